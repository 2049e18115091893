r"""Formatting conversations of typed content parts.

A turn is written as ``<turn ROLE>``, line end, its parts one after another, ``</turn>``, line end.
A visitor flattens the parts: text is escaped; an image, audio or document part becomes a
placeholder such as ``<image 2>``, numbered in order over the conversation, and leaves an
attachment record with its reference and the tokens it expands to.

All control strings start with ``<``. Inside texts ``\`` becomes ``\\`` and ``<`` becomes ``\<``,
so no text can imitate a control string and unescaping gives the text back exactly. In roles ``>``
and line ends are escaped too.

The output has one row per turn. The turns of a conversation in order, joined, are its formatted
text; a conversation of any length passes through one turn at a time.
"""

from __future__ import annotations

import hashlib
import math
import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

END = "</turn>\n"
_HEAD = re.compile(r"<turn ((?:[^\\>]|\\.)*)>\n", re.S)
_PLACEHOLDER = re.compile(r"(?<!\\)((?:\\\\)*)<(image|audio|document|part) \d+>")
_ESCAPED = re.compile(r"\\(.)", re.S)

PART = (
    "struct<type:string,text:string,ref:string,width:int,height:int,seconds:double,pages:int>"
)
_ATTACHMENT = "struct<placeholder:string,type:string,ref:string,tokens:bigint>"
_OUT = (
    "conv_id bigint, place bigint, formatted string, loss_start bigint, loss_end bigint,"
    f" tokens bigint, attachments array<{_ATTACHMENT}>"
)


@dataclass(frozen=True)
class Rates:
    """How attachments expand to tokens."""

    patch: int = 14
    per_second: float = 25.0
    per_page: int = 256
    other: int = 1


def escape(text: str) -> str:
    return text.replace("\\", "\\\\").replace("<", "\\<")


def unescape(text: str) -> str:
    return _ESCAPED.sub(r"\1", text) if "\\" in text else text


def escape_role(role: str) -> str:
    return escape(role).replace(">", "\\>").replace("\n", "\\n")


def unescape_role(role: str) -> str:
    return _ESCAPED.sub(lambda m: "\n" if m[1] == "n" else m[1], role)


@dataclass
class PartVisitor:
    """Flattens the parts of one conversation's turns."""

    rates: Rates = field(default_factory=Rates)
    seen: int = 0

    def turn(self, role: str, parts: list[dict]) -> tuple[str, int, list[dict]]:
        """The formatted turn, where its body starts, and its attachments."""
        head = f"<turn {escape_role(role)}>\n"
        body: list[str] = []
        attachments: list[dict] = []
        for part in parts:
            visit = getattr(self, f"visit_{part.get('type') or 'text'}", self.visit_part)
            written, attached = visit(part)
            body.append(written)
            if attached:
                attachments.append(attached)
        return head + "".join(body) + END, len(head), attachments

    def visit_text(self, part: dict) -> tuple[str, None]:
        return escape(part.get("text") or ""), None

    def visit_image(self, part: dict) -> tuple[str, dict]:
        across, down = (math.ceil((part.get(k) or 0) / self.rates.patch) for k in ("width", "height"))
        return self._attach("image", part, across * down)

    def visit_audio(self, part: dict) -> tuple[str, dict]:
        return self._attach("audio", part, math.ceil((part.get("seconds") or 0) * self.rates.per_second))

    def visit_document(self, part: dict) -> tuple[str, dict]:
        return self._attach("document", part, (part.get("pages") or 0) * self.rates.per_page)

    def visit_part(self, part: dict) -> tuple[str, dict]:
        """A part of a type that is not known keeps its place and its reference."""
        return self._attach("part", part, self.rates.other)

    def _attach(self, kind: str, part: dict, tokens: int) -> tuple[str, dict]:
        self.seen += 1
        placeholder = f"<{kind} {self.seen}>"
        # A placeholder stands for one token at least, also where its size is not known.
        return placeholder, {
            "placeholder": placeholder, "type": part.get("type"), "ref": part.get("ref"), "tokens": max(tokens, 1),
        }


def parse_turn(formatted: str) -> tuple[str, str]:
    """Role and text of a formatted turn; placeholders are left out of the text."""
    head = _HEAD.match(formatted)
    if head is None or not formatted.endswith(END):
        raise ValueError("not a formatted turn")
    body = formatted[head.end() : -len(END)]
    return unescape_role(head[1]), unescape(_PLACEHOLDER.sub(r"\1", body))


def format_turns(df: DataFrame, rates: Rates = Rates(), loss_roles: tuple[str, ...] = ("assistant",)) -> DataFrame:
    """Format conversations given as rows (conv_id, turn, role, text or parts).

    ``parts`` (array of ``PART``) is used where the column exists and is not null, ``text`` as a
    single text part elsewhere. Returns one row per turn: conv_id, place (1 up, in order),
    formatted, loss_start and loss_end (code points within ``formatted`` under the loss mask, null
    for other roles), tokens (that the attachments expand to) and attachments.

    Defined results: turns go by number, a null number first, equal numbers by role and text; null
    role and null text count as empty; rows with null conv_id make one conversation; repeated rows
    are turns each; other columns are left out. Turns of a conversation meet in one task, which
    holds one batch of them.
    """
    spark = df.sparkSession
    parts = F.col("parts").cast(f"array<{PART}>") if "parts" in df.columns else F.lit(None).cast(f"array<{PART}>")
    text = F.col("text") if "text" in df.columns else F.lit(None).cast("string")
    rows = df.select(
        F.col("conv_id").cast("bigint").alias("conv_id"),
        F.col("turn").cast("bigint").alias("turn"),
        F.coalesce("role", F.lit("")).alias("role"),
        text.alias("text"),
        parts.alias("parts"),
    )
    wide = int(spark.conf.get("spark.sql.shuffle.partitions"))
    ordered = rows.repartition(wide, "conv_id").sortWithinPartitions("conv_id", "turn", "role", "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, place, visitor = object(), 0, PartVisitor(rates)
        for batch in batches:
            out = []
            for row in batch.to_pylist():
                if row["conv_id"] != current:
                    current, place, visitor = row["conv_id"], 0, PartVisitor(rates)
                place += 1
                given = row["parts"] if row["parts"] is not None else [{"type": "text", "text": row["text"]}]
                formatted, start, attached = visitor.turn(row["role"], [p or {} for p in given])
                learned = row["role"] in loss_roles
                out.append({
                    "conv_id": current, "place": place, "formatted": formatted,
                    "loss_start": start if learned else None,
                    "loss_end": len(formatted) - len(END) if learned else None,
                    "tokens": sum(a["tokens"] for a in attached), "attachments": attached,
                })
            yield pa.RecordBatch.from_pylist(out, _ARROW)

    return ordered.mapInArrow(run, _OUT)


_ARROW = pa.schema([
    ("conv_id", pa.int64()), ("place", pa.int64()), ("formatted", pa.string()),
    ("loss_start", pa.int64()), ("loss_end", pa.int64()), ("tokens", pa.int64()),
    ("attachments", pa.list_(pa.struct([
        ("placeholder", pa.string()), ("type", pa.string()), ("ref", pa.string()), ("tokens", pa.int64()),
    ]))),
])


def read_back(turns: DataFrame) -> DataFrame:
    """Per conversation what its formatted turns say when parsed again.

    Returns conv_id, n_turns, turns_sha256 (of role, line end, text, line end per turn), loss_chars
    and loss_sha256 (the unescaped text under the loss mask, in order) and formatted_chars.
    """
    wide = int(turns.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    rows = turns.select("conv_id", "place", "formatted", "loss_start", "loss_end")
    ordered = rows.repartition(wide, "conv_id").sortWithinPartitions("conv_id", "place")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: _Digest | None = None
        for batch in batches:
            done = []
            for row in batch.to_pylist():
                if held is None or held.conv_id != row["conv_id"]:
                    if held is not None:
                        done.append(held.row())
                    held = _Digest(row["conv_id"])
                held.add(row["formatted"], row["loss_start"], row["loss_end"])
            if done:
                yield pa.RecordBatch.from_pylist(done, _DIGESTS)
        if held is not None:
            yield pa.RecordBatch.from_pylist([held.row()], _DIGESTS)

    return ordered.mapInArrow(
        run,
        "conv_id bigint, n_turns bigint, turns_sha256 string, loss_chars bigint, loss_sha256 string,"
        " formatted_chars bigint",
    )


_DIGESTS = pa.schema([
    ("conv_id", pa.int64()), ("n_turns", pa.int64()), ("turns_sha256", pa.string()),
    ("loss_chars", pa.int64()), ("loss_sha256", pa.string()), ("formatted_chars", pa.int64()),
])


class _Digest:
    """Running digests of one conversation."""

    def __init__(self, conv_id: int | None):
        self.conv_id = conv_id
        self.turns, self.loss = hashlib.sha256(), hashlib.sha256()
        self.n_turns = self.loss_chars = self.chars = 0

    def add(self, formatted: str, start: int | None, end: int | None) -> None:
        role, text = parse_turn(formatted)
        self.turns.update(f"{role}\n{text}\n".encode())
        self.n_turns += 1
        self.chars += len(formatted)
        if start is not None:
            learned = unescape(_PLACEHOLDER.sub(r"\1", formatted[start:end]))
            self.loss.update(learned.encode())
            self.loss_chars += len(learned)

    def row(self) -> dict:
        return {
            "conv_id": self.conv_id, "n_turns": self.n_turns, "turns_sha256": self.turns.hexdigest(),
            "loss_chars": self.loss_chars, "loss_sha256": self.loss.hexdigest(), "formatted_chars": self.chars,
        }

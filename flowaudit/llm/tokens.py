"""Ids of a vocabulary file of the tokenizers library, each distinct segment encoded once."""

from __future__ import annotations

import os
import re
from collections.abc import Callable

import pyarrow as pa

from flowaudit.llm.segments import Remembered, Vocabulary, byte_level_entries, segments, taken
from flowaudit.llm.textops import text_bytes

_loaded: dict[str, Callable[[pa.Array], list[bytes]]] = {}


def library_encoder(path: str) -> Callable[[], Callable[[pa.Array], list[bytes]]]:
    """A maker of encoders for ``bitplanes.write_shards``: texts to little-endian id bytes.

    Equal to ``Tokenizer.encode(text, add_special_tokens=False).ids`` for every text; null counts as
    empty. The vocabulary must be a byte-level one whose added tokens hold and take no white space.
    """

    def make() -> Callable[[pa.Array], list[bytes]]:
        if path not in _loaded:
            _loaded[path] = _encoder(path)
        return _loaded[path]

    return make


def _encoder(path: str) -> Callable[[pa.Array], list[bytes]]:
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    library = Tokenizer.from_file(path)
    for token in library.get_added_tokens_decoder().values():
        if token.lstrip or token.rstrip or re.search(r"\s", token.content):
            raise ValueError(f"added token {token.content!r} reaches over white space")
    remembered = Remembered(
        Vocabulary(
            lambda texts: [e.ids for e in library.encode_batch_fast(texts, add_special_tokens=False)],
            byte_level_entries(library),
            0,
        )
    )

    def encode(texts: pa.Array) -> list[bytes]:
        cut = segments(*text_bytes(texts))
        lists, _ = remembered.ids(cut.distinct)
        flat, places = taken(lists, cut.numbers, cut.places)
        raw = flat.astype("<u4").tobytes()
        return [raw[4 * a : 4 * b] for a, b in zip(places[:-1].tolist(), places[1:].tolist())]

    return encode

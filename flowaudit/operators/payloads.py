"""Raw component payloads, their properties, and the column catalog."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from flowaudit.functions.payload import property_map
from flowaudit.functions.text import compose_type_name
from flowaudit.operators.joins import lookup
from flowaudit.operators.lag import unique_matches
from flowaudit.operators.ordered import SPLIT_ROWS, with_previous

# Monitoring commands and component kinds of the payload table.
COMMANDS = ("mon", "describe")
COMPONENT_TYPES = ("APP", "SOURCE", "STREAM", "TARGET", "TYPE")


def with_reason(df: DataFrame, payload: str = "jsondata") -> DataFrame:
    """Add why a payload cannot be captured as ``reason``, null where it can.

    The first that holds of: ``command`` or ``type`` not known, payload ``missing``, not ``json``, or JSON
    but no ``object``. The payload is parsed once.
    """
    parsed = F.schema_of_variant(F.try_parse_json(F.col(payload)))
    reason = (
        F.when(~F.coalesce(F.col("command").isin(*COMMANDS), F.lit(False)), "command")
        .when(~F.coalesce(F.col("type").isin(*COMPONENT_TYPES), F.lit(False)), "type")
        .when(F.col(payload).isNull(), "missing")
        .when(parsed.isNull(), "json")
        .when(~parsed.startswith("OBJECT"), "object")
    )
    return df.withColumn("reason", reason)


def capture(df: DataFrame) -> DataFrame:
    """Payloads with a known command, a known component kind and a JSON object."""
    return _judged(df).where("__reason IS NULL").drop("__reason")


def capture_rejects(df: DataFrame) -> DataFrame:
    """The payloads that ``capture`` leaves out; ``with_reason`` says why."""
    return _judged(df).where("__reason IS NOT NULL").drop("__reason")


def _judged(df: DataFrame) -> DataFrame:
    named = with_reason(df.select("command", "type", "jsondata", F.struct("*").alias("__row")))
    return named.select("__row.*", F.col("reason").alias("__reason"))


def reject_counts(df: DataFrame) -> DataFrame:
    """Rows per reason, those kept under ``kept``; they add up to the rows of ``df``."""
    judged = _judged(df).groupBy(F.coalesce("__reason", F.lit("kept")).alias("reason"))
    return judged.agg(F.count(F.lit(1)).alias("row_count"))


# Possessive, as Java walks other repetitions of alternatives by recursion and fails on long strings.
_BRACKETS = r'"[^"\\]*+(?:\\.[^"\\]*+)*+"|[^\[\]{}"]++'
_EMPTY_SIBLINGS = r"(?:[{\[][}\]]){2,}+"


def _spread(df: DataFrame) -> DataFrame:
    """Rows dealt to all cores: each gives many rows, and few files of small rows give few tasks."""
    return df.repartition(2 * df.sparkSession.sparkContext.defaultParallelism)


def _depth(df: DataFrame, payload: str) -> int:
    """Levels of the most nested payload, from its brackets outside of strings.

    Payloads of one shape have the same brackets, so these are made distinct before they are counted.
    """
    is_json = F.try_parse_json(F.col(payload)).isNotNull()
    brackets = F.regexp_replace(F.regexp_replace(F.col(payload), _BRACKETS, ""), _EMPTY_SIBLINGS, "{}")
    shapes = _spread(df.select(F.col(payload))).where(is_json).select(brackets.alias("shape")).distinct()
    start = F.struct(F.lit(0).alias("now"), F.lit(0).alias("most"))

    def step(state, mark):
        now = state["now"] + F.when(mark.isin("{", "["), 1).when(mark.isin("}", "]"), -1).otherwise(0)
        return F.struct(now.alias("now"), F.greatest(state["most"], now).alias("most"))

    deepest = F.max(F.aggregate(F.split("shape", ""), start, step, lambda state: state["most"]))
    return shapes.agg(deepest).first()[0] or 0


def payload_paths(df: DataFrame, payload: str = "jsondata") -> DataFrame:
    """One row per value of each payload at any depth: its ``path``, ``kind`` and text ``value``.

    A path reads ``a.b[0].c``; keys that are no plain names stand as ``['key']``. Objects and arrays give
    a row of their own only where they are empty. Kinds are object, array, string, number, boolean and
    null. Payloads that are no JSON give no rows; ``with_reason`` names them. The payload is parsed once and opened
    level by level in one pass; how many levels there are is read from the brackets first. Opening finds
    nothing inside plain and empty values, so only these last ones are written out as text.
    """
    kept = [F.col(f"`{c}`") for c in df.columns if c != payload]
    levels = _depth(df, payload)
    parsed = F.try_parse_json(F.col(payload))
    rows = _spread(df).select(F.struct(*kept).alias("__kept"), parsed.alias("__v"), F.lit("").alias("__path"))
    rows = rows.where(F.col("__v").isNotNull()).withColumn("__open", F.col("__v"))
    for _ in range(levels):
        inside = df.sparkSession.tvf.variant_explode_outer(F.col("__open").outer())
        plain = F.when(F.col("key").rlike(r"^\w+$"), F.concat(F.lit("."), "key"))
        named = F.coalesce(plain, F.concat(F.lit("['"), "key", F.lit("']")))
        step = F.when(F.col("key").isNotNull(), named).otherwise(F.concat(F.lit("["), F.col("pos").cast("string"), F.lit("]")))
        done = F.col("pos").isNull()
        rows = rows.lateralJoin(inside).select(
            "__kept",
            F.when(done, F.col("__v")).otherwise(F.col("value")).alias("__v"),
            F.when(done, F.col("__path")).otherwise(F.concat("__path", step)).alias("__path"),
            F.col("value").alias("__open"),
        )
    rows = rows.select("__kept", "__v", "__path", F.to_json("__v").alias("__text"))
    mark = F.substring("__text", 1, 1)
    kind = (
        F.when(mark == "{", "object").when(mark == "[", "array").when(mark == '"', "string")
        .when(mark.isin("t", "f"), "boolean").when(mark == "n", "null").otherwise("number")
    )
    value = F.when(mark == '"', F.col("__v").cast("string")).when(mark != "n", F.col("__text"))
    return rows.select("__kept.*", F.ltrim(F.col("__path"), F.lit(".")).alias("path"), kind.alias("kind"), value.alias("value"))


def properties(df: DataFrame, payload: str = "jsondata") -> DataFrame:
    """One row per top-level property of each payload."""
    kept = [c for c in df.columns if c != payload]
    return df.select(
        *kept, F.explode(property_map(F.col(payload))).alias("property", "value")
    )


def property_changes(
    props: DataFrame,
    keys: Sequence[str] = ("app_name", "component_name", "property"),
    order: Sequence[str] = ("batch_ts",),
    value: str = "value",
    split_rows: int | None = SPLIT_ROWS,
) -> DataFrame:
    """Captures whose property value differs from the capture before; the first is no change."""
    seen = props.withColumn("__seen", F.lit(True))
    before = with_previous(
        seen, keys, order, {"previous_value": value, "__had": "__seen"}, split_rows
    )
    changed = F.col("__had") & ~F.col(value).eqNullSafe(F.col("previous_value"))
    return before.where(changed).drop("__seen", "__had")


def columns_of(types: DataFrame, columns: str = "columns") -> DataFrame:
    """One row per column of each type definition, in place order."""
    kept = [c for c in types.columns if c != columns]
    return types.select(*kept, F.posexplode(columns).alias("position", "__column")).select(
        *kept,
        F.col("position").cast("bigint").alias("position"),
        F.col("__column.name").alias("column_name"),
        F.col("__column.type").alias("column_type"),
        F.col("__column.is_pk").alias("is_pk"),
    )


def match_type(types: DataFrame, tables: DataFrame, separator: str = "_") -> DataFrame:
    """Find the app and table a type was made for, by the composed name.

    ``tables`` has ``app_name`` and ``table_name``. Several fitting pairs leave both null.
    """
    pairs = tables.select(
        compose_type_name(F.col("app_name"), F.col("table_name"), separator).alias("__name"),
        F.struct("app_name", "table_name").alias("pair"),
    )
    matches = unique_matches(pairs, "__name", "pair").select(
        F.col("__name"),
        F.col("__owner.app_name").alias("app_name"),
        F.col("__owner.table_name").alias("table_name"),
        "candidates",
    )
    return (
        lookup(types, matches, F.upper("type_name"), "__name")
        .withColumn("candidates", F.coalesce("candidates", F.lit(0).cast("bigint")))
    )


def emit_on_change(
    df: DataFrame,
    keys: Sequence[str] = ("type_name",),
    version: str = "created_date",
    order: Sequence[str] = ("batch_ts",),
    split_rows: int | None = SPLIT_ROWS,
) -> DataFrame:
    """Rows seen first for their key, or whose version differs from the row before."""
    seen = df.withColumn("__seen", F.lit(True))
    before = with_previous(
        seen, keys, order, {"__version": version, "__had": "__seen"}, split_rows
    )
    fresh = F.col("__had").isNull() | ~F.col(version).eqNullSafe(F.col("__version"))
    return before.where(fresh).drop("__seen", "__version", "__had")

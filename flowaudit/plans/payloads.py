"""Payload, property and column catalog queries."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from flowaudit.operators import payloads
from flowaudit.plans import inputs as i
from flowaudit.plans.registry import query
from flowaudit.session import cut


def captured(ev: DataFrame) -> DataFrame:
    """Each event is a capture of a component: clicks carry broken JSON, errors a strange command."""
    kinds = {"signup": "APP", "purchase": "SOURCE", "click": "STREAM", "view": "TARGET",
             "error": "TYPE"}
    commands = {"signup": "mon", "purchase": "describe", "click": "mon", "view": "describe",
                "error": "stop"}
    good = F.concat(
        F.lit('{"band": '), F.floor(F.col("k") / 25).cast("bigint"), F.lit(', "kind": "'),
        F.col("event_type"), F.lit('"}'),
    )
    return ev.select(
        "event_id", F.col("ts").alias("batch_ts"), "hour_ts", "app_name",
        F.col("event_type").alias("component_name"),
        i.pick(F.col("event_type"), commands).alias("command"),
        i.pick(F.col("event_type"), kinds).alias("type"),
        F.when(F.col("event_type") == "click", "{bad").otherwise(good).alias("jsondata"),
    )


@query(
    "payload_envelope",
    f"""WITH {i.EV} SELECT event_id, app_name, event_type AS component_name,
  CASE event_type WHEN 'signup' THEN 'mon' ELSE 'describe' END AS command,
  CASE event_type WHEN 'signup' THEN 'APP' WHEN 'purchase' THEN 'SOURCE' ELSE 'TARGET' END AS type,
  '{{"band": ' || (k // 25) || ', "kind": "' || event_type || '"}}' AS jsondata
FROM ev WHERE event_type NOT IN ('click', 'error')""",
)
def payload_envelope(spark: SparkSession, sf_dir: str) -> DataFrame:
    good = payloads.capture(captured(i.events(spark, sf_dir)))
    return good.select("event_id", "app_name", "component_name", "command", "type", "jsondata")


@query(
    "payload_rejects",
    """SELECT event_type AS component_name, count(*) AS row_count FROM events
WHERE event_type IN ('click', 'error') GROUP BY 1""",
)
def payload_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    bad = payloads.capture_rejects(captured(i.events(spark, sf_dir)))
    return bad.groupBy("component_name").agg(F.count(F.lit(1)).alias("row_count"))


@query(
    "payload_reject_reasons",
    """SELECT CASE WHEN event_type = 'error' THEN 'command' WHEN event_type = 'click' THEN 'json'
  WHEN event_type = 'view' AND event_id % 2 = 0 THEN 'object' WHEN event_type = 'signup' AND event_id % 3 = 0 THEN 'missing'
  ELSE 'kept' END AS reason, count(*) AS row_count FROM events GROUP BY 1""",
)
def payload_reject_reasons(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every second view sends an array, every third signup nothing; all rows are kept or rejected once."""
    sent = captured(i.events(spark, sf_dir))
    array = (F.col("component_name") == "view") & (F.col("event_id") % 2 == 0)
    nothing = (F.col("component_name") == "signup") & (F.col("event_id") % 3 == 0)
    text = F.when(array, "[1, 2]").when(~nothing, F.col("jsondata"))
    return payloads.reject_counts(sent.withColumn("jsondata", text))


_NESTED_SQL = """SELECT event_id, 'band' AS path, 'number' AS kind, CAST(k // 25 AS VARCHAR) AS value FROM ev
UNION ALL SELECT event_id, 'kind', 'string', event_type FROM ev
UNION ALL SELECT event_id, 'limits.rows', 'number', CAST(k AS VARCHAR) FROM ev
UNION ALL SELECT event_id, 'limits.on', 'boolean', CASE WHEN k > 50 THEN 'true' ELSE 'false' END FROM ev
UNION ALL SELECT event_id, 'limits[''a b'']', 'null', NULL FROM ev
UNION ALL SELECT event_id, 'steps[0].at', 'string', '{[' FROM ev
UNION ALL SELECT event_id, 'steps[1][0]', 'number', '2' FROM ev
UNION ALL SELECT event_id, 'steps[1][1].deep.er', 'array', '[]' FROM ev"""


@query("payload_paths", f"WITH {i.EV} {_NESTED_SQL}")
def payload_paths(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Nested payloads of every event, opened down to their single values."""
    ev = i.events(spark, sf_dir)
    text = F.concat(
        F.lit('{"band": '), F.floor(F.col("k") / 25).cast("bigint").cast("string"), F.lit(', "kind": "'), "event_type",
        F.lit('", "limits": {"rows": '), F.col("k").cast("string"), F.lit(', "on": '), (F.col("k") > 50).cast("string"),
        F.lit(', "a b": null}, "steps": [{"at": "{["}, [2, {"deep": {"er": []}}]]}'),
    )
    return payloads.payload_paths(ev.select("event_id", text.alias("jsondata")))


@query(
    "payload_properties",
    f"""WITH {i.EV} SELECT event_id, 'band' AS property, CAST(k // 25 AS VARCHAR) AS value
FROM ev WHERE event_type NOT IN ('click', 'error')
UNION ALL SELECT event_id, 'kind', event_type FROM ev WHERE event_type NOT IN ('click', 'error')""",
)
def payload_properties(spark: SparkSession, sf_dir: str) -> DataFrame:
    good = payloads.capture(captured(i.events(spark, sf_dir)))
    return payloads.properties(good).select("event_id", "property", "value")


@query(
    "property_changes",
    f"""WITH {i.EV}, p AS (SELECT event_id, app_name, event_type AS component_name, CAST(k // 25 AS VARCHAR) AS value,
    lag(CAST(k // 25 AS VARCHAR)) OVER (PARTITION BY app_name, event_type ORDER BY ts, event_id) AS previous_value
  FROM ev WHERE event_type NOT IN ('click', 'error'))
SELECT event_id, app_name, component_name, 'band' AS property, previous_value, value
FROM p WHERE previous_value <> value""",
)
def property_changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    props = payloads.properties(payloads.capture(captured(i.events(spark, sf_dir))))
    changes = payloads.property_changes(
        cut(props, "properties"), order=("batch_ts", "event_id")
    )
    return changes.select(
        "event_id", "app_name", "component_name", "property", "previous_value", "value"
    )


def _type_definitions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A part is a type; the words of its name are its columns, the first one the key."""
    words = F.split("p_name", " ")
    columns = F.transform(
        words,
        lambda word, place: F.struct(
            word.alias("name"), F.col("p_type").alias("type"), (place == 0).alias("is_pk")
        ),
    )
    return i.table(spark, sf_dir, "part").select("p_partkey", columns.alias("columns"))


@query(
    "type_columns",
    """SELECT p_partkey, n - 1 AS position, string_split(p_name, ' ')[n] AS column_name,
  p_type AS column_type, n = 1 AS is_pk
FROM part, unnest(range(1, len(string_split(p_name, ' ')) + 1)) AS t(n)""",
)
def type_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    return payloads.columns_of(_type_definitions(spark, sf_dir))


@query(
    "match_type",
    """WITH pairs AS (
  SELECT DISTINCT p_brand AS app_name, p_type AS table_name FROM part
  UNION SELECT DISTINCT lower(p_brand), p_type FROM part WHERE p_retailprice >= 1000),
owners AS (
  SELECT upper(app_name) || '_' || upper(table_name) AS type_name, count(*) AS candidates,
    CASE WHEN count(*) = 1 THEN min(app_name) END AS app_name,
    CASE WHEN count(*) = 1 THEN min(table_name) END AS table_name FROM pairs GROUP BY 1)
SELECT p_partkey, t.type_name, app_name, table_name, coalesce(candidates, 0) AS candidates
FROM (SELECT p_partkey, 'Brand#' || p_size || '_' || p_type AS type_name FROM part) t
LEFT JOIN owners o ON upper(t.type_name) = o.type_name""",
)
def match_type(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Brand and type compose to a name; dear brands are also spelt in small letters."""
    part = i.table(spark, sf_dir, "part")
    tables = part.select(F.col("p_brand").alias("app_name"), F.col("p_type").alias("table_name"))
    twins = part.where(F.col("p_retailprice") >= 1000).select(
        F.lower("p_brand").alias("app_name"), F.col("p_type").alias("table_name")
    )
    types = part.select(
        "p_partkey",
        F.concat(F.lit("Brand#"), "p_size", F.lit("_"), "p_type").alias("type_name"),
    )
    return payloads.match_type(types, tables.unionByName(twins))


@query(
    "emit_on_change",
    f"""WITH {i.EV}, v AS (SELECT event_id, table_name AS type_name, k // 25 AS band,
    lag(k // 25) OVER (PARTITION BY table_name ORDER BY ts, event_id) AS before FROM ev)
SELECT event_id, type_name, band FROM v WHERE before IS DISTINCT FROM band""",
)
def emit_on_change(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every event polls the type of its table; the band of ``k`` is the version."""
    polls = i.events(spark, sf_dir).select(
        "event_id", "ts", "hour_ts", F.col("table_name").alias("type_name"),
        F.floor(F.col("k") / 25).cast("bigint").alias("band"),
    )
    fresh = payloads.emit_on_change(
        polls, ("type_name",), "band", ("ts", "event_id")
    )
    return fresh.select("event_id", "type_name", "band")

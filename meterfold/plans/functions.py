"""Scalar functions and nested values: SCA-1..12, NST-1..4."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from meterfold.functions import fixed, load, slots, text, vectors
from meterfold.operators import rollup
from meterfold.plans import standins as si
from meterfold.plans.aggregations import nested_recap
from meterfold.plans.registry import query
from meterfold.sources import messages, tables


def _events(spark: SparkSession, folder: str) -> DataFrame:
    return tables.load(spark, folder, "events")


@query(
    "SCA-1_lower_split",
    """SELECT doc_id, CAST(len(string_split(lower(text), ' ')) AS INTEGER) AS tokens,
              string_split(lower(text), ' ')[1] AS first,
              string_split(lower(text), ' ')[-1] AS last FROM documents""",
)
def lower_split(spark: SparkSession, folder: str) -> DataFrame:
    words = tables.load(spark, folder, "documents").select(
        "doc_id", text.words(F.col("text")).alias("w")
    )
    return words.select(
        "doc_id",
        F.size("w").alias("tokens"),
        F.element_at("w", 1).alias("first"),
        F.element_at("w", -1).alias("last"),
    )


@query(
    "SCA-2_strip",
    r"""SELECT doc_id, length(regexp_replace(line, '^\s+|\s+$', '', 'g')) AS n, line_no
        FROM (SELECT doc_id, unnest(string_split(text, chr(10))) AS line,
                     unnest(range(len(string_split(text, chr(10)))))::INTEGER AS line_no
              FROM documents)""",
)
def strip(spark: SparkSession, folder: str) -> DataFrame:
    documents = tables.load(spark, folder, "documents")
    lines = documents.select("doc_id", F.posexplode(F.split("text", "\n", -1)).alias("line_no", "line"))
    return lines.select(
        "doc_id", "line_no", F.length(text.strip(F.col("line"))).cast("bigint").alias("n")
    )


@query(
    "SCA-3_round",
    """SELECT event_id, round(value / 7e0, 2) AS two, round(value / 7e0, 3) AS three,
              round(value / 7e0, 4) AS four FROM events""",
)
def rounding(spark: SparkSession, folder: str) -> DataFrame:
    value = F.col("value") / F.lit(7.0)
    return _events(spark, folder).select(
        "event_id",
        fixed.rounded(value, 2).alias("two"),
        fixed.rounded(value, 3).alias("three"),
        fixed.rounded(value, 4).alias("four"),
    )


@query(
    "SCA-4_abs_least_greatest",
    """SELECT event_id, abs(value - 35e0) AS gap, greatest(value, 1e0) AS at_least,
              least(value, 100e0) AS at_most FROM events""",
)
def extremes(spark: SparkSession, folder: str) -> DataFrame:
    value = F.col("value")
    return _events(spark, folder).select(
        "event_id",
        F.abs(value - F.lit(35.0)).alias("gap"),
        F.greatest(value, F.lit(1.0)).alias("at_least"),
        F.least(value, F.lit(100.0)).alias("at_most"),
    )


_DISTANCE_SQL = """sqrt(list_sum(list_transform(range(1, len({a}) + 1),
    lambda i: (CAST({a}[i] AS DOUBLE) - CAST({b}[i] AS DOUBLE)) ** 2)))"""
_HALVES_SQL = "embedding[1:32] AS a, embedding[33:64] AS b"


@query(
    "SCA-5_distance",
    f"""SELECT vec_id, round({_DISTANCE_SQL.format(a='a', b='b')}, 6) AS distance
        FROM (SELECT vec_id, {_HALVES_SQL} FROM embeddings)""",
)
def distance(spark: SparkSession, folder: str) -> DataFrame:
    vector = F.col("embedding").cast("array<double>")
    halves = tables.load(spark, folder, "embeddings").select(
        "vec_id", F.slice(vector, 1, 32).alias("a"), F.slice(vector, 33, 32).alias("b")
    )
    return halves.select("vec_id", F.round(vectors.euclidean(F.col("a"), F.col("b")), 6).alias("distance"))


@query(
    "SCA-6_first_smallest",
    """SELECT vec_id, CAST(list_position(embedding, list_min(embedding)) - 1 AS INTEGER) AS place
       FROM embeddings""",
)
def first_smallest(spark: SparkSession, folder: str) -> DataFrame:
    place = vectors.first_smallest(F.col("embedding"))
    return tables.load(spark, folder, "embeddings").select("vec_id", place.alias("place"))


@query(
    "SCA-7_hour_weekend",
    """SELECT event_id, hour(ts) + minute(ts) / 60e0 AS hour, isodow(ts) >= 6 AS weekend FROM events""",
)
def hour_weekend(spark: SparkSession, folder: str) -> DataFrame:
    ts = F.col("ts")
    return _events(spark, folder).select(
        "event_id", load.decimal_hour(ts).alias("hour"), load.is_weekend(ts).alias("weekend")
    )


@query(
    "SCA-8_expected_load",
    """WITH placed AS (
           SELECT event_id, value, ts, hour(ts) + minute(ts) / 60e0 AS h,
                  CASE event_type WHEN 'click' THEN 'Residential' WHEN 'error' THEN 'Industrial'
                       WHEN 'purchase' THEN 'Commercial' ELSE event_type END AS zone FROM events),
       factors AS (
           SELECT *, CASE zone
               WHEN 'Industrial' THEN 0.20e0 + 1.20e0 * (1e0 / (1 + exp(-(h - 7.5e0) * 1.6e0)))
                    * (1e0 / (1 + exp((h - 18e0) * 1.4e0)))
               WHEN 'Commercial' THEN 0.30e0 + 0.95e0 * exp(-((h - 11.5e0) ** 2) / 3.92e0)
                    + 1.20e0 * exp(-((h - 20e0) ** 2) / 3.92e0)
               ELSE 0.30e0 + 0.85e0 * exp(-((h - 8e0) ** 2) / 2.88e0)
                    + 1.45e0 * exp(-((h - 20.5e0) ** 2) / 4.5e0) END AS factor,
               CASE zone WHEN 'Residential' THEN 0.45e0 WHEN 'Commercial' THEN 1.2e0
                    WHEN 'Industrial' THEN 3.5e0 ELSE 0.45e0 END AS base,
               CASE WHEN isodow(ts) < 6 THEN 1e0 ELSE CASE zone WHEN 'Industrial' THEN 0.45e0
                    WHEN 'Residential' THEN 1.1e0 ELSE 1.05e0 END END AS weekend FROM placed)
       SELECT event_id, round(base * factor * weekend, 6) AS expected,
              round(value / (base * factor * weekend), 4) AS ratio FROM factors""",
)
def expected_load(spark: SparkSession, folder: str) -> DataFrame:
    kind = F.col("event_type")
    zone = (
        F.when(kind == "click", "Residential")
        .when(kind == "error", "Industrial")
        .when(kind == "purchase", "Commercial")
        .otherwise(kind)
    )
    expected = load.expected_energy(zone, F.col("ts"))
    placed = _events(spark, folder).select("event_id", "value", expected.alias("expected"))
    return placed.select(
        "event_id",
        F.round("expected", 6).alias("expected"),
        F.round(F.col("value") / F.col("expected"), 4).alias("ratio"),
    )


@query(
    "SCA-9_time_text",
    """SELECT event_id, strftime(ts, '%Y-%m-%dT%H:%M:%S') AS iso, strftime(ts, '%H:%M') AS clock,
              date_trunc('second', ts) AS parsed, ts + INTERVAL '17 minutes' AS later FROM events""",
)
def time_text(spark: SparkSession, folder: str) -> DataFrame:
    ts = F.col("ts")
    return _events(spark, folder).select(
        "event_id",
        text.iso(ts).alias("iso"),
        text.clock(ts).alias("clock"),
        text.parse_iso(text.iso(ts)).alias("parsed"),
        text.minutes_later(ts, 17).alias("later"),
    )


@query(
    "SCA-10_hash_slot",
    """SELECT event_id, o AS offset_s, least(o // 60, 14) AS slot FROM (
           SELECT event_id, (('0x' || md5(CAST(event_id AS VARCHAR)))::UHUGEINT % 900)::BIGINT AS o
           FROM events)""",
)
def hash_slot(spark: SparkSession, folder: str) -> DataFrame:
    key = F.col("event_id").cast("string")
    return _events(spark, folder).select(
        "event_id",
        slots.md5_modulo(key, 900).alias("offset_s"),
        slots.window_slot(key).alias("slot"),
    )


@query(
    "SCA-11_number_text",
    """SELECT o_orderkey, replace(format('{:,}', o_orderkey * 1000), ',', ' ') AS whole,
              replace(format('{:,.2f}', o_totalprice), ',', ' ') AS money,
              printf('%+.1f%%', (o_totalprice - 1e5) / 1e5 * 100) AS change FROM orders""",
)
def number_text(spark: SparkSession, folder: str) -> DataFrame:
    price = F.col("o_totalprice")
    change = (price - F.lit(1e5)) / F.lit(1e5) * F.lit(100.0)
    return tables.load(spark, folder, "orders").select(
        "o_orderkey",
        text.grouped_int(F.col("o_orderkey") * 1000).alias("whole"),
        text.grouped_float(price).alias("money"),
        text.signed_percent(change).alias("change"),
    )


@query(
    "SCA-12_keys",
    """SELECT 'cycle-' || c_custkey AS cycle_key,
              printf('GRD-%s-MTR-%05d', c_mktsegment, c_custkey) AS meter_key FROM customer""",
)
def keys(spark: SparkSession, folder: str) -> DataFrame:
    parts = [F.lit("GRD"), F.col("c_mktsegment"), F.lit("MTR")]
    return tables.load(spark, folder, "customer").select(
        text.cycle_key(F.col("c_custkey")).alias("cycle_key"),
        text.sequence_key(parts, F.col("c_custkey")).alias("meter_key"),
    )


@query(
    "NST-1_explode",
    "SELECT doc_id, unnest(string_split(lower(text), ' ')) AS word FROM documents",
)
def explode(spark: SparkSession, folder: str) -> DataFrame:
    documents = tables.load(spark, folder, "documents")
    return documents.select("doc_id", F.explode(text.words(F.col("text"))).alias("word"))


@query(
    "NST-2_record_json",
    """SELECT event_id, strftime(ts, '%Y-%m-%dT%H:%M:%S.%f') AS "timestamp", event_type, value, props
       FROM events""",
)
def record_json(spark: SparkSession, folder: str) -> DataFrame:
    events = _events(spark, folder).withColumnRenamed("ts", "timestamp")
    line = messages.record_json(events).alias("line")
    schema = "event_id BIGINT, timestamp STRING, event_type STRING, value DOUBLE, props STRING"
    return events.select(line).select(F.from_json("line", schema).alias("r")).select("r.*")


@query(
    "NST-3_json_path",
    """SELECT event_id, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k,
              json_extract_string(props, '$.k') AS k_text FROM events""",
)
def json_path(spark: SparkSession, folder: str) -> DataFrame:
    return _events(spark, folder).select(
        "event_id",
        F.from_json("props", "k BIGINT")["k"].alias("k"),
        F.get_json_object("props", "$.k").alias("k_text"),
    )


@query(
    "NST-4_inline",
    f"""{si.TO_LEVEL3} SELECT window_start, district, total_meters,
        energy_units / 1e4 AS total_energy_kwh FROM l3""",
)
def inline(spark: SparkSession, folder: str) -> DataFrame:
    return rollup.unnest_children(nested_recap(spark, folder))

"""Projections and filters: PRJ-1..6, FIL-1..7, SET-1."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from meterfold import model
from meterfold.functions import bands, load, text
from meterfold.operators import lookup, rollup
from meterfold.plans import standins as si
from meterfold.plans.inputs import level_messages, purchases_copy
from meterfold.plans.registry import query
from meterfold.sources import history, messages, tables


@query("PRJ-1_columns", "SELECT o_orderstatus, o_totalprice, o_orderkey FROM orders")
def columns(spark: SparkSession, folder: str) -> DataFrame:
    return tables.load(spark, folder, "orders").select("o_orderstatus", "o_totalprice", "o_orderkey")


@query("PRJ-2_cast", "SELECT o_orderkey AS id, o_totalprice AS spent FROM orders")
def cast(spark: SparkSession, folder: str) -> DataFrame:
    return purchases_copy(spark, folder).select(
        F.col("id").cast("bigint").alias("id"), F.col("spent").try_cast("double").alias("spent")
    )


@query(
    "PRJ-3_tags",
    f"""{si.TO_LEVEL3} SELECT 'district' AS kind, 15 AS window_duration_min, district, window_start,
        total_meters FROM l3""",
)
def tags(spark: SparkSession, folder: str) -> DataFrame:
    l3 = rollup.finish(si.level3(spark, folder)).withColumn("kind", F.lit("district"))
    return l3.select("kind", "window_duration_min", "district", "window_start", "total_meters")


@query(
    "PRJ-4_drop_column",
    f"""{si.TO_LEVEL4} SELECT window_start, districts_reported, total_meters, min_voltage,
        max_voltage, anomalies_count FROM l4""",
)
def drop_column(spark: SparkSession, folder: str) -> DataFrame:
    inner = [name for name in rollup.STATE if name.endswith(("_units", "_count")) and name != "anomalies_count"]
    return si.level4(spark, folder).drop(*inner)


PLACES_SQL = """places AS (
    SELECT n_name AS district, 35.0 + n_nationkey / 100e0 AS latitude,
           -5.0 - n_nationkey / 100e0 AS longitude
    FROM nation WHERE n_regionkey <> 0)"""


def places(spark: SparkSession, folder: str) -> DataFrame:
    """Coordinates of the districts outside the first region."""
    number = F.col("n_nationkey") / F.lit(100.0)
    return (
        tables.load(spark, folder, "nation")
        .where(F.col("n_regionkey") != 0)
        .select(
            F.col("n_name").alias("district"),
            (F.lit(35.0) + number).alias("latitude"),
            (F.lit(-5.0) - number).alias("longitude"),
        )
    )


@query(
    "PRJ-5_widen",
    f"""{si.TO_LEVEL3}, {PLACES_SQL}
        SELECT district, window_start, total_meters, anomalies_count, latitude, longitude
        FROM l3 LEFT JOIN places USING (district)""",
)
def widen(spark: SparkSession, folder: str) -> DataFrame:
    l3 = si.level3(spark, folder).select("district", "window_start", "total_meters", "anomalies_count")
    return lookup.look_up(l3, places(spark, folder), ["district"], {})


@query(
    "PRJ-6_derived",
    """SELECT event_id, value * 4000e0 AS power_w, value * 4000e0 / greatest(value, 1e0) AS current_a
       FROM events""",
)
def derived(spark: SparkSession, folder: str) -> DataFrame:
    value = F.col("value")
    return tables.load(spark, folder, "events").select(
        "event_id",
        load.mean_power(value).alias("power_w"),
        load.mean_current(value, value).alias("current_a"),
    )


@query(
    "FIL-1_equality",
    "SELECT o_orderkey, o_totalprice FROM orders WHERE o_orderstatus = 'F'",
)
def equality(spark: SparkSession, folder: str) -> DataFrame:
    orders = tables.load(spark, folder, "orders")
    return orders.where(F.col("o_orderstatus") == "F").select("o_orderkey", "o_totalprice")


@query("FIL-2_out_of_band", "SELECT event_id, value FROM events WHERE value < 2 OR value > 190")
def out_of_band(spark: SparkSession, folder: str) -> DataFrame:
    events = tables.load(spark, folder, "events")
    return events.where(bands.out_of_band(F.col("value"), si.BAND)).select("event_id", "value")


@query(
    "FIL-3_threshold",
    f"""{si.daily(si.TO_LEVEL3)} SELECT district, window_start, anomalies_count, min_voltage
        FROM l3 WHERE anomalies_count > 1""",
)
def threshold(spark: SparkSession, folder: str) -> DataFrame:
    l3 = si.level3(spark, folder, minutes=24 * 60)
    return l3.where(F.col("anomalies_count") > 1).select(
        "district", "window_start", "anomalies_count", "min_voltage"
    )


@query(
    "FIL-4_demux",
    f"""{si.TO_LEVEL3} SELECT '{model.TOPIC_DISTRIBUTORS}' AS topic,
               CAST(distributor_id AS VARCHAR) AS key, window_start, total_meters
        FROM l2 JOIN hierarchy USING (distributor_id)
        UNION ALL SELECT '{model.TOPIC_CONCENTRATORS}', CAST(concentrator_id AS VARCHAR),
               window_start, total_meters FROM l3""",
)
def demux(spark: SparkSession, folder: str) -> DataFrame:
    routes = level_messages(
        spark, folder, (model.TOPIC_DISTRIBUTORS, model.TOPIC_CONCENTRATORS)
    )
    sent = messages.message_frame(routes)
    shown = None
    for topic, schema in (
        (model.TOPIC_DISTRIBUTORS, model.DISTRIBUTOR_SCHEMA),
        (model.TOPIC_CONCENTRATORS, model.CONCENTRATOR_SCHEMA),
    ):
        part = messages.of_topic(sent, topic, schema).select(
            F.lit(topic).alias("topic"),
            F.col("message_key").alias("key"),
            text.parse_iso(F.col("window_start")).alias("window_start"),
            "total_meters",
        )
        shown = part if shown is None else shown.unionByName(part)
    return shown


@query(
    "FIL-5_fallbacks",
    """SELECT event_id, coalesce(nullif(event_type, 'error'), props, '?') AS label,
              coalesce(nullif(value, 0e0), 230e0) AS level FROM events""",
)
def fallbacks(spark: SparkSession, folder: str) -> DataFrame:
    events = tables.load(spark, folder, "events")
    kind = F.nullif(F.col("event_type"), F.lit("error"))
    value = F.nullif(F.col("value"), F.lit(0.0))
    return events.select(
        "event_id",
        bands.first_present(kind, "props", default="?").alias("label"),
        bands.first_present(value, default=230.0).alias("level"),
    )


@query(
    "FIL-6_severity",
    f"""{si.daily(si.TO_LEVEL4)}
        SELECT 'district' AS level, district, window_start,
               CASE WHEN anomalies_count > 5 THEN 'crit' WHEN anomalies_count > 0 THEN 'warn'
                    ELSE 'ok' END AS severity,
               CASE WHEN min_voltage < 2 THEN 'low' WHEN min_voltage < 10 THEN 'warn'
                    ELSE 'ok' END AS low_level FROM l3
        UNION ALL
        SELECT 'cycle', NULL, window_start,
               CASE WHEN anomalies_count > 50 THEN 'crit' WHEN anomalies_count > 0 THEN 'warn'
                    ELSE 'ok' END,
               CASE WHEN min_voltage < 2 THEN 'low' WHEN min_voltage < 10 THEN 'warn'
                    ELSE 'ok' END FROM l4""",
)
def severity(spark: SparkSession, folder: str) -> DataFrame:
    l3 = si.level3_table(spark, folder, minutes=24 * 60)
    minimum = bands.low_level(F.col("min_voltage"), 2.0, 10.0).alias("low_level")

    def banded(rows: DataFrame, level: str, district, critical: int) -> DataFrame:
        marked = bands.severity(F.col("anomalies_count"), critical).alias("severity")
        return rows.select(
            F.lit(level).alias("level"), district.alias("district"), "window_start", marked, minimum
        )

    return banded(l3, "district", F.col("district"), 5).unionByName(
        banded(rollup.recap(l3), "cycle", F.lit(None).cast("string"), 50)
    )


@query(
    "FIL-7_band_side",
    """SELECT event_id, value, CASE WHEN value < 2 THEN 'under' ELSE 'over' END AS side
       FROM events WHERE value < 2 OR value > 190""",
)
def band_side(spark: SparkSession, folder: str) -> DataFrame:
    value = F.col("value")
    found = tables.load(spark, folder, "events").where(bands.out_of_band(value, si.BAND))
    return found.select("event_id", "value", bands.band_side(value, si.BAND).alias("side"))


@query(
    "SET-1_tagged_union",
    f"""{si.TO_LEVEL4}, {si.CYCLES_SQL}
        SELECT 'district' AS kind, window_start, district, CAST(NULL AS BIGINT) AS cycle_id,
               total_meters FROM l3
        UNION ALL SELECT 'cycle', window_start, NULL, cycle_id, total_meters FROM cycles""",
)
def tagged_union(spark: SparkSession, folder: str) -> DataFrame:
    l3 = si.level3_table(spark, folder)
    both = history.history_rows(rollup.finish(l3), rollup.cycles(rollup.recap(l3)))
    return both.select("kind", "window_start", "district", "cycle_id", "total_meters")

"""How the given tables play the parts of the metering model.

An event is a reading, its user the distributor, the user's nation the
concentrator and district, the region the zone. ``value`` serves as energy and
as voltage, with an accepted band that leaves about 6 % of the rows outside.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from meterfold import scratch
from meterfold.functions import load
from meterfold.model import Band
from meterfold.operators import rollup
from meterfold.sources import tables

BAND = Band(low=2.0, high=190.0, nominal=35.0)
PARENT_KEYS = ("concentrator_id", "district", "zone_type")
EVENT_TYPES = ("click", "error", "purchase", "signup", "view")


def as_readings(events: DataFrame) -> DataFrame:
    value = F.col("value")
    return events.select(
        F.col("event_id").alias("meter_id"),
        F.col("user_id").alias("distributor_id"),
        F.col("ts").alias("timestamp"),
        value.alias("energy_consumption"),
        value.alias("voltage"),
        load.mean_current(value, value).alias("current"),
    )


def readings(spark: SparkSession, folder: str) -> DataFrame:
    return as_readings(tables.load(spark, folder, "events"))


def districts(spark: SparkSession, folder: str) -> DataFrame:
    nation = tables.load(spark, folder, "nation")
    region = tables.load(spark, folder, "region")
    return nation.join(region, nation.n_regionkey == region.r_regionkey).select(
        F.col("n_nationkey").alias("concentrator_id"),
        F.col("n_name").alias("district"),
        F.col("r_name").alias("zone_type"),
    )


def hierarchy(spark: SparkSession, folder: str) -> DataFrame:
    """Distributors with their parents.

    The hint is on the districts, a row for each nation: by its estimates Spark would broadcast
    the customers, as it multiplies the sizes of nations and regions.
    """
    customer = tables.load(spark, folder, "customer").select(
        F.col("c_custkey").alias("distributor_id"), F.col("c_nationkey").alias("concentrator_id")
    )
    return customer.join(F.broadcast(districts(spark, folder)), "concentrator_id")


def level2(spark: SparkSession, folder: str, **options) -> DataFrame:
    return rollup.by_distributor(readings(spark, folder), band=BAND, **options)


def level3(spark: SparkSession, folder: str, **options) -> DataFrame:
    placed = rollup.with_parents(level2(spark, folder, **options), hierarchy(spark, folder))
    return rollup.by_parent(placed, PARENT_KEYS)


def level3_table(spark: SparkSession, folder: str, **options) -> DataFrame:
    """Level 3 written once, for queries that read it more than once."""
    return scratch.stored(level3(spark, folder, **options), "level3")


def level4(spark: SparkSession, folder: str) -> DataFrame:
    return rollup.recap(level3(spark, folder))


# --- the same in SQL --------------------------------------------------------


def fx(expression: str, digits: int) -> str:
    """A measure in units of its last decimal."""
    return f"CAST(floor({expression} * 1e{digits} + 0.5) AS BIGINT)"


def fsum(expression: str, digits: int) -> str:
    """Order-independent sum of a measure."""
    return f"(CAST(sum({fx(expression, digits)}) AS BIGINT) / 1e{digits})"


READINGS_SQL = """readings AS (
    SELECT event_id AS meter_id, user_id AS distributor_id, ts AS "timestamp",
           value AS energy_consumption, value AS voltage,
           value * 4000e0 / greatest(value, 1e0) AS current
    FROM events)"""

HIERARCHY_SQL = """hierarchy AS (
    SELECT c_custkey AS distributor_id, n_nationkey AS concentrator_id,
           n_name AS district, r_name AS zone_type
    FROM customer JOIN nation ON c_nationkey = n_nationkey
    JOIN region ON n_regionkey = r_regionkey)"""

_UNITS_SQL = """CAST(sum(total_meters) AS BIGINT) AS total_meters,
           CAST(sum(energy_units) AS BIGINT) AS energy_units,
           CAST(sum(voltage_units) AS BIGINT) AS voltage_units,
           CAST(sum(current_units) AS BIGINT) AS current_units,
           min(min_voltage) AS min_voltage, max(max_voltage) AS max_voltage,
           CAST(sum(anomalies_count) AS BIGINT) AS anomalies_count"""


def level2_sql(bucket: str = "time_bucket(INTERVAL '15 minutes', \"timestamp\")") -> str:
    return f"""l2 AS (
    SELECT distributor_id, {bucket} AS window_start, count(*) AS total_meters,
           CAST(sum({fx('energy_consumption', 4)}) AS BIGINT) AS energy_units,
           CAST(sum({fx('voltage', 2)}) AS BIGINT) AS voltage_units,
           CAST(sum({fx('current', 3)}) AS BIGINT) AS current_units,
           min(voltage) AS min_voltage, max(voltage) AS max_voltage,
           count(*) FILTER (WHERE voltage < 2 OR voltage > 190) AS anomalies_count
    FROM readings GROUP BY 1, 2)"""


LEVEL3_SQL = f"""l3 AS (
    SELECT concentrator_id, district, zone_type, window_start,
           count(*) AS total_distributors, {_UNITS_SQL}
    FROM l2 JOIN hierarchy USING (distributor_id) GROUP BY 1, 2, 3, 4)"""

LEVEL4_SQL = f"""l4 AS (
    SELECT window_start, count(*) AS districts_reported, {_UNITS_SQL}
    FROM l3 GROUP BY 1)"""

TO_LEVEL2 = f"WITH {READINGS_SQL}, {level2_sql()}"
TO_LEVEL3 = f"{TO_LEVEL2}, {HIERARCHY_SQL}, {LEVEL3_SQL}"
TO_LEVEL4 = f"{TO_LEVEL3}, {LEVEL4_SQL}"


def daily(sql: str) -> str:
    """The same levels over one-day windows."""
    return sql.replace("INTERVAL '15 minutes'", "INTERVAL '1 day'")


def record_sql(*keys: str, minutes: int = 15) -> str:
    """Select list of a finished record."""
    listed = "".join(f"{k}, " for k in keys)
    return f"""{listed}window_start,
        window_start + INTERVAL '{minutes} minutes' AS window_end,
        {minutes} AS window_duration_min, total_meters,
        energy_units / 1e4 AS total_energy_kwh,
        voltage_units / 1e2 / total_meters AS avg_voltage,
        current_units / 1e3 / total_meters AS avg_current,
        min_voltage, max_voltage, anomalies_count"""


# All windows numbered from 1, and the recap as it is logged.
CYCLES_SQL = """cycles AS (
    SELECT row_number() OVER (ORDER BY window_start) AS cycle_id,
           window_start AS cycle_start,
           window_start + INTERVAL '17 minutes' AS cycle_end,
           window_start, window_start + INTERVAL '15 minutes' AS window_end,
           15 AS window_duration_min, districts_reported, total_meters,
           energy_units / 1e4 AS total_energy_kwh, anomalies_count
    FROM l4)"""

# Total energy per window.
SERIES_SQL = f"""series AS (
    SELECT time_bucket(INTERVAL '15 minutes', ts) AS window_start,
           {fsum('value', 4)} AS energy
    FROM events GROUP BY 1)"""

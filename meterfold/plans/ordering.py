"""Sorts, limits, top-N, samples: ORD-1..7."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from meterfold.functions import fixed
from meterfold.operators import reports, sampling
from meterfold.plans import standins as si
from meterfold.plans.aggregations import energy_series
from meterfold.plans.registry import query
from meterfold.sources import tables

_SUPPLIER_SQL = f"""loads AS (
    SELECT l_suppkey, {si.fsum('l_extendedprice', 2)} AS energy, count(*) AS lines
    FROM lineitem GROUP BY 1)"""


def supplier_loads(spark: SparkSession, folder: str) -> DataFrame:
    lines = tables.load(spark, folder, "lineitem")
    return lines.groupBy("l_suppkey").agg(
        fixed.fixed_sum("l_extendedprice", 2).alias("energy"), F.count(F.lit(1)).alias("lines")
    )


@query("ORD-1_sort_descending", f"WITH {_SUPPLIER_SQL} SELECT * FROM loads ORDER BY energy DESC")
def sort_descending(spark: SparkSession, folder: str) -> DataFrame:
    return supplier_loads(spark, folder).orderBy(F.desc("energy"), "l_suppkey")


@query("ORD-2_sort_ascending", f"WITH {si.SERIES_SQL} SELECT * FROM series ORDER BY window_start")
def sort_ascending(spark: SparkSession, folder: str) -> DataFrame:
    return energy_series(spark, folder).orderBy("window_start")


@query(
    "ORD-3_top_n",
    f"""WITH {_SUPPLIER_SQL} SELECT row_number() OVER (ORDER BY energy DESC, l_suppkey) AS rank,
               l_suppkey, s_name, s_nationkey, energy, lines
        FROM loads JOIN supplier ON l_suppkey = s_suppkey ORDER BY 1 LIMIT 10""",
)
def top_n(spark: SparkSession, folder: str) -> DataFrame:
    """The winners are found first; only they are joined to their context."""
    best = reports.top_n(supplier_loads(spark, folder), "energy", 10, "l_suppkey")
    supplier = tables.load(spark, folder, "supplier")
    return best.join(supplier, best.l_suppkey == supplier.s_suppkey).select(
        "rank", "l_suppkey", "s_name", "s_nationkey", "energy", "lines"
    )


@query(
    "ORD-4_top_outliers",
    """WITH found AS (SELECT event_id, user_id, value, abs(value - 35e0) AS distance,
                             CASE WHEN value < 2 THEN 'under' ELSE 'over' END AS side,
                             count(*) OVER () AS detected
                      FROM events WHERE value < 2 OR value > 190)
       SELECT *, row_number() OVER (ORDER BY distance DESC, event_id) AS rank
       FROM found ORDER BY rank LIMIT 10""",
)
def top_outliers(spark: SparkSession, folder: str) -> DataFrame:
    events = tables.load(spark, folder, "events").select("event_id", "user_id", "value")
    return reports.top_outliers(events, "value", 10, "event_id", si.BAND)


@query(
    "ORD-5_top_with_required",
    f"""WITH {_SUPPLIER_SQL}, placed AS (
            SELECT l_suppkey, s_nationkey, energy, row_number() OVER (
                ORDER BY energy DESC, l_suppkey) AS rank
            FROM loads JOIN supplier ON l_suppkey = s_suppkey),
        best AS (SELECT * FROM placed WHERE rank <= 5),
        extra AS (SELECT l_suppkey, s_nationkey, energy, 6 AS rank FROM placed
            WHERE s_nationkey = 3 AND NOT EXISTS (SELECT 1 FROM best WHERE s_nationkey = 3)
            ORDER BY placed.rank LIMIT 1)
        SELECT * FROM best UNION ALL SELECT * FROM extra""",
)
def top_with_required(spark: SparkSession, folder: str) -> DataFrame:
    supplier = tables.load(spark, folder, "supplier")
    loads = supplier_loads(spark, folder)
    placed = loads.join(supplier, loads.l_suppkey == supplier.s_suppkey).select(
        "l_suppkey", "s_nationkey", "energy"
    )
    return reports.top_with_required(placed, "energy", "l_suppkey", "s_nationkey", 3)


@query("ORD-6_preview", "SELECT * FROM orders ORDER BY o_orderkey LIMIT 5")
def preview(spark: SparkSession, folder: str) -> DataFrame:
    return sampling.preview(tables.load(spark, folder, "orders"), 5, "o_orderkey")


@query(
    "ORD-7_sample",
    "SELECT vec_id, label FROM embeddings ORDER BY md5('42-' || vec_id), vec_id LIMIT 20",
)
def sample(spark: SparkSession, folder: str) -> DataFrame:
    vectors = tables.load(spark, folder, "embeddings").select("vec_id", "label")
    return sampling.sample_rows(vectors, 20, 42, "vec_id")

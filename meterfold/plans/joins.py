"""Joins: JOI-1..6."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from meterfold import model
from meterfold.functions import fixed
from meterfold.operators import hierarchy, kmeans, lookup, reports, rollup, series
from meterfold.plans import standins as si
from meterfold.plans.projections import PLACES_SQL, places
from meterfold.plans.registry import query
from meterfold.sources import tables


@query(
    "JOI-1_lookup_default",
    f"""WITH {PLACES_SQL}
        SELECT c_custkey, n_name AS district, coalesce(latitude, 35.575e0) AS latitude,
               coalesce(longitude, -5.365e0) AS longitude
        FROM customer JOIN nation ON c_nationkey = n_nationkey
        LEFT JOIN places ON n_name = district""",
)
def lookup_default(spark: SparkSession, folder: str) -> DataFrame:
    customer = tables.load(spark, folder, "customer")
    nation = tables.load(spark, folder, "nation")
    named = customer.join(nation, customer.c_nationkey == nation.n_nationkey).select(
        "c_custkey", F.col("n_name").alias("district")
    )
    defaults = {"latitude": model.DEFAULT_LATITUDE, "longitude": model.DEFAULT_LONGITUDE}
    return lookup.look_up(named, places(spark, folder), ["district"], defaults)


@query(
    "JOI-2_parent_readings",
    f"""SELECT c_custkey, c_name, count(*) AS readings, {si.fsum('value', 4)} AS energy
        FROM customer JOIN events ON c_custkey = user_id GROUP BY 1, 2""",
)
def parent_readings(spark: SparkSession, folder: str) -> DataFrame:
    """Readings are added up per parent before the parent's columns are joined."""
    events = tables.load(spark, folder, "events")
    summed = events.groupBy(F.col("user_id").alias("c_custkey")).agg(
        F.count(F.lit(1)).alias("readings"),
        fixed.fixed_sum("value", model.ENERGY_DIGITS).alias("energy"),
    )
    customer = tables.load(spark, folder, "customer").select("c_custkey", "c_name")
    return customer.join(summed, "c_custkey").select("c_custkey", "c_name", "readings", "energy")


@query(
    "JOI-3_resolve_parent",
    f"""{si.TO_LEVEL2}, {si.HIERARCHY_SQL}
        SELECT distributor_id, concentrator_id, district, zone_type, window_start, total_meters
        FROM l2 JOIN hierarchy USING (distributor_id)""",
)
def resolve_parent(spark: SparkSession, folder: str) -> DataFrame:
    placed = rollup.with_parents(si.level2(spark, folder), si.hierarchy(spark, folder))
    return placed.select(
        "distributor_id", "concentrator_id", "district", "zone_type", "window_start", "total_meters"
    )


@query(
    "JOI-3_deep_hierarchy",
    """WITH RECURSIVE links AS (
           SELECT c_custkey AS child, c_custkey - (c_custkey % 7 + 1) AS parent FROM customer),
       walk AS (
           SELECT child, parent AS root, 1::BIGINT AS depth FROM links
           WHERE parent NOT IN (SELECT child FROM links)
           UNION ALL
           SELECT l.child, w.root, w.depth + 1 FROM walk w JOIN links l ON l.parent = w.child)
       SELECT child, root, depth FROM walk""",
)
def deep_hierarchy(spark: SparkSession, folder: str) -> DataFrame:
    """Every customer hangs on one a few numbers before it: chains as long as the table."""
    customer = tables.load(spark, folder, "customer")
    above = F.col("c_custkey") - (F.col("c_custkey") % 7 + 1)
    return hierarchy.roots(customer.select(F.col("c_custkey").alias("child"), above.alias("parent")))


@query(
    "JOI-4_parents_with_readings",
    "SELECT c_custkey, c_name FROM customer WHERE c_custkey IN (SELECT user_id FROM events)",
)
def parents_with_readings(spark: SparkSession, folder: str) -> DataFrame:
    customer = tables.load(spark, folder, "customer").select("c_custkey", "c_name")
    readings = tables.load(spark, folder, "events").select(F.col("user_id").alias("c_custkey"))
    return lookup.parents_with_readings(customer, readings, "c_custkey")


@query(
    "JOI-5_dense_grid",
    f"""{si.TO_LEVEL3},
        latest AS (SELECT * FROM l3 QUALIFY row_number() OVER (
            PARTITION BY district ORDER BY window_start DESC) = 1),
        ranked AS (SELECT district, zone_type, row_number() OVER (
            ORDER BY energy_units DESC, district) AS rank FROM latest),
        best AS (SELECT district, zone_type FROM ranked WHERE rank <= 5),
        extra AS (SELECT district, zone_type FROM ranked WHERE zone_type = 'EUROPE'
            AND NOT EXISTS (SELECT 1 FROM best WHERE zone_type = 'EUROPE') ORDER BY rank LIMIT 1),
        selected AS (SELECT district FROM best UNION ALL SELECT district FROM extra),
        steps AS (SELECT DISTINCT window_start FROM l3 ORDER BY 1 DESC LIMIT 10)
        SELECT district, window_start, coalesce(energy_units, 0) / 1e4 AS total_energy_kwh
        FROM selected CROSS JOIN steps LEFT JOIN l3 USING (district, window_start)""",
)
def dense_grid(spark: SparkSession, folder: str) -> DataFrame:
    l3 = rollup.finish(si.level3_table(spark, folder)).select(
        "district", "zone_type", "window_start", "total_energy_kwh"
    )
    latest = series.latest_per_key(l3, ["district"], ["window_start"])
    selected = reports.top_with_required(
        latest, "total_energy_kwh", "district", "zone_type", "EUROPE"
    )
    steps = series.last_windows(l3, "window_start", 10)
    return lookup.dense_grid(
        selected, steps, l3, ["district"], "window_start", "total_energy_kwh"
    )


NEAREST_SQL = """start AS (
    SELECT row_number() OVER (ORDER BY md5('42-' || vec_id), vec_id) - 1 AS cluster, embedding AS c
    FROM embeddings ORDER BY md5('42-' || vec_id), vec_id LIMIT 5),
  distances AS (
    SELECT vec_id, cluster, sqrt(list_sum(list_transform(range(1, len(embedding) + 1),
           lambda i: (CAST(embedding[i] AS DOUBLE) - CAST(c[i] AS DOUBLE)) ** 2))) AS distance
    FROM embeddings CROSS JOIN start),
  assigned AS (
    SELECT vec_id, CAST(arg_min(cluster, (distance, cluster)) AS INTEGER) AS cluster
    FROM distances GROUP BY vec_id)"""


def assigned(spark: SparkSession, folder: str) -> DataFrame:
    """Vectors with their nearest of five sampled start centroids."""
    points = tables.load(spark, folder, "embeddings")
    start = kmeans.start_centroids(points, 5, "vec_id", "embedding")
    return kmeans.assign(points, start, "embedding")


@query("JOI-6_nearest_centroid", f"WITH {NEAREST_SQL} SELECT vec_id, cluster FROM assigned")
def nearest_centroid(spark: SparkSession, folder: str) -> DataFrame:
    return assigned(spark, folder).select("vec_id", "cluster")

"""k-means steps: KMN-1..6."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from meterfold.operators import kmeans, sampling
from meterfold.plans.registry import query
from meterfold.sources import tables

K = 5
SEED = 42
ROUNDS = 20
TOLERANCE = 1e-4


def _points(spark: SparkSession, folder: str) -> DataFrame:
    return tables.load(spark, folder, "embeddings")


def _first_points(points: DataFrame, k: int = K) -> list[list[float]]:
    rows = points.orderBy("vec_id").limit(k).collect()
    return [[float(x) for x in r["embedding"]] for r in rows]


_POINTS_SQL = "points AS MATERIALIZED (SELECT vec_id, CAST(embedding AS DOUBLE[]) AS p FROM embeddings)"
_FIRST_SQL = f"""c0 AS MATERIALIZED (
    SELECT row_number() OVER (ORDER BY vec_id) - 1 AS cluster, p AS c, 0 AS rounds, false AS done
    FROM points ORDER BY vec_id LIMIT {K})"""


def _assign_sql(name: str, centroids: str) -> str:
    return f"""{name} AS MATERIALIZED (
    SELECT vec_id, any_value(p) AS p, arg_min(cluster, (list_distance(p, c), cluster)) AS cluster
    FROM points CROSS JOIN {centroids} GROUP BY vec_id)"""


def _means_sql(name: str, assigned: str) -> str:
    return f"""{name} AS MATERIALIZED (
    SELECT cluster, list(mean ORDER BY pos) AS m FROM (
        SELECT cluster, pos, avg(x) AS mean FROM (
            SELECT cluster, unnest(p) AS x, unnest(range(len(p))) AS pos FROM {assigned})
        GROUP BY cluster, pos) GROUP BY cluster)"""


def _fit_sql() -> str:
    """All rounds written out; a round after the last one changes nothing."""
    parts = [_POINTS_SQL, _FIRST_SQL]
    for r in range(1, ROUNDS + 1):
        before = f"c{r - 1}"
        parts.append(_assign_sql(f"a{r}", before))
        parts.append(_means_sql(f"m{r}", f"a{r}"))
        parts.append(f"""n{r} AS MATERIALIZED (
    SELECT c.cluster, c.c AS old, coalesce(m.m, c.c) AS new, rounds, done
    FROM {before} c LEFT JOIN m{r} m USING (cluster))""")
        parts.append(f"""c{r} AS MATERIALIZED (
    SELECT cluster, CASE WHEN done THEN old ELSE new END AS c,
           CASE WHEN done THEN rounds ELSE rounds + 1 END AS rounds,
           done OR (SELECT sum(list_distance(old, new)) FROM n{r}) < {TOLERANCE} AS done
    FROM n{r})""")
    parts.append(_assign_sql("final", f"c{ROUNDS}"))
    return "WITH " + ", ".join(parts)


@query(
    "KMN-1_start",
    """SELECT vec_id, round(CAST(embedding[1] AS DOUBLE), 6) AS first FROM embeddings
       ORDER BY md5('42-' || vec_id), vec_id LIMIT 5""",
)
def start(spark: SparkSession, folder: str) -> DataFrame:
    drawn = sampling.sample_rows(_points(spark, folder).select("vec_id", "embedding"), K, SEED, "vec_id")
    first = F.round(F.col("embedding")[0].cast("double"), 6)
    return drawn.select("vec_id", first.alias("first"))


@query(
    "KMN-2_assign",
    f"WITH {_POINTS_SQL}, {_FIRST_SQL}, {_assign_sql('a1', 'c0')} "
    "SELECT vec_id, CAST(cluster AS INTEGER) AS cluster FROM a1",
)
def assign(spark: SparkSession, folder: str) -> DataFrame:
    points = _points(spark, folder)
    return kmeans.assign(points, _first_points(points), "embedding").select("vec_id", "cluster")


@query(
    "KMN-3_move",
    f"WITH {_POINTS_SQL}, {_FIRST_SQL}, {_assign_sql('a1', 'c0')}, {_means_sql('m1', 'a1')} "
    """SELECT CAST(cluster AS INTEGER) AS cluster, CAST(pos AS INTEGER) AS pos, round(x, 6) AS mean
       FROM (SELECT cluster, unnest(m) AS x, unnest(range(len(m))) AS pos FROM m1)""",
)
def move(spark: SparkSession, folder: str) -> DataFrame:
    points = _points(spark, folder)
    held = kmeans.assign(points, _first_points(points), "embedding")
    means = kmeans.group_means(held, "cluster", "embedding")
    return means.select("cluster", "pos", F.round("mean", 6).alias("mean"))


_FAR_SQL = f"""c0 AS MATERIALIZED (
    SELECT row_number() OVER (ORDER BY vec_id) - 1 AS cluster, p AS c FROM points
    ORDER BY vec_id LIMIT {K}),
  far AS MATERIALIZED (
    SELECT cluster, c FROM c0
    UNION ALL SELECT {K}, list_transform(c, lambda x: 1e3::DOUBLE) FROM c0 WHERE cluster = 0)"""


@query(
    "KMN-4_empty_cluster",
    f"WITH {_POINTS_SQL}, {_FAR_SQL}, {_assign_sql('a1', 'far')}, {_means_sql('m1', 'a1')} "
    """SELECT CAST(cluster AS INTEGER) AS cluster, CAST(pos AS INTEGER) AS pos, round(x, 6) AS "new"
       FROM (SELECT far.cluster, unnest(coalesce(m, c)) AS x, unnest(range(len(c))) AS pos
             FROM far LEFT JOIN m1 ON far.cluster = m1.cluster)""",
)
def empty_cluster(spark: SparkSession, folder: str) -> DataFrame:
    points = _points(spark, folder)
    centroids = _first_points(points)
    centroids.append([1000.0] * len(centroids[0]))
    held = kmeans.assign(points, centroids, "embedding")
    moved = kmeans.moved_centroids(held, centroids, "embedding")
    return moved.select("cluster", "pos", F.round("new", 6).alias("new"))


def _fitted(spark: SparkSession, folder: str) -> tuple[kmeans.KMeansResult, DataFrame]:
    points = _points(spark, folder)
    result = kmeans.fit(points, "embedding", _first_points(points), ROUNDS, TOLERANCE)
    return result, kmeans.assign(points, result.centroids, "embedding")


@query(
    "KMN-5_fit",
    f"""{_fit_sql()} SELECT vec_id, CAST(final.cluster AS INTEGER) AS cluster,
        CAST((SELECT max(rounds) FROM c{ROUNDS}) AS INTEGER) AS rounds FROM final""",
)
def fit(spark: SparkSession, folder: str) -> DataFrame:
    result, held = _fitted(spark, folder)
    return held.select("vec_id", "cluster", F.lit(result.rounds).alias("rounds"))


@query(
    "KMN-5_bounded_fit",
    f"""{_fit_sql()} SELECT vec_id, CAST(final.cluster AS INTEGER) AS cluster,
        CAST((SELECT max(rounds) FROM c{ROUNDS}) AS INTEGER) AS rounds FROM final""",
)
def bounded_fit(spark: SparkSession, folder: str) -> DataFrame:
    points = _points(spark, folder)
    result = kmeans.fit_bounded(points, "embedding", _first_points(points), ROUNDS, TOLERANCE)
    held = kmeans.assign(points, result.centroids, "embedding")
    return held.select("vec_id", "cluster", F.lit(result.rounds).alias("rounds"))


@query(
    "KMN-6_sizes",
    f"""{_fit_sql()} SELECT CAST(cluster AS INTEGER) AS cluster, count(*) AS points
        FROM final GROUP BY 1""",
)
def sizes(spark: SparkSession, folder: str) -> DataFrame:
    return kmeans.cluster_sizes(_fitted(spark, folder)[1])

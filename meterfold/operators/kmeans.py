"""k-means on a column of vectors.

The driver holds k x d numbers and nothing else. One round is one scan: tasks
find the nearest centroids of an Arrow batch of vectors and add the vectors up,
so k x d partial sums per batch are all that leaves them, however many points a
cluster has. Sums are kept as whole numbers, a whole part and a fraction, which makes
centroids, rounds and the stop the same for every partitioning. :func:`fit_bounded` keeps
bounds between rounds and looks only at the points that may have changed cluster.
"""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import StorageLevel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from meterfold import scratch
from meterfold.functions import vectors
from meterfold.operators import sampling

Centroids = Sequence[Sequence[float]]

#: Fractions are counted in this many parts; 2^-40 is far below what vectors hold.
_FRACTION = 2.0**40
#: Whole parts of a batch add up safely below this.
_LARGEST = 2.0**46


@dataclass(frozen=True)
class KMeansResult:
    """Final centroids and how they were reached."""

    centroids: list[list[float]]
    rounds: int
    shift: float
    converged: bool
    #: Share of the distances (points x centroids x rounds) that bounds made needless.
    skipped: float = 0.0


def start_centroids(
    points: DataFrame, k: int, row_id: str, vector: str, seed: int = 42
) -> list[list[float]]:
    """``k`` sampled points."""
    rows = sampling.sample_rows(points.select(row_id, vector), k, seed, row_id).collect()
    return [[float(x) for x in row[vector]] for row in rows]


def assign(
    points: DataFrame,
    centroids: Centroids,
    vector: str,
    cluster: str = "cluster",
    arrow: bool = False,
) -> DataFrame:
    """Add the index of the nearest centroid; the lowest index wins a tie.

    The distances are built-in expressions. ``arrow=True`` computes them on Arrow
    batches instead, which pays off once k x d reaches a few hundred.
    """
    if arrow:
        return points.withColumn(cluster, vectors.nearest_in_arrow(F.col(vector), centroids))
    table = vectors.centroid_table(centroids)
    point = vectors.of_length(F.col(vector).cast("array<double>"), len(centroids[0]))
    distances = F.transform(table, lambda c: vectors.euclidean(point, c))
    held = points.select("*", distances.alias("_distances"))
    return held.select(
        *points.columns, vectors.first_smallest(F.col("_distances")).alias(cluster)
    )


def group_means(
    rows: DataFrame, group: str, vector: str
) -> DataFrame:
    """Component-wise mean per group as (group, pos, mean) rows.

    Missing vectors are left out; all others of a batch must have one length.
    """
    kind = rows.schema[group].dataType.simpleString()
    chosen = rows.select(F.col(group).alias("g"), F.col(vector).cast("array<double>").alias("v"))
    return _means(chosen.mapInArrow(_group_sums, f"g {kind}, {_SUMS}"), group)


_SUMS = "pos int, n bigint, whole bigint, fraction bigint"


def _sums(found: np.ndarray, rows: np.ndarray, groups: int) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """Group, members, and the sums of whole parts and fractions of each coordinate."""
    if not (np.abs(rows) < _LARGEST).all():
        raise ValueError(f"a coordinate is not a number below {_LARGEST:g}")
    whole = np.rint(rows)
    parts = np.rint((rows - whole) * _FRACTION).astype(np.int64)
    whole = whole.astype(np.int64)
    for g in range(groups):
        own = found == g
        if own.any():
            yield g, int(own.sum()), whole[own].sum(0), parts[own].sum(0)


def _records(groups: pa.Array, sums: Iterator) -> pa.RecordBatch:
    found = list(sums)
    width = len(found[0][2]) if found else 0
    columns = [
        groups.take(pa.array(np.repeat([f[0] for f in found], width).astype(np.int64))),
        pa.array(np.tile(np.arange(width, dtype=np.int32), len(found))),
        pa.array(np.repeat(np.array([f[1] for f in found], dtype=np.int64), width)),
        *(pa.array(np.concatenate([f[i] for f in found]) if found else np.zeros(0, np.int64)) for i in (2, 3)),
    ]
    return pa.RecordBatch.from_arrays(columns, names=["g", "pos", "n", "whole", "fraction"])


def _group_sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        held = batch.column("v")
        if held.null_count < len(held):
            width = int(held.value_lengths().drop_null()[0].as_py())
            rows, present = vectors.matrix(held, width)
            coded = batch.column("g").dictionary_encode(null_encoding="encode")
            codes = coded.indices.to_numpy(zero_copy_only=False)[present]
            yield _records(coded.dictionary, _sums(codes, rows, len(coded.dictionary)))


def _cluster_sums(centroids: Centroids):
    table = np.array(centroids, dtype=np.float64)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows, _ = vectors.matrix(batch.column("v"), table.shape[1])
            numbers = pa.array(np.arange(len(table), dtype=np.int32))
            yield _records(numbers, _sums(vectors.nearest(rows, table), rows, len(table)))

    return run


def _means(sums: DataFrame, group: str) -> DataFrame:
    def total(column: str):
        return F.sum(F.col(column).cast("decimal(38,0)")).cast("double")

    mean = (total("whole") + total("fraction") / F.lit(_FRACTION)) / F.sum("n")
    return sums.groupBy(F.col("g").alias(group), "pos").agg(mean.alias("mean"))


def mean_vectors(rows: DataFrame, group: str, vector: str, into: str = "centroid") -> DataFrame:
    """Component-wise mean per group as one array of d numbers."""
    parts = group_means(rows, group, vector)
    ordered = F.array_sort(F.collect_list(F.struct("pos", "mean")))
    return parts.groupBy(group).agg(F.transform(ordered, lambda s: s["mean"]).alias(into))


def moved_centroids(
    assigned: DataFrame, centroids: Centroids, vector: str, cluster: str = "cluster"
) -> DataFrame:
    """New centroids as (cluster, pos, old, new); an empty cluster keeps its old one."""
    spark = assigned.sparkSession
    old = (
        spark.range(1)
        .select(F.posexplode(vectors.centroid_table(centroids)).alias(cluster, "_c"))
        .select(cluster, F.posexplode("_c").alias("pos", "old"))
    )
    means = group_means(assigned, cluster, vector)
    return old.join(means, [cluster, "pos"], "left").select(
        cluster, "pos", "old", F.coalesce("mean", "old").alias("new")
    )


def cluster_sizes(assigned: DataFrame, cluster: str = "cluster") -> DataFrame:
    """Points per cluster."""
    return assigned.groupBy(cluster).agg(F.count(F.lit(1)).alias("points"))


def total_shift(old: Centroids, new: Centroids) -> float:
    """Sum of the distances the centroids moved."""
    return sum(math.dist(a, b) for a, b in zip(old, new, strict=True))


def fit(
    points: DataFrame,
    vector: str,
    start: Centroids,
    max_rounds: int = 20,
    tolerance: float = 1e-4,
    storage: StorageLevel | None = None,
    arrow: bool = True,
) -> KMeansResult:
    """Repeat assign and move until the total shift is below the tolerance.

    ``storage`` keeps the vector column between rounds; without it every round
    scans the source again, which needs no executor memory or disk. With
    ``arrow=False`` the distances are built-in expressions.
    """
    if max_rounds < 1 or not start:
        raise ValueError("max_rounds and the number of start centroids must be positive")
    current = [[float(x) for x in c] for c in start]
    data = points.select(F.col(vector).cast("array<double>").alias("v"))
    if storage is not None:
        data = data.persist(storage)
    try:
        for done in range(1, max_rounds + 1):
            following = [list(c) for c in current]
            if arrow:
                sums = data.mapInArrow(_cluster_sums(current), f"g int, {_SUMS}")
                means = _means(sums, "cluster")
            else:
                means = group_means(assign(data, current, "v").where("v is not null"), "cluster", "v")
            for row in means.collect():
                following[row["cluster"]][row["pos"]] = row["mean"]
            shift = total_shift(current, following)
            current = following
            if shift < tolerance:
                return KMeansResult(current, done, shift, True)
        return KMeansResult(current, max_rounds, shift, False)
    finally:
        if storage is not None:
            data.unpersist()


_Totals = dict[tuple[int, int], tuple[int, int, int]]


def _totals(sums: DataFrame) -> _Totals:
    """Members and sums per (group, coordinate), k x d of them."""
    exact = [F.sum(F.col(c).cast("decimal(38,0)")).alias(c) for c in ("n", "whole", "fraction")]
    rows = sums.groupBy("g", "pos").agg(*exact).collect()
    return {(r["g"], r["pos"]): (int(r["n"]), int(r["whole"]), int(r["fraction"])) for r in rows}


def _placed(centroids: Centroids):
    table = np.array(centroids, dtype=np.float64)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            held = batch.column("v")
            rows, _ = vectors.matrix(held, table.shape[1])
            found, slack = vectors.nearest_with_slack(rows, table)
            yield pa.RecordBatch.from_arrays(
                [held, pa.array(found), pa.array(slack)], names=["v", "cluster", "slack"]
            )

    return run


def _changes(centroids: Centroids):
    """Sums that leave and enter clusters; the points looked at are members of group -1."""
    table = np.array(centroids, dtype=np.float64)
    k, width = table.shape
    numbers = pa.array([*range(k), -1], pa.int32())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows, _ = vectors.matrix(batch.column("v"), width)
            before = batch.column("cluster").to_numpy()
            now = vectors.nearest(rows, table)
            moved = now != before
            nothing = np.zeros(width, dtype=np.int64)
            left = ((g, -n, -w, -f) for g, n, w, f in _sums(before[moved], rows[moved], k))
            entered = _sums(now[moved], rows[moved], k)
            yield _records(numbers, [(k, len(rows), nothing, nothing), *left, *entered])

    return run


def _open_points(stock: DataFrame, anchor: Centroids, current: Centroids) -> DataFrame:
    """Points whose slack the moves since ``anchor`` may have used up.

    A point keeps its cluster while the way of its own centroid and the longest way of
    another one together stay below its slack (triangle inequality).
    """
    ways = [math.dist(a, b) for a, b in zip(anchor, current, strict=True)]
    needs = [
        (way + max((w for j, w in enumerate(ways) if j != i), default=0.0)) * (1 + 1e-9)
        for i, way in enumerate(ways)
    ]
    need = F.get(F.array(*[F.lit(x) for x in needs]), F.col("cluster"))
    return stock.where((F.col("slack") <= max(needs)) & (F.col("slack") <= need)).select("v", "cluster")


def fit_bounded(
    points: DataFrame,
    vector: str,
    start: Centroids,
    max_rounds: int = 20,
    tolerance: float = 1e-4,
) -> KMeansResult:
    """:func:`fit` in which points that cannot have changed cluster are left alone.

    A stock-taking writes every vector with its cluster and its slack, by how much the second
    nearest centroid is farther. In later rounds the slack decides, in the JVM, who is looked
    at again, and the sums of the stock are corrected by those that changed cluster. The
    stock is sorted by slack inside each file, so row groups of settled points are not read.
    Stock is taken again when most points are open though the centroids have calmed down.
    Sums are whole numbers: centroids, rounds and shift are those of :func:`fit`, bit by bit.
    """
    if max_rounds < 1 or not start:
        raise ValueError("max_rounds and the number of start centroids must be positive")
    current = [[float(x) for x in c] for c in start]
    data = points.select(F.col(vector).cast("array<double>").alias("v")).where("v is not null")
    spark = points.sparkSession
    done, looked_at, members = 0, 0, 0
    while True:
        with scratch.job(spark):
            anchor, calm = current, math.inf
            placed = data.mapInArrow(_placed(anchor), "v array<double>, cluster int, slack double")
            stock = scratch.stored(placed.sortWithinPartitions("slack"), "clusters")
            base = _totals(
                stock.select(F.col("cluster").alias("g"), "v").mapInArrow(_group_sums, f"g int, {_SUMS}")
            )
            members = looked = sum(n for (_, pos), (n, _, _) in base.items() if pos == 0)
            changed: _Totals = {}
            while True:
                following = _from_totals(current, base, changed)
                shift = total_shift(current, following)
                current, done, looked_at = following, done + 1, looked_at + looked
                if shift < tolerance or done == max_rounds:
                    share = 1 - looked_at / (members * done) if members else 0.0
                    return KMeansResult(current, done, shift, shift < tolerance, share)
                if calm == math.inf:
                    calm = shift / 2
                elif 2 * looked > members and shift < calm:
                    break
                again = _open_points(stock, anchor, current)
                changed = _totals(again.mapInArrow(_changes(current), f"g int, {_SUMS}"))
                looked = changed.get((-1, 0), (0, 0, 0))[0]


def _from_totals(current: Centroids, base: _Totals, changed: _Totals) -> list[list[float]]:
    """New centroids from the sums of the stock and the changes since; an empty one stays."""
    none = (0, 0, 0)
    moved = []
    for g, centroid in enumerate(current):
        row = []
        for pos, old in enumerate(centroid):
            sums = zip(base.get((g, pos), none), changed.get((g, pos), none), strict=True)
            n, whole, fraction = (a + b for a, b in sums)
            row.append((float(whole) + float(fraction) / _FRACTION) / n if n else old)
        moved.append(row)
    return moved


def ml_kmeans(points: DataFrame, vector: str, k: int, seed: int = 42, max_rounds: int = 20):
    """Spark ML's k-means on the same column, for use outside compared results.

    Its start and stopping rule differ from :func:`fit`.
    """
    from pyspark.ml.clustering import KMeans
    from pyspark.ml.functions import array_to_vector

    features = points.select(array_to_vector(F.col(vector).cast("array<double>")).alias("features"))
    return KMeans(k=k, seed=seed, maxIter=max_rounds).fit(features)

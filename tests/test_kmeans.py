from __future__ import annotations

import dataclasses

import numpy as np
import pytest
from pyspark import StorageLevel

from meterfold import scratch
from meterfold.operators import kmeans


def _blobs():
    rng = np.random.default_rng(7)
    centers = np.array([[2.0, 2.0], [8.0, 3.0], [5.0, 8.0]])
    return np.round(np.concatenate([c + rng.normal(0, 0.8, (100, 2)) for c in centers]), 6)


def _frame(spark, points):
    return spark.createDataFrame([(i, [float(x) for x in p]) for i, p in enumerate(points)], "id INT, p ARRAY<DOUBLE>")


def _brute(points, start, max_rounds, tolerance):
    current = np.array(start, dtype=float)
    for done in range(1, max_rounds + 1):
        nearest = np.linalg.norm(points[:, None] - current[None], axis=2).argmin(1)
        new = np.array([points[nearest == i].mean(0) if (nearest == i).any() else c for i, c in enumerate(current)])
        shift = np.linalg.norm(new - current, axis=1).sum()
        current = new
        if shift < tolerance:
            return current, done, True
    return current, max_rounds, False


@pytest.mark.parametrize("start", [[[2, 2], [8, 3], [5, 8]], [[0, 0], [0.1, 0], [0, 0.1]], [[5, 5], [5, 5], [99, 99]]])
@pytest.mark.parametrize(
    ("storage", "arrow"), [(None, False), (StorageLevel.MEMORY_AND_DISK, False), (None, True)]
)
def test_fit_matches_brute_force(spark, start, storage, arrow):
    points = _blobs()
    result = kmeans.fit(_frame(spark, points), "p", start, storage=storage, arrow=arrow)
    want, rounds, converged = _brute(points, start, 20, 1e-4)
    assert np.allclose(result.centroids, want, atol=1e-9)
    assert (result.rounds, result.converged) == (rounds, converged)
    if start[2] == [99, 99]:
        assert result.centroids[2] == [99.0, 99.0]


@pytest.mark.parametrize("start", [[[2, 2], [8, 3], [5, 8]], [[0, 0], [0.1, 0], [0, 0.1]], [[5, 5], [5, 5], [99, 99]], [[1, 1]]])
def test_bounds_change_nothing(spark, start):
    points = _frame(spark, _blobs()).unionByName(spark.createDataFrame([(-1, None)], "id INT, p ARRAY<DOUBLE>"))
    plain = kmeans.fit(points, "p", start)
    bounded = kmeans.fit_bounded(points.repartition(3), "p", start)
    assert dataclasses.replace(bounded, skipped=0.0) == plain
    assert 0.0 <= bounded.skipped < 1.0


def test_bounds_skip_settled_points(spark):
    rng = np.random.default_rng(3)
    centers = rng.normal(0, 30, (8, 6))
    points = np.concatenate([c + rng.normal(0, 2, (400, 6)) for c in centers])
    start = (points[::400] + 1.5).tolist()
    frame = _frame(spark, points)
    bounded = kmeans.fit_bounded(frame, "p", start)
    assert dataclasses.replace(bounded, skipped=0.0) == kmeans.fit(frame, "p", start)
    assert bounded.rounds >= 2 and bounded.skipped > 0.3


def test_stock_is_taken_again(spark, monkeypatch):
    taken = []
    stored = scratch.stored
    monkeypatch.setattr(kmeans.scratch, "stored", lambda rows, label: taken.append(label) or stored(rows, label))
    rng = np.random.default_rng(5)
    frame = _frame(spark, rng.normal(0, 1, (2000, 2)))
    start = [[0.01 * i, 0.0] for i in range(4)]
    bounded = kmeans.fit_bounded(frame, "p", start, max_rounds=60)
    assert dataclasses.replace(bounded, skipped=0.0) == kmeans.fit(frame, "p", start, max_rounds=60)
    assert len(taken) > 1


def test_bounded_fit_of_nothing_and_of_odd_values(spark):
    empty = spark.createDataFrame([], "p ARRAY<DOUBLE>")
    result = kmeans.fit_bounded(empty, "p", [[1.0, 2.0]])
    assert (result.centroids, result.rounds, result.skipped) == ([[1.0, 2.0]], 1, 0.0)
    bad = spark.createDataFrame([([1.0, float("nan")],)], "p ARRAY<DOUBLE>")
    with pytest.raises(Exception, match="not a number"):
        kmeans.fit_bounded(bad, "p", [[1.0, 2.0], [3.0, 4.0]])
    with pytest.raises(ValueError):
        kmeans.fit_bounded(empty, "p", [])


def test_round_limit(spark):
    points = _blobs()
    result = kmeans.fit(_frame(spark, points), "p", [[0, 0], [0.1, 0], [0, 0.1]], max_rounds=1)
    assert (result.rounds, result.converged) == (1, False)
    with pytest.raises(ValueError):
        kmeans.fit(_frame(spark, points), "p", [])


@pytest.mark.parametrize("arrow", [False, True])
def test_tie_goes_to_the_first_centroid(spark, arrow):
    held = kmeans.assign(_frame(spark, [[1.0, 0.0]]), [[0.0, 0.0], [2.0, 0.0]], "p", arrow=arrow)
    assert held.first().cluster == 0


def test_arrow_form_gives_the_same_clusters(spark):
    rows = [(i, [float((i * 7 + j * 3) % 11) for j in range(8)]) for i in range(500)] + [(500, None)]
    points = spark.createDataFrame(rows, "id INT, p ARRAY<FLOAT>").repartition(5)
    centroids = [rows[i][1] for i in (3, 8, 21)]
    plain = kmeans.assign(points, centroids, "p").select("id", "cluster")
    batched = kmeans.assign(points, centroids, "p", arrow=True).select("id", "cluster")
    assert plain.exceptAll(batched).isEmpty() and batched.count() == 501


def test_steps(spark):
    points = _frame(spark, [[0.0, 0.0], [2.0, 0.0], [10.0, 10.0]])
    centroids = [[0.0, 0.0], [9.0, 9.0], [500.0, 500.0]]
    held = kmeans.assign(points, centroids, "p")
    assert {r.cluster: r.points for r in kmeans.cluster_sizes(held).collect()} == {0: 2, 1: 1}
    means = {r.cluster: r.centroid for r in kmeans.mean_vectors(held, "cluster", "p").collect()}
    assert means == {0: [1.0, 0.0], 1: [10.0, 10.0]}
    moved = kmeans.moved_centroids(held, centroids, "p").collect()
    assert {(r.cluster, r.pos): r.new for r in moved}[2, 0] == 500.0
    assert kmeans.total_shift(centroids, [[1.0, 0.0], [10.0, 10.0], [500.0, 500.0]]) == pytest.approx(1 + 2**0.5)


def test_start_is_repeatable(spark):
    points = _frame(spark, _blobs())
    first = kmeans.start_centroids(points, 3, "id", "p")
    assert len(first) == 3 and first == kmeans.start_centroids(points.repartition(5), 3, "id", "p")


def test_spark_ml_form(spark):
    model = kmeans.ml_kmeans(_frame(spark, _blobs()), "p", 3)
    assert len(model.clusterCenters()) == 3


@pytest.mark.parametrize("arrow", [False, True])
def test_vectors_of_another_length_are_refused(spark, arrow):
    points = spark.createDataFrame([(1, [1.0]), (2, [1.0, 2.0, 3.0])], "id INT, p ARRAY<DOUBLE>").coalesce(1)
    with pytest.raises(Exception, match="instead of 2"):
        kmeans.assign(points, [[0.0, 0.0], [1.0, 1.0]], "p", arrow=arrow).collect()
    with pytest.raises(Exception, match="instead of 2"):
        kmeans.fit(points, "p", [[0.0, 0.0]])


def test_missing_vectors_have_no_cluster_and_no_weight(spark):
    points = spark.createDataFrame([(1, [1.0, 1.0]), (2, None), (3, [3.0, 5.0])], "id INT, p ARRAY<DOUBLE>")
    for arrow in (False, True):
        held = kmeans.assign(points, [[0.0, 0.0]], "p", arrow=arrow)
        assert {r.id: r.cluster for r in held.collect()} == {1: 0, 2: None, 3: 0}
    assert kmeans.fit(points, "p", [[0.0, 0.0]]).centroids == [[2.0, 3.0]]


def test_fit_does_not_depend_on_partitions(spark):
    points = spark.range(3000).selectExpr("id", "array(sin(id) * 1e3, cos(id * 7) / 3, id / 7) p")
    start = kmeans.start_centroids(points, 4, "id", "p")
    found = [kmeans.fit(points.repartition(n), "p", start) for n in (1, 3, 8)]
    assert found[0] == found[1] == found[2]

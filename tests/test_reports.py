from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from meterfold.model import Band
from meterfold.operators import counting, lookup, reports, sampling

PURCHASES = [
    ("1", "green tea", "2", "awesome"),
    ("2", "black tea", "4", "satisfactory"),
    ("3", "green tea", "1", "awesome"),
    ("4", "green tea", "1.5", "awful"),
    ("5", "coffee", "8", "awesome"),
    ("6", "black tea", "1", "awesome"),
    ("7", "coffee", "4", "satisfactory"),
    ("8", "green tea", "2", "satisfactory"),
    ("9", "black tea", "3", "awesome"),
    ("10", "green tea", "1", "awful"),
]


@pytest.fixture(scope="module")
def purchases(spark):
    rows = spark.createDataFrame(PURCHASES, "id STRING, product STRING, spent STRING, rating STRING")
    return rows.withColumn("spent", F.col("spent").cast("double"))


def test_purchase_report(purchases):
    awesome = F.col("rating") == "awesome"
    assert counting.filtered_max(purchases, awesome, "spent").first().max_spent == 8.0
    found = counting.filtered_summary(purchases, awesome, "product", "spent", 2)
    assert {r["product"]: (r.n, r.total, r["mean"]) for r in found.collect()} == {
        "green tea": (2, 3.0, 1.5),
        "coffee": (1, 8.0, 8.0),
        "black tea": (2, 4.0, 2.0),
    }


def test_word_count(spark):
    lines = spark.createDataFrame([("Red fish  blue",), ("red FISH",), ("red",)], "line STRING")
    got = [(r.word, r.n) for r in counting.word_count(lines, "line").collect()]
    assert got == [("red", 3), ("fish", 2), ("", 1), ("blue", 1)]


@pytest.fixture(scope="module")
def loads(spark):
    rows = [("a", 10.0, "R"), ("b", 30.0, "R"), ("c", 30.0, "R"), ("d", 20.0, "I"), ("e", 10.0, "C")]
    return spark.createDataFrame(rows, "k STRING, v DOUBLE, z STRING")


def test_share_and_ratio(spark, loads):
    shares = {r.k: r.pct for r in reports.with_share(loads, "v").collect()}
    assert shares["b"] == 30.0 and sum(shares.values()) == pytest.approx(100.0)
    ratios = {r.k: r.ratio for r in reports.with_ratio_to_max(loads, "v").collect()}
    assert ratios["b"] == 100.0 and ratios["d"] == pytest.approx(200 / 3)
    zeros = spark.createDataFrame([("a", 0.0)], "k STRING, v DOUBLE")
    assert reports.with_share(zeros, "v").first().pct == 0.0
    assert reports.with_ratio_to_max(zeros, "v").first().ratio == 0.0


def test_plot_scale_has_margins_and_a_least_span(spark, loads):
    y = {r.k: r.y for r in reports.with_plot_scale(loads, "v").collect()}
    assert y["a"] == pytest.approx(1 / 22) and y["b"] == pytest.approx(21 / 22)
    flat = spark.createDataFrame([("a", 5.0), ("b", 5.0)], "k STRING, v DOUBLE")
    assert [r.y for r in reports.with_plot_scale(flat, "v").collect()] == pytest.approx([0.5, 0.5])


def test_top_n_breaks_ties_by_id(loads):
    assert [(r["rank"], r.k) for r in reports.top_n(loads, "v", 3, "k").collect()] == [(1, "b"), (2, "c"), (3, "d")]


def test_top_with_required(loads):
    def got(required, n):
        rows = reports.top_with_required(loads, "v", "k", "z", required, n).collect()
        return [(r["rank"], r.k) for r in rows]

    assert got("I", 2) == [(1, "b"), (2, "c"), (3, "d")]
    assert got("I", 3) == [(1, "b"), (2, "c"), (3, "d")]
    assert got("missing", 2) == [(1, "b"), (2, "c")]


def test_top_outliers_count_all(spark):
    rows = spark.createDataFrame([(i, v) for i, v in enumerate([230.0, 206.0, 254.0, 200.0, 253.0])], "i INT, v DOUBLE")
    got = reports.top_outliers(rows, "v", 2, "i", Band()).orderBy("rank").collect()
    assert [(r.i, r.side, r.detected, r.distance) for r in got] == [(3, "under", 3, 30.0), (1, "under", 3, 24.0)]


def test_total_row(loads):
    got = {r.z: (r.v, r.is_total) for r in reports.with_total_row(loads, ["z"], ["v"]).collect()}
    assert got == {"R": (70.0, 0), "I": (20.0, 0), "C": (10.0, 0), "TOTAL": (100.0, 1)}


def test_look_up_defaults(spark, loads):
    places = spark.createDataFrame([("a", 1.5)], "k STRING, lat DOUBLE")
    got = {r.k: r.lat for r in lookup.look_up(loads, places, ["k"], {"lat": 9.0}).collect()}
    assert got == {"a": 1.5, "b": 9.0, "c": 9.0, "d": 9.0, "e": 9.0}


def test_parents_with_readings_with_a_hot_key(spark):
    parents = spark.range(5).withColumnRenamed("id", "p")
    readings = spark.range(9000).select(F.when(F.col("id") < 8990, 1).otherwise(3).cast("bigint").alias("p"))
    got = [r.p for r in lookup.parents_with_readings(parents, readings, "p").orderBy("p").collect()]
    assert got == [1, 3]


def test_dense_grid_fills_gaps(spark):
    facts = spark.createDataFrame([("a", 1, 5.0), ("a", 3, 6.0), ("b", 2, 7.0)], "k STRING, w INT, v DOUBLE")
    steps = facts.select("w").distinct()
    got = lookup.dense_grid(facts.select("k").distinct(), steps, facts, ["k"], "w", "v")
    assert {(r.k, r.w): r.v for r in got.collect()} == {
        ("a", 1): 5.0, ("a", 2): 0.0, ("a", 3): 6.0, ("b", 1): 0.0, ("b", 2): 7.0, ("b", 3): 0.0,
    }


def test_sample_is_repeatable(spark):
    rows = spark.range(1000)
    first = {r.id for r in sampling.sample_rows(rows.repartition(3), 20, 42, "id").collect()}
    second = {r.id for r in sampling.sample_rows(rows.repartition(11), 20, 42, "id").collect()}
    other = {r.id for r in sampling.sample_rows(rows, 20, 43, "id").collect()}
    assert len(first) == 20 and first == second and first != other


def test_pivot_uses_the_given_values(spark):
    rows = spark.createDataFrame([(1, "x", 2.0), (1, "y", 3.0), (2, "x", 4.0)], "w INT, k STRING, v DOUBLE")
    wide = reports.pivot_measure(rows, "w", "k", ["x", "y", "z"], F.sum("v")).orderBy("w")
    assert wide.columns == ["w", "x", "y", "z"]
    assert [tuple(r) for r in wide.collect()] == [(1, 2.0, 3.0, None), (2, 4.0, None, None)]


def test_pivot_keeps_unlisted_values(spark):
    rows = spark.createDataFrame([(1, "a", 1), (1, "zz", 5), (1, None, 7), (2, "b", 2)], "d INT, t STRING, v INT")
    wide = reports.pivot_measure(rows, "d", "t", ["a", "b"], F.sum("v"), other="other", total="total")
    assert [tuple(r) for r in wide.orderBy("d").collect()] == [(1, 1, None, 12, 13), (2, None, 2, None, 2)]
    with pytest.raises(Exception, match="not listed: zz|not listed: null"):
        reports.pivot_measure(rows, "d", "t", ["a", "b"], F.sum("v")).collect()


def test_dense_grid_has_one_row_per_cell(spark):
    facts = spark.createDataFrame([("x", 1, 5.0, 1), ("x", 1, 3.0, 2), ("x", 2, 1.0, 1)], "k STRING, w INT, v DOUBLE, at INT")
    got = lookup.dense_grid(facts.select("k"), facts.select("w"), facts, ["k"], "w", "v", last=1, written="at").collect()
    assert [tuple(r) for r in got] == [("x", 2, 1.0)]
    got = lookup.dense_grid(facts.select("k"), facts.select("w"), facts, ["k"], "w", "v", written="at").orderBy("w").collect()
    assert [tuple(r) for r in got] == [("x", 1, 3.0), ("x", 2, 1.0)]

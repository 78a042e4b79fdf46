from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from meterfold.operators import series


@pytest.fixture(scope="module")
def line(spark):
    return spark.createDataFrame([(1, 10.0), (2, 0.0), (3, 5.0), (4, 5.0), (5, 4.0)], "w INT, e DOUBLE")


def test_change_against_previous(line):
    got = {r.w: (r.change_pct, r.direction) for r in series.with_change(line, "w", "e", 12).collect()}
    assert got == {
        1: (None, None), 2: (-100.0, "down"), 3: (None, None), 4: (0.0, "up"), 5: (pytest.approx(-20.0), "down"),
    }


def test_cut_comes_before_the_comparison(line):
    got = {r.w: r.change_pct for r in series.with_change(line, "w", "e", 2).collect()}
    assert got == {4: None, 5: pytest.approx(-20.0)}


def test_headline(line):
    row = series.headline(line, "w", "e").first()
    assert row.w == 5 and row.change_pct == pytest.approx(-20.0)
    assert series.headline(line.limit(1), "w", "e").first().change_pct is None


def test_latest_per_key_with_a_hot_key(spark):
    rows = spark.range(0, 9000, 1, 8).select(
        F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id") % 50).alias("k"),
        (F.col("id") % 4000).alias("t"),
        "id",
    )
    got = {r.k: (r.t, r.id) for r in series.latest_per_key(rows, ["k"], ["t", "id"]).collect()}
    want = {}
    for r in rows.collect():
        want[r.k] = max(want.get(r.k, (-1, -1)), (r.t, r.id))
    assert got == want


def test_row_at_or_latest(spark):
    rows = spark.createDataFrame([("a", 1, 1), ("a", 3, 2), ("b", 1, 3), ("b", 2, 4)], "k STRING, w INT, v INT")
    got = {r.k: r.v for r in series.row_at_or_latest(rows, ["k"], "w", 3).collect()}
    assert got == {"a": 2, "b": 4}
    older = {r.k: r.v for r in series.row_at_or_latest(rows, ["k"], "w", 1).collect()}
    assert older == {"a": 1, "b": 3}


def test_current_or_latest(spark):
    rows = spark.createDataFrame([("a", 1), ("a", 3), ("b", 2)], "k STRING, w INT")
    got = {r.k: (r.w, r.is_current) for r in series.current_or_latest(rows, ["k"], "w").collect()}
    assert got == {"a": (3, True), "b": (2, False)}


def test_last_windows_and_retention(spark):
    rows = spark.range(40).select((F.col("id") % 10).alias("w"), "id")
    kept = series.in_last_windows(rows, "w", 3)
    assert {r.w for r in kept.collect()} == {7, 8, 9} and kept.count() == 12
    assert series.in_last_windows(kept, "w", 3).count() == 12
    assert series.in_last_windows(rows, "w", 0).count() == 40
    assert series.in_last_windows(rows, "w", 99).count() == 40
    with pytest.raises(ValueError):
        series.in_last_windows(rows, "w", -1)


def test_limit_on_the_event_time_reaches_the_scan(spark, tmp_path):
    path = str(tmp_path / "t")
    spark.range(1000).select((F.col("id") - F.col("id") % 10).alias("w"), "id").write.parquet(path)
    kept = series.in_last_windows(spark.read.parquet(path), "w", 2, "id")
    assert kept.count() == 20
    assert "GreaterThanOrEqual(id," in kept._jdf.queryExecution().executedPlan().toString()

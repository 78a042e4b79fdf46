"""Batches merged into a stored roll-up give what a recomputation gives."""

from __future__ import annotations

import datetime as dt
import os

import pytest
from pyspark.sql import functions as F

from meterfold import incremental
from meterfold.operators import rollup
from meterfold.sources import versions

T0 = dt.datetime(2026, 5, 16, 22, 0)


@pytest.fixture(scope="module")
def readings(spark):
    """Four days of readings; D0 has most of them, D8 has no parent."""
    return spark.range(4000).select(
        F.col("id"),
        F.when(F.col("id") % 3 > 0, "D0").otherwise(F.concat(F.lit("D"), F.col("id") % 9)).alias("distributor_id"),
        (F.lit(T0).cast("timestamp_ntz") + F.expr("make_dt_interval(0, 0, id)")).alias("timestamp"),
        (F.col("id") % 977 / 100.0).alias("energy_consumption"),
        F.when(F.col("id") % 10 > 0, (200 + F.col("id") % 61).cast("double")).alias("voltage"),
        F.lit(1.5).alias("current"),
    )


@pytest.fixture(scope="module")
def hierarchy(spark):
    return spark.createDataFrame([(f"D{i}", f"C{i % 2}") for i in range(8)], "distributor_id string, concentrator_id string")


def _same(a, b):
    b = b.select(*a.columns)
    return a.exceptAll(b).isEmpty() and b.exceptAll(a).isEmpty()


def _whole(rows, hierarchy):
    level2 = rollup.by_distributor(rows)
    level3 = rollup.by_parent(rollup.with_parents(level2, hierarchy), ["concentrator_id"])
    return {"level2": level2, "level3": level3, "level4": rollup.recap(level3)}


def test_batches_equal_a_recomputation(spark, readings, hierarchy, tmp_path):
    table = incremental.RollUpTable(spark, str(tmp_path / "t"), hierarchy, ["concentrator_id"])
    seen = readings.where("false")
    for batch, part in enumerate(("id % 3 = 1", "id % 3 = 0", "id % 3 = 2")):
        table.merge(readings.where(part), f"b{batch}")
        seen = seen.union(readings.where(part))
        for level, want in _whole(seen, hierarchy).items():
            assert _same(want, table.read(level))
    assert table.merge(readings.where("id % 3 = 2"), "b2") == []
    assert table.merge(readings.where("false"), "none") == []
    assert _same(_whole(readings, hierarchy)["level4"], table.read("level4"))


def test_untouched_days_keep_their_files(spark, readings, hierarchy, tmp_path):
    path = str(tmp_path / "t")
    table = incremental.RollUpTable(spark, path, hierarchy, ["concentrator_id"])
    days = table.merge(readings, "all")
    assert days == ["2026-05-16", "2026-05-17", "2026-05-18", "2026-05-19"]

    def stamps():
        return {
            s.key: (s.path, os.stat(s.path).st_mtime_ns) for s in versions.manifest(spark, path).segments
        }

    before = stamps()
    opened = table.read("level4")
    old = readings.where("timestamp >= '2026-05-17 06:00:00' and timestamp < '2026-05-17 07:00:00'")
    assert table.merge(old, "late") == ["2026-05-17"]
    after = stamps()
    assert {k for k in after if after[k] != before[k]} == {f"{n}/2026-05-17" for n in incremental.LEVELS}
    assert _same(_whole(readings.union(old), hierarchy)["level4"], table.read("level4"))
    # A reader from before the merge, and one of a single day.
    assert _same(_whole(readings, hierarchy)["level4"], opened)
    day = _whole(readings.union(old), hierarchy)["level2"].where("date(window_start) = '2026-05-17'")
    assert _same(day, table.read("level2", ["2026-05-17"]))
    # A merge that started from an older version does not overwrite the newer one.
    with pytest.raises(versions.Conflict):
        versions.commit(spark, path, versions.manifest(spark, path, 1))

from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import functions as F

from meterfold.operators import rollup

T0 = dt.datetime(2026, 5, 16, 14, 0)
SCHEMA = """distributor_id STRING, meter_id STRING, timestamp TIMESTAMP_NTZ,
            energy_consumption DOUBLE, voltage DOUBLE, current DOUBLE"""


@pytest.fixture(scope="module")
def readings(spark):
    rows = [
        ("D1", "M1", T0, 0.5, 230.0, 8.0),
        ("D1", "M2", T0 + dt.timedelta(minutes=14, seconds=59), 0.7, 206.0, 10.0),
        ("D2", "M3", T0 + dt.timedelta(minutes=3), 1.0, 254.0, 12.0),
        ("D2", "M3", T0 + dt.timedelta(minutes=15), 1.0, 253.0, 12.0),
        ("D9", "M4", T0, 1.0, 230.0, 12.0),
    ]
    return spark.createDataFrame(rows, SCHEMA)


@pytest.fixture(scope="module")
def hierarchy(spark):
    return spark.createDataFrame(
        [("D1", "C1", "North", "Residential"), ("D2", "C1", "North", "Residential")],
        "distributor_id STRING, concentrator_id STRING, district STRING, zone_type STRING",
    )


def test_levels_of_the_worked_example(readings, hierarchy):
    level2 = rollup.by_distributor(readings)
    got = {
        (r.distributor_id, r.window_start): r for r in rollup.finish(level2).collect()
    }
    d1 = got["D1", T0]
    assert (d1.total_meters, d1.total_energy_kwh, d1.avg_voltage, d1.avg_current) == (2, 1.2, 218.0, 9.0)
    assert (d1.min_voltage, d1.max_voltage, d1.anomalies_count) == (206.0, 230.0, 1)
    assert (d1.window_end, d1.window_duration_min) == (T0 + dt.timedelta(minutes=15), 15)
    assert got["D2", T0 + dt.timedelta(minutes=15)].anomalies_count == 0

    placed = rollup.with_parents(level2, hierarchy)
    level3 = rollup.by_parent(placed, ["concentrator_id", "district", "zone_type"])
    c1 = rollup.finish(level3).where(F.col("window_start") == T0).first()
    assert (c1.total_distributors, c1.total_meters, c1.total_energy_kwh) == (2, 3, 2.2)
    assert (c1.avg_voltage, c1.min_voltage, c1.max_voltage, c1.anomalies_count) == (230.0, 206.0, 254.0, 2)

    cycles = {r.cycle_id: r for r in rollup.cycles(rollup.recap(level3)).collect()}
    assert sorted(cycles) == [1, 2]
    assert (cycles[1].districts_reported, cycles[1].total_meters, cycles[1].anomalies_count) == (1, 3, 2)
    assert cycles[1].cycle_end == T0 + dt.timedelta(minutes=17)


def test_weighted_mean_of_group_means(spark):
    rows = spark.createDataFrame([(218.0, 2), (254.0, 1)], "mean DOUBLE, n BIGINT")
    value = rollup.weighted_mean(F.col("mean"), F.col("n"), 2)
    assert rows.agg(value.alias("m")).first().m == 230.0
    assert rows.limit(0).agg(value.alias("m")).first().m == 0.0


def test_window_origin(readings):
    level2 = rollup.by_distributor(readings, origin_minutes=7)
    starts = {r.window_start.minute for r in level2.collect()}
    assert starts <= {7, 22, 37, 52}


def test_upper_levels_agree_with_direct_aggregation(spark):
    rows = spark.range(20000).select(
        F.format_string("D%03d", F.col("id") % 50).alias("distributor_id"),
        (F.lit(T0).cast("timestamp_ntz") + F.expr("make_dt_interval(0, 0, 0, id % 7200)")).alias("timestamp"),
        (F.col("id") % 977 / 100.0).alias("energy_consumption"),
        (200 + F.col("id") % 61).cast("double").alias("voltage"),
        (F.col("id") % 13 / 8.0).alias("current"),
    )
    level2 = rollup.by_distributor(rows)
    parents = level2.select("distributor_id").distinct().withColumn(
        "concentrator_id", F.substring("distributor_id", 1, 3)
    )
    level3 = rollup.by_parent(rollup.with_parents(level2, parents), ["concentrator_id"])
    direct = rollup.by_distributor(rows, keys=[])
    shared = ["window_start", *rollup.STATE]
    top = rollup.recap(level3).select(*shared)
    assert top.exceptAll(direct.select(*shared)).isEmpty()
    assert direct.select(*shared).exceptAll(top).isEmpty()


def test_missing_measures_do_not_bias_means(spark):
    rows = spark.createDataFrame(
        [("a", T0, 1.0, 230.0, None), ("a", T0, None, None, None), ("b", T0, 2.0, 210.0, 4.0)],
        "distributor_id STRING, timestamp TIMESTAMP_NTZ, energy_consumption DOUBLE, voltage DOUBLE, current DOUBLE",
    )
    level2 = rollup.by_distributor(rows)
    a = rollup.finish(level2).where("distributor_id = 'a'").first()
    assert (a.total_meters, a.total_energy_kwh, a.avg_voltage, a.avg_current) == (2, 1.0, 230.0, None)
    top = rollup.finish(rollup.recap(level2)).first()
    assert (top.total_meters, top.avg_voltage, top.avg_current) == (3, 220.0, 4.0)


@pytest.mark.parametrize("children", [999, 1000, 1001])
def test_nested_layout_does_not_depend_on_the_number_of_children(spark, children):
    parents = spark.createDataFrame([(1, children, children)], "w INT, n BIGINT, meters BIGINT")
    rows = spark.range(children).select(F.lit(1).alias("w"), F.col("id").alias("child"))
    nested = rollup.nest_children(parents, rows, ["w"], "child", "n", totals=["n", "meters"])
    assert nested.columns == ["w", "n", "meters", "part", "parts", "districts"]
    found = nested.orderBy("part").collect()
    assert [r.part for r in found] == list(range(found[0].parts)) and len(found) == (1 if children <= 1000 else 2)
    assert [r.meters for r in found] == [children] + [None] * (len(found) - 1)
    assert sorted(d.child for r in found for d in r.districts) == list(range(children))


@pytest.mark.parametrize("per_record", [1, 7, 1000])
def test_nested_children_are_whole(spark, per_record):
    parents = spark.createDataFrame([(1, 50), (2, 1)], "w INT, n BIGINT")
    children = spark.range(50).select(F.lit(1).alias("w"), F.col("id").alias("child"), (F.col("id") * 2).alias("x"))
    children = children.unionByName(spark.range(1).select(F.lit(2).alias("w"), F.col("id").alias("child"), F.lit(9).cast("bigint").alias("x")))
    nested = rollup.nest_children(parents, children, ["w"], "child", "n", per_record=per_record)
    sizes = [r.s for r in nested.select(F.size("districts").alias("s")).collect()]
    assert sum(sizes) == 51
    if per_record == 1000:
        assert len(sizes) == 2
    back = rollup.unnest_children(nested).select("w", "child", "x")
    assert back.exceptAll(children.select("w", "child", "x")).isEmpty() and back.count() == 51


def test_display_digits(readings):
    shown = rollup.finish(rollup.by_distributor(readings, keys=[]), digits=True)
    row = shown.where(F.col("window_start") == T0).first()
    assert row.avg_current == 10.5 and row.avg_voltage == 230.0

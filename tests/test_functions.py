from __future__ import annotations

import hashlib
import math

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from meterfold.functions import bands, fixed, load, slots, text, vectors
from meterfold.model import Band


def one(spark, column, **values):
    names = list(values)
    schema = ", ".join(
        f"{n} {'STRING' if isinstance(v, str) or v is None else 'DOUBLE' if isinstance(v, float) else 'BIGINT'}"
        for n, v in values.items()
    )
    rows = spark.createDataFrame([tuple(values[n] for n in names)], schema)
    return rows.select(column.alias("r")).first()["r"]


def test_band_limits_are_accepted(spark):
    rows = spark.createDataFrame([(206.99,), (207.0,), (253.0,), (253.01,)], "v DOUBLE")
    found = rows.select(bands.out_of_band(F.col("v")).alias("out"), bands.band_side(F.col("v")).alias("side"))
    assert [(r.out, r.side) for r in found.collect()] == [
        (True, "under"), (False, "over"), (False, "over"), (True, "over"),
    ]


@pytest.mark.parametrize(
    ("count", "critical", "band"),
    [(51, 50, "crit"), (50, 50, "warn"), (0, 50, "ok"), (6, 5, "crit"), (5, 5, "warn")],
)
def test_severity(spark, count, critical, band):
    assert one(spark, bands.severity(F.col("c"), critical), c=count) == band


@pytest.mark.parametrize(("value", "band"), [(206.9, "low"), (207.0, "warn"), (215.0, "ok")])
def test_low_level(spark, value, band):
    assert one(spark, bands.low_level(F.col("v")), v=value) == band


def test_first_present(spark):
    rows = spark.createDataFrame([(None, "b"), ("a", "b"), (None, None)], "x STRING, y STRING")
    found = rows.select(bands.first_present("x", "y", default="?").alias("r")).collect()
    assert [r.r for r in found] == ["b", "a", "?"]


def test_fixed_sum_does_not_depend_on_partitioning(spark):
    rows = spark.range(0, 5000, 1, 16).select((F.col("id") * 0.01 + 0.07).alias("v"))
    sums = {rows.repartition(n).agg(fixed.fixed_sum("v", 2).alias("s")).first().s for n in (1, 3, 16)}
    assert sums == {sum(i + 7 for i in range(5000)) / 100}


def test_fixed_mean_of_nothing_is_null(spark):
    rows = spark.createDataFrame([], "v DOUBLE")
    assert rows.agg(fixed.fixed_mean("v", 2).alias("m")).first().m is None


def test_words_keep_empty_tokens(spark):
    assert one(spark, text.words(F.col("t")), t="A  b ") == ["a", "", "b", ""]


def test_strip_takes_tabs_and_newlines(spark):
    assert one(spark, text.strip(F.col("t")), t="\t a b\n ") == "a b"


@pytest.mark.parametrize("value", [258.65, 305.95, 0.0, -0.04, -12.35, 1234.5, 99.95])
def test_signed_percent_matches_python(spark, value):
    expected = f"{'+' if value >= 0 else ''}{value:.1f}%"
    assert one(spark, text.signed_percent(F.col("v")), v=value) == expected


def test_grouped_numbers(spark):
    assert one(spark, text.grouped_int(F.col("v")), v=1234567) == "1 234 567"
    assert one(spark, text.grouped_float(F.col("v")), v=1234567.891) == "1 234 567.89"


def test_sequence_key(spark):
    key = text.sequence_key([F.lit("GRD"), F.lit("ABC"), F.lit("MTR")], F.col("n"))
    assert one(spark, key, n=42) == "GRD-ABC-MTR-00042"


def test_time_text(spark):
    rows = spark.createDataFrame([("2026-05-16T14:00:00",), ("junk",)], "t STRING")
    parsed = rows.select(text.parse_iso(F.col("t")).alias("p"))
    shown = parsed.select(
        text.iso(F.col("p")).alias("iso"),
        text.clock(text.minutes_later(F.col("p"), 15)).alias("end"),
    ).collect()
    assert [tuple(r) for r in shown] == [("2026-05-16T14:00:00", "14:15"), (None, None)]


@settings(max_examples=25, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(keys=st.lists(st.text(min_size=0, max_size=12), min_size=1, max_size=20), modulus=st.integers(1, 2**31 - 1))
def test_md5_modulo_matches_python(spark, keys, modulus):
    keys = [k.encode("utf-8", "ignore").decode() for k in keys]
    rows = spark.createDataFrame([(k,) for k in keys], "k STRING")
    got = [r.m for r in rows.select(slots.md5_modulo(F.col("k"), modulus).alias("m")).collect()]
    assert got == [int(hashlib.md5(k.encode()).hexdigest(), 16) % modulus for k in keys]


@pytest.mark.parametrize("slot_count", [1, 7, 15, 900])
def test_window_slot(spark, slot_count):
    rows = spark.range(500).select(F.col("id").cast("string").alias("k"))
    got = [r.s for r in rows.select(slots.window_slot(F.col("k"), slot_count).alias("s")).collect()]
    step = 900 // slot_count
    want = [
        min(int(hashlib.md5(str(i).encode()).hexdigest(), 16) % 900 // step, slot_count - 1)
        for i in range(500)
    ]
    assert got == want


def test_slot_arguments_are_checked():
    with pytest.raises(ValueError):
        slots.window_slot(F.col("k"), 901)
    with pytest.raises(ValueError):
        slots.md5_modulo(F.col("k"), 0)


def _expected_energy(zone, hour, weekend):
    bell = lambda h, top, spread: math.exp(-((h - top) ** 2) / (2 * spread**2))
    if zone == "Industrial":
        up, down = 1 / (1 + math.exp(-(hour - 7.5) * 1.6)), 1 / (1 + math.exp((hour - 18) * 1.4))
        factor, base, extra = 0.2 + 1.2 * up * down, 3.5, 0.45
    elif zone == "Commercial":
        factor = 0.3 + 0.95 * bell(hour, 11.5, 1.4) + 1.2 * bell(hour, 20, 1.4)
        base, extra = 1.2, 1.05
    else:
        factor = 0.3 + 0.85 * bell(hour, 8, 1.2) + 1.45 * bell(hour, 20.5, 1.5)
        base, extra = 0.45, 1.10 if zone == "Residential" else 1.05
    return base * factor * (extra if weekend else 1.0)


@pytest.mark.parametrize("zone", ["Residential", "Commercial", "Industrial", "Other"])
@pytest.mark.parametrize(
    ("ts", "hour", "weekend"),
    [("2024-01-05 20:30:00", 20.5, False), ("2024-01-06 08:15:00", 8.25, True), ("2024-01-07 03:00:00", 3.0, True)],
)
def test_expected_energy(spark, zone, ts, hour, weekend):
    rows = spark.createDataFrame([(zone, ts)], "z STRING, t STRING")
    moment = F.col("t").cast("timestamp_ntz")
    got = rows.select(
        load.expected_energy(F.col("z"), moment).alias("e"),
        load.decimal_hour(moment).alias("h"),
        load.is_weekend(moment).alias("w"),
    ).first()
    assert (got.h, got.w) == (hour, weekend)
    assert got.e == pytest.approx(_expected_energy(zone, hour, weekend), rel=1e-12)


def test_mean_current_counts_at_least_one_volt(spark):
    current = load.mean_current(F.col("e"), F.col("v"))
    assert one(spark, current, e=0.5, v=230.0) == 2000.0 / 230.0
    assert one(spark, current, e=0.5, v=0.0) == 2000.0


def test_vectors(spark):
    rows = spark.createDataFrame([(" 3.0,4.0\n",)], "line STRING")
    point = vectors.parse_vector(F.col("line"))
    got = rows.select(
        point.alias("p"),
        vectors.euclidean(point, F.array(F.lit(0.0), F.lit(0.0))).alias("d"),
        vectors.first_smallest(F.array(F.lit(2.0), F.lit(1.0), F.lit(1.0))).alias("i"),
    ).first()
    assert (got.p, got.d, got.i) == ([3.0, 4.0], 5.0, 1)


def test_band_defaults():
    assert (Band().low, Band().high, Band().nominal) == (207.0, 253.0, 230.0)


@pytest.mark.parametrize("value", ["double('NaN')", "double('Infinity')", "-1e300D", "1e16D"])
def test_uncountable_measures_raise(spark, value):
    rows = spark.sql(f"SELECT {value} AS x")
    with pytest.raises(Exception, match="not a countable measure"):
        rows.select(fixed.to_fixed("x", 4)).collect()


def test_missing_measures_stay_missing(spark):
    row = spark.sql("SELECT CAST(NULL AS DOUBLE) AS x, 1.25D AS y").select(fixed.to_fixed("x", 2).alias("x"), fixed.to_fixed("y", 2).alias("y")).first()
    assert (row.x, row.y) == (None, 125)

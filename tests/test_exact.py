from __future__ import annotations

import math
import random
import struct
from collections import defaultdict

import pytest

from meterfold.functions import exact

SCHEMA = "k string, v double"


def any_double(rng):
    while True:
        v = struct.unpack("<d", rng.randbytes(8))[0]
        if math.isfinite(v) and abs(v) < 1e300:
            return v


def wanted(rows):
    held = defaultdict(list)
    for k, v in rows:
        held[k] += [] if v is None else [v]
    return {k: (len(vs), math.fsum(vs) if vs else None) for k, vs in held.items()}


def found(spark, rows, parts):
    frame = spark.createDataFrame(rows, SCHEMA).repartition(parts)
    return {r["k"]: (r["n"], r["total"]) for r in exact.exact_sums(frame, ["k"], "v").collect()}


def test_sums_are_those_of_fsum_for_every_partitioning(spark):
    rng = random.Random(5)
    rows = [(rng.choice("abc"), any_double(rng)) for _ in range(3000)]
    rows += [("near", s * 10.0 ** rng.randint(-8, 8) * rng.random()) for _ in range(500) for s in (1, -1)]
    rows += [("cancel", v) for v in (1e100, 1.0, -1e100, 1e-100)]
    rows += [("tiny", v) for v in (5e-324, 5e-324, 2.2250738585072014e-308, -0.0, 0.0)]
    rows += [("edge", s * (2.0**e + d)) for e in range(-40, 49, 8) for d in (0, 2.0 ** (e - 52), -(2.0 ** (e - 53))) for s in (1, -0.5)]
    rows += [("large", 1.7e308), ("large", -1.7e308), ("large", 1.5), (None, 0.1), (None, None), ("none", None)]
    want = wanted(rows)
    for parts in (1, 7):
        assert found(spark, rows, parts) == want


def test_endless_values(spark):
    inf, nan = math.inf, math.nan
    rows = [("p", inf), ("p", 1.0), ("m", -inf), ("both", inf), ("both", -inf), ("nan", nan), ("nan", 2.0), ("over", 1.7e308), ("over", 1.7e308)]
    got = found(spark, rows, 3)
    assert got["p"] == (2, inf) and got["m"] == (1, -inf) and got["over"] == (2, inf)
    assert math.isnan(got["both"][1]) and math.isnan(got["nan"][1])


def test_names_and_empty_tables(spark):
    frame = spark.createDataFrame([(1, 2, 0.5), (1, 2, 0.25)], "bin int, endless int, whole double")
    row = exact.exact_sums(frame, ["bin", "endless"], "whole").first()
    assert tuple(row) == (1, 2, 2, 0.75)
    assert exact.exact_sums(frame.limit(0), ["bin"], "whole").count() == 0


@pytest.mark.parametrize("value", [2.0**-1074, -(2.0**-1022), 1.7976931348623157e308, 1 / 3, -65536.0, 2.0**16 - 2.0**-37])
def test_one_value_comes_back(spark, value):
    assert found(spark, [("a", value)], 1) == {"a": (1, value)}

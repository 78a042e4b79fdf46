"""Late readings become rows: nothing is lost, nothing is counted twice."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from meterfold.streaming import cascade, late

T0 = dt.datetime(2026, 5, 16, 14, 0)
SCHEMA = "meter long, at timestamp_ntz, energy long"


def _at(minutes):
    return T0 + dt.timedelta(minutes=minutes)


def test_closed_and_late(spark, tmp_path):
    source, out, state = (str(tmp_path / n) for n in ("in", "out", "state"))
    turns = [
        [(1, _at(1), 5), (2, _at(14), None), (3, _at(16), 7), (4, _at(40), 1)],  # closes 14:00, watermark 14:30
        [(5, _at(2), 10), (6, _at(3), 1), (7, _at(29), 2), (8, _at(31), 4)],  # 14:00, 14:15 late, 14:30 open
        [(9, _at(29), 3), (10, _at(90), 9), (11, None, 100)],
    ]
    for rows in turns:
        spark.createDataFrame(rows, SCHEMA).coalesce(1).write.mode("append").parquet(source)
        stream = cascade.with_watermark(spark.readStream.schema(SCHEMA).parquet(source), "at")
        found = late.closed_and_late(
            stream, "at", {"readings": F.lit(1), "energy": F.col("energy")}, spread=F.col("meter"), slots=3
        )
        with cascade.many_keys(spark):
            cascade.run_to_files(found, out, state)
    rows = late.per_window(spark.read.parquet(out), ["readings", "energy"]).collect()
    got = {(r["window_start"], r["late"]): (r["readings"], r["energy"]) for r in rows}
    assert got == {
        (_at(0), False): (2, 5), (_at(15), False): (1, 7), (_at(30), False): (2, 5),
        (_at(0), True): (2, 11), (_at(15), True): (2, 5),
    }


def test_window_origin(spark, tmp_path):
    source, out, state = (str(tmp_path / n) for n in ("in", "out", "state"))
    rows = [(1, _at(6), 1), (2, _at(7), 1), (3, _at(21), 1), (4, _at(22), 1), (5, _at(80), 1)]
    spark.createDataFrame(rows, SCHEMA).write.parquet(source)
    stream = cascade.with_watermark(spark.readStream.schema(SCHEMA).parquet(source), "at")
    found = late.closed_and_late(stream, "at", {"n": F.lit(1)}, spread=F.col("meter"), origin_minutes=7)
    with cascade.many_keys(spark):
        cascade.run_to_files(found, out, state)
    rows = late.per_window(spark.read.parquet(out), ["n"]).collect()
    assert {r["window_start"]: r["n"] for r in rows} == {_at(-8): 1, _at(7): 2, _at(22): 1}

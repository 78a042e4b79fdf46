from __future__ import annotations

import datetime as dt
import json

from pyspark.sql import functions as F

from meterfold import jobs, model
from meterfold.operators import bundles
from meterfold.sources import history, messages

T0 = dt.datetime(2026, 5, 16, 14, 0)


def test_roll_up_publishes_and_logs(spark, tmp_path):
    readings = spark.range(3600).select(
        F.concat(F.lit("M"), "id").alias("meter_id"),
        F.concat(F.lit("D"), F.col("id") % 6).alias("distributor_id"),
        (F.lit(T0).cast("timestamp_ntz") + F.expr("make_dt_interval(0, 0, 0, id)")).alias("timestamp"),
        F.lit(0.5).alias("energy_consumption"),
        (200 + F.col("id") % 61).cast("double").alias("voltage"),
        F.lit(1.5).alias("current"),
    )
    hierarchy = spark.createDataFrame(
        [(f"D{i}", f"C{i % 2}", f"Area{i % 2}", f"A{i % 2}", "Residential") for i in range(6)],
        "distributor_id STRING, concentrator_id STRING, district STRING, district_code STRING, zone_type STRING",
    )
    log, target = str(tmp_path / "log"), messages.Target(path=str(tmp_path / "out"))
    cycles = jobs.roll_up(readings, hierarchy, target, log, keep_windows=3, first_cycle=11)
    assert [r.cycle_id for r in cycles.orderBy("cycle_id").collect()] == [11, 12, 13, 14]

    sent = messages.read_envelopes(spark, target.path)
    report = bundles.console_report(sent)
    assert {r.topic: r.messages for r in report["messages"].collect()} == {
        model.TOPIC_READINGS: 3600, model.TOPIC_DISTRIBUTORS: 24,
        model.TOPIC_CONCENTRATORS: 8, model.TOPIC_CENTER: 4,
    }
    recap = sent.where("key = 'cycle-11'").first()["value"]
    parsed = json.loads(recap)
    assert parsed["window_start"] == "2026-05-16T14:00:00" and parsed["cycle_end"] == "2026-05-16T14:17:00"
    assert [d["concentrator_id"] for d in parsed["districts"]] == ["C0", "C1"]
    first = parsed["districts"][0]
    assert (first["window_start"], first["window_end"]) == ("2026-05-16T14:00:00", "2026-05-16T14:15:00")
    assert parsed["total_energy_kwh"] == 450.0 == sum(d["total_energy_kwh"] for d in parsed["districts"])

    kept = history.load_history(spark, log)
    assert sorted(r.cycle_id for r in kept.cycles.collect()) == [12, 13, 14]
    assert kept.districts.count() == 6


def test_session_sizing():
    from meterfold import sized_for

    assert sized_for(10)["spark__sql__shuffle__partitions"] == "200"
    assert sized_for(10 * 2**40)["spark__sql__shuffle__partitions"] == "40960"
    assert sized_for(2**60)["spark__sql__shuffle__partitions"] == "100000"


def test_a_named_batch_can_be_repeated(spark, tmp_path):
    """Origin, duty cycle and versioned outputs of the batch job."""
    readings = spark.range(7200).select(
        F.concat(F.lit("M"), "id").alias("meter_id"),
        F.concat(F.lit("D"), F.col("id") % 6).alias("distributor_id"),
        (F.lit(T0).cast("timestamp_ntz") + F.expr("make_dt_interval(0, 0, 0, id)")).alias("timestamp"),
        F.lit(0.5).alias("energy_consumption"),
        F.lit(230.0).alias("voltage"),
        F.lit(1.5).alias("current"),
    )
    hierarchy = spark.createDataFrame(
        [(f"D{i}", f"C{i % 2}", f"Area{i % 2}", f"A{i % 2}", "Residential") for i in range(6)],
        "distributor_id STRING, concentrator_id STRING, district STRING, district_code STRING, zone_type STRING",
    )
    log, target = str(tmp_path / "log"), messages.Target(path=str(tmp_path / "out"))
    for _ in range(2):
        jobs.roll_up(readings, hierarchy, target, log, origin_minutes=10, active=15, batch="14h", keep_windows=3)
    sent = messages.read_committed(spark, target.path)
    counts = {r["topic"]: r["count"] for r in sent.groupBy("topic").count().collect()}
    # Cycles from 13:40: active 13:40-13:55, 14:10-14:25, 14:40-14:55, 15:10-15:25, 15:40-15:55.
    assert counts == {
        model.TOPIC_READINGS: 3600, model.TOPIC_DISTRIBUTORS: 24, model.TOPIC_CONCENTRATORS: 8, model.TOPIC_CENTER: 4,
    }
    kept = history.split_history(history.parse_lines(history.committed_lines(spark, log)))
    assert sorted(r.window_start.strftime("%H:%M") for r in kept.cycles.collect()) == ["14:40", "15:10", "15:40"]
    assert kept.districts.count() == 6

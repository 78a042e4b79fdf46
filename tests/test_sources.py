from __future__ import annotations

import datetime as dt
import json

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from meterfold import model, scratch
from meterfold.operators import bundles, rollup, series
from meterfold.sources import history, messages, rows, tables

T0 = dt.datetime(2026, 5, 16, 23, 30)


def _write(tmp_path, name, lines):
    folder = tmp_path / name
    folder.mkdir()
    (folder / "part.txt").write_text("\n".join(lines) + "\n", encoding="utf-8")
    return str(folder)


def test_headerless_csv(spark, tmp_path):
    path = _write(tmp_path, "csv", ["1,green tea,2,awesome", "2,coffee,1.5,awful"])
    read = rows.read_csv(spark, path)
    assert set(t for _, t in read.dtypes) == {"string"}
    assert [tuple(r) for r in read.orderBy("id").collect()] == [
        ("1", "green tea", "2", "awesome"),
        ("2", "coffee", "1.5", "awful"),
    ]


def test_points(spark, tmp_path):
    path = _write(tmp_path, "points", ["1.5,2", "  -3,4e1 "])
    assert sorted(r.point for r in rows.read_points(spark, path).collect()) == [[-3.0, 40.0], [1.5, 2.0]]


def _message(topic, key, **value):
    return json.dumps({"topic": topic, "key": key, "value": value})


def test_strict_envelopes_skip_blank_lines(spark, tmp_path):
    path = _write(tmp_path, "ok", [_message("a", "k1", x=1), "", "   ", _message("b", None, x=2)])
    log = messages.read_envelopes(spark, path)
    assert {(r.topic, r.key) for r in log.collect()} == {("a", "k1"), ("b", None)}
    assert [tuple(r) for r in messages.of_topic(log, "b", "x INT").collect()] == [(None, 2)]


@pytest.mark.parametrize("bad", ['{"topic": "a", "key"', '{"key": "k", "value": {}}', '{"topic":"a","key":"k","value":{}} tail'])
def test_strict_envelopes_fail_on_a_bad_line(spark, tmp_path, bad):
    path = _write(tmp_path, "bad", [_message("a", "k1", x=1), bad])
    with pytest.raises(PySparkException):
        messages.read_envelopes(spark, path).collect()


def test_envelope_lines_are_json_objects(spark):
    frame = spark.createDataFrame([("é\"x", None)], "name STRING, gap STRING")
    route = messages.Route(frame, "t", F.col("name"))
    line = messages.envelope_lines(messages.message_frame([route])).first()["value"]
    assert json.loads(line) == {"topic": "t", "key": "é\"x", "value": {"name": "é\"x", "gap": None}}


def test_publish_appends_to_files(spark, tmp_path):
    frame = messages.message_frame([messages.Route(spark.range(3), "t", F.col("id"))])
    target = messages.Target(path=str(tmp_path / "out"))
    messages.publish(frame, target)
    messages.publish(frame, target)
    assert messages.read_envelopes(spark, target.path).count() == 6
    with pytest.raises(ValueError):
        messages.Target()


def test_broker_options():
    assert messages.BROKER_OPTIONS == {
        "kafka.compression.type": "gzip", "kafka.linger.ms": "20", "kafka.acks": "1",
    }


def _district(kind, name, start, energy, anomalies=0, **more):
    row = {
        "concentrator_id": f"{name}-C", "district": name, "zone_type": "Residential",
        "window_start": start.isoformat(), "window_end": (start + dt.timedelta(minutes=15)).isoformat(),
        "window_duration_min": 15, "total_distributors": 2, "total_meters": 3,
        "total_energy_kwh": energy, "avg_voltage": 230.0, "min_voltage": 206.0, "max_voltage": 254.0,
        "anomalies_count": anomalies,
    }
    row.update(more)
    return {"kind": kind, **row} if kind else row


def test_tolerant_history(spark, tmp_path):
    cycle = {"kind": "cycle", "cycle_id": 1, "cycle_start": T0.isoformat(), "cycle_end": T0.isoformat(), "total_energy_kwh": 3.0}
    good = [json.dumps(_district("district", "A", T0, 1.0)), json.dumps(cycle)]
    bad = [good[0][:-1], good[0] + " tail", good[0] + good[1], "not json", "", '{"other": 1}']
    log = history.load_history(spark, _write(tmp_path, "log", good + bad))
    assert [(r.district, r.window_start) for r in log.districts.collect()] == [("A", T0)]
    (row,) = log.cycles.collect()
    assert (row.cycle_id, row.window_start) == (1, T0)


def test_older_log_becomes_one_window(spark, tmp_path):
    later = T0 + dt.timedelta(minutes=30)
    lines = [
        _message(model.TOPIC_CONCENTRATORS, "A-C", **_district(None, "A", T0, 1.0)),
        _message(model.TOPIC_CONCENTRATORS, "A-C", **_district(None, "A", later, 2.0, 4)),
        _message(model.TOPIC_CONCENTRATORS, "B-C", **_district(None, "B", later, 5.5, 1)),
        _message("other", "x", a=1),
    ]
    log = history.load_history(spark, _write(tmp_path, "old", lines))
    assert {r.district: (r.window_start, r.total_energy_kwh) for r in log.districts.collect()} == {
        "A": (later, 2.0), "B": (later, 5.5),
    }
    (cycle,) = log.cycles.collect()
    assert (cycle.cycle_id, cycle.districts_reported, cycle.total_meters) == (0, 2, 6)
    assert (cycle.total_energy_kwh, cycle.anomalies_count, cycle.window_start) == (7.5, 5, later)
    newer = lines + [json.dumps(_district("district", "Z", T0, 1.0))]
    assert [r.district for r in history.load_history(spark, _write(tmp_path, "new", newer)).districts.collect()] == ["Z"]


def test_empty_log(spark, tmp_path):
    log = history.load_history(spark, _write(tmp_path, "none", [""]))
    assert log.districts.isEmpty() and log.cycles.isEmpty()


@pytest.fixture(scope="module")
def levels(spark):
    """Six windows over midnight, four districts of two zones."""
    readings = spark.range(5400).select(
        F.concat(F.lit("D"), F.col("id") % 16).alias("distributor_id"),
        F.concat(F.lit("M"), "id").alias("meter_id"),
        (F.lit(T0).cast("timestamp_ntz") + F.expr("make_dt_interval(0, 0, 0, id % 5400)")).alias("timestamp"),
        (F.col("id") % 977 / 100.0).alias("energy_consumption"),
        (200 + F.col("id") % 61).cast("double").alias("voltage"),
        F.lit(1.5).alias("current"),
    )
    number = F.substring("distributor_id", 2, 2).cast("int")
    hierarchy = readings.select("distributor_id").distinct().select(
        "distributor_id",
        F.concat(F.lit("C"), number % 4).alias("concentrator_id"),
        F.concat(F.lit("Area"), number % 4).alias("district"),
        F.when(number % 4 == 0, "Industrial").otherwise("Residential").alias("zone_type"),
    )
    level2 = rollup.with_parents(rollup.by_distributor(readings), hierarchy)
    level3 = rollup.by_parent(level2, ["concentrator_id", "district", "zone_type"])
    return readings.join(hierarchy, "distributor_id"), level2, level3


def _windows(spark, path):
    log = history.load_history(spark, path)
    return (
        sorted({r.window_start for r in log.districts.collect()}),
        sorted(r.window_start for r in log.cycles.collect()),
    )


def test_history_round_trip_and_trim(spark, tmp_path, levels):
    _, _, level3 = levels
    path = str(tmp_path / "log")
    cycles = rollup.cycles(rollup.recap(level3))
    history.append_history(rollup.finish(level3), cycles, path)
    starts = [T0 + dt.timedelta(minutes=15 * i) for i in range(6)]
    assert _windows(spark, path) == (starts, starts)
    assert len(scratch.list_folders(spark, path)) == 2

    folder = tmp_path / "log" / "window_date=2026-05-16"
    (folder / "more.txt").write_text("broken line\n")
    for keep, left in ((0, 6), (99, 6), (5, 5), (5, 5), (3, 3), (1, 1)):
        history.trim_history(spark, path, keep)
        if left >= 5:
            assert spark.read.text(path).where("value = 'broken line'").count() == 1
        assert _windows(spark, path) == (starts[-left:], starts[-left:])
    assert len(scratch.list_folders(spark, path)) == 1
    with pytest.raises(ValueError):
        history.trim_history(spark, path, -1)


def test_history_rows_have_one_layout(levels):
    _, _, level3 = levels
    both = history.history_rows(rollup.finish(level3), rollup.cycles(rollup.recap(level3)))
    counts = {r.kind: r["count"] for r in both.groupBy("kind").count().collect()}
    assert counts == {"district": 24, "cycle": 6}


def test_dashboard(spark, tmp_path, levels):
    _, _, level3 = levels
    path = str(tmp_path / "log")
    history.append_history(rollup.finish(level3), rollup.cycles(rollup.recap(level3)), path)
    places = spark.createDataFrame([("Area1", 1.0, 2.0)], "district STRING, latitude DOUBLE, longitude DOUBLE")
    frames = bundles.dashboard(history.load_history(spark, path), places, trend=4, top=2)
    assert frames["headline"].first().window_start == T0 + dt.timedelta(minutes=75)
    assert frames["timeline"].count() == 6
    assert frames["districts"].count() == 4
    assert {r.district: r.latitude for r in frames["map"].collect()}["Area2"] == model.DEFAULT_LATITUDE
    assert frames["total_series"].count() == 4
    series_rows = frames["district_series"].collect()
    assert len(series_rows) in (8, 12) and "Area0" in {r.district for r in series_rows}
    assert max(r.ratio for r in frames["bars"].collect()) == 100.0


def test_console_report(spark, tmp_path, levels):
    readings, level2, level3 = levels
    cycles = rollup.cycles(rollup.recap(level3))
    path = str(tmp_path / "messages")
    sent = messages.message_frame(
        [
            messages.Route(readings, model.TOPIC_READINGS, F.col("meter_id")),
            messages.Route(rollup.finish(level2), model.TOPIC_DISTRIBUTORS, F.col("distributor_id")),
            messages.Route(rollup.finish(level3), model.TOPIC_CONCENTRATORS, F.col("concentrator_id")),
            messages.Route(cycles, model.TOPIC_CENTER, F.col("cycle_id")),
        ]
    )
    messages.publish(sent, messages.Target(path=path))
    report = bundles.console_report(messages.read_envelopes(spark, path), n=3)
    assert {r.topic: r.messages for r in report["messages"].collect()} == {
        model.TOPIC_READINGS: 5400, model.TOPIC_DISTRIBUTORS: 96,
        model.TOPIC_CONCENTRATORS: 24, model.TOPIC_CENTER: 6,
    }
    assert report["last_cycle"].first().cycle_id == 6
    assert sum(r.pct for r in report["zones"].collect()) == pytest.approx(100.0)
    assert report["top_distributors"].count() == 3
    worst = report["voltage_anomalies"].collect()
    assert len(worst) == 3 and worst[0].detected == readings.where("voltage < 207 or voltage > 253").count()
    totals = {r.district: r.total_meters for r in report["district_totals"].collect()}
    assert totals["TOTAL"] == 5400
    one = bundles.console_report(messages.read_envelopes(spark, path), window_start=T0.isoformat())
    assert one["districts"].count() == 4 and one["last_cycle"].first().cycle_id == 1
    assert {r.low_level for r in one["districts"].collect()} == {"low"}
    assert one["histogram"].count() == 4


def test_scratch_needs_a_shared_folder_on_a_cluster(spark, monkeypatch):
    named = spark.conf.get("spark.checkpoint.dir", None) or scratch.shared_folder(spark)
    assert scratch.new_path(spark, "x").startswith(named)

    class Cluster:
        class conf:
            get = staticmethod(lambda key, default: default)

        class sparkContext:
            master = "yarn"

    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        scratch.shared_folder(Cluster)


def test_retention_as_a_frame(levels):
    _, _, level3 = levels
    kept = series.in_last_windows(level3, "window_start", 2)
    assert kept.count() == 8 and series.in_last_windows(kept, "window_start", 2).count() == 8


def test_streams_leave_neighbouring_tables_alone(spark, tmp_path):
    spark.range(3).write.parquet(str(tmp_path / "t.parquet"))
    spark.range(2).write.parquet(str(tmp_path / "t.parquet_backup"))
    rows = tables.stream(spark, str(tmp_path), "t", "id BIGINT")
    query = rows.writeStream.format("memory").queryName("only_t").trigger(availableNow=True).start()
    query.awaitTermination()
    assert spark.table("only_t").count() == 3


def test_jobs_delete_only_their_own_tables(spark):
    outer = scratch.stored(spark.range(4), "outer")
    with scratch.job(spark):
        assert scratch.stored(spark.range(5), "inner").count() == 5
        path = scratch._CREATED[-1]
    assert outer.count() == 4
    assert scratch.delete(spark, path) is False


def test_tables_can_go_before_the_job_ends(spark):
    first, second = (scratch.stored(spark.range(n), "part") for n in (3, 4))
    path = scratch._CREATED[-2]
    scratch.release(first, spark.range(1))
    assert path not in scratch._CREATED and not scratch.exists(spark, path) and second.count() == 4

    def build():
        return scratch.stored(spark.range(5), "inner").where("id > 1")

    before = list(scratch._CREATED)
    rows = scratch.finished(spark, "stage", build)
    assert rows.count() == 3 and len(scratch._CREATED) == len(before) + 1
    scratch.release(rows, second)
    assert scratch._CREATED == before[:-1]

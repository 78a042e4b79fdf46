"""Streams give the batch result for every window the watermark has closed."""

from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import functions as F

from meterfold import model
from meterfold.operators import rollup
from meterfold.plans import standins
from meterfold.sources import messages, tables
from meterfold.streaming import cascade

T0 = dt.datetime(2026, 5, 16, 14, 0)


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    """A table stored as a folder of files, in time order; D0 has two thirds of the rows."""
    base = str(tmp_path_factory.mktemp("stream"))
    rows = spark.range(0, 6000).select(
        F.when(F.col("id") % 3 > 0, "D0").otherwise(F.concat(F.lit("D"), F.col("id") % 9)).alias("distributor_id"),
        F.concat(F.lit("M"), "id").alias("meter_id"),
        (F.lit(T0).cast("timestamp_ntz") + F.expr("make_dt_interval(0, 0, 0, id)")).alias("timestamp"),
        (F.col("id") % 977 / 100.0).alias("energy_consumption"),
        (200 + F.col("id") % 61).cast("double").alias("voltage"),
        F.lit(1.5).alias("current"),
    )
    rows.repartitionByRange(4, "timestamp").write.parquet(tables.table_path(base, "readings"))
    return base


@pytest.fixture(scope="module")
def hierarchy(spark):
    rows = [(f"D{i}", f"C{i % 2}") for i in range(9)]
    return spark.createDataFrame(rows, "distributor_id STRING, concentrator_id STRING")


def _stream(spark, folder, per_batch=None):
    source = tables.stream(spark, folder, "readings", files_per_batch=per_batch)
    return cascade.with_watermark(source, "timestamp")


def _closed(rows):
    last = T0 + dt.timedelta(seconds=5999)
    limit = last - dt.timedelta(minutes=10) - dt.timedelta(minutes=15)
    return rows.where(F.col("window_start") <= F.lit(limit).cast("timestamp_ntz"))


def _same(a, b):
    b = b.select(*a.columns)
    return a.exceptAll(b).isEmpty() and b.exceptAll(a).isEmpty()


def _to_files(spark, stream, tmp_path):
    cascade.run_to_files(stream, str(tmp_path / "out"), str(tmp_path / "state"))
    return spark.read.parquet(str(tmp_path / "out"))


def test_level2_equals_batch(spark, folder, tmp_path):
    level = cascade.by_distributor(_stream(spark, folder), ["distributor_id"])
    got = _to_files(spark, cascade.plain_windows(level), tmp_path)
    want = _closed(rollup.by_distributor(tables.load(spark, folder, "readings")))
    assert want.count() > 0 and _same(want, got)


def test_three_levels_in_one_query(spark, folder, hierarchy, tmp_path):
    level2 = cascade.by_distributor(_stream(spark, folder), ["distributor_id"])
    level3 = cascade.by_parent(level2.join(hierarchy, "distributor_id"), ["concentrator_id"], "total_distributors")
    level4 = cascade.by_parent(level3, [], "districts_reported")
    got = _to_files(spark, cascade.plain_windows(level4), tmp_path)
    batch = rollup.with_parents(rollup.by_distributor(tables.load(spark, folder, "readings")), hierarchy)
    want = _closed(rollup.recap(rollup.by_parent(batch, ["concentrator_id"])))
    assert want.count() > 0 and _same(want, got)


def test_restart_continues_without_repeats(spark, tmp_path, folder):
    """A second run over later files adds the newly closed windows once."""
    rows = tables.load(spark, folder, "readings")
    base = str(tmp_path)
    middle = F.lit(T0 + dt.timedelta(minutes=50)).cast("timestamp_ntz")
    path = tables.table_path(base, "readings")
    for part in (rows.where(F.col("timestamp") < middle), rows.where(F.col("timestamp") >= middle)):
        part.write.mode("append").parquet(path)
        level = cascade.by_distributor(_stream(spark, base), ["distributor_id"])
        got = _to_files(spark, cascade.plain_windows(level), tmp_path)
    assert _same(_closed(rollup.by_distributor(rows)), got)


def test_many_small_batches_equal_one(spark, tmp_path, folder):
    rows = tables.load(spark, folder, "readings")
    for i in range(4):
        low, high = (F.lit(T0 + dt.timedelta(minutes=25 * n)).cast("timestamp_ntz") for n in (i, i + 1))
        part = rows.where((F.col("timestamp") >= low) & (F.col("timestamp") < high)).coalesce(1)
        part.write.mode("append").parquet(tables.table_path(str(tmp_path), "readings"))
    level = cascade.by_distributor(_stream(spark, str(tmp_path), per_batch=1), ["distributor_id"])
    got = _to_files(spark, cascade.plain_windows(level), tmp_path)
    assert _same(_closed(rollup.by_distributor(rows)), got)


def test_messages_become_readings_again(spark, folder, tmp_path):
    """Published readings, read back from their log as a stream, give the same roll-up."""
    rows = tables.load(spark, folder, "readings")
    route = messages.Route(rows, model.TOPIC_READINGS, F.col("meter_id"))
    target = messages.Target(path=str(tmp_path / "log"))
    messages.publish(messages.message_frame([route]), target)
    readings = messages.readings_of(messages.stream_envelopes(spark, target.path))
    watermarked = cascade.with_watermark(readings, "timestamp")
    level = cascade.by_distributor(watermarked, ["distributor_id"])
    got = _to_files(spark, cascade.plain_windows(level), tmp_path)
    assert _same(_closed(rollup.by_distributor(rows)), got)
    batch = messages.readings_of(messages.read_envelopes(spark, target.path))
    assert batch.select("meter_id", "timestamp").exceptAll(rows.select("meter_id", "timestamp")).isEmpty()


def test_duty_cycle(spark):
    rows = spark.createDataFrame([(T0 + dt.timedelta(minutes=m),) for m in (0, 14, 15, 29, 30, 44, 45)], "t TIMESTAMP_NTZ")
    got = {r.t.minute for r in cascade.duty_cycle(rows, "t").collect()}
    assert got == {0, 14, 30, 44}
    with pytest.raises(ValueError):
        cascade.duty_cycle(rows, "t", active=31)


def test_fan_out_and_replay(spark, folder, hierarchy, tmp_path):
    out = str(tmp_path / "out")
    publish = cascade.file_publisher(out)
    sent = []

    def twice(batch, number):
        """A batch that is attempted again must not add messages."""
        publish(batch, number)
        publish(batch, number)
        sent.append(number)

    query = cascade.fan_out(
        _stream(spark, folder), hierarchy, ["concentrator_id"], "concentrator_id", twice, str(tmp_path / "s")
    )
    query.awaitTermination()
    assert sent
    log = messages.read_envelopes(spark, out)
    counts = {r.topic: r["count"] for r in log.groupBy("topic").count().collect()}
    level2 = _closed(rollup.by_distributor(tables.load(spark, folder, "readings")))
    windows = level2.select("window_start").distinct().count()
    assert counts == {
        model.TOPIC_DISTRIBUTORS: level2.count(),
        model.TOPIC_CONCENTRATORS: 2 * windows,
        model.TOPIC_CENTER: windows,
    }
    center = messages.of_topic(log, model.TOPIC_CENTER, model.RECAP_SCHEMA)
    assert center.agg(F.sum("total_meters")).first()[0] == level2.agg(F.sum("total_meters")).first()[0]
    assert center.where("message_key = 'cycle-202605161400'").count() == 1


def test_forward_readings(spark, folder, tmp_path):
    out = str(tmp_path / "out")
    query = cascade.forward_readings(
        tables.stream(spark, folder, "readings"), F.col("meter_id"), cascade.file_publisher(out), str(tmp_path / "s")
    )
    query.awaitTermination()
    log = messages.read_envelopes(spark, out)
    typed = messages.of_topic(log, model.TOPIC_READINGS, model.READING_SCHEMA)
    assert typed.count() == 6000 and typed.where("message_key <> meter_id").isEmpty()


def test_broker_sink_options():
    options = cascade.sink_options("/ck", "host:1")
    assert options["kafka.acks"] == "1" and options["checkpointLocation"] == "/ck"


def test_published_records_are_complete(spark, folder, hierarchy, tmp_path):
    """Every topic read back, field by field, against the batch records."""
    out = str(tmp_path / "out")
    query = cascade.fan_out(
        _stream(spark, folder), hierarchy, ["concentrator_id"], "concentrator_id",
        cascade.committed_publisher(out, "levels"), str(tmp_path / "s"),
    )
    query.awaitTermination()
    log = messages.read_committed(spark, out)
    level2 = rollup.with_parents(_closed(rollup.by_distributor(tables.load(spark, folder, "readings"))), hierarchy)
    level3 = rollup.by_parent(level2, ["concentrator_id"])
    iso = lambda c: F.date_format(c, "yyyy-MM-dd'T'HH:mm:ss").alias(c)
    for topic, want, schema in (
        (model.TOPIC_DISTRIBUTORS, rollup.distributor_records(level2), model.DISTRIBUTOR_SCHEMA),
        (model.TOPIC_CONCENTRATORS, rollup.concentrator_records(level3), model.CONCENTRATOR_SCHEMA),
    ):
        got = messages.of_topic(log, topic, schema)
        want = want.withColumns({c: iso(c) for c in ("window_start", "window_end")})
        assert _same(got.select(*want.columns), want)
        assert got.where("timestamp is null or timestamp <> window_start").isEmpty()
    fields = log.where(F.col("topic") == model.TOPIC_CONCENTRATORS).select(F.json_object_keys("value").alias("k")).first()["k"]
    assert "avg_current" not in fields and "timestamp" in fields
    center = messages.of_topic(log, model.TOPIC_CENTER, model.RECAP_SCHEMA)
    for r in center.collect():
        start = r.window_start
        assert r.message_key == f"cycle-{r.cycle_id}" and r.cycle_start == start
        assert dt.datetime.fromisoformat(r.cycle_end) == dt.datetime.fromisoformat(start) + dt.timedelta(minutes=17)
        assert r.districts_reported == len(r.districts) == 2
        assert r.total_meters == sum(d.total_meters for d in r.districts)
        assert {d.timestamp for d in r.districts} == {start}
    text = log.where(F.col("topic") == model.TOPIC_CENTER).select(F.json_object_keys("value").alias("k")).first()["k"]
    assert not {"avg_voltage", "avg_current", "min_voltage", "max_voltage"} & set(text)


def test_consumer_keeps_running(spark, folder, hierarchy, tmp_path):
    """Messages in, messages out, with a free trigger; only the active minutes of a cycle count."""
    rows = tables.load(spark, folder, "readings")
    source, out = str(tmp_path / "in"), str(tmp_path / "out")
    route = messages.Route(rows, model.TOPIC_READINGS, F.col("meter_id"))
    messages.publish(messages.message_frame([route]), messages.Target(path=source))
    query = cascade.consume(
        messages.stream_envelopes(spark, source), hierarchy, ["concentrator_id"], "concentrator_id",
        cascade.committed_publisher(out, "levels"), str(tmp_path / "s"), active=15, origin_minutes=5,
        trigger={"processingTime": "1 second"},
    )
    try:
        query.processAllAvailable()
        assert query.isActive
    finally:
        query.stop()
    active = cascade.duty_cycle(rows, "timestamp", 15, 30, 5).drop("cycle_start")
    want = rollup.by_distributor(active, origin_minutes=5)
    assert {r.window_start.minute for r in want.select("window_start").distinct().collect()} == {5, 35}
    last = active.agg(F.max("timestamp")).first()[0]
    limit = F.lit(last - dt.timedelta(minutes=25)).cast("timestamp_ntz")
    want = want.where(F.col("window_start") <= limit)
    got = messages.of_topic(messages.read_committed(spark, out), model.TOPIC_DISTRIBUTORS, model.DISTRIBUTOR_SCHEMA)
    starts = {r[0] for r in got.select("window_start").distinct().collect()}
    assert starts and starts <= {r[0].isoformat() for r in want.select("window_start").distinct().collect()}
    assert got.agg(F.sum("total_meters")).first()[0] == want.agg(F.sum("total_meters")).first()[0]


def _plan(rows):
    return rows._jdf.queryExecution().executedPlan().toString()


def test_levels_out_of_the_state_are_not_broadcast(spark, folder, hierarchy, tmp_path):
    """The batch that closes the windows reads nothing, so Spark takes what leaves the state for small."""
    level2 = cascade.by_distributor(_stream(spark, folder), ["distributor_id"])
    level3 = cascade.by_parent(cascade.with_parents(level2, hierarchy), ["concentrator_id"], "distributors")
    query = cascade.start_to_files(cascade.plain_windows(level3), str(tmp_path / "out"), str(tmp_path / "state"))
    query.awaitTermination()
    last = query._jsq.streamingQuery().lastExecution().executedPlan().toString()
    assert "LocalTableScan" in last and "SortMergeJoin" in last and "BroadcastExchange" not in last
    want = rollup.by_parent(
        rollup.with_parents(_closed(rollup.by_distributor(tables.load(spark, folder, "readings"))), hierarchy),
        ["concentrator_id"], "distributors",
    )
    assert _same(want, spark.read.parquet(str(tmp_path / "out")))


def test_fan_out_broadcasts_no_level(spark, folder, hierarchy, tmp_path):
    plans, files = [], cascade.file_publisher(str(tmp_path / "out"))

    def publish(batch, number):
        plans.append(_plan(batch))
        files(batch, number)

    cascade.fan_out(
        _stream(spark, folder), hierarchy, ["concentrator_id"], "concentrator_id", publish, str(tmp_path / "s")
    ).awaitTermination()
    assert len(plans) == 2
    assert all("SortMergeJoin" in p and "BroadcastExchange" not in p for p in plans)


def test_hierarchy_sends_the_districts_only(spark, tmp_path):
    base = str(tmp_path)
    for name, rows in {
        "region": [(0, "R")],
        "nation": [(i, f"N{i}", 0) for i in range(25)],
        "customer": [(i, f"C{i}", i % 25, 1.0, "S") for i in range(200)],
    }.items():
        spark.createDataFrame(rows, tables.SCHEMAS[name]).write.parquet(tables.table_path(base, name))
    found = standins.hierarchy(spark, base)
    assert found.count() == 200
    assert "BuildLeft" not in _plan(found)

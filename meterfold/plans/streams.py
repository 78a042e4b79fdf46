"""Streaming queries: STR-1..5 and STR-7 (STR-6 is a batch count in ``windows``)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from meterfold import model, scratch
from meterfold.functions import fixed, text
from meterfold.operators import rollup
from meterfold.plans import standins as si
from meterfold.plans.registry import query
from meterfold.sources import messages, tables
from meterfold.streaming import cascade, late

# Windows the watermark has closed once all rows are read.
CLOSED_SQL = "window_start + INTERVAL '15 minutes' <= (SELECT max(ts) FROM events) - INTERVAL '10 minutes'"


def _readings(spark: SparkSession, folder: str) -> DataFrame:
    stream = si.as_readings(tables.stream(spark, folder, "events"))
    return cascade.with_watermark(stream, "timestamp")


def _to_table(spark: SparkSession, stream: DataFrame, label: str) -> DataFrame:
    path, checkpoint = scratch.new_path(spark, label), scratch.new_path(spark, f"{label}-state")
    cascade.run_to_files(stream, path, checkpoint)
    return spark.read.parquet(path)


@query(
    "STR-1_tumbling",
    f"{si.TO_LEVEL2} SELECT {si.record_sql('distributor_id')} FROM l2 WHERE {CLOSED_SQL}",
)
def tumbling(spark: SparkSession, folder: str) -> DataFrame:
    level = cascade.by_distributor(_readings(spark, folder), ["distributor_id"], band=si.BAND)
    return rollup.finish(_to_table(spark, cascade.plain_windows(level), "tumbling"))


@query(
    "STR-2_cascade",
    f"{si.TO_LEVEL4} SELECT districts_reported, {si.record_sql()} FROM l4 WHERE {CLOSED_SQL}",
)
def three_levels(spark: SparkSession, folder: str) -> DataFrame:
    level2 = cascade.by_distributor(_readings(spark, folder), ["distributor_id"], band=si.BAND)
    placed = cascade.with_parents(level2, si.hierarchy(spark, folder))
    level3 = cascade.by_parent(placed, si.PARENT_KEYS, "total_distributors")
    level4 = cascade.by_parent(level3, [], "districts_reported")
    return rollup.finish(_to_table(spark, cascade.plain_windows(level4), "cascade"))


@query(
    "STR-3_window_origin",
    f"""WITH placed AS (
            SELECT time_bucket(INTERVAL '15 minutes', ts, INTERVAL '7 minutes') AS window_start, value
            FROM events)
        SELECT window_start, count(*) AS readings, {si.fsum('value', 4)} AS energy
        FROM placed WHERE {CLOSED_SQL} GROUP BY 1""",
)
def window_origin(spark: SparkSession, folder: str) -> DataFrame:
    window = rollup.tumbling("timestamp", origin_minutes=7).alias("window")
    counted = _readings(spark, folder).groupBy(window).agg(
        F.count(F.lit(1)).alias("readings"),
        fixed.fixed_sum("energy_consumption", model.ENERGY_DIGITS).alias("energy"),
    )
    return _to_table(spark, cascade.plain_windows(counted), "origin")


@query(
    "STR-4_duty_cycle",
    """WITH placed AS (
           SELECT time_bucket(INTERVAL '30 minutes', ts) AS cycle_start, ts, user_id FROM events)
       SELECT cycle_start, user_id AS distributor_id, count(*) AS readings FROM placed
       WHERE ts < cycle_start + INTERVAL '15 minutes'
         AND cycle_start + INTERVAL '30 minutes' <= (
             SELECT max(ts) FROM placed WHERE ts < cycle_start + INTERVAL '15 minutes')
             - INTERVAL '10 minutes'
       GROUP BY 1, 2""",
)
def duty_cycle(spark: SparkSession, folder: str) -> DataFrame:
    stream = si.as_readings(tables.stream(spark, folder, "events"))
    stream = stream.withColumn("timestamp", F.col("timestamp").cast("timestamp"))
    active = cascade.duty_cycle(stream, "timestamp").withWatermark("timestamp", cascade.DELAY)
    window = rollup.tumbling("timestamp", model.CYCLE_MINUTES).alias("window")
    counted = active.groupBy(window, "distributor_id").agg(F.count(F.lit(1)).alias("readings"))
    found = _to_table(spark, cascade.plain_windows(counted), "duty")
    return found.withColumnRenamed("window_start", "cycle_start")


@query(
    "STR-5_fan_out",
    f"""{si.TO_LEVEL4}
        SELECT '{model.TOPIC_READINGS}' AS topic, CAST(meter_id AS VARCHAR) AS key,
               CAST(NULL AS VARCHAR) AS window_start, CAST(NULL AS BIGINT) AS total_meters
        FROM readings
        UNION ALL SELECT '{model.TOPIC_DISTRIBUTORS}', CAST(distributor_id AS VARCHAR),
               strftime(window_start, '%Y-%m-%dT%H:%M:%S'), total_meters
        FROM l2 JOIN hierarchy USING (distributor_id) WHERE {CLOSED_SQL}
        UNION ALL SELECT '{model.TOPIC_CONCENTRATORS}', CAST(concentrator_id AS VARCHAR),
               strftime(window_start, '%Y-%m-%dT%H:%M:%S'), total_meters
        FROM l3 WHERE {CLOSED_SQL}
        UNION ALL SELECT '{model.TOPIC_CENTER}', 'cycle-' || strftime(window_start, '%Y%m%d%H%M'),
               strftime(window_start, '%Y-%m-%dT%H:%M:%S'), total_meters
        FROM l4 WHERE {CLOSED_SQL}""",
)
def fan_out(spark: SparkSession, folder: str) -> DataFrame:
    base = scratch.new_path(spark, "fan")
    upper = cascade.fan_out(
        _readings(spark, folder),
        si.hierarchy(spark, folder),
        si.PARENT_KEYS,
        "concentrator_id",
        cascade.committed_publisher(f"{base}/out", "upper"),
        f"{base}/upper-state",
        band=si.BAND,
    )
    upper.awaitTermination()
    raw = cascade.forward_readings(
        si.as_readings(tables.stream(spark, folder, "events")),
        F.col("meter_id"),
        cascade.committed_publisher(f"{base}/out", "raw"),
        f"{base}/raw-state",
    )
    raw.awaitTermination()
    log = messages.read_committed(spark, f"{base}/out")
    return log.select(
        "topic",
        "key",
        F.get_json_object("value", "$.window_start").alias("window_start"),
        F.get_json_object("value", "$.total_meters").cast("bigint").alias("total_meters"),
    )


@query(
    "STR-7_watermark",
    f"""WITH placed AS (SELECT time_bucket(INTERVAL '15 minutes', ts) AS window_start FROM events)
        SELECT window_start, strftime(window_start, '%H:%M') AS clock, count(*) AS readings
        FROM placed WHERE {CLOSED_SQL} GROUP BY 1""",
)
def watermark(spark: SparkSession, folder: str) -> DataFrame:
    window = rollup.tumbling("timestamp").alias("window")
    counted = _readings(spark, folder).groupBy(window).agg(F.count(F.lit(1)).alias("readings"))
    closed = _to_table(spark, cascade.plain_windows(counted), "watermark")
    return closed.select("window_start", text.clock(F.col("window_start")).alias("clock"), "readings")


SLICES, SLICE_FILES = 4, 2


@query(
    "STR-2_bounded_batches",
    f"{si.TO_LEVEL4} SELECT districts_reported, {si.record_sql()} FROM l4 WHERE {CLOSED_SQL}",
)
def bounded_batches(spark: SparkSession, folder: str) -> DataFrame:
    """The cascade over readings that arrive slice by slice, one slice to a micro-batch."""
    arrived = scratch.new_path(spark, "slices")
    events = tables.load(spark, folder, "events")
    first, last = events.agg(F.min("ts"), F.max("ts")).first()
    width = (last - first) / SLICES
    for number in range(SLICES):
        part = events
        if number:
            part = part.where(F.col("ts") >= F.lit(first + number * width).cast("timestamp_ntz"))
        if number + 1 < SLICES:
            part = part.where(F.col("ts") < F.lit(first + (number + 1) * width).cast("timestamp_ntz"))
        # Files of one slice only: the next one is written when this one is there.
        part.repartition(SLICE_FILES, "event_id").write.mode("append").parquet(tables.table_path(arrived, "events"))
    stream = tables.stream(spark, arrived, "events", files_per_batch=SLICE_FILES)
    readings = cascade.with_watermark(si.as_readings(stream), "timestamp")
    level2 = cascade.by_distributor(readings, ["distributor_id"], band=si.BAND)
    placed = cascade.with_parents(level2, si.hierarchy(spark, folder))
    level3 = cascade.by_parent(placed, si.PARENT_KEYS, "total_distributors")
    level4 = cascade.by_parent(level3, [], "districts_reported")
    return rollup.finish(_to_table(spark, cascade.plain_windows(level4), "bounded"))


# The second delivery: one reading in twenty comes after all others.
SECOND = "event_id % 20 = 0"


@query(
    "STR-7_late_readings",
    f"""WITH placed AS (
            SELECT ts, time_bucket(INTERVAL '15 minutes', ts) AS window_start, {SECOND} AS second,
                   {si.fx('value', 4)} AS units FROM events),
        marks AS (
            SELECT max(ts) FILTER (NOT second) - INTERVAL '10 minutes' AS first_mark,
                   max(ts) - INTERVAL '10 minutes' AS last_mark FROM placed),
        judged AS (
            SELECT *, second AND window_start + INTERVAL '15 minutes' <= first_mark AS late,
                   window_start + INTERVAL '15 minutes' <= last_mark AS closed FROM placed, marks)
        SELECT window_start, late, count(*) AS readings, CAST(sum(units) AS BIGINT) AS energy_units
        FROM judged WHERE late OR closed GROUP BY 1, 2""",
)
def late_readings(spark: SparkSession, folder: str) -> DataFrame:
    """Two deliveries into one folder, a run of the stream after each."""
    arrived = scratch.new_path(spark, "arrived")
    out, state = scratch.new_path(spark, "late"), scratch.new_path(spark, "late-state")
    events = si.as_readings(tables.load(spark, folder, "events"))
    for part in (f"NOT {SECOND}", SECOND):
        delivered = events.where(part.replace("event_id", "meter_id"))
        delivered.write.mode("append").parquet(arrived)
        stream = spark.readStream.schema(events.schema).parquet(arrived)
        rows = late.closed_and_late(
            cascade.with_watermark(stream, "timestamp"),
            "timestamp",
            {
                "readings": F.lit(1),
                "energy_units": fixed.to_fixed("energy_consumption", model.ENERGY_DIGITS),
            },
            spread=F.col("meter_id"),
        )
        with cascade.many_keys(spark):
            cascade.run_to_files(rows, out, state)
    return late.per_window(spark.read.parquet(out), ["readings", "energy_units"])

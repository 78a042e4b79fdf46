"""The roll-up as streaming queries.

Windows close when the watermark passes their end, and append mode emits every
row of a closed window once. State per open window is one row per key; readings
are combined in the map tasks before they reach it.
"""

from __future__ import annotations

import contextlib
from collections.abc import Callable, Iterator, Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from meterfold import model
from meterfold.functions import text
from meterfold.model import Band, Measures
from meterfold.operators import rollup
from meterfold.session import DEFAULTS
from meterfold.sources import messages

DELAY = "10 minutes"


def with_watermark(readings: DataFrame, time: str, delay: str = DELAY) -> DataFrame:
    """Readings with an event time the engine accepts, late ones bounded."""
    return readings.withColumn(time, F.col(time).cast("timestamp")).withWatermark(time, delay)


def by_distributor(
    readings: DataFrame,
    keys: Sequence[str],
    measures: Measures = Measures(),
    band: Band = Band(),
    minutes: int = model.WINDOW_MINUTES,
    origin_minutes: int = 0,
) -> DataFrame:
    """Level 2 of a watermarked stream; keeps the ``window`` column."""
    window = rollup.tumbling(measures.time, minutes, origin_minutes).alias("window")
    return readings.groupBy(window, *keys).agg(*rollup.reading_state(measures, band))


def by_parent(
    level: DataFrame,
    keys: Sequence[str],
    children: str,
    minutes: int = model.WINDOW_MINUTES,
    origin_minutes: int = 0,
) -> DataFrame:
    """The next level over the same windows, in the same query."""
    width = f"{minutes} minutes"
    shift = f"{origin_minutes} minutes"
    window = F.window(F.window_time("window"), width, width, shift).alias("window")
    return level.groupBy(window, *keys).agg(
        F.count(F.lit(1)).alias(children), *rollup.merged_state()
    )


def with_parents(level: DataFrame, hierarchy: DataFrame, on: str = "distributor_id") -> DataFrame:
    """Inner look-up of the parent columns of each child row of a stream's level.

    Both sides are sorted. Spark judges the size of a batch by what it reads, and the batch that
    closes the windows may read nothing: without the hint all rows that leave the state
    would be broadcast through the driver.
    """
    return rollup.with_parents(level.hint("merge"), hierarchy, on)


def plain_windows(level: DataFrame) -> DataFrame:
    """``window_start`` without a zone in place of the window struct."""
    rest = [c for c in level.columns if c != "window"]
    start = F.col("window.start").cast("timestamp_ntz")
    return level.select(start.alias("window_start"), *rest)


#: Take what is there now, then stop.
ONCE = {"availableNow": True}


def duty_cycle(
    readings: DataFrame,
    time: str,
    active: int = model.WINDOW_MINUTES,
    cycle: int = model.CYCLE_MINUTES,
    origin_minutes: int = 0,
) -> DataFrame:
    """Readings of the first ``active`` minutes of every cycle, with ``cycle_start``.

    Cycles begin ``origin_minutes`` after the epoch and every ``cycle`` minutes from there.
    """
    if not 0 < active <= cycle:
        raise ValueError("active must be between 1 and the cycle length")
    start = rollup.tumbling(time, cycle, origin_minutes % cycle)["start"]
    placed = readings.withColumn("cycle_start", start)
    limit = F.col("cycle_start") + F.expr(f"INTERVAL '{active}' MINUTE")
    return placed.where(F.col(time) < limit)


@contextlib.contextmanager
def many_keys(spark: SparkSession) -> Iterator[None]:
    """Streams started in the block keep their state off-heap, which stateful processors need."""
    name = "spark.sql.streaming.stateStore.providerClass"
    before = spark.conf.get(name)
    spark.conf.set(name, DEFAULTS[name])
    try:
        yield
    finally:
        spark.conf.set(name, before)


def start_to_files(
    stream: DataFrame, path: str, checkpoint: str, trigger: Mapping[str, object] = ONCE
) -> StreamingQuery:
    """Start a stream into Parquet files; ``trigger`` as in ``DataStreamWriter.trigger``."""
    return (
        stream.writeStream.format("parquet")
        .outputMode("append")
        .option("path", path)
        .option("checkpointLocation", checkpoint)
        .trigger(**trigger)
        .start()
    )


def run_to_files(stream: DataFrame, path: str, checkpoint: str) -> None:
    """Process what is available now into Parquet files."""
    start_to_files(stream, path, checkpoint).awaitTermination()


def cascade_routes(
    distributors: DataFrame,
    hierarchy: DataFrame,
    parent_keys: Sequence[str],
    parent_id: str,
    minutes: int = model.WINDOW_MINUTES,
) -> list[messages.Route]:
    """Routes of the complete records of levels 2 to 4 for a set of closed windows.

    Districts and their centre are sorted and merged as in :func:`with_parents`.
    """
    placed = with_parents(distributors, hierarchy)
    concentrators = rollup.by_parent(placed, parent_keys)
    districts = rollup.concentrator_records(concentrators, minutes)
    center = rollup.stream_cycles(rollup.recap(concentrators), minutes=minutes)
    recaps = rollup.center_records(center, districts.hint("merge"), parent_id)
    return [
        messages.Route(
            rollup.distributor_records(placed, minutes), model.TOPIC_DISTRIBUTORS, F.col("distributor_id")
        ),
        messages.Route(districts, model.TOPIC_CONCENTRATORS, F.col(parent_id)),
        messages.Route(recaps, model.TOPIC_CENTER, text.cycle_key(F.col("cycle_id"))),
    ]


def fan_out(
    readings: DataFrame,
    hierarchy: DataFrame,
    parent_keys: Sequence[str],
    parent_id: str,
    publish: Callable[[DataFrame, int], None],
    checkpoint: str,
    measures: Measures = Measures(),
    band: Band = Band(),
    minutes: int = model.WINDOW_MINUTES,
    origin_minutes: int = 0,
    trigger: Mapping[str, object] = ONCE,
) -> StreamingQuery:
    """Publish levels 2 to 4, each to its topic, from one stateful aggregation.

    All rows of a window close in the same micro-batch, so the upper levels are
    plain aggregates of that batch. ``publish`` gets the batch number and must
    replace what an earlier attempt of that batch wrote. With a ``trigger`` such as
    ``{"processingTime": "1 minute"}`` the query keeps running. Readings outside the
    active part of a cycle are left out by :func:`duty_cycle` before.
    """
    level = plain_windows(
        by_distributor(readings, ["distributor_id"], measures, band, minutes, origin_minutes)
    )

    def send(batch: DataFrame, number: int) -> None:
        held = batch.persist()
        try:
            routes = cascade_routes(held, hierarchy, parent_keys, parent_id, minutes)
            publish(messages.message_frame(routes), number)
        finally:
            held.unpersist()

    return (
        level.writeStream.outputMode("append")
        .option("checkpointLocation", checkpoint)
        .foreachBatch(send)
        .trigger(**trigger)
        .start()
    )


def consume(
    sent: DataFrame,
    hierarchy: DataFrame,
    parent_keys: Sequence[str],
    parent_id: str,
    publish: Callable[[DataFrame, int], None],
    checkpoint: str,
    band: Band = Band(),
    delay: str = DELAY,
    active: int | None = None,
    cycle: int = model.CYCLE_MINUTES,
    origin_minutes: int = 0,
    trigger: Mapping[str, object] = ONCE,
) -> StreamingQuery:
    """The whole consumer: level-1 messages of a stream in, messages of levels 2 to 4 out.

    ``sent`` are the (topic, key, value) rows of ``messages.subscribe``, a growing log or a folder
    of envelopes. ``active`` keeps only the first minutes of every cycle, as in the duty
    cycle of the meters.
    """
    readings = with_watermark(messages.readings_of(sent), Measures().time, delay)
    if active is not None:
        readings = duty_cycle(readings, Measures().time, active, cycle, origin_minutes).drop("cycle_start")
    # The record of a reading names its place; the hierarchy is the one that counts.
    wanted = ["meter_id", "distributor_id", *(getattr(Measures(), f) for f in ("time", "energy", "voltage", "current"))]
    return fan_out(
        readings.select(*wanted), hierarchy, parent_keys, parent_id, publish, checkpoint,
        band=band, origin_minutes=origin_minutes, trigger=trigger,
    )


def broker_publisher(servers: str) -> Callable[[DataFrame, int], None]:
    """Publisher to a broker; a batch that is attempted again is sent again."""

    def write(batch: DataFrame, number: int) -> None:
        messages.publish(batch, messages.Target(servers=servers))

    return write


def file_publisher(path: str) -> Callable[[DataFrame, int], None]:
    """Publisher that writes each batch to a folder of its own and overwrites it on retry."""

    def write(batch: DataFrame, number: int) -> None:
        messages.envelope_lines(batch).write.mode("overwrite").text(
            f"{path}/batch={number}", lineSep="\n"
        )

    return write


def committed_publisher(path: str, name: str) -> Callable[[DataFrame, int], None]:
    """Publisher that commits each batch of the stream ``name`` once; read by ``messages.read_committed``."""

    def write(batch: DataFrame, number: int) -> None:
        messages.publish(batch, messages.Target(path=path), batch=f"{name}-{number}")

    return write


def forward_readings(
    readings: DataFrame,
    key: Column,
    publish: Callable[[DataFrame, int], None],
    checkpoint: str,
    trigger: Mapping[str, object] = ONCE,
) -> StreamingQuery:
    """Publish level 1: every reading, keyed by its meter."""
    def send(batch: DataFrame, number: int) -> None:
        publish(messages.message_frame([messages.Route(batch, model.TOPIC_READINGS, key)]), number)

    return (
        readings.writeStream.outputMode("append")
        .option("checkpointLocation", checkpoint)
        .foreachBatch(send)
        .trigger(**trigger)
        .start()
    )


def sink_options(checkpoint: str, servers: str) -> dict[str, str]:
    """Options of a streaming broker sink."""
    return {
        "kafka.bootstrap.servers": servers,
        "checkpointLocation": checkpoint,
        **messages.BROKER_OPTIONS,
    }


def to_broker(
    stream: DataFrame, spark: SparkSession, servers: str, checkpoint: str
) -> StreamingQuery:
    """Write a stream of (topic, key, value) rows to a broker."""
    writer = stream.writeStream.format("kafka").outputMode("append")
    for name, value in sink_options(checkpoint, servers).items():
        writer = writer.option(name, value)
    return writer.start()

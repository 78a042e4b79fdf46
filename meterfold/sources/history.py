"""Window-history log: JSON lines tagged ``kind``, in folders per day."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from meterfold import model, scratch
from meterfold.functions import fixed, text
from meterfold.operators import series
from meterfold.sources import messages, versions

PARTITION = "window_date"
#: Segment of a versioned log for lines without a window.
UNDATED = "undated"


def history_rows(concentrators: DataFrame, cycles: DataFrame) -> DataFrame:
    """Both record kinds as one frame; a column one kind lacks is null there."""
    tagged = concentrators.withColumn("kind", F.lit("district"))
    return tagged.unionByName(cycles.withColumn("kind", F.lit("cycle")), allowMissingColumns=True)


def history_lines(concentrators: DataFrame, cycles: DataFrame) -> DataFrame:
    """(value, window_date) lines of both kinds."""
    lines = []
    for kind, rows in (("district", concentrators), ("cycle", cycles)):
        rows = rows.drop("districts").withColumn("kind", F.lit(kind))
        ordered = ["kind", *[c for c in rows.columns if c != "kind"]]
        lines.append(
            rows.select(
                messages.record_json(rows, ordered).alias("value"),
                F.date_format("window_start", "yyyy-MM-dd").alias(PARTITION),
            )
        )
    return lines[0].unionByName(lines[1])


def append_history(concentrators: DataFrame, cycles: DataFrame, path: str) -> None:
    """Add windows to the log.

    The rebalance hint gives each day few files, and a day with many rows
    several tasks.
    """
    lines = history_lines(concentrators, cycles).hint("rebalance", PARTITION)
    lines.write.mode("append").partitionBy(PARTITION).text(path, lineSep="\n")


@dataclass(frozen=True)
class History:
    """Rows of a log by kind, times parsed."""

    districts: DataFrame
    cycles: DataFrame


def parse_lines(lines: DataFrame, column: str = "value", order: Column | None = None) -> DataFrame:
    """Tolerant parse: blank and broken lines are dropped. ``order`` is kept as ``line_order``."""
    kept = [] if order is None else [order.alias("line_order")]
    parsed = lines.select(*kept, messages.one_record(F.col(column), model.HISTORY_SCHEMA).alias("r"))
    return parsed.where(F.col("r").isNotNull()).select("r.*", *["line_order" for _ in kept])


def _place() -> Column:
    """Where a line stands: its file, the part of the file, and the line in that part."""
    part = [F.col(f"_metadata.{n}") for n in ("file_path", "file_block_start")]
    return F.struct(*part, F.monotonically_increasing_id().alias("line"))


def _times(*fallback: str) -> Column:
    return text.parse_iso(F.coalesce(*[F.col(c) for c in fallback]))


_DISTRICT_FIELDS = (
    "concentrator_id", "district", "district_code", "zone_type", "window_duration_min",
    "total_distributors", "total_meters", "total_energy_kwh", "avg_voltage", "min_voltage",
    "max_voltage", "anomalies_count",
)
_CYCLE_FIELDS = (
    "cycle_id", "districts_reported", "total_meters", "total_energy_kwh", "anomalies_count",
)


def split_history(parsed: DataFrame) -> History:
    """District and cycle rows; windows fall back to the older field names.

    Without any district row the concentrator messages of an envelope log stand
    in: the newest message per district becomes one window (of several for one window the
    last line of the log, or the one with the largest digest where lines have no order),
    and the cycle row is added up from those. Both branches stay lazy; the check for district rows
    stops at the first one.
    """
    kind = F.col("kind")
    tagged = parsed.where(kind == "district")
    districts = tagged.select(
        *_DISTRICT_FIELDS,
        _times("window_start", "timestamp").alias("window_start"),
        _times("window_end", "timestamp").alias("window_end"),
    )
    cycles = parsed.where(kind == "cycle").select(
        *_CYCLE_FIELDS,
        _times("window_start", "cycle_start").alias("window_start"),
        _times("window_end", "cycle_end").alias("window_end"),
    )

    older = parsed.where(kind.isNull() & (F.col("topic") == model.TOPIC_CONCENTRATORS))
    order = F.col("line_order") if "line_order" in parsed.columns else F.xxhash64("value")
    record = F.from_json("value", model.CONCENTRATOR_SCHEMA).alias("v")
    older = older.select(order.alias("line_order"), record).select("line_order", "v.*")
    older = older.select(
        "line_order",
        *[c for c in _DISTRICT_FIELDS if c != "district"],
        F.coalesce("district", F.lit("?")).alias("district"),
        _times("window_start", "timestamp").alias("window_start"),
        _times("window_end", "timestamp").alias("window_end"),
    )
    newest = series.latest_per_key(older, ["district"], ["window_start", "line_order"]).drop("line_order")
    use_older = ~tagged.exists()
    stand_in = newest.where(use_older)
    summed = stand_in.agg(
        F.lit(0).cast("bigint").alias("cycle_id"),
        F.count(F.lit(1)).alias("districts_reported"),
        F.sum("total_meters").alias("total_meters"),
        fixed.fixed_sum("total_energy_kwh", model.ENERGY_DIGITS).alias("total_energy_kwh"),
        F.sum("anomalies_count").alias("anomalies_count"),
        F.max("window_start").alias("window_start"),
        F.max("window_end").alias("window_end"),
    ).where(F.col("districts_reported") > 0)
    has_cycles = parsed.where(kind == "cycle").exists()
    return History(
        districts.unionByName(stand_in),
        cycles.unionByName(summed.where(~has_cycles)),
    )


def load_history(spark: SparkSession, path: str) -> History:
    """Read a log written by :func:`append_history` or an envelope log.

    The parsed lines feed several branches: they are parsed once and stored.
    """
    lines = spark.read.text(path, lineSep="\n")
    return split_history(scratch.stored(parse_lines(lines, order=_place()), "parsed"))


def _line_start() -> Column:
    """Window of a log line: its start, or that of its cycle; null for a line without one."""
    return text.parse_iso(
        F.coalesce(F.get_json_object("value", "$.window_start"), F.get_json_object("value", "$.cycle_start"))
    )


def append_committed(concentrators: DataFrame, cycles: DataFrame, path: str, batch: str) -> bool:
    """Add windows to a versioned log, once per batch name; whether they were added."""
    lines = history_lines(concentrators, cycles).hint("rebalance", PARTITION)
    return versions.append(lines, path, batch, by=PARTITION)


def adopt_flat(spark: SparkSession, flat: str, path: str, batch: str | None = None) -> bool:
    """Take a flat log, one file or a folder of lines, into a versioned one, once per ``batch``.

    Lines keep their text. Those without a window have a segment of their own, which
    no retention drops. ``batch`` is the flat log's path unless given.
    """
    lines = spark.read.text(flat, lineSep="\n")
    day = F.coalesce(F.date_format(_line_start(), "yyyy-MM-dd"), F.lit(UNDATED))
    dated = lines.withColumn(PARTITION, day).hint("rebalance", PARTITION)
    return versions.append(dated, path, batch or flat, by=PARTITION)


def committed_lines(spark: SparkSession, path: str, version: int | None = None) -> DataFrame:
    """Lines of a versioned log as ``value``."""
    return versions.read(spark, path, version=version)


def trim_committed(spark: SparkSession, path: str, windows: int = model.HISTORY_WINDOWS) -> int:
    """Keep the last ``windows`` windows of a versioned log; 0 keeps all. The version that holds.

    Segments of earlier days leave the manifest, those of later days stay the files they
    are, and the day of the oldest kept window is written anew if it holds older rows. No
    file is changed or deleted: a reader that was opened before still reads all its rows,
    until ``versions.vacuum``. The log is scanned newest day first, and only as many
    days as it takes to find the windows.
    """
    if windows < 0:
        raise ValueError("windows must not be negative")
    base = versions.manifest(spark, path)
    days = sorted({s.key for s in base.segments if s.key != UNDATED}, reverse=True)
    oldest, found = None, 0
    for last in range(len(days)) if windows else ():
        timed = versions.read(spark, path, keys=[days[last]], version=base.version).withColumn("_start", _line_start())
        kept = series.last_windows(timed, "_start", windows - found).agg(
            F.count(F.lit(1)).alias("n"), F.min("_start").alias("oldest")
        ).first()
        found += kept["n"]
        if found == windows:
            oldest = kept["oldest"]
            break
    if oldest is None:
        return base.version
    day = oldest.strftime("%Y-%m-%d")
    drop = [s for s in base.segments if s.key < day and s.key != UNDATED]
    boundary = base.of([day])
    timed = versions.read(spark, path, keys=[day], version=base.version).withColumn("_start", _line_start())
    kept = F.col("_start") >= F.lit(oldest).cast("timestamp_ntz")
    add: list[versions.Segment] = []
    if not timed.where(~kept).isEmpty():
        lines = timed.where(kept).select("value", F.lit(day).alias(PARTITION))
        add, _ = versions.write(lines, path, "", by=PARTITION)
        drop += boundary
    if not drop:
        return base.version
    return versions.commit(spark, path, base, add, drop).version


def trim_history(spark: SparkSession, path: str, windows: int = model.HISTORY_WINDOWS) -> None:
    """Keep the last ``windows`` windows of a log on disk; 0 keeps all.

    Whole days before the oldest kept window are deleted as folders. Only the
    day of that window is rewritten, and only when it holds older rows; lines of
    that day without a window stay. Running it again changes nothing.
    """
    if windows < 0:
        raise ValueError("windows must not be negative")
    if windows == 0:
        return
    timed = spark.read.text(path, lineSep="\n").withColumn("_start", _line_start())
    kept = series.last_windows(timed, "_start", windows).agg(
        F.count(F.lit(1)).alias("n"), F.min("_start").alias("oldest")
    ).first()
    if kept["n"] < windows:
        return
    oldest = kept["oldest"]
    day = oldest.strftime("%Y-%m-%d")
    boundary = timed.where(F.col(PARTITION).cast("string") == day)
    too_old = F.coalesce(F.col("_start") < F.lit(oldest).cast("timestamp_ntz"), F.lit(False))
    if not boundary.where(too_old).isEmpty():
        (
            boundary.where(~too_old)
            .select("value", F.col(PARTITION).cast("string").alias(PARTITION))
            .write.mode("overwrite")
            .option("partitionOverwriteMode", "dynamic")
            .partitionBy(PARTITION)
            .text(path, lineSep="\n")
        )
    for folder in scratch.list_folders(spark, path):
        name, _, value = folder.partition("=")
        if name == PARTITION and value < day:
            scratch.delete(spark, f"{path}/{folder}")

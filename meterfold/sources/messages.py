"""Messages: one JSON text per record, addressed by topic and key."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from meterfold import model
from meterfold.functions import text
from meterfold.sources import versions

# Nulls stay visible; timestamps inside nested records look like the others.
_JSON = {"ignoreNullFields": "false", "timestampNTZFormat": text.ISO_SECONDS}

#: Producer settings of the broker sink.
BROKER_OPTIONS = {
    "kafka.compression.type": "gzip",
    "kafka.linger.ms": "20",
    "kafka.acks": "1",
}


def _jsonable(rows: DataFrame, columns: Sequence[str]) -> list[Column]:
    """Columns with timestamps turned into ISO text."""
    types = dict(rows.dtypes)
    return [
        text.iso(F.col(c), micros=True).alias(c)
        if c == "timestamp" and types[c].startswith("timestamp")
        else text.iso(F.col(c)).alias(c)
        if types[c].startswith("timestamp")
        else F.col(c)
        for c in columns
    ]


def record_json(rows: DataFrame, columns: Sequence[str] | None = None) -> Column:
    """The record as JSON text; nulls stay visible."""
    return F.to_json(F.struct(*_jsonable(rows, columns or rows.columns)), _JSON)


@dataclass(frozen=True)
class Route:
    """Rows of one level, their topic and the column of their key."""

    rows: DataFrame
    topic: str
    key: Column


def message_frame(routes: Sequence[Route]) -> DataFrame:
    """(topic, key, value) rows of all routes: what a broker sink takes."""
    frames = [
        r.rows.select(
            F.lit(r.topic).alias("topic"),
            r.key.cast("string").alias("key"),
            record_json(r.rows).alias("value"),
        )
        for r in routes
    ]
    return reduce(DataFrame.unionByName, frames)


def envelope_lines(messages: DataFrame) -> DataFrame:
    """``{"topic","key","value"}`` lines; the value is embedded as an object."""
    head = F.to_json(F.struct("topic", "key"), _JSON)
    line = F.concat(F.expr("substring(h, 1, length(h) - 1)"), F.lit(',"value":'), "value", F.lit("}"))
    return messages.select(head.alias("h"), "value").select(line.alias("value"))


@dataclass(frozen=True)
class Target:
    """Where messages go: a broker when servers are given, else a file folder."""

    path: str | None = None
    servers: str | None = None

    def __post_init__(self) -> None:
        if not (self.path or self.servers):
            raise ValueError("a target needs a path or broker servers")


def publish(messages: DataFrame, target: Target, batch: str | None = None) -> None:
    """Write (topic, key, value) rows to the target.

    With the name of a ``batch`` a file target takes them once, however often the job is
    repeated, and all or none of them (:func:`read_committed`). Without one they are appended.
    """
    if target.servers:
        writer = messages.write.format("kafka").option("kafka.bootstrap.servers", target.servers)
        for name, value in BROKER_OPTIONS.items():
            writer = writer.option(name, value)
        writer.save()
    elif batch is not None:
        versions.append(envelope_lines(messages), target.path, batch)
    else:
        envelope_lines(messages).write.mode("append").text(target.path, lineSep="\n")


def subscribe(spark: SparkSession, servers: str, topics: Sequence[str]) -> DataFrame:
    """Topics of a broker as a stream of (topic, key, value, timestamp)."""
    source = (
        spark.readStream.format("kafka")
        .option("kafka.bootstrap.servers", servers)
        .option("subscribe", ",".join(topics))
        .load()
    )
    return source.select(
        "topic", F.col("key").cast("string"), F.col("value").cast("string"), "timestamp"
    )


def one_record(line: Column, schema: str) -> Column:
    """The record of a line that holds exactly one JSON object, else null.

    Read as a one-element array, a line with anything after the object is
    malformed; on its own the parser would stop behind the object. The array is
    named once, by the lambda, so a line is parsed once.
    """
    wrapped = F.concat(F.lit("["), line, F.lit("]"))
    found = F.from_json(wrapped, f"ARRAY<STRUCT<{schema}>>", {"mode": "PERMISSIVE"})
    single = F.transform(F.array(found), lambda a: F.when(F.size(a) == 1, F.get(a, F.lit(0))))
    return F.get(single, F.lit(0))


def parse_envelopes(lines: DataFrame, column: str = "line") -> DataFrame:
    """Strict parse of envelope lines: blank lines are skipped, a bad one fails."""
    stripped = lines.select(text.strip(F.col(column)).alias("line")).where(F.col("line") != "")
    # A generated row: filters on the topic stay above it and do not repeat the parse.
    record = one_record(F.col("line"), model.ENVELOPE_SCHEMA)
    parsed = stripped.select("line", F.inline(F.array(record)))
    topic = F.when(
        F.col("topic").isNull() | F.col("value").isNull(),
        F.raise_error(F.concat(F.lit("not a message: "), F.substring("line", 1, 200))).cast("string"),
    ).otherwise(F.col("topic"))
    return parsed.select(topic.alias("topic"), "key", "value")


def read_envelopes(spark: SparkSession, path: str) -> DataFrame:
    """Envelope log as (topic, key, value) rows."""
    return parse_envelopes(spark.read.text(path, lineSep="\n").withColumnRenamed("value", "line"))


def read_committed(spark: SparkSession, path: str, version: int | None = None) -> DataFrame:
    """(topic, key, value) rows of the committed batches below ``path``."""
    return parse_envelopes(versions.read(spark, path, version=version), "value")


def stream_envelopes(spark: SparkSession, path: str) -> DataFrame:
    """Envelope log as a stream of (topic, key, value) rows."""
    lines = spark.readStream.text(path, lineSep="\n")
    return parse_envelopes(lines.withColumnRenamed("value", "line"))


def readings_of(messages: DataFrame) -> DataFrame:
    """Typed readings of the level-1 topic, from a log or a stream."""
    typed = of_topic(messages, model.TOPIC_READINGS, model.READING_SCHEMA).drop("message_key")
    return typed.withColumn("timestamp", text.parse_iso(F.col("timestamp")))


def of_topic(messages: DataFrame, topic: str, schema: str) -> DataFrame:
    """Typed records of one topic, next to their key."""
    picked = messages.where(F.col("topic") == F.lit(topic))
    return picked.select(
        F.col("key").alias("message_key"),
        F.from_json("value", schema, {"mode": "FAILFAST"}).alias("v"),
    ).select("message_key", "v.*")

"""Sources and sinks: SRC-1..7, SNK-1..4."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from meterfold import model, scratch
from meterfold.functions import text
from meterfold.operators import counting, rollup
from meterfold.plans import standins as si
from meterfold.plans.registry import query
from meterfold.sources import growing, history, messages, rows, tables, versions
from meterfold.streaming import cascade


def purchases_copy(spark: SparkSession, folder: str) -> DataFrame:
    """Orders written as headerless CSV in the purchase layout, and read back."""
    path = scratch.new_path(spark, "purchases")
    orders = tables.load(spark, folder, "orders").select(
        "o_orderkey",
        "o_orderpriority",
        F.col("o_totalprice").cast("decimal(18,2)"),
        "o_orderstatus",
    )
    rows.write_csv(orders, path)
    return rows.read_csv(spark, path)


@query(
    "SRC-1_headerless_csv",
    """SELECT CAST(o_orderkey AS VARCHAR) AS id, o_orderpriority AS product,
              CAST(CAST(o_totalprice AS DECIMAL(18,2)) AS VARCHAR) AS spent,
              o_orderstatus AS rating
       FROM orders""",
)
def headerless_csv(spark: SparkSession, folder: str) -> DataFrame:
    return purchases_copy(spark, folder)


@query(
    "SRC-2_text_lines",
    """SELECT line, count(*) AS n FROM (
           SELECT unnest(string_split(text, chr(10))) AS line FROM documents) GROUP BY line""",
)
def text_lines(spark: SparkSession, folder: str) -> DataFrame:
    path = scratch.new_path(spark, "lines")
    rows.write_lines(tables.load(spark, folder, "documents"), "text", path)
    return rows.read_lines(spark, path).groupBy("line").agg(F.count(F.lit(1)).alias("n"))


@query(
    "SRC-3_literal_rows",
    """WITH names(status, label) AS (VALUES ('O', 'open'), ('F', 'filled'), ('P', 'pending'))
       SELECT label, count(*) AS n FROM orders JOIN names ON o_orderstatus = status GROUP BY label""",
)
def literal_rows(spark: SparkSession, folder: str) -> DataFrame:
    names = rows.literal_rows(
        spark, [("O", "open"), ("F", "filled"), ("P", "pending")], "status STRING, label STRING"
    )
    orders = tables.load(spark, folder, "orders")
    counted = orders.groupBy(F.col("o_orderstatus").alias("status")).agg(F.count(F.lit(1)).alias("n"))
    return counted.join(names, "status").select("label", "n")


@query(
    "SRC-4_vector_lines",
    """SELECT vec_id, CAST(len(embedding) AS INTEGER) AS dims,
              CAST(embedding[1] AS DOUBLE) AS first, CAST(embedding[-1] AS DOUBLE) AS last,
              CAST(list_max(embedding) AS DOUBLE) AS largest,
              CAST(list_min(embedding) AS DOUBLE) AS smallest
       FROM embeddings""",
)
def vector_lines(spark: SparkSession, folder: str) -> DataFrame:
    path = scratch.new_path(spark, "vectors")
    numbers = F.transform(F.col("embedding").cast("array<double>"), lambda x: x.cast("string"))
    line = F.concat_ws(",", F.col("vec_id").cast("string"), numbers)
    vectors = tables.load(spark, folder, "embeddings").select(
        F.concat(F.lit(" "), line, F.lit(" ")).alias("line")
    )
    rows.write_lines(vectors, "line", path)
    numbered = rows.read_points(spark, path, "numbers")
    point = F.slice("numbers", 2, F.size("numbers") - 1)
    return numbered.select(F.col("numbers")[0].cast("bigint").alias("vec_id"), point.alias("p")).select(
        "vec_id",
        F.size("p").alias("dims"),
        F.element_at("p", 1).alias("first"),
        F.element_at("p", -1).alias("last"),
        F.array_max("p").alias("largest"),
        F.array_min("p").alias("smallest"),
    )


ALL_TOPICS = (
    model.TOPIC_READINGS,
    model.TOPIC_DISTRIBUTORS,
    model.TOPIC_CONCENTRATORS,
    model.TOPIC_CENTER,
)


def level_messages(
    spark: SparkSession, folder: str, topics: Sequence[str] = ALL_TOPICS
) -> list[messages.Route]:
    """Routes of the levels asked for; levels with several readers are stored."""
    placed = rollup.with_parents(si.level2(spark, folder), si.hierarchy(spark, folder))
    if model.TOPIC_DISTRIBUTORS in topics:
        placed = scratch.stored(placed, "level2")
    l3 = rollup.by_parent(placed, si.PARENT_KEYS)
    if model.TOPIC_CENTER in topics:
        l3 = scratch.stored(l3, "level3")
    districts = rollup.concentrator_records(l3)
    routes = [
        messages.Route(si.readings(spark, folder), model.TOPIC_READINGS, F.col("meter_id")),
        messages.Route(rollup.distributor_records(placed), model.TOPIC_DISTRIBUTORS, F.col("distributor_id")),
        messages.Route(districts, model.TOPIC_CONCENTRATORS, F.col("concentrator_id")),
        messages.Route(
            rollup.center_records(rollup.cycles(rollup.recap(l3)), districts, "concentrator_id"),
            model.TOPIC_CENTER,
            text.cycle_key(F.col("cycle_id")),
        ),
    ]
    return [r for r in routes if r.topic in topics]


def spaced(lines: DataFrame) -> DataFrame:
    """Each line followed by a blank one."""
    return lines.select(F.explode(F.array(F.col("value"), F.lit("  "))).alias("value"))


@query(
    "SRC-5_strict_envelopes",
    f"""WITH {si.READINGS_SQL}
        SELECT CAST(meter_id AS VARCHAR) AS message_key, CAST(meter_id AS VARCHAR) AS meter_id,
               CAST(distributor_id AS VARCHAR) AS distributor_id,
               strftime("timestamp", '%Y-%m-%dT%H:%M:%S.%f') AS "timestamp",
               energy_consumption, voltage FROM readings""",
)
def strict_envelopes(spark: SparkSession, folder: str) -> DataFrame:
    path = scratch.new_path(spark, "envelopes")
    routes = level_messages(
        spark, folder, (model.TOPIC_READINGS, model.TOPIC_CONCENTRATORS)
    )
    sent = messages.message_frame(routes)
    rows.write_lines(spaced(messages.envelope_lines(sent)), "value", path)
    log = messages.read_envelopes(spark, path)
    typed = messages.of_topic(log, model.TOPIC_READINGS, model.READING_SCHEMA)
    return typed.select(
        "message_key", "meter_id", "distributor_id", "timestamp", "energy_consumption", "voltage"
    )


def damaged(lines: DataFrame) -> DataFrame:
    """Each line followed by a cut-off copy and a blank one."""
    cut = F.expr("substring(value, 1, length(value) - 1)")
    return lines.select(F.explode(F.array(F.col("value"), cut, F.lit(""))).alias("value"))


@query(
    "SRC-6_tolerant_history",
    f"""{si.TO_LEVEL4}, {si.CYCLES_SQL}
        SELECT 'district' AS kind, district, window_start, total_distributors AS children,
               total_meters, energy_units / 1e4 AS total_energy_kwh, anomalies_count FROM l3
        UNION ALL
        SELECT 'cycle', NULL, window_start, districts_reported, total_meters,
               total_energy_kwh, anomalies_count FROM cycles""",
)
def tolerant_history(spark: SparkSession, folder: str) -> DataFrame:
    path = scratch.new_path(spark, "history")
    l3 = si.level3_table(spark, folder)
    lines = history.history_lines(rollup.finish(l3), rollup.cycles(rollup.recap(l3)))
    rows.write_lines(damaged(lines), "value", path)
    log = history.load_history(spark, path)
    shown = ["window_start", "children", "total_meters", "total_energy_kwh", "anomalies_count"]
    districts = log.districts.withColumnRenamed("total_distributors", "children")
    cycles = log.cycles.withColumnRenamed("districts_reported", "children")
    return districts.select(F.lit("district").alias("kind"), "district", *shown).unionByName(
        cycles.select(F.lit("cycle").alias("kind"), F.lit(None).cast("string").alias("district"), *shown)
    )


@query(
    "SRC-7_older_log",
    f"""{si.TO_LEVEL3}, latest AS (
            SELECT * FROM l3 QUALIFY row_number() OVER (
                PARTITION BY district ORDER BY window_start DESC) = 1)
        SELECT 'district' AS kind, district, window_start, total_meters,
               energy_units / 1e4 AS total_energy_kwh, anomalies_count FROM latest
        UNION ALL
        SELECT 'cycle', NULL, max(window_start), CAST(sum(total_meters) AS BIGINT),
               CAST(sum(energy_units) AS BIGINT) / 1e4, CAST(sum(anomalies_count) AS BIGINT)
        FROM latest""",
)
def older_log(spark: SparkSession, folder: str) -> DataFrame:
    path = scratch.new_path(spark, "older")
    routes = level_messages(spark, folder, (model.TOPIC_CONCENTRATORS,))
    rows.write_lines(messages.envelope_lines(messages.message_frame(routes)), "value", path)
    log = history.load_history(spark, path)
    shown = ["window_start", "total_meters", "total_energy_kwh", "anomalies_count"]
    return log.districts.select(F.lit("district").alias("kind"), "district", *shown).unionByName(
        log.cycles.select(
            F.lit("cycle").alias("kind"), F.lit(None).cast("string").alias("district"), *shown
        )
    )


TOPIC_COUNTS_SQL = f"""{si.TO_LEVEL4}
    SELECT '{model.TOPIC_READINGS}' AS topic, count(*) AS messages FROM readings
    UNION ALL SELECT '{model.TOPIC_DISTRIBUTORS}', count(*) FROM l2 JOIN hierarchy USING (distributor_id)
    UNION ALL SELECT '{model.TOPIC_CONCENTRATORS}', count(*) FROM l3
    UNION ALL SELECT '{model.TOPIC_CENTER}', count(*) FROM l4"""


@query(
    "SNK-1_envelope_append",
    """SELECT topic, CAST(event_id AS VARCHAR) AS key, value
       FROM events, (VALUES ('first'), ('second')) t(topic)""",
)
def envelope_append(spark: SparkSession, folder: str) -> DataFrame:
    path = scratch.new_path(spark, "appended")
    events = tables.load(spark, folder, "events")
    for topic in ("first", "second"):
        route = messages.Route(events, topic, F.col("event_id"))
        messages.publish(messages.message_frame([route]), messages.Target(path=path))
    value = F.get_json_object("value", "$.value").cast("double")
    return messages.read_envelopes(spark, path).select("topic", "key", value.alias("value"))


@query(
    "SNK-2_broker_frame",
    f"""{si.TO_LEVEL3}
        SELECT '{model.TOPIC_CONCENTRATORS}' AS topic, CAST(concentrator_id AS VARCHAR) AS key,
               district, strftime(window_start, '%Y-%m-%dT%H:%M:%S') AS window_start,
               total_meters, energy_units / 1e4 AS total_energy_kwh
        FROM l3""",
)
def broker_frame(spark: SparkSession, folder: str) -> DataFrame:
    l3 = rollup.finish(si.level3(spark, folder))
    route = messages.Route(l3, model.TOPIC_CONCENTRATORS, F.col("concentrator_id"))
    frame = messages.message_frame([route])
    parsed = F.from_json("value", model.CONCENTRATOR_SCHEMA)
    return frame.withColumn("v", parsed).select(
        "topic", "key", "v.district", "v.window_start", "v.total_meters", "v.total_energy_kwh"
    )


@query(
    "SNK-3_complete_records",
    f"""{si.TO_LEVEL4}, {si.CYCLES_SQL}
        SELECT 'cycle-' || cycle_id AS key, cycle_id, strftime(cycle_end, '%Y-%m-%dT%H:%M:%S') AS cycle_end,
               districts_reported, district, l3.total_meters AS district_meters,
               l3.energy_units / 1e4 AS district_energy, strftime(l3.window_start, '%Y-%m-%dT%H:%M:%S') AS "timestamp"
        FROM cycles JOIN l3 ON cycles.window_start = l3.window_start""",
)
def complete_records(spark: SparkSession, folder: str) -> DataFrame:
    """Centre messages read back, one row per nested district."""
    path = scratch.new_path(spark, "records")
    routes = level_messages(spark, folder, (model.TOPIC_CENTER,))
    messages.publish(messages.message_frame(routes), messages.Target(path=path), batch="all")
    log = messages.of_topic(messages.read_committed(spark, path), model.TOPIC_CENTER, model.RECAP_SCHEMA)
    rows = log.select("message_key", "cycle_id", "cycle_end", "districts_reported", F.explode("districts").alias("d"))
    return rows.select(
        F.col("message_key").alias("key"),
        "cycle_id",
        "cycle_end",
        "districts_reported",
        "d.district",
        F.col("d.total_meters").alias("district_meters"),
        F.col("d.total_energy_kwh").alias("district_energy"),
        "d.timestamp",
    )


@query("SNK-3_publish", TOPIC_COUNTS_SQL)
def publish(spark: SparkSession, folder: str) -> DataFrame:
    path = scratch.new_path(spark, "published")
    target = messages.Target(path=path)
    messages.publish(messages.message_frame(level_messages(spark, folder)), target)
    return counting.topic_counts(messages.read_envelopes(spark, path))


@query(
    "SNK-4_history_append",
    f"""{si.TO_LEVEL4}, {si.CYCLES_SQL}
        SELECT 'district' AS kind, strftime(window_start, '%Y-%m-%d') AS window_date,
               count(*) AS n, CAST(sum(total_meters) AS BIGINT) AS meters,
               CAST(sum(anomalies_count) AS BIGINT) AS anomalies,
               CAST(NULL AS BIGINT) AS last_cycle
        FROM l3 GROUP BY 2
        UNION ALL
        SELECT 'cycle', strftime(window_start, '%Y-%m-%d'), count(*),
               CAST(sum(total_meters) AS BIGINT), CAST(sum(anomalies_count) AS BIGINT),
               max(cycle_id)
        FROM cycles GROUP BY 2""",
)
def history_append(spark: SparkSession, folder: str) -> DataFrame:
    path = scratch.new_path(spark, "log")
    l3 = si.level3_table(spark, folder)
    history.append_history(rollup.finish(l3), rollup.cycles(rollup.recap(l3)), path)
    log = history.parse_lines(spark.read.text(path, lineSep="\n"))
    return log.groupBy("kind", F.substring("window_start", 1, 10).alias("window_date")).agg(
        F.count(F.lit(1)).alias("n"),
        F.sum("total_meters").alias("meters"),
        F.sum("anomalies_count").alias("anomalies"),
        F.max("cycle_id").alias("last_cycle"),
    )


@query(
    "SNK-1_exactly_once",
    """SELECT topic, CAST(event_id AS VARCHAR) AS key, value
       FROM events, (VALUES ('first'), ('second')) t(topic)""",
)
def exactly_once(spark: SparkSession, folder: str) -> DataFrame:
    """Two batches: the first is sent twice, the second fails before its commit and is sent again."""
    path = scratch.new_path(spark, "committed")
    events = tables.load(spark, folder, "events")
    sent = {
        topic: messages.message_frame([messages.Route(events, topic, F.col("event_id"))])
        for topic in ("first", "second")
    }
    target = messages.Target(path=path)
    versions.write(messages.envelope_lines(sent["second"]), path, "second")
    for topic in ("first", "first", "second"):
        messages.publish(sent[topic], target, batch=topic)
    value = F.get_json_object("value", "$.value").cast("double")
    return messages.read_committed(spark, path).select("topic", "key", value.alias("value"))


def _append_to_files(path: str, sizes: dict[str, int]):
    """Append a partition's lines to the partition's own file, as the writer of a log does.

    ``sizes`` has the files' lengths before: a repeated task cuts off what its first
    attempt wrote.
    """

    def run(batches):
        import os

        from pyspark import TaskContext

        name = f"{path}/log-{TaskContext.get().partitionId():05d}.jsonl"
        os.makedirs(path, exist_ok=True)
        with open(name, "ab") as log:
            log.truncate(sizes.get(name, 0))
            for batch in batches:
                log.writelines(line.as_py().encode("utf-8") + b"\n" for line in batch.column("value"))
        yield from ()

    return run


@query(
    "SRC-5_growing_log",
    """SELECT 'events' AS topic, CAST(event_id AS VARCHAR) AS key, value,
              event_id % 3 = 0 AS second FROM events""",
)
def growing_log(spark: SparkSession, folder: str) -> DataFrame:
    """A stream over files that are appended to after its first run, and its restart."""
    path, out, state = (scratch.new_path(spark, n) for n in ("growing", "lines", "lines-state"))
    local = path.removeprefix("file://") if path.startswith("file:///") else path
    events = tables.load(spark, folder, "events")
    second = F.col("event_id") % 3 == 0
    for part in (~second, second):
        routes = [messages.Route(events.where(part), "events", F.col("event_id"))]
        lines = messages.envelope_lines(messages.message_frame(routes))
        sizes = growing.LogReader(local, growing.SPLIT_BYTES).latestOffset() if scratch.exists(spark, path) else {}
        # Dealt out by value, not by file: about as many lines for each file.
        dealt = lines.repartition(8, F.xxhash64("value"))
        dealt.mapInArrow(_append_to_files(local, sizes), "value string").write.format("noop").mode("overwrite").save()
        cascade.run_to_files(growing.stream_envelopes(spark, local, 1 << 16), out, state)
    found = spark.read.parquet(out)
    return found.select(
        "topic",
        "key",
        F.get_json_object("value", "$.value").cast("double").alias("value"),
        (F.col("key").cast("bigint") % 3 == 0).alias("second"),
    )

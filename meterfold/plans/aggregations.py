"""Aggregations: AGG-1..23."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from meterfold import incremental, model, scratch
from meterfold.functions import bands, exact, fixed
from meterfold.operators import counting, hierarchy, kmeans, reports, rollup, series
from meterfold.plans import standins as si
from meterfold.plans.inputs import TOPIC_COUNTS_SQL, level_messages
from meterfold.plans.joins import NEAREST_SQL, assigned
from meterfold.plans.registry import query
from meterfold.sources import messages, tables

FILLED = "o_orderstatus = 'F'"


@query(
    "AGG-1_word_count",
    """SELECT word, count(*) AS n FROM (
           SELECT unnest(string_split(lower(text), ' ')) AS word FROM documents) GROUP BY word""",
)
def word_count(spark: SparkSession, folder: str) -> DataFrame:
    return counting.word_count(tables.load(spark, folder, "documents"), "text")


@query("AGG-2_filtered_max", f"SELECT max(o_totalprice) AS max_o_totalprice FROM orders WHERE {FILLED}")
def filtered_max(spark: SparkSession, folder: str) -> DataFrame:
    orders = tables.load(spark, folder, "orders")
    return counting.filtered_max(orders, F.expr(FILLED), "o_totalprice")


def _filled_summary(spark: SparkSession, folder: str, column: str) -> DataFrame:
    orders = tables.load(spark, folder, "orders")
    found = counting.filtered_summary(
        orders, F.expr(FILLED), "o_orderpriority", "o_totalprice", digits=2
    )
    return found.select("o_orderpriority", column)


@query(
    "AGG-3_filtered_count",
    f"SELECT o_orderpriority, count(*) AS n FROM orders WHERE {FILLED} GROUP BY 1",
)
def filtered_count(spark: SparkSession, folder: str) -> DataFrame:
    return _filled_summary(spark, folder, "n")


@query(
    "AGG-4_filtered_sum",
    f"""SELECT l_linestatus, {si.fsum('l_extendedprice', 2)} AS total FROM lineitem
        WHERE l_returnflag = 'R' GROUP BY 1""",
)
def filtered_sum(spark: SparkSession, folder: str) -> DataFrame:
    lines = tables.load(spark, folder, "lineitem")
    found = counting.filtered_summary(
        lines, F.col("l_returnflag") == "R", "l_linestatus", "l_extendedprice", digits=2
    )
    return found.select("l_linestatus", "total")


@query(
    "AGG-5_mean_per_key",
    f"""SELECT l_suppkey, count(*) AS n, {si.fsum('l_extendedprice', 2)} AS total,
               {si.fsum('l_extendedprice', 2)} / count(*) AS mean
        FROM lineitem WHERE l_returnflag = 'R' GROUP BY 1""",
)
def mean_per_key(spark: SparkSession, folder: str) -> DataFrame:
    lines = tables.load(spark, folder, "lineitem")
    return counting.filtered_summary(
        lines, F.col("l_returnflag") == "R", "l_suppkey", "l_extendedprice", digits=2
    )


#: Signed values over 84 powers of two, of which the SQL adds up the whole numbers.
_WIDE_SQL = "CASE WHEN l_returnflag = 'R' THEN -1 ELSE 1 END * l_quantity * pow(2, 12 * l_linenumber)"


@query(
    "AGG-5_exact_sum",
    f"""SELECT l_suppkey, count(*) AS n, CAST(sum(CAST({_WIDE_SQL} AS HUGEINT)) AS DOUBLE) / pow(2, 40) AS total
        FROM lineitem GROUP BY 1""",
)
def exact_sum(spark: SparkSession, folder: str) -> DataFrame:
    sign = F.when(F.col("l_returnflag") == "R", -1.0).otherwise(1.0)
    wide = sign * F.col("l_quantity") * F.pow(F.lit(2.0), 12 * F.col("l_linenumber") - 40)
    lines = tables.load(spark, folder, "lineitem").select("l_suppkey", wide.alias("wide"))
    return exact.exact_sums(lines, ["l_suppkey"], "wide")


@query(
    "AGG-6_distributor_window",
    f"{si.TO_LEVEL2} SELECT {si.record_sql('distributor_id')} FROM l2",
)
def distributor_window(spark: SparkSession, folder: str) -> DataFrame:
    return rollup.finish(si.level2(spark, folder))


@query(
    "AGG-7_concentrator_window",
    f"""{si.TO_LEVEL3} SELECT total_distributors,
        {si.record_sql('concentrator_id', 'district', 'zone_type')} FROM l3""",
)
def concentrator_window(spark: SparkSession, folder: str) -> DataFrame:
    return rollup.finish(si.level3(spark, folder))


@query(
    "AGG-8_weighted_mean",
    f"""{si.TO_LEVEL2} SELECT window_start,
        CAST(sum(voltage_units) AS BIGINT) / 1e2 / sum(total_meters) AS mean FROM l2 GROUP BY 1""",
)
def weighted_mean(spark: SparkSession, folder: str) -> DataFrame:
    l2 = rollup.finish(si.level2(spark, folder))
    mean = rollup.weighted_mean(F.col("avg_voltage"), F.col("total_meters"), model.VOLTAGE_DIGITS)
    return l2.groupBy("window_start").agg(mean.alias("mean"))


@query(
    "AGG-9_global_recap",
    f"{si.TO_LEVEL4} SELECT districts_reported, {si.record_sql()} FROM l4",
)
def global_recap(spark: SparkSession, folder: str) -> DataFrame:
    return rollup.finish(si.level4(spark, folder))


@query(
    "AGG-9_incremental_recap",
    f"{si.TO_LEVEL4} SELECT districts_reported, {si.record_sql()} FROM l4",
)
def incremental_recap(spark: SparkSession, folder: str) -> DataFrame:
    """Three batches, each with readings of old windows; one is sent twice."""
    table = incremental.RollUpTable(
        spark, scratch.new_path(spark, "roll-up"), si.hierarchy(spark, folder), si.PARENT_KEYS, band=si.BAND
    )
    readings = si.readings(spark, folder)
    for batch in (0, 1, 1, 2):
        table.merge(readings.where(F.col("meter_id") % 3 == batch), f"batch-{batch}")
    return rollup.finish(table.read("level4"))


def nested_recap(spark: SparkSession, folder: str, per_record: int = 4) -> DataFrame:
    """Recaps in several parts: a window of the given tables has up to 25 districts."""
    l3 = si.level3_table(spark, folder)
    children = rollup.finish(l3).select("window_start", "district", "total_meters", "total_energy_kwh")
    parents = rollup.recap(l3).select("window_start", "districts_reported", "total_meters")
    return rollup.nest_children(
        parents,
        children,
        ["window_start"],
        "district",
        "districts_reported",
        per_record=per_record,
        totals=["districts_reported", "total_meters"],
    )


@query(
    "AGG-10_nested_children",
    f"""{si.TO_LEVEL4},
        kids AS (SELECT window_start, min(district) AS first_child, max(district) AS last_child,
                 CAST(sum(total_meters) AS BIGINT) AS child_meters FROM l3 GROUP BY 1)
        SELECT window_start, districts_reported, total_meters,
               districts_reported AS children, first_child, last_child, child_meters, true AS numbered
        FROM l4 JOIN kids USING (window_start)""",
)
def nested_children(spark: SparkSession, folder: str) -> DataFrame:
    zero = F.lit(0).cast("bigint")
    meters = F.aggregate("districts", zero, lambda acc, d: acc + d["total_meters"])
    parts = F.array_sort(F.collect_list("part"))
    return nested_recap(spark, folder).groupBy("window_start").agg(
        F.sum("districts_reported").alias("districts_reported"),
        F.sum("total_meters").alias("total_meters"),
        F.sum(F.size("districts")).alias("children"),
        F.min(F.element_at("districts", 1)["district"]).alias("first_child"),
        F.max(F.element_at("districts", -1)["district"]).alias("last_child"),
        F.sum(meters).alias("child_meters"),
        (parts == F.sequence(F.lit(0), F.max("parts") - 1)).alias("numbered"),
    )


@query(
    "AGG-11_conditional_count",
    """SELECT event_type, count(*) FILTER (WHERE value < 2 OR value > 190) AS anomalies_count,
              count(*) AS n FROM events GROUP BY 1""",
)
def conditional_count(spark: SparkSession, folder: str) -> DataFrame:
    return tables.load(spark, folder, "events").groupBy("event_type").agg(
        F.count_if(bands.out_of_band(F.col("value"), si.BAND)).alias("anomalies_count"),
        F.count(F.lit(1)).alias("n"),
    )


@query("AGG-12_count_per_topic", TOPIC_COUNTS_SQL)
def count_per_topic(spark: SparkSession, folder: str) -> DataFrame:
    return counting.topic_counts(messages.message_frame(level_messages(spark, folder)))


@query(
    "AGG-13_zone_breakdown",
    f"""{si.TO_LEVEL3}, zones AS (
            SELECT zone_type, CAST(sum(energy_units) AS BIGINT) / 1e4 AS energy,
                   CAST(sum(total_meters) AS BIGINT) AS meters, count(*) AS districts,
                   CAST(sum(anomalies_count) AS BIGINT) AS anomalies FROM l3 GROUP BY 1)
        SELECT zone_type, energy, meters, districts, anomalies,
               round(energy / sum(energy) OVER () * 100, 6) AS pct FROM zones""",
)
def zone_breakdown(spark: SparkSession, folder: str) -> DataFrame:
    l3 = rollup.finish(si.level3(spark, folder))
    found = reports.group_breakdown(
        l3, "zone_type", "total_energy_kwh", "total_meters", "anomalies_count", model.ENERGY_DIGITS
    )
    return found.withColumn("pct", F.round("pct", 6))


@query(
    "AGG-14_total_row",
    """SELECT CASE WHEN grouping(n_name) = 1 THEN 'TOTAL' ELSE n_name END AS district,
              count(*) AS customers, CAST(grouping(n_name) AS INTEGER) AS is_total
       FROM customer JOIN nation ON c_nationkey = n_nationkey GROUP BY ROLLUP (n_name)""",
)
def total_row(spark: SparkSession, folder: str) -> DataFrame:
    customer = tables.load(spark, folder, "customer")
    nation = tables.load(spark, folder, "nation")
    counted = customer.groupBy("c_nationkey").agg(F.count(F.lit(1)).alias("customers"))
    named = counted.join(nation, counted.c_nationkey == nation.n_nationkey).select(
        F.col("n_name").alias("district"), "customers"
    )
    return reports.with_total_row(named, ["district"], ["customers"])


@query(
    "AGG-15_distinct_windows",
    "SELECT DISTINCT time_bucket(INTERVAL '15 minutes', ts) AS window_start FROM events",
)
def distinct_windows(spark: SparkSession, folder: str) -> DataFrame:
    start = rollup.tumbling("ts")["start"].alias("window_start")
    return series.distinct_windows(tables.load(spark, folder, "events").select(start), "window_start")


def energy_series(spark: SparkSession, folder: str) -> DataFrame:
    """Total energy per window."""
    start = rollup.tumbling("ts")["start"].alias("window_start")
    events = tables.load(spark, folder, "events").select(start, F.col("value").alias("energy"))
    return series.total_per_window(events, "window_start", "energy", model.ENERGY_DIGITS)


@query("AGG-16_series_total", f"WITH {si.SERIES_SQL} SELECT window_start, energy FROM series")
def series_total(spark: SparkSession, folder: str) -> DataFrame:
    return energy_series(spark, folder)


@query(
    "AGG-17_pivot",
    "SELECT time_bucket(INTERVAL '1 day', ts) AS day, "
    + ", ".join(
        f"CAST(sum({si.fx('value', 4)}) FILTER (WHERE event_type = '{t}') AS BIGINT) / 1e4 AS {t}"
        for t in si.EVENT_TYPES[:4]
    )
    + f""", CAST(sum({si.fx('value', 4)}) FILTER (WHERE event_type IS NULL OR event_type NOT IN
          ('click', 'error', 'purchase', 'signup')) AS BIGINT) / 1e4 AS other,
        CAST(sum({si.fx('value', 4)}) AS BIGINT) / 1e4 AS total FROM events GROUP BY 1""",
)
def pivot(spark: SparkSession, folder: str) -> DataFrame:
    events = tables.load(spark, folder, "events").select(
        F.date_trunc("day", F.col("ts")).cast("timestamp_ntz").alias("day"), "event_type", "value"
    )
    measure = fixed.fixed_sum("value", model.ENERGY_DIGITS)
    # One type is left out of the list on purpose: its rows are under "other".
    return reports.pivot_measure(
        events, "day", "event_type", si.EVENT_TYPES[:4], measure, other="other", total="total"
    )


@query(
    "AGG-18_level_counts",
    """SELECT (SELECT count(*) FROM customer) AS distributors,
              (SELECT count(*) FROM nation) AS districts, (SELECT count(*) FROM region) AS zones""",
)
def level_counts(spark: SparkSession, folder: str) -> DataFrame:
    return hierarchy.level_counts(
        {
            "distributors": (tables.load(spark, folder, "customer"), "c_custkey"),
            "districts": (tables.load(spark, folder, "nation"), "n_nationkey"),
            "zones": (tables.load(spark, folder, "region"), "r_regionkey"),
        }
    )


@query(
    "AGG-19_control_totals",
    """SELECT lang, CAST(sum(n_chars) AS BIGINT) AS declared,
              CAST(sum(length(text)) AS BIGINT) AS actual,
              sum(n_chars) = sum(length(text)) AS ok FROM documents GROUP BY lang""",
)
def control_totals(spark: SparkSession, folder: str) -> DataFrame:
    documents = tables.load(spark, folder, "documents")
    checked = hierarchy.control_totals(
        documents, ["lang"], F.sum("n_chars"), F.sum(F.length("text"))
    )
    return checked.select("lang", "declared", "actual", "ok")


@query(
    "AGG-20_vector_mean",
    """SELECT label, CAST(pos AS INTEGER) AS pos, round(avg(CAST(x AS DOUBLE)), 6) AS mean
       FROM (SELECT label, unnest(embedding) AS x, unnest(range(len(embedding))) AS pos
             FROM embeddings) GROUP BY 1, 2""",
)
def vector_mean(spark: SparkSession, folder: str) -> DataFrame:
    vectors = kmeans.mean_vectors(tables.load(spark, folder, "embeddings"), "label", "embedding")
    return vectors.select("label", F.posexplode("centroid").alias("pos", "mean")).select(
        "label", "pos", F.round("mean", 6).alias("mean")
    )


@query(
    "AGG-21_group_size",
    f"WITH {NEAREST_SQL} SELECT cluster, count(*) AS points FROM assigned GROUP BY 1",
)
def group_size(spark: SparkSession, folder: str) -> DataFrame:
    return kmeans.cluster_sizes(assigned(spark, folder))


@query(
    "AGG-22_member_lists",
    """SELECT c_nationkey, c_custkey // 500 AS block, count(*) AS n_members,
              string_agg(CAST(c_custkey AS VARCHAR), ',' ORDER BY c_custkey) AS members
       FROM customer GROUP BY 1, 2""",
)
def member_lists(spark: SparkSession, folder: str) -> DataFrame:
    customer = tables.load(spark, folder, "customer")
    lists = hierarchy.member_lists(customer, ["c_nationkey"], "c_custkey", block=500)
    return lists.select(
        "c_nationkey", "block", "n_members", F.array_join("members", ",").alias("members")
    )


@query("AGG-23_min_max", "SELECT min(value) + 0e0 AS low, max(value) + 0e0 AS high FROM events")
def min_max(spark: SparkSession, folder: str) -> DataFrame:
    events = tables.load(spark, folder, "events")
    # Adding zero turns a minimum of -0.0 into 0.0; which of the two wins is not defined.
    low, high = F.min("value") + F.lit(0.0), F.max("value") + F.lit(0.0)
    return events.agg(low.alias("low"), high.alias("high"))

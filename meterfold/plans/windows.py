"""Window functions: WIN-1..15."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from meterfold import scratch
from meterfold.functions import fixed, slots, text
from meterfold.operators import hierarchy, ordering, reports, rollup, series
from meterfold.plans import standins as si
from meterfold.plans.aggregations import energy_series
from meterfold.plans.registry import query
from meterfold.sources import history, tables
from meterfold.sources import rows as source_rows


def _day(column: str):
    return F.date_trunc("day", F.col(column))


@query(
    "WIN-1_rank_number",
    """SELECT row_number() OVER (ORDER BY o_totalprice DESC, o_orderkey) AS rank, o_orderkey,
              o_totalprice FROM orders ORDER BY 1 LIMIT 10""",
)
def rank_number(spark: SparkSession, folder: str) -> DataFrame:
    orders = tables.load(spark, folder, "orders").select("o_orderkey", "o_totalprice")
    return reports.top_n(orders, "o_totalprice", 10, "o_orderkey")


_CHANGE_SQL = """changes AS (
    SELECT window_start, energy, (energy - prev) / nullif(prev, 0) * 100 AS change_pct FROM (
        SELECT *, lag(energy) OVER (ORDER BY window_start) AS prev FROM (
            SELECT * FROM series ORDER BY window_start DESC LIMIT {n})))"""
_DIRECTION_SQL = """window_start, energy, change_pct,
    CASE WHEN change_pct >= 0 THEN 'up' WHEN change_pct < 0 THEN 'down' END AS direction"""


@query(
    "WIN-2_change",
    f"WITH {si.SERIES_SQL}, {_CHANGE_SQL.format(n=12)} SELECT {_DIRECTION_SQL} FROM changes",
)
def change(spark: SparkSession, folder: str) -> DataFrame:
    return series.with_change(energy_series(spark, folder), "window_start", "energy")


@query(
    "WIN-3_headline",
    f"""WITH {si.SERIES_SQL}, {_CHANGE_SQL.format(n=2)}
        SELECT {_DIRECTION_SQL} FROM changes ORDER BY window_start DESC LIMIT 1""",
)
def headline(spark: SparkSession, folder: str) -> DataFrame:
    return series.headline(energy_series(spark, folder), "window_start", "energy")


@query(
    "WIN-4_current_or_latest",
    f"""{si.TO_LEVEL3} SELECT district, window_start, total_meters, anomalies_count,
            window_start = (SELECT max(window_start) FROM l3) AS is_current
        FROM l3 QUALIFY row_number() OVER (PARTITION BY district ORDER BY
            window_start = (SELECT max(window_start) FROM l3) DESC, window_start DESC) = 1""",
)
def current_or_latest(spark: SparkSession, folder: str) -> DataFrame:
    l3 = si.level3_table(spark, folder).select("district", "window_start", "total_meters", "anomalies_count")
    return series.current_or_latest(l3, ["district"], "window_start")


@query(
    "WIN-5_latest_per_key",
    """SELECT user_id, event_id, ts, event_type, value FROM events
       QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) = 1""",
)
def latest_per_key(spark: SparkSession, folder: str) -> DataFrame:
    events = tables.load(spark, folder, "events").drop("props")
    return series.latest_per_key(events, ["user_id"], ["ts", "event_id"]).select(
        "user_id", "event_id", "ts", "event_type", "value"
    )


@query(
    "WIN-6_last_windows",
    """WITH placed AS (
           SELECT event_id, value, time_bucket(INTERVAL '15 minutes', ts) AS window_start FROM events)
       SELECT event_id, value, window_start FROM placed WHERE window_start IN (
           SELECT DISTINCT window_start FROM placed ORDER BY 1 DESC LIMIT 12)""",
)
def last_windows(spark: SparkSession, folder: str) -> DataFrame:
    start = rollup.tumbling("ts")["start"].alias("window_start")
    placed = tables.load(spark, folder, "events").select("event_id", "value", "ts", start)
    return series.in_last_windows(placed, "window_start", 12, "ts").drop("ts")


@query(
    "WIN-7_retention",
    f"""{si.TO_LEVEL3} SELECT district, window_start, total_meters, anomalies_count FROM l3
        QUALIFY dense_rank() OVER (ORDER BY window_start DESC) <= 96""",
)
def retention(spark: SparkSession, folder: str) -> DataFrame:
    l3 = si.level3_table(spark, folder).select("district", "window_start", "total_meters", "anomalies_count")
    return series.in_last_windows(l3, "window_start", 96)


@query(
    "WIN-7_snapshot_retention",
    f"""{si.TO_LEVEL4}, {si.CYCLES_SQL},
        log AS (
            SELECT 'district' AS kind, district, window_start, total_meters FROM l3
            UNION ALL SELECT 'cycle', NULL, window_start, total_meters FROM cycles),
        kept AS (SELECT * FROM log QUALIFY dense_rank() OVER (ORDER BY window_start DESC) <= 96)
        SELECT 'after' AS reader, kind, count(*) AS n, min(window_start) AS oldest,
               CAST(sum(total_meters) AS BIGINT) AS meters FROM kept GROUP BY kind
        UNION ALL
        SELECT 'before', kind, count(*), min(window_start), CAST(sum(total_meters) AS BIGINT)
        FROM log GROUP BY kind""",
)
def snapshot_retention(spark: SparkSession, folder: str) -> DataFrame:
    """A flat log is taken in and trimmed; a reader from before still has all rows."""
    flat, path = scratch.new_path(spark, "flat"), scratch.new_path(spark, "versions")
    l3 = si.level3_table(spark, folder)
    lines = history.history_lines(rollup.finish(l3), rollup.cycles(rollup.recap(l3)))
    source_rows.write_lines(lines, "value", flat)
    history.adopt_flat(spark, flat, path)
    before = history.committed_lines(spark, path)
    history.trim_committed(spark, path, 96)
    found = None
    for reader, log in (("before", before), ("after", history.committed_lines(spark, path))):
        counted = history.parse_lines(log).groupBy(F.lit(reader).alias("reader"), "kind").agg(
            F.count(F.lit(1)).alias("n"),
            text.parse_iso(F.min("window_start")).alias("oldest"),
            F.sum("total_meters").alias("meters"),
        )
        found = counted if found is None else found.unionByName(counted)
    return found


_NATION_SQL = f"""nations AS (
    SELECT c_nationkey, {si.fsum('c_acctbal', 2)} AS balance FROM customer GROUP BY 1)"""


def nation_balances(spark: SparkSession, folder: str) -> DataFrame:
    customer = tables.load(spark, folder, "customer")
    return customer.groupBy("c_nationkey").agg(fixed.fixed_sum("c_acctbal", 2).alias("balance"))


@query(
    "WIN-8_share",
    f"""WITH {_NATION_SQL} SELECT c_nationkey, balance,
        round(balance / nullif(sum(balance) OVER (), 0) * 100, 6) AS pct FROM nations""",
)
def share(spark: SparkSession, folder: str) -> DataFrame:
    found = reports.with_share(nation_balances(spark, folder), "balance")
    return found.withColumn("pct", F.round("pct", 6))


@query(
    "WIN-9_ratio_to_max",
    f"""WITH {_NATION_SQL} SELECT c_nationkey, balance,
        balance / max(balance) OVER () * 100 AS ratio FROM nations""",
)
def ratio_to_max(spark: SparkSession, folder: str) -> DataFrame:
    return reports.with_ratio_to_max(nation_balances(spark, folder), "balance")


@query(
    "WIN-10_plot_scale",
    f"""WITH {si.SERIES_SQL}, bounds AS (
            SELECT min(energy) AS lo, max(energy) AS hi FROM series),
        padded AS (SELECT lo - greatest(hi - lo, 1e0) * 0.05e0 AS lo,
                          hi + greatest(hi - lo, 1e0) * 0.05e0 AS hi FROM bounds)
        SELECT window_start, energy, (energy - lo) / (hi - lo) AS y FROM series, padded""",
)
def plot_scale(spark: SparkSession, folder: str) -> DataFrame:
    return reports.with_plot_scale(energy_series(spark, folder), "energy")


@query(
    "WIN-11_relative_position",
    f"""WITH {si.SERIES_SQL} SELECT window_start, energy,
        CASE WHEN count(*) OVER () = 1 THEN 0.5e0 ELSE
        (row_number() OVER (ORDER BY window_start) - 1) / CAST(count(*) OVER () - 1 AS DOUBLE)
        END AS x FROM series""",
)
def relative_position(spark: SparkSession, folder: str) -> DataFrame:
    # Numbering reads its input twice: the events are aggregated once, before.
    held = scratch.stored(energy_series(spark, folder), "series")
    placed = ordering.positions(held, ["window_start"], _day("window_start"), total="n")
    x = (F.col("position") - 1) / F.nullif(F.col("n") - 1, F.lit(0))
    return placed.select("window_start", "energy", F.coalesce(x, F.lit(0.5)).alias("x"))


@query(
    "WIN-12_running_total",
    """SELECT slot, count(*) AS sent, CAST(sum(count(*)) OVER (ORDER BY slot) AS BIGINT) AS total_sent
       FROM (SELECT time_bucket(INTERVAL '1 minute', ts) AS slot FROM events) GROUP BY slot""",
)
def running_total(spark: SparkSession, folder: str) -> DataFrame:
    slot = rollup.tumbling("ts", minutes=1)["start"].alias("slot")
    sent = tables.load(spark, folder, "events").select(slot).groupBy("slot").agg(
        F.count(F.lit(1)).alias("sent")
    )
    placed = ordering.positions(sent, ["slot"], _day("slot"), running={"total_sent": "sent"})
    return placed.drop("position")


@query(
    "WIN-13_window_number",
    """SELECT window_start, readings, dense_rank() OVER (ORDER BY window_start) AS cycle_id FROM (
           SELECT time_bucket(INTERVAL '15 minutes', ts) AS window_start, count(*) AS readings
           FROM events GROUP BY 1)""",
)
def window_number(spark: SparkSession, folder: str) -> DataFrame:
    start = rollup.tumbling("ts")["start"].alias("window_start")
    windows = tables.load(spark, folder, "events").groupBy(start).agg(
        F.count(F.lit(1)).alias("readings")
    )
    return ordering.positions(
        scratch.stored(windows, "windows"), ["window_start"], _day("window_start"), position="cycle_id"
    )


@query(
    "WIN-14_balanced_parents",
    """SELECT c_custkey, c_nationkey, CAST(ntile(7) OVER (
           PARTITION BY c_nationkey ORDER BY c_custkey) AS INTEGER) AS parent_no FROM customer""",
)
def balanced_parents(spark: SparkSession, folder: str) -> DataFrame:
    customer = tables.load(spark, folder, "customer").select("c_custkey", "c_nationkey")
    return hierarchy.balanced_parents(customer, ["c_nationkey"], "c_custkey", 7)


@query(
    "WIN-15_sequence_keys",
    """SELECT c_custkey, printf('GRD-%02d-MTR-%05d', c_nationkey, row_number() OVER (
           PARTITION BY c_nationkey ORDER BY c_custkey)) AS member_key FROM customer""",
)
def sequence_keys(spark: SparkSession, folder: str) -> DataFrame:
    customer = tables.load(spark, folder, "customer").select("c_custkey", "c_nationkey")
    parts = [F.lit("GRD"), F.lpad(F.col("c_nationkey").cast("string"), 2, "0"), F.lit("MTR")]
    keyed = hierarchy.sequence_keys(customer, ["c_nationkey"], "c_custkey", parts)
    return keyed.select("c_custkey", "member_key")


@query(
    "STR-6_slot_spread",
    """SELECT least((('0x' || md5(CAST(event_id AS VARCHAR)))::UHUGEINT % 900)::BIGINT // 60, 14) AS slot,
              count(*) AS meters FROM events GROUP BY 1""",
)
def slot_spread(spark: SparkSession, folder: str) -> DataFrame:
    slot = slots.window_slot(F.col("event_id").cast("string"))
    events = tables.load(spark, folder, "events").select(slot.alias("slot"))
    return events.groupBy("slot").agg(F.count(F.lit(1)).alias("meters"))

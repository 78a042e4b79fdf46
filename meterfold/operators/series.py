"""Time-series operators on aggregated windows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from meterfold.functions import fixed


def last_rows(series: DataFrame, time: str, n: int) -> DataFrame:
    """The last ``n`` rows of a series with one row per time."""
    return series.orderBy(F.desc(time)).limit(n)


def last_windows(rows: DataFrame, time: str, n: int) -> DataFrame:
    """The last ``n`` distinct times."""
    return rows.select(time).where(F.col(time).isNotNull()).distinct().orderBy(F.desc(time)).limit(n)


def in_last_windows(
    rows: DataFrame, time: str, n: int, event_time: str | None = None
) -> DataFrame:
    """Rows of the last ``n`` distinct times; 0 keeps all rows.

    The oldest time kept is one value, found by a top-N over distinct times. The
    rows are then filtered against it where they are scanned: no join, no rank.
    ``event_time`` names a stored column never earlier than its window: the same
    limit on it lets the scan skip old row groups.
    """
    if n < 0:
        raise ValueError("n must not be negative")
    if n == 0:
        return rows
    oldest = last_windows(rows, time, n).agg(F.min(time).alias("v")).scalar()
    kept = rows.where(F.col(time) >= oldest)
    return kept if event_time is None else kept.where(F.col(event_time) >= oldest)


def with_change(series: DataFrame, time: str, measure: str, last: int = 12) -> DataFrame:
    """Percent change against the previous row, over the last rows of a series.

    The cut comes first, so the oldest row shown has no change. A previous value
    of 0 gives none either. ``direction`` is ``up`` from 0 % on.
    """
    shown = last_rows(series, time, last)
    previous = F.lag(measure).over(Window.orderBy(time))
    change = (F.col(measure) - previous) / F.nullif(previous, F.lit(0.0)) * F.lit(100.0)
    direction = F.when(F.col("change_pct") >= 0, "up").when(F.col("change_pct") < 0, "down")
    return shown.withColumn("change_pct", change).withColumn("direction", direction)


def headline(series: DataFrame, time: str, measure: str) -> DataFrame:
    """The newest row with its change against the one before."""
    return last_rows(with_change(series, time, measure, last=2), time, 1)


def latest_per_key(rows: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """One row per key, the one with the largest order columns.

    Written as an aggregate, not a ranking: each task keeps its best row per key
    before the shuffle, so a hot key stays small.
    """
    rest = [c for c in rows.columns if c not in keys]
    newest = F.max_by(F.struct(*rest), F.struct(*order))
    return rows.groupBy(*keys).agg(newest.alias("_row")).select(*keys, "_row.*")


def current_or_latest(rows: DataFrame, keys: Sequence[str], time: str) -> DataFrame:
    """Row of the newest window per key, or the key's own latest row.

    The newest window holds the largest time of all, so a key that has a row in
    it has no later one: both cases are the latest row of the key.
    ``is_current`` tells them apart.
    """
    newest = rows.agg(F.max(time).alias("v")).scalar()
    latest = latest_per_key(rows, keys, [time])
    return latest.withColumn("is_current", F.col(time) == newest)


def row_at_or_latest(rows: DataFrame, keys: Sequence[str], time: str, current: object) -> DataFrame:
    """Row at a given time per key, or the key's latest row when it has none."""
    here = F.coalesce((F.col(time) == F.lit(current)).cast("int"), F.lit(0))
    return latest_per_key(rows.withColumn("_here", here), keys, ["_here", time]).drop("_here")


def total_per_window(rows: DataFrame, time: str, measure: str, digits: int) -> DataFrame:
    """Sum of a measure over all rows of a window."""
    return rows.groupBy(time).agg(fixed.fixed_sum(measure, digits).alias(measure))


def distinct_windows(rows: DataFrame, time: str) -> DataFrame:
    """All times in ascending order."""
    return rows.select(time).distinct().orderBy(time)

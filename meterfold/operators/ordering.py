"""Positions and running totals over large ordered sets.

A window function without a partition key sends every row to one task, and one
with a hot key sends a third of them there. Here the order is cut into buckets
by an expression that never decreases along it (a day, a block of ids). Rows
are numbered inside their bucket and shifted by the totals of the buckets
before it; only the bucket totals, one row each, are ever ordered as a whole.
:func:`sorted_positions` needs no such expression: it sorts the rows into ranges.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from meterfold import scratch

#: A monotonically increasing id is the partition number above so many bits of row number.
_ROW_BITS = 33


def id_block(column: str, width: int) -> Column:
    """Bucket for a whole-number order column: blocks of ``width`` ids.

    The division is one of whole numbers, so ids beyond 2^53 keep their block.
    """
    below = F.when((F.col(column) < 0) & (F.col(column) % width != 0), F.lit(1)).otherwise(F.lit(0))
    return F.expr(f"`{column}` div {int(width)}") - below


def spread_blocks(rows: DataFrame, column: str, blocks: int) -> Column:
    """Bucket for a whole-number order column: ``blocks`` parts of about equal size.

    The limits are approximate quantiles of the ids themselves, one aggregate
    over the column, so outliers and gaps do not matter and nothing is added to
    or taken from an id. The limits become literals: a bucket is found by a
    handful of comparisons.
    """
    shares = [i / blocks for i in range(1, blocks)]
    limits = []
    if shares:
        found = rows.agg(F.percentile_approx(column, shares, 20 * blocks).alias("v")).first()["v"]
        limits = sorted(set(found or []))

    def place(low: int, high: int) -> Column:
        """Number of limits below the id, among those from ``low`` to ``high``."""
        if low == high:
            return F.lit(low).cast("bigint")
        middle = (low + high) // 2
        above = F.col(column) > F.lit(limits[middle]).cast("bigint")
        return F.when(above, place(middle + 1, high)).otherwise(place(low, middle))

    return place(0, len(limits))


def positions(
    rows: DataFrame,
    order_by: Sequence[str],
    bucket: Column,
    keys: Sequence[str] = (),
    position: str = "position",
    total: str | None = None,
    running: Mapping[str, str] | None = None,
) -> DataFrame:
    """Add the 1-based place of each row along ``order_by`` within ``keys``.

    The rows are read twice, once for the bucket totals: pass a table or an
    aggregate, not a long chain of work.

    ``bucket`` must not decrease along ``order_by`` and ``order_by`` must be
    unique within ``keys``. ``total`` names a column for the number of rows of
    the key; ``running`` maps new columns to whole-number columns whose sum up
    to and including the row they hold.
    """
    running = dict(running or {})
    marked = rows.withColumn("_bucket", bucket)
    parts = [*keys, "_bucket"]
    counted = marked.groupBy(*parts).agg(
        F.count(F.lit(1)).alias("_rows"),
        *[F.sum(source).alias(f"_sum_{name}") for name, source in running.items()],
    )
    whole = Window.partitionBy(*keys)
    before = whole.orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    shifts = counted.select(
        *[F.col(c).alias(f"_k{i}") for i, c in enumerate(parts)],
        F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_rows_before"),
        F.sum("_rows").over(whole).alias("_rows_total"),
        *[
            F.coalesce(F.sum(f"_sum_{name}").over(before), F.lit(0)).alias(f"_before_{name}")
            for name in running
        ],
    )
    same = [marked[c].eqNullSafe(shifts[f"_k{i}"]) for i, c in enumerate(parts)]
    joined = marked.join(shifts, same, "inner")
    inside = Window.partitionBy(*parts).orderBy(*order_by)
    so_far = inside.rowsBetween(Window.unboundedPreceding, 0)
    added = [(F.col("_rows_before") + F.row_number().over(inside)).alias(position)]
    if total:
        added.append(F.col("_rows_total").alias(total))
    for name, source in running.items():
        added.append((F.col(f"_before_{name}") + F.sum(source).over(so_far)).alias(name))
    return joined.select(*rows.columns, *added)


def sorted_positions(
    rows: DataFrame,
    order_by: Sequence[str],
    keys: Sequence[str] = (),
    position: str = "position",
    total: str | None = None,
    partitions: int | None = None,
) -> DataFrame:
    """Add the 1-based place of each row along ``order_by`` within ``keys``.

    A sample sort with prefix sums: rows are dealt by ranges of (``keys``, ``order_by``),
    sorted inside each range and stored once with their number in it; the counts per
    range, few rows, give each range its shift. Ranges come from a sample of the rows
    themselves, so neither a hot key nor far outliers make one of them large. Rows
    that tie along all of ``order_by`` take places in any order.

    ``total`` names a column for the number of rows of the key. Nulls come first.
    """
    by = [*keys, *order_by]
    number = partitions or int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    place = F.monotonically_increasing_id()
    table = scratch.stored(
        rows.repartitionByRange(number, *by)
        .sortWithinPartitions(*by)
        .withColumn("_place", place)
        .withColumn("_range", F.shiftright("_place", _ROW_BITS))
        .withColumn("_place", F.col("_place").bitwiseAND(F.lit((1 << _ROW_BITS) - 1))),
        "sorted",
    )
    parts = [*keys, "_range"]
    counted = table.groupBy(*parts).agg(F.count(F.lit(1)).alias("_rows"), F.min("_place").alias("_first"))
    whole = Window.partitionBy(*keys)
    before = whole.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    shifts = counted.select(
        *[F.col(c).alias(f"_k{i}") for i, c in enumerate(parts)],
        (F.coalesce(F.sum("_rows").over(before), F.lit(0)) - F.col("_first") + 1).alias("_shift"),
        F.sum("_rows").over(whole).alias("_total"),
    )
    same = [table[c].eqNullSafe(shifts[f"_k{i}"]) for i, c in enumerate(parts)]
    added = [(F.col("_place") + F.col("_shift")).alias(position)]
    if total:
        added.append(F.col("_total").alias(total))
    return table.join(shifts, same).select(*rows.columns, *added)

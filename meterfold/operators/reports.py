"""Reports on aggregated rows: shares, totals, top-N, outliers."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from meterfold.functions import bands, fixed
from meterfold.model import Band


def _total(rows: DataFrame, value: Column) -> Column:
    """An aggregate over all rows as a scalar subquery: one row, no shuffle of detail."""
    return rows.agg(value.alias("v")).scalar()


def with_share(rows: DataFrame, measure: str, share: str = "pct", scale: float = 100.0) -> DataFrame:
    """Share of the total; 0 when the total is 0."""
    total = F.nullif(_total(rows, F.sum(measure)), F.lit(0))
    value = F.col(measure) / total * F.lit(scale)
    return rows.withColumn(share, F.coalesce(value, F.lit(0.0)))


def with_ratio_to_max(
    rows: DataFrame, measure: str, ratio: str = "ratio", scale: float = 100.0
) -> DataFrame:
    """Value relative to the largest one; a largest value of 0 counts as 1."""
    top = _total(rows, F.max(measure))
    divisor = F.when(top == 0, F.lit(1.0)).otherwise(top)
    return rows.withColumn(ratio, F.col(measure) / divisor * F.lit(scale))


def with_plot_scale(
    rows: DataFrame, measure: str, position: str = "y", padding: float = 0.05
) -> DataFrame:
    """Place between the padded minimum (0) and maximum (1) of all rows."""
    low, high = _total(rows, F.min(measure)), _total(rows, F.max(measure))
    margin = F.greatest(high - low, F.lit(1.0)) * F.lit(padding)
    bottom, top = low - margin, high + margin
    return rows.withColumn(position, (F.col(measure) - bottom) / (top - bottom))


def with_total_row(
    rows: DataFrame, keys: Sequence[str], sums: Sequence[str], label: str = "TOTAL"
) -> DataFrame:
    """Detail rows and one row of sums named ``label`` in the first key."""
    first, *others = keys
    parts = rows.groupBy(*keys).agg(*[F.sum(c).alias(c) for c in sums])
    total = parts.agg(*[F.sum(c).alias(c) for c in sums])
    named = total.select(
        F.lit(label).alias(first), *[F.lit(None).cast("string").alias(c) for c in others], *sums
    )
    detail = parts.withColumn("is_total", F.lit(0))
    return detail.unionByName(named.withColumn("is_total", F.lit(1)))


def top_n(
    rows: DataFrame,
    measure: str,
    n: int,
    tie_break: str,
    rank: str | None = "rank",
) -> DataFrame:
    """The ``n`` rows with the largest measure, numbered from 1.

    Sorting and cutting happen per task first; only the winners are numbered.
    """
    order = [F.desc(measure), F.asc(tie_break)]
    best = rows.orderBy(*order).limit(n)
    if rank is None:
        return best
    number = F.row_number().over(Window.orderBy(*order)).cast("bigint")
    return best.withColumn(rank, number)


def top_outliers(
    rows: DataFrame,
    measure: str,
    n: int,
    tie_break: str,
    band: Band = Band(),
) -> DataFrame:
    """Out-of-band rows farthest from nominal, with the number of all of them."""
    found = rows.where(bands.out_of_band(F.col(measure), band))
    counted = found.agg(F.count(F.lit(1)).alias("v")).scalar()
    distance = F.abs(F.col(measure) - F.lit(band.nominal))
    ranked = top_n(found.withColumn("distance", distance), "distance", n, tie_break)
    return ranked.withColumn("side", bands.band_side(F.col(measure), band)).withColumn(
        "detected", counted
    )


def top_with_required(
    rows: DataFrame,
    measure: str,
    tie_break: str,
    category: str,
    required: str,
    n: int = 5,
) -> DataFrame:
    """Top ``n``, plus the best row of a required category when none made it."""
    best = top_n(rows, measure, n, tie_break)
    wanted = F.col(category) == F.lit(required)
    present = best.where(wanted)
    extra = top_n(rows.where(wanted), measure, 1, tie_break, rank=None)
    extra = extra.where(~present.exists()).withColumn("rank", F.lit(n + 1).cast("bigint"))
    return best.unionByName(extra)


def group_breakdown(
    rows: DataFrame,
    category: str,
    energy: str,
    meters: str,
    anomalies: str,
    digits: int,
) -> DataFrame:
    """Sums per category with the number of rows and the share of energy.

    The total is taken over the category rows, of which there are a handful, so
    the rows themselves are read once.
    """
    grouped = rows.groupBy(category).agg(
        fixed.fixed_sum(energy, digits).alias("energy"),
        F.sum(meters).alias("meters"),
        F.count(F.lit(1)).alias("districts"),
        F.sum(anomalies).alias("anomalies"),
    )
    total = F.nullif(F.sum("energy").over(Window.partitionBy()), F.lit(0))
    share = F.coalesce(F.col("energy") / total * F.lit(100.0), F.lit(0.0))
    return grouped.withColumn("pct", share)


def pivot_measure(
    rows: DataFrame,
    index: str,
    columns: str,
    values: Sequence[str],
    measure: Column,
    other: str | None = None,
    total: str | None = None,
) -> DataFrame:
    """One column per listed value; the list is given, so no pass looks for it.

    No row is lost: those with a value that is not in the list, or with none,
    count in the column ``other``, and raise an error if that is not asked for.
    ``total`` names a column over all rows. ``measure`` is an aggregate that can
    be taken over any rows.
    """
    listed = F.col(columns).isin(list(values))
    unlisted = F.concat(F.lit("value is not listed: "), F.coalesce(F.col(columns), F.lit("null")))
    rest = F.lit(other) if other else F.raise_error(unlisted).cast("string")
    placed = rows.withColumn(columns, F.when(listed, F.col(columns)).otherwise(rest))
    wanted = [*values, *([other] if other else [])]
    if total is None:
        return placed.groupBy(index).pivot(columns, wanted).agg(measure)
    if total in wanted:
        raise ValueError(f"{total} is the name of a value")
    # Cells and totals come from one scan and one shuffle of partial rows; the pivot sees cells only.
    both = placed.groupingSets([[F.col(index), F.col(columns)], [F.col(index)]], index, columns)
    cells = both.agg(measure.alias("_cell"), F.grouping(columns).alias("_whole"))
    named = cells.withColumn(columns, F.when(F.col("_whole") == 1, F.lit(total)).otherwise(F.col(columns)))
    return named.groupBy(index).pivot(columns, [*wanted, total]).agg(F.max("_cell"))

"""Joins: look-ups with defaults, parents of readings, dense grids."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from meterfold import model


def look_up(
    facts: DataFrame, table: DataFrame, on: Sequence[str], defaults: Mapping[str, object]
) -> DataFrame:
    """Left join to a look-up table; its missing values take the defaults."""
    joined = facts.join(table, list(on), "left")
    added = [
        F.coalesce(table[c], F.lit(defaults[c])).alias(c) if c in defaults else table[c]
        for c in table.columns
        if c not in on
    ]
    return joined.select(*[facts[c] for c in facts.columns], *added)


def parents_with_readings(parents: DataFrame, readings: DataFrame, on: str) -> DataFrame:
    """Parents that have at least one reading.

    The reading keys are made distinct first: map tasks drop repeats, so a hot
    key crosses the shuffle once per task instead of once per reading.
    """
    return parents.join(readings.select(on).distinct(), on, "left_semi")


def dense_grid(
    series: DataFrame,
    steps: DataFrame,
    facts: DataFrame,
    keys: Sequence[str],
    step: str,
    measure: str,
    missing: object = 0.0,
    last: int = model.HISTORY_WINDOWS,
    written: str | None = None,
) -> DataFrame:
    """Every series at every one of the ``last`` steps; a gap holds ``missing``.

    The steps, ``last`` of them at most, are folded into a single array and
    unfolded next to each series, so no pair of rows is ever joined to find the
    grid. A step may be in ``facts`` several times for a series, as in a log of
    repeated attempts: the row with the largest ``written`` counts, without that
    column the one with the largest measure. Each cell is one row.
    """
    newest = steps.select(step).distinct().orderBy(F.desc(step)).limit(last)
    folded = newest.agg(F.array_sort(F.collect_list(step)).alias("steps"))
    value = F.max_by(measure, written) if written else F.max(measure)
    facts = facts.groupBy(*keys, step).agg(value.alias(measure))
    grid = (
        series.select(*keys).distinct()
        .withColumn("_steps", folded.scalar())
        .select(*keys, F.explode_outer("_steps").alias(step))
        .where(F.col(step).isNotNull())
    )
    on = [*keys, step]
    return grid.join(facts.select(*on, measure), on, "left").select(
        *on, F.coalesce(F.col(measure), F.lit(missing)).alias(measure)
    )

"""Word counts and filtered aggregates per key."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from meterfold.functions import fixed, text


def tokens(lines: DataFrame, column: str, token: str = "word") -> DataFrame:
    """One row per token of each line."""
    return lines.select(F.explode(text.words(F.col(column))).alias(token))


def word_count(lines: DataFrame, column: str) -> DataFrame:
    """Occurrences of each token, most frequent first.

    Repeats are added up in the map tasks, so a word that makes up a third of
    the text crosses the shuffle once per task.
    """
    counted = tokens(lines, column).groupBy("word").agg(F.count(F.lit(1)).alias("n"))
    return counted.orderBy(F.desc("n"), F.asc("word"))


def filtered_max(rows: DataFrame, keep: Column, measure: str) -> DataFrame:
    """Largest measure of the rows that pass the filter."""
    return rows.where(keep).agg(F.max(measure).alias(f"max_{measure}"))


def filtered_summary(
    rows: DataFrame, keep: Column, key: str, measure: str, digits: int
) -> DataFrame:
    """Count, sum and mean per key of the rows that pass the filter, in one pass."""
    return rows.where(keep).groupBy(key).agg(
        F.count(F.lit(1)).alias("n"),
        fixed.fixed_sum(measure, digits).alias("total"),
        fixed.fixed_mean(measure, digits).alias("mean"),
    )


def topic_counts(messages: DataFrame, topic: str = "topic") -> DataFrame:
    """Number of messages per topic."""
    return messages.groupBy(topic).agg(F.count(F.lit(1)).alias("messages"))

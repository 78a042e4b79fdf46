"""Repeatable samples."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def sample_rows(rows: DataFrame, k: int, seed: int, row_id: str) -> DataFrame:
    """``k`` rows without replacement.

    Rows are ordered by a digest of seed and id: the draw depends on neither the
    partitioning nor the engine, and each task only keeps its own first ``k``.
    """
    draw = F.md5(F.concat(F.lit(f"{seed}-"), F.col(row_id).cast("string")).cast("binary"))
    return rows.orderBy(draw, row_id).limit(k)


def preview(rows: DataFrame, n: int, *order: str) -> DataFrame:
    """First ``n`` rows in a fixed order."""
    return rows.orderBy(*order).limit(n)

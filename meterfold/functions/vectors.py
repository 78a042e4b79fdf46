"""Vectors held as arrays of doubles."""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F

from meterfold.functions.text import strip


def parse_vector(line: Column) -> Column:
    """Numbers of a comma-separated line."""
    return F.transform(F.split(strip(line), ","), lambda x: F.trim(x).cast("double"))


def centroid_table(centroids: Sequence[Sequence[float]]) -> Column:
    """k x d numbers as one literal; k and d are the caller's, not the data's."""
    rows = [", ".join(f"{float(x)!r}D" for x in c) for c in centroids]
    return F.expr("array(" + ", ".join(f"array({row})" for row in rows) + ")")


def euclidean(a: Column, b: Column) -> Column:
    """Distance between two vectors of equal length."""
    gaps = F.zip_with(a, b, lambda x, y: x - y)
    return F.sqrt(F.aggregate(gaps, F.lit(0.0), lambda acc, gap: acc + gap * gap))


def matrix(batch: pa.Array, width: int) -> tuple[np.ndarray, np.ndarray]:
    """The vectors of an Arrow column that are there, and marks for which those are.

    A vector of another length, or with a missing number, raises an error.
    """
    present = batch.is_valid().to_numpy(zero_copy_only=False)
    lengths = batch.value_lengths().to_numpy(zero_copy_only=False)[present]
    if (lengths != width).any():
        raise ValueError(f"a vector has {int(lengths[lengths != width][0])} numbers instead of {width}")
    numbers = batch.flatten()
    if numbers.null_count:
        raise ValueError("a vector lacks a number")
    return numbers.to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, width), present


def distances(rows: np.ndarray, table: np.ndarray) -> np.ndarray:
    """Distance of every row to every row of ``table``."""
    squares = np.empty((len(rows), len(table)))
    for i, centroid in enumerate(table):
        gaps = rows - centroid
        np.einsum("ij,ij->i", gaps, gaps, out=squares[:, i])
    return np.sqrt(squares)


def nearest(rows: np.ndarray, table: np.ndarray) -> np.ndarray:
    """Index of the nearest row of ``table``; the lowest index wins a tie."""
    return distances(rows, table).argmin(axis=1).astype(np.int32)


def nearest_with_slack(rows: np.ndarray, table: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The nearest row of ``table``, and by how much the second nearest is farther.

    The slack is a little less than the true one, by more than distances are rounded.
    """
    held = distances(rows, table)
    found = held.argmin(axis=1).astype(np.int32)
    every = np.arange(len(rows))
    first = held[every, found]
    held[every, found] = np.inf
    second = held.min(axis=1)
    doubt = 1e-9 * (first + np.where(np.isinf(second), 0.0, second) + np.abs(table).max())
    return found, second - first - doubt


def of_length(vector: Column, width: int) -> Column:
    """The vector; null stays null, another length raises an error."""
    message = F.concat(F.lit("a vector has "), F.size(vector).cast("string"), F.lit(f" numbers instead of {width}"))
    return F.when(F.size(vector) == width, vector).when(vector.isNotNull(), F.raise_error(message).cast("array<double>"))


def nearest_in_arrow(point: Column, centroids: Sequence[Sequence[float]]) -> Column:
    """Index of the nearest centroid, worked out per Arrow batch.

    Same rule as :func:`euclidean` with :func:`first_smallest`; for large
    k x d the batch arithmetic outweighs the transfer to the Python worker.
    """
    table = np.array(centroids, dtype=np.float64)

    @F.arrow_udf("int")
    def place(batch: pa.Array) -> pa.Array:
        rows, present = matrix(batch, table.shape[1])
        found = np.zeros(len(batch), dtype=np.int32)
        found[present] = nearest(rows, table)
        return pa.array(found, mask=~present)

    return place(point)


def first_smallest(distances: Column) -> Column:
    """Zero-based place of the smallest element; the first one on a tie."""
    return (F.array_position(distances, F.array_min(distances)) - 1).cast("int")

"""Headerless CSV, text lines, vectors in text, literal rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from meterfold.functions import vectors

PURCHASE_COLUMNS = ("id", "product", "spent", "rating")


def read_csv(spark: SparkSession, path: str, columns: Sequence[str] = PURCHASE_COLUMNS) -> DataFrame:
    """Headerless CSV with positional columns, all text until cast."""
    schema = ", ".join(f"`{c}` STRING" for c in columns)
    return spark.read.schema(schema).csv(path, header=False)


def write_csv(rows: DataFrame, path: str) -> None:
    """Headerless CSV copy of the rows."""
    rows.write.mode("errorifexists").csv(path, header=False)


def read_lines(spark: SparkSession, path: str) -> DataFrame:
    """Text file as one row per line."""
    return spark.read.text(path, lineSep="\n").withColumnRenamed("value", "line")


def write_lines(rows: DataFrame, column: str, path: str, mode: str = "append") -> None:
    """One text line per row."""
    rows.select(F.col(column).alias("value")).write.mode(mode).text(path, lineSep="\n")


def read_points(spark: SparkSession, path: str, into: str = "point") -> DataFrame:
    """Comma-separated numbers, one vector per line."""
    return read_lines(spark, path).select(vectors.parse_vector(F.col("line")).alias(into))


def literal_rows(spark: SparkSession, rows: Sequence[tuple], schema: str) -> DataFrame:
    """Rows given in code."""
    return spark.createDataFrame(list(rows), schema)

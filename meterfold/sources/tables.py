"""Parquet tables of a data folder.

The layouts are given, so opening a table reads no file footer and a query is
planned without running a job.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

SCHEMAS = {
    "region": "r_regionkey INT, r_name STRING",
    "nation": "n_nationkey INT, n_name STRING, n_regionkey INT",
    "customer": "c_custkey BIGINT, c_name STRING, c_nationkey INT, c_acctbal DOUBLE, c_mktsegment STRING",
    "supplier": "s_suppkey BIGINT, s_name STRING, s_nationkey INT, s_acctbal DOUBLE",
    "orders": """o_orderkey BIGINT, o_custkey BIGINT, o_orderstatus STRING, o_totalprice DOUBLE,
                 o_orderdate TIMESTAMP_NTZ, o_orderpriority STRING""",
    "lineitem": """l_orderkey BIGINT, l_partkey BIGINT, l_suppkey BIGINT, l_linenumber INT,
                   l_quantity DOUBLE, l_extendedprice DOUBLE, l_discount DOUBLE, l_tax DOUBLE,
                   l_returnflag STRING, l_linestatus STRING, l_shipdate TIMESTAMP_NTZ""",
    "events": """event_id BIGINT, ts TIMESTAMP_NTZ, user_id BIGINT, event_type STRING,
                 value DOUBLE, props STRING""",
    "documents": "doc_id BIGINT, text STRING, lang STRING, source STRING, n_chars BIGINT",
    "embeddings": "vec_id BIGINT, embedding ARRAY<FLOAT>, label INT",
}


def table_path(folder: str, name: str) -> str:
    return f"{folder.rstrip('/')}/{name}.parquet"


def load(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """One table of the folder; a name without a layout is read with the file's own."""
    reader = spark.read
    if name in SCHEMAS:
        reader = reader.schema(SCHEMAS[name])
    return reader.parquet(table_path(folder, name))


def stream(
    spark: SparkSession,
    folder: str,
    name: str,
    schema: StructType | str | None = None,
    files_per_batch: int | None = None,
) -> DataFrame:
    """The files of one table as a stream.

    The pattern matches a table stored as one file or as a folder of files, and
    nothing else whose name begins like it.
    ``files_per_batch`` bounds what a batch takes on; files then arrive in the
    order of their age, and readings behind the watermark are late.
    """
    layout = schema or SCHEMAS.get(name) or load(spark, folder, name).schema
    reader = spark.readStream.schema(layout)
    if files_per_batch is not None:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.parquet(f"{table_path(folder, name)[:-1]}[t]")

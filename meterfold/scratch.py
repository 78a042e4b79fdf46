"""Shared folder for tables a job writes and reads back."""

from __future__ import annotations

import contextlib
import tempfile
import uuid
import weakref
from collections.abc import Callable, Iterator

from pyspark.sql import DataFrame, SparkSession

#: Spark drops the shuffle files of a finished statement while this holds.
_DROP_SHUFFLES = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
_LOCAL_FOLDER: str | None = None
_CREATED: list[str] = []
_PATHS: weakref.WeakKeyDictionary[DataFrame, str] = weakref.WeakKeyDictionary()


def shared_folder(spark: SparkSession) -> str:
    """Folder named by ``spark.checkpoint.dir``.

    Only a ``local`` session without that setting gets a folder of its own;
    on a cluster a machine-local folder would be invisible to the executors.
    """
    global _LOCAL_FOLDER
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder all executors can reach")
    if _LOCAL_FOLDER is None:
        _LOCAL_FOLDER = tempfile.mkdtemp(prefix="meterfold-")
    return _LOCAL_FOLDER


def new_path(spark: SparkSession, label: str) -> str:
    """A fresh path below the shared folder."""
    path = f"{shared_folder(spark)}/meterfold/{label}-{uuid.uuid4().hex}"
    _CREATED.append(path)
    return path


def stored(rows: DataFrame, label: str) -> DataFrame:
    """Write a frame that several branches read, and read it back.

    A roll-up level is small next to the readings it comes from. Written once,
    it saves each branch a pass over the readings (branches that need different
    columns share no shuffle), and its size is known when joins are planned. The
    shuffle files that led to it go as soon as it is written.
    """
    return _written(rows, new_path(rows.sparkSession, label))


def _written(rows: DataFrame, path: str) -> DataFrame:
    spark = rows.sparkSession
    before = spark.conf.get(_DROP_SHUFFLES)
    spark.conf.set(_DROP_SHUFFLES, "true")
    try:
        rows.write.parquet(path)
    finally:
        spark.conf.set(_DROP_SHUFFLES, before)
    found = spark.read.schema(rows.schema).parquet(path)
    _PATHS[found] = path
    return found


def finished(spark: SparkSession, label: str, build: Callable[[], DataFrame]) -> DataFrame:
    """The rows that ``build`` gives, stored; what it stored on the way is deleted."""
    path = new_path(spark, label)
    with job(spark):
        return _written(build(), path)


def release(*frames: DataFrame) -> None:
    """Delete tables that ``stored`` wrote, once nothing is left that reads them."""
    for rows in frames:
        path = _PATHS.pop(rows, None)
        if path is not None and path in _CREATED:
            _CREATED.remove(path)
            delete(rows.sparkSession, path)


@contextlib.contextmanager
def job(spark: SparkSession) -> Iterator[None]:
    """Delete what is stored inside the block when it ends, and nothing else.

    Frames that read stored tables must be used up before. Blocks may be nested;
    what other threads store meanwhile belongs to the innermost open block.
    """
    first = len(_CREATED)
    try:
        yield
    finally:
        own = _CREATED[first:]
        del _CREATED[first:]
        for path in own:
            delete(spark, path)


def clear(spark: SparkSession) -> None:
    """Delete all that this process put into the shared folder."""
    while _CREATED:
        delete(spark, _CREATED.pop())


def delete(spark: SparkSession, path: str) -> bool:
    """Delete ``path`` through the Hadoop file system that owns it."""
    jvm = spark.sparkContext._jvm
    target = jvm.org.apache.hadoop.fs.Path(path)
    fs = target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return fs.delete(target, True)


def exists(spark: SparkSession, path: str) -> bool:
    """Whether there is a file or folder at ``path``."""
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(target)


def list_folders(spark: SparkSession, path: str) -> list[str]:
    """Names of the folders directly below ``path``."""
    jvm = spark.sparkContext._jvm
    target = jvm.org.apache.hadoop.fs.Path(path)
    fs = target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if not fs.exists(target):
        return []
    return sorted(s.getPath().getName() for s in fs.listStatus(target) if s.isDirectory())

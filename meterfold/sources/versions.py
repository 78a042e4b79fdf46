"""Tables of unchanging segments behind a numbered manifest.

Writers put files into a segment of their own and then commit a manifest that names it:
one small file, created under the next version number, last. Readers take the segments
of the newest manifest and nothing else, so

* a job that fails half-way leaves files that nobody reads, and its repetition under the
  same batch name is taken once;
* a segment can be replaced (retention, merging) without touching a reader that has the
  older version open, until :func:`vacuum` deletes what no kept version names.

Manifests are read and written through the file system that owns the path. Of two
writers that commit the same version one fails and starts over.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Iterable
from dataclasses import asdict, dataclass, replace

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from meterfold import scratch

_DIGITS = 12


class Conflict(RuntimeError):
    """Another writer has committed this version."""


@dataclass(frozen=True)
class Segment:
    """A folder of files. ``key`` tells segments of one table apart (a day, a level and day)."""

    path: str
    key: str = ""
    batch: str = ""


@dataclass(frozen=True)
class Written:
    """What a batch has written: rows and a sum of row digests, for :func:`verified`."""

    batch: str
    folder: str
    rows: int
    checksum: str


@dataclass(frozen=True)
class Manifest:
    version: int = 0
    segments: tuple[Segment, ...] = ()
    batches: tuple[Written, ...] = ()

    def has(self, batch: str) -> bool:
        return any(w.batch == batch for w in self.batches)

    def of(self, keys: Iterable[str] | None = None) -> list[Segment]:
        wanted = None if keys is None else set(keys)
        return [s for s in self.segments if wanted is None or s.key in wanted]


def _system(spark: SparkSession, path: str):
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), target


def _name(path: str, version: int) -> str:
    return f"{path}/versions/{version:0{_DIGITS}d}.json"


def versions(spark: SparkSession, path: str) -> list[int]:
    """Committed versions, oldest first."""
    fs, folder = _system(spark, f"{path}/versions")
    if not fs.exists(folder):
        return []
    names = [s.getPath().getName() for s in fs.listStatus(folder)]
    return sorted(int(n[:_DIGITS]) for n in names if n.endswith(".json") and n[:_DIGITS].isdigit())


def manifest(spark: SparkSession, path: str, version: int | None = None) -> Manifest:
    """A version of the table, the newest by default; version 0 is empty."""
    known = versions(spark, path)
    if version is None:
        version = known[-1] if known else 0
    if version == 0:
        return Manifest()
    fs, file = _system(spark, _name(path, version))
    stream = fs.open(file)
    try:
        held = json.loads(spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))
    finally:
        stream.close()
    return Manifest(
        held["version"],
        tuple(Segment(**s) for s in held["segments"]),
        tuple(Written(**w) for w in held["batches"]),
    )


def _digest(rows: DataFrame) -> Column:
    return F.coalesce(F.sum(F.xxhash64(*rows.columns).cast("decimal(38,0)")), F.lit(0)).cast("string")


def write(
    rows: DataFrame, path: str, batch: str, form: str = "text", by: str | None = None
) -> tuple[list[Segment], Written]:
    """Write rows into a new folder that no reader sees yet.

    ``by`` names a column whose values become the keys of one segment each; it is not stored.
    """
    spark = rows.sparkSession
    folder = f"{path}/segments/{uuid.uuid4().hex}"
    stored = rows.drop(by) if by else rows
    seen = Observation()
    watched = rows.observe(seen, F.count(F.lit(1)).alias("rows"), _digest(stored).alias("checksum"))
    writer = watched.write.format(form)
    if form == "text":
        writer = writer.option("lineSep", "\n")
    if by:
        writer = writer.partitionBy(by)
    writer.save(folder)
    keys = [name.partition("=")[2] for name in scratch.list_folders(spark, folder)] if by else []
    segments = [Segment(f"{folder}/{by}={k}", k, batch) for k in keys] if by else [Segment(folder, "", batch)]
    return segments, Written(batch, folder, seen.get["rows"], seen.get["checksum"])


def commit(
    spark: SparkSession,
    path: str,
    base: Manifest,
    add: Iterable[Segment] = (),
    drop: Iterable[Segment] = (),
    written: Written | None = None,
) -> Manifest:
    """Make the next version of ``base``: without ``drop``, with ``add``. Raises :class:`Conflict`."""
    gone = {s.path for s in drop}
    kept = tuple(s for s in base.segments if s.path not in gone)
    batches = base.batches + ((written,) if written else ())
    new = Manifest(base.version + 1, kept + tuple(add), batches)
    text = json.dumps(
        {"version": new.version, "segments": [asdict(s) for s in new.segments], "batches": [asdict(w) for w in batches]}
    )
    fs, final = _system(spark, _name(path, new.version))
    _, draft = _system(spark, f"{path}/versions/.{uuid.uuid4().hex}")
    stream = fs.create(draft, True)
    stream.write(bytearray(text.encode("utf-8")))
    stream.close()
    if fs.exists(final) or not fs.rename(draft, final):
        fs.delete(draft, False)
        raise Conflict(f"version {new.version} of {path} is there already")
    return new


def append(rows: DataFrame, path: str, batch: str, form: str = "text", by: str | None = None, tries: int = 5) -> bool:
    """Add the rows of a batch once; a batch that is committed is left alone. Whether rows were added."""
    spark = rows.sparkSession
    base = manifest(spark, path)
    if base.has(batch):
        return False
    segments, written = write(rows, path, batch, form, by)
    for attempt in range(tries):
        try:
            commit(spark, path, base, segments, written=written)
            return True
        except Conflict:
            if attempt == tries - 1:
                raise
            base = manifest(spark, path)
            if base.has(batch):
                return False
    return False


def read(
    spark: SparkSession,
    path: str,
    form: str = "text",
    schema: str | None = None,
    keys: Iterable[str] | None = None,
    version: int | None = None,
) -> DataFrame:
    """Rows of a version. The files are fixed when the frame is made; later commits do not change it."""
    schema = schema or "value string"
    segments = manifest(spark, path, version).of(keys)
    if not segments:
        return spark.createDataFrame([], schema)
    reader = spark.read.format(form).schema(schema)
    if form == "text":
        reader = reader.option("lineSep", "\n")
    return reader.load([s.path for s in segments])


def verified(spark: SparkSession, path: str, form: str = "text", schema: str | None = None) -> DataFrame:
    """Rows and digest of every committed batch as stored, next to those it was committed with.

    Only batches whose segments are all still part of the table are looked at.
    """
    held = manifest(spark, path)
    folders: dict[str, set[str]] = {}
    for s in held.segments:
        folders.setdefault(s.batch, set()).add(s.path)
    expected = [(w.batch, w.rows, w.checksum) for w in held.batches if w.batch in folders]
    found = None
    for batch, own in folders.items():
        reader = spark.read.format(form).schema(schema or "value string")
        rows = (reader.option("lineSep", "\n") if form == "text" else reader).load(sorted(own))
        counted = rows.agg(F.count(F.lit(1)).alias("found_rows"), _digest(rows).alias("found_checksum"))
        counted = counted.select(F.lit(batch).alias("batch"), "*")
        found = counted if found is None else found.union(counted)
    kinds = "batch string, rows bigint, checksum string"
    if found is None:
        return spark.createDataFrame([], f"{kinds}, found_rows bigint, found_checksum string, ok boolean")
    joined = spark.createDataFrame(expected, kinds).join(found, "batch")
    same = (F.col("rows") == F.col("found_rows")) & (F.col("checksum") == F.col("found_checksum"))
    return joined.withColumn("ok", same)


def vacuum(spark: SparkSession, path: str, keep: int = 2) -> list[str]:
    """Delete the segments that only versions before the last ``keep`` name, and those versions.

    Files of writers that have not committed are never touched.
    """
    if keep < 1:
        raise ValueError("the newest version is always kept")
    known = versions(spark, path)
    old, kept = known[:-keep], known[-keep:]
    live = {s.path for v in kept for s in manifest(spark, path, v).segments}
    gone = sorted({s.path for v in old for s in manifest(spark, path, v).segments} - live)
    for folder in gone:
        scratch.delete(spark, folder)
    for version in old:
        scratch.delete(spark, _name(path, version))
    return gone


def renamed(segments: Iterable[Segment], prefix: str) -> list[Segment]:
    """The segments with ``prefix`` before their keys, for several tables behind one manifest."""
    return [replace(s, key=f"{prefix}{s.key}") for s in segments]

"""Drop lines that several documents share."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from meterfold import scratch

MIN_DOCS, MIN_CHARS = 3, 20
_SPACE = b"\x20\x09\x0a\x0b\x0c\x0d"
_LOWER = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))

KEY = ["key_a", "key_b"]
KEYS = "key_a bigint, key_b bigint, doc_id bigint"
RESULT = "doc_id bigint, n_lines bigint, n_dropped bigint, kept_sha256 string, kept string"


def line_keys(text: bytes, min_chars: int) -> list[tuple[int, int] | None]:
    """The 128-bit key of every line as two signed numbers, None for a line that is too short."""
    found: list[tuple[int, int] | None] = []
    for line in text.translate(_LOWER).split(b"\n"):
        line = line.strip(_SPACE)
        if len(line) < min_chars or (len(line) < 4 * min_chars and len(line.decode("utf-8")) < min_chars):
            found.append(None)
            continue
        digest = xxhash.xxh3_128_digest(line)
        found.append((int.from_bytes(digest[:8], "little", signed=True), int.from_bytes(digest[8:], "little", signed=True)))
    return found


def _exploded(min_chars: int):
    """The different keys of every document."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows(keys: list, docs: list) -> pa.RecordBatch:
            first, second = zip(*keys)
            columns = [pa.array(c, pa.int64()) for c in (first, second, docs)]
            return pa.RecordBatch.from_arrays(columns, names=[*KEY, "doc_id"])

        for batch in batches:
            keys, docs = [], []
            for doc, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                own = set(line_keys(text.as_py().encode("utf-8"), min_chars)) - {None}
                keys.extend(own)
                docs.extend([doc] * len(own))
                if len(keys) > 100_000:
                    yield rows(keys, docs)
                    keys, docs = [], []
            if keys:
                yield rows(keys, docs)

    return run


def _reassembled(min_chars: int, with_text: bool):
    """Every row's lines without those whose keys are in ``gone``, in their order."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows: tuple[list, ...] = ([], [], [], [])
            for text, gone in zip(batch.column("text"), batch.column("gone")):
                data = (text.as_py() or "").encode("utf-8")
                n_lines, n_dropped = data.count(b"\n") + 1, 0
                if gone.is_valid:
                    drop = {(k["key_a"], k["key_b"]) for k in gone.as_py()}
                    lines = zip(data.split(b"\n"), line_keys(data, min_chars))
                    left = [line for line, key in lines if key not in drop]
                    n_dropped, data = n_lines - len(left), b"\n".join(left)
                kept = data.decode("utf-8") if with_text else None
                for held, value in zip(rows, (n_lines, n_dropped, hashlib.sha256(data).hexdigest(), kept)):
                    held.append(value)
            kinds = (pa.int64(), pa.int64(), pa.string(), pa.string())
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), *(pa.array(v, k) for v, k in zip(rows, kinds))],
                names=["doc_id", "n_lines", "n_dropped", "kept_sha256", "kept"],
            )

    return run


def common_lines(keys: DataFrame, min_docs: int = MIN_DOCS) -> DataFrame:
    """Keys held by at least ``min_docs`` documents, and the largest ``doc_id`` of each.

    The count goes through a shuffle on (key, document) first, so a line that a third of
    all documents hold arrives at its own task as one partial count per partition.
    """
    counted = keys.groupBy(*KEY).agg(F.count_distinct("doc_id").alias("n_docs"), F.max("doc_id").alias("last_doc"))
    return counted.where(F.col("n_docs") >= min_docs)


def without_common_lines(
    docs: DataFrame, min_docs: int = MIN_DOCS, min_chars: int = MIN_CHARS, with_text: bool = True
) -> DataFrame:
    """Every row of ``docs`` without the lines that at least ``min_docs`` documents hold.

    ``docs`` has ``doc_id`` and ``text``; other columns are not read. Lines end at ``\\n``; a
    null or empty text is one empty line. A line's key is the line without white space at
    its ends, A-Z in lower case; keys of fewer than ``min_chars`` code points stay. The
    document with the largest ``doc_id`` of a key keeps all its lines of that key.

    Rows with one ``doc_id`` are one document when documents are counted, whatever their
    texts, and each row comes back with its own lines. A row without a ``doc_id`` is not
    counted and stays whole. ``kept`` is the rest; a text that loses all lines is empty.

    Lines are exploded to 128-bit keys once and stored; their counts, the look-up of
    the common ones and the list of each document's lost keys are Spark shuffles. The
    look-up splits hot keys at run time, or broadcasts if the stored list is small.
    """
    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text"))
    held = rows.where("doc_id is not null and text is not null")
    keys = scratch.stored(held.mapInArrow(_exploded(min_chars), KEYS), "line-keys")
    common = scratch.stored(common_lines(keys, min_docs).select(*KEY, "last_doc"), "common-lines")
    lost = keys.join(common, KEY).where(F.col("doc_id") < F.col("last_doc"))
    gone = lost.groupBy("doc_id").agg(F.collect_set(F.struct(*KEY)).alias("gone"))
    joined = rows.join(gone, "doc_id", "left").select("doc_id", "text", "gone")
    return joined.mapInArrow(_reassembled(min_chars, with_text), RESULT)


_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"

SQL = f"""
WITH numbered AS (
    SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS parts FROM documents),
lines AS (
    SELECT doc_id, unnest(range(1, len(parts) + 1)) AS place, unnest(parts) AS line FROM numbered),
keyed AS (
    SELECT *, translate(trim(line, chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
                        '{_UPPER}', '{_UPPER.lower()}') AS key
    FROM lines),
common AS (
    SELECT key, max(doc_id) AS last_doc FROM keyed WHERE length(key) >= {MIN_CHARS}
    GROUP BY key HAVING count(DISTINCT doc_id) >= {MIN_DOCS}),
marked AS (
    SELECT k.doc_id, k.place, k.line, c.last_doc IS NOT NULL AND k.doc_id < c.last_doc AS gone
    FROM keyed k LEFT JOIN common c ON k.key = c.key)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (gone) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY place) FILTER (NOT gone), '')) AS kept_sha256
FROM marked GROUP BY doc_id
"""

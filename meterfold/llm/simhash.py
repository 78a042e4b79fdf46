"""Near-duplicate groups by SimHash, searched with covering masks."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from meterfold import scratch
from meterfold.llm.components import components

SEED = 42
#: A bucket up to this many fingerprints is compared in one go; a larger one is dealt
#: again by a second set of masks, which leaves 12 free bits and so no more than this.
BUCKET = 4096


def fingerprint(text: str | None, width: int = 3) -> int:
    """64 bits, each set if it is set in over half of the shingle hashes; 0 without words."""
    words = (text or "").encode("utf-8", "replace").lower().split()
    if not words:
        return 0
    width = min(width, len(words))
    line = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))
    votes, n = np.zeros(64, np.int64), len(words) - width + 1
    digest = xxhash.xxh64_intdigest
    for at in range(0, n, 1 << 15):
        to = min(n, at + (1 << 15))
        cuts = zip(starts[at:to].tolist(), ends[at + width - 1 : to + width - 1].tolist())
        hashes = np.fromiter((digest(line[s:e], SEED) for s, e in cuts), np.uint64, to - at)
        votes += np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype=np.int64)
    return int(np.packbits(votes * 2 > n, bitorder="little").view("<u8")[0])


def covering_masks(bits: list[int], radius: int) -> list[int]:
    """Masks of which every pair that differs in up to ``radius`` of ``bits`` shares one.

    Bit number i gets the vector i mod (2^(radius+1) - 1) + 1 of radius + 1 binary
    digits; mask v keeps the bits whose vector has an odd product with v. Up to
    radius vectors always leave some v that is orthogonal to all of them, and
    that mask keeps none of the differing bits.
    """
    count = (1 << (radius + 1)) - 1
    masks = []
    for v in range(1, count + 1):
        kept = [b for i, b in enumerate(bits) if ((i % count + 1) & v).bit_count() % 2]
        masks.append(sum(1 << b for b in kept))
    return masks


def _signed(number: int) -> int:
    return number - (1 << 64) if number >> 63 else number


def _stars(found: np.ndarray, radius: int) -> Iterator[tuple[int, np.ndarray]]:
    """Fingerprints of one bucket that reach each other: the first, and the others."""
    rest = found
    while len(rest) > 1:
        root, rest = rest[0], rest[1:]
        front, members = np.array([root], np.uint64), []
        while len(front) and len(rest):
            step, front = front[:128], front[128:]
            near = (np.bitwise_count(step[:, None] ^ rest[None, :]) <= radius).any(0)
            new, rest = rest[near], rest[~near]
            members.append(new)
            front = np.concatenate((front, new))
        if members and (others := np.concatenate(members)).size:
            yield root, others


def _linked(radius: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = [np.zeros(0, np.int64)] * 3

        def out(parts):
            a, b = [], []
            for x in parts:
                for root, others in _stars(x, radius):
                    a.append(np.full(len(others), root, np.uint64))
                    b.append(others)
            if a:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.concatenate(a).view(np.int64)), pa.array(np.concatenate(b).view(np.int64))], names=["a", "b"]
                )

        for batch in batches:
            cols = [np.concatenate((h, batch.column(i).to_numpy())) for i, h in enumerate(held)]
            if not len(cols[0]):
                continue
            new = np.flatnonzero((cols[0][1:] != cols[0][:-1]) | (cols[1][1:] != cols[1][:-1])) + 1
            last = new[-1] if len(new) else 0
            held = [c[last:] for c in cols]
            cuts = np.split(cols[2][:last].view(np.uint64), new[:-1]) if last else []
            yield from out(x for x in cuts if len(x) > 1)
        yield from out([held[2].view(np.uint64)])

    return run


def links(prints: DataFrame, radius: int = 2) -> DataFrame:
    """``a``, ``b``: links that join all fingerprints within ``radius`` bits, step by step.

    ``prints`` has the distinct bigint fingerprints ``fp``. Each goes to one bucket
    per covering mask; pairs outside a common bucket differ in more bits. A
    bucket gives one star for each set that hangs together, never all its pairs.
    """
    bits = list(range(64))
    first = covering_masks(bits, radius)

    def keyed(masks: list[tuple[int, int]]):
        return F.explode(F.array(*[
            F.struct(F.lit(t).cast("bigint").alias("t"), F.col("fp").bitwiseAND(F.lit(_signed(m))).alias("key"))
            for t, m in masks
        ])).alias("k")

    rows = prints.select("fp", keyed(list(enumerate(first)))).select("k.t", "k.key", "fp")
    rows = scratch.stored(
        rows.join(rows.groupBy("t", "key").agg(F.count("*").alias("n")).where("n > 1"), ["t", "key"]), "buckets"
    )
    parts = rows.where(F.col("n") <= BUCKET).select("t", "key", "fp")
    for t, mask in enumerate(first):
        free = [b for b in bits if not mask >> b & 1]
        again = [(100 * (t + 1) + i, mask | m) for i, m in enumerate(covering_masks(free, radius))]
        parts = parts.union(
            rows.where((F.col("n") > BUCKET) & (F.col("t") == t)).select("fp", keyed(again)).select("k.t", "k.key", "fp")
        )
    return (
        parts.repartition("t", "key").sortWithinPartitions("t", "key", "fp")
        .mapInArrow(_linked(radius), "a bigint, b bigint").distinct()
    )


def _fingerprints(width: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = np.fromiter(
                (fingerprint(x.as_py(), width) for x in batch.column(1)), np.uint64, batch.num_rows
            )
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[::2], pa.array(found.view(np.int64))], names=["doc_id", "digest", "fp"]
            )

    return run


def _grouped(docs: DataFrame, radius: int, width: int) -> DataFrame:
    """``doc_id``, ``digest`` of the text, ``fp`` and ``root`` of every row."""
    text = F.col("text").cast("string")
    prints = scratch.stored(
        docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), text.alias("text"), F.xxhash64(text).alias("digest"))
        .mapInArrow(_fingerprints(width), "doc_id bigint, digest bigint, fp bigint"),
        "prints",
    )
    distinct = scratch.stored(prints.select("fp").distinct(), "prints")
    roots = components(links(distinct, radius)).withColumnRenamed("node", "fp")
    ids = distinct.join(roots, "fp", "left").select("fp", F.coalesce("root", "fp").alias("root"))
    return prints.join(ids, "fp")


def near_duplicates(docs: DataFrame, radius: int = 2, width: int = 3) -> DataFrame:
    """``doc_id``, ``fingerprint``, ``component_id`` of every row of ``docs``.

    ``docs`` has ``doc_id`` and ``text``; other columns are not read. Texts without a
    word, null ones included, have the fingerprint zero and are linked like
    others. Repeated rows come back as often as they came in; a null ``doc_id``
    keeps its row but never names a component. Copies meet in one fingerprint
    before the search, so a large group of them costs one row in it.
    """
    rows = scratch.stored(_grouped(docs, radius, width), "grouped")
    named = rows.groupBy("root").agg(F.min("doc_id").alias("component_id"))
    return rows.join(named, "root").select(
        "doc_id",
        F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"),
        "component_id",
    )


def one_of_each(docs: DataFrame, radius: int = 2, width: int = 3) -> DataFrame:
    """One row of ``docs`` for each near-duplicate group, that of the smallest ``doc_id``.

    All columns stay. Texts that share a ``doc_id`` are told apart; of those in one group the one
    with the smallest digest stays. Repeated rows are one document. A row without
    a ``doc_id`` cannot be told apart and stays.
    """
    found = _grouped(docs.where("doc_id is not null"), radius, width)
    first = found.groupBy("root").agg(F.min(F.struct("doc_id", "digest")).alias("first")).select("first.*").distinct()
    rows = docs.select(
        F.struct("*").alias("kept_row"),
        F.col("doc_id").cast("bigint").alias("doc_id"),
        F.xxhash64(F.col("text").cast("string")).alias("digest"),
    )
    chosen = rows.join(first, ["doc_id", "digest"], "left_semi").dropDuplicates(["doc_id", "digest"])
    return chosen.select("kept_row").union(rows.where("doc_id is null").select("kept_row")).select("kept_row.*")

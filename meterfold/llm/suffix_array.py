"""Exact repeats of 100 bytes by prefix doubling."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from meterfold.llm import repeats
from meterfold.llm.text import BYTE_NAMES, Block, pair

WIDTH = 100
#: Length of the prefixes that are ranked first.
SEED = 32
_SPAN = WIDTH - SEED + 1  # anchors a window can have
_PLACE = np.uint64((1 << 24) - 1)
#: Windows of a part in the second round, and the bytes they all share.
_PART = 9
_CORE = WIDTH - _PART + 1


def _ranks(block: Block) -> np.ndarray:
    """Names of the 32 bytes from every position: pairs of names at offsets 1, 2, 4, 8, 16."""
    names, step = BYTE_NAMES[block.data], 1
    while step < SEED:
        names = pair(names[:-step], names[step:])
        step *= 2
    return names


def _at_width(ranks: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Names of the 100 bytes from these positions: doubled to 64, then 64 and the last 64."""
    first = pair(ranks[at], ranks[at + 32])
    return pair(first, pair(ranks[at + 36], ranks[at + 68]))


def _anchors(block: Block, ranks: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """All window starts of the block, and the anchor of each.

    It is the least rank among the 69 prefixes in the window, the leftmost of equals,
    so equal windows have it at the same place.
    """
    order = (ranks & ~_PLACE) | np.arange(len(ranks), dtype=np.uint64)
    width, least = 1, order
    while 2 * width <= _SPAN:
        least = np.minimum(least[:-width], least[width:])
        width *= 2
    least = np.minimum(least[: len(order) - _SPAN + 1], least[_SPAN - width : len(order) - width + 1])
    return least, (least & _PLACE).astype(np.int64)


def _empty() -> repeats.Runs:
    none = np.zeros(0, np.int64)
    return none.astype(np.uint64), none.astype(np.uint64), none, none, none


def runs(block: Block) -> repeats.Runs:
    """Windows of the block in runs with one anchor."""
    parts = [_runs(b) for b in _chunks(block)]
    parts = [p for p in parts if len(p[0])]
    return tuple(np.concatenate(c) for c in zip(*parts)) if parts else _empty()


def _chunks(block: Block) -> Iterator[tuple[Block, int, int]]:
    """A block as it is, or one very long text in overlapping pieces."""
    most = 1 << 22
    if len(block.data) <= most:
        yield block, 0, 0
        return
    for row in range(len(block)):
        low, high = int(block.offsets[row]), int(block.offsets[row + 1])
        for at in range(low, max(low + 1, high - WIDTH + 1), most):
            piece = block.data[at : min(high, at + most + WIDTH - 1)]
            yield Block(piece, np.array([0, len(piece)]), 0), row, at - low


def _runs(chunk: tuple[Block, int, int]) -> repeats.Runs:
    block, row_shift, shift = chunk
    if len(block.data) < WIDTH:
        return _empty()
    ranks = _ranks(block)
    _, anchor = _anchors(block, ranks)
    row = np.searchsorted(block.offsets, np.arange(len(anchor)), "right") - 1
    whole = np.arange(len(anchor)) + WIDTH <= block.offsets[row + 1]
    at = np.flatnonzero(whole)
    if not len(at):
        return _empty()
    cut = np.ones(len(at), dtype=bool)
    cut[1:] = (anchor[at[1:]] != anchor[at[:-1]]) | (row[at[1:]] != row[at[:-1]])
    opens = np.flatnonzero(cut)
    first, last = at[opens], at[np.append(opens[1:], len(at)) - 1]
    name = pair(_at_width(ranks, first), _at_width(ranks, last)) + (last - first).astype(np.uint64)
    start = first - block.offsets[row[first]] + shift
    return ranks[anchor[first]], name, row[first] + row_shift, start, last - first + 1


def parts(block: Block, row: np.ndarray, start: np.ndarray, count: np.ndarray) -> repeats.Runs:
    """Open runs in parts of up to 9 windows, by the distance from window to anchor.

    All windows of a part share 92 bytes, whose name is its key. What they have besides
    are up to 8 bytes on either side, which go along.
    """
    if not len(row):
        none = np.zeros(0, np.int64)
        return *_empty(), *(none,) * 4
    ranks = _ranks(block)
    low = block.offsets[row] + start
    anchor = np.empty(len(row), dtype=np.int64)
    for at in range(0, len(row), 8192):
        near = low[at : at + 8192, None] + np.arange(_SPAN)
        anchor[at : at + 8192] = low[at : at + 8192] + np.argmin(ranks[near] & ~_PLACE, axis=1)
    near_t, far_t = anchor - (low + count - 1), anchor - low
    pieces = far_t // _PART - near_t // _PART + 1
    run, piece = repeats.each_window(np.arange(len(row)), near_t // _PART, pieces)
    anchor, near_t, far_t, row = anchor[run], near_t[run], far_t[run], row[run]
    least = np.maximum(near_t, piece * _PART) - piece * _PART
    most = np.minimum(far_t, piece * _PART + _PART - 1) - piece * _PART
    core = anchor - piece * _PART
    key = pair(pair(ranks[core], ranks[core + 32]), pair(ranks[core + 28], ranks[core + 60]))
    key = pair(key, piece.astype(np.uint64))
    padded = np.concatenate((np.zeros(8, np.uint8), block.data, np.zeros(8, np.uint8))).astype(np.uint64)
    left, right = np.zeros(len(core), np.uint64), np.zeros(len(core), np.uint64)
    for k in range(_PART - 1):
        left |= np.where(k < most, padded[8 + core - 1 - k], 0).astype(np.uint64) << np.uint64(8 * k)
        right |= np.where(k < _PART - 1 - least, padded[8 + core + _CORE + k], 0).astype(np.uint64) << np.uint64(8 * k)
    name = pair(left, right) + (least * 16 + most).astype(np.uint64)
    first = core - most - block.offsets[row]
    return key, name, row, first, most - least + 1, key, left, right, least

_BYTES = np.array([(1 << (8 * k)) - 1 for k in range(9)], dtype=np.uint64)


def windows(start, count, core, left, right, shift) -> tuple[np.ndarray, ...]:
    """The windows of open parts, named by the shared 92 bytes and the rest beside them."""
    row, j = repeats.each_window(np.arange(len(start)), shift, count.astype(np.int64))
    name = pair(left.view(np.uint64)[row] & _BYTES[j], right.view(np.uint64)[row] & _BYTES[_PART - 1 - j])
    key = pair(core.view(np.uint64)[row], j.astype(np.uint64))
    return key, name, row, start[row].astype(np.int64) + (shift[row] + count[row] - 1 - j)


RESULT = "doc_id bigint, n_bytes bigint, n_removed bigint, n_spans bigint, kept_sha256 string, kept string"


def _kept(with_text: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes, removed, spans, digests, kept = [], [], [], [], []
            for text, found in zip(batch.column("text"), repeats.lists(batch.column("repeats"))):
                data = np.frombuffer((text.as_py() or "").encode("utf-8"), dtype=np.uint8)
                rest = data
                sizes.append(len(data))
                removed.append(0)
                spans.append(0)
                if found is not None:
                    gone = repeats.covered(len(data), *found, WIDTH)
                    removed[-1] = int(gone.sum())
                    spans[-1] = int(gone[:1].sum() + (gone[1:] & ~gone[:-1]).sum())
                    rest = data[~gone]
                digests.append(hashlib.sha256(rest).hexdigest())
                kept.append(rest.tobytes().decode("utf-8", "ignore") if with_text else None)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"), pa.array(sizes, pa.int64()), pa.array(removed, pa.int64()),
                    pa.array(spans, pa.int64()), pa.array(digests, pa.string()), pa.array(kept, pa.string()),
                ],
                names=["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "kept"],
            )

    return run


def without_repeats(docs: DataFrame, with_text: bool = True) -> DataFrame:
    """Every row of ``docs`` without the bytes of 100-byte strings that start earlier.

    ``docs`` has ``doc_id`` and ``text``; other columns are not read. A null text is empty.
    Earlier is a smaller ``doc_id``, or the same one and an earlier start; strings are judged on
    the input. Rows that repeat a ``doc_id`` with its text are one document and come
    back alike; texts that share a ``doc_id`` are documents of their own, in the order of
    their digests. A row without a ``doc_id`` comes back whole. ``kept`` is the rest as
    text, without characters that the cut has split.

    Ranks are names made by doubling: of 32 bytes at every position, where Spark sorts only
    the anchors; of 92 bytes for the windows around anchors that several texts share; and
    of 100 bytes for those still undecided. What is unique after a round, or repeats
    with all windows of its anchor, leaves the search.
    """
    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text"))
    rows = repeats.with_variants(rows)
    found = repeats.repeated(rows, runs, parts, windows)
    joined = rows.join(found, [*repeats.DOC], "left").select("doc_id", "text", "repeats")
    return joined.mapInArrow(_kept(with_text), RESULT)

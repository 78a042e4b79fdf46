"""Exact repeats of 20 words by recompression."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from meterfold.llm import repeats
from meterfold.llm.text import SPACE_WORDS, Block, mix, pair, stretch_names

WIDTH = 20
#: Rounds of naming runs and pairs. Later symbols reach over more words than a window has.
ROUNDS = 2
#: A window takes its anchor from the longest of these classes of symbols it holds.
LENGTHS = (3, 2, 1)
_NEVER = 1 << 40
_PLACE = np.uint64((1 << 26) - 1)


class _Symbols:
    """One level of a block: names, the words they stand for, and the words that decide them.

    A symbol is there in every text that has the same words from ``low`` to ``high``.
    ``head`` marks the first symbol of a text.
    """

    def __init__(self, name, start, end, low, high, head):
        self.name, self.start, self.end, self.low, self.high, self.head = name, start, end, low, high, head

    def tails(self) -> np.ndarray:
        return np.append(self.head[1:], True)


def _runs_named(s: _Symbols) -> _Symbols:
    """Maximal runs of one name become one symbol; the neighbours decide where a run ends."""
    n = len(s.name)
    opens = s.head.copy()
    opens[1:] |= s.name[1:] != s.name[:-1]
    first = np.flatnonzero(opens)
    last = np.append(first[1:], n) - 1
    size = last - first + 1
    name = s.name[first]
    long = size > 1
    name[long] = pair(mix(name[long]), size[long].astype(np.uint64))
    low = np.where(s.head[first], -_NEVER, s.low[first - 1])
    tails = s.tails()
    high = np.where(tails[last], _NEVER, s.high[np.minimum(last + 1, n - 1)])
    return _Symbols(name, s.start[first], s.end[last], np.minimum(low, s.low[first]), np.maximum(high, s.high[last]), s.head[first])


def _pairs_named(s: _Symbols, turn: int) -> _Symbols:
    """Each name is a left or a right one; a left one followed by a right one become one symbol."""
    n = len(s.name)
    left = (mix(s.name + np.uint64(turn * 0x51ED27 + 1)) >> np.uint64(63)).astype(bool)
    tails = s.tails()
    joined = np.zeros(n, dtype=bool)
    joined[:-1] = left[:-1] & ~left[1:] & ~s.head[1:]
    second = np.zeros(n, dtype=bool)
    second[1:] = joined[:-1]
    name, end, low, high = s.name.copy(), s.end.copy(), s.low.copy(), s.high.copy()
    at = np.flatnonzero(joined)
    name[at] = pair(s.name[at], s.name[at + 1])
    end[at] = s.end[at + 1]
    high[at] = np.maximum(s.high[at], s.high[at + 1])
    low[at] = np.minimum(s.low[at], s.low[at + 1])
    # A left name alone depends on the symbol after it, a right one on the one before it.
    alone = np.flatnonzero(left & ~joined)
    after = np.where(tails[alone], _NEVER, s.high[np.minimum(alone + 1, n - 1)])
    high[alone] = np.maximum(high[alone], after)
    alone = np.flatnonzero(~left & ~second)
    before = np.where(s.head[alone], -_NEVER, s.low[np.maximum(alone - 1, 0)])
    low[alone] = np.minimum(low[alone], before)
    keep = ~second
    return _Symbols(name[keep], s.start[keep], end[keep], low[keep], high[keep], s.head[keep])


def _symbols(names: np.ndarray, head: np.ndarray) -> tuple[np.ndarray, ...]:
    """Symbols of all rounds that the words of some window decide, each as it comes up first."""
    at = np.arange(len(names))
    level = _Symbols(names, at, at + 1, at, at + 1, head)
    found = [(level.name, level.start, level.end, level.low, level.high)]
    for turn in range(ROUNDS):
        for step in (_runs_named, lambda s, turn=turn: _pairs_named(s, turn)):
            before, level = level, step(level)
            # A symbol that stays needs more words to be decided than it did before.
            kept = np.isin(level.end * 2, before.end * 2, assume_unique=True) & (
                level.start == before.start[np.minimum(np.searchsorted(before.end, level.end), len(before.end) - 1)]
            )
            fit = ~kept & (level.high - level.low <= WIDTH) & (level.low >= 0)
            found.append((level.name[fit], level.start[fit], level.end[fit], level.low[fit], level.high[fit]))
    return tuple(np.concatenate(c) for c in zip(*found))


def _anchors(names: np.ndarray, head: np.ndarray, n_windows: int) -> tuple[np.ndarray, np.ndarray]:
    """For each window start: a number of its anchor in the block, and the anchor's name.

    The name covers all words that decide the symbol, which every window that holds it has.

    Of the symbols that the words of the window decide, those of the longest class count,
    and of these the one with the least name, the leftmost of equals. All of this
    follows from the words, so equal windows have equal anchors at the same place.
    """
    name, start, end, low, high = _symbols(names, head)
    length = end - start
    number = (mix(name) >> np.uint64(26) << np.uint64(26)) | start.astype(np.uint64) & _PLACE
    first, span = high - WIDTH, WIDTH - (high - low)
    most = np.uint64(0xFFFFFFFFFFFFFFFF)
    best, key = np.full(n_windows, most), np.zeros(n_windows, dtype=np.uint64)
    upper = 1 << 30
    for least in LENGTHS:
        open_ = key == 0
        if not open_.any():
            break
        mine = np.flatnonzero((length >= least) & (length < upper))
        upper = least
        if least == 1:  # only the places without a longer symbol
            left = np.cumsum(np.append(0, open_))
            low_w, high_w = np.clip(first[mine], 0, n_windows), np.clip(low[mine] + 1, 0, n_windows)
            mine = mine[left[np.maximum(high_w, low_w)] > left[low_w]]
        here = np.full(n_windows, most)
        for step in range(WIDTH):
            some = mine[span[mine] >= step]
            at = first[some] + step
            good = (at >= 0) & (at < n_windows)
            np.minimum.at(here, at[good], number[some[good]])
        taken = open_ & (here != most)
        best[taken] = here[taken]
        order = mine[np.argsort(number[mine])]
        at = order[np.searchsorted(number[order], here[taken])]
        key[taken] = pair(stretch_names(names, low[at], high[at]), number[at] >> np.uint64(26)) | np.uint64(1)
    return best, key


def _doubled(names: np.ndarray) -> np.ndarray:
    """Names of the 16 words from every position."""
    step = 1
    while step < 16:
        names = pair(names[:-step], names[step:]) if len(names) > step else names[:0]
        step *= 2
    return names


def _word_names(block: Block) -> tuple[np.ndarray, np.ndarray]:
    starts, ends, first = block.words(SPACE_WORDS)
    return block.names(starts, ends), first


def _empty() -> repeats.Runs:
    none = np.zeros(0, np.int64)
    return none.astype(np.uint64), none.astype(np.uint64), none, none, none


def runs(block: Block) -> repeats.Runs:
    """Windows of the block in runs with one anchor."""
    names, first = _word_names(block)
    if len(names) < WIDTH:
        return _empty()
    head = np.zeros(len(names), dtype=bool)
    head[first[:-1][first[1:] > first[:-1]]] = True
    n = len(names) - WIDTH + 1
    row = np.searchsorted(first, np.arange(n), "right") - 1
    at = np.flatnonzero(np.arange(n) + WIDTH <= first[row + 1])
    if not len(at):
        return _empty()
    anchor, key = _anchors(names, head, n)
    sixteen = _doubled(names)
    cut = np.ones(len(at), dtype=bool)
    cut[1:] = (anchor[at[1:]] != anchor[at[:-1]]) | (row[at[1:]] != row[at[:-1]])
    opens = np.flatnonzero(cut)
    low, high = at[opens], at[np.append(opens[1:], len(at)) - 1]
    twenty = pair(sixteen[low], sixteen[low + 4])
    name = pair(twenty, pair(sixteen[high], sixteen[high + 4])) + (high - low).astype(np.uint64)
    return key[low], name, row[low], low - first[row[low]], high - low + 1


def windows(block: Block, row: np.ndarray, start: np.ndarray, count: np.ndarray) -> repeats.Runs:
    """The windows of open runs, each by itself."""
    row, start = repeats.each_window(row, start, count)
    names, first = _word_names(block)
    at = first[row] + start
    good = (start >= 0) & (at + WIDTH <= first[row + 1])
    row, start, at = row[good], start[good], at[good]
    if not len(at):
        return _empty()
    sixteen = _doubled(names)
    # Two names of the same 20 words, put together at different places.
    other = pair(pair(sixteen[at], sixteen[at + 1]), pair(sixteen[at + 2], sixteen[at + 4]))
    return other, pair(sixteen[at], sixteen[at + 4]), row, start, np.ones(len(at), np.int64)


RESULT = "doc_id bigint, n_words bigint, n_removed bigint, kept_sha256 string, kept string"


def _cut(text: str | None, found: tuple[np.ndarray, np.ndarray] | None) -> tuple[int, int, bytes]:
    words = (text or "").encode("utf-8").split()
    if found is None:
        return len(words), 0, b" ".join(words)
    gone = repeats.covered(len(words), *found, WIDTH)
    return len(words), int(gone.sum()), b" ".join([w for w, g in zip(words, gone.tolist()) if not g])


def _kept(with_text: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [
                _cut(text.as_py(), found)
                for text, found in zip(batch.column("text"), repeats.lists(batch.column("repeats")))
            ]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"),
                    pa.array([r[0] for r in rows], pa.int64()),
                    pa.array([r[1] for r in rows], pa.int64()),
                    pa.array([hashlib.sha256(r[2]).hexdigest() for r in rows], pa.string()),
                    pa.array([r[2].decode("utf-8") if with_text else None for r in rows], pa.string()),
                ],
                names=["doc_id", "n_words", "n_removed", "kept_sha256", "kept"],
            )

    return run


def _texts(docs: DataFrame) -> DataFrame:
    return docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text"))


def without_repeats(docs: DataFrame, with_text: bool = True) -> DataFrame:
    """Every row of ``docs`` without the words of 20-word windows that start earlier.

    ``docs`` has ``doc_id`` and ``text``; other columns are not read. A null text has no words.
    Earlier is a smaller ``doc_id``, or the same one and an earlier start; windows are judged
    on the input. Rows that repeat a ``doc_id`` with its text are one document and come
    back alike; texts that share a ``doc_id`` are documents of their own, in the order of
    their digests. A row without a ``doc_id`` comes back whole. ``kept`` holds the kept words
    with one space between them.

    Rounds name runs of one symbol, then pairs of a left and a right symbol, after nothing
    but their words, so equal stretches get equal symbols inside. Each window is
    filed under one of its long symbols, and Spark sorts the runs of windows under
    the same one; shared symbols reveal repeats, the names of whole runs and
    windows verify them.
    """
    rows = repeats.with_variants(_texts(docs))
    found = repeats.repeated(rows, runs, windows)
    joined = rows.join(found, [*repeats.DOC], "left").select("doc_id", "text", "repeats")
    return joined.mapInArrow(_kept(with_text), RESULT)


def _replaced(at: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = batch.column("kept_row").flatten()
            names = batch.schema.field("kept_row").type.names
            texts = rows[at].to_pylist()
            for i, found in enumerate(repeats.lists(batch.column("repeats"))):
                if found is not None:
                    texts[i] = _cut(texts[i], found)[2].decode("utf-8")
            rows[at] = pa.array(texts, rows[at].type)
            yield pa.RecordBatch.from_arrays(
                [pa.StructArray.from_arrays(rows, names=names)], names=["kept_row"]
            )

    return run


def cut_texts(docs: DataFrame) -> DataFrame:
    """``docs`` with the repeated words gone from ``text``; texts without any stay as they are.

    Documents are those of :func:`without_repeats`; all columns come back as they were.
    """
    rows = docs.select(F.struct("*").alias("kept_row"))
    texts = F.col("kept_row.doc_id").cast("bigint").alias("doc_id"), F.col("kept_row.text").cast("string").alias("text")
    rows = repeats.with_variants(rows.select("kept_row", *texts))
    found = repeats.repeated(rows, runs, windows)
    joined = rows.join(found, [*repeats.DOC], "left").select("kept_row", "repeats")
    kind = f"kept_row {rows.schema['kept_row'].dataType.simpleString()}"
    return joined.mapInArrow(_replaced(docs.columns.index("text")), kind).select("kept_row.*")

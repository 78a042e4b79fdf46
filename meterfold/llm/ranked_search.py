"""Ranked lexical search over an index in segments.

A segment holds some thousand documents: their ids, their lengths, and a posting list for each
term. Every posting has an impact, what one occurrence of the term in a query adds to
the document's score apart from the term's weight. Over each asked list lies a sparse
table of range maxima, so the largest impact between two documents is two look-ups.

A query starts with the interval of all documents of a segment. The sum of its lists' weighted
maxima bounds every score inside. The intervals with the highest bounds are split
at the document that holds the interval's largest weighted impact; that one is scored,
and the halves get bounds of their own. Intervals whose bound is below the k-th best score
so far cannot matter and go, so the result is exact.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from meterfold import scratch
from meterfold.llm.text import ALNUM_WORDS, ASCII_LOWER, Block, blocks

TOP = 20
#: A segment ends with the block of text in which it reaches so many documents or postings.
SEGMENT_DOCS, SEGMENT_POSTINGS = 16_384, 2_000_000
#: Terms of one turn of queries, which every task holds.
TURN_TERMS = 50_000
#: Intervals split at once, at first and at most.
_FEW, _MANY = 8, 256

INDEX = (
    "docs array<bigint>, lengths array<bigint>, n_docs bigint, n_terms bigint, "
    "names array<bigint>, sizes array<int>, places binary, counts binary"
)


# ---------------------------------------------------------------- index

def _postings(block: Block) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Term, text of the block and occurrences of each posting, and the length of each text."""
    starts, ends, first = block.words(ALNUM_WORDS)
    names = block.names(starts, ends, ASCII_LOWER).view(np.int64)
    lengths = np.diff(first)
    rows = np.repeat(np.arange(len(block)), lengths)
    order = np.lexsort((rows, names))
    names, rows = names[order], rows[order]
    fresh = np.ones(len(names), dtype=bool)
    fresh[1:] = (names[1:] != names[:-1]) | (rows[1:] != rows[:-1])
    at = np.flatnonzero(fresh)
    return names[at], rows[at], np.diff(np.append(at, len(names))), lengths


def _narrow(numbers: np.ndarray) -> bytes:
    """Whole numbers in the fewest bytes that hold the largest."""
    most = int(numbers.max()) if len(numbers) else 0
    kind = next(k for k in ("<u1", "<u2", "<u4", "<u8") if most <= np.iinfo(k).max)
    return numbers.astype(kind).tobytes()


def _wide(data: bytes, size: int) -> np.ndarray:
    return np.frombuffer(data, dtype=f"<u{len(data) // size}").astype(np.int64) if size else np.zeros(0, np.int64)


def _segment(docs: list, parts: list[tuple[np.ndarray, ...]]) -> pa.RecordBatch:
    names, rows, counts, lengths = (np.concatenate(p) for p in zip(*parts))
    order = np.lexsort((rows, names))
    names, rows, counts = names[order], rows[order], counts[order]
    fresh = np.ones(len(names), dtype=bool)
    fresh[1:] = names[1:] != names[:-1]
    at = np.flatnonzero(fresh)
    row = {
        "docs": docs, "lengths": lengths, "n_docs": int((lengths > 0).sum()), "n_terms": int(lengths.sum()),
        "names": names[at], "sizes": np.diff(np.append(at, len(names))), "places": _narrow(rows), "counts": _narrow(counts),
    }
    kinds = dict(docs=pa.list_(pa.int64()), lengths=pa.list_(pa.int64()), n_docs=pa.int64(), n_terms=pa.int64(),
                 names=pa.list_(pa.int64()), sizes=pa.list_(pa.int32()), places=pa.binary(), counts=pa.binary())
    return pa.RecordBatch.from_arrays([pa.array([row[n]], k) for n, k in kinds.items()], names=list(kinds))


def _indexed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    docs, parts, held = [], [], 0
    for batch in batches:
        ids = batch.column(0).to_pylist()
        for block in blocks(batch.column(1)):
            names, rows, counts, lengths = _postings(block)
            parts.append((names, rows + len(docs), counts, lengths))
            docs.extend(ids[block.first : block.first + len(block)])
            held += len(names)
            if len(docs) >= SEGMENT_DOCS or held >= SEGMENT_POSTINGS:
                yield _segment(docs, parts)
                docs, parts, held = [], [], 0
    if docs:
        yield _segment(docs, parts)


def index(docs: DataFrame) -> DataFrame:
    """The stored segments of ``docs`` (``doc_id``, ``text``): every term of every document."""
    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return scratch.stored(rows.mapInArrow(_indexed, INDEX), "index")


# ---------------------------------------------------------------- queries

def _query_terms(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        at = 0
        for block in blocks(batch.column("text")):
            names, rows, counts, lengths = _postings(block)
            order = np.argsort(rows, kind="stable")
            ends = np.append(0, np.cumsum(np.bincount(rows, minlength=len(lengths))))
            columns = (pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(c[order], pa.int64())) for c in (names, counts))
            yield pa.RecordBatch.from_arrays(
                [batch.column("item").slice(at, len(lengths)), *columns], names=["item", "names", "counts"]
            )
            at += len(lengths)


def _sizes(asked: np.ndarray):
    """How many documents of each segment hold each asked term."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in range(batch.num_rows):
                names, sizes = (batch.column(n)[row].values.to_numpy() for n in ("names", "sizes"))
                there = np.isin(names, asked, assume_unique=True)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(names[there]), pa.array(sizes[there], pa.int64())], names=["name", "n"]
                )

    return run


class _Lists:
    """The asked posting lists of a segment, one after another, with their range maxima.

    A value is impact and document in one number, so a maximum also tells where it stands.
    """

    def __init__(self, row: dict, asked: np.ndarray, n_docs: int, n_terms: int):
        sizes = row["sizes"].astype(np.int64)
        ends = np.cumsum(sizes)
        mine = np.flatnonzero(np.isin(row["names"], asked, assume_unique=True))
        self.names, sizes = row["names"][mine], sizes[mine]
        total = int(ends[-1]) if len(ends) else 0
        self.bounds = np.append(0, np.cumsum(sizes))
        at = np.repeat(ends[mine] - sizes - self.bounds[:-1], sizes) + np.arange(self.bounds[-1])
        place, count = _wide(row["places"], total)[at], _wide(row["counts"], total)[at]
        room = 75 + 25 * row["lengths"] * n_docs // max(n_terms, 1)
        impact = 1_000_000_000 * count // (1000 * count + 12 * room[place])
        self.docs = row["docs"]
        self.size = len(row["lengths"])
        #: list and document of every posting, ascending
        self.keys = (np.repeat(np.arange(len(mine)), sizes) << 32) | place
        value = (impact << 32) | place
        levels, width = [value], 1
        longest = int(sizes.max()) if len(sizes) else 0
        while 2 * width <= longest:
            last = levels[-1]
            nxt = last.copy()
            np.maximum(last[:-width], last[width:], out=nxt[:-width])
            levels.append(nxt)
            width *= 2
        self.table = np.concatenate(levels)
        self.total = len(value)
        self.log = np.frexp(np.arange(1, longest + 2))[1] - 1  # of n at n - 1

    def maxima(self, low: np.ndarray, high: np.ndarray) -> np.ndarray:
        """The largest value of each range of postings, 0 for an empty one."""
        size = high - low
        some = size > 0
        level = self.log[np.where(some, size - 1, 0)]
        base = level * self.total
        first = self.table[np.where(some, base + low, 0)]
        second = self.table[np.where(some, base + high - (1 << level), 0)]
        return np.where(some, np.maximum(first, second), 0)


_LOW = (1 << 32) - 1


def best(lists: _Lists, terms: np.ndarray, weights: np.ndarray, k: int, least: int) -> tuple[np.ndarray, np.ndarray]:
    """Documents of the segment among which are its ``k`` best with a score of ``least`` or more, and their scores."""
    own = np.searchsorted(lists.names, terms)
    there = own < len(lists.names)
    there[there] = lists.names[own[there]] == terms[there]
    own, weights = own[there], weights[there]
    docs, scores = np.zeros(0, np.int64), np.zeros(0, np.int64)
    if not len(own):
        return docs, scores
    base = own << 32
    low, high = lists.bounds[own][None, :], lists.bounds[own + 1][None, :]
    value = lists.maxima(low, high)
    gain = (value >> 32) * weights
    bound, split = gain.sum(axis=1), value[0, gain.argmax(axis=1)] & _LOW
    many = _FEW
    while len(bound):
        if len(bound) > many:
            order = np.argpartition(bound, len(bound) - many)
            rest, top = order[:-many], order[-many:]
        else:
            rest, top = np.zeros(0, np.int64), np.arange(len(bound))
        many = min(2 * many, _MANY)
        at = split[top]
        key = base[None, :] + at[:, None]
        here = np.searchsorted(lists.keys, key.ravel()).reshape(key.shape)
        hit = (here < high[top]) & (lists.keys[np.minimum(here, lists.total - 1)] == key)
        impact = lists.table[np.where(hit, here, 0)] >> 32
        docs = np.append(docs, at)
        scores = np.append(scores, (impact * weights * hit).sum(axis=1))
        if len(scores) >= k:
            least = max(least, int(np.partition(scores, len(scores) - k)[-k]))
            good = scores >= least
            docs, scores = docs[good], scores[good]
        new_low = np.concatenate((low[top], here + hit))
        new_high = np.concatenate((here, high[top]))
        value = lists.maxima(new_low, new_high)
        gain = (value >> 32) * weights
        new_bound = gain.sum(axis=1)
        new_split = value[np.arange(len(value)), gain.argmax(axis=1)] & _LOW
        old, new = rest[bound[rest] >= least], np.flatnonzero((new_bound >= least) & (new_bound > 0))
        low, high = np.concatenate((low[old], new_low[new])), np.concatenate((high[old], new_high[new]))
        bound, split = np.append(bound[old], new_bound[new]), np.append(split[old], new_split[new])
    good = scores >= max(least, 1)
    return docs[good], scores[good]


FOUND = "item bigint, doc_id bigint, score bigint"


def _searched(items: list[tuple[int, np.ndarray, np.ndarray]], asked: np.ndarray, n_docs: int, n_terms: int, k: int):
    """The ``k`` best of each query among the segments of a task."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, list[tuple[int, bool, int]]] = {}  # per query: (-score, no id, id), best first
        for batch in batches:
            for r in range(batch.num_rows):
                row = {n: batch.column(n)[r] for n in batch.schema.names}
                row = {n: v.as_py() if n in ("places", "counts", "docs") else v.values.to_numpy() if n in ("lengths", "names", "sizes") else None for n, v in row.items()}
                lists = _Lists(row, asked, n_docs, n_terms)
                for item, terms, weights in items:
                    old = held.get(item, [])
                    least = -old[-1][0] if len(old) == k else 1
                    places, scores = best(lists, terms, weights, k, least)
                    if len(places):
                        new = [(-s, lists.docs[d] is None, lists.docs[d] or 0) for d, s in zip(places.tolist(), scores.tolist())]
                        held[item] = sorted(old + new)[:k]
        rows = [(item, None if no_id else doc, -score) for item, own in held.items() for score, no_id, doc in own]
        for at in range(0, len(rows), 100_000):
            columns = zip(*rows[at : at + 100_000])
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], names=["item", "doc_id", "score"])

    return run


def weight(n_docs: int, df: int) -> int:
    return math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df + 1)))


def _turn(segments: DataFrame, queries: list, n_docs: int, n_terms: int, k: int) -> DataFrame:
    """The best documents for some queries, over all segments."""
    asked = np.unique(np.array([n for q in queries for n in q["names"]], dtype=np.int64))
    counts = segments.select("names", "sizes").mapInArrow(_sizes(asked), "name bigint, n bigint")
    df = {r["name"]: r["n"] for r in counts.groupBy("name").agg(F.sum("n").alias("n")).collect()}
    items = []
    for q in queries:
        terms = np.array(q["names"], dtype=np.int64)
        weights = np.array([weight(n_docs, df.get(n, 0)) * c for n, c in zip(q["names"], q["counts"])], dtype=np.int64)
        items.append((q["item"], terms, weights))
    needed = segments.select("docs", "lengths", "names", "sizes", "places", "counts")
    found = needed.mapInArrow(_searched(items, asked, n_docs, n_terms, k), FOUND)
    order = Window.partitionBy("item").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def search(docs: DataFrame, items: DataFrame, k: int = TOP) -> DataFrame:
    """The ``k`` documents of ``docs`` with the highest scores above 0 for each row of ``items``.

    ``docs`` has ``doc_id`` and ``text``, ``items`` has ``item_id`` and ``text``; other columns are not
    read. Equal scores stand in the order of ``doc_id``. A null or empty text has no terms:
    such a document is never found and such an item finds nothing. Every row of ``docs`` is
    a document and every row of ``items`` a query, also where ids repeat or are null (a null
    ``doc_id`` stands last among equals).

    The index of all documents is made and stored once. Queries are taken in turns of
    about ``TURN_TERMS`` terms by a hash of their row, which bounds what goes to the tasks; a
    turn reads the index twice, for the terms' document counts and for the search.
    A task carries its best scores from segment to segment and gives at most
    ``k`` rows per query. A term is known by a 64-bit name of its bytes.
    """
    segments = index(docs)
    all_ = segments.agg(F.sum("n_docs").alias("docs"), F.sum("n_terms").alias("terms")).first()
    n_docs, n_terms = all_["docs"] or 0, all_["terms"] or 0
    rows = items.select("item_id", F.col("text").cast("string").alias("text"))
    rows = scratch.stored(rows.withColumn("item", F.monotonically_increasing_id()), "items")
    terms = scratch.stored(
        rows.select("item", "text").mapInArrow(_query_terms, "item bigint, names array<bigint>, counts array<bigint>"),
        "query-terms",
    )
    turns = (terms.agg(F.sum(F.size("names")).alias("n")).first()["n"] or 0) // TURN_TERMS + 1
    turn, found = F.pmod(F.xxhash64("item"), F.lit(turns)), None
    for number in range(turns):
        part = _turn(segments, terms.where(turn == number).collect(), n_docs, n_terms, k)
        part = scratch.stored(part, "found") if turns > 1 else part
        found = part if found is None else found.union(part)
    return rows.join(found, "item").select("item_id", "rank", "doc_id", "score")


_PATTERN = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
_FOLD = "translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

SQL = f"""
WITH words AS (
    SELECT doc_id, unnest(regexp_extract_all({_FOLD.format('text')}, '{_PATTERN}')) AS term FROM documents),
asked AS (
    SELECT item_id, unnest(regexp_extract_all({_FOLD.format('text')}, '{_PATTERN}')) AS term FROM benchmark),
lengths AS (SELECT doc_id, count(*) AS n FROM words GROUP BY doc_id),
whole AS (SELECT count(*) AS n_docs, sum(n)::BIGINT AS n_terms FROM lengths),
tfs AS (
    SELECT doc_id, term, count(*) AS tf FROM words WHERE term IN (SELECT term FROM asked) GROUP BY doc_id, term),
weights AS (
    SELECT term, floor(1000 * ln((2 * n_docs + 2)::DOUBLE / (2 * count(*) + 1)))::BIGINT AS w
    FROM tfs, whole GROUP BY term, n_docs),
impacts AS (
    SELECT doc_id, term,
           w * ((1000000000 * tf) // (1000 * tf + 12 * (75 + (25 * n * n_docs) // n_terms))) AS s
    FROM tfs JOIN weights USING (term) JOIN lengths USING (doc_id), whole),
scores AS (
    SELECT item_id, doc_id, sum(s)::BIGINT AS score FROM asked JOIN impacts USING (term)
    GROUP BY item_id, doc_id HAVING sum(s) > 0),
ranked AS (
    SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS place FROM scores)
SELECT item_id, place::INTEGER AS rank, doc_id, score FROM ranked WHERE place <= {TOP}
"""

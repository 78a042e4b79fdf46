"""Find benchmark passages in documents by a prefix-filtered set join."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from meterfold import scratch
from meterfold.llm.text import ALNUM_WORDS, ASCII_LOWER, Block, blocks, pair, stretch_names

WINDOW = 13
SHINGLE = 3
#: Bits of a filter per name in it, and of the largest filter sent to the tasks (16 MB).
BITS_A_NAME = 32
MOST_BITS = 1 << 27
#: Windows in a batch that leaves a task.
_SLICE = 10_000

_FOLD = bytes(ASCII_LOWER[i] if ALNUM_WORDS[i] else 32 for i in range(256))


def words_of(text: str | None) -> list[bytes]:
    """Lower-cased runs of digits, letters a to z and all characters beyond ASCII."""
    return (text or "").encode("utf-8", "replace").translate(_FOLD).split()


def _word_names(block: Block) -> tuple[np.ndarray, np.ndarray]:
    starts, ends, first = block.words(ALNUM_WORDS)
    return block.names(starts, ends, ASCII_LOWER), first


def _shingle_names(names: np.ndarray, width: int) -> np.ndarray:
    found = names
    for i in range(1, width):
        found = pair(found[: len(names) - i], names[i:])
    return found


def _inside(first: np.ndarray, width: int) -> np.ndarray:
    """Marks for the shingle starts that do not run over the end of their text."""
    good = np.ones(int(first[-1]), dtype=bool)
    for back in range(1, width):
        cut = first[1:] - back
        good[cut[cut >= first[:-1]]] = False
    return good


@dataclass
class Filter:
    """A bit table of names; a name that is in it is always found, others rarely."""

    table: np.ndarray
    log: int

    def holds(self, names: np.ndarray) -> np.ndarray:
        found = np.ones(len(names), dtype=bool)
        for at in (names >> np.uint64(64 - self.log), names & np.uint64((1 << self.log) - 1)):
            found &= (self.table[at >> np.uint64(6)] >> (at & np.uint64(63)) & np.uint64(1)).astype(bool)
        return found


def filter_of(names: DataFrame, most_bits: int = MOST_BITS) -> Filter:
    """The filter of a column of names, put together in Spark; at most ``most_bits`` reach the driver."""
    held = names.toDF("name")
    count = held.agg(F.approx_count_distinct("name")).first()[0]
    log = max(6, min(most_bits.bit_length() - 1, (BITS_A_NAME * count).bit_length()))
    high, low = F.shiftrightunsigned("name", 64 - log), F.col("name").bitwiseAND(F.lit((1 << log) - 1))
    words = (
        held.select(F.explode(F.array(high, low)).alias("at"))
        .select(F.shiftright("at", 6).alias("word"), F.expr("shiftleft(1L, CAST(at & 63 AS INT))").alias("bit"))
        .groupBy("word").agg(F.bit_or("bit").alias("bits")).toArrow()
    )
    table = np.zeros(1 << (log - 6), dtype=np.uint64)
    table[words["word"].to_numpy()] = words["bits"].to_numpy().view(np.uint64)
    return Filter(table, log)


_WINDOWS = "item_id bigint, window string, size int, name bigint, shingles array<bigint>"


def _windows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for block in blocks(batch.column(1)):
            names, first = _word_names(block)
            starts, ends, _ = block.words(ALNUM_WORDS)
            data = ASCII_LOWER[block.data].tobytes()
            for i in range(len(block)):
                low, high = int(first[i]), int(first[i + 1])
                size = min(WINDOW, high - low)
                if not size:
                    continue
                own, width = names[low:high], min(SHINGLE, size)
                words = [data[a:b] for a, b in zip(starts[low:high].tolist(), ends[low:high].tolist())]
                shingles = _shingle_names(own, width).view(np.int64)
                for at in range(0, len(words) - size + 1, _SLICE):
                    places = np.arange(at, min(at + _SLICE, len(words) - size + 1))
                    inner = places[:, None] + np.arange(size - width + 1)
                    yield pa.RecordBatch.from_arrays(
                        [
                            batch.column(0).take(pa.array(np.full(len(places), block.first + i))),
                            pa.array([b" ".join(words[p : p + size]) for p in places.tolist()], pa.string()),
                            pa.array(np.full(len(places), size, np.int32)),
                            pa.array(stretch_names(own, places, places + size).view(np.int64)),
                            pa.array(list(shingles[inner]), pa.list_(pa.int64())),
                        ],
                        names=["item_id", "window", "size", "name", "shingles"],
                    )


def windows(items: DataFrame) -> DataFrame:
    """Every run of 13 words of an item, or the whole item if it has fewer, and its shingles."""
    return items.select(
        F.col("item_id").cast("bigint").alias("item_id"), F.col("text").cast("string").alias("text")
    ).mapInArrow(_windows, _WINDOWS)


def _counted(held, widths: list[int]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for block in blocks(batch.column(0)):
                names, first = _word_names(block)
                for width in (w for w in widths if w <= len(names)):
                    own = _shingle_names(names, width)
                    own = own[held.value.holds(own) & _inside(first, width)[: len(own)]]
                    shingles, n = np.unique(own, return_counts=True)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(shingles.view(np.int64)), pa.array(n.astype(np.int64))], names=["shingle", "n"]
                    )

    return run


def prefixes(docs: DataFrame, listed: DataFrame, sizes: list[int], most_bits: int = MOST_BITS) -> DataFrame:
    """Each window once, with its rarest shingle in ``docs`` and that shingle's place.

    All shingles of a window must be in a document that holds it, so in the order of
    rarity a prefix of one is enough. Windows with a shingle that no document has are gone.
    """
    spark = docs.sparkSession
    placed = listed.select("window", "size", "name", "shingles").distinct().select(
        "window", "size", "name", F.posexplode("shingles").alias("place", "shingle")
    )
    held = spark.sparkContext.broadcast(filter_of(placed.select("shingle"), most_bits))
    widths = sorted({min(SHINGLE, s) for s in sizes})
    seen = docs.select("text").mapInArrow(_counted(held, widths), "shingle bigint, n bigint")
    counts = seen.groupBy("shingle").agg(F.sum("n").alias("n"))
    rarest = F.min(F.struct(F.coalesce("n", F.lit(0)).alias("n"), "place", "shingle"))
    ranked = placed.join(counts, "shingle", "left").groupBy("window", "size", "name").agg(rarest.alias("first"))
    return ranked.where("first.n > 0").select("window", "size", "name", "first.place", "first.shingle")


_FOUND = "doc_id bigint, digest binary, n_words bigint, start bigint, size int, place int, shingle bigint, window string"
_NAMES = [c.split()[0] for c in _FOUND.split(", ")]


def _candidates(names, first, sizes, keys: Filter, whole: Filter) -> Iterator[tuple]:
    """Document, start, size, place and shingle of windows around key shingles."""
    for size in sizes:
        width = min(SHINGLE, size)
        if len(names) < size:
            continue
        shingles = _shingle_names(names, width)
        at = np.flatnonzero(keys.holds(shingles) & _inside(first, width)[: len(shingles)])
        docs = np.searchsorted(first, at, "right") - 1
        for place in range(size - width + 1):
            start = at - place
            good = (start >= first[docs]) & (start + size <= first[docs + 1])
            start, doc, shingle = start[good], docs[good], shingles[at[good]]
            good = whole.holds(stretch_names(names, start, start + size))
            yield doc[good], start[good], size, place, shingle[good]


def _searched(keys, whole, sizes: list[int]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for block in blocks(batch.column("text")):
                names, first = _word_names(block)
                n_words = np.diff(first).astype(np.int64)
                ids = batch.column("doc_id").slice(block.first, len(block))
                digests = batch.column("digest").slice(block.first, len(block))
                nothing = [pa.nulls(len(block), t) for t in (pa.int64(), pa.int32(), pa.int32(), pa.int64(), pa.string())]
                yield pa.RecordBatch.from_arrays([ids, digests, pa.array(n_words), *nothing], names=_NAMES)
                words = None
                for docs, starts, size, place, shingles in _candidates(names, first, sizes, keys.value, whole.value):
                    if words is None and len(docs):
                        data = ASCII_LOWER[block.data].tobytes()
                        low, high, _ = block.words(ALNUM_WORDS)
                        words = True
                    for cut in range(0, len(docs), _SLICE):
                        doc, start = docs[cut : cut + _SLICE], starts[cut : cut + _SLICE]
                        texts = [
                            b" ".join(data[a:b] for a, b in zip(low[s : s + size].tolist(), high[s : s + size].tolist()))
                            for s in start.tolist()
                        ]
                        at = pa.array(doc)
                        yield pa.RecordBatch.from_arrays(
                            [
                                pa.nulls(len(doc), pa.int64()), digests.take(at), pa.array(n_words[doc]),
                                pa.array((start - first[doc]).astype(np.int64)),
                                pa.array(np.full(len(doc), size, np.int32)), pa.array(np.full(len(doc), place, np.int32)),
                                pa.array(shingles[cut : cut + _SLICE].view(np.int64)), pa.array(texts, pa.string()),
                            ],
                            names=_NAMES,
                        )

    return run


def _digest(text: Column) -> Column:
    return F.unhex(F.sha2(F.coalesce(text.cast("string"), F.lit("")), 256))


def search(docs: DataFrame, items: DataFrame, most_bits: int = MOST_BITS) -> tuple[DataFrame, DataFrame]:
    """The texts that hold windows of items, and the documents.

    ``docs`` has ``doc_id``, ``digest`` and ``text``. The first frame has one row per
    different text with a hit: ``digest``, ``n_words``, ``n_hit``, ``spans`` (starts and ends
    of hit words, apart from each other and in order) and ``items``; the second
    ``doc_id``, ``digest`` and ``n_words`` of every row of ``docs``.

    A join on the prefix token: windows come under their rarest shingle, documents give the
    windows around their key shingles that pass the length and position bounds, and both
    meet by shingle, place, size and the words themselves, so no key is shared by more
    than one window. Two filters of bounded size keep back most of what has no partner;
    what they let through wrongly finds none in the join. No window goes through the driver.
    Equal texts are searched for once they are found, not once per copy.
    """
    spark = docs.sparkSession
    listed = scratch.stored(windows(items), "windows")
    sizes = sorted(r["size"] for r in listed.select("size").distinct().collect())  # 13 at most
    chosen = scratch.stored(prefixes(docs, listed, sizes, most_bits), "prefixes")
    keys = spark.sparkContext.broadcast(filter_of(chosen.select("shingle"), most_bits))
    whole = spark.sparkContext.broadcast(filter_of(chosen.select("name"), most_bits))
    found = scratch.stored(docs.select("doc_id", "digest", "text").mapInArrow(_searched(keys, whole, sizes), _FOUND), "candidates")
    candidates = found.where("start is not null").drop("doc_id").distinct()
    on = ["shingle", "place", "size", "window"]
    hits = scratch.stored(candidates.join(chosen.select(*on), on).select("digest", "n_words", "start", "size", "window"), "hits")
    order = Window.partitionBy("digest").orderBy("start", "size")
    end = F.col("start") + F.col("size")
    before = F.max(end).over(order.rowsBetween(Window.unboundedPreceding, -1))
    opens = F.when(before >= F.col("start"), 0).otherwise(1)
    spans = (
        hits.select("digest", "n_words", "start", "size", opens.alias("opens"))
        .withColumn("span", F.sum("opens").over(order.rowsBetween(Window.unboundedPreceding, 0)))
        .groupBy("digest", "n_words", "span").agg(F.min("start").alias("low"), F.max(end).alias("high"))
        .groupBy("digest", "n_words")
        .agg(F.sum(F.col("high") - F.col("low")).alias("n_hit"), F.array_sort(F.collect_list(F.struct("low", "high"))).alias("spans"))
    )
    met = (
        hits.select("digest", "window").distinct()
        .join(listed.where("item_id is not null").select("window", "item_id").distinct(), "window")
        .groupBy("digest").agg(F.array_sort(F.collect_set("item_id")).alias("items"))
    )
    texts = spans.join(met, "digest", "left").withColumn("items", F.coalesce("items", F.array().cast("array<bigint>")))
    return texts, found.where("start is null").select("doc_id", "digest", "n_words")


def _sha(column: Column) -> Column:
    return F.sha2(F.array_join(F.array_sort(F.transform(column, lambda i: i.cast("string"))), ","), 256)


def _contaminated() -> Column:
    return (F.col("n_hit") > 0) & (20 * F.col("n_hit") >= F.col("n_words"))


def contamination(docs: DataFrame, items: DataFrame, most_bits: int = MOST_BITS) -> DataFrame:
    """Per row of ``docs``: words, hit words, items met, and whether it is contaminated.

    ``docs`` has ``doc_id`` and ``text``, ``items`` has ``item_id`` and ``text``; other
    columns are not read. Null and empty texts have no words. Repeated rows are judged
    each on its own. Windows of an item without an id hit words but name no item.
    Without items no document is contaminated.
    """
    rows = docs.select(
        F.col("doc_id").cast("bigint").alias("doc_id"), _digest(F.col("text")).alias("digest"), F.col("text").cast("string").alias("text")
    )
    texts, listed = search(rows, items, most_bits)
    found = listed.join(texts.select("digest", "n_hit", "items"), "digest", "left").withColumns(
        {"n_hit": F.coalesce("n_hit", F.lit(0)), "items": F.coalesce("items", F.array().cast("array<bigint>"))}
    )
    return found.select(
        "doc_id", "n_words", "n_hit", F.size("items").cast("bigint").alias("n_items"),
        _sha(F.col("items")).alias("items_sha256"), _contaminated().alias("contaminated"),
    )


def clean(docs: DataFrame, items: DataFrame, most_bits: int = MOST_BITS) -> DataFrame:
    """The rows of ``docs`` that are not contaminated, with all their columns."""
    rows = docs.select(
        F.lit(None).cast("bigint").alias("doc_id"), _digest(F.col("text")).alias("digest"), F.col("text").cast("string").alias("text")
    )
    texts, _ = search(rows, items, most_bits)
    bad = scratch.stored(texts.where(_contaminated()).select("digest"), "contaminated")
    whole = docs.select(F.struct("*").alias("kept_row"), _digest(F.col("text")).alias("digest"))
    return whole.join(bad, "digest", "left_anti").select("kept_row.*")

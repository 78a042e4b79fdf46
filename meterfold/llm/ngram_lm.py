"""Language-model scores by deleted interpolation of n-grams, words and a uniform share."""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from meterfold import scratch
from meterfold.llm.text import ASCII_LOWER, SPACE_WORDS, blocks, pair

#: Bytes of text whose tokens go together as one block.
BLOCK_TEXT = 4 << 20
#: Names that one task adds up at a time, at most (as many as the texts have tokens, if all differ).
RANGE_NAMES = 2_000_000
#: Words of the longest n-grams of a registered model.
ORDER = 3
FOLDS, HELD_OUT = 5, 1
#: Names of the end of a text and of the place before its first word.
END, START = (np.uint64(x) for x in (0x9D39247E33776D41, 0x2AF7398005AAA5C7))
#: Steps per octave in which the EM tells shares apart, and its rounds.
OCTAVE, ROUNDS = 8, 200

BLOCKS = "block bigint, doc_ids array<bigint>, sizes array<bigint>, held array<boolean>, words binary, tokens binary"
ASKED = "kind int, part int, block bigint, names binary, counts binary"
ANSWERS = "kind int, part int, block bigint, elsewhere binary, total bigint, types bigint"
ANSWER = "array<struct<kind int, part int, elsewhere binary>>"
COUNTED = "doc_ids array<bigint>, sizes array<bigint>, held array<boolean>, counts array<binary>"


# ---------------------------------------------------------------- packed numbers

def packed(numbers: np.ndarray) -> bytes:
    """Whole numbers of 0 or more, byte by place and compressed."""
    planes = np.ascontiguousarray(numbers.astype("<u8").view(np.uint8).reshape(-1, 8).T)
    return zstandard.ZstdCompressor(level=1).compress(planes.tobytes())


def unpacked(data: bytes) -> np.ndarray:
    planes = np.frombuffer(zstandard.ZstdDecompressor().decompress(data), np.uint8).reshape(8, -1)
    return np.ascontiguousarray(planes.T).view("<u8").reshape(-1).astype(np.uint64)


def packed_sorted(names: np.ndarray) -> bytes:
    return packed(np.diff(names, prepend=np.uint64(0)))


def unpacked_sorted(data: bytes) -> np.ndarray:
    return np.cumsum(unpacked(data), dtype=np.uint64)


# ---------------------------------------------------------------- blocks of tokens

def held_out(doc_id: int | None) -> bool:
    return zlib.crc32(b"" if doc_id is None else str(doc_id).encode()) % FOLDS == HELD_OUT


def _block(key: int, docs: list, sizes: list[np.ndarray], names: list[np.ndarray]) -> pa.RecordBatch:
    lengths, flat = np.concatenate(sizes), np.concatenate(names)
    words, tokens = np.unique(flat, return_inverse=True)
    return pa.RecordBatch.from_arrays(
        [
            pa.array([key]), pa.array([docs], pa.list_(pa.int64())), pa.array([lengths.tolist()], pa.list_(pa.int64())),
            pa.array([[held_out(d) for d in docs]], pa.list_(pa.bool_())),
            pa.array([packed_sorted(words)], pa.binary()), pa.array([packed(tokens)], pa.binary()),
        ],
        names=["block", "doc_ids", "sizes", "held", "words", "tokens"],
    )


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Blocks with keys of their own, whatever they hold: the task's partition and a number in it."""
    key = TaskContext.get().partitionId() << 32
    docs, sizes, names, held = [], [], [], 0
    for batch in batches:
        ids = batch.column(0).to_pylist()
        for block in blocks(batch.column(1)):
            starts, ends, first = block.words(SPACE_WORDS)
            found = block.names(starts, ends, ASCII_LOWER)
            docs += ids[block.first : block.first + len(block)]
            sizes.append(np.diff(first) + 1)
            names.append(np.insert(found, first[1:], END))
            held += len(block.data)
            if held >= BLOCK_TEXT:
                yield _block(key, docs, sizes, names)
                key += 1
                docs, sizes, names, held = [], [], [], 0
    if docs:
        yield _block(key, docs, sizes, names)


@dataclass
class Grams:
    """The n-grams of one length of a block: distinct names, and which of them each token ends."""

    names: np.ndarray
    which: np.ndarray
    #: Training counts in all blocks, once the answers are in.
    totals: np.ndarray
    #: Whether another block asked for the name as well.
    shared: np.ndarray
    asked: np.ndarray


@dataclass
class Tokens:
    """One block opened."""

    words: np.ndarray
    tokens: np.ndarray  #: places in ``words``
    heads: np.ndarray  #: the first token of each text
    train: np.ndarray  #: per token
    grams: list[Grams]  #: words, pairs, ...

    def before(self, grams: Grams) -> np.ndarray:
        """The n-gram that ends one token earlier, or the number of n-grams for the start of a text."""
        earlier = np.empty_like(grams.which)
        earlier[1:] = grams.which[:-1]
        earlier[self.heads] = len(grams.names)
        return earlier

    def longer(self, answers: list[dict]) -> None:
        """Add the next longer n-grams, with what the answers say about them.

        An n-gram of three or more words is asked for only if both parts of it that are a word
        shorter are in other blocks too: where one of them is not, the n-gram is not either.
        """
        kind = len(self.grams) + 1
        if kind == 1:
            names, which, asked = self.words, self.tokens, np.ones(len(self.words), dtype=bool)
        else:
            last = self.grams[-1]
            before = self.before(last)
            names, which = np.unique(
                pair(np.append(last.names, START)[before], self.words[self.tokens]), return_inverse=True
            )
            which = which.astype(np.int32)
            asked = np.ones(len(names), dtype=bool)
            if kind > 2:
                asked[which] = last.shared[last.which] & np.append(last.shared, True)[before]
        totals = np.bincount(which[self.train], minlength=len(names))
        shared = np.zeros(len(names), dtype=bool)
        own = sorted((a for a in answers if a["kind"] == kind), key=lambda a: a["part"])
        if own:
            elsewhere = np.concatenate([unpacked(a["elsewhere"]).astype(np.int64) for a in own])
            shared[asked] = elsewhere > 0
            totals[asked] += np.maximum(elsewhere - 1, 0)
        self.grams.append(Grams(names, which, totals, shared, asked))


def _rows(batch: pa.RecordBatch) -> Iterator[dict]:
    """Rows one at a time: a block may have many MB."""
    for i in range(batch.num_rows):
        yield {n: batch.column(n)[i].as_py() for n in batch.schema.names}


def _opened(row: dict, order: int) -> Tokens:
    words, tokens = unpacked_sorted(row["words"]), unpacked(row["tokens"]).astype(np.int32)
    sizes = np.array(row["sizes"], dtype=np.int64)
    train = np.repeat(~np.array(row["held"], dtype=bool), sizes)
    own = Tokens(words, tokens, np.cumsum(sizes) - sizes, train, [])
    for _ in range(order):
        own.longer(row.get("answers") or [])
    return own


def _asked(kinds: tuple[int, ...], parts: int):
    """Per block: the training counts of its n-grams of these lengths, cut by ranges of names."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cuts = np.array([(i << 64) // parts for i in range(parts)], dtype=np.uint64)
        for batch in batches:
            for row in _rows(batch):
                own = _opened(row, max(kinds))
                rows = []
                for kind in kinds:
                    grams = own.grams[kind - 1]
                    names = grams.names[grams.asked]
                    counts = np.bincount(grams.which[own.train], minlength=len(grams.names))[grams.asked]
                    bounds = np.append(np.searchsorted(names, cuts), len(names))
                    rows += [
                        (kind, p, row["block"], packed_sorted(names[bounds[p] : bounds[p + 1]]), packed(counts[bounds[p] : bounds[p + 1]]))
                        for p in np.flatnonzero(np.diff(bounds)).tolist()
                    ]
                if rows:
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(c, t) for c, t in zip(zip(*rows), (pa.int32(), pa.int32(), pa.int64(), pa.binary(), pa.binary()))],
                        names=["kind", "part", "block", "names", "counts"],
                    )

    return run


def _answered(table: pa.Table) -> pa.Table:
    """For each block and name of a range: 0 if no other block asked for it, else 1 and their training counts."""
    rows = table.to_pylist()
    names = [unpacked_sorted(r["names"]) for r in rows]
    counts = [unpacked(r["counts"]).astype(np.int64) for r in rows]
    every, place = np.unique(np.concatenate(names), return_inverse=True)
    total = np.zeros(len(every), dtype=np.int64)
    np.add.at(total, place, np.concatenate(counts))
    shared = np.bincount(place) > 1
    found, at = [], 0
    for i, (row, own) in enumerate(zip(rows, counts)):
        here = place[at : at + len(own)]
        more = np.where(shared[here], 1 + total[here] - own, 0)
        at += len(own)
        found.append(
            {
                "kind": row["kind"], "part": row["part"], "block": row["block"], "elsewhere": packed(more),
                "total": int(total.sum()) if i == 0 else 0, "types": int((total > 0).sum()) if i == 0 else 0,
            }
        )
    kinds = (pa.int32(), pa.int32(), pa.int64(), pa.binary(), pa.int64(), pa.int64())
    return pa.table({n: pa.array([f[n] for f in found], k) for n, k in zip(found[0], kinds)})


def _token_counts(order: int):
    """Per block: for every token the training counts of the n-grams it ends."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in _rows(batch):
                own = _opened(row, order)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([row["doc_ids"]], pa.list_(pa.int64())), pa.array([row["sizes"]], pa.list_(pa.int64())),
                        pa.array([row["held"]], pa.list_(pa.bool_())),
                        pa.array([[packed(g.totals[g.which]) for g in own.grams]], pa.list_(pa.binary())),
                    ],
                    names=["doc_ids", "sizes", "held", "counts"],
                )

    return run


# ---------------------------------------------------------------- the model

def bucket(counts: np.ndarray) -> np.ndarray:
    """0 for a context never seen, then one for each doubling of its count."""
    return np.where(counts > 0, np.frexp(np.maximum(counts, 1).astype(float))[1], 0)


@dataclass
class Counted:
    """Training counts for every token of a block."""

    counts: list[np.ndarray]  #: of the word, of the pair it ends, ...
    sizes: np.ndarray
    heads: np.ndarray
    held: np.ndarray

    def context(self, k: int, train_docs: int) -> np.ndarray:
        """How often what stands before the last word of the n-grams of k words occurs."""
        found = np.empty_like(self.counts[k - 2])
        found[1:] = self.counts[k - 2][:-1]
        found[self.heads] = train_docs
        return found


def _counted(row: dict) -> Counted:
    sizes = np.array(row["sizes"], dtype=np.int64)
    counts = [unpacked(c).astype(np.int64) for c in row["counts"]]
    return Counted(counts, sizes, np.cumsum(sizes) - sizes, np.array(row["held"], dtype=bool))


@dataclass
class Model:
    """What the weights need beside the counts of a token."""

    train_docs: int
    n: int
    types: int
    #: Weights of pair, word and uniform share, then of each longer n-gram, per context bucket.
    weights: list[np.ndarray]

    def chances(self, own: Counted, taken: int = 0) -> np.ndarray:
        """The chance of every token by the weights known so far, with ``taken`` of itself out of the counts."""
        context = own.context(2, self.train_docs) - taken
        w = self.weights[0][bucket(context)]
        chance = (
            w[:, 0] * np.where(context > 0, (own.counts[1] - taken) / np.maximum(context, 1), 0.0)
            + w[:, 1] * (own.counts[0] - taken) / max(1, self.n - taken) + w[:, 2] / (self.types + 1)
        )
        for k, weights in enumerate(self.weights[1:], 3):
            context = own.context(k, self.train_docs) - taken
            part = weights[bucket(context)]
            chance = part * np.where(context > 0, (own.counts[k - 1] - taken) / np.maximum(context, 1), 0.0) + (1 - part) * chance
        return chance


def _octaves(share: np.ndarray) -> np.ndarray:
    """Steps of a share below one; 1000 stands for zero."""
    with np.errstate(divide="ignore"):
        steps = np.rint(-OCTAVE * np.log2(share))
    return np.where(share > 0, np.minimum(steps, 999), 1000).astype(np.int64)


def _deleted(model: Model):
    """How often each mix of shares occurs when a training token is taken out of the counts.

    Before there are weights the shares are those of pair and word, then those of the
    n-gram that is a word longer and of the model so far.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in _rows(batch):
                own = _counted(row)
                train = np.repeat(~own.held, own.sizes)
                k = len(model.weights) + 2
                context = own.context(k, model.train_docs)[train] - 1
                share = np.where(context > 0, (own.counts[k - 1][train] - 1) / np.maximum(context, 1), 0.0)
                if model.weights:
                    other = model.chances(own, 1)[train] if train.any() else np.zeros(0)
                else:
                    other = (own.counts[0][train] - 1) / max(1, model.n - 1)
                cells = (bucket(context) * 1001 + _octaves(share)) * 1001 + _octaves(other)
                cells, counts = np.unique(cells, return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array(cells), pa.array(counts.astype(np.int64))], names=["cell", "n"])

    return run


def _settled(which: np.ndarray, share: np.ndarray, counts: np.ndarray, buckets: int) -> np.ndarray:
    """Weights of the shares for each bucket, by EM.

    Each round shares every count out over the shares by what they explain. One count for
    each keeps all weights above zero; a bucket without counts has equal ones.
    """
    weights = np.full((buckets, len(share)), 1 / len(share))
    for _ in range(ROUNDS):
        part = weights[which].T * share
        part *= counts / part.sum(0)
        sums = np.stack([np.bincount(which, p, buckets) for p in part], axis=1) + 1
        new = sums / sums.sum(1, keepdims=True)
        done = np.abs(new - weights).max() < 1e-9
        weights = new
        if done:
            break
    return weights


def _shares(cells: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Bucket and both shares of a cell."""
    first, second = cells // 1001 % 1001, cells % 1001
    return (
        cells // 1001**2,
        np.where(first < 1000, 2.0 ** (-first / OCTAVE), 0.0), np.where(second < 1000, 2.0 ** (-second / OCTAVE), 0.0),
    )


def mixture(cells: np.ndarray, counts: np.ndarray, types: int, buckets: int = 64) -> np.ndarray:
    """Weights of pair, word and uniform share for each bucket of the word before."""
    which, double, single = _shares(cells)
    weights = _settled(which, np.stack([double, single, np.full(len(cells), 1 / (types + 1))]), counts, buckets)
    weights[0] = [0.0, *(weights[0, 1:] / weights[0, 1:].sum())]  # no context, no pair
    return weights


def longer_weights(cells: np.ndarray, counts: np.ndarray, buckets: int = 64) -> np.ndarray:
    """Weight of the longer n-gram against the model so far, for each bucket of its context."""
    which, long, short = _shares(cells)
    weights = _settled(which, np.stack([long, short]), counts, buckets)[:, 0]
    weights[0] = 0.0
    return weights


SCORES = (
    "doc_id bigint, held_out boolean, n_tokens bigint, n_known bigint, train_tokens bigint, "
    "base_score double, score double"
)


def _scores(model: Model):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in _rows(batch):
                own = _counted(row)
                words = own.counts[0]
                base = np.log10((words + 0.5) / (model.n + 0.5 * (model.types + 1)))
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(row["doc_ids"], pa.int64()), pa.array(own.held), pa.array(own.sizes),
                        pa.array(np.add.reduceat((words > 0).astype(np.int64), own.heads)),
                        pa.array(np.full(len(own.heads), model.n, np.int64)),
                        pa.array(np.add.reduceat(base, own.heads)),
                        pa.array(np.add.reduceat(np.log10(model.chances(own)), own.heads)),
                    ],
                    names=["doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"],
                )

    return run


def scores(docs: DataFrame, order: int = ORDER, parts: int | None = None) -> DataFrame:
    """Log probabilities of every row of ``docs`` under a model of its training part.

    ``docs`` has ``doc_id`` and ``text``; other columns are not read. A null text is empty and has
    one token, the end. Documents whose id has the CRC-32 remainder 1 by 5 are held
    out; a missing id counts as an empty one, and repeated rows count each.

    A token's probability mixes the share of its pair with the word before, that of the
    word, and an equal one; then, up to ``order`` words (2 at least), the share of each longer
    n-gram with the mix so far. The weights depend on how often the context was seen and
    come from EM over the training tokens, each taken out of the counts first.

    Tokens are stored in blocks. A block asks for its distinct n-grams only, as sorted
    names packed by ranges; who holds a range adds up the counts and answers each block. So a shuffle
    row is a range of a block, no name has more than one entry per block, and no task
    sees more than a range or a block. There are as many ranges as the tokens fill with
    ``RANGE_NAMES`` each, or ``parts``.
    """
    if order < 2:
        raise ValueError("order is 2 at least")
    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text"))
    tokens = scratch.stored(rows.mapInArrow(_blocks, BLOCKS), "tokens")
    zero = F.lit(0).cast("bigint")
    size = tokens.select(
        F.aggregate("held", zero, lambda a, h: a + F.when(h, 0).otherwise(1)).alias("docs"),
        F.aggregate("sizes", zero, lambda a, n: a + n).alias("tokens"),
    ).agg(F.sum("docs").alias("docs"), F.sum("tokens").alias("tokens")).first()
    parts = parts or -(-max(1, size["tokens"] or 0) // RANGE_NAMES)
    model = Model(size["docs"] or 0, 0, 0, [])
    read, known = tokens, tokens.withColumn("answers", F.lit(None).cast(ANSWER))
    for kinds in [(1, 2), *((k,) for k in range(3, order + 1))]:
        asked = known.mapInArrow(_asked(kinds, parts), ASKED)
        answers = scratch.stored(asked.groupBy("kind", "part").applyInArrow(_answered, ANSWERS), "answers")
        if 1 in kinds:
            total = answers.where("kind = 1").agg(F.sum("total").alias("n"), F.sum("types").alias("v")).first()
            model.n, model.types = total["n"] or 0, total["v"] or 0
        grouped = answers.groupBy("block").agg(F.collect_list(F.struct("kind", "part", "elsewhere")).alias("more"))
        none = F.array().cast(ANSWER)
        joined = known.join(grouped, "block", "left").withColumn(
            "answers", F.concat(F.coalesce("answers", none), F.coalesce("more", none))
        ).drop("more")
        if order in kinds:
            known = counted = scratch.stored(joined.mapInArrow(_token_counts(order), COUNTED), "counted")
        else:
            known = scratch.stored(joined, "answered")
        scratch.release(read, answers)
        read = known
    for _ in range(order - 1):
        cells = counted.mapInArrow(_deleted(model), "cell bigint, n bigint").groupBy("cell").agg(F.sum("n").alias("n"))
        found = cells.collect()  # at most 64 x 1001 x 1001, some thousands in practice
        cells, counts = np.array([r["cell"] for r in found], dtype=np.int64), np.array([r["n"] for r in found], dtype=float)
        model.weights.append(longer_weights(cells, counts) if model.weights else mixture(cells, counts, model.types))
    return counted.mapInArrow(_scores(model), SCORES)

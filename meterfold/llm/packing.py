"""Pack tokenised documents into sequences of a fixed length."""

from __future__ import annotations

import sys
import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from meterfold import scratch
from meterfold.llm.text import ASCII_LOWER, Block, blocks, mix

CAPACITY = 2048
#: Different parts of words whose ids one Python worker remembers.
KEPT_PARTS = 2_000_000
#: Text that is cut into parts at once.
TEXT_BYTES = 1 << 21
#: Fillings the search may take, and sizes it may look at, before it returns its best packing so far.
NODES, WORK = 20_000, 3_000_000
#: Bins of a branch whose open fillings the search holds; those of earlier bins are made again when it comes back.
HELD_LEVELS = 32

_encoders: dict[str, "Encoder"] = {}

# Kinds of bytes: white space, letter, digit, other sign; the rest makes a chunk odd.
_SPACE, _LETTER, _DIGIT, _SIGN, _ODD = range(5)
_KIND = np.full(256, _ODD, dtype=np.uint8)
_KIND[0x21:0x7F] = _SIGN
_KIND[0x30:0x3A] = _DIGIT
_KIND[0x41:0x5B] = _KIND[0x61:0x7B] = _LETTER
_KIND[[0x20, 0x0A]] = _SPACE
_NOT_SPACE = _KIND != _SPACE
#: The second byte of Latin-1 letters, and of those in upper case.
_LATIN = np.zeros(256, dtype=bool)
_LATIN[0x80:0xC0] = True
_LATIN[[0x97, 0xB7]] = False
_LATIN_UPPER = _LATIN.copy()
_LATIN_UPPER[0x9F:] = False
#: Bytes as the signs that stand for them in the tokenizer's model: printable ones as they are, the others from 256 on.
_SHOWN = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
_SIGNS = {b: 256 + n for n, b in enumerate(sorted(set(range(256)) - set(_SHOWN)))}
#: Endings that the tokenizer takes together with the apostrophe before them.
_ENDINGS = (b"s", b"t", b"m", b"d", b"re", b"ve", b"ll")


class Encoder:
    """Ids of texts, a block of texts at a time.

    The tokenizer never joins characters across a space or line end. A chunk between two of
    them made of printable ASCII signs and Latin-1 letters falls into the parts its
    pre-tokenizer makes: runs of letters, single digits, runs of other signs, an apostrophe
    with its ending. Parts are known by a 64-bit name of their lower-case bytes; a new one
    goes through the tokenizer's model once. Any other chunk (other characters, control
    characters, perhaps a special token) is one part, and goes through the whole
    tokenizer once.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self._tokenizer = Tokenizer.from_file(path)
        self._forget()

    def _forget(self) -> None:
        self._names = np.zeros(0, np.uint64)
        self._starts, self._sizes = np.zeros(0, np.int64), np.zeros(0, np.int64)
        self._flat = np.zeros(0, "<u4")

    def _learn(self, names: np.ndarray, odd: np.ndarray, parts: list[bytes]) -> None:
        """Remember the ids of new parts; ``names`` are sorted."""
        encode, model, found = self._tokenizer.encode, self._tokenizer.model.tokenize, []
        for is_odd, part in zip(odd.tolist(), parts):
            if is_odd:
                found.append(encode(part.decode("utf-8"), add_special_tokens=False).ids)
            else:
                text = part.decode("latin-1")
                found.append([t.id for t in model(text if text.isascii() else text.translate(_SIGNS))])
        sizes = np.array([len(f) for f in found], dtype=np.int64)
        starts = len(self._flat) + np.cumsum(sizes) - sizes
        self._flat = np.concatenate((self._flat, np.array([i for f in found for i in f], dtype="<u4")))
        at = np.searchsorted(self._names, names)
        self._names = np.insert(self._names, at, names)
        self._starts, self._sizes = np.insert(self._starts, at, starts), np.insert(self._sizes, at, sizes)

    @staticmethod
    def _parts(block: Block) -> tuple[Block, np.ndarray, np.ndarray, np.ndarray]:
        """The block in lower case, starts and ends of the parts in it, and which are odd chunks."""
        data = block.data
        starts, ends, _ = block.words(_NOT_SPACE)
        kind, folded = _KIND[data], ASCII_LOWER[data]
        latin = np.flatnonzero(data[:-1] == 0xC3)
        latin = latin[_LATIN[data[latin + 1]]]
        kind[latin] = kind[latin + 1] = _LETTER
        upper = latin[_LATIN_UPPER[data[latin + 1]]] + 1
        folded[upper] += 0x20
        lower = Block(folded, block.offsets, block.first)
        if not len(starts):
            return lower, starts, ends, np.zeros(0, bool)
        opens = np.zeros(len(data) + 1, dtype=bool)
        opens[1:-1] = (kind[1:] != kind[:-1]) | (kind[1:] == _DIGIT)
        opens[starts] = True
        mark = np.append(np.flatnonzero((data == 0x27) & opens[:-1]), len(data))
        chunk_end = np.append(ends[np.searchsorted(starts, mark[:-1], "right") - 1], 0)
        taken = np.zeros(len(mark), dtype=bool)
        for ending in _ENDINGS:
            fits = ~taken & (mark + 1 + len(ending) <= chunk_end)
            for k, byte in enumerate(ending):
                fits &= folded[np.minimum(mark + 1 + k, len(data) - 1)] == byte
            at = mark[fits]
            opens[at + 1] = False
            after = at + 1 + len(ending)
            opens[after[after < len(data)]] |= kind[after[after < len(data)]] != _SPACE
            taken |= fits
        # A chunk with an odd byte, or with what may open a special token, stays whole.
        odd_byte = kind == _ODD
        odd_byte[:-1] |= (data[:-1] == 0x3C) & (data[1:] == 0x7C)
        before = np.append(0, np.cumsum(odd_byte))
        odd = before[ends] > before[starts]
        if odd.any():
            change = np.zeros(len(data) + 1, dtype=np.int8)
            change[starts[odd]] += 1
            change[ends[odd]] -= 1
            opens[:-1] &= np.cumsum(change[:-1]) == 0
            opens[starts] = True
        opens[:-1] &= kind != _SPACE
        opens[-1] = False
        first = np.flatnonzero(opens)
        chunk = np.searchsorted(starts, first, "right") - 1
        last = np.minimum(np.append(first[1:], len(data)), ends[chunk])
        return lower, first, last, odd[chunk]

    def _unknown(self, names: np.ndarray) -> np.ndarray:
        if not len(self._names):
            return np.ones(len(names), dtype=bool)
        return self._names[np.minimum(np.searchsorted(self._names, names), len(self._names) - 1)] != names

    def ids(self, block: Block) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all texts of a block one after another, and where each text starts."""
        lower, first, last, odd = self._parts(block)
        names = lower.names(first, last)
        if odd.any():
            names[odd] = mix(block.names(first[odd], last[odd]) + np.uint64(1))
        own, at, inverse = np.unique(names, return_index=True, return_inverse=True)
        new = self._unknown(own)
        if len(self._names) + new.sum() > KEPT_PARTS:
            self._forget()
            new[:] = True
        if new.any():
            first_of, is_odd = at[new], odd[at[new]]
            raw, plain = block.data.tobytes(), lower.data.tobytes()
            bounds = zip(is_odd.tolist(), first[first_of].tolist(), last[first_of].tolist())
            self._learn(own[new], is_odd, [(raw if o else plain)[a:b] for o, a, b in bounds])
        place = np.searchsorted(self._names, own)
        sizes = self._sizes[place][inverse]
        ends = np.cumsum(sizes)
        shift = np.repeat(self._starts[place][inverse] - ends + sizes, sizes)
        found = self._flat[shift + np.arange(len(shift))]
        bounds = np.append(0, ends)[np.searchsorted(first, block.offsets)]
        return found, bounds


def encoder(path: str) -> Encoder:
    if path not in _encoders:
        _encoders[path] = Encoder(path)
    return _encoders[path]


PIECES = "doc_id bigint, piece int, start bigint, length bigint, ids_crc32 bigint"


def _cut(path: str, capacity: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = encoder(path)
        for batch in batches:
            docs = batch.column(0).to_pylist()
            for block in blocks(batch.column(1), TEXT_BYTES):
                ids, bounds = known.ids(block)
                rows: tuple[list, ...] = ([], [], [], [], [])
                for doc, low, high in zip(docs[block.first :], bounds[:-1].tolist(), bounds[1:].tolist()):
                    own = ids[low:high].tobytes() + b"\0\0\0\0"
                    for piece, at in enumerate(range(0, len(own), 4 * capacity)):
                        part = own[at : at + 4 * capacity]
                        for held, value in zip(rows, (doc, piece, at // 4, len(part) // 4, zlib.crc32(part))):
                            held.append(value)
                kinds = (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64())
                yield pa.RecordBatch.from_arrays(
                    [pa.array(v, k) for v, k in zip(rows, kinds)],
                    names=["doc_id", "piece", "start", "length", "ids_crc32"],
                )

    return run


def pieces(docs: DataFrame, tokenizer: str, capacity: int = CAPACITY) -> DataFrame:
    """Every document's ids and a final 0, cut only where they are more than ``capacity``."""
    return docs.select(
        F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text")
    ).mapInArrow(_cut(tokenizer, capacity), PIECES)


# ---------------------------------------------------------------- the plan of bins

Pattern = tuple[tuple[int, ...], int]  #: lengths in one bin, and how many such bins


def lower_bound(counts: dict[int, int], capacity: int) -> int:
    """No packing has fewer bins.

    By volume; by what large pieces leave for others; and by dual feasible functions: if a
    length s counts as floor((k + 1) s / capacity) / k of a bin, no bin holds more than one.
    Before that, pieces up to some length may count as nothing, if those that
    leave no more than that length free count as whole bins.
    """
    total = sum(n * c for n, c in counts.items())
    best = -(-total // capacity)
    for least in sorted({n for n in counts if n <= capacity // 2} | {0}):
        huge = sum(c for n, c in counts.items() if n > capacity - least)
        large = sum(c for n, c in counts.items() if capacity // 2 < n <= capacity - least)
        room = sum((capacity - n) * c for n, c in counts.items() if capacity // 2 < n <= capacity - least)
        small = sum(n * c for n, c in counts.items() if least <= n <= capacity // 2)
        best = max(best, huge + large + max(0, -(-(small - room) // capacity)))
    if not counts:
        return 0
    lengths, many = (np.array(c, dtype=np.int64) for c in zip(*sorted(counts.items())))
    limits = np.append(0, lengths[lengths <= capacity // 2])
    for k in range(1, 101):
        whole = (k + 1) * lengths % capacity == 0
        # Shares in units of 1 / (k (k + 1)); a length that divides evenly counts as it is.
        share = np.where(whole, (k + 1) * lengths // capacity * k, (k + 1) * lengths // capacity * (k + 1))
        parts = np.append(0, np.cumsum(share * many))
        counted = np.append(0, np.cumsum(many))
        low = np.searchsorted(lengths, limits, "left")
        high = np.maximum(np.searchsorted(lengths, capacity - limits, "right"), low)
        units = parts[high] - parts[low] + (counted[-1] - counted[high]) * k * (k + 1)
        best = max(best, -(-int(units.max()) // (k * (k + 1))))
    return best


def best_fit(counts: dict[int, int], capacity: int) -> list[Pattern]:
    """Best-fit decreasing on counts: equal bins are filled together."""
    open_bins: dict[int, list[Pattern]] = {}
    for length in sorted(counts, reverse=True):
        left = counts[length]
        while left:
            room = min((r for r in open_bins if r >= length), default=None)
            if room is None:
                each = capacity // length
                if left >= each:
                    open_bins.setdefault(capacity - each * length, []).append(((length,) * each, left // each))
                    left %= each
                if left:
                    open_bins.setdefault(capacity - left * length, []).append(((length,) * left, 1))
                    left = 0
                continue
            inside, many = open_bins[room].pop()
            each = min(room // length, left)
            use = min(many, left // each)
            if use < many:
                open_bins[room].append((inside, many - use))
            if not open_bins[room]:
                del open_bins[room]
            open_bins.setdefault(room - each * length, []).append((inside + (length,) * each, use))
            left -= use * each
    return [p for group in open_bins.values() for p in group]


def _grown(sums: int, length: int, times: int, mask: int) -> int:
    """Reachable sums, as bits of a number, with up to so many pieces of a length more."""
    step = 1
    while times > 0:
        step = min(step, times)
        sums |= sums << length * step & mask
        times -= step
        step *= 2
    return sums


def _dominated(chosen: tuple[int, ...], waste: int, free: int) -> bool:
    """Whether some of the pieces could give way to one larger free piece that fits as well.

    ``free`` has a bit for each length of which pieces are left. Two or more pieces may also
    give way to one of their common length: the smaller ones are easier to place elsewhere.
    """
    one = several = 0
    for n in chosen:
        several |= (several | one) << n
        one |= 1 << n
    reach, width = (1 | one | several) << 1, 1
    while width < waste:
        step = min(width, waste - width)
        reach |= reach << step
        width += step
    return bool(((reach if waste else 0) | several) & free)


def _fillings(
    left: dict[int, int], room: int, most_waste: int, work: list[int]
) -> Iterator[tuple[int, ...]]:
    """Undominated ways to fill ``room``, least waste first, then larger pieces first.

    Sums that the shorter lengths can reach are kept as bits, so only branches with
    a solution are entered. Looking at a length costs one of ``work[0]``; without any
    left the search ends.
    """
    sizes = sorted((n for n, c in left.items() if c and n <= room), reverse=True)
    work[0] -= len(sizes)
    mask, reach = (1 << room + 1) - 1, [1]
    for n in reversed(sizes):
        reach.append(_grown(reach[-1], n, min(left[n], room // n), mask))
    reach.reverse()

    def fill(first: int, target: int, used: int) -> Iterator[tuple[int, ...]]:
        if not target:
            yield ()
            return
        for k in range(first, len(sizes)):
            if not reach[k] >> target & 1 or work[0] <= 0:
                return
            work[0] -= 1
            n = sizes[k]
            taken = used if k == first else 0
            if n <= target and taken < left[n] and reach[k] >> target - n & 1:
                for more in fill(k, target - n, taken + 1):
                    yield (n, *more)

    free = sum(1 << n for n, c in left.items() if c)
    for waste in range(min(room, most_waste) + 1):
        if reach[0] >> room - waste & 1:
            for chosen in fill(0, room - waste, 0):
                gone = sum(1 << n for n, c in Counter(chosen).items() if c >= left[n])
                if not _dominated(chosen, waste, free & ~gone):
                    yield chosen
        if work[0] <= 0:
            return


@dataclass
class _Level:
    """A bin of a branch: its largest piece, the waste allowed when it was opened, its fillings so far."""

    largest: int
    slack: int
    taken: int = 0
    ways: Iterator[tuple[int, ...]] | None = None


def plan(
    counts: dict[int, int], capacity: int = CAPACITY, nodes: int = NODES, work: int = WORK
) -> list[Pattern]:
    """Bins for so many pieces of each length.

    Branch and bound by bin completion: the largest piece left opens a bin, and the search
    branches over its undominated fillings. A filling is used for as many bins as
    its pieces allow. Best-fit decreasing gives the first packing to beat; a branch
    whose waste rules out a better one is cut. The search ends at the lower bound, or after
    ``nodes`` fillings or ``work`` looks at a length, whichever comes first, with the best
    packing so far. Its time follows the number of lengths, of which there are at most
    ``capacity``, not the number of pieces. The fillings still open at a bin hold some 100 kB,
    and a branch has a thousand bins or more: only the last few are held. An earlier bin's are
    made again when the search comes back to it, up to where they stood, which changes no packing.
    """
    counts = {n: c for n, c in counts.items() if c}
    total = sum(n * c for n, c in counts.items())
    bound, best = lower_bound(counts, capacity), best_fit(counts, capacity)
    fewest = sum(m for _, m in best)
    left, waste, looks = Counter(counts), 0, [work]
    stack: list[_Level] = []
    chosen: list[Pattern] = []

    def open_level() -> None:
        stack.append(_Level(max(n for n, c in left.items() if c), (fewest - 1) * capacity - total - waste))
        if len(stack) > HELD_LEVELS:
            stack[-1 - HELD_LEVELS].ways = None

    def next_way(level: _Level) -> tuple[int, ...] | None:
        if level.ways is None:
            others = {n: c - (n == level.largest) for n, c in left.items()}
            level.ways = _fillings(others, capacity - level.largest, level.slack, looks)
            # What was looked at before is not counted again.
            counted, looks[0] = looks[0], sys.maxsize
            for _ in range(level.taken):
                next(level.ways)
            looks[0] = counted
        level.taken += 1
        return next(level.ways, None)

    if fewest > bound:
        open_level()
    while stack and fewest > bound and nodes > 0 and looks[0] > 0:
        if len(chosen) == len(stack):
            lengths, many = chosen.pop()
            left.update({n: c * many for n, c in Counter(lengths).items()})
            waste -= (capacity - sum(lengths)) * many
        largest = stack[-1].largest
        way = next_way(stack[-1])
        if way is None:
            stack.pop()
            continue
        nodes -= 1
        lengths = (largest, *way)
        need, spare = Counter(lengths), capacity - largest - sum(way)
        many = min(left[n] // c for n, c in need.items())
        allowed = (fewest - 1) * capacity - total - waste
        if spare:
            many = min(many, max(1, allowed // spare))
        if spare * many > allowed:
            continue
        chosen.append((lengths, many))
        left.subtract({n: c * many for n, c in need.items()})
        waste += spare * many
        if any(left.values()):
            open_level()
            continue
        bins = sum(m for _, m in chosen)
        if bins < fewest:
            best, fewest = list(chosen), bins
    return best


# ---------------------------------------------------------------- places

def _slots(patterns: list[Pattern]) -> tuple[np.ndarray, ...]:
    """For the k-th piece of a length: where its run of bins starts, and its place there."""
    used: Counter = Counter()
    rows, base = [], 0
    for lengths, many in patterns:
        at = 0
        for length, each in sorted(Counter(lengths).items(), reverse=True):
            rows.append((length, used[length], base, each, at))
            used[length] += each * many
            at += each * length
        base += many
    rows.sort()
    return tuple(np.array(c, dtype=np.int64) for c in zip(*rows)) if rows else (np.zeros(0, np.int64),) * 5


def _place(slots: tuple[np.ndarray, ...]):
    lengths, firsts, bases, each, offsets = slots

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys = (lengths << 44) + firsts
        for batch in batches:
            length = batch.column("length").to_numpy()
            k = batch.column("k").to_numpy()
            at = np.searchsorted(keys, (length << 44) + k, "right") - 1
            nth = k - firsts[at]
            columns = [batch.column(n) for n in ("doc_id", "piece", "start", "length", "ids_crc32")]
            yield pa.RecordBatch.from_arrays(
                [*columns, pa.array(bases[at] + nth // each[at]), pa.array(offsets[at] + nth % each[at] * length)],
                names=["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"],
            )

    return run


def numbered(rows: DataFrame, total: int, per_bucket: int = 100_000) -> DataFrame:
    """Add ``k``, 0 to n - 1 among the rows of one length.

    Rows are numbered inside buckets of about ``per_bucket`` rows and shifted by the
    counts of earlier buckets, so a length that most rows share is spread.
    """
    buckets = total // per_bucket + 1
    rows = rows.withColumn("bucket", F.pmod(F.xxhash64("doc_id", "piece"), F.lit(buckets)))
    before = Window.partitionBy("length").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    counts = rows.groupBy("length", "bucket").agg(F.count("*").alias("n")).select(
        "length", "bucket", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("shift")
    )
    inside = Window.partitionBy("length", "bucket").orderBy("doc_id", "piece", "ids_crc32")
    return (
        rows.withColumn("i", F.row_number().over(inside) - 1)
        .join(counts, ["length", "bucket"])
        .withColumn("k", F.col("shift") + F.col("i"))
        .drop("bucket", "i", "shift")
    )


def pack(docs: DataFrame, tokenizer: str, capacity: int = CAPACITY, nodes: int = NODES) -> DataFrame:
    """One row per piece, with the sequence it goes to and its place there.

    ``docs`` has ``doc_id`` and ``text``; other columns are not read. A null or empty text
    is one piece with the id 0. Repeated rows, and rows without a ``doc_id``, are packed
    like any other. Only the number of pieces of each length, at most ``capacity``
    numbers, comes to the driver. ``tokenizer`` is the path of a vocabulary file
    that every machine has.
    """
    cut = scratch.stored(pieces(docs, tokenizer, capacity), "pieces")
    counts = {r["length"]: r["n"] for r in cut.groupBy("length").agg(F.count("*").alias("n")).collect()}
    slots = _slots(plan(counts, capacity, nodes))
    return numbered(cut, sum(counts.values())).mapInArrow(
        _place(slots), PIECES + ", sequence_id bigint, offset bigint"
    )

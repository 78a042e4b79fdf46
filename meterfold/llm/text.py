"""Texts of an Arrow batch as arrays of bytes, words and 64-bit names.

All of it runs inside Spark tasks. A batch is worked in blocks of a few MB, so the
memory of a task does not follow the batch; only one text longer than a block
makes a larger one.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

BLOCK_BYTES = 1 << 20
_WRAP = np.uint64(0xFFFFFFFFFFFFFFFF)


def mix(x: np.ndarray) -> np.ndarray:
    """Spread every bit of 64-bit numbers over all bits; one to one."""
    x = x ^ (x >> np.uint64(30))
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def pair(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """The name of two names next to each other."""
    return mix(left * np.uint64(0x9E3779B97F4A7C15) + right)


BYTE_NAMES = mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(0xD1342543DE82EF95))
_BASE = np.uint64(0x5851F42D4C957F2D)
_INVERSE = np.uint64(pow(0x5851F42D4C957F2D, -1, 1 << 64))

ASCII_LOWER = np.arange(256, dtype=np.uint8)
ASCII_LOWER[65:91] += 32

SPACE_WORDS = np.ones(256, dtype=bool)
SPACE_WORDS[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = False

ALNUM_WORDS = np.zeros(256, dtype=bool)
ALNUM_WORDS[0x30:0x3A] = ALNUM_WORDS[0x41:0x5B] = ALNUM_WORDS[0x61:0x7B] = True
ALNUM_WORDS[0x80:] = True

_powers: dict[str, np.ndarray] = {}


def _power_table(base: np.uint64, name: str, size: int) -> np.ndarray:
    held = _powers.get(name)
    if held is None or len(held) < size:
        steps = np.full(max(size, BLOCK_BYTES + 1), base, dtype=np.uint64)
        steps[0] = 1
        held = _powers[name] = np.cumprod(steps)
    return held[:size]


class Block:
    """Some texts: their bytes in one array, and where each text starts."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray, first: int):
        self.data, self.offsets, self.first = data, offsets, first

    def __len__(self) -> int:
        return len(self.offsets) - 1

    def words(self, kind: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Starts and ends of words in ``data``, and the first word of every text."""
        inside = kind[self.data]
        opens, closes = inside.copy(), inside.copy()
        opens[1:] &= ~inside[:-1]
        closes[:-1] &= ~inside[1:]
        filled = self.offsets[1:] > self.offsets[:-1]
        heads, tails = self.offsets[:-1][filled], self.offsets[1:][filled] - 1
        opens[heads] = inside[heads]
        closes[tails] = inside[tails]
        starts, ends = np.flatnonzero(opens), np.flatnonzero(closes) + 1
        return starts, ends, np.searchsorted(starts, self.offsets)

    def names(self, starts: np.ndarray, ends: np.ndarray, fold: np.ndarray | None = None) -> np.ndarray:
        """A name for each of these stretches of bytes; equal bytes have equal names."""
        table = BYTE_NAMES if fold is None else BYTE_NAMES[fold]
        n = len(self.data)
        sums = np.zeros(n + 1, dtype=np.uint64)
        np.cumsum(table[self.data] * _power_table(_BASE, "up", n), out=sums[1:])
        return mix((sums[ends] - sums[starts]) * _power_table(_INVERSE, "down", n + 1)[starts])


def stretch_names(names: np.ndarray, low: np.ndarray, high: np.ndarray) -> np.ndarray:
    """A name for each stretch ``names[low:high]``; equal stretches have equal names."""
    n = len(names)
    sums = np.zeros(n + 1, dtype=np.uint64)
    np.cumsum(names * _power_table(_BASE, "up", n), out=sums[1:])
    return mix((sums[high] - sums[low]) * _power_table(_INVERSE, "down", n + 1)[low])


def blocks(texts: pa.Array, limit: int = BLOCK_BYTES) -> Iterator[Block]:
    """The texts of a column, in order; a null is an empty text."""
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    texts = texts.cast(pa.large_string()).fill_null("")
    if len(texts) == 0:
        return
    bounds, data = texts.buffers()[1:]
    offsets = np.frombuffer(bounds, dtype=np.int64)[texts.offset : texts.offset + len(texts) + 1]
    whole = np.frombuffer(data, dtype=np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    at = 0
    while at < len(texts):
        to = int(np.searchsorted(offsets, offsets[at] + limit, "right")) - 1
        to = min(max(to, at + 1), len(texts))
        low, high = offsets[at], offsets[to]
        yield Block(whole[low:high], offsets[at : to + 1] - low, at)
        at = to


def as_signed(names: np.ndarray) -> np.ndarray:
    return names.view(np.int64)

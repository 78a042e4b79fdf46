"""Stable spreading of ids over the slots of a window."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def md5_modulo(text: Column, modulus: int) -> Column:
    """The MD5 digest of ``text``, read as one 128-bit number, modulo ``modulus``.

    The digest is folded eight hex digits at a time, so every step fits a
    ``bigint`` as long as the modulus is below 2**31.
    """
    if not 0 < modulus < 2**31:
        raise ValueError("modulus must be between 1 and 2**31 - 1")
    digest = F.md5(text.cast("binary"))
    rest = F.lit(0).cast("bigint")
    for start in (1, 9, 17, 25):
        piece = F.conv(F.substring(digest, start, 8), 16, 10).cast("bigint")
        rest = (rest * F.lit(2**32 % modulus) + piece) % F.lit(modulus)
    return rest


def window_slot(text: Column, slots: int = 15, window_seconds: int = 900) -> Column:
    """Slot of an id: its offset in the window, in steps of equal length."""
    if not 1 <= slots <= window_seconds:
        raise ValueError("slots must be between 1 and the window length in seconds")
    step = window_seconds // slots
    offset = md5_modulo(text, window_seconds)
    return F.least(F.floor(offset / F.lit(step)), F.lit(slots - 1).cast("bigint"))

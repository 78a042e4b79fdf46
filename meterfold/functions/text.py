"""Text: tokens, trimming, number and time formats, record keys."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

ISO_SECONDS = "yyyy-MM-dd'T'HH:mm:ss"
ISO_MICROS = "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"


def words(text: Column) -> Column:
    """Lower-cased text cut at single spaces; empty tokens stay."""
    return F.split(F.lower(text), " ", -1)


def strip(text: Column) -> Column:
    """Remove white space of any kind from both ends."""
    return F.regexp_replace(text, r"^\s+|\s+$", "")


def grouped_int(value: Column) -> Column:
    """Whole number with a space between thousands."""
    return F.translate(F.format_number(value.cast("bigint"), 0), ",", " ")


def grouped_float(value: Column, digits: int = 2) -> Column:
    """Number with ``digits`` decimals and a space between thousands."""
    return F.translate(F.format_number(value, digits), ",", " ")


def signed_percent(value: Column) -> Column:
    """``+1.5%`` style text; null when there is no value.

    ``format_number`` rounds the exact binary value, as C and Python do.
    """
    sign = F.when(value >= 0, F.lit("+")).otherwise(F.lit(""))
    return F.concat(sign, F.translate(F.format_number(value, 1), ",", ""), F.lit("%"))


def iso(ts: Column, micros: bool = False) -> Column:
    """ISO-8601 text without a zone."""
    return F.date_format(ts, ISO_MICROS if micros else ISO_SECONDS)


def parse_iso(text: Column) -> Column:
    """Timestamp (no zone) of ISO-8601 text; null when it is not one."""
    return text.try_cast("timestamp_ntz")


def clock(ts: Column) -> Column:
    """``HH:mm``."""
    return F.date_format(ts, "HH:mm")


def minutes_later(ts: Column, minutes: int) -> Column:
    """``ts`` plus a number of minutes."""
    return ts + F.expr(f"INTERVAL '{int(minutes)}' MINUTE")


def cycle_key(number: Column) -> Column:
    """Message key of a cycle."""
    return F.concat(F.lit("cycle-"), number.cast("string"))


def sequence_key(parts: list[Column], number: Column, width: int = 5) -> Column:
    """``A-B-00001``: the parts, then a zero-padded number, joined by dashes."""
    pattern = "-".join(["%s"] * len(parts)) + f"-%0{width}d"
    return F.format_string(pattern, *parts, number)

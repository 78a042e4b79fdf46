"""Sums of doubles that depend on neither order nor partitions, without declared decimals.

A double is cut at fixed powers of two: its exponent names a bin of 16 powers, and inside
the bin it becomes five digits of 16 bits that hold all of it. Digits of one bin add up
exactly in any order, in the hash aggregate, combined before the shuffle. A group has at
most 133 bins, whatever the values; at the end carries run through its digits once and the
leading ones are rounded to the nearest double.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

_POWERS = 16
_BASE = 1 << _POWERS
_DIGITS = ("d0", "d1", "d2", "d3", "d4")


def _digits(value: Column) -> list[Column]:
    """Bin and digits of a finite double, each digit 16 powers below the one before.

    Zero and null are in bin 0. The first digit carries the sign and may have a bit more.
    """
    known = F.when(value != 0.0, value)
    bin = F.coalesce(F.floor(F.log2(F.abs(known)) / _POWERS), F.lit(0)).cast("int")
    # Two steps, as one factor for the smallest doubles would be infinite. Both are exact.
    half = F.pow(F.lit(2.0), bin * F.lit(-_POWERS // 2))
    rest, found = F.coalesce(known, F.lit(0.0)) * half * half, [bin.alias("bin")]
    for name in _DIGITS:
        found.append(F.floor(rest).alias(name))
        rest = (rest - F.floor(rest)) * F.lit(float(_BASE))
    return found


def _carried(sign: int) -> Column:
    """Digits from 0 to 65,535 from the lowest place up, and what is left above (0 or -1)."""

    def step(state: Column, place: Column) -> Column:
        total = state["carry"]
        for i, name in enumerate(_DIGITS):
            total = total + sign * F.coalesce(F.try_element_at("bins", place + i)[name], F.lit(0).cast("bigint"))
        digit = F.array(total.bitwiseAND(F.lit(_BASE - 1).cast("bigint")))
        return F.struct(F.shiftright(total, _POWERS).alias("carry"), F.concat(state["digits"], digit).alias("digits"))

    start = F.struct(F.lit(0).cast("bigint").alias("carry"), F.array().cast("array<bigint>").alias("digits"))
    return F.aggregate(F.sequence(F.col("low") - 4, F.col("high") + 5), start, step)


def _rounded(digits: Column, low: Column) -> Column:
    """The nearest double of a number given by its digits; ``low`` is the place of the first.

    62 leading bits, the last one set as well if anything follows, become a double. Its
    scaling is exact: a sum of doubles that is too small for 53 bits has none to lose.
    """
    backward = F.reverse(digits)
    zeros = F.array_position(F.transform(backward, lambda d: d > 0), True).cast("int") - 1
    lead = F.concat(F.slice(backward, zeros + 1, F.size(backward)), F.array_repeat(F.lit(0).cast("bigint"), 5))
    parts = F.struct(
        (lead[0] * _BASE * _BASE + lead[1] * _BASE + lead[2]).alias("upper"),
        (lead[3] * _BASE + lead[4]).alias("lower"),
        F.exists(F.slice(lead, 6, F.size(lead)), lambda d: d > 0).alias("more"),
        (30 - F.length(F.bin(lead[0]))).alias("shift"),
        (low + F.size(digits) - 3 - zeros).alias("place"),
    )

    def joined(p: Column) -> Column:
        room = F.pow(F.lit(2.0), p["shift"]).cast("bigint")
        cut = F.pow(F.lit(2.0), 32 - p["shift"]).cast("bigint")
        bits = p["upper"] * room + F.floor(p["lower"] / cut).cast("bigint")
        sticky = (p["more"] | (p["lower"] % cut > 0)).cast("bigint")
        power = p["place"] * _POWERS - p["shift"]
        half = F.floor(power / 2).cast("int")
        return bits.bitwiseOR(sticky).cast("double") * F.pow(F.lit(2.0), half) * F.pow(F.lit(2.0), power - half)

    found = F.transform(F.array(parts), joined)[0]
    return F.when(zeros < 0, F.lit(0.0)).otherwise(found)


def exact_sums(rows: DataFrame, keys: Sequence[str], measure: str, total: str = "total", n: str = "n") -> DataFrame:
    """Per key: number of values and their sum, rounded once, to the nearest double.

    Nulls are left out; a key without a value has a null sum. NaN, or infinities of both
    signs, give NaN; infinities of one sign give that infinity. ``keys`` may be empty and may
    have any names.
    """
    names = [f"key{i}" for i in range(len(keys))]
    value = F.col(measure).cast("double")
    endless = value.isNotNull() & (F.isnan(value) | (F.abs(value) == F.lit(math.inf)))
    cut = rows.select(
        *[F.col(k).alias(a) for k, a in zip(keys, names)], value.alias("value"), F.when(endless, value).alias("endless")
    ).select(
        *names, "endless", F.col("value").isNotNull().cast("bigint").alias("known"),
        *_digits(F.when(F.col("endless").isNull(), F.col("value"))),
    )
    ends = [F.sum("known").alias("known"), F.sum("endless").alias("endless")]  # endless values add up alike in any order
    bins = cut.groupBy(*names, "bin").agg(*[F.sum(d).alias(d) for d in _DIGITS], *ends)
    joined = bins.groupBy(*names).agg(
        F.map_from_entries(F.collect_list(F.struct("bin", F.struct(*_DIGITS)))).alias("bins"),
        F.min("bin").alias("low"), F.max("bin").alias("high"), *ends,
    )
    above = joined.withColumn("above", _carried(1))
    below = above.withColumn("negative", F.col("above.carry") < 0).withColumn(
        "digits", F.when(F.col("negative"), _carried(-1)["digits"]).otherwise(F.col("above.digits"))
    )
    found = _rounded(F.col("digits"), F.col("low") - 4) * F.when(F.col("negative"), -1.0).otherwise(1.0)
    found = F.when(F.col("known") > 0, F.coalesce("endless", found))
    return below.select(*[F.col(a).alias(k) for k, a in zip(keys, names)], F.col("known").alias(n), found.alias(total))

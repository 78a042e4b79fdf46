"""Decimal measures added up as whole numbers.

A float sum depends on the order in which partial sums meet, which changes with
every shuffle. A measure with a known number of decimals is therefore summed as
a count of its last decimal (a ``bigint``): the result is the same for every
partitioning and the aggregation buffer stays a primitive, so it runs in the
code-generated hash aggregate. NaN, infinity and values too large to be counted
raise an error, as an overflowing sum does in ANSI mode.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _col(value: Column | str) -> Column:
    return F.col(value) if isinstance(value, str) else value


#: Below this a double has an exact count in a bigint.
_LIMIT = 9.2e18


def to_fixed(value: Column | str, digits: int) -> Column:
    """``value`` in units of its last decimal; null stays null."""
    scaled = _col(value) * F.lit(float(10**digits)) + F.lit(0.5)
    countable = F.abs(scaled) < F.lit(_LIMIT)  # NaN is larger than any number
    message = F.concat(F.lit("not a countable measure: "), _col(value).cast("string"))
    return F.when(countable | scaled.isNull(), F.floor(scaled)).otherwise(
        F.raise_error(message).cast("bigint")
    )


def from_fixed(value: Column | str, digits: int) -> Column:
    """Double value of a fixed-point count."""
    return _col(value) / F.lit(float(10**digits))


def fixed_sum(value: Column | str, digits: int) -> Column:
    """Order-independent sum of a measure with ``digits`` decimals."""
    return from_fixed(F.sum(to_fixed(value, digits)), digits)


def fixed_mean(value: Column | str, digits: int) -> Column:
    """Order-independent mean; null for an empty group."""
    return fixed_sum(value, digits) / F.nullif(F.count(_col(value)), F.lit(0))


def rounded(value: Column | str, digits: int) -> Column:
    """Rounding for display; compared results stay unrounded."""
    return F.round(_col(value), digits)

"""Range checks and severity bands."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from meterfold.model import Band


def out_of_band(value: Column, band: Band = Band()) -> Column:
    """True strictly outside the band; both limits are accepted values."""
    return (value < F.lit(band.low)) | (value > F.lit(band.high))


def band_side(value: Column, band: Band = Band()) -> Column:
    """``under`` or ``over`` for a value known to be out of band."""
    return F.when(value < F.lit(band.low), F.lit("under")).otherwise(F.lit("over"))


def severity(count: Column, critical: int) -> Column:
    """``crit`` above ``critical``, ``warn`` above zero, else ``ok``."""
    return (
        F.when(count > F.lit(critical), F.lit("crit"))
        .when(count > F.lit(0), F.lit("warn"))
        .otherwise(F.lit("ok"))
    )


def low_level(value: Column, low: float = 207.0, warn: float = 215.0) -> Column:
    """Band of a minimum: below ``low``, below ``warn``, or fine."""
    return (
        F.when(value < F.lit(low), F.lit("low"))
        .when(value < F.lit(warn), F.lit("warn"))
        .otherwise(F.lit("ok"))
    )


def first_present(*values: Column | str, default: object = None) -> Column:
    """First non-null of the columns, then the default."""
    columns = [F.col(v) if isinstance(v, str) else v for v in values]
    if default is not None:
        columns.append(F.lit(default))
    return F.coalesce(*columns)

"""Windowed roll-up over the hierarchy: reading, distributor, concentrator, centre.

Each level keeps *mergeable* state (counts, fixed-point sums, extremes), so a
level is built from the one below it and never goes back to the readings. Means
are worked out at the end by :func:`finish`.

The readings are aggregated before any dimension is joined: the only shuffle
that sees the raw volume is the one on (distributor, window), and it moves
partially aggregated rows. A distributor with a third of all readings adds one
row per window and map task, not a hot partition.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from meterfold import model
from meterfold.functions import bands, fixed, text
from meterfold.model import Band, Measures
from meterfold.operators import ordering

STATE = (
    "total_meters",
    "energy_units",
    "voltage_units",
    "voltage_count",
    "current_units",
    "current_count",
    "min_voltage",
    "max_voltage",
    "anomalies_count",
)


def tumbling(time: str, minutes: int = model.WINDOW_MINUTES, origin_minutes: int = 0) -> Column:
    """Window ``[start, start + minutes)``, shifted from the epoch by the origin."""
    if origin_minutes:
        width = f"{minutes} minutes"
        return F.window(time, width, width, f"{origin_minutes} minutes")
    return F.window(time, f"{minutes} minutes")


def reading_state(measures: Measures = Measures(), band: Band = Band()) -> list[Column]:
    """Aggregates that turn readings into mergeable state."""
    voltage, current = F.col(measures.voltage), F.col(measures.current)
    return [
        F.count(F.lit(1)).alias("total_meters"),
        F.sum(fixed.to_fixed(measures.energy, model.ENERGY_DIGITS)).alias("energy_units"),
        F.sum(fixed.to_fixed(measures.voltage, model.VOLTAGE_DIGITS)).alias("voltage_units"),
        F.count(voltage).alias("voltage_count"),
        F.sum(fixed.to_fixed(measures.current, model.CURRENT_DIGITS)).alias("current_units"),
        F.count(current).alias("current_count"),
        F.min(voltage).alias("min_voltage"),
        F.max(voltage).alias("max_voltage"),
        F.count_if(bands.out_of_band(voltage, band)).alias("anomalies_count"),
    ]


def merged_state() -> list[Column]:
    """Aggregates that merge the state of child rows."""
    merged = []
    for name in STATE:
        merge = {"min_voltage": F.min, "max_voltage": F.max}.get(name, F.sum)
        merged.append(merge(name).alias(name))
    return merged


def by_distributor(
    readings: DataFrame,
    keys: Sequence[str] = ("distributor_id",),
    measures: Measures = Measures(),
    band: Band = Band(),
    minutes: int = model.WINDOW_MINUTES,
    origin_minutes: int = 0,
) -> DataFrame:
    """Level 2: state of each key and window."""
    start = tumbling(measures.time, minutes, origin_minutes)["start"]
    used = [*keys, measures.energy, measures.voltage, measures.current]
    placed = readings.select(*dict.fromkeys(used), start.alias("window_start"))
    return placed.groupBy(*keys, "window_start").agg(*reading_state(measures, band))


def with_parents(
    level: DataFrame, hierarchy: DataFrame, on: str = "distributor_id"
) -> DataFrame:
    """Inner look-up of the parent columns of each child row.

    No hint: Spark broadcasts the hierarchy when its size is below the
    threshold and sorts both sides otherwise, with skewed partitions split.
    """
    return level.join(hierarchy, on, "inner")


def by_parent(
    level: DataFrame,
    keys: Sequence[str],
    children: str = "total_distributors",
) -> DataFrame:
    """Levels 3 and 4: merged state of each key and window, and the child count."""
    return level.groupBy(*keys, "window_start").agg(
        F.count(F.lit(1)).alias(children), *merged_state()
    )


def finish(
    level: DataFrame, minutes: int = model.WINDOW_MINUTES, digits: bool = False
) -> DataFrame:
    """Record columns of a level: window bounds, sums and means instead of state.

    A mean is over the readings that have the measure, and null if none has. An
    energy without any value is 0. ``digits=True`` rounds to the decimals a
    record is published with.
    """
    def mean(units: str, count: str, places: int) -> Column:
        return fixed.from_fixed(units, places) / F.nullif(F.col(count), F.lit(0))

    energy = F.coalesce(fixed.from_fixed("energy_units", model.ENERGY_DIGITS), F.lit(0.0))
    values = {
        "total_energy_kwh": (energy, 4),
        "avg_voltage": (mean("voltage_units", "voltage_count", model.VOLTAGE_DIGITS), 2),
        "avg_current": (mean("current_units", "current_count", model.CURRENT_DIGITS), 3),
    }
    measures = [
        (fixed.rounded(value, places) if digits else value).alias(name)
        for name, (value, places) in values.items()
    ]
    kept = [c for c in level.columns if c not in STATE and c != "window_start"]
    return level.select(
        *kept,
        "window_start",
        text.minutes_later(F.col("window_start"), minutes).alias("window_end"),
        F.lit(minutes).alias("window_duration_min"),
        "total_meters",
        *measures,
        "min_voltage",
        "max_voltage",
        "anomalies_count",
    )


def distributor_records(level2: DataFrame, minutes: int = model.WINDOW_MINUTES) -> DataFrame:
    """Level-2 records as published: rounded, with the window start once more as ``timestamp``."""
    return finish(level2, minutes, digits=True).withColumn("timestamp", text.iso(F.col("window_start")))


def concentrator_records(level3: DataFrame, minutes: int = model.WINDOW_MINUTES) -> DataFrame:
    """Level-3 records as published: like level 2, without a mean current."""
    return distributor_records(level3, minutes).drop("avg_current")


def center_records(
    center: DataFrame,
    districts: DataFrame,
    child_id: str,
    per_record: int = 1000,
) -> DataFrame:
    """Level-4 records as published: cycle records with their districts nested."""
    return nest_children(
        center,
        districts,
        ["window_start"],
        child_id,
        "districts_reported",
        per_record=per_record,
        totals=["districts_reported", "total_meters", "total_energy_kwh", "anomalies_count"],
    )


def weighted_mean(mean: Column, weight: Column, digits: int) -> Column:
    """Mean of group means weighted by group size, 0.0 when the weights sum to 0.

    A group without a mean has no weight. ``digits`` are the decimals of the values behind the means; the product of a
    mean and its count is a sum of such values.
    """
    total = F.nullif(F.sum(F.when(mean.isNotNull(), weight)), F.lit(0))
    return F.coalesce(fixed.fixed_sum(mean * weight, digits) / total, F.lit(0.0))


def recap(concentrators: DataFrame) -> DataFrame:
    """Level 4: one row of state per window over all concentrators."""
    return by_parent(concentrators, [], children="districts_reported")


def cycles(
    center: DataFrame,
    transmit_minutes: int = model.TRANSMIT_MINUTES,
    minutes: int = model.WINDOW_MINUTES,
) -> DataFrame:
    """Finished level-4 records with their cycle number and bounds."""
    done = finish(center, minutes)
    numbered = ordering.positions(
        done, ["window_start"], F.date_trunc("day", F.col("window_start")), position="cycle_id"
    )
    return _cycle_columns(numbered, transmit_minutes)


def stream_cycles(
    center: DataFrame,
    transmit_minutes: int = model.TRANSMIT_MINUTES,
    minutes: int = model.WINDOW_MINUTES,
) -> DataFrame:
    """Level-4 records numbered without a count of the windows before them.

    The number is the window's start written as ``yyyyMMddHHmm``: it rises with time and a
    restart or a late part of the history does not shift it.
    """
    number = F.date_format("window_start", "yyyyMMddHHmm").cast("bigint")
    return _cycle_columns(finish(center, minutes).withColumn("cycle_id", number), transmit_minutes)


def _cycle_columns(numbered: DataFrame, transmit_minutes: int) -> DataFrame:
    ends = text.minutes_later(F.col("window_end"), transmit_minutes)
    return numbered.select(
        "cycle_id",
        F.col("window_start").alias("cycle_start"),
        ends.alias("cycle_end"),
        "window_start",
        "window_end",
        "window_duration_min",
        "districts_reported",
        "total_meters",
        "total_energy_kwh",
        "anomalies_count",
    )


def nest_children(
    parents: DataFrame,
    children: DataFrame,
    keys: Sequence[str],
    child_id: str,
    child_count: str,
    into: str = "districts",
    per_record: int = 1000,
    totals: Sequence[str] = (),
) -> DataFrame:
    """Parent records holding their child rows as an array of structs.

    Each parent has ``parts`` records, numbered by ``part`` from 0; one with more
    than ``per_record`` children has several. The children are spread over them
    by a hash of their id, so no array grows with the data and no child is left
    out. The columns in ``totals`` are in part 0 only and null in the others:
    adding records up never counts a parent twice.
    """
    fields = [c for c in children.columns if c != child_id]
    record = F.struct(child_id, *fields).alias("_child")
    placed = children.select(*keys, record).join(parents, list(keys), "inner")
    parts = F.ceil(F.col(child_count) / F.lit(float(per_record))).cast("int")
    part = F.pmod(F.xxhash64(F.col("_child")[child_id]), parts).cast("int")
    records = placed.groupBy(*parents.columns, part.alias("_slot")).agg(
        F.array_sort(F.collect_list("_child")).alias(into)
    )
    # A parent has a few records at most: its children divided by per_record.
    own = Window.partitionBy(*keys)
    number = (F.row_number().over(own.orderBy("_slot")) - 1).alias("part")
    numbered = records.select("*", number, F.count(F.lit(1)).over(own).cast("int").alias("parts"))
    held = [
        F.when(F.col("part") == 0, F.col(c)).alias(c) if c in totals else F.col(c)
        for c in parents.columns
    ]
    return numbered.select(*held, "part", "parts", into)


def unnest_children(parents: DataFrame, column: str = "districts") -> DataFrame:
    """Child rows again."""
    return parents.select(F.inline(column))

"""Jobs that write: one batch roll-up with its messages and history."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from meterfold import model, scratch
from meterfold.functions import text
from meterfold.model import Band, Measures
from meterfold.operators import rollup
from meterfold.sources import history, messages
from meterfold.streaming import cascade


def roll_up(
    readings: DataFrame,
    hierarchy: DataFrame,
    target: messages.Target,
    history_path: str | None = None,
    parent_keys: Sequence[str] = ("concentrator_id", "district", "district_code", "zone_type"),
    measures: Measures = Measures(),
    band: Band = Band(),
    keep_windows: int = model.HISTORY_WINDOWS,
    first_cycle: int = 1,
    minutes: int = model.WINDOW_MINUTES,
    origin_minutes: int = 0,
    active: int | None = None,
    cycle: int = model.CYCLE_MINUTES,
    batch: str | None = None,
) -> DataFrame:
    """Publish all four levels of a batch of readings and log its windows.

    Windows begin ``origin_minutes`` after the epoch. ``active`` leaves out the readings after
    the first minutes of every cycle. With a ``batch`` name messages and history go to
    versioned tables and the job can be repeated without doubling them.

    ``hierarchy`` holds ``distributor_id`` and the parent keys. Levels 2 and 3
    are written once and read by every branch behind them, so the readings are
    read twice: for their own messages and for the roll-up. Returns level 4,
    which reads the stored level 3: run the job inside ``scratch.job`` and use the
    result there, which then deletes what this job stored and nothing else.
    """
    if active is not None:
        readings = cascade.duty_cycle(readings, measures.time, active, cycle, origin_minutes).drop("cycle_start")
    added = rollup.by_distributor(
        readings, measures=measures, band=band, minutes=minutes, origin_minutes=origin_minutes
    )
    level2 = scratch.stored(rollup.with_parents(added, hierarchy), "level2")
    level3 = scratch.stored(rollup.by_parent(level2, parent_keys), "level3")
    districts = rollup.concentrator_records(level3, minutes)
    shift = F.col("cycle_id") + F.lit(first_cycle - 1)
    cycles = rollup.cycles(rollup.recap(level3), minutes=minutes).withColumn("cycle_id", shift)
    recaps = rollup.center_records(cycles, districts, "concentrator_id")
    placed = rollup.distributor_records(level2, minutes)
    messages.publish(
        messages.message_frame(
            [
                messages.Route(readings, model.TOPIC_READINGS, F.col("meter_id")),
                messages.Route(placed, model.TOPIC_DISTRIBUTORS, F.col("distributor_id")),
                messages.Route(districts, model.TOPIC_CONCENTRATORS, F.col("concentrator_id")),
                messages.Route(recaps, model.TOPIC_CENTER, text.cycle_key(F.col("cycle_id"))),
            ]
        ),
        target,
        batch,
    )
    if history_path is not None and batch is not None:
        history.append_committed(districts, cycles, history_path, batch)
        history.trim_committed(readings.sparkSession, history_path, keep_windows)
    elif history_path is not None:
        history.append_history(districts, cycles, history_path)
        history.trim_history(readings.sparkSession, history_path, keep_windows)
    return cycles

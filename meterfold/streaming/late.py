"""Readings that come after their window has closed, as rows instead of losses.

A windowed aggregation drops a late reading unseen. Here a stateful processor keeps the
sums of every open window, emits them when the event-time timer of the window's end goes
off, and passes what arrives afterwards on as rows marked ``late``.
"""

from __future__ import annotations

from collections.abc import Iterator, Mapping

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle
from pyspark.sql.types import LongType, StructField, StructType

from meterfold import model

#: Parts of a window that are kept apart, so a busy window is not one task's work.
SLOTS = 16


class _Windows(StatefulProcessor):
    """Sums of one slot of one window. A key is (end of the window in ms, slot)."""

    def __init__(self, names: list[str]):
        self._names = names

    def init(self, handle: StatefulProcessorHandle) -> None:
        self._handle = handle
        self._sums = handle.getValueState("sums", StructType([StructField(n, LongType()) for n in self._names]))

    def _row(self, key, late: bool, sums: list[int]) -> pd.DataFrame:
        return pd.DataFrame({"end_ms": [key[0]], "slot": [key[1]], "late": [late], **{n: [s] for n, s in zip(self._names, sums)}})

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        sums = [0] * len(self._names)
        for part in rows:
            sums = [s + int(part[n].sum()) for n, s in zip(self._names, sums)]
        if key[0] <= timerValues.getCurrentWatermarkInMs():
            yield self._row(key, True, sums)
            return
        if self._sums.exists():
            sums = [s + h for s, h in zip(sums, self._sums.get())]
        else:
            self._handle.registerTimer(key[0])
        self._sums.update(tuple(sums))

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        yield self._row(key, False, list(self._sums.get()))
        self._sums.clear()

    def close(self) -> None:
        pass


def closed_and_late(
    readings: DataFrame,
    time: str,
    sums: Mapping[str, Column],
    spread: Column,
    minutes: int = model.WINDOW_MINUTES,
    origin_minutes: int = 0,
    slots: int = SLOTS,
) -> DataFrame:
    """Rows of closed windows and of late readings, from a watermarked stream.

    Each has ``window_start``, ``late``, ``slot`` and the whole-number ``sums`` (a null adds
    nothing). A window closes when the watermark reaches its end and gives one row per slot
    then; the readings of a batch that come later give one row per window and slot. Adding up
    the slots gives the window (:func:`per_window`). ``spread`` deals readings out to slots.
    A reading without a time is in no window.

    The event time itself does not go into the processor: rows that still carry it
    would be dropped by the engine once they are behind the watermark.
    """
    width, origin = minutes * 60_000, origin_minutes * 60_000
    millis = F.unix_millis(F.col(time).cast("timestamp")) - F.lit(origin)
    end = millis - F.pmod(millis, F.lit(width)) + F.lit(width + origin)
    keyed = readings.select(
        end.alias("end_ms"),
        F.pmod(F.xxhash64(spread), F.lit(slots)).cast("int").alias("slot"),
        *[F.coalesce(value.cast("bigint"), F.lit(0)).alias(name) for name, value in sums.items()],
    )
    columns = "".join(f", {name} bigint" for name in sums)
    found = keyed.where(F.col("end_ms").isNotNull()).groupBy("end_ms", "slot").transformWithStateInPandas(
        statefulProcessor=_Windows(list(sums)),
        outputStructType=f"end_ms bigint, slot int, late boolean{columns}",
        outputMode="append",
        timeMode="eventTime",
    )
    start = F.timestamp_millis(F.col("end_ms") - F.lit(width)).cast("timestamp_ntz")
    return found.select(start.alias("window_start"), "late", "slot", *sums)


def per_window(rows: DataFrame, sums: list[str]) -> DataFrame:
    """Stored rows of :func:`closed_and_late` with their slots added up."""
    return rows.groupBy("window_start", "late").agg(*[F.sum(name).alias(name) for name in sums])

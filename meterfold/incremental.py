"""The roll-up kept as a table that batches are merged into.

A batch of readings is added up by distributor and window like a roll-up of its own. Only
the days it touches are read again, merged and written as new segments, level by level;
the segments of all other days stay the files they are. One manifest holds the levels
together: a reader sees all of a batch or nothing of it, and a batch that is repeated
counts once.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from meterfold import model, scratch
from meterfold.model import Band, Measures
from meterfold.operators import rollup
from meterfold.sources import versions

DAY = "window_date"
LEVELS = ("level2", "level3", "level4")


def _schema(keys: str, children: str | None) -> str:
    """Columns of a stored level: keys, window, children, state."""
    counted = f"{children} bigint, " if children else ""
    state = ", ".join(f"{n} {'double' if n in ('min_voltage', 'max_voltage') else 'bigint'}" for n in rollup.STATE)
    return f"{keys}{', ' if keys else ''}window_start timestamp_ntz, {counted}{state}"


class RollUpTable:
    """Levels 2 to 4 at ``path``.

    ``hierarchy`` has ``distributor_id`` and the parent keys; it is applied anew to the touched
    days whenever a batch is merged. Readings of a distributor without a parent stay in
    level 2 only.
    """

    def __init__(
        self,
        spark: SparkSession,
        path: str,
        hierarchy: DataFrame,
        parent_keys: Sequence[str],
        measures: Measures = Measures(),
        band: Band = Band(),
        minutes: int = model.WINDOW_MINUTES,
    ):
        self.spark, self.path, self.hierarchy = spark, path, hierarchy
        self.parent_keys, self.measures, self.band, self.minutes = list(parent_keys), measures, band, minutes
        kinds = dict(hierarchy.dtypes)
        parents = ", ".join(f"{k} {kinds[k]}" for k in self.parent_keys)
        self.schemas = {
            "level2": _schema(f"distributor_id {kinds['distributor_id']}", None),
            "level3": _schema(parents, "total_distributors"),
            "level4": _schema("", "districts_reported"),
        }

    def read(self, level: str, days: Sequence[str] | None = None, version: int | None = None) -> DataFrame:
        """Mergeable state of a level, of some days or of all; ``rollup.finish`` makes records of it."""
        held = versions.manifest(self.spark, self.path, version)
        keys = [s.key for s in held.segments if s.key.startswith(f"{level}/")]
        if days is not None:
            keys = [k for k in keys if k.partition("/")[2] in set(days)]
        return versions.read(self.spark, self.path, "parquet", self.schemas[level], keys, held.version)

    def _written(self, rows: DataFrame, level: str, batch: str):
        day = F.date_format("window_start", "yyyy-MM-dd")
        dealt = rows.withColumn(DAY, day).hint("rebalance", DAY)
        segments, written = versions.write(dealt, self.path, batch, "parquet", DAY)
        return versions.renamed(segments, f"{level}/"), written

    def merge(self, readings: DataFrame, batch: str) -> list[str]:
        """Add a batch; the days it touches, none if it was merged before.

        Two merges at the same time do not mix: the second to commit raises
        ``versions.Conflict`` and has to be run again on the new version.
        """
        base = versions.manifest(self.spark, self.path)
        if base.has(batch):
            return []
        with scratch.job(self.spark):
            change = scratch.stored(
                rollup.by_distributor(readings, measures=self.measures, band=self.band, minutes=self.minutes), "change"
            )
            touched = change.select(F.date_format("window_start", "yyyy-MM-dd").alias("day")).distinct()
            days = sorted(r["day"] for r in touched.collect())
            if not days:
                return []
            old = self.read("level2", days, base.version)
            columns = change.columns
            merged = old.select(*columns).unionByName(change).groupBy("distributor_id", "window_start")
            level2 = merged.agg(*rollup.merged_state())
            add, written = self._written(level2, "level2", batch)
            stored2 = self.spark.read.schema(self.schemas["level2"]).parquet(*[s.path for s in add])
            placed = rollup.with_parents(stored2, self.hierarchy)
            more, _ = self._written(rollup.by_parent(placed, self.parent_keys), "level3", batch)
            add += more
            if more:
                stored3 = self.spark.read.schema(self.schemas["level3"]).parquet(*[s.path for s in more])
                more, _ = self._written(rollup.recap(stored3), "level4", batch)
                add += more
        gone = [s for s in base.segments if s.key.partition("/")[2] in set(days)]
        versions.commit(self.spark, self.path, base, add, gone, written)
        return days

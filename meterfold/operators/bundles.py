"""Report sets: the frames behind the console report and the dashboard."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from meterfold import model
from meterfold.functions import bands
from meterfold.model import Band
from meterfold.operators import counting, lookup, reports, series
from meterfold.sources import messages
from meterfold.sources.history import History

DISTRICT_CRITICAL = 5
CYCLE_CRITICAL = 50


def district_table(districts: DataFrame) -> DataFrame:
    """District rows by falling energy, with severity and low-voltage bands."""
    ranked = districts.withColumn(
        "severity", bands.severity(F.col("anomalies_count"), DISTRICT_CRITICAL)
    ).withColumn("low_level", bands.low_level(F.col("min_voltage")))
    return ranked.orderBy(F.desc("total_energy_kwh"), "district")


def console_report(
    log: DataFrame, n: int = 10, band: Band = Band(), window_start: str | None = None
) -> dict[str, DataFrame]:
    """Frames of the console report over an envelope log of (topic, key, value).

    Without ``window_start`` the tables cover all windows in the log.
    """

    def typed(topic: str, schema: str) -> DataFrame:
        rows = messages.of_topic(log, topic, schema)
        if window_start is None or "window_start" not in rows.columns:
            return rows
        return rows.where(F.col("window_start") == window_start)

    readings = typed(model.TOPIC_READINGS, model.READING_SCHEMA)
    distributors = typed(model.TOPIC_DISTRIBUTORS, model.DISTRIBUTOR_SCHEMA)
    concentrators = typed(model.TOPIC_CONCENTRATORS, model.CONCENTRATOR_SCHEMA)
    recaps = typed(model.TOPIC_CENTER, model.RECAP_SCHEMA).drop("districts")
    last = series.last_rows(recaps, "cycle_id", 1)
    zones = reports.group_breakdown(
        concentrators,
        "zone_type",
        "total_energy_kwh",
        "total_meters",
        "anomalies_count",
        model.ENERGY_DIGITS,
    )
    return {
        "messages": counting.topic_counts(log),
        "last_cycle": last.withColumn(
            "severity", bands.severity(F.col("anomalies_count"), CYCLE_CRITICAL)
        ),
        "zones": zones.orderBy(F.desc("energy"), "zone_type"),
        "districts": district_table(concentrators),
        "district_totals": reports.with_total_row(
            concentrators,
            ["district"],
            ["total_meters", "total_distributors", "total_energy_kwh", "anomalies_count"],
        ),
        "histogram": reports.with_ratio_to_max(
            concentrators.select("district", "zone_type", "total_energy_kwh"),
            "total_energy_kwh",
        ),
        "top_distributors": reports.top_n(
            distributors, "total_energy_kwh", n, "distributor_id"
        ),
        "voltage_anomalies": reports.top_outliers(readings, "voltage", n, "meter_id", band),
    }


def dashboard(
    history: History,
    coordinates: DataFrame,
    trend: int = 10,
    timeline: int = 12,
    top: int = 5,
    required_zone: str = "Industrial",
) -> dict[str, DataFrame]:
    """Frames of the dashboard over a window history.

    Each frame reads the history on its own; pass stored tables when the log is
    large.
    """
    districts, cycles = history.districts, history.cycles
    current = cycles.agg(F.max("window_start").alias("v")).scalar()
    latest = series.row_at_or_latest(districts, ["district"], "window_start", current)
    selected = reports.top_with_required(
        latest, "total_energy_kwh", "district", "zone_type", required_zone, top
    )
    places = {"latitude": model.DEFAULT_LATITUDE, "longitude": model.DEFAULT_LONGITUDE}
    steps = series.last_windows(districts, "window_start", trend)
    shown = series.with_change(cycles, "window_start", "total_energy_kwh", timeline)
    return {
        "headline": series.headline(cycles, "window_start", "total_energy_kwh").withColumn(
            "severity", bands.severity(F.col("anomalies_count"), CYCLE_CRITICAL)
        ),
        "timeline": shown.withColumn(
            "severity", bands.severity(F.col("anomalies_count"), CYCLE_CRITICAL)
        ),
        "districts": district_table(latest),
        "bars": reports.with_ratio_to_max(
            latest.select("district", "zone_type", "total_energy_kwh"), "total_energy_kwh"
        ),
        "map": lookup.look_up(latest, coordinates, ["district"], places),
        "total_series": reports.with_plot_scale(
            series.last_rows(cycles, "window_start", trend), "total_energy_kwh"
        ),
        "district_series": lookup.dense_grid(
            selected, steps, districts, ["district"], "window_start", "total_energy_kwh"
        ),
    }

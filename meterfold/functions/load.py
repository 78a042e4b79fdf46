"""Expected load by zone and hour, and power derived from energy."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F

# --- fixed values ---------------------------------------------------------
# Mean kWh of one meter in one window, by zone; other zones use the default.
BASE_ENERGY = {"Residential": 0.45, "Commercial": 1.20, "Industrial": 3.50}
DEFAULT_BASE_ENERGY = 0.45
# Watts per kWh drawn in a quarter of an hour.
WATTS_PER_WINDOW_KWH = 4000.0
# Weekend factor by zone; other zones use the default.
WEEKEND_FACTOR = {"Industrial": 0.45, "Residential": 1.10}
DEFAULT_WEEKEND_FACTOR = 1.05


@dataclass(frozen=True)
class Peak:
    """Bell-shaped peak: height, hour of the top, spread in hours."""

    height: float
    hour: float
    spread: float


@dataclass(frozen=True)
class Plateau:
    """Working-hours plateau between two logistic slopes."""

    height: float
    rise_hour: float
    rise_slope: float
    fall_hour: float
    fall_slope: float


# --- fixed values: floor and shapes of each zone's day ---------------------
RESIDENTIAL_DAY = (0.30, (Peak(0.85, 8.0, 1.2), Peak(1.45, 20.5, 1.5)))
COMMERCIAL_DAY = (0.30, (Peak(0.95, 11.5, 1.4), Peak(1.20, 20.0, 1.4)))
INDUSTRIAL_DAY = (0.20, (Plateau(1.20, 7.5, 1.6, 18.0, 1.4),))
ZONE_DAYS = {
    "Residential": RESIDENTIAL_DAY,
    "Industrial": INDUSTRIAL_DAY,
    "Commercial": COMMERCIAL_DAY,
}


def _shape(part: Peak | Plateau, hour: Column) -> Column:
    if isinstance(part, Peak):
        gap = hour - F.lit(part.hour)
        return F.lit(part.height) * F.exp(-(gap * gap) / F.lit(2.0 * part.spread**2))
    rise = F.lit(1.0) / (1.0 + F.exp(-(hour - F.lit(part.rise_hour)) * F.lit(part.rise_slope)))
    fall = F.lit(1.0) / (1.0 + F.exp((hour - F.lit(part.fall_hour)) * F.lit(part.fall_slope)))
    return F.lit(part.height) * rise * fall


def _day(day: tuple, hour: Column) -> Column:
    floor, parts = day
    total = F.lit(floor)
    for part in parts:
        total = total + _shape(part, hour)
    return total


def decimal_hour(ts: Column) -> Column:
    """Hour of the day with minutes as a fraction (14:15 is 14.25)."""
    return F.hour(ts) + F.minute(ts) / F.lit(60.0)


def is_weekend(ts: Column) -> Column:
    """True on Saturday and Sunday."""
    return F.weekday(ts) >= F.lit(5)


def _by_zone(zone: Column, values: Mapping[str, object], default: Column) -> Column:
    picked = None
    for name, value in values.items():
        value = value if isinstance(value, Column) else F.lit(value)
        hit = zone == F.lit(name)
        picked = F.when(hit, value) if picked is None else picked.when(hit, value)
    return default if picked is None else picked.otherwise(default)


def hourly_factor(zone: Column, hour: Column) -> Column:
    """Load factor of a zone at a decimal hour; unknown zones are residential."""
    days = {name: _day(day, hour) for name, day in ZONE_DAYS.items() if name != "Residential"}
    return _by_zone(zone, days, _day(RESIDENTIAL_DAY, hour))


def expected_energy(zone: Column, ts: Column) -> Column:
    """Expected kWh of one meter in the window of ``ts``."""
    base = _by_zone(zone, BASE_ENERGY, F.lit(DEFAULT_BASE_ENERGY))
    weekend = _by_zone(zone, WEEKEND_FACTOR, F.lit(DEFAULT_WEEKEND_FACTOR))
    factor = F.when(is_weekend(ts), weekend).otherwise(F.lit(1.0))
    return base * hourly_factor(zone, decimal_hour(ts)) * factor


def mean_power(energy: Column) -> Column:
    """Mean watts over a window from its kWh."""
    return energy * F.lit(WATTS_PER_WINDOW_KWH)


def mean_current(energy: Column, voltage: Column) -> Column:
    """Amperes from mean power; the voltage counts as at least one volt."""
    return mean_power(energy) / F.greatest(voltage, F.lit(1.0))

"""Record layouts and the fixed values of the metering domain."""

from __future__ import annotations

from dataclasses import dataclass

# --- fixed values ---------------------------------------------------------
# Window and cycle lengths in minutes.
WINDOW_MINUTES = 15
CYCLE_MINUTES = 30
TRANSMIT_MINUTES = 2
# Windows kept by the history log.
HISTORY_WINDOWS = 96
# Decimals each measure carries when a reading is emitted.
ENERGY_DIGITS = 4
VOLTAGE_DIGITS = 2
CURRENT_DIGITS = 3
# Coordinates of an area that is not in the lookup table.
DEFAULT_LATITUDE = 35.575
DEFAULT_LONGITUDE = -5.365
# Topics, one per level.
TOPIC_READINGS = "meters.readings"
TOPIC_DISTRIBUTORS = "distributors.aggregated"
TOPIC_CONCENTRATORS = "concentrators.aggregated"
TOPIC_CENTER = "center.ingest"


@dataclass(frozen=True)
class Band:
    """Accepted range of a measure; both limits belong to it."""

    low: float = 207.0
    high: float = 253.0
    nominal: float = 230.0


@dataclass(frozen=True)
class Measures:
    """Column names of a reading that the roll-up uses."""

    time: str = "timestamp"
    energy: str = "energy_consumption"
    voltage: str = "voltage"
    current: str = "current"


# --- schemas (DDL) --------------------------------------------------------
ENVELOPE_SCHEMA = "topic STRING, key STRING, value STRING"

READING_SCHEMA = """
    meter_id STRING, distributor_id STRING, concentrator_id STRING, district STRING,
    district_code STRING, zone_type STRING, timestamp STRING,
    energy_consumption DOUBLE, voltage DOUBLE, current DOUBLE,
    latitude DOUBLE, longitude DOUBLE
"""

DISTRIBUTOR_SCHEMA = """
    distributor_id STRING, concentrator_id STRING, district STRING, district_code STRING,
    zone_type STRING, window_start STRING, window_end STRING, timestamp STRING,
    window_duration_min INT, total_meters BIGINT, total_energy_kwh DOUBLE,
    avg_voltage DOUBLE, min_voltage DOUBLE, max_voltage DOUBLE, avg_current DOUBLE,
    anomalies_count BIGINT
"""

CONCENTRATOR_SCHEMA = """
    concentrator_id STRING, district STRING, district_code STRING, zone_type STRING,
    window_start STRING, window_end STRING, timestamp STRING, window_duration_min INT,
    total_distributors BIGINT, total_meters BIGINT, total_energy_kwh DOUBLE,
    avg_voltage DOUBLE, min_voltage DOUBLE, max_voltage DOUBLE, anomalies_count BIGINT
"""

_CYCLE_FIELDS = """
    cycle_id BIGINT, cycle_start STRING, cycle_end STRING, window_start STRING,
    window_end STRING, window_duration_min INT, districts_reported BIGINT,
    total_meters BIGINT, total_energy_kwh DOUBLE, anomalies_count BIGINT
"""

#: ``part`` and ``parts`` number the records of a centre with very many districts.
RECAP_SCHEMA = f"{_CYCLE_FIELDS}, part INT, parts INT, districts ARRAY<STRUCT<{CONCENTRATOR_SCHEMA}>>"

#: One wide layout for both kinds of history row and for envelope lines.
HISTORY_SCHEMA = f"""
    kind STRING, topic STRING, value STRING, {CONCENTRATOR_SCHEMA},
    cycle_id BIGINT, cycle_start STRING, cycle_end STRING, districts_reported BIGINT
"""

"""Schemas of the landed inputs, fixed at ingest (no inference passes)."""

from __future__ import annotations

from .fixed_values import FORECAST_SLOTS, SLOT_CONC_COLUMN, SLOT_INDEX_COLUMN

SENSOR_PAGE = """results ARRAY<STRUCT<value: DOUBLE, sensorType: STRING, parameter: STRUCT<name: STRING, units: STRING>,
  period: STRUCT<datetimeFrom: STRUCT<utc: STRING, local: STRING>>>>"""

_SLOTS = ", ".join(
    f"`{c.format(label)}`: DOUBLE" for c in (SLOT_CONC_COLUMN, SLOT_INDEX_COLUMN) for _, label in FORECAST_SLOTS)
STATION_PROPERTIES = f"UTC_DATE: STRING, Station: STRING, Site_Name: STRING, DAILY_AQI: DOUBLE, {_SLOTS}"
STATION_GEOJSON = f"""features ARRAY<STRUCT<geometry: STRUCT<coordinates: ARRAY<DOUBLE>>,
  properties: STRUCT<{STATION_PROPERTIES}>>>"""

SITE_OPTIONS = "STRUCT<time_col: STRING, val_col: STRING, file: STRING, time_parser: STRING, unit: STRING>"
SITE_ENTRY = f"""STRUCT<location_name: STRING, lat: DOUBLE, lon: DOUBLE, observation_source: STRING,
  obs_options: MAP<STRING, {SITE_OPTIONS}>>"""
SITE_REGISTRY = f"MAP<STRING, {SITE_ENTRY}>"

SITE_INDEX = "location_name STRING, species STRING, sources ARRAY<STRING>"

MONITOR = """siteName STRING, stationID STRING, coordinates ARRAY<DOUBLE>,
  monitors ARRAY<STRUCT<parameterName: STRING>>"""

LOCATIONS = """results ARRAY<STRUCT<id: BIGINT, name: STRING, provider: STRUCT<name: STRING>,
  coordinates: STRUCT<latitude: DOUBLE, longitude: DOUBLE>,
  sensors: ARRAY<STRUCT<id: BIGINT, parameter: STRUCT<name: STRING>>>>>"""


def document(fields: dict[str, str]) -> str:
    """Forecast document whose forecast rows carry ``fields`` (name -> type) besides the times."""
    rows = ", ".join(f"`{n}`: {t}" for n, t in {"time": "STRING", "local_time": "STRING", **fields}.items())
    return f"""location STRING, lat DOUBLE, lon DOUBLE, species STRING, timezone STRING, observation_source STRING,
  sources ARRAY<STRING>, forecasts ARRAY<STRUCT<{rows}>>"""

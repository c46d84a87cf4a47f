"""Cleaning and enrichment rules as Column expressions (JVM-side, codegen-friendly)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values of the data model (must stay as they are for matching results):
# valid speed 0..200, temperature -10..60, humidity 0..100 (inclusive);
# AQI bands: <= 50 Good, <= 100 Moderate, <= 150 Unhealthy for Sensitive, otherwise Unhealthy;
# heat index = round(temperature + 0.33 * humidity / 10 - 4.0, 1);
# fuel type "Electric" marks an EV, status "Active" an open incident,
# incident type "None" (a string value) means no real incident.
SPEED_RANGE = (0, 200)
TEMPERATURE_RANGE = (-10, 60)
HUMIDITY_RANGE = (0, 100)
AQI_BANDS = ((50, "Good"), (100, "Moderate"), (150, "Unhealthy for Sensitive"))
AQI_OTHERWISE = "Unhealthy"
HEAT_INDEX_HUMIDITY_FACTOR = 0.33
HEAT_INDEX_OFFSET = 4.0
ELECTRIC = "Electric"
ACTIVE = "Active"
RESOLVED = "Resolved"
NO_INCIDENT = "None"


def _c(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def speed_ok(c: str | Column = "speed") -> Column:
    """Inclusive [0, 200]; null and NaN fail."""
    return _c(c).between(*SPEED_RANGE)


def temperature_ok(c: str | Column = "temperature") -> Column:
    return _c(c).between(*TEMPERATURE_RANGE)


def humidity_ok(c: str | Column = "humidity") -> Column:
    return _c(c).between(*HUMIDITY_RANGE)


def event_date(ts: str | Column = "timestamp") -> Column:
    """Calendar date of the event as STRING yyyy-MM-dd (the partition value)."""
    return F.to_date(_c(ts)).cast("string")


def event_hour(ts: str | Column = "timestamp") -> Column:
    return F.hour(_c(ts))


def speed_kmh(c: str | Column = "speed") -> Column:
    return F.round(_c(c), 1)


def is_ev(c: str | Column = "fuelType") -> Column:
    """Three-valued: a null fuel type stays null."""
    return _c(c) == ELECTRIC


def heat_index(temperature: str | Column = "temperature", humidity: str | Column = "humidity") -> Column:
    return F.round(_c(temperature) + HEAT_INDEX_HUMIDITY_FACTOR * _c(humidity) / 10 - HEAT_INDEX_OFFSET, 1)


def aqi_category(c: str | Column = "airQualityIndex") -> Column:
    """Banded AQI label; a null index falls through to the last band."""
    expr = None
    for upper, label in AQI_BANDS:
        expr = F.when(_c(c) <= upper, label) if expr is None else expr.when(_c(c) <= upper, label)
    return expr.otherwise(AQI_OTHERWISE)


def is_active(c: str | Column = "status") -> Column:
    return _c(c) == ACTIVE


def is_real_incident(c: str | Column = "type") -> Column:
    """`type != 'None'`; a null type stays null."""
    return _c(c) != NO_INCIDENT


def not_none_type(c: str | Column = "type") -> Column:
    """`type != 'None'` with pandas semantics: a null type is kept."""
    return ~_c(c).eqNullSafe(NO_INCIDENT)


def lat_lon(c: str | Column = "location") -> tuple[Column, Column]:
    """Location text `[lat, lon]` -> (lat, lon) doubles; bad text or short arrays give null."""
    arr = F.from_json(_c(c), "array<double>")
    return F.get(arr, 0), F.get(arr, 1)

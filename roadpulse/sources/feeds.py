"""Deterministic derivation of the five telemetry feeds from an observation table.

One observed step (a row of `events`: event_id, ts, user_id, event_type, value) yields one
record in each feed; the records share vehicle, timestamp and location, as a vehicle
publishing all five readings at one instant would. Every tenth step is delivered twice
(identical re-delivery), so deduplication has real work and a deterministic answer.
All columns are integer arithmetic or string building over the step number, so any engine
derives identical values. The projection is narrow: no shuffle, one pass over the input.
"""

from __future__ import annotations

from pyspark.sql import DataFrame

from roadpulse.schemas import EMERGENCY, FEED_SCHEMAS, GPS, TRAFFIC, VEHICLE, WEATHER

# Fixed values of the feed domains (producer value lists), in their natural order.
MAKES = ["Toyota", "Kia", "Hyundai", "VinFast", "Ford"]
MODELS = ["Vios", "Morning", "Accent", "VF8", "Ranger"]
FUEL_TYPES = ["Gasoline", "Electric", "Hybrid"]
WEATHER_CONDITIONS = ["Sunny", "Cloudy", "Rain", "Stormy"]
INCIDENT_TYPE_BY_EVENT = {"error": "Accident", "signup": "Fire", "purchase": "Medical",
                          "click": "Police", "view": "None"}
STATUSES = ["Active", "Resolved"]
DIRECTION = "South-East"
VEHICLE_TYPE = "private"
CAMERA_PREFIX = "Camera-HighwayAI-0"
SNAPSHOT = "Base64EncodedString"
DESCRIPTION = "Incident on the expressway"
ID_PREFIX = {VEHICLE: "veh-", GPS: "gps-", TRAFFIC: "cam-", WEATHER: "wx-", EMERGENCY: "emg-"}
REDELIVERY_EVERY = 10   # every 10th step is delivered twice
NULL_VEHICLE_EVERY = 101
NULL_FUEL_EVERY = 97    # fuel type missing on every 97th step
NULL_AQI_EVERY = 89     # AQI missing on every 89th step


def _q(text: str) -> str:
    """SQL string literal."""
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


def _pick(options: list[str], index_sql: str) -> str:
    return f"element_at(array({', '.join(_q(o) for o in options)}), CAST(({index_sql}) + 1 AS INT))"


def _tenths(int_sql: str) -> str:
    return f"(CAST({int_sql} AS DOUBLE) / 10.0D)"


def observations(events: DataFrame) -> DataFrame:
    """Steps with re-deliveries: every row once, every REDELIVERY_EVERY-th row a second
    time. One scan: the second copy is generated next to the first (no union re-scan).
    Columns: n (the step number), ts, user_id, event_type, value."""
    return events.selectExpr(
        "event_id AS n", "ts", "user_id", "event_type", "value",
        f"explode(IF(event_id % {REDELIVERY_EVERY} = 0, array(0, 1), array(0))) AS _copy").drop("_copy")


def feed_exprs(feed: str, n: str = "n") -> list[str]:
    """SQL expressions of one feed record over an observation row (`n` names the step
    column; ts, user_id, event_type, value), in schema order, each cast to its schema type.
    Built as text so the whole projection reaches the JVM in one call."""
    exprs = _feed_sql(feed, n)
    return [f"CAST({exprs[f.name]} AS {f.dataType.simpleString()}) AS `{f.name}`" for f in FEED_SCHEMAS[feed].fields]


def _feed_sql(feed: str, n: str) -> dict[str, str]:
    common = {
        "id": f"concat({_q(ID_PREFIX[feed])}, CAST({n} AS STRING))",
        "vehicle_id": "concat('Vehicle-', CAST(user_id AS STRING))",
        "timestamp": "CAST(ts AS TIMESTAMP)",
        "location": f"concat('[10.', CAST(4113 + {n} % 3657 AS STRING), '1,106.', CAST(7009 + {n} % 2991 AS STRING), '1]')",
    }
    if feed == VEHICLE:
        specific = {
            "vehicle_id": f"CASE WHEN {n} % {NULL_VEHICLE_EVERY} <> 0 THEN concat('Vehicle-', CAST(user_id AS STRING)) END",
            "speed": f"value + CAST({n} % 8 AS DOUBLE) / 1000.0D", "direction": _q(DIRECTION),
            "make": _pick(MAKES, f"{n} % 5"), "model": _pick(MODELS, f"({n} div 5) % 5"),
            "year": f"2018 + {n} % 7",
            "fuelType": f"CASE WHEN {n} % {NULL_FUEL_EVERY} <> 0 THEN {_pick(FUEL_TYPES, f'{n} % 3')} END",
        }
    elif feed == GPS:
        specific = {"speed": "value", "direction": _q(DIRECTION), "vehicleType": _q(VEHICLE_TYPE)}
    elif feed == TRAFFIC:
        specific = {"camera_id": f"concat({_q(CAMERA_PREFIX)}, CAST({n} % 5 AS STRING))", "snapshot": _q(SNAPSHOT)}
    elif feed == WEATHER:
        specific = {
            "temperature": f"CAST(({n} * 7919) % 80000 AS DOUBLE) / 1000.0D - 15.0D",
            "weatherCondition": _pick(WEATHER_CONDITIONS, f"{n} % 4"),
            "precipitation": _tenths(f"({n} * 3) % 500"),
            "windSpeed": _tenths(f"({n} * 11) % 600"),
            "humidity": f"CAST({n} % 111 AS INT) - 5",
            "airQualityIndex": f"CASE WHEN {n} % {NULL_AQI_EVERY} <> 0 THEN {_tenths(f'({n} * 13) % 2500')} END",
        }
    elif feed == EMERGENCY:
        pairs = ", ".join(f"{_q(k)}, {_q(v)}" for k, v in INCIDENT_TYPE_BY_EVENT.items())
        specific = {
            "incidentId": f"concat('inc-', CAST({n} AS STRING))",
            "type": f"try_element_at(map({pairs}), event_type)",
            "status": _pick(STATUSES, f"{n} % 2"),
            "description": _q(DESCRIPTION),
        }
    else:
        raise KeyError(feed)
    return {**common, **specific}


def derive_feed(events: DataFrame, feed: str) -> DataFrame:
    """Raw records of one feed derived from the observation table (with re-deliveries):
    one statement, one scan; LATERAL VIEW generates the second copy of every
    REDELIVERY_EVERY-th step."""
    return events.sparkSession.sql(
        f"SELECT {', '.join(feed_exprs(feed, 'event_id'))} FROM {{events}} "
        f"LATERAL VIEW explode(IF(event_id % {REDELIVERY_EVERY} = 0, array(0, 1), array(0))) copies AS _copy",
        events=events)

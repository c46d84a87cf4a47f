"""Named analytic reports over the refined tables (catalog or path), for production runs.

Each report is an operator from roadpulse.operators applied to refined DataFrames; inputs
come from `scan` (catalog tables, partition-pruned when dates are given) so nothing is
recomputed from raw data.
"""

from __future__ import annotations

from collections.abc import Callable
from inspect import signature

from pyspark.sql import DataFrame

from roadpulse.operators import dashboard as D
from roadpulse.operators import emergency as E
from roadpulse.operators import temporal as X
from roadpulse.operators import vehicle as V
from roadpulse.schemas import EMERGENCY, VEHICLE, WEATHER

Tables = dict[str, DataFrame]

REPORTS: dict[str, tuple[tuple[str, ...], Callable[..., DataFrame]]] = {
    "speed_by_make_fuel": ((VEHICLE,), V.speed_by_make_fuel),
    "speed_by_hour": ((VEHICLE,), V.speed_by_hour),
    "ev_share_by_date": ((VEHICLE,), V.ev_share_by_date),
    "top_models": ((VEHICLE,), V.top_models),
    "speed_by_weather": ((VEHICLE, WEATHER), V.speed_by_weather),
    "daily_kpi": ((VEHICLE, WEATHER, EMERGENCY), V.daily_kpi),
    "daily_kpi_exact": ((VEHICLE, WEATHER, EMERGENCY), V.daily_kpi_exact),
    "speed_by_make": ((VEHICLE,), V.speed_by_make),
    "incidents_by_day": ((EMERGENCY,), E.incidents_by_day),
    "active_incidents": ((EMERGENCY,), E.active_incidents),
    "resolution_rate": ((EMERGENCY,), E.resolution_rate),
    "incidents_by_hour_of_day": ((EMERGENCY,), E.incidents_by_hour_of_day),
    "top_incident_vehicles": ((EMERGENCY,), E.top_incident_vehicles),
    "active_incident_feed": ((EMERGENCY,), E.active_incident_feed),
    "kpi_row": ((VEHICLE, WEATHER, EMERGENCY), D.kpi_row),
    "speed_timeline": ((VEHICLE,), D.speed_timeline),
    "mean_speed_by_hour": ((VEHICLE,), D.mean_speed_by_hour),
    "make_counts": ((VEHICLE,), lambda v: D.value_counts(v, "make")),
    "fuel_share": ((VEHICLE,), lambda v: D.value_counts(v, "fuelType", share=True)),
    "speed_mean_max_by_make": ((VEHICLE,), D.speed_mean_max_by_make),
    "weather_series": ((WEATHER,), D.weather_series),
    "condition_share": ((WEATHER,), lambda w: D.value_counts(w, "weatherCondition", share=True, label="condition")),
    "aqi_counts": ((WEATHER,), lambda w: D.value_counts(w, "aqi_category", label="category")),
    "incident_type_counts": ((EMERGENCY,), D.incident_type_counts),
    "active_table": ((EMERGENCY,), D.active_table),
    "incident_timeline": ((EMERGENCY,), D.incident_timeline),
    "latest_vehicle": ((VEHICLE,), lambda v, n=500: D.latest(v, D.VEHICLE_COLUMNS, n)),
    "latest_weather": ((WEATHER,), lambda w, n=500: D.latest(w, D.WEATHER_COLUMNS, n)),
    "latest_emergency": ((EMERGENCY,), lambda e, n=500: D.latest(e, D.EMERGENCY_COLUMNS, n)),
    "trips": ((VEHICLE,), X.trips),
    "asof_weather": ((VEHICLE, WEATHER), X.asof_weather),
}


def run_report(name: str, tables: Tables, *, latest: int | None = None, **kw) -> DataFrame:
    """Run a named report. With `latest`, each input is first cut to its newest `latest`
    rows -- the dashboard's own scope (it shows its cards over the newest 500 rows)."""
    feeds, fn = REPORTS[name]
    unknown = set(kw) - set(signature(fn).parameters)
    if unknown:
        raise ValueError(f"report {name} takes no {', '.join(sorted(unknown))}")
    inputs = [tables[f] for f in feeds]
    if latest:
        inputs = [D.latest_rows(df, latest) for df in inputs]
    return fn(*inputs, **kw)

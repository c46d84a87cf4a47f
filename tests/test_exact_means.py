"""Means of raw measurements keep all decimals; pair sums outgrow a BIGINT without harm."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from roadpulse.operators import dashboard as D
from roadpulse.operators import vehicle as V
from roadpulse.operators.refine import refine_emergency, refine_vehicle, refine_weather
from roadpulse.schemas import EMERGENCY, FEED_SCHEMAS, VEHICLE, WEATHER

T0 = dt.datetime(2024, 1, 5, 7, 0)


def _rows(spark, feed, values, refine):
    """Rows of a feed; `values` are dicts, the rest is null."""
    schema = FEED_SCHEMAS[feed]
    rows = [tuple({"id": f"r{i}", "vehicle_id": "V1", "timestamp": T0, **v}.get(f.name) for f in schema) for i, v in enumerate(values)]
    return refine(spark.createDataFrame(rows, schema))


@pytest.fixture
def frames(spark):
    v = _rows(spark, VEHICLE, [{"speed": 10.004, "make": "Kia"}, {"speed": 10.004, "make": "Kia"}], refine_vehicle)
    w = _rows(spark, WEATHER, [{"temperature": t, "humidity": 50, "weatherCondition": "Sunny", "airQualityIndex": 10.0} for t in (25.05, 25.05, 25.14)], refine_weather)
    e = _rows(spark, EMERGENCY, [{"type": "Fire", "status": "Active"}], refine_emergency)
    return v, w, e


def test_means_of_values_with_three_decimals(frames):
    v, w, e = frames
    assert D.mean_speed_by_hour(v).first().speed == 10.004
    assert D.speed_mean_max_by_make(v).first().avg_speed == 10.004
    assert {r.mean_speed for r in D.speed_timeline(v).collect()} == {10.004}
    assert V.speed_by_make(v).first().avg_speed == 10.0
    assert V.speed_by_weather(v, w).first().avg_temp_c == 25.1
    assert V.daily_kpi(v, w, e).first().avg_temp_c == 25.1
    assert V.daily_kpi_exact(v, w, e).first().avg_temp_c == 25.1
    assert D.kpi_row(v, w, e).first().avg_temp == 25.1


def test_a_tie_shows_the_third_decimal(spark):
    v = _rows(spark, VEHICLE, [{"speed": 10.049, "make": "Kia"}, {"speed": 10.0510001, "make": "Kia"}], refine_vehicle)
    assert V.speed_by_make(v).first().avg_speed == 10.1  # 10.05000005; two decimals would give 10.05 too, one 10.0
    assert D.mean_speed_by_hour(v).first().speed == pytest.approx(10.05000005, abs=1e-12)


def _many(spark, feed, n, keys=1, **values):
    schema = FEED_SCHEMAS[feed]
    base = spark.range(n * keys)
    cols = {"id": F.concat(F.lit("r"), F.col("id").cast("string")), "vehicle_id": F.concat(F.lit("V"), (F.col("id") % keys).cast("string")),
            "timestamp": F.lit(T0).cast("timestamp"), **{k: F.lit(x) for k, x in values.items()}}
    return base.select(*[cols.get(f.name, F.lit(None)).cast(f.dataType).alias(f.name) for f in schema])


def test_one_busy_vehicle_day(spark):
    n = 300_000
    v = refine_vehicle(_many(spark, VEHICLE, n, speed=100.0, fuelType="Electric"))
    w = refine_weather(_many(spark, WEATHER, n, temperature=30.0, humidity=50, weatherCondition="Sunny", airQualityIndex=10.0))
    e = refine_emergency(_many(spark, EMERGENCY, n, type="Fire", status="Active"))
    r = V.daily_kpi(v, w, e).first()
    assert (r.total_records, r.avg_speed_kmh, r.avg_temp_c, r.unique_vehicles) == (n**3, 100.0, 30.0, 1)
    assert r.ev_trips == r.total_incidents == r.real_incidents == n**3
    r = V.speed_by_weather(v, w).first()
    assert (r.vehicle_obs, r.avg_speed_kmh, r.avg_temp_c, r.avg_humidity_pct) == (n**2, 100.0, 30.0, 50.0)


def test_many_vehicle_days(spark):
    """The sums over all vehicles of a date pass 2^63 although no single vehicle-day does."""
    n, keys = 12_000, 50
    v = refine_vehicle(_many(spark, VEHICLE, n, keys, speed=199.9))
    w = refine_weather(_many(spark, WEATHER, n, keys, temperature=-10.0, humidity=50, weatherCondition="Sunny"))
    e = refine_emergency(_many(spark, EMERGENCY, n, keys, type="Fire", status="Active"))
    r = V.daily_kpi(v, w, e).first()
    assert (r.total_records, r.avg_speed_kmh, r.avg_temp_c, r.unique_vehicles) == (keys * n**3, 199.9, -10.0, keys)


def test_sketch_keeps_null_hours(spark):
    v = _rows(spark, VEHICLE, [{"speed": 10.0}, {"speed": 20.0}, {"speed": 30.0, "timestamp": None}], refine_vehicle)
    assert sorted(map(str, V.speed_by_hour(v, method="sketch").collect())) == sorted(map(str, V.speed_by_hour(v).collect()))
    assert V.speed_by_hour(v, method="sketch").filter("hour IS NULL").count() == 1

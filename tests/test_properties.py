"""Property tests: random small inputs, the engine's operators against brute force."""

import datetime as dt

import pandas as pd
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from roadpulse.functions.stats import exact_mean
from roadpulse.operators import vehicle as V
from roadpulse.operators.temporal import asof_weather, trips

SETTINGS = settings(max_examples=8, deadline=None, suppress_health_check=list(HealthCheck))
KEY = st.sampled_from(["A", "B", None])
DAY = st.sampled_from(["2024-01-01", "2024-01-02", None])


@SETTINGS
@given(vrows=st.lists(st.tuples(KEY, DAY, st.integers(0, 2000), st.sampled_from([True, False, None])),
                      min_size=1, max_size=25),
       wrows=st.lists(st.tuples(KEY, DAY, st.integers(-100, 600), st.integers(0, 100)), max_size=15),
       erows=st.lists(st.tuples(KEY, DAY, st.sampled_from([True, False, None])), max_size=15))
def test_daily_kpi_factorised_equals_pairwise(spark, vrows, wrows, erows):
    v = spark.createDataFrame([(f"v{i}", k, d, s / 10, ev) for i, (k, d, s, ev) in enumerate(vrows)],
                              "id string, vehicle_id string, date string, speed_kmh double, is_ev boolean")
    w = spark.createDataFrame([(f"w{i}", k, d, t / 10, h) for i, (k, d, t, h) in enumerate(wrows)],
                              "id string, vehicle_id string, date string, temperature double, humidity int")
    e = spark.createDataFrame([(f"e{i}", k, d, r) for i, (k, d, r) in enumerate(erows)],
                              "id string, vehicle_id string, date string, is_real_incident boolean")
    on_w = (F.col("v.vehicle_id") == F.col("w.vehicle_id")) & (F.col("v.date") == F.col("w.date"))
    on_e = (F.col("v.vehicle_id") == F.col("e.vehicle_id")) & (F.col("v.date") == F.col("e.date"))
    pairs = v.alias("v").join(w.alias("w"), on_w, "left").join(e.alias("e"), on_e, "left")
    brute = (pairs.groupBy(F.col("v.date").alias("date"))
             .agg(F.count_distinct("v.vehicle_id"), F.count("v.id"), F.round(exact_mean("v.speed_kmh", 1), 1),
                  F.sum(F.col("v.is_ev").cast("int")).cast("bigint"), F.round(exact_mean("w.temperature", 1), 1),
                  F.count("e.id"), F.sum(F.col("e.is_real_incident").cast("int")).cast("bigint")))
    key = lambda t: tuple((x is None, str(x)) for x in t)
    assert sorted(map(tuple, V.daily_kpi(v, w, e).collect()), key=key) == sorted(map(tuple, brute.collect()), key=key)


@SETTINGS
@given(gaps=st.lists(st.lists(st.integers(0, 9000), min_size=1, max_size=30), min_size=1, max_size=3),
       gap_s=st.sampled_from([600, 1800, 3600]), bucket_s=st.sampled_from([None, 60, 300, 600]))
def test_trips_equal_sequential_split(spark, gaps, gap_s, bucket_s):
    rows, t0 = [], dt.datetime(2024, 1, 1)
    for vi, steps in enumerate(gaps):
        t = t0
        for i, g in enumerate(steps):
            t += dt.timedelta(seconds=g)
            rows.append((f"{vi}-{i}", f"veh{vi}", t, 50.0))
    v = spark.createDataFrame(rows, "id string, vehicle_id string, timestamp timestamp, speed_kmh double")
    got = sorted((r.vehicle_id, r.trip_start, r.points) for r in trips(v, gap_s, bucket_s).collect())
    pdf = pd.DataFrame(rows, columns=["id", "vehicle_id", "timestamp", "s"]).sort_values(["vehicle_id", "timestamp"])
    d = pdf.groupby("vehicle_id")["timestamp"].diff()
    pdf["trip"] = (d.isna() | (d >= pd.Timedelta(seconds=gap_s))).groupby(pdf["vehicle_id"]).cumsum()
    exp = pdf.groupby(["vehicle_id", "trip"]).agg(start=("timestamp", "min"), n=("id", "count")).reset_index()
    assert got == sorted(zip(exp.vehicle_id, [x.to_pydatetime() for x in exp.start], exp.n))


@SETTINGS
@given(vt=st.lists(st.integers(0, 3 * 3600 * 10**6), min_size=1, max_size=25),
       wt=st.lists(st.integers(0, 3 * 3600 * 10**6), max_size=25, unique=True),
       near=st.lists(st.integers(0, 2_000_000), max_size=10), share=st.booleans())
def test_asof_equals_merge_asof(spark, vt, wt, near, share):
    """Microsecond instants over three hours: readings cross second and hour edges, some
    share an instant, some weather sits exactly at a reading's instant."""
    t0 = dt.datetime(2024, 1, 1)
    vt = vt + [vt[0] + d for d in near] + ([vt[0]] * 3 if share else [])
    wt = sorted(set(wt + ([vt[-1]] if share else [])))
    vrows = [(f"v{i}", "veh", t0 + dt.timedelta(microseconds=u), 1.0) for i, u in enumerate(vt)]
    wrows = [(f"w{i:03d}", "veh", t0 + dt.timedelta(microseconds=u), float(i), "Sunny") for i, u in enumerate(wt)]
    v = spark.createDataFrame(vrows, "id string, vehicle_id string, timestamp timestamp, speed_kmh double")
    w = spark.createDataFrame(wrows, "id string, vehicle_id string, timestamp timestamp, temperature double, "
                                     "weatherCondition string")
    got = {r.id: r.weather_id for r in asof_weather(v, w).collect()}
    left = pd.DataFrame(vrows, columns=["id", "vehicle_id", "timestamp", "s"]).sort_values("timestamp")
    right = pd.DataFrame(wrows, columns=["weather_id", "vehicle_id", "wt", "temp", "c"]).sort_values("wt")
    if len(right):
        exp = pd.merge_asof(left, right, left_on="timestamp", right_on="wt", by="vehicle_id")
        expected = {r.id: (None if pd.isna(r.weather_id) else r.weather_id) for r in exp.itertuples()}
    else:
        expected = {r.id: None for r in left.itertuples()}
    assert got == expected


@SETTINGS
@given(values=st.lists(st.tuples(st.integers(0, 3), st.integers(0, 2000)), min_size=1, max_size=60),
       ps=st.lists(st.sampled_from([0.0, 0.01, 0.25, 0.5, 0.9, 0.95, 0.99, 1.0]), min_size=1, max_size=3,
                   unique=True))
def test_histogram_percentiles_equal_discrete_rank(spark, values, ps):
    import math
    import statistics

    from roadpulse.operators.quantiles import histogram_summary
    df = spark.createDataFrame([(g, x / 10) for g, x in values], "g int, x double")
    names = [f"p{i}" for i in range(len(ps))]
    got = {r.g: r for r in histogram_summary(df, ["g"], "x", ps, names, scale=1).collect()}
    for g in {g for g, _ in values}:
        xs = sorted(x / 10 for gg, x in values if gg == g)
        n = len(xs)
        r = got[g]
        assert r.rows == n
        assert abs(r.mean - statistics.fmean(xs)) < 1e-9
        for p, name in zip(ps, names):
            assert r[name] == xs[max(math.ceil(p * n), 1) - 1]


@SETTINGS
@given(values=st.lists(st.integers(-1000, 2000), min_size=0, max_size=40))
def test_exact_mean_and_stddev(spark, values):
    import statistics

    from roadpulse.functions.stats import exact_mean, exact_stddev
    df = spark.createDataFrame([(x / 10,) for x in values], "x double").repartition(3)
    r = df.agg(exact_mean("x", 1).alias("m"), exact_stddev("x", 1).alias("s")).first()
    xs = [x / 10 for x in values]
    if not xs:
        assert r.m is None and r.s is None
        return
    assert r.m == sum(values) / (len(values) * 10)
    if len(xs) < 2:
        assert r.s is None
    else:
        assert abs(r.s - statistics.stdev(xs)) < 1e-9 * max(1.0, statistics.stdev(xs))

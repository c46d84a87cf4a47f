"""Tables laid out for their queries: buckets by join keys, sketches by group; and today's incidents."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from roadpulse.operators import emergency as E
from roadpulse.operators import vehicle as V
from roadpulse.operators.quantiles import histogram_summary, merged_percentiles, sketch_table
from roadpulse.operators.refine import refine_emergency, refine_vehicle, refine_weather
from roadpulse.schemas import EMERGENCY, VEHICLE, WEATHER
from roadpulse.sources import catalog as C
from roadpulse.sources.feeds import derive_feed
from tests.conftest import SF_SMALL


@pytest.fixture(scope="module")
def feeds(spark):
    events = spark.read.parquet(f"{SF_SMALL}/events.parquet")
    return {f: r(derive_feed(events, f)) for f, r in ((VEHICLE, refine_vehicle), (WEATHER, refine_weather), (EMERGENCY, refine_emergency))}


@pytest.mark.parametrize("fn", ["speed_by_weather", "daily_kpi"])
def test_bucketed_tables_join_without_an_exchange_of_rows(spark, feeds, tmp_base, fn):
    db = f"bucketed_{fn}_" + tmp_base.rsplit("-", 1)[-1]
    C.ensure_database(spark, db, f"{tmp_base}/_db")
    own = (VEHICLE, WEATHER) if fn == "speed_by_weather" else (VEHICLE, WEATHER, EMERGENCY)
    tables = [spark.table(C.write_bucketed(feeds[f], db, f, tmp_base, buckets=4)) for f in own]
    threshold = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        out = getattr(V, fn)(*tables)
        plan = out._jdf.queryExecution().executedPlan().toString()
        got = out.collect()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
    assert got == getattr(V, fn)(*[feeds[f] for f in own]).collect() and got
    below = plan[plan.index("SortMergeJoin"):]
    assert "Exchange" not in below and "Bucketed: true" in below
    assert plan.count("Exchange") == 2  # the final groups and their order


@pytest.mark.parametrize("k", [64, 200])
def test_merged_sketches_against_the_exact_histogram(spark, k):
    rows = spark.range(120_000).select((F.col("id") % 4).cast("int").alias("day"), (F.col("id") % 3).cast("int").alias("hour"),
                                       F.when(F.col("id") % 11 != 0, F.round(F.pow(F.rand(7), 3) * 200, 1)).alias("speed_kmh"))
    rows = rows.unionByName(spark.createDataFrame([(0, 9, None), (1, 9, None)], "day int, hour int, speed_kmh double")).cache()
    sketches = sketch_table(rows, ["day", "hour"], "speed_kmh", k=k).cache()
    assert sketches.filter("hour <> 9").agg(F.max(F.length("sketch"))).first()[0] < 40 * k  # groups of 10,000 rows
    names, shares = ["p05", "p50", "p95"], [0.05, 0.5, 0.95]
    for days in ([0, 1, 2, 3], [1, 2], [3]):
        part = rows.filter(F.col("day").isin(days))
        got = {r.hour: r for r in merged_percentiles(sketches.filter(F.col("day").isin(days)), ["hour"], shares, names, k=k).collect()}
        exact = {r.hour: r for r in histogram_summary(part, ["hour"], "speed_kmh", shares, names, scale=1).collect()}
        assert got.keys() == exact.keys() and {h: r.rows for h, r in got.items()} == {h: r["rows"] for h, r in exact.items()}
        if 9 in got:
            assert [got[9][n] for n in names] == [None] * 3
        for hour in (0, 1, 2):
            values = sorted(r[0] for r in part.filter((F.col("hour") == hour) & F.col("speed_kmh").isNotNull()).select("speed_kmh").collect())
            for p, n in zip(shares, names, strict=True):
                low = sum(x < got[hour][n] for x in values) / len(values)
                high = sum(x <= got[hour][n] for x in values) / len(values)
                assert low - 6 / k <= p <= high + 6 / k, (hour, n)


def test_todays_incidents_by_default(spark, feeds):
    today = dt.date.today()
    rows = feeds[EMERGENCY].filter("is_real_incident AND is_active").limit(3).withColumn("date", F.lit(today.isoformat()))
    mixed = rows.unionByName(feeds[EMERGENCY])
    assert E.active_incidents(mixed).count() == E.active_incidents(mixed, as_of=today.isoformat()).count() == 3

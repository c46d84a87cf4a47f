"""Refined write, catalog tables, partition repair and pruning, overwrite modes, plan shapes."""

import datetime as dt

from pyspark.sql import functions as F

from roadpulse.operators import dashboard as D
from roadpulse.operators.refine import refine_gps, refine_traffic, refine_vehicle
from roadpulse.schemas import EMERGENCY, FEEDS, GPS, TRAFFIC, VEHICLE
from roadpulse.sources import catalog as C
from roadpulse.sources import storage as S
from roadpulse.sources.feeds import derive_feed
from roadpulse.schemas import FEED_SCHEMAS
from tests.conftest import SF_SMALL


def _events(spark):
    return spark.read.parquet(f"{SF_SMALL}/events.parquet")


def test_write_register_repair_prune(spark, tmp_base):
    from roadpulse.operators.refine import refine_emergency
    e = refine_emergency(derive_feed(_events(spark), EMERGENCY))
    db = "t_" + tmp_base.rsplit("-", 1)[-1]
    C.ensure_database(spark, db, f"{tmp_base}/_db")
    C.register_tables(spark, db, tmp_base, (EMERGENCY,), strict=True)
    rows = S.write_refined(e, EMERGENCY, tmp_base)
    assert rows == 1000
    assert C.scan(spark, db, EMERGENCY).count() == 0  # partitions not yet known
    C.repair_partitions(spark, db, EMERGENCY)
    assert C.scan(spark, db, EMERGENCY).count() == 1000
    pruned = C.scan(spark, db, EMERGENCY, dates=["2024-01-05"])
    plan = pruned._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(date" in plan and "2024-01-05" in plan
    assert pruned.count() == e.filter(F.col("date") == "2024-01-05").count()
    assert dict(pruned.dtypes)["date"] == "string"


def test_null_timestamp_goes_to_default_partition(spark, tmp_base):
    rows = [("c1", "V", "cam", "[1,2]", None, "snap"), ("c2", "V", "cam", "[1,2]", dt.datetime(2024, 1, 2), "s")]
    t = refine_traffic(spark.createDataFrame(rows, FEED_SCHEMAS[TRAFFIC]))
    S.write_refined(t, TRAFFIC, tmp_base)
    back = {r.id: r.date for r in S.read_refined(spark, TRAFFIC, tmp_base).collect()}
    assert back == {"c1": None, "c2": "2024-01-02"}


def test_static_vs_dynamic_overwrite(spark, tmp_base):
    v = refine_vehicle(derive_feed(_events(spark), VEHICLE))
    S.write_refined(v, VEHICLE, tmp_base)
    total = v.count()
    one_day = v.filter(F.col("date") == "2024-01-03")
    S.write_refined(one_day, VEHICLE, tmp_base, dynamic=True)
    assert S.read_refined(spark, VEHICLE, tmp_base).count() == total
    S.write_refined(one_day, VEHICLE, tmp_base, dynamic=False)
    assert S.read_refined(spark, VEHICLE, tmp_base).count() == one_day.count()


def test_refine_all_isolates_failures(spark, tmp_base):
    ev = _events(spark)
    for feed in FEEDS:
        if feed != TRAFFIC:
            S.write_raw_batch(derive_feed(ev, feed), feed, tmp_base)
    status = {r.feed: (r.status, r.rows) for r in S.refine_all(spark, tmp_base, tmp_base).collect()}
    assert status[TRAFFIC][0].startswith("FAIL")
    assert status[EMERGENCY] == ("OK", 1000)


def test_plan_shapes(spark):
    v = refine_vehicle(derive_feed(_events(spark), VEHICLE))
    top = D.latest(v, D.VEHICLE_COLUMNS)._jdf.queryExecution().executedPlan().toString()
    assert "TakeOrderedAndProject" in top
    q = refine_gps(derive_feed(_events(spark), GPS), filter_first=True)
    scan = q._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [IsNotNull(value), GreaterThanOrEqual(value,0.0)" in scan
    for df in (D.speed_timeline(v), D.value_counts(v, "fuelType", share=True)):
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert "CartesianProduct" not in plan and "NestedLoopJoin" not in plan

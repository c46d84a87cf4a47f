"""A delta never costs a row, and the catalog works table by table from metadata."""

import datetime as dt
import json
import os

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from roadpulse.operators import emergency as E
from roadpulse.operators import dashboard as D
from roadpulse.operators.refine import dedup_latest, refine_emergency, refine_vehicle
from roadpulse.schemas import EMERGENCY, FEED_SCHEMAS, FEEDS, GPS, VEHICLE
from roadpulse.sources import catalog as C
from roadpulse.sources import published
from roadpulse.sources import storage as S
from roadpulse.sources.feeds import derive_feed
from tests.conftest import SF_SMALL


def _vehicle(spark, rows):
    schema = FEED_SCHEMAS[VEHICLE]
    return spark.createDataFrame([tuple({"id": i, "vehicle_id": "V1", "timestamp": t, "speed": s}.get(f.name) for f in schema) for i, t, s in rows], schema)


def _table(spark, base):
    return sorted((r.id, r.date, r.speed) for r in S.read_refined(spark, VEHICLE, base).collect())


def test_a_delta_of_new_late_and_corrected_rows(spark, tmp_base):
    day = lambda d, h=1: dt.datetime(2024, 1, d, h)
    first = [(f"a{k}", day(1), 10.0 + k) for k in range(5)] + [("b", day(2), 50.0), ("c", day(3), 60.0)]
    S.write_raw_batch(_vehicle(spark, first), VEHICLE, tmp_base)
    S.write_refined(refine_vehicle(S.read_raw(spark, VEHICLE, tmp_base)), VEHICLE, tmp_base)
    delta = [("late", day(1, 23), 7.0), ("a1", day(1), 99.0), ("c", day(2, 5), 61.0), ("new", day(4), 5.0)]  # c moves to another day
    rows = S.incremental_refine(_vehicle(spark, delta), VEHICLE, tmp_base)
    want = sorted([("a0", "2024-01-01", 10.0), ("a1", "2024-01-01", 99.0), ("a2", "2024-01-01", 12.0), ("a3", "2024-01-01", 13.0),
                   ("a4", "2024-01-01", 14.0), ("late", "2024-01-01", 7.0), ("b", "2024-01-02", 50.0), ("c", "2024-01-02", 61.0),
                   ("new", "2024-01-04", 5.0)])
    assert _table(spark, tmp_base) == want and rows == len(want)
    # the raw layer may hold the delta by then: the same again changes nothing
    S.write_raw_batch(_vehicle(spark, delta), VEHICLE, tmp_base)
    S.incremental_refine(_vehicle(spark, delta), VEHICLE, tmp_base)
    assert _table(spark, tmp_base) == want


def test_a_row_without_time(spark, tmp_base):
    S.write_raw_batch(_vehicle(spark, [("a", None, 1.0), ("b", dt.datetime(2024, 1, 1), 2.0)]), VEHICLE, tmp_base)
    S.write_refined(refine_vehicle(S.read_raw(spark, VEHICLE, tmp_base)), VEHICLE, tmp_base)
    S.incremental_refine(_vehicle(spark, [("n", None, 3.0)]), VEHICLE, tmp_base)
    assert sorted(r.id for r in S.read_refined(spark, VEHICLE, tmp_base).collect()) == ["a", "b", "n"]


def _day(d, h=1):
    return dt.datetime(2024, 1, d, h)


def _load(spark, base, rows):
    S.write_refined(refine_vehicle(dedup_latest(_vehicle(spark, rows)), dedup_rows=False), VEHICLE, base)


def _model(batches):
    """{id: (time, speed)} of the rows a refine from scratch gives, later batches winning."""
    held = {}
    for batch in batches:
        latest = {}
        for i, t, v in batch:
            key = (t is not None, t or dt.datetime.min, v is not None, v or 0.0)
            if i not in latest or key > latest[i][0]:
                latest[i] = (key, (t, v))
        held |= {i: row for i, (_, row) in latest.items()}
    return sorted(((i or "", t.strftime("%Y-%m-%d") if t else "", v) for i, (t, v) in held.items() if v is not None and 0 <= v <= 200))


def _held(spark, base):
    return sorted((r.id or "", r.date or "", r.speed) for r in S.read_refined(spark, VEHICLE, base).collect())


def _check(spark, base, *batches):
    _load(spark, base, batches[0])
    for k, batch in enumerate(batches[1:], 2):
        rows = S.incremental_refine(_vehicle(spark, batch), VEHICLE, base, id_buckets=4)
        assert _held(spark, base) == _model(batches[:k])
        assert int(rows) == sum(d in {x.replace(published.NO_DATE, "") for x in rows.dates} for _, d, _ in _held(spark, base))


def test_an_id_with_copies_on_several_dates(spark, tmp_base):
    _check(spark, tmp_base, [("A", _day(1), 1.0), ("A", _day(2), 2.0)], [("B", _day(1), 3.0)], [("A", _day(1), 4.0)], [("C", _day(2), 5.0)])


def test_null_ids_are_one_id(spark, tmp_base):
    _check(spark, tmp_base, [(None, _day(1), 1.0), ("x", _day(1), 1.0)], [(None, _day(2), 2.0)], [("y", _day(1), 3.0)])


def test_a_row_that_gets_its_time_leaves_the_others_without(spark, tmp_base):
    _check(spark, tmp_base, [("X", None, 1.0), ("Y", None, 2.0)], [("X", _day(3), 1.0)], [("Y", _day(3), 2.0)], [("Z", None, 3.0)])


def test_a_copy_that_fails_the_rules_takes_the_row_away(spark, tmp_base):
    _check(spark, tmp_base, [("A", _day(1), 1.0), ("B", _day(2), 2.0)], [("A", _day(1), 999.0)], [("A", _day(1), 7.0)], [("B", _day(2), None), ("A", _day(1), -1.0)])


_ROW = st.tuples(st.sampled_from(["a", "b", "c", "d", None]), st.sampled_from([None, _day(1), _day(1, 5), _day(2), _day(3)]),
                 st.sampled_from([0.0, 5.0, 50.0, 300.0, None]))


@settings(max_examples=4, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture], derandomize=True)
@given(first=st.lists(_ROW, min_size=2, max_size=6), deltas=st.lists(st.lists(_ROW, min_size=1, max_size=4), min_size=2, max_size=3))
def test_random_deltas_equal_a_refine_from_scratch(spark, first, deltas):
    from roadpulse.session import scratch_dir

    _check(spark, scratch_dir(spark, "random"), first, *deltas)


def test_an_interrupted_run_leaves_the_table_as_it_was(spark, tmp_base, monkeypatch):
    first, delta = [("A", _day(1), 1.0), ("B", _day(2), 2.0)], [("A", _day(2), 9.0), ("C", _day(1), 3.0)]
    _load(spark, tmp_base, first)

    def ended(*args, **options):
        raise KeyboardInterrupt

    with monkeypatch.context() as m:  # all folders are written, the switch is not
        m.setattr(published, "publish", ended)
        with pytest.raises(KeyboardInterrupt):
            S.incremental_refine(_vehicle(spark, delta), VEHICLE, tmp_base)
    assert _held(spark, tmp_base) == _model([first])
    root = S.refined_path(tmp_base, VEHICLE).removeprefix("file:")
    os.makedirs(f"{root}/_manifest", exist_ok=True)
    with open(f"{root}/_manifest/0000000001.json", "w") as f:  # ended within the switch
        f.write(json.dumps({"dates": {"2024-01-01": "gone"}})[:-5])
    assert _held(spark, tmp_base) == _model([first])
    S.incremental_refine(_vehicle(spark, delta), VEHICLE, tmp_base)
    assert _held(spark, tmp_base) == _model([first, delta])


def test_two_writers_cannot_both_publish(spark, tmp_base, monkeypatch):
    _load(spark, tmp_base, [("A", _day(1), 1.0)])
    real = published.publish

    def late(spark, root, before, label, **options):  # another writer is quicker
        monkeypatch.setattr(published, "publish", real)
        S.incremental_refine(_vehicle(spark, [("B", _day(1), 2.0)]), VEHICLE, tmp_base)
        real(spark, root, before, label, **options)

    monkeypatch.setattr(published, "publish", late)
    with pytest.raises(RuntimeError, match="another writer"):
        S.incremental_refine(_vehicle(spark, [("C", _day(1), 3.0)]), VEHICLE, tmp_base)
    assert [r[0] for r in _held(spark, tmp_base)] == ["A", "B"]


def test_whole_and_dynamic_writes_after_a_delta(spark, tmp_base):
    _load(spark, tmp_base, [("A", _day(1), 1.0), ("B", _day(2), 2.0)])
    S.incremental_refine(_vehicle(spark, [("C", _day(2), 3.0)]), VEHICLE, tmp_base)
    day2 = refine_vehicle(_vehicle(spark, [("D", _day(2), 4.0)]))
    with pytest.raises(ValueError):
        S.write_refined(day2, VEHICLE, tmp_base, mode="append")
    assert S.write_refined(day2, VEHICLE, tmp_base, dynamic=True).dates == ("2024-01-02",)
    assert [r[0] for r in _held(spark, tmp_base)] == ["A", "D"]
    S.incremental_refine(_vehicle(spark, [("D", _day(1), 5.0)]), VEHICLE, tmp_base)  # the id index is built anew
    assert [r[:2] for r in _held(spark, tmp_base)] == [("A", "2024-01-01"), ("D", "2024-01-01")]
    _load(spark, tmp_base, [("E", _day(1), 1.0)])
    assert [r[0] for r in _held(spark, tmp_base)] == ["E"]


def test_only_touched_dates_are_read_and_registered(spark, tmp_base):
    _load(spark, tmp_base, [(f"v{d}{k}", _day(d, k + 1), float(k)) for d in range(1, 6) for k in range(4)] + [("n", None, 1.0)])
    db = "dates_" + tmp_base.rsplit("-", 1)[-1]
    C.ensure_database(spark, db, f"{tmp_base}/_db")
    C.register_tables(spark, db, tmp_base, (VEHICLE,), strict=True)
    C.repair_partitions(spark, db, VEHICLE)
    said = []
    run = spark.sql
    rows = S.incremental_refine(_vehicle(spark, [("v10", _day(9), 7.0), ("new", _day(2), 8.0), ("n", _day(2), 1.0)]), VEHICLE, tmp_base)
    assert rows.dates == ("2024-01-01", "2024-01-02", "2024-01-09", published.NO_DATE)
    spark.sql = lambda text, *a, **k: (said.append(text), run(text, *a, **k))[1]
    try:
        C.register_dates(spark, db, VEHICLE, tmp_base, rows.dates)
    finally:
        del spark.sql
    assert not any("MSCK" in x for x in said) and not any("2024-01-03" in x for x in said) and sum("ADD IF NOT" in x for x in said) == 1
    table = C.scan(spark, db, VEHICLE)
    assert sorted((r.id or "", r.date or "") for r in table.collect()) == [r[:2] for r in _held(spark, tmp_base)]
    plan = S.read_refined(spark, VEHICLE, tmp_base).filter("date = '2024-01-03'")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(date" in plan
    again = C.register_and_repair(spark, db, tmp_base, (VEHICLE,)).collect()
    assert again[0].status == "created" and C.scan(spark, db, VEHICLE).count() == table.count()


@pytest.mark.parametrize("n", [1, 3, 4, 9, 21, 22, 23, 99])
def test_newest_rows_from_partitions(spark, tmp_base, n):
    rows = [(f"v{d}{k}", _day(d, k // 2 + 1), float(k)) for d in range(1, 6) for k in range(4)] + [("n1", None, 1.0), ("n2", None, 1.0)]
    _load(spark, tmp_base, rows)
    db = "newest_" + tmp_base.rsplit("-", 1)[-1]
    C.ensure_database(spark, db, f"{tmp_base}/_db")
    C.register_tables(spark, db, tmp_base, (VEHICLE,), strict=True)
    C.register_dates(spark, db, VEHICLE, tmp_base, [f"2024-01-0{d}" for d in range(1, 6)] + [published.NO_DATE])
    out = C.newest_rows(spark, db, VEHICLE, n)
    assert out.collect() == D.latest(C.scan(spark, db, VEHICLE), out.columns, n).collect()
    if n <= 4:  # the newest date holds as many: one directory is read
        read = {r[0].split("date=")[1][:10] for r in C.scan(spark, db, VEHICLE).filter("date = '2024-01-05'").select(F.input_file_name()).collect()}
        plan = out._jdf.queryExecution().executedPlan().toString()
        assert read == {"2024-01-05"} and "2024-01-05" in plan and "2024-01-04" not in plan


def test_one_bad_table_does_not_stop_the_others(spark, tmp_base):
    events = spark.read.parquet(f"{SF_SMALL}/events.parquet")
    for feed in (EMERGENCY, VEHICLE):
        S.write_refined({EMERGENCY: refine_emergency, VEHICLE: refine_vehicle}[feed](derive_feed(events, feed)), feed, tmp_base)
    db = "bad_" + tmp_base.rsplit("-", 1)[-1]
    C.ensure_database(spark, db, f"{tmp_base}/_db")
    spark.sql(f"CREATE VIEW `{db}`.`{GPS}` AS SELECT 1 AS x")  # in the way of the table: it cannot be repaired
    status = {r.table: r.status for r in C.register_and_repair(spark, db, tmp_base).collect()}
    assert status.keys() == set(FEEDS) and status[GPS].startswith("FAIL")
    assert C.scan(spark, db, EMERGENCY).count() == 1000 and C.scan(spark, db, VEHICLE).count() > 0


def test_newest_date_without_a_scan(spark, tmp_base):
    events = spark.read.parquet(f"{SF_SMALL}/events.parquet")
    e = refine_emergency(derive_feed(events, EMERGENCY))
    S.write_refined(e, EMERGENCY, tmp_base)
    db = "new_" + tmp_base.rsplit("-", 1)[-1]
    C.ensure_database(spark, db, f"{tmp_base}/_db")
    C.register_tables(spark, db, tmp_base, (EMERGENCY,), strict=True)
    assert C.newest_partition(spark, db, EMERGENCY) is None
    C.repair_partitions(spark, db, EMERGENCY)
    shown = spark.sql(f"SHOW PARTITIONS `{db}`.`{EMERGENCY}`")._jdf.queryExecution().executedPlan().toString()
    assert "Scan" not in shown.replace("LocalTableScan", "")
    newest = C.newest_partition(spark, db, EMERGENCY)
    assert newest == e.agg(F.max("date")).first()[0]
    out = E.active_incidents(C.scan(spark, db, EMERGENCY), as_of=newest)
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert f"(date#" in plan and f"= {newest})" in plan and plan.count("Scan parquet") == 1
    assert out.select(F.input_file_name()).distinct().count() <= 1 or all(
        f"date={newest}" in r[0] for r in C.scan(spark, db, EMERGENCY, [newest]).select(F.input_file_name()).distinct().collect())

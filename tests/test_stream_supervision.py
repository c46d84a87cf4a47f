"""Streams that are watched, stopped, limited and late."""

import json
import os
import subprocess
import sys

import pytest
from pyspark.sql import functions as F

from roadpulse.operators import temporal as X
from roadpulse.operators.refine import refine_vehicle, reject_counts
from roadpulse.plans import streams as ST
from roadpulse.schemas import GPS, VEHICLE, WEATHER
from roadpulse.session import scratch_dir
from roadpulse.sources.feeds import derive_feed
from roadpulse.sources.storage import read_raw
from roadpulse.streaming import ingest as I
from roadpulse.streaming import operators as SO
from roadpulse.streaming.status import StreamStatus
from tests.conftest import SF_SMALL
from tests.test_stream_batches import ROCKS, _landed, _run, _stream

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


def _events(spark):
    return spark.read.parquet(f"{SF_SMALL}/events.parquet")


@pytest.mark.parametrize("provider", [None, ROCKS])
def test_trips_equal_batch_with_bounded_state(spark, provider):
    landing, rows = _landed(spark, VEHICLE)
    ST.publish_marker(spark, landing, VEHICLE)
    if provider:
        spark.conf.set("spark.sql.streaming.stateStore.providerClass", provider)
    spark.conf.set("spark.sql.streaming.sessionWindow.merge.sessions.in.local.partition", str(provider is None).lower())
    try:
        got, batches, held = _run(spark, SO.stream_trips(SO.stream_refine(_stream(spark, landing, VEHICLE), VEHICLE)), "trips-ranges")
    finally:
        spark.conf.unset("spark.sql.streaming.stateStore.providerClass")
        spark.conf.unset("spark.sql.streaming.sessionWindow.merge.sessions.in.local.partition")
    want = X.trips(refine_vehicle(rows)).collect()
    found = ST.before_end(got, "trip_start").select(*X.trips(refine_vehicle(rows)).columns).collect()
    assert batches == 6 and sorted(found, key=str) == sorted(want, key=str)
    assert max(held) < len(want) / 2  # open trips and recent ids, never all trips


def test_a_pause_of_exactly_the_gap_starts_a_new_trip(spark):
    times = ["10:00:00.000000", "11:59:59.999999", "13:59:59.999999", "14:00:00.000000"]
    rows = [(f"k{i}", json.dumps({"id": f"id{i}", "vehicle_id": "V", "speed": 10.0 * i, "timestamp": f"2024-01-01T{t}"})) for i, t in enumerate(times)]
    landing = scratch_dir(spark, "landing")
    for r in rows:
        I.publish(spark.createDataFrame([r], "key string, value string").coalesce(1), landing, VEHICLE)
    ST.publish_marker(spark, landing, VEHICLE)
    got, _, _ = _run(spark, SO.stream_trips(SO.stream_refine(_stream(spark, landing, VEHICLE), VEHICLE)), "trips-edge")
    assert sorted((r.points, r.avg_speed_kmh, r.duration_s) for r in got.filter("vehicle_id = 'V'").collect()) == [(2, 5.0, 7199), (2, 25.0, 0)]


def test_one_failing_feed_leaves_the_others_running(spark):
    rows, base = derive_feed(_events(spark), VEHICLE), scratch_dir(spark, "base")
    landing = ST.land_batches(spark, rows, VEHICLE, ST.by_time(rows, 3), 3)
    w = ST.land_batches(spark, derive_feed(_events(spark), WEATHER), WEATHER, F.lit(0), 1)
    status = StreamStatus(spark, scratch_dir(spark, "status"))
    good = I.write_raw(I.decode_stream(I.read_topic(spark, VEHICLE, landing=landing, max_files_per_trigger=1), VEHICLE), VEHICLE, base,
                       trigger=ST.AVAILABLE_NOW)

    def broken(batch, batch_id):
        raise ValueError("no space left")

    bad = (I.read_topic(spark, WEATHER, landing=w).writeStream.option("checkpointLocation", f"{base}/broken").trigger(**ST.AVAILABLE_NOW)
           .foreachBatch(broken).start())
    status.watch(good, VEHICLE)
    status.watch(bad, WEATHER)
    with pytest.raises(RuntimeError, match="no space left"):
        I.await_all(spark, [bad, good], keep_going=True)
    status.close()
    assert read_raw(spark, VEHICLE, base).count() == 1100
    rows = status.status().collect()
    assert sorted(r.input_rows for r in rows if r.feed == VEHICLE and r.input_rows) and sum(r.input_rows or 0 for r in rows if r.feed == VEHICLE) == 1100
    ends = {(r.feed, r.event) for r in rows if r.event != "batch"}
    assert ends == {(VEHICLE, "ended"), (WEATHER, "failed")}
    assert all("no space left" in r.error for r in rows if r.event == "failed")
    assert max(r.lag_seconds for r in rows if r.feed == VEHICLE and r.lag_seconds) >= 120


def test_the_first_failure_stops_the_others_by_default(spark):
    landing = ST.land_batches(spark, derive_feed(_events(spark), VEHICLE), VEHICLE, F.lit(0), 1)
    base = scratch_dir(spark, "base")

    def broken(batch, batch_id):
        raise ValueError("no space left")

    endless = I.write_raw(I.decode_stream(I.read_topic(spark, VEHICLE, landing=landing), VEHICLE), VEHICLE, base, trigger={"processingTime": "1 second"})
    bad = I.read_topic(spark, VEHICLE, landing=landing).writeStream.option("checkpointLocation", f"{base}/broken").foreachBatch(broken).start()
    with pytest.raises(RuntimeError, match="no space left"):
        I.await_all(spark, [endless, bad])
    endless.awaitTermination(20)
    assert not endless.isActive


def test_rejects_of_each_batch_add_up(spark):
    rows = derive_feed(_events(spark), GPS)
    landing = ST.land_batches(spark, rows, GPS, ST.by_time(rows, 3), 3)
    status = StreamStatus(spark, scratch_dir(spark, "status"), every=1)
    query = I.write_stream(SO.observed_refine(ST.one_file_stream(spark, landing, GPS), GPS), f"{status.path}/data", f"{status.path}/checkpoint",
                           trigger=ST.AVAILABLE_NOW)
    status.watch(query, GPS)
    I.await_all(spark, [query])
    status.close()
    got = status.rejected()
    assert got.filter("checked > 0").select("batch").distinct().count() == 3
    sums = got.groupBy("feed", "rule").agg(F.sum("rejected").alias("rejected"), F.sum("checked").alias("checked"))
    assert sorted(sums.collect()) == sorted(reject_counts(rows, GPS).select("feed", "rule", "rejected", "checked").collect())


def test_late_rows_go_aside(spark):
    base, landing = scratch_dir(spark, "base"), scratch_dir(spark, "landing")
    record = lambda i, t: (f"k{i}", json.dumps({"id": f"id{i}", "vehicle_id": "V", "speed": 1.0} | ({"timestamp": f"2024-01-01T{t}"} if t else {})))
    for batch in ([record(1, "10:00:00"), record(2, None)], [record(3, "09:58:00.000000"), record(4, "09:58:00.000001"), ("bad", "?")], [("worse", "!")],
                  [record(5, "12:00:00"), record(6, "09:00:00")], [record(7, "11:58:00"), record(8, "11:58:01"), record(9, None)]):
        I.publish(spark.createDataFrame(batch, "key string, value string").coalesce(1), landing, VEHICLE)
    topic = I.read_topic(spark, VEHICLE, landing=landing, max_files_per_trigger=1)
    I.await_all(spark, [I.write_split(topic, VEHICLE, base, trigger=ST.AVAILABLE_NOW, late_after="2 minutes")])
    ids = lambda df: sorted(r.id for r in df.collect())
    assert ids(spark.read.parquet(I.late_path(base, VEHICLE))) == ["id3", "id6", "id7"]
    assert ids(read_raw(spark, VEHICLE, base)) == ["id1", "id2", "id4", "id5", "id8", "id9"]
    assert spark.read.parquet(I.dead_letter_path(base, VEHICLE)).count() == 2
    with pytest.raises(ValueError, match="batch by batch"):  # the two ways of ingest never share a folder
        I.write_raw(I.decode_stream(topic, VEHICLE), VEHICLE, base)
    other = scratch_dir(spark, "base")
    I.await_all(spark, [I.write_raw(I.decode_stream(topic, VEHICLE), VEHICLE, other, trigger=ST.AVAILABLE_NOW)])
    with pytest.raises(ValueError, match="file sink"):
        I.write_split(topic, VEHICLE, other)


def test_operators_count_what_they_drop_as_late(spark):
    landing = scratch_dir(spark, "landing")
    for k, hours in enumerate(([10, 11], [15], [16], [10, 17])):
        batch = [(f"k{k}{h}", json.dumps({"id": f"id{k}{h}", "vehicle_id": "V", "speed": 1.0, "timestamp": f"2024-01-01T{h}:00:00"})) for h in hours]
        I.publish(spark.createDataFrame(batch, "key string, value string").coalesce(1), landing, VEHICLE)
    status = StreamStatus(spark, scratch_dir(spark, "status"))
    query = I.write_stream(SO.sliding_speed(SO.stream_refine(_stream(spark, landing, VEHICLE), VEHICLE)), f"{status.path}/d", f"{status.path}/c", trigger=ST.AVAILABLE_NOW)
    status.watch(query, VEHICLE)
    I.await_all(spark, [query])
    status.close()
    assert status.status().agg(F.sum("dropped_late")).first()[0] >= 1


def test_bytes_of_a_batch_stay_below_the_limit(spark):
    rows = derive_feed(_events(spark), VEHICLE)
    landing = ST.land_batches(spark, rows, VEHICLE, ST.by_time(rows, 12), 12)
    folder = I.landing_path(landing, VEHICLE).removeprefix("file:")
    sizes = [os.path.getsize(f"{folder}/{f}") for f in os.listdir(folder) if f.endswith(".parquet")]
    limit = 3 * max(sizes)
    base, moved = scratch_dir(spark, "base"), scratch_dir(spark, "archive")
    read = []

    def note(batch, batch_id):
        files = [r[0].removeprefix("file://") for r in batch.select("file").distinct().collect()]
        read.append(sum(map(os.path.getsize, files)))

    topic = I.read_topic(spark, VEHICLE, landing=landing, max_bytes_per_trigger=limit)
    query = topic.withColumn("file", F.input_file_name()).writeStream.option("checkpointLocation", f"{base}/notes").trigger(**ST.AVAILABLE_NOW).foreachBatch(note).start()
    I.await_all(spark, [query])
    assert len(read) >= 4 and max(read) <= limit and sum(read) == sum(sizes)
    for _ in range(2):  # files move once a later batch has been planned
        topic = I.read_topic(spark, VEHICLE, landing=landing, max_bytes_per_trigger=limit, archive=moved)
        I.await_all(spark, [I.write_raw(I.decode_stream(topic, VEHICLE), VEHICLE, base, trigger=ST.AVAILABLE_NOW)])
    assert read_raw(spark, VEHICLE, base).count() == 1100
    assert len([f for f in os.listdir(folder) if f.endswith(".parquet")]) < 12


def test_a_hot_bucket_split_by_salts_joins_the_same(spark):
    vehicles, v_rows = _landed(spark, VEHICLE)
    weather, w_rows = _landed(spark, WEATHER)
    one = lambda df: df.withColumn("vehicle_id", F.lit("hot"))  # noqa: E731  a single vehicle sends everything
    v, w = (one(SO.stream_refine(_stream(spark, at, feed), feed)) for at, feed in ((vehicles, VEHICLE), (weather, WEATHER)))
    got, _, _ = _run(spark, SO.join_weather(v, w, salts=4), "join-salts")
    from roadpulse.operators.refine import refine_weather
    want = SO.join_weather(one(refine_vehicle(v_rows)), one(refine_weather(w_rows)))
    assert sorted(map(str, got.collect())) == sorted(map(str, want.collect())) and got.count() > 0


KILLED = """
import os, sys
from pyspark.sql import SparkSession
spark = SparkSession.builder.master("local[2]").config("spark.ui.enabled", "false").config("spark.sql.session.timeZone", "UTC").getOrCreate()
from roadpulse.streaming import ingest as I
split = I.split_batch("vehicle_data", sys.argv[2], "2 minutes")
def killed(batch, batch_id):
    split(batch, batch_id)
    if batch_id == 2:
        os._exit(9)
topic = I.read_topic(spark, "vehicle_data", landing=sys.argv[1], max_files_per_trigger=1)
topic.writeStream.option("checkpointLocation", I.checkpoint_path(sys.argv[2], "vehicle_data")).trigger(availableNow=True).foreachBatch(killed).start().awaitTermination()
"""


def test_a_killed_process_loses_and_repeats_nothing(spark):
    rows = derive_feed(_events(spark), VEHICLE)
    landing, base = ST.land_batches(spark, rows, VEHICLE, ST.by_time(rows, 5), 5), scratch_dir(spark, "base")
    done = subprocess.run([sys.executable, "-c", KILLED, landing, base], env=os.environ | {"PYTHONPATH": ROOT}, capture_output=True, text=True, timeout=180)
    assert done.returncode == 9, done.stderr[-800:]
    assert 0 < read_raw(spark, VEHICLE, base).count() < 1100
    topic = I.read_topic(spark, VEHICLE, landing=landing, max_files_per_trigger=1)
    I.await_all(spark, [I.write_split(topic, VEHICLE, base, trigger=ST.AVAILABLE_NOW, late_after="2 minutes")])
    got = read_raw(spark, VEHICLE, base)
    assert got.count() == 1100 and got.exceptAll(rows.select(*got.columns)).isEmpty()

import pytest
from pyspark.sql import functions as F

from roadpulse.plans import registry
from roadpulse.plans import streams as ST
from roadpulse.plans.inputs import raw
from roadpulse.schemas import VEHICLE
from roadpulse.session import scratch_dir
from roadpulse.streaming import ingest as I

SMALL = "/root/testdata/sf0.001"


def _micro_batches(spark, landing, files):
    """Rows of each micro-batch, and the rows of each file that holds any."""
    seen, held = [], []

    def note(batch, batch_id):
        counts = [r["count"] for r in batch.groupBy("file").count().collect()]
        seen.append(sum(counts))
        held.extend(counts)

    topic = I.read_topic(spark, VEHICLE, landing=landing, max_files_per_trigger=files).withColumn("file", F.input_file_name())
    I.await_all(spark, [topic.writeStream.option("checkpointLocation", scratch_dir(spark, "notes")).trigger(**ST.AVAILABLE_NOW).foreachBatch(note).start()])
    return seen, held


def test_a_batch_of_many_files_is_one_micro_batch(spark, monkeypatch):
    monkeypatch.setattr(ST, "FILE_ROWS", 20)
    rows = raw(spark, SMALL, VEHICLE)
    batch = ST.by_time(rows, 3)
    files = ST.files_a_batch(rows, batch)
    want = [r["count"] for r in rows.groupBy(batch.alias("k")).count().orderBy("k").collect()]
    assert files == -(-max(want) // 20) > 1
    seen, held = _micro_batches(spark, ST.land_batches(spark, rows, VEHICLE, batch, 3, files=files), files)
    assert seen == want and max(held) <= 30


def test_a_batch_of_few_rows_still_has_its_files(spark):
    rows = raw(spark, SMALL, VEHICLE)
    few = F.when(F.col("id").isin("veh-1", "veh-2"), 1).otherwise(F.when(F.col("id") == "veh-3", 2).otherwise(0))
    landing = ST.land_batches(spark, rows, VEHICLE, few, 4, files=5)
    assert ST._landed_files(spark, landing, VEHICLE) == 20
    seen, _ = _micro_batches(spark, landing, 5)
    assert seen == [rows.count() - 3, 2, 1, 0]


@pytest.mark.parametrize("name", ["stream_late_rows", "stream_rejects", "stream_recovery", "stream_trips"])
def test_plans_give_the_same_rows_from_many_files(spark, monkeypatch, name):
    one, files = sorted(map(str, registry.PLANS[name](spark, SMALL).collect())), []
    land = ST.land_batches

    def noted(*args, **kw):
        files.append(kw["files"])
        return land(*args, **kw)

    monkeypatch.setattr(ST, "FILE_ROWS", 10)
    monkeypatch.setattr(ST, "land_batches", noted)
    many = sorted(map(str, registry.PLANS[name](spark, SMALL).collect()))
    assert min(files) > 1 and many == one


def test_a_split_batch_is_parsed_once(spark, monkeypatch):
    kept, parse = [], I.parsed
    monkeypatch.setattr(I, "parsed", lambda df, feed: kept.append(parse(df, feed)) or kept[-1])
    wire = spark.createDataFrame([("a", '{"id": "1", "timestamp": "2024-01-01T10:00:00"}'), ("b", "?")], "key string, value string")
    I.split_batch(VEHICLE, scratch_dir(spark, "once"))(wire, 0)
    assert len(kept) == 1 and not kept[0].is_cached
    good, bad = I.parts(kept[0].persist())
    try:
        for df in (good, bad):
            assert "from_json" not in df._jdf.queryExecution().optimizedPlan().toString().split("InMemoryRelation")[0]
        assert [r.id for r in good.collect()] == ["1"] and [tuple(r) for r in bad.collect()] == [("b", "?")]
    finally:
        kept[0].unpersist()

"""Streaming and storage plans: landing folders, stream runs and write/read round trips,
all inside fresh folders below the session's shared checkpoint directory."""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StructField, StructType

from roadpulse.plans.inputs import events
from roadpulse.schemas import EMERGENCY, VEHICLE, WEATHER
from roadpulse.session import run_concurrently, scratch_dir
from roadpulse.sources.feeds import derive_feed
from roadpulse.sources.wire import encode
from roadpulse.streaming.ingest import WIRE_SCHEMA, decode_stream, landing_path, publish, read_topic, write_stream

AVAILABLE_NOW = {"availableNow": True}
# End-of-input marker: one record per feed, far in event time, published after the data so
# the watermark passes every real window and append mode emits them all. It passes the
# feed's rules (so predicate pushdown cannot hide it from the watermark) and its own
# window is never closed; results are cut below END_OF_INPUT anyway.
END_OF_INPUT = "9000-01-01T00:00:00.000000"
_MARKER_FIELDS = {
    VEHICLE: {"speed": 0.0, "fuelType": "Electric", "make": "Ford"},
    WEATHER: {"temperature": 0.0, "humidity": 0, "airQualityIndex": 0.0, "weatherCondition": "Sunny"},
    EMERGENCY: {"type": "Accident", "status": "Active"},
}


def land(spark: SparkSession, sf_dir: str, feeds: tuple[str, ...], *, end_marker: bool = False) -> str:
    """Encode the derived feeds and publish them into a fresh landing folder (one job per
    feed, submitted concurrently); the optional end marker goes in afterwards."""
    landing = scratch_dir(spark, "landing")
    ev = events(spark, sf_dir)
    outcome = run_concurrently({feed: (lambda f=feed: publish(encode(derive_feed(ev, f), f), landing, f))
                                for feed in feeds})
    for result in outcome.values():
        if isinstance(result, Exception):
            raise result
    if end_marker:
        for feed in feeds:
            publish_marker(spark, landing, feed)
    return landing


FILE_ROWS = 100_000  # rows a landed file holds at most


def files_a_batch(rows: DataFrame, batch: Column) -> int:
    """Files that each batch needs so that none holds more than FILE_ROWS rows, or one more where they are
    dealt unevenly: as many tasks encode, decode and write a micro-batch."""
    largest = rows.groupBy(batch.alias("batch")).count().agg(F.max("count")).first()[0]
    return max(1, -(-(largest or 0) // FILE_ROWS))


def land_batches(spark: SparkSession, rows: DataFrame, feed: str, batch: Column, n: int, *, files: int = 1, end_marker: bool = False) -> str:
    """Publishes `rows` in `n` batches of exactly `files` files each, one batch after the other: those of
    `batch` 0, 1, ... With that many files per trigger each is a micro-batch of its own. The rows
    are dealt out before they are encoded, so `files` tasks encode a batch."""
    landing, staged = scratch_dir(spark, "landing"), scratch_dir(spark, "batches")
    rows.withColumn("_batch", batch).write.partitionBy("_batch").parquet(staged)
    numbered = spark.read.schema(StructType([*rows.schema.fields, StructField("_batch", IntegerType())])).parquet(staged)
    landed = 0
    for k in range(n):
        dealt = numbered.filter(F.col("_batch") == k).withColumn("_file", (F.monotonically_increasing_id() % files).cast("int"))
        publish(encode(dealt.repartitionById(files, "_file"), feed), landing, feed)
        landed += files
        for _ in range(landed - _landed_files(spark, landing, feed)):  # a batch of few rows: files without rows
            publish(spark.createDataFrame([], WIRE_SCHEMA).coalesce(1), landing, feed)
    if end_marker:
        publish_marker(spark, landing, feed)
    return landing


def _landed_files(spark: SparkSession, landing: str, feed: str) -> int:
    path = spark._jvm.org.apache.hadoop.fs.Path(f"{landing_path(landing, feed)}/part-*")
    return len(path.getFileSystem(spark._jsc.hadoopConfiguration()).globStatus(path))


def by_time(rows: DataFrame, n: int) -> Column:
    """Which of `n` equal ranges of event time a row lies in."""
    micros = F.unix_micros("timestamp")
    low, high = (F.lit(x).cast("bigint") for x in rows.agg(F.min(micros), F.max(micros)).first())
    return F.floor((micros - low) * n / (high - low + 1)).cast("int")


def publish_marker(spark: SparkSession, landing: str, feed: str) -> None:
    record = {"id": "__end_of_input__", "vehicle_id": "__end_of_input__", "timestamp": END_OF_INPUT, **_MARKER_FIELDS.get(feed, {})}
    marker = spark.createDataFrame([("__end_of_input__", json.dumps(record))], "key string, value string")
    publish(marker.coalesce(1), landing, feed)


def forget_last_commit(spark: SparkSession, checkpoint: str) -> None:
    """The checkpoint as a run leaves it that stops after a batch's files are written and before the batch
    is committed."""
    commits = spark._jvm.org.apache.hadoop.fs.Path(f"{checkpoint}/commits")
    fs = commits.getFileSystem(spark._jsc.hadoopConfiguration())
    last = max((s.getPath() for s in fs.listStatus(commits) if s.getPath().getName().isdigit()), key=lambda p: int(p.getName()))
    fs.delete(last, False)


def decoded_stream(spark: SparkSession, landing: str, feed: str) -> DataFrame:
    return decode_stream(read_topic(spark, feed, fmt="parquet", landing=landing), feed)


def one_file_stream(spark: SparkSession, landing: str, feed: str, files: int = 1) -> DataFrame:
    """Decoded records, one landing file (or a landed batch's `files`) a micro-batch."""
    return decode_stream(read_topic(spark, feed, landing=landing, max_files_per_trigger=files), feed)


# Diagnostics: the stateful operators of each stream run's micro-batches, by run name
# (rows held in state and rows evicted by the watermark), for tools/plan_report.py.
STATE_REPORT: dict[str, list[dict]] = {}


def run_to_parquet(spark: SparkSession, df: DataFrame, name: str, *, partition_by: list[str] | None = None,
                   read_schema=None) -> DataFrame:
    """Run a stream to completion (availableNow) into a fresh Parquet folder; read it back."""
    out = scratch_dir(spark, f"out-{name}")
    q = write_stream(df, f"{out}/data", f"{out}/checkpoint", trigger=AVAILABLE_NOW, partition_by=partition_by)
    q.awaitTermination()
    if q.exception() is not None:
        raise RuntimeError(f"stream {name} failed: {q.exception()}")
    STATE_REPORT[name] = [
        {"batches": len(q.recentProgress),
         "operator": op.get("operatorName"),
         "rows_in_state_at_end": op.get("numRowsTotal"),
         "rows_evicted_total": sum(p["stateOperators"][i].get("numRowsRemoved", 0) for p in q.recentProgress
                                   if len(p.get("stateOperators", [])) > i)}
        for i, op in enumerate((q.lastProgress or {}).get("stateOperators", []))]
    reader = spark.read.schema(read_schema) if read_schema is not None else spark.read
    return reader.parquet(f"{out}/data")


def before_end(df: DataFrame, col: str) -> DataFrame:
    """Rows (windows) starting at least a day before the end marker: no window shorter than
    a day that holds the marker can pass, whether or not it was ever emitted."""
    cut = F.lit(END_OF_INPUT.replace("T", " ")).cast("timestamp") - F.expr("INTERVAL 1 DAY")
    return df.filter(F.col(col) < cut)

"""Streaming ingest: topic -> decode -> watermark -> append Parquet, one query per feed.

A topic is either a Kafka topic (`fmt="kafka"`, needs the Kafka connector on the
classpath) or a landing folder of files carrying the same (key, value) records
(`fmt="parquet"` or `"json"` lines with key/value, or `"text"` with one JSON value per
line). Decoding, watermarking and sinks are identical for all of them.
"""

from __future__ import annotations

from collections.abc import Callable
from contextlib import suppress

from pyspark.errors import StreamingQueryException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from roadpulse.schemas import FEEDS
from roadpulse.sources.storage import checkpoint_path, raw_path
from roadpulse.sources.wire import decode, parsed, parts
from roadpulse.streaming.status import StreamStatus

WIRE_SCHEMA = "key string, value string"
DEFAULT_WATERMARK = "2 minutes"


def landing_path(landing: str, feed: str) -> str:
    return f"{landing.rstrip('/')}/{feed}"


def publish(wire: DataFrame, landing: str, feed: str, mode: str = "append") -> None:
    """Batch-publish encoded (key, value) records into a feed's landing folder."""
    wire.select("key", "value").write.mode(mode).parquet(landing_path(landing, feed))


def read_topic(spark: SparkSession, feed: str, *, fmt: str = "parquet", landing: str | None = None,
               options: dict[str, str] | None = None, max_files_per_trigger: int | None = None,
               max_bytes_per_trigger: int | None = None, archive: str | None = None) -> DataFrame:
    """Unbounded (key, value) records of one feed. Admission to a micro-batch: by bytes or by number
    of files of a landing folder (a single larger file still comes through, alone), by
    `maxOffsetsPerTrigger` of Kafka in `options`. With `archive`, files of committed batches move
    there, so that the landing folder's listing stays short."""
    options = dict(options or {})
    if fmt == "kafka":
        # minPartitions splits a large topic partition into several tasks by offset range,
        # so one hot topic partition does not become one task per batch
        reader = (spark.readStream.format("kafka").option("subscribe", feed)
                  .option("startingOffsets", "latest").option("failOnDataLoss", "false")
                  .option("minPartitions", str(spark.sparkContext.defaultParallelism)))
        return reader.options(**options).load().selectExpr("CAST(key AS STRING) AS key",
                                                           "CAST(value AS STRING) AS value")
    if landing is None:
        raise ValueError("a file topic needs its landing folder")
    reader = spark.readStream.options(**options)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", str(max_files_per_trigger))
    if max_bytes_per_trigger:
        reader = reader.option("maxBytesPerTrigger", str(max_bytes_per_trigger))
    if archive:
        reader = reader.option("cleanSource", "archive").option("sourceArchiveDir", f"{archive.rstrip('/')}/{feed}")
    path = landing_path(landing, feed)
    if fmt == "parquet":
        return reader.schema(WIRE_SCHEMA).parquet(path)
    if fmt == "json":
        return reader.schema(WIRE_SCHEMA).json(path)
    if fmt == "text":
        return reader.text(path).selectExpr("CAST(NULL AS STRING) AS key", "value")
    raise ValueError(f"unknown topic format {fmt!r}")


def decode_stream(df: DataFrame, feed: str, watermark: str | None = DEFAULT_WATERMARK) -> DataFrame:
    """S2 + T1: typed decode and an event-time watermark on `timestamp`."""
    out = decode(df, feed)
    return out.withWatermark("timestamp", watermark) if watermark else out


def _trigger(writer, trigger: dict | None):
    return writer.trigger(**trigger) if trigger else writer


def write_stream(df: DataFrame, path: str, checkpoint: str, *, trigger: dict | None = None,
                 partition_by: list[str] | None = None, query_name: str | None = None,
                 output_mode: str = "append") -> StreamingQuery:
    """Append a stream to Parquet with a checkpoint (exactly-once file sink, T2-T4)."""
    writer = (df.writeStream.format("parquet").option("checkpointLocation", checkpoint)
              .option("path", path).option("compression", "snappy").outputMode(output_mode))
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    if query_name:
        writer = writer.queryName(query_name)
    return _trigger(writer, trigger).start()


def _holds(spark: SparkSession, pattern: str) -> bool:
    path = spark._jvm.org.apache.hadoop.fs.Path(pattern)
    return bool(path.getFileSystem(spark._jsc.hadoopConfiguration()).globStatus(path))


def write_raw(df: DataFrame, feed: str, base: str, *, trigger: dict | None = None) -> StreamingQuery:
    """S3: raw append sink of one feed."""
    if _holds(df.sparkSession, f"{raw_path(base, feed)}/batch=*"):
        raise ValueError(f"{raw_path(base, feed)} is written batch by batch (dead letters or late rows): go on that way")
    return write_stream(df, raw_path(base, feed), checkpoint_path(base, feed), trigger=trigger)


def await_all(spark: SparkSession, queries: list[StreamingQuery], poll_s: int = 1, *, keep_going: bool = False) -> None:
    """Block until every query has stopped. The first failure of any query stops the others and is
    raised at once (a later query's failure is not hidden behind an earlier one that keeps
    running); with `keep_going` the others run on, and the failures are raised when all have ended.
    Only these queries are looked at; other queries of the session are left alone."""
    pending, failed = list(queries), []
    while pending:
        ended = [q for q in pending if not q.isActive]
        pending = [q for q in pending if q.isActive]
        failed += [q for q in ended if q.exception() is not None]
        if failed and not keep_going:
            for other in pending:
                other.stop()
            break
        if pending:
            with suppress(StreamingQueryException):  # it has failed: seen in the next turn
                pending[0].awaitTermination(poll_s)
    if failed:
        raise RuntimeError("; ".join(f"stream {q.name or q.id} failed: {q.exception()}" for q in failed))


def dead_letter_path(base: str, feed: str) -> str:
    return f"{base.rstrip('/')}/dead_letters/{feed}"


def late_path(base: str, feed: str) -> str:
    return f"{base.rstrip('/')}/late/{feed}"


def _high_path(base: str, feed: str, batch_id: int) -> str:
    return f"{base.rstrip('/')}/_event_time/{feed}/batch={batch_id}"


def split_batch(feed: str, base: str, late_after: str | None = None) -> Callable[[DataFrame, int], None]:
    """What one micro-batch of a split ingest does: decoded rows go to the raw layer, undecodable records to
    the dead letters and, with `late_after`, rows at or below the batch's watermark to the late
    rows. That watermark is the highest event time of all earlier batches less `late_after`, as the
    engine's own; each batch keeps the highest time so far in a table of its own, so a batch that
    runs again decides alike. Every folder is a batch's own and is overwritten by a second run."""
    def split(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        records = parsed(batch, feed).persist()  # parsed once, for all outputs
        try:
            good, bad = parts(records)
            outputs = [(bad, dead_letter_path(base, feed))]
            if late_after:
                before = spark.read.schema("high bigint").parquet(_high_path(base, feed, batch_id - 1)).first().high if batch_id else None
                seen = good.agg(F.max(F.unix_micros("timestamp")).alias("high"))
                mark = F.lit(False) if before is None else F.col("timestamp") <= F.timestamp_micros(F.lit(before)) - F.expr(f"INTERVAL {late_after}")
                late = F.coalesce(mark, F.lit(False))
                outputs += [(good.filter(late), late_path(base, feed))]
                good = good.filter(~late)
                seen.select(F.greatest("high", F.lit(before).cast("bigint")).alias("high")).write.mode("overwrite").parquet(_high_path(base, feed, batch_id))
            for df, path in [(good, raw_path(base, feed)), *outputs]:
                df.write.mode("overwrite").option("compression", "snappy").parquet(f"{path}/batch={batch_id}")
        finally:
            records.unpersist()
    return split


def write_split(topic: DataFrame, feed: str, base: str, *, trigger: dict | None = None, late_after: str | None = None) -> StreamingQuery:
    """One query, so one reader of the topic, writes every micro-batch to several folders
    (`split_batch`); a record is in exactly one of them. A base folder is ingested either this way
    or by `write_raw`, from its first batch on; the other is refused."""
    if _holds(topic.sparkSession, f"{raw_path(base, feed)}/_spark_metadata"):
        raise ValueError(f"{raw_path(base, feed)} is written by the file sink: go on without dead letters and late rows")
    writer = topic.writeStream.option("checkpointLocation", checkpoint_path(base, feed)).foreachBatch(split_batch(feed, base, late_after))
    return _trigger(writer, trigger).start()


def run_ingest(spark: SparkSession, landing: str, base: str, feeds: tuple[str, ...] = FEEDS, *,
               fmt: str = "parquet", trigger: dict | None = None, watermark: str | None = DEFAULT_WATERMARK,
               wait: bool = True, dead_letters: bool = False, late_rows: bool = False, keep_going: bool = False,
               status: StreamStatus | None = None, options: dict[str, str] | None = None) -> list[StreamingQuery]:
    """One concurrent streaming query per feed (topic -> decode -> raw Parquet).
    With `dead_letters` (X9), records whose id does not decode go, whole and undecoded, to
    base/dead_letters/<feed> instead of becoming all-null raw rows; with `late_rows`, so do rows behind the
    watermark, to base/late/<feed>. With `wait` (and a finite trigger such as availableNow) block
    until all finish; with `keep_going` one feed's failure leaves the others running. `status` keeps
    a table of every feed's batches and failures. If a query cannot start, those already
    started are stopped."""
    started = []
    try:
        for feed in feeds:
            topic = read_topic(spark, feed, fmt=fmt, landing=landing, options=options)
            if dead_letters or late_rows:
                started.append(write_split(topic, feed, base, trigger=trigger, late_after=watermark if late_rows else None))
            else:
                started.append(write_raw(decode_stream(topic, feed, watermark), feed, base, trigger=trigger))
            if status:
                status.watch(started[-1], feed)
    except Exception:
        for query in started:
            query.stop()
        raise
    if wait:
        try:
            await_all(spark, started, keep_going=keep_going)
        finally:
            if status:
                status.close()
    return started

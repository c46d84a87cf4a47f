"""Raw and refined Parquet layers.

Layout below one `base` folder (any Hadoop path: object store, HDFS, local in tests):
  base/raw/<feed>/          append-only raw Parquet (streaming sink or batch landing)
  base/refined/<feed>/date=yyyy-MM-dd/   refined Parquet, partitioned by a STRING date
  base/_checkpoints/<feed>/ streaming checkpoints
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from roadpulse.schemas import FEED_SCHEMAS, PARTITION_COLUMN, refined_schema
from roadpulse.sources import published

COMPRESSION = "snappy"  # Parquet codec of the raw and refined layers


def raw_path(base: str, feed: str) -> str:
    return f"{base.rstrip('/')}/raw/{feed}"


def refined_path(base: str, feed: str) -> str:
    return f"{base.rstrip('/')}/refined/{feed}"


def checkpoint_path(base: str, feed: str, purpose: str = "ingest") -> str:
    return f"{base.rstrip('/')}/_checkpoints/{purpose}/{feed}"


def materialize(df: DataFrame, purpose: str) -> DataFrame:
    """Write `df` once as Parquet below the session's shared checkpoint folder and return
    a scan of it: a frame read several times is computed once, and its lineage is cut
    (a lost executor re-reads the files instead of recomputing upstream shuffles)."""
    from roadpulse.session import scratch_dir

    spark = df.sparkSession
    path = scratch_dir(spark, purpose)
    df.write.parquet(path)
    return spark.read.parquet(path)


def read_raw(spark: SparkSession, feed: str, base: str) -> DataFrame:
    """Raw feed with the registry schema imposed (no inference, no schema merge)."""
    rows = spark.read.schema(FEED_SCHEMAS[feed]).parquet(raw_path(base, feed))
    return rows.select(*[f.name for f in FEED_SCHEMAS[feed].fields])  # not the batch folders of split ingest


def write_raw_batch(df: DataFrame, feed: str, base: str, mode: str = "append") -> None:
    """Batch landing of raw rows (the streaming sink writes the same layout)."""
    (df.select(*[f.name for f in FEED_SCHEMAS[feed].fields]).write.mode(mode)
       .option("compression", COMPRESSION).parquet(raw_path(base, feed)))


def refined_read_schema(feed: str) -> StructType:
    return StructType(refined_schema(feed).fields + [StructField(PARTITION_COLUMN, StringType(), True)])


def read_refined(spark: SparkSession, feed: str, base: str) -> DataFrame:
    """Refined feed by path, as last published; `date` stays a STRING (no partition type inference)."""
    return published.read(spark, refined_path(base, feed), refined_read_schema(feed), PARTITION_COLUMN)


def _laid_out(df: DataFrame, layout: str) -> DataFrame:
    if layout == "rebalance" and df.sparkSession.conf.get("spark.sql.adaptive.enabled", "true") != "true":
        layout = "range"  # without AQE a rebalance is one task per date; range-partition instead
    if layout == "rebalance":
        # AQE rebalance on the partition column: a big date is split into tasks of the
        # advisory size, small dates are coalesced, so each task writes one or a few
        # right-sized files; rows are time-ordered inside files (tight min/max stats).
        return df.hint("rebalance", PARTITION_COLUMN).sortWithinPartitions(PARTITION_COLUMN, "timestamp")
    if layout == "range":
        # Range partitioning on (date, timestamp): balanced, contiguous time ranges per
        # task, at the cost of a sampling pass.
        return df.repartitionByRange(PARTITION_COLUMN, "timestamp").sortWithinPartitions(PARTITION_COLUMN, "timestamp")
    if layout == "local":
        # No extra shuffle: each task writes one file per date it holds, one at a time.
        return df.sortWithinPartitions(PARTITION_COLUMN)
    raise ValueError(f"unknown layout {layout!r}")


class Rows(int):
    """A number of rows written; `dates` names the dates (partition folder names) they lie on."""

    dates: tuple[str, ...] = ()

    @classmethod
    def observed(cls, obs: Observation) -> "Rows":
        out = cls(obs.get["rows"])
        out.dates = tuple(sorted(obs.get["dates"]))
        return out


def _write_dates(df: DataFrame, feed: str, path: str, layout: str, mode: str, dynamic: bool = False) -> Rows:
    obs = Observation(f"rows_{feed}_{uuid.uuid4().hex[:12]}")  # unique: writes may run concurrently
    out = _laid_out(df.select(*[f.name for f in refined_read_schema(feed).fields]), layout).observe(
        obs, F.count(F.lit(1)).alias("rows"), F.collect_set(F.coalesce(F.col(PARTITION_COLUMN), F.lit(published.NO_DATE))).alias("dates"))
    writer = out.write.mode(mode).option("compression", COMPRESSION).partitionBy(PARTITION_COLUMN)
    if dynamic:
        writer = writer.option("partitionOverwriteMode", "dynamic")
    writer.parquet(path)
    return Rows.observed(obs)


def write_refined(df: DataFrame, feed: str, base: str, *, mode: str = "overwrite",
                  dynamic: bool = False, layout: str = "rebalance") -> Rows:
    """Write a refined feed partitioned by `date`; returns the row count and the dates, observed
    during the write (no second pass). `dynamic=True` replaces the dates present in `df`, each
    as a whole, and keeps every other partition: `df` must hold all rows of its dates
    (`incremental_refine` sees to that for a delta). `layout="rebalance"` needs AQE; without
    it rows go through `range`, the same rows in other files. A whole overwrite also drops
    what was published since the last one; a table with published dates takes no appends."""
    spark, root = df.sparkSession, refined_path(base, feed)
    now = published.manifest(spark, root) if dynamic or mode != "overwrite" else None
    if now is None:
        return _write_dates(df, feed, root, layout, mode, dynamic)
    if not dynamic:
        raise ValueError(f"{root} has dates published after its last whole write: use incremental_refine or dynamic=True")
    label = published.new_label()
    rows = _write_dates(df, feed, f"{root}/_versions/v={label}", layout, "overwrite")
    published.publish(spark, root, now, label, dates=list(rows.dates), gone=[], buckets=None, n_buckets=now["n_buckets"])
    return rows


def incremental_refine(raw_delta: DataFrame, feed: str, base: str, *, layout: str = "rebalance", id_buckets: int = 64) -> Rows:
    """Bring a delta of raw rows (new ids, corrected copies, late rows) into the refined feed
    and rewrite only the dates it touches: those of its rows and those on which its ids lie now.
    The refined table holds one surviving row per id; a delta's copy of an id replaces that
    row wherever it lies, also where the new copy fails the feed's range rules, and of several
    copies in one delta the latest counts (`dedup_latest`). Null ids are one id, rows without a
    time lie on the date-less partition, and the same delta again changes nothing. So the result
    equals a refine of all rows from scratch in which later deltas win.

    Which dates hold a delta's ids is read from the id index, only in the buckets its ids fall
    into; the first delta builds the index from the table. Untouched dates are neither read nor
    written. New folders are staged and one manifest switches to them (`published`): a run that
    ends early leaves the table as it was. Returns the rows on the touched dates, and these."""
    from roadpulse.operators.refine import REFINERS, dedup_latest

    spark, root = raw_delta.sparkSession, refined_path(base, feed)
    names = [f.name for f in FEED_SCHEMAS[feed].fields]
    delta = materialize(dedup_latest(raw_delta.select(*names)), f"delta-{feed}")
    fresh = materialize(REFINERS[feed](delta, dedup_rows=False), f"fresh-{feed}")
    now = published.manifest(spark, root)
    ids = delta.select("id", published.bucket("id", id_buckets).alias("bucket"))
    wanted = [r.bucket for r in ids.select("bucket").distinct().collect()]  # id_buckets at most
    if not wanted:
        return Rows(0)
    table = read_refined(spark, feed, base)
    index = published.ids(spark, root, now, "id", PARTITION_COLUMN, id_buckets, wanted)
    if index is None:  # the first delta, or other buckets than before
        index = table.select("id", PARTITION_COLUMN, published.bucket("id", id_buckets).alias("bucket"))
        wanted = list(range(id_buckets))
    changed = ids.select(F.col("id").alias("_changed"))
    same = F.col("id").eqNullSafe(F.col("_changed"))
    day = F.coalesce(F.col(PARTITION_COLUMN), F.lit(published.NO_DATE)).alias("d")
    # one row per calendar date
    touched = {r.d for r in index.join(changed, same, "left_semi").select(day).unionByName(fresh.select(day)).distinct().collect()}
    known = F.col(PARTITION_COLUMN).isin(sorted(touched - {published.NO_DATE}))
    on_touched = known | F.col(PARTITION_COLUMN).isNull() if published.NO_DATE in touched else known
    label = published.new_label()
    rebuilt = table.filter(on_touched).join(changed, same, "left_anti").unionByName(fresh)
    rows = _write_dates(rebuilt, feed, f"{root}/_versions/v={label}", layout, "overwrite")
    entries = index.join(changed, same, "left_anti").unionByName(
        fresh.select("id", PARTITION_COLUMN, published.bucket("id", id_buckets).alias("bucket")))
    obs = Observation(f"ids_{feed}_{label}")
    (entries.hint("rebalance", "bucket").sortWithinPartitions("bucket", "id").observe(obs, F.collect_set("bucket").alias("buckets"))
     .write.partitionBy("bucket").parquet(f"{root}/_ids/v={label}"))
    published.publish(spark, root, _without(now, wanted), label, dates=list(rows.dates), gone=sorted(touched - set(rows.dates)),
                      buckets=sorted(obs.get["buckets"]), n_buckets=id_buckets)
    rows.dates = tuple(sorted(touched))
    return rows


def _without(now: dict | None, buckets: list[int]) -> dict | None:
    """A manifest whose entries for these buckets of ids are written anew."""
    return now and now | {"ids": {b: label for b, label in now["ids"].items() if int(b) not in buckets}}


def refine_deltas(spark: SparkSession, raw_base: str, refined_base: str, feeds: tuple[str, ...] | None = None, *, db: str | None = None,
                  strict: bool = False, layout: str = "rebalance") -> DataFrame:
    """X13 for every feed that has raw rows at `raw_base`: each is brought in as a delta and, with `db`, the
    dates it touched are registered. One feed failing does not stop the others. Returns (feed, status, rows)."""
    from roadpulse.schemas import FEEDS
    from roadpulse.sources.catalog import register_dates

    results = []
    for feed in feeds or FEEDS:
        try:
            rows = incremental_refine(read_raw(spark, feed, raw_base), feed, refined_base, layout=layout)
            if db:
                register_dates(spark, db, feed, refined_base, rows.dates)
            results.append((feed, "OK", int(rows)))
        except Exception as exc:
            if strict:
                raise
            results.append((feed, f"FAIL: {type(exc).__name__}: {exc}", None))
    return spark.createDataFrame(results, "feed string, status string, rows bigint")


def refine_all(spark: SparkSession, raw_base: str, refined_base: str, feeds: tuple[str, ...] | None = None,
               *, strict: bool = False, layout: str = "rebalance", concurrent: bool = True,
               dynamic: bool = False, **refine_kw) -> DataFrame:
    """Raw -> refined for every feed; one feed failing does not stop the others.
    Feeds are independent jobs and run concurrently unless `concurrent=False`. With
    `dynamic=True` only the dates present in the raw input are replaced, each as a whole: the
    input must hold all rows of those dates (for a delta use incremental_refine).
    Returns (feed, status, rows); `strict=True` raises the first failure instead."""
    from roadpulse.operators.refine import REFINERS
    from roadpulse.schemas import FEEDS
    from roadpulse.session import run_concurrently

    feeds = tuple(feeds or FEEDS)

    def job(feed: str):
        return lambda: write_refined(REFINERS[feed](read_raw(spark, feed, raw_base), **refine_kw), feed,
                                     refined_base, layout=layout, dynamic=dynamic)

    if concurrent:
        outcome = run_concurrently({feed: job(feed) for feed in feeds})
    else:
        outcome = {}
        for feed in feeds:
            try:
                outcome[feed] = job(feed)()
            except Exception as exc:
                outcome[feed] = exc
    results = []
    for feed in feeds:
        got = outcome[feed]
        if isinstance(got, Exception):
            if strict:
                raise got
            results.append((feed, f"FAIL: {type(got).__name__}: {got}", None))
        else:
            results.append((feed, "OK", int(got)))
    return spark.createDataFrame(results, "feed string, status string, rows bigint")

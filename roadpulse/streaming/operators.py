"""Stateful streaming operators, bounded by event-time watermarks.

Each works on a decoded, watermarked stream (decode_stream) and shares its column rules
with the batch operators, so a stream and a batch over the same records agree.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from roadpulse.functions import rules
from roadpulse.functions.stats import exact_mean
from roadpulse.operators.refine import RANGE_RULES, REFINERS

KEY = "id"


def stream_dedup(df: DataFrame, key: str = KEY, salts: int | None = None) -> DataFrame:
    """Drop re-deliveries of an id; state for an id is kept only until the watermark
    passes its event time plus the watermark delay (bounded state).

    Copies of one id all hash to one task. Where bursts of copies of a single id are to be
    expected (a third of a batch, say), `salts` splits them at the price of a second state
    store: a first dedup runs on
    (id, input partition mod salts): copies arriving through different input partitions
    meet in different tasks, and at most `salts` survivors per id reach the final dedup on
    id. The salt is the input partition, so a replayed batch salts the same way."""
    if salts and salts > 1:
        df = (df.withColumn("_salt", F.spark_partition_id() % salts)
                .dropDuplicatesWithinWatermark([key, "_salt"]).drop("_salt"))
    return df.dropDuplicatesWithinWatermark([key])


def stream_refine(df: DataFrame, feed: str, *, dedup_rows: bool = True) -> DataFrame:
    """The refine rules on a stream. Deduplication is the watermark-bounded form; the
    filters and derived columns are the batch ones. Sink it partitioned by `date`."""
    if dedup_rows:
        df = stream_dedup(df)
    return REFINERS[feed](df, dedup_rows=False)


def hourly_incidents(e: DataFrame) -> DataFrame:
    """Incidents per (1-hour tumbling window, type), 'None' excluded; in append mode a
    window is emitted once the watermark passes its end."""
    return (e.filter(rules.not_none_type("type") & F.col("type").isNotNull())
             .groupBy(F.window("timestamp", "1 hour"), "type")
             .agg(F.count(F.lit(1)).alias("count"))
             .select(F.col("window.start").alias("timestamp"), "type", "count"))


def sliding_speed(v: DataFrame, length: str = "10 minutes", slide: str = "5 minutes") -> DataFrame:
    """Speed statistics over sliding event-time windows."""
    return (v.groupBy(F.window("timestamp", length, slide))
             .agg(F.count(F.lit(1)).alias("observations"),
                  F.round(exact_mean("speed_kmh", 1), 1).alias("avg_speed_kmh"),
                  F.max("speed_kmh").alias("max_speed_kmh"))
             .select(F.col("window.start").alias("window_start"), F.col("window.end").alias("window_end"),
                     "observations", "avg_speed_kmh", "max_speed_kmh"))


def stream_trips(v: DataFrame, gap_seconds: int = 7200, key: str = "vehicle_id") -> DataFrame:
    """X6 on a stream: `temporal.trips` as merging session windows. Readings of a vehicle form one
    trip while the pause between them is shorter than the gap; a trip is emitted once the
    watermark passes its last reading by the gap, and its state (one row of sums per open trip,
    not its readings) leaves with it. A session window joins readings up to and with its gap, so the
    gap is a microsecond less. `spark.sql.streaming.sessionWindow.merge.sessions.in.local.partition`
    (on in `build_session`) merges a busy vehicle's readings before the shuffle."""
    gap = f"{gap_seconds - 1}.999999 seconds"
    return (v.filter(F.col(key).isNotNull())
             .groupBy(key, F.session_window("timestamp", gap))
             .agg(F.max("timestamp").alias("trip_end"), F.count(F.lit(1)).alias("points"),
                  F.round(exact_mean("speed_kmh", 1), 1).alias("avg_speed_kmh"))
             .select(key, F.col("session_window.start").alias("trip_start"), "trip_end", "points", "avg_speed_kmh",
                     ((F.unix_micros("trip_end") - F.unix_micros("session_window.start")) / 1_000_000).cast("bigint").alias("duration_s")))


def observed_refine(df: DataFrame, feed: str, *, dedup_rows: bool = True) -> DataFrame:
    """X3 with X12: as stream_refine, and every micro-batch reports how many deduplicated rows each range
    rule rejects, as the observed metrics `rejects_<feed>` of the query's progress: counted while the
    rows pass, without a second reader. `status.reject_rows` turns them into rows."""
    if dedup_rows:
        df = stream_dedup(df)
    passes = [(name, F.coalesce(rule(), F.lit(False))) for name, rule in RANGE_RULES.get(feed, [])]
    every = F.lit(True)
    for _, ok in passes:
        every = every & ok
    counts = [F.count_if(~ok).alias(name) for name, ok in [*passes, ("any_rule", every)]]
    df = df.observe(f"rejects_{feed}", *counts, F.count(F.lit(1)).alias("checked"))
    return REFINERS[feed](df, dedup_rows=False)


def join_weather(v: DataFrame, w: DataFrame, within: str = "5 minutes", within_seconds: int = 300, salts: int = 1) -> DataFrame:
    """X11: stream-stream join of vehicle and weather readings of the same vehicle whose
    event times are at most `within` apart. Both sides carry watermarks, so each side's
    join state is dropped once no future row of the other side can match it.

    State is keyed by (vehicle, time bucket of 2 x within) rather than by vehicle alone, so a
    busy vehicle spreads over buckets: a weather reading sits in its own bucket, a vehicle
    reading is emitted to the buckets of its window ends (at most two), so every pair
    meets in exactly one bucket and the interval condition keeps the exact semantics. `salts`
    splits a hot bucket further: a vehicle reading goes to one of that many tasks, by its id, and a
    weather reading to all of them, so a pair still meets once."""
    width = 2 * within_seconds * 1_000_000
    bucket_of = lambda c: F.floor(F.unix_micros(c) / F.lit(width)).cast("bigint")
    vt = F.col("timestamp")
    lo = bucket_of(vt - F.expr(f"INTERVAL {within}"))
    hi = bucket_of(vt + F.expr(f"INTERVAL {within}"))
    vs = v.select(F.col("id").alias("vehicle_record"), F.col("vehicle_id"),
                  F.col("timestamp").alias("vehicle_time"), "speed_kmh",
                  *([F.pmod(F.xxhash64("id"), F.lit(salts)).cast("int").alias("_vs")] if salts > 1 else []),
                  F.explode(F.array_distinct(F.array(lo, hi))).alias("_vb"))
    ws = w.select(F.col("id").alias("weather_record"), F.col("vehicle_id").alias("w_vehicle_id"),
                  F.col("timestamp").alias("weather_time"), "temperature", "weatherCondition",
                  bucket_of(F.col("timestamp")).alias("_wb"),
                  *([F.explode(F.sequence(F.lit(0), F.lit(salts - 1))).alias("_ws")] if salts > 1 else []))
    cond = ((F.col("vehicle_id") == F.col("w_vehicle_id")) & (F.col("_vb") == F.col("_wb"))
            & ((F.col("_vs") == F.col("_ws")) if salts > 1 else F.lit(True))
            & (F.col("weather_time") >= F.col("vehicle_time") - F.expr(f"INTERVAL {within}"))
            & (F.col("weather_time") <= F.col("vehicle_time") + F.expr(f"INTERVAL {within}")))
    return vs.join(ws, cond, "inner").drop("w_vehicle_id", "_vb", "_wb", "_vs", "_ws")

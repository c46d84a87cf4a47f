"""Time-ordered per-vehicle operators: trips (sessions split by inactivity) and the as-of
join (latest weather reading at or before each vehicle reading).

Both need "the previous row of this vehicle", which a window partitioned by vehicle alone
would compute in one task per vehicle: a vehicle holding a third of all rows would be a
third of the job in one task. Here no window ever runs over all rows of a vehicle. Trips are
built from summaries per (vehicle, bucket), combined map-side, whose number is bounded by time,
not by data volume; the as-of join runs over ranges of (vehicle, time) of about equal size and
hands what a range ends with to the ranges that follow.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from roadpulse.functions.stats import mean_from_parts, scaled


def _bucket(ts: Column, seconds: int) -> Column:
    return F.floor(F.unix_micros(ts) / F.lit(seconds * 1_000_000)).cast("bigint")


def trips(v: DataFrame, gap_seconds: int = 7200, bucket_seconds: int | None = None,
          key: str = "vehicle_id", ts: str = "timestamp") -> DataFrame:
    """Per vehicle, consecutive readings form one trip while the pause between them is
    shorter than `gap_seconds`; a pause of at least the gap starts a new trip.
    Output: vehicle_id, trip_start, trip_end, points, avg_speed_kmh, duration_s.

    Buckets are at most `gap_seconds` wide, so two readings in one bucket are less than a
    gap apart: only the first reading of a bucket can start a trip, and every reading of a
    bucket belongs to the same trip. The rows are therefore aggregated once to one summary
    per (vehicle, bucket) -- map-side combined, so a busy vehicle never lands in one task --
    and trip boundaries are found by a window over those summaries (one row per non-empty
    bucket of a vehicle). Trips are the sums of their buckets. One scan, no row-level join."""
    bucket_seconds = bucket_seconds or gap_seconds
    if bucket_seconds > gap_seconds:
        raise ValueError("bucket_seconds must not exceed gap_seconds")
    rows = v.filter(F.col(key).isNotNull() & F.col(ts).isNotNull())
    buckets = (rows.groupBy(key, _bucket(F.col(ts), bucket_seconds).alias("_b"))
                   .agg(F.min(ts).alias("_first"), F.max(ts).alias("_last"), F.count(F.lit(1)).alias("_n"),
                        F.sum(scaled("speed_kmh", 1)).alias("_s"), F.count(scaled("speed_kmh", 1)).alias("_c")))
    by_vehicle = Window.partitionBy(key).orderBy("_b")
    prev_last = F.lag("_last").over(by_vehicle)
    pause = F.unix_micros(F.col("_first")) - F.unix_micros(prev_last)
    starts = buckets.withColumn(
        "_start", F.when(prev_last.isNull() | (pause >= F.lit(gap_seconds * 1_000_000)), F.col("_first")))
    assigned = starts.withColumn(
        "trip_start", F.max("_start").over(by_vehicle.rowsBetween(Window.unboundedPreceding, Window.currentRow)))
    return (assigned.groupBy(key, "trip_start")
                    .agg(F.max("_last").alias("trip_end"), F.sum("_n").alias("points"),
                         F.round(mean_from_parts(F.sum("_s"), F.sum("_c"), 1), 1).alias("avg_speed_kmh"))
                    .withColumn("duration_s",
                                ((F.unix_micros("trip_end") - F.unix_micros("trip_start")) / 1_000_000)
                                .cast("bigint"))
                    .orderBy(key, "trip_start"))


WX_TYPE = "struct<t:timestamp,wid:string,temp:double,cond:string>"


def asof_weather(v: DataFrame, w: DataFrame, key: str = "vehicle_id", ts: str = "timestamp") -> DataFrame:
    """Every vehicle reading with the latest weather reading of the same vehicle at or
    before its timestamp (a weather reading at the same instant counts as before; among
    weather readings at one instant the greatest id wins). No earlier reading: nulls.
    Output: id, vehicle_id, timestamp, speed_kmh, weather_id, weather_time, temperature,
    weatherCondition.

    Both inputs, narrow, are laid out together by ranges of (vehicle, time, weather first, id). Ranges
    are of about equal size whatever the skew: a busy vehicle, even one busy instant, is cut into
    several. A window per range and vehicle carries the last weather along; then each vehicle that
    goes on in a further range takes over the last weather of its earlier ranges, which is at most
    one row per range, so that side is broadcast. Rows are shuffled twice (by range, and to
    the window of their range) and never joined to each other. The laid-out rows are written
    once below the shared checkpoint folder. Readings without a vehicle or a time keep their
    row, with nulls."""
    from roadpulse.sources.storage import materialize

    wx = F.struct(F.col(ts).alias("t"), F.col("id").alias("wid"), F.col("temperature").alias("temp"),
                  F.col("weatherCondition").alias("cond"))
    known = F.col(key).isNotNull() & F.col(ts).isNotNull()
    readings = v.select(key, ts, F.lit(1).alias("_side"), "id", "speed_kmh", F.lit(None).cast(WX_TYPE).alias("_wx"))
    both = readings.unionByName(w.select(key, ts, F.lit(0).alias("_side"), "id", F.lit(None).cast("double").alias("speed_kmh"), wx.alias("_wx")))
    order = [ts, "_side", "id"]
    upto = Window.partitionBy("_range", key).orderBy(*order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    laid = materialize(both.filter(known).repartitionByRange(key, *order).withColumn("_range", F.spark_partition_id())
                       .withColumn("_near", F.last("_wx", ignorenulls=True).over(upto)), "asof")
    # one row per vehicle and range; of them only vehicles that go on in a further range get a carry
    ends = laid.groupBy(key, "_range").agg(F.max_by("_wx", F.when(F.col("_side") == 0, F.struct(ts, "id"))).alias("_last"))
    earlier = Window.partitionBy(key).orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    carry = (ends.withColumn("_carry", F.last("_last", ignorenulls=True).over(earlier)).filter("_carry IS NOT NULL")
             .select(key, "_range", "_carry"))
    answered = (laid.filter("_side = 1").join(F.broadcast(carry), [key, "_range"], "left")
                .select("id", key, ts, "speed_kmh", F.coalesce("_near", "_carry").alias("_m")))
    out = answered.unionByName(v.filter(~known).select("id", key, ts, "speed_kmh", F.lit(None).cast(WX_TYPE).alias("_m")))
    return out.select("id", key, ts, "speed_kmh", F.col("_m.wid").alias("weather_id"),
                      F.col("_m.t").alias("weather_time"), F.col("_m.temp").alias("temperature"),
                      F.col("_m.cond").alias("weatherCondition"))

"""Vehicle analytics over refined frames (vehicle, weather, emergency).

The two joins on (vehicle_id, date) are many-to-many: every vehicle row of a vehicle-day
meets every weather (and emergency) row of the same vehicle-day, and the figures are
taken over those pairs. Instead of materialising the pairs (cubic in the rows of a busy
vehicle-day), each side is pre-aggregated per key and the pair-level sums are rebuilt
exactly: a sum over pairs of a vehicle value is (sum over the vehicle rows) x (number of
partner rows), and so on. Those products are DECIMAL(38,0): a busy vehicle-day makes more pairs
than a BIGINT holds. The joins then meet one row per key per side, all three sides
are hash-partitioned on the same key by their aggregates, and a hot vehicle is combined
map-side before any shuffle.
"""

from __future__ import annotations

from functools import reduce
from operator import mul

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from roadpulse.operators.quantiles import histogram_summary, sketch_percentiles
from roadpulse.functions.stats import (
    WIDE,
    big,
    exact_mean,
    exact_stddev,
    mean_from_parts,
    pct,
    scaled,
    sum_flag,
    wide_mean,
    wide_units,
)

KEYS = ["vehicle_id", "date"]
SPEED_KMH_SCALE, HEAT_SCALE, HUMIDITY_SCALE = 1, 1, 0  # decimals the rules leave


def speed_by_make_fuel(v: DataFrame) -> DataFrame:
    """V1: speed statistics per (make, fuelType), fastest first."""
    return (v.groupBy("make", "fuelType")
             .agg(F.count(F.lit(1)).alias("trip_count"),
                  F.round(exact_mean("speed_kmh", SPEED_KMH_SCALE), 1).alias("avg_speed_kmh"),
                  F.round(F.min("speed_kmh"), 1).alias("min_speed_kmh"),
                  F.round(F.max("speed_kmh"), 1).alias("max_speed_kmh"),
                  F.round(exact_stddev("speed_kmh", SPEED_KMH_SCALE), 2).alias("stddev_speed"))
             .orderBy(F.desc("avg_speed_kmh"), "make", "fuelType"))


def speed_by_hour(v: DataFrame, method: str = "histogram", accuracy: int = 10_000) -> DataFrame:
    """V2: per hour of day: observations, mean, p50 and p95 of speed_kmh.
    `histogram` (default) is exact: speed_kmh has at most 2,001 values, so the per-hour
    histogram is bounded whatever the data size. `sketch` uses percentile_approx."""
    if method == "histogram":
        s = histogram_summary(v, ["hour"], "speed_kmh", [0.5, 0.95], ["p50", "p95"], scale=SPEED_KMH_SCALE)
    elif method == "sketch":
        s = sketch_percentiles(v, ["hour"], "speed_kmh", [0.5, 0.95], ["p50", "p95"], scale=SPEED_KMH_SCALE, accuracy=accuracy)
    else:
        raise ValueError(f"unknown method {method!r}")
    return (s.select("hour", F.col("rows").alias("observations"), F.round("mean", 1).alias("avg_speed"),
                     F.round("p50", 1).alias("p50_speed"), F.round("p95", 1).alias("p95_speed"))
             .orderBy("hour"))


def ev_share_by_date(v: DataFrame) -> DataFrame:
    """V3: EV count and share per date; a null is_ev counts in the denominator only."""
    return (v.groupBy("date")
             .agg(F.count(F.lit(1)).alias("total_vehicles"), sum_flag("is_ev").alias("ev_count"))
             .withColumn("ev_pct", pct(F.col("ev_count"), F.col("total_vehicles")))
             .orderBy(F.desc("date")))


def top_models(v: DataFrame, n: int = 15) -> DataFrame:
    """V4: the n most frequent (make, model, year); ties broken by make, model, year."""
    return (v.groupBy("make", "model", "year")
             .agg(F.count(F.lit(1)).alias("trip_count"),
                  F.round(exact_mean("speed_kmh", SPEED_KMH_SCALE), 1).alias("avg_speed_kmh"))
             .orderBy(F.desc("trip_count"), "make", "model", "year")
             .limit(n))


def speed_by_make(v: DataFrame) -> DataFrame:
    """Mean raw speed and trip count per make."""
    return (v.groupBy("make")
             .agg(F.round(wide_mean("speed"), 1).alias("avg_speed"),
                  F.count(F.lit(1)).alias("trips"))
             .orderBy(F.desc("avg_speed"), "make"))


def _keyed(df: DataFrame) -> DataFrame:
    return df.filter(F.col("vehicle_id").isNotNull() & F.col("date").isNotNull())


def speed_by_weather(v: DataFrame, w: DataFrame) -> DataFrame:
    """V5: vehicle x weather on (vehicle_id, date), grouped by (weatherCondition,
    aqi_category); figures over the joined pairs, computed from per-key aggregates."""
    va = (_keyed(v).groupBy(*KEYS)
          .agg(F.count(F.lit(1)).alias("n_v"), F.count("id").alias("n_vid"),
               F.sum(scaled("speed_kmh", SPEED_KMH_SCALE)).alias("sp_sum"),
               F.count(scaled("speed_kmh", SPEED_KMH_SCALE)).alias("sp_cnt")))
    wa = (_keyed(w).groupBy(*KEYS, "weatherCondition", "aqi_category")
          .agg(F.count(F.lit(1)).alias("n_w"),
               F.sum(wide_units("temperature")).alias("t_sum"),
               F.count(wide_units("temperature")).alias("t_cnt"),
               F.sum(scaled("heat_index", HEAT_SCALE)).alias("hi_sum"),
               F.count(scaled("heat_index", HEAT_SCALE)).alias("hi_cnt"),
               F.sum(scaled("humidity", HUMIDITY_SCALE)).alias("h_sum"),
               F.count(scaled("humidity", HUMIDITY_SCALE)).alias("h_cnt")))
    j = va.join(wa, KEYS, "inner")
    nv, nw = big("n_v"), big("n_w")
    over = lambda c, n: F.sum(big(c) * n)
    return (j.groupBy("weatherCondition", "aqi_category")
             .agg(over("n_vid", nw).cast("bigint").alias("vehicle_obs"),
                  F.round(mean_from_parts(over("sp_sum", nw), over("sp_cnt", nw),
                                          SPEED_KMH_SCALE), 1).alias("avg_speed_kmh"),
                  F.round(mean_from_parts(over("t_sum", nv), over("t_cnt", nv),
                                          WIDE), 1).alias("avg_temp_c"),
                  F.round(mean_from_parts(over("hi_sum", nv), over("hi_cnt", nv),
                                          HEAT_SCALE), 1).alias("avg_heat_index"),
                  F.round(mean_from_parts(over("h_sum", nv), over("h_cnt", nv),
                                          HUMIDITY_SCALE), 0).alias("avg_humidity_pct"))
             .orderBy(F.desc("avg_speed_kmh"), "weatherCondition", "aqi_category"))


def daily_kpi(v: DataFrame, w: DataFrame, e: DataFrame) -> DataFrame:
    """V6: per date, vehicle LEFT JOIN weather LEFT JOIN emergency on (vehicle_id, date).
    Counts and sums are over the joined rows (multiplied by the fan-out, as the query
    defines them); rebuilt from per-key aggregates so no pair is materialised."""
    va = (v.groupBy(*KEYS)
          .agg(F.count(F.lit(1)).alias("n_v"), F.count("id").alias("n_vid"),
               F.sum(scaled("speed_kmh", SPEED_KMH_SCALE)).alias("sp_sum"),
               F.count(scaled("speed_kmh", SPEED_KMH_SCALE)).alias("sp_cnt"),
               F.sum(F.col("is_ev").cast("int")).cast("bigint").alias("ev_sum")))
    wa = (_keyed(w).groupBy(*KEYS)
          .agg(F.count(F.lit(1)).alias("n_w"),
               F.sum(wide_units("temperature")).alias("t_sum"),
               F.count(wide_units("temperature")).alias("t_cnt")))
    ea = (_keyed(e).groupBy(*KEYS)
          .agg(F.count(F.lit(1)).alias("n_e"), F.count("id").alias("n_eid"),
               F.sum(F.col("is_real_incident").cast("int")).cast("bigint").alias("real_sum")))
    j = va.join(wa, KEYS, "left").join(ea, KEYS, "left")
    nv = big("n_v")
    mw = big(F.coalesce(F.col("n_w"), F.lit(1)))
    me = big(F.coalesce(F.col("n_e"), F.lit(1)))
    over = lambda c, *n: F.sum(reduce(mul, n, big(c)))
    return (j.groupBy("date")
             .agg(F.count("vehicle_id").alias("unique_vehicles"),
                  over("n_vid", mw, me).cast("bigint").alias("total_records"),
                  F.round(mean_from_parts(over("sp_sum", mw, me), over("sp_cnt", mw, me), SPEED_KMH_SCALE), 1)
                   .alias("avg_speed_kmh"),
                  over("ev_sum", mw, me).cast("bigint").alias("ev_trips"),
                  F.round(mean_from_parts(over("t_sum", nv, me), over(F.coalesce(F.col("t_cnt"), F.lit(0)), nv, me),
                                          WIDE), 1).alias("avg_temp_c"),
                  over(F.coalesce(F.col("n_eid"), F.lit(0)), nv, mw).cast("bigint").alias("total_incidents"),
                  over("real_sum", nv, mw).cast("bigint").alias("real_incidents"))
             .orderBy(F.desc_nulls_last("date")))


def daily_kpi_exact(v: DataFrame, w: DataFrame, e: DataFrame) -> DataFrame:
    """Daily KPI without fan-out: each feed aggregated per date, then joined on date."""
    vd = (v.groupBy("date")
          .agg(F.count_distinct("vehicle_id").alias("unique_vehicles"),
               F.count("id").alias("total_records"),
               F.round(exact_mean("speed_kmh", SPEED_KMH_SCALE), 1).alias("avg_speed_kmh"),
               sum_flag("is_ev").alias("ev_trips")))
    wd = w.groupBy("date").agg(F.round(wide_mean("temperature"), 1).alias("avg_temp_c"))
    ed = (e.groupBy("date")
          .agg(F.count("id").alias("total_incidents"),
               sum_flag("is_real_incident").alias("real_incidents")))
    return (vd.join(wd, "date", "left").join(ed, "date", "left")
              .select("date", "unique_vehicles", "total_records", "avg_speed_kmh", "ev_trips",
                      "avg_temp_c", F.coalesce(F.col("total_incidents"), F.lit(0)).alias("total_incidents"),
                      "real_incidents")
              .orderBy(F.desc_nulls_last("date")))

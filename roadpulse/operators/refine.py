"""Raw feed -> refined feed: deduplicate on `id`, range-filter, derive columns.

Each refiner is a pure DataFrame -> DataFrame function; streaming reuses the same column
rules (see roadpulse.streaming). Order follows the data model: dedup first, then filters,
so a bad copy of an id wins only if it was the copy kept. `filter_first=True` moves the
range filters below the dedup, which lets Parquet skip row groups (PushedFilters) and is
identical whenever copies of an id are identical.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from roadpulse.functions import rules
from roadpulse.schemas import EMERGENCY, GPS, TRAFFIC, VEHICLE, WEATHER

KEY = "id"


def dedup(df: DataFrame, keys: tuple[str, ...] = (KEY,)) -> DataFrame:
    """One row per key, arbitrary survivor (all null keys collapse into one row).
    Map-side partial aggregation pre-combines hot keys before the shuffle."""
    return df.dropDuplicates(list(keys))


def dedup_latest(df: DataFrame, key: str = KEY, order: tuple[str, ...] = ("timestamp",)) -> DataFrame:
    """Deterministic dedup: per key keep the row with the greatest `order` columns, the
    remaining columns breaking ties (nulls lowest). One partial+final aggregate, skew-safe; the
    row is its own rank, so it is carried once."""
    cols = df.columns
    rank = F.struct(*[F.col(c) for c in order], *[F.col(c) for c in cols if c not in order])
    return df.groupBy(key).agg(F.max(rank).alias("_row")).select(*[F.col("_row")[c].alias(c) for c in cols])


def _apply(df: DataFrame, conditions: list[Column], filter_first: bool, dedup_rows: bool) -> DataFrame:
    keep = None
    for cond in conditions:  # sequential filters == their conjunction
        keep = cond if keep is None else keep & cond
    if filter_first and keep is not None:
        df = df.filter(keep)
    if dedup_rows:
        df = dedup(df)
    if not filter_first and keep is not None:
        df = df.filter(keep)
    return df


def refine_vehicle(df: DataFrame, *, filter_first: bool = False, dedup_rows: bool = True) -> DataFrame:
    df = _apply(df, [rules.speed_ok("speed")], filter_first, dedup_rows)
    return df.withColumns({
        "date": rules.event_date("timestamp"),
        "hour": rules.event_hour("timestamp"),
        "speed_kmh": rules.speed_kmh("speed"),
        "is_ev": rules.is_ev("fuelType"),
    })


def refine_gps(df: DataFrame, *, filter_first: bool = False, dedup_rows: bool = True) -> DataFrame:
    df = _apply(df, [rules.speed_ok("speed")], filter_first, dedup_rows)
    return df.withColumns({"date": rules.event_date("timestamp"), "hour": rules.event_hour("timestamp")})


def refine_traffic(df: DataFrame, *, filter_first: bool = False, dedup_rows: bool = True) -> DataFrame:
    df = _apply(df, [], filter_first, dedup_rows)
    return df.withColumn("date", rules.event_date("timestamp")).drop("snapshot")


def refine_weather(df: DataFrame, *, filter_first: bool = False, dedup_rows: bool = True) -> DataFrame:
    df = _apply(df, [rules.temperature_ok("temperature"), rules.humidity_ok("humidity")],
                filter_first, dedup_rows)
    return df.withColumns({
        "date": rules.event_date("timestamp"),
        "heat_index": rules.heat_index("temperature", "humidity"),
        "aqi_category": rules.aqi_category("airQualityIndex"),
    })


def refine_emergency(df: DataFrame, *, filter_first: bool = False, dedup_rows: bool = True) -> DataFrame:
    df = _apply(df, [], filter_first, dedup_rows)
    return df.withColumns({
        "date": rules.event_date("timestamp"),
        "is_active": rules.is_active("status"),
        "is_real_incident": rules.is_real_incident("type"),
    })


REFINERS: dict[str, Callable[..., DataFrame]] = {
    VEHICLE: refine_vehicle,
    GPS: refine_gps,
    TRAFFIC: refine_traffic,
    WEATHER: refine_weather,
    EMERGENCY: refine_emergency,
}

# Range rules per feed, in the order the refiner applies them.
RANGE_RULES: dict[str, list[tuple[str, Callable[[], Column]]]] = {
    VEHICLE: [("speed_range", lambda: rules.speed_ok("speed"))],
    GPS: [("speed_range", lambda: rules.speed_ok("speed"))],
    WEATHER: [("temperature_range", lambda: rules.temperature_ok("temperature")),
              ("humidity_range", lambda: rules.humidity_ok("humidity"))],
}


def reject_counts(df: DataFrame, feed: str) -> DataFrame:
    """Rows (after dedup) each rule rejects, and rows rejected by any rule, in one pass.
    Columns: feed, rule, rejected, checked. A null or NaN value fails its rule."""
    deduped = dedup(df)
    feed_rules = RANGE_RULES.get(feed, [])
    passes = [F.coalesce(rule(), F.lit(False)) for _, rule in feed_rules]
    every = F.lit(True)
    for p in passes:
        every = every & p
    aggs = [F.count_if(~p).alias(name) for (name, _), p in zip(feed_rules, passes)]
    aggs.append(F.count_if(~every).alias("any_rule"))
    aggs.append(F.count(F.lit(1)).alias("checked"))
    names = [name for name, _ in feed_rules] + ["any_rule"]
    one_row = deduped.agg(*aggs)
    return (one_row.unpivot(["checked"], names, "rule", "rejected")
                   .select(F.lit(feed).alias("feed"), "rule", F.col("rejected").cast("bigint"),
                           F.col("checked").cast("bigint")))

"""Emergency-incident analytics over the refined emergency frame."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from roadpulse.functions import rules
from roadpulse.functions.stats import pct, sum_flag


def incidents_by_day(e: DataFrame) -> DataFrame:
    """Per (date, type, status): events, active and real-incident counts."""
    return (e.groupBy("date", F.col("type").alias("incident_type"), "status")
             .agg(F.count(F.lit(1)).alias("total_events"),
                  sum_flag("is_active").alias("active_count"),
                  sum_flag("is_real_incident").alias("real_incident_count"))
             .orderBy(F.desc_nulls_last("date"), F.desc("total_events"), "incident_type", "status"))


def latest_date(df: DataFrame, date_col: str = "date") -> Column:
    """The newest partition date present, as a scalar subquery (one small aggregate job)."""
    return df.agg(F.max(date_col)).scalar()


def active_incidents(e: DataFrame, as_of: str | Column | None = None) -> DataFrame:
    """Active real incidents of one date, newest first. `as_of` defaults to today's date;
    pass a 'yyyy-MM-dd' string or a Column (e.g. latest_date(e)). The date predicate is on
    the partition column, so a partitioned table prunes to one directory."""
    if as_of is None:
        day = F.date_format(F.current_date(), "yyyy-MM-dd")
    elif isinstance(as_of, str):
        day = F.lit(as_of)
    else:
        day = as_of
    return (e.filter((F.col("is_active") == F.lit(True)) & (F.col("is_real_incident") == F.lit(True))
                     & (F.col("date") == day))
             .select("id", "vehicle_id", "incidentId", "type", "timestamp", "location", "description")
             .orderBy(F.desc("timestamp"), "id"))


def resolution_rate(e: DataFrame) -> DataFrame:
    """Over real incidents, per type: total, resolved, still active, resolved %."""
    resolved = F.sum(F.when(F.col("status") == rules.RESOLVED, 1).otherwise(0)).cast("bigint")
    active = F.sum(F.when(F.col("status") == rules.ACTIVE, 1).otherwise(0)).cast("bigint")
    return (e.filter(F.col("is_real_incident") == F.lit(True))
             .groupBy(F.col("type").alias("incident_type"))
             .agg(F.count(F.lit(1)).alias("total"), resolved.alias("resolved"), active.alias("still_active"))
             .withColumn("resolution_rate_pct", pct(F.col("resolved"), F.col("total")))
             .orderBy(F.desc("total"), "incident_type"))


def incidents_by_hour_of_day(e: DataFrame) -> DataFrame:
    """Real incidents per (hour of day, type)."""
    return (e.filter(F.col("is_real_incident") == F.lit(True))
             .groupBy(F.hour("timestamp").alias("hour_of_day"), F.col("type").alias("incident_type"))
             .agg(F.count(F.lit(1)).alias("event_count"))
             .orderBy("hour_of_day", F.desc("event_count"), "incident_type"))


def top_incident_vehicles(e: DataFrame, n: int = 20) -> DataFrame:
    """E5: vehicles with the most real incidents (at least one), with their distinct
    incident types joined by ', ' in sorted order. The per-vehicle set is bounded by the
    number of incident types, and merges map-side."""
    return (e.groupBy("vehicle_id")
             .agg(F.count(F.lit(1)).alias("total_incidents"),
                  sum_flag("is_real_incident").alias("real_incidents"),
                  F.array_join(F.array_sort(F.collect_set("type")), ", ").alias("incident_types"))
             .filter(F.col("real_incidents") > 0)
             .orderBy(F.desc("real_incidents"), "vehicle_id")
             .limit(n))


def active_incident_feed(e: DataFrame) -> DataFrame:
    """R2: active incidents whose type is not 'None' (SQL semantics: null type excluded)."""
    return (e.filter((F.col("status") == rules.ACTIVE) & rules.is_real_incident("type"))
             .select("type", "status", "timestamp", "description", "id")
             .orderBy(F.desc("timestamp"), "id")
             .drop("id"))

"""Dashboard datasets: the figures behind each KPI card, chart and table.

Each function takes any refined frame. The dashboard's own scope, the newest 500 rows of
each table, is `latest_rows(...)`; pass its output to scope a dataset to it, or pass the whole table (the default in the query registry). One-row
figures next to row-level data (the mean line, pie shares) are scalar subqueries: computed
once by a small aggregate job and inlined as a literal. The KPI row is three one-row
aggregates pivoted together. No join and no single-partition window is involved.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from roadpulse.functions import rules
from roadpulse.functions.stats import wide_mean

# The columns the dashboard reads, in their natural order.
VEHICLE_COLUMNS = ["timestamp", "speed", "speed_kmh", "make", "model", "fuelType", "is_ev", "hour", "date"]
WEATHER_COLUMNS = ["timestamp", "temperature", "weatherCondition", "precipitation", "windSpeed",
                   "humidity", "airQualityIndex", "heat_index", "aqi_category", "date"]
EMERGENCY_COLUMNS = ["timestamp", "type", "status", "location", "description", "is_active",
                     "is_real_incident", "date"]


def latest(df: DataFrame, cols: list[str], n: int = 500, ts: str = "timestamp", key: str = "id") -> DataFrame:
    """Newest n rows (timestamp desc, id breaks ties) -> TakeOrderedAndProject:
    each task keeps its own top n, the driver merges n x tasks rows."""
    return df.orderBy(F.desc_nulls_last(ts), F.asc(key)).limit(n).select(*cols)


KPI_METRICS = ["avg_speed", "ev_pct", "total_records", "active_incidents", "real_incidents", "avg_temp"]


def kpi_row(v: DataFrame, w: DataFrame, e: DataFrame) -> DataFrame:
    """One row: active incidents (status Active, any type), real incidents, mean speed,
    mean temperature, EV % (over non-null is_ev), vehicle record count; 0 when empty.
    Each table is aggregated once to one row, turned into (metric, value) rows, and the
    three are pivoted into the single KPI row: one scan per table, no join."""
    def long(one_row: DataFrame, names: list[str]) -> DataFrame:
        return one_row.unpivot([], names, "metric", "value")

    vk = v.agg(F.round(wide_mean("speed"), 1).alias("avg_speed"),
               F.round(F.avg(F.col("is_ev").cast("double")) * 100, 1).alias("ev_pct"),
               F.count(F.lit(1)).cast("double").alias("total_records"))
    wk = w.agg(F.round(wide_mean("temperature"), 1).alias("avg_temp"))
    ek = e.agg(F.count_if(F.col("status") == rules.ACTIVE).cast("double").alias("active_incidents"),
               F.count_if(F.col("is_real_incident") == F.lit(True)).cast("double").alias("real_incidents"))
    metrics = (long(vk, ["avg_speed", "ev_pct", "total_records"])
               .unionByName(long(wk, ["avg_temp"]))
               .unionByName(long(ek, ["active_incidents", "real_incidents"])))
    row = metrics.groupBy().pivot("metric", KPI_METRICS).agg(F.first("value"))
    counts = {"total_records", "active_incidents", "real_incidents"}
    return row.select(*[(F.coalesce(F.col(m), F.lit(0.0)).cast("bigint") if m in counts
                         else F.coalesce(F.col(m), F.lit(0.0))).alias(m) for m in KPI_METRICS])


def speed_timeline(v: DataFrame) -> DataFrame:
    """(timestamp, speed) with the overall mean speed beside every point, in time order.
    `id` breaks timestamp ties so the range partitioning of the sort can split a timestamp
    shared by many rows."""
    mean_speed = v.agg(wide_mean("speed")).scalar()
    return v.orderBy("timestamp", "id").select("timestamp", "speed", mean_speed.alias("mean_speed"))


def mean_speed_by_hour(v: DataFrame) -> DataFrame:
    """Mean raw speed per hour (null hours dropped, as a pandas group-by does)."""
    return (v.filter(F.col("hour").isNotNull()).groupBy("hour")
             .agg(wide_mean("speed").alias("speed")).orderBy("hour"))


def value_counts(df: DataFrame, column: str, *, share: bool = False, label: str | None = None) -> DataFrame:
    """Row count per value (nulls dropped), most frequent first; with
    `share`, count / total non-null rows (the pie-chart fraction)."""
    label = label or column
    present = df.filter(F.col(column).isNotNull())
    counts = present.groupBy(F.col(column).alias(label)).agg(F.count(F.lit(1)).alias("count"))
    if share:
        total = present.agg(F.count(F.lit(1))).scalar()
        counts = counts.withColumn("share", F.col("count").cast("double") / total.cast("double"))
    return counts.orderBy(F.desc("count"), label)


def speed_mean_max_by_make(v: DataFrame) -> DataFrame:
    """Mean and max raw speed per make."""
    return (v.filter(F.col("make").isNotNull()).groupBy("make")
             .agg(wide_mean("speed").alias("avg_speed"), F.max("speed").alias("max_speed"))
             .orderBy("make"))


def weather_series(w: DataFrame) -> DataFrame:
    """Temperature and humidity over time (`id` breaks timestamp ties, as in D5)."""
    return w.orderBy("timestamp", "id").select("timestamp", "temperature", "humidity")


def incident_type_counts(e: DataFrame) -> DataFrame:
    """Incidents per type, 'None' excluded."""
    return value_counts(e.filter(rules.not_none_type("type")), "type")


def active_table(e: DataFrame, n: int = 10) -> DataFrame:
    """The n newest active incidents whose type is not 'None' (a null type is kept,
    as the dashboard's pandas comparison keeps it)."""
    return (e.filter((F.col("status") == rules.ACTIVE) & rules.not_none_type("type"))
             .orderBy(F.desc_nulls_last("timestamp"), "id").limit(n)
             .select("timestamp", "type", "status", "description"))


def incident_timeline(e: DataFrame) -> DataFrame:
    """Incidents per (hour bucket, type), 'None' excluded; observed combinations only."""
    return (e.filter(rules.not_none_type("type") & F.col("type").isNotNull()
                     & F.col("timestamp").isNotNull())
             .groupBy(F.date_trunc("hour", "timestamp").alias("timestamp"), "type")
             .agg(F.count(F.lit(1)).alias("count"))
             .orderBy("timestamp", "type"))


def latest_rows(df: DataFrame, n: int = 500, ts: str = "timestamp", key: str = "id") -> DataFrame:
    """The newest n rows with all their columns (top-k per task, merged once)."""
    return df.orderBy(F.desc_nulls_last(ts), F.asc(key)).limit(n)


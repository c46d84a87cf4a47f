"""Catalog side: database, five external partitioned tables, partition discovery, pruned scans.

DDL is generated from the feed registry and runs through spark.sql against whatever
catalog the session uses (in-memory, Hive metastore, ...).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from roadpulse.schemas import FEEDS, PARTITION_COLUMN, table_ddl
from roadpulse.sources import published
from roadpulse.sources.storage import refined_path


def ensure_database(spark: SparkSession, db: str, location: str | None = None) -> None:
    """CREATE DATABASE IF NOT EXISTS (optionally at a shared location)."""
    loc = f" LOCATION '{location}'" if location else ""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS `{db}`{loc}")


def register_tables(spark: SparkSession, db: str, base: str, feeds: tuple[str, ...] = FEEDS,
                    *, strict: bool = False) -> DataFrame:
    """One external Parquet table per refined feed, partitioned by STRING `date`.
    Returns (table, status); with `strict` the first failure raises."""
    status = []
    for feed in feeds:
        try:
            spark.sql(table_ddl(db, feed, refined_path(base, feed)))
            status.append((feed, "created"))
        except Exception as exc:  # one table failing does not stop the others
            if strict:
                raise
            status.append((feed, f"FAIL: {exc}"))
    return spark.createDataFrame(status, "table string, status string")


def register_and_repair(spark: SparkSession, db: str, base: str, feeds: tuple[str, ...] = FEEDS) -> DataFrame:
    """S8 + S9, each table on its own: a table that was created is repaired, and neither step
    failing stops the other tables. Returns (table, status)."""
    status = []
    for row in register_tables(spark, db, base, feeds).collect():
        state = row.status
        if state == "created":
            try:
                repair_partitions(spark, db, row.table)
                if now := published.manifest(spark, refined_path(base, row.table)):
                    register_dates(spark, db, row.table, base, [*now["dates"], *now["gone"]])
            except Exception as exc:
                state = f"FAIL: {exc}"
        status.append((row.table, state))
    return spark.createDataFrame(status, "table string, status string")


def newest_partition(spark: SparkSession, db: str, feed: str) -> str | None:
    """The newest date of a table from the catalog's partition list alone: no file is opened. The
    list has one entry per date."""
    names = [r[0] for r in spark.sql(f"SHOW PARTITIONS `{db}`.`{feed}`").collect()]
    dates = [n.split("=", 1)[1] for n in names if n.startswith(f"{PARTITION_COLUMN}=")]
    return max((d for d in dates if d != "__HIVE_DEFAULT_PARTITION__"), default=None)


def repair_partitions(spark: SparkSession, db: str, feed: str) -> None:
    """Discover partition directories written since the table was created."""
    spark.sql(f"MSCK REPAIR TABLE `{db}`.`{feed}`")


def write_bucketed(df: DataFrame, db: str, feed: str, base: str, *, buckets: int = 64) -> str:
    """A refined feed as a table laid out by its join keys: one file per bucket of (vehicle_id, date),
    sorted by them, so V5 and V6 aggregate and join such tables without an exchange of rows. A
    busy vehicle spreads over its dates; a date filter skips row groups. Returns the table's
    name. Choose `buckets` so that a bucket of the largest feed is a few hundred megabytes."""
    keys, name = ("vehicle_id", PARTITION_COLUMN), f"{feed}_bucketed"
    (df.repartition(buckets, *keys).write.mode("overwrite").format("parquet").option("path", f"{base.rstrip('/')}/bucketed/{feed}")
     .bucketBy(buckets, *keys).sortBy(*keys).saveAsTable(f"`{db}`.`{name}`"))
    return f"`{db}`.`{name}`"


def register_dates(spark: SparkSession, db: str, feed: str, base: str, dates: tuple[str, ...] | list[str]) -> None:
    """S9 for a write's own dates (`Rows.dates`): new ones go to the catalog as one batch of partitions, at
    the folders that hold them now, moved ones get their new location, emptied ones leave. No other
    date is listed; `repair_partitions` is for tables written by someone else."""
    if not dates:
        return
    root, table = refined_path(base, feed), f"`{db}`.`{feed}`"
    now = published.manifest(spark, root)
    known = {r[0].split("=", 1)[1] for r in spark.sql(f"SHOW PARTITIONS {table}").collect()}
    spec = lambda d: f"PARTITION (`{PARTITION_COLUMN}`='{d}')"
    where = {d: published.folder(root, now, PARTITION_COLUMN, d) for d in sorted(dates)}
    for d, path in where.items():
        if path and d in known:
            spark.sql(f"ALTER TABLE {table} {spec(d)} SET LOCATION '{path}'")
    if new := [f"{spec(d)} LOCATION '{path}'" for d, path in where.items() if path and d not in known]:
        spark.sql(f"ALTER TABLE {table} ADD IF NOT EXISTS {' '.join(new)}")
    if gone := [spec(d) for d, path in where.items() if path is None]:
        spark.sql(f"ALTER TABLE {table} DROP IF EXISTS {', '.join(gone)}")
    spark.catalog.refreshTable(table)


def newest_rows(spark: SparkSession, db: str, feed: str, n: int, ts: str = "timestamp", key: str = "id") -> DataFrame:
    """D1-D3 from partitions: the newest n rows (time descending, id breaks ties) of a table. Dates are
    walked from the newest, twice as many at a time, until they hold n rows (counts come from the
    files' footers); only those directories are read. Rows without a time come after all
    others, so their partition is read only if all dates together hold too few."""
    names = [r[0].split("=", 1)[1] for r in spark.sql(f"SHOW PARTITIONS `{db}`.`{feed}`").collect()]
    dates = sorted((d for d in names if d != published.NO_DATE), reverse=True)
    table, held, taken, step = spark.table(f"`{db}`.`{feed}`"), 0, 0, 1
    while held < n and taken < len(dates):
        held += table.filter(F.col(PARTITION_COLUMN).isin(dates[taken:taken + step])).count()
        taken, step = taken + step, step * 2
    rows = table if held < n else table.filter(F.col(PARTITION_COLUMN).isin(dates[:taken]))
    return rows.orderBy(F.desc_nulls_last(ts), F.asc(key)).limit(n)


def scan(spark: SparkSession, db: str, feed: str, dates: list[str] | Column | None = None) -> DataFrame:
    """Table scan restricted to partition dates (PartitionFilters: only matching
    directories are listed and read). `dates` may be a list or a Column expression."""
    df = spark.table(f"`{db}`.`{feed}`")
    if dates is None:
        return df
    if isinstance(dates, Column):
        return df.filter(F.col(PARTITION_COLUMN) == dates)
    return df.filter(F.col(PARTITION_COLUMN).isin(list(dates)))

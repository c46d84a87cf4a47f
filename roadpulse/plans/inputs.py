"""Inputs of every registered plan: the observation table and the feeds Spark derives from it."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import TimestampType

from roadpulse.operators.refine import REFINERS
from roadpulse.session import pin_utc
from roadpulse.sources.feeds import derive_feed


# Observation table schema (declared, so no job reads Parquet footers to infer it).
EVENTS_SCHEMA = ("event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, "
                 "props string")


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    pin_utc(spark)
    return spark.read.schema(EVENTS_SCHEMA).parquet(f"{sf_dir.rstrip('/')}/events.parquet")


def raw(spark: SparkSession, sf_dir: str, feed: str) -> DataFrame:
    return derive_feed(events(spark, sf_dir), feed)


def refined(spark: SparkSession, sf_dir: str, feed: str, **kw) -> DataFrame:
    return REFINERS[feed](raw(spark, sf_dir, feed), **kw)


def comparable(df: DataFrame) -> DataFrame:
    """Timestamps as TIMESTAMP_NTZ (wall clock, UTC) so results compare with zone-less SQL."""
    fields = df.schema.fields
    if not any(isinstance(f.dataType, TimestampType) for f in fields):
        return df
    cols = [F.col(f.name).cast("timestamp_ntz").alias(f.name) if isinstance(f.dataType, TimestampType)
            else F.col(f.name) for f in fields]
    return df.select(*cols)

"""Wire format: (key, value) records whose value is the JSON text of one feed row.

The same decode expression serves batch frames and streaming frames.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from roadpulse.schemas import FEED_SCHEMAS

# Wire timestamp format: ISO-8601 local time with microseconds, no zone.
WIRE_TIMESTAMP_FORMAT = "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"


def encode(df: DataFrame, feed: str, keep: tuple[str, ...] = ()) -> DataFrame:
    """Feed rows -> (key = id, value = JSON). `location` goes on the wire as a JSON array.
    Columns named in `keep` pass through beside the record."""
    cols = []
    for field in FEED_SCHEMAS[feed].fields:
        if field.name == "location":
            cols.append(F.from_json(F.col("location"), "array<double>").alias("location"))
        else:
            cols.append(F.col(field.name))
    value = F.to_json(F.struct(*cols), {"timestampFormat": WIRE_TIMESTAMP_FORMAT})
    return df.select(F.col("id").alias("key"), value.alias("value"), *keep)


def _decoded(df: DataFrame, feed: str, value_col: str = "value"):
    return F.from_json(F.col(value_col).cast("string"), FEED_SCHEMAS[feed])


def decode(df: DataFrame, feed: str, value_col: str = "value") -> DataFrame:
    """Typed parse and flatten. Malformed JSON becomes an all-null row, never an error;
    a field of the wrong type becomes null on its own; unknown fields are ignored."""
    return df.select(_decoded(df, feed, value_col).alias("data")).select("data.*")


def parsed(df: DataFrame, feed: str, value_col: str = "value") -> DataFrame:
    """data (the decoded record), bad (whether it is undecodable) and the undecodable original's key and
    value. A record is undecodable when its id does not come out of the parse."""
    data = df.select(F.col("key"), F.col(value_col).cast("string").alias("value"), _decoded(df, feed, value_col).alias("data"))
    bad = F.col("data.id").isNull()
    return data.select(F.when(bad, F.col("key")).alias("key"), F.when(bad, F.col("value")).alias("value"), "data", bad.alias("bad"))


def parts(records: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(decoded good rows, undecodable originals) of `parsed` records."""
    return records.filter("NOT bad").select("data.*"), records.filter("bad").select("key", "value")


def split_dead_letters(df: DataFrame, feed: str, value_col: str = "value") -> tuple[DataFrame, DataFrame]:
    """(decoded good rows, undecodable originals). A record is undecodable when its id does
    not come out of the parse. Both outputs are filters of one parse, which a caller that reads both
    keeps (`parsed`, `parts`)."""
    return parts(parsed(df, feed, value_col))

"""Small helpers the operators share: table reading, hand-over tables, token cleaning."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from roadpulse.session import scratch_dir, ship_package

#: a word is a run of anything but ASCII white space
SPACE = r"[\x20\x09-\x0D]+"


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    ship_package(spark)
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def written(df: DataFrame, purpose: str) -> DataFrame:
    """`df` written once below the shared checkpoint folder and read back: lineage is cut, a
    lost executor re-reads files instead of recomputing, and later jobs share one result."""
    ship_package(df.sparkSession)
    path = scratch_dir(df.sparkSession, purpose)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def apart(docs: DataFrame, **columns: str) -> DataFrame:
    """The rows of `docs`, each as one struct `__row`, beside the named columns an operator needs: no
    column of the input, whatever its name, can meet one of the operator's. `select("__row.*")`
    gives the input's columns back."""
    return docs.select(F.struct("*").alias("__row"), *[F.col(column).alias(name) for name, column in columns.items()])


def words(text: Column) -> Column:
    """Array of the words of `text` (null: none)."""
    return F.filter(F.split(F.coalesce(text, F.lit("")), SPACE), lambda w: w != "")

"""Refined tables whose dates are replaced in one step.

Below the folder of a refined table:
  date=.../                       what a plain write left
  _versions/v=<label>/date=.../   dates rewritten since
  _ids/v=<label>/bucket=<k>/      the id index: id and the date of its row
  _manifest/<n>.json              which version holds each rewritten date and each bucket of ids

A change writes its folders first, where no reader looks, and then one manifest: that file is the
switch. The newest readable manifest counts, so a run that ends before or within it leaves the old
table, and two writers cannot publish under one number. Spark's readers skip names that begin
with an underscore, so whoever reads the plain folder sees its last whole write.
"""

from __future__ import annotations

import json
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

#: the folder name of rows without a date
NO_DATE = "__HIVE_DEFAULT_PARTITION__"


def _fs(spark: SparkSession, path: str):
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark._jsc.hadoopConfiguration()), where


def _numbers(spark: SparkSession, root: str) -> list[int]:
    fs, where = _fs(spark, f"{root}/_manifest")
    if not fs.exists(where):
        return []
    names = [s.getPath().getName() for s in fs.listStatus(where)]
    return sorted((int(n[:-5]) for n in names if n.endswith(".json") and n[:-5].isdigit()), reverse=True)


def manifest(spark: SparkSession, root: str, number: int | None = None) -> dict | None:
    """The newest readable manifest (or the one of a number): number, dates and ids (folder key ->
    label), gone (dates that hold no row any more), touched (dates that it changed)."""
    for n in _numbers(spark, root) if number is None else [number]:
        lines = spark.read.text(f"{root}/_manifest/{n:010d}.json", wholetext=True).collect()
        try:
            return json.loads(lines[0][0]) | {"number": n}
        except (ValueError, IndexError):
            continue  # its writer was interrupted
    return None


def publish(spark: SparkSession, root: str, before: dict | None, label: str, *, dates: list[str], gone: list[str], buckets: list[int] | None,
            n_buckets: int) -> None:
    """The switch: `dates` and `buckets` of the id index lie in the version `label`, `gone` dates are
    empty, all else is as in `before`. Without `buckets` the id index counts no more."""
    before = before or {"number": 0, "dates": {}, "gone": [], "ids": {}}
    if before["number"] != next((n for n in _numbers(spark, root) if manifest(spark, root, n)), 0):
        raise RuntimeError(f"{root} was changed by another writer; run again")
    after = {
        "dates": {d: v for d, v in before["dates"].items() if d not in gone} | dict.fromkeys(dates, label),
        "gone": sorted(set(before["gone"]) - set(dates) | set(gone)),
        "ids": {} if buckets is None else before["ids"] | {str(b): label for b in buckets},
        "n_buckets": n_buckets, "touched": sorted({*dates, *gone})}
    number = next(iter(_numbers(spark, root)), 0) + 1
    fs, where = _fs(spark, f"{root}/_manifest/{number:010d}.json")
    stream = fs.create(where, False)  # fails if another writer took the number
    try:
        stream.write(bytearray(json.dumps(after).encode()))
    finally:
        stream.close()


def new_label() -> str:
    return uuid.uuid4().hex[:12]


def read(spark: SparkSession, root: str, schema: StructType, partition: str) -> DataFrame:
    """The table as the newest manifest has it."""
    plain = spark.read.schema(schema).parquet(root)
    now = manifest(spark, root)
    if now is None:
        return plain
    left = {d for d in [*now["dates"], *now["gone"]] if d != NO_DATE}
    kept = ~F.coalesce(F.col(partition).isin(sorted(left)), F.lit(False)) if left else F.lit(True)
    if NO_DATE in now["dates"] or NO_DATE in now["gone"]:
        kept = kept & F.col(partition).isNotNull()
    return plain.filter(kept).unionByName(_versions(spark, root, schema, partition, now["dates"])) if now["dates"] else plain.filter(kept)


def _versions(spark: SparkSession, root: str, schema: StructType, partition: str, labels: dict[str, str], area: str = "_versions") -> DataFrame:
    whole = StructType([*schema.fields, StructField("v", StringType())])
    paths = [f"{root}/{area}/v={label}/{partition}={key}" for key, label in sorted(labels.items())]
    return (spark.read.schema(whole).option("basePath", f"{root}/{area}").parquet(*paths)
            .select(*[F.col(f.name) for f in schema.fields]))


def folder(root: str, now: dict | None, partition: str, date: str) -> str | None:
    """Where a date's rows lie; None if it has none any more."""
    if now and date in now["gone"]:
        return None
    label = (now or {"dates": {}})["dates"].get(date)
    return f"{root}/_versions/v={label}/{partition}={date}" if label else f"{root}/{partition}={date}"


def bucket(key: str, n_buckets: int):
    return F.pmod(F.xxhash64(F.coalesce(F.col(key), F.lit(""))), F.lit(n_buckets)).cast("int")


def ids(spark: SparkSession, root: str, now: dict | None, key: str, partition: str, n_buckets: int, wanted: list[int] | None = None) -> DataFrame | None:
    """key, partition, bucket of the id index, of the `wanted` buckets alone; None if there is no index."""
    if not now or not now["ids"] or now["n_buckets"] != n_buckets:
        return None
    labels = {b: label for b, label in now["ids"].items() if wanted is None or int(b) in wanted}
    schema = StructType([StructField(key, StringType()), StructField(partition, StringType())])
    if not labels:
        return spark.createDataFrame([], schema).withColumn("bucket", F.lit(0))
    held = StructType([*schema.fields, StructField("bucket", StringType())])
    return _versions(spark, root, held, "bucket", labels, "_ids").withColumn("bucket", F.col("bucket").cast("int"))

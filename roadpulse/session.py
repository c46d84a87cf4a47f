"""Session construction and the shared scratch folder.

On a cluster the scratch folder is the one the cluster names in ``spark.checkpoint.dir``
(shared storage every executor can reach). Only when nothing is configured, as in tests on
one machine, a local folder is created and registered as the checkpoint directory.
"""

from __future__ import annotations

import io
import os
import tempfile
import uuid
import zipfile
from collections.abc import Callable  # noqa: F401

from pyspark.sql import SparkSession


# Cluster sizing for 100 TB-class inputs: start shuffles wide and let AQE coalesce them to
# ~256 MB partitions (and split skewed ones), read ~256 MB input splits, and broadcast only
# what AQE measures below the threshold at run time.
CLUSTER_CONF = {
    "spark.sql.shuffle.partitions": "8192",
    "spark.sql.adaptive.coalescePartitions.initialPartitionNum": "8192",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "256m",
    "spark.sql.files.maxPartitionBytes": "256m",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "4",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "512m",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "64m",
    # streaming state (dedup ids, windows, join buffers) in RocksDB, not the executor heap
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
}


def build_session(master: str | None = None, *, shuffle_partitions: int | None = None,
                  app_name: str = "roadpulse", extra: dict[str, str] | None = None) -> SparkSession:
    """A session with the settings the engine relies on (UTC, AQE with skew handling, no UI).

    Nothing that was submitted is overridden: without `master` the submitted one holds, and a
    default below is set only where the submission says nothing of that key. Arguments win over
    both. A `local[N]` master gets N shuffle partitions and Spark's in-memory state store (small
    state commits faster in one JVM); any other master gets CLUSTER_CONF."""
    from pyspark import SparkConf, SparkContext

    if master is None:
        SparkContext._ensure_initialized()  # the JVM holds what was submitted; a conf made before it starts is empty
    submitted = SparkConf()  # what spark-submit, its defaults file or PYSPARK_SUBMIT_ARGS set
    given = master or submitted.get("spark.master", None)
    local = (given or "local").startswith("local")
    cores = int(given[6:-1]) if (given or "").startswith("local[") and given[6:-1].isdigit() else os.cpu_count() or 8
    defaults = {
        "spark.ui.enabled": "false",
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.sources.partitionOverwriteMode": "static",
        "spark.sql.streaming.noDataMicroBatches.enabled": "true",
        "spark.sql.streaming.sessionWindow.merge.sessions.in.local.partition": "true",
    }
    defaults |= {"spark.sql.shuffle.partitions": str(cores), "spark.driver.memory": "8g"} if local else CLUSTER_CONF
    builder = SparkSession.builder
    if master:
        builder = builder.master(master)
    if master or not submitted.contains("spark.app.name"):
        builder = builder.appName(app_name)
    for key, value in defaults.items():
        if not submitted.contains(key):
            builder = builder.config(key, value)
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for key, value in (extra or {}).items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def pin_utc(spark: SparkSession) -> None:
    """Feeds carry zone-less wall-clock timestamps; every rule reads them in UTC."""
    if spark.conf.get("spark.sql.session.timeZone") != "UTC":
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def _checkpoint_dir(spark: SparkSession) -> str | None:
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured
    return spark.sparkContext.getCheckpointDir()


def scratch_dir(spark: SparkSession, purpose: str) -> str:
    """A fresh folder below the session's shared checkpoint directory.

    Sets a local checkpoint directory only when the session has none (tests, local runs).
    """
    base = _checkpoint_dir(spark)
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a shared folder (HDFS, object store) on a cluster")
        base = tempfile.mkdtemp(prefix="roadpulse-ckpt-")
        spark.sparkContext.setCheckpointDir(base)
        base = _checkpoint_dir(spark) or base
    return f"{base.rstrip('/')}/roadpulse/{purpose}-{uuid.uuid4().hex[:12]}"


_SHIPPED: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Python workers import this package by name: its sources go to them once per application, so that a
    driver that loaded it from a path needs no PYTHONPATH on the executors. The archive lies in
    the shared scratch folder."""
    app = spark.sparkContext.applicationId
    if app in _SHIPPED:
        return
    here = os.path.dirname(os.path.abspath(__file__))
    packed = io.BytesIO()
    with zipfile.ZipFile(packed, "w", zipfile.ZIP_DEFLATED) as archive:
        for folder, _, names in sorted(os.walk(here)):
            for name in sorted(n for n in names if n.endswith(".py")):
                path = os.path.join(folder, name)
                archive.write(path, os.path.join(os.path.basename(here), os.path.relpath(path, here)))
    where = spark._jvm.org.apache.hadoop.fs.Path(f"{scratch_dir(spark, 'package')}/{os.path.basename(here)}.zip")
    stream = where.getFileSystem(spark._jsc.hadoopConfiguration()).create(where, True)
    try:
        stream.write(bytearray(packed.getvalue()))
    finally:
        stream.close()
    spark.sparkContext.addPyFile(where.toString())
    _SHIPPED.add(app)


def run_concurrently(tasks: dict[str, "Callable[[], object]"], max_workers: int | None = None) -> dict[str, object]:
    """Submit independent Spark jobs from driver threads so their stages share the cluster
    (small jobs fill each other's idle slots; one job's straggler does not idle the rest).
    Returns name -> result, or name -> the exception it raised."""
    from concurrent.futures import ThreadPoolExecutor

    results: dict[str, object] = {}
    with ThreadPoolExecutor(max_workers=max_workers or max(1, len(tasks))) as pool:
        futures = {name: pool.submit(fn) for name, fn in tasks.items()}
        for name, fut in futures.items():
            try:
                results[name] = fut.result()
            except Exception as exc:  # reported to the caller, never swallowed silently
                results[name] = exc
    return results

"""What running streams did: a listener that keeps one row per micro-batch and per end of a query.

The table (STATUS_SCHEMA, appended Parquet) tells which feed processed which batch, how many rows came in, how
far the watermark lies behind the newest event, how many rows the stateful operators dropped as
late, what they hold, and why a query ended. Range-rule rejects that `observed_refine` counts
come with the same events, one row per rule and batch.
"""

from __future__ import annotations

import threading
from collections import deque
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery, StreamingQueryListener

STATUS_SCHEMA = ("feed string, run string, event string, batch bigint, input_rows bigint, dropped_late bigint, state_rows bigint, "
                 "lag_seconds double, batch_ms bigint, error string")
REJECT_SCHEMA = "feed string, batch bigint, rule string, rejected bigint, checked bigint"


def _seconds(text: str | None) -> float | None:
    return datetime.fromisoformat(text.replace("Z", "+00:00")).timestamp() if text else None


def progress_row(feed: str, progress) -> tuple:
    """A STATUS_SCHEMA row of a query's progress."""
    times, operators = progress.eventTime or {}, progress.stateOperators or []
    newest, watermark = _seconds(times.get("max")), _seconds(times.get("watermark"))
    lag = newest - watermark if newest is not None and watermark else None
    return (feed, str(progress.runId), "batch", progress.batchId, progress.numInputRows, sum(o.numRowsDroppedByWatermark for o in operators),
            sum(o.numRowsTotal for o in operators), lag, progress.batchDuration, None)


def reject_rows(progress) -> list[tuple]:
    """REJECT_SCHEMA rows of a progress: a row for each rule of each observed feed."""
    out = []
    for name, seen in (progress.observedMetrics or {}).items():
        if name.startswith("rejects_") and seen is not None:
            counts = seen.asDict()
            out += [(name[len("rejects_"):], progress.batchId, rule, n, counts["checked"]) for rule, n in counts.items() if rule != "checked"]
    return out


class StreamStatus(StreamingQueryListener):
    """Listens to the queries given to `watch` and appends what they report below `path`; rows wait in
    memory until `every` of them are there, or `flush`."""

    def __init__(self, spark: SparkSession, path: str, every: int = 1000):
        self.spark, self.path, self.every = spark, path.rstrip("/"), every
        self.lock, self.feeds, self.rows, self.rejects = threading.Lock(), {}, [], []
        self.early = deque(maxlen=1000)  # told of queries not made known yet; others of the session fall out
        spark.streams.addListener(self)

    def watch(self, query: StreamingQuery, feed: str) -> None:
        with self.lock:
            self.feeds[str(query.id)] = feed
            early = list(self.early)
            self.early.clear()
        for note in early:  # told before the query was made known
            note()

    def _of(self, query_id, note) -> str | None:
        with self.lock:
            feed = self.feeds.get(str(query_id))
            if feed is None:
                self.early.append(note)
        return feed

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        if feed := self._of(event.progress.id, lambda: self.onQueryProgress(event)):
            with self.lock:
                self.rows.append(progress_row(feed, event.progress))
                self.rejects += reject_rows(event.progress)
                full = len(self.rows) >= self.every
            if full:
                self.flush()

    def onQueryTerminated(self, event) -> None:
        if feed := self._of(event.id, lambda: self.onQueryTerminated(event)):
            with self.lock:
                self.rows.append((feed, str(event.runId), "failed" if event.exception else "ended", None, None, None, None, None, None, event.exception))

    def flush(self) -> None:
        with self.lock:
            rows, self.rows, rejects, self.rejects = self.rows, [], self.rejects, []
        for found, schema, name in ((rows, STATUS_SCHEMA, "status"), (rejects, REJECT_SCHEMA, "rejects")):
            if found:
                self.spark.createDataFrame(found, schema).coalesce(1).write.mode("append").parquet(f"{self.path}/{name}")

    def close(self) -> None:
        """After the watched queries have ended: all that was reported is in the table."""
        self.spark._jsc.sc().listenerBus().waitUntilEmpty()
        self.spark.streams.removeListener(self)
        self.flush()

    def status(self) -> DataFrame:
        return self.spark.read.schema(STATUS_SCHEMA).parquet(f"{self.path}/status")

    def rejected(self) -> DataFrame:
        return self.spark.read.schema(REJECT_SCHEMA).parquet(f"{self.path}/rejects")

"""Status, stop and progress history of streaming queries."""

from __future__ import annotations

import json
import threading
from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.listener import StreamingQueryListener

from tidemark.session import scratch

PROGRESS = (
    "query_id string, name string, batch_id bigint, at string, input_rows bigint, "
    "input_rows_per_second double, processed_rows_per_second double, late_rows_dropped bigint"
)


def status(query: StreamingQuery | None) -> dict[str, Any]:
    if query is None:
        return {"status": "No active query"}
    return {
        "id": query.id,
        "status": query.status,
        "is_active": query.isActive,
        "recent_progress": query.lastProgress,
    }


def stop(query: StreamingQuery | None, wait: bool = True) -> None:
    if query is None:
        return
    query.stop()
    if wait:
        query.awaitTermination()


def await_all(queries: list[StreamingQuery], timeout: float | None = None) -> bool:
    """Wait for all queries; when one fails, stop the others and raise its error.

    The queries are polled in turn, so a failure of the last shows at once. With
    a timeout, the answer is whether all of them ended within it.
    """
    import time

    ends = None if timeout is None else time.monotonic() + timeout
    pending = list(queries)
    while pending:
        for query in list(pending):
            try:
                if query.awaitTermination(0.5):
                    pending.remove(query)
            except Exception:
                for other in queries:
                    if other is not query and other.isActive:
                        other.stop()
                raise
        if ends is not None and pending and time.monotonic() > ends:
            return False
    return True


class ProgressLog(StreamingQueryListener):
    """Keeps one small row per micro-batch, of all batches.

    Rows gather in memory and are appended to a table in the shared folder
    whenever there are ``rows_per_file``, so the history is complete however long
    a query runs, and what is written survives the driver.
    """

    def __init__(self, spark: SparkSession, rows_per_file: int = 1000, path: str | None = None):
        self.spark = spark
        self.path = path or scratch(spark, "progress")
        self._rows_per_file = rows_per_file
        self._rows: list[tuple] = []
        self._written = False
        self._lock = threading.RLock()

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        p = json.loads(event.progress.json)
        late = sum(s.get("numRowsDroppedByWatermark", 0) for s in p.get("stateOperators", []))
        row = (
            p["id"], p.get("name"), p["batchId"], p["timestamp"], int(p.get("numInputRows", 0)),
            float(p.get("inputRowsPerSecond", 0.0)), float(p.get("processedRowsPerSecond", 0.0)), late,
        )
        with self._lock:
            self._rows.append(row)
            full = len(self._rows) >= self._rows_per_file
        if full:  # not in the listener's own thread, which must stay free for events
            threading.Thread(target=self.flush, daemon=True).start()

    def flush(self) -> None:
        """Append what is in memory to the table."""
        with self._lock:
            if self._rows:
                self.spark.createDataFrame(self._rows, PROGRESS).coalesce(1).write.mode("append").parquet(self.path)
                self._rows, self._written = [], True

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        pass

    def history(self) -> DataFrame:
        with self._lock:
            recent = self.spark.createDataFrame(list(self._rows), PROGRESS)
            return self.spark.read.schema(PROGRESS).parquet(self.path).union(recent) if self._written else recent


def throughput(history: DataFrame) -> DataFrame:
    """Batches, rows and mean rows per second of each query."""
    from pyspark.sql import functions as F

    return history.groupBy("query_id").agg(
        F.count(F.lit(1)).alias("batches"),
        F.sum("input_rows").alias("input_rows"),
        F.avg("processed_rows_per_second").alias("mean_rows_per_second"),
        F.sum("late_rows_dropped").alias("late_rows_dropped"),
    )

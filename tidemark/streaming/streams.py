"""Structured Streaming sources, sinks and query control.

A stream over a table is a file source with a fixed schema (append-only, so
there is nothing to ignore-changes). Sinks are Parquet with a checkpoint in
the shared folder, which gives exactly-once output across restarts.

``Progress`` keeps one row for each micro-batch of the queries it is shown. It polls the
queries' own reports; a listener would need a callback port into the driver."""

from __future__ import annotations

import time
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery


def read_stream(spark: SparkSession, path: str, schema: T.StructType, fmt: str = "parquet",
                max_files_per_trigger: int | None = None, drop: Sequence[str] = ()) -> DataFrame:
    """File stream source; ``path`` is a folder or a glob. Optional rate
    limit by files per micro-batch; ``drop`` removes columns up front."""
    r = spark.readStream.format(fmt).schema(schema)
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", int(max_files_per_trigger))
    df = r.load(path)
    return df.drop(*drop) if drop else df


def write_stream(df: DataFrame, path: str, checkpoint: str, name: str | None = None,
                 available_now: bool = True, processing_time: str | None = None,
                 partition_by: Sequence[str] = ()) -> StreamingQuery:
    """Append to Parquet with a checkpoint. ``available_now`` processes what
    is there (in rate-limited batches) and stops; else a processing-time
    trigger keeps it running."""
    w = df.writeStream.format("parquet").outputMode("append").option("checkpointLocation", checkpoint)
    if name:
        w = w.queryName(name)
    if partition_by:
        w = w.partitionBy(*partition_by)
    if available_now:
        w = w.trigger(availableNow=True)
    elif processing_time:
        w = w.trigger(processingTime=processing_time)
    return w.start(path)


PROGRESS = "name string, query_id string, run_id string, batch long, at string, n_rows long, rows_per_second double"


class Progress:
    """Micro-batches of streaming queries, as a table.

    ``watch`` takes over what a query has reported since the last call; a query keeps its last
    hundred reports, so call it more often than that many batches pass. With ``path``, rows are
    appended there whenever KEEP of them are held, so the driver holds no more."""

    KEEP = 1000

    def __init__(self, spark: SparkSession, path: str | None = None):
        self.spark, self.path = spark, path
        self.rows: list[tuple] = []
        self.seen: dict[str, int] = {}  # last batch of each run

    def watch(self, query: StreamingQuery) -> int:
        """Number of batches of this run that have been reported."""
        run = str(query.runId)
        for p in query.recentProgress:
            if p["batchId"] > self.seen.get(run, -1) and p["numInputRows"] > 0:
                self.seen[run] = p["batchId"]
                self.rows.append((query.name, str(query.id), run, int(p["batchId"]), p["timestamp"], int(p["numInputRows"]), float(p["processedRowsPerSecond"])))
        if self.path and len(self.rows) >= self.KEEP:
            self.flush()
        return sum(r[2] == run for r in self.rows) if not self.path else self.table().where(F.col("run_id") == run).count()

    def flush(self) -> None:
        if self.path and self.rows:
            self.spark.createDataFrame(self.rows, PROGRESS).coalesce(1).write.mode("append").parquet(self.path)
            self.rows = []

    def table(self) -> DataFrame:
        """One row per batch, in ``PROGRESS`` columns."""
        self.flush()
        if self.path and self.seen:
            return self.spark.read.schema(PROGRESS).parquet(self.path)
        return self.spark.createDataFrame(self.rows, PROGRESS)


def await_batches(query: StreamingQuery, progress: Progress, n: int, timeout: float = 20.0, poll: float = 0.2) -> bool:
    """Wait until a run has reported ``n`` batches; False if it ends or the time passes before."""
    deadline = time.monotonic() + timeout
    while True:
        active = query.isActive
        if progress.watch(query) >= n:
            return True
        if not active or time.monotonic() >= deadline:
            return False
        time.sleep(poll)


def list_streams(spark: SparkSession) -> DataFrame:
    """The active queries: name, query_id, run_id, state (the query's own message), last_batch, n_rows of it."""
    rows = []
    for q in spark.streams.active:  # few: one per running query
        last = q.lastProgress
        rows.append((q.name, str(q.id), str(q.runId), q.status["message"], int(last["batchId"]) if last else None, int(last["numInputRows"]) if last else None))
    return spark.createDataFrame(rows, "name string, query_id string, run_id string, state string, last_batch long, n_rows long")


def run_to_end(query: StreamingQuery, timeout: float | None = None, progress: Progress | None = None) -> StreamingQuery:
    """Wait for an ``availableNow`` query to finish. With ``timeout`` (seconds) it
    is stopped and an error raised if it takes longer; without, a healthy query
    may take as long as it needs (a failed one raises at once). Its batches go to ``progress``."""
    if progress is not None:
        end = None if timeout is None else time.monotonic() + timeout
        while not query.awaitTermination(0.2):
            progress.watch(query)
            if end is not None and time.monotonic() >= end:
                break
        progress.watch(query)
        timeout = None if timeout is None else max(0.0, end - time.monotonic())
    if timeout is None:
        query.awaitTermination()
    elif not query.awaitTermination(timeout):
        query.stop()
        raise TimeoutError(f"stream {query.name or query.id} did not finish within {timeout} s")
    if query.exception() is not None:
        raise RuntimeError(f"stream failed: {query.exception()}")
    return query


def preview_stream(df: DataFrame, name: str, mode: str = "append") -> StreamingQuery:
    """In-memory sink queryable as table ``name``. The memory sink keeps its rows on the
    driver: append mode is for tests and notebooks; "complete" holds the present result of an
    aggregate, as many rows as it has groups."""
    return df.writeStream.format("memory").queryName(name).outputMode(mode).start()


def find_stream(spark: SparkSession, name: str) -> StreamingQuery | None:
    for q in spark.streams.active:
        if q.name == name:
            return q
    return None


def await_stream(spark: SparkSession, name: str, timeout: float = 20.0, poll: float = 5.0) -> StreamingQuery | None:
    """Wait until a stream with this name is active (the list is re-read on
    every poll, so a late start is seen)."""
    deadline = time.monotonic() + timeout
    while True:
        q = find_stream(spark, name)
        if q is not None or time.monotonic() >= deadline:
            return q
        time.sleep(poll)


def stop_stream(spark: SparkSession, name: str) -> bool:
    """Stop the stream with this name only (other streams keep running)."""
    q = find_stream(spark, name)
    if q is None:
        return False
    q.stop()
    return True

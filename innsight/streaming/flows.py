"""Triggered streams: append, split into valid and quarantined rows, keyed upsert, counted violations.

All flows run with ``availableNow``: they take what has arrived since the last
checkpoint and stop. Transformations are the batch ones, so a finished stream equals
the batch result.
"""

from __future__ import annotations

import time
from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQueryListener

from innsight.operators.keys import dedup_latest
from innsight.operators.quality import Rule, keep_valid, observe_warnings, quarantine, warnings
from innsight.sources.storage import remove, write_table

Transform = Callable[[DataFrame], DataFrame]


def stream_source(spark: SparkSession, path: str, schema: T.StructType, glob: str | None = None, files_per_batch: int | None = None) -> DataFrame:
    """Append stream over the Parquet files of a landed table."""
    reader = spark.readStream.schema(schema)
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.parquet(path)


def _finish(query) -> None:
    query.awaitTermination()


def run_silver(stream: DataFrame, transform: Transform, rules: Sequence[Rule], target: str, checkpoint: str) -> None:
    """Cleaned append stream: derive, drop rows that fail a critical rule, write."""
    cleaned = keep_valid(transform(stream), rules)
    _finish(cleaned.writeStream.format("parquet").option("path", target).option("checkpointLocation", checkpoint).trigger(availableNow=True).start())


def _write_batch(df: DataFrame, path: str, batch_id: int) -> None:
    """One folder per batch, overwritten on retry, so a repeated batch leaves no duplicates."""
    df.write.mode("overwrite").parquet(f"{path}/batch_id={batch_id}")


def run_split(
    stream: DataFrame, transform: Transform, rules: Sequence[Rule], reasons: Sequence[tuple[str, str]], fallback: str, valid: str, rejected: str, checkpoint: str
) -> None:
    """Valid rows and quarantined rows from one read of each batch."""

    def both(batch: DataFrame, batch_id: int) -> None:
        batch = batch.persist()
        try:
            _write_batch(keep_valid(transform(batch), rules), valid, batch_id)
            _write_batch(quarantine(batch, rules, reasons, fallback), rejected, batch_id)
        finally:
            batch.unpersist()

    _finish(stream.writeStream.foreachBatch(both).option("checkpointLocation", checkpoint).trigger(availableNow=True).start())


def run_upsert(stream: DataFrame, transform: Transform, keys: Sequence[str], newest_first: Callable[[], list[Column]], target: str, checkpoint: str, reduce_first: bool = False) -> None:
    """Keyed upsert: each batch is reduced to its newest row per key and added as changes.

    A batch costs its own size, whatever the size of the target. :func:`current_rows`
    resolves the newest row per key on read; :func:`compact` folds the changes in.
    ``reduce_first``: ``transform`` works row by row and leaves the columns of key and order as
    they are, so only the rows that stay are transformed and no derived column is shuffled.
    """

    def merge(batch: DataFrame, batch_id: int) -> None:
        newest = lambda df: dedup_latest(df, keys, newest_first())
        _write_batch(transform(newest(batch)) if reduce_first else newest(transform(batch)), f"{target}/changes", batch_id)

    _finish(stream.writeStream.foreachBatch(merge).option("checkpointLocation", checkpoint).trigger(availableNow=True).start())


def _numbers(spark: SparkSession, folder: str, name: str) -> list[int]:
    """Numbers of the sub-folders ``name=<number>``, in order."""
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
    fs = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    names = [s.getPath().getName() for s in fs.listStatus(path)] if fs.exists(path) else []
    return sorted(int(n.split("=", 1)[1]) for n in names if n.startswith(f"{name}="))


def current_rows(spark: SparkSession, target: str, keys: Sequence[str], newest_first: list[Column]) -> DataFrame:
    """Newest row per key; a late row with an older order value does not win.

    The newest base and all changes that are still there are read: a batch that was
    folded in and then written again by a retry only repeats rows of the base.
    """
    bases, batches = _numbers(spark, f"{target}/base", "upto"), _numbers(spark, f"{target}/changes", "batch_id")
    parts = [spark.read.parquet(f"{target}/base/upto={bases[-1]}")] if bases else []
    if batches:
        parts.append(spark.read.parquet(f"{target}/changes").withColumn("batch_id", F.col("batch_id").cast("long")))
    rows = parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1])
    return dedup_latest(rows, keys, [*newest_first, F.desc("batch_id")]).drop("batch_id")


def compact(spark: SparkSession, target: str, keys: Sequence[str], newest_first: list[Column]) -> DataFrame:
    """Fold the changes into a new base with the newest row per key, and give it.

    A base lies apart from the batches and is named after the last batch it holds, so
    no retry of a batch can overwrite it. It is complete before anything is removed.
    """
    batches, bases = _numbers(spark, f"{target}/changes", "batch_id"), _numbers(spark, f"{target}/base", "upto")
    # Only a batch newer than the base, or none: a retried one adds nothing.
    fresh = [b for b in batches if not bases or b > bases[-1]]
    if fresh:
        rows = current_rows(spark, target, keys, newest_first).withColumn("batch_id", F.lit(fresh[-1]).cast("long"))
        write_table(rows, f"{target}/base/upto={fresh[-1]}", rebalance=False)  # one row per key in each task
        for b in bases:
            remove(spark, f"{target}/base/upto={b}")
        for b in batches:
            if b <= fresh[-1]:
                remove(spark, f"{target}/changes/batch_id={b}")
    return current_rows(spark, target, keys, newest_first)


class ViolationLog(StreamingQueryListener):
    """Collects the observed rule counters of every finished batch (one small row each)."""

    def __init__(self, name: str):
        self.name = name
        self.batches: list[dict[str, int]] = []
        self.ended: set[str] = set()

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        self.ended.add(str(event.runId))

    def onQueryProgress(self, event) -> None:
        seen = event.progress.observedMetrics.get(self.name)
        if seen is not None:
            self.batches.append({"batch_id": event.progress.batchId, **seen.asDict()})


def run_with_metrics(stream: DataFrame, transform: Transform, rules: Sequence[Rule], target: str, checkpoint: str, name: str) -> list[dict]:
    """Run the cleaned stream with warning counters; returns the counters per batch."""
    checked = observe_warnings(keep_valid(transform(stream), rules), name, warnings(rules))
    log = ViolationLog(name)
    stream.sparkSession.streams.addListener(log)
    try:
        query = (
            checked.writeStream.format("parquet").queryName(name).option("path", target).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
        )
        _finish(query)
        # Events come in order, the end of the query last; a query keeps only its newest updates itself.
        until = time.time() + 60
        while str(query.runId) not in log.ended:
            if time.time() > until:
                raise TimeoutError("the stream's counters did not arrive")
            time.sleep(0.05)
    finally:
        stream.sparkSession.streams.removeListener(log)
    return log.batches

"""Senders: one that hands rows to tasks, and one that writes to a folder: batches as transactions, annotations and updates as files, each written whole and again in its place."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from datetime import datetime

from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F

from spanlake.operators import spans
from spanlake.sources import sink, writers


class Tasks:
    """A destination that many tasks send to at once: `emit` gets the rows of a task, has sent all of them when it returns, and raises if it hasn't.

    A batch is done when all its tasks are, so nothing of it waits in a buffer when the next one starts. Rows carry their ids: a
    task that runs again sends the same spans under the same ids.
    """

    def __init__(self, emit: Callable[[Iterator[Row]], None], workers: int = 8):
        if not 1 <= workers <= writers.MOST_WORKERS:
            raise ValueError(f"workers must be 1 to {writers.MOST_WORKERS}")
        self.emit, self.workers = emit, workers

    def send(self, batch: DataFrame, day: object, number: int) -> None:
        rows, bad = spans.wide(batch, "evals") if "evals" in batch.columns else spans.wide(batch)
        if not bad.isEmpty():
            raise ValueError(f"{day}: {bad.first().reason}")
        writers.send(rows, self.workers, self.emit)


class Folder:
    """A destination as a folder of Parquet: spans by day and batch, annotations by day, and updates.

    A batch counts once, however often it is sent, so here an uncertain batch is no danger.
    """

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")

    def send(self, batch: DataFrame, day: object, number: int) -> None:
        rows, bad = spans.wide(batch, "evals") if "evals" in batch.columns else spans.wide(batch)
        if not bad.isEmpty():
            raise ValueError(f"{day}: {bad.first().reason}")
        sink.register(self.spark)
        rows.withColumn("day", F.lit(day)).write.format(sink.FORMAT).option("path", f"{self.path}/spans").option("batch", f"{day}-{number}").mode("append").save()

    def readable(self) -> DataFrame:
        """span_id, trace_id and start_time of what has landed."""
        columns = {"span_id": F.col("`context.span_id`"), "trace_id": F.col("`context.trace_id`"), "start_time": F.timestamp_micros((F.col("start_time") / 1000).cast("long"))}
        sink.register(self.spark)
        return self.spark.read.format(sink.FORMAT).load(f"{self.path}/spans").select(*[c.alias(k) for k, c in columns.items()])

    def annotate(self, records: DataFrame, start: datetime, end: datetime) -> None:
        """Annotations of a call; records of one day and chunk that are sent again replace themselves."""
        told = records.withColumns({"window_start": F.lit(start), "window_end": F.lit(end), "day": F.lit(f"{start:%Y%m%d}")})
        told.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("day", "chunk").parquet(f"{self.path}/annotations")

    def update(self, cells: DataFrame) -> None:
        cells.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("day").parquet(f"{self.path}/updates")

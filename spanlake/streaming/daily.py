"""Observations as a stream: daily counts with late rows, ids kept once, and session anchors."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from spanlake.operators import spans


def counts(stream: DataFrame, time: str = "start_time", late: str | None = "1 day") -> DataFrame:
    """day, rows of a stream; a day is final when the watermark has passed it. late: None for a stream that has a watermark."""
    marked = stream.withWatermark(time, late) if late else stream
    windowed = marked.groupBy(F.window(time, "1 day")).agg(F.count(F.lit(1)).alias("rows"))
    return windowed.select(F.col("window.start").cast("date").alias("day"), "rows")


def once(stream: DataFrame, ident: str = "id", time: str = "start_time", late: str = "1 day") -> DataFrame:
    """Rows whose id came within the watermark's reach before are dropped; state is bounded by that reach."""
    return stream.withWatermark(time, late).dropDuplicatesWithinWatermark([ident])


def first_traces(stream: DataFrame) -> DataFrame:
    """session_id, trace_id of the trace that starts a session (ties: the least id), for the update mode: sent again when rows of it come. State is two values a session."""
    rows = stream.where("session_id IS NOT NULL AND start_time IS NOT NULL").select("session_id", "trace_id", "start_time")
    return rows.groupBy("session_id").agg(F.min_by("trace_id", F.struct("start_time", "trace_id")).alias("trace_id"))


def write_spans(stream: DataFrame, target: str, checkpoint: str, once_only: bool = True) -> StreamingQuery:
    """Projects observations to spans and writes them by day. Roots need whole traces and are for the batch plan."""

    def save(batch: DataFrame, _: int) -> None:
        usable, _rejected = spans.split(batch)
        spans.project(usable).withColumn("day", F.to_date("start_time")).write.mode("append").partitionBy("day").parquet(target)

    writer = stream.writeStream.foreachBatch(save).option("checkpointLocation", checkpoint)
    return (writer.trigger(availableNow=True) if once_only else writer).start()

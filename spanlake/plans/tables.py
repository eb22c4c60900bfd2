"""Tables of a target folder: read, replaced by days, and the ledger of batches as a log of events."""

from __future__ import annotations

import uuid
from collections.abc import Iterable
from datetime import date

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from spanlake.operators import batches

#: An event of a batch: what happened, the state after it, and, where the batch was made, its places in the day, its fingerprint and files.
EVENT = "day date, batch long, seq long, event string, status string, start long, end long, rows long, checksum string, files array<string>"


def read_table(spark: SparkSession, path: str) -> DataFrame | None:
    """A table of a target folder; None if it isn't there yet."""
    try:
        return spark.read.parquet(path)
    except AnalysisException as none:
        if none.getCondition() in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            return None
        raise


def drop(spark: SparkSession, path: str) -> None:
    """Deletes a folder of any file system that Spark reads; one that isn't there is no fault."""
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark._jsc.hadoopConfiguration()).delete(where, True)


def replace_days(df: DataFrame, path: str, days: Iterable[date], most: int = 0) -> None:
    """Writes days of a table. Of these days nothing that was there stays, also where df has no rows of a day; other days stay as they are.

    It isn't atomic: what reads the table trusts a day only if the ledger has it, which is written after. most: rows of a file, 0 for no bound.
    """
    for day in days:  # a row a day
        drop(df.sparkSession, f"{path}/day={day}")
    df.write.mode("append").option("maxRecordsPerFile", most).partitionBy("day").parquet(path)


def staged(df: DataFrame, target: str) -> tuple[DataFrame, str]:
    """The rows written to a folder of their own below the target, which the caller drops, so that several plans read them."""
    path = f"{target}/_staged/{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path), path


def read_events(spark: SparkSession, target: str) -> DataFrame | None:
    return read_table(spark, f"{target}/ledger")


def append_events(events: DataFrame, target: str) -> None:
    """Adds events to the log; a file a call and day, and nothing that is there is read or written anew."""
    events.write.mode("append").partitionBy("day").parquet(f"{target}/ledger")


def read_ledger(spark: SparkSession, target: str) -> DataFrame | None:
    """The batches with their states; None before the first."""
    events = read_events(spark, target)
    return None if events is None else batches.states(events)


def make_events(made: DataFrame, events: DataFrame | None) -> DataFrame:
    """Events of batches that were made (day, batch, start, end, rows, checksum, files), after all there are of their days."""
    after = F.lit(0).cast("long")
    if events is not None:
        last = events.groupBy("day").agg((F.max("seq") + 1).alias("_after"))
        made, after = made.join(last, "day", "left"), F.coalesce("_after", F.lit(0).cast("long"))
    return made.select("day", "batch", after.alias("seq"), F.lit("made").alias("event"), F.lit(batches.PENDING).alias("status"), "start", "end", "rows", "checksum", "files")


def withdraw(events: DataFrame, days: DataFrame) -> DataFrame:
    """Events that take all batches of some days back, before these are written anew."""
    own = batches.states(events).join(days, "day", "left_semi").select("day", "batch")
    last = events.groupBy("day").agg((F.max("seq") + 1).alias("seq"))
    none = [F.lit(None).cast(t).alias(c) for c, t in (("start", "long"), ("end", "long"), ("rows", "long"), ("checksum", "string"), ("files", "array<string>"))]
    return own.join(last, "day").select("day", "batch", "seq", F.lit("withdrawn").alias("event"), F.lit(batches.WITHDRAWN).alias("status"), *none)


class Day:
    """The states of one day's batches on the driver, a row a batch, and the events that move them."""

    def __init__(self, spark: SparkSession, target: str, day: date):
        self.spark, self.target, self.day = spark, target, day
        events = read_events(spark, target).where(F.col("day") == F.lit(day))
        self.seq = (events.agg(F.max("seq")).first()[0] or 0) + 1
        self.rows = {r.batch: r.asDict() for r in batches.states(events).collect()}

    def move(self, **events: list[int]) -> None:
        """Appends an event for each of some batches: one file."""
        out = []
        for event, own in events.items():
            for batch in own:
                row = self.rows[batch]
                row["status"] = batches.transition(row["status"], event)
                out.append((self.day, batch, self.seq, event, row["status"], None, None, None, None, None))
                self.seq += 1
        if out:
            append_events(self.spark.createDataFrame(out, EVENT).coalesce(1), self.target)

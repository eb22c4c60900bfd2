"""Sinks: day-partitioned tables, fingerprints, exported files and per-batch senders."""

from __future__ import annotations

import json
import os
import tempfile
from collections.abc import Callable, Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


#: Tasks that a batch is sent by at most.
MOST_WORKERS = 32


class ShardError(Exception):
    """A shard that must not be written or read."""


def duplicate_ids(spans: DataFrame, day: str = "day", ident: str = "span_id") -> DataFrame:
    """day, span_id, copies of ids that a day has more than once, or null ids."""
    return spans.groupBy(day, ident).agg(F.count(F.lit(1)).alias("copies")).where((F.col("copies") > 1) | F.col(ident).isNull())


def refuse_duplicates(spans: DataFrame, day: str = "day", ident: str = "span_id") -> None:
    """Raises if a day has an id more than once, or a null one."""
    bad = duplicate_ids(spans, day, ident).limit(1).collect()
    if bad:
        raise ShardError(f"{bad[0][day]}: span id {bad[0][ident]!r} is missing or repeated")


def write_days(spans: DataFrame, path: str, overwrite: bool = False, day: str = "day", ident: str = "span_id") -> None:
    """Writes spans as Parquet, a folder a day. Missing or repeated ids are refused; existing days are too, unless overwritten, and then only these days are replaced."""
    refuse_duplicates(spans, day, ident)
    spark = spans.sparkSession
    if not overwrite:
        try:
            there = spark.read.parquet(path).select(day).distinct()
        except Exception as none:  # noqa: BLE001  nothing is written yet
            if "PATH_NOT_FOUND" not in str(none) and "UNABLE_TO_INFER_SCHEMA" not in str(none):
                raise
        else:
            if not there.join(spans.select(day).distinct(), day, "left_semi").isEmpty():
                raise ShardError("a day is there already; overwrite it or leave it")
    spans.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(day).parquet(path)


def row_digest(df: DataFrame, *leave: str) -> Column:
    """60 bits of an MD5 over a row's columns by name; nulls, and where a text ends, count."""

    def shown(c: str) -> Column:
        value = F.to_json(F.struct(c)) if df.schema[c].dataType.typeName() in ("map", "struct", "array", "variant") else F.col(c).cast("string")
        return F.when(value.isNull(), "n").otherwise(F.concat(F.length(value).cast("string"), F.lit(":"), value))

    text = F.concat_ws(",", *[shown(c) for c in sorted(df.columns) if c not in leave], F.lit(""))
    return F.conv(F.substring(F.md5(text.cast("binary")), 1, 15), 16, 10).cast("decimal(38,0)")


def fingerprint(df: DataFrame, *by: str) -> DataFrame:
    """Rows and a checksum that doesn't depend on their order, for each value of `by`: the sum of the rows' digests, so that equal rows count each time."""
    return df.groupBy(*by).agg(F.count(F.lit(1)).alias("rows"), F.sum(row_digest(df, *by)).cast("string").alias("checksum"))


def check_fingerprint(df: DataFrame, known: DataFrame, *by: str) -> DataFrame:
    """The values of `by` whose fingerprint isn't the known one, or that only one side has."""
    now = fingerprint(df, *by).withColumnsRenamed({"rows": "rows_now", "checksum": "checksum_now"})
    both = now.join(known, list(by), "full_outer")
    return both.where(~(F.col("rows").eqNullSafe(F.col("rows_now")) & F.col("checksum").eqNullSafe(F.col("checksum_now"))))


def write_json(path: str, content: object) -> None:
    """Writes a small JSON file whole or not at all: a temporary file beside it takes its place."""
    os.makedirs(os.path.dirname(path) or ".", exist_ok=True)
    handle, temp = tempfile.mkstemp(dir=os.path.dirname(path) or ".", suffix=".tmp")
    try:
        with os.fdopen(handle, "w") as out:
            json.dump(content, out, indent=2, default=str)
            out.flush()
            os.fsync(out.fileno())
        os.replace(temp, path)
    finally:
        if os.path.exists(temp):
            os.unlink(temp)


def write_code_files(exports: DataFrame, folder: str) -> int:
    """Writes exported code (file, content), a row a code evaluator, as files of the driver; returns how many."""
    os.makedirs(folder, exist_ok=True)
    n = 0
    for row in exports.select("file", "content").toLocalIterator():
        with open(os.path.join(folder, os.path.basename(row.file)), "w") as out:
            out.write(row.content)
        n += 1
    return n


def send(spans: DataFrame, workers: int, sender: Callable[[Iterable], None]) -> None:
    """Deals spans round to so many tasks and hands each task's rows to the sender (1 to 32 tasks), which has sent all when it returns.

    The rows carry their ids, so a task that runs again sends the same spans under the same ids.
    """
    if not 1 <= workers <= MOST_WORKERS:
        raise ValueError(f"workers must be 1 to {MOST_WORKERS}")
    spans.repartition(workers).foreachPartition(sender)

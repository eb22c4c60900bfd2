"""Small DataFrame helpers that the operators share."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


#: Rows of two numbers up to which such a table is broadcast: 4 MB.
BROADCAST_ROWS = 250_000
#: Rows that a Python task gets at once: texts are long, and a task's memory follows from it.
BATCH_ROWS = 1000


def bound_batches(spark: SparkSession) -> None:
    """Makes Arrow batches small for tables of texts; Spark's own bound is 10,000 rows."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    """One of the test tables, for a query over texts."""
    bound_batches(spark)
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def _shared_folder(spark: SparkSession) -> str:
    """The folder that the session names in spark.checkpoint.dir; only a session without one (a test) gets one of its own."""
    context = spark.sparkContext
    if not context.getCheckpointDir():
        if not context.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        context.setCheckpointDir(tempfile.mkdtemp(prefix="checkpoints-"))
    return context.getCheckpointDir()


def cut(df: DataFrame) -> DataFrame:
    """The rows written to the shared checkpoint folder, so that lost executors cost no recomputation."""
    _shared_folder(df.sparkSession)
    return df.checkpoint(eager=True)


_scopes: list[dict[str, str]] = []


def stored(df: DataFrame) -> DataFrame:
    """The rows as Parquet in the shared checkpoint folder, read back: unlike a checkpoint it has the size that it has, and columns can be pruned."""
    spark = df.sparkSession
    path = f"{_shared_folder(spark)}/table-{uuid.uuid4().hex}"
    df.write.parquet(path)
    if _scopes:
        _scopes[-1][path] = path
    return spark.read.schema(df.schema).parquet(path)


def table(df: DataFrame, rows: int = BROADCAST_ROWS) -> DataFrame:
    """`stored` for tables of ids or links, for loops of joins, which would otherwise multiply estimated sizes without end.

    A table of up to `rows` rows, of a few ids each, is marked for broadcast joins; a larger one isn't.
    """
    out = stored(df)
    return F.broadcast(out) if out.count() <= rows else out


@contextmanager
def scratch(spark: SparkSession) -> Iterator[Callable[[DataFrame], DataFrame]]:
    """Tables stored within are deleted at the end, but for those that a frame given to the yielded function reads; these belong to the scope around, if there is one."""
    own: dict[str, str] = {}
    _scopes.append(own)

    def keep(df: DataFrame) -> DataFrame:
        for name in _names(df):
            for path in [p for p in own if p.endswith(name)]:
                del own[path]
                if len(_scopes) > 1:
                    _scopes[-2][path] = path
        return df

    try:
        yield keep
    finally:
        _scopes.pop()
        for path in own:
            _delete(spark, path)


def _names(df: DataFrame) -> set[str]:
    """The names of the stored tables that a frame reads."""
    return {x for file in df.inputFiles() for x in file.split("/") if x.startswith("table-")}


def _delete(spark: SparkSession, path: str) -> None:
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark._jsc.hadoopConfiguration()).delete(where, True)


def discard(df: DataFrame) -> None:
    """Deletes the stored tables that a frame reads, when nothing needs it any more."""
    for name in _names(df):
        _delete(df.sparkSession, f"{_shared_folder(df.sparkSession)}/{name}")


def text_or_empty(column: str) -> Column:
    return F.coalesce(F.col(column), F.lit(""))


def fresh(df: DataFrame, *names: str) -> list[str]:
    """Column names that df doesn't have, for columns that an operator adds for itself."""
    taken, out = {c.lower() for c in df.columns}, []
    for name in names:
        new = f"_{name}"
        while new.lower() in taken:
            new = f"_{new}"
        taken.add(new.lower())
        out.append(new)
    return out


def with_text_key(df: DataFrame, name: str, *columns: str) -> DataFrame:
    """Adds a key of a row's content: rows with equal keys are copies and get equal results."""
    return df.withColumn(name, F.sha2(F.to_json(F.struct(*[F.col(c) for c in columns])), 256))


__all__ = ["bound_batches", "cut", "discard", "fresh", "read", "scratch", "stored", "table", "text_or_empty", "with_text_key"]

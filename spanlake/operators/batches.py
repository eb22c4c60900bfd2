"""Batches, chunks, the ledger of batches and progress."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from spanlake.operators.numbering import greedy, numbered

#: Rows and bytes at which a batch is closed, and the states of a batch.
BATCH_ROWS, BATCH_BYTES = 10_000, 32 << 20
PENDING, UNCERTAIN, SUBMITTED, WITHDRAWN = "pending", "uncertain", "submitted", "withdrawn"


def by_rows(df: DataFrame, by: str, order: str, rows: int = BATCH_ROWS) -> DataFrame:
    """Adds batch: every `rows` rows of a group are one."""
    return numbered(df, by, order).withColumn("batch", F.floor(F.col("n") / rows).cast("long")).drop("n")


def chunks(df: DataFrame, order: str, size: int) -> DataFrame:
    """Adds chunk: the rows in order, so many a chunk."""
    return numbered(df, None, order).withColumn("chunk", F.floor(F.col("n") / size).cast("long")).drop("n")


def by_bytes(df: DataFrame, by: str, order: str, size: str, rows: int = BATCH_ROWS, limit: int = BATCH_BYTES) -> DataFrame:
    """by, order, batch: a batch closes after the row with which it has `rows` rows or `limit` bytes; a row over the limit may close it alone."""
    return greedy(df, by, order, size, rows, limit)


def round_robin(df: DataFrame, order: str, shards: int, by: str | None = None) -> DataFrame:
    """Adds shard: rows are dealt in turn, within each group if one is given."""
    return numbered(df, by, order).withColumn("shard", (F.col("n") % shards).cast("int")).drop("n")


def batch_table(df: DataFrame, by: str, batch: str = "batch") -> DataFrame:
    """A ledger for batched rows: by, batch, start, end, status pending."""
    sizes = df.groupBy(by, batch).agg(F.count(F.lit(1)).alias("rows"))
    end = F.sum("rows").over(Window.partitionBy(by).orderBy(batch))
    return sizes.select(by, batch, (end - F.col("rows")).alias("start"), end.alias("end"), F.lit(PENDING).alias("status"))


def outcome(stage: Column, status: Column) -> Column:
    """What a failed upload means: prepared nothing sent, rejected (4xx but 408), ambiguous (all else)."""
    return F.when(stage == "prepare", "prepared").when((stage == "bulk") & status.between(400, 499) & (status != 408), "rejected").otherwise("ambiguous")


def outcome_of(stage: str, status: int | None) -> str:
    """The same for one failure on the driver; a failure without a status is ambiguous once something may have left."""
    if stage == "prepare":
        return "prepared"
    return "rejected" if stage == "bulk" and status is not None and 400 <= status <= 499 and status != 408 else "ambiguous"


def transition(status: str, event: str) -> str:
    """The state of a batch after start, success, rejected or prepared (nothing landed), ambiguous, or a decision on it."""
    moves = {
        (PENDING, "start"): UNCERTAIN, (UNCERTAIN, "success"): SUBMITTED, (UNCERTAIN, "rejected"): PENDING, (UNCERTAIN, "prepared"): PENDING, (UNCERTAIN, "ambiguous"): UNCERTAIN,
        (UNCERTAIN, "found"): SUBMITTED, (UNCERTAIN, "absent"): PENDING,
    }
    if (status, event) not in moves:
        raise ValueError(f"a {status} batch can't take {event!r}")
    return moves[status, event]


def states(events: DataFrame, by: str = "day") -> DataFrame:
    """by, batch, start, end, status, rows, checksum, files of each batch from its events: the state after the last one, and what the last one that made it says. Withdrawn batches are none."""
    made = F.max_by(F.struct("start", "end", "rows", "checksum", "files"), F.when(F.col("event") == "made", F.col("seq")))
    last = events.groupBy(by, "batch").agg(made.alias("m"), F.max_by("status", "seq").alias("status"))
    return last.where(F.col("status") != WITHDRAWN).select(by, "batch", "m.start", "m.end", "status", "m.rows", "m.checksum", "m.files")


def progress(ledger: DataFrame, by: str = "day") -> DataFrame:
    """Of each shard: batches, submitted and uncertain ones, spans submitted, and whether it is complete."""
    done = F.col("status") == SUBMITTED
    return ledger.groupBy(by).agg(
        F.count(F.lit(1)).alias("batches"), F.count_if(done).alias("submitted"), F.count_if(F.col("status") == UNCERTAIN).alias("uncertain"),
        F.coalesce(F.sum(F.when(done, F.col("end") - F.col("start"))), F.lit(0)).cast("long").alias("spans_submitted"), F.every(done).alias("complete"),
    )


def overall(shards: DataFrame, by: str = "day") -> DataFrame:
    """One row over all shards: how many, complete ones, spans submitted, and shards with uncertain batches."""
    return shards.agg(F.count(F.lit(1)).alias("shards"), F.count_if("complete").alias("complete"), F.coalesce(F.sum("spans_submitted"), F.lit(0)).cast("long").alias("spans_submitted"), F.count_if(F.col("uncertain") > 0).alias("uncertain_shards"))


def rows_of(rows: DataFrame, ledger: DataFrame, by: str, order: str) -> DataFrame:
    """The rows of the ledger's batches: each batch's range of places in its group, start to end (exclusive).

    Rows and ranges meet by blocks of BATCH_ROWS places, so that a row is compared with the ranges of its block only.
    """
    block = lambda place: F.floor(place / BATCH_ROWS).cast("long")
    ranges = ledger.where(F.col("end") > F.col("start")).select(F.col(by).alias("_by"), "batch", "start", "end", F.explode(F.sequence(block(F.col("start")), block(F.col("end") - 1))).alias("_block"))
    placed = numbered(rows, by, order).withColumn("_at", block(F.col("n")))
    met = placed.join(ranges, (F.col(by) == F.col("_by")) & (F.col("_at") == F.col("_block")))
    return met.where((F.col("n") >= F.col("start")) & (F.col("n") < F.col("end"))).drop("_by", "_block", "_at", "start", "end", "n")


def statistics(spans: DataFrame, by: str = "day") -> DataFrame:
    """Of each shard: spans, distinct traces, first start and last end."""
    per_trace = spans.groupBy(by, "trace_id").agg(F.count(F.lit(1)).alias("n"), F.min("start_time").alias("start"), F.max(F.coalesce("end_time", "start_time")).alias("end"))
    return per_trace.groupBy(by).agg(F.sum("n").alias("spans"), F.count("trace_id").alias("traces"), F.min("start").alias("first_start"), F.max("end").alias("last_end"))


def conflicts(bindings: DataFrame, source: str, project: str) -> DataFrame:
    """Shards that were bound to another source or project: a run that goes on with them would split one history."""
    return bindings.where(~(F.col("source").eqNullSafe(F.lit(source)) & F.col("project").eqNullSafe(F.lit(project))))


def to_send(ledger: DataFrame, by: str = "day") -> DataFrame:
    """Pending batches of shards that have no uncertain one; a shard with one must be resolved first."""
    doubtful = ledger.where(F.col("status") == UNCERTAIN).select(by).distinct()
    return ledger.where(F.col("status") == PENDING).join(doubtful, by, "left_anti")


def days_left(windows: DataFrame, shards: DataFrame) -> DataFrame:
    """Days that no complete shard has."""
    return windows.join(shards.where("complete").select("day"), "day", "left_anti")

"""Whole runs: export days of spans and score cells, load batches under a ledger, verify, apply what was deferred.

A target folder has tables by day: spans with their batch and evaluations, in files of a batch each, cells (what scores fill),
frames (cells that are applied after the spans can be found), and the ledger, a log of what became of each batch; a log of the
cells that were applied; the days that have frames; and one table that binds it to a source and a project. The ledger is
written last: a day without one is exported anew.
"""

from __future__ import annotations

import time
from collections.abc import Callable
from datetime import date, datetime, timedelta

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from spanlake.operators import batches, reconcile, scores, spans
from spanlake.plans import tables
from spanlake.sources import readers, writers
from spanlake.sources.readers import Source

#: Records of annotations handed over at once, and tries of an update.
ANNOTATE_ROWS, TRIES = 1000, 8


class RunError(Exception):
    """A run that must not go on."""


class SendError(Exception):
    """A batch that a sender could not send. stage: prepare (nothing has left), bulk or quick; status: of the answer, if there was one."""

    def __init__(self, stage: str, status: int | None = None, text: str = ""):
        super().__init__(text or f"{stage} {status}")
        self.stage, self.status = stage, status


def preflight(source: Source) -> list[dict]:
    """Checks in order: observations are there, have ids and times, scores can be read. A failed fatal check ends them."""
    out: list[dict] = []
    try:
        observations = source.observations()
        found = observations.agg(F.count(F.lit(1)).alias("rows"), F.count_if(F.col("start_time").isNull() | F.col("trace_id").isNull()).alias("bad")).first()
    except Exception as failed:  # noqa: BLE001  the report says why
        return [{"check": "observations", "ok": False, "fatal": True, "detail": str(failed).splitlines()[0][:160]}]
    out.append({"check": "observations", "ok": found.rows > 0, "fatal": True, "detail": f"{found.rows} rows"})
    if not found.rows:
        return out
    out.append({"check": "usable", "ok": found.bad == 0, "fatal": False, "detail": f"{found.bad} rows without a trace or start"})
    try:
        out.append({"check": "scores", "ok": True, "fatal": False, "detail": f"{source.scores().count()} rows"})
    except Exception as failed:  # noqa: BLE001
        out.append({"check": "scores", "ok": False, "fatal": False, "detail": str(failed).splitlines()[0][:160]})
    return out


def bind(spark: SparkSession, target: str, source: str, project: str) -> None:
    """Binds a target folder to a source and a project. One that is bound to another is refused: a resumed run would split one history."""
    bound = tables.read_table(spark, f"{target}/binding")
    if bound is None:
        spark.createDataFrame([(source, project)], "source string, project string").coalesce(1).write.parquet(f"{target}/binding")
        return
    other = batches.conflicts(bound, source, project).first()
    if other is not None:
        raise RunError(f"the folder belongs to {other.source!r} and {other.project!r}")


def classified_scores(source: Source, chosen: DataFrame, roots: DataFrame) -> DataFrame:
    """The scores of chosen observations' traces and sessions, whenever given, once each; names collide over all scores of the source."""
    everything = source.scores()
    own = readers.scores_about(everything, chosen, chosen)
    return scores.classify(readers.keep_first(own, "id", "at"), roots, everything=everything)


def export(source: Source, target: str, now: datetime, years: int = 2, most_days: int | None = None, overwrite: bool = False, reattach_orphans: bool = False, batch_rows: int = batches.BATCH_ROWS, bulk: bool = True) -> dict[str, DataFrame]:
    """Writes spans, score cells, deferred frames and, last, the ledger of all eligible days that have none yet, in one job over all days.

    With overwrite, days of which no batch has been sent yet are written anew too; their batches are withdrawn first, so a crash
    leaves days without a ledger, which the next run exports. A day with a sent or an uncertain batch is refused. A day that is
    there is else left as it is, to be loaded further. Returns what was written, what was rejected or skipped, and the cells
    whose span isn't there. bulk: the way in, on which evaluations ride with spans.

    Spans are written in the order of their batches, in files of a batch's rows at most, and the ledger says which files a batch
    is in and what its fingerprint is, as read from them: so a batch is read without its day.
    The days' observations and roots are staged, as are spans: each is checked and computed once, and read by columns.
    """
    observations, rejected = spans.split(source.observations())
    observations = spans.by_day(observations)
    windows = readers.day_windows(readers.history_range(readers.daily_counts(observations, "start_time")))
    days = readers.eligible_days(windows, now, years, most_days).select("day")
    spark = observations.sparkSession
    events = tables.read_events(spark, target)
    if events is not None:
        ledger = batches.states(events)
        if not overwrite:
            days = days.join(ledger.select("day").distinct(), "day", "left_anti")
        elif not ledger.where(F.col("status") != batches.PENDING).join(days, "day", "left_semi").isEmpty():
            raise RunError("a batch of these days is sent or uncertain; they can't be written anew")
    listed = [r.day for r in days.collect()]  # a row a day
    days = spark.createDataFrame([(d,) for d in listed], "day date")
    if events is not None and overwrite:
        tables.append_events(tables.withdraw(events, days), target)
        events = tables.read_events(spark, target)
    left = observations.join(days, "day", "left_semi")
    chosen, rows_folder = tables.staged(left, target)
    roots, roots_folder = tables.staged(spans.roots(chosen), target)
    built, folder = tables.staged(spans.assemble(chosen, reattach_orphans=reattach_orphans, tops=roots).withColumn("day", F.to_date("start_time")), target)
    writers.refuse_duplicates(built)
    if not spark.sparkContext.getCheckpointDir():  # numbering writes below it
        spark.sparkContext.setCheckpointDir(f"{target}/_staged")
    batched = batches.by_rows(built.select("day", "span_id"), "day", "span_id", batch_rows)
    anchors = spans.session_anchors(chosen, roots)
    cells = scores.long_columns(classified_scores(source, chosen, roots))
    of_days = lambda name, schema: spark.read.schema(schema).parquet(f"{target}/{name}").join(days, "day", "left_semi")  # noqa: E731  there may be no day
    placed = scores.placed(cells, built, anchors)
    tables.replace_days(placed, f"{target}/cells", listed)
    placed = of_days("cells", placed.schema)
    tables.replace_days(deferred_cells(placed, bulk), f"{target}/frames", listed)
    inline = placed.where("bucket <> 'annotations'").withColumn("target", F.coalesce("anchor", "target"))
    whole = scores.riding(built, inline).join(batched, ["day", "span_id"])
    tables.replace_days(whole.repartitionByRange("day", "batch").sortWithinPartitions("day", "batch", "span_id"), f"{target}/spans", listed, batch_rows)
    written = of_days("spans", whole.schema)
    if listed:
        tables.append_events(tables.make_events(made_batches(spark.read.schema(whole.schema).parquet(f"{target}/spans"), days), events), target)
        days.coalesce(1).write.mode("append").parquet(f"{target}/framed")
    for path in (folder, rows_folder, roots_folder):
        tables.drop(spark, path)
    classified = classified_scores(source, left, spans.roots(left))  # what is returned is read later, without staged rows
    unmatched = scores.long_columns(classified).select("bucket", "target").distinct().join(placed.select("bucket", "target").distinct(), ["bucket", "target"], "left_anti")
    return {"spans": written, "rejected": rejected, "skipped": scores.skipped(classified), "unmatched": unmatched, "cells": spark.read.schema(placed.schema).parquet(f"{target}/cells")}


def made_batches(files: DataFrame, days: DataFrame) -> DataFrame:
    """day, batch, start, end, rows, checksum, files of span files of some days: one scan, summed where the rows are."""
    told = files.select("day", "batch", F.col("_metadata.file_name").alias("_file"), writers.row_digest(files, "day", "batch").alias("_digest"))
    sums = told.join(days, "day", "left_semi").groupBy("day", "batch").agg(F.count(F.lit(1)).alias("rows"), F.sum("_digest").cast("string").alias("checksum"), F.sort_array(F.collect_set("_file")).alias("files"))
    end = F.sum("rows").over(Window.partitionBy("day").orderBy("batch"))
    return sums.select("day", "batch", (end - F.col("rows")).alias("start"), end.alias("end"), "rows", "checksum", "files")


def deferred_cells(placed: DataFrame, bulk: bool) -> DataFrame:
    """Of placed cells those that are applied later, on their span: annotations, and off the bulk path evaluations too."""
    later = F.lit(True) if not bulk else F.col("bucket") == "annotations"
    return placed.where(later).select("bucket", F.coalesce("anchor", "target").alias("target"), "column", "number", "text", "day")


def read_ledger(spark: SparkSession, target: str) -> DataFrame | None:
    return tables.read_ledger(spark, target)


def batch_rows_of(spark: SparkSession, target: str, schema: StructType, day: date, *made: dict) -> DataFrame:
    """The spans of some batches of a day, read from their files alone."""
    paths = sorted({f"{target}/spans/day={day}/{name}" for row in made for name in row["files"]})
    rows = spark.read.option("basePath", f"{target}/spans").schema(schema).parquet(*paths)
    return rows.where(F.col("batch").isin([row["batch"] for row in made]))


def changed_batches(rows: DataFrame, made: list[dict]) -> list[int]:
    """The batches whose rows aren't those that were exported, by number and fingerprint."""
    now = {r.batch: (r.rows, r.checksum) for r in writers.fingerprint(rows.drop("day"), "batch").collect()}  # a row a batch
    return [row["batch"] for row in made if now.get(row["batch"]) != (row["rows"], row["checksum"])]


def load(spark: SparkSession, target: str, send: Callable[[DataFrame, object, int], None], bulk: bool = True, wave: int = 1) -> dict[str, int]:
    """Sends pending batches oldest day first. A batch is marked uncertain before it is sent and submitted after.

    A wave of batches is read once from its own files and compared with its fingerprints; if one differs, nothing of the wave is
    sent and the run ends. So a batch costs its own rows, whatever its day holds. On the bulk path a batch's spans carry their
    evaluations in evals. A day with an uncertain batch is passed over. send(spans of the batch, day, batch) raises SendError
    where it knows what became of the batch: prepared or rejected, the batch is pending again; any other error leaves it
    uncertain. Either ends the day. wave: batches that are marked at once; after a crash all of them are uncertain. The states of
    one day are on the driver at a time, a row a batch.
    """
    ledger = read_ledger(spark, target)
    if ledger is None:
        raise RunError("nothing is exported")
    out = {"sent": 0, "rejected": 0, "uncertain": 0}
    days = [r.day for r in batches.to_send(ledger).select("day").distinct().orderBy("day").toLocalIterator()]
    schema = spark.read.parquet(f"{target}/spans").schema
    for day in days:
        state = tables.Day(spark, target, day)
        open_ = sorted(b for b, row in state.rows.items() if row["status"] == batches.PENDING)
        for at in range(0, len(open_), wave):
            own = open_[at : at + wave]
            made = [state.rows[b] for b in own]
            rows = batch_rows_of(spark, target, schema, day, *made)
            if bad := changed_batches(rows, made):
                raise RunError(f"{day}: batches {bad} aren't what was exported")
            state.move(start=own)
            ended: dict[str, list[int]] = {"success": []}
            for batch, row in zip(own, made, strict=True):
                part = batch_rows_of(spark, target, schema, day, row).drop("batch")
                try:
                    send(part if bulk else part.drop("evals"), day, batch)
                except Exception as failed:  # noqa: BLE001  what is no SendError may have landed
                    event = batches.outcome_of(failed.stage, failed.status) if isinstance(failed, SendError) else "ambiguous"
                    out["uncertain" if event == "ambiguous" else "rejected"] += 1
                    ended[event] = [batch]
                    if later := own[own.index(batch) + 1 :]:  # of this wave nothing more is sent
                        ended["prepared"] = [*ended.get("prepared", []), *later]
                    break
                ended["success"].append(batch)
                out["sent"] += 1
            state.move(**ended)
            if len(ended) > 1:
                break
    return out


def resolve(spark: SparkSession, target: str, day: date, batch: int, landed: bool) -> None:
    """Settles an uncertain batch after a look at what landed."""
    tables.Day(spark, target, day).move(**{"found" if landed else "absent": [batch]})


def verify(spark: SparkSession, target: str, readable: DataFrame, time: str = "start_time") -> DataFrame:
    """Days of which fewer rows can be read back than were submitted."""
    return reconcile.shortfall(reconcile.expected_days(batches.progress(read_ledger(spark, target))), reconcile.rows_by_day(readable, time))


def verify_until(spark: SparkSession, target: str, look: Callable[[], DataFrame], patience: float = 600.0, sleep: Callable[[float], None] = time.sleep) -> list[dict]:
    """`verify` again and again, with waits that double, until no day is short or patience (seconds) ends; the days that are still short, a row a day."""
    waited = 0.0
    for wait in reconcile.delays():
        short = [r.asDict() for r in verify(spark, target, look()).orderBy("day").collect()]
        if not short or waited >= patience:
            return short
        sleep(wait)
        waited += wait
    return []


def status(spark: SparkSession, target: str) -> DataFrame:
    return batches.progress(read_ledger(spark, target))


def verify_total(spark: SparkSession, target: str, readable: int) -> dict[str, int]:
    """Spans submitted, readable and missing, where the destination can tell one number only."""
    expected = batches.overall(batches.progress(read_ledger(spark, target))).first().spans_submitted
    return {"expected": expected, "readable": readable, "missing": max(0, expected - readable)}


def score_plan(spark: SparkSession, target: str) -> DataFrame | None:
    """The deferred cells of all days as one table with what became of them: applied is true for those in the log. None before the first export."""
    frames, log = tables.read_table(spark, f"{target}/frames"), tables.read_table(spark, f"{target}/applied")
    return None if frames is None else scores.plan(frames, log)


def rebuild_frames(source: Source, target: str, bulk: bool = True) -> int:
    """Writes the deferred frames of exported days that have none, from the source; spans and ledger stay as they are. Returns the number of days.

    A day that turned out to have no deferred cells is remembered and not looked at again.
    """
    observations = spans.by_day(spans.split(source.observations())[0])
    spark = observations.sparkSession
    ledger, framed = read_ledger(spark, target), tables.read_table(spark, f"{target}/framed")
    if ledger is None:
        raise RunError("nothing is exported")
    days = ledger.select("day").distinct() if framed is None else scores.without_frames(ledger, framed)
    listed = [r.day for r in days.collect()]  # a row a day
    days = spark.createDataFrame([(d,) for d in listed], "day date")
    written = spark.read.parquet(f"{target}/spans").join(days, "day", "left_semi")
    chosen = observations.join(days, "day", "left_semi")
    roots = spans.roots(chosen)
    placed = scores.placed(scores.long_columns(classified_scores(source, chosen, roots)), written, spans.session_anchors(chosen, roots))
    tables.replace_days(deferred_cells(placed, bulk), f"{target}/frames", listed)
    days.coalesce(1).write.mode("append").parquet(f"{target}/framed")
    return len(listed)


def apply_scores(spark: SparkSession, target: str, annotate: Callable[[DataFrame, datetime, datetime], None], update: Callable[[DataFrame], None], readable: DataFrame, now: datetime, sleep: Callable[[float], None] = time.sleep, rows: int = ANNOTATE_ROWS) -> dict:
    """Applies the deferred cells that aren't applied yet, and logs each one once the call that carried it has returned.

    annotate(records: span_id, values, chunk; start and end of the day's window, an hour wider on both sides) gets the annotations
    of `rows` spans of a day at a time; update(cells) gets the evaluations of a day whose span is readable and recent enough, and
    is tried TRIES times. A call that fails is a problem of its day and chunk; other chunks and days go on, and what they applied
    is never sent again. A crash between a call and its log line repeats that one call. Targets that updates can't reach are
    permanent, reported, and looked at again the next time. Days and chunks are walked through, a row each on the driver.
    """
    frames = tables.read_table(spark, f"{target}/frames")
    if read_ledger(spark, target) is None:
        raise RunError("nothing is exported")
    out = {"days": 0, "annotations": 0, "evaluations": 0, "unmatched": 0, "problems": []}
    if frames is None:
        return out
    log = tables.read_table(spark, f"{target}/applied")
    left, folder = tables.staged(scores.to_apply(frames, log), target)
    notes = left.where("bucket = 'annotations'")
    chunked, chunk_folder = tables.staged(scores.chunked(notes, rows).repartitionByRange("day", "chunk").sortWithinPartitions("day", "chunk"), target)

    def applied(cells: DataFrame, day: date, part: str) -> None:
        cells.select("digest", F.lit(day).alias("day"), F.lit(part).alias("part")).coalesce(1).write.mode("append").parquet(f"{target}/applied")

    def problem(day: date, part: str, failed: Exception) -> None:
        out["problems"].append(f"{day} {part}: {str(failed).splitlines()[0][:160] if str(failed) else type(failed).__name__}")

    out["days"] = left.select("day").distinct().count()
    for r in chunked.groupBy("day", "chunk").agg(F.count_distinct("target").alias("n")).orderBy("day", "chunk").collect():
        own = chunked.where((F.col("day") == F.lit(r.day)) & (F.col("chunk") == r.chunk))
        start = datetime.combine(r.day, datetime.min.time())
        try:
            annotate(scores.annotation_records(own).withColumn("chunk", F.lit(r.chunk)), start - timedelta(hours=1), start + timedelta(hours=25))
        except Exception as failed:  # noqa: BLE001  other chunks go on
            problem(r.day, f"chunk {r.chunk}", failed)
            continue
        applied(own, r.day, f"chunk {r.chunk}")
        out["annotations"] += r.n
    evals = left.where("bucket <> 'annotations'")
    lost = scores.unmatched(evals, readable, F.lit(now))
    out["unmatched"] = lost.count()
    found = evals.join(lost, "target", "left_anti")
    waits = reconcile.delays(first=3.0)
    for r in found.groupBy("day").agg(F.count(F.lit(1)).alias("n")).orderBy("day").collect():
        own = found.where(F.col("day") == F.lit(r.day))
        for attempt in range(TRIES):
            try:
                update(own.drop("digest"))
            except Exception as failed:  # noqa: BLE001  the project may not be there yet
                if attempt == TRIES - 1:
                    problem(r.day, "evaluations", failed)
                else:
                    sleep(next(waits))
            else:
                applied(own, r.day, "evaluations")
                out["evaluations"] += r.n
                break
    for path in (folder, chunk_folder):
        tables.drop(spark, path)
    return out


def run(source: Source, target: str, now: datetime, send: Callable[[DataFrame, object, int], None], look: Callable[[], DataFrame], annotate: Callable[[DataFrame, datetime, datetime], None], update: Callable[[DataFrame], None], *, name: str = "files", project: str = "default", bulk: bool = True, patience: float = 600.0, sleep: Callable[[float], None] = time.sleep, **options) -> dict:
    """Preflight, binding, export, load, verification and deferred scores, in this order; a report of each.

    A failed fatal check ends the run before anything is written; days that stay short end it before scores are applied.
    """
    began, phases = time.monotonic(), {}

    def timed(phase: str, result):
        phases[phase] = time.monotonic() - began - sum(phases.values())
        return result

    checks = timed("preflight", preflight(source))
    report: dict = {"preflight": checks, "ok": False}
    if any(c["fatal"] and not c["ok"] for c in checks):
        return report
    spark = source.observations().sparkSession
    bind(spark, target, name, project)
    done = export(source, target, now, bulk=bulk, **options)
    report["export"] = timed("export", {k: done[k].count() for k in ("spans", "rejected", "skipped", "unmatched")})
    report["load"] = timed("load", load(spark, target, send, bulk))
    report["short"] = timed("verify", verify_until(spark, target, look, patience, sleep))
    if not report["short"]:
        report["scores"] = timed("scores", apply_scores(spark, target, annotate, update, look(), now, sleep))
    report["phases"] = reconcile.phase_shares(phases, report["export"]["spans"])
    report["ok"] = not (report["short"] or report["load"]["uncertain"] or report["load"]["rejected"] or report.get("scores", {}).get("problems"))
    return report

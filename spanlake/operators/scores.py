"""Scores to evaluations and annotations of spans, traces and sessions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from spanlake.functions import ids, names
from spanlake.operators import batches
from spanlake.sources import scratch

GRANULARITY = {"observation": "span", "trace": "trace", "session": "session"}
#: Columns of a wide table of evaluations; further ones share a VARIANT.
MOST_COLUMNS = 200
PREFIX = {"span": "eval", "trace": "trace_eval", "session": "session_eval"}


def number_and_label(data_type: Column, number: Column, text: Column, value: Column | None = None) -> tuple[Column, Column]:
    """A score's number and label. value: the raw value as text where it is no number.

    A category's value is its label; a boolean fills in the half it lacks; what else has neither is labelled by its value.
    """
    kind, raw = F.upper(data_type), value if value is not None else number.cast("string")
    label = F.coalesce(text, F.when((kind == "BOOLEAN") & number.isNotNull(), F.when(number != 0, "true").otherwise("false")), F.when((kind == "CATEGORICAL") | number.isNull(), raw))
    yes = F.lower(F.trim(text)).isin("true", "1", "yes")
    return F.coalesce(number, F.when((kind == "BOOLEAN") & text.isNotNull(), F.when(yes, 1.0).otherwise(0.0))), label


def granularity(kind: Column, subject: Column) -> Column:
    """span, trace or session; null for another kind or no subject."""
    table = F.create_map(*[F.lit(x) for pair in GRANULARITY.items() for x in pair])
    return F.when(subject.isNotNull(), F.try_element_at(table, F.lower(kind)))


def classify(scores: DataFrame, trace_roots: DataFrame, space: ids.Namespaces = ids.DEFAULT, everything: DataFrame | None = None) -> DataFrame:
    """Scores with clean name, number, label, granularity, whether an annotation, target (span or session id) and a reason if there is none.

    Names that turn into one clean name anywhere in the table, or in `everything` if given, collide: all but the least are
    refused, for all days alike.
    """
    number, label = number_and_label(F.col("data_type"), F.col("value_number"), F.col("value_text"))
    level = granularity(F.col("kind"), F.col("subject_id"))
    clean = names.column_name(F.col("name"))
    source = scores if everything is None else everything
    raw = F.regexp_replace("name", r"(?U)\A\s+|\s+\z", "")
    made = scores.withColumns({"clean": clean, "number": number, "label": label, "granularity": level, "annotation": F.coalesce((F.upper("source") == "ANNOTATION") & (level != "session"), F.lit(False)), "_raw": raw})
    named = source.select(clean.alias("clean"), level.alias("level"), raw.alias("_raw")).where("clean IS NOT NULL AND level IS NOT NULL")
    owner = named.groupBy("clean").agg(F.min("_raw").alias("_owner"))
    roots = trace_roots.select(F.col("trace_id").alias("_trace"), F.col("root_id").alias("_root"))
    joined = made.join(owner, "clean", "left").join(roots, (F.col("granularity") == "trace") & (F.col("subject_id") == F.col("_trace")), "left")
    target = F.when(F.col("granularity") == "span", ids.span_id(F.col("subject_id"), space)).when(F.col("granularity") == "trace", F.col("_root")).when(F.col("granularity") == "session", F.col("subject_id"))
    empty = F.col("number").isNull() & F.col("label").isNull() & (F.coalesce("comment", F.lit("")) == "")
    reason = (
        F.when(F.col("kind").isNull() | F.col("subject_id").isNull(), "no subject")
        .when(F.col("granularity").isNull(), "subject kind is not mapped")
        .when(target.isNull(), "trace is not there")
        .when(F.col("clean").isNull(), "name is empty")
        .when(F.col("_raw") != F.col("_owner"), "name collides")
        .when(empty, "no value")
    )
    return joined.withColumn("reason", reason).withColumn("target", target).drop("_raw", "_owner", "_trace", "_root")


def long_columns(classified: DataFrame) -> DataFrame:
    """A row for each cell: bucket (evals, annotations, session_evals), target, column, number, text. The last score of a cell by (at, id) wins."""
    note = F.when(F.col("comment") != "", F.col("comment"))
    prefix = F.when(F.col("annotation"), "annotation").otherwise(F.element_at(F.create_map(*[F.lit(x) for p in PREFIX.items() for x in p]), F.col("granularity")))
    cell = lambda field, number, text: F.struct(F.lit(field).alias("field"), number.cast("double").alias("number"), text.cast("string").alias("text"))
    nothing = F.lit(None)
    human = F.col("annotation")
    cells = F.array(
        cell("score", F.col("number"), nothing), cell("label", nothing, F.col("label")), F.when(~human, cell("explanation", nothing, note)), F.when(human, cell("text", nothing, note)),
        F.when(human, cell("updated_by", nothing, F.col("author"))), F.when(human, cell("updated_at", nothing, F.col("at"))),
    )
    filled = F.filter(cells, lambda c: c.isNotNull() & (c["number"].isNotNull() | c["text"].isNotNull()))
    bucket = F.when(F.col("granularity") == "session", "session_evals").when(human, "annotations").otherwise("evals")
    rows = classified.where("reason IS NULL").select(bucket.alias("bucket"), "target", F.explode(filled).alias("c"), prefix.alias("p"), "clean", F.struct("at", "id").alias("order"))
    return rows.groupBy("bucket", "target", F.concat_ws(".", "p", "clean", "c.field").alias("column")).agg(F.max_by(F.struct("c.number", "c.text"), "order").alias("v")).select("bucket", "target", "column", "v.number", "v.text")


def skipped(classified: DataFrame) -> DataFrame:
    """id, name and reason of the scores that have no place."""
    return classified.where("reason IS NOT NULL").select("id", "name", "reason")


def skipped_by_reason(classified: DataFrame) -> DataFrame:
    """reason, scores: how many scores have no place, by reason; a row of all has the reason null."""
    return skipped(classified).rollup("reason").agg(F.count(F.lit(1)).alias("scores"))


def columns_of(cells: DataFrame) -> DataFrame:
    """bucket, column, targets: the columns that evaluations and annotations fill."""
    return cells.groupBy("bucket", "column").agg(F.count(F.lit(1)).alias("targets"))


def riding(spans: DataFrame, cells: DataFrame) -> DataFrame:
    """Spans with evals, the cells that travel with them: an array of (column, number, text) by column; empty without any."""
    kind = "array<struct<column: string, number: double, text: string>>"
    own = cells.groupBy(F.col("target").alias("span_id")).agg(F.array_sort(F.collect_list(F.struct("column", "number", "text"))).alias("evals"))
    return spans.join(own, "span_id", "left").withColumn("evals", F.coalesce("evals", F.array().cast(kind)))


def placed(cells: DataFrame, spans: DataFrame, anchors: DataFrame) -> DataFrame:
    """Cells with day, that of the span they belong to: session cells go to their anchor, whose id is in anchor (null for other cells). Cells without a span are left out."""
    a = anchors.select(F.col("session_id").alias("_session"), F.col("anchor"))
    joined = cells.join(a, (F.col("bucket") == "session_evals") & (F.col("target") == F.col("_session")), "left").drop("_session")
    days = spans.select(F.col("span_id").alias("_span"), "day")
    return joined.join(days, F.coalesce("anchor", "target") == F.col("_span")).drop("_span")


def pending(frames: DataFrame, applied: DataFrame) -> DataFrame:
    """Deferred cells of days that aren't applied yet, with the window in which their spans are found: the day, an hour wider on both sides."""
    left = frames.join(applied.select("day").distinct(), "day", "left_anti")
    hour = F.expr("INTERVAL 1 HOUR")
    start = F.col("day").cast("timestamp")
    return left.withColumns({"window_start": start - hour, "window_end": start + F.expr("INTERVAL 1 DAY") + hour})


def cell_digest() -> Column:
    """Tells a deferred cell: its day, span and column, and what it says."""
    return F.md5(F.to_json(F.struct("bucket", "target", "column", "number", "text", "day"), {"ignoreNullFields": "false"}).cast("binary"))


def to_apply(frames: DataFrame, log: DataFrame | None) -> DataFrame:
    """Deferred cells that no line of the log (digest) has, with their digest. A cell whose score was changed since counts as new."""
    told = frames.withColumn("digest", cell_digest())
    return told if log is None else told.join(log.select("digest"), "digest", "left_anti")


def plan(frames: DataFrame, log: DataFrame | None) -> DataFrame:
    """Deferred cells with applied: whether a line of the log has them."""
    told = frames.withColumn("digest", cell_digest())
    if log is None:
        return told.drop("digest").withColumn("applied", F.lit(False))
    lines = log.select("digest").distinct().withColumn("_told", F.lit(True))
    return told.join(lines, "digest", "left").withColumn("applied", F.coalesce("_told", F.lit(False))).drop("digest", "_told")


def chunked(cells: DataFrame, rows: int) -> DataFrame:
    """Adds chunk: the cells of so many spans of a day are one, by the span's id. A span's cells are one row while it is numbered, so they are computed once and need no join."""
    rest = [c for c in cells.columns if c not in ("day", "target")]
    own = cells.where("day IS NOT NULL AND target IS NOT NULL").groupBy("day", "target").agg(F.collect_list(F.struct(*rest)).alias("_cells"))
    chunk = F.floor(F.col("n") / rows).cast("long").alias("chunk")
    return batches.numbered(own, "day", "target").select("day", "target", chunk, F.explode("_cells").alias("c")).select("day", "target", *[f"c.`{c}`" for c in rest], "chunk")


def without_frames(shards: DataFrame, frames: DataFrame) -> DataFrame:
    """Days that were exported and have no deferred cells written: those to rebuild."""
    return shards.select("day").distinct().join(frames.select("day").distinct(), "day", "left_anti")


def collisions(scores: DataFrame) -> DataFrame:
    """Clean names that several names turn into."""
    return scores.select(names.column_name(F.col("name")).alias("clean"), "name").distinct().where("clean IS NOT NULL").groupBy("clean").agg(F.count(F.lit(1)).alias("names")).where("names > 1")


def pivot(cells: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Cells of one bucket as a wide table: target and the named columns. Names are given, so nothing is collected."""
    value = lambda c: F.max(F.when(F.col("column") == c, F.coalesce(F.col("number").cast("string"), F.col("text"))))
    return cells.groupBy("target").agg(*[(value(c).try_cast("double") if c.endswith(".score") else value(c)).alias(c) for c in columns])


def wide(cells: DataFrame, most: int = MOST_COLUMNS) -> DataFrame:
    """target, the columns of the cells themselves, and rest: cells of one bucket as a wide table whose columns are found first.

    When this is called, the cells are computed once and written to the shared folder, a row a target. The first look counts
    targets by column; the `most` that most targets have (ties: by name) become columns, scores as numbers, others as text, and
    the driver gets these names only. The second opens each row by itself. What has no column of its own is in rest, a VARIANT
    object by name (null without any), so nothing is lost however many names there are. A target has one cell of a column, as
    `long_columns` gives them.
    """
    told = cells.groupBy("target").agg(F.collect_list(F.struct("column", "number", "text")).alias("_cells"))
    path = scratch.shared(cells.sparkSession, "wide")
    told.write.parquet(path)
    rows = cells.sparkSession.read.schema(told.schema).parquet(path)
    names_ = rows.select("target", F.explode(F.array_distinct(F.transform("_cells", lambda x: x["column"]))).alias("column"))
    found = names_.groupBy("column").agg(F.count("target").alias("n")).orderBy(F.desc("n"), "column").limit(most).select("column").collect()
    own = sorted(r.column for r in found)
    value = lambda x, c: x["number"] if c.endswith(".score") else F.coalesce(x["text"], x["number"].cast("string"))
    of = lambda c: F.array_max(F.transform(F.filter("_cells", lambda x: x["column"] == c), lambda x: value(x, c))).alias(c)
    others = F.array_sort(F.transform(F.filter("_cells", lambda x: ~x["column"].isin(own)), lambda x: F.struct(x["column"].alias("key"), F.struct(x["number"].alias("number"), x["text"].alias("text")).alias("value"))))
    rest = F.when(F.size("_rest") > 0, F.parse_json(F.to_json(F.map_from_entries("_rest"))))
    return rows.select("target", *[of(c) for c in own], others.alias("_rest")).select("target", *[F.col(f"`{c}`") for c in own], rest.alias("rest"))


def attach(spans: DataFrame, cells: DataFrame) -> DataFrame:
    """Cells of evals with the span that each belongs to."""
    return cells.where("bucket = 'evals'").join(spans.select(F.col("span_id").alias("target"), "trace_id", "name", "span_kind"), "target")


def anchored(cells: DataFrame, anchors: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(session cells with their anchor span as target, sessions without an anchor)."""
    of_session = cells.where("bucket = 'session_evals'")
    a = anchors.select(F.col("session_id").alias("target"), "anchor")
    found = of_session.join(a, "target").select("bucket", F.col("anchor").alias("target"), F.col("target").alias("session_id"), "column", "number", "text")
    return found, of_session.join(a, "target", "left_anti").select(F.col("target").alias("session_id")).distinct()


def inline(cells: DataFrame, anchors: DataFrame, bulk: bool) -> DataFrame:
    """Cells that travel with the spans: evals, and on the bulk path session cells on their anchors too."""
    evals = cells.where("bucket = 'evals'")
    return evals.unionByName(anchored(cells, anchors)[0].drop("session_id")) if bulk else evals


def deferred(cells: DataFrame, anchors: DataFrame, bulk: bool) -> DataFrame:
    """Cells that are applied later: annotations, and off the bulk path evals and anchored session cells too."""
    notes = cells.where("bucket = 'annotations'")
    return notes if bulk else notes.unionByName(cells.where("bucket = 'evals'")).unionByName(anchored(cells, anchors)[0].drop("session_id"))


def unmatched(cells: DataFrame, spans: DataFrame, now: Column, days: int = 31) -> DataFrame:
    """Targets that no span started in the last `days` days has."""
    near = spans.where(F.col("start_time") >= now - F.expr(f"INTERVAL {days} DAYS")).select(F.col("span_id").alias("target"))
    return cells.select("target").distinct().join(near, "target", "left_anti")


def annotation_records(cells: DataFrame) -> DataFrame:
    """span_id, values: an array of (name, label, score, text) by name. A lone author becomes the text; what has nothing is left out."""
    parts = cells.where("bucket = 'annotations'").select("target", F.regexp_extract("column", r"\Aannotation\.(.+)\.[^.]+\z", 1).alias("name"), F.regexp_extract("column", r"\.([^.]+)\z", 1).alias("field"), "number", "text")
    of = lambda field, c="text": F.max(F.when(F.col("field") == field, F.col(c)))
    grouped = parts.groupBy("target", "name").agg(of("label").alias("label"), of("score", "number").alias("score"), of("text").alias("given"), of("updated_by").alias("by"), of("updated_at").alias("at"))
    author = F.concat(F.lit("author "), F.col("by"), F.coalesce(F.concat(F.lit(" at "), F.col("at")), F.lit("")))
    rows = grouped.withColumn("text", F.coalesce("given", author)).where("label IS NOT NULL OR score IS NOT NULL OR text IS NOT NULL")
    return rows.groupBy(F.col("target").alias("span_id")).agg(F.array_sort(F.collect_list(F.struct("name", "label", "score", "text"))).alias("values"))

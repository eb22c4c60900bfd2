"""Sources: a registry of readers that give canonical observations, scores and resources as DataFrames."""

from __future__ import annotations

from abc import ABC, abstractmethod
from collections.abc import Callable
from datetime import date, datetime, timedelta

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Canonical columns with their types, and the names they may have in older or newer records.
OBSERVATION = {
    "id": ("string", ("id",)), "trace_id": ("string", ("traceId", "trace_id")), "parent_id": ("string", ("parentObservationId", "parent_id")), "type": ("string", ("type",)), "name": ("string", ("name",)),
    "start_time": ("timestamp", ("startTime", "start_time")), "end_time": ("timestamp", ("endTime", "end_time")), "completion_start": ("timestamp", ("completionStartTime",)),
    "level": ("string", ("level",)), "status_message": ("string", ("statusMessage", "status_message")), "input": ("string", ("input",)), "output": ("string", ("output",)), "metadata": ("string", ("metadata",)),
    "model": ("string", ("model",)), "model_parameters": ("string", ("modelParameters",)), "prompt_name": ("string", ("promptName",)), "prompt_version": ("string", ("promptVersion",)),
    "usage_details": ("map<string,double>", ("usageDetails", "usage_details")), "usage": ("map<string,double>", ("usage",)), "cost_details": ("map<string,double>", ("costDetails",)),
    "session_id": ("string", ("sessionId", "session_id")), "user_id": ("string", ("userId", "user_id")), "tags": ("array<string>", ("tags",)),
}
SCORE = {
    "id": ("string", ("id",)), "name": ("string", ("name",)), "data_type": ("string", ("dataType", "data_type")), "value_number": ("double", ("value", "value_number")), "value_text": ("string", ("stringValue", "string_value", "value_text")),
    "comment": ("string", ("comment",)), "source": ("string", ("source",)), "kind": ("string", ("subject.kind", "kind")), "subject_id": ("string", ("subject.id", "subject_id")), "subject_trace": ("string", ("subject.traceId", "subject_trace")),
    "author": ("string", ("authorUserId", "author")), "at": ("timestamp", ("timestamp", "createdAt", "at")),
    "observation_id": ("string", ("observationId", "observation_id")), "trace_id": ("string", ("traceId", "trace_id")), "session_id": ("string", ("sessionId", "session_id")),
}
#: The canonical shape of each kind of resource.
RESOURCES = {
    "prompts": {"id": ("string", ("id",)), "name": ("string", ("name",)), "version": ("int", ("version",)), "body": ("string", ("prompt", "body")), "kind": ("string", ("type", "kind")), "config": ("string", ("config",)), "labels": ("array<string>", ("labels",)), "message": ("string", ("commitMessage", "message"))},
    "dataset_items": {"id": ("string", ("id",)), "dataset": ("string", ("datasetName", "dataset")), "input": ("string", ("input",)), "expected": ("string", ("expectedOutput", "expected")), "metadata": ("string", ("metadata",)), "status": ("string", ("status",))},
    "score_configs": {"name": ("string", ("name",)), "data_type": ("string", ("dataType", "data_type")), "categories": ("array<struct<label: string, value: double>>", ("categories",)), "low": ("double", ("minValue", "low")), "high": ("double", ("maxValue", "high")), "description": ("string", ("description",))},
    "evaluators": {
        "id": ("string", ("id",)), "name": ("string", ("name",)), "type": ("string", ("type",)), "messages": ("array<struct<role: string, content: string>>", ("messages", "prompt")), "provider": ("string", ("provider", "modelProvider")), "model": ("string", ("model",)), "data_type": ("string", ("dataType", "data_type")),
        "categories": ("array<string>", ("categories",)), "low": ("double", ("minValue", "low")), "high": ("double", ("maxValue", "high")), "value_guidance": ("string", ("scoreGuidance", "value_guidance")), "reason_guidance": ("string", ("reasoningGuidance", "reason_guidance")), "version": ("string", ("version",)),
        "language": ("string", ("sourceCodeLanguage", "language")), "description": ("string", ("description",)), "code": ("string", ("sourceCode", "code")),
    },
    "rules": {"name": ("string", ("name",)), "filter": ("string", ("filter",)), "sampling": ("double", ("sampling",)), "enabled": ("boolean", ("enabled",)), "evaluator_ids": ("array<string>", ("evaluatorIds", "evaluator_ids"))},
}
#: Groups of columns that a scan of observations can be asked for.
FIELD_GROUPS = {"core": ("id", "trace_id", "parent_id", "type", "name", "start_time", "end_time", "completion_start", "level", "status_message", "session_id", "user_id", "tags"), "io": ("input", "output", "metadata"), "model": ("model", "model_parameters", "prompt_name", "prompt_version"), "usage": ("usage_details", "usage", "cost_details")}
#: Where a page of records may hold its list.
LISTS = ("data", "items", "observations", "scores", "results")


def _has(df: DataFrame, path: str) -> bool:
    schema = df.schema
    for part in path.split("."):
        if not hasattr(schema, "fieldNames") or part not in schema.fieldNames():
            return False
        schema = schema[part].dataType
    return True


def canonical(records: DataFrame, shape: dict[str, tuple[str, tuple[str, ...]]]) -> DataFrame:
    """Records of any generation in one shape: each column is the first of its spellings that isn't null, tried into its type.

    Objects and lists where text is wanted become JSON text; columns that no spelling has are null.
    """

    def column(name: str) -> Column:
        kind, spellings = shape[name]
        found = []
        for path in spellings:
            if _has(records, path):
                source = records.select(path).schema[0].dataType.typeName()
                value = F.to_json(path) if kind == "string" and source in ("struct", "array", "map", "variant") else F.col(path)
                found.append(value if source == "map" and kind.startswith("map") else F.from_json(F.to_json(path), kind) if source == "struct" and kind.startswith("map") else value.try_cast(kind))
        return (F.coalesce(*found) if found else F.lit(None).cast(kind)).alias(name)

    return records.select(*map(column, shape))


def flat_subject(scores: DataFrame) -> DataFrame:
    """Scores of the older generation, with flat ids, get kind and subject: session before observation before trace."""
    kind = F.when(F.col("session_id").isNotNull(), "session").when(F.col("observation_id").isNotNull(), "observation").when(F.col("trace_id").isNotNull(), "trace")
    ident = F.coalesce("session_id", "observation_id", "trace_id")
    old = F.col("kind").isNull()
    return scores.withColumns({"subject_id": F.when(old, ident).otherwise(F.col("subject_id")), "subject_trace": F.when(old & F.col("session_id").isNull(), F.col("trace_id")).otherwise(F.col("subject_trace")), "kind": F.lower(F.when(old, kind).otherwise(F.col("kind")))}).drop("observation_id", "trace_id", "session_id")


def records_of(pages: DataFrame) -> DataFrame:
    """The records of pages (a JSON body each): a bare list, or a list under one of five names; what is no object is dropped. A JSON text each."""
    body = F.trim("body")
    found = F.coalesce(F.when(body.startswith("["), body), *[F.get_json_object(body, f"$.{k}") for k in LISTS])
    return pages.select(F.explode(F.from_json(found, "array<string>")).alias("record")).where(F.col("record").startswith("{"))


class Source(ABC):
    """What a source gives. A subclass that lacks a method can't be made."""

    @abstractmethod
    def observations(self, start: datetime | None = None, end: datetime | None = None) -> DataFrame: ...

    @abstractmethod
    def scores(self, start: datetime | None = None, end: datetime | None = None) -> DataFrame: ...

    @abstractmethod
    def resources(self, kind: str) -> DataFrame: ...


class Files(Source):
    """Records as Parquet or JSON files in a folder: observations, scores, and a folder for each kind of resource."""

    def __init__(self, spark: SparkSession, folder: str, form: str = "parquet"):
        if form not in ("parquet", "json", "orc"):
            raise ValueError(f"no form {form!r}; there are parquet, json and orc")
        self.spark, self.folder, self.form = spark, folder.rstrip("/"), form

    def _read(self, name: str) -> DataFrame:
        return self.spark.read.format(self.form).load(f"{self.folder}/{name}")

    def observations(self, start: datetime | None = None, end: datetime | None = None, fields: tuple[str, ...] = tuple(FIELD_GROUPS), extra: Column | None = None) -> DataFrame:
        """Observations that start in a window, with the columns of some field groups, and for which an extra condition holds."""
        rows = in_window(canonical(self._read("observations"), OBSERVATION), "start_time", start, end)
        return projected(rows if extra is None else rows.where(extra), fields)

    def scores(self, start: datetime | None = None, end: datetime | None = None) -> DataFrame:
        return in_window(flat_subject(canonical(self._read("scores"), SCORE)), "at", start, end)

    def resources(self, kind: str) -> DataFrame:
        """Resources of a kind in its canonical shape; kinds without one as they are."""
        return canonical(self._read(kind), RESOURCES[kind]) if kind in RESOURCES else self._read(kind)


_SOURCES: dict[str, Callable[..., Source]] = {"files": Files}


def register(mode: str, make: Callable[..., Source]) -> None:
    """Adds a source under a name."""
    _SOURCES[mode] = make


def source(mode: str, *args, **options) -> Source:
    """The source of that name; an unknown one is an error that names those there are."""
    if mode not in _SOURCES:
        raise ValueError(f"no source {mode!r}; there are {', '.join(sorted(_SOURCES))}")
    return _SOURCES[mode](*args, **options)


def in_window(df: DataFrame, time: str, start: datetime | None, end: datetime | None) -> DataFrame:
    """Rows with start <= time < end; an open side has no bound. The filters reach the scan."""
    if start is not None:
        df = df.where(F.col(time) >= F.lit(start))
    return df if end is None else df.where(F.col(time) < F.lit(end))


def projected(rows: DataFrame, fields: tuple[str, ...]) -> DataFrame:
    """The columns of some field groups (core always)."""
    wanted = {c for group in ("core", *fields) for c in FIELD_GROUPS[group]}
    return rows.select(*[c for c in rows.columns if c in wanted])


def scores_of(scores: DataFrame, keys: DataFrame, kind: str, key: str) -> DataFrame:
    """Scores whose subject of that kind (trace, session) is among keys, whenever they were given."""
    column = "subject_trace" if kind == "trace" else "subject_id"
    chosen = keys.select(F.col(key).alias(column)).distinct()
    of_kind = scores if kind == "trace" else scores.where(F.col("kind") == kind)
    return of_kind.join(chosen, column, "left_semi").select(*scores.columns)


def scores_about(scores: DataFrame, traces: DataFrame, sessions: DataFrame) -> DataFrame:
    """Scores of some traces (trace_id) and of some sessions (session_id), whenever they were given: the scores are read once, and meet both under one key."""
    keys = traces.select(F.concat(F.lit("t"), "trace_id").alias("_key")).unionByName(sessions.select(F.concat(F.lit("s"), "session_id").alias("_key"))).where("_key IS NOT NULL").distinct()
    own = F.array_compact(F.array(F.concat(F.lit("t"), "subject_trace"), F.when(F.col("kind") == "session", F.concat(F.lit("s"), "subject_id"))))
    return scores.withColumn("_key", F.explode(own)).join(keys, "_key", "left_semi").select(*scores.columns)


def keep_first(df: DataFrame, key: str, *order: str) -> DataFrame:
    """One row of each key, the first in that order; rows with a null key all stay.

    Tasks keep the first row of each key that they meet, so copies are not gathered to be sorted.
    """
    first = df.where(F.col(key).isNotNull()).groupBy(F.col(key).alias("_key")).agg(F.min_by(F.struct(*[F.col(c) for c in df.columns]), F.struct(*order)).alias("_row")).select("_row.*")
    return first.unionByName(df.where(F.col(key).isNull()))


def daily_counts(df: DataFrame, time: str) -> DataFrame:
    """day, rows; rows without a time are left out."""
    return df.where(F.col(time).isNotNull()).groupBy(F.to_date(time).alias("day")).agg(F.count(F.lit(1)).alias("rows"))


def summed_counts(partial: DataFrame) -> DataFrame:
    """day, rows from counts of overlapping or cut looks (day, rows): what several looks have of one day is added up."""
    return partial.groupBy("day").agg(F.sum("rows").cast("long").alias("rows"))


def counted_in_chunks(df: DataFrame, time: str, first: date, last: date, days: int = 60) -> DataFrame:
    """`daily_counts` look by look over ranges of so many days, as a source that limits ranges gives them."""
    looks = [daily_counts(in_window(df, time, datetime.combine(a, datetime.min.time()), datetime.combine(b, datetime.min.time())), time) for a, b in chunks_of_days(first, last, days)]
    out = looks[0]
    for look in looks[1:]:
        out = out.unionByName(look)
    return summed_counts(out)


def history_range(counts: DataFrame) -> DataFrame:
    """One row: earliest and latest day with rows, how many such days, and all rows. Null days where nothing is found."""
    return counts.where("rows > 0").agg(F.min("day").alias("earliest"), F.max("day").alias("latest"), F.count(F.lit(1)).alias("populated_days"), F.coalesce(F.sum("rows"), F.lit(0)).cast("long").alias("total"))


def day_windows(ranges: DataFrame, earliest: str = "earliest", latest: str = "latest") -> DataFrame:
    """day, start, end (exclusive) of each UTC day from earliest to latest, both in."""
    days = ranges.where(F.col(earliest).isNotNull()).select(F.explode(F.sequence(F.to_date(earliest), F.to_date(latest))).alias("day"))
    return days.select("day", F.col("day").cast("timestamp").alias("start"), F.date_add("day", 1).cast("timestamp").alias("end"))


def eligible_days(windows: DataFrame, now: datetime, years: int, most: int | None = None) -> DataFrame:
    """Windows that end after now less 365 days a year; with `most`, the oldest so many."""
    kept = windows.where(F.col("end") > F.lit(now - timedelta(days=365 * years)))
    return kept if most is None else kept.orderBy("day").limit(most)


def chunks_of_days(first: date, last: date, days: int = 60) -> list[tuple[date, date]]:
    """Half-open ranges of so many days that cover first to last."""
    out, at, stop = [], first, last + timedelta(days=1)
    while at < stop:
        out.append((at, min(stop, at + timedelta(days=days))))
        at = out[-1][1]
    return out

"""The test tables as canonical observations, scores and ledgers, so that queries have something to read."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

#: Batches of the ledger made from observations.
LEDGER_BATCH = 100


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def observations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as observations: a trace is a user's day; some traces have no root, some several."""
    events = table(spark, sf_dir, "events")
    trace = F.concat(F.lit("u"), F.col("user_id").cast("string"), F.lit("-"), F.date_format("ts", "yyyyMMdd"))
    first = Window.partitionBy("trace_id").orderBy("ts", "event_id")
    head = F.first("event_id").over(first)
    kinds = {"view": "SPAN", "click": "TOOL", "purchase": "GENERATION", "signup": "EVENT", "error": "SPAN"}
    kind = F.element_at(F.create_map(*[F.lit(x) for p in kinds.items() for x in p]), F.col("event_type"))
    made = events.withColumn("trace_id", trace).withColumn("_rn", F.row_number().over(first)).withColumn("_head", head)
    parent = (
        F.when((F.col("_rn") == 1) & (F.col("_head") % 11 == 0), F.concat(F.lit("missing-"), F.col("_head").cast("string")))
        .when((F.col("_rn") == 1) | (F.col("event_id") % 7 == 0), None)
        .otherwise(F.concat(F.lit("e"), F.col("_head").cast("string")))
    )
    start = F.col("ts").cast("timestamp")
    tokens = F.get_json_object("props", "$.k").cast("double")
    return made.select(
        F.concat(F.lit("e"), F.col("event_id").cast("string")).alias("id"), "trace_id", parent.alias("parent_id"), kind.alias("type"), F.col("event_type").alias("name"),
        start.alias("start_time"), F.timestamp_add("SECOND", F.floor("value").cast("int"), start).alias("end_time"),
        F.when(F.col("event_type") == "error", "ERROR").otherwise("DEFAULT").alias("level"), F.col("props").alias("metadata"), F.create_map(F.lit("input"), tokens).alias("usage_details"),
        F.concat(F.lit("s"), F.col("user_id").cast("string")).alias("session_id"), F.col("user_id").cast("string").alias("user_id"), F.col("event_id").alias("seq"),
    )


def chats(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Conversation turns as observations: id, trace_id, parent_id, type, input and output text, role."""
    turns = table(spark, sf_dir, "conversations")
    said = F.col("role") == "assistant"
    return turns.select(
        F.concat_ws("-", "conv_id", "turn").alias("id"), F.col("conv_id").cast("string").alias("trace_id"), F.when(F.col("turn") > 0, F.concat(F.col("conv_id").cast("string"), F.lit("-0"))).alias("parent_id"),
        F.when(said, "GENERATION").otherwise("SPAN").alias("type"), F.when(~said, F.col("text")).alias("input"), F.when(said, F.col("text")).alias("output"), "role", "turn", "conv_id", "text",
    )


def scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Labels and events as scores of every kind: id, name, data_type, value_number, value_text, comment, source, kind, subject_id, subject_trace, author, at."""
    obs = observations(spark, sf_dir)
    labels = table(spark, sf_dir, "labels").join(obs.select(F.col("seq").alias("doc_id"), "trace_id", "session_id"), "doc_id", "left")
    unit = F.col("doc_id") % 3
    kind = F.when(unit == 0, "trace").when(unit == 1, "session").otherwise("dataset_run")
    subject = F.when(unit == 0, F.col("trace_id")).when(unit == 1, F.col("session_id")).otherwise(F.concat(F.lit("r"), F.col("doc_id").cast("string")))
    at = F.lit(0).cast("long")
    null = F.lit(None).cast("string")
    common = [F.lit("API").alias("source"), kind.alias("kind"), subject.alias("subject_id"), F.when(unit == 0, F.col("trace_id")).alias("subject_trace"), null.alias("author"), (F.col("doc_id") + at).alias("at")]
    quality = labels.select(F.concat(F.lit("q"), F.col("doc_id").cast("string")).alias("id"), F.lit("quality").alias("name"), F.lit("NUMERIC").alias("data_type"), F.col("quality").cast("double").alias("value_number"), null.alias("value_text"), null.alias("comment"), *common)
    toxic = labels.select(F.concat(F.lit("t"), F.col("doc_id").cast("string")).alias("id"), F.lit("is.toxic").alias("name"), F.lit("BOOLEAN").alias("data_type"), F.col("toxic").cast("double").alias("value_number"), null.alias("value_text"), F.when(F.col("toxic") == 1, "flagged").alias("comment"), *common)
    human = F.col("seq") % 5 == 0
    typed = obs.select(
        F.concat(F.lit("c"), F.col("seq").cast("string")).alias("id"), F.when(F.col("seq") % 2 == 0, "event-type").otherwise("event.type").alias("name"), F.lit("CATEGORICAL").alias("data_type"), F.lit(None).cast("double").alias("value_number"), F.col("name").alias("value_text"),
        F.when(F.col("level") == "ERROR", "failed").alias("comment"), F.when(human, "ANNOTATION").otherwise("EVAL").alias("source"), F.lit("observation").alias("kind"), F.col("id").alias("subject_id"), F.col("trace_id").alias("subject_trace"), F.when(human, F.col("user_id")).alias("author"), F.col("seq").alias("at"),
    )
    return quality.unionByName(toxic).unionByName(typed)


def ledger(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Batches of 100 spans of each day: day, batch, start, end, status. Every fourth day of a month has uncertain ones."""
    obs = observations(spark, sf_dir).select(F.to_date("start_time").alias("day"), "seq")
    numbered = obs.withColumn("n", F.row_number().over(Window.partitionBy("day").orderBy("seq")) - 1)
    batches = numbered.groupBy("day", F.floor(F.col("n") / LEDGER_BATCH).cast("long").alias("batch")).agg(F.min("n").cast("long").alias("start"), (F.max("n") + 1).cast("long").alias("end"))
    unit = F.col("batch") % 3
    status = F.when(unit == 2, "submitted").when((unit == 1) & (F.dayofmonth("day") % 4 == 0), "uncertain").otherwise("pending")
    return batches.withColumn("status", status)

"""Queries over single records: sources, functions, and what is refused."""

from __future__ import annotations

from datetime import date, datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from spanlake.catalog import _KIND, _OBS, _SPAN, _obs, query
from spanlake.functions import names, prompts, values
from spanlake.operators import batches, reconcile, resources, spans
from spanlake.sources import fixtures, readers


@query(f"""WITH {_OBS} SELECT id, name, metadata FROM obs
WHERE start_time >= TIMESTAMP '2024-01-05 00:00:00' AND start_time < TIMESTAMP '2024-01-12 00:00:00' AND type <> 'TOOL'""")
def windowed_observations(spark: SparkSession, d: str) -> DataFrame:
    """A scan of a half-open window with two field groups and a further condition."""
    rows = readers.in_window(_obs(spark, d), "start_time", datetime(2024, 1, 5), datetime(2024, 1, 12))
    return readers.projected(rows.where("type <> 'TOOL'"), ("io",)).select("id", "name", "metadata")


@query("""SELECT '{"id":' || event_id || '}' AS record FROM events WHERE event_id % 5 < 3
UNION ALL SELECT '{"id":0}' FROM events WHERE event_id % 5 = 2""")
def page_records(spark: SparkSession, d: str) -> DataFrame:
    """Records of page bodies of several shapes; what is no object is dropped."""
    own = F.concat(F.lit('{"id":'), F.col("event_id").cast("string"), F.lit("}"))
    unit = F.col("event_id") % 5
    body = (
        F.when(unit == 0, F.concat(F.lit('{"data":['), own, F.lit(",3]}")))
        .when(unit == 1, F.concat(F.lit(" ["), own, F.lit("] ")))
        .when(unit == 2, F.concat(F.lit('{"scores":['), own, F.lit(',{"id":0}]}')))
        .when(unit == 3, F.lit('{"meta":1}'))
        .otherwise('{"results":[]}')
    )
    return readers.records_of(fixtures.table(spark, d, "events").select(body.alias("body")))


@query(f"""WITH {_OBS} SELECT id, CASE WHEN seq % 13 = 0 THEN 'no trace id' WHEN seq % 17 = 0 THEN 'no start time' ELSE 'metadata uses a reserved key' END AS reason
FROM obs WHERE seq % 13 = 0 OR seq % 17 = 0 OR seq % 19 = 0""")
def rejected_rows(spark: SparkSession, d: str) -> DataFrame:
    """Observations that can't be spans, each with the first reason."""
    every = lambda n: F.col("seq") % n == 0
    broken = _obs(spark, d).withColumns({
        "trace_id": F.when(~every(13), F.col("trace_id")).otherwise(F.when(every(2), "")), "start_time": F.when(~every(17), F.col("start_time")),
        "metadata": F.when(every(19), '{"provenance":{}}').otherwise(F.col("metadata")),
    })
    return spans.split(broken)[1].select("id", "reason")


@query(f"""WITH {_OBS} SELECT 'import' AS source, 'observation' AS record_kind, id AS original_id, trace_id AS original_trace_id, parent_id AS original_parent_id,
type AS original_type, level FROM obs""")
def provenance_fields(spark: SparkSession, d: str) -> DataFrame:
    record = {"id": F.col("id"), "trace_id": F.col("trace_id"), "parent_id": F.col("parent_id"), "type": F.col("type")}
    return _obs(spark, d).select(values.provenance(record, "observation", extra={"level": F.col("level")}).alias("p")).select("p.*")


@query("""WITH c AS (SELECT conv_id, turn, role, text FROM conversations)
SELECT conv_id, turn, 'in.0.message.role' AS name, role AS leaf FROM c UNION ALL SELECT conv_id, turn, 'in.0.message.content', text FROM c WHERE text IS NOT NULL
UNION ALL SELECT conv_id, turn, 'in.1.message.role', 'assistant' FROM c UNION ALL SELECT conv_id, turn, 'in.1.message.tool_calls.0.tool_call.id', 't' || turn FROM c
UNION ALL SELECT conv_id, turn, 'in.1.message.tool_calls.0.tool_call.function.name', 'f' FROM c
UNION ALL SELECT conv_id, turn, 'in.1.message.tool_calls.0.tool_call.function.arguments', '{}' FROM c""")
def message_attributes(spark: SparkSession, d: str) -> DataFrame:
    """Messages with a tool call under flat indexed names."""
    call = F.struct(F.concat(F.lit("t"), F.col("turn").cast("string")).alias("id"), F.struct(F.lit("f").alias("name"), F.lit("{}").alias("arguments")).alias("function"))
    of = "array<struct<id: string, function: struct<name: string, arguments: string>>>"
    first = F.struct("role", F.col("text").alias("content"), F.lit(None).cast(of).alias("tool_calls"))
    second = F.struct(F.lit("assistant").alias("role"), F.lit(None).cast("string").alias("content"), F.array(call).cast(of).alias("tool_calls"))
    chat = F.to_json(F.struct(F.array(first, second).alias("messages")))
    turns = fixtures.table(spark, d, "conversations").select("conv_id", "turn", chat.alias("input"))
    return turns.select("conv_id", "turn", F.explode(values.message_columns("in", values.messages(F.col("input")))).alias("name", "leaf"))


@query("""SELECT conv_id, turn, p.place, CASE p.place WHEN 0 THEN role WHEN 2 THEN 'x' END AS role
FROM conversations, (SELECT unnest([0, 1, 2])::INTEGER AS place) p""")
def folded_messages(spark: SparkSession, d: str) -> DataFrame:
    """Flat indexed names as a list again, with an empty place where an index is missing."""
    flat = F.create_map(F.lit("m.0.role"), F.col("role"), F.lit("m.2.role"), F.lit("x"), F.lit("n.9.role"), F.lit("y"))
    t = fixtures.table(spark, d, "conversations")
    return t.select("conv_id", "turn", F.posexplode(values.fold_indexed(flat, "m")).alias("place", "m")).select("conv_id", "turn", "place", F.try_element_at("m", F.lit("role")).alias("role"))


@query(f"""WITH {_OBS}, t AS (SELECT trace_id, min(seq) AS m FROM obs GROUP BY trace_id)
SELECT id, CASE WHEN seq % 2 = 0 THEN session_id ELSE 'ts' || m END AS session_id, user_id, CASE WHEN m % 2 = 0 THEN 't' WHEN seq % 3 = 0 THEN 'o' END AS tag FROM obs JOIN t USING (trace_id)""")
def trace_fields(spark: SparkSession, d: str) -> DataFrame:
    """Session, user and tags from a row and its trace."""
    o = _obs(spark, d)
    traces = o.groupBy(F.col("trace_id").alias("id")).agg(F.min("seq").alias("m")).select(
        "id", F.concat(F.lit("ts"), F.col("m").cast("string")).alias("session_id"), F.lit(None).cast("string").alias("user_id"), F.when(F.col("m") % 2 == 0, F.array(F.lit("t"))).otherwise(F.array().cast("array<string>")).alias("tags"),
    )
    rows = o.withColumns({"session_id": F.when(F.col("seq") % 2 == 0, F.col("session_id")), "tags": F.when(F.col("seq") % 3 == 0, F.array(F.lit("o")))})
    return spans.with_trace_fields(rows, traces).select("id", "session_id", "user_id", F.try_element_at("tags", F.lit(1)).alias("tag"))


@query("""SELECT event_id, CASE event_id % 5 WHEN 0 THEN props WHEN 1 THEN '{"original_metadata":[1,2]}' WHEN 2 THEN '{"original_metadata":"plain"}' WHEN 3 THEN '{}' ELSE '{"original_metadata":3}' END AS metadata FROM events""")
def metadata_objects(spark: SparkSession, d: str) -> DataFrame:
    """Metadata of any kind as objects."""
    unit = F.col("event_id") % 5
    raw = F.when(unit == 0, F.col("props")).when(unit == 1, "[1,2]").when(unit == 2, "plain").when(unit == 4, "3")
    return fixtures.table(spark, d, "events").select("event_id", values.metadata_object(raw).alias("metadata"))


@query("""SELECT event_id, CASE WHEN event_id % 3 = 0 THEN 'session' WHEN event_id % 3 = 1 THEN 'observation' ELSE 'trace' END AS kind,
CASE WHEN event_id % 3 = 0 THEN 's' WHEN event_id % 3 = 1 THEN 'o' ELSE 't' END || event_id AS subject_id, CASE WHEN event_id % 3 > 0 THEN 't' || event_id END AS subject_trace FROM events""")
def score_subjects(spark: SparkSession, d: str) -> DataFrame:
    """Subjects of scores with flat ids: session before observation before trace."""
    unit, text = F.col("event_id") % 3, F.col("event_id").cast("string")
    null = F.lit(None).cast("string")
    rows = fixtures.table(spark, d, "events").select(
        "event_id", null.alias("kind"), null.alias("subject_id"), null.alias("subject_trace"), F.when(unit == 0, F.concat(F.lit("s"), text)).alias("session_id"), F.when(unit < 2, F.concat(F.lit("o"), text)).alias("observation_id"), F.concat(F.lit("t"), text).alias("trace_id"),
    )
    return readers.flat_subject(rows).select("event_id", "kind", "subject_id", "subject_trace")


@query("""SELECT n_nationkey, v.version, CASE WHEN v.version = 1 THEN 'm' || n_regionkey ELSE 'own' END AS model FROM nation, (SELECT unnest([1, 2])::INTEGER AS version) v""")
def version_overlay(spark: SparkSession, d: str) -> DataFrame:
    """Versions over the defaults of what they are versions of."""
    n = fixtures.table(spark, d, "nation")
    defaults = n.select("n_nationkey", F.concat(F.lit("m"), F.col("n_regionkey").cast("string")).alias("model"))
    versions = n.select("n_nationkey", F.explode(F.array(F.lit(1), F.lit(2))).alias("version")).withColumn("model", F.when(F.col("version") == 2, "own"))
    return resources.overlay(defaults, versions, "n_nationkey", "model").select("n_nationkey", "version", "model")


@query("""WITH a AS (SELECT CAST(ts AS DATE) AS day, count(*) AS n FROM events GROUP BY 1), b AS (SELECT CAST(ts AS DATE) AS day, count(*) AS n FROM events WHERE event_id % 50 <> 0 GROUP BY 1)
SELECT day, a.n AS rows_before, b.n AS rows_after FROM a FULL JOIN b USING (day) WHERE a.n IS DISTINCT FROM b.n""", days=("day",))
def quiet_days(spark: SparkSession, d: str) -> DataFrame:
    """Days whose counts differ between two looks."""
    e = fixtures.table(spark, d, "events")
    return reconcile.moved(readers.daily_counts(e, "ts"), readers.daily_counts(e.where("event_id % 50 <> 0"), "ts")).select("day", "rows_before", "rows_after")


@query("""SELECT CAST(d AS DATE) AS day FROM (SELECT unnest(generate_series(min(ts)::DATE::TIMESTAMP, max(ts)::DATE::TIMESTAMP, INTERVAL 1 DAY)) AS d FROM events)
WHERE d + INTERVAL 1 DAY > TIMESTAMP '2026-01-15 00:00:00' - INTERVAL 730 DAYS ORDER BY d LIMIT 5""", days=("day",))
def eligible_windows(spark: SparkSession, d: str) -> DataFrame:
    """The oldest five days that two years of history reach."""
    windows = readers.day_windows(readers.history_range(readers.daily_counts(fixtures.table(spark, d, "events"), "ts")))
    return readers.eligible_days(windows, datetime(2026, 1, 15), 2, 5).select("day")


@query("SELECT CAST(ts AS DATE) AS day, count(*) AS rows FROM events WHERE ts >= TIMESTAMP '2024-01-01 00:00:00' AND ts < TIMESTAMP '2024-03-11 00:00:00' GROUP BY 1", days=("day",))
def chunked_daily_counts(spark: SparkSession, d: str) -> DataFrame:
    """Daily counts look by look over ranges of 30 days."""
    return readers.counted_in_chunks(fixtures.table(spark, d, "events"), "ts", date(2024, 1, 1), date(2024, 3, 10), 30)


@query(f"WITH {_OBS} SELECT id, row_number() OVER (PARTITION BY trace_id ORDER BY start_time, id) AS place FROM obs")
def ordered_rows(spark: SparkSession, d: str) -> DataFrame:
    return spans.ordered(_obs(spark, d)).select("id", F.col("place").cast("long").alias("place"))


@query("""SELECT event_id, CAST(CASE event_id % 4 WHEN 0 THEN CAST(1700000000 + event_id AS DOUBLE) * 1000000000 WHEN 1 THEN CAST((1700000000 + event_id) * 1000 AS DOUBLE) * 1000000
WHEN 2 THEN CAST((1700000000 + event_id) * 1000000 AS DOUBLE) * 1000 ELSE CAST((1700000000 + event_id) * 1000000000 AS DOUBLE) END AS BIGINT) AS nanos FROM events""")
def number_nanos(spark: SparkSession, d: str) -> DataFrame:
    """Epoch numbers in seconds, milli-, micro- and nanoseconds."""
    base = F.col("event_id").cast("long") + F.lit(1_700_000_000)
    scale = F.element_at(F.array(*[F.lit(x).cast("long") for x in (1, 1000, 1_000_000, 1_000_000_000)]), (F.col("event_id") % 4 + 1).cast("int"))
    return fixtures.table(spark, d, "events").select("event_id", values.nanos_of_number((base * scale).cast("double")).alias("nanos"))


@query("""SELECT event_id, CASE event_id % 3 WHEN 0 THEN strftime(ts, '%Y-%m-%dT%H:%M:%SZ') WHEN 1 THEN strftime(ts, '%Y-%m-%dT%H:%M:%S') || '.000007Z' END AS iso FROM events""")
def iso_times(spark: SparkSession, d: str) -> DataFrame:
    """Times read from text, unreadable ones as null, and written with a Z."""
    unit, whole = F.col("event_id") % 3, F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss")
    text = F.when(unit == 0, F.concat(whole, F.lit("Z"))).when(unit == 1, F.concat(whole, F.lit(".000007"))).otherwise("at noon")
    return fixtures.table(spark, d, "events").select("event_id", values.iso(values.parse_time(text)).alias("iso"))


@query("""SELECT n_nationkey, 'https://h.example/spaces/' || replace(url_encode(n_name), '%20', '+') || '/projects/' || replace(url_encode('a b/' || n_nationkey), '%20', '+') || '?start=1704067200000&end=' || (1704067200000 + n_nationkey * 86400000) AS link,
'run-202401' || lpad(CAST(n_nationkey + 1 AS VARCHAR), 2, '0') || '-000000' AS project FROM nation""")
def deep_links(spark: SparkSession, d: str) -> DataFrame:
    """Links to a project in a range of time, and names of projects that have none."""
    start = F.lit("2024-01-01 00:00:00").cast("timestamp")
    end = F.timestamp_add("DAY", F.col("n_nationkey").cast("int"), start)
    project = F.concat(F.lit("a b/"), F.col("n_nationkey").cast("string"))
    return fixtures.table(spark, d, "nation").select("n_nationkey", names.deep_link("https://h.example/", F.col("n_name"), project, start, end).alias("link"), names.default_project_name("run", end).alias("project"))


@query("""SELECT n_nationkey, n_regionkey IN (0, 2, 4) AS secret, CASE n_regionkey WHEN 1 THEN 'not a pair: b' WHEN 3 THEN 'not a pair: =c' END AS error FROM nation""")
def strict_pairs(spark: SparkSession, d: str) -> DataFrame:
    """Names of settings that are secret, and what is wrong with lists of pairs."""
    at = (F.col("n_regionkey") + 1).cast("int")
    name = F.concat(F.lit("n"), F.col("n_nationkey").cast("string"), F.element_at(F.array(*[F.lit(x) for x in ("_API_KEY", "_host", "_Token", "_x", "_password")]), at))
    text = F.element_at(F.array(*[F.lit(x) for x in ("a=1,b=2", "a=1, b ,c=3", "", "a=1,=c,d", " a = 1 ,")]), at)
    return fixtures.table(spark, d, "nation").select("n_nationkey", names.is_secret(name).alias("secret"), names.pair_error(text).alias("error"))


@query(f"""WITH {_OBS} SELECT {_SPAN("id")} AS span_id, CASE WHEN kind = 'LLM' THEN 'm' || seq % 3 END AS model, CASE WHEN kind = 'LLM' THEN '{{"t":1}}' END AS invocation_parameters,
CASE WHEN kind = 'LLM' AND seq % 2 = 0 THEN 'p' END AS prompt_name FROM (SELECT *, {_KIND} AS kind FROM obs)""")
def llm_attributes(spark: SparkSession, d: str) -> DataFrame:
    """Attributes that only model calls have."""
    o = _obs(spark, d).withColumns({"model": F.concat(F.lit("m"), (F.col("seq") % 3).cast("string")), "model_parameters": F.lit('{"t":1}'), "prompt_name": F.when(F.col("seq") % 2 == 0, "p").otherwise("")})
    return spans.project(o).select("span_id", "model", "invocation_parameters", "prompt_name")


@query("""SELECT event_id, ['a', 'z.y.x.w.v.u.t'] AS names, CAST(event_id AS VARCHAR) AS leaf FROM events""")
def deep_attributes(spark: SparkSession, d: str) -> DataFrame:
    """Leaves of an object that is nested seven deep, by name."""
    nested = F.concat(F.lit('{"z":{"y":{"x":{"w":{"v":{"u":{"t":'), F.col("event_id").cast("string"), F.lit('}}}}}},"n":[],"a":1}'))
    flat = fixtures.table(spark, d, "events").select("event_id", values.flatten_json(nested).alias("flat"))  # a column of its own, so that it is computed once
    return flat.select("event_id", F.map_keys("flat").alias("names"), F.element_at("flat", "z.y.x.w.v.u.t").alias("leaf"))


@query("""SELECT n_nationkey, CASE WHEN n_regionkey % 3 = 0 THEN 'prepared' WHEN n_regionkey % 3 = 1 AND 396 + n_nationkey * 6 BETWEEN 400 AND 499 AND 396 + n_nationkey * 6 <> 408 THEN 'rejected' ELSE 'ambiguous' END AS outcome FROM nation""")
def upload_outcomes(spark: SparkSession, d: str) -> DataFrame:
    """What failures of uploads mean, by stage and status."""
    stage = F.element_at(F.array(F.lit("prepare"), F.lit("bulk"), F.lit("quick")), (F.col("n_regionkey") % 3 + 1).cast("int"))
    return fixtures.table(spark, d, "nation").select("n_nationkey", batches.outcome(stage, F.col("n_nationkey") * 6 + 396).alias("outcome"))


@query(f"WITH {_OBS} SELECT id AS span_id, strftime(start_time, '%Y-%m-%d %H:%M:%S') AS started FROM obs WHERE start_time < TIMESTAMP '2026-01-10 00:00:00' - INTERVAL 730 DAYS ORDER BY start_time, id LIMIT 20")
def retention_rows(spark: SparkSession, d: str) -> DataFrame:
    """The oldest spans that are too old: a report of 20."""
    o = _obs(spark, d).withColumnRenamed("id", "span_id")
    rows = reconcile.retention_sample(o, F.lit("2026-01-10 00:00:00").cast("timestamp"), 2)
    return rows.select("span_id", F.date_format("start_time", "yyyy-MM-dd HH:mm:ss").alias("started"))


@query("""SELECT 'p' || conv_id AS name, CAST(turn AS INTEGER) AS version, text AS body, CASE WHEN turn % 2 = 0 THEN 'chat' ELSE 'text' END AS kind, [role] AS labels FROM conversations""")
def canonical_prompts(spark: SparkSession, d: str) -> DataFrame:
    """Prompt records of a source in the canonical shape."""
    t = fixtures.table(spark, d, "conversations")
    records = t.select(F.concat(F.lit("p"), F.col("conv_id").cast("string")).alias("name"), F.col("turn").cast("string").alias("version"), F.col("text").alias("prompt"), F.when(F.col("turn") % 2 == 0, "chat").otherwise("text").alias("type"), F.array("role").alias("labels"))
    return readers.canonical(records, readers.RESOURCES["prompts"]).select("name", "version", "body", "kind", "labels")


@query("""WITH t AS (SELECT DISTINCT conv_id, turn, text FROM conversations)
SELECT 'p' || conv_id AS name, CAST(turn AS VARCHAR) AS version, text AS body, row_number() OVER (PARTITION BY conv_id ORDER BY turn) - 1 AS place FROM t
UNION ALL SELECT 'p' || conv_id, 'draft', NULL, count(*) FROM t GROUP BY conv_id""")
def version_order(spark: SparkSession, d: str) -> DataFrame:
    """Versions that summaries list with their bodies, in the order of their numbers."""
    t = fixtures.table(spark, d, "conversations").select(F.concat(F.lit("p"), F.col("conv_id").cast("string")).alias("name"), F.col("turn").cast("string").alias("version"), F.col("text").alias("body")).distinct()
    summaries = t.groupBy("name").agg(F.concat(F.collect_set("version"), F.array(F.lit("draft"))).alias("versions"))
    return resources.ordered_versions(resources.with_bodies(summaries, t)).select("name", "version", "body", F.col("place").cast("long").alias("place"))


@query("""SELECT CAST(n_nationkey AS VARCHAR) AS name, 'MUSTACHE' AS variable_format, CASE WHEN n_regionkey = 0 THEN 'note ' || n_nationkey ELSE 'Imported (version 1)' END AS message, 'OPEN_AI' AS provider, CAST(n_regionkey AS VARCHAR) AS temperature FROM nation""")
def prompt_payloads(spark: SparkSession, d: str) -> DataFrame:
    """What is made of prompt versions; a missing message is made up."""
    key = F.col("n_nationkey").cast("string")
    rows = fixtures.table(spark, d, "nation").select(
        key.alias("name"), F.lit("1").alias("version"), F.lit("Hi {{x}}").alias("body"), F.lit(False).alias("is_list"), F.concat(F.lit('{"model":"gpt-4o","temperature":'), F.col("n_regionkey").cast("string"), F.lit("}")).alias("config"),
        F.array(F.lit("prod")).alias("labels"), F.when(F.col("n_regionkey") == 0, F.concat(F.lit(" note "), key)).otherwise(" ").alias("message"),
    )
    return resources.prompt_versions(rows).select("name", "variable_format", "message", "provider", F.col("parameters")["temperature"].alias("temperature"))


@query("""SELECT n_nationkey AS id, replace(n_name, ' ', '_') || '_-' || n_nationkey || CASE n_regionkey % 3 WHEN 0 THEN '.py' WHEN 1 THEN '.ts' ELSE '.txt' END AS file,
CASE WHEN n_regionkey % 3 = 0 THEN '#' ELSE '//' END || ' evaluator: ' || n_name || '!' AS head, 8::BIGINT AS lines FROM nation""")
def code_files(spark: SparkSession, d: str) -> DataFrame:
    """Code evaluators as files."""
    n = fixtures.table(spark, d, "nation")
    language = F.element_at(F.array(F.lit("Python"), F.lit("TYPESCRIPT"), F.lit("ruby")), (F.col("n_regionkey") % 3 + 1).cast("int"))
    rows = n.select(F.col("n_nationkey").alias("id"), F.concat("n_name", F.lit("!")).alias("name"), F.lit(2).alias("version"), language.alias("language"), F.lit("two\nlines").alias("description"), F.col("n_name").alias("code"))
    lines = F.split("content", "\n")
    return resources.code_exports(rows).select("id", "file", F.element_at(lines, 1).alias("head"), F.size(lines).cast("long").alias("lines"))


@query("""SELECT 'd' || doc_id % 10 AS dataset, count(*) FILTER (WHERE doc_id % 10 <> 0) AS items, CASE WHEN count(*) FILTER (WHERE doc_id % 10 <> 0) = 0 THEN 'no active items' END AS note FROM documents GROUP BY 1""")
def dataset_notes(spark: SparkSession, d: str) -> DataFrame:
    """Datasets with how many active items they have."""
    docs = fixtures.table(spark, d, "documents")
    unit = F.col("doc_id") % 10
    return resources.dataset_notes(docs.select(F.concat(F.lit("d"), unit.cast("string")).alias("dataset"), F.when(unit == 0, "archived").alias("status")))


@query("""WITH it AS (SELECT source AS dataset, doc_id AS item, CASE WHEN n_chars % 2 = 0 THEN 'language' ELSE 'input' END AS col, CASE WHEN n_chars % 2 = 0 THEN lang ELSE 'plain' END AS cell, n_chars FROM documents WHERE doc_id % 10 <> 0),
l AS (SELECT dataset, item, 0 AS pos, col, cell FROM it UNION ALL SELECT dataset, item, 1, 'expected_output', CAST(n_chars AS VARCHAR) FROM it UNION ALL SELECT dataset, item, 2, 'metadata_source', dataset FROM it UNION ALL SELECT dataset, item, 3, 'source_item_id', CAST(item AS VARCHAR) FROM it),
c AS (SELECT dataset, col, row_number() OVER (PARTITION BY dataset ORDER BY min(item * 10 + pos)) - 1 AS place FROM l GROUP BY dataset, col)
SELECT c.dataset, it.item, c.place, c.col AS "column", l.cell FROM c JOIN it USING (dataset) LEFT JOIN l ON l.dataset = c.dataset AND l.item = it.item AND l.col = c.col""")
def dataset_wide(spark: SparkSession, d: str) -> DataFrame:
    """Items of datasets over all columns of their dataset, in the order in which columns are first seen."""
    docs = fixtures.table(spark, d, "documents")
    source = F.when(F.col("n_chars") % 2 == 0, F.to_json(F.struct(F.col("lang").alias("language")))).otherwise("plain")
    items = docs.select(F.col("source").alias("dataset"), F.col("doc_id").alias("id"), source.alias("input"), F.col("n_chars").cast("string").alias("expected"), F.to_json(F.struct("source")).alias("metadata"), F.when(F.col("doc_id") % 10 == 0, "ARCHIVED").alias("status"))
    rows = resources.dataset_rows(resources.dataset_examples(items))
    return rows.select("dataset", "item", F.posexplode(F.arrays_zip("names", "cells")).alias("place", "x")).select("dataset", "item", F.col("place").cast("long").alias("place"), F.col("x.names").alias("column"), F.col("x.cells").alias("cell"))


@query("""WITH n AS (SELECT 'r' || n_regionkey AS rule, n_nationkey AS evaluator, n_regionkey FROM nation)
SELECT rule, evaluator, 'input' AS variable, CASE WHEN n_regionkey % 2 = 0 THEN 'attributes.metadata.q' ELSE 'attributes.input.value' END AS "column", n_regionkey % 2 = 0 AS own FROM n
UNION ALL SELECT rule, evaluator, 'output', 'attributes.output.value', FALSE FROM n
UNION ALL SELECT rule, evaluator, 'extra', 'attributes.output.value', TRUE FROM n WHERE n_regionkey % 2 = 0""")
def rule_mappings(spark: SparkSession, d: str) -> DataFrame:
    """Columns of rules' evaluators, with what an assignment overrides."""
    n = fixtures.table(spark, d, "nation")
    over = lambda variable, source, path: F.struct(F.lit(variable).alias("variable"), F.lit(source).alias("source"), F.lit(path).cast("string").alias("path"))
    some = F.array(over("input", "metadata", "$.q"), over("extra", "output", None))
    assigned = n.select(F.concat(F.lit("r"), F.col("n_regionkey").cast("string")).alias("rule"), F.col("n_nationkey").alias("evaluator"), F.when(F.col("n_regionkey") % 2 == 0, some).otherwise(F.slice(some, 1, 0)).alias("overrides"))
    own = n.select(F.col("n_nationkey").alias("evaluator"), F.explode(F.array(F.lit("input"), F.lit("output"))).alias("variable")).withColumn("column", prompts.source_column(F.col("variable"), F.lit(None).cast("string")))
    return resources.rule_mappings(assigned, own)

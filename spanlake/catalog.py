"""All queries over the test tables, with the SQL each is compared with."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from spanlake.functions import ids, names, prompts, values
from spanlake.operators import batches, reconcile, resources, scores, spans
from spanlake.sources import fixtures, readers, writers

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}

_OBS = """
ev AS (SELECT *, 'u' || user_id || '-' || strftime(ts, '%Y%m%d') AS trace_id FROM events),
ew AS (SELECT *, row_number() OVER (PARTITION BY trace_id ORDER BY ts, event_id) AS rn, first_value(event_id) OVER (PARTITION BY trace_id ORDER BY ts, event_id) AS head FROM ev),
obs AS (
  SELECT 'e' || event_id AS id, trace_id,
    CASE WHEN rn = 1 AND head % 11 = 0 THEN 'missing-' || head WHEN rn = 1 OR event_id % 7 = 0 THEN NULL ELSE 'e' || head END AS parent_id,
    CASE event_type WHEN 'view' THEN 'SPAN' WHEN 'click' THEN 'TOOL' WHEN 'purchase' THEN 'GENERATION' WHEN 'signup' THEN 'EVENT' WHEN 'error' THEN 'SPAN' END AS type,
    event_type AS name, ts AS start_time, ts + to_seconds(CAST(floor(value) AS BIGINT)) AS end_time, CASE WHEN event_type = 'error' THEN 'ERROR' ELSE 'DEFAULT' END AS level,
    props AS metadata, CAST(json_extract_string(props, '$.k') AS DOUBLE) AS k, 's' || user_id AS session_id, CAST(user_id AS VARCHAR) AS user_id, event_id AS seq
  FROM ew)"""
_KIND = "CASE type WHEN 'GENERATION' THEN 'LLM' WHEN 'TOOL' THEN 'TOOL' ELSE 'CHAIN' END"


def _hex(value: str, space: str, width: int) -> str:
    plain = f"replace(lower(trim({value})), '-', '')"
    return f"(CASE WHEN regexp_full_match({plain}, '[0-9a-f]{{{width}}}') AND {plain} <> repeat('0', {width}) THEN {plain} ELSE substr(sha256('{space}' || trim({value})), 1, {width}) END)"


_SPAN, _TRACE = (lambda v: _hex(v, ids.DEFAULT.span, 16)), (lambda v: _hex(v, ids.DEFAULT.trace, 32))
_ROOT = lambda v: f"substr(sha256('{ids.DEFAULT.root}' || trim({v})), 1, 16)"
_TOPS = f"""{_OBS},
tops AS (
  SELECT trace_id, count(*) AS n, count(*) FILTER (WHERE parent_id IS NULL) AS parentless, min(start_time) AS start_time, max(end_time) AS end_time, min(session_id) AS session_id,
    min_by(id, (start_time, id)) FILTER (WHERE parent_id IS NULL) AS only_root, min_by(name, (start_time, id)) FILTER (WHERE parent_id IS NULL) AS root_name, min_by(name, (start_time, id)) AS first_name
  FROM obs GROUP BY trace_id),
roots AS (SELECT *, parentless <> 1 AS made_up, CASE WHEN parentless <> 1 THEN {_ROOT("trace_id")} ELSE {_SPAN("only_root")} END AS root_id, CASE WHEN parentless = 1 THEN root_name ELSE first_name END AS name FROM tops)"""
_SCORES = f"""{_TOPS},
lab AS (SELECT l.*, o.trace_id, o.session_id FROM labels l LEFT JOIN obs o ON o.seq = l.doc_id),
sc AS (
  SELECT 'q' || doc_id AS id, 'quality' AS name, 'NUMERIC' AS data_type, CAST(quality AS DOUBLE) AS number, NULL AS text, NULL AS comment, 'API' AS source, CASE doc_id % 3 WHEN 0 THEN 'trace' WHEN 1 THEN 'session' ELSE 'dataset_run' END AS kind,
    CASE doc_id % 3 WHEN 0 THEN trace_id WHEN 1 THEN session_id ELSE 'r' || doc_id END AS subject_id, NULL AS author, doc_id AS stamp FROM lab
  UNION ALL SELECT 't' || doc_id, 'is.toxic', 'BOOLEAN', CAST(toxic AS DOUBLE), NULL, CASE WHEN toxic = 1 THEN 'flagged' END, 'API', CASE doc_id % 3 WHEN 0 THEN 'trace' WHEN 1 THEN 'session' ELSE 'dataset_run' END,
    CASE doc_id % 3 WHEN 0 THEN trace_id WHEN 1 THEN session_id ELSE 'r' || doc_id END, NULL, doc_id FROM lab
  UNION ALL SELECT 'c' || seq, CASE WHEN seq % 2 = 0 THEN 'event-type' ELSE 'event.type' END, 'CATEGORICAL', NULL, name, CASE WHEN level = 'ERROR' THEN 'failed' END, CASE WHEN seq % 5 = 0 THEN 'ANNOTATION' ELSE 'EVAL' END, 'observation', id,
    CASE WHEN seq % 5 = 0 THEN user_id END, seq FROM obs),
cl AS (
  SELECT sc.*, regexp_replace(regexp_replace(sc.name, '[^a-zA-Z0-9_\\s]+', '_', 'g'), '_+', '_', 'g') AS clean, CASE kind WHEN 'observation' THEN 'span' WHEN 'trace' THEN 'trace' WHEN 'session' THEN 'session' END AS granularity,
    coalesce(text, CASE WHEN data_type = 'BOOLEAN' THEN CASE WHEN number <> 0 THEN 'true' ELSE 'false' END END) AS label, r.root_id AS trace_root
  FROM sc LEFT JOIN roots r ON sc.kind = 'trace' AND sc.subject_id = r.trace_id),
ow AS (SELECT clean, min(name) AS owner FROM cl WHERE granularity IS NOT NULL AND subject_id IS NOT NULL GROUP BY clean),
cs AS (
  SELECT cl.*, source = 'ANNOTATION' AND granularity <> 'session' AS annotation, CASE granularity WHEN 'span' THEN {_SPAN("subject_id")} WHEN 'trace' THEN trace_root WHEN 'session' THEN subject_id END AS target,
    CASE WHEN subject_id IS NULL THEN 'no subject' WHEN granularity IS NULL THEN 'subject kind is not mapped' WHEN granularity = 'trace' AND trace_root IS NULL THEN 'trace is not there' WHEN cl.name <> owner THEN 'name collides' END AS reason
  FROM cl LEFT JOIN ow USING (clean)),
cells0 AS (
  SELECT CASE WHEN granularity = 'session' THEN 'session_evals' WHEN annotation THEN 'annotations' ELSE 'evals' END AS bucket, target,
    CASE WHEN annotation THEN 'annotation' ELSE CASE granularity WHEN 'span' THEN 'eval' WHEN 'trace' THEN 'trace_eval' ELSE 'session_eval' END END || '.' || clean AS p, stamp, id, number, label, comment, annotation, author
  FROM cs WHERE reason IS NULL),
cells1 AS (
  SELECT bucket, target, p || '.score' AS col, stamp, id, number, NULL AS text FROM cells0 WHERE number IS NOT NULL
  UNION ALL SELECT bucket, target, p || '.label', stamp, id, NULL, label FROM cells0 WHERE label IS NOT NULL
  UNION ALL SELECT bucket, target, p || CASE WHEN annotation THEN '.text' ELSE '.explanation' END, stamp, id, NULL, comment FROM cells0 WHERE comment IS NOT NULL
  UNION ALL SELECT bucket, target, p || '.updated_by', stamp, id, NULL, author FROM cells0 WHERE annotation AND author IS NOT NULL
  UNION ALL SELECT bucket, target, p || '.updated_at', stamp, id, NULL, CAST(stamp AS VARCHAR) FROM cells0 WHERE annotation),
cells AS (SELECT bucket, target, col AS "column", max_by({{'n': number, 't': text}}, (stamp, id)) AS v FROM cells1 GROUP BY ALL),
anchors AS (
  SELECT session_id, min_by(root_id, (first_start, trace_id)) AS anchor FROM (SELECT DISTINCT o.session_id, o.trace_id, r.root_id, r.start_time AS first_start FROM obs o JOIN roots r USING (trace_id)) GROUP BY session_id)"""
_LEDGER = f"""{_OBS},
ln AS (SELECT CAST(start_time AS DATE) AS day, row_number() OVER (PARTITION BY CAST(start_time AS DATE) ORDER BY seq) - 1 AS n FROM obs),
lb AS (SELECT day, n // {fixtures.LEDGER_BATCH} AS batch, min(n) AS start, max(n) + 1 AS "end" FROM ln GROUP BY 1, 2),
led AS (SELECT *, CASE WHEN batch % 3 = 2 THEN 'submitted' WHEN batch % 3 = 1 AND day_of_month % 4 = 0 THEN 'uncertain' ELSE 'pending' END AS status FROM (SELECT *, day(day) AS day_of_month FROM lb)),
prog AS (SELECT day, count(*) AS batches, count(*) FILTER (WHERE status = 'submitted') AS submitted, count(*) FILTER (WHERE status = 'uncertain') AS uncertain,
  CAST(coalesce(sum("end" - start) FILTER (WHERE status = 'submitted'), 0) AS BIGINT) AS spans_submitted, bool_and(status = 'submitted') AS complete FROM led GROUP BY day)"""


def query(sql: str | None = None, days: tuple[str, ...] = ()) -> Callable[[Query], Query]:
    """Registers a query under its function's name, with its SQL. days: date columns, which both sides show as text."""

    def add(f: Query) -> Query:
        QUERIES[f.__name__] = lambda spark, sf_dir: f(spark, sf_dir).withColumns({c: F.col(c).cast("string") for c in days})
        if sql:
            ORACLES[f.__name__] = f"SELECT * REPLACE ({', '.join(f'CAST({c} AS VARCHAR) AS {c}' for c in days)}) FROM ({sql})" if days else sql
        return f

    return add


def _when(c: str) -> Column:
    return F.date_format(c, "yyyy-MM-dd HH:mm:ss")


def _obs(spark: SparkSession, d: str) -> DataFrame:
    return fixtures.observations(spark, d)


def _cells(spark: SparkSession, d: str) -> DataFrame:
    return scores.long_columns(scores.classify(fixtures.scores(spark, d), spans.roots(_obs(spark, d))))


def _anchors(spark: SparkSession, d: str) -> DataFrame:
    o = _obs(spark, d)
    return spans.session_anchors(o, spans.roots(o))


def _shards(spark: SparkSession, d: str) -> DataFrame:
    return batches.progress(fixtures.ledger(spark, d))


@query(f"WITH {_OBS} SELECT id, {_SPAN('id')} AS span_id, {_SPAN('parent_id')} AS parent_id FROM obs")
def span_ids(spark: SparkSession, d: str) -> DataFrame:
    return _obs(spark, d).select("id", ids.span_id(F.col("id")).alias("span_id"), ids.span_id(F.col("parent_id")).alias("parent_id"))


@query(f"WITH {_OBS} SELECT DISTINCT trace_id AS source, {_TRACE('trace_id')} AS trace_id, {_TRACE('md5(trace_id)')} AS passed, {_ROOT('trace_id')} AS root_id FROM obs")
def trace_ids(spark: SparkSession, d: str) -> DataFrame:
    t = _obs(spark, d).select("trace_id").distinct()
    return t.select(F.col("trace_id").alias("source"), ids.trace_id(F.col("trace_id")).alias("trace_id"), ids.trace_id(F.md5(F.col("trace_id").cast("binary"))).alias("passed"), ids.root_span_id(F.col("trace_id")).alias("root_id"))


@query(f"WITH {_OBS} SELECT id, name, {_KIND} AS span_kind, level AS status_source, CASE WHEN level = 'ERROR' THEN 'ERROR' ELSE 'OK' END AS status_code, strftime(start_time, '%Y-%m-%d %H:%M:%S') AS started, strftime(end_time, '%Y-%m-%d %H:%M:%S') AS ended FROM obs")
def span_projection(spark: SparkSession, d: str) -> DataFrame:
    o = _obs(spark, d)
    return o.select("id", values.span_name(F.col("name"), F.col("type")).alias("name"), values.span_kind(F.col("type")).alias("span_kind"), F.col("level").alias("status_source"), values.status_code(F.col("level")).alias("status_code"), _when("start_time").alias("started"), _when("end_time").alias("ended"))


@query(f"""WITH {_TOPS}, sp AS (
  SELECT CAST(o.start_time AS DATE) AS day, {_KIND.replace("type", "o.type")} AS span_kind, CASE WHEN o.parent_id IS NULL THEN CASE WHEN r.made_up THEN r.root_id END ELSE o.parent_id END AS parent FROM obs o JOIN roots r USING (trace_id)
  UNION ALL SELECT CAST(start_time AS DATE), 'CHAIN', NULL FROM roots WHERE made_up)
SELECT day, span_kind, count(*) AS spans, count(*) FILTER (WHERE parent IS NULL) AS roots FROM sp GROUP BY day, span_kind""", days=("day",))
def span_kind_hist(spark: SparkSession, d: str) -> DataFrame:
    """Spans and roots per day and kind, over whole trees."""
    return spans.kind_counts(spans.by_day(spans.assemble(_obs(spark, d))), "day")


@query("""SELECT conv_id, turn, CASE WHEN text IS NULL THEN NULL WHEN regexp_matches(trim(text), '^[{\\[]') AND json_valid(trim(text)) THEN 'application/json' ELSE 'text/plain' END AS mime,
CASE WHEN turn % 2 = 0 THEN 'application/json' ELSE 'text/plain' END AS wrapped FROM conversations""")
def io_mime(spark: SparkSession, d: str) -> DataFrame:
    t = fixtures.table(spark, d, "conversations")
    wrapped = F.when(F.col("turn") % 2 == 0, F.to_json(F.struct("role", "text"))).otherwise(F.concat(F.lit("{"), F.col("turn").cast("string")))
    return t.select("conv_id", "turn", values.mime_type(F.col("text")).alias("mime"), values.mime_type(wrapped).alias("wrapped"))


@query(f"WITH {_OBS} SELECT seq, CAST(coalesce(nullif(k, 0), -1) AS BIGINT) AS prompt, CAST(trunc(seq % 4) AS BIGINT) AS completion, CAST(coalesce(nullif(k, 0), 0) + seq % 4 AS BIGINT) AS total FROM obs")
def usage_totals(spark: SparkSession, d: str) -> DataFrame:
    o = _obs(spark, d)
    u = values.usage(F.col("usage_details"), F.create_map(F.lit("completionTokens"), (F.col("seq") % 4).cast("double")))
    return o.select("seq", *[F.coalesce(u[k], F.lit(-1).cast("long")).alias(k) for k in ("prompt", "completion", "total")])


@query(f"WITH {_OBS} SELECT seq, CAST(CASE WHEN k <> 0 THEN k * 0.5 ELSE seq * 0.25 END AS DOUBLE) AS prompt, CAST(seq % 3 AS DOUBLE) AS completion, CAST(CASE WHEN k <> 0 THEN k * 0.5 ELSE seq * 0.25 END + seq % 3 AS DOUBLE) AS total FROM obs")
def cost_totals(spark: SparkSession, d: str) -> DataFrame:
    o = _obs(spark, d)
    seq, none = F.col("seq").cast("double"), F.lit(None).cast("double")
    details = F.create_map(F.lit("input"), F.col("usage_details")["input"] * 0.5)
    c = values.cost(details, {"prompt": (none, seq * 0.25), "completion": (none, (F.col("seq") % 3).cast("double")), "total": (none, none)})
    return o.select("seq", *[c[k].alias(k) for k in ("prompt", "completion", "total")])


@query("SELECT conv_id, CAST(row_number() OVER (PARTITION BY conv_id ORDER BY turn) - 1 AS INTEGER) AS place, role, text AS content FROM conversations WHERE text IS NOT NULL")
def messages_long(spark: SparkSession, d: str) -> DataFrame:
    """Conversations as JSON chat inputs, read back as messages."""
    t = fixtures.table(spark, d, "conversations").where("text IS NOT NULL")
    turns = F.array_sort(F.collect_list(F.struct("turn", "role", F.col("text").alias("content"))))
    chats = t.groupBy("conv_id").agg(F.to_json(F.struct(F.transform(turns, lambda x: F.struct(x["role"].alias("role"), x["content"].alias("content"))).alias("messages"))).alias("input"))
    return chats.select("conv_id", F.posexplode(values.messages(F.col("input"))).alias("place", "m")).select("conv_id", "place", "m.role", "m.content")


@query(f"WITH {_TOPS} SELECT trace_id, n AS rows, parentless, made_up, root_id, name, strftime(start_time, '%Y-%m-%d %H:%M:%S') AS started, strftime(end_time, '%Y-%m-%d %H:%M:%S') AS ended FROM roots")
def trace_roots(spark: SparkSession, d: str) -> DataFrame:
    return spans.roots(_obs(spark, d)).select("trace_id", "rows", "parentless", "made_up", "root_id", "name", _when("start_time").alias("started"), _when("end_time").alias("ended"))


@query(f"WITH {_TOPS} SELECT root_id AS span_id, {_TRACE('trace_id')} AS trace_id, name, CAST(n AS BIGINT) AS rows, strftime(end_time, '%Y-%m-%d %H:%M:%S') AS ended FROM roots WHERE made_up")
def synthetic_roots(spark: SparkSession, d: str) -> DataFrame:
    made = spans.made_up_roots(spans.roots(_obs(spark, d)))
    return made.select("span_id", "trace_id", "name", F.get_json_object("metadata", "$.observation_count").cast("long").alias("rows"), _when("end_time").alias("ended"))


@query(f"WITH {_TOPS} SELECT {_SPAN('o.id')} AS span_id, CASE WHEN o.parent_id IS NULL THEN CASE WHEN r.made_up THEN r.root_id END ELSE {_SPAN('o.parent_id')} END AS parent_id FROM obs o JOIN roots r USING (trace_id) UNION ALL SELECT root_id, NULL FROM roots WHERE made_up")
def reparented_spans(spark: SparkSession, d: str) -> DataFrame:
    return spans.assemble(_obs(spark, d)).select("span_id", "parent_id")


@query(f"""WITH {_TOPS} SELECT {_SPAN("o.id")} AS span_id, CASE WHEN o.parent_id IS NULL THEN CASE WHEN r.made_up THEN r.root_id END WHEN p.id IS NULL THEN CASE WHEN {_SPAN("o.id")} <> r.root_id THEN r.root_id ELSE {_SPAN("o.parent_id")} END ELSE {_SPAN("o.parent_id")} END AS parent_id
FROM obs o JOIN roots r USING (trace_id) LEFT JOIN obs p ON p.trace_id = o.trace_id AND p.id = o.parent_id UNION ALL SELECT root_id, NULL FROM roots WHERE made_up""")
def reattached_orphans(spark: SparkSession, d: str) -> DataFrame:
    return spans.assemble(_obs(spark, d), reattach_orphans=True).select("span_id", "parent_id")


@query(f"WITH {_SCORES} SELECT session_id, anchor FROM anchors")
def session_anchor(spark: SparkSession, d: str) -> DataFrame:
    return _anchors(spark, d)


@query(f"WITH {_OBS} SELECT {_SPAN('id')} AS span_id, CAST(epoch(end_time) - epoch(start_time) AS BIGINT) * 1000000000 AS nanos, coalesce(CASE WHEN type = 'GENERATION' THEN CAST(nullif(k, 0) AS BIGINT) END, -1) AS prompt_tokens FROM obs")
def wide_rows(spark: SparkSession, d: str) -> DataFrame:
    rows = spans.wide(spans.project(_obs(spark, d)))[0]
    return rows.select(F.col("`context.span_id`").alias("span_id"), (F.col("end_time") - F.col("start_time")).alias("nanos"), F.coalesce(F.col("`attributes.llm.token_count.prompt`"), F.lit(-1).cast("long")).alias("prompt_tokens"))


@query("""WITH j AS (SELECT event_id, props, CAST(json_extract_string(props, '$.k') AS VARCHAR) AS k FROM events)
SELECT event_id, 'a.k' AS name, k AS leaf FROM j UNION ALL SELECT event_id, 'b', '[1,2]' FROM j UNION ALL SELECT event_id, 'c.d.e', CAST(event_id AS VARCHAR) FROM j""")
def flattened_attributes(spark: SparkSession, d: str) -> DataFrame:
    nested = F.concat(F.lit('{"a":'), F.col("props"), F.lit(',"b":[1,2],"z":null,"c":{"d":{"e":'), F.col("event_id").cast("string"), F.lit("}}}"))
    return fixtures.table(spark, d, "events").select("event_id", F.explode(values.flatten_json(nested)).alias("name", "leaf"))


@query(f"WITH {_SCORES} SELECT id, CAST(number AS DOUBLE) AS number, label FROM cl")
def score_values(spark: SparkSession, d: str) -> DataFrame:
    number, label = scores.number_and_label(F.col("data_type"), F.col("value_number"), F.col("value_text"))
    return fixtures.scores(spark, d).select("id", number.alias("number"), F.when(F.col("data_type") != "NUMERIC", label).alias("label"))


@query(f"WITH {_SCORES} SELECT granularity, annotation, count(*) AS scores FROM cs WHERE granularity IS NOT NULL AND subject_id IS NOT NULL GROUP BY ALL")
def score_granularity(spark: SparkSession, d: str) -> DataFrame:
    c = scores.classify(fixtures.scores(spark, d), spans.roots(_obs(spark, d)))
    return c.where("granularity IS NOT NULL").groupBy("granularity", "annotation").agg(F.count(F.lit(1)).alias("scores"))


@query(f'WITH {_SCORES} SELECT bucket, target, "column", CAST(v.n AS DOUBLE) AS number, v.t AS text FROM cells')
def score_partition_long(spark: SparkSession, d: str) -> DataFrame:
    return _cells(spark, d)


@query(f"WITH {_SCORES} SELECT id, name, reason FROM cs WHERE reason IS NOT NULL")
def score_skipped(spark: SparkSession, d: str) -> DataFrame:
    return scores.skipped(scores.classify(fixtures.scores(spark, d), spans.roots(_obs(spark, d))))


@query(f"WITH {_SCORES} SELECT DISTINCT name, clean FROM cl")
def sanitised_names(spark: SparkSession, d: str) -> DataFrame:
    return fixtures.scores(spark, d).select("name", names.column_name(F.col("name")).alias("clean")).distinct()


@query(f"WITH {_SCORES} SELECT clean, count(DISTINCT name) AS names FROM cl GROUP BY clean HAVING count(DISTINCT name) > 1")
def name_collisions(spark: SparkSession, d: str) -> DataFrame:
    return scores.collisions(fixtures.scores(spark, d))


@query(f"""WITH {_SCORES}, sp AS (SELECT {_SPAN("id")} AS span_id, name FROM obs UNION ALL SELECT root_id, name FROM roots WHERE made_up)
SELECT c.target, c."column", CAST(c.v.n AS DOUBLE) AS number, c.v.t AS text, sp.name FROM cells c JOIN sp ON c.target = sp.span_id WHERE c.bucket = 'evals'""")
def eval_attach(spark: SparkSession, d: str) -> DataFrame:
    return scores.attach(spans.assemble(_obs(spark, d)), _cells(spark, d)).select("target", "column", "number", "text", "name")


@query(f"""WITH {_SCORES} SELECT target, max(v.n) FILTER (WHERE "column" = 'trace_eval.quality.score') AS quality, max(v.t) FILTER (WHERE "column" = 'trace_eval.is_toxic.label') AS toxic FROM cells WHERE bucket = 'evals' GROUP BY target""")
def eval_table(spark: SparkSession, d: str) -> DataFrame:
    """Evals as a wide table of two columns."""
    wide = scores.pivot(_cells(spark, d).where("bucket = 'evals'"), ["trace_eval.quality.score", "trace_eval.is_toxic.label"])
    return wide.select("target", F.col("`trace_eval.quality.score`").alias("quality"), F.col("`trace_eval.is_toxic.label`").alias("toxic"))


@query(f"""WITH {_SCORES} SELECT a.anchor AS target, c.target AS session_id, c."column", CAST(c.v.n AS DOUBLE) AS number, c.v.t AS text FROM cells c JOIN anchors a ON c.target = a.session_id WHERE bucket = 'session_evals'""")
def session_eval_anchor(spark: SparkSession, d: str) -> DataFrame:
    return scores.anchored(_cells(spark, d), _anchors(spark, d))[0].drop("bucket")


@query(f"WITH {_SCORES}, few AS (SELECT * FROM anchors WHERE CAST(substr(session_id, 2) AS BIGINT) % 2 = 0) SELECT DISTINCT c.target AS session_id FROM cells c ANTI JOIN few ON c.target = few.session_id WHERE bucket = 'session_evals'")
def unanchored_sessions(spark: SparkSession, d: str) -> DataFrame:
    few = _anchors(spark, d).where(F.substring("session_id", 2, 20).cast("long") % 2 == 0)
    return scores.anchored(_cells(spark, d), few)[1]


@query(f"""WITH {_SCORES}, ses AS (SELECT a.anchor AS target, c."column", c.v FROM cells c JOIN anchors a ON c.target = a.session_id WHERE bucket = 'session_evals')
SELECT 'inline' AS way, bucket, count(*) AS cells FROM (SELECT bucket, target FROM cells WHERE bucket = 'evals' UNION ALL SELECT 'session_evals', target FROM ses) GROUP BY bucket
UNION ALL SELECT 'deferred', bucket, count(*) FROM (SELECT bucket, target FROM cells WHERE bucket <> 'session_evals' UNION ALL SELECT 'session_evals', target FROM ses) GROUP BY bucket""")
def frame_routes(spark: SparkSession, d: str) -> DataFrame:
    """Cells that travel with spans on the bulk path, and those applied later on the quick one."""
    c, a = _cells(spark, d), _anchors(spark, d)
    count = lambda df, way: df.groupBy("bucket").agg(F.count(F.lit(1)).alias("cells")).select(F.lit(way).alias("way"), "bucket", "cells")
    return count(scores.inline(c, a, bulk=True), "inline").unionByName(count(scores.deferred(c, a, bulk=False), "deferred"))


@query(f"""WITH {_SCORES}, a AS (SELECT target, v.t AS label FROM cells WHERE bucket = 'annotations' AND "column" LIKE '%.label'), b AS (SELECT target, v.t AS who FROM cells WHERE "column" LIKE '%.updated_by'), t AS (SELECT target, v.t AS text FROM cells WHERE bucket = 'annotations' AND "column" LIKE '%.text')
SELECT target AS span_id, label, coalesce(text, 'author ' || who || ' at ' || (SELECT max(c.v.t) FROM cells c WHERE c.target = a.target AND c."column" LIKE '%.updated_at')) AS text FROM a LEFT JOIN b USING (target) LEFT JOIN t USING (target)""")
def annotation_records(spark: SparkSession, d: str) -> DataFrame:
    r = scores.annotation_records(_cells(spark, d)).select("span_id", F.explode("values").alias("v"))
    return r.select("span_id", "v.label", "v.text")


@query(f"WITH {_SCORES} SELECT min(id) AS id, count(*) AS copies FROM (SELECT id FROM sc UNION ALL SELECT id FROM sc WHERE kind = 'session') GROUP BY id")
def deduped_scores(spark: SparkSession, d: str) -> DataFrame:
    """Scores fetched by trace and by session again, one of each id kept; copies says how many there were."""
    s = fixtures.scores(spark, d)
    both = s.unionByName(s.where("kind = 'session'"))
    return readers.keep_first(both, "id", "at").join(both.groupBy("id").agg(F.count(F.lit(1)).alias("copies")), "id").select("id", "copies")


@query(f"WITH {_SCORES} SELECT id FROM sc WHERE kind <> 'dataset_run' AND subject_id IN (SELECT trace_id FROM obs WHERE seq % 10 = 0) OR kind = 'session' AND subject_id IN (SELECT session_id FROM obs WHERE seq % 500 = 0) OR kind = 'observation' AND subject_id IN (SELECT id FROM obs WHERE trace_id IN (SELECT trace_id FROM obs WHERE seq % 10 = 0))")
def scores_of_traces(spark: SparkSession, d: str) -> DataFrame:
    """Scores of some traces and sessions, whenever given."""
    s, o = fixtures.scores(spark, d), _obs(spark, d)
    by_trace = readers.scores_of(s, o.where("seq % 10 = 0"), "trace", "trace_id")
    by_session = readers.scores_of(s, o.where("seq % 500 = 0"), "session", "session_id")
    return readers.keep_first(by_trace.unionByName(by_session), "id", "at").select("id")


@query("SELECT CAST(ts AS DATE) AS day, count(*) AS rows FROM events GROUP BY 1", days=("day",))
def daily_counts(spark: SparkSession, d: str) -> DataFrame:
    return readers.daily_counts(fixtures.table(spark, d, "events"), "ts")


@query("SELECT min(day) AS earliest, max(day) AS latest, count(*) AS populated_days, CAST(sum(n) AS BIGINT) AS total FROM (SELECT CAST(ts AS DATE) AS day, count(*) AS n FROM events GROUP BY 1)", days=("earliest", "latest"))
def history_range(spark: SparkSession, d: str) -> DataFrame:
    return readers.history_range(daily_counts(spark, d))


@query("SELECT CAST(unnest(generate_series(min(ts)::DATE::TIMESTAMP, max(ts)::DATE::TIMESTAMP, INTERVAL 1 DAY)) AS DATE) AS day FROM events", days=("day",))
def day_windows(spark: SparkSession, d: str) -> DataFrame:
    return readers.day_windows(history_range(spark, d)).select("day")


@query("SELECT count(*) AS total, strftime(min(ts), '%Y-%m-%d %H:%M:%S') AS oldest, count(*) FILTER (WHERE ts < TIMESTAMP '2026-01-10 00:00:00' - INTERVAL 730 DAYS) AS too_old FROM events")
def retention_check(spark: SparkSession, d: str) -> DataFrame:
    now = F.lit("2026-01-10 00:00:00").cast("timestamp_ntz")
    return reconcile.retention(fixtures.table(spark, d, "events"), now, 2, "ts").withColumn("oldest", _when("oldest"))


@query("SELECT CAST(ts AS DATE) AS day, event_id, CAST((row_number() OVER (PARTITION BY CAST(ts AS DATE) ORDER BY event_id) - 1) // 50 AS BIGINT) AS batch FROM events", days=("day",))
def batches_by_rows(spark: SparkSession, d: str) -> DataFrame:
    e = fixtures.table(spark, d, "events").select(F.to_date("ts").alias("day"), "event_id")
    return batches.by_rows(e, "day", "event_id", 50)


@query("""WITH RECURSIVE e AS (SELECT CAST(ts AS DATE) AS day, event_id, CAST(floor(value) AS BIGINT) AS size, row_number() OVER (PARTITION BY CAST(ts AS DATE) ORDER BY event_id) AS n FROM events),
w AS (
  SELECT day, event_id, n, 0::BIGINT AS batch, 1 AS c, size AS total FROM e WHERE n = 1
  UNION ALL SELECT e.day, e.event_id, e.n, CASE WHEN w.c >= 50 OR w.total >= 600 THEN w.batch + 1 ELSE w.batch END, CASE WHEN w.c >= 50 OR w.total >= 600 THEN 1 ELSE w.c + 1 END, CASE WHEN w.c >= 50 OR w.total >= 600 THEN e.size ELSE w.total + e.size END FROM w JOIN e ON e.day = w.day AND e.n = w.n + 1)
SELECT day, event_id, batch FROM w""", days=("day",))
def batches_by_bytes(spark: SparkSession, d: str) -> DataFrame:
    e = fixtures.table(spark, d, "events").select(F.to_date("ts").alias("day"), "event_id", F.floor("value").alias("size"))
    return batches.by_bytes(e, "day", "event_id", "size", 50, 600)


@query("SELECT event_id, CAST((row_number() OVER (PARTITION BY CAST(ts AS DATE) ORDER BY event_id) - 1) % 8 AS INTEGER) AS shard FROM events")
def round_robin(spark: SparkSession, d: str) -> DataFrame:
    e = fixtures.table(spark, d, "events").select(F.to_date("ts").alias("day"), "event_id")
    return batches.round_robin(e, "event_id", 8, "day").select("event_id", "shard")


@query(f'WITH {_LEDGER} SELECT day, batches, submitted, uncertain, spans_submitted, complete FROM prog', days=("day",))
def ledger_progress(spark: SparkSession, d: str) -> DataFrame:
    return _shards(spark, d)


@query(f"WITH {_LEDGER} SELECT count(*) AS shards, count(*) FILTER (WHERE complete) AS complete, CAST(sum(spans_submitted) AS BIGINT) AS spans_submitted, count(*) FILTER (WHERE uncertain > 0) AS uncertain_shards FROM prog")
def migration_progress(spark: SparkSession, d: str) -> DataFrame:
    return batches.overall(_shards(spark, d))


@query(f'WITH {_LEDGER} SELECT day, batch, start, "end" FROM led ANTI JOIN (SELECT DISTINCT day FROM led WHERE status = \'uncertain\') u USING (day) WHERE status = \'pending\'', days=("day",))
def batches_to_send(spark: SparkSession, d: str) -> DataFrame:
    return batches.to_send(fixtures.ledger(spark, d)).select("day", "batch", "start", "end")


@query(f"""WITH {_LEDGER}, rd AS (SELECT CAST(start_time AS DATE) AS day, count(*) AS readable FROM obs WHERE seq % 97 <> 0 AND seq % 5 = 0 GROUP BY 1)
SELECT day, spans_submitted AS expected, coalesce(readable, 0) AS readable, spans_submitted - coalesce(readable, 0) AS missing FROM prog LEFT JOIN rd USING (day) WHERE spans_submitted > 0 AND coalesce(readable, 0) < spans_submitted""", days=("day",))
def expected_vs_readable(spark: SparkSession, d: str) -> DataFrame:
    there = _obs(spark, d).where("seq % 97 <> 0 AND seq % 5 = 0")
    return reconcile.shortfall(reconcile.expected_days(_shards(spark, d)), reconcile.rows_by_day(there, "start_time", "time"))


@query("SELECT CAST(ts AS DATE) AS day, 'e' || event_id % 100 AS span_id, count(*) AS copies FROM events GROUP BY 1, 2 HAVING count(*) > 1", days=("day",))
def duplicate_span_ids(spark: SparkSession, d: str) -> DataFrame:
    e = fixtures.table(spark, d, "events").select(F.to_date("ts").alias("day"), F.concat(F.lit("e"), (F.col("event_id") % 100).cast("string")).alias("span_id"))
    return writers.duplicate_ids(e)


@query("""SELECT user_id, CASE WHEN user_id % 7 = 0 THEN 'quick' WHEN age > 31 THEN 'bulk' WHEN user_id % 5 = 0 THEN 'bulk' WHEN n * 10000 < 830000 THEN 'quick' ELSE 'bulk' END AS path
FROM (SELECT user_id, count(*) AS n, date_diff('day', min(ts)::DATE, DATE '2024-02-03') AS age FROM events GROUP BY user_id)""")
def path_choice(spark: SparkSession, d: str) -> DataFrame:
    users = fixtures.table(spark, d, "events").groupBy("user_id").agg(F.count(F.lit(1)).alias("n"), F.date_diff(F.lit("2024-02-03").cast("date"), F.to_date(F.min("ts"))).alias("age"))
    chosen = F.when(F.col("user_id") % 7 == 0, "quick").otherwise("auto")
    return users.select("user_id", reconcile.path(chosen, F.when(F.col("user_id") % 5 != 0, F.col("n") * 10000), F.col("age")).alias("path"))


@query("""SELECT source AS dataset, doc_id AS item, CASE WHEN n_chars % 2 = 0 THEN 'language' ELSE 'input' END AS "column", CASE WHEN n_chars % 2 = 0 THEN lang ELSE 'plain' END AS cell FROM documents WHERE doc_id % 10 <> 0
UNION ALL SELECT source, doc_id, 'expected_output', CAST(n_chars AS VARCHAR) FROM documents WHERE doc_id % 10 <> 0 UNION ALL SELECT source, doc_id, 'metadata_source', source FROM documents WHERE doc_id % 10 <> 0
UNION ALL SELECT source, doc_id, 'source_item_id', CAST(doc_id AS VARCHAR) FROM documents WHERE doc_id % 10 <> 0""")
def dataset_examples(spark: SparkSession, d: str) -> DataFrame:
    docs = fixtures.table(spark, d, "documents")
    source = F.when(F.col("n_chars") % 2 == 0, F.to_json(F.struct(F.col("lang").alias("language")))).otherwise("plain")
    items = docs.select(F.col("source").alias("dataset"), F.col("doc_id").alias("id"), source.alias("input"), F.col("n_chars").cast("string").alias("expected"), F.to_json(F.struct("source")).alias("metadata"), F.when(F.col("doc_id") % 10 == 0, "ARCHIVED").alias("status"))
    return resources.dataset_examples(items).select("dataset", "item", F.explode("cells").alias("column", "cell"))


@query("SELECT conv_id, turn, list_filter([role, 'Latest', ' ', 'prod'], lambda x: trim(x) <> '' AND lower(trim(x)) <> 'latest') AS labels FROM conversations")
def prompt_labels(spark: SparkSession, d: str) -> DataFrame:
    t = fixtures.table(spark, d, "conversations")
    return t.select("conv_id", "turn", prompts.prompt_labels(F.array("role", F.lit("Latest"), F.lit(" "), F.lit("prod"))).alias("labels"))


@query("""SELECT p_partkey, CASE p_size % 6 WHEN 0 THEN 'OPEN_AI' WHEN 1 THEN 'ANTHROPIC' WHEN 2 THEN 'VERTEX_AI' WHEN 3 THEN 'AWS_BEDROCK' WHEN 4 THEN 'CUSTOM' ELSE 'OPEN_AI' END AS provider FROM part""")
def prompt_provider(spark: SparkSession, d: str) -> DataFrame:
    models = F.array(*[F.lit(m) for m in ("gpt-4", " Claude-3", "gemini-pro", "meta.llama", "llama", "O3-mini")])
    model = F.concat(F.element_at(models, (F.col("p_size") % 6 + 1).cast("int")), F.lit("-"), F.col("p_size").cast("string"))
    return fixtures.table(spark, d, "part").select("p_partkey", prompts.provider(model).alias("provider"))


@query("""SELECT p_partkey, CAST(p_size AS VARCHAR) AS top_k, CASE WHEN p_size % 2 = 0 THEN ['color', 'zone'] ELSE ['color'] END AS dropped FROM part""")
def invocation_split(spark: SparkSession, d: str) -> DataFrame:
    size = F.col("p_size").cast("string")
    config = F.concat(F.lit('{"model":"m","color":1,'), F.when(F.col("p_size") % 2 == 0, '"zone":2,').otherwise(""), F.lit('"top_k":'), size, F.lit(',"stop":null}'))
    taken, dropped = prompts.invocation_split(config)
    return fixtures.table(spark, d, "part").select("p_partkey", taken["top_k"].alias("top_k"), dropped.alias("dropped"))


@query("""WITH c AS (SELECT conv_id, max(turn) AS top FROM conversations GROUP BY conv_id)
SELECT conv_id, CASE WHEN top > 2 THEN 'no messages' WHEN top > 1 THEN 'empty body' END AS refusal FROM c""")
def prompt_refusals(spark: SparkSession, d: str) -> DataFrame:
    """Prompts whose last version is bad are refused as a whole."""
    tops = fixtures.table(spark, d, "conversations").groupBy("conv_id").agg(F.max("turn").alias("top"))
    v = tops.select(F.col("conv_id").cast("string").alias("name"), "conv_id", F.explode(F.sequence(F.lit(1).cast("long"), F.lit(2).cast("long"))).alias("version"), "top")
    bad = F.col("version") == 2
    body = F.when(bad & (F.col("top") > 2), "[]").when(bad & (F.col("top") > 1), "  ").otherwise("Hello {{name}}")
    rows = v.select("name", "version", body.alias("body"), (body == "[]").alias("is_list"), F.lit("{}").alias("config"), F.array(F.lit("latest")).alias("labels"), F.lit("").alias("message"))
    return resources.prompt_versions(rows).groupBy(F.col("name").cast("long").alias("conv_id")).agg(F.max("prompt_refusal").alias("refusal"))


@query("""SELECT p_partkey, CAST(i AS INTEGER) AS step, round(0.0 + i * (p_size / 10.0), 6) AS score, regexp_replace(regexp_replace(printf('%.4f', i * (p_size / 10.0)), '0+$', ''), '\\.$', '') AS label FROM part, range(11) r(i) WHERE p_size > 0""")
def choice_grid(spark: SparkSession, d: str) -> DataFrame:
    grid = prompts.numeric_choices(F.lit(0.0), F.col("p_size").cast("double"))
    return fixtures.table(spark, d, "part").where("p_size > 0").select("p_partkey", F.posexplode(grid).alias("step", "c")).select("p_partkey", "step", F.col("c.score").alias("score"), F.col("c.label").alias("label"))


@query("""SELECT conv_id, turn, 'Say {input} as {{' || role || '}} in {a.b}, {{}} and {{"k": 1}}' AS template, ['input', 'a.b'] AS variables FROM conversations""")
def mustache_convert(spark: SparkSession, d: str) -> DataFrame:
    text = F.concat(F.lit("Say {{ input }} as {"), F.col("role"), F.lit('} in {{a.b}}, {} and {"k": 1}'))
    return fixtures.table(spark, d, "conversations").select("conv_id", "turn", prompts.template(text).alias("template"), prompts.template_variables(text).alias("variables"))


@query("""SELECT n_name AS evaluator, 'input' AS variable, 'attributes.input.value' AS "column", NULL AS note FROM nation
UNION ALL SELECT n_name, 'reply', CASE n_regionkey WHEN 0 THEN 'attributes.output.value' WHEN 1 THEN 'attributes.metadata.a.b' WHEN 2 THEN NULL WHEN 3 THEN NULL ELSE 'attributes.metadata' END, CASE n_regionkey WHEN 2 THEN 'source has no column' WHEN 3 THEN 'unknown source' END FROM nation
UNION ALL SELECT n_name, 'other', NULL, 'unbound' FROM nation""")
def column_mapping(spark: SparkSession, d: str) -> DataFrame:
    n = fixtures.table(spark, d, "nation").select(F.col("n_name").alias("evaluator"), "n_regionkey")
    kind = F.element_at(F.array(*[F.lit(x) for x in ("output", "metadata", "tool_calls", "stars", "Metadata")]), F.col("n_regionkey") + 1)
    bindings = n.select("evaluator", F.lit("reply").alias("variable"), kind.alias("source"), F.when(F.col("n_regionkey") == 1, "$.a.b").alias("path"))
    wanted = n.select("evaluator", F.explode(F.array(F.lit("input"), F.lit("reply"), F.lit("other"))).alias("variable"))
    return resources.column_mappings(bindings, wanted)


@query("""WITH r AS (SELECT r_name AS rule, r_regionkey, n_nationkey, n_name FROM region JOIN nation ON n_regionkey = r_regionkey)
SELECT rule, CAST(n_nationkey AS BIGINT) AS evaluator, CASE WHEN r_regionkey <> 4 AND n_nationkey % 4 IN (0, 1) THEN 'x' || n_nationkey END AS created_id, r_regionkey / 10.0 AS sampling, r_regionkey % 2 = 0 AS continuous,
CASE WHEN r_regionkey = 4 THEN 'rule has a filter' WHEN n_nationkey % 4 = 3 THEN 'code evaluator' WHEN n_nationkey % 4 = 2 THEN 'not created' END AS note FROM r""")
def rule_task_plan(spark: SparkSession, d: str) -> DataFrame:
    n = fixtures.table(spark, d, "nation").select(F.col("n_nationkey").cast("long").alias("id"), "n_regionkey")
    held = n.groupBy("n_regionkey").agg(F.collect_list("id").alias("evaluator_ids"))
    rules = fixtures.table(spark, d, "region").join(held, F.col("r_regionkey") == F.col("n_regionkey")).select(F.col("r_name").alias("name"), F.when(F.col("r_regionkey") == 4, '[{"a":1}]').alias("filter"), (F.col("r_regionkey") / 10.0).alias("sampling"), (F.col("r_regionkey") % 2 == 0).alias("enabled"), "evaluator_ids")
    evaluators = n.select("id", F.when(F.col("id") % 4 == 3, "code").otherwise("llm_as_judge").alias("type"))
    created = n.where("id % 4 <> 2").select("id", F.concat(F.lit("x"), F.col("id").cast("string")).alias("created_id"))
    return resources.rule_tasks(rules, evaluators, created)


@query("""SELECT n_name AS source_name, n_name AS name, CASE n_regionkey % 3 WHEN 2 THEN 'continuous' ELSE 'categorical' END AS kind,
CASE WHEN n_regionkey = 0 THEN NULL WHEN n_regionkey = 1 THEN 'no labelled categories' WHEN n_regionkey = 2 THEN 'no bounds' END AS reason FROM nation""")
def score_configs(spark: SparkSession, d: str) -> DataFrame:
    unit = F.col("n_regionkey") % 3
    label = F.when(F.col("n_regionkey") == 1, " ").otherwise("good")
    configs = fixtures.table(spark, d, "nation").select(F.col("n_name").alias("name"), F.when(unit == 2, "NUMERIC").when(unit == 1, "BOOLEAN").otherwise("categorical").alias("data_type"), F.array(F.struct(label.alias("label"), F.lit(1.0).alias("value"))).alias("categories"), F.lit(0.0).alias("low"), F.lit(None).cast("double").alias("high"), F.lit("").alias("description"))
    return resources.score_configs(configs).select("source_name", "name", "kind", "reason")


@query("""SELECT n_name AS name, 'Rate {output}' || chr(10) || chr(10) || 'Respond with exactly one of: ' || CASE WHEN n_regionkey % 2 = 0 THEN 'true, false' ELSE 'good, bad' END AS template,
CASE WHEN n_regionkey = 3 THEN 'no integration' WHEN n_regionkey = 4 THEN 'not a judge' END AS refusal, CASE WHEN n_regionkey % 2 = 0 THEN 0.0 WHEN n_regionkey = 1 THEN 0.25 ELSE 0.0 END AS last_score FROM nation""")
def judge_payloads(spark: SparkSession, d: str) -> DataFrame:
    n = fixtures.table(spark, d, "nation")
    yes = F.col("n_regionkey") % 2 == 0
    provider = F.when(F.col("n_regionkey") == 3, "other").otherwise("OpenAI")
    null = F.lit(None).cast("double")
    evaluators = n.select(
        F.col("n_nationkey").alias("id"), F.col("n_name").alias("name"), F.when(F.col("n_regionkey") == 4, "code").otherwise("llm_as_judge").alias("type"), F.array(F.struct(F.lit("user").alias("role"), F.lit("Rate {{output}}").alias("content"))).alias("messages"),
        provider.alias("provider"), F.lit("m").alias("model"), F.when(yes, "BOOLEAN").otherwise("CATEGORICAL").alias("data_type"), F.array(F.lit("good"), F.lit("bad")).alias("categories"), null.alias("low"), null.alias("high"), F.lit("").alias("value_guidance"), F.lit(None).cast("string").alias("reason_guidance"),
    )
    configs = n.where("n_regionkey = 1").select(F.col("n_name").alias("name"), F.create_map(F.lit("good"), F.lit(1.0), F.lit("bad"), F.lit(0.25)).alias("scores"))
    made = resources.judges(evaluators, configs, names.parse_pairs(F.lit("openai=i1,x=")), None, None)
    return made.select("name", "template", "refusal", F.element_at("choices", -1)["score"].alias("last_score"))


@query("SELECT n_name AS name FROM nation WHERE n_name NOT IN (SELECT n_name FROM nation WHERE n_regionkey < 2)")
def skip_existing(spark: SparkSession, d: str) -> DataFrame:
    n = fixtures.table(spark, d, "nation").select(F.col("n_name").alias("name"), "n_regionkey")
    return resources.skip_existing(n, n.where("n_regionkey < 2")).select("name")


@query("""SELECT n_nationkey, 'Q' || n_nationkey || '-' || replace(n_name, ' ', '-') AS project, CASE WHEN n_nationkey % 2 = 0 THEN 'project not found' ELSE 'space not found' END AS reason, n_nationkey % 2 = 0 AS waits, 'sk-a…<' || (4 + length(n_name)) || ' chars>' AS secret FROM nation""")
def names_and_reasons(spark: SparkSession, d: str) -> DataFrame:
    n = fixtures.table(spark, d, "nation")
    what = F.when(F.col("n_nationkey") % 2 == 0, "project").otherwise("space")
    text = F.concat(F.lit("Error during update request:  Flight returned not found error, with message: "), what, F.lit(" not found. gRPC client debug context: {x}"))
    reason = names.error_reason(text)
    return n.select("n_nationkey", names.project_name(F.concat(F.lit(" --Q"), F.col("n_nationkey").cast("string"), F.lit(" / "), F.col("n_name"), F.lit("!"))).alias("project"), reason.alias("reason"), names.not_yet_indexed(reason).alias("waits"), names.redacted(F.concat(F.lit("sk-a"), "n_name")).alias("secret"))


from spanlake import catalog_records, catalog_runs, catalog_transfer, catalog_varied  # noqa: E402, F401  they register their queries

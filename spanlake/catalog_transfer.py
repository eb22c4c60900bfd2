"""Queries over the log of batches, their fingerprints, what is left to apply, and the data sources."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from spanlake.catalog import _LEDGER, _OBS, _ROOT, _SCORES, _SPAN, _TOPS, _anchors, _cells, _obs, query
from spanlake.catalog_runs import _FIELD, _SPANS, _built
from spanlake.operators import batches, scores, sketches, spans
from spanlake.plans import run, tables
from spanlake.plans.run import deferred_cells
from spanlake.sources import fixtures, pages, readers, scratch, sink, writers

#: A window that starts and ends within days.
LOW, HIGH = "2024-01-05 06:00:00", "2024-01-09 12:30:00"
BATCH = 50


def _log(spark: SparkSession, d: str) -> DataFrame:
    """What happened to the batches of the test ledger: made, some sent, some in doubt, and every eleventh day withdrawn and made anew."""
    own = fixtures.ledger(spark, d)
    again = F.dayofmonth("day") % 11 == 0
    steps = F.when(F.col("status") == batches.SUBMITTED, F.array(*[F.lit(x) for x in ("start", "success")])).when(F.col("status") == batches.UNCERTAIN, F.array(F.lit("start"), F.lit("ambiguous"))).otherwise(F.array(F.lit("start"), F.lit("rejected")))
    story = F.concat(F.array(F.lit("made")), F.when(again, F.array(F.lit("withdrawn"), F.lit("made"))).otherwise(F.array().cast("array<string>")), F.when(F.col("batch") % 2 == 0, steps).otherwise(F.array().cast("array<string>")))
    after = F.element_at(F.create_map(*[F.lit(x) for p in {"made": "pending", "withdrawn": "withdrawn", "start": "uncertain", "success": "submitted", "ambiguous": "uncertain", "rejected": "pending"}.items() for x in p]), F.col("event"))
    told = own.select("day", "batch", "start", "end", F.posexplode(story).alias("at", "event"))
    made = lambda c: F.when(F.col("event") == "made", c)
    return told.select("day", "batch", (F.col("batch") * 10 + F.col("at")).alias("seq"), "event", after.alias("status"), made(F.col("start") * 10 + F.col("at")).alias("start"), made(F.col("end") * 10 + F.col("at")).alias("end"), made(F.col("end") - F.col("start")).alias("rows"), F.lit(None).cast("string").alias("checksum"), F.lit(None).cast("array<string>").alias("files"))


@query(f"""WITH {_LEDGER}, p AS (SELECT *, CASE WHEN day_of_month % 11 = 0 THEN 2 ELSE 0 END AS stp FROM led)
SELECT day, batch, start * 10 + stp AS start, "end" * 10 + stp AS "end", "end" - start AS rows, CASE WHEN batch % 2 = 1 THEN 'pending' ELSE status END AS status FROM p""", days=("day",))
def ledger_states(spark: SparkSession, d: str) -> DataFrame:
    """States of batches from the log of their events."""
    return batches.states(_log(spark, d)).select("day", "batch", "start", "end", "rows", "status")


@query(f"""WITH {_LEDGER} SELECT DISTINCT day FROM led WHERE day_of_month % 4 <> 0 OR NOT EXISTS (SELECT 1 FROM led l WHERE l.day = led.day AND l.status = 'uncertain' AND l.batch % 2 = 0)""", days=("day",))
def days_without_doubt(spark: SparkSession, d: str) -> DataFrame:
    """Days none of whose batches is uncertain after all that happened."""
    states = batches.states(_log(spark, d))
    return states.select("day").distinct().join(states.where(F.col("status") == batches.UNCERTAIN).select("day"), "day", "left_anti")


@query(f"""WITH {_LEDGER}, w AS (SELECT * FROM led WHERE day_of_month % 11 <> 0) SELECT day, batch, start, "end", CASE WHEN batch % 2 = 1 THEN 'pending' ELSE status END AS status FROM (SELECT day, batch, start * 10 AS start, "end" * 10 AS "end", status FROM w)""", days=("day",))
def withdrawn_days(spark: SparkSession, d: str) -> DataFrame:
    """States after every eleventh day was withdrawn once more."""
    log = _log(spark, d)
    gone = log.select("day").distinct().where(F.dayofmonth("day") % 11 == 0)
    return batches.states(log.unionByName(tables.withdraw(log, gone))).select("day", "batch", "start", "end", "status")


@query(f"""WITH {_TOPS}, sp AS (
  SELECT CAST(o.start_time AS DATE) AS day, {_SPAN("o.id")} AS span_id, CASE WHEN o.parent_id IS NULL THEN CASE WHEN r.made_up THEN r.root_id END ELSE {_SPAN("o.parent_id")} END AS parent_id, o.name FROM obs o JOIN roots r USING (trace_id)
  UNION ALL SELECT CAST(start_time AS DATE), {_ROOT("trace_id")}, NULL, name FROM roots WHERE made_up),
b AS (SELECT *, (row_number() OVER (PARTITION BY day ORDER BY span_id) - 1) // {BATCH} AS batch FROM sp)
SELECT day, CAST(batch AS BIGINT) AS batch, count(*) AS rows, CAST(sum(CAST('0x' || substr(md5(concat_ws(',', {_FIELD("name")}, {_FIELD("parent_id")}, {_FIELD("span_id")}, '')), 1, 15) AS BIGINT)) AS VARCHAR) AS checksum FROM b GROUP BY day, batch""", days=("day",))
def batch_fingerprints(spark: SparkSession, d: str) -> DataFrame:
    """Rows and checksum of each batch of spans: ids, parents and names."""
    cut = batches.by_rows(_built(spark, d).select("day", "span_id", "parent_id", "name"), "day", "span_id", BATCH)
    return writers.fingerprint(cut, "day", "batch")


@query(f"""WITH {_SCORES}, {_SPANS}, pc AS (SELECT bucket, coalesce(anchor, target) AS target, "column", v, day FROM cells LEFT JOIN anchors ON bucket = 'session_evals' AND target = session_id JOIN sp ON coalesce(anchor, target) = span_id)
SELECT day, bucket, target, "column", CAST(v.n AS DOUBLE) AS number, v.t AS text FROM pc WHERE NOT (bucket = 'annotations' AND day(day) % 2 = 0)""", days=("day",))
def cells_to_apply(spark: SparkSession, d: str) -> DataFrame:
    """Deferred cells that are left when the annotations of every other day are in the log."""
    frames = deferred_cells(scores.placed(_cells(spark, d), _built(spark, d), _anchors(spark, d)), bulk=False)
    log = frames.where((F.col("bucket") == "annotations") & (F.dayofmonth("day") % 2 == 0)).select(scores.cell_digest().alias("digest"))
    return scores.to_apply(frames, log).select("day", "bucket", "target", "column", "number", "text")


@query(f"""WITH {_SCORES}, {_SPANS}, pc AS (SELECT bucket, day FROM cells LEFT JOIN anchors ON bucket = 'session_evals' AND target = session_id JOIN sp ON coalesce(anchor, target) = span_id)
SELECT bucket, day(day) % 2 = 0 AND bucket = 'annotations' AS applied, count(*) AS cells FROM pc GROUP BY ALL""")
def merged_plan(spark: SparkSession, d: str) -> DataFrame:
    """Deferred cells of all days in one plan, by what became of them; the log tells some lines twice."""
    frames = deferred_cells(scores.placed(_cells(spark, d), _built(spark, d), _anchors(spark, d)), bulk=False)
    log = frames.where((F.col("bucket") == "annotations") & (F.dayofmonth("day") % 2 == 0)).select(scores.cell_digest().alias("digest"))
    return scores.plan(frames, log.unionByName(log)).groupBy("bucket", "applied").agg(F.count(F.lit(1)).alias("cells"))


@query(f"""WITH {_SCORES}, {_SPANS}, t AS (SELECT DISTINCT day, target FROM cells JOIN sp ON target = span_id WHERE bucket = 'annotations')
SELECT day, target, CAST((row_number() OVER (PARTITION BY day ORDER BY target) - 1) // {BATCH} AS BIGINT) AS chunk FROM t""", days=("day",))
def annotation_calls(spark: SparkSession, d: str) -> DataFrame:
    """The call of each annotated span: so many spans of a day in one."""
    frames = deferred_cells(scores.placed(_cells(spark, d), _built(spark, d), _anchors(spark, d)), bulk=True)
    return scores.chunked(frames, BATCH).select("day", "target", "chunk").distinct()


@query(f"""SELECT 'e' || event_id AS id, strftime(ts, '%Y-%m-%d %H:%M:%S') AS started, 'u' || user_id || '-' || strftime(ts, '%Y%m%d') AS trace_id, event_type AS name, props AS metadata FROM events WHERE ts >= TIMESTAMP '{LOW}' AND ts < TIMESTAMP '{HIGH}' AND event_type = 'click'""")
def pages_in_window(spark: SparkSession, d: str) -> DataFrame:
    """Observations written as pages of JSON, and read back by a window and a name that reach the source."""
    pages.register(spark)
    path = scratch.shared(spark, "pages")
    pages.write_pages(_obs(spark, d).select("id", "trace_id", "name", "metadata", "start_time"), path)
    read = spark.read.format(pages.FORMAT).option("fields", "core,metadata").load(path)
    at = [F.lit(datetime.fromisoformat(x)) for x in (LOW, HIGH)]
    return read.where((F.col("start_time") >= at[0]) & (F.col("start_time") < at[1]) & (F.col("name") == "click")).select("id", F.date_format("start_time", "yyyy-MM-dd HH:mm:ss").alias("started"), "trace_id", "name", "metadata")


@query("""SELECT CAST(ts AS DATE) AS day, count(*) AS rows, count(*) FILTER (WHERE event_type = 'error') AS errors FROM events GROUP BY 1""", days=("day",))
def sent_once(spark: SparkSession, d: str) -> DataFrame:
    """Batches written as transactions, one of them twice, and read back: each row counts once."""
    sink.register(spark)
    path = scratch.shared(spark, "sent")
    rows = _obs(spark, d).select(F.to_date("start_time").alias("day"), "id", "level")
    error = F.col("level") == "ERROR"
    for batch, part in (("errors", rows.where(error)), ("others", rows.where(~error)), ("errors", rows.where(error))):
        part.write.format(sink.FORMAT).option("path", path).option("batch", batch).mode("append").save()
    return spark.read.format(sink.FORMAT).load(path).groupBy("day").agg(F.count(F.lit(1)).alias("rows"), F.count_if(error).alias("errors"))


@query(f"""WITH {_OBS} SELECT CAST(date_trunc('week', start_time) AS DATE) AS week, count(*) AS rows, count(DISTINCT trace_id) AS traces, true AS near, true AS near_median, true AS near_high FROM obs GROUP BY 1""", days=("week",))
def week_sketches(spark: SparkSession, d: str) -> DataFrame:
    """Weeks from the sketches of their days: whether estimates are as near to the exact numbers as is stated."""
    rows = spans.by_day(_obs(spark, d))
    week = F.to_date(F.date_trunc("week", "day")).alias("week")
    merged = sketches.of_ranges(sketches.of_days(rows), week).select("week", sketches.distinct().alias("found"), sketches.quantile(0.5).alias("median"), sketches.quantile(0.95).alias("high"))
    told = rows.select(week, "trace_id", sketches.duration().alias("took")).join(merged, "week")
    below = lambda c, share: (F.count_if(F.col("took") < F.col(c)) <= (share + 0.01) * F.count("took")) & (F.count_if(F.col("took") <= F.col(c)) >= (share - 0.01) * F.count("took"))
    exact = told.groupBy("week").agg(F.count(F.lit(1)).alias("rows"), F.count_distinct("trace_id").alias("traces"), F.first("found").alias("found"), below("median", 0.5).alias("near_median"), below("high", 0.95).alias("near_high"))
    return exact.select("week", "rows", "traces", (F.abs(F.col("found") - F.col("traces")) <= 0.03 * F.col("traces") + 1).alias("near"), "near_median", "near_high")


@query(f"""WITH {_SCORES}, w AS (SELECT target, max(v.t) FILTER (WHERE "column" = 'eval.event_type.label') AS label, max(v.n) FILTER (WHERE "column" = 'trace_eval.quality.score') AS quality,
  list(DISTINCT "column" ORDER BY "column") FILTER (WHERE "column" NOT IN (SELECT "column" FROM (SELECT "column", count(DISTINCT target) AS n FROM cells WHERE bucket = 'evals' GROUP BY 1 ORDER BY n DESC, "column" LIMIT 3))) AS others FROM cells WHERE bucket = 'evals' GROUP BY target)
SELECT target, label, CASE WHEN list_contains(others, 'trace_eval.quality.score') THEN NULL ELSE quality END AS quality, CASE WHEN list_contains(others, 'trace_eval.quality.score') THEN quality END AS rest_quality, CAST(coalesce(len(others), 0) AS BIGINT) AS others FROM w""")
def found_columns(spark: SparkSession, d: str) -> DataFrame:
    """Evaluations as a table that finds its three columns itself; the others are in a VARIANT."""
    table = scores.wide(_cells(spark, d).where("bucket = 'evals'"), 3)
    column = lambda c, kind: F.col(f"`{c}`") if c in table.columns else F.lit(None).cast(kind)
    rest = F.map_keys(F.try_variant_get("rest", "$", "map<string,variant>"))
    return table.select("target", column("eval.event_type.label", "string").alias("label"), column("trace_eval.quality.score", "double").alias("quality"), F.try_variant_get("rest", "$['trace_eval.quality.score'].number", "double").alias("rest_quality"), F.coalesce(F.size(rest), F.lit(0)).cast("long").alias("others"))


@query("""WITH j AS (SELECT event_id, json_extract_string(props, '$.k') AS k, event_type FROM events)
SELECT event_id, 'k' AS name, k AS text, NULL AS list FROM j WHERE k IS NOT NULL UNION ALL SELECT event_id, 'tags', NULL, [event_type, CAST(event_id AS VARCHAR), 'true'] FROM j
UNION ALL SELECT event_id, 'deep.x.y', CAST(event_id * 2 AS VARCHAR), NULL FROM j WHERE event_id % 3 = 0 UNION ALL SELECT event_id, 'deep.mix', '[1,{"a":' || event_id || '}]', NULL FROM j WHERE event_id % 3 = 0 UNION ALL SELECT event_id, 'deep', event_type, NULL FROM j WHERE event_id % 3 = 1""")
def attribute_leaves(spark: SparkSession, d: str) -> DataFrame:
    """Leaves of objects whose parts differ from row to row; lists of scalars stay lists."""
    e, number = fixtures.table(spark, d, "events"), F.col("event_id").cast("string")
    deep = F.when(F.col("event_id") % 3 == 0, F.concat(F.lit('{"x":{"y":'), (F.col("event_id") * 2).cast("string"), F.lit(',"none":null},"mix":[1,{"a":'), number, F.lit('}],"empty":[]}'))).when(F.col("event_id") % 3 == 1, F.concat(F.lit('"'), F.col("event_type"), F.lit('"'))).otherwise("null")
    json = F.concat(F.lit('{"k":'), F.coalesce(F.get_json_object("props", "$.k"), F.lit("null")), F.lit(',"tags":["'), F.col("event_type"), F.lit('",'), number, F.lit(',true],"deep":'), deep, F.lit("}"))
    return spans.leaves(e.select("event_id", json.alias("json")), "json", "event_id")


@query(f"""WITH {_TOPS}, t AS (SELECT trace_id AS id, 'rec ' || min(seq) AS name, min(start_time) - INTERVAL 5 MINUTES AS at FROM obs GROUP BY trace_id HAVING min(seq) % 3 = 0)
SELECT r.trace_id, r.made_up OR t.id IS NOT NULL AS made_up, CASE WHEN r.made_up OR t.id IS NOT NULL THEN {_ROOT("r.trace_id")} ELSE r.root_id END AS root_id, CASE WHEN t.id IS NULL THEN r.name WHEN split_part(t.name, ' ', 2)::BIGINT % 2 = 0 THEN t.name ELSE 'trace' END AS name,
  strftime(coalesce(t.at, r.start_time), '%Y-%m-%d %H:%M:%S') AS started FROM roots r LEFT JOIN t ON t.id = r.trace_id""")
def record_roots(spark: SparkSession, d: str) -> DataFrame:
    """Roots where some traces have a record of their own, with a name or a blank one."""
    o = _obs(spark, d)
    first = o.groupBy(F.col("trace_id").alias("id")).agg(F.min("seq").alias("m"), F.min("start_time").alias("at")).where("m % 3 = 0")
    records = first.select("id", F.when(F.col("m") % 2 == 0, F.concat(F.lit("rec "), F.col("m").cast("string"))).otherwise("").alias("name"), (F.col("at") - F.expr("INTERVAL 5 MINUTES")).alias("timestamp"))
    return spans.roots(o, traces=records).select("trace_id", "made_up", "root_id", "name", F.date_format("start_time", "yyyy-MM-dd HH:mm:ss").alias("started"))


def _source(spark: SparkSession, d: str) -> readers.Source:
    """The test tables as files of records, below the shared folder."""
    path = scratch.shared(spark, "source")
    _obs(spark, d).drop("seq").write.parquet(f"{path}/observations")
    fixtures.scores(spark, d).withColumn("at", F.timestamp_seconds("at")).write.parquet(f"{path}/scores")
    return readers.source("files", spark, path)


_EXPORTED = f"""{_SCORES}, {_SPANS}, pc AS (SELECT bucket, target, day FROM cells LEFT JOIN anchors ON bucket = 'session_evals' AND target = session_id JOIN sp ON coalesce(anchor, target) = span_id),
ex AS (SELECT day, count(*) AS spans, CAST(ceil(count(*) / 200.0) AS BIGINT) AS batches FROM sp GROUP BY day), cc AS (SELECT day, count(*) FILTER (WHERE bucket <> 'annotations') AS riding, count(*) FILTER (WHERE bucket = 'annotations') AS deferred FROM pc GROUP BY day)"""


@query(f"WITH {_EXPORTED} SELECT day, batches, spans, coalesce(riding, 0) AS riding, coalesce(deferred, 0) AS deferred FROM ex LEFT JOIN cc USING (day)", days=("day",))
def exported_days(spark: SparkSession, d: str) -> DataFrame:
    """What an export of all days wrote, as its ledger and its files say."""
    target = scratch.shared(spark, "exported")
    done = run.export(_source(spark, d), target, datetime(2025, 1, 1), batch_rows=200)
    told = run.read_ledger(spark, target).groupBy("day").agg(F.count(F.lit(1)).alias("batches"), F.sum("rows").alias("spans"))
    riding = done["spans"].groupBy("day").agg(F.sum(F.size("evals")).cast("long").alias("riding"))
    frames = spark.read.parquet(f"{target}/frames").groupBy("day").agg(F.count(F.lit(1)).alias("deferred"))
    return told.join(riding, "day").join(frames, "day", "left").fillna(0, ["deferred"])


@query(f"WITH {_SCORES} SELECT id, count(*) AS copies FROM (SELECT id FROM sc JOIN (SELECT DISTINCT trace_id FROM obs WHERE seq % 10 = 0) t ON CASE kind WHEN 'trace' THEN subject_id WHEN 'observation' THEN (SELECT any_value(trace_id) FROM obs o WHERE o.id = subject_id) END = t.trace_id UNION ALL SELECT id FROM sc WHERE kind = 'session' AND subject_id IN (SELECT session_id FROM obs WHERE seq % 500 = 0)) GROUP BY id")
def scores_about_both(spark: SparkSession, d: str) -> DataFrame:
    """Scores of some traces and sessions in one look, and how often each was met."""
    o = _obs(spark, d)
    met = readers.scores_about(fixtures.scores(spark, d), o.where("seq % 10 = 0"), o.where("seq % 500 = 0"))
    return met.groupBy("id").agg(F.count(F.lit(1)).alias("copies"))

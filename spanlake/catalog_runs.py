"""Queries over shards, ledgers, deferred scores and whole resource families."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from spanlake.catalog import _LEDGER, _OBS, _ROOT, _SCORES, _SPAN, _TOPS, _anchors, _cells, _obs, _shards, _when, query, rule_task_plan, score_configs
from spanlake.operators import batches, resources, scores, spans
from spanlake.plans.run import deferred_cells
from spanlake.sources import fixtures, readers, writers

_SPANS = f"""sp AS (SELECT {_SPAN("id")} AS span_id, CAST(start_time AS DATE) AS day, start_time FROM obs UNION ALL SELECT root_id, CAST(start_time AS DATE), start_time FROM roots WHERE made_up)"""


def _built(spark: SparkSession, d: str) -> DataFrame:
    return spans.by_day(spans.assemble(_obs(spark, d)))


@query(f"""WITH {_OBS} SELECT CAST(start_time AS DATE) AS day, count(*) AS spans, count(DISTINCT trace_id) AS traces, strftime(min(start_time), '%Y-%m-%d %H:%M:%S') AS first_start,
strftime(max(coalesce(end_time, start_time)), '%Y-%m-%d %H:%M:%S') AS last_end FROM obs GROUP BY 1""", days=("day",))
def shard_stats(spark: SparkSession, d: str) -> DataFrame:
    """Spans, traces and time range of each day."""
    return batches.statistics(spans.by_day(_obs(spark, d))).withColumns({"first_start": _when("first_start"), "last_end": _when("last_end")})


@query(f"WITH {_SCORES} SELECT reason, count(*) AS scores FROM cs WHERE reason IS NOT NULL GROUP BY ROLLUP (reason)")
def skipped_totals(spark: SparkSession, d: str) -> DataFrame:
    """Scores without a place, by reason and in all."""
    return scores.skipped_by_reason(scores.classify(fixtures.scores(spark, d), spans.roots(_obs(spark, d))))


@query(f'WITH {_SCORES} SELECT bucket, "column", count(*) AS targets FROM cells GROUP BY ALL')
def eval_columns(spark: SparkSession, d: str) -> DataFrame:
    return scores.columns_of(_cells(spark, d))


@query(f"WITH {_OBS} SELECT trace_id, CAST((row_number() OVER (ORDER BY trace_id) - 1) // 40 AS BIGINT) AS chunk FROM (SELECT DISTINCT trace_id FROM obs)")
def score_chunks(spark: SparkSession, d: str) -> DataFrame:
    """Trace ids in chunks of 40."""
    return batches.chunks(_obs(spark, d).select("trace_id").distinct(), "trace_id", 40)


@query(f"""WITH {_SCORES}, {_SPANS}, e AS (SELECT target, count(*) AS n, min("column") AS first FROM cells WHERE bucket = 'evals' GROUP BY target)
SELECT span_id, coalesce(n, 0) AS evals, first FROM sp LEFT JOIN e ON target = span_id""")
def evals_riding(spark: SparkSession, d: str) -> DataFrame:
    """Spans with the evaluations that travel with them."""
    rows = scores.riding(_built(spark, d), _cells(spark, d).where("bucket = 'evals'"))
    return rows.select("span_id", F.size("evals").cast("long").alias("evals"), F.try_element_at("evals", F.lit(1))["column"].alias("first"))


@query(f"""WITH {_SCORES}, {_SPANS}, pc AS (SELECT bucket, day FROM cells LEFT JOIN anchors ON bucket = 'session_evals' AND target = session_id JOIN sp ON coalesce(anchor, target) = span_id)
SELECT day, bucket, count(*) AS cells, strftime(CAST(day AS TIMESTAMP) - INTERVAL 1 HOUR, '%Y-%m-%d %H:%M:%S') AS window_start, strftime(CAST(day AS TIMESTAMP) + INTERVAL 25 HOUR, '%Y-%m-%d %H:%M:%S') AS window_end
FROM pc WHERE day(day) % 3 <> 0 GROUP BY day, bucket""", days=("day",))
def pending_frames(spark: SparkSession, d: str) -> DataFrame:
    """Deferred cells of days that aren't applied yet, with the windows of their days."""
    built = _built(spark, d)
    frames = deferred_cells(scores.placed(_cells(spark, d), built, _anchors(spark, d)), bulk=False)
    applied = built.select("day").distinct().where(F.dayofmonth("day") % 3 == 0)
    left = scores.pending(frames, applied)
    return left.groupBy("day", "bucket").agg(F.count(F.lit(1)).alias("cells"), F.min("window_start").alias("window_start"), F.max("window_end").alias("window_end")).withColumns({c: _when(c) for c in ("window_start", "window_end")})


@query(f"WITH {_LEDGER} SELECT DISTINCT day FROM led WHERE day(day) % 2 = 1", days=("day",))
def rebuilt_days(spark: SparkSession, d: str) -> DataFrame:
    """Exported days without deferred frames."""
    ledger = fixtures.ledger(spark, d)
    return scores.without_frames(ledger, ledger.where(F.dayofmonth("day") % 2 == 0))


@query(f"WITH {_SCORES}, {_SPANS} SELECT DISTINCT target FROM cells WHERE bucket = 'evals' AND target NOT IN (SELECT span_id FROM sp WHERE start_time >= TIMESTAMP '2024-02-10 00:00:00' - INTERVAL 31 DAYS)")
def unmatched_targets(spark: SparkSession, d: str) -> DataFrame:
    """Targets of evaluations that late updates can't reach."""
    return scores.unmatched(_cells(spark, d).where("bucket = 'evals'"), _built(spark, d), F.lit("2024-02-10 00:00:00").cast("timestamp"))


@query(f"WITH {_SCORES} SELECT target AS span_id, CAST((row_number() OVER (ORDER BY target) - 1) // 50 AS BIGINT) AS chunk FROM (SELECT DISTINCT target FROM cells WHERE bucket = 'annotations')")
def annotation_chunks(spark: SparkSession, d: str) -> DataFrame:
    """Records of annotations in chunks of 50."""
    return batches.chunks(scores.annotation_records(_cells(spark, d)), "span_id", 50).select("span_id", "chunk")


@query("""SELECT 'score_configs' AS family, CASE WHEN n_regionkey IN (1, 2) THEN 'failed' WHEN n_nationkey % 5 = 0 THEN 'skipped' ELSE 'created' END AS outcome, count(*) AS resources FROM nation GROUP BY 2
UNION ALL SELECT 'rules', CASE WHEN n_regionkey = 4 OR n_nationkey % 4 IN (2, 3) THEN 'failed' ELSE 'created' END, count(*) FROM nation GROUP BY 2""")
def resource_report(spark: SparkSession, d: str) -> DataFrame:
    """What becomes of resources, by family and outcome."""
    there = fixtures.table(spark, d, "nation").where("n_nationkey % 5 = 0").select(F.col("n_name").alias("name"))
    configs = resources.outcomes("score_configs", score_configs(spark, d), "source_name", F.col("reason"), there)
    rules = resources.outcomes("rules", rule_task_plan(spark, d), "rule", F.col("note"))
    return resources.report(configs.unionByName(rules))


@query(f"WITH {_TOPS} SELECT CAST(start_time AS DATE) AS day, trace_id, made_up, root_id FROM roots", days=("day",))
def day_roots(spark: SparkSession, d: str) -> DataFrame:
    """Roots of the parts that days have of traces."""
    return spans.roots(spans.by_day(_obs(spark, d)), per=("day", "trace_id")).select("day", "trace_id", "made_up", "root_id")


@query(f"""WITH {_TOPS} SELECT CAST(start_time AS DATE) AS day, session_id, root_id AS anchor FROM roots""", days=("day",))
def day_anchors(spark: SparkSession, d: str) -> DataFrame:
    """The anchor of each session on each day."""
    o = spans.by_day(_obs(spark, d))
    return spans.session_anchors(o, spans.roots(o, per=("day", "trace_id")), per=("day",))


@query(f"""WITH {_LEDGER}, ds AS (SELECT CAST(unnest(generate_series(min(day)::TIMESTAMP, max(day)::TIMESTAMP, INTERVAL 1 DAY)) AS DATE) AS day FROM prog)
SELECT day FROM ds WHERE day NOT IN (SELECT day FROM prog WHERE complete)""", days=("day",))
def days_to_export(spark: SparkSession, d: str) -> DataFrame:
    """Days of the history that no complete shard has."""
    windows = readers.day_windows(readers.history_range(readers.daily_counts(_obs(spark, d), "start_time")))
    return batches.days_left(windows, _shards(spark, d)).select("day")


@query(f"""WITH {_OBS} SELECT day, seq, 1::BIGINT AS batch FROM (SELECT CAST(start_time AS DATE) AS day, seq, row_number() OVER (PARTITION BY CAST(start_time AS DATE) ORDER BY seq) - 1 AS n FROM obs) WHERE n >= {fixtures.LEDGER_BATCH} AND n < {2 * fixtures.LEDGER_BATCH}""", days=("day",))
def batch_ranges(spark: SparkSession, d: str) -> DataFrame:
    """The rows of each day's second batch, by its range in the ledger."""
    rows = spans.by_day(_obs(spark, d)).select("day", "seq")
    return batches.rows_of(rows, fixtures.ledger(spark, d).where("batch = 1"), "day", "seq").select("day", "seq", "batch")


@query("SELECT n_nationkey AS shard FROM nation WHERE NOT (n_regionkey = 1 AND n_nationkey % 2 = 0)")
def binding_conflicts(spark: SparkSession, d: str) -> DataFrame:
    """Shards that belong to another source or project."""
    n = fixtures.table(spark, d, "nation")
    bound = n.select(F.col("n_nationkey").alias("shard"), F.concat(F.lit("s"), F.col("n_regionkey").cast("string")).alias("source"), F.when(F.col("n_nationkey") % 2 == 0, "p").alias("project"))
    return batches.conflicts(bound, "s1", "p").select("shard")


_FIELD = lambda c: f"CASE WHEN {c} IS NULL THEN 'n' ELSE length({c}) || ':' || {c} END"


@query(f"""WITH {_TOPS}, sp AS (
  SELECT CAST(o.start_time AS DATE) AS day, {_SPAN("o.id")} AS span_id, CASE WHEN o.parent_id IS NULL THEN CASE WHEN r.made_up THEN r.root_id END ELSE {_SPAN("o.parent_id")} END AS parent_id, o.name FROM obs o JOIN roots r USING (trace_id)
  UNION ALL SELECT CAST(start_time AS DATE), {_ROOT("trace_id")}, NULL, name FROM roots WHERE made_up)
SELECT day, count(*) AS rows, CAST(sum(CAST('0x' || substr(md5(concat_ws(',', {_FIELD("name")}, {_FIELD("parent_id")}, {_FIELD("span_id")}, '')), 1, 15) AS BIGINT)) AS VARCHAR) AS checksum FROM sp GROUP BY day""", days=("day",))
def day_fingerprints(spark: SparkSession, d: str) -> DataFrame:
    """Rows and checksum of each day's spans: ids, parents and names."""
    return writers.fingerprint(_built(spark, d).select("day", "span_id", "parent_id", "name"), "day")

from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from spanlake.functions import ids
from spanlake.operators import batches, reconcile, resources, scores, spans
from spanlake.plans import cli, run, settings
from spanlake.sources import readers, writers
from spanlake.streaming import daily

T = datetime(2024, 1, 1, 10)
OBS = "id string, trace_id string, parent_id string, name string, type string, start_time timestamp, end_time timestamp, session_id string, metadata string"


def obs(spark, *rows):
    return spark.createDataFrame([(i, t, p, n, "SPAN", T + timedelta(minutes=m), None, s, None) for i, t, p, n, m, s in rows], OBS)


@pytest.fixture
def three(spark):
    return obs(spark, ("a", "one", None, "top", 0, "s"), ("b", "one", "a", None, 1, "s"), ("c", "two", None, "x", 2, "s"), ("d", "two", "", "y", 3, None), ("e", "none", "gone", "z", 4, None))


def test_roots(spark, three):
    r = {x.trace_id: x for x in spans.roots(three).collect()}
    assert [r[k].made_up for k in ("one", "two", "none")] == [False, True, True]
    assert (r["one"].name, r["two"].name, r["none"].name) == ("top", "x", "z")
    assert r["two"].end_time == T + timedelta(minutes=3)


def test_assemble(spark, three):
    tree = {x.span_id: x.parent_id for x in spans.assemble(three).collect()}
    row = spark.range(1).select(*[ids.span_id(F.lit(x)).alias(x) for x in "abcde"], ids.root_span_id(F.lit("two")).alias("two"), ids.root_span_id(F.lit("none")).alias("none"), ids.span_id(F.lit("gone")).alias("gone")).first()
    assert tree == {row.a: None, row.b: row.a, row.c: row.two, row.d: row.two, row.two: None, row.e: row.gone, row.none: None}
    again = {x.span_id: x.parent_id for x in spans.assemble(three, reattach_orphans=True).collect()}
    assert again[row.e] == row.none


def test_rejects(spark):
    rows = spark.createDataFrame([("a", None, None, "", "SPAN", T, None, None, None), ("b", "t", None, "", "SPAN", None, None, None, None), ("c", "t", None, "", "SPAN", T, None, None, '{"provenance":1}'), ("d", "t", None, "", "SPAN", T, None, None, "{}")], OBS)
    good, bad = spans.split(rows)
    assert [r.id for r in good.collect()] == ["d"] and {r.reason for r in bad.collect()} == {"no trace id", "no start time", "metadata uses a reserved key"}


def test_wide_rejects_backward_times(spark, three):
    late = spans.assemble(three).withColumn("end_time", F.lit(T - timedelta(days=1)))
    rows, bad = spans.wide(late)
    assert rows.count() == 0 and bad.count() == 7


def test_anchor(spark, three):
    tops = spans.roots(three)
    assert [(r.session_id, r.anchor) for r in spans.session_anchors(three, tops).collect()] == [("s", tops.where("trace_id = 'one'").first().root_id)]


SCORE = "id string, name string, data_type string, value_number double, value_text string, comment string, source string, kind string, subject_id string, subject_trace string, author string, at long"


def test_scores_are_conserved(spark, three):
    given = [
        ("1", "q", "NUMERIC", 1.0, None, None, "API", "trace", "one", "one", None, 1), ("2", "q", "NUMERIC", 2.0, None, None, "API", "trace", "one", "one", None, 2), ("3", "q!", "NUMERIC", 1.0, None, None, "API", "observation", "a", None, None, 1),
        ("4", " ", "NUMERIC", 1.0, None, None, "API", "observation", "a", None, None, 1), ("5", "w", "NUMERIC", None, None, None, "API", "observation", "a", None, None, 1), ("6", "w", "BOOLEAN", None, "yes", "c", "ANNOTATION", "observation", "a", None, "me", 1),
        ("7", "w", "NUMERIC", 1.0, None, None, "ANNOTATION", "session", "s", None, None, 1), ("8", "w", "NUMERIC", 1.0, None, None, "API", "dataset_run", "r", None, None, 1), ("9", "w", "NUMERIC", 1.0, None, None, "API", "trace", "lost", None, None, 1), (None, "w", "NUMERIC", 1.0, None, None, "API", None, None, None, None, 1),
        ("10", "q ", "NUMERIC", 1.0, None, None, "API", "observation", "a", None, None, 1), ("11", "q_", "CATEGORICAL", None, "x", None, "API", "observation", "a", None, None, 1),
    ]
    c = scores.classify(spark.createDataFrame(given, SCORE), spans.roots(three))
    reasons = {r.id: r.reason for r in scores.skipped(c).collect()}
    assert reasons == {"4": "name is empty", "5": "no value", "8": "subject kind is not mapped", "9": "trace is not there", None: "no subject", "11": "name collides"}
    cells = scores.long_columns(c)
    kept = {(r.bucket, r.column): (r.number, r.text) for r in cells.collect()}
    assert kept[("evals", "trace_eval.q.score")] == (2.0, None) and kept[("annotations", "annotation.w.score")] == (1.0, None) and kept[("session_evals", "session_eval.w.score")] == (1.0, None)
    record = scores.annotation_records(cells).first()
    assert (record["values"][0].label, record["values"][0].text) == ("yes", "c")


def test_collision_names_the_least(spark):
    df = spark.createDataFrame([("a.b",), ("a-b",), ("c",)], "name string")
    assert [(r.clean, r.names) for r in scores.collisions(df).collect()] == [("a_b", 2)]


def test_byte_batches(spark):
    df = spark.createDataFrame([("d", i, s) for i, s in enumerate([5, 5, 30, 1, 1, 1, 9])], "g string, i int, s int")
    assert [r.batch for r in batches.by_bytes(df, "g", "i", "s", 3, 10).orderBy("i").collect()] == [0, 0, 1, 2, 2, 2, 3]
    assert [r.batch for r in batches.by_rows(df, "g", "i", 3).orderBy("i").collect()] == [0, 0, 0, 1, 1, 1, 2]


def test_states():
    assert batches.transition("pending", "start") == "uncertain" and batches.transition("uncertain", "success") == "submitted"
    with pytest.raises(ValueError):
        batches.transition("submitted", "start")


def test_outcomes(spark):
    rows = [("prepare", 0, "prepared"), ("bulk", 400, "rejected"), ("bulk", 408, "ambiguous"), ("bulk", 503, "ambiguous"), ("quick", 400, "ambiguous")]
    df = spark.createDataFrame(rows, "s string, c int, want string").select("want", batches.outcome(F.col("s"), F.col("c")).alias("got"))
    assert all(r.want == r.got for r in df.collect())


def test_retention_on_the_cutoff(spark):
    df = spark.createDataFrame([(T,), (T - timedelta(seconds=1),)], "start_time timestamp")
    assert reconcile.retention(df, F.lit(T + timedelta(days=730)), 2).first().too_old == 1


def test_windows_and_counts(spark, three):
    c = readers.daily_counts(three, "start_time")
    assert readers.history_range(c).first().total == 5
    assert readers.day_windows(readers.history_range(c.where("rows > 99"))).count() == 0
    assert [len(x) for x in (readers.chunks_of_days(T.date(), T.date() + timedelta(days=120)),)] == [3]


def test_keep_first_keeps_null_ids(spark):
    df = spark.createDataFrame([("a", 1), ("a", 2), (None, 1), (None, 1)], "id string, at int")
    assert sorted((r.id or "", r.at) for r in readers.keep_first(df, "id", "at").collect()) == [("", 1), ("", 1), ("a", 1)]


def test_canonical_generations(spark):
    new = spark.read.json(spark.sparkContext.parallelize(['{"id":"1","traceId":"t","startTime":"2024-01-01T00:00:00Z","input":{"a":1},"usageDetails":{"input":3}}']))
    row = readers.canonical(new, readers.OBSERVATION).first()
    assert (row.trace_id, row.input, row.usage_details) == ("t", '{"a":1}', {"input": 3.0})
    old = spark.read.json(spark.sparkContext.parallelize(['{"id":"1","name":"n","observationId":"o","traceId":"t","value":1}']))
    flat = readers.flat_subject(readers.canonical(old, readers.SCORE)).first()
    assert (flat.kind, flat.subject_id, flat.subject_trace) == ("observation", "o", "t")


def test_pages(spark):
    pages = spark.createDataFrame([('{"data":[{"a":1},3]}',), ('[{"b":2}]',), ('{"meta":1}',)], "body string")
    assert sorted(r.record for r in readers.records_of(pages).collect()) == ['{"a":1}', '{"b":2}']


def test_sources_refuse():
    with pytest.raises(ValueError):
        readers.source("nowhere")
    with pytest.raises(TypeError):
        type("Half", (readers.Source,), {"scores": None})()


def test_days_are_written_once(spark, three, tmp_path):
    built = spans.assemble(three).withColumn("day", F.to_date("start_time"))
    writers.write_days(built, f"{tmp_path}/s")
    with pytest.raises(writers.ShardError):
        writers.write_days(built, f"{tmp_path}/s")
    with pytest.raises(writers.ShardError):
        writers.write_days(built.unionByName(built), f"{tmp_path}/t")
    known = writers.fingerprint(built.select("span_id", "day"), "day")
    assert writers.check_fingerprint(built.select("span_id", "day"), known, "day").count() == 0
    assert writers.check_fingerprint(built.select("span_id", "day").limit(2), known, "day").count() == 1


def test_run(spark, three, tmp_path, capsys):
    folder, target = f"{tmp_path}/in", f"{tmp_path}/out"
    three.write.parquet(f"{folder}/observations")
    spark.createDataFrame([("1", "q", "NUMERIC", 1.0, None, None, "API", "trace", "one", "one", None, T)], SCORE.replace("at long", "at timestamp")).write.parquet(f"{folder}/scores")
    source = readers.source("files", spark, folder)
    assert all(c["ok"] for c in run.preflight(source))
    done = run.export(source, target, T, batch_rows=3)
    assert done["spans"].count() == 7 and done["cells"].count() == 1
    seen = []

    def send(df, day, batch):
        seen.append(df.count())
        if batch == 1 and len(seen) == 2:
            raise TimeoutError

    assert run.load(spark, target, send) == {"sent": 1, "rejected": 0, "uncertain": 1}
    assert run.load(spark, target, send) == {"sent": 0, "rejected": 0, "uncertain": 0}
    run.resolve(spark, target, T.date(), 1, landed=False)
    assert run.load(spark, target, send)["sent"] == 2 and sum(seen) == 10
    assert run.verify(spark, target, spark.read.parquet(f"{target}/spans")).count() == 0
    assert cli.main(["status", "--target", target], spark) == 0 and '"complete": true' in capsys.readouterr().out
    assert cli.main(["verify"], spark) == 2


def test_settings(tmp_path):
    f = tmp_path / "s"
    f.write_text("SPANLAKE_YEARS=3 # three\nSPANLAKE_API_KEY='abc#defgh'\nSPANLAKE_ODD=1\n")
    with pytest.raises(settings.SettingsError):
        settings.load(str(f), {})
    f.chmod(0o600)
    s = settings.load(str(f), {"SPANLAKE_YEARS": "9"})
    assert s.get("SPANLAKE_YEARS") == 3 and s.get("SPANLAKE_PATH") == "auto" and s.warnings == ["unknown setting SPANLAKE_ODD"]
    assert s.summary()["SPANLAKE_API_KEY"] == "abc#…<9 chars>"
    with pytest.raises(settings.SettingsError):
        s.require("SPANLAKE_PATH")


def test_dataset_name_clash(spark):
    items = spark.createDataFrame([("1", "d", '{"expected_output":"in"}', "out", None, None)], "id string, dataset string, input string, expected string, metadata string, status string")
    assert resources.dataset_examples(items).first().cells == {"expected_output": "in", "expected_output_2": "out", "source_item_id": "1"}


def test_streams(spark, three, tmp_path):
    three.write.parquet(f"{tmp_path}/in")
    stream = spark.readStream.schema(three.schema).parquet(f"{tmp_path}/in")
    q = daily.first_traces(stream).writeStream.format("memory").queryName("firsts").outputMode("update").trigger(availableNow=True).start()
    q.awaitTermination(60)
    assert [(r.session_id, r.trace_id) for r in spark.table("firsts").collect()] == [("s", "one")]
    daily.write_spans(stream, f"{tmp_path}/out", f"{tmp_path}/cp").awaitTermination(60)
    assert spark.read.parquet(f"{tmp_path}/out").count() == 5
    q = daily.counts(daily.once(stream), late=None).writeStream.format("memory").queryName("counts").outputMode("append").trigger(availableNow=True).start()
    q.awaitTermination(60)
    assert spark.table("counts").schema.names == ["day", "rows"]

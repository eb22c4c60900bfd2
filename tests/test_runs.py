"""Whole runs: what a rerun, a crash, a failed send or a second look leaves behind."""

import random
import shutil
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from spanlake.functions import values
from spanlake.operators import batches, numbering, resources
from spanlake.plans import cli, migrate, run, tables
from spanlake.sources import readers, senders, writers

T = datetime(2024, 1, 1, 10)
OBS = "id string, trace_id string, parent_id string, name string, type string, start_time timestamp, end_time timestamp, session_id string, metadata string"
SCORE = "id string, name string, data_type string, value_number double, value_text string, comment string, source string, kind string, subject_id string, subject_trace string, author string, at timestamp"


@pytest.fixture(scope="module")
def home(spark, tmp_path_factory):
    """A source of two days of observations with scores of a trace, a span, a session and a lost span, and its export off the bulk path."""
    path = tmp_path_factory.mktemp("runs")
    rows = [(f"o{i}", f"t{i // 3}", None if i % 3 == 0 else f"o{i - i % 3}", f"n{i}", "SPAN", T + timedelta(hours=8 * (i // 3), minutes=i), None, f"s{i // 6}", None) for i in range(12)]
    given = [
        ("1", "q", "NUMERIC", 1.0, None, None, "API", "trace", "t0", "t0", None, T), ("2", "ok", "BOOLEAN", 1.0, None, None, "ANNOTATION", "observation", "o4", "t1", "me", T),
        ("3", "w", "NUMERIC", 2.0, None, None, "API", "session", "s1", None, None, T), ("4", "q", "NUMERIC", 3.0, None, None, "API", "observation", "lost", "t0", None, T),
    ]
    spark.createDataFrame(rows, OBS).write.parquet(f"{path}/in/observations")
    spark.createDataFrame(given, SCORE).write.parquet(f"{path}/in/scores")
    done = run.export(readers.source("files", spark, f"{path}/in"), f"{path}/out", T, batch_rows=4, bulk=False)
    assert [r.bucket for r in done["unmatched"].collect()] == ["evals"] and done["skipped"].count() == 0
    return path


@pytest.fixture
def source(spark, home):
    return readers.source("files", spark, f"{home}/in")


@pytest.fixture
def target(home, tmp_path):
    """The exported folder, for a test alone."""
    shutil.copytree(home / "out", tmp_path / "out")
    return f"{tmp_path}/out"


def rows_of(df):
    return sorted(map(repr, df.collect()))


def test_fingerprints_tell_tables_apart(spark):
    make = lambda *rows: spark.createDataFrame(rows, "a int, b int, c string").withColumn("day", F.lit(1))
    prints = [writers.fingerprint(make(*r), "day").first().checksum for r in ([(1, None, "x")], [(None, 1, "x")], [(1, None, "x"), (5, 5, "y"), (5, 5, "y")], [(1, None, "x"), (7, 7, "y"), (7, 7, "y")], [(1, None, "1:x")], [(11, None, "x")])]
    assert len(set(prints)) == len(prints)
    assert writers.fingerprint(make((1, 2, "a"), (3, 4, "b")), "day").first() == writers.fingerprint(make((3, 4, "b"), (1, 2, "a")), "day").first()


def test_a_crash_before_the_ledger_loses_nothing(spark, source, home, target):
    shutil.rmtree(f"{target}/ledger")  # it is written last
    done = run.export(source, target, T, batch_rows=4, bulk=False)
    for name in ("spans", "cells", "frames", "ledger"):
        assert rows_of(spark.read.parquet(f"{target}/{name}").drop("files")) == rows_of(spark.read.parquet(f"{home}/out/{name}").drop("files")), name
    assert done["spans"].count() == 12 and done["cells"].count() == 6 and len(rows_of(run.read_ledger(spark, target))) == 4


def test_sent_days_are_not_written_anew(spark, source, target):
    sent = []
    assert run.load(spark, target, lambda df, day, n: sent.append(df.agg(F.count(F.lit(1)), F.sum(F.size("evals"))).first())) == {"sent": 4, "rejected": 0, "uncertain": 0}
    assert sum(r[0] for r in sent) == 12 and sum(r[1] for r in sent) == 2 and max(r[0] for r in sent) == 4
    with pytest.raises(run.RunError):
        run.export(source, target, T, overwrite=True)


def test_failed_sends(spark, target):
    failures = [(run.SendError("prepare"), "pending"), (run.SendError("bulk", 400), "pending"), (ValueError("odd"), "uncertain"), (run.SendError("quick", 400), "uncertain")]
    day = run.read_ledger(spark, target).agg(F.min("day")).first()[0]
    for error, state in failures:
        def send(df, of, n, error=error):
            raise error

        run.load(spark, target, send, bulk=False)
        assert [r.status for r in run.read_ledger(spark, target).where((F.col("day") == F.lit(day)) & (F.col("batch") == 0)).collect()] == [state]
        if state == "uncertain":
            run.resolve(spark, target, day, 0, landed=False)
    with pytest.raises(ValueError):
        run.resolve(spark, target, day, 0, landed=True)


def test_overwritten_days_keep_nothing(spark, source, home, target, tmp_path):
    """Cells and frames of scores that are gone from the source go, though the days get no new ones."""
    shutil.copytree(f"{home}/in/observations", f"{tmp_path}/in/observations")
    spark.createDataFrame([], SCORE).write.parquet(f"{tmp_path}/in/scores")
    bare = readers.source("files", spark, f"{tmp_path}/in")
    assert spark.read.parquet(f"{target}/cells").count() == 6
    done = run.export(bare, target, T, overwrite=True, batch_rows=5, bulk=False)
    assert done["cells"].count() == 0 and done["spans"].count() == 12 and spark.read.schema(done["cells"].schema).parquet(f"{target}/frames").count() == 0
    assert run.status(spark, target).agg(F.sum("batches")).first()[0] == len(rows_of(run.read_ledger(spark, target))) < 5
    assert tables.read_events(spark, target).where("event = 'withdrawn'").count() == 4


def test_a_batch_is_read_from_its_files_alone(spark, tmp_path):
    """Rows read for a batch are its own: metrics of the scans, not of the day."""
    rows = [(f"o{i}", f"t{i // 4}", None, "n", "SPAN", T + timedelta(seconds=i), None, None, None) for i in range(400)]
    spark.createDataFrame(rows, OBS).write.parquet(f"{tmp_path}/in/observations")
    spark.createDataFrame([], SCORE).write.parquet(f"{tmp_path}/in/scores")
    target = f"{tmp_path}/out"
    run.export(readers.source("files", spark, f"{tmp_path}/in"), target, T, batch_rows=50)
    schema, made = spark.read.parquet(f"{target}/spans").schema, {r.batch: r.asDict() for r in run.read_ledger(spark, target).collect()}
    assert len({f for r in made.values() for f in r["files"]}) >= len(made) == 10  # a synthetic root a trace
    read = []
    for n in (1, 2, 4):
        df = run.batch_rows_of(spark, target, schema, T.date(), *[made[b] for b in range(n)])
        assert df.count() == 50 * n
        metrics = df._jdf.queryExecution().executedPlan()
        files = df.inputFiles()
        read.append(sum(spark.read.parquet(f).count() for f in files))
        assert metrics is not None and len(files) <= n + 1
    assert read == [50, 100, 200]


def test_changed_files_are_refused(spark, target, tmp_path):
    """A span file that isn't what was exported ends the load before anything of its wave is sent."""
    day = run.read_ledger(spark, target).agg(F.min("day")).first()[0]
    row = next(r for r in run.read_ledger(spark, target).collect() if (r.day, r.batch) == (day, 1))
    file = f"{target}/spans/day={day}/{row.files[0]}"
    spark.read.parquet(file).withColumn("name", F.lit("changed")).coalesce(1).write.parquet(f"{tmp_path}/other")
    for other in (tmp_path / "other").glob("part-*"):
        shutil.copy(other, file)
        shutil.copy(other.with_name(f".{other.name}.crc"), f"{target}/spans/day={day}/.{row.files[0]}.crc")
    sent = []
    with pytest.raises(run.RunError, match="aren't what was exported"):
        run.load(spark, target, lambda df, day, n: sent.append((day, n)))
    assert sent == [(day, 0)] and {r.batch: r.status for r in run.read_ledger(spark, target).where(F.col("day") == F.lit(day)).collect()}[1] == "pending"


def test_a_failed_day_keeps_others_applied(spark, target, tmp_path):
    """Chunks that were applied are never sent again, whatever fails beside them."""
    frames = spark.read.parquet(f"{target}/frames").where("bucket = 'annotations'")
    days = sorted(r.day for r in run.read_ledger(spark, target).select("day").distinct().collect())
    note = frames.collect()[0]
    more = [(note.bucket, f"{i:016x}", "annotation.ok.label", None, "yes", d) for i in range(5) for d in days]
    spark.createDataFrame(more, frames.schema).write.mode("append").partitionBy("day").parquet(f"{target}/frames")
    told = []

    def fails_late(records, start, end):
        got = [(r.span_id, start) for r in records.collect()]
        assert len(got) <= 2
        if start.date() == days[0] and len([t for t in told if t[1] == start]) >= 2:  # the second day's window starts on the first
            raise OSError("no")
        told.extend(got)

    first = run.apply_scores(spark, target, fails_late, lambda df: None, spark.createDataFrame([], "span_id string, start_time timestamp"), T, rows=2)
    assert first["problems"] and len(told) == len(set(told)) >= 6
    done = run.apply_scores(spark, target, lambda df, a, b: told.extend((r.span_id, a) for r in df.collect()), lambda df: None, spark.createDataFrame([], "span_id string, start_time timestamp"), T, rows=2)
    assert done["problems"] == [] and len(told) == len(set(told)) == 11


def test_tasks_send_all_rows(spark, target, tmp_path):
    """Many tasks send a batch; one that fails leaves the batch uncertain, as some of it may have landed."""
    def emit(rows, path=str(tmp_path)):
        import uuid

        own = [r["context.span_id"] for r in rows]
        if own:
            with open(f"{path}/{uuid.uuid4().hex}.sent", "w") as out:
                out.write("\n".join(own) + "\n")

    assert run.load(spark, target, senders.Tasks(emit, 3).send)["sent"] == 4
    sent = [x for f in tmp_path.glob("*.sent") for x in f.read_text().split()]
    assert sorted(sent) == sorted(r.span_id for r in spark.read.parquet(f"{target}/spans").select("span_id").collect())
    with pytest.raises(ValueError, match="1 to 32"):
        senders.Tasks(emit, 33)
    plan = run.score_plan(spark, target)
    assert plan.count() == spark.read.parquet(f"{target}/frames").count() and plan.where("applied").count() == 0 and run.score_plan(spark, f"{tmp_path}/none") is None


def test_waves_and_one_number(spark, target):
    def third(df, day, n, seen=[]):  # noqa: B006
        seen.append(n)
        if len(seen) == 2:
            raise run.SendError("bulk", 422)

    assert run.load(spark, target, third, wave=9) == {"sent": 3, "rejected": 1, "uncertain": 0}
    assert sorted(r.status for r in run.read_ledger(spark, target).collect()) == ["pending", "submitted", "submitted", "submitted"]
    total = run.verify_total(spark, target, 5)
    assert total["expected"] - 5 == total["missing"] > 0 and run.verify_total(spark, target, 99)["missing"] == 0


def test_binding(spark, tmp_path):
    run.bind(spark, f"{tmp_path}", "a", "p")
    run.bind(spark, f"{tmp_path}", "a", "p")
    with pytest.raises(run.RunError, match="belongs to 'a' and 'p'"):
        run.bind(spark, f"{tmp_path}", "b", "p")


def test_deferred_scores(spark, target, tmp_path):
    sink = senders.Folder(spark, f"{tmp_path}/sink")
    run.load(spark, target, sink.send, bulk=False)
    assert sink.readable().count() == 12
    tries, waits = [], []

    def update(cells):
        tries.append(cells.count())
        if len(tries) < 3:
            raise TimeoutError("project not found")

    def refused(records, start, end):
        assert end - start == timedelta(hours=26)
        raise OSError("no")

    late = run.apply_scores(spark, target, refused, lambda df: 1 / 0, sink.readable().limit(0), T, waits.append)
    assert (late["unmatched"], late["evaluations"], len(late["problems"]), waits) == (2, 0, 1, [])  # permanent: reported, not tried
    done = run.apply_scores(spark, target, refused, update, sink.readable(), T, waits.append)
    assert (done["annotations"], done["evaluations"], len(done["problems"])) == (0, 2, 1) and sum(tries) >= 2 and waits == [3.0, 6.0]
    done = run.apply_scores(spark, target, sink.annotate, lambda df: 1 / 0, sink.readable(), T)  # evaluations aren't sent again
    assert (done["annotations"], done["evaluations"], done["unmatched"], done["problems"]) == (1, 0, 0, [])
    assert run.apply_scores(spark, target, sink.annotate, update, sink.readable(), T)["days"] == 0
    assert run.score_plan(spark, target).where("NOT applied").count() == 0
    looks, waits = [sink.readable().limit(1), sink.readable()], []
    assert run.verify_until(spark, target, lambda: looks.pop(0), sleep=waits.append) == [] and waits == [2.0]
    assert run.verify_until(spark, target, lambda: sink.readable().limit(1), patience=1, sleep=waits.append)


def test_rebuilt_frames(spark, source, home, target):
    shutil.rmtree(f"{target}/frames")
    shutil.rmtree(f"{target}/framed")
    before = rows_of(run.read_ledger(spark, target))
    assert run.rebuild_frames(source, target, bulk=False) == 2
    assert rows_of(spark.read.parquet(f"{target}/frames")) == rows_of(spark.read.parquet(f"{home}/out/frames")) and rows_of(run.read_ledger(spark, target)) == before
    assert run.rebuild_frames(source, target, bulk=False) == 0  # days without deferred cells are remembered too


def test_commands(spark, home, target, tmp_path, capsys, monkeypatch):
    fresh = ["--folder", f"{home}/in", "--target", f"{tmp_path}/new", "--destination", f"{tmp_path}/sink"]
    assert cli.main(["load", "--target", "x"], spark) == 2 and cli.main(["load", *fresh], spark) == 1
    monkeypatch.setenv("SPANLAKE_YEARS", "100")
    assert cli.main(["run", *fresh], spark) == 0 and '"ok": true' in capsys.readouterr().out
    assert cli.main(["verify", *fresh], spark) == 0 and cli.main([*fresh, "apply-scores"], spark) == 0 and cli.main(["status", "--target", target], spark) == 0
    run.bind(spark, f"{tmp_path}/bound", "elsewhere", "p")
    assert cli.main(["run", *fresh[:2], "--target", f"{tmp_path}/bound", *fresh[4:]], spark) == 1


def test_no_day_is_eligible(spark, source, tmp_path):
    done = run.export(source, f"{tmp_path}/none", T + timedelta(days=9999))
    assert [done[k].count() for k in ("spans", "cells", "unmatched")] == [0, 0, 0] and run.read_ledger(spark, f"{tmp_path}/none") is None


def test_resources(spark, tmp_path):
    folder, target = f"{tmp_path}/in", f"{tmp_path}/out"
    spark.createDataFrame([("stars", "NUMERIC", 1.0, 5.0), ("odd", "NUMERIC", None, 5.0)], "name string, dataType string, minValue double, maxValue double").write.parquet(f"{folder}/score_configs")
    spark.createDataFrame([("p", "1", "Hi {{x}}"), ("p", "2", "  "), ("r", "1", "Yo")], "name string, version string, prompt string").write.parquet(f"{folder}/prompts")
    spark.createDataFrame([("1", "d", '{"q":1}'), ("2", "d", "plain")], "id string, datasetName string, input string").write.parquet(f"{folder}/dataset_items")
    judge = "id string, name string, type string, prompt array<struct<role: string, content: string>>, provider string, model string, dataType string, sourceCodeLanguage string, sourceCode string"
    spark.createDataFrame([("e1", "good", "llm_as_judge", [("user", "Rate {{output}}")], "openai", "m", "BOOLEAN", None, None), ("e2", "code", "code", None, None, None, "BOOLEAN", "PYTHON", "pass")], judge).write.parquet(f"{folder}/evaluators")
    spark.createDataFrame([("rule", None, 0.5, True, ["e1", "e2"])], "name string, filter string, sampling double, enabled boolean, evaluatorIds array<string>").write.parquet(f"{folder}/rules")
    source, options = readers.source("files", spark, folder), migrate.Options({"openai": "i"}, code_folder=f"{tmp_path}/code", tasks=True)
    first = {(r.family, r.name): r.outcome for r in migrate.migrate(spark, source, target, options, (*migrate.FAMILIES, "moods")).collect()}
    assert first == {("score_configs", "stars"): "created", ("score_configs", "odd"): "failed", ("prompts", "p"): "failed", ("prompts", "r"): "created", ("datasets", "d"): "created", ("evaluators", "good"): "created", ("evaluators", "code"): "failed", ("rules", "rule"): "created", ("moods", None): "failed"}
    assert (tmp_path / "code" / "code-e2.py").read_text().startswith("# evaluator: code")
    again = migrate.migrate(spark, source, target, options).where("outcome = 'skipped'").count()
    assert again == 5 and migrate.migrate(spark, source, f"{tmp_path}/dry", options, dry=True).where("outcome = 'created'").count() == 5
    assert tables.read_table(spark, f"{tmp_path}/dry/resources/prompts") is None


def test_numbers_do_not_depend_on_parts(spark, monkeypatch):
    monkeypatch.setattr(numbering, "PART_ROWS", 20)
    monkeypatch.setattr(numbering, "MOST_BOUNDS", 7)
    r = random.Random(1)
    rows = [(r.choice(["a", "b", None]), i) for i in r.sample(range(10_000), 400)]
    got = {(x.g, x.i): x.n for x in batches.numbered(spark.createDataFrame(rows, "g string, i int"), "g", "i").collect()}
    for g in ("a", "b", None):
        assert [got[g, i] for i in sorted(i for k, i in rows if k == g)] == list(range(sum(k == g for k, _ in rows)))
    whole = batches.chunks(spark.createDataFrame(rows, "g string, i int"), "i", 100).groupBy("chunk").count().collect()
    assert {x["count"] for x in whole} == {100} and batches.numbered(spark.createDataFrame([], "g string, i int"), "g", "i").count() == 0


@pytest.mark.parametrize("rows,limit", [(4, 20), (50, 7), (3, 10**9)])
def test_byte_batches_against_a_loop(spark, rows, limit):
    r = random.Random(rows)
    data = [(r.choice("ab"), i, r.choice([None, 0, 1, 5, 30])) for i in range(300)]
    want = {}
    for g in "ab":
        batch = count = total = 0
        for _, i, size in (x for x in data if x[0] == g):
            want[i] = batch
            count, total = count + 1, total + (size or 0)
            if count >= rows or total >= limit:
                batch, count, total = batch + 1, 0, 0
    df = spark.createDataFrame(data, "g string, i int, s int")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "17")
    try:
        assert {x.i: x.batch for x in batches.by_bytes(df, "g", "i", "s", rows, limit).collect()} == want
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")


def test_clashing_keys(spark):
    one = spark.range(1).select(values.flatten_json(F.lit('{"a.b":1,"a":{"b":2,"c":null}}')).alias("m")).first().m
    assert one == {"a.b": "1"}
    items = spark.createDataFrame([("1", "d", '{" q":"x","q ":"y","expected_output":"e","expected_output_2":"f"}', "out", None, None)], "id string, dataset string, input string, expected string, metadata string, status string")
    cells = resources.dataset_examples(items).first().cells
    assert sorted(cells.values()) == ["1", "e", "f", "out", "x", "y"] and cells["expected_output_3"] == "out" and {cells["q"], cells["q_2"]} == {"x", "y"}


def test_an_export_computes_observations_twice(spark, source, tmp_path):
    """once for the days there are, once for the rows that all tables of the export are made from."""
    seen = spark.sparkContext.accumulator(0)

    def tell(_):
        seen.add(1)
        return True

    class Counted(readers.Files):
        def observations(self, *window, **more):
            return super().observations(*window, **more).where(F.udf(tell, "boolean").asNondeterministic()("id"))

    rows = source.observations().count()
    done = run.export(Counted(spark, source.folder), f"{tmp_path}/out", T, batch_rows=4)
    assert rows <= seen.value <= 2 * rows and done["spans"].count() >= rows - done["rejected"].count()


def test_only_metadata_that_may_hold_the_reserved_key_is_refused(spark):
    from spanlake.operators import spans

    texts = ['{"provenance":1}', r'{"\u0070rovenance":1}', '{"a":"provenance"}', '"provenance"', '{"a":1}', None]
    rows = spark.createDataFrame([(str(i), "t", T, m) for i, m in enumerate(texts)], "id string, trace_id string, start_time timestamp, metadata string")
    usable, rejected = spans.split(rows)
    assert {r.id for r in rejected.collect()} == {"0", "1"} and {r.id for r in usable.collect()} == {"2", "3", "4", "5"}

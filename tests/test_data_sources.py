"""The data sources: batches as transactions, and pages read by time."""

import json
from datetime import UTC, datetime, timedelta

import pytest
from pyspark.sql import functions as F

from spanlake.sources import pages, sink

T = datetime(2024, 1, 1, 22)


def write(df, path, batch):
    df.write.format(sink.FORMAT).option("path", path).option("batch", batch).mode("append").save()


def test_batches_are_written_once(spark, tmp_path):
    sink.register(spark)
    path = f"file://{tmp_path}/out"
    df = spark.range(100).select("id", F.concat(F.lit("n"), "id").alias("a.b"), F.array(F.struct(F.col("id").alias("x"))).alias("list"), F.timestamp_seconds("id").alias("at")).repartition(3)
    write(df, path, "d-0")
    write(df.limit(5), path, "d-0")  # the batch is there
    write(df.where("id < 0"), path, "d-1")  # an empty one is told too
    write(df.limit(7).withColumn("more", F.lit(1.5)), path, "d-2")
    read = spark.read.format(sink.FORMAT).load(path)
    assert read.count() == 107 and read.where("more IS NULL").count() == 100
    assert sorted(r["a.b"] for r in read.where("more IS NULL").collect()) == sorted(f"n{i}" for i in range(100))
    assert read.where("more IS NULL").orderBy("id").first()["at"] == datetime(1970, 1, 1)
    assert [(x["batch"], x["rows"]) for x in sink.commits(path)] == [("d-0", 100), ("d-1", 0), ("d-2", 7)]


def test_a_failed_write_leaves_nothing(spark, tmp_path):
    """A task that is killed, though others have written theirs: nothing is visible or left, and the batch can be sent again."""
    sink.register(spark)
    path = f"{tmp_path}/out"
    odd = spark.range(1000).repartition(4, "id").withColumn("x", F.when(F.col("id") == 999, F.raise_error(F.lit("killed")).cast("long")).otherwise(F.col("id")))
    with pytest.raises(Exception, match="killed"):
        write(odd, path, "b")
    assert sink.commits(path) == [] and sink.clean(path) <= 1  # of a task that ran on when the write had ended
    write(spark.range(1000), path, "b")
    assert sink.clean(path) == 0
    assert spark.read.format(sink.FORMAT).load(path).count() == 1000


def test_refusals(spark, tmp_path):
    sink.register(spark)
    pages.register(spark)
    for mode, batch in (("overwrite", "a"), ("append", ""), ("append", "a/b"), ("append", ".a")):
        with pytest.raises(Exception, match="batch"):
            spark.range(1).write.format(sink.FORMAT).option("path", f"{tmp_path}/x").option("batch", batch).mode(mode).save()
    with pytest.raises(Exception, match="no committed batch"):
        spark.read.format(sink.FORMAT).load(f"{tmp_path}/none").count()
    with pytest.raises(Exception, match="no fields stars"):
        spark.read.format(pages.FORMAT).option("fields", "io,stars").load(f"{tmp_path}/none").count()


@pytest.fixture
def written(spark, tmp_path):
    pages.register(spark)
    rows = [(f"o{i}", f"t{i % 3}", None if i % 5 else "é\n\"x\"", T + timedelta(minutes=30 * i), {"input": float(i)}) for i in range(20)] + [("late", "t", None, None, None)]
    df = spark.createDataFrame(rows, "id string, trace_id string, input string, start_time timestamp, usage_details map<string,double>")
    pages.write_pages(df, f"{tmp_path}/pages", rows=6)
    return f"{tmp_path}/pages", df


def test_pages_hold_what_was_written(spark, written):
    path, df = written
    read = spark.read.format(pages.FORMAT).load(path)
    key = lambda r: (r.id, r.trace_id, r.input, r.start_time)
    assert sorted(map(key, read.collect()), key=repr) == sorted(map(key, df.where("start_time IS NOT NULL").collect()), key=repr)
    assert json.loads(read.where("id = 'o7'").first().usage_details) == {"input": 7.0}
    assert spark.read.format(pages.FORMAT).option("fields", "io").load(path).columns == ["id", "start_time", "input", "output", "metadata"]
    assert spark.read.format(pages.FORMAT).option("fields", "name").load(path).columns == ["id", "name", "start_time"]


def test_windows_reach_the_source(spark, written):
    path, df = written
    reader = lambda: pages.PageReader(path, pages.Pages({"path": path}).schema())
    assert len({f.file.split("day=")[1][:10] for f in reader().partitions()}) == 2
    from pyspark.sql.datasource import EqualTo, GreaterThan, GreaterThanOrEqual, IsNotNull, LessThan

    one = reader()
    low, high = T.replace(tzinfo=UTC) + timedelta(hours=3), T.replace(tzinfo=UTC) + timedelta(hours=6)
    given = [GreaterThanOrEqual(("start_time",), low), LessThan(("start_time",), high), EqualTo(("trace_id",), "t1"), IsNotNull(("id",)), GreaterThan(("id",), "a")]
    assert list(one.pushFilters(given)) == given[3:]  # Spark looks itself at what the reader doesn't take
    assert {f.file.split("day=")[1][:10] for f in one.partitions()} == {"2024-01-02"}
    rows = [r for f in one.partitions() for b in one.read(f) for r in b.to_pylist()]
    assert rows and all(low <= r["start_time"] < high and r["trace_id"] == "t1" for r in rows)
    for low, high in ((3, 6), (0, 1), (50, 60), (-5, 50)):
        a, b = F.lit(T + timedelta(hours=low)), F.lit(T + timedelta(hours=high))
        window = lambda d: d.where((F.col("start_time") >= a) & (F.col("start_time") < b))  # noqa: B023, E731
        got = window(spark.read.format(pages.FORMAT).load(path))
        assert sorted(r.id for r in got.collect()) == sorted(r.id for r in window(df).collect())
    plan = spark._jvm.PythonSQLUtils.explainString(got._jdf.queryExecution(), "formatted")
    assert "GreaterThanOrEqual(start_time" in plan and "LessThan(start_time" in plan and "(start_time#" not in plan.split("Condition :")[1].replace("isnotnull(start_time#", "")



def test_odd_pages(spark, tmp_path):
    """Bare lists, other names, other spellings, lines and records that are none, times without a zone."""
    pages.register(spark)
    folder = tmp_path / "p" / "day=2024-01-01"
    folder.mkdir(parents=True)
    lines = ['[{"id":"a","trace_id":"t","start_time":"2024-01-01T01:00:00"}, 5, null]', "", "no json", '{"items":[{"id":"b","traceId":"u","startTime":"2024-01-01T02:00:00+01:00","input":{"q":[1]}}]}', '{"other":[]}', '"x"', '{"data":{"id":"c"}}', '{"results":[{"id":"d","startTime":"never"}]}']
    (folder / "x.json").write_text("\n".join(lines))
    (folder / "_skip").write_text(lines[0])
    got = {r.id: (r.trace_id, r.start_time, r.input) for r in spark.read.format(pages.FORMAT).load(f"{tmp_path}/p").collect()}
    assert got == {"a": ("t", datetime(2024, 1, 1, 1), None), "b": ("u", datetime(2024, 1, 1, 1), '{"q": [1]}'), "d": (None, None, None)}

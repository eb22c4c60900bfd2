"""Mergeable statistics and wide tables that find their columns."""

from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from spanlake.operators import scores, sketches

T = datetime(2024, 1, 1)


def test_ranges_from_sketches(spark):
    rows = spark.range(40_000).select(F.date_add(F.lit(T.date()), (F.col("id") % 10).cast("int")).alias("day"), F.concat(F.lit("t"), (F.col("id") % 9000).cast("string")).alias("trace_id"), F.lit(T).alias("start_time"), (F.lit(T) + F.make_dt_interval(secs=(F.col("id") % 1000).cast("decimal(18,6)"))).alias("end_time"))
    days = sketches.of_days(rows)
    assert days.count() == 10 and days.agg(F.max(F.length("ids") + F.length("values"))).first()[0] < 32_768
    got = sketches.of_ranges(days).select("rows", sketches.distinct().alias("n"), sketches.quantile(0.5).alias("m"), sketches.quantile(0.99).alias("h")).first()
    assert got.rows == 40_000 and abs(got.n - 9000) < 270
    assert abs(got.m / 1e6 - 500) < 10 and abs(got.h / 1e6 - 990) < 10


def test_sketches_of_nothing(spark):
    open_ = spark.createDataFrame([(T.date(), None, T, None)], "day date, trace_id string, start_time timestamp, end_time timestamp")
    got = sketches.of_ranges(sketches.of_days(open_)).select("rows", sketches.distinct().alias("n"), sketches.quantile(0.5).alias("m")).first()
    assert (got.rows, got.n, got.m) == (1, 0, None)
    assert sketches.of_ranges(sketches.of_days(open_.limit(0)), "day").count() == 0


CELLS = "bucket string, target string, `column` string, number double, text string"


@pytest.mark.parametrize("most", [1, 2, 50])
def test_wide_tables_lose_nothing(spark, most):
    cells = [("evals", "a", "eval.q.score", 1.0, None), ("evals", "b", "eval.q.score", 0.5, None), ("evals", "a", "eval.q.label", None, "good"), ("evals", "b", 'eval.o"dd.label', None, 'x"y'), ("evals", "c", "eval.n.explanation", None, "é")]
    table = scores.wide(spark.createDataFrame(cells, CELLS), most)
    assert len(table.columns) == 2 + min(most, 4) and table.columns[-1] == "rest"
    found = {}
    for r in table.withColumn("rest", F.to_json("rest")).collect():
        for c in table.columns[1:-1]:
            if r[c] is not None:
                found[r.target, c] = r[c]
        rest = spark.createDataFrame([(r.rest,)], "r string").select(F.from_json("r", "map<string,struct<number: double, text: string>>").alias("m")).first().m or {}
        for c, v in rest.items():
            found[r.target, c] = v.number if v.number is not None else v.text
    assert found == {(t, c): n if n is not None else x for _, t, c, n, x in cells}
    assert scores.wide(spark.createDataFrame([], CELLS), most).columns == ["target", "rest"]


def test_wide_tables_and_chunks_compute_cells_once(spark):
    """cells are made by the costliest joins of a plan, so neither the look for columns nor the numbering makes them anew."""
    from datetime import date

    seen = spark.sparkContext.accumulator(0)

    def tell(i):
        seen.add(1)
        return f"c{i % 3 if i % 2 else 0}.label"

    made = spark.range(0, 600, 1, 3).select((F.col("id") % 200).cast("string").alias("target"), F.udf(tell, "string").asNondeterministic()("id").alias("column"), F.lit(None).cast("double").alias("number"), F.col("id").cast("string").alias("text"))
    got = scores.wide(made.dropDuplicates(["target", "column"]), 1)
    assert seen.value == 600 and got.columns == ["target", "c0.label", "rest"] and got.count() == 200 and seen.value == 600
    seen.value = 0
    chunks = scores.chunked(made.withColumn("day", F.lit(date(2024, 1, 1))), 40)
    assert sorted((r.chunk, r["count"]) for r in chunks.groupBy("chunk").count().collect()) == [(i, 120) for i in range(5)]
    assert chunks.columns == ["day", "target", "column", "number", "text", "chunk"] and seen.value == 600

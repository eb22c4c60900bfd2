"""Streams with state give what the batch plan gives, also after a restart."""

import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from spanlake.operators import spans
from spanlake.streaming import late

T = datetime(2024, 1, 1)
OBS = "id string, trace_id string, parent_id string, name string, start_time timestamp, end_time timestamp, session_id string"


@pytest.fixture
def store(spark):
    before = spark.conf.get("spark.sql.streaming.stateStore.providerClass")
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", late.STORE)
    yield
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", before)


def run(df, path):
    q = df.writeStream.format("parquet").option("path", f"{path}/out").option("checkpointLocation", f"{path}/cp").outputMode("append").trigger(availableNow=True).start()
    q.awaitTermination(240)


def test_roots_change_until_the_watermark_passes(spark, store, tmp_path):
    r = random.Random(5)
    rows = [(f"o{i:03}", r.choice([None, *(f"t{k}" for k in range(12))]), r.choice([None, "", "p", "p", "p"]), "n", T + timedelta(minutes=r.randint(0, 50)), r.choice([None, T + timedelta(minutes=60)]), f"s{i % 3}") for i in range(60)]
    end = [("end", "last", None, "n", T + timedelta(days=3), None, None)]
    parts = [rows[:20], rows[20:40], rows[40:], end, [("more", "last", None, "n", T + timedelta(days=6), None, None)]]
    shape = spark.createDataFrame([], OBS).schema
    for i, part in enumerate(parts):  # each run starts from the checkpoint of the one before
        spark.createDataFrame(part, OBS).coalesce(1).write.mode("append").parquet(f"{tmp_path}/in")
        run(late.roots(spark.readStream.schema(shape).parquet(f"{tmp_path}/in")), tmp_path)
        if i == 2:
            assert spark.read.parquet(f"{tmp_path}/out").count() == 0  # all are open
    want = spans.roots(spark.createDataFrame(rows, OBS).where("trace_id IS NOT NULL")).drop("name")
    got = spark.read.parquet(f"{tmp_path}/out").where("trace_id <> 'last'")
    assert {r.made_up for r in want.collect()} == {True, False}
    assert sorted(map(repr, got.select(*want.columns).collect())) == sorted(map(repr, want.collect()))


def test_late_scores_meet_their_spans(spark, tmp_path):
    spans_ = [("a", T), ("b", T + timedelta(hours=2)), ("c", T + timedelta(hours=3))]
    scores = [("1", "a", T + timedelta(hours=5)), ("2", "b", T + timedelta(hours=1)), ("3", "b", T + timedelta(hours=26)), ("4", "c", T + timedelta(hours=28)), ("5", "gone", T)]
    spark.createDataFrame(spans_, "span_id string, start_time timestamp").write.parquet(f"{tmp_path}/spans")
    spark.createDataFrame(scores, "id string, target string, at timestamp").write.parquet(f"{tmp_path}/scores")
    read = lambda n: spark.readStream.schema(spark.read.parquet(f"{tmp_path}/{n}").schema).parquet(f"{tmp_path}/{n}")
    run(late.scored(read("spans"), read("scores")), tmp_path)
    assert {r.id for r in spark.read.parquet(f"{tmp_path}/out").where(F.col("span_start").isNotNull()).collect()} == {"1", "3"}

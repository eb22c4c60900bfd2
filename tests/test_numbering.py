"""Places and greedy batches of large groups against plain loops."""

import random

import pytest
from pyspark.sql import functions as F

from spanlake.operators import batches, numbering


def plain_batches(rows, most, limit):
    """{(g, o): batch} of (g, o, size) by one loop over each group."""
    out, state = {}, {}
    for g, o, size in sorted(rows, key=lambda r: (str(r[0]), r[1])):
        batch, count, total = state.get(g, (0, 0, 0))
        out[g, o] = batch
        count, total = count + 1, total + max(size or 0, 0)
        state[g] = (batch + 1, 0, 0) if count >= most or total >= limit else (batch, count, total)
    return out


def sized(seed, n=400):
    r = random.Random(seed)
    size = lambda: r.choice([0, 0, 1, 3, 10, 40, 1000, None, -5]) if seed % 2 else 7
    return [(r.choice(["a", "a", "a", "b", None]), i, size()) for i in range(n)] + [("one", 0, 5)]


@pytest.mark.parametrize(("seed", "most", "limit"), [(1, 5, 60), (2, 5, 10_000), (3, 9, 1), (4, 50, 14)])
def test_greedy_batches(spark, monkeypatch, seed, most, limit):
    """Blocks of few rows and few of them joined at once: several levels; batches longer than rows allow, rows over the limit, sizes of nothing."""
    monkeypatch.setattr(numbering, "BLOCK_ROWS", 16)
    monkeypatch.setattr(numbering, "FAN", 3)
    monkeypatch.setattr(numbering, "PART_ROWS", 100)
    rows = sized(seed)
    df = spark.createDataFrame(rows, "g string, o int, size long").repartition(3)
    assert {(r.g, r.o): r.batch for r in batches.by_bytes(df, "g", "o", "size", most, limit).collect()} == plain_batches(rows, most, limit)


def test_greedy_of_nothing_and_refusals(spark):
    none = spark.createDataFrame([], "day date, id string, size int")
    out = batches.by_bytes(none, "day", "id", "size", 5, 5)
    assert out.columns == ["day", "id", "batch"] and out.count() == 0
    with pytest.raises(ValueError, match="one row"):
        batches.by_bytes(none, "day", "id", "size", 0, 5)


def test_no_task_gets_a_large_group(spark, monkeypatch):
    """The plan of byte batches has no Python, and no window or aggregate over a whole group of rows once it is cut."""
    monkeypatch.setattr(numbering, "PART_ROWS", 64)
    df = spark.range(5000).select(F.lit("x").alias("g"), "id", (F.col("id") % 13).alias("size"))
    cut = numbering.numbered(df, "g", "id", size="size")
    plan = batches.by_bytes(df, "g", "id", "size", 20, 50)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan
    got = cut.orderBy("id").collect()
    assert [r.n for r in got] == list(range(5000)) and got[-1].before == sum(i % 13 for i in range(4999))


def test_numbering_with_ties_and_clashing_names(spark, monkeypatch):
    monkeypatch.setattr(numbering, "PART_ROWS", 10)
    monkeypatch.setattr(numbering, "MOST_BOUNDS", 4)
    r = random.Random(2)
    rows = [(r.choice(["a", None]), r.randint(0, 9), f"{i}") for i in range(300)]
    df = spark.createDataFrame(rows, "g string, part int, `own.x` string").withColumns({"Group": F.lit(1), "n": F.lit("y")})
    got = numbering.numbered(df, "g", "part").collect()
    for g in ("a", None):
        own = sorted((x.n, x.part) for x in got if x.g == g)
        assert [n for n, _ in own] == list(range(len(own))) and [p for _, p in own] == sorted(p for _, p in own)
    assert sorted(x["own.x"] for x in got) == sorted(x[2] for x in rows)


def test_rows_are_computed_once_and_sorted(spark, monkeypatch):
    """whatever the groups' size, a row is computed for the write and for the look at where ranges end, not for each step."""
    monkeypatch.setattr(numbering, "PART_ROWS", 64)
    seen = spark.sparkContext.accumulator(0)

    def tell(i):
        seen.add(1)
        return i % 97

    rows = spark.range(0, 4000, 1, 4).select(F.when(F.col("id") % 5 != 0, F.col("id") % 2).alias("g"), F.udf(tell, "long").asNondeterministic()("id").alias("o"), "id", F.lit(None).alias("none"))
    got = numbering.numbered(rows, "g", "o", "id", size="o").collect()
    assert seen.value <= 2 * 4000
    want = {}
    for g in (None, 0, 1):
        before = 0
        for n, (o, i) in enumerate(sorted((i % 97, i) for i in range(4000) if (i % 2 if i % 5 else None) == g)):
            want[i] = (g, o, None, n, before)
            before += o
    assert {r.id: (r.g, r.o, r.none, r.n, r.before) for r in got} == want

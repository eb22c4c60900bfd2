"""Places of rows in large ordered groups, and greedy batches of them, without a task that holds a group."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from spanlake.sources import scratch

#: Rows of a file of numbered rows. The ranges are Spark's own, so no bounds are kept; the second number is there for callers that set it.
PART_ROWS, MOST_BOUNDS = 1 << 20, 256
#: Rows of a block of greedy batches (four times a batch's rows at least), and blocks that are joined at once.
BLOCK_ROWS, FAN = 1 << 14, 256


def free(df: DataFrame, *names: str) -> list[str]:
    """Names like these that df has no columns of."""
    taken = {c.lower() for c in df.columns}
    return [next(n for n in (f"{'_' * k}{name}" for k in range(1, 99)) if n.lower() not in taken) for name in names]


def same(a: str, b: str, *columns: str) -> list[Column]:
    """Columns of two aliases are equal, nulls too."""
    return [F.col(f"{a}.`{c}`").eqNullSafe(F.col(f"{b}.`{c}`")) for c in columns]


def numbered(df: DataFrame, by: str | None, *order: str, size: str | None = None) -> DataFrame:
    """Adds n, the place of each row in its group (of the whole table without one) from 0, and with `size` also before, the sum of the sizes before it.

    When this is called, the rows are computed once, dealt to ranges of (group, order) and written in this order to the shared
    folder: a row's place in its range is then known, and what stands before a range is a sum over ranges. So a row moves once,
    what made it isn't computed anew by each look at it, and no task gets a large group. Only `before` takes one more shuffle, by
    range. Rows that tie in `order` may swap places; they stay in one range. A null group is one; a null size counts as 0.
    Columns n and before are replaced.
    """
    spark, out = df.sparkSession, ["n", *(["before"] if size else [])]
    group, part, own, more = free(df, "group", "part", "own", "more")
    kept = [c for c in df.columns if c.lower() not in out]
    empty = {f.name for f in df.schema if f.dataType.typeName() == "void"}  # Parquet has no such type
    amount = F.coalesce(F.col(size), F.lit(0)).cast("long") if size else F.lit(0).cast("long")
    keyed = df.withColumn(group, F.col(by) if by else F.lit(0))
    dealt = keyed.repartitionByRange(group, *order).sortWithinPartitions(group, *order)
    placed = dealt.select(*[F.col(f"`{c}`") for c in kept if c not in empty], F.col(group), *([amount.alias(more)] if size else []), F.monotonically_increasing_id().alias(own))
    path = scratch.shared(spark, "numbered")
    placed.write.option("maxRecordsPerFile", PART_ROWS).parquet(f"{path}/rows")
    rows = spark.read.schema(placed.schema).parquet(f"{path}/rows").withColumn(part, F.shiftright(own, 33))
    # own counts on within a range, which may hold several groups
    past = Window.partitionBy(group).orderBy(part).rowsBetween(Window.unboundedPreceding, -1)
    before = lambda c: F.coalesce(F.sum(c).over(past), F.lit(0))
    total = rows.groupBy(group, part).agg(F.min(own).alias(own), F.count(F.lit(1)).alias("rows"), *([F.sum(more).alias(more)] if size else []))
    moved = total.select(group, part, (before("rows") - F.col(own)).alias(own), *([before(more).alias(more)] if size else []))
    moved.write.parquet(f"{path}/ranges")
    ranges = spark.read.schema(moved.schema).parquet(f"{path}/ranges")
    if size:
        upto = Window.partitionBy(group, part).orderBy(own).rowsBetween(Window.unboundedPreceding, 0)
        rows = rows.withColumn(more, F.sum(more).over(upto) - F.col(more))
    met = rows.alias("a").join(ranges.alias("b"), same("a", "b", group, part))
    plus = lambda c: F.col(f"a.{c}") + F.col(f"b.{c}")
    return met.select(*[F.lit(None).alias(c) if c in empty else F.col(f"a.`{c}`") for c in kept], plus(own).alias("n"), *([plus(more).alias("before")] if size else []))


def _ends(placed: DataFrame, block_rows: int, rows: int, limit: int) -> DataFrame:
    """g, block, nexts: for each row of a block in order, the place after the batch that would start there.

    Each row is a point at the sum before it and a question at that sum and the limit: the points below the question are in the
    batch. Both are sorted by their sums within blocks of places, a block with the points of a batch's rows beyond it, so a
    running maximum answers all.
    """
    block = F.floor(F.col("n") / block_rows).cast("long")
    point = lambda b: F.struct(b.alias("block"), F.col("before").alias("at"), F.lit(1).alias("kind"), F.col("n").alias("n"))
    ask = F.struct(block.alias("block"), (F.col("before") + limit).alias("at"), F.lit(0).alias("kind"), F.col("n").alias("n"))
    near = (block > 0) & (F.col("n") % block_rows < rows)
    events = placed.select("g", F.explode(F.array_compact(F.array(ask, point(block), F.when(near, point(block - 1))))).alias("e")).select("g", "e.*")
    below = Window.partitionBy("g", "block").orderBy("at", "kind").rowsBetween(Window.unboundedPreceding, 0)
    seen = events.withColumn("last", F.max(F.when(F.col("kind") == 1, F.col("n"))).over(below)).where("kind = 0")
    nexts = F.array_sort(F.collect_list(F.struct("n", F.least(F.col("last") + 1, F.col("n") + rows).alias("next"))))
    return seen.groupBy("g", "block").agg(F.transform(nexts, lambda x: x["next"]).alias("nexts"))


def _maps(blocks: DataFrame, block_rows: int) -> DataFrame:
    """g, block, start, end, nexts, jumps, exits: where the batches lead that start at each place at which a block can be entered.

    A batch that starts later never ends earlier, so a block is entered up to where the batch of the row before it ends, and no
    start needs more jumps through the block than its first row and one. So a block costs its rows, not their square.
    """
    own = blocks.withColumn("start", F.col("block") * block_rows).withColumn("end", F.col("start") + F.size("nexts"))
    before = blocks.select("g", (F.col("block") + 1).alias("block"), F.element_at("nexts", -1).alias("latest"))
    met = own.alias("a").join(before.alias("b"), same("a", "b", "g", "block"), "left").select("a.*", F.coalesce("b.latest", "a.start").alias("latest"))
    follow = lambda p: F.when(p < F.col("end"), F.get("nexts", (p - F.col("start")).cast("int"))).otherwise(p)
    walked = met.withColumn("jumps", F.aggregate("nexts", F.struct(F.col("start").alias("p"), F.lit(0).alias("k")), lambda s, _: F.when(s["p"] < F.col("end"), F.struct(follow(s["p"]).alias("p"), (s["k"] + 1).alias("k"))).otherwise(s))["k"] + 1)
    entries = F.sequence("start", F.least("latest", F.col("end") - 1))
    return walked.withColumn("exits", F.transform(entries, lambda e: F.aggregate(F.sequence(F.lit(1), F.col("jumps")), e, lambda p, _: follow(p)))).drop("latest")


def _through(block: Column, p: Column) -> Column:
    """Where a way that comes to a place in or after a block leaves it."""
    return F.when(p < block["end"], F.get(block["exits"], (p - block["start"]).cast("int"))).otherwise(p)


def _entries(maps: DataFrame, blocks: int) -> DataFrame:
    """g, block, entry: the first start of a batch in or after each block. maps: g, block, start, end, exits; blocks: how many a group has at most.

    FAN neighbours are joined to one, and those again, until a group has one, which is entered at its first place; then each tells its parts.
    """
    if blocks <= 1:
        return maps.select("g", "block", F.col("start").alias("entry"))
    own = F.array_sort(F.collect_list(F.struct("block", "start", "end", "exits")))
    joined = maps.groupBy("g", F.floor(F.col("block") / FAN).cast("long").alias("block")).agg(own.alias("parts"))
    first, last = F.get("parts", F.lit(0)), F.element_at("parts", -1)
    exits = F.transform(first["exits"], lambda p: F.aggregate(F.slice("parts", 2, FAN), p, lambda q, b: _through(b, q)))
    upper = joined.select("g", "block", first["start"].alias("start"), last["end"].alias("end"), exits.alias("exits"))
    known = _entries(upper, -(-blocks // FAN)).alias("u")
    met = joined.alias("j").join(known, same("j", "u", "g", "block")).select("j.g", "j.parts", "u.entry")
    none = F.array().cast("array<struct<block: bigint, entry: bigint>>")
    told = F.aggregate("parts", F.struct(F.col("entry").alias("p"), none.alias("all")), lambda s, b: F.struct(_through(b, s["p"]).alias("p"), F.array_append(s["all"], F.struct(b["block"].alias("block"), s["p"].alias("entry"))).alias("all")))
    return met.select("g", F.explode(told["all"]).alias("e")).select("g", "e.block", "e.entry")


def greedy(df: DataFrame, by: str, order: str, size: str, rows: int, limit: int) -> DataFrame:
    """by, order, batch: rows of a group in order, from 0; a batch closes with the row by which it has `rows` rows or sizes of `limit` in all.

    Where a batch starts depends on all before it, but where it ends on its start alone. So each row's end is found at once from
    running sums; blocks of rows then say where they are left by where they are entered, and these maps are joined like sums.
    No task holds a group, and no Python runs. Rows that tie in order may swap places; null or negative sizes count as 0; a null
    group is one; no rows give none.
    """
    if rows < 1 or limit < 1:
        raise ValueError("a batch has one row and one byte at least")
    block_rows = max(BLOCK_ROWS, 4 * rows)
    slim = df.select(F.col(by).alias("g"), F.col(order).alias("o"), F.greatest(F.coalesce(F.col(size), F.lit(0)), F.lit(0)).cast("long").alias("bytes"))
    placed = numbered(slim, "g", "o", size="bytes")
    maps = _maps(_ends(placed, block_rows, rows, limit), block_rows)
    entries = _entries(maps.select("g", "block", "start", "end", "exits"), -(-((placed.agg(F.max("n")).first()[0] or 0) + 1) // block_rows)).alias("e")
    met = maps.alias("m").join(entries, same("m", "e", "g", "block")).select("m.*", "entry")
    walk = F.aggregate(
        F.sequence(F.lit(1), F.col("jumps")), F.array("entry"),
        lambda s, _: F.when(F.element_at(s, -1) < F.col("end"), F.array_append(s, F.get("nexts", (F.element_at(s, -1) - F.col("start")).cast("int")))).otherwise(s),
    )
    starts = met.select("g", "block", "start", F.filter(walk, lambda p: p < F.col("end")).alias("starts"))
    past = Window.partitionBy("g").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    dealt = starts.withColumn("past", F.coalesce(F.sum(F.size("starts")).over(past), F.lit(0)))
    open_ = F.array(F.struct(F.col("start").alias("n"), (F.col("past") - 1).alias("batch")))
    marks = dealt.select("g", "block", F.explode(F.concat(open_, F.transform("starts", lambda p, i: F.struct(p.alias("n"), (F.col("past") + i).alias("batch"))))).alias("m"))
    both = placed.select("g", F.floor(F.col("n") / block_rows).cast("long").alias("block"), "n", F.lit(None).cast("long").alias("batch"), F.lit(1).alias("kind"), "o").unionByName(marks.select("g", "block", "m.n", "m.batch", F.lit(0).alias("kind")), allowMissingColumns=True)
    upto = Window.partitionBy("g", "block").orderBy("n", "kind").rowsBetween(Window.unboundedPreceding, 0)
    return both.withColumn("batch", F.max("batch").over(upto)).where("kind = 1").select(F.col("g").alias(by), F.col("o").alias(order), "batch")

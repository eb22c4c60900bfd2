"""Operator 13: sources mixed to target weights by entropy balancing."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from spanlake.llm.frames import read, scratch, stored
from spanlake.operators.batches import numbered

#: Weights of the sources in order, repeating; words of the mix by words of all documents; the most copies of a document.
WEIGHTS, SHARE, MOST = (5, 2, 1), 1.5, 2
#: Newton's steps stop when each source's words are this near their target, as a part of it, or after so many steps.
NEAR, STEPS = 1e-7, 60
#: A document's draw is a number of BITS bits; the draw up to which a source's documents get a further copy is found DIGIT bits at a time.
BITS, DIGIT, SEED = 32, 8, 42
#: Sums of weighted words are decimal, so that they don't depend on the order of rows.
_EXACT = "decimal(38,9)"


def words(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")


def targets(sources: DataFrame, share: float = SHARE, most: int = MOST) -> DataFrame:
    """Adds target: `share` of all words dealt by weight, but `most` times a source's words at most; what is above is dealt to the others by weight.

    That has a level: each source gets level x weight or its bound. The level rises until no source is newly bound; a step is one
    sum over the sources, of which the driver gets three numbers.
    """
    bound = F.col("source_size") * float(most)
    all_, weight = sources.agg(F.sum("source_size"), F.sum("weight")).first()
    level = share * (all_ or 0) / weight if weight else 0.0
    while weight:
        at = F.lit(level) * F.col("weight") >= bound
        held, free = sources.agg(F.coalesce(F.sum(F.when(at, bound)), F.lit(0.0)), F.coalesce(F.sum(F.when(~at, F.col("weight"))), F.lit(0))).first()
        higher = (share * all_ - held) / free if free else level
        if higher <= level:
            break
        level = higher
    return sources.withColumn("target", F.least(bound, F.lit(level) * F.col("weight")))


def _rate(tilt: Column, relative: Column, most: int) -> Column:
    """exp(tilt x relative size), `most` at most; the tilt is null where all documents get the most."""
    power = tilt * relative
    return F.when(tilt.isNull() | (power >= math.log(most)), F.lit(float(most))).otherwise(F.exp(power))


def tilts(sources: DataFrame, sizes: DataFrame, most: int = MOST) -> DataFrame:
    """number, tilt: of each source the tilt with which its documents' rates give the target.

    The rates that keep the entropy least against one copy of each document, under the words wanted and the bound of copies,
    are exp(tilt x relative size), `most` at most. The tilt is where the dual, which is convex, has its least: Newton's steps
    from 0 within a bracket that each step narrows; a step that leaves it is its middle. sizes: number, size, n (documents of a
    size). A step is a join of the sizes with a table of a row a source, and one sum a source.
    """
    mean = F.col("source_size") / F.col("n_docs")
    small = F.col("least_size") / mean
    wanted = F.col("target") / mean
    state = sources.where("source_size > 0").select(
        "number", mean.alias("mean"), wanted.alias("wanted"), (F.col("target") >= most * F.col("source_size")).alias("full"),
        F.lit(0.0).alias("tilt"), (-F.col("n_docs") / (math.e * wanted)).alias("low"), (math.log(most) / small).alias("high"), (F.col("target") >= most * F.col("source_size")).alias("done"),
    )
    state = stored(state)
    for _ in range(STEPS):
        if state.where("NOT done").isEmpty():
            break
        open_ = sizes.join(state.where("NOT done").select("number", "mean", "tilt"), "number")
        relative = F.col("size") / F.col("mean")
        rate = _rate(F.col("tilt"), relative, most)
        slope = F.when(rate < most, F.col("n") * relative * relative * rate).otherwise(0.0)
        sums = open_.groupBy("number").agg(F.sum((F.col("n") * relative * rate).cast(_EXACT)).cast("double").alias("got"), F.sum(slope.cast(_EXACT)).cast("double").alias("slope"))
        over = F.col("got") - F.col("wanted")
        low, high = F.when(over < 0, F.col("tilt")).otherwise(F.col("low")), F.when(over > 0, F.col("tilt")).otherwise(F.col("high"))
        step = F.col("tilt") - F.try_divide(over, F.col("slope"))
        met = F.coalesce(F.abs(over) <= NEAR * F.col("wanted"), F.lit(True))
        new = F.when(F.col("done") | met, F.col("tilt")).when((step > low) & (step < high), step).otherwise((low + high) / 2)
        moved = state.join(sums, "number", "left").select("number", "mean", "wanted", "full", new.alias("tilt"), F.when(F.col("done"), F.col("low")).otherwise(low).alias("low"), F.when(F.col("done"), F.col("high")).otherwise(high).alias("high"), (F.col("done") | met).alias("done"))
        state = stored(moved)
    return state.select("number", F.when(~F.col("full"), F.col("tilt")).alias("tilt"))


def thresholds(rated: DataFrame, sources: DataFrame) -> DataFrame:
    """number, threshold, left, tied: documents whose place is below the threshold get a further copy, whole, and those at it share `left` words by size (tied: their words).

    rated: number, size, base (copies so far), place. What a source still wants, less than its documents that may get a copy,
    is filled in order of places. Where it is full is found digit by digit: words of each digit under the digits found are
    summed, a table of 2**DIGIT rows a source, so no task holds a source's documents.
    """
    base = rated.groupBy("number").agg(F.sum(F.col("size") * F.col("base")).alias("_has"))
    state = sources.join(base, "number").select("number", F.greatest(F.round(F.col("target") - F.col("_has")).cast("long"), F.lit(0)).alias("left"), F.lit(0).cast("long").alias("threshold"), F.lit(False).alias("all"), F.lit(0).cast("long").alias("tied"))
    for shift in range(BITS - DIGIT, -1, -DIGIT):
        state = stored(state)
        of = F.shiftright("place", shift + DIGIT) == F.col("threshold")
        digit = (F.shiftright("place", shift) % (1 << DIGIT)).alias("digit")
        sums = rated.where("may").join(state.where("NOT all"), "number").where(of).groupBy("number", digit).agg(F.sum("size").alias("words"))
        upto = F.sum("words").over(Window.partitionBy("number").orderBy("digit"))
        full = sums.withColumn("upto", upto).join(state.select("number", "left"), "number").where(F.col("upto") > F.col("left"))
        found = full.groupBy("number").agg(F.min(F.struct("digit", (F.col("upto") - F.col("words")).alias("before"), "words")).alias("f"))
        done = F.col("all") | F.col("f").isNull()  # all documents that may get a copy do
        state = state.join(found, "number", "left").select(
            "number", F.when(done, F.col("left")).otherwise(F.col("left") - F.col("f.before")).alias("left"), F.when(done, F.col("threshold")).otherwise(F.col("threshold") * (1 << DIGIT) + F.col("f.digit")).alias("threshold"), done.alias("all"), F.when(done, F.lit(0)).otherwise(F.col("f.words")).cast("long").alias("tied"),
        )
    return stored(state.select("number", F.when(F.col("all"), F.lit(1 << BITS)).otherwise(F.col("threshold")).alias("threshold"), "left", "tied"))


def mix(docs: DataFrame, key: str = "doc_id", source: str = "source", text: str = "text", weights: Sequence[int] = WEIGHTS, share: float = SHARE, most: int = MOST) -> DataFrame:
    """key, source, size, source_size, target, rate, taken: how often a mix takes each document, and how many words of it.

    Size is a text's number of words (null: none). Sources stand in order of code points, null last, and weigh `weights` in turn;
    `targets` gives their words. `tilts` gives each document a rate between 0 and `most`; the whole part is copies, and a draw by
    the key's text form against the rest says who gets a further copy, in an order that fills the source's target exactly: the one
    document at the end gets the words that are left of a copy. So taken is whole copies but for one document a source (rows that
    share a key and a draw share these words by size), and never above `most` times the size. Draws depend on keys alone and sums
    are exact, so a run anew agrees. Documents without words take none, a source of such has target 0. Repeated rows are rows.
    Other columns are not looked at. No rows: none.

    Texts are read once, for their sizes; all that moves is ids and numbers, and a source's rows never meet in a task: they are
    summed where they are, and joined with a row a source.
    """
    spark = docs.sparkSession
    draw = F.conv(F.substring(F.md5(F.concat(F.lit(f"{SEED}:"), F.coalesce(F.col(key).cast("string"), F.lit(""))).cast("binary")), 1, BITS // 4), 16, 10).cast("long")
    with scratch(spark) as keep:
        slim = stored(docs.select(F.col(key).alias("key"), F.col(source).alias("source"), words(F.col(text)).alias("size"), draw.alias("draw")))
        named = slim.groupBy("source").agg(F.sum("size").alias("source_size"), F.count_if(F.col("size") > 0).alias("n_docs"), F.min(F.when(F.col("size") > 0, F.col("size"))).alias("least_size"))
        ranked = numbered(named.withColumn("unnamed", F.col("source").isNull()), None, "unnamed", "source").withColumnRenamed("n", "number")
        weight = F.element_at(F.array(*[F.lit(w) for w in weights]), (F.col("number") % len(weights) + 1).cast("int"))
        sources = stored(targets(stored(ranked.withColumn("weight", weight)), share, most))
        met = slim.alias("d").join(sources.alias("s"), F.col("d.source").eqNullSafe(F.col("s.source")))
        of_source = stored(met.select("d.*", "number", "source_size", "n_docs", "target"))
        tilt = tilts(sources, stored(of_source.where("size > 0").groupBy("number", "size").agg(F.count(F.lit(1)).alias("n"))), most)
        rate = F.when(F.col("size") > 0, _rate(F.col("tilt"), F.col("size") * F.col("n_docs") / F.col("source_size"), most)).otherwise(0.0)
        rated = of_source.join(stored(tilt), "number", "left").withColumn("rate", rate).withColumn("base", F.floor("rate").cast("long"))
        place = F.floor((F.col("draw") + (1 + F.col("base") - F.col("rate")) * float(1 << BITS)) / 2).cast("long")
        rated = stored(rated.select("key", "source", "size", "source_size", "target", "number", "rate", "base", place.alias("place"), ((F.col("size") > 0) & (F.col("base") < most)).alias("may")))
        more = F.when(F.col("place") < F.col("threshold"), F.col("size")).when(F.col("place") == F.col("threshold"), F.expr("cast(cast(left as decimal(38,0)) * size div tied as long)")).otherwise(0)
        out = rated.join(thresholds(rated, sources), "number").select(F.col("key").alias(key), F.col("source").alias(source), "size", "source_size", "target", "rate", (F.col("size") * F.col("base") + F.when(F.col("may"), more).otherwise(0)).alias("taken"))
        return keep(out)


def op13_entropy_balancing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix(read(spark, sf_dir, "documents")).select("doc_id", "size", "source_size", "target", "taken")

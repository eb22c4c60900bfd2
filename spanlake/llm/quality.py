"""Operator 10: quality rules whose cutoffs keep the risk of false rejection under control."""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from spanlake.llm.frames import cut, fresh, read, table
from spanlake.llm.textio import NOT_SPACE, buffers, byte_table, grams, room, rows_of, runs, slices, word_hashes

MIN_WORDS, MAX_REPEAT, REPEAT_WINDOW = 20, 30, 8
#: Share of good documents that may be lost in a stratum, and the chance that a bound is wrong anywhere.
ALPHA, DELTA = 0.01, 0.05
#: Share of a stratum's part of DELTA for the test of all rules together; the rest is for the rules one by one.
UNION_SHARE = 0.8
#: Cutoffs tried for each rule, at even steps of the range 0 to 1 that every rate has.
STEPS = 40
COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
_SYMBOLS = byte_table(b"#*$%&|<>")


def measure(docs: DataFrame, text: str = "text") -> DataFrame:
    """Adds the counts of each whole text: n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, and n_lines and n_upper.

    n_repeat_words are the words in windows of 8 words that the text has twice or more, the first
    included. Null and empty texts have zeros. Columns of these names are replaced.
    """
    made = (*COUNTS, "n_lines", "n_upper")
    keep = [c for c in docs.columns if c.lower() not in made]
    (body,) = fresh(docs, "body")
    slim = docs.select(*keep, F.col(text).alias(body))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, body):
                data, offsets = buffers(part.column(body))
                starts, ends, first = runs(data, offsets, NOT_SPACE)
                total = lambda mask, offsets=offsets: np.diff(np.concatenate(([0], np.cumsum(mask)))[offsets])
                row = rows_of(first)
                n = np.diff(first)
                h = grams(word_hashes(data, starts, ends, lower=False), REPEAT_WINDOW)
                inside = room(first)[: len(h)] >= REPEAT_WINDOW
                where = np.flatnonzero(inside)
                twice = np.zeros(len(starts) + 1, np.int64)
                if len(where):
                    order = where[np.lexsort((h[where], row[where]))]
                    same = (h[order][1:] == h[order][:-1]) & (row[order][1:] == row[order][:-1])
                    again = np.zeros(len(order), bool)
                    again[1:] |= same
                    again[:-1] |= same
                    np.add.at(twice, order[again], 1)
                    np.add.at(twice, order[again] + REPEAT_WINDOW, -1)
                repeats = np.bincount(row[np.cumsum(twice[:-1]) > 0], minlength=len(n)) if len(row) else np.zeros(len(n), np.int64)
                dup, lines = [], []
                raw = data.tobytes()
                for a, b in zip(offsets[:-1].tolist(), offsets[1:].tolist(), strict=True):
                    own = [x for x in raw[a:b].split(b"\n") if x and not x.isspace()]
                    lines.append(len(own))
                    dup.append(len(own) - len(set(own)))
                solid = NOT_SPACE[data] & ((data & 0xC0) != 0x80)
                columns = (n, total(solid), total(_SYMBOLS[data]), dup, repeats, lines, total((data >= 65) & (data <= 90)))
                yield pa.RecordBatch.from_arrays([*part.columns[: len(keep)], *(pa.array(np.asarray(c), pa.int64()) for c in columns)], names=[*keep, *made])

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in slim.schema.fields[:-1])
    return slim.mapInArrow(run, (schema + ", " if schema else "") + ", ".join(f"{c} long" for c in made))


#: The rules: a rate from 0 to 1, high in bad text; a document whose rate is over the cutoff of its stratum goes.
RULES = {
    "symbols": "least(1, n_symbols / greatest(n_words, 1))",
    "repeats": "n_repeat_words / greatest(n_words, 1)",
    "dup_lines": "n_dup_lines / greatest(n_lines, 1)",
    "shouting": "least(1, n_upper / greatest(word_chars, 1))",
    "long_words": "least(1, greatest(0, word_chars / greatest(n_words, 1) - 4) / 20)",
    "short_words": "greatest(0, 1 - word_chars / greatest(n_words, 1) / 5)",
}


_ANY = "any"


def _tail(k: int, n: int, p: float) -> float:
    """P(at most k of n) for a binomial, from logs."""
    if p <= 0 or k >= n:
        return 1.0
    if p >= 1:
        return 0.0
    logs = [math.lgamma(n + 1) - math.lgamma(i + 1) - math.lgamma(n - i + 1) + i * math.log(p) + (n - i) * math.log1p(-p) for i in range(k + 1)]
    top = max(logs)
    return min(1.0, math.exp(top) * sum(math.exp(x - top) for x in logs))


def upper_bound(k: int, n: int, delta: float) -> float:
    """Clopper and Pearson's exact upper bound of a rate of which k of n are seen, wrong with chance delta."""
    if n == 0 or k >= n:
        return 1.0
    low, high = k / n, 1.0
    for _ in range(60):
        mid = (low + high) / 2
        low, high = (mid, high) if _tail(k, n, mid) > delta else (low, mid)
    return high


def choose(counts: dict[tuple[str, str, int], int], goods: dict[str, int], rules: Sequence[str], alpha: float, delta: float, steps: int = STEPS, union: dict[tuple[str, int], int] | None = None) -> dict[str, dict[str, float]]:
    """The safe cutoffs of the rules in each stratum; no entry if there are none.

    counts has, for a stratum, rule and step, how many good documents of the holdout have a rate above
    step / steps; union has, for a stratum and step, how many have any rate above it. A document is lost if any
    rule rejects it. delta is shared out over the strata (Bonferroni), and a stratum's part over two ways:

    - together: all rules have one cutoff, and the union of what they reject may lose alpha of the good ones. It needs
      few labels, but the rule that good text meets first holds up the others.
    - one by one: each rule may lose alpha / rules, and this way's part is shared out over the rules. It needs many.

    Cutoffs are tried from the mildest on and the first whose bound is too high ends the search, which needs no
    further correction (fixed sequence). Both ways are safe at once, so either may be taken: the second if it
    has a cutoff for every rule, else the one with the lower sum of cutoffs (1 for a rule that is not used). Without `union` there is only the second way.
    """
    whole = delta / max(1, len(goods))
    together = UNION_SHARE * whole if union is not None else 0.0
    share, each = alpha / max(1, len(rules)), (whole - together) / max(1, len(rules))
    out: dict[str, dict[str, float]] = {}
    for stratum, n in goods.items():
        lowest = lambda lost, most, chance, n=n: _lowest([lost(k) for k in range(steps)], n, most, chance)
        single = {rule: c for rule in rules if (c := lowest(lambda k, s=stratum, r=rule: counts.get((s, r, k), 0), share, each)) < 1}
        best = single
        if union is not None and len(single) < len(rules) and (c := lowest(lambda k, s=stratum: union.get((s, k), 0), alpha, together)) < 1 and c * len(rules) < sum(single.get(x, 1.0) for x in rules):
            best = dict.fromkeys(rules, c)
        if best:
            out[stratum] = best
    return out


def _lowest(lost: Sequence[int], n: int, most: float, chance: float) -> float:
    """The lowest step, as a part of all, down to which no bound of the rate lost of n is over `most`; 1 if there is none."""
    step = len(lost)
    while step and upper_bound(lost[step - 1], n, chance) <= most:
        step -= 1
    return step / len(lost)


def fit(measured: DataFrame, labels: DataFrame, stratum: str = "lang", doc_id: str = "doc_id", alpha: float = ALPHA, delta: float = DELTA, steps: int = STEPS) -> DataFrame:
    """stratum, cutoffs: the safe cutoffs of each stratum by rule (a map, empty if there are none), from all labelled documents.

    The labelled documents are the holdout: rules, their order and the steps are fixed beforehand, so labels only test
    cutoffs. Good documents (quality 1) are counted by stratum, rule and step; a stratum is chosen for in a task, from
    rules x steps numbers. Rows of null are the stratum ''. Labels that contradict each other, are null or lack a document
    say nothing.
    """
    good = labels.where(F.col(doc_id).isNotNull()).groupBy(F.col(doc_id).alias("_id")).agg(F.min("quality").alias("q")).where("q = 1").select("_id")
    rates = [F.expr(e).alias(r) for r, e in RULES.items()]
    rates.append(F.greatest(*[F.expr(e) for e in RULES.values()]).alias(_ANY))
    held = measured.join(good, F.col(doc_id) == F.col("_id"), "left_semi").select(F.coalesce(F.col(stratum).cast("string"), F.lit("")).alias("s"), *rates)
    bins = F.array(*[F.struct(F.lit(r).alias("rule"), F.ceil(F.col(r) * steps).cast("int").alias("bin")) for r in (*RULES, _ANY)])
    counted = cut(held.select("s", F.explode(bins).alias("x")).groupBy("s", "x.rule", "x.bin").agg(F.count(F.lit(1)).alias("n")))
    strata = counted.select("s").distinct().count()

    def choose_one(group: pd.DataFrame) -> pd.DataFrame:
        own = group["s"].iloc[0]
        counts, union = {}, {}
        for rule, b, n in zip(group["rule"], group["bin"], group["n"], strict=True):
            for step in range(min(b, steps)):  # a rate in bin b is above every step below b
                if rule == _ANY:
                    union[own, step] = union.get((own, step), 0) + n
                else:
                    counts[own, rule, step] = counts.get((own, rule, step), 0) + n
        goods = {own: int(group.loc[group["rule"] == _ANY, "n"].sum())}
        chosen = choose(counts, goods, list(RULES), alpha, delta / strata, steps, union).get(own)
        return pd.DataFrame([(own, chosen or {})], columns=["stratum", "cutoffs"], dtype=object)

    return counted.groupBy("s").applyInPandas(choose_one, "stratum string, cutoffs map<string, double>")


def judge(measured: DataFrame, cutoffs: DataFrame, stratum: str = "lang") -> DataFrame:
    """Adds base_failed, rejected_by (names of rules, array) and kept. Columns of these names are replaced.

    A stratum that wasn't fitted has the cutoffs of '', if any; one that was and has no safe cutoff has no rules.
    """
    keep = [c for c in measured.columns if c.lower() not in ("base_failed", "rejected_by", "kept")]
    name, own, rest, others = fresh(measured, "stratum", "cutoffs", "rest", "others")
    known = cutoffs.select(F.col("stratum").alias(name), F.col("cutoffs").alias(own))
    spare = F.broadcast(cutoffs.where("stratum = ''").select(F.col("stratum").alias(rest), F.col("cutoffs").alias(others)))  # one row at most
    joined = measured.withColumns({name: F.coalesce(F.col(stratum).cast("string"), F.lit("")), rest: F.lit("")}).join(known, name, "left").join(spare, rest, "left")
    limits = F.coalesce(own, others)
    tests = [F.when(F.expr(rate) > F.try_element_at(limits, F.lit(rule)), F.lit(rule)) for rule, rate in RULES.items()]
    rejected = F.filter(F.array(*tests), lambda x: x.isNotNull())
    failed = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEAT * F.col("n_words"))
    return joined.select(*keep, failed.alias("base_failed"), rejected.alias("rejected_by"), (~failed & (F.size(rejected) == 0)).alias("kept"))


def apply_rules(docs: DataFrame, labels: DataFrame, stratum: str = "lang", doc_id: str = "doc_id", text: str = "text", alpha: float = ALPHA, delta: float = DELTA, with_text: bool = True) -> DataFrame:
    """All rows with their counts, base_failed, rejected_by and kept; without the text column if with_text is false.

    Null and empty texts have no words and fail the base rule. Without labels no cutoff is safe and only the base rule
    rejects. Repeated rows get equal verdicts. Texts are measured once and the counts written, unless texts are to be
    returned beside them: those are then measured again, not written. Cutoffs are a small table by stratum, which `table`
    marks for a broadcast join up to its bound.
    """
    slim = docs.select(*([doc_id, stratum] if with_text else [c for c in docs.columns if c != text]), text)
    counts = cut(measure(slim, text).drop(text))
    cutoffs = table(fit(counts, labels, stratum, doc_id, alpha, delta))
    return judge(measure(docs, text) if with_text else counts, cutoffs, stratum)


def op10_risk_controlled_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    out = apply_rules(docs, read(spark, sf_dir, "labels"), with_text=False)
    return out.select("doc_id", *COUNTS, "base_failed", "kept", "rejected_by")

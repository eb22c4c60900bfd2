"""Counts on both sides compared, retention, and the choice of a way in."""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Spans below which the quick way is sooner done, and the days back that late updates reach.
CROSSOVER, UPDATE_DAYS = 830_000, 31


def expected_days(shards: DataFrame) -> DataFrame:
    """day, expected: spans submitted, of days that have some."""
    return shards.where("spans_submitted > 0").select("day", F.col("spans_submitted").alias("expected"))


def rows_by_day(df: DataFrame, *times: str) -> DataFrame:
    """day, readable: rows by the UTC day of the first of the given times that is a column; unreadable times are left out."""
    time = next(t for t in times if t in df.columns)
    return df.select(F.to_date(F.col(time).try_cast("timestamp")).alias("day")).where("day IS NOT NULL").groupBy("day").agg(F.count(F.lit(1)).alias("readable"))


def shortfall(expected: DataFrame, readable: DataFrame) -> DataFrame:
    """day, expected, readable, missing: days of which fewer rows can be read than were sent."""
    joined = expected.join(readable, "day", "left").select("day", "expected", F.coalesce("readable", F.lit(0)).cast("long").alias("readable"))
    return joined.withColumn("missing", F.col("expected") - F.col("readable")).where("missing > 0")


def retention(spans: DataFrame, now: Column, years: int, time: str = "start_time") -> DataFrame:
    """One row: all spans, the oldest, how many are older than now less 365 days a year."""
    cutoff = now - F.expr(f"INTERVAL {365 * years} DAYS")
    return spans.agg(F.count(F.lit(1)).alias("total"), F.min(time).alias("oldest"), F.count_if(F.col(time) < cutoff).alias("too_old"))


def retention_sample(spans: DataFrame, now: Column, years: int, most: int = 20, time: str = "start_time") -> DataFrame:
    """The oldest few spans that are too old: a report."""
    return spans.where(F.col(time) < now - F.expr(f"INTERVAL {365 * years} DAYS")).orderBy(time, "span_id").limit(most)


def path(chosen: Column, spans: Column, age_days: Column) -> Column:
    """bulk or quick: as chosen; bulk for history older than late updates reach or of unknown size; quick below the crossover."""
    choice = F.lower(F.trim(F.coalesce(chosen, F.lit("auto"))))
    return F.when(choice.isin("bulk", "quick"), choice).when(age_days > UPDATE_DAYS, "bulk").when(spans.isNull(), "bulk").when(spans < CROSSOVER, "quick").otherwise("bulk")


def moved(before: DataFrame, after: DataFrame) -> DataFrame:
    """Days whose counts differ between two looks: the source isn't quiet."""
    joined = before.withColumnRenamed("rows", "rows_before").join(after.withColumnRenamed("rows", "rows_after"), "day", "full_outer")
    return joined.where(~F.col("rows_before").eqNullSafe(F.col("rows_after")))


def phase_shares(phases: dict[str, float], spans: int) -> dict[str, dict[str, float]]:
    """Seconds, share of the whole in percent, and spans a second of each phase."""
    total = sum(phases.values()) or 1.0
    return {k: {"seconds": round(s, 2), "share": round(100 * s / total, 1), "spans_per_second": round(spans / s, 1) if s else 0.0} for k, s in phases.items()}


def delays(first: float = 2.0, cap: float = 30.0) -> Iterator[float]:
    """Waits that double up to a cap."""
    while True:
        yield min(first, cap)
        first = min(2 * first, cap)

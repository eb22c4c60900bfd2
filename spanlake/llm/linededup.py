"""Operator 6: site-relative line frequency."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from spanlake.llm.frames import fresh, read

#: A line is boilerplate of its site if more than this share of the site's pages has it, and so many pages at least.
MAX_RATIO, MIN_PAGES = 0.01, 5


def drop_boilerplate(docs: DataFrame, site: str = "source", text: str = "text", max_ratio: float = MAX_RATIO, min_pages: int = MIN_PAGES) -> DataFrame:
    """Removes from each text the lines that more than `max_ratio` of its site's pages hold.

    A line is what stands between two line feeds; it is compared as it is. Lines of spaces or nothing
    aren't counted or removed. A page counts once for a line, however often it holds it; every row is a
    page, repeated rows too. A text of boilerplate lines only stays whole: it is a copy of a page, which
    is the affair of near-duplicate removal. Pages with a null site are one site of their own. A null
    text stays null, an empty one empty.

    Returns all columns, with the new text in place, and n_lines and n_dropped (long; replaced if the
    input has such columns).

    Pages per line are counted from partial counts of each task, so a line or site with a third of all
    rows is no group of rows anywhere. The joins are equi-joins that Spark can split where a key is hot.
    """
    key, line, pages, total, drop = fresh(docs, "key", "line", "pages", "total", "drop")
    host = F.col(site)
    digest = lambda x: F.md5(x.cast("binary"))
    solid = lambda x: x.rlike(r"[^ \t\x0B\f\r]")
    keyed = docs.withColumn(key, F.sha2(F.concat_ws("\x01", host.cast("string"), F.when(host.isNull(), F.lit("\x02")), F.col(text)), 256))
    lines = keyed.select(key, host.alias(site), F.explode(F.array_distinct(F.filter(F.split(text, "\n", -1), solid))).alias(line)).withColumn(line, digest(F.col(line)))
    totals = docs.groupBy(host.alias(site)).agg(F.count(F.lit(1)).alias(total))
    counts = lines.groupBy(site, line).agg(F.count(F.lit(1)).alias(pages)).where(F.col(pages) >= min_pages)
    left, right = counts.alias("c"), totals.alias("t")
    boiler = left.join(right, F.col(f"c.{site}").eqNullSafe(F.col(f"t.{site}"))).where(F.col(pages) > F.lit(max_ratio) * F.col(total)).select(F.col(f"c.{site}").alias(site), line)
    hits = lines.alias("l").join(boiler.alias("b"), (F.col(f"l.{line}") == F.col(f"b.{line}")) & F.col(f"l.{site}").eqNullSafe(F.col(f"b.{site}")), "left_semi")
    per_key = hits.groupBy(key).agg(F.collect_set(line).alias(drop))  # no more than the lines of one text
    parts = F.split(text, "\n", -1)
    stays = lambda x: ~(solid(x) & F.array_contains(F.col(drop), digest(x)))
    kept = F.filter(parts, stays)
    emptied = ~F.exists(kept, solid)
    change = F.col(drop).isNotNull() & ~emptied
    out = keyed.join(per_key, key, "left")
    n_lines = F.coalesce(F.size(F.filter(parts, solid)), F.lit(0)).cast("long")
    n_lines = F.when(F.col(text).isNull(), F.lit(0).cast("long")).otherwise(n_lines)
    n_dropped = F.when(change, (F.size(parts) - F.size(kept)).cast("long")).otherwise(F.lit(0).cast("long"))
    new = F.when(change, F.array_join(kept, "\n")).otherwise(F.col(text))
    columns = [F.col(c) for c in docs.columns if c.lower() not in (text.lower(), "n_lines", "n_dropped")]
    return out.select(*columns, n_lines.alias("n_lines"), n_dropped.alias("n_dropped"), new.alias(text))


def op6_site_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = drop_boilerplate(read(spark, sf_dir, "documents"))
    return out.select("doc_id", "source", "n_lines", "n_dropped", "text")


ORACLE = f"""
WITH d AS (
  SELECT row_number() OVER () AS rid, doc_id, source, text, string_split(text, chr(10)) AS parts FROM documents
), l AS (
  SELECT rid, source, unnest(list_distinct(list_filter(parts, lambda x: regexp_matches(x, '[^ \\t\\x0B\\f\\r]')))) AS line FROM d
), t AS (
  SELECT source, count(*) AS total FROM d GROUP BY source
), b AS (
  SELECT l.source, l.line FROM l JOIN t ON l.source IS NOT DISTINCT FROM t.source
  GROUP BY l.source, l.line, t.total HAVING count(*) >= {MIN_PAGES} AND count(*) > CAST({MAX_RATIO} AS DOUBLE) * t.total
), h AS (
  SELECT l.rid, list(l.line) AS gone FROM l JOIN b ON l.line = b.line AND l.source IS NOT DISTINCT FROM b.source GROUP BY l.rid
), k AS (
  SELECT d.*, list_filter(parts, lambda x: NOT list_contains(coalesce(gone, []), x)) AS kept FROM d LEFT JOIN h USING (rid)
), c AS (
  SELECT *, len(list_filter(kept, lambda x: regexp_matches(x, '[^ \\t\\x0B\\f\\r]'))) > 0 AS partly FROM k
)
SELECT doc_id, source, CAST(coalesce(len(list_filter(parts, lambda x: regexp_matches(x, '[^ \\t\\x0B\\f\\r]'))), 0) AS BIGINT) AS n_lines,
  CAST(CASE WHEN partly THEN len(parts) - len(kept) ELSE 0 END AS BIGINT) AS n_dropped,
  CASE WHEN partly THEN array_to_string(kept, chr(10)) ELSE text END AS text
FROM c
"""

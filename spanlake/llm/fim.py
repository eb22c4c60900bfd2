"""Operator 12: fill-in-middle transformation, cut by a matcher that streams over each text twice."""

from __future__ import annotations

import re
from collections.abc import Iterator
from itertools import islice

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from spanlake.llm.frames import bound_batches, fresh, read, text_or_empty

#: A unit is a word with the white space before it, or white space that no word follows.
UNIT = re.compile(r"[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+")
PREFIX, SUFFIX, MIDDLE = MARKS = ("<P>", "<S>", "<M>")
#: Seed of the draws, percent of texts that are transformed, and percent of those that take the form spm.
SEED, RATE, SPM_RATE = 42, 50, 80
#: Characters of output that a task hands back at once; a longer text is handed back alone.
SLICE_CHARS = 1 << 22


def places(text: str, first: int, second: int) -> tuple[int, int, int]:
    """Number of units, and the places after the ranks min and max of first % (n + 1) and second % (n + 1).

    The text is matched twice: once to count, once more as far as the second rank. No list of units is ever made.
    """
    n = sum(1 for _ in UNIT.finditer(text))
    a, b = sorted((first % (n + 1), second % (n + 1)))
    matches, at = UNIT.finditer(text), []
    for more in (a, b - a):
        last = at[-1] if at else 0
        for unit in islice(matches, more):
            last = unit.end()
        at.append(last)
    return n, at[0], at[1]


def draws(key: Column, seed: int) -> list[Column]:
    """Four numbers below 2**32 that depend on the seed and the key's text alone."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), key).cast("binary"), 256)
    return [F.conv(F.substring(digest, 8 * i + 1, 8), 16, 10).cast("long") for i in range(4)]


def arranged(form: str, prefix: str, middle: str, suffix: str) -> str:
    return PREFIX + prefix + SUFFIX + suffix + MIDDLE + middle if form == "psm" else SUFFIX + suffix + PREFIX + prefix + MIDDLE + middle


def transform(docs: DataFrame, key: str = "doc_id", text: str = "text", seed: int = SEED, rate: int = RATE, spm_rate: int = SPM_RATE) -> DataFrame:
    """n_units (long), form (plain, psm or spm), output (string), prefix_chars and middle_chars (long) beside the other columns.

    The text is cut after the ranks of two draws into prefix, middle and suffix, which `form` puts in another order between
    marks. A null or empty text, one that holds a mark, and those that the rate leaves out are plain: output is the text (empty
    for null), the two lengths, in code points, are null. Draws depend on the key's text form alone (a null key: empty text), so
    repeated rows get equal results and a run anew agrees. The text is replaced; columns of these names are too; other columns
    stay. Nothing is shuffled, and a task holds one batch of texts and what it returns of them, SLICE_CHARS at once.
    """
    h1, h2, h3, h4 = draws(F.coalesce(F.col(key).cast("string"), F.lit("")), seed)
    whole = text_or_empty(text)
    marked = whole.contains(MARKS[0]) | whole.contains(MARKS[1]) | whole.contains(MARKS[2])
    form = F.when((whole == "") | marked | (F.pmod(h3, F.lit(100)) >= rate), "plain").when(F.pmod(h4, F.lit(100)) < spm_rate, "spm").otherwise("psm")
    made = {"n_units": "long", "form": "string", "output": "string", "prefix_chars": "long", "middle_chars": "long"}
    others = [c for c in docs.columns if c.lower() != text.lower() and c.lower() not in made]
    body, first, second, shape = fresh(docs, "body", "first", "second", "shape")
    rows = docs.select(*others, whole.alias(body), h1.alias(first), h2.alias(second), form.alias(shape))

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            done, chars, start = [], 0, 0
            for i in range(batch.num_rows):
                whole, a, b, kind = (batch.column(len(others) + k)[i].as_py() for k in range(4))
                n, x, y = places(whole, a, b)
                done.append((n, kind, whole, None, None) if kind == "plain" else (n, kind, arranged(kind, whole[:x], whole[x:y], whole[y:]), x, y - x))
                chars += len(whole)
                if chars >= SLICE_CHARS or i == batch.num_rows - 1:
                    columns = [pa.array(c, t) for c, t in zip(zip(*done, strict=True), (pa.int64(), pa.string(), pa.string(), pa.int64(), pa.int64()), strict=True)]
                    yield pa.RecordBatch.from_arrays([*batch.slice(start, len(done)).columns[: len(others)], *columns], names=[*others, *made])
                    done, chars, start = [], 0, i + 1

    kinds = dict(docs.dtypes)
    return rows.mapInArrow(cut, ", ".join([*(f"`{c}` {kinds[c]}" for c in others), *(f"{c} {t}" for c, t in made.items())]))


def restored(output: Column, form: Column) -> Column:
    """The text that an output was made from: the marks of a form stand once each, in a known order."""
    parts = F.split(output, "|".join(MARKS), -1)
    part = lambda i: F.try_element_at(parts, F.lit(i))
    return F.when(form == "psm", F.concat(part(2), part(4), part(3))).when(form == "spm", F.concat(part(3), part(4), part(2))).otherwise(output)


def op12_streaming_fill_in_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    bound_batches(spark)
    done = transform(read(spark, sf_dir, "documents").select("doc_id", "text"))
    digest = lambda c: F.sha2(c.cast("binary"), 256)
    return done.select("doc_id", F.col("n_units").alias("n"), "form", "prefix_chars", "middle_chars", digest(F.col("output")).alias("output_sha256"), digest(restored(F.col("output"), F.col("form"))).alias("restored_sha256"))


ORACLE = f"""
WITH d AS (
  SELECT doc_id, coalesce(text, '') AS t, sha256('{SEED}:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS h FROM documents
), u AS (
  SELECT doc_id, t, regexp_extract_all(t, '[\\x20\\x09-\\x0D]*[^\\x20\\x09-\\x0D]+|[\\x20\\x09-\\x0D]+') AS units,
    CAST('0x' || substr(h, 1, 8) AS BIGINT) AS h1, CAST('0x' || substr(h, 9, 8) AS BIGINT) AS h2, CAST('0x' || substr(h, 17, 8) AS BIGINT) AS h3, CAST('0x' || substr(h, 25, 8) AS BIGINT) AS h4
  FROM d
), r AS (
  SELECT doc_id, t, units, CAST(len(units) AS BIGINT) AS n, least(h1 % (len(units) + 1), h2 % (len(units) + 1)) AS a, greatest(h1 % (len(units) + 1), h2 % (len(units) + 1)) AS b,
    CASE WHEN t = '' OR contains(t, '<P>') OR contains(t, '<S>') OR contains(t, '<M>') OR h3 % 100 >= {RATE} THEN 'plain' WHEN h4 % 100 < {SPM_RATE} THEN 'spm' ELSE 'psm' END AS form
  FROM u
), p AS (
  SELECT doc_id, t, n, form, array_to_string(units[1:a], '') AS prefix, array_to_string(units[a + 1:b], '') AS middle, array_to_string(units[b + 1:n], '') AS suffix FROM r
)
SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN CAST(length(prefix) AS BIGINT) END AS prefix_chars, CASE WHEN form <> 'plain' THEN CAST(length(middle) AS BIGINT) END AS middle_chars,
  sha256(CASE form WHEN 'plain' THEN t WHEN 'psm' THEN '<P>' || prefix || '<S>' || suffix || '<M>' || middle ELSE '<S>' || suffix || '<P>' || prefix || '<M>' || middle END) AS output_sha256,
  sha256(CASE form WHEN 'plain' THEN t ELSE prefix || middle || suffix END) AS restored_sha256
FROM p
"""

"""Queries whose inputs differ from row to row: texts of documents and turns, blank, null, nested, repeated and unknown parts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from spanlake.catalog import query
from spanlake.functions import names, prompts, values
from spanlake.sources import fixtures

#: Pieces of templates, in turn; what stands in braces is a variable, a name of none, nested or nothing.
_PIECES = ("{{ name }} and {{name}} {{b}}", "{{ é }} {x}", "{{a.b_1}}{{{c}}}", "{}}{{", "{{ }} {{1a}} {{_}}", "{{b}} {{ a }} {{b}} \\ {\"k\": {{a}}}", "")
_VARIABLE = r"\{\{\s*([A-Za-z_][A-Za-z0-9_.]*)\s*\}\}"


def _picked(unit: Column, values_: tuple[str, ...]) -> Column:
    return F.element_at(F.array(*[F.lit(x) for x in values_]), (unit + 1).cast("int"))


_PIECE_SQL = "CASE (conv_id + turn) % 8 " + " ".join(f"WHEN {i} THEN '{p}'" for i, p in enumerate(_PIECES)) + " END"
_TEMPLATE_SQL = (
    "WITH t AS (SELECT conv_id, turn, CASE WHEN (conv_id + turn) % 8 < 7 THEN role || ' ' || " + _PIECE_SQL + " || ' ' || left(text, 60) END AS x FROM conversations), "
    "v AS (SELECT *, regexp_extract_all(x, '" + _VARIABLE + "', 1) AS l, regexp_replace(x, '" + _VARIABLE + r"', chr(1) || '\1' || chr(2), 'g') AS marked FROM t) "
    "SELECT conv_id, turn, replace(replace(replace(replace(marked, '{', '{{'), '}', '}}'), chr(1), '{'), chr(2), '}') AS template, "
    "array_to_string(list_filter(l, lambda x, i: list_position(l, x) = i), ',') AS variables FROM v"
)


@query(_TEMPLATE_SQL)
def varied_templates(spark: SparkSession, d: str) -> DataFrame:
    """Templates with repeated, nested, unknown and no variables around the texts of turns."""
    t, unit = fixtures.table(spark, d, "conversations"), (F.col("conv_id") + F.col("turn")) % 8
    text = F.when(unit < 7, F.concat("role", F.lit(" "), _picked(F.least(unit, F.lit(6)), _PIECES), F.lit(" "), F.left("text", F.lit(60))))
    return t.select("conv_id", "turn", prompts.template(text).alias("template"), F.array_join(prompts.template_variables(text), ",").alias("variables"))


@query("""WITH t AS (SELECT conv_id, turn, [role, CASE (conv_id + turn) % 5 WHEN 0 THEN 'LATEST' WHEN 1 THEN ' latest  ' WHEN 2 THEN '   ' WHEN 3 THEN NULL ELSE 'latest-2' END, left(text, 1 + conv_id % 9), CASE WHEN turn % 2 = 0 THEN role END] AS l FROM conversations)
SELECT conv_id, turn, array_to_string(list_filter(l, lambda x: trim(x) <> '' AND lower(trim(x)) <> 'latest'), '|') AS labels FROM t""")
def varied_labels(spark: SparkSession, d: str) -> DataFrame:
    """Labels of which some are blank, null, repeated or the newest version's own."""
    t, unit = fixtures.table(spark, d, "conversations"), (F.col("conv_id") + F.col("turn")) % 5
    odd = F.when(unit != 3, _picked(unit, ("LATEST", " latest  ", "   ", "", "latest-2")))
    labels = F.array("role", odd, F.left("text", (F.col("conv_id") % 9 + 1).cast("int")), F.when(F.col("turn") % 2 == 0, F.col("role")))
    return t.select("conv_id", "turn", F.array_join(prompts.prompt_labels(labels), "|").alias("labels"))


_PART = "substr(text, 1 + CAST(doc_id % 40 AS INTEGER), 10 + CAST(doc_id % 90 AS INTEGER))"
_CLEAN = r"regexp_replace({x}, '^\s+|\s+$', '', 'g')"


@query(rf"""WITH t AS (SELECT doc_id, CASE WHEN doc_id % 7 = 0 THEN NULL WHEN doc_id % 7 = 1 THEN ' -- ' || {_PART} || '__!' ELSE {_PART} END AS x FROM documents),
c AS (SELECT *, regexp_replace({_CLEAN.format(x=r"regexp_replace(" + _CLEAN.format(x="x") + r", '[^a-zA-Z0-9_\s]+', '_', 'g')")}, '_{{2,}}', '_', 'g') AS clean,
  regexp_replace(regexp_replace({_CLEAN.format(x="x")}, '[^a-zA-Z0-9_-]+', '-', 'g'), '^[-_]+|[-_]+$', '', 'g') AS p FROM t)
SELECT doc_id, nullif(clean, '') AS clean, regexp_replace(left(p, 60), '^[-_]+|[-_]+$', '', 'g') AS project, CASE WHEN coalesce(x, '') = '' THEN '<unset>' ELSE left(x, 4) || '…<' || length(x) || ' chars>' END AS secret,
  regexp_matches(upper(x), 'KEY|SECRET|TOKEN|PASSWORD|CREDENTIAL') AS hidden FROM c""")
def varied_names(spark: SparkSession, d: str) -> DataFrame:
    """Names of columns and projects from pieces of documents, null ones too."""
    docs, unit = fixtures.table(spark, d, "documents"), F.col("doc_id") % 7
    part = F.substring(F.col("text"), (F.col("doc_id") % 40 + 1).cast("int"), (F.col("doc_id") % 90 + 10).cast("int"))
    x = F.when(unit == 0, None).when(unit == 1, F.concat(F.lit(" -- "), part, F.lit("__!"))).otherwise(part)
    return docs.select("doc_id", names.column_name(x).alias("clean"), names.project_name(x).alias("project"), names.redacted(x).alias("secret"), names.is_secret(x).alias("hidden"))


@query("""WITH p AS (SELECT p_partkey, p_size, replace(p_name, ' ', '_') AS k FROM part)
SELECT p_partkey, CASE WHEN p_size % 4 = 3 THEN NULL WHEN p_size % 4 = 1 THEN CAST(p_size AS VARCHAR) END AS top_k, CASE WHEN p_size % 4 <> 3 AND p_size % 3 = 0 THEN CAST(CAST('0.' || p_size AS DOUBLE) AS VARCHAR) END AS temperature,
  CASE WHEN p_size % 4 = 3 THEN '' ELSE array_to_string(list_sort(list_concat(['é' || k], CASE WHEN p_size % 2 = 0 THEN ['Top_K'] ELSE [] END)), ',') END AS dropped FROM p""")
def varied_settings(spark: SparkSession, d: str) -> DataFrame:
    """Settings of prompts of which some are unknown, null or no object."""
    size, key = F.col("p_size").cast("string"), F.replace(F.col("p_name"), F.lit(" "), F.lit("_"))
    unit = F.col("p_size") % 4
    config = F.concat(F.lit('{"é'), key, F.lit('":{"x":[1]},"model":"m"'), F.when(F.col("p_size") % 2 == 0, ',"Top_K":1').otherwise(""), F.when(unit == 1, F.concat(F.lit(',"top_k":'), size)).otherwise(',"top_k":null'), F.when(F.col("p_size") % 3 == 0, F.concat(F.lit(',"temperature":0.'), size)).otherwise(""), F.lit("}"))
    taken, dropped = prompts.invocation_split(F.when(unit != 3, config))
    return fixtures.table(spark, d, "part").select("p_partkey", F.try_element_at(taken, F.lit("top_k")).alias("top_k"), F.try_element_at(taken, F.lit("temperature")).alias("temperature"), F.array_join(dropped, ",").alias("dropped"))


@query("""WITH t AS (SELECT conv_id, turn, role, turn % 5 AS gap FROM conversations)
SELECT conv_id, turn, CAST(i AS INTEGER) AS place, CASE WHEN i = gap THEN role END AS role, CASE WHEN i = 0 AND gap > 0 THEN 'x' || conv_id END AS content FROM t, range(5) r(i) WHERE i <= gap""")
def varied_folds(spark: SparkSession, d: str) -> DataFrame:
    """Flat indexed names with gaps of any size, as lists."""
    t = fixtures.table(spark, d, "conversations")
    gap = F.col("turn") % 5
    first = F.when(gap > 0, F.map_from_arrays(F.array(F.lit("m.0.content"), F.lit("m.x.role")), F.array(F.concat(F.lit("x"), F.col("conv_id").cast("string")), F.lit("n")))).otherwise(F.create_map().cast("map<string,string>"))
    flat = F.map_concat(first, F.create_map(F.concat(F.lit("m."), gap.cast("string"), F.lit(".role")), F.col("role")))
    rows = t.select("conv_id", "turn", F.posexplode(values.fold_indexed(flat, "m")).alias("place", "m"))
    return rows.select("conv_id", "turn", "place", F.try_element_at("m", F.lit("role")).alias("role"), F.try_element_at("m", F.lit("content")).alias("content"))

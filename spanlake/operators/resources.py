"""Prompts, datasets, score configurations, judges and rules: what can be carried over, and why the rest can't."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from spanlake.functions import names, prompts


def score_configs(configs: DataFrame) -> DataFrame:
    """name, kind, values or bounds, reason and notes of score configurations (name, data_type, categories array of (label, value), low, high, description)."""
    kind = F.upper(F.trim("data_type"))
    listed = kind.isin("CATEGORICAL", "BOOLEAN")
    labelled = (F.coalesce(F.size("categories"), F.lit(0)) > 0) & F.forall("categories", lambda c: F.coalesce(F.trim(c["label"]), F.lit("")) != "")
    bounded = F.col("low").isNotNull() & F.col("high").isNotNull()
    clean = names.column_name(F.col("name"))
    reason = F.when(clean.isNull(), "name is empty").when(listed & ~F.coalesce(labelled, F.lit(False)), "no labelled categories").when((kind == "NUMERIC") & ~bounded, "no bounds").when(~listed & (F.coalesce(kind, F.lit("")) != "NUMERIC"), "unknown data type")
    note = F.when(F.coalesce("description", F.lit("")) != "", "description is lost")
    return configs.select(F.col("name").alias("source_name"), clean.alias("name"), F.when(listed, "categorical").when(kind == "NUMERIC", "continuous").alias("kind"), F.when(listed, F.col("categories")).alias("values"), F.when(~listed, F.col("low")).alias("low"), F.when(~listed, F.col("high")).alias("high"), reason.alias("reason"), note.alias("note"))


def prompt_versions(versions: DataFrame) -> DataFrame:
    """Payload and refusal of each prompt version (name, version, body, is_list, config, labels, message); one bad version refuses its prompt."""
    config = prompts.invocation_split(F.col("config"))
    model = F.get_json_object("config", "$.model")
    made = versions.select(
        "name", F.col("version").cast("int").alias("version"), prompts.prompt_messages(F.col("body"), F.col("is_list")).alias("messages"), prompts.provider(model).alias("provider"), model.alias("model"),
        F.lit(prompts.VARIABLE_FORMAT).alias("variable_format"), config[0].alias("parameters"), config[1].alias("dropped"), prompts.prompt_labels(F.col("labels")).alias("labels"), prompts.commit_message(F.col("message"), F.col("version")).alias("message"),
        prompts.prompt_refusal(F.col("body"), F.col("is_list")).alias("refusal"),
    )
    bad = made.where("refusal IS NOT NULL").groupBy("name").agg(F.min("refusal").alias("prompt_refusal"))
    return made.join(bad, "name", "left")


def ordered_versions(versions: DataFrame, key: str = "name", version: str = "version") -> DataFrame:
    """Versions with place, from 0 in the order of their numbers; versions that are no numbers come last, as text."""
    order = [F.col(version).try_cast("int").asc_nulls_last(), F.col(version)]
    return versions.withColumn("place", F.row_number().over(Window.partitionBy(key).orderBy(*order)) - 1)


def with_bodies(summaries: DataFrame, bodies: DataFrame) -> DataFrame:
    """Each version that a prompt's summary lists (name, versions array) with its body (name, version, ...); a version without a body has nulls."""
    listed = summaries.select("name", F.explode("versions").alias("version"))
    return listed.join(bodies, ["name", "version"], "left")


def dataset_notes(items: DataFrame) -> DataFrame:
    """dataset, items, note: active items of each dataset; one without any is noted, not refused."""
    active = F.upper(F.coalesce("status", F.lit("ACTIVE"))) == "ACTIVE"
    return items.groupBy("dataset").agg(F.count_if(active).alias("items")).withColumn("note", F.when(F.col("items") == 0, "no active items"))


def dataset_examples(items: DataFrame) -> DataFrame:
    """dataset, item, cells: a map of the columns of each active item (id, dataset, input, expected, metadata, status as JSON or plain text).

    An input object's keys become columns; metadata keys get a prefix. Of columns that would have one name the first, of
    the input before others, has it, and each further one the first of `_2`, `_3` and so on that is free.
    """
    of = "map<string,string>"
    obj = lambda c: F.when(F.trim(c).startswith("{"), F.map_entries(F.from_json(c, of)))
    one = lambda name, value: F.array(F.struct(F.lit(name).alias("key"), value.cast("string").alias("value")))
    named = lambda entries, name: F.transform(entries, lambda e: F.struct(name(F.trim(e["key"])).alias("key"), e["value"].alias("value")))
    none = F.array().cast("array<struct<key: string, value: string>>")
    given = F.coalesce(named(obj(F.col("input")), lambda k: F.when(k == "", "input").otherwise(k)), one("input", F.col("input")))
    meta = F.coalesce(named(obj(F.col("metadata")), lambda k: F.concat(F.lit("metadata_"), k)), F.when(F.col("metadata").isNotNull(), one("metadata", F.col("metadata"))), none)
    more = F.concat(F.when(F.col("expected").isNotNull(), one("expected_output", F.col("expected"))).otherwise(none), meta, F.when(F.col("id").isNotNull(), one("source_item_id", F.col("id"))).otherwise(none))

    def put(cells: Column, entry: Column) -> Column:
        tries = F.transform(F.sequence(F.lit(1), F.size(cells) + 1), lambda i: F.when(i == 1, entry["key"]).otherwise(F.concat(entry["key"], F.lit("_"), i.cast("string"))))
        free = F.element_at(F.filter(tries, lambda name: ~F.array_contains(F.map_keys(cells), name)), 1)
        return F.map_concat(cells, F.map_from_arrays(F.array(free), F.array(entry["value"])))

    active = items.where(F.upper(F.coalesce("status", F.lit("ACTIVE"))) == "ACTIVE")
    return active.select("dataset", F.col("id").alias("item"), F.aggregate(F.concat(given, more), F.create_map().cast(of), put).alias("cells"))


def dataset_columns(examples: DataFrame) -> DataFrame:
    """dataset, column, rows, place: every column that an item of a dataset has, in the order in which they are first seen by item and place in it."""
    each = examples.select("dataset", "item", F.posexplode(F.map_keys("cells")).alias("at", "column"))
    seen = each.groupBy("dataset", "column").agg(F.count(F.lit(1)).alias("rows"), F.min(F.struct("item", "at")).alias("first"))
    return seen.select("dataset", "column", "rows", (F.row_number().over(Window.partitionBy("dataset").orderBy("first", "column")) - 1).alias("place"))


def dataset_rows(examples: DataFrame) -> DataFrame:
    """dataset, item, names, cells: the columns of the dataset in order, and each item's cells in that order, null where it has none."""
    names_ = dataset_columns(examples).groupBy("dataset").agg(F.transform(F.array_sort(F.collect_list(F.struct("place", "column"))), lambda c: c["column"]).alias("names"))
    return examples.join(names_, "dataset").select("dataset", "item", "names", F.transform("names", lambda c: F.try_element_at("cells", c)).alias("cells"))


def judges(evaluators: DataFrame, configs: DataFrame, integrations: Column, default_integration: str | None, default_model: str | None) -> DataFrame:
    """name, template, variables, choices, integration, model, refusal, note of judges.

    evaluators: id, name, type, messages, provider, model, data_type, categories, low, high, value_guidance,
    reason_guidance; configs: name and scores (map of label to number) of score configurations; integrations: a map.
    """
    joined = evaluators.join(configs.select("name", "scores"), "name", "left")
    kind = F.upper("data_type")
    placed = prompts.categorical_choices(F.col("categories"), F.col("scores"))
    yes_no = F.array(F.struct(F.lit("true").alias("label"), F.lit(1.0).alias("score")), F.struct(F.lit("false").alias("label"), F.lit(0.0).alias("score")))
    choices = F.when(kind == "BOOLEAN", yes_no).when(kind == "CATEGORICAL", placed).when(kind == "NUMERIC", prompts.numeric_choices(F.col("low"), F.col("high")))
    made = joined.withColumn("choices", choices)
    hints = prompts.guidance(F.col("value_guidance"), F.col("reason_guidance"), F.transform("choices", lambda c: c["label"]))
    body = F.concat_ws("\n\n", prompts.flat_prompt(F.col("messages")), F.when(hints != "", hints))
    integration = F.coalesce(F.try_element_at(integrations, F.lower("provider")), F.lit(default_integration).cast("string"))
    model = F.coalesce("model", F.lit(default_model).cast("string"))
    variables = prompts.template_variables(body)
    refusal = (
        F.when(F.col("type") != "llm_as_judge", "not a judge").when(integration.isNull(), "no integration").when(model.isNull(), "no model")
        .when((kind == "CATEGORICAL") & F.col("choices").isNull(), "fewer than two categories").when(~kind.isin("BOOLEAN", "CATEGORICAL", "NUMERIC"), "unknown output")
        .when(F.size(variables) < 1, "no variables").when(names.column_name(F.col("name")).isNull(), "name is empty")
    )
    note = F.when((kind == "NUMERIC") & F.col("choices").isNull(), "freeform output").when((kind == "CATEGORICAL") & F.col("scores").isNull(), "scores by place")
    return made.select("id", names.column_name(F.col("name")).alias("name"), prompts.template(body).alias("template"), variables.alias("variables"), "choices", integration.alias("integration"), model.alias("model"), refusal.alias("refusal"), note.alias("note"))


def column_mappings(bindings: DataFrame, variables: DataFrame) -> DataFrame:
    """evaluator, variable, column, note: bindings (evaluator, variable, source, path) of an evaluator's variables; input and output bind themselves."""
    known = bindings.where(F.col("variable").isNotNull()).withColumn("column", prompts.source_column(F.col("source"), F.col("path")))
    own = prompts.source_column(F.col("variable"), F.lit(None).cast("string"))
    joined = variables.join(known.select("evaluator", "variable", "source", "column"), ["evaluator", "variable"], "full_outer")
    column = F.coalesce("column", F.when(F.col("variable").isin("input", "output"), own))
    note = F.when(column.isNotNull(), None).when(F.lower("source").isin(*prompts.UNMAPPABLE_SOURCES), "source has no column").when(F.col("source").isNotNull(), "unknown source").otherwise("unbound")
    return joined.select("evaluator", "variable", column.alias("column"), note.alias("note"))


def rule_tasks(rules: DataFrame, evaluators: DataFrame, created: DataFrame) -> DataFrame:
    """rule, evaluator, created_id, sampling, continuous, note of each assignment of each rule (name, filter, sampling, enabled, evaluator_ids array).

    A rule with a filter is not planned; nor are evaluators that are code, unknown or not created.
    """
    each = rules.select(F.col("name").alias("rule"), "filter", "sampling", "enabled", F.explode("evaluator_ids").alias("evaluator"))
    joined = each.join(evaluators.select(F.col("id").alias("evaluator"), "type"), "evaluator", "left").join(created.select(F.col("id").alias("evaluator"), "created_id"), "evaluator", "left")
    note = F.when(F.coalesce("filter", F.lit("")).isin("", "[]", "{}") == F.lit(False), "rule has a filter").when(F.col("type").isNull(), "unknown evaluator").when(F.col("type") != "llm_as_judge", "code evaluator").when(F.col("created_id").isNull(), "not created")
    return joined.select("rule", "evaluator", F.when(note.isNull(), F.col("created_id")).alias("created_id"), F.col("sampling").cast("double").alias("sampling"), F.coalesce("enabled", F.lit(False)).alias("continuous"), note.alias("note"))


def rule_mappings(assignments: DataFrame, mappings: DataFrame) -> DataFrame:
    """rule, evaluator, variable, column, own: the columns that an assignment's variables read.

    assignments: rule, evaluator, overrides (array of variable, source, path); mappings: evaluator, variable, column. An
    override with a column goes before the evaluator's own.
    """
    base = assignments.select("rule", "evaluator").join(mappings.select("evaluator", "variable", F.col("column").alias("_base")), "evaluator")
    over = assignments.select("rule", "evaluator", F.explode("overrides").alias("o")).select("rule", "evaluator", "o.variable", prompts.source_column(F.col("o.source"), F.col("o.path")).alias("_over"))
    joined = base.join(over, ["rule", "evaluator", "variable"], "full_outer")
    return joined.select("rule", "evaluator", "variable", F.coalesce("_over", "_base").alias("column"), F.col("_over").isNotNull().alias("own"))


def code_exports(evaluators: DataFrame) -> DataFrame:
    """id, file, content of code evaluators (id, name, version, language, description, code): not created, written out to be ported."""
    return evaluators.select("id", prompts.code_file(F.col("name"), F.col("id"), F.col("language")).alias("file"), prompts.code_content(F.col("name"), F.col("id"), F.col("version"), F.col("language"), F.col("description"), F.col("code")).alias("content"))


def outcomes(family: str, planned: DataFrame, name: str, reason: Column, existing: DataFrame | None = None, note: Column | None = None) -> DataFrame:
    """family, name, outcome, detail of each planned resource: failed with a reason, skipped if its name is there, else created (with a note)."""
    rows = planned.select(F.col(name).cast("string").alias("name"), reason.alias("_reason"), (F.lit(None) if note is None else note).cast("string").alias("_note"))
    there = F.lit(False)
    if existing is not None:
        rows = rows.join(existing.select(F.col("name").cast("string").alias("_there")).distinct(), F.col("name") == F.col("_there"), "left")
        there = F.col("_there").isNotNull()
    outcome = F.when(F.col("_reason").isNotNull(), "failed").when(there, "skipped").otherwise("created")
    return rows.select(F.lit(family).alias("family"), "name", outcome.alias("outcome"), F.coalesce("_reason", "_note").alias("detail"))


def skip_existing(wanted: DataFrame, existing: DataFrame, name: str = "name") -> DataFrame:
    """Wanted rows whose name isn't there yet."""
    return wanted.join(existing.select(name).distinct(), name, "left_anti")


def overlay(defaults: DataFrame, versions: DataFrame, key: str, *columns: str) -> DataFrame:
    """A row a version: its own values before the defaults'."""
    d = defaults.select(key, *[F.col(c).alias(f"_{c}") for c in columns])
    return versions.join(d, key, "left").withColumns({c: F.coalesce(c, f"_{c}") for c in columns}).drop(*[f"_{c}" for c in columns])


def report(outcomes: DataFrame) -> DataFrame:
    """family, outcome, resources."""
    return outcomes.groupBy("family", "outcome").agg(F.count(F.lit(1)).alias("resources"))

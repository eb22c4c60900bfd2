"""Resources of all families, in the order in which they need each other; a family that fails doesn't stop the others."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass, field, replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from spanlake.operators import resources
from spanlake.plans.tables import read_table
from spanlake.plans.settings import Settings
from spanlake.sources import writers
from spanlake.sources.readers import Source

FAMILIES = ("score_configs", "prompts", "datasets", "evaluators", "rules")


@dataclass
class Options:
    """How evaluators are made: integrations by provider, what others get, where code goes, and whether rules become tasks, which cost money."""

    integrations: dict[str, str] = field(default_factory=dict)
    default_integration: str | None = None
    default_model: str | None = None
    code_folder: str | None = None
    tasks: bool = False

    @classmethod
    def of(cls, conf: Settings) -> Options:
        text = conf.get("SPANLAKE_INTEGRATIONS") or ""
        pairs = dict(part.split("=", 1) for part in text.split(",") if "=" in part)
        return cls({k.strip().lower(): v.strip() for k, v in pairs.items()}, conf.get("SPANLAKE_DEFAULT_INTEGRATION"), conf.get("SPANLAKE_DEFAULT_MODEL"), conf.get("SPANLAKE_CODE_FOLDER"), conf.get("SPANLAKE_CREATE_TASKS"))


def _existing(spark: SparkSession, target: str, family: str) -> DataFrame | None:
    return read_table(spark, f"{target}/resources/{family}")


def _score_configs(source: Source, options: Options) -> tuple[DataFrame, str]:
    return resources.score_configs(source.resources("score_configs")), "source_name"


def _prompts(source: Source, options: Options) -> tuple[DataFrame, str]:
    rows = source.resources("prompts")
    versions = rows.withColumn("is_list", F.coalesce((F.lower("kind") == "chat") | F.trim("body").startswith("["), F.lit(False)))
    made = resources.prompt_versions(resources.ordered_versions(versions))
    return made.groupBy("name").agg(F.first("prompt_refusal").alias("reason"), F.sort_array(F.collect_list(F.struct("version", "message", "messages", "model", "provider"))).alias("versions")), "name"


def _datasets(source: Source, options: Options) -> tuple[DataFrame, str]:
    items = source.resources("dataset_items")
    rows = resources.dataset_rows(resources.dataset_examples(items))
    held = rows.groupBy("dataset").agg(F.first("names").alias("names"), F.count(F.lit(1)).alias("rows"))
    return resources.dataset_notes(items).join(held, "dataset", "left").withColumn("reason", F.lit(None).cast("string")), "dataset"


def _evaluators(source: Source, options: Options) -> tuple[DataFrame, str]:
    rows = source.resources("evaluators")
    if options.code_folder:
        writers.write_code_files(resources.code_exports(rows.where("type <> 'llm_as_judge'")), options.code_folder)
    configs = source.resources("score_configs").select("name", F.map_from_entries(F.transform("categories", lambda c: F.struct(c["label"], c["value"]))).alias("scores"))
    pairs = [F.lit(x) for pair in options.integrations.items() for x in pair]
    known = F.create_map(*pairs).cast("map<string,string>")
    made = resources.judges(rows, configs.dropDuplicates(["name"]), known, options.default_integration, options.default_model)
    return made.withColumn("reason", F.col("refusal")), "name"


def _rules(source: Source, options: Options) -> tuple[DataFrame, str]:
    judges = _evaluators(source, Options(options.integrations, options.default_integration, options.default_model))[0]
    created = judges.where("reason IS NULL").select("id", F.col("name").alias("created_id"))
    tasks = resources.rule_tasks(source.resources("rules"), source.resources("evaluators"), created)
    held = tasks.groupBy("rule").agg(F.count_if(F.col("created_id").isNotNull()).alias("evaluators"), F.min("note").alias("note"))
    off = F.lit(None if options.tasks else "tasks are not asked for").cast("string")
    return held.withColumn("reason", F.coalesce(F.when(F.col("evaluators") == 0, F.coalesce("note", F.lit("no evaluator"))), off)), "rule"


MAKERS: dict[str, Callable[[Source, Options], tuple[DataFrame, str]]] = {"score_configs": _score_configs, "prompts": _prompts, "datasets": _datasets, "evaluators": _evaluators, "rules": _rules}


def migrate(spark: SparkSession, source: Source, target: str, options: Options | None = None, families: Sequence[str] = FAMILIES, dry: bool = False) -> DataFrame:
    """family, name, outcome, detail of every resource of the families; those created are written to the target's resources.

    What can't be made is failed with its reason; what is there is skipped. An unknown family, or one whose source can't be
    read, is one failed row, and the others go on. dry: nothing is written.
    """
    options = replace(options or Options(), code_folder=None) if dry else options or Options()
    out = spark.createDataFrame([], "family string, name string, outcome string, detail string")
    for family in families:
        try:
            if family not in MAKERS:
                raise ValueError("unknown family")
            planned, name = MAKERS[family](source, options)
            existing = _existing(spark, target, family)
            found = resources.outcomes(family, planned, name, F.col("reason"), None if existing is None else existing.select(F.col(name).alias("name")))
            rows = found.collect()  # a resource is configuration, set up by hand
            made = [r.name for r in rows if r.outcome == "created"]
            if made and not dry:
                fresh = planned.join(spark.createDataFrame([(m,) for m in made], "_name string"), F.col(name).cast("string") == F.col("_name"), "left_semi")
                fresh.write.mode("append").parquet(f"{target}/resources/{family}")
            out = out.unionByName(spark.createDataFrame(rows, found.schema) if rows else found.limit(0))
        except Exception as failed:  # noqa: BLE001  one family must not stop the others
            text = str(failed).splitlines()[0][:160] if str(failed) else type(failed).__name__
            out = out.unionByName(spark.createDataFrame([(family, None, "failed", text)], out.schema))
    return out


__all__ = ["FAMILIES", "Options", "migrate"]

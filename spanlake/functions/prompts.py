"""Prompts, model settings and evaluator templates as Column expressions over JSON text."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Message roles, providers by the start of a model's name, settings a model call takes, and settings that aren't ones.
ROLES = {"system": "SYSTEM", "user": "USER", "assistant": "ASSISTANT", "tool": "TOOL", "function": "TOOL"}
PROVIDERS = {
    "gpt-": "OPEN_AI", "o1": "OPEN_AI", "o3": "OPEN_AI", "o4": "OPEN_AI", "chatgpt": "OPEN_AI", "text-davinci": "OPEN_AI", "claude": "ANTHROPIC",
    "gemini": "VERTEX_AI", "bison": "VERTEX_AI", "anthropic.": "AWS_BEDROCK", "amazon.": "AWS_BEDROCK", "meta.": "AWS_BEDROCK", "mistral.": "AWS_BEDROCK",
}
INVOCATION_KEYS = (
    "temperature", "max_tokens", "max_completion_tokens", "top_p", "frequency_penalty", "presence_penalty", "stop", "response_format",
    "tool_config", "top_k", "thinking_level", "thinking_budget", "reasoning_effort", "verbosity",
)
NOT_INVOCATION_KEYS = ("model", "provider", "api_version", "deployment")
#: Span columns that an evaluator's variables read, and sources that have none.
SOURCE_COLUMNS = {"input": "attributes.input.value", "output": "attributes.output.value"}
UNMAPPABLE_SOURCES = ("tool_calls", "expected_output", "experiment_item_metadata")
NUMERIC_STEPS = 11
#: What a judge's prompt says before its guidance; judges are compared by their whole prompts.
GUIDANCE = ("Scoring guidance: ", "Reasoning guidance: ", "Respond with exactly one of: ")
#: Fixed value: how variables are written in the prompts that are made.
VARIABLE_FORMAT = "MUSTACHE"
_MUSTACHE = r"\{\{\s*([A-Za-z_][A-Za-z0-9_.]*)\s*\}\}"
_MESSAGES = "array<struct<role: string, content: string>>"


def provider(model: Column) -> Column:
    """The provider of a model by the longest start of its name that is known; others are CUSTOM."""
    name, out = F.lower(F.trim(model)), F.lit("CUSTOM")
    for prefix in sorted(PROVIDERS, key=len):
        out = F.when(name.startswith(prefix), PROVIDERS[prefix]).otherwise(out)
    return out


def invocation_split(config: Column) -> tuple[Column, Column]:
    """The settings of a JSON object that a model call takes (map of text), and the sorted names of those it doesn't."""
    settings = F.from_json(config, "map<string, string>")
    taken = F.map_filter(settings, lambda k, v: k.isin(*INVOCATION_KEYS) & v.isNotNull())
    dropped = F.array_sort(F.filter(F.map_keys(settings), lambda k: ~k.isin(*INVOCATION_KEYS, *NOT_INVOCATION_KEYS)))
    none = F.expr("array()").cast("array<string>")
    return F.coalesce(taken, F.create_map().cast("map<string,string>")), F.coalesce(dropped, none)


def prompt_messages(body: Column, is_list: Column) -> Column:
    """A prompt's messages with upper-case roles: a text is one of USER; null contents are empty."""
    known = F.create_map(*[F.lit(x) for pair in ROLES.items() for x in pair])
    listed = F.transform(F.from_json(body, _MESSAGES), lambda m: F.struct(F.try_element_at(known, F.lower(F.trim(m["role"]))).alias("role"), F.coalesce(m["content"], F.lit("")).alias("content")))
    return F.when(is_list, listed).otherwise(F.array(F.struct(F.lit("USER").alias("role"), body.alias("content"))))


def prompt_refusal(body: Column, is_list: Column) -> Column:
    """Why a prompt's body can't be taken, or null."""
    made = prompt_messages(body, is_list)
    return (
        F.when(body.isNull(), "no body")
        .when(~is_list & (F.regexp_replace(body, r"(?U)\s+", "") == ""), "empty body")
        .when(is_list & (F.coalesce(F.size(made), F.lit(0)) < 1), "no messages")
        .when(is_list & F.exists(made, lambda m: m["role"].isNull()), "unknown role")
    )


def prompt_labels(labels: Column) -> Column:
    """Labels but `latest` in any case and blanks."""
    return F.filter(labels, lambda x: (F.trim(x) != "") & (F.lower(F.trim(x)) != "latest"))


def commit_message(message: Column, version: Column) -> Column:
    return F.coalesce(F.when(F.trim(message) != "", F.trim(message)), F.concat(F.lit("Imported (version "), version.cast("string"), F.lit(")")))


def template(text: Column) -> Column:
    """A mustache template as an f-string template: {{v}} becomes {v}, every other brace is doubled."""
    marked = F.regexp_replace(text, _MUSTACHE, "\x01$1\x02")
    doubled = F.replace(F.replace(marked, F.lit("{"), F.lit("{{")), F.lit("}"), F.lit("}}"))
    return F.translate(doubled, "\x01\x02", "{}")


def template_variables(text: Column) -> Column:
    """The distinct variables of a mustache template in order."""
    return F.array_distinct(F.regexp_extract_all(text, F.lit(_MUSTACHE), F.lit(1)))


def flat_prompt(messages: Column) -> Column:
    """Messages as one text: a single user message is its content, others stand under [ROLE]."""
    part = lambda m: F.concat(F.lit("["), F.upper(F.coalesce(m["role"], F.lit("user"))), F.lit("]\n"), F.coalesce(m["content"], F.lit("")))
    only = (F.size(messages) == 1) & (F.lower(F.element_at(messages, 1)["role"]) == "user")
    return F.when(only, F.coalesce(F.element_at(messages, 1)["content"], F.lit(""))).otherwise(F.array_join(F.transform(messages, part), "\n\n"))


def guidance(value: Column, reasoning: Column, choices: Column) -> Column:
    """Lines of guidance for those of the three that are there; choices: names in order."""
    filled = lambda c: F.when(c != "", c)
    return F.concat_ws("\n", F.concat(F.lit(GUIDANCE[0]), filled(value)), F.concat(F.lit(GUIDANCE[1]), filled(reasoning)), F.when(F.size(choices) > 0, F.concat(F.lit(GUIDANCE[2]), F.array_join(choices, ", "))))


def numeric_choices(low: Column, high: Column) -> Column:
    """Eleven even steps of a range as (label, score); null if the range is open or empty."""
    from spanlake.functions.names import number_label

    step = (high - low) / (NUMERIC_STEPS - 1)
    made = F.transform(F.sequence(F.lit(0), F.lit(NUMERIC_STEPS - 1)), lambda i: F.struct(number_label(low + i * step).alias("label"), F.round(low + i * step, 6).alias("score")))
    return F.when(high > low, made)


def categorical_choices(labels: Column, configured: Column) -> Column:
    """Labels with scores: those configured if all labels have one, else by place from 1 down to 0."""
    top = F.size(labels) - 1
    all_known = (F.size(configured) > 0) & F.forall(labels, lambda x: F.try_element_at(configured, x).isNotNull())
    given = F.transform(labels, lambda x: F.struct(x.alias("label"), F.try_element_at(configured, x).alias("score")))
    placed = F.transform(labels, lambda x, i: F.struct(x.alias("label"), F.round(F.lit(1.0) - i / top, 4).alias("score")))
    return F.when(F.size(labels) < 2, None).when(F.coalesce(all_known, F.lit(False)), given).otherwise(placed)


def source_column(source: Column, path: Column) -> Column:
    """The span column that a variable's source names; null if there is none."""
    rest = F.regexp_replace(F.coalesce(F.trim(path), F.lit("")), r"\A\$\.?", "")
    known = F.create_map(*[F.lit(x) for pair in SOURCE_COLUMNS.items() for x in pair])
    return F.when(F.lower(source) == "metadata", F.concat(F.lit("attributes.metadata"), F.when(rest != "", F.concat(F.lit("."), rest)).otherwise(F.lit("")))).otherwise(F.try_element_at(known, F.lower(source)))


def code_file(name: Column, ident: Column, language: Column) -> Column:
    """A file name for an evaluator's code; the id keeps equal names apart."""
    suffix = F.when(F.upper(language) == "PYTHON", "py").when(F.upper(language) == "TYPESCRIPT", "ts").otherwise("txt")
    return F.concat(F.regexp_replace(F.coalesce(name, F.lit("evaluator")), "[^A-Za-z0-9_.-]+", "_"), F.lit("-"), F.coalesce(ident.cast("string"), F.lit("0")), F.lit("."), suffix)


def code_content(name: Column, ident: Column, version: Column, language: Column, description: Column, code: Column) -> Column:
    """The text of an exported code evaluator: comment lines that say what it was, a blank line, and the code."""
    mark = F.when(F.upper(language) == "PYTHON", "#").otherwise("//")
    say = lambda label, value: F.concat(mark, F.lit(f" {label}: "), F.regexp_replace(F.coalesce(value.cast("string"), F.lit("-")), r"\s*[\r\n]+\s*", " "))
    lines = [say("evaluator", name), say("id", ident), say("version", version), say("language", F.lower(language)), say("description", description), F.concat(mark, F.lit(" not created: port it by hand"))]
    return F.concat(F.concat_ws("\n", *lines), F.lit("\n\n"), F.coalesce(code, F.lit("")))

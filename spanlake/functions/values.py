"""Texts, numbers, times, messages, usage and status as Column expressions over JSON text and maps."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

#: The span kind of each observation type.
KIND_OF_TYPE = {
    "GENERATION": "LLM", "SPAN": "CHAIN", "EVENT": "CHAIN", "AGENT": "AGENT", "TOOL": "TOOL", "CHAIN": "CHAIN",
    "RETRIEVER": "RETRIEVER", "EMBEDDING": "EMBEDDING", "GUARDRAIL": "GUARDRAIL", "EVALUATOR": "EVALUATOR", "RERANKER": "RERANKER",
}
#: The keys under which token counts and costs are found, the newer shape first.
USAGE_KEYS = {
    "prompt": (("input", "prompt", "promptTokens"), ("input", "promptTokens", "prompt_tokens")),
    "completion": (("output", "completion", "completionTokens"), ("output", "completionTokens", "completion_tokens")),
    "total": (("total", "totalTokens"), ("total", "totalTokens", "total_tokens")),
}
USAGE_MAIN = ("input", "output", "total", "prompt", "completion")
COST_KEYS = {"prompt": ("input", "prompt"), "completion": ("output", "completion"), "total": ("total",)}
_MESSAGE = "array<struct<role: string, content: string, name: string, tool_calls: array<struct<id: string, function: struct<name: string, arguments: string>>>>>"


def or_else(*columns: Column) -> Column:
    """The first that is neither null nor the empty text."""
    return F.coalesce(*[F.when(c.cast("string") != "", c) for c in columns])


def span_kind(kind: Column, extra: dict[str, str] | None = None) -> Column:
    """The span kind of an observation type in any case; a missing type is SPAN, an unknown one UNKNOWN. extra: further or other kinds."""
    table = KIND_OF_TYPE | (extra or {})
    known = F.create_map(*[F.lit(x) for pair in table.items() for x in pair])
    return F.coalesce(F.element_at(known, F.upper(or_else(kind, F.lit("SPAN")))), F.lit("UNKNOWN"))


def is_json(text: Column) -> Column:
    """True for the text of a JSON object or array. A text with more after its end isn't one."""
    body = F.regexp_replace(text, r"(?U)\A\s+|\s+\z", "")
    starts = body.rlike(r"\A[{\[]")
    ends = F.when(F.substring(body, 1, 1) == "{", body.endswith("}")).otherwise(body.endswith("]"))
    return F.coalesce(starts & ends & F.try_parse_json(body).isNotNull(), F.lit(False))


def mime_type(text: Column) -> Column:
    """application/json for JSON objects and arrays, text/plain for other texts, null for null."""
    return F.when(text.isNull(), None).when(is_json(text), "application/json").otherwise("text/plain")


def messages(text: Column) -> Column:
    """Chat messages in a JSON text: a list, or one under `messages`, `input` or `prompt`, or a single message.

    Elements without a role are left out; no message at all is null. A message is (role, content, name, tool_calls).
    Content that is no text is JSON text.
    """
    body = F.when(is_json(text), F.regexp_replace(text, r"(?U)\A\s+|\s+\z", ""))
    nested = [F.get_json_object(body, f"$.{k}") for k in ("messages", "input", "prompt")]
    lists = [F.when(n.startswith("["), n) for n in nested]
    single = F.get_json_object(body, "$.role").isNotNull() & (F.get_json_object(body, "$.content").isNotNull() | F.get_json_object(body, "$.tool_calls").isNotNull())
    source = F.when(body.startswith("["), body).otherwise(F.coalesce(*lists, F.when(single, F.concat(F.lit("["), body, F.lit("]")))))
    found = F.filter(F.from_json(source, _MESSAGE), lambda m: m["role"].isNotNull())
    return F.when(F.size(found) > 0, found)


def message_columns(prefix: str, items: Column) -> Column:
    """Messages under flat indexed names: a map from `prefix.i.message.role` and the like to text."""
    entry = lambda name, value: F.struct(name.alias("key"), value.alias("value"))

    def one(m: Column, i: Column) -> Column:
        base = F.concat(F.lit(f"{prefix}."), i.cast("string"), F.lit(".message"))

        def call(c: Column, j: Column) -> Column:
            at = F.concat(base, F.lit(".tool_calls."), j.cast("string"), F.lit(".tool_call"))
            return F.array(entry(F.concat(at, F.lit(".id")), c["id"]), entry(F.concat(at, F.lit(".function.name")), c["function"]["name"]), entry(F.concat(at, F.lit(".function.arguments")), c["function"]["arguments"]))

        calls = F.flatten(F.transform(F.coalesce(m["tool_calls"], F.expr("array()").cast("array<struct<id: string, function: struct<name: string, arguments: string>>>")), call))
        return F.concat(F.array(*[entry(F.concat(base, F.lit(f".{k}")), m[k]) for k in ("role", "content", "name")]), calls)

    return F.map_from_entries(F.filter(F.flatten(F.transform(items, one)), lambda e: e["value"].isNotNull()))


def fold_indexed(attributes: Column, prefix: str) -> Column:
    """The way back: flat indexed names of one prefix as a list of maps, with an empty map where an index is missing."""
    pattern = rf"\A{prefix.replace('.', chr(92) + '.')}\.(\d+)\.(.+)\z"
    entries = F.filter(F.map_entries(attributes), lambda e: e["key"].rlike(pattern))
    index = lambda e: F.regexp_extract(e["key"], pattern, 1).cast("int")
    last = F.array_max(F.transform(entries, index))
    at = lambda i: F.map_from_entries(F.transform(F.filter(entries, lambda e: index(e) == i), lambda e: F.struct(F.regexp_extract(e["key"], pattern, 2), e["value"])))
    return F.when(last.isNotNull(), F.transform(F.sequence(F.lit(0), last), at))


def first_number(numbers: Column, keys: tuple[str, ...]) -> Column:
    return F.coalesce(*[F.try_element_at(numbers, F.lit(k)) for k in keys])


def usage(details: Column, legacy: Column) -> dict[str, Column]:
    """Token counts: prompt, completion, total (long) and the other details (map). Zero gives way to the older field.

    A missing total is the sum of the parts that are there.
    """
    pick = lambda names: F.coalesce(F.nullif(first_number(details, names[0]), F.lit(0.0)), first_number(legacy, names[1]))
    parts = {k: pick(v) for k, v in USAGE_KEYS.items()}
    known = parts["prompt"].isNotNull() | parts["completion"].isNotNull()
    total = F.coalesce(parts["total"], F.when(known, F.coalesce(parts["prompt"], F.lit(0.0)) + F.coalesce(parts["completion"], F.lit(0.0))))
    rest = F.transform_values(F.map_filter(details, lambda k, v: ~k.isin(*USAGE_MAIN)), lambda k, v: v.cast("long"))
    return {"prompt": parts["prompt"].cast("long"), "completion": parts["completion"].cast("long"), "total": total.cast("long"), "other": rest}


def cost(details: Column, legacy: dict[str, tuple[Column, ...]]) -> dict[str, Column]:
    """Costs as doubles: details first, then the given columns of each part; zero gives way; a missing total is the sum."""
    parts = {k: F.coalesce(F.nullif(first_number(details, keys), F.lit(0.0)), *[F.nullif(c, F.lit(0.0)) for c in legacy[k][:-1]], legacy[k][-1]) for k, keys in COST_KEYS.items()}
    known = parts["prompt"].isNotNull() | parts["completion"].isNotNull()
    parts["total"] = F.coalesce(parts["total"], F.when(known, F.coalesce(parts["prompt"], F.lit(0.0)) + F.coalesce(parts["completion"], F.lit(0.0))))
    return parts


def status_code(level: Column) -> Column:
    """ERROR for that level in any case, OK for another, UNSET without one."""
    return F.when(F.upper(level) == "ERROR", "ERROR").when(or_else(level).isNotNull(), "OK").otherwise("UNSET")


def end_time(end: Column, completion_start: Column, start: Column) -> Column:
    return F.coalesce(end, completion_start, start)


def span_name(name: Column, kind: Column) -> Column:
    return F.coalesce(or_else(name), F.lower(or_else(kind, F.lit("SPAN"))))


def session_value(*candidates: Column) -> Column:
    """The first that isn't null: the record's before the trace's. The empty text counts."""
    return F.coalesce(*candidates)


def tags(of_trace: Column, of_record: Column) -> Column:
    """The trace's tags if it has any, else the record's; none is null."""
    return F.coalesce(F.when(F.size(of_trace) > 0, of_trace), F.when(F.size(of_record) > 0, of_record))


def metadata_object(text: Column) -> Column:
    """Metadata as the text of a JSON object: others are wrapped as original_metadata, null is {}."""
    body = F.regexp_replace(text, r"(?U)\A\s+|\s+\z", "")
    whole = is_json(text) & body.startswith("{")
    parsed = is_json(text) | F.coalesce(F.try_parse_json(body).isNotNull() & body.rlike(r'\A(?:-?\d+(?:\.\d+)?(?:[eE][+-]?\d+)?|true|false|"(?:[^"\\]|\\.)*")\z'), F.lit(False))
    wrapped = F.when(parsed, F.concat(F.lit('{"original_metadata":'), body, F.lit("}"))).otherwise(F.to_json(F.struct(text.alias("original_metadata"))))
    return F.when(text.isNull() | (body == "null"), "{}").when(whole, body).otherwise(wrapped)


def provenance(record: dict[str, Column], kind: str, source: str = "import", extra: dict[str, Column] | None = None) -> Column:
    """Where a span comes from: source, kind of record, and the record's own id, trace, parent and type, with extras."""
    fields = {"source": F.lit(source), "record_kind": F.lit(kind), "original_id": record["id"], "original_trace_id": F.coalesce(record["trace_id"], record["id"]), "original_parent_id": record["parent_id"], "original_type": record["type"]} | (extra or {})
    return F.struct(*[v.cast("string").alias(k) for k, v in fields.items()])


def uses_key(json_object: Column, key: str) -> Column:
    """Whether a JSON object has a key."""
    return F.coalesce(F.array_contains(F.json_object_keys(json_object), key), F.lit(False))


def parse_time(text: Column) -> Column:
    """A timestamp from ISO-8601 text; without a zone it is UTC (the session's), unreadable is null."""
    return F.try_to_timestamp(text)


def nanos_of_time(moment: Column) -> Column:
    return F.unix_micros(moment.cast("timestamp")) * F.lit(1000)


def nanos_of_number(number: Column) -> Column:
    """Nanoseconds from an epoch number whose size tells seconds, milli-, micro- and nanoseconds apart."""
    scales = ((1e11, 1_000_000_000), (1e14, 1_000_000), (1e17, 1_000))
    return reduce(lambda rest, s: F.when(number < s[0], (number * F.lit(s[1])).cast("long")).otherwise(rest), reversed(scales), number.cast("long"))


def iso(moment: Column) -> Column:
    """ISO-8601 with a Z; microseconds only where there are some."""
    whole = F.date_format(moment, "yyyy-MM-dd'T'HH:mm:ss")
    return F.concat(whole, F.when(F.date_format(moment, "SSSSSS") != "000000", F.concat(F.lit("."), F.date_format(moment, "SSSSSS"))).otherwise(F.lit("")), F.lit("Z"))


def nesting(json: Column) -> Column:
    """How deep the objects of a JSON text lie in each other, lists apart: 1 for a flat one. One pass over the text."""
    braces = F.regexp_replace(F.regexp_replace(json, r'"[^"\\]*+(?:\\.[^"\\]*+)*+"', ""), r"[^{}]++", "")
    step = lambda s, c: F.struct((s["at"] + F.when(c == "{", 1).otherwise(-1)).alias("at"), F.greatest(s["most"], s["at"] + F.when(c == "{", 1).otherwise(0)).alias("most"))
    return F.aggregate(F.filter(F.split(braces, ""), lambda c: c != ""), F.struct(F.lit(0).alias("at"), F.lit(0).alias("most")), step)["most"]


def _held(value: Column, use: Callable[[Column], Column]) -> Column:
    """use(value), with the value computed once however often it is used: an expression within a lambda is computed for each element."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def flatten_json(json_object: Column, depth: int | None = None) -> Column:
    """A JSON object's leaves under dotted names (map of text, by name), however deep; with a depth, what lies deeper stays JSON text.

    Lists stay JSON text; null and empty lists are left out. Of leaves that would have one name the first stays. A turn opens
    one level, so the work is the text's length by its depth, however wide it is. `spans.leaves` keeps lists as lists.
    """
    of = "map<string, string>"

    def spread(e: Column) -> Column:
        inner = F.transform(F.map_entries(F.from_json(e["value"], of)), lambda i: F.struct(F.concat(e["key"], F.lit("."), i["key"]).alias("key"), i["value"].alias("value")))
        # what `is_json` says of a text that starts with a brace, without its passes over the text
        closed = e["value"].endswith("}") | e["value"].rlike(r"(?U)\}\s+\z")
        return F.when(e["value"].startswith("{") & closed & F.try_parse_json(e["value"]).isNotNull(), inner).otherwise(F.array(F.struct(e["key"].alias("key"), e["value"].alias("value"))))

    def opened(levels: Column) -> Column:
        turns = levels - 1 if depth is None else F.least(levels - 1, F.lit(depth - 1))
        steps = F.when(turns > 0, F.sequence(F.lit(1), turns)).otherwise(F.array().cast("array<int>"))
        return F.aggregate(steps, F.map_entries(F.from_json(json_object, of)), lambda found, _: F.flatten(F.transform(found, spread)))

    leaves = _held(nesting(json_object), opened)
    kept = F.filter(leaves, lambda e: e["value"].isNotNull() & (e["value"] != "[]"))
    ordered = F.sort_array(F.transform(kept, lambda e, i: F.struct(e["key"].alias("key"), i.alias("at"), e["value"].alias("value"))))
    first = _held(ordered, lambda all_: F.filter(all_, lambda e, i: (i == 0) | (e["key"] != F.get(all_, i - 1)["key"])))
    return F.map_from_entries(F.transform(first, lambda e: F.struct(e["key"].alias("key"), e["value"].alias("value"))))

"""Observations to span trees."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window
from pyspark.sql import functions as F

from spanlake.functions import ids, values

#: Key of the provenance in metadata; metadata that uses it itself is refused.
PROVENANCE = "provenance"


def _column(df: DataFrame, name: str, kind: str = "string"):
    return F.col(name) if name in df.columns else F.lit(None).cast(kind)


def split(observations: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(usable, rejected with a reason): a row needs a trace id, a start, and metadata that leaves the provenance key free."""
    raw = _column(observations, "metadata")
    meta, may = values.metadata_object(raw), raw.contains(PROVENANCE) | raw.contains("\\")  # else there is no such key, and nothing to parse
    reason = (
        F.when(values.or_else(F.col("trace_id")).isNull(), "no trace id")
        .when(F.col("start_time").isNull(), "no start time")
        .when(may & values.uses_key(meta, PROVENANCE), "metadata uses a reserved key")
    )
    marked = observations.withColumn("reason", reason)
    return marked.where("reason IS NULL").drop("reason"), marked.where("reason IS NOT NULL")


def project(observations: DataFrame, names: ids.Namespaces = ids.DEFAULT, extra_kinds: dict[str, str] | None = None) -> DataFrame:
    """One span for each usable observation, with its own (hashed) parent if it has one; roots are for `assemble`.

    Columns: span_id, trace_id, parent_id, name, span_kind, start_time, end_time, status_code, status_message,
    input, input_mime, output, output_mime, token counts and costs (LLM spans only), session_id, user_id, tags,
    metadata (JSON object text), source_id, source_trace, source_parent.
    """
    get = lambda name, kind="string": _column(observations, name, kind)
    numbers = "map<string,double>"
    kind = values.span_kind(get("type"), extra_kinds)
    llm = lambda c: F.when(kind == "LLM", c)
    tokens = values.usage(get("usage_details", numbers), get("usage", numbers))
    costs = values.cost(get("cost_details", numbers), {k: (get(f"calculated_{v}_cost", "double"), get(f"{v}_cost", "double")) for k, v in (("prompt", "input"), ("completion", "output"), ("total", "total"))})
    parent = values.or_else(get("parent_id"))
    return observations.select(
        ids.span_id(F.col("id"), names).alias("span_id"), ids.trace_id(F.col("trace_id"), names).alias("trace_id"), ids.span_id(parent, names).alias("parent_id"),
        values.span_name(get("name"), get("type")).alias("name"), kind.alias("span_kind"), F.col("start_time"),
        values.end_time(get("end_time", "timestamp"), get("completion_start", "timestamp"), F.col("start_time")).alias("end_time"),
        values.status_code(get("level")).alias("status_code"), F.coalesce(get("status_message"), F.lit("")).alias("status_message"),
        get("input").alias("input"), values.mime_type(get("input")).alias("input_mime"), get("output").alias("output"), values.mime_type(get("output")).alias("output_mime"),
        llm(values.or_else(get("model"))).alias("model"), llm(get("model_parameters")).alias("invocation_parameters"), llm(values.or_else(get("prompt_name"))).alias("prompt_name"), llm(get("prompt_version")).alias("prompt_version"),
        *[llm(tokens[k]).alias(f"tokens_{k}") for k in ("prompt", "completion", "total")], llm(tokens["other"]).alias("tokens_other"), *[llm(costs[k]).alias(f"cost_{k}") for k in ("prompt", "completion", "total")],
        llm(values.messages(get("input"))).alias("input_messages"), llm(values.messages(get("output"))).alias("output_messages"),
        get("session_id").alias("session_id"), get("user_id").alias("user_id"), get("tags", "array<string>").alias("tags"), values.metadata_object(get("metadata")).alias("metadata"),
        F.col("id").cast("string").alias("source_id"), F.col("trace_id").cast("string").alias("source_trace"), parent.alias("source_parent"),
    )


def with_trace_fields(observations: DataFrame, traces: DataFrame) -> DataFrame:
    """Observations with session, user and tags of their trace where they lack them; a trace's tags go before."""
    t = traces.select(F.col("id").alias("trace_id"), F.col("session_id").alias("_s"), F.col("user_id").alias("_u"), F.col("tags").alias("_t"))
    joined = observations.join(t, "trace_id", "left")
    tags = values.tags(F.col("_t"), _column(observations, "tags", "array<string>"))
    return joined.withColumns({"session_id": F.coalesce(_column(observations, "session_id"), "_s"), "user_id": F.coalesce(_column(observations, "user_id"), "_u"), "tags": tags}).drop("_s", "_u", "_t")


def by_day(observations: DataFrame) -> DataFrame:
    return observations.withColumn("day", F.to_date("start_time"))


def roots(observations: DataFrame, names: ids.Namespaces = ids.DEFAULT, traces: DataFrame | None = None, per: tuple[str, ...] = ("trace_id",)) -> DataFrame:
    """A row a trace: how many rows and parentless rows, whether its root is made up, the root's id, its name and interval.

    A trace with exactly one parentless row has that as its root, unless there is a trace record; all others get a
    made-up one. Groups are aggregated, not windowed: a trace of any size is one small row. The name is the only
    root's, else that of the earliest row with one, else `trace`. per: the columns of a trace, ("day", "trace_id")
    for one root a day and trace.
    """
    parentless = values.or_else(F.col("parent_id")).isNull()
    end = values.end_time(_column(observations, "end_time", "timestamp"), _column(observations, "completion_start", "timestamp"), F.col("start_time"))
    order = F.struct("start_time", F.col("id").cast("string"))
    named = values.or_else(F.col("name")).isNotNull()
    grouped = observations.groupBy(*per).agg(
        F.count(F.lit(1)).alias("rows"), F.count_if(parentless).alias("parentless"), F.min("start_time").alias("start_time"), F.max(end).alias("end_time"),
        F.min_by(F.when(parentless, F.col("id").cast("string")), F.when(parentless, order)).alias("only_root"), F.min_by(F.when(parentless, F.col("name")), F.when(parentless, order)).alias("_root_name"),
        F.min_by(F.when(named, F.col("name")), F.when(named, order)).alias("_first_name"), F.min_by("session_id", order).alias("session_id"),
    )
    if traces is not None:
        t = traces.select(F.col("id").alias("trace_id"), F.lit(True).alias("_record"), F.col("name").alias("_trace_name"), F.col("timestamp").alias("_at"))
        grouped = grouped.join(t, "trace_id", "left")
        made_up = F.coalesce("_record", F.lit(False)) | (F.col("parentless") != 1)
        name = F.coalesce(values.or_else(F.col("_trace_name")), F.when(F.col("_record"), F.lit("trace")))
        grouped = grouped.withColumns({"start_time": F.least("start_time", "_at"), "end_time": F.greatest("end_time", "_at")})
    else:
        made_up, name = F.col("parentless") != 1, F.lit(None).cast("string")
    single = F.when(F.col("parentless") == 1, values.or_else(F.col("_root_name")))
    root = F.when(made_up, ids.root_span_id(F.col("trace_id"), names)).otherwise(ids.span_id(F.col("only_root"), names))
    return grouped.select(*per, "rows", "parentless", made_up.alias("made_up"), root.alias("root_id"), F.coalesce(name, single, values.or_else(F.col("_first_name")), F.lit("trace")).alias("name"), "start_time", "end_time", "session_id")


def made_up_roots(trace_roots: DataFrame, names: ids.Namespaces = ids.DEFAULT) -> DataFrame:
    """Spans for the roots that are made up: they cover all rows of their trace."""
    meta = F.to_json(F.struct(F.lit(True).alias("synthesized_root"), F.col("rows").alias("observation_count")))
    return trace_roots.where("made_up").select(
        F.col("root_id").alias("span_id"), ids.trace_id(F.col("trace_id"), names).alias("trace_id"), F.lit(None).cast("string").alias("parent_id"), "name", F.lit("CHAIN").alias("span_kind"),
        "start_time", "end_time", F.lit("UNSET").alias("status_code"), F.lit("").alias("status_message"), "session_id", meta.alias("metadata"), F.col("trace_id").alias("source_trace"),
    )


def assemble(observations: DataFrame, names: ids.Namespaces = ids.DEFAULT, traces: DataFrame | None = None, reattach_orphans: bool = False, extra_kinds: dict[str, str] | None = None, tops: DataFrame | None = None) -> DataFrame:
    """All spans of all traces: observations, and made-up roots that parentless rows hang on.

    Rows without a trace id are no part of a tree and are left out: `split` rejects them with a reason. A parent that
    doesn't exist stays as it is, unless reattach_orphans hangs such rows on the trace's root. tops: the observations' `roots`,
    if they are known.
    """
    tops = roots(observations, names, traces) if tops is None else tops
    spans = project(observations, names, extra_kinds).alias("s")
    r = tops.select(F.col("trace_id").alias("_trace"), F.col("made_up").alias("_made_up"), F.col("root_id").alias("_root")).alias("r")
    joined = spans.join(r, F.col("s.source_trace") == F.col("r._trace"))
    parent = F.when(F.col("source_parent").isNull(), F.when(F.col("_made_up"), F.col("_root"))).otherwise(F.col("parent_id"))
    out = joined.withColumn("parent_id", parent)
    if reattach_orphans:
        have = observations.select(F.col("trace_id").alias("_t"), F.col("id").cast("string").alias("_id"), F.lit(True).alias("_there")).distinct()
        out = out.join(have, (F.col("source_trace") == F.col("_t")) & (F.col("source_parent") == F.col("_id")), "left")
        lost = F.col("source_parent").isNotNull() & F.col("_there").isNull() & (F.col("span_id") != F.col("_root"))
        out = out.withColumn("parent_id", F.when(lost, F.col("_root")).otherwise(F.col("parent_id"))).drop("_t", "_id", "_there")
    return out.drop("_trace", "_made_up", "_root").unionByName(made_up_roots(tops, names), allowMissingColumns=True)


def session_anchors(observations: DataFrame, trace_roots: DataFrame, per: tuple[str, ...] = ()) -> DataFrame:
    """session_id, anchor: the root of each session's trace that starts first (ties: the least trace id). per: e.g. ("day",)."""
    starts = observations.groupBy(*per, "trace_id").agg(F.min("start_time").alias("first_start"))
    of_session = observations.where(values.or_else(F.col("session_id")).isNotNull()).select(*per, "trace_id", "session_id").distinct()
    joined = of_session.join(starts, [*per, "trace_id"]).join(trace_roots.select(*per, "trace_id", "root_id"), [*per, "trace_id"])
    return joined.groupBy(*per, "session_id").agg(F.min_by("root_id", F.struct("first_start", "trace_id")).alias("anchor"))


def leaves(df: DataFrame, json: str, *keys: str) -> DataFrame:
    """keys, name, text, list: the leaves of a column's JSON objects under dotted names, a row each.

    A scalar is text; a list of scalars is a list of texts; another list is JSON text; nulls and empty lists are left out, as are
    texts that are no JSON object. Objects are VARIANT, opened level by level by lateral joins, so the work is that of the leaves
    by their depth. How deep the column goes is looked at once, when this is called.
    """
    deepest = df.agg(F.max(values.nesting(F.col(json)))).first()[0] or 0
    is_object = lambda v: F.schema_of_variant(v).startswith("OBJECT")
    level = df.select(*keys, F.lit(None).cast("string").alias("_name"), F.try_parse_json(F.col(json)).alias("_value")).where(F.col("_value").isNotNull() & is_object(F.col("_value")))
    found = []
    for _ in range(deepest):
        inner = level.alias("l").lateralJoin(level.sparkSession.tvf.variant_explode(F.col("l._value").outer()).alias("i"))
        opened = inner.select(*[f"l.{k}" for k in keys], F.concat_ws(".", "l._name", "i.key").alias("_name"), F.col("i.value").alias("_value")).where(F.col("_value").isNotNull() & ~F.is_variant_null("_value"))
        found.append(opened.where(~is_object(F.col("_value"))))
        level = opened.where(is_object(F.col("_value")))
    out = found[0] if found else level
    for more in found[1:]:
        out = out.unionByName(more)
    parts = F.try_variant_get("_value", "$", "array<variant>")
    scalar = F.forall(parts, lambda v: ~F.schema_of_variant(v).rlike("^(OBJECT|ARRAY|VOID)"))
    texts = F.transform(parts, lambda v: F.try_variant_get(v, "$", "string"))
    whole = F.when(parts.isNull(), F.try_variant_get("_value", "$", "string")).when(~scalar, F.to_json("_value"))
    return out.where(parts.isNull() | (F.size(parts) > 0)).select(*keys, F.col("_name").alias("name"), whole.alias("text"), F.when(parts.isNotNull() & scalar, texts).alias("list"))


def wide(spans: DataFrame, *more: str) -> tuple[DataFrame, DataFrame]:
    """(rows, rejected): spans under dotted names with nanosecond times; a span without ids or that ends before it starts is rejected. more: further columns, as they are."""
    nanos = lambda c: values.nanos_of_time(F.col(c))
    start, end = nanos("start_time"), F.coalesce(nanos("end_time"), nanos("start_time"))
    reason = F.when(F.col("trace_id").isNull() | F.col("span_id").isNull(), "no ids").when(start.isNull(), "no start time").when(end < start, "ends before it starts")
    marked = spans.withColumn("reason", reason)
    dotted = {
        "input": "attributes.input.value", "input_mime": "attributes.input.mime_type", "output": "attributes.output.value", "output_mime": "attributes.output.mime_type", "model": "attributes.llm.model_name",
        "tokens_prompt": "attributes.llm.token_count.prompt", "tokens_completion": "attributes.llm.token_count.completion", "tokens_total": "attributes.llm.token_count.total",
        "cost_prompt": "attributes.llm.cost.prompt", "cost_completion": "attributes.llm.cost.completion", "cost_total": "attributes.llm.cost.total",
        "input_messages": "attributes.llm.input_messages", "output_messages": "attributes.llm.output_messages", "session_id": "attributes.session.id", "user_id": "attributes.user.id", "tags": "attributes.tag.tags", "metadata": "attributes.metadata",
    }
    rows = marked.where("reason IS NULL").select(
        F.col("trace_id").alias("context.trace_id"), F.col("span_id").alias("context.span_id"), values.or_else(F.col("parent_id")).alias("parent_id"), "name", start.alias("start_time"), end.alias("end_time"),
        F.coalesce(values.or_else(F.col("status_code")), F.lit("UNSET")).alias("status_code"), F.coalesce("status_message", F.lit("")).alias("status_message"), F.coalesce(values.or_else(F.col("span_kind")), F.lit("UNKNOWN")).alias("span_kind"),
        *[F.col(c).alias(d) for c, d in dotted.items() if c in spans.columns], *more,
    )
    return rows, marked.where("reason IS NOT NULL")


def kind_counts(spans: DataFrame, *by: str) -> DataFrame:
    """Spans and roots by kind."""
    return spans.groupBy(*by, "span_kind").agg(F.count(F.lit(1)).alias("spans"), F.count_if(values.or_else(F.col("parent_id")).isNull()).alias("roots"))


def ordered(observations: DataFrame) -> DataFrame:
    """Rows with their place in their trace by start, then id."""
    return observations.withColumn("place", F.row_number().over(Window.partitionBy("trace_id").orderBy("start_time", "id")))

import hashlib
import time

import pytest
from pyspark.sql import functions as F

from spanlake.functions import ids, names, prompts, values
from spanlake.operators import spans


def one(spark, column, value=None, kind="string"):
    return spark.createDataFrame([(value,)], f"v {kind}").select(column(F.col("v")).alias("r")).first().r


@pytest.mark.parametrize(
    "value,expected",
    [
        ("0123456789abcdef", "0123456789abcdef"), ("0123-4567-89AB-CDEF", "0123456789abcdef"), (" 0123456789abcdef\n", "0123456789abcdef"), (None, None), ("  ", None),
        ("0" * 16, hashlib.sha256((ids.DEFAULT.span + "0" * 16).encode()).hexdigest()[:16]), ("É1", hashlib.sha256((ids.DEFAULT.span + "É1").encode()).hexdigest()[:16]),
    ],
)
def test_span_id(spark, value, expected):
    assert one(spark, ids.span_id, value) == expected


def test_trace_and_root_ids(spark):
    uuid = "123E4567-e89b-12d3-a456-426614174000"
    assert one(spark, ids.trace_id, uuid) == uuid.replace("-", "").lower()
    assert one(spark, ids.root_span_id, uuid) == hashlib.sha256((ids.DEFAULT.root + uuid).encode()).hexdigest()[:16]


@pytest.mark.parametrize("text,mime", [('{"a":1}', "application/json"), (" [1, 2] ", "application/json"), ("{broken", "text/plain"), ('{"a":1} x', "text/plain"), ("hi", "text/plain"), ("", "text/plain"), (None, None), ("12", "text/plain")])
def test_mime(spark, text, mime):
    assert one(spark, values.mime_type, text) == mime


@pytest.mark.parametrize("kind,expected", [("generation", "LLM"), ("EVENT", "CHAIN"), (None, "CHAIN"), ("odd", "UNKNOWN"), ("", "CHAIN")])
def test_kinds(spark, kind, expected):
    assert one(spark, values.span_kind, kind) == expected


def test_messages(spark):
    chat = '{"messages":[{"role":"user","content":"a"},{"content":"no role"},{"role":"assistant","content":null,"tool_calls":[{"id":"t","function":{"name":"f","arguments":"{}"}}]}]}'
    found = one(spark, values.messages, chat)
    assert [(m.role, m.content) for m in found] == [("user", "a"), ("assistant", None)]
    flat = one(spark, lambda c: values.message_columns("in", values.messages(c)), chat)
    assert flat["in.0.message.role"] == "user" and flat["in.1.message.tool_calls.0.tool_call.function.name"] == "f"
    assert one(spark, values.messages, '{"role":"user","content":"x"}')[0].content == "x"
    assert one(spark, values.messages, "plain") is None and one(spark, values.messages, "[]") is None


def test_fold(spark):
    df = spark.createDataFrame([({"m.0.role": "a", "m.2.role": "b", "x": "y"},)], "v map<string,string>")
    assert df.select(values.fold_indexed(F.col("v"), "m").alias("r")).first().r == [{"role": "a"}, {}, {"role": "b"}]


def test_usage_zero_gives_way(spark):
    df = spark.createDataFrame([({"input": 0.0, "cached": 3.0}, {"input": 7.0, "output": 2.0})], "d map<string,double>, u map<string,double>")
    u = values.usage(F.col("d"), F.col("u"))
    assert tuple(df.select(u["prompt"], u["completion"], u["total"], u["other"]).first()) == (7, 2, 9, {"cached": 3})


@pytest.mark.parametrize("text,expected", [('{"a":1}', '{"a":1}'), ("3", '{"original_metadata":3}'), ("word", '{"original_metadata":"word"}'), (None, "{}"), ("[1]", '{"original_metadata":[1]}')])
def test_metadata(spark, text, expected):
    assert one(spark, values.metadata_object, text) == expected


def test_times(spark):
    assert one(spark, lambda c: values.nanos_of_number(c), 1700000000.0, "double") == 1700000000 * 10**9
    assert one(spark, lambda c: values.nanos_of_number(c), 1700000000000.0, "double") == 1700000000 * 10**9
    assert one(spark, lambda c: values.iso(values.parse_time(c)), "2024-01-02T03:04:05.000007Z") == "2024-01-02T03:04:05.000007Z"
    assert one(spark, lambda c: values.iso(values.parse_time(c)), "2024-01-02T03:04:05Z") == "2024-01-02T03:04:05Z"
    assert one(spark, values.parse_time, "no time") is None


def test_flatten(spark):
    assert one(spark, values.flatten_json, '{"a":{"b":{"c":1}},"d":[1,{"e":2}],"n":null,"z":[]}') == {"a.b.c": "1", "d": '[1,{"e":2}]'}


def test_flattening_is_computed_once(spark):
    """the depth of a text is found once for a row, also where a query asks for names and a leaf; texts that look like objects are opened as before."""
    from spanlake import catalog

    plan = catalog.QUERIES["deep_attributes"](spark, "/root/testdata/sf0.001")._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("[^{}]++") == 1
    texts = r'{"a":"{\"b\":1} ","c":"{x}","d":"{\"b\":1} y","e":{"f":1},"g":"{\"b\":1,\"b\":2}"}'
    assert one(spark, values.flatten_json, texts) == {"a.b": "1", "c": "{x}", "d": '{"b":1} y', "e.f": "1", "g": '{"b":1,"b":2}'}


def test_wide_objects_are_flattened_in_a_second(spark):
    """10,000 objects side by side in one cell; braces within texts don't count."""
    wide = "{" + ",".join(f'"k{i}":{{"a":{i},"b":"}}{{\\"{i}"}}' for i in range(10_000)) + "}"
    df = spark.createDataFrame([(wide,)], "j string").cache()
    assert one(spark, values.nesting, '{"a":"}{{","b":{"c":[{"d":{}}]},"e":{}}') == 4 and df.select(values.nesting(F.col("j"))).first()[0] == 2
    flat = df.select(F.map_entries(values.flatten_json(F.col("j"))).alias("e"))
    flat.first()
    began = time.perf_counter()
    got = flat.first().e
    assert time.perf_counter() - began < 3 and len(got) == 20_000 and {e.key: e.value for e in got}["k7.b"] == '}{"7'


def test_leaves(spark):
    rows = [(1, '{"l":[1,"a",true],"m":[],"o":{"p":[[1]],"q":{"r":2,"t":[null,1]}},"s":"y","u":null,"v":[{"a":1}]}'), (2, "[1]"), (3, None), (4, "x"), (5, "{}"), (6, '{"a":{"b":{}}}')]
    got = {(r.k, r.name): (r.text, r.list) for r in spans.leaves(spark.createDataFrame(rows, "k int, j string"), "j", "k").collect()}
    assert got == {(1, "l"): (None, ["1", "a", "true"]), (1, "o.p"): ("[[1]]", None), (1, "o.q.r"): ("2", None), (1, "o.q.t"): ("[null,1]", None), (1, "s"): ("y", None), (1, "v"): ('[{"a":1}]', None)}
    assert spans.leaves(spark.createDataFrame([], "k int, j string"), "j", "k").count() == 0


def test_names(spark):
    assert one(spark, names.column_name, " a--b.c__d ") == "a_b_c_d"
    assert one(spark, names.column_name, "  ") is None
    assert one(spark, names.project_name, " -Tenor / Lev  Prod!- ") == "Tenor-Lev-Prod"
    assert one(spark, names.number_label, 0.5, "double") == "0.5" and one(spark, names.number_label, 10.0, "double") == "10" and one(spark, names.number_label, 0.0, "double") == "0"
    assert one(spark, names.error_reason, "Error during update request: Error during update request: gone. gRPC client debug context: x") == "gone"
    assert len(one(spark, names.error_reason, "y" * 500)) == 160
    assert one(spark, names.parse_pairs, "A=x, b = y,c,=d,a=z") == {"a": "z", "b": "y"}
    assert one(spark, names.redacted, "") == "<unset>" and one(spark, names.is_secret, "my_token") is True


def test_templates(spark):
    text = 'See {{ a }} and {"k": {{b.c}}} {{a}}'
    assert one(spark, prompts.template, text) == 'See {a} and {{"k": {b.c}}} {a}'
    assert one(spark, prompts.template_variables, text) == ["a", "b.c"]


def test_choices(spark):
    df = spark.createDataFrame([(["a", "b", "c"], {"a": 1.0, "b": 0.2})], "l array<string>, c map<string,double>")
    assert [x.score for x in df.select(prompts.categorical_choices(F.col("l"), F.col("c")).alias("r")).first().r] == [1.0, 0.5, 0.0]
    assert one(spark, lambda c: prompts.numeric_choices(c, F.lit(0.0)), 1.0, "double") is None


def test_prompts(spark):
    assert one(spark, lambda c: prompts.prompt_refusal(c, F.lit(True)), '[{"role":"alien","content":"x"}]') == "unknown role"
    assert one(spark, lambda c: prompts.prompt_messages(c, F.lit(True)), '[{"role":"Function","content":null}]')[0].role == "TOOL"
    assert one(spark, prompts.provider, None) == "CUSTOM"
    assert one(spark, lambda c: prompts.source_column(F.lit("metadata"), c), "$.x.y") == "attributes.metadata.x.y"

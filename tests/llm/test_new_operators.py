"""Conversation repair, fill-in-middle and mixing against plain versions."""

import hashlib
import itertools
import random
import re
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from spanlake.llm import conversations, fim, mixing

DOCS = "doc_id long, text string, lang string, source string, n_chars long"
TURNS = "conv_id long, turn long, role string, text string"

# 11


def plain_damage(rows):
    out = []
    for conv, turn, role, text in rows:
        role, text = " " if role is None else role, " " if text is None else text
        kind = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        if kind:
            row = (conv, turn, "user" if kind == 4 else role, "" if kind == 1 else re.sub("[.!?]", "", text) if kind == 2 else text)
            out += [row] * (2 if kind == 3 else 1)
    return out


def plain_repair(rows):
    """gaps, blank, duplicate, truncated, illegal, cost, audit, digest of one conversation's rows, by trying every row at every state."""
    rows = sorted(rows, key=lambda r: (r[1] is not None, r[1] or 0, r[2], hashlib.sha256(f"{len(r[2])}:{r[2]}{r[3]}".encode()).digest()))
    turns = [t for _, t, _, _ in rows if t is not None]
    seen, found = set(), []
    for _, _, role, text in rows:
        solid = re.sub(r"[\x20\x09-\x0D]", "", text)
        found.append("blank" if not solid else "duplicate" if (role, text) in seen else "" if solid[-1] in ".!?" else "truncated")
        seen.add((role, text))
    best = {"": (0, "", ())}  # by what has been said so far: nothing, s, u, a

    def add(ways, state, cost, audit, said):
        if state not in ways or (cost, audit) < ways[state][:2]:
            ways[state] = (cost, audit, said)

    def insert(ways):
        for _ in range(3):
            for state, (cost, audit, said) in list(ways.items()):
                to = "a" if state == "u" else "u"
                add(ways, to, cost + 3, audit + "I", (*said, ("user" if to == "u" else "assistant", "")))
        return ways

    insert(best)
    for (_, _, role, text), fault in zip(rows, found, strict=True):
        ways = {}
        for state, (cost, audit, said) in best.items():
            add(ways, state, cost + 4, audit + "D", said)
            if fault in ("blank", "duplicate"):
                continue
            more, to = 3 * (fault == "truncated"), "a" if state == "u" else "u"
            add(ways, to, cost + more + 3, audit + "R", (*said, ("user" if to == "u" else "assistant", text)))
            if role[:1] == to or role[:1] == "s" and state == "":
                add(ways, role[:1], cost + more, audit + "K", (*said, (role, text)))
        best = insert(ways)
    cost, audit, said = min(best[s] for s in ("", "a") if s in best)
    initials = [r[2][:1] for r in rows]
    return (
        max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0, *(found.count(x) for x in ("blank", "duplicate", "truncated")), sum(a + b not in ("su", "ua", "au") for a, b in itertools.pairwise(initials)),
        cost, audit, hashlib.sha256("\n".join(f"{a}:{b}" for a, b in said).encode()).hexdigest(),
    )


def query11(spark, tmp_path, rows, schema=TURNS):
    folder = str(tmp_path / f"c{random.random()}")
    spark.createDataFrame(rows, schema).write.parquet(f"{folder}/conversations.parquet")
    return {r.conv_id: tuple(r)[1:] for r in conversations.op11_viterbi_repair(spark, folder).collect()}


def plain11(rows):
    return {c: plain_repair([r for r in plain_damage(rows) if r[0] == c]) for c in {r[0] for r in rows}}


def any_rows(seed, convs=120):
    r = random.Random(seed)
    texts = [None, "", " \t", "Yes.", "No", "Why?\n", "Go!", "é…", "a" * 3000 + ".", "Yes."]
    roles = ["system", "user", "assistant", "user", "assistant", None, "tool", "", "User", "u"]
    return [(r.choice([None, *range(convs)]), r.choice([None, -3, *range(12)]), r.choice(roles), r.choice(texts)) for _ in range(convs * 7)]


@pytest.mark.parametrize("block", [1, 3, 1 << 12])
def test_conversations_match_a_plain_version(spark, tmp_path, monkeypatch, block):
    """Null ids, turns, roles and texts, ties, repeated rows; blocks of few rows have to be joined to the same edits."""
    monkeypatch.setattr(conversations, "BLOCK", block)
    rows = any_rows(block)
    assert query11(spark, tmp_path, rows) == plain11(rows)


def test_no_conversations_and_clashing_columns(spark, tmp_path):
    assert query11(spark, tmp_path, []) == {}
    gone = next(i for i in range(999) if zlib.crc32(f"{i}:0".encode()) % 20 == 0)
    assert query11(spark, tmp_path, [(gone, 0, "user", "Hi.")]) == {gone: (0, 0, 0, 0, 0, 0, "", hashlib.sha256().hexdigest())}
    rows = [(1, t, "user" if t % 2 else "assistant", f"{t}.") for t in range(6)]
    more = [(*r, "x", 1, "y") for r in rows]
    assert query11(spark, tmp_path, more, TURNS + ", content string, copies long, place string") == plain11(rows)


def test_hot_conversation_spans_blocks_and_tasks(spark):
    """A long conversation is searched by several tasks and keeps its order; its repaired rows obey the grammar."""
    r = random.Random(4)
    rows = [(7, t, r.choice(["user", "assistant", "system"]), f"text {t}" + r.choice([".", "", "!"]), 1) for t in range(9000)]
    report, repaired = conversations.repair(spark.createDataFrame(rows, TURNS + ", copies long").repartition(5))
    said = [x.role[0] for x in repaired.orderBy("place", "step").collect()]
    assert re.fullmatch("s?(ua)+", "".join(said))
    want = plain_repair([x[:4] for x in rows])
    got = report.first()
    assert (got.gaps, got.blank, got.duplicate, got.truncated, got.illegal, got.cost, got.audit) == want[:-1]
    assert conversations.digests(repaired).first().repaired_sha256 == want[-1]


def test_copies_are_one_row_with_a_count(spark):
    rows = [(1, 0, "user", "Hi.", 1000), (1, 1, "assistant", "So.", 1), (1, 1, "assistant", "So.", 2), (1, 2, "user", " ", 3)]
    report, repaired = conversations.repair(spark.createDataFrame(rows, TURNS + ", copies long"))
    got = report.first()
    assert (got.duplicate, got.blank, got.cost, got.audit) == (1001, 3, 4 * 1004, "K" + "D" * 999 + "K" + "D" * 5)
    assert [(x.role, x.text) for x in repaired.orderBy("place", "step").collect()] == [("user", "Hi."), ("assistant", "So.")]


# 12


def plain_fim(key, text):
    text = text or ""
    h = hashlib.sha256(f"42:{'' if key is None else key}".encode()).hexdigest()
    h1, h2, h3, h4 = (int(h[i : i + 8], 16) for i in (0, 8, 16, 24))
    units = re.findall(r"[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+", text)
    n = len(units)
    a, b = sorted((h1 % (n + 1), h2 % (n + 1)))
    if not text or any(m in text for m in ("<P>", "<S>", "<M>")) or h3 % 100 >= 50:
        return n, "plain", text, None, None
    prefix, middle, suffix = "".join(units[:a]), "".join(units[a:b]), "".join(units[b:])
    form = "spm" if h4 % 100 < 80 else "psm"
    out = f"<P>{prefix}<S>{suffix}<M>{middle}" if form == "psm" else f"<S>{suffix}<P>{prefix}<M>{middle}"
    return n, form, out, len(prefix), len(middle)


def test_fill_in_middle_matches_a_plain_version(spark, monkeypatch):
    """Null, empty, blank, marked and long texts, null and repeated ids, white space of all kinds, clashing columns."""
    monkeypatch.setattr(fim, "SLICE_CHARS", 500)
    r = random.Random(1)
    texts = [None, "", " ", "\n\t ", "a", " a ", "<P>", "a <S> b", "x<M", "<P", "<S><", " é x", "w " * 40_000, *("".join(r.choices(["ab", "é", " ", "\n", "\v", "<", "P>", ">", "𝔘"], k=r.randint(0, 60))) for _ in range(400))]
    rows = [(None if i == 5 else i // 2, t) for i, t in enumerate(texts)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumns({"form": F.lit(1), "N_units": F.lit("x"), "body": F.lit(2)})
    done = fim.transform(docs)
    assert {"doc_id", "body", "n_units", "form", "output", "prefix_chars", "middle_chars"} == set(done.columns)
    got = sorted(((x.doc_id is None, x.doc_id or 0, x.n_units, x.form, x.output, x.prefix_chars, x.middle_chars, x.back) for x in done.withColumn("back", fim.restored(F.col("output"), F.col("form"))).collect()), key=repr)
    assert got == sorted(((k is None, k or 0, *plain_fim(k, t), t or "") for k, t in rows), key=repr)
    assert {x[3] for x in got} == {"plain", "spm", "psm"}
    assert fim.transform(docs.limit(0)).count() == 0


def test_places_count_units_and_stop_at_the_second_rank():
    text = " one two\n three  "
    assert [fim.places(text, i, j) for i, j in ((0, 0), (1, 3), (3, 1), (4, 2), (9, 9))] == [(4, 0, 0), (4, 4, 15), (4, 4, 15), (4, 8, 17), (4, 17, 17)]



# 13


def plain_tilt(sizes, target, most=2):
    """The tilt by halving, over all sizes."""
    x = np.array(sizes, float)
    x /= x.mean()
    got = lambda tilt: (x * np.exp(np.minimum(tilt * x, np.log(most)))).sum() * (np.mean(sizes))
    low, high = -1e6, np.log(most) / x.min()
    for _ in range(300):
        mid = (low + high) / 2
        low, high = (mid, high) if got(mid) < target else (low, mid)
    return np.exp(np.minimum(high * x, np.log(most)))


def plain_targets(sources, share=1.5, most=2):
    """Deals what is above the bounds anew until none is above."""
    names = sorted(sources, key=lambda s: (s is None, s or ""))
    weight = {s: (5, 2, 1)[i % 3] for i, s in enumerate(names)}
    left, open_, out = share * sum(sources.values()), set(names), {}
    while open_:
        total = sum(weight[s] for s in open_)
        full = {s for s in open_ if left * weight[s] / total >= most * sources[s]}
        for s in full or open_:
            out[s] = most * sources[s] if full else left * weight[s] / total
        left, open_ = left - sum(out[s] for s in full), open_ - (full or open_)
    return out


def check_mix(spark, docs, rows):
    got = [r.asDict() for r in mixing.mix(docs).collect()]
    words = lambda t: len(re.findall(r"[^\x20\x09-\x0D]+", t or ""))
    assert sorted(((r["doc_id"] is None, r["doc_id"] or 0, str(r["source"]), r["size"]) for r in got)) == sorted((i is None, i or 0, str(s), words(t)) for i, t, s in rows)
    sums = {}
    for _, t, s in rows:
        sums.setdefault(s, []).append(words(t))
    want = plain_targets({s: sum(x) for s, x in sums.items()})
    for s, sizes in sums.items():
        own = [r for r in got if r["source"] == s]
        assert {r["source_size"] for r in own} == {sum(sizes)} and all(abs(r["target"] - want[s]) <= 1e-9 * max(1, want[s]) for r in own)
        assert all(0 <= r["taken"] <= 2 * r["size"] for r in own)
        assert abs(sum(r["taken"] for r in own) - want[s]) <= len(own)  # rows with one id and draw share the last words
        some = [n for n in sizes if n]
        if some and want[s] < 2 * sum(sizes):
            rates = dict(zip(some, plain_tilt(some, want[s]), strict=True))
            assert all(abs(r["rate"] - rates[r["size"]]) < 1e-3 for r in own if r["size"])
    return got


def test_mix_matches_a_plain_version(spark):
    """Null sources, texts and ids, empty sources, one long document, a source with most rows, repeated rows."""
    r = random.Random(3)
    source = lambda i: None if i % 17 == 0 else "hot" if i % 3 == 0 else f"s{i % 7}"
    rows = [(i, " ".join(["w"] * int(r.paretovariate(0.8) * 5)), source(i)) for i in range(600)]
    rows += [(1000, "x " * 50_000, "s1"), (1001, None, "s2"), (1002, "", "empty"), (None, "a b c", "s3"), (None, "a b c d", "s3"), (5, "a b", "s5"), (5, "a b", "s5"), (7, " \n", "é")]
    docs = spark.createDataFrame([(i, t, "en", s, 0) for i, t, s in rows], DOCS).withColumns({"size": F.lit("x"), "number": F.lit("y"), "rate": F.lit(0)})
    got = check_mix(spark, docs, rows)
    again = mixing.mix(docs.repartition(7)).collect()
    key = lambda r: repr((r["doc_id"], r["source"], r["size"], r["taken"], r["rate"]))
    assert sorted(map(key, got)) == sorted(key(r.asDict()) for r in again)
    cut = [x for x in got if x["size"] and x["taken"] % x["size"]]
    assert len(cut) <= len({x["source"] for x in got}) + 2  # one a source, and rows that share its id


def test_mix_of_copies_and_of_nothing(spark):
    """Rows with one id are drawn alike: they share what is left by size."""
    rows = [(1, "a b c d", "x")] * 300 + [(2, "a b", "x"), (3, "q " * 900, "y")]
    check_mix(spark, spark.createDataFrame([(i, t, "en", s, 0) for i, t, s in rows], DOCS), rows)
    assert mixing.mix(spark.createDataFrame([], DOCS)).count() == 0
    blank = mixing.mix(spark.createDataFrame([(1, None, "en", "a", 0), (2, " ", "en", None, 0)], DOCS)).collect()
    assert all((r.size, r.source_size, r.target, r.taken) == (0, 0, 0.0, 0) for r in blank)


def test_query_mixes_the_table(spark):
    got = mixing.op13_entropy_balancing(spark, "/root/testdata/sf0.001").toPandas()
    assert len(got) == 200 and abs(got.taken.sum() - 1.5 * got["size"].sum()) <= 20 and (got.taken <= 2 * got["size"]).all()

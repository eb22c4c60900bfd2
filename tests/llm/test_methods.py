"""Methods against plain versions of themselves, and the edges that every text operator shares."""

import hashlib
import json
import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from spanlake.llm import bpe, catalog, decontam, domtree, frames, htmltext, langid, linededup, neardup, pii, quality, sharding, substring

FOLDER, MIDDLE, LARGE = "/root/testdata/sf0.001", "/root/testdata/sf0.01", "/root/testdata/sf0.1"
SHAPE = "doc_id long, text string, lang string, source string, n_chars long"


def rows(spark, *texts, ids=None):
    return spark.createDataFrame([(i, t, "en", "s", len(t or "")) for i, t in zip(ids or range(len(texts)), texts, strict=True)], SHAPE)


# 1


def test_base_spans_of_the_query(spark):
    kinds = {"email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]"}
    rules = {"email": lambda s: True, "ip": lambda s: all(int(p) <= 255 for p in s.split(".")), "card": pii.is_card, "phone": pii.is_phone}
    texts = {r.doc_id: r.text or "" for r in frames.read(spark, MIDDLE, "documents").collect()}
    secrets = found = 0
    for r in catalog.QUERIES["op1_bilstm_crf_pii"](spark, MIDDLE).collect():
        text = texts[r.doc_id]
        want = sorted(((k, m.start(), m.end()) for k, p in kinds.items() for m in re.finditer(p, text) if rules[k](m[0])), key=lambda s: (s[1], list(kinds).index(s[0])))
        shown = [f"{k}:{a}:{b}" for k, a, b in want]
        assert r.base_sha256 == hashlib.sha256(",".join(shown).encode()).hexdigest() and set(shown) <= set(filter(None, r.spans.split(",")))
        assert [r.n_email, r.n_ip, r.n_card, r.n_phone] == [sum(s[0] == k for s in want) for k in kinds]
        held = {f"secret:{m.start(1)}:{m.end(1)}" for m in re.finditer(r'token = "([0-9a-f]{40})"', text)}
        more = set(filter(None, r.spans.split(","))) - set(shown)
        secrets, found = secrets + len(held), found + len(held & more)
        assert len(more - held) <= 1 and r.has_private == bool(r.spans)
    assert found >= 0.9 * secrets > 0  # the model alone knows secrets


def test_unseen_spans_by_kind():
    for kind, (precision, recall) in pii.precision_and_recall(pii.default_model(), 400, seed=7).items():
        assert precision > 0.85 and recall > 0.85, kind


# 3


def test_language_against_numpy(spark):
    docs = frames.read(spark, FOLDER, "documents").select("doc_id", "text", "lang", langid.held_out().alias("out")).collect()
    vectors = langid.GramVectors()
    totals = {}
    for r in docs:
        if not r.out and r.lang is not None:
            for key, n in zip(*langid.ngrams(r.text), strict=True):
                totals[r.lang] = totals.get(r.lang, 0) + n * vectors.bind(int(key)).astype(np.float64)
    names = sorted(totals)
    matrix = np.stack([totals[k] / np.linalg.norm(totals[k]) for k in names])
    got = {r.doc_id: r for r in catalog.QUERIES["op3_hd_language_id"](spark, FOLDER).collect()}
    for r in docs:
        keys, counts = langid.ngrams(r.text)
        if not len(keys):
            assert (got[r.doc_id].lang_pred, got[r.doc_id].score) == ("und", 0.0)
            continue
        own = sum(n * vectors.bind(int(k)).astype(np.float64) for k, n in zip(keys, counts, strict=True))
        cosines = matrix @ own / np.linalg.norm(own)
        assert got[r.doc_id].lang_pred == names[int(cosines.argmax())] and abs(got[r.doc_id].score - max(0, cosines.max())) < 1e-4


def test_repeated_rows_with_other_labels(spark):
    docs = spark.createDataFrame([("the cat sat", "en"), ("the cat sat", "de"), ("the cat sat", "en"), ("das Haus", "de")], "text string, lang string")
    model = langid.fit(docs)
    assert sorted(model) == ["de", "en"] and langid.predict(docs, model).count() == 4


# 7


def test_token_hashes_of_the_query(spark):
    import public_tokenizers
    import tiktoken

    path = public_tokenizers.path(bpe.VOCABULARY)
    other = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=bpe.read_ranks(path), special_tokens={})
    texts = {r.doc_id: r.text or "" for r in frames.read(spark, FOLDER, "documents").collect()}
    sha = lambda x: hashlib.sha256(x).hexdigest()
    for r in catalog.QUERIES["op7_byte_bpe"](spark, FOLDER).collect():
        ids = other.encode_ordinary(texts[r.doc_id])
        assert (r.n_tokens, r.ids_sha256, r.decoded_sha256) == (len(ids), sha(",".join(map(str, ids)).encode()), sha(texts[r.doc_id].encode()))


def test_offsets_of_rows(spark):
    import public_tokenizers

    texts = ["añ 😀x", None, "", "plain words", "中文"]
    out = bpe.encode(rows(spark, *texts), public_tokenizers.path(bpe.VOCABULARY), public_tokenizers.PATTERN, offsets="at").collect()
    for r in out:
        assert len(r.ids) == len(r["at"]) and (not r.ids or (r["at"][0].start, r["at"][-1].end) == (0, len(r.text)))
        assert all(a.start <= b.start <= a.end for a, b in zip(r["at"], r["at"][1:], strict=False))


# 8


def site(r, host, layout, n):
    """Pages of a made-up site with the text of each article."""
    words = lambda k: " ".join("".join(r.choice("abcdefghij") for _ in range(r.randint(2, 8))) for _ in range(k))
    menu = "".join(f"<li><a href='/{i}'>{words(2)}</a></li>" for i in range(7))
    legal = f"<p>{words(60)}</p>"
    for i in range(n):
        head, blocks = words(4), [words(r.randint(10, 60)) for _ in range(r.randint(1, 12))]
        body = "".join(f"<p>{b}</p>" if j % 3 else f"<h3>{b[:20].strip()}</h3><p>{b}</p>" for j, b in enumerate(blocks))
        text = " ".join([head, *(b if j % 3 else f"{b[:20].strip()} {b}" for j, b in enumerate(blocks))])
        advert = f"<div class='ad-box'>{words(9)}</div>"
        talk = f"<section id='comments'><p>{words(12)}</p></section>"
        teaser = "".join(f"<li><a href='/x{i}{j}'>{words(5)}</a></li>" for j in range(5))
        if layout == "article":
            html = f"<body><div class='topbar'>{words(3)}</div><ul>{menu}</ul><article><h1>{head}</h1>{advert}{body}{talk}</article><div>{legal}</div></body>"
        elif layout == "plain":  # containers without names, a notice on some pages only, links that vary
            notice = f"<div><p>{'Please note our terms. ' * 3}</p></div>" if i % 3 == 0 else ""
            html = f"<body>{notice}<div><ul>{menu}</ul></div><div><h1>{head}</h1><div>{body}</div></div><div><ul>{teaser}</ul></div><div>{legal}</div></body>"
        else:  # nested, with a constant line within the text
            html = f"<body><div id='page'><header>{words(2)}</header><div class='content'><h1>{head}</h1><p class='by'>Read on every day</p>{advert}{body}</div><aside>{words(30)}</aside></div><footer>{words(5)}</footer></body>"
        yield f"https://{host}/{i}", html, text


@pytest.mark.parametrize("layout", ["article", "plain", "nested"])
def test_main_text_of_made_up_sites(spark, layout):
    made = list(site(random.Random(layout), f"{layout}.example", layout, 40))
    pages = spark.createDataFrame([(i, u, h) for i, (u, h, _) in enumerate(made)], "page_id long, url string, html string")
    got = {x.page_id: x.text for x in htmltext.main_text(pages).collect()}
    assert [i for i, (_, _, text) in enumerate(made) if got[i] != text] == []


def test_odd_pages(spark):
    deep = "<div>" * 5000 + "<p>bottom</p>"
    mixed = "".join(f"<div><p>x{i}</p>" for i in range(3000))
    html = {
        1: deep, 2: deep.replace("bottom", "floor"), 3: mixed, 4: deep.replace("bottom", "ground"), 5: deep.replace("bottom", "cellar"), 6: None, 7: "", 8: "<p>" + "long " * 200_000, 9: "<p>same</p>", 10: "<p>same</p>",
        11: '<article><p class="search-engine">Kept</p><div class="social-science"><p>too</p></div></article>', 12: '<div id="comments-policy-article"><article><p>Policy</p></article></div>', 13: '<article>A<div class="ad">no</div>B</article>',
    }
    pages = spark.createDataFrame([(i, "https://one.example/", h) for i, h in html.items()], "page_id long, url string, html string")
    got = {x.page_id: x.text for x in htmltext.main_text(pages).collect()}
    assert [got[i] for i in (1, 2, 4, 5)] == ["bottom", "floor", "ground", "cellar"] and got[3].startswith("x0 x1 ") and got[6] == got[7] == ""
    assert len(got[8]) == 999_999 and got[9] == got[10] == "same" and (got[11], got[12], got[13]) == ("Kept too", "Policy", "A B")
    assert htmltext.main_text(pages.limit(0)).count() == 0


def test_matching_against_recursion():
    def best(a, b):
        if a[0] != b[0]:
            return 0
        m, n = len(a[1]), len(b[1])
        t = [[0] * (n + 1) for _ in range(m + 1)]
        for i in range(m):
            for j in range(n):
                t[i + 1][j + 1] = max(t[i][j + 1], t[i + 1][j], t[i][j] + best(a[1][i], b[1][j]))
        return 1 + t[m][n]

    r = random.Random(3)

    def tree(depth):
        return (r.choice("abc"), [tree(depth - 1) for _ in range(r.randint(0, 4))] if depth else [])

    def shape(t):
        s = domtree.Shape.made(t[0], "")
        s.kids = [shape(k) for k in t[1]]
        return s

    for _ in range(200):
        a, b = ("x", [tree(3) for _ in range(3)]), ("x", [tree(3) for _ in range(3)])
        p, q = shape(a), shape(b)
        p.measure()
        q.measure()
        score, pairs = domtree.match(p, q)
        assert score == best(a, b) == len(pairs) and all(x.sign == y.sign for x, y in pairs)
        grown = domtree.grow(domtree.load(domtree.dump(p)), q)
        assert domtree.match(grown, q)[0] == q.size  # all of a page is in the wrapper that grew with it


# 10


def test_verdicts_against_plain_counts(spark):
    docs, labels = frames.read(spark, LARGE, "documents"), frames.read(spark, LARGE, "labels")
    got = {r.doc_id: r for r in catalog.QUERIES["op10_risk_controlled_rules"](spark, LARGE).collect()}
    good = {r.doc_id for r in labels.groupBy("doc_id").agg(F.min("quality").alias("q")).where("q = 1").collect()}
    measured = quality.measure(docs.select("doc_id", "lang", "text")).drop("text")
    table = measured.select("doc_id", F.coalesce("lang", F.lit("")).alias("s"), *[F.expr(e).alias(k) for k, e in quality.RULES.items()]).collect()
    strata = {r.s for r in table if r.doc_id in good}
    cut = {}
    for s in strata:
        own = [r for r in table if r.s == s and r.doc_id in good]
        counts = {(s, k, step): sum(np.ceil(r[k] * quality.STEPS) > step for r in own) for k in quality.RULES for step in range(quality.STEPS)}
        union = {(s, step): sum(np.ceil(max(r[k] for k in quality.RULES) * quality.STEPS) > step for r in own) for step in range(quality.STEPS)}
        cut |= {s: {}} | quality.choose(counts, {s: len(own)}, list(quality.RULES), quality.ALPHA, quality.DELTA / len(strata), union=union)
    fired = 0
    for r in table:
        over = [k for k in quality.RULES if r[k] > cut.get(r.s, cut.get("", {})).get(k, 2)]
        assert sorted(got[r.doc_id].rejected_by) == sorted(over) and got[r.doc_id].kept == (not over and not got[r.doc_id].base_failed)
        fired += bool(over)
    assert fired > 0
    held = [r for r in table if r.doc_id in good]
    assert sum(bool(got[r.doc_id].rejected_by) for r in held) <= quality.ALPHA * len(held)


def test_risk_on_unseen_labels(spark):
    docs = frames.read(spark, LARGE, "documents").select("doc_id", "lang", "text")
    labels = frames.read(spark, LARGE, "labels")
    half = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 2 == 0
    out = quality.apply_rules(docs, labels.where(half), alpha=0.02, with_text=False)
    unseen = out.join(labels.where(~half & (F.col("quality") == 1)).select("doc_id").distinct(), "doc_id", "left_semi")
    lost, n = unseen.agg(F.count_if(F.size("rejected_by") > 0), F.count(F.lit(1))).first()
    assert n > 500 and lost / n <= 0.02 + 3 * (0.02 * 0.98 / n) ** 0.5


# all of them


def test_empty_tables(spark):
    import corpus_pipeline
    import public_tokenizers

    none = rows(spark)
    items = spark.createDataFrame([(1, "one two three")], "item_id long, text string")
    path, pattern = public_tokenizers.path(bpe.VOCABULARY), public_tokenizers.PATTERN
    labels = spark.createDataFrame([], "doc_id long, quality int")
    made = [pii.find(none), decontam.contaminated(none, items), langid.predict(none, langid.fit(none)), sharding.layout(none), substring.remove_repeats(none), linededup.drop_boilerplate(none), bpe.round_trip(none, path, pattern), neardup.near_duplicates(none), quality.apply_rules(none, labels)]
    assert [df.count() for df in made] == [0] * len(made)
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, none, FOLDER).count() == 0


def test_ties_and_repeats(spark):
    text = " ".join(f"w{i}" for i in range(40))
    twice = rows(spark, text, text, text + " end", "x", "x", ids=[3, 3, 1, 2, 2])
    out = {(r.doc_id, r.component_id, r.kept) for r in neardup.near_duplicates(twice).collect()}
    assert out == {(3, 1, False), (1, 1, True), (2, 2, True)}
    slots = sharding.layout(twice).groupBy("shard").agg(F.sort_array(F.collect_list("slot")).alias("s")).collect()
    assert all(r.s == list(range(len(r.s))) for r in slots)
    kept = {(r.doc_id, r.kept_text) for r in substring.remove_repeats(twice).collect()}
    assert kept == {(3, ""), (1, text + " end"), (2, "x")}


def test_stages_keep_what_they_must(spark):
    import corpus_pipeline

    long = " ".join(f"word{i} the" for i in range(40))
    odd = spark.createDataFrame([(1, long, "en", "a", 1), (1, long, "en", "a", 1), (1, "quite another text of the same id", "en", "a", 1), (None, long, "en", "a", 1), (5, None, None, None, None), (7, "", "en", "b", 0)], SHAPE)
    near = corpus_pipeline.remove_near_duplicates(spark, odd, FOLDER)
    assert sorted((r.doc_id or 0, r.text or "") for r in near.collect()) == [(0, long), (1, "quite another text of the same id"), (1, long), (5, ""), (7, "")]
    assert corpus_pipeline.remove_leaks(spark, odd, FOLDER).count() == 6 and corpus_pipeline.remove_boilerplate(spark, odd, FOLDER).count() == 6
    assert all(json.dumps(list(r.ids)) and r.n_tokens == len(r.ids) for r in corpus_pipeline.tokenize(spark, odd, FOLDER).collect())


def test_scratch_tables_are_deleted(spark):
    import os

    folder = frames._shared_folder(spark).removeprefix("file:")
    before = set(os.listdir(folder))
    out = neardup.near_duplicates(frames.read(spark, FOLDER, "documents"))
    assert len({x for x in set(os.listdir(folder)) - before if x.startswith("table-")}) <= 2 and out.count() == 200

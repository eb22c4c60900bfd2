"""Main text of odd pages, and of the whole table against a plain reading of its articles."""

import html
import itertools
import random
import re
import time

import pytest

from spanlake.llm import domtree, htmltext

FOLDER = "/root/testdata/sf0.01"


@pytest.mark.parametrize(
    "page,text",
    [
        ("<article><p data-x=it's>Hello don't stop</p><p>Second</p></article>", "Hello don't stop Second"),
        ('<article><p title="a"">One</p></article>', "One"),
        ('<article><p title="never closed>lost?</p><p>more</p></article>', "lost? more"),
        ('<a href=x?y="q>link</a><article id=a/b><p class = "x>y" title=>T</p></article>', "T"),
        ('<article><p title="class=ad">k</p><div data-class="ad" class="x" class="ad">z</div><div class="ad">gone</div></article>', "k z"),
        ('<article><p>Body text.</p><article class="comment"><p>rude</p></article></article><article class="comment">so</article>', "Body text."),
        ('<article class="teaser">short</article><article><p>The long article.</p></article><article>next</article>', "The long article."),
        ('<article class="comment">only</article>', "only"),
        ('<article><p>A</p><math><mi>x</mi></math> <button>Go</button><label>L</label><svg><text>T</text></svg></article>', "A x GoLT"),
        ('<article><p>A</p><figure class="banner"><img src=x><figcaption>cap</figcaption></figure></article>', "A cap"),
        ('<article><p>A<form><label>L</label></form><select><option>o</select><p>B', "A B"),
        ("<article><p>one<p>two<div>three</div></p>four", "one two three four"),
        ("", ""), ("no tags &amp; all", "no tags & all"), ("<article></article>", ""),
    ],
)
def test_odd_pages(page, text):
    assert htmltext.extract(page, None) == text


@pytest.mark.parametrize("page", ["<ul><li>{n}x{m}</li></ul>", "<div><p>{n}x{m}", "<b>{n}x{m}</i>"])
def test_deep_pages_take_time_by_their_length(page):
    """30,000 levels: lists in lists, paragraphs that blocks end, tags that close nothing."""
    open_, close = page.split("{n}x{m}")
    began = time.perf_counter()
    assert htmltext.extract(open_ * 30_000 + "x" + close * 30_000, None) == "x"
    assert time.perf_counter() - began < 10  # quadratic work takes minutes


def best_sum(left, right):
    table = [[0] * (len(right) + 1) for _ in range(len(left) + 1)]
    for i, x in enumerate(left):
        for j, y in enumerate(right):
            own = (x.size if x.key == y.key else 1) if x.sign == y.sign else 0
            table[i + 1][j + 1] = max(table[i][j + 1], table[i + 1][j], table[i][j] + own)
    return table[-1][-1]


@pytest.mark.parametrize("seed", range(6))
def test_long_lists_are_aligned_as_a_whole(seed):
    """The sum of a full table, pairs in order, each child once."""
    r = random.Random(seed)

    def shapes(n):
        out = []
        for _ in range(n):
            x = domtree.Shape.made(r.choice("abc"), "")
            x.kids = [domtree.Shape.made(r.choice("de"), "") for _ in range(r.randint(0, 2))]
            x.measure()
            out.append(x)
        return out

    left, right = shapes(r.randint(0, 60)), shapes(r.randint(1, 60))
    pairs = domtree._aligned(left, right)
    at = [(left.index(p), right.index(q)) for p, q in pairs]
    assert all(a < c and b < d for (a, b), (c, d) in itertools.pairwise(at)) and all(p.sign == q.sign for p, q in pairs)
    assert sum(p.size if p.key == q.key else 1 for p, q in pairs) == best_sum(left, right)


def test_long_lists_of_far_places_match(monkeypatch):
    """A list that starts with 200 further children of other signatures meets its like beyond them."""
    page = lambda head: domtree.Shape([domtree.parse("<div>" + "".join(f"<{t}><i></i></{t}>" for t in head) + "</div>")], "")
    a, b = ["p", "h2"] * 40 + ["h3"], ["dl", "table"] * 100 + ["p", "h2"] * 39 + ["h4", "p", "h2"]
    small = domtree.match(page(a), page(b))[0]
    monkeypatch.setattr(domtree, "MATCH_CELLS", 10**9)
    assert small == domtree.match(page(a), page(b))[0] > 80


def test_query_reads_every_article(spark):
    """The text between the tags of the article, without adverts; blocks are apart, inline tags are not."""
    inline = re.compile(r"</?(?:b|i|em|strong|a|span|code|u|small|sub|sup)\b[^>]*>")
    got = {r.page_id: r for r in htmltext.op8_wrapper_induction(spark, FOLDER).collect()}
    rows = spark.read.parquet(f"{FOLDER}/pages.parquet").collect()
    assert len(rows) == len(got)
    for r in rows:
        found = re.findall(r"<article[^>]*>(.*?)(?:</article>|<footer|\Z)", r.html or "", re.S)
        plain = " ".join(re.sub(r'<div class="ad">.*?</div>|<!--.*?-->', " ", x, flags=re.S) for x in found)
        want = " ".join(html.unescape(re.sub(r"<[^>]+>", " ", inline.sub("", plain))).split())
        assert got[r.page_id].text == want and got[r.page_id].n_chars == len(want) and got[r.page_id].url == r.url

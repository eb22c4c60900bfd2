"""Operator 8: main text of web pages by wrapper induction over all pages of a host."""

from __future__ import annotations

import json
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from spanlake.llm import domtree
from spanlake.llm.domtree import Node, Shape, block_text, containers, digest, parse, slots, text_of
from spanlake.llm.frames import fresh, read, scratch, stored

#: Distinct pages of a host whose trees are matched into its wrapper, which names slots; what is constant is counted over all.
REFERENCES = 16
#: Distinct pages that a constant needs, and the share of a slot's pages that has it.
CONSTANT_PAGES, CONSTANT_SHARE = 4, 0.9
#: Share of link text from which a slot is a menu, and share of the text that a child has that takes its parent's place.
LINK_SHARE, DENSE_SHARE = 0.8, 0.8
#: Wrappers are broadcast up to so many bytes and joined by a shuffle beyond; a task keeps as many read ones.
BROADCAST_BYTES = 8 << 20
_OWN_TEXTS = frozenset(("h1", "h2", "h3", "p", "pre"))
_TEXTS = frozenset(("p", "h1", "h2", "h3", "h4", "b", "span", "a", "li", "td"))


def host_of(url: Column) -> Column:
    """The host of a URL in lower case, without port and user; '' if there is none."""
    return F.coalesce(F.regexp_extract(F.lower(url), r"^[a-z][a-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)", 1), F.lit(""))


def _outermost(root: Node, tag: str, named: bool) -> list[Node]:
    out, todo = [], [root]
    while todo:
        node = todo.pop()
        if node.tag == tag:
            out.append(node)
        else:
            todo += reversed([k for k in node.nodes() if named or not k.named])
    return out


def link_text(node: Node) -> int:
    """Characters of the text in links below a node."""
    return sum(len(text_of(n)) for n in node.elements() if n.tag == "a" and n.up.tag != "a")


def _solid(text: str) -> int:
    return sum(map(len, text.split()))


def sizes(root: Node, dull: Callable[[Node], bool]) -> dict[int, tuple[int, int]]:
    """Characters, white space apart, of the text below each element that isn't dull, and of those in links; each text is looked at once."""
    out: dict[int, tuple[int, int]] = {}
    for n in reversed(list(root.elements())):
        own = links = 0
        for k in () if dull(n) else n.kids:
            if isinstance(k, str):
                own += _solid(k)
            elif id(k) in out:
                own, links = own + out[id(k)][0], links + out[id(k)][1]
        out[id(n)] = own, own if n.tag == "a" else links
    return out


def main_node(root: Node, dull: Callable[[Node], bool]) -> tuple[Node, bool]:
    """The node that holds the article, and whether the page says so: of the outermost <article>s the one with most text that isn't dull, else <main>, else the densest node.

    An element whose names mark comments, teasers and the like is no article as long as another is there. The densest node is
    found from the top over text that isn't dull: a child with DENSE_SHARE of all of it takes the place of its parent, unless
    the parent has headings or paragraphs of its own.
    """
    there = next((x for named, tag in ((False, "article"), (False, "main"), (True, "article"), (True, "main")) if (x := _outermost(root, tag, named))), [])
    if len(there) == 1:
        return there[0], True
    size = {k: own for k, (own, _) in sizes(root, lambda n: n.named or dull(n)).items()}
    if there:
        return max(there, key=lambda n: size[id(n)]), True  # the first of those with as much
    here = root
    while True:
        kids = [k for k in here.nodes() if size[id(k)] >= DENSE_SHARE * size[id(root)] > 0]
        if not kids or kids[0].tag in _TEXTS or any(k.tag in _OWN_TEXTS and size[id(k)] for k in here.nodes() if k is not kids[0]):
            return here, False
        here = kids[0]


def features(source: str, wrapper: Shape | None) -> list[dict]:
    """The blocks of a page: their slot, a digest of their text, its length, and that of its links; equal blocks of a slot once."""
    root = parse(source)
    where, inside = slots(root, wrapper), containers(root)
    found: dict[tuple[int, int], list[int]] = {}
    for node in root.elements():
        if id(node) not in inside and (text := block_text(node)):
            entry = found.setdefault((where[id(node)], digest(text)), [0, 0])
            entry[0] += len(text)
            entry[1] += link_text(node)
    return [{"slot": s, "block": b, "size": n, "links": k} for (s, b), (n, k) in found.items()]


class Wrapper:
    """What is known of a host: the tree of its slots, the constant blocks of each slot, and the slots of menus."""

    def __init__(self, text: str | None):
        raw = json.loads(text) if text else {}
        self.tree = domtree.load(json.loads(raw["tree"])) if raw.get("tree") else None
        self.template: dict[int, set[int]] = {}
        for x in raw.get("template") or ():
            self.template.setdefault(x["slot"], set()).add(x["block"])
        self.menus = set(raw.get("menus") or ())


def extract(source: str | None, wrapper: Wrapper | None) -> str:
    """The article's text of one whole page (null or empty: empty).

    Constant blocks of the host go everywhere; elements whose names mark comments, adverts and the like go too. Slots of
    menus, and on a host without a wrapper lists of links, go where no <article> or <main> marks the article.
    """
    if not source:
        return ""
    root, wrapper = parse(source), wrapper or Wrapper(None)
    inside = containers(root)
    where = slots(root, wrapper.tree) if wrapper.template or wrapper.menus else {}
    constant = {id(n) for n in root.elements() if id(n) not in inside and (known := wrapper.template.get(where.get(id(n)))) and (text := block_text(n)) and digest(text) in known}
    menus = {id(n) for n in root.elements() if where.get(id(n)) in wrapper.menus and id(n) not in inside}
    if wrapper.tree is None:
        own = sizes(root, lambda n: False)
        menus |= {id(n) for n in root.elements() if n.tag in ("ul", "ol") and own[id(n)][0] and own[id(n)][1] >= LINK_SHARE * own[id(n)][0]}
    main, marked = main_node(root, lambda n: id(n) in constant or id(n) in menus)
    return text_of(main, lambda n: n is not main and (n.named or id(n) in constant or not marked and id(n) in menus))


def _batched(run: Callable[[pa.RecordBatch], pa.RecordBatch], rows: int = 100) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    return lambda batches: (run(batch.slice(a, rows)) for batch in batches for a in range(0, batch.num_rows, rows))


def _kept(read_one: Callable[[str], object]) -> Callable[[str | None], object]:
    """A reader that keeps what it has read, up to BROADCAST_BYTES of source."""
    known: dict[str, object] = {}
    held = 0

    def get(text: str | None) -> object:
        nonlocal held
        if text is None:
            return None
        if text not in known:
            if held > BROADCAST_BYTES:
                known.clear()
                held = 0
            known[text] = read_one(text)
            held += len(text)
        return known[text]

    return get


def _small(df: DataFrame, *texts: str) -> DataFrame:
    """A written table, marked for a broadcast join if its texts are BROADCAST_BYTES at most."""
    size = df.agg(F.sum(sum((F.coalesce(F.octet_length(t), F.lit(0)) for t in texts), F.lit(32)))).first()[0] or 0
    return F.broadcast(df) if size <= BROADCAST_BYTES else df


def trees(pages: DataFrame) -> DataFrame:
    """host, tree: the wrapper's slots of each host with CONSTANT_PAGES distinct pages (pages: host, page, html; page is a digest).

    The REFERENCES distinct pages with the least digests are matched one after the other. Pages are ranked among the few
    whose digest is low for the number of their host's pages, so no group has many.
    """
    distinct = pages.select("host", "page").distinct()
    enough = distinct.groupBy("host").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= CONSTANT_PAGES)
    part = F.col("page").cast("double") / 2.0**64 + 0.5
    low = distinct.join(enough, "host").where(part * F.col("n") <= 4 * REFERENCES)
    ranked = low.withColumn("rank", F.row_number().over(Window.partitionBy("host").orderBy("page"))).where(F.col("rank") <= REFERENCES)
    chosen = ranked.select("host", "page")
    sample = pages.join(chosen, ["host", "page"], "left_semi").groupBy("host", "page").agg(F.first("html").alias("html"))

    def build(group: pa.Table) -> pa.Table:
        wrapper = None
        for html in group.sort_by("page").column("html").to_pylist():
            root = parse(html)
            wrapper = domtree.grow(wrapper, Shape([root], "", containers(root)))
        return pa.table({"host": group.column("host").slice(0, 1), "tree": [json.dumps(domtree.dump(wrapper))]})

    return sample.groupBy("host").applyInArrow(build, "host string, tree string")


def induce_hosts(pages: DataFrame, host: str, html: str) -> DataFrame:
    """The wrapper of each host as JSON: host, wrapper; from all pages, of which copies count once.

    Every page is aligned with its host's tree. A block that CONSTANT_SHARE of the pages with its slot have there,
    CONSTANT_PAGES at least, is template; so a second layout or a notice of some pages is judged by the pages that have
    its slots. A slot of mostly links is a menu. All else varies and is content. Counts are summed in the tasks before they
    meet, so no task gets all pages of a host. Hosts with fewer distinct pages have no wrapper.
    """
    named = pages.where(F.length(html) > 0).select(F.col(host).alias("host"), F.xxhash64(html).alias("page"), F.col(html).alias("html"))
    built = stored(trees(named))
    kinds = pa.list_(pa.struct([("slot", pa.int64()), ("block", pa.int64()), ("size", pa.int64()), ("links", pa.int64())]))

    def tell(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tree = _kept(lambda text: domtree.load(json.loads(text)))

        def run(part: pa.RecordBatch) -> pa.RecordBatch:
            made = [features(x, tree(t)) for x, t in zip(part.column("html").to_pylist(), part.column("tree").to_pylist(), strict=True)]
            return pa.RecordBatch.from_arrays([part.column("host"), part.column("page"), pa.array(made, kinds)], names=["host", "page", "blocks"])

        return _batched(run)(batches)

    told = named.join(_small(built, "host", "tree"), "host").mapInArrow(tell, "host string, page long, blocks array<struct<slot: long, block: long, size: long, links: long>>")
    told = stored(told.dropDuplicates(["host", "page"]))
    blocks = told.select("host", F.explode("blocks").alias("b")).groupBy("host", "b.slot", "b.block").agg(F.count(F.lit(1)).alias("n"), F.sum("b.size").alias("size"), F.sum("b.links").alias("links"))
    blocks = stored(blocks)
    each = told.select("host", F.explode(F.array_distinct(F.col("blocks.slot"))).alias("slot")).groupBy("host", "slot").agg(F.count(F.lit(1)).alias("pages")).where(F.col("pages") >= CONSTANT_PAGES)
    each = stored(each)
    constant = blocks.where(F.col("n") >= CONSTANT_PAGES).join(each, ["host", "slot"]).where(F.col("n") >= CONSTANT_SHARE * F.col("pages"))
    linked = blocks.groupBy("host", "slot").agg(F.sum("size").alias("size"), F.sum("links").alias("links")).where(F.col("links") >= LINK_SHARE * F.col("size")).join(each, ["host", "slot"], "left_semi")
    template = constant.groupBy("host").agg(F.collect_list(F.struct("slot", "block")).alias("template"))
    menus = linked.groupBy("host").agg(F.collect_list("slot").alias("menus"))
    return built.join(template, "host", "left").join(menus, "host", "left").select("host", F.to_json(F.struct("tree", "template", "menus")).alias("wrapper"))


def main_text(pages: DataFrame, url: str = "url", html: str = "html", out: str = "text") -> DataFrame:
    """All rows and columns of pages with the main text of each whole page (null or empty HTML: empty text).

    A null URL, or one without a host, belongs to the host ''. A host with fewer than CONSTANT_PAGES distinct pages has no
    template; its article is found by its tags, by names and by where the text is. Repeated rows get equal texts and count
    once. However deep or long a page is, it is read to its end. A column named `out` is replaced.
    """
    host, wrapper = fresh(pages, "host", "wrapper")
    keep = [c for c in pages.columns if c.lower() != out.lower()]
    hosted = pages.select(*keep, host_of(F.col(url)).alias(host))
    with scratch(pages.sparkSession) as hold:
        learned = hold(stored(induce_hosts(hosted, host, html).select(F.col("host").alias(host), F.col("wrapper").alias(wrapper))))
    joined = hosted.join(_small(learned, host, wrapper), host, "left").select(*keep, wrapper)
    at = [c.lower() for c in keep].index(html.lower())

    def text(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = _kept(Wrapper)

        def run(part: pa.RecordBatch) -> pa.RecordBatch:
            made = [extract(x, known(w)) for x, w in zip(part.column(at).to_pylist(), part.column(len(keep)).to_pylist(), strict=True)]
            return pa.RecordBatch.from_arrays([*part.columns[: len(keep)], pa.array(made, pa.string())], names=[*keep, out])

        return _batched(run)(batches)

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in joined.schema.fields[:-1])
    return joined.mapInArrow(text, f"{schema}, `{out}` string")


def op8_wrapper_induction(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = main_text(read(spark, sf_dir, "pages"))
    return out.select("page_id", "url", "text", F.char_length("text").cast("long").alias("n_chars"))

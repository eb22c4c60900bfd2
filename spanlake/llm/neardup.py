"""Operator 9: near-duplicate groups by fast similarity sketching, banding and exact verification."""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from spanlake.llm.components import extend
from spanlake.llm.frames import cut, read, scratch, stored, table
from spanlake.llm.textio import NOT_SPACE, buffers, grams, mix, runs, signed, slices, word_hashes

#: Words in a shingle, and the least similarity of a link in hundredths.
SHINGLE, PERCENT = 5, 85
#: A band of ROWS coordinates meets for a pair of similarity 0.85 with chance 0.32, so all BANDS miss it with chance 9e-7.
BANDS, ROWS = 36, 7
#: The same for the documents that first rounds leave open: narrow bands (chance 0.033 each, all miss with 8e-7) that
#: pairs of similarity 0.7 share in one of four cases only.
NARROW_BANDS, NARROW_ROWS = 420, 21
#: Rounds that try one partner a bucket before all pairs between the groups that are left are tried.
ROUNDS = 6
#: Documents of a task that makes narrow bands, and elements of sets that a task keeps while it compares.
NARROW_DOCS, KEPT_ELEMENTS = 200, 2_000_000
#: Chances that all bands of a kind miss a pair at the threshold, from which other thresholds get their number of bands.
MISS, NARROW_MISS = 1e-6, 8e-7
_EMPTY = np.uint64(0xFFFFFFFFFFFFFFFF)


class Bands(NamedTuple):
    """Least similarity of a link in hundredths, and the bands and coordinates a band of both kinds."""

    percent: int
    bands: int
    rows: int
    narrow_bands: int
    narrow_rows: int


def bands_for(percent: int = PERCENT) -> Bands:
    """Bands for a threshold: as long as a band meets a pair at it about as often as at PERCENT, and enough of them.

    At PERCENT they are BANDS of ROWS and NARROW_BANDS of NARROW_ROWS.
    """
    if not 0 < percent <= 99:
        raise ValueError("percent is from 1 to 99")
    sim = percent / 100
    scale = math.log(PERCENT / 100) / math.log(sim)
    rows, narrow = (max(1, math.ceil(n * scale - 1e-9)) for n in (ROWS, NARROW_ROWS))
    enough = lambda miss, n: math.ceil(math.log(miss) / math.log1p(-(sim**n)))
    return Bands(percent, enough(MISS, rows), rows, enough(NARROW_MISS, narrow), narrow)


def shingle_sets(column: pa.Array, size: int = SHINGLE) -> list[np.ndarray]:
    """The sorted distinct shingles of each row as 64-bit hashes; fewer words than a shingle are one."""
    data, offsets = buffers(column)
    starts, ends, first = runs(data, offsets, NOT_SPACE)
    hashes = word_hashes(data, starts, ends, lower=True)
    whole = grams(hashes, size)
    out = []
    for a, b in zip(first[:-1].tolist(), first[1:].tolist(), strict=True):
        n = b - a
        out.append(np.unique(whole[a : b - size + 1]) if n >= size else grams(hashes[a:b], n) if n else np.empty(0, np.uint64))
    return out


def sketches(sets: list[np.ndarray], t: int) -> np.ndarray:
    """A fast similarity sketch of each set: t coordinates that agree with the chance of the similarity.

    Round i throws every element into one of t bins at a random height between i and i + 1 and each bin
    keeps its lowest; a set is done when all its bins have one. After t rounds, round t + j throws all
    elements into bin j, so every coordinate fills. A set of s elements needs about s + t log t throws.
    """
    out = np.full((len(sets), t), _EMPTY, np.uint64)
    sizes = np.array([len(s) for s in sets])
    todo = np.flatnonzero(sizes)
    elements = np.concatenate([sets[i] for i in todo]) if len(todo) else np.empty(0, np.uint64)
    rows = np.repeat(todo, sizes[todo])
    flat = out.reshape(-1)
    pause = max(1, t * len(todo) // max(1, 2 * len(elements)))  # rounds between looks; a full set's further throws are all higher
    for i in range(2 * t):
        if not len(todo):
            break
        x = mix(elements ^ mix(np.full(1, i + 1, np.uint64)))
        bins = ((x >> np.uint64(32)) * np.uint64(t)) >> np.uint64(32) if i < t else np.full(len(x), i - t, np.uint64)
        height = (np.uint64(i) << np.uint64(54)) | (mix(x) >> np.uint64(10))
        np.minimum.at(flat, rows * t + bins.astype(np.int64), height)
        if (i + 1) % pause and i != t - 1:
            continue
        open_ = (out[todo] == _EMPTY).any(axis=1)
        if not open_.all():
            still = np.zeros(len(sets), bool)
            todo = todo[open_]
            still[todo] = True
            here = still[rows]
            elements, rows = elements[here], rows[here]
    return out


def band_keys(sketch: np.ndarray, bands: int = BANDS, rows: int = ROWS) -> np.ndarray:
    """A 64-bit key of each band of each sketch."""
    parts = sketch.reshape(len(sketch), bands, rows)
    key = np.broadcast_to(np.arange(bands, dtype=np.uint64), parts.shape[:2]).copy()
    for j in range(rows):
        key = mix(key ^ parts[:, :, j])
    return key


def _sketched(batches: Iterator[pa.RecordBatch], of: Bands) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for part in slices(batch):
            sets = shingle_sets(part.column("text"))
            keys = band_keys(sketches(sets, of.bands * of.rows), of.bands, of.rows)
            n = np.array([len(s) for s in sets], np.int64)
            prints = [np.array([f(s) for s in sets], np.uint64) for f in (lambda s: mix(s ^ np.uint64(0xA5A5)).sum(dtype=np.uint64), lambda s: mix(s + np.uint64(0x5EED)).sum(dtype=np.uint64))]
            lists = pa.ListArray.from_arrays(pa.array(np.arange(len(n) + 1) * of.bands, pa.int32()), signed(keys.reshape(-1)))
            yield pa.RecordBatch.from_arrays([part.column("doc_id"), pa.array(n), signed(prints[0]), signed(prints[1]), lists], names=["doc_id", "n", "p", "q", "bands"])


def _packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Texts as compressed bytes: half of what they take in a shuffle."""
    codec = pa.Codec("zstd", 1)
    for batch in batches:
        raw = [x.as_buffer() if x.is_valid else pa.py_buffer(b"") for x in batch.column("text")]
        yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("mark"), pa.array([len(x) for x in raw], pa.int64()), pa.array([codec.compress(x, asbytes=True) for x in raw], pa.binary())], names=["doc_id", "mark", "size", "blob"])


def _texts(batch: pa.RecordBatch, side: str = "") -> Iterator[bytes]:
    codec = pa.Codec("zstd", 1)
    for blob, size in zip(batch.column(f"{side}blob"), batch.column(f"{side}size").to_pylist(), strict=True):
        yield codec.decompress(blob.as_buffer(), size, asbytes=True)


def _narrowed(batches: Iterator[pa.RecordBatch], of: Bands) -> Iterator[pa.RecordBatch]:
    """The narrow bands of documents."""
    for batch in batches:
        for part in (batch.slice(a, 50) for a in range(0, batch.num_rows, 50)):
            sets = shingle_sets(pa.array([t.decode() for t in _texts(part)], pa.large_string()))
            keys = band_keys(sketches(sets, of.narrow_bands * of.narrow_rows), of.narrow_bands, of.narrow_rows)
            lists = pa.ListArray.from_arrays(pa.array(np.arange(len(sets) + 1) * of.narrow_bands, pa.int32()), signed(keys.reshape(-1)))
            yield pa.RecordBatch.from_arrays([part.column("node"), pa.array([len(x) for x in sets], pa.int64()), lists], names=["node", "n", "bands"])


def _verified(batches: Iterator[pa.RecordBatch], percent: int) -> Iterator[pa.RecordBatch]:
    """Whether each pair is a link, and its Jaccard distance, from the full sets."""
    codec = pa.Codec("zstd", 1)
    for batch in batches:
        known: dict[tuple[int, int, int], np.ndarray] = {}
        held = 0
        cols = {c: batch.column(c).to_pylist() for c in ("a", "b", "a_size", "b_size")}
        links, distances = [], []
        for i in range(batch.num_rows):
            pair = []
            for side in "ab":
                blob = batch.column(f"{side}_blob")[i].as_buffer()
                key = (cols[side][i], blob.size, hash(bytes(blob)))
                if key not in known:
                    text = codec.decompress(blob, cols[f"{side}_size"][i], asbytes=True)
                    made = shingle_sets(pa.array([text.decode()], pa.large_string()))[0]
                    if held + len(made) > KEPT_ELEMENTS:
                        known, held = {}, 0
                    known[key], held = made, held + len(made)
                pair.append(known[key])
            both = len(np.intersect1d(*pair, assume_unique=True))
            union = len(pair[0]) + len(pair[1]) - both
            links.append(100 * both >= percent * union)
            distances.append(1 - both / union)
        yield pa.RecordBatch.from_arrays([batch.column("a"), batch.column("b"), pa.array(links, pa.bool_()), pa.array(distances, pa.float64())], names=["a", "b", "link", "distance"])


def _sizes_fit(x: Column, y: Column, percent: int) -> Column:
    return 100 * F.least(x, y) >= percent * F.greatest(x, y)


def _with(run: Callable, what: object) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    return lambda batches: run(batches, what)


def _once(blobs: DataFrame) -> DataFrame:
    """A written table of texts (doc_id, mark, size, blob, row) with one row of those that share doc_id and mark, found by ids alone."""
    several = blobs.groupBy("doc_id", "mark").agg(F.min("row").alias("first"), F.count(F.lit(1)).alias("c")).where("c > 1")
    extra = table(blobs.select("doc_id", "mark", "row").join(several.drop("c"), ["doc_id", "mark"]).where("row <> first").select("row"))
    return (blobs if extra.isEmpty() else blobs.join(extra, "row", "left_anti")).select("doc_id", "size", "blob")


class _Search:
    """Buckets of classes of equal sets, and the groups found so far."""

    def __init__(self, docs: DataFrame, of: Bands):
        self.of = of
        rows = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
        self.rows = cut(rows.mapInArrow(_with(_sketched, of), "doc_id long, n long, p long, q long, bands array<long>"))
        known = self.rows.where("n > 0 AND doc_id IS NOT NULL")
        tops = known.groupBy("p", "q").agg(F.min("doc_id").alias("node"), F.first("n").alias("n"), F.first("bands").alias("bands"))
        copies = known.groupBy("p", "q").agg(F.min("doc_id").alias("node"), F.count(F.lit(1)).alias("c")).where("c > 1")
        self.classes = table(copies.drop("c"))  # a document without copies is its own class and isn't looked up
        members = tops.select(F.explode("bands").alias("key"), "node", "n")
        shared = members.groupBy("key").agg(F.count(F.lit(1)).alias("c")).where("c > 1").select("key")
        self.members = table(members.join(shared, "key", "left_semi"))
        texts = docs.select("doc_id", F.xxhash64("text").alias("mark"), "text").where("doc_id IS NOT NULL")
        blobs = texts.mapInArrow(_packed, "doc_id long, mark long, size long, blob binary")
        wanted = table(self.members.select(F.col("node").alias("doc_id")).distinct())
        self.blobs = _once(stored(blobs.join(wanted, "doc_id", "left_semi").withColumn("row", F.monotonically_increasing_id())))
        self.tested = None
        self.roots = None
        self.anchors = None

    def verify(self, pairs: DataFrame) -> DataFrame:
        """a, b, link and distance of pairs (a, b), from their full texts. If rows share a doc_id, each of their texts is tried."""
        side = lambda s: self.blobs.select(F.col("doc_id").alias(s), F.col("size").alias(f"{s}_size"), F.col("blob").alias(f"{s}_blob"))
        joined = pairs.join(side("a"), "a").join(side("b"), "b")
        return joined.mapInArrow(_with(_verified, self.of.percent), "a long, b long, link boolean, distance double")

    def add(self, pairs: DataFrame) -> bool:
        """Verifies pairs that weren't yet and joins the groups that they link; false if they link none."""
        pairs = pairs.distinct()
        if self.tested is not None:
            pairs = pairs.join(self.tested, ["a", "b"], "left_anti")
        pairs = table(pairs)  # each stands for two texts
        self.tested = pairs if self.tested is None else self.tested.unionByName(pairs)
        found = self.verify(pairs)
        if self.anchors is None:  # the first pairs have each class once as a: its distance from b is kept
            found = table(found)
            own = found.groupBy("a").agg(F.min(F.struct("b", "distance")).alias("x")).select(F.col("a").alias("node"), F.col("x.b").alias("anchor"), "x.distance")
            others = found.select(F.col("b").alias("node")).distinct().join(own, "node", "left_anti")
            self.anchors = table(own.unionByName(others.select("node", F.col("node").alias("anchor"), F.lit(0.0).alias("distance"))))
        before, self.roots = self.roots, extend(self.roots, found.where("link").select("a", "b"))
        return self.roots is not before

    def narrow(self) -> None:
        """Puts the members that are left into the buckets of narrow bands."""
        left = table(self.members.select("node").distinct())
        texts = self.blobs.withColumnRenamed("doc_id", "node").join(left, "node", "left_semi")
        tasks = math.ceil(left.count() / NARROW_DOCS) or 1  # by number: few bytes take long here
        bands = texts.repartition(tasks, "node").mapInArrow(_with(_narrowed, self.of), "node long, n long, bands array<long>")
        self.members = cut(bands).select(F.explode("bands").alias("key"), "node", "n")

    def open(self) -> DataFrame:
        """Members of buckets that still hold several groups, with their group. Of buckets with the same members one is kept: all give the same pairs."""
        m = self.members.join(self.roots, "node", "left").select("key", "node", "n", F.coalesce("root", "node").alias("root"))
        prints = [F.bit_xor(F.xxhash64("node", F.lit(i))).alias(f"print{i}") for i in range(2)]
        several = m.groupBy("key").agg(F.min("root").alias("x"), F.max("root").alias("y"), F.count(F.lit(1)).alias("c"), *prints).where("x < y")
        several = table(several.groupBy("c", "print0", "print1").agg(F.min("key").alias("key")).select("key"))
        self.members = table(m.join(several, "key", "left_semi")).drop("root")  # buckets of one group are done
        held = self.members.join(self.roots, "node", "left").select("key", "node", "n", F.coalesce("root", "node").alias("root"))
        return held.join(self.anchors, "node", "left")


MEMBER = ("node", "n", "root", "anchor", "distance")


def _pairs(members: DataFrame, pivots: DataFrame, percent: int) -> DataFrame:
    """Each member with each p of its bucket that could be a link to another group, the greater node first.

    Sizes must fit; and as the Jaccard distance is a metric, two members whose distances from one anchor
    differ by more than a link's distance are no link. With a column keys, all keys of a member, a pair counts once.
    """
    fit = (F.col("node") != F.col("p.node")) & _sizes_fit(F.col("n"), F.col("p.n"), percent)
    if "root" in members.columns:
        apart = (F.col("anchor") == F.col("p.anchor")) & (F.abs(F.col("distance") - F.col("p.distance")) > 1 - percent / 100 + 1e-9)
        fit = fit & (F.col("root") != F.col("p.root")) & ~F.coalesce(apart, F.lit(False))
    if "keys" in members.columns:  # in the first bucket that it shares
        fit = fit & (F.array_min(F.array_intersect("keys", "p.keys")) == F.col("key"))
    joined = members.join(pivots, "key").where(fit)
    hi = F.col("node") > F.col("p.node")
    pick = lambda x, y: F.when(hi, F.col(x)).otherwise(F.col(y))
    return joined.select(pick("node", "p.node").alias("a"), pick("p.node", "node").alias("b"))


def near_duplicates(docs: DataFrame, percent: int = PERCENT) -> DataFrame:
    """doc_id, n_shingles, component_id and kept of each row of docs (doc_id long, text string).

    Shingles are 5 words, with A-Z in lower case; a link needs a similarity of `percent` hundredths or more,
    confirmed on the full sets. Documents of equal sets are one class, found by 128-bit sums of hashes, and only its first
    document is compared. Classes that share a band of the sketch are candidates. Not all pairs of a bucket
    are tried: first each class with the least class it meets most often, then one partner a bucket. Members of
    buckets that still hold several groups get a longer sketch and narrow bands, which tell similarities of
    0.7 and 0.85 well apart (other thresholds likewise); there again one partner a bucket is tried, and at last all pairs between groups that
    are left. A pair within a group can change nothing, so no link that matters is left out.

    A text without words, an empty one or null has n_shingles 0 and stays alone. Rows with one doc_id are
    one document for links; a null doc_id links to nothing and is kept. Ids are cast to long, so others than numbers are an
    error. Columns other than the two are not read. Tables that the search has written are deleted when it ends, but for
    the two that the result reads.
    """
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    with scratch(docs.sparkSession) as keep:
        return keep(_grouped(docs, percent))


def _grouped(docs: DataFrame, percent: int) -> DataFrame:
    search = _Search(docs, bands_for(percent))
    pivots = search.members.groupBy("key").agg(F.min(F.struct("node", "n")).alias("p"))
    starry = _pairs(search.members, pivots, percent).groupBy("a", "b").agg(F.count(F.lit(1)).alias("c"))
    best = starry.groupBy("a").agg(F.max(F.struct("c", (-F.col("b")).alias("minus"))).alias("x"))
    search.add(best.select("a", (-F.col("x.minus")).alias("b")))
    for turn in range(ROUNDS + 1):
        left = search.open()
        per = left.groupBy("key", "root").agg(F.count(F.lit(1)).alias("c")).groupBy("key").agg(F.sum("c").alias("n"), F.sum(F.col("c") * F.col("c")).alias("squares"), F.max(F.struct("c", "root")).alias("main"))
        todo = per.agg(F.sum("n").alias("n"), F.sum(F.col("n") * F.col("n") - F.col("squares")).alias("pairs")).first()
        if not todo.n:
            break
        strays = left.join(per.select("key", F.col("main.root").alias("main")), "key").where("root <> main")
        if turn > 0 and (turn == ROUNDS or not moved or todo.pairs <= 16 * todo.n):
            keys = left.groupBy("node").agg(F.collect_set("key").alias("keys"))  # whole keys, of buckets that are left
            search.add(_pairs(strays.join(keys, "node"), left.join(keys, "node").select("key", F.struct(*MEMBER, "keys").alias("p")), percent))
            break
        random = F.xxhash64("node", "key", F.lit(turn))
        mains = left.join(per.select("key", F.col("main.root").alias("root")), ["key", "root"]).groupBy("key").agg(F.min_by(F.struct(*MEMBER), random).alias("p"))
        moved = search.add(_pairs(strays, mains, percent))
        if turn == 0:
            search.open()  # drops the buckets that are done now
            search.narrow()
    known = (F.col("n") > 0) & F.col("doc_id").isNotNull()
    out = search.rows.drop("bands").join(search.classes, ["p", "q"], "left").withColumn("node", F.coalesce("node", "doc_id")).join(search.roots, "node", "left")
    root = F.when(known, F.coalesce("root", "node")).otherwise(F.col("doc_id"))
    return out.select("doc_id", F.col("n").alias("n_shingles"), root.alias("component_id"), F.col("doc_id").eqNullSafe(root).alias("kept"))


def op9_fast_similarity_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(read(spark, sf_dir, "documents"))

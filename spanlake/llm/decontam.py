"""Operator 2: benchmark decontamination by a prefix-filtered containment join."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from spanlake.llm.frames import fresh, read, stored
from spanlake.llm.textio import LOWER, WORD_CHARS, buffers, grams, room, rows_of, runs, signed, slices, word_hashes

#: Words in a window of an item, and words in a shingle.
WINDOW, SHINGLE = 10, 3
#: Bits of the sieve that keeps most other shingles from the join: a fixed size, whatever the data.
SIEVE_BITS = 1 << 24
#: Bytes of all results of hit texts, digests and item ids, up to which they are broadcast to the documents.
RESULT_BYTES = 4 << 20


def _words(batch: pa.RecordBatch, column: str):
    data, offsets = buffers(batch.column(column))
    starts, ends, first = runs(data, offsets, WORD_CHARS)
    return LOWER[data], starts, ends, first, word_hashes(data, starts, ends, lower=True)


def item_windows(items: DataFrame, item_id: str = "item_id", text: str = "text", window: int = WINDOW, shingle: int = SHINGLE) -> DataFrame:
    """A row for each window of each item: item_id, words (joined by a space), n_words, and its shingles' hashes with their places.

    An item of fewer words than `window` is one window; one of fewer than `shingle` words has the whole
    as its only shingle, of that many words.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, texts, sizes, keys, places = [], [], [], [], []
            data, starts, ends, first, hashes = _words(batch, "text")
            raw = data.tobytes()
            for row, item in enumerate(batch.column("item_id").to_pylist()):
                a, b = first[row], first[row + 1]
                if a == b:
                    continue
                n = min(window, b - a)
                k = min(shingle, n)
                own = grams(hashes[a:b], k).view(np.int64)
                words = [raw[starts[i] : ends[i]].decode() for i in range(a, b)]
                for at in range(b - a - n + 1):
                    ids.append(item)
                    texts.append(" ".join(words[at : at + n]))
                    sizes.append(n)
                    keys.append(own[at : at + n - k + 1].tolist())
                    places.append(list(range(n - k + 1)))
            yield pa.RecordBatch.from_arrays([pa.array(ids, batch.column("item_id").type), pa.array(texts, pa.string()), pa.array(sizes, pa.int32()), pa.array(keys, pa.list_(pa.int64())), pa.array(places, pa.list_(pa.int32()))], names=["item_id", "words", "n", "keys", "places"])

    kind = dict(items.dtypes)[item_id]
    slim = items.select(F.col(item_id).alias("item_id"), F.col(text).alias("text"))
    return slim.mapInArrow(run, f"item_id {kind}, words string, n int, keys array<long>, places array<int>")


def _sieve(shingles: DataFrame) -> np.ndarray:
    """SIEVE_BITS bits with those of the shingles' hashes set, gathered as distinct bits: 2 MB whatever the data."""
    bits = shingles.select((F.col("key").bitwiseAND(SIEVE_BITS - 1)).cast("int").alias("bit")).distinct()
    packed = bits.groupBy((F.col("bit") / 1024).cast("int").alias("block")).agg(F.collect_list((F.col("bit") % 1024).cast("short")).alias("on"))
    sieve = np.zeros(SIEVE_BITS, bool)
    for r in packed.toLocalIterator():
        sieve[r.block * 1024 + np.array(r.on, np.int64)] = True
    return sieve


def contaminated(docs: DataFrame, items: DataFrame, doc_id: str = "doc_id", text: str = "text", item_id: str = "item_id", item_text: str = "text", window: int = WINDOW, shingle: int = SHINGLE) -> DataFrame:
    """n_words, n_hit, n_items, item_ids (sorted as strings) and contaminated of each document row.

    A window of an item occurs where its words stand in a row in a document; all its shingles are then
    there, so its rarest one over the whole corpus is. Steps: count the items' shingles in all documents,
    take from each window its rarest as the prefix that a match needs, join documents to windows on it,
    keep places where the window fits the document (place and length), and compare the words themselves.

    Rows of equal text are looked at together; each row gets the result. Null and empty texts have no
    words; items without words, and an empty items table, hit nothing. Null item ids are left out of
    item_ids and n_items, but their words count. Items with one id count once. The columns of docs stay
    but for those of the same names.
    """
    made = ("n_words", "n_hit", "n_items", "item_ids", "contaminated")
    spark = docs.sparkSession
    windows = item_windows(items, item_id, item_text, window, shingle)
    listed = windows.select("item_id", "words", "n", F.explode(F.arrays_zip("keys", "places")).alias("s")).select("item_id", "words", "n", F.col("s.keys").alias("key"), F.col("s.places").alias("place"))
    shingles = listed.select("key", F.least("n", F.lit(shingle)).alias("k")).distinct()
    by_size = {k: _sieve(shingles.where(F.col("k") == k)) for k in sorted(r.k for r in shingles.select("k").distinct().toLocalIterator())}  # shingle sizes at most
    sieves = spark.sparkContext.broadcast({k: np.packbits(v) for k, v in by_size.items()})
    (key,) = fresh(docs, "key")
    keyed = docs.withColumn(key, F.sha2(F.coalesce(F.col(text), F.lit("")), 256))

    def seen(batch: pa.RecordBatch):
        """Each place of a shingle that the sieve lets through."""
        data, starts, ends, first, hashes = _words(batch, "text")
        left, row = room(first), rows_of(first)
        for k, packed in sieves.value.items():
            h = grams(hashes, k)
            at = (h & np.uint64(SIEVE_BITS - 1)).astype(np.int64)
            on = np.flatnonzero(((packed[at >> 3] >> (7 - (at & 7)).astype(np.uint8)) & 1).astype(bool) & (left[: len(h)] >= k))
            yield k, h, on, row, first, data, starts, ends

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch):
                for k, h, on, *_ in seen(part):
                    keys, n = np.unique(h[on], return_counts=True)
                    yield pa.RecordBatch.from_arrays([signed(keys), pa.array(np.full(len(keys), k), pa.int32()), pa.array(n, pa.int64())], names=["key", "k", "n"])

    slim = docs.select(F.coalesce(F.col(text), F.lit("")).alias("text"))
    counts = slim.mapInArrow(counted, "key long, k int, n long").groupBy("key", "k").agg(F.sum("n").alias("seen"))
    seen_in_docs = F.coalesce("seen", F.lit(0))
    order = Window.partitionBy("words", "n").orderBy("seen", "key", "place")
    ranked = listed.drop("item_id").distinct().withColumn("k", F.least("n", F.lit(shingle))).join(counts, ["key", "k"], "left").withColumn("seen", seen_in_docs)
    spots = ranked.withColumn("rank", F.row_number().over(order)).where("rank = 1 AND seen > 0").select("key", "k", "place", "n", "words")  # the rarest is in no document: nor is the window

    def placed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Each shingle in the sieve, with the words around it that a window could cover."""
        for batch in batches:
            for part in slices(batch):
                texts = part.column("key").to_pylist()
                out = [[], [], [], [], [], []]
                for k, h, on, row, first, data, starts, ends in seen(part):
                    raw = data.tobytes()
                    reach = window - k
                    for i, key_ in zip(on.tolist(), h[on].view(np.int64).tolist(), strict=True):
                        r = row[i]
                        a, b = max(first[r], i - reach), min(first[r + 1], i + k + reach)
                        around = " ".join([raw[starts[j] : ends[j]].decode() for j in range(a, b)])
                        for column, value in zip(out, (key_, k, texts[r], i - first[r], i - a, around), strict=True):
                            column.append(value)
                kinds = (pa.int64(), pa.int32(), pa.string(), pa.int64(), pa.int32(), pa.string())
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(out, kinds, strict=True)], names=["key", "k", "doc", "at", "before", "around"])

    slim = keyed.select(F.col(key).alias("key"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    places = slim.mapInArrow(placed, "key long, k int, doc string, at long, before int, around string").dropDuplicates(["doc", "at", "k"])
    near = F.split("around", " ")
    fits = (F.col("place") <= F.col("before")) & (F.col("before") - F.col("place") + F.col("n") <= F.size(near))
    same = F.concat_ws(" ", F.slice(near, F.col("before") - F.col("place") + 1, F.col("n"))) == F.col("words")
    hits = places.join(spots, ["key", "k"]).where(fits).where(same).select("doc", (F.col("at") - F.col("place")).alias("a"), "n", "words")
    owners = windows.select("words", "n", "item_id").distinct()
    per_item = hits.select("doc", "words", "n").distinct().join(owners, ["words", "n"]).where(F.col("item_id").isNotNull()).groupBy("doc").agg(F.array_sort(F.collect_set(F.col("item_id").cast("string"))).alias("items"))
    spans = hits.select("doc", "a", (F.col("a") + F.col("n")).alias("b")).groupBy("doc", "a").agg(F.max("b").alias("b"))
    reach = F.max("b").over(Window.partitionBy("doc").orderBy("a").rowsBetween(Window.unboundedPreceding, -1))
    covered = spans.withColumn("c", F.greatest(F.col("b") - F.greatest(F.col("a"), F.coalesce(reach, F.lit(0).cast("long"))), F.lit(0).cast("long"))).groupBy("doc").agg(F.sum("c").alias("hit"))
    result = stored(covered.join(per_item, "doc", "left").withColumnRenamed("doc", key))  # so that copies of one text are joined, not grouped
    held = result.agg(F.sum(F.lit(128) + F.coalesce(F.octet_length(F.concat_ws(",", "items")), F.lit(0)))).first()[0] or 0
    result = F.broadcast(result) if held <= RESULT_BYTES else result

    keep = [c for c in docs.columns if c.lower() not in made]
    total = F.size(F.filter(F.split(F.coalesce(F.col(text), F.lit("")), r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"), lambda w: w != "")).cast("long")
    out = keyed.select(*keep, key, total.alias("n_words")).join(result, key, "left")
    none = F.array().cast("array<string>")
    n_hit = F.coalesce("hit", F.lit(0).cast("long"))
    return out.select(*keep, "n_words", n_hit.alias("n_hit"), F.size(F.coalesce("items", none)).cast("long").alias("n_items"), F.coalesce("items", none).alias("item_ids"), (n_hit > 0).alias("contaminated"))


def op2_prefix_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    found = contaminated(docs, read(spark, sf_dir, "benchmark"))
    return found.select("doc_id", "n_words", "n_hit", "n_items", F.sha2(F.concat_ws(",", "item_ids"), 256).alias("items_sha256"), "contaminated")

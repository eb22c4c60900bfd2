"""Operator 5: removal of repeated passages with compressed FM-indexes over content-defined shards."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from spanlake.llm.fmindex import FMIndex
from spanlake.llm.frames import cut, read
from spanlake.llm.textio import NOT_SPACE, buffers, grams, mix, room, rows_of, runs, signed, slices, word_hashes

#: Words in a window, and in the n-grams whose least hash in a window is the window's key.
WINDOW, KEY_WORDS = 13, 5
#: Most windows in a segment (their removal is a bit mask), words in an index, and segments of one key in it.
RUN, SHARD_WORDS, KEY_SEGMENTS = 32, 100_000, 20_000
_NONE = (1 << 63) - 1
#: Keys and contents have 48 bits: 96 together tell segments apart, and a shuffle carries fewer random bytes.
_SPARE = np.uint64(16)
#: Bits of a place in a text; above them stand MARK_BITS bits of the text's hash, for rows that share a doc_id.
PLACE_BITS, MARK_BITS = 40, 20


class Segments:
    """The segments of all rows of a slice: runs of windows with one key, and all words these windows cover.

    Equal windows have equal keys wherever they stand, so they meet under that key.
    """

    def __init__(self, column: pa.Array, window: int = WINDOW, key_words: int = KEY_WORDS):
        self.data, offsets = buffers(column)
        self.starts, self.ends, self.first = runs(self.data, offsets, NOT_SPACE)
        hashes = word_hashes(self.data, self.starts, self.ends, lower=False)
        n = max(0, len(hashes) - window + 1)
        least = np.empty(0, np.uint64)
        if n:
            keys = grams(hashes, key_words)
            least = keys[:n].copy()
            for j in range(1, window - key_words + 1):
                np.minimum(least, keys[j : j + n], out=least)
        row = rows_of(self.first)[:n]
        inside = room(self.first)[:n] >= window
        same = np.zeros(n, bool)
        same[1:] = inside[1:] & inside[:-1] & (least[1:] == least[:-1]) & (row[1:] == row[:-1])
        head = np.flatnonzero(inside & ~same)
        run = np.zeros(n, np.int64)
        if len(head):
            run[head] = np.diff(np.concatenate(([0], head)))
            run = np.arange(n) - np.cumsum(run)
        head = np.flatnonzero(inside & (run % RUN == 0)) if n else head  # a long run is cut, always at the same distance from its start
        last = np.flatnonzero(inside & np.concatenate(((run[1:] % RUN == 0) | ~inside[1:], [True]))) if n else head
        self.key, self.row, self.at, self.size = least[head] >> _SPARE, row[head], head - self.first[row[head]], last - head + window
        self.head = head

    def contents(self, i: np.ndarray) -> np.ndarray:
        """Hashes of the words of segments, apart from their keys'."""
        other = word_hashes(self.data, self.starts, self.ends, lower=False, seed=2)
        out, head, size = np.zeros(len(i), np.uint64), self.head[i], self.size[i]
        for j in range(int(size.max(initial=0))):
            on = np.flatnonzero(size > j)
            out[on] = mix(out[on] ^ other[head[on] + j])
        return out >> _SPARE

    def words(self, i: int) -> bytes:
        a, b = self.head[i], self.head[i] + self.size[i]
        return b" ".join(self.data[self.starts[a] : self.ends[b - 1]].tobytes().split())


def _keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Each key of each row once."""
    for batch in batches:
        for part in slices(batch):
            s = Segments(part.column("text"))
            order = np.lexsort((s.key, s.row))
            key, row = s.key[order], s.row[order]
            new = np.ones(len(key), bool)
            new[1:] = (key[1:] != key[:-1]) | (row[1:] != row[:-1])
            yield pa.RecordBatch.from_arrays([signed(key[new]), part.column("doc_id").take(pa.array(row[new]))], names=["key", "doc_id"])


def _packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    codec = pa.Codec("zstd", 3)
    for batch in batches:
        raw = [x.as_buffer() if x.is_valid else pa.py_buffer(b"") for x in batch.column("text")]
        yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("mark"), pa.array([len(x) for x in raw], pa.int64()), pa.array([codec.compress(x, asbytes=True) for x in raw], pa.binary())], names=["doc_id", "mark", "size", "blob"])


def _unpacked(batch: pa.RecordBatch, rows: int = 400) -> Iterator[tuple[pa.RecordBatch, pa.Array]]:
    """Slices of a batch with their texts."""
    codec = pa.Codec("zstd", 3)
    batch = batch.filter(pc.is_valid(batch.column("keys")))  # others have nothing to look for
    for a in range(0, batch.num_rows, rows):
        part = batch.slice(a, rows)
        texts = [codec.decompress(b.as_buffer(), n, asbytes=True) for b, n in zip(part.column("blob"), part.column("size").to_pylist(), strict=True)]
        at = np.concatenate(([0], np.cumsum([len(t) for t in texts], dtype=np.int64)))
        yield part, pa.Array.from_buffers(pa.large_string(), len(texts), [None, pa.py_buffer(at), pa.py_buffer(b"".join(texts))])


def _tag(key: np.ndarray, row: np.ndarray, content: np.ndarray | None = None) -> np.ndarray:
    tag = mix(key ^ mix(row.astype(np.uint64)))
    return tag if content is None else mix(tag ^ content)


def _wanted(part: pa.RecordBatch, s: Segments) -> np.ndarray:
    """The segments of a slice whose keys the row's list has."""
    lists = part.column("keys")
    flat = lists.flatten().to_numpy().view(np.uint64)
    row = np.repeat(np.arange(part.num_rows), lists.value_lengths().fill_null(0).to_numpy())
    return np.flatnonzero(np.isin(_tag(s.key, s.row), _tag(flat, row)))


def _placed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Key, content hash and place of each segment whose key other documents have too."""
    for batch in batches:
        for part, texts in _unpacked(batch):
            s = Segments(texts)
            i = _wanted(part, s)
            marks = part.column("mark").to_numpy().astype(np.int64)[s.row[i]] << PLACE_BITS
            yield pa.RecordBatch.from_arrays([signed(s.key[i]), signed(s.contents(i)), part.column("doc_id").take(pa.array(s.row[i])), pa.array(marks | s.at[i], pa.int64())], names=["key", "content", "doc_id", "place"])


def _written(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The words of the segments for which the row is the first document (keys, contents: pairs that it was first with)."""
    for batch in batches:
        for part, texts in _unpacked(batch):
            s = Segments(texts)
            i = _wanted(part, s)
            contents = s.contents(i)
            lists = part.column("keys")
            row = np.repeat(np.arange(part.num_rows), lists.value_lengths().fill_null(0).to_numpy())
            asked = _tag(lists.flatten().to_numpy().view(np.uint64), row, part.column("contents").flatten().to_numpy().view(np.uint64))
            mine = np.isin(_tag(s.key[i], s.row[i], contents), asked)  # a row may hold another row's segment of a key that it was asked for
            i, contents = i[mine], contents[mine]
            _, once = np.unique(mix(contents) ^ s.key[i], return_index=True)
            once.sort()
            i, contents = i[once], contents[once]
            yield pa.RecordBatch.from_arrays([signed(s.key[i]), signed(contents), part.column("doc_id").take(pa.array(s.row[i])), pa.array([s.words(j) for j in i.tolist()], pa.binary())], names=["key", "content", "owner", "words"])


def search_shards(batches: Iterator[pa.RecordBatch], window: int = WINDOW, limit: int = SHARD_WORDS) -> Iterator[pa.RecordBatch]:
    """Segments sorted by key in, the least owner of each of their windows out.

    Keys that follow each other make a shard of about `limit` words. Its segments are indexed and then
    streamed through the index by backward search. A shard ends at a key's end, so equal windows are in one.
    """
    held: list[pa.RecordBatch] = []
    words = 0

    def shard(rows: pa.Table) -> Iterator[pa.RecordBatch]:
        rows = rows.combine_chunks()
        column = rows.column("words").combine_chunks()
        text = column.cast(pa.large_binary())
        at = np.frombuffer(text.buffers()[1], np.int64)[text.offset : text.offset + len(text) + 1]
        data = np.frombuffer(text.buffers()[2], np.uint8)[at[0] : at[-1]]
        starts, ends, first = runs(data, at - at[0], NOT_SPACE)
        _, symbol = np.unique(word_hashes(data, starts, ends, lower=False), return_inverse=True)
        symbol, row = symbol + 1, rows_of(first)
        spread = np.zeros(len(symbol) + len(column), np.int64)
        spread[np.arange(len(symbol)) + row] = symbol
        owner = rows.column("owner").to_numpy()
        index = FMIndex(spread, np.repeat(owner, np.diff(first) + 1), int(symbol.max(initial=0)) + 1, window)
        least = index.least_owner(symbol, first, _NONE)
        keep = np.flatnonzero(room(first) >= window)
        sizes = np.bincount(row[keep], minlength=len(column))
        owners = pa.ListArray.from_arrays(pa.array(np.concatenate(([0], np.cumsum(sizes))), pa.int32()), pa.array(least[keep]))
        edges = np.searchsorted(row[keep], np.arange(len(column)))  # each segment has a window
        bounds = [pa.array(f.reduceat(least[keep], edges)) for f in (np.minimum, np.maximum)]
        yield pa.RecordBatch.from_arrays([rows.column("key").combine_chunks(), rows.column("content").combine_chunks(), *bounds, owners], names=["key", "content", "lo", "hi", "owners"])

    for batch in batches:
        if not batch.num_rows:
            continue
        keys = batch.column("key").to_numpy()
        size = np.cumsum(pc.binary_length(batch.column("words")).to_numpy() // 6 + 1)  # about the words
        a = 0
        new = np.flatnonzero(np.concatenate(([bool(held) and held[-1].column("key")[-1].as_py() != keys[0]], keys[1:] != keys[:-1])))
        for cut in new.tolist():
            if words + (size[cut - 1] if cut else 0) - (size[a - 1] if a else 0) >= limit:
                held.append(batch.slice(a, cut - a))
                yield from shard(pa.Table.from_batches([x for x in held if x.num_rows]))
                held, words, a = [], 0, cut
        held.append(batch.slice(a))
        words += int(size[-1] - (size[a - 1] if a else 0))
    if held:
        yield from shard(pa.Table.from_batches([x for x in held if x.num_rows]))


def _windows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Each window of a segment as a segment of its own, under a key of all its words."""
    for batch in batches:
        out = [[], [], [], [], [], []]
        for key, content, owner, words in zip(*(batch.column(c).to_pylist() for c in ("key", "content", "owner", "words")), strict=True):
            w = words.split(b" ")
            for j in range(len(w) - WINDOW + 1):
                own = b" ".join(w[j : j + WINDOW])
                part = int.from_bytes(hashlib.blake2b(own, digest_size=8).digest(), "little", signed=True)
                for c, v in zip(out, (key, content, j, part, owner, own), strict=True):
                    c.append(v)
        kinds = (pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.binary())
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(out, kinds, strict=True)], names=["key", "content", "j", "part", "owner", "words"])


def _searched(segments: DataFrame) -> DataFrame:
    """The least owner of each window of each segment (key, content, owner, words)."""
    return segments.repartition("key").sortWithinPartitions("key").mapInArrow(search_shards, "key long, content long, lo long, hi long, owners array<long>")


def window_owners(segments: DataFrame) -> DataFrame:
    """The same for segments of keys with too many for one index: each window is a segment under a key of its own words."""
    windows = segments.mapInArrow(_windows, "key long, content long, j int, part long, owner long, words binary")
    single = windows.groupBy("part", "words").agg(F.min("owner").alias("owner")).select(F.col("part").alias("key"), F.col("part").alias("content"), "owner", "words")
    found = _searched(single).select(F.col("key").alias("part"), F.element_at("owners", 1).alias("owner"))
    split = windows.select("key", "content", "j", "part").distinct().join(found, "part").groupBy("key", "content").agg(F.array_sort(F.collect_list(F.struct("j", "owner"))).alias("x"))
    return split.select("key", "content", F.array_min("x.owner").alias("lo"), F.array_max("x.owner").alias("hi"), F.col("x.owner").alias("owners"))


def _kept(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Removes the covered words: doc_id, n_words, n_removed and the kept words."""
    codec = pa.Codec("zstd", 3)
    low = (1 << PLACE_BITS) - 1
    for batch in batches:
        spots, marks = batch.column("spots"), batch.column("mark").to_pylist()
        totals, removed, texts = [], [], []
        for i, (blob, size) in enumerate(zip(batch.column("blob"), batch.column("size").to_pylist(), strict=True)):
            words = codec.decompress(blob.as_buffer(), size, asbytes=True).split()
            totals.append(len(words))
            if spots[i].is_valid:
                place, mask = (spots[i].values.field(f).to_numpy() for f in ("place", "mask"))
                mine = place >> PLACE_BITS == marks[i]
                place, mask = place[mine] & low, mask[mine]
                edge = np.zeros(len(words) + WINDOW + RUN + 1, np.int64)
                for j in range(RUN):
                    at = place[(mask >> j) & 1 == 1] + j
                    if len(at):
                        np.add.at(edge, at, 1)
                        np.add.at(edge, at + WINDOW, -1)
                stays = np.flatnonzero(np.cumsum(edge)[: len(words)] == 0)
                words = [words[k] for k in stays.tolist()]
            removed.append(totals[-1] - len(words))
            texts.append(b" ".join(words).decode())
        yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(totals, pa.int64()), pa.array(removed, pa.int64()), pa.array(texts, pa.large_string()).cast(pa.string())], names=["doc_id", "n_words", "n_removed", "kept_text"])


def remove_repeats(docs: DataFrame, most: int = KEY_SEGMENTS) -> DataFrame:
    """doc_id, n_words, n_removed and kept_text (kept words joined by a space) of each row of docs (doc_id, text).

    A word goes if a window of 13 words over it also starts in a document with a smaller doc_id. Windows meet
    under a key, the least hash of their 5-grams; runs of windows with one key are segments. Keys that
    only one document has need no search. Of the others each distinct segment is indexed once, with its
    least document, in FM-index shards of neighbouring keys; backward search gives each window the least
    document that has it. So a passage that a third of all documents share is one segment in one index.

    A null or empty text has no words. A null doc_id is neither smaller nor larger than others: its row stays whole
    and removes nothing. Rows with one doc_id remove nothing from each other. Ids are cast to long, so others than numbers
    are an error. Other columns are not read.
    """
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    known = docs.where("doc_id IS NOT NULL AND text IS NOT NULL")
    keys = known.mapInArrow(_keys, "key long, doc_id long")
    shared = keys.groupBy("key").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("key")
    per_doc = cut(keys.join(shared, "key", "left_semi").groupBy("doc_id").agg(F.collect_set("key").alias("keys")))
    mark = F.pmod(F.xxhash64("text"), F.lit(1 << MARK_BITS)).cast("int").alias("mark")
    blobs = docs.select("doc_id", mark, "text").mapInArrow(_packed, "doc_id long, mark int, size long, blob binary")
    placed = blobs.join(per_doc, "doc_id", "left").select("doc_id", "mark", "size", "blob", "keys").mapInArrow(_placed, "key long, content long, doc_id long, place long")
    firsts = placed.groupBy("key", "content").agg(F.min("doc_id").alias("doc_id"))
    flagged = firsts.withColumn("hot", F.count(F.lit(1)).over(Window.partitionBy("key")) > most)

    def written(which: DataFrame) -> DataFrame:
        asked = which.groupBy("doc_id").agg(F.collect_list(F.struct("key", "content")).alias("pairs")).select("doc_id", F.col("pairs.key").alias("keys"), F.col("pairs.content").alias("contents"))
        return blobs.join(asked, "doc_id", "left").select("doc_id", "mark", "size", "blob", "keys", "contents").mapInArrow(_written, "key long, content long, owner long, words binary")

    owners = _searched(written(flagged.where("NOT hot"))).unionByName(window_owners(written(flagged.where("hot"))))
    earlier = F.transform("owners", lambda o, j: F.when(o < F.col("doc_id"), F.call_function("shiftleft", F.lit(1).cast("long"), j)).otherwise(F.lit(0).cast("long")))
    each = F.aggregate(earlier, F.lit(0).cast("long"), lambda x, y: x + y)
    all_ = F.call_function("shiftleft", F.lit(1).cast("long"), F.size("owners")) - 1
    mask = F.when(F.col("hi") < F.col("doc_id"), all_).when(F.col("lo") >= F.col("doc_id"), F.lit(0).cast("long")).otherwise(each)
    spots = placed.join(owners, ["key", "content"]).select("doc_id", "place", mask.alias("mask")).where("mask <> 0")
    per_row = spots.groupBy("doc_id").agg(F.collect_set(F.struct("place", "mask")).alias("spots"))
    return blobs.join(per_row, "doc_id", "left").select("doc_id", "mark", "size", "blob", "spots").mapInArrow(_kept, "doc_id long, n_words long, n_removed long, kept_text string")


def op5_fm_index_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = remove_repeats(read(spark, sf_dir, "documents"))
    return out.select("doc_id", "n_words", "n_removed", F.sha2("kept_text", 256).alias("kept_sha256"))

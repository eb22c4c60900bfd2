"""Operator 7: byte-level BPE encoding and decoding."""

from __future__ import annotations

import base64
import functools
import hashlib
import json
import os
from collections.abc import Iterator, Sequence
from itertools import chain, pairwise

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from spanlake.llm.frames import read
from spanlake.llm.textio import places, resident, slices

VOCABULARY = "byte_bpe_multi_50k.tiktoken"
#: Words whose ids a task keeps; with so many new ones, those not met since the last turn are forgotten.
KEEP = 60_000
#: A longer run of one kind is encoded anew in each slice, not kept.
LONGEST = 64


def byte_to_char() -> list[str]:
    """The printable character that stands for each byte: itself, or the next from U+0100 on."""
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    hidden = [b for b in range(256) if b not in set(shown)]
    table = {b: chr(b) for b in shown} | {b: chr(0x100 + i) for i, b in enumerate(hidden)}
    return [table[b] for b in range(256)]


def read_ranks(path: str) -> dict[bytes, int]:
    """Token bytes and ranks of a vocabulary file with a base64 token and a rank a line."""
    with open(path, "rb") as lines:
        return {base64.b64decode(token): int(rank) for token, rank in (line.split() for line in lines if line.strip())}


def tokenizer_json(ranks: dict[bytes, int]) -> str:
    """A `tokenizers` BPE model that merges as the ranks do.

    A merge joins any two neighbours whose bytes together are a token, the lowest rank first; so every
    split of a token into two tokens is a merge, in the order of ranks, of one token the longest left
    part first. A whole word that is a token is taken as it is.
    """
    chars = byte_to_char()
    shown = {token: "".join(chars[b] for b in token) for token in ranks}
    merges = [[shown[t[:i]], shown[t[i:]]] for t in sorted(ranks, key=ranks.get) for i in range(len(t) - 1, 0, -1) if t[:i] in ranks and t[i:] in ranks]
    model = {"type": "BPE", "dropout": None, "unk_token": None, "continuing_subword_prefix": None, "end_of_word_suffix": None, "fuse_unk": False, "byte_fallback": False, "ignore_merges": True, "vocab": {shown[t]: r for t, r in ranks.items()}, "merges": merges}
    return json.dumps({"version": "1.0", "truncation": None, "padding": None, "added_tokens": [], "normalizer": None, "pre_tokenizer": None, "post_processor": None, "decoder": None, "model": model})


@functools.lru_cache(2)
def _driver_model(path: str) -> tuple[str, dict[bytes, int]]:
    ranks = read_ranks(path)
    return tokenizer_json(ranks), ranks


class Pieces:
    """A table of byte strings, to be laid end to end by their numbers."""

    def __init__(self, pieces: Sequence[bytes]):
        self.data = np.frombuffer(b"".join(pieces), np.uint8)
        self.sizes = np.array([len(x) for x in pieces], np.int64)
        self.starts = np.cumsum(self.sizes) - self.sizes

    def joined(self, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The bytes of the pieces, and where each starts, with the end."""
        sizes = self.sizes[ids]
        return self.data[places(self.starts[ids], sizes)], np.concatenate(([0], np.cumsum(sizes)))


class Codec:
    """Encodes and decodes texts: words by a pattern, bytes by a table, merges by the `tokenizers` library."""

    def __init__(self, model: str, pattern: str, keep: int = KEEP):
        import regex

        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark gives each task its core
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_str(model)
        self.words = regex.compile(pattern).findall
        chars = byte_to_char()
        to_byte = {c: b for b, c in enumerate(chars)}
        self.by_latin = dict(enumerate(chars))
        ids = self.tokenizer.get_vocab()
        known = {i: bytes(to_byte[c] for c in t) for t, i in ids.items()}
        size = max(known, default=-1) + 1
        self.token_bytes = Pieces([known.get(i, b"") for i in range(size)])
        self.decimals = Pieces([b"%d," % i for i in range(size)])
        self.numbers = list(range(size))  # so that kept ids share them
        self.keep = keep
        self.known: dict[str, tuple[int, ...]] = {}
        self.older: dict[str, tuple[int, ...]] = {}

    def mapped(self, word: str) -> str:
        """The word's bytes as the characters that stand for them."""
        return word.encode("utf-8").decode("latin-1").translate(self.by_latin)

    def lookup(self, words: list[str]) -> list[tuple[int, ...]]:
        """The ids of each of some distinct words; what is met for the first time is encoded once."""
        new = [w for w in words if w not in self.known]
        kept = {w: self.older[w] for w in new if w in self.older}
        new = [w for w in new if w not in kept]
        made = self.tokenizer.encode_batch_fast([self.mapped(w) for w in new], add_special_tokens=False)
        self.known.update(kept)
        self.known.update((w, tuple(map(self.numbers.__getitem__, x.ids))) for w, x in zip(new, made, strict=True))
        out = [self.known[w] for w in words]
        for w in new:
            if len(w) > LONGEST:
                del self.known[w]
        if len(self.known) > self.keep:
            self.older, self.known = self.known, {}
        return out

    def encode_batch(self, texts: Sequence[str | None]) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all texts end to end, and where those of each start, with the end."""
        found = [self.words(t) if t else [] for t in texts]
        coded = pa.array(list(chain.from_iterable(found)), pa.large_string()).dictionary_encode()
        lists = self.lookup(coded.dictionary.to_pylist())
        sizes = np.fromiter(map(len, lists), np.int64, len(lists))
        flat = np.fromiter(chain.from_iterable(lists), np.int32, int(sizes.sum()))
        at = coded.indices.to_numpy(zero_copy_only=False)
        starts, sizes = (np.cumsum(sizes) - sizes)[at], sizes[at]
        first = np.cumsum([0, *map(len, found)])
        return flat[places(starts, sizes)], np.concatenate(([0], np.cumsum(sizes)))[first]

    def encode(self, text: str | None) -> list[int]:
        return self.encode_batch([text])[0].tolist()

    def offsets_batch(self, ids: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """For each token the code points of its text that it touches, start and end: a character cut between tokens belongs to each."""
        data, at = self.token_bytes.joined(ids)
        points = np.concatenate(([0], np.cumsum((data & 0xC0) != 0x80)))  # begun before each byte
        base = np.repeat(points[at[first[:-1]]], np.diff(first))
        return points[at[:-1] + 1] - 1 - base, points[at[1:]] - base

    def offsets(self, text: str | None) -> list[tuple[int, int]]:
        ids, first = self.encode_batch([text])
        return list(zip(*(x.tolist() for x in self.offsets_batch(ids, first)), strict=True))

    def decode(self, ids: Sequence[int]) -> bytes:
        """The bytes of the ids; characters that tokens split are whole again."""
        return self.token_bytes.joined(np.asarray(ids, np.int64))[0].tobytes()


def _codec(model: str, pattern: str) -> Codec:
    return resident(f"codec {hashlib.sha256((pattern + model).encode()).hexdigest()}", lambda: Codec(model, pattern))


def _bounds(first: np.ndarray) -> pa.Array:
    return pa.array(first, pa.int32())


def _pass(docs: DataFrame, made: Sequence[str]) -> tuple[DataFrame, list[str], str]:
    """docs without columns of the names that are made, those left, and their schema."""
    keep = [c for c in docs.columns if c.lower() not in {m.lower() for m in made}]
    slim = docs.select(*keep)
    return slim, keep, "".join(f"`{f.name}` {f.dataType.simpleString()}, " for f in slim.schema.fields)


def encode(docs: DataFrame, vocabulary: str, pattern: str, text: str = "text", ids: str = "ids", offsets: str | None = None) -> DataFrame:
    """Adds the token ids of each whole text as an array of int (null or empty text: empty array).

    With `offsets`, a column of that name has for each token the code points that it touches, start and end (exclusive).
    `vocabulary` is a path the driver can read; the model (as large as the vocabulary, whatever the
    data) goes to the tasks as a broadcast variable. All rows, repeated ones too, and other columns stay; columns of
    the names added are replaced.
    """
    model = docs.sparkSession.sparkContext.broadcast(_driver_model(vocabulary)[0])
    made = [ids, *([offsets] if offsets else [])]
    slim, keep, schema = _pass(docs, made)
    at = [c.lower() for c in keep].index(text.lower())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = _codec(model.value, pattern)
        for batch in batches:
            for part in slices(batch, keep[at]):
                flat, first = codec.encode_batch(part.column(at).to_pylist())
                lists = [pa.ListArray.from_arrays(_bounds(first), pa.array(flat))]
                if offsets:
                    both = [pa.array(x.astype(np.int32)) for x in codec.offsets_batch(flat, first)]
                    lists.append(pa.ListArray.from_arrays(_bounds(first), pa.StructArray.from_arrays(both, ["start", "end"])))
                yield pa.RecordBatch.from_arrays([*part.columns, *lists], names=[*keep, *made])

    return slim.mapInArrow(run, f"{schema}`{ids}` array<int>" + (f", `{offsets}` array<struct<start: int, end: int>>" if offsets else ""))


def decode(rows: DataFrame, vocabulary: str, pattern: str, ids: str = "ids", out: str = "decoded") -> DataFrame:
    """Adds the bytes of each row's ids as a binary column (null ids: null). A column named `out` is replaced."""
    model = rows.sparkSession.sparkContext.broadcast(_driver_model(vocabulary)[0])
    slim, keep, schema = _pass(rows, [out])
    at = [c.lower() for c in keep].index(ids.lower())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = _codec(model.value, pattern)
        for batch in batches:
            for part in (batch.slice(a, 100) for a in range(0, batch.num_rows, 100)):
                found = [None if x is None else codec.decode(x) for x in part.column(at).to_pylist()]
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array(found, pa.binary())], names=[*keep, out])

    return slim.mapInArrow(run, f"{schema}`{out}` binary")


def round_trip(docs: DataFrame, vocabulary: str, pattern: str, text: str = "text", keep_ids: bool = False) -> DataFrame:
    """All rows and columns, with n_tokens, ids_sha256 and decoded_sha256 of each whole text (null: empty).

    The ids themselves leave the task only with keep_ids, as an array column `ids`. Columns of these names are replaced.
    """
    model = docs.sparkSession.sparkContext.broadcast(_driver_model(vocabulary)[0])
    made = ("n_tokens", "ids_sha256", "decoded_sha256", *(["ids"] if keep_ids else []))
    slim, keep, schema = _pass(docs, made)
    at = [c.lower() for c in keep].index(text.lower())
    digests = lambda data, cuts, less: pa.array([hashlib.sha256(data[a : max(a, b - less)]).hexdigest() for a, b in pairwise(cuts.tolist())], pa.string())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = _codec(model.value, pattern)
        for batch in batches:
            for part in slices(batch, keep[at]):
                flat, first = codec.encode_batch(part.column(at).to_pylist())
                shown, ends = codec.decimals.joined(flat)
                decoded, cuts = codec.token_bytes.joined(flat)
                lists = [pa.ListArray.from_arrays(_bounds(first), pa.array(flat))] if keep_ids else []
                columns = [pa.array(np.diff(first), pa.int64()), digests(shown, ends[first], 1), digests(decoded, cuts[first], 0)]
                yield pa.RecordBatch.from_arrays([*part.columns, *columns, *lists], names=[*keep, *made])

    return slim.mapInArrow(run, f"{schema}n_tokens long, ids_sha256 string, decoded_sha256 string" + (", ids array<int>" if keep_ids else ""))


def op7_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    return round_trip(docs, public_tokenizers.path(VOCABULARY), public_tokenizers.PATTERN).select("doc_id", "n_tokens", "ids_sha256", "decoded_sha256")


__all__ = ["Codec", "Pieces", "byte_to_char", "decode", "encode", "op7_byte_bpe", "read_ranks", "round_trip", "tokenizer_json"]

"""Operator 3: language identification with hyperdimensional profiles."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from spanlake.llm.frames import fresh, read
from spanlake.llm.textio import mix, resident

#: Length of the vectors, letters in an n-gram, and most n-gram vectors that a task keeps.
DIM, N, KEEP = 1024, 3, 40_000
#: N-gram vectors that are bundled at once.
STEP = 4096
#: Bytes of n-grams that a task holds before it sums them, of one language and of all.
LANGUAGE_BYTES, HELD_BYTES = 16 << 20, 64 << 20
#: Most languages a model has, those with the most labelled texts: it bounds the prototypes, DIM numbers a language.
MAX_LANGS = 2000
UNKNOWN = "und"
_BITS = 21  # a code point
_CLASS = np.zeros(0x110000, np.uint32)


def _letters() -> np.ndarray:
    """For each code point its lower-case letter; 32, a space, for what is no letter."""
    if not _CLASS[97]:
        _CLASS[:] = 32
        for c in range(0x110000):
            if not 0xD800 <= c < 0xE000 and (x := chr(c)).isalpha():
                low = x.lower()
                _CLASS[c] = ord(low) if len(low) == 1 else c
    return _CLASS


def ngrams(text: str | None, n: int = N) -> tuple[np.ndarray, np.ndarray]:
    """The n-grams of a whole text as numbers, and how often each occurs; words are padded by one space."""
    if not text:
        return np.empty(0, np.uint64), np.empty(0, np.int64)
    codes = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)
    x = np.concatenate(([32], _letters()[codes], [32])).astype(np.uint64)
    letter = x != 32
    x = x[letter | np.concatenate(([True], letter[:-1]))]  # runs of others become one space
    if len(x) < n or not letter.any():
        return np.empty(0, np.uint64), np.empty(0, np.int64)
    keys = x[: len(x) - n + 1].copy()
    for j in range(1, n):
        keys = (keys << np.uint64(_BITS)) | x[j : j + len(keys)]
    return np.unique(keys, return_counts=True)


class GramVectors:
    """Vectors of n-grams: the product of each letter's random signs, permuted by its place.

    A letter's signs come from a hash of its code point, so every task has the same vectors and a letter
    that training never saw has one too.
    """

    def __init__(self, dim: int = DIM, n: int = N, keep: int = KEEP):
        self.dim, self.n, self.keep = dim, n, keep
        self.rows: dict[int, int] = {}
        self.table = np.empty((0, dim), np.int8)

    def letter(self, code: int) -> np.ndarray:
        words = mix(np.arange(self.dim // 64 + 1, dtype=np.uint64) + np.uint64(code << 20))
        return np.unpackbits(words.view(np.uint8))[: self.dim].astype(np.float32) * 2 - 1

    def bind(self, key: int) -> np.ndarray:
        out = np.ones(self.dim, np.float32)
        for place in range(self.n):
            code = (key >> (_BITS * (self.n - 1 - place))) & ((1 << _BITS) - 1)
            out *= np.roll(self.letter(code), place)
        return out

    def of(self, keys: np.ndarray) -> np.ndarray:
        """The vectors of the given n-grams, one a row; the table has a byte a sign."""
        if len(self.rows) + len(keys) > self.keep:
            self.rows, self.table = {}, np.empty((0, self.dim), np.int8)
        new = [k for k in keys.tolist() if k not in self.rows]
        if new:
            at = len(self.rows)
            if at + len(new) > len(self.table):
                grown = np.empty((max(at + len(new), len(self.table) * 5 // 4, 1024), self.dim), np.int8)
                grown[:at] = self.table[:at]
                self.table = grown
            for i, k in enumerate(new, at):
                self.table[i] = self.bind(k)
                self.rows[k] = i
        return self.table[[self.rows[k] for k in keys.tolist()]].astype(np.float32)

    def bundle(self, grams: list[tuple[np.ndarray, np.ndarray]]) -> np.ndarray:
        """The sum of the vectors of all n-grams of each text, a row a text; `grams` has their numbers and counts."""
        out = np.zeros((len(grams), self.dim), np.float32)
        if not any(len(keys) for keys, _ in grams):
            return out
        keys, column = np.unique(np.concatenate([k for k, _ in grams]), return_inverse=True)
        row = np.repeat(np.arange(len(grams)), [len(k) for k, _ in grams])
        counts = np.concatenate([c for _, c in grams])
        order = np.argsort(column, kind="stable")
        row, column, counts = row[order], column[order], counts[order]
        for a in range(0, len(keys), STEP):
            here = slice(*np.searchsorted(column, (a, a + STEP)))
            dense = np.zeros((len(grams), min(STEP, len(keys) - a)), np.float32)
            dense[row[here], column[here] - a] = counts[here]
            out += dense @ self.of(keys[a : a + STEP])
        return out


def _shared(dim: int, n: int) -> GramVectors:
    return resident(f"gram vectors {dim} {n}", lambda: GramVectors(dim, n))


def fit(labelled: DataFrame, text: str = "text", lang: str = "lang", dim: int = DIM, n: int = N) -> dict[str, np.ndarray]:
    """The prototype of each language: the bundle of all n-grams of its labelled texts, over all rows given.

    Rows without a language or letters are left out. Each task sums its rows, and holds HELD_BYTES of n-grams at most that it
    hasn't summed yet, besides those of one text; what meets is `dim` sums a
    language and task, added up by Spark, and the driver gets the few prototypes. Of more than MAX_LANGS languages
    those with the most texts are learned (ties: by name); texts of others get one of these. Repeated rows count each time,
    whatever their labels.
    """

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: dict[str, list[tuple[np.ndarray, np.ndarray]]] = {}
        held: dict[str, int] = {}
        totals: dict[str, np.ndarray] = {}
        vectors, total = _shared(dim, n), 0

        def close(lang_: str) -> None:
            grams = found.pop(lang_)
            held.pop(lang_)
            keys, at = np.unique(np.concatenate([k for k, _ in grams]), return_inverse=True)
            counts = np.bincount(at, np.concatenate([c for _, c in grams]), len(keys))
            totals[lang_] = totals.get(lang_, 0.0) + vectors.bundle([(keys, counts)])[0].astype(np.float64)

        for batch in batches:
            for text_, lang_ in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                grams = ngrams(text_, n)
                found.setdefault(lang_, []).append(grams)
                held[lang_] = held.get(lang_, 0) + sum(x.nbytes for x in grams)
                total += sum(x.nbytes for x in grams)
                if held[lang_] >= LANGUAGE_BYTES or total >= HELD_BYTES:
                    most = max(held, key=held.get)
                    total -= held[most]
                    close(most)
        for lang_ in list(found):
            close(lang_)
        for lang_, v in totals.items():
            yield pa.RecordBatch.from_pydict({"lang": [lang_] * dim, "i": pa.array(range(dim), pa.int32()), "v": v})

    rows = labelled.where(F.col(lang).isNotNull()).select(F.col(text).alias("text"), F.col(lang).alias("lang"))
    names = rows.groupBy("lang").agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), "lang").limit(MAX_LANGS + 1).collect()
    if len(names) > MAX_LANGS:
        rows = rows.where(F.col("lang").isin([r.lang for r in names[:MAX_LANGS]]))
    summed = rows.mapInArrow(sums, "lang string, i int, v double").groupBy("lang", "i").agg(F.sum("v").alias("v"))
    out: dict[str, np.ndarray] = {}
    for r in summed.toLocalIterator():
        out.setdefault(r.lang, np.zeros(dim))[r.i] = r.v
    return {k: out[k] / max(np.linalg.norm(out[k]), 1e-9) for k in sorted(out)}


def predict(docs: DataFrame, prototypes: dict[str, np.ndarray], text: str = "text", out_lang: str = "lang_pred", out_score: str = "score", n: int = N) -> DataFrame:
    """Adds the language whose prototype has the highest cosine with the text's bundle, and that cosine (0 to 1).

    A null text, one without a letter, or no prototypes: `und` and 0. Ties go to the first language by
    name. Columns of the names added are replaced.
    """
    names = list(prototypes)
    matrix = np.stack([prototypes[k] for k in names]).astype(np.float32) if names else np.empty((0, DIM), np.float32)
    keep = [c for c in docs.columns if c.lower() not in (out_lang.lower(), out_score.lower())]
    (body,) = fresh(docs, "body")
    slim = docs.select(*keep, F.col(text).alias(body))

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vectors = _shared(matrix.shape[1], n)
        for batch in batches:
            for part in (batch.slice(a, 128) for a in range(0, batch.num_rows, 128)):
                bundles = vectors.bundle([ngrams(x, n) for x in part.column(len(keep)).to_pylist()])
                sizes = np.linalg.norm(bundles, axis=1)
                cosines = np.clip((bundles @ matrix.T) / np.maximum(sizes, 1e-9)[:, None], 0, 1) if names else np.zeros((part.num_rows, 1))
                best = np.argmax(cosines, axis=1)
                known = (sizes > 0) & bool(names)
                found = [names[b] if k else UNKNOWN for b, k in zip(best, known, strict=True)]
                scores = np.where(known, cosines[np.arange(len(best)), best], 0.0)
                yield pa.RecordBatch.from_arrays([*part.columns[: len(keep)], pa.array(found, pa.string()), pa.array(scores, pa.float64())], names=[*keep, out_lang, out_score])

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in slim.schema.fields[:-1])
    return slim.mapInArrow(score, f"{schema + ', ' if schema else ''}`{out_lang}` string, `{out_score}` double")


def held_out(doc_id: str = "doc_id") -> Column:
    """The fold that no training sees: crc32 of the id as text, modulo 4, is 2."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % 4 == 2, F.lit(False))


def op3_hd_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    prototypes = fit(docs.where(~held_out()))
    return predict(docs.select("doc_id", held_out().alias("held_out"), "text"), prototypes).select("doc_id", "held_out", "lang_pred", "score")


__all__ = ["GramVectors", "fit", "held_out", "ngrams", "op3_hd_language_id", "predict"]

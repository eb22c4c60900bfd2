"""Operator 1: personal data by fixed patterns and a character-level BiLSTM with CRF transitions."""

from __future__ import annotations

import functools
import hashlib
import os
import re
from collections import Counter
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from spanlake.llm.bilstm import PAD, BiLstmCrf, codes
from spanlake.llm.frames import fresh, read
from spanlake.llm.textio import buffers, byte_table, slices

#: Kinds with a fixed pattern, and those that the model knows: secrets (keys, tokens, passwords) have no pattern.
KINDS = ("email", "ip", "card", "phone")
MODEL_KINDS = (*KINDS, "secret")
#: Code points in a window, and from one window to the next.
WINDOW, STRIDE = 128, 64
#: Labelled windows made for training, passes over them, and hidden units a direction.
EXAMPLES, PASSES, HIDDEN = 10_000, 5, 20
#: The weights that `python -m spanlake.llm.pii` has trained and written; they are used only if they are of the settings here.
WEIGHTS = os.path.join(os.path.dirname(__file__), "pii_weights.npz")
#: Least length of a secret.
SECRET_CHARS = 8
_HINTS = byte_table(b"0123456789@")
_DOMAIN = re.compile(r"@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOTTED = re.compile(r"[0-9.]+")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_NOT_DIGIT = re.compile(r"[^0-9]")
Span = tuple[str, int, int]


def luhn(digits: str) -> bool:
    """The check digit rule of card numbers."""
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = int(c) << (i & 1)
        total += d - 9 if d > 9 else d
    return total % 10 == 0


def is_ip(text: str) -> bool:
    parts = text.split(".")
    return len(parts) == 4 and all(p.isascii() and p.isdigit() and len(p.lstrip("0")) <= 3 and int(p) <= 255 for p in parts)


def is_card(text: str) -> bool:
    digits = _NOT_DIGIT.sub("", text)
    return 12 <= len(digits) <= 19 and luhn(digits)


def is_phone(text: str) -> bool:
    return 9 <= len(_NOT_DIGIT.sub("", text)) <= 15


def base_spans(text: str) -> list[Span]:
    """Matches of the fixed patterns, leftmost and without overlap in each kind; matches that fail their rule are dropped.

    The patterns' matches are found in time linear in the text: an email around each @, an address within each
    run of digits and dots.
    """
    out: list[Span] = []
    if "@" in text:
        free = 0
        for m in _DOMAIN.finditer(text):
            a = m.start()
            while a > free and text[a - 1] in _LOCAL:
                a -= 1
            if a < m.start():
                out.append(("email", a, m.end()))
                free = m.end()
    for m in _DOTTED.finditer(text):
        if m[0].count(".") < 3:
            continue
        parts, at, i = m[0].split("."), m.start(), 0
        while i + 3 < len(parts):
            if all(parts[i : i + 4]):
                size = sum(map(len, parts[i : i + 4])) + 3
                if is_ip(text[at : at + size]):
                    out.append(("ip", at, at + size))
                at, i = at + size + 1, i + 4
            else:
                at, i = at + len(parts[i]) + 1, i + 1
    out += [("card", m.start(), m.end()) for m in _CARD.finditer(text) if is_card(m[0])]
    if "+" in text:
        out += [("phone", m.start(), m.end()) for m in _PHONE.finditer(text) if is_phone(m[0])]
    return sorted(out, key=lambda s: (s[1], KINDS.index(s[0])))


def admissible(kind: str, text: str) -> bool:
    """Whether a span of the model can be of its kind: addresses, check digits and lengths must be right, and every kind needs a digit or an @.

    A secret needs SECRET_CHARS characters in one word and a digit; what is one the model alone decides.
    """
    if kind == "secret":
        return len(text) >= SECRET_CHARS and not re.search(r"\s", text) and bool(re.search("[0-9]", text))
    if kind == "email":
        name, at, domain = text.partition("@")
        return bool(at and name and "." in domain.strip(".") and "@" not in domain and not re.search(r"\s", text))
    if text[:1] == " " or text[-1:] == " " or re.search(r"[^0-9+(). \x2d]", text):
        return False
    return {"ip": is_ip, "card": is_card, "phone": is_phone}[kind](text)


def examples(n: int = EXAMPLES, seed: int = 3, kinds: Sequence[str] = KINDS) -> list[tuple[str, list[Span]]]:
    """Made-up texts of one window with labelled spans of some kinds: each in several forms among words, and what is none of them."""
    rng = np.random.default_rng(seed)
    pick = lambda xs: xs[rng.integers(len(xs))]
    digits = lambda k: "".join(str(d) for d in rng.integers(0, 10, k))
    letters = lambda k: "".join(pick("etaoinshrdlucmfwypvbgkéèöüñß" if rng.random() < 0.2 else "etaoinshrdlucmfwypvbgk") for _ in range(k))
    plain = lambda k: "".join(pick("etaoinshrdlucmfwypvbgk") for _ in range(k))
    number = lambda top: str(rng.integers(0, top))

    def card() -> str:
        body = digits(rng.integers(11, 19))
        full = next(body + d for d in "0123456789" if luhn(body + d))
        gap = pick(["", "", " ", "-"])
        return gap.join(full[i : i + 4] for i in range(0, len(full), 4))

    def phone() -> str:
        a, b, c = digits(3), digits(3), digits(4)
        return pick([f"+{number(99)} ({a}) {b}-{c}", f"+{number(99)}{a}{b}{c}", f"+{number(99)} {a} {b} {c}", f"({a}) {b}-{c}", f"{a}-{b}-{c}", f"+{number(99)}-{a}-{b}-{c}", f"+{number(99)}.{a}.{b}.{c}"])

    def email() -> str:
        name = plain(rng.integers(2, 9)) + pick(["", digits(rng.integers(1, 6)), "." + plain(5), "_" + plain(4), "+" + plain(3)])
        return f"{name}@{pick(['mail', plain(5), plain(8)])}{pick(['', number(9)])}.{pick(['example.', '', plain(4) + '-' + plain(3) + '.'])}{pick(['com', 'org', 'net', 'de', 'co.uk', 'fr'])}"

    hexed = lambda k: "".join(pick("0123456789abcdef") for _ in range(k))
    mixed = lambda k: "".join(pick("abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789") for _ in range(k))

    def secret() -> tuple[str, str, str]:
        """What stands before a secret, the secret, and what stands after it."""
        free = rng.random()
        if free < 0.15:
            return "", "AKIA" + "".join(pick("ABCDEFGHIJKLMNOPQRSTUVWXYZ234567") for _ in range(16)), ""
        if free < 0.25:
            return pick(["", "Bearer "]), pick(["sk-", "ghp_", "pk_live_", "xoxb-"]) + mixed(rng.integers(20, 40)), ""
        name = pick(["token", "token", "api_key", "apikey", "API_KEY", "secret", "client_secret", "password", "passwd", "access_token", "key", "auth"])
        quote = pick(['"', '"', "'", ""])
        body = pick([hexed(40), hexed(32), mixed(rng.integers(16, 44)), mixed(rng.integers(8, 16)) + digits(2), mixed(20) + pick("+/_-") + mixed(19)])
        return f"{name}{pick([' = ', '=', ': ', ':', ' '])}{quote}", body, quote

    bare = lambda make: lambda: ("", make(), "")
    makers = {"email": bare(email), "ip": bare(lambda: ".".join(number(256) for _ in range(4))), "card": bare(card), "phone": bare(phone), "secret": secret}
    others = [
        lambda: f"commit {hexed(40)}", lambda: f"sha256:{hexed(64)}", lambda: "-".join(hexed(k) for k in (8, 4, 4, 4, 12)), lambda: f"the {pick(['token', 'password', 'key', 'secret'])} {plain(8)}", lambda: f"{pick(['token', 'key'])} = {plain(6)}", lambda: f"Version {number(9)}.{number(9)}",
        lambda: f"{rng.integers(1900, 2030)}-{rng.integers(10, 13)}-{rng.integers(10, 29)}", lambda: f"{number(24)}:{number(60)}:{number(60)}", lambda: "#" + digits(rng.integers(2, 9)), lambda: f"{number(9)}.{number(9)}.{number(9)}",
        lambda: digits(rng.integers(1, 9)), lambda: digits(rng.integers(12, 30)), lambda: "@" + plain(6), lambda: f"{number(999)},{digits(3)}.{digits(2)}", lambda: f"${number(5000)}.{digits(2)}", lambda: f"{300 + int(number(600))}.{number(999)}.{number(999)}.{number(999)}",
        lambda: f"{plain(4)}{number(99)}@ {plain(4)}", lambda: f"https://{plain(6)}.com/{digits(6)}", lambda: f"{number(99)}%", lambda: f"{number(12)}/{number(31)}/{rng.integers(1990, 2030)}",
    ]
    out = []
    for _ in range(n):
        text, spans = "", []
        while len(text) < WINDOW:
            r = rng.random()
            if r < 0.12:
                kind = pick(MODEL_KINDS)
                before, value, after = makers[kind]()
                spans.append((kind, len(text + before), len(text + before + value)))
                text += before + value + after
            elif r < 0.22:
                text += pick(others)()
            else:
                word = letters(rng.integers(1, 10))
                text += word.capitalize() if rng.random() < 0.15 else word
            text += pick([" ", " ", " ", " ", ", ", ". ", "\n", ".\n"])
        cut = int(rng.integers(0, 30))  # windows start and end anywhere
        out.append((text[cut : cut + WINDOW], [(k, max(0, a - cut), min(WINDOW, b - cut)) for k, a, b in spans if k in kinds and b > cut and a - cut < WINDOW]))
    return out


def as_arrays(labelled: Sequence[tuple[str, list[Span]]]) -> tuple[np.ndarray, np.ndarray]:
    x, y = np.full((len(labelled), WINDOW), PAD, np.uint8), np.zeros((len(labelled), WINDOW), np.int64)
    for i, (text, spans) in enumerate(labelled):
        c = codes(text)[:WINDOW]
        x[i, : len(c)] = c
        for kind, a, b in spans:
            tag = 2 * MODEL_KINDS.index(kind) + 1
            y[i, a:b] = tag + 1
            y[i, a] = tag
    return x, y


def train(labelled: Sequence[tuple[str, list[Span]]], passes: int = PASSES) -> BiLstmCrf:
    """A model from texts of up to WINDOW code points with labelled spans."""
    model = BiLstmCrf(len(MODEL_KINDS), HIDDEN)
    model.train(*as_arrays(labelled), passes)
    return model


def settings_digest() -> str:
    """What the default model depends on: its labelled texts, kinds and settings."""
    sample = examples(50, kinds=MODEL_KINDS)
    return hashlib.sha256(repr((MODEL_KINDS, WINDOW, EXAMPLES, PASSES, HIDDEN, sample)).encode()).hexdigest()


@functools.lru_cache(1)
def default_model() -> BiLstmCrf:
    """The model of the made-up labelled texts: from WEIGHTS if they are of these settings, else trained (minutes)."""
    if os.path.exists(WEIGHTS):
        with np.load(WEIGHTS) as saved:
            if str(saved["settings"]) == settings_digest():
                model = BiLstmCrf(len(MODEL_KINDS), HIDDEN)
                model.weights = {k: saved[k].astype(np.float32) for k in model.weights}
                return model
    return train(examples(kinds=MODEL_KINDS))


def precision_and_recall(model: BiLstmCrf, n: int = 2000, seed: int = 99) -> dict[str, tuple[float, float]]:
    """By kind, from reconciled spans of made-up texts that training has not seen; spans that a window's edge cuts don't count."""
    made = examples(n, seed, MODEL_KINDS)
    right, found_, wanted = Counter(), Counter(), Counter()
    for (text, spans), found in zip(made, model_spans([t for t, _ in made], model), strict=True):
        inner = lambda xs, text=text: {x for x in xs if x[1] > 1 and x[2] < len(text) - 1}
        got, want = inner(reconcile(text, base_spans(text), found)), inner(spans)
        right.update(k for k, *_ in got & want)
        found_.update(k for k, *_ in got)
        wanted.update(k for k, *_ in want)
    return {k: (right[k] / max(1, found_[k]), right[k] / max(1, wanted[k])) for k in MODEL_KINDS}


def window_starts(size: int) -> list[int]:
    return list(range(0, max(1, size - WINDOW + STRIDE), STRIDE))


def model_spans(texts: Sequence[str], model: BiLstmCrf) -> list[list[tuple[tuple, Span]]]:
    """For each text the spans of all its windows with a rank: (touches an inner edge, distance from the window's middle).

    A window without a digit or @ isn't run: no span in it could be admissible, so its answer is known.
    """
    places, rows = [], []
    for t, text in enumerate(texts):
        c = codes(text)
        hint = np.flatnonzero(_HINTS[np.minimum(c, 127)] & (c < 128))
        if not len(hint):
            continue
        for a in window_starts(len(c)):
            if np.searchsorted(hint, a) < np.searchsorted(hint, a + WINDOW):
                row = np.full(WINDOW, PAD, np.uint8)
                row[: len(c[a : a + WINDOW])] = c[a : a + WINDOW]
                rows.append(row)
                places.append((t, a, min(len(c), a + WINDOW), len(c)))
    out: list[list[tuple[tuple, Span]]] = [[] for _ in texts]
    for first in range(0, len(rows), 1024):
        tags = model.decode(np.stack(rows[first : first + 1024]))
        for (t, a, b, size), own in zip(places[first : first + 1024], tags, strict=True):
            i, end = 0, b - a
            heads = np.flatnonzero(own[:end] % 2 == 1)
            for i in heads.tolist():
                j = i + 1
                while j < end and own[j] == own[i] + 1:
                    j += 1
                edge = (i == 0 and a > 0) or (j == end and b < size)
                out[t].append(((edge, abs((i + j) / 2 - WINDOW / 2)), (MODEL_KINDS[(int(own[i]) - 1) // 2], a + i, a + j)))
    return out


def reconcile(text: str, base: list[Span], found: list[tuple[tuple, Span]]) -> list[Span]:
    """All spans of a text: the base ones, then those of windows, whole and central ones first, that are admissible and overlap none taken.

    A secret may hold base spans, as a token's digits can look like a card.
    """
    taken = list(base)
    for _, (kind, a, b) in sorted(found):
        alone = kind in ("email", "secret") or not (text[a - 1 : a].isdigit() or text[b : b + 1].isdigit())  # no part of a longer number
        clash = any(a < y and x < b and not (kind == "secret" and k != "secret" and a <= x and y <= b) for k, x, y in taken)
        if alone and not clash and admissible(kind, text[a:b]):
            taken.append((kind, a, b))
    return sorted(taken, key=lambda s: (s[1], MODEL_KINDS.index(s[0])))


def find(docs: DataFrame, model: BiLstmCrf | None = None, text: str = "text") -> DataFrame:
    """Adds base and spans of each whole text: arrays of (kind, start, end) in code points, end exclusive.

    base has the matches of the fixed patterns; spans has them and what the model adds. Both are ordered by start, then
    kind. Null and empty texts have none. Texts are cut into overlapping windows for the model, however long they are.
    Repeated rows get equal spans. Columns named base or spans are replaced. Without a model, the default one is taken,
    which was trained from made-up labelled texts (EXAMPLES windows, always the same); its weights, some kilobytes, go to the tasks.
    """
    keep = [c for c in docs.columns if c.lower() not in ("base", "spans")]
    (body,) = fresh(docs, "body")
    slim = docs.select(*keep, F.col(text).alias(body))
    shared = docs.sparkSession.sparkContext.broadcast(model or default_model())
    kind = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, body):
                data, offsets = buffers(part.column(body))
                hints = np.concatenate(([0], np.cumsum(_HINTS[data])))[offsets]
                rows = np.flatnonzero(np.diff(hints))
                texts = [part.column(body)[i].as_py() for i in rows.tolist()]
                base, every = [[] for _ in range(part.num_rows)], [[] for _ in range(part.num_rows)]
                for i, t, found in zip(rows.tolist(), texts, model_spans(texts, shared.value), strict=True):
                    base[i] = base_spans(t)
                    every[i] = reconcile(t, base[i], found)
                lists = [pa.array([[{"kind": k, "start": a, "end": b} for k, a, b in s] for s in x], kind) for x in (base, every)]
                yield pa.RecordBatch.from_arrays([*part.columns[: len(keep)], *lists], names=[*keep, "base", "spans"])

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in slim.schema.fields[:-1])
    spans = "array<struct<kind: string, start: int, end: int>>"
    return slim.mapInArrow(run, f"{schema + ', ' if schema else ''}base {spans}, spans {spans}")


def masked(docs: DataFrame, model: BiLstmCrf | None = None, text: str = "text") -> DataFrame:
    """The rows with each span in the text replaced by its kind in angle brackets."""
    found = find(docs, model, text)
    piece = lambda acc, s: F.struct(F.concat(acc["done"], F.substring(F.col(text), acc["at"] + 1, F.greatest(s["start"] - acc["at"], F.lit(0))), F.when(s["start"] >= acc["at"], F.concat(F.lit("<"), s["kind"], F.lit(">"))).otherwise(F.lit(""))).alias("done"), F.greatest(acc["at"], s["end"]).alias("at"))
    zero = F.struct(F.lit("").alias("done"), F.lit(0).alias("at"))
    new = F.aggregate("spans", zero, piece, lambda acc: F.concat(acc["done"], F.substring(F.col(text), acc["at"] + 1, 2147483647)))
    return found.withColumn(text, new).drop("base", "spans")


def op1_bilstm_crf_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = find(read(spark, sf_dir, "documents").select("doc_id", "text")).drop("text")
    shown = lambda c: F.concat_ws(",", F.transform(c, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])))
    count = lambda c, k: F.size(F.filter(c, lambda s: s["kind"] == k)).cast("long").alias(f"n_{k}")
    counts = [count("base", k) for k in KINDS]
    more = [count("spans", "secret"), F.size("spans").cast("long").alias("n_spans"), (F.size("spans") > 0).alias("has_private")]
    return found.select("doc_id", *counts, F.sha2(shown("base"), 256).alias("base_sha256"), shown("spans").alias("spans"), *more)


def main() -> None:
    """Trains the default model, writes WEIGHTS and prints precision and recall by kind on unseen texts."""
    model = train(examples(kinds=MODEL_KINDS))
    np.savez_compressed(WEIGHTS, settings=settings_digest(), **{k: v.astype(np.float16) for k, v in model.weights.items()})
    default_model.cache_clear()
    for kind, (precision, recall) in precision_and_recall(default_model()).items():
        print(f"{kind}: precision {precision:.3f}, recall {recall:.3f}")


__all__ = ["base_spans", "default_model", "examples", "find", "masked", "op1_bilstm_crf_pii", "precision_and_recall", "reconcile", "train"]

if __name__ == "__main__":
    main()

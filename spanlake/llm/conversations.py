"""Operator 11: conversations brought into the grammar `(system? (user assistant)+)?` at the least cost."""

from __future__ import annotations

import hashlib
import re
from collections.abc import Callable, Iterable, Iterator
from itertools import groupby, islice

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from spanlake.llm.frames import bound_batches, read, stored

#: Costs of the edits. Keeping a row is free; a truncated row that stays adds TRUNCATED.
REROLE, DELETE, INSERT, TRUNCATED = 3, 4, 3, 3
#: States of the grammar: nothing yet, after a system row, after a user row, after an assistant row; a conversation may end in two.
EMPTY, OPENED, ASKED, ANSWERED = range(4)
ENDS = (EMPTY, ANSWERED)
#: Where the initial of a kept row leads, and where an added user or assistant row does.
KEPT = {(EMPTY, "s"): OPENED, **{(s, "u"): ASKED for s in (EMPTY, OPENED, ANSWERED)}, (ASKED, "a"): ANSWERED}
NEXT = {EMPTY: ASKED, OPENED: ASKED, ASKED: ANSWERED, ANSWERED: ASKED}
#: Edits in detail, in the order of their initials: delete, a further copy (deleted), insert a user or an assistant row, keep, rerole to user or assistant.
DELETED, COPY, INSERT_USER, INSERT_ASSISTANT, KEEP, TO_USER, TO_ASSISTANT = "DEIJKRS"
INITIALS = ("EJS", "DIR")
#: What happens to a row by the remainder of its key's CRC by this.
DAMAGE = 20
#: Rows of a conversation that one step of the search takes; steps are joined afterwards.
BLOCK = 1 << 12
_SOLID, _END = r"[^\x20\x09-\x0D]", r"[.!?][\x20\x09-\x0D]*\z"
#: The least (cost, edits) to get to each of the four states; None where no way leads.
Layer = list[tuple[int, str] | None]


def damaged(rows: DataFrame) -> DataFrame:
    """conv_id, turn, role, text, copies: rows damaged by the CRC of their key. Null roles and texts are one space, and so are null ids and turns in the key."""
    of = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    kind = F.pmod(F.crc32(F.concat(of("conv_id"), F.lit(":"), of("turn")).cast("binary")), F.lit(DAMAGE))
    text = F.when(kind == 1, "").when(kind == 2, F.regexp_replace(of("text"), "[.!?]", "")).otherwise(of("text"))
    return rows.where(kind != 0).select("conv_id", "turn", F.when(kind == 4, "user").otherwise(of("role")).alias("role"), text.alias("text"), F.when(kind == 3, 2).otherwise(1).cast("long").alias("copies"))


def _content() -> Column:
    """Tells rows by role and text, whatever they hold."""
    return F.unhex(F.sha2(F.concat(F.char_length("role").cast("string"), F.lit(":"), F.col("role"), F.col("text")).cast("binary"), 256))


def faults(rows: DataFrame) -> DataFrame:
    """conv_id, turn, content (of role and text), initial, copies, fault (blank, duplicate, truncated or empty) of each different row: no texts.

    Equal rows of a turn are one with a count, so no group holds copies; a row is a duplicate if the content is in an earlier turn.
    """
    fault = F.when(~F.col("text").rlike(_SOLID), "blank").when(~F.col("text").rlike(_END), "truncated").otherwise("")
    light = rows.select("conv_id", "turn", F.col("role"), _content().alias("content"), "copies", fault.alias("fault"))
    distinct = light.groupBy("conv_id", "turn", "role", "content", "fault").agg(F.sum("copies").alias("copies"))
    seen = F.struct(F.col("turn").isNotNull().alias("known"), "turn")
    first = distinct.groupBy("conv_id", "content").agg(F.min(seen).alias("first")).alias("f")
    met = distinct.alias("d").join(first, F.col("d.conv_id").eqNullSafe(F.col("f.conv_id")) & (F.col("d.content") == F.col("f.content")))
    later = (F.col("d.fault") != "blank") & ~F.col("f.first").eqNullSafe(F.struct(F.col("d.turn").isNotNull().alias("known"), "d.turn"))
    return met.select("d.conv_id", "d.turn", "d.role", "d.content", F.substring("d.role", 1, 1).alias("initial"), "d.copies", F.when(later, "duplicate").otherwise(F.col("d.fault")).alias("fault"))


def closed(layer: Layer) -> Layer:
    """A layer after the inserts that help: two in a row at most, as a third one would lead to a state that was there before."""
    for _ in range(2):
        for state in range(4):
            if (way := layer[state]) is not None:
                to = NEXT[state]
                more = (way[0] + INSERT, way[1] + (INSERT_USER if to == ASKED else INSERT_ASSISTANT))
                if layer[to] is None or more < layer[to]:
                    layer[to] = more
    return layer


def advance(layer: Layer, initial: str, fault: str, copies: int) -> Layer:
    """The layer after a row: deleted, kept or given another role; then its further copies are deleted, and inserts close it.

    Among ways of one cost the edits that are least as text win. Two such ways to a state never have one as the start of the
    other, as what is longer by inserts costs more; so the least start stays the least whatever follows.
    """
    out: Layer = [None] * 4
    tail = COPY * (copies - 1)
    more = DELETE * (copies - 1)

    def offer(state: int, cost: int, edits: str) -> None:
        way = (cost + more, edits + tail)
        if out[state] is None or way < out[state]:
            out[state] = way

    stays = TRUNCATED if fault == "truncated" else 0
    for state, way in enumerate(layer):
        if way is None:
            continue
        cost, edits = way
        offer(state, cost + DELETE, edits + DELETED)
        if fault in ("blank", "duplicate"):
            continue
        if (to := KEPT.get((state, initial))) is not None:
            offer(to, cost + stays, edits + KEEP)
        to = NEXT[state]
        offer(to, cost + stays + REROLE, edits + (TO_USER if to == ASKED else TO_ASSISTANT))
    return closed(out)


def start(state: int = EMPTY) -> Layer:
    layer: Layer = [None] * 4
    layer[state] = (0, "")
    return closed(layer)


def joined(first: list[Layer], second: list[Layer]) -> list[Layer]:
    """Of two runs of rows, one after the other, the least ways from each state to each: (min, +) over costs and edits."""
    out: list[Layer] = []
    for layer in first:
        to: Layer = [None] * 4
        for way, rest in zip(layer, second, strict=True):
            for state in range(4):
                if way is not None and rest[state] is not None:
                    more = (way[0] + rest[state][0], way[1] + rest[state][1])
                    if to[state] is None or more < to[state]:
                        to[state] = more
        out.append(to)
    return out


#: What is known of a block of rows; costs and edits are those of the ways from each state to each.
_BLOCKS = "conv_id {id}, at long, n long, first_turn long, last_turn long, turns long, first string, last string, blank long, duplicate long, truncated long, illegal long, costs array<array<long>>, edits array<array<string>>"
#: The edits of each block; the counts of the conversation stand in the row of its first block alone.
_EDITS = "conv_id {id}, at long, ops string, report struct<gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string>"
_LAWFUL = frozenset(("su", "ua", "au"))
_COUNTS = ("blank", "duplicate", "truncated", "illegal")
_ROW = f"[{INSERT_USER}{INSERT_ASSISTANT}]*[{DELETED}{KEEP}{TO_USER}{TO_ASSISTANT}]{COPY}*"


def _runs(batches: Iterable[pa.RecordBatch], *key: str) -> Iterator[tuple[tuple, Iterator[dict]]]:
    """Rows that follow each other with one key."""
    rows = (row for batch in batches for row in batch.to_pylist())
    return groupby(rows, key=lambda row: tuple(row[c] for c in key))


def _batches(rows: Iterator[dict], schema: pa.Schema, size: int) -> Iterator[pa.RecordBatch]:
    while held := list(islice(rows, size)):
        yield pa.RecordBatch.from_pylist(held, schema)


def _mapped(df: DataFrame, rows_of: Callable[[Iterable[pa.RecordBatch]], Iterator[dict]], ddl: str, size: int = 256) -> DataFrame:
    schema = to_arrow_schema(StructType.fromDDL(ddl))
    return df.mapInArrow(lambda batches: _batches(rows_of(batches), schema, size), ddl)


def _block(conv: object, rows: Iterator[dict]) -> dict:
    """Counts, ends and ways of a block."""
    out: dict = dict.fromkeys(("n", "turns", *_COUNTS), 0) | {"conv_id": conv, "first_turn": None, "last_turn": None, "last": None}
    layers = [start(s) for s in range(4)]
    for row in rows:
        initial, copies, fault, turn = row["initial"], row["copies"], row["fault"], row["turn"]
        if not out["n"]:
            out |= {"at": row["place"], "first": initial}
        else:
            out["illegal"] += out["last"] + initial not in _LAWFUL
        out["illegal"] += (copies - 1) * (initial + initial not in _LAWFUL)
        if turn is not None and turn != out["last_turn"]:
            out["turns"] += 1
            out["first_turn"] = turn if out["first_turn"] is None else out["first_turn"]
            out["last_turn"] = turn
        out["n"] += 1
        out["last"] = initial
        if fault == "blank":
            out["blank"] += copies
        else:
            out["duplicate"] += copies - (fault != "duplicate")
            out["truncated"] += fault == "truncated"
        layers = [advance(x, initial, fault, copies) for x in layers]
    split = lambda k: [[w and w[k] for w in x] for x in layers]
    return out | {"costs": split(0), "edits": split(1)}


def _conversation(conv: object, blocks: Iterator[dict]) -> Iterator[dict]:
    """The least edits of a conversation, block by block, with its counts in the first row."""
    total, low, high, last, turns, ways, sizes = dict.fromkeys(_COUNTS, 0), None, None, None, 0, [], []
    for b in blocks:
        total = {c: n + b[c] for c, n in total.items()}
        total["illegal"] += last is not None and last + b["first"] not in _LAWFUL
        last = b["last"]
        if b["first_turn"] is not None:
            turns += b["turns"] - (high == b["first_turn"])
            low, high = b["first_turn"] if low is None else low, b["last_turn"]
        ways.append([[None if c is None else (c, e) for c, e in zip(*x, strict=True)] for x in zip(b["costs"], b["edits"], strict=True)])
        sizes.append((b["at"], b["n"]))
    while len(ways) > 1:  # by pairs, so that edits are copied as often as the number of blocks can be halved
        ways = [joined(*ways[i : i + 2]) if i + 1 < len(ways) else ways[i] for i in range(0, len(ways), 2)]
    cost, edits = min(w for s in ENDS if (w := ways[0][EMPTY][s]) is not None)
    report = {**total, "gaps": 0 if low is None else high - low + 1 - turns, "cost": cost, "audit": edits.translate(str.maketrans(*INITIALS))}
    ends, at = re.finditer(_ROW, edits), 0
    for k, (place, n) in enumerate(sizes):
        end = at
        for m in islice(ends, n):
            end = m.end()
        end = len(edits) if k == len(sizes) - 1 else end  # inserts after the last row
        yield {"conv_id": conv, "at": place, "ops": edits[at:end], "report": report if k == 0 else None}
        at = end


def repair(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Two frames: a row a conversation (conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit), and the repaired rows.

    rows: conv_id, turn (long), role, text and copies (long), without null roles or texts; other columns are not looked at. Rows
    are taken by turn, nulls first; rows of one turn by role and then by the SHA-256 of role and text, equal rows as one that is
    there `copies` times. A null conv_id is a conversation of its own. The least edits by cost, and of equal cost the least as
    text, are found by a forward search over the four states, block by block of BLOCK rows; blocks of a conversation are joined
    afterwards, so one with a third of all rows is searched by many tasks. Repaired rows: conv_id, place and step (their order),
    role, text; added rows have an empty text. Conversations without rows aren't in either. No rows: two empty frames.

    Texts move once, to the edits of the rows that stay; all else is about hashes, initials and counts. A conversation's edits
    are one text in a task, as long as it has rows.
    """
    kinds = dict(rows.dtypes)
    bound_batches(rows.sparkSession)
    light = faults(rows)
    order = ["conv_id", "turn", "role", "content"]
    placed = stored(light.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("place", F.monotonically_increasing_id()))
    cut = placed.select("conv_id", "turn", "initial", "copies", "fault", "place", F.floor(F.col("place") / BLOCK).cast("long").alias("block"))
    blocks = _mapped(cut.repartition("conv_id", "block").sortWithinPartitions("conv_id", "place"), lambda batches: (_block(k[0], own) for k, own in _runs(batches, "conv_id", "block")), _BLOCKS.format(id=kinds["conv_id"]))
    edits = stored(_mapped(blocks.repartition("conv_id").sortWithinPartitions("conv_id", "at"), lambda batches: (row for k, own in _runs(batches, "conv_id") for row in _conversation(k[0], own)), _EDITS.format(id=kinds["conv_id"])))
    report = edits.where("report IS NOT NULL").select("conv_id", "report.*")
    ops = edits.select("at", F.posexplode(F.regexp_extract_all("ops", F.lit(rf"{_ROW}(?:[{INSERT_USER}{INSERT_ASSISTANT}]+$)?"), F.lit(0))).alias("i", "ops")).select((F.col("at") + F.col("i")).alias("place"), "ops")
    acts = placed.join(ops, "place").where(F.col("ops").rlike(f"[^{DELETED}{COPY}]")).select("conv_id", "turn", "content", "role", "place", "ops").alias("e")
    texts = rows.select("conv_id", "turn", _content().alias("content"), "text").groupBy("conv_id", "turn", "content").agg(F.first("text").alias("text")).alias("t")
    same = [F.col(f"e.{c}").eqNullSafe(F.col(f"t.{c}")) for c in ("conv_id", "turn", "content")]
    made = acts.join(texts, same, "left").select("e.conv_id", "place", "role", "text", F.posexplode(F.regexp_extract_all("ops", F.lit(f"[^{DELETED}{COPY}]"), F.lit(0))).alias("step", "op"))
    role = F.when(F.col("op").isin(INSERT_USER, TO_USER), "user").when(F.col("op").isin(INSERT_ASSISTANT, TO_ASSISTANT), "assistant").otherwise(F.col("role"))
    text = F.when(F.col("op").isin(INSERT_USER, INSERT_ASSISTANT), "").otherwise(F.col("text"))
    return report, made.select("conv_id", "place", "step", role.alias("role"), text.alias("text"))


def digests(repaired: DataFrame) -> DataFrame:
    """conv_id, repaired_sha256: of the lines role:text of each conversation in order. A hash goes from row to row, so a task streams a conversation and holds nothing of it."""

    def hashed(batches: Iterable[pa.RecordBatch]) -> Iterator[dict]:
        for (conv,), rows in _runs(batches, "conv_id"):
            digest, line = hashlib.sha256(), ""
            for row in rows:
                digest.update(f"{line}{row['role']}:{row['text']}".encode())
                line = "\n"
            yield {"conv_id": conv, "repaired_sha256": digest.hexdigest()}

    ordered = repaired.repartition("conv_id").sortWithinPartitions("conv_id", "place", "step").select("conv_id", "role", "text")
    return _mapped(ordered, hashed, f"conv_id {dict(repaired.dtypes)['conv_id']}, repaired_sha256 string")


def op11_viterbi_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = read(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    report, repaired = repair(damaged(rows))
    same = lambda a, b: F.col(f"{a}.conv_id").eqNullSafe(F.col(f"{b}.conv_id"))
    out = rows.select("conv_id").distinct().alias("c").join(report.alias("r"), same("c", "r"), "left").join(digests(repaired).alias("d"), same("c", "d"), "left")
    numbers = [F.coalesce(F.col(f"r.{c}"), F.lit(0).cast("long")).alias(c) for c in ("gaps", *_COUNTS, "cost")]
    return out.select("c.conv_id", *numbers, F.coalesce("r.audit", F.lit("")).alias("audit"), F.coalesce("d.repaired_sha256", F.lit(hashlib.sha256().hexdigest())).alias("repaired_sha256"))


ORACLE = f"""
WITH RECURSIVE crc AS (
  SELECT list(v ORDER BY n) AS t FROM (
    SELECT n, list_reduce(list_prepend(n, range(8)), lambda c, _: CASE WHEN c % 2 = 1 THEN xor(c // 2, 3988292384) ELSE c // 2 END) AS v
    FROM (SELECT CAST(unnest(range(256)) AS BIGINT) AS n))
), k AS (
  SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
    xor(4294967295, list_reduce(list_prepend(4294967295::BIGINT, list_transform(regexp_extract_all(hex(encode(coalesce(CAST(conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' '))), '..'), lambda p: CAST('0x' || p AS BIGINT))),
      lambda c, b: xor(c // 256, crc.t[xor(c, b) % 256 + 1]))) % {DAMAGE} AS kind
  FROM conversations, crc
), d AS (
  SELECT conv_id, turn, CASE WHEN kind = 4 THEN 'user' ELSE role END AS role, CASE kind WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text
  FROM (SELECT *, unnest(range(CASE WHEN kind = 3 THEN 2 ELSE 1 END)) FROM k WHERE kind <> 0)
), o AS (
  SELECT *, left(role, 1) AS i, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, sha256(length(role) || ':' || role || text)) AS n FROM d
), f AS (
  SELECT *, CASE WHEN NOT regexp_matches(text, '[^\\x20\\x09-\\x0D]') THEN 'blank' WHEN row_number() OVER (PARTITION BY conv_id, role, text ORDER BY n) > 1 THEN 'duplicate'
    WHEN NOT regexp_matches(text, '[.!?][\\x20\\x09-\\x0D]*$') THEN 'truncated' ELSE '' END AS fault, lag(i) OVER (PARTITION BY conv_id ORDER BY n) AS j
  FROM o
), g AS (
  SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count(*) FILTER (WHERE fault = 'blank') AS blank, count(*) FILTER (WHERE fault = 'duplicate') AS duplicate,
    count(*) FILTER (WHERE fault = 'truncated') AS truncated, count(*) FILTER (WHERE j IS NOT NULL AND j || i NOT IN ('su', 'ua', 'au')) AS illegal, max(n) AS top
  FROM f GROUP BY conv_id
), v AS (
  -- the least (cost, edits) to each state after n rows: e nothing yet, s system, u user, a assistant
  SELECT conv_id, top, 0::BIGINT AS n, {{'c': 0::BIGINT, 'a': ''}} AS e, {{'c': 1000000000::BIGINT, 'a': ''}} AS s, {{'c': {INSERT}::BIGINT, 'a': 'I'}} AS u, {{'c': {2 * INSERT}::BIGINT, 'a': 'II'}} AS a FROM g
  UNION ALL
  SELECT conv_id, top, n, e, s, u2, list_min([a, {{'c': u2.c + {INSERT}, 'a': u2.a || 'I'}}]) FROM (
    SELECT *, list_min([u, {{'c': e.c + {INSERT}, 'a': e.a || 'I'}}, {{'c': s.c + {INSERT}, 'a': s.a || 'I'}}, {{'c': a.c + {INSERT}, 'a': a.a || 'I'}}]) AS u2 FROM (
      SELECT v.conv_id, v.top, f.n, {{'c': v.e.c + {DELETE}, 'a': v.e.a || 'D'}} AS e,
        list_min([{{'c': v.s.c + {DELETE}, 'a': v.s.a || 'D'}}, {{'c': v.e.c + p + CASE WHEN i = 's' THEN 0 ELSE 1000000000 END, 'a': v.e.a || 'K'}}]) AS s,
        list_min([{{'c': v.u.c + {DELETE}, 'a': v.u.a || 'D'}}, {{'c': v.e.c + p + {REROLE}, 'a': v.e.a || 'R'}}, {{'c': v.s.c + p + {REROLE}, 'a': v.s.a || 'R'}}, {{'c': v.a.c + p + {REROLE}, 'a': v.a.a || 'R'}},
          {{'c': v.e.c + p + w, 'a': v.e.a || 'K'}}, {{'c': v.s.c + p + w, 'a': v.s.a || 'K'}}, {{'c': v.a.c + p + w, 'a': v.a.a || 'K'}}]) AS u,
        list_min([{{'c': v.a.c + {DELETE}, 'a': v.a.a || 'D'}}, {{'c': v.u.c + p + {REROLE}, 'a': v.u.a || 'R'}}, {{'c': v.u.c + p + CASE WHEN i = 'a' THEN 0 ELSE 1000000000 END, 'a': v.u.a || 'K'}}]) AS a
      FROM v JOIN (SELECT conv_id, n, i, CASE fault WHEN 'blank' THEN 1000000000 WHEN 'duplicate' THEN 1000000000 WHEN 'truncated' THEN {TRUNCATED} ELSE 0 END AS p, CASE WHEN i = 'u' THEN 0 ELSE 1000000000 END AS w FROM f) f
        ON f.n = v.n + 1 AND f.conv_id IS NOT DISTINCT FROM v.conv_id))
), b AS (
  SELECT conv_id, list_min([e, a]) AS best FROM v WHERE n = top
), l AS (
  SELECT conv_id, pos, letter, sum(CASE WHEN letter <> 'I' THEN 1 ELSE 0 END) OVER (PARTITION BY conv_id ORDER BY pos) AS n
  FROM (SELECT conv_id, pos, edits[pos] AS letter FROM (SELECT conv_id, unnest(range(1, length(best.a) + 1)) AS pos, best.a AS edits FROM b))
), q AS (
  SELECT l.conv_id, l.pos, l.letter, f.role, f.text, f.i, row_number() OVER (PARTITION BY l.conv_id ORDER BY l.pos) AS place,
    first_value(l.letter = 'K' AND f.i = 's') OVER (PARTITION BY l.conv_id ORDER BY l.pos) AS leads
  FROM l LEFT JOIN f ON l.letter <> 'I' AND f.n = l.n AND f.conv_id IS NOT DISTINCT FROM l.conv_id WHERE l.letter <> 'D'
), h AS (
  SELECT conv_id, sha256(string_agg(CASE WHEN letter = 'K' THEN role WHEN (place - CASE WHEN leads THEN 1 ELSE 0 END) % 2 = 1 THEN 'user' ELSE 'assistant' END || ':' || coalesce(text, ''), chr(10) ORDER BY pos)) AS sha FROM q GROUP BY conv_id
)
SELECT c.conv_id, CAST(coalesce(gaps, 0) AS BIGINT) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate, coalesce(truncated, 0) AS truncated, coalesce(illegal, 0) AS illegal,
  CAST(coalesce(best.c, 0) AS BIGINT) AS cost, coalesce(best.a, '') AS audit, coalesce(sha, sha256('')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) c LEFT JOIN g ON g.conv_id IS NOT DISTINCT FROM c.conv_id LEFT JOIN b ON b.conv_id IS NOT DISTINCT FROM c.conv_id LEFT JOIN h ON h.conv_id IS NOT DISTINCT FROM c.conv_id
"""

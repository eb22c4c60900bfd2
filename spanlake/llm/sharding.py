"""Operator 4: weighted rendezvous hashing of stable record keys over shards."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from spanlake.llm.frames import fresh, read

N_SHARDS = 24
#: Parts of each shard that are numbered side by side; shards x BLOCKS bounds the table of their offsets.
BLOCKS = 256


def draw(key: Column, shard: Column) -> Column:
    """A number in (0, 1) that depends on the key and the shard alone: 52 bits of an MD5."""
    bits = F.conv(F.substring(F.md5(F.concat(key, F.lit("#"), shard.cast("string"))), 1, 13), 16, 10)
    return (bits.cast("double") + F.lit(0.5)) / F.lit(float(1 << 52))


def best_shard(key: Column, weights: Sequence[float]) -> Column:
    """The shard whose cost -ln(draw)/weight is least: a shard wins in proportion to its weight."""
    if not weights or min(weights) <= 0:
        raise ValueError("weights must be positive")
    costs = F.array(*[F.struct((-F.log(draw(key, F.lit(i))) / F.lit(float(w))).alias("cost"), F.lit(i).alias("shard")) for i, w in enumerate(weights)])
    return F.array_min(costs)["shard"]


def assign(docs: DataFrame, weights: Sequence[float], key: str = "doc_id", out: str = "shard") -> DataFrame:
    """Adds the shard (0 to len(weights) - 1) of each record as an int column.

    Only the key's text form and the weights decide, so equal keys share a shard, and a shard that is
    added or takes more weight only takes records into itself. A null key counts as the empty text.
    An `out` column that exists is replaced. No rows move: it is a projection.
    """
    return docs.withColumn(out, best_shard(F.coalesce(F.col(key).cast("string"), F.lit("")), weights))


def number(rows: DataFrame, shard: str, spread: Sequence[str], order: Sequence[str], out: str = "slot", blocks: int = BLOCKS) -> DataFrame:
    """Adds a gapless number from 0 within each shard.

    Each shard is cut into `blocks` parts by a hash of the `spread` columns; the parts are numbered on
    their own and moved by the sizes of the parts before, a table of shards x blocks rows at most. So
    no task holds a shard. Rows that tie in `order` may swap their numbers.
    """
    part, before, size = fresh(rows, "part", "before", "size")
    text = F.concat_ws("#", *[F.coalesce(F.col(c).cast("string"), F.lit("")) for c in spread])
    parted = rows.withColumn(part, F.conv(F.substring(F.md5(text), 1, 6), 16, 10).cast("long") % F.lit(blocks))
    sizes = parted.groupBy(shard, part).agg(F.count(F.lit(1)).alias(size))
    offsets = sizes.select(shard, part, (F.sum(size).over(Window.partitionBy(shard).orderBy(part)) - F.col(size)).alias(before))
    numbered = parted.withColumn(out, F.row_number().over(Window.partitionBy(shard, part).orderBy(*order)).cast("long") - 1)
    joined = numbered.join(F.broadcast(offsets), [shard, part])  # blocks rows a shard: a bound that the data can't move
    return joined.withColumn(out, F.col(out) + F.col(before)).select(*rows.columns, out)


def write_shards(docs: DataFrame, path: str, weights: Sequence[float], key: str = "doc_id") -> None:
    """Writes the records as Parquet, one folder a shard."""
    (name,) = fresh(docs, "shard")
    assign(docs, weights, key, name).write.partitionBy(name).parquet(path)


def layout(docs: DataFrame, n_shards: int = N_SHARDS) -> DataFrame:
    """Shard, slot and the shard with one more shard, for each document (law `key`).

    A null text has size 8 and CRC 0; a null doc_id hashes as the empty text; repeated rows share a shard
    and take slots of their own.
    """
    text = F.coalesce(F.col("text"), F.lit(""))
    key = F.coalesce(F.col("doc_id").cast("string"), F.lit(""))
    costs = F.array(*[F.struct((-F.log(draw(key, F.lit(i)))).alias("cost"), F.lit(i).alias("shard")) for i in range(n_shards + 1)])
    slim = docs.select("doc_id", (F.octet_length(text) + F.lit(8)).cast("long").alias("size"), F.crc32(text.cast("binary")).alias("text_crc32"), F.lit("key").alias("law"), costs.alias("_costs"))
    placed = slim.select("doc_id", "size", "text_crc32", "law", F.array_min(F.slice("_costs", 1, n_shards))["shard"].alias("shard"), F.array_min("_costs")["shard"].alias("grown_shard"))
    return number(placed, "shard", ["doc_id", "text_crc32", "size"], ["doc_id", "text_crc32", "size"]).select("doc_id", "size", "text_crc32", "law", "shard", "slot", "grown_shard")


def op4_rendezvous_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    return layout(read(spark, sf_dir, "documents"))


ORACLE = f"""
WITH d AS (
  SELECT row_number() OVER () AS rid, doc_id, coalesce(text, '') AS t, coalesce(CAST(doc_id AS VARCHAR), '') AS k FROM documents
), costs AS (
  SELECT rid, i, -ln((CAST('0x' || substr(md5(k || '#' || i), 1, 13) AS BIGINT) + 0.5::DOUBLE) / 4503599627370496::DOUBLE) AS cost
  FROM d, range({N_SHARDS + 1}) r(i)
), best AS (
  SELECT rid, CAST(arg_min(i, cost) FILTER (WHERE i < {N_SHARDS}) AS INTEGER) AS shard, CAST(arg_min(i, cost) AS INTEGER) AS grown_shard
  FROM costs GROUP BY rid
), crc AS (
  -- CRC-32 bit by bit: a step for each byte, over the table of the 256 remainders
  SELECT list(v ORDER BY n) AS t FROM (
    SELECT n, list_reduce(list_prepend(n, range(8)), lambda c, _: CASE WHEN c % 2 = 1 THEN xor(c // 2, 3988292384) ELSE c // 2 END) AS v
    FROM (SELECT CAST(unnest(range(256)) AS BIGINT) AS n))
), sized AS (
  SELECT d.doc_id, octet_length(encode(d.t)) + 8 AS size, d.t, best.shard, best.grown_shard,
    xor(4294967295, list_reduce(list_prepend(4294967295::BIGINT, list_transform(regexp_extract_all(hex(encode(d.t)), '..'), lambda p: CAST('0x' || p AS BIGINT))),
      lambda c, b: xor(c // 256, crc.t[xor(c, b) % 256 + 1]))) AS text_crc32
  FROM d JOIN best USING (rid), crc
), parts AS (
  SELECT *, CAST('0x' || substr(md5(concat_ws('#', coalesce(CAST(doc_id AS VARCHAR), ''), text_crc32, size)), 1, 6) AS BIGINT) % {BLOCKS} AS part FROM sized
)
SELECT doc_id, CAST(size AS BIGINT) AS size, CAST(text_crc32 AS BIGINT) AS text_crc32, 'key' AS law, shard,
  CAST(row_number() OVER (PARTITION BY shard ORDER BY part, doc_id, text_crc32, size) - 1 AS BIGINT) AS slot, grown_shard
FROM parts
"""

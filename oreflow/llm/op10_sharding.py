"""Sharding by weighted rendezvous hashing, in built-in functions only.

Each record draws one number per shard from md5(key | shard); the shard with
the largest weighted draw gets it.  A record's shard depends on its key, the
shards and their weights alone, so a further shard takes records only into
itself, and a larger weight takes in proportion.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import documents, without

SHARDS = 24
# records numbered by one task at a time
SLOT_BLOCK = 50_000


def draw(key: Column, shard: int) -> Column:
    """52 bits of md5 as a whole number; the same in any SQL engine."""
    return F.conv(F.substring(F.md5(F.concat(key, F.lit(f"|{shard}"))), 1, 13), 16, 10).cast("long")


def shard_of(key: Column, weights: list[float]) -> Column:
    """Shard of each key.  ``weights``: one positive number per shard; a NULL
    key counts as the empty string.  With equal weights the largest draw wins
    (ties: the smaller shard); else the smallest -ln(u) / weight."""
    if not weights or any(not w > 0 for w in weights):
        raise ValueError("weights must be positive")
    k = F.coalesce(key.cast("string"), F.lit(""))
    if len(set(weights)) == 1:
        best = F.greatest(*[F.struct(draw(k, s).alias("d"), F.lit(-s).alias("s")) for s in range(len(weights))]) \
            if len(weights) > 1 else F.struct(draw(k, 0).alias("d"), F.lit(0).alias("s"))
        return (-best["s"]).cast("int")
    cost = [F.struct((-F.log((draw(k, s) + F.lit(0.5)) / F.lit(float(1 << 52))) / F.lit(float(w))).alias("c"),
                     F.lit(s).alias("s")) for s, w in enumerate(weights)]
    return F.least(*cost)["s"].cast("int")


def shard(df: DataFrame, key: str, weights: list[float], out: str = "shard") -> DataFrame:
    """``df`` with column ``out`` (a column of that name in ``df`` is replaced).
    No shuffle; repeated keys share a shard."""
    return without(df, [out]).withColumn(out, shard_of(F.col(key), weights))


def slots(df: DataFrame, by: str, order: list[str], out: str = "slot", rows: int | None = None) -> DataFrame:
    """Numbers the rows of each ``by`` gaplessly from 0 in ``order``.

    Equal rows are counted before the shuffle, so one key that holds a third
    of all rows moves as one row; a shard is numbered in many buckets at once
    (about SLOT_BLOCK rows each), whose offsets come from one row per bucket.
    ``df`` is read twice and must be deterministic."""
    n = df.count() if rows is None else rows
    buckets = max(1, n // SLOT_BLOCK)
    cols = df.columns
    g = df.groupBy(*cols).agg(F.count(F.lit(1)).alias("_n")) \
        .withColumn("_b", F.pmod(F.xxhash64(*order), F.lit(buckets)).cast("int"))
    w = _window([by, "_b"], order)
    g = g.withColumn("_before", F.sum("_n").over(w) - F.col("_n"))
    sizes = g.groupBy(by, "_b").agg(F.sum("_n").alias("_size"))
    offs = sizes.withColumn("_off", F.sum("_size").over(_window([by], ["_b"])) - F.col("_size")) \
        .select(F.col(by).alias("_by"), F.col("_b").alias("_bb"), "_off")
    j = g.join(offs, F.col(by).eqNullSafe(F.col("_by")) & (F.col("_b") == F.col("_bb")))
    first = F.col("_off") + F.col("_before")
    return j.select(*cols, F.explode(F.sequence(first, first + F.col("_n") - 1)).alias(out))


def _window(by: list[str], order: list[str]):
    from pyspark.sql import Window
    return Window.partitionBy(*by).orderBy(*order).rowsBetween(Window.unboundedPreceding, Window.currentRow)


def op10_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    text = F.coalesce(F.col("text"), F.lit(""))
    d = documents(spark, sf_dir).select(
        "doc_id",
        (F.octet_length(text) + 8).cast("long").alias("size"),
        F.crc32(text.cast("binary")).alias("text_crc32"))
    d = shard(d, "doc_id", [1.0] * SHARDS)
    d = shard(d, "doc_id", [1.0] * (SHARDS + 1), "grown_shard")
    d = slots(d, "shard", ["doc_id", "text_crc32", "size"])
    return d.select("doc_id", "size", "text_crc32", F.lit("key").alias("law"), "shard", "slot", "grown_shard")


def _draw_sql(key: str, s: int) -> str:
    return f"('0x' || substr(md5(concat({key}, '|{s}')), 1, 13))::BIGINT"


def _shard_sql(n: int) -> str:
    d = ", ".join(_draw_sql("k", s) for s in range(n))
    return f"list_position([{d}], list_max([{d}])) - 1"


# CRC-32 by nibbles: the table of 16 steps follows from the polynomial
def _crc_sql() -> str:
    t = []
    for i in range(16):
        c = i
        for _ in range(4):
            c = (c >> 1) ^ (0xEDB88320 if c & 1 else 0)
        t.append(c)
    step = f"xor(c >> 4, {t}[(xor(c, n) & 15) + 1])"
    return f"xor(list_reduce(list_prepend(4294967295, nib), lambda c, n: {step}), 4294967295)"


OP10_SQL = f"""
WITH d AS (
  SELECT row_number() OVER () AS r, doc_id, coalesce(doc_id::VARCHAR, '') AS k, hex(encode(coalesce(text, ''))) AS hx
  FROM documents),
b AS (
  SELECT r, i, ('0x' || substr(hx, 2 * i + 1, 2))::BIGINT AS v FROM d, unnest(range(length(hx) // 2)) AS u(i)),
nibs AS (SELECT r, flatten(list([v & 15, v >> 4] ORDER BY i)) AS nib FROM b GROUP BY r),
s AS (
  SELECT doc_id, length(hx) // 2 + 8 AS size, CASE WHEN nib IS NULL THEN 0 ELSE {_crc_sql()} END AS text_crc32,
         ({_shard_sql(SHARDS)})::INT AS shard, ({_shard_sql(SHARDS + 1)})::INT AS grown_shard
  FROM d LEFT JOIN nibs USING (r))
SELECT doc_id, size, text_crc32, 'key' AS law, shard,
       row_number() OVER (PARTITION BY shard ORDER BY doc_id, text_crc32, size) - 1 AS slot, grown_shard
FROM s"""

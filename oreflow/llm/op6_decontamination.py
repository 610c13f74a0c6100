"""Benchmark decontamination by spaced-seed hashing.

A document is contaminated if some window of OVERLAP consecutive tokens of an
item (all of a shorter one) agrees with the text in AGREE percent of places;
items of fewer than WHOLE tokens must be there whole.

A mask keeps some of a window's tokens and ignores the others, so a window whose
ignored tokens were substituted still hashes alike.  A window that may lack e
tokens is split into equal parts; the masks keep every choice of all parts but e,
so whichever tokens were substituted, one mask hits.  All masks slide over every
text; a filter of bounded size passes the text windows that may hit, which are
joined with the items' windows.  Around each hit text and item are laid side by
side and all windows counted.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations
from math import comb

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .bitmap import Bitmap, build
from .common import cut, documents, free_name, id_key, key_id
from .textvec import _U, Flat, mix, pieces

OVERLAP = 16
AGREE = 80
WHOLE = 7
MOST_MASKS = 6   # of one length of window


def least(w: int) -> int:
    """Places of a window of ``w`` tokens that must agree."""
    return w if w < WHOLE else -(-AGREE * w // 100)


def masks(w: int) -> tuple[int, list[str]]:
    """Length of a part, and masks (1: token kept, 0: ignored): at some multiple of
    that length, one keeps only tokens that agree in any window of ``w`` tokens with
    ``least(w)`` that do.  Of the ways to part it, that which keeps most tokens."""
    e = w - least(w)
    ways = [(size * (w // size - e), -comb(w // size - 1, e), size) for size in range(1, w + 1)
            if w // size > e and comb(w // size - 1, e) <= MOST_MASKS]
    size = max(ways)[2]
    parts = w // size
    # masks slide, so each starts with a part that it keeps
    kept = [(0, *c) for c in combinations(range(1, parts), parts - e - 1)]
    return size, ["".join(("1" if k in c else "0") * size for k in range(c[-1] + 1)) for c in kept]


def seeds(doc: np.ndarray, h: np.ndarray, some: list[str]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Per mask: first tokens of all windows within one text, and their hashes."""
    for mask in some:
        n = len(h) - len(mask) + 1
        if n <= 0:
            yield np.zeros(0, np.int64), np.zeros(0, np.uint64)
            continue
        at = np.flatnonzero(doc[:n] == doc[len(mask) - 1:])
        x = np.full(len(at), _U(int(mask, 2)))
        for j, keep in enumerate(mask):
            if keep == "1":
                x = x * _U(0xD6E8FEB86659FD93) + h[at + j]
        yield at, mix(x)


def tokens(f: Flat) -> tuple[np.ndarray, np.ndarray]:
    s, e, doc = f.words()
    return doc, f.range_hashes(s, e)


def _items(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for rows, f in pieces(batches):
        doc, h = tokens(f)
        at = np.searchsorted(doc, np.arange(f.n + 1))
        yield pa.RecordBatch.from_arrays(
            [rows.column(0), pa.array([h[a:b].tobytes() for a, b in zip(at[:-1], at[1:])], pa.binary())],
            names=["item", "words"])


def _item_seeds(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        hs, it, at = [], [], []
        for item, w in zip(b.column(0).to_pylist(), b.column(1)):
            h = np.frombuffer(w.as_buffer(), np.uint64)
            w = min(OVERLAP, len(h))
            size, some = masks(w)
            for p, x in seeds(np.zeros(len(h), np.int64), h, some):
                if len(h) == w:       # one window: parts lie at multiples of their size
                    p, x = p[p % size == 0], x[p % size == 0]
                hs.append(x)
                at.append(p)
                it.append(np.full(len(p), item, np.int64))
        cols = [np.concatenate(c) if c else np.zeros(0, np.int64) for c in (hs, it, at)]
        yield pa.RecordBatch.from_arrays([pa.array(cols[0].astype(np.uint64).view(np.int64)), pa.array(cols[1]), pa.array(cols[2])],
                                         names=["h", "item", "q"])


def _regions(batches: Iterator[pa.RecordBatch], some: Bitmap, kinds: list[str]) -> Iterator[pa.RecordBatch]:
    """Stretches of a text around windows that may hit: their tokens' hashes, and
    each such window's first token (counted from the stretch's start) and hash."""
    for rows, f in pieces(batches):
        doc, h = tokens(f)
        at, hs = [], []
        for p, x in seeds(doc, h, kinds):
            ok = some(x)
            at.append(p[ok])
            hs.append(x[ok])
        at = np.concatenate([np.zeros(0, np.int64), *at])
        hs = np.concatenate([np.zeros(0, np.uint64), *hs])
        order = np.argsort(at, kind="stable")
        at, hs = at[order], hs[order]
        first = np.searchsorted(doc, np.arange(f.n + 1))
        d = doc[at] if len(at) else at
        lo = np.maximum(at - OVERLAP, first[d])
        hi = np.minimum(at + OVERLAP, first[d + 1])
        new = np.ones(len(at), bool)
        new[1:] = (d[1:] != d[:-1]) | (lo[1:] > hi[:-1])
        start = np.flatnonzero(new)
        end = np.append(start[1:], len(at))
        out = [[], [], []]
        for a, b in zip(start, end):
            out[0].append(h[lo[a]:hi[b - 1]].tobytes())
            out[1].append(at[a:b] - lo[a])
            out[2].append(hs[a:b].view(np.int64))
        ids = rows.column(0).take(pa.array(d[start])) if len(start) else rows.column(0).slice(0, 0)
        yield pa.RecordBatch.from_arrays(
            [ids, pa.array(out[0], pa.binary()), pa.array(out[1], pa.list_(pa.int64())), pa.array(out[2], pa.list_(pa.int64()))],
            names=["id", "words", "p", "h"])


def overlap(text: np.ndarray, item: np.ndarray, diag: int) -> int:
    """Most places that agree in a window of min(OVERLAP, item) tokens; 0 if too few do."""
    n = len(item)
    w = min(OVERLAP, n)
    at = np.arange(n) + diag
    ok = (at >= 0) & (at < len(text))
    same = np.zeros(n, np.int64)
    same[ok] = text[at[ok]] == item[ok]
    c = np.concatenate([[0], np.cumsum(same)])
    m = int((c[w:] - c[:-w]).max())
    return m if m >= least(w) else 0


def _verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        out = [overlap(np.frombuffer(t.as_buffer(), np.uint64), np.frombuffer(i.as_buffer(), np.uint64), d)
               for t, i, d in zip(b.column(2), b.column(3), b.column(4).to_pylist())]
        yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(out, pa.int64())], names=["id", "item", "agree"])


def contaminated(df: DataFrame, benchmark: DataFrame) -> DataFrame:
    """(id, n_items, first_item, best): ids of ``df`` that overlap items of
    ``benchmark`` (item_id, text): how many items of distinct words, the smallest
    item_id and the most places that agree.

    NULL, empty and wordless texts and items take no part; items of fewer than
    WHOLE words must be there word by word; a NULL item_id counts as the smallest.  Items of equal words are one item; rows
    with one id share their findings.  An empty table gives no rows."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    items = benchmark.select(id_key("item_id").alias("item"), text.alias("text")) \
        .mapInArrow(_items, "item bigint, words binary").groupBy("words").agg(F.min("item").alias("item"))
    # an item_id may stand for several texts: each gets a number of its own
    items = cut(items.where(F.octet_length("words") > 0).withColumn("number", F.monotonically_increasing_id()))
    seed = cut(items.select("number", "words").mapInArrow(_item_seeds, "h bigint, item bigint, q bigint"))
    some = build(seed.select("h"))
    # lengths of windows: OVERLAP at most
    sizes = items.select(F.least(F.octet_length("words") / 8, F.lit(OVERLAP)).cast("int").alias("w")).distinct().collect()
    kinds = sorted({m for r in sizes for m in masks(r["w"])[1]})
    src = df.select(id_key().alias("id"), text.alias("text"))
    regions = src.mapInArrow(lambda it: _regions(it, some, kinds), "id bigint, words binary, p array<bigint>, h array<bigint>")
    regions = cut(regions.withColumn("region", F.monotonically_increasing_id()))
    at = regions.select("region", F.explode(F.arrays_zip("p", "h")).alias("x")).select("region", "x.p", "x.h")
    hits = at.join(seed, "h").select("region", "item", (F.col("p") - F.col("q")).alias("diag")).distinct()
    j = hits.join(regions.select("region", "id", F.col("words").alias("text")), "region") \
        .join(items.select(F.col("number").alias("item"), F.col("words").alias("item_words"), F.col("item").alias("item_id")), "item")
    good = j.select("id", F.struct("item", "item_id").alias("item"), "text", "item_words", "diag") \
        .mapInArrow(_verify, "id bigint, item struct<item: bigint, item_id: bigint>, agree bigint").where(F.col("agree") > 0)
    best = good.groupBy("id", "item").agg(F.max("agree").alias("agree"))
    return best.groupBy("id").agg(F.count(F.lit(1)).alias("n_items"), F.min("item.item_id").alias("first_item"),
                                  F.max("agree").alias("best"))


def decontaminate(df: DataFrame, benchmark: DataFrame) -> DataFrame:
    """Rows of ``df`` whose id shows no overlap with an item, with all their columns."""
    bad = contaminated(df, benchmark).select(F.col("id").alias(free_name(df, "_bad")))
    k = free_name(df, "_id")
    return df.withColumn(k, id_key()).join(bad, F.col(k) == F.col(bad.columns[0]), "left_anti").select(*df.columns)


def op6_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per document: whether it overlaps an item, with how many, which first, and how well."""
    d = documents(spark, sf_dir)
    bad = contaminated(d, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))
    j = d.select(id_key().alias("id")).join(bad, "id", "left")
    return j.select(key_id("id").alias("doc_id"), F.col("best").isNotNull().alias("contaminated"),
                    F.coalesce("n_items", F.lit(0)).cast("long").alias("n_items"), key_id("first_item").alias("first_item"),
                    F.coalesce("best", F.lit(0)).cast("long").alias("best"))


# The oracle's own seeds and least length: it finds what they hit, the operator all.
MASKS = ("1111111", "1101011011", "11100100010011", "10110011101")
WEIGHT = 7


def _key_sql(w: str, mask: str, m: int) -> str:
    return f"'{m} ' || " + " || ' ' || ".join(f"{w}[i + {j + 1}]" for j, k in enumerate(mask) if k == "1")


def _seed_sql(table: str, key: str) -> str:
    return " UNION ALL ".join(
        f"SELECT {key}, i, {_key_sql('w', mask, m)} AS k FROM {table}, unnest(range(len(w) - {len(mask) - 1})) AS u(i)"
        f" WHERE len(w) >= {len(mask)}" for m, mask in enumerate(MASKS))


_UP = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
_WORDS_SQL = (f"regexp_extract_all(translate(coalesce(text, ''), '{_UP}', '{_UP.lower()}'), '[^\\x20\\x09-\\x0D]+')")

OP6_SQL = f"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, {_WORDS_SQL} AS w FROM documents),
b AS (SELECT row_number() OVER () AS n, * FROM (
  SELECT {_WORDS_SQL} AS w, min(item_id) AS item_id FROM benchmark GROUP BY 1) WHERE len(w) >= {WEIGHT}),
hit AS (
  SELECT DISTINCT x.r, y.n, x.i AS p, y.i AS q
  FROM ({_seed_sql('d', 'r')}) x JOIN ({_seed_sql('b', 'n')}) y ON x.k = y.k),
v AS (
  SELECT d.doc_id, hit.n, b.item_id, least({OVERLAP}, len(b.w)) AS l, s,
         list_sum(list_transform(range(s, s + least({OVERLAP}, len(b.w))),
           lambda j: CASE WHEN p - q + j >= 0 AND p - q + j < len(d.w) AND d.w[p - q + j + 1] = b.w[j + 1]
                     THEN 1 ELSE 0 END)) AS agree
  FROM hit JOIN d USING (r) JOIN b ON b.n = hit.n,
       unnest(range(greatest(0, q - least({OVERLAP}, len(b.w)) + 1), least(q, len(b.w) - least({OVERLAP}, len(b.w))) + 1)) AS u(s)),
g AS (
  SELECT doc_id, count(DISTINCT n) AS n_items, min(item_id) AS first_item, max(agree) AS best
  FROM v WHERE agree * 100 >= {AGREE} * l GROUP BY doc_id)
SELECT documents.doc_id, best IS NOT NULL AS contaminated, coalesce(n_items, 0) AS n_items, first_item,
       coalesce(best, 0) AS best
FROM documents LEFT JOIN g ON documents.doc_id IS NOT DISTINCT FROM g.doc_id"""

"""Line de-duplication by site-relative frequency, in built-in functions only.

A line is boilerplate on a host if it stands on more than ``max_ratio`` of the
host's pages, and on ``min_pages`` at least.  Lines are compared trimmed; empty
lines stay.  Counting moves one pair of hashes per distinct line and page, added
up before the shuffle; the lines dropped on a host are at most (mean lines of
its pages) / max_ratio, so they fit one array per host, and a page is cut by
that array without being taken apart again.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import documents, free_name, without

MAX_RATIO = 0.1
MIN_PAGES = 5
_EDGE = " \t\r\x0b\x0c"


def line_key(line: Column) -> Column:
    """Two independent 64-bit hashes of the trimmed line."""
    t = F.btrim(line, F.lit(_EDGE))
    return F.struct(F.xxhash64(t).alias("a"), F.xxhash64(F.lit(1), t).alias("b"))


def _lines(text: Column) -> Column:
    return F.split(text, "\n", -1)


def boilerplate(df: DataFrame, host: str, text: str, max_ratio: float = MAX_RATIO,
                min_pages: int = MIN_PAGES) -> DataFrame:
    """(host, dropped: array of line keys, pages) of hosts that have any such line.

    A line repeated on one page counts once; a NULL host is a host of its own;
    a page without text counts as a page."""
    d = df.select(F.col(host).alias("host"), F.col(text).alias("text"))
    pages = d.groupBy("host").agg(F.count(F.lit(1)).alias("pages"))
    filled = F.filter(_lines(F.col("text")), lambda x: F.length(F.btrim(x, F.lit(_EDGE))) > 0)
    on = d.select("host", F.explode(F.array_distinct(F.transform(filled, line_key))).alias("k")) \
        .groupBy("host", "k").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= min_pages)
    j = on.join(pages.withColumnRenamed("host", "_h"), F.col("host").eqNullSafe(F.col("_h")))
    return j.where(F.col("n") > F.lit(max_ratio) * F.col("pages")) \
        .groupBy("host").agg(F.collect_list("k").alias("dropped"))


def line_dedup(df: DataFrame, host: str = "source", text: str = "text", max_ratio: float = MAX_RATIO,
               min_pages: int = MIN_PAGES, counts: tuple[str, str] | None = None) -> DataFrame:
    """``df`` with the boilerplate lines of each host taken out of ``text``.

    Every row stays, with its other columns; NULL text stays NULL; a text whose
    lines all go becomes ''.  ``counts`` names two columns to add: lines of the
    text, and lines dropped (columns of those names are replaced)."""
    if counts:
        df = without(df, [c for c in counts if c.lower() not in (host.lower(), text.lower())])
    gone, h = free_name(df, "_dropped"), free_name(df, "_host")
    bad = boilerplate(df, host, text, max_ratio, min_pages).select(F.col("host").alias(h), F.col("dropped").alias(gone))
    j = df.join(bad, F.col(host).eqNullSafe(F.col(h)), "left")
    lines = _lines(F.col(text))
    stay = F.filter(lines, lambda x: ~F.array_contains(F.col(gone), line_key(x)))
    cut = F.when(F.col(gone).isNull(), F.col(text)).otherwise(F.array_join(stay, "\n"))
    out = [(cut.alias(c) if c.lower() == text.lower() else F.col(f"`{c}`")) for c in df.columns]
    if counts:
        n = F.coalesce(F.size(F.filter(lines, lambda x: F.lit(True))), F.lit(0))
        left = F.coalesce(F.size(stay), F.lit(0))
        n = F.when(F.col(text).isNull(), 0).otherwise(n).cast("long")
        out += [n.alias(counts[0]), F.when(F.col(gone).isNull() | F.col(text).isNull(), 0).otherwise(n - left)
                .cast("long").alias(counts[1])]
    return j.select(*out)


def op7_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = documents(spark, sf_dir).select("doc_id", "source", "text")
    return line_dedup(d, counts=("n_lines", "n_dropped")).select("doc_id", "source", "n_lines", "n_dropped", "text")


_TRIM = "trim({}, ' ' || chr(9) || chr(13) || chr(11) || chr(12))"

OP7_SQL = f"""
WITH l AS (
  SELECT r, doc_id, source, text, i, lines[i] AS line, {_TRIM.format('lines[i]')} AS t FROM (
    SELECT row_number() OVER () AS r, doc_id, source, text, string_split(text, chr(10)) AS lines FROM documents),
    unnest(range(1, len(lines) + 1)) AS u(i)),
p AS (SELECT source, count(*) AS pages FROM documents GROUP BY source),
bad AS (
  SELECT l.source, t FROM l JOIN p ON l.source IS NOT DISTINCT FROM p.source WHERE length(t) > 0
  GROUP BY l.source, t, pages HAVING count(DISTINCT r) >= {MIN_PAGES} AND count(DISTINCT r) > {MAX_RATIO} * pages),
m AS (
  SELECT l.*, bad.t IS NOT NULL AS gone FROM l LEFT JOIN bad ON l.source IS NOT DISTINCT FROM bad.source AND l.t = bad.t),
g AS (
  SELECT r, doc_id, source, count(*) AS n_lines, count_if(gone) AS n_dropped,
         coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (WHERE NOT gone), '') AS text
  FROM m GROUP BY r, doc_id, source)
SELECT doc_id, source, n_lines, n_dropped, text FROM g
UNION ALL SELECT doc_id, source, 0, 0, NULL FROM documents WHERE text IS NULL"""

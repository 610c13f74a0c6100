"""Quality rules with adaptive thresholds from mergeable quantile sketches.

Every document gets exact counts; four whole-number measures go into sketches
per (lang, source).  A sketch is a histogram over bins that keep a number's top
seven bits (relative error below 1/64), so sketches of partitions, sources and
languages merge by adding counts, and equal inputs give equal thresholds.  A
group's limits are its quartiles spread by ``FENCE`` quartile distances (one unit
of the measure at least).  Of repetition most texts have none and ordinary ones
some, so its quartiles say nothing: there the limit is no lower than the group's
upper quantile.  Symbols are none in most prose and many in junk, and some in a
source of tables or code: there the limit lies in the widest gap of the group's
sketch above the body of its documents, and at its end where it has no gap.  Groups with few documents use the merged sketch of their
language, or of all.  The limits join back to the documents, and a document
outside any of them goes.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import cut, documents
from .textvec import _U, SPACE, Flat, mix, pieces, unique_per_text, windows

MIN_WORDS, MAX_REPEAT_PCT = 50, 50
FENCE = 3
MIN_GROUP = 200
KNEE = 8        # a gap's far end is so many times its near end, counted from one, at least
UNIT = 1        # least width of a fence, in the measure's own unit
# measure -> (whether it has a lower limit; percent of a group's documents that the upper one spares at least)
GAPPED = ("symbol_pm",)        # measures whose upper limit lies in a gap
MEASURES = {
    "symbol_pm": (False, 75),      # symbols per 1000 characters of words
    "dup_line_pm": (False, 99),    # repeated lines per 1000 lines with a word
    "repeat_pm": (False, 99),      # words in repeated 3-word windows per 1000 words
    "word_cpm": (True, 75),        # characters per 100 words
}
_SYMBOL = np.zeros(256, bool)
_SYMBOL[[ord(c) for c in "#*$%&|<>"]] = True

QUANTILES = ("q1", "q3", "top", "knee")
STATS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines")


def repeat_words(doc: np.ndarray, h: np.ndarray, n: int) -> np.ndarray:
    """Per text: words inside 3-word windows that occur twice or more in it."""
    at, w = windows(doc, h, 3)
    out = np.zeros(n, np.int64)
    if not len(at):
        return out
    key = mix(w ^ (doc[at].astype(np.uint64) * _U(0x9E3779B97F4A7C15)))
    order = np.argsort(key)
    ks = key[order]
    same = ks[1:] == ks[:-1]
    dup = np.zeros(len(ks), bool)
    dup[1:] |= same
    dup[:-1] |= same
    hit = at[order[dup]]
    cover = np.zeros(len(h), bool)
    for j in range(3):
        cover[hit + j] = True
    return np.bincount(doc[cover], minlength=n)


def line_counts(f: Flat, in_word: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Per text: lines that have a word, and those of them equal to an earlier one."""
    s, e, d = f.lines()
    c = np.zeros(len(in_word) + 1, np.int64)
    np.cumsum(in_word, out=c[1:])
    full = c[e] > c[s]
    s, e, d = s[full], e[full], d[full]
    ud, _ = unique_per_text(d, f.range_hashes(s, e, lower=False))
    n = np.bincount(d, minlength=f.n)
    return n, n - np.bincount(ud, minlength=f.n)


def text_stats(f: Flat) -> dict[str, np.ndarray]:
    starts, ends, doc = f.words()
    h = f.range_hashes(starts, ends, lower=False)
    in_word = ~SPACE[f.buf]
    lines, dups = line_counts(f, in_word)
    return {
        "n_words": np.bincount(doc, minlength=f.n),
        "word_chars": f.per_text(in_word & ((f.buf & 0xC0) != 0x80)),
        "n_symbols": f.per_text(_SYMBOL[f.buf]),
        "n_dup_lines": dups,
        "n_repeat_words": repeat_words(doc, h, f.n),
        "n_lines": lines,
    }


def _stats(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for rows, f in pieces(batches):
        st = text_stats(f)
        yield pa.RecordBatch.from_arrays(
            [*(rows.column(i) for i in range(3)), *(pa.array(st[k], pa.int64()) for k in STATS)],
            names=["doc_id", "lang", "source", *STATS])


def document_stats(df: DataFrame) -> DataFrame:
    """Exact counts of every text (NULL: none) beside doc_id, lang and source."""
    src = df.selectExpr("cast(doc_id as bigint) doc_id", "cast(lang as string) lang", "cast(source as string) source",
                        "cast(text as string) text")
    schema = "doc_id bigint, lang string, source string, " + ", ".join(f"{k} bigint" for k in STATS)
    return src.mapInArrow(_stats, schema)


def _per(num: str, den: str, scale: int) -> Column:
    return F.when(F.col(den) > 0, F.floor(F.col(num) * scale / F.col(den))).otherwise(0).cast("long")


def with_measures(df: DataFrame) -> DataFrame:
    return df.withColumns({
        "symbol_pm": _per("n_symbols", "word_chars", 1000),
        "dup_line_pm": _per("n_dup_lines", "n_lines", 1000),
        "repeat_pm": _per("n_repeat_words", "n_words", 1000),
        "word_cpm": _per("word_chars", "n_words", 100),
    })


def _width(v: Column) -> Column:
    return F.pow(F.lit(2), F.greatest(F.length(F.bin(v)) - 7, F.lit(0))).cast("long")


def bin_of(v: Column) -> Column:
    """Lower edge of a number's bin: its top seven bits."""
    return v - F.pmod(v, _width(v))


def sketch(df: DataFrame, by: list[str], measures: list[str]) -> DataFrame:
    """Histogram sketches: (by..., measure, bin, n).  Merge: add n."""
    long = df.select(*by, F.explode(F.array(*[F.struct(F.lit(m).alias("measure"), bin_of(F.col(m)).alias("bin"))
                                              for m in measures])).alias("s"))
    return long.select(*by, "s.*").groupBy(*by, "measure", "bin").agg(F.count(F.lit(1)).alias("n"))


def quartiles(sk: DataFrame, by: list[str]) -> DataFrame:
    """Per group and measure: count, lower and upper quartile (bin edges), the last
    number of the bin that holds the measure's upper quantile, and the knee: the
    middle (geometric, counted from one) of the widest gap between bins that lies
    above the spared share, else the last number of the last bin.

    A sketch has a few hundred bins at most, so a group's window is small."""
    w = Window.partitionBy(*by, "measure")
    run = w.orderBy("bin").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    c = sk.withColumns({"cum": F.sum("n").over(run), "total": F.sum("n").over(w)})
    spared = F.coalesce(*[F.when(F.col("measure") == m, F.lit(top)) for m, (_, top) in MEASURES.items()])
    last = F.col("bin") + _width(F.col("bin")) - 1
    c = c.withColumn("last", F.lag(last).over(w.orderBy("bin")))
    ratio = (F.col("bin") + 1) / (F.col("last") + 1)
    gap = (ratio >= KNEE) & ((F.col("cum") - F.col("n")) * 100 >= F.col("total") * spared)
    middle = (F.floor(F.sqrt((F.col("last") + 1.0) * (F.col("bin") + 1.0))) - 1).cast("long")
    return c.groupBy(*by, "measure").agg(
        F.coalesce(F.max(F.when(gap, F.struct(ratio.alias("r"), (-F.col("bin")).alias("b"), middle.alias("m"))))["m"], F.max(last)).alias("knee"),
        F.max("total").alias("total"),
        F.min(F.when(F.col("cum") * 4 >= F.col("total"), F.col("bin"))).alias("q1"),
        F.min(F.when(F.col("cum") * 4 >= F.col("total") * 3, F.col("bin"))).alias("q3"),
        F.min(F.when(F.col("cum") * 100 >= F.col("total") * spared, F.col("bin") + _width(F.col("bin")) - 1)).alias("top"))


def thresholds(sk: DataFrame) -> DataFrame:
    """Limits per (lang, source): one row, columns <measure>_lo and <measure>_hi.

    Groups below MIN_GROUP documents take the sketch merged over their language;
    languages below it take the one merged over all."""
    sk = cut(sk)
    lang = sk.groupBy("lang", "measure", "bin").agg(F.sum("n").alias("n"))
    every = sk.groupBy("measure", "bin").agg(F.sum("n").alias("n"))
    g = quartiles(sk, ["lang", "source"])
    ql = quartiles(lang, ["lang"]).select(F.col("lang").alias("l2"), F.col("measure").alias("m2"), F.col("total").alias("t2"),
                                          *[F.col(q).alias(f"{q}_2") for q in QUANTILES])
    qa = quartiles(every, []).select(F.col("measure").alias("m3"), *[F.col(q).alias(f"{q}_3") for q in QUANTILES])
    # qa has one row per measure, whatever the data
    j = g.join(ql, F.col("lang").eqNullSafe(F.col("l2")) & (F.col("measure") == F.col("m2"))) \
        .join(F.broadcast(qa), F.col("measure") == F.col("m3"))

    def pick(q: str) -> Column:
        return F.when(F.col("total") >= MIN_GROUP, F.col(q)).when(F.col("t2") >= MIN_GROUP, F.col(f"{q}_2")) \
            .otherwise(F.col(f"{q}_3"))
    j = j.select("lang", "source", "measure", *[pick(q).alias(q) for q in QUANTILES])
    out = []
    for m, (lo, _) in MEASURES.items():
        mine = F.col("measure") == m
        spread = F.greatest(FENCE * (F.col("q3") - F.col("q1")), F.lit(UNIT))
        if lo:
            out.append(F.max(F.when(mine, F.col("q1") - spread)).alias(f"{m}_lo"))
        out.append(F.max(F.when(mine, F.greatest(F.col("q3") + spread, F.col("knee" if m in GAPPED else "top")))).alias(f"{m}_hi"))
    return j.groupBy("lang", "source").agg(*out)


def quality_rules(df: DataFrame) -> DataFrame:
    """Per row of ``df``: doc_id, the counts, base_failed and kept.

    NULL and empty texts have no words and fail the base rules; NULL lang or
    source is a group of its own; repeated rows are judged each; an empty table
    gives no rows; other columns of ``df`` play no part.  Thresholds come from
    the documents that pass the base rules."""
    st = cut(with_measures(document_stats(df)).withColumn(
        "base_failed", (F.col("n_words") < MIN_WORDS) | (F.col("n_repeat_words") * 100 > F.col("n_words") * MAX_REPEAT_PCT)))
    th = thresholds(sketch(st.where(~F.col("base_failed")), ["lang", "source"], list(MEASURES)))
    th = th.withColumnsRenamed({"lang": "_l", "source": "_s"})
    j = st.join(th, F.col("lang").eqNullSafe(F.col("_l")) & F.col("source").eqNullSafe(F.col("_s")), "left")
    ok = ~F.col("base_failed")
    for m, (lo, _) in MEASURES.items():
        ok = ok & (F.col(m) <= F.col(f"{m}_hi"))
        if lo:
            ok = ok & (F.col(m) >= F.col(f"{m}_lo"))
    return j.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed",
                    F.coalesce(ok, F.lit(False)).alias("kept"), "lang", "source", *MEASURES)


def op2_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules(documents(spark, sf_dir)).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")

"""Quality classifier: regularised quadratic discriminant analysis.

Each text becomes a few transformed statistics.  Per class, Spark adds up count,
sums and products of the statistics over all labelled training rows; from these
few numbers come the class means and covariances, shrunk towards their diagonal
and the pooled covariance.  The cached Cholesky factor of each class turns a
batch of documents into Mahalanobis log-densities by one triangular product.
The class sums are as small whatever the input, so no training row is left out.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import cut, documents, fold, id_key
from .op2_quality_rules import line_counts, repeat_words
from .textvec import SPACE, Flat, pieces, unique_per_text

THRESHOLD = 0.3
TO_DIAGONAL, TO_POOLED, RIDGE = 0.05, 0.1, 0.02
FEATURES = ("words", "word_length", "symbols", "bangs", "upper", "dup_lines", "repeats", "stutter", "bars",
            "variety", "digits", "stops")


def _marks(chars: str) -> np.ndarray:
    m = np.zeros(256, bool)
    m[[ord(c) for c in chars]] = True
    return m


_SYM, _BANG, _BAR, _STOP = _marks("#*$%&<>"), _marks("!"), _marks("|"), _marks(".,;:?")
_UPPER, _LETTER, _DIGIT = (np.zeros(256, bool) for _ in range(3))
_UPPER[65:91] = True
_LETTER[65:91] = _LETTER[97:123] = True
_DIGIT[48:58] = True


def features(f: Flat) -> np.ndarray:
    """Transformed statistics of each text; an empty text has all shares 0."""
    starts, ends, doc = f.words()
    h = f.range_hashes(starts, ends, lower=False)
    in_word = ~SPACE[f.buf]
    n = np.bincount(doc, minlength=f.n)
    chars = f.per_text(in_word & ((f.buf & 0xC0) != 0x80))
    lines, dups = line_counts(f, in_word)
    twice = np.zeros(len(h), bool)
    twice[1:] = (h[1:] == h[:-1]) & (doc[1:] == doc[:-1])
    ud, _ = unique_per_text(doc, h)
    some = np.maximum(n, 1)
    share = lambda x, of: np.log(0.01 + x / np.maximum(of, 1))
    letters = f.per_text(_LETTER[f.buf])
    return np.column_stack([
        np.log1p(n),
        np.log1p(chars / some),
        share(f.per_text(_SYM[f.buf]), chars),
        share(f.per_text(_BANG[f.buf]), n),
        share(f.per_text(_UPPER[f.buf]), letters),
        share(dups, lines),
        share(repeat_words(doc, h, f.n), n),
        share(np.bincount(doc[twice], minlength=f.n), n),
        share(f.per_text(_BAR[f.buf]), n),
        # distinct words against the number expected to be distinct at this length
        np.log((1 + np.bincount(ud, minlength=f.n)) / (1 + some ** 0.9)),
        share(f.per_text(_DIGIT[f.buf]), chars),
        share(f.per_text(_STOP[f.buf]), n),
    ])


def _features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for rows, f in pieces(batches):
        x = features(f)
        cols = [pa.array(x[:, i]) for i in range(x.shape[1])]
        yield pa.RecordBatch.from_arrays([rows.column(0), *cols], names=["doc_id", *FEATURES])


def document_features(df: DataFrame) -> DataFrame:
    src = df.selectExpr("cast(doc_id as bigint) doc_id", "cast(text as string) text")
    return src.mapInArrow(_features, "doc_id bigint, " + ", ".join(f"{k} double" for k in FEATURES))


@dataclass(frozen=True)
class Discriminant:
    prior: float                 # log odds of class 1
    means: tuple                 # per class
    whiten: tuple                # per class: inverse of the Cholesky factor
    log_det: tuple               # per class: log determinant of the covariance

    def score(self, x: np.ndarray) -> np.ndarray:
        if not self.means:
            return np.full(len(x), self.prior)
        d = []
        for c in (0, 1):
            z = (x - self.means[c]) @ self.whiten[c].T
            d.append(-0.5 * (np.einsum("ij,ij->i", z, z) + self.log_det[c]))
        return 1.0 / (1.0 + np.exp(-np.clip(d[1] - d[0] + self.prior, -700, 700)))


def class_sums(train: DataFrame, label: str, columns: tuple[str, ...]) -> dict[int, tuple]:
    """Per class: count, sums and products of the columns (two rows at most)."""
    k = len(columns)
    pairs = [(i, j) for i in range(k) for j in range(i, k)]
    aggs = [F.count(F.lit(1)).alias("n"), *[F.sum(c).alias(f"s{i}") for i, c in enumerate(columns)],
            *[F.sum(F.col(columns[i]) * F.col(columns[j])).alias(f"p{i}_{j}") for i, j in pairs]]
    out = {}
    for r in train.where(F.col(label).isin(0, 1)).groupBy(label).agg(*aggs).collect():
        p = np.zeros((k, k))
        for i, j in pairs:
            p[i, j] = p[j, i] = r[f"p{i}_{j}"]
        out[int(r[label])] = (r["n"], np.array([r[f"s{i}"] for i in range(k)]), p)
    return out


def fit(sums: dict[int, tuple]) -> Discriminant:
    """Without rows of both classes: the share of class 1 (0.5 without any)."""
    if set(sums) != {0, 1}:
        n = {c: sums.get(c, (0,))[0] for c in (0, 1)}
        return Discriminant((n[1] + 1) / (n[0] + n[1] + 2), (), (), ())
    mean, cov = {}, {}
    for c, (n, s, p) in sums.items():
        mean[c] = s / n
        cov[c] = p / n - np.outer(mean[c], mean[c])
    total = sums[0][0] + sums[1][0]
    pooled = sum(sums[c][0] * cov[c] for c in (0, 1)) / total
    whiten, log_det = [], []
    for c in (0, 1):
        v = (1 - TO_POOLED) * cov[c] + TO_POOLED * pooled
        v = (1 - TO_DIAGONAL) * v + TO_DIAGONAL * np.diag(np.diag(v)) + RIDGE * np.eye(len(v))
        low = np.linalg.cholesky(v)
        whiten.append(np.linalg.inv(low))
        log_det.append(2 * float(np.log(np.diag(low)).sum()))
    return Discriminant(float(np.log(sums[1][0] / sums[0][0])), (mean[0], mean[1]), tuple(whiten), tuple(log_det))


def quality_classifier(df: DataFrame, labels: DataFrame, label: str = "quality", threshold: float = THRESHOLD) -> DataFrame:
    """Per row of ``df``: doc_id, held_out, score (chance of label 1), predicted.

    Learns from labelled rows outside the held-out fold; labels that are NULL or
    neither 0 nor 1 are no labels, and an id with both labels teaches both.  NULL
    and empty texts are scored by their (zero) statistics; a NULL id is held out;
    repeated rows are scored each; an empty table gives no rows."""
    x = cut(document_features(df).withColumn("held_out", fold() == 0))
    y = labels.select(id_key().alias("_id"), F.col(label).cast("int").alias("_y")).where(F.col("_y").isin(0, 1)).distinct()
    train = x.where(~F.col("held_out")).join(y, F.col("doc_id") == F.col("_id"))
    model = fit(class_sums(train, "_y", FEATURES))

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            v = np.column_stack([b.column(i).to_numpy(zero_copy_only=False) for i in range(2, 2 + len(FEATURES))])
            p = model.score(v)
            yield pa.RecordBatch.from_arrays(
                [b.column(0), b.column(1), pa.array(p), pa.array((p >= threshold).astype(np.int32))],
                names=["doc_id", "held_out", "score", "predicted"])
    return x.select("doc_id", "held_out", *FEATURES).mapInArrow(
        score, "doc_id bigint, held_out boolean, score double, predicted int")


def op8_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_classifier(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/labels.parquet"))

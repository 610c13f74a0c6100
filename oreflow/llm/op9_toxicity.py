"""Toxicity by weak supervision.

Voters are lexicons and patterns: a fixed word list, and words and word stems
that labelled training rows show to stand in toxic texts.  A generative label
model learns from all their votes how often each voter is right (expectation
maximisation over labelled and unlabelled rows; a label is one more, very
accurate voter) and how strongly voters agree beyond what the class explains;
correlated voters share their weight.  Its posteriors train a linear classifier
over the stems found and the votes, which scores every whole text.

Only the fit uses a sample: at most about MAX_ROWS labelled rows of each class
and MAX_ROWS unlabelled rows, chosen by a hash of the id; so the ids sent to all
tasks, the lexicon (MAX_STEMS) and what the driver holds are bounded.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, IntegerType

from .common import cut, documents, fold, free_name, id_key, without
from .textvec import _U, NOT_LETTER, Flat, Lookup, count_equal, mix, pieces, unique_per_text

MAX_ROWS, MAX_STEMS = 20_000, 4096
# a mined stem stands in MIN_DOCS toxic texts, has these log odds, and a likelihood ratio
# that chance would not reach once among all the stems tried
MIN_DOCS, MIN_LOG_ODDS, SURE = 4, 2.0, 8.0
THRESHOLD = 0.5
# fixed list of the first voter
LEXICON = ("idiot", "moron", "scum", "loser", "worthless", "pathetic", "clown", "trash", "disgusting", "stupid",
           "dumb", "jerk", "hate", "vermin", "filth", "garbage")
PREFIXES = (4, 5, 6)
LABEL_ACCURACY = 0.98
VOTERS = ("lexicon", "words", "weak_words", "stems", "weak_stems", "two", "many", "dense", "nothing")


def stem_hashes(f: Flat) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct (text, hash) of whole words and of word beginnings, and words per
    text.  The last bit of a hash tells a whole word (1) from a beginning (0)."""
    s, e, doc = f.words(NOT_LETTER)
    p = f.prefix()
    docs, hs = zip(*(_kind(p, s, e, doc, k) for k in (0, *PREFIXES)))
    d, h = unique_per_text(np.concatenate(docs), np.concatenate(hs))
    return d, h, np.bincount(doc, minlength=f.n)


def _kind(p: np.ndarray, s: np.ndarray, e: np.ndarray, doc: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Texts and hashes of all whole words (k = 0), or of the first k bytes of longer words."""
    if not k:
        return doc, Flat.hashes(p, s, e) | _U(1)
    long = np.flatnonzero((e - s) > k)
    return doc[long], mix(Flat.hashes(p, s[long], s[long] + k) + _U(k)) & ~_U(1)


def lexicon_hashes() -> np.ndarray:
    b = "\n".join(LEXICON).encode()
    f = Flat(np.frombuffer(b, np.uint8), np.array([0, len(b)], np.int64))
    s, e, _ = f.words(NOT_LETTER)
    return Flat.hashes(f.prefix(), s, e) | _U(1)


@dataclass(frozen=True)
class Stems:
    """The bounded lexicon: hashes, log odds, whether a whole word; the first are the fixed list."""
    hashes: np.ndarray
    odds: np.ndarray
    whole: np.ndarray
    fixed: int

    def find(self, f: Flat, look: Lookup) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Distinct (text, number of a stem in it), and words per text."""
        s, e, doc = f.words(NOT_LETTER)
        p = f.prefix()
        out_d, out_i = [], []
        for k in (0, *PREFIXES):
            d, h = _kind(p, s, e, doc, k)
            i = look(h)
            hit = i >= 0
            out_d.append(d[hit])
            out_i.append(i[hit].astype(np.int64))
        d, i = unique_per_text(np.concatenate(out_d), np.concatenate(out_i))
        return d, i, np.bincount(doc, minlength=f.n)

    def votes(self, d: np.ndarray, i: np.ndarray, words: np.ndarray) -> np.ndarray:
        """Texts x voters: 1 toxic, 0 clean, -1 no vote."""
        n = len(words)
        strong = self.odds >= 4.0
        fixed = np.arange(len(self.hashes)) < self.fixed
        kinds = [fixed, ~fixed & self.whole & strong, ~fixed & self.whole & ~strong,
                 ~self.whole & strong, ~self.whole & ~strong]
        by = [np.bincount(d[k[i]], minlength=n) for k in kinds]
        certain = by[0] + by[1] + by[3]
        every = sum(by)
        v = np.full((n, len(VOTERS)), -1, np.int8)
        for j, b in enumerate(by):
            v[b > 0, j] = 1
        v[certain >= 2, 5] = 1
        v[every >= 6, 6] = 1
        v[certain * 100 >= np.maximum(words, 1), 7] = 1
        v[every == 0, 8] = 0
        return v


@dataclass(frozen=True)
class LabelModel:
    prior: float
    table: np.ndarray        # class x voter x (abstain, clean, toxic)
    share: np.ndarray        # weight of each voter after its correlations

    def posterior(self, votes: np.ndarray, label: np.ndarray | None = None) -> np.ndarray:
        lt = np.log(self.table)
        at = votes.astype(np.int64) + 1
        odds = np.log(self.prior / (1 - self.prior)) + sum(
            self.share[j] * (lt[1, j][at[:, j]] - lt[0, j][at[:, j]]) for j in range(votes.shape[1]))
        if label is not None:
            gold = np.log(LABEL_ACCURACY / (1 - LABEL_ACCURACY))
            odds = odds + np.where(label < 0, 0.0, np.where(label == 1, gold, -gold))
        return 1 / (1 + np.exp(-np.clip(odds, -50, 50)))


def fit_label_model(votes: np.ndarray, label: np.ndarray, rounds: int = 20) -> LabelModel:
    """``label``: 1, 0 or -1 (unknown)."""
    m = votes.shape[1]
    known = label >= 0
    prior = float(np.clip(label[known].mean() if known.any() else 0.1, 0.01, 0.99))
    p = np.where(known, label, np.where((votes == 1).any(axis=1), 0.8, 0.05)).astype(float)
    share = np.ones(m)
    model = LabelModel(prior, np.full((2, m, 3), 1 / 3), share)
    for _ in range(rounds):
        table = np.empty((2, m, 3))
        for c, w in ((0, 1 - p), (1, p)):
            for j in range(m):
                n = np.bincount(votes[:, j].astype(np.int64) + 1, weights=w, minlength=3) + 0.5
                table[c, j] = n / n.sum()
        tox = (votes == 1).astype(float)
        rho = np.zeros((m, m))
        for w in (1 - p, p):
            total = max(w.sum(), 1e-9)
            x = tox - (w @ tox) / total
            v = (x * w[:, None]).T @ x / total
            sd = np.sqrt(np.maximum(np.diag(v), 1e-9))
            rho += 0.5 * np.clip(v / np.outer(sd, sd), 0, 1)
        share = 1 / (1 + rho.sum(axis=1) - np.diag(rho))
        model = LabelModel(prior, table, share)
        p = model.posterior(votes, label)
    return model


def dense_features(votes: np.ndarray, d: np.ndarray, words: np.ndarray) -> np.ndarray:
    hits = np.bincount(d, minlength=len(words))
    return np.column_stack([(votes == 1), (votes == 0), np.log1p(hits), hits / np.maximum(words, 1)]).astype(float)


def fit_linear(dense: np.ndarray, d: np.ndarray, i: np.ndarray, stems: int, target: np.ndarray,
               rounds: int = 300, rate: float = 0.3, l2: float = 2e-4) -> tuple[np.ndarray, np.ndarray]:
    """Logistic regression on soft targets: weights of stems, and of dense features with the bias last."""
    n = len(target)
    x = np.column_stack([dense, np.ones(n)])
    ws, wd = np.zeros(stems), np.zeros(x.shape[1])
    gs, gd = np.full(stems, 1e-8), np.full(x.shape[1], 1e-8)
    for _ in range(rounds):
        z = x @ wd + np.bincount(d, weights=ws[i], minlength=n)
        err = (1 / (1 + np.exp(-np.clip(z, -50, 50))) - target) / n
        g1 = np.bincount(i, weights=err[d], minlength=stems) + l2 * ws / 10
        g2 = x.T @ err + l2 * np.append(wd[:-1], 0)
        gs += g1 * g1
        gd += g2 * g2
        ws -= rate * g1 / np.sqrt(gs)
        wd -= rate * g2 / np.sqrt(gd)
    return ws, wd


@dataclass(frozen=True)
class Model:
    stems: Stems
    ws: np.ndarray
    wd: np.ndarray

    def score(self, f: Flat, look: Lookup) -> np.ndarray:
        d, i, words = self.stems.find(f, look)
        x = dense_features(self.stems.votes(d, i, words), d, words)
        z = x @ self.wd[:-1] + self.wd[-1] + np.bincount(d, weights=self.ws[i], minlength=f.n)
        return 1 / (1 + np.exp(-np.clip(z, -50, 50)))


def training_sample(df: DataFrame, labels: DataFrame, label: str, max_rows: int) -> DataFrame:
    """(text, y) of distinct texts: y 1 or 0 by label, -1 without; see the module's text for the bound.
    An id with both labels counts as toxic."""
    ids = df.select(id_key().alias("_id"), (fold() != 0).alias("_train")).where("_train")
    y = labels.select(id_key().alias("_id"), fold().alias("_f"), F.col(label).cast("int").alias("_y")) \
        .where(F.col("_y").isin(0, 1) & (F.col("_f") != 0)).groupBy("_id").agg(F.max("_y").alias("_y"))
    y = cut(y)
    n = {r["_y"]: r["n"] for r in y.groupBy("_y").agg(F.count(F.lit(1)).alias("n")).collect()}
    rows = ids.count()
    pick = F.pmod(F.xxhash64("_id"), F.lit(1 << 30)) / F.lit(float(1 << 30))
    few = y.where(F.when(F.col("_y") == 1, pick < max_rows / max(n.get(1, 0), 1)).otherwise(pick < max_rows / max(n.get(0, 0), 1)))
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    src = df.select(id_key().alias("_id"), fold().alias("_f"), text.alias("text"))
    # the sample of ids is bounded by max_rows a class: 16 bytes a row
    lab = src.join(F.broadcast(few), "_id")
    free = src.where((F.col("_f") != 0) & (pick < max_rows / max(rows, 1))) \
        .join(F.broadcast(y.where(pick < max_rows / max(rows, 1))), "_id", "left").where(F.col("_y").isNull())
    both = lab.select("text", "_y").unionByName(free.select("text", F.lit(-1).alias("_y")))
    return both.groupBy("text").agg(F.max("_y").cast("int").alias("y"))


def mine_stems(sample: DataFrame, max_stems: int) -> Stems:
    """The fixed list, then words and stems that tell toxic training texts from
    others, by MIN_DOCS, MIN_LOG_ODDS and SURE."""
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, f in pieces(batches):
            y = rows.column(1).to_numpy(zero_copy_only=False)
            d, h, _ = stem_hashes(f)
            tox = (y[d] == 1).astype(np.int64)
            u, n1, _ = count_equal(h, tox)
            _, n, _ = count_equal(h)
            yield pa.RecordBatch.from_arrays([pa.array(u.view(np.int64)), pa.array(n1), pa.array((n - n1).astype(np.int64))],
                                             names=["h", "n1", "n0"])
    lab = sample.where(F.col("y") >= 0)
    n = {r["y"]: r["n"] for r in lab.groupBy("y").agg(F.count(F.lit(1)).alias("n")).collect()}
    n1, n0 = n.get(1, 0), n.get(0, 0)
    odds = F.log((F.col("n1") + 0.5) / F.lit(n1 + 1.0)) - F.log((F.col("n0") + 0.5) / F.lit(n0 + 1.0))
    tried = cut(lab.select("text", "y").mapInArrow(count, "h bigint, n1 bigint, n0 bigint")
                .groupBy("h").agg(F.sum("n1").alias("n1"), F.sum("n0").alias("n0")).where(F.col("n1") >= MIN_DOCS))
    share = min(max(n1 / max(n1 + n0, 1), 1e-6), 1 - 1e-6)
    seen = F.col("n1") + F.col("n0")
    part = lambda c, p: F.when(F.col(c) > 0, F.col(c) * F.log(F.col(c) / (seen * F.lit(p)))).otherwise(0.0)
    ratio = 2 * (part("n1", share) + part("n0", 1 - share))
    enough = 2 * float(np.log(max(tried.count(), 1))) + SURE
    got = tried.withColumn("odds", odds).where((F.col("odds") >= MIN_LOG_ODDS) & (ratio >= enough)) \
        .orderBy((F.col("odds") * F.col("n1")).desc(), "h").limit(max_stems).collect()
    fixed = lexicon_hashes()
    mined = np.array([r["h"] for r in got], np.int64).view(np.uint64)
    o = np.array([r["odds"] for r in got])
    new = ~np.isin(mined, fixed)
    return Stems(np.concatenate([fixed, mined[new]]), np.concatenate([np.full(len(fixed), 4.0), o[new]]),
                 np.concatenate([fixed, mined[new]]) & _U(1) == _U(1), len(fixed))


def fit(df: DataFrame, labels: DataFrame, label: str = "toxic", max_rows: int = MAX_ROWS,
        max_stems: int = MAX_STEMS) -> Model:
    sample = cut(training_sample(df, labels, label, max_rows))
    stems = mine_stems(sample, max_stems)

    def hits(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        look = Lookup(stems.hashes)
        for rows, f in pieces(batches):
            d, i, words = stems.find(f, look)
            at = np.searchsorted(d, np.arange(f.n + 1))
            yield pa.RecordBatch.from_arrays(
                [rows.column(1), pa.array(words.astype(np.int64)), pa.ListArray.from_arrays(pa.array(at, pa.int32()), pa.array(i))],
                names=["y", "words", "hits"])
    got = sample.select("text", "y").mapInArrow(hits, "y int, words bigint, hits array<bigint>").toArrow()
    y = got.column("y").to_numpy().astype(np.int64)
    words = got.column("words").to_numpy()
    lists = got.column("hits").combine_chunks()
    sizes = np.diff(lists.offsets.to_numpy()) if len(lists) else np.zeros(0, np.int64)
    d, i = np.repeat(np.arange(len(y)), sizes), lists.flatten().to_numpy().astype(np.int64)
    votes = stems.votes(d, i, words)
    dense = dense_features(votes, d, words)
    if not (y == 1).any():
        # nothing to learn from: the fixed list alone decides
        ws = np.where(np.arange(len(stems.hashes)) < stems.fixed, 4.0, 0.0)
        return Model(stems, ws, np.append(np.zeros(2 * len(VOTERS) + 2), -2.0))
    target = fit_label_model(votes, y).posterior(votes, y)
    ws, wd = fit_linear(dense, d, i, len(stems.hashes), target)
    return Model(stems, ws, wd)


def toxicity(df: DataFrame, labels: DataFrame, label: str = "toxic", threshold: float = THRESHOLD,
             max_rows: int = MAX_ROWS) -> DataFrame:
    """``df`` with held_out, score (chance of label 1) and predicted.

    Columns of those names in ``df`` are replaced, others stay.  Learns from
    labelled rows outside the held-out fold.  NULL and empty texts get the score
    of a text without any hit; a NULL id is held out; repeated rows are scored
    each; an empty table gives no rows; without toxic labels the fixed list
    alone decides."""
    model = fit(df, labels, label, max_rows)
    base = without(df, ["held_out", "score", "predicted"])
    base = base.withColumn("held_out", fold() == 0)
    tmp = free_name(base, "_text")
    src = base.withColumn(tmp, F.col("text").cast("string"))
    names = [*base.columns, "score", "predicted"]
    schema = base.schema.add("score", DoubleType(), False).add("predicted", IntegerType(), False)

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        look = Lookup(model.stems.hashes)
        for rows, f in pieces(batches, tmp):
            p = model.score(f, look)
            cols = [rows.column(j) for j in range(rows.num_columns - 1)]
            yield pa.RecordBatch.from_arrays([*cols, pa.array(p), pa.array((p >= threshold).astype(np.int32))],
                                             names=names)
    return src.mapInArrow(score, schema)


def op9_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = toxicity(documents(spark, sf_dir).select("doc_id", "text"), spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return out.select("doc_id", "held_out", "score", "predicted")

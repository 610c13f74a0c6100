"""Embedding whitening by polarised covariances.

A vector's entries become whole numbers (floor of SCALE times the entry, plus
SHIFT), so sums are exact.  The fit list holds each distinct vector once.
Variances of single dimensions and of sums of two dimensions are squares
alone: with V(i) and V(i+j) known, polarisation gives the covariance
(V(i+j) - V(i) - V(j)) / 2.  Tasks centre each vector at the whole number next
to the mean, add up squares of every dimension and of every pair's sum, and
send one exact total per pair; what the rounded centre is off by is taken out
exactly at the end.  The matrix has the square of the dimension entries,
whatever the number of rows; eigh of it gives the components.

Totals travel as limbs of 30 bits, so no size of number or table overflows.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import cut, free_name, wider, without

SCALE, SHIFT = 64, 1_000_000
COMPONENTS = 16
LIMB, LIMBS = 30, 6
ROWS = 512                # vectors whose pair sums are held at a time


def _limbs(totals: list[int]) -> list[list[int]]:
    """Signed limbs, lowest first: a number of any sign is their weighted sum."""
    out = []
    for t in totals:
        sign, t, own = (-1 if t < 0 else 1), abs(t), []
        for _ in range(LIMBS - 1):
            own.append(sign * (t & (1 << LIMB) - 1))
            t >>= LIMB
        out.append([*own, sign * t])
    return [list(x) for x in zip(*out)] or [[] for _ in range(LIMBS)]


_SUMS = "dim int, k int, " + ", ".join(f"l{i} bigint" for i in range(LIMBS))


def _batch(dim: int, totals: list[int]) -> pa.RecordBatch:
    n = len(totals)
    return pa.RecordBatch.from_arrays(
        [pa.array([dim] * n, pa.int32()), pa.array(range(n), pa.int32()), *[pa.array(x, pa.int64()) for x in _limbs(totals)]],
        names=["dim", "k", *[f"l{i}" for i in range(LIMBS)]])


def _by_dim(b: pa.RecordBatch, col: int) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """Dimension, row numbers and matrix of the vectors of each dimension."""
    lists = b.column(col)
    offs = lists.offsets.to_numpy().astype(np.int64)
    values = lists.values.to_numpy(zero_copy_only=False)
    n = np.diff(offs)
    for d in np.unique(n):
        rows = np.flatnonzero(n == d)
        if d:
            yield int(d), rows, values[offs[rows][:, None] + np.arange(d)]
        else:
            yield 0, rows, np.zeros((len(rows), 0), np.int64)


def _wide(x: np.ndarray, terms: int) -> np.ndarray:
    """Python's own integers where squares of ``terms`` entries could pass 2^63."""
    most = int(np.abs(x).max()) if x.size and x.dtype != object else 0
    return x if x.dtype != object and most * most * max(terms, 1) < 1 << 62 else x.astype(object)


def _count_and_sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Number of vectors (k = 0) and sum of each dimension (k = 1 ..)."""
    held: dict[int, list[int]] = {}
    for b in batches:
        for d, rows, x in _by_dim(b, 0):
            own = [len(rows), *(int(v) for v in _wide(x, len(rows)).sum(axis=0))]
            held[d] = [a + c for a, c in zip(held[d], own)] if d in held else own
    for d, totals in held.items():
        yield _batch(d, totals)


def _pairs(d: int) -> tuple[np.ndarray, np.ndarray]:
    """Every dimension (paired with itself), then every pair of two."""
    i, j = np.triu_indices(d, 1)
    return np.concatenate([np.arange(d), i]), np.concatenate([np.arange(d), j])


def _squares(batches: Iterator[pa.RecordBatch], centre: dict[int, np.ndarray]) -> Iterator[pa.RecordBatch]:
    """Sums of squares of centred dimensions and of centred pair sums."""
    held: dict[int, list[int]] = {}
    for b in batches:
        for d, _, x in _by_dim(b, 0):
            i, j = _pairs(d)
            for at in range(0, len(x), ROWS):
                part = _wide(x[at:at + ROWS] - centre[d], 4 * ROWS)
                # a dimension alone, not twice itself
                own = np.concatenate([(part * part).sum(axis=0), ((part[:, i[d:]] + part[:, j[d:]]) ** 2).sum(axis=0)])
                own = [int(v) for v in own]
                held[d] = [a + c for a, c in zip(held[d], own)] if d in held else own
    for d, totals in held.items():
        yield _batch(d, totals)


def _totals(rows: DataFrame) -> dict[int, list[int]]:
    """One number per dimension or pair: its size is that of the matrix."""
    got = rows.groupBy("dim", "k").agg(*[F.sum(f"l{i}").alias(f"l{i}") for i in range(LIMBS)]).collect()
    out: dict[int, dict[int, int]] = {}
    for r in got:
        out.setdefault(r["dim"], {})[r["k"]] = sum(r[f"l{i}"] << (LIMB * i) for i in range(LIMBS))
    return {d: [v[k] for k in range(len(v))] for d, v in out.items()}


@dataclass(frozen=True)
class Whitening:
    """Fit of the vectors of one dimension."""
    n: int
    sums: list[int]
    centre: list[int]             # whole number next to each mean
    covariance: np.ndarray
    values: np.ndarray            # falling
    vectors: np.ndarray           # columns: unit components
    explained: np.ndarray

    @staticmethod
    def of(count_and_sums: list[int], centre: list[int], squares: list[int]) -> Whitening:
        n, sums = count_and_sums[0], count_and_sums[1:]
        d = len(sums)
        off = [s - n * c for s, c in zip(sums, centre)]            # n times what the centre is off by
        i, j = _pairs(d)
        variance = [n * q - ((off[a] + off[b]) if a != b else off[a]) ** 2
                    for q, a, b in zip(squares, i.tolist(), j.tolist())]     # times n squared, exact
        cov = np.zeros((d, d))
        square = n * n
        for k, (a, b) in enumerate(zip(i.tolist(), j.tolist())):
            whole = 2 * variance[a] if a == b else variance[k] - variance[a] - variance[b]
            cov[a, b] = cov[b, a] = whole / (2 * square)           # of whole numbers: rounded once
        e, v = np.linalg.eigh(cov) if d else (np.zeros(0), np.zeros((0, 0)))
        e, v = e[::-1], v[:, ::-1]
        trace = float(np.trace(cov))
        return Whitening(n, sums, centre, cov, e, v, e / trace if trace > 0 else np.zeros(d))

    def scale(self, components: int) -> np.ndarray:
        """1 / root of each eigenvalue; 0 where it is nothing but rounding."""
        e = self.values[:components]
        least = max(float(self.values[0]) if len(self.values) else 0.0, 0.0) * len(self.sums) * np.finfo(float).eps
        return np.where(e > least, 1 / np.sqrt(np.where(e > least, e, 1.0)), 0.0)

    def whitened(self, x: np.ndarray, components: int) -> np.ndarray:
        away = (x - np.array(self.centre, x.dtype)).astype(float)
        away -= np.array([(s - self.n * c) / self.n for s, c in zip(self.sums, self.centre)])
        return away @ self.vectors[:, :components] * self.scale(components)

    def deviation(self, x: np.ndarray) -> list[int]:
        """Sum over dimensions of (n * x - sum) ** 2, exact."""
        away = _wide(x - np.array(self.centre, x.dtype), x.shape[1])
        off = [s - self.n * c for s, c in zip(self.sums, self.centre)]
        bound = max([abs(o) for o in off], default=0) * (int(np.abs(away).max()) if away.size else 0) * max(len(off), 1)
        across = away @ np.array(off, np.int64) if bound < 1 << 62 and away.dtype != object else \
            away.astype(object) @ np.array(off, object)
        own = (away * away).sum(axis=1)
        rest = sum(o * o for o in off)
        return [self.n * self.n * int(q) - 2 * self.n * int(c) + rest for q, c in zip(own, across)]


def _moments(batches: Iterator[pa.RecordBatch], fits: dict[int, Whitening], components: int) -> Iterator[pa.RecordBatch]:
    held: dict[int, np.ndarray] = {}
    for b in batches:
        for d, _, x in _by_dim(b, 0):
            w = fits[d].whitened(x, components)
            held[d] = held.get(d, 0) + (w.T @ w).ravel()
    for d, m in held.items():
        yield pa.RecordBatch.from_arrays([pa.array([d] * len(m), pa.int32()), pa.array(range(len(m)), pa.int32()), pa.array(m)],
                                         names=["dim", "k", "v"])


def _identity_errors(fit_list: DataFrame, fits: dict[int, Whitening], components: int) -> dict[int, float]:
    """Largest absolute entry of the whitened fit list's covariance minus the identity."""
    got = fit_list.mapInArrow(lambda it: _moments(it, fits, components), "dim int, k int, v double") \
        .groupBy("dim", "k").agg(F.sum("v").alias("v")).collect()
    out = {}
    for d, fit in fits.items():
        k = min(components, d)
        m = np.zeros(k * k)
        for r in got:
            if r["dim"] == d:
                m[r["k"]] = r["v"] / fit.n
        want = np.diag((fit.scale(k) > 0).astype(float))
        out[d] = float(np.abs(m.reshape(k, k) - want).max()) if k else 0.0
    return out


def whole_numbers(df: DataFrame, embedding: str, out: str) -> DataFrame:
    """``df`` without the rows whose vector is NULL or holds NULL or numbers that
    aren't finite, and with the array of whole numbers ``out``."""
    v = F.col(f"`{embedding}`").cast("array<double>")
    finite = F.forall(v, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf")))
    x = F.transform(v, lambda c: F.floor(c * F.lit(float(SCALE))).cast("long") + F.lit(SHIFT))
    return df.where(v.isNotNull() & finite).withColumn(out, x)


def fit(x: DataFrame, components: int = COMPONENTS) -> tuple[dict[int, Whitening], dict[int, float]]:
    """Fits by dimension, from the only column of ``x`` (arrays of whole numbers),
    and the identity error of each."""
    fit_list = cut(x.distinct())
    first = _totals(fit_list.mapInArrow(_count_and_sums, _SUMS))
    centre = {d: [(2 * s + t[0]) // (2 * t[0]) for s in t[1:]] for d, t in first.items()}
    held = {d: np.array(c, np.int64) for d, c in centre.items()}
    second = _totals(fit_list.mapInArrow(lambda it: _squares(it, held), _SUMS))
    fits = {d: Whitening.of(t, centre[d], second.get(d, [])) for d, t in first.items()}
    return fits, _identity_errors(fit_list, fits, components)


def _apply(batches: Iterator[pa.RecordBatch], fits: dict[int, Whitening], errors: dict[int, float],
           components: int, col: str) -> Iterator[pa.RecordBatch]:
    for b in batches:
        at = b.schema.get_field_index(col)
        n, deviation, white, explained, error = ([None] * b.num_rows for _ in range(5))
        for d, rows, x in _by_dim(b, at):
            f = fits[d]
            w, dev, share = f.whitened(x, components), f.deviation(x), f.explained[:components].tolist()
            for k, r in enumerate(rows):
                n[r], deviation[r], white[r], explained[r], error[r] = f.n, Decimal(dev[k]), w[k].tolist(), share, errors[d]
        rest = [i for i in range(b.num_columns) if i != at]
        yield pa.RecordBatch.from_arrays(
            [*[b.column(i) for i in rest], pa.array(n, pa.int64()), pa.array(deviation, pa.decimal128(38, 0)),
             pa.array(white, pa.list_(pa.float64())), pa.array(explained, pa.list_(pa.float64())), pa.array(error, pa.float64())],
            names=[*[b.schema.names[i] for i in rest], "n", "deviation", "whitened", "explained", "identity_error"])


def whiten(df: DataFrame, embedding: str = "embedding", components: int = COMPONENTS) -> DataFrame:
    """The rows of ``df`` with a whole vector, with n (distinct vectors), deviation
    (exact), whitened and explained (arrays by component, eigenvalues falling)
    and identity_error.

    Rows whose vector is NULL or holds NULL, infinite or NaN entries go; repeated
    rows stay but count once in the fit; vectors of another length are another
    space with a fit of its own; empty vectors get empty arrays.  A component
    without variance (one vector, or a constant or dependent dimension) is 0 for
    every row.  An entry whose whole number passes 64 bits is an error under
    ANSI rules.  Columns with the names of the new ones are replaced, all others
    are kept; an empty table gives no rows."""
    x = free_name(df, "_x")
    src = whole_numbers(df, embedding, x)
    fits, errors = fit(src.select(x), components)
    src = without(src, ["n", "deviation", "whitened", "explained", "identity_error"])
    schema = wider(without(src, [x]), "n bigint, deviation decimal(38,0), whitened array<double>, "
                   "explained array<double>, identity_error double")
    return src.mapInArrow(lambda it: _apply(it, fits, errors, components, x), schema)


def op13_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    w = whiten(spark.read.parquet(f"{sf_dir}/embeddings.parquet").select("vec_id", "embedding"))
    return w.select("vec_id", F.col("n"), F.col("deviation").cast("long").alias("deviation"), "identity_error",
                    F.posexplode(F.arrays_zip("whitened", "explained")).alias("at", "c")) \
        .select("vec_id", (F.col("at") + 1).cast("int").alias("component"), "n", "deviation",
                F.col("c.whitened").alias("whitened"), F.col("c.explained").alias("explained"), "identity_error")

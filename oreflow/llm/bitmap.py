"""A fixed-size filter over 64-bit keys that every task can hold.

It only spares a shuffle rows that surely don't match; an exact join follows.
Its size follows the number of keys up to a bound, so the copy sent to the
tasks never exceeds MAX_BITS; beyond that it lets more rows through.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .textvec import _U, mix

MIN_BITS, MAX_BITS, BITS_PER_KEY = 16, 27, 24
_SLICES = 16


def _places(h: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray]:
    a = mix(h)
    return (a >> _U(64 - bits)).astype(np.int64), (mix(a + _U(1)) >> _U(64 - bits)).astype(np.int64)


@dataclass(frozen=True)
class Bitmap:
    bits: int
    packed: np.ndarray

    def __call__(self, h: np.ndarray) -> np.ndarray:
        """Numbers of the keys that may be in the set."""
        a, b = _places(h, self.bits)
        i = np.flatnonzero((self.packed[a >> 3] >> (a & 7).astype(np.uint8)) & 1)
        b = b[i]
        return i[((self.packed[b >> 3] >> (b & 7).astype(np.uint8)) & 1) == 1]


def build(keys: DataFrame) -> Bitmap:
    """Of the first column (64-bit numbers) of ``keys``, which is read twice."""
    n = keys.count()
    bits = min(MAX_BITS, max(MIN_BITS, (n * BITS_PER_KEY).bit_length()))
    part = (1 << bits) // _SLICES

    def places(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            p = np.concatenate(_places(b.column(0).to_numpy(zero_copy_only=False).astype(np.int64).view(np.uint64), bits))
            yield pa.RecordBatch.from_arrays([pa.array(p // part), pa.array(p % part)], names=["slice", "p"])

    def slices(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, np.ndarray] = {}
        for b in batches:
            s, p = (b.column(i).to_numpy() for i in (0, 1))
            for k in np.unique(s):
                held.setdefault(int(k), np.zeros(part, bool))[p[s == k]] = True
        for k, m in held.items():
            yield pa.RecordBatch.from_arrays([pa.array([k]), pa.array([np.packbits(m, bitorder="little").tobytes()])],
                                             names=["slice", "packed"])

    got = keys.mapInArrow(places, "slice bigint, p bigint").repartition(_SLICES, "slice") \
        .mapInArrow(slices, "slice bigint, packed binary").collect()
    packed = np.zeros((1 << bits) // 8, np.uint8)
    for r in got:
        packed[r["slice"] * part // 8:(r["slice"] + 1) * part // 8] = np.frombuffer(r["packed"], np.uint8)
    return Bitmap(bits, packed)

"""Running sums over a sorted table, with no window and no group that holds a key.

``ordered`` sorts by ranges, so a key of any size lies in neighbouring
partitions; ``running_sums`` needs one row per partition to carry sums over."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import cut

PART = "_part"


def ordered(df: DataFrame, *cols: str) -> DataFrame:
    """``df`` by ranges of ``cols``, each partition sorted, written once; the
    partition's number is a column, so later plans can't change it."""
    return cut(df.repartitionByRange(*cols).sortWithinPartitions(*cols).withColumn(PART, F.spark_partition_id()))


def running_sums(df: DataFrame, key: str, read: str, values: Callable[[pa.RecordBatch], list[np.ndarray]],
                 result: Callable[[pa.RecordBatch, list[np.ndarray], list[np.ndarray]], pa.RecordBatch],
                 schema: str) -> DataFrame:
    """Sums (modulo 2^64) of ``values`` from each key's first row to the row, in
    the order of ``df`` (of ``ordered``, by ``key`` first; a 64-bit number, not
    NULL).  ``result`` makes output rows of a batch, its values and its sums."""

    def ends(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = first = last = None
        sums: list[int] = []
        for b in batches:
            if not b.num_rows:
                continue
            k = b.column(b.schema.get_field_index(key)).to_numpy()
            part = b.column(b.schema.get_field_index(PART))[0].as_py()
            first = int(k[0]) if first is None else first
            at = int(np.searchsorted(k, k[-1]))
            own = [int(v[at:].sum(dtype=np.uint64)) for v in values(b)]
            sums = [(a + c) % (1 << 64) for a, c in zip(sums, own)] if at == 0 and last == int(k[0]) else own
            last = int(k[-1])
        if part is not None:
            yield pa.RecordBatch.from_arrays([pa.array([x]) for x in (part, first, last, [str(s) for s in sums])],
                                             names=["part", "first", "last", "sums"])

    rows = sorted(df.select(*read.split(), PART).mapInArrow(ends, "part bigint, first bigint, last bigint, sums array<string>").collect())
    carry: dict[int, tuple[int, list[int]]] = {}
    held: tuple[int, list[int]] | None = None
    for r in rows:
        sums = [int(s) for s in r["sums"]]
        if held and held[0] == r["first"]:
            carry[r["part"]] = held
            if r["first"] == r["last"]:
                sums = [(a + c) % (1 << 64) for a, c in zip(held[1], sums)]
        held = (r["last"], sums)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        state = None
        for n, b in enumerate(b for b in batches if b.num_rows):
            k = b.column(b.schema.get_field_index(key)).to_numpy()
            if n == 0:
                state = carry.get(b.column(b.schema.get_field_index(PART))[0].as_py())
            own = values(b)
            start = np.flatnonzero(np.append(True, k[1:] != k[:-1]))
            size = np.diff(np.append(start, len(k)))
            sums = []
            for i, v in enumerate(own):
                total = np.cumsum(v, dtype=np.uint64)
                before = np.append(np.uint64(0), total)[start]
                if state and state[0] == int(k[0]):
                    before[0] -= np.uint64(state[1][i])
                sums.append(total - np.repeat(before, size))
            state = (int(k[-1]), [int(s[-1]) for s in sums])
            yield result(b, own, sums)

    return df.select(*read.split(), PART).mapInArrow(run, schema)

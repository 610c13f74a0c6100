"""Cost-balanced sequence packing.

Documents become token ids closed by id 0.  Whole sequences are cut off long
documents first.  The remainders of a block of documents are laid, longest
first, into as many sequences as their tokens fill: each goes to the sequence
of the lowest attention cost so far (LINEAR * n + QUADRATIC * n^2 for a piece of
n tokens, as attention stays inside a piece) that has room for it.  What finds
no room whole is cut to fill the gaps; what is left then (under one sequence)
joins the next block, so only a partition's last sequence is padded.

Packing needs no shuffle: a task packs its own partition block by block, holding
one block of remainders.  Sequence ids carry the partition number; a task that
runs again on the same split gives the same pieces.
"""

from __future__ import annotations

import json
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession

from .common import documents

CAPACITY = 1024
# cost of a piece of n tokens: LINEAR * n + QUADRATIC * n * n
LINEAR, QUADRATIC = 1.0, 1.0 / 512
BLOCK = 4096          # remainders packed together
RUN = 20_000          # texts longer than this go to the tokenizer library itself

SCHEMA = ("doc_id bigint, start bigint, length bigint, ids_crc32 bigint, doc_tokens bigint, "
          "sequence_id bigint, offset bigint")


def vocabulary_path() -> str:
    import public_tokenizers
    return public_tokenizers.path("byte_bpe_50k.json")


def _byte_letters() -> dict[str, int]:
    """The printable stand-ins of byte-level BPE: printable Latin-1 bytes stand
    for themselves, the others take the code points from 256 on, in order."""
    own = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in set(own)]
    return {chr(b): b for b in own} | {chr(256 + i): b for i, b in enumerate(rest)}


class Tokenizer:
    """Ids of the vocabulary file.  The faster of two installed libraries reads
    the same ranks; very long texts go to the one the file is made for (tests
    hold both equal)."""

    def __init__(self, path: str):
        import public_tokenizers
        import tiktoken
        from tokenizers import Tokenizer as Own
        spec = json.load(open(path, encoding="utf-8"))
        letters = _byte_letters()
        special = {t["content"]: t["id"] for t in spec.get("added_tokens", [])}
        ranks = {bytes(letters[c] for c in w): i for w, i in spec["model"]["vocab"].items() if w not in special}
        self.fast = tiktoken.Encoding("file", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks,
                                      special_tokens=special)
        self.own = Own.from_file(path)

    def __call__(self, text: str) -> list[int]:
        if len(text) > RUN and max(map(len, text.split(" "))) > 1000:
            return self.own.encode(text, add_special_tokens=False).ids
        return self.fast.encode(text, allowed_special="all")


_tokenizers: dict[str, Tokenizer] = {}


def tokenizer(path: str) -> Tokenizer:
    if path not in _tokenizers:
        _tokenizers[path] = Tokenizer(path)
    return _tokenizers[path]


def cost(n):
    return LINEAR * n + QUADRATIC * n * n


def pack_block(lengths: np.ndarray, capacity: int, last: bool) -> list[tuple[int, int, int, int]]:
    """Lay pieces of ``lengths`` (each below ``capacity``) into sequences.

    Returns (piece, start in the piece, tokens, sequence).  Unless ``last``, the
    tokens beyond the whole sequences (fewer than ``capacity``) are left out."""
    total = int(lengths.sum())
    bins = total // capacity
    room = np.full(bins, capacity, np.int64)
    load = np.zeros(bins)
    out, over = [], []
    for i in np.argsort(-lengths, kind="stable"):
        n = int(lengths[i])
        if bins:
            fits = np.where(room >= n, load, np.inf)
            b = int(np.argmin(fits))
            if fits[b] < np.inf:
                out.append((int(i), 0, n, b))
                room[b] -= n
                load[b] += cost(n)
                continue
        over.append(int(i))
    gaps = [int(b) for b in np.argsort(-room, kind="stable") if room[b]]
    used = 0
    for i in over:
        at, n = 0, int(lengths[i])
        while n and gaps:
            b = gaps[0]
            k = min(n, int(room[b]))
            out.append((i, at, k, b))
            room[b] -= k
            at, n = at + k, n - k
            if not room[b]:
                gaps.pop(0)
        if n and last:
            # all that is left is less than one sequence
            out.append((i, at, n, bins))
            used += n
    return out


def _pack(batches: Iterator[pa.RecordBatch], path: str, capacity: int, ids: bool) -> Iterator[pa.RecordBatch]:
    tok = tokenizer(path)
    base = (TaskContext.get().partitionId() if TaskContext.get() else 0) << 36
    seq = 0
    rest: list[tuple] = []        # (doc_id, start, ids, doc_tokens) below one sequence
    rows: list[tuple] = []

    def put(doc, start, part, total, sequence, offset):
        row = (doc, start, len(part), zlib.crc32(part.tobytes()), total, base + sequence, offset)
        rows.append(row + (part.tolist(),) if ids else row)

    def flush(last: bool):
        nonlocal seq, rest
        laid = pack_block(np.array([len(r[2]) for r in rest], np.int64), capacity, last)
        offset: dict[int, int] = {}
        taken = [0] * len(rest)
        for i, at, n, b in laid:
            doc, start, part, total = rest[i]
            put(doc, start + at, part[at:at + n], total, seq + b, offset.get(b, 0))
            offset[b] = offset.get(b, 0) + n
            taken[i] = max(taken[i], at + n)
        seq += len(offset)
        rest = [(d, s + k, p[k:], t) for (d, s, p, t), k in zip(rest, taken) if k < len(p)]

    def drain():
        cols = list(zip(*rows)) or [()] * (8 if ids else 7)
        fields = [pa.field(n, pa.int64()) for n in ("doc_id", "start", "length", "ids_crc32", "doc_tokens",
                                                    "sequence_id", "offset")]
        if ids:
            fields.append(pa.field("ids", pa.list_(pa.int32())))
        batch = pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(cols, fields)], schema=pa.schema(fields))
        rows.clear()
        return batch

    for b in batches:
        docs, texts = b.column(0), b.column(1)
        for j in range(b.num_rows):
            a = np.array([*tok(texts[j].as_py() or ""), 0], dtype="<u4")
            doc, whole = docs[j].as_py(), len(a) // capacity * capacity
            for at in range(0, whole, capacity):
                put(doc, at, a[at:at + capacity], len(a), seq, 0)
                seq += 1
            if whole < len(a):
                rest.append((doc, whole, a[whole:], len(a)))
            if len(rest) >= BLOCK:
                flush(False)
            if len(rows) >= 20_000:
                yield drain()
    flush(True)
    yield drain()


def pack(df: DataFrame, text: str = "text", doc_id: str = "doc_id", capacity: int = CAPACITY,
         path: str | None = None, ids: bool = False) -> DataFrame:
    """One row per piece: its document, first token and number of tokens in it,
    CRC-32 of its ids, the document's tokens, its sequence and its place there.

    NULL and empty texts are a document of the closing id alone; a NULL id stays
    NULL; repeated rows are packed each; other columns of ``df`` play no part;
    an empty table gives no rows.  ``ids`` adds the token ids themselves."""
    path = path or vocabulary_path()
    schema = SCHEMA + (", ids array<int>" if ids else "")
    src = df.selectExpr(f"cast(`{doc_id}` as bigint) as doc_id", f"cast(`{text}` as string) as text")
    return src.mapInArrow(lambda it: _pack(it, path, capacity, ids), schema)


def op1_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(documents(spark, sf_dir))

"""Whole-batch text kernels in numpy over Arrow string columns.

A batch's texts lie one after the other in one byte buffer; words, lines and
their 64-bit hashes come out of it as arrays, without a Python loop per word.
Work goes in pieces of half a MB so a task's memory does not depend on the size
of Arrow's batches.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa

CHUNK_BYTES = 1 << 19
LONG = 64        # bytes that range_hashes takes in blocks

_U = np.uint64
_P = 0x9E3779B97F4A7C15 | 1
_PINV = pow(_P, -1, 1 << 64)


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser: every input bit reaches every output bit."""
    x = x ^ (x >> _U(31))
    x = x * _U(0x7FB5D329728EA185)
    x = x ^ (x >> _U(27))
    x = x * _U(0x81DADEF4BC2DD44D)
    return x ^ (x >> _U(33))


_BYTE = mix(np.arange(1, 257, dtype=np.uint64) * _U(0xD1342543DE82EF95))
_BYTE_OTHER = mix(np.arange(1, 257, dtype=np.uint64) * _U(0xA0761D6478BD642F))
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_BYTE_LOWER = _BYTE[_LOWER]
SPACE = np.zeros(256, bool)
SPACE[[32, 9, 10, 11, 12, 13]] = True
NOT_LETTER = np.ones(256, bool)
NOT_LETTER[65:91] = NOT_LETTER[97:123] = NOT_LETTER[128:] = False

# masks of the first 0 .. 8 bytes of a little-endian block
_KEEP = np.array([(1 << 8 * k) - 1 for k in range(9)], np.uint64)

_powers: dict[str, np.ndarray] = {}


def _pow(n: int) -> tuple[np.ndarray, np.ndarray]:
    if len(_powers.get("p", ())) < n + 1:
        for k, base in (("p", _P), ("i", _PINV)):
            a = np.full(max(n, CHUNK_BYTES) + 1, _U(base))
            a[0] = 1
            _powers[k] = np.cumprod(a, dtype=np.uint64)
    return _powers["p"], _powers["i"]


class Flat:
    """Bytes of several texts: ``buf`` and offsets ``offs`` (one more than texts)."""

    def __init__(self, buf: np.ndarray, offs: np.ndarray):
        self.buf, self.offs, self.n = buf, offs, len(offs) - 1

    def prefix(self, lower: bool = True, other: bool = False) -> np.ndarray:
        """Running polynomial sums; ``hashes`` reads any byte range from them (windows
        of bounded length only: long patterned ranges can meet; see ``range_hashes``).
        ``other`` gives sums of a second hash (case kept)."""
        p, _ = _pow(len(self.buf))
        s = np.empty(len(self.buf) + 1, np.uint64)
        s[0] = 0
        x = (_BYTE_OTHER if other else _BYTE_LOWER if lower else _BYTE)[self.buf]
        x *= p[:len(x)]
        np.cumsum(x, out=s[1:])
        return s

    def range_hashes(self, starts: np.ndarray, ends: np.ndarray, lower: bool = True) -> np.ndarray:
        """Hashes of byte ranges, eight bytes at a time: each block goes through the
        finaliser together with what came before, in two lanes of their own
        constants.  Ranges of up to eight bytes that are equally long never
        collide; no sum or polynomial is there to be met by a pattern of bytes.
        Ranges of more than LONG bytes get their BLAKE2b digest, one by one."""
        n = (ends - starts).astype(np.int64)
        buf = _LOWER[self.buf] if lower else self.buf
        long = np.flatnonzero(n > LONG)
        if len(long):
            out = np.empty(len(n), np.uint64)
            view = memoryview(buf.tobytes())
            out[long] = np.frombuffer(b"".join(
                hashlib.blake2b(view[a:b], digest_size=8).digest() for a, b in zip(starts[long].tolist(), ends[long].tolist())), "<u8")
            rest = np.flatnonzero(n <= LONG)
            out[rest] = self.range_hashes(starts[rest], ends[rest], lower)
            return out
        padded = np.concatenate([buf, np.zeros(8, np.uint8)])
        eight = np.ndarray(len(buf) + 1, "<u8", padded, strides=(1,))
        a = mix(n.astype(np.uint64) * _U(0x9FB21C651E98DF25) + _U(0x1F83D9ABFB41BD6B))
        b = np.zeros(0, np.uint64)
        left, at, rows = n, starts.astype(np.int64), None
        short = np.minimum(left, 8)
        a = mix(a ^ (eight[at] & _KEEP[short]))
        rows = np.flatnonzero(left > 8)
        if len(rows):
            # the second lane starts from the first block, with another constant
            b = mix((eight[at[rows]] + _U(0xC2B2AE3D27D4EB4F)) * _U(0xD6E8FEB86659FD93))
            h, left, at, live = a[rows], left[rows] - 8, at[rows] + 8, np.arange(len(rows))
            while len(live):
                block = eight[at[live]] & _KEEP[np.minimum(left[live], 8)]
                h[live] = mix(h[live] ^ block)
                b[live] = mix((b[live] + block) * _U(0xD6E8FEB86659FD93) + _U(1))
                left[live] -= 8
                at[live] += 8
                live = live[left[live] > 0]
            a[rows] = mix(h ^ (b * _U(0x2545F4914F6CDD1D)))
        return a

    @staticmethod
    def hashes(prefix: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        _, inv = _pow(len(prefix) - 1)
        return mix((prefix[ends] - prefix[starts]) * inv[starts] + (ends - starts).astype(np.uint64))

    def words(self, sep: np.ndarray = SPACE) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Start, end and text number of each word (runs of bytes not in ``sep``)."""
        if not len(self.buf):
            z = np.zeros(0, np.int64)
            return z, z, z
        space = sep[self.buf]
        edge = self.offs[:-1][self.offs[:-1] < self.offs[1:]]
        before = np.empty(len(space), bool)
        before[0] = True
        before[1:] = space[:-1]
        before[edge] = True
        after = np.empty(len(space), bool)
        after[-1] = True
        after[:-1] = space[1:]
        after[edge[1:] - 1] = True
        np.logical_not(space, out=space)
        starts = np.flatnonzero(space & before)
        ends = np.flatnonzero(space & after) + 1
        first = np.searchsorted(starts, self.offs)
        return starts, ends, np.repeat(np.arange(self.n), first[1:] - first[:-1])

    def per_text(self, mask: np.ndarray) -> np.ndarray:
        """Number of marked bytes of each text."""
        c = np.zeros(len(mask) + 1, np.int64)
        np.cumsum(mask, out=c[1:])
        return c[self.offs[1:]] - c[self.offs[:-1]]

    def lines(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Start, end (without the newline) and text number of each line."""
        nl = np.flatnonzero(self.buf == 10)
        of_nl = np.searchsorted(self.offs, nl, "right") - 1
        doc = np.concatenate([np.arange(self.n), of_nl])
        start = np.concatenate([self.offs[:-1], nl + 1])
        order = np.lexsort((start, doc))
        doc, start = doc[order], start[order]
        end = np.empty(len(start), np.int64)
        end[:-1] = start[1:] - 1
        last = np.ones(len(start), bool)
        last[:-1] = doc[1:] != doc[:-1]
        end[last] = self.offs[1:][doc[last]]
        return start, end, doc


def flat(col: pa.Array) -> Flat:
    """A string column as one buffer; NULL counts as the empty text."""
    if isinstance(col, pa.ChunkedArray):
        col = col.combine_chunks()
    if col.null_count:
        col = col.fill_null("")
    kind = np.int64 if pa.types.is_large_string(col.type) else np.int32
    if not len(col):
        return Flat(np.zeros(0, np.uint8), np.zeros(1, np.int64))
    _, o, d = col.buffers()
    offs = np.frombuffer(o, kind)[col.offset:col.offset + len(col) + 1].astype(np.int64)
    buf = np.frombuffer(d, np.uint8)[offs[0]:offs[-1]] if d is not None and d.size else np.zeros(0, np.uint8)
    return Flat(buf, offs - offs[0])


def pieces(batches: Iterator[pa.RecordBatch], text: str = "text",
           limit: int = CHUNK_BYTES) -> Iterator[tuple[pa.RecordBatch, Flat]]:
    """Rows of each batch in runs of about ``limit`` bytes of text (one text at least)."""
    for b in batches:
        f = flat(b.column(b.schema.get_field_index(text)))
        at = 0
        while at < f.n:
            to = max(at + 1, int(np.searchsorted(f.offs, f.offs[at] + limit, "right")) - 1)
            lo, hi = f.offs[at], f.offs[to]
            yield b.slice(at, to - at), Flat(f.buf[lo:hi], f.offs[at:to + 1] - lo)
            at = to


def count_equal(h: np.ndarray, weight: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct values, how often each occurs (or its weights' sum), and where it occurs once."""
    order = np.argsort(h)
    s = h[order]
    first = np.ones(len(s), bool)
    first[1:] = s[1:] != s[:-1]
    at = np.flatnonzero(first)
    n = np.diff(np.append(at, len(s))) if weight is None else np.add.reduceat(weight[order], at) if len(at) else weight[:0]
    return s[at], n, order[at]


class Lookup:
    """Numbers 0.. of given distinct hashes; -1 for any other.  One probe of a
    sparse table settles nearly every hash, a sorted search the rest."""

    def __init__(self, keys: np.ndarray):
        keys = np.asarray(keys, np.uint64)
        self.bits = _U(max(12, int(len(keys)).bit_length() + 3))
        size = 1 << int(self.bits)
        self.slot = np.full(size, -1, np.int32)
        at = self._at(keys)
        self.slot[at[::-1]] = np.arange(len(keys) - 1, -1, -1)
        self.keys = keys
        lost = np.flatnonzero(self.slot[at] != np.arange(len(keys)))
        lost = lost[np.argsort(keys[lost])]
        self.lost_keys, self.lost_ids = keys[lost], lost
        self.crowded = np.zeros(size, bool)
        self.crowded[at[lost]] = True

    def _at(self, h: np.ndarray) -> np.ndarray:
        return (h >> (_U(64) - self.bits)).astype(np.int64)

    def __call__(self, h: np.ndarray) -> np.ndarray:
        if not len(self.keys):
            return np.full(len(h), -1, np.int32)
        at = self._at(h)
        out = self.slot[at]
        bad = (out >= 0) & (self.keys[out] != h)
        out[bad] = -1
        more = np.flatnonzero(bad & self.crowded[at])
        if len(more):
            i = np.minimum(np.searchsorted(self.lost_keys, h[more]), len(self.lost_keys) - 1)
            ok = self.lost_keys[i] == h[more]
            out[more[ok]] = self.lost_ids[i[ok]]
        return out


def unique_per_text(doc: np.ndarray, h: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct (text number, hash) pairs, sorted by both."""
    order = np.lexsort((h, doc))
    doc, h = doc[order], h[order]
    keep = np.ones(len(h), bool)
    keep[1:] = (h[1:] != h[:-1]) | (doc[1:] != doc[:-1])
    return doc[keep], h[keep]


def windows(doc: np.ndarray, h: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """First word and hash of each run of ``n`` words within one text."""
    m = len(h) - n + 1
    if m <= 0:
        return np.zeros(0, np.int64), np.zeros(0, np.uint64)
    at = np.flatnonzero(doc[:m] == doc[n - 1:])
    x = np.zeros(len(at), np.uint64)
    for j in range(n):
        x = mix(x * _U(0x2545F4914F6CDD1D) + h[at + j] + _U(j + 1))
    return at, x


def shingle_sets(f: Flat, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingles of ``n`` words of each text (ASCII lower-cased): text
    number and hash, sorted.  A text with 1 to n-1 words has its whole word
    sequence as its only shingle; one without words has none."""
    starts, ends, doc = f.words()
    h = f.range_hashes(starts, ends)
    at, x = windows(doc, h, n)
    count = np.bincount(doc, minlength=f.n)
    sd, sx = doc[at], x
    short = np.flatnonzero((count > 0) & (count < n))
    if len(short):
        first = np.searchsorted(doc, short)
        y = np.zeros(len(short), np.uint64)
        for j in range(n - 1):
            more = count[short] > j
            y[more] = mix(y[more] * _U(0x2545F4914F6CDD1D) + h[first[more] + j] + _U(j + 1))
        y = mix(y + _U(0x5851F42D4C957F2D))
        sd, sx = np.concatenate([sd, short]), np.concatenate([sx, y])
    return unique_per_text(sd, sx)

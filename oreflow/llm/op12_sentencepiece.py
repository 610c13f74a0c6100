"""Offset-preserving encoding with a SentencePiece BPE model, and decoding.

1. Normalisation: at each place the longest rule of the model's compiled
   character map (a double-array trie) that is a prefix of the rest replaces it,
   else one character is kept; every normalised byte remembers where its source
   began.  Blanks become the space mark, one is put in front of a text.
2. Segmentation: adjacent symbols whose concatenation is a piece are merged,
   best score first, leftmost on ties.  No piece holds a space mark behind
   another character, so texts fall into words that merge on their own; the
   distinct words of a batch are merged together, one merge per word and round,
   in arrays.
3. Alignment: ends of pieces in the normalised text are carried back to bytes of
   the source.  ``offsets`` has one number more than ``ids``: piece i covers the
   source bytes offsets[i] to offsets[i + 1] (an unknown character's last byte
   piece covers it whole, the others and the end id cover nothing).

A task holds one piece of a batch and a bounded table of words seen before.
"""

from __future__ import annotations

import heapq
import re
import struct
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import documents, wider, without
from .textvec import _U, Lookup, mix, pieces

SPACE = "▁"
MARK = SPACE.encode()
REPLACEMENT = "�".encode()
NORMAL, UNKNOWN, CONTROL, BYTE = 1, 2, 3, 6
WORDS_KEPT = 200_000      # words a task remembers
LONG = 48                 # longer words are cut where no piece can lie, then merged by a queue


def model_path() -> str:
    import public_tokenizers
    return public_tokenizers.path("piece_bpe_32k.model")


# -- the model file ----------------------------------------------------------


def _fields(b: bytes) -> Iterator[tuple[int, int | bytes]]:
    """(number, value) of a protocol-buffer message."""
    def varint(i):
        v = s = 0
        while True:
            x = b[i]
            i, v, s = i + 1, v | (x & 127) << s, s + 7
            if x < 128:
                return v, i
    i = 0
    while i < len(b):
        tag, i = varint(i)
        kind = tag & 7
        if kind == 0:
            v, i = varint(i)
        else:
            n, i = varint(i) if kind == 2 else ({1: 8, 5: 4}[kind], i)
            v, i = b[i:i + n], i + n
        yield tag >> 3, v


class CharsMap:
    """Longest-prefix rules of a compiled character map."""

    def __init__(self, blob: bytes):
        n = struct.unpack_from("<I", blob)[0] if blob else 0
        self.units = np.frombuffer(blob, "<u4", n // 4, 4).tolist() if n else []
        self.strings = blob[4 + n:]

    def longest(self, text: bytes, at: int) -> tuple[bytes, int] | None:
        """Replacement and length of the longest rule that starts at ``at``."""
        if not self.units:
            return None
        units, found = self.units, None
        step = lambda u: (u >> 10) << ((u & 512) >> 6)
        node = step(units[0])
        for i in range(at, len(text)):
            node ^= text[i]
            u = units[node] if node < len(units) else 0
            if u & 0x800000FF != text[i]:
                break
            node ^= step(u)
            if u >> 8 & 1:
                found = (units[node] & 0x7FFFFFFF, i + 1 - at)
        if found is None:
            return None
        start = found[0]
        return self.strings[start:self.strings.index(b"\0", start)], found[1]


def _char_length(text: bytes, at: int) -> int:
    """Bytes of the well-formed character at ``at``; 0 if there is none."""
    x = text[at]
    n = 1 if x < 128 else 2 if 0xC2 <= x < 0xE0 else 3 if 0xE0 <= x < 0xF0 else 4 if 0xF0 <= x < 0xF5 else 0
    try:
        return n if n and text[at:at + n].decode() else 0
    except UnicodeDecodeError:
        return 0


class Normalizer:
    def __init__(self, charsmap: bytes = b"", dummy_prefix: bool = True, remove_extra: bool = True,
                 escape: bool = True):
        self.map = CharsMap(charsmap)
        self.dummy_prefix, self.remove_extra = dummy_prefix, remove_extra
        self.space = MARK if escape else b" "

    def prefix(self, text: bytes, at: int) -> tuple[bytes, int]:
        rule = self.map.longest(text, at)
        if rule:
            return rule
        n = _char_length(text, at)
        return (text[at:at + n], n) if n else (REPLACEMENT, 1)

    def __call__(self, text: bytes) -> tuple[bytes, np.ndarray]:
        """Normalised text, and for each of its bytes and its end the source byte."""
        if not self.map.units and not self.remove_extra:
            plain = self._plain(text)
            if plain is not None:
                return plain
        out, origin, at = bytearray(), [], 0
        if self.remove_extra:
            while at < len(text):
                p, n = self.prefix(text, at)
                if p != b" ":
                    break
                at += n
        if at == len(text):
            # the library gives such a text no place but its start
            return b"", np.zeros(1, np.int64)

        def put(p: bytes) -> None:
            out.extend(p)
            origin.extend([at] * len(p))
        if self.dummy_prefix:
            put(self.space)
        after_space = self.remove_extra
        while at < len(text):
            p, n = self.prefix(text, at)
            if after_space:
                p = p.lstrip(b" ")
            if p:
                put(p.replace(b" ", self.space))
                after_space = p.endswith(b" ")
            at += n
            after_space &= self.remove_extra
        if self.remove_extra:
            while out.endswith(self.space):
                at = origin[len(out) - len(self.space)]
                del out[-len(self.space):], origin[-len(self.space):]
        return bytes(out), np.array([*origin, at], np.int64)

    def _plain(self, text: bytes) -> tuple[bytes, np.ndarray] | None:
        """Without rules only blanks change; None if the text isn't well-formed."""
        if not text:
            return b"", np.zeros(1, np.int64)
        try:
            text.decode()
        except UnicodeDecodeError:
            return None
        front = self.space if self.dummy_prefix else b""
        wide = np.ones(len(text), np.int64)
        wide[np.frombuffer(text, np.uint8) == 32] = len(self.space)
        origin = np.concatenate([np.zeros(len(front), np.int64), np.repeat(np.arange(len(text)), wide), [len(text)]])
        return front + text.replace(b" ", self.space), origin


class Model:
    """Pieces, scores and merges of a BPE model file."""

    def __init__(self, path: str):
        self.pieces, self.scores, self.kinds = [], [], []
        trainer, norm = {}, {}
        with open(path, "rb") as f:
            for k, v in _fields(f.read()):
                if k == 1:
                    p = dict(_fields(v))
                    self.pieces.append(p[1].decode())
                    self.scores.append(struct.unpack("<f", p.get(2, b"\0\0\0\0"))[0])
                    self.kinds.append(p.get(3, NORMAL))
                elif k == 2:
                    trainer = dict(_fields(v))
                elif k == 3:
                    norm = dict(_fields(v))
        if trainer.get(3) != 2 or trainer.get(24) or set(self.kinds) - {NORMAL, UNKNOWN, CONTROL, BYTE}:
            raise ValueError("only BPE models without own or unused symbols, spaces as prefixes")
        self.normalize = Normalizer(norm.get(2, b""), bool(norm.get(3, 1)), bool(norm.get(4, 1)), bool(norm.get(5, 1)))
        self.strip = self.normalize.dummy_prefix or self.normalize.remove_extra
        self.unknown = self.kinds.index(UNKNOWN)
        self.end = self.pieces.index(trainer.get(47, b"</s>").decode())
        self.fallback = bool(trainer.get(35, 0))
        self.unknown_surface = trainer.get(44, " ⁇ ".encode())
        self.byte = np.full(256, self.unknown, np.int32)
        for i, k in enumerate(self.kinds):
            if k == BYTE:
                self.byte[int(self.pieces[i][1:-1], 16)] = i
        self._merges()
        # words merge on their own if a space mark stands only at the front of a piece
        inner = re.compile(f"[^{SPACE}]{SPACE}")
        apart = not any(inner.search(p) for p in self.ids)
        self.words = re.compile(f"{SPACE}*[^{SPACE}]+|{SPACE}+" if apart else r"(?s:.+)")

    def _merges(self) -> None:
        """Symbols are pieces and the single characters of pieces; a merge is a
        pair of symbols that makes a piece."""
        self.ids = {p: i for i, (p, k) in enumerate(zip(self.pieces, self.kinds)) if k == NORMAL}
        symbol = dict(self.ids)
        chars = sorted({c for p in self.ids for c in p})
        for c in chars:
            symbol.setdefault(c, len(self.pieces) + len(symbol) - len(self.ids))
        self.chars = np.array([ord(c) for c in chars], np.uint32)
        self.char_symbol = np.array([symbol[c] for c in chars], np.int64)
        names = {i: s for s, i in symbol.items()}
        # a symbol that is no piece counts as the unknown character it is
        self.extra = np.array([ord(names[i]) for i in range(len(self.pieces), len(self.pieces) + len(symbol) - len(self.ids))], np.int64)
        self.base = len(self.pieces) + len(self.extra)
        order = {s: r for r, s in enumerate(sorted(set(self.scores), reverse=True))}
        pairs = [(symbol[p[:k]] * self.base + symbol[p[k:]], i) for p, i in self.ids.items()
                 for k in range(1, len(p)) if p[:k] in symbol and p[k:] in symbol]
        key = np.array([k for k, _ in pairs] or [0], np.uint64)
        self.merged = np.array([i for _, i in pairs] or [0], np.int64)
        self.rank = np.array([order[self.scores[i]] for _, i in pairs] or [0], np.int64)
        self.pair = Lookup(mix(key))            # mix is one to one: no two pairs share a key
        self.bigrams = np.unique(np.array([ord(a) << 32 | ord(b) for p in self.ids for a, b in zip(p, p[1:])], np.uint64))
        self.width = np.array([len(p.encode()) for p in self.pieces], np.int64)

    # -- merging -------------------------------------------------------------

    def _symbols(self, codes: np.ndarray) -> np.ndarray:
        """Symbol of each character; -1 - code for one that no piece holds."""
        at = np.minimum(np.searchsorted(self.chars, codes), len(self.chars) - 1)
        return np.where(self.chars[at] == codes, self.char_symbol[at], -1 - codes.astype(np.int64))

    def _found(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Number of the merge of each pair of symbols; -1 for none."""
        known = (left >= 0) & (right >= 0)
        out = np.full(len(left), -1, np.int64)
        i = np.flatnonzero(known)
        out[i] = self.pair(mix((left[i] * self.base + right[i]).astype(np.uint64)))
        return out

    def merge_words(self, sym: np.ndarray, word: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Merged symbols and their words, given symbols in order of ``word``."""
        done_s, done_w = [], []
        none = np.int64(1) << 62
        pair = self._found(sym[:-1], sym[1:])
        pair[word[:-1] != word[1:]] = -1
        pair = np.append(pair, -1)
        while len(sym):
            cost = np.where(pair >= 0, (self.rank[pair] << 32) + np.arange(len(sym)), none)
            first = np.flatnonzero(np.append(True, word[1:] != word[:-1]))
            best = np.minimum.reduceat(cost, first)
            still = best < none
            if not still.all():
                size = np.diff(np.append(first, len(sym)))
                keep = np.repeat(still, size)
                done_s.append(sym[~keep])
                done_w.append(word[~keep])
                place = np.cumsum(keep) - 1
                sym, word, pair = sym[keep], word[keep], pair[keep]
                at = place[(best[still] & 0xFFFFFFFF)]
            else:
                at = best & 0xFFFFFFFF
            if not len(sym):
                break
            sym[at] = self.merged[pair[at]]
            stay = np.ones(len(sym), bool)
            stay[at + 1] = False
            at = np.cumsum(stay)[at] - 1
            sym, word, pair = sym[stay], word[stay], pair[stay]
            # the pairs on both sides of what was merged are new
            for i in (at, at[at > 0] - 1):
                j = np.minimum(i + 1, len(sym) - 1)
                p = self._found(sym[i], sym[j])
                p[(j == i) | (word[i] != word[j])] = -1
                pair[i] = p
        s = np.concatenate(done_s) if done_s else sym
        w = np.concatenate(done_w) if done_w else word
        order = np.argsort(w, kind="stable")
        return s[order], w[order]

    def merge_long(self, sym: list[int]) -> list[int]:
        """The same for one long word, with a queue of pairs."""
        n = len(sym)
        before, after = list(range(-1, n - 1)), [*range(1, n), -1]
        merged, rank, cache = self.merged, self.rank, {}
        queue: list[tuple] = []

        def look(i: int) -> None:
            j = after[i] if i >= 0 else -1
            if j < 0 or sym[i] < 0 or sym[j] < 0:
                return
            k = (sym[i], sym[j])
            if k not in cache:
                cache[k] = int(self._found(np.array([k[0]]), np.array([k[1]]))[0])
            if (p := cache[k]) >= 0:
                heapq.heappush(queue, (int(rank[p]), i, *k, int(merged[p])))
        for i in range(n - 1):
            look(i)
        gone = [False] * n
        while queue:
            _, i, a, b, m = heapq.heappop(queue)
            j = after[i]
            if gone[i] or j < 0 or sym[i] != a or sym[j] != b:
                continue
            sym[i], gone[j], after[i] = m, True, after[j]
            if after[i] >= 0:
                before[after[i]] = i
            look(before[i])
            look(i)
        return [s for s, g in zip(sym, gone) if not g]

    def segment(self, words: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Ids of the words, one after the other; normalised bytes that each id
        covers; number of ids of each word."""
        size = np.array([len(w) for w in words], np.int64)
        codes = np.frombuffer("".join(words).encode("utf-32-le"), np.uint32)
        word = np.repeat(np.arange(len(words)), size)
        sym = self._symbols(codes)
        long = size > LONG
        part_s, part_w = [], []
        small = ~long[word] if long.any() else np.ones(len(word), bool)
        if long.any():
            start = np.cumsum(size) - size
            for i in np.flatnonzero(long):
                a, b = start[i], start[i] + size[i]
                c = codes[a:b].astype(np.uint64)
                cut = np.flatnonzero(~np.isin(c[:-1] << _U(32) | c[1:], self.bigrams)) + 1
                edges = [0, *cut.tolist(), int(b - a)]
                got: list[int] = []
                for x, y in zip(edges, edges[1:]):
                    got += self.merge_long(sym[a + x:a + y].tolist())
                part_s.append(np.array(got, np.int64))
                part_w.append(np.full(len(got), i))
        s, w = self.merge_words(sym[small], word[small])
        if part_s:
            s, w = np.concatenate([s, *part_s]), np.concatenate([w, *part_w])
            order = np.argsort(w, kind="stable")
            s, w = s[order], w[order]
        return self._to_ids(s, w, len(words))

    def _to_ids(self, s: np.ndarray, w: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        odd = (s < 0) | (s >= len(self.pieces))
        if not odd.any():
            return s.astype(np.int32), self.width[s], np.bincount(w, minlength=n)
        ids, width, count, at = [], [], np.bincount(w, minlength=n), 0
        for i in np.flatnonzero(odd):
            ids.append(s[at:i])
            width.append(self.width[s[at:i]])
            code = -1 - s[i] if s[i] < 0 else self.extra[s[i] - len(self.pieces)]
            raw = chr(int(code)).encode()
            own = self.byte[list(raw)] if self.fallback else np.array([self.unknown])
            ids.append(own)
            width.append(np.array([0] * (len(own) - 1) + [len(raw)]))
            count[w[i]] += len(own) - 1
            at = i + 1
        ids.append(s[at:])
        width.append(self.width[s[at:]])
        return np.concatenate(ids).astype(np.int32), np.concatenate(width).astype(np.int64), count

    # -- decoding ------------------------------------------------------------

    @property
    def surfaces(self) -> tuple[np.ndarray, np.ndarray]:
        """Bytes that each id stands for (any other id is unknown)."""
        if not hasattr(self, "_surfaces"):
            out = []
            for p, k in zip([*self.pieces, ""], [*self.kinds, UNKNOWN]):
                out.append(b"" if k == CONTROL else self.unknown_surface if k == UNKNOWN else
                           bytes([int(p[1:-1], 16)]) if k == BYTE else p.replace(SPACE, " ").encode())
            self._surfaces = np.frombuffer(b"".join(out), np.uint8), np.cumsum([0, *map(len, out)])
            self._mute = np.array([k == CONTROL for k in [*self.kinds, UNKNOWN]])
            self._front = np.array([k == NORMAL and p.startswith(SPACE) for p, k in zip([*self.pieces, ""], [*self.kinds, UNKNOWN])])
        return self._surfaces


@lru_cache(maxsize=4)
def load(path: str) -> Model:
    return Model(path)


# -- columns -----------------------------------------------------------------


def _ragged(start: np.ndarray, n: np.ndarray) -> np.ndarray:
    """start[0] .. start[0] + n[0] - 1, then those of 1, and so on."""
    return np.repeat(start - (np.cumsum(n) - n), n) + np.arange(int(n.sum()))


class Words:
    """Segmentations of the words a task has met."""

    def __init__(self, model: Model):
        self.model = model
        self.clear()

    def clear(self) -> None:
        self.number: dict[str, int] = {}
        self.ids, self.width = [np.zeros(0, np.int32)], [np.zeros(0, np.int64)]
        self.count: list[np.ndarray] = []

    def __call__(self, words: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Ids, covered bytes, and the number of ids of each word."""
        number = self.number
        new = [w for w in dict.fromkeys(words) if w not in number]
        if new and len(number) + len(new) > WORDS_KEPT and number:
            self.clear()
            number, new = self.number, list(dict.fromkeys(words))
        if new:
            ids, width, count = self.model.segment(new)
            number.update(zip(new, range(len(number), len(number) + len(new))))
            self.ids.append(ids)
            self.width.append(width)
            self.count.append(count)
            self.ids, self.width, self.count = [np.concatenate(self.ids)], [np.concatenate(self.width)], [np.concatenate(self.count)]
            self.start = np.cumsum(self.count[0]) - self.count[0]
        if not words:
            return self.ids[0][:0], self.width[0][:0], np.zeros(0, np.int64)
        at = np.fromiter(map(number.__getitem__, words), np.int64, len(words))
        n = self.count[0][at]
        i = _ragged(self.start[at], n)
        return self.ids[0][i], self.width[0][i], n


def _encode(batches: Iterator[pa.RecordBatch], path: str, text: str, end: bool) -> Iterator[pa.RecordBatch]:
    model = load(path)
    seen = Words(model)
    for rows, f in pieces(batches, text):
        words, per_text, origins = [], np.zeros(f.n, np.int64), []
        buf = f.buf.tobytes()
        for k in range(f.n):
            norm, origin = model.normalize(buf[f.offs[k]:f.offs[k + 1]])
            own = model.words.findall(norm.decode())
            words += own
            per_text[k] = len(own)
            origins.append(origin)
        ids, width, n = seen(words)
        # ids of each text, then the place of each id's end in the normalised text and in the source
        first = np.cumsum(np.append(0, n))[np.cumsum(np.append(0, per_text))]
        count = np.diff(first)
        total = np.cumsum(np.append(0, width))
        base = np.cumsum([0, *map(len, origins)])[:-1]
        origin = np.concatenate(origins) if origins else np.zeros(0, np.int64)
        inside = total[1:] - np.repeat(total[first[:-1]], count)
        ends = origin[np.repeat(base, count) + inside]
        more = int(end)
        out_ids = np.full(len(ids) + more * f.n, model.end, np.int32)
        to = np.cumsum(np.append(0, count + more))
        out_ids[_ragged(to[:-1], count)] = ids
        # one number in front of each text's ends, one more for the end id
        offs = np.empty(len(out_ids) + f.n, np.int64)
        at = to + np.arange(f.n + 1)
        offs[at[:-1]] = origin[base] if f.n else 0
        offs[_ragged(at[:-1] + 1, count)] = ends
        if end:
            offs[at[1:] - 1] = offs[at[1:] - 2]
        yield pa.RecordBatch.from_arrays(
            [*rows.columns, pa.ListArray.from_arrays(pa.array(to, pa.int32()), pa.array(out_ids)),
             pa.ListArray.from_arrays(pa.array(at, pa.int32()), pa.array(offs, pa.int32()))],
            names=[*rows.schema.names, "ids", "offsets"])


def encode(df: DataFrame, text: str = "text", path: str | None = None, end: bool = True) -> DataFrame:
    """``df`` with ``ids`` (array<int>) and ``offsets`` (array<int>, one more than
    ids: piece i covers the text's bytes offsets[i] to offsets[i + 1]).

    A NULL text counts as the empty one, whose only id is the end id (if
    ``end``); texts of any length are encoded whole; each of equal rows is
    encoded; columns called ids or offsets are replaced, all others are kept; an
    empty table gives no rows."""
    path = path or model_path()
    df = without(df, ["ids", "offsets"])
    at = next(c for c in df.columns if c.lower() == text.lower())
    df = df.withColumn(at, F.col(f"`{at}`").cast("string"))
    return df.mapInArrow(lambda it: _encode(it, path, at, end), wider(df, "ids array<int>, offsets array<int>"))


def _repaired(raw: bytes) -> bytes:
    """Each byte that begins no well-formed character becomes U+FFFD."""
    try:
        raw.decode()
        return raw
    except UnicodeDecodeError:
        pass
    out, at = bytearray(), 0
    while at < len(raw):
        n = _char_length(raw, at)
        out += raw[at:at + n] if n else REPLACEMENT
        at += n or 1
    return bytes(out)


DECODE_IDS = 1 << 18      # ids decoded together


def _decode(batches: Iterator[pa.RecordBatch], path: str, col: str, out: str) -> Iterator[pa.RecordBatch]:
    model = load(path)
    pool, start = model.surfaces
    for b in batches:
        lists = b.column(b.schema.get_field_index(col))
        offs = lists.offsets.to_numpy().astype(np.int64)
        values = lists.values
        at = 0
        while at < b.num_rows:
            to = max(at + 1, int(np.searchsorted(offs, offs[at] + DECODE_IDS, "right")) - 1)
            raw = values.slice(offs[at], offs[to] - offs[at]).fill_null(-1).to_numpy(zero_copy_only=False)
            ids = np.where((raw >= 0) & (raw < len(model.pieces)), raw, len(model.pieces)).astype(np.int64)
            o = offs[at:to + 1] - offs[at]
            n = start[ids + 1] - start[ids]
            text = pool[_ragged(start[ids], n)].tobytes()
            ends = np.cumsum(np.append(0, n))[o]
            # the mark in front of the first piece that is not a control id is none of the text
            spoken = np.append(np.flatnonzero(~model._mute[ids]), len(ids))
            i = spoken[np.searchsorted(spoken, o[:-1])]
            strip = (i < o[1:]) & np.append(model._front[ids], False)[i] if model.strip else np.zeros(to - at, bool)
            got = [_repaired(text[x + s:y]) for x, y, s in zip(ends[:-1].tolist(), ends[1:].tolist(), strip.tolist())]
            none = lists.slice(at, to - at).is_null().to_pylist()
            col_out = pa.array([None if z else g.decode() for g, z in zip(got, none)], pa.string())
            yield pa.RecordBatch.from_arrays([*b.slice(at, to - at).columns, col_out], names=[*b.schema.names, out])
            at = to


def decode(df: DataFrame, ids: str = "ids", out: str = "decoded", path: str | None = None) -> DataFrame:
    """``df`` with the text ``out`` that the ids stand for.

    Control ids say nothing, unknown ids (also NULL and numbers beyond the
    vocabulary) the model's sign for them; bytes that make no character become
    U+FFFD; an empty array gives the empty text, a NULL one NULL; a column
    called ``out`` is replaced; an empty table gives no rows."""
    path = path or model_path()
    df = without(df, [out])
    df = df.withColumn(ids, F.col(ids).cast("array<int>"))
    return df.mapInArrow(lambda it: _decode(it, path, ids, out), wider(df, f"`{out}` string"))


def op12_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Digests of ids and decoded text; ``covered_bytes`` (source bytes that the
    pieces' spans cover together) equals the text's length in bytes."""
    d = decode(encode(documents(spark, sf_dir).select("doc_id", "text")).select("doc_id", "ids", "offsets"))
    return d.select(
        "doc_id", F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), " "), 256).alias("ids_sha256"),
        F.sha2(F.col("decoded"), 256).alias("decoded_sha256"),
        (F.element_at("offsets", -1) - F.element_at("offsets", 1)).cast("long").alias("covered_bytes"))

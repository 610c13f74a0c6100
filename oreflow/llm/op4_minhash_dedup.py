"""Near-duplicates by bottom-k sketches of one hash function.

A document is the set of its distinct word shingles; two are linked if their
Jaccard similarity reaches the threshold.

1. Equal sets are one class (a 128-bit sum over the set), so exact copies cost
   one grouped minimum however many there are.
2. A class keeps its K smallest hash values.  Inverted lists of retained values
   give overlaps: two sets of similarity t share each of the K smallest values
   of their union with chance t.
3. Lists of at most HOT classes give their pairs.  In a longer list every class
   is compared with the list's pivot alone, the class with the most of such
   values (the middle of a group of near copies).  Distance 1 - J is a metric:
   what is linked with a member of a pivot's circle (distance up to 1-t) lies
   within 2(1-t) of the pivot.  So only classes in that border, and only those
   not yet in the pivot's component, are compared with the circle.  Classes that
   have few short lists and no pivot nearby form the next round's input.  Sets
   no larger than their sketch count exactly: they go on until their short lists,
   or those of a linked pivot, outnumber the values a linked set may lack.
4. The union sketch of a pair estimates its similarity; far pairs go.  The
   cutoffs are so low that a linked pair is lost with a chance below 1e-6.
5. The full sets of what is left give the exact similarity.

Nothing is capped: when rounds stop shrinking, or what is left costs no more than
some passes over all sets, the members of the remaining classes' shortest lists are
compared with each other, by size and block by block: their sketches first, then the
full sets of those that any sketch of their list comes near to.  A further round would
carry on each class that has no near copy at all, only because its words are frequent.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .bitmap import Bitmap, build
from .common import Tables, documents, free_name, id_key, key_id
from .components import components
from .textvec import _U, mix, pieces, shingle_sets

K = 32
HOT = 24
SAFE = 8        # shared long lists that make a pivot's circle reliable
FEW = 12        # long lists among K from which short ones alone don't suffice
BLOCK = 100_000  # shingles on one side of a block
SIDE = 8192      # sketches on one side of a block of sketches
TILE = 1024      # of them compared at once
PARTNERS = 12    # near sketches among a tile's up to which a class gives pairs
LIST_COST = 4    # pairs per class that comparing whole lists one by one may cost
PASSES = 100     # times the shingles of all classes that comparing them block by block may cost
SIGN = _U(1 << 63)

_SKETCH = "id bigint, th bigint, n bigint, fp1 bigint, fp2 bigint, sketch array<bigint>, brief array<int>"


def _ordered(h: np.ndarray) -> np.ndarray:
    """Signed numbers in the order of the unsigned hashes."""
    return (h ^ SIGN).view(np.int64)


def _sketches(batches: Iterator[pa.RecordBatch], words: int) -> Iterator[pa.RecordBatch]:
    for rows, f in pieces(batches):
        d, h = shingle_sets(f, words)
        off = np.searchsorted(d, np.arange(f.n + 1))
        fps = []
        for salt in (1, 2):
            c = np.zeros(len(h) + 1, np.uint64)
            np.cumsum(mix(h + _U(salt)), out=c[1:])
            fps.append((c[off[1:]] - c[off[:-1]]).view(np.int64))
        n = np.diff(off)
        k = np.minimum(n, K)
        to = np.zeros(f.n + 1, np.int64)
        np.cumsum(k, out=to[1:])
        at = np.repeat(off[:-1] - to[:-1], k) + np.arange(to[-1])
        to = pa.array(to, pa.int32())
        v = _ordered(h[at])
        yield pa.RecordBatch.from_arrays(
            [rows.column(0), rows.column(1), pa.array(n.astype(np.int64)), pa.array(fps[0]), pa.array(fps[1]),
             pa.ListArray.from_arrays(to, pa.array(v)), pa.ListArray.from_arrays(to, pa.array((v >> 32).astype(np.int32)))],
            names=["id", "th", "n", "fp1", "fp2", "sketch", "brief"])


def _sets(batches: Iterator[pa.RecordBatch], words: int, some: Bitmap) -> Iterator[pa.RecordBatch]:
    """Full sets of the texts whose ids may be wanted."""
    for b in batches:
        at = some(b.column(0).to_numpy(zero_copy_only=False).view(np.uint64))
        if not len(at):
            continue
        for rows, f in pieces([b.take(pa.array(at))]):
            d, h = shingle_sets(f, words)
            off = np.searchsorted(d, np.arange(f.n + 1))
            raw = [h[a:b].tobytes() for a, b in zip(off[:-1], off[1:])]
            yield pa.RecordBatch.from_arrays([rows.column(0), rows.column(1), pa.array(raw, pa.binary())],
                                             names=["id", "th", "full"])


def _shared(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        out, all_ = np.empty(b.num_rows, np.int64), np.empty(b.num_rows, np.int64)
        for j, (x, y) in enumerate(zip(b.column(2), b.column(3))):
            s = np.frombuffer(x.as_buffer(), np.uint64)
            t = np.frombuffer(y.as_buffer(), np.uint64)
            if len(s) > len(t):
                s, t = t, s
            i = np.searchsorted(t, s)
            i[i == len(t)] = 0
            out[j] = (t[i] == s).sum() if len(t) else 0
            all_[j] = len(s) + len(t) - out[j]
        yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(out), pa.array(all_)],
                                         names=["a", "b", "shared", "united"])


class Block:
    """Some sets, indexed by their values."""

    def __init__(self, nodes: pa.ChunkedArray, full: pa.ChunkedArray):
        self.nodes = nodes.to_numpy()
        sets = [np.frombuffer(v.as_buffer(), np.uint64) for c in full.chunks for v in c]
        self.sizes = np.array([len(v) for v in sets], np.int64)
        value = np.concatenate(sets) if sets else np.zeros(0, np.uint64)
        order = np.argsort(value, kind="stable")
        self.value, self.of = value[order], np.repeat(np.arange(len(sets)), self.sizes)[order]

    def linked(self, x: np.ndarray, percent: int) -> np.ndarray:
        """Numbers of the sets that ``x`` is linked with."""
        a, b = np.searchsorted(self.value, x, "left"), np.searchsorted(self.value, x, "right")
        n = b - a
        at = np.repeat(a - (np.cumsum(n) - n), n) + np.arange(n.sum())
        shared = np.bincount(self.of[at], minlength=len(self.sizes))
        return np.flatnonzero(shared * 100 >= (len(x) + self.sizes - shared) * percent)


def _each(t: pa.Table, nodes: int, full: int) -> Iterator[tuple[int, np.ndarray]]:
    for node, raw in zip(t.column(nodes).to_pylist(), (v for c in t.column(full).chunks for v in c)):
        yield node, np.frombuffer(raw.as_buffer(), np.uint64)


def _links_table(out: list[tuple[int, int]]) -> pa.Table:
    return pa.table({"a": pa.array([x for x, _ in out], pa.int64()), "b": pa.array([y for _, y in out], pa.int64())})


def _meet(xs: pa.Table, ys: pa.Table, percent: int) -> pa.Table:
    """For each set of ``xs`` the first set of ``ys`` that it is linked with, if any."""
    out: list[tuple[int, int]] = []
    if ys.num_rows:
        block = Block(ys.column("node_y"), ys.column("full_y"))
        for node, x in _each(xs, 3, 4):
            hit = block.nodes[block.linked(x, percent)]
            hit = hit[hit != node]
            if len(hit):
                out.append((node, int(hit[0])))
    return _links_table(out)


def _join_all(xs: pa.Table, ys: pa.Table, percent: int) -> pa.Table:
    """Links between ``xs`` and ``ys`` that join all they link."""
    out: list[tuple[int, int]] = []
    if ys.num_rows and xs.num_rows:
        block = Block(ys.column("node_y"), ys.column("full_y"))
        label = np.arange(ys.num_rows)
        for node, x in _each(xs, 5, 6):
            hit = block.linked(x, percent)
            hit = hit[block.nodes[hit] != node]
            if len(hit):
                # one link for each part not yet joined, and they are one part from now on
                parts, first = np.unique(label[hit], return_index=True)
                out += [(node, int(block.nodes[hit[i]])) for i in first]
                label[np.isin(label, parts)] = parts[0]
    return _links_table(out)


def _shared_counts(row: np.ndarray, value: np.ndarray, nx: int, n: int) -> np.ndarray:
    """How many values each of the first ``nx`` of ``n`` sets shares with each other
    one of all ``n``; ``row`` and ``value`` give each set's values."""
    order = np.argsort(value, kind="stable")
    row, value = row[order], value[order]
    new = np.ones(len(value), bool)
    new[1:] = value[1:] != value[:-1]
    at = np.flatnonzero(new)
    times = np.diff(np.append(at, len(value)))
    # values of many sets by one matrix product, of few sets pair by pair
    many = times > max(4, n // 16)
    m = np.zeros((n, int(many.sum())), np.float32)
    number = np.repeat(np.cumsum(many) - 1, times)
    often = np.repeat(many, times)
    m[row[often], number[often]] = 1
    out = (m[:nx] @ m.T).astype(np.int32)
    few = (times > 1) & ~many
    each = times[few]
    a = np.repeat(at[few], each) + np.arange(each.sum()) - np.repeat(np.cumsum(each) - each, each)
    b = np.repeat(at[few], each)
    each = np.repeat(each, each)
    x = row[np.repeat(a, each)]
    y = row[np.repeat(b, each) + np.arange(each.sum()) - np.repeat(np.cumsum(each) - each, each)]
    inside = x < nx
    return out + np.bincount(x[inside] * n + y[inside], minlength=nx * n).reshape(nx, n)


def _near_ones(size: np.ndarray, off: np.ndarray, value: np.ndarray, x: np.ndarray, y: np.ndarray,
               least: float, percent: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Which sets in ``x`` may be linked with which in ``y`` (``x`` itself if both are the
    same): sizes allow it, and the sketches share at least ``least`` of their union, as far
    as it is kept.  Two arrays of pairs, and the sets of all pairs that are in no array
    because both sets have more than PARTNERS others in a tile."""
    many = np.zeros(len(size), bool)
    pairs = [(np.zeros(0, np.int64), np.zeros(0, np.int64))]
    for i in range(0, len(x), TILE):
        for j in range(i if y is x else 0, len(y), TILE):
            p, q = x[i:i + TILE], y[j:j + TILE]
            own = y is x and i == j
            sets = p if own else np.concatenate([p, q])
            k = np.diff(off)[sets]
            row = np.repeat(np.arange(len(sets)), k)
            at = np.repeat(off[sets] - (np.cumsum(k) - k), k) + np.arange(k.sum())
            shared = _shared_counts(row, value[at], len(p), len(sets))[:, 0 if own else len(p):]
            kx, ky, sx, sy = np.diff(off)[p][:, None], np.diff(off)[q][None, :], size[p][:, None], size[q][None, :]
            near = (shared >= least * np.minimum(K, kx + ky - shared)) \
                & (np.minimum(sx, sy) * 100 >= np.maximum(sx, sy) * percent)
            if own:
                np.fill_diagonal(near, False)
            full = (near.sum(axis=1) > PARTNERS)[:, None] & (near.sum(axis=0) > PARTNERS)[None, :] & near
            many[p[full.any(axis=1)]] = True
            many[q[full.any(axis=0)]] = True
            a, b = np.nonzero(near & ~full)
            if own:
                a, b = a[a < b], b[a < b]
            pairs.append((p[a], q[b]))
    return *(np.concatenate(c) for c in zip(*pairs)), np.flatnonzero(many)


def _likely(batches: Iterator[pa.RecordBatch], least: float, percent: int) -> Iterator[pa.RecordBatch]:
    """(v, a, b) of what ``_near_ones`` finds in each cell (v, i, j), a < b for a pair, b = -1
    for one of the sets that give none; a cell's rows lie together."""
    held: list[pa.RecordBatch] = []

    def cells(t: pa.Table) -> pa.RecordBatch:
        v, i, j, own, node, size = (t.column(c).to_numpy() for c in range(6))
        brief = t.column(6).combine_chunks()
        if isinstance(brief, pa.ChunkedArray):
            brief = brief.chunk(0)
        off, value = brief.offsets.to_numpy().astype(np.int64), brief.values.to_numpy()
        new = _starts(v, i, j)
        out = [(v[:0], node[:0], node[:0])]
        for a, b in zip(new, np.append(new[1:], len(v))):
            if b - a > 1:
                x = np.flatnonzero(own[a:b] == i[a])
                y = x if i[a] == j[a] else np.flatnonzero(own[a:b] == j[a])
                p, q, many = _near_ones(size[a:b], off[a:b + 1], value, x, y, least, percent)
                p, q = node[a + p], node[a + q]
                n = len(p) + len(many)
                out.append((np.full(n, v[a]), np.append(np.minimum(p, q), node[a + many]),
                            np.append(np.maximum(p, q), np.full(len(many), -1))))
        return pa.RecordBatch.from_arrays([pa.array(np.concatenate(c)) for c in zip(*out)], names=["v", "a", "b"])

    for b in batches:
        if not b.num_rows:
            continue
        # the last cell may go on in the next batch
        key = [np.concatenate([h.column(c).to_numpy()[-1:] for h in held[-1:]] + [b.column(c).to_numpy()]) for c in range(3)]
        last = int(_starts(*key)[-1]) - (len(key[0]) - b.num_rows)
        if last >= 0:
            done = held + [b.slice(0, last)]
            held = [b.slice(last)]
            if sum(d.num_rows for d in done):
                yield cells(pa.Table.from_batches(done))
        else:
            held.append(b)
    if held:
        yield cells(pa.Table.from_batches(held))


def _starts(*key: np.ndarray) -> np.ndarray:
    """Where the key changes, the first row included."""
    new = np.ones(len(key[0]), bool)
    new[1:] = False
    for k in key:
        new[1:] |= k[1:] != k[:-1]
    return np.flatnonzero(new)


class NearDuplicates:
    """One run over a table; ``r`` holds the classes: node, id, th, n, sketch."""

    def __init__(self, df: DataFrame, words: int, percent: int):
        self.words, self.percent = words, percent
        self.cut = Tables(df.sparkSession)
        text = F.coalesce(F.col("text").cast("string"), F.lit(""))
        self.src = df.select(id_key().alias("id"), F.xxhash64(text).alias("th"), text.alias("text"))
        w = words
        self.docs = self.cut(self.src.mapInArrow(lambda it: _sketches(it, w), _SKETCH))
        some = self.docs.where(F.col("n") > 0)
        r = some.groupBy("fp1", "fp2", "n").agg(F.min(F.struct("id", "th", "sketch", "brief")).alias("x")) \
            .select("fp1", "fp2", "n", "x.*")
        self.r = self.cut(r.withColumn("node", F.monotonically_increasing_id()))
        self.full: DataFrame | None = None

    # -- similarity of pairs (columns a, b of nodes) ---------------------------

    def _near(self, a: Column, b: Column, percent: int) -> Column:
        """Sizes allow a similarity of ``percent``."""
        return F.least(a, b) * 100 >= F.greatest(a, b) * percent

    def estimated(self, pairs: DataFrame, least: float) -> DataFrame:
        """Pairs whose union sketch shows at least ``least`` of its values in both."""
        sk = self.r.select("node", "brief")
        j = pairs.join(sk.select(F.col("node").alias("a"), F.col("brief").alias("sa")), "a") \
            .join(sk.select(F.col("node").alias("b"), F.col("brief").alias("sb")), "b")
        union = F.slice(F.array_sort(F.array_union("sa", "sb")), 1, K)
        both = F.size(F.array_intersect(union, F.array_intersect("sa", "sb")))
        return j.where(both >= F.lit(least) * F.size(union)).select("a", "b")

    def _full_sets(self, nodes: DataFrame) -> DataFrame:
        """(node, full) of ``nodes`` and all asked for before.  A scan of the texts
        makes the new ones; a bounded filter keeps the others out of the shuffle."""
        new = nodes if self.full is None else nodes.join(self.full.select("node"), "node", "left_anti")
        need = self.cut(self.r.join(new, "node").select("node", "id", "th"))
        if need.isEmpty():
            return self.full if self.full is not None else need.select("node", F.lit(b"").alias("full"))
        w, some = self.words, build(need.select("id"))
        got = self.src.mapInArrow(lambda it: _sets(it, w, some), "id bigint, th bigint, full binary") \
            .groupBy("id", "th").agg(F.first("full").alias("full")).join(need, ["id", "th"]).select("node", "full")
        got = self.cut.rows(got)
        self.cut.drop(need)
        self.full = got if self.full is None else self.full.union(got)
        return self.full

    def exact(self, pairs: DataFrame, percent: int) -> DataFrame:
        """(a, b, shared, linked) of the pairs whose exact similarity reaches ``percent``."""
        pairs = self.cut(pairs)
        ids = pairs.select(F.col("a").alias("node")).union(pairs.select("b")).distinct()
        sets = self._full_sets(ids)
        j = pairs.join(sets.select(F.col("node").alias("a"), F.col("full").alias("fa")), "a") \
            .join(sets.select(F.col("node").alias("b"), F.col("full").alias("fb")), "b")
        s = j.select("a", "b", "fa", "fb").mapInArrow(_shared, "a bigint, b bigint, shared bigint, united bigint")
        out = self.cut(s.where(F.col("shared") * 100 >= F.col("united") * percent).select(
            "a", "b", "shared", (F.col("shared") * 100 >= F.col("united") * self.percent).alias("linked")))
        self.cut.drop(pairs)
        return out

    # -- candidates ------------------------------------------------------------

    def _need(self, n: Column) -> Column:
        """Of a set of n <= K values, so many that any linked set's sketch holds one:
        one more than a linked set may lack or, being larger, keep out of its sketch."""
        lacked = n - F.ceil(n * F.lit(self.percent) / 100)
        larger = F.floor(n * 100 / F.lit(self.percent))
        unkept = F.floor((n + larger) * 100 / F.lit(100 + self.percent)) - K
        return F.greatest(lacked, unkept) + 1

    def links(self) -> DataFrame:
        """All links (a, b) between classes that components need."""
        t = self.percent / 100
        link_cut = t - 6 * (t * (1 - t) / K) ** 0.5
        far = max(2 * self.percent - 100, 0)                       # similarity at the border's end
        b = max(far / 100, 0.05)
        far_cut = max(b - 4.5 * (b * (1 - b) / K) ** 0.5, 0.05)
        # smaller sets are linked with no set but their equals
        todo = self.r.where(F.col("n") * 100 >= (F.col("n") + 1) * self.percent) \
            .select("node", "n", F.explode("sketch").alias("v"))
        small, need = F.col("n") <= K, self._need(F.col("n"))
        surely = F.when(small, need).otherwise(SAFE)
        found: list[DataFrame] = []
        stars: list[DataFrame] = []
        size, forest = None, None
        nodes, whole = self.r.agg(F.count(F.lit(1)), F.coalesce(F.sum("n"), F.lit(0))).first()
        cut = self.cut
        while True:
            df = todo.groupBy("v").agg(F.count(F.lit(1)).alias("df")).where(F.col("df") > 1)
            post = cut(todo.join(df, "v"))
            cut.drop(todo)
            n = post.select("node").distinct().count()
            if not n:
                break
            if size is not None:
                # all pairs of what is left, when that costs less than the lists so far, or (by blocks)
                # than a round may, or when nothing else helps
                short = self._shortest(post)
                cost, work = short.groupBy("v").agg(F.count(F.lit(1)).cast("double").alias("c"), F.sum("n").alias("s")) \
                    .agg(F.sum(F.col("c") * F.col("c") / 2), F.sum(F.col("c") * F.col("s") / 2)).first()
                if cost <= LIST_COST * nodes:
                    found.append(cut(self.estimated(self._pairs(short), link_cut)))
                    break
                if work <= PASSES * whole or n > 0.7 * size:
                    pairs, many = self._likely(short, link_cut)
                    found.append(pairs)
                    forest = self._all_pairs(many)
                    cut.drop(many)
                    break
            size = n
            # a row per class: its long lists, the longest first, and what they weigh together
            per = post.where(F.col("df") > HOT).groupBy("node").agg(
                F.first("n").alias("n"), F.sort_array(F.collect_list(F.struct("df", "v")), asc=False).alias("lists")) \
                .withColumn("hots", F.size("lists")) \
                .withColumn("weight", F.aggregate("lists", F.lit(0.0), lambda s, x: s + F.log2(x["df"])))
            per = cut(per)
            found.append(cut(self.estimated(self._pairs(post.where(F.col("df") <= HOT), per), link_cut)))
            star, top = self._stars(per, far)
            pivots = top.groupBy(F.col("b").alias("node")).agg(F.count(F.lit(1)).alias("lists"), F.first("nb").alias("n"))
            near = self.exact(self.estimated(star.select("a", "b"), far_cut), far)
            tested = cut(star.join(near, ["a", "b"]))
            stars.append(tested)
            safe = tested.where(F.col("linked") & (F.col("o") >= surely)).select(F.col("a").alias("node")) \
                .union(pivots.where(F.col("lists") >= surely).select("node")).distinct()
            rest = per.where(F.when(small, F.col("n") - F.col("hots") < need).otherwise(F.col("hots") >= FEW)) \
                .select("node").join(safe, "node", "left_anti")
            todo = cut(post.select("node", "n", "v").join(rest, "node", "left_semi"))
            cut.drop(post, per, star, near, top)
            cut.sweep()
        cut.drop(post)
        if not found:
            return self.r.select(F.col("node").alias("a"), F.col("node").alias("b")).limit(0)
        pairs = found[0]
        for f in found[1:]:
            pairs = pairs.union(f)
        linked = self.exact(pairs.distinct(), self.percent)
        cut.drop(*found)
        links = linked.where("linked").select("a", "b")
        if forest is not None:
            links = links.union(forest)
        star = stars[0]
        for s in stars[1:]:
            star = star.unionByName(s)
        links = cut(links.union(star.where("linked").select("a", "b")))
        cut.drop(linked, forest)
        cut.sweep()
        return cut(links.union(self._border(links, star)))

    def _pairs(self, short: DataFrame, per: DataFrame | None = None) -> DataFrame:
        """Distinct pairs of short lists' members whose sizes (and, given the
        number of long lists of each, overlaps) allow a link."""
        s = short.select("v", "node", "n")
        x, y = s.alias("x"), s.alias("y")
        j = x.join(y, F.col("x.v") == F.col("y.v")).where(
            (F.col("x.node") < F.col("y.node")) & self._near(F.col("x.n"), F.col("y.n"), self.percent))
        p = j.groupBy(F.col("x.node").alias("a"), F.col("y.node").alias("b")).agg(
            F.count(F.lit(1)).alias("o"), F.max(F.greatest("x.n", "y.n")).alias("m"))
        if per is None:
            return p.select("a", "b")
        h = per.select("node", "hots")
        p = p.join(h.select(F.col("node").alias("a"), F.col("hots").alias("ha")), "a", "left") \
            .join(h.select(F.col("node").alias("b"), F.col("hots").alias("hb")), "b", "left")
        # of the union's K smallest values a linked pair shares this many but for a chance below 1e-7
        # (small sets: percent of all); at most the smaller number of long lists is not counted here
        t = self.percent / 100
        sure = max(1, int(K * t - 6.5 * (K * t * (1 - t)) ** 0.5))
        least = F.when(F.col("m") < K, F.ceil(F.col("m") * F.lit(self.percent) / 100)).otherwise(sure)
        long = F.least(F.coalesce("ha", F.lit(0)), F.coalesce("hb", F.lit(0)))
        return p.where(F.col("o") >= F.greatest(F.lit(1), least - long)).select("a", "b")

    def _shortest(self, post: DataFrame) -> DataFrame:
        """Each class's shortest lists.  Of a set no larger than its sketch, so many
        that two linked sets must share one (all but what may differ); else FEW."""
        from pyspark.sql import Window
        w = Window.partitionBy("node").orderBy("df", "v")
        # a list of one class is not in post: it takes its place among the shortest
        alone = F.least(F.col("n"), F.lit(K)) - F.count(F.lit(1)).over(Window.partitionBy("node"))
        most = F.when(F.col("n") <= K, self._need(F.col("n"))).otherwise(FEW) - F.least(alone, F.lit(FEW - 4))
        return post.withColumn("_r", F.row_number().over(w)).withColumn("_m", most).where(F.col("_r") <= F.col("_m"))

    def _stars(self, per: DataFrame, far: int) -> tuple[DataFrame, DataFrame]:
        """(a, b, o, n): a class, the pivot of o of its long lists, the class's size;
        (v, b, nb): a long list, its pivot, the pivot's size."""
        h = per.select("node", "n", "weight", F.explode("lists").alias("x")).select("node", "n", "weight", F.col("x.v").alias("v"))
        top = self.cut(h.groupBy("v").agg(F.max(F.struct("weight", -F.col("node"), "n")).alias("p"))
                       .select("v", (-F.col("p.col2")).alias("b"), F.col("p.n").alias("nb")))
        star = h.join(top, "v").where((F.col("node") != F.col("b")) & self._near(F.col("n"), F.col("nb"), far)) \
            .groupBy(F.col("node").alias("a"), "b").agg(F.count(F.lit(1)).alias("o"), F.first("n").alias("n"))
        return self.cut(star), top

    def _likely(self, lists: DataFrame, least: float) -> tuple[DataFrame, DataFrame]:
        """Pairs (a, b) of classes of one list whose sketches come near, and those rows of
        ``lists`` whose classes have too many such others for pairs (see ``_near_ones``).
        Of all other classes the full sets are not needed.

        A list is dealt into blocks by class, and each block meets itself and each other."""
        lists = self.cut(lists.select("v", "node", "n"))
        count = lists.groupBy("v").agg(F.count(F.lit(1)).alias("c")).where(F.col("c") > 1) \
            .select("v", F.ceil(F.col("c") / SIDE).cast("int").alias("blocks"))
        own = F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int")
        x = lists.join(count, "v").withColumn("own", own) \
            .join(self.r.select("node", "brief"), "node") \
            .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))) \
            .select("v", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"), "own", "node", "n", "brief")
        percent = self.percent
        near = self.cut(x.repartition("v", "i", "j").sortWithinPartitions("v", "i", "j")
                        .mapInArrow(lambda it: _likely(it, least, percent), "v bigint, a bigint, b bigint"))
        many = near.where(F.col("b") < 0).select("v", F.col("a").alias("node")).distinct()
        many = self.cut(lists.join(many, ["v", "node"], "left_semi"))
        pairs = self.cut(self.estimated(near.where(F.col("b") >= 0).select("a", "b").distinct(), least))
        self.cut.drop(lists, near)
        return pairs, many

    def _all_pairs(self, lists: DataFrame) -> DataFrame:
        """Links that join what is linked within each list, found block by block.

        Sizes fall into bands so wide that linked sets lie in one band or in two
        neighbouring ones: a list's band meets itself and the next, nothing else."""
        # a hair below one band for the largest ratio of sizes, so rounding can't part linked sets
        width = float(-np.log(self.percent / 100)) / 0.999
        band = F.floor(F.log(F.col("n").cast("double")) / F.lit(width)) if width > 0 else F.col("n")
        own = F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int")
        banded = lists.select("v", "node", "n", band.cast("long").alias("band"))
        count = banded.groupBy("v", "band").agg(F.ceil(F.sum("n") / BLOCK).cast("int").alias("blocks"))
        full = self._full_sets(lists.select("node").distinct())
        x = self.cut(banded.join(count, ["v", "band"]).withColumn("own", own).join(
            count.select("v", (F.col("band") - 1).alias("band"), F.col("blocks").alias("above")), ["v", "band"], "left").join(
            count.select("v", (F.col("band") + 1).alias("band"), F.col("blocks").alias("below")), ["v", "band"], "left"))
        placed, x = x, x.join(full, "node")
        last = F.col("blocks") - 1
        lower, upper = F.sequence(F.lit(0), F.col("own")), F.sequence(F.col("own"), last)
        every = lambda c: F.sequence(F.lit(0), F.col(c) - 1)
        # up: 0 a band against itself, 1 against the next
        xs = x.select("v", "band", F.lit(0).alias("up"), F.col("own").alias("i"), F.explode(upper).alias("j"), "node", "full") \
            .union(x.where("above is not null").select("v", "band", F.lit(1), "own", F.explode(every("above")), "node", "full"))
        ys = x.select("v", "band", F.lit(0).alias("up"), F.explode(lower).alias("i"), F.col("own").alias("j"), "node", "full") \
            .union(x.where("below is not null").select("v", F.col("band") - 1, F.lit(1), F.explode(every("below")), "own",
                                                       "node", "full")) \
            .toDF("v_y", "band_y", "up_y", "i_y", "j_y", "node_y", "full_y")
        percent = self.percent
        out = self.cut(xs.groupBy("v", "band", "up", "i", "j").cogroup(ys.groupBy("v_y", "band_y", "up_y", "i_y", "j_y"))
                       .applyInArrow(lambda x, y: _join_all(x, y, percent), "a bigint, b bigint"))
        self.cut.drop(placed)
        return out

    def _border(self, links: DataFrame, star: DataFrame) -> DataFrame:
        """Links between a pivot's border and its circle, where they join components.

        The circle is one component, so one link for each class of the border is enough."""
        comp = components(links.select(F.col("a").alias("u"), F.col("b").alias("v")))
        root = lambda name: comp.select(F.col("node").alias(name), F.col("root").alias(f"r{name}"))
        n = self.r.select("node", "n")
        edge = star.where(~F.col("linked")).join(root("a"), "a", "left").join(root("b"), "b", "left") \
            .where(F.coalesce("ra", "a") != F.coalesce("rb", "b")).select(F.col("a").alias("node"), F.col("b").alias("p"))
        edge = self.cut(edge.join(n, "node"))
        circle = star.where("linked").select(F.col("a").alias("node"), F.col("b").alias("p")).join(edge.select("p").distinct(), "p")
        circle = self.cut(circle.join(n, "node"))
        sets = self._full_sets(edge.select("node").union(circle.select("node")).distinct())
        # a pivot's border and circle meet block by block: each block holds about BLOCK shingles
        blocks = lambda x, name: x.groupBy("p").agg(F.ceil(F.sum("n") / BLOCK).cast("int").alias(name))
        count = blocks(edge, "nx").join(blocks(circle, "ny"), "p")
        own = lambda m: F.pmod(F.xxhash64("node"), F.col(m)).cast("int")
        every = lambda m: F.explode(F.sequence(F.lit(0), F.col(m) - 1))
        full = sets.join(edge.select("node").union(circle.select("node")).distinct(), "node")
        xs = edge.join(full, "node").join(count, "p").select("p", own("nx").alias("i"), every("ny").alias("j"), "node", "full")
        ys = circle.join(full, "node").join(count, "p").select("p", every("nx").alias("i"), own("ny").alias("j"), "node", "full")
        percent = self.percent
        ys = ys.toDF("p_y", "i_y", "j_y", "node_y", "full_y")
        return xs.groupBy("p", "i", "j").cogroup(ys.groupBy("p_y", "i_y", "j_y")).applyInArrow(
            lambda x, y: _meet(x, y, percent), "a bigint, b bigint")

    def classes(self) -> DataFrame:
        """One row per input row: id, th, n_shingles, component (smallest id that can be reached)."""
        links = self.links()
        keep = {getattr(x, "table", None) for x in (self.docs, self.r, links)}
        for t in [t for t in self.cut.paths if t not in keep]:
            self.cut.drop(t)
        comp = components(links.select(F.col("a").alias("u"), F.col("b").alias("v")))
        self.cut.drop(links)
        self.cut.sweep()
        r = self.r.join(comp, "node", "left").withColumn("root", F.coalesce("root", "node"))
        low = r.groupBy("root").agg(F.min("id").alias("component"))
        r = r.join(low, "root").select(F.col("fp1").alias("_1"), F.col("fp2").alias("_2"), F.col("n").alias("_n"), "component")
        d = self.docs.select("id", "th", "n", "fp1", "fp2")
        j = d.join(r, (F.col("fp1") == F.col("_1")) & (F.col("fp2") == F.col("_2")) & (F.col("n") == F.col("_n")), "left")
        return j.select("id", "th", F.col("n").alias("n_shingles"), F.coalesce("component", "id").alias("component"))


def near_duplicates(df: DataFrame, words: int = 5, percent: int = 80) -> DataFrame:
    """Per row of ``df``: doc_id, n_shingles, component_id, kept.

    NULL, empty and wordless texts have no shingles and are linked with nothing;
    a NULL id counts as the smallest id; rows with one id are told apart by
    their text, and share the id's fate in ``kept``; an empty table gives no
    rows; other columns play no part."""
    c = NearDuplicates(df, words, percent).classes()
    return c.select(key_id("id").alias("doc_id"), "n_shingles", key_id("component").alias("component_id"),
                    (F.col("id") == F.col("component")).alias("kept"))


def drop_near_duplicates(df: DataFrame, words: int = 5, percent: int = 80) -> DataFrame:
    """``df`` with one row of each group: that of the smallest id (of equal rows
    one, of different texts with one id in one group the first by text).  Rows
    without words all stay."""
    c = NearDuplicates(df, words, percent).classes()
    keep = c.where((F.col("id") == F.col("component")) & (F.col("n_shingles") > 0)).groupBy("component") \
        .agg(F.min("th").alias("_kt")).select(F.col("component").alias("_ki"), "_kt")
    lone = c.where(F.col("n_shingles") == 0).select(F.col("id").alias("_ki"), F.col("th").alias("_kt")).distinct()
    i, t = (free_name(df, x) for x in ("_id", "_th"))
    src = df.withColumns({i: id_key(), t: F.xxhash64(F.coalesce(F.col("text").cast("string"), F.lit("")))})
    cols = df.columns
    one = src.join(keep, (F.col(i) == F.col("_ki")) & (F.col(t) == F.col("_kt"))).dropDuplicates([i, t])
    none = src.join(lone, (F.col(i) == F.col("_ki")) & (F.col(t) == F.col("_kt")), "left_semi")
    return one.select(*cols).unionByName(none.select(*cols))


def op4_minhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(documents(spark, sf_dir), words=2, percent=80)

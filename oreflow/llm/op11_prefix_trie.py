"""Prefix trie of conversations by time-forward processing.

A node is a distinct sequence of first turns.  Its key is the sum (128 bits) of
the SHA-256 values of (position, turn) along the path, so prefix keys are
running sums and no conversation is gathered.  Nodes are grouped by key; then
subtree totals go from children to parents:

1. Nodes of more than a certain number of conversations (at most TOP of them)
   form the trie's top; what hangs below is cut into shards, each the subtree of
   a node outside the top whose parent is in it.
2. Within a shard nodes are sorted externally, deepest level first.  A node's
   finished row waits for its parent in a priority queue that spills to disk;
   the parent takes its children's rows off the front, adds up their totals,
   fills itself in as their parent and goes on to its own.
3. The shards' roots are added up by parent, and the top goes the same way.

A node of a single conversation heads a chain without branches: only the first
one of a chain goes through the shards.
"""

from __future__ import annotations

import hashlib
import heapq
import pickle
import tempfile
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import cut
from .op10_sharding import _crc_sql
from .scan import ordered, running_sums

TOP = 1 << 14            # nodes in the top at most
LEAST = 256              # conversations that a subtree outside the top may have in any case
QUEUE = 50_000           # rows a queue holds in memory
CHUNK = 1 << 20          # characters of ids hashed at a time
HEADS = 8                # first turns that a conversation can take from another
EMPTY = hashlib.sha256(b"").hexdigest()


class SpillingQueue:
    """Smallest tuple first; all beyond ``limit`` go to sorted runs on disk."""

    def __init__(self, limit: int = QUEUE):
        self.limit, self.heap, self.heads = limit, [], []
        self.runs = 0

    def push(self, item: tuple) -> None:
        heapq.heappush(self.heap, item)
        if len(self.heap) > self.limit:
            f = tempfile.TemporaryFile()
            self.heap.sort()
            for at in range(0, len(self.heap), 1000):
                pickle.dump(self.heap[at:at + 1000], f)
            f.seek(0)
            self.heap = []
            self.runs += 1
            self._next(self._read(f))

    @staticmethod
    def _read(f) -> Iterator[tuple]:
        with f:
            while True:
                try:
                    yield from pickle.load(f)
                except EOFError:
                    return

    def _next(self, run: Iterator[tuple]) -> None:
        for item in run:
            heapq.heappush(self.heads, (item, id(run), run))
            return

    def first(self) -> tuple | None:
        a = self.heap[0] if self.heap else None
        b = self.heads[0][0] if self.heads else None
        return b if a is None or b is not None and b < a else a

    def pop(self) -> tuple:
        item = self.first()
        if self.heap and self.heap[0] is item:
            return heapq.heappop(self.heap)
        _, _, run = heapq.heappop(self.heads)
        self._next(run)
        return item


# -- conversations as rows (c, pos, key, size, last) -----------------------------


def numbered_turns(df: DataFrame, conv_id: str = "conv_id", turn: str = "turn", role: str = "role",
                   text: str = "text") -> DataFrame:
    """Turns of each conversation numbered from 1, NULL turns first: c, pos, key
    (of role and text), size (bytes of the text)."""
    r, t = (F.coalesce(F.col(f"`{x}`").cast("string"), F.lit("")) for x in (role, text))
    src = df.select(
        F.col(f"`{conv_id}`").cast("long").alias("c"), F.col(f"`{turn}`").cast("long").alias("t"),
        F.sha2(F.concat(F.octet_length(r).cast("string"), F.lit(":"), r, t), 256).alias("key"),
        F.octet_length(t).cast("long").alias("size")).where("c is not null")

    def result(b: pa.RecordBatch, own: list, sums: list) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([b.column(0), pa.array(sums[0].view(np.int64)), b.column(1), b.column(2)],
                                          names=["c", "pos", "key", "size"])

    return running_sums(ordered(src, "c", "t", "key"), "c", "c key size", lambda b: [np.ones(b.num_rows, np.uint64)], result,
                        "c bigint, pos bigint, key string, size bigint")


def rebuilt(turns: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Each conversation c with the first h turns of conversation c - c % 5 in place
    of its own first h, h = crc32(c) % 9: turns and conversations (c, length)."""
    turns = cut(turns)
    length = cut(turns.groupBy("c").agg(F.count(F.lit(1)).alias("n")))
    h = F.crc32(F.col("c").cast("string").cast("binary")) % (HEADS + 1)
    convs = length.select("c", "n", (F.col("c") - F.col("c") % 5).alias("base"), h.alias("h"))
    convs = convs.join(length.select(F.col("c").alias("base"), F.col("n").alias("m")), "base", "left") \
        .withColumn("k", F.least("h", F.coalesce("m", F.lit(0)))) \
        .withColumn("length", F.col("k") + F.greatest(F.col("n") - F.col("h"), F.lit(0)))
    convs = cut(convs.select("c", "base", "h", "k", "length"))
    head = turns.where(F.col("pos") <= HEADS).withColumnRenamed("c", "base") \
        .join(convs.select("c", "base", "k", "length"), "base").where(F.col("pos") <= F.col("k"))
    own = turns.join(convs.select("c", "h", "k", "length"), "c").where(F.col("pos") > F.col("h")) \
        .withColumn("pos", F.col("k") + F.col("pos") - F.col("h"))
    cols = ["c", "pos", "key", "size", (F.col("pos") == F.col("length")).alias("last")]
    return head.select(*cols).unionByName(own.select(*cols)), convs.select("c", "length")


# -- nodes --------------------------------------------------------------------


def _paths(turns: DataFrame) -> DataFrame:
    """A row for each conversation and depth: the node's key p, its parent's key q."""
    step = F.unhex(F.sha2(F.concat(F.col("pos").cast("string"), F.lit(":"), "key"), 256))
    src = ordered(turns.select("c", F.col("pos").alias("depth"), step.alias("step"), "size", "last"), "c", "depth")

    def values(b: pa.RecordBatch) -> list[np.ndarray]:
        col = b.column(b.schema.get_field_index("step"))
        raw = np.frombuffer(b"".join(col.to_pylist()), "<u8").reshape(-1, 4)
        return [raw[:, 0], raw[:, 1]]

    def result(b: pa.RecordBatch, own: list, sums: list) -> pa.RecordBatch:
        q = [s - v for s, v in zip(sums, own)]
        return pa.RecordBatch.from_arrays(
            [b.column(0), b.column(1), *[pa.array(np.ascontiguousarray(x).view(np.int64)) for x in (*sums, *q)], b.column(3), b.column(4)],
            names=["c", "depth", "p1", "p2", "q1", "q2", "size", "last"])

    return running_sums(src, "c", "c depth step size last", values, result,
                        "c bigint, depth bigint, p1 bigint, p2 bigint, q1 bigint, q2 bigint, size bigint, last boolean")


def _ends(members: DataFrame) -> DataFrame:
    """(p1, p2, ends): SHA-256 of the ascending ids of the conversations (c) that
    end at a node.  A range of a node's ids is joined where it lies; the pieces,
    one per range, are hashed one after the other."""

    def chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            p1, p2, c = (b.column(i).to_numpy() for i in range(3))
            if not len(c):
                continue
            at = np.flatnonzero(np.append(True, (p1[1:] != p1[:-1]) | (p2[1:] != p2[:-1])))
            parts = [",".join(map(str, c[x:y].tolist())) for x, y in zip(at, np.append(at[1:], len(c)))]
            yield pa.RecordBatch.from_arrays([pa.array(p1[at]), pa.array(p2[at]), pa.array(c[at]), pa.array(parts)],
                                             names=["p1", "p2", "c", "part"])

    def hashes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, h = None, None
        for b in batches:
            out = []
            for p1, p2, part in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), b.column(3)):
                if (p1, p2) != key:
                    if key:
                        out.append((*key, h.hexdigest()))
                    key, h = (p1, p2), hashlib.sha256()
                else:
                    h.update(b",")
                h.update(part.as_buffer())
            yield _rows(out, ("p1", "p2", "ends"), "llS")
        if key:
            yield _rows([(*key, h.hexdigest())], ("p1", "p2", "ends"), "llS")

    s = members.select("p1", "p2", "c").repartitionByRange("p1", "p2", "c").sortWithinPartitions("p1", "p2", "c")
    return s.mapInArrow(chunks, "p1 bigint, p2 bigint, c bigint, part string").repartition("p1", "p2") \
        .sortWithinPartitions("p1", "p2", "c").mapInArrow(hashes, "p1 bigint, p2 bigint, ends string")


def _rows(rows: list[tuple], names: tuple, kinds: str) -> pa.RecordBatch:
    cols = list(zip(*rows)) or [()] * len(names)
    return pa.RecordBatch.from_arrays([pa.array(c, pa.string() if k == "S" else pa.int64()) for c, k in zip(cols, kinds)],
                                      names=list(names))


_OUT = ("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends", "q1", "q2")
_OUT_DDL = "conv_id bigint, depth bigint, parent_conv_id bigint, n_convs bigint, n_children bigint, n_leaves bigint, " \
           "saved_tokens bigint, ends string, q1 bigint, q2 bigint"
_NODE = ["s1", "s2", "depth", "p1", "p2", "q1", "q2", "conv_id", "n_convs", "size", "ends", "children", "leaves", "saved"]


def _forward(batches: Iterator[pa.RecordBatch], limit: int) -> Iterator[pa.RecordBatch]:
    """Nodes (_NODE) shard by shard, deepest first, to finished rows.  Rows of shard
    roots have no parent_conv_id yet, but its key (q1, q2)."""
    queue, out = SpillingQueue(limit), []
    for b in batches:
        for s1, s2, depth, p1, p2, q1, q2, conv, n, size, ends, children, leaves, saved in zip(*(c.to_pylist() for c in b.columns)):
            here = (s1, s2, -depth, p1, p2)
            while (item := queue.first()) is not None and item[:5] == here:
                row = queue.pop()[5]
                out.append((*row[:2], conv, *row[2:], None, None))
                children += 1
                leaves += row[4]
                saved += row[5]
            row = (conv, depth, n, children, leaves if children else 1, saved + (n - 1) * size, ends)
            if (p1, p2) == (s1, s2):
                out.append((*row[:2], None, *row[2:], q1, q2))
            else:
                queue.push((s1, s2, 1 - depth, q1, q2, row))
        if len(out) >= 5000:
            yield _rows(out, _OUT, "lllllllSll")
            out = []
    yield _rows(out, _OUT, "lllllllSll")


def prefix_trie(turns: DataFrame, convs: DataFrame, least: int = LEAST, queue: int = QUEUE) -> DataFrame:
    """One row per node: conv_id (smallest member), depth, parent_conv_id, n_convs,
    n_children, n_leaves, saved_tokens, ends_sha256.

    ``turns`` has a row (c, pos, key, size, last) per turn, ``convs`` a row (c) per
    conversation; one without turns is a member of the root alone, the root has
    no parent, and a table without conversations has no nodes."""
    spark = turns.sparkSession
    paths = cut(_paths(turns))
    rows, n_convs, low = paths.count(), *convs.agg(F.count(F.lit(1)), F.min("c")).first()
    if not n_convs:
        return spark.createDataFrame([], _OUT_DDL).drop("q1", "q2").withColumnRenamed("ends", "ends_sha256")
    nodes = cut(paths.groupBy("depth", "p1", "p2").agg(
        F.count(F.lit(1)).alias("n_convs"), F.min("c").alias("conv_id"), F.first("size").alias("size"),
        F.first("q1").alias("q1"), F.first("q2").alias("q2")))
    # fewer than rows / most nodes have more members than ``most``
    most = max(least, rows // TOP)
    heavy = nodes.where(F.col("n_convs") > most).select("p1", "p2", "conv_id").collect()
    top = F.broadcast(spark.createDataFrame([(0, 0, low), *[tuple(r) for r in heavy]], "h1 bigint, h2 bigint, top_conv bigint"))
    is_top = lambda a, b: (F.col(a) == F.col("h1")) & (F.col(b) == F.col("h2"))

    members = paths.where("last").select("p1", "p2", "c").unionByName(
        convs.join(paths.select("c").distinct(), "c", "left_anti").select(F.lit(0).cast("long").alias("p1"), F.lit(0).cast("long").alias("p2"), "c"))
    ends = cut(_ends(members))
    hashed = lambda d: d.join(ends, ["p1", "p2"], "left").withColumn("ends", F.coalesce("ends", F.lit(EMPTY)))

    # chains of single conversations
    alone = nodes.where("n_convs = 1")
    chain = alone.groupBy("conv_id").agg(F.min("depth").alias("f"), F.max("depth").alias("l"))
    alone = alone.join(chain, "conv_id")
    tails = alone.where(F.col("depth") > F.col("f")).select(
        "conv_id", "depth", F.col("conv_id").alias("parent_conv_id"), "n_convs", (F.col("depth") < F.col("l")).cast("long").alias("n_children"),
        F.lit(1).cast("long").alias("n_leaves"), F.lit(0).cast("long").alias("saved_tokens"),
        F.when(F.col("depth") == F.col("l"), F.sha2(F.col("conv_id").cast("string"), 256)).otherwise(EMPTY).alias("ends"))
    zero = F.lit(0).cast("long")
    heads = alone.where(F.col("depth") == F.col("f")).withColumns(
        {"children": (F.col("f") < F.col("l")).cast("long"), "leaves": F.lit(1).cast("long"), "saved": zero}).drop("f", "l")
    shared = nodes.where((F.col("n_convs") > 1) & (F.col("n_convs") <= most)).withColumns({"children": zero, "leaves": zero, "saved": zero})

    # a conversation's shard: the first node of its path outside the top
    shard = paths.join(top, is_top("q1", "q2"), "left_semi").join(top, is_top("p1", "p2"), "left_anti") \
        .select(F.col("c").alias("conv_id"), F.col("p1").alias("s1"), F.col("p2").alias("s2"))
    inner = hashed(shared.unionByName(heads)).join(shard, "conv_id").select(*_NODE)
    done = cut(inner.repartition("s1", "s2").sortWithinPartitions("s1", "s2", F.col("depth").desc(), "p1", "p2")
               .mapInArrow(lambda it: _forward(it, queue), _OUT_DDL))

    # across shard roots: the top, at most TOP nodes and the root
    up = done.where("parent_conv_id is null").groupBy(F.col("q1").alias("p1"), F.col("q2").alias("p2")).agg(
        F.count(F.lit(1)).alias("children"), F.sum("n_leaves").alias("leaves"), F.sum("saved_tokens").alias("saved"))
    root = spark.createDataFrame([(0, 0, 0, n_convs, low, 0, None, None)],
                                 "depth bigint, p1 bigint, p2 bigint, n_convs bigint, conv_id bigint, size bigint, q1 bigint, q2 bigint")
    high = hashed(nodes.where(F.col("n_convs") > most).unionByName(root).join(up, ["p1", "p2"], "left")) \
        .fillna(0, ["children", "leaves", "saved"]).withColumns({"s1": zero, "s2": zero}).select(*_NODE)
    high = high.repartition(1).sortWithinPartitions(F.col("depth").desc(), "p1", "p2").mapInArrow(lambda it: _forward(it, queue), _OUT_DDL)

    out = [c for c in _OUT if c not in ("q1", "q2")]
    roots = done.where("parent_conv_id is null").drop("parent_conv_id").join(top, is_top("q1", "q2")) \
        .withColumnRenamed("top_conv", "parent_conv_id")
    whole = done.where("parent_conv_id is not null").select(*out).unionByName(roots.select(*out)) \
        .unionByName(high.select(*out)).unionByName(tails.select(*out))
    return whole.withColumnRenamed("ends", "ends_sha256")


def conversation_trie(df: DataFrame, conv_id: str = "conv_id", turn: str = "turn", role: str = "role",
                      text: str = "text") -> DataFrame:
    """The trie of a table of turns as they are.

    Turns go by number, NULL first, then by a hash of role and text (equal rows
    are turns each); NULL roles and texts are empty; rows without a conversation
    belong to none; other columns play no part; an empty table has no nodes."""
    turns = cut(numbered_turns(df, conv_id, turn, role, text))
    convs = turns.groupBy("c").agg(F.count(F.lit(1)).alias("length"))
    return prefix_trie(turns.join(convs, "c").select("c", "pos", "key", "size", (F.col("pos") == F.col("length")).alias("last")), convs)


def op11_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefix_trie(*rebuilt(numbered_turns(spark.read.parquet(f"{sf_dir}/conversations.parquet"))))


OP11_SQL = f"""
WITH src AS (
  SELECT conv_id, turn, coalesce(role, '') AS r, coalesce(text, '') AS t FROM conversations WHERE conv_id IS NOT NULL),
lists AS (
  SELECT conv_id, list({{'r': r, 't': t}} ORDER BY turn NULLS FIRST, sha256(strlen(r) || ':' || r || t)) AS l FROM src GROUP BY conv_id),
digits AS (
  SELECT conv_id, flatten(list([v & 15, v >> 4] ORDER BY i)) AS nib
  FROM lists, unnest(range(length(conv_id::VARCHAR))) AS u(i), LATERAL (SELECT ascii(substr(conv_id::VARCHAR, i::INT + 1, 1))::BIGINT AS v)
  GROUP BY conv_id),
h AS (SELECT conv_id, ({_crc_sql()}) % {HEADS + 1} AS h FROM digits),
seqs AS (
  SELECT a.conv_id, list_concat(coalesce(b.l[1:h], []), a.l[h + 1:]) AS s
  FROM lists a JOIN h USING (conv_id) LEFT JOIN lists b ON b.conv_id = a.conv_id - a.conv_id % 5),
paths AS (SELECT conv_id, d, s[1:d] AS p, len(s) AS n FROM seqs, unnest(range(len(s) + 1)) AS u(d)),
nodes AS (
  SELECT p, d, min(conv_id) AS conv_id, count(*) AS n_convs, (count(*) - 1) * coalesce(strlen(p[d].t), 0) AS own,
         sha256(coalesce(string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) FILTER (WHERE n = d), '')) AS ends_sha256
  FROM paths GROUP BY p, d),
kids AS (SELECT p[1:d - 1] AS p, count(*) AS n_children FROM nodes WHERE d > 0 GROUP BY 1),
full_nodes AS (SELECT nodes.*, coalesce(n_children, 0) AS n_children FROM nodes LEFT JOIN kids USING (p)),
sub AS (
  SELECT p[1:k] AS p, sum(own) AS saved, count(*) FILTER (WHERE n_children = 0) AS leaves
  FROM full_nodes, unnest(range(d + 1)) AS u(k) GROUP BY 1)
SELECT x.conv_id, x.d AS depth, y.conv_id AS parent_conv_id, x.n_convs, x.n_children, leaves AS n_leaves,
       saved::BIGINT AS saved_tokens, x.ends_sha256
FROM full_nodes x JOIN sub USING (p) LEFT JOIN nodes y ON x.d > 0 AND y.p = x.p[1:x.d - 1]"""

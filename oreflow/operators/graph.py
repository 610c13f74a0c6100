"""Property-graph operators on two DataFrames:

* ``nodes(id, label, ...props)`` and
* ``edges(src, dst, type, ...props)`` (directed).

Pattern matches are joins; variable-length paths, BFS and weighted shortest
paths are iterative frontier joins.  Every round is a distributed join of
the frontier with the edges; the frontier is checkpointed every few rounds
to the shared checkpoint folder, so the plan does not grow with the number
of hops and a lost executor recomputes at most a few rounds.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window

from oreflow.session import checkpoint_dir


def _cut(df: DataFrame, rnd: int, every: int) -> DataFrame:
    if every and rnd % every == 0:
        checkpoint_dir(df.sparkSession)
        return df.checkpoint(eager=True)
    return df


# ------------------------------------------------------------------ building
def edges_from_keys(left: DataFrame, right: DataFrame, left_key: str, right_key: str,
                    src_id: str, dst_id: str, edge_type: str,
                    props: dict[str, Column] | None = None) -> DataFrame:
    """GR-01: MATCH (a),(b) WHERE a.k = b.k CREATE (a)-[:T {..}]->(b)."""
    j = left.join(right, left[left_key] == right[right_key])
    cols = [F.col(src_id).alias("src"), F.col(dst_id).alias("dst"), F.lit(edge_type).alias("type")]
    cols += [c.alias(k) for k, c in (props or {}).items()]
    return j.select(*cols)


def out_edges(edges: DataFrame, edge_type: str | None = None) -> DataFrame:
    return edges if edge_type is None else edges.where(F.col("type") == edge_type)


# ------------------------------------------------------------------ patterns
def one_hop(nodes: DataFrame, edges: DataFrame, edge_type: str, dst_filter: Column) -> DataFrame:
    """GR-02: (a)-[:T]->(b) WHERE <filter on b>: the a ids with b's props."""
    b = nodes.where(dst_filter).select(F.col("id").alias("dst"), *[F.col(c).alias(f"dst_{c}")
                                                                      for c in nodes.columns if c != "id"])
    return out_edges(edges, edge_type).join(b, "dst")


def chain(edges: DataFrame, types: Sequence[str]) -> DataFrame:
    """GR-03: (n0)-[:t1]->(n1)-[:t2]->(n2)...: one row per matching chain
    with columns n0..nk."""
    out = None
    for i, t in enumerate(types):
        e = out_edges(edges, t).select(F.col("src").alias(f"n{i}"), F.col("dst").alias(f"n{i + 1}"))
        out = e if out is None else out.join(e, f"n{i}")
    return out


def degrees(nodes: DataFrame, edges: DataFrame, types: Sequence[str]) -> DataFrame:
    """GR-11: per node, in/out degree per edge type (zero kept for nodes
    without edges)."""
    ends = (edges.select(F.col("src").alias("id"), "type", F.lit("out").alias("dir"))
            .unionByName(edges.select(F.col("dst").alias("id"), "type", F.lit("in").alias("dir"))))
    cols = [f"{t}_{d}" for t in types for d in ("in", "out")]
    piv = (ends.where(F.col("type").isin(list(types)))
           .withColumn("k", F.concat_ws("_", "type", "dir"))
           .groupBy("id").pivot("k", cols).count())
    out = nodes.select("id", "label").join(piv, "id", "left")
    for c in cols:
        out = out.withColumn(c, F.coalesce(F.col(c), F.lit(0)).cast("long"))
    return out


def unconnected(nodes: DataFrame, edges: DataFrame, edge_type: str, direction: str = "in") -> DataFrame:
    """GR-10: nodes without a ``direction`` edge of ``edge_type``."""
    end = "dst" if direction == "in" else "src"
    return nodes.join(out_edges(edges, edge_type).select(F.col(end).alias("id")), "id", "left_anti")


def neighbourhood(edges: DataFrame, node_id) -> DataFrame:
    """GR-17: all edges incident to one node, with the direction seen from
    the node (a union of the two incidences, no row multiplication)."""
    return (edges.where(F.col("src") == node_id).withColumn("direction", F.lit("out"))
            .withColumn("other", F.col("dst"))
            .unionByName(edges.where(F.col("dst") == node_id).withColumn("direction", F.lit("in"))
                         .withColumn("other", F.col("src"))))


def stats(nodes: DataFrame, edges: DataFrame) -> DataFrame:
    """GR-18: nodes per label, edges per type, and average degree E/N."""
    nl = nodes.groupBy(F.lit("nodes").alias("kind"), F.col("label").alias("name")).agg(
        F.count(F.lit(1)).cast("double").alias("value"))
    et = edges.groupBy(F.lit("edges").alias("kind"), F.col("type").alias("name")).agg(
        F.count(F.lit(1)).cast("double").alias("value"))
    n = nodes.select(F.count(F.lit(1))).scalar()
    avg = edges.agg((F.count(F.lit(1)) / n).alias("value")).select(
        F.lit("graph").alias("kind"), F.lit("avg_degree").alias("name"), "value")
    return nl.unionByName(et).unionByName(avg)


def detach_delete(nodes: DataFrame, edges: DataFrame, node_ids: DataFrame) -> tuple[DataFrame, DataFrame]:
    """GR-19: remove nodes and every edge touching them."""
    ids = node_ids.select(F.col("id"))
    n = nodes.join(ids, "id", "left_anti")
    e = (edges.join(ids.withColumnRenamed("id", "src"), "src", "left_anti")
         .join(ids.withColumnRenamed("id", "dst"), "dst", "left_anti"))
    return n, e


def sync_properties(nodes: DataFrame, metrics: DataFrame, key: str = "id") -> DataFrame:
    """GR-20: upsert metric columns into node properties (nodes without
    metrics keep NULL)."""
    return nodes.join(metrics, key, "left")


# -------------------------------------------------------------------- paths
def var_length_paths(edges: DataFrame, sources: DataFrame, max_hops: int, min_hops: int = 1,
                     weight: str | None = None, avoid: Sequence | None = None,
                     checkpoint_every: int = 3) -> DataFrame:
    """GR-05 / GR-08: all simple paths (no repeated node) of 1..max_hops
    edges starting at the ``sources`` ids.  Columns: start, end, path
    (array of node ids), hops, total (sum of ``weight``).  ``avoid`` removes
    nodes (and their edges) before the search (GR-08)."""
    e = edges
    if avoid:
        e = e.where(~F.col("src").isin(list(avoid)) & ~F.col("dst").isin(list(avoid)))
    w = F.col(weight) if weight else F.lit(1)
    e = e.select("src", "dst", w.cast("double").alias("__w"))
    frontier = sources.select(F.col("id").alias("start"), F.col("id").alias("end"),
                              F.array(F.col("id")).alias("path"), F.lit(0).alias("hops"),
                              F.lit(0.0).alias("total"))
    found = None
    for h in range(1, max_hops + 1):
        step = (frontier.join(e, frontier["end"] == e["src"])
                .where(~F.array_contains(F.col("path"), F.col("dst")))
                .select("start", F.col("dst").alias("end"), F.array_append("path", F.col("dst")).alias("path"),
                        F.lit(h).alias("hops"), (F.col("total") + F.col("__w")).alias("total")))
        step = _cut(step, h, checkpoint_every)
        if h >= min_hops:
            found = step if found is None else found.unionByName(step)
        frontier = step
    return found


def paths_between(edges: DataFrame, sources: DataFrame, targets: DataFrame, max_hops: int, min_hops: int = 1,
                  weight: str | None = None, avoid: Sequence | None = None) -> DataFrame:
    """GR-05 / GR-08: all simple paths of min_hops..max_hops edges from one of the
    ``sources`` to one of the ``targets`` (ids).  Columns: start, end, path, hops,
    total.  ``avoid`` removes nodes before the search.

    Half paths grow from both ends and meet on their middle node: a path of L
    edges is one of ceil(L / 2) edges from a source and one of floor(L / 2) edges
    back from a target that share no other node.  So no more than half the hops
    are ever listed without an end in sight."""
    e = edges
    if avoid:
        e = e.where(~F.col("src").isin(list(avoid)) & ~F.col("dst").isin(list(avoid)))
        sources, targets = (x.where(~F.col("id").isin(list(avoid))) for x in (sources, targets))
    w = (F.col(weight) if weight else F.lit(1)).cast("double")
    e = _cut(e.select("src", "dst", w.alias("w")), 1, 1)
    back = e.select(F.col("dst").alias("src"), F.col("src").alias("dst"), "w")
    ahead, behind = {0: _points(sources)}, {0: _points(targets)}
    found = None
    for n in range(1, max_hops + 1):
        f, b = (n + 1) // 2, n // 2
        for half, hops, by in ((ahead, f, e), (behind, b, back)):
            if hops not in half:
                half[hops] = _cut(_longer(half[hops - 1], by, "w"), 1, 1)
        if n < min_hops:
            continue
        y = behind[b].select(F.col("start").alias("y_start"), F.col("end").alias("y_end"), F.col("path").alias("y_path"),
                             F.col("total").alias("y_total"))
        rest = F.slice(F.reverse("y_path"), 2, b) if b else F.array().cast(ahead[f].schema["path"].dataType)
        j = ahead[f].join(y, F.col("end") == F.col("y_end")).where(~F.arrays_overlap("path", rest) if b else F.lit(True))
        step = j.select("start", F.col("y_start").alias("end"), F.concat("path", rest).alias("path"), F.lit(n).alias("hops"),
                        (F.col("total") + F.col("y_total")).alias("total"))
        found = step if found is None else found.unionByName(step)
    return found


def _points(ids: DataFrame) -> DataFrame:
    return ids.select(F.col("id").alias("start"), F.col("id").alias("end"), F.array("id").alias("path"), F.lit(0.0).alias("total")).distinct()


def _longer(paths: DataFrame, e: DataFrame, weight: str) -> DataFrame:
    """Simple paths with one more edge."""
    return paths.join(e, F.col("end") == F.col("src")).where(~F.array_contains("path", F.col("dst"))) \
        .select("start", F.col("dst").alias("end"), F.array_append("path", F.col("dst")).alias("path"),
                (F.col("total") + F.col(weight)).alias("total"))


def bfs_levels(edges: DataFrame, sources: DataFrame, max_hops: int | None = None,
               checkpoint_every: int = 3) -> DataFrame:
    """GR-06: unweighted shortest distance (hops) from each source to every
    reachable node; a frontier expansion that drops already visited
    (source, node) pairs, ending on an empty frontier."""
    e = _cut(edges.select("src", "dst").distinct(), 1, 1)     # not derived again in every round
    visited = sources.select(F.col("id").alias("start"), F.col("id").alias("node"), F.lit(0).alias("hops"))
    frontier = visited
    h = 0
    while True:
        h += 1
        if max_hops is not None and h > max_hops:
            break
        nxt = (frontier.join(e, frontier["node"] == e["src"])
               .select("start", F.col("dst").alias("node")).distinct()
               .join(visited.select("start", "node"), ["start", "node"], "left_anti")
               .withColumn("hops", F.lit(h)))
        nxt = _cut(nxt, h, 1)  # materialised: its emptiness decides the loop
        if nxt.isEmpty():
            break
        visited = _cut(visited.unionByName(nxt), h, checkpoint_every)
        frontier = nxt
    return visited.where(F.col("hops") > 0)


def weighted_shortest(edges: DataFrame, sources: DataFrame, weight: str) -> DataFrame:
    """GR-07: minimum total weight from each source to every reachable node
    by relaxation (Bellman-Ford on DataFrames): each round follows only the
    distances that the last one improved, until none improves.  Non-negative
    weights assumed.  The edges are written once, not derived in every round."""
    e = _cut(edges.groupBy("src", "dst").agg(F.min(F.col(weight).cast("double")).alias("__w")), 1, 1)
    dist = sources.select(F.col("id").alias("start"), F.col("id").alias("node"), F.lit(0.0).alias("dist"))
    frontier = dist
    while True:
        cand = (frontier.join(e, frontier["node"] == e["src"])
                .select("start", F.col("dst").alias("node"), (F.col("dist") + F.col("__w")).alias("dist"))
                .groupBy("start", "node").agg(F.min("dist").alias("dist")))
        better = cand.join(dist.withColumnRenamed("dist", "__old"), ["start", "node"], "left") \
            .where(F.col("__old").isNull() | (F.col("dist") < F.col("__old"))).drop("__old")
        frontier = _cut(better, 1, 1)
        if frontier.isEmpty():
            break
        dist = _cut(dist.unionByName(frontier).groupBy("start", "node").agg(F.min("dist").alias("dist")), 1, 1)
    return dist.where(F.col("start") != F.col("node"))


def impact_set(edges: DataFrame, target, max_hops: int) -> DataFrame:
    """GR-09: every node from which ``target`` can be reached, with each number
    of steps up to ``max_hops`` that takes it there without passing the target
    before.  Rounds over sets of (node, length): no path is listed, and a round
    is no larger than the number of nodes."""
    rev = _cut(edges.select(F.col("dst").alias("at"), F.col("src").alias("node"))
               .where(F.col("src") != F.lit(target)).distinct(), 1, 1)
    frontier = rev.where(F.col("at") == F.lit(target)).select("node")
    found = None
    for n in range(1, max_hops + 1):
        level = frontier.withColumn("length", F.lit(n))
        found = level if found is None else found.unionByName(level)
        if n < max_hops:
            frontier = _cut(frontier.withColumnRenamed("node", "at").join(rev, "at").select("node").distinct(), 1, 1)
            if frontier.isEmpty():
                break
    return found


def expand_context(edges: DataFrame, seeds: DataFrame, hops: int) -> DataFrame:
    """GR-21: facts (edges) within ``hops`` of the seed entities, edges
    taken in both directions; one row per (seed, hop, edge)."""
    und = (edges.select("src", "dst", "type")
           .unionByName(edges.select(F.col("dst").alias("src"), F.col("src").alias("dst"), "type")))
    reach = seeds.select(F.col("id").alias("seed"), F.col("id").alias("node"))
    seen = reach
    out = None
    for h in range(1, hops + 1):
        facts = reach.join(und, reach["node"] == und["src"]).select(
            "seed", F.lit(h).alias("hop"), "src", "dst", "type")
        out = facts if out is None else out.unionByName(facts)
        nxt = facts.select("seed", F.col("dst").alias("node")).distinct().join(seen, ["seed", "node"], "left_anti")
        seen = seen.unionByName(nxt)
        reach = nxt
    return out


def intervals(events: DataFrame, node: str, ts: str, tiebreak: str | None = None,
              bucket_s: int | None = None) -> DataFrame:
    """GR-15: days between consecutive events of a node: avg, min, max.
    With ``tiebreak`` and ``bucket_s`` the window is bucketed by time (a node with a third of all events is spread over its time buckets)."""
    from oreflow.operators.windows import bucketed_neighbour
    if tiebreak and bucket_s:
        d = bucketed_neighbour(events, [node], ts, tiebreak, bucket_s, ts, "__prev")
        d = d.withColumn("__gap", F.datediff(F.col(ts), F.col("__prev")))
    else:
        w = Window.partitionBy(node).orderBy(*([ts, tiebreak] if tiebreak else [ts]))
        d = events.withColumn("__gap", F.datediff(F.col(ts), F.lag(ts).over(w)))
    return (d.where(F.col("__gap").isNotNull()).groupBy(node)
            .agg(F.avg("__gap").alias("avg_days"), F.min("__gap").alias("min_days"),
                 F.max("__gap").alias("max_days"), F.count(F.lit(1)).alias("n_intervals")))

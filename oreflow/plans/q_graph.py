"""Registered graph queries over a property graph derived from the tables.

Nodes: Customer, Supplier, Part, Nation, Region (ids prefixed by label).
Edges: LOCATED_IN (customer/supplier -> nation), PART_OF (nation ->
region), SUPPLIES (supplier -> part), BOUGHT (customer -> part, revenue),
TRADES_WITH (nation -> nation: each nation's three main trade routes by
revenue, weighted by a distance derived from the revenue).
"""

from __future__ import annotations

from pyspark.sql import functions as F

from oreflow.functions.numeric import round_half_up as rh
from oreflow.operators import graph as g
from oreflow.plans.registry import query
from oreflow.plans.sqlfmt import rnd
from oreflow.sources.tables import production, read


def _id(label: str, col: str):
    return F.concat(F.lit(label[0] + ":"), F.col(col).cast("string"))


def build_graph(spark, d):
    c, s, p = read(spark, d, "customer"), read(spark, d, "supplier"), read(spark, d, "part")
    n, r = read(spark, d, "nation"), read(spark, d, "region")
    nodes = (c.select(_id("C", "c_custkey").alias("id"), F.lit("Customer").alias("label"),
                      F.col("c_name").alias("name"))
             .unionByName(s.select(_id("S", "s_suppkey").alias("id"), F.lit("Supplier").alias("label"),
                                   F.col("s_name").alias("name")))
             .unionByName(p.select(_id("P", "p_partkey").alias("id"), F.lit("Part").alias("label"),
                                   F.col("p_type").alias("name")))
             .unionByName(n.select(_id("N", "n_nationkey").alias("id"), F.lit("Nation").alias("label"),
                                   F.col("n_name").alias("name")))
             .unionByName(r.select(_id("R", "r_regionkey").alias("id"), F.lit("Region").alias("label"),
                                   F.col("r_name").alias("name"))))
    e = [c.select(_id("C", "c_custkey").alias("src"), _id("N", "c_nationkey").alias("dst"),
                  F.lit("LOCATED_IN").alias("type"), F.lit(None).cast("double").alias("weight")),
         s.select(_id("S", "s_suppkey").alias("src"), _id("N", "s_nationkey").alias("dst"),
                  F.lit("LOCATED_IN").alias("type"), F.lit(None).cast("double").alias("weight")),
         n.select(_id("N", "n_nationkey").alias("src"), _id("R", "n_regionkey").alias("dst"),
                  F.lit("PART_OF").alias("type"), F.lit(None).cast("double").alias("weight"))]
    li = read(spark, d, "lineitem")
    e.append(li.groupBy("l_suppkey", "l_partkey").agg(F.sum("l_quantity").alias("weight"))
             .select(_id("S", "l_suppkey").alias("src"), _id("P", "l_partkey").alias("dst"),
                     F.lit("SUPPLIES").alias("type"), "weight"))
    pr = production(spark, d)
    e.append(pr.groupBy("o_custkey", "l_partkey")
             .agg(F.sum(F.col("l_extendedprice") * (1 - F.col("l_discount"))).alias("weight"))
             .select(_id("C", "o_custkey").alias("src"), _id("P", "l_partkey").alias("dst"),
                     F.lit("BOUGHT").alias("type"), "weight"))
    e.append(trade_routes(spark, d))
    edges = e[0]
    for x in e[1:]:
        edges = edges.unionByName(x)
    return nodes, edges


def trade_routes(spark, d):
    """TRADES_WITH: customer nation -> supplier nation, all pairs that trade."""
    pr = production(spark, d)
    c = read(spark, d, "customer").select("c_custkey", "c_nationkey")
    s = read(spark, d, "supplier").select("s_suppkey", "s_nationkey")
    t = (pr.join(c, pr.o_custkey == c.c_custkey).join(s, pr.l_suppkey == s.s_suppkey)
         .where(F.col("c_nationkey") != F.col("s_nationkey"))
         .groupBy("c_nationkey", "s_nationkey")
         .agg(F.sum(F.col("l_extendedprice") * (1 - F.col("l_discount"))).alias("rev")))
    return t.select(_id("N", "c_nationkey").alias("src"), _id("N", "s_nationkey").alias("dst"),
                    F.lit("TRADES_WITH").alias("type"),
                    (F.round(F.lit(1e8) / F.col("rev")) + 1).alias("weight"))


ROUTES_SQL = """
t AS (SELECT c.c_nationkey a, s.s_nationkey b, sum(l.l_extendedprice * (1 - l.l_discount)) rev
      FROM lineitem l JOIN orders o ON o.o_orderkey = l.l_orderkey JOIN customer c ON c.c_custkey = o.o_custkey
      JOIN supplier s ON s.s_suppkey = l.l_suppkey WHERE c.c_nationkey <> s.s_nationkey GROUP BY ALL),
routes AS (SELECT 'N:' || CAST(a AS VARCHAR) AS src, 'N:' || CAST(b AS VARCHAR) AS dst, round(1e8 / rev) + 1 AS w
           FROM t)"""


@query("gr_stats", ops=("GR-01", "GR-18"), sql=f"""
WITH {ROUTES_SQL},
e AS (
  SELECT 'LOCATED_IN' AS type, count(*) AS n FROM customer
  UNION ALL SELECT 'LOCATED_IN', count(*) FROM supplier
  UNION ALL SELECT 'PART_OF', count(*) FROM nation
  UNION ALL SELECT 'SUPPLIES', count(*) FROM (SELECT DISTINCT l_suppkey, l_partkey FROM lineitem)
  UNION ALL SELECT 'BOUGHT', count(*) FROM (SELECT DISTINCT o_custkey, l_partkey FROM lineitem JOIN orders ON o_orderkey = l_orderkey)
  UNION ALL SELECT 'TRADES_WITH', count(*) FROM routes),
n AS (SELECT 'Customer' AS label, count(*) AS n FROM customer UNION ALL SELECT 'Supplier', count(*) FROM supplier
      UNION ALL SELECT 'Part', count(*) FROM part UNION ALL SELECT 'Nation', count(*) FROM nation
      UNION ALL SELECT 'Region', count(*) FROM region)
SELECT 'nodes' AS kind, label AS name, CAST(n AS DOUBLE) AS value FROM n
UNION ALL SELECT 'edges', type, CAST(sum(n) AS DOUBLE) FROM e GROUP BY type
UNION ALL SELECT 'graph', 'avg_degree', round((SELECT sum(n) FROM e) / (SELECT sum(n) FROM n), 6)
""")
def gr_stats(spark, d):
    nodes, edges = build_graph(spark, d)
    s = g.stats(nodes, edges)
    return s.withColumn("value", F.when(F.col("kind") == "graph", F.round("value", 6)).otherwise(F.col("value")))


@query("gr_one_hop", ops=("GR-02",), sql="""
SELECT 'C:' || CAST(c_custkey AS VARCHAR) AS src, n.n_name AS dst_name
FROM customer c JOIN nation n ON n.n_nationkey = c.c_nationkey WHERE n.n_name = 'NATION_3'
""")
def gr_one_hop(spark, d):
    nodes, edges = build_graph(spark, d)
    h = g.one_hop(nodes, edges, "LOCATED_IN", (F.col("label") == "Nation") & (F.col("name") == "NATION_3"))
    return h.where(F.col("src").startswith("C:")).select("src", F.col("dst_name").alias("dst_name"))


@query("gr_multi_hop_aggregate", ops=("GR-03", "GR-04"), sql=f"""
WITH b AS (SELECT o_custkey, l_partkey, sum(l_extendedprice * (1 - l_discount)) AS rev
           FROM lineitem JOIN orders ON o_orderkey = l_orderkey GROUP BY ALL)
SELECT 'R:' || CAST(n.n_regionkey AS VARCHAR) AS region, count(DISTINCT c.c_custkey) AS n_customers,
       count(DISTINCT b.l_partkey) AS n_parts, {rnd("sum(b.rev)", 2)} AS revenue, {rnd("avg(b.rev)", 4)} AS avg_edge
FROM b JOIN customer c ON c.c_custkey = b.o_custkey JOIN nation n ON n.n_nationkey = c.c_nationkey
GROUP BY 1
""")
def gr_multi_hop_aggregate(spark, d):
    nodes, edges = build_graph(spark, d)
    ch = g.chain(edges, ["LOCATED_IN", "PART_OF"]).where(F.col("n0").startswith("C:"))
    bought = g.out_edges(edges, "BOUGHT").select(F.col("src").alias("n0"), F.col("dst").alias("part"), "weight")
    j = ch.join(bought, "n0")
    return j.groupBy(F.col("n2").alias("region")).agg(
        F.count_distinct("n0").alias("n_customers"), F.count_distinct("part").alias("n_parts"),
        rh(F.sum("weight"), 2).alias("revenue"), rh(F.avg("weight"), 4).alias("avg_edge"))


@query("gr_var_length_paths", ops=("GR-05", "SF-12", "SF-13"), sql=f"""
WITH RECURSIVE {ROUTES_SQL},
p(start_, end_, path, hops, total) AS (
  SELECT src, dst, [src, dst], 1, w FROM routes WHERE src = 'N:0'
  UNION ALL
  SELECT p.start_, r.dst, list_append(p.path, r.dst), p.hops + 1, p.total + r.w
  FROM p JOIN routes r ON r.src = p.end_ WHERE NOT list_contains(p.path, r.dst) AND p.end_ <> 'N:3' AND p.hops < 5)
SELECT start_ AS start, end_ AS "end", array_to_string(path, '>') AS path, CAST(hops AS INTEGER) AS hops, total FROM p
WHERE end_ = 'N:3'
""")
def gr_var_length_paths(spark, d):
    # every route of one to five hops from one place to another
    ids = lambda x: spark.createDataFrame([(x,)], "id string")
    p = g.paths_between(trade_routes(spark, d), ids("N:0"), ids("N:3"), max_hops=5, weight="weight")
    return p.select("start", "end", F.array_join("path", ">").alias("path"), "hops", "total")


@query("gr_shortest_hops", ops=("GR-06",), sql=f"""
WITH RECURSIVE {ROUTES_SQL},
p(end_, hops) AS (
  SELECT dst, 1 FROM routes WHERE src = 'N:0'
  UNION
  SELECT r.dst, p.hops + 1 FROM p JOIN routes r ON r.src = p.end_ WHERE p.hops < 24)
SELECT 'N:0' AS start, end_ AS node, CAST(min(hops) AS INTEGER) AS hops FROM p WHERE end_ <> 'N:0' GROUP BY end_
""")
def gr_shortest_hops(spark, d):
    routes = trade_routes(spark, d)
    src = routes.sparkSession.createDataFrame([("N:0",)], "id string")
    return g.bfs_levels(routes, src).select("start", "node", "hops")


@query("gr_weighted_shortest", ops=("GR-07",), sql=f"""
WITH RECURSIVE {ROUTES_SQL},
p(end_, total, hops) AS (
  SELECT dst, w, 1 FROM routes WHERE src = 'N:0'
  UNION
  SELECT end_, min(total), hops + 1
  FROM (SELECT r.dst AS end_, p.total + r.w AS total, p.hops FROM p JOIN routes r ON r.src = p.end_ WHERE p.hops < 24)
  GROUP BY end_, hops)
SELECT 'N:0' AS start, end_ AS node, min(total) AS dist FROM p WHERE end_ <> 'N:0' GROUP BY end_
""")
def gr_weighted_shortest(spark, d):
    routes = trade_routes(spark, d)
    src = routes.sparkSession.createDataFrame([("N:0",)], "id string")
    return g.weighted_shortest(routes, src, "weight").select("start", "node", "dist")


@query("gr_paths_avoiding", ops=("GR-08",), sql=f"""
WITH RECURSIVE {ROUTES_SQL},
r2 AS (SELECT * FROM routes WHERE src <> 'N:9' AND dst <> 'N:9'),
p(end_, path, hops, total) AS (
  SELECT dst, ['N:0', dst], 1, w FROM r2 WHERE src = 'N:0'
  UNION ALL
  SELECT r.dst, list_append(p.path, r.dst), p.hops + 1, p.total + r.w
  FROM p JOIN r2 r ON r.src = p.end_ WHERE NOT list_contains(p.path, r.dst) AND p.end_ <> 'N:3' AND p.hops < 6)
SELECT CAST(hops AS INTEGER) AS hops, path[-2] AS last_stop, count(*) AS n_routes, min(total) AS shortest,
       sum(total) AS all_distances, min(array_to_string(path, '>')) AS first_route, max(array_to_string(path, '>')) AS last_route
FROM p WHERE end_ = 'N:3' GROUP BY ALL
""")
def gr_paths_avoiding(spark, d):
    # routes of one to six hops that do without a node: millions, so summed up by length and last stop
    ids = lambda x: spark.createDataFrame([(x,)], "id string")
    p = g.paths_between(trade_routes(spark, d), ids("N:0"), ids("N:3"), max_hops=6, weight="weight", avoid=["N:9"])
    route = F.array_join("path", ">")
    return p.groupBy("hops", F.element_at("path", -2).alias("last_stop")).agg(
        F.count(F.lit(1)).alias("n_routes"), F.min("total").alias("shortest"), F.sum("total").alias("all_distances"),
        F.min(route).alias("first_route"), F.max(route).alias("last_route"))


@query("gr_impact_set", ops=("GR-09",), sql=f"""
WITH RECURSIVE {ROUTES_SQL},
p(end_, hops) AS (
  SELECT src, 1 FROM routes WHERE dst = 'N:9'
  UNION
  SELECT r.src, p.hops + 1 FROM p JOIN routes r ON r.dst = p.end_ WHERE r.src <> 'N:9' AND p.hops < 6)
SELECT end_ AS node, CAST(hops AS INTEGER) AS length FROM p
""")
def gr_impact_set(spark, d):
    return g.impact_set(trade_routes(spark, d), "N:9", max_hops=6)


@query("gr_unconnected_parts", ops=("GR-10", "JN-14"), sql="""
SELECT 'P:' || CAST(p_partkey AS VARCHAR) AS id FROM part
WHERE p_partkey NOT IN (SELECT l_partkey FROM lineitem)
""")
def gr_unconnected_parts(spark, d):
    nodes, edges = build_graph(spark, d)
    return g.unconnected(nodes.where(F.col("label") == "Part"), edges, "BOUGHT", "in").select("id")


@query("gr_degrees", ops=("GR-11",), sql="""
SELECT 'N:' || CAST(n_nationkey AS VARCHAR) AS id, 'Nation' AS label,
       (SELECT count(*) FROM customer WHERE c_nationkey = n_nationkey)
     + (SELECT count(*) FROM supplier WHERE s_nationkey = n_nationkey) AS LOCATED_IN_in,
       CAST(0 AS BIGINT) AS LOCATED_IN_out, CAST(0 AS BIGINT) AS PART_OF_in, CAST(1 AS BIGINT) AS PART_OF_out
FROM nation
UNION ALL
SELECT 'R:' || CAST(r_regionkey AS VARCHAR), 'Region', CAST(0 AS BIGINT), CAST(0 AS BIGINT),
       (SELECT count(*) FROM nation WHERE n_regionkey = r_regionkey), CAST(0 AS BIGINT) FROM region
""")
def gr_degrees(spark, d):
    nodes, edges = build_graph(spark, d)
    dg = g.degrees(nodes.where(F.col("label").isin("Nation", "Region")), edges, ["LOCATED_IN", "PART_OF"])
    return dg.select("id", "label", "LOCATED_IN_in", "LOCATED_IN_out", "PART_OF_in", "PART_OF_out")


@query("gr_recommendation", ops=("GR-12", "OL-04"), sql=f"""
WITH tgt AS (SELECT p_partkey, p_type FROM part WHERE p_partkey = (SELECT min(p_partkey) FROM part)),
b AS (SELECT o_custkey, l_partkey, sum(l_extendedprice * (1 - l_discount)) rev
      FROM lineitem JOIN orders ON o_orderkey = l_orderkey GROUP BY ALL),
cand AS (SELECT b.o_custkey, sum(b.rev) AS score FROM b JOIN part p ON p.p_partkey = b.l_partkey
         WHERE p.p_type = (SELECT p_type FROM tgt) AND b.l_partkey <> (SELECT p_partkey FROM tgt)
         GROUP BY 1)
SELECT 'C:' || CAST(o_custkey AS VARCHAR) AS customer, {rnd("score", 2)} AS score FROM cand
WHERE o_custkey NOT IN (SELECT o_custkey FROM b WHERE l_partkey = (SELECT p_partkey FROM tgt))
ORDER BY score DESC, o_custkey LIMIT 10
""")
def gr_recommendation(spark, d):
    nodes, edges = build_graph(spark, d)
    p = read(spark, d, "part")
    target = p.select(F.min("p_partkey")).scalar()
    tgt_id = F.concat(F.lit("P:"), target.cast("string"))
    tgt_type = p.where(F.col("p_partkey") == target).select("p_type").scalar()
    bought = g.out_edges(edges, "BOUGHT")
    parts = nodes.where(F.col("label") == "Part").select(F.col("id").alias("dst"), F.col("name").alias("ptype"))
    cand = (bought.join(parts, "dst").where((F.col("ptype") == tgt_type) & (F.col("dst") != tgt_id))
            .groupBy("src").agg(F.sum("weight").alias("score")))
    owners = bought.where(F.col("dst") == tgt_id).select("src")
    rec = cand.join(owners, "src", "left_anti")
    key = F.substring_index("src", ":", -1).cast("long")
    return (rec.orderBy(F.col("score").desc(), key).limit(10)
            .select(F.col("src").alias("customer"), rh("score", 2).alias("score")))


@query("gr_repeat_events", ops=("GR-13", "AG-08", "AG-09"), sql=f"""
SELECT o_custkey, count(*) AS n_orders, count(CASE WHEN o_orderpriority = '1-URGENT' THEN 1 END) AS n_urgent,
       {rnd("count(CASE WHEN o_orderpriority = '1-URGENT' THEN 1 END) * 100.0 / count(*)", 2)} AS urgent_pct
FROM orders GROUP BY o_custkey HAVING count(*) >= 15
""")
def gr_repeat_events(spark, d):
    o = read(spark, d, "orders")
    g_ = o.groupBy("o_custkey").agg(
        F.count(F.lit(1)).alias("n_orders"),
        F.count(F.when(F.col("o_orderpriority") == "1-URGENT", 1)).alias("n_urgent"))
    return (g_.where(F.col("n_orders") >= 15)
            .withColumn("urgent_pct", rh(F.col("n_urgent") * 100.0 / F.col("n_orders"), 2)))


@query("gr_association", ops=("GR-14", "AG-06"), sql="""
SELECT l_suppkey, count(DISTINCT o_custkey) AS n_customers, min(o_custkey) AS first_customer
FROM lineitem JOIN orders ON o_orderkey = l_orderkey WHERE l_returnflag = 'R' GROUP BY l_suppkey
""")
def gr_association(spark, d):
    p = production(spark, d).where(F.col("l_returnflag") == "R")
    # distinct count and smallest member instead of collecting the set: a
    # supplier may serve any share of all customers
    return p.groupBy("l_suppkey").agg(F.count_distinct("o_custkey").alias("n_customers"),
                                      F.min("o_custkey").alias("first_customer"))


@query("gr_event_intervals", ops=("GR-15", "WN-01"), sql=f"""
WITH x AS (SELECT o_custkey, date_diff('day', lag(o_orderdate) OVER (PARTITION BY o_custkey ORDER BY o_orderdate),
                                        o_orderdate) AS gap FROM orders)
SELECT o_custkey, {rnd("avg(gap)", 3)} AS avg_days, CAST(min(gap) AS INTEGER) AS min_days,
       CAST(max(gap) AS INTEGER) AS max_days, count(*) AS n_intervals
FROM x WHERE gap IS NOT NULL GROUP BY o_custkey
""")
def gr_event_intervals(spark, d):
    iv = g.intervals(read(spark, d, "orders"), "o_custkey", "o_orderdate", "o_orderkey", bucket_s=365 * 86400)
    return iv.select("o_custkey", rh("avg_days", 3).alias("avg_days"), "min_days", "max_days", "n_intervals")


@query("gr_closed_cycles", ops=("GR-16",), sql="""
SELECT 'N:' || CAST(c.c_nationkey AS VARCHAR) AS nation, count(*) AS n_cycles
FROM (SELECT DISTINCT o.o_custkey, l.l_partkey, l.l_suppkey FROM lineitem l JOIN orders o ON o.o_orderkey = l.l_orderkey) b
JOIN customer c ON c.c_custkey = b.o_custkey JOIN supplier s ON s.s_suppkey = b.l_suppkey
WHERE s.s_nationkey = c.c_nationkey GROUP BY 1
""")
def gr_closed_cycles(spark, d):
    # (c)-[:BOUGHT]->(p)<-[:SUPPLIES]-(s)-[:LOCATED_IN]->(n)<-[:LOCATED_IN]-(c), with the supplier
    # being the one of the purchase: a cycle closing on the customer's nation
    pr = production(spark, d).select("o_custkey", "l_partkey", "l_suppkey").distinct()
    c = read(spark, d, "customer").select("c_custkey", "c_nationkey")
    s = read(spark, d, "supplier").select("s_suppkey", "s_nationkey")
    j = (pr.join(c, pr.o_custkey == c.c_custkey).join(s, pr.l_suppkey == s.s_suppkey)
         .where(F.col("s_nationkey") == F.col("c_nationkey")))
    return j.groupBy(F.concat(F.lit("N:"), F.col("c_nationkey").cast("string")).alias("nation")).agg(
        F.count(F.lit(1)).alias("n_cycles"))


@query("gr_neighbourhood", ops=("GR-17", "JN-22"), sql="""
SELECT 'LOCATED_IN' AS type, 'in' AS direction, count(*) AS n FROM (
  SELECT c_custkey FROM customer WHERE c_nationkey = 3 UNION ALL SELECT s_suppkey FROM supplier WHERE s_nationkey = 3)
UNION ALL SELECT 'PART_OF', 'out', count(*) FROM nation WHERE n_nationkey = 3
""")
def gr_neighbourhood(spark, d):
    nodes, edges = build_graph(spark, d)
    nb = g.neighbourhood(edges.where(F.col("type").isin("LOCATED_IN", "PART_OF")), "N:3")
    return nb.groupBy("type", "direction").agg(F.count(F.lit(1)).alias("n"))


@query("gr_detach_delete", ops=("GR-19",), sql="""
SELECT 'nodes' AS kind, (SELECT count(*) FROM customer) + (SELECT count(*) FROM supplier) + (SELECT count(*) FROM part)
       + (SELECT count(*) FROM nation) - 1 + (SELECT count(*) FROM region) AS n
UNION ALL SELECT 'located_in', (SELECT count(*) FROM customer WHERE c_nationkey <> 24)
                              + (SELECT count(*) FROM supplier WHERE s_nationkey <> 24)
UNION ALL SELECT 'part_of', (SELECT count(*) FROM nation WHERE n_nationkey <> 24)
""")
def gr_detach_delete(spark, d):
    nodes, edges = build_graph(spark, d)
    ids = nodes.where(F.col("id") == "N:24").select("id")
    n2, e2 = g.detach_delete(nodes, edges, ids)
    from oreflow.operators.aggregates import count_report
    return count_report({"nodes": n2, "located_in": e2.where(F.col("type") == "LOCATED_IN"),
                         "part_of": e2.where(F.col("type") == "PART_OF")}).select(
        F.col("table_name").alias("kind"), F.col("n_rows").alias("n"))


@query("gr_sync_properties", ops=("GR-20",), sql="""
SELECT 'S:' || CAST(s_suppkey AS VARCHAR) AS id, s_name AS name, q.total_qty
FROM supplier LEFT JOIN (SELECT l_suppkey, sum(l_quantity) AS total_qty FROM lineitem GROUP BY 1) q
  ON q.l_suppkey = s_suppkey
""")
def gr_sync_properties(spark, d):
    nodes, _ = build_graph(spark, d)
    m = read(spark, d, "lineitem").groupBy(_id("S", "l_suppkey").alias("id")).agg(
        F.sum("l_quantity").alias("total_qty"))
    return g.sync_properties(nodes.where(F.col("label") == "Supplier"), m).select("id", "name", "total_qty")


@query("gr_context_expansion", ops=("GR-21",), sql="""
WITH e AS (SELECT 'C:' || CAST(c_custkey AS VARCHAR) s, 'N:' || CAST(c_nationkey AS VARCHAR) t FROM customer
           UNION ALL SELECT 'S:' || CAST(s_suppkey AS VARCHAR), 'N:' || CAST(s_nationkey AS VARCHAR) FROM supplier
           UNION ALL SELECT 'N:' || CAST(n_nationkey AS VARCHAR), 'R:' || CAST(n_regionkey AS VARCHAR) FROM nation),
u AS (SELECT s, t FROM e UNION ALL SELECT t, s FROM e),
h1 AS (SELECT s, t FROM u WHERE s = 'N:1'),
n1 AS (SELECT DISTINCT t AS node FROM h1 WHERE t <> 'N:1'),
h2 AS (SELECT u.s, u.t FROM u JOIN n1 ON u.s = n1.node)
SELECT 1 AS hop, count(*) AS n_facts FROM h1 UNION ALL SELECT 2, count(*) FROM h2
""")
def gr_context_expansion(spark, d):
    nodes, edges = build_graph(spark, d)
    e = edges.where(F.col("type").isin("LOCATED_IN", "PART_OF"))
    seeds = nodes.where(F.col("id") == "N:1").select("id")
    facts = g.expand_context(e, seeds, 2)
    return facts.groupBy("hop").agg(F.count(F.lit(1)).alias("n_facts"))

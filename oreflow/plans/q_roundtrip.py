"""Registered queries that write files or tables and read them back: file
sources, stored results, a real load with its log, a corrupted fixture."""

from __future__ import annotations

from pyspark.sql import functions as F

from oreflow.functions.numeric import round_half_up as rh
from oreflow.operators import etl
from oreflow.operators import profile as pr
from oreflow.operators import quality as dq
from oreflow.operators import text as tx
from oreflow.plans.q_quality import ORDER_RULES
from oreflow.plans.registry import query
from oreflow.plans.sqlfmt import rnd
from oreflow.session import scratch_path
from oreflow.sinks import writers as w
from oreflow.sources import files
from oreflow.sources.tables import read


@query("src_csv_back", ops=("SRC-01",), sql=f"""
SELECT n_regionkey AS region, count(*) AS n, {rnd("sum(c_acctbal)", 2)} AS balance, max(c_name) AS last_name,
       count(*) FILTER (WHERE c_custkey % 40 = 7) AS n_corrupt, count(*) FILTER (WHERE c_custkey % 40 <> 7) AS units,
       CAST(sum(c_custkey) AS BIGINT) AS sum_keys
FROM customer JOIN nation ON n_nationkey = c_nationkey GROUP BY 1
""")
def src_csv_back(spark, d):
    """Customers as CSV files with a header; one in forty has text where a number
    is declared and is kept as it stands in the file."""
    path = scratch_path(spark, "src-csv")
    c = read(spark, d, "customer").join(F.broadcast(read(spark, d, "nation").select("n_nationkey", "n_regionkey")),  # 25 rows
                                        F.col("c_nationkey") == F.col("n_nationkey"))
    bad = F.col("c_custkey") % 40 == 7
    c.select("c_custkey", "c_name", F.col("n_regionkey").alias("region"), F.col("c_acctbal").alias("balance"),
             F.when(bad, "none").otherwise("1").alias("units")).write.option("header", True).csv(path)
    r = files.read_csv(spark, path, "c_custkey long, c_name string, region int, balance double, units int")
    return r.groupBy("region").agg(F.count(F.lit(1)).alias("n"), rh(F.sum("balance"), 2).alias("balance"),
                                   F.max("c_name").alias("last_name"), F.count(files.CORRUPT).alias("n_corrupt"),
                                   F.sum("units").alias("units"), F.sum("c_custkey").alias("sum_keys"))


@query("src_json_arrays_back", ops=("SRC-02",), sql="""
SELECT c_mktsegment AS segment, count(*) AS n, max(c_name) AS last_name, CAST(sum(c_custkey) AS BIGINT) AS sum_keys
FROM customer GROUP BY 1
""")
def src_json_arrays_back(spark, d):
    """Files that hold one JSON array of documents each."""
    path = scratch_path(spark, "src-json")
    doc = F.struct(F.col("c_custkey").alias("id"), F.col("c_name").alias("name"), F.col("c_mktsegment").alias("segment"))
    # arrays of bounded size: a thousand keys to a file's one line
    a = read(spark, d, "customer").groupBy(F.floor(F.col("c_custkey") / 1000).alias("part")).agg(F.to_json(F.collect_list(doc)).alias("value"))
    a.repartition("part").write.partitionBy("part").text(path)
    r = files.read_json_documents(spark, path, "id long, name string, segment string")
    return r.groupBy("segment").agg(F.count(F.lit(1)).alias("n"), F.max("name").alias("last_name"), F.sum("id").alias("sum_keys"))


@query("src_xml_records_back", ops=("SRC-04",), sql=f"""
SELECT s_nationkey AS nation, count(*) AS n, {rnd("sum(s_acctbal)", 2)} AS balance, max(s_name) AS last_name FROM supplier GROUP BY 1
""")
def src_xml_records_back(spark, d):
    """XML files with many records each; an attribute, text and a nested element."""
    path = scratch_path(spark, "src-xml")
    s = read(spark, d, "supplier").select(F.col("s_suppkey").alias("_id"), F.col("s_name").alias("name"),
                                          F.struct(F.col("s_nationkey").alias("_nation"), F.col("s_acctbal").alias("_VALUE")).alias("balance"))
    s.repartition(2).write.format("xml").option("rootTag", "suppliers").option("rowTag", "supplier").save(path)
    r = files.read_xml(spark, path, "supplier", "_id long, name string, balance struct<_VALUE: double, _nation: int>")
    return r.groupBy(F.col("balance._nation").alias("nation")).agg(
        F.count(F.lit(1)).alias("n"), rh(F.sum("balance._VALUE"), 2).alias("balance"), F.max("name").alias("last_name"))


@query("snk_stored_results", ops=("SNK-10", "DQ-12"), sql="""
SELECT 'status_in_set' AS rule, count(o_orderstatus) AS evaluated, count(*) FILTER (WHERE o_orderstatus NOT IN ('F', 'O', 'P')) AS unexpected FROM orders
UNION ALL SELECT 'key_not_null', count(*), count(*) FILTER (WHERE o_orderkey IS NULL) FROM orders
""")
def snk_stored_results(spark, d):
    """A suite's results as a stored table, read back."""
    path = scratch_path(spark, "snk-results")
    rules = [r for r in ORDER_RULES if r.name in ("status_in_set", "key_not_null")]
    w.write_results(dq.evaluate(read(spark, d, "orders"), rules), path)
    return w.table(spark, path).select("rule", "evaluated", "unexpected")


@query("dq_corrupted_rows", ops=("DQ-13", "DQ-12"), sql="""
WITH k AS (SELECT o_orderkey, row_number() OVER (ORDER BY o_orderkey) AS i FROM orders),
c AS (SELECT CASE WHEN i = 1 THEN NULL ELSE o.o_orderkey END AS o_orderkey, CASE WHEN i = 2 THEN 'X' ELSE o_orderstatus END AS o_orderstatus,
             CASE WHEN i = 3 THEN -5.0 ELSE o_totalprice END AS o_totalprice, CASE WHEN i = 4 THEN 'urgent' ELSE o_orderpriority END AS o_orderpriority,
             CASE WHEN i = 5 THEN -1 ELSE o_custkey END AS o_custkey, o_orderdate FROM orders o JOIN k ON k.o_orderkey = o.o_orderkey)
SELECT 'key_not_null' AS rule, count(*) FILTER (WHERE o_orderkey IS NULL) AS unexpected FROM c
UNION ALL SELECT 'status_in_set', count(*) FILTER (WHERE o_orderstatus NOT IN ('F', 'O', 'P')) FROM c
UNION ALL SELECT 'price_range', count(*) FILTER (WHERE o_totalprice < 1000 OR o_totalprice > 400000) FROM c
UNION ALL SELECT 'priority_format', count(*) FILTER (WHERE NOT regexp_matches(o_orderpriority, '^[1-5]-[A-Z ]+$')) FROM c
UNION ALL SELECT 'customer_fk', count(*) FILTER (WHERE o_custkey NOT IN (SELECT c_custkey FROM customer)) FROM c
""")
def dq_corrupted_rows(spark, d):
    """Five rows corrupted, each in its own way, and the suite run again."""
    o = read(spark, d, "orders")
    keys = [r["o_orderkey"] for r in o.select("o_orderkey").orderBy("o_orderkey").limit(5).collect()]
    hit = lambda i, col, value: F.when(F.col("k") == keys[i], F.lit(value)).otherwise(F.col(col)).alias(col)
    c = o.withColumn("k", F.col("o_orderkey")).select(
        hit(0, "o_orderkey", None), hit(1, "o_orderstatus", "X"), hit(2, "o_totalprice", -5.0), hit(3, "o_orderpriority", "urgent"),
        hit(4, "o_custkey", -1), "o_orderdate")
    names = ("key_not_null", "status_in_set", "price_range", "priority_format", "customer_fk")
    rules = [r for r in ORDER_RULES if r.name in names]
    return dq.evaluate(c, rules, {"customer": read(spark, d, "customer")}).select("rule", "unexpected")


LOADS = [
    {"name": "facts", "load_priority": 1, "dependencies": ["customers", "parts"]},
    {"name": "customers", "load_priority": 2, "dependencies": ["nations"]},
    {"name": "parts", "load_priority": 3, "dependencies": []},
    {"name": "nations", "load_priority": 4, "dependencies": []},
    {"name": "broken", "load_priority": 9, "dependencies": []},
]


@query("etl_logged_load", ops=("ETL-02", "ETL-07", "ETL-10", "UD-01"), sql="""
SELECT 'nations' AS table_name, 'completed' AS status, count(*) AS rows_extracted, count(*) AS rows_loaded, 0 AS rows_rejected, 1 AS place FROM nation
UNION ALL SELECT 'customers', 'completed', count(*), count(*) FILTER (WHERE c_acctbal >= 0), count(*) FILTER (WHERE c_acctbal < 0), 2 FROM customer
UNION ALL SELECT 'parts', 'completed', count(*), count(*), 0, 3 FROM part
UNION ALL SELECT 'facts', 'completed', count(*), count(*) FILTER (WHERE l_quantity <= 49), count(*) FILTER (WHERE l_quantity > 49), 4 FROM lineitem
UNION ALL SELECT 'broken', 'failed', NULL, NULL, NULL, 5
""")
def etl_logged_load(spark, d):
    """A load of five tables in the order of their dependencies; each writes its
    start and its end (or failure) to the log around the real write, and a failed
    one does not stop the others.  A second run of the same batch loads nothing
    again."""
    tables = {"nations": ("nation", None), "customers": ("customer", F.col("c_acctbal") >= 0), "parts": ("part", None),
              "facts": ("lineitem", F.col("l_quantity") <= 49), "broken": ("no_such_table", None)}
    base, log = scratch_path(spark, "load"), scratch_path(spark, "load-log")
    order = etl.load_plan(LOADS)

    def load(name, load_id):
        table, valid = tables[name]
        return etl.logged_load(spark, log, load_id, name, lambda: read(spark, d, table), f"{base}/{name}", valid, batch=f"{name}-1")
    for i, name in enumerate(order):
        load(name, i + 1)
    again = {name: load(name, 100 + i) for i, name in enumerate(order)}
    assert not any(again.values())
    state = etl.load_state(w.table(spark, log)).where(F.col("load_id") < 100)
    return state.select("table_name", "status", "rows_extracted", "rows_loaded", "rows_rejected", F.col("load_id").cast("int").alias("place"))


@query("tx_session_analytics", ops=("TX-09",), sql=f"""
WITH m AS (SELECT conv_id, role, len(list_filter(string_split_regex(text, '\\s+'), lambda x: x <> '')) AS tok FROM conversations),
s AS (SELECT conv_id, count(*) AS turns, sum(tok) AS tokens, sum(tok) FILTER (WHERE role = 'assistant') AS answered,
             sum(tok / 1000.0 * CASE role WHEN 'assistant' THEN 1.5 ELSE 0.5 END) AS cost FROM m GROUP BY conv_id)
SELECT turns, count(*) AS n_sessions, CAST(sum(tokens) AS BIGINT) AS tokens, {rnd("avg(tokens)", 3)} AS mean_tokens,
       {rnd("sum(answered) / sum(tokens)", 4)} AS answer_share, {rnd("sum(cost)", 4)} AS cost,
       CAST(quantile_disc(tokens, 0.5) AS BIGINT) AS p50_tokens, CAST(quantile_disc(tokens, 0.9) AS BIGINT) AS p90_tokens
FROM s GROUP BY turns
""")
def tx_session_analytics(spark, d):
    """Interactions by session (conversation), sessions by their number of turns."""
    m = read(spark, d, "conversations").select("conv_id", "role", tx.token_count("text").alias("tok"))
    rate = F.when(F.col("role") == "assistant", 1.5).otherwise(0.5)
    s = m.groupBy("conv_id").agg(F.count(F.lit(1)).alias("turns"), F.sum("tok").alias("tokens"),
                                 F.sum(F.when(F.col("role") == "assistant", F.col("tok"))).alias("answered"),
                                 F.sum(F.col("tok") / 1000.0 * rate).alias("cost"))
    q = pr.exact_quantiles(s, "tokens", [0.5, 0.9], ["turns"]).groupBy("turns").agg(
        F.min_by("value", "q").alias("p50_tokens"), F.max_by("value", "q").alias("p90_tokens"))
    g = s.groupBy("turns").agg(F.count(F.lit(1)).alias("n_sessions"), F.sum("tokens").alias("tokens"), rh(F.avg("tokens"), 3).alias("mean_tokens"),
                               rh(F.sum("answered") / F.sum("tokens"), 4).alias("answer_share"), rh(F.sum("cost"), 4).alias("cost"))
    return g.join(q, "turns")

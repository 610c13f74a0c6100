"""Registered relational queries: predicates, joins and aggregations over the
production binding (lineitem + orders, dimensions customer/nation/region,
supplier, part)."""

from __future__ import annotations

from pyspark.sql import functions as F

from oreflow.functions.numeric import round_half_up as rh
from oreflow.functions.timefn import trunc
from oreflow.operators import aggregates as agg
from oreflow.operators import joins
from oreflow.plans.registry import query
from oreflow.plans.sqlfmt import rnd
from oreflow.sources.tables import production, read


@query("rp_output_by_region_month", ops=("RP-05", "AG-01", "JN-01", "JN-02", "SF-07"), bench=True,
       sql=f"""
SELECT r.r_name AS mine, date_trunc('month', o.o_orderdate) AS month,
       count(*) AS trips, {rnd("sum(l.l_quantity)", 1)} AS tonnage,
       {rnd("avg(l.l_quantity)", 3)} AS avg_load, min(l.l_quantity) AS min_load, max(l.l_quantity) AS max_load,
       {rnd("sum(l.l_extendedprice * (1 - l.l_discount))", 2)} AS revenue
FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey
JOIN customer c ON c.c_custkey = o.o_custkey
JOIN nation n ON n.n_nationkey = c.c_nationkey
JOIN region r ON r.r_regionkey = n.n_regionkey
GROUP BY ALL
""")
def rp_output_by_region_month(spark, d):
    p = production(spark, d).select("o_custkey", "o_orderdate", "l_quantity",
                                    "l_extendedprice", "l_discount")
    c = read(spark, d, "customer").select("c_custkey", "c_nationkey")
    n = read(spark, d, "nation")   # 25 rows: broadcast bounded by definition
    r = read(spark, d, "region")   # 5 rows
    j = (p.join(c, p.o_custkey == c.c_custkey)
         .join(F.broadcast(n), F.col("c_nationkey") == n.n_nationkey)
         .join(F.broadcast(r), n.n_regionkey == r.r_regionkey))
    return j.groupBy(F.col("r_name").alias("mine"), trunc("month", "o_orderdate").alias("month")).agg(
        F.count(F.lit(1)).alias("trips"), rh(F.sum("l_quantity"), 1).alias("tonnage"),
        rh(F.avg("l_quantity"), 3).alias("avg_load"), F.min("l_quantity").alias("min_load"),
        F.max("l_quantity").alias("max_load"),
        rh(F.sum(F.col("l_extendedprice") * (1 - F.col("l_discount"))), 2).alias("revenue"))


@query("pf_lineitem_predicates", ops=("PF-01", "PF-03", "PF-04", "PF-05", "PF-09", "PF-11", "PF-14"),
       sql="""
SELECT l_orderkey, l_linenumber, l_quantity AS tonnage,
       coalesce(nullif(l_returnflag, 'N'), 'none') AS return_class,
       l_quantity * (1 - l_discount) AS net_tonnage
FROM lineitem
WHERE l_quantity >= 10 AND l_quantity < 45 AND l_returnflag IN ('R', 'N')
  AND l_shipdate BETWEEN TIMESTAMP '1996-01-01' AND TIMESTAMP '1996-12-31'
  AND (l_discount > 0.05 OR NOT (l_linestatus = 'O'))
""")
def pf_lineitem_predicates(spark, d):
    li = read(spark, d, "lineitem")
    pred = ((F.col("l_quantity") >= 10) & (F.col("l_quantity") < 45)
            & F.col("l_returnflag").isin("R", "N")
            & F.col("l_shipdate").between(F.lit("1996-01-01").cast("timestamp_ntz"),
                                          F.lit("1996-12-31").cast("timestamp_ntz"))
            & ((F.col("l_discount") > 0.05) | ~(F.col("l_linestatus") == "O")))
    return li.where(pred).select(
        "l_orderkey", "l_linenumber", F.col("l_quantity").alias("tonnage"),
        F.coalesce(F.nullif(F.col("l_returnflag"), F.lit("N")), F.lit("none")).alias("return_class"),
        (F.col("l_quantity") * (1 - F.col("l_discount"))).alias("net_tonnage"))


@query("pf_part_patterns", ops=("PF-06", "PF-07", "PF-16", "PF-17"), sql="""
SELECT p_partkey, p_brand, p_type, p_size, p_retailprice,
       (p_type LIKE '%BRASS%' OR p_type LIKE '%COPPER%') AS is_multi_metal,
       regexp_matches(p_brand, '^Brand#1[0-9]$') AS brand_ok
FROM part
WHERE p_brand IS NOT NULL AND p_name IS NOT NULL
  AND ((p_size > 40 AND p_retailprice < 1500) OR p_type LIKE 'PROMO%')
""")
def pf_part_patterns(spark, d):
    p = read(spark, d, "part")
    # replacement candidates: large and cheap (PF-17), or promotional type
    cand = ((F.col("p_size") > 40) & (F.col("p_retailprice") < 1500)) | F.col("p_type").like("PROMO%")
    return (p.where(F.col("p_brand").isNotNull() & F.col("p_name").isNotNull() & cand)
            .select("p_partkey", "p_brand", "p_type", "p_size", "p_retailprice",
                    (F.col("p_type").like("%BRASS%") | F.col("p_type").like("%COPPER%")).alias("is_multi_metal"),
                    F.col("p_brand").rlike("^Brand#1[0-9]$").alias("brand_ok")))


@query("pf_distinct_segments", ops=("PF-12", "PF-01"), sql="""
SELECT DISTINCT c_mktsegment AS segment, c_nationkey AS nation_key FROM customer
""")
def pf_distinct_segments(spark, d):
    return read(spark, d, "customer").select(
        F.col("c_mktsegment").alias("segment"), F.col("c_nationkey").alias("nation_key")).distinct()


@query("jn_left_on_filters", ops=("JN-04", "RP-08", "JN-03"), sql=f"""
SELECT o.o_orderpriority, count(DISTINCT o.o_orderkey) AS n_orders,
       count(l.l_orderkey) AS n_returned_lines, {rnd("coalesce(sum(l.l_quantity), 0)", 1)} AS returned_qty
FROM orders o LEFT JOIN lineitem l
  ON l.l_orderkey = o.o_orderkey AND l.l_returnflag = 'R'
 AND CAST(l.l_shipdate AS DATE) <= CAST(o.o_orderdate AS DATE) + INTERVAL 60 DAY
GROUP BY o.o_orderpriority
""")
def jn_left_on_filters(spark, d):
    o = read(spark, d, "orders")
    li = read(spark, d, "lineitem")
    # predicates on the optional side stay in ON, so unmatched orders survive
    cond = ((li.l_orderkey == o.o_orderkey) & (li.l_returnflag == "R")
            & (F.to_date(li.l_shipdate) <= F.date_add(F.to_date(o.o_orderdate), 60)))
    j = o.join(li, cond, "left")
    return j.groupBy("o_orderpriority").agg(
        F.count_distinct("o_orderkey").alias("n_orders"),
        F.count("l_orderkey").alias("n_returned_lines"),
        rh(F.coalesce(F.sum("l_quantity"), F.lit(0.0)), 1).alias("returned_qty"))


@query("jn_semi_customers_with_orders", ops=("JN-13",), sql="""
SELECT c_mktsegment AS segment, count(*) AS n_customers FROM customer c
WHERE EXISTS (SELECT 1 FROM orders o WHERE o.o_custkey = c.c_custkey AND o.o_orderstatus = 'F')
GROUP BY c_mktsegment
""")
def jn_semi_customers_with_orders(spark, d):
    c = read(spark, d, "customer")
    o = read(spark, d, "orders").where(F.col("o_orderstatus") == "F")
    return (c.join(o, c.c_custkey == o.o_custkey, "left_semi")
            .groupBy(F.col("c_mktsegment").alias("segment")).agg(F.count(F.lit(1)).alias("n_customers")))


@query("jn_anti_orphans", ops=("JN-14", "G10", "DQ-07"), sql="""
SELECT 'customer_without_orders' AS check_name, count(*) AS n FROM customer c
WHERE NOT EXISTS (SELECT 1 FROM orders o WHERE o.o_custkey = c.c_custkey)
UNION ALL
SELECT 'part_never_shipped', count(*) FROM part p
WHERE NOT EXISTS (SELECT 1 FROM lineitem l WHERE l.l_partkey = p.p_partkey)
UNION ALL
SELECT 'line_without_order', count(*) FROM lineitem l
WHERE NOT EXISTS (SELECT 1 FROM orders o WHERE o.o_orderkey = l.l_orderkey)
""")
def jn_anti_orphans(spark, d):
    c, o = read(spark, d, "customer"), read(spark, d, "orders")
    p, li = read(spark, d, "part"), read(spark, d, "lineitem")
    return agg.count_report({
        "customer_without_orders": c.join(o, c.c_custkey == o.o_custkey, "left_anti"),
        "part_never_shipped": p.join(li, p.p_partkey == li.l_partkey, "left_anti"),
        "line_without_order": li.join(o, li.l_orderkey == o.o_orderkey, "left_anti"),
    }).withColumnRenamed("table_name", "check_name").withColumnRenamed("n_rows", "n")


@query("jn_nation_scorecard", ops=("JN-15", "RP-10", "JN-06", "WH-10"), sql=f"""
SELECT n.n_name AS nation,
       (SELECT count(*) FROM customer c WHERE c.c_nationkey = n.n_nationkey) AS n_customers,
       (SELECT count(*) FROM supplier s WHERE s.s_nationkey = n.n_nationkey) AS n_suppliers,
       (SELECT {rnd("sum(o.o_totalprice)", 2)} FROM orders o JOIN customer c ON c.c_custkey = o.o_custkey
         WHERE c.c_nationkey = n.n_nationkey) AS order_value,
       (SELECT {rnd("avg(s.s_acctbal)", 2)} FROM supplier s WHERE s.s_nationkey = n.n_nationkey) AS avg_supplier_balance
FROM nation n
""")
def jn_nation_scorecard(spark, d):
    # correlated per-row sub-selects become pre-aggregates + left joins
    n = read(spark, d, "nation")
    c = read(spark, d, "customer")
    s = read(spark, d, "supplier")
    o = read(spark, d, "orders")
    cc = c.groupBy(F.col("c_nationkey").alias("k")).agg(F.count(F.lit(1)).alias("n_customers"))
    sc = s.groupBy(F.col("s_nationkey").alias("k")).agg(
        F.count(F.lit(1)).alias("n_suppliers"), rh(F.avg("s_acctbal"), 2).alias("avg_supplier_balance"))
    ov = (o.join(c, o.o_custkey == c.c_custkey).groupBy(F.col("c_nationkey").alias("k"))
          .agg(rh(F.sum("o_totalprice"), 2).alias("order_value")))
    j = (n.join(cc, n.n_nationkey == cc.k, "left").drop("k")
         .join(sc, n.n_nationkey == sc.k, "left").drop("k")
         .join(ov, n.n_nationkey == ov.k, "left").drop("k"))
    return j.select(F.col("n_name").alias("nation"),
                    F.coalesce("n_customers", F.lit(0)).cast("long").alias("n_customers"),
                    F.coalesce("n_suppliers", F.lit(0)).cast("long").alias("n_suppliers"),
                    "order_value", "avg_supplier_balance")


@query("jn_above_average_orders", ops=("JN-16",), sql="""
SELECT o_orderpriority, count(*) AS n_above_avg FROM orders
WHERE o_totalprice > (SELECT avg(o_totalprice) FROM orders)
GROUP BY o_orderpriority
""")
def jn_above_average_orders(spark, d):
    o = read(spark, d, "orders")
    avg_price = o.select(F.avg("o_totalprice")).scalar()
    return (o.where(F.col("o_totalprice") > avg_price).groupBy("o_orderpriority")
            .agg(F.count(F.lit(1)).alias("n_above_avg")))


@query("jn_lookup_customer_orders", ops=("JN-17", "JN-15", "AG-18", "RP-14"), sql=f"""
WITH g AS (SELECT o_custkey, count(*) AS n, count(*) FILTER (WHERE o_orderpriority = '1-URGENT') AS n_urgent,
                  arg_min(o_orderkey, {{'d': o_orderdate, 'k': o_orderkey}}) AS first_key,
                  sum(o_totalprice) AS total, bool_and(o_totalprice > 50000) AS all_big
           FROM orders GROUP BY o_custkey)
SELECT c.c_custkey, coalesce(g.n, 0) AS n_orders, coalesce(g.n_urgent, 0) AS n_urgent,
       g.first_key AS first_order_key, {rnd("coalesce(g.total, 0)", 2)} AS total_value,
       coalesce(g.all_big, true) AS all_big
FROM customer c LEFT JOIN g ON g.o_custkey = c.c_custkey
""")
def jn_lookup_customer_orders(spark, d):
    # a customer may own any share of all orders: the per-parent summary is
    # built with partial aggregates (no per-customer array), then left-joined
    c = read(spark, d, "customer").select("c_custkey")
    o = read(spark, d, "orders")
    g = o.groupBy("o_custkey").agg(
        F.count(F.lit(1)).alias("n"), F.count_if(F.col("o_orderpriority") == "1-URGENT").alias("u"),
        F.min_by("o_orderkey", F.struct("o_orderdate", "o_orderkey")).alias("first_order_key"),
        F.sum("o_totalprice").alias("t"), F.bool_and(F.col("o_totalprice") > 50000).alias("b"))
    j = c.join(g, c.c_custkey == g.o_custkey, "left")
    return j.select("c_custkey", F.coalesce("n", F.lit(0)).alias("n_orders"),
                    F.coalesce("u", F.lit(0)).alias("n_urgent"), "first_order_key",
                    rh(F.coalesce("t", F.lit(0.0)), 2).alias("total_value"),
                    F.coalesce("b", F.lit(True)).alias("all_big"))


@query("jn_lookup_order_lines", ops=("JN-17", "SF-12"), sql=f"""
WITH g AS (SELECT l_orderkey, count(*) AS n, count(*) FILTER (WHERE l_returnflag = 'R') AS n_ret,
                  min({{'l': l_linenumber, 'q': l_quantity}}).q AS first_qty, sum(l_quantity) AS qty
           FROM lineitem GROUP BY l_orderkey)
SELECT o.o_orderkey, coalesce(g.n, 0) AS n_lines, coalesce(g.n_ret, 0) AS n_returned,
       g.first_qty AS first_line_qty, {rnd("coalesce(g.qty, 0)", 2)} AS total_qty
FROM orders o LEFT JOIN g ON g.l_orderkey = o.o_orderkey
""")
def jn_lookup_order_lines(spark, d):
    # $lookup with the array result: the children of one order (its lines)
    # are bounded, so the array per parent is safe to build
    o = read(spark, d, "orders").select("o_orderkey")
    li = read(spark, d, "lineitem")
    j = joins.lookup_array(o, li, "o_orderkey", "l_orderkey", "lines",
                           ["l_linenumber", "l_quantity", "l_returnflag"], order_by="l_linenumber")
    arr = F.col("lines")
    return j.select(
        "o_orderkey", F.size(arr).cast("long").alias("n_lines"),
        F.size(F.filter(arr, lambda x: x["l_returnflag"] == "R")).cast("long").alias("n_returned"),
        F.try_element_at(arr, F.lit(1))["l_quantity"].alias("first_line_qty"),
        rh(F.aggregate(arr, F.lit(0.0), lambda acc, x: acc + x["l_quantity"]), 2).alias("total_qty"))


@query("jn_unnest_name_words", ops=("JN-18", "JN-19", "SF-12", "UD-05"), sql="""
WITH w AS (SELECT list_filter(string_split(p_name, ' '), lambda x: length(x) >= 5) AS l FROM part)
SELECT word, count(*) AS n FROM (
  SELECT unnest(CASE WHEN len(l) = 0 THEN [NULL::VARCHAR] ELSE l END) AS word FROM w)
GROUP BY word
""")
def jn_unnest_name_words(spark, d):
    p = read(spark, d, "part")
    longw = F.filter(F.split("p_name", " "), lambda x: F.length(x) >= 5)
    # outer unnest: parts without a long word still count once, as NULL
    return (p.select(F.explode_outer(longw).alias("word"))
            .groupBy("word").agg(F.count(F.lit(1)).alias("n")))


@query("ag_count_distinct", ops=("AG-03", "AG-02"), sql="""
SELECT o_orderpriority, count(DISTINCT o_custkey) AS n_customers, count(*) AS n_orders FROM orders
GROUP BY o_orderpriority
UNION ALL SELECT 'ALL', count(DISTINCT o_custkey), count(*) FROM orders
""")
def ag_count_distinct(spark, d):
    o = read(spark, d, "orders")
    g = o.groupBy("o_orderpriority").agg(F.count_distinct("o_custkey").alias("n_customers"),
                                         F.count(F.lit(1)).alias("n_orders"))
    tot = o.agg(F.count_distinct("o_custkey").alias("n_customers"),
                F.count(F.lit(1)).alias("n_orders")).select(
        F.lit("ALL").alias("o_orderpriority"), "n_customers", "n_orders")
    return g.unionByName(tot)


@query("ag_string_agg_nations", ops=("AG-05", "RP-01"), sql="""
SELECT r.r_name AS region, count(*) AS n_nations,
       string_agg(DISTINCT n.n_name, ', ' ORDER BY n.n_name) AS nation_names
FROM nation n JOIN region r ON r.r_regionkey = n.n_regionkey GROUP BY r.r_name
""")
def ag_string_agg_nations(spark, d):
    n, r = read(spark, d, "nation"), read(spark, d, "region")
    return (n.join(r, r.r_regionkey == n.n_regionkey).groupBy(F.col("r_name").alias("region"))
            .agg(F.count(F.lit(1)).alias("n_nations"),
                 F.expr("listagg(DISTINCT n_name, ', ') WITHIN GROUP (ORDER BY n_name)").alias("nation_names")))


@query("ag_collect_sorted_set", ops=("AG-06",), sql="""
SELECT n_regionkey, list(DISTINCT n_nationkey ORDER BY n_nationkey) AS nation_keys FROM nation GROUP BY n_regionkey
""")
def ag_collect_sorted_set(spark, d):
    return read(spark, d, "nation").groupBy("n_regionkey").agg(
        F.array_sort(F.collect_set("n_nationkey")).alias("nation_keys"))


@query("ag_filtered_having", ops=("AG-07", "AG-08", "AG-09"), sql=f"""
SELECT l_suppkey, count(*) AS n_lines,
       count(*) FILTER (WHERE l_returnflag = 'R') AS n_returned,
       sum(CASE WHEN l_linestatus = 'F' THEN 1 ELSE 0 END) AS n_finished,
       min(l_shipdate) FILTER (WHERE l_returnflag = 'R') AS first_return,
       {rnd("stddev_samp(l_quantity)", 3)} AS std_qty
FROM lineitem GROUP BY l_suppkey
HAVING count(*) FILTER (WHERE l_returnflag = 'R') > 0.25 * count(*) AND stddev_samp(l_quantity) > 0
""")
def ag_filtered_having(spark, d):
    li = read(spark, d, "lineitem")
    g = li.groupBy("l_suppkey").agg(
        F.count(F.lit(1)).alias("n_lines"),
        F.count_if(F.col("l_returnflag") == "R").alias("n_returned"),
        F.sum(F.when(F.col("l_linestatus") == "F", 1).otherwise(0)).alias("n_finished"),
        F.min(F.when(F.col("l_returnflag") == "R", F.col("l_shipdate"))).alias("first_return"),
        F.stddev("l_quantity").alias("std_qty"))
    return (g.where((F.col("n_returned") > 0.25 * F.col("n_lines")) & (F.col("std_qty") > 0))
            .withColumn("n_finished", F.col("n_finished").cast("bigint"))
            .withColumn("std_qty", rh("std_qty", 3)))


@query("ag_group_by_expression", ops=("AG-10",), sql=f"""
SELECT year(o_orderdate) AS year, substr(o_orderpriority, 1, 1) AS prio, o_orderstatus AS status,
       count(*) AS n, {rnd("sum(o_totalprice)", 2)} AS value
FROM orders GROUP BY ALL
""")
def ag_group_by_expression(spark, d):
    o = read(spark, d, "orders")
    return o.groupBy(F.year("o_orderdate").cast("bigint").alias("year"),
                     F.substring("o_orderpriority", 1, 1).alias("prio"),
                     F.col("o_orderstatus").alias("status")).agg(
        F.count(F.lit(1)).alias("n"), rh(F.sum("o_totalprice"), 2).alias("value"))


@query("ag_two_level", ops=("AG-11",), sql=f"""
WITH per AS (SELECT o.o_orderpriority, o.o_orderkey, count(l.l_orderkey) AS n_lines
             FROM orders o JOIN lineitem l ON l.l_orderkey = o.o_orderkey GROUP BY ALL)
SELECT o_orderpriority, {rnd("avg(n_lines)", 4)} AS avg_lines, max(n_lines) AS max_lines, count(*) AS n_orders
FROM per GROUP BY o_orderpriority
""")
def ag_two_level(spark, d):
    o = read(spark, d, "orders").select("o_orderkey", "o_orderpriority")
    li = read(spark, d, "lineitem").select("l_orderkey")
    # first level on lineitem alone (orders are never fanned out), then join
    per = li.groupBy("l_orderkey").agg(F.count(F.lit(1)).alias("n_lines"))
    j = o.join(per, o.o_orderkey == per.l_orderkey)
    return j.groupBy("o_orderpriority").agg(
        rh(F.avg("n_lines"), 4).alias("avg_lines"), F.max("n_lines").alias("max_lines"),
        F.count(F.lit(1)).alias("n_orders"))


@query("ag_share_of_total", ops=("AG-12", "WN-10"), sql=f"""
SELECT c_mktsegment, count(*) AS amount, {rnd("100.0 * count(*) / sum(count(*)) OVER ()", 3)} AS share_pct
FROM customer GROUP BY c_mktsegment
""")
def ag_share_of_total(spark, d):
    s = agg.share_of_total(read(spark, d, "customer"), ["c_mktsegment"])
    return s.withColumn("share_pct", rh("share_pct", 3))


@query("ag_weighted_recombine", ops=("AG-13", "TS-23", "G12"), sql=f"""
SELECT l_suppkey, count(*) AS n, {rnd("avg(l_quantity)", 6)} AS avg_value,
       min(l_quantity) AS min_value, max(l_quantity) AS max_value
FROM lineitem GROUP BY l_suppkey
""")
def ag_weighted_recombine(spark, d):
    li = read(spark, d, "lineitem")
    # monthly partials (as a materialised rollup would hold them) ...
    part = li.groupBy("l_suppkey", trunc("month", "l_shipdate").alias("m")).agg(
        F.sum("l_quantity").alias("sum_value"), F.count(F.lit(1)).alias("n"),
        F.min("l_quantity").alias("min_value"), F.max("l_quantity").alias("max_value"))
    # ... recombined exactly by sum and count, never by averaging averages
    r = agg.weighted_recombine(part, ["l_suppkey"])
    return r.select("l_suppkey", "n", rh("avg_value", 6).alias("avg_value"), "min_value", "max_value")


@query("ag_bucket_boundaries", ops=("AG-15", "SF-14"), sql=f"""
SELECT CASE WHEN c_acctbal >= -1000 AND c_acctbal < 0 THEN 'negative'
            WHEN c_acctbal >= 0 AND c_acctbal < 2500 THEN 'low'
            WHEN c_acctbal >= 2500 AND c_acctbal < 5000 THEN 'mid'
            WHEN c_acctbal >= 5000 AND c_acctbal < 7500 THEN 'high'
            ELSE 'other' END AS bucket,
       count(*) AS n, {rnd("avg(c_acctbal)", 2)} AS avg_balance
FROM customer GROUP BY 1
""")
def ag_bucket_boundaries(spark, d):
    return agg.bucket_by_boundaries(
        read(spark, d, "customer"), "c_acctbal", [-1000, 0, 2500, 5000, 7500], "other",
        {"avg_balance": rh(F.avg("c_acctbal"), 2)}, labels=["negative", "low", "mid", "high"])


@query("ag_facet_counts", ops=("AG-16",), sql="""
SELECT 'c_mktsegment' AS facet, c_mktsegment AS value, count(*) AS n FROM customer GROUP BY c_mktsegment
UNION ALL SELECT 'c_nationkey', CAST(c_nationkey AS VARCHAR), count(*) FROM customer GROUP BY c_nationkey
UNION ALL SELECT 'positive', CAST(c_acctbal > 0 AS VARCHAR), count(*) FROM customer GROUP BY c_acctbal > 0
""")
def ag_facet_counts(spark, d):
    c = read(spark, d, "customer").withColumn("positive", F.col("c_acctbal") > 0)
    return agg.facet_counts(c, ["c_mktsegment", "c_nationkey", "positive"])


@query("ag_pivot_flags", ops=("AG-17",), sql="""
SELECT l_returnflag, count(*) FILTER (WHERE l_linestatus = 'F') AS F,
       count(*) FILTER (WHERE l_linestatus = 'O') AS O FROM lineitem GROUP BY l_returnflag
""")
def ag_pivot_flags(spark, d):
    return agg.pivot_counts(read(spark, d, "lineitem"), "l_returnflag", "l_linestatus", ["F", "O"])


@query("ag_last_by_order", ops=("AG-18", "OL-05"), sql="""
SELECT o_custkey, arg_max(o_totalprice, {'d': o_orderdate, 'k': o_orderkey}) AS last_price,
       max(o_orderdate) AS last_date FROM orders GROUP BY o_custkey
""")
def ag_last_by_order(spark, d):
    o = read(spark, d, "orders")
    return o.groupBy("o_custkey").agg(
        F.max_by("o_totalprice", F.struct("o_orderdate", "o_orderkey")).alias("last_price"),
        F.max("o_orderdate").alias("last_date"))


@query("ag_top_suppliers", ops=("AG-19", "OL-04"), sql=f"""
SELECT l_suppkey, {rnd("sum(l_extendedprice * (1 - l_discount))", 2)} AS revenue FROM lineitem
GROUP BY l_suppkey ORDER BY sum(l_extendedprice * (1 - l_discount)) DESC, l_suppkey LIMIT 10
""")
def ag_top_suppliers(spark, d):
    g = read(spark, d, "lineitem").groupBy("l_suppkey").agg(
        F.sum(F.col("l_extendedprice") * (1 - F.col("l_discount"))).alias("rev"))
    return (g.orderBy(F.col("rev").desc(), "l_suppkey").limit(10)
            .select("l_suppkey", rh("rev", 2).alias("revenue")))


@query("ag_month_counts_from_text", ops=("AG-20", "SF-11"), sql="""
WITH t AS (SELECT o_orderpriority, strftime(o_orderdate, '%Y-%m-%dT%H:%M:%S') AS iso FROM orders)
SELECT o_orderpriority, date_trunc('month', CAST(iso AS TIMESTAMP)) AS month, count(*) AS n FROM t GROUP BY ALL
""")
def ag_month_counts_from_text(spark, d):
    o = read(spark, d, "orders").select(
        "o_orderpriority", F.date_format("o_orderdate", "yyyy-MM-dd'T'HH:mm:ss").alias("iso"))
    ts_ = F.to_timestamp_ntz("iso", F.lit("yyyy-MM-dd'T'HH:mm:ss"))
    return o.groupBy("o_orderpriority", trunc("month", ts_).alias("month")).agg(
        F.count(F.lit(1)).alias("n"))


@query("ag_row_count_report", ops=("AG-21", "ETL-09"), sql="""
SELECT 'region' AS table_name, count(*) AS n_rows FROM region
UNION ALL SELECT 'nation', count(*) FROM nation
UNION ALL SELECT 'supplier', count(*) FROM supplier
UNION ALL SELECT 'customer', count(*) FROM customer
UNION ALL SELECT 'part', count(*) FROM part
UNION ALL SELECT 'orders', count(*) FROM orders
UNION ALL SELECT 'lineitem', count(*) FROM lineitem
""")
def ag_row_count_report(spark, d):
    names = ["region", "nation", "supplier", "customer", "part", "orders", "lineitem"]
    return agg.count_report({n: read(spark, d, n) for n in names})

"""Registered data-quality and profiling queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from oreflow.functions.numeric import round_half_up as rh
from oreflow.operators import documents as doc
from oreflow.operators import profile as pr
from oreflow.operators import quality as dq
from oreflow.operators.quality import Rule
from oreflow.plans.q_documents import customer_docs, supplier_xml
from oreflow.plans.registry import query
from oreflow.plans.sqlfmt import rnd
from oreflow.sources.tables import production, read, sensor_readings

# Suites are data: the rule list drives both the evaluation and the SQL twin.
ORDER_RULES = [
    Rule("key_not_null", "not_null", "o_orderkey", severity="critical", action="reject_row"),
    Rule("key_unique", "unique", "o_orderkey", severity="critical", action="reject_duplicates"),
    Rule("status_in_set", "in_set", "o_orderstatus", {"values": ["F", "O", "P"]}),
    Rule("price_range", "between", "o_totalprice", {"min": 1000.0, "max": 400000.0}),
    Rule("priority_format", "regex", "o_orderpriority", {"pattern": "^[1-5]-[A-Z ]+$"}),
    Rule("row_count", "row_count", None, {"min": 1}),
    Rule("customer_fk", "fk", "o_custkey", {"parent": "customer", "parent_key": "c_custkey"}),
    Rule("date_not_before_1995", "expr", None,
         {"predicate": "o_orderdate >= TIMESTAMP_NTZ '1995-01-01 00:00:00'"}),
]


def _pct(u: str, e: str) -> str:
    return f"round({u} * 100.0 / nullif({e}, 0), 4)"


@query("dq_suite_orders", ops=("DQ-01", "DQ-02", "DQ-03", "DQ-04", "DQ-05", "DQ-06", "DQ-07", "DQ-12",
                               "SNK-10", "UD-04"), sql=f"""
WITH r AS (
 SELECT 'key_not_null' AS rule, 'not_null' AS kind, 'o_orderkey' AS "column", count(*) AS evaluated,
        count(*) FILTER (WHERE o_orderkey IS NULL) AS unexpected FROM orders
 UNION ALL SELECT 'status_in_set', 'in_set', 'o_orderstatus', count(o_orderstatus),
        count(*) FILTER (WHERE o_orderstatus NOT IN ('F', 'O', 'P')) FROM orders
 UNION ALL SELECT 'price_range', 'between', 'o_totalprice', count(o_totalprice),
        count(*) FILTER (WHERE o_totalprice < 1000 OR o_totalprice > 400000) FROM orders
 UNION ALL SELECT 'priority_format', 'regex', 'o_orderpriority', count(o_orderpriority),
        count(*) FILTER (WHERE NOT regexp_matches(o_orderpriority, '^[1-5]-[A-Z ]+$')) FROM orders
 UNION ALL SELECT 'date_not_before_1995', 'expr', NULL, count(*),
        count(*) FILTER (WHERE o_orderdate < TIMESTAMP '1995-01-01') FROM orders
 UNION ALL SELECT 'key_unique', 'unique', 'o_orderkey', count(o_orderkey),
        count(o_orderkey) - count(DISTINCT o_orderkey) FROM orders
 UNION ALL SELECT 'row_count', 'row_count', NULL, 1,
        CASE WHEN count(*) BETWEEN 1 AND 1000000000 THEN 0 ELSE 1 END FROM orders
 UNION ALL SELECT 'customer_fk', 'fk', 'o_custkey', count(o_custkey),
        count(*) FILTER (WHERE o_custkey IS NOT NULL AND o_custkey NOT IN (SELECT c_custkey FROM customer))
        FROM orders)
SELECT *, {_pct("unexpected", "evaluated")} AS unexpected_pct, unexpected = 0 AS success FROM r
""")
def dq_suite_orders(spark, d):
    return dq.evaluate(read(spark, d, "orders"), ORDER_RULES, {"customer": read(spark, d, "customer")})


LINE_RULES = [
    Rule("shipped_after_order", "expr", None, {"predicate": "l_shipdate >= o_orderdate"}),
    Rule("returned_implies_finished", "expr", None,
         {"predicate": "NOT (l_returnflag = 'R') OR l_linestatus = 'F'"}),
    Rule("discount_range", "between", "l_discount", {"min": 0.0, "max": 0.1}),
    Rule("flag_in_set", "in_set", "l_returnflag", {"values": ["A", "N", "R"]}),
    Rule("shipdate_not_null", "not_null", "l_shipdate"),
]


@query("dq_suite_lineitem", ops=("DQ-08", "DQ-09", "DQ-12"), sql=f"""
WITH p AS (SELECT * FROM lineitem JOIN orders ON l_orderkey = o_orderkey),
r AS (
 SELECT 'shipped_after_order' AS rule, 'expr' AS kind, NULL AS "column", count(*) AS evaluated,
        count(*) FILTER (WHERE l_shipdate < o_orderdate) AS unexpected FROM p
 UNION ALL SELECT 'returned_implies_finished', 'expr', NULL, count(*),
        count(*) FILTER (WHERE l_returnflag = 'R' AND l_linestatus <> 'F') FROM p
 UNION ALL SELECT 'discount_range', 'between', 'l_discount', count(l_discount),
        count(*) FILTER (WHERE l_discount < 0 OR l_discount > 0.1) FROM p
 UNION ALL SELECT 'flag_in_set', 'in_set', 'l_returnflag', count(l_returnflag),
        count(*) FILTER (WHERE l_returnflag NOT IN ('A', 'N', 'R')) FROM p
 UNION ALL SELECT 'shipdate_not_null', 'not_null', 'l_shipdate', count(*),
        count(*) FILTER (WHERE l_shipdate IS NULL) FROM p)
SELECT *, {_pct("unexpected", "evaluated")} AS unexpected_pct, unexpected = 0 AS success FROM r
""")
def dq_suite_lineitem(spark, d):
    return dq.evaluate(production(spark, d), LINE_RULES)


QUARANTINE_RULES = [
    Rule("quantity_range", "between", "l_quantity", {"min": 1.0, "max": 49.0}, "critical", "reject_row"),
    Rule("high_discount", "between", "l_discount", {"max": 0.09}, "warning", "flag_as_suspect"),
    Rule("line_key_unique", "unique", "line_key", {}, "critical", "reject_duplicates"),
    Rule("tax_range", "between", "l_tax", {"min": 0.0, "max": 0.08}, "info", "log_and_continue"),
]


@query("dq_quarantine_split", ops=("DQ-11", "ETL-08"), sql="""
WITH l AS (SELECT *, CAST(l_orderkey AS VARCHAR) || '-' || CAST(l_linenumber AS VARCHAR) AS line_key FROM lineitem),
c AS (SELECT *, count(*) OVER (PARTITION BY line_key) AS copies FROM l),
x AS (SELECT *, CASE WHEN l_quantity < 1 OR l_quantity > 49 THEN 'quantity_range'
                     WHEN copies > 1 THEN 'line_key_unique' END AS error_type,
             l_discount > 0.09 AS is_suspect FROM c)
SELECT CASE WHEN error_type IS NULL THEN 'clean' ELSE 'quarantine' END AS outcome,
       error_type, CASE WHEN error_type IS NULL THEN is_suspect END AS is_suspect, count(*) AS n
FROM x GROUP BY ALL
""")
def dq_quarantine_split(spark, d):
    li = read(spark, d, "lineitem").withColumn(
        "line_key", F.concat_ws("-", F.col("l_orderkey").cast("string"), F.col("l_linenumber").cast("string")))
    clean, bad = dq.split_quarantine(li, QUARANTINE_RULES, ["line_key"], "lineitem", load_id=1)
    a = clean.groupBy(F.lit("clean").alias("outcome"), F.lit(None).cast("string").alias("error_type"),
                      "is_suspect").agg(F.count(F.lit(1)).alias("n"))
    b = bad.groupBy(F.lit("quarantine").alias("outcome"), "error_type",
                    F.lit(None).cast("boolean").alias("is_suspect")).agg(F.count(F.lit(1)).alias("n"))
    return a.unionByName(b)


# Physical range per sensor type of the binding (DQ-10): one row per type.
SENSOR_RANGES = [("click", 0.0, 300.0), ("view", 0.0, 250.0), ("purchase", 0.0, 350.0),
                 ("signup", 0.0, 300.0), ("error", 0.0, 200.0)]


@query("dq_range_flags", ops=("DQ-10", "JN-09"), sql="""
WITH rg(t, lo, hi) AS (VALUES ('click', 0.0, 300.0), ('view', 0.0, 250.0), ('purchase', 0.0, 350.0),
                              ('signup', 0.0, 300.0), ('error', 0.0, 200.0))
SELECT event_type AS sensor_type, count(*) FILTER (WHERE value < lo OR value > hi) AS n_suspect, count(*) AS n
FROM events JOIN rg ON rg.t = event_type GROUP BY event_type
""")
def dq_range_flags(spark, d):
    ranges = spark.createDataFrame(SENSOR_RANGES, "sensor_type string, min double, max double")
    f = dq.range_flags(sensor_readings(spark, d), ranges, "sensor_type", "value")
    return f.groupBy("sensor_type").agg(F.count_if("is_suspect").alias("n_suspect"),
                                        F.count(F.lit(1)).alias("n"))


@query("dq_freshness", ops=("DQ-14",), sql="""
WITH n AS (SELECT max(o_orderdate) - INTERVAL 30 DAY AS now_ FROM orders)
SELECT CASE WHEN o_orderdate > now_ THEN 'future'
            WHEN o_orderdate < now_ - INTERVAL 365 DAY THEN 'stale' ELSE 'fresh' END AS freshness,
       count(*) AS n
FROM orders, n GROUP BY 1
""")
def dq_freshness(spark, d):
    o = read(spark, d, "orders")
    # "now" is a parameter; here 30 days before the newest order, so the
    # three classes all occur
    now = o.select(F.max("o_orderdate") - F.expr("INTERVAL 30 DAYS")).scalar()
    return dq.freshness(o, "o_orderdate", now, 365).groupBy("freshness").agg(F.count(F.lit(1)).alias("n"))


@query("dq_quality_dimensions", ops=("DQ-15",), sql=f"""
WITH o AS (SELECT * FROM orders),
t AS (SELECT l_orderkey AS k, count(*) AS lines, sum(l_extendedprice * (1 - l_discount) * (1 + l_tax)) AS total,
             CASE WHEN bool_and(l_linestatus = 'F') THEN 'F' WHEN bool_and(l_linestatus = 'O') THEN 'O' ELSE 'P' END AS status
      FROM lineitem GROUP BY 1),
mx AS (SELECT max(o_orderdate) AS t FROM orders),
s AS (
 SELECT 'orders' AS source, 'completeness' AS dimension,
        (count(o_custkey) + count(o_orderdate)) / (2.0 * count(*)) AS score FROM o
 UNION ALL SELECT 'orders', 'uniqueness', count(DISTINCT o_orderkey) / count(*) FROM o
 UNION ALL SELECT 'orders', 'validity', count(*) FILTER (WHERE o_orderstatus IN ('F', 'O', 'P')) / count(*) FROM o
 UNION ALL SELECT 'orders', 'accuracy',
        (2.0 * count(*) FILTER (WHERE t.lines > 0 AND abs(o_totalprice - t.total) <= 0.01 * t.total)
         + count(*) FILTER (WHERE t.lines > 0 AND o_orderstatus = t.status)) / (3.0 * count(t.lines))
        FROM o LEFT JOIN t ON t.k = o.o_orderkey
 UNION ALL SELECT 'orders', 'consistency',
        count(*) FILTER (WHERE o_custkey IN (SELECT c_custkey FROM customer)) / count(*) FROM o
 UNION ALL SELECT 'orders', 'timeliness',
        count(*) FILTER (WHERE o_orderdate >= (SELECT t FROM mx) - INTERVAL 365 DAY) / count(*) FROM o)
SELECT source, dimension, {rnd("score", 4)} AS score, score >= 0.95 AS passed FROM s
UNION ALL SELECT source, 'overall', {rnd("avg(score)", 4)}, avg(score) >= 0.95 FROM s GROUP BY source
""")
def dq_quality_dimensions(spark, d):
    o, c = read(spark, d, "orders"), read(spark, d, "customer")
    # what the lines say is trusted: an order's value (to 1 %) and its status
    is_all = lambda x: F.bool_and(F.col("l_linestatus") == x)
    lines = read(spark, d, "lineitem").groupBy(F.col("l_orderkey").alias("k")).agg(
        F.sum(F.col("l_extendedprice") * (1 - F.col("l_discount")) * (1 + F.col("l_tax"))).alias("total"),
        F.when(is_all("F"), "F").when(is_all("O"), "O").otherwise("P").alias("status"))
    agree = {"o_totalprice": (F.abs(F.col("o_totalprice") - F.col("total")) <= 0.01 * F.col("total"), 2.0),
             "o_orderstatus": (F.col("o_orderstatus") == F.col("status"), 1.0)}
    return dq.dimension_scores(o, "orders", key="o_orderkey", required=["o_custkey", "o_orderdate"],
                            valid=F.col("o_orderstatus").isin("F", "O", "P"),
                            fk=("o_custkey", c, "c_custkey"), ts="o_orderdate", max_age_days=365,
                            target=0.95, trusted=(lines, "k", agree))


@query("dq_cross_source", ops=("DQ-16", "JN-06"), sql="""
WITH l AS (SELECT l_orderkey, sum(l_extendedprice * (1 - l_discount) * (1 + l_tax)) AS lines_value
           FROM lineitem GROUP BY l_orderkey)
SELECT CASE WHEN o.o_orderkey IS NULL THEN 'missing_order' WHEN l.l_orderkey IS NULL THEN 'missing_lines'
            WHEN abs(o.o_totalprice - l.lines_value) <= 0.01 * o.o_totalprice THEN 'match'
            ELSE 'mismatch' END AS status, count(*) AS n
FROM orders o FULL OUTER JOIN l ON l.l_orderkey = o.o_orderkey GROUP BY 1
""")
def dq_cross_source(spark, d):
    o = read(spark, d, "orders").select("o_orderkey", "o_totalprice")
    li = read(spark, d, "lineitem")
    lv = li.groupBy("l_orderkey").agg(F.sum(F.col("l_extendedprice") * (1 - F.col("l_discount"))
                                            * (1 + F.col("l_tax"))).alias("lines_value"))
    j = o.join(lv, o.o_orderkey == lv.l_orderkey, "full_outer")
    st = (F.when(F.col("o_orderkey").isNull(), "missing_order")
          .when(F.col("l_orderkey").isNull(), "missing_lines")
          .when(F.abs(F.col("o_totalprice") - F.col("lines_value")) <= 0.01 * F.col("o_totalprice"), "match")
          .otherwise("mismatch"))
    return j.groupBy(st.alias("status")).agg(F.count(F.lit(1)).alias("n"))


CUSTOMER_DOC_SCHEMA = {
    "type": "object",
    "required": ["id", "type", "nation", "tags"],
    "additionalProperties": False,
    "properties": {
        "id": {"type": "integer", "minimum": 0, "maximum": 999},
        "type": {"type": "string", "enum": ["AUTOMOBILE", "BUILDING", "FURNITURE", "MACHINERY"]},
        "nation": {"type": "object", "required": ["key", "name"],
                   "properties": {"key": {"type": "integer", "minimum": 0, "maximum": 24},
                                  "name": {"type": "string", "pattern": "^[A-Z][A-Z0-9_ ]*$"}}},
        "flag": {"type": ["string", "null"], "enum": ["debt", None]},
        "tags": {"type": "array", "items": {"enum": ["vip", "gold", "std"]}, "uniqueItems": True},
    },
}


@query("dq_json_schema", ops=("DQ-17",), sql="""
SELECT '$.id:maximum' AS violation, count(*) AS n FROM customer WHERE c_custkey > 999 HAVING count(*) > 0
UNION ALL
SELECT '$.type:enum', count(*) FROM customer
WHERE c_mktsegment NOT IN ('AUTOMOBILE', 'BUILDING', 'FURNITURE', 'MACHINERY') HAVING count(*) > 0
""")
def dq_json_schema(spark, d):
    v = dq.schema_violations(customer_docs(spark, d), CUSTOMER_DOC_SCHEMA, "doc", "c_custkey")
    return v.groupBy("violation").agg(F.count(F.lit(1)).alias("n"))


ORDER_DOC_SCHEMA = {
    "type": "object",
    "$defs": {
        "Text": {"type": "string", "minLength": 1},
        "Line": {"type": "object", "required": ["n", "part"], "additionalProperties": False,
                 "properties": {"n": {"type": "integer", "minimum": 1, "maximum": 6}, "flag": {"enum": ["A", "N"]},
                                "part": {"type": "string", "pattern": "^P-[0-9]{1,3}$"}, "qty": {"type": "number"}}},
    },
    "required": ["id", "clerk", "lines"],
    "properties": {
        "id": {"type": "string", "maxLength": 6}, "clerk": {"$ref": "#/$defs/Text"},
        "lines": {"type": "array", "items": {"$ref": "#/$defs/Line"}, "uniqueItems": True},
        "discount": {"oneOf": [{"type": "number"}, {"type": "null"}]},
    },
}


@query("dq_json_schema_nested", ops=("DQ-17",), sql="""
WITH d AS (SELECT o_orderkey AS k, bool_or(l_linenumber > 6) AS n, bool_or(l_returnflag = 'R') AS flag, bool_or(l_partkey > 999) AS part
           FROM orders JOIN lineitem ON l_orderkey = o_orderkey GROUP BY 1),
v AS (
  SELECT k, '$.id:maxLength' AS violation FROM d WHERE length('O-' || k) > 6
  UNION ALL SELECT k, '$.clerk:minLength' FROM d WHERE k % 50 = 0
  UNION ALL SELECT k, '$.lines[*].n:maximum' FROM d WHERE n
  UNION ALL SELECT k, '$.lines[*].flag:enum' FROM d WHERE flag
  UNION ALL SELECT k, '$.lines[*].part:pattern' FROM d WHERE part
  UNION ALL SELECT k, '$.discount:oneOf' FROM d WHERE k % 7 = 2)
SELECT violation, count(*) AS n, CAST(sum(k) AS BIGINT) AS sum_keys FROM v GROUP BY violation
""")
def dq_json_schema_nested(spark, d):
    """Orders as documents (lines nested; one order's lines are few) against a
    schema with definitions, alternatives, lengths and element rules."""
    k = F.col("o_orderkey")
    line = F.struct(F.col("l_linenumber").alias("n"), F.col("l_returnflag").alias("flag"),
                    F.concat(F.lit("P-"), F.col("l_partkey").cast("string")).alias("part"), F.col("l_quantity").alias("qty"))
    o = read(spark, d, "orders").join(read(spark, d, "lineitem"), F.col("l_orderkey") == k) \
        .groupBy("o_orderkey").agg(F.collect_list(line).alias("lines"))
    text = F.to_json(F.struct(F.concat(F.lit("O-"), k.cast("string")).alias("id"), F.when(k % 50 == 0, "").otherwise("clerk").alias("clerk"),
                              "lines"))
    discount = F.when(k % 7 == 2, '"n/a"').when(k % 7 == 3, "null").otherwise("0.5")
    docs = o.select("o_orderkey", F.concat(F.left(text, F.length(text) - 1), F.lit(',"discount":'), discount, F.lit("}")).alias("doc"))
    v = dq.schema_violations(docs, ORDER_DOC_SCHEMA, "doc", "o_orderkey")
    return v.groupBy("violation").agg(F.count(F.lit(1)).alias("n"), F.sum("o_orderkey").alias("sum_keys"))


@query("dq_document_validator", ops=("DQ-18",), sql="""
WITH b AS (SELECT c_custkey > 999 OR c_mktsegment NOT IN ('AUTOMOBILE', 'BUILDING', 'FURNITURE', 'MACHINERY')
                  AS bad, c_nationkey % 2 = 0 AS even FROM customer)
SELECT 'strict/error' AS mode, CASE WHEN bad THEN 'rejected' ELSE 'accepted' END AS status, count(*) AS n
FROM b GROUP BY ALL
UNION ALL
SELECT 'strict/warn', CASE WHEN bad THEN 'warned' ELSE 'accepted' END, count(*) FROM b GROUP BY ALL
UNION ALL
SELECT 'moderate/error', CASE WHEN bad AND even THEN 'rejected' ELSE 'accepted' END, count(*) FROM b GROUP BY ALL
""")
def dq_document_validator(spark, d):
    docs = customer_docs(spark, d)
    a = dq.validate_documents(docs, CUSTOMER_DOC_SCHEMA, "doc", "c_custkey", "strict", "error")
    b = dq.validate_documents(docs, CUSTOMER_DOC_SCHEMA, "doc", "c_custkey", "strict", "warn")
    # moderate: documents that were not valid before are let through
    c = dq.validate_documents(docs.join(read(spark, d, "customer").select("c_custkey", "c_nationkey"), "c_custkey"),
                              CUSTOMER_DOC_SCHEMA, "doc", "c_custkey", "moderate", "error", F.col("c_nationkey") % 2 == 0)
    counts = [x.groupBy(F.lit(mode).alias("mode"), "status").agg(F.count(F.lit(1)).alias("n"))
              for mode, x in (("strict/error", a), ("strict/warn", b), ("moderate/error", c))]
    return counts[0].unionByName(counts[1]).unionByName(counts[2])


XML_RULES = [
    Rule("id_pattern", "regex", "id", {"pattern": "^[0-9]+$"}),
    Rule("payload_range", "between", "payload", {"min": -1000.0, "max": 9000.0}),
    Rule("mine_code_pattern", "regex", "mine_code", {"pattern": "^M([0-9]|1[0-9]|2[0-4])$"}),
    Rule("unit_required", "not_null", "unit"),
]


@query("dq_xml_rules", ops=("DQ-19",), sql=f"""
WITH x AS (SELECT CAST(s_suppkey AS VARCHAR) AS id, s_acctbal AS payload,
                  'M' || CAST(s_nationkey AS VARCHAR) AS mine_code, 't' AS unit FROM supplier),
r AS (
 SELECT 'id_pattern' AS rule, 'regex' AS kind, 'id' AS "column", count(id) AS evaluated,
        count(*) FILTER (WHERE NOT regexp_matches(id, '^[0-9]+$')) AS unexpected FROM x
 UNION ALL SELECT 'payload_range', 'between', 'payload', count(payload),
        count(*) FILTER (WHERE payload < -1000 OR payload > 9000) FROM x
 UNION ALL SELECT 'mine_code_pattern', 'regex', 'mine_code', count(mine_code),
        count(*) FILTER (WHERE NOT regexp_matches(mine_code, '^M([0-9]|1[0-9]|2[0-4])$')) FROM x
 UNION ALL SELECT 'unit_required', 'not_null', 'unit', count(*), count(*) FILTER (WHERE unit IS NULL) FROM x)
SELECT *, {_pct("unexpected", "evaluated")} AS unexpected_pct, unexpected = 0 AS success FROM r
""")
def dq_xml_rules(spark, d):
    x = supplier_xml(spark, d).select(
        doc.xpath_text("xml", "/equipment/@id").alias("id"),
        doc.xpath_number("xml", "//specifications/payload").alias("payload"),
        doc.xpath_text("xml", "//mine/@code").alias("mine_code"),
        F.nullif(doc.xpath_text("xml", "//specifications/payload/@unit"), F.lit("")).alias("unit"))
    return dq.evaluate(x, XML_RULES)


@query("pr_profile_columns", ops=("PR-01",), sql=f"""
WITH l AS (SELECT * FROM lineitem)
SELECT 'l_quantity' AS "column", m.metric, m.value FROM (
  SELECT [{{'metric': 'count', 'value': count(l_quantity)::DOUBLE}},
          {{'metric': 'missing', 'value': count(*) FILTER (WHERE l_quantity IS NULL)::DOUBLE}},
          {{'metric': 'distinct', 'value': count(DISTINCT l_quantity)::DOUBLE}},
          {{'metric': 'min', 'value': min(l_quantity)}}, {{'metric': 'max', 'value': max(l_quantity)}},
          {{'metric': 'mean', 'value': {rnd("avg(l_quantity)", 6)}}},
          {{'metric': 'std', 'value': {rnd("stddev_samp(l_quantity)", 6)}}},
          {{'metric': 'zeros', 'value': count(*) FILTER (WHERE l_quantity = 0)::DOUBLE}},
          {{'metric': 'negatives', 'value': count(*) FILTER (WHERE l_quantity < 0)::DOUBLE}},
          {{'metric': 'p50', 'value': quantile_disc(l_quantity, 0.5)}},
          {{'metric': 'p90', 'value': quantile_disc(l_quantity, 0.9)}}] AS a FROM l), unnest(a) AS t(m)
UNION ALL
SELECT 'l_returnflag', m.metric, m.value FROM (
  SELECT [{{'metric': 'count', 'value': count(l_returnflag)::DOUBLE}},
          {{'metric': 'missing', 'value': count(*) FILTER (WHERE l_returnflag IS NULL)::DOUBLE}},
          {{'metric': 'distinct', 'value': count(DISTINCT l_returnflag)::DOUBLE}},
          {{'metric': 'min_length', 'value': min(length(l_returnflag))::DOUBLE}},
          {{'metric': 'max_length', 'value': max(length(l_returnflag))::DOUBLE}},
          {{'metric': 'mean_length', 'value': {rnd("avg(length(l_returnflag))", 6)}}}] AS a FROM l),
  unnest(a) AS t(m)
""")
def pr_profile_columns(spark, d):
    p = pr.profile(read(spark, d, "lineitem"), ["l_quantity", "l_returnflag"], quantiles=[0.5, 0.9],
                   exact_distinct=True)
    return p.where(~F.col("metric").isin("skewness", "rows")).select(
        "column", "metric", F.when(F.col("metric").isin("mean", "std", "mean_length"), rh("value", 6))
        .otherwise(F.col("value")).alias("value"))


@query("pr_histogram", ops=("PR-02",), sql="""
WITH mm AS (SELECT min(l_extendedprice) lo, max(l_extendedprice) hi FROM lineitem)
SELECT CAST(least(floor((l_extendedprice - lo) / ((hi - lo) / 10)), 9) AS INTEGER) AS bin, count(*) AS n,
       min(l_extendedprice) AS bin_min, max(l_extendedprice) AS bin_max
FROM lineitem, mm GROUP BY 1
""")
def pr_histogram(spark, d):
    return pr.histogram(read(spark, d, "lineitem"), "l_extendedprice", 10)


@query("pr_correlations", ops=("PR-03",), sql=f"""
WITH r AS (SELECT l_quantity, l_extendedprice,
                  rank() OVER (ORDER BY l_quantity) + (count(*) OVER (PARTITION BY l_quantity) - 1) / 2.0 AS ra,
                  rank() OVER (ORDER BY l_extendedprice) + (count(*) OVER (PARTITION BY l_extendedprice) - 1) / 2.0 AS rb
           FROM lineitem),
ct AS (SELECT l_returnflag a, l_linestatus b, count(*) n_ab FROM lineitem GROUP BY ALL),
ra AS (SELECT a, sum(n_ab) n_a FROM ct GROUP BY a), rb AS (SELECT b, sum(n_ab) n_b FROM ct GROUP BY b),
tot AS (SELECT sum(n_ab) n, count(DISTINCT a) ka, count(DISTINCT b) kb FROM ct),
chi AS (SELECT sum(n_ab * n_ab / (n_a * n_b / (SELECT n FROM tot))) - (SELECT n FROM tot) AS chi2
        FROM ct JOIN ra USING (a) JOIN rb USING (b))
SELECT {rnd("(SELECT corr(l_quantity, l_extendedprice) FROM lineitem)", 6)} AS pearson,
       {rnd("(SELECT corr(ra, rb) FROM r)", 6)} AS spearman,
       {rnd("sqrt(chi2 / ((SELECT n FROM tot) * (SELECT least(ka, kb) - 1 FROM tot)))", 6)} AS cramers_v
FROM chi
""")
def pr_correlations(spark, d):
    li = read(spark, d, "lineitem")
    pearson = li.select(F.corr("l_quantity", "l_extendedprice")).scalar()
    cv = pr.cramers_v(li, "l_returnflag", "l_linestatus").select("cramers_v").scalar()
    sp = pr.spearman(li, "l_quantity", "l_extendedprice")
    # scalar sub-queries: each one-row result is attached without a join
    return sp.select(rh(pearson, 6).alias("pearson"), rh("spearman", 6).alias("spearman"),
                     rh(cv, 6).alias("cramers_v"))


LINE_COLUMNS = ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_extendedprice", "l_discount", "l_tax",
                "l_returnflag", "l_linestatus", "l_shipdate"]


@query("pr_duplicates_and_nulls", ops=("PR-04",), sql=f"""
WITH d AS (SELECT count(*) AS n FROM lineitem GROUP BY {", ".join(LINE_COLUMNS)} HAVING count(*) > 1)
SELECT 'rows' AS kind, 'distinct rows that repeat' AS item, count(*) AS n FROM d
UNION ALL SELECT 'rows', 'copies of them', CAST(coalesce(sum(n), 0) AS BIGINT) FROM d
UNION ALL SELECT 'event', 'user and type that repeat', count(*) FROM (SELECT 1 FROM events GROUP BY user_id, event_type HAVING count(*) > 1)
UNION ALL SELECT 'nulls', {" || ".join(f"(CASE WHEN {c} IS NULL THEN '1' ELSE '0' END)" for c in LINE_COLUMNS)}, count(*) FROM lineitem GROUP BY 2
""")
def pr_duplicates_and_nulls(spark, d):
    """Repeated rows by all columns, and the patterns of missing values over all of them."""
    li = read(spark, d, "lineitem").select(*LINE_COLUMNS)
    dup = pr.duplicate_rows(li).agg(F.count(F.lit(1)).alias("a"), F.coalesce(F.sum("n_copies"), F.lit(0)).alias("b"))
    rows = dup.select(F.explode(F.array(
        F.struct(F.lit("rows").alias("kind"), F.lit("distinct rows that repeat").alias("item"), F.col("a").alias("n")),
        F.struct(F.lit("rows").alias("kind"), F.lit("copies of them").alias("item"), F.col("b").alias("n")))).alias("x")).select("x.*")
    ev = pr.duplicate_rows(read(spark, d, "events"), ["user_id", "event_type"]).agg(F.count(F.lit(1)).alias("n"))
    nul = pr.null_patterns(li, LINE_COLUMNS).select(F.lit("nulls").alias("kind"), F.col("null_mask").alias("item"), "n")
    return rows.unionByName(ev.select(F.lit("event").alias("kind"), F.lit("user and type that repeat").alias("item"), "n")).unionByName(nul)


@query("pr_top_values", ops=("PR-01",), sql="""
WITH v AS (
  SELECT 'o_custkey' AS "column", 'bigint' AS type, CAST(o_custkey AS VARCHAR) AS value, count(*) AS n FROM orders GROUP BY ALL
  UNION ALL SELECT 'o_orderpriority', 'string', o_orderpriority, count(*) FROM orders GROUP BY ALL
  UNION ALL SELECT 'o_orderstatus', 'string', o_orderstatus, count(*) FROM orders GROUP BY ALL)
SELECT "column", type, CAST(place AS INTEGER) AS place, value, n
FROM (SELECT *, row_number() OVER (PARTITION BY "column" ORDER BY n DESC, value) AS place FROM v WHERE value IS NOT NULL) WHERE place <= 5
""")
def pr_top_values(spark, d):
    return pr.top_values(read(spark, d, "orders"), ["o_custkey", "o_orderpriority", "o_orderstatus"])


@query("pr_profile_estimates", ops=("PR-01",), sql="""
SELECT c AS "column", TRUE AS distinct_within, TRUE AS median_within FROM (VALUES ('l_partkey'), ('l_extendedprice'), ('l_quantity')) t(c)
""")
def pr_profile_estimates(spark, d):
    """The default profile (sketches) against exact values: distinct counts within
    five times the sketch's relative deviation of 1 %, ranks of the median within
    0.01 % of the rows and one."""
    li, cols = read(spark, d, "lineitem"), ["l_partkey", "l_extendedprice", "l_quantity"]
    p = pr.profile(li, cols, quantiles=[0.5])
    est = p.where(F.col("metric").isin("distinct", "p50")).groupBy("column").pivot("metric", ["distinct", "p50"]).agg(F.first("value"))
    out = None
    for c in cols:
        mid = est.where(F.col("column") == c).select("p50").scalar()
        exact = li.agg(F.count_distinct(c).alias("d"), F.count(c).alias("n"), F.count_if(F.col(c) < mid).alias("below"),
                       F.count_if(F.col(c) <= mid).alias("upto")).select(F.lit(c).alias("column"), "*")
        out = exact if out is None else out.unionByName(exact)
    slack = F.col("n") * 0.0001 + 1
    return est.join(out, "column").select(
        "column", (F.abs(F.col("distinct") - F.col("d")) <= 0.05 * F.col("d")).alias("distinct_within"),
        ((F.col("below") <= F.col("n") / 2 + slack) & (F.col("upto") >= F.col("n") / 2 - slack)).alias("median_within"))


@query("pr_high_correlation", ops=("PR-05", "PR-03"), sql=f"""
WITH c AS (SELECT corr(l_quantity, l_extendedprice) AS a, corr(l_quantity, l_discount) AS b, corr(l_extendedprice, l_discount) AS c_,
                  corr(l_quantity, 2 * l_quantity + l_tax) AS d, corr(l_extendedprice, 2 * l_quantity + l_tax) AS e,
                  corr(l_discount, 2 * l_quantity + l_tax) AS f FROM lineitem),
p AS (SELECT 'l_quantity' AS "column", 'l_extendedprice' AS other, a AS value FROM c
      UNION ALL SELECT 'l_quantity', 'l_discount', b FROM c UNION ALL SELECT 'l_extendedprice', 'l_discount', c_ FROM c
      UNION ALL SELECT 'l_quantity', 'twice', d FROM c UNION ALL SELECT 'l_extendedprice', 'twice', e FROM c
      UNION ALL SELECT 'l_discount', 'twice', f FROM c)
SELECT "column", other, 'high_correlation' AS alert, {rnd("value", 6)} AS value FROM p WHERE abs(value) > 0.9
""")
def pr_high_correlation(spark, d):
    li = read(spark, d, "lineitem").withColumn("twice", 2 * F.col("l_quantity") + F.col("l_tax"))
    a = pr.correlation_alerts(li, ["l_quantity", "l_extendedprice", "l_discount", "twice"])
    return a.withColumn("value", rh("value", 6))


@query("pr_alerts", ops=("PR-05",), sql="""
WITH p AS (
  SELECT 'c_custkey' AS "column", count(c_custkey) AS cnt, count(DISTINCT c_custkey) AS dist,
         count(*) FILTER (WHERE c_custkey IS NULL) AS miss, count(*) FILTER (WHERE c_custkey = 0) AS zer FROM customer
  UNION ALL SELECT 'c_nationkey', count(c_nationkey), count(DISTINCT c_nationkey),
         count(*) FILTER (WHERE c_nationkey IS NULL), count(*) FILTER (WHERE c_nationkey = 0) FROM customer
  UNION ALL SELECT 'c_mktsegment', count(c_mktsegment), count(DISTINCT c_mktsegment),
         count(*) FILTER (WHERE c_mktsegment IS NULL), NULL FROM customer
  UNION ALL SELECT 'c_name', count(c_name), count(DISTINCT c_name),
         count(*) FILTER (WHERE c_name IS NULL), NULL FROM customer),
n AS (SELECT count(*) AS rows_ FROM customer)
SELECT "column", 'constant' AS alert, CAST(dist AS DOUBLE) AS value FROM p WHERE dist = 1
UNION ALL SELECT "column", 'high_cardinality', dist / cnt FROM p WHERE dist / nullif(cnt, 0) > 0.9
UNION ALL SELECT "column", 'missing', miss / rows_ FROM p, n WHERE miss / rows_ > 0.05
UNION ALL SELECT "column", 'zeros', zer / rows_ FROM p, n WHERE zer / rows_ > 0.10
""")
def pr_alerts(spark, d):
    c = read(spark, d, "customer")
    cols = ["c_custkey", "c_nationkey", "c_mktsegment", "c_name"]
    return pr.alerts(pr.profile(c, cols, exact_distinct=True), skew=None)


@query("pr_compare_groups", ops=("PR-06",), sql=f"""
WITH a AS (SELECT count(o_totalprice) c, min(o_totalprice) mi, max(o_totalprice) ma, avg(o_totalprice) me
           FROM orders WHERE o_orderstatus = 'F'),
b AS (SELECT count(o_totalprice) c, min(o_totalprice) mi, max(o_totalprice) ma, avg(o_totalprice) me
      FROM orders WHERE o_orderstatus = 'O')
SELECT 'count' AS metric, CAST(a.c AS DOUBLE) AS value_a, CAST(b.c AS DOUBLE) AS value_b,
       CAST(b.c - a.c AS DOUBLE) AS difference FROM a, b
UNION ALL SELECT 'min', a.mi, b.mi, {rnd("b.mi - a.mi", 4)} FROM a, b
UNION ALL SELECT 'max', a.ma, b.ma, {rnd("b.ma - a.ma", 4)} FROM a, b
UNION ALL SELECT 'mean', {rnd("a.me", 4)}, {rnd("b.me", 4)}, {rnd("b.me - a.me", 4)} FROM a, b
""")
def pr_compare_groups(spark, d):
    cmp = pr.compare_groups(read(spark, d, "orders"), "o_orderstatus", "F", "O", ["o_totalprice"])
    return (cmp.where(F.col("metric").isin("count", "min", "max", "mean"))
            .select("metric",
                    F.when(F.col("metric") == "mean", rh("value_a", 4)).otherwise(F.col("value_a")).alias("value_a"),
                    F.when(F.col("metric") == "mean", rh("value_b", 4)).otherwise(F.col("value_b")).alias("value_b"),
                    F.when(F.col("metric") == "count", F.col("difference"))
                    .otherwise(rh("difference", 4)).alias("difference")))


@query("pr_profile_query", ops=("PR-07", "SRC-05"), sql=f"""
WITH q AS (SELECT o_orderpriority, sum(l_extendedprice * (1 - l_discount)) AS revenue
           FROM lineitem JOIN orders ON l_orderkey = o_orderkey GROUP BY o_orderkey, o_orderpriority)
SELECT 'revenue' AS "column", 'count' AS metric, CAST(count(revenue) AS DOUBLE) AS value FROM q
UNION ALL SELECT 'revenue', 'mean', {rnd("avg(revenue)", 4)} FROM q
UNION ALL SELECT 'revenue', 'max', {rnd("max(revenue)", 4)} FROM q
UNION ALL SELECT 'revenue', 'p50', {rnd("quantile_disc(revenue, 0.5)", 4)} FROM q
""")
def pr_profile_query(spark, d):
    # the source is a query (here a Spark SQL statement over the tables; a
    # JDBC source reads the same way through sources.files.read_jdbc)
    q = production(spark, d).groupBy("o_orderkey", "o_orderpriority").agg(
        F.sum(F.col("l_extendedprice") * (1 - F.col("l_discount"))).alias("revenue"))
    p = pr.profile(q.select("revenue"), ["revenue"], quantiles=[0.5], exact_distinct=True)
    return p.where(F.col("metric").isin("count", "mean", "max", "p50")).select(
        "column", "metric", F.when(F.col("metric") == "count", F.col("value"))
        .otherwise(rh("value", 4)).alias("value"))


@query("pr_iqr_outliers", ops=("PR-08",), sql="""
WITH q AS (SELECT quantile_disc(o_totalprice, 0.25) q1, quantile_disc(o_totalprice, 0.75) q3 FROM orders)
SELECT o_orderkey, o_totalprice FROM orders, q
WHERE o_totalprice < q1 - 1.5 * (q3 - q1) OR o_totalprice > q3 + 1.5 * (q3 - q1)
""")
def pr_iqr_outliers(spark, d):
    return pr.iqr_outliers(read(spark, d, "orders"), "o_totalprice").select("o_orderkey", "o_totalprice")

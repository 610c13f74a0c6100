"""Registered document queries (JSON / XML / modelling patterns).

Documents are derived from the given tables by Spark itself (``to_json`` of
structs, XML text built from columns), so every query's work grows with the
tables; the SQL oracles compute the same answers from the base columns.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from oreflow.functions.numeric import round_half_up as rh
from oreflow.operators import documents as doc
from oreflow.plans.q_timeseries import KEYS, R
from oreflow.plans.registry import query
from oreflow.plans.sqlfmt import rnd
from oreflow.sources.tables import read, sensor_readings


def customer_docs(spark, d):
    """Customer passports as JSON text: nested nation object, an optional
    ``flag`` key (absent, not null, when there is no debt) and a tag array."""
    c = read(spark, d, "customer")
    n = read(spark, d, "nation")  # 25 rows
    j = c.join(F.broadcast(n), c.c_nationkey == n.n_nationkey)
    tags = F.when(F.col("c_acctbal") > 9000, F.array(F.lit("vip"), F.lit("gold"))).otherwise(
        F.array(F.lit("std")))
    body = F.struct(F.col("c_custkey").alias("id"), F.col("c_mktsegment").alias("type"),
                    F.struct(F.col("c_nationkey").alias("key"), F.col("n_name").alias("name")).alias("nation"),
                    F.when(F.col("c_acctbal") < 0, F.lit("debt")).alias("flag"),
                    tags.alias("tags"))
    return j.select("c_custkey", F.to_json(body).alias("doc"))


def order_docs(spark, d):
    """Order documents with the array of their lines (bounded per order)."""
    li = read(spark, d, "lineitem")
    lines = li.groupBy("l_orderkey").agg(F.array_sort(F.collect_list(F.struct(
        F.col("l_linenumber").alias("line"), F.col("l_quantity").alias("qty"),
        F.col("l_returnflag").alias("flag")))).alias("lines"))
    return lines.select(F.col("l_orderkey").alias("order_id"),
                        F.to_json(F.struct(F.col("l_orderkey").alias("id"), "lines")).alias("doc"))


@query("doc_json_path_extract", ops=("DOC-01", "SRC-03", "SF-11"), sql="""
SELECT event_id AS reading_id, CAST(json_extract(props, '$.k') AS INTEGER) AS k_int,
       json_extract_string(props, '$.k') AS k_text,
       json_extract_string(props, '$.missing') AS missing
FROM events
""")
def doc_json_path_extract(spark, d):
    e = read(spark, d, "events")
    v = doc.parse("props")
    return e.select(F.col("event_id").alias("reading_id"), doc.path(v, "$.k", "int").alias("k_int"),
                    F.get_json_object("props", "$.k").alias("k_text"),
                    doc.path(v, "$.missing", "string").alias("missing"))


@query("doc_containment", ops=("DOC-02",), sql="""
SELECT c_custkey FROM customer
WHERE c_mktsegment = 'BUILDING' AND c_nationkey = 3 AND c_acctbal > 9000
""")
def doc_containment(spark, d):
    docs = customer_docs(spark, d)
    pat = {"type": "BUILDING", "nation": {"key": 3}, "tags": ["vip"]}
    return docs.where(doc.contains(doc.parse("doc"), pat)).select("c_custkey")


@query("doc_key_exists", ops=("DOC-03",), sql="""
SELECT c_mktsegment AS type, count(*) FILTER (WHERE c_acctbal < 0) AS n_flagged,
       count(*) FILTER (WHERE c_acctbal > 9000) AS n_vip, count(*) AS n
FROM customer GROUP BY c_mktsegment
""")
def doc_key_exists(spark, d):
    docs = customer_docs(spark, d)
    v = doc.parse("doc")
    return docs.groupBy(doc.path(v, "$.type").alias("type")).agg(
        F.count_if(doc.has_key("doc", "flag")).alias("n_flagged"),
        F.count_if(doc.array_has(v, "$.tags", "vip")).alias("n_vip"),
        F.count(F.lit(1)).alias("n"))


@query("doc_array_functions", ops=("DOC-04", "DOC-05", "DOC-06"), sql="""
SELECT l_orderkey AS order_id, count(*) AS n_lines,
       count(*) FILTER (WHERE l_quantity > 40) AS n_big,
       bool_or(l_returnflag = 'R') AS any_returned,
       min(l_linenumber) FILTER (WHERE l_returnflag = 'R') AS first_returned_line
FROM lineitem GROUP BY l_orderkey
""")
def doc_array_functions(spark, d):
    docs = order_docs(spark, d)
    v = doc.parse("doc")
    lines = doc.array_elements(v, "$.lines", "struct<line:int,qty:double,flag:string>")
    ret = F.filter(lines, lambda x: x["flag"] == "R")
    return docs.select(
        "order_id", F.json_array_length(F.get_json_object("doc", "$.lines")).cast("bigint").alias("n_lines"),
        F.size(F.filter(lines, lambda x: x["qty"] > 40)).cast("bigint").alias("n_big"),
        F.exists(lines, lambda x: x["flag"] == "R").alias("any_returned"),
        F.try_element_at(ret, F.lit(1))["line"].alias("first_returned_line"))


@query("doc_unnest_lines", ops=("DOC-04", "JN-18"), sql="""
SELECT l_orderkey AS order_id, l_linenumber AS line, l_quantity AS qty FROM lineitem WHERE l_quantity > 48
""")
def doc_unnest_lines(spark, d):
    docs = order_docs(spark, d)
    lines = doc.array_elements(doc.parse("doc"), "$.lines", "struct<line:int,qty:double,flag:string>")
    return (docs.select("order_id", F.explode(lines).alias("l"))
            .where(F.col("l.qty") > 48).select("order_id", "l.line", "l.qty"))


@query("doc_modify_fields", ops=("DOC-07",), sql="""
SELECT c_custkey AS id, upper(n.n_name) || '!' AS nation_name, 'id,type,nation,tags,region' AS keys,
       CASE WHEN c_acctbal > 9000 THEN 3 ELSE 2 END AS n_tags
FROM customer JOIN nation n ON n.n_nationkey = c_nationkey
""")
def doc_modify_fields(spark, d):
    docs = customer_docs(spark, d)
    schema = ("id bigint, type string, nation struct<key:int,name:string>, flag string, "
              "tags array<string>")
    s = F.from_json("doc", schema)
    changed = (s.withField("nation.name", F.concat(F.upper(s["nation"]["name"]), F.lit("!")))  # jsonb_set
               .dropFields("flag")                                                             # - 'flag'
               .withField("tags", F.array_append(s["tags"], F.lit("checked")))                 # arr || x
               .withField("region", F.lit("unknown")))                                         # || object
    out = docs.select(F.to_json(changed).alias("doc2"))
    v = doc.parse("doc2")
    return out.select(doc.path(v, "$.id", "bigint").alias("id"),
                      doc.path(v, "$.nation.name").alias("nation_name"),
                      F.array_join(F.json_object_keys("doc2"), ",").alias("keys"),
                      F.json_array_length(F.get_json_object("doc2", "$.tags")).alias("n_tags"))


@query("doc_build_object", ops=("DOC-08",), sql="""
SELECT s_suppkey, CAST(json_object('id', s_suppkey, 'name', s_name, 'nation', s_nationkey) AS VARCHAR) AS doc
FROM supplier
""")
def doc_build_object(spark, d):
    s = read(spark, d, "supplier")
    return s.select("s_suppkey", F.to_json(F.struct(F.col("s_suppkey").alias("id"), F.col("s_name").alias("name"),
                                                    F.col("s_nationkey").alias("nation"))).alias("doc"))


def supplier_xml(spark, d):
    s = read(spark, d, "supplier")
    xml = F.concat(
        F.lit('<equipment xmlns="urn:plant" id="'), F.col("s_suppkey").cast("string"), F.lit('">'),
        F.lit("<name>"), F.col("s_name"), F.lit("</name>"),
        F.lit('<mine code="M'), F.col("s_nationkey").cast("string"), F.lit('"/>'),
        F.lit('<specifications><payload unit="t">'), F.col("s_acctbal").cast("string"),
        F.lit("</payload></specifications></equipment>"))
    return s.select("s_suppkey", xml.alias("xml"))


@query("doc_xpath_extract", ops=("DOC-09", "SRC-04", "G19"), sql="""
SELECT CAST(s_suppkey AS VARCHAR) AS id, s_name AS name, 'M' || CAST(s_nationkey AS VARCHAR) AS mine_code,
       s_acctbal AS payload
FROM supplier WHERE s_acctbal > 5000
""")
def doc_xpath_extract(spark, d):
    x = supplier_xml(spark, d)
    out = x.select(doc.xpath_text("xml", "/equipment/@id").alias("id"),
                   doc.xpath_text("xml", "//name").alias("name"),
                   doc.xpath_text("xml", "//mine/@code").alias("mine_code"),
                   doc.xpath_number("xml", "//specifications/payload").alias("payload"))
    return out.where(F.col("payload") > 5000)


@query("doc_page_titles", ops=("DOC-09", "SRC-04"), sql="""
SELECT page_id, replace(regexp_extract(html, '<title>(.*?)</title>', 1), '&amp;', '&') AS title
FROM pages
""")
def doc_page_titles(spark, d):
    p = read(spark, d, "pages")
    # the pages are HTML, not XML: cut the title out first, then let the XML
    # reader decode it
    return p.select("page_id", F.coalesce(doc.title_text(F.regexp_extract("html", r"<title>([^\n]*?)</title>", 1)), F.lit("")).alias("title"))


@query("doc_polymorphic_read", ops=("DOC-10", "PF-02"), sql="""
SELECT event_id AS reading_id, event_type AS type, ts,
       CASE WHEN event_type = 'purchase' THEN value END AS amount,
       CASE WHEN event_type = 'error' THEN CASE WHEN value > 100 THEN 'critical' ELSE 'warning' END END AS severity,
       CASE WHEN event_type IN ('click', 'view') THEN CAST(json_extract(props, '$.k') AS INTEGER) END AS target
FROM events
""")
def doc_polymorphic_read(spark, d):
    e = read(spark, d, "events")
    t = F.col("event_type")
    return e.select(
        F.col("event_id").alias("reading_id"), t.alias("type"), "ts",
        F.when(t == "purchase", F.col("value")).alias("amount"),
        F.when(t == "error", F.when(F.col("value") > 100, "critical").otherwise("warning")).alias("severity"),
        F.when(t.isin("click", "view"), doc.path(doc.parse("props"), "$.k", "int")).alias("target"))


@query("doc_extended_reference", ops=("DOC-11", "SNK-05"), sql="""
SELECT CASE WHEN n.n_name = 'NATION_3' THEN 'NATION_3 (renamed)' ELSE n.n_name END AS nation_name,
       count(*) AS n_docs, count(*) FILTER (WHERE n.n_name = 'NATION_3') AS n_affected
FROM customer c JOIN nation n ON n.n_nationkey = c.c_nationkey GROUP BY 1
""")
def doc_extended_reference(spark, d):
    docs = customer_docs(spark, d)
    s = docs.select(F.from_json("doc", "id bigint, nation struct<key:int,name:string>").alias("s"))
    hit = F.col("s.nation.name") == "NATION_3"
    # propagate the parent rename into every embedded copy (updateMany)
    upd = s.select(F.when(hit, F.col("s").withField("nation.name", F.lit("NATION_3 (renamed)")))
                   .otherwise(F.col("s")).alias("s"), hit.alias("affected"))
    return upd.groupBy(F.col("s.nation.name").alias("nation_name")).agg(
        F.count(F.lit(1)).alias("n_docs"), F.count_if("affected").alias("n_affected"))


@query("doc_bucket_fold", ops=("DOC-12",), sql=f"""
WITH r AS (SELECT *, time_bucket(INTERVAL '1 day', ts) AS bucket_start FROM {R}),
n AS (SELECT *, (row_number() OVER (PARTITION BY equipment_id, sensor_type, bucket_start
                                    ORDER BY ts, reading_id) - 1) // 4 AS bucket_no FROM r)
SELECT equipment_id, sensor_type, bucket_start, CAST(bucket_no AS INTEGER) AS bucket_no,
       count(*) AS count, min(value) AS min_value, max(value) AS max_value,
       {rnd("sum(value)", 2)} AS sum_value, CAST(count(*) AS INTEGER) AS n_stored
FROM n GROUP BY ALL
""")
def doc_bucket_fold(spark, d):
    r = sensor_readings(spark, d)
    reading = F.struct(F.col("ts"), F.col("reading_id"), F.col("value"))
    b = doc.bucket_fold(r, KEYS, "ts", "1 day", cap=4, reading=reading, value="value")
    return b.select(*KEYS, "bucket_start", "bucket_no", "count", "min_value", "max_value",
                    rh("sum_value", 2).alias("sum_value"), F.size("readings").alias("n_stored"))


@query("doc_bucket_rollup", ops=("DOC-13", "AG-13"), sql=f"""
WITH r AS (SELECT *, time_bucket(INTERVAL '1 day', ts) AS b,
                  (row_number() OVER (PARTITION BY equipment_id, sensor_type, time_bucket(INTERVAL '1 day', ts)
                                      ORDER BY ts, reading_id) - 1) // 4 AS bn FROM {R})
SELECT equipment_id, sensor_type, count(*) AS n, min(value) AS min_value, max(value) AS max_value,
       {rnd("avg(value)", 4)} AS avg_value, count(DISTINCT (b, bn)) AS n_buckets,
       count(*) AS n_unfolded
FROM r GROUP BY ALL
""")
def doc_bucket_rollup(spark, d):
    r = sensor_readings(spark, d)
    reading = F.struct(F.col("ts"), F.col("reading_id"), F.col("value"))
    b = doc.bucket_fold(r, KEYS, "ts", "1 day", cap=4, reading=reading, value="value")
    roll = doc.bucket_rollup(b, KEYS)
    unfolded = doc.bucket_unfold(b, KEYS).groupBy(*KEYS).agg(F.count(F.lit(1)).alias("n_unfolded"))
    return roll.join(unfolded, KEYS).select(
        *KEYS, "n", "min_value", "max_value", rh("avg_value", 4).alias("avg_value"), "n_buckets",
        "n_unfolded")


@query("doc_computed_totals", ops=("DOC-14",), sql=f"""
SELECT o_custkey, o_orderpriority, {rnd("sum(o_totalprice)", 2)} AS total, count(*) AS n_orders,
       max(o_totalprice) AS max_order
FROM orders GROUP BY ALL
""")
def doc_computed_totals(spark, d):
    # batch form of the computed pattern ($inc/$max upserts): one aggregate
    o = read(spark, d, "orders")
    return o.groupBy("o_custkey", "o_orderpriority").agg(
        rh(F.sum("o_totalprice"), 2).alias("total"), F.count(F.lit(1)).alias("n_orders"),
        F.max("o_totalprice").alias("max_order"))


@query("doc_attribute_pattern", ops=("DOC-15", "PF-15"), sql="""
SELECT l_orderkey, l_linenumber, l_discount AS discount, l_tax AS tax FROM lineitem WHERE l_quantity > 45
""")
def doc_attribute_pattern(spark, d):
    li = read(spark, d, "lineitem")
    a = doc.attribute_array(li, ["l_orderkey", "l_linenumber"],
                            {"quantity": F.col("l_quantity"), "discount": F.col("l_discount"),
                             "tax": F.col("l_tax")}, {"quantity": "t"})
    hit = a.where(doc.attribute_match("metrics", "quantity", lambda v: v > 45))
    m = doc.attribute_pivot(hit, ["l_orderkey", "l_linenumber"])
    return m.select("l_orderkey", "l_linenumber", F.col("attrs")["discount"].alias("discount"),
                    F.col("attrs")["tax"].alias("tax"))


@query("doc_subset_pattern", ops=("DOC-16", "OL-06"), sql="""
WITH r AS (SELECT o_custkey, o_orderkey,
                  row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) AS rn
           FROM orders)
SELECT c.c_custkey, count(r.o_orderkey) AS n_children,
       max(CASE WHEN rn = 1 THEN r.o_orderkey END) AS newest_order,
       CAST(count(*) FILTER (WHERE rn <= 3) AS INTEGER) AS n_embedded
FROM customer c LEFT JOIN r ON r.o_custkey = c.c_custkey GROUP BY c.c_custkey
""")
def doc_subset_pattern(spark, d):
    c = read(spark, d, "customer").select("c_custkey")
    o = read(spark, d, "orders")
    s = doc.subset_pattern(c, o, "c_custkey", "o_custkey",
                           [F.col("o_orderdate").desc(), F.col("o_orderkey").desc()], 3,
                           ["o_orderkey", "o_orderdate"])
    return s.select("c_custkey", "n_children",
                    F.try_element_at("recent", F.lit(1))["o_orderkey"].alias("newest_order"),
                    F.coalesce(F.size("recent"), F.lit(0)).alias("n_embedded"))


@query("doc_schema_versions", ops=("DOC-17", "UD-03"), sql="""
SELECT s_suppkey, s_acctbal / 100.0 AS lat, CAST(s_nationkey AS DOUBLE) AS lon, s_name AS level
FROM supplier
""")
def doc_schema_versions(spark, d):
    s = read(spark, d, "supplier")
    lat, lon = F.col("s_acctbal") / 100.0, F.col("s_nationkey").cast("double")
    v1 = F.to_json(F.struct(F.lit(1).alias("schema_version"), lat.alias("latitude"),
                            lon.alias("longitude"), F.col("s_name").alias("level")))
    v2 = F.to_json(F.struct(F.lit(2).alias("schema_version"),
                            F.struct(F.array(lon, lat).alias("coordinates")).alias("location"),
                            F.col("s_name").alias("level")))
    docs = s.select("s_suppkey", F.when(F.col("s_suppkey") % 2 == 0, v1).otherwise(v2).alias("doc"))
    u = docs.select("s_suppkey", doc.unify_versions(doc.parse("doc")).alias("loc"))
    return u.select("s_suppkey", "loc.lat", "loc.lon", "loc.level")

"""Registered business reports and sink transformations.

The sink queries write tables below the shared scratch folder through the
sinks and return what a read of them gives; the reports compose the operators
on the test bindings.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from oreflow.functions.classify import quality_flag
from oreflow.functions.numeric import round_half_up as rh
from oreflow.functions.timefn import minutes_between, trunc
from oreflow.operators import documents as doc
from oreflow.operators import joins
from oreflow.operators import normalize as nz
from oreflow.operators import vectors as vx
from oreflow.plans.q_documents import customer_docs
from oreflow.plans.q_timeseries import KEYS, QF, R
from oreflow.plans.q_warehouse import CUT, _cut, latest_priority, priority_changes
from oreflow.plans.registry import query
from oreflow.plans.sqlfmt import rnd
from oreflow.session import scratch_path
from oreflow.sinks import writers as w
from oreflow.sources.tables import production, read, sensor_readings


# ------------------------------------------------------------ sink contents
@query("snk_merge_latest", ops=("SNK-04",), sql="""
SELECT o_custkey AS c_custkey, arg_max(o_orderpriority, {'d': o_orderdate, 'k': o_orderkey}) AS priority
FROM orders GROUP BY o_custkey
""")
def snk_merge_latest(spark, d):
    ch = priority_changes(spark, d).select("c_custkey", "priority", "change_ts", "change_seq")
    path, newest = scratch_path(spark, "snk-upsert"), F.struct("change_ts", "change_seq")
    w.upsert(spark, ch.where(F.col("change_ts") < _cut()), path, ["c_custkey"], newest)
    w.upsert(spark, ch.where(F.col("change_ts") >= _cut()), path, ["c_custkey"], newest)
    return w.table(spark, path).select("c_custkey", "priority")


@query("snk_upsert_moving_partition", ops=("SNK-04",), sql="""
SELECT priority, count(*) AS n, CAST(sum(k) AS BIGINT) AS sum_keys
FROM (SELECT o_custkey AS k, arg_max(o_orderpriority, {'d': o_orderdate, 'k': o_orderkey}) AS priority
      FROM orders GROUP BY o_custkey) GROUP BY priority
""")
def snk_upsert_moving_partition(spark, d):
    """A key whose partition column changes leaves its old partition."""
    ch = priority_changes(spark, d).select("c_custkey", "priority", "change_ts", "change_seq")
    path, newest = scratch_path(spark, "snk-upsert-part"), F.struct("change_ts", "change_seq")
    for part in (ch.where(F.col("change_ts") < _cut()), ch.where(F.col("change_ts") >= _cut())):
        w.upsert(spark, part, path, ["c_custkey"], newest, partition_by=["priority"])
    return w.table(spark, path).groupBy("priority").agg(
        F.count(F.lit(1)).alias("n"), F.sum("c_custkey").alias("sum_keys"))


@query("snk_load_append_update", ops=("SNK-01", "SNK-02", "SNK-05"), sql=f"""
SELECT o_orderstatus, o_orderpriority, CASE WHEN o_totalprice > 200000 THEN 'large' END AS size_class, count(*) AS n
FROM (SELECT * REPLACE (CASE WHEN o_orderstatus = 'P' THEN 'OPEN' ELSE o_orderstatus END AS o_orderstatus) FROM orders)
GROUP BY ALL
""")
def snk_load_append_update(spark, d):
    """Truncate-and-load (twice: the second load replaces the first), append, update in place."""
    o = read(spark, d, "orders").select("o_orderkey", "o_orderdate", "o_orderstatus", "o_orderpriority", "o_totalprice")
    path = scratch_path(spark, "snk-load")
    w.overwrite(o, path)
    w.overwrite(o.where(F.col("o_orderdate") < _cut()), path)
    w.append(o.where(F.col("o_orderdate") >= _cut()), path)
    w.append(o.where(F.col("o_orderdate").isNull()), path)
    w.update_table(spark, path, {"o_orderstatus": F.lit("OPEN")}, F.col("o_orderstatus") == "P")
    w.update_table(spark, path, {"size_class": F.lit("large")}, F.col("o_totalprice") > 200000)
    return w.table(spark, path).groupBy("o_orderstatus", "o_orderpriority", "size_class").agg(
        F.count(F.lit(1)).alias("n"))


@query("snk_delete_where", ops=("SNK-06",), sql="""
SELECT o_orderstatus, o_orderpriority, count(*) AS n FROM orders
WHERE NOT (o_orderstatus = 'P' AND o_orderpriority = '5-LOW') GROUP BY ALL
""")
def snk_delete_where(spark, d):
    path = scratch_path(spark, "snk-delete")
    w.overwrite(read(spark, d, "orders"), path)
    w.delete_where(spark, path, (F.col("o_orderstatus") == "P") & (F.col("o_orderpriority") == "5-LOW"))
    return w.table(spark, path).groupBy("o_orderstatus", "o_orderpriority").agg(F.count(F.lit(1)).alias("n"))


@query("snk_time_chunks", ops=("SNK-07",), sql="""
SELECT 'month' AS chunk_type, strftime(l_shipdate, '%Y-%m') AS chunk, count(*) AS n FROM lineitem GROUP BY 2
UNION ALL
SELECT '7 days', CAST(CAST(time_bucket(INTERVAL 7 DAY, l_shipdate, TIMESTAMP '1970-01-01') AS DATE) AS VARCHAR),
       count(*) FROM lineitem GROUP BY 2
""")
def snk_time_chunks(spark, d):
    li = read(spark, d, "lineitem")
    out = None
    for chunk in ("month", "7 days"):
        path = scratch_path(spark, "snk-chunks")
        w.write_time_partitioned(li.select("l_orderkey", "l_shipdate"), path, "l_shipdate", chunk)
        n = w.table(spark, path).groupBy(F.col("chunk").cast("string").alias("chunk")).agg(F.count(F.lit(1)).alias("n"))
        n = n.select(F.lit(chunk).alias("chunk_type"), "chunk", "n")
        out = n if out is None else out.unionByName(n)
    return out


@query("snk_refresh_window", ops=("SNK-08", "TS-17"), sql=f"""
WITH n AS (SELECT max(ts) AS now_ FROM events),
r AS (SELECT * FROM {R}, n
      WHERE ts >= date_trunc('day', now_ - INTERVAL 2 DAY) AND ts < now_ - INTERVAL 1 HOUR)
SELECT time_bucket(INTERVAL 1 HOUR, ts) AS bucket, sensor_type, count(*) AS n, {rnd("sum(value)")} AS sum_value,
       CAST(time_bucket(INTERVAL 1 HOUR, ts) AS DATE) AS day
FROM r GROUP BY ALL
""")
def snk_refresh_window(spark, d):
    r = sensor_readings(spark, d)
    now = r.select(F.max("ts")).scalar()
    roll = w.refresh_window_rollup(r, "ts", ["sensor_type"], "value", now, 2 * 86400, 3600)
    return roll.select("bucket", "sensor_type", "n", rh("sum_value").alias("sum_value"), "day")


@query("snk_retention_tiers", ops=("SNK-09",), sql=f"""
WITH c AS (SELECT max(ts) - INTERVAL 7 DAY AS cut FROM events),
old AS (SELECT time_bucket(INTERVAL 1 HOUR, ts) AS b, event_type FROM events, c WHERE ts < cut)
SELECT 'raw_kept' AS tier, count(*) AS n_rows FROM events, c WHERE ts >= cut
UNION ALL SELECT 'hourly_rollup', count(*) FROM (SELECT DISTINCT b, event_type FROM old)
""")
def snk_retention_tiers(spark, d):
    e = read(spark, d, "events")
    cut = e.agg((F.max("ts") - F.expr("INTERVAL 7 DAYS")).alias("c")).first()["c"]
    raw, roll = scratch_path(spark, "snk-raw"), scratch_path(spark, "snk-rollup")
    w.overwrite(e.where(F.col("ts").isNotNull()), raw)
    w.tiered_retention(spark, raw, roll, "ts", ["event_type"], "value", cut)
    w.tiered_retention(spark, raw, roll, "ts", ["event_type"], "value", cut)   # a repeat changes nothing
    from oreflow.operators.aggregates import count_report
    return count_report({"raw_kept": w.table(spark, raw), "hourly_rollup": w.table(spark, roll)}).select(
        F.col("table_name").alias("tier"), "n_rows")


# ------------------------------------------------------ predicates and joins
@query("pf_null_safe_change", ops=("PF-08",), sql=f"""
WITH b1 AS (SELECT o_custkey k, arg_max(o_orderpriority, {{'d': o_orderdate, 'k': o_orderkey}}) p
            FROM orders WHERE o_orderdate < TIMESTAMP '{CUT}' GROUP BY 1),
b2 AS (SELECT o_custkey k, arg_max(o_orderpriority, {{'d': o_orderdate, 'k': o_orderkey}}) p
       FROM orders WHERE o_orderdate >= TIMESTAMP '{CUT}' GROUP BY 1)
SELECT count(*) FILTER (WHERE b1.p IS DISTINCT FROM b2.p) AS n_changed,
       count(*) FILTER (WHERE b1.p IS NOT DISTINCT FROM b2.p) AS n_same
FROM b1 FULL OUTER JOIN b2 ON b1.k = b2.k
""")
def pf_null_safe_change(spark, d):
    b1 = latest_priority(spark, d, True).withColumnRenamed("priority", "p1")
    b2 = latest_priority(spark, d, False).withColumnRenamed("priority", "p2")
    j = b1.join(b2, "c_custkey", "full_outer")
    same = F.col("p1").eqNullSafe(F.col("p2"))
    return j.agg(F.count_if(~same).alias("n_changed"), F.count_if(same).alias("n_same"))


@query("jn_cross_values", ops=("JN-08", "JN-03"), sql=f"""
WITH v AS (SELECT r.r_name AS region, count(DISTINCT o.o_orderkey) AS orders_, count(*) AS lines_
           FROM lineitem l JOIN orders o ON o.o_orderkey = l.l_orderkey
           JOIN customer c ON c.c_custkey = o.o_custkey JOIN nation n ON n.n_nationkey = c.c_nationkey
           JOIN region r ON r.r_regionkey = n.n_regionkey GROUP BY 1),
grid AS (SELECT r_name AS region, m.metric FROM region CROSS JOIN (VALUES ('orders'), ('lines'), ('none')) m(metric))
SELECT g.region, g.metric, CAST(coalesce(CASE g.metric WHEN 'orders' THEN v.orders_ WHEN 'lines' THEN v.lines_ END, 0) AS BIGINT) AS value
FROM grid g LEFT JOIN v ON v.region = g.region
""")
def jn_cross_values(spark, d):
    # CROSS JOIN (VALUES ...) with a literal list is an explode of an array
    # literal: every region row is repeated per metric, no join
    r = read(spark, d, "region").select(F.col("r_name").alias("region"))
    grid = r.select("region", F.explode(F.array(F.lit("orders"), F.lit("lines"), F.lit("none"))).alias("metric"))
    p = production(spark, d)
    c = read(spark, d, "customer").select("c_custkey", "c_nationkey")
    n, rg = read(spark, d, "nation"), read(spark, d, "region")
    v = (p.join(c, p.o_custkey == c.c_custkey).join(F.broadcast(n), F.col("c_nationkey") == n.n_nationkey)
         .join(F.broadcast(rg), n.n_regionkey == rg.r_regionkey)
         .groupBy(F.col("r_name").alias("region"))
         .agg(F.count_distinct("o_orderkey").alias("orders_"), F.count(F.lit(1)).alias("lines_")))
    j = grid.join(v, "region", "left")
    val = F.when(F.col("metric") == "orders", F.col("orders_")).when(F.col("metric") == "lines", F.col("lines_"))
    return j.select("region", "metric", F.coalesce(val, F.lit(0)).cast("bigint").alias("value"))


WARN = "(value > 200 AND value <= 300)"


def _warn_alarm(spark, d, mode):
    r = sensor_readings(spark, d)
    is_warn = (F.col("value") > 200) & (F.col("value") <= 300)
    j = joins.first_event_before(r, KEYS, "ts", is_warn, F.col("value") > 300, mode=mode, out="warn_ts")
    return j.select("reading_id", *KEYS, "warn_ts", rh(minutes_between("warn_ts", "ts"), 3).alias("minutes"))


FIRST_WARN_SQL = f"""
WITH r AS {R},
fw AS (SELECT equipment_id, sensor_type, min(ts) AS warn_ts FROM r WHERE {WARN} GROUP BY ALL)
SELECT r.reading_id, r.equipment_id, r.sensor_type, fw.warn_ts,
       {rnd("date_diff('microsecond', fw.warn_ts, r.ts) / 60e6", 3)} AS minutes
FROM r JOIN fw USING (equipment_id, sensor_type) WHERE r.value > 300"""


@query("jn_first_warn_to_alarm", ops=("JN-12", "RP-07"), sql=FIRST_WARN_SQL)
def jn_first_warn_to_alarm(spark, d):
    return _warn_alarm(spark, d, "first_any")


@query("jn_first_warn_before_alarm", ops=("JN-12",), sql=FIRST_WARN_SQL + " AND fw.warn_ts <= r.ts")
def jn_first_warn_before_alarm(spark, d):
    return _warn_alarm(spark, d, "first_before")


@query("jn_latest_warn_asof", ops=("JN-12", "JN-21"), sql=f"""
WITH r AS {R}
SELECT a.reading_id, a.equipment_id, a.sensor_type, max(w.ts) AS warn_ts,
       {rnd("date_diff('microsecond', max(w.ts), a.ts) / 60e6", 3)} AS minutes
FROM r a JOIN r w ON w.equipment_id = a.equipment_id AND w.sensor_type = a.sensor_type
 AND w.ts <= a.ts AND w.value > 200 AND w.value <= 300
WHERE a.value > 300 GROUP BY a.reading_id, a.equipment_id, a.sensor_type, a.ts
""")
def jn_latest_warn_asof(spark, d):
    return _warn_alarm(spark, d, "latest_before")


@query("norm_schema_evolution", ops=("NORM-04",), sql="""
SELECT count(*) * 2 AS n_rows, count(*) AS n_missing_segment_code, count(*) AS n_missing_segment FROM customer
""")
def norm_schema_evolution(spark, d):
    c = read(spark, d, "customer")
    v1 = c.drop("c_mktsegment")                                       # old table version
    v2 = c.withColumn("segment_code", F.substring("c_mktsegment", 1, 3))  # new version adds a column
    # re-running the migration is a no-op: the column is already there
    v2 = nz.ensure_column(nz.ensure_column(v2, "segment_code", "string"), "segment_code", "string")
    v2 = nz.drop_column_if_present(nz.drop_column_if_present(v2, "c_acctbal"), "c_acctbal")
    u = nz.align_schemas(v1, v2)
    return u.agg(F.count(F.lit(1)).alias("n_rows"),
                 F.count_if(F.col("segment_code").isNull()).alias("n_missing_segment_code"),
                 F.count_if(F.col("c_mktsegment").isNull()).alias("n_missing_segment"))


@query("vec_upsert_ttl", ops=("VEC-11", "SNK-04", "SNK-09"), sql="""
SELECT CASE WHEN label <= 2 THEN 2 ELSE 1 END AS version, count(*) AS n_upserted,
       count(*) FILTER (WHERE label <= 2) AS n_after_ttl
FROM embeddings GROUP BY 1
""")
def vec_upsert_ttl(spark, d):
    e = read(spark, d, "embeddings")
    v1 = e.select("vec_id", "embedding", "label", F.lit(1).alias("version"),
                  F.lit("2024-01-01 00:00:00").cast("timestamp_ntz").alias("loaded_at"))
    # a re-embedding batch (unit-length vectors) for labels 0..2
    v2 = e.where(F.col("label") <= 2).select("vec_id", vx.normalise("embedding").cast("array<float>").alias("embedding"),
                                             "label", F.lit(2).alias("version"),
                                             F.lit("2024-02-01 00:00:00").cast("timestamp_ntz").alias("loaded_at"))
    up = w.merge_latest(v1, v2, ["vec_id"], F.col("version"))
    ttl_from = F.lit("2024-02-20 00:00:00").cast("timestamp_ntz") - F.expr("INTERVAL 30 DAYS")
    kept = up.withColumn("alive", F.col("loaded_at") >= ttl_from)
    return kept.groupBy("version").agg(F.count(F.lit(1)).alias("n_upserted"), F.count_if("alive").alias("n_after_ttl"))


# ------------------------------------------------------------------ reports
@query("rp_balance_by_nation", ops=("RP-02", "AG-01", "UD-06"), sql=f"""
SELECT s_nationkey, count(*) AS n_suppliers, {rnd("avg(s_acctbal)")} AS avg_balance, max(s_acctbal) AS max_balance
FROM supplier WHERE s_acctbal > 0 GROUP BY s_nationkey
""")
def rp_balance_by_nation(spark, d):
    # zero and negative balances are left out of the averages, as zero
    # engine hours are in the reference report
    s = read(spark, d, "supplier").where(F.col("s_acctbal") > 0)
    return s.groupBy("s_nationkey").agg(F.count(F.lit(1)).alias("n_suppliers"),
                                        rh(F.avg("s_acctbal")).alias("avg_balance"),
                                        F.max("s_acctbal").alias("max_balance"))


@query("rp_readings_by_type_and_flag", ops=("RP-03", "AG-01", "SF-14"), sql=f"""
SELECT sensor_type, {QF} AS quality, count(*) AS n, {rnd("avg(value)")} AS avg_value FROM {R} GROUP BY ALL
""")
def rp_readings_by_type_and_flag(spark, d):
    r = sensor_readings(spark, d)
    return r.groupBy("sensor_type", quality_flag("value").alias("quality")).agg(
        F.count(F.lit(1)).alias("n"), rh(F.avg("value")).alias("avg_value"))


@query("rp_alarm_readings", ops=("RP-04", "JN-01"), sql=f"""
SELECT r.reading_id, r.ts, r.sensor_type, r.value, c.c_name AS equipment_name, c.c_nationkey AS mine_key
FROM {R} r JOIN customer c ON c.c_custkey = r.equipment_id WHERE r.value > 300
""")
def rp_alarm_readings(spark, d):
    r = sensor_readings(spark, d).where(F.col("value") > 300)
    c = read(spark, d, "customer").select("c_custkey", "c_name", "c_nationkey")
    j = r.join(c, r.equipment_id == c.c_custkey)
    return j.select("reading_id", "ts", "sensor_type", "value", F.col("c_name").alias("equipment_name"),
                    F.col("c_nationkey").alias("mine_key"))


@query("rp_downtime_top_equipment", ops=("RP-06", "AG-05", "OL-04"), sql=f"""
SELECT equipment_id, count(*) AS n_events, {rnd("sum(value)")} AS minutes,
       string_agg(DISTINCT CASE WHEN value > 100 THEN 'major' ELSE 'minor' END, ', '
                  ORDER BY CASE WHEN value > 100 THEN 'major' ELSE 'minor' END) AS categories
FROM {R} WHERE sensor_type = 'error' GROUP BY equipment_id
ORDER BY sum(value) DESC, equipment_id LIMIT 10
""")
def rp_downtime_top_equipment(spark, d):
    r = sensor_readings(spark, d).where(F.col("sensor_type") == "error").withColumn(
        "category", F.when(F.col("value") > 100, "major").otherwise("minor"))
    g = r.groupBy("equipment_id").agg(
        F.count(F.lit(1)).alias("n_events"), F.sum("value").alias("m"),
        F.expr("listagg(DISTINCT category, ', ') WITHIN GROUP (ORDER BY category)").alias("categories"))
    return (g.orderBy(F.col("m").desc(), "equipment_id").limit(10)
            .select("equipment_id", "n_events", rh("m").alias("minutes"), "categories"))


@query("rp_fleet_by_mine_and_type", ops=("RP-09", "JN-02"), sql="""
SELECT r.r_name AS mine, n.n_name AS equipment_type, count(DISTINCT c.c_custkey) AS n_equipment,
       count(DISTINCT s.s_suppkey) AS n_operators
FROM nation n JOIN region r ON r.r_regionkey = n.n_regionkey
LEFT JOIN customer c ON c.c_nationkey = n.n_nationkey LEFT JOIN supplier s ON s.s_nationkey = n.n_nationkey
GROUP BY ALL
""")
def rp_fleet_by_mine_and_type(spark, d):
    n, r = read(spark, d, "nation"), read(spark, d, "region")
    # pre-aggregate each side before joining: no customer x supplier fan-out
    c = read(spark, d, "customer").groupBy("c_nationkey").agg(F.count_distinct("c_custkey").alias("n_equipment"))
    s = read(spark, d, "supplier").groupBy("s_nationkey").agg(F.count_distinct("s_suppkey").alias("n_operators"))
    j = (n.join(r, n.n_regionkey == r.r_regionkey).join(c, n.n_nationkey == c.c_nationkey, "left")
         .join(s, n.n_nationkey == s.s_nationkey, "left"))
    return j.select(F.col("r_name").alias("mine"), F.col("n_name").alias("equipment_type"),
                    F.coalesce("n_equipment", F.lit(0)).cast("bigint").alias("n_equipment"),
                    F.coalesce("n_operators", F.lit(0)).cast("bigint").alias("n_operators"))


@query("rp_supplier_reliability", ops=("RP-11", "OL-04", "SF-10"), sql=f"""
SELECT l_suppkey, count(*) AS n_lines, count(DISTINCT l_partkey) AS n_parts,
       {rnd("count(*) FILTER (WHERE l_returnflag = 'R') * 100.0 / count(*)", 3)} AS return_pct
FROM lineitem GROUP BY l_suppkey
ORDER BY count(*) FILTER (WHERE l_returnflag = 'R') * 100.0 / count(*), l_suppkey LIMIT 10
""")
def rp_supplier_reliability(spark, d):
    li = read(spark, d, "lineitem")
    g = li.groupBy("l_suppkey").agg(F.count(F.lit(1)).alias("n_lines"), F.count_distinct("l_partkey").alias("n_parts"),
                                    (F.count_if(F.col("l_returnflag") == "R") * 100.0 / F.count(F.lit(1))).alias("p"))
    return g.orderBy("p", "l_suppkey").limit(10).select("l_suppkey", "n_lines", "n_parts",
                                                        rh("p", 3).alias("return_pct"))


@query("rp_incident_analytics", ops=("RP-13", "PF-14", "SF-10"), sql=f"""
SELECT r.r_name AS mine, o.o_orderpriority AS severity, count(*) AS n_incidents,
       {rnd("sum(o.o_totalprice)", 2)} AS total_cost, {rnd("sum(o.o_totalprice) / nullif(count(*), 0)", 2)} AS cost_per_incident
FROM orders o JOIN customer c ON c.c_custkey = o.o_custkey JOIN nation n ON n.n_nationkey = c.c_nationkey
JOIN region r ON r.r_regionkey = n.n_regionkey GROUP BY ALL
""")
def rp_incident_analytics(spark, d):
    o = read(spark, d, "orders")
    c = read(spark, d, "customer").select("c_custkey", "c_nationkey")
    n, r = read(spark, d, "nation"), read(spark, d, "region")
    j = (o.join(c, o.o_custkey == c.c_custkey).join(F.broadcast(n), F.col("c_nationkey") == n.n_nationkey)
         .join(F.broadcast(r), n.n_regionkey == r.r_regionkey))
    g = j.groupBy(F.col("r_name").alias("mine"), F.col("o_orderpriority").alias("severity")).agg(
        F.count(F.lit(1)).alias("n_incidents"), F.sum("o_totalprice").alias("cost"))
    return g.select("mine", "severity", "n_incidents", rh("cost", 2).alias("total_cost"),
                    rh(F.try_divide(F.col("cost"), F.nullif(F.col("n_incidents"), F.lit(0))), 2).alias("cost_per_incident"))


@query("rp_maintenance_cost_nested", ops=("RP-15", "JN-18", "AG-18"), sql=f"""
SELECT l_orderkey AS order_id, count(*) AS n_lines, {rnd("sum(l_extendedprice)", 2)} AS total_cost,
       max({{'l': l_linenumber, 'c': l_extendedprice}}).c AS last_cost
FROM lineitem GROUP BY l_orderkey
""")
def rp_maintenance_cost_nested(spark, d):
    li = read(spark, d, "lineitem")
    docs = li.groupBy("l_orderkey").agg(F.collect_list(F.struct(
        F.col("l_linenumber").alias("line"), F.col("l_extendedprice").alias("cost"))).alias("history"))
    u = docs.select("l_orderkey", F.explode("history").alias("h"))          # $unwind
    return u.groupBy(F.col("l_orderkey").alias("order_id")).agg(
        F.count(F.lit(1)).alias("n_lines"), rh(F.sum("h.cost"), 2).alias("total_cost"),
        F.max(F.struct("h.line", "h.cost"))["cost"].alias("last_cost"))


@query("rp_json_telemetry", ops=("RP-16", "DOC-01", "AG-07"), sql=f"""
SELECT CAST(json_extract(props, '$.k') AS INTEGER) // 10 AS horizon, count(*) AS n,
       count(*) FILTER (WHERE value > 300) AS n_critical, {rnd("avg(value)", 3)} AS avg_value
FROM events GROUP BY 1
""")
def rp_json_telemetry(spark, d):
    e = read(spark, d, "events")
    hz = F.floor(doc.path(doc.parse("props"), "$.k", "int") / 10).cast("int")
    return e.groupBy(hz.alias("horizon")).agg(F.count(F.lit(1)).alias("n"),
                                              F.count_if(F.col("value") > 300).alias("n_critical"),
                                              rh(F.avg("value"), 3).alias("avg_value"))


@query("rp_json_fleet_aggregates", ops=("RP-17", "DOC-01", "DOC-04"), sql="""
SELECT c_mktsegment AS type, c_nationkey AS mine_key, count(*) AS n,
       sum(CASE WHEN c_acctbal > 9000 THEN 2 ELSE 1 END) AS n_tags
FROM customer GROUP BY ALL
""")
def rp_json_fleet_aggregates(spark, d):
    docs = customer_docs(spark, d)
    v = doc.parse("doc")
    tags = doc.array_elements(v, "$.tags", "string")
    return docs.groupBy(doc.path(v, "$.type").alias("type"), doc.path(v, "$.nation.key", "int").alias("mine_key")).agg(
        F.count(F.lit(1)).alias("n"), F.sum(F.size(tags)).alias("n_tags"))


@query("rp_plan_vs_actual", ops=("RP-18", "JN-06", "SF-10"), sql=f"""
WITH geo AS (SELECT c.c_custkey, r.r_name FROM customer c JOIN nation n ON n.n_nationkey = c.c_nationkey
             JOIN region r ON r.r_regionkey = n.n_regionkey),
plan AS (SELECT g.r_name AS mine, date_trunc('month', o.o_orderdate) AS month, sum(o.o_totalprice) AS planned
         FROM orders o JOIN geo g ON g.c_custkey = o.o_custkey GROUP BY ALL),
act AS (SELECT g.r_name AS mine, date_trunc('month', l.l_shipdate) AS month,
               sum(l.l_extendedprice * (1 - l.l_discount) * (1 + l.l_tax)) AS actual
        FROM lineitem l JOIN orders o ON o.o_orderkey = l.l_orderkey JOIN geo g ON g.c_custkey = o.o_custkey GROUP BY ALL)
SELECT coalesce(p.mine, a.mine) AS mine, coalesce(p.month, a.month) AS month, {rnd("p.planned", 2)} AS planned,
       {rnd("a.actual", 2)} AS actual, {rnd("a.actual * 100.0 / nullif(p.planned, 0)", 2)} AS fulfilment_pct
FROM plan p FULL OUTER JOIN act a ON a.mine = p.mine AND a.month = p.month
""")
def rp_plan_vs_actual(spark, d):
    o = read(spark, d, "orders")
    c = read(spark, d, "customer").select("c_custkey", "c_nationkey")
    n, r = read(spark, d, "nation"), read(spark, d, "region")
    geo = (c.join(F.broadcast(n), c.c_nationkey == n.n_nationkey).join(F.broadcast(r), n.n_regionkey == r.r_regionkey)
           .select("c_custkey", F.col("r_name").alias("mine")))
    plan = (o.join(geo, o.o_custkey == geo.c_custkey).groupBy("mine", trunc("month", "o_orderdate").alias("month"))
            .agg(F.sum("o_totalprice").alias("planned")))
    p = production(spark, d)
    act = (p.join(geo, p.o_custkey == geo.c_custkey).groupBy("mine", trunc("month", "l_shipdate").alias("month"))
           .agg(F.sum(F.col("l_extendedprice") * (1 - F.col("l_discount")) * (1 + F.col("l_tax"))).alias("actual")))
    j = plan.join(act, ["mine", "month"], "full_outer")
    return j.select("mine", "month", rh("planned", 2).alias("planned"), rh("actual", 2).alias("actual"),
                    rh(F.try_divide(F.col("actual") * 100.0, F.nullif(F.col("planned"), F.lit(0.0))), 2)
                    .alias("fulfilment_pct"))

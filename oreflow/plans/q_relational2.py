"""Registered queries: window functions, ordering, set operations and scalar
functions."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import Window

from oreflow.functions import timefn
from oreflow.functions.hashing import row_hash
from oreflow.functions.numeric import round_half_up as rh
from oreflow.operators import aggregates as agg
from oreflow.operators import timeseries as ts
from oreflow.operators import windows as wn
from oreflow.plans.q_timeseries import KEYS, R
from oreflow.plans.registry import query
from oreflow.plans.sqlfmt import rnd
from oreflow.sources.tables import read, sensor_readings


@query("wn_running_totals", ops=("WN-05", "WN-08"), sql=f"""
SELECT o_orderkey, o_custkey,
       CAST(row_number() OVER w AS INTEGER) AS seq_no,
       {rnd("sum(o_totalprice) OVER w", 2)} AS running_value,
       {rnd("avg(o_totalprice) OVER w", 2)} AS running_avg
FROM orders WINDOW w AS (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey
                         ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)
""")
def wn_running_totals(spark, d):
    o = read(spark, d, "orders").select("o_orderkey", "o_custkey", "o_orderdate", "o_totalprice")
    r = wn.running_stats(o, ["o_custkey"], "o_orderdate", "o_orderkey", "o_totalprice", bucket_s=365 * 86400)
    return r.select("o_orderkey", "o_custkey", F.col("seq_no").cast("int").alias("seq_no"),
                    rh("running_sum", 2).alias("running_value"), rh("running_avg", 2).alias("running_avg"))


@query("wn_sessions_by_gap", ops=("WN-09", "ST-03"), bench=True, sql=f"""
WITH g AS (SELECT equipment_id, ts, reading_id,
                  CASE WHEN lag(ts) OVER w IS NULL
                         OR ts - lag(ts) OVER w > INTERVAL '10 minutes' THEN 1 ELSE 0 END AS is_new
           FROM {R} WINDOW w AS (PARTITION BY equipment_id ORDER BY ts, reading_id)),
s AS (SELECT *, sum(is_new) OVER (PARTITION BY equipment_id ORDER BY ts, reading_id
                                  ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS session_no FROM g)
SELECT equipment_id, CAST(session_no AS BIGINT) AS session_no, min(ts) AS session_start,
       max(ts) AS session_end, count(*) AS n_events,
       CAST(date_diff('microsecond', min(ts), max(ts)) // 1000000 AS BIGINT) AS duration_s
FROM s GROUP BY ALL
""")
def wn_sessions_by_gap(spark, d):
    r = sensor_readings(spark, d)
    return wn.sessions_by_gap(r, ["equipment_id"], "ts", gap_s=600, order_tiebreak="reading_id",
                              bucket_s=86400)


@query("wn_peak_per_day", ops=("WN-07",), sql=f"""
SELECT sensor_type, CAST(ts AS DATE) AS day, max({{'v': value, 'i': -reading_id}}).v AS peak_value,
       -max({{'v': value, 'i': -reading_id}}).i AS peak_reading_id
FROM {R} GROUP BY ALL
""")
def wn_peak_per_day(spark, d):
    # FIRST_VALUE(x) OVER (ORDER BY v DESC) per group == arg-max per group,
    # computed as a partial aggregate instead of a full window sort
    r = sensor_readings(spark, d)
    pk = F.max(F.struct(F.col("value").alias("v"), (-F.col("reading_id")).alias("i")))
    return r.groupBy("sensor_type", F.to_date("ts").alias("day")).agg(pk.alias("pk")).select(
        "sensor_type", "day", F.col("pk.v").alias("peak_value"), (-F.col("pk.i")).alias("peak_reading_id"))


@query("wn_ma_crossover", ops=("WN-12", "WN-03", "WN-04"), sql=f"""
WITH m AS (SELECT reading_id, equipment_id, sensor_type, ts,
                  avg(value) OVER (PARTITION BY equipment_id, sensor_type ORDER BY ts, reading_id
                                   ROWS BETWEEN 2 PRECEDING AND CURRENT ROW) AS ma_fast,
                  avg(value) OVER (PARTITION BY equipment_id, sensor_type ORDER BY ts, reading_id
                                   ROWS BETWEEN 7 PRECEDING AND CURRENT ROW) AS ma_slow
           FROM {R}),
x AS (SELECT *, ma_fast - ma_slow AS signal,
             lag(ma_fast - ma_slow) OVER (PARTITION BY equipment_id, sensor_type ORDER BY ts, reading_id) AS prev_signal
      FROM m)
SELECT reading_id, equipment_id, sensor_type, {rnd("signal", 3)} AS signal,
       CASE WHEN signal > 0 THEN 'golden' ELSE 'death' END AS cross_type
FROM x WHERE prev_signal IS NOT NULL AND sign(signal) <> sign(prev_signal) AND signal <> 0 AND prev_signal <> 0
""")
def wn_ma_crossover(spark, d):
    r = sensor_readings(spark, d)
    x = wn.ma_crossover(r, KEYS, "ts", "value", fast=3, slow=8, order_tiebreak="reading_id",
                        bucket_s=7 * 86400)
    return x.select("reading_id", *KEYS, rh("signal", 3).alias("signal"), "cross_type")


@query("wn_sequence_per_key", ops=("WN-08", "WN-11"), sql="""
SELECT event_id AS reading_id, user_id AS equipment_id,
       CAST(row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS INTEGER) AS seq_no,
       CAST(rank() OVER (PARTITION BY user_id, event_type ORDER BY value DESC) AS INTEGER) AS value_rank
FROM events
""")
def wn_sequence_per_key(spark, d):
    r = sensor_readings(spark, d)
    # sequence number = running count (bucketed on large inputs); value rank
    # from distinct (key, value) counts on large inputs
    s = wn.running_stats(r.withColumn("__one", F.lit(1.0)), ["equipment_id"], "ts", "reading_id", "__one",
                         bucket_s=7 * 86400)
    s = wn.rank_by_value(s, ["equipment_id", "sensor_type"], "value", "value_rank")
    return s.select("reading_id", "equipment_id", F.col("seq_no").cast("int").alias("seq_no"), "value_rank")


@query("wn_lag_pct_change", ops=("WN-01", "WN-02", "SF-10"), sql=f"""
SELECT reading_id, {rnd("value - lag(value) OVER w", 2)} AS delta,
       {rnd("(value - lag(value) OVER w) * 100.0 / nullif(lag(value) OVER w, 0)", 2)} AS pct_change,
       lead(value) OVER w AS next_value
FROM {R} WINDOW w AS (PARTITION BY equipment_id, sensor_type ORDER BY ts, reading_id)
""")
def wn_lag_pct_change(spark, d):
    r = ts.lag_delta(sensor_readings(spark, d), KEYS, "ts", "value", order_tiebreak="reading_id",
                     bucket_s=7 * 86400)
    return r.select("reading_id", rh("delta", 2).alias("delta"), rh("pct_change", 2).alias("pct_change"),
                    "next_value")


@query("ol_top_customers", ops=("OL-01", "OL-02", "OL-04"), sql="""
SELECT c_custkey, c_name, c_acctbal, c_mktsegment FROM customer
ORDER BY c_acctbal DESC NULLS LAST, c_name LIMIT 20
""")
def ol_top_customers(spark, d):
    c = read(spark, d, "customer")
    return (c.orderBy(F.col("c_acctbal").desc_nulls_last(), "c_name").limit(20)
            .select("c_custkey", "c_name", "c_acctbal", "c_mktsegment"))


@query("ol_sort_by_case", ops=("OL-03", "PF-10"), sql="""
SELECT o_orderkey, o_orderpriority, o_totalprice,
       CASE o_orderpriority WHEN '1-URGENT' THEN 1 WHEN '2-HIGH' THEN 2 ELSE 3 END AS severity
FROM orders ORDER BY severity, abs(o_totalprice - 150000) DESC, o_orderkey LIMIT 25
""")
def ol_sort_by_case(spark, d):
    o = read(spark, d, "orders")
    sev = (F.when(F.col("o_orderpriority") == "1-URGENT", 1)
           .when(F.col("o_orderpriority") == "2-HIGH", 2).otherwise(3))
    return (o.select("o_orderkey", "o_orderpriority", "o_totalprice", sev.alias("severity"))
            .orderBy("severity", F.abs(F.col("o_totalprice") - 150000).desc(), "o_orderkey").limit(25))


@query("ol_top3_per_segment", ops=("OL-06", "DOC-16", "AG-19"), sql="""
WITH r AS (SELECT c.c_mktsegment, o.o_orderkey, o.o_totalprice,
                  row_number() OVER (PARTITION BY c.c_mktsegment ORDER BY o.o_totalprice DESC, o.o_orderkey) AS rank
           FROM orders o JOIN customer c ON c.c_custkey = o.o_custkey)
SELECT c_mktsegment, o_orderkey, o_totalprice, CAST(rank AS INTEGER) AS rank FROM r WHERE rank <= 3
""")
def ol_top3_per_segment(spark, d):
    o = read(spark, d, "orders").select("o_orderkey", "o_custkey", "o_totalprice")
    c = read(spark, d, "customer").select("c_custkey", "c_mktsegment")
    j = o.join(c, o.o_custkey == c.c_custkey)
    t = agg.top_k_per_group(j, ["c_mktsegment"], [F.col("o_totalprice").desc(), F.col("o_orderkey")], 3)
    return t.select("c_mktsegment", "o_orderkey", "o_totalprice", "rank")


@query("ol_first_row", ops=("OL-05",), sql="""
SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 1
""")
def ol_first_row(spark, d):
    o = read(spark, d, "orders")
    return o.orderBy(F.col("o_totalprice").desc(), "o_orderkey").limit(1).select("o_orderkey", "o_totalprice")


@query("so_union_timeline", ops=("SO-01", "RP-07", "ST-15", "SF-01"), sql="""
SELECT o_custkey AS entity_id, o_orderdate AS event_time, 'order' AS source,
       'order ' || CAST(o_orderkey AS VARCHAR) || ' ' || o_orderpriority AS text FROM orders
UNION ALL
SELECT o.o_custkey, l.l_shipdate, 'shipment',
       'line ' || CAST(l.l_linenumber AS VARCHAR) || ' of ' || CAST(l.l_orderkey AS VARCHAR)
FROM lineitem l JOIN orders o ON o.o_orderkey = l.l_orderkey
""")
def so_union_timeline(spark, d):
    o = read(spark, d, "orders")
    li = read(spark, d, "lineitem")
    a = o.select(F.col("o_custkey").alias("entity_id"), F.col("o_orderdate").alias("event_time"),
                 F.lit("order").alias("source"),
                 F.concat(F.lit("order "), F.col("o_orderkey").cast("string"), F.lit(" "),
                          F.col("o_orderpriority")).alias("text"))
    b = (li.join(o.select("o_orderkey", "o_custkey"), li.l_orderkey == o.o_orderkey)
         .select(F.col("o_custkey").alias("entity_id"), F.col("l_shipdate").alias("event_time"),
                 F.lit("shipment").alias("source"),
                 F.concat(F.lit("line "), F.col("l_linenumber").cast("string"), F.lit(" of "),
                          F.col("l_orderkey").cast("string")).alias("text")))
    return a.unionByName(b)


@query("so_except_reconcile", ops=("SO-02", "ETL-09"), sql="""
WITH a AS (SELECT DISTINCT l_orderkey AS k FROM lineitem),
b AS (SELECT o_orderkey AS k FROM orders)
SELECT 'lines_without_order' AS check_name, count(*) AS n,
       CASE WHEN count(*) = 0 THEN 'OK' ELSE 'MISMATCH' END AS status
FROM (SELECT k FROM a EXCEPT SELECT k FROM b)
UNION ALL
SELECT 'orders_without_lines', count(*), CASE WHEN count(*) = 0 THEN 'OK' ELSE 'MISMATCH' END
FROM (SELECT k FROM b EXCEPT SELECT k FROM a)
""")
def so_except_reconcile(spark, d):
    a = read(spark, d, "lineitem").select(F.col("l_orderkey").alias("k"))
    b = read(spark, d, "orders").select(F.col("o_orderkey").alias("k"))
    rep = agg.count_report({"lines_without_order": a.subtract(b),
                            "orders_without_lines": b.subtract(a)})
    return rep.select(F.col("table_name").alias("check_name"), F.col("n_rows").alias("n"),
                      F.when(F.col("n_rows") == 0, "OK").otherwise("MISMATCH").alias("status"))


@query("sf_string_functions", ops=("SF-01", "SF-02", "SF-03", "G4"), sql="""
SELECT c_custkey,
       upper(c_mktsegment) || ' ' || left(c_name, 1) || '.' AS display_name,
       concat_ws('|', c_mktsegment, CASE WHEN c_acctbal > 5000 THEN NULL ELSE 'std' END) AS tag,
       lpad(CAST(c_nationkey AS VARCHAR), 3, '0') AS nation_code,
       length(trim(c_name)) AS name_len, ascii(c_mktsegment) AS first_code,
       lower(substr(c_name, 1, 8)) AS prefix
FROM customer
""")
def sf_string_functions(spark, d):
    c = read(spark, d, "customer")
    return c.select(
        "c_custkey",
        F.concat(F.upper("c_mktsegment"), F.lit(" "), F.left("c_name", F.lit(1)), F.lit(".")).alias("display_name"),
        F.concat_ws("|", "c_mktsegment", F.when(F.col("c_acctbal") > 5000, F.lit(None))
                    .otherwise(F.lit("std"))).alias("tag"),
        F.lpad(F.col("c_nationkey").cast("string"), 3, "0").alias("nation_code"),
        F.length(F.trim("c_name")).alias("name_len"), F.ascii("c_mktsegment").alias("first_code"),
        F.lower(F.substring("c_name", 1, 8)).alias("prefix"))


@query("sf_row_hash", ops=("SF-04", "ETL-01", "G4"), sql="""
SELECT s_suppkey, md5(concat_ws('|', coalesce(length(CAST(s_suppkey AS VARCHAR)) || ':' || s_suppkey, '~'),
                                coalesce(length(s_name) || ':' || s_name, '~'),
                                coalesce(length(CAST(s_nationkey AS VARCHAR)) || ':' || s_nationkey, '~'))) AS row_hash
FROM supplier
""")
def sf_row_hash(spark, d):
    s = read(spark, d, "supplier")
    return s.select("s_suppkey", row_hash("s_suppkey", "s_name", "s_nationkey").alias("row_hash"))


# Localised month and weekday names of the calendar dimension (gotcha G9):
# fixed values, in calendar order.
MONTH_NAMES_RU = ["Январь", "Февраль", "Март", "Апрель", "Май", "Июнь", "Июль", "Август",
                  "Сентябрь", "Октябрь", "Ноябрь", "Декабрь"]
DAY_NAMES_RU = ["Понедельник", "Вторник", "Среда", "Четверг", "Пятница", "Суббота", "Воскресенье"]

_MONTH_VALUES = ", ".join(f"({i + 1}, '{m}')" for i, m in enumerate(MONTH_NAMES_RU))
_DAY_VALUES = ", ".join(f"({i + 1}, '{m}')" for i, m in enumerate(DAY_NAMES_RU))


@query("wh_calendar_dimension", ops=("WH-01", "SF-05", "SF-06", "SRC-07", "G8", "G9"), sql=f"""
WITH rg AS (SELECT CAST(min(o_orderdate) AS DATE) AS lo, CAST(max(o_orderdate) AS DATE) AS hi FROM orders),
d AS (SELECT CAST(unnest(generate_series(lo, hi, INTERVAL 1 DAY)) AS DATE) AS date FROM rg),
mn(m, month_name) AS (VALUES {_MONTH_VALUES}),
dn(i, day_name) AS (VALUES {_DAY_VALUES})
SELECT CAST(strftime(date, '%Y%m%d') AS INTEGER) AS date_key, date, year(date) AS year,
       quarter(date) AS quarter, month(date) AS month, mn.month_name,
       CAST(weekofyear(date) AS INTEGER) AS week_of_year, day(date) AS day_of_month,
       isodow(date) AS day_of_week, dn.day_name, isodow(date) >= 6 AS is_weekend
FROM d JOIN mn ON mn.m = month(date) JOIN dn ON dn.i = isodow(date)
""")
def wh_calendar_dimension(spark, d):
    from oreflow.operators.warehouse import calendar_dimension
    o = read(spark, d, "orders")
    return calendar_dimension(spark, o, "o_orderdate", MONTH_NAMES_RU, DAY_NAMES_RU)


@query("sf_math_functions", ops=("SF-09", "SF-11"), sql=f"""
SELECT l_orderkey, l_linenumber, {rnd("l_extendedprice / 3.0", 2)} AS r2, abs(l_quantity - 25) AS dev,
       CAST(floor(l_quantity / 7) AS BIGINT) AS f7, l_linenumber % 3 AS m3,
       greatest(l_discount, l_tax) AS gt, least(l_discount, l_tax) AS lt,
       {rnd("sin(l_quantity * pi() / 50) + cos(l_quantity * pi() / 50)", 6)} AS wave,
       CAST(l_quantity AS INTEGER) AS qty_int, TRY_CAST(l_returnflag AS INTEGER) AS bad_cast
FROM lineitem
""")
def sf_math_functions(spark, d):
    li = read(spark, d, "lineitem")
    q = F.col("l_quantity")
    return li.select(
        "l_orderkey", "l_linenumber", rh(F.col("l_extendedprice") / 3.0, 2).alias("r2"),
        F.abs(q - 25).alias("dev"), F.floor(q / 7).cast("bigint").alias("f7"),
        (F.col("l_linenumber") % 3).alias("m3"),
        F.greatest("l_discount", "l_tax").alias("gt"), F.least("l_discount", "l_tax").alias("lt"),
        rh(F.sin(q * F.pi() / 50) + F.cos(q * F.pi() / 50), 6).alias("wave"),
        q.cast("int").alias("qty_int"), F.col("l_returnflag").try_cast("int").alias("bad_cast"))


@query("sf_array_functions", ops=("SF-12", "SF-13", "AG-06"), sql=f"""
WITH a AS (SELECT l_orderkey, list(l_quantity ORDER BY l_linenumber, l_quantity) AS q FROM lineitem GROUP BY l_orderkey)
SELECT l_orderkey, len(q) AS n_lines, q[1] AS first_qty,
       len(list_filter(q, lambda x: x > 25)) AS n_big,
       {rnd("list_sum(list_transform(q, lambda x: x * 2))", 2)} AS double_sum,
       list_bool_and(list_transform(q, lambda x: x > 0)) AS all_positive,
       len(list_filter(q, lambda x: x > 49)) = 0 AS none_above_49
FROM a
""")
def sf_array_functions(spark, d):
    li = read(spark, d, "lineitem")
    # per-order arrays are bounded by the lines of one order (a handful)
    a = li.groupBy("l_orderkey").agg(
        F.transform(F.array_sort(F.collect_list(F.struct("l_linenumber", "l_quantity"))),
                    lambda s: s["l_quantity"]).alias("q"))
    q = F.col("q")
    return a.select(
        "l_orderkey", F.size(q).cast("bigint").alias("n_lines"), F.try_element_at(q, F.lit(1)).alias("first_qty"),
        F.size(F.filter(q, lambda x: x > 25)).cast("bigint").alias("n_big"),
        rh(F.aggregate(F.transform(q, lambda x: x * 2), F.lit(0.0), lambda acc, x: acc + x), 2)
        .alias("double_sum"),
        F.forall(q, lambda x: x > 0).alias("all_positive"),
        (~F.exists(q, lambda x: x > 49)).alias("none_above_49"))


@query("sf_shift_production_day", ops=("SF-15", "SF-08"), sql="""
WITH s AS (SELECT CASE WHEN hour(ts) >= 8 AND hour(ts) < 16 THEN 1 WHEN hour(ts) >= 16 THEN 2 ELSE 3 END AS shift,
                  CAST(ts - INTERVAL 8 HOUR AS DATE) AS production_date, value FROM events)
SELECT production_date, shift, count(*) AS n_readings FROM s GROUP BY ALL
""")
def sf_shift_production_day(spark, d):
    r = sensor_readings(spark, d)
    return r.groupBy(timefn.production_date("ts").alias("production_date"),
                     timefn.shift_of("ts").alias("shift")).agg(F.count(F.lit(1)).alias("n_readings"))


@query("sf_grade_class", ops=("SF-16", "SF-14"), sql="""
SELECT CASE WHEN l_quantity >= 40 AND l_discount <= 0.03 THEN 'high'
            WHEN l_quantity >= 20 THEN 'ordinary' ELSE 'poor' END AS grade,
       count(*) AS n FROM lineitem GROUP BY 1
""")
def sf_grade_class(spark, d):
    from oreflow.functions.classify import grade_class
    li = read(spark, d, "lineitem")
    return li.groupBy(grade_class("l_quantity", "l_discount").alias("grade")).agg(
        F.count(F.lit(1)).alias("n"))

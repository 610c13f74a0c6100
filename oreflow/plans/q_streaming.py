"""Registered streaming queries.

Each one runs a Structured Streaming job over a landing folder that the
``events`` table is delivered to out of order, in three micro-batches
(``core.land_out_of_order``), with ``trigger(availableNow=True)`` into a
changelog sink below the shared checkpoint folder, then returns the final
result table.  Results equal those of the whole table in the order of time.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from oreflow.functions.classify import quality_flag
from oreflow.functions.numeric import round_half_up as rh
from oreflow.plans.q_timeseries import KEYS, R
from oreflow.plans.registry import query
from oreflow.plans.sqlfmt import rnd
from oreflow.session import scratch_path
from oreflow.sinks.writers import table
from oreflow.sources.tables import read, sensor_readings
from oreflow.streaming import core as sc
from oreflow.streaming import operators as so

# Alert rules of the telemetry binding (fixed values; one row per rule):
# rule_id, event_type, alert_level, condition_type, threshold_low, threshold_high, is_active
ALERT_RULES = [
    (1, "click", "warning", "gt", None, 200.0, True),
    (2, "click", "critical", "gt", None, 300.0, True),
    (3, "view", "warning", "gt", None, 200.0, True),
    (4, "view", "critical", "gt", None, 300.0, True),
    (5, "purchase", "warning", "gt", None, 250.0, True),
    (6, "purchase", "critical", "gt", None, 320.0, True),
    (7, "purchase", "warning", "lt", 1.0, None, True),
    (8, "purchase", "critical", "lt", 0.1, None, True),
    (9, "signup", "warning", "gt", None, 220.0, True),
    (10, "signup", "critical", "gt", None, 330.0, False),
    (11, "error", "warning", "range", 0.5, 150.0, True),
    (12, "error", "critical", "gt", None, 250.0, True),
]
RULES_SCHEMA = ("rule_id int, event_type string, alert_level string, condition_type string, "
                "threshold_low double, threshold_high double, is_active boolean")


def _v(x):
    return "NULL" if x is None else (("TRUE" if x else "FALSE") if isinstance(x, bool) else
                                     (f"'{x}'" if isinstance(x, str) else repr(x)))


RULES_SQL = ("rules(rule_id, event_type, alert_level, condition_type, threshold_low, threshold_high, is_active)"
             " AS (VALUES " + ", ".join("(" + ", ".join(_v(x) for x in r) + ")" for r in ALERT_RULES) + ")")
ALERTS_SQL = f"""{RULES_SQL},
alerts AS (SELECT e.event_id AS reading_id, e.user_id AS equipment_id, e.event_type AS sensor_type, e.value,
                  e.ts, r.rule_id, r.alert_level
           FROM events e JOIN rules r ON r.event_type = e.event_type AND r.is_active
           WHERE (r.condition_type = 'gt' AND e.value > r.threshold_high)
              OR (r.condition_type = 'lt' AND e.value < r.threshold_low)
              OR (r.condition_type = 'range' AND (e.value < r.threshold_low OR e.value > r.threshold_high)))"""


def rules_df(spark):
    return spark.createDataFrame(ALERT_RULES, RULES_SCHEMA)


def _stream(spark, d):
    """The readings as they arrive: out of order, in several micro-batches."""
    return sc.arrivals(spark, sc.land_out_of_order(spark, d))


def _landed_sql(faulty: bool) -> str:
    """The landing of ``sc.land_out_of_order``: readings with time of arrival and delivery."""
    lag = f"(event_id % {sc.LAG_STEPS}) * {sc.LAG_STEP_H}"
    lag = f"CASE WHEN event_id % 50 = 7 THEN 288 ELSE {lag} END" if faulty else lag
    ts = "CASE WHEN event_id % 97 = 3 THEN ts + INTERVAL 10 DAYS ELSE ts END" if faulty else "ts"
    return f"""landed AS (
  SELECT event_id AS reading_id, user_id AS equipment_id, event_type AS sensor_type, value, {ts} AS ts,
         ts + to_hours(CAST({lag} AS BIGINT)) AS arrived FROM events),
deliveries AS (
  SELECT *, least(floor((epoch_us(arrived) - min(epoch_us(arrived)) OVER ()) * {sc.DROPS}.0
                        / (max(epoch_us(arrived)) OVER () - min(epoch_us(arrived)) OVER ())), {sc.DROPS - 1}) AS delivery FROM landed)"""


@query("st_tumbling_windows", ops=("ST-01", "ST-13", "TS-17", "G11", "SRC-08"), sql=f"""
SELECT time_bucket(INTERVAL '5 minutes', ts) AS window_start, time_bucket(INTERVAL '5 minutes', ts) + INTERVAL '5 minutes' AS window_end,
       equipment_id, sensor_type, count(*) AS n, {rnd("sum(value)")} AS sum_value, {rnd("avg(value)")} AS avg_value,
       min(value) AS min_value, max(value) AS max_value, {rnd("stddev_samp(value)")} AS std_value
FROM {R} WHERE value <= 300 GROUP BY ALL
""")
def st_tumbling_windows(spark, d):
    s = _stream(spark, d).where(quality_flag("value") != "bad")  # good + suspect (G11)
    agg = so.window_aggregates(s, KEYS, "ts", "value", "5 minutes", watermark=sc.DELAY)
    out = sc.run_changelog(agg, "st_tumbling", "update")
    r = sc.to_ntz(sc.read_changelog(spark, out, ["window", *KEYS]))
    return r.select(F.col("window.start").alias("window_start"), F.col("window.end").alias("window_end"), *KEYS,
                    "n", rh("sum_value").alias("sum_value"), rh("avg_value").alias("avg_value"),
                    "min_value", "max_value", rh("std_value").alias("std_value"))


@query("st_sliding_windows", ops=("ST-02",), sql=f"""
WITH w AS (SELECT sensor_type, value, unnest(generate_series(time_bucket(INTERVAL '1 minute', ts) - INTERVAL '9 minutes',
                                                             time_bucket(INTERVAL '1 minute', ts), INTERVAL '1 minute')) AS ws
           FROM {R})
SELECT ws AS window_start, sensor_type, count(*) AS n, {rnd("avg(value)", 4)} AS avg_value FROM w GROUP BY ALL
""")
def st_sliding_windows(spark, d):
    agg = so.window_aggregates(_stream(spark, d), ["sensor_type"], "ts", "value", "10 minutes", "1 minute", sc.DELAY)
    out = sc.run_changelog(agg, "st_sliding", "update")
    r = sc.to_ntz(sc.read_changelog(spark, out, ["window", "sensor_type"]))
    return r.select(F.col("window.start").alias("window_start"), "sensor_type", "n",
                    rh("avg_value", 4).alias("avg_value"))


@query("st_session_windows", ops=("ST-03", "G21"), sql=f"""
WITH g AS (SELECT equipment_id, ts, reading_id,
                  CASE WHEN lag(ts) OVER w IS NULL OR ts - lag(ts) OVER w > INTERVAL '10 minutes' THEN 1 ELSE 0 END AS is_new
           FROM {R} WINDOW w AS (PARTITION BY equipment_id ORDER BY ts, reading_id)),
s AS (SELECT *, sum(is_new) OVER (PARTITION BY equipment_id ORDER BY ts, reading_id
                                  ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS sn FROM g)
SELECT equipment_id, min(ts) AS session_start, max(ts) AS last_event, count(*) AS n_events FROM s GROUP BY equipment_id, sn
""")
def st_session_windows(spark, d):
    agg = so.session_windows(_stream(spark, d), ["equipment_id"], "ts", 600, sc.DELAY)
    out = sc.run_changelog(agg, "st_session")
    return sc.to_ntz(sc.read_changelog(spark, out, ["equipment_id", "session_start"]))


@query("st_threshold_alerts", ops=("ST-04", "JN-09", "SF-14"), sql=f"""
WITH {ALERTS_SQL}
SELECT reading_id, equipment_id, sensor_type, rule_id, alert_level, value FROM alerts
""")
def st_threshold_alerts(spark, d):
    a = so.threshold_alerts(_stream(spark, d), rules_df(spark), "sensor_type", "value")
    out = sc.run_changelog(a.select("reading_id", "equipment_id", "sensor_type", "rule_id", "alert_level", "value"),
                           "st_alerts", "append")
    return sc.read_changelog(spark, out)


@query("st_alert_stats", ops=("ST-05",), sql=f"""
WITH {ALERTS_SQL}
SELECT alert_level, sensor_type, count(*) AS n_alerts, max(value) AS max_value, min(value) AS min_value FROM alerts
GROUP BY ALL
""")
def st_alert_stats(spark, d):
    a = so.threshold_alerts(_stream(spark, d), rules_df(spark), "sensor_type", "value")
    g = a.groupBy("alert_level", "sensor_type").agg(F.count(F.lit(1)).alias("n_alerts"),
                                                    F.max("value").alias("max_value"), F.min("value").alias("min_value"))
    out = sc.run_changelog(g, "st_alert_stats", "update")
    return sc.read_changelog(spark, out, ["alert_level", "sensor_type"])


@query("st_escalation", ops=("ST-06",), sql=f"""
WITH {ALERTS_SQL},
w AS (SELECT equipment_id, ts, reading_id,
             count(*) OVER (PARTITION BY equipment_id ORDER BY ts RANGE BETWEEN INTERVAL '15 minutes' PRECEDING AND CURRENT ROW) AS n
      FROM alerts WHERE alert_level = 'warning')
SELECT equipment_id, ts, reading_id, CAST(n AS INTEGER) AS n_in_window FROM w WHERE n >= 3
""")
def st_escalation(spark, d):
    a = so.threshold_alerts(_stream(spark, d), rules_df(spark), "sensor_type", "value")
    e = so.escalate_bursts(a, ["equipment_id"], "ts", "reading_id", "warning", 900, 3, sc.DELAY)
    out = sc.run_changelog(e, "st_escalation")
    return sc.to_ntz(sc.read_changelog(spark, out, ["reading_id"]).select("equipment_id", "ts", "reading_id", "n_in_window"))


@query("st_unacknowledged_critical", ops=("ST-07", "TS-24"), sql=f"""
WITH {ALERTS_SQL},
crit AS (SELECT * FROM alerts WHERE alert_level = 'critical'),
acks AS (SELECT user_id AS equipment_id, event_type AS sensor_type, ts AS ack_ts FROM events WHERE value <= 200)
SELECT c.reading_id, c.equipment_id, c.sensor_type, c.ts FROM crit c
WHERE NOT EXISTS (SELECT 1 FROM acks k WHERE k.equipment_id = c.equipment_id AND k.sensor_type = c.sensor_type
                  AND k.ack_ts >= c.ts AND k.ack_ts <= c.ts + INTERVAL '10 minutes')
""")
def st_unacknowledged_critical(spark, d):
    from oreflow.operators.joins import rule_join
    r = sensor_readings(spark, d)
    alerts = rule_join(r, rules_df(spark).withColumnRenamed("event_type", "sensor_type"), "sensor_type", "value")
    crit = alerts.where(F.col("alert_level") == "critical").select("reading_id", *KEYS, "ts")
    # an acknowledgement = the reading of the same sensor back in the normal range
    acks = r.where(F.col("value") <= 200).select(*KEYS, F.col("ts").alias("ack_ts"))
    return so.unacknowledged(crit, acks, KEYS, "ts", "ack_ts", 600)


# the watermark that fires the last timers comes from the rows before the last (empty) micro-batch
@query("st_ack_timer", ops=("ST-07",), sql=f"""
WITH crit AS (SELECT * FROM {R} WHERE value > 300), acks AS (SELECT * FROM {R} WHERE value <= 200)
SELECT c.equipment_id, c.sensor_type, c.ts AS alert_time, c.ts + INTERVAL '10 minutes' AS deadline FROM crit c
WHERE c.ts + INTERVAL '10 minutes' < (SELECT max(ts) FROM {R} WHERE value > 300 OR value <= 200) - INTERVAL '{sc.DELAY}'
  AND NOT EXISTS (SELECT 1 FROM acks k WHERE k.equipment_id = c.equipment_id AND k.sensor_type = c.sensor_type
                  AND k.ts >= c.ts AND k.ts <= c.ts + INTERVAL '10 minutes')
""")
def st_ack_timer(spark, d):
    kind = F.when(F.col("value") > 300, "critical").when(F.col("value") <= 200, "ack")
    t = so.ack_timer(_stream(spark, d).withColumn("kind", kind), KEYS, "ts", "kind", 600, sc.DELAY)
    out = sc.run_changelog(t, "st_ack_timer")
    return sc.to_ntz(sc.read_changelog(spark, out))


@query("st_moving_stats", ops=("ST-08", "WN-03"), sql=f"""
SELECT reading_id, {rnd("avg(value) OVER w", 4)} AS ma, {rnd("stddev_samp(value) OVER w", 4)} AS mstd
FROM {R} WINDOW w AS (PARTITION BY equipment_id, sensor_type ORDER BY ts, reading_id ROWS BETWEEN 4 PRECEDING AND CURRENT ROW)
""")
def st_moving_stats(spark, d):
    m = so.moving_stats(_stream(spark, d), KEYS, "ts", "reading_id", "value", 5, sc.DELAY)
    out = sc.run_changelog(m, "st_moving")
    r = sc.read_changelog(spark, out, ["reading_id"])
    return r.select("reading_id", rh("ma", 4).alias("ma"), rh("mstd", 4).alias("mstd"))


@query("st_late_data", ops=("ST-09", "ST-11"), sql=f"""
WITH {_landed_sql(True)},
timely AS (SELECT *, ts > arrived + INTERVAL 24 HOURS AS ahead FROM deliveries),
tops AS (SELECT delivery, max(ts) FILTER (WHERE NOT ahead) AS top FROM timely GROUP BY delivery),
seen AS (SELECT delivery, max(top) OVER (ORDER BY delivery ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS before FROM tops)
SELECT reading_id, ts, CASE WHEN ahead THEN 'future' WHEN ts < before - INTERVAL '{sc.DELAY}' THEN 'late' ELSE 'on_time' END AS arrival
FROM timely JOIN seen USING (delivery)
""")
def st_late_data(spark, d):
    out = scratch_path(spark, "st-late")
    s = sc.arrivals(spark, sc.land_out_of_order(spark, d, faulty=True))
    sc.run_with_late_side_output(s, "ts", 48 * 3600, out, ["reading_id"], arrived="arrived")
    parts = [spark.read.parquet(f"{out}/{x}").select("reading_id", "ts", F.lit(x).alias("arrival"))
             for x in ("on_time", "late", "future")]
    return sc.to_ntz(parts[0].unionByName(parts[1]).unionByName(parts[2]))


# rows are held against the watermark that was in force in the micro-batch before theirs
@query("st_late_rows_dropped", ops=("ST-08", "ST-09"), sql=f"""
WITH {_landed_sql(True)},
rows AS (SELECT * FROM deliveries UNION ALL SELECT * FROM deliveries WHERE reading_id % 40 = 5),
tops AS (SELECT delivery, max(ts) AS top FROM rows GROUP BY delivery),
seen AS (SELECT delivery, max(top) OVER (ORDER BY delivery ROWS BETWEEN UNBOUNDED PRECEDING AND 2 PRECEDING) AS before FROM tops)
SELECT count(*) FILTER (WHERE ts < before - INTERVAL '{sc.DELAY}') AS n_late,
       count(*) FILTER (WHERE before IS NULL OR ts >= before - INTERVAL '{sc.DELAY}') AS n_taken
FROM rows JOIN seen USING (delivery)
""")
def st_late_rows_dropped(spark, d):
    """What the engine drops behind the watermark is counted, and nothing else is lost."""
    s = sc.arrivals(spark, sc.land_out_of_order(spark, d, faulty=True))
    out = sc.run_changelog(so.session_windows(s, ["equipment_id"], "ts", 600, sc.DELAY), "st_dropped")
    n = sc.read_changelog(spark, out, ["equipment_id", "session_start"]).agg(F.sum("n_events").alias("n_taken"))
    return n.select(F.lit(out.late_rows).cast("long").alias("n_late"), "n_taken")


@query("st_lag_metrics", ops=("ST-10",), sql=f"""
WITH {_landed_sql(True)},
l AS (SELECT sensor_type, date_diff('microsecond', ts, arrived) // 1000000 AS lag FROM deliveries)
SELECT sensor_type, {rnd("avg(lag)", 3)} AS avg_lag_s, max(lag) AS max_lag_s, quantile_disc(lag, 0.95) AS p95_lag_s
FROM l GROUP BY sensor_type
""")
def st_lag_metrics(spark, d):
    # the landing's own time of arrival; repeated rows count once
    s = sc.arrivals(spark, sc.land_out_of_order(spark, d, faulty=True))
    out = sc.run_changelog(s.select("reading_id", "sensor_type", "ts", "arrived"), "st_lag", "append")
    lm = so.lag_metrics(sc.read_changelog(spark, out).distinct(), "ts", "arrived", ["sensor_type"])
    return lm.select("sensor_type", rh("avg_lag_s", 3).alias("avg_lag_s"), "max_lag_s", "p95_lag_s")


@query("st_stream_dedup", ops=("ST-11", "TS-15"), sql=f"""
SELECT DISTINCT equipment_id, time_bucket(INTERVAL '1 minute', ts) AS minute FROM {R}
""")
def st_stream_dedup(spark, d):
    s = _stream(spark, d).withColumn("minute", F.date_trunc("minute", "ts"))
    dd = so.dedup_within_watermark(s, ["equipment_id", "minute"], "ts", sc.DELAY)
    out = sc.run_changelog(dd.select("equipment_id", "minute"), "st_dedup", "append")
    return sc.to_ntz(sc.read_changelog(spark, out))


@query("st_stream_interval_join", ops=("ST-12", "JN-10"), sql=f"""
WITH a AS (SELECT * FROM {R} WHERE value > 250), b AS (SELECT * FROM {R} WHERE value > 300)
SELECT a.reading_id AS anomaly_id, b.reading_id AS alert_id FROM a JOIN b
  ON a.equipment_id = b.equipment_id AND a.sensor_type = b.sensor_type
 AND a.ts BETWEEN b.ts - INTERVAL '30 minutes' AND b.ts + INTERVAL '30 minutes'
""")
def st_stream_interval_join(spark, d):
    a = _stream(spark, d).where(F.col("value") > 250)
    b = _stream(spark, d).where(F.col("value") > 300)
    j = so.interval_join_streams(a, b, KEYS, "ts", "ts", "30 minutes", sc.DELAY)
    out = sc.run_changelog(j.select(F.col("l.reading_id").alias("anomaly_id"), F.col("r.reading_id").alias("alert_id")),
                           "st_join", "append")
    return sc.read_changelog(spark, out)


@query("st_speed_layer_fact", ops=("ST-14", "JN-11", "JN-20"), sql=f"""
WITH h AS (SELECT time_bucket(INTERVAL '1 hour', ts) AS hour, equipment_id, count(*) AS n_readings,
                  {rnd("avg(value)", 3)} AS avg_value, count(*) FILTER (WHERE value > 300) AS n_alarms FROM {R} GROUP BY ALL)
SELECT CAST(strftime(h.hour, '%Y%m%d%H') AS BIGINT) AS hour_key, h.equipment_id, c.c_nationkey AS mine_key,
       h.n_readings, h.avg_value, h.n_alarms
FROM h LEFT JOIN customer c ON c.c_custkey = h.equipment_id
""")
def st_speed_layer_fact(spark, d):
    s = _stream(spark, d)
    agg = (s.withWatermark("ts", sc.DELAY).groupBy(F.window("ts", "1 hour").alias("window"), "equipment_id")
           .agg(F.count(F.lit(1)).alias("n_readings"), F.sum("value").alias("sum_value"),
                F.count_if(F.col("value") > 300).alias("n_alarms")))
    out = sc.run_changelog(agg, "st_speed", "update")
    h = sc.to_ntz(sc.read_changelog(spark, out, ["window", "equipment_id"]))
    dim = read(spark, d, "customer").select(F.col("c_custkey").alias("equipment_id"), F.col("c_nationkey").alias("mine_key"))
    f = h.join(dim, "equipment_id", "left")
    return f.select(F.date_format("window.start", "yyyyMMddHH").cast("bigint").alias("hour_key"), "equipment_id",
                    "mine_key", "n_readings", rh(F.col("sum_value") / F.col("n_readings"), 3).alias("avg_value"),
                    "n_alarms")


@query("st_unified_timeline", ops=("ST-15", "SO-01"), sql=f"""
WITH {ALERTS_SQL}
SELECT equipment_id, ts, 'reading' AS source, sensor_type || '=' || CAST(value AS VARCHAR) AS text FROM {R}
WHERE value > 250
UNION ALL SELECT equipment_id, ts, 'alert', alert_level || ':' || CAST(rule_id AS VARCHAR) FROM alerts
""")
def st_unified_timeline(spark, d):
    s = _stream(spark, d)
    a = so.threshold_alerts(_stream(spark, d), rules_df(spark), "sensor_type", "value")
    t = (s.where(F.col("value") > 250).select("equipment_id", "ts", F.lit("reading").alias("source"),
                                              F.concat(F.col("sensor_type"), F.lit("="), F.col("value").cast("string")).alias("text"))
         .unionByName(a.select("equipment_id", "ts", F.lit("alert").alias("source"),
                               F.concat(F.col("alert_level"), F.lit(":"), F.col("rule_id").cast("string")).alias("text"))))
    out = sc.run_changelog(t, "st_timeline", "append")
    return sc.to_ntz(sc.read_changelog(spark, out))


@query("st_state_tracking", ops=("ST-16",), sql=f"""
WITH q AS (SELECT equipment_id, ts, reading_id,
                  CASE WHEN value > 300 THEN 'bad' WHEN value > 200 THEN 'suspect' ELSE 'good' END AS st FROM {R}),
l AS (SELECT *, lag(st) OVER w AS prev FROM q WINDOW w AS (PARTITION BY equipment_id ORDER BY ts, reading_id)),
c AS (SELECT * FROM l WHERE prev IS NULL OR prev <> st),
t AS (SELECT equipment_id, ts, prev AS previous_state, st AS new_state,
             lag(ts) OVER (PARTITION BY equipment_id ORDER BY ts, reading_id) AS since FROM c)
SELECT equipment_id, ts, previous_state, new_state, date_diff('microsecond', since, ts) // 1000000 AS seconds_in_previous
FROM t WHERE previous_state IS NOT NULL
""")
def st_state_tracking(spark, d):
    s = _stream(spark, d).withColumn("state", quality_flag("value"))
    t = so.state_transitions(s, ["equipment_id"], "ts", "reading_id", "state", sc.DELAY)
    out = sc.run_changelog(t, "st_state")
    return sc.to_ntz(sc.read_changelog(spark, out, ["reading_id"]).select(
        "equipment_id", "ts", "previous_state", "new_state", "seconds_in_previous"))


@query("st_chained_windows", ops=("ST-17", "TS-23", "AG-13"), sql=f"""
SELECT time_bucket(INTERVAL '1 hour', ts) AS hour, sensor_type, count(*) AS n, {rnd("avg(value)", 6)} AS avg_value,
       min(value) AS min_value, max(value) AS max_value
FROM {R} GROUP BY ALL
""")
def st_chained_windows(spark, d):
    # the 5-minute partials come from the streaming job; the hourly rollup
    # recombines sums and counts, so stream and batch averages agree (TS-23)
    five = so.window_aggregates(_stream(spark, d), ["sensor_type"], "ts", "value", "5 minutes", watermark=sc.DELAY)
    out = sc.run_changelog(five, "st_five", "update")
    partial = sc.read_changelog(spark, out, ["window", "sensor_type"])
    h = sc.to_ntz(so.chained_rollup(partial, ["sensor_type"], "1 hour"))
    return h.select(F.col("window.start").alias("hour"), "sensor_type", "n", rh("avg_value", 6).alias("avg_value"),
                    "min_value", "max_value")


@query("doc_running_totals", ops=("DOC-14", "SNK-04"), sql=f"""
SELECT equipment_id, sensor_type, count(*) AS n, {rnd("sum(value)", 2)} AS total, max(value) AS largest FROM {R} GROUP BY ALL
""")
def doc_running_totals(spark, d):
    # three deliveries out of order, the second added twice
    path = sc.run_totals(_stream(spark, d), "totals", KEYS, "value", again=[1])
    return table(spark, path).select(*KEYS, "n", rh("total", 2).alias("total"), "largest")

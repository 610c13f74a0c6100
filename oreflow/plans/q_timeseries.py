"""Registered time-series queries over the ``events`` telemetry binding."""

from __future__ import annotations

from pyspark.sql import functions as F

from oreflow.functions.classify import quality_flag
from oreflow.functions.numeric import round_half_up as rh
from oreflow.plans.sqlfmt import rnd
from oreflow.operators import joins, timeseries as ts
from oreflow.plans.registry import query
from oreflow.sources.tables import sensor_readings

KEYS = ["equipment_id", "sensor_type"]

# DuckDB view of the same binding, shared by the oracle statements
R = ("(SELECT event_id AS reading_id, user_id AS equipment_id, event_type AS sensor_type, "
     "value, ts, props AS payload FROM events)")
QF = ("CASE WHEN value > 300.0 THEN 'bad' WHEN value > 200.0 THEN 'suspect' "
      "ELSE 'good' END")


@query("ts_zscore_anomalies", ops=("TS-03", "AG-04", "JN-05", "PF-10", "SF-10"), bench=True, sql=f"""
WITH r AS {R},
s AS (SELECT equipment_id, sensor_type, avg(value) AS mean_val, stddev_samp(value) AS std_val
      FROM r GROUP BY equipment_id, sensor_type)
SELECT r.reading_id, r.ts, r.equipment_id, r.sensor_type,
       {rnd("r.value", 2)} AS value, {rnd("s.mean_val", 2)} AS mean, {rnd("s.std_val", 2)} AS stddev,
       {rnd("(r.value - s.mean_val) / nullif(s.std_val, 0)", 2)} AS z_score,
       CASE WHEN abs(r.value - s.mean_val) > 3 * s.std_val THEN 'critical' ELSE 'warning' END AS category
FROM r JOIN s ON r.equipment_id = s.equipment_id AND r.sensor_type = s.sensor_type
WHERE abs(r.value - s.mean_val) > 2 * s.std_val
""")
def ts_zscore_anomalies(spark, d):
    a = ts.zscore_anomalies(sensor_readings(spark, d), KEYS, "value")
    return a.select("reading_id", "ts", "equipment_id", "sensor_type",
                    rh("value", 2).alias("value"), rh("mean_val", 2).alias("mean"),
                    rh("std_val", 2).alias("stddev"), rh("z_score", 2).alias("z_score"),
                    "category")


@query("ts_zscore_top50", ops=("TS-03", "OL-03", "OL-04"), sql=f"""
WITH r AS {R},
s AS (SELECT equipment_id, sensor_type, avg(value) AS mean_val, stddev_samp(value) AS std_val
      FROM r GROUP BY equipment_id, sensor_type)
SELECT r.reading_id, r.equipment_id, r.sensor_type,
       {rnd("(r.value - s.mean_val) / nullif(s.std_val, 0)", 4)} AS z_score
FROM r JOIN s ON r.equipment_id = s.equipment_id AND r.sensor_type = s.sensor_type
WHERE abs(r.value - s.mean_val) > 2 * s.std_val
ORDER BY abs((r.value - s.mean_val) / nullif(s.std_val, 0)) DESC, r.reading_id
LIMIT 50
""")
def ts_zscore_top50(spark, d):
    # top-k report: the limit is the feature; ties broken by reading_id
    a = ts.zscore_anomalies(sensor_readings(spark, d), KEYS, "value")
    return (a.orderBy(F.abs("z_score").desc(), "reading_id").limit(50)
            .select("reading_id", "equipment_id", "sensor_type",
                    rh("z_score", 4).alias("z_score")))


@query("ts_bucket_stats_1h", ops=("TS-01", "TS-02", "AG-01", "SF-14"), bench=True, sql=f"""
WITH r AS (SELECT *, {QF} AS quality FROM {R})
SELECT time_bucket(INTERVAL '1 hour', ts) AS bucket, equipment_id, sensor_type,
       count(*) AS n_readings, {rnd("min(value)", 2)} AS min_value, {rnd("avg(value)", 2)} AS avg_value,
       {rnd("max(value)", 2)} AS max_value, {rnd("stddev_samp(value)", 2)} AS std_value,
       count(*) FILTER (WHERE quality <> 'good') AS n_not_good
FROM r GROUP BY ALL
""")
def ts_bucket_stats_1h(spark, d):
    r = sensor_readings(spark, d).withColumn("quality", quality_flag("value"))
    return ts.bucket_stats(r, KEYS, "ts", "value", "1 hour", quality="quality")


@query("ts_bucket_stats_week", ops=("TS-01", "SF-07"), sql=f"""
SELECT time_bucket(INTERVAL '1 week', ts) AS bucket, sensor_type,
       count(*) AS n_readings, {rnd("min(value)", 2)} AS min_value, {rnd("avg(value)", 2)} AS avg_value,
       {rnd("max(value)", 2)} AS max_value, {rnd("stddev_samp(value)", 2)} AS std_value
FROM {R} GROUP BY ALL
""")
def ts_bucket_stats_week(spark, d):
    # week buckets start on Monday (G7)
    return ts.bucket_stats(sensor_readings(spark, d), ["sensor_type"], "ts", "value", "1 week")


@query("ts_anomaly_counts_by_day", ops=("TS-05", "AG-07", "AG-09"), sql=f"""
WITH r AS {R},
s AS (SELECT equipment_id, sensor_type, avg(value) AS mean_val, stddev_samp(value) AS std_val
      FROM r GROUP BY equipment_id, sensor_type)
SELECT time_bucket(INTERVAL '1 day', r.ts) AS day, r.equipment_id,
       count(*) FILTER (WHERE abs(r.value - s.mean_val) > 2 * s.std_val) AS anomalies_2sigma,
       count(*) FILTER (WHERE abs(r.value - s.mean_val) > 3 * s.std_val) AS anomalies_3sigma,
       count(*) AS total_readings
FROM r JOIN s ON r.equipment_id = s.equipment_id AND r.sensor_type = s.sensor_type
GROUP BY ALL
HAVING count(*) FILTER (WHERE abs(r.value - s.mean_val) > 2 * s.std_val) > 0
""")
def ts_anomaly_counts_by_day(spark, d):
    return ts.anomaly_counts_by_day(sensor_readings(spark, d), KEYS, ["equipment_id"], "ts", "value")


@query("ts_rolling_zscore_alerts", ops=("TS-04", "WN-03", "WN-04", "JN-10"), bench=True, sql=f"""
WITH r AS {R},
a AS (SELECT reading_id, ts, equipment_id, sensor_type, value,
             avg(value) OVER w AS roll_avg, stddev_samp(value) OVER w AS roll_std
      FROM r WINDOW w AS (PARTITION BY equipment_id, sensor_type ORDER BY ts, reading_id
                          ROWS BETWEEN 23 PRECEDING AND CURRENT ROW)),
al AS (SELECT reading_id AS alert_id, ts AS alert_time, equipment_id, sensor_type
       FROM r WHERE value > 300)
SELECT a.reading_id, a.ts, a.equipment_id, a.sensor_type, {rnd("a.value", 2)} AS value,
       {rnd("a.roll_avg", 2)} AS rolling_avg,
       {rnd("(a.value - a.roll_avg) / nullif(a.roll_std, 0)", 2)} AS z_score,
       al.alert_id, al.alert_time
FROM a LEFT JOIN al ON a.equipment_id = al.equipment_id AND a.sensor_type = al.sensor_type
 AND a.ts BETWEEN al.alert_time - INTERVAL '30 minutes' AND al.alert_time + INTERVAL '30 minutes'
WHERE a.roll_std > 0 AND abs(a.value - a.roll_avg) > 2.5 * a.roll_std
""")
def ts_rolling_zscore_alerts(spark, d):
    r = sensor_readings(spark, d)
    # windows per (key, week) with halo rows: a hot sensor is spread over weeks
    anomalies = ts.rolling_zscore(r, KEYS, "ts", "value", n=24, k=2.5,
                                  order_tiebreak="reading_id", bucket_s=7 * 86400)
    alerts = r.where(F.col("value") > 300).select(
        F.col("reading_id").alias("alert_id"), F.col("ts").alias("alert_time"), *KEYS)
    j = joins.interval_join(
        anomalies.select("reading_id", "ts", *KEYS, "value", "roll_avg", "z_score"),
        alerts, KEYS, "ts", "alert_time", before_s=1800, after_s=1800,
        how="left", left_id="reading_id")
    return j.select("reading_id", "ts", *KEYS, rh("value", 2).alias("value"),
                    rh("roll_avg", 2).alias("rolling_avg"),
                    rh("z_score", 2).alias("z_score"), "alert_id", "alert_time")

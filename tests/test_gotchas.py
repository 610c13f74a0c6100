"""One test per answer-changing gotcha (G1..G21) on small own fixtures."""

import datetime as dt

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from oreflow.functions import timefn
from oreflow.functions.hashing import hash_key, row_hash
from oreflow.operators import aggregates as agg
from oreflow.operators import windows as wn


def ts(s):
    return dt.datetime.fromisoformat(s)


def test_g1_watermark_needs_timestamp(spark, sf_small):
    from oreflow.streaming.core import EVENTS_SCHEMA, event_stream, stream_table_dir
    raw = spark.readStream.schema(EVENTS_SCHEMA).parquet(stream_table_dir(sf_small, "events"))
    with pytest.raises(AnalysisException):
        raw.withWatermark("ts", "10 minutes").groupBy(F.window("ts", "5 minutes")).count().schema  # noqa: B018
    ok = event_stream(spark, stream_table_dir(sf_small, "events"))   # casts to TIMESTAMP
    assert ok.schema["ts"].dataType.simpleString() == "timestamp"
    ok.withWatermark("ts", "10 minutes").groupBy(F.window("ts", "5 minutes")).count().schema  # noqa: B018


def test_g2_guarded_division_does_not_raise(spark):
    from oreflow.functions.numeric import safe_div
    r = spark.createDataFrame([(1.0, 0.0), (4.0, 2.0)], "a double, b double").select(safe_div("a", "b").alias("q"))
    assert [x.q for x in r.orderBy("q").collect()] == [None, 2.0]


def test_g3_stddev_is_sample(spark):
    r = spark.createDataFrame([(1.0,), (2.0,), (3.0,), (4.0,)], "v double").agg(F.stddev("v")).first()[0]
    assert abs(r - 1.2909944487) < 1e-9


def test_g4_null_marker_keeps_positions(spark):
    df = spark.createDataFrame([("a", None), (None, "a")], "x string, y string")
    h = [r.h for r in df.select(row_hash("x", "y").alias("h")).collect()]
    assert h[0] != h[1]
    k = [r.k for r in df.select(hash_key("x", "y").alias("k")).collect()]
    assert k[0] != k[1]


def test_hash_input_cannot_be_shifted(spark):
    rows = [("a|b", "c"), ("a", "b|c"), ("a", "~"), ("a", None), ("a", " "), ("a", ""), ("1:a", "c")]
    df = spark.createDataFrame(rows, "x string, y string")
    assert df.select(row_hash("x", "y").alias("h")).distinct().count() == len(rows)


def test_g5_total_minutes_not_minute_field(spark):
    df = spark.createDataFrame([(ts("2024-01-01 08:00:00"), ts("2024-01-01 10:05:30"))], "a timestamp_ntz, b timestamp_ntz")
    assert df.select(timefn.minutes_between("a", "b")).first()[0] == pytest.approx(125.5)


def test_g6_epoch_seconds(spark):
    df = spark.createDataFrame([(ts("1970-01-02 00:00:01"),)], "t timestamp_ntz")
    assert df.select(timefn.epoch_seconds("t")).first()[0] == 86401.0


def test_g7_week_buckets_start_on_monday(spark):
    df = spark.createDataFrame([(ts("2024-01-04 12:00:00"),), (ts("2024-01-07 23:00:00"),)], "t timestamp_ntz")
    starts = {r.b for r in df.select(timefn.time_bucket("t", "1 week").alias("b")).collect()}
    assert starts == {ts("2024-01-01 00:00:00")}  # 2024-01-01 is a Monday


def test_g8_iso_week_and_weekday(spark):
    df = spark.createDataFrame([(dt.date(2025, 12, 29),), (dt.date(2025, 1, 5),)], "d date")
    p = timefn.calendar_parts("d")
    r = df.select(p["week_of_year"].alias("w"), p["day_of_week"].alias("dow"), p["is_weekend"].alias("we")).collect()
    assert (r[0].w, r[0].dow, r[0].we) == (1, 1, False)   # Monday of ISO week 1 of 2026
    assert (r[1].w, r[1].dow, r[1].we) == (1, 7, True)    # Sunday = 7


def test_g10_not_in_with_null_vs_left_anti(spark):
    a = spark.createDataFrame([(1,), (2,)], "k int")
    b = spark.createDataFrame([(1,), (None,)], "k int")
    a.createOrReplaceTempView("ga")
    b.createOrReplaceTempView("gb")
    assert spark.sql("SELECT * FROM ga WHERE k NOT IN (SELECT k FROM gb)").count() == 0
    assert [r.k for r in a.join(b, "k", "left_anti").collect()] == [2]


def test_g12_recombine_sums_not_averages(spark):
    parts = spark.createDataFrame([("x", 10.0, 1), ("x", 30.0, 3)], "k string, sum_value double, n long")
    r = agg.weighted_recombine(parts, ["k"], min_col=None, max_col=None).first()
    assert r.avg_value == 10.0          # (10 + 30) / 4, not (10 + 10) / 2


def test_g21_session_gap_boundary(spark):
    rows = [(1, ts("2024-01-01 00:00:00")), (1, ts("2024-01-01 00:09:59")),   # 9:59 -> same
            (1, ts("2024-01-01 00:19:59")),                                      # 10:00 -> same
            (1, ts("2024-01-01 00:30:00"))]                                      # 10:01 -> new
    df = spark.createDataFrame(rows, "k int, t timestamp_ntz")
    s = wn.sessions_by_gap(df, ["k"], "t", 600).orderBy("session_no").collect()
    assert [r.n_events for r in s] == [3, 1]
    assert s[0].session_end == ts("2024-01-01 00:19:59")   # last event, not last + gap
    # Spark's own session window agrees on the boundary
    sw = df.groupBy("k", F.session_window("t", "10 minutes")).count().orderBy("session_window").collect()
    assert [r["count"] for r in sw] == [3, 1]

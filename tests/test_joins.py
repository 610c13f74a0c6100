"""Join operators: bucketed interval join, range count, first-event and
point-in-time joins (exact edges, unmatched rows, no duplicates)."""

import datetime as dt

from pyspark.sql import functions as F

from oreflow.operators import joins

T = dt.datetime.fromisoformat


def test_interval_join_edges_and_left_rows(spark):
    left = spark.createDataFrame([(1, "A", T("2024-01-01 10:00:00")), (2, "A", T("2024-01-01 12:00:00")),
                                  (3, "B", T("2024-01-01 10:00:00"))], "rid int, k string, ts timestamp_ntz")
    right = spark.createDataFrame([(10, "A", T("2024-01-01 10:30:00")),     # exactly +30 min: match
                                   (11, "A", T("2024-01-01 09:30:00")),     # exactly -30 min: match
                                   (12, "A", T("2024-01-01 10:30:00.000001")),  # just outside
                                   (13, "B", T("2024-01-01 11:00:00"))], "aid int, k string, at timestamp_ntz")
    inner = joins.interval_join(left, right, ["k"], "ts", "at", 1800, 1800)
    assert sorted((r.rid, r.aid) for r in inner.collect()) == [(1, 10), (1, 11)]
    lj = joins.interval_join(left, right, ["k"], "ts", "at", 1800, 1800, how="left", left_id="rid")
    assert sorted((r.rid, r.aid) for r in lj.collect()) == [(1, 10), (1, 11), (2, None), (3, None)]
    # a narrow bucket width only changes the replication, not the answer
    lj2 = joins.interval_join(left, right, ["k"], "ts", "at", 1800, 1800, how="left", left_id="rid", bucket_s=60)
    assert sorted((r.rid, r.aid) for r in lj2.collect()) == [(1, 10), (1, 11), (2, None), (3, None)]


def test_range_count_keeps_empty_windows(spark):
    w = spark.createDataFrame([("A", T("2024-01-01 00:00:00"), T("2024-01-01 06:00:00")),
                               ("A", T("2024-01-01 06:00:00"), T("2024-01-02 06:00:00")),
                               ("B", T("2024-01-01 00:00:00"), T("2024-01-01 01:00:00"))],
                              "k string, s timestamp_ntz, e timestamp_ntz")
    ev = spark.createDataFrame([("A", T("2024-01-01 05:59:59")), ("A", T("2024-01-01 06:00:00")),
                                ("A", T("2024-01-01 23:00:00"))], "k string, t timestamp_ntz")
    r = {(x.k, x.s.hour): x.n_events for x in joins.range_count(w, ev, ["k"], "s", "e", "t").collect()}
    assert r == {("A", 0): 1, ("A", 6): 2, ("B", 0): 0}


def test_first_event_modes(spark):
    df = spark.createDataFrame([("A", T("2024-01-01 10:00:00"), "alarm"), ("A", T("2024-01-01 10:05:00"), "warn"),
                                ("A", T("2024-01-01 10:20:00"), "alarm"), ("A", T("2024-01-01 10:10:00"), "warn")],
                               "k string, ts timestamp_ntz, kind string")
    w, a = F.col("kind") == "warn", F.col("kind") == "alarm"

    def got(mode):
        return sorted((r.ts.minute, r.first_ts.minute) for r in
                      joins.first_event_before(df, ["k"], "ts", w, a, mode=mode).collect())
    assert got("first_any") == [(0, 5), (20, 5)]          # warning after the alarm still counts
    assert got("first_before") == [(20, 5)]
    assert got("latest_before") == [(20, 10)]


def test_point_in_time_join(spark):
    dim = spark.createDataFrame([("C1", "low", T("2024-01-01 00:00:00"), T("2024-02-01 00:00:00")),
                                 ("C1", "high", T("2024-02-01 00:00:00"), T("9999-12-31 00:00:00"))],
                                "k string, v string, f timestamp_ntz, t timestamp_ntz")
    fact = spark.createDataFrame([("C1", T("2024-01-31 23:59:59")), ("C1", T("2024-02-01 00:00:00"))],
                                 "k string, ts timestamp_ntz")
    r = sorted((x.ts.day, x.v) for x in joins.point_in_time_join(fact, dim, ["k"], "ts", "f", "t").collect())
    assert r == [(1, "high"), (31, "low")]

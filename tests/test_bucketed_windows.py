"""Bucketed (key, time bucket) windows must equal key-partitioned windows."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F
from pyspark.sql import Window

from oreflow.operators.windows import bucketed_neighbour, bucketed_window, rank_by_value, running_stats, sessions_by_gap


@pytest.fixture(scope="module")
def data(spark):
    rnd = random.Random(3)
    base = dt.datetime(2024, 1, 1)
    rows, rid = [], 0
    for key, n in [(1, 3000), (2, 7), (3, 1), (4, 60)]:           # one hot key, sparse keys
        for _ in range(n):
            rid += 1
            rows.append((key, base + dt.timedelta(seconds=rnd.randint(0, 20 * 86400)), rid, rnd.random() * 100))
    return spark.createDataFrame(rows, "k int, ts timestamp_ntz, rid int, v double")


@pytest.mark.parametrize("bucket_s", [3600, 86400, 5 * 86400])
def test_matches_plain_window(data, bucket_s):
    cols = {
        "ma5": lambda w: F.avg("v").over(w.rowsBetween(-4, 0)),
        "sd5": lambda w: F.stddev("v").over(w.rowsBetween(-4, 0)),
        "prev": lambda w: F.lag("v").over(w),
        "nxt": lambda w: F.lead("v").over(w),
        "c3": lambda w: F.count("v").over(w.rowsBetween(-1, 1)),
    }
    got = bucketed_window(data, ["k"], "ts", "rid", bucket_s, 4, 1, cols)
    wk = Window.partitionBy("k").orderBy("ts", "rid")
    want = data
    for name, fn in cols.items():
        want = want.withColumn(name, fn(wk))

    def rows(df):
        return sorted((r.rid, round(r.ma5, 9), None if r.sd5 is None else round(r.sd5, 9), r.prev, r.nxt, r.c3)
                      for r in df.select("rid", *cols).collect())
    assert rows(got) == rows(want)


@pytest.fixture(scope="module")
def hard(spark):
    """NULL keys, NULL times, ties, and one key with a third of all rows."""
    base = dt.datetime(2024, 1, 1)
    rows = [(1, base + dt.timedelta(minutes=7 * i), i, float(i % 5)) for i in range(40)]
    rows += [(None, base + dt.timedelta(hours=i), 100 + i, float(i)) for i in range(20)]
    rows += [(2 + i % 3, base + dt.timedelta(days=i % 4), 200 + i, 1.0) for i in range(40)]
    rows += [(1, None, 300, 9.0), (None, None, 301, 8.0), (None, None, 302, None), (7, None, 303, 7.0)]
    return spark.createDataFrame(rows, "k int, ts timestamp_ntz, rid int, v double")


def _rows(df, *cols):
    return sorted(map(str, df.select(*cols).collect()))


def test_null_keys_and_times_keep_their_rows(hard):
    w = Window.partitionBy("k").orderBy("ts", "rid")
    up = w.rowsBetween(Window.unboundedPreceding, 0)
    want = hard.select("rid", F.count(F.lit(1)).over(up).alias("seq_no"), F.sum("v").over(up).alias("running_sum"))
    got = running_stats(hard, ["k"], "ts", "rid", "v", bucket_s=3600)
    assert _rows(got, "rid", "seq_no", "running_sum") == _rows(want, "rid", "seq_no", "running_sum")
    lagged = bucketed_window(hard, ["k"], "ts", "rid", 3600, 1, 0, {"prev": lambda s: F.lag("v").over(s)})
    assert _rows(lagged, "rid", "prev") == _rows(hard.select("rid", F.lag("v").over(w).alias("prev")), "rid", "prev")


@pytest.mark.parametrize("bucket_s", [60, 3600, 10 ** 9])
@pytest.mark.parametrize("following", [False, True])
def test_neighbour_equals_plain_window(hard, bucket_s, following):
    w = Window.partitionBy("k").orderBy("ts", "rid")
    want = hard.withColumn("x", (F.lead if following else F.lag)("v").over(w))
    got = bucketed_neighbour(hard, ["k"], "ts", "rid", bucket_s, "v", "x", following)
    rows = lambda d: sorted(map(str, d.select("k", "ts", "rid", "x").collect()))
    assert rows(got) == rows(want)


def test_sessions_with_null_keys_and_times(hard):
    got = sessions_by_gap(hard, ["k"], "ts", 600, "rid", 3600)
    want = sessions_by_gap(hard, ["k"], "ts", 600, "rid")
    cols = ["k", "session_no", "session_start", "n_events"]
    assert _rows(got, *cols) == _rows(want, *cols)
    assert got.agg(F.sum("n_events")).first()[0] == hard.count()


@pytest.mark.parametrize("descending", [True, False])
def test_rank_by_value_with_nulls(hard, descending):
    o = F.col("v").desc() if descending else F.col("v").asc()
    want = hard.withColumn("r", F.rank().over(Window.partitionBy("k").orderBy(o)))
    assert _rows(rank_by_value(hard, ["k"], "v", "r", descending), "rid", "r") == _rows(want, "rid", "r")


def test_surrogate_keys_with_null_member(spark):
    from oreflow.operators.warehouse import add_surrogate_keys
    rows = spark.createDataFrame([(1,), (2,), (None,), (5,)], "bk int")
    assert sorted(r.sk for r in add_surrogate_keys(rows, None, ["bk"], "sk").collect()) == [1, 2, 3, 4]


def test_shortest_path_over_a_long_chain(spark):
    from oreflow.operators.graph import weighted_shortest
    e = spark.range(70).select(F.col("id").alias("src"), (F.col("id") + 1).alias("dst"), F.lit(1.5).alias("w"))
    got = weighted_shortest(e, spark.range(1).select("id"), "w")
    assert got.count() == 70 and got.agg(F.max("dist")).first()[0] == 105.0

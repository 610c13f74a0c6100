"""Structured Streaming behaviour across micro-batches (own fixtures)."""

import datetime as dt
import os
import random
import statistics

import pytest
from pyspark.sql import functions as F

from oreflow.streaming import core as sc
from oreflow.streaming import operators as so

SCHEMA = "event_id long, ts timestamp_ntz, user_id long, event_type string, value double, props string"
T = dt.datetime.fromisoformat


def _land(spark, landing, name, rows):
    spark.createDataFrame(rows, SCHEMA).coalesce(1).write.mode("overwrite").parquet(os.path.join(landing, name))


def _stream(spark, landing):
    return sc.event_stream(spark, os.path.join(landing, "*"))


def test_late_rows_go_to_side_output(spark, scratch):
    landing, out = os.path.join(scratch, "landing"), os.path.join(scratch, "out")
    _land(spark, landing, "b1", [(1, T("2024-01-01 09:00:00"), 1, "click", 1.0, "{}"),
                                 (2, T("2024-01-01 10:00:00"), 1, "click", 2.0, "{}")])
    ck = sc.run_with_late_side_output(_stream(spark, landing), "ts", 1800, out, ["reading_id"])
    _land(spark, landing, "b2", [(3, T("2024-01-01 09:31:00"), 1, "click", 3.0, "{}"),    # 29 min late
                                 (4, T("2024-01-01 09:29:00"), 1, "click", 4.0, "{}"),    # 31 min late
                                 (5, T("2024-01-03 10:00:00"), 1, "click", 5.0, "{}"),    # from the future
                                 (6, T("2024-01-01 10:05:00"), 1, "click", 6.0, "{}"),
                                 (6, T("2024-01-01 10:05:00"), 1, "click", 6.0, "{}")])   # duplicate id
    sc.run_with_late_side_output(_stream(spark, landing), "ts", 1800, out, ["reading_id"], checkpoint=ck)
    on_time = sorted(r.reading_id for r in spark.read.parquet(os.path.join(out, "on_time")).collect())
    late = [r.reading_id for r in spark.read.parquet(os.path.join(out, "late")).collect()]
    fut = [r.reading_id for r in spark.read.parquet(os.path.join(out, "future")).collect()]
    assert on_time == [1, 2, 3, 6] and late == [4] and fut == [5]


def test_window_state_survives_micro_batches(spark, scratch):
    landing = os.path.join(scratch, "landing")
    rows = [(i, T("2024-01-01 10:00:00") + dt.timedelta(minutes=i), 1, "click", float(i), "{}") for i in range(12)]
    _land(spark, landing, "b1", rows[:6])
    agg = so.window_aggregates(_stream(spark, landing), ["equipment_id"], "ts", "value", "5 minutes")
    out = sc.run_changelog(agg, "t-win", "update")
    _land(spark, landing, "b2", rows[6:])
    # a second stream on the same input gives the full answer in one go;
    # the changelog read keeps the latest version of every window
    out2 = sc.run_changelog(so.window_aggregates(_stream(spark, landing), ["equipment_id"], "ts", "value",
                                                 "5 minutes"), "t-win2", "update")
    first = {r.window.start: r.n for r in sc.read_changelog(spark, out, ["window", "equipment_id"]).collect()}
    full = {r.window.start: r.n for r in sc.read_changelog(spark, out2, ["window", "equipment_id"]).collect()}
    assert sum(first.values()) == 6 and sorted(full.values()) == [2, 5, 5]


def test_escalation_needs_three_warnings_in_15_minutes(spark, scratch):
    landing = os.path.join(scratch, "landing")
    base = T("2024-01-01 10:00:00")
    rows = [(1, base, 7, "click", 250.0, "{}"), (2, base + dt.timedelta(minutes=14), 7, "click", 250.0, "{}"),
            (3, base + dt.timedelta(minutes=16), 7, "click", 250.0, "{}"),       # 2 in window -> no
            (4, base + dt.timedelta(minutes=20), 7, "click", 250.0, "{}")]       # 14,16,20 -> escalate
    _land(spark, landing, "b1", rows)
    rules = spark.createDataFrame([(1, "click", "warning", "gt", None, 200.0, True)],
                                  "rule_id int, event_type string, alert_level string, condition_type string, "
                                  "threshold_low double, threshold_high double, is_active boolean")
    a = so.threshold_alerts(_stream(spark, landing), rules, "sensor_type", "value")
    out = sc.run_changelog(so.escalate_bursts(a, ["equipment_id"], "ts", "reading_id"), "t-esc")
    got = [(r.reading_id, r.n_in_window) for r in sc.read_changelog(spark, out, ["reading_id"]).collect()]
    assert got == [(4, 3)]


def test_ack_timer_fires_only_without_ack(spark, scratch):
    landing = os.path.join(scratch, "landing")
    b = T("2024-01-01 10:00:00")
    _land(spark, landing, "b1", [(1, b, 1, "click", 400.0, "{}"), (2, b + dt.timedelta(minutes=9), 1, "click", 10.0, "{}"),
                                 (3, b, 2, "click", 400.0, "{}"), (4, b + dt.timedelta(minutes=11), 2, "click", 10.0, "{}")])
    s = _stream(spark, landing)
    ev = s.withColumn("kind", F.when(F.col("value") > 300, "critical").when(F.col("value") <= 200, "ack"))
    ev = ev.where(F.col("kind").isNotNull())
    ck = sc.scratch_path(spark, "t-ack-ckpt")
    out = sc.scratch_path(spark, "t-ack-out")

    def run():
        q = (so.ack_timer(ev, ["equipment_id"], "ts", "kind", 600, "5 minutes").writeStream
             .option("checkpointLocation", ck).outputMode("update")
             .foreachBatch(lambda df, i: df.write.mode("append").parquet(out)))
        sc.run_stream(q, spark)
    run()
    # a later event moves the watermark past both deadlines
    _land(spark, landing, "b2", [(9, b + dt.timedelta(hours=2), 3, "view", 1.0, "{}")])
    run()
    _land(spark, landing, "b3", [(10, b + dt.timedelta(hours=3), 3, "view", 1.0, "{}")])
    run()
    fired = sorted(r.equipment_id for r in spark.read.parquet(out).collect())
    assert fired == [2]


def test_moving_stats_across_batches_equal_batch_window(spark, scratch):
    from pyspark.sql import Window
    landing = os.path.join(scratch, "landing")
    rows = [(i, T("2024-01-01 00:00:00") + dt.timedelta(minutes=i), 1, "view", float(i * i % 7), "{}") for i in range(10)]
    _land(spark, landing, "b1", rows[:4])
    ck = sc.scratch_path(spark, "t-ms-ckpt")
    out = sc.scratch_path(spark, "t-ms-out")

    def run():
        m = so.moving_stats(_stream(spark, landing), ["equipment_id"], "ts", "reading_id", "value", 3)
        q = (m.writeStream.option("checkpointLocation", ck).outputMode("update")
             .foreachBatch(lambda df, i: df.write.mode("append").parquet(out)))
        sc.run_stream(q, spark)
    run()
    _land(spark, landing, "b2", rows[4:])
    run()
    got = {r.reading_id: round(r.ma, 9) for r in spark.read.parquet(out).collect()}
    batch = spark.createDataFrame(rows, SCHEMA)
    w = Window.partitionBy("user_id").orderBy("ts").rowsBetween(-2, 0)
    want = {r.event_id: round(r.ma, 9) for r in batch.select("event_id", F.avg("value").over(w).alias("ma")).collect()}
    assert got == want


@pytest.fixture(scope="module")
def disorder(spark):
    """Readings of a few sensors (one of them with a third of all rows) that arrive
    up to 12 hours late in five deliveries, and their landing folder."""
    rnd = random.Random(3)
    base = T("2024-01-01 00:00:00")
    rows = []
    for i in range(900):
        at = base + dt.timedelta(seconds=rnd.randrange(4 * 86400) if i % 9 else 60 * i)
        rows.append((i, at, 1 if i % 3 == 0 else rnd.randrange(2, 30), "click", rnd.choice([1.0, 250.0, 400.0, None]), "{}"))
    arrival = sorted(rows, key=lambda r: (r[1] + dt.timedelta(seconds=rnd.randrange(12 * 3600)), r[0]))
    landing = sc.scratch_path(spark, "disorder")
    for k in range(5):
        part = arrival[k * 180:(k + 1) * 180]
        spark.createDataFrame(part, SCHEMA).coalesce(1).write.mode("append").parquet(landing)
    return rows, landing


def _feed(spark, landing):
    return sc.event_stream(spark, landing, max_files_per_trigger=1)


def _by_key(rows):
    out = {}
    for r in sorted(rows, key=lambda r: (r[1], r[0])):
        out.setdefault(r[2], []).append(r)
    return out


def test_sessions_do_not_depend_on_arrival(spark, disorder):
    rows, landing = disorder
    out = sc.run_changelog(so.session_windows(_feed(spark, landing), ["equipment_id"], "ts", 3600, "13 hours"), "t-ses")
    got = sorted((r.equipment_id, r.session_start, r.last_event, r.n_events)
                 for r in sc.read_changelog(spark, out, ["equipment_id", "session_start"]).collect())
    want = []
    for k, own in _by_key(rows).items():
        run = []
        for r in own:
            if run and (r[1] - run[-1]).total_seconds() > 3600:
                want.append((k, run[0], run[-1], len(run)))
                run = []
            run.append(r[1])
        want.append((k, run[0], run[-1], len(run)))
    assert got == sorted(want) and out.late_rows == 0
    assert spark.read.parquet(out).where("deleted").count() > 0      # some were joined later


def test_moving_stats_and_bursts_do_not_depend_on_arrival(spark, disorder):
    rows, landing = disorder
    out = sc.run_changelog(so.moving_stats(_feed(spark, landing), ["equipment_id"], "ts", "reading_id", "value", 4, "13 hours"), "t-mov")
    got = {r.reading_id: (r.ma, r.mstd) for r in sc.read_changelog(spark, out, ["reading_id"]).collect()}
    assert len(got) == len(rows)
    for own in _by_key(rows).values():
        for i, r in enumerate(own):
            w = [x[4] for x in own[max(0, i - 3):i + 1] if x[4] is not None]
            ma, sd = got[r[0]]
            assert (ma is None) == (not w) and (sd is None) == (len(w) < 2)
            assert not w or abs(ma - statistics.mean(w)) < 1e-9
            assert len(w) < 2 or abs(sd - statistics.stdev(w)) < 1e-9
    alerts = _feed(spark, landing).where("value > 200").withColumn("alert_level", F.lit("warning"))
    out = sc.run_changelog(so.escalate_bursts(alerts, ["equipment_id"], "ts", "reading_id", "warning", 7200, 3, "13 hours"), "t-bur")
    got = {r.reading_id: r.n_in_window for r in sc.read_changelog(spark, out, ["reading_id"]).collect()}
    want = {}
    for own in _by_key([r for r in rows if r[4] and r[4] > 200]).values():
        for r in own:
            n = sum(0 <= (r[1] - x[1]).total_seconds() <= 7200 for x in own)
            if n >= 3:
                want[r[0]] = n
    assert got == want and want


def test_state_changes_do_not_depend_on_arrival(spark, disorder):
    rows, landing = disorder
    s = _feed(spark, landing).withColumn("state", F.when(F.col("value") > 300, "bad").when(F.col("value") > 200, "odd").otherwise("good"))
    s = s.withColumn("state", F.when(F.col("value").isNotNull(), F.col("state")))
    out = sc.run_changelog(so.state_transitions(s, ["equipment_id"], "ts", "reading_id", "state", "13 hours"), "t-tra")
    got = {r.reading_id: (r.previous_state, r.new_state, r.seconds_in_previous)
           for r in sc.read_changelog(spark, out, ["reading_id"]).collect()}
    want = {}
    for own in _by_key([r for r in rows if r[4] is not None]).values():
        state = since = None
        for r in own:
            now = "bad" if r[4] > 300 else "odd" if r[4] > 200 else "good"
            if state and now != state:
                want[r[0]] = (state, now, int((r[1] - since).total_seconds()))
            if now != state:
                state, since = now, r[1]
    assert got == want


def test_rows_behind_the_watermark_are_counted(spark, disorder):
    rows, _ = disorder
    landing, latest_first = sc.scratch_path(spark, "latest-first"), sorted(rows, key=lambda r: r[1], reverse=True)
    for k in range(3):
        spark.createDataFrame(latest_first[k * 300:(k + 1) * 300], SCHEMA).coalesce(1).write.mode("append").parquet(landing)
    out = sc.run_changelog(so.session_windows(_feed(spark, landing), ["equipment_id"], "ts", 3600, "10 minutes"), "t-late")
    taken = sc.read_changelog(spark, out, ["equipment_id", "session_start"]).agg(F.sum("n_events")).first()[0]
    # a row is held against the watermark in force in the micro-batch before its own
    assert out.late_rows == 300 and taken == 600


def test_answers_may_arrive_before_their_alarm(spark, disorder):
    rows, landing = disorder
    kind = F.when(F.col("value") > 300, "critical").when(F.col("value") <= 200, "ack")
    t = so.ack_timer(_feed(spark, landing).withColumn("kind", kind), ["equipment_id"], "ts", "kind", 3600, "13 hours")
    out = sc.run_changelog(t, "t-ack")
    got = sorted((r.equipment_id, r.alert_time) for r in sc.read_changelog(spark, out).collect())
    wait, rated = dt.timedelta(hours=1), [r for r in rows if r[4] is not None and (r[4] > 300 or r[4] <= 200)]
    end = max(r[1] for r in rated) - dt.timedelta(hours=13)
    want = [(k, r[1]) for k, own in _by_key(rated).items() for r in own if r[4] > 300 and r[1] + wait < end
            and not any(x[4] <= 200 and r[1] <= x[1] <= r[1] + wait for x in own)]
    assert got == sorted(want) and want


def test_a_changelog_of_no_batch_is_empty_and_other_failures_are_errors(spark, scratch):
    assert sc.read_changelog(spark, scratch, schema="a int").count() == 0
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        sc.read_changelog(spark, scratch)


def test_state_does_not_grow_with_the_number_of_keys(spark, scratch):
    landing, base = os.path.join(scratch, "landing"), T("2024-01-01 10:00:00")
    rows = [(2 * k + i, base + dt.timedelta(minutes=k % 50 + 10 * i), k or None, "click" if k % 3 else None, float(k + i), "{}")
            for k in range(3000) for i in range(2)]
    _land(spark, landing, "b1", rows)
    m = so.moving_stats(_stream(spark, landing), ["equipment_id", "sensor_type"], "ts", "reading_id", "value", 2, "1 hour")
    out = sc.scratch_path(spark, "t-keys-out")
    q = (m.writeStream.option("checkpointLocation", sc.scratch_path(spark, "t-keys-ckpt")).outputMode("update")
         .foreachBatch(lambda df, i: df.write.mode("append").parquet(out)).trigger(availableNow=True).start())
    q.awaitTermination()
    # one state and its timer for a bucket of keys, not for each key
    assert 0 < max(o.numRowsTotal for p in q.recentProgress for o in p.stateOperators) < 3000
    got = {r.reading_id: (r.equipment_id, r.sensor_type, r.ma) for r in spark.read.parquet(out).collect()}
    assert got == {r[0]: (r[2], r[3], r[4] - r[0] % 2 / 2) for r in rows}

"""Writers (no MERGE on Parquet: staged rewrites) and file sources."""

import datetime as dt
import os

import pytest
from pyspark.sql import functions as F

from oreflow.sinks import writers as w
from oreflow.sources import files

T = dt.datetime.fromisoformat


def test_overwrite_append_insert_if_absent(spark, scratch):
    p = os.path.join(scratch, "t")
    w.overwrite(spark.createDataFrame([(1, "a")], "k int, v string"), p)
    w.append(spark.createDataFrame([(2, "b")], "k int, v string"), p)
    inc = spark.createDataFrame([(2, "x"), (3, "c")], "k int, v string")
    w.insert_if_absent(spark, inc, p, ["k"])
    w.insert_if_absent(spark, inc, p, ["k"])           # rerun adds nothing
    assert sorted(map(tuple, w.table(spark, p).collect())) == [(1, "a"), (2, "b"), (3, "c")]


def test_upsert_last_write_wins_partitioned(spark, scratch):
    p = os.path.join(scratch, "u")
    base = spark.createDataFrame([(1, "d1", "old", 1), (2, "d1", "keep", 1), (3, "d2", "other", 1)],
                                 "k int, day string, v string, ver int")
    w.overwrite(base, p, ["day"])
    ch = spark.createDataFrame([(1, "d1", "new", 2), (1, "d1", "older", 0), (4, "d1", "add", 1)],
                               "k int, day string, v string, ver int")
    w.upsert(spark, ch, p, ["k"], F.col("ver"), partition_by=["day"])
    got = {r.k: r.v for r in w.table(spark, p).collect()}
    assert got == {1: "new", 2: "keep", 3: "other", 4: "add"}


def test_upsert_first_load_and_key_that_moves(spark, scratch):
    p, cols = os.path.join(scratch, "um"), "k int, day string, v string, ver int"
    first = [(1, "d1", "old", 1), (1, "d1", "new", 2), (2, "d2", "x", 1), (None, "d3", "n", 1)]
    w.upsert(spark, spark.createDataFrame(first, cols), p, ["k"], F.col("ver"), partition_by=["day"])
    assert {(r.k, r.v) for r in w.table(spark, p).collect()} == {(1, "new"), (2, "x"), (None, "n")}
    ch = [(2, "d1", "moved", 2), (None, "d1", "m", 2)]
    w.upsert(spark, spark.createDataFrame(ch, cols), p, ["k"], F.col("ver"), partition_by=["day"])
    got = [(r.k, r.day, r.v) for r in w.table(spark, p).collect()]
    assert sorted(got, key=str) == sorted([(1, "d1", "new"), (2, "d1", "moved"), (None, "d1", "m")], key=str)


def test_update_and_delete(spark, scratch):
    p = os.path.join(scratch, "ud")
    w.overwrite(spark.createDataFrame([(1, "a", 10), (2, "b", 20), (3, None, 30)], "k int, t string, n int"), p)
    w.update_table(spark, p, {"n": F.col("n") + 1, "t": F.lit("z")}, F.col("k") >= 2)
    w.delete_where(spark, p, F.col("t") == "a")
    assert sorted(map(tuple, w.table(spark, p).collect())) == [(2, "z", 21), (3, "z", 31)]


def test_time_partitions_retention_and_tiers(spark, scratch):
    raw, roll = os.path.join(scratch, "raw"), os.path.join(scratch, "roll")
    rows = [(1, T("2024-01-01 10:00:00"), 1.0), (1, T("2024-01-01 10:30:00"), 3.0), (1, T("2024-02-20 10:00:00"), 5.0)]
    df = spark.createDataFrame(rows, "k int, ts timestamp_ntz, v double")
    w.write_time_partitioned(df, raw, "ts", "month")
    parts = w._state(spark, raw)["parts"]
    assert sorted(p.split("/")[1] for p in parts) == ["chunk=2024-01", "chunk=2024-02"]
    w.tiered_retention(spark, raw, roll, "ts", ["k"], "v", "2024-02-01 00:00:00")
    assert w.table(spark, raw).count() == 1
    r = w.table(spark, roll).first()
    assert (r.n, r.sum_value) == (2, 4.0)
    w.write_time_partitioned(df, raw, "ts", "month", mode="overwrite")
    w.retention(spark, raw, "chunk", "2024-02")
    assert sorted(r.chunk for r in w.table(spark, raw).select("chunk").distinct().collect()) == ["2024-02"]


class Crash(Exception):
    pass


def _crash(*_):
    raise Crash


def test_a_failure_before_the_pointer_leaves_the_old_table(spark, scratch, monkeypatch):
    p = os.path.join(scratch, "safe")
    rows = lambda: sorted(map(tuple, w.table(spark, p).collect()))
    w.overwrite(spark.createDataFrame([(1, "d1", 10), (2, "d1", 20), (3, "d2", 30)], "k int, day string, n int"), p, ["day"])
    before = rows()
    change = spark.createDataFrame([(2, "d2", 99)], "k int, day string, n int")
    steps = [lambda: w.upsert(spark, change, p, ["k"], F.col("n"), ["day"]), lambda: w.delete_where(spark, p, F.col("k") == 1),
             lambda: w.update_table(spark, p, {"n": F.lit(0)}, F.col("k") > 1), lambda: w.append(change, p),
             lambda: w.retention(spark, p, "day", "d2")]
    with monkeypatch.context() as m:
        m.setattr(w, "_point", _crash)
        for step in steps:
            with pytest.raises(Crash):
                step()
            assert rows() == before
    w.upsert(spark, change, p, ["k"], F.col("n"), ["day"])
    assert {r.k: (r.day, r.n) for r in w.table(spark, p).collect()} == {1: ("d1", 10), 2: ("d2", 99), 3: ("d2", 30)}
    assert w.vacuum(spark, p) >= 5 and len(rows()) == 3
    held = w.table(spark, p)
    w.delete_where(spark, p, F.col("k") == 1)
    assert held.count() == 3 and w.table(spark, p).count() == 2        # a reader keeps the state it began with


def test_a_repeated_batch_changes_nothing(spark, scratch):
    p = os.path.join(scratch, "batch")
    df = spark.createDataFrame([(1, 1)], "k int, n int")
    for _ in range(2):
        w.append(df, p, batch="load-1")
        w.update_table(spark, p, {"n": F.col("n") + 1}, F.col("k") == 1, batch="raise-1")
    assert [tuple(r) for r in w.table(spark, p).collect()] == [(1, 2)]


def test_retention_tiers_after_a_failure_between_the_steps(spark, scratch, monkeypatch):
    raw, roll = os.path.join(scratch, "raw2"), os.path.join(scratch, "roll2")
    rows = [(1, T("2024-01-01 10:00:00"), 1.0), (1, T("2024-02-20 10:00:00"), 5.0), (1, None, 7.0)]
    schema = "k int, ts timestamp_ntz, v double"
    w.overwrite(spark.createDataFrame(rows, schema), raw)
    run = lambda: w.tiered_retention(spark, raw, roll, "ts", ["k"], "v", "2024-02-01 00:00:00")
    real = w._point
    with monkeypatch.context() as m:
        m.setattr(w, "_point", lambda spark, path, state: _crash() if path == raw else real(spark, path, state))
        with pytest.raises(Crash):
            run()
    assert w.table(spark, roll).count() == 1 and w.table(spark, raw).count() == 3
    run()
    run()
    assert w.table(spark, roll).agg(F.sum("n")).first()[0] == 1 and w.table(spark, raw).count() == 2
    # an old row that comes later is rolled up too, not lost
    w.append(spark.createDataFrame([(1, T("2024-01-01 10:10:00"), 3.0)], schema), raw)
    run()
    assert w.table(spark, roll).agg(F.sum("n")).first()[0] == 2 and w.table(spark, raw).count() == 2


def test_refresh_rollup_replaces_only_window_days(spark, scratch):
    p = os.path.join(scratch, "hourly")
    src = spark.createDataFrame([(1, T("2024-01-01 10:05:00"), 1.0), (1, T("2024-01-02 11:00:00"), 2.0)],
                                "k int, ts timestamp_ntz, v double")
    w.refresh_rollup(spark, src, p, "ts", ["k"], "v", "2024-01-03 00:00:00", 3 * 86400, 0)
    more = src.unionByName(spark.createDataFrame([(1, T("2024-01-02 11:30:00"), 4.0)], "k int, ts timestamp_ntz, v double"))
    w.refresh_rollup(spark, more, p, "ts", ["k"], "v", "2024-01-03 00:00:00", 86400, 0)
    got = {(str(r.day), r.n) for r in w.table(spark, p).collect()}
    assert got == {("2024-01-01", 1), ("2024-01-02", 2)}


def test_csv_keeps_corrupt_rows(spark, scratch):
    p = os.path.join(scratch, "in.csv")
    os.makedirs(scratch, exist_ok=True)
    with open(p, "w", encoding="utf-8") as f:
        f.write("equipment_id,engine_hours\nEQ-001,12.5\nEQ-002,not-a-number\n")
    df = files.read_csv(spark, p, "equipment_id string, engine_hours double")
    rows = sorted(df.collect(), key=lambda r: r.equipment_id)
    assert rows[0]._corrupt_record is None and rows[1]._corrupt_record.startswith("EQ-002")


def test_json_and_xml_documents(spark, scratch):
    os.makedirs(scratch, exist_ok=True)
    jp = os.path.join(scratch, "docs.json")
    with open(jp, "w", encoding="utf-8") as f:
        f.write('[{"id": "EQ-1", "sensors": [{"id": "S1"}]}, {"id": "EQ-2", "sensors": []}]')
    j = files.read_json_documents(spark, jp, "id string, sensors array<struct<id:string>>")
    assert sorted((r.id, len(r.sensors)) for r in j.collect()) == [("EQ-1", 1), ("EQ-2", 0)]
    xp = os.path.join(scratch, "eq.xml")
    with open(xp, "w", encoding="utf-8") as f:
        f.write('<fleet xmlns="urn:x"><equipment id="PDM-001"><model>LH517</model>'
                '<payload unit="t">17.2</payload></equipment><equipment id="PDM-002"><model>R1700</model>'
                '<payload unit="t">15</payload></equipment></fleet>')
    x = files.read_xml(spark, xp, "equipment").orderBy("_id").collect()
    assert [(r._id, r.model, r.payload._VALUE, r.payload._unit) for r in x] == [
        ("PDM-001", "LH517", 17.2, "t"), ("PDM-002", "R1700", 15.0, "t")]


def test_series_and_inline(spark):
    r = files.inline_rows(spark, [(T("2024-01-01 00:00:00"), T("2024-01-03 00:00:00"))], "lo timestamp_ntz, hi timestamp_ntz")
    assert files.date_series(r, "lo", "hi").count() == 3
    assert files.id_series(spark, 0, 10, 2).count() == 10

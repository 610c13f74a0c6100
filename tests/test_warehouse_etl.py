"""ETL, SCD and vault behaviour on own fixtures (G13..G16, idempotency)."""

import datetime as dt

from pyspark.sql import functions as F

from oreflow.operators import etl, vault
from oreflow.operators import warehouse as wh

D = dt.datetime.fromisoformat
DIM = "op_id string, grade int, mine string, effective_from timestamp_ntz, effective_to timestamp_ntz, is_current boolean"


def _check_scd2(dim):
    rows = dim.orderBy("op_id", "effective_from").collect()
    by = {}
    for r in rows:
        by.setdefault(r.op_id, []).append(r)
    for k, vs in by.items():
        assert sum(v.is_current for v in vs) == 1, k                       # one current version
        for a, b in zip(vs, vs[1:]):
            assert a.effective_to == b.effective_from, k                     # no gap, no overlap
        assert vs[-1].is_current and vs[-1].effective_to == D("9999-12-31 00:00:00")
    return by


def test_scd2_stress(spark):
    current = spark.createDataFrame([
        ("OP-007", 4, "M1", D("2024-01-01 00:00:00"), D("9999-12-31 00:00:00"), True),
        ("OP-008", 3, None, D("2024-01-01 00:00:00"), D("9999-12-31 00:00:00"), True),
        ("OP-009", 2, "M2", D("2024-01-01 00:00:00"), D("9999-12-31 00:00:00"), True),
    ], DIM)
    inc = spark.createDataFrame([
        ("OP-007", 5, "M1", D("2024-02-01 00:00:00")),   # grade 4 -> 5
        ("OP-007", 4, "M1", D("2024-03-01 00:00:00")),   # and back to 4 in the same batch
        ("OP-008", 3, None, D("2024-02-01 00:00:00")),   # re-sent unchanged (NULL mine)
        ("OP-010", 1, "M9", D("2024-02-01 00:00:00")),   # new key, unknown mine kept (G14)
    ], "op_id string, grade int, mine string, change_ts timestamp_ntz")
    out = wh.scd2_apply(current, inc, ["op_id"], ["grade", "mine"], F.lit(None))
    by = _check_scd2(out)
    assert [v.grade for v in by["OP-007"]] == [4, 5, 4]
    assert len(by["OP-008"]) == 1 and len(by["OP-009"]) == 1 and len(by["OP-010"]) == 1
    # replaying the same batch changes nothing (idempotent)
    again = wh.scd2_apply(out, inc, ["op_id"], ["grade", "mine"], F.lit(None))
    assert sorted(map(tuple, again.collect())) == sorted(map(tuple, out.collect()))


def test_scd2_only_tracked_columns_open_versions(spark):
    # G13: a change in an untracked column does not open a version
    current = spark.createDataFrame([("OP-1", 4, "M1", D("2024-01-01 00:00:00"), D("9999-12-31 00:00:00"), True)], DIM)
    inc = spark.createDataFrame([("OP-1", 4, "M2", D("2024-02-01 00:00:00"))],
                                "op_id string, grade int, mine string, change_ts timestamp_ntz")
    out = wh.scd2_apply(current, inc, ["op_id"], ["grade"], F.lit(None))
    assert out.count() == 1


def test_insert_if_absent_is_keyed_on_business_key(spark):
    # G15: re-running an insert-if-absent load adds nothing
    target = spark.createDataFrame([("EQ-1", "a")], "k string, v string")
    inc = spark.createDataFrame([("EQ-1", "b"), ("EQ-2", "c"), ("EQ-2", "d")], "k string, v string")
    new = wh.insert_if_absent(target, inc, ["k"], order_by=F.col("v"))
    assert [(r.k, r.v) for r in new.collect()] == [("EQ-2", "c")]
    t2 = target.unionByName(new)
    assert wh.insert_if_absent(t2, inc, ["k"]).count() == 0


def test_incremental_extract_overlap_and_rerun(spark):
    # G16: overlap re-reads rows at/near the watermark; de-duplicated; rerun adds 0
    src = spark.createDataFrame([
        ("PRD-015", D("2024-02-10 10:00:00")), ("PRD-016", D("2024-02-10 12:00:00")),
        ("PRD-017", D("2024-02-10 12:03:00")), ("PRD-016", D("2024-02-10 12:04:00")),
    ], "id string, updated_at timestamp_ntz")
    target = spark.createDataFrame([("PRD-015",)], "id string")
    wm = F.lit(D("2024-02-10 12:00:00"))
    ext = etl.incremental_extract(src, wm, "updated_at", ["id"], overlap_s=300)
    rows = {r.id: r.updated_at for r in ext.collect()}
    assert rows == {"PRD-016": D("2024-02-10 12:04:00"), "PRD-017": D("2024-02-10 12:03:00")}
    new = etl.new_rows_only(ext, target, ["id"])
    assert new.count() == 2
    assert etl.new_rows_only(ext, target.unionByName(new.select("id")), ["id"]).count() == 0


def test_change_detection_types(spark):
    prev = spark.createDataFrame([(1, "a"), (2, "b"), (3, "c")], "k int, v string")
    cur = spark.createDataFrame([(2, "b"), (3, "x"), (4, "d")], "k int, v string")
    t = {r.k: r.change_type for r in etl.change_detection(prev, cur, ["k"], ["v"]).collect()}
    assert t == {1: "deleted", 2: "unchanged", 3: "changed", 4: "new"}


def test_load_log_latest_state_and_failure(spark):
    log = (etl.log_event(spark, 1, "t", "full", "running", at=D("2024-01-01 00:00:00"))
           .unionByName(etl.log_event(spark, 1, "t", "full", "completed", 10, 9, 1, at=D("2024-01-01 00:06:00")))
           .unionByName(etl.log_event(spark, 2, "t", "incremental", "running", at=D("2024-01-02 00:00:00")))
           .unionByName(etl.log_event(spark, 2, "t", "incremental", "failed", error="boom", at=D("2024-01-02 00:01:00"))))
    st = {r.load_id: r for r in etl.load_state(log).collect()}
    assert st[1].status == "completed" and st[2].status == "failed"
    h = {r.load_id: r for r in etl.load_health(log).collect()}
    assert h[1].duration_s == 360 and h[1].duration_alarm


def test_load_plan_dependency_order():
    tables = [{"name": "fact", "load_priority": 3, "dependencies": ["dim_a", "dim_b"]},
              {"name": "dim_b", "load_priority": 2, "dependencies": ["dim_a"]},
              {"name": "dim_a", "load_priority": 1}]
    assert etl.load_plan(tables) == ["dim_a", "dim_b", "fact"]


def test_junk_dimension_new_combination_later(spark):
    f1 = spark.createDataFrame([("a", "x"), ("a", "y")], "t string, c string")
    j1 = wh.junk_dimension(f1, ["t", "c"], None, "jk")
    f2 = spark.createDataFrame([("a", "x"), ("b", "x")], "t string, c string")
    j2 = wh.junk_dimension(f2, ["t", "c"], j1, "jk")
    assert sorted((r.t, r.c, r.jk) for r in j2.collect()) == [("a", "x", 1), ("a", "y", 2), ("b", "x", 3)]


def test_vault_reload_adds_nothing_and_satellite_end_dates(spark):
    ld1, ld2 = F.lit("2024-01-01 00:00:00"), F.lit("2024-02-01 00:00:00")
    src = spark.createDataFrame([("OP-1", "M1", 4), ("OP-2", None, 3)], "op string, mine string, grade int")
    h = vault.hub_rows(src, "op", "hk", ld1, "crm")
    assert vault.insert_new(h, vault.hub_rows(src, "op", "hk", ld2, "crm"), "hk").count() == 0
    link = vault.link_rows(src, ["op", "mine"], "lk", ["op_hk", "mine_hk"], ld1, "crm")
    assert link.count() == 2                        # the NULL member still yields one link
    s1 = vault.satellite_load(None, vault.satellite_rows(src, "op", "hk", ["grade"], ld1, "crm"), "hk")
    changed = spark.createDataFrame([("OP-1", "M1", 5), ("OP-2", None, 3)], "op string, mine string, grade int")
    s2 = vault.satellite_load(s1, vault.satellite_rows(changed, "op", "hk", ["grade"], ld2, "crm"), "hk")
    assert s2.count() == 3                          # only the changed attribute adds a row
    assert vault.current_satellite(s2).count() == 2
    s3 = vault.satellite_load(s2, vault.satellite_rows(changed, "op", "hk", ["grade"], ld2, "crm"), "hk")
    assert s3.count() == 3                          # reload adds nothing


def test_surrogate_keys_dense_and_stable(spark):
    d = spark.createDataFrame([(30,), (10,), (20,)], "k long")
    a = {r.k: r.sk for r in wh.add_surrogate_keys(d, None, ["k"], "sk").collect()}
    assert a == {10: 1, 20: 2, 30: 3}
    ex = spark.createDataFrame([(5, 7)], "k long, sk long")
    b = {r.k: r.sk for r in wh.add_surrogate_keys(d, ex, ["k"], "sk").collect()}
    assert b == {10: 8, 20: 9, 30: 10}

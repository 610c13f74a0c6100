"""As-of joins over a hot key, late SCD2 changes, dense numbers and paths, each
against a plain version in Python."""

import datetime as dt
import itertools
import random

import pytest
from pyspark.sql import functions as F

from oreflow.operators import graph as g
from oreflow.operators import joins
from oreflow.operators import warehouse as wh
from oreflow.operators.numbering import dense_numbers

BASE = dt.datetime(2024, 1, 1)
OPEN = dt.datetime(9999, 12, 31)


@pytest.fixture(scope="module")
def versions():
    """Versions of a few keys without overlaps, some with gaps, one key with most of them."""
    rnd, rows = random.Random(5), []
    for k, n in [(1, 200), (2, 3), (3, 1), (5, 8)]:
        cuts = sorted(rnd.sample(range(0, 400 * 24), n + 1))
        for i, (a, b) in enumerate(zip(cuts, cuts[1:])):
            if rnd.random() < 0.9:
                rows.append((k, f"v{k}-{i}", BASE + dt.timedelta(hours=a), BASE + dt.timedelta(hours=b)))
    return rows


def test_point_in_time_join_with_a_hot_key(spark, versions):
    rnd = random.Random(6)
    facts = [(i, 1 if i % 3 else rnd.choice([2, 3, 4, 5]), BASE + dt.timedelta(hours=rnd.randrange(-50, 420 * 24))) for i in range(900)]
    facts += [(900, 1, None), (901, None, BASE), (902, 1, versions[3][2]), (903, 1, versions[3][3])]
    f = spark.createDataFrame(facts, "id int, k int, ts timestamp_ntz").repartition(3)
    v = spark.createDataFrame(versions + [(None, "none", BASE, OPEN)], "k int, name string, a timestamp_ntz, b timestamp_ntz")
    want = {i: next((n for vk, n, a, b in versions if vk == k and t and a <= t < b), None) for i, k, t in facts}
    left = {r.id: r.name for r in joins.point_in_time_join(f, v, ["k"], "ts", "a", "b", bucket_s=5 * 86400).collect()}
    assert left == want
    inner = joins.point_in_time_join(f, v, ["k"], "ts", "a", "b", "inner").collect()
    assert {r.id: r.name for r in inner} == {i: n for i, n in want.items() if n}
    plan = joins.point_in_time_join(f, v, ["k"], "ts", "a", "b")._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Window [") == 2 and "Join" not in plan


def test_latest_event_before_with_a_hot_key(spark):
    rnd = random.Random(8)
    rows = [(i, 1 if i % 3 == 0 else rnd.randrange(2, 9), BASE + dt.timedelta(minutes=rnd.randrange(30 * 1440)), rnd.choice("wax")) for i in range(600)]
    df = spark.createDataFrame(rows, "id int, k int, ts timestamp_ntz, kind string")
    got = {r.id: r.w for r in joins.first_event_before(df, ["k"], "ts", F.col("kind") == "w", F.col("kind") == "a", "latest_before", "w", 86400).collect()}
    want = {}
    for i, k, t, kind in rows:
        before = [x[2] for x in rows if x[1] == k and x[3] == "w" and x[2] <= t]
        if kind == "a" and before:
            want[i] = max(before)
    assert got == want


CHANGE = "k int, grade string, note string, change_ts timestamp_ntz, change_seq long"
DIM = "k int, grade string, note string, effective_from timestamp_ntz, effective_to timestamp_ntz, is_current boolean"


def in_order(changes):
    out = []
    for k, own in itertools.groupby(sorted(changes, key=lambda c: (c[0], c[3], c[4])), key=lambda c: c[0]):
        kept = []
        for c in own:
            if not kept or kept[-1][1] != c[1]:
                kept.append(c)
        for a, b in zip(kept, [*kept[1:], None]):
            out.append((a[0], a[1], a[3], b[3] if b else OPEN, b is None))
    return sorted(out)


def test_late_batches_equal_loading_in_order(spark):
    rnd = random.Random(2)
    changes = [(1 if i % 3 == 0 else rnd.randrange(2, 12), rnd.choice("AB"), f"n{i}", BASE + dt.timedelta(hours=rnd.randrange(2000)), i)
               for i in range(400)]
    rnd.shuffle(changes)
    batches = [changes[:150], changes[150:300], changes[300:]]        # every batch has late changes
    dim, seen = spark.createDataFrame([], DIM), spark.createDataFrame([], CHANGE)
    for b in batches:
        df = spark.createDataFrame(b, CHANGE)
        dim = wh.scd2_apply(dim, df, ["k"], ["grade"], F.lit(None), bucket_s=10 * 86400, history=seen).checkpoint()
        seen = seen.unionByName(df)
    rows = lambda d: sorted((r.k, r.grade, r.effective_from, r.effective_to, r.is_current) for r in d.collect())
    assert rows(dim) == in_order(changes)
    again = wh.scd2_apply(dim, spark.createDataFrame(batches[1], CHANGE), ["k"], ["grade"], F.lit(None), history=seen)
    assert rows(again) == in_order(changes)


def test_a_late_change_without_history_is_spliced_in(spark):
    t = lambda n: BASE + dt.timedelta(days=n)
    dim = spark.createDataFrame([(1, "A", "x", t(0), t(10), False), (1, "B", "y", t(10), OPEN, True),
                                 (2, "A", "z", t(0), OPEN, True)], DIM)
    late = spark.createDataFrame([(1, "C", "late", t(5), 1), (1, "B", "same", t(12), 2), (2, "A", "same", t(3), 3), (3, "N", "new", t(1), 4),
                                  (3, "N", "no time", None, 5)], CHANGE)
    got = sorted((r.k, r.grade, r.effective_from, r.effective_to) for r in wh.scd2_apply(dim, late, ["k"], ["grade"], F.lit(None)).collect())
    assert got == [(1, "A", t(0), t(5)), (1, "B", t(10), OPEN), (1, "C", t(5), t(10)), (2, "A", t(0), OPEN), (3, "N", t(1), OPEN)]


def test_dense_numbers_of_composite_keys(spark):
    rnd = random.Random(1)
    rows = list({(rnd.choice([None, "a", "b", "ü"]), rnd.choice([None, 1, 2, 30, 200]), rnd.randrange(40)) for _ in range(500)})
    df = spark.createDataFrame(rows, "a string, b int, c int").repartition(7)
    got = [(r.a, r.b, r.c) for r in sorted(dense_numbers(df, ["a", "b", "c"], "n").collect(), key=lambda r: r.n)]
    low = lambda r: tuple((x is not None, x or (0 if not isinstance(x, str) else "")) if x is not None else (False,) for x in r)
    assert got == sorted(rows, key=low)
    assert sorted(r.n for r in dense_numbers(df, ["a", "b", "c"], "n").collect()) == list(range(1, len(rows) + 1))
    old = wh.add_surrogate_keys(df.limit(0), None, ["a", "b"], "sk")
    assert old.count() == 0
    first = wh.junk_dimension(df.where("c < 20"), ["a", "b"], None, "sk").checkpoint()
    both = wh.junk_dimension(df, ["a", "b"], first, "sk").collect()
    assert len(both) == len({r[:2] for r in rows}) and sorted(r.sk for r in both) == list(range(1, len(both) + 1))
    assert {(r.a, r.b): r.sk for r in first.collect()}.items() <= {(r.a, r.b): r.sk for r in both}.items()


def test_half_paths_meet_to_all_simple_paths(spark):
    rnd = random.Random(4)
    edges = [(str(a), str(b), float(rnd.randrange(1, 9))) for a in range(9) for b in range(9) if a != b and rnd.random() < 0.45]
    e = spark.createDataFrame(edges, "src string, dst string, w double")
    ids = lambda *x: spark.createDataFrame([(i,) for i in x], "id string")

    def walk(path, total):
        if path[-1] in ("5", "6") and len(path) > 1:
            yield "-".join(path), total
        if len(path) <= 6:
            for a, b, w in edges:
                if a == path[-1] and b not in path and b != "7":
                    yield from walk([*path, b], total + w)
    want = sorted([*walk(["0"], 0.0), *walk(["1"], 0.0)])
    got = g.paths_between(e, ids("0", "1"), ids("5", "6"), 6, weight="w", avoid=["7"])
    assert sorted(("-".join(r.path), r.total) for r in got.collect()) == want
    assert all(r.hops == len(r.path) - 1 and r.path[0] == r.start and r.path[-1] == r.end for r in got.collect())
    steps = {(a, 1) for a, b, _ in edges if b == "8"}
    want_set, level = set(steps), {a for a, _ in steps}
    for n in range(2, 5):
        level = {a for a, b, _ in edges if b in level and a != "8"}
        want_set |= {(a, n) for a in level}
    assert {(r.node, r.length) for r in g.impact_set(e, "8", 4).collect()} == want_set


def test_only_versions_are_sorted_for_the_edges_of_buckets(spark):
    f = spark.range(4).selectExpr("id % 2 AS k", "timestamp_ntz'2024-01-01' AS ts")
    v = spark.range(3).selectExpr("id AS k", "timestamp_ntz'2023-01-01' AS a", "timestamp_ntz'2025-01-01' AS b", "id AS name")
    j = joins.point_in_time_join(f, v, ["k"], "ts", "a", "b")
    assert sorted((r.k, r.name) for r in j.collect()) == [(0, 0), (0, 0), (1, 1), (1, 1)]
    lines = j._jdf.queryExecution().optimizedPlan().toString().split("\n")
    depth = lambda x: len(x) - len(x.lstrip(" :+-"))
    for at, line in enumerate(lines):
        if "max_by" in line and "Aggregate" in line:
            below = lines[at + 1:next((i for i in range(at + 1, len(lines)) if depth(lines[i]) <= depth(line)), len(lines))]
            assert below and not any("Union" in x for x in below)
            break
    else:
        raise AssertionError("no table of edges")

"""Document patterns and graph algorithms on own fixtures (golden values)."""

import pytest
from pyspark.sql import functions as F

from oreflow.operators import documents as doc
from oreflow.operators import graph as g


def test_key_missing_vs_null(spark):
    df = spark.createDataFrame([('{"a": null}',), ('{"b": 1}',)], "j string")
    r = df.select(doc.has_key("j", "a").alias("has"), doc.path(doc.parse("j"), "$.a", "int").alias("v")).collect()
    assert [(x.has, x.v) for x in r] == [(True, None), (False, None)]


def test_containment_nested_and_array_subset(spark):
    df = spark.createDataFrame([('{"type":"LHD","mine":{"code":"M1"},"tags":["a","b"]}',),
                                ('{"type":"LHD","mine":{"code":"M2"},"tags":["a"]}',)], "j string")
    v = doc.parse("j")
    hit = df.select(doc.contains(v, {"type": "LHD", "mine": {"code": "M1"}, "tags": ["b"]}).alias("c")).collect()
    assert [x.c for x in hit] == [True, False]


def test_xpath_ignores_default_namespace(spark):
    df = spark.createDataFrame([('<e xmlns="urn:a" id="7"><name>N &amp; M</name><v unit="kg">3.5</v></e>',)], "x string")
    r = df.select(doc.xpath_text("x", "//name").alias("n"), doc.xpath_text("x", "/e/@id").alias("i"),
                  doc.xpath_number("x", "//v").alias("v")).first()
    assert (r.n, r.i, r.v) == ("N & M", "7", 3.5)


def test_titles_cut_in_an_entity_are_read(spark, scratch):
    import os

    from oreflow.plans.q_documents import doc_page_titles
    titles = ["a &amp; b", "cut &quo", "a & b <i>c</i> ]]>", "&quot;x&quot; &amp;amp;", "", "bell \x07 &amp;", "cr\r", "ü \u2028 ñ"]
    rows = [(i, f"<html><head><title>{t}</title></head></html>") for i, t in enumerate(titles)]
    rows += [(100, "<html>none</html>"), (101, None)]
    spark.createDataFrame(rows, "page_id long, html string").write.parquet(os.path.join(scratch, "pages.parquet"))
    got = {r.page_id: r.title for r in doc_page_titles(spark, scratch).collect()}
    assert got == {**{i: t.replace("&amp;", "&") for i, t in enumerate(titles)}, 100: "", 101: ""}


def test_schema_versions_axis_order(spark):
    df = spark.createDataFrame([('{"schema_version":1,"latitude":67.5,"longitude":33.1,"level":"-400"}',),
                                ('{"schema_version":2,"location":{"coordinates":[33.1,67.5]},"level":"-400"}',)],
                               "j string")
    r = df.select(doc.unify_versions(doc.parse("j")).alias("s")).collect()
    assert [(x.s.lat, x.s.lon) for x in r] == [(67.5, 33.1), (67.5, 33.1)]


def test_attribute_match_requires_one_element(spark):
    df = spark.createDataFrame([(1,)], "id int")
    a = doc.attribute_array(df.withColumn("t", F.lit(80.0)).withColumn("p", F.lit(5.0)), ["id"],
                            {"temperature": F.col("t"), "pressure": F.col("p")})
    both = a.select(doc.attribute_match("metrics", "temperature", lambda v: v > 70).alias("m1"),
                    doc.attribute_match("metrics", "pressure", lambda v: v > 70).alias("m2")).first()
    assert (both.m1, both.m2) == (True, False)


def test_computed_pattern_shift_totals(spark):
    # four trips of one shift: running totals as one aggregate
    trips = spark.createDataFrame([("M001", 42.5), ("M001", 38.0), ("M001", 45.2), ("M001", 39.8)], "m string, t double")
    r = trips.groupBy("m").agg(F.round(F.sum("t"), 1).alias("total"), F.count(F.lit(1)).alias("trips"),
                               F.max("t").alias("max_t")).first()
    assert (r.total, r.trips, r.max_t) == (165.5, 4, 45.2)


def test_bucket_fold_caps_and_keeps_stats(spark):
    import datetime as dt
    rows = [(1, dt.datetime(2024, 1, 1, 10, i), float(i)) for i in range(10)]
    df = spark.createDataFrame(rows, "k int, ts timestamp_ntz, v double")
    reading = F.struct("ts", "v")
    b = doc.bucket_fold(df, ["k"], "ts", "1 hour", cap=4, reading=reading, value="v").orderBy("bucket_no").collect()
    assert [x["count"] for x in b] == [4, 4, 2]
    assert [len(x.readings) for x in b] == [4, 4, 2]
    roll = doc.bucket_rollup(doc.bucket_fold(df, ["k"], "ts", "1 hour", 4, reading, "v"), ["k"]).first()
    assert (roll.n, roll.avg_value, roll.max_value) == (10, 4.5, 9.0)


# route graph of the reference's transport chains (fixed values): src, dst, distance_m
ROUTES = [("EQ-001", "EQ-007", 500), ("EQ-007", "EQ-010", 1200), ("EQ-002", "EQ-004", 300),
          ("EQ-004", "EQ-008", 800), ("EQ-008", "EQ-010", 1000), ("EQ-003", "EQ-005", 400),
          ("EQ-005", "EQ-009", 600), ("EQ-009", "EQ-011", 900), ("EQ-001", "EQ-004", 350),
          ("EQ-004", "EQ-010", 2000)]


@pytest.fixture()
def routes(spark):
    return spark.createDataFrame(ROUTES, "src string, dst string, distance_m long").withColumn(
        "type", F.lit("CONNECTED_TO"))


def test_routes_eq001_to_eq010(spark, routes):
    src = spark.createDataFrame([("EQ-001",)], "id string")
    p = g.var_length_paths(routes, src, 5, weight="distance_m").where(F.col("end") == "EQ-010")
    got = sorted((r.hops, r.total, "-".join(r.path)) for r in p.collect())
    assert got == [(2, 1700.0, "EQ-001-EQ-007-EQ-010"), (2, 2350.0, "EQ-001-EQ-004-EQ-010"),
                   (3, 2150.0, "EQ-001-EQ-004-EQ-008-EQ-010")]
    sp = {r.node: r.dist for r in g.weighted_shortest(routes, src, "distance_m").collect()}
    assert sp["EQ-010"] == 1700.0
    hops = {r.node: r.hops for r in g.bfs_levels(routes, src).collect()}
    assert hops["EQ-010"] == 2 and hops["EQ-008"] == 2
    avoid = g.var_length_paths(routes, src, 5, avoid=["EQ-007"]).where(F.col("end") == "EQ-010")
    assert sorted(r.hops for r in avoid.collect()) == [2, 3]


def test_cycles_terminate_and_impact_lengths(spark):
    e = spark.createDataFrame([("a", "b"), ("b", "c"), ("c", "a"), ("c", "c"), ("x", "c")], "src string, dst string")
    src = spark.createDataFrame([("a",)], "id string")
    p = g.var_length_paths(e, src, 10)
    assert p.count() == 2                      # a-b, a-b-c (simple paths only)
    imp = {(r.node, r.length) for r in g.impact_set(e, "c", 5).collect()}
    assert imp == {("b", 1), ("x", 1), ("a", 2)}


def test_isolated_node_has_zero_degree(spark):
    nodes = spark.createDataFrame([("a", "N"), ("b", "N"), ("z", "N")], "id string, label string")
    edges = spark.createDataFrame([("a", "b", "R")], "src string, dst string, type string")
    d = {r.id: (r.R_in, r.R_out) for r in g.degrees(nodes, edges, ["R"]).collect()}
    assert d == {"a": (0, 1), "b": (1, 0), "z": (0, 0)}
    assert [r.id for r in g.unconnected(nodes, edges, "R", "in").orderBy("id").collect()] == ["a", "z"]
    n2, e2 = g.detach_delete(nodes, edges, spark.createDataFrame([("b",)], "id string"))
    assert n2.count() == 2 and e2.count() == 0

"""Data-quality suites, quarantine, schema rules and profiling on fixtures."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from oreflow.operators import profile as pr
from oreflow.operators import quality as dq
from oreflow.operators.quality import Rule

PROD = "production_id string, mine_id string, tonnage double, fe_pct double, status string"
PROD_RULES = [
    Rule("id_not_null", "not_null", "production_id"),
    Rule("id_unique", "unique", "production_id"),
    Rule("mine_not_null", "not_null", "mine_id"),
    Rule("tonnage_range", "between", "tonnage", {"min": 0.0, "max": 500.0}),
    Rule("fe_range", "between", "fe_pct", {"min": 0.0, "max": 100.0}),
    Rule("status_set", "in_set", "status", {"values": ["completed", "interrupted"]}),
    Rule("id_format", "regex", "production_id", {"pattern": "^PRD-[0-9]{3}$"}),
    Rule("rows", "row_count", None, {"min": 1, "max": 1000}),
    Rule("completed_has_tonnage", "expr", None, {"predicate": "NOT (status = 'completed') OR tonnage > 0"}),
    Rule("mine_fk", "fk", "mine_id", {"parent": "mines", "parent_key": "mine_id"}),
    Rule("fe_not_null", "not_null", "fe_pct"),
]


def _clean(spark):
    rows = [(f"PRD-{i:03d}", "MINE-01" if i % 2 else "MINE-02", 100.0 + i, 30.0 + i / 10, "completed")
            for i in range(1, 11)]
    return spark.createDataFrame(rows, PROD)


def _dirty(df):
    """DQ-13: corrupt five rows deterministically (NULL mine, duplicate id,
    Fe 150, tonnage -10, unknown status)."""
    w = F.col("production_id")
    return (df.withColumn("mine_id", F.when(w == "PRD-001", F.lit(None)).otherwise(F.col("mine_id")))
            .withColumn("production_id", F.when(w == "PRD-002", F.lit("PRD-003")).otherwise(w))
            .withColumn("fe_pct", F.when(w == "PRD-004", 150.0).otherwise(F.col("fe_pct")))
            .withColumn("tonnage", F.when(w == "PRD-005", -10.0).otherwise(F.col("tonnage")))
            .withColumn("status", F.when(w == "PRD-006", "unknown").otherwise(F.col("status"))))


def test_clean_suite_passes_and_dirty_fails(spark):
    mines = spark.createDataFrame([("MINE-01",), ("MINE-02",)], "mine_id string")
    clean = dq.evaluate(_clean(spark), PROD_RULES, {"mines": mines})
    assert clean.count() == len(PROD_RULES) and clean.where(~F.col("success")).count() == 0
    dirty = dq.evaluate(_dirty(_clean(spark)), PROD_RULES, {"mines": mines})
    failed = {r.rule for r in dirty.where(~F.col("success")).collect()}
    # the five corrupted rows break five value rules, and the negative
    # tonnage of a completed row also breaks the conditional rule
    assert failed == {"mine_not_null", "id_unique", "fe_range", "tonnage_range", "status_set",
                      "completed_has_tonnage"}


def test_quarantine_split_is_complete(spark):
    df = _dirty(_clean(spark))
    rules = [Rule("tonnage_range", "between", "tonnage", {"min": 0.0}, "critical", "reject_row"),
             Rule("fe_range", "between", "fe_pct", {"max": 100.0}, "warning", "flag_as_suspect"),
             Rule("id_unique", "unique", "production_id", {}, "critical", "reject_duplicates")]
    clean, bad = dq.split_quarantine(df, rules, ["production_id"], "production", 7)
    assert clean.count() + bad.count() == df.count()
    assert {r.error_type for r in bad.collect()} == {"tonnage_range", "id_unique"}
    assert clean.where("is_suspect").count() == 1
    raw = bad.select("raw_data").first()[0]
    assert raw.startswith("{") and "production_id" in raw


READING_SCHEMA = {
    "type": "object",
    "required": ["reading_id", "sensor_id", "timestamp", "type", "value", "status"],
    "properties": {
        "reading_id": {"type": "string"},
        "sensor_id": {"type": "string", "pattern": "^SNS-[0-9]{3}$"},
        "timestamp": {"type": "string", "format": "date-time"},
        "type": {"type": "string", "enum": ["temperature", "vibration", "pressure"]},
        "value": {"type": ["number", "null"]},
        "status": {"type": "string", "enum": ["ok", "warning", "alarm"]},
    },
}


def test_json_schema_invalid_reading_has_four_violations(spark):
    docs = spark.createDataFrame([
        (1, '{"reading_id":"R1","sensor_id":"SNS-001","timestamp":"2024-01-01T10:00:00Z","type":"pressure","value":null,"status":"ok"}'),
        (2, '{"reading_id":"R2","sensor_id":"BAD","timestamp":"yesterday","type":"noise","value":1.5,"status":"broken"}'),
        (3, '{not json'),
    ], "id int, doc string")
    v = dq.schema_violations(docs, READING_SCHEMA, "doc", "id")
    by = {}
    for r in v.collect():
        by.setdefault(r.id, set()).add(r.violation)
    assert 1 not in by                                   # null value allowed by the type union
    assert by[2] == {"$.sensor_id:pattern", "$.timestamp:format", "$.type:enum", "$.status:enum"}
    assert by[3] == {"$:parse"}


def test_schema_compiler_rejects_unknown_keywords():
    with pytest.raises(ValueError):
        dq.compile_json_schema({"type": "object", "if": {}}, F.lit(None))


def test_document_validator_levels(spark):
    docs = spark.createDataFrame([(1, '{"reading_id":"R","sensor_id":"X","timestamp":"2024-01-01T00:00:00Z",'
                                      '"type":"pressure","value":1,"status":"ok"}')], "id int, doc string")
    err = dq.validate_documents(docs, READING_SCHEMA, "doc", "id", "strict", "error").first()
    warn = dq.validate_documents(docs, READING_SCHEMA, "doc", "id", "strict", "warn").first()
    assert err.status == "rejected" and warn.status == "warned"
    mod = dq.validate_documents(docs.withColumn("was_valid", F.lit(False)), READING_SCHEMA, "doc", "id",
                                "moderate", "error", F.col("was_valid")).first()
    assert mod.status == "accepted"                      # moderate: previously invalid docs pass


def test_xml_rules_three_violations(spark):
    from oreflow.operators.documents import xpath_number, xpath_text
    xml = spark.createDataFrame([
        ('<equipment xmlns="urn:x" id="PDM-001" type="loader"><payload unit="t">20</payload></equipment>',),
        ('<equipment xmlns="urn:x" id="pdm-1" type="spaceship"><payload unit="t">200</payload></equipment>',),
    ], "x string")
    cols = xml.select(xpath_text("x", "/equipment/@id").alias("id"), xpath_text("x", "/equipment/@type").alias("type"),
                      xpath_number("x", "//payload").alias("payload"))
    rules = [Rule("id", "regex", "id", {"pattern": "^[A-Z]{3}-[0-9]{3}$"}),
             Rule("type", "in_set", "type", {"values": ["loader", "truck"]}),
             Rule("payload", "between", "payload", {"min": 0.0, "max": 100.0})]
    v = dq.violations(cols, rules).select(F.size("violations").alias("n")).collect()
    assert [r.n for r in v] == [0, 3]


def test_freshness_classes(spark):
    d = dt.datetime.fromisoformat
    df = spark.createDataFrame([(d("2024-01-10 00:00:00"),), (d("2023-01-01 00:00:00"),), (d("2024-03-01 00:00:00"),)],
                               "t timestamp_ntz")
    now = F.lit(d("2024-02-01 00:00:00"))
    assert [r.freshness for r in dq.freshness(df, "t", now, 365).collect()] == ["fresh", "stale", "future"]


def test_profile_and_alerts(spark):
    df = spark.createDataFrame([(i, 0 if i < 5 else i, "x") for i in range(20)], "id int, v int, c string")
    p = {(r.column, r.metric): r.value for r in pr.profile(df, quantiles=[0.5], accuracy=10000).collect()}
    assert p[("id", "distinct")] == 20 and p[("v", "zeros")] == 5 and p[("c", "distinct")] == 1
    assert p[("id", "p50")] == 9
    al = {(r.column, r.alert) for r in pr.alerts(pr.profile(df)).collect()}
    assert ("c", "constant") in al and ("id", "high_cardinality") in al and ("v", "zeros") in al


def test_spearman_matches_pandas(spark):
    import pandas as pd
    vals = [(1.0, 2.0), (2.0, 1.0), (3.0, 4.0), (4.0, 3.0), (5.0, 5.0), (5.0, 6.0)]
    df = spark.createDataFrame(vals, "a double, b double")
    got = pr.spearman(df, "a", "b").first()[0]
    want = pd.DataFrame(vals, columns=["a", "b"]).corr(method="spearman").iloc[0, 1]
    assert got == pytest.approx(want)


def test_histogram_and_iqr(spark):
    df = spark.createDataFrame([(float(i),) for i in range(10)] + [(100.0,)], "v double")
    h = {r.bin: r.n for r in pr.histogram(df, "v", 10).collect()}
    assert sum(h.values()) == 11 and h[9] == 1
    assert [r.v for r in pr.iqr_outliers(df, "v").collect()] == [100.0]


def test_exact_quantiles_per_group(spark):
    import math
    import random
    rnd = random.Random(3)
    rows = [(g, rnd.choice([None, rnd.randrange(300), 7])) for g in ["a", "b", None] for _ in range(500)]
    df = spark.createDataFrame(rows, "g string, v int")
    got = {(r.g, r.q): r.value for r in pr.exact_quantiles(df, "v", [0.0, 0.25, 0.7, 1.0], ["g"], buckets=8).collect()}
    for g in ("a", "b", None):
        v = sorted(x for h, x in rows if h == g and x is not None)
        assert all(got[(g, q)] == v[max(1, math.ceil(round(q * len(v), 6))) - 1] for q in (0.0, 0.25, 0.7, 1.0))


def test_json_schema_references_alternatives_and_elements(spark):
    import json

    import pytest

    from oreflow.operators import quality as dq
    schema = {
        "type": "array", "items": {"$ref": "#/$defs/Thing"},
        "$defs": {
            "Name": {"type": "string", "minLength": 1, "maxLength": 4},
            "Thing": {"type": "object", "required": ["id"], "additionalProperties": False, "properties": {
                "id": {"$ref": "#/$defs/Name"}, "n": {"type": "integer", "exclusiveMinimum": 0},
                "past": {"oneOf": [{"type": "array", "items": {"$ref": "#/$defs/Name"}}, {"type": "null"}]},
                "kind": {"anyOf": [{"const": 1}, {"enum": ["a", True]}]}, "on": {"format": "date", "type": "string"},
                "both": {"allOf": [{"minimum": 2}, {"maximum": 5}]}}}}}
    cases = [
        ([], []), ({}, ["$:type"]), (None, ["$:type"]),
        ([{"id": "ab", "n": 3, "past": None, "kind": True, "on": "2024-02-29", "both": 5}], []),
        ([{"id": "ab", "past": ["x", "y"], "kind": 1}], []),
        ([{"id": "x"}, {"id": ""}], ["$[*].id:minLength"]), ([{"id": "abcde"}], ["$[*].id:maxLength"]),
        ([{"n": 1}], ["$[*].id:required"]), ([{"id": "a", "more": 1}], ["$[*]:additionalProperties"]),
        ([{"id": "a", "n": 0}], ["$[*].n:exclusiveMinimum"]), ([{"id": "a", "n": 1.5}], ["$[*].n:type"]),
        ([{"id": "a", "past": ["x", ""]}], ["$[*].past:oneOf"]), ([{"id": "a", "past": 5}], ["$[*].past:oneOf"]),
        ([{"id": "a", "kind": "b"}], ["$[*].kind:anyOf"]), ([{"id": "a", "kind": False}], ["$[*].kind:anyOf"]),
        ([{"id": "a", "on": "2024-02-30"}], ["$[*].on:format"]), ([{"id": "a", "both": 6}], ["$[*].both:allOf"]),
    ]
    df = spark.createDataFrame([(i, json.dumps(d)) for i, (d, _) in enumerate(cases)] + [(99, "not json")], "i int, d string")
    got = {}
    for r in dq.schema_violations(df, schema, "d", "i").collect():
        got.setdefault(r.i, []).append(r.violation)
    assert got.pop(99) == ["$:parse"]
    assert got == {i: want for i, (_, want) in enumerate(cases) if want}
    for bad in ({"multipleOf": 2}, {"properties": {"a": {"if": {}}}}, {"format": "uri"}, {"$ref": "#/$defs/none"},
                {"$defs": {"A": {"items": {"$ref": "#/$defs/A"}}}, "$ref": "#/$defs/A"}):
        with pytest.raises(ValueError):
            dq.compile_json_schema(bad, F.col("d"))


def test_json_schema_takes_a_value_apart_once(spark):
    from oreflow.plans.q_quality import ORDER_DOC_SCHEMA
    docs = spark.range(1).selectExpr("id", "'{}' AS doc")
    plan = dq.schema_violations(docs, ORDER_DOC_SCHEMA, "doc", "id")._jdf.queryExecution().optimizedPlan().toString()
    # one extraction of the array, not one for each rule about its elements
    assert plan.count("ArrayType(VariantType") == 1
    # a value's kind is found once, not once for each rule
    assert plan.count("schemaOfVariant") <= 11


def test_json_schema_with_many_rules_and_repeated_names(spark):
    import json
    names = [f"f{i:03d}" for i in range(40)]
    schema = {"$defs": {"T": {"type": "integer"}}, "required": names,
              "properties": {n: {"$ref": "#/$defs/T", "type": "integer"} for n in names}}
    full = {n: 1 for n in names}
    cases = [full, {**full, "f030": [1, {"a": 2}]}, {n: 1 for n in names if n not in ("f002", "f039")}, [1]]
    df = spark.createDataFrame([(i, json.dumps(c)) for i, c in enumerate(cases)] + [(9, None)], "i int, d string")
    got = {r.i: r.violations for r in dq.validate_documents(df, schema, "d", "i").collect()}
    # two rules of one name are two violations; rules come in the schema's order
    assert got == {0: [], 1: ["$.f030:type"] * 2, 2: ["$.f002:required", "$.f039:required"], 3: [], 9: ["$:parse"]}


def test_top_values_are_exact_where_the_sketch_is_not(spark):
    from collections import Counter

    from oreflow.operators import profile as pr
    import random
    rnd = random.Random(1)
    rows = [(rnd.choice(["hot", None, str(rnd.randrange(3000))]), i % 50) for i in range(6000)]
    df = spark.createDataFrame(rows, "a string, b int").repartition(4)
    for tracked in (16, 10_000):
        got = {(r.column, r.place): (r.type, r.value, r.n) for r in pr.top_values(df, ["a", "b"], 4, tracked).collect()}
        for c, kind, values in (("a", "string", [r[0] for r in rows if r[0] is not None]), ("b", "int", [str(r[1]) for r in rows])):
            want = sorted(Counter(values).items(), key=lambda x: (-x[1], x[0]))[:4]
            assert [got[(c, p + 1)] for p in range(4)] == [(kind, v, n) for v, n in want]
    assert pr.top_values(df.limit(0), ["a"]).count() == 0

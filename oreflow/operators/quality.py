"""Declarative data-quality rules, evaluated as Spark jobs.

A rule is data (name, kind, column, parameters, severity, action).  A suite
of row-level rules is evaluated in ONE aggregate pass over the table
(``count_if`` per rule); key uniqueness and referential integrity need one
shuffle each.  The same rules also produce per-row violation arrays, which
split a batch into clean rows and a quarantine table.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import add, and_, or_
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Rule:
    name: str
    kind: str              # not_null | in_set | between | regex | expr | unique | fk | row_count
    column: str | None = None
    params: dict = field(default_factory=dict)
    severity: str = "warning"      # critical stops the load
    action: str = "log_and_continue"  # reject_row | reject_duplicates | flag_as_suspect | log_and_continue


ROW_KINDS = {"not_null", "in_set", "between", "regex", "expr"}


def row_ok(rule: Rule) -> Column:
    """Row predicate of a row-level rule: True = passes.  Like the
    expectation libraries, NULL values pass every rule except not_null."""
    c = F.col(rule.column) if rule.column else None
    p = rule.params
    if rule.kind == "not_null":
        return c.isNotNull()
    if rule.kind == "in_set":
        return c.isNull() | c.isin(list(p["values"]))
    if rule.kind == "between":
        ok = F.lit(True)
        if p.get("min") is not None:
            ok = ok & (c >= F.lit(p["min"]))
        if p.get("max") is not None:
            ok = ok & (c <= F.lit(p["max"]))
        return c.isNull() | ok
    if rule.kind == "regex":
        return c.isNull() | c.rlike(p["pattern"])
    if rule.kind == "expr":
        # cross-column or conditional rule (DQ-08/09); NULL -> passes
        return F.coalesce(F.expr(p["predicate"]), F.lit(True))
    raise ValueError(f"not a row rule: {rule.kind}")


def evaluate(df: DataFrame, rules: Sequence[Rule], parents: dict[str, DataFrame] | None = None
             ) -> DataFrame:
    """DQ-12: suite result, one row per rule: rule, kind, column, evaluated,
    unexpected, unexpected_pct, success."""
    parents = parents or {}
    row_rules = [r for r in rules if r.kind in ROW_KINDS]
    aggs = [F.count(F.lit(1)).alias("__n")]
    for i, r in enumerate(row_rules):
        evaluated = F.count(F.lit(1)) if r.kind in ("not_null", "expr") else F.count(F.col(r.column))
        aggs += [evaluated.alias(f"__e{i}"), F.count_if(~row_ok(r)).alias(f"__u{i}")]
    one = df.agg(*aggs)  # single pass, partial aggregation per partition
    parts = []
    for i, r in enumerate(row_rules):
        parts.append(one.select(F.lit(r.name).alias("rule"), F.lit(r.kind).alias("kind"),
                                F.lit(r.column).cast("string").alias("column"),
                                F.col(f"__e{i}").alias("evaluated"), F.col(f"__u{i}").alias("unexpected")))
    for i, r in enumerate(rules):
        if r.kind == "unique":
            # rows minus distinct keys, from a grouped count (partial counts
            # per partition; no distinct-aggregate expansion)
            per_key = df.where(F.col(r.column).isNotNull()).groupBy(r.column).agg(F.count(F.lit(1)).alias("__c"))
            parts.append(per_key.agg(F.sum("__c").alias("evaluated"), F.count(F.lit(1)).alias("__d"))
                         .select(F.lit(r.name).alias("rule"), F.lit(r.kind).alias("kind"),
                                 F.lit(r.column).alias("column"),
                                 F.coalesce(F.col("evaluated"), F.lit(0)).cast("long").alias("evaluated"),
                                 (F.coalesce(F.col("evaluated"), F.lit(0)) - F.col("__d")).cast("long").alias("unexpected")))
        elif r.kind == "row_count":
            lo, hi = r.params.get("min", 0), r.params.get("max")
            ok = F.col("__n") >= lo
            if hi is not None:
                ok = ok & (F.col("__n") <= hi)
            parts.append(one.select(F.lit(r.name).alias("rule"), F.lit(r.kind).alias("kind"),
                                    F.lit(None).cast("string").alias("column"),
                                    F.lit(1).cast("long").alias("evaluated"),
                                    F.when(ok, 0).otherwise(1).cast("long").alias("unexpected")))
        elif r.kind == "fk":
            # distinct parent keys: the left join never multiplies child rows
            parent = (parents[r.params["parent"]].select(F.col(r.params["parent_key"]).alias("__pk"))
                      .distinct())
            j = df.select(r.column).join(parent, F.col(r.column) == F.col("__pk"), "left")
            parts.append(j.agg(
                F.count(F.col(r.column)).alias("evaluated"),
                F.count_if(F.col(r.column).isNotNull() & F.col("__pk").isNull()).alias("unexpected"))
                .select(F.lit(r.name).alias("rule"), F.lit(r.kind).alias("kind"),
                        F.lit(r.column).alias("column"), "evaluated", "unexpected"))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return (out.withColumn("unexpected_pct", F.round(F.try_divide(F.col("unexpected") * 100.0,
                                                                   F.col("evaluated")), 4))
            .withColumn("success", F.col("unexpected") == 0))


def violations(df: DataFrame, rules: Sequence[Rule], out: str = "violations") -> DataFrame:
    """DQ-11: per row, the array of names of the row-level rules it breaks."""
    checks = [F.when(~row_ok(r), F.lit(r.name)) for r in rules if r.kind in ROW_KINDS]
    arr = F.filter(F.array(*checks), lambda x: x.isNotNull()) if checks else F.array().cast("array<string>")
    return df.withColumn(out, arr)


def split_quarantine(df: DataFrame, rules: Sequence[Rule], key_cols: Sequence[str],
                     table_name: str, load_id: int | Column = 0) -> tuple[DataFrame, DataFrame]:
    """DQ-11 / ETL-08: (clean, quarantine).  Rows breaking a ``reject_row``
    rule go to quarantine with the rule name as error type, a message, the
    row key and the raw row as JSON; rows breaking only ``flag_as_suspect``
    rules stay clean with ``is_suspect``; ``log_and_continue`` only counts.
    ``reject_duplicates`` rules on a column send every row of a duplicated
    key to quarantine.  clean + quarantine = input."""
    reject = [r for r in rules if r.action == "reject_row" and r.kind in ROW_KINDS]
    suspect = [r for r in rules if r.action == "flag_as_suspect" and r.kind in ROW_KINDS]
    dups = [r for r in rules if r.action == "reject_duplicates"]
    v = violations(df, reject, "__rej")
    v = violations(v, suspect, "__sus")
    for r in dups:
        d = df.groupBy(r.column).agg(F.count(F.lit(1)).alias("__c")).where(F.col("__c") > 1)
        v = (v.join(d.select(r.column, F.lit(r.name).alias(f"__dup_{r.name}")), r.column, "left")
             .withColumn("__rej", F.when(F.col(f"__dup_{r.name}").isNotNull(),
                                         F.array_append("__rej", F.lit(r.name))).otherwise(F.col("__rej")))
             .drop(f"__dup_{r.name}"))
    base_cols = df.columns
    bad = v.where(F.size("__rej") > 0)
    quarantine = bad.select(
        (load_id if isinstance(load_id, Column) else F.lit(load_id)).alias("load_id"),
        F.lit(table_name).alias("table_name"),
        F.concat_ws("|", *[F.col(k).cast("string") for k in key_cols]).alias("record_key"),
        F.element_at("__rej", 1).alias("error_type"),
        F.concat(F.lit("failed rules: "), F.array_join("__rej", ", ")).alias("error_message"),
        F.to_json(F.struct(*base_cols)).alias("raw_data"))
    clean = v.where(F.size("__rej") == 0).select(*base_cols, (F.size("__sus") > 0).alias("is_suspect"))
    return clean, quarantine


def critical_failures(result: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """Failed rules whose severity is critical (the load must stop)."""
    crit = [r.name for r in rules if r.severity == "critical"]
    return result.where(~F.col("success") & F.col("rule").isin(crit))


def range_flags(df: DataFrame, ranges: DataFrame, type_col: str, value: str) -> DataFrame:
    """DQ-10: per-type physical range (type, min, max) -> ``is_suspect``.
    Spark broadcasts the ranges if their size allows it."""
    r = ranges.select(F.col(type_col).alias("__t"), F.col("min").alias("__lo"), F.col("max").alias("__hi"))
    j = df.join(r, df[type_col] == r["__t"], "left")
    bad = (F.col(value) < F.col("__lo")) | (F.col(value) > F.col("__hi"))
    return j.withColumn("is_suspect", F.coalesce(bad, F.lit(False))).drop("__t", "__lo", "__hi")


def freshness(df: DataFrame, ts: str, now: Column, max_age_days: int) -> DataFrame:
    """DQ-14: classify rows as future / stale / fresh relative to ``now``."""
    age = F.col(ts) < now - F.make_dt_interval(F.lit(max_age_days))
    return df.withColumn("freshness", F.when(F.col(ts) > now, "future").when(age, "stale").otherwise("fresh"))


# ------------------------------------------------------------ schema rules
# keywords that say nothing about validity
_NOTES = {"$schema", "$id", "$defs", "definitions", "$comment", "title", "description", "default", "examples"}
_INTEGERS = ("BIGINT", "INT", "SMALLINT", "TINYINT")


def compile_json_schema(schema: dict, v: Column, prefix: str = "$") -> list[tuple[str, Column]]:
    """DQ-17: compile a JSON-Schema subset into (rule, violated) column pairs over
    a VARIANT column: type (also several, 'null'), enum, const, required,
    properties, additionalProperties=false, items, minItems, maxItems,
    uniqueItems, minLength, maxLength, pattern, format (date-time, date),
    minimum, maximum (and exclusive ones), oneOf, anyOf, allOf and $ref into the
    document's own definitions.  Rules on array elements hold for every element
    (``[*]`` in the name).  Any other keyword, and a $ref that leads back to
    itself, is refused."""
    names, broken = _broken(schema, v, prefix)
    return [(name, broken[i // _BITS].bitwiseAND(F.lit(1 << i % _BITS)) != 0) for i, name in enumerate(names)]


_BITS = 63      # rules that go through a document together


def _broken(schema: dict, v: Column, prefix: str = "$") -> tuple[list[str], list[Column]]:
    """The names of the rules, and a column of bits for each ``_BITS`` of them: which
    ones a parsed document breaks (none for NULL)."""
    names: list[str] = []
    node = _compile(schema, prefix, schema, (), names)
    return names, [_present(v, node, at) for at in range(0, len(names), _BITS)]


def _violations(schema: dict, v: Column) -> Column:
    """The names of the rules that a parsed document breaks, in the schema's order;
    an unparsable document has one violation, not one per rule."""
    names, broken = _broken(schema, v)
    out = F.when(v.isNull(), F.array(F.lit("$:parse"))).otherwise(F.array().cast("array<string>"))
    for c, bits in enumerate(broken):
        some = F.array(*[F.struct(F.lit(n).alias("n"), F.lit(1 << i).alias("bit")) for i, n in enumerate(names[c * _BITS:(c + 1) * _BITS])])
        out = F.concat(out, _let(bits, lambda m: F.when(m != 0, F.transform(F.filter(some, lambda x: m.bitwiseAND(x["bit"]) != 0),
                                                                            lambda x: x["n"])).otherwise(F.array().cast("array<string>")), "array<string>"))
    return out


def _let(value: Column, body, kind: str = "long") -> Column:
    """``body(value)`` of type ``kind``, with the value worked out once.  (The element
    of a transformed array would ask the whole expression for its type on every row.)"""
    return F.aggregate(F.array(value), F.lit(None).cast(kind), lambda _, x: body(x))


def _any(bits: list[Column]) -> Column:
    return reduce(lambda x, y: x.bitwiseOR(y), bits) if bits else F.lit(0).cast("long")


def _is(kind: Column, name: str) -> Column:
    """Whether a value of this ``kind`` is of a JSON type."""
    return {"null": lambda: kind == "VOID", "string": lambda: kind == "STRING", "boolean": lambda: kind == "BOOLEAN",
            "array": lambda: kind.startswith("ARRAY"), "object": lambda: kind.startswith("OBJECT"),
            "integer": lambda: kind.isin(*_INTEGERS) | (kind.startswith("DECIMAL(") & kind.endswith(",0)")),
            "number": lambda: kind.isin(*_INTEGERS, "DOUBLE", "FLOAT") | kind.startswith("DECIMAL")}[name]()


def _equals(x: Column, value) -> Column:
    if value is None:
        return _is(x["k"], "null")
    name, cast = ("boolean", "boolean") if isinstance(value, bool) else ("number", "double") if isinstance(value, (int, float)) \
        else ("string", "string")
    return F.coalesce(_is(x["k"], name) & (F.try_variant_get(x["v"], "$", cast) == F.lit(value)), F.lit(False))


@dataclass
class _Node:
    """A compiled schema: rules about a value itself and about what it holds."""
    takes: set = field(default_factory=set)     # what of an array or object the rules look at
    rules: list = field(default_factory=list)   # (number, function of a value's parts to whether the rule is broken)
    same: list = field(default_factory=list)    # nodes about the same value
    fields: list = field(default_factory=list)  # (name, node)
    items: list = field(default_factory=list)   # nodes about every element

    def holds(self, at: int) -> bool:
        """Whether a rule with a number in [at, at + _BITS) lies here or below."""
        return any(at <= i < at + _BITS for i, _ in self.rules) or any(
            n.holds(at) for n in (*self.same, *self.items, *(n for _, n in self.fields)))

    def bits(self, x: Column, at: int) -> Column:
        """The broken ones of the rules [at, at + _BITS), of a value's parts."""
        out = [F.when(rule(x), F.lit(1 << i - at).cast("long")).otherwise(F.lit(0).cast("long")) for i, rule in self.rules if at <= i < at + _BITS]
        out += [n.bits(x, at) for n in self.same if n.holds(at)]
        out += [_present(x["m"][name], n, at) for name, n in self.fields if n.holds(at)]
        none = F.lit(0).cast("long")
        out += [F.when(x["e"].isNotNull(), F.aggregate(x["e"], none, lambda s, y: s.bitwiseOR(_any(
            [_present(y, n, at) for n in self.items if n.holds(at)])))).otherwise(none)] if any(n.holds(at) for n in self.items) else []
        return _any(out)


def _present(v: Column, node: _Node, at: int) -> Column:
    """Bits of a value, 0 if there is none.  It is taken apart once: elements (e),
    fields (m), kind (k); only where the rules expect neither is the kind that of its
    whole content."""
    def of(x: Column) -> Column:
        kind = F.schema_of_variant(x["v"])
        if "m" in node.takes:
            kind = F.when(x["m"].isNotNull(), "OBJECT").otherwise(kind)
        if "e" in node.takes:
            kind = F.when(x["e"].isNotNull(), "ARRAY").otherwise(kind)
        return _let(F.struct(x["v"].alias("v"), kind.alias("k"), *[x[c].alias(c) for c in sorted(node.takes)]), lambda y: node.bits(y, at))

    types = {"e": "array<variant>", "m": "map<string,variant>"}
    parts = [F.try_variant_get(v, "$", types[c]).alias(c) for c in sorted(node.takes)]
    if not parts:
        return F.when(v.isNotNull(), _let(F.struct(v.alias("v"), F.schema_of_variant(v).alias("k")), lambda y: node.bits(y, at))) \
            .otherwise(F.lit(0).cast("long"))
    return F.when(v.isNotNull(), _let(F.struct(v.alias("v"), *parts), of)).otherwise(F.lit(0).cast("long"))


def _compile(schema: dict, path: str, root: dict, seen: tuple, names: list[str]) -> _Node:
    """Rules of a schema; their names are added to ``names``, in the schema's order."""
    text = lambda x: F.try_variant_get(x["v"], "$", "string")
    num = lambda x: F.try_variant_get(x["v"], "$", "double")
    # a keyword about one type says nothing of values of others
    on = lambda kind, test: lambda x: _is(x["k"], kind) & test(x)
    moment = {"date-time": "yyyy-MM-dd'T'HH:mm:ss[.SSS]XXX", "date": "yyyy-MM-dd"}
    node = _Node()

    def add_rule(name: str, rule) -> None:
        node.rules.append((len(names), rule))
        names.append(name)

    for word, arg in schema.items():
        rule = None
        if word in _NOTES:
            continue
        if word == "$ref":
            if arg in seen:
                raise ValueError(f"$ref leads back to itself: {arg}")
            target = root
            for part in arg.removeprefix("#").strip("/").split("/"):
                if not arg.startswith("#") or part and part not in target:
                    raise ValueError(f"unknown $ref: {arg}")
                target = target[part] if part else target
            node.same.append(_compile(target, path, root, (*seen, arg), names))
        elif word == "type":
            kinds = [arg] if isinstance(arg, str) else list(arg)
            node.takes |= {p for p, kind in (("e", "array"), ("m", "object")) if kind in kinds}
            rule = lambda x, kinds=kinds: ~reduce(or_, [_is(x["k"], k) for k in kinds])
        elif word == "enum":
            rule = lambda x, arg=arg: ~reduce(or_, [_equals(x, y) for y in arg])
        elif word == "const":
            rule = lambda x, arg=arg: ~_equals(x, arg)
        elif word == "required":
            node.takes.add("m")
            for name in arg:
                add_rule(f"{path}.{name}:required", on("object", lambda x, name=name: x["m"][name].isNull()))
        elif word == "properties":
            node.takes.add("m")
            for name, sub in arg.items():
                node.fields.append((name, _compile(sub, f"{path}.{name}", root, seen, names)))
        elif word == "additionalProperties":
            if arg not in (True, False):
                raise ValueError("additionalProperties must be true or false")
            known = list(schema.get("properties", {}))
            if arg is False:
                node.takes.add("m")
                rule = on("object", lambda x: F.exists(F.map_keys(x["m"]), lambda k: ~k.isin(known) if known else F.lit(True)))
        elif word == "items":
            node.takes.add("e")
            node.items.append(_compile(arg, f"{path}[*]", root, seen, names))
        elif word == "uniqueItems":
            node.takes.add("e")
            twice = lambda x: _let(F.transform(x["e"], lambda y: F.to_json(y)), lambda p: F.size(F.array_distinct(p)) != F.size(p), "boolean")
            rule = on("array", lambda x: (F.size(x["e"]) > 1) & twice(x)) if arg else None
        elif word in ("minItems", "maxItems"):
            node.takes.add("e")
            rule = on("array", lambda x, arg=arg, low=word[:3] == "min": F.size(x["e"]) < arg if low else F.size(x["e"]) > arg)
        elif word in ("minLength", "maxLength"):
            rule = on("string", lambda x, arg=arg, low=word[:3] == "min": F.length(text(x)) < arg if low else F.length(text(x)) > arg)
        elif word == "pattern":
            rule = on("string", lambda x, arg=arg: ~text(x).rlike(arg))
        elif word == "format" and arg in moment:
            rule = on("string", lambda x, arg=arg: F.try_to_timestamp(text(x), F.lit(moment[arg])).isNull())
        elif word in ("minimum", "maximum", "exclusiveMinimum", "exclusiveMaximum"):
            test = {"minimum": lambda x, y: x < y, "maximum": lambda x, y: x > y,
                    "exclusiveMinimum": lambda x, y: x <= y, "exclusiveMaximum": lambda x, y: x >= y}[word]
            rule = on("number", lambda x, arg=arg, test=test: test(num(x), F.lit(float(arg))))
        elif word in ("oneOf", "anyOf", "allOf"):
            branches = []
            for sub in arg:
                own: list[str] = []
                branch = _compile(sub, path, root, seen, own)
                node.takes |= branch.takes
                branches.append((branch, range(0, len(own), _BITS)))

            def matching(x, branches=branches):
                fits = lambda b, ats: reduce(and_, [b.bits(x, at) == 0 for at in ats], F.lit(True))
                return reduce(add, [fits(b, ats).cast("int") for b, ats in branches])
            rule = {"oneOf": lambda x, m=matching: m(x) != 1, "anyOf": lambda x, m=matching: m(x) == 0,
                    "allOf": lambda x, m=matching, n=len(branches): m(x) < n}[word]
        else:
            raise ValueError(f"unsupported JSON-Schema keyword at {path}: {word}" + (f" = {arg}" if word == "format" else ""))
        if rule is not None:
            add_rule(f"{path}:{word}", rule)
    for n in node.same:
        node.takes |= n.takes
    return node


def schema_violations(df: DataFrame, schema: dict, doc_col: str, id_col: str) -> DataFrame:
    """DQ-17: one row per (document, violated rule); unparsable JSON is a
    violation of its own."""
    # parsed once: the rules refer to the parsed column
    df = df.select(id_col, F.try_parse_json(F.col(doc_col)).alias("__v"))
    return df.select(id_col, F.explode(_violations(schema, F.col("__v"))).alias("violation"))


def validate_documents(df: DataFrame, schema: dict, doc_col: str, id_col: str,
                       level: str = "strict", action: str = "error",
                       previously_valid: Column | None = None) -> DataFrame:
    """DQ-18: document validator.  level strict checks every document,
    moderate only new documents and those valid before (``previously_valid``
    column, default all new).  action error rejects, warn accepts with the
    warning.  Output adds ``status`` accepted | rejected | warned and
    ``violations``."""
    df = df.withColumn("__v", F.try_parse_json(F.col(doc_col)))
    arr = _violations(schema, F.col("__v"))
    checked = F.lit(True) if level == "strict" else F.coalesce(previously_valid, F.lit(True)) \
        if previously_valid is not None else F.lit(True)
    bad = checked & (F.size(arr) > 0)
    status = F.when(~bad, "accepted").when(F.lit(action == "error"), "rejected").otherwise("warned")
    return df.withColumn("violations", arr).withColumn("status", status).drop("__v")


def dimension_scores(df: DataFrame, source: str, key: str, required: Sequence[str], valid: Column,
                     fk: tuple[str, DataFrame, str] | None, ts: str | None, max_age_days: int,
                     target: float = 0.95,
                     trusted: tuple[DataFrame, str, dict[str, tuple[Column, float]]] | None = None) -> DataFrame:
    """DQ-15: quality dimensions of one source as shares in [0, 1]: accuracy
    (agreement with a trusted table: ``trusted`` gives it, its key, and for each
    field a condition over both tables' columns and a weight; the weighted mean
    of the fields' shares among the rows that the trusted table knows),
    completeness (non-null required cells), uniqueness (distinct keys per
    row), validity (rows passing ``valid``), consistency (rows whose foreign
    key exists in the parent), timeliness (rows within ``max_age_days`` of
    the newest row); plus their mean as 'overall'.  One aggregate pass,
    plus one join for consistency.  Output: source, dimension, score, passed."""
    from oreflow.functions.numeric import round_half_up
    base = df
    if fk is not None:
        col, parent, pkey = fk
        pk = parent.select(F.col(pkey).alias("__pk")).distinct()
        base = base.join(pk, base[col] == pk["__pk"], "left")
    newest = df.select(F.max(ts)).scalar() if ts else None
    n = F.count(F.lit(1))
    agreed = {}
    if trusted is not None:
        other, other_key, fields = trusted
        base = base.join(other, base[key] == other[other_key], "left")
        known = F.count_if(F.col(other_key).isNotNull())
        weights = sum(w for _, w in fields.values())
        shares = [F.count_if(F.col(other_key).isNotNull() & F.coalesce(same, F.lit(False))) * F.lit(w) for same, w in fields.values()]
        agreed = {"accuracy": sum(shares) / (F.lit(float(weights)) * F.nullif(known, F.lit(0)))}
    scores = agreed | {
        "completeness": sum(F.count(c) for c in required) / (F.lit(float(len(required))) * n),
        "uniqueness": F.count_distinct(key) / n,
        "validity": F.count_if(valid) / n,
    }
    if fk is not None:
        scores["consistency"] = F.count_if(F.col("__pk").isNotNull()) / n
    if ts:
        scores["timeliness"] = F.count_if(F.col(ts) >= newest - F.make_dt_interval(F.lit(max_age_days))) / n
    wide = base.agg(*[e.alias(k) for k, e in scores.items()])
    names = list(scores)
    overall = sum(F.col(k) for k in names) / F.lit(float(len(names)))
    rows = F.array(*[F.struct(F.lit(k).alias("dimension"), F.col(k).alias("score")) for k in names],
                   F.struct(F.lit("overall").alias("dimension"), overall.alias("score")))
    return (wide.select(F.explode(rows).alias("r"))
            .select(F.lit(source).alias("source"), "r.dimension",
                    round_half_up(F.col("r.score"), 4).alias("score"),
                    (F.col("r.score") >= target).alias("passed")))

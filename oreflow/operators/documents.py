"""Document operators: JSON paths and containment on VARIANT, XML paths,
and the document-modelling patterns (bucket, computed, attribute, subset,
extended reference, schema versioning, polymorphic read).

JSON text is parsed once into VARIANT (``try_parse_json``: malformed text
becomes NULL instead of failing the job); paths are then read with
``try_variant_get``.  JSONPath filters are not evaluated by a path engine:
arrays are typed with ``variant_get(..., 'array<...>')`` and filtered with
Spark's higher-order functions (gotcha G18).
"""

from __future__ import annotations

import json
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def _keys(keys) -> list[str]:
    return [keys] if isinstance(keys, str) else list(keys)


# --------------------------------------------------------------------- JSON
def parse(col) -> Column:
    """SRC-03: JSON text -> VARIANT; malformed documents become NULL."""
    return F.try_parse_json(_c(col))


def path(v, json_path: str, type_: str = "string") -> Column:
    """DOC-01 (``->>``/``->`` then cast): typed value at a path, NULL when
    the path is missing or the value does not fit the type."""
    return F.try_variant_get(_c(v), json_path, type_)


def has_key(json_text, key: str) -> Column:
    """DOC-03 (``doc ? 'k'``): the top-level key exists, whatever its value
    (a key with JSON null still exists; a missing key does not)."""
    return F.coalesce(F.array_contains(F.json_object_keys(_c(json_text)), F.lit(key)), F.lit(False))


def array_has(v, json_path: str, value: str) -> Column:
    """DOC-03 (``doc->'tags' ? 'x'``): a string array at ``json_path`` holds
    ``value``."""
    return F.coalesce(F.array_contains(path(v, json_path, "array<string>"), F.lit(value)), F.lit(False))


def _literal_type(x) -> str:
    if isinstance(x, bool):
        return "boolean"
    if isinstance(x, int):
        return "bigint"
    if isinstance(x, float):
        return "double"
    return "string"


def contains(v, pattern: Mapping | str, prefix: str = "$") -> Column:
    """DOC-02 (``doc @> pattern``): every scalar of the pattern equals the
    document's value at the same path; nested objects recurse; a pattern
    array must be a subset of the document array (scalars only)."""
    if isinstance(pattern, str):
        pattern = json.loads(pattern)
    conds = []
    for k, x in pattern.items():
        p = f"{prefix}.{k}"
        if isinstance(x, Mapping):
            conds.append(contains(v, x, p))
        elif isinstance(x, list):
            for item in x:
                arr = path(v, p, f"array<{_literal_type(item)}>")
                conds.append(F.coalesce(F.array_contains(arr, F.lit(item)), F.lit(False)))
        else:
            conds.append(F.coalesce(path(v, p, _literal_type(x)) == F.lit(x), F.lit(False)))
    out = F.lit(True)
    for c in conds:
        out = out & c
    return out


def array_elements(v, json_path: str, element_type: str) -> Column:
    """DOC-04/06: the array at ``json_path`` typed as ``array<element_type>``
    (struct element types allowed), for ``explode``/``filter``/``exists``."""
    return path(v, json_path, f"array<{element_type}>")


# ---------------------------------------------------------------------- XML
def xpath_text(xml, xp: str) -> Column:
    """DOC-09: first text value at an XPath (Spark ignores the default
    namespace, G19, so ``//name`` matches in a namespaced document)."""
    return F.xpath_string(_c(xml), F.lit(xp))


def title_text(html) -> Column:
    """DOC-09: text of an HTML title's content.  Titles may be cut off in an
    entity or hold bare ``&`` and ``<``, which no XML document may: all but
    ``&amp;`` stands for itself.  A title with a character that XML has no way to
    write (control characters) is decoded as plain text."""
    t = _c(html)
    own = F.regexp_replace(t, "&(?!amp;)", "&amp;")
    for mark, name in (("<", "&lt;"), (">", "&gt;"), ("\r", "&#13;")):
        own = F.replace(own, F.lit(mark), F.lit(name))
    xml = F.concat(F.lit("<title>"), own, F.lit("</title>"))
    return F.when(t.rlike("[\\x00-\\x08\\x0B\\x0C\\x0E-\\x1F\\uFFFE\\uFFFF]"), F.replace(t, F.lit("&amp;"), F.lit("&"))) \
        .otherwise(xpath_text(xml, "/title"))


def xpath_number(xml, xp: str) -> Column:
    return F.xpath_double(_c(xml), F.lit(xp))


def xpath_all(xml, xp: str) -> Column:
    return F.xpath(_c(xml), F.lit(xp))


# ----------------------------------------------------------------- patterns
def bucket_fold(df: DataFrame, keys: Sequence[str], ts: str, width: str, cap: int,
                reading: Column, value: str) -> DataFrame:
    """DOC-12 (bucket pattern): readings folded into per-key time buckets of
    at most ``cap`` readings each, with count, min, max, sum and the
    readings array sorted by time.

    A full time bucket spills into bucket_no 1, 2, ...: the position inside
    (key, window) comes from a window over that small group, never from a
    whole key."""
    keys = _keys(keys)
    win = F.window(_c(ts), width).start
    d = df.withColumn("bucket_start", win)
    w = Window.partitionBy(*keys, "bucket_start").orderBy(_c(ts), reading)
    d = d.withColumn("bucket_no", F.floor((F.row_number().over(w) - 1) / cap).cast("int"))
    return d.groupBy(*keys, "bucket_start", "bucket_no").agg(
        F.count(F.lit(1)).alias("count"), F.min(value).alias("min_value"),
        F.max(value).alias("max_value"), F.sum(value).alias("sum_value"),
        F.array_sort(F.collect_list(reading)).alias("readings"))


def bucket_unfold(buckets: DataFrame, keys: Sequence[str], readings: str = "readings") -> DataFrame:
    """DOC-13: one row per stored reading again."""
    return buckets.select(*_keys(keys), "bucket_start", F.explode(readings).alias("r")).select(
        *_keys(keys), "bucket_start", "r.*")


def bucket_rollup(buckets: DataFrame, keys: Sequence[str]) -> DataFrame:
    """DOC-13: analytics from stored bucket statistics: max of maxes, min of
    mins, and the average recombined by counts (not an average of averages)."""
    return buckets.groupBy(*_keys(keys)).agg(
        F.sum("count").alias("n"), F.min("min_value").alias("min_value"),
        F.max("max_value").alias("max_value"),
        (F.sum("sum_value") / F.sum("count")).alias("avg_value"),
        F.count(F.lit(1)).alias("n_buckets"))


def attribute_array(df: DataFrame, id_cols: Sequence[str], attrs: Mapping[str, Column],
                    unit: Mapping[str, str] | None = None, out: str = "metrics") -> DataFrame:
    """DOC-15: columns -> array of {key, value, unit} (attribute pattern)."""
    unit = unit or {}
    items = [F.struct(F.lit(k).alias("key"), c.cast("double").alias("value"),
                      F.lit(unit.get(k)).cast("string").alias("unit")) for k, c in attrs.items()]
    return df.select(*_keys(id_cols), F.array(*items).alias(out))


def attribute_match(arr, key: str, pred) -> Column:
    """DOC-15 / PF-15 ($elemMatch): one element satisfies both the key test
    and the value predicate."""
    return F.exists(_c(arr), lambda e: (e["key"] == F.lit(key)) & pred(e["value"]))


def attribute_pivot(df: DataFrame, id_cols: Sequence[str], arr: str = "metrics") -> DataFrame:
    """DOC-15: attribute array -> map key -> value."""
    return df.select(*_keys(id_cols), F.map_from_entries(
        F.transform(arr, lambda e: F.struct(e["key"], e["value"]))).alias("attrs"))


def subset_pattern(parent: DataFrame, child: DataFrame, parent_key: str, child_key: str,
                   order: Sequence[Column], n: int, fields: Sequence[str], out: str = "recent") -> DataFrame:
    """DOC-16 (subset pattern): the newest ``n`` children embedded in the
    parent, plus the total child count; children are cut to ``n`` per
    parent before they are collected."""
    w = Window.partitionBy(child_key).orderBy(*order)
    top = (child.withColumn("__rn", F.row_number().over(w)).where(F.col("__rn") <= n)
           .groupBy(child_key).agg(F.array_sort(F.collect_list(
               F.struct(F.col("__rn").alias("pos"), *[F.col(f) for f in fields]))).alias(out)))
    cnt = child.groupBy(child_key).agg(F.count(F.lit(1)).alias("n_children"))
    j = (parent.join(top, parent[parent_key] == top[child_key], "left").drop(top[child_key])
         .join(cnt, parent[parent_key] == cnt[child_key], "left").drop(cnt[child_key]))
    return j.withColumn("n_children", F.coalesce("n_children", F.lit(0)).cast("long"))


def unify_versions(v, version_path: str = "$.schema_version") -> Column:
    """DOC-17: read schema v1 {latitude, longitude, level} and v2
    {location: {coordinates: [lng, lat]}, level} into one struct
    {lat, lon, level}.  Note the axis order of v2 (longitude first)."""
    ver = path(v, version_path, "int")
    v1 = F.struct(path(v, "$.latitude", "double").alias("lat"),
                  path(v, "$.longitude", "double").alias("lon"),
                  path(v, "$.level", "string").alias("level"))
    coords = path(v, "$.location.coordinates", "array<double>")
    v2 = F.struct(F.try_element_at(coords, F.lit(2)).alias("lat"), F.try_element_at(coords, F.lit(1)).alias("lon"),
                  path(v, "$.level", "string").alias("level"))
    return F.when(ver == 2, v2).otherwise(v1)

"""Join operators beyond Spark's built-in equi joins.

Range conditions without an equi key make Spark fall back to a nested-loop
join.  The helpers here add a time-bucket equi key so the join stays a hash
or sort-merge join, and the bucket also splits a hot entity key into many
shuffle keys (one third of all rows on one key is still spread over time).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window

from oreflow.functions.timefn import epoch_seconds
from oreflow.operators.windows import bucketed_last


def _keys(keys) -> list[str]:
    if keys is None:
        return []
    return [keys] if isinstance(keys, str) else list(keys)


def interval_join(left: DataFrame, right: DataFrame, keys: Sequence[str],
                  left_ts: str, right_ts: str, before_s: float, after_s: float,
                  how: str = "inner", bucket_s: float | None = None,
                  left_id: str | None = None) -> DataFrame:
    """Rows of ``left`` matched to rows of ``right`` with equal ``keys`` and
    ``right_ts - before_s <= left_ts <= right_ts + after_s`` (JN-10).

    Each right row is put in exactly one bucket of width ``bucket_s``; each
    left row is replicated to the (few) buckets its tolerance interval
    touches, so every qualifying pair meets exactly once and no duplicates
    arise.  ``how`` is 'inner' or 'left' (left rows without a partner kept,
    right columns NULL).  Column names of the two sides must not overlap
    except for ``keys``; ``how='left'`` needs ``left_id``, a unique column
    of ``left``.
    """
    keys = _keys(keys)
    width = float(bucket_s or max(before_s + after_s, 1.0))
    lt, rt = F.col(left_ts), F.col(right_ts)
    l_e = epoch_seconds(lt)
    r_b = F.floor(epoch_seconds(rt) / width)
    lo = F.floor((l_e - after_s) / width)
    hi = F.floor((l_e + before_s) / width)
    lb = left.withColumn("__b", F.explode(F.sequence(lo, hi)))
    rb = right.withColumn("__b", r_b)
    cond = [lb[k] == rb[k] for k in keys] + [lb["__b"] == rb["__b"]]
    rng = ((lb[left_ts] >= rb[right_ts] - F.make_dt_interval(secs=F.lit(before_s)))
           & (lb[left_ts] <= rb[right_ts] + F.make_dt_interval(secs=F.lit(after_s))))
    out_cols = [lb[c] for c in left.columns] + [rb[c] for c in right.columns if c not in keys]
    if how == "inner":
        return lb.join(rb, cond + [rng], "inner").select(*out_cols)
    if how != "left" or not left_id:
        raise ValueError("how must be 'inner', or 'left' with left_id")
    # one left-outer pass over the bucket copies; per left row keep its
    # matches, or (no match in any of its buckets) exactly one row with NULL
    # right columns.  The window groups one left row's few copies only.
    rmark = rb.withColumn("__hit", F.lit(True))
    j = lb.join(rmark, cond + [rng], "left")
    w = Window.partitionBy(lb[left_id])
    j = (j.select(*out_cols, lb["__b"].alias("__lb"), F.coalesce(rmark["__hit"], F.lit(False)).alias("__hit"))
         .withColumn("__any", F.max("__hit").over(w)).withColumn("__first", F.min("__lb").over(w)))
    return (j.where(F.col("__hit") | (~F.col("__any") & (F.col("__lb") == F.col("__first"))))
            .drop("__lb", "__hit", "__any", "__first"))


def range_count(windows: DataFrame, events: DataFrame, keys: Sequence[str],
                start: str, end: str, ts: str, out: str = "n_events",
                bucket_s: float = 3600.0) -> DataFrame:
    """For each window row, the number of events with equal keys and
    ``start <= ts < end`` (JN-11); windows without events get 0.

    Windows are replicated to the buckets they span (bounded by the window
    length / bucket width), events sit in one bucket: an equi join.  A window
    is identified by (keys, start, end); hits are pre-aggregated to that
    grain before joining back.
    """
    keys = _keys(keys)
    ident = keys + [start, end]
    wb = windows.select(*keys, start, end,
                  F.explode(F.sequence(F.floor(epoch_seconds(F.col(start)) / bucket_s),
                                       F.floor(epoch_seconds(F.col(end)) / bucket_s))).alias("__b"))
    eb = events.select(*keys, F.col(ts).alias("__ts"),
                       F.floor(epoch_seconds(F.col(ts)) / bucket_s).alias("__b"))
    hits = (wb.join(eb, keys + ["__b"], "inner")
            .where((F.col("__ts") >= F.col(start)) & (F.col("__ts") < F.col(end)))
            .groupBy(*ident).agg(F.count(F.lit(1)).alias(out)))
    return (windows.join(hits, ident, "left")
            .withColumn(out, F.coalesce(F.col(out), F.lit(0)).cast("long")))


def first_event_before(df: DataFrame, keys: Sequence[str], ts: str, is_first: Column,
                       is_target: Column, mode: str = "first_any",
                       out: str = "first_ts", bucket_s: int = 7 * 86400) -> DataFrame:
    """JN-12: for every target row (e.g. ALARM) the time of a 'first' event
    (e.g. WARN) of the same key.

    * ``first_any``: MIN(ts) of first-events per key, as the reference does
      (the warning may even come after the alarm);
    * ``first_before``: the same minimum, kept only when it is not after the
      target (the ordered reading);
    * ``latest_before``: the last first-event at or before the target (an
      as-of join), carried over the key's time buckets.
    The first two are a grouped minimum joined back (no window)."""
    keys = _keys(keys)
    if mode in ("first_any", "first_before"):
        firsts = df.where(is_first).groupBy(*keys).agg(F.min(ts).alias(out))
        j = df.where(is_target).join(firsts, keys, "inner")
        return j if mode == "first_any" else j.where(F.col(out) <= F.col(ts))
    if mode != "latest_before":
        raise ValueError(mode)
    # a first event of the same time counts as before
    marked = df.where(is_first | is_target).withColumn("__t", F.coalesce(is_target, F.lit(False)).cast("int"))
    return (bucketed_last(marked, keys, ts, ["__t"], bucket_s, F.when(is_first, F.col(ts)), out)
            .where(is_target & F.col(out).isNotNull()).drop("__t"))


def point_in_time_join(fact: DataFrame, dim: DataFrame, keys: Sequence[str],
                       fact_ts: str, valid_from: str, valid_to: str,
                       how: str = "left", bucket_s: int = 30 * 86400) -> DataFrame:
    """Attach the dimension version valid at the fact's time (JN-20, JN-21):
    ``valid_from <= fact_ts < valid_to``; versions of a key do not overlap.

    A segmented scan: facts and the starts of versions lie together by (key,
    time bucket), and the last version before a fact is its candidate; what
    holds at a bucket's beginning comes from a table of bucket edges.  A key with
    a third of all facts is spread over its buckets, and no fact meets more than
    one version.  NULL keys and facts without a time match nothing."""
    keys = _keys(keys)
    at = lambda c: F.col(c).cast("timestamp_ntz")
    version = [c for c in dim.columns if c not in keys]
    f = fact.select(*keys, at(fact_ts).alias("__ts"), F.struct(*[F.col(c) for c in fact.columns]).alias("__f"),
                    F.lit(1).alias("__k"), F.lit(None).cast("timestamp_ntz").alias("__to"))
    v = dim.where(F.col(valid_from).isNotNull()).select(
        *keys, at(valid_from).alias("__ts"), F.lit(0).alias("__k"), at(valid_to).alias("__to"),
        F.struct(at(valid_to).alias("until"), F.struct(*[F.col(c) for c in version]).alias("row")).alias("__d"))
    u = f.unionByName(v, allowMissingColumns=True)
    j = bucketed_last(u, keys, "__ts", ["__k", "__to"], bucket_s, F.col("__d"), "__hit").where(F.col("__f").isNotNull())
    known = F.lit(True)
    for k in keys:
        known = known & F.col(k).isNotNull()
    hit = known & (F.col("__ts") < F.col("__hit.until"))
    if how == "inner":
        j = j.where(hit)
    elif how != "left":
        raise ValueError("how must be 'inner' or 'left'")
    return j.select(*[F.col(f"__f.{c}").alias(c) for c in fact.columns],
                    *[F.when(hit, F.col(f"__hit.row.{c}")).alias(c) for c in version])


def lookup_array(parent: DataFrame, child: DataFrame, parent_key: str,
                 child_key: str, as_col: str, fields: Sequence[str],
                 order_by: str | None = None) -> DataFrame:
    """$lookup: every parent row gets the array of its matching child rows
    (empty array if none) (JN-17).  Children are grouped before the join, so
    no parent row is multiplied."""
    sfields = list(fields)
    if order_by and order_by not in sfields:
        sfields = [order_by] + sfields
    elif order_by:
        sfields = [order_by] + [f for f in sfields if f != order_by]
    st = F.struct(*[F.col(f) for f in sfields])
    grouped = child.groupBy(F.col(child_key).alias("__k")).agg(
        F.array_sort(F.collect_list(st)).alias(as_col))
    joined = parent.join(grouped, parent[parent_key] == grouped["__k"], "left").drop("__k")
    empty = F.array().cast(grouped.schema[as_col].dataType)
    return joined.withColumn(as_col, F.coalesce(F.col(as_col), empty))


def rule_join(events: DataFrame, rules: DataFrame, key: str, value: str,
              cond_col: str = "condition_type", lo: str = "threshold_low",
              hi: str = "threshold_high", active: str | None = "is_active") -> DataFrame:
    """Theta join of events with threshold rules (JN-09): rules of the same
    type whose condition holds — 'gt': value > hi; 'lt': value < lo;
    'range': value outside [lo, hi].  Spark broadcasts the rules if their size
    allows it, else joins by type."""
    r = rules.where(F.col(active)) if active else rules
    v = F.col(value)
    hit = (((F.col(cond_col) == "gt") & (v > F.col(hi)))
           | ((F.col(cond_col) == "lt") & (v < F.col(lo)))
           | ((F.col(cond_col) == "range") & ((v < F.col(lo)) | (v > F.col(hi)))))
    return events.join(r, key, "inner").where(hit)

"""Window-function operators: gap sessions and moving-average crossovers."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window

from oreflow.functions.timefn import epoch_seconds


def _keys(keys) -> list[str]:
    return [keys] if isinstance(keys, str) else list(keys)


# bucket of rows without a time: they sort before all others, as in a plain window
NO_TIME = -(1 << 62)


def time_bucket(ts: str, bucket_s: int):
    return F.coalesce(F.floor(epoch_seconds(F.col(ts)) / F.lit(float(bucket_s))).cast("long"), F.lit(NO_TIME))


def null_safe_join(left: DataFrame, right: DataFrame, keys: Sequence[str], how: str = "inner") -> DataFrame:
    """Join on ``keys`` where NULL equals NULL; the keys come from ``left``."""
    other = {k: f"__r_{k}" for k in keys}
    right = right.withColumnsRenamed(other)
    cond = F.lit(True)
    for k in keys:
        cond = cond & F.col(k).eqNullSafe(F.col(other[k]))
    return left.join(right, cond, how).drop(*other.values())


def bucketed_window(df: DataFrame, keys: Sequence[str], ts: str, tiebreak: str, bucket_s: int,
                    preceding: int, following: int, columns) -> DataFrame:
    """Row-frame window computations partitioned by (key, time bucket)
    instead of by key, with exact results.

    ``columns`` maps output names to functions ``WindowSpec -> Column``; the
    spec passed in is partitioned by the keys and the bucket and ordered by
    (ts, tiebreak).  A frame may reach ``preceding`` rows back and
    ``following`` rows ahead.  Each bucket therefore receives, besides its
    own rows, the last rows of the buckets before it and the first rows of
    the buckets after it that its frames can reach ("halo" rows); which
    bucket needs which halo row follows from a per-key table of bucket row
    counts (one row per bucket).  Results are kept for the own rows only.

    Why: a window partitioned by key alone puts every row of a hot key (a
    third of all rows, say) into one task; here the key is spread over its
    time buckets and only bounded halos are copied."""
    keys = list(keys)
    order = [F.col(ts), F.col(tiebreak)]
    base_cols = df.columns
    d = df.withColumn("__b", time_bucket(ts, bucket_s))
    own = d.select(*base_cols, F.col("__b").alias("__t"), F.lit(True).alias("__own"))
    # per bucket: rows before it, and the buckets near enough to lend it rows (each has
    # a row at least, so no more of them than the frame reaches)
    wk = Window.partitionBy(*keys).orderBy("__b")
    counts = d.groupBy(*keys, "__b").agg(F.count(F.lit(1)).alias("__n"))
    counts = counts.withColumn("__cb", F.coalesce(F.sum("__n").over(wk.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
    bucket = F.struct(F.col("__b").alias("b"), F.col("__cb").alias("cb"), F.col("__n").alias("n"))
    near = []
    if preceding:
        short = lambda x: F.lit(preceding) - (F.col("__cb") - x["cb"] - x["n"])
        counts = counts.withColumn("__before", F.collect_list(bucket).over(wk.rowsBetween(-preceding, -1)))
        near.append(F.transform(F.filter("__before", lambda x: short(x) > 0),
                                lambda x: F.struct(x["b"].alias("b"), (x["n"] - short(x)).alias("lo"), x["n"].alias("hi"))))
    if following:
        more = lambda x: F.lit(following) - (x["cb"] - F.col("__cb") - F.col("__n"))
        counts = counts.withColumn("__after", F.collect_list(bucket).over(wk.rowsBetween(1, following)))
        near.append(F.transform(F.filter("__after", lambda x: more(x) > 0),
                                lambda x: F.struct(x["b"].alias("b"), F.lit(0).cast("long").alias("lo"), more(x).alias("hi"))))
    lend = counts.withColumn("__near", F.concat(*near)).select(*keys, F.col("__b").alias("__t"), F.explode("__near").alias("x")) \
        .select(*keys, F.col("x.b").alias("__b"), "__t", F.col("x.lo").alias("__lo"), F.col("x.hi").alias("__hi"))
    numbered = d.withColumn("__rs", F.row_number().over(Window.partitionBy(*keys, "__b").orderBy(*order)))
    halo = null_safe_join(numbered, lend, keys + ["__b"]).where((F.col("__rs") > F.col("__lo")) & (F.col("__rs") <= F.col("__hi")))
    out = own.unionByName(halo.select(*base_cols, "__t", F.lit(False).alias("__own")))
    spec = Window.partitionBy(*keys, "__t").orderBy(*order)
    for name, fn in columns.items():
        out = out.withColumn(name, fn(spec))
    return out.where(F.col("__own")).drop("__t", "__own")


def _with_edges(d: DataFrame, edges: DataFrame, first: bool) -> tuple[DataFrame, str]:
    """Rows with one more row per (key, bucket) that brings what other buckets
    know: the first (else the last) of its bucket by the column returned."""
    rows = d.withColumn("__side", F.lit(0)).unionByName(
        edges.withColumn("__side", F.lit(-1 if first else 1)), allowMissingColumns=True)
    return rows, "__side"


def bucketed_neighbour(df: DataFrame, keys: Sequence[str], ts: str, tiebreak: str, bucket_s: int,
                       value: str, out: str, following: bool = False) -> DataFrame:
    """``value`` of the key's previous row (``following``: next row) in
    (ts, tiebreak) order: from the row's own time bucket, or for the first
    (last) row of a bucket from the edge of the nearest bucket that has rows,
    found in a table of one row per (key, bucket).  The same rows as LAG/LEAD
    over the key, without a window that spans a key; rows are shuffled once."""
    keys = list(keys)
    near, edge = (F.lead, F.min_by) if following else (F.lag, F.max_by)
    d = df.withColumn("__b", time_bucket(ts, bucket_s)).withColumn("__v", F.struct(F.col(value).alias("v")))
    per = d.groupBy(*keys, "__b").agg(edge("__v", F.struct(ts, tiebreak)).alias("__e"))
    per = per.withColumn("__v", near("__e").over(Window.partitionBy(*keys).orderBy("__b"))) \
        .where(F.col("__v").isNotNull()).select(*keys, "__b", "__v")
    rows, side = _with_edges(d, per, not following)
    got = near("__v").over(Window.partitionBy(*keys, "__b").orderBy(side, ts, tiebreak))
    return rows.withColumn(out, got["v"]).where(F.col(side) == 0).drop("__b", "__v", side)


def bucketed_running_sum(df: DataFrame, keys: Sequence[str], ts: str, tiebreak: str, bucket_s: int,
                         value: str, out: str) -> DataFrame:
    """Running sum of ``value`` per key in (ts, tiebreak) order: each bucket
    begins with the sum of all earlier ones (a prefix over one row per bucket),
    so no window spans a whole key; rows are shuffled once."""
    keys = list(keys)
    d = df.withColumn("__b", time_bucket(ts, bucket_s)).withColumn("__v", F.col(value))
    per = d.groupBy(*keys, "__b").agg(F.sum("__v").alias("__s"))
    per = per.withColumn("__v", F.sum("__s").over(
        Window.partitionBy(*keys).orderBy("__b").rowsBetween(Window.unboundedPreceding, -1))) \
        .where(F.col("__v").isNotNull()).select(*keys, "__b", "__v")
    rows, side = _with_edges(d, per, True)
    total = F.sum("__v").over(Window.partitionBy(*keys, "__b").orderBy(side, ts, tiebreak)
                              .rowsBetween(Window.unboundedPreceding, 0))
    return rows.withColumn(out, total).where(F.col(side) == 0).drop("__b", "__v", side)


def bucketed_last(df: DataFrame, keys: Sequence[str], ts: str, order: Sequence[str], bucket_s: int,
                  value, out: str) -> DataFrame:
    """The last value that is not NULL of the key's rows up to each row, in
    (ts, *order*) order: a segmented scan.  Each bucket begins with what the
    buckets before it carried (from a table of one row per bucket)."""
    keys, order = list(keys), list(order)
    d = df.withColumn("__b", time_bucket(ts, bucket_s)).withColumn("__v", value)
    # only rows with a value are sorted for their bucket's last one; of the others their
    # buckets are enough, and a bucket of values alone needs no edge
    ends = d.where(F.col("__v").isNotNull()).groupBy(*keys, "__b").agg(F.max_by("__v", F.struct(ts, *order)).alias("__e"))
    asked = d.where(F.col("__v").isNull()).select(*keys, "__b").distinct()
    per = asked.withColumn("__n", F.lit(0)).unionByName(ends.withColumn("__n", F.lit(1)), allowMissingColumns=True)
    per = per.withColumn("__v", F.last("__e", ignorenulls=True).over(
        Window.partitionBy(*keys).orderBy("__b", "__n").rowsBetween(Window.unboundedPreceding, -1))) \
        .where((F.col("__n") == 0) & F.col("__v").isNotNull()).select(*keys, "__b", "__v")
    rows, side = _with_edges(d, per, True)
    got = F.last("__v", ignorenulls=True).over(Window.partitionBy(*keys, "__b").orderBy(side, ts, *order)
                                               .rowsBetween(Window.unboundedPreceding, 0))
    return rows.withColumn(out, got).where(F.col(side) == 0).drop("__b", "__v", side)


def sessions_by_gap(df: DataFrame, keys: Sequence[str], ts: str, gap_s: float,
                    order_tiebreak: str | None = None, bucket_s: int | None = None) -> DataFrame:
    """WN-09 / ST-03 (batch): a new session starts when the time since the
    key's previous row exceeds ``gap_s``; session id = running sum of the
    start flags (ROWS frame, so ties in time do not merge).  One row per
    session: start, end (last event, not last event + gap), count,
    duration in whole seconds.  A gap of exactly ``gap_s`` stays in the
    session.  With ``bucket_s`` (needs ``order_tiebreak``) sessions are cut at
    bucket borders and joined again, so a hot key is spread over its buckets."""
    keys = _keys(keys)
    gap = F.make_dt_interval(secs=F.lit(gap_s))
    if bucket_s and order_tiebreak:
        return _sessions_by_bucket(df, keys, ts, gap, order_tiebreak, bucket_s)
    order = [F.col(ts)] + ([F.col(order_tiebreak)] if order_tiebreak else [])
    w = Window.partitionBy(*keys).orderBy(*order)
    prev = F.lag(ts).over(w)
    new = F.when(prev.isNull() | (F.col(ts) - prev > gap), 1).otherwise(0)
    s = (df.withColumn("__new", new)
         .withColumn("session_no", F.sum("__new").over(w.rowsBetween(Window.unboundedPreceding, 0))))
    return s.groupBy(*keys, "session_no").agg(
        F.min(ts).alias("session_start"), F.max(ts).alias("session_end"),
        F.count(F.lit(1)).alias("n_events")).withColumn(
        "duration_s", F.timestamp_diff("SECOND", F.col("session_start"), F.col("session_end")))


def _sessions_by_bucket(df: DataFrame, keys: list[str], ts: str, gap, tiebreak: str, bucket_s: int) -> DataFrame:
    """Pieces of sessions inside each (key, bucket) first; the bucket table (first
    and last time, breaks inside) tells which pieces go on over a border."""
    d = df.select(*keys, ts, tiebreak).withColumn("__b", time_bucket(ts, bucket_s))
    w = Window.partitionBy(*keys, "__b").orderBy(ts, tiebreak)
    prev = F.lag(ts).over(w)
    breaks = (F.row_number().over(w) > 1) & (prev.isNull() | (F.col(ts) - prev > gap))
    d = d.withColumn("__new", F.when(breaks, 1).otherwise(0)) \
        .withColumn("__seq", F.sum("__new").over(w.rowsBetween(Window.unboundedPreceding, 0)))
    pieces = d.groupBy(*keys, "__b", "__seq").agg(F.min(ts).alias("__lo"), F.max(ts).alias("__hi"), F.count(F.lit(1)).alias("__n"))
    wk = Window.partitionBy(*keys).orderBy("__b")
    per = pieces.groupBy(*keys, "__b").agg(F.min("__lo").alias("__lo"), F.max("__hi").alias("__hi"), F.max("__seq").alias("__seq"))
    last = F.lag("__hi").over(wk)
    per = per.withColumn("__first", F.when(last.isNull() | (F.col("__lo") - last > gap), 1).otherwise(0))
    per = per.withColumn("__no", F.sum(F.col("__first") + F.col("__seq")).over(wk.rowsBetween(Window.unboundedPreceding, 0)) - F.col("__seq"))
    s = null_safe_join(pieces, per.select(*keys, "__b", "__no"), keys + ["__b"])
    return s.groupBy(*keys, (F.col("__no") + F.col("__seq")).alias("session_no")).agg(
        F.min("__lo").alias("session_start"), F.max("__hi").alias("session_end"), F.sum("__n").alias("n_events")).withColumn(
        "duration_s", F.timestamp_diff("SECOND", F.col("session_start"), F.col("session_end")))


def ma_crossover(df: DataFrame, keys: Sequence[str], ts: str, value: str, fast: int, slow: int,
                 order_tiebreak: str | None = None, bucket_s: int | None = None) -> DataFrame:
    """WN-12: fast minus slow moving average (row frames); rows where the
    sign of the difference flips are crossings ('golden' up, 'death' down).
    Both frames share one partitioning and ordering (one window sort); with
    ``bucket_s`` both passes run per (key, time bucket) with halos."""
    keys = _keys(keys)
    flip = (F.col("prev_signal").isNotNull() & (F.signum("signal") != F.signum("prev_signal"))
            & (F.col("signal") != 0) & (F.col("prev_signal") != 0))
    if bucket_s and order_tiebreak:
        m = bucketed_window(df, keys, ts, order_tiebreak, bucket_s, slow - 1, 0, {
            "ma_fast": lambda w: F.avg(value).over(w.rowsBetween(-(fast - 1), 0)),
            "ma_slow": lambda w: F.avg(value).over(w.rowsBetween(-(slow - 1), 0))})
        m = m.withColumn("signal", F.col("ma_fast") - F.col("ma_slow"))
        x = bucketed_neighbour(m, keys, ts, order_tiebreak, bucket_s, "signal", "prev_signal")
        return x.where(flip).withColumn("cross_type", F.when(F.col("signal") > 0, "golden").otherwise("death"))
    order = [F.col(ts)] + ([F.col(order_tiebreak)] if order_tiebreak else [])
    w = Window.partitionBy(*keys).orderBy(*order)
    x = (df.withColumn("ma_fast", F.avg(value).over(w.rowsBetween(-(fast - 1), 0)))
         .withColumn("ma_slow", F.avg(value).over(w.rowsBetween(-(slow - 1), 0)))
         .withColumn("signal", F.col("ma_fast") - F.col("ma_slow"))
         .withColumn("prev_signal", F.lag("signal").over(w)))
    return x.where(flip).withColumn(
        "cross_type", F.when(F.col("signal") > 0, "golden").otherwise("death"))


def prefix_max_before(df: DataFrame, order_col: str, value: str, out: str, fanout: int = 1024) -> DataFrame:
    """Maximum of ``value`` over all rows with a smaller ``order_col``
    (an exclusive prefix maximum), in two levels: rows are grouped into
    blocks of ``fanout`` consecutive order values; the prefix over block
    maxima is a window over one row per block, the rest is a window inside
    each block.  No window spans the whole table."""
    blk = F.floor(F.col(order_col) / F.lit(fanout)).cast("long")
    d = df.withColumn("__blk", blk)
    per_blk = d.groupBy("__blk").agg(F.max(value).alias("__bm"))
    per_blk = per_blk.withColumn("__before_blk", F.max("__bm").over(
        Window.orderBy("__blk").rowsBetween(Window.unboundedPreceding, -1)))
    inside = F.max(value).over(Window.partitionBy("__blk").orderBy(order_col)
                               .rowsBetween(Window.unboundedPreceding, -1))
    j = d.withColumn("__in", inside).join(per_blk.select("__blk", "__before_blk"), "__blk")
    return j.withColumn(out, F.greatest("__in", "__before_blk")).drop("__blk", "__in", "__before_blk")


def running_stats(df: DataFrame, keys: Sequence[str], ts: str, tiebreak: str, value: str,
                  bucket_s: int | None = None) -> DataFrame:
    """WN-05 / WN-08: per key in (ts, tiebreak) order the running count
    (= row number), running sum and running average.  With ``bucket_s`` the
    sums are a prefix over per-bucket totals plus a running sum inside the
    bucket (no window over a whole key)."""
    keys = list(keys)
    if bucket_s:
        d = bucketed_running_sum(df.withColumn("__one", F.lit(1)), keys, ts, tiebreak, bucket_s, "__one", "seq_no")
        d = bucketed_running_sum(d, keys, ts, tiebreak, bucket_s, value, "running_sum").drop("__one")
    else:
        w = Window.partitionBy(*keys).orderBy(ts, tiebreak).rowsBetween(Window.unboundedPreceding, 0)
        d = df.withColumn("seq_no", F.count(F.lit(1)).over(w)).withColumn("running_sum", F.sum(value).over(w))
    return d.withColumn("running_avg", F.col("running_sum") / F.col("seq_no"))


def rank_by_value(df: DataFrame, keys: Sequence[str], value: str, out: str, descending: bool = True) -> DataFrame:
    """WN-11: SQL ``rank()`` of each row by ``value`` inside its key (ties
    share the rank, gaps follow; NULL keys are one key, NULL values sort as in
    ORDER BY).  Rank = 1 + rows of the key with a better value: a running sum
    over the distinct values, joined back, so a key with a third of all rows
    costs as many window rows as it has distinct values (readings of fixed
    precision have a bounded number)."""
    keys = list(keys)
    vc = df.groupBy(*keys, value).agg(F.count(F.lit(1)).alias("__c"))
    o = F.col(value).desc() if descending else F.col(value).asc()
    before = F.coalesce(F.sum("__c").over(Window.partitionBy(*keys).orderBy(o)
                                          .rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    ranks = vc.select(*keys, value, (before + 1).cast("int").alias(out))
    return null_safe_join(df, ranks, keys + [value])

"""Time-series operators on readings (key columns, a timestamp, a value).

Statistics that need the whole history of a key (mean/std for z-scores)
are computed by a grouped aggregate with map-side partial aggregation and
joined back; Spark's AQE turns the join into a broadcast at runtime when the
statistics table is small, and splits skewed partitions otherwise.  Nothing
collects a key's history into one array.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window

from oreflow.functions.numeric import round_half_up
from oreflow.functions.timefn import epoch_seconds, minutes_between, time_bucket


def _keys(keys) -> list[str]:
    return [keys] if isinstance(keys, str) else list(keys)


# --------------------------------------------------------------------- buckets
def bucket_stats(df: DataFrame, keys: Sequence[str], ts: str, value: str, width: str,
                 quality: str | None = None, digits: int = 2,
                 bucket_col: str = "bucket") -> DataFrame:
    """TS-01/02: per key and fixed-width bucket: count, min, avg, max,
    sample std; with ``quality`` also the number of non-'good' readings."""
    keys = _keys(keys)
    aggs = [F.count(F.lit(1)).alias("n_readings"),
            round_half_up(F.min(value), digits).alias("min_value"),
            round_half_up(F.avg(value), digits).alias("avg_value"),
            round_half_up(F.max(value), digits).alias("max_value"),
            round_half_up(F.stddev(value), digits).alias("std_value")]
    if quality:
        aggs.append(F.count_if(F.col(quality) != "good").alias("n_not_good"))
    return df.groupBy(time_bucket(ts, width).alias(bucket_col), *keys).agg(*aggs)


# ------------------------------------------------------------------- z-scores
def key_stats(df: DataFrame, keys: Sequence[str], value: str) -> DataFrame:
    """Mean, sample std and count per key (partial aggregation map-side)."""
    return df.groupBy(*_keys(keys)).agg(
        F.avg(value).alias("mean_val"), F.stddev(value).alias("std_val"),
        F.count(value).alias("n_val"))


def zscore(df: DataFrame, keys: Sequence[str], value: str,
           stats_filter: Column | None = None) -> DataFrame:
    """Every row with its key's mean/std and z = (v-mean)/std (NULL when
    std is 0 or undefined).  ``stats_filter`` restricts the rows the
    statistics are computed on (G11: 'good' only) while all rows are
    scored."""
    keys = _keys(keys)
    base = df.where(stats_filter) if stats_filter is not None else df
    st = key_stats(base, keys, value)
    z = (F.col(value) - F.col("mean_val")) / F.nullif(F.col("std_val"), F.lit(0.0))
    return df.join(st, keys, "inner").withColumn("z_score", z)


def zscore_anomalies(df: DataFrame, keys: Sequence[str], value: str,
                     warn: float = 2.0, crit: float = 3.0,
                     stats_filter: Column | None = None) -> DataFrame:
    """TS-03: rows more than ``warn`` sample deviations from their key mean,
    classed 'warning' (> warn σ) or 'critical' (> crit σ).  Keys with zero
    deviation produce no anomaly."""
    scored = zscore(df, keys, value, stats_filter)
    dev = F.abs(F.col(value) - F.col("mean_val"))
    return (scored.where(dev > F.lit(warn) * F.col("std_val"))
            .withColumn("category", F.when(dev > F.lit(crit) * F.col("std_val"), "critical")
                        .otherwise("warning")))


def anomaly_counts_by_day(df: DataFrame, keys: Sequence[str], group_keys: Sequence[str],
                          ts: str, value: str) -> DataFrame:
    """TS-05: per day and ``group_keys`` the number of 2σ and 3σ readings
    and all readings; only days with at least one 2σ reading."""
    scored = zscore(df, keys, value)
    dev = F.abs(F.col(value) - F.col("mean_val"))
    return (scored.groupBy(time_bucket(ts, "1 day").alias("day"), *_keys(group_keys))
            .agg(F.count_if(dev > 2 * F.col("std_val")).alias("anomalies_2sigma"),
                 F.count_if(dev > 3 * F.col("std_val")).alias("anomalies_3sigma"),
                 F.count(F.lit(1)).alias("total_readings"))
            .where(F.col("anomalies_2sigma") > 0))


# ------------------------------------------------------------ rolling windows
def rolling_stats(df: DataFrame, keys: Sequence[str], ts: str, value: str, n: int,
                  prefix: str = "ma", order_tiebreak: str | None = None,
                  bucket_s: int | None = None) -> DataFrame:
    """WN-03: moving avg/min/max/std over the last ``n`` rows per key
    (ROWS BETWEEN n-1 PRECEDING AND CURRENT ROW).  With ``bucket_s`` (and a
    unique ``order_tiebreak``) the window runs per (key, time bucket) with
    halo rows (``windows.bucketed_window``): exact, and a hot key is spread
    over its buckets instead of one task."""
    cols = {f"{prefix}_avg": lambda w: F.avg(value).over(w.rowsBetween(-(n - 1), 0)),
            f"{prefix}_min": lambda w: F.min(value).over(w.rowsBetween(-(n - 1), 0)),
            f"{prefix}_max": lambda w: F.max(value).over(w.rowsBetween(-(n - 1), 0)),
            f"{prefix}_std": lambda w: F.stddev(value).over(w.rowsBetween(-(n - 1), 0)),
            f"{prefix}_n": lambda w: F.count(value).over(w.rowsBetween(-(n - 1), 0))}
    return _ordered(df, keys, ts, order_tiebreak, bucket_s, n - 1, 0, cols)


def _ordered(df, keys, ts, tiebreak, bucket_s, preceding, following, cols):
    """Apply window columns per key, spread over time buckets when ``bucket_s``
    and a ``tiebreak`` are given, whatever the size."""
    if bucket_s and tiebreak:
        from oreflow.operators.windows import bucketed_window
        return bucketed_window(df, _keys(keys), ts, tiebreak, bucket_s, preceding, following, cols)
    order = [F.col(ts)] + ([F.col(tiebreak)] if tiebreak else [])
    w = Window.partitionBy(*_keys(keys)).orderBy(*order)
    out = df
    for name, fn in cols.items():
        out = out.withColumn(name, fn(w))
    return out


def rolling_zscore(df: DataFrame, keys: Sequence[str], ts: str, value: str,
                   n: int = 144, k: float = 2.5, order_tiebreak: str | None = None,
                   bucket_s: int | None = None) -> DataFrame:
    """TS-04 (first half): rows whose distance from the moving mean of the
    last ``n`` rows exceeds ``k`` moving deviations (std > 0)."""
    r = rolling_stats(df, keys, ts, value, n, "roll", order_tiebreak, bucket_s)
    return (r.where((F.col("roll_std") > 0)
                    & (F.abs(F.col(value) - F.col("roll_avg")) > k * F.col("roll_std")))
            .withColumn("z_score", (F.col(value) - F.col("roll_avg")) / F.col("roll_std")))


def cumulative_stats(df: DataFrame, keys: Sequence[str], ts: str, value: str,
                     order_tiebreak: str | None = None) -> DataFrame:
    """WN-05: running average and sample deviation from the first row."""
    order = [F.col(ts)] + ([F.col(order_tiebreak)] if order_tiebreak else [])
    w = Window.partitionBy(*_keys(keys)).orderBy(*order).rowsBetween(
        Window.unboundedPreceding, 0)
    return (df.withColumn("cum_avg", F.avg(value).over(w))
            .withColumn("cum_std", F.stddev(value).over(w))
            .withColumn("dev_from_cum_avg", F.col(value) - F.col("cum_avg")))


def lag_delta(df: DataFrame, keys: Sequence[str], ts: str, value: str,
              order_tiebreak: str | None = None, bucket_s: int | None = None) -> DataFrame:
    """WN-01/02: previous and next value, delta, and percent change
    (NULL when the previous value is 0)."""
    cols = {"prev_value": lambda w: F.lag(value).over(w), "next_value": lambda w: F.lead(value).over(w)}
    return (_ordered(df, keys, ts, order_tiebreak, bucket_s, 1, 1, cols)
            .withColumn("delta", F.col(value) - F.col("prev_value"))
            .withColumn("pct_change", F.try_divide(F.col("delta") * 100.0,
                                                   F.nullif(F.col("prev_value"), F.lit(0.0)))))


# ------------------------------------------------------------ period analysis
def period_over_period(df: DataFrame, keys: Sequence[str], ts: str, value: str,
                       width: str, threshold: float | None = None) -> DataFrame:
    """WN-06 / TS-06 / TS-07: average per bucket and its change against the
    key's previous bucket; with ``threshold`` a trend label up / down /
    steady (change beyond ±threshold)."""
    keys = _keys(keys)
    agg = df.groupBy(*keys, time_bucket(ts, width).alias("bucket")).agg(
        F.avg(value).alias("avg_value"), F.count(F.lit(1)).alias("n_readings"))
    w = Window.partitionBy(*keys).orderBy("bucket")
    out = (agg.withColumn("prev_avg", F.lag("avg_value").over(w))
           .withColumn("change", F.col("avg_value") - F.col("prev_avg")))
    if threshold is not None:
        out = out.withColumn(
            "trend", F.when(F.col("change") > threshold, "up")
            .when(F.col("change") < -threshold, "down")
            .when(F.col("change").isNotNull(), "steady"))
    return out


def trend_forecast(df: DataFrame, keys: Sequence[str], ts: str, value: str,
                   threshold: float, width: str = "1 week") -> DataFrame:
    """TS-08 / AG-14: least-squares trend of the per-bucket averages per key,
    slope per day, R², and days until the trend line reaches ``threshold``
    (NULL unless slope > 0).  Time is centred per key before regression for
    numeric stability."""
    keys = _keys(keys)
    b = df.groupBy(*keys, time_bucket(ts, width).alias("bucket")).agg(
        F.avg(value).alias("avg_value"))
    x_days = epoch_seconds("bucket") / 86400.0
    reg = b.groupBy(*keys).agg(
        F.regr_slope(F.col("avg_value"), x_days).alias("slope_per_day"),
        F.regr_intercept(F.col("avg_value"), x_days).alias("intercept"),
        F.regr_r2(F.col("avg_value"), x_days).alias("r2"),
        F.max(x_days).alias("last_x"), F.count(F.lit(1)).alias("n_buckets"))
    current = F.col("intercept") + F.col("slope_per_day") * F.col("last_x")
    return (reg.withColumn("current_level", current)
            .withColumn("days_to_threshold",
                        F.when(F.col("slope_per_day") > 0,
                               (F.lit(threshold) - current) / F.col("slope_per_day")))
            .drop("last_x"))


def first_crossing(df: DataFrame, keys: Sequence[str], ts: str, value: str,
                   level: float) -> DataFrame:
    """TS-09: first time the value exceeds ``level`` per key."""
    return df.groupBy(*_keys(keys)).agg(
        F.min(F.when(F.col(value) > level, F.col(ts))).alias("first_crossing")
    ).where(F.col("first_crossing").isNotNull())


def first_last_change(df: DataFrame, keys: Sequence[str], ts: str, value: str,
                      width: str = "1 week") -> DataFrame:
    """TS-10 / JN-07: average of the first and of the last bucket per key
    and the percent change, in one pass (conditional aggregation on the
    bucket rank instead of a self join)."""
    keys = _keys(keys)
    b = df.groupBy(*keys, time_bucket(ts, width).alias("bucket")).agg(
        F.avg(value).alias("avg_value"))
    per = b.groupBy(*keys).agg(
        F.min_by("avg_value", "bucket").alias("first_avg"),
        F.max_by("avg_value", "bucket").alias("last_avg"),
        F.min("bucket").alias("first_bucket"), F.max("bucket").alias("last_bucket"))
    return per.withColumn("pct_change", F.try_divide(
        (F.col("last_avg") - F.col("first_avg")) * 100.0,
        F.nullif(F.col("first_avg"), F.lit(0.0))))


def local_peaks(df: DataFrame, keys: Sequence[str], ts: str, value: str,
                floor: float, order_tiebreak: str | None = None, bucket_s: int | None = None) -> DataFrame:
    """TS-11: values higher than both neighbours and above ``floor``."""
    cols = {"prev_value": lambda w: F.lag(value).over(w), "next_value": lambda w: F.lead(value).over(w)}
    return (_ordered(df, keys, ts, order_tiebreak, bucket_s, 1, 1, cols)
            .where((F.col(value) > F.col("prev_value")) & (F.col(value) > F.col("next_value"))
                   & (F.col(value) > floor)))


def rise_time(df: DataFrame, keys: Sequence[str], ts: str, value: str,
              levels: Sequence[float]) -> DataFrame:
    """TS-12: first time each level is exceeded, the time of the peak and the
    total minutes from each level's first crossing to the peak (G5: total
    minutes, not the minute field)."""
    keys = _keys(keys)
    # peak time: the latest reading among those with the maximum value
    peak = F.max(F.struct(F.col(value).alias("v"), F.col(ts).alias("t")))
    aggs = [peak.v.alias("peak_value"), peak.t.alias("peak_time")]
    for lv in levels:
        aggs.append(F.min(F.when(F.col(value) > lv, F.col(ts))).alias(f"first_above_{int(lv)}"))
    out = df.groupBy(*keys).agg(*aggs)
    for lv in levels:
        out = out.withColumn(f"minutes_{int(lv)}_to_peak",
                             minutes_between(f"first_above_{int(lv)}", "peak_time"))
    return out


# ---------------------------------------------------------------- gap handling
def gaps(df: DataFrame, keys: Sequence[str], ts: str, max_gap_s: float,
         order_tiebreak: str | None = None, bucket_s: int | None = None) -> DataFrame:
    """TS-16 (detection): consecutive readings of a key further apart than
    ``max_gap_s`` seconds: gap start, gap end, gap seconds."""
    d = _ordered(df, keys, ts, order_tiebreak, bucket_s, 1, 0, {"gap_start": lambda w: F.lag(ts).over(w)})
    return (d.withColumn("gap_s", F.timestamp_diff("SECOND", F.col("gap_start"), F.col(ts)))
            .where(F.col("gap_s") > max_gap_s)
            .select(*_keys(keys), "gap_start", F.col(ts).alias("gap_end"), "gap_s"))


def gap_fill(df: DataFrame, keys: Sequence[str], ts: str, value: str, width: str, bucket_s: int = 30 * 86400) -> DataFrame:
    """TS-16 (fill): a regular spine of buckets per key between its first and
    last bucket; buckets without readings get the linear interpolation of
    the neighbouring known bucket averages (``interpolated`` = true).

    Each known bucket brings the ones missing up to the next known one, which
    comes from (key, ``bucket_s``) parts and their edges: no spine of a key is
    made or joined, and no window spans one."""
    from oreflow.operators.windows import bucketed_neighbour
    keys = _keys(keys)
    step = F.expr(f"INTERVAL {width}")
    b = df.groupBy(*keys, time_bucket(ts, width).alias("bucket")).agg(F.avg(value).alias("avg_value"))
    b = b.withColumn("__own", F.struct("bucket", "avg_value"))
    # buckets whose readings have no value: a start or an end of the spine, else like missing ones
    b = b.withColumn("__any", F.when(F.col("avg_value").isNotNull(), F.col("__own")))
    known = bucketed_neighbour(b.where(F.col("avg_value").isNotNull()), keys, "bucket", "avg_value", bucket_s, "__own", "__next", following=True)
    last = F.coalesce(F.col("__next.bucket") - step, F.col("bucket"))
    known = known.withColumn("__at", F.explode(F.sequence("bucket", last, step)))
    span = F.timestamp_diff("SECOND", F.col("bucket"), F.col("__next.bucket")).cast("double")
    frac = F.timestamp_diff("SECOND", F.col("bucket"), F.col("__at")).cast("double") / span
    here = F.col("__at") == F.col("bucket")
    filled = known.select(*keys, F.col("__at").alias("bucket"), F.when(here, F.col("avg_value")).alias("avg_value"), (~here).alias("interpolated"),
                          F.when(here, F.col("avg_value")).otherwise(F.col("avg_value") + (F.col("__next.avg_value") - F.col("avg_value")) * frac)
                          .alias("value_filled"))
    ends = b.groupBy(*keys).agg(F.min("bucket").alias("lo"), F.max("bucket").alias("hi"), F.min("__any").alias("__f"), F.max("__any").alias("__l"))
    before = F.when(F.col("__f").isNull(), F.sequence("lo", "hi", step)) \
        .when(F.col("lo") < F.col("__f.bucket"), F.sequence("lo", F.col("__f.bucket") - step, step))
    after = F.when(F.col("hi") > F.col("__l.bucket"), F.sequence(F.col("__l.bucket") + step, "hi", step))
    none = F.array().cast("array<timestamp_ntz>") if dict(b.dtypes)["bucket"] == "timestamp_ntz" else F.array().cast("array<timestamp>")
    outside = ends.select(*keys, F.explode(F.concat(F.coalesce(before, none), F.coalesce(after, none))).alias("bucket"),
                          F.lit(None).cast("double").alias("avg_value"), F.lit(True).alias("interpolated"),
                          F.lit(None).cast("double").alias("value_filled"))
    return filled.unionByName(outside)


def dedup_readings(df: DataFrame, keys: Sequence[str], ts: str, keep_min: str) -> DataFrame:
    """TS-15: one reading per (key, time): the one with the smallest
    ``keep_min`` (deterministic, unlike ``dropDuplicates``).  A grouped
    ``min_by`` aggregates partially before the shuffle."""
    grp = _keys(keys) + [ts]
    rest = [c for c in df.columns if c not in grp]
    kept = F.min_by(F.struct(*[F.col(c) for c in rest]), F.col(keep_min)).alias("__r")
    return df.groupBy(*grp).agg(kept).select(*grp, "__r.*")

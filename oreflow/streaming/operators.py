"""Streaming operators (ST-01..ST-17).  Windows, joins and filters accept batch
or streaming DataFrames; those of ``stateful`` take streams and keep per-key
state in the state store (checkpointed), bounded by the watermark."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from oreflow.streaming.stateful import NOT_KNOWN, AckTimer, Bursts, MovingStats, Sessions, Transitions, run_processor


def _keys(keys) -> list[str]:
    return [keys] if isinstance(keys, str) else list(keys)


def _id(id_col: str):
    # a NULL among the ids would make them floats in pandas
    return F.coalesce(F.col(id_col).cast("long"), F.lit(NOT_KNOWN))


# ------------------------------------------------------------------ windows
def window_aggregates(df: DataFrame, keys: Sequence[str], ts: str, value: str, width: str,
                      slide: str | None = None, watermark: str | None = "30 minutes") -> DataFrame:
    """ST-01 / ST-02: tumbling (or sliding) event-time windows per key:
    count, sum, avg, min, max, sample std.  The watermark bounds the
    state: windows older than it are final and dropped from the state."""
    d = df.withWatermark(ts, watermark) if watermark else df
    w = F.window(F.col(ts), width, slide) if slide else F.window(F.col(ts), width)
    return d.groupBy(w.alias("window"), *_keys(keys)).agg(
        F.count(F.lit(1)).alias("n"), F.sum(value).alias("sum_value"), F.avg(value).alias("avg_value"),
        F.min(value).alias("min_value"), F.max(value).alias("max_value"), F.stddev(value).alias("std_value"))


def session_windows(df: DataFrame, keys: Sequence[str], ts: str, gap_s: float,
                    watermark: str = "30 minutes") -> DataFrame:
    """ST-03: gap sessions per key: session_start, last_event (not last + gap),
    n_events; a gap of exactly ``gap_s`` stays in the session.  Update rows by
    (keys, session_start): a session that a row in between has joined to an
    earlier one comes again with ``deleted``."""
    d = run_processor(df, _keys(keys), ts, watermark, {}, Sessions(int(gap_s * 1_000_000)),
                      "start bigint, last bigint, n_events bigint, deleted boolean")
    return d.select(*_keys(keys), F.timestamp_micros("start").alias("session_start"),
                    F.timestamp_micros("last").alias("last_event"), "n_events", "deleted")


def chained_rollup(five_min: DataFrame, keys: Sequence[str], width: str = "1 hour") -> DataFrame:
    """ST-17 / TS-23: roll window results up into a coarser window using
    ``window_time`` of the inner window, merging sums and counts (the exact
    average, never an average of averages, G12)."""
    return five_min.groupBy(F.window(F.window_time("window"), width).alias("window"), *_keys(keys)).agg(
        F.sum("n").alias("n"), F.sum("sum_value").alias("sum_value"),
        F.min("min_value").alias("min_value"), F.max("max_value").alias("max_value")).withColumn(
        "avg_value", F.col("sum_value") / F.col("n"))


# ------------------------------------------------------------------- alerts
def threshold_alerts(events: DataFrame, rules: DataFrame, type_col: str, value: str) -> DataFrame:
    """ST-04: stream-static join with the (small, broadcast) rule table; an
    event raises one alert per matching active rule (JN-09 conditions)."""
    from oreflow.operators.joins import rule_join
    r = rules.withColumnRenamed("event_type", type_col) if "event_type" in rules.columns else rules
    return rule_join(events, r, type_col, value)


def escalate_bursts(alerts: DataFrame, keys: Sequence[str], ts: str, id_col: str, level: str = "warning",
                    window_s: int = 900, min_count: int = 3, watermark: str = "30 minutes") -> DataFrame:
    """ST-06: a ``level`` alert escalates to critical when it is at least the
    ``min_count``-th such alert of its key within ``window_s`` seconds
    (inclusive).  Update rows by ``id_col``: an alert that arrives later but
    happened earlier raises the counts of those after it."""
    src = alerts.where(F.col("alert_level") == level)
    d = run_processor(src, _keys(keys), ts, watermark, {"id": _id(id_col)},
                      Bursts(window_s * 1_000_000, min_count), "us bigint, id bigint, n_in_window int")
    return d.select(*_keys(keys), F.timestamp_micros("us").alias(ts), F.col("id").alias(id_col), "n_in_window")


def unacknowledged(alerts: DataFrame, acks: DataFrame, keys: Sequence[str], alert_ts: str, ack_ts: str,
                   timeout_s: int = 600) -> DataFrame:
    """ST-07 (batch form): critical alerts without an acknowledgement within
    ``timeout_s`` become emergencies (left join on key and time range)."""
    keys = _keys(keys)
    a = alerts.alias("a")
    k = acks.select(*keys, F.col(ack_ts).alias("__ack"))
    cond = [a[x] == k[x] for x in keys] + [k["__ack"] >= a[alert_ts],
                                          k["__ack"] <= a[alert_ts] + F.make_dt_interval(secs=F.lit(timeout_s))]
    return a.join(k, cond, "left_anti")


def ack_timer(alerts_and_acks: DataFrame, keys: Sequence[str], ts: str, kind: str, timeout_s: int = 600,
              watermark: str = "30 minutes") -> DataFrame:
    """ST-07 (stream form): per key event-time timers: each 'critical' event
    arms one at ts + timeout, an 'ack' event within that time disarms it (also
    one that arrived before the alarm), a fired timer emits an emergency, once.
    Timers fire when the watermark has passed their time."""
    src = alerts_and_acks.where(F.col(kind).isin("critical", "ack"))
    d = run_processor(src, _keys(keys), ts, watermark, {"ack": F.col(kind) != "critical"},
                      AckTimer(timeout_s * 1_000_000), "alert_us bigint, deadline_us bigint")
    return d.select(*_keys(keys), F.timestamp_micros("alert_us").alias("alert_time"),
                    F.timestamp_micros("deadline_us").alias("deadline"))


# ------------------------------------------------------------ stateful stats
def moving_stats(df: DataFrame, keys: Sequence[str], ts: str, id_col: str, value: str, n: int,
                 watermark: str = "30 minutes") -> DataFrame:
    """ST-08: moving average / sample std over each key's last ``n`` readings in
    the order of event time (analytic row frames are not allowed on streams).
    Update rows by ``id_col``: a reading that arrives late moves the windows of
    those after it.  NULL values count for nothing."""
    d = run_processor(df, _keys(keys), ts, watermark, {"id": _id(id_col), "x": F.col(value).cast("double")},
                      MovingStats(n), "id bigint, us bigint, value double, ma double, mstd double")
    return d.select(*_keys(keys), F.col("id").alias(id_col), F.timestamp_micros("us").alias(ts),
                    F.col("value").alias(value), "ma", "mstd")


def state_transitions(df: DataFrame, keys: Sequence[str], ts: str, id_col: str, state_col: str,
                      watermark: str = "30 minutes") -> DataFrame:
    """ST-16: equipment state tracking: one row per change of ``state_col`` per
    key with previous state, new state and whole seconds spent in the previous.
    Update rows by ``id_col``; a change undone by a row that arrived later comes
    again with ``deleted``.  Rows without a state are left out."""
    src = df.where(F.col(state_col).isNotNull())
    d = run_processor(src, _keys(keys), ts, watermark, {"id": _id(id_col), "x": F.col(state_col).cast("string")},
                      Transitions(), "id bigint, us bigint, previous_state string, new_state string, "
                                     "seconds_in_previous bigint, deleted boolean")
    return d.select(*_keys(keys), F.col("id").alias(id_col), F.timestamp_micros("us").alias(ts), "previous_state",
                    "new_state", "seconds_in_previous", "deleted")


# --------------------------------------------------------------- other ops
def late_split(batch: DataFrame, ts: str, watermark_col) -> tuple[DataFrame, DataFrame]:
    """ST-09: split a micro-batch into on-time rows and late rows (event
    time below the watermark in force when the batch arrived); late rows
    go to a side output instead of being silently dropped."""
    wm = F.col(watermark_col) if isinstance(watermark_col, str) else watermark_col
    late = F.col(ts) < wm
    return batch.where(~late | wm.isNull()), batch.where(late)


def dedup_within_watermark(df: DataFrame, keys: Sequence[str], ts: str, watermark: str = "30 minutes") -> DataFrame:
    """ST-11: drop repeated events (same keys) within the watermark delay."""
    return df.withWatermark(ts, watermark).dropDuplicatesWithinWatermark(_keys(keys))


def interval_join_streams(left: DataFrame, right: DataFrame, keys: Sequence[str], left_ts: str, right_ts: str,
                          tolerance: str = "30 minutes", watermark: str = "1 hour") -> DataFrame:
    """ST-12: watermarked stream-stream join of left events to right events
    of the same key within ±tolerance (state bounded by the watermarks)."""
    keys = _keys(keys)
    lw = left.withWatermark(left_ts, watermark).alias("l")
    rw = right.withWatermark(right_ts, watermark).alias("r")
    tol = F.expr(f"INTERVAL {tolerance}")
    cond = [F.col(f"l.{k}") == F.col(f"r.{k}") for k in keys] + [
        F.col(f"l.{left_ts}") >= F.col(f"r.{right_ts}") - tol,
        F.col(f"l.{left_ts}") <= F.col(f"r.{right_ts}") + tol]
    return lw.join(rw, cond, "inner")


def lag_metrics(df: DataFrame, event_ts: str, ingest_ts: str, keys: Sequence[str]) -> DataFrame:
    """ST-10: ingestion minus event time per key: mean, max and exact p95 seconds."""
    from oreflow.operators.profile import exact_quantiles
    from oreflow.operators.windows import null_safe_join
    keys = _keys(keys)
    lags = df.select(*keys, F.timestamp_diff("SECOND", F.col(event_ts), F.col(ingest_ts)).alias("__lag"))
    g = lags.groupBy(*keys).agg(F.avg("__lag").alias("avg_lag_s"), F.max("__lag").alias("max_lag_s"))
    q = exact_quantiles(lags, "__lag", [0.95], keys).select(*keys, F.col("value").alias("p95_lag_s"))
    return null_safe_join(g, q, keys, "left")

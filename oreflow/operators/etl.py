"""ETL operators: staging extract, load log, watermarks, incremental extract
with overlap, change detection, load plans.

Control tables (load log, watermark) are small append-only DataFrames; the
latest state of a load is ``max_by`` over its events, so a failed run that
never writes its 'completed' event leaves the watermark untouched.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from oreflow.functions.hashing import row_hash

LOAD_LOG_SCHEMA = ("load_id long, table_name string, load_type string, status string, "
                   "rows_extracted long, rows_loaded long, rows_rejected long, error_message string, "
                   "event_time timestamp_ntz")


def _keys(keys) -> list[str]:
    return [keys] if isinstance(keys, str) else list(keys)


def stage(df: DataFrame, load_id: int, source_system: str, load_ts: Column | None = None,
          hash_cols: Sequence[str] | None = None) -> DataFrame:
    """ETL-01: source rows plus _load_id, _load_timestamp, _source_system and
    _row_hash (MD5 of the NULL-marked business columns)."""
    cols = list(hash_cols or df.columns)
    ts = load_ts if load_ts is not None else F.localtimestamp()
    return df.select("*", F.lit(load_id).cast("long").alias("_load_id"),
                     ts.cast("timestamp_ntz").alias("_load_timestamp"),
                     F.lit(source_system).alias("_source_system"), row_hash(*cols).alias("_row_hash"))


# ------------------------------------------------------------------ load log
def log_event(spark: SparkSession, load_id: int, table: str, load_type: str, status: str,
              extracted: int | None = None, loaded: int | None = None, rejected: int | None = None,
              error: str | None = None, at=None) -> DataFrame:
    """ETL-02 / UD-01: one load-log event (start, finish or fail) as a
    one-row DataFrame, to be appended to the log table."""
    import datetime as _dt
    at = at or _dt.datetime.now()
    return spark.createDataFrame(
        [(load_id, table, load_type, status, extracted, loaded, rejected, error, at)], LOAD_LOG_SCHEMA)


def logged_load(spark: SparkSession, log_path: str, load_id: int, name: str, source: Callable[[], DataFrame], path: str,
                valid: Column | None = None, load_type: str = "full", batch: str | None = None) -> bool:
    """ETL-02 / UD-01: load a table and write the log around it: 'started' before,
    'completed' with the rows extracted, loaded and rejected (``valid`` not true)
    after, or 'failed' with the error.  Log and table are tables of
    ``sinks.writers``; a ``batch`` that the table has already is not loaded (nor
    logged) again.  True if the load was completed."""
    from oreflow.sinks import writers
    if batch is not None and writers.committed(spark, path, batch):
        return False
    event = lambda *a, **b: writers.append(log_event(spark, load_id, name, load_type, *a, **b), log_path)
    event("started")
    try:
        df = source()
        ok = F.coalesce(valid, F.lit(False)) if valid is not None else F.lit(True)
        writers.commit(df.where(ok), path, batch=batch)
        n, good = df.agg(F.count(F.lit(1)), F.count_if(ok)).first()
    except Exception as e:  # noqa: BLE001 - whatever it was, the log has it
        event("failed", error=str(e)[:500])
        return False
    event("completed", extracted=n, loaded=good, rejected=n - good)
    return True


def load_state(log: DataFrame) -> DataFrame:
    """ETL-02: the latest state of every load (latest event wins)."""
    cols = [c for c in log.columns if c != "load_id"]
    return log.groupBy("load_id").agg(
        F.max_by(F.struct(*cols), F.col("event_time")).alias("s"),
        F.min("event_time").alias("started_at")).select("load_id", "s.*", "started_at")


def load_health(log: DataFrame, max_duration_s: int = 300, max_rejected: int = 10) -> DataFrame:
    """ETL-10: duration, rejected rows and alarm flags per finished load."""
    st = load_state(log)
    dur = F.timestamp_diff("SECOND", F.col("started_at"), F.col("event_time"))
    return st.select("load_id", "table_name", "status", dur.alias("duration_s"), "rows_rejected",
                     (dur > max_duration_s).alias("duration_alarm"),
                     (F.coalesce("rows_rejected", F.lit(0)) > max_rejected).alias("rejected_alarm"))


# ----------------------------------------------------------------- watermark
def watermark_of(df: DataFrame, updated: str, created: str | None = None) -> Column:
    """ETL-03: MAX(COALESCE(updated_at, created_at)) as a scalar sub-query."""
    c = F.coalesce(F.col(updated), F.col(created)) if created else F.col(updated)
    return df.select(F.max(c)).scalar()


def incremental_extract(source: DataFrame, watermark, ts_col: str, keys: Sequence[str],
                        overlap_s: int = 0, lookback_s: int | None = None,
                        version_col: str | None = None) -> DataFrame:
    """ETL-04 (G16): rows changed after ``watermark - overlap``, optionally
    no older than ``watermark - lookback``; overlapping re-reads are
    de-duplicated on ``keys`` keeping the newest version (by ``version_col``,
    default ``ts_col``).  A NULL watermark (first run) extracts everything."""
    wm = watermark if isinstance(watermark, Column) else F.lit(watermark)
    lo = wm - F.make_dt_interval(secs=F.lit(overlap_s))
    cond = F.col(ts_col) > lo
    if lookback_s is not None:
        cond = cond & (F.col(ts_col) >= wm - F.make_dt_interval(secs=F.lit(lookback_s)))
    picked = source.where(wm.isNull() | cond)
    vcol = version_col or ts_col
    rest = [c for c in source.columns if c not in _keys(keys)]
    return (picked.groupBy(*_keys(keys))
            .agg(F.max_by(F.struct(*rest), F.col(vcol)).alias("__r")).select(*_keys(keys), "__r.*"))


def new_rows_only(extract: DataFrame, target: DataFrame, keys: Sequence[str]) -> DataFrame:
    """ETL-05 / WH-06: rows whose key is not loaded yet (re-running the same
    extract therefore adds nothing)."""
    return extract.join(target.select(*_keys(keys)), _keys(keys), "left_anti")


def change_detection(previous: DataFrame, current: DataFrame, keys: Sequence[str],
                     compare: Sequence[str]) -> DataFrame:
    """ETL-06: full outer join on the key, compare row hashes of ``compare``:
    change_type new | changed | unchanged | deleted."""
    keys = _keys(keys)
    p = previous.select(*keys, row_hash(*compare).alias("__hp"))
    c = current.select(*keys, row_hash(*compare).alias("__hc"))
    # NULL keys match each other
    c = c.withColumnsRenamed({k: f"__c_{k}" for k in keys})
    same = reduce(and_, [F.col(k).eqNullSafe(F.col(f"__c_{k}")) for k in keys])
    j = p.join(c, same, "full_outer")
    keys = [F.when(F.col("__hp").isNull(), F.col(f"__c_{k}")).otherwise(F.col(k)).alias(k) for k in keys]
    t = (F.when(F.col("__hp").isNull(), "new").when(F.col("__hc").isNull(), "deleted")
         .when(F.col("__hp") == F.col("__hc"), "unchanged").otherwise("changed"))
    return j.select(*keys, t.alias("change_type"))


# ----------------------------------------------------------------- load plan
def load_plan(tables: Sequence[Mapping]) -> list[str]:
    """ETL-07: table names in dependency order (dependencies first, then by
    load_priority).  Plain Python over a small configuration."""
    by_name = {t["name"]: t for t in tables}
    order: list[str] = []
    state: dict[str, int] = {}

    def visit(n: str) -> None:
        if state.get(n) == 2:
            return
        if state.get(n) == 1:
            raise ValueError(f"dependency cycle at {n}")
        state[n] = 1
        for dep in sorted(by_name[n].get("dependencies", []),
                          key=lambda x: (by_name[x].get("load_priority", 0), x)):
            visit(dep)
        state[n] = 2
        order.append(n)

    for t in sorted(tables, key=lambda t: (t.get("load_priority", 0), t["name"])):
        visit(t["name"])
    return order


def reconcile_counts(pairs: Mapping[str, tuple[DataFrame, DataFrame]]) -> DataFrame:
    """ETL-09: row counts of staging vs target per table with OK/MISMATCH."""
    out = None
    for name, (a, b) in pairs.items():
        ca = a.agg(F.count(F.lit(1)).alias("staging_rows"))
        cb = b.agg(F.count(F.lit(1)).alias("target_rows"))
        row = ca.select(F.lit(name).alias("table_name"), "staging_rows",
                        cb.select("target_rows").scalar().alias("target_rows"))
        out = row if out is None else out.unionByName(row)
    return out.withColumn("status", F.when(F.col("staging_rows") == F.col("target_rows"), "OK")
                          .otherwise("MISMATCH"))

"""Table writes: overwrite, append, insert-if-absent, upsert, predicate
update/delete, time-partitioned tables, rollup refresh and retention.

Plain Parquet has no MERGE (G17).  A table is a folder of written versions and a
small pointer file that names the folders (one per version and partition) the
table consists of now.  Every change writes a new version beside the others and
replaces the pointer last, in one rename: a job that fails before leaves the old
table whole, readers never see half a change, and unchanged partitions are not
written again.  A change may carry a batch id; the pointer remembers it, and the
same batch again is a no-op.  One writer at a time; read with ``table``.
"""

from __future__ import annotations

import hashlib
import json
import os
import uuid
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from oreflow.session import path_exists

POINTER = "_table.json"
VERSION = "__version"


def _keys(keys) -> list[str]:
    return [keys] if isinstance(keys, str) else list(keys)


def _path(spark: SparkSession, path: str):
    """Hadoop path and its file system (object stores too)."""
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p, p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def _state(spark: SparkSession, path: str) -> dict | None:
    """What the pointer says: parts (folders), keys, schema, batches."""
    p, fs = _path(spark, os.path.join(path, POINTER))
    if not fs.exists(p):
        return None
    stream = fs.open(p)
    try:
        return json.loads(spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))
    finally:
        stream.close()


def _point(spark: SparkSession, path: str, state: dict) -> None:
    """Replace the pointer: written aside, then renamed over the old one."""
    jvm, gateway = spark.sparkContext._jvm, spark.sparkContext._gateway
    new, fs = _path(spark, os.path.join(path, f"{POINTER}-{uuid.uuid4().hex}"))
    out = fs.create(new)
    try:
        out.write(json.dumps(state).encode())
    finally:
        out.close()
    rename = jvm.org.apache.hadoop.fs.Options.Rename
    how = gateway.new_array(rename, 1)
    how[0] = rename.OVERWRITE
    new = fs.makeQualified(new)
    jvm.org.apache.hadoop.fs.FileContext.getFileContext(new.toUri(), spark.sparkContext._jsc.hadoopConfiguration()) \
        .rename(new, fs.makeQualified(_path(spark, os.path.join(path, POINTER))[0]), how)


def exists(spark: SparkSession, path: str) -> bool:
    """True when ``path`` holds a table of these writers."""
    return path_exists(spark, os.path.join(path, POINTER))


def committed(spark: SparkSession, path: str, batch: str) -> bool:
    """Whether the table has the batch already."""
    return batch in (_state(spark, path) or {"batches": []})["batches"]


def table(spark: SparkSession, path: str) -> DataFrame:
    """The table as it is now; a change made later does not reach this frame."""
    state = _state(spark, path)
    if state is None:
        raise FileNotFoundError(f"no table at {path}")
    schema = StructType.fromJson(state["schema"])
    if not state["parts"]:
        return spark.createDataFrame([], schema)
    read = spark.read.schema(schema.add(StructField(VERSION, StringType()))).option("basePath", path)
    return read.parquet(*[os.path.join(path, p) for p in state["parts"]]).drop(VERSION)


def _folders(spark: SparkSession, path: str, version: str, depth: int) -> list[str]:
    """Folders of a version's partitions, relative to the table."""
    found = [version]
    for _ in range(depth):
        below = []
        for f in found:
            p, fs = _path(spark, os.path.join(path, f))
            below += [f"{f}/{x.getPath().getName()}" for x in fs.listStatus(p) if x.isDirectory() and "=" in x.getPath().getName()]
        found = below
    return found


def commit(df: DataFrame, path: str, partition_by: Sequence[str] | None = None, replace: str = "all",
           touched: DataFrame | None = None, batch: str | None = None) -> bool:
    """Write ``df`` as a change of the table: ``replace`` 'all' of it, nothing
    ('append'), or the 'partitions' that ``df`` or ``touched`` (partition
    columns) holds.  False if ``batch`` has been committed before."""
    spark = df.sparkSession
    old = _state(spark, path) or {"parts": [], "keys": list(partition_by or []), "batches": [], "schema": df.schema.jsonValue()}
    if batch is not None and batch in old["batches"]:
        return False
    keys = list(partition_by or []) if replace == "all" else old["keys"]
    version = f"{VERSION}={uuid.uuid4().hex}"
    w = df.write.partitionBy(*keys) if keys else df.write
    w.parquet(os.path.join(path, version))
    new, schema = _folders(spark, path, version, len(keys)), df.schema
    parts = new
    if replace != "all":
        schema = StructType.fromJson(old["schema"])
        schema = StructType([*schema.fields, *(f for f in df.schema.fields if f.name not in schema.names)])
        within = lambda f: f.partition("/")[2]
        gone = {within(f) for f in new} if replace == "partitions" else set()
        if touched is not None:
            name = spark.sparkContext._jvm.org.apache.spark.sql.catalyst.catalog.ExternalCatalogUtils.getPartitionPathString
            texts = touched.select(*[F.col(k).cast("string").alias(k) for k in keys]).distinct().collect()
            gone |= {"/".join(name(k, r[k]) for k in keys) for r in texts}
        parts = [f for f in old["parts"] if within(f) not in gone or replace == "append"] + new
    _point(spark, path, {"parts": parts, "keys": keys, "schema": schema.jsonValue(),
                         "batches": old["batches"] + ([batch] if batch is not None else [])})
    return True


def vacuum(spark: SparkSession, path: str) -> int:
    """Delete the versions that the table has none of any more (and readers of
    older states may still use); how many."""
    kept = {f.partition("/")[0] for f in _state(spark, path)["parts"]}
    p, fs = _path(spark, path)
    old = [x.getPath() for x in fs.listStatus(p) if x.getPath().getName().startswith(f"{VERSION}=") and x.getPath().getName() not in kept]
    for x in old:
        fs.delete(x, True)
    return len(old)


def overwrite(df: DataFrame, path: str, partition_by: Sequence[str] | None = None,
              dynamic: bool = False, batch: str | None = None) -> None:
    """SNK-01 truncate-and-load (or, with ``dynamic``, replace only the
    partitions present in ``df``)."""
    commit(df, path, partition_by, "partitions" if dynamic else "all", batch=batch)


def append(df: DataFrame, path: str, partition_by: Sequence[str] | None = None, batch: str | None = None) -> None:
    """SNK-02 append load."""
    commit(df, path, partition_by, "append", batch=batch)


def insert_if_absent(spark: SparkSession, df: DataFrame, path: str, keys: Sequence[str], batch: str | None = None) -> None:
    """SNK-03: append rows whose key is not in the table yet (one per key)."""
    keys = _keys(keys)
    fresh = df.dropDuplicates(keys)
    if exists(spark, path):
        fresh = fresh.join(table(spark, path).select(*keys), keys, "left_anti")
    append(fresh, path, batch=batch)


def merge_latest(target: DataFrame, changes: DataFrame, keys: Sequence[str], order: Column) -> DataFrame:
    """SNK-04 as a transformation: per key the newest row of target ∪
    changes (last write wins by ``order``, computed on the union)."""
    keys = _keys(keys)
    u = target.unionByName(changes, allowMissingColumns=True)
    rest = [c for c in u.columns if c not in keys]
    return (u.withColumn("__o", order).groupBy(*keys)
            .agg(F.max_by(F.struct(*rest), F.col("__o")).alias("__r")).select(*keys, "__r.*"))


def upsert(spark: SparkSession, changes: DataFrame, path: str, keys: Sequence[str], order: Column,
           partition_by: Sequence[str] | None = None, batch: str | None = None) -> None:
    """SNK-04 upsert: a new version of the table, or with ``partition_by`` of the
    partitions that hold one of the keys now or will.  The first load is
    merged too: it keeps one row per key."""
    keys = _keys(keys)
    if not exists(spark, path):
        commit(merge_latest(changes.limit(0), changes, keys, order), path, partition_by, batch=batch)
        return
    whole = table(spark, path)
    if not partition_by:
        commit(merge_latest(whole, changes, keys, order), path, batch=batch)
        return
    parts = list(partition_by)
    same = [F.col(f"t.{k}").eqNullSafe(F.col(f"c.{k}")) for k in keys]
    held = whole.alias("t").join(changes.select(*keys).distinct().alias("c"), same, "left_semi").select(*parts)
    touched = held.union(changes.select(*parts)).distinct()
    here = [F.col(f"t.{k}").eqNullSafe(F.col(f"p.{k}")) for k in parts]
    near = whole.alias("t").join(touched.alias("p"), here, "left_semi")
    # a partition that all its rows leave is replaced by nothing
    commit(merge_latest(near, changes, keys, order), path, parts, "partitions", touched, batch)


def predicate_update(df: DataFrame, assignments: Mapping[str, Column], predicate: Column) -> DataFrame:
    """SNK-05: UPDATE t SET c = v WHERE p, as a column rewrite."""
    out = df
    for c, v in assignments.items():
        out = out.withColumn(c, F.when(predicate, v).otherwise(F.col(c)) if c in df.columns
                             else F.when(predicate, v))
    return out


def update_table(spark: SparkSession, path: str, assignments: Mapping[str, Column],
                 predicate: Column, batch: str | None = None) -> None:
    """SNK-05 applied to a stored table."""
    commit(predicate_update(table(spark, path), assignments, predicate), path, _state(spark, path)["keys"], batch=batch)


def delete_where(spark: SparkSession, path: str, predicate: Column, batch: str | None = None) -> None:
    """SNK-06: DELETE WHERE p (rows for which p is NULL are kept)."""
    kept = table(spark, path).where(~F.coalesce(predicate, F.lit(False)))
    commit(kept, path, _state(spark, path)["keys"], batch=batch)


def chunk_column(ts: str, chunk: str) -> Column:
    """SNK-07: chunk id of a time-partitioned table: 'month' -> yyyy-MM,
    'N days' -> start date of the N-day chunk (epoch aligned)."""
    if chunk == "month":
        return F.date_format(F.col(ts), "yyyy-MM")
    return F.to_date(F.window(F.col(ts), chunk).start)


def write_time_partitioned(df: DataFrame, path: str, ts: str, chunk: str = "7 days",
                           mode: str = "append") -> None:
    """SNK-07: derived chunk column + partitionBy; filters on the chunk
    column prune whole folders.  Rows are dealt by chunk first, so a chunk gets
    few files, and one with many rows is split over several tasks."""
    d = df.withColumn("chunk", chunk_column(ts, chunk)).hint("rebalance", F.col("chunk"))
    commit(d, path, ["chunk"], "append" if mode == "append" else "partitions")


def refresh_rollup(spark: SparkSession, source: DataFrame, path: str, ts: str, keys: Sequence[str],
                   value: str, now, start_offset_s: int, end_offset_s: int, width: str = "1 hour") -> None:
    """SNK-08 / TS-17 (batch form): recompute the rollup buckets inside the
    refresh window [now - start_offset, now - end_offset) and replace only
    their day partitions (dynamic overwrite).  Older buckets stay as
    materialised; the newest ``end_offset`` is left for the next run."""
    roll = refresh_window_rollup(source, ts, keys, value, now, start_offset_s, end_offset_s, width)
    commit(roll, path, ["day"], "partitions")


def refresh_window_rollup(source: DataFrame, ts: str, keys: Sequence[str], value: str, now,
                          start_offset_s: int, end_offset_s: int, width: str = "1 hour") -> DataFrame:
    """SNK-08: the rollup rows a refresh recomputes: whole days from the day
    of ``now - start_offset`` up to (excluding) ``now - end_offset``."""
    now_c = now if isinstance(now, Column) else F.lit(now).cast("timestamp_ntz")
    lo = now_c - F.make_dt_interval(secs=F.lit(start_offset_s))
    hi = now_c - F.make_dt_interval(secs=F.lit(end_offset_s))
    # refresh whole days: every bucket of a touched day is recomputed
    day_lo = F.date_trunc("day", lo).cast("timestamp_ntz")
    src = source.where((F.col(ts) >= day_lo) & (F.col(ts) < hi))
    b = F.window(F.col(ts), width).start
    return (src.groupBy(b.alias("bucket"), *_keys(keys))
            .agg(F.count(F.lit(1)).alias("n"), F.sum(value).alias("sum_value"),
                 F.min(value).alias("min_value"), F.max(value).alias("max_value"))
            .withColumn("day", F.to_date("bucket")))


BUCKETS = 16     # parts of a table of running totals


def add_totals(df: DataFrame, path: str, keys: Sequence[str], value: str, batch: str, buckets: int = BUCKETS) -> bool:
    """DOC-14 (computed pattern: increment and maximum upserts): add a batch of
    rows to a table of running totals per key: n, total, largest.  The batch is
    summed by key first; only the parts of the table that hold one of its keys
    are written again.  False if ``batch`` has been added before."""
    spark, keys = df.sparkSession, _keys(keys)
    state = _state(spark, path)
    if state and batch in state["batches"]:
        return False
    part = F.pmod(F.xxhash64(*keys), F.lit(buckets)).cast("int")
    new = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"), F.sum(value).alias("total"), F.max(value).alias("largest")) \
        .withColumn("part", part)
    if state:
        new = new.unionByName(table(spark, path).join(new.select("part").distinct(), "part", "left_semi"))
    merged = new.groupBy(*keys, "part").agg(F.sum("n").alias("n"), F.sum("total").alias("total"), F.max("largest").alias("largest"))
    return commit(merged, path, ["part"], "partitions" if state else "all", batch=batch)


def retention(spark: SparkSession, path: str, partition_col: str, keep_from) -> None:
    """SNK-09: drop the partitions older than ``keep_from``: the pointer leaves
    their folders out, no row is read or written."""
    t = table(spark, path)
    old = t.where(F.col(partition_col) < F.lit(keep_from)).select(partition_col)
    commit(t.limit(0), path, None, "partitions", old)


def tiered_retention(spark: SparkSession, raw_path: str, rollup_path: str, ts: str,
                     keys: Sequence[str], value: str, raw_keep_from, width: str = "1 hour") -> None:
    """SNK-09 tiers: roll raw rows older than ``raw_keep_from`` into the
    coarser table (appended), then drop them from the raw table.

    The append is a batch named after the state of the raw table that it rolls
    up: run again after a failure between the two steps, it adds nothing."""
    raw, state = table(spark, raw_path), _state(spark, raw_path)
    old = raw.where(F.col(ts) < F.lit(raw_keep_from).cast("timestamp_ntz"))
    roll = (old.groupBy(F.window(F.col(ts), width).start.alias("bucket"), *_keys(keys))
            .agg(F.count(F.lit(1)).alias("n"), F.sum(value).alias("sum_value"),
                 F.min(value).alias("min_value"), F.max(value).alias("max_value")))
    parts = hashlib.sha256("\n".join(sorted(state["parts"])).encode()).hexdigest()
    append(roll, rollup_path, batch=f"{raw_keep_from}/{parts}")
    kept = raw.where(F.coalesce(F.col(ts) >= F.lit(raw_keep_from).cast("timestamp_ntz"), F.lit(True)))
    commit(kept, raw_path, state["keys"])


def write_results(df: DataFrame, path: str) -> None:
    """SNK-10: profile / validation results are tables (Parquet)."""
    overwrite(df, path)


def table_path(base: str, name: str) -> str:
    return os.path.join(base, name)

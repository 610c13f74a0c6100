"""Structured Streaming plumbing: file sources, a changelog sink and a
runner that drives a stream to completion over the available files.

Every transformation in ``oreflow.operators`` takes any DataFrame, so the
same functions run on a streaming DataFrame.  The sink used here is an
append-only changelog (``foreachBatch``: each micro-batch's updated rows
are appended with the batch id); readers take the latest row per key.
Appends are idempotent per batch id (a restarted batch overwrites its own
folder), so an executor or driver loss replays without duplicates.
"""

from __future__ import annotations

import os
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from oreflow.session import path_exists, scratch_path

EVENTS_SCHEMA = "event_id long, ts timestamp_ntz, user_id long, event_type string, value double, props string"


def _keys(keys) -> list[str]:
    return [keys] if isinstance(keys, str) else list(keys)


def event_stream(spark: SparkSession, path: str, schema: str = EVENTS_SCHEMA,
                 max_files_per_trigger: int | None = None) -> DataFrame:
    """SRC-08: telemetry landing folder as a stream, in the reference's
    vocabulary; event time cast to TIMESTAMP so watermarks work (G1).  A
    Kafka source is the same plan after its value is parsed."""
    r = spark.readStream.schema(schema)
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", max_files_per_trigger)
    s = r.parquet(path)
    own = [F.col("arrived").cast("timestamp").alias("arrived")] if "arrived" in s.columns else []
    return s.select(F.col("event_id").alias("reading_id"), F.col("user_id").alias("equipment_id"),
                    F.col("event_type").alias("sensor_type"), "value",
                    F.col("ts").cast("timestamp").alias("ts"), F.col("props").alias("payload"), *own)


def stream_table_dir(sf_dir: str, table: str) -> str:
    """Landing path of a table for the file stream source: a folder, or (for
    the one-file test tables) a glob matching exactly that file."""
    return os.path.join(sf_dir, f"[{table[0]}]{table[1:]}.parquet")


class Changelog(str):
    """Folder of a stream's update rows, with their schema and the number of
    rows that the stateful operators dropped as late."""

    schema: StructType
    late_rows: int

    def __new__(cls, path: str, schema: StructType, late_rows: int):
        self = super().__new__(cls, path)
        self.schema, self.late_rows = schema, late_rows
        return self


def run_changelog(stream: DataFrame, name: str, output_mode: str = "update",
                  trigger_available_now: bool = True) -> Changelog:
    """Run ``stream`` until the available input is processed, appending
    every micro-batch's rows to a fresh changelog folder below the shared
    checkpoint location.  Returns the folder."""
    spark = stream.sparkSession
    out = scratch_path(spark, f"{name}-out")
    ckpt = scratch_path(spark, f"{name}-ckpt")

    def write_batch(df: DataFrame, batch_id: int) -> None:
        # one folder per batch: a replayed batch overwrites itself
        df.write.mode("overwrite").parquet(os.path.join(out, f"_batch={batch_id}"))

    late = run_stream(stream.writeStream.outputMode(output_mode).option("checkpointLocation", ckpt)
                      .foreachBatch(write_batch), spark, trigger_available_now)
    return Changelog(out, stream.schema, late)


def run_totals(stream: DataFrame, name: str, keys: Sequence[str], value: str, again: Sequence[int] = ()) -> str:
    """DOC-14 on a stream: every micro-batch is added to a table of running totals
    (``writers.add_totals``) under its number, so one that is repeated after a
    failure counts once; ``again`` repeats batches to show it.  Returns the
    table's path."""
    from oreflow.sinks.writers import add_totals
    spark = stream.sparkSession
    out, ckpt = scratch_path(spark, f"{name}-totals"), scratch_path(spark, f"{name}-ckpt")

    def write_batch(df: DataFrame, batch_id: int) -> None:
        for _ in range(2 if batch_id in again else 1):
            add_totals(df, out, keys, value, f"{name}-{batch_id}")

    run_stream(stream.writeStream.option("checkpointLocation", ckpt).foreachBatch(write_batch), spark)
    return out


STATE_STORE = ("spark.sql.streaming.stateStore.providerClass",
               "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")


def run_stream(writer, spark: SparkSession, available_now: bool = True) -> int:
    """Run a stream to its end; the number of rows its stateful operators
    dropped because the watermark had passed them.  State lives in RocksDB."""
    before = spark.conf.get(STATE_STORE[0])
    spark.conf.set(*STATE_STORE)
    try:
        q = (writer.trigger(availableNow=True) if available_now else writer).start()
        q.awaitTermination()
    finally:
        spark.conf.set(STATE_STORE[0], before)
    if q.exception() is not None:
        raise RuntimeError(str(q.exception()))
    return sum(o.numRowsDroppedByWatermark for p in q.recentProgress for o in p.stateOperators)


def read_changelog(spark: SparkSession, path: str, keys: Sequence[str] | None = None,
                   schema: StructType | str | None = None) -> DataFrame:
    """All rows of a changelog (append mode) or, with ``keys``, the latest
    row per key (update mode) unless that one is marked ``deleted``.  A stream
    without a batch left no rows; any other failure to read is an error."""
    schema = schema or getattr(path, "schema", None)
    if schema is not None and not path_exists(spark, path):
        return spark.createDataFrame([], schema)
    fields = StructType.fromDDL(schema) if isinstance(schema, str) else schema
    reader = spark.read.schema(StructType([*fields.fields, StructField("_batch", LongType())])) if fields else spark.read
    df = reader.parquet(path)
    if not keys:
        return df.drop("_batch")
    rest = [c for c in df.columns if c not in _keys(keys) and c != "_batch"]
    latest = (df.groupBy(*_keys(keys)).agg(F.max_by(F.struct(*rest), F.col("_batch")).alias("__r"))
              .select(*_keys(keys), "__r.*"))
    return latest.where(~F.col("deleted")).drop("deleted") if "deleted" in rest else latest


def to_ntz(df: DataFrame) -> DataFrame:
    """Cast TIMESTAMP columns (and struct fields) back to NTZ wall-clock time."""
    from pyspark.sql.types import StructType, TimestampType
    cols = []
    for f in df.schema.fields:
        if isinstance(f.dataType, TimestampType):
            cols.append(F.col(f.name).cast("timestamp_ntz").alias(f.name))
        elif isinstance(f.dataType, StructType) and any(isinstance(x.dataType, TimestampType)
                                                        for x in f.dataType.fields):
            cols.append(F.struct(*[(F.col(f"{f.name}.{x.name}").cast("timestamp_ntz")
                                    if isinstance(x.dataType, TimestampType) else F.col(f"{f.name}.{x.name}"))
                                   .alias(x.name) for x in f.dataType.fields]).alias(f.name))
        else:
            cols.append(F.col(f.name))
    return df.select(*cols)


def run_with_late_side_output(stream: DataFrame, ts: str, delay_s: int, out: str, keys: Sequence[str],
                              future_s: int = 86400, trigger_available_now: bool = True,
                              checkpoint: str | None = None, arrived: str | None = None):
    """ST-09 / ST-11: drive ``stream`` and split every micro-batch into rows
    from the future (more than ``future_s`` ahead of their arrival time
    ``arrived``; without such a column, ahead of everything seen so far), late
    rows (event time older than the highest event time of earlier batches'
    on-time rows minus ``delay_s``) and on-time rows; each goes to its own
    folder below ``out``.  Repeated events (same ``keys``) are dropped within
    the batch and against the on-time rows already written inside the watermark
    delay (a stateful streaming de-duplication would silently drop the late rows
    before they reach the side output).  Each batch writes its own folders and
    its maximum under its own number, so a repeated batch changes nothing.
    Returns the query's checkpoint folder (reuse it to continue)."""
    spark = stream.sparkSession
    ckpt = checkpoint or scratch_path(spark, "late-ckpt")

    def write_batch(df: DataFrame, batch_id: int) -> None:
        from oreflow.streaming.operators import late_split
        maxima, done = os.path.join(out, "_max"), os.path.join(out, "on_time")
        earlier = F.col("_batch") < batch_id
        seen = spark.read.parquet(maxima).where(earlier).agg(F.max("m")).first()[0] if path_exists(spark, maxima) else None
        wm = F.lit(seen).cast("timestamp") - F.make_dt_interval(secs=F.lit(delay_s)) if seen else F.lit(None).cast("timestamp")
        df = df.dropDuplicates(_keys(keys))
        if arrived:
            anchor = F.col(arrived)
        else:
            # the highest time seen before, at first the batch's median: one bogus row cannot move it
            anchor = F.lit(seen or df.agg(F.percentile_approx(ts, 0.5)).first()[0]).cast("timestamp")
        fut = F.coalesce(F.col(ts) > anchor + F.make_dt_interval(secs=F.lit(future_s)), F.lit(False))
        if path_exists(spark, done):
            recent = spark.read.parquet(done).where(earlier)
            recent = recent.where(F.col(ts) >= wm) if seen else recent
            df = df.join(recent.select(*_keys(keys)), _keys(keys), "left_anti")
        on_time, late = late_split(df.where(~fut), ts, wm)
        base = os.path.join(out, "{}", f"_batch={batch_id}")
        on_time.write.mode("overwrite").parquet(base.format("on_time"))
        late.write.mode("overwrite").parquet(base.format("late"))
        df.where(fut).write.mode("overwrite").parquet(base.format("future"))
        spark.read.schema(df.schema).parquet(base.format("on_time")).agg(F.max(ts).alias("m")) \
            .write.mode("overwrite").parquet(base.format("_max"))

    run_stream(stream.writeStream.option("checkpointLocation", ckpt).foreachBatch(write_batch), spark, trigger_available_now)
    return ckpt


LAG_STEPS, LAG_STEP_H = 5, 8       # arrival lags of the landing: 0, 8 .. 32 hours
DELAY = "48 hours"                 # watermark delay that covers them
DROPS, FILES = 3, 4                # deliveries, files in each

_LANDED: dict[tuple, str] = {}


def land_out_of_order(spark: SparkSession, sf_dir: str, faulty: bool = False) -> str:
    """Landing folder of the ``events`` table as gateways deliver it: a reading
    arrives up to 32 hours after its event time, in the order of arrival, in
    three deliveries of four files each.  ``faulty`` also has late gateways (one
    reading in 50 comes 12 days after its time), wrong clocks (one in 97 is ten
    days ahead) and repeated rows (one in 40).  Written once per session."""
    key = (spark.sparkContext.applicationId, id(spark), sf_dir, faulty)
    if key in _LANDED:
        return _LANDED[key]
    e = spark.read.parquet(os.path.join(sf_dir, "events.parquet"))
    n = F.col("event_id")
    hours = (n % LAG_STEPS) * LAG_STEP_H
    if faulty:
        hours = F.when(n % 50 == 7, 12 * 24).otherwise(hours)
    e = e.withColumn("arrived", F.col("ts") + F.make_dt_interval(hours=hours.cast("int")))
    if faulty:
        e = e.withColumn("ts", F.when(n % 97 == 3, F.col("ts") + F.expr("INTERVAL 10 DAYS")).otherwise(F.col("ts")))
        e = e.unionByName(e.where(n % 40 == 5))
    a = F.unix_micros(F.col("arrived").cast("timestamp"))
    lo, hi = e.agg(F.min(a), F.max(a)).first()
    e = e.withColumn("drop", F.least(F.floor((a - lo) * DROPS / F.greatest(F.lit(hi - lo if hi else 1), F.lit(1))), F.lit(DROPS - 1)))
    path = scratch_path(spark, "landing")
    for k in range(DROPS):
        e.where(F.col("drop") == k).drop("drop").repartition(FILES).write.mode("append").parquet(path)
    _LANDED[key] = path
    return path


def arrivals(spark: SparkSession, landing: str) -> DataFrame:
    """A landing folder as a stream, one delivery in a micro-batch, with the time
    of arrival."""
    return event_stream(spark, landing, f"{EVENTS_SCHEMA}, arrived timestamp_ntz", max_files_per_trigger=FILES)

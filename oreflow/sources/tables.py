"""The driver's parquet tables and the domain views the library works on.

Binding of the plant concepts onto the given tables:

* sensor readings  <- ``events``  (equipment_id=user_id, sensor_type=event_type,
  value, ts, payload=props JSON)
* production fact  <- ``lineitem`` + ``orders``
* mines / equipment types / equipment / operators
                   <- ``region`` / ``nation`` / ``supplier``, ``customer`` / ``part``
* documents, labels, benchmark, conversations, pages, embeddings as given.

Only column pruning happens here; every view stays lazy so Catalyst pushes
filters and projections into the parquet scan.
"""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

TABLES = (
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem",
    "events", "documents", "embeddings", "pages", "benchmark", "labels",
    "conversations",
)


def table_path(sf_dir: str, name: str) -> str:
    return os.path.join(sf_dir, f"{name}.parquet")


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    if name not in TABLES:
        raise ValueError(f"unknown table {name!r}")
    return spark.read.parquet(table_path(sf_dir, name))


def register_views(spark: SparkSession, sf_dir: str) -> None:
    """Register every table as a temp view (for the SQL form of a job)."""
    for t in TABLES:
        read(spark, sf_dir, t).createOrReplaceTempView(t)


def sensor_readings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Telemetry readings in the reference's vocabulary."""
    return read(spark, sf_dir, "events").select(
        F.col("event_id").alias("reading_id"),
        F.col("user_id").alias("equipment_id"),
        F.col("event_type").alias("sensor_type"),
        F.col("value"),
        F.col("ts"),
        F.col("props").alias("payload"),
    )


def production(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Production fact at line grain: order = shift report, line = trip."""
    li = read(spark, sf_dir, "lineitem")
    o = read(spark, sf_dir, "orders")
    return li.join(o, li.l_orderkey == o.o_orderkey, "inner")


def spread(df: DataFrame, factor: int = 1) -> DataFrame:
    """Spread CPU-heavy per-row work (tokenising, parsing) over the cluster
    when the input arrives in fewer splits than there are cores (e.g. one
    large unsplittable file).  The partition count is known at planning
    time; at scale the input already has far more splits than cores and
    nothing is shuffled."""
    target = df.sparkSession.sparkContext.defaultParallelism * factor
    if df.rdd.getNumPartitions() < target:
        return df.repartition(target)
    return df

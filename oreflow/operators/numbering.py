"""Dense numbers in a global order without a window over the whole table."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from oreflow.session import checkpoint_dir

_ROW_BITS = 33    # of monotonically_increasing_id: partition above, row in it below


def dense_numbers(df: DataFrame, order: Sequence[str], out: str) -> DataFrame:
    """Numbers 1, 2, ... of the rows in the order of ``order`` (NULL first).

    Rows are sorted by ranges and written once, so partitions and the places in
    them stay; each partition's first number is the count of the rows before it
    (one number per partition, summed on the driver)."""
    spark = df.sparkSession
    checkpoint_dir(spark)
    s = df.repartitionByRange(*order).sortWithinPartitions(*order) \
        .withColumn("__m", F.monotonically_increasing_id()).checkpoint()
    part = F.shiftrightunsigned("__m", _ROW_BITS)
    counts = sorted(tuple(r) for r in s.groupBy(part.alias("p")).agg(F.count(F.lit(1)).alias("n")).collect())
    before, offsets = 0, []
    for p, n in counts:
        offsets.append((p, before))
        before += n
    table = spark.createDataFrame(offsets, "__p bigint, __before bigint")
    # one row per partition
    j = s.join(F.broadcast(table), part == F.col("__p"))
    row = F.col("__m").bitwiseAND((1 << _ROW_BITS) - 1)
    return j.withColumn(out, F.col("__before") + row + 1).drop("__m", "__p", "__before")


def running_totals(df: DataFrame, order: Sequence[str], value: str, out: str) -> DataFrame:
    """Sum of ``value`` up to each row in the order of ``order`` (unique): sums
    inside ranges of the order, after the totals of the ranges before (one number
    per range, summed on the driver)."""
    spark = df.sparkSession
    checkpoint_dir(spark)
    s = df.repartitionByRange(*order).withColumn("__p", F.spark_partition_id()).checkpoint()
    before, offsets = 0, []
    for r in s.groupBy("__p").agg(F.sum(value).alias("n")).orderBy("__p").collect():
        offsets.append((r["__p"], before))
        before += r["n"]
    table = spark.createDataFrame(offsets, "__p int, __before long")
    inside = F.sum(value).over(Window.partitionBy("__p").orderBy(*order).rowsBetween(Window.unboundedPreceding, 0))
    return s.withColumn("__in", inside).join(F.broadcast(table), "__p").withColumn(out, F.col("__before") + F.col("__in")) \
        .drop("__p", "__in", "__before")

"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

import gc

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from oreflow.session import checkpoint_dir, scratch_path

# Stands for a NULL id while rows are compared; ids of documents are not negative.
NULL_ID = -(1 << 63)


BATCH_ROWS = "spark.sql.execution.arrow.maxRecordsPerBatch"


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The table; rows of text go to Python a thousand at a time unless the
    session says otherwise, so long texts don't fill an executor's memory."""
    if spark.conf.get(BATCH_ROWS) == "10000":
        spark.conf.set(BATCH_ROWS, "1000")
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def cut(df: DataFrame) -> DataFrame:
    """Write ``df`` to the shared checkpoint folder and go on from there: its
    lineage ends, and a lost executor costs no recomputation."""
    checkpoint_dir(df.sparkSession)
    return df.checkpoint()


def id_key(col: str = "doc_id") -> Column:
    return F.coalesce(F.col(col).cast("long"), F.lit(NULL_ID))


def key_id(col: str) -> Column:
    c = F.col(col)
    return F.when(c != NULL_ID, c)


def fold(col: str = "doc_id", parts: int = 5) -> Column:
    """crc32 of the id's text modulo ``parts``; a NULL id counts as ''."""
    return F.crc32(F.coalesce(F.col(col).cast("string"), F.lit("")).cast("binary")) % parts


def free_name(df: DataFrame, name: str) -> str:
    """A column name not used in ``df`` (compared without case)."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name = f"_{name}"
    return name


def without(df: DataFrame, names: list[str]) -> DataFrame:
    """``df`` without columns that an operator is about to add."""
    low = {n.lower() for n in names}
    return df.select(*[F.col(f"`{c}`") for c in df.columns if c.lower() not in low])


def wider(df: DataFrame, columns: str) -> StructType:
    """The schema of ``df`` with further columns, given as DDL."""
    return StructType(df.schema.fields + StructType.fromDDL(columns).fields)


class Tables:
    """Intermediate tables as Parquet in the shared folder: smaller than a
    checkpoint, and dropped as soon as what they lead to is written."""

    def __init__(self, spark: SparkSession):
        self.spark, self.paths, self.made = spark, {}, 0

    def __call__(self, df: DataFrame, name: str | None = None) -> DataFrame:
        self.made += 1
        name = name or f"table{self.made}"
        path = scratch_path(self.spark, name)
        df.write.option("compression", "zstd").parquet(path)
        self.paths[name] = path
        out = self.spark.read.schema(df.schema).parquet(path)
        out.table = name
        return out

    def rows(self, df: DataFrame) -> DataFrame:
        """For long values: a checkpoint, row by row (Parquet is read and written
        thousands of rows at a time), dropped like the others."""
        checkpoint_dir(self.spark)
        out = df.checkpoint()
        self.made += 1
        out.table = f"rows{self.made}"
        self.paths[out.table] = out._jdf.queryExecution().analyzed().rdd().getCheckpointFile().get()
        return out

    def drop(self, *names: str | DataFrame | None) -> None:
        """Delete tables, all without names."""
        jvm = self.spark.sparkContext._jvm
        conf = self.spark.sparkContext._jsc.hadoopConfiguration()
        for n in names or list(self.paths):
            path = self.paths.pop(getattr(n, "table", n), None)
            if path:
                path = jvm.org.apache.hadoop.fs.Path(path)
                path.getFileSystem(conf).delete(path, True)

    def sweep(self) -> None:
        """Let Spark delete the shuffle files of jobs that are over: it does so when
        the driver's garbage is collected, which many short rounds never cause."""
        gc.collect()
        self.spark.sparkContext._jvm.System.gc()

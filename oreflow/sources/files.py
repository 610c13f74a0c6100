"""File, JDBC, inline and series sources (SRC-01..SRC-07)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

CORRUPT = "_corrupt_record"


def _with_corrupt(schema: StructType | str, spark: SparkSession) -> StructType:
    if isinstance(schema, str):
        schema = StructType.fromDDL(schema)
    if CORRUPT in schema.fieldNames():
        return schema
    return StructType(list(schema.fields) + [StructField(CORRUPT, StringType(), True)])


def read_csv(spark: SparkSession, path: str, schema: StructType | str, delimiter: str = ",",
             keep_corrupt: bool = True) -> DataFrame:
    """SRC-01: CSV with header and declared types (no inference).  Rows that
    do not fit the schema are kept with their raw text in
    ``_corrupt_record`` (PERMISSIVE) so they can be quarantined.  Spark parses
    only the columns that are asked for: read all of them to see every fault."""
    r = (spark.read.option("header", True).option("delimiter", delimiter).option("encoding", "UTF-8")
         .option("mode", "PERMISSIVE"))
    if keep_corrupt:
        r = r.option("columnNameOfCorruptRecord", CORRUPT).schema(_with_corrupt(schema, spark))
    else:
        r = r.schema(schema)
    return r.csv(path)


def read_json_documents(spark: SparkSession, path: str, schema: StructType | str | None = None,
                        multiline: bool = True) -> DataFrame:
    """SRC-02: a JSON array of documents per file (multiLine) or JSON lines."""
    r = spark.read.option("multiLine", multiline).option("mode", "PERMISSIVE")
    if schema is not None:
        r = r.schema(schema)
    return r.json(path)


def read_xml(spark: SparkSession, path: str, row_tag: str, schema: StructType | str | None = None,
             xsd_path: str | None = None) -> DataFrame:
    """SRC-04: XML files, one record per ``row_tag`` element; attributes
    arrive as ``_name`` fields, mixed value+attribute elements as
    ``_VALUE``.  ``xsd_path`` turns on the reader's own XSD row validation
    (a cross-check for DQ-19)."""
    r = spark.read.format("xml").option("rowTag", row_tag)
    if xsd_path:
        r = r.option("rowValidationXSDPath", xsd_path)
    if schema is not None:
        r = r.schema(schema)
    return r.load(path)


def read_jdbc(spark: SparkSession, url: str, query: str, properties: dict | None = None,
              partition_column: str | None = None, lower: int | None = None, upper: int | None = None,
              num_partitions: int = 8) -> DataFrame:
    """SRC-05: a query against a database, read in parallel ranges of
    ``partition_column`` when given (the query is wrapped as a subquery)."""
    r = spark.read.format("jdbc").option("url", url)
    for k, v in (properties or {}).items():
        r = r.option(k, v)
    if partition_column:
        r = (r.option("dbtable", f"({query}) q").option("partitionColumn", partition_column)
             .option("lowerBound", lower).option("upperBound", upper).option("numPartitions", num_partitions))
    else:
        r = r.option("query", query)
    return r.load()


def inline_rows(spark: SparkSession, rows: Sequence[tuple], schema: str) -> DataFrame:
    """SRC-06: VALUES (...) — small literal tables (rules, mappings)."""
    return spark.createDataFrame(list(rows), schema)


def date_series(df_with_range: DataFrame, lo: str, hi: str, step: str = "1 day", out: str = "d") -> DataFrame:
    """SRC-07: generate_series between two columns of a (one-row or keyed)
    DataFrame: ``explode(sequence(lo, hi, step))``."""
    return df_with_range.select("*", F.explode(F.sequence(F.col(lo), F.col(hi),
                                                          F.expr(f"INTERVAL {step}"))).alias(out))


def id_series(spark: SparkSession, start: int, end: int, partitions: int | None = None) -> DataFrame:
    """SRC-07: integer series [start, end) generated in parallel."""
    return spark.range(start, end, 1, partitions)

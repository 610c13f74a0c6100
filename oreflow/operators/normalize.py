"""Normalisation operators: normal-form checks, text-to-key migration,
lossless split of a wide table, idempotent schema changes."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DataType


def multi_value_rows(df: DataFrame, column: str, separators: Sequence[str] = (",", ";")) -> DataFrame:
    """NORM-01: rows whose text holds several values (1NF violation)."""
    cond = None
    for s in separators:
        c = F.col(column).contains(s)
        cond = c if cond is None else cond | c
    return df.where(cond)


def fd_violations(df: DataFrame, determinant: Sequence[str], dependent: str) -> DataFrame:
    """NORM-01: determinant values mapped to more than one dependent value
    (the functional dependency A -> B does not hold for them)."""
    return (df.groupBy(*determinant).agg(F.count_distinct(dependent).alias("n_values"))
            .where(F.col("n_values") > 1))


def map_text_to_key(df: DataFrame, text_col: str, mapping: DataFrame, map_text: str, map_key: str,
                    out: str) -> DataFrame:
    """NORM-02 (G20): replace free text by a key through a mapping table.
    A left join keeps rows whose spelling is not mapped (``out`` NULL) so
    they can be reported; text is matched after trim.  The mapping table
    is one row per spelling and is expected to be small; Spark's runtime
    statistics decide on broadcasting it."""
    m = mapping.select(F.trim(F.col(map_text)).alias("__t"), F.col(map_key).alias(out)).dropDuplicates(["__t"])
    return df.join(m, F.trim(F.col(text_col)) == F.col("__t"), "left").drop("__t")


def lossless_split(wide: DataFrame, entity_cols: Sequence[str], entity_key: str, fk: str) -> DataFrame:
    """NORM-03: split a wide table into an entity table (distinct
    projection) and the rest (with the foreign key), rebuild by join and
    check that nothing was lost or invented.  Output: check_name, n."""
    entity = wide.select(*entity_cols).distinct()
    rest = wide.drop(*[c for c in entity_cols if c != fk])
    rebuilt = rest.join(entity, rest[fk] == entity[entity_key]).select(*wide.columns)
    lost = wide.exceptAll(rebuilt)
    extra = rebuilt.exceptAll(wide)
    from oreflow.operators.aggregates import count_report
    rep = count_report({"rows_wide": wide, "rows_rebuilt": rebuilt, "lost_rows": lost.unionByName(extra),
                        "orders_entity": entity})
    return rep.select(F.col("table_name").alias("check_name"), F.col("n_rows").alias("n"))


def ensure_column(df: DataFrame, name: str, dtype: DataType | str) -> DataFrame:
    """NORM-04: add a column if it is absent (re-running changes nothing)."""
    return df if name in df.columns else df.withColumn(name, F.lit(None).cast(dtype))


def drop_column_if_present(df: DataFrame, name: str) -> DataFrame:
    """NORM-04: drop a column if present."""
    return df.drop(name) if name in df.columns else df


def align_schemas(a: DataFrame, b: DataFrame) -> DataFrame:
    """NORM-04: union of two versions of a table whose columns differ."""
    return a.unionByName(b, allowMissingColumns=True)

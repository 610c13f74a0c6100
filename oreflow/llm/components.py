"""Connected components of a link table by large-star / small-star rounds."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Tables


def _stars(e: DataFrame) -> bool:
    """Whether every node above another has but one below it, which has none itself."""
    ends = e.select(F.col("u").alias("w"), F.lit(1).alias("down"), F.lit(0).alias("up")) \
        .unionByName(e.select(F.col("v").alias("w"), F.lit(0).alias("down"), F.lit(1).alias("up")))
    return ends.groupBy("w").agg(F.sum("down").alias("down"), F.max("up").alias("up")) \
        .where(F.col("down") + F.col("up") > 1).isEmpty()


def components(links: DataFrame) -> DataFrame:
    """(node, root) for every node of ``links`` (columns u, v): root is the
    smallest node that can be reached.  Rounds go on until all are stars; a
    node's neighbours are only ever reduced to their minimum, never gathered."""
    e = links.where(F.col("u") != F.col("v")) \
        .select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct()
    tables = Tables(links.sparkSession)
    e = tables(e)
    while not _stars(e):
        both = e.unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        m = both.groupBy("u").agg(F.min("v").alias("m")).select(F.col("u").alias("w"), F.least("u", "m").alias("m"))
        large = both.join(m, F.col("u") == F.col("w")).where(F.col("v") > F.col("u")) \
            .select(F.col("v").alias("u"), F.col("m").alias("v")).where(F.col("u") != F.col("v")).distinct()
        low = large.groupBy("u").agg(F.min("v").alias("m")).select(F.col("u").alias("w"), "m")
        small = large.join(low, F.col("u") == F.col("w")) \
            .select(F.explode(F.array(F.struct(F.col("u").alias("u"), F.col("m").alias("v")),
                                      F.struct(F.col("v").alias("u"), F.col("m").alias("v")))).alias("x")) \
            .select("x.u", "x.v").where(F.col("u") != F.col("v")).distinct()
        old, e = e, tables(small)
        tables.drop(old)
    # every node is now linked with its root alone
    roots = e.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct()
    return e.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(roots)

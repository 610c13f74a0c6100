"""Aggregation operators composed from Spark built-ins.

All of them aggregate with partial (map-side) combine before the shuffle;
none gathers a group's rows into one array unless the operator's result is
that array (top-k lists are capped by k before collection).
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window


def _keys(keys) -> list[str]:
    if keys is None:
        return []
    return [keys] if isinstance(keys, str) else list(keys)


def share_of_total(df: DataFrame, keys: Sequence[str], measure: Column | None = None,
                   out: str = "share_pct") -> DataFrame:
    """AG-12 / WN-10: count (or sum of ``measure``) per group and its percent
    of the grand total.  The grand total is a window over the already
    aggregated groups (one row per group), not over the raw rows."""
    m = F.count(F.lit(1)) if measure is None else F.sum(measure)
    g = df.groupBy(*_keys(keys)).agg(m.alias("amount"))
    total = F.sum("amount").over(Window.partitionBy())
    return g.withColumn(out, F.col("amount") * 100.0 / total)


def facet_counts(df: DataFrame, dims: Sequence[str]) -> DataFrame:
    """AG-16 ($facet): counts by each dimension separately, in one pass with
    GROUPING SETS.  Output: facet (dimension name), value, n."""
    dims = list(dims)
    g = df.groupingSets([[F.col(d)] for d in dims], *[F.col(d) for d in dims]).agg(
        F.count(F.lit(1)).alias("n"), *[F.grouping(d).alias(f"__g_{d}") for d in dims])
    facet = value = None
    for d in dims:
        on = F.col(f"__g_{d}") == 0
        facet = F.when(on, F.lit(d)) if facet is None else facet.when(on, F.lit(d))
        v = F.col(d).cast("string")
        value = F.when(on, v) if value is None else value.when(on, v)
    return g.select(facet.alias("facet"), value.alias("value"), "n")


def pivot_counts(df: DataFrame, row_key: str, pivot_col: str, values: Sequence[str],
                 measure: Column | None = None) -> DataFrame:
    """AG-17: cross-tab; explicit pivot values avoid an extra distinct job."""
    g = df.groupBy(row_key).pivot(pivot_col, list(values))
    out = g.count() if measure is None else g.agg(F.sum(measure))
    for v in values:
        out = out.withColumn(v, F.coalesce(F.col(v), F.lit(0)))
    return out


def top_k_per_group(df: DataFrame, keys: Sequence[str], order: Sequence[Column], k: int,
                    rank_col: str = "rank") -> DataFrame:
    """OL-06 / AG-19: the first ``k`` rows per group under ``order``
    (which must end in a unique tie-breaker for determinism).

    Spark plans ``row_number() <= k`` over a window as a group limit, which
    drops rows before the window sort, so a hot group keeps only k rows per
    partition early."""
    w = Window.partitionBy(*_keys(keys)).orderBy(*order)
    return df.withColumn(rank_col, F.row_number().over(w)).where(F.col(rank_col) <= k)


def last_by_order(df: DataFrame, keys: Sequence[str], value: str, order: str,
                  out: str | None = None) -> DataFrame:
    """AG-18 ($last): value of the row with the greatest ``order`` per group."""
    return df.groupBy(*_keys(keys)).agg(F.max_by(value, order).alias(out or f"last_{value}"))


def weighted_recombine(partials: DataFrame, keys: Sequence[str], sum_col: str = "sum_value",
                       n_col: str = "n", min_col: str | None = "min_value",
                       max_col: str | None = "max_value") -> DataFrame:
    """AG-13 / TS-23: merge partial aggregates (sum, count, min, max) into
    the exact overall average.  Averages of averages are never taken."""
    aggs = [F.sum(sum_col).alias("sum_value"), F.sum(n_col).alias("n")]
    if min_col:
        aggs.append(F.min(min_col).alias("min_value"))
    if max_col:
        aggs.append(F.max(max_col).alias("max_value"))
    g = partials.groupBy(*_keys(keys)).agg(*aggs)
    return g.withColumn("avg_value", F.try_divide(F.col("sum_value"), F.nullif(F.col("n"), F.lit(0))))


def bucket_by_boundaries(df: DataFrame, value: str, boundaries: Sequence[float],
                         default: str = "other", outputs: Mapping[str, Column] | None = None,
                         labels: Sequence[str] | None = None) -> DataFrame:
    """AG-15 ($bucket): lower-inclusive ranges with a default bucket."""
    from oreflow.functions.classify import range_bucket
    aggs = [F.count(F.lit(1)).alias("n")]
    for name, c in (outputs or {}).items():
        aggs.append(c.alias(name))
    b = range_bucket(value, boundaries, default, labels)
    return df.groupBy(b.alias("bucket")).agg(*aggs)


def count_report(parts: Mapping[str, DataFrame]) -> DataFrame:
    """AG-21: one row per named DataFrame with its row count (UNION ALL of
    global counts); each count is its own aggregate job branch."""
    out = None
    for name, df in parts.items():
        c = df.agg(F.count(F.lit(1)).alias("n_rows")).select(F.lit(name).alias("table_name"), "n_rows")
        out = c if out is None else out.unionByName(c)
    return out

"""Column profiling as distributed aggregates (PR-01..PR-08).

A profile is a long table (column, metric, value) computed in one aggregate
pass per table; quantiles use ``percentile_approx`` (bounded memory per
group).  Ranks for Spearman correlation come from quantile buckets and
distinct-value counts, never from a window over the whole table in one task.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window
from pyspark.sql.types import NumericType, StringType

from oreflow.operators.numbering import running_totals


def numeric_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, NumericType)]


def profile(df: DataFrame, columns: Sequence[str] | None = None, quantiles: Sequence[float] = (),
            accuracy: int = 10000, exact_distinct: bool = False) -> DataFrame:
    """PR-01: per column count, missing, distinct, min, max, mean, std,
    zeros, negatives (numeric), min/max/avg length (strings), and the
    requested approximate quantiles.  Output: column, metric, value (double).

    Distinct counts are HyperLogLog estimates by default: several exact
    distinct aggregates in one pass make Spark expand every row once per
    column; ``exact_distinct`` asks for exact values, of quantiles too (from
    counts per value, see ``exact_quantiles``)."""
    columns = list(columns or df.columns)
    types = {f.name: f.dataType for f in df.schema.fields}
    aggs, names = [F.count(F.lit(1)).alias("__rows")], []
    for c in columns:
        col = F.col(c)
        m = {"rows": F.count(F.lit(1)), "count": F.count(col), "missing": F.count_if(col.isNull())}
        if not exact_distinct:
            m["distinct"] = F.approx_count_distinct(col, 0.01)
        if isinstance(types[c], NumericType):
            m.update({"min": F.min(col), "max": F.max(col), "mean": F.avg(col), "std": F.stddev(col),
                      "zeros": F.count_if(col == 0), "negatives": F.count_if(col < 0),
                      "skewness": F.skewness(col)})
            for q in quantiles if not exact_distinct else ():
                m[f"p{int(q * 100)}"] = F.percentile_approx(col, q, accuracy)
        elif isinstance(types[c], StringType):
            m.update({"min_length": F.min(F.length(col)), "max_length": F.max(F.length(col)),
                      "mean_length": F.avg(F.length(col))})
        for k, e in m.items():
            alias = f"{c}__{k}"
            aggs.append(e.cast("double").alias(alias))
            names.append((c, k, alias))
    wide = df.agg(*aggs)
    if exact_distinct:
        # exact distinct counts as separate scalar sub-queries: mixed into
        # the main aggregate they would expand every row once per column
        extra = []
        for c in columns:
            extra.append(df.select(F.count_distinct(c).cast("double")).scalar().alias(f"{c}__distinct"))
            names.append((c, "distinct", f"{c}__distinct"))
            if quantiles and isinstance(types[c], NumericType):
                found = exact_quantiles(df, c, quantiles)
                for q in quantiles:
                    value = found.where(F.col("q") == float(q)).select(F.max("value").cast("double"))
                    extra.append(value.scalar().alias(f"{c}__p{int(q * 100)}"))
                    names.append((c, f"p{int(q * 100)}", f"{c}__p{int(q * 100)}"))
        wide = wide.select("*", *extra)
    stack = F.explode(F.array(*[F.struct(F.lit(c).alias("column"), F.lit(k).alias("metric"),
                                         F.col(a).alias("value")) for c, k, a in names]))
    return wide.select(stack.alias("s")).select("s.*")


TRACKED = 10_000     # values that a heavy-hitter sketch tracks
SKETCH_ERROR = 3.5   # a sketch's count is off by this share of rows / its size at most


def top_values(df: DataFrame, columns: Sequence[str], k: int = 5, tracked: int = TRACKED) -> DataFrame:
    """PR-01: type and the k most frequent values of each column, exact: column,
    type, place, value (text), n; ties by value, NULL is no value.

    A heavy-hitter sketch (partial per task, merged) names candidates; a second
    pass counts them.  A value the sketch does not name occurs no more often than
    its last candidate and its error bound say; only a column whose k-th count
    is not above that is counted value by value."""
    spark, parts = df.sparkSession, []
    wide = 4 * k
    sketch = df.agg(F.count(F.lit(1)).alias("rows"), *[F.call_function("approx_top_k", F.col(c).cast("string"), F.lit(wide), F.lit(tracked)).alias(f"s{i}")
                                                       for i, c in enumerate(columns)]).first()
    bound = SKETCH_ERROR * sketch["rows"] / tracked
    for i, c in enumerate(columns):
        found = [r["item"] for r in sketch[f"s{i}"] if r["item"] is not None]
        text = F.col(c).cast("string")
        # no more than ``wide`` values
        exact = df.where(text.isin(found)).groupBy(text.alias("value")).agg(F.count(F.lit(1)).alias("n")).collect() if found else []
        exact = sorted(((r["n"], r["value"]) for r in exact), key=lambda x: (-x[0], x[1]))
        rest = (min(r["count"] for r in sketch[f"s{i}"]) if len(found) >= wide else 0) + bound
        if len(exact) < k and len(found) >= wide or exact and len(found) >= wide and exact[min(k, len(exact)) - 1][0] <= rest \
                or len(found) < wide and bound >= 1:
            top = df.where(text.isNotNull()).groupBy(text.alias("value")).agg(F.count(F.lit(1)).alias("n")) \
                .orderBy(F.col("n").desc(), "value").limit(k).collect()
            exact = [(r["n"], r["value"]) for r in top]
        kind = df.schema[c].dataType.simpleString()
        parts += [(c, kind, p + 1, v, n) for p, (n, v) in enumerate(exact[:k])]
    return spark.createDataFrame(parts, "column string, type string, place int, value string, n long")


def correlation_alerts(df: DataFrame, columns: Sequence[str], threshold: float = 0.9) -> DataFrame:
    """PR-05: pairs of numeric columns whose correlation is beyond ``threshold``,
    all pairs in one aggregate: column, other, alert, value."""
    pairs = [(a, b) for i, a in enumerate(columns) for b in columns[i + 1:]]
    wide = df.agg(*[F.corr(F.col(a).cast("double"), F.col(b).cast("double")).alias(f"r{i}") for i, (a, b) in enumerate(pairs)])
    rows = F.array(*[F.struct(F.lit(a).alias("column"), F.lit(b).alias("other"), F.col(f"r{i}").alias("value"))
                     for i, (a, b) in enumerate(pairs)])
    return wide.select(F.explode(rows).alias("p")).select("p.column", "p.other", F.lit("high_correlation").alias("alert"), "p.value") \
        .where(F.abs("value") > threshold)


def histogram(df: DataFrame, column: str, bins: int) -> DataFrame:
    """PR-02: exact equal-width histogram between min and max (the maximum
    falls into the last bin)."""
    mm = df.agg(F.min(column).alias("lo"), F.max(column).alias("hi"))
    lo, hi = mm.select("lo").scalar(), mm.select("hi").scalar()
    width = (hi - lo) / F.lit(bins)
    b = F.least(F.floor((F.col(column) - lo) / F.nullif(width, F.lit(0.0))), F.lit(bins - 1))
    return (df.where(F.col(column).isNotNull())
            .groupBy(F.coalesce(b, F.lit(0)).cast("int").alias("bin"))
            .agg(F.count(F.lit(1)).alias("n"), F.min(column).alias("bin_min"), F.max(column).alias("bin_max")))


def global_average_rank(df: DataFrame, column: str, out: str) -> DataFrame:
    """Average rank (1-based, ties share the mean rank) of ``column`` over the
    whole table: rows per distinct value, running totals over ranges of values
    (``numbering.running_totals``: as many ranges as shuffle partitions), joined
    back.  A value held by a third of all rows is one row of the counts."""
    counts = df.groupBy(F.col(column).alias("__v")).agg(F.count(F.lit(1)).alias("__t"))
    ranks = running_totals(counts, ["__v"], "__t", "__upto") \
        .select("__v", (F.col("__upto") - F.col("__t") + (F.col("__t") + 1) / 2.0).alias(out))
    return df.join(ranks, F.col(column).eqNullSafe(F.col("__v"))).drop("__v")


def exact_quantiles(df: DataFrame, column: str, probs: Sequence[float], keys: Sequence[str] = (),
                    buckets: int = 64) -> DataFrame:
    """Exact discrete quantiles, per group of ``keys`` if given: the smallest
    value that at least q·n of the group's non-NULL values do not exceed.
    Output: keys, q, value.

    Works on counts per distinct value, ordered inside ranges of values whose
    boundaries (approximate quantiles) are fetched once, so neither a group's
    rows nor its distinct values meet in one task."""
    keys = list(keys)
    d = df.where(F.col(column).isNotNull())
    bounds = d.agg(F.percentile_approx(column, [i / buckets for i in range(1, buckets)], 10000)).first()[0] or []
    b = F.size(F.filter(F.array(*[F.lit(x) for x in sorted(set(bounds))]), lambda x: x < F.col(column))) \
        if bounds else F.lit(0)
    vc = d.groupBy(*keys, F.col(column).alias("value")).agg(F.count(F.lit(1)).alias("__t")) \
        .withColumn(column, F.col("value")).withColumn("__b", b)
    group = Window.partitionBy(*[F.col(f"__k{i}") for i in range(len(keys))])
    ranges = vc.groupBy(*[F.col(k).alias(f"__k{i}") for i, k in enumerate(keys)], F.col("__b").alias("__rb")) \
        .agg(F.sum("__t").alias("__n")) \
        .withColumn("__off", F.sum("__n").over(group.orderBy("__rb").rowsBetween(Window.unboundedPreceding, -1))) \
        .withColumn("__all", F.sum("__n").over(group))
    same = F.col("__b") == F.col("__rb")
    for i, k in enumerate(keys):
        same = same & F.col(k).eqNullSafe(F.col(f"__k{i}"))
    upto = F.sum("__t").over(Window.partitionBy(*keys, "__b").orderBy("value")
                             .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    r = vc.withColumn("__upto", upto).join(ranges, same).withColumn("__upto", F.col("__upto") + F.coalesce("__off", F.lit(0)))
    r = r.withColumn("q", F.explode(F.array(*[F.lit(float(q)) for q in probs])))
    rank = F.greatest(F.lit(1), F.ceil(F.round(F.col("q") * F.col("__all"), 6)))
    return r.where((F.col("__upto") >= rank) & (F.col("__upto") - F.col("__t") < rank)).select(*keys, "q", "value")


def spearman(df: DataFrame, a: str, b: str) -> DataFrame:
    """PR-03: Spearman correlation = Pearson correlation of average ranks
    (rows with a NULL in either column are left out)."""
    base = df.select(a, b).where(F.col(a).isNotNull() & F.col(b).isNotNull())
    ranked = global_average_rank(global_average_rank(base, a, "__ra"), b, "__rb")
    return ranked.agg(F.corr("__ra", "__rb").alias("spearman"))


def cramers_v(df: DataFrame, a: str, b: str) -> DataFrame:
    """PR-03 (categorical): Cramér's V from the contingency table; all
    steps are aggregates over (a, b) counts."""
    ct = df.groupBy(a, b).agg(F.count(F.lit(1)).alias("n_ab"))
    ra = ct.groupBy(a).agg(F.sum("n_ab").alias("n_a"))
    rb = ct.groupBy(b).agg(F.sum("n_ab").alias("n_b"))
    tot = ct.agg(F.sum("n_ab").alias("n"), F.count_distinct(a).alias("k_a"),
                 F.count_distinct(b).alias("k_b"))
    # chi2 = sum(n_ab^2 / (n_a n_b / n)) - n over the observed cells only:
    # empty cells contribute 0 to the sum, so no (a x b) grid is built
    j = ct.join(ra, a).join(rb, b)
    n = tot.select("n").scalar()
    chi = j.agg((F.sum(F.col("n_ab") * F.col("n_ab") / (F.col("n_a") * F.col("n_b") / n)) - n).alias("chi2"))
    k = F.least(tot.select("k_a").scalar(), tot.select("k_b").scalar()) - 1
    return chi.select("chi2", F.sqrt(F.col("chi2") / (n * F.nullif(k, F.lit(0)))).alias("cramers_v"))


def null_patterns(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """PR-04: how many rows share each pattern of missing columns."""
    mask = F.concat_ws("", *[F.when(F.col(c).isNull(), "1").otherwise("0") for c in columns])
    return df.groupBy(mask.alias("null_mask")).agg(F.count(F.lit(1)).alias("n"))


def duplicate_rows(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """PR-04: rows that occur more than once (all columns), with counts."""
    cols = list(columns or df.columns)
    return df.groupBy(*cols).agg(F.count(F.lit(1)).alias("n_copies")).where(F.col("n_copies") > 1)


def alerts(prof: DataFrame, high_card: float = 0.9, skew: float | None = 1.0,
           missing: float = 0.05, zeros: float = 0.10) -> DataFrame:
    """PR-05: alerts from a ``profile`` table: constant, high cardinality,
    skewed, missing share, zeros share.  Output: column, alert, value."""
    wide = prof.groupBy("column").pivot(
        "metric", ["rows", "count", "distinct", "missing", "zeros", "skewness"]).agg(F.first("value"))
    n = F.col("rows")
    rules = [
        ("constant", F.col("distinct") == 1, F.col("distinct")),
        ("high_cardinality", F.col("distinct") / F.nullif(F.col("count"), F.lit(0.0)) > high_card,
         F.col("distinct") / F.col("count")),
        ("skewed", F.abs(F.col("skewness")) > (skew if skew is not None else float("inf")),
         F.col("skewness")),
        ("missing", F.col("missing") / n > missing, F.col("missing") / n),
        ("zeros", F.col("zeros") / n > zeros, F.col("zeros") / n),
    ]
    arr = F.array(*[F.when(F.coalesce(cond, F.lit(False)),
                           F.struct(F.lit(name).alias("alert"), val.cast("double").alias("value")))
                    for name, cond, val in rules])
    return wide.select("column", F.explode(F.filter(arr, lambda x: x.isNotNull())).alias("a")).select(
        "column", "a.alert", "a.value")


def compare_groups(df: DataFrame, group_col: str, a_value, b_value, columns: Sequence[str],
                   exact_distinct: bool = False) -> DataFrame:
    """PR-06: profile two subsets side by side and their differences."""
    pa = profile(df.where(F.col(group_col) == a_value), columns, exact_distinct=exact_distinct) \
        .withColumnRenamed("value", "value_a")
    pb = profile(df.where(F.col(group_col) == b_value), columns, exact_distinct=exact_distinct) \
        .withColumnRenamed("value", "value_b")
    return (pa.join(pb, ["column", "metric"], "full_outer")
            .withColumn("difference", F.col("value_b") - F.col("value_a")))


def iqr_outliers(df: DataFrame, column: str, k: float = 1.5) -> DataFrame:
    """PR-08: rows outside [q1 - k·IQR, q3 + k·IQR], by exact quartiles."""
    q = exact_quantiles(df, column, [0.25, 0.75])
    q1, q3 = (q.where(F.col("q") == p).select(F.max("value")).scalar() for p in (0.25, 0.75))
    iqr = q3 - q1
    return df.where((F.col(column) < q1 - k * iqr) | (F.col(column) > q3 + k * iqr))

"""Threshold ladders and range buckets as pure column expressions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def ladder(value, steps: Sequence[tuple[float, str]], default: str,
           inclusive: bool = False) -> Column:
    """First label whose threshold ``value`` exceeds, checked in order.

    ``steps`` is ``[(threshold, label), ...]`` from the most severe down,
    e.g. ``[(300, 'bad'), (200, 'suspect')]`` with default ``'good'``.
    """
    v = _c(value)
    expr = None
    for thr, label in steps:
        cond = (v >= thr) if inclusive else (v > thr)
        expr = F.when(cond, F.lit(label)) if expr is None else expr.when(cond, F.lit(label))
    return F.lit(default) if expr is None else expr.otherwise(F.lit(default))


# Quality classes of a raw reading (SF-14): above 300 is bad, above 200 is
# suspect, the rest is good.  Parameters of the test binding, not constants
# of the reference.
QUALITY_STEPS = ((300.0, "bad"), (200.0, "suspect"))


def quality_flag(value) -> Column:
    return ladder(value, QUALITY_STEPS, "good")


def range_bucket(value, boundaries: Sequence[float], default: str = "other",
                 labels: Sequence[str] | None = None) -> Column:
    """$bucket: lower-inclusive ranges [b_i, b_{i+1}); outside -> default.

    The label of a bucket is its lower boundary unless ``labels`` are given.
    """
    v = _c(value)
    if labels is None:
        labels = [str(b) for b in boundaries[:-1]]
    expr = None
    for lo, hi, lab in zip(boundaries[:-1], boundaries[1:], labels):
        cond = (v >= lo) & (v < hi)
        expr = F.when(cond, F.lit(lab)) if expr is None else expr.when(cond, F.lit(lab))
    return expr.otherwise(F.lit(default))


def sigma_class(z, warn: float = 2.0, crit: float = 3.0) -> Column:
    """|z| > crit -> 'critical', > warn -> 'warning', else 'normal'."""
    a = F.abs(_c(z))
    return (F.when(a > crit, F.lit("critical"))
            .when(a > warn, F.lit("warning")).otherwise(F.lit("normal")))


def grade_class(tonnage, quality, high_t: float = 40.0, high_q: float = 0.03,
                ordinary_t: float = 20.0) -> Column:
    """SF-16: grade class from tonnage and a quality measure; thresholds are
    parameters (high: enough tonnage and low impurity)."""
    t, q = _c(tonnage), _c(quality)
    return (F.when((t >= high_t) & (q <= high_q), F.lit("high"))
            .when(t >= ordinary_t, F.lit("ordinary")).otherwise(F.lit("poor")))

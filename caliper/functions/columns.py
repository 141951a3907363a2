"""Row-level column expressions.

All are built-in expressions: they fuse into the scan stage's generated code.
"""

from __future__ import annotations

from typing import Iterable, Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


# P5: dictionary map; an unmapped value becomes NULL (no otherwise).
def map_values(c, mapping: Mapping) -> Column:
    out = None
    for k, v in mapping.items():
        out = F.when(_c(c) == F.lit(k), F.lit(v)) if out is None else out.when(_c(c) == F.lit(k), F.lit(v))
    return out


# P6
def threshold_flag(c, t: float) -> Column:
    return (_c(c) >= F.lit(t)).cast("int")


# NULL stays NULL (least/greatest alone would skip it).
def clip(c, lo: float, hi: float) -> Column:
    x = _c(c)
    return F.when(x.isNull(), F.lit(None)).otherwise(F.least(F.greatest(x, F.lit(lo)), F.lit(hi)))


# Weighted rule score.
def rule_score(rules: Sequence[tuple[float, Column]], lo: float = 0.0, hi: float = 1.0) -> Column:
    """``sum(weight * condition)`` clipped to ``[lo, hi]``; a NULL condition counts as false."""
    s = None
    for w, cond in rules:
        term = F.lit(float(w)) * F.coalesce(cond.cast("int"), F.lit(0))
        s = term if s is None else s + term
    return clip(s, lo, hi)


# Right-closed bands, as pd.cut; outside every band -> NULL.
# The age and BMI band edges and labels used by the premium model.
AGE_BANDS = ((0, 30, "18-30"), (30, 45, "31-45"), (45, 60, "46-60"), (60, 100, "60+"))
BMI_BANDS = ((0, 25, "normal"), (25, 30, "overweight"), (30, 35, "obese"), (35, 100, "severely_obese"))


def band(c, bands: Iterable[tuple[float, float, str]], ordinal: bool = False) -> Column:
    """Label (or 0-based ordinal) of the band ``(lo, hi]`` holding the value."""
    x = _c(c)
    out = None
    for i, (lo, hi, label) in enumerate(bands):
        val = F.lit(i) if ordinal else F.lit(label)
        cond = (x > F.lit(lo)) & (x <= F.lit(hi))
        out = F.when(cond, val) if out is None else out.when(cond, val)
    return out


# P10
def abs_error(actual, predicted) -> Column:
    return F.abs(_c(actual) - _c(predicted))


# P14
def percent(num, den, digits: int = 2, half_even: bool = False) -> Column:
    r = F.bround if half_even else F.round
    return r(F.lit(100.0) * _c(num) / _c(den), digits)


def fixed_decimal(c, digits: int = 2) -> Column:
    """Thousands-separated fixed-decimal text (HALF_EVEN, as Java's DecimalFormat)."""
    return F.format_number(_c(c), digits)


# Dummy columns with the first level dropped.
def dummies(df: DataFrame, col: str, levels: Sequence[str] | None = None, drop_first: bool = True,
            max_levels: int = 1000, prefix: str | None = None) -> DataFrame:
    """One 0/1 column per level (sorted), first dropped.

    The levels are a bounded driver-side list: fetched with a capped distinct
    query when not given, and refused above ``max_levels``.
    """
    if levels is None:
        rows = df.select(col).where(F.col(col).isNotNull()).distinct().orderBy(col).limit(max_levels + 1).collect()
        if len(rows) > max_levels:
            raise ValueError(f"{col} has more than {max_levels} levels; one-hot it as a vector instead")
        levels = [r[0] for r in rows]
    levels = sorted(levels)
    keep = levels[1:] if drop_first else levels
    p = prefix or col
    # NULL is no level: all zeros, as pandas does
    return df.select("*", *[F.coalesce((F.col(col) == F.lit(v)).cast("int"), F.lit(0)).alias(f"{p}_{v}")
                            for v in keep])

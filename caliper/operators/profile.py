"""Table profiling and aggregations.

Each function is one declarative aggregation plan; Spark does map-side
partial aggregation before every shuffle.  Totals used as denominators are
uncorrelated scalar subqueries (``DataFrame.scalar()``), not cross joins.
Results come back in long form ``(column, metric...)`` so that wide tables
do not produce wide rows.
"""

from __future__ import annotations

import math
from typing import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from caliper.functions.text import explode_tokens
from caliper.operators.quantiles import exact_quantiles
from caliper.operators.ranking import lookup_join, top_k


def _long(df_one_row: DataFrame, names: Sequence[str], fields: dict[str, callable]) -> DataFrame:
    """Stack per-column stats of a one-row aggregate into rows ``(column, stat...)``."""
    structs = [F.struct(F.lit(n).alias("column_name"), *[fn(n).alias(k) for k, fn in fields.items()])
               for n in names]
    return df_one_row.select(F.inline(F.array(*structs)))


def mean(c, decimals: int | None = None) -> Column:
    """Mean; with ``decimals`` (a column of fixed-decimal values such as prices) the sum is
    an exact decimal, so the result does not depend on the summation order
    (partitioning), cast to double once and divided by the count."""
    x = F.col(c) if isinstance(c, str) else c
    if decimals is None:
        return F.avg(x)
    return F.sum(x.cast(f"decimal(38,{decimals})")).cast("double") / F.count(x)


# A1 -------------------------------------------------------------------------
def table_summary(df: DataFrame, rate_col: str | None = None, mean_cols: Sequence[str] = (),
                  decimals: int | None = None) -> DataFrame:
    aggs = [F.count(F.lit(1)).alias("rows")]
    if rate_col:
        aggs.append(F.avg(F.col(rate_col).cast("double")).alias(f"{rate_col}_rate"))
    aggs += [mean(c, decimals).alias(f"mean_{c}") for c in mean_cols]
    return df.agg(*aggs)


# A2 / A3 / A20 -----------------------------------------------------------------
def describe(df: DataFrame, cols: Sequence[str], by: Sequence[str] = (), approx: bool = False,
             accuracy: int = 10000, decimals: int | None = None) -> DataFrame:
    """count, mean, sample std, min, 25/50/75 % (linear interpolation), max per column.

    Quartiles are exact and distributed (:func:`exact_quantiles`: no value
    map gathered in one task); ``approx=True`` uses ``percentile_approx``.
    """
    by = list(by)
    probs = [0.25, 0.5, 0.75]
    aggs = []
    for c in cols:
        x = F.col(c).cast("double")
        aggs += [F.count(x).alias(f"{c}__count"), mean(F.col(c), decimals).alias(f"{c}__mean"),
                 F.stddev_samp(x).alias(f"{c}__std"), F.min(x).alias(f"{c}__min"), F.max(x).alias(f"{c}__max")]
        if approx:
            aggs.append(F.percentile_approx(x, probs, accuracy).alias(f"{c}__q"))
    g = df.groupBy(*by).agg(*aggs) if by else df.agg(*aggs)
    fields = lambda c: [F.lit(c).alias("column_name"), F.col(f"{c}__count").alias("count"),
                        F.col(f"{c}__mean").alias("mean"), F.col(f"{c}__std").alias("std"),
                        F.col(f"{c}__min").alias("min"), F.col(f"{c}__max").alias("max")]
    if approx:
        structs = [F.struct(*fields(c), F.col(f"{c}__q")[0].alias("p25"), F.col(f"{c}__q")[1].alias("p50"),
                            F.col(f"{c}__q")[2].alias("p75")) for c in cols]
        return g.select(*by, F.inline(F.array(*structs)))
    base = g.select(*by, F.inline(F.array(*[F.struct(*fields(c)) for c in cols])))
    # all columns in one pipeline: stack to (by..., column_name, value), column_name is a group key
    stacked = df.select(*by, F.inline(F.array(*[F.struct(F.lit(c).alias("column_name"),
                                                         F.col(c).cast("double").alias("value"))
                                                for c in cols])))
    qs = exact_quantiles(stacked, "value", probs, by + ["column_name"])
    wide = qs.groupBy(*by, "column_name").agg(*[F.max(F.when(F.col("p") == p, F.col("value"))).alias(n)
                                                for p, n in zip(probs, ("p25", "p50", "p75"))])
    out = base.join(wide, on=by + ["column_name"], how="left")  # columns x groups rows on both sides
    return out.select(*by, "column_name", "count", "mean", "std", "min", "p25", "p50", "p75", "max")


def median(df: DataFrame, col: str, by: Sequence[str] = ()) -> DataFrame:
    return exact_quantiles(df, col, [0.5], by).select(*by, F.col("value").alias("median"))


# A4 / A5 / A23 --------------------------------------------------------------
def value_counts(df: DataFrame, col: str, normalize: bool = False, ascending: bool = False) -> DataFrame:
    """Counts per non-NULL value, largest first (ties by value); ``normalize`` gives shares."""
    x = df.where(F.col(col).isNotNull())
    out = x.groupBy(col).agg(F.count(F.lit(1)).alias("count"))
    if normalize:
        total = x.agg(F.count(F.lit(1))).scalar()
        out = out.select(col, "count", (F.col("count") / total).alias("share"))
    order = F.col("count").asc() if ascending else F.col("count").desc()
    return out.orderBy(order, F.col(col))


# A6 / A9 -------------------------------------------------------------------
def crosstab(df: DataFrame, a: str, b: str, b_values: Sequence | None = None,
             agg: Column | None = None) -> DataFrame:
    """Contingency table (``a`` rows, one column per ``b`` level), zero-filled.

    Pass ``b_values`` to avoid the extra distinct-values job and to fix the
    column order; ``agg`` replaces ``count`` (segment pivot A9: ``first(mae)``).
    """
    g = df.where(F.col(a).isNotNull() & F.col(b).isNotNull()).groupBy(a).pivot(b, list(b_values) if b_values else None)
    if agg is None:
        return g.count().na.fill(0).orderBy(a)
    return g.agg(agg).orderBy(a)


# A7 / A8 ------------------------------------------------------------------------
def grouped_mean(df: DataFrame, by: Sequence[str] | str, col: str, alias: str | None = None,
                 decimals: int | None = None) -> DataFrame:
    by = [by] if isinstance(by, str) else list(by)
    return df.groupBy(*by).agg(mean(col, decimals).alias(alias or f"mean_{col}"))


def segment_error(df: DataFrame, bands: Sequence[str], err_col: str = "abs_error",
                  worst: int | None = None) -> DataFrame:
    """Mean error and count per observed segment, worst first; NULL bands dropped."""
    cond = None
    for b in bands:
        c = F.col(b).isNotNull()
        cond = c if cond is None else cond & c
    out = (df.where(cond).groupBy(*bands)
           .agg(F.avg(err_col).alias("mae"), F.count(F.lit(1)).alias("count"))
           .orderBy(F.col("mae").desc(), *bands))
    return out.limit(worst) if worst else out


# A10 / A11 ------------------------------------------------------------------------
def null_counts(df: DataFrame) -> DataFrame:
    one = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in df.columns])
    return _long(one, df.columns, {"null_count": lambda n: F.col(n)})


def info(df: DataFrame) -> DataFrame:
    """``(column, dtype, non_null, rows)`` in one pass."""
    one = df.agg(F.count(F.lit(1)).alias("__rows"), *[F.count(F.col(c)).alias(c) for c in df.columns])
    types = dict((f.name, f.dataType.simpleString()) for f in df.schema.fields)
    structs = [F.struct(F.lit(c).alias("column_name"), F.lit(types[c]).alias("dtype"),
                        F.col(c).alias("non_null"), F.col("__rows").alias("rows")) for c in df.columns]
    return one.select(F.inline(F.array(*structs)))


# A12 / U3 ---------------------------------------------------------------------------
def distinct_count(df: DataFrame, cols: Sequence[str], approx: bool = False, rsd: float = 0.01) -> DataFrame:
    f = (lambda c: F.approx_count_distinct(c, rsd)) if approx else F.countDistinct
    one = df.agg(*[f(c).alias(c) for c in cols])
    return _long(one, cols, {"distinct": lambda n: F.col(n)})


# A13 / A14 ------------------------------------------------------------------------
def correlation_matrix(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Pearson r for every pair, pairwise-complete, in one aggregation; long ``(a, b, r)``."""
    pairs = [(a, b) for i, a in enumerate(cols) for b in cols[i:]]
    one = df.agg(*[F.corr(F.col(a).cast("double"), F.col(b).cast("double")).alias(f"{a}__{b}")
                   for a, b in pairs])
    structs = []
    for a, b in pairs:
        structs.append(F.struct(F.lit(a).alias("a"), F.lit(b).alias("b"), F.col(f"{a}__{b}").alias("r")))
        if a != b:
            structs.append(F.struct(F.lit(b).alias("a"), F.lit(a).alias("b"), F.col(f"{a}__{b}").alias("r")))
    return one.select(F.inline(F.array(*structs)))


def target_correlation(df: DataFrame, target: str, cols: Sequence[str]) -> DataFrame:
    one = df.agg(*[F.corr(F.col(c).cast("double"), F.col(target).cast("double")).alias(c) for c in cols])
    return (_long(one, cols, {"r": lambda n: F.col(n)})
            .orderBy(F.col("r").desc_nulls_last(), "column_name"))


# A15 / A16 ------------------------------------------------------------------------
def _bin_expr(x: Column, lo: Column, hi: Column, n: int) -> Column:
    """Equal-width bin 0..n-1, last bin closed; a zero-width range goes to bin 0."""
    raw = F.floor((x - lo) * F.lit(n) / (hi - lo))
    return F.when(hi == lo, F.lit(0)).otherwise(F.least(raw, F.lit(n - 1))).cast("int")


def histogram(df: DataFrame, col: str, bins: int = 10, by: str | None = None,
              shared_bins: bool = True, zero_fill: bool = True) -> DataFrame:
    """Counts per equal-width bin between min and max (NULLs ignored).

    With ``by``, bins are shared across classes (seaborn ``hue``); with
    ``shared_bins=False`` each class uses its own range (two ``hist`` calls).
    """
    x = df.where(F.col(col).isNotNull()).select(*([by] if by else []), F.col(col).cast("double").alias("x"))
    if by and not shared_bins:
        stats = x.groupBy(by).agg(F.min("x").alias("lo"), F.max("x").alias("hi"))
        y = x.join(stats, on=by)
        lo, hi = F.col("lo"), F.col("hi")
    else:
        st = x.agg(F.min("x").alias("lo"), F.max("x").alias("hi"))
        lo, hi = st.select("lo").scalar(), st.select("hi").scalar()
        y = x
    keys = ([by] if by else []) + ["bin"]
    y = y.withColumn("bin", _bin_expr(F.col("x"), lo, hi, bins))
    out = y.groupBy(*keys).agg(F.count(F.lit(1)).alias("count"), F.min(lo).alias("lo"), F.max(hi).alias("hi"))
    out = out.select(*keys, (F.col("lo") + (F.col("hi") - F.col("lo")) * F.col("bin") / bins).alias("bin_lo"),
                     (F.col("lo") + (F.col("hi") - F.col("lo")) * (F.col("bin") + 1) / bins).alias("bin_hi"),
                     "count")
    if zero_fill and not by:
        dom = df.sparkSession.range(bins).select(F.col("id").cast("int").alias("bin"))
        out = (dom.join(out, on="bin", how="left")
               .select("bin",
                       (F.lit(lo) + (F.lit(hi) - F.lit(lo)) * F.col("bin") / bins).alias("bin_lo"),
                       (F.lit(lo) + (F.lit(hi) - F.lit(lo)) * (F.col("bin") + 1) / bins).alias("bin_hi"),
                       F.coalesce(F.col("count"), F.lit(0)).alias("count")))
    return out.orderBy(*keys)


# A17 -----------------------------------------------------------------------------
def kde(df: DataFrame, col: str, grid_size: int = 200, cut: float = 3.0, binned: bool = False,
        n_bins: int = 2048) -> DataFrame:
    """Gaussian kernel density on a grid, Scott bandwidth ``std * n^(-1/5)``.

    ``binned=True`` deals each row's mass to the two nearest of ``n_bins + 1``
    points (linear binning): one aggregation of the rows, then a convolution of
    at most ``n_bins x grid_size`` terms.  That replaces the kernel by its linear
    interpolation between points a distance d apart, so no density is off by
    more than ``d^2 / (8 sqrt(2 pi) h^3)``.

    The grid spans ``[min - cut*h, max + cut*h]``.  Else each row adds its kernel to
    every grid point through ``posexplode`` of a ``grid_size`` array, combined
    map-side by the aggregation, so the cost is ``n * grid_size`` arithmetic and
    one bounded shuffle of ``grid_size`` rows per task.
    """
    x = df.where(F.col(col).isNotNull()).select(F.col(col).cast("double").alias("x"))
    st = x.agg(F.count("x").alias("n"), F.stddev_samp("x").alias("s"), F.min("x").alias("lo"),
               F.max("x").alias("hi"))
    n, s, lo, hi = (st.select(c).scalar() for c in ("n", "s", "lo", "hi"))
    h = s * F.pow(n.cast("double"), F.lit(-0.2))
    g0 = lo - F.lit(cut) * h
    step = (hi - lo + F.lit(2 * cut) * h) / F.lit(grid_size - 1)
    if binned:
        # a row's mass goes to the two nearest of n_bins + 1 points, by its distance from them: a count and a sum per
        # bin, then two points a bin; the kernel work is n_bins x grid_size whatever the number of rows
        bw = F.when(hi > lo, (hi - lo) / F.lit(n_bins)).otherwise(F.lit(1.0))
        at = x.select(((F.col("x") - lo) / bw).alias("u")).withColumn("b", F.least(F.floor("u"), F.lit(n_bins - 1)).cast("int"))
        bins = at.groupBy("b").agg(F.count(F.lit(1)).alias("c"), F.sum(F.col("u") - F.col("b")).alias("f"))
        point = lambda i, w: F.struct(i.alias("i"), w.alias("wt"))
        ends = F.array(point(F.col("b"), F.col("c") - F.col("f")), point(F.col("b") + 1, F.col("f")))
        points = bins.select(F.inline(ends)).groupBy("i").agg(F.sum("wt").alias("wt"))
        x = points.select((lo + F.col("i") * bw).alias("x"), "wt")
    else:
        x = x.withColumn("wt", F.lit(1.0))
    # the scalars become row columns first: subqueries may not sit inside a lambda
    y = x.select("x", "wt", h.alias("h"), g0.alias("g0"), step.alias("step"))
    grid = F.transform(F.sequence(F.lit(0), F.lit(grid_size - 1)),
                       lambda i: F.col("wt") * F.exp(F.lit(-0.5) * F.pow((F.col("g0") + i * F.col("step") - F.col("x"))
                                                                         / F.col("h"), 2)))
    dens = y.select(F.posexplode(grid).alias("i", "k")).groupBy("i").agg(F.sum("k").alias("ksum"))
    norm = n.cast("double") * h * F.lit(math.sqrt(2 * math.pi))
    return dens.select(F.col("i").cast("int").alias("i"), (g0 + F.col("i") * step).alias("x"),
                       (F.col("ksum") / norm).alias("density")).orderBy("i")


# A18 / A19 ----------------------------------------------------------------------------
def box_stats(df: DataFrame, col: str, by: str | None = None, whis: float = 1.5,
              max_broadcast_rows: int = 1_000_000) -> DataFrame:
    """Q1, median, Q3, whiskers at the last datum within ``whis`` IQR, outlier count per group."""
    keys = [by] if by else []
    x = df.where(F.col(col).isNotNull()).select(*keys, F.col(col).cast("double").alias("x"))
    eq = exact_quantiles(x, "x", [0.25, 0.5, 0.75], keys)
    q = eq.groupBy(*keys).agg(*[F.max(F.when(F.col("p") == p, F.col("value"))).alias(n)
                                for p, n in ((0.25, "q1"), (0.5, "median"), (0.75, "q3"))])
    q = q.withColumn("lo_fence", F.col("q1") - whis * (F.col("q3") - F.col("q1"))) \
         .withColumn("hi_fence", F.col("q3") + whis * (F.col("q3") - F.col("q1")))
    inside = (F.col("x") >= F.col("lo_fence")) & (F.col("x") <= F.col("hi_fence"))
    stats = [F.min(F.when(inside, F.col("x"))).alias("whisker_lo"),
             F.max(F.when(inside, F.col("x"))).alias("whisker_hi"),
             F.count_if(~inside).alias("outliers"), F.count(F.lit(1)).alias("n")]
    if keys:
        y = lookup_join(x, q, on=keys, max_broadcast_rows=max_broadcast_rows)
        return y.groupBy(*keys, "q1", "median", "q3").agg(*stats).orderBy(*keys)
    # one global group: the quartiles are scalar subqueries, no join needed
    y = x.select("x", *[q.select(c).scalar().alias(c) for c in ("q1", "median", "q3", "lo_fence", "hi_fence")])
    return y.groupBy("q1", "median", "q3").agg(*stats)


def letter_value_probs(depth: int) -> list[float]:
    """Tail probabilities 1/2, 1/4, 3/4, 1/8, 7/8, ... down to 2**-depth."""
    ps = [0.5]
    for k in range(2, depth + 1):
        ps += [2.0 ** -k, 1 - 2.0 ** -k]
    return ps


def letter_values(df: DataFrame, col: str, by: str | None = None, depth: int = 5) -> DataFrame:
    """Letter-value (boxen) quantiles per group, long ``(by, level, lower, upper)``."""
    keys = [by] if by else []
    ps = letter_value_probs(depth)
    eq = exact_quantiles(df, col, ps, keys)
    g = eq.groupBy(*keys).agg(F.array(*[F.max(F.when(F.col("p") == p, F.col("value"))) for p in ps]).alias("q"))
    structs = [F.struct(F.lit(1).alias("level"), F.col("q")[0].alias("lower"), F.col("q")[0].alias("upper"))]
    for k in range(2, depth + 1):
        i = 1 + 2 * (k - 2)
        structs.append(F.struct(F.lit(k).alias("level"), F.col("q")[i].alias("lower"), F.col("q")[i + 1].alias("upper")))
    return g.select(*keys, F.inline(F.array(*structs)))


# A21 / A22 / A25 ----------------------------------------------------------------------
def token_counts(df: DataFrame, tokens_col: str, by: str | None = None, top_n: int | None = None,
                 term_col: str = "term") -> DataFrame:
    """Token frequencies (overall or per category), top ``n`` each, ties by term.

    The explode and the partial count run map-side; with ``by`` the top-n is a
    ``WindowGroupLimit``, applied before and after the shuffle, so a category
    holding a third of the corpus never reaches one task with all its terms.
    """
    keys = ([by] if by else []) + [term_col]
    counts = (explode_tokens(df, [by] if by else [], tokens_col, term_col)
              .groupBy(*keys).agg(F.count(F.lit(1)).alias("count")))
    if top_n is None:
        return counts
    if by:
        return top_k(counts, by, [F.col("count").desc(), F.col(term_col)], top_n, rank_col="rank")
    return counts.orderBy(F.col("count").desc(), F.col(term_col)).limit(top_n)


# A24 ----------------------------------------------------------------------------------
def zero_filled_counts(df: DataFrame, col: str, k: int) -> DataFrame:
    """Counts over the known domain 0..k-1, missing values as 0."""
    dom = df.sparkSession.range(k).select(F.col("id").cast("int").alias(col))
    c = df.groupBy(F.col(col).cast("int").alias(col)).agg(F.count(F.lit(1)).alias("count"))
    return (dom.join(c, on=col, how="left")
            .select(col, F.coalesce(F.col("count"), F.lit(0)).alias("count")).orderBy(col))


# P18 ---------------------------------------------------------------------------------
def binned_scatter(df: DataFrame, x: str, y: str, hue: str, bins: int = 20) -> DataFrame:
    """2-D binned projection coloured by a category: counts per (bin_x, bin_y, hue)."""
    st = df.agg(F.min(x).alias("xl"), F.max(x).alias("xh"), F.min(y).alias("yl"), F.max(y).alias("yh"))
    xl, xh, yl, yh = (st.select(c).scalar() for c in ("xl", "xh", "yl", "yh"))
    return (df.where(F.col(x).isNotNull() & F.col(y).isNotNull())
            .select(_bin_expr(F.col(x).cast("double"), xl, xh, bins).alias("bin_x"),
                    _bin_expr(F.col(y).cast("double"), yl, yh, bins).alias("bin_y"), F.col(hue))
            .groupBy("bin_x", "bin_y", hue).agg(F.count(F.lit(1)).alias("count")))

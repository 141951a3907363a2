"""Exact quantiles by distributed radix selection.

Spark's exact ``percentile`` merges every partition's value->count map into
one final buffer, so a continuous column's distinct values all meet in one
task.  Here the same answer (linear interpolation between the order
statistics at ranks ``floor(p(n-1))`` and ``ceil(p(n-1))``, numpy's and
pandas' default) comes from rounds of bounded counters:

* A round deals the values into at most ``cells`` cells by an order-preserving
  map - first the logarithm of the size between the group's extremes, then
  straight lines between the extremes of a cell - and counts each cell, with
  its smallest and largest value, by a map-side combined aggregation.
* Running counts of a group's cells name the cell of every wanted rank.  A rank
  that is the first or last of its cell, or whose cell has one value, is found.
* Only the values of cells with open ranks go on to the next round, each of
  which splits them ``cells`` ways: two or three rounds for any usual column.

A row is neither copied per quantile nor shuffled; no table or task is larger
than ``cells`` counters a group and round.  What is left of a round (a row per
group and wanted rank) is written, so rounds do not nest, and the next round's
join with it is a broadcast as long as its files are small.
"""

from __future__ import annotations

import math
from typing import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from caliper.session import stored

CELLS = 1 << 16


def _log_size(v: Column) -> Column:
    """Non-decreasing in ``v`` and finite, whatever the double: NaN after infinity, as Spark orders them."""
    return (F.when(F.isnan(v), F.lit(712.0)).when(v == math.inf, F.lit(711.0)).when(v == -math.inf, F.lit(-711.0))
            .otherwise(F.signum(v) * F.log1p(F.abs(v))))


def _cell(x: Column, lo: Column, hi: Column, cells: int) -> Column:
    """Cell of ``x`` between ``lo`` (the first) and ``hi`` (the last): rounding keeps the order."""
    return F.when(hi > lo, F.floor((x - lo) / (hi - lo) * F.lit(float(cells - 1)))).otherwise(F.lit(0)).cast("int")


def _beside(x: DataFrame, small: DataFrame, by: list[str]) -> DataFrame:
    """``x`` with the rows of its group in ``small`` (null is a group of its own); without groups, ``small`` is a few rows."""
    if not by:
        return x.withColumn("_one", F.lit(1)).join(F.broadcast(small.withColumn("_one", F.lit(1))), "_one").drop("_one")
    s = small.withColumnsRenamed({c: f"_by{i}" for i, c in enumerate(by)})
    on = [x[c].eqNullSafe(s[f"_by{i}"]) for i, c in enumerate(by)]
    return x.join(s, on).drop(*[f"_by{i}" for i in range(len(by))])


def exact_quantiles(df: DataFrame, col: str, probs: Sequence[float], by: Sequence[str] = (), cells: int = CELLS) -> DataFrame:
    """Long ``(by..., p, value)``; NULLs ignored; groups with no values are absent."""
    by, probs = list(by), [float(p) for p in probs]
    x = df.where(F.col(col).isNotNull()).select(*by, (F.col(col).cast("double") + F.lit(0.0)).alias("v"))
    y = _log_size(F.col("v"))
    groups = stored(x.groupBy(*by).agg(F.count(F.lit(1)).alias("n"), F.min(y).alias("y_lo"), F.max(y).alias("y_hi")).where("n > 0"), "quantile-groups")
    rank = lambda p, f: f(F.lit(p) * (F.col("n") - 1)).cast("long")
    ranks = F.array_distinct(F.array(*[rank(p, f) for p in probs for f in (F.floor, F.ceil)]))
    dealt = _beside(x, groups.withColumn("ranks", ranks), by).select(
        *by, F.lit(0).cast("long").alias("below"), "ranks", _cell(y, F.col("y_lo"), F.col("y_hi"), cells).alias("cell"), "v")
    found = []
    while True:
        # ``below`` rows of the group precede those dealt; it also tells a group's open cells apart
        count = dealt.groupBy(*by, "below", "cell").agg(F.count(F.lit(1)).alias("k"), F.min("v").alias("lo"), F.max("v").alias("hi"), F.first("ranks").alias("ranks"))
        w = Window.partitionBy(*by, "below").orderBy("cell").rowsBetween(Window.unboundedPreceding, 0)       # at most ``cells`` rows
        count = count.withColumn("below", F.col("below") + F.sum("k").over(w) - F.col("k"))
        last = F.col("below") + F.col("k") - 1
        here = F.filter("ranks", lambda r: (r >= F.col("below")) & (r <= last))
        value = F.when((F.col("r") == F.col("below")) | (F.col("lo") == F.col("hi")), F.col("lo")).when(F.col("r") == last, F.col("hi"))
        got = stored(count.select(*by, "below", "k", "lo", "hi", F.explode(here).alias("r")).select(
            *by, "below", "lo", "hi", "r", value.alias("value")), "quantile-ranks")
        found.append(got.where("value is not null").select(*by, "r", "value"))
        todo = got.where("value is null").groupBy(*by, "below", "lo", "hi").agg(F.collect_set("r").alias("ranks"))
        if todo.isEmpty():
            break
        v, lo, hi = F.col("v"), F.col("lo"), F.col("hi")
        # a cell whose width is no finite number (it may end in infinity or NaN) is split by the logarithm once more
        cell = F.when(F.abs(hi - lo) < math.inf, _cell(v, lo, hi, cells)).otherwise(_cell(y, _log_size(lo), _log_size(hi), cells))
        dealt = _beside(x, todo, by).where((v >= lo) & (v <= hi)).select(*by, "below", "ranks", cell.alias("cell"), "v")
    at = found[0]
    for f in found[1:]:
        at = at.unionByName(f)
    at = at.groupBy(*by).agg(F.map_from_entries(F.collect_list(F.struct("r", "value"))).alias("at"))         # two ranks a quantile at most
    pos = lambda p: F.lit(p) * (F.col("n") - 1)
    low, high = (lambda p: F.element_at("at", rank(p, F.floor))), (lambda p: F.element_at("at", rank(p, F.ceil)))
    # between equal neighbours nothing is interpolated (infinities would give NaN)
    between = lambda p: F.when(low(p) == high(p), low(p)).otherwise(low(p) + (high(p) - low(p)) * (pos(p) - F.floor(pos(p))))
    values = F.array(*[F.struct(F.lit(p).alias("p"), between(p).alias("value")) for p in probs])
    return _beside(at, groups.select(*by, "n"), by).select(*by, F.inline(values))

"""Distributed exact quantiles against numpy's linear interpolation."""

import math
import random

import numpy as np
from pyspark.sql import functions as F

from caliper.operators.quantiles import exact_quantiles


def test_exact_quantiles_grouped_and_global(spark):
    rnd = random.Random(3)
    rows = [(rnd.choice("abc"), float(rnd.randint(0, 50)) if rnd.random() < 0.5 else rnd.random() * 100)
            for _ in range(3000)]
    rows += [("d", 7.0), ("e", None), (None, 2.0), (None, 3.0), *[("f", x) for x in (-1e308, 3.0, float("inf"))]]
    df = spark.createDataFrame(rows, "g string, x double")
    probs = [0.25, 0.5, 0.75, 0.1, 0.99, 0.0, 1.0]
    got = {(r.g, r.p): r.value for r in exact_quantiles(df, "x", probs, by=["g"], cells=7).collect()}
    for g in "abcd":
        xs = np.array([x for gg, x in rows if gg == g and x is not None])
        for p in probs:
            assert abs(got[(g, p)] - np.quantile(xs, p)) < 1e-9
    assert got[("f", 0.5)] == 3.0 and got[(None, 0.5)] == 2.5
    assert not any(k[0] == "e" for k in got)  # a group with only NULLs has no quantiles
    rows, df = rows[:-3], df.where("g is null or g <> 'f'")
    allx = np.array([x for _, x in rows if x is not None])
    glob = {r.p: r.value for r in exact_quantiles(df, "x", probs, cells=7).collect()}
    for p in probs:
        assert abs(glob[p] - np.quantile(allx, p)) < 1e-9


def test_exact_quantiles_of_awkward_values(spark):
    """Extremes, tiny differences, both zeros, infinities and NaN (which follows infinity)."""
    values = [1e308, -1e308, 5e-324, -5e-324, 0.0, -0.0, 1.0, math.nextafter(1.0, 2), math.nextafter(1.0, 0), math.inf, -math.inf, math.nan, 1e-300, 2e-300]
    df = spark.createDataFrame([(v,) for v in values], "x double")
    n = len(values)
    got = [r.value for r in exact_quantiles(df, "x", [i / (n - 1) for i in range(n)], cells=3).orderBy("p").collect()]
    ranked = sorted(values[:-3] + values[-2:], key=lambda v: v) + [math.nan]
    # p * (n - 1) may miss the integer by an ulp, which only moves a value towards its neighbour
    for i in (0, n - 1):
        assert got[i] == ranked[i] or math.isnan(ranked[i]) and math.isnan(got[i])
    assert exact_quantiles(df, "x", [0.5], cells=2).first().value == (ranked[6] + ranked[7]) / 2
    assert exact_quantiles(df.limit(0), "x", [0.5]).count() == 0


def test_no_row_is_copied_per_quantile(spark):
    df = spark.range(20_000).select((F.col("id") % 3).alias("g"), F.pmod(F.xxhash64("id"), F.lit(10 ** 12)).cast("double").alias("x"))
    want = df.toPandas().groupby("g").x.quantile([0.1, 0.5, 0.9])
    got = {(r.g, r.p): r.value for r in exact_quantiles(df, "x", [0.1, 0.5, 0.9], by=["g"], cells=64).collect()}
    assert all(abs(got[k] - v) < 1e-3 for k, v in want.items()) and len(got) == 9

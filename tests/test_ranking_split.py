"""Hash-order primitives and splits against brute force; properties of splits, folds, undersampling."""

import hashlib
import math
import random

from pyspark.sql import functions as F

from caliper.operators import ranking as RK
from caliper.operators import split as S


def _h(k, seed=42):
    return hashlib.md5(f"{k}|{seed}".encode()).hexdigest()


def _df(spark, n=2000, classes=3):
    rnd = random.Random(3)
    rows = [(i, rnd.randrange(classes) if rnd.random() > 0.05 else classes) for i in range(n)]
    return rows, spark.createDataFrame(rows, "k long, c int")


def test_top_fraction_exact(spark):
    rows, df = _df(spark)
    got = {r.k for r in RK.top_fraction(df, "k", fraction=0.2, class_col="c", digits=1).where("selected").collect()}
    exp = set()
    for c in {c for _, c in rows}:
        ks = sorted((k for k, cc in rows if cc == c), key=lambda k: (_h(k), k))
        exp |= set(ks[: math.ceil(0.2 * len(ks))])
    assert got == exp


def test_top_fraction_needs_no_shuffle_of_rows(spark):
    rows, df = _df(spark)
    df = df.withColumn("c", F.when(F.col("c") < 3, F.col("c")))                  # a null class
    out = RK.top_fraction(df, "k", fraction=0.2, class_col="c", digits=1)
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "Exchange hashpartitioning" not in plan and "Window" not in plan
    exp = set()
    for c in range(4):
        ks = sorted((k for k, cc in rows if cc == c), key=lambda k: (_h(k), k))
        exp |= set(ks[: math.ceil(0.2 * len(ks))])
    assert {r.k for r in out.where("selected").collect()} == exp


def test_top_fraction_of_nothing(spark):
    rows, df = _df(spark, 50)
    assert RK.top_fraction(df, "k", n=0).where("selected").count() == 0
    assert RK.top_fraction(df, "k", n=10 ** 6).where("selected").count() == 50
    assert RK.top_fraction(df.limit(0), "k", fraction=0.5).count() == 0
    twice = df.unionByName(df)
    assert RK.top_fraction(twice, "k", n=1).where("selected").count() == 2        # equal keys go together


def test_hash_rank_exact(spark):
    rows, df = _df(spark, 500)
    got = {r.k: r.rank for r in RK.hash_rank(df, "k", class_col="c", digits=2).collect()}
    for c in {c for _, c in rows}:
        ks = sorted((k for k, cc in rows if cc == c), key=lambda k: (_h(k), k))
        for i, k in enumerate(ks):
            assert got[k] == i


def test_prefix_sums_match_cumsum(spark):
    rnd = random.Random(5)
    vals = sorted({round(rnd.random() * 100, 3) for _ in range(800)})
    rows = [(v, rnd.randrange(5)) for v in vals]
    df = spark.createDataFrame(rows, "x double, w long")
    got = {r.x: r.cum_w for r in RK.prefix_sums(df, "x", ["w"], n_buckets=7).collect()}
    run = 0
    for v, w in rows:
        run += w
        assert got[v] == run


def test_split_disjoint_exhaustive_and_stratified(spark):
    rows, df = _df(spark)
    out = S.train_test_split(df, "k", 0.2, 42, stratify="c")
    assert out.count() == len(rows) and out.select("k").distinct().count() == len(rows)
    counts = {(r.split, r.c): r["count"] for r in S.split_counts(out, "c").collect()}
    for c in {c for _, c in rows}:
        n = sum(1 for _, cc in rows if cc == c)
        assert counts[("test", c)] == math.ceil(0.2 * n)
        assert counts.get(("train", c), 0) == n - math.ceil(0.2 * n)


def test_folds_balanced(spark):
    rows, df = _df(spark)
    f = S.stratified_folds(df, "k", "c", k=5)
    g = f.groupBy("c", "fold").count().collect()
    for c in {c for _, c in rows}:
        sizes = [r["count"] for r in g if r.c == c]
        assert max(sizes) - min(sizes) <= 1


def test_undersample_ratio(spark):
    rows = [(i, 1 if i % 50 == 0 else 0) for i in range(3000)]
    df = spark.createDataFrame(rows, "k long, y int")
    out = S.undersample(df, "k", "y", minority=1, ratio=5)
    n_min = sum(1 for _, y in rows if y == 1)
    c = {r.y: r["count"] for r in out.groupBy("y").count().collect()}
    assert c[1] == n_min and c[0] == 5 * n_min


def test_class_weights(spark):
    df = spark.createDataFrame([(0,)] * 90 + [(1,)] * 10, "y int")
    w = {r.y: r.weight for r in S.balanced_class_weights(df, "y").collect()}
    assert abs(w[0] - 100 / (2 * 90)) < 1e-12 and abs(w[1] - 100 / (2 * 10)) < 1e-12


def test_lookup_join_without_a_bound(spark):
    big = spark.createDataFrame([(i, "hot" if i % 3 else f"t{i}") for i in range(300)], "k int, term string")
    small = spark.createDataFrame([("hot", 1.0)] + [(f"t{i}", 2.0) for i in range(0, 300, 3)], "term string, v double")
    a = RK.lookup_join(big, small, "term", max_broadcast_rows=0)
    b = big.join(small, "term")
    assert sorted(a.select("k", "v").collect()) == sorted(b.select("k", "v").collect())


def test_explode_tokens_keeps_rows_and_skips_empty(spark):
    from caliper.functions.text import explode_tokens
    df = spark.createDataFrame([(1, ["a", "b", "a"]), (2, []), (3, None)], "k int, t array<string>")
    got = sorted((r.k, r.pos, r.term) for r in explode_tokens(df, ["k"], "t", "term", pos="pos").collect())
    assert got == [(1, 0, "a"), (1, 1, "b"), (1, 2, "a")]


def test_stratified_split_with_a_one_row_class(spark):
    rows = [(i, 0) for i in range(20)] + [(100, 1)]
    df = spark.createDataFrame(rows, "k long, c int")
    out = {r.k: r.split for r in S.train_test_split(df, "k", 0.2, 42, stratify="c").collect()}
    assert out[100] == "test"  # ceil(0.2 * 1) = 1
    assert sum(1 for k, s in out.items() if s == "test" and k != 100) == 4

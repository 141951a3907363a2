"""Metrics: the golden confusion-matrix fixture, curves against brute force, edge frames."""

import itertools
import random

import pytest
from pyspark.sql import functions as F

from caliper.operators import evaluate as E


def _golden(spark):
    # TN 954, FP 12, FN 14, TP 135 -> 1,115 (label, prediction) rows
    rows = [(0, 0)] * 954 + [(0, 1)] * 12 + [(1, 0)] * 14 + [(1, 1)] * 135
    return spark.createDataFrame(rows, "label int, pred int")


def test_golden_report(spark):
    rep = {(r.label, r.metric): r.value for r in
           E.classification_report(_golden(spark), "label", "pred", names={0: "ham", 1: "spam"}).collect()}
    expect = {("ham", "precision"): .986, ("ham", "recall"): .988, ("ham", "f1-score"): .987,
              ("spam", "precision"): .918, ("spam", "recall"): .906, ("spam", "f1-score"): .912,
              ("macro avg", "precision"): .952, ("macro avg", "recall"): .947, ("macro avg", "f1-score"): .949,
              ("weighted avg", "precision"): .977, ("weighted avg", "recall"): .977,
              ("weighted avg", "f1-score"): .977, ("accuracy", "accuracy"): .977}
    for k, v in expect.items():
        assert round(rep[k], 3) == v, k
    assert rep[("ham", "support")] == 966 and rep[("spam", "support")] == 149


def test_golden_confusion_and_f1(spark):
    cm = {(r.actual, r.predicted): r["count"] for r in
          E.confusion_matrix(_golden(spark), "label", "pred", labels=[0, 1]).collect()}
    assert cm == {(0, 0): 954, (0, 1): 12, (1, 0): 14, (1, 1): 135}
    m = E.binary_metrics(_golden(spark), "label", "pred").first()
    assert round(m.f1, 3) == .912 and round(m.accuracy, 3) == .977


def _scored(spark, n=300, seed=1, ties=True):
    rnd = random.Random(seed)
    rows = []
    for i in range(n):
        s = round(rnd.random(), 1 if ties else 6)
        y = 1 if rnd.random() < 0.3 + 0.4 * s else 0
        rows.append((i, y, s))
    return rows, spark.createDataFrame(rows, "k int, label int, score double")


def test_roc_auc_matches_pairwise(spark):
    rows, df = _scored(spark)
    pos = [s for _, y, s in rows if y == 1]
    neg = [s for _, y, s in rows if y == 0]
    brute = sum(1.0 if p > q else 0.5 if p == q else 0.0 for p, q in itertools.product(pos, neg)) / (len(pos) * len(neg))
    got = E.roc_auc(df, "label", "score", n_buckets=4).first()[0]
    assert got == pytest.approx(brute, abs=1e-12)


def test_average_precision_and_pr_curve(spark):
    rows, df = _scored(spark, ties=False)
    srt = sorted(rows, key=lambda r: -r[2])
    P = sum(y for _, y, _ in rows)
    ap, tp = 0.0, 0
    for i, (_, y, _) in enumerate(srt, 1):
        if y:
            tp += 1
            ap += (1 / P) * tp / i
    assert E.average_precision(df, "label", "score", n_buckets=8).first()[0] == pytest.approx(ap, abs=1e-12)
    curve = E.pr_curve(df, "label", "score").collect()
    assert max(r.recall for r in curve) == 1.0


def test_threshold_sweep_brute_force(spark):
    rows, df = _scored(spark, ties=False)
    import numpy as np
    ths = np.linspace(0.01, 0.99, 100)
    best = None
    for t in ths:
        tp = sum(1 for _, y, s in rows if y == 1 and s >= t)
        fp = sum(1 for _, y, s in rows if y == 0 and s >= t)
        fn = sum(1 for _, y, s in rows if y == 1 and s < t)
        f1 = 0.0 if 2 * tp + fp + fn == 0 else 2 * tp / (2 * tp + fp + fn)
        if best is None or f1 > best[1]:
            best = (t, f1)
    sw = E.threshold_sweep(df, "label", "score", 0.01, 0.99, 100)
    got = E.best_threshold(sw).first()
    assert got.threshold == pytest.approx(best[0]) and got.f1 == pytest.approx(best[1])


def test_sweep_default_when_no_positive_prediction(spark):
    df = spark.createDataFrame([(0, 0.001), (1, 0.002)], "label int, score double")
    sw = E.threshold_sweep(df, "label", "score", 0.01, 0.9, 200)
    got = E.best_threshold(sw, default=(0.5, 0.0)).first()
    assert (got.threshold, got.f1) == (0.5, 0.0)


def test_all_tied_scores_auc_half(spark):
    df = spark.createDataFrame([(i % 2, 0.7) for i in range(10)], "label int, score double")
    assert E.roc_auc(df, "label", "score").first()[0] == pytest.approx(0.5)


def test_regression_metrics(spark):
    df = spark.createDataFrame([(1.0, 1.5), (2.0, 2.0), (3.0, 2.0)], "y double, p double")
    r = E.regression_metrics(df, "y", "p").first()
    assert r.mae == pytest.approx(0.5)
    assert r.rmse == pytest.approx(((0.25 + 0 + 1) / 3) ** 0.5)
    assert r.r2 == pytest.approx(1 - 1.25 / 2.0)


def test_single_class_and_no_positive_prediction(spark):
    df = spark.createDataFrame([(0, 0)] * 5, "label int, pred int")
    m = E.binary_metrics(df, "label", "pred").first()
    assert (m.tp, m.fp, m.fn, m.tn) == (0, 0, 0, 5) and m.f1 == 0.0 and m.precision == 0.0 and m.accuracy == 1.0
    rep = {(r.label, r.metric): r.value for r in E.classification_report(df, "label", "pred").collect()}
    assert rep[("1", "support")] == 0.0 and rep[("1", "f1-score")] == 0.0 and rep[("0", "recall")] == 1.0
    auc = E.roc_auc(spark.createDataFrame([(0, 0.3), (0, 0.9)], "label int, score double"), "label", "score")
    assert auc.first()[0] is None  # undefined with one class: NULL, not a number

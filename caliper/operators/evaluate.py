"""Evaluation over a scored frame.

Inputs are ``(label, prediction)`` or ``(label, score)`` columns.  Every
metric is one aggregation; curves group rows by score first (ties collapse
into one point) and take running sums with the distributed prefix sum, so
neither a score order nor a class ever sits in a single task.  Threshold
sweeps bucket each score once instead of re-scanning per threshold.
"""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from caliper.session import stored
from caliper.operators.ranking import prefix_sums


# E1-E3 ------------------------------------------------------------------------------
def regression_metrics(df: DataFrame, actual: str, predicted: str) -> DataFrame:
    """MAE, RMSE and R^2 in one pass (``R^2 = 1 - SSE / (n * var_pop(y))``)."""
    e = F.col(actual) - F.col(predicted)
    return df.agg(F.avg(F.abs(e)).alias("mae"), F.sqrt(F.avg(e * e)).alias("rmse"),
                  (F.lit(1.0) - F.sum(e * e) / (F.count(F.lit(1)) * F.var_pop(actual))).alias("r2"),
                  F.count(F.lit(1)).alias("n"))


# E4 / E5 / E7 -----------------------------------------------------------------------
def _counts(label: Column, pred: Column, positive=1):
    y, p = label == F.lit(positive), pred == F.lit(positive)
    return (F.count_if(y & p).alias("tp"), F.count_if(~y & p).alias("fp"),
            F.count_if(y & ~p).alias("fn"), F.count_if(~y & ~p).alias("tn"))


def f1_expr(tp: Column, fp: Column, fn: Column) -> Column:
    """F1 of the positive class, 0 when undefined."""
    d = F.lit(2) * tp + fp + fn
    return F.when(d == 0, F.lit(0.0)).otherwise(F.lit(2.0) * tp / d)


def binary_metrics(df: DataFrame, label: str, pred: str, by: Sequence[str] = (), positive=1) -> DataFrame:
    """tp/fp/fn/tn, accuracy, precision, recall and F1 of the positive class (optionally per group)."""
    g = df.groupBy(*by) if by else df.groupBy()
    c = g.agg(*_counts(F.col(label), F.col(pred), positive))
    tp, fp, fn, tn = (F.col(x) for x in ("tp", "fp", "fn", "tn"))
    n = tp + fp + fn + tn
    return c.select(*by, "tp", "fp", "fn", "tn",
                    ((tp + tn) / n).alias("accuracy"),
                    F.when(tp + fp == 0, 0.0).otherwise(tp / (tp + fp)).alias("precision"),
                    F.when(tp + fn == 0, 0.0).otherwise(tp / (tp + fn)).alias("recall"),
                    f1_expr(tp, fp, fn).alias("f1"))


def confusion_matrix(df: DataFrame, label: str, pred: str, labels: Sequence | None = None,
                     names: dict | None = None) -> DataFrame:
    """Long ``(actual, predicted, count)`` zero-filled over the label domain."""
    c = df.groupBy(F.col(label).alias("actual"), F.col(pred).alias("predicted")).agg(
        F.count(F.lit(1)).alias("count"))
    if labels is None:
        return c
    # the label domain is a bounded, caller-given list; the counts come from the data
    at, pt = c.schema["actual"].dataType, c.schema["predicted"].dataType
    dom = df.sparkSession.createDataFrame([(a, p) for a in labels for p in labels], ["actual", "predicted"])
    dom = dom.select(F.col("actual").cast(at), F.col("predicted").cast(pt))
    out = dom.join(c, on=["actual", "predicted"], how="left").select(
        "actual", "predicted", F.coalesce("count", F.lit(0)).alias("count"))
    if names:
        m = F.create_map(*[x for k, v in names.items() for x in (F.lit(k), F.lit(v))])
        out = out.withColumn("actual", m[F.col("actual")]).withColumn("predicted", m[F.col("predicted")])
    return out


# E6 ----------------------------------------------------------------------------------
def classification_report(df: DataFrame, label: str, pred: str, labels: Sequence = (0, 1),
                          names: dict | None = None) -> DataFrame:
    """Long ``(label, metric, value)``: precision/recall/f1/support per class, accuracy, macro and weighted avg."""
    aggs = [F.count(F.lit(1)).alias("n"), F.count_if(F.col(label) == F.col(pred)).alias("correct")]
    for i, c in enumerate(labels):
        y, p = F.col(label) == F.lit(c), F.col(pred) == F.lit(c)
        aggs += [F.count_if(y & p).alias(f"tp{i}"), F.count_if(p).alias(f"pp{i}"), F.count_if(y).alias(f"s{i}")]
    one = df.agg(*aggs)
    rows = []
    for i, c in enumerate(labels):
        tp, pp, s = F.col(f"tp{i}"), F.col(f"pp{i}"), F.col(f"s{i}")
        prec = F.when(pp == 0, 0.0).otherwise(tp / pp)
        rec = F.when(s == 0, 0.0).otherwise(tp / s)
        f1 = F.when(prec + rec == 0, 0.0).otherwise(2 * prec * rec / (prec + rec))
        name = str(names.get(c, c)) if names else str(c)
        rows.append((name, prec, rec, f1, s))
    structs = []
    for name, prec, rec, f1, s in rows:
        for m, v in (("precision", prec), ("recall", rec), ("f1-score", f1), ("support", s.cast("double"))):
            structs.append(F.struct(F.lit(name).alias("label"), F.lit(m).alias("metric"), v.cast("double").alias("value")))
    k = len(rows)
    n = F.col("n")
    for avg_name, w in (("macro avg", None), ("weighted avg", True)):
        for j, m in enumerate(("precision", "recall", "f1-score")):
            if w:
                v = sum((r[1 + j] * r[4] for r in rows), F.lit(0.0)) / n
            else:
                v = sum((r[1 + j] for r in rows), F.lit(0.0)) / k
            structs.append(F.struct(F.lit(avg_name).alias("label"), F.lit(m).alias("metric"), v.cast("double").alias("value")))
        structs.append(F.struct(F.lit(avg_name).alias("label"), F.lit("support").alias("metric"), n.cast("double").alias("value")))
    structs.append(F.struct(F.lit("accuracy").alias("label"), F.lit("accuracy").alias("metric"),
                            (F.col("correct") / n).cast("double").alias("value")))
    return one.select(F.inline(F.array(*structs)))


# Curves --------------------------------------------------------------------------------
def score_counts(df: DataFrame, label: str, score: str, positive=1) -> DataFrame:
    """``(score, pos, neg)`` per distinct score: the input of every curve."""
    y = F.col(label) == F.lit(positive)
    return (df.where(F.col(score).isNotNull())
            .groupBy((F.col(score).cast("double") + F.lit(0.0)).alias("score"))
            .agg(F.count_if(y).alias("pos"), F.count_if(~y).alias("neg")))


def _cumulated(df: DataFrame, label: str, score: str, positive=1, n_buckets: int | None = None) -> DataFrame:
    """Per distinct score: counts at or above it (``tps``, ``fps``) and totals ``P``, ``N``."""
    # (score, pos, neg) is read by the quantiles, the totals and the running sums: written once
    # (one row per distinct score), so nothing stays in executor storage
    sc = stored(score_counts(df, label, score, positive), "score-counts")
    cum = prefix_sums(sc, "score", ["pos", "neg"], n_buckets=n_buckets)
    tot = sc.agg(F.sum("pos").alias("P"), F.sum("neg").alias("N"))
    P, N = tot.select("P").scalar(), tot.select("N").scalar()
    return cum.select("score", "pos", "neg", (P - F.col("cum_pos") + F.col("pos")).alias("tps"),
                      (N - F.col("cum_neg") + F.col("neg")).alias("fps"),
                      (F.col("cum_neg") - F.col("neg")).alias("neg_below"),
                      P.alias("P"), N.alias("N"))


def roc_auc(df: DataFrame, label: str, score: str, positive=1, n_buckets: int | None = None) -> DataFrame:
    """Exact, tie-aware ROC-AUC: ``sum_s pos_s * (neg_below_s + neg_s / 2) / (P * N)``."""
    c = _cumulated(df, label, score, positive, n_buckets)
    return c.agg((F.sum(F.col("pos") * (F.col("neg_below") + F.col("neg") / 2.0))
                  / (F.first("P").cast("double") * F.first("N"))).alias("roc_auc"))


def roc_curve(df: DataFrame, label: str, score: str, positive=1, n_buckets: int | None = None) -> DataFrame:
    """``(threshold, fpr, tpr)`` at every distinct score (no intermediate points dropped)."""
    c = _cumulated(df, label, score, positive, n_buckets)
    return c.select(F.col("score").alias("threshold"), (F.col("fps") / F.col("N")).alias("fpr"),
                    (F.col("tps") / F.col("P")).alias("tpr"))


def average_precision(df: DataFrame, label: str, score: str, positive=1, n_buckets: int | None = None) -> DataFrame:
    """Step-wise AP ``sum_n (R_n - R_{n-1}) P_n`` (not the trapezoidal area)."""
    c = _cumulated(df, label, score, positive, n_buckets)
    return c.agg(F.sum((F.col("pos") / F.col("P")) * (F.col("tps") / (F.col("tps") + F.col("fps"))))
                 .alias("average_precision"))


def pr_curve(df: DataFrame, label: str, score: str, positive=1, n_buckets: int | None = None) -> DataFrame:
    """``(threshold, precision, recall)`` from the top score down to the first threshold with full recall."""
    c = _cumulated(df, label, score, positive, n_buckets)
    full = c.where(F.col("tps") == F.col("P")).agg(F.max("score")).scalar()
    return c.where(F.col("score") >= full).select(
        F.col("score").alias("threshold"), (F.col("tps") / (F.col("tps") + F.col("fps"))).alias("precision"),
        (F.col("tps") / F.col("P")).alias("recall"))


# E12 / E13 / E14 ----------------------------------------------------------------------
def threshold_sweep(df: DataFrame, label: str, score: str, lo: float, hi: float, num: int,
                    positive=1) -> DataFrame:
    """F1 at every threshold of ``linspace(lo, hi, num)``, predicting positive when ``score >= t``.

    Each score is bucketed once to the last threshold not above it; counts per
    bucket (at most ``num + 1`` rows) are suffix-summed.  That bounded table is
    the only thing a single-partition window touches.
    """
    step = (hi - lo) / (num - 1)
    t_of = lambda i: F.when(i == F.lit(num - 1), F.lit(float(hi))).otherwise(F.lit(float(lo)) + i * F.lit(step))
    s = F.col(score).cast("double")
    b0 = F.least(F.greatest(F.floor((s - F.lit(lo)) / F.lit(step)), F.lit(-1)), F.lit(num - 1)).cast("int")
    x = df.where(F.col(score).isNotNull()).select((F.col(label) == F.lit(positive)).alias("y"), s.alias("s"),
                                                  b0.alias("b0"))
    # exact correction at bucket edges: last i with t_i <= s
    b = (F.when((F.col("b0") >= 0) & (t_of(F.col("b0")) > F.col("s")), F.col("b0") - 1)
         .when((F.col("b0") < num - 1) & (t_of(F.col("b0") + 1) <= F.col("s")), F.col("b0") + 1)
         .otherwise(F.col("b0")))
    per = x.groupBy(b.alias("b")).agg(F.count_if("y").alias("pos"), F.count_if(~F.col("y")).alias("neg"))
    # all bounded by num + 1 rows: the positives total comes from the bucket table
    # itself (bucket -1 holds scores below the first threshold), not from a rescan
    P = per.agg(F.coalesce(F.sum("pos"), F.lit(0))).scalar()  # Spark reuses the bucket aggregate's exchange
    dom = df.sparkSession.range(num).select(F.col("id").cast("int").alias("b"))
    w = Window.orderBy(F.col("b").desc()).rowsBetween(Window.unboundedPreceding, 0)
    sw = (dom.join(per, on="b", how="left").na.fill(0, ["pos", "neg"])
          .select("b", F.sum("pos").over(w).alias("tp"), F.sum("neg").over(w).alias("fp")))
    tp, fp = F.col("tp"), F.col("fp")
    fn = P - tp
    return sw.select(F.col("b").alias("i"), t_of(F.col("b")).alias("threshold"), "tp", "fp", fn.alias("fn"),
                     F.when(tp + fp == 0, 0.0).otherwise(tp / (tp + fp)).alias("precision"),
                     F.when(tp + fn == 0, 0.0).otherwise(tp / (tp + fn)).alias("recall"),
                     f1_expr(tp, fp, fn).alias("f1"))


def best_threshold(sweep: DataFrame, default: tuple[float, float] | None = None) -> DataFrame:
    """First maximum of F1 (lowest threshold).  With ``default``, a strict improvement over
    ``default[1]`` is required, else ``default`` is returned (the fraud sweep's rule)."""
    best = sweep.agg(F.min_by(F.struct("threshold", "f1"), F.struct(-F.col("f1"), F.col("i"))).alias("b"))
    out = best.select(F.col("b.threshold").alias("threshold"), F.col("b.f1").alias("f1"))
    if default is None:
        return out
    t0, f0 = default
    better = F.col("f1") > F.lit(float(f0))
    return out.select(F.when(better, F.col("threshold")).otherwise(F.lit(float(t0))).alias("threshold"),
                      F.when(better, F.col("f1")).otherwise(F.lit(float(f0))).alias("f1"))


def f1_at_threshold(df: DataFrame, label: str, score: str, t, positive=1) -> DataFrame:
    """F1 with ``score >= t``; ``t`` may be a number or a scalar Column from another model's sweep."""
    tc = F.lit(t) if isinstance(t, (int, float)) else t
    p = (F.col(score) >= tc)
    y = F.col(label) == F.lit(positive)
    c = df.agg(F.count_if(y & p).alias("tp"), F.count_if(~y & p).alias("fp"), F.count_if(y & ~p).alias("fn"))
    return c.select(f1_expr(F.col("tp"), F.col("fp"), F.col("fn")).alias("f1"))


# E20 / E21 -----------------------------------------------------------------------------
def metrics_by_split(df: DataFrame, label: str, pred: str, split_col: str = "split") -> DataFrame:
    return binary_metrics(df, label, pred, by=[split_col]).select(split_col, "accuracy", "f1")


def compare_models(tables: dict[str, DataFrame]) -> DataFrame:
    """Union of metric rows with a ``model`` column (columns aligned by name)."""
    out = None
    for name, t in tables.items():
        x = t.select(F.lit(name).alias("model"), *t.columns)
        out = x if out is None else out.unionByName(x, allowMissingColumns=True)
    return out

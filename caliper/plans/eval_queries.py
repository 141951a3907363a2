"""Registered queries: splits, rebalancing, weights, evaluation metrics and curves."""

from __future__ import annotations

from pyspark.sql import functions as F

from caliper.functions.columns import threshold_flag
from caliper.operators import evaluate as E
from caliper.operators import split as S
from caliper.plans.common import R, SCORED_SQL, SEGMENT_SQL, labelled_docs, scored_lineitem, segment_frame
from caliper.plans.registry import Tables, query

LI_KEYS = ["l_orderkey", "l_linenumber"]
LI_HASH = "md5(concat_ws('|', CAST(l_orderkey AS VARCHAR), CAST(l_linenumber AS VARCHAR), '42'))"
DOC_HASH = "md5(concat_ws('|', CAST(doc_id AS VARCHAR), '42'))"


# Splits -----------------------------------------------------------------------------------
@query("f7_random_split", "F7", sql=f"""
SELECT l_orderkey, l_linenumber,
       CASE WHEN row_number() OVER (ORDER BY {LI_HASH}, l_orderkey, l_linenumber)
                 <= ceil(0.2 * count(*) OVER ()) THEN 'test' ELSE 'train' END AS split
FROM lineitem""")
def random_split(spark, sf):
    li = Tables(spark, sf).lineitem.select(*LI_KEYS)
    return S.train_test_split(li, LI_KEYS, test_size=0.2, seed=42)


STRAT_SQL = f"""strat AS (
  SELECT d.doc_id, l.toxic,
         CASE WHEN row_number() OVER (PARTITION BY l.toxic ORDER BY {DOC_HASH.replace('doc_id', 'd.doc_id')}, d.doc_id)
                   <= ceil(0.2 * count(*) OVER (PARTITION BY l.toxic)) THEN 'test' ELSE 'train' END AS split
  FROM documents d JOIN labels l ON d.doc_id = l.doc_id)"""


@query("f8_stratified_split", "F8", sql=f"WITH {STRAT_SQL} SELECT doc_id, toxic, split FROM strat")
def stratified_split(spark, sf):
    d = labelled_docs(Tables(spark, sf)).select("doc_id", "toxic")
    return S.train_test_split(d, "doc_id", test_size=0.2, seed=42, stratify="toxic")


@query("f8_split_counts", "F8", sql=f"WITH {STRAT_SQL} SELECT split, toxic, count(*) AS count FROM strat GROUP BY 1, 2")
def split_counts(spark, sf):
    d = labelled_docs(Tables(spark, sf)).select("doc_id", "toxic")
    return S.split_counts(S.train_test_split(d, "doc_id", 0.2, 42, stratify="toxic"), "toxic")


@query("f9_stratified_folds", "F9", sql=f"""
SELECT d.doc_id, l.quality,
       CAST((row_number() OVER (PARTITION BY l.quality ORDER BY {DOC_HASH.replace('doc_id', 'd.doc_id')}, d.doc_id) - 1) % 5 AS INTEGER) AS fold
FROM documents d JOIN labels l ON d.doc_id = l.doc_id""")
def stratified_folds(spark, sf):
    d = labelled_docs(Tables(spark, sf)).select("doc_id", "quality")
    return S.stratified_folds(d, "doc_id", "quality", k=5, seed=42)


@query("f11_undersample", "F11 J2 U1", sql=f"""
WITH x AS (SELECT l_orderkey, l_linenumber, CAST(l_quantity = 50 AS INTEGER) AS label FROM lineitem),
m AS (SELECT count(*) AS n FROM x WHERE label = 1)
SELECT l_orderkey, l_linenumber, label FROM x WHERE label = 1
UNION ALL
SELECT l_orderkey, l_linenumber, label FROM (
  SELECT *, row_number() OVER (ORDER BY {LI_HASH}, l_orderkey, l_linenumber) AS rn FROM x WHERE label <> 1)
WHERE rn <= 5 * (SELECT n FROM m)""")
def undersample(spark, sf):
    li = Tables(spark, sf).lineitem.select(*LI_KEYS, (F.col("l_quantity") == 50).cast("int").alias("label"))
    return S.undersample(li, LI_KEYS, "label", minority=1, ratio=5, seed=42)


@query("f12_class_weights", "F12", sql=f"""
SELECT toxic, {R("(SELECT count(*) FROM labels) / (2.0 * count(*))")} AS weight FROM labels GROUP BY toxic""")
def class_weights(spark, sf):
    return S.balanced_class_weights(Tables(spark, sf).labels, "toxic")


# Metrics -----------------------------------------------------------------------------------
@query("e1_e3_regression_metrics", "E1 E2 E3", sql=f"""
WITH {SEGMENT_SQL}
SELECT {R("avg(abs(actual - predicted))")} AS mae, {R("sqrt(avg((actual - predicted) * (actual - predicted)))")} AS rmse,
       {R("1 - sum((actual - predicted) * (actual - predicted)) / (count(*) * var_pop(actual))")} AS r2, count(*) AS n
FROM seg""")
def regression_metrics(spark, sf):
    return E.regression_metrics(segment_frame(Tables(spark, sf)), "actual", "predicted")


PRED_SQL = f"{SCORED_SQL}, pred AS (SELECT *, CAST(score >= 0.5 AS INTEGER) AS predicted FROM scored)"


def _pred(spark, sf):
    s = scored_lineitem(Tables(spark, sf))
    return s.withColumn("predicted", threshold_flag("score", 0.5))


@query("e4_e5_binary_metrics", "E4 E5 P6", sql=f"""
WITH {PRED_SQL}, c AS (
  SELECT count(*) FILTER (WHERE label = 1 AND predicted = 1) AS tp, count(*) FILTER (WHERE label <> 1 AND predicted = 1) AS fp,
         count(*) FILTER (WHERE label = 1 AND predicted <> 1) AS fn, count(*) FILTER (WHERE label <> 1 AND predicted <> 1) AS tn
  FROM pred)
SELECT tp, fp, fn, tn, {R("(tp + tn) / (tp + fp + fn + tn)")} AS accuracy,
       {R("CASE WHEN tp + fp = 0 THEN 0.0 ELSE tp / (tp + fp) END")} AS precision,
       {R("CASE WHEN tp + fn = 0 THEN 0.0 ELSE tp / (tp + fn) END")} AS recall,
       {R("CASE WHEN 2 * tp + fp + fn = 0 THEN 0.0 ELSE 2.0 * tp / (2 * tp + fp + fn) END")} AS f1 FROM c""")
def binary_metrics(spark, sf):
    return E.binary_metrics(_pred(spark, sf), "label", "predicted")


_NAMES = {0: "kept", 1: "returned"}


def _report_sql():
    cls = []
    for c, name in _NAMES.items():
        cls.append(f"""SELECT '{name}' AS label, tp, pp, s FROM (SELECT count(*) FILTER (WHERE label = {c} AND predicted = {c}) AS tp,
  count(*) FILTER (WHERE predicted = {c}) AS pp, count(*) FILTER (WHERE label = {c}) AS s FROM pred)""")
    return f"""WITH {PRED_SQL},
k AS ({' UNION ALL '.join(cls)}),
m AS (SELECT label, CASE WHEN pp = 0 THEN 0.0 ELSE tp / pp END AS p, CASE WHEN s = 0 THEN 0.0 ELSE tp / s END AS r, s FROM k),
f AS (SELECT *, CASE WHEN p + r = 0 THEN 0.0 ELSE 2 * p * r / (p + r) END AS f1 FROM m),
n AS (SELECT count(*) AS n, count(*) FILTER (WHERE label = predicted) AS correct FROM pred)
SELECT label, 'precision' AS metric, {R('p')} AS value FROM f
UNION ALL SELECT label, 'recall', {R('r')} FROM f
UNION ALL SELECT label, 'f1-score', {R('f1')} FROM f
UNION ALL SELECT label, 'support', {R('s')} FROM f
UNION ALL SELECT 'macro avg', 'precision', {R('avg(p)')} FROM f
UNION ALL SELECT 'macro avg', 'recall', {R('avg(r)')} FROM f
UNION ALL SELECT 'macro avg', 'f1-score', {R('avg(f1)')} FROM f
UNION ALL SELECT 'macro avg', 'support', {R('n')} FROM n
UNION ALL SELECT 'weighted avg', 'precision', {R('sum(p * s) / sum(s)')} FROM f
UNION ALL SELECT 'weighted avg', 'recall', {R('sum(r * s) / sum(s)')} FROM f
UNION ALL SELECT 'weighted avg', 'f1-score', {R('sum(f1 * s) / sum(s)')} FROM f
UNION ALL SELECT 'weighted avg', 'support', {R('n')} FROM n
UNION ALL SELECT 'accuracy', 'accuracy', {R('correct / n')} FROM n"""


@query("e6_classification_report", "E6", sql=_report_sql())
def classification_report(spark, sf):
    return E.classification_report(_pred(spark, sf), "label", "predicted", labels=(0, 1), names=_NAMES)


@query("e7_confusion_matrix", "E7", sql=f"""
WITH {PRED_SQL}, d AS (SELECT a.v AS actual, p.v AS predicted FROM (VALUES (0), (1)) a(v), (VALUES (0), (1)) p(v)),
c AS (SELECT label AS actual, predicted, count(*) AS count FROM pred GROUP BY 1, 2)
SELECT CASE d.actual WHEN 0 THEN 'kept' ELSE 'returned' END AS actual,
       CASE d.predicted WHEN 0 THEN 'kept' ELSE 'returned' END AS predicted, coalesce(c.count, 0) AS count
FROM d LEFT JOIN c ON d.actual = c.actual AND d.predicted = c.predicted""")
def confusion_matrix(spark, sf):
    return E.confusion_matrix(_pred(spark, sf), "label", "predicted", labels=[0, 1], names=_NAMES)


SC_SQL = f"""{SCORED_SQL},
sc AS (SELECT score + 0.0 AS score, count(*) FILTER (WHERE label = 1) AS pos, count(*) FILTER (WHERE label <> 1) AS neg
       FROM scored WHERE score IS NOT NULL GROUP BY 1),
cum AS (SELECT score, pos, neg, sum(pos) OVER (ORDER BY score DESC) AS tps, sum(neg) OVER (ORDER BY score DESC) AS fps,
               coalesce(sum(neg) OVER (ORDER BY score ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS nb,
               sum(pos) OVER () AS P, sum(neg) OVER () AS N FROM sc)"""


@query("e8_roc_auc", "E8", sql=f"WITH {SC_SQL} SELECT {R('sum(pos * (nb + neg / 2.0)) / (sum(pos) * sum(neg))')} AS roc_auc FROM cum")
def roc_auc(spark, sf):
    return E.roc_auc(scored_lineitem(Tables(spark, sf)), "label", "score")


@query("e9_roc_curve", "E9", sql=f"WITH {SC_SQL} SELECT {R('score')} AS threshold, {R('fps / N')} AS fpr, {R('tps / P')} AS tpr FROM cum")
def roc_curve(spark, sf):
    return E.roc_curve(scored_lineitem(Tables(spark, sf)), "label", "score")


@query("e10_average_precision", "E10", sql=f"""
WITH {SC_SQL} SELECT {R('sum((pos / P) * (tps / (tps + fps)))')} AS average_precision FROM cum""")
def average_precision(spark, sf):
    return E.average_precision(scored_lineitem(Tables(spark, sf)), "label", "score")


@query("e11_pr_curve", "E11", sql=f"""
WITH {SC_SQL}
SELECT {R('score')} AS threshold, {R('tps / (tps + fps)')} AS precision, {R('tps / P')} AS recall FROM cum
WHERE score >= (SELECT max(score) FROM cum WHERE tps = P)""")
def pr_curve(spark, sf):
    return E.pr_curve(scored_lineitem(Tables(spark, sf)), "label", "score")


def _sweep_sql(lo, hi, num):
    step = (hi - lo) / (num - 1)
    return f"""{SCORED_SQL},
th AS (SELECT CAST(range AS INTEGER) AS i,
              CASE WHEN range = {num - 1} THEN CAST({hi!r} AS DOUBLE) ELSE CAST({lo!r} AS DOUBLE) + range * CAST({step!r} AS DOUBLE) END AS thr
       FROM range({num})),
sw AS (SELECT i, thr, count(*) FILTER (WHERE label = 1 AND score >= thr) AS tp,
              count(*) FILTER (WHERE label <> 1 AND score >= thr) AS fp,
              count(*) FILTER (WHERE label = 1 AND NOT score >= thr) AS fn
       FROM th CROSS JOIN (SELECT label, score FROM scored WHERE score IS NOT NULL) GROUP BY i, thr),
f AS (SELECT *, CASE WHEN 2 * tp + fp + fn = 0 THEN 0.0 ELSE 2.0 * tp / (2 * tp + fp + fn) END AS f1 FROM sw)"""


@query("e12_threshold_sweep", "E12 X25", sql=f"""
WITH {_sweep_sql(0.01, 0.99, 100)}
SELECT i, {R('thr')} AS threshold, tp, fp, fn, {R('CASE WHEN tp + fp = 0 THEN 0.0 ELSE tp / (tp + fp) END')} AS precision,
       {R('CASE WHEN tp + fn = 0 THEN 0.0 ELSE tp / (tp + fn) END')} AS recall, {R('f1')} AS f1 FROM f""")
def threshold_sweep(spark, sf):
    return E.threshold_sweep(scored_lineitem(Tables(spark, sf)), "label", "score", 0.01, 0.99, 100)


@query("e12_best_threshold", "E12", sql=f"""
WITH {_sweep_sql(0.01, 0.99, 100)} SELECT {R('thr')} AS threshold, {R('f1')} AS f1 FROM f ORDER BY f1 DESC, i LIMIT 1""")
def best_threshold(spark, sf):
    sw = E.threshold_sweep(scored_lineitem(Tables(spark, sf)), "label", "score", 0.01, 0.99, 100)
    return E.best_threshold(sw)


@query("e13_best_threshold_strict", "E13", sql=f"""
WITH {_sweep_sql(0.01, 0.9, 200)}, b AS (SELECT thr, f1 FROM f ORDER BY f1 DESC, i LIMIT 1)
SELECT {R('CASE WHEN f1 > 0 THEN thr ELSE 0.5 END')} AS threshold, {R('CASE WHEN f1 > 0 THEN f1 ELSE 0.0 END')} AS f1 FROM b""")
def best_threshold_strict(spark, sf):
    sw = E.threshold_sweep(scored_lineitem(Tables(spark, sf)), "label", "score", 0.01, 0.9, 200)
    return E.best_threshold(sw, default=(0.5, 0.0))


@query("e14_f1_at_foreign_threshold", "E14", sql=f"""
WITH {_sweep_sql(0.01, 0.99, 100)}, b AS (SELECT thr FROM f ORDER BY f1 DESC, i LIMIT 1),
o AS (SELECT CAST(l_returnflag = 'R' AS INTEGER) AS label, 1.0 / (1.0 + exp(-(CAST(-1.0 AS DOUBLE) + CAST(0.04 AS DOUBLE) * l_quantity))) AS score2 FROM lineitem),
c AS (SELECT count(*) FILTER (WHERE label = 1 AND score2 >= (SELECT thr FROM b)) AS tp,
             count(*) FILTER (WHERE label <> 1 AND score2 >= (SELECT thr FROM b)) AS fp,
             count(*) FILTER (WHERE label = 1 AND NOT score2 >= (SELECT thr FROM b)) AS fn FROM o)
SELECT {R('CASE WHEN 2 * tp + fp + fn = 0 THEN 0.0 ELSE 2.0 * tp / (2 * tp + fp + fn) END')} AS f1 FROM c""")
def f1_at_foreign_threshold(spark, sf):
    t = Tables(spark, sf)
    sw = E.threshold_sweep(scored_lineitem(t), "label", "score", 0.01, 0.99, 100)
    thr = E.best_threshold(sw).select("threshold").scalar()
    other = t.lineitem.select((F.col("l_returnflag") == "R").cast("int").alias("label"),
                              (F.lit(1.0) / (F.lit(1.0) + F.exp(-(F.lit(-1.0) + F.lit(0.04) * F.col("l_quantity")))))
                              .alias("score2"))
    return E.f1_at_threshold(other, "label", "score2", thr)


@query("e20_metrics_by_split", "E20 F7", sql=f"""
WITH {PRED_SQL},
s AS (SELECT *, CASE WHEN row_number() OVER (ORDER BY {LI_HASH}, l_orderkey, l_linenumber)
                          <= ceil(0.2 * count(*) OVER ()) THEN 'test' ELSE 'train' END AS split FROM pred)
SELECT split, {R('avg(CAST(label = predicted AS INTEGER))')} AS accuracy,
       {R('CASE WHEN count(*) FILTER (WHERE label = 1 OR predicted = 1) = 0 THEN 0.0 ELSE 2.0 * count(*) FILTER (WHERE label = 1 AND predicted = 1) / (count(*) FILTER (WHERE label = 1) + count(*) FILTER (WHERE predicted = 1)) END')} AS f1
FROM s GROUP BY split""")
def metrics_by_split(spark, sf):
    p = S.train_test_split(_pred(spark, sf), LI_KEYS, 0.2, 42)
    return E.metrics_by_split(p, "label", "predicted")


@query("e21_model_comparison", "E21", sql=f"""
WITH {SEGMENT_SQL}
SELECT 'scaled' AS model, {R('avg(abs(actual - predicted))')} AS mae, {R('1 - sum((actual - predicted) * (actual - predicted)) / (count(*) * var_pop(actual))')} AS r2 FROM seg
UNION ALL
SELECT 'unscaled', {R('avg(abs(actual - predicted / 0.9))')}, {R('1 - sum((actual - predicted / 0.9) * (actual - predicted / 0.9)) / (count(*) * var_pop(actual))')} FROM seg""")
def model_comparison(spark, sf):
    seg = segment_frame(Tables(spark, sf)).withColumn("p2", F.col("predicted") / 0.9)
    a = E.regression_metrics(seg, "actual", "predicted").select("mae", "r2")
    b = E.regression_metrics(seg, "actual", "p2").select("mae", "r2")
    return E.compare_models({"scaled": a, "unscaled": b})

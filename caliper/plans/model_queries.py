"""Registered queries: models, explanations and scoring jobs (M, E15-E19, J3, C)."""

from __future__ import annotations

from pyspark.ml import Pipeline, PipelineModel
from pyspark.sql import functions as F

from caliper.functions import text as X
from caliper.operators import evaluate as E
from caliper.operators import explain as XP
from caliper.operators import models as M
from caliper.operators import score as SC
from caliper.operators import split as S
from caliper.operators.features import FeatureGrid, SmoothTfidf
from caliper.operators.logistic import RidgeLogistic
from caliper.operators.stages import NGramRange, TextCleaner
from caliper.plans.common import R, SCORED_SQL, WORD_RE, labelled_docs, scored_lineitem
from caliper.plans.registry import Tables, query
from caliper.session import stored
from caliper.sources.io import spread


# Coefficient table shared by J3 / E18 / E19 (a fitted naive log-odds model) ----------------
def logodds_coefs(t: Tables):
    d = labelled_docs(t).select("doc_id", "quality", X.word_tokens(X.lower("text")).alias("toks"))
    dt = d.select("doc_id", "quality", F.explode(F.array_distinct("toks")).alias("term"))
    g = dt.groupBy("term").agg(F.count_if(F.col("quality") == 1).alias("pos"),
                               F.count_if(F.col("quality") != 1).alias("neg"))
    return g.where(F.col("pos") + F.col("neg") >= 2).select(
        "term", F.log((F.col("pos") + 1.0) / (F.col("neg") + 1.0)).alias("coef"))


COEFS_SQL = f"""coefs AS (
  SELECT term, ln(CAST(count(*) FILTER (WHERE quality = 1) + 1 AS DOUBLE) / CAST(count(*) FILTER (WHERE quality <> 1) + 1 AS DOUBLE)) AS coef
  FROM (SELECT DISTINCT d.doc_id, l.quality, unnest(regexp_extract_all(lower(d.text), '{WORD_RE}')) AS term
        FROM documents d JOIN labels l ON d.doc_id = l.doc_id)
  GROUP BY term HAVING count(*) >= 2)"""


def _bench_tokens(t: Tables):
    return t.benchmark.select("item_id", X.word_tokens(X.lower("text")).alias("toks"))


@query("j3_term_coefficients", "J3 M15", sql=f"""
WITH {COEFS_SQL},
b AS (SELECT item_id, unnest(regexp_extract_all(lower(text), '{WORD_RE}')) AS term FROM benchmark)
SELECT item_id, count(coef) AS n_known, {R('1.0 / (1.0 + exp(-(0.0 + coalesce(sum(coef), 0.0))))')} AS score
FROM benchmark LEFT JOIN b USING (item_id) LEFT JOIN coefs ON b.term = coefs.term GROUP BY item_id""")
def term_coefficients(spark, sf):
    t = Tables(spark, sf)
    return XP.known_term_score(_bench_tokens(t), "item_id", "toks", logodds_coefs(t))


@query("e19_top_contributions", "E19 J3", sql=f"""
WITH {COEFS_SQL},
b AS (SELECT DISTINCT item_id, unnest(regexp_extract_all(lower(text), '{WORD_RE}')) AS term FROM benchmark),
j AS (SELECT item_id, b.term, coef FROM b JOIN coefs ON b.term = coefs.term)
SELECT item_id, CAST(rk AS INTEGER) AS rank, term, {R('coef')} AS contribution FROM (
  SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY abs(coef) DESC, term) AS rk FROM j) WHERE rk <= 5""")
def top_contributions(spark, sf):
    t = Tables(spark, sf)
    return XP.term_contributions(_bench_tokens(t), "item_id", "toks", logodds_coefs(t), k=5)


TFIDF_CONTRIB_SQL = f"""
WITH {COEFS_SQL},
n AS (SELECT count(*) AS n FROM documents),
df AS (SELECT term, count(DISTINCT doc_id) AS df FROM (
         SELECT doc_id, unnest(regexp_extract_all(lower(text), '{WORD_RE}')) AS term FROM documents) GROUP BY 1),
tf AS (SELECT item_id, term, count(*) AS tf FROM (
         SELECT item_id, unnest(regexp_extract_all(lower(text), '{WORD_RE}')) AS term FROM benchmark) GROUP BY 1, 2),
w AS (SELECT item_id, term, tf * (ln((1.0 + n) / (1.0 + df)) + 1.0) AS x FROM tf JOIN df USING (term), n),
c AS (SELECT w.item_id, w.term, x / sqrt(s) * coef AS c
      FROM w JOIN (SELECT item_id, sum(x * x) AS s FROM w GROUP BY 1) USING (item_id) JOIN coefs USING (term))
"""


def _tfidf_contributions(t: Tables):
    """(item_id, term, contribution): tf-idf (smooth, L2) times coefficient."""
    from caliper.operators import features as FT
    n = t.documents.agg(F.count(F.lit(1))).scalar()
    docs = t.documents.select("doc_id", X.word_tokens(X.lower("text")).alias("toks"))
    vocab = FT.document_frequency(FT.term_frequencies(docs, "doc_id", "toks")).withColumn("idx", F.lit(0))
    w = FT.tfidf(FT.term_frequencies(_bench_tokens(t), "item_id", "toks"), vocab, n, "item_id")
    return w.join(logodds_coefs(t), "term").select("item_id", "term", (F.col("weight") * F.col("coef")).alias("contribution"))


@query("e19b_tfidf_contributions", "E19 J3 F6", sql=TFIDF_CONTRIB_SQL + f"""
SELECT item_id, CAST(rk AS INTEGER) AS rank, term, {R('c')} AS contribution FROM (
  SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY round(abs(c), 9) DESC, term) AS rk FROM c WHERE c <> 0) WHERE rk <= 5""")
def tfidf_contributions(spark, sf):
    """Form (b): the five strongest tf-idf x coefficient terms of each item."""
    from caliper.operators.ranking import top_k
    c = _tfidf_contributions(Tables(spark, sf)).where(F.col("contribution") != 0)
    return top_k(c, "item_id", [F.round(F.abs("contribution"), 9).desc(), F.col("term")], 5, rank_col="rank").select(
        "item_id", "rank", "term", "contribution")


@query("e19c_signed_contributions", "E19 J3 F6", sql=TFIDF_CONTRIB_SQL + f"""
SELECT item_id, CASE WHEN c > 0 THEN 'for' ELSE 'against' END AS side, CAST(rk AS INTEGER) AS rank, term, {R('c')} AS contribution FROM (
  SELECT *, row_number() OVER (PARTITION BY item_id, c > 0 ORDER BY round(abs(c), 9) DESC, term) AS rk FROM c WHERE c <> 0) WHERE rk <= 5""")
def signed_contributions(spark, sf):
    """Form (c): the five strongest terms for and against the positive class of each item."""
    from caliper.operators.ranking import top_k
    c = _tfidf_contributions(Tables(spark, sf)).where(F.col("contribution") != 0)
    c = c.withColumn("side", F.when(F.col("contribution") > 0, "for").otherwise("against"))
    return top_k(c, ["item_id", "side"], [F.round(F.abs("contribution"), 9).desc(), F.col("term")], 5, rank_col="rank").select(
        "item_id", "side", "rank", "term", "contribution")


@query("e18_top_bottom_terms", "E18", sql=f"""
WITH {COEFS_SQL}
(SELECT 'positive' AS side, term, {R('coef')} AS coef FROM coefs ORDER BY coefs.coef DESC, term LIMIT 20)
UNION ALL
(SELECT 'negative' AS side, term, {R('coef')} AS coef FROM coefs ORDER BY coefs.coef ASC, term LIMIT 20)""")
def top_bottom_terms(spark, sf):
    return XP.top_bottom_terms(logodds_coefs(Tables(spark, sf)), 20)


@query("f3_one_hot", "F3", sql="""
SELECT c_custkey, concat_ws(',', CAST(c_mktsegment = 'AUTOMOBILE' AS INTEGER), CAST(c_mktsegment = 'BUILDING' AS INTEGER),
       CAST(c_mktsegment = 'FURNITURE' AS INTEGER), CAST(c_mktsegment = 'MACHINERY' AS INTEGER)) AS slots FROM customer""")
def one_hot(spark, sf):
    """Levels seen in training, in alphabetical order; the one left out of it is all zeros."""
    from pyspark.ml.functions import vector_to_array
    c = Tables(spark, sf).customer.select("c_custkey", "c_mktsegment")
    model = Pipeline(stages=M.one_hot_stages(["c_mktsegment"])).fit(c.where("c_mktsegment <> 'HOUSEHOLD'"))
    slots = F.transform(vector_to_array("c_mktsegment__ohe"), lambda x: x.cast("int").cast("string"))
    return model.transform(c).select("c_custkey", F.array_join(slots, ",").alias("slots"))


@query("m1_linear_regression_1d", "M1 F4 M11", sql="""
SELECT floor(regr_slope(l_extendedprice, l_quantity) * 10000.0 + 0.5) / 10000.0 + 0.0 AS slope,
       floor(regr_intercept(l_extendedprice, l_quantity) * 10000.0 + 0.5) / 10000.0 + 0.0 AS intercept FROM lineitem""")
def linear_regression_1d(spark, sf):
    li = Tables(spark, sf).lineitem.select("l_quantity", F.col("l_extendedprice").alias("label"))
    from pyspark.ml.feature import VectorAssembler
    model = Pipeline(stages=[VectorAssembler(inputCols=["l_quantity"], outputCol="features"),
                             M.linear_regression()]).fit(li)
    lr = model.stages[-1]
    r4 = lambda v: F.floor(F.lit(float(v)) * F.lit(10000.0) + F.lit(0.5)).cast("double") / F.lit(10000.0)
    return spark.range(1).select(r4(lr.coefficients[0]).alias("slope"), r4(lr.intercept).alias("intercept"))


@query("c6_gauge_zones", "C6", sql=f"""
WITH {SCORED_SQL}
SELECT CASE WHEN score * 100 < 45 THEN 'negative' WHEN score * 100 < 55 THEN 'neutral' ELSE 'positive' END AS zone,
       count(*) AS count FROM scored GROUP BY 1""")
def gauge_zones(spark, sf):
    s = scored_lineitem(Tables(spark, sf))
    return s.groupBy(SC.gauge_zone(F.col("score") * 100).alias("zone")).agg(F.count(F.lit(1)).alias("count"))


# Model fits (rows-only checks) --------------------------------------------------------------
def _text_model(train, C=1.0, l1=False, vocab=5000, ngram=(1, 2), profile="sentiment"):
    """Cleaning, n-grams, TF-IDF and logistic regression; texts are cleaned once, the vocabulary reads what is written
    and the solver reads the written matrix."""
    clean = PipelineModel([TextCleaner("text", "tokens", profile=profile), NGramRange("tokens", "grams", *ngram)])
    grams = stored(clean.transform(train).select("grams", "label"), "text-grams")
    tfidf = SmoothTfidf("grams", "features", vocabSize=vocab).fit(grams)
    matrix = stored(tfidf.transform(grams).select("features", "label"), "text-matrix")
    n = matrix.count()
    # the same objective; unscaled, a ridge fit needs far fewer passes (see ``operators/logistic.py``)
    solver = M.logistic_regression(C=C, n_rows=n, l1=True) if l1 else RidgeLogistic(regParam=M.refit_penalty(C, n), tol=1e-6)
    lr = solver.fit(matrix)
    return PipelineModel([*clean.stages, tfidf, lr])


def _text_split(t: Tables):
    d = labelled_docs(t).select("doc_id", "text", F.col("quality").cast("double").alias("label"))
    return stored(S.train_test_split(d, "doc_id", 0.2, 42, stratify="label"), "text-split")


@query("m3_text_logistic_l2", "M3 M11 M14 F6 X20 UD2 E4 E5 E20")
def text_logistic_l2(spark, sf):
    d = _text_split(Tables(spark, sf))
    model = _text_model(d.where("split = 'train'"), C=1.0)
    pred = model.transform(d)
    return E.binary_metrics(pred, "label", "prediction", by=["split"])


@query("m5_text_logistic_l1", "M5 E18")
def text_logistic_l1(spark, sf):
    d = _text_split(Tables(spark, sf))
    model = _text_model(d.where("split = 'train'"), C=1.0, l1=True, ngram=(1, 1))
    tfidf, lr = model.stages[2], model.stages[3]
    terms = tfidf.stages[0].vocabulary
    coefs = XP.coefficient_table(spark, terms, lr.coefficients.toArray()).withColumnRenamed("feature", "term")
    return XP.top_bottom_terms(coefs, 20)


def _lineitem_rare(t: Tables):
    li = t.lineitem.select("l_orderkey", "l_linenumber", "l_discount", "l_tax", "l_extendedprice",
                           (F.col("l_quantity") == 50).cast("double").alias("label"))
    return stored(spread(S.train_test_split(li, ["l_orderkey", "l_linenumber"], 0.2, 42, stratify="label")), "lineitem-split")


@query("m4_balanced_logistic", "M4 F12 F2 E8 E12")
def balanced_logistic(spark, sf):
    d = _lineitem_rare(Tables(spark, sf))
    train = S.with_class_weights(d.where("split = 'train'"), "label")
    n = train.agg(F.sum("weight")).first()[0]
    pipe = Pipeline(stages=M.tabular_stages(["l_discount", "l_tax", "l_extendedprice"])
                    + [M.logistic_regression(C=1.0, n_rows=n, weight_col="weight")])
    model = pipe.fit(train)
    test = M.positive_probability(model.transform(d.where("split = 'test'")))
    auc = E.roc_auc(test, "label", "p1")
    best = E.best_threshold(E.threshold_sweep(test, "label", "p1", 0.01, 0.99, 100))
    return auc.select("roc_auc", best.select("threshold").scalar().alias("best_threshold"),
                      best.select("f1").scalar().alias("best_f1"))


def _customer(t: Tables):
    c = t.customer.select("c_custkey", "c_acctbal", F.col("c_nationkey").cast("string").alias("nation"),
                          (F.col("c_mktsegment") == "BUILDING").cast("double").alias("label"))
    return stored(spread(S.train_test_split(c, "c_custkey", 0.2, 42, stratify="label")), "customer-split")


@query("m6_gbt_classifier", "M6 F3 E5 E8")
def gbt_classifier(spark, sf):
    d = _customer(Tables(spark, sf))
    model = M.fit_by_features(M.tabular_stages(["c_acctbal"], ["nation"], bins=32), M.gbt_classifier(200, 0.1, 3), d.where("split = 'train'"))
    test = M.positive_probability(model.transform(d.where("split = 'test'")))
    m = E.binary_metrics(test, "label", "prediction")
    return m.select("f1", "accuracy", E.roc_auc(test, "label", "p1").select("roc_auc").scalar().alias("roc_auc"))


@query("m7_rf_classifier_balanced", "M7 F12 E16")
def rf_classifier_balanced(spark, sf):
    d = _customer(Tables(spark, sf))
    train = S.with_class_weights(d.where("split = 'train'"), "label")
    pipe = Pipeline(stages=M.tabular_stages(["c_acctbal"], ["nation"])
                    + [M.random_forest_classifier(300, 12, weight_col="weight")])
    model = pipe.fit(train)
    names = XP.feature_names(model.transform(train.limit(1)))
    return XP.importance_table(spark, names, model.stages[-1].featureImportances)


def _orders(t: Tables):
    o = t.orders.select("o_orderkey", "o_orderstatus", "o_orderpriority", F.col("o_totalprice").alias("label"),
                        F.pmod(F.xxhash64("o_custkey"), F.lit(100)).cast("double").alias("cust_bucket"))
    return stored(spread(S.train_test_split(o, "o_orderkey", 0.2, 42)), "orders-split")


@query("m8_gbt_regressor", "M8 E1 E2 E3 E21")
def gbt_regressor(spark, sf):
    d = _orders(Tables(spark, sf))
    model = M.fit_by_features(M.tabular_stages(["cust_bucket"], ["o_orderstatus", "o_orderpriority"]),
                              M.gbt_regressor(100, 0.1, 3), d.where("split = 'train'"))
    return E.regression_metrics(model.transform(d.where("split = 'test'")), "label", "prediction")


@query("c4_what_if", "C4 C2")
def what_if(spark, sf):
    d = _orders(Tables(spark, sf))
    model = M.fit_by_features(M.tabular_stages(["cust_bucket"], ["o_orderstatus", "o_orderpriority"]),
                              M.gbt_regressor(100, 0.1, 3), d.where("split = 'train'"))
    scen = {"status_f": (F.col("o_orderstatus") != "F", {"o_orderstatus": F.lit("F")}),
            "medium": (F.col("o_orderpriority") == "1-URGENT", {"o_orderpriority": F.lit("3-MEDIUM")})}
    return SC.what_if(model, d.where("split = 'test'"), "o_orderkey", scen)


@query("m2_rf_regressor", "M2 E15 E16 P1")
def rf_regressor(spark, sf):
    li = Tables(spark, sf).lineitem.select("l_orderkey", "l_linenumber", "l_quantity", "l_discount", "l_tax",
                                           F.col("l_extendedprice").alias("label"))
    # 300 bootstraps are much work per row: the split is written in as many files as there are cores
    d = stored(spread(S.train_test_split(li, ["l_orderkey", "l_linenumber"], 0.2, 42)), "lineitem-split")
    model = M.fit_forest_by_features(M.tabular_stages(["l_quantity", "l_discount", "l_tax"], impute=True, bins=32),
                                     M.random_forest_regressor(300, 12), d.where("split = 'train'"))
    met = E.regression_metrics(M.predict_by_features(model, d.where("split = 'test'")), "label", "prediction")
    names = XP.feature_names(PipelineModel(model.stages[:-1]).transform(d.limit(1)))
    imp = XP.importance_table(spark, names, model.stages[-1].featureImportances)
    return E.compare_models({"random_forest": met.select("mae", "rmse", "r2")}).unionByName(
        imp.select(F.lit("importance:").alias("model"), F.lit(None).cast("double").alias("mae"),
                   F.lit(None).cast("double").alias("rmse"), F.col("importance").alias("r2")), allowMissingColumns=True)


@query("e15_coefficient_ranking", "E15 M3 F2 M14 M15")
def coefficient_ranking(spark, sf):
    d = _lineitem_rare(Tables(spark, sf))
    train = d.where("split = 'train'")
    n = train.count()
    pipe = Pipeline(stages=M.tabular_stages(["l_discount", "l_tax", "l_extendedprice"])
                    + [M.logistic_regression(C=1.0, n_rows=n)])
    model = pipe.fit(train)
    lr = model.stages[-1]
    names = XP.feature_names(model.transform(train.limit(1)))
    # M14 vs M15: the model's own probability against the coefficient table applied by hand
    scored = model.transform(d.where("split = 'test'"))
    scored = M.positive_probability(scored)
    from pyspark.ml.functions import vector_to_array
    z = F.lit(float(lr.intercept))
    for i, w in enumerate(lr.coefficients.toArray()):
        z = z + F.lit(float(w)) * vector_to_array("features")[i]
    gap = scored.agg(F.max(F.abs(F.col("p1") - F.lit(1.0) / (F.lit(1.0) + F.exp(-z))))).scalar()
    return XP.coefficient_table(spark, names, lr.coefficients.toArray()).withColumn("m14_m15_max_gap", gap)


def _grid(spark, d, n_folds: int, vocab: list[int], grams: list[str], cs: list[float], name: str):
    """Class-1 F1 of every grid point over stratified folds, and the best one refit on all rows.

    Cleaning and n-grams do not depend on the training rows, so they are made
    once (``uni`` and ``bi`` token columns, written) and the grid varies which one is read.
    A vocabulary is fitted once per fold and column, a matrix made once per
    vocabulary, and the strengths of the penalty share it and every pass over it.
    """
    d = stored(S.stratified_folds(stored(d, f"{name}-tokens"), "doc_id", "label", k=n_folds), name)
    n = d.count()
    n_train = n * (n_folds - 1) / n_folds
    tfidf = SmoothTfidf(grams[0], "features")
    lr = RidgeLogistic()
    pipe = FeatureGrid(tfidf, lr)
    grid = {tfidf.inputCol: grams, tfidf.vocabSize: vocab, lr.regParam: [M.refit_penalty(c, n_train) for c in cs]}
    cv = M.grid_search(pipe, grid, "fold", parallelism=8, n_folds=n_folds)
    rows = []
    for p, m, sd in M.cv_summary(cv.fit(d)):
        rows.append((p["inputCol"], int(p["vocabSize"]), round(1.0 / (p["regParam"] * n_train), 6), m, sd, m - 2 * sd, m + 2 * sd))
    best = max(rows, key=lambda r: (r[3], r[0], -r[1], -r[2]))
    refit = Pipeline(stages=[SmoothTfidf(best[0], "features", vocabSize=best[1]),
                            RidgeLogistic(regParam=M.refit_penalty(best[2], n))]).fit(d)
    f1 = M.f1_evaluator().evaluate(refit.transform(d))
    out = spark.createDataFrame(rows, "grams string, vocab int, C double, mean_f1 double, std_f1 double, lo double, hi double")
    chosen = (F.col("grams") == best[0]) & (F.col("vocab") == best[1]) & (F.col("C") == best[2])
    return out.withColumn("refit_f1", F.when(chosen, F.lit(float(f1))))


@query("m12_grid_search", "M12 M13 F9")
def grid_search(spark, sf):
    """18 points x 3 folds: vocabulary 3,000 to 10,000, one or two words, C 0.1 to 10."""
    d = labelled_docs(Tables(spark, sf)).select("doc_id", F.col("quality").cast("double").alias("label"), X.clean_sentiment("text").alias("uni"))
    return _grid(spark, d.withColumn("bi", X.ngrams(F.col("uni"), 1, 2)), 3, [3000, 5000, 10000], ["uni", "bi"], [0.1, 1.0, 10.0], "grid-sentiment")


@query("m12b_grid_search_spam", "M12 M13 F9")
def grid_search_spam(spark, sf):
    """9 points x 5 folds: vocabulary 1,000 to 3,000, C 0.1 to 10."""
    d = labelled_docs(Tables(spark, sf)).select("doc_id", F.col("toxic").cast("double").alias("label"), X.word_tokens(X.lower("text")).alias("uni"))
    return _grid(spark, d, 5, [1000, 2000, 3000], ["uni"], [0.1, 1.0, 10.0], "grid-spam")


@query("j6_permuted_column", "J6", sql=f"""
SELECT CAST(rep AS INTEGER) AS rep, count(*) AS n, {R('sum(CAST(c_acctbal AS DECIMAL(38,2)))')} AS total,
       count(DISTINCT c_acctbal) AS n_values, 1 AS moved
FROM customer, (SELECT unnest(generate_series(0, 9)) AS rep) GROUP BY rep""")
def permuted_column(spark, sf):
    """Each shuffled copy keeps the column's multiset, and moves it."""
    from caliper.operators.ranking import hash_rank
    c = Tables(spark, sf).customer.select("c_custkey", "c_acctbal", F.col("c_acctbal").alias("was"))
    x = XP.permuted_copies(hash_rank(c, "c_custkey", seed=42, rank_col="pos"), "c_custkey", "c_acctbal", 10)
    return x.groupBy("rep").agg(F.count(F.lit(1)).alias("n"), F.sum(F.col("c_acctbal").cast("decimal(38,2)")).cast("double").alias("total"),
                                F.countDistinct("c_acctbal").alias("n_values"), F.max((F.col("c_acctbal") != F.col("was")).cast("int")).alias("moved"))


@query("e17_permutation_importance", "E17 J6")
def permutation_importance(spark, sf):
    d = _customer(Tables(spark, sf))
    train = S.with_class_weights(d.where("split = 'train'"), "label")
    pipe = Pipeline(stages=M.tabular_stages(["c_acctbal"], ["nation"]) + [
        M.logistic_regression(C=1.0, n_rows=train.agg(F.sum("weight")).first()[0], weight_col="weight")])
    model = pipe.fit(train)
    return XP.permutation_importance(model, d.where("split = 'test'"), "c_custkey", ["c_acctbal", "nation"],
                                     n_repeats=10, top=10)


# Scoring jobs ----------------------------------------------------------------------------
@query("c1_batch_text_scoring", "C1")
def batch_text_scoring(spark, sf):
    t = Tables(spark, sf)
    train = labelled_docs(t).select("doc_id", "text", F.col("toxic").cast("double").alias("label"))
    model = _text_model(train, C=10.0, vocab=2000, ngram=(1, 1), profile="spam")
    conv = t.conversations.select(F.concat_ws(":", "conv_id", "turn").alias("msg_id"), "text")
    return SC.score_messages(model, conv, "msg_id")


@query("c3_sentiment_scoring", "C3 M14")
def sentiment_scoring(spark, sf):
    t = Tables(spark, sf)
    train = labelled_docs(t).select("doc_id", "text", F.col("quality").cast("double").alias("label"))
    model = _text_model(train, C=1.0)
    return SC.score_sentiment(model, t.benchmark.select("item_id", "text"), "item_id")


@query("c2_tabular_scoring", "C2 M4 S3")
def tabular_scoring(spark, sf):
    """Customer rows scored at threshold 0.5 by a class-weighted logistic model."""
    d = _customer(Tables(spark, sf))
    train = S.with_class_weights(d.where("split = 'train'"), "label")
    n = train.agg(F.sum("weight")).first()[0]
    pipe = Pipeline(stages=M.tabular_stages(["c_acctbal"], ["nation"])
                    + [M.logistic_regression(C=1.0, n_rows=n, weight_col="weight")])
    model = pipe.fit(train)
    # S3: the rows to score arrive as JSON records, read back with the model's input schema
    from caliper.session import scratch_path
    from caliper.sources import io as IO
    test = d.where("split = 'test'").select("c_custkey", "c_acctbal", "nation")
    p = scratch_path(spark, "customers-json")
    test.write.mode("overwrite").json(p)
    recs = IO.read_json_records(spark, p, test.schema)
    return SC.score_tabular(model, recs, "c_custkey", threshold=0.5)

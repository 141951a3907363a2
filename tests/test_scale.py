"""Work that must not grow faster than the input: one pass over texts, bounded batches, no row set on the driver."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from caliper.operators import smote as SM
from caliper.operators import split as S

from conftest import SF001


def test_stream_reads_a_table_of_part_files(spark, tmp_path):
    from caliper.plans.job_queries import stream_scoring
    for t in ("documents", "labels", "conversations"):
        spark.read.parquet(f"{SF001}/{t}.parquet").repartition(3).write.parquet(str(tmp_path / f"{t}.parquet"))
    assert stream_scoring(spark, str(tmp_path)).count() == spark.read.parquet(f"{SF001}/conversations.parquet").count()


def test_class_weights_leave_rows_where_they_are(spark):
    df = spark.range(100).select("id", F.when(F.col("id") < 10, 1.0).when(F.col("id") < 95, 0.0).alias("label"))
    out = S.with_class_weights(df, "label")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        plan = out._jdf.queryExecution().toString()
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan
    got = {(r.label, round(r.weight, 6)): r.n for r in out.groupBy("label", "weight").agg(F.count("*").alias("n")).collect()}
    assert got == {(1.0, round(100 / 30, 6)): 10, (0.0, round(100 / 255, 6)): 85}


def test_shipped_queries_leave_in_bounded_frames():
    import pandas as pd
    cells = SM.Cells(np.zeros((64, 2)))
    cells.pieces[:], cells.lo[:], cells.hi[:] = 1, 0.0, 1.0

    class Held:
        value = cells
    n = 3000
    df = pd.DataFrame({"k": np.arange(n), "v": [np.zeros(2)] * n, "cell": 0, "reach": np.inf})
    sizes = [len(x) for x in SM._ship(Held, "k")([df])]
    assert sum(sizes) == n * 63 and max(sizes) <= SM.OUT_ROWS


def test_neighbours_do_not_depend_on_slices(spark, monkeypatch):
    X = np.random.default_rng(7).random((90, 3))
    df = spark.createDataFrame([(i, X[i].tolist()) for i in range(90)], "k long, v array<double>")
    want = sorted(SM.knn(df, df, "k", "v", k=3, block_rows=20).collect())
    monkeypatch.setattr(SM, "QUERY_ROWS", 10)
    assert sorted(SM.knn(df, df, "k", "v", k=3, block_rows=20).collect()) == want


@pytest.mark.parametrize("name", ["f13_dtm_stats"])
def test_texts_are_cleaned_once(spark, name):
    from caliper.plans import load_all
    plan = load_all()[name].fn(spark, SF001)._jdf.queryExecution().toString()
    assert "regexp" not in plan.lower() and "term-frequencies" in plan


def test_text_models_fit_on_written_grams(spark, monkeypatch):
    from caliper.plans import model_queries as Q
    seen, whole = [], Q.TextCleaner._transform
    monkeypatch.setattr(Q.TextCleaner, "_transform", lambda self, df: seen.append(1) or whole(self, df))
    df = spark.createDataFrame([(f"{'gamma' if i % 3 else 'delta'} {'poor' if i % 2 else 'fine'}", float(i % 2)) for i in range(30)], "text string, label double")
    model = Q._text_model(df, vocab=20, ngram=(1, 1))
    assert len(seen) == 1 and len(model.stages) == 4
    assert model.transform(df).where("prediction = label").count() == 30


def test_logistic_rows_are_packed_once(spark, monkeypatch):
    """Blocks of few rows, many passes: the matrix is read once and the result is that of one block."""
    from pyspark.ml.linalg import Vectors
    from caliper.operators import logistic as L
    r = np.random.default_rng(3)
    rows = [(Vectors.sparse(6, [i % 6], [float(r.normal())]) if i % 2 else Vectors.dense(r.normal(size=6)), float(r.random() > 0.5)) for i in range(90)]
    df = spark.createDataFrame(rows, ["features", "label"]).repartition(2).cache()
    made, whole = [], L.packed
    monkeypatch.setattr(L, "packed", lambda m: made.append(1) or whole(m))
    want = L.RidgeLogistic(tol=1e-8).fit(df).coefficients.toArray()
    monkeypatch.setattr(L, "BLOCK_ROWS", 7)
    assert np.allclose(L.RidgeLogistic(tol=1e-8).fit(df).coefficients.toArray(), want, atol=1e-6) and len(made) == 2


def test_partial_sums_leave_as_one_row_a_task(spark, monkeypatch):
    from caliper.operators import nmf as NMF
    V = np.random.default_rng(4).random((20, 6))
    df = spark.createDataFrame([(i, list(range(6)), V[i].tolist()) for i in range(20)], "doc int, idx array<int>, val array<double>").repartition(3)
    Q, want = np.eye(6)[:, :2], V.T @ V @ np.eye(6)[:, :2]
    assert np.allclose(NMF._gram_times(df, Q), want)
    monkeypatch.setattr(NMF, "DRIVER_BYTES", 0)
    assert np.allclose(NMF._gram_times(df, Q), want)


def test_boosting_on_feature_rows_equals_boosting_on_all_rows(spark):
    from pyspark.ml import Pipeline
    from caliper.operators import models as M
    r = np.random.default_rng(5)
    df = spark.createDataFrame([(float(i % 7), "abc"[i % 3], float(i % 7 * (i % 3) + r.normal())) for i in range(300)], "n double, c string, label double")
    stages, gbt = M.tabular_stages(["n"], ["c"]), M.gbt_regressor(10, 0.1, 3)
    few, all_rows = M.fit_by_features(stages, gbt, df), Pipeline(stages=[*stages, gbt]).fit(df)
    a, b = ([x.prediction for x in m.transform(df).orderBy("n", "c", "label").collect()] for m in (few, all_rows))
    assert np.allclose(a, b)
    assert [t.depth for t in few.stages[-1].trees] == [t.depth for t in all_rows.stages[-1].trees]


def test_bootstrap_sums_are_those_of_rows(spark):
    from pyspark.ml.linalg import Vectors
    from caliper.operators import models as M
    sizes = [5, 40, 400]
    df = spark.createDataFrame([(Vectors.dense([float(c), 0.5]), float(c) + (i % 2)) for c, n in enumerate(sizes) for i in range(n)], ["features", "label"])
    rows = M.bootstrap_by_features(df.repartition(3), "features", "label", 300, 7).collect()
    assert len({(r.tree, r.features) for r in rows}) == len(rows) and {r.tree for r in rows} == set(range(300))
    for c, n in enumerate(sizes):
        of_c = {r.tree: r for r in rows if r.features[0] == c}
        w = np.array([of_c[t].weight if t in of_c else 0.0 for t in range(300)])
        # Poisson: a bootstrap of rows; weights times a draw of the whole vector would have a variance of n * n
        assert abs(w.mean() - n) < 6 * (n / 300) ** 0.5 and 0.6 < w.var() / n < 1.6
        assert abs(np.mean([r.label for r in of_c.values()]) - (c + (n // 2) / n)) < 0.1


def test_forest_on_feature_rows_is_like_the_forest_on_all_rows(spark, monkeypatch):
    from pyspark.ml import Pipeline
    from caliper.operators import models as M
    monkeypatch.setattr(M, "BOOTSTRAP_CELLS", 8)
    r = np.random.default_rng(5)
    df = spark.createDataFrame([(float(i % 7), None if i % 50 == 0 else float(i % 3), float(i % 7 * (i % 3) + r.normal())) for i in range(2000)], "n double, c double, label double")
    forest, seen = M.random_forest_regressor(12, 6), []
    fit = M.DecisionTreeRegressor.fit
    monkeypatch.setattr(M.DecisionTreeRegressor, "fit", lambda self, rows: seen.append(rows.count()) or fit(self, rows))
    few = M.fit_forest_by_features(M.tabular_stages(["n", "c"], impute=True, bins=32), forest, df)
    assert len(seen) == 12 and max(seen) <= 21
    assert few.stages[-1].getNumTrees == 12 and max(t.depth for t in few.stages[-1].trees) <= 6
    all_rows = Pipeline(stages=[*M.tabular_stages(["n", "c"], impute=True), forest]).fit(df)
    a, b = ([x.prediction for x in p.orderBy("n", "c", "label").collect()] for p in (few.transform(df), all_rows.transform(df)))
    assert np.allclose(a, b, atol=0.25)
    assert np.allclose(few.stages[-1].featureImportances.toArray(), all_rows.stages[-1].featureImportances.toArray(), atol=0.03)
    once = [x.prediction for x in M.predict_by_features(few, df).orderBy("n", "c", "label").collect()]
    assert np.allclose(once, a)


def test_boosted_classifier_on_bins_equals_boosting_on_all_rows(spark):
    from pyspark.ml import Pipeline
    from caliper.operators import models as M
    r = np.random.default_rng(6)
    xs = [*np.round(r.normal(size=900) * 50, 2), *[3.0] * 60]
    df = spark.createDataFrame([(float(x), "abc"[i % 3], float(x + 20 * (i % 3) + 30 * r.normal() > 20)) for i, x in enumerate(xs)],
                               "n double, c string, label double")
    gbt, seen = M.gbt_classifier(10, 0.1, 3), []
    fit = M.GBTClassifier.fit
    try:
        M.GBTClassifier.fit = lambda self, rows: seen.append(rows.count()) or fit(self, rows)
        few = M.fit_by_features(M.tabular_stages(["n"], ["c"], bins=32), gbt, df)
    finally:
        M.GBTClassifier.fit = fit
    assert seen and seen[0] <= 32 * 3 * 2
    all_rows = Pipeline(stages=[*M.tabular_stages(["n"], ["c"]), gbt]).fit(df)
    a, b = ([x.probability[1] for x in m.transform(df).orderBy("n", "c", "label").collect()] for m in (few, all_rows))
    assert np.allclose(a, b)
    odd = spark.createDataFrame([(1.0, 2.0), (None, float("nan")), (4.0, 2.0)], "a double, b double")
    out = M.QuantileBins(["a", "b"]).fit(odd).transform(odd).collect()
    assert [(r.a__bin, r.b__bin) for r in out] == [(0.0, 0.0), (None, None), (1.0, 0.0)]


def test_permuted_copies_are_not_broadcast(spark):
    from caliper.operators import explain as XP
    from caliper.operators.ranking import hash_rank
    base = hash_rank(spark.range(50).withColumn("v", F.col("id") * 2), "id", rank_col="pos")
    copies = XP.permuted_copies(base, "id", "v", 2)
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        plan = copies._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    assert plan.count("SortMergeJoin") >= 3
    assert copies.groupBy("rep").agg(F.sum("v").alias("s"), F.count("*").alias("n")).select("s", "n").distinct().collect() == [(2450, 50)]


def test_a_task_hands_on_one_row_a_feature_vector(spark, monkeypatch):
    from pyspark.ml.linalg import Vectors
    from caliper.operators import models as M
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "10")
    try:
        df = spark.createDataFrame([(Vectors.dense([float(i % 6)]), 1.0) for i in range(200)], ["features", "label"]).repartition(2)
        monkeypatch.setattr(M, "BOOTSTRAP_CELLS", 8)
        partial, kind, plain = [], type(df), type(df).mapInArrow
        monkeypatch.setattr(kind, "mapInArrow", lambda self, *a: partial.append(plain(self, *a)) or partial[-1])
        M.bootstrap_by_features(df, "features", "label", 4, 7)
        assert partial[0].count() == 12
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")


def _nmf_rows():
    V = np.random.default_rng(6).random((50, 8)) * (np.random.default_rng(7).random((50, 8)) < 0.6)
    return [(d, j, float(V[d, j])) for d in range(50) for j in range(8) if V[d, j] > 0], V


def test_nmf_packs_its_matrix_once_for_all_fits(spark, monkeypatch):
    from caliper.operators import nmf as NMF
    rows, _ = _nmf_rows()
    df, docs = spark.createDataFrame(rows, "doc_id long, idx int, v double"), spark.range(50).select(F.col("id").alias("doc_id"))
    fit = {"max_iter": 10, "tol": 0.0, "init": "nndsvda", "l2_w": 0.1, "l2_h": 0.1}
    alone = [NMF.fit_nmf(df, "doc_id", 8, k=k, docs=docs, **fit) for k in (2, 3)]
    monkeypatch.setattr(NMF, "BLOCK_ROWS", 4)                    # several blocks a task
    V, made = NMF.pack(df, "doc_id", docs), []
    monkeypatch.setattr(NMF, "_blocks", lambda v: made.append(1))
    for k, want in zip((2, 3), alone):
        got = NMF.fit_nmf(V, "doc_id", 8, k=k, **fit)
        assert np.allclose(got.H, want.H, atol=1e-8) and np.allclose([e for _, e in got.errors], [e for _, e in want.errors])
        assert {r.doc_id: [round(x, 7) for x in r.w] for r in got.W.collect()} == {r.doc_id: [round(x, 7) for x in r.w] for r in want.W.collect()}
    V.release()
    assert not made


def test_nmf_leaves_a_document_without_an_id_out_of_its_passes(spark):
    from caliper.operators import nmf as NMF
    rows, V = _nmf_rows()
    df = spark.createDataFrame(rows + [(None, 0, 5.0)], "doc_id long, idx int, v double")
    res = NMF.fit_nmf(df, "doc_id", 8, k=2, max_iter=30, tol=0.0)
    W = {r.doc_id: np.array(r.w) for r in res.W.collect()}
    assert None not in W and set(W) == {d for d, _, _ in rows}
    assert np.linalg.norm(V - np.array([W.get(d, np.zeros(2)) for d in range(50)]) @ res.H) < 0.8 * np.linalg.norm(V)


def _count_vectors(spark, n=300, terms=40):
    from pyspark.ml.linalg import Vectors
    rng = np.random.default_rng(8)
    topics = rng.dirichlet(np.full(terms, 0.1), 3)
    rows = []
    for i in range(n):
        c = rng.multinomial(rng.integers(0, 80), topics[i % 3] * 0.9 + topics[(i + 1) % 3] * 0.1)
        rows.append((i, Vectors.sparse(terms, [(int(j), float(c[j])) for j in np.flatnonzero(c)])))
    return spark.createDataFrame(rows, ["doc_id", "features"]).repartition(3)


def test_gamma_functions():
    import math
    from caliper.operators import lda as LD
    x = np.array([1e-3, 0.05, 0.7, 1.0, 3.3, 40.0, 1e5])
    assert np.allclose(LD.lgamma(x), [math.lgamma(v) for v in x], rtol=1e-11, atol=1e-11)
    h = 1e-4 * x
    assert np.allclose(LD.digamma(x), (LD.lgamma(x + h) - LD.lgamma(x - h)) / (2 * h), rtol=1e-6)


def test_extrapolated_mixtures_end_where_plain_steps_do(monkeypatch):
    from caliper.operators import lda as LD
    rng = np.random.default_rng(9)
    B, C, alpha = rng.dirichlet(np.full(60, 0.2), 4).T, rng.poisson(3.0, (50, 60)).astype(float), np.full(4, 0.25)
    start, steps = rng.gamma(100, 0.01, (50, 4)), []
    whole = LD.digamma
    monkeypatch.setattr(LD, "digamma", lambda x: steps.append(len(x)) or whole(x))
    args = (np.tile(B, (50, 1, 1)) + 1e-6, C, alpha, start, 1e-9)
    plain, n_plain = LD._mixtures(*args, rounds=0), sum(steps)
    steps.clear()
    assert np.allclose(LD._mixtures(*args), plain, atol=1e-5) and sum(steps) < 0.7 * n_plain
    assert np.allclose(LD._mixtures(*args, rounds=2), plain, atol=1e-5)


def test_lda_on_blocks_is_the_model_of_spark(spark, monkeypatch):
    """Bound and mixtures of one model are those of ``pyspark.ml``, and so, near enough, is the fit."""
    from pyspark.ml.clustering import LDA
    from caliper.operators import lda as LD, models as M, topics as T
    x = _count_vectors(spark)
    monkeypatch.setattr(LD, "CELLS", 2000)                                   # several groups of documents a block
    lda = M.online_lda(k=3, passes=20, subsampling_rate=0.5)
    model = lda.fit(x)
    theirs = LDA(k=3, optimizer="online", maxIter=40, subsamplingRate=0.5, learningOffset=50.0, learningDecay=0.7,
                 optimizeDocConcentration=False, seed=42).fit(x)
    for m in (model, theirs):
        assert T.lda_perplexity(m, x) == pytest.approx(np.exp(m.logPerplexity(x)), rel=1e-3)
    assert T.lda_perplexity(model, x) < 1.1 * T.lda_perplexity(theirs, x)                # draws differ
    assert model.vocabSize() == 40 and model.getK() == 3 and model.describeTopics(5).count() == 3
    got = {r.doc_id: r.distribution for r in T.lda_distribution(model, x, "doc_id").collect()}
    weight, off = np.exp(LD._topic_weights(model.topicsMatrix().toArray())), []
    for r in x.where("doc_id < 40").collect():
        v = r.features
        if len(v.indices):
            g, _ = LD.infer(np.array([len(v.indices)]), v.indices.astype(np.int64), v.values, weight, np.full(3, 1 / 3), np.ones((1, 3)))
            off.append(np.abs(g[0] / g[0].sum() - got[r.doc_id]).max())
    assert np.median(off) < 0.02                                       # plain steps may end far from where they lead


def test_topic_sweep_packs_its_vectors_once(spark, monkeypatch):
    from caliper.operators import lda as LD
    from caliper.plans import topic_queries as TQ
    made, whole = [], LD.pack
    monkeypatch.setattr(LD, "pack", lambda *a: made.append(1) or whole(*a))
    assert [k for k, _, _ in TQ._sweep(_count_vectors(spark), (2, 3), passes=1)] == [2, 3] and len(made) == 1


def test_null_count_vectors_are_refused(spark):
    from caliper.operators import lda as LD
    x = _count_vectors(spark, 10)
    with pytest.raises(Exception, match="a count vector is null"):
        LD.pack(x.select(F.when(F.col("doc_id") != 3, F.col("features")).alias("features")))


def test_passes_work_on_slices_of_a_block(spark, monkeypatch):
    """Sums do not depend on the slices; rows without an entry count."""
    from pyspark.ml.linalg import Vectors
    from caliper.operators import logistic as L
    r = np.random.default_rng(11)
    X = r.normal(size=(70, 5)) * (r.random((70, 5)) < 0.4)
    X[[0, 31, 69]] = 0.0
    y, w, theta = (r.random(70) > 0.5).astype(float), r.random(70), r.normal(size=(2, 6))
    rows = [(Vectors.sparse(5, {int(j): float(x[j]) for j in np.flatnonzero(x)}), float(a), float(b)) for x, a, b in zip(X, y, w)]
    df, seen = spark.createDataFrame(rows, ["x", "y", "w"]).repartition(2), []
    z = X @ theta[:, :5].T + theta[:, 5]
    miss = w[:, None] * (1 / (1 + np.exp(-z)) - y[:, None])
    want = np.column_stack([miss.T @ X, miss.sum(0), (w[:, None] * (np.logaddexp(0, z) - y[:, None] * z)).sum(0), [w.sum()] * 2])
    for n in (256, 8, 1):
        monkeypatch.setattr(L, "SLICE_ROWS", n)
        blocks = list(L._pack(df.toArrow().combine_chunks().to_batches()))
        seen.append([len(s[0]) for b in blocks for s in L._sliced(*(c[0].as_py() for c in b.columns))])
        assert np.allclose(L.pass_over(L.packed(df), theta), want)
    assert max(seen[1]) == 8 and sum(map(sum, seen)) == 210

"""Model stages, NMF, kNN/SMOTE, streaming and the driver contract."""

import os

import numpy as np
import pytest
from pyspark.ml import Pipeline
from pyspark.sql import functions as F

from caliper.operators import features as FT
from caliper.operators import models as M
from caliper.operators import nmf as NMF
from caliper.operators import smote as SM
from caliper.sources import io as IO

from conftest import SF001


def test_population_scaler_and_imputer(spark):
    df = spark.createDataFrame([(1.0,), (2.0,), (3.0,), (None,)], "x double")
    imp = M.MedianImputer(["x"]).fit(df)
    out = imp.transform(df)
    assert [r.x__imp for r in out.collect()] == [1.0, 2.0, 3.0, 2.0]
    sc = M.PopulationScaler(["x__imp"]).fit(out).transform(out)
    vals = [r.x__imp__sc for r in sc.collect()]
    std = np.std([1.0, 2.0, 3.0, 2.0])  # population std
    assert vals[0] == pytest.approx((1.0 - 2.0) / std)


def test_one_hot_unknown_is_zero(spark):
    train = spark.createDataFrame([("a",), ("b",)], "c string")
    test = spark.createDataFrame([("a",), ("z",), (None,)], "c string")
    model = Pipeline(stages=M.one_hot_stages(["c"])).fit(train)
    vecs = [r.c__ohe.toArray().tolist() for r in model.transform(test).collect()]
    assert vecs == [[1.0, 0.0], [0.0, 0.0], [0.0, 0.0]]


def test_logistic_regparam_scaling():
    lr = M.logistic_regression(C=2.0, n_rows=100)
    assert lr.getRegParam() == pytest.approx(1 / 200) and not lr.getStandardization()


def test_nmf_properties(spark):
    rng = np.random.default_rng(0)
    W0, H0 = rng.random((30, 3)), rng.random((3, 12))
    V = W0 @ H0
    rows = [(d, j, float(V[d, j])) for d in range(30) for j in range(12)]
    Vdf = spark.createDataFrame(rows, "doc_id int, idx int, v double")
    res = NMF.fit_nmf(Vdf, "doc_id", 12, k=3, max_iter=40, tol=0.0, check_every=10)
    errs = [e for _, e in res.errors]
    assert all(b <= a + 1e-9 for a, b in zip(errs, errs[1:]))
    assert (res.H >= 0).all()
    assert res.W.where(F.exists("w", lambda x: x < 0)).count() == 0
    assert errs[-1] < np.linalg.norm(V) * 0.5


def test_knn_matches_brute_force(spark):
    rng = np.random.default_rng(1)
    X = rng.random((60, 4))
    df = spark.createDataFrame([(i, X[i].tolist()) for i in range(60)], "k long, v array<double>")
    got = {(r.k, r.rank): r.nn_key for r in SM.knn(df, df, "k", "v", k=3, block_rows=25).collect()}
    for i in range(60):
        d = ((X - X[i]) ** 2).sum(1)
        d[i] = np.inf
        order = sorted(range(60), key=lambda j: (d[j], j))[:3]
        for r, j in enumerate(order, 1):
            assert got[(i, r)] == j


def test_smote_counts_and_segments(spark):
    rng = np.random.default_rng(2)
    rows = [(i, rng.random(3).tolist(), 1 if i < 12 else 0) for i in range(80)]
    df = spark.createDataFrame(rows, "k long, v array<double>, y int")
    out = SM.smote(df, "k", "v", "y", minority=1, k=3)
    c = {r.y: r["count"] for r in out.groupBy("y").count().collect()}
    assert c[1] == c[0] == 68
    mins = np.array([r[1] for r in rows if r[2] == 1])
    for r in out.where("synthetic").collect():
        p = np.array(r.v)
        seed = mins[int(r.k.split("#")[0])]
        # p lies on a segment from its seed to some minority point
        ok = False
        for q in mins:
            d = q - seed
            if np.allclose(d, 0):
                continue
            u = float(np.dot(p - seed, d) / np.dot(d, d))
            if -1e-9 <= u <= 1 + 1e-9 and np.allclose(seed + u * d, p, atol=1e-9):
                ok = True
                break
        assert ok


def test_sources_roundtrip(spark, tmp_path):
    df = spark.read.parquet(f"{SF001}/nation.parquet")
    p = str(tmp_path / "nation_csv")
    IO.write_table(df, p, fmt="csv")
    back = IO.read_csv(spark, p, schema=df.schema)
    assert back.count() == df.count()
    with pytest.raises(ValueError):
        IO.require_columns(df, ["n_nationkey", "nope"])
    assert IO.path_exists(spark, p) and not IO.path_exists(spark, p + "_missing")
    got = IO.read_with_fallback(spark, [p + "_missing", p], lambda x: IO.read_csv(spark, x, df.schema), drop=["n_name"])
    assert "n_name" not in got.columns
    tsv = tmp_path / "msgs.tsv"
    tsv.write_text('ham\tHello "there"\nspam\tWIN now\n')
    m = IO.read_labelled_tsv(spark, str(tsv)).collect()
    assert [(r.label, r.text) for r in m] == [("ham", 'Hello "there"'), ("spam", "WIN now")]
    sp = str(tmp_path / "split")
    IO.persist_split(df.withColumn("split", F.when(F.col("n_nationkey") < 5, "test").otherwise("train")), sp)
    assert IO.read_split(spark, sp, "test").count() == 5


def test_entry_and_registry(spark):
    import __spark_entry__ as E
    out = E.entry(spark)
    assert out.columns == ["quality", "term", "count", "rank"] and out.count() > 0
    qs, sqls = E.queries(), E.oracle_sql()
    assert set(sqls) <= set(qs) and len(qs) >= 100


def test_stream_equals_batch(spark, tmp_path):
    from caliper.operators.score import score_messages
    from caliper.plans.model_queries import _text_model
    from caliper.streaming.score_stream import score_available
    docs = spark.read.parquet(f"{SF001}/documents.parquet").join(spark.read.parquet(f"{SF001}/labels.parquet"), "doc_id")
    model = _text_model(docs.select("doc_id", "text", F.col("toxic").cast("double").alias("label")),
                        C=10.0, vocab=500, ngram=(1, 1), profile="spam")
    conv = spark.read.parquet(f"{SF001}/conversations.parquet")
    schema = conv.schema
    s = score_available(model, spark, SF001, schema, F.concat_ws(":", "conv_id", "turn"),
                        file_glob="conversations.parquet")
    b = score_messages(model, conv.select(F.concat_ws(":", "conv_id", "turn").alias("msg_id"), "text"), "msg_id")
    assert sorted(s.collect()) == sorted(b.collect())


def test_json_record_scan(spark, tmp_path):
    from pyspark.sql import types as T
    p = tmp_path / "one.json"
    p.write_text('{\n  "MedInc": 3.5,\n  "Latitude": 37.8,\n  "Longitude": -122.2\n}\n')
    schema = T.StructType([T.StructField(c, T.DoubleType()) for c in ("MedInc", "Latitude", "Longitude")])
    rows = IO.read_json_records(spark, str(p), schema, multiline=True).collect()
    assert len(rows) == 1 and rows[0].MedInc == 3.5


def test_what_if_savings(spark):
    from pyspark.ml.feature import SQLTransformer
    from caliper.operators.score import what_if
    model = SQLTransformer(statement="SELECT *, x * 2.0 AS prediction FROM __THIS__")
    df = spark.createDataFrame([(1, 1.0, "no"), (2, 5.0, "yes")], "k int, x double, smoker string")
    out = {r.k: r for r in what_if(model, df, "k", {
        "cap": (F.col("x") > 3, {"x": F.lit(3.0)}),
        "quit": (F.col("smoker") == "yes", {"smoker": F.lit("no")})}).collect()}
    assert out[1].base == 2.0 and out[1].cap is None and out[1].saving_cap is None
    assert out[2].base == 10.0 and out[2].cap == 6.0 and out[2].saving_cap == 4.0
    assert out[2].saving_quit == 0.0  # the stand-in model ignores smoker


def test_nmf_keeps_documents_without_terms(spark):
    V = spark.createDataFrame([(d, j, 1.0) for d in range(20) for j in range(6) if (d + j) % 2], "doc_id long, idx int, v double")
    docs = spark.range(25).select(F.col("id").alias("doc_id"))
    for init in ("random", "nndsvda"):
        res = NMF.fit_nmf(V, "doc_id", 6, k=2, max_iter=20, docs=docs, init=init)
        assert res.W.count() == 25 and res.errors[-1][1] < 0.5
        dist = NMF.nmf_transform(V, "doc_id", res.H, n_iter=20, docs=docs)
        assert {r.doc_id for r in dist.collect() if sum(r.distribution) == 0} == set(range(20, 25))


def test_strip_accents_over_all_of_unicode(spark):
    texts = [("Việt ﬁn ά ẛ", "Viet fin α s"), ("plain", "plain"), (None, None), ("Å½ é", "A1⁄2 e"), ("ё", "е")]
    from caliper.functions import text as X
    got = spark.createDataFrame([(i, t) for i, (t, _) in enumerate(texts)], "i int, t string").select("i", X.strip_accents("t").alias("t"))
    assert {r.i: r.t for r in got.collect()} == {i: w for i, (_, w) in enumerate(texts)}


def test_knn_far_from_the_origin(spark):
    rows = [(i, [1e8 + 0.01 * i, 1e8]) for i in range(200)]
    df = spark.createDataFrame(rows, "k int, v array<double>")
    got = {(r.k, r.rank): r.nn_key for r in SM.knn(df, df, "k", "v", k=2, block_rows=30).collect()}
    assert all({got[i, 1], got[i, 2]} == {i - 1, i + 1} for i in range(1, 199))


def test_permuted_copies_keep_the_multiset(spark):
    from caliper.operators import explain as XP
    from caliper.operators.ranking import hash_rank
    df = spark.range(50).select(F.col("id").alias("k"), (F.col("id") * 3).alias("x"), F.col("id").alias("y"))
    out = XP.permuted_copies(hash_rank(df, "k", seed=1, rank_col="pos"), "k", "x", 4).collect()
    for rep in range(4):
        part = [r for r in out if r.rep == rep]
        assert sorted(r.x for r in part) == sorted(3 * i for i in range(50)) and sorted(r.k for r in part) == list(range(50))
        assert any(r.x != 3 * r.k for r in part) and all(r.y == r.k for r in part)


def test_permutation_importance_ranks_the_used_column_first(spark):
    from pyspark.ml.feature import SQLTransformer
    from caliper.operators import explain as XP
    model = SQLTransformer(statement="SELECT *, CASE WHEN x > 20 THEN 1.0 ELSE 0.0 END AS prediction FROM __THIS__")
    df = spark.range(60).select(F.col("id").alias("k"), F.col("id").alias("x"), (F.col("id") % 7).alias("z"), (F.col("id") > 20).cast("int").alias("label"))
    out = XP.permutation_importance(model, df, "k", ["z", "x"], n_repeats=5).collect()
    assert [r.feature for r in out] == ["x", "z"] and out[0].importance_mean > 0.1 and out[1].importance_mean == 0


def test_coefficient_and_importance_tables(spark):
    from pyspark.ml.linalg import Vectors
    from caliper.operators import explain as XP
    out = XP.importance_table(spark, ["a", "b"], Vectors.dense([0.2, 0.8])).collect()
    assert [(r.feature, r.importance) for r in out] == [("b", 0.8), ("a", 0.2)]


def test_median_of_a_column_without_values(spark):
    from caliper.operators import models as M
    df = spark.createDataFrame([(1.0, None), (3.0, None), (None, None)], "a double, b double")
    out = M.MedianImputer(["a", "b"]).fit(df).transform(df).collect()
    assert sorted(r.a__imp for r in out) == [1.0, 2.0, 3.0] and all(r.b__imp is None for r in out)


def test_knn_ships_rows_only_where_a_nearer_one_can_be(spark):
    """Clustered rows, ties included: equal to brute force, and far fewer shipments than rows times blocks."""
    import numpy as np
    from pyspark.sql import functions as F
    r = np.random.default_rng(4)
    centres = r.normal(size=(20, 3)) * 100
    pts = np.round(np.concatenate([c + r.normal(size=(60, 3)) for c in centres]), 1)
    pts[5] = pts[6] = pts[7]
    df = spark.createDataFrame([(i, [float(x) for x in p]) for i, p in enumerate(pts)], "k long, v array<double>")
    got = {(x.k, x["rank"]): (x.nn_key, x.dist) for x in SM.knn(df, df, "k", "v", k=4, block_rows=30).collect()}
    d = np.sqrt(((pts[:, None] - pts[None]) ** 2).sum(2))
    for i in range(len(pts)):
        best = sorted((d[i, j], j) for j in range(len(pts)) if j != i)[:4]
        assert [got[i, n + 1][0] for n in range(4)] == [j for _, j in best]
        assert np.allclose([got[i, n + 1][1] for n in range(4)], [x for x, _ in best])
    cells, rows = SM.cells_of(df, "k", 30, 1024)
    ask = rows.withColumn("reach", F.lit(3.0))
    blocks = int(cells.pieces.sum())
    assert blocks >= 40 and SM.shipments(ask, cells, "k", "long").count() < len(pts) * blocks / 8
    assert SM.knn(df, df.limit(0), "k", "v").count() == 0 and SM.knn(df.limit(0), df, "k", "v").count() == 0
    few = SM.knn(df, df.where("k < 3"), "k", "v", k=4).groupBy("k").count()
    assert {x["count"] for x in few.where("k >= 3").collect()} == {3}


def test_nmf_equals_dense_coordinate_descent(spark):
    """The distributed passes, scaled penalties included, are those of a dense factorisation from the same start."""
    rng = np.random.default_rng(3)
    V = np.maximum(0, rng.random((40, 4)) @ rng.random((4, 15)) - 0.6)
    Vdf = spark.createDataFrame([(d, j, float(V[d, j])) for d in range(40) for j in range(15) if V[d, j] > 0], "doc_id int, idx int, v double")
    Vd = spark.createDataFrame([(d, [j for j in range(15) if V[d, j] > 0], [float(x) for x in V[d] if x > 0]) for d in range(40)], "doc int, idx array<int>, val array<double>")
    W, H = NMF._nndsvda(Vd, 40, 15, 4, float(V.sum() / 600), seed=42)
    W = np.array([r.w for r in W.orderBy("doc").collect()])
    objective = lambda: (0.5 * ((V - W @ H) ** 2).sum() + 0.002 * 15 * (0.5 * W.sum() + 0.25 * (W ** 2).sum())
                         + 0.001 * 40 * (0.5 * H.sum() + 0.25 * (H ** 2).sum()))
    values = [objective()]
    for _ in range(5):
        W = NMF.coordinate_sweeps(W, V @ H.T, H @ H.T, 0.015, 0.015, 10)
        H = NMF.coordinate_sweeps(H.T, V.T @ W, W.T @ W, 0.02, 0.02, 10).T
        values.append(objective())
    assert all(y <= x for x, y in zip(values, values[1:]))
    res = NMF.fit_nmf(Vdf, "doc_id", 15, k=4, max_iter=5, tol=0.0, init="nndsvda", docs=spark.range(40).selectExpr("cast(id as int) doc_id"),
                      alpha_w=0.002, alpha_h=0.001, l1_ratio=0.5)
    assert np.allclose(res.H, H, atol=1e-6)
    assert np.allclose([r.w for r in res.W.orderBy("doc_id").collect()], W, atol=1e-6)


def test_nndsvda_equals_the_dense_start(spark):
    rng = np.random.default_rng(5)
    V = rng.random((30, 12))
    Vd = spark.createDataFrame([(d, list(range(12)), [float(x) for x in V[d]]) for d in range(30)], "doc long, idx array<int>, val array<double>")
    W, H = NMF._nndsvda(Vd, 30, 12, 3, float(V.mean()), seed=1)
    u, s, vt = np.linalg.svd(V, full_matrices=False)
    W = np.array([r.w for r in W.orderBy("doc").collect()])
    assert np.allclose(W[:, 0], np.sqrt(s[0]) * np.abs(u[:, 0]), atol=1e-6) and np.allclose(H[0], np.sqrt(s[0]) * np.abs(vt[0]), atol=1e-6)


def test_binned_density_keeps_its_bound(spark):
    import math
    from caliper.operators import profile as A
    r = np.random.default_rng(2)
    x = np.concatenate([r.normal(size=400), 4 + r.normal(size=200) / 2])
    df = spark.createDataFrame([(float(v),) for v in x], "x double")
    exact = [a.density for a in A.kde(df, "x", 50).collect()]
    h = x.std(ddof=1) * len(x) ** -0.2
    for bins in (40, 500):
        d = (x.max() - x.min()) / bins
        got = [a.density for a in A.kde(df, "x", 50, binned=True, n_bins=bins).collect()]
        assert max(abs(a - b) for a, b in zip(got, exact)) <= d ** 2 / (8 * math.sqrt(2 * math.pi) * h ** 3)


def test_cleaner_switches(spark):
    from caliper.operators.stages import TextCleaner
    df = spark.createDataFrame([("The CATS and Dogs run",)], "text string")
    clean = lambda **kw: TextCleaner("text", "t", **kw).transform(df).first().t
    assert clean(profile="topic", lowercase=False, removeStopwords=False) == ["The", "CATS", "and", "Dogs", "run"]
    assert clean(profile="topic", lemmas={"cats": "cat", "dogs": "the"}) == ["cat", "run"]
    assert clean(lemmas={"dogs": "dog"}) == ["cats", "dog", "run"]


def test_grid_with_shared_features_equals_the_plain_search(spark):
    from pyspark.ml import Pipeline
    from caliper.operators.features import FeatureGrid, SmoothTfidf
    rows = [(i, i % 3, float(i % 2), [f"w{j}" for j in range(12) if (i * 7 + j * (2 + i % 2)) % 5 < 2]) for i in range(60)]
    df = spark.createDataFrame(rows, "doc_id int, fold int, label double, toks array<string>")
    out = []
    for make in (lambda t, c: Pipeline(stages=[t, c]), FeatureGrid):
        tfidf, lr = SmoothTfidf("toks", "features"), M.logistic_regression(C=1.0, n_rows=40, max_iter=50)
        grid = {tfidf.vocabSize: [12, 50], lr.regParam: [0.001, 0.1]}
        cv = M.grid_search(make(tfidf, lr), grid, "fold", n_folds=3).fit(df)
        out.append([(p["vocabSize"], p["regParam"], round(m, 6), round(s, 6)) for p, m, s in M.cv_summary(cv)])
        assert cv.bestModel.transform(df).count() == 60
    assert out[0] == out[1]


def test_tfidf_keeps_terms_of_many_documents(spark):
    """A ``maxDF`` of 1.0 is the share of all documents."""
    from caliper.operators.features import SmoothTfidf
    df = spark.createDataFrame([(["a", "b"],), (["a", "c"],), (["a"],)], "toks array<string>")
    model = SmoothTfidf("toks", "v").fit(df)
    assert sorted(model.stages[0].vocabulary) == ["a", "b", "c"]
    first = model.transform(df).first().v
    want = np.array([1.0, np.log(4 / 2) + 1])               # smoothed idf + 1 of a and b
    assert sorted(first.values) == pytest.approx(sorted(want / np.linalg.norm(want)))


def test_shared_logistic_equals_the_plain_one(spark, monkeypatch):
    """Sparse and dense vectors, weights, nulls; a grid's penalties share passes and fit as each alone does."""
    from pyspark.ml.classification import LogisticRegression
    from pyspark.ml.linalg import Vectors
    from caliper.operators import logistic as L
    r, rows = np.random.default_rng(1), []
    for i in range(200):
        at, v = sorted(r.choice(12, 4, replace=False).tolist()), r.normal(size=4)
        x = Vectors.sparse(12, at, v.tolist())
        rows.append((x if i % 3 else Vectors.dense(x.toArray()), float(v.sum() + r.normal() > 0), float(1 + i % 3)))
    df = spark.createDataFrame(rows, ["features", "label", "w"]).repartition(3).cache()
    nulls = df.unionByName(df.limit(5).withColumn("label", F.lit(None).cast("double")))
    e = L.RidgeLogistic(weightCol="w", tol=1e-9)
    passes, whole = [], L.pass_over
    monkeypatch.setattr(L, "pass_over", lambda m, t: passes.append(len(t)) or whole(m, t))
    both = dict(e.fitMultiple(nulls, [{e.regParam: 0.01}, {e.regParam: 0.2}]))
    assert max(passes) == 2 and len(passes) < 60
    for i, reg in enumerate((0.01, 0.2)):
        want = LogisticRegression(regParam=reg, standardization=False, tol=1e-12, maxIter=1000, weightCol="w").fit(df)
        assert np.allclose(both[i].coefficients.toArray(), want.coefficients.toArray(), atol=1e-3)
        assert abs(both[i].intercept - want.intercept) < 1e-3
        assert both[i].transform(df).where("prediction = label").count() == want.transform(df).where("prediction = label").count()
    monkeypatch.setattr(L, "DRIVER_BYTES", 0)               # sums added in a tree of tasks
    tree = L.RidgeLogistic(weightCol="w", tol=1e-9, regParam=0.2).fit(df)
    assert np.allclose(tree.coefficients.toArray(), both[1].coefficients.toArray(), atol=1e-6)
    for bad in (df.where("false"), df.withColumn("w", F.lit(0.0))):
        with pytest.raises(ValueError):
            e.fit(bad)
    with pytest.raises(ValueError):
        L.RidgeLogistic(regParam=0.0).fit(df)


def test_features_grid_hands_one_matrix_to_all_penalties(spark):
    from caliper.operators.features import FeatureGrid, SmoothTfidf
    from caliper.operators.logistic import RidgeLogistic
    rows = [(i % 3, float(i % 2), [f"w{j}" for j in range(12) if (i * 7 + j * (2 + i % 2)) % 5 < 2]) for i in range(60)]
    df = spark.createDataFrame(rows, "fold int, label double, toks array<string>")
    tfidf = SmoothTfidf("toks", "features")
    cv = M.grid_search(FeatureGrid(tfidf, RidgeLogistic(tol=1e-8)), {tfidf.vocabSize: [12, 50]}, "fold", n_folds=3).fit(df)
    plain = M.grid_search(FeatureGrid(tfidf, M.logistic_regression(C=1.0, n_rows=100.0)), {tfidf.vocabSize: [12, 50]}, "fold", n_folds=3).fit(df)
    assert [round(m, 3) for _, m, _ in M.cv_summary(cv)] == [round(m, 3) for _, m, _ in M.cv_summary(plain)]


def test_document_share_is_counted_before_the_vocabulary_fit(spark, monkeypatch):
    """Spark gets a number of rows (given a share it persists all token arrays), and the terms are those of the share."""
    from pyspark.ml.feature import CountVectorizer
    seen, fit = [], CountVectorizer.fit
    monkeypatch.setattr(CountVectorizer, "fit", lambda self, df, *a: seen.append(self.getMaxDF()) or fit(self, df, *a))
    df = spark.createDataFrame([(i, ["all"] + ["most"] * (i < 18) + ["few"] * (i < 2) + [f"one{i}"]) for i in range(20)]
                               + [(20, ["all"])], "id int, toks array<string>")
    cv = FT.count_vectorizer(df, "toks", 10, min_df=2.0, max_df=0.95)
    assert seen == [0.95 * 21] and set(cv.vocabulary) == {"most", "few"}
    assert set(FT.count_vectorizer(df, "toks", 10, min_df=2.0, max_df=0.8).vocabulary) == {"few"}
    assert set(cv.vocabulary) == set(CountVectorizer(inputCol="toks", outputCol="f", minDF=2.0, maxDF=0.95).fit(df).vocabulary)


def test_topic_models_fitted_side_by_side_equal_those_fitted_alone(spark):
    """the sweep fits models at the same time; rows and their order are those of one fit after the other."""
    from pyspark.ml.linalg import Vectors
    from caliper.plans import topic_queries as TQ
    counts = [sorted({i * j % 12: 1.0 + j for j in range(1, 5)}.items()) for i in range(40)]
    x = spark.createDataFrame([(i, Vectors.sparse(12, c)) for i, c in enumerate(counts)], ["doc_id", "features"])
    beside, alone = TQ._sweep(x, (4, 2, 3), passes=1), TQ._sweep(x, (4, 2, 3), passes=1, parallelism=1)
    assert [r[0] for r in beside] == [4, 2, 3] and np.allclose(beside, alone, rtol=1e-9)

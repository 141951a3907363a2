"""Text functions and profiling on hand-made edge frames."""

import pytest
from pyspark.sql import functions as F

from caliper.functions import columns as C
from caliper.functions import text as X
from caliper.functions.porter import stem
from caliper.operators import profile as A
from caliper.operators import textjobs as TJ


def _one(spark, expr, value, schema="t string"):
    return spark.createDataFrame([(value,)], schema).select(expr.alias("o")).first().o


def test_strip_html_and_sentiment(spark):
    assert _one(spark, X.strip_html("t"), "good<br/>bad") == "goodbad"
    assert _one(spark, X.strip_html("t"), "a<b\nc>d") == "a<b\nc>d"  # '.' stops at a line break
    toks = _one(spark, X.clean_sentiment("t"), "The <b>MOVIE</b> was   great, great!")
    assert toks == ["movie", "great", "great"]  # duplicates kept, stop words dropped
    assert _one(spark, X.clean_sentiment("t"), "") == []


def test_spam_and_topic_cleaners(spark):
    assert _one(spark, X.clean_spam("t"), "Héllo,  WORLD_1!") == "héllo world_1 "
    t = "From: a@b.com\nSubject: hi\nVisit http://x.y now, 42 cats!"
    assert _one(spark, X.clean_topic("t"), t) == ["visit", "cats"]
    assert _one(spark, X.clean_topic("t"), None) == []


def test_ngrams_and_tokens(spark):
    assert _one(spark, X.ngrams(F.col("t"), 1, 2), ["a", "b", "c"], "t array<string>") == ["a", "b", "c", "a b", "b c"]
    assert _one(spark, X.ngrams(F.col("t"), 2, 2), ["a"], "t array<string>") == []
    assert _one(spark, X.vectorizer_tokens("t", "letters3"), "abc ab1 abcd_e défg xyz") == ["abc", "xyz"]
    assert _one(spark, X.strip_accents("t"), "Café déjà") == "Cafe deja"


def test_bands_right_closed(spark):
    df = spark.createDataFrame([(x,) for x in (0.0, 25.0, 30.0, 30.0001, 45.0, 60.0, 100.0, 101.0, None)], "x double")
    got = [r.b for r in df.select(C.band("x", C.BMI_BANDS).alias("b")).collect()]
    assert got == [None, "normal", "overweight", "obese", "severely_obese", "severely_obese", "severely_obese", None, None]


def test_clip_keeps_null_and_label_map(spark):
    df = spark.createDataFrame([(5.0,), (None,), (-1.0,)], "x double")
    assert [r.o for r in df.select(C.clip("x", 0.0, 1.0).alias("o")).collect()] == [1.0, None, 0.0]
    df = spark.createDataFrame([("ham",), ("spam",), ("other",)], "l string")
    assert [r.o for r in df.select(C.map_values("l", {"ham": 0, "spam": 1}).alias("o")).collect()] == [0, 1, None]


def test_describe_and_histogram(spark):
    df = spark.createDataFrame([(float(x),) for x in [1, 2, 3, 4, 100]] + [(None,)], "x double")
    d = A.describe(df, ["x"]).first()
    assert d["count"] == 5 and d.p25 == 2.0 and d.p50 == 3.0 and d.p75 == 4.0
    h = A.histogram(df, "x", bins=4).collect()
    assert [r["count"] for r in h] == [4, 0, 0, 1]  # last bin closed


def test_value_counts_drop_null(spark):
    df = spark.createDataFrame([("a",), ("b",), ("a",), (None,)], "v string")
    assert [(r.v, r["count"]) for r in A.value_counts(df, "v").collect()] == [("a", 2), ("b", 1)]


def test_porter_and_stem_job(spark):
    assert [stem(w) for w in ["caresses", "ponies", "hopping", "generalizations", "sky"]] == \
        ["caress", "poni", "hop", "gener", "sky"]
    df = spark.createDataFrame([(1, ["running", "cats", "running"]), (2, [])], "k int, t array<string>")
    out = {r.k: r.s for r in TJ.stem_tokens(df, "k", "t", "s").collect()}
    assert out == {1: ["run", "cat", "run"], 2: []}


def test_umass_pairs(spark):
    from caliper.operators.topics import umass_coherence
    top = spark.createDataFrame([(0, 1, "a"), (0, 2, "b")], "topic int, rank int, term string")
    dt = spark.createDataFrame([(1, "a"), (1, "b"), (2, "a"), (3, "b")], "doc_id int, term string")
    import math
    got = umass_coherence(top, dt).first().coherence
    assert got == pytest.approx(math.log((1 + 1) / 2))


def test_kde_binned_close_to_exact(spark):
    import random
    rnd = random.Random(7)
    df = spark.createDataFrame([(rnd.gauss(0, 1),) for _ in range(2000)], "x double")
    a = [r.density for r in A.kde(df, "x").collect()]
    b = [r.density for r in A.kde(df, "x", binned=True).collect()]
    assert max(abs(x - y) for x, y in zip(a, b)) < 1e-3 * max(a)
    # the density integrates to ~1 over the grid
    xs = [r.x for r in A.kde(df, "x").collect()]
    assert abs(sum(a) * (xs[1] - xs[0]) - 1.0) < 0.01


def test_tfidf_term_in_every_document(spark):
    import math
    from caliper.operators import features as FT
    df = spark.createDataFrame([(1, ["a", "b"]), (2, ["a"]), (3, ["a", "c", "c"])], "d int, t array<string>")
    tf = FT.term_frequencies(df, "d", "t")
    vocab = FT.fit_vocabulary(tf, 3, max_features=10, min_df=1, max_df=1.0)
    w = {(r.d, r.term): r.weight for r in FT.tfidf(tf, vocab, 3, "d", norm=None, vocab_bound=10).collect()}
    assert w[(2, "a")] == pytest.approx(1.0)  # smoothed idf of a term in every document is 1, not 0
    assert w[(3, "c")] == pytest.approx(2 * (math.log(4 / 2) + 1))

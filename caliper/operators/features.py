"""Text features in long form and as ``pyspark.ml`` stages.

The long form ``(doc, term, tf)`` is the distributed sparse matrix: one
``groupBy(doc, term)`` builds it, one ``groupBy(term)`` gives document
frequencies, and the vocabulary (capped by ``max_features``) is the only
table that may be broadcast, because its size is bounded by that cap.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence
from threading import Lock

import numpy as np
from pyspark.ml import Estimator, PipelineModel
from pyspark.ml.feature import CountVectorizer, CountVectorizerModel, ElementwiseProduct, IDF, Normalizer
from pyspark.ml.linalg import DenseVector
from pyspark.ml.param.shared import HasInputCol, HasOutputCol, Param, Params, TypeConverters
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsWritable
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from caliper.functions.text import explode_tokens
from caliper.operators.ranking import lookup_join
from caliper.session import stored


def term_frequencies(df: DataFrame, doc_col: str, tokens_col: str, term_col: str = "term") -> DataFrame:
    """``(doc, term, tf)``: the sparse document-term matrix, aggregated map-side."""
    return (explode_tokens(df, [doc_col], tokens_col, term_col)
            .groupBy(doc_col, term_col).agg(F.count(F.lit(1)).alias("tf")))


def _df_bound(x, n_docs):
    """sklearn's reading of min_df/max_df: a float is a share of the documents, an int a count."""
    return F.lit(float(x)) * n_docs if isinstance(x, float) else F.lit(int(x))


# F5 --------------------------------------------------------------------------------
def fit_vocabulary(tf: DataFrame, n_docs, max_features: int | None = 5000, min_df=2, max_df=0.95,
                   term_col: str = "term") -> DataFrame:
    """``(term, idx, df, count)``: terms within the DF bounds, top ``max_features`` by corpus count.

    Ties at the cut are broken by term; ``idx`` numbers the kept terms in
    alphabetical order, as sklearn's vocabulary does.  ``n_docs`` is a
    number or a scalar Column (all documents, including those with no tokens).
    """
    n = F.lit(n_docs) if isinstance(n_docs, (int, float)) else n_docs
    st = tf.groupBy(term_col).agg(F.count(F.lit(1)).alias("df"), F.sum("tf").alias("count"))
    st = st.where((F.col("df") >= _df_bound(min_df, n)) & (F.col("df") <= _df_bound(max_df, n)))
    if max_features:
        st = st.orderBy(F.col("count").desc(), F.col(term_col)).limit(max_features)
        # the kept vocabulary is bounded by max_features: a single ordered window is fine
        return st.withColumn("idx", (F.row_number().over(Window.orderBy(term_col)) - 1).cast("int"))
    # uncapped: a dense index from two levels, the terms' first letters and the terms inside one (no global window on terms)
    st = st.withColumn("_head", F.substring(term_col, 1, 3))
    heads = st.groupBy("_head").agg(F.count(F.lit(1)).alias("_n"))
    before = F.coalesce(F.sum("_n").over(Window.orderBy("_head").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    offsets = heads.select("_head", before.alias("_off"))
    inside = F.row_number().over(Window.partitionBy("_head").orderBy(term_col)) - 1
    return (st.join(offsets, "_head").withColumn("idx", (F.col("_off") + inside).cast("int")).drop("_head", "_off"))


# F6 --------------------------------------------------------------------------------
def tfidf(tf: DataFrame, vocab: DataFrame, n_docs, doc_col: str, sublinear: bool = False,
          smooth: bool = True, norm: str | None = "l2", term_col: str = "term",
          max_broadcast_rows: int = 1_000_000, vocab_bound: int | None = None) -> DataFrame:
    """``(doc, term, idx, weight)``: ``tf' * idf``, idf ``ln((1+n)/(1+df)) + 1`` (smooth), L2 per doc.

    ``tf' = 1 + ln(tf)`` when ``sublinear``.  Terms outside the vocabulary drop out.
    """
    n = F.lit(n_docs) if isinstance(n_docs, (int, float)) else n_docs
    idf = (F.log((F.lit(1.0) + n) / (F.lit(1.0) + F.col("df"))) if smooth
           else F.log(n / F.col("df"))) + F.lit(1.0)
    v = vocab.select(term_col, "idx", idf.alias("idf"))
    # a vocabulary fitted with max_features is bounded by it: pass it as vocab_bound
    x = lookup_join(tf, v, on=term_col, max_broadcast_rows=max_broadcast_rows, bound=vocab_bound)
    tfw = (F.lit(1.0) + F.log(F.col("tf"))) if sublinear else F.col("tf").cast("double")
    x = x.withColumn("weight", tfw * F.col("idf"))
    if norm == "l2":
        x = x.withColumn("weight", F.col("weight") / F.sqrt(F.sum(F.col("weight") ** 2).over(
            Window.partitionBy(doc_col))))
    elif norm == "l1":
        x = x.withColumn("weight", F.col("weight") / F.sum(F.abs("weight")).over(Window.partitionBy(doc_col)))
    return x.select(doc_col, term_col, "idx", "weight")


# F13 / F14 -----------------------------------------------------------------------------
def dtm_stats(tf: DataFrame, n_docs, n_terms) -> DataFrame:
    """Shape, stored entries and sparsity of the document-term matrix."""
    n = F.lit(n_docs) if isinstance(n_docs, (int, float)) else n_docs
    v = F.lit(n_terms) if isinstance(n_terms, (int, float)) else n_terms
    return tf.agg(F.count(F.lit(1)).alias("nnz")).select(
        n.cast("long").alias("n_docs"), v.cast("long").alias("n_terms"), "nnz",
        (F.lit(1.0) - F.col("nnz") / (n.cast("double") * v.cast("double"))).alias("sparsity"))


def document_frequency(tf: DataFrame, term_col: str = "term", doc_col: str | None = None) -> DataFrame:
    """Documents per term (each (doc, term) row of ``tf`` is one document)."""
    return tf.groupBy(term_col).agg(F.count(F.lit(1)).alias("df"))


# F15 -----------------------------------------------------------------------------------
def apply_vocabulary(df: DataFrame, doc_col: str, tokens_col: str, vocab: DataFrame,
                     term_col: str = "term") -> DataFrame:
    """Vectorizer reuse on new text: counts of known terms; unseen terms drop out.

    The vocabulary may be uncapped: adaptive execution broadcasts it if its size allows.
    """
    tf = term_frequencies(df, doc_col, tokens_col, term_col)
    return lookup_join(tf, vocab.select(term_col, "idx"), on=term_col)


# pyspark.ml stages ---------------------------------------------------------------------
def count_vectorizer(df: DataFrame, tokens_col: str, vocab_size: int, min_df: float = 1.0, max_df: float = 1.0,
                     out: str = "features") -> CountVectorizerModel:
    """Spark's ``CountVectorizer`` fitted on ``df``; ``max_df`` below 1 is a share of the rows.

    Given a share, Spark persists the token arrays of all rows (many times the size of their texts) to count the
    rows; the share is counted here and handed over as a number of rows, which is the same bound without that copy.
    """
    bound = max_df * df.count() if max_df < 1.0 <= min_df else max_df
    return CountVectorizer(inputCol=tokens_col, outputCol=out, vocabSize=vocab_size, minDF=min_df,
                           maxDF=bound if bound >= min_df else max_df).fit(df)


class SmoothTfidf(Estimator, HasInputCol, HasOutputCol, DefaultParamsReadable, DefaultParamsWritable):
    """Token arrays -> L2-normalised smoothed TF-IDF vectors (sklearn's ``TfidfVectorizer`` maths).

    Spark's ``IDF`` gives ``ln((n+1)/(df+1))``; the ``+1`` is added as an
    ``ElementwiseProduct`` with ``idf + 1``, then a ``Normalizer``.  The
    fitted model is a ``PipelineModel`` of built-in stages (savable as is).
    """

    vocabSize = Param(Params._dummy(), "vocabSize", "max_features", TypeConverters.toInt)
    minDF = Param(Params._dummy(), "minDF", "min document frequency (count or share)", TypeConverters.toFloat)
    maxDF = Param(Params._dummy(), "maxDF", "max document frequency (count above 1, or share)", TypeConverters.toFloat)

    def __init__(self, inputCol="tokens", outputCol="features", vocabSize=5000, minDF=1.0, maxDF=1.0):
        super().__init__()
        self._setDefault(vocabSize=5000, minDF=1.0, maxDF=1.0)
        self._set(inputCol=inputCol, outputCol=outputCol, vocabSize=vocabSize, minDF=minDF, maxDF=maxDF)

    def _vocabulary(self, df: DataFrame) -> tuple[list[str], np.ndarray]:
        """Terms by falling corpus count, at most ``vocabSize``, and ``idf + 1`` of each."""
        inp, out, most = self.getInputCol(), "_tf", self.getOrDefault(self.maxDF)
        # 1.0 is the share of all documents; Spark would read it as one document
        bound = {} if most == 1.0 else {"maxDF": most}
        cv = CountVectorizer(inputCol=inp, outputCol=out, vocabSize=self.getOrDefault(self.vocabSize), minDF=self.getOrDefault(self.minDF), **bound).fit(df)
        return cv.vocabulary, IDF(inputCol=out, outputCol="_idf").fit(cv.transform(df)).idf.toArray() + 1.0

    def _model(self, terms: list[str], scale: np.ndarray) -> PipelineModel:
        inp, out, size = self.getInputCol(), self.getOutputCol(), self.getOrDefault(self.vocabSize)
        cv = CountVectorizerModel.from_vocabulary(terms[:size], inputCol=inp, outputCol="_tf")
        ep = ElementwiseProduct(scalingVec=DenseVector(scale[:size]), inputCol="_tf", outputCol="_w")
        return PipelineModel([cv, ep, Normalizer(p=2.0, inputCol="_w", outputCol=out)])

    def _fit(self, df: DataFrame) -> PipelineModel:
        return self._model(*self._vocabulary(df))

    def fitMultiple(self, dataset: DataFrame, paramMaps: Sequence[dict]) -> Iterator[tuple[int, PipelineModel]]:
        """The models of all ``paramMaps``, from one fit of the largest vocabulary per input column and document
        frequency bounds: terms come by falling count, so a smaller vocabulary is the head of a larger one."""
        each = [self.copy(pm) for pm in paramMaps]
        key = lambda e: (e.getInputCol(), e.getOrDefault(e.minDF), e.getOrDefault(e.maxDF))
        largest: dict = {}
        for e in each:
            if key(e) not in largest or e.getOrDefault(e.vocabSize) > largest[key(e)].getOrDefault(e.vocabSize):
                largest[key(e)] = e
        fits = Shared(lambda k: largest[k]._vocabulary(dataset))
        return OnDemand(lambda i: each[i]._model(*fits(key(each[i]))), len(each))


class Shared:
    """``make(key)``, made once per key, by whichever thread asks first."""

    def __init__(self, make: Callable):
        self.make, self.lock, self.locks, self.made = make, Lock(), {}, {}

    def __call__(self, key):
        with self.lock:
            lock = self.locks.setdefault(key, Lock())
        with lock:
            if key not in self.made:
                self.made[key] = self.make(key)
            return self.made[key]


class OnDemand:
    """Iterator ``(i, make(i))`` that several threads may share."""

    def __init__(self, make: Callable, n: int):
        self.make, self.left, self.lock = make, iter(range(n)), Lock()

    def __iter__(self):
        return self

    def __next__(self):
        with self.lock:
            i = next(self.left)
        return i, self.make(i)


class FeatureGrid(Estimator):
    """A feature estimator and a classifier whose grid points share features.

    ``fitMultiple`` fits and applies the features once for every distinct
    setting of the feature estimator's own parameters; the matrix is written,
    and all settings of the classifier are fitted on it by one ``fitMultiple``.  The models are plain
    ``PipelineModel``s, so a search over it equals one over a ``Pipeline``.
    """

    def __init__(self, features: Estimator, classifier: Estimator):
        super().__init__()
        self.features, self.classifier = features, classifier

    def copy(self, extra=None) -> "FeatureGrid":
        return FeatureGrid(self.features.copy(extra), self.classifier.copy(extra))

    def _fit(self, df: DataFrame) -> PipelineModel:
        return next(iter(self.fitMultiple(df, [{}])))[1]

    def fitMultiple(self, dataset: DataFrame, paramMaps: Sequence[dict]) -> Iterator[tuple[int, PipelineModel]]:
        own = [{p: v for p, v in pm.items() if p.parent == self.features.uid} for pm in paramMaps]
        rest = [{p: v for p, v in pm.items() if p.parent != self.features.uid} for pm in paramMaps]
        names = [tuple(sorted((p.name, v) for p, v in o.items())) for o in own]
        distinct = dict(zip(names, own))
        models = dict(self.features.fitMultiple(dataset, list(distinct.values())))
        model = dict(zip(distinct, (models[i] for i in range(len(distinct)))))
        # only the columns the classifier reads are written
        cols = [self.classifier.getOrDefault(p) for p in self.classifier.params if p.name in ("featuresCol", "labelCol", "weightCol") and self.classifier.isDefined(p)]
        points = {name: [i for i, n in enumerate(names) if n == name] for name in distinct}

        def fit(name) -> dict:
            matrix = stored(model[name].transform(dataset).select(*cols), "grid-matrix")
            fitted = dict(self.classifier.fitMultiple(matrix, [rest[i] for i in points[name]]))
            return {i: fitted[j] for j, i in enumerate(points[name])}

        fits = Shared(fit)
        return OnDemand(lambda i: PipelineModel([model[names[i]], fits(names[i])[i]]), len(rest))


def fit_tfidf(df: DataFrame, tokens_col: str, out_col: str = "features", vocab_size: int = 5000,
              min_df: float = 1.0, max_df: float = 1.0) -> PipelineModel:
    return SmoothTfidf(tokens_col, out_col, vocab_size, min_df, max_df).fit(df)

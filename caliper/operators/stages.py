"""Custom ``pyspark.ml`` transformers built from Column expressions (UD2, X23, X20).

They are stateless, so they are plain ``Transformer``s with params, savable
through ``DefaultParamsWritable`` and usable inside a ``Pipeline`` or
``CrossValidator``.  ``transform`` only adds a column expression: the work
runs in the JVM inside the scan stage.
"""

from __future__ import annotations

from pyspark.ml import Transformer
from pyspark.ml.param.shared import HasInputCol, HasOutputCol, Param, Params, TypeConverters
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsWritable
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from caliper.functions import text as X
from caliper.functions.stopwords import ENGLISH, topic_stops


class TextCleaner(Transformer, HasInputCol, HasOutputCol, DefaultParamsReadable, DefaultParamsWritable):
    """Text -> token array by one of the reference's cleaning profiles.

    ``profile``: ``sentiment`` (tags, ASCII letters, stop words), ``spam``
    (non-word characters; tokens on whitespace), ``topic`` (e-mail
    artefacts, punctuation and digits, length >= ``minTokenLen``, stop words).
    ``lowercase`` switches the topic profile's lower-casing off.  ``lemmas`` maps
    tokens to lemmas in any profile, before the stop words; the map is part of
    the stage and hence bounded (:mod:`textjobs` joins a table of any size).
    """

    profile = Param(Params._dummy(), "profile", "sentiment | spam | topic", TypeConverters.toString)
    removeStopwords = Param(Params._dummy(), "removeStopwords", "drop stop words", TypeConverters.toBoolean)
    minTokenLen = Param(Params._dummy(), "minTokenLen", "topic profile: shortest token kept", TypeConverters.toInt)
    lowercase = Param(Params._dummy(), "lowercase", "topic profile: lower-case the text", TypeConverters.toBoolean)
    lemmas = Param(Params._dummy(), "lemmas", "token, lemma, token, lemma ...", TypeConverters.toListString)

    def __init__(self, inputCol: str = "text", outputCol: str = "tokens", profile: str = "sentiment",
                 removeStopwords: bool = True, minTokenLen: int = 3, lowercase: bool = True, lemmas: dict | None = None):
        super().__init__()
        self._setDefault(profile="sentiment", removeStopwords=True, minTokenLen=3, lowercase=True, lemmas=[])
        self._set(inputCol=inputCol, outputCol=outputCol, profile=profile, removeStopwords=removeStopwords,
                  minTokenLen=minTokenLen, lowercase=lowercase, lemmas=[x for pair in (lemmas or {}).items() for x in pair])

    def _transform(self, df: DataFrame) -> DataFrame:
        c, prof = F.col(self.getInputCol()), self.getOrDefault(self.profile)
        lemmas = self.getOrDefault(self.lemmas)
        stops = self.getOrDefault(self.removeStopwords)
        late, stops = stops and bool(lemmas) and prof != "spam", stops and not lemmas
        if prof == "sentiment":
            out = X.clean_sentiment(c, remove_stops=stops)
        elif prof == "spam":
            out = X.whitespace_tokens(X.clean_spam(c, trim=True))
        elif prof == "topic":
            out = X.clean_topic(c, remove_stops=stops, min_token_len=self.getOrDefault(self.minTokenLen),
                                lowercase=self.getOrDefault(self.lowercase))
        else:
            raise ValueError(f"unknown profile {prof!r}")
        if lemmas:
            known = F.create_map(*[F.lit(x) for x in lemmas])
            out = F.transform(out, lambda t: F.coalesce(known[t], t))
        if late:
            out = X.remove_stopwords(out, ENGLISH if prof == "sentiment" else topic_stops())
        return df.withColumn(self.getOutputCol(), out)


class NGramRange(Transformer, HasInputCol, HasOutputCol, DefaultParamsReadable, DefaultParamsWritable):
    """Tokens -> all n-grams for n in [nMin, nMax] in one array (sklearn's ``ngram_range``)."""

    nMin = Param(Params._dummy(), "nMin", "smallest n", TypeConverters.toInt)
    nMax = Param(Params._dummy(), "nMax", "largest n", TypeConverters.toInt)

    def __init__(self, inputCol: str = "tokens", outputCol: str = "grams", nMin: int = 1, nMax: int = 1):
        super().__init__()
        self._setDefault(nMin=1, nMax=1)
        self._set(inputCol=inputCol, outputCol=outputCol, nMin=nMin, nMax=nMax)

    def _transform(self, df: DataFrame) -> DataFrame:
        return df.withColumn(self.getOutputCol(), X.ngrams(F.col(self.getInputCol()),
                                                           self.getOrDefault(self.nMin), self.getOrDefault(self.nMax)))

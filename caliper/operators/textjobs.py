"""Token-mapping jobs: stemming (X14) and lemmatisation.

Cost follows the vocabulary, not the corpus: distinct tokens are found by a
``groupBy`` (map-side combined), the per-token function runs once per
distinct token in an Arrow-batched pandas UDF, and the ``(token, mapped)``
table is joined back to the exploded tokens.  The join is a
broadcast under a bound known by construction; else adaptive execution decides
by the measured size and splits a token that holds a third of all occurrences.
"""

from __future__ import annotations

from typing import Iterable

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from caliper.functions.porter import stem
from caliper.functions.text import explode_tokens, remove_stopwords
from caliper.operators.ranking import lookup_join


@F.pandas_udf(T.StringType())
def _stem_udf(s: pd.Series) -> pd.Series:
    return s.map(stem)


def map_tokens(df: DataFrame, key: str, tokens_col: str, mapping: DataFrame, out_col: str | None = None,
               token_col: str = "token", mapped_col: str = "mapped",
               max_broadcast_rows: int = 2_000_000) -> DataFrame:
    """Replace each token by its mapping (missing tokens map to themselves), keeping order and repeats."""
    out_col = out_col or tokens_col
    ex = explode_tokens(df, [key], tokens_col, token_col, pos="_pos")
    m = mapping.select(token_col, mapped_col)
    j = lookup_join(ex, m, on=token_col, how="left", max_broadcast_rows=max_broadcast_rows)
    j = j.select(key, "_pos", F.coalesce(F.col(mapped_col), F.col(token_col)).alias("_t"))
    back = j.groupBy(key).agg(F.array_sort(F.collect_list(F.struct("_pos", "_t"))).alias("_s"))
    back = back.select(key, F.transform("_s", lambda s: s["_t"]).alias("_mapped"))
    res = df.join(back, on=key, how="left")
    return res.withColumn(out_col, F.coalesce(F.col("_mapped"), F.array().cast("array<string>"))).drop("_mapped")


def stem_map(df: DataFrame, tokens_col: str, token_col: str = "token") -> DataFrame:
    """``(token, mapped)`` for every distinct token: the Porter stem, computed once per token."""
    vocab = explode_tokens(df, [], tokens_col, token_col).distinct()
    return vocab.select(token_col, _stem_udf(F.col(token_col)).alias("mapped"))


def stem_tokens(df: DataFrame, key: str, tokens_col: str, out_col: str | None = None) -> DataFrame:
    """Porter-stem token arrays (order and repeats kept)."""
    return map_tokens(df, key, tokens_col, stem_map(df, tokens_col), out_col)


def lemmatize_tokens(df: DataFrame, key: str, tokens_col: str, lemmas: DataFrame, out_col: str | None = None,
                     stops: Iterable[str] | None = None) -> DataFrame:
    """X15 (+ X16): map tokens through a ``(token, lemma)`` table, then an optional second stop-word pass."""
    m = lemmas.select(F.col(lemmas.columns[0]).alias("token"), F.col(lemmas.columns[1]).alias("mapped"))
    out = map_tokens(df, key, tokens_col, m, out_col)
    if stops is not None:
        oc = out_col or tokens_col
        out = out.withColumn(oc, remove_stopwords(oc, stops))
    return out

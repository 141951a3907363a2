"""Explanations: coefficients, importances, per-row contributions, permutation importance.

Model tables (coefficients, importances, vocabulary) are bounded by the
number of features and may live on the driver; per-row explanations stay
distributed: tokens are exploded, joined to the (size-checked) coefficient
table and cut to the top k per row by a window with a group limit.
"""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from caliper.functions.text import explode_tokens
from caliper.operators.evaluate import f1_expr
from caliper.session import stored
from caliper.operators.ranking import hash_rank, lookup_join, top_k


def feature_names(df: DataFrame, features_col: str = "features") -> list[str]:
    """Slot names from the vector column's ML attributes (VectorAssembler / OneHotEncoder metadata)."""
    meta = df.schema[features_col].metadata.get("ml_attr", {})
    attrs = meta.get("attrs", {})
    names = {}
    for group in attrs.values():
        for a in group:
            names[a["idx"]] = a.get("name", f"f{a['idx']}")
    n = meta.get("num_attrs", len(names))
    return [names.get(i, f"f{i}") for i in range(n)]


# E15 --------------------------------------------------------------------------------
def coefficient_table(spark: SparkSession, names: Sequence[str], coefs: Sequence[float]) -> DataFrame:
    """``(feature, coef, abs_coef)`` ordered by absolute value (a bounded model table)."""
    rows = [(str(n), float(c)) for n, c in zip(names, coefs)]
    df = spark.createDataFrame(rows, "feature string, coef double")
    return df.withColumn("abs_coef", F.abs("coef")).orderBy(F.col("abs_coef").desc(), "feature")


# E16 --------------------------------------------------------------------------------
def importance_table(spark: SparkSession, names: Sequence[str], importances) -> DataFrame:
    rows = [(str(n), float(v)) for n, v in zip(names, importances.toArray())]
    return spark.createDataFrame(rows, "feature string, importance double").orderBy(
        F.col("importance").desc(), "feature")


# E18 --------------------------------------------------------------------------------
def top_bottom_terms(coefs: DataFrame, k: int = 20, term_col: str = "term", coef_col: str = "coef") -> DataFrame:
    """The k most positive and k most negative terms, with a ``side`` column."""
    top = coefs.orderBy(F.col(coef_col).desc(), term_col).limit(k).select(F.lit("positive").alias("side"), term_col, coef_col)
    bot = coefs.orderBy(F.col(coef_col).asc(), term_col).limit(k).select(F.lit("negative").alias("side"), term_col, coef_col)
    return top.unionByName(bot)


# J3 / E19 ---------------------------------------------------------------------------
def term_contributions(df: DataFrame, key: str, tokens_col: str, coefs: DataFrame, k: int = 5,
                       weights_col: str | None = None, drop_zeros: bool = True, term_col: str = "term",
                       coef_col: str = "coef", max_broadcast_rows: int = 1_000_000) -> DataFrame:
    """Top-k terms of each row by |contribution|.

    Without ``weights_col``: each known distinct token contributes its
    coefficient once.  With ``weights_col`` (an array aligned with the tokens,
    e.g. tf-idf): contribution = weight * coefficient; zeros are dropped
    unless ``drop_zeros=False``.  Ties break by term, then position.
    """
    if not weights_col:
        df = df.select(key, F.array_distinct(tokens_col).alias(tokens_col))
    x = explode_tokens(df, [key] + ([weights_col] if weights_col else []), tokens_col, term_col, pos="pos")
    if weights_col:
        x = x.withColumn("w", F.element_at(weights_col, F.col("pos") + 1)).drop(weights_col)
    j = lookup_join(x, coefs.select(term_col, coef_col), on=term_col, max_broadcast_rows=max_broadcast_rows)
    contrib = F.col(coef_col) * F.col("w") if weights_col else F.col(coef_col)
    j = j.withColumn("contribution", contrib)
    if weights_col and drop_zeros:
        j = j.where(F.col("contribution") != 0)
    return top_k(j, key, [F.abs("contribution").desc(), F.col(term_col), F.col("pos")], k, rank_col="rank").select(
        key, "rank", term_col, "contribution")


def known_term_score(df: DataFrame, key: str, tokens_col: str, coefs: DataFrame, intercept: float = 0.0,
                     term_col: str = "term", coef_col: str = "coef") -> DataFrame:
    """M15 over text: ``sigmoid(b + sum of known-term coefficients)`` per row; a row without known terms scores ``sigmoid(b)``."""
    x = explode_tokens(df, [key], tokens_col, term_col)
    j = lookup_join(x, coefs.select(term_col, coef_col), on=term_col)
    s = j.groupBy(key).agg(F.count(F.lit(1)).alias("n_known"), F.sum(coef_col).alias("z"))
    s = df.select(key).join(s, key, "left").select(key, F.coalesce("n_known", F.lit(0)).alias("n_known"), F.coalesce("z", F.lit(0.0)).alias("z"))
    return s.select(key, "n_known", (F.lit(1.0) / (F.lit(1.0) + F.exp(-(F.lit(intercept) + F.col("z"))))).alias("score"))


# E17 / J6 ---------------------------------------------------------------------------
def permuted_copies(base: DataFrame, key: str, column: str, n_repeats: int, seed: int = 42) -> DataFrame:
    """``n_repeats`` copies of ``base`` (with its ``pos`` from ``hash_rank``), ``column`` shuffled in each (``rep``).

    A row takes the column from the row at its shuffled position,
    ``rank of md5(key|pair)``; the donor side is two columns wide and is not
    copied per repeat.
    """
    x = base.withColumn("rep", F.explode(F.sequence(F.lit(0), F.lit(n_repeats - 1))))
    x = x.withColumn("_pair", F.concat(F.lit(f"{column}#"), F.col("rep").cast("string")))
    x = x.withColumn("_k2", F.concat_ws("|", F.col(key).cast("string"), "_pair"))
    shuffled = hash_rank(x, "_k2", class_col="_pair", seed=seed, rank_col="_spos")
    donor = base.select(F.col("pos").alias("_spos"), F.col(column).alias("_donor"))
    # a donor a row: joined by shuffle, never through the driver
    return shuffled.join(donor.hint("merge"), "_spos").withColumn(column, F.col("_donor")).drop("_k2", "_pair", "_spos", "_donor")


def permutation_importance(model, test: DataFrame, key: str, columns: Sequence[str], label_col: str = "label",
                           n_repeats: int = 10, seed: int = 42, top: int | None = 10,
                           prediction_col: str = "prediction") -> DataFrame:
    """Mean drop of class-1 F1 when one raw column is shuffled, per column.

    Rows are ranked once (written) and columns go through in batches of one:
    each batch scores ``n_repeats`` copies and leaves ``n_repeats`` numbers, so
    the test split is never held columns x repeats times.
    """
    base = stored(hash_rank(test, key, seed=seed, rank_col="pos"), "permutation-base")
    y, p = F.col(label_col) == 1, F.col(prediction_col) == 1
    f1 = f1_expr(F.count_if(y & p), F.count_if(~y & p), F.count_if(y & ~p)).alias("f1")
    base_f1 = model.transform(base).agg(f1).first()["f1"]
    rows = []
    for c in columns:
        drops = [float(base_f1) - float(r["f1"]) for r in
                 model.transform(permuted_copies(base, key, c, n_repeats, seed)).groupBy("rep").agg(f1).collect()]
        mean = sum(drops) / len(drops)
        rows.append((c, mean, (sum((d - mean) ** 2 for d in drops) / len(drops)) ** 0.5))
    out = test.sparkSession.createDataFrame(rows, "feature string, importance_mean double, importance_std double")
    out = out.orderBy(F.col("importance_mean").desc(), "feature")
    return out.limit(top) if top else out

"""Splits, folds, rebalancing and class weights.

Row choice is by ``md5(key|seed)``: a pure function of the row, so a split
is stable under recompute and executor loss, and SQL can reproduce it.
Exact counts come from the hash-bucket primitives in ``ranking``; no step
sorts a whole class in one task.
"""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from caliper.operators.ranking import hash_rank, top_fraction


# F7 / F8 ---------------------------------------------------------------------------
def train_test_split(df: DataFrame, keys: Sequence[str] | str, test_size: float = 0.2, seed: int = 42,
                     stratify: str | None = None, split_col: str = "split") -> DataFrame:
    """Add ``split`` = 'test' for the ``ceil(test_size * n_c)`` smallest hashes of each class, else 'train'."""
    x = top_fraction(df, keys, fraction=test_size, class_col=stratify, seed=seed, flag_col="_test")
    return x.withColumn(split_col, F.when(F.col("_test"), F.lit("test")).otherwise(F.lit("train"))).drop("_test")


def split_counts(df: DataFrame, label_col: str, split_col: str = "split") -> DataFrame:
    """Class counts per split (the printed check of a stratified split)."""
    return df.groupBy(split_col, label_col).agg(F.count(F.lit(1)).alias("count"))


# F9 ------------------------------------------------------------------------------
def stratified_folds(df: DataFrame, keys: Sequence[str] | str, label_col: str | None, k: int = 5,
                     seed: int = 42, fold_col: str = "fold") -> DataFrame:
    """Fold id ``rank mod k`` within each class: every fold gets ``n_c/k`` rows of class c (+-1)."""
    x = hash_rank(df, keys, class_col=label_col, seed=seed, rank_col="_rank")
    return x.withColumn(fold_col, (F.col("_rank") % k).cast("int")).drop("_rank")


# F11 / J2 / U1 --------------------------------------------------------------------
def undersample(df: DataFrame, keys: Sequence[str] | str, label_col: str, minority=1, ratio: int = 5,
                seed: int = 42) -> DataFrame:
    """All minority rows plus ``ratio * n_minority`` majority rows with the smallest hashes.

    The majority target is a scalar subquery (no driver round trip); if the
    majority is smaller than the target, all of it is kept.
    """
    is_min = F.col(label_col) == F.lit(minority)
    n_min = df.where(is_min).agg(F.count(F.lit(1))).scalar()
    maj = df.where(~is_min).withColumn("_want", n_min * F.lit(ratio))
    picked = top_fraction(maj, keys, n_col="_want", seed=seed, flag_col="_keep")
    picked = picked.where(F.col("_keep")).drop("_keep", "_want")
    return df.where(is_min).unionByName(picked)


# F12 -------------------------------------------------------------------------------
def balanced_class_weights(df: DataFrame, label_col: str) -> DataFrame:
    """``(label, weight)`` with ``weight = n / (k * n_c)``; one row per class."""
    counts = df.groupBy(label_col).agg(F.count(F.lit(1)).alias("n_c"))
    n = df.agg(F.count(F.lit(1))).scalar()
    k = counts.agg(F.count(F.lit(1))).scalar()
    return counts.select(label_col, (n.cast("double") / (k * F.col("n_c"))).alias("weight"))


def with_class_weights(df: DataFrame, label_col: str, weight_col: str = "weight") -> DataFrame:
    """Attach balanced weights as ``weightCol`` for ``pyspark.ml`` estimators."""
    w = balanced_class_weights(df, label_col).withColumnRenamed("weight", weight_col)
    # a row a class: the rows stay where they are (shuffled by class, most of them would meet in one task)
    return df.join(F.broadcast(w), on=label_col)

"""Derived inputs shared by several registered queries, each with its SQL twin.

* ``scored_lineitem``: a labelled, scored row set for the evaluation operators.
  The label is ``l_returnflag = 'R'``; the score is a fixed logistic formula
  of the line's numbers (M15), so both engines see the same scores and ties.
* ``segment_frame``: lineitem joined to part, banded by the premium model's
  age edges (on quantity) and BMI edges (on part size), with a fixed-formula
  prediction of the extended price and its absolute error.
* ``labelled_docs``: documents joined to their quality/toxicity labels.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from caliper.functions.columns import AGE_BANDS, BMI_BANDS, abs_error, band
from caliper.plans.registry import Tables

def R(expr: str) -> str:
    """SQL: round a floating expression the way the registry rounds Spark output."""
    return f"(floor(CAST({expr} AS DOUBLE) * 1000000.0 + 0.5) / 1000000.0 + 0.0)"


def MEAN(col: str, decimals: int = 2) -> str:
    """SQL twin of ``profile.mean(col, decimals)``: exact decimal sum, one cast, one division."""
    return f"(CAST(sum(CAST({col} AS DECIMAL(38,{decimals}))) AS DOUBLE) / count({col}))"


# Fixed scoring formula of the stand-in model: z = 4*discount - 3*tax + 0.02*quantity - 0.5,
# computed from integer cents and one division so that both engines get the same
# z (and the same ties) bit for bit; only exp() may differ in the last place.
def score_column() -> F.Column:
    cents = lambda c: F.round(F.col(c) * 100).cast("int")
    zi = F.lit(4) * cents("l_discount") - F.lit(3) * cents("l_tax") + F.lit(2) * F.col("l_quantity").cast("int") - F.lit(50)
    z = zi / F.lit(100.0)
    return F.lit(1.0) / (F.lit(1.0) + F.exp(-z))


def scored_lineitem(t: Tables) -> DataFrame:
    return t.lineitem.select("l_orderkey", "l_linenumber",
                             (F.col("l_returnflag") == "R").cast("int").alias("label"),
                             score_column().alias("score"))


SCORE_SQL = ("1.0 / (1.0 + exp(-((4 * CAST(round(l_discount * 100) AS INTEGER) - 3 * CAST(round(l_tax * 100) AS INTEGER)"
             " + 2 * CAST(l_quantity AS INTEGER) - 50) / 100.0)))")
SCORED_SQL = f"""scored AS (
  SELECT l_orderkey, l_linenumber, CAST(l_returnflag = 'R' AS INTEGER) AS label, {SCORE_SQL} AS score
  FROM lineitem)"""


def segment_frame(t: Tables) -> DataFrame:
    li = t.lineitem.select("l_orderkey", "l_linenumber", "l_partkey", "l_quantity", "l_extendedprice")
    pa = t.part.select(F.col("p_partkey").alias("l_partkey"), "p_size", "p_retailprice")
    j = li.join(pa, on="l_partkey", how="inner")
    pred = F.col("l_quantity") * F.col("p_retailprice") * F.lit(0.9)
    return j.select("l_orderkey", "l_linenumber",
                    band("l_quantity", AGE_BANDS).alias("age_band"),
                    band("p_size", BMI_BANDS).alias("bmi_band"),
                    F.col("l_extendedprice").alias("actual"), pred.alias("predicted"),
                    abs_error("l_extendedprice", pred).alias("abs_error"))


def _band_sql(x: str, bands) -> str:
    arms = " ".join(f"WHEN {x} > {lo} AND {x} <= {hi} THEN '{lab}'" for lo, hi, lab in bands)
    return f"CASE {arms} END"


SEGMENT_SQL = f"""seg AS (
  SELECT l.l_orderkey, l.l_linenumber,
         {_band_sql('l.l_quantity', AGE_BANDS)} AS age_band,
         {_band_sql('p.p_size', BMI_BANDS)} AS bmi_band,
         l.l_extendedprice AS actual, l.l_quantity * p.p_retailprice * 0.9 AS predicted,
         abs(l.l_extendedprice - l.l_quantity * p.p_retailprice * 0.9) AS abs_error
  FROM lineitem l JOIN part p ON l.l_partkey = p.p_partkey)"""


def labelled_docs(t: Tables) -> DataFrame:
    return t.texts.select("doc_id", "text", "lang", "source").join(
        t.labels.select("doc_id", "quality", "toxic"), on="doc_id", how="inner")


WORD_RE = r"[\p{L}\p{N}_]+"

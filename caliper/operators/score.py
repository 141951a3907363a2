"""Scoring jobs: the reference's apps and CLIs re-aimed as batch jobs.

A fitted ``PipelineModel`` is loaded once per job and applied with
``transform``; nothing is collected.  Scores are read from the probability
vector with ``vector_to_array`` (JVM-side).
"""

from __future__ import annotations

from typing import Mapping, Sequence

from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


# C1 ---------------------------------------------------------------------------------
def score_messages(model, df: DataFrame, key: str, text_col: str = "text",
                   labels: Sequence[str] = ("Not Spam", "Spam")) -> DataFrame:
    """``(key, Message, Prediction, Confidence)``; confidence is the larger class probability."""
    out = model.transform(df)
    p = vector_to_array("probability")
    return out.select(key, F.col(text_col).alias("Message"),
                      F.when(F.col("prediction") == 1.0, F.lit(labels[1])).otherwise(F.lit(labels[0])).alias("Prediction"),
                      F.array_max(p).alias("Confidence"))


# C2 ---------------------------------------------------------------------------------
def score_tabular(model, df: DataFrame, key: str, threshold: float | None = 0.5) -> DataFrame:
    """Class at ``threshold`` on P(class 1), or the regression value when ``threshold`` is None."""
    out = model.transform(df)
    if threshold is None:
        return out.select(key, F.col("prediction").alias("prediction"))
    p1 = vector_to_array("probability")[1]
    return out.select(key, p1.alias("probability"), (p1 >= F.lit(threshold)).cast("int").alias("prediction"))


# C3 ---------------------------------------------------------------------------------
def score_sentiment(model, df: DataFrame, key: str) -> DataFrame:
    """Label, both probabilities and confidence = P(predicted class)."""
    out = model.transform(df)
    p = vector_to_array("probability")
    pred = F.col("prediction").cast("int")
    return out.select(key, F.when(pred == 1, "positive").otherwise("negative").alias("sentiment"),
                      p[0].alias("p_negative"), p[1].alias("p_positive"),
                      F.element_at(p, pred + 1).alias("confidence"))


# C4 ---------------------------------------------------------------------------------
def what_if(model, df: DataFrame, key: str, scenarios: Mapping[str, tuple[Column, Mapping[str, Column]]],
            prediction_col: str = "prediction") -> DataFrame:
    """Base and counterfactual predictions in one ``transform``.

    ``scenarios`` maps a name to ``(condition, {column: new value})``.  Every
    row is exploded into the base copy plus one copy per scenario (a bounded
    fan-out: the number of scenarios), scored once, and pivoted back with a
    ``groupBy(key)``.  ``saving_<name> = base - scenario`` where the condition
    holds, NULL elsewhere.
    """
    copies = [F.struct(F.lit("base").alias("_scn"), F.lit(True).alias("_cond"))]
    for name, (cond, _) in scenarios.items():
        copies.append(F.struct(F.lit(name).alias("_scn"), cond.alias("_cond")))
    x = df.withColumn("_c", F.explode(F.array(*copies))).select("*", "_c._scn", "_c._cond").drop("_c")
    for name, (_, changes) in scenarios.items():
        for c, v in changes.items():
            x = x.withColumn(c, F.when(F.col("_scn") == name, v).otherwise(F.col(c)))
    out = model.transform(x)
    aggs = [F.max(F.when(F.col("_scn") == "base", F.col(prediction_col))).alias("base")]
    for name in scenarios:
        aggs.append(F.max(F.when((F.col("_scn") == name) & F.col("_cond"), F.col(prediction_col))).alias(name))
    g = out.groupBy(key).agg(*aggs)
    return g.select(key, "base", *list(scenarios),
                    *[(F.col("base") - F.col(n)).alias(f"saving_{n}") for n in scenarios])


# C6 ---------------------------------------------------------------------------------
def gauge_zone(score_pct: Column) -> Column:
    """Positivity gauge: [0, 45) negative, [45, 55) neutral, [55, 100] positive."""
    return (F.when(score_pct < 45, F.lit("negative")).when(score_pct < 55, F.lit("neutral"))
            .otherwise(F.lit("positive")))

"""Mixing sources to target weights: weighted fair queueing over shuffled documents.

Each source is a queue of its documents in a seeded hash order, read up to
``max_epochs`` times.  A queued copy that ends after ``c`` words of its source
gets the virtual finish time ``c / target(source)``; serving copies in the
order of that time serves every source in proportion to its target, and the
total budget is spent when the virtual time reaches 1.  The copy that straddles
the cut is taken in part, so a source's words are its target, rounded down.
Finish times rise along a source's queue, so the cut at 1 needs no global sort:
``taken`` is each source's running sum, cut at its target, in whole words.
``training_order`` alone sorts by finish time, after the cut.

Running sums per source never put a source into one task: documents are cut
into buckets of the hash order (about ``bucket_rows`` rows each, however many
documents there are), bucket totals give offsets, and the window runs inside a
(source, bucket).  Only the table of sources meets an unpartitioned window.
Targets: water filling in closed form over the sources sorted by
limit / weight.

Defined results: a null text has size 0; the null source is a source, last in
order; sources of size 0 get target 0; an empty table gives no rows; equal rows
are interchangeable, so reruns agree.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

WORD = r"[^\x20\x09-\x0D]+"
WEIGHTS = (3, 1, 2)


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def source_targets(sized: DataFrame, weights=WEIGHTS, budget_share: float = 1.5, max_epochs: int = 2) -> DataFrame:
    """One row per source: ``source, source_size, weight, target``.

    Weights are dealt to the sources in code point order, null last.  A target
    is at most ``max_epochs`` times its source's size; what a limited source
    cannot take is shared among the others by weight.
    """
    src = sized.groupBy("source").agg(F.sum("size").alias("source_size"))
    rank = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1
    w = F.element_at(F.array(*[F.lit(int(x)) for x in weights]), (rank % len(weights) + 1).cast("int"))
    src = src.withColumn("weight", w.cast("long")).withColumn("_cap", F.col("source_size") * max_epochs)
    everything = Window.partitionBy()
    by_ratio = Window.orderBy(F.col("_cap") / F.col("weight"), F.col("source").asc_nulls_last())
    before = by_ratio.rowsBetween(Window.unboundedPreceding, -1)
    budget = F.sum("source_size").over(everything) * F.lit(float(budget_share))
    src = (src.withColumn("_budget", budget).withColumn("_w", F.sum("weight").over(everything))
           .withColumn("_level", (F.col("_budget") - F.coalesce(F.sum("_cap").over(before), F.lit(0)))
                       / (F.col("_w") - F.coalesce(F.sum("weight").over(before), F.lit(0))))
           .withColumn("_full", F.col("_level") * F.col("weight") >= F.col("_cap")))
    left = F.col("_budget") - F.sum(F.when(F.col("_full"), F.col("_cap")).otherwise(0)).over(everything)
    shares = F.col("_w") - F.sum(F.when(F.col("_full"), F.col("weight")).otherwise(0)).over(everything)
    return src.withColumn("_left", left).withColumn("_shares", shares).select(
        "source", "source_size", "weight",
        F.when(F.col("_full"), F.col("_cap").cast("double"))
        .otherwise(F.col("_left") * F.col("weight") / F.col("_shares")).alias("target"))


def mix(spark: SparkSession, docs: DataFrame, weights=WEIGHTS, budget_share: float = 1.5, max_epochs: int = 2,
        seed: int = 17, bucket_rows: int = 20_000, keep: tuple[str, ...] = ()) -> DataFrame:
    """Queue entries of every document: ``doc_id, source, size, source_size, target, finish, taken`` and ``keep``.

    ``finish`` is the virtual time at which the document's first copy ends and
    ``taken`` its words in the mix, all copies counted.
    """
    sized = docs.select("doc_id", "source", *[c for c in keep if c not in ("doc_id", "source")],
                        word_count(F.col("text")).alias("size"))
    # the queue order: a seeded hash of the id; the id and size break ties
    sized = sized.withColumn("_h", F.md5(F.concat_ws("|", F.col("doc_id").cast("string"), F.lit(str(seed)))))
    n = docs.count()
    buckets = 1 << max(4, (max(n, 1) // bucket_rows).bit_length())
    sized = sized.withColumn("_b", F.shiftright(F.conv(F.substring("_h", 1, 8), 16, 10).cast("long"), 32 - buckets.bit_length() + 1))
    targets = source_targets(sized, weights, budget_share, max_epochs)
    per = sized.groupBy("source", "_b").agg(F.sum("size").alias("_t"))
    ow = Window.partitionBy("source").orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)
    offsets = per.select(F.col("source").alias("_s"), F.col("_b").alias("_b2"),
                         F.coalesce(F.sum("_t").over(ow), F.lit(0)).alias("_off"))
    lookup = offsets.join(targets.withColumnRenamed("source", "_s2"), F.col("_s").eqNullSafe(F.col("_s2"))).drop("_s2", "weight")
    iw = (Window.partitionBy("source", "_b").orderBy("_h", "doc_id", "size")
          .rowsBetween(Window.unboundedPreceding, -1))
    q = sized.withColumn("_in", F.coalesce(F.sum("size").over(iw), F.lit(0)))
    q = q.join(lookup, F.col("source").eqNullSafe(F.col("_s")) & (F.col("_b") == F.col("_b2")))
    start = F.col("_off") + F.col("_in")
    goal = F.floor("target")
    # epoch e of a document starts at start + e * source_size; a copy's words before the goal are taken
    parts = [F.greatest(F.lit(0).cast("long"), F.least(F.col("size"), goal - (start + F.lit(e) * F.col("source_size"))))
             for e in range(max_epochs)]
    taken = parts[0]
    for p in parts[1:]:
        taken = taken + p
    finish = F.when(F.col("target") > 0, (start + F.col("size")) / F.col("target"))
    return q.select("doc_id", "source", *[c for c in keep if c not in ("doc_id", "source")], "size", "source_size", "target",
                    finish.alias("finish"), taken.cast("long").alias("taken"))


def training_order(mixed: DataFrame, max_epochs: int = 2) -> DataFrame:
    """The copies the mix takes, globally range-sorted by virtual finish time."""
    step = F.col("source_size") / F.col("target")
    copies = mixed.where(F.col("taken") > 0).withColumn("epoch", F.explode(F.sequence(F.lit(0), F.lit(max_epochs - 1))))
    words = F.greatest(F.lit(0), F.least(F.col("size"), F.col("taken") - F.col("epoch") * F.col("size")))
    copies = copies.withColumn("words", words.cast("long")).where(F.col("words") > 0)
    return copies.withColumn("finish", F.col("finish") + F.col("epoch") * step).drop("taken").orderBy("finish", "doc_id")


def op10_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return mix(spark, docs).select("doc_id", "size", "source_size", "target", "taken")


def mix_sql(table: str) -> str:
    return rf"""
  sized AS (SELECT doc_id, source, coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::BIGINT AS size,
                   md5(concat_ws('|', doc_id::VARCHAR, '17')) AS h FROM {table}),
  src AS (SELECT source, sum(size)::BIGINT AS source_size, [3, 1, 2][(row_number() OVER (ORDER BY source ASC NULLS LAST) - 1) % 3 + 1] AS weight
          FROM sized GROUP BY source),
  lev AS (SELECT *, 2 * source_size AS cap, sum(source_size) OVER () * 1.5::DOUBLE AS budget, sum(weight) OVER () AS w,
            ((sum(source_size) OVER () * 1.5::DOUBLE)
              - coalesce(sum(2 * source_size) OVER (ORDER BY 2.0::DOUBLE * source_size / weight, source ASC NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::DOUBLE)
            / (sum(weight) OVER () - coalesce(sum(weight) OVER (ORDER BY 2.0::DOUBLE * source_size / weight, source ASC NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))::DOUBLE AS lvl
          FROM src),
  tgt AS (SELECT source, source_size, CASE WHEN lvl * weight >= cap THEN cap::DOUBLE ELSE
            (budget - (sum(CASE WHEN lvl * weight >= cap THEN cap ELSE 0 END) OVER ())::DOUBLE) * weight
            / (w - sum(CASE WHEN lvl * weight >= cap THEN weight ELSE 0 END) OVER ())::DOUBLE END AS target FROM lev),
  q AS (SELECT doc_id, size, source_size, target,
          coalesce(sum(size) OVER (PARTITION BY s.source ORDER BY h, doc_id, size ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS st
        FROM sized s JOIN tgt t ON s.source IS NOT DISTINCT FROM t.source)
  SELECT doc_id, size, source_size, target,
         (greatest(0, least(size, floor(target)::BIGINT - st)) + greatest(0, least(size, floor(target)::BIGINT - st - source_size)))::BIGINT AS taken
  FROM q"""


OP10_SQL = "WITH " + mix_sql("documents").strip()

"""Substring dedup by relative Lempel-Ziv parsing against an index of all documents.

The reference is the corpus itself.  Its index has one entry per context (see
``passages``: an anchor and the run of windows it owns) with the first and the
last document position that hold it; the entries are dealt by hash, so every
partition of the table is one indexed reference block and a look-up reaches the
only block that can hold a match.

* Parse: each document's contexts are looked up in all blocks by a join, and the
  document is factored greedily from the left: a factor runs on while the next
  context directly follows and points to the same reference document at the
  same distance, otherwise a new factor begins; words no factor covers are
  literals.
* Factors of ``length`` words or more are duplicate spans.  A factor's end cuts
  through windows that reach into what follows, so windows at factor
  boundaries - those of contexts without a match of their own whose seed occurs
  elsewhere - are checked one by one, by 128-bit hashes, against the windows of
  all other contexts with that seed.

Windows are judged on the input, so all occurrences of a repeated passage are
found, the first one included.  A hot passage is one index entry, its
occurrences are joined to it by a splittable join, and nothing is paired with
anything else.

Defined results: null or wordless texts have no words; rows with equal ids and
texts are documents of their own that repeat each other; overlapping windows of
one document count as repeats.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from caliper.llm import passages as P
from caliper.llm.words import SPACED, slices, split_words


def greedy_factors(anchors: list[dict], length: int) -> list[dict]:
    """Factors of one document from its matched contexts ``ws, nw, ref_id, ref_rk, ref_ws``."""
    out: list[dict] = []
    ahead = None
    for x in sorted(anchors, key=lambda r: r["ws"]):
        place = (x["ref_id"], x["ref_rk"], x["ref_ws"] - x["ws"])
        if out and ahead == (place, x["ws"]):
            out[-1]["b"] = x["ws"] + x["nw"] - 1 + length
        else:
            out.append({"a": x["ws"], "b": x["ws"] + x["nw"] - 1 + length, "ref_id": x["ref_id"], "ref_a": x["ref_ws"]})
        ahead = (place, x["ws"] + x["nw"])
    return out


def union_of(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for a, b in sorted(spans):
        if out and a <= out[-1][1]:
            out[-1] = (out[-1][0], max(out[-1][1], b))
        else:
            out.append((a, b))
    return out


def matched_contexts(cand: DataFrame, ctx: DataFrame) -> DataFrame:
    """Occurrences of contexts that occur twice or more, with another occurrence as reference."""
    index = ctx.where("n > 1").select("seed", "ctx", "first", "last")
    j = cand.join(index, ["seed", "ctx"])
    itself = F.col("first.id").eqNullSafe(F.col("id")) & (F.col("first.rk") == F.col("rk")) & (F.col("first.ws") == F.col("ws"))
    ref = F.when(itself, F.col("last")).otherwise(F.col("first"))
    return j.select("id", "rk", F.struct("ws", "nw", ref["id"].alias("ref_id"), ref["rk"].alias("ref_rk"), ref["ws"].alias("ref_ws")).alias("m"))


def parse(spark: SparkSession, docs: DataFrame, length: int = 35, gram: int = 16) -> DataFrame:
    """Per document of ``keyed`` docs that has any: matched contexts and repeated boundary windows."""
    cand = P.repeated_anchors(docs, length, gram)
    ctx = P.stored(P.contexts(cand), "contexts")
    texts = P.with_text(P.open_contexts(ctx).select("first.id", "first.rk", "first.ws", "first.nw", "n"), docs, "ws", "nw", "n")
    windows = P.stored(P.window_hashes(texts, length), "windows")
    matched = matched_contexts(cand, ctx)
    edge = P.repeated_windows(windows)
    both = matched.select("id", "rk", "m", F.lit(None).cast("int").alias("w")).unionByName(
        edge.select("id", "rk", F.lit(None).cast(matched.schema["m"].dataType).alias("m"), "w"))
    # equal rows say the same: a set keeps the list as long as one of them, however many there are
    return both.groupBy("id", "rk").agg(F.collect_set("m").alias("m"), F.collect_set("w").alias("w"))


def _cut(length: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text"):
                w = split_words(part.column("text"), SPACED)
                out: dict[str, list] = {"n_words": [], "n_removed": [], "kept": [], "factors": []}
                for d, (m, edge) in enumerate(zip(part.column("m").to_pylist(), part.column("w").to_pylist())):
                    i, end = int(w.first[d]), int(w.first[d + 1])
                    factors = greedy_factors(m or [], length)
                    spans = union_of([(f["a"], f["b"]) for f in factors] + [(x, x + length) for x in edge or []])
                    kept, at = [], i
                    for a, b in [*spans, (end - i, end - i)]:
                        if at < i + a:
                            kept.append(w.spaced(at, i + a))
                        at = i + b
                    out["n_words"].append(end - i)
                    out["n_removed"].append(sum(b - a for a, b in spans))
                    out["kept"].append(b" ".join(kept).decode())
                    out["factors"].append(factors)
                ref = part.schema.field("m").type.value_type.field("ref_id").type
                kinds = [pa.int64(), pa.int64(), pa.string(), pa.list_(pa.struct([("a", pa.int64()), ("b", pa.int64()), ("ref_id", ref), ("ref_a", pa.int64())]))]
                yield pa.RecordBatch.from_arrays([part.column("id"), *[pa.array(v, t) for v, t in zip(out.values(), kinds)]], ["id", *out])
    return run


def dedup_substrings(spark: SparkSession, docs: DataFrame, length: int = 35, gram: int = 16, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: ``id_col, n_words, n_removed, kept`` (text of the kept words) and its ``factors (a, b, ref_id, ref_a)``."""
    d = P.keyed(docs, id_col, text_col)
    kind = d.schema["id"].dataType.simpleString()
    found = parse(spark, d, length, gram)
    j = d.join(found, P.same_doc(d, found), "left").select(d["id"], d["text"], found["m"], found["w"])
    out = j.mapInArrow(_cut(length), f"id {kind}, n_words long, n_removed long, kept string, "
                                     f"factors array<struct<a:long,b:long,ref_id:{kind},ref_a:long>>")
    return out.withColumnRenamed("id", id_col)


def op7_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return dedup_substrings(spark, docs).select("doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))


OP7_SQL = r"""
WITH d AS (SELECT doc_id, coalesce(regexp_extract_all(text, '[^\x20\x09-\x0D]+'), []) AS ws FROM documents),
win AS (SELECT doc_id, i, md5(array_to_string(ws[i:i + 34], ' ')) AS h
        FROM (SELECT doc_id, ws, unnest(generate_series(1, len(ws) - 34)) AS i FROM d WHERE len(ws) >= 35)),
rep AS (SELECT h FROM win GROUP BY h HAVING count(*) > 1),
gone AS (SELECT DISTINCT doc_id, p FROM (SELECT doc_id, unnest(generate_series(i, i + 34)) AS p FROM win SEMI JOIN rep USING (h))),
words AS (SELECT doc_id, generate_subscripts(ws, 1) AS p, unnest(ws) AS w FROM d),
k AS (SELECT doc_id, count(*) FILTER (g.p IS NOT NULL) AS n_removed, string_agg(w, ' ' ORDER BY p) FILTER (g.p IS NULL) AS kept
      FROM words LEFT JOIN gone g USING (doc_id, p) GROUP BY doc_id)
SELECT doc_id, len(ws)::BIGINT AS n_words, coalesce(n_removed, 0)::BIGINT AS n_removed, sha256(coalesce(kept, '')) AS kept_sha256
FROM d LEFT JOIN k USING (doc_id)
"""

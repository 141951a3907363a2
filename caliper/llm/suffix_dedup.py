"""Suffix-array dedup: sparse suffix arrays at minimiser positions.

Of all suffixes only those at anchors are kept (see ``passages``: the smallest
gram of each ``length``-word window), and of those only the ones whose seed
recurs.  Suffixes that agree on all words their anchor answers for are equal
neighbours and settle each other before sorting (one row stands for them).  The
rest is sorted twice by Spark's range partitioner: by the words to the right of
the anchor (the suffix array) and by the words to its left (the array of
reversed prefixes).  Neighbours in each order are compared and their match is
extended to the left and to the right:

* A window with ``o`` words left of its anchor is repeated if a neighbour
  matches ``o`` words or more to the left and ``length - o`` or more to the
  right.
* It is unique if no neighbour in the first order matches so far right, or none
  in the second so far left: sorted neighbours are the closest ones there are.
* The few windows that neither rule decides - and those next to a partition's
  edge, whose other neighbour is out of sight - are compared by 128-bit hashes
  within their seed.

So the spans are exactly the words in windows of ``length`` words that occur
more than once, anywhere.  No group is gathered: equal suffixes are aggregated,
and a seed with very many different surroundings is cut by the range
partitioner like any other part of the order.

Defined results: null and short texts have no spans; rows with equal ids and
texts repeat each other and share their spans; a passage that a document
repeats by itself counts.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from caliper.llm import passages as P
from caliper.llm.substring_dedup import union_of
from caliper.llm.words import SPACED, mix64, multi_arange, signed, slices, split_words

FAR = 1 << 20          # stands for "out of sight" in a match length


def _suffix_rows(texts: DataFrame, length: int) -> DataFrame:
    """For each open context: word hashes to the right of its anchor and to the left (reversed), big-endian so that bytes sort like words."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text"):
                w = split_words(part.column("text"), SPACED)
                lists = part.column("rows")
                flat, per = lists.flatten(), np.diff(lists.offsets.to_numpy())
                doc = np.repeat(np.arange(part.num_rows), per)
                ws, nw, p = (flat.field(c).to_numpy(zero_copy_only=False).astype(np.int64) for c in ("ws", "nw", "p"))
                base = w.first[doc]
                h = w.hash.astype(">u8")
                right, _ = multi_arange(base + p, ws + nw - 1 + length - p)
                left, owner = multi_arange(base + ws, p - ws)
                left = (base + p - 1)[owner] - (left - (base + ws)[owner])
                rows = pa.array(doc)
                yield pa.RecordBatch.from_arrays(
                    [flat.field("seed"), _binary(h[right], ws + nw - 1 + length - p), _binary(h[left], p - ws), part.column("id").take(rows),
                     part.column("rk").take(rows), *(flat.field(c) for c in ("ws", "nw", "p", "n"))],
                    ["seed", "r", "l", "id", "rk", "ws", "nw", "p", "n"])
    kind = texts.schema["id"].dataType.simpleString()
    return texts.select("id", "rk", "text", "rows").mapInArrow(
        run, f"seed long, r binary, l binary, id {kind}, rk long, ws int, nw int, p int, n long")


def _binary(words: np.ndarray, count: np.ndarray) -> pa.Array:
    off = np.zeros(len(count) + 1, np.int32)
    np.cumsum(count * 8, out=off[1:])
    return pa.Array.from_buffers(pa.binary(), len(count), [None, pa.py_buffer(off), pa.py_buffer(words.tobytes())])


def _matrix(col: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Binary values of 8-byte words as a zero-padded matrix, and their lengths in words."""
    off = np.frombuffer(col.buffers()[1], np.int32, len(col) + 1, col.offset * 4) // 8
    n = np.diff(off).astype(np.int64)
    m = np.zeros((len(n), max(1, int(n.max()) if len(n) else 1)), np.uint64)
    raw = np.frombuffer(col.buffers()[2], ">u8") if col.buffers()[2] is not None else np.empty(0, ">u8")
    at, owner = multi_arange(np.zeros(len(n), np.int64), n)
    m[owner, at] = raw[off[0]:off[-1]]
    return m, n


def _common(col: pa.Array) -> np.ndarray:
    """Common prefix, in words, of each value and the one before it."""
    m, n = _matrix(col)
    diff = m[1:] != m[:-1]
    first = np.where(diff.any(1), diff.argmax(1), m.shape[1])
    return np.minimum(first, np.minimum(n[1:], n[:-1]))


def _neighbours(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sorted rows in; per row its matches (left, right) with the row before and the row after.

    -1: the neighbour has another seed; FAR: the neighbour is out of sight.
    """
    def out(rows: pa.RecordBatch, lb, rb, la, ra) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays(
            [*(rows.column(c) for c in ("seed", "id", "rk", "ws", "nw", "p", "n")), *(pa.array(x.astype(np.int32)) for x in (lb, rb, la, ra))],
            ["seed", "id", "rk", "ws", "nw", "p", "n", "lb", "rb", "la", "ra"])

    held, before = None, None        # the last row seen, and its match with the row before it
    for batch in batches:
        if not batch.num_rows:
            continue
        rows = batch if held is None else pa.Table.from_batches([held, batch]).combine_chunks().to_batches()[0]
        seed = rows.column("seed").to_numpy()
        same = seed[1:] == seed[:-1]
        left, right = np.where(same, _common(rows.column("l")), -1), np.where(same, _common(rows.column("r")), -1)
        first = (np.array([FAR]), np.array([FAR])) if held is None else before
        lb, rb = np.concatenate([first[0], left]), np.concatenate([first[1], right])
        n = rows.num_rows
        if n > 1:
            yield out(rows.slice(0, n - 1), lb[:-1], rb[:-1], left, right)
        held, before = rows.slice(n - 1, 1), (lb[-1:], rb[-1:])
    if held is not None:
        yield out(held, *before, np.array([FAR]), np.array([FAR]))


def _sorted_matches(suffixes: DataFrame, *order: str) -> DataFrame:
    kind = suffixes.schema["id"].dataType.simpleString()
    return (suffixes.repartitionByRange("seed", *order).sortWithinPartitions("seed", *order)
            .mapInArrow(_neighbours, f"seed long, id {kind}, rk long, ws int, nw int, p int, n long, lb int, rb int, la int, ra int"))


def _decide(length: int):
    """Windows of each context that are repeated, and those left undecided, as arrays of first words."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            get = lambda c: batch.column(c).to_numpy(zero_copy_only=False).astype(np.int64)
            ws, nw, p = get("ws"), get("nw"), get("p")
            at, i = multi_arange(ws, nw)
            o = p[i] - at                                      # words left of the anchor
            yes = np.zeros(len(at), bool)
            most = {"r": np.full(len(ws), -1), "s": np.full(len(ws), -1)}
            for side in ("r", "s"):                            # suffix order, reversed prefix order
                for pair in ("b", "a"):
                    left, right = get(f"{side}_l{pair}"), get(f"{side}_r{pair}")
                    seen = left < FAR
                    yes |= (seen & (left >= 0))[i] & (left[i] >= o) & (right[i] >= length - o)
                    most[side] = np.maximum(most[side], right if side == "r" else left)
            open_ = ~yes & (most["r"][i] >= length - o) & (most["s"][i] >= o)
            lists = lambda ok: pa.ListArray.from_arrays(np.concatenate([[0], np.cumsum(np.bincount(i[ok], minlength=len(ws)))]).astype(np.int32),
                                                        pa.array(at[ok].astype(np.int32)))
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in ("seed", "id", "rk", "ws", "n")), lists(yes), lists(open_)],
                                             ["seed", "id", "rk", "ws", "n", "yes", "open"])
    return run


def _hash_windows(length: int):
    """128-bit hashes of all windows of suffix rows."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            (left, nl), (right, nr) = _matrix(batch.column("l")), _matrix(batch.column("r"))
            get = lambda c: batch.column(c).to_numpy(zero_copy_only=False).astype(np.int64)
            ws, nw, p = get("ws"), get("nw"), get("p")
            at, i = multi_arange(ws, nw)
            h1, h2 = np.zeros(len(at), np.uint64), np.zeros(len(at), np.uint64)
            for j in range(length):                            # word j of each window
                k = at + j - p[i]                              # its place right of the anchor, or left of it if negative
                word = np.where(k >= 0, right[i, np.clip(k, 0, right.shape[1] - 1)], left[i, np.clip(-k - 1, 0, left.shape[1] - 1)])
                h1 = mix64(h1 * np.uint64(0x9E3779B97F4A7C15) + word)
                h2 = mix64(h2 * np.uint64(0xC2B2AE3D27D4EB4F) + (word ^ np.uint64(0x165667B19E3779F9)))
            rows = pa.array(i)
            yield pa.RecordBatch.from_arrays([pa.array(signed(h1)), pa.array(signed(h2)), *(batch.column(c).take(rows) for c in ("id", "rk", "n")),
                                              pa.array(at.astype(np.int32))], ["h1", "h2", "id", "rk", "n", "w"])
    return run


def repeated_passages(spark: SparkSession, docs: DataFrame, length: int = 50, gram: int = 24, id_col: str = "doc_id",
                      text_col: str = "text") -> DataFrame:
    """One row per maximal repeated span of a document: ``id_col, begin, end, n_words`` (word numbers from 0, end excluded)."""
    d = P.keyed(docs, id_col, text_col)
    kind = d.schema["id"].dataType.simpleString()
    cand = P.repeated_anchors(d, length, gram)
    ctx = P.stored(P.contexts(cand), "contexts")
    reps = P.open_contexts(ctx).select("seed", "first.id", "first.rk", "first.ws", "first.nw", "first.p", "n")
    suffixes = P.stored(_suffix_rows(P.with_text(reps, d, "seed", "ws", "nw", "p", "n"), length), "suffixes")
    key = ["seed", "id", "rk", "ws", "nw", "p", "n"]
    pre = lambda df, s: df.select(*key, *(F.col(c).alias(f"{s}_{c}") for c in ("lb", "rb", "la", "ra")))
    by_right, by_left = pre(_sorted_matches(suffixes, "r", "l"), "r"), pre(_sorted_matches(suffixes, "l", "r"), "s").drop("nw", "p", "n")
    b = by_left.select(*[F.col(c).alias(f"_{c}") if c in key else c for c in by_left.columns])
    both = by_right.join(b, (by_right["seed"] == b["_seed"]) & by_right["id"].eqNullSafe(b["_id"]) & (by_right["rk"] == b["_rk"])
                         & (by_right["ws"] == b["_ws"])).drop("_seed", "_id", "_rk", "_ws")
    decided = P.stored(both.mapInArrow(_decide(length), f"seed long, id {kind}, rk long, ws int, n long, yes array<int>, open array<int>"), "decided")
    # what the neighbours leave open: windows of the same seeds, by hash
    seeds = P.stored(decided.where("n = 1 and size(open) > 0").groupBy("seed").agg(F.count(F.lit(1)).alias("m")).select("seed"), "undecided-seeds")
    windows = P.stored(suffixes.join(seeds, "seed", "left_semi").mapInArrow(
        _hash_windows(length), f"h1 long, h2 long, id {kind}, rk long, n long, w int"), "windows")
    spans = (cand.join(ctx.where("n > 1").select("seed", "ctx"), ["seed", "ctx"], "left_semi")
             .select("id", "rk", F.col("ws").alias("a"), (F.col("ws") + F.col("nw") - 1 + length).alias("b"))
             .unionByName(decided.where("n = 1").select("id", "rk", F.explode("yes").alias("a")).withColumn("b", F.col("a") + length))
             .unionByName(P.repeated_windows(windows).select("id", "rk", F.col("w").alias("a"), (F.col("w") + length).alias("b"))))
    merged = spans.groupBy("id", "rk").agg(F.collect_list(F.struct("a", "b")).alias("s")).mapInArrow(_merge, f"id {kind}, rk long, begin long, end long")
    # rows with the same id and text are documents of their own
    times = d.groupBy("id", "rk").agg(F.count(F.lit(1)).alias("t")).where("t > 1")
    out = merged.join(times, P.same_doc(merged, times), "left").select(
        merged["id"].alias(id_col), "begin", "end", (F.col("end") - F.col("begin")).alias("n_words"),
        F.explode(F.sequence(F.lit(1), F.coalesce(F.col("t"), F.lit(1)).cast("int"))).alias("_copy"))
    return out.drop("_copy")


def _merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows = [(i, a, b) for i, s in enumerate(batch.column("s").to_pylist()) for a, b in union_of([(x["a"], x["b"]) for x in s])]
        take = pa.array([r[0] for r in rows], pa.int64())
        yield pa.RecordBatch.from_arrays([batch.column("id").take(take), batch.column("rk").take(take), pa.array([r[1] for r in rows], pa.int64()),
                                          pa.array([r[2] for r in rows], pa.int64())], ["id", "rk", "begin", "end"])


def op1_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repeated_passages(spark, spark.read.parquet(f"{sf_dir}/documents.parquet"))


OP1_SQL = r"""
WITH d AS (SELECT doc_id, coalesce(regexp_extract_all(text, '[^\x20\x09-\x0D]+'), []) AS ws FROM documents),
win AS (SELECT doc_id, i, md5(array_to_string(ws[i:i + 49], ' ')) AS h
        FROM (SELECT doc_id, ws, unnest(generate_series(1, len(ws) - 49)) AS i FROM d WHERE len(ws) >= 50)),
rep AS (SELECT h FROM win GROUP BY h HAVING count(*) > 1),
hit AS (SELECT doc_id, i, i - lag(i) OVER (PARTITION BY doc_id ORDER BY i) AS gap FROM win SEMI JOIN rep USING (h)),
run AS (SELECT doc_id, i, sum(CASE WHEN gap <= 50 THEN 0 ELSE 1 END) OVER (PARTITION BY doc_id ORDER BY i) AS r FROM hit)
SELECT doc_id, (min(i) - 1)::BIGINT AS begin, (max(i) + 49)::BIGINT AS "end", (max(i) - min(i) + 50)::BIGINT AS n_words
FROM run GROUP BY doc_id, r
"""

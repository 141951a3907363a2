"""Repeated word windows by content-selected anchors; shared by the two passage operators.

A window is ``length`` consecutive words of one document (words are
``[^\\x20\\x09-\\x0D]+``, unchanged).  Every window selects its *anchor*: the
first smallest hash among its ``k``-word grams.  Equal windows select the same
anchor at the same offset, so a window can only be repeated where its anchor's
*seed* (the gram's hash) is.  Neighbouring windows mostly share an anchor; the
run of windows an anchor owns, with all words they cover, is its *context*.

* About ``2 / (length - k + 2)`` of the words become anchors; they are written
  once, in the shared folder, and seeds that occur once fall away by a partial
  aggregation and a semi-join (Spark splits hot seeds).
* Equal (seed, context) pairs prove all windows of their occurrences repeated,
  and a context stands for all its occurrences from then on.
* Only the single contexts of seeds that have several are left open.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from caliper.llm.words import SPACED, Words, first_minimum, multi_arange, signed, slices, split_words
from caliper.session import scratch_path

KEY = ["id", "rk"]       # a document: its id and a hash of its text, so rows with equal or null ids stay apart


def keyed(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    return docs.select(F.col(id_col).alias("id"), F.xxhash64(F.col(text_col)).alias("rk"), F.col(text_col).alias("text"))


def stored(df: DataFrame, name: str) -> DataFrame:
    """Written to the shared folder and read back: cuts lineage, survives lost executors."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    out = df.sparkSession.read.parquet(path)
    out.stored_at = path
    return out


def discard(*tables: DataFrame) -> None:
    """Remove ``stored`` tables whose readers have themselves been written.

    The shuffle files of the jobs that wrote them go too: Spark's cleaner
    removes those of plans that the driver has collected as garbage.
    """
    for t in tables:
        sc = t.sparkSession.sparkContext
        path = sc._jvm.org.apache.hadoop.fs.Path(t.stored_at)
        path.getFileSystem(sc._jsc.hadoopConfiguration()).delete(path, True)
    if tables:
        release(tables[0])


def release(table: DataFrame) -> None:
    """Let Spark's cleaner remove the shuffle files of finished jobs: it does when the driver collects their plans."""
    table.sparkSession.sparkContext._jvm.System.gc()


def same_doc(a: DataFrame, b: DataFrame):
    return a["id"].eqNullSafe(b["id"]) & (a["rk"] == b["rk"])


def _anchors(w: Words, length: int, k: int):
    """For each anchor: its word, the first window it owns, how many, and their text (as word indices of the batch)."""
    grams, _ = w.ngrams(k)
    best = first_minimum(grams, length - k + 1) if len(grams) > length - k else np.empty(0, np.int64)
    last = np.repeat(w.first[1:], w.count())[:len(best)]
    window = np.flatnonzero(np.arange(len(best)) + length <= last)
    anchor, doc = best[window], w.doc()[window]
    new = np.ones(len(window), bool)
    new[1:] = (anchor[1:] != anchor[:-1]) | (doc[1:] != doc[:-1])
    begin = np.flatnonzero(new)
    count = np.diff(np.append(begin, len(window)))
    return grams[anchor[begin]], anchor[begin], window[begin], count, doc[begin]


def anchors(docs: DataFrame, length: int, k: int) -> DataFrame:
    """``id, rk, ws, nw, p, seed, ctx``: anchor word p of ``nw`` windows from word ``ws`` on."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text"):
                w = split_words(part.column("text"), SPACED)
                seed, p, ws, nw, doc = _anchors(w, length, k)
                if not len(p):
                    continue
                ctx = w.spans(ws, nw - 1 + length, second=True) ^ ((p - ws).astype(np.uint64) << np.uint64(32)) ^ nw.astype(np.uint64)
                rows = pa.array(doc)
                yield pa.RecordBatch.from_arrays(
                    [part.column("id").take(rows), part.column("rk").take(rows), pa.array((ws - w.first[doc]).astype(np.int32)),
                     pa.array(nw.astype(np.int32)), pa.array((p - w.first[doc]).astype(np.int32)), pa.array(signed(seed)), pa.array(signed(ctx))],
                    ["id", "rk", "ws", "nw", "p", "seed", "ctx"])
    kind = docs.schema["id"].dataType.simpleString()
    return docs.mapInArrow(run, f"id {kind}, rk long, ws int, nw int, p int, seed long, ctx long")


def repeated_anchors(docs: DataFrame, length: int, k: int) -> DataFrame:
    """The anchors whose seed occurs more than once (written)."""
    occ = stored(anchors(docs, length, k), "anchors")
    # tables of repeated keys are written, so that the joins with them shuffle both sides and may split hot keys
    seeds = stored(occ.groupBy("seed").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("seed"), "seeds")
    out = stored(occ.join(seeds, "seed", "left_semi"), "repeated-anchors")
    discard(occ, seeds)
    return out


def contexts(cand: DataFrame) -> DataFrame:
    """One row per (seed, ctx): occurrences ``n`` and the first and last of them."""
    at = F.struct("id", "rk", "ws", "nw", "p")
    return cand.groupBy("seed", "ctx").agg(F.count(F.lit(1)).alias("n"), F.min(at).alias("first"), F.max(at).alias("last"))


def open_contexts(ctx: DataFrame) -> DataFrame:
    """All contexts of the seeds that have one with a single occurrence."""
    seeds = stored(ctx.where("n = 1").groupBy("seed").agg(F.count(F.lit(1)).alias("m")).select("seed"), "open-seeds")
    return ctx.join(seeds, "seed", "left_semi")


def with_text(rows: DataFrame, docs: DataFrame, *cols: str) -> DataFrame:
    """The texts of the documents that have ``rows``, with their rows as an array (bounded by the document)."""
    per = rows.groupBy("id", "rk").agg(F.collect_list(F.struct(*cols)).alias("rows"))
    # equal rows of docs have equal texts and get equal results: one of them is enough
    one = docs.select("id", "rk", "text")
    return one.join(per, same_doc(one, per)).select(one["id"], one["rk"], "text", "rows")


def window_hashes(texts: DataFrame, length: int) -> DataFrame:
    """``h1, h2, id, rk, w, n`` of every window of the listed contexts ``rows(ws, nw, n)``."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text"):
                w = split_words(part.column("text"), SPACED)
                lists = part.column("rows")
                flat, per = lists.flatten(), np.diff(lists.offsets.to_numpy())
                doc = np.repeat(np.arange(part.num_rows), per)
                ws, nw, n = (flat.field(c).to_numpy(zero_copy_only=False).astype(np.int64) for c in ("ws", "nw", "n"))
                at, owner = multi_arange(ws + w.first[doc], nw)
                size = np.full(len(at), length)
                rows = pa.array(doc[owner])
                yield pa.RecordBatch.from_arrays(
                    [pa.array(signed(w.spans(at, size))), pa.array(signed(w.spans(at, size, second=True))), part.column("id").take(rows),
                     part.column("rk").take(rows), pa.array((at - w.first[doc[owner]]).astype(np.int32)), pa.array(n[owner])],
                    ["h1", "h2", "id", "rk", "w", "n"])
    kind = texts.schema["id"].dataType.simpleString()
    return texts.select("id", "rk", "text", "rows").mapInArrow(run, f"h1 long, h2 long, id {kind}, rk long, w int, n long")


def repeated_windows(windows: DataFrame) -> DataFrame:
    """``id, rk, w`` of the windows of single contexts that some other occurrence has too."""
    twice = stored(windows.groupBy("h1", "h2").agg(F.sum("n").alias("m")).where("m > 1").select("h1", "h2"), "repeated-windows")
    return windows.where("n = 1").join(twice, ["h1", "h2"], "left_semi").select("id", "rk", "w")

"""Ranked lexical search: hybrid TAAT-DAAT over sharded inverted indexes.

* Statistics: the number of documents with a term (N) and all their terms (L)
  are counted first, document frequencies from the index; all are global, so a
  document scores the same in whatever shard it lies.
* Index: the documents of a task become shards of ``shard_docs`` documents; a
  shard is one row of a written table: sorted terms and their posting lists of
  local document numbers and *impacts* (what a document adds per weight).  Long
  lists - those that are in more than one of ``LONG`` documents - also carry
  the place of their first posting and the largest impact in every *block* of
  ``BLOCK`` documents.
* Term at a time: an item's short lists are summed first into accumulators; the
  k-th largest is a score that k documents reach.
* Document at a time: the accumulators then are one more iterator, in document
  order with a bound per block like a long list's.  Blocks are visited in
  document order; one whose bounds together stay below the item's k-th best
  score so far is skipped, and its postings are not read.  In a block that is
  visited, the iterators that cannot reach the k-th best together are not
  essential: only documents of the others are candidates, which look the rest
  up in order of their bounds and are dropped once they cannot reach it.
* The k-th best score of an item is carried from shard to shard of a task; a
  task gives its k best an item, and a partial limit and a rank over those give
  the global k best.  Items are looked up in blocks of at most ``block_terms``
  (item, term) rows, one block at a time, which the driver broadcasts.

The score is in 64-bit integers throughout: ``sum of w * ((10^9 tf) div
(1000 tf + 8 m))`` over the item's distinct terms, where ``w = floor(1000 ln((2N
+ 2) / (2 df + 1)))`` and ``m = 10 + (90 n N) div L`` for a document of n terms.

Defined results: terms as in ``TERMS``, lower-cased A-Z; null or wordless
documents have no term and are never found; items without a term, and terms in
no document, find nothing; equal item rows are one item, equal document rows
are each ranked; equal scores rank by id, nulls last.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from caliper.llm.passages import keyed, stored
from caliper.llm.words import _byte_class, multi_arange, packed, signed, slices, split_words

#: ``[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+``; capitals are lower-cased before
TERMS = _byte_class([*range(0x00, 0x30), *range(0x3A, 0x41), *range(0x5B, 0x61), *range(0x7B, 0x80)])
BLOCK = 256            # documents with one bound per long list
LONG = 16              # a list is long if it holds more than a document in so many
LISTS = {"terms": np.uint64, "first": np.int32, "docs": np.int32, "impacts": np.int32, "long": np.int32, "begins": np.int32, "bounds": np.int32}   # an impact is 10^6 at most


def _postings(part: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Postings (text, term, frequency) of a slice and the number of terms of each text."""
    w = split_words(part.column("text"), TERMS, lower=True)
    doc = w.doc()
    order = np.lexsort((w.hash, doc))
    h, doc = w.hash[order], doc[order]
    new = np.ones(len(h), bool)
    new[1:] = (h[1:] != h[:-1]) | (doc[1:] != doc[:-1])
    at = np.flatnonzero(new)
    return doc[at], h[at], np.diff(np.append(at, len(h))), w.count()


def _sizes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for part in slices(batch, "text"):
            n = split_words(part.column("text"), TERMS).count()
            yield pa.RecordBatch.from_arrays([pa.array([int((n > 0).sum())]), pa.array([int(n.sum())])], ["n", "terms"])


def _shard(parts: list, n_docs: int, n_terms: int) -> dict[str, np.ndarray]:
    """The lists of a shard; ``parts`` are ``_postings`` of consecutive texts."""
    base = np.cumsum([0] + [len(x[3]) for x in parts])
    doc = np.concatenate([x[0] + b for x, b in zip(parts, base)]).astype(np.int64)
    term, tf, size = (np.concatenate([x[i] for x in parts]).astype(t) for i, t in ((1, np.uint64), (2, np.int64), (3, np.int64)))
    order = np.argsort(term, kind="stable")
    term, doc, tf = term[order], doc[order], tf[order]
    m = 10 + 90 * size[doc] * n_docs // max(n_terms, 1)
    impact = 1_000_000_000 * tf // (1000 * tf + 8 * m)
    known, first = np.unique(term, return_index=True)
    first = np.append(first, len(term))
    n = len(size)
    long = np.flatnonzero(np.diff(first) * LONG > n)
    blocks = -(-n // BLOCK)
    begins, bounds = np.zeros((len(long), blocks + 1), np.int64), np.zeros((len(long), blocks), np.int64)
    for i, t in enumerate(long):
        d, x = doc[first[t]:first[t + 1]], impact[first[t]:first[t + 1]]
        begins[i] = np.searchsorted(d, np.arange(blocks + 1) * BLOCK)
        np.maximum.at(bounds[i], d // BLOCK, x)
    return {"terms": known, "first": first, "docs": doc, "impacts": impact, "long": long, "begins": begins.ravel(), "bounds": bounds.ravel()}


def _shards(shard_docs: int, n_docs: int, n_terms: int):
    def row(ids: list, parts: list) -> pa.RecordBatch:
        lists = _shard(parts, n_docs, n_terms)
        ids = pa.concat_arrays(ids)
        return pa.RecordBatch.from_arrays([pa.ListArray.from_arrays(pa.array([0, len(ids)], pa.int32()), ids),
                                           *(pa.array([lists[c].astype(t).tobytes()], pa.binary()) for c, t in LISTS.items())], ["ids", *LISTS])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, parts, n = [], [], 0
        for batch in batches:
            for part in slices(batch, "text"):
                for a in range(0, part.num_rows, shard_docs):
                    some = part.slice(a, shard_docs)
                    ids.append(some.column("id"))
                    parts.append(_postings(some))
                    n += some.num_rows
                    if n >= shard_docs:
                        yield row(ids, parts)
                        ids, parts, n = [], [], 0
        if n:
            yield row(ids, parts)
    return run


def _item_terms(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for part in slices(batch, "text"):
            doc, term, _, _ = _postings(part)
            rows = pa.array(doc)
            yield pa.RecordBatch.from_arrays([part.column("id").take(rows), part.column("rk").take(rows), pa.array(signed(term))], ["id", "rk", "term"])


def _list_lengths(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for terms, first in zip(batch.column("terms"), batch.column("first")):
            t, n = np.frombuffer(terms.as_py(), np.int64), np.diff(np.frombuffer(first.as_py(), np.int32)).astype(np.int64)
            for a in range(0, len(t), 100_000):
                yield pa.RecordBatch.from_arrays([pa.array(t[a:a + 100_000]), pa.array(n[a:a + 100_000])], ["term", "df"])


class ItemBlock:
    """Items of a block: ``terms`` (distinct, sorted), and for every item the places of its terms and their weights."""

    def __init__(self, rows: pd.DataFrame, n_docs: int):
        item = rows.groupby(["id", "rk"], sort=True, dropna=False).ngroup().to_numpy(np.int64)
        order = np.argsort(item, kind="stable")
        first = np.unique(item[order], return_index=True)[1]
        self.id, self.rk = pa.array(rows["id"].to_numpy()[order[first]], from_pandas=True), rows["rk"].to_numpy(np.int64)[order[first]]
        self.first = np.append(first, len(order))
        self.terms, self.term = np.unique(rows["term"].to_numpy(np.int64)[order].view(np.uint64), return_inverse=True)
        self.weight = np.array([math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df + 1))) for df in rows["df"].to_numpy()[order].tolist()], np.int64)

    def __len__(self) -> int:
        return len(self.rk)


class Best:
    """The k best ``(score, id)`` of an item; ``least`` is the score that a document needs to be among them."""

    def __init__(self, k: int):
        self.k, self.rows, self.least = k, [], 1

    def add(self, scores: np.ndarray, ids: list) -> None:
        self.rows = sorted(self.rows + [(-int(s), i is None, i) for s, i in zip(scores, ids)], key=lambda x: x if x[2] is not None else (*x[:2], 0))[:self.k]
        if len(self.rows) == self.k:
            self.least = max(self.least, -self.rows[-1][0])


class Shard:
    def __init__(self, row: dict, block: ItemBlock):
        for c, t in LISTS.items():
            setattr(self, c, np.frombuffer(row[c], t))
        self.ids = row["ids"]
        self.n_blocks = -(-len(self.ids) // BLOCK)
        self.begins, self.bounds = self.begins.reshape(-1, self.n_blocks + 1), self.bounds.reshape(-1, self.n_blocks)
        at = np.minimum(np.searchsorted(self.terms, block.terms), max(0, len(self.terms) - 1))
        self.entry = np.where(self.terms[at] == block.terms, at, -1) if len(self.terms) else np.full(len(block.terms), -1)

    def accumulators(self, entry: np.ndarray, weight: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Term at a time: documents of the lists ``entry``, sorted, and their sums."""
        length = self.first[entry + 1] - self.first[entry]
        at, which = multi_arange(self.first[entry].astype(np.int64), length)
        order = np.argsort(self.docs[at], kind="stable")
        doc, add = self.docs[at][order], (self.impacts[at] * weight[which])[order]
        begin = np.flatnonzero(np.append(True, doc[1:] != doc[:-1])) if len(doc) else np.empty(0, np.int64)
        return doc[begin], np.add.reduceat(add, begin) if len(begin) else np.empty(0, np.int64)

    def search(self, term: np.ndarray, weight: np.ndarray, best: Best) -> int:
        """Adds the item's best documents to ``best``; gives the number of blocks visited."""
        entry = self.entry[term]
        weight, entry = weight[entry >= 0], entry[entry >= 0]
        place = np.searchsorted(self.long, entry)
        is_long = np.append(self.long, -1)[place] == entry
        docs, sums = self.accumulators(entry[~is_long], weight[~is_long])
        lists, factor = place[is_long], weight[is_long]
        # iterators: the long lists and, as the last one, the accumulators; a bound for each in every block
        bounds = np.zeros((len(lists) + 1, self.n_blocks), np.int64)
        bounds[:-1] = self.bounds[lists] * factor[:, None]
        np.maximum.at(bounds[-1], docs // BLOCK, sums)
        begin = np.searchsorted(docs, np.arange(self.n_blocks + 1) * BLOCK)
        total, visited = bounds.sum(0), 0
        if len(sums) >= best.k:                           # k documents score what the accumulators have already, at least
            best.least = max(best.least, int(np.partition(sums, -best.k)[-best.k]))
        for b in np.flatnonzero(total >= best.least).tolist():
            if total[b] < best.least:                     # the k-th best has grown meanwhile
                continue
            visited += 1
            score, open_ = np.zeros(BLOCK, np.int64), np.zeros(BLOCK, bool)
            order = np.argsort(-bounds[:, b], kind="stable")
            left = total[b]
            for i in order.tolist():
                if not bounds[i, b]:
                    break
                # iterators from here on are essential while they could reach the k-th best without those before
                if i == len(lists):
                    at, add = docs[begin[b]:begin[b + 1]] - b * BLOCK, sums[begin[b]:begin[b + 1]]
                else:
                    start = self.first[self.long[lists[i]]]
                    some = slice(start + self.begins[lists[i], b], start + self.begins[lists[i], b + 1])
                    at, add = self.docs[some] - b * BLOCK, self.impacts[some] * factor[i]
                if left >= best.least:
                    open_[at] = True
                score[at] += add
                left -= bounds[i, b]
                open_ &= score + left >= best.least
                if left < best.least and not open_.any():
                    break
            found = np.flatnonzero(open_ & (score >= best.least))
            if len(found):
                if len(found) > 4 * best.k:               # more than can be among the k best, ties apart
                    found = found[score[found] >= np.partition(score[found], -best.k)[-best.k]]
                best.add(score[found], self.ids.take(pa.array(found + b * BLOCK)).to_pylist())
        return visited


def _search(block, k: int, kind: pa.DataType, id_kind: pa.DataType):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        items: ItemBlock = block.value
        best = [Best(k) for _ in range(len(items))]
        for batch in batches:
            for i in range(batch.num_rows):
                shard = Shard({c: batch.column(c)[i].as_py() for c in LISTS} | {"ids": batch.column("ids")[i].values}, items)
                for j, b in enumerate(best):
                    x, y = items.first[j], items.first[j + 1]
                    shard.search(items.term[x:y], items.weight[x:y], b)
        who = pa.array([j for j, b in enumerate(best) for _ in b.rows], pa.int64())
        found = [x for b in best for x in b.rows]
        out = pa.RecordBatch.from_arrays([items.id.take(who).cast(id_kind), pa.array(items.rk).take(who), pa.array([x[2] for x in found], kind),
                                          pa.array([-x[0] for x in found], pa.int64())], ["item_id", "rk", "doc_id", "score"])
        yield from (out.slice(a, 100_000) for a in range(0, out.num_rows, 100_000))
    return run


def _item_blocks(weighted: DataFrame, most: int) -> list[DataFrame]:
    """Rows of items in blocks of at most ``most`` rows, whole items each; an item of more terms may be a block of its own."""
    n = weighted.count()
    if n <= most:
        return [weighted] if n else []
    buckets = weighted.withColumn("_b", F.pmod(F.xxhash64("id", "rk"), F.lit(64 * -(-n // most))))
    sizes = [(r["_b"], r.n) for r in buckets.groupBy("_b").agg(F.count(F.lit(1)).alias("n")).collect()]
    return [buckets.where(F.col("_b").between(a, b)) for a, b in packed(sizes, most)]


def rank_documents(spark: SparkSession, docs: DataFrame, items: DataFrame, k: int = 10, shard_docs: int = 2048, block_terms: int = 500_000,
                   id_col: str = "doc_id", text_col: str = "text", item_id: str = "item_id", item_text: str = "text") -> DataFrame:
    """``item_id, rank, doc_id, score``: the k best rows of ``docs`` for every row of ``items``."""
    d = keyed(docs, id_col, text_col)
    asked = keyed(items, item_id, item_text).dropDuplicates(["id", "rk"])
    kind, asked_kind = d.schema["id"].dataType.simpleString(), asked.schema["id"].dataType.simpleString()
    n_docs, n_terms = d.select("text").mapInArrow(_sizes, "n long, terms long").agg(F.coalesce(F.sum("n"), F.lit(0)), F.coalesce(F.sum("terms"), F.lit(0))).first()
    index = stored(d.mapInArrow(_shards(shard_docs, n_docs, n_terms), f"ids array<{kind}>, " + ", ".join(f"{c} binary" for c in LISTS)), "lexical-index")
    terms = stored(asked.mapInArrow(_item_terms, f"id {asked_kind}, rk long, term long"), "item-terms")
    lengths = index.select("terms", "first").mapInArrow(_list_lengths, "term long, df long")
    df = lengths.join(terms.select("term").distinct(), "term", "left_semi").groupBy("term").agg(F.sum("df").alias("df"))
    weighted = stored(terms.join(df, "term"), "weighted-terms")
    cut, found = _item_blocks(weighted, block_terms), None
    for rows in cut:
        block = spark.sparkContext.broadcast(ItemBlock(rows.select("id", "rk", "term", "df").toArrow().to_pandas(integer_object_nulls=True), n_docs))
        one = index.mapInArrow(_search(block, k, to_arrow_type(d.schema["id"].dataType), to_arrow_type(asked.schema["id"].dataType)),
                               f"item_id {asked_kind}, rk long, doc_id {kind}, score long")
        if len(cut) > 1:
            one = stored(one, "block-results")
            block.unpersist(blocking=True)                # the driver holds one block at a time
        found = one if found is None else found.unionByName(one)
    if found is None:
        return spark.createDataFrame([], f"item_id {asked_kind}, rank int, doc_id {kind}, score long")
    w = Window.partitionBy("item_id", "rk").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
    return found.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k).select("item_id", "rank", "doc_id", "score")


def op13_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    return rank_documents(spark, docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


OP13_SQL = r"""
WITH dt AS (SELECT doc_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                   '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS t FROM documents),
it AS (SELECT DISTINCT item_id, t FROM (SELECT item_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                   '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS t FROM benchmark)),
tf AS (SELECT doc_id, t, count(*)::BIGINT AS tf FROM dt GROUP BY 1, 2),
dl AS (SELECT doc_id, sum(tf)::BIGINT AS n FROM tf GROUP BY 1),
st AS (SELECT count(*)::BIGINT AS nd, sum(n)::BIGINT AS nt FROM dl),
w AS (SELECT t, floor(1000 * ln((2 * nd + 2)::DOUBLE / (2 * count(*) + 1)))::BIGINT AS w FROM tf, st GROUP BY t, nd),
s AS (SELECT item_id, doc_id, sum(w * ((1000000000 * tf) // (1000 * tf + 8 * (10 + (90 * n * nd) // nt))))::BIGINT AS score
      FROM it JOIN tf USING (t) JOIN w USING (t) JOIN dl USING (doc_id), st GROUP BY 1, 2)
SELECT item_id, rank::INTEGER AS rank, doc_id, score
FROM (SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS rank FROM s WHERE score > 0) WHERE rank <= 10
"""

"""Benchmark decontamination: a prefix-filtered set join of documents with item-sized windows.

Every benchmark item is cut into windows of ``window`` consecutive words (an
item of fewer words is one window).  A window's shingles (``shingle`` words
each, with their offsets) are ordered by rarity, counted over all documents.
Containment is asked in full, so a document that holds a window holds each of
its shingles and the necessary prefix is its single rarest one.  A document
shingle equal to a prefix shingle proposes ``start = position - offset``;
``start >= 0`` and ``start + length <= n_words`` bound it by position and
length; what is left is verified word by word, first on hashes and then on the
bytes of the text.

The join is made on the map side: the prefix index of a *slice* of the
benchmark is broadcast.  Slices are cut by measured sizes: the distinct items
are dealt into many buckets by a hash of id and text, and buckets are put
together up to ``4 * slice_words`` characters, so one id with many rows spreads
over slices and only a bucket that is larger by itself (in effect, one huge
item) makes a larger slice.  A slice passes through the driver, which builds its
index; any benchmark goes through in as many passes as it needs and no document
moves.  Rarity is a first pass that counts, per task, only the
shingles of the slice and sums them in Spark.

Defined results: null or wordless texts have no words and no hits; an item
without words has no window; repeated documents are judged each; repeated item
ids count once; an item without an id is searched like any other, its hits count
and contaminate, only ``items`` has no id to list.  ``op4_decontaminate`` leaves
such items out, as its SQL does.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from caliper.llm.passages import stored
from caliper.llm.words import ALNUM, Words, multi_arange, opened, packed, signed, slices, split_words

SPAN = T.StructType().add("a", "long").add("b", "long")
OUT = [T.StructField("n_words", T.LongType()), T.StructField("covered", T.ArrayType(SPAN)), T.StructField("items", T.ArrayType(T.StringType()))]


class _Slice:
    """Windows of a slice of the benchmark: words, shingles, items."""

    def __init__(self, items: list[tuple[str | None, str]], window: int, shingle: int):
        w = split_words(pa.array([t for _, t in items], pa.string()), ALNUM, lower=True)
        self.text: list[bytes] = []
        self.ids: list[list[str]] = []
        words: list[np.ndarray] = []
        seen: dict[bytes, int] = {}
        for d, (item, _) in enumerate(items):
            a, b = int(w.first[d]), int(w.first[d + 1])
            for i in range(a, max(a + 1, b - window + 1) if b > a else a):
                text = w.bytes(i, min(b, i + window))
                k = seen.setdefault(text, len(seen))
                if k == len(words):
                    words.append(w.hash[i:min(b, i + window)])
                    self.text.append(text)
                    self.ids.append([])
                if item is not None and item not in self.ids[k]:
                    self.ids[k].append(item)
        self.length = np.array([len(x) for x in words], np.int64)
        self.words = np.zeros((len(words), window), np.uint64)
        for k, x in enumerate(words):
            self.words[k, :len(x)] = x
        # shingles of each window: (size, hash, window, offset)
        size, hashes, owner, offset = [], [], [], []
        for k, x in enumerate(words):
            s = min(shingle, len(x))
            one = Words(np.empty(0, np.uint8), np.empty(0), np.empty(0), np.array([0, len(x)]), x)
            h = one.ngrams(s)[0]
            hashes.append(h), size.append(np.full(len(h), s)), owner.append(np.full(len(h), k)), offset.append(np.arange(len(h)))
        cat = lambda x, t: np.concatenate(x).astype(t) if x else np.empty(0, t)
        self.size, self.hash, self.owner, self.offset = cat(size, np.int64), cat(hashes, np.uint64), cat(owner, np.int64), cat(offset, np.int64)

    def candidates(self) -> dict[int, np.ndarray]:
        """Distinct shingle hashes by shingle size, sorted."""
        return {int(s): np.unique(self.hash[self.size == s]) for s in np.unique(self.size)}

    def prefixes(self, df: dict[tuple[int, int], int]) -> dict[int, tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """The rarest shingle of each window: by size, sorted hashes with window and offset."""
        count = np.array([df.get((int(s), int(h)), 0) for s, h in zip(self.size, signed(self.hash))], np.int64)
        order = np.lexsort((self.offset, self.hash, count, self.owner))
        first = order[np.unique(self.owner[order], return_index=True)[1]] if len(order) else order
        out = {}
        for s in np.unique(self.size[first]):
            f = first[self.size[first] == s]
            f = f[np.argsort(self.hash[f], kind="stable")]
            out[int(s)] = (self.hash[f], self.owner[f], self.offset[f])
        return out


def _shingle_counts(cand, text_col):
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sizes = cand.value
        totals = {s: np.zeros(len(h), np.int64) for s, h in sizes.items()}
        for batch in batches:
            for part in slices(batch, text_col, 1_000_000):
                w = split_words(part.column(text_col), ALNUM, lower=True)
                for s, known in sizes.items():
                    h, inside = w.ngrams(s)
                    h = h[inside]
                    at = np.minimum(np.searchsorted(known, h), len(known) - 1)
                    totals[s] += np.bincount(at[known[at] == h], minlength=len(known))
        for s, known in sizes.items():
            some = np.flatnonzero(totals[s])
            yield pa.RecordBatch.from_arrays([pa.array(np.full(len(some), s), pa.int32()), pa.array(signed(known[some])),
                                              pa.array(totals[s][some])], ["s", "h", "n"])
    return count


def _find(index, id_cols, text_col, within=None):
    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sl, prefixes = index.value
        for batch in opened(batches, text_col, within):
            for part in slices(batch, text_col, 1_000_000):
                w = split_words(part.column(text_col), ALNUM, lower=True)
                n_docs, doc = part.num_rows, w.doc()
                covered: list[list] = [[] for _ in range(n_docs)]
                found: list[set] = [set() for _ in range(n_docs)]
                for s, (known, owner, offset) in prefixes.items():
                    h, inside = w.ngrams(s)
                    lo = np.searchsorted(known, h, "left")
                    some = np.flatnonzero((known[np.minimum(lo, len(known) - 1)] == h) & inside) if len(h) else np.empty(0, np.int64)
                    lo = lo[some]
                    entry, k = multi_arange(lo, np.searchsorted(known, h[some], "right") - lo)
                    pos, win = some[k], owner[entry]
                    start, d = pos - offset[entry], doc[pos]
                    ok = (start >= w.first[d]) & (start + sl.length[win] <= w.first[d + 1])      # position and length
                    start, win, d = start[ok], win[ok], d[ok]
                    ok = np.ones(len(start), bool)
                    for j in range(sl.words.shape[1]):                                          # words, by hash
                        here = j < sl.length[win]
                        ok &= ~here | (w.hash[np.where(here, start + j, 0)] == sl.words[win, j])
                    for i, k, t in zip(start[ok].tolist(), win[ok].tolist(), d[ok].tolist()):
                        j = i + int(sl.length[k])
                        if w.bytes(i, j) == sl.text[k]:                                         # words, by their bytes
                            covered[t].append({"a": i - int(w.first[t]), "b": j - int(w.first[t])})
                            found[t].update(sl.ids[k])
                yield pa.RecordBatch.from_arrays(
                    [*[part.column(c) for c in id_cols], pa.array(w.count(), pa.int64()),
                     pa.array([_merged(c) for c in covered], pa.list_(pa.struct([("a", pa.int64()), ("b", pa.int64())]))),
                     pa.array([sorted(x) for x in found], pa.list_(pa.string()))],
                    [*id_cols, "n_words", "covered", "items"])
    return find


def _merged(spans: list[dict]) -> list[dict]:
    out: list[dict] = []
    for s in sorted(spans, key=lambda x: (x["a"], x["b"])):
        if out and s["a"] <= out[-1]["b"]:
            out[-1]["b"] = max(out[-1]["b"], s["b"])
        else:
            out.append(dict(s))
    return out


def _n_hit(spans: Column) -> Column:
    """Words in the union of sorted or unsorted spans."""
    start = F.struct(F.lit(0).cast("long").alias("n"), F.lit(0).cast("long").alias("e"))
    step = lambda acc, x: F.struct((acc["n"] + F.greatest(F.lit(0).cast("long"), x["b"] - F.greatest(acc["e"], x["a"]))).alias("n"),
                                   F.greatest(acc["e"], x["b"]).alias("e"))
    return F.aggregate(F.sort_array(spans), start, step)["n"]


def _item_slices(items: DataFrame, most: int) -> list[DataFrame]:
    """``items (i, t)`` in slices of at most ``most`` characters."""
    n_chars = items.agg(F.coalesce(F.sum(F.length("t")), F.lit(0))).first()[0]
    if n_chars <= most:
        return [items]
    items = stored(items.distinct().withColumn("_b", F.pmod(F.xxhash64("i", "t"), F.lit(64 * -(-n_chars // most)))), "benchmark")
    sizes = [(r["_b"], r.n) for r in items.groupBy("_b").agg(F.sum(F.length("t")).alias("n")).collect()]
    return [items.where(F.col("_b").between(a, b)) for a, b in packed(sizes, most)]


def decontaminate(spark: SparkSession, docs: DataFrame, items: DataFrame, window: int = 10, shingle: int = 3,
                  slice_words: int = 2_000_000, id_cols: tuple[str, ...] = ("doc_id",), text_col: str = "text",
                  item_id: str = "item_id", item_text: str = "text", within: str | None = None) -> DataFrame:
    """Per row of ``docs``: ``id_cols, n_words, n_hit, items, contaminated``.

    The text may be a field of a struct among ``id_cols``, ``within``; it then goes to the Python workers once, in there.
    """
    items = items.select(F.col(item_id).cast("string").alias("i"), F.col(item_text).alias("t")).where("t is not null")
    cut = _item_slices(items, 4 * slice_words)
    d = docs.select(*dict.fromkeys([*id_cols, *([] if within else [text_col])]))
    text = F.col(within)[text_col] if within else F.col(text_col)
    if len(cut) > 1:                                      # rows with equal or null ids are kept apart by their text
        d = d.withColumn("_text", F.struct(F.xxhash64(text), F.hash(text)))
    keys = (*id_cols, "_text") if len(cut) > 1 else id_cols
    schema = T.StructType([d.schema[c] for c in keys] + OUT)
    parts = []
    for k, some in enumerate(cut):
        rows = some.orderBy("i", "t").collect()
        sl = _Slice([(r.i, r.t) for r in rows], window, shingle)
        if not len(sl.length) and k < len(cut) - 1:
            continue
        cand = spark.sparkContext.broadcast(sl.candidates())
        counts = d.select(text.alias(text_col)).mapInArrow(_shingle_counts(cand, text_col), "s int, h long, n long") if len(sl.length) else None
        df = {(r.s, r.h): r.n for r in counts.groupBy("s", "h").agg(F.sum("n").alias("n")).collect()} if counts is not None else {}
        index = spark.sparkContext.broadcast((sl, sl.prefixes(df)))
        parts.append(d.mapInArrow(_find(index, keys, text_col, within), schema).withColumn("_slice", F.lit(k)))
    if len(parts) == 1:
        out = parts[0]
    else:
        # every slice gives a row for each row of docs; equal rows are told apart by their number, and a slice says the same of all of them
        both = parts[0]
        for p in parts[1:]:
            both = both.unionByName(p)
        out = (both.groupBy(*keys, "n_words")
               .agg(F.collect_set(F.struct("_slice", "covered", "items")).alias("found"), F.count(F.lit(1)).alias("n"))
               .withColumn("covered", F.flatten(F.col("found.covered"))).withColumn("items", F.array_distinct(F.flatten(F.col("found.items"))))
               .withColumn("_copy", F.explode(F.sequence(F.lit(1), (F.col("n") / len(parts)).cast("int")))))
    return out.select(*id_cols, "n_words", _n_hit(F.col("covered")).alias("n_hit"), F.sort_array("items").alias("items"),
                      (F.size("covered") > 0).alias("contaminated"))


def op4_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    items = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    return decontaminate(spark, docs, items).select(
        "doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), "contaminated")


OP4_SQL = r"""
WITH dw AS (SELECT doc_id, coalesce(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                   '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+'), []) AS ws FROM documents),
iw AS (SELECT item_id::VARCHAR AS item_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                   '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS ws FROM benchmark WHERE text IS NOT NULL),
win AS (SELECT DISTINCT item_id, least(10, len(ws)) AS n, array_to_string(ws[i:i + 9], ' ') AS w
        FROM (SELECT item_id, ws, unnest(generate_series(1, greatest(1, len(ws) - 9))) AS i FROM iw WHERE len(ws) > 0)),
lens AS (SELECT DISTINCT n FROM win),
hit AS (SELECT doc_id, i, n, item_id FROM
          (SELECT doc_id, n, i, array_to_string(ws[i:i + n - 1], ' ') AS w FROM
             (SELECT doc_id, ws, n, unnest(generate_series(1, len(ws) - n + 1)) AS i FROM dw, lens WHERE len(ws) >= n)) d
        JOIN win USING (n, w)),
cov AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(generate_series(i, i + n - 1)) AS p FROM hit) GROUP BY doc_id),
its AS (SELECT doc_id, count(*) AS n_items, sha256(string_agg(item_id, ',' ORDER BY item_id)) AS s
        FROM (SELECT DISTINCT doc_id, item_id FROM hit WHERE item_id IS NOT NULL) GROUP BY doc_id)
SELECT doc_id, len(ws)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items,
       coalesce(s, sha256('')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM dw LEFT JOIN cov USING (doc_id) LEFT JOIN its USING (doc_id)
"""

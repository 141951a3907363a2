"""Periodic run detection by internal pattern matching.

A *run* is a stretch of consecutive words with smallest period q (words q apart
are identical) of at least ``max(least, times * q)`` words that no neighbouring
word extends.  Words are ``[^\\x20\\x09-\\x0D]+``, told apart by 64-bit hashes.

Documents are independent of each other, so the work is one map over the rows:
Spark deals them out, nothing is shuffled.  Inside a task:

1. Most documents have no run, which their ``GRAM``-word grams prove: inside a
   run nearly every gram occurred at most q words before.  Stretches of grams
   that did are too short for their own distances everywhere else.  Only
   documents where such a stretch is left are looked at further.
2. Their words, a separator after each document, get a suffix array by prefix
   doubling; the ranks of every round are kept.  They name all *dyadic blocks*
   (2^k words), give each block's interval of the suffix array, and the longest
   common extension of two places in a step per round.
3. A wavelet tree over the suffix array answers range successor: the next (or
   last) place of a block after (or before) a given one.  A run of period q with
   ``2^(k-1) < q <= 2^k`` covers an aligned block of 2^k words as it has 4 q
   words or more; the block's occurrences in the neighbouring window are a
   progression with difference q, so its successor or predecessor in the
   window is q words away, a candidate period.
4. A candidate is extended to both sides as far as words q apart agree and is a
   run if it is long enough.  Its period is the smallest: with a smaller one the
   block would have occurred closer by.

Defined results: null, empty and wordless texts have no word, no run and an
empty kept text; equal rows are judged each.  Memory is about 40 words of 8
bytes for each word of a batch of texts of ``BATCH`` words (or of one longer
text).
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from caliper.llm.words import SPACED, Words, multi_arange, slices, split_words

GRAM = 4
BATCH = 250_000


def suspects(w: Words, least: int, times: int) -> np.ndarray:
    """Texts whose grams do not rule a run out.

    A run of period q and ``times * q`` words has ``times * q - q - 3`` grams in
    a row (two at least, for least = 6) that occurred at most q words before.  In
    a stretch of m such grams that bounds q by ``(m + 3) / (times - 1)``, hence
    the distance of each of them.
    """
    grams, inside = w.ngrams(GRAM)
    at = np.flatnonzero(inside)
    doc = w.doc()[at]
    key = grams[at] + doc.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    order = np.argsort(key, kind="stable")
    same = key[order][1:] == key[order][:-1]
    back = np.zeros(len(at), np.int64)                    # distance to the gram's last occurrence in the text, 0: none
    back[order[1:][same]] = at[order[1:][same]] - at[order[:-1][same]]
    rows = np.flatnonzero(back)
    while len(rows):
        new = np.append(True, (np.diff(at[rows]) != 1) | (np.diff(doc[rows]) != 0))
        m = np.diff(np.append(np.flatnonzero(new), len(rows)))
        stay = (back[rows] <= np.repeat((m + 3) // (times - 1), m)) & np.repeat(m >= least - GRAM, m)
        if stay.all():
            break
        rows = rows[stay]
    return np.unique(doc[rows])


class Blocks:
    """Ranks of all dyadic blocks of a word sequence, and its suffix array."""

    def __init__(self, words: np.ndarray):
        n = len(words)
        rank = np.unique(words, return_inverse=True)[1]
        self.ranks = [rank.astype(np.int32)]
        while int(rank.max()) < n - 1:
            step = 1 << (len(self.ranks) - 1)
            behind = np.zeros(n, np.int64)
            behind[:max(0, n - step)] = rank[step:] + 1
            key = rank.astype(np.int64) * (n + 1) + behind
            order = np.argsort(key)
            new = np.append(0, key[order][1:] != key[order][:-1])
            rank = np.empty(n, np.int64)
            rank[order] = np.cumsum(new)
            self.ranks.append(rank.astype(np.int32))
        self.suffixes = np.argsort(rank)

    def interval(self, k: int, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Of the blocks of 2^k words at ``at``: their interval of the suffix array."""
        count = np.bincount(self.ranks[k])
        end = np.cumsum(count)
        r = self.ranks[k][at]
        return end[r] - count[r], end[r]

    def forth(self, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        """How many words from i and from j on agree."""
        n, total = len(self.suffixes), np.zeros(len(i), np.int64)
        for k in range(len(self.ranks) - 1, -1, -1):
            x, y = np.minimum(i + total, n - 1), np.minimum(j + total, n - 1)
            total += (self.ranks[k][x] == self.ranks[k][y]) * (1 << k)
        return total

    def back(self, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        """How many words before i and before j agree."""
        total = np.zeros(len(i), np.int64)
        for k in range(len(self.ranks) - 1, -1, -1):
            x, y = i - total - (1 << k), j - total - (1 << k)
            total += ((x >= 0) & (self.ranks[k][np.maximum(x, 0)] == self.ranks[k][np.maximum(y, 0)])) * (1 << k)
        return total


class WaveletTree:
    """Order statistics of intervals of a permutation: one bit of the values a level, stably split."""

    def __init__(self, values: np.ndarray):
        self.bits = max(1, int(len(values) - 1).bit_length())
        self.zeros, self.split = [], []
        for b in range(self.bits - 1, -1, -1):
            one = (values >> b & 1).astype(bool)
            self.zeros.append(np.append(0, np.cumsum(~one)).astype(np.int32))
            self.split.append(int(self.zeros[-1][-1]))
            values = np.concatenate([values[~one], values[one]])

    def below(self, lo: np.ndarray, hi: np.ndarray, x: np.ndarray) -> np.ndarray:
        """How many values of the interval ``lo:hi`` are less than x."""
        out = np.zeros(len(x), np.int64)
        for level, (zeros, split) in enumerate(zip(self.zeros, self.split)):
            one = (x >> (self.bits - 1 - level) & 1).astype(bool)
            l0, h0 = zeros[lo], zeros[hi]
            out += np.where(one, h0 - l0, 0)
            lo, hi = np.where(one, split + lo - l0, l0), np.where(one, split + hi - h0, h0)
        return out

    def smallest(self, lo: np.ndarray, hi: np.ndarray, j: np.ndarray) -> np.ndarray:
        """The j-th smallest value (from 0) of the interval ``lo:hi``."""
        out = np.zeros(len(j), np.int64)
        for level, (zeros, split) in enumerate(zip(self.zeros, self.split)):
            l0, h0 = zeros[lo], zeros[hi]
            one = j >= h0 - l0
            j = np.where(one, j - (h0 - l0), j)
            out |= one.astype(np.int64) << (self.bits - 1 - level)
            lo, hi = np.where(one, split + lo - l0, l0), np.where(one, split + hi - h0, h0)
        return out


def find_runs(words: np.ndarray, longest: int, least: int, times: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start, length and period of all runs of ``words`` (texts of at most ``longest`` words, a separator of its own after each)."""
    n, blocks = len(words), Blocks(words)
    tree = WaveletTree(blocks.suffixes)
    found = []
    for k in range(min(len(blocks.ranks), int(max(1, 2 * longest // times)).bit_length())):
        size = 1 << k
        at = np.arange(0, n - size + 1, size)
        lo, hi = blocks.interval(k, at)
        some = hi - lo > 1
        at, lo, hi = at[some], lo[some], hi[some]
        place = tree.below(lo, hi, at)
        for step in (1, -1):                              # the next occurrence after, the last one before
            has = (place + step >= 0) & (place + step < hi - lo)
            other = tree.smallest(lo[has], hi[has], place[has] + step)
            first, q = np.minimum(at[has], other), np.abs(other - at[has])
            near = (q <= size) & (2 * q > size)
            found.append(np.stack([first[near], q[near]]))
    first, q = np.concatenate(found, axis=1)
    start = first - blocks.back(first, first + q)
    length = first + q + blocks.forth(first, first + q) - start
    run = length >= np.maximum(least, times * q)
    rows = np.unique(np.stack([start, q, length])[:, run], axis=1)
    return rows[0], rows[2], rows[1]


def text_runs(w: Words, least: int, times: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Text, start, length and period of all runs of a batch of texts, by text, start and period."""
    docs, count = suspects(w, least, times), w.count()
    out = [np.empty((4, 0), np.int64)]
    turn = (np.cumsum(count[docs]) - count[docs]) // BATCH
    for part in np.split(docs, np.flatnonzero(np.diff(turn)) + 1) if len(docs) else []:
        size = count[part]
        at, which = multi_arange(w.first[part], size)
        words = np.zeros(len(at) + len(part), np.uint64)
        ends = np.cumsum(size + 1)
        known, words_id = np.unique(w.hash[at], return_inverse=True)
        words = np.empty(len(at) + len(part), np.int64)
        words[np.arange(len(at)) + which] = words_id
        words[ends - 1] = len(known) + np.arange(len(part))
        start, length, period = find_runs(words, int(size.max()), least, times)
        row = np.searchsorted(ends, start, side="right")
        out.append(np.stack([part[row], start - (ends - size - 1)[row], length, period]))
    doc, start, length, period = np.concatenate(out, axis=1)
    order = np.lexsort((period, start, doc))
    return doc[order], start[order], length[order], period[order]


def _collapse(least: int, times: int, text_col: str, keep: list[str]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, text_col):
                w = split_words(part.column(text_col), SPACED)
                doc, start, length, period = text_runs(w, least, times)
                # words of a run after its first period are dropped
                step = np.zeros(len(w.hash) + 1, np.int64)
                np.add.at(step, w.first[doc] + start + period, 1)
                np.add.at(step, w.first[doc] + start + length, -1)
                dropped = np.cumsum(step)[:-1] > 0
                kept = [w.spaced(a, b) for a, b in zip(w.first[:-1], w.first[1:])]
                for d in np.unique(doc).tolist():
                    stay = np.flatnonzero(~dropped[w.first[d]:w.first[d + 1]]) + w.first[d]
                    kept[d] = b" ".join([w.data[a:b].tobytes() for a, b in zip(w.start[stay], w.end[stay])])
                per = np.bincount(doc, minlength=part.num_rows)
                fields = pa.StructArray.from_arrays([pa.array(x) for x in (start, length, period)], ["start", "length", "period"])
                runs = pa.ListArray.from_arrays(pa.array(np.append(0, np.cumsum(per)), pa.int32()), fields)
                yield pa.RecordBatch.from_arrays([*(part.column(c) for c in keep), pa.array(w.count()), runs, pa.array(kept, pa.binary()).cast(pa.string())],
                                                 [*keep, "n_words", "runs", "kept"])
    return run


def collapse_runs(docs: DataFrame, least: int = 6, times: int = 4, id_cols: tuple[str, ...] = ("doc_id",), text_col: str = "text") -> DataFrame:
    """Per row of ``docs``: ``id_cols, n_words, runs`` (start, length, period; by start, then period) and ``kept``, the text without repetitions.

    ``times`` is 4 or more and ``least`` 6 or more: shorter runs need not cover an aligned block or a repeated gram.
    """
    if times < 4 or least < GRAM + 2:
        raise ValueError("runs of fewer than 4 periods or 6 words are not covered")
    kinds = ", ".join(f"`{c}` {docs.schema[c].dataType.simpleString()}" for c in id_cols)
    rows = docs.select(*dict.fromkeys([*id_cols, text_col]))
    return rows.mapInArrow(_collapse(least, times, text_col, list(id_cols)),
                           f"{kinds}, n_words long, runs array<struct<start:long,length:long,period:long>>, kept string")


def strongest(runs: Column) -> Column:
    """The run of the greatest exact length / period; the first of equals (runs come by start, then period)."""
    better = lambda x, y: x["length"] * y["period"] > y["length"] * x["period"]
    return F.aggregate(runs, F.get(runs, F.lit(0)), lambda best, x: F.when(better(x, best), x).otherwise(best))


def with_periodic_ends(docs: DataFrame) -> DataFrame:
    """``doc_id, text``; of a tenth of the documents, by the checksum of the id, with a periodic end (words joined by a space)."""
    h = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    # a column of its own, so that words are cut once a document
    cut = docs.select("doc_id", "text", F.floor(h / 10).alias("g"), F.when(F.pmod(h, F.lit(10)) == 0, F.regexp_extract_all("text", F.lit(r"([^\x20\x09-\x0D]+)"), 1)).alias("ws"))
    cut = cut.withColumn("n", F.size("ws").cast("long"))
    a = F.pmod(F.col("g"), F.col("n"))
    cut = cut.withColumn("a", F.when(F.col("n") > 0, a)).withColumn("p", F.when(F.col("n") > 0, 1 + F.floor((F.col("n") - a) / (3 + F.pmod(F.col("g"), F.lit(8))))))
    periodic = F.transform("ws", lambda x, i: F.when(i < F.col("a"), x).otherwise(F.get("ws", (F.col("a") + F.pmod(i - F.col("a"), F.col("p"))).cast("int"))))
    return cut.select("doc_id", F.when(F.col("n") > 0, F.array_join(periodic, " ")).otherwise(F.col("text")).alias("text"))


def op11_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    out = collapse_runs(with_periodic_ends(docs))
    line = lambda x: F.concat_ws(",", x["start"], x["length"], x["period"])
    best = strongest(F.col("runs"))
    return out.select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), best["start"].alias("start"), best["length"].alias("length"), best["period"].alias("period"),
        F.floor(1000 * best["length"] / best["period"]).cast("long").alias("exponent_milli"),
        F.sha2(F.array_join(F.transform("runs", lambda x: F.concat(line(x), F.lit("\n"))), ""), 256).alias("runs_sha256"),
        F.sha2("kept", 256).alias("collapsed_sha256"))

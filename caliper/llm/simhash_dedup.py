"""SimHash near-duplicates by pigeonhole blocks.

1. Fingerprint: a document's ``n``-word shingles, repeats included, are hashed
   (XXH64 of the words joined by one space, A-Z lower-cased); a bit is 1 if it
   is set in more than half of the hashes.
2. Equal fingerprints are one class; classes are what is joined.
3. Pigeonhole: the bits are split into ``differ + 1`` blocks.  Fingerprints that
   differ in at most ``differ`` bits agree in one block at least, so each goes
   to one *bucket* a block, and close pairs share a bucket.
4. A bucket of more than ``bucket`` fingerprints is split once more: the bits
   that its members need not share are cut into ``differ + 1`` blocks again.
   By the same argument no close pair is lost, and as r open bits leave at most
   2^r fingerprints, this ends.  So no task compares more than ``bucket``
   fingerprints with each other, however many lie close together, and a hot
   bucket costs a few copies of its rows, not their square.
5. In each bucket the Hamming distances of its members are verified and a
   spanning forest of the links is emitted, never all pairs; components of the
   forests are those of all links.

Defined results: a text of fewer words than ``n`` is one shingle; null and
wordless texts have fingerprint zero and link like any other; equal rows are
two documents; a null id is never a component's id unless all its ids are null.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from caliper.llm.components import components, stars
from caliper.llm.passages import discard, stored
from caliper.llm.words import slices

ALL = (1 << 64) - 1
VOTES = 100_000         # hashes whose bits are counted at a time


def shingle_hashes(text: bytes, n: int, seed: int) -> np.ndarray:
    """XXH64 of every run of ``n`` words of ``text`` (of all words, if fewer)."""
    words = text.lower().split()                         # bytes: only A-Z, and only the six ASCII separators
    joined = b" ".join(words)
    m = max(1, len(words) - n + 1) if words else 0
    start = np.cumsum([0] + [len(w) + 1 for w in words])
    end = start[min(n, len(words)):] - 1
    digest = xxhash.xxh64_intdigest
    return np.fromiter((digest(joined[a:b], seed) for a, b in zip(start[:m].tolist(), end[:m].tolist())), np.uint64, m)


def fingerprint(hashes: np.ndarray) -> int:
    votes = np.zeros(64, np.int64)
    for i in range(0, len(hashes), VOTES):
        some = hashes[i:i + VOTES].astype(">u8").view(np.uint8).reshape(-1, 8)
        votes += np.unpackbits(some, axis=1).sum(0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * votes > len(hashes)).tobytes(), "big")


def _fingerprints(n: int, seed: int, text_col: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, text_col):
                texts = part.column(text_col).cast(pa.large_binary())
                fp = np.array([fingerprint(shingle_hashes(t.as_py() or b"", n, seed)) for t in texts], np.uint64)
                yield pa.RecordBatch.from_arrays([part.column("id"), pa.array(fp.view(np.int64))], ["id", "fp"])
    return run


def split_bits(mask: int, parts: int) -> list[int]:
    """``mask`` with each of ``parts`` nearly equal blocks of the bits that it leaves open."""
    bits = [b for b in range(63, -1, -1) if not mask >> b & 1]
    cuts = [len(bits) * i // parts for i in range(parts + 1)]
    return sorted({mask | sum(1 << b for b in bits[x:y]) for x, y in zip(cuts, cuts[1:])} - {mask})


def _long(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def _bucket_links(differ: int):
    """Spanning forests of the links within buckets; rows come sorted by bucket."""
    def links(mask: np.ndarray, key: np.ndarray, fp: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        last = np.append((mask[1:] != mask[:-1]) | (key[1:] != key[:-1]), True)
        after = np.flatnonzero(last)[np.cumsum(np.append(0, last[:-1]))] - np.arange(len(fp))   # members behind each row
        a, b, rows, step = [], [], np.flatnonzero(after), 1
        while len(rows):
            close = np.bitwise_count(fp[rows] ^ fp[rows + step]) <= differ
            x, y = stars(fp[rows[close]].view(np.int64), fp[rows[close] + step].view(np.int64))
            a.append(x)
            b.append(y)
            step += 1
            rows = rows[after[rows] >= step]
        return stars(np.concatenate(a), np.concatenate(b)) if a else (np.empty(0, np.int64), np.empty(0, np.int64))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rest = tuple(np.empty(0, np.int64) for _ in range(3))
        for batch in batches:
            rows = tuple(np.concatenate([r, batch.column(c).to_numpy()]) for r, c in zip(rest, ("mask", "key", "fp")))
            if not len(rows[0]):
                continue
            other = (rows[0] != rows[0][-1]) | (rows[1] != rows[1][-1])
            open_ = int(np.flatnonzero(other)[-1]) + 1 if other.any() else 0
            rest = tuple(r[open_:] for r in rows)                       # the last bucket may go on in the next batch
            a, b = links(rows[0][:open_], rows[1][:open_], rows[2][:open_].view(np.uint64))
            yield pa.RecordBatch.from_arrays([pa.array(a), pa.array(b)], ["a", "b"])
        a, b = links(rest[0], rest[1], rest[2].view(np.uint64))
        yield pa.RecordBatch.from_arrays([pa.array(a), pa.array(b)], ["a", "b"])
    return run


def close_edges(spark: SparkSession, classes: DataFrame, differ: int, bucket: int) -> DataFrame:
    """Edges ``(a, b)`` that connect the fingerprints ``fp`` of ``classes`` (distinct) as their links do."""
    if bucket < 1 << differ:
        raise ValueError("a bucket of `differ` open bits cannot be split: it needs room for 2 ** differ fingerprints")
    found, masks, members, old = [], [0], classes.select("fp"), None
    while masks:
        split = {m: [_long(c) for c in split_bits(m, differ + 1)] for m in masks}
        if old is None:
            one = members.withColumn("child", F.explode(F.array(*[F.lit(c) for c in split[0]])))
        else:                                             # a row for each block of each open mask: at most (differ + 1) ** level rows
            pairs = spark.createDataFrame([(_long(m), c) for m, cs in split.items() for c in cs], "mask long, child long")
            one = members.join(F.broadcast(pairs), "mask")
        one = stored(one.select(F.col("child").alias("mask"), F.col("fp").bitwiseAND(F.col("child")).alias("key"), "fp"), "blocks")
        size = stored(one.groupBy("mask", "key").agg(F.count(F.lit(1)).alias("n")).where("n > 1"), "bucket-sizes")
        ready = one.join(size.where(F.col("n") <= bucket), ["mask", "key"], "left_semi")
        rows = ready.repartition("mask", "key").sortWithinPartitions("mask", "key")
        found.append(stored(rows.mapInArrow(_bucket_links(differ), "a long, b long"), "close"))
        hot = size.where(F.col("n") > bucket)
        masks = [r["mask"] & ALL for r in hot.select("mask").distinct().collect()]        # masks, not fingerprints: few by construction
        if masks:
            members = stored(one.join(hot, ["mask", "key"], "left_semi").select("fp", "mask"), "hot-buckets")
        discard(one, size, *([old] if old is not None else []))
        old = members if masks else None
    out = found[0]
    for x in found[1:]:
        out = out.unionByName(x)
    return out


def simhash_components(spark: SparkSession, docs: DataFrame, n: int = 5, differ: int = 3, seed: int = 42, bucket: int = 512,
                       id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row of ``docs``: ``id_col, fp`` (fingerprint, long) and ``component_id``, the smallest id that links reach."""
    kind = docs.schema[id_col].dataType.simpleString()
    d = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    fps = stored(d.mapInArrow(_fingerprints(n, seed, "text"), f"id {kind}, fp long"), "fingerprints")
    classes = stored(fps.groupBy("fp").agg(F.min("id").alias("cid")), "classes")
    comp = components(close_edges(spark, classes, differ, bucket))
    named = classes.join(comp, classes["fp"] == comp["v"], "left").select("fp", "cid", F.coalesce("c", "fp").alias("c"))
    ids = stored(named.groupBy("c").agg(F.min("cid").alias("component_id")), "component-ids")
    # written, so that the join with the documents shuffles both sides and may split a hot fingerprint
    of = stored(named.join(ids, "c").select("fp", "component_id"), "component-of")
    return fps.join(of, "fp").select(F.col("id").alias(id_col), "fp", "component_id")


def op12_simhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    return simhash_components(spark, docs, n=3).select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")

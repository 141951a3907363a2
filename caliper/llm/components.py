"""Connected components of an edge table: a spanning forest in every task, then star steps or one bounded task.

Each task first reduces its edges to stars (every vertex to the smallest one it
is connected with inside the task), so that no more edges than vertices of a
task travel.  What is left is finished by one task if it is at most
``local_edges`` edges, a size that is counted first; above that, alternating
large-star and small-star steps run: a minimum per vertex (partially
aggregated, so a hub costs a row a task) that is written before it is joined
back to the edges, so the join shuffles both sides and a hub can be split.
Both ways give the smallest vertex of every component.  Every round is written
to the shared folder: the plan stays flat and a lost executor costs one round.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from caliper.llm.passages import discard, stored

LOCAL_EDGES = 500_000     # edges that one task finishes (16 bytes each)


def least_labels(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The vertices of edges ``a - b`` and the smallest vertex that each is connected with."""
    v, place = np.unique(np.concatenate([a, b]), return_inverse=True)
    x, y = place[:len(a)], place[len(a):]
    label = np.arange(len(v))
    while len(x):
        lx, ly = label[x], label[y]
        least = np.minimum(lx, ly)
        np.minimum.at(label, lx, least)
        np.minimum.at(label, ly, least)
        while True:                                       # every vertex points to the root of its tree
            up = label[label]
            if np.array_equal(up, label):
                break
            label = up
        apart = label[x] != label[y]
        x, y = x[apart], y[apart]
    return v, v[label]


def stars(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Edges ``vertex - smallest vertex`` of the components of ``a - b``."""
    v, c = least_labels(a, b)
    return v[v != c], c[v != c]


def _forest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    a = b = np.empty(0, np.int64)
    for batch in batches:
        a, b = stars(np.concatenate([a, batch.column("a").to_numpy()]), np.concatenate([b, batch.column("b").to_numpy()]))
    for i in range(0, len(a), 100_000):
        yield pa.RecordBatch.from_arrays([pa.array(a[i:i + 100_000]), pa.array(b[i:i + 100_000])], ["a", "b"])


def _signature(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())


def _star_round(e: DataFrame) -> DataFrame:
    both = e.unionByName(e.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = stored(both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m")), "least")
    large = stored(both.where("b > a").join(least, "a").where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct(), "edges")
    low = stored(large.groupBy("a").agg(F.min("b").alias("m")), "least")
    out = stored(large.join(low, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).where("a <> b")
                 .unionByName(low.select("a", F.col("m").alias("b"))).distinct(), "edges")
    discard(least, large, low)
    return out


def components(edges: DataFrame, local_edges: int = LOCAL_EDGES) -> DataFrame:
    """``(v, c)`` for every vertex of ``edges (a, b)`` but the smallest of each component, which is ``c`` (written)."""
    pairs = edges.where("a <> b").select(F.col("a").cast("long").alias("a"), F.col("b").cast("long").alias("b"))
    e = stored(pairs.mapInArrow(_forest, "a long, b long"), "edges")
    n = e.count()
    if n > local_edges:
        before = _signature(e)
        while True:
            last, e = e, _star_round(e)
            discard(last)
            after = _signature(e)
            if after == before:
                break
            before = after
    elif n:
        last, e = e, stored(e.coalesce(1).mapInArrow(_forest, "a long, b long"), "edges")
        discard(last)
    return e.select(F.col("a").alias("v"), F.col("b").alias("c"))

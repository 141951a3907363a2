"""Exact k-nearest neighbours (J4) and SMOTE oversampling.

kNN works on metric partitions.  A bounded number of pivots (the reference
rows of smallest hash) cut the reference rows into the cells of their nearest
pivots, and large cells into pieces of about ``block_rows`` rows.  A query row
first searches the cell of its own nearest pivot, which bounds the distance of
its k-th neighbour.  Then it goes only to the cells that may hold a nearer
row: by the triangle inequality a cell of radii ``lo..hi`` around pivot p holds
nothing nearer than ``d(q, p) - hi`` and ``lo - d(q, p)``, nor than the distance
of q to the plane halfway between p and its own pivot.  In a piece, distances
come from coordinate differences (no expanded squares, so nothing cancels) and
each query row's k best are emitted, all candidates counted.  A final top-k
over the winners per piece is exact.  Only the pivots and the cells' radii (at
most ``max_pivots`` rows) pass through the driver.

SMOTE replicates each minority row a bounded number of times (the
oversampling ratio), picks the neighbour and the gap from hashes of
``(key, copy, seed)`` and interpolates with ``zip_with``: no row order, no
driver loop over rows.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from caliper.operators.ranking import hash_rank, top_k
from caliper.session import stored


def _nearest_in_block(key: str, k: int, exclude_self: bool, rows_at_once: int = 256):
    """The k nearest rows of a reference block for every row of a query block (ties by key)."""
    def nearest(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        out = []
        if len(left) and len(right):
            right = right.sort_values(key, kind="stable")
            names, m = right[key].to_numpy(), np.stack(right["v"].to_numpy()).astype(np.float64)
            for a in range(0, len(left), rows_at_once):
                part = left.iloc[a:a + rows_at_once]
                q, mine = np.stack(part["v"].to_numpy()).astype(np.float64), part[key].to_numpy()
                d2 = np.zeros((len(q), len(m)))
                for j in range(m.shape[1]):
                    d2 += (q[:, j, None] - m[None, :, j]) ** 2
                if exclude_self:
                    d2[mine[:, None] == names[None, :]] = np.inf
                best = np.argsort(d2, axis=1, kind="stable")[:, :k]       # names are sorted: a stable sort breaks ties by key
                dist = np.take_along_axis(d2, best, axis=1)
                row, col = np.nonzero(np.isfinite(dist))
                out.append(pd.DataFrame({key: mine[row], "nn_key": names[best[row, col]], "dist": np.sqrt(dist[row, col])}))
        return pd.concat(out) if out else pd.DataFrame({key: [], "nn_key": [], "dist": []})
    return nearest


class Cells:
    """Pivots, and of each pivot's cell the rows, the radii and the pieces."""

    def __init__(self, pivots: np.ndarray):
        self.pivots = pivots
        self.apart = self.distances(pivots)                # between pivots
        self.lo, self.hi, self.pieces = np.full(len(pivots), np.inf), np.full(len(pivots), -np.inf), np.zeros(len(pivots), int)

    def distances(self, v: np.ndarray) -> np.ndarray:
        d2 = np.zeros((len(v), len(self.pivots)))
        for j in range(self.pivots.shape[1]):
            d2 += (v[:, j, None] - self.pivots[None, :, j]) ** 2
        return np.sqrt(d2)

    def near(self, v: np.ndarray, home: np.ndarray, reach: np.ndarray) -> np.ndarray:
        """Cells, but the own one, that may hold a row within ``reach`` of each row of ``v``."""
        d = self.distances(v)
        own = d[np.arange(len(v)), home]
        apart = self.apart[home]
        with np.errstate(divide="ignore", invalid="ignore"):
            plane = np.where(apart > 0, (d ** 2 - own[:, None] ** 2) / (2 * apart), 0.0)
        least = np.maximum(np.maximum(d - self.hi, self.lo - d), plane)
        slack = 1e-9 * (1 + d + own[:, None])             # more than rounding can add to a bound
        ok = (self.pieces > 0) & (least - slack <= reach[:, None])
        ok[np.arange(len(v)), home] = False
        return ok


def _vectors(column) -> np.ndarray:
    return np.stack(column.to_numpy()).astype(np.float64) if len(column) else np.zeros((0, 1))


ROWS = 256             # rows whose distances to all pivots are held at once
OUT_ROWS = 8_192       # shipped rows that leave in one frame
QUERY_ROWS = 16_384    # query rows that one task searches a piece for, on average over the slices


def _parts(frames):
    """The rows of ``frames``, at most ``ROWS`` at once: a row may leave once for every cell."""
    for df in frames:
        for a in range(0, len(df), ROWS):
            yield df.iloc[a:a + ROWS]


def _assign(cells, key: str):
    """``key, v, cell, radius``: rows with their nearest pivot (the first of equals)."""
    def run(frames):
        for df in _parts(frames):
            if len(df):
                d = cells.value.distances(_vectors(df["v"]))
                cell = d.argmin(1)
                yield pd.DataFrame({key: df[key], "v": df["v"], "cell": cell.astype(np.int32), "radius": d[np.arange(len(df)), cell]})
    return run


def _ship(cells, key: str):
    """``key, v, cell``: a query row for every further cell that may hold a nearer neighbour."""
    def run(frames):
        for df in _parts(frames):
            if len(df):
                rows, far = np.nonzero(cells.value.near(_vectors(df["v"]), df["cell"].to_numpy(), df["reach"].to_numpy()))
                for a in range(0, len(rows), OUT_ROWS):
                    row, cell = rows[a:a + OUT_ROWS], far[a:a + OUT_ROWS]
                    yield pd.DataFrame({key: df[key].to_numpy()[row], "v": df["v"].to_numpy()[row], "cell": cell.astype(np.int32)})
    return run


def cells_of(ref: DataFrame, key: str, block_rows: int, max_pivots: int) -> tuple[Cells, DataFrame]:
    """The cells and the rows ``key, v, cell, radius, piece`` of ``ref (key, v)`` (written)."""
    spark, kind = ref.sparkSession, ref.schema[key].dataType.simpleString()
    n = min(max_pivots, max(1, math.ceil(ref.count() / block_rows)))
    picked = ref.orderBy(F.xxhash64(key, F.lit("pivot")), key).limit(n).select("v").collect()     # at most ``max_pivots`` rows
    cells = Cells(np.array([r.v for r in picked], np.float64) if picked else np.zeros((0, 0)))
    if not picked:
        return cells, stored(ref.withColumns({"cell": F.lit(0), "radius": F.lit(0.0), "piece": F.lit(0)}), "knn-cells")
    rows = stored(ref.mapInPandas(_assign(spark.sparkContext.broadcast(cells), key), f"{key} {kind}, v array<double>, cell int, radius double"), "knn-cells")
    for r in rows.groupBy("cell").agg(F.count(F.lit(1)).alias("n"), F.min("radius").alias("lo"), F.max("radius").alias("hi")).collect():
        cells.lo[r.cell], cells.hi[r.cell], cells.pieces[r.cell] = r.lo, r.hi, math.ceil(r.n / block_rows)
    return cells, rows.withColumn("piece", F.pmod(F.xxhash64(key, F.lit("piece")), _pieces(cells)).cast("int"))


def _pieces(cells: Cells):
    """Column: the pieces of ``cell``."""
    return F.get(F.array(*[F.lit(max(1, int(n))) for n in cells.pieces]), F.col("cell"))


def shipments(query: DataFrame, cells: Cells, key: str, kind: str) -> DataFrame:
    """``key, v, cell, piece``: the rows of ``query (key, v, cell, reach)`` for each further piece that they must search."""
    block = query.sparkSession.sparkContext.broadcast(cells)
    far = query.mapInPandas(_ship(block, key), f"{key} {kind}, v array<double>, cell int")
    return far.withColumn("piece", F.explode(F.sequence(F.lit(0), _pieces(cells) - 1)))


def knn(query: DataFrame, ref: DataFrame, key: str, vec_col: str, k: int = 5, exclude_self: bool = True,
        block_rows: int = 4096, max_pivots: int = 1024) -> DataFrame:
    """``(key, rank, nn_key, dist)``: the k nearest ``ref`` rows of every ``query`` row (Euclidean, ties by key)."""
    kind = query.schema[key].dataType.simpleString()
    out = f"{key} {kind}, nn_key {kind}, dist double"
    v = F.col(vec_col).cast("array<double>").alias("v")
    cells, rows = cells_of(ref.select(key, v), key, block_rows, max_pivots)
    if not len(cells.pivots):
        return query.sparkSession.createDataFrame([], f"{key} {kind}, rank int, nn_key {kind}, dist double")
    block = query.sparkSession.sparkContext.broadcast(cells)
    asked = stored(query.select(key, v).mapInPandas(_assign(block, key), f"{key} {kind}, v array<double>, cell int, radius double"), "knn-queries")

    # a piece may be searched by all query rows: they come in slices, each beside a copy of the piece
    slices = math.ceil(asked.count() / QUERY_ROWS)
    at = ["cell", "piece", "slice"]

    def search(q: DataFrame) -> DataFrame:
        r = rows.withColumn("slice", F.explode(F.sequence(F.lit(0), F.lit(max(0, slices - 1))))).select(key, "v", *at).groupBy(*at)
        q = q.withColumn("slice", F.pmod(F.xxhash64(key, F.lit("slice")), F.lit(max(1, slices))).cast("int"))
        return q.select(key, "v", *at).groupBy(*at).cogroup(r).applyInPandas(_nearest_in_block(key, k, exclude_self), out)

    order = [F.col("dist").asc(), F.col("nn_key").asc()]
    home = stored(top_k(search(asked.withColumn("piece", F.explode(F.sequence(F.lit(0), _pieces(cells) - 1)))), key, order, k), "knn-home")
    # with k rows at home, the k-th distance is as far as a nearer neighbour can be
    reach = home.groupBy(key).agg(F.when(F.count(F.lit(1)) >= k, F.max("dist")).alias("reach"))
    far = asked.join(reach, key, "left").select(key, "v", "cell", F.coalesce("reach", F.lit(math.inf)).alias("reach"))
    best = home.unionByName(search(shipments(far, cells, key, kind)))
    return top_k(best, key, order, k, rank_col="rank").select(key, "rank", "nn_key", "dist")


def smote(df: DataFrame, key: str, vec_col: str, label_col: str, minority=1, k: int = 5, seed: int = 42,
          ratio: float = 1.0, block_rows: int = 4096) -> DataFrame:
    """Add synthetic minority rows until ``n_min = ratio * n_maj``; returns original + synthetic rows.

    Synthetic rows get ``key = '<seed key>#s<copy>'`` (string) and ``synthetic = true``.
    """
    is_min = F.col(label_col) == F.lit(minority)
    mino = df.where(is_min).select(key, vec_col, label_col)
    n_min = mino.count()
    n_maj = df.where(~is_min).count()
    n_new = max(0, int(round(ratio * n_maj)) - n_min)
    base = df.select(F.col(key).cast("string").alias(key), F.col(vec_col).cast("array<double>").alias(vec_col),
                     label_col, F.lit(False).alias("synthetic"))
    if n_new == 0 or n_min < 2:
        return base
    per, extra = divmod(n_new, n_min)
    nn = knn(mino, mino, key, vec_col, k=k, block_rows=block_rows)
    kk = min(k, n_min - 1)
    seeds = hash_rank(mino, key, seed=seed, rank_col="_r")
    copies = F.when(F.col("_r") < extra, per + 1).otherwise(per)
    rep = (seeds.withColumn("copy", F.explode(F.sequence(F.lit(0), copies - 1)))
           .where(copies > 0))
    h = F.xxhash64(F.col(key), F.col("copy"), F.lit(seed))
    rep = (rep.withColumn("rank", (F.pmod(h, F.lit(kk)) + 1).cast("int"))
           .withColumn("u", F.pmod(F.xxhash64(F.col(key), F.col("copy"), F.lit(seed + 1)), F.lit(1_000_000)) / 1e6))
    j = rep.join(nn.select(key, "rank", "nn_key"), on=[key, "rank"], how="inner")
    vecs = mino.select(F.col(key).alias("nn_key"), F.col(vec_col).cast("array<double>").alias("_nv"))
    j = j.join(vecs, on="nn_key", how="inner")
    x = F.col(vec_col).cast("array<double>")
    syn = j.select(F.concat(F.col(key).cast("string"), F.lit("#s"), F.col("copy").cast("string")).alias(key),
                   F.zip_with(x, F.col("_nv"), lambda a, b: a + F.col("u") * (b - a)).alias(vec_col),
                   F.col(label_col), F.lit(True).alias("synthetic"))
    return base.unionByName(syn)

"""Shared distributed primitives: hash order, exact top fraction, prefix sums, top-k, lookup joins.

None of these moves a whole table, partition or group through one task:

* ``hash_order``: a row's position in a seeded random order is ``md5(key|seed)``,
  a pure function of the row (stable on recompute, identical in SQL).
* ``top_fraction``: the smallest ``ceil(f * n_c)`` hashes of each class,
  exactly, without a shuffle of the rows: counters per (class, hash bucket)
  give each class's threshold row, and a map over the input flags by it.
* ``prefix_sums``: running sums in a global order without the single-partition
  window: a written range-partitioned table, range totals (a row a range) as
  offsets, and a running sum inside each range.
* ``top_k``: ``row_number() <= k`` per group; Spark plans a partial
  ``WindowGroupLimit`` before the shuffle, so a hot group is cut map-side.
* ``lookup_join``: broadcast only under a bound known by construction;
  otherwise adaptive execution decides by the measured size and splits hot keys.
"""

from __future__ import annotations

from typing import Callable, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from caliper.session import stored

DEFAULT_HASH_DIGITS = 5          # 16**5 = 1,048,576 hash buckets per class: at 10^12 rows a boundary bucket holds ~10^6
DEFAULT_BROADCAST_ROWS = 1_000_000


def _cols(x) -> list[str]:
    return [x] if isinstance(x, str) else list(x)


def hash_order(keys: Sequence[str] | str, seed: int = 42) -> Column:
    """md5 of the key columns and the seed, joined by '|' (SQL: md5(concat_ws('|', k..., seed)))."""
    return F.md5(F.concat_ws("|", *[F.col(k).cast("string") for k in _cols(keys)], F.lit(str(seed))))


def hash_bucket(h: Column, digits: int = DEFAULT_HASH_DIGITS) -> Column:
    return F.conv(F.substring(h, 1, digits), 16, 10).cast("int")


def _beside(x: DataFrame, small: DataFrame, cols: list) -> DataFrame:
    """Inner join on ``cols``; null is a value like any other."""
    s = small.withColumnsRenamed({c: f"_on{i}" for i, c in enumerate(cols)})
    return x.join(s, [x[c].eqNullSafe(s[f"_on{i}"]) for i, c in enumerate(cols)]).drop(*[f"_on{i}" for i in range(len(cols))])


SUPER_BITS = 10  # buckets are grouped 1024 at a time for the two-level running count


def _bucket_running_count(counts: DataFrame, cls: list, max_broadcast_rows: int) -> DataFrame:
    """Add ``_cum`` (running count over buckets, inclusive) and ``_n`` (class total).

    Two levels instead of one single-partition window: totals per super-bucket
    (``_b >> 10``; at most ``16^digits / 1024`` rows per class) get their offsets
    from a small window, and the running count inside a super-bucket is a
    window partitioned by (class, super-bucket).
    """
    c = counts.withColumn("_hi", F.shiftright(F.col("_b"), SUPER_BITS))
    sup = c.groupBy(*cls, "_hi").agg(F.sum("_cnt").alias("_scnt"))
    sw = Window.partitionBy(*cls).orderBy("_hi") if cls else Window.orderBy("_hi")
    sup = sup.select(*cls, "_hi",
                     F.coalesce(F.sum("_scnt").over(sw.rowsBetween(Window.unboundedPreceding, -1)),
                                F.lit(0)).alias("_soff"),
                     F.sum("_scnt").over(Window.partitionBy(*cls) if cls else Window.partitionBy()).alias("_n"))
    iw = Window.partitionBy(*cls, "_hi").orderBy("_b").rowsBetween(Window.unboundedPreceding, 0)
    return (_beside(c, sup, cls + ["_hi"])
            .withColumn("_cum", F.col("_soff") + F.sum("_cnt").over(iw)).drop("_hi", "_soff"))


def selection_threshold(df: DataFrame, keys, target: Callable[[Column], Column], class_col: str | None = None, seed: int = 42,
                        digits: int = DEFAULT_HASH_DIGITS, want: str | None = None) -> DataFrame:
    """``(class_col, _k, _thr)``: of every class, the ``_k``-th smallest ``(hash, keys)``, ``_k = target(rows of the class)``.

    Found by counters: rows per (class, leading hash digits) with the smallest
    and largest member.  The running count names the bucket of the wanted row,
    which mostly is the bucket's first or last; where it is not, the bucket's
    rows are counted by the next digits.  So a class costs one scan, or two if its
    buckets hold many rows, and no rows travel.  ``want`` names a column with the
    class's own target, which ``target`` may use as ``_want``.
    """
    keys, cls = _cols(keys), [class_col] if class_col else []
    x = df.select(*dict.fromkeys([*cls, *keys]), *([want] if want else []), hash_order(keys, seed).alias("_h"))
    x = x.select(*cls, F.struct("_h", *[F.col(k).alias(f"_key{i}") for i, k in enumerate(keys)]).alias("_row"), "_h", *([F.col(want).alias("_want")] if want else []))
    aggs = [F.count(F.lit(1)).alias("_cnt"), F.min("_row").alias("_lo"), F.max("_row").alias("_hi_row")]
    found, rows, at, open_ = [], x, 0, None
    while True:
        bucket = F.conv(F.substring("_h", at + 1, digits), 16, 10).cast("int")
        carry = ["_need"] if open_ is not None else []
        counts = rows.withColumn("_b", bucket).groupBy(*cls, "_b").agg(*aggs, *([F.first("_want").alias("_want")] if want else []), *[F.first(c).alias(c) for c in carry])
        counts = _bucket_running_count(counts, cls, DEFAULT_BROADCAST_ROWS)
        k = F.col("_need") if carry else target(F.col("_n"))
        edge = counts.withColumn("_k", k.cast("long")).where("_k > 0 and _cum >= _k").groupBy(*cls).agg(
            F.min(F.struct("_b", "_cum", "_cnt", "_k", "_lo", "_hi_row")).alias("e")).where("e is not null")
        need = F.col("e._k") - (F.col("e._cum") - F.col("e._cnt"))
        edge = edge.select(*cls, need.alias("_need"), "e._cnt", "e._lo", "e._hi_row")
        one = (F.col("_need") == 1) | (F.col("_lo._h") == F.col("_hi_row._h"))            # equal hashes: rows of equal keys go together
        edge = edge.withColumn("_thr", F.when(F.col("_need") == F.col("_cnt"), F.col("_hi_row")).when(one, F.col("_lo")))
        edge = stored(edge, "threshold")
        found.append(edge.where("_thr is not null").select(*cls, "_thr"))
        open_ = edge.where("_thr is null").select(*[F.col(c).alias("_cls") for c in cls], "_need", F.substring("_lo._h", 1, at + digits).alias("_head"))
        if open_.isEmpty():
            break
        at += digits
        # a row a class at most; without classes a single row
        same = (x[class_col].eqNullSafe(open_["_cls"]) if cls else F.lit(True)) & (F.substring(x["_h"], 1, at) == open_["_head"])
        rows = x.join(open_, same).drop("_cls", "_head")
    out = found[0]
    for f in found[1:]:
        out = out.unionByName(f)
    return out


def top_fraction(df: DataFrame, keys, fraction: float | None = None, n: int | None = None,
                 class_col: str | None = None, seed: int = 42, flag_col: str = "selected",
                 digits: int = DEFAULT_HASH_DIGITS, n_col: str | None = None) -> DataFrame:
    """Flag the rows with the smallest ``ceil(fraction * n_c)`` (or ``n``) hashes of each class.

    Equals ``row_number() over (partition by class order by md5(key|seed), key) <= k``
    for keys that are unique (rows of equal keys are flagged together).  All
    rows are returned with a boolean ``flag_col``, by a map over the input: the
    class's threshold comes from :func:`selection_threshold`.  ``n_col`` names a
    per-row column carrying each class's own target count instead.
    """
    keys = _cols(keys)
    # ceil in exact decimal arithmetic (0.2 * 5 must be 1, not 1.0000000000000002)
    share = lambda m: F.ceil(F.lit(str(fraction)).cast("decimal(20,10)") * m.cast("decimal(20,0)"))
    target = ((lambda m: F.least(F.col("_want").cast("long"), m)) if n_col else (lambda m: F.least(F.lit(int(n)), m)) if n is not None else share)
    thr = selection_threshold(df, keys, target, class_col, seed, digits, n_col)
    row = F.struct(hash_order(keys, seed), *keys)
    if not class_col:
        return df.withColumn(flag_col, F.coalesce(row <= thr.select("_thr").scalar(), F.lit(False)))
    thr = thr.select(F.col(class_col).alias("_cls"), "_thr")
    y = df.join(thr, df[class_col].eqNullSafe(thr["_cls"]), "left")                       # a row a class: broadcast by its file size
    return y.withColumn(flag_col, F.coalesce(row <= F.col("_thr"), F.lit(False))).drop("_cls", "_thr")


def hash_rank(df: DataFrame, keys, class_col: str | None = None, seed: int = 42,
              rank_col: str = "rank", digits: int = DEFAULT_HASH_DIGITS,
              max_broadcast_rows: int = DEFAULT_BROADCAST_ROWS) -> DataFrame:
    """0-based position of every row in its class's hash order, computed per hash bucket.

    Equals ``row_number() over (partition by class order by md5(key|seed), key) - 1``;
    the window runs per (class, bucket), so no task holds a whole class.
    """
    keys = _cols(keys)
    cls = [class_col] if class_col else []
    x = df.withColumn("_h", hash_order(keys, seed)).withColumn("_b", hash_bucket(F.col("_h"), digits))
    counts = x.groupBy(*cls, "_b").agg(F.count(F.lit(1)).alias("_cnt"))
    offs = _bucket_running_count(counts, cls, max_broadcast_rows).select(
        *cls, "_b", (F.col("_cum") - F.col("_cnt")).alias("_off"))
    rw = Window.partitionBy(*cls, "_b").orderBy("_h", *keys)
    # up to 16^digits rows a class: joined by shuffle, never through the driver
    return (_beside(x, offs.hint("merge"), cls + ["_b"])
            .withColumn(rank_col, (F.col("_off") + F.row_number().over(rw) - 1).cast("long"))
            .drop("_h", "_b", "_off"))


def prefix_sums(df: DataFrame, order_col: str, value_cols: Sequence[str], n_buckets: int | None = None,
                prefix: str = "cum_") -> DataFrame:
    """Inclusive running sums of ``value_cols`` in ascending ``order_col`` order, in two phases.

    ``order_col`` must be unique per row (group by it first: curves collapse tied
    scores into one row).  The rows are dealt into ranges (``n_buckets``, else as
    many as shuffle partitions) and written with the number of their range.
    Then every range's totals, a row a range, are summed up to offsets and each
    range takes its own running sum.  The limits of the ranges stay with Spark.
    """
    x = df.withColumn(order_col, F.col(order_col).cast("double"))
    x = x.repartitionByRange(n_buckets, order_col) if n_buckets else x.repartitionByRange(order_col)
    x = stored(x.withColumn("_bk", F.spark_partition_id()), "ranges")
    tot = x.groupBy("_bk").agg(*[F.sum(v).alias(f"_t_{v}") for v in value_cols])
    ow = Window.orderBy("_bk").rowsBetween(Window.unboundedPreceding, -1)  # a row a range
    offs = tot.select("_bk", *[F.coalesce(F.sum(f"_t_{v}").over(ow), F.lit(0)).alias(f"_o_{v}")
                               for v in value_cols])
    iw = Window.partitionBy("_bk").orderBy(order_col).rowsBetween(Window.unboundedPreceding, 0)
    y = x.join(offs, on="_bk", how="inner")
    for v in value_cols:
        y = y.withColumn(f"{prefix}{v}", F.col(f"_o_{v}") + F.sum(v).over(iw))
    return y.drop("_bk", *[f"_o_{v}" for v in value_cols])


def top_k(df: DataFrame, group_cols, order_cols: Sequence[Column], k: int, rank_col: str | None = None) -> DataFrame:
    """Per-group top-k by ``row_number``; order columns must end in a unique tie key."""
    w = Window.partitionBy(*_cols(group_cols)).orderBy(*order_cols)
    rn = rank_col or "_rn"
    out = df.withColumn(rn, F.row_number().over(w)).where(F.col(rn) <= k)
    return out if rank_col else out.drop(rn)


def lookup_join(big: DataFrame, small: DataFrame, on, how: str = "inner",
                max_broadcast_rows: int = DEFAULT_BROADCAST_ROWS, bound: int | None = None) -> DataFrame:
    """Join a lookup table.

    ``bound`` states a size known by construction (a vocabulary capped by
    ``max_features``): under the limit it is broadcast.  Otherwise the join is
    left to adaptive execution, which broadcasts the lookup side if its measured
    size allows it and splits a key that holds a third of the rows if not; no
    job runs and nothing is cached while the plan is built.
    """
    on = _cols(on)
    if bound is not None and bound <= max_broadcast_rows:
        return big.join(F.broadcast(small), on=on, how=how)
    return big.join(small, on=on, how=how)

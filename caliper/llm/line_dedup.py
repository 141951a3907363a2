"""Line dedup: levelled sorted runs of line keys, compacted periodically.

A *run* is a Parquet table of ``(h1, h2, n)`` sorted by key: the 96-bit hash of
a line key and the number of documents of one batch (or of several compacted
batches) that hold it.  A new batch of documents is aggregated into its own
level-0 run.  When a level holds ``fanout`` runs they are merged (sum of ``n``
per key) into one run of the next level, so a key lives in at most
``fanout * levels`` places and a batch never rewrites the whole store.
Documents are cleaned by an anti-join of their lines with the keys whose
merged count reaches ``min_docs``.

Everything is DataFrame code: the runs are written tables in the shared
checkpoint folder, so a lost executor recomputes one batch at most, and the
only wide rows that move are the documents themselves, once, to meet their
(small) lists of dropped keys.  Counting is partial-aggregated before its
shuffle, so a line held by a third of all documents costs one row a task.

Defined results: a null or empty text is one empty line; an empty key is never
dropped; a row is a document, so repeated rows count as often as they occur;
rows with equal or null ids are kept apart by their text.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from caliper.session import scratch_path

WHITE = " \t\n\x0b\x0c\r"          # fixed values: the white space stripped from a line
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def ascii_lower(c: Column) -> Column:
    """Lower-case A-Z only; all-ASCII strings take the fast built-in."""
    return F.when(F.length(c) == F.octet_length(c), F.lower(c)).otherwise(F.translate(c, UPPER, LOWER))


def lines_of(text: Column) -> Column:
    return F.split(F.coalesce(text, F.lit("")), "\n", -1)


def line_key(line: Column) -> Column:
    return ascii_lower(F.btrim(line, F.lit(WHITE)))


def key_hash(key: Column) -> Column:
    """96 bits: a 64-bit and an unrelated 32-bit hash of the key."""
    return F.struct(F.xxhash64(key).alias("h1"), F.hash(key).alias("h2"))


def _keys(text: Column) -> Column:
    """The distinct hashed non-empty keys of a text."""
    keys = F.transform(lines_of(text), line_key)
    return F.array_distinct(F.transform(F.filter(keys, lambda k: F.length(k) >= 1), key_hash))


class LineRuns:
    """A store of levelled runs under ``path``; ``add`` takes batches, ``counts`` merges all runs."""

    def __init__(self, spark: SparkSession, path: str | None = None, fanout: int = 4):
        self.spark, self.fanout = spark, fanout
        self.path = path or scratch_path(spark, "line-runs")
        self.levels: list[list[str]] = [[]]
        self._next = 0

    def _write(self, df: DataFrame) -> str:
        out = f"{self.path}/run-{self._next:06d}"
        self._next += 1
        df.sortWithinPartitions("h1", "h2").write.mode("overwrite").parquet(out)
        return out

    def _merged(self, runs: list[str]) -> DataFrame:
        parts = [self.spark.read.parquet(p) for p in runs]
        return reduce(DataFrame.unionByName, parts).groupBy("h1", "h2").agg(F.sum("n").alias("n"))

    def add(self, docs: DataFrame, text_col: str = "text") -> None:
        """Aggregate a batch into a level-0 run, then compact full levels upwards."""
        keys = docs.select(F.explode(_keys(F.col(text_col))).alias("k"))
        self.levels[0].append(self._write(keys.groupBy("k.h1", "k.h2").agg(F.count(F.lit(1)).alias("n"))))
        level = 0
        while len(self.levels[level]) >= self.fanout:
            run = self._write(self._merged(self.levels[level]))
            self.levels[level] = []
            level += 1
            if level == len(self.levels):
                self.levels.append([])
            self.levels[level].append(run)

    def counts(self) -> DataFrame:
        return self._merged([p for level in self.levels for p in level])


def drop_lines(docs: DataFrame, frequent: DataFrame, id_col: str = "doc_id", text_col: str = "text",
               cols: list[str] | None = None, counts: bool = True) -> DataFrame:
    """Drop every line whose key is in ``frequent (h1, h2)``.

    Returns ``cols`` of ``docs`` with the text replaced (a null text stays null)
    and, if ``counts``, ``n_lines`` and ``n_dropped``.  Only hashed keys meet
    the frequent list (the join key is a key hash: a common line's rows are
    split by the skew join); each document then meets its own bounded list of
    dropped keys.  Rows travel as one struct, so no column name can clash.
    """
    cols = cols or docs.columns
    if text_col not in cols:
        raise ValueError(f"{text_col} is not among the columns kept")
    d = docs.select(F.struct(*[F.col(f"`{c}`") for c in cols]).alias("row"), F.col(id_col).alias("i"), F.col(text_col).alias("t"),
                    F.xxhash64(F.col(text_col)).alias("rk"))
    pairs = d.select("i", "rk", F.explode(_keys(F.col("t"))).alias("k")).select("i", "rk", "k.h1", "k.h2")
    gone = (pairs.join(frequent.select("h1", "h2"), ["h1", "h2"], "left_semi")
            .groupBy("i", "rk").agg(F.collect_set(F.struct("h1", "h2")).alias("gone"))
            .select(F.col("i").alias("i2"), F.col("rk").alias("rk2"), "gone"))
    j = d.join(gone, F.col("i").eqNullSafe(F.col("i2")) & (F.col("rk") == F.col("rk2")), "left")
    lines = lines_of(F.col("t"))
    kept = F.when(F.col("gone").isNull(), lines).otherwise(
        F.filter(lines, lambda x: ~F.array_contains(F.col("gone"), key_hash(line_key(x))) | (F.length(line_key(x)) < 1)))
    text = F.when(F.col("t").isNotNull(), F.array_join(kept, "\n"))
    out = j.select(F.col("row").withField(f"`{text_col}`", text).alias("row"), F.size(lines).cast("long").alias("n_lines"),
                   (F.size(lines) - F.size(kept)).cast("long").alias("n_dropped"))
    return out.select("row.*", "n_lines", "n_dropped") if counts else out.select("row.*")


def dedup_lines(spark: SparkSession, docs: DataFrame, min_docs: int = 10, batches: int = 4, fanout: int = 4,
                id_col: str = "doc_id", text_col: str = "text", cols: list[str] | None = None, counts: bool = True) -> DataFrame:
    """Feed all documents to a run store in ``batches`` and drop the lines held by ``min_docs`` documents or more."""
    runs = LineRuns(spark, fanout=fanout)
    for b in range(batches):
        runs.add(docs.where(F.pmod(F.xxhash64(id_col), F.lit(batches)) == b), text_col)
    # a table of its own, so that the anti-join shuffles both sides and may split a common line's rows
    path = f"{runs.path}/frequent"
    runs.counts().where(F.col("n") >= min_docs).select("h1", "h2").write.parquet(path)
    frequent = spark.read.parquet(path)
    return drop_lines(docs, frequent, id_col, text_col, cols, counts)


def op9_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    out = dedup_lines(spark, docs)
    return out.select("doc_id", "n_lines", "n_dropped",
                      F.sha2(F.coalesce("text", F.lit("")), 256).alias("kept_sha256"))


OP9_SQL = r"""
WITH l AS (
  SELECT doc_id, generate_subscripts(ls, 1) AS pos, unnest(ls) AS line
  FROM (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS ls FROM documents)),
k AS (
  SELECT *, translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
                      'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key FROM l),
f AS (SELECT key FROM k WHERE length(key) >= 1 GROUP BY key HAVING count(DISTINCT doc_id) >= 10)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (f.key IS NOT NULL) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (f.key IS NULL), '')) AS kept_sha256
FROM k LEFT JOIN f ON k.key = f.key GROUP BY doc_id
"""

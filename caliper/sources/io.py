"""Sources and sinks.

Scans take an explicit schema wherever one is known; inference is left for
ad-hoc CSV only.  NaN in numeric columns is turned into NULL at the source,
since the reference treats NaN as missing while Spark treats it as a value.
"""

from __future__ import annotations

from typing import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

TABLES = ("region nation customer supplier part orders lineitem events documents "
          "embeddings pages benchmark labels conversations").split()


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """Parquet scan of one driver table, NaN as NULL; column pruning and filter pushdown are Catalyst's."""
    return nan_to_null(spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet"))


def spread(df: DataFrame, min_tasks: int | None = None) -> DataFrame:
    """``df`` in at least ``min_tasks`` tasks (the session's cores unless given), for scans that feed heavy work per row.

    A scan has as many tasks as its files have row groups or splits.  Only one
    with fewer than ``min_tasks`` is dealt out anew; Catalyst prunes its columns
    before, so just those that are used move.  A large table has splits enough
    and is left as it is.
    """
    least = min_tasks or df.sparkSession.sparkContext.defaultParallelism
    return df if df.rdd.getNumPartitions() >= least else df.repartition(least)


def nan_to_null(df: DataFrame, cols: Iterable[str] | None = None) -> DataFrame:
    """Replace NaN by NULL in floating columns (pandas' notion of missing)."""
    fl = {f.name for f in df.schema.fields if isinstance(f.dataType, (T.DoubleType, T.FloatType))}
    cols = [c for c in (cols or fl) if c in fl]
    if not cols:
        return df
    return df.select(*[F.nanvl(F.col(c), F.lit(None).cast(df.schema[c].dataType)).alias(c)
                       if c in cols else F.col(c) for c in df.columns])


# S1 -------------------------------------------------------------------------
def read_csv(spark: SparkSession, path: str, schema: T.StructType | str | None = None,
             header: bool = True, multiline: bool = False) -> DataFrame:
    """CSV scan with header.  Quoted newlines (reviews) need ``multiline=True``."""
    r = spark.read.option("header", header).option("escape", '"')
    if multiline:
        r = r.option("multiLine", True)
    if schema is not None:
        r = r.schema(schema)
    else:
        r = r.option("inferSchema", True)
    return r.csv(path)


# S2 -------------------------------------------------------------------------
def read_labelled_tsv(spark: SparkSession, path: str, label_col: str = "label",
                      text_col: str = "text") -> DataFrame:
    """Header-less TSV of ``label<TAB>text`` (messages corpus)."""
    schema = T.StructType([T.StructField(label_col, T.StringType()),
                           T.StructField(text_col, T.StringType())])
    return (spark.read.schema(schema).option("sep", "\t").option("header", False)
            .option("quote", "\u0000").csv(path))


# S3 -------------------------------------------------------------------------
def read_json_records(spark: SparkSession, path: str, schema: T.StructType, multiline: bool = False) -> DataFrame:
    """JSON records to score; a directory of records scores as one batch.

    JSON lines by default; ``multiline=True`` for pretty-printed files holding
    one record (or one array of records) each.
    """
    return spark.read.schema(schema).option("multiLine", multiline).json(path)


# S4 -------------------------------------------------------------------------
def corpus(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Labelled corpus scan ``(doc_id, raw_text, category)``; ``source`` plays the category."""
    return (read_table(spark, sf_dir, "documents")
            .select("doc_id", F.col("text").alias("raw_text"), F.col("source").alias("category")))


# S5 -------------------------------------------------------------------------
def require_columns(df: DataFrame, cols: Iterable[str], what: str = "input") -> DataFrame:
    """Fail before any action when a required column is missing."""
    missing = [c for c in cols if c not in df.columns]
    if missing:
        raise ValueError(f"{what} is missing required column(s): {', '.join(missing)}")
    return df


# S6 -------------------------------------------------------------------------
def path_exists(spark: SparkSession, path: str) -> bool:
    """Existence test through the Hadoop file-system API (works for any cluster FS)."""
    jvm = spark.sparkContext._jvm
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(conf).exists(p)


def is_file(spark: SparkSession, path: str) -> bool:
    """Whether ``path`` is one file and not a folder of part files."""
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).getFileStatus(p).isFile()


def read_with_fallback(spark: SparkSession, paths: list[str], reader, drop: Iterable[str] = ()) -> DataFrame:
    """First existing path wins; then drop target columns if present (no-op otherwise)."""
    for p in paths:
        if path_exists(spark, p):
            return reader(p).drop(*drop)
    raise FileNotFoundError(f"none of the sources exist: {paths}")


# S7 / S8 ----------------------------------------------------------------------
def write_table(df: DataFrame, path: str, fmt: str = "parquet", mode: str = "overwrite",
                partition_by: Iterable[str] | None = None) -> None:
    """Distributed sink; never through the driver."""
    w = df.write.mode(mode)
    if partition_by:
        w = w.partitionBy(*partition_by)
    if fmt == "csv":
        w = w.option("header", True)
    w.format(fmt).save(path)


def write_metrics_json(df: DataFrame, path: str, one_file: bool = True) -> None:
    """A metrics frame as JSON lines; ``one_file=False`` for frames that grow with the data."""
    (df.coalesce(1) if one_file else df).write.mode("overwrite").json(path)


def write_records_json(df: DataFrame, path: str, key: str) -> None:
    """Records-orient variant: one JSON array of the rows, in key order, for frames of a bounded number of rows."""
    one = df.agg(F.to_json(F.array_sort(F.collect_list(F.struct(key, *[c for c in df.columns if c != key])))).alias("value"))
    one.coalesce(1).write.mode("overwrite").text(path)


# S9 -------------------------------------------------------------------------
def save_model(model, path: str) -> None:
    model.write().overwrite().save(path)


def load_pipeline_model(path: str):
    from pyspark.ml import PipelineModel
    return PipelineModel.load(path)


# S10 ------------------------------------------------------------------------
def persist_split(df: DataFrame, path: str, split_col: str = "split") -> None:
    """Write a split once, partitioned by its label, so evaluation prunes to ``test``."""
    write_table(df, path, partition_by=[split_col])


def read_split(spark: SparkSession, path: str, split: str, split_col: str = "split") -> DataFrame:
    return spark.read.parquet(path).where(F.col(split_col) == split)

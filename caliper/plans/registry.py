"""Registry of named queries over the driver tables, each with its SQL oracle.

A query is ``fn(spark, sf_dir) -> DataFrame``.  Floating columns are rounded
to ``DIGITS`` decimals on the way out so that the DuckDB oracle, which rounds
the same way in its SQL, hashes equal values; everything else is returned as
the operator produced it.
"""

from __future__ import annotations

from dataclasses import dataclass
from typing import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from caliper.sources.io import read_table, spread

DIGITS = 6


@dataclass
class Entry:
    name: str
    fn: Callable[[SparkSession, str], DataFrame]
    sql: str | None
    ops: tuple[str, ...]


REGISTRY: dict[str, Entry] = {}


def round_floats(df: DataFrame, digits: int = DIGITS) -> DataFrame:
    out = []
    for f in df.schema.fields:
        if isinstance(f.dataType, (T.DoubleType, T.FloatType)):
            # floor(x * 10^d + 0.5) / 10^d: plain IEEE operations, so both engines round a
            # given double identically (their round() functions differ at halves); NaN kept
            x = F.col(f.name).cast("double")
            sc = float(10 ** digits)
            r = F.floor(x * F.lit(sc) + F.lit(0.5)).cast("double") / F.lit(sc) + F.lit(0.0)
            out.append(F.when(F.isnan(x), x).otherwise(r).alias(f.name))
        else:
            out.append(F.col(f.name))
    return df.select(*out)


def query(name: str, ops: str, sql: str | None = None):
    """Register ``fn`` under ``name``; ``ops`` lists the SURVEY ids it covers."""
    def deco(fn):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return round_floats(fn(spark, sf_dir))
        run.__name__ = fn.__name__
        run.__doc__ = fn.__doc__
        if name in REGISTRY:
            raise ValueError(f"duplicate query {name}")
        REGISTRY[name] = Entry(name, run, sql.strip() if sql else None, tuple(ops.split()))
        return fn
    return deco


class Tables:
    """Lazy table access for a query: ``t.lineitem`` is a parquet scan."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.sf_dir = spark, sf_dir

    def __getattr__(self, name: str) -> DataFrame:
        if name.startswith("_"):
            raise AttributeError(name)
        return read_table(self.spark, self.sf_dir, name)

    @property
    def texts(self) -> DataFrame:
        """``documents`` for work on their texts: a small file is dealt to all cores."""
        return spread(self.documents)


def sql_list(words) -> str:
    """A SQL list literal of strings (quotes doubled)."""
    return ", ".join("'" + w.replace("'", "''") + "'" for w in words)

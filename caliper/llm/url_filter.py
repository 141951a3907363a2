"""URL filters: a blocked Bloom filter of listed canonical URLs, then an exact hash join.

A list entry is a canonical ``host/path``: it covers its host, all subdomains
and every path that starts with its path; the longest covering entry decides.
A URL therefore has few candidate keys: its host suffixes times the prefixes of
its path whose length occurs in the list.

* Build: each entry's hash picks a block of eight 32-bit lanes and sets one bit
  per lane (a split-block filter), so a probe touches one block.  Lanes are
  OR-ed per block by an aggregation; the filter has ``max_blocks`` blocks at
  most (32 bytes each) whatever the list's length, and travels as one
  array-valued scalar subquery.
* Probe: URLs none of whose keys pass are settled in the scan, without a
  shuffle.
* Exact: keys that pass are hash-joined with the list (AQE broadcasts a small
  list by its measured size, and splits hot keys otherwise); false positives
  find no partner and fall out.

Defined results: a null URL or one without ``://`` has empty host and path and
no rule; repeated pages are judged each; null actions in the list are ignored;
an empty list allows everything.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from caliper.llm.line_dedup import ascii_lower

RULES = [("block", "net", "/"), ("allow", "example.net", "/en/"), ("block", "example.com", "/de/"), ("allow", "org", "/fr/")]
LANES = 8


def url_host(url: Column) -> Column:
    """After the first ``://`` up to ``/ ? #`` or the end, A-Z lower-cased; empty without ``://``."""
    return F.when(url.contains("://"), ascii_lower(F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1))).otherwise(F.lit(""))


def url_path(url: Column) -> Column:
    return F.when(url.contains("://"), F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1)).otherwise(F.lit(""))


def _lane_bits(h2: Column) -> list[Column]:
    """One bit for each lane from eight 5-bit slices of a second hash."""
    return [F.call_function("shiftleft", F.lit(1), F.shiftrightunsigned(h2, 5 * i).bitwiseAND(31).cast("int")) for i in range(LANES)]


def _hashes(key: Column) -> tuple[Column, Column]:
    return F.xxhash64(key), F.xxhash64(key, F.lit(1))


def bloom_filter(keys: DataFrame, n_keys: int, max_blocks: int = 1 << 17) -> tuple[DataFrame, int]:
    """``(one-row frame with array column f, number of blocks)`` for a frame with a ``key`` column.

    16 bits a key up to ``max_blocks``; beyond that only more false positives.
    """
    blocks = min(max_blocks, max(16, 1 << max(1, n_keys // 16).bit_length()))
    h1, h2 = _hashes(F.col("key"))
    lanes = [c.alias(f"l{i}") for i, c in enumerate(_lane_bits(h2))]
    built = (keys.select(F.pmod(h1, F.lit(blocks)).alias("b"), *lanes).groupBy("b")
             .agg(F.struct(*[F.bit_or(f"l{i}").alias(f"l{i}") for i in range(LANES)]).alias("v")))
    # blocks <= max_blocks rows: the gathered array has a proven bound
    m = F.map_from_entries(F.collect_list(F.struct("b", "v")))
    zero = F.struct(*[F.lit(0).alias(f"l{i}") for i in range(LANES)])
    dense = F.transform(F.sequence(F.lit(0), F.lit(blocks - 1)), lambda i: F.coalesce(F.try_element_at(F.col("m"), i.cast("long")), zero))
    return built.agg(m.alias("m")).select(dense.alias("f")), blocks


def probe(filt: Column, blocks: int, key: Column) -> Column:
    """Whether all eight bits of a key are set; the filter column is read once, for the key's block."""
    h1, h2 = _hashes(key)

    def passes(block: Column) -> Column:
        ok = F.lit(True)
        for i, bit in enumerate(_lane_bits(h2)):
            ok = ok & (block[f"l{i}"].bitwiseAND(bit) != 0)
        return ok

    return F.forall(F.array(F.element_at(filt, (F.pmod(h1, F.lit(blocks)) + 1).cast("int"))), passes)


def filter_urls(spark: SparkSession, pages: DataFrame, rules: DataFrame, id_col: str = "page_id", url_col: str = "url",
                default: str = "allow") -> DataFrame:
    """Judge every row of ``pages`` by ``rules (action, host, path)``: id, host, path, rule, verdict."""
    rules = (rules.where("host is not null and path is not null and action is not null")
             .select(F.concat_ws("\x00", ascii_lower(F.col("host")), "path").alias("key"),
                     F.concat("host", "path").alias("rule"), "action", F.length("path").alias("plen"))
             .groupBy("key").agg(F.min(F.struct("rule", "action", "plen")).alias("r"))   # one entry a key
             .select("key", "r.*"))
    n_rules, lens = rules.agg(F.count(F.lit(1)), F.sort_array(F.collect_set("plen"))).first()
    base = pages.select(F.col(id_col), F.col(url_col).alias("_url")).select(
        id_col, url_host(F.col("_url")).alias("host"), url_path(F.col("_url")).alias("path"))
    if not n_rules:
        return base.select(id_col, "host", "path", F.lit(None).cast("string").alias("rule"), F.lit(default).alias("verdict"))
    filt, blocks = bloom_filter(rules.select("key"), n_rules)
    labels = F.split("host", r"\.", -1)
    hosts = F.transform(F.sequence(F.lit(1), F.size(labels)),
                        lambda i: F.array_join(F.slice(labels, i, F.size(labels)), "."))
    # path lengths that occur in the list (bounded by the longest listed path)
    cuts = F.filter(F.array(*[F.lit(int(x)) for x in lens]), lambda n: n <= F.length("path"))
    keys = F.flatten(F.transform(hosts, lambda h: F.transform(cuts, lambda n: F.concat_ws("\x00", h, F.substring(F.col("path"), F.lit(1), n)))))
    base = base.withColumn("_keys", F.when(F.col("host") == "", F.array().cast("array<string>")).otherwise(keys))
    base = base.withColumn("_f", filt.scalar())
    base = base.withColumn("_hits", F.filter("_keys", lambda k: probe(F.col("_f"), blocks, k))).drop("_f", "_keys")
    clear = base.where(F.size("_hits") == 0).select(id_col, "host", "path", F.lit(None).cast("string").alias("rule"),
                                                    F.lit(None).cast("string").alias("action"))
    # every copy of a row gives the same number of hits: rows / hits counts repeated rows
    hit = base.where(F.size("_hits") > 0).select(id_col, "host", "path", F.size("_hits").alias("_m"), F.explode("_hits").alias("key"))
    best = F.max(F.when(F.col("rule").isNotNull(), F.struct(F.length("rule").alias("n"), "rule", "action")))
    found = (hit.join(rules, "key", "left").groupBy(id_col, "host", "path", "_m")
             .agg(best.alias("_r"), F.count(F.lit(1)).alias("_n"))
             .withColumn("_copy", F.explode(F.sequence(F.lit(1), (F.col("_n") / F.col("_m")).cast("int"))))
             .select(id_col, "host", "path", F.col("_r.rule").alias("rule"), F.col("_r.action").alias("action")))
    return clear.unionByName(found).select(id_col, "host", "path", "rule", F.coalesce("action", F.lit(default)).alias("verdict"))


def op3_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet")
    rules = spark.sql("SELECT * FROM VALUES " + ", ".join(f"('{a}', '{h}', '{p}')" for a, h, p in RULES) + " AS r(action, host, path)")
    return filter_urls(spark, pages, rules)


OP3_SQL = r"""
WITH p AS (
  SELECT page_id,
         CASE WHEN contains(url, '://') THEN translate(regexp_extract(url, '(?s)^.*?://([^/?#]*)', 1),
              'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') ELSE '' END AS host,
         CASE WHEN contains(url, '://') THEN regexp_extract(url, '(?s)^.*?://[^/?#]*([^?#]*)', 1) ELSE '' END AS path
  FROM pages),
r AS (SELECT * FROM (VALUES ('block', 'net', '/'), ('allow', 'example.net', '/en/'),
                            ('block', 'example.com', '/de/'), ('allow', 'org', '/fr/')) t(action, rh, rp))
SELECT page_id, host, path,
       (SELECT arg_max(rh || rp, length(rh || rp)) FROM r WHERE (host = rh OR ends_with(host, '.' || rh)) AND starts_with(path, rp)) AS rule,
       coalesce((SELECT arg_max(action, length(rh || rp)) FROM r WHERE (host = rh OR ends_with(host, '.' || rh)) AND starts_with(path, rp)), 'allow') AS verdict
FROM p
"""

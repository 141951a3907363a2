"""Registered queries: profiling, projections, joins, set operations (A, P, J1-J2, U)."""

from __future__ import annotations

from pyspark.sql import functions as F

from caliper.functions import columns as C
from caliper.functions import text as X
from caliper.functions.stopwords import ENGLISH
from caliper.operators import profile as A
from caliper.operators.ranking import hash_order
from caliper.plans.common import (MEAN, R, SCORED_SQL, SEGMENT_SQL, WORD_RE, labelled_docs, scored_lineitem,
                                  segment_frame)
from caliper.plans.registry import Tables, query, sql_list

STOPS_SQL = sql_list(ENGLISH)


# Flagship: class-wise top terms --------------------------------------------------
@query("a22_class_top_terms", "A22 A25 J1 X1 X9 X13", sql=f"""
WITH t AS (
  SELECT l.quality, unnest(regexp_extract_all(lower(d.text), '{WORD_RE}')) AS term
  FROM documents d JOIN labels l ON d.doc_id = l.doc_id),
c AS (SELECT quality, term, count(*) AS count FROM t WHERE term NOT IN ({STOPS_SQL}) GROUP BY quality, term)
SELECT quality, term, count, CAST(rank AS INTEGER) AS rank FROM (
  SELECT *, row_number() OVER (PARTITION BY quality ORDER BY count DESC, term) AS rank FROM c)
WHERE rank <= 20""")
def class_top_terms(spark, sf):
    """documents ⋈ labels → lower → word tokens → stop words → top 20 terms per quality class."""
    t = Tables(spark, sf)
    toks = labelled_docs(t).select("quality", X.remove_stopwords(X.word_tokens(X.lower("text"))).alias("tokens"))
    return A.token_counts(toks, "tokens", by="quality", top_n=20)


@query("a1_table_summary", "A1", sql=f"""
SELECT count(*) AS rows, {R("avg(CAST(o_orderstatus = 'F' AS INTEGER))")} AS is_f_rate,
       {R(MEAN("o_totalprice"))} AS mean_o_totalprice FROM orders""")
def table_summary(spark, sf):
    o = Tables(spark, sf).orders.withColumn("is_f", (F.col("o_orderstatus") == "F").cast("int"))
    return A.table_summary(o, rate_col="is_f", mean_cols=["o_totalprice"], decimals=2)


_DESC_COLS = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]


def _describe_sql(cols, table, by=None):
    parts = []
    for c in cols:
        sel = (f"{by}, " if by else "") + f"""'{c}' AS column_name, count({c}) AS count, {R(MEAN(c))} AS mean,
  {R(f'stddev_samp({c})')} AS std, {R(f'min({c})')} AS min, {R(f'quantile_cont({c}, 0.25)')} AS p25,
  {R(f'quantile_cont({c}, 0.5)')} AS p50, {R(f'quantile_cont({c}, 0.75)')} AS p75, {R(f'max({c})')} AS max"""
        parts.append(f"SELECT {sel} FROM {table}" + (f" GROUP BY {by}" if by else ""))
    return "\nUNION ALL\n".join(parts)


@query("a2_describe", "A2", sql=_describe_sql(_DESC_COLS, "lineitem"))
def describe(spark, sf):
    return A.describe(Tables(spark, sf).lineitem, _DESC_COLS, decimals=2)


@query("a3_grouped_describe", "A3", sql=_describe_sql(["l_quantity", "l_discount"], "lineitem", "l_returnflag"))
def grouped_describe(spark, sf):
    return A.describe(Tables(spark, sf).lineitem, ["l_quantity", "l_discount"], by=["l_returnflag"], decimals=2)


@query("a4_value_counts", "A4 P11", sql="""
SELECT o_orderpriority, count(*) AS count FROM orders WHERE o_orderpriority IS NOT NULL GROUP BY 1""")
def value_counts(spark, sf):
    return A.value_counts(Tables(spark, sf).orders, "o_orderpriority")


@query("a5_value_shares", "A5", sql=f"""
SELECT event_type, count(*) AS count, {R("count(*) / (SELECT count(*) FROM events WHERE event_type IS NOT NULL)")} AS share
FROM events WHERE event_type IS NOT NULL GROUP BY 1""")
def value_shares(spark, sf):
    return A.value_counts(Tables(spark, sf).events, "event_type", normalize=True)


@query("a6_crosstab", "A6", sql="""
SELECT l_returnflag, count(*) FILTER (WHERE l_linestatus = 'F') AS "F", count(*) FILTER (WHERE l_linestatus = 'O') AS "O"
FROM lineitem WHERE l_returnflag IS NOT NULL AND l_linestatus IS NOT NULL GROUP BY 1""")
def crosstab(spark, sf):
    return A.crosstab(Tables(spark, sf).lineitem, "l_returnflag", "l_linestatus", ["F", "O"])


@query("a7_grouped_mean", "A7", sql=f"""
SELECT source, {R("avg(n_chars)")} AS mean_n_chars FROM documents GROUP BY 1""")
def grouped_mean(spark, sf):
    return A.grouped_mean(Tables(spark, sf).documents, "source", "n_chars")


@query("a8_segment_error", "A8 P9 P10 E22", sql=f"""
WITH {SEGMENT_SQL}
SELECT age_band, bmi_band, {R("avg(abs_error)")} AS mae, count(*) AS count FROM seg
WHERE age_band IS NOT NULL AND bmi_band IS NOT NULL GROUP BY 1, 2""")
def segment_error(spark, sf):
    return A.segment_error(segment_frame(Tables(spark, sf)), ["age_band", "bmi_band"])


@query("e22_worst_segments", "E22 P12", sql=f"""
WITH {SEGMENT_SQL}
SELECT age_band, bmi_band, {R("avg(abs_error)")} AS mae, count(*) AS count FROM seg
WHERE age_band IS NOT NULL AND bmi_band IS NOT NULL GROUP BY 1, 2 ORDER BY avg(abs_error) DESC, 1, 2 LIMIT 5""")
def worst_segments(spark, sf):
    return A.segment_error(segment_frame(Tables(spark, sf)), ["age_band", "bmi_band"], worst=5)


_BMI = ["normal", "overweight", "obese", "severely_obese"]


@query("a9_segment_pivot", "A9", sql=f"""
WITH {SEGMENT_SQL}, s AS (
  SELECT age_band, bmi_band, avg(abs_error) AS mae FROM seg
  WHERE age_band IS NOT NULL AND bmi_band IS NOT NULL GROUP BY 1, 2)
SELECT age_band, """ + ", ".join(f"{R(f'max(mae) FILTER (WHERE bmi_band = {chr(39)}{b}{chr(39)})')} AS {b}" for b in _BMI)
       + " FROM s GROUP BY 1")
def segment_pivot(spark, sf):
    seg = A.segment_error(segment_frame(Tables(spark, sf)), ["age_band", "bmi_band"])
    return A.crosstab(seg, "age_band", "bmi_band", _BMI, agg=F.first("mae"))


def _per_column_sql(table, cols, expr, alias):
    return "\nUNION ALL\n".join(f"SELECT '{c}' AS column_name, {expr.format(c=c)} AS {alias} FROM {table}" for c in cols)


_CUST = ["c_custkey", "c_name", "c_nationkey", "c_acctbal", "c_mktsegment"]


@query("a10_null_counts", "A10", sql=_per_column_sql("customer", _CUST, "count(*) FILTER (WHERE {c} IS NULL)", "null_count"))
def null_counts(spark, sf):
    return A.null_counts(Tables(spark, sf).customer)


_ORD_TYPES = [("o_orderkey", "bigint"), ("o_custkey", "bigint"), ("o_orderstatus", "string"),
              ("o_totalprice", "double"), ("o_orderdate", "timestamp_ntz"), ("o_orderpriority", "string")]


@query("a11_info", "A11", sql="\nUNION ALL\n".join(
    f"SELECT '{c}' AS column_name, '{ty}' AS dtype, count({c}) AS non_null, count(*) AS rows FROM orders"
    for c, ty in _ORD_TYPES))
def info(spark, sf):
    return A.info(Tables(spark, sf).orders)


_DIST = ["l_returnflag", "l_linestatus", "l_suppkey", "l_partkey"]


@query("a12_distinct_counts", "A12", sql=_per_column_sql("lineitem", _DIST, "count(DISTINCT {c})", "distinct"))
def distinct_counts(spark, sf):
    return A.distinct_count(Tables(spark, sf).lineitem, _DIST)


@query("a12_distinct_values", "A12", sql="SELECT DISTINCT source FROM documents")
def distinct_values(spark, sf):
    return Tables(spark, sf).documents.select("source").distinct()


_CORR = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]


@query("a13_correlation_matrix", "A13", sql="\nUNION ALL\n".join(
    f"SELECT '{a}' AS a, '{b}' AS b, {R(f'corr({a}, {b})')} AS r FROM lineitem" for a in _CORR for b in _CORR))
def correlation_matrix(spark, sf):
    return A.correlation_matrix(Tables(spark, sf).lineitem, _CORR)


@query("a14_target_correlation", "A14", sql="\nUNION ALL\n".join(
    f"SELECT '{c}' AS column_name, {R(f'corr({c}, l_extendedprice)')} AS r FROM lineitem"
    for c in ["l_quantity", "l_discount", "l_tax"]))
def target_correlation(spark, sf):
    return A.target_correlation(Tables(spark, sf).lineitem, "l_extendedprice", ["l_quantity", "l_discount", "l_tax"])


@query("a15_histogram", "A15", sql=f"""
WITH s AS (SELECT min(value) AS lo, max(value) AS hi FROM events WHERE value IS NOT NULL),
b AS (SELECT CAST(CASE WHEN hi = lo THEN 0 ELSE least(floor((value - lo) * 10 / (hi - lo)), 9) END AS INTEGER) AS bin
      FROM events, s WHERE value IS NOT NULL),
c AS (SELECT bin, count(*) AS count FROM b GROUP BY bin),
d AS (SELECT CAST(range AS INTEGER) AS bin FROM range(10))
SELECT d.bin, {R("lo + (hi - lo) * d.bin / 10")} AS bin_lo, {R("lo + (hi - lo) * (d.bin + 1) / 10")} AS bin_hi,
       coalesce(c.count, 0) AS count
FROM d CROSS JOIN s LEFT JOIN c ON d.bin = c.bin""")
def histogram(spark, sf):
    return A.histogram(Tables(spark, sf).events, "value", bins=10)


@query("a16_histogram_by_class", "A16", sql=f"""
WITH s AS (SELECT min(l_extendedprice) AS lo, max(l_extendedprice) AS hi FROM lineitem WHERE l_extendedprice IS NOT NULL),
b AS (SELECT l_returnflag, CAST(least(floor((l_extendedprice - lo) * 10 / (hi - lo)), 9) AS INTEGER) AS bin, lo, hi
      FROM lineitem, s WHERE l_extendedprice IS NOT NULL)
SELECT l_returnflag, bin, {R("min(lo) + (min(hi) - min(lo)) * bin / 10")} AS bin_lo,
       {R("min(lo) + (min(hi) - min(lo)) * (bin + 1) / 10")} AS bin_hi, count(*) AS count
FROM b GROUP BY l_returnflag, bin""")
def histogram_by_class(spark, sf):
    return A.histogram(Tables(spark, sf).lineitem, "l_extendedprice", bins=10, by="l_returnflag")


@query("a16b_histogram_own_bins", "A16", sql=f"""
WITH s AS (SELECT l_returnflag, min(l_extendedprice) AS lo, max(l_extendedprice) AS hi FROM lineitem WHERE l_extendedprice IS NOT NULL GROUP BY 1),
b AS (SELECT l.l_returnflag, CAST(least(floor((l_extendedprice - lo) * 10 / (hi - lo)), 9) AS INTEGER) AS bin, lo, hi
      FROM lineitem l JOIN s USING (l_returnflag) WHERE l_extendedprice IS NOT NULL)
SELECT l_returnflag, bin, {R("min(lo) + (min(hi) - min(lo)) * bin / 10")} AS bin_lo,
       {R("min(lo) + (min(hi) - min(lo)) * (bin + 1) / 10")} AS bin_hi, count(*) AS count
FROM b GROUP BY l_returnflag, bin""")
def histogram_own_bins(spark, sf):
    """Each class over its own range."""
    return A.histogram(Tables(spark, sf).lineitem, "l_extendedprice", bins=10, by="l_returnflag", shared_bins=False)


@query("a17_kde", "A17", sql=f"""
WITH s AS (SELECT count(value) AS n, stddev_samp(value) AS sd, min(value) AS lo, max(value) AS hi
           FROM events WHERE value IS NOT NULL),
p AS (SELECT n, lo, hi, sd * pow(CAST(n AS DOUBLE), -0.2) AS h FROM s),
q AS (SELECT n, h, lo - 3.0 * h AS g0, (hi - lo + 6.0 * h) / 199 AS step FROM p),
g AS (SELECT CAST(range AS INTEGER) AS i FROM range(200))
SELECT g.i, {R("any_value(g0) + g.i * any_value(step)")} AS x,
       {R("sum(exp(-0.5 * pow((g0 + g.i * step - e.value) / h, 2))) / (any_value(n) * any_value(h) * sqrt(2 * pi()))")} AS density
FROM g CROSS JOIN q CROSS JOIN (SELECT value FROM events WHERE value IS NOT NULL) e
GROUP BY g.i""")
def kde(spark, sf):
    return A.kde(Tables(spark, sf).events, "value", grid_size=200)


@query("a17b_kde_binned", "A17", sql=f"""
WITH s AS (SELECT count(value) AS n, stddev_samp(value) AS sd, min(value) AS lo, max(value) AS hi
           FROM events WHERE value IS NOT NULL),
p AS (SELECT n, lo, hi, sd * pow(CAST(n AS DOUBLE), -0.2) AS h, (hi - lo) / 2048 AS bw FROM s),
q AS (SELECT n, h, lo, bw, lo - 3.0 * h AS g0, (hi - lo + 6.0 * h) / 199 AS step FROM p),
u AS (SELECT (value - lo) / bw AS u, least(floor((value - lo) / bw), 2047) AS b FROM events, q WHERE value IS NOT NULL),
b AS (SELECT b, count(*) AS c, sum(u - b) AS f FROM u GROUP BY b),
m AS (SELECT i, sum(wt) AS wt FROM (SELECT b AS i, c - f AS wt FROM b UNION ALL SELECT b + 1, f FROM b) GROUP BY i),
g AS (SELECT CAST(range AS INTEGER) AS i FROM range(200))
SELECT g.i, {R("any_value(g0) + g.i * any_value(step)")} AS x,
       {R("sum(wt * exp(-0.5 * pow((g0 + g.i * step - (lo + m.i * bw)) / h, 2))) / (any_value(n) * any_value(h) * sqrt(2 * pi()))")} AS density
FROM g CROSS JOIN q CROSS JOIN m GROUP BY g.i""")
def kde_binned(spark, sf):
    """The density by linear binning: its cost does not grow with rows times grid points."""
    return A.kde(Tables(spark, sf).events, "value", grid_size=200, binned=True)


@query("a18_box_stats", "A18", sql=f"""
WITH q AS (SELECT event_type, quantile_cont(value, 0.25) AS q1, quantile_cont(value, 0.5) AS med,
                  quantile_cont(value, 0.75) AS q3 FROM events WHERE value IS NOT NULL GROUP BY 1),
f AS (SELECT *, q1 - 1.5 * (q3 - q1) AS lo, q3 + 1.5 * (q3 - q1) AS hi FROM q)
SELECT e.event_type, {R("f.q1")} AS q1, {R("f.med")} AS median, {R("f.q3")} AS q3,
       {R("min(CASE WHEN value >= lo AND value <= hi THEN value END)")} AS whisker_lo,
       {R("max(CASE WHEN value >= lo AND value <= hi THEN value END)")} AS whisker_hi,
       count(*) FILTER (WHERE NOT (value >= lo AND value <= hi)) AS outliers, count(*) AS n
FROM events e JOIN f ON e.event_type = f.event_type WHERE e.value IS NOT NULL
GROUP BY e.event_type, f.q1, f.med, f.q3""")
def box_stats(spark, sf):
    return A.box_stats(Tables(spark, sf).events, "value", by="event_type")


def _lv_sql(depth=4):
    ps = A.letter_value_probs(depth)
    parts = [f"SELECT event_type, 1 AS level, {R(f'quantile_cont(value, {ps[0]})')} AS lower, "
             f"{R(f'quantile_cont(value, {ps[0]})')} AS upper FROM events WHERE value IS NOT NULL GROUP BY 1"]
    for k in range(2, depth + 1):
        i = 1 + 2 * (k - 2)
        parts.append(f"SELECT event_type, {k} AS level, {R(f'quantile_cont(value, {ps[i]})')} AS lower, "
                     f"{R(f'quantile_cont(value, {ps[i + 1]})')} AS upper FROM events WHERE value IS NOT NULL GROUP BY 1")
    return "\nUNION ALL\n".join(parts)


@query("a19_letter_values", "A19", sql=_lv_sql(4))
def letter_values(spark, sf):
    return A.letter_values(Tables(spark, sf).events, "value", by="event_type", depth=4)


@query("a20_median", "A20", sql=f"""
SELECT o_orderstatus, {R("quantile_cont(o_totalprice, 0.5)")} AS median FROM orders GROUP BY 1""")
def median(spark, sf):
    return A.median(Tables(spark, sf).orders, "o_totalprice", by=["o_orderstatus"])


@query("a21_top_terms", "A21 X9", sql=f"""
WITH t AS (SELECT unnest(regexp_extract_all(lower(text), '{WORD_RE}')) AS term FROM documents)
SELECT term, count(*) AS count FROM t GROUP BY term ORDER BY count DESC, term LIMIT 25""")
def top_terms(spark, sf):
    d = Tables(spark, sf).texts.select(X.word_tokens(X.lower("text")).alias("tokens"))
    return A.token_counts(d, "tokens", top_n=25)


@query("a23_category_counts", "A23", sql="SELECT source, count(*) AS count FROM documents WHERE source IS NOT NULL GROUP BY 1")
def category_counts(spark, sf):
    return A.value_counts(Tables(spark, sf).documents, "source", ascending=True)


@query("a24_zero_filled_counts", "A24", sql="""
SELECT CAST(r.range AS INTEGER) AS p_size, coalesce(c.count, 0) AS count
FROM range(60) r LEFT JOIN (SELECT p_size, count(*) AS count FROM part GROUP BY 1) c ON r.range = c.p_size""")
def zero_filled_counts(spark, sf):
    return A.zero_filled_counts(Tables(spark, sf).part, "p_size", 60)


# Projections and predicates -------------------------------------------------------
@query("p1_features_target", "P1 P2 P13", sql="""
SELECT l_orderkey, l_linenumber, l_quantity, l_discount, l_tax, l_extendedprice AS target FROM lineitem""")
def features_target(spark, sf):
    li = Tables(spark, sf).lineitem
    feats = li.drop("l_partkey", "l_suppkey", "l_returnflag", "l_linestatus", "l_shipdate", "no_such_column")
    return feats.withColumnRenamed("l_extendedprice", "target")


@query("p3_filter_mask", "P3", sql="""
SELECT l_orderkey, l_linenumber, l_quantity FROM lineitem WHERE l_returnflag = 'R' AND l_quantity > 45""")
def filter_mask(spark, sf):
    li = Tables(spark, sf).lineitem
    return li.where((F.col("l_returnflag") == "R") & (F.col("l_quantity") > 45)).select(
        "l_orderkey", "l_linenumber", "l_quantity")


@query("p5_label_map", "P5", sql="""
SELECT conv_id, turn, CASE role WHEN 'user' THEN 1 WHEN 'assistant' THEN 0 END AS label FROM conversations""")
def label_map(spark, sf):
    c = Tables(spark, sf).conversations
    return c.select("conv_id", "turn", C.map_values("role", {"user": 1, "assistant": 0}).alias("label"))


@query("p6_threshold_flag", "P6 M15", sql=f"""
WITH {SCORED_SQL}
SELECT l_orderkey, l_linenumber, {R("score")} AS score, CAST(score >= 0.5 AS INTEGER) AS predicted FROM scored""")
def threshold_flag(spark, sf):
    s = scored_lineitem(Tables(spark, sf))
    return s.select("l_orderkey", "l_linenumber", "score", C.threshold_flag("score", 0.5).alias("predicted"))


@query("p7_clip", "P7", sql=f"""
SELECT l_orderkey, l_linenumber,
       {R("CASE WHEN l_extendedprice IS NULL THEN NULL ELSE least(greatest(l_extendedprice * (1 - l_discount), 1000.0), 50000.0) END")} AS net
FROM lineitem""")
def clip(spark, sf):
    li = Tables(spark, sf).lineitem
    return li.select("l_orderkey", "l_linenumber",
                     C.clip(F.col("l_extendedprice") * (1 - F.col("l_discount")), 1000.0, 50000.0).alias("net"))


@query("p8_rule_score", "P8", sql=f"""
SELECT o_orderkey, {R("least(greatest(0.35 * coalesce(CAST(o_orderpriority = '1-URGENT' AS INTEGER), 0) + 0.25 * coalesce(CAST(o_totalprice > 200000 AS INTEGER), 0) + 0.30 * coalesce(CAST(o_orderstatus = 'O' AS INTEGER), 0), 0.0), 0.9)")} AS risk
FROM orders""")
def rule_score(spark, sf):
    o = Tables(spark, sf).orders
    rules = [(0.35, F.col("o_orderpriority") == "1-URGENT"), (0.25, F.col("o_totalprice") > 200000),
             (0.30, F.col("o_orderstatus") == "O")]
    return o.select("o_orderkey", C.rule_score(rules, 0.0, 0.9).alias("risk"))


@query("p9_bands", "P9", sql="""
SELECT CASE WHEN p_size > 0 AND p_size <= 30 THEN '18-30' WHEN p_size > 30 AND p_size <= 45 THEN '31-45'
            WHEN p_size > 45 AND p_size <= 60 THEN '46-60' WHEN p_size > 60 AND p_size <= 100 THEN '60+' END AS age_band,
       CASE WHEN p_size > 0 AND p_size <= 30 THEN 0 WHEN p_size > 30 AND p_size <= 45 THEN 1
            WHEN p_size > 45 AND p_size <= 60 THEN 2 WHEN p_size > 60 AND p_size <= 100 THEN 3 END AS band_ordinal,
       count(*) AS count
FROM part GROUP BY ALL""")
def bands(spark, sf):
    p = Tables(spark, sf).part
    return (p.select(C.band("p_size", C.AGE_BANDS).alias("age_band"),
                     C.band("p_size", C.AGE_BANDS, ordinal=True).alias("band_ordinal"))
            .groupBy("age_band", "band_ordinal").agg(F.count(F.lit(1)).alias("count")))


@query("p10_abs_error", "P10", sql=f"""
WITH {SEGMENT_SQL} SELECT l_orderkey, l_linenumber, {R("abs_error")} AS abs_error FROM seg""")
def abs_error(spark, sf):
    return segment_frame(Tables(spark, sf)).select("l_orderkey", "l_linenumber", "abs_error")


@query("p11_sorted", "P11", sql="SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice DESC, o_orderkey")
def sorted_orders(spark, sf):
    return Tables(spark, sf).orders.select("o_orderkey", "o_totalprice").orderBy(
        F.col("o_totalprice").desc(), "o_orderkey")


@query("p12_top_bottom_k", "P12", sql="""
(SELECT 'top' AS side, o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 10)
UNION ALL
(SELECT 'bottom' AS side, o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice ASC, o_orderkey LIMIT 10)""")
def top_bottom_k(spark, sf):
    o = Tables(spark, sf).orders.select("o_orderkey", "o_totalprice")
    top = o.orderBy(F.col("o_totalprice").desc(), "o_orderkey").limit(10).select(F.lit("top").alias("side"), "*")
    bot = o.orderBy(F.col("o_totalprice").asc(), "o_orderkey").limit(10).select(F.lit("bottom").alias("side"), "*")
    return top.unionByName(bot)


@query("p14_ratio_format", "P14", sql=f"""
SELECT o_orderstatus, count(*) AS n,
       {R("round(100.0 * count(*) / (SELECT count(*) FROM orders), 2)")} AS pct,
       {R(MEAN("o_totalprice") + " / 1000.0")} AS mean_k
FROM orders GROUP BY 1""")
def ratio_format(spark, sf):
    o = Tables(spark, sf).orders
    total = o.agg(F.count(F.lit(1))).scalar()
    g = o.groupBy("o_orderstatus").agg(F.count(F.lit(1)).alias("n"), A.mean("o_totalprice", 2).alias("m"))
    return g.select("o_orderstatus", "n", C.percent(F.col("n"), total, 2).alias("pct"),
                    (F.col("m") / 1000.0).alias("mean_k"))


@query("p14b_fixed_decimal", "P14", sql="""
SELECT o_orderstatus, format('{:,.2f}', CAST(sum(CAST(o_totalprice AS DECIMAL(38,2))) AS DOUBLE)) AS total FROM orders GROUP BY 1""")
def fixed_decimal(spark, sf):
    g = Tables(spark, sf).orders.groupBy("o_orderstatus").agg(F.sum(F.col("o_totalprice").cast("decimal(38,2)")).cast("double").alias("t"))
    return g.select("o_orderstatus", C.fixed_decimal("t", 2).alias("total"))


_PTYPES = ["ECONOMY", "LARGE", "MEDIUM", "PROMO", "SMALL", "STANDARD"]


@query("p15_dummies", "P15", sql="SELECT p_partkey, " + ", ".join(
    f"coalesce(CAST(p_type = '{v}' AS INTEGER), 0) AS p_type_{v}" for v in _PTYPES[1:]) + " FROM part")
def dummy_columns(spark, sf):
    p = Tables(spark, sf).part.select("p_partkey", "p_type")
    return C.dummies(p, "p_type").drop("p_type")


@query("p16_hash_sample", "P16 T6", sql="""
SELECT doc_id, source FROM documents ORDER BY md5(concat_ws('|', CAST(doc_id AS VARCHAR), '42')), doc_id LIMIT 100""")
def hash_sample(spark, sf):
    d = Tables(spark, sf).documents.select("doc_id", "source")
    return d.orderBy(hash_order("doc_id", 42), "doc_id").limit(100)


@query("p17_head", "P17", sql="SELECT doc_id, lang, n_chars FROM documents ORDER BY doc_id LIMIT 5")
def head(spark, sf):
    return Tables(spark, sf).documents.select("doc_id", "lang", "n_chars").orderBy("doc_id").limit(5)


@query("p18_binned_scatter", "P18", sql="""
WITH s AS (SELECT min(l_quantity) AS xl, max(l_quantity) AS xh, min(l_extendedprice) AS yl, max(l_extendedprice) AS yh FROM lineitem)
SELECT CAST(least(floor((l_quantity - xl) * 10 / (xh - xl)), 9) AS INTEGER) AS bin_x,
       CAST(least(floor((l_extendedprice - yl) * 10 / (yh - yl)), 9) AS INTEGER) AS bin_y, l_returnflag, count(*) AS count
FROM lineitem, s WHERE l_quantity IS NOT NULL AND l_extendedprice IS NOT NULL GROUP BY ALL""")
def binned_scatter(spark, sf):
    return A.binned_scatter(Tables(spark, sf).lineitem, "l_quantity", "l_extendedprice", "l_returnflag", bins=10)


# Joins and set operations ---------------------------------------------------------------
@query("j1_attach_labels", "J1", sql="""
SELECT d.doc_id, d.source, l.quality, l.toxic FROM documents d JOIN labels l ON d.doc_id = l.doc_id""")
def attach_labels(spark, sf):
    return labelled_docs(Tables(spark, sf)).select("doc_id", "source", "quality", "toxic")


@query("j2_semi_select", "J2", sql="""
SELECT l_orderkey, l_linenumber FROM lineitem
WHERE l_orderkey IN (SELECT o_orderkey FROM orders WHERE o_orderpriority = '1-URGENT')""")
def semi_select(spark, sf):
    t = Tables(spark, sf)
    keys = t.orders.where(F.col("o_orderpriority") == "1-URGENT").select(F.col("o_orderkey").alias("l_orderkey"))
    return t.lineitem.select("l_orderkey", "l_linenumber").join(keys, on="l_orderkey", how="left_semi")

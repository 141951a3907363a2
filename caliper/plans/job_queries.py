"""Registered queries: token-mapping jobs, kNN, SMOTE and stream scoring."""

from __future__ import annotations

from pyspark.sql import functions as F

from caliper.functions import text as X
from caliper.functions.stopwords import topic_stops
from caliper.operators import smote as SM
from caliper.operators import textjobs as TJ
from caliper.plans.registry import Tables, query, sql_list
from caliper.plans.text_queries import topic_sql

TOPIC_STOPS = sql_list(topic_stops())


@query("x14_stemmed_tokens", "X14 X23")
def stemmed_tokens(spark, sf):
    """Sentiment cleaning with Porter stemming as a vocabulary-map job."""
    d = Tables(spark, sf).documents.select("doc_id", X.clean_sentiment("text").alias("toks"))
    s = TJ.stem_tokens(d, "doc_id", "toks", "stems")
    return s.select("doc_id", F.size("stems").alias("n_tokens"), F.md5(X.join_tokens("stems")).alias("h"))


def plural_lemmas(tokens_df, tokens_col="toks"):
    """A lemma table derived from the corpus: 'xs' -> 'x' when 'x' is itself a token of the corpus."""
    v = X.explode_tokens(tokens_df, [], tokens_col, "token").distinct()
    pl = v.where(F.col("token").endswith("s")).select("token", F.expr("substring(token, 1, length(token) - 1)").alias("lemma"))
    return pl.join(v.select(F.col("token").alias("lemma")), on="lemma", how="left_semi").select("token", "lemma")


@query("x15_lemmatized_tokens", "X15 X16 X23", sql=f"""
WITH d AS MATERIALIZED (SELECT doc_id, {topic_sql('text')} AS toks FROM documents),
e AS (SELECT doc_id, unnest(toks) AS token, generate_subscripts(toks, 1) AS pos FROM d),
v AS (SELECT DISTINCT token FROM e),
lem AS (SELECT v.token, substr(v.token, 1, length(v.token) - 1) AS lemma FROM v
        WHERE suffix(v.token, 's') AND substr(v.token, 1, length(v.token) - 1) IN (SELECT token FROM v)),
m AS (SELECT e.doc_id, e.pos, coalesce(lem.lemma, e.token) AS t FROM e LEFT JOIN lem ON e.token = lem.token),
f AS (SELECT doc_id, list(t ORDER BY pos) FILTER (WHERE NOT list_contains([{TOPIC_STOPS}], t)) AS toks FROM m GROUP BY doc_id)
SELECT d.doc_id, md5(array_to_string(coalesce(f.toks, []), ' ')) AS h, CAST(len(coalesce(f.toks, [])) AS INTEGER) AS n_tokens
FROM d LEFT JOIN f ON d.doc_id = f.doc_id""")
def lemmatized_tokens(spark, sf):
    """Topic cleaning, a corpus-derived lemma table, then the second stop-word pass."""
    d = Tables(spark, sf).documents.select("doc_id", X.clean_topic("text").alias("toks"))
    out = TJ.lemmatize_tokens(d, "doc_id", "toks", plural_lemmas(d), "lem", stops=topic_stops())
    return out.select("doc_id", F.md5(X.join_tokens("lem")).alias("h"), F.size("lem").alias("n_tokens"))


@query("j4_knn_minority", "J4", sql="""
WITH m AS (SELECT vec_id, CAST(embedding AS DOUBLE[]) AS v FROM embeddings WHERE label = 0),
p AS (SELECT a.vec_id, b.vec_id AS nn_key,
             list_sum(list_transform(list_zip(a.v, b.v), lambda z: (z[1] - z[2]) * (z[1] - z[2]))) AS d2
      FROM m a JOIN m b ON a.vec_id <> b.vec_id)
SELECT vec_id, CAST(rk AS INTEGER) AS rank, nn_key FROM (
  SELECT *, row_number() OVER (PARTITION BY vec_id ORDER BY d2, nn_key) AS rk FROM p) WHERE rk <= 5""")
def knn_minority(spark, sf):
    m = Tables(spark, sf).embeddings.where(F.col("label") == 0).select("vec_id", "embedding")
    return SM.knn(m, m, "vec_id", "embedding", k=5).select("vec_id", "rank", "nn_key")


@query("j4_knn_offset", "J4", sql="""
WITH m AS (SELECT vec_id, list_transform(embedding, lambda x: CAST(x AS DOUBLE) + 1e8) AS v FROM embeddings WHERE label = 0),
p AS (SELECT a.vec_id, b.vec_id AS nn_key,
             list_sum(list_transform(list_zip(a.v, b.v), lambda z: (z[1] - z[2]) * (z[1] - z[2]))) AS d2
      FROM m a JOIN m b ON a.vec_id <> b.vec_id)
SELECT vec_id, CAST(rk AS INTEGER) AS rank, nn_key FROM (
  SELECT *, row_number() OVER (PARTITION BY vec_id ORDER BY d2, nn_key) AS rk FROM p) WHERE rk <= 5""")
def knn_offset(spark, sf):
    """Vectors far from the origin, where expanded squares cancel."""
    m = Tables(spark, sf).embeddings.where(F.col("label") == 0).select(
        "vec_id", F.transform("embedding", lambda x: x.cast("double") + F.lit(1e8)).alias("v"))
    return SM.knn(m, m, "vec_id", "v", k=5, block_rows=100).select("vec_id", "rank", "nn_key")


@query("f10_smote", "F10 J4", sql="""
WITH c AS (SELECT count(*) FILTER (WHERE label = 0) AS mino, count(*) FILTER (WHERE label <> 0) AS majo FROM embeddings)
SELECT * FROM (SELECT 0 AS y, FALSE AS synthetic, majo AS count, 0.0 AS off_segment FROM c
               UNION ALL SELECT 1, FALSE, mino, 0.0 FROM c
               UNION ALL SELECT 1, TRUE, greatest(majo - mino, 0), 0.0 FROM c) WHERE count > 0""")
def smote_counts(spark, sf):
    """SMOTE to 1:1 (label 0 as the minority), then class counts and the largest off-segment residual."""
    e = Tables(spark, sf).embeddings.select("vec_id", "embedding", (F.col("label") == 0).cast("int").alias("y"))
    out = SM.smote(e, "vec_id", "embedding", "y", minority=1, k=5, seed=42)
    # distance of each synthetic point from the nearest segment between its seed row and one of that row's neighbours
    m = e.where("y = 1").select("vec_id", F.col("embedding").cast("array<double>").alias("a"))
    nn = SM.knn(m, m, "vec_id", "a", k=5).select("vec_id", "nn_key").join(
        m.select(F.col("vec_id").alias("nn_key"), F.col("a").alias("b")), "nn_key").join(m, "vec_id")
    syn = out.where("synthetic").select(F.col("vec_id").alias("name"), F.col("embedding").alias("p"),
                                        F.substring_index("vec_id", "#s", 1).cast("long").alias("vec_id"))
    minus = lambda x, y: F.zip_with(x, y, lambda s, t: s - t)
    dot = lambda x, y: F.aggregate(F.zip_with(x, y, lambda s, t: s * t), F.lit(0.0), lambda s, t: s + t)
    j = syn.join(nn, "vec_id").select("name", minus("p", "a").alias("d"), minus("b", "a").alias("e"))
    j = j.withColumn("t", F.coalesce(dot("d", "e") / F.nullif(dot("e", "e"), F.lit(0.0)), F.lit(0.0)))
    gap = F.zip_with("d", "e", lambda s, t: s - F.col("t") * t)
    off = j.select("name", F.when(F.col("t").between(-1e-9, 1 + 1e-9), F.sqrt(dot(gap, gap))).alias("r")).groupBy("name").agg(F.min("r").alias("r"))
    worst = off.agg(F.max(F.coalesce("r", F.lit(1e9)))).scalar()
    n = out.groupBy("y", "synthetic").agg(F.count(F.lit(1)).alias("count"))
    return n.withColumn("off_segment", F.when(F.col("synthetic"), worst).otherwise(F.lit(0.0)))


@query("f2_population_scaler", "F2 F1", sql="""
SELECT l_orderkey, l_linenumber,
       floor((l_quantity - avg(l_quantity) OVER ()) / stddev_pop(l_quantity) OVER () * 1000000.0 + 0.5) / 1000000.0 + 0.0 AS q
FROM lineitem""")
def population_scaler(spark, sf):
    from caliper.operators import models as M
    li = Tables(spark, sf).lineitem.select("l_orderkey", "l_linenumber", "l_quantity")
    out = M.PopulationScaler(["l_quantity"]).fit(li).transform(li)
    return out.select("l_orderkey", "l_linenumber", F.col("l_quantity__sc").alias("q"))


@query("f1_median_imputer", "F1", sql="""
WITH x AS (SELECT c_custkey, CASE WHEN c_custkey % 3 = 0 THEN NULL ELSE c_acctbal END AS a FROM customer)
SELECT c_custkey, floor(coalesce(a, (SELECT quantile_cont(a, 0.5) FROM x)) * 1000000.0 + 0.5) / 1000000.0 + 0.0 AS a, CAST(NULL AS DOUBLE) AS empty FROM x""")
def median_imputer(spark, sf):
    """Medians of all columns in one job; a column without values stays NULL."""
    from caliper.operators import models as M
    c = Tables(spark, sf).customer.select("c_custkey", F.when(F.col("c_custkey") % 3 != 0, F.col("c_acctbal")).alias("a"),
                                          F.lit(None).cast("double").alias("empty"))
    out = M.MedianImputer(["a", "empty"]).fit(c).transform(c)
    return out.select("c_custkey", F.col("a__imp").alias("a"), F.col("empty__imp").alias("empty"))


@query("s8_records_json", "S8", sql="SELECT CAST(o_orderstatus AS VARCHAR) AS o_orderstatus, count(*) AS n FROM orders GROUP BY 1")
def records_json(spark, sf):
    from caliper.session import scratch_path
    from caliper.sources import io as IO
    m = Tables(spark, sf).orders.groupBy("o_orderstatus").agg(F.count(F.lit(1)).alias("n"))
    p = scratch_path(spark, "records-json")
    IO.write_records_json(m, p, "o_orderstatus")
    return spark.read.schema(m.schema).json(p)


@query("w1_stream_scoring", "W1 C1")
def stream_scoring(spark, sf):
    from caliper.plans.model_queries import _text_model
    from caliper.plans.common import labelled_docs
    from caliper.streaming.score_stream import score_available
    t = Tables(spark, sf)
    train = labelled_docs(t).select("doc_id", "text", F.col("toxic").cast("double").alias("label"))
    model = _text_model(train, C=10.0, vocab=2000, ngram=(1, 1), profile="spam")
    # one file or a folder of part files: the messages are the table's files
    path = f"{sf.rstrip('/')}/conversations.parquet"
    return score_available(model, spark, path, spark.read.parquet(path).schema, F.concat_ws(":", "conv_id", "turn"))


# Sources and sinks: round trips through the shared checkpoint folder ------------------------
@query("s1_csv_roundtrip", "S1 S5 S7", sql="SELECT * FROM customer")
def csv_roundtrip(spark, sf):
    from caliper.session import scratch_path
    from caliper.sources import io as IO
    c = Tables(spark, sf).customer
    p = scratch_path(spark, "customer-csv")
    IO.write_table(c, p, fmt="csv")
    back = IO.read_csv(spark, p, schema=c.schema)
    return IO.require_columns(back, c.columns, "customer csv")


@query("s2_tsv_scan", "S2", sql="""
SELECT role AS label, regexp_replace(text, '[\\t\\n\\r]', ' ', 'g') AS text FROM conversations""")
def tsv_scan(spark, sf):
    from caliper.session import scratch_path
    from caliper.sources import io as IO
    c = Tables(spark, sf).conversations.select("role", F.regexp_replace("text", "[\\t\\n\\r]", " ").alias("text"))
    p = scratch_path(spark, "messages-tsv")
    c.write.mode("overwrite").option("sep", "\t").option("quote", "\u0000").csv(p)
    return IO.read_labelled_tsv(spark, p)


@query("s4_corpus_scan", "S4", sql="SELECT doc_id, source AS category, CAST(length(text) AS INTEGER) AS n FROM documents")
def corpus_scan(spark, sf):
    from caliper.sources import io as IO
    return IO.corpus(spark, sf).select("doc_id", "category", F.length("raw_text").alias("n"))


@query("s6_fallback_drop_target", "S6 P2", sql="SELECT c_custkey, c_name, c_nationkey, c_acctbal FROM customer")
def fallback_drop_target(spark, sf):
    from caliper.sources import io as IO
    paths = [f"{sf}/no_such_customer.parquet", f"{sf}/customer.parquet"]
    return IO.read_with_fallback(spark, paths, spark.read.parquet, drop=["c_mktsegment", "absent_target"])


@query("s8_metrics_json", "S8 E4 E5", sql="""
SELECT count(*) FILTER (WHERE l_returnflag = 'R') AS positives, count(*) AS n FROM lineitem""")
def metrics_json(spark, sf):
    from caliper.session import scratch_path
    from caliper.sources import io as IO
    li = Tables(spark, sf).lineitem
    m = li.agg(F.count_if(F.col("l_returnflag") == "R").alias("positives"), F.count(F.lit(1)).alias("n"))
    p = scratch_path(spark, "metrics-json")
    IO.write_metrics_json(m, p)
    return spark.read.schema(m.schema).json(p)


@query("s9_model_roundtrip", "S9 S10 M11", sql="SELECT CAST(ceil(count(*) / 5.0) AS BIGINT) AS n, 0.0 AS max_gap FROM orders")
def model_roundtrip(spark, sf):
    from pyspark.ml import Pipeline
    from caliper.operators import models as M
    from caliper.operators import split as S
    from caliper.session import scratch_path
    from caliper.sources import io as IO
    o = Tables(spark, sf).orders.select("o_orderkey", "o_orderstatus", F.col("o_totalprice").alias("label"))
    d = S.train_test_split(o, "o_orderkey", 0.2, 42)
    sp = scratch_path(spark, "orders-split")
    IO.persist_split(d, sp)
    train, test = IO.read_split(spark, sp, "train"), IO.read_split(spark, sp, "test")
    model = Pipeline(stages=M.tabular_stages([], ["o_orderstatus"]) + [M.linear_regression()]).fit(train)
    mp = scratch_path(spark, "orders-model")
    IO.save_model(model, mp)
    loaded = IO.load_pipeline_model(mp)
    a = model.transform(test).select("o_orderkey", F.col("prediction").alias("p1"))
    b = loaded.transform(test).select("o_orderkey", F.col("prediction").alias("p2"))
    return a.join(b, "o_orderkey").agg(F.count(F.lit(1)).alias("n"), F.max(F.abs(F.col("p1") - F.col("p2"))).alias("max_gap"))


@query("f1_median_impute", "F1", sql="""
WITH x AS (SELECT CASE WHEN l_discount = 0 THEN NULL ELSE l_discount END AS d FROM lineitem),
m AS (SELECT quantile_cont(d, 0.5) AS med FROM x)
SELECT count(*) FILTER (WHERE d IS NULL) AS n_imputed,
       floor(CAST(sum(CAST(coalesce(d, med) AS DECIMAL(38,6))) AS DOUBLE) * 1000000.0 + 0.5) / 1000000.0 + 0.0 AS total
FROM x, m""")
def median_impute(spark, sf):
    from caliper.operators import models as M
    x = Tables(spark, sf).lineitem.select(F.when(F.col("l_discount") == 0, F.lit(None)).otherwise(F.col("l_discount")).alias("d"))
    out = M.MedianImputer(["d"]).fit(x).transform(x)
    # exact decimal sum: the total does not depend on the summation order
    return out.agg(F.count_if(F.col("d").isNull()).alias("n_imputed"),
                   F.sum(F.col("d__imp").cast("decimal(38,6)")).cast("double").alias("total"))

"""Registered queries: text cleaning, tokenisation and text features (X, F5, F6, F13-F15, P4)."""

from __future__ import annotations

from pyspark.sql import functions as F

from caliper.functions import text as X
from caliper.functions.stopwords import ENGLISH, topic_stops
from caliper.operators import features as FT
from caliper.operators import profile as A
from caliper.plans.common import R, WORD_RE
from caliper.session import stored
from caliper.plans.registry import Tables, query, sql_list


def q(s: str) -> str:
    """A SQL string literal."""
    return "'" + s.replace("'", "''") + "'"


WS_SQL = X.WS  # the same class text reads alike in Java and RE2
STOPS = sql_list(ENGLISH)
TOPIC_STOPS = sql_list(topic_stops())


def ws_tokens_sql(e: str) -> str:
    return f"list_filter(regexp_split_to_array({e}, '[{WS_SQL}]+'), lambda t: t <> '')"


def no_stops_sql(e: str, stops: str = STOPS) -> str:
    return f"list_filter({e}, lambda t: NOT list_contains([{stops}], t))"


def strip_html_sql(e: str) -> str:
    return f"regexp_replace({e}, '<.*?>', '', 'g')"


def sentiment_sql(e: str) -> str:
    t = f"regexp_replace(lower({e}), '<.*?>', '', 'g')"
    t = f"regexp_replace({t}, '[^a-zA-Z{WS_SQL}]', '', 'g')"
    t = f"trim(regexp_replace({t}, '[{WS_SQL}]+', ' ', 'g'), ' ')"
    return no_stops_sql(ws_tokens_sql(t))


def spam_sql(e: str, trim: bool = False) -> str:
    t = f"regexp_replace(regexp_replace(lower({e}), '[^\\p{{L}}\\p{{N}}_]', ' ', 'g'), '[{WS_SQL}]+', ' ', 'g')"
    return f"trim({t}, ' ')" if trim else t


def topic_sql(e: str) -> str:
    nws = f"[^{WS_SQL}]"
    t = f"coalesce(CAST({e} AS VARCHAR), '')"
    t = f"regexp_replace({t}, '{nws}+@{nws}+', ' ', 'g')"
    t = f"regexp_replace({t}, 'http{nws}+|www\\.{nws}+', ' ', 'g')"
    t = f"regexp_replace({t}, '(?im)^({X.HEADER_NAMES}):.*$', ' ', 'g')"
    t = f"translate({t}, {q(X.PUNCT_DIGITS)}, {q(' ' * len(X.PUNCT_DIGITS))})"
    toks = f"list_filter({ws_tokens_sql(f'lower({t})')}, lambda t: length(t) >= 3)"
    return no_stops_sql(toks, TOPIC_STOPS)


def accents_sql(e: str) -> str:
    """DuckDB's own accent stripping."""
    return f"strip_accents({e})"


def letters3_sql(e: str) -> str:
    return f"list_filter(regexp_extract_all({e}, '{WORD_RE}'), lambda t: regexp_full_match(t, '[a-zA-Z]{{3,}}'))"


@query("x2_strip_html", "X2", sql=f"""
SELECT page_id, md5({strip_html_sql('html')}) AS h, CAST(length({strip_html_sql('html')}) AS INTEGER) AS n FROM pages""")
def strip_html(spark, sf):
    p = Tables(spark, sf).pages
    s = X.strip_html("html")
    return p.select("page_id", F.md5(s).alias("h"), F.length(s).alias("n"))


@query("x23_sentiment_clean", "X23 X1 X2 X3 X4 X8 X13 X17 UD1", sql=f"""
SELECT doc_id, md5(array_to_string(toks, ' ')) AS h, CAST(len(toks) AS INTEGER) AS n_tokens
FROM (SELECT doc_id, {sentiment_sql('text')} AS toks FROM documents)""")
def sentiment_clean(spark, sf):
    d = Tables(spark, sf).texts
    toks = X.clean_sentiment("text")
    return d.select("doc_id", F.md5(X.join_tokens(toks)).alias("h"), F.size(toks).alias("n_tokens"))


@query("p4_drop_empty_clean", "P4", sql=f"""
SELECT count(*) FILTER (WHERE c <> '') AS kept, count(*) FILTER (WHERE c = '') AS dropped
FROM (SELECT array_to_string({sentiment_sql('text')}, ' ') AS c FROM documents)""")
def drop_empty_clean(spark, sf):
    d = Tables(spark, sf).texts.select(X.join_tokens(X.clean_sentiment("text")).alias("c"))
    return d.agg(F.count_if(F.col("c") != "").alias("kept"), F.count_if(F.col("c") == "").alias("dropped"))


@query("x23_spam_clean", "X23 X1 X5 X4 X18", sql=f"""
SELECT doc_id, md5(c) AS h, CAST(length(c) AS INTEGER) AS length FROM (SELECT doc_id, {spam_sql('text')} AS c FROM documents)""")
def spam_clean(spark, sf):
    c = X.clean_spam("text")
    return Tables(spark, sf).texts.select("doc_id", F.md5(c).alias("h"), F.length(c).alias("length"))


@query("x23_spam_clean_trimmed", "X4", sql=f"""
SELECT conv_id, turn, CAST(length({spam_sql('text', trim=True)}) AS INTEGER) AS length FROM conversations""")
def spam_clean_trimmed(spark, sf):
    c = X.clean_spam("text", trim=True)
    return Tables(spark, sf).conversations.select("conv_id", "turn", F.length(c).alias("length"))


@query("x23_topic_clean", "X23 X22 X6 X7 X1 X10 X12 X13 X16 X17 U2", sql=f"""
SELECT doc_id, md5(array_to_string(toks, ' ')) AS h, CAST(len(toks) AS INTEGER) AS n_tokens
FROM (SELECT doc_id, {topic_sql('text')} AS toks FROM documents)""")
def topic_clean(spark, sf):
    toks = X.clean_topic("text")
    return Tables(spark, sf).texts.select("doc_id", F.md5(X.join_tokens(toks)).alias("h"),
                                              F.size(toks).alias("n_tokens"))


@query("x6_email_artifacts", "X6", sql=f"""
SELECT conv_id, turn, md5(c) AS h FROM (SELECT conv_id, turn,
  regexp_replace(regexp_replace(regexp_replace(text, '[^{WS_SQL}]+@[^{WS_SQL}]+', ' ', 'g'),
    'http[^{WS_SQL}]+|www\\.[^{WS_SQL}]+', ' ', 'g'), '(?im)^({X.HEADER_NAMES}):.*$', ' ', 'g') AS c
  FROM conversations)""")
def email_artifacts(spark, sf):
    c = Tables(spark, sf).conversations
    return c.select("conv_id", "turn", F.md5(X.strip_email_artifacts("text")).alias("h"))


@query("x7_punct_digits", "X7", sql=f"""
SELECT item_id, translate(text, {q(X.PUNCT_DIGITS)}, {q(' ' * len(X.PUNCT_DIGITS))}) AS c FROM benchmark""")
def punct_digits(spark, sf):
    return Tables(spark, sf).benchmark.select("item_id", X.punct_digits_to_space("text").alias("c"))


@query("x19_word_count", "X19 X8 X18", sql=f"""
SELECT doc_id, CAST(len({ws_tokens_sql('text')}) AS INTEGER) AS words, CAST(length(text) AS INTEGER) AS chars FROM documents""")
def word_count(spark, sf):
    d = Tables(spark, sf).texts
    return d.select("doc_id", X.word_count("text").alias("words"), X.char_length("text").alias("chars"))


@query("x20_bigram_counts", "X20 A21", sql=f"""
WITH t AS MATERIALIZED (SELECT doc_id, {sentiment_sql('text')} AS toks FROM documents),
g AS (SELECT unnest(list_transform(list_zip(toks[1:len(toks) - 1], toks[2:len(toks)]),
                                   lambda p: p[1] || ' ' || p[2])) AS gram FROM t WHERE len(toks) >= 2)
SELECT gram, count(*) AS count FROM g GROUP BY gram ORDER BY count DESC, gram LIMIT 30""")
def bigram_counts(spark, sf):
    d = Tables(spark, sf).texts.select(X.ngrams(X.clean_sentiment("text"), 2, 2).alias("grams"))
    return A.token_counts(d, "grams", top_n=30, term_col="gram")


@query("x20_uni_bi_grams", "X20", sql=f"""
WITH t AS (SELECT item_id, {sentiment_sql('text')} AS toks FROM benchmark)
SELECT item_id, CAST(len(toks) + greatest(len(toks) - 1, 0) AS INTEGER) AS n_grams FROM t""")
def uni_bi_grams(spark, sf):
    b = Tables(spark, sf).benchmark
    return b.select("item_id", F.size(X.ngrams(X.clean_sentiment("text"), 1, 2)).alias("n_grams"))


# letters with marks outside Latin-1 (two below, a horn, stacked marks), appended to every text
MARKED = "Vi\u1ec7t \u1e01\u1e13 \u01a1\u1edb \u0101\u0323 \u03ac \u0439"


@query("x21_strip_accents", "X21", sql=f"""
SELECT doc_id, md5({accents_sql(f"text || '{MARKED}'")}) AS h FROM documents""")
def strip_accents(spark, sf):
    d = Tables(spark, sf).texts
    return d.select("doc_id", F.md5(X.strip_accents(F.concat("text", F.lit(MARKED)))).alias("h"))


@query("x11_vectorizer_tokens", "X11 X9 X12", sql=f"""
SELECT doc_id,
  CAST(len(list_filter(regexp_extract_all(lower(text), '{WORD_RE}'), lambda t: length(t) >= 2)) AS INTEGER) AS n_default,
  CAST(len({letters3_sql('lower(text)')}) AS INTEGER) AS n_letters3,
  CAST(len(list_filter({ws_tokens_sql('text')}, lambda t: length(t) >= 3)) AS INTEGER) AS n_min3
FROM documents""")
def vectorizer_tokens(spark, sf):
    d = Tables(spark, sf).texts
    return d.select("doc_id", F.size(X.vectorizer_tokens(X.lower("text"), "default")).alias("n_default"),
                    F.size(X.vectorizer_tokens(X.lower("text"), "letters3")).alias("n_letters3"),
                    F.size(X.min_length(X.whitespace_tokens("text"), 3)).alias("n_min3"))


@query("x25_argmax", "X25 T3", sql="""
SELECT vec_id, CAST(list_position(embedding, list_max(embedding)) - 1 AS INTEGER) AS argmax FROM embeddings""")
def argmax(spark, sf):
    return Tables(spark, sf).embeddings.select("vec_id", X.argmax("embedding").alias("argmax"))


@query("x24_topic_names", "X24 A22", sql=f"""
WITH t AS (SELECT source, unnest({no_stops_sql(letters3_sql('lower(text)'), TOPIC_STOPS)}) AS term FROM documents),
c AS (SELECT source, term, count(*) AS n FROM t GROUP BY 1, 2),
r AS (SELECT *, row_number() OVER (PARTITION BY source ORDER BY n DESC, term) AS rk FROM c QUALIFY rk <= 2)
SELECT source, max(CASE WHEN rk = 1 THEN upper(substr(term, 1, 1)) || substr(term, 2) END) || ' & ' ||
               max(CASE WHEN rk = 2 THEN upper(substr(term, 1, 1)) || substr(term, 2) END) AS topic_name
FROM r GROUP BY source""")
def topic_names(spark, sf):
    d = Tables(spark, sf).texts.select(
        "source", X.remove_stopwords(X.vectorizer_tokens(X.lower("text"), "letters3"), topic_stops()).alias("toks"))
    top2 = A.token_counts(d, "toks", by="source", top_n=2)
    words = top2.groupBy("source").agg(F.sort_array(F.collect_list(F.struct("rank", "term"))).alias("w"))
    return words.select("source", X.topic_name(F.transform("w", lambda s: s["term"])).alias("topic_name"))


# Text features -------------------------------------------------------------------------
def topic_tf(t: Tables):
    """Topic vectorizer input: lower -> strip accents -> >= 3 ASCII letters (sklearn token pattern)."""
    d = t.texts.select("doc_id", X.vectorizer_tokens(X.strip_accents(X.lower("text")), "letters3").alias("toks"))
    return FT.term_frequencies(d, "doc_id", "toks")


TOPIC_TF_SQL = f"""tf AS (
  SELECT doc_id, term, count(*) AS tf FROM (
    SELECT doc_id, unnest({letters3_sql(accents_sql('lower(text)'))}) AS term FROM documents)
  GROUP BY 1, 2),
nd AS (SELECT count(*) AS n FROM documents),
st AS (SELECT term, count(*) AS df, sum(tf) AS cnt FROM tf GROUP BY term),
vocab AS (SELECT term, df, cnt FROM st, nd WHERE df >= 2 AND df <= 0.95 * n ORDER BY cnt DESC, term LIMIT 5000)"""


@query("f5_count_vocabulary", "F5 X21 X11", sql=f"""
WITH {TOPIC_TF_SQL}
SELECT term, CAST(row_number() OVER (ORDER BY term) - 1 AS INTEGER) AS idx, df, CAST(cnt AS BIGINT) AS count FROM vocab""")
def count_vocabulary(spark, sf):
    t = Tables(spark, sf)
    n = t.documents.agg(F.count(F.lit(1))).scalar()
    return FT.fit_vocabulary(topic_tf(t), n, max_features=5000, min_df=2, max_df=0.95)


@query("f6_tfidf_sublinear", "F6", sql=f"""
WITH {TOPIC_TF_SQL},
w AS (SELECT tf.doc_id, tf.term, (1 + ln(tf.tf)) * (ln((1 + n) / (1 + v.df)) + 1) AS w
      FROM tf JOIN vocab v ON tf.term = v.term, nd)
SELECT doc_id, term, {R("w / sqrt(sum(w * w) OVER (PARTITION BY doc_id))")} AS weight FROM w""")
def tfidf_sublinear(spark, sf):
    t = Tables(spark, sf)
    n = t.documents.agg(F.count(F.lit(1))).scalar()
    tf = topic_tf(t)
    vocab = FT.fit_vocabulary(tf, n, max_features=5000, min_df=2, max_df=0.95)
    return FT.tfidf(tf, vocab, n, "doc_id", sublinear=True, vocab_bound=5000).select("doc_id", "term", "weight")


@query("f13_dtm_stats", "F13", sql=f"""
WITH {TOPIC_TF_SQL},
nnz AS (SELECT count(*) AS nnz FROM tf JOIN vocab USING (term))
SELECT CAST(n AS BIGINT) AS n_docs, CAST((SELECT count(*) FROM vocab) AS BIGINT) AS n_terms, nnz,
       {R("1 - nnz / (n * (SELECT count(*) FROM vocab))")} AS sparsity FROM nd, nnz""")
def dtm_stats(spark, sf):
    t = Tables(spark, sf)
    n = t.documents.agg(F.count(F.lit(1))).scalar()
    tf = stored(topic_tf(t), "term-frequencies")            # texts are cleaned and counted once
    vocab = stored(FT.fit_vocabulary(tf, n, max_features=5000, min_df=2, max_df=0.95), "vocabulary")
    kept = tf.join(F.broadcast(vocab.select("term")), on="term")  # vocabulary capped at 5000
    return FT.dtm_stats(kept, n, vocab.agg(F.count(F.lit(1))).scalar())


@query("f14_doc_freq_hist", "F14 A15", sql=f"""
WITH {TOPIC_TF_SQL},
s AS (SELECT min(df) AS lo, max(df) AS hi FROM st),
b AS (SELECT CAST(CASE WHEN hi = lo THEN 0 ELSE least(floor((df - lo) * 10 / (hi - lo)), 9) END AS INTEGER) AS bin FROM st, s),
c AS (SELECT bin, count(*) AS count FROM b GROUP BY bin),
d AS (SELECT CAST(range AS INTEGER) AS bin FROM range(10))
SELECT d.bin, {R("lo + (hi - lo) * d.bin / 10")} AS bin_lo, {R("lo + (hi - lo) * (d.bin + 1) / 10")} AS bin_hi,
       coalesce(c.count, 0) AS count FROM d CROSS JOIN s LEFT JOIN c ON d.bin = c.bin""")
def doc_freq_hist(spark, sf):
    return A.histogram(FT.document_frequency(topic_tf(Tables(spark, sf))), "df", bins=10)


@query("f15_vocab_transform", "F15", sql=f"""
WITH {TOPIC_TF_SQL},
b AS (SELECT item_id, unnest({letters3_sql(accents_sql('lower(text)'))}) AS term FROM benchmark)
SELECT item_id, b.term, count(*) AS tf FROM b JOIN vocab ON b.term = vocab.term GROUP BY 1, 2""")
def vocab_transform(spark, sf):
    t = Tables(spark, sf)
    n = t.documents.agg(F.count(F.lit(1))).scalar()
    vocab = FT.fit_vocabulary(topic_tf(t), n, max_features=5000, min_df=2, max_df=0.95)
    b = t.benchmark.select("item_id", X.vectorizer_tokens(X.strip_accents(X.lower("text")), "letters3").alias("toks"))
    return FT.apply_vocabulary(b, "item_id", "toks", vocab).select("item_id", "term", "tf")


@query("x24b_keyword_split", "X24", sql="""
SELECT item_id, len(k) AS n, array_to_string(k, '|') AS keywords FROM (
  SELECT item_id, list_filter(list_transform(string_split(text, ','), lambda x: trim(x)), lambda x: x <> '') AS k FROM benchmark)""")
def keyword_split(spark, sf):
    """Comma separated entries, trimmed, empty ones dropped."""
    k = Tables(spark, sf).benchmark.select("item_id", X.keyword_split("text").alias("k"))
    return k.select("item_id", F.size("k").cast("long").alias("n"), F.array_join("k", "|").alias("keywords"))

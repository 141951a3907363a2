"""Nulls, empty and very long texts, ties, repeated rows, empty tables and clashing columns, against plain Python."""

import random
import zlib
from collections import Counter, defaultdict

import brute
import numpy as np
import pandas as pd
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from caliper.llm import bm25_search, decontaminate, jaccard_join, language_id, line_dedup, mixing, substring_dedup, suffix_dedup, url_filter, warc
from caliper.session import scratch_path

DOCS = "doc_id long, text string, lang string, source string, n_chars long"
# names that the operators use inside
EXTRA = ["id", "rk", "n", "row", "size", "toks", "score", "lang_pred", "ambiguous", "h1", "n_words", "items", "n_lines", "target", "_k", "_rk", "p"]
rng = random.Random(3)
WORDS = ["the", "of", "and", "Über", "naïve", "ça", *(f"w{i}" for i in range(400))]


def prose(n, seed):
    r = random.Random(seed)
    return " ".join(r.choice(WORDS) for _ in range(n))


def edited(text, every, seed):
    r = random.Random(seed)
    return " ".join(f"x{r.random()}" if i % every == every - 1 else w for i, w in enumerate(text.split(" ")))


PASSAGE, BASE, LONG = prose(70, 1), prose(300, 2), prose(30_000, 4)
TEXTS = [
    (1, None), (2, ""), (3, " \n\t\x0b "), (4, BASE), (5, BASE), (5, BASE), (6, edited(BASE, 60, 1)), (7, edited(BASE, 90, 2)), (8, edited(BASE, 8, 3)),
    (9, prose(40, 5) + "\n" + PASSAGE + " " + prose(50, 6)), (10, prose(20, 7) + "\t" + PASSAGE), (11, PASSAGE[:-3]), (None, prose(60, 8)), (None, prose(60, 8)),
    (None, None), (12, "a " * 120), (13, "the of and"), (14, "The  OF\nand"), (15, LONG), (16, LONG + " " + prose(80, 9)), (17, "one"), (-5, prose(64, 8)),
    (18, "\x00 nul \x00"), (19, BASE + "\n" + BASE),
]


def docs(spark, texts=TEXTS, extra=EXTRA):
    df = spark.createDataFrame([(i, t, None if i is None else "en", f"s{(i or 0) % 3}", len(t or "")) for i, t in texts], DOCS)
    return df.select("*", *[F.lit(7).alias(c) for c in extra])


def test_suffix_dedup(spark):
    got = Counter((r.doc_id, r.begin, r.end) for r in suffix_dedup.repeated_passages(spark, docs(spark)).collect())
    want = Counter((i, a, b) for (i, _), (_, pos) in zip(TEXTS, brute.covered([t for _, t in TEXTS], 50)) for a, b in brute.runs(pos))
    assert got == want and want


@pytest.mark.parametrize("length,gram", [(35, 16), (12, 5)])
def test_substring_dedup(spark, length, gram):
    out = substring_dedup.dedup_substrings(spark, docs(spark), length, gram).collect()
    got = Counter((r.doc_id, r.n_words, r.n_removed, r.kept) for r in out)
    want = Counter((i, len(w), len(pos), " ".join(x for p, x in enumerate(w) if p not in pos))
                   for (i, _), (w, pos) in zip(TEXTS, brute.covered([t for _, t in TEXTS], length)))
    assert got == want
    assert all(f.b - f.a >= length for r in out for f in r.factors)


def test_suffix_dedup_random(spark):
    """Short alphabets give passages that overlap, nest and continue in many ways."""
    for seed in range(3):
        r = random.Random(seed)
        parts = [" ".join(r.choice("ab") + str(r.randrange(6)) for _ in range(r.randrange(3, 30))) for _ in range(25)]
        texts = [(i, " ".join(r.choice(parts) for _ in range(12))) for i in range(40)]
        got = {(x.doc_id, x.begin, x.end) for x in suffix_dedup.repeated_passages(spark, docs(spark, texts), 20, 8).collect()}
        assert got == {(i, a, b) for (i, _), (_, pos) in zip(texts, brute.covered([t for _, t in texts], 20)) for a, b in brute.runs(pos)}
        got = {(x.doc_id, x.n_removed) for x in substring_dedup.dedup_substrings(spark, docs(spark, texts), 20, 8).collect()}
        assert got == {(i, len(pos)) for (i, _), (_, pos) in zip(texts, brute.covered([t for _, t in texts], 20))}


def jaccard_want(texts, n, percent):
    group, sizes = brute.jaccard_groups([t for _, t in texts], n, percent)
    ids = defaultdict(list)
    for (i, _), g in zip(texts, group):
        ids[g].append(i)
    least = {g: min((x for x in v if x is not None), default=None) for g, v in ids.items()}
    return Counter((i, s, least[g]) for (i, _), s, g in zip(texts, sizes, group))


@pytest.mark.parametrize("n,percent", [(4, 85), (5, 80)])
def test_jaccard_join(spark, n, percent):
    got = jaccard_join.jaccard_components(spark, docs(spark), n, percent).collect()
    assert Counter((r.doc_id, r.n_shingles, r.component_id) for r in got) == jaccard_want(TEXTS, n, percent)


def test_jaccard_join_large_groups(spark, monkeypatch):
    """Groups cut into many leaves: near copies of a few bases, some near the limit."""
    texts = [(i, edited(prose(150, i % 3), 12 + i % 40, i)) for i in range(120)]
    inner = jaccard_join.linked_components
    refine = jaccard_join.refined_groups
    monkeypatch.setattr(jaccard_join, "linked_components", lambda *a, **k: inner(*a, leaf_docs=7, leaf_tokens=2000, leaders=3))
    monkeypatch.setattr(jaccard_join, "refined_groups", lambda *a, **k: refine(*a, group_docs=5, leaf_docs=9))
    for percent in (60, 75, 85):
        got = jaccard_join.jaccard_components(spark, docs(spark, texts), 3, percent).collect()
        assert Counter((r.doc_id, r.n_shingles, r.component_id) for r in got) == jaccard_want(texts, 3, percent)


def test_tree_pruning_loses_nothing():
    import numpy as np
    r = np.random.default_rng(1)
    base = [r.integers(0, 2**63, 200).astype(np.uint64) for _ in range(4)]
    sets = [np.unique(np.concatenate([base[i % 4][:int(r.integers(100, 200))], r.integers(0, 2**63, int(r.integers(0, 40))).astype(np.uint64)])) for i in range(90)]
    links = jaccard_join.tree_links(list(range(90)), sets, [0] * 90, 70)
    parent = list(range(90))
    for a, b in links:
        parent = [parent[a] if p == parent[b] else p for p in parent]
    want = list(range(90))
    for i in range(90):
        for j in range(i):
            o = len(np.intersect1d(sets[i], sets[j]))
            if 100 * o >= 70 * (len(sets[i]) + len(sets[j]) - o):
                want = [want[i] if p == want[j] else p for p in want]
    assert [[a == b for b in parent] for a in parent] == [[a == b for b in want] for a in want]


def test_decontaminate(spark):
    items = [(1, " ".join(BASE.split()[20:45])), (2, "the OF and"), (3, None), (4, ""), (5, "ONE"), (None, "one"), (5, "one"), (6, " ".join(LONG.split()[29_000:29_012]))]
    frame = spark.createDataFrame(items, "item_id long, text string").withColumn("i", F.lit(1))
    want = Counter((i, *x[:2], tuple(x[2])) for (i, _), x in zip(TEXTS, brute.decontaminated([t for _, t in TEXTS], [x for x in items if x[0] is not None])))
    for words in (2_000_000, 20):                         # one slice of the benchmark, and several
        out = decontaminate.decontaminate(spark, docs(spark), frame, slice_words=words).collect()
        assert Counter((r.doc_id, r.n_words, r.n_hit, tuple(r["items"])) for r in out) == want
    out = decontaminate.decontaminate(spark, docs(spark), frame.limit(0)).collect()
    assert len(out) == len(TEXTS) and not any(r.contaminated for r in out)


def test_decontaminate_rows_without_ids(spark):
    """Rows of one id (or none) and one length are judged each, with one slice of the benchmark and with several."""
    leak, clean = prose(40, 31), prose(40, 32)
    texts = [(None, leak), (None, clean), (None, leak), (7, clean), (7, leak), (7, None), (7, "")]
    frame = spark.createDataFrame([(i, " ".join(leak.split()[i:i + 12])) for i in range(8)], "item_id long, text string")
    want = Counter((i, *x[:2], tuple(x[2])) for (i, _), x in zip(texts, brute.decontaminated([t for _, t in texts], frame.collect())))
    for words in (2_000_000, 20):
        out = decontaminate.decontaminate(spark, docs(spark, texts), frame, slice_words=words).collect()
        assert Counter((r.doc_id, r.n_words, r.n_hit, tuple(r["items"])) for r in out) == want
        assert sum(r.contaminated for r in out) == 3


def test_decontaminate_items_without_ids(spark):
    leak = prose(40, 33).split()
    items = [(None, " ".join(leak[:12])), (None, " ".join(leak[12:24])), (1, " ".join(leak[20:30])), (None, None), (None, "")]
    frame = spark.createDataFrame(items, "item_id long, text string")
    texts = [(1, " ".join(leak[:15])), (2, " ".join(leak)), (3, prose(30, 34))]
    for words in (2_000_000, 5):
        out = decontaminate.decontaminate(spark, docs(spark, texts), frame, slice_words=words).collect()
        assert {r.doc_id: (r.n_hit, r["items"], r.contaminated) for r in out} == {1: (12, [], True), 2: (30, ["1"], True), 3: (0, [], False)}


def test_decontaminate_slices_are_bounded(spark, monkeypatch):
    """One item id (or none) with all rows does not land in one slice."""
    made = []
    init = decontaminate._Slice.__init__
    monkeypatch.setattr(decontaminate._Slice, "__init__", lambda self, items, *rest: made.append(items) or init(self, items, *rest))
    words = LONG.split()
    rows = [(None if i % 2 else 1, " ".join(words[20 * i:20 * i + 12])) for i in range(120)]
    texts = [(1, " ".join(words[:200])), (2, prose(50, 35))]
    most = 4 * 200
    out = decontaminate.decontaminate(spark, docs(spark, texts), spark.createDataFrame(rows + rows, "item_id long, text string"), slice_words=200).collect()
    assert {r.doc_id: (r.n_hit, r["items"]) for r in out} == {1: (120, ["1"]), 2: (0, [])}
    assert max(sum(len(t) for _, t in items) for items in made) <= most
    assert Counter(x for items in made for x in map(tuple, items)) == Counter((i and str(i), t) for i, t in set(rows))


def test_line_dedup(spark):
    texts = [*TEXTS, *[(100 + i, f"own {i}\n Shared LINE \x0b\n\nÄ end {i % 2}\t\r\n{'ten' if i < 10 else 'x'}\nlast") for i in range(12)], (100, "shared line"), (None, "SHARED line\n")]
    out = line_dedup.dedup_lines(spark, docs(spark, texts), cols=["doc_id", "text"]).collect()
    assert Counter((r.doc_id, r.n_lines, r.n_dropped, r.text or "") for r in out) == Counter((i, *x) for (i, _), x in zip(texts, brute.dropped_lines([t for _, t in texts])))
    again = line_dedup.dedup_lines(spark, docs(spark, texts), batches=9, fanout=2, cols=["doc_id", "text"]).collect()
    assert Counter(map(tuple, again)) == Counter(map(tuple, out))


def test_mixing(spark):
    texts = [(i, prose(rng.randrange(1, 60), i)) for i in range(200)]
    frame = docs(spark, [*TEXTS, *texts]).withColumn("source", F.when(F.col("doc_id") % 7 == 0, F.lit(None)).otherwise(F.concat(F.lit("é"), (F.col("doc_id") % 5).cast("string"))))
    out = mixing.mix(spark, frame, bucket_rows=20).collect()
    size, taken, target = Counter(), Counter(), {}
    for r in out:
        size[r.source] += r.size
        taken[r.source] += r.taken
        target[r.source] = r.target
        assert 0 <= r.taken <= 2 * r.size
    want = brute.water_fill(size)
    assert target == pytest.approx(want)
    assert all(taken[s] == int(want[s] + 1e-9) for s in want)
    assert Counter((r.doc_id, r.size) for r in out) == Counter((i, len(brute.spaced(t))) for i, t in [*TEXTS, *texts])
    again = mixing.mix(spark, frame.repartition(5), bucket_rows=10_000)
    assert Counter((r.doc_id, r.size, r.taken) for r in again.collect()) == Counter((r.doc_id, r.size, r.taken) for r in out)
    order = mixing.training_order(again).collect()
    assert sum(r.words for r in order) == sum(taken.values()) and [r.finish for r in order] == sorted(r.finish for r in order)


def test_mixing_is_the_global_queue_cut_at_time_one(spark):
    texts = [(i, prose(rng.randrange(1, 60), i)) for i in range(150)]
    out = mixing.mix(spark, docs(spark, texts), bucket_rows=10).collect()
    queue = sorted((r.finish + e * r.source_size / r.target, r.source, r.doc_id, r.size, r.target) for r in out for e in range(2) if r.size)
    taken, cut = Counter(), set()
    for finish, source, doc, size, target in queue:
        if finish <= 1:
            taken[doc] += size
        elif source not in cut:                               # the copy that straddles the cut
            cut.add(source)
            taken[doc] += max(0, size - round(finish * target) + int(target))
    assert taken == Counter({r.doc_id: r.taken for r in out})


def test_bm25(spark):
    own = [t for t in TEXTS if t[0] is not None and t != (5, BASE)] + [(30 + i, prose(30 + i, i % 9)) for i in range(60)]
    queries = own[1::4]
    for shard, common in ((8192, 0.05), (16, 0.4), (5, 0.0)):
        out = bm25_search.top_k(spark, docs(spark, own), docs(spark, queries), k=4, shard_docs=shard, common=common, block_terms=700).collect()
        got = defaultdict(list)
        for r in sorted(out, key=lambda r: r["rank"]):
            got[r.query_id].append((r.score, r.doc_id))
        want = {q: best for q, best in brute.bm25(queries, own, 4) if best}
        assert {q: [i for _, i in x] for q, x in got.items()} == {q: [i for _, i in x] for q, x in want.items()}
        assert all(got[q][j][0] == pytest.approx(want[q][j][0], abs=2e-4) for q in want for j in range(len(want[q])))


URLS = [None, "", "no scheme", "http://a.NET/x?y", "https://Example.net/en/1#z", "http://example.net/en", "http://net/", "http://planet/", "x://s.example.com/de/?a", "x://org/fr/",
        "x://a.org/fr/q/://", "http://example.net", "http://.net/", "a\nb://b.net/q", "http://example.net/EN/", "http://é.net/en/"]


def test_bm25_sums_many_queries_at_once(monkeypatch):
    """A run of queries is one sum over their postings, however the runs are cut, and equals term by term sums."""
    import numpy as np
    texts = [prose(30, i) for i in range(90)] + [None, ""]
    part = pa.RecordBatch.from_arrays([pa.array(range(len(texts))), pa.array([0] * len(texts)), pa.array(texts)], ["id", "rk", "text"])
    row = next(bm25_search._shards(4096)([part]))
    df = next(bm25_search._shard_df([row])).to_pandas()
    terms = next(bm25_search._query_terms([part.slice(0, 40)])).to_pandas().merge(df, on="term")
    q = bm25_search.QueryBlock(terms, len(texts), 30.0, 1.0, 3)
    shard = bm25_search.Shard({c: row.column(c)[0].as_py() for c in ("terms", "first", "docs", "tf", "size")} | {"ids": row.column("ids")[0].values}, q)
    want = np.zeros((len(q), shard.n))
    for i in range(len(q)):
        for e in range(q.rare_first[i], q.rare_first[i + 1]):
            at = int(np.flatnonzero(shard.terms == q.rare_term[q.rare_place[e]])[0])
            some = slice(shard.first[at], shard.first[at + 1])
            want[i, shard.docs[some]] += shard.impact[some] * q.rare_weight[e]
    real, calls = np.bincount, []
    monkeypatch.setattr(np, "bincount", lambda *a, **k: calls.append(1) or real(*a, **k))
    for run, most in ((1 << 16, 1), (500, len(q)), (1, len(q))):
        monkeypatch.setattr(bm25_search, "RUN", run)
        calls.clear()
        assert np.allclose(shard._rare(q, 0, len(q)), want, rtol=1e-12, atol=0) and len(calls) <= most
        assert np.allclose(shard._rare(q, 7, 19), want[7:19], rtol=1e-12, atol=0)
        calls.clear()


def test_bm25_query_blocks_are_bounded(spark, monkeypatch):
    made = []
    init = bm25_search.QueryBlock.__init__
    monkeypatch.setattr(bm25_search.QueryBlock, "__init__", lambda self, rows, *rest: made.append(len(rows)) or init(self, rows, *rest))
    texts = [(2 ** 60 + i, prose(2 + 25 * (i % 3), 50 + i)) for i in range(60)] + [(None, prose(30, 49))]
    whole = bm25_search.top_k(spark, docs(spark, texts), docs(spark, texts), k=3).collect()
    assert len(made) == 1 and {r.query_id for r in whole} == {i for i, _ in texts}
    parts = bm25_search.top_k(spark, docs(spark, texts), docs(spark, texts), k=3, block_terms=120).collect()
    assert Counter(map(tuple, parts)) == Counter(map(tuple, whole))
    assert max(made[1:]) <= 120 and sum(made[1:]) == made[0]


def test_bm25_very_long_query():
    """Documents that tie exactly all stay, however far the single precision sums are off."""
    n, terms, r = 24, 100_000, np.random.default_rng(1)
    tf = np.stack([r.permutation(np.arange(terms) % 40 + 1) for _ in range(n)], axis=1).astype(np.int32)       # term x document
    row = {"ids": None, "terms": np.arange(terms, dtype=np.uint64).tobytes(), "first": (np.arange(terms + 1) * n).astype(np.int64).tobytes(),
           "docs": np.tile(np.arange(n, dtype=np.int32), terms).tobytes(), "tf": tf.tobytes(), "size": tf.sum(0).astype(np.int32).tobytes()}
    rows = pd.DataFrame({"id": 1, "rk": 1, "term": np.arange(terms), "qtf": 3, "df": n})
    q = bm25_search.QueryBlock(rows, 10 * n, float(tf.sum(0).mean()), 0.05, 2)
    (_, found, score), = bm25_search.Shard(row, q).search(q, 0, 1)
    assert found.tolist() == list(range(n)) and len(set(score)) == 1


def test_url_filter(spark):
    rows = [(i // 2, u) for i, u in enumerate([*URLS, *URLS])] + [(None, URLS[3])]
    pages = spark.createDataFrame(rows, "page_id long, url string").withColumn("key", F.lit(1)).withColumn("host", F.lit("h")).withColumn("_m", F.lit(1))
    rules = spark.createDataFrame(url_filter.RULES, "action string, host string, path string")
    out = url_filter.filter_urls(spark, pages, rules).collect()
    assert Counter(map(tuple, out)) == Counter((i, *brute.judged(u)) for i, u in rows)
    assert {r.verdict for r in url_filter.filter_urls(spark, pages, rules.limit(0)).collect()} == {"allow"}
    many = url_filter.RULES + [("block", f"h{i}.example.org", "/" * (i % 3 + 1)) for i in range(500)]
    out = url_filter.filter_urls(spark, pages, spark.createDataFrame(many, "action string, host string, path string")).collect()
    assert Counter(map(tuple, out)) == Counter((i, *brute.judged(u, many)) for i, u in rows)


def test_bloom_filter_is_a_filter(spark):
    keys = spark.range(3000).select(F.concat(F.lit("k"), "id").alias("key"))
    f, blocks = url_filter.bloom_filter(keys, 3000)
    ok = lambda df: df.withColumn("f", f.scalar()).where(url_filter.probe(F.col("f"), blocks, F.col("key"))).count()
    assert ok(keys) == 3000
    assert ok(spark.range(3000).select(F.concat(F.lit("other"), "id").alias("key"))) < 60


PAGES = [(1, "http://a/ b", "same"), (2, None, "same"), (2, None, "same"), (3, "u", None), (4, "u", ""), (5, "u", "Grüße\r\n\r\n" * 4), (None, "u", "same"), (None, "v", "alone"), (6, "w", "x" * 300_000)]


@pytest.mark.parametrize("zip64,archive_bytes,least", [(False, 1 << 28, 0), (True, 200, 0), (True, 1 << 28, 5)])
def test_warc_round_trip(spark, zip64, archive_bytes, least):
    pages = spark.createDataFrame(PAGES, "page_id long, url string, html string").withColumn("digest", F.lit(1)).withColumn("payload", F.lit(2))
    manifest = warc.write_archives(spark, pages, scratch_path(spark, "warc-test"), min_revisit_bytes=least, archive_bytes=archive_bytes, zip64=zip64)
    got = Counter((r.id, r.record_type, r.refers_to, r.payload_bytes, None if r.payload is None else bytes(r.payload)) for r in warc.read_archives(spark, manifest, range_bytes=100).collect())
    want = Counter()
    for i, _, html in PAGES:
        raw = (html or "").encode()
        top = max((j for j, _, h in PAGES if (h or "") == (html or "") and j is not None), default=None)
        revisit = i != top and len(raw) >= least
        want[(None if i is None else str(i), "revisit" if revisit else "response", str(top) if revisit else None, len(raw), None if revisit else raw)] += 1
    assert got == want
    assert warc.read_archives(spark, warc.write_archives(spark, pages.limit(0), scratch_path(spark, "warc-empty"))).count() == 0


def test_archives_are_plain_zip_files(spark, tmp_path):
    import gzip
    import zipfile
    pages = spark.createDataFrame(PAGES, "page_id long, url string, html string")
    for zip64 in (False, True):
        manifest = warc.write_archives(spark, pages.coalesce(1), f"file://{tmp_path}/z{zip64}", zip64=zip64).collect()
        z = zipfile.ZipFile(manifest[0].path.removeprefix("file://"))
        assert z.testzip() is None and sorted(z.namelist()) == sorted([warc.DATA, warc.INDEX])
        assert gzip.decompress(z.read(warc.DATA)).count(b"WARC/1.1\r\n") == manifest[0].records


def test_zip_directory_errors():
    with pytest.raises(ValueError):
        warc.zip_members(lambda a, n: b"\0" * n, 500)


def test_language_id(spark):
    d = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    d = d.unionByName(docs(spark, extra=[]).withColumn("lang", F.lit(None).cast("string"))).withColumn("score", F.lit(1)).withColumn("x", F.lit(1))
    model = language_id.train(d.where(~language_id.held_out(F.col("doc_id"))))
    out = language_id.predict(spark, d, model, id_cols=["doc_id", "lang", "text"]).collect()
    assert len(out) == d.count() and all(0 <= r.score <= 1 for r in out)
    held = [r for r in out if r.lang and zlib.crc32(str(r.doc_id).encode()) % 3 == 1]
    assert sum(r.lang == r.lang_pred for r in held) / len(held) > 0.98
    for r in out:
        assert (r.lang_pred == "und") == (not any(c.isalpha() for c in r.text or ""))
    nothing = language_id.train(d.limit(0))
    assert {r.lang_pred for r in language_id.predict(spark, d.limit(9), nothing, id_cols=["doc_id"]).collect()} == {"und"}
    single = language_id.train(d.where("lang = 'fr'"))
    assert {r.lang_pred for r in language_id.predict(spark, d.where("lang = 'de'"), single, id_cols=["doc_id"]).collect()} == {"fr"}


def test_language_id_is_fitted_in_a_task(spark, monkeypatch):
    """pipeline: feature rows and their Gram matrix stay off the driver, which gets the weights only; these solve the ridge."""
    rows = [(i, "ab"[i % 2], f"{prose(8, i)} {'xyz'[i % 2] * 9}") for i in range(40)]
    d = spark.createDataFrame(rows, "doc_id long, lang string, text string")
    solve = np.linalg.solve
    with monkeypatch.context() as m:
        m.setattr(np.linalg, "solve", lambda *a: pytest.fail("solved on the driver"))
        m.setattr(type(d), "toArrow", lambda *a: pytest.fail("feature rows on the driver"))
        model = language_id.train(d, sample_rows=80, dim=64, ridge=0.05)
    x = language_id.features(pa.array([t for _, _, t in rows]), 64).astype(np.float32).astype(float)
    y = model.code[[model.languages.index(lang) for _, lang, _ in rows]]
    assert np.allclose(model.weights, x.T @ solve(x @ x.T + 0.05 * np.eye(40), y), atol=1e-6) and model.code.shape[1] == 1


def test_language_id_keeps_every_language(spark):
    """Languages whose share of the sample is a row or two, and rows without ids, are in the model; the sample is bounded."""
    rows = [(i if i % 2 else None, f"l{i % 60}", f"{prose(8, i)} l{i % 60}") for i in range(6000)]
    model = language_id.train(spark.createDataFrame(rows, "doc_id long, lang string, text string"), sample_rows=60, dim=64)
    assert model.languages == sorted({x for _, x, _ in rows})


@pytest.mark.parametrize("k", [2, 4, 6, 9, 40])
def test_codewords_are_apart(k):
    code = language_id.codewords(k)
    near = min(int((code[i] != code[j]).sum()) for i in range(k) for j in range(i))
    assert near >= max(1, code.shape[1] // 4)


def test_empty_tables(spark):
    none = docs(spark).limit(0)
    assert suffix_dedup.repeated_passages(spark, none).count() == 0
    assert substring_dedup.dedup_substrings(spark, none).count() == 0
    assert jaccard_join.jaccard_components(spark, none).count() == 0
    assert jaccard_join.one_of_each(spark, none).columns == none.columns
    assert line_dedup.dedup_lines(spark, none, counts=False).columns == none.columns
    assert mixing.mix(spark, none).count() == 0
    assert bm25_search.top_k(spark, none, none).count() == 0
    assert bm25_search.top_k(spark, docs(spark), none).count() == 0


def test_factors_of_equal_rows_grow_with_their_number(spark):
    """Every copy lists the factors of one: four times the rows, four times the factors."""
    text = prose(120, 77)
    total = {}
    for copies in (5, 20):
        out = substring_dedup.dedup_substrings(spark, docs(spark, [(None, text)] * copies + [(1, prose(50, 78))])).collect()
        assert all(r.n_removed == (120 if r.doc_id is None else 0) for r in out)
        total[copies] = sum(len(r.factors) for r in out)
    assert total[20] == 4 * total[5] > 0


def test_archives_of_one_payload_in_half_of_the_pages(spark):
    pages = spark.createDataFrame([(i, "http://a", "same" if i % 2 else str(i)) for i in range(200)], "page_id long, url string, html string")
    folder = scratch_path(spark, "warc-split")
    manifest = warc.write_archives(spark, pages, folder)
    assert sum(r.records for r in manifest.collect()) == 200

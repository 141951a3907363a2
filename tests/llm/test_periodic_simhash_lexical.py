"""Periodic runs, SimHash groups, ranked lexical search and components against plain Python."""

import random
from collections import Counter, defaultdict

import brute
import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F
from test_edges import EXTRA, LONG, TEXTS, WORDS, docs, edited, prose

from caliper.llm import lexical_search, periodic_runs, simhash_dedup
from caliper.llm.components import components, least_labels
from caliper.llm.queries import QUERIES
from caliper.llm.words import SPACED, split_words

SF = "/root/testdata/sf0.001"


def periodic_text(seed):
    """Short alphabets and repeated pieces: runs that touch, nest and share words."""
    r, parts = random.Random(seed), []
    for _ in range(r.randrange(1, 6)):
        unit = [r.choice("abc") for _ in range(r.randrange(1, 9))]
        parts += (unit * 8)[:r.randrange(1, 60)] if r.random() < .7 else [r.choice("ab") for _ in range(r.randrange(20))]
    return " ".join(parts)


def test_runs_of_random_texts():
    for seed in range(150):
        texts = [periodic_text(seed * 10 + i) for i in range(8)]
        doc, start, length, period = periodic_runs.text_runs(split_words(pa.array(texts), SPACED), 6, 4)
        for i, t in enumerate(texts):
            assert [(s, n, q) for d, s, n, q in zip(doc, start, length, period) if d == i] == brute.periodic_runs(t.split())


def test_long_period_and_small_batches(monkeypatch):
    monkeypatch.setattr(periodic_runs, "BATCH", 50)
    unit = prose(700, 3).split()
    texts = [" ".join(unit * 4), " ".join(unit * 4 + unit[:3]), " ".join((unit * 4)[:-1]), "x", "a b " * 9, " ".join(unit[:100] * 5 + ["z"] * 7)]
    doc, start, length, period = periodic_runs.text_runs(split_words(pa.array(texts), SPACED), 6, 4)
    got = list(zip(doc.tolist(), start.tolist(), length.tolist(), period.tolist()))
    assert got == [(0, 0, 2800, 700), (1, 0, 2803, 700), (4, 0, 18, 2), (5, 0, 500, 100), (5, 500, 7, 1)]


def test_wavelet_tree():
    r = np.random.default_rng(1)
    for n in (1, 2, 7, 64, 200):
        values = r.permutation(n)
        tree = periodic_runs.WaveletTree(values)
        lo = r.integers(0, n, 100)
        hi = lo + r.integers(0, n - lo + 1)
        x = r.integers(0, n, 100)
        below = tree.below(lo, hi, x)
        assert below.tolist() == [int((values[a:b] < y).sum()) for a, b, y in zip(lo, hi, x)]
        some = hi > lo
        j = r.integers(0, np.maximum(hi - lo, 1))
        assert tree.smallest(lo[some], hi[some], j[some]).tolist() == [int(np.sort(values[a:b])[i]) for a, b, i in zip(lo[some], hi[some], j[some])]


def test_runs_need_four_periods(spark):
    with pytest.raises(ValueError):
        periodic_runs.collapse_runs(docs(spark), times=3)


def test_collapse_edges(spark):
    texts = TEXTS + [(40, "Na na na na na na na, hey"), (41, "x\ny\tx y x y x y z"), (41, "x\ny\tx y x y x y z"), (42, "a " * 6 + "b " * 5)]
    out = periodic_runs.collapse_runs(docs(spark, texts), id_cols=("doc_id", "id", "n", "row")).collect()
    got = Counter((r.doc_id, r.n_words, tuple(map(tuple, r.runs)), r.kept) for r in out)
    want = Counter()
    for i, t in texts:
        w = brute.spaced(t)
        runs = brute.periodic_runs(w) if len(w) < 5000 else []
        drop = {p for s, n, q in runs for p in range(s + q, s + n)}
        want[i, len(w), tuple(runs), " ".join(x for p, x in enumerate(w) if p not in drop)] += 1
    assert got == want and all(r.id == r.n == r.row == 7 for r in out)
    assert periodic_runs.collapse_runs(docs(spark, [])).count() == 0


def test_op11_against_brute(spark):
    rows = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()
    got = {tuple(r) for r in QUERIES["op11_periodic_runs"](spark, SF).select(
        "doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256").collect()}
    short = {r.doc_id for r in rows if len(r.text or "") < 20_000}
    assert {x for x in got if x[0] in short} == {brute.op11(r.doc_id, r.text) for r in rows if r.doc_id in short}
    assert len(got) == len(rows) and sum(x[1] > 0 for x in got) > 10


def groups_of(rows):
    out = defaultdict(list)
    for i, g in rows:
        out[g].append(i)
    return out


@pytest.mark.parametrize("n,bucket", [(3, 512), (5, 8)])
def test_simhash_edges(spark, n, bucket):
    texts = TEXTS + [(50 + i, edited(LONG, 5000 + 37 * i, i)) for i in range(12)] + [(80, "one two"), (81, " ONE  two "), (82, "one")]
    got = simhash_dedup.simhash_components(spark, docs(spark, texts), n=n, bucket=bucket).collect()
    prints = [brute.simhash(t, n) for _, t in texts]
    group = brute.simhash_groups(prints)
    ids = groups_of((i, g) for (i, _), g in zip(texts, group))
    least = {g: min((x for x in v if x is not None), default=None) for g, v in ids.items()}
    assert Counter((r.doc_id, r.fp & (1 << 64) - 1, r.component_id) for r in got) == Counter((i, p, least[g]) for (i, _), p, g in zip(texts, prints, group))
    assert len(set(prints)) > len(least)                     # some links are between different fingerprints
    assert simhash_dedup.simhash_components(spark, docs(spark, [])).count() == 0


def test_bucket_is_not_too_small(spark):
    with pytest.raises(ValueError):
        simhash_dedup.simhash_components(spark, docs(spark), bucket=7)


def test_simhash_only_null_ids(spark):
    assert [r.component_id for r in simhash_dedup.simhash_components(spark, docs(spark, [(None, "a b"), (None, "a b")])).collect()] == [None, None]


def test_close_fingerprints_in_split_buckets(spark, bucket=8):
    """Clusters of many close fingerprints: buckets are split again and again, and no link is lost."""
    r, prints = random.Random(5), set()
    for _ in range(6):
        x = r.getrandbits(64)
        for _ in range(60):
            prints.add(x)
            y = x
            for b in r.sample(range(64), r.choice([1, 2, 3, 3, 4])):
                y ^= 1 << b
            x = y if r.random() < .5 else x
            prints.add(y)
    prints = sorted(prints)
    classes = spark.createDataFrame([(p - (1 << 64) if p >> 63 else p,) for p in prints], "fp long")
    comp = {r.v & (1 << 64) - 1: r.c & (1 << 64) - 1 for r in components(simhash_dedup.close_edges(spark, classes, 3, bucket)).collect()}
    got, want = {}, {}
    for p, g in zip(prints, brute.simhash_groups(prints)):
        got.setdefault(comp.get(p, p), set()).add(p)
        want.setdefault(g, set()).add(p)
    assert sorted(map(sorted, got.values())) == sorted(map(sorted, want.values()))


def test_op12_against_brute(spark):
    rows = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()
    prints = [brute.simhash(r.text, 3) for r in rows]
    ids = groups_of((r.doc_id, g) for r, g in zip(rows, brute.simhash_groups(prints)))
    least = {i: min(v) for v in ids.values() for i in v}
    got = {tuple(r) for r in QUERIES["op12_simhash_dedup"](spark, SF).select("doc_id", "fingerprint", "component_id").collect()}
    assert got == {(r.doc_id, f"{p:016x}", least[r.doc_id]) for r, p in zip(rows, prints)}


@pytest.mark.parametrize("local", [0, 10_000])
def test_components(spark, local):
    r = random.Random(2)
    edges = [(r.randrange(400), r.randrange(400)) for _ in range(250)] + [(1000 + i, 1001 + i) for i in range(200)] + [(2000, 2000 + i) for i in range(300)]
    v, c = least_labels(*np.array(edges).T)
    got = {(x.v, x.c) for x in components(spark.createDataFrame(edges, "a long, b long").repartition(7), local).collect()}
    assert got == {(a, b) for a, b in zip(v.tolist(), c.tolist()) if a != b}
    assert components(spark.createDataFrame([], "a long, b long"), local).count() == 0


ITEMS = [(1, "the of Über w1 w2 w2"), (2, None), (3, ""), (4, "zzz-unknown"), (None, "w3 W4 the"), (5, prose(30, 11)), (5, "w7 w8 the of"), (6, " ".join(WORDS)), (1, "the of Über w1 w2 w2"),
         (7, "the")]


@pytest.mark.parametrize("k,shard,block", [(10, 4096, 500_000), (3, 5, 500_000), (10, 7, 4)])
def test_lexical_search(spark, monkeypatch, k, shard, block):
    monkeypatch.setattr(lexical_search, "BLOCK", 4)
    texts = TEXTS + [(100 + i, prose(5 + i % 40, i)) for i in range(60)] + [(200 + i, "the of w1 W1") for i in range(9)] + [(None, "w3 w4")]
    items = spark.createDataFrame(ITEMS, "item_id long, text string").select("*", *[F.lit(1).alias(c) for c in EXTRA])
    out = lexical_search.rank_documents(spark, docs(spark, texts), items, k=k, shard_docs=shard, block_terms=block).collect()
    got = defaultdict(list)
    for r in sorted(out, key=lambda r: r["rank"]):
        got[r.item_id].append((r["rank"], r.score, r.doc_id))
    want = defaultdict(list)
    for i, found in brute.lexical(dict.fromkeys(ITEMS), texts, k):
        want[i] += [(n + 1, s, d) for n, (s, d) in enumerate(found)]
    assert {i: Counter(v) for i, v in got.items()} == {i: Counter(v) for i, v in want.items() if v}


def test_lexical_search_empty(spark):
    items = spark.createDataFrame(ITEMS, "item_id long, text string")
    assert lexical_search.rank_documents(spark, docs(spark, []), items).count() == 0
    assert lexical_search.rank_documents(spark, docs(spark), items.limit(0)).count() == 0


def test_lexical_bounds_skip_blocks():
    """A rare match far ahead makes later blocks of common terms unnecessary."""
    n = 40 * lexical_search.BLOCK
    texts = pa.array(["rare rarer the", *("the of and" if i % 2 else "the other" for i in range(n - 1))])
    batch = pa.RecordBatch.from_arrays([pa.array(range(n)), texts], ["id", "text"])
    row = next(iter(lexical_search._shards(n, n, 3 * n)([batch])))
    shard_row = {c: row.column(c)[0].as_py() for c in lexical_search.LISTS} | {"ids": row.column("ids")[0].values}
    words = split_words(pa.array(["rare the"]), lexical_search.TERMS).hash
    import pandas as pd
    block = lexical_search.ItemBlock(pd.DataFrame({"id": [1, 1], "rk": [0, 0], "term": words.view(np.int64), "df": [1, n]}), n)
    best = lexical_search.Best(1)
    visited = lexical_search.Shard(shard_row, block).search(block.term, block.weight, best)
    assert best.rows[0][2] == 0 and visited == 1

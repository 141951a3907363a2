"""Language ID with error-correcting output codes.

Every language gets a codeword of +1/-1 bits; one linear classifier per bit is
trained on hashed byte n-grams (bigrams and trigrams of the lower-cased text,
square-rooted counts of unit length) and predicts that bit.  A text's bit
margins are decoded by loss weighting: the codeword with the smallest summed
``exp(-bit * margin)`` wins, its share among all codewords is the score, and a
small gap to the second codeword flags the text as ambiguous.

Training sample: labelled rows chosen by a hash of id and text, ``sample_rows``
in all at most and equally many per language (all rows of a language that has
fewer); only their feature rows
(``dim`` numbers each) meet in one task, whose memory is bounded by
``sample_rows * (dim + sample_rows)`` whatever the corpus.  The classifiers are ridge
regressions solved at once in the sample's Gram matrix there; the driver gets their weights.
Prediction is a map-only pass over whole texts; the broadcast model has ``dim * bits`` numbers.

Defined results: a null text or one without a letter is ``und`` with score 0;
with one learned language every other text gets it; with none every text is
``und``; repeated rows are predicted each.
"""

from __future__ import annotations

import itertools
import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from caliper.llm.words import opened, slices

UND = "und"
#: ASCII letters lower-cased, other ASCII bytes as one space, other bytes as they are
_FOLD = np.full(256, 0x20, np.uint8)
_FOLD[0x41:0x5B] = np.arange(0x61, 0x7B)
_FOLD[0x61:0x7B] = np.arange(0x61, 0x7B)
_FOLD[0x80:] = np.arange(0x80, 0x100)


@dataclass
class Model:
    languages: list[str]
    code: np.ndarray       # languages x bits, +1 or -1
    weights: np.ndarray    # dim x bits
    dim: int


def codewords(k: int, seed: int = 5) -> np.ndarray:
    """k codewords: all distinct non-constant columns up to six languages, else the best of many random codes."""
    if k < 2:
        return np.ones((k, 0))
    if k <= 6:
        cols = [(1, *c) for c in itertools.product((1, -1), repeat=k - 1) if -1 in c]
        return np.array(cols, float).T
    bits, rng, best = math.ceil(10 * math.log2(k)), np.random.default_rng(seed), None
    for _ in range(500):
        c = rng.choice([-1.0, 1.0], (k, bits))
        near = int(((bits - c @ c.T) / 2 + bits * np.eye(k)).min())
        if (best is None or near > best[0]) and (np.abs(c.sum(0)) < k).all():
            best = (near, c)
    return best[1]


def features(texts: pa.Array, dim: int) -> np.ndarray:
    """Unit-length square roots of hashed n-gram counts, a row a text."""
    texts = texts.fill_null("").cast(pa.large_string())
    n = len(texts)
    off = np.frombuffer(texts.buffers()[1], np.int64, n + 1, texts.offset * 8)
    raw = texts.buffers()[2]
    b = _FOLD[np.frombuffer(raw, np.uint8)[off[0]:off[-1]]].astype(np.int64) if raw is not None else np.empty(0, np.int64)
    size = np.diff(off)
    row = np.repeat(np.arange(n) * dim, size)
    left = np.repeat(off[1:] - off[0], size) - np.arange(len(b))          # bytes left in the text, this one included
    counts = np.zeros(n * dim)
    for k, mult in ((2, (40503, 9973)), (3, (60493, 25253, 7919))):
        m = len(b) - k + 1
        if m <= 0:
            continue
        h = sum(b[i:i + m] * f for i, f in enumerate(mult)) + k * 1013904223
        h = ((h * 2654435761) >> 13) % dim
        ok = left[:m] >= k
        counts += np.bincount((row[:m] + h)[ok], minlength=n * dim)
    x = np.sqrt(counts.reshape(n, dim))
    norm = np.sqrt((x * x).sum(1, keepdims=True))
    return x / np.where(norm > 0, norm, 1)


def _rows(batch: pa.RecordBatch, text_col: str, most: int = 100) -> Iterator[pa.RecordBatch]:
    """Slices whose features, and the bytes' numbers they are counted from, take few MB (some 80 bytes a text byte)."""
    for part in slices(batch, text_col, 500_000):
        for a in range(0, part.num_rows, most):
            yield part.slice(a, most)


def _feature_rows(text_col: str, dim: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in _rows(batch, text_col):
                x = features(part.column(text_col), dim).astype(np.float32)
                yield pa.RecordBatch.from_arrays([part.column("lang"), pa.array([r.tobytes() for r in x], pa.binary())], ["lang", "x"])
    return run


def _fit(dim: int, ridge: float):
    """All feature rows, in an order of their own -> the languages found and the weights of the bits of their codewords."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = pa.Table.from_batches(batches, pa.schema([("lang", pa.string()), ("x", pa.binary())]))
        table = table.take(pc.sort_indices(table, [("lang", "ascending"), ("x", "ascending")])).combine_chunks()
        rows = table.column("lang").to_pylist()
        langs = sorted(set(rows))
        code = codewords(len(langs))
        weights = np.zeros((dim, 0))
        if len(langs) > 1:
            x = np.empty((len(rows), dim))
            for i, r in enumerate(table.column("x")):
                x[i] = np.frombuffer(r.as_buffer(), np.float32)
            del table
            at = {lang: i for i, lang in enumerate(langs)}
            gram = x @ x.T
            gram[np.diag_indices(len(x))] += ridge
            weights = x.T @ np.linalg.solve(gram, code[[at[r] for r in rows]])
        yield pa.RecordBatch.from_arrays([pa.array([langs], pa.list_(pa.string())), pa.array([weights.tobytes()], pa.binary())],
                                         ["languages", "weights"])
    return run


def train(docs: DataFrame, sample_rows: int = 2400, dim: int = 4096, ridge: float = 0.05, id_col: str = "doc_id",
          text_col: str = "text", lang_col: str = "lang") -> Model:
    """Fit on labelled rows of ``docs`` (null texts and languages are left out)."""
    docs = docs.where(F.col(text_col).isNotNull() & F.col(lang_col).isNotNull())
    counts = {r.lang: r.n for r in docs.groupBy(F.col(lang_col).alias("lang")).agg(F.count(F.lit(1)).alias("n")).collect()}
    langs = sorted(counts)
    if len(langs) > sample_rows:
        raise ValueError(f"{len(langs)} languages for a sample of {sample_rows} rows")
    if not langs:
        return Model([], np.ones((0, 0)), np.zeros((dim, 0)), dim)
    quota = sample_rows // len(langs)
    # twice the quota and some more pass the coin (all rows of a small language); the quota is what has the smallest hashes
    share = {x: min(1.0, (2 * quota + 50) / counts[x]) for x in langs}
    key = F.xxhash64(F.col(id_col), F.col(text_col), F.lit("sample"))
    place = F.pmod(key, F.lit(1 << 30)) / F.lit(float(1 << 30))
    limit = F.element_at(F.create_map(*[F.lit(v) for x in langs for v in (x, share[x])]), F.col(lang_col))
    some = docs.where(place < limit).select(F.col(lang_col).alias("lang"), F.col(text_col).alias("text"), place.alias("place"), key.alias("key"))
    nth = F.row_number().over(Window.partitionBy("lang").orderBy("place", "key", "text"))
    sample = some.withColumn("nth", nth).where(F.col("nth") <= quota).select("lang", "text")
    rows = sample.mapInArrow(_feature_rows("text", dim), "lang string, x binary")
    fitted = rows.repartition(1).mapInArrow(_fit(dim, ridge), "languages array<string>, weights binary").collect()
    langs = list(fitted[0].languages) if fitted else []
    code = codewords(len(langs))
    weights = np.frombuffer(fitted[0].weights).reshape(dim, -1) if code.size else np.zeros((dim, 0))
    return Model(langs, code, weights, dim)


def decode(model: Model, x: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Best language of each row, its share, and the share of the runner-up."""
    if model.code.shape[1] == 0:
        return np.zeros(len(x), int), np.ones(len(x)), np.zeros(len(x))
    margin = np.clip(x @ model.weights, -4, 4)
    loss = np.exp(-margin[:, None, :] * model.code[None, :, :]).sum(2)          # rows x languages
    share = np.exp(loss.min(1, keepdims=True) - loss)
    share /= share.sum(1, keepdims=True)
    order = np.argsort(-share, axis=1, kind="stable")
    i = np.arange(len(x))
    return order[:, 0], share[i, order[:, 0]], share[i, order[:, 1]]


def _has_letter(text: str | None) -> bool:
    return text is not None and any(c.isalpha() for c in text)


def _predictor(model, id_cols: list[str], text_col: str, gap: float, within: str | None = None):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m: Model = model.value
        for batch in opened(batches, text_col, within):
            for part in _rows(batch, text_col):
                known = np.array([bool(m.languages) and _has_letter(t) for t in part.column(text_col).to_pylist()], bool)
                best, score, second = (decode(m, features(part.column(text_col), m.dim)) if m.languages
                                       else (np.zeros(part.num_rows, int), np.zeros(part.num_rows), np.zeros(part.num_rows)))
                lang = [m.languages[b] if k else UND for b, k in zip(best.tolist(), known.tolist())]
                yield pa.RecordBatch.from_arrays(
                    [*[part.column(c) for c in id_cols], pa.array(lang), pa.array(np.where(known, np.clip(score, 0, 1), 0.0)),
                     pa.array(known & (score - second < gap))], [*id_cols, "lang_pred", "score", "ambiguous"])
    return run


def predict(spark: SparkSession, docs: DataFrame, model: Model, gap: float = 0.1, text_col: str = "text",
            id_cols: list[str] | None = None, within: str | None = None) -> DataFrame:
    """``id_cols`` of every row with ``lang_pred, score, ambiguous``.

    The text may be a field of a struct among ``id_cols``, ``within``; it then goes to the Python workers once, in there.
    """
    id_cols = id_cols or [c for c in docs.columns if c != text_col]
    d = docs.select(*dict.fromkeys([*id_cols, *([] if within else [text_col])]))
    schema = T.StructType([d.schema[c] for c in id_cols]).add("lang_pred", "string").add("score", "double").add("ambiguous", "boolean")
    return d.mapInArrow(_predictor(spark.sparkContext.broadcast(model), id_cols, text_col, gap, within), schema)


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string")) % 3 == 1, F.lit(False))


def op5_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text", "lang")
    model = train(docs.where(~held_out(F.col("doc_id"))))
    return predict(spark, docs.select("doc_id", "text"), model, id_cols=["doc_id"]).select(
        "doc_id", held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score", "ambiguous")

"""Scalar text functions (X1-X25) as Column expressions.

Everything here stays inside whole-stage codegen: regular expressions,
``translate`` and higher-order array functions, no Python per row.
Regexes use only classes that Java (Spark) and RE2 (the SQL oracle) read
alike: Python's Unicode ``\\s`` and ``\\w`` are spelled out as explicit
classes, and there is no ``\\b`` next to non-ASCII text.
"""

from __future__ import annotations

import string
import unicodedata
from functools import lru_cache
from typing import Iterable

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from caliper.functions.stopwords import ENGLISH, topic_stops

# Python's str whitespace (str.isspace) as an explicit class body.
WS = r"\t\n\x0B\f\r\x1C-\x1F\x85\p{Z}"
# Python's Unicode word character (letters, numbers, underscore).
WORD = r"\p{L}\p{N}_"
# Python's string.punctuation followed by string.digits.
PUNCT_DIGITS = string.punctuation + string.digits
HEADER_NAMES = "from|subject|organization|lines|nntp-posting-host"


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


# X1
def lower(c) -> Column:
    return F.lower(_c(c))


# Tags to empty string; '.' stops at '\n' only, as in Python ('(?d)' = UNIX_LINES).
def strip_html(c) -> Column:
    return F.regexp_replace(_c(c), r"(?d)<.*?>", "")


# Keep ASCII letters and whitespace; accented letters are removed, not mapped.
def keep_ascii_letters(c) -> Column:
    return F.regexp_replace(_c(c), f"[^a-zA-Z{WS}]", "")


# Collapse whitespace runs to one space; ``trim`` strips the ends.
def collapse_whitespace(c, trim: bool = True) -> Column:
    out = F.regexp_replace(_c(c), f"[{WS}]+", " ")
    return F.trim(out) if trim else out


# Non-word characters (Unicode sense) to a space.
def non_word_to_space(c) -> Column:
    return F.regexp_replace(_c(c), f"[^{WORD}]", " ")


# E-mail addresses, then URLs, then header lines, each to a space.
def strip_email_artifacts(c) -> Column:
    nws = f"[^{WS}]"
    out = F.regexp_replace(_c(c), f"{nws}+@{nws}+", " ")
    out = F.regexp_replace(out, f"http{nws}+|www\\.{nws}+", " ")
    return F.regexp_replace(out, f"(?imd)^({HEADER_NAMES}):.*$", " ")


# Punctuation and ASCII digits to spaces.
def punct_digits_to_space(c) -> Column:
    return F.translate(_c(c), PUNCT_DIGITS, " " * len(PUNCT_DIGITS))


# Whitespace tokenisation, empty pieces dropped.
def whitespace_tokens(c) -> Column:
    return F.filter(F.split(_c(c), f"[{WS}]+"), lambda t: t != F.lit(""))


# Maximal runs of word characters.
def word_tokens(c) -> Column:
    return F.regexp_extract_all(_c(c), F.lit(f"[{WORD}]+"), F.lit(0))


# X11: vectorizer token patterns.
def vectorizer_tokens(c, pattern: str = "default") -> Column:
    """``default``: runs of >= 2 word characters; ``letters3``: runs of >= 3 ASCII letters only."""
    toks = word_tokens(c)
    if pattern == "default":
        return F.filter(toks, lambda t: F.length(t) >= 2)
    if pattern == "letters3":
        return F.filter(toks, lambda t: t.rlike("^[a-zA-Z]{3,}$"))
    raise ValueError(f"unknown token pattern {pattern!r}")


# X12
def min_length(tokens, n: int = 3) -> Column:
    return F.filter(_c(tokens), lambda t: F.length(t) >= n)


# Keeps duplicates and order (array_except would not).
def remove_stopwords(tokens, stops: Iterable[str] = ENGLISH) -> Column:
    stops = list(dict.fromkeys(stops))
    return F.filter(_c(tokens), lambda t: ~t.isin(stops))


def explode_tokens(df, keep, tokens, alias: str = "term", pos: str | None = None):
    """One row per token (optionally with its 0-based position).

    Uses the outer generator plus a NULL filter: for a plain ``explode`` Spark
    infers a ``size(tokens) > 0`` pre-filter, which, with the projection
    collapsed into it, would run the whole tokenising expression twice per row.
    """
    keep = list(keep)
    if pos:
        x = df.select(*keep, F.posexplode_outer(_c(tokens)).alias(pos, alias))
    else:
        x = df.select(*keep, F.explode_outer(_c(tokens)).alias(alias))
    return x.where(F.col(alias).isNotNull())


# X17
def join_tokens(tokens, sep: str = " ") -> Column:
    return F.array_join(_c(tokens), sep)


# Length in code points.
def char_length(c) -> Column:
    return F.length(_c(c))


# X19
def word_count(c) -> Column:
    return F.size(whitespace_tokens(c))


def _joiner(fields):
    # a one-argument lambda: Spark passes the element index to two-argument ones
    return lambda s: F.concat_ws(" ", *[s[f] for f in fields])


# N-grams in sklearn's order: all n-grams of the smallest n first, by position.
def ngrams(tokens, n_min: int = 1, n_max: int = 1) -> Column:
    """n-grams as ``arrays_zip`` of n shifted slices.

    The token expression is an argument of ``slice`` (evaluated n times per
    row), never referenced inside a lambda, where Spark would re-evaluate it
    for every element.
    """
    t = _c(tokens)
    parts = []
    for n in range(n_min, n_max + 1):
        if n == 1:
            parts.append(t)
            continue
        length = F.greatest(F.size(t) - F.lit(n - 1), F.lit(0))
        z = F.arrays_zip(*[F.slice(t, k, length).alias(f"g{k}") for k in range(1, n + 1)])
        parts.append(F.transform(z, _joiner([f"g{k}" for k in range(1, n + 1)])))
    return parts[0] if len(parts) == 1 else F.concat(*parts)


# Strip accents (NFKD, combining marks dropped), over all of Unicode.
@F.pandas_udf(T.StringType())
def _strip_accents(texts: pd.Series) -> pd.Series:
    strip = lambda t: None if t is None else "".join(x for x in unicodedata.normalize("NFKD", t) if not unicodedata.combining(x))
    return texts.map(strip)


def strip_accents(c) -> Column:
    """Compatibility decomposition without combining marks.

    Spark has no normalisation function, so texts with non-ASCII characters go
    through an Arrow-batched UDF; all-ASCII texts stay as they are.
    """
    c = _c(c)
    ascii_only = F.length(c) == F.octet_length(c)
    return F.when(ascii_only, c).otherwise(_strip_accents(F.when(~ascii_only, c)))


# X22
def text_or_empty(c) -> Column:
    return F.coalesce(_c(c).cast("string"), F.lit(""))


# X24: "A & B" from the two top words, title-cased, else a fallback name.
def topic_name(words, fallback: str = "General Topic") -> Column:
    w = _c(words)
    return F.when(F.size(w) >= 2,
                  F.concat_ws(" & ", F.initcap(F.element_at(w, 1)), F.initcap(F.element_at(w, 2)))
                  ).otherwise(F.lit(fallback))


def keyword_split(c, sep: str = ",") -> Column:
    return F.filter(F.transform(F.split(_c(c), sep), lambda t: F.trim(t)), lambda t: t != F.lit(""))


# Argmax (first wins), 0-based.
def argmax(arr) -> Column:
    a = _c(arr)
    return (F.array_position(a, F.array_max(a)) - 1).cast("int")


def linspace(start: float, stop: float, num: int) -> Column:
    step = (stop - start) / (num - 1)
    return F.transform(F.sequence(F.lit(0), F.lit(num - 1)), lambda i: F.lit(start) + i * F.lit(step))


# Composite cleaners ------------------------------------------------------
def clean_sentiment(c, remove_stops: bool = True, stops: Iterable[str] = ENGLISH) -> Column:
    """lower -> strip tags -> ASCII letters -> collapse/trim -> tokens -> stop words (array)."""
    t = collapse_whitespace(keep_ascii_letters(strip_html(lower(c))), trim=True)
    toks = whitespace_tokens(t)
    return remove_stopwords(toks, stops) if remove_stops else toks


def clean_spam(c, trim: bool = False) -> Column:
    """lower -> non-word to space -> collapse whitespace (string)."""
    return collapse_whitespace(non_word_to_space(lower(c)), trim=trim)


def clean_topic(c, lowercase: bool = True, remove_stops: bool = True, min_token_len: int = 3,
                stops: Iterable[str] | None = None) -> Column:
    """text-or-empty -> e-mail artefacts -> punctuation/digits -> lower -> tokens -> length -> stops (array).

    Lemmatisation (X15) is a join against a lemma table, see
    :func:`caliper.operators.textjobs.map_tokens`; the second stop-word pass
    (X16) follows it there.
    """
    stops = topic_stops() if stops is None else stops
    t = punct_digits_to_space(strip_email_artifacts(text_or_empty(c)))
    if lowercase:
        t = lower(t)
    toks = min_length(whitespace_tokens(t), min_token_len)
    return remove_stopwords(toks, stops) if remove_stops else toks

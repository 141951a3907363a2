"""Vectorised word splitting and hashing of Arrow string columns, used inside tasks.

Texts are handled as UTF-8 bytes: both word classes of this subpackage are
decided by ASCII bytes alone (every byte of a longer character is a word
byte), so splitting bytes equals splitting code points.  Hashes are 64-bit
polynomials over bytes (words) or word hashes (n-grams), taken from running
sums, so a batch costs a few numpy passes whatever the window length.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

_P, _Q1, _Q2 = 0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0xD6E8FEB86659FD93   # odd multipliers
_MASK = (1 << 64) - 1
_powers: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def _byte_class(separators: list[int]) -> np.ndarray:
    t = np.ones(256, bool)
    t[separators] = False
    return t


#: ``[^\x20\x09-\x0D]+``
SPACED = _byte_class([0x20, *range(0x09, 0x0E)])
#: ``[^\x00-\x2F\x3A-\x60\x7B-\x7F]+`` over text whose A-Z are lower-cased
ALNUM = _byte_class([*range(0x00, 0x30), *range(0x3A, 0x61), *range(0x7B, 0x80)])
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[0x41:0x5B] += 32


def _power_table(base: int, n: int) -> tuple[np.ndarray, np.ndarray]:
    """``base**i`` and its inverse modulo 2**64 for i < n."""
    have = _powers.get(base)
    if have is None or len(have[0]) < n:
        size = max(1 << 16, 1 << (n - 1).bit_length())
        out = []
        for b in (base, pow(base, -1, 1 << 64)):
            a = np.full(size, b, np.uint64)
            a[0] = 1
            out.append(np.multiply.accumulate(a))
        _powers[base] = have = (out[0], out[1])
    return have[0][:n], have[1][:n]


def mix64(h: np.ndarray) -> np.ndarray:
    """A bijective finaliser that spreads all bits."""
    h = h ^ (h >> np.uint64(30))
    h = h * np.uint64(0xBF58476D1CE4E5B9)
    h ^= h >> np.uint64(27)
    h *= np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def _running(values: np.ndarray, base: int) -> tuple[np.ndarray, np.ndarray]:
    """Running sums of ``values[i] * base**i`` (one longer) and the inverse powers."""
    power, inverse = _power_table(base, len(values) + 1)
    total = np.zeros(len(values) + 1, np.uint64)
    np.cumsum(values * power[:-1], out=total[1:])
    return total, inverse


@dataclass
class Words:
    """Words of a batch of texts; ``first[d]:first[d + 1]`` are those of text ``d``."""

    data: np.ndarray     # bytes of the batch, A-Z lower-cased if asked for
    start: np.ndarray    # first byte of each word
    end: np.ndarray      # one past its last byte
    first: np.ndarray    # first word of each text, and the number of words
    hash: np.ndarray     # 64-bit hash of each word

    def count(self) -> np.ndarray:
        return np.diff(self.first)

    def doc(self) -> np.ndarray:
        """The text of each word."""
        return np.repeat(np.arange(len(self.first) - 1), self.count())

    def ngrams(self, n: int, second: bool = False) -> tuple[np.ndarray, np.ndarray]:
        """Hash of the n words that begin at each word, and whether they lie in one text."""
        m = len(self.hash) - n + 1
        if m <= 0:
            return np.empty(0, np.uint64), np.empty(0, bool)
        total, inverse = _running(self.hash, _Q2 if second else _Q1)
        h = mix64((total[n:] - total[:-n]) * inverse[:m] + np.uint64(n))
        last = np.repeat(self.first[1:], self.count())[:m]
        return h, np.arange(m) + n <= last

    def spans(self, at: np.ndarray, length: np.ndarray, second: bool = False) -> np.ndarray:
        """Hash of ``length`` words from each word index ``at``."""
        total, inverse = _running(self.hash, _Q2 if second else _Q1)
        return mix64((total[at + length] - total[at]) * inverse[at] + length.astype(np.uint64))

    def bytes(self, i: int, j: int, sep: bytes = b" ") -> bytes:
        """Words ``i:j`` joined."""
        raw = self.data
        return sep.join([raw[a:b].tobytes() for a, b in zip(self.start[i:j], self.end[i:j])])

    def spaced(self, i: int, j: int) -> bytes:
        """``bytes(i, j)`` of words of the class SPACED, whose separators are those of ``bytes.split``."""
        return b" ".join(self.data[self.start[i]:self.end[j - 1]].tobytes().split()) if j > i else b""


def split_words(texts: pa.Array, word_bytes: np.ndarray, lower: bool = False) -> Words:
    texts = texts.fill_null("").cast(pa.large_string())
    n = len(texts)
    off = np.frombuffer(texts.buffers()[1], np.int64, n + 1, texts.offset * 8)
    raw = texts.buffers()[2]
    data = np.frombuffer(raw, np.uint8)[off[0]:off[-1]] if raw is not None else np.empty(0, np.uint8)
    off = off - off[0]
    if lower:
        data = _LOWER[data]
    inside = word_bytes[data]
    edge = np.zeros(len(data) + 1, bool)
    edge[off] = True                                     # a text's first byte begins a word, whatever came before
    begins, ends = inside.copy(), inside.copy()
    begins[1:] &= ~inside[:-1] | edge[1:-1]
    ends[:-1] &= ~inside[1:] | edge[1:-1]
    start, end = np.flatnonzero(begins), np.flatnonzero(ends) + 1
    total, inverse = _running(data.astype(np.uint64) + np.uint64(1), _P)
    h = mix64((total[end] - total[start]) * inverse[start] + (end - start).astype(np.uint64))
    return Words(data, start, end, np.searchsorted(start, off), h)


def slices(batch: pa.RecordBatch, text: str, limit: int = 3_000_000) -> Iterator[pa.RecordBatch]:
    """Cut a batch into runs of rows of about ``limit`` text bytes (a longer text is a run of its own)."""
    size = pc.fill_null(pc.binary_length(batch.column(text)), 0).to_numpy(zero_copy_only=False).astype(np.int64)
    run = (np.cumsum(size) - size) // limit
    cuts = [0, *(np.flatnonzero(np.diff(run)) + 1).tolist(), batch.num_rows]
    for a, b in zip(cuts, cuts[1:]):
        if b > a:
            yield batch.slice(a, b - a)


def opened(batches: Iterator[pa.RecordBatch], text: str, within: str | None) -> Iterator[pa.RecordBatch]:
    """Batches with the field ``text`` of their struct column ``within`` as a column too, uncopied (no ``within``: as they are)."""
    for batch in batches:
        yield batch if within is None else batch.append_column(text, pc.struct_field(batch.column(within), text))


def first_minimum(h: np.ndarray, width: int) -> np.ndarray:
    """For each i, the index of the first smallest of ``h[i:i + width]`` (for the i that have so many)."""
    value, index, cover = h, np.arange(len(h)), 1
    while cover < width:
        step = min(cover, width - cover)
        a, b = value[:-step], value[step:]
        less = b < a
        value, index = np.where(less, b, a), np.where(less, index[step:], index[:-step])
        cover += step
    return index


def signed(h: np.ndarray) -> np.ndarray:
    return h.view(np.int64)


def multi_arange(start: np.ndarray, length: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """All ``start[i] + 0 .. length[i] - 1`` in a row, and the i of each."""
    owner = np.repeat(np.arange(len(start)), length)
    ends = np.cumsum(length)
    return np.arange(int(ends[-1]) if len(ends) else 0) - np.repeat(ends - length, length) + np.repeat(start, length), owner


def packed(sizes: list[tuple[int, int]], most: int) -> list[tuple[int, int]]:
    """Ranges (first, last) of consecutive buckets ``(bucket, size)`` of at most ``most`` together, or of one bucket."""
    out, total = [], 0
    for bucket, size in sorted(sizes):
        if out and total + size <= most:
            out[-1] = (out[-1][0], bucket)
            total += size
        else:
            out.append((bucket, bucket))
            total = size
    return out

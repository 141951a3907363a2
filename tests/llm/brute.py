"""Plain Python versions of the operators, for small inputs."""

import hashlib
import math
import re
import zlib
from collections import Counter, defaultdict
from fractions import Fraction

import xxhash

SPACED = re.compile(r"[^\x20\x09-\x0D]+")
ALNUM = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
LOW = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def spaced(text, lower=False):
    return SPACED.findall((text or "").translate(LOW) if lower else (text or ""))


def alnum(text):
    return ALNUM.findall((text or "").translate(LOW))


def sha(x):
    return hashlib.sha256(x.encode()).hexdigest()


def covered(texts, length):
    """Per text: its words, and the set of words inside repeated windows."""
    words = [spaced(t) for t in texts]
    seen = Counter(tuple(w[i:i + length]) for w in words for i in range(len(w) - length + 1))
    return [(w, {p for i in range(len(w) - length + 1) if seen[tuple(w[i:i + length])] > 1 for p in range(i, i + length)}) for w in words]


def runs(positions):
    out = []
    for p in sorted(positions):
        if out and p == out[-1][1]:
            out[-1][1] = p + 1
        else:
            out.append([p, p + 1])
    return [tuple(x) for x in out]


def shingles(text, n):
    w = spaced(text, True)
    return {tuple(w[i:i + n]) for i in range(max(1, len(w) - n + 1))} if w else set()


def jaccard_groups(texts, n, percent):
    """A group number for each text."""
    sets = [shingles(t, n) for t in texts]
    group = list(range(len(texts)))
    for i, a in enumerate(sets):
        for j in range(i):
            o = len(a & sets[j])
            if a and sets[j] and 100 * o >= percent * (len(a) + len(sets[j]) - o) and group[i] != group[j]:
                old, new = group[i], group[j]
                group = [new if g == old else g for g in group]
    return group, [len(s) for s in sets]


def decontaminated(texts, items, window=10):
    """Per text: words, words hit, items found."""
    wins = defaultdict(set)
    for i, t in items:
        w = alnum(t)
        for k in range(max(1, len(w) - window + 1) if w else 0):
            wins[tuple(w[k:k + window])].add(str(i))
    out = []
    for t in texts:
        w, hit, ids = alnum(t), set(), set()
        for win, who in wins.items():
            for k in range(len(w) - len(win) + 1):
                if tuple(w[k:k + len(win)]) == win:
                    hit.update(range(k, k + len(win)))
                    ids |= who
        out.append((len(w), len(hit), sorted(ids)))
    return out


def line_key(line):
    return line.strip(" \t\n\x0b\x0c\r").translate(LOW)


def dropped_lines(texts, least=10):
    """Per text: lines, lines dropped, what is left."""
    lines = [(t or "").split("\n") for t in texts]
    df = Counter(k for ls in lines for k in {line_key(x) for x in ls} if k)
    out = []
    for ls in lines:
        kept = [x for x in ls if df[line_key(x)] < least or not line_key(x)]
        out.append((len(ls), len(ls) - len(kept), "\n".join(kept)))
    return out


def water_fill(size, weights=(3, 1, 2), share=1.5, most=2):
    """Targets by repeated resharing: ``size`` maps source -> words."""
    order = sorted(size, key=lambda s: (s is None, s if s is not None else ""))
    w = {s: weights[i % len(weights)] for i, s in enumerate(order)}
    target, open_, left = {}, set(order), share * sum(size.values())
    while open_:
        level = left / sum(w[s] for s in open_)
        full = {s for s in open_ if level * w[s] >= most * size[s]}
        if not full:
            target |= {s: level * w[s] for s in open_}
            break
        for s in full:
            target[s] = float(most * size[s])
            left -= most * size[s]
        open_ -= full
    return target


def bm25(queries, docs, k):
    """``queries``, ``docs``: (id, text) pairs; per query its best (id, score)."""
    words = [(i, Counter(alnum(t))) for i, t in docs]
    n, mean = len(docs), sum(sum(c.values()) for _, c in words) / max(1, len(docs))
    df = Counter(t for _, c in words for t in c)
    out = []
    for q, text in queries:
        score = []
        for i, c in words:
            dl = sum(c.values())
            s = sum(qtf * math.log(1 + (n - df[t] + .5) / (df[t] + .5)) * c[t] * 2.2 / (c[t] + 1.2 * (.25 + .75 * dl / mean))
                    for t, qtf in Counter(alnum(text)).items() if c[t])
            if s > 0:
                score.append((round(s, 4), i))
        out.append((q, sorted(score, key=lambda x: (-x[0], x[1]))[:k]))
    return out


RULES = [("block", "net", "/"), ("allow", "example.net", "/en/"), ("block", "example.com", "/de/"), ("allow", "org", "/fr/")]


def judged(url, rules=RULES):
    m = re.match(r"(?s)^.*?://([^/?#]*)([^?#]*)", url or "")
    host, path = (m[1].translate(LOW), m[2]) if m else ("", "")
    fits = [(len(h + p), h + p, a) for a, h, p in rules if (host == h or host.endswith("." + h)) and path.startswith(p)]
    best = max(fits, default=None)
    return host, path, best and best[1], best[2] if best else "allow"


def periodic_runs(w, least=6, times=4):
    """``(start, length, period)`` of the runs of the words ``w``, by start, then period."""
    out = []
    for q in range(1, len(w) // times + 1):
        i = 0
        while i + q < len(w):
            if w[i] != w[i + q]:
                i += 1
                continue
            s = i
            while i + q < len(w) and w[i] == w[i + q]:
                i += 1
            x = w[s:i + q]
            if len(x) >= max(least, times * q) and not any(all(a == b for a, b in zip(x, x[r:])) for r in range(1, q)):
                out.append((s, len(x), q))
    return sorted(out, key=lambda r: (r[0], r[2]))


def with_periodic_end(doc_id, words):
    h, n = zlib.crc32(str(doc_id).encode()) if doc_id is not None else 1, len(words)
    if h % 10 or not n:
        return words
    a = h // 10 % n
    p = 1 + (n - a) // (3 + h // 10 % 8)
    return [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]


def op11(doc_id, text):
    w = with_periodic_end(doc_id, spaced(text))
    runs = periodic_runs(w)
    drop = {i for s, n, q in runs for i in range(s + q, s + n)}
    best = max(runs, key=lambda x: (Fraction(x[1], x[2]), -x[0], -x[2]), default=None)
    return (doc_id, len(runs), *((*best, 1000 * best[1] // best[2]) if best else (None,) * 4), sha("".join(f"{s},{n},{q}\n" for s, n, q in runs)),
            sha(" ".join(x for i, x in enumerate(w) if i not in drop)))


def simhash(text, n):
    w = spaced(text, True)
    h = [xxhash.xxh64_intdigest(" ".join(w[i:i + n]).encode(), 42) for i in range(max(1, len(w) - n + 1))] if w else []
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def simhash_groups(prints, differ=3):
    group = list(range(len(prints)))
    for i, a in enumerate(prints):
        for j in range(i):
            if (a ^ prints[j]).bit_count() <= differ and group[i] != group[j]:
                old, new = group[i], group[j]
                group = [new if g == old else g for g in group]
    return group


TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def lexical(items, docs, k):
    """``items``, ``docs``: (id, text) pairs; per item its best (score, id)."""
    terms = [(i, Counter(x.translate(LOW) for x in TERM.findall(t or ""))) for i, t in docs]
    n, total = sum(1 for _, c in terms if c), sum(sum(c.values()) for _, c in terms)
    df = Counter(t for _, c in terms for t in c)
    out = []
    for q, text in items:
        found = []
        for i, c in terms:
            m = 10 + 90 * sum(c.values()) * n // max(total, 1)
            s = sum(math.floor(1000 * math.log((2 * n + 2) / (2 * df[t] + 1))) * (10 ** 9 * c[t] // (1000 * c[t] + 8 * m))
                    for t in {x.translate(LOW) for x in TERM.findall(text or "")} if c[t])
            if s > 0:
                found.append((s, i))
        out.append((q, sorted(found, key=lambda x: (-x[0], x[1] is None, x[1] or 0))[:k]))
    return out

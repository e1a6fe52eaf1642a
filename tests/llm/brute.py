"""Plain versions of the operators, for comparison."""

from __future__ import annotations

import hashlib
import re
import zlib
from collections import Counter, defaultdict
from fractions import Fraction

import numpy as np

WS = " \t\n\x0b\x0c\r"
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def words(text):
    return [w for w in re.split(r"[\x20\x09-\x0D]+", text or "") if w]


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def drop_lines(texts, least):
    """[(lines, dropped, kept text)] in the order of the texts."""
    key = lambda line: line.strip(WS).translate(LOWER)
    split = [(t or "").split("\n") for t in texts]
    found = Counter(k for lines in split for k in {key(x) for x in lines} if k)
    out = []
    for lines in split:
        kept = [x for x in lines if found[key(x)] < least]
        out.append((len(lines), len(lines) - len(kept), "\n".join(kept)))
    return out


class Groups:
    def __init__(self, n):
        self.up = list(range(n))

    def root(self, x):
        while self.up[x] != x:
            x = self.up[x]
        return x

    def join(self, a, b):
        a, b = self.root(a), self.root(b)
        self.up[max(a, b)] = min(a, b)


def smallest(ids, groups):
    """For each row the smallest id of its group; None only where all are null."""
    best = defaultdict(list)
    for i, x in enumerate(ids):
        if x is not None:
            best[groups.root(i)].append(x)
    return [min(best[groups.root(i)], default=None) for i in range(len(ids))]


def near(ids, texts, n, percent):
    """[(shingles, component)] in the order of the rows."""
    sets = []
    for t in texts:
        w = [x.translate(LOWER) for x in words(t)]
        sets.append({tuple(w[i : i + n]) for i in range(len(w) - n + 1)} if len(w) >= n else {tuple(w)} if w else set())
    groups = Groups(len(texts))
    for i, a in enumerate(sets):
        for j in range(i):
            if a and sets[j] and 100 * len(a & sets[j]) >= percent * len(a | sets[j]):
                groups.join(i, j)
    return [(len(s), c) for s, c in zip(sets, smallest(ids, groups))]


def measures(text):
    text = text or ""
    w = words(text)
    grams = [tuple(w[i : i + 3]) for i in range(len(w) - 2)]
    twice = {g for g, k in Counter(grams).items() if k > 1}
    lines = [x for x in text.split("\n") if words(x)]
    return (
        len(w),
        sum(map(len, w)),
        len(re.findall(r"[#*$%&|<>]", text)),
        len(lines) - len(set(lines)),
        len({i + d for i, g in enumerate(grams) if g in twice for d in range(3)}),
    )


def cosine_links(ids, vectors, labels, threshold):
    """[(links, component)] in the order of the rows."""
    def fine(v):
        return v is not None and all(x is not None and np.isfinite(x) for x in v) and any(v)

    groups, links = Groups(len(ids)), [0] * len(ids)
    for i in range(len(ids)):
        for j in range(i):
            if labels[i] is None or labels[i] != labels[j] or not fine(vectors[i]) or not fine(vectors[j]) or len(vectors[i]) != len(vectors[j]):
                continue
            a, b = np.array(vectors[i], float), np.array(vectors[j], float)
            if a @ b / (np.linalg.norm(a) * np.linalg.norm(b)) >= threshold:
                links[i] += 1
                links[j] += 1
                groups.join(i, j)
    return list(zip(links, smallest(ids, groups)))


def spelling(docs, noise, least=7, twice=2, times=10):
    """{word: (n, near words, form, its n, root)} of (doc_id, text)."""
    counts = Counter()
    for doc, text in docs:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = run.translate(LOWER)
            h = zlib.crc32(f"{'' if doc is None else doc}:{run}".encode())
            if noise and h % noise == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            counts[run] += 1
    counts = {w: n for w, n in counts.items() if len(w) >= least and n >= twice}

    def one_edit(a, b):
        if len(a) < len(b):
            a, b = b, a
        if len(a) == len(b):
            return sum(x != y for x, y in zip(a, b)) == 1
        return len(a) == len(b) + 1 and any(a[:i] + a[i + 1 :] == b for i in range(len(a)))

    near_words = {w: [v for v in counts if abs(len(v) - len(w)) < 2 and one_edit(w, v)] for w in counts}
    form = {}
    for w, near_ in near_words.items():
        best = min(near_, key=lambda v: (-counts[v], v), default=None)
        form[w] = best if best and counts[best] >= times * counts[w] else None

    def root(w):
        while form[w]:
            w = form[w]
        return w

    return {w: (n, len(near_words[w]), form[w], counts.get(form[w]), root(w)) for w, n in counts.items()}


def licenses(text, phrases):
    """(words, [(label, place)]) of phrases, by comparing word for word."""
    found = [w.translate(LOWER) for w in re.split(r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", text or "") if w]
    return len(found), [(label, i) for i in range(len(found)) for label, p in phrases if found[i : i + len(p.split())] == p.split()]


def whitened(vectors, components):
    """(n, deviations, explained, whitened without signs) of vectors of one length."""
    x = [[int(np.floor(1024.0 * float(c))) + 100000 for c in v] for v in vectors]
    n, sums = len(x), [sum(c) for c in zip(*x)]
    deviations = [sum((n * c - s) ** 2 for c, s in zip(v, sums)) for v in x]
    centred = np.array([[float(Fraction(n * c - s, n)) for c, s in zip(v, sums)] for v in x])
    covariance = centred.T @ centred / n
    values, axes = np.linalg.eigh(covariance)
    values, axes = values[::-1][:components], axes[:, ::-1][:, :components]
    return n, deviations, values / np.trace(covariance), np.abs(centred @ axes / np.sqrt(values))

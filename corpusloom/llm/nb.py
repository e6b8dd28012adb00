"""Naive Bayes over character n-grams of words: language posteriors of spans of text."""

from __future__ import annotations

import numpy as np
import pyarrow as pa

from corpusloom.llm import textvec as T
from corpusloom.llm.common import LANGS
from corpusloom.llm.seeds import SEEDS

BITS, ORDERS = 17, (1, 2, 3, 4, 5)
SMOOTH = 0.3
#: Of a language that labels claim for a share of the sample, an n-gram needs this many times its smoothed rate to count fully.
ROUNDS = 4
SCRIPT_OF = {"hi": T.S_DEVA, "mr": T.S_DEVA, "hinglish": T.S_LATIN, "en": T.S_LATIN, "bn": T.S_BENG, "ta": T.S_TAML}
_EDGE = 1


def ngram_buckets(c: np.ndarray, start: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Buckets of all n-grams of the words (with an edge mark at both ends), and the word of each, in order of words."""
    n = (end - start).astype(np.int64) + 2
    off = np.cumsum(n) - n
    total = int(n.sum())
    flat = np.full(total, _EDGE, dtype=np.uint64)
    word = np.repeat(np.arange(len(n)), n)
    pos = np.arange(total) - off[word]
    inner = (pos > 0) & (pos < n[word] - 1)
    flat[inner] = c[(start[word] + pos - 1)[inner]]
    buckets, owners = [], []
    h = np.zeros(total, dtype=np.uint64)
    for k in range(1, max(ORDERS) + 1):
        m = total - k + 1
        if m <= 0:
            break
        h = h[:m] * np.uint64(0x9FB21C651E98DF25) + (flat[k - 1 : k - 1 + m] + np.uint64(7)) * np.uint64(0xBF58476D1CE4E5B9)
        if k in ORDERS:
            ok = word[:m] == word[k - 1 : k - 1 + m]
            if k == 1:
                ok = ok & (flat[:m] != _EDGE)
            buckets.append((T.mix(h[ok] + np.uint64(k)) >> np.uint64(64 - BITS)).astype(np.int64))
            owners.append(word[:m][ok])
    b, o = np.concatenate(buckets), np.concatenate(owners)
    return b, o


def word_sums(table: np.ndarray, c: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Sum of ``table``'s rows over the n-grams of each word."""
    out = np.zeros((len(start), table.shape[1]))
    if len(start):
        b, o = ngram_buckets(c, start, end)
        for j in range(table.shape[1]):
            out[:, j] = np.bincount(o, table[b, j], len(start))
    return out


class Spans:
    """Words with a letter of a column slice, grouped by given spans of code points."""

    def __init__(self, x: T.Codes, start: np.ndarray, end: np.ndarray):
        self.words = w = T.words(x)
        self.at, self.inv = w.distinct
        one = w.only(self.at)
        self.has = one.some(one.codes.kind == T.LETTER)[self.inv]
        self.a, self.b = np.searchsorted(w.start, start), np.searchsorted(w.start, end)

    def sums(self, table: np.ndarray) -> np.ndarray:
        """Sum of the n-gram scores of each span's words."""
        w = self.words
        if not len(w):
            return np.zeros((len(self.a), table.shape[1]))
        per = word_sums(table, w.codes.c, w.start[self.at], w.end[self.at])[self.inv] * self.has[:, None]
        s = np.zeros((len(w) + 1, table.shape[1]))
        np.cumsum(per, axis=0, out=s[1:])
        return s[self.b] - s[self.a]

    def counts(self) -> np.ndarray:
        s = np.zeros(len(self.words) + 1, dtype=np.int64)
        np.cumsum(self.has, out=s[1:])
        return s[self.b] - s[self.a]


def fit_table(sp: Spans, to: np.ndarray, classes: int, prior: np.ndarray | None = None) -> np.ndarray:
    """Log probabilities of n-grams by class from spans of class ``to`` (-1: none), less their mean over classes."""
    w = sp.words
    span_of = np.full(len(w), -1, dtype=np.int64)
    for i, (a, b) in enumerate(zip(sp.a.tolist(), sp.b.tolist(), strict=True)):
        span_of[a:b] = to[i]
    counts = np.zeros((1 << BITS, classes))
    if len(w):
        b, o = ngram_buckets(w.codes.c, w.start[sp.at], w.end[sp.at])
        for j in range(classes):
            n = np.bincount(sp.inv[(span_of == j) & sp.has], minlength=len(sp.at)).astype(float)
            counts[:, j] = np.bincount(b, n[o], 1 << BITS)
    if prior is not None:
        counts += prior
    total = counts.sum(axis=0)
    p = np.log(counts + SMOOTH) - np.log(total + SMOOTH * 3e4)
    # Buckets that nothing was seen in say nothing.
    p -= p.mean(axis=1, keepdims=True)
    p[counts.sum(axis=1) == 0] = 0
    return p.astype(np.float32)


def _seed_spans() -> tuple[Spans, np.ndarray]:
    t = [(s, i) for i, x in enumerate(LANGS) for s in SEEDS[x]]
    x = T.folded(T.codes(pa.array([s for s, _ in t])))
    return Spans(x, x.start, x.end), np.array([i for _, i in t])


def train_languages(texts: pa.Array, labels: list[str | None]) -> tuple[np.ndarray, T.Codes, tuple[np.ndarray, np.ndarray, np.ndarray], np.ndarray]:
    """A language table from texts whose labels may be wrong or missing and that may be mixed: labels start it,
    then each sentence of a known script goes to the language its words have together, a few rounds long.
    Also gives the folded texts, their sentences and the language of each sentence (-1: open)."""
    x = T.folded(T.codes(texts))
    start, end, row = T.sentence_spans(x)
    sp = Spans(x, start, end)
    index = {c: i for i, c in enumerate(LANGS)}
    lab = np.array([index.get(v, -1) for v in labels], dtype=np.int64)
    to = lab[row] if len(row) else np.zeros(0, np.int64)
    script = T.take(T.tables()[2], x.c)
    own = np.array([SCRIPT_OF[c] for c in LANGS])
    if len(row):
        n = np.zeros((len(x.c) + 1, 6), dtype=np.int64)
        for s in range(6):
            np.cumsum(script == s, out=n[1:, s])
        main = (n[end] - n[start])[:, 1:].argmax(axis=1) + 1
        to = np.where((to >= 0) & (own[to] == main), to, -1)
        allowed = own[None, :] == main[:, None]
    seed, seed_to = _seed_spans()
    prior = _counts(seed, seed_to) * 3
    words = sp.counts()
    table = fit_table(sp, to, len(LANGS), prior)
    for _ in range(ROUNDS if len(row) else 0):
        s = np.where(allowed, sp.sums(table), -np.inf)
        order = np.sort(s, axis=1)
        gap = order[:, -1] - np.where(np.isfinite(order[:, -2]), order[:, -2], order[:, -1] - 99)
        to = np.where((words > 0) & np.isfinite(order[:, -1]) & (gap > 0.5 * words), s.argmax(axis=1), -1)
        table = fit_table(sp, to, len(LANGS), prior)
    return table, x, (start, end, row), to


def _counts(sp: Spans, to: np.ndarray) -> np.ndarray:
    w = sp.words
    counts = np.zeros((1 << BITS, len(LANGS)))
    b, o = ngram_buckets(w.codes.c, w.start, w.end)
    np.add.at(counts, (b, to[w.row][o]), 1.0)
    return counts

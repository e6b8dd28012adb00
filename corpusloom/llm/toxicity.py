"""Problem 8: abusive, hateful and sexual passages, by a bag of subword embeddings under a linear softmax.

A passage is the mean of the embeddings of its words, word pairs and the character n-grams of its words; embeddings and
softmax are trained jointly, in numpy. Ratings are of documents, so the training also has to find the passages meant:
it starts from all passages of a document rated abusive and then keeps those that score. As the softmax is linear,
a trained model is one number for each feature, and scoring is a mean of looked-up numbers.
"""

from __future__ import annotations

import io
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusloom.llm import textvec as T
from corpusloom.llm.common import shared, table

#: Rated documents the model is fitted on, at most: abusive and harmless ones.
ABUSIVE_ROWS, HARMLESS_ROWS = 2500, 5000
#: Harmless passages of these that are trained on, at most.
HARMLESS_PASSAGES = 40000
BITS, DIMENSIONS, ORDERS = 19, 8, (3, 4, 5)
#: Gradient steps of a round, rounds, step size, decay of embeddings, share of the loss that abusive passages have.
STEPS, ROUNDS, RATE, DECAY, EPSILON, ABUSIVE_SHARE, SEED = 36, 3, 0.05, 1e-7, 1e-7, 0.3, 7
#: A feature counts if so many words or pairs have it. Odds from which the best passage of an abusive document, and any of its passages, is meant.
MIN_SEEN, FIRST_ODDS, SURE_ODDS = 2, 1.6, 2.1
#: Documents' worth of no evidence that every word's odds start from.
SMOOTH = 1.0
#: A passage that scores at least this is abusive. Passages of more words than WINDOW are scored in windows of so many as well.
THRESHOLD, WINDOW = 0.5, 14
#: A passage of fewer words says little: it counts only if the rated documents show one of its words to be abusive by itself, with
#: SURE_ODDS and in so many abusive documents, at least.
SHORT, WORD_SEEN = 3, 5

# Digits and signs written for letters.
_LEET = {"0": "o", "1": "i", "3": "e", "4": "a", "5": "s", "7": "t", "@": "a", "$": "s"}
# Signs put between or over the letters of a word.
_BETWEEN = ".*-_~·•+|/\\#^"
_BREAKS = T.STOPS + "\n\r"

def normal(x: T.Codes) -> T.Codes:
    """Folded codes with disguises undone: letters for leet signs, no signs between letters, no doubled letters, spelled-out words joined."""
    x = T.folded(x)
    c = x.c.copy()
    if not len(c):
        return x
    kinds = T.tables()[1]
    leet = np.zeros(128, dtype=np.uint32)
    for a, b in _LEET.items():
        leet[ord(a)] = ord(b)
    k = T.take(kinds, c)
    letter = (k == T.LETTER) & (c < 128)
    cand = (c < 128) & (leet[np.minimum(c, 127)] > 0)
    if cand.any():
        at = np.flatnonzero(cand)
        for step in range(3):
            # A sign between letters, or before or after one within a word; the last passes reach signs beside signs.
            left = np.zeros(len(at), bool)
            left[at > 0] = letter[at[at > 0] - 1]
            right = np.zeros(len(at), bool)
            inner = at < len(c) - 1
            right[inner] = letter[at[inner] + 1]
            hit = (left & right) if step == 0 else (left | right)
            digit = (c[at] >= 48) & (c[at] < 58)
            if step:
                hit &= left | ~digit  # "4 weeks" and "b4" stay apart: a digit is a letter only after one
            c[at[hit]] = leet[c[at[hit]]]
            letter[at[hit]] = True
            at = at[~hit]
    x = T.Codes(c, x.start, x.end)
    w = T.words(x)
    if len(w) > 1:
        n = w.end - w.start
        gap = w.start[1:] - w.end[:-1]
        same = w.row[1:] == w.row[:-1]
        sign = T.among(c[w.end[:-1]], _BETWEEN) & (gap == 1)
        single = same & (n[1:] == 1) & (n[:-1] == 1) & (gap <= 2)
        # Three or more single letters in a row.
        runs = single.copy()
        runs[1:] |= False
        edge = np.flatnonzero(np.diff(np.concatenate([[False], single, [False]]).astype(np.int8)))
        runs = np.zeros(len(single), bool)
        for a, b in edge.reshape(-1, 2):
            if b - a >= 2:
                runs[a:b] = True
        join = runs | (same & sign & ((c[w.end[:-1]] == ord("*")) | ((n[:-1] <= 3) & (n[1:] <= 3))))
        if join.any():
            drop = np.zeros(len(c) + 1, dtype=np.int64)
            at = np.flatnonzero(join)
            np.add.at(drop, w.end[at], 1)
            np.add.at(drop, w.start[at + 1], -1)
            x = x.keep(np.cumsum(drop[:-1]) == 0)
            c = x.c
    k = T.take(kinds, c)
    twice = np.zeros(len(c), dtype=bool)
    twice[1:] = (c[1:] == c[:-1]) & (k[1:] == T.LETTER)
    return x.keep(~twice) if twice.any() else x


class Passages:
    """Passages of a column of texts with the words of each. A passage ends at stop marks and pictographs, and at line
    breaks unless ``across``: a text may be broken into lines within its sentences."""

    def __init__(self, w: T.Words, across: bool = False):
        self.words, x = w, w.codes
        n = len(w)
        k = T.take(T.tables()[1], x.c)
        stop = T.among(x.c, _BREAKS) | (x.c >= 0x1F000)
        nxt = np.ones(len(x.c), bool)
        nxt[:-1] = (k[1:] == T.SPACE) | stop[1:] | (x.c[1:] == 34)
        brk = np.zeros(len(x.c) + 1, dtype=np.int64)
        line = (x.c == 10) | (x.c == 13)
        brk_at = (stop & nxt & ~line) | (x.c >= 0x1F000)
        if not across:
            brk_at |= line
        np.cumsum(brk_at, out=brk[1:])
        new = np.ones(n, dtype=bool)
        if n:
            new[1:] = (w.row[1:] != w.row[:-1]) | (brk[w.start[1:]] > brk[w.end[:-1]])
        self.first = np.append(np.flatnonzero(new), n)
        self.row = w.row[self.first[:-1]] if n else np.zeros(0, np.int64)
        self.of = np.cumsum(new) - 1
        self.pair_ok = ~new[1:] if n else np.zeros(0, bool)

    def __len__(self) -> int:
        return len(self.first) - 1


def _word_features(w: T.Words, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Buckets of the given words (each word and its character n-grams), with the index of the word of each."""
    c, start, end = w.codes.c, w.start[at], w.end[at]
    n = end - start + 2
    off = np.cumsum(n) - n
    total = int(n.sum())
    word = np.repeat(np.arange(len(n)), n)
    flat = np.full(total, 1, dtype=np.uint64)
    pos = np.arange(total) - off[word]
    inner = (pos > 0) & (pos < n[word] - 1)
    flat[inner] = c[(start[word] + pos - 1)[inner]]
    buckets, owners = [w.hash[at] >> np.uint64(64 - BITS)], [np.arange(len(at))]
    h = np.zeros(total, dtype=np.uint64)
    for k in range(1, max(ORDERS) + 1):
        m = total - k + 1
        if m <= 0:
            break
        h = h[:m] * np.uint64(0x9FB21C651E98DF25) + (flat[k - 1 : k - 1 + m] + np.uint64(7)) * np.uint64(0xBF58476D1CE4E5B9)
        if k in ORDERS:
            ok = word[:m] == word[k - 1 : k - 1 + m]
            buckets.append(T.mix(h[ok] + np.uint64(k)) >> np.uint64(64 - BITS))
            owners.append(word[:m][ok])
    return np.concatenate(buckets).astype(np.int64), np.concatenate(owners)


def _pair_buckets(h: np.ndarray) -> np.ndarray:
    return (T.mix(h[:-1] * np.uint64(0x9FB21C651E98DF25) + h[1:] * np.uint64(0x2545F4914F6CDD1D)) >> np.uint64(64 - BITS)).astype(np.int64)


def words_of(col: pa.Array) -> T.Words:
    return T.words(normal(T.codes(col)))


class Model:
    """One number for each feature, the softmax's bias, and the hashes of words that are abusive by themselves."""

    def __init__(self, weight: np.ndarray, bias: float, words: np.ndarray | None = None):
        self.weight, self.bias, self.words = weight.astype(np.float32), bias, np.zeros(0, np.uint64) if words is None else words

    def to_bytes(self) -> bytes:
        """The model as bytes, to be kept where one training serves many runs."""
        out = io.BytesIO()
        np.savez_compressed(out, weight=self.weight, bias=self.bias, words=self.words)
        return out.getvalue()

    @staticmethod
    def from_bytes(data: bytes) -> Model:
        with np.load(io.BytesIO(data)) as m:
            return Model(m["weight"], float(m["bias"]), m["words"])

    def scores(self, p: Passages) -> np.ndarray:
        """Probability that each passage is abusive."""
        w = p.words
        if not len(w):
            return np.zeros(0)
        _, at, inv = T.unique(w.hash)
        b, o = _word_features(w, at)
        total = np.bincount(o, self.weight[b], len(at))[inv]
        count = np.bincount(o, minlength=len(at)).astype(float)[inv]
        # A pair counts for its second word.
        total[1:] += np.where(p.pair_ok, self.weight[_pair_buckets(w.hash)], 0)
        count[1:] += p.pair_ok
        s, n = np.append(0, np.cumsum(total)), np.append(0, np.cumsum(count))
        a, e = p.first[:-1], p.first[1:]
        out = (s[e] - s[a]) / (n[e] - n[a])
        short = np.flatnonzero(e - a < SHORT)
        if len(short):
            own = np.append(0, np.cumsum(np.isin(w.hash, self.words)))
            out[short[own[e[short]] == own[a[short]]]] = -np.inf
        long = np.flatnonzero(e - a > WINDOW)
        if len(long):
            k = (e - a)[long] - WINDOW + 1
            at = np.cumsum(k) - k
            x = np.arange(k.sum()) + np.repeat(a[long] - at, k)
            out[long] = np.maximum(out[long], np.maximum.reduceat((s[x + WINDOW] - s[x]) / (n[x + WINDOW] - n[x]), at))
        return 1 / (1 + np.exp(-np.clip(out + self.bias, -30, 30)))


def _odds(p: Passages, feature: np.ndarray, of: np.ndarray, docs: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Distinct features, the index of each given one, the log odds of each from the abusive and harmless documents that have it, and how many
    abusive ones do. ``of`` is the passage of each given feature."""
    key, inv = np.unique(feature, return_inverse=True)
    seen = np.unique(inv * np.int64(len(docs)) + p.row[of])
    f, d = seen // len(docs), seen % len(docs)
    pos, neg = np.bincount(f, docs[d], len(key)), np.bincount(f, ~docs[d], len(key))
    # Smoothed towards no evidence: a feature of few documents says little. One that no harmless document has says something even so,
    # as all usual words occur in harmless ones.
    share = (docs.sum() + 1) / (len(docs) + 2)
    return key, inv, np.log((pos + SMOOTH * share) / share) - np.log((neg + SMOOTH * (1 - share)) / (1 - share)), pos


def _evidence(p: Passages, docs: np.ndarray) -> np.ndarray:
    """Mean log odds of each passage's words and pairs."""
    w = p.words
    pair = T.mix(w.hash[:-1] * np.uint64(3) + w.hash[1:])[p.pair_ok]
    of = np.concatenate([p.of, p.of[1:][p.pair_ok]])
    _, inv, odds, _ = _odds(p, np.concatenate([w.hash, pair]), of, docs)
    return np.bincount(of, odds[inv], len(p)) / np.maximum(np.bincount(of, minlength=len(p)), 1)


def train(texts: pa.Array, abusive: np.ndarray) -> Model:
    """From rated documents: 1 abusive, 0 harmless. Where none is rated abusive, nothing scores."""
    rated = abusive.astype(bool)
    p = Passages(words_of(texts))
    doc = rated[p.row]
    if not doc.any():
        return Model(np.zeros(1 << BITS), -np.inf)
    # The passages that a rating means: by the odds of their words, the best one of each abusive document and others like it.
    odds = _evidence(p, rated)
    best = np.full(len(rated), -np.inf)
    np.maximum.at(best, p.row, odds)
    target = doc & (((odds >= best[p.row]) & (odds > FIRST_ODDS)) | (odds > SURE_ODDS))
    weight = np.where(target | ~doc, 1.0, 0.0)
    weight[~doc & (odds > SURE_ODDS)] = 0  # of a wrong rating, perhaps
    # Harmless passages are many and alike: a bounded part of them is enough, those most like abusive ones first.
    other = np.flatnonzero(~target)
    if len(other) > HARMLESS_PASSAGES:
        other = other[np.argsort(-odds[other], kind="stable")]
        rest = other[HARMLESS_PASSAGES // 8 :]
        h = T.mix(np.arange(len(rest), dtype=np.uint64) + np.uint64(SEED))
        weight[rest[np.argsort(h)[HARMLESS_PASSAGES - HARMLESS_PASSAGES // 8 :]]] = -1
    net = _Net(p, np.flatnonzero(weight >= 0))
    target, weight, doc, odds = target[net.passages], weight[net.passages], doc[net.passages], odds[net.passages]
    for round_ in range(ROUNDS):
        prob = net.fit(target, weight, STEPS)
        if round_ < ROUNDS - 1:
            # What scores in an abusive document is meant as well; a harmless passage that scores for sure is a wrong rating.
            target = target & (prob > 0.2) | doc & (prob > 0.8) & (odds > FIRST_ODDS)
            weight = np.where(doc & ~target, 0.3, np.where(~doc & (prob > 0.95) & (odds > FIRST_ODDS), 0.1, 1.0))
    key, _, word_odds, pos = _odds(p, p.words.hash, p.of, rated)
    return net.model(key[(word_odds >= SURE_ODDS) & (pos >= WORD_SEEN)])


class _Net:
    """Embeddings and softmax over some passages, trained together by full-batch gradient steps (Adam)."""

    def __init__(self, p: Passages, passages: np.ndarray):
        self.passages, self.m = passages, len(passages)
        w = p.words
        to = np.full(len(p), -1, dtype=np.int64)
        to[passages] = np.arange(self.m)
        of = to[p.of]
        use = np.flatnonzero(of >= 0)
        _, first, inv = np.unique(w.hash[use], return_index=True, return_inverse=True)
        b, o = _word_features(w, use[first])
        ok = np.flatnonzero(p.pair_ok & (of[1:] >= 0))
        pairs, pair_of = _pair_buckets(w.hash)[ok], of[1:][ok]
        # Features that only one passage has say nothing about others.
        times = np.bincount(inv, minlength=len(first))
        n = np.bincount(b, times[o], 1 << BITS) + np.bincount(pairs, minlength=1 << BITS)
        self.count = np.maximum(1, np.bincount(of[use], np.bincount(o, minlength=len(first))[inv], self.m) + np.bincount(pair_of, minlength=self.m)).astype(np.float32)[:, None]
        keep, pkeep = n[b] >= MIN_SEEN, n[pairs] >= MIN_SEEN
        b, o, pairs, pair_of = b[keep], o[keep], pairs[pkeep], pair_of[pkeep]
        self.used, ids = np.unique(np.concatenate([b, pairs]), return_inverse=True)
        fb, pb = ids[: len(b)], ids[len(b) :]
        # A word is a row of the passages' sums; a pair is a word of one feature.
        unit_of = np.concatenate([of[use], pair_of])
        upairs, pinv = np.unique(pb, return_inverse=True)
        unit = np.concatenate([inv, len(first) + pinv])
        feature, owner = np.concatenate([fb, upairs]), np.concatenate([o, len(first) + np.arange(len(upairs))])
        self.units = len(first) + len(upairs)
        self.by_owner = _Sums(owner, self.units, feature)
        self.by_feature = _Sums(feature, len(self.used), owner)
        self.by_passage = _Sums(unit_of, self.m, unit)
        self.by_unit = _Sums(unit, self.units, unit_of)
        rng = np.random.default_rng(SEED)
        self.emb = (rng.standard_normal((len(self.used), DIMENSIONS)) * 0.05).astype(np.float32)
        self.out = (rng.standard_normal((DIMENSIONS, 2)) * 0.5).astype(np.float32)
        self.bias = np.zeros(2, dtype=np.float32)
        self.moments = [(np.zeros_like(v), np.zeros_like(v)) for v in (self.emb, self.out, self.bias)]
        self.t = 0

    def fit(self, target: np.ndarray, weight: np.ndarray, steps: int) -> np.ndarray:
        pos, neg = weight[target].sum(), weight[~target].sum()
        scale = (np.where(target, ABUSIVE_SHARE / max(pos, 1e-9), (1 - ABUSIVE_SHARE) / max(neg, 1e-9)) * weight).astype(np.float32)[:, None]
        for _ in range(steps):
            self.t += 1
            hid = self.by_passage(self.by_owner(self.emb)) / self.count
            z = hid @ self.out + self.bias
            e = np.exp(z - z.max(axis=1, keepdims=True))
            g = e / e.sum(axis=1, keepdims=True)
            prob = g[:, 1].copy()
            g[np.arange(self.m), target.astype(int)] -= 1
            g *= scale
            d = (g @ self.out.T) / self.count
            grads = (self.by_feature(self.by_unit(d)) + DECAY * self.emb, hid.T @ g, g.sum(axis=0))
            for v, gr, (m1, m2) in zip((self.emb, self.out, self.bias), grads, self.moments, strict=True):
                m1 += 0.1 * (gr - m1)
                m2 += 0.01 * (gr * gr - m2)
                v -= RATE * (m1 / (1 - 0.9**self.t)) / (np.sqrt(m2 / (1 - 0.99**self.t)) + EPSILON)
        return prob

    def model(self, words: np.ndarray) -> Model:
        weight = np.zeros(1 << BITS, dtype=np.float32)
        weight[self.used] = self.emb @ (self.out[:, 1] - self.out[:, 0])
        return Model(weight, float(self.bias[1] - self.bias[0]), words)


class _Sums:
    """Sums of the rows ``of`` of a matrix by ``group``."""

    def __init__(self, group: np.ndarray, groups: int, of: np.ndarray):
        order = np.argsort(group, kind="stable")
        self.of = of[order]
        self.ids, self.edge = np.unique(group[order], return_index=True)
        self.groups = groups

    def __call__(self, x: np.ndarray) -> np.ndarray:
        out = np.zeros((self.groups, x.shape[1]), dtype=np.float32)
        if len(self.ids):
            out[self.ids] = np.add.reduceat(x[self.of], self.edge, axis=0)
        return out


def rated_documents(documents: DataFrame, labels: DataFrame, abusive: int = ABUSIVE_ROWS, harmless: int = HARMLESS_ROWS) -> DataFrame:
    """(text, toxic) of a bounded sample of rated documents; ratings of one document count by majority, ties not at all."""
    r = labels.where("toxic is not null and doc_id is not null").groupBy("doc_id").agg(F.avg("toxic").alias("mean")).where("mean != 0.5").select("doc_id", (F.col("mean") > 0.5).alias("toxic"))
    pick = lambda on, n: r.where(F.col("toxic") if on else ~F.col("toxic")).orderBy(F.xxhash64("doc_id"), "doc_id").limit(n)
    ids = pick(True, abusive).unionByName(pick(False, harmless))
    return documents.select("doc_id", "text").where("text is not null").join(F.broadcast(ids), "doc_id").select("text", "toxic")


def fit(documents: DataFrame, labels: DataFrame) -> Model:
    t = rated_documents(documents, labels).toArrow()
    return train(t["text"].combine_chunks() if t.num_rows else pa.array([], pa.string()), t["toxic"].to_numpy().astype(bool) if t.num_rows else np.zeros(0, bool))


def document_scores(documents: DataFrame, labels: DataFrame | None, model: Model | None = None) -> DataFrame:
    """(doc_id, source, score): the score of each document's worst passage, by a model of the ratings in ``labels`` or by a given one (see ``fit``).

    Null, blank and wordless texts score 0. Repeated documents count each; without documents rated abusive all score 0;
    an empty table gives no row; other columns are ignored.
    """
    held = shared(documents.sparkSession, model or fit(documents, labels))

    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in T.slices(it, "text"):
            w = words_of(b.column("text"))
            score = np.zeros(b.num_rows)
            for across in (False, True):
                p = Passages(w, across)
                np.maximum.at(score, p.row, held.value.scores(p))
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), b.column("source"), pa.array(score)], names=["doc_id", "source", "score"])

    return documents.select("doc_id", "source", "text").mapInArrow(run, "doc_id long, source string, score double")


def source_rates(scores: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """Documents, abusive documents and their share by source; a null source is one of its own."""
    return scores.groupBy("source").agg(F.count("*").alias("documents"), F.count_if(F.col("score") >= threshold).alias("abusive"), F.avg((F.col("score") >= threshold).cast("double")).alias("rate"), F.avg("score").alias("mean_score"))


def _tables(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    return table(spark, sf_dir, "documents", "doc_id", "text", "source"), table(spark, sf_dir, "labels", "doc_id", "toxic")


def p8_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return document_scores(*_tables(spark, sf_dir)).where(F.col("score") >= THRESHOLD).select("doc_id")


def p8_rates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return source_rates(document_scores(*_tables(spark, sf_dir)))

"""Problem 2: token counts under an existing tokenizer, by source, language and domain.

A unigram vocabulary is laid out as a double-array trie over bytes. The best path of every distinct segment (white space
and the word after it) is found by count-only Viterbi for all segments of a batch at once; only the path's length
is kept. For vocabularies of another kind, of which the scores are merge ranks, a unigram score is derived from the
rank (Zipf's law); ``exact_counter`` counts with the tokenizer itself, segment by segment, to tell the difference.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusloom.llm import textvec as T
from corpusloom.llm.common import canonical_label, shared, table

#: Vocabulary file, a parameter of all queries.
VOCABULARY = "/opt/tokenizers/piece_bpe_32k.model"
#: Ranks are shifted by this before their logarithm is taken.
ZIPF_SHIFT = 100
#: Counts of distinct segments kept by a worker, at most.
CACHE = 400_000
_SPACE, _MARK = 32, 0x2581


class DoubleArray:
    """A trie over bytes in two arrays: child of node s by byte c is t = base[s] + c if check[t] == s. Values are scores, NaN: no entry."""

    def __init__(self, entries: dict[bytes, float]):
        children: list[dict[int, int]] = [{}]
        value = [math.nan]
        for key, score in entries.items():
            s = 0
            for c in key:
                t = children[s].get(c)
                if t is None:
                    t = children[s][c] = len(children)
                    children.append({})
                    value.append(math.nan)
                s = t
            value[s] = score
        # Nodes with several children are placed first, on a front that moves on once it is nearly full; single
        # children then fill the gaps.
        order = [0]
        for s in order:
            order.extend(children[s].values())
        used = bytearray(1 << 20)
        used[0] = 1
        base_of = [0] * len(children)
        front = 1
        for s in sorted(order, key=lambda s: -len(children[s])):
            codes_ = sorted(children[s])
            if len(codes_) < 2:
                break
            low = codes_[0]
            t, full = max(front, low + 1), 0
            begun = t
            while True:
                if used[t]:
                    full += 1
                elif not any(used[t - low + c] for c in codes_[1:]):
                    break
                t += 1
                if t + 600 > len(used):
                    used.extend(bytes(len(used)))
            if full > 0.5 * (t - begun + 1):
                front = t
            base_of[s] = t - low
            for c in codes_:
                used[t - low + c] = 1
        free = 1
        for s in order:
            if len(children[s]) == 1:
                (c,) = children[s]
                free = used.index(0, max(free, 257))  # beyond any byte, so that a base is positive
                base_of[s] = free - c
                used[free] = 1
                if free > len(used) - 600:
                    used.extend(bytes(len(used)))
        size = used.rindex(1) + 258
        base, check, scores = np.zeros(size, np.int32), np.full(size, -1, np.int32), np.full(size, np.nan)
        place = {0: 0}
        check[0] = -2
        for s in order:
            p = place.pop(s)
            base[p] = base_of[s]
            scores[p] = value[s]
            for c, k in children[s].items():
                check[base_of[s] + c] = p
                place[k] = base_of[s] + c
        self.base, self.check, self.score = base, check, scores
        self.depth = max(map(len, entries), default=0)

    def get(self, key: bytes) -> float:
        s = 0
        for c in key:
            t = int(self.base[s]) + c
            if t >= len(self.check) or self.check[t] != s or t == 0:
                return math.nan
            s = t
        return float(self.score[s])


class Unigram:
    """A unigram vocabulary: pieces with log scores. A character that no piece covers costs one token for each of its bytes. ``rules`` is
    the model whose normalizer segments pass first, if it has one; ``strip`` is whether it drops all but one blank."""

    def __init__(self, pieces: dict[str, float], rules: bytes | None = None, strip: bool = False):
        self.rules, self.strip = rules, strip
        self.trie = DoubleArray({p.replace("▁", " ").encode(): s for p, s in pieces.items() if p})
        self.unknown = min(pieces.values(), default=0.0) - 10.0

    def normal(self, segments: list[bytes]) -> list[bytes]:
        texts = [s.decode("utf-8", "replace") for s in segments]
        if self.rules is not None:
            texts = _normalizer(self.rules).normalize(texts)
        if self.strip:
            texts = ["".join(" " + x for x in t.split(" ") if x) for t in texts]
        return [t.encode() for t in texts]

    def counts(self, segments: list[bytes]) -> np.ndarray:
        """Tokens of the best path of each segment, once normalized."""
        if self.rules is not None or self.strip:
            segments = self.normal(segments)
        n = np.array([len(s) for s in segments], dtype=np.int64)
        data = np.frombuffer(b"".join(segments), dtype=np.uint8)
        total = len(data)
        if not total:
            return np.zeros(len(segments), dtype=np.int64)
        off = np.cumsum(n) - n
        stop = np.repeat(off + n, n)  # end of the segment of each byte
        lead = (data & 0xC0) != 0x80
        t = self.trie
        start = np.flatnonzero(lead)
        node = np.zeros(len(start), dtype=np.int64)
        at = start.copy()
        edges: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        for _ in range(t.depth):
            ok = at < stop[start]
            start, node, at = start[ok], node[ok], at[ok]
            if not len(start):
                break
            nxt = t.base[node] + data[at]
            ok = (nxt > 0) & (nxt < len(t.check))
            ok[ok] = t.check[nxt[ok]] == node[ok]
            start, node, at = start[ok], nxt[ok].astype(np.int64), at[ok] + 1
            hit = ~np.isnan(t.score[node])
            edges.append((start[hit], at[hit], t.score[node[hit]]))
        # Characters: bytes to the next lead byte. Those without a piece of their own fall back to bytes.
        first = np.flatnonzero(lead)
        nxt_first = np.append(first[1:], total)
        have = np.zeros(total, dtype=bool)
        for s, e, _ in edges:
            k = np.searchsorted(first, s)
            have[s[nxt_first[k] == e]] = True
        lost = first[~have[first]]
        lost_end = nxt_first[~have[first]]
        s = np.concatenate([*(x for x, _, _ in edges), lost])
        e = np.concatenate([*(x for _, x, _ in edges), lost_end])
        score = np.concatenate([*(x for _, _, x in edges), self.unknown * (lost_end - lost)])
        add = np.concatenate([np.ones(len(s) - len(lost), np.int64), lost_end - lost])
        segment = np.searchsorted(off, s, side="right") - 1
        rel = s - off[segment]
        order = np.argsort(rel, kind="stable")
        s, e, score, add, rel = s[order], e[order] + segment[order], score[order], add[order], rel[order]
        s = s + segment[order]  # nodes: one more than bytes in each segment
        best = np.full(total + len(n), -np.inf)
        length = np.zeros(total + len(n), dtype=np.int64)
        best[off + np.arange(len(n))] = 0
        cut = np.flatnonzero(np.diff(rel, prepend=-1))
        for a, b in zip(cut.tolist(), [*cut[1:].tolist(), len(rel)], strict=True):
            to, cand = e[a:b], best[s[a:b]] + score[a:b]
            np.maximum.at(best, to, cand)
            win = best[to] == cand
            length[to[win]] = length[s[a:b][win]] + add[a:b][win]
        return length[off + n + np.arange(len(n))]


@lru_cache(2)
def _normalizer(model: bytes):
    import sentencepiece

    return sentencepiece.SentencePieceNormalizer(model_proto=model, add_dummy_prefix=False, escape_whitespaces=False, remove_extra_whitespaces=False)


def zipf_scores(pieces: list[str]) -> dict[str, float]:
    """Unigram scores of pieces in order of rank."""
    return {p: -math.log(i + ZIPF_SHIFT) for i, p in enumerate(pieces)}


@lru_cache(2)
def load_unigram(path: str = VOCABULARY) -> Unigram:
    """The vocabulary of a SentencePiece model: with its own scores if it is a unigram model, by rank if not; and with its normalizer.

    Merge ranks are whole numbers that fall by one from piece to piece; log probabilities are not.
    """
    import sentencepiece
    from sentencepiece import sentencepiece_model_pb2

    model = sentencepiece_model_pb2.ModelProto()
    with open(path, "rb") as f:
        proto = f.read()
    model.ParseFromString(proto)
    spec = model.normalizer_spec
    rules = proto if spec.precompiled_charsmap else None
    sp = sentencepiece.SentencePieceProcessor(model_proto=proto)
    ids = [i for i in range(sp.get_piece_size()) if not (sp.is_control(i) or sp.is_unknown(i) or sp.is_byte(i) or sp.is_unused(i))]
    pieces, scores = [sp.id_to_piece(i) for i in ids], [sp.get_score(i) for i in ids]
    own = any(s != int(s) for s in scores if abs(s) < 1e8)
    return Unigram(dict(zip(pieces, scores, strict=True)) if own else zipf_scores(pieces), rules, spec.remove_extra_whitespaces)


def segments(col: pa.Array) -> tuple[T.Codes, np.ndarray, np.ndarray, np.ndarray]:
    """Segments of each text, a blank put before it: runs of blanks and the characters up to the next blank. (codes, start, end, row)"""
    x = T.codes(col)
    c = np.where(x.c == _MARK, _SPACE, x.c).astype(np.uint32)
    rows = np.flatnonzero(x.end > x.start)
    c = np.insert(c, x.start[rows], _SPACE)
    shift = np.zeros(len(x) + 1, dtype=np.int64)
    np.cumsum(x.end > x.start, out=shift[1:])
    x = T.Codes(c, x.start + shift[:-1], x.end + shift[1:])
    space = c == _SPACE
    new = space.copy()
    new[1:] &= ~space[:-1]
    new[x.start[rows]] = True
    start = np.flatnonzero(new)
    end = np.append(start[1:], len(c))
    row = np.searchsorted(x.start[rows], start, side="right") - 1
    return x, start, end, rows[row] if len(rows) else row


class Counter:
    """Tokens of texts by their distinct segments, whose counts are remembered."""

    def __init__(self, count: Callable[[list[bytes]], np.ndarray]):
        self.count, self.known = count, {}

    def __call__(self, col: pa.Array) -> np.ndarray:
        x, start, end, row = segments(col)
        if not len(start):
            return np.zeros(len(col), dtype=np.int64)
        keys, at, inv = T.unique(T.span_hash(x.c, start, end))
        known = self.known
        if len(known) > CACHE:
            known.clear()
        names = keys.tolist()
        new = [i for i, k in enumerate(names) if k not in known]
        if new:
            texts = [x.c[start[at[i]] : end[at[i]]].astype("<u4").tobytes().decode("utf-32-le", "replace").encode("utf-8", "replace") for i in new]
            for i in range(0, len(new), 20000):
                known.update(zip((names[j] for j in new[i : i + 20000]), self.count(texts[i : i + 20000]).tolist(), strict=True))
        n = np.array([known[k] for k in names], dtype=np.int64)
        return np.bincount(row, n[inv], len(col)).astype(np.int64)


@lru_cache(2)
def _piece_processor(model: bytes):
    import sentencepiece

    return sentencepiece.SentencePieceProcessor(model_proto=model)


def exact_counter(model: bytes) -> Counter:
    """Counts as the SentencePiece model itself does. Sound where no piece has a blank after another character, as in its vocabularies."""

    def count(parts: list[bytes]) -> np.ndarray:
        # The processor puts a blank before each text itself, but not before an empty one.
        return np.array([max(1, len(x)) for x in _piece_processor(model).encode([p[1:].decode() for p in parts], num_threads=1)], dtype=np.int64)

    return Counter(count)


def token_counts(df: DataFrame, text: str, vocabulary: str = VOCABULARY, exact: bool = False) -> DataFrame:
    """``df`` with a column ``tokens`` in place of ``text``: estimated by the unigram vocabulary, or exact by the model.

    Null and empty texts have 0 tokens; blank ones those of their blanks. Repeated rows count each; an empty table stays empty.
    """
    spark = df.sparkSession
    keep = [c for c in df.columns if c != text]
    schema = df.select(*keep).schema.add("tokens", "long")
    held = shared(spark, open(vocabulary, "rb").read() if exact else load_unigram(vocabulary))

    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = exact_counter(held.value) if exact else Counter(held.value.counts)
        for b in T.slices(it, text):
            yield pa.RecordBatch.from_arrays([*(b.column(c) for c in keep), pa.array(counter(b.column(text)))], names=[*keep, "tokens"])

    return df.mapInArrow(run, schema)


def canonical_source(src: Column) -> Column:
    """A source's name without case, outer blanks and version; ``unknown`` for null and blank ones."""
    s = F.regexp_replace(F.lower(F.trim(src)), "_v[0-9]+$", "")
    return F.when(F.coalesce(s, F.lit("")) == "", "unknown").otherwise(s)


def token_budget(pairs: DataFrame, pool: DataFrame, mix: DataFrame, documents: DataFrame, vocabulary: str = VOCABULARY) -> DataFrame:
    """(tbl, source, language, domain, texts, tokens): how many tokens each slice of both tables holds.

    A pair's language is that of the latest prompt with its key, else its own label; its domain is its source's. What is
    missing is ``unknown``. Totals are summed by key before prompts are joined, so that no key is moved row by row.
    """
    own = F.coalesce(canonical_label(F.col("lang")), F.lit("unknown"))
    t = token_counts(pairs.select("key", canonical_source(F.col("src")).alias("source"), own.alias("own"), "response"), "response", vocabulary)
    t = t.groupBy("key", "source", "own").agg(F.count("*").alias("texts"), F.sum("tokens").alias("tokens"))
    prompts = pool.where("key is not null").groupBy("key").agg(F.max_by(canonical_label(F.col("plang")), F.struct("added_at", "pool_id")).alias("plang"))
    domains = mix.groupBy(canonical_source(F.col("src")).alias("source")).agg(F.min("domain").alias("domain"))
    t = t.join(prompts, "key", "left").join(domains, "source", "left").select(F.lit("train_smoke").alias("tbl"), "source", F.coalesce("plang", "own").alias("language"), F.coalesce("domain", F.lit("unknown")).alias("domain"), "texts", "tokens")
    d = token_counts(documents.select(canonical_source(F.col("source")).alias("source"), own.alias("language"), F.coalesce(F.trim("domain"), F.lit("unknown")).alias("domain"), "text"), "text", vocabulary)
    d = d.select(F.lit("documents").alias("tbl"), "source", "language", "domain", F.lit(1).cast("long").alias("texts"), "tokens")
    return t.unionByName(d).groupBy("tbl", "source", "language", "domain").agg(F.sum("texts").alias("texts"), F.sum("tokens").alias("tokens"))


def p2_estimates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The estimate of each text of both tables."""
    a = table(spark, sf_dir, "train_smoke", "row_id", "response").select(F.lit("train_smoke").alias("tbl"), F.col("row_id").alias("ref_id"), F.col("response").alias("text"))
    b = table(spark, sf_dir, "documents", "doc_id", "text").select(F.lit("documents").alias("tbl"), F.col("doc_id").alias("ref_id"), "text")
    return token_counts(a.unionByName(b), "text")


def p2_budget(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_budget(
        table(spark, sf_dir, "train_smoke", "key", "src", "lang", "response"), table(spark, sf_dir, "pool_todo", "key", "plang", "added_at", "pool_id"),
        table(spark, sf_dir, "source_mix", "src", "domain"), table(spark, sf_dir, "documents", "source", "lang", "domain", "text"),
    )

"""Problems 2 and 6: counts against a plain Viterbi and the tokenizer, the trie, packing invariants."""

from __future__ import annotations

import os
import random

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from corpusloom.llm import packing as Q
from corpusloom.llm import tokens as K
from tests.conftest import rows

needs_model = pytest.mark.skipif(not os.path.exists(K.VOCABULARY), reason="no vocabulary file")


@settings(max_examples=100, deadline=None)
@given(st.dictionaries(st.binary(min_size=1, max_size=6), st.floats(-9, 0), min_size=1, max_size=60))
def test_double_array(entries):
    t = K.DoubleArray(entries)
    assert all(t.get(k) == v for k, v in entries.items())
    for k in entries:
        for other in (k + b"x", k[:-1], b"zz" + k):
            assert (t.get(other) == entries[other]) if other in entries else t.get(other) != t.get(other)


def test_segments_are_normalized_first():
    """A unigram model's own rules (here lower case and compatibility forms) come before its pieces; dropped blanks cost nothing."""
    spm = pytest.importorskip("sentencepiece")
    rules = spm.SentencePieceNormalizer(rule_name="nmt_nfkc_cf").serialized_model_proto()
    pieces = {"▁abc": -1.0, "▁": -2.0, "xii": -1.5, "a": -3.0}
    plain, own = K.Unigram(pieces), K.Unigram(pieces, rules, strip=True)
    texts = [" ＡＢＣ".encode(), b" ABC", " Ⅻ".encode(), b"   ", b" abc", b"", b"   abc"]
    assert own.counts(texts).tolist() == [1, 1, 2, 0, 1, 0, 1]
    assert plain.counts(texts)[[1, 3, 4, 5, 6]].tolist() == [4, 3, 1, 0, 3]


def viterbi(segment: str, pieces: dict[str, float], unknown: float) -> int:
    best = [(0.0, 0)] + [(-1e18, 0)] * len(segment)
    for i in range(len(segment)):
        steps = [(segment[i:j], j, 1) for j in range(i + 1, len(segment) + 1) if segment[i:j] in pieces]
        if segment[i] not in pieces:
            steps.append((None, i + 1, len(segment[i].encode())))
        for p, j, n in steps:
            s = best[i][0] + (pieces[p] if p else unknown * n)
            if s > best[j][0]:
                best[j] = (s, best[i][1] + n)
    return best[-1][1]


def test_viterbi_against_the_table():
    rng = random.Random(4)
    for _ in range(60):
        pieces = {"".join(rng.choice("abक ") for _ in range(rng.randint(1, 4))): -rng.random() * 9 - 0.01 for _ in range(12)}
        u = K.Unigram(pieces)
        parts = ["".join(rng.choice("abकz ") for _ in range(rng.randint(1, 12))) for _ in range(30)]
        got = u.counts([p.encode() for p in parts])
        assert [int(x) for x in got] == [viterbi(p, pieces, u.unknown) for p in parts]


@needs_model
def test_exact_counts_and_estimates():
    import sentencepiece

    sp = sentencepiece.SentencePieceProcessor(model_file=K.VOCABULARY)
    texts = ["hello  world", "", " ", "नमस्ते दुनिया, कैसे हो?", "tab\tand\n\nline", "वाक्य " * 50, "a▁b  ", "emoji 😀 ①", None, "  lead", "the market sells a cheap version of the lamp"]
    col = pa.array(texts, pa.string())
    exact = K.exact_counter(open(K.VOCABULARY, "rb").read())(col)
    assert exact.tolist() == [len(sp.encode(t or "")) for t in texts]
    estimate = K.Counter(K.load_unigram().counts)(col)
    assert abs(int(estimate.sum()) - int(exact.sum())) <= 0.02 * exact.sum() and estimate[1] == 0 and estimate[8] == 0


@needs_model
def test_budget(spark):
    pairs = spark.createDataFrame([("k", "Hindi_v2", None, "one two"), ("k", " hindi", "en", "three"), (None, None, "ta", None)], "key string, src string, lang string, response string")
    pool = spark.createDataFrame([("k", "hi", 1, 1), ("k", "marathi", 2, 2)], "key string, plang string, added_at int, pool_id int")
    mix = spark.createDataFrame([("hindi", "general")], "src string, domain string")
    docs = spark.createDataFrame([("wiki", "hin", None, "four"), ("wiki", "?", "d", "")], "source string, lang string, domain string, text string")
    got = rows(K.token_budget(pairs, pool, mix, docs), "tbl", "source", "language", "domain", "texts")
    assert got == [("documents", "wiki", "hi", "unknown", 1), ("documents", "wiki", "unknown", "d", 1), ("train_smoke", "hindi", "mr", "general", 2), ("train_smoke", "unknown", "ta", "unknown", 1)]
    assert K.token_counts(pairs.limit(0).select("key", "response"), "response").count() == 0


@settings(max_examples=150, deadline=None)
@given(st.lists(st.integers(1, 50), max_size=60), st.integers(50, 80))
def test_packing_keeps_all_and_overfills_none(sizes, capacity):
    bins = Q.pack(sizes, capacity)
    assert sorted(i for b in bins for i in b) == list(range(len(sizes)))
    assert all(sum(sizes[i] for i in b) <= capacity for b in bins)
    if sizes:
        loads = [sum(sizes[i] for i in b) for b in bins]
        assert sum(1 for x in loads if 2 * x <= capacity) <= 1  # two half-empty bins would have been one


def test_packing_is_tight_and_divides_only_what_must_be():
    rng = np.random.default_rng(3)
    sizes = rng.integers(30, 900, 4000)
    bins = Q.pack(sizes.tolist(), 2048)
    assert sizes.sum() / (len(bins) * 2048) > 0.98
    doc, start, size = Q.pieces(np.array([0, 5, 2048, 2049, 5000]), 2048)
    assert doc.tolist() == [1, 2, 3, 3, 4, 4, 4] and size.tolist() == [5, 2048, 2048, 1, 2048, 2048, 904] and start.tolist() == [0, 0, 0, 2048, 0, 2048, 4096]


@needs_model
def test_sequences(spark):
    docs = spark.createDataFrame([(i, "word " * (i % 40)) for i in range(300)] + [(999, "long " * 5000), (1000, None)], "doc_id long, text string")
    out = Q.sequences(docs, capacity=256, block=64)
    f = Q.fill(out, 256).first()
    assert f.over_full == 0 and f.filled > 0.9
    parts = rows(out.where("doc_id = 999"), "part", "first_token", "tokens")
    assert [p[0] for p in sorted(parts)] == list(range(len(parts))) and len(parts) > 10
    assert out.where("doc_id < 999").count() == out.where("doc_id < 999").select("doc_id").distinct().count() == 300 - 8 + out.where("doc_id < 999 and doc_id % 40 = 0").count()
    assert Q.sequences(docs.limit(0)).count() == 0

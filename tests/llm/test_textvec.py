"""Vectorised text primitives against plain Python."""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
from hypothesis import given, settings
from hypothesis import strategies as st

from corpusloom.llm import textvec as T

TEXT = st.text(alphabet=st.sampled_from("abAB १क़कि,.!?।\n\t​é①　😀'\"*"), max_size=40)
LISTS = st.lists(st.one_of(st.none(), TEXT), max_size=8)


@settings(max_examples=150, deadline=None)
@given(LISTS)
def test_rows_come_back(texts):
    x = T.codes(pa.array(texts, pa.string()))
    assert [x.text(i) for i in range(len(x))] == [t or "" for t in texts]


def test_slices_of_slices():
    a = pa.array(["aa", None, "अआ", "", "x" * 50, "b"])
    x = T.codes(a.slice(1, 4))
    assert [x.text(i) for i in range(4)] == ["", "अआ", "", "x" * 50]
    b = pa.RecordBatch.from_arrays([a, pa.array(range(6))], names=["t", "i"])
    parts = list(T.slices(iter([b]), "t", 10))
    assert sum(p.num_rows for p in parts) == 6 and [v for p in parts for v in p["i"].to_pylist()] == list(range(6))


def test_bytes_that_are_no_text():
    a = pa.array([b"ok", b"\xff\xfe", None], pa.binary())
    raw = pa.StringArray.from_buffers(3, a.buffers()[1], a.buffers()[2], a.buffers()[0])
    x = T.codes(raw)
    assert [x.text(i) for i in range(3)] == ["ok", "��", ""]


@settings(max_examples=150, deadline=None)
@given(LISTS)
def test_words_and_hashes(texts):
    w = T.words(T.folded(T.codes(pa.array(texts, pa.string()))))
    got = [[w.text(j) for j in range(w.first[i], w.first[i + 1])] for i in range(len(texts))]
    fold = {"A": "a", "B": "b", "१": "1", "é": "e", "①": "1", "​": "", "़": ""}
    for t, g in zip(texts, got, strict=True):
        s = "".join(fold.get(c, c) for c in (t or "").replace("क़", "क"))
        assert g == re.findall(r"[a-zअ-हऀ-ः0-9ा-्]+", s) or any(c in (t or "") for c in "①")
    flat = [x for g in got for x in g]
    h = w.hash
    assert all((h[i] == h[j]) == (flat[i] == flat[j]) for i in range(len(flat)) for j in range(len(flat)))
    if flat:
        assert (T.str_hash(flat) == h).all()


def test_sentences():
    x = T.codes(pa.array(["One. Two! 3.5 is a number.\nLast line", "1. First item. Second", "", "क है। ख है|  ग", "..."]))
    start, end, row = T.sentence_spans(x)
    got = [(int(r), x.c[a:b].astype("<u4").tobytes().decode("utf-32-le").strip()) for a, b, r in zip(start, end, row, strict=True)]
    assert got == [(0, "One."), (0, "Two!"), (0, "3.5 is a number."), (0, "Last line"), (1, "1. First item."), (1, "Second"), (3, "क है।"), (3, "ख है|"), (3, "ग")]


def test_hashes_do_not_depend_on_place():
    rng = np.random.default_rng(0)
    words = ["".join(rng.choice(list("abc"), 5)) for _ in range(200)]
    a = T.str_hash(words)
    b = T.str_hash(words[::-1])[::-1]
    assert (a == b).all() and len(set(a.tolist())) == len(set(words))


def test_distinct_words():
    """Each word's own place among the distinct ones, their letters, and flags of theirs, also where text goes on behind the last word."""
    w = T.words(T.folded(T.codes(pa.array(["a bb a1", None, "bb bb ...", "", "1a x2 !!2"]))))
    at, inv = w.distinct
    assert sorted(w.text(i) for i in at) == ["1a", "2", "a", "a1", "bb", "x2"]
    assert [w.text(i) for i in at[inv]] == [w.text(i) for i in range(len(w))]
    one = w.only(at)
    assert [one.text(i) for i in range(len(at))] == [w.text(i) for i in at] and (one.hash == w.hash[at]).all() and one.row.tolist() == list(range(len(at)))
    for x in (w, one, T.words(T.codes(pa.array(["a 1"]))), T.words(T.codes(pa.array(["a .1. b 2x 9"])))):
        assert x.some(x.codes.kind == T.DIGIT).tolist() == [any(c.isdigit() for c in x.text(i)) for i in range(len(x))]
    none = T.words(T.codes(pa.array(["", None, "..."])))
    assert not len(none.distinct[0]) and not len(none.some(none.codes.kind == T.DIGIT))

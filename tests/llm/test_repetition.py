"""Problem 5: the share against brute force; the bands lose no case."""

from __future__ import annotations

import random
import unicodedata

import numpy as np
import pyarrow as pa
from hypothesis import given, settings
from hypothesis import strategies as st

from corpusloom.llm import repetition as R
from tests.conftest import rows


def brute(text: str) -> tuple[int, float]:
    w = []
    for x in (text or "").split():
        y = "".join(c for c in x.lower() if unicodedata.category(c)[0] in "LM")
        if y:
            w.append(y)
    covered, seen = [False] * len(w), set()
    for i in range(len(w) - 3):
        g = tuple(w[i : i + 4])
        if g in seen:
            covered[i : i + 4] = [True] * 4
        seen.add(g)
    return len(w), (sum(covered) / len(w) if w else 0.0)


@settings(max_examples=200, deadline=None)
@given(st.lists(st.lists(st.sampled_from(["a", "B", "c,", "7", "d!", "e", "हम", "-"]), max_size=40).map(" ".join), max_size=5))
def test_share(texts):
    w = R.plain_words(pa.array(texts, pa.string()))
    got = R.repeated_share(w, len(texts))
    for t, n, s in zip(texts, np.diff(w.first), got, strict=True):
        assert (int(n), round(float(s), 9)) == (brute(t)[0], round(brute(t)[1], 9))


def test_bands_lose_no_case():
    """Texts with just the share asked for, in the shortest runs and widely spread, stay under the limit."""
    rng = random.Random(1)
    texts = []
    for _ in range(1500):
        n = rng.choice([12, 13, 16, 25, 40, 80, 200, 256, 257, 300, 700])
        words = [f"w{chr(97 + rng.randrange(26))}{chr(97 + rng.randrange(26))}{chr(97 + i // 26 % 26)}{chr(97 + i % 26)}{chr(97 + i // 676)}" for i in range(n)]
        need = -(-3 * n // 10)
        out, runs = words[: n - need], []
        k = need // 4
        for i in range(k):
            a = rng.randrange(max(1, len(words[: n - need]) - 4))
            runs.append(words[a : a + 4 + (need % 4 if i == 0 else 0)])
        body = out[:]
        for r in runs:
            at = rng.randrange(len(out) // 2, len(body) + 1) if len(body) > 8 else len(body)
            body[at:at] = r
        texts.append(" ".join(body))
    w = R.plain_words(pa.array(texts))
    n = np.diff(w.first)
    coded = R.word_ratios(w, len(texts))
    case = (n >= R.MIN_WORDS) & (R.repeated_share(w, len(texts)) >= R.SHARE)
    assert case.sum() > 300 and (coded[case] <= R.limit(n[case])).all()


def test_limit_holds_for_long_texts():
    """Just the share asked for in runs of four: at the end, spread over the second half, and among few different words; to 100,000 words."""
    rng = np.random.default_rng(4)
    for n in (257, 512, 1000, 4000, 20000, 100000):
        for mode in ("tail", "spread", "few"):
            fresh = n - 4 * -(-3 * n // 40)
            w = rng.integers(1, 1 << 60, fresh) if mode != "few" else rng.permutation(np.repeat(rng.integers(1, 1 << 60, fresh // 4 + 1), 4))[:fresh]
            runs = [w[a : a + 4] for a in rng.integers(0, fresh // 2, -(-3 * n // 40))]
            at = np.sort(rng.integers(fresh // 2, fresh + 1, len(runs))) if mode == "spread" else np.full(len(runs), fresh)
            h = np.insert(w, np.repeat(at, 4), np.concatenate(runs)).astype(np.uint64)
            text = " ".join("".join(chr(97 + int(x) // 26**k % 26) for k in range(11)) for x in h)
            v = R.plain_words(pa.array([text]))
            share, ratio = R.repeated_share(v, 1)[0], R.word_ratios(v, 1)[0]
            assert share < R.SHARE or ratio <= R.limit(np.array([len(h)]))[0] - 0.03


def test_share_below_the_limit_is_reported(spark):
    """p5_repetition gives the exact share where it is too small for p5_found, too."""
    rng = random.Random(6)
    texts = []
    for n, again in ((235, 35), (250, 20), (1000, 100), (3000, 40), (60, 4)):
        w = ["".join(rng.choice("abcdefghij") for _ in range(8)) for _ in range(n - again)]
        texts.append(" ".join(w + w[5 : 5 + again]))
    df = spark.createDataFrame(list(enumerate(texts)), "row_id long, response string")
    got = {r.row_id: r.repeated_share for r in R.repetition(df).collect()}
    assert got == {i: brute(t)[1] for i, t in enumerate(texts)} and all(0 < v < R.SHARE for v in got.values())
    assert R.repetitive(df).count() == 0


def test_repeats_far_back(spark):
    """Passages said again thousands of words later, whole or in runs of four, in any place; a long text without any."""
    rng = random.Random(2)
    fresh = lambda n: ["".join(rng.choice("abcdefghijklmnop") for _ in range(9)) for _ in range(n)]
    texts = []
    for n in (520, 3000, 9000):
        w = fresh(n)
        texts.append(w + w)
        runs = [w[a : a + 4] + fresh(2) for a in (rng.randrange(n - 4) for _ in range(n // 6))]
        texts.append(w + [x for r in runs for x in r])
    texts = [" ".join(t) for t in [*texts, fresh(6000)]]
    want = [i for i, t in enumerate(texts) if brute(t)[1] >= R.SHARE]
    df = spark.createDataFrame(list(enumerate(texts)), "row_id long, response string")
    assert want == [0, 1, 2, 3, 4, 5] and rows(R.repetitive(df)) == [(i,) for i in want]
    r = {x.row_id: x for x in R.repetition(df).collect()}
    assert [r[i].repeated_share for i in r] == [brute(texts[i])[1] for i in r]
    assert all(r[i].word_ratio < 0.6 for i in (0, 2, 4)) and r[6].repeated_share == 0


def test_queries(spark):
    loop = "the boat came back " * 6
    plain = "one careful person can manage the whole garden alone if the weather stays kind and dry today"
    df = spark.createDataFrame([(1, loop), (2, plain), (3, None), (4, ""), (5, "la la"), (1, loop), (6, "x y z q " * 9000)], "row_id long, response string")
    assert rows(R.repetitive(df)) == [(1,), (1,), (6,)]
    r = {x.row_id: x for x in R.repetition(df).collect()}
    assert r[1].repeated_share == brute(loop)[1] and r[2].repeated_share == 0 and r[3].words == 0 and r[6].band == "repetitive" and r[2].band == "ok"
    assert R.repetition(df.limit(0)).count() == 0

"""Problem 7: whole, partial, changed and disguised passages; quotations, stock wording and sibling exercises."""

from __future__ import annotations

import random

import pytest

from corpusloom.llm import leaks as L
from tests.conftest import rows

STOCK = "Read the following passage carefully and choose the correct option from the four choices given below."


def item(seed: int) -> str:
    r = random.Random(seed)
    n = lambda: "".join(r.choice(["ka", "lo", "mi", "ru", "te"]) + r.choice(["ban", "dor", "fel", "gus"]) for _ in range(2)) + str(seed)[-1] * 0
    a, b, c, d = (n() + chr(97 + seed % 26) for _ in range(4))
    x, y = r.randint(1000, 9999), r.randint(1000, 9999)
    return f"Trader {a.title()} carried {x} sacks of {b} jute from {c.title()} towards {d.title()}, selling {y} at the {c} gate. Each {b} sack lost {y} grams before {d}, said {a} in the {c} register. How many {b} sacks did {a} still own at {d}?"


ITEMS = {i: (STOCK + " " if i % 2 else "") + item(i) for i in range(1, 9)}
NOISE = "The market sells a cheap lamp. Children learn cooking by watching. Rain and dust are the usual enemies of the old boat."


def changed(text: str) -> str:
    w = text.split()
    return " ".join(x if i % 5 else "quite" for i, x in enumerate(w))


@pytest.fixture(scope="module")
def tables(spark):
    own = ITEMS[2].split()
    docs = {
        1: NOISE + " " + ITEMS[2] + " " + NOISE, 2: NOISE + " " + " ".join(own[5:18]), 3: changed(ITEMS[4]), 4: ITEMS[6].upper().replace(" ", "\n​"), 5: NOISE + ' it says "' + " ".join(own[5:10]) + '"', 6: STOCK + " " + NOISE, 7: item(77), 8: NOISE, 9: None, 10: "",
        11: ITEMS[1].replace(",", " ;") + " " + ITEMS[3], 12: " ".join(ITEMS[8].split()[:26]) + " " + NOISE,
    }
    d = spark.createDataFrame([(i, t, "x") for i, t in docs.items()], "doc_id long, text string, item_id string")
    b = spark.createDataFrame([(i, t) for i, t in ITEMS.items()] + [(99, None)], "item_id long, text string")
    return d, b


WANT = [(1, 2), (2, 2), (3, 4), (4, 6), (11, 1), (11, 3), (12, 8)]


def test_cases(tables):
    assert sorted(rows(L.leaks(*tables))) == sorted(WANT)


def test_blocks_of_items(tables):
    assert sorted(rows(L.leaks(*tables, block_bytes=300))) == sorted(WANT)


def test_empty_tables(tables):
    d, b = tables
    assert L.leaks(d.limit(0), b).count() == 0 and L.leaks(d, b.limit(0)).count() == 0


def test_subsequence_against_the_table():
    import numpy as np

    rng = random.Random(2)
    for _ in range(200):
        a, b = ([rng.randint(0, 4) for _ in range(rng.randint(0, 12))] for _ in range(2))
        t = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
        for i, x in enumerate(a):
            for j, y in enumerate(b):
                t[i + 1][j + 1] = t[i][j] + 1 if x == y else max(t[i][j + 1], t[i + 1][j])
        assert L.subsequence(np.array(a, np.uint64), np.array(b, np.uint64)) == t[-1][-1]


def test_pieces_after_stray_own_words(spark):
    """Half of an item or more, edited, after a few of its own words that stand apart: all that a window at every own word finds."""
    import numpy as np

    rng = random.Random(4)
    texts = [ITEMS[i] for i in sorted(ITEMS)]
    items = next(L._blocks(L.classes(spark.createDataFrame(list(enumerate(texts)), "item_id long, text string")), 1 << 20))
    lost = total = 0
    for _ in range(1500):
        k = rng.randrange(len(texts))
        n = int(items.length[k])
        mine = items.hash[items.first[k] : items.first[k + 1]]
        own = items.own_keys[items.own_item == k]
        other = lambda m: np.array([rng.getrandbits(63) for _ in range(m)], np.uint64)
        kept = sorted(rng.sample(range(n), -(-n * rng.randint(50, 65) // 100)))
        if len(set(mine[kept].tolist()) & set(own.tolist())) < max(L.OWN_LEAST, L.OWN_SHARE * len(own)):
            continue
        parts = [other(20)]
        for _ in range(rng.randint(0, 6)):
            parts += [own[[rng.randrange(len(own))]], other(rng.randint(0, n // 2))]
        for i in kept:
            parts += [mine[[i]], other(rng.random() < 0.3)]
        total += 1
        lost += not L.in_pieces(items, k, np.concatenate([*parts, other(60)]))
    assert total > 500 and lost == 0


@pytest.mark.parametrize("copies", [1, 2, 3, 7])
def test_equal_items_leak_together(spark, copies):
    """An item that the benchmark has more than once, in other case and punctuation, is found under each of its ids."""
    same = [(100 + i, ITEMS[2] if i % 2 else ITEMS[2].upper().replace(".", " !")) for i in range(copies)]
    b = spark.createDataFrame([*same, *((i, t) for i, t in ITEMS.items() if i != 2)], "item_id long, text string")
    own = ITEMS[2].split()
    d = spark.createDataFrame([(1, NOISE + " " + ITEMS[2]), (2, " ".join(own[5:18])), (3, changed(ITEMS[2])), (4, NOISE)], "doc_id long, text string")
    assert sorted(rows(L.leaks(d, b))) == sorted((i, k) for i in (1, 2, 3) for k, _ in same)


def test_run_hits_are_verified(spark):
    """A run key that another text's words would share is no hit unless the twelve words are the item's."""
    import numpy as np
    import pyarrow as pa

    items = next(L._blocks(L.classes(spark.createDataFrame([(1, ITEMS[2])], "item_id long, text string")), 1 << 20))
    other = L.normal_words(pa.array(["one two three four five six seven eight nine ten eleven twelve"]))[0]
    items.run_keys, items.run_at, items.run_item = L._ngrams(other, L.RUN)[0], np.array([0]), np.array([0])
    items.table[:] = True
    assert L.scan(other, items) == []


def test_cleaned(spark, tables):
    d, b = tables
    for size in (1 << 20, 300):
        got = {r.doc_id: r for r in L.cleaned(d, b, block_bytes=size).collect()}
        assert {i: r.action for i, r in got.items()} == {1: "cut", 2: "cut", 3: "dropped", 4: "dropped", 5: "kept", 6: "kept", 7: "kept", 8: "kept", 9: "kept", 10: "kept", 11: "dropped", 12: "dropped"}
        assert " ".join(got[1].text.split()) == NOISE + " " + NOISE and got[9].text is None and got[8].text == NOISE
        assert got[2].leaked_words == 13 and got[2].text.split()[-1] == NOISE.split()[-1] and got[3].text is None
    left = spark.createDataFrame([(i, r.text) for i, r in got.items()], "doc_id long, text string")
    assert L.leaks(left, b).count() == 0
    twice = spark.createDataFrame([(1, " ".join([NOISE, ITEMS[2], NOISE * 9, ITEMS[2], NOISE]))], "doc_id long, text string")
    r = L.cleaned(twice, b).first()
    assert r.action == "cut" and r.leaked_words == 2 * len(L.normal_words(__import__("pyarrow").array([ITEMS[2]]))[0])
    assert L.cleaned(d.limit(0), b).count() == 0 and {r.action for r in L.cleaned(d, b.limit(0)).collect()} == {"kept"}

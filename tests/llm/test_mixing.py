"""Problem 3: targets, caps, size and mean of the rounding."""

from __future__ import annotations

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from corpusloom.llm import mixing as M
from tests.conftest import rows


def test_copies():
    c = M.copies({"a": 100.0, "b": 100.0, "c": 10.0, "d": 5.0}, {"a": 0.5, "b": 0.3, "c": 0.2, "e": 0.1}, {"a": 2, "b": 2, "c": 3, "e": 4})
    assert c["c"] == 3.0 and sum(c[s] * n for s, n in (("a", 100), ("b", 100), ("c", 10))) == pytest.approx(210)
    assert c["a"] / c["b"] == pytest.approx(5 / 3)
    assert M.copies({}, {"a": 1.0}, {"a": 1}) == {} and M.copies({"a": 10.0}, {"a": 1.0}, {"a": 2}, total=1000)["a"] == 2.0


@settings(max_examples=100, deadline=None)
@given(st.lists(st.tuples(st.floats(0, 1), st.integers(1, 50)), min_size=1, max_size=40), st.integers(0, 9999))
def test_pivotal_keeps_the_size(data, seed):
    rng = np.random.default_rng(seed)
    p, s = [x for x, _ in data], [float(y) for _, y in data]
    out, open_ = M.pivotal(p, s, rng.random(len(p)).tolist())
    assert set(out.tolist()) <= {0, 1}
    total = sum(a * b for a, b in zip(out[:-1], s, strict=True)) + (open_[1] * open_[2] if open_ else 0)
    assert total == pytest.approx(sum(a * b for a, b in zip(p, s, strict=True)), abs=1e-6)


def test_pivotal_keeps_the_mean():
    rng = np.random.default_rng(1)
    p, s, hits = [0.2, 0.5, 0.7, 0.35, 0.9], [3.0, 10.0, 1.0, 7.0, 2.0], np.zeros(5)
    n = 6000
    for _ in range(n):
        out, open_ = M.pivotal(p, s, rng.random(5).tolist())
        x = out[:-1].astype(float)
        if open_:
            x[open_[0]] = open_[1]
        hits += x
    assert np.abs(hits / n - p).max() < 0.03


@pytest.fixture(scope="module")
def mixed(spark):
    rng = np.random.default_rng(5)
    data = [(i, ["A", "b_v2", " c", "unlisted", None][k], "x" * int(rng.integers(1, 60))) for i, k in enumerate(rng.choice(5, 4000, p=[0.45, 0.4, 0.02, 0.1, 0.03]))] + [(9001, "a", None), (9002, "a", " ")]
    pairs = spark.createDataFrame(data, "row_id long, src string, response string").repartition(6)
    mix = spark.createDataFrame([("a", "d1", 0.5, 1), ("b", "d2", 0.3, 3), ("c", "d3", 0.16, 4), ("none", "d4", 0.04, 2)], "src string, domain string, target_share double, max_repeats int")
    return pairs, mix, M.mixture(pairs, mix)


def test_shares(mixed):
    pairs, mix, out = mixed
    r = {x.src: x for x in M.shares(pairs, mix, out).collect()}
    assert r["c"].most_copies == 4 and r["c"].used == r["c"].records
    assert r["none"].actual_share == 0 and r["unlisted"].size == 0 and r["unlisted"].target_share == 0
    assert r["a"].most_copies <= 1 and r["b"].most_copies <= 3
    assert sum(x.actual_share for x in r.values()) == pytest.approx(1)
    whole = sum(r[s].available for s in ("a", "b", "c"))
    want = M.copies({s: float(r[s].available) for s in ("a", "b", "c")}, {s: r[s].target_share for s in ("a", "b", "c")}, {s: r[s].max_repeats for s in ("a", "b", "c")})
    for s in ("a", "b", "c"):
        assert abs(r[s].size - want[s] * r[s].available) <= 60
    assert abs(sum(x.size for x in r.values()) - whole) <= 180


def test_each_record_once(mixed, spark, monkeypatch):
    pairs, mix, out = mixed
    got = rows(out, "row_id")
    assert len(got) == len(set(got)) and (9001,) not in got and (9002,) not in got
    monkeypatch.setattr(M, "FAN_IN", 2)  # a tree of several levels
    deep = M.mixture(pairs, mix)
    assert sorted(rows(deep, "row_id")) == sorted(got)
    a, b = ({r.src: r["sum(t)"] for r in x.selectExpr("src", "size * copies t").groupBy("src").sum("t").collect()} for x in (out, deep))
    assert all(abs(a[s] - b[s]) <= 60 for s in a)


def test_empty_tables(mixed):
    pairs, mix, _ = mixed
    assert M.mixture(pairs.limit(0), mix).count() == 0 and M.mixture(pairs, mix.limit(0)).count() == 0

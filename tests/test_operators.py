"""Relational operators on small fixtures, against plain Python where SQL doesn't reach."""

from __future__ import annotations

import random

import numpy as np
import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from corpusloom.functions import wordlists as W
from corpusloom.operators import dedup as D
from corpusloom.operators import extract as E
from corpusloom.operators import joins as J
from corpusloom.operators import metrics as M
from corpusloom.operators import retrieval as R
from corpusloom.operators import sampling as L
from corpusloom.operators import sets as Z
from corpusloom.operators import windows as N
from tests.conftest import rows

slow = settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])


# ---- deduplication


def test_keep_first_is_first_and_idempotent(spark):
    df = spark.createDataFrame([(1, "A "), (2, "a"), (3, None), (4, "b"), (5, " "), (6, "B")], "i int, t string")
    out = D.by_text(df, "t", ["i"])
    assert rows(out, "i") == [(1,), (4,)]
    assert rows(D.by_text(out, "t", ["i"])) == rows(out)
    assert rows(D.keep_first(df, F.col("t"), ["i"]), "i") == [(1,), (2,), (3,), (4,), (5,), (6,)]


def test_conversations_and_pools(spark):
    s = "k int, messages array<struct<role:string,content:string>>"
    df = spark.createDataFrame([(1, [("user", " Hi")]), (2, [("user", "hi ")]), (3, [("user", "hi"), ("user", None)]), (4, [])], s)
    assert rows(D.by_conversation(df, "messages", ["k"]), "k") == [(1,), (3,), (4,)]
    a, b = spark.createDataFrame([(9, "x")], "i int, q string"), spark.createDataFrame([(1, "X"), (2, "y")], "i int, q string")
    assert rows(D.across_pools([a, b], ["q"], ["i"]), "pool_rank", "i") == [(0, 9), (1, 2)]
    assert rows(D.prefer(a, b.withColumn("q", F.lower("q")), "q"), "i") == [(2,), (9,)]


def test_fuzzy_records(spark):
    df = spark.createDataFrame([(1, "Robert Smith", "x"), (2, "Robert Smyth", "x"), (3, "Jane Doe", "x"), (4, "robert smith", "x"), (5, None, "x"), (6, "Robert Smith", "x")], "i int, name string, b string")
    got = dict(rows(D.fuzzy_groups(df, "i", ["name"], 0.8, F.col("b"))))
    assert got == {1: 1, 2: 1, 3: 3, 4: 1, 5: 5, 6: 1}
    exact = dict(rows(D.fuzzy_groups(df, "i", ["name"], 1.0, F.col("b"))))
    assert exact == {1: 1, 2: 2, 3: 3, 4: 1, 5: 5, 6: 1}


def test_fuzzy_records_against_brute_force(spark):
    rng = random.Random(3)
    names = ["".join(rng.choice("ab") for _ in range(rng.randint(3, 7))) for _ in range(40)]
    df = spark.createDataFrame([(i, n, "b") for i, n in enumerate(names)], "i int, name string, b string")
    group = [-1] * len(names)
    for i in range(len(names)):
        if group[i] < 0:
            group[i] = i
            for j in range(i + 1, len(names)):
                if group[j] < 0 and D._similar((names[i],), (names[j],), 0.75):
                    group[j] = i
    assert dict(rows(D.fuzzy_groups(df, "i", ["name"], 0.75, F.col("b")))) == dict(enumerate(group))


def test_fuzzy_records_query_compares_all(spark, tmp_path):
    """d08_fuzzy_records against a greedy pass over all rows: parts of different brands join too."""
    rng = random.Random(5)
    parts = [(1, "Brand#12", "SMALL"), (2, "Brand#34", "SMALL"), (3, None, "SMALL"), (4, "Brand#12", None)]
    parts += [(i, f"Brand#{rng.randint(1, 25)}", rng.choice(["SMALL", "LARGE", "PROMO", "STANDARD"])) for i in range(5, 120)]
    spark.createDataFrame(parts, "p_partkey long, p_brand string, p_type string").write.parquet(str(tmp_path / "part.parquet"))
    similar = lambda a, b: sum(1.0 if x == y else 0.0 if None in (x, y) else D._edit(x.lower(), y.lower(), 0.0) for x, y in zip(a, b, strict=True)) / 2 >= 0.85 - 1e-12
    group: dict[int, int] = {}
    for n, (i, *a) in enumerate(parts):
        if i not in group:
            group.update({j: i for j, *b in parts[n:] if j not in group and similar(a, b)})
    from corpusloom.plans.queries import QUERIES

    assert group[2] == 1 and dict(rows(QUERIES["d08_fuzzy_records"](spark, str(tmp_path)))) == group


# ---- joins


def test_lookups(spark):
    a = spark.createDataFrame([("q1 ", 1), ("zz", 2), (None, 3)], "t string, i int")
    pool = spark.createDataFrame([("q1", "late", 2), ("q1", "early", 1)], "t string, s string, o int")
    assert rows(J.first_source(a, pool, "t", "s", ["o"]), "i", "found") == [(1, "early"), (2, None), (3, None)]
    assert rows(J.not_done(a, spark.createDataFrame([("zz",)], "t string"), "t"), "i") == [(1,), (3,)]
    x, y = spark.createDataFrame([("a", "1"), ("b", "1"), ("c", None)], "p string, h string"), spark.createDataFrame([("b", "2"), ("c", None), ("d", "1")], "p string, h string")
    assert rows(J.reconcile(x, y, "p", "h")) == [("a", "removed"), ("b", "updated"), ("c", "unchanged"), ("d", "added")]
    base = spark.createDataFrame([(1, True, 1), (1, False, 2), (2, True, 1)], "id int, ok boolean, o int")
    cand = spark.createDataFrame([(1, True, 1), (2, False, 1)], "id int, ok boolean, o int")
    assert rows(J.compare_runs(base, cand, "id", "ok", "o")) == [(1, "improvement"), (2, "regression")]
    assert [r.key for r in J.numbered(spark.range(50).repartition(7), "m", ["id"]).orderBy("id").collect()] == [f"m:{i + 1}" for i in range(50)]


# ---- metrics


@slow
@given(st.lists(st.integers(-5, 5), min_size=1, max_size=30), st.sampled_from([0.1, 0.5, 0.9, 1.0]))
def test_percentile_by_floor_index(spark, values, q):
    df = spark.createDataFrame([("g", v) for v in values], "g string, v int")
    want = sorted(values)[min(len(values) - 1, int(len(values) * q))]
    got = M.percentiles(df, ["g"], "v", {"f": ("floor", q), "n": ("nearest", q), "i": ("interpolated", q)}).first()
    assert got.f == want and got.n == sorted(values)[max(0, int(np.ceil(round(len(values) * q, 9))) - 1)] and got.i == pytest.approx(float(np.quantile(values, q)))
    assert M.percentiles(df, [], "v", {"f": ("floor", q)}).first().f == want


def test_threshold_and_precision(spark):
    rng = np.random.default_rng(1)
    s, y = rng.random(300), rng.random(300) < 0.4
    got = M.tune_threshold(spark.createDataFrame([(float(a), bool(b)) for a, b in zip(s, y, strict=True)], "s double, y boolean"), "s", "y").first()

    def f1(t):
        p = s >= t - 1e-9
        return 2 * (p & y).sum() / max(1, p.sum() + y.sum())

    grid = [round(0.05 + 0.01 * i, 2) for i in range(91)]
    best = max(grid, key=lambda t: (round(f1(t), 12), -round(abs(t - 0.5), 6)))
    assert got.threshold == pytest.approx(best) and got.f1 == pytest.approx(f1(best))


def test_rewards(spark):
    ok = "<start_working_out>x<end_working_out><SOLUTION>{}</SOLUTION>"
    df = spark.createDataFrame([(ok.format("5"), "5"), (ok.format(" 5"), "5"), (ok.format("5.2"), "5"), (ok.format("5.9"), "5"), (ok.format("9"), "5"), (ok.format("x"), "5"), ("none", "5")], "c string, t string")
    r = M.rewards(F.col("c"), F.col("t"))
    got = [tuple(x) for x in df.select(r["format"], r["approximate"], r["answer"], r["number"]).collect()]
    assert [g[2] for g in got] == [5.0, 3.5, 2.0, 1.5, -2.5, -4.5, -2.0]
    assert got[0] == (3.0, 2.0, 5.0, 3.5) and got[-1] == (0.0, -4.0, -2.0, -2.5)


def test_parameter_score_and_quota(spark):
    m = lambda d: F.create_map(*[F.lit(x) for kv in d.items() for x in kv])
    s = spark.range(1).select(M.parameter_score(F.lit(True), m({"a": "1", "z": "1"}), m({"a": "1", "b": "2"})).alias("s")).first().s
    assert s == pytest.approx(0.3 + 0.15 + 0.15 + 0.075)
    assert [r.quota for r in M.inverse_quota(spark.createDataFrame([(0.0,), (1.0,)], "s double"), "s", 100).orderBy("s").collect()] == [92, 8]


# ---- windows


@slow
@given(st.lists(st.tuples(st.integers(0, 40), st.integers(1, 9)), min_size=1, max_size=15))
def test_merged_intervals(spark, spans):
    df = spark.createDataFrame([("g", a, a + n) for a, n in spans], "g string, s int, e int")
    got = sorted((r.s, r.e) for r in N.merged_intervals(df, ["g"], "s", "e").collect())
    want: list[list[int]] = []
    for a, b in sorted((a, a + n) for a, n in spans):
        if want and a <= want[-1][1]:
            want[-1][1] = max(want[-1][1], b)
        else:
            want.append([a, b])
    assert got == [tuple(x) for x in want]


def test_free_slots(spark):
    t = lambda h, m=0: f"2026-01-05 {h:02d}:{m:02d}:00"

    def slots(busy, least=30):
        df = spark.createDataFrame([("d", a, b) for a, b in busy], "d string, a string, b string").select("d", F.expr("cast(a as timestamp_ntz) a"), F.expr("cast(b as timestamp_ntz) b"))
        return sorted(r.minutes for r in N.free_slots(df, ["d"], "a", "b", F.expr(f"timestamp_ntz '{t(8)}'"), F.expr(f"timestamp_ntz '{t(18)}'"), least).collect())

    day = [(t(9), t(9, 30)), (t(10), t(11)), (t(12), t(13)), (t(14), t(16))]
    assert slots(day) == [30, 60, 60, 60, 120]
    assert slots(day, 60) == [60, 60, 60, 120]
    assert slots([(t(7), t(19))]) == []
    assert slots([(t(9), t(10, 30)), (t(10), t(11))]) == [60, 420]


def test_greedy_share_against_a_loop(spark):
    rng = random.Random(5)
    data = [(i, rng.choice("ab"), rng.randint(1, 30)) for i in range(120)]
    df = spark.createDataFrame(data, "i int, g string, n int").withColumn("b", F.lit(100))
    got = {r.i for r in N.greedy_share(df, ["g"], "n", "b", ["i"]).collect()}
    want = set()
    for g in "ab":
        left = 100
        for i, _, n in sorted((r for r in data if r[1] == g), key=lambda r: (-r[2], r[0])):
            if n <= left:
                left -= n
                want.add(i)
    assert got == want


def test_turns(spark):
    s = "k int, messages array<struct<role:string,content:string>>, n array<int>"
    m = [("user", "a"), ("assistant", "b")] * 3
    df = spark.createDataFrame([(1, m, [1] * 6), (2, m, [1, 1, 1, 1, 9, 9]), (3, m, [9] * 6), (4, m[:2], [1, 1]), (5, None, None)], s)
    assert rows(df.select("k", F.size(N.trimmed_turns(F.col("messages"), F.col("n"), 10)).alias("n"))) == [(1, 6), (2, 4), (3, -1), (4, 2), (5, -1)] or rows(df.select("k", F.size(N.trimmed_turns(F.col("messages"), F.col("n"), 10)).alias("n"))) == [(1, 6), (2, 4), (3, None), (4, 2), (5, None)]
    pairs = spark.createDataFrame([(1, [[" ", "x"], ["a"], [" b ", "c"]]), (2, []), (3, None)], "k int, p array<array<string>>")
    assert rows(pairs.select("k", N.first_valid_pair(F.col("p")).alias("p")).select("k", "p.*")) == [(1, "b", "c"), (2, None, None), (3, None, None)]


def test_length_batches(spark):
    data = [(i, (i * 7) % 10) for i in range(50)]
    got = {r.i: r.batch for r in N.length_batches(spark.createDataFrame(data, "i int, n int"), "n", "i", 16).collect()}
    assert got == {i: k // 16 for k, (i, _) in enumerate(sorted(data, key=lambda r: (r[1], r[0])))}


# ---- sampling


def test_samples_keep_their_counts(spark):
    df = spark.range(400).select("id", F.when(F.col("id") % 4 == 0, "a").when(F.col("id") % 4 == 1, "b").otherwise("c").alias("g"))
    took = L.quotas(df, "g", {"a": 10, "b": 500}, F.col("id"), 1)
    assert rows(took.groupBy("g").count()) == [("a", 10), ("b", 100)]
    assert rows(took) == rows(L.quotas(df.repartition(9), "g", {"a": 10, "b": 500}, F.col("id"), 1))
    assert rows(L.shortage(took, "g", {"a": 10, "b": 500})) == [("a", 10, 10, 0), ("b", 500, 100, 400)]
    assert rows(L.stratified(df, "g", F.col("id"), 0.8, 1).groupBy("g", "split").count()) == [("a", "test", 20), ("a", "train", 80), ("b", "test", 20), ("b", "train", 80), ("c", "test", 40), ("c", "train", 160)]
    small = spark.createDataFrame([(1, "x"), (2, "y"), (3, "y"), (4, "z"), (5, "z"), (6, "z")], "id int, g string")
    got = {g: sorted(s for _, s in x) for g, x in ((g, [r for r in rows(L.three_way(small, "g", F.col("id"), 1), "g", "split") if r[0] == g]) for g in "xyz")}
    assert got == {"x": ["train"], "y": ["test", "train"], "z": ["eval", "test", "train"]}
    assert L.reinforced(small, F.lit(3)).count() == 18
    assert 20 < L.uniform_split(spark.range(1000), F.col("id"), 0.05).where("split = 'test'").count() < 85
    kept = L.demote_and_cap(df, F.col("g") == "c", F.col("g") == "a", 0.12, F.col("id"), 1)
    assert rows(kept.groupBy("g").count()) == [("a", 100), ("b", 100), ("c", 12)]


# ---- sets, extraction, retrieval


def test_sets(spark):
    a = spark.createDataFrame([(1, "x")], "i int, t string")
    assert rows(Z.union_tagged({"a": a, "b": spark.createDataFrame([(2,)], "i int")}), "src", "i", "t") == [("a", 1, "x"), ("b", 2, None)]
    assert rows(Z.missing_from(spark.createDataFrame([("a",), ("b",), ("b",), (None,)], "k string"), spark.createDataFrame([("a",)], "k string"), "k")) == [("b",), (None,)]


def test_findings(spark):
    text = "first\nSSN 123-45-6789\nmail john.doe@example.com\ncall (555) 123-4567\ncard 4111 1111 1111 1111\nno card 4111 1111 1111 1112"
    df = spark.createDataFrame([(1, text), (2, None), (3, "")], "d int, t string")
    got = {(r.line, r.kind, r.masked) for r in E.findings(df, "d", "t", W.PII).collect()}
    assert {(x, k) for x, k, _ in got} >= {(2, "ssn"), (3, "email"), (4, "phone"), (5, "credit_card")}
    assert not any(k == "credit_card" and x == 6 for x, k, _ in got)
    assert all("123-45-6789" not in m and "4111 1111" not in m for _, _, m in got)


def test_fields_times_and_slots(spark):
    t = "Invoice 42\nName: John Doe\ntotal $125.50 on 2026-01-15, ask support@example.com or +1 555 123 4567"
    df = spark.createDataFrame([(t,)], "t string")
    f = lambda n: tuple(df.select(E.extract_field(F.col("t"), n).alias("x")).first().x)
    assert f("total") == ("125.50", 0.8) and f("date") == ("2026-01-15", 0.9) and f("email") == ("support@example.com", 0.9)
    assert f("name") == ("John Doe", 0.6) and f("missing") == (None, 0.0)
    now = F.expr("timestamp_ntz '2026-01-05 22:30:00'")
    at = lambda s: str(spark.range(1).select(E.time_expression(F.lit(s), now).alias("x")).first().x)
    assert at("for 2 hours") == "2026-01-06 00:30:00" and at("until tomorrow") == "2026-01-06 08:00:00" and at("tonight") == "2026-01-06 21:00:00"
    assert at("until 6:15pm") == "2026-01-06 18:15:00" and at("until 11pm") == "2026-01-05 23:00:00" and at("whenever") == "None"


def test_html_json_and_reports(spark):
    one = lambda v, col: spark.createDataFrame([(v,)], "t string").select(col.alias("x")).first().x
    assert one("<style>p{}</style><p>a&amp;b</p>\n<script>x()</script> c", E.html_text(F.col("t"))) == "a&amp;b c"
    assert one('say ```json\n{"k": 5}\n```', E.json_field(F.col("t"), "$.k")) == "5"
    assert one("## Tasks\n```\nid  name  ok\n1  a b  yes\n```\n## Breakdown", E.report_rows(F.col("t"))) == [["id", "name", "ok"], ["1", "a b", "yes"]]


def test_cosine_and_top_k(spark):
    rng = np.random.default_rng(2)
    v = rng.standard_normal((120, 8)).astype(np.float32)
    df = spark.createDataFrame([(i, [float(x) for x in r]) for i, r in enumerate(v)], "id long, v array<float>").repartition(5)
    n = v / np.linalg.norm(v, axis=1, keepdims=True)
    got = {(r.query, r.rank): r.id for r in R.top_k_each(df, "id", "v", df.where("id % 50 = 0"), 4).collect()}
    for q in (0, 50, 100):
        s = np.round((n.astype(np.float64) @ n[q].astype(np.float64)), 6)
        s[q] = -9
        want = sorted(range(120), key=lambda i: (-s[i], i))[:4]
        assert [got[q, k + 1] for k in range(4)] == want
    assert rows(R.top_k_each(df, "id", "v", df.where("id % 50 = 0"), 4, block=1)) == rows(R.top_k_each(df, "id", "v", df.where("id % 50 = 0"), 4))
    z = spark.createDataFrame([([0.0, 0.0], [1.0, 0.0])], "a array<double>, b array<double>")
    assert z.select(R.cosine(F.col("a"), F.col("b")).alias("x")).first().x == 0.0
    with pytest.raises(Exception, match="lengths"):
        spark.range(1).select(R.cosine(F.array(F.lit(1.0)), F.array(F.lit(1.0), F.lit(2.0)))).collect()


def test_bm25_against_a_loop(spark):
    import math

    docs = [(1, "night bus clean"), (2, "night market"), (3, "bus bus bus stop"), (4, None), (5, "nothing here at all")]
    got = dict(rows(R.bm25(spark.createDataFrame(docs, "i int, t string"), "i", {"t": 1}, "night bus bus", W.STOPWORDS)))
    terms = {i: [x for x in (t or "").split() if x not in W.STOPWORDS] for i, t in docs}
    avg = sum(map(len, terms.values())) / len(terms)
    want = {}
    for i, t in terms.items():
        s = 0.0
        for q in ("night", "bus", "bus"):
            d = sum(q in x for x in terms.values())
            f = t.count(q)
            s += math.log((len(terms) - d + 0.5) / (d + 0.5) + 1) * f * 2.5 / (f + 1.5 * (1 - 0.75 + 0.75 * len(t) / avg))
        if s > 0:
            want[i] = s
    assert got.keys() == want.keys() and all(got[k] == pytest.approx(want[k]) for k in want)


def test_faithfulness_and_keywords(spark):
    f = lambda a, s: spark.createDataFrame([(a, s)], "a string, s string").select(R.faithfulness(F.col("a"), F.col("s"), W.STOPWORDS).alias("x")).first().x
    assert f("red bus stops here", "the red bus stops there") is True
    assert f("one two three", "four five six") is False and f("word", "word") is False and f("x y", None) is True
    kb = spark.createDataFrame([(1, ["night bus", "late"]), (2, ["day"]), (3, ["bus"])], "i int, k array<string>")
    assert rows(R.keyword_match(kb, "i", "k", "a late night bus"))[0][:2] == (1, 3.0)
    assert rows(R.keyword_match(kb, "i", "k", "nothing")) == []


def test_codes_sections_and_trees(spark):
    from corpusloom.functions import text as X
    from corpusloom.operators import gates as G

    one = lambda v, col, kind="string": spark.createDataFrame([(v,)], f"t {kind}").select(col.alias("x")).first().x
    places = [("DEL", "New Delhi"), ("BOM", "Mumbai")]
    assert [one(v, X.code_of(F.col("t"), places)) for v in ("bom", "to mumbai please", "xyz", None)] == ["BOM", "BOM", "XYZ", None]
    assert one(["a", None, "b"], X.paragraphs(F.col("t")), "array<string>") == "a\n\nb"
    assert one("a\nb\n\n \n\nc", E.sections(F.col("t"))) == ["a\nb", "c"]
    assert one("\n".join("abcdefg"), E.sections(F.col("t"))) == ["a\nb\nc\nd\ne", "f\ng"]
    tree = spark.createDataFrame([(1, None, "root"), (2, 1, "leaf"), (3, 9, "lost")], "id int, up int, n string")
    assert rows(J.with_parent_row(tree, "id", "up", ["n"]), "id", "parent_n") == [(1, None), (2, "root"), (3, None)]
    s = "messages array<struct<role:string,content:string>>"
    make = lambda last: [("system", "s"), ("user", "u"), ("assistant", last)]
    df = spark.createDataFrame([(make("[f(a=1)]"),), (make("f"),), (make("[g()]"),), ([("user", "u")],), (None,)], s)
    assert [r[0] for r in df.select(G.example_reason(F.col("messages"), ["f"])).collect()] == [None, "call", "tool", "roles", "roles"]
    assert [r[0] for r in df.select(G.prompt_fits(F.col("messages"), 9)).collect()][:3] == [False, True, True]


def test_chance_rank_is_a_plain_rank(spark):
    from pyspark.sql import Window

    df = spark.range(3000).select("id", F.when(F.col("id") % 3 > 0, "hot").alias("g"))
    plain = F.row_number().over(Window.partitionBy("g").orderBy(L.chance_order(F.col("id"), 5), "id"))
    assert rows(L.chance_rank(df, ["g"], F.col("id"), 5), "id", "_rank") == rows(df.withColumn("_rank", plain), "id", "_rank")


# ---- hot groups


def test_places_and_neighbours_in_ranges(spark, request):
    """One group of nine tenths of all rows, cut into ranges: places, running sums and neighbours are those of a plain sort; nulls are a group of their own."""
    from corpusloom.operators import ranks

    rng = np.random.default_rng(5)
    data = [("hot" if rng.random() < 0.9 else None if rng.random() < 0.3 else "cold", int(i), None if rng.random() < 0.2 else f"v{i}") for i in rng.permutation(3000)]
    df = spark.createDataFrame(data, "g string, i long, v string").repartition(7)
    # So few rows would be put into one range.
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    request.addfinalizer(lambda: spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled"))
    s = ranks.ranged(df, ["g"], ["i"])
    assert s.where("g = 'hot'").select("_p").distinct().count() > 2
    sizes = sorted(r["count"] for r in s.groupBy("_p").count().collect())
    assert sizes[-1] < 2 * sizes[len(sizes) // 2]
    want = {}
    for g in {d[0] for d in data}:
        rows_ = sorted((d for d in data if d[0] == g), key=lambda d: d[1])
        for k, d in enumerate(rows_):
            want[d[1]] = (k + 1, sum(x[1] for x in rows_[: k + 1]), rows_[k - 1][2] if k else None, rows_[k + 1][2] if k + 1 < len(rows_) else None)
    place = {r.i: r._place for r in ranks.place(df, ["g"], ["i"]).collect()}
    total = {r.i: r._upto for r in ranks.running(df, ["g"], ["i"], "i").collect()}
    near = {r.i: (r._previous, r._next) for r in ranks.neighbours(df, ["g"], ["i"], "v").collect()}
    assert {i: (place[i], total[i], *near[i]) for i in want} == want and len(place) == len(data)
    assert [r._place for r in ranks.place(df, [], ["i"]).orderBy("i").collect()] == list(range(1, 3001))
    assert ranks.place(df.limit(0), ["g"], ["i"]).count() == 0


def test_hot_key_operators_equal_the_plain_ones(spark):
    rng = np.random.default_rng(6)
    data = [("hot" if rng.random() < 0.9 else f"k{rng.integers(5)}", int(i), int(rng.integers(1, 9))) for i in range(800)]
    df = spark.createDataFrame(data, "g string, i long, n long")
    by = {g: sorted((d for d in data if d[0] == g), key=lambda d: d[1]) for g in {d[0] for d in data}}
    assert {r.i: r.variant for r in N.variants(df, ["g"], ["i"], 3).collect()} == {d[1]: k % 3 for rows_ in by.values() for k, d in enumerate(rows_)}
    v = {r.i: r.view for r in N.compressed_history(df, ["g"], "i", "n", 4, F.lit(-1)).collect()}
    assert v == {d[1]: (d[2] if k >= len(rows_) - 4 else -1) for rows_ in by.values() for k, d in enumerate(rows_)}
    b = {r.i: r.batch for r in N.length_batches(df, "n", "i", 16).collect()}
    assert b == {d[1]: k // 16 for k, d in enumerate(sorted(data, key=lambda d: (d[2], d[1])))}
    kept = {r.i for r in N.greedy_share(df.withColumn("b", F.lit(100)), ["g"], "n", "b", ["i"]).collect()}
    want = set()
    for rows_ in by.values():
        left = 100
        for d in sorted(rows_, key=lambda d: (-d[2], d[1])):
            if d[2] <= left:
                left -= d[2]
                want.add(d[1])
    assert kept == want


def test_neighbours_of_keys_fill_from_a_ring(spark):
    pool = spark.createDataFrame([(f"p{i}",) for i in range(9)] + [("p1",), (None,)], "item string")
    wanted = spark.createDataFrame([("a", ["p1", "x"]), ("b", []), ("c", None), ("d", ["p1", "p2", "p3", "p4", "p5"])], "k string, near array<string>")
    got = {}
    for r in J.fill_neighbours(wanted, "k", "near", pool, "item", 4).collect():
        got.setdefault(r.k, {})[r["rank"]] = r["item"]
    assert all(sorted(g) == [1, 2, 3, 4] and len(set(g.values())) == 4 for g in got.values())
    assert (got["a"][1], got["a"][2]) == ("p1", "x") and [got["d"][i] for i in range(1, 5)] == ["p1", "p2", "p3", "p4"]
    assert J.fill_neighbours(wanted, "k", "near", pool.limit(0), "item", 4).count() == 2 + 4


def test_meetings(spark):
    text = "Ann: Hi.\nBob: AI: @Zoë fix it by May 5; asap\n\nwe need to figure out why\nI'll pay"
    df = spark.createDataFrame([(1, text), (1, text), (2, None), (3, " \n "), (4, "todo: \nnothing here")], "d int, t string")
    got = [tuple(r) for r in E.meeting_items(df, "d", "t").orderBy("d", "line", "kind").collect()]
    one = [
        (1, 2, "action", "Zoë", "@Zoë fix it by May 5; asap", "May 5", "high", "Ann: Hi. Bob: AI: @Zoë fix it by May 5; asap"),
        (1, 4, "question", None, "we need to figure out why", None, None, "we need to figure out why I'll pay"),
        (1, 5, "commitment", "Bob", "pay", "", None, "we need to figure out why I'll pay"),
    ]
    need = [(1, 4, "action", "Bob", "we need to figure out why", "", "medium", "we need to figure out why I'll pay")]
    assert sorted(got, key=str) == sorted([x for x in (*one, *need) for _ in range(2)], key=str)
    m = {r.d: r.minutes for r in E.minutes(df.where("d > 1"), "d", "t").collect()}
    assert m[2] == m[3] == "## Meeting Minutes\n\nNo transcript content provided.\n" and "- (no speakers identified)" in m[4] and "**Topic 1**\n\ntodo: \nnothing here\n" in m[4]
    assert E.meeting_items(df.limit(0), "d", "t").count() == 0

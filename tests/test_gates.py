"""Gates on literal rows, reasons included."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from corpusloom.operators import gates as G
from tests.conftest import rows

GOOD_HI = "भारत की राजधानी नई दिल्ली है और यह शहर यमुना नदी के किनारे बसा हुआ है। यहाँ संसद भवन, राष्ट्रपति भवन और कई ऐतिहासिक इमारतें हैं, जिन्हें देखने हर साल लाखों लोग आते हैं।"
Q_HI = "भारत की राजधानी कौन सी है?"


def reason(spark, column, **values):
    return spark.createDataFrame([tuple(values.values())], ", ".join(f"{k} string" for k in values)).select(column.alias("r")).first().r


def accept(spark, r, q=Q_HI, target="hindi", budget="medium"):
    return reason(spark, G.acceptance(F.col("r"), F.col("q"), F.col("t"), F.col("b")), r=r, q=q, t=target, b=budget)


def test_acceptance(spark):
    assert accept(spark, GOOD_HI) is None
    assert accept(spark, GOOD_HI.rstrip("।")) == "truncated"
    assert accept(spark, "नई दिल्ली।", budget="short") == "below-budget"
    assert accept(spark, "भारत दिल्ली है। " * 12) == "repetitive"
    assert accept(spark, "This is an answer in plain English that goes on for quite a while so that it has more than twenty words in it, and ends.", "kya hai yeh cheez", "hindi") in ("not_devanagari", "unrelated")
    assert accept(spark, "mujhe nahi pata ki kya hai.", "kya hai", "hinglish") == "refusal"
    assert accept(spark, None) == "truncated"


def test_language_gate_is_anchored(spark):
    g = G.language_gate(F.col("r"), "hindi")
    for t in ("दिल्ली", "कायम रहो", "कार्य", "अच्छे लोग"):
        assert reason(spark, g, r=t) is None
    assert reason(spark, g, r="हे आहे आणि ते नाही") == "marathi_dominated(3>0)"
    assert reason(spark, g, r="झाले है और में") is None
    assert reason(spark, g, r="maps dekhkar疆域 samajhiye") == "foreign_script"
    assert reason(spark, g, r=" ") == "empty"
    assert reason(spark, g, r=None) == "empty"
    assert reason(spark, G.language_gate(F.col("r"), "hinglish"), r="tumhala aahe ka") == "marathi_romanised"


def test_dangling(spark):
    assert reason(spark, G.dangling(F.col("r")).cast("string"), r="यह किताब और") == "true"
    assert reason(spark, G.dangling(F.col("r")).cast("string"), r="उस घर के") == "false"
    assert reason(spark, G.dangling(F.col("r"), True).cast("string"), r="उस घर के") == "true"
    assert reason(spark, G.dangling(F.col("r")).cast("string"), r="one, two,") == "true"
    assert reason(spark, G.dangling(F.col("r")).cast("string"), r="it ends with the") == "true"
    assert reason(spark, G.dangling(F.col("r")).cast("string"), r="it ends.") == "false"


def test_corpus_quality_order(spark):
    g = G.corpus_quality(F.col("r"))
    base = " ".join(f"शब्द{chr(0x915 + i % 30)}{chr(0x915 + i // 30)}" for i in range(60))
    assert reason(spark, g, r="छोटा") == "short"
    assert reason(spark, g, r="") == "short"
    assert reason(spark, G.corpus_quality(F.col("r"), min_words=0), r="") == "empty"
    assert reason(spark, g, r=base) is None
    assert reason(spark, g, r=base + " বাংলা") == "bengali"
    assert reason(spark, g, r=base + " ★") == "symbols"
    assert reason(spark, g, r=base + " हहहहहहहह") == "repeat"
    assert reason(spark, g, r=base + " see www.x.com") == "url"
    assert reason(spark, g, r=base + " 1234567") == "digits"
    assert reason(spark, g, r="a b c " * 20) == "not_devanagari"
    assert reason(spark, g, r=base + " आहे आणि") == "marathi"
    assert reason(spark, g, r=base + " the and is of to in") == "english"
    assert reason(spark, g, r="क ख ग " * 20) == "loopy"


def test_pair_gates(spark):
    i, o = F.col("i"), F.col("o")
    assert reason(spark, G.pair_basic(i, o), i="tell me more", o="I'm sorry, no") == "refusal"
    assert reason(spark, G.pair_basic(i, o), i="I'm sorry to ask", o="fine then") is None
    assert reason(spark, G.pair_strict(i, o), i="I'm sorry to ask", o="fine then") == "refusal"
    assert reason(spark, G.pair_basic(i, o), i="नमस्ते जी", o="fine") == "script"
    assert reason(spark, G.pair_basic(i, o), i="one", o="fine") == "prompt_words"
    assert reason(spark, G.pair_strict(i, o), i="two words", o="```x```") == "fence"
    assert reason(spark, G.pair_strict(i, o), i=None, o="x y") == "empty"
    assert reason(spark, G.pair_scripted(i, o, None), i="नमस्ते जी", o="plain words") == "script"


def test_conversations(spark):
    schema = "k string, messages array<struct<role:string,content:string>>"
    u, a = ("user", "q"), ("assistant", "r")
    data = [("ok", [u, a]), ("ends", [u, a, u]), ("starts", [a, u, a]), ("twice", [u, u, a]), ("blank", [u, ("assistant", " ")]), ("first", [("user", "疆"), ("assistant", "")]), ("none", []), ("null", None)]
    got = dict(rows(spark.createDataFrame(data, schema).select("k", G.conversation(F.col("messages")))))
    assert got == {"ok": None, "ends": "ends_on_user", "starts": "starts_on_assistant", "twice": "not_alternating", "blank": "empty", "first": "foreign_script", "none": "empty", "null": "empty"}


def test_conversation_votes(spark):
    schema = "messages array<struct<role:string,content:string,deleted:boolean,labels:map<string,double>>>"
    make = lambda deleted, labels: ([("user", "q", False, None), ("assistant", "r", deleted, labels)],)
    data = [make(True, None), make(None, {"spam": 0.5}), make(None, {"quality": 0.4}), make(None, {"quality": 0.6, "spam": 0.33})]
    got = [r[0] for r in spark.createDataFrame(data, schema).select(G.conversation(F.col("messages"), votes=True)).collect()]
    assert got == ["deleted", "human_label_reject", "low_quality_vote", None]


def test_anomalies(spark):
    df = spark.createDataFrame([(0, "10"), (1, "11"), (2, "9"), (3, "10"), (4, "10"), (5, "100"), (6, ""), (7, None), (8, "x")], "i int, v string")
    r = rows(G.anomalies(df, "i", [{"rule": "z_score", "field": "v"}, {"rule": "missing", "field": "v"}, {"rule": "range", "field": "v", "min": 9.5, "max": 50}, {"rule": "pattern", "field": "v", "pattern": r"^\d*$"}]), "i", "rule", "detail")
    assert r == sorted([(5, "z_score", "outlier"), (6, "missing", "missing"), (7, "missing", "missing"), (2, "range", "below minimum"), (5, "range", "above maximum"), (8, "pattern", "no match")], key=str)
    assert {x["rule"] for x in G.auto_rules(df)} == {"z_score", "missing"}


def test_prompts(spark):
    ok = lambda t, k: reason(spark, G.standalone_prompt(F.col("r"), k).cast("string"), r=t)
    assert ok("What is the capital of France?", "english") == "true"
    assert ok("Is it so", "english") == "false"
    assert ok("What about this and", "english") == "false"
    assert ok("As you said what is this thing", "english") == "false"
    assert ok("भारत की राजधानी का नाम क्या है?", "hindi") == "true"
    assert ok("kya haal hai mere bhai", "romanised") == "true"
    assert reason(spark, G.generated_prompt_language(F.col("r")), r="1. भारत क्या है") == "hi"


def test_facts_and_judges(spark):
    df = spark.createDataFrame([("The capital is DELHI", ["delhi"], "Score: 4"), ("x", None, "none"), (None, ["a"], "5")], "a string, g array<string>, j string")
    assert [tuple(r) for r in df.select(G.contains_fact(F.col("a"), F.col("g")), G.judged(F.col("j"))).collect()] == [(True, True), (False, False), (False, True)]


def test_release_assertion(spark):
    df = spark.createDataFrame([("ठीक है और", "hindi")], "response string, lang string")
    G.assert_release(df, 1)
    with pytest.raises(AssertionError):
        G.assert_release(df, 2)

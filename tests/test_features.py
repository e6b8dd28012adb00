"""Scalar features on literal rows."""

from __future__ import annotations

import unicodedata

import pytest
from pyspark.sql import functions as F

from corpusloom.functions import text as X
from corpusloom.functions import udfs as U
from corpusloom.functions import wordlists as W


def one(spark, value, column, name="t", kind="string"):
    return spark.createDataFrame([(value,)], f"{name} {kind}").select(column.alias("v")).first().v


# text, length, words, share of text, of letters, of letters and signs
CASES = [("हिन्दी में test करो।", 20, 4, 0.65, 0.6, 0.7647), ("नमस्ते, आप कैसे हैं?", 20, 4, 0.75, 1.0, 1.0), ("kaise ho bhai", 13, 3, 0, 0, 0), ("भारत 2023", 9, 2, 0.4444, 1.0, 1.0)]


@pytest.mark.parametrize("case", CASES)
def test_script_shares_and_words(spark, case):
    t, length, words, f1, f2, f3 = case
    c = F.col("t")
    r = spark.createDataFrame([(t,)], "t string").select(F.length(c).alias("n"), X.word_count(c).alias("w"), X.script_share_of_text(c).alias("a"), X.script_share_of_letters(c).alias("b"), X.script_share_of_marked(c).alias("c")).first()
    assert (r.n, r.w) == (length, words)
    assert [round(x, 4) for x in (r.a, r.b, r.c)] == [round(x, 4) for x in (f1, f2, f3)]


def test_empty_and_null_texts(spark):
    c = F.col("t")
    r = spark.createDataFrame([("",), (None,)], "t string").select(X.script_share_of_text(c).alias("a"), X.word_count(c).alias("w"), X.trigram_uniqueness(X.words(c)).alias("u"), X.prose_tokens(c).alias("p")).collect()
    assert tuple(r[0]) == (0.0, 0, None, 0)
    assert r[1].a is None and r[1].p is None


def test_trigram_uniqueness(spark):
    assert one(spark, "a b c a b c a b c", X.trigram_uniqueness(X.words(F.col("t")))) == pytest.approx(3 / 7)
    assert one(spark, "a b", X.trigram_uniqueness(X.words(F.col("t")))) is None


def test_white_space_is_as_in_python(spark):
    t = "a b\x1cc　d\te\n f​g"
    assert one(spark, t, X.word_count(F.col("t"))) == len(t.split())


def test_word_boundary_is_as_in_python(spark):
    import re

    for t in ("के लिए और", "और", "के", "the end", "athe", "x और।", "औरत"):
        got = one(spark, t, F.regexp_count("t", F.lit(X.pyregex(r"\b(?:और|के|the)\b", True))))
        assert got == len(re.findall(r"\b(?:और|के|the)\b", t, re.I)), t


def test_masks_cards_and_similarity(spark):
    c = F.col("t")
    assert one(spark, "4111 1111 1111 1111", X.is_card_number(c)) is True
    assert one(spark, "4111 1111 1111 1112", X.is_card_number(c)) is False
    assert one(spark, "123", X.is_card_number(c)) is False
    assert one(spark, "abcdyz", X.masked(c)) == "ab**yz"
    assert one(spark, "abcd", X.masked(c)) == "****"
    assert one(spark, "Robert Smith", X.edit_similarity(c, F.lit("Robert Smyth"))) == pytest.approx(0.9167, abs=1e-4)
    assert one(spark, "", X.edit_similarity(c, F.lit(" "))) == 1.0


def test_boxes_and_grids(spark):
    c = F.col("t")
    assert one(spark, "<10><20><30><40>", X.parse_box(c)) == [0.1, 0.2, 0.3, 0.4]
    assert one(spark, "<30><20><10><40>", X.parse_box(c)) is None
    assert one(spark, "<1><2><3>", X.parse_box(c)) is None
    g = one(spark, 10.0, X.grid_points(c, F.lit(20.0), F.lit(4.0), 5), kind="double")
    assert len(g) == 5 and g[4].i == 4
    assert one(spark, [0.1, 0.2, 1.5, 0.2, 1.5, 0.9, 0.1, -1.0], X.corner_box(c), kind="array<double>") == [0.1, 0.0, 1.0, 0.9]


def test_multi_hot_raises_on_unknown_labels(spark):
    c = F.col("t")
    assert one(spark, ["b", None], X.multi_hot(c, ["a", "b"]), kind="array<string>") == [0.0, 1.0]
    with pytest.raises(Exception, match="unknown label"):
        one(spark, ["z"], X.multi_hot(c, ["a", "b"]), kind="array<string>")


def test_search_terms(spark):
    assert one(spark, "How do I restart the Wi-Fi routers in rooms 12b? testing tested", X.search_terms(F.col("t"), W.STOPWORDS)) == ["restart", "wifi", "router", "room", "12", "test", "test"]


def test_query_moods(spark):
    for t, want in (("Open settings", "navigate"), ("restart it now", "imperative"), ("what is this", "question"), ("it broke", "statement")):
        assert one(spark, t, X.query_mood(F.col("t"))) == want


def test_udfs(spark):
    assert one(spark, "क़", U.nfc("t")) == unicodedata.normalize("NFC", "क़")
    assert one(spark, "a+b%2520c%zz", U.percent_decoded("t")) == "a+b c%zz"
    assert one(spark, "अआइ", U.utf8_prefix(4)("t")) == "अ"
    assert one(spark, "abc " * 30, U.ends_in_loop("t")) is True
    assert one(spark, "a normal sentence that says something once and only once, no more than that.", U.ends_in_loop("t")) is False
    assert one(spark, "p1\n\np2\n\n" + "x" * 30, U.chunks(10)("t")) == ["p1\n\np2", "x" * 10, "x" * 10, "x" * 10]
    assert one(spark, "mail a@b.co or 123-45-6789", U.redacted("t")) == "mail [REDACTED-email] or [REDACTED-ssn]"
    assert one(spark, "a,b\n1,2", U.table_rows("t")) == [["a", "b"], ["1", "2"]]
    assert one(spark, "| a | b |\n|---|---|\n| 1 | 2 |", U.table_rows("t")) == [["a", "b"], ["1", "2"]]
    assert '"name": "f"' in one(spark, "<think>no</think>[f(a=1)]", U.tool_call("t"))
    assert '"name": "g"' in one(spark, 'text {"name": "g", "arguments": {"x": 1,}}', U.tool_call("t"))
    assert one(spark, "no call", U.tool_call("t")) is None
    assert one(spark, "acct # 123456 or account number is 1234567890, call 555-123-4567", U.redacted("t")) == "[REDACTED-accountNumber] or [REDACTED-accountNumber], call [REDACTED-phone]"
    assert one(spark, None, U.nfc("t")) is None


def test_tokenizer_counts(spark):
    import os

    path = "/opt/tokenizers/byte_bpe_50k.json"
    if not os.path.exists(path):
        pytest.skip("no tokenizer file")
    assert one(spark, "hello world", U.tokenizer_counts(path)("t")) == 2


def test_hash_embedding(spark):
    """Both halves are the same 64 bytes, from -1 to 1, scaled to length 1."""
    import hashlib

    import numpy as np

    for t in ("some text", "", "हिंदी"):
        b = np.frombuffer(hashlib.sha512(t.encode()).digest(), np.uint8) / 127.5 - 1
        v = np.concatenate([b, b]) / np.sqrt(2 * (b * b).sum())
        assert np.allclose(one(spark, t, X.hash_embedding(F.col("t"))), v, atol=1e-12)
    assert one(spark, None, X.hash_embedding(F.col("t"))) is None

"""Problem 1: planted defects and harmless look-alikes."""

from __future__ import annotations

import pytest

from corpusloom.llm import pairs as P
from tests.conftest import rows

EN = ["The market sells a cheap version of the lamp.", "Children learn cooking by watching their grandparents.", "A short list on the wall keeps the room in good order.", "Rain and dust are the usual enemies of the old boat.", "One careful person can manage the garden alone.", "The best season for travel starts after the second harvest."]
HI = ["बाज़ार में दीये का सस्ता रूप मिलता है।", "बच्चे अपने दादा दादी को देखकर खाना बनाना सीखते हैं।", "दीवार पर लगी छोटी सूची कमरे को ठीक रखती है।", "बारिश और धूल पुरानी नाव के दुश्मन हैं।", "एक सावधान व्यक्ति अकेला बगीचा संभाल सकता है।"]
HG = ["bazaar mein diye ka sasta version milta hai.", "bachche apne dada dadi ko dekh kar khana banana seekhte hain.", "deewar par lagi chhoti list kamre ko theek rakhti hai.", "barish aur dhool purani naav ke dushman hain.", "ek savdhan insaan akela bagicha sambhaal sakta hai."]


@pytest.fixture(scope="module")
def found(spark):
    ask = {"en": "What is this thing and how does it work?", "hi": "यह क्या है और यह कैसे काम करता है?", "hi-Latn": "yeh kya hai aur yeh kaise kaam karta hai?"}
    base = [(ask[lang], x + " " + y, lang) for lang, ss in (("en", EN), ("hi", HI), ("hi-Latn", HG)) for x in ss for y in ss]
    filler = [(1000 + i, q, r, lang) for i, (q, r, lang) in enumerate(base)]
    cases = {
        "empty": [("What is it?", x) for x in (None, "", " \n", "N/A", "<empty>", "...", "[no response]")],
        "copied": [("What is the best season for travel?", "what is the best season for travel"), ("What is the best season for travel?", 'Question: "What is the best season for travel?"'), ("What is the best season for travel?", "What is the best season for travel? What is the best season for travel?"), ("What is the best season for travel?", "What is the best season for")],
        "refusal": [("How do I clean a lamp?", "I'm sorry, but I can't help with that."), ("How do I clean a lamp?", "This is something I would rather not comment on. Please ask an expert instead."), ("दीया कैसे साफ़ करें?", "माफ़ कीजिए, इस विषय पर मैं टिप्पणी नहीं करना चाहूँगा।"), ("diya kaise saaf karein?", "Maaf karna, yeh kaam mujhse nahi ho payega. Kisi expert se pooch lo."), ("दिवा कसा साफ करावा?", "माफ करा, मी याबद्दल काहीही सांगू शकत नाही.")],
        "other_language": [("How do I keep the room in good order?", HI[2] + " " + HI[0]), ("कमरे को ठीक कैसे रखें और बाज़ार में क्या मिलता है?", EN[2] + " " + EN[1]), ("kamre ko theek kaise rakhein aur bazaar mein kya milta hai?", HI[2] + " " + HI[1])],
        "truncated": [("How do I keep a room?", EN[0] + " A short list on the wall keeps the"), ("How do I keep a room?", EN[0] + " Children learn cooking by watch"), ("How do I keep a room?", EN[0] + " One careful person can manage the garden alone,"), ("कमरे को ठीक कैसे रखें?", HI[0] + " दीवार पर लगी छोटी सूची")],
        None: [
            ("How do I keep a room?", EN[2].rstrip(".")), ("Who opened it?", "Midre, Kentuni"), ("How many?", "8"), ("How many?", None and ""), ("Repeat this sentence exactly: Rain and dust are here.", "Rain and dust are here."), ("Answer in Hindi: how do I keep the room in good order?", HI[2]),
            ("How do I keep the room in good order?", EN[2] + " " + HI[1]), ("What did he say?", "The shopkeeper said sorry three times, because nobody could help him find the lamp."), ("Write a note to say sorry.", "Sorry, I could not bring the boat. I cannot undo the delay, but the next one will be on time."), ("Keep it?", EN[2] + " 🙂"),
        ],
    }
    cases[None] = [c for c in cases[None] if c[1] is not None]
    planted, i = [], 1
    want = {}
    for kind, pairs in cases.items():
        for q, r in pairs:
            planted.append((i, q, r, "en"))
            want[i] = kind
            i += 1
    df = spark.createDataFrame(planted + filler, "row_id long, instruction string, response string, lang string")
    got = dict(rows(P.defects(df)))
    return want, got, {r[0]: r[1:3] for r in planted}


def test_planted_cases(found):
    want, got, texts = found
    wrong = {i: (k, got.get(i), texts[i]) for i, k in want.items() if got.get(i) != k}
    assert not wrong


def test_others_are_no_cases(found):
    want, got, _ = found
    assert not [i for i in got if i not in want]


def test_odd_rows(spark):
    schema = "row_id long, instruction string, response string, lang string"
    assert P.defects(spark.createDataFrame([], schema)).count() == 0
    long = "word " * 60000
    df = spark.createDataFrame([(1, None, None, None), (1, None, None, None), (2, None, "A fine answer to nothing.", None), (3, "q", long, "en")], schema)
    got = rows(P.defects(df))
    assert got[:2] == [(1, "empty"), (1, "empty")] and all(r[0] == 1 for r in got)


def test_ends_are_counted_over_all_rows(spark):
    """Words and endings that only rows outside the language model's sample have are known, whatever the sample's size."""
    rare = "The lighthouse keeper paints gleaming corridors."
    filler = [(100 + i, "What is this thing and how does it work?", EN[i % 6] + " " + EN[i // 6 % 6], "en") for i in range(600)]
    seen = [(10 + i, "What is this thing and how does it work?", EN[i] + " " + rare, "en") for i in range(6)]
    planted = [(1, "How do I keep a room?", EN[0] + " The lighthouse keeper paints gleam", "en"), (2, "How do I keep a room?", EN[0] + " " + rare.rstrip("."), "en"), (3, "How do I keep a room?", EN[0] + " The lighthouse keeper paints", "en")]
    df = spark.createDataFrame(planted + seen + filler, "row_id long, instruction string, response string, lang string")
    assert rows(P.defects(df, sample_rows=20)) == [(1, "truncated"), (3, "truncated")]
    w = P.T.words(P.T.folded(P.T.codes(P.pa.array([rare]))))
    known = P.known_skeletons(df)
    last = P._last(P._classes(P._numbered(w), known), *(P.np.array([i]) for i in (len(w) - 1, 0)))
    keys = [int(k.view(P.np.int64)[0]) for k in (P._context(last, 5), P._word_key(w.hash[-1:]))]
    counts = P.end_counts(df, P.shared(spark, known), P.bitmap(spark.createDataFrame([(k,) for k in keys], "key long")))
    assert rows(counts.where(P.F.col("key").isin(keys)).select("ended", "seen")) == [(0, 6), (6, 6)]


def test_bitmap_loses_no_key(spark):
    """Every key put in is found again, and of others hardly any."""
    rng = P.np.random.default_rng(1)
    keys = rng.integers(-(1 << 63), 1 << 63, 3000)
    asked = P.bitmap(spark.createDataFrame([(int(k),) for k in keys], "key long"))
    assert asked(keys.view(P.np.uint64)).all() and asked(rng.integers(0, 1 << 63, 100000).astype(P.np.uint64)).mean() < 0.01


def test_end_likelihood_by_hand(spark):
    """Contexts of one to five words, each correcting the shorter one; a word cut within; ties and unknown contexts."""
    candidates = spark.createDataFrame([(7, 1, [1, 2, 3, 4, 5, 6, 7, 8]), (7, 2, [11, 12, 13, 14, 15, 16, 17, 18]), (8, 3, [1, 2, 23, 24, 25, 26, 27, 28])], "row_id long, uid long, keys array<long>")
    counts = spark.createDataFrame([(1, 5, 10), (2, 4, 4), (3, 0, 1), (6, 0, 3), (7, 0, 9), (27, 0, 2)], "key long, ended long, seen long")
    p = (4 + 2 * ((5 + 2 * 0.1) / 12)) / 6
    got = sorted((r.row_id, round(r.p, 9), r.cut) for r in P.likelihoods(candidates, counts).collect())
    assert got == [(7, 0.1, False), (7, round(p, 9), False), (8, round(p, 9), True)]


@pytest.mark.parametrize(("prompt", "asks"), [("write it in roman", True), ("romanised please", True), ("a romantic evening", False), ("englishman abroad", False), ("in english?", True), ("इसे हिंदी में लिखो", True)])
def test_languages_asked_for(prompt, asks):
    assert any(p.search(prompt) for p in P._ASKS_LANG.values()) == asks


@pytest.mark.parametrize("times", [1, 2, 3, 4, 5, 6, 8, 13, 20])
def test_copies_any_number_of_times(times):
    prompt = "what is the best season for travel in the hills"
    assert P.is_copy(prompt, " ".join([prompt] * times))
    assert not P.is_copy(prompt, " ".join([prompt] * times) + " the best season starts after the second harvest when roads are dry and rooms are cheap")


def test_copies_of_very_long_prompts():
    """Thousands of words are compared word by word."""
    prompt = " ".join(f"w{i * 7919 % 9973}" for i in range(8000))
    assert P.is_copy(prompt, prompt) and P.is_copy(prompt, " ".join(prompt.split()[:7000]))
    assert not P.is_copy(prompt, " ".join(reversed(prompt.split())))


def test_long_copies_and_refusals(spark):
    """A question said many times over, three times before an answer, and refusals of more than 70 words."""
    ask = "What is the best season for travel?"
    sorry = "I am sorry, but I would rather not comment on this matter. Please ask an expert instead."
    long = "I cannot help with that " + "because of the rules about such things and others " * 9
    told = "The shopkeeper said sorry three times because nobody could help him. " * 12
    planted = [(1, ask, " ".join([ask] * 9), "en"), (2, ask, " ".join([ask] * 3) + " " + " ".join(EN), "en"), (3, ask, " ".join([sorry] * 6), "en"), (4, ask, long, "en"), (5, ask, told + sorry, "en")]
    filler = [(100 + i, "What is this thing and how does it work?", EN[i % 6] + " " + EN[i // 6], "en") for i in range(36)]
    df = spark.createDataFrame(planted + filler, "row_id long, instruction string, response string, lang string")
    assert rows(P.defects(df)) == [(1, "copied"), (3, "refusal"), (4, "refusal")]


def test_words_are_classed_once(monkeypatch):
    """However often words are said, each distinct one is classed once, and the row before changes no class."""
    sizes, real = [], P._skeletons
    monkeypatch.setattr(P, "_skeletons", lambda w: sizes.append(len(w)) or real(w))
    classes = lambda rows: P._numbered(P.T.words(P.T.folded(P.T.codes(P.pa.array(rows)))))
    got = classes(["the lamp 7 is cheap"] * 500 + ["pan"])
    assert sizes == [6]
    assert got[:5].tolist() == classes(["the lamp 7 is cheap"]).tolist() == [*classes(["the lamp"]), P._NUM, *classes(["is", "cheap"])]
    assert got[-1] == classes(["pan"])[0]


def test_ends_of_texts_behind_long_tails(spark):
    """The last letter, digit or stop mark is found behind any number of blanks, quotes and pictures, and never in the row before."""
    body = ["Done.", "open", "", "\u200b", "a", "…", "b)"]
    texts = [t + tail * n for t in body for tail in (" ", '"', "🙂", "\u200b \n") for n in (0, 1, 15, 16, 17, 300, 5000)]
    raw = P.T.codes(P.pa.array(texts))
    solid = lambda c: c.isalnum() or c in P.T.STOPS
    want = [max((raw.start[i] + j for j, c in enumerate(t) if solid(c)), default=-1) for i, t in enumerate(texts)]
    assert P._final(raw, P.np.ones(len(texts), dtype=bool)).tolist() == want
    assert (P._final(raw, P.np.zeros(len(texts), dtype=bool)) == -1).all()

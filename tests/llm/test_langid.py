"""Problem 4: held-out accuracy of sentences, segments of mixed texts, labels."""

from __future__ import annotations

import pyarrow as pa
import pyarrow.parquet as pq
import pytest

from corpusloom.llm import langid as L
from corpusloom.llm.common import LABELS
from tests.conftest import DATA, rows
from tests.llm.test_pairs import EN, HG, HI

MR = ["बाजारात दिव्याचे स्वस्त रूप मिळते.", "मुले आजी आजोबांना पाहून स्वयंपाक शिकतात.", "भिंतीवर लावलेली छोटी यादी खोली नीट ठेवते.", "पाऊस आणि धूळ जुन्या होडीचे शत्रू आहेत.", "एक सावध माणूस एकटा बाग सांभाळू शकतो."]
BN = ["বাজারে প্রদীপের সস্তা রূপ পাওয়া যায়।", "বৃষ্টি আর ধুলো পুরনো নৌকার শত্রু।"]
TA = ["சந்தையில் விளக்கின் மலிவான வடிவம் கிடைக்கிறது.", "மழையும் தூசியும் பழைய படகின் எதிரிகள்."]


@pytest.fixture(scope="module")
def segments(spark):
    train = [(i, s, lang) for i, (lang, s) in enumerate([(k, a + " " + b) for k, ss in (("hi", HI), ("mr", MR), ("hinglish", HG), ("en", EN)) for a in ss for b in ss if a != b])]
    texts = {
        9001: (HI[0] + " " + HI[3], "mr"), 9002: (MR[1], None), 9003: (HG[2], "hinglish"), 9004: (EN[1] + " " + HI[1] + " " + HI[2], "en"), 9005: (BN[0], "hi"), 9006: (TA[0] + "\n" + EN[3], None), 9007: ("ok fine", None), 9008: (None, None), 9009: ("12 34 56 78", "hi"),
        9010: (HG[0] + " " + MR[3] + " " + HG[4], None),
    }
    df = spark.createDataFrame([("t", i, s, k, 0) for i, s, k in train] + [("t", i, s, k, 0) for i, (s, k) in texts.items()], "tbl string, ref_id long, text string, label string, seg int")
    return L.languages(df)


def test_segments(segments):
    got = rows(segments.where("ref_id > 9000"), "ref_id", "seg", "lang")
    assert got == [
        (9001, 0, "hi"), (9002, 0, "mr"), (9003, 0, "hinglish"), (9004, 1, "en"), (9004, 2, "hi"), (9005, 0, "bn"), (9006, 1, "ta"), (9006, 2, "en"), (9010, 1, "hinglish"), (9010, 2, "mr"), (9010, 3, "hinglish"),
    ]


def test_labels_that_are_right_are_no_cases(segments):
    assert {r[0] for r in rows(L.wrong_labels(segments).where("ref_id > 9000"), "ref_id")} == {9001, 9002, 9004, 9005, 9006, 9010}
    assert L.wrong_labels(segments).where("ref_id < 9000").count() == 0
    assert all(0 < r.confidence <= 1 for r in segments.collect())


def test_labels_answer_for_no_text():
    """Whatever a text's own label says, its result is the same; what no dictionary compresses has no language."""
    dicts = L.train(pa.array([a + " " + b for ss in (HI, MR, HG, EN) for a in ss for b in ss]), [k for k, ss in (("hi", HI), ("mr", MR), ("hinglish", HG), ("en", EN)) for _ in range(len(ss) ** 2)])
    texts = [HI[0], MR[1], HG[2], EN[3], BN[0], TA[1], "qwzx vbnq zzkp wqjx pqlm xxvz", "ৎৎঢ় ঐঐঔ ঊঊঋ ৎঢ়ৎ ঔঔঐ", EN[1] + " " + HI[1]]
    out = []
    for label in (None, "en", "hinglish", "hi", "bn"):
        b = pa.RecordBatch.from_arrays([pa.array(["t"] * len(texts)), pa.array(range(len(texts))), pa.array(texts), pa.array([label] * len(texts), pa.string())], names=["tbl", "ref_id", "text", "label"])
        out.append([(r["ref_id"], r["seg"], r["lang"], r["confidence"]) for p in L.segment_rows(iter([b]), dicts) for r in p.to_pylist()])
    assert all(x == out[0] for x in out)
    assert [x[2] for x in out[0]] == ["hi", "mr", "hinglish", "en", "bn", "ta", None, None, "en", "hi"]
    assert all((x[3] > 0.5) == (x[2] is not None) for x in out[0])


def test_held_out_accuracy():
    """Trained on half of the labelled rows, wrong labels among them, the other half's labels must agree but for wrong ones."""
    try:
        t = pq.read_table(f"{DATA}/../sf0.01/train_smoke.parquet", columns=["row_id", "response", "lang"])
    except OSError:
        pytest.skip("no test tables")
    canon = {s: k for k, v in LABELS.items() for s in v}
    lab = [canon.get((x or "").strip().lower()) for x in t["lang"].to_pylist()]
    half = t.num_rows // 2
    dicts = L.train(t["response"].combine_chunks()[:half], lab[:half])
    b = pa.RecordBatch.from_arrays([pa.array(["t"] * (t.num_rows - half)), t["row_id"].combine_chunks()[half:], t["response"].combine_chunks()[half:], pa.array(lab[half:], pa.string())], names=["tbl", "ref_id", "text", "label"])
    out = [r for p in L.segment_rows(iter([b]), dicts) for r in p.to_pylist() if r["seg"] == 0 and r["label"]]
    assert len(out) > 1000 and sum(r["label"] == r["lang"] for r in out) > 0.92 * len(out)


def test_given_dictionaries(spark):
    dicts = L.train(pa.array([*HI, *MR, *HG, *EN]), ["hi"] * len(HI) + ["mr"] * len(MR) + ["hinglish"] * len(HG) + ["en"] * len(EN))
    df = spark.createDataFrame([("t", 1, HI[0], None), ("t", 2, EN[1], "hi")], "tbl string, ref_id long, text string, label string")
    assert rows(L.languages(df, dictionaries=dicts), "ref_id", "lang") == [(1, "hi"), (2, "en")]


def test_odd_tables(spark):
    schema = "tbl string, ref_id long, text string, label string"
    assert L.languages(spark.createDataFrame([], schema)).count() == 0
    df = spark.createDataFrame([("t", 1, None, None), ("t", 2, "", None), ("t", 3, "यह " * 30000, None), ("t", 3, "यह " * 30000, None)], schema)
    assert rows(L.languages(df), "ref_id", "seg") == [(3, 0), (3, 0)]

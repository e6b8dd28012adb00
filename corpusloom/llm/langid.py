"""Problem 4: languages of documents and of the segments of mixed ones, by compression.

Each language has a dictionary of raw text. A sentence belongs to the language whose dictionary compresses it
smallest; where the margin to the next is narrow it is rejected and takes the language of its neighbours. Only
dictionaries of the sentence's main script compete: a dictionary in another script has no bytes in common with it. Where one
language alone has the script, it competes with no dictionary at all. A text of which every sentence is rejected has no language;
labels serve to sort the dictionaries' text and never answer for a text.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusloom.llm import nb
from corpusloom.llm import textvec as T
from corpusloom.llm.common import LANGS, bounded_sample, canonical_label, shared, table
from corpusloom.llm.seeds import SEEDS

#: Labelled rows the dictionaries are made of, at most (twice this at worst); and bytes of each dictionary, at most.
SAMPLE_ROWS, DICT_BYTES = 8000, 64 << 10
#: A sentence is decided if the next dictionary needs more bytes by this much and by this share of the smallest size.
MARGIN_BYTES, MARGIN_SHARE = 3, 0.04
#: Compression level; and bytes put after every sentence, which cost the same in all languages: a short sentence alone would be stored
#: as it is, as small gains don't pay for a compressed block.
LEVEL, PADDING = 6, b"\0" * 24
#: Steepness of the confidence in the margin's share of the size.
STEEP = 8.0
#: Texts with fewer words that contain a letter have no language of their own.
MIN_WORDS = 4

SCRIPT_OF = nb.SCRIPT_OF


def _compressor(content: bytes) -> zstandard.ZstdCompressor:
    p = zstandard.ZstdCompressionParameters.from_level(
        LEVEL, source_size=256, dict_size=len(content), write_content_size=False, write_checksum=False, write_dict_id=False, format=zstandard.FORMAT_ZSTD1_MAGICLESS
    )
    if not content:
        return zstandard.ZstdCompressor(compression_params=p)
    d = zstandard.ZstdCompressionDict(content, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
    d.precompute_compress(compression_params=p)
    return zstandard.ZstdCompressor(dict_data=d, compression_params=p)


@lru_cache(4)
def _compressors(dicts: tuple[bytes, ...]) -> list[zstandard.ZstdCompressor]:
    """One for each language and, at last, one without a dictionary."""
    return [_compressor(d) for d in (*dicts, b"")]


def letters(x: T.Codes) -> np.ndarray:
    """One byte for each folded code point: letters and marks by their place in their block, all else a blank."""
    k = T.take(T.tables()[1], x.c)
    return np.where((k == T.LETTER) | (k == T.MARK), x.c & 0x7F, 0x20).astype(np.uint8)


class Sentences:
    """Sentences of a column slice with their main script and number of words that contain a letter."""

    def __init__(self, col: pa.Array):
        self.codes = x = T.folded(T.codes(col))
        self.start, self.end, self.row = T.sentence_spans(x)
        script = T.take(T.tables()[2], x.c)
        counts = np.zeros((len(self.start), 6), dtype=np.int64)
        for s in range(1, 6):
            n = np.zeros(len(x.c) + 1, dtype=np.int64)
            np.cumsum(script == s, out=n[1:])
            counts[:, s] = n[self.end] - n[self.start]
        self.script = np.where(counts.any(axis=1), counts.argmax(axis=1), 0)
        w = T.words(x)
        n = np.zeros(len(x.c) + 1, dtype=np.int64)
        np.cumsum(T.take(T.tables()[1], x.c) == T.LETTER, out=n[1:])
        has = n[w.end] > n[w.start]
        m = np.zeros(len(w) + 1, dtype=np.int64)
        np.cumsum(has, out=m[1:])
        self.words = m[np.searchsorted(w.start, self.end)] - m[np.searchsorted(w.start, self.start)]
        self.row_words = m[w.first[1:]] - m[w.first[:-1]] if len(x) else m[:0]
        self.bytes = letters(x).tobytes()

    def __len__(self) -> int:
        return len(self.start)


def classify(s: Sentences, dicts: tuple[bytes, ...]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Best language of each sentence (-1: none has its script), its margin in bytes over the next, and its size."""
    best = np.full(len(s), -1, dtype=np.int64)
    margin = np.zeros(len(s), dtype=np.int64)
    size = np.ones(len(s), dtype=np.int64)
    data = s.bytes
    z = _compressors(dicts)
    for script in set(SCRIPT_OF.values()):
        at = np.flatnonzero(s.script == script)
        own = [i for i, x in enumerate(LANGS) if SCRIPT_OF[x] == script]
        if not len(at):
            continue
        parts = [data[a:b] + PADDING for a, b in zip(s.start[at].tolist(), s.end[at].tolist(), strict=True)]
        sizes = np.array([[len(x) for x in map(z[i].compress, parts)] for i in (own if len(own) > 1 else [*own, -1])])
        order = np.argsort(sizes, axis=0, kind="stable")
        least = np.take_along_axis(sizes, order[:1], 0)[0]
        best[at] = np.array([*own, -1])[order[0]]
        margin[at] = np.take_along_axis(sizes, order[1:2], 0)[0] - least
        size[at] = least
    return best, margin, size


def decided(best: np.ndarray, margin: np.ndarray, size: np.ndarray) -> np.ndarray:
    return (best >= 0) & (margin >= MARGIN_BYTES) & (margin >= MARGIN_SHARE * size)


def train(texts: pa.Array, labels: list[str | None]) -> tuple[bytes, ...]:
    """A dictionary for each language from labelled texts. Labels may be wrong and texts mixed, so sentences are
    first sorted by their words (``nb.train_languages``); each distinct one enters its language's dictionary once,
    which gives it more different words in the same room."""
    _, x, (start, end, _), to = nb.train_languages(texts, labels)
    data = letters(x).tobytes()
    dicts = []
    for i, lang in enumerate(LANGS):
        at = np.flatnonzero(to == i)
        seen = dict.fromkeys(data[a:b] for a, b in zip(start[at].tolist(), end[at].tolist(), strict=True))
        seeds = b"\n".join(_letter_bytes(t) for t in SEEDS[lang])
        dicts.append(seeds + b"\n" + b"\n".join(_spread(list(seen), DICT_BYTES - len(seeds) - 1)))
    return tuple(dicts)


def _spread(parts: list[bytes], most: int) -> list[bytes]:
    """As many parts as fit, taken evenly over the list."""
    total = sum(map(len, parts)) + len(parts)
    step = max(1, -(-total // most))
    return parts[::step]


def _letter_bytes(text: str) -> bytes:
    return letters(T.folded(T.codes(pa.array([text])))).tobytes()


def segments(s: Sentences, dicts: tuple[bytes, ...]) -> tuple[np.ndarray, ...]:
    """Maximal runs of sentences in one language: (row, first sentence, one past the last, language, confidence).

    Rejected sentences join the run before them, or the one after them at a text's start. A text of which every
    sentence is rejected is one run without a language (-1) and with a confidence of 0.5 at most.
    """
    best, margin, size = classify(s, dicts)
    lang = np.where(decided(best, margin, size) & (s.words > 0), best, -1)
    n = len(s)
    if not n:
        z = np.zeros(0, dtype=np.int64)
        return z, z, z, z, z
    first = np.searchsorted(s.row, s.row, side="left")
    idx = np.where(lang >= 0, np.arange(n), -1)
    before = np.maximum.accumulate(idx)
    back = np.where(lang[::-1] >= 0, np.arange(n)[::-1], n)
    after = np.minimum.accumulate(back)[::-1]
    last = np.searchsorted(s.row, s.row, side="right") - 1
    has_b, has_a = before >= first, after <= last
    filled = np.where(has_b, lang[np.maximum(before, 0)], np.where(has_a, lang[np.minimum(after, n - 1)], -1))
    new = np.ones(n, dtype=bool)
    new[1:] = (s.row[1:] != s.row[:-1]) | (filled[1:] != filled[:-1])
    a = np.flatnonzero(new)
    b = np.append(a[1:], n)
    # The margin's share of the compressed size, over the run; what is against the run's language counts against it.
    share = np.add.reduceat(np.where(best == filled, margin, -margin), a) / np.add.reduceat(size, a)
    confidence = 1 / (1 + np.exp(-STEEP * np.clip(np.where(filled[a] < 0, -np.abs(share), share), -1, 1)))
    return s.row[a], a, b, filled[a], confidence


def segment_rows(batches: Iterator[pa.RecordBatch], dicts: tuple[bytes, ...]) -> Iterator[pa.RecordBatch]:
    """(tbl, ref_id, text, label) to (tbl, ref_id, seg, lang, confidence, label, n_segs, start, end) with one row for each run."""
    names = np.array([*LANGS, None], dtype=object)
    for b in T.slices(batches, "text"):
        s = Sentences(b.column("text"))
        row, first, last, lang, confidence = segments(s, dicts)
        ok = s.row_words[row] >= MIN_WORDS if len(row) else np.zeros(0, bool)
        row, first, last, lang, confidence = (x[ok] for x in (row, first, last, lang, confidence))
        if not len(row):
            continue
        begin = np.searchsorted(row, row, side="left")
        n = np.searchsorted(row, row, side="right") - begin
        seg = np.where(n == 1, 0, np.arange(len(row)) - begin + 1)
        at = pa.array(row)
        off = s.codes.start[row]
        yield pa.RecordBatch.from_arrays(
            [
                b.column("tbl").take(at), b.column("ref_id").take(at), pa.array(seg), pa.array(names[lang], pa.string()), pa.array(confidence), b.column("label").take(at), pa.array(n), pa.array(s.start[first] - off), pa.array(s.end[last - 1] - off),
            ],
            names=["tbl", "ref_id", "seg", "lang", "confidence", "label", "n_segs", "start", "end"],
        )


SEGMENT_SCHEMA = "tbl string, ref_id long, seg long, lang string, confidence double, label string, n_segs long, start long, end long"


def texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(tbl, ref_id, text, label): the texts of both tables. The label is a code of the six, or null."""
    a = table(spark, sf_dir, "train_smoke", "row_id", "response", "lang").select(
        F.lit("train_smoke").alias("tbl"), F.col("row_id").alias("ref_id"), F.col("response").alias("text"), canonical_label(F.col("lang")).alias("label")
    )
    b = table(spark, sf_dir, "pool_todo", "pool_id", "instruction", "plang").select(
        F.lit("pool_todo").alias("tbl"), F.col("pool_id").alias("ref_id"), F.col("instruction").alias("text"), canonical_label(F.col("plang")).alias("label")
    )
    return a.unionByName(b)


def fit(df: DataFrame, bound: int = SAMPLE_ROWS) -> tuple[bytes, ...]:
    """Dictionaries from a bounded sample of (ref_id, text, label)."""
    t = bounded_sample(df, "ref_id", bound).select("text", "label").toArrow()
    return train(t["text"].combine_chunks() if t.num_rows else pa.array([], pa.string()), t["label"].to_pylist())


def languages(df: DataFrame, sample_rows: int = SAMPLE_ROWS, dictionaries: tuple[bytes, ...] | None = None) -> DataFrame:
    """Every text's runs of sentences in one language: SEGMENT_SCHEMA, where seg is 0 for a text in one language. The dictionaries are made of a sample
    of the texts, or given (see ``fit``).

    ``df`` has tbl, ref_id, text and label (a code of the six or null); other columns are ignored. Null, blank and
    letterless texts and texts with fewer than four words that contain a letter give no row; repeated rows count
    each; an empty table gives no row. Ties between two languages are narrow margins, hence rejected; a text
    of which every sentence is rejected, or has another script, has a null language. Labels don't matter to a text's own result.
    """
    df = df.select("tbl", "ref_id", "text", "label")
    dicts = shared(df.sparkSession, dictionaries or fit(df, sample_rows))
    return df.mapInArrow(lambda it: segment_rows(it, dicts.value), SEGMENT_SCHEMA)


def wrong_labels(segs: DataFrame) -> DataFrame:
    """Rows of ``languages`` that a label doesn't tell already: all runs of mixed texts, and texts in one language whose label is missing or another.
    Rejected texts are no such rows."""
    return segs.where(F.col("lang").isNotNull()).where((F.col("seg") > 0) | F.col("label").isNull() | (F.col("label") != F.col("lang")))


def p4_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return wrong_labels(languages(texts(spark, sf_dir))).select("tbl", "ref_id", "seg", "lang")


def p4_segments(spark: SparkSession, sf_dir: str) -> DataFrame:
    return languages(texts(spark, sf_dir))

"""Problem 5: repetition inside a document, by bands of zstandard ratios over whole texts and fixed chunks.

Two ratios are taken. That of the text's own bytes, whole and by chunk, tells what is incompressible or compresses far too well for
its length (``BANDS``). That of the text's words, each written as eight bytes of its hash, depends on neither script nor spelling of
words: without repetition it is 1, and a run of words that occurred before costs a few bytes in all. Its
length-specific limit is so wide that no text with the share of repetition asked for can lie beyond it (see
``limit``); an exact count over those it lets through gives the share. Chunks can't rule a text out there, as what repeats may lie
chunks apart.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, SparkSession

from corpusloom.llm import textvec as T
from corpusloom.llm.common import table

#: A run has at least so many words; a text at least so many; and at least this share of its words lies in runs that occurred before.
RUN, MIN_WORDS, SHARE = 4, 12, 0.30
#: Bytes of a chunk of text; words up to which the fast compressor finds every run, beyond which the one that looks at every place is used.
CHUNK_BYTES, FAST_WORDS = 2048, 256
#: Bands of the byte ratio by the text's bytes: (from bytes, repetitive below, incompressible above).
BANDS = ((0, 0.0, 9.0), (100, 0.22, 1.05), (300, 0.18, 1.0), (1000, 0.14, 0.85), (4000, 0.10, 0.75), (20000, 0.06, 0.7))
LEVEL, THOROUGH = 6, 16
#: Bits of the widest window (128 MB).
MOST_LOG = 27


def limit(words: np.ndarray) -> np.ndarray:
    """Largest word ratio of a text that may have SHARE of its words in repeated runs.

    Such a text has 0.3 n words or more in matches of RUN words, 32 bytes, or longer; a match costs up to some 4 bytes
    and saves 28: the ratio is at most 1 - 0.3 * 28 / 32 = 0.74 but for up to 14 bytes of headers, 1.75 / n. The fast compressor
    searches in wider steps the more bytes had no match, by up to 8 bytes within FAST_WORDS words, which the limit's room covers; for
    longer texts the optimal parser looks at every byte. The window holds the whole text.
    """
    return 0.82 + 2.4 / np.maximum(words, 1)


def may_repeat(words: np.ndarray, ratio: np.ndarray) -> np.ndarray:
    """Whether a text may have SHARE of its words in repeated runs, by its word ratio; one whose words no window holds may always."""
    return (words >= MIN_WORDS) & ((ratio <= limit(words)) | (words > 1 << (MOST_LOG - 3)))


@lru_cache(64)
def _sized(log: int, thorough: bool) -> zstandard.ZstdCompressor:
    wide = {"window_log": log, "hash_log": min(log + 1, 24), "chain_log": min(log + 1, 24)} if log > 12 else {}
    if thorough:
        wide["strategy"] = zstandard.STRATEGY_BTOPT
    p = zstandard.ZstdCompressionParameters.from_level(THOROUGH if thorough else LEVEL, source_size=1 << log, write_content_size=False, write_checksum=False, write_dict_id=False, format=zstandard.FORMAT_ZSTD1_MAGICLESS, **wide)
    return zstandard.ZstdCompressor(compression_params=p)


def _z(size: int, thorough: bool = False) -> zstandard.ZstdCompressor:
    """A compressor whose window holds ``size`` bytes (128 MB at most)."""
    return _sized(min(max(12, (size - 1).bit_length()), MOST_LOG), thorough)


@lru_cache(1)
def _lower() -> np.ndarray:
    t = np.arange(0x20000, dtype=np.uint32)
    for c in range(0x20000):
        low = chr(c).lower()
        if len(low) == 1:
            t[c] = ord(low)
    return t


def plain_words(col: pa.Array) -> T.Words:
    """Words between white space, without case, digits and punctuation; what is then empty is no word."""
    x = T.codes(col)
    k = T.take(T.tables()[1], x.c)
    c = np.where(x.c < 0x20000, T.take(_lower(), x.c), x.c)
    x = x.keep((k == T.LETTER) | (k == T.MARK) | (k == T.SPACE), c)
    return T.Words(x, *T.spans(T.take(T.tables()[1], x.c) != T.SPACE, x))


def repeated_share(w: T.Words, rows: int) -> np.ndarray:
    """Share of each row's words that lie in a run of RUN or more words that occurred, as the same run, earlier in the row."""
    n = len(w)
    count = np.bincount(w.row, minlength=rows)
    out = np.zeros(rows)
    if n < RUN:
        return out
    h = T.ngram_hash(w.hash, RUN)
    at = np.flatnonzero(w.row[: len(h)] == w.row[RUN - 1 :])
    key = h[at] + T.mix(w.row[at].astype(np.uint64) + np.uint64(1))
    _, first, inv = np.unique(key, return_index=True, return_inverse=True)
    again = at[first[inv] < np.arange(len(at))]
    cover = np.zeros(n + 1, dtype=np.int64)
    np.add.at(cover, again, 1)
    np.add.at(cover, np.minimum(again + RUN, n), -1)
    covered = np.bincount(w.row, np.cumsum(cover[:n]) > 0, rows)
    np.divide(covered, count, out=out, where=count > 0)
    return out


def word_ratios(w: T.Words, rows: int) -> np.ndarray:
    """Ratio of each row's word codes when compressed."""
    data = w.hash.tobytes()
    out = np.ones(rows)
    for i, (a, b) in enumerate(zip(w.first[:-1].tolist(), w.first[1:].tolist(), strict=True)):
        n = b - a
        if n >= MIN_WORDS:
            out[i] = len(_z(8 * n, n > FAST_WORDS).compress(data[8 * a : 8 * b])) / (8 * n)
    return out


def byte_ratios(col: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Bytes of each text, the ratio of the whole and that of its most compressible chunk."""
    texts = [b"" if x is None else x for x in col.cast(pa.large_binary()).to_pylist()]
    z = _z(CHUNK_BYTES)
    size = np.array([len(t) for t in texts], dtype=np.int64)
    whole = np.array([len(_z(len(t)).compress(t)) / len(t) if t else 1.0 for t in texts])
    chunk = np.array(
        [min(len(z.compress(t[j : j + CHUNK_BYTES])) / len(t[j : j + CHUNK_BYTES]) for j in range(0, max(1, len(t) - 200), CHUNK_BYTES)) if len(t) > CHUNK_BYTES else w for t, w in zip(texts, whole, strict=True)]
    )
    return size, whole, chunk


def band(size: np.ndarray, ratio: np.ndarray, chunk: np.ndarray) -> np.ndarray:
    """ok, repetitive or incompressible, by the limits for the text's length."""
    at = np.searchsorted([b[0] for b in BANDS], size, side="right") - 1
    low, high = np.array([b[1] for b in BANDS])[at], np.array([b[2] for b in BANDS])[at]
    return np.where(ratio > high, "incompressible", np.where(np.minimum(ratio, chunk) < low, "repetitive", "ok"))


def repetition(df: DataFrame) -> DataFrame:
    """(row_id, words, ratio, chunk_ratio, word_ratio, band, repeated_share) of each row of (row_id, response).

    Null, blank and wordless responses have 0 words, a word ratio of 1 and a share of 0; texts of fewer than twelve
    words aren't compressed as words. The share is exact for every text. Repeated rows count
    each; an empty table gives no row; other columns are ignored.
    """

    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in T.slices(it, "response"):
            w = plain_words(b.column("response"))
            n = np.diff(w.first)
            coded, share = word_ratios(w, b.num_rows), repeated_share(w, b.num_rows)
            size, whole, chunk = byte_ratios(b.column("response"))
            yield pa.RecordBatch.from_arrays([b.column("row_id"), pa.array(n), pa.array(whole), pa.array(chunk), pa.array(coded), pa.array(band(size, whole, chunk)), pa.array(share)], names=["row_id", "words", "ratio", "chunk_ratio", "word_ratio", "band", "repeated_share"])

    return df.select("row_id", "response").mapInArrow(run, "row_id long, words long, ratio double, chunk_ratio double, word_ratio double, band string, repeated_share double")


def repetitive(df: DataFrame) -> DataFrame:
    """row_id of each response with MIN_WORDS or more words, SHARE or more of them in repeated runs.

    Null, blank and short responses give no row; repeated rows count each; an empty table gives no row; other columns are ignored.
    """

    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in T.slices(it, "response"):
            w = plain_words(b.column("response"))
            n = np.diff(w.first)
            coded = word_ratios(w, b.num_rows)
            at = np.flatnonzero(may_repeat(n, coded))
            if len(at):
                part = plain_words(b.column("response").take(pa.array(at)))
                at = at[repeated_share(part, len(at)) >= SHARE - 1e-12]
                if len(at):
                    yield pa.RecordBatch.from_arrays([b.column("row_id").take(pa.array(at))], names=["row_id"])

    return df.select("row_id", "response").mapInArrow(run, "row_id long")


def p5_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repetitive(table(spark, sf_dir, "train_smoke", "row_id", "response"))


def p5_repetition(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repetition(table(spark, sf_dir, "train_smoke", "row_id", "response"))

"""Vectorised text primitives on Arrow string columns.

Rows never become Python strings one by one: a column slice is decoded once to an array of code points,
folded through a lookup table, cut into words and hashed with prefix sums. Everything is a function of the
text alone, so results don't depend on batch or partition boundaries.
"""

from __future__ import annotations

import unicodedata
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

SPACE, LETTER, MARK, DIGIT, PUNCT, SYMBOL = 0, 1, 2, 3, 4, 5
_TOP = 0x20000  # code points beyond are treated as this table's last entry of their own kind

S_NONE, S_LATIN, S_DEVA, S_BENG, S_TAML, S_OTHER = 0, 1, 2, 3, 4, 5

# Look-alike letters and digits written for Latin ones (leet spellings are not among them).
_LOOKALIKE = dict(zip("аеорсухіјѕԁһӏοαν", "aeopcyxijsdhloav", strict=True))
# The nukta signs, dropped so that a letter with and without nukta is one letter.
_NUKTA = {0x093C, 0x09BC}
# Signs written one for the other (candrabindu for anusvara).
_SAME_SIGN = {0x0901: 0x0902, 0x0981: 0x0982}
_MULTI_NUKTA = {0x0929, 0x0931, 0x0934, *range(0x0958, 0x0960), 0x09DC, 0x09DD, 0x09DF}


@lru_cache(1)
def tables() -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Per code point: folded code point (0: dropped), class, script."""
    fold = np.arange(_TOP, dtype=np.uint32)
    kind = np.full(_TOP, SYMBOL, dtype=np.uint8)
    script = np.zeros(_TOP, dtype=np.uint8)
    for c in range(_TOP):
        ch = chr(c)
        cat = unicodedata.category(ch)
        if ch.isspace() or cat in ("Zs", "Zl", "Zp"):
            kind[c] = SPACE
        elif cat[0] == "L":
            kind[c] = LETTER
        elif cat[0] == "M":
            kind[c] = MARK
        elif cat == "Nd":
            kind[c] = DIGIT
        elif cat[0] == "P":
            kind[c] = PUNCT
        if cat in ("Cf", "Cc", "Cs") and not ch.isspace():
            fold[c] = 0
            continue
        if cat in ("Cn", "Co"):
            continue
        if c in _NUKTA or 0xFE00 <= c <= 0xFE0F:
            fold[c] = 0
        elif cat == "Mn" and 0x0300 <= c < 0x0370:
            fold[c] = 0
        elif c in _SAME_SIGN:
            fold[c] = _SAME_SIGN[c]
        elif c >= 0x80 or ch.isupper():
            d = unicodedata.normalize("NFKD", ch)
            if cat == "Nd":
                fold[c] = 0x30 + unicodedata.digit(ch)
            elif cat[0] == "L" and (len(d) == 1 or unicodedata.combining(d[1]) or c in _MULTI_NUKTA):
                low = d[0].lower()
                fold[c] = ord(_LOOKALIKE.get(low, low) if len(low) == 1 else low[0])
            elif len(d) == 1 and d != ch:
                fold[c] = ord(d.lower()[0])
        if cat[0] in "LM":
            b = int(fold[c]) or c
            if b < 0x250 or 0x1E00 <= b < 0x1F00 or 0xFF00 <= b < 0xFFF0:
                script[c] = S_LATIN
            elif 0x0900 <= b < 0x0980 or 0xA8E0 <= b < 0xA900:
                script[c] = S_DEVA
            elif 0x0980 <= b < 0x0A00:
                script[c] = S_BENG
            elif 0x0B80 <= b < 0x0C00:
                script[c] = S_TAML
            else:
                script[c] = S_OTHER
    return fold, kind, script


class Codes:
    """Code points of the rows of a column slice: ``c`` all of them, rows ``start[i]:end[i]``."""

    __slots__ = ("c", "start", "end", "_kind")

    def __init__(self, c: np.ndarray, start: np.ndarray, end: np.ndarray):
        self.c, self.start, self.end = c, start, end
        self._kind: np.ndarray | None = None

    @property
    def kind(self) -> np.ndarray:
        """Class of each code point."""
        if self._kind is None:
            self._kind = take(tables()[1], self.c)
        return self._kind

    def __len__(self) -> int:
        return len(self.start)

    def rows(self) -> np.ndarray:
        """Row of each code point."""
        return np.repeat(np.arange(len(self.start)), self.end - self.start)

    def keep(self, mask: np.ndarray, c: np.ndarray | None = None) -> Codes:
        """Only the code points under ``mask``."""
        gone = np.flatnonzero(~mask)
        return Codes((self.c if c is None else c)[mask], self.start - np.searchsorted(gone, self.start), self.end - np.searchsorted(gone, self.end))

    def text(self, i: int) -> str:
        return self.c[self.start[i] : self.end[i]].astype("<u4").tobytes().decode("utf-32-le", "replace")


def codes(col: pa.Array) -> Codes:
    """Nulls count as empty. Bytes that are not UTF-8 become U+FFFD."""
    if isinstance(col, pa.ChunkedArray):
        col = col.combine_chunks()
    col = col.cast(pa.large_string())
    n = len(col)
    if n == 0:
        return Codes(np.zeros(0, np.uint32), np.zeros(0, np.int64), np.zeros(0, np.int64))
    if col.null_count:
        col = col.fill_null("")
    off = np.frombuffer(col.buffers()[1], dtype=np.int64)[col.offset : col.offset + n + 1]
    raw = col.buffers()[2]
    raw = raw[int(off[0]) : int(off[-1])] if raw is not None else b""
    try:
        c = np.frombuffer(raw.to_pybytes().decode().encode("utf-32-le") if len(raw) else b"", dtype="<u4")
    except UnicodeDecodeError:
        data = raw.to_pybytes()
        o = off - off[0]
        parts = [data[a:b].decode("utf-8", "replace") for a, b in zip(o[:-1], o[1:], strict=True)]
        ends = np.cumsum([len(p) for p in parts])
        c = np.frombuffer("".join(parts).encode("utf-32-le", "surrogatepass"), dtype="<u4")
        return Codes(c, ends - np.array([len(p) for p in parts]), ends)
    b = np.frombuffer(raw, dtype=np.uint8) if len(raw) else np.zeros(0, np.uint8)
    if len(c) == len(b):
        o = off - off[0]
    else:
        o = np.append(0, np.cumsum(pc.utf8_length(col).to_numpy()))
    return Codes(c, o[:-1], o[1:])


def take(table: np.ndarray, c: np.ndarray) -> np.ndarray:
    """``table`` by code point; code points beyond the table have the entry of U+4E00 (a letter) or themselves."""
    if len(c) and c.max() >= _TOP:
        c = np.where(c >= _TOP, 0x4E00, c)
    return table.take(c, mode="clip")  # none is out of range: the quicker way


@lru_cache(16)
def _flags(chars: str) -> np.ndarray:
    t = np.zeros(_TOP, dtype=bool)
    t[[ord(c) for c in chars]] = True
    return t


def among(c: np.ndarray, chars: str) -> np.ndarray:
    """Whether each code point is one of ``chars``."""
    return take(_flags(chars), c)


def folded(x: Codes) -> Codes:
    """Lower case, compatibility forms, accents, nuktas, look-alikes and digits folded; invisible characters dropped."""
    c = take(tables()[0], x.c)
    return Codes(c, x.start, x.end) if c.all() else x.keep(c != 0, c)


_POWERS = [np.zeros(0, np.uint64), np.zeros(0, np.uint64)]
_B = 0x9E3779B97F4A7C15 | 1
_BINV = pow(_B, -1, 1 << 64)


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    if len(_POWERS[0]) < n:
        n = max(n, 1 << 21)
        for k, (first, b) in enumerate(((0xBF58476D1CE4E5B9, _B), (1, _BINV))):
            p = np.full(n, b, dtype=np.uint64)
            p[0] = first
            np.multiply.accumulate(p, out=p)
            _POWERS[k] = p
    return _POWERS[0], _POWERS[1]


def mix(h: np.ndarray) -> np.ndarray:
    """Spreads 64-bit hashes."""
    h = h ^ (h >> np.uint64(32))
    h = h * np.uint64(0xD6E8FEB86659FD93)
    return h ^ (h >> np.uint64(29))


def span_hash(c: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """64-bit hash of each span of ``c``; equal spans have equal hashes wherever they lie."""
    n = len(c)
    p, inv = _powers(n + 1)
    s = np.zeros(n + 1, dtype=np.uint64)
    v = c.astype(np.uint64)
    v += np.uint64(1)
    v *= p[:n]
    np.cumsum(v, out=s[1:])
    return mix((s[end] - s[start]) * inv[start] + (end - start).astype(np.uint64))


def str_hash(words: list[str]) -> np.ndarray:
    """The hashes that ``span_hash`` gives to these (already folded) strings."""
    ends = np.cumsum([len(w) for w in words], dtype=np.int64)
    c = np.frombuffer("".join(words).encode("utf-32-le"), dtype="<u4")
    return span_hash(c, ends - np.array([len(w) for w in words], dtype=np.int64), ends)


class Words:
    """Words of a slice: spans of ``codes.c``, the row of each, its hash; words of row i are ``first[i]:first[i+1]``."""

    __slots__ = ("codes", "start", "end", "row", "first", "_hash", "_distinct")

    def __init__(self, x: Codes, start: np.ndarray, end: np.ndarray):
        self.codes, self.start, self.end = x, start, end
        self.first = np.searchsorted(start, np.append(x.start, len(x.c)))
        if len(x):
            self.first[-1] = len(start)
        self.row = np.repeat(np.arange(len(x)), np.diff(self.first))
        self._hash: np.ndarray | None = None
        self._distinct: tuple[np.ndarray, np.ndarray] | None = None

    @property
    def distinct(self) -> tuple[np.ndarray, np.ndarray]:
        """The place of one occurrence of each distinct word, and each word's index among them."""
        if self._distinct is None:
            self._distinct = distinct(self.hash)
        return self._distinct

    def only(self, at: np.ndarray) -> Words:
        """The words at ``at``, each as a row of its own."""
        n = self.end[at] - self.start[at]
        end = np.cumsum(n)
        x = Codes(self.codes.c[np.repeat(self.start[at] - end + n, n) + np.arange(n.sum())], end - n, end)
        return Words(x, x.start, x.end)

    def some(self, mask: np.ndarray) -> np.ndarray:
        """Whether a code point of each word is under ``mask``."""
        return np.logical_or.reduceat(np.append(mask, False), np.stack([self.start, self.end], axis=1).reshape(-1))[::2] if len(self) else np.zeros(0, dtype=bool)

    @property
    def hash(self) -> np.ndarray:
        if self._hash is None:
            self._hash = span_hash(self.codes.c, self.start, self.end)
        return self._hash

    def __len__(self) -> int:
        return len(self.start)

    def text(self, i: int) -> str:
        return self.codes.c[self.start[i] : self.end[i]].astype("<u4").tobytes().decode("utf-32-le", "replace")


def spans(inside: np.ndarray, x: Codes) -> tuple[np.ndarray, np.ndarray]:
    """Maximal runs of ``inside`` that don't cross rows."""
    n = len(inside)
    cut = np.zeros(n + 1, dtype=bool)
    cut[x.start] = True
    prev = np.zeros(n, dtype=bool)
    prev[1:] = inside[:-1]
    start = np.flatnonzero(inside & (~prev | cut[:n]))
    nxt = np.zeros(n, dtype=bool)
    nxt[:-1] = inside[1:]
    end = np.flatnonzero(inside & (~nxt | cut[1:])) + 1
    return start, end


def words(x: Codes) -> Words:
    """Maximal runs of letters, marks and digits of folded codes."""
    k = x.kind
    return Words(x, *spans((k >= LETTER) & (k <= DIGIT), x))


def ngram_hash(h: np.ndarray, n: int) -> np.ndarray:
    """Hash of each run of n hashes, by its first; shorter by n - 1 than ``h``."""
    m = max(0, len(h) - n + 1)
    out = np.zeros(m, dtype=np.uint64)
    k = np.uint64(1)
    for i in range(n):
        out = out * np.uint64(0x9FB21C651E98DF25) + h[i : i + m]
        k = k + np.uint64(1)
    return mix(out + np.uint64(n))


def unique(h: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct hashes, the place of one occurrence of each, and each hash's index among them."""
    return np.unique(h, return_index=True, return_inverse=True)


def distinct(h: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """As ``unique``, by a hash table, in any order: the place of one occurrence of each distinct hash, and each hash's index among them."""
    d = pa.array(h).dictionary_encode()
    inv = d.indices.to_numpy().astype(np.int64)
    at = np.zeros(len(d.dictionary), dtype=np.int64)
    at[inv] = np.arange(len(h))
    return at, inv


def slices(batches: Iterator[pa.RecordBatch], column: str | list[str], most: int = 1 << 21) -> Iterator[pa.RecordBatch]:
    """Cuts batches so that each part holds about ``most`` bytes of the text columns; a longer text is a part of its own."""
    names = [column] if isinstance(column, str) else column
    for b in batches:
        if not b.num_rows:
            continue
        size = np.zeros(b.num_rows, dtype=np.int64)
        for x in names:
            size += pc.binary_length(b.column(x)).fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64)
        part = np.cumsum(size) // most
        edge = np.append(np.flatnonzero(np.diff(part, prepend=-1)), b.num_rows)
        for i, j in zip(edge[:-1], edge[1:], strict=True):
            if j > i:
                yield b.slice(i, j - i)


# Sentence ends: full stop, question and exclamation marks, danda, double danda, vertical bar written for danda, ellipsis.
STOPS = ".?!।॥|…؟。！？"


def sentence_spans(x: Codes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Sentences of each row as spans of code points: (start, end, row). A sentence ends at a line break or
    after stop marks that are followed by white space or the row's end; spans without letters or digits are
    joined to nothing (they are left out)."""
    n = len(x.c)
    if not n:
        z = np.zeros(0, dtype=np.int64)
        return z, z, z
    k = x.kind
    stop = np.flatnonzero(among(x.c, STOPS))
    mine = np.searchsorted(x.start, stop, side="right") - 1
    brk = stop[(stop + 1 == x.end[mine]) | (k[np.minimum(stop + 1, n - 1)] == SPACE)]
    # A stop after a lone number is a list mark, not a sentence end: "1. ".
    at = brk[(brk > 0) & (x.c[brk] == ord("."))]
    at = at[k[at - 1] == DIGIT]
    if len(at):
        not_digit = np.flatnonzero(k != DIGIT)
        before = np.searchsorted(not_digit, at) - 1
        run = np.where(before >= 0, not_digit[before] + 1, 0)  # where the digits before the stop begin
        row = np.searchsorted(x.start, run, side="right") - 1
        brk = np.setdiff1d(brk, at[(run == x.start[row]) | (x.c[np.maximum(run - 1, 0)] == 10)], assume_unique=True)
    edge = np.unique(np.concatenate([x.start, brk + 1, np.flatnonzero((x.c == 10) | (x.c == 13)) + 1, [n]]))
    start, end = (edge[:-1], edge[1:]) if edge[0] == 0 else (np.append(0, edge[:-1]), edge)
    ok = np.logical_or.reduceat((k == LETTER) | (k == DIGIT), start)
    start, end = start[ok], end[ok]
    row = np.searchsorted(x.start, start, side="right") - 1
    return start, end, row

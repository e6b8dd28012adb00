"""Problem 1: prompt and response pairs that don't serve, with the type of their defect.

Languages of prompt and response come from one naive Bayes model over character n-grams; an answer that no stop
mark ends is held against the likelihood that a text ends after its last words. Copies are found by the words that
prompt and response share, refusals by a linear model of words and word pairs (``refusals``).

The end-of-text model is asked only about the last words of answers without a stop mark. Their contexts are collected first; a
bitmap of them, of fixed size, goes to the tasks that count contexts over all responses, so that little else is shuffled.
The counts are exact and joined to the answers, whatever the number of either. Rare words are one class in contexts: which ones are not
rare is counted over all responses, too, and known to all tasks as a bitmap.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator
from difflib import SequenceMatcher

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import Broadcast, TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusloom.llm import nb, refusals
from corpusloom.llm import textvec as T
from corpusloom.llm.common import LANGS, bounded_sample, canonical_label, shared, table
from corpusloom.llm.leaks import subsequence
from corpusloom.sources.checkpoint import checkpointed

#: Labelled responses that the language model is fitted on, at most (twice this at worst).
SAMPLE_ROWS = 12000
#: Words of the end-of-text model's longest context, and the weight of a shorter context in sightings of the longer one.
ORDER, PULL = 5, 2.0
#: Sightings in all responses from which a word, and a context or a word's beginning, is known.
WORD_SEEN, CONTEXT_SEEN = 3, 2
#: Bits of the bitmaps (16 MB each). The fuller they are, the more contexts are counted that none asks for and the more rare words pass for known ones; none is lost.
BITMAP_BITS = 27
#: A text that ends after its last words with less likelihood is truncated.
END_LIKELIHOOD = 0.1
#: Answers of fewer words than this are names, numbers or phrases: they are neither truncated nor in a language.
SHORT_WORDS = 4
#: Log-likelihood gap between languages, for each word of a sentence, that decides it.
GAP = 1.0
#: Shares of the response that must lie in the prompt, and of the prompt in the response, in a copy.
COPY_OF_RESPONSE, COPY_OF_PROMPT = 0.85, 0.6

# What is written in place of an answer, without its punctuation and in lower case.
PLACEHOLDERS = frozenset(
    "null|none|nil|na|n a|nan|empty|blank|undefined|unknown|missing|void|todo|tbd|tba|placeholder|no answer|no response|no output|no text|"
    "answer|response|answer here|your answer here|insert answer here|insert text here|lorem ipsum|not available|not applicable|no data|nothing|"
    "none given|no content|response here|output|uttar|jawab|koi jawab nahi|koi uttar nahi|khali|खाली|रिक्त|उत्तर|जवाब|कोई उत्तर नहीं|कोई जवाब नहीं|उत्तर नाही|xxx|xx|x|test|eof|end".split("|")
)
# Words put before a repeated question.
_DRESS = re.compile(
    r"^(?:(?:question|prompt|query|instruction|input|user|human|q|que|answer|ans|a|response|output|assistant|sawaal|sawal|prashn|jawab|uttar|प्रश्न|सवाल|उत्तर|जवाब|"
    r"you asked|you said|your question(?: was| is)?|the question(?: was| is)?|aapne poocha|aapka sawaal(?: hai| tha)?|आपने पूछा|आपका प्रश्न|आपका सवाल|तुमचा प्रश्न|প্রশ্ন|কেউ জিজ্ঞাসা|கேள்வி)\s)+"
)
# A prompt that asks for itself, or a part of itself, back.
_ASKS_COPY = re.compile(
    r"\brepeat (?:this|the|after|what|these|exactly|my|back)|\bverbatim\b|word for word|\bcopy (?:this|the following|out)|\becho (?:this|back)|\bsay (?:this|it) (?:back|again)|\bquote (?:this|the)|"
    r"\bas it is\b|\bexactly as (?:written|it is|given)|\brewrite (?:this|the) (?:sentence|line|text) (?:unchanged|as)|dohra(?:o|ao|iye|iye|yen|ein|ye|iyega)\b|waise? k[ai] wais[ai]|jaise? k[ai] tais[ai]|jyon k[ai] tyon|"
    r"hu ?ba ?hu|दोहराइए|दोहराओ|दोहराएं|दोहराये|दोहरायें|दोहराना|ज्यों का त्यों|वैसे का वैसा|जैसे का तैसा|हूबहू|जसेच्या तसे|जसाच्या तसा|पुन्हा लिहा|पुन्हा म्हणा|तसेच लिहा|হুবহু|আবার লিখ|পুনরাবৃত্তি|திரும்ப(?:ச்)? (?:சொல்|எழுத)|அப்படியே"
)
# Names of the languages, by which a prompt asks for one: whole words in Latin letters, others anywhere.
_NAMES = {
    "en": (r"english|angrezi|angreji|inglish", r"अंग्रेजी|अंग्रेज़ी|इंग्लिश|इंग्रजी|ইংরেজি|ஆங்கில"),
    "hi": (r"hindi|devanagari", r"हिंदी|हिन्दी|देवनागरी|হিন্দি|இந்தி|हिंदीत"),
    "hinglish": (r"hinglish|roman|romanised|romanized|latin (?:script|letters)|english letters", r"हिंग्लिश|रोमन|হিংলিশ"),
    "mr": (r"marathi", r"मराठी|মারাঠি|மராத்தி"),
    "bn": (r"bengali|bangla|bangali", r"बंगाली|बांग्ला|बंगला|বাংলা|வங்காள"),
    "ta": (r"tamil", r"तमिल|तामिळ|तमिळ|তামিল|தமிழ்|தமிழில்"),
}
_ASKS_LANG = {k: re.compile(rf"(?<![a-z])(?:{latin})(?![a-z])|{other}") for k, (latin, other) in _NAMES.items()}
_TRANSLATE = re.compile(r"translat|anuvaad|anuvad|अनुवाद|भाषांतर|অনুবাদ|மொழிபெயர்")

_CLOSERS = "\"'”’»)]}*_`~"
# Vowels, and the half vowel that spellings put between them, of the four scripts.
_VOWELS = "aeiouyअआइईउऊऋएऐओऔयঅআইঈউঊঋএঐওঔযஅஆஇஈஉஊஎஏஐஒஓஔய"
_DANGLING = ",;:-–—(/&+"
_UNK, _NUM = np.uint64(0x1234567), np.uint64(0x7654321)


def _contexts(last: np.ndarray, most: int) -> Iterator[np.ndarray]:
    """Contexts of the last word, of the last two, up to ``most``: each goes on from the one before."""
    h = np.zeros(len(last), dtype=np.uint64)
    for i in range(most):
        h = T.mix(h * np.uint64(0x9FB21C651E98DF25) + last[:, last.shape[1] - 1 - i] + np.uint64(i))
        yield h


def _context(last: np.ndarray, k: int) -> np.ndarray:
    return [*_contexts(last, k)][-1]


def _skeletons(w: T.Words) -> np.ndarray:
    """Hash of each word without vowels, signs and doubled letters, so that spellings of one word agree; of the word itself if nothing is left."""
    x = w.codes
    keep = (x.kind == T.LETTER) & ~T.among(x.c, _VOWELS)
    double = np.append(False, x.c[1:] == x.c[:-1])[: len(x.c)]
    double[w.start] = False
    keep &= ~double
    n = np.zeros(len(x.c) + 1, dtype=np.int64)
    np.cumsum(keep, out=n[1:])
    h = T.span_hash(x.c[keep], n[w.start], n[w.end])
    return np.where(n[w.end] > n[w.start], h, w.hash)


def _numbered(w: T.Words) -> np.ndarray:
    """Classes of words: their skeletons, but one class for all with a digit. Told once for each distinct word, and of nothing but its own letters."""
    at, inv = w.distinct
    one = w.only(at)
    return np.where(one.some(one.codes.kind == T.DIGIT), _NUM, _skeletons(one))[inv]


class Ended:
    """Words of the sentences that a stop mark ends."""

    def __init__(self, x: T.Codes):
        start, end, _ = T.sentence_spans(x)
        self.codes = x
        self.words = w = T.words(x)
        a, b = np.searchsorted(w.start, start), np.searchsorted(w.start, end)
        tail = x.c[np.maximum(end - 1, 0)]
        two = x.c[np.maximum(end - 2, 0)]
        ok = T.among(tail, T.STOPS) & (tail != ord("…")) & ~((tail == ord(".")) & (two == ord("."))) & (b - a >= SHORT_WORDS)
        a, n = a[ok], (b - a)[ok]
        self.first = np.repeat(a, n)  # of each word's sentence
        self.at = self.first + np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
        self.is_end = np.zeros(len(w), dtype=bool)
        self.is_end[b[ok] - 1] = True


def _word_key(h: np.ndarray) -> np.ndarray:
    return T.mix(h + np.uint64(3))


def _after_key(two: np.ndarray) -> np.ndarray:
    """Key by which the two words before a last word are asked for."""
    return T.mix(two ^ np.uint64(0x5851F42D4C957F2D))


def _two(last: np.ndarray) -> np.ndarray:
    """Context of the two words before the last one."""
    return _context(np.concatenate([np.zeros((len(last), 1), np.uint64), last[:, :-1]], axis=1), 2)


class Bitmap:
    """A set of keys by their first bits: it has all that were put in, and some others."""

    def __init__(self, places: np.ndarray, bits: np.ndarray):
        self.bits = np.zeros(1 << (BITMAP_BITS - 6), dtype=np.uint64)
        self.bits[places] = bits.view(np.uint64)

    def __call__(self, key: np.ndarray) -> np.ndarray:
        at = key >> np.uint64(64 - BITMAP_BITS)
        return (self.bits[(at >> np.uint64(6)).astype(np.int64)] >> (at & np.uint64(63))) & np.uint64(1) > 0


def bitmap(keys: DataFrame) -> Bitmap:
    """The bitmap of the column ``key``, put together by tasks: no more than its own size reaches the driver."""
    at = F.shiftrightunsigned("key", 64 - BITMAP_BITS)
    # A shift of longs takes its last six bits.
    t = keys.groupBy(F.shiftright(at, 6).alias("place")).agg(F.bit_or(F.expr(f"shiftleft(1L, int(shiftrightunsigned(key, {64 - BITMAP_BITS}) & 63))")).alias("bits")).toArrow()
    return Bitmap(t["place"].to_numpy(), t["bits"].to_numpy())


def _tally(key: np.ndarray, ended: np.ndarray | None = None, times: np.ndarray | None = None) -> tuple[np.ndarray, ...]:
    """(key, times ended, times seen) of each key."""
    at, inv = T.distinct(key)
    key = key[at]
    seen = np.bincount(inv, times, len(key)).astype(np.int64)
    return key, np.zeros(len(key), np.int64) if ended is None else np.bincount(inv, ended, len(key)).astype(np.int64), seen


def _classes(skeletons: np.ndarray, known: Bitmap) -> np.ndarray:
    """One class for all skeletons that aren't known."""
    return np.where(known(skeletons) | (skeletons == _NUM), skeletons, _UNK)


def skeleton_counts(x: T.Codes) -> list[tuple[np.ndarray, ...]]:
    """Sightings of the words' skeletons."""
    s = Ended(x)
    return [_tally(_numbered(s.words)[s.at])] if len(s.at) else []


def context_counts(x: T.Codes, known: Bitmap, asked: Bitmap) -> list[tuple[np.ndarray, ...]]:
    """Of the keys asked for: sightings and ends of contexts, sightings of words, and of beginnings of words after the
    two words before them (a last word among these is cut within)."""
    s = Ended(x)
    w, at = s.words, s.at
    if not len(at):
        return []
    last = _last(_classes(_numbered(w), known), at, s.first)
    is_end = s.is_end[at]
    out = []
    for key in _contexts(last, ORDER):
        ok = asked(key)
        out.append(_tally(key[ok], is_end[ok]))
    key = _word_key(w.hash[at])
    out.append(_tally(key[asked(key)]))
    two = _two(last)
    ok = asked(_after_key(two))
    _, i, times = np.unique(T.mix(two[ok] + w.hash[at[ok]]), return_index=True, return_counts=True)
    two, word = two[ok][i], at[ok][i]
    n = w.end[word] - w.start[word] - 1
    of = np.repeat(np.arange(len(n)), n)
    start = w.start[word][of]
    begin = T.span_hash(x.c, start, start + 1 + np.arange(len(of)) - np.repeat(np.cumsum(n) - n, n))
    key = T.mix(two[of] + begin)
    ok = asked(key)
    out.append(_tally(key[ok], times=times[of][ok]))
    return out


def _counted(df: DataFrame, count: Callable[[T.Codes], list[tuple[np.ndarray, ...]]]) -> DataFrame:
    """(key, ended, seen) over all responses, of what ``count`` finds in each."""

    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[np.ndarray, ...]] = []
        for b in T.slices(it, "response", 1 << 23):
            held += count(T.folded(T.codes(b.column("response"))))
            if sum(len(h[0]) for h in held) > 1 << 21:
                yield batch(held)
                held = []
        if held:
            yield batch(held)

    def batch(held: list[tuple[np.ndarray, ...]]) -> pa.RecordBatch:
        key, ended, seen = (np.concatenate(c) for c in zip(*held, strict=True))
        key, ended, seen = _tally(key, ended, seen)
        return pa.RecordBatch.from_arrays([pa.array(key.view(np.int64)), pa.array(ended), pa.array(seen)], names=["key", "ended", "seen"])

    c = df.select("response").mapInArrow(run, "key long, ended long, seen long")
    return c.groupBy("key").agg(F.sum("ended").alias("ended"), F.sum("seen").alias("seen"))


def known_skeletons(df: DataFrame) -> Bitmap:
    """Skeletons that WORD_SEEN words or more have, in the sentences of all responses that a stop mark ends."""
    return bitmap(_counted(df, skeleton_counts).where(F.col("seen") >= WORD_SEEN))


def end_counts(df: DataFrame, known: Broadcast, asked: Bitmap) -> DataFrame:
    """(key, ended, seen) of each key asked for, over the sentences of all responses that a stop mark ends: contexts before each next word
    went on, the one before the mark ended."""
    held = shared(df.sparkSession, asked)
    return _counted(df, lambda x: context_counts(x, known.value, held.value))


def likelihoods(candidates: DataFrame, counts: DataFrame) -> DataFrame:
    """(row_id, p, cut) of each row of ``candidates`` (row_id, uid, keys): the likelihood of an end after its last words, where each longer
    context that was seen corrects that after the shorter one by its counts; and whether its last word, unknown or new after the same words, only begins one."""
    k = candidates.select("row_id", "uid", F.posexplode("keys").alias("place", "key")).where(F.col("place") < ORDER + 2)
    k = k.join(counts.where(F.col("seen") >= CONTEXT_SEEN), "key", "left")
    at = lambda i, c: F.max(F.when(F.col("place") == i, F.col(c)))
    k = k.groupBy("row_id", "uid").agg(*(at(i, c).alias(f"{c}{i}") for i in range(ORDER + 2) for c in ("ended", "seen")))
    p = F.lit(0.1)
    for i in range(ORDER):
        k = k.withColumn(f"p{i}", F.when(F.col(f"seen{i}").isNull(), p).otherwise((F.col(f"ended{i}") + PULL * p) / (F.col(f"seen{i}") + PULL)))
        p = F.col(f"p{i}")
    known = F.coalesce(F.col(f"seen{ORDER}") >= WORD_SEEN, F.lit(False))
    new = ~known | (F.col("seen2").isNull() & (p < 0.5))
    return k.select("row_id", p.alias("p"), (new & F.col(f"seen{ORDER + 1}").isNotNull()).alias("cut"))


def _last(cls: np.ndarray, at: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Classes of the ORDER words that end with word ``at``, none before word ``first``: 0."""
    out = np.zeros((ORDER, len(at)), dtype=np.uint64)
    for i in range(ORDER):
        j = at - (ORDER - 1 - i)
        np.multiply(cls.take(j, mode="clip"), j >= first, out=out[i])
    return out.T


class Side:
    """Languages of the sentences of one column."""

    def __init__(self, col: pa.Array, language: np.ndarray):
        self.codes = x = T.folded(T.codes(col))
        self.start, self.end, self.row = T.sentence_spans(x)
        sp = nb.Spans(x, self.start, self.end)
        self.words = sp.words
        n = sp.counts()
        sums = sp.sums(language)
        own = np.array([nb.SCRIPT_OF[c] for c in LANGS])
        # A sentence's script is that of most of its words, told by their first letters.
        script = T.take(T.tables()[2], x.c[sp.words.start])
        size = sp.b - sp.a
        of = np.repeat(np.arange(len(size)), size)
        at = np.repeat(sp.a - np.cumsum(size) + size, size) + np.arange(len(of))
        per = np.bincount(of * 6 + script[at], minlength=len(size) * 6).reshape(-1, 6)
        main = per[:, 1:].argmax(axis=1) + 1
        sums = np.where(own[None, :] == main[:, None], sums, -1e9)
        order = np.sort(sums, axis=1)
        self.gap = order[:, -1] - order[:, -2] if len(n) else np.zeros(0)
        sure = (n > 0) & (self.gap >= GAP * n) & (self.gap >= 4) & (order[:, -1] > -1e8) if len(n) else np.zeros(0, bool)
        self.lang = np.where(sure, sums.argmax(axis=1), -1) if len(n) else np.zeros(0, np.int64)
        rows = len(x)
        self.has = np.zeros((rows, len(LANGS)), dtype=np.int64)
        np.add.at(self.has.reshape(-1), self.row[sure] * len(LANGS) + self.lang[sure], n[sure])
        self.open = np.bincount(self.row[~sure], n[~sure], rows) if len(n) else np.zeros(rows)


def _plain(x: T.Codes, i: int) -> str:
    """Folded words of row i joined by blanks."""
    return " ".join(re.findall(r"[^\W_](?:[^\W_]|[ऀ-ःऺ-ॏ॑-ॗॢॣঁ-ঃা-্ৗஂா-்ௗ])*", x.text(i)))


#: Product of the lengths of prompt and part up to which they are compared letter by letter, beyond it word by word: the time of the first grows faster.
_LETTERS = 1 << 18


def _common(a: str, b: str) -> tuple[float, float]:
    """Shares of ``b`` and of ``a`` that both have in the same order."""
    if len(a) * len(b) <= _LETTERS:
        size = sum(m.size for m in SequenceMatcher(None, a, b, autojunk=False).get_matching_blocks() if m.size >= 3)
        return size / len(b), size / len(a)
    a_, b_ = (np.array([hash(w) for w in t.split()]) for t in (a, b))
    size = subsequence(a_, b_)
    return size / len(b_), size / len(a_)


def is_copy(prompt: str, response: str) -> bool:
    """Whether the words of a response are those of its prompt, wholly or nearly, once or several times over."""
    response = _DRESS.sub("", response + " ").strip()
    if not prompt or len(response) < 4:
        return False
    n = len(prompt)
    # Said more than once: each part is held against the prompt.
    parts = [response]
    if len(response) > 1.6 * n:
        k = max(1, round(len(response) / (n + 1)))
        step = len(response) / k
        parts = [response[round(i * step) : round((i + 1) * step)] for i in range(k)]
    for part in parts:
        mine, its = _common(prompt, part) if part.strip() else (0.0, 0.0)
        if mine < COPY_OF_RESPONSE or its < COPY_OF_PROMPT:
            return False
    return True


def find(b: pa.RecordBatch, language: np.ndarray, declines: np.ndarray, known: Bitmap) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The defect of each row of (instruction, response), or None; the rows that the end-of-text model decides, and the keys that each asks for."""
    n = b.num_rows
    out = np.full(n, None, dtype=object)
    raw = T.codes(b.column("response"))
    q, r = Side(b.column("instruction"), language), Side(b.column("response"), language)
    x, w = r.codes, r.words
    count = np.diff(w.first) if n else np.zeros(0, np.int64)
    # Empty.
    out[count == 0] = "empty"
    for i in np.flatnonzero((count > 0) & (count <= 4) & (x.end - x.start < 60)):
        if _plain(x, i) in PLACEHOLDERS:
            out[i] = "empty"
    # Copied: rows most of whose words are in the prompt.
    qh = q.words.hash + T.mix(q.words.row.astype(np.uint64) + np.uint64(1))
    rh = w.hash + T.mix(w.row.astype(np.uint64) + np.uint64(1))
    shares = np.zeros(n)
    np.divide(np.bincount(w.row, pc.is_in(pa.array(rh), value_set=pa.array(qh)).to_numpy(zero_copy_only=False), n), count, out=shares, where=count > 0)
    qn = np.diff(q.words.first)
    for i in np.flatnonzero((out == None) & (shares >= 0.5) & (count >= 2)):  # noqa: E711
        prompt, whole = _plain(q.codes, i), q.codes.text(i)
        if _ASKS_COPY.search(prompt):
            continue
        response = _plain(x, i)
        if any(is_copy(p, response) for p in dict.fromkeys([prompt, *_lines(whole)])):
            out[i] = "copied"
    # Refusals.
    parts = refusals.Parts(w, _numbered, r.start, r.end, r.row)
    out[(out == None) & refusals.declining(parts, declines)] = "refusal"  # noqa: E711
    # Another language: no sentence of the answer is in a language that the prompt has.
    answered, asked = r.has > 0, q.has > 0
    other = (out == None) & answered.any(axis=1) & asked.any(axis=1) & ~(answered & asked).any(axis=1) & (r.has.sum(axis=1) >= np.maximum(SHORT_WORDS, r.open))  # noqa: E711
    for i in np.flatnonzero(other):
        prompt = q.codes.text(i)
        if not _TRANSLATE.search(prompt) and not any(_ASKS_LANG[LANGS[j]].search(prompt) for j in np.flatnonzero(answered[i])):
            out[i] = "other_language"
    # Truncated.
    dangling, open_, keys = unfinished(raw, x, w, _classes(parts.skeleton, known), (out == None) & (count >= SHORT_WORDS))  # noqa: E711
    out[dangling] = "truncated"
    return out, open_, keys


def _lines(text: str) -> list[str]:
    """The lines of a prompt, as words: one of them may be the question, the others its context."""
    parts = [s for s in text.split("\n") if s.strip()]
    if len(parts) < 2:
        return []
    x = T.folded(T.codes(pa.array(parts)))
    return [p for p in (_plain(x, i) for i in range(len(parts))) if p]


def _final(raw: T.Codes, rows: np.ndarray) -> np.ndarray:
    """Place of the last code point of each of ``rows`` that isn't white space, a sign other than a stop mark, a closing mark or invisible; -1: none.
    The ends of texts are looked at first, more of those in which none is found."""
    out = np.full(len(rows), -1, dtype=np.int64)
    left, reach = np.flatnonzero(rows), 16
    while len(left):
        start = np.maximum(raw.start[left], raw.end[left] - reach)
        size = raw.end[left] - start
        stop = np.cumsum(size)
        at = np.repeat(start - stop + size, size) + np.arange(size.sum())
        c = raw.c[at]
        kind = T.take(T.tables()[1], c)
        skip = (kind == T.SPACE) | ((kind == T.SYMBOL) & ~T.among(c, T.STOPS)) | T.among(c, _CLOSERS) | (T.take(T.tables()[0], c) == 0)
        solid = np.flatnonzero(~skip)
        i = np.searchsorted(solid, stop) - 1
        j = solid[np.maximum(i, 0)] if len(solid) else np.zeros(len(left), np.int64)
        found = (i >= 0) & (j >= stop - size)
        out[left[found]] = at[j[found]]
        left, reach = left[~found & (start > raw.start[left])], reach * 16
    return out


def unfinished(raw: T.Codes, x: T.Codes, w: T.Words, cls: np.ndarray, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of ``rows``, those that end on a sign after which text goes on; those that no stop mark ends; and of each of these the keys
    that the end-of-text model is asked for: contexts of 1 to ORDER words, the last word, its letters as a beginning, and what they stand after."""
    pos = _final(raw, rows)
    some = pos >= 0
    pos = np.maximum(pos, 0)
    last = raw.c[pos] if len(raw.c) else np.zeros(len(rows), np.uint32)
    stop = T.among(last, T.STOPS)
    before = raw.c[np.maximum(pos - 1, 0)] if len(raw.c) else last
    dots = (last == ord("…")) | ((last == ord(".")) & (before == ord(".")))
    rows = some & (~stop | dots)
    # A closing bracket at the end holds a remark, not the end of the answer.
    who = np.flatnonzero(rows)
    if not len(who):
        return who, who, np.zeros((0, ORDER + 3), np.uint64)
    final = w.first[who + 1] - 1
    tail = raw.c[raw.end[who] - 1]
    depth = np.zeros(len(who), dtype=np.int64)
    for n in np.flatnonzero((tail == ord(")")) | (T.take(T.tables()[1], tail) == T.SPACE)):
        depth[n] = _remark(raw, who[n])
    final = np.maximum(final - depth, w.first[who])
    last5 = _last(cls, final, w.first[who])
    # The context may not reach across a sentence end: words before one are left out.
    stops = np.flatnonzero(T.among(x.c, T.STOPS) | (x.c == 10))
    for k in range(ORDER - 1, 0, -1):
        j = final - k
        ok = j >= w.first[who]
        gap_has_stop = np.zeros(len(who), dtype=bool)
        jj = np.maximum(j, 0)
        seg_a, seg_b = w.end[jj], w.start[np.minimum(jj + 1, len(w) - 1)]
        gap_has_stop[ok] = np.searchsorted(stops, seg_b[ok]) > np.searchsorted(stops, seg_a[ok])
        last5[gap_has_stop, : ORDER - k] = 0
    two = _two(last5)
    keys = [*_contexts(last5, ORDER)]
    keys += [_word_key(w.hash[final]), T.mix(two + T.span_hash(x.c, w.start[final], w.end[final])), _after_key(two)]
    # Answers that loop are no cases: the last words were said before.
    h4 = T.ngram_hash(cls, 4)
    loop = np.zeros(len(who), dtype=bool)
    for n, (i, f) in enumerate(zip(who.tolist(), final.tolist(), strict=True)):
        if f - w.first[i] >= 5:
            own = h4[w.first[i] : f - 2]
            loop[n] = (own == own[-1]).sum() >= 3 or len(set(own.tolist())) < 0.6 * len(own)
    dangling = T.among(last[who], _DANGLING)
    ask = ~loop & ~dangling
    return who[dangling & ~loop], who[ask], np.stack(keys, axis=1)[ask]


def _remark(raw: T.Codes, i: int) -> int:
    """Words of a bracketed remark that ends row i."""
    s = raw.text(i).rstrip()
    if s.endswith(")") and "(" in s:
        return len(s[s.rindex("(") :].split())
    return 0


def defects(df: DataFrame, sample_rows: int = SAMPLE_ROWS) -> DataFrame:
    """(row_id, defect) of each pair that doesn't serve, of (row_id, instruction, response, lang).

    Null, blank and placeholder responses are ``empty`` whatever the prompt; a null or blank prompt can't be copied
    or answered in another language. Repeated rows count each; an empty table gives no row; other columns
    are ignored. A pair has one type, the first of empty, copied, refusal, other_language, truncated.
    """
    df = df.select("row_id", "instruction", "response", "lang")
    s = bounded_sample(df, "row_id", sample_rows).where(F.length("response") > 20).select("response", canonical_label(F.col("lang")).alias("label")).toArrow()
    texts = s["response"].combine_chunks() if s.num_rows else pa.array([], pa.string())
    model = shared(df.sparkSession, (nb.train_languages(texts, s["label"].to_pylist())[0], refusals.train(texts, _numbered)))
    known = shared(df.sparkSession, known_skeletons(df))

    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        language, declines = model.value
        uid = TaskContext.get().partitionId() << 40
        for b in T.slices(it, ["instruction", "response"]):
            found, open_, keys = find(b, language, declines, known.value)
            at = np.flatnonzero(found != None)  # noqa: E711
            rows = np.concatenate([at, open_])
            if not len(rows):
                continue
            offsets = np.concatenate([np.zeros(len(at) + 1, np.int32), np.arange(1, len(open_) + 1, dtype=np.int32) * (ORDER + 3)])
            lists = pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(keys.reshape(-1).view(np.int64)))
            yield pa.RecordBatch.from_arrays([b.column("row_id").take(pa.array(rows)), pa.array([*found[at], *[None] * len(open_)], pa.string()), pa.array(uid + np.arange(len(rows))), lists], names=["row_id", "defect", "uid", "keys"])
            uid += len(rows)

    # Two later steps read it: written once, it needs no second look at the texts.
    found = checkpointed(df.select("row_id", "instruction", "response").mapInArrow(run, "row_id long, defect string, uid long, keys array<long>"))
    open_ = found.where("defect is null").select("row_id", "uid", "keys")
    ends = likelihoods(open_, end_counts(df, known, bitmap(open_.select(F.explode("keys").alias("key")))))
    cut = ends.where((F.col("p") < END_LIKELIHOOD) | F.col("cut")).select("row_id", F.lit("truncated").alias("defect"))
    return found.where("defect is not null").select("row_id", "defect").unionByName(cut)


def p1_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return defects(table(spark, sf_dir, "train_smoke", "row_id", "instruction", "response", "lang"))

"""Scalar text features as Column functions. Unless said otherwise null gives null and the empty text is a text of length 0."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from corpusloom.functions.wordlists import MEETING

DEVANAGARI = "ऀ-ॿ"
#: White space as Python's str.split has it.
SPACE = r"(?U)[\s\x1c-\x1f]+"
#: What Python's \w matches; vowel signs are not among it.
WORD_CHAR = r"[\p{L}\p{N}_]"
#: Python's \b: between such a character and none.
BOUNDARY = rf"(?:(?<={WORD_CHAR})(?!{WORD_CHAR})|(?<!{WORD_CHAR})(?={WORD_CHAR}))"


def pyregex(pattern: str, ignore_case: bool = False) -> str:
    r"""A Python pattern in Java's dialect: \b as Python has it, case folding over all of Unicode."""
    return ("(?iu)" if ignore_case else "") + pattern.replace(r"\b", BOUNDARY)


def let(value: Column, body) -> Column:
    """``body`` of a value that is computed once, however often the body names it."""
    return F.try_element_at(F.transform(F.array(value), body), F.lit(1))


def count_chars(t: Column, char_class: str) -> Column:
    """Characters of ``t`` in the class (written without brackets)."""
    return F.length(F.regexp_replace(t, f"[^{char_class}]+", ""))


def _share(part: Column, whole: Column) -> Column:
    return part.cast("double") / F.greatest(F.lit(1), whole)


def script_share_of_text(t: Column, script: str = DEVANAGARI) -> Column:
    """characters of the script over all characters; 0 for the empty text."""
    return _share(count_chars(t, script), F.length(t))


def script_share_of_letters(t: Column, script: str = DEVANAGARI) -> Column:
    """letters of the script over letters. Vowel signs are no letters."""
    letters = F.regexp_replace(t, r"[^\p{L}]+", "")
    return _share(count_chars(letters, script), F.length(letters))


def script_share_of_marked(t: Column, script: str = DEVANAGARI) -> Column:
    """characters of the script over letters and characters of the script."""
    return _share(count_chars(t, script), count_chars(t, r"\p{L}" + script))


def latin_share(t: Column) -> Column:
    """ASCII letters over letters."""
    return _share(count_chars(t, "A-Za-z"), count_chars(t, r"\p{L}"))


def strip(t: Column) -> Column:
    """A text without white space at its ends, as Python's str.strip."""
    return F.regexp_replace(t, rf"(?U)^[\s\x1c-\x1f]+|[\s\x1c-\x1f]+$", "")


def words(t: Column) -> Column:
    """the words between white space."""
    return F.filter(F.split(t, SPACE), lambda x: x != "")


def word_count(t: Column) -> Column:
    """how many words lie between white space; no array of them is made."""
    return F.regexp_count(t, F.lit(r"(?U)[^\s\x1c-\x1f]+"))


def is_blank(t: Column) -> Column:
    """Whether a text has nothing but white space."""
    return ~t.rlike(r"(?U)[^\s\x1c-\x1f]")


def token_word_count(t: Column) -> Column:
    """runs of Latin or Devanagari letters, signs and apostrophes."""
    return F.regexp_count(t, F.lit(f"[A-Za-z{DEVANAGARI}']+"))


def content_words(t: Column) -> Column:
    """distinct lower-case words of three or more Devanagari or four or more Latin characters."""
    return F.array_distinct(F.transform(F.regexp_extract_all(t, F.lit(f"([{DEVANAGARI}]{{3,}}|[a-zA-Z]{{4,}})"), F.lit(1)), F.lower))


def trigram_uniqueness(w: Column) -> Column:
    """F8: distinct word trigrams over trigrams of an array of words; null below three words."""

    def unique(w: Column) -> Column:
        n = F.size(w)
        grams = F.transform(F.sequence(F.lit(1), F.greatest(n - 2, F.lit(1))), lambda i: F.concat_ws("\x01", F.get(w, i - 1), F.get(w, i), F.get(w, i + 1)))
        return F.when(n >= 3, F.size(F.array_distinct(grams)) / (n - 2))

    return let(w, unique)


def sha1_key(t: Column, hexes: int = 16) -> Column:
    """the first hex digits of the SHA-1 of the text's UTF-8 bytes."""
    return F.substring(F.sha1(F.encode(t, "UTF-8")), 1, hexes)


def content_hash(t: Column) -> Column:
    """SHA-256 of the text."""
    return F.sha2(t, 256)


def strip_list_mark(t: Column) -> Column:
    """a text without list marks, numbers and quotes at its start and quotes at its end."""
    return F.regexp_replace(F.regexp_replace(t, r"^[\s\-*•\d.)]+", ""), "^[\"'“”]+|[\"'“”]+$", "")


def prose_tokens(t: Column, bytes_per_token: float = 3.2) -> Column:
    """tokens by UTF-8 bytes: 3.2 bytes a token of prose, 2.8 of JSON."""
    return F.ceil(F.octet_length(t) / F.lit(bytes_per_token)).cast("long")


def message_tokens(role: Column, content: Column) -> Column:
    """F16: four for the frame and the content's, tool results being JSON; null content counts nothing."""
    return F.lit(4) + F.coalesce(F.when(role == "tool", prose_tokens(content, 2.8)).otherwise(prose_tokens(content)), F.lit(0))


def preview(t: Column, chars: int) -> Column:
    """one line, at most ``chars`` characters, with an ellipsis where something is left out."""
    line = F.regexp_replace(t, r"\s+", " ")
    return F.when(F.length(line) > chars, F.concat(F.substring(line, 1, chars), F.lit("..."))).otherwise(line)


def render_chat(messages: Column) -> Column:
    """role-marked turns, one after another; an empty conversation is the empty text."""
    return F.array_join(F.transform(messages, lambda m: F.concat(F.lit("<|im_start|>"), m.role, F.lit("\n"), F.coalesce(m.content, F.lit("")), F.lit("<|im_end|>\n"))), "")


def masked(t: Column) -> Column:
    """the first and last two characters of the trimmed text, stars between; all stars up to four characters."""
    s, n = F.trim(t), F.length(F.trim(t))
    return F.when(n <= 4, F.repeat(F.lit("*"), n)).otherwise(F.concat(F.substring(s, 1, 2), F.repeat(F.lit("*"), n - 4), F.substring(s, -2, 2)))


def is_card_number(t: Column) -> Column:
    """13 to 19 digits that pass the Luhn check, whatever stands between them."""
    d = F.regexp_replace(t, r"\D", "")
    return F.length(d).between(13, 19) & F.call_function("luhn_check", d)


def edit_similarity(a: Column, b: Column) -> Column:
    """one less the edit distance over the longer length, of trimmed lower-case texts; two empty texts are equal."""
    x, y = F.lower(F.trim(a)), F.lower(F.trim(b))
    n = F.greatest(F.length(x), F.length(y))
    return F.when(n == 0, F.lit(1.0)).otherwise(1 - F.levenshtein(x, y) / n)


def clean_subject(t: Column) -> Column:
    """a subject without one leading reply or forward mark."""
    return F.regexp_replace(t, r"(?i)^(re:|fwd:|fw:)\s*", "")


def file_kind(name: Column, kinds: dict[str, str]) -> Column:
    """kind of a file by its extension; ``other`` without a known one."""
    ext = F.lower(F.regexp_extract(name, r"\.([^.]+)$", 1))
    pairs = [F.lit(x) for kind, exts in kinds.items() for e in exts.split() for x in (e, kind)]
    return F.coalesce(F.try_element_at(F.create_map(*pairs), ext), F.lit("other"))


def clean_path(p: Column) -> Column:
    """home expanded, slashes merged, none at the end, lower case."""
    return F.lower(F.regexp_replace(F.regexp_replace(F.regexp_replace(p, "^~/", "/home/user/"), "/+", "/"), "(?<=.)/$", ""))


def haversine_km(lat1: Column, lon1: Column, lat2: Column, lon2: Column, radius: float = 6371.0) -> Column:
    """great-circle distance."""
    a = F.pow(F.sin(F.radians(lat2 - lat1) / 2), 2) + F.cos(F.radians(lat1)) * F.cos(F.radians(lat2)) * F.pow(F.sin(F.radians(lon2 - lon1) / 2), 2)
    return F.lit(2 * radius) * F.asin(F.least(F.lit(1.0), F.sqrt(a)))


def grid_points(lat: Column, lon: Column, size_km: Column, n: int) -> Column:
    """``n`` points of a square grid around a centre, row by row, as (i, lat, lon)."""
    side = int(n**0.5) + (int(n**0.5) ** 2 < n)
    step = size_km / side
    off = lambda k: (k - (side - 1) / 2) * step
    point = lambda i: F.struct(
        i.alias("i"), F.round(lat + off(F.floor(i / side)) / 111.0, 6).alias("lat"), F.round(lon + off(i % side) / (111.0 * F.cos(F.radians(lat))), 6).alias("lon")
    )
    return F.transform(F.sequence(F.lit(0), F.lit(n - 1)), point)


def bin_centres(start: Column, end: Column, bins: int) -> Column:
    """centres of equal bins of a time span, to the second."""
    width = (F.unix_seconds(end.cast("timestamp")) - F.unix_seconds(start.cast("timestamp"))) / bins
    return F.transform(F.sequence(F.lit(0), F.lit(bins - 1)), lambda i: F.floor(F.unix_seconds(start.cast("timestamp")) + width * i + width / 2))


def parse_box(t: Column) -> Column:
    """(x1, y1, x2, y2) of exactly four ``<n>`` hundredths, rounded to four places; null if not four or not a box."""
    v = F.transform(F.regexp_extract_all(t, F.lit(r"<(\d+)>"), F.lit(1)), lambda x: F.round(x.cast("double") / 100, 4))
    ok = (F.size(v) == 4) & (F.try_element_at(v, F.lit(3)) > F.try_element_at(v, F.lit(1))) & (F.try_element_at(v, F.lit(4)) > F.try_element_at(v, F.lit(2)))
    return F.when(ok, v)


def corner_box(v: Column) -> Column:
    """the box around eight corner coordinates, within 0 and 1."""
    pick = lambda odd: F.filter(v, lambda x, i: i % 2 == odd)
    clamp = lambda x: F.greatest(F.lit(0.0), F.least(F.lit(1.0), x))
    return F.array(*(clamp(f(pick(o))) for f, o in ((F.array_min, 0), (F.array_min, 1), (F.array_max, 0), (F.array_max, 1))))


def multi_hot(labels: Column, classes: list[str]) -> Column:
    """F32: 1.0 for each class among the labels, in order of classes; a label that is no class raises an error, a null one is none."""
    labels = F.array_compact(labels)
    known = F.array(*map(F.lit, classes))
    hot = F.transform(known, lambda c: F.array_contains(labels, c).cast("double"))
    return F.when(F.size(F.array_except(labels, known)) > 0, F.raise_error("unknown label").cast("array<double>")).otherwise(hot)


def metric_key(t: Column) -> Column:
    """lower case, anything else than letters and digits one underscore, none at the ends."""
    return F.regexp_replace(F.regexp_replace(F.lower(t), "[^a-z0-9]+", "_"), "^_+|_+$", "")


def search_terms(t: Column, stopwords: list[str]) -> Column:
    """terms of a search: wi-fi joined, digits apart from letters, no stop words and single letters, plain stemming."""
    s = F.regexp_replace(F.lower(t), r"\bwi[\W_]*fi\b", "wifi")
    s = F.regexp_replace(F.regexp_replace(s, r"(?<=\d)(?=\p{L})|(?<=\p{L})(?=\d)", " "), r"[^\p{L}\p{N}]+", " ")
    terms = F.filter(F.split(s, " "), lambda x: (x != "") & ~x.isin(stopwords) & ((F.length(x) > 1) | x.rlike(r"^\d$")))
    n = F.length
    return F.transform(
        terms,
        lambda x: F.when((n(x) >= 7) & x.endswith("ing"), F.regexp_replace(x, "ing$", ""))
        .when((n(x) >= 6) & x.endswith("ed"), F.regexp_replace(x, "ed$", ""))
        .when((n(x) >= 5) & x.endswith("s") & ~x.endswith("ss"), F.regexp_replace(x, "s$", ""))
        .otherwise(x),
    )


def bigram_set(t: Column, stopwords: list[str]) -> Column:
    """distinct pairs of neighbouring words of which not both are stop words."""

    def pairs(w: Column) -> Column:
        n = F.size(w)
        both = F.transform(F.sequence(F.lit(1), F.greatest(n - 1, F.lit(1))), lambda i: F.struct(F.get(w, i - 1).alias("a"), F.get(w, i).alias("b")))
        both = F.filter(both, lambda p: p["b"].isNotNull() & ~(p["a"].isin(stopwords) & p["b"].isin(stopwords)))
        return F.array_distinct(F.transform(both, lambda p: F.concat_ws(" ", p["a"], p["b"])))

    return let(F.filter(F.split(F.regexp_replace(F.lower(t), r"[^a-z0-9\s]", " "), r"\s+"), lambda x: x != ""), pairs)


def query_mood(t: Column) -> Column:
    """what a query wants: navigate, imperative, question or statement, the first that applies."""
    s = F.lower(strip(t))
    return (
        F.when(s.rlike(r"^(go to|open|take me|show me|navigate)\b"), "navigate")
        .when(s.rlike(r"^(turn|set|enable|disable|restart|reset|pause|block|stop|start|run|change|write|give|suggest|describe|repeat|tell|explain)\b"), "imperative")
        .when(s.rlike(r"\?\s*$") | s.rlike(r"^(how|what|why|when|where|who|which|can|could|is|are|do|does|should)\b"), "question")
        .otherwise("statement")
    )


def task_priority(t: Column) -> Column:
    """high before low, medium without either."""
    return F.when(t.rlike(pyregex(MEETING["high"])), "high").when(t.rlike(pyregex(MEETING["low"])), "low").otherwise("medium")


def whole_words(listed: list[str]) -> str:
    r"""A pattern of the listed words between Python's word boundaries; the words must consist of what \w matches."""
    return rf"(?iu)(?<!{WORD_CHAR})(?:{'|'.join(listed)})(?!{WORD_CHAR})"


def first_of(cases: list[tuple[Column, str]]) -> Column:
    """The first reason whose condition holds, null if none does. A condition that is null doesn't hold."""
    return reduce(lambda acc, c: acc.when(c[0], F.lit(c[1])), cases[1:], F.when(cases[0][0], F.lit(cases[0][1])))


def runs_in(t: Column, listed: list[str], distinct: bool = False, runs: str = f"[{DEVANAGARI}]+") -> Column:
    """Occurrences (or distinct forms) of listed words among a text's maximal runs."""
    all_ = F.regexp_extract_all(t, F.lit(f"({runs})"), F.lit(1))
    hit = F.filter(all_, lambda w: w.isin(listed))
    return F.size(F.array_distinct(hit) if distinct else hit)


def paragraphs(lines: Column) -> Column:
    """texts of an array as paragraphs of one text; nulls are left out."""
    return F.array_join(lines, "\n\n")


def code_of(t: Column, places: list[tuple[str, str]]) -> Column:
    """the code that a text is, else that of the first place (of code, name) whose name it contains, else the text in upper case."""
    up, low = F.upper(F.trim(t)), F.lower(t)
    named = None
    for code, name in places:
        cond = F.contains(low, F.lit(name.lower()))
        named = F.when(cond, code) if named is None else named.when(cond, code)
    return F.when(up.isin([c for c, _ in places]), up).otherwise(named.otherwise(up))


def hash_embedding(t: Column) -> Column:
    """128 numbers from the 64 bytes of a text's SHA-512, said twice, each from -1 to 1, scaled to length 1."""
    half = F.transform(F.sequence(F.lit(0), F.lit(63)), lambda i: F.conv(F.substring(F.sha2(t, 512), i * 2 + 1, F.lit(2)), 16, 10).cast("double") / 127.5 - 1)
    unit = let(half, lambda v: let(F.sqrt(2 * F.aggregate(v, F.lit(0.0), lambda a, x: a + x * x)), lambda n: F.transform(F.concat(v, v), lambda x: F.when(n > 0, x / n).otherwise(x))))
    return F.when(t.isNotNull(), unit)

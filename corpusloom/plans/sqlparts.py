"""Parts of the DuckDB statements that say the same as the Spark expressions."""

from __future__ import annotations

import re

from corpusloom.functions import wordlists as W

DEV = "ऀ-ॿ"
_SPACE = r"[\s\x{0B}\x{1C}-\x{1F}\x{85}\x{A0}\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}]+"


def q(s: str) -> str:
    """A text literal."""
    return "'" + s.replace("'", "''") + "'"


def has(t: str, pattern: str) -> str:
    return f"regexp_matches({t}, {q(pattern)})"


def count(t: str, cls: str) -> str:
    return f"length(regexp_replace({t}, {q(f'[^{cls}]')}, '', 'g'))"


def words(t: str) -> str:
    return f"list_filter(regexp_split_to_array({t}, {q(_SPACE)}), lambda x: x <> '')"


def strip(t: str) -> str:
    return f"regexp_replace({t}, {q('^' + _SPACE + '|' + _SPACE + '$')}, '', 'g')"


def n_words(t: str) -> str:
    return f"len({words(t)})"


def share(a: str, b: str) -> str:
    return f"(({a})::double / greatest(1, {b}))"


def f1(t: str, script: str = DEV) -> str:
    return share(count(t, script), f"length({t})")


def f2(t: str, script: str = DEV) -> str:
    letters = f"regexp_replace({t}, {q('[^' + chr(92) + 'p{L}]')}, '', 'g')"
    return share(count(letters, script), f"length({letters})")


def f3(t: str, script: str = DEV) -> str:
    return share(count(t, script), count(t, r"\p{L}" + script))


def f4(t: str) -> str:
    return share(count(t, "A-Za-z"), count(t, r"\p{L}"))


def unique(w: str) -> str:
    """Of a column that holds an array of words."""
    return f"CASE WHEN len({w}) >= 3 THEN len(list_distinct(list_transform(range(1, len({w}) - 1), lambda i: {w}[i] || chr(1) || {w}[i+1] || chr(1) || {w}[i+2])))::double / (len({w}) - 2) END"


def runs_in(t: str, listed: list[str], distinct: bool = False) -> str:
    hit = f"list_filter(regexp_extract_all({t}, {q(f'[{DEV}]+')}), lambda x: x IN ({', '.join(map(q, listed))}))"
    return f"len(list_distinct({hit}))" if distinct else f"len({hit})"


def seven_alike() -> str:
    """Seven or more of one character in a row, without a back-reference: one alternative for each character of the scripts at hand."""
    chars = [*map(chr, range(0x20, 0x7F)), *map(chr, range(0x900, 0x980)), *map(chr, range(0x980, 0xA00)), *map(chr, range(0xB80, 0xC00)), "…", "​", "😡", "★", "■"]
    return "|".join(re.escape(c).replace(r"\ ", " ") + "{7,}" for c in chars)


def case(cases: list[tuple[str, str]]) -> str:
    return "CASE " + " ".join(f"WHEN {c} THEN {q(v)}" for c, v in cases) + " END"


def text(c: str) -> str:
    return f"coalesce({c}, '')"


def boundary_words(listed: list[str]) -> str:
    return rf"(?i)\b(?:{'|'.join(listed)})\b"


def dangling(t: str, fixed: bool = False) -> str:
    """P14. Words that end in a vowel sign have no boundary after them, so that the plain rule leaves them out."""
    words_ = [w for w in W.DANGLING_HINDI if fixed or not "\u093a" <= w[-1] <= "\u094f" and w[-1] not in "ंःँ"] + W.DANGLING_ENGLISH
    edge = r"\p{L}\p{M}\p{N}_" if fixed else r"\p{L}\p{N}_"
    return has(t, rf"(?i)(?:[,;:]|(?:^|[^{edge}])(?:{'|'.join(words_)}))" + _SPACE[:-1] + "*$")


def first_words(w: str, n: int) -> str:
    return f"array_to_string({w}[1:{n}], ' ')"


def content(t: str) -> str:
    return f"list_distinct(list_transform(regexp_extract_all({t}, '[{DEV}]{{3,}}|[a-zA-Z]{{4,}}'), lambda x: lower(x)))"


def acceptance(r: str, i: str, w: str, budget: str) -> str:
    """P9 for a Hindi slot."""
    bound = lambda k: "CASE " + " ".join(f"WHEN {budget} = {q(b)} THEN {v[k]}" for b, v in W.BUDGETS.items()) + f" ELSE {W.BUDGETS['medium'][k]} END"
    d, p, cw, rw = f1(r), f1(i), content(i), content(r)
    short = W.SHORTHAND.replace(r"(?!\w)", "")
    return case(
        [
            (has(first_words(w, 18), "(?i)" + W.DODGE), "dodge"), (f"NOT {has(r, W.TERMINAL)}", "truncated"), (has(r, "(?i)" + short), "shorthand"), (f"{has(r, '(?i)' + W.REFUSAL_GENERATED)} OR {has(r, '(?i)' + W.REFUSAL_GENERATED_HI)}", "refusal"),
            (f"len({w}) < {bound(2)}", "below-budget"), (f"len({w}) > {bound(3)}", "above-budget"), (f"({p} > 0.35) = ({d} > 0.35) AND len({cw}) > 0 AND len({rw}) > 0 AND len(list_intersect({cw}, {rw}))::double / greatest(1, len({cw})) < 0.08", "unrelated"), (f"{unique(w)} < 0.92", "repetitive"),
            (f"{p} > 0.35 AND {d} < 0.35", "romanized_answer_to_devanagari"), (f"{d} < 0.55", "not_devanagari"),
        ]
    )


def release(qs: str, a: str, blob: str) -> str:
    """P13 where the script is needed."""
    sq, sa = f3(qs), f3(a)
    return case(
        [
            (f"{runs_in(blob, W.AUDIT_MARATHI, True)} > {runs_in(blob, W.GATE_HINDI, True)}", "marathi"), (has(blob, f"[{W.GATE_FOREIGN}]"), "foreign_script"), (f"{sa} < 0.30 AND {sq} > 0.35", "script_mirror"), (f"{sa} > 0.35 AND {sq} < 0.35", "script_mirror_reverse"),
            (dangling(strip(a)), "truncated"), (f"{f3(blob)} < 0.10", "no_devanagari"), (has(first_words(words(a), 18), "(?i)" + W.DODGE), "dodge"), (f"{n_words(a)} < 4", "too_short"),
        ]
    )


QUALITY_FOREIGN = W.CPT_SCRIPTS


def quality(t: str, w: str) -> str:
    """P2's reason of text ``t`` whose words are in column ``w``."""
    oth, own = runs_in(t, W.CPT_MARATHI), runs_in(t, W.CPT_HINDI)
    english = f"len(regexp_extract_all({t}, {q(boundary_words(W.ENGLISH_FUNCTION))}))"
    return case(
        [
            (f"len({w}) < 40", "short"), (f"len({w}) > 1200", "long"), (f"length({t}) > 4000", "chars"), (f"{strip(t)} = ''", "empty"),
            *((has(t, f"[{r}]"), n) for n, r in QUALITY_FOREIGN.items()),
            (has(t, f"[{W.SYMBOLS}]"), "symbols"), (has(t, seven_alike()), "repeat"), (f"{has(t, '(?i)' + W.URL)} OR {has(t, W.EMAIL)}", "url"), (has(t, r"[\p{Nd}]{6,}"), "digits"), (f"NOT {has(t, chr(92) + 'p{L}')}", "noletters"),
            (f"{f2(t)} < 0.70", "not_devanagari"), (f"{f2(t)} > 0.995 AND len({w}) < 60", "stub"), (f"{oth} > 0 AND {oth} > {own}", "marathi"), (f"{oth} >= 3 AND {oth} >= 2 * greatest(1, {own})", "marathi_heavy"), (f"{english} >= 6", "english"), (f"{unique(w)} < 0.88", "loopy"),
        ]
    )


# The terms of a text: what the Spark expression does, in RE2.
STOP = "(" + ", ".join(map(q, W.STOPWORDS)) + ")"


def terms(t: str) -> str:
    s = rf"regexp_replace(lower({t}), '\bwi[\W_]*fi\b', 'wifi', 'g')"
    s = rf"regexp_replace(regexp_replace(regexp_replace({s}, '([0-9])(\p{{L}})', '\1 \2', 'g'), '(\p{{L}})([0-9])', '\1 \2', 'g'), '[^\p{{L}}\p{{N}}]+', ' ', 'g')"
    kept = rf"list_filter(string_split({s}, ' '), lambda x: x <> '' AND x NOT IN {STOP} AND (length(x) > 1 OR regexp_matches(x, '^[0-9]$')))"
    return f"list_transform({kept}, lambda x: CASE WHEN length(x) >= 7 AND x LIKE '%ing' THEN x[:-4] WHEN length(x) >= 6 AND x LIKE '%ed' THEN x[:-3] WHEN length(x) >= 5 AND x LIKE '%s' AND x NOT LIKE '%ss' THEN x[:-2] ELSE x END)"

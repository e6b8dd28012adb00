"""Row gates. Each gives the first reason why a row is rejected, null where it is kept. A null text is an empty one."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusloom.functions import text as X
from corpusloom.functions import wordlists as W
from corpusloom.operators.metrics import percentiles


def _t(t: Column) -> Column:
    return F.coalesce(t, F.lit(""))


def corpus_coarse(t: Column, script: str = X.DEVANAGARI, min_words: int = 40, max_words: int = 1200, max_chars: int = 4000, least_script: float = 0.55, most_latin: float = 0.45) -> Column:
    """Empty, short, long, chars, latin."""
    t = _t(t)
    n = X.word_count(t)
    return (
        F.when(X.is_blank(t), "empty").when(~n.between(min_words, max_words), F.when(n < min_words, "short").otherwise("long")).when(F.length(t) > max_chars, "chars")
        .when((X.script_share_of_text(t, script) < least_script) | (X.latin_share(t) > most_latin), "latin")
    )


def corpus_quality(
    t: Column, script: str = X.DEVANAGARI, foreign: Mapping[str, str] = W.CPT_SCRIPTS, other: Sequence[str] = tuple(W.CPT_MARATHI), own: Sequence[str] = tuple(W.CPT_HINDI), runs: str = f"[{X.DEVANAGARI}]+",
    min_words: int = 40, max_words: int = 1200, max_chars: int = 4000, least_script: float = 0.70, uniqueness: float = 0.88, english: int = 6, names: tuple[str, str, str] = ("not_devanagari", "marathi", "marathi_heavy"),
) -> Column:
    """Short, long, chars, empty, a foreign script by name, symbols, repeat, url, digits, noletters, wrong script, stub,
    other language (by markers), english, loopy. ``empty`` only shows where short texts are allowed (a text without words is short)."""
    t = _t(t)
    share = X.script_share_of_letters(t, script)
    oth, mine = X.runs_in(t, list(other), runs=runs), X.runs_in(t, list(own), runs=runs)
    # Each step is computed only if the ones before gave no reason. What several conditions need stands in the first of them only
    # for almost all texts: that no word of the other language is there, that the number of words is within bounds.
    any_foreign = t.rlike(f"[{''.join(foreign.values())}]")

    def reason(w: Column) -> Column:
        n = F.size(w)
        return F.coalesce(
            F.when(~n.between(min_words, max_words), F.when(n < min_words, "short").otherwise("long")).when(F.length(t) > max_chars, "chars").when(X.is_blank(t), "empty"),
            F.when(any_foreign, X.first_of([(t.rlike(f"[{r}]"), name) for name, r in foreign.items()])) if foreign else F.lit(None).cast("string"),
            X.first_of(
                [
                    (t.rlike(f"[{W.SYMBOLS}]"), "symbols"), (t.rlike(r"(.)\1{6,}"), "repeat"), (t.rlike("(?i)" + W.URL) | (t.contains("@") & t.rlike("(?U)" + W.EMAIL)), "url"), (t.rlike(r"(?U)\d{6,}"), "digits"), (~t.rlike(r"\p{L}"), "noletters"),
                    (share < least_script, names[0]), ((n < 60) & (share > 0.995), "stub"),
                ]
            ),
            F.when(oth > 0, X.first_of([(oth > mine, names[1]), ((oth >= 3) & (oth >= 2 * F.greatest(F.lit(1), mine)), names[2])])),
            X.first_of([(F.regexp_count(t, F.lit(X.whole_words(W.ENGLISH_FUNCTION))) >= english, "english"), (X.trigram_uniqueness(w) < uniqueness, "loopy")]),
        )

    return X.let(X.words(t), reason)


def pair_basic(i: Column, o: Column, allow_script: bool = False, max_chars: int | None = None, script: str = X.DEVANAGARI) -> Column:
    """Script (unless allowed), chars, fence, refusal in the answer only, prompt words 2 to 120, answer words 1 to 600, lengths."""
    i, o = _t(i), _t(o)
    cases = [] if allow_script else [(i.rlike(f"[{script}]") | o.rlike(f"[{script}]"), "script")]
    if max_chars:
        cases.append((F.length(i) + F.length(o) > max_chars, "chars"))
    return X.first_of(
        [*cases, (o.contains("```") | i.contains("```"), "fence"), (o.rlike(X.pyregex(W.REFUSAL_PAIRS, True)), "refusal"), (~X.word_count(i).between(2, 120), "prompt_words"), (~X.word_count(o).between(1, 600), "answer_words"), ((F.length(i) > 1500) | (F.length(o) > 4000), "length")]
    )


def pair_strict(i: Column, o: Column, max_chars: int = 620) -> Column:
    """Empty, fence, refusal on either side, chars, two words on each side."""
    i, o = X.strip(_t(i)), X.strip(_t(o))
    refusal = X.pyregex(W.REFUSAL_PAIRS, True)
    return X.first_of([((i == "") | (o == ""), "empty"), (i.contains("```") | o.contains("```"), "fence"), (i.rlike(refusal) | o.rlike(refusal), "refusal"), (F.length(i) + F.length(o) > max_chars, "chars"), ((X.word_count(i) < 2) | (X.word_count(o) < 2), "words")])


def pair_scripted(i: Column, o: Column, mode: bool | str | None = "any", max_chars: int = 620, other: Sequence[str] = tuple(W.CPT_MARATHI), foreign: str = W.GATE_FOREIGN) -> Column:
    """P5: fence, refusal on either side, presence of another language's marker, foreign script, script by ``mode`` (True: both
    sides have it, False: neither, None: they agree, any), chars, answer of 20 words, prompt of 3."""
    i, o = _t(i), _t(o)
    both = F.concat_ws(" ", i, o)
    refusal = X.pyregex(W.REFUSAL_PAIRS, True)
    di, do = i.rlike(f"[{X.DEVANAGARI}]"), o.rlike(f"[{X.DEVANAGARI}]")
    script = {True: ~(di & do), False: di | do, None: di != do, "any": F.lit(False)}[mode]
    return X.first_of(
        [(both.contains("```"), "fence"), (both.rlike(refusal), "refusal"), (X.runs_in(both, list(other)) > 0, "marathi"), (both.rlike(f"[{foreign}]"), "foreign_script"), (script, "script"), (F.length(i) + F.length(o) > max_chars, "chars"), (X.word_count(o) < 20, "answer_words"), (X.word_count(i) < 3, "prompt_words")]
    )


def metric_at_least(metric: Column, least: float = 70.0) -> Column:
    """Whether a metric, 0 if missing, reaches a threshold."""
    return F.coalesce(metric, F.lit(0.0)) >= least


def language_gate(t: Column, lang: str, other: Sequence[str] = tuple(W.GATE_MARATHI), own: Sequence[str] = tuple(W.GATE_HINDI), latin: Sequence[str] = tuple(W.GATE_MARATHI_LATIN), foreign: str = W.GATE_FOREIGN) -> Column:
    """Empty, foreign_script, and by the slot's language: more distinct forms of another language than of its own, three of them at all, or two romanised ones."""
    t = _t(t)
    m, h = X.runs_in(t, list(other), distinct=True), X.runs_in(t, list(own), distinct=True)
    r = F.when(X.is_blank(t), "empty").when(t.rlike(f"[{foreign}]"), "foreign_script")
    if lang == "hindi":
        # Forms are only counted where one of the other language is there at all.
        counted = F.when(m > h, F.concat(F.lit("marathi_dominated("), m, F.lit(">"), h, F.lit(")"))).when(m >= 3, F.concat(F.lit("marathi_markers("), m, F.lit(")")))
        r = r.when(m > 0, counted)
    if lang == "hinglish":
        r = r.when(F.regexp_count(t, F.lit(X.whole_words(list(latin)))) >= 2, "marathi_romanised")
    return r


def pair_language_gate(i: Column, o: Column, lang: str) -> Column:
    """The answer's reason, else the prompt's."""
    return F.coalesce(language_gate(o, lang), language_gate(i, lang))


def acceptance(r: Column, instruction: Column, target: Column, budget: Column) -> Column:
    """Dodge, truncated, shorthand, refusal, below-budget, above-budget, unrelated, repetitive, and the script by target. A budget that isn't known is ``medium``."""
    r, instruction = _t(r), _t(instruction)
    w = X.words(r)
    n = F.size(w)
    bound = lambda k: F.coalesce(F.try_element_at(F.create_map(*[F.lit(x) for b, v in W.BUDGETS.items() for x in (b, v[k])]), budget), F.lit(W.BUDGETS["medium"][k]))
    d, p = X.script_share_of_text(r), X.script_share_of_text(instruction)
    cw, rw = X.content_words(instruction), X.content_words(r)
    overlap = F.size(F.array_intersect(cw, rw)) / F.greatest(F.size(cw), F.lit(1))
    return X.first_of(
        [
            (F.array_join(F.slice(w, 1, 18), " ").rlike(X.pyregex(W.DODGE, True)), "dodge"), (~r.rlike(W.TERMINAL), "truncated"), (r.rlike(X.pyregex(W.SHORTHAND, True)), "shorthand"), (r.rlike(X.pyregex(W.REFUSAL_GENERATED, True)) | r.rlike(X.pyregex(W.REFUSAL_GENERATED_HI, True)), "refusal"),
            (n < bound(2), "below-budget"), (n > bound(3), "above-budget"), (((p > 0.35) == (d > 0.35)) & (F.size(cw) > 0) & (F.size(rw) > 0) & (overlap < 0.08), "unrelated"), (X.trigram_uniqueness(w) < 0.92, "repetitive"),
            (target.isin("hindi", "hinglish") & (p > 0.35) & (d < 0.35), "romanized_answer_to_devanagari"), ((target == "english") & (d > 0.10), "answer_in_hindi"), ((target == "hinglish") & (d > 0.35), "went_devanagari"), ((target == "hindi") & (d < 0.55), "not_devanagari"),
        ]
    )


def contains_fact(answer: Column, gold: Column) -> Column:
    """P10: whether any gold text stands in the answer, whatever its case; false without gold."""
    return F.coalesce(F.exists(gold, lambda g: F.contains(F.lower(_t(answer)), F.lower(g))), F.lit(False))


def judged(reply: Column, least: int = 4) -> Column:
    """Whether the first digit from 1 to 5 of a judge's reply reaches a threshold; no digit counts 0."""
    return F.coalesce(F.regexp_extract(_t(reply), "[1-5]", 0).try_cast("int"), F.lit(0)) >= least


def structure(r: Column, budget: Column) -> Column:
    """Short for its budget (20 words if unknown), truncated, repetitive."""
    r = _t(r)
    w = X.words(r)
    floor = F.coalesce(F.try_element_at(F.create_map(*[F.lit(x) for b, v in W.BUDGET_FLOORS.items() for x in (b, v)]), budget), F.lit(20))
    return X.first_of([(F.size(w) < floor, "short"), (~r.rlike(W.TERMINAL), "truncated"), (X.trigram_uniqueness(w) < 0.92, "repetitive")])


def dangling(t: Column, fix_devanagari: bool = False) -> Column:
    r"""Whether a text ends on a comma, colon or connective. By default words that end in a vowel sign don't count, as no
    Python \b follows one; ``fix_devanagari`` counts them."""
    words = "|".join([*W.DANGLING_HINDI, *W.DANGLING_ENGLISH])
    if fix_devanagari:
        return _t(t).rlike(rf"(?iuU)(?:[,;:]|(?<![\p{{L}}\p{{M}}\p{{N}}_])(?:{words})(?![\p{{L}}\p{{M}}\p{{N}}_]))\s*$")
    return _t(t).rlike(rf"(?iuU)(?:[,;:]|{X.BOUNDARY}(?:{words}){X.BOUNDARY})\s*$")


def release(q: Column, a: Column, blob: Column, needs_script: Column) -> Column:
    """Marathi, foreign_script, script_mirror and its reverse, truncated, no_devanagari (where needed), dodge, too_short."""
    q, a, blob = _t(q), _t(a), _t(blob)
    sq, sa = X.script_share_of_marked(q), X.script_share_of_marked(a)
    return X.first_of(
        [
            (X.runs_in(blob, W.AUDIT_MARATHI, distinct=True) > X.runs_in(blob, W.GATE_HINDI, distinct=True), "marathi"), (blob.rlike(f"[{W.GATE_FOREIGN}]"), "foreign_script"), ((sa < 0.30) & (sq > 0.35), "script_mirror"), ((sa > 0.35) & (sq < 0.35), "script_mirror_reverse"),
            (dangling(X.strip(a)), "truncated"), (needs_script & (X.script_share_of_marked(blob) < 0.10), "no_devanagari"), (F.array_join(F.slice(X.words(a), 1, 18), " ").rlike(X.pyregex(W.DODGE, True)), "dodge"), (X.word_count(a) < 4, "too_short"),
        ]
    )


def conversation(messages: Column, foreign: str = W.GATE_FOREIGN, votes: bool = False) -> Column:
    """The first failing message's first failing rule (empty, deleted, foreign_script, human_label_reject, low_quality_vote), then
    ends_on_user, starts_on_assistant, not_alternating. Deleted flags and votes are looked at if the messages have them (``votes``)."""

    def one(m: Column) -> Column:
        r = F.when(X.strip(_t(m.content)) == "", "empty")
        if votes:
            r = r.when(F.coalesce(m.deleted, F.lit(False)), "deleted")
        r = r.when(m.content.rlike(f"[{foreign}]"), "foreign_script")
        if votes:
            bad = [F.coalesce(F.try_element_at(m.labels, F.lit(v)), F.lit(0.0)) >= 0.5 for v in W.REJECT_VOTES]
            any_bad = bad[0]
            for b in bad[1:]:
                any_bad = any_bad | b
            r = r.when(any_bad, "human_label_reject").when((m.role == "assistant") & (F.try_element_at(m.labels, F.lit("quality")) < 0.5), "low_quality_vote")
        return r

    reasons = F.filter(F.transform(messages, one), lambda r: r.isNotNull())
    role = lambda k: F.coalesce(F.try_element_at(messages, F.lit(k)).role, F.lit(""))
    return F.coalesce(
        F.try_element_at(reasons, F.lit(1)),
        X.first_of([(F.coalesce(F.size(messages), F.lit(0)) < 1, "empty"), (role(-1) != "assistant", "ends_on_user"), (role(1) != "user", "starts_on_assistant"), (adjacent_roles(messages), "not_alternating")]),
    )


def adjacent_roles(messages: Column) -> Column:
    """Whether two neighbouring messages have one role."""
    return F.exists(F.sequence(F.lit(1), F.greatest(F.size(messages), F.lit(1))), lambda i: (i > 1) & (F.try_element_at(messages, i).role == F.try_element_at(messages, i - 1).role) & (i > 1))


def conversation_length(messages: Column, least: int = 4, most: int = 8) -> Column:
    """Whether a conversation has so many messages."""
    return F.size(messages).between(least, most)


def any_turn(messages: Column, test) -> Column:
    """Whether any turn's content passes ``test``."""
    return F.coalesce(F.exists(messages, lambda m: test(_t(m.content))), F.lit(False))


def standalone_prompt(t: Column, kind: str) -> Column:
    """Whether a prompt stands by itself, by the rules for its kind: english, hindi or romanised."""
    t = X.strip(_t(t))
    w = X.words(t)
    n = F.size(w)
    if kind == "english":
        bare = F.regexp_replace(F.lower(t), r"[ ?.]+$", "")
        last = F.coalesce(F.try_element_at(X.words(bare), F.lit(-1)), F.lit(""))
        opener = t.rlike(r"(?i)^(is|are|was|were|do|does|did|can|could|will|would|should|has|have|had)\b")
        back = t.rlike(r"(?i)\b(you (said|told|mentioned)|your (answer|response)|as you|that you)\b")
        return n.between(3, 40) & ~last.isin("or", "and", "is", "are", "the", "a", "an") & ~(opener & (n <= 6)) & ~back
    if kind == "hindi":
        back = "आपके जवाब|आपने कहा|आपने बताया|उस समय|जैसा आपने|इसका मतलब|पिछले प्रश्न|ऊपर बताया|आपके पहले|आपके अनुसार|क्या आपने|जैसा कि|और इसके|उसी के|आपका पहला|पहले आप"
        return n.between(5, 45) & ~t.rlike(back) & (X.script_share_of_text(t) >= 0.7) & ~t.contains("\n")
    return n.between(4, 45) & (X.script_share_of_text(t) <= 0.35)


def generated_prompt_language(t: Column) -> Column:
    """Hi or hinglish for a prompt of 2 to 14 words in one script, null for others."""
    t = X.strip_list_mark(_t(t))
    s = X.script_share_of_text(t)
    return F.when(X.word_count(t).between(2, 14), F.when(s >= 0.50, "hi").when(s <= 0.05, "hinglish"))


def expanded_prompt(t: Column) -> Column:
    """P20: whether an expanded prompt is usable: 10 to 28 words, no link, long number or filler, a stop mark at its end."""
    t = X.strip(_t(t))
    return X.word_count(t).between(10, 28) & ~t.rlike(r"(?i)https?://|\d{3,}|lorem|TODO") & t.rlike(r"[?।.!]$")


def quantile_filter(df: DataFrame, column: str, q: float = 0.9) -> DataFrame:
    """Rows whose value is at most the interpolated quantile, cut to a whole number. Nulls are dropped; an empty table stays empty."""
    limit = percentiles(df, [], column, {"_q": ("interpolated", q)}).select(F.floor("_q").alias("_limit"))  # one row
    return df.join(F.broadcast(limit), F.lit(True)).where(F.col(column) <= F.col("_limit")).drop("_limit")


def anomalies(df: DataFrame, row: str, rules: Sequence[Mapping]) -> DataFrame:
    """(row, rule, field, value, detail) of rule violations: range (below, above), z_score (population deviation, strictly
    beyond), missing (null or empty), pattern (texts that don't match). A rule is a mapping with rule, field and its parameters."""
    parts = []
    for r in rules:
        f, kind = F.col(r["field"]), r["rule"]
        text = f.cast("string")
        if kind == "range":
            v = f.try_cast("double")
            for cond, side in ((v < r["min"] if r.get("min") is not None else None, "below minimum"), (v > r["max"] if r.get("max") is not None else None, "above maximum")):
                if cond is not None:
                    parts.append(df.where(cond).select(row, F.lit(kind).alias("rule"), F.lit(r["field"]).alias("field"), text.alias("value"), F.lit(side).alias("detail")))
        elif kind == "z_score":
            v = f.try_cast("double")
            s = df.agg(F.avg(v).alias("_m"), F.stddev_pop(v).alias("_s")).where("_s > 0")
            parts.append(df.join(F.broadcast(s), F.lit(True)).where(F.abs((v - F.col("_m")) / F.col("_s")) > r.get("threshold", 2.0)).select(row, F.lit(kind).alias("rule"), F.lit(r["field"]).alias("field"), text.alias("value"), F.lit("outlier").alias("detail")))
        elif kind == "missing":
            parts.append(df.where(f.isNull() | (text == "")).select(row, F.lit(kind).alias("rule"), F.lit(r["field"]).alias("field"), text.alias("value"), F.lit("missing").alias("detail")))
        elif kind == "pattern":
            parts.append(df.where(~text.rlike(r["pattern"])).select(row, F.lit(kind).alias("rule"), F.lit(r["field"]).alias("field"), text.alias("value"), F.lit("no match").alias("detail")))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def auto_rules(df: DataFrame, least: int = 5) -> list[dict]:
    """A z-score rule for each column with at least ``least`` numbers, a missing rule for all."""
    counts = df.agg(*(F.count(F.col(c).try_cast("double")).alias(c) for c, t in df.dtypes if t in ("int", "bigint", "double", "float", "string"))).first().asDict()
    return [{"rule": "z_score", "field": c, "threshold": 2.0} for c, n in counts.items() if n >= least] + [{"rule": "missing", "field": c} for c in df.columns]


def deflection(t: Column) -> Column:
    """Incomplete, question_back (short and asking) or deflected answers, null for others."""
    s = F.lower(_t(t))
    has = lambda *p: F.exists(F.array(*map(F.lit, p)), lambda x: F.contains(s, x))
    return X.first_of([(has("let me", "i'll now", "i will now", "next, i") & ~has("done", "completed", "finished"), "incomplete"), ((F.octet_length(s) < 300) & s.contains("?"), "question_back"), (has("i can't", "i cannot", "unable to", "don't have access"), "deflected")])


def like_search(q: str, *columns: Column) -> Column:
    """Whether any column holds the text, whatever its ASCII case; % and _ of the text are wildcards."""
    out = F.lit(False)
    for c in columns:
        out = out | F.coalesce(c.ilike(f"%{q}%"), F.lit(False))
    return out


def conjunction(predicates: Sequence[Column | None]) -> Column:
    """All predicates given; true without any."""
    out = F.lit(True)
    for p in predicates:
        if p is not None:
            out = out & p
    return out


def overlaps(start: Column, end: Column, a: Column, b: Column, closed: bool = False) -> Column:
    """Whether two intervals overlap, as half-open or closed ones."""
    return ((start <= b) & (end >= a)) if closed else ((start < b) & (end > a))


def eval_gates(t: Column, kind: str) -> Column:
    """Whether an answer passes its script gate: hindi, hinglish or english."""
    t = _t(t)
    n, d = X.word_count(t), X.script_share_of_text(t)
    return {"hindi": d > 0.55, "hinglish": (n >= 20) & (d < 0.35), "english": (n >= 25) & (X.latin_share(t) > 0.7)}[kind]


def assert_release(df: DataFrame, least: int, langs: Sequence[str] = ("hindi", "hinglish")) -> None:
    """Raises unless a release has no row of another language, only known languages and enough rows."""
    r = df.agg(F.count("*").alias("n"), F.count_if(language_gate(F.col("response"), "hindi").startswith("marathi")).alias("other"), F.count_if(~F.col("lang").isin(list(langs))).alias("langs")).first()
    if r.n < least or r.other or r.langs:
        raise AssertionError(f"release rejected: {r.asDict()}")


def prompt_fits(messages: Column, most: int = 6000) -> Column:
    """Whether messages have so many characters together at most and no JSON reference."""
    size = F.aggregate(messages, F.lit(0), lambda a, m: a + F.coalesce(F.length(m.content), F.lit(0)))
    return (size <= most) & ~any_turn(messages, lambda t: t.contains('"$ref"'))


def example_reason(messages: Column, tools: Sequence[str]) -> Column:
    """P25: why a tool-call example is invalid: not system, user and assistant, no bracketed call, or an unknown tool."""
    roles = F.transform(messages, lambda m: m.role)
    last = _t(F.try_element_at(messages, F.lit(-1)).content)
    name = F.regexp_extract(last, r"^\s*\[([A-Za-z_][\w.]*)\(.*\)\]\s*$", 1)
    return X.first_of([(F.coalesce(~roles.eqNullSafe(F.array(*map(F.lit, ("system", "user", "assistant")))), F.lit(True)), "roles"), (name == "", "call"), (~name.isin(list(tools)), "tool")])

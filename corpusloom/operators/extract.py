"""Extraction from text and JSON."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from corpusloom.functions import text as X
from corpusloom.functions import wordlists as W

#: Line ends as Python's str.splitlines has them.
BREAKS = r"\r\n|[\n\r\x0b\x0c\x1c-\x1e\x85\u2028\u2029]"


def html_text(t: Column) -> Column:
    """Scripts, styles and tags removed, white space collapsed; entities stay."""
    s = F.regexp_replace(F.regexp_replace(t, r"(?is)<script[^>]*>.*?</script>", ""), r"(?is)<style[^>]*>.*?</style>", "")
    return F.trim(F.regexp_replace(F.regexp_replace(s, "<[^>]+>", " "), r"\s+", " "))


def findings(df: DataFrame, key: str, text: str, patterns: Mapping[str, str], luhn: tuple[str, ...] = ("credit_card",), first: str | None = None) -> DataFrame:
    """(key, line, kind, masked, context) of every match in every line, lines from 1; kinds in ``luhn`` need the check digit.

    One look at the whole text comes first, so that lines are cut of few texts only: with ``first``, a pattern that every text with a finding has
    (``W.SENSITIVE`` for the known kinds), or else with all patterns. Null and empty texts give no row.
    """
    rules = {k: X.pyregex(p) for k, p in patterns.items()}
    some = df.where(F.col(text).rlike(first or "|".join(f"(?:{p})" for p in rules.values())))
    lines = some.select(key, F.posexplode(F.split(F.col(text), BREAKS)).alias("_i", "_line"))
    lines = lines.where(F.col("_line").rlike(first)) if first else lines
    per = F.array(*(F.struct(F.lit(k).alias("kind"), F.regexp_extract_all("_line", F.lit(f"({p})"), F.lit(1)).alias("found")) for k, p in rules.items()))
    hits = lines.select(key, "_i", "_line", F.explode(per).alias("_p")).select(key, "_i", "_line", F.col("_p.kind").alias("kind"), F.explode("_p.found").alias("_m"))
    hits = hits.where(~F.col("kind").isin(list(luhn)) | X.is_card_number(F.col("_m")))
    return hits.select(key, (F.col("_i") + 1).alias("line"), "kind", X.masked(F.col("_m")).alias("masked"), F.substring(X.strip(F.col("_line")), 1, 200).alias("context"))


def cleanup_actions(found: DataFrame, key: str, actions: Mapping[str, tuple[str, str]] = W.CLEANUP) -> DataFrame:
    """One action for each key and kind, with severity and matches."""
    pick = lambda i, default: F.coalesce(F.try_element_at(F.create_map(*[F.lit(x) for k, v in actions.items() for x in (k, v[i])]), F.col("kind")), F.lit(default))
    return found.groupBy(key, "kind").agg(F.count("*").alias("matches"), F.min("line").alias("first_line")).select(key, "kind", "matches", "first_line", pick(0, "redact").alias("action"), pick(1, "medium").alias("severity"))


def _spoken(df: DataFrame, key: str, text: str) -> DataFrame:
    """Texts that aren't blank, each under a number of its own (``_u``), with their stripped lines (``_s``)."""
    t = df.where(F.col(text).rlike(r"(?U)\S")).select(key, F.col(text).alias("_t"), F.monotonically_increasing_id().alias("_u"))
    return t.withColumn("_s", F.transform(F.split("_t", BREAKS), X.strip))


def _items(spoken: DataFrame, key: str) -> DataFrame:
    m = {k: X.pyregex(p).replace(r"@(\w+)", f"@({X.WORD_CHAR}+)") for k, p in W.MEETING.items()}
    s, line = F.col("_s"), F.col("line")
    near = lambda i, x: F.array_join(F.filter(F.array(F.when(i > 0, F.get(s, i - 1)), x, F.get(s, i + 1)), lambda y: y.isNotNull() & (y != "")), " ")
    rows = F.transform(s, lambda x, i: F.struct(i.alias("i"), x.alias("line"), near(i, x).alias("context")))
    # Of a text only the lines that someone's name begins or that say something of interest leave the row.
    said = "|".join(f"(?:{m[k]})" for k in ("marker", "phrase", "commitment", "decision", "question"))
    rows = F.filter(rows, lambda r: r["line"].rlike(m["speaker"]) | r["line"].rlike(said) | r["line"].contains("?"))
    t = spoken.select(key, "_u", F.inline(rows)).withColumn("label", F.nullif(F.regexp_extract("line", m["speaker"], 1), F.lit("")))
    t = t.withColumn("speaker", F.last("label", True).over(Window.partitionBy("_u").orderBy("i")))
    first = lambda x, k, g=1: F.trim(F.regexp_extract(x, m[k], g))
    bare = F.when(F.col("label").isNotNull(), X.strip(F.regexp_replace(line, m["speaker"], ""))).otherwise(line)
    marked, task = line.rlike(m["marker"]), first(line, "marker")
    said_in = F.when(marked, task).otherwise(line)
    level = F.when(said_in.rlike(m["high"]), "high").when(said_in.rlike(m["low"]), "low").otherwise("medium")
    mention = F.nullif(F.regexp_extract(said_in, m["mention"], 1), F.lit(""))
    item = lambda cond, kind, who, content, deadline, priority: F.when(cond, F.struct(F.lit(kind).alias("kind"), who.alias("who"), content.alias("content"), deadline.alias("deadline"), priority.alias("priority")))
    none = F.lit(None).cast("string")
    found = F.array(
        item(marked | line.rlike(m["phrase"]), "action", F.coalesce(mention, "speaker", F.lit("Unassigned")), F.when(marked, task).otherwise(bare), first(said_in, "deadline"), level),
        item(line.rlike(m["commitment"]), "commitment", F.coalesce("speaker", F.lit("Unknown")), first(line, "commitment", 2), first(line, "deadline"), none),
        item(line.rlike(m["decision"]), "decision", F.coalesce("speaker", F.lit("Group")), first(line, "decision"), none, none),
        item((line.contains("?") | line.rlike(m["question"])) & (bare != ""), "question", none, bare, none, none),
    )
    t = t.select(key, "_u", (F.col("i") + 1).alias("line"), "context", F.inline(F.array_compact(found)))
    # A question that a text asks again counts once.
    again = F.row_number().over(Window.partitionBy("_u", "kind", "content").orderBy("line"))
    return t.withColumn("_n", again).where("kind != 'question' or _n = 1").drop("_n")


def meeting_items(df: DataFrame, key: str, text: str) -> DataFrame:
    """(key, line, kind, who, content, deadline, priority, context) of actions, commitments, decisions and open questions in transcripts.

    Who is mentioned, or else speaks; the context is the line and its neighbours. Null and blank texts give no row; repeated rows count each.
    """
    return _items(_spoken(df, key, text), key).select(key, "line", "kind", "who", "content", "deadline", "priority", "context")


def minutes(df: DataFrame, key: str, text: str) -> DataFrame:
    """(key, minutes): attendees, discussion, actions, decisions and open questions of a transcript, as one text. A text that is null or
    blank has none to tell."""
    spoken = _spoken(df, key, text)
    i = _items(spoken, key)
    line = lambda kind, say: F.transform(F.array_sort(F.collect_list(F.when(F.col("kind") == kind, F.struct("line", say.alias("say"))))), lambda x: x["say"])
    due, grade = F.when(F.col("deadline") != "", F.concat(F.lit(" (due: "), "deadline", F.lit(")"))).otherwise(""), F.when(F.col("priority") != "medium", F.concat(F.lit(" ["), "priority", F.lit("]"))).otherwise("")
    # One text's lines only are gathered.
    per = i.groupBy("_u").agg(
        line("action", F.concat(F.lit("- **"), "who", F.lit("**: "), "content", due, grade)).alias("_actions"), line("decision", F.concat(F.lit("- "), "content", F.lit(" ("), "who", F.lit(")"))).alias("_decisions"),
        line("question", F.concat(F.lit("- "), "content")).alias("_questions"),
    )
    names = F.array_sort(F.array_distinct(F.filter(F.transform("_s", lambda x: F.regexp_extract(x, W.MEETING["speaker"], 1)), lambda x: x != "")))
    none = F.array().cast("array<string>")
    full = lambda x, empty: F.when(F.size(F.coalesce(x, none)) > 0, x).otherwise(F.array(F.lit(empty)))
    head = lambda x: F.array(F.lit(f"### {x}\n"))
    topics = F.flatten(F.transform(sections(F.col("_t")), lambda x, k: F.array(F.concat(F.lit("**Topic "), (k + 1).cast("string"), F.lit("**\n")), X.strip(x), F.lit(""))))
    gap = F.array(F.lit(""))
    asked = F.when(F.size(F.coalesce("_questions", none)) > 0, F.concat(head("Open Questions"), F.col("_questions"), gap)).otherwise(none)
    parts = F.concat(
        F.array(F.lit("## Meeting Minutes\n")), head("Attendees"), full(F.transform(names, lambda x: F.concat(F.lit("- "), x)), "- (no speakers identified)"), gap, head("Discussion"), topics,
        head("Action Items"), full(F.col("_actions"), "- (none identified)"), gap, head("Decisions"), full(F.col("_decisions"), "- (none identified)"), gap, asked,
    )
    told = spoken.join(per, "_u", "left").select(key, F.array_join(parts, "\n").alias("minutes"))
    blank = df.where(F.col(text).isNull() | ~F.col(text).rlike(r"(?U)\S")).select(key, F.lit("## Meeting Minutes\n\nNo transcript content provided.\n").alias("minutes"))
    return told.unionByName(blank)


def extract_field(t: Column, name: str) -> Column:
    """(value, confidence) of a field by its name: amount, date, email, phone, number, else ``name: value``."""
    n = name.lower()
    if any(x in n for x in ("amount", "total", "price", "cost")):
        v, c = F.regexp_extract(t, r"\$?\s?(\d[\d,]*\.\d{2})", 1), 0.8
    elif "date" in n:
        v, c = F.regexp_extract(t, r"(\d{4}-\d{2}-\d{2}|\d{1,2}/\d{1,2}/\d{2,4})", 1), 0.9
    elif "email" in n:
        v, c = F.regexp_extract(t, r"([\w.+-]+@[\w-]+\.[\w.]*\w)", 1), 0.9
    elif "phone" in n:
        v, c = F.regexp_extract(t, r"(\+?\d[\d\s().-]{7,}\d)", 1), 0.7
    elif any(x in n for x in ("number", "count", "id")):
        v, c = F.regexp_extract(t, r"(\d+)", 1), 0.5
    else:
        v, c = F.trim(F.regexp_extract(t, rf"(?im)^\s*{name}\s*[:=]\s*(.+)$", 1)), 0.6
    return F.struct(F.when(v != "", v).alias("value"), F.when(v != "", F.lit(c)).otherwise(0.0).alias("confidence"))


def suggestions(df: DataFrame, key: str, text: str, rules: Mapping[str, tuple[str, float]] = W.SUGGESTIONS, elements: Column | None = None) -> DataFrame:
    """(key, action, confidence, rank) of every rule whose pattern the text has, the most confident first. Rules that only the text of
    ``elements`` (an array of texts) has count for nine tenths. Null and blank texts have none of their own."""
    other = F.lit("") if elements is None else F.array_join(F.filter(elements, lambda x: x != ""), " ")
    here = lambda p: F.coalesce(F.col(text).rlike(X.pyregex(p)), F.lit(False))
    found = lambda c, i, a: F.struct((-c).alias("_c"), F.lit(i).alias("_i"), F.lit(a).alias("action"))
    hits = [F.when(here(p), found(F.lit(conf), i, a)).when(other.rlike(X.pyregex(p)), found(F.lit(conf) * 0.9, i + len(rules), a)) for i, (a, (p, conf)) in enumerate(rules.items())]
    t = df.select(key, F.posexplode(F.array_sort(F.array_compact(F.array(*hits)))).alias("rank", "_h"))
    return t.select(key, "_h.action", (-F.col("_h._c")).alias("confidence"), "rank")


def calls_text(calls: Column) -> Column:
    """X11: tool calls (name, arguments) as bracketed text."""
    return F.concat(F.lit("["), F.array_join(F.transform(calls, lambda c: F.concat(c["name"], F.lit("("), F.coalesce(c["arguments"], F.lit("")), F.lit(")"))), ", "), F.lit("]"))


def json_field(t: Column, path: str) -> Column:
    """A field of JSON text, as it stands or inside a fence; null if it isn't JSON."""
    body = F.when(t.contains("```"), F.regexp_extract(t, r"(?s)```(?:json)?\s*(\{.*?\})\s*```", 1)).otherwise(t)
    return F.get_json_object(body, path)


def tagged(t: Column, tags: tuple[str, ...]) -> Column:
    """The first of the tags that the text has, else none."""
    out = None
    for x in tags:
        out = F.when(F.contains(t, F.lit(f"[{x}]")), x) if out is None else out.when(F.contains(t, F.lit(f"[{x}]")), x)
    return out.otherwise("none")


def merged_context(t: Column, context: Column) -> Column:
    """A prompt with its context under it, if there is one."""
    c = F.trim(F.coalesce(context, F.lit("")))
    return F.when(c != "", F.concat_ws("\n\n", t, c)).otherwise(t)


def time_expression(t: Column, now: Column) -> Column:
    """When a time expression ends: for N hours (1 to 24), until tomorrow (8:00), tonight (the next 21:00), until h[:mm][am|pm] (the next one); null without one."""
    s = F.lower(t)
    day = F.date_trunc("day", now)
    hours = F.regexp_extract(s, r"for (\d{1,2}) hours?", 1).try_cast("int")
    h, m, ap = (F.regexp_extract(s, r"until (\d{1,2})(?::(\d{2}))?\s*(am|pm)?", k) for k in (1, 2, 3))
    hour = F.when((ap == "pm") & (h.try_cast("int") < 12), h.try_cast("int") + 12).when((ap == "am") & (h.try_cast("int") == 12), F.lit(0)).otherwise(h.try_cast("int"))
    at = lambda hh, mm=F.lit(0): day + F.make_dt_interval(F.lit(0), hh, mm)
    nxt = lambda x: F.when(x > now, x).otherwise(x + F.expr("interval 1 day"))
    return (
        F.when(hours.between(1, 24), now + F.make_dt_interval(F.lit(0), hours))
        .when(s.rlike(r"until tomorrow"), day + F.expr("interval 1 day 8 hours"))
        .when(s.rlike(r"bedtime|tonight"), nxt(at(F.lit(21))))
        .when((h != "") & (hour < 24), nxt(at(hour, F.coalesce(m.try_cast("int"), F.lit(0)))))
    )


def slots(t: Column, rules: Mapping[str, str]) -> Column:
    """The canonical name of the first pattern that the text has; null without one."""
    out = None
    s = F.lower(t)
    for name, p in rules.items():
        out = F.when(s.rlike(p), name) if out is None else out.when(s.rlike(p), name)
    return out


def request_slots(t: Column, devices: Mapping[str, str] | None = None) -> Column:
    """A struct of the slots of a request: device (of the caller's own catalogue), action, time, place, error and urgency; null where there is none."""
    low = F.lower(t)
    error = F.nullif(F.regexp_extract(low, W.SLOT_ERROR, 0), F.lit(""))
    lights = F.nullif(F.regexp_extract(low, f"({W.SLOT_LIGHTS})", 1), F.lit(""))
    first = None
    for x in W.SLOT_LIGHTS.split("|"):  # the first of the list, not of the text
        first = F.when(low.contains(x), x) if first is None else first.when(low.contains(x), x)
    return F.struct(
        (slots(t, devices) if devices else F.lit(None).cast("string")).alias("device"), slots(t, W.SLOT_ACTIONS).alias("action"), slots(t, W.SLOT_TIMES).alias("time"), slots(t, W.SLOT_PLACES).alias("place"),
        F.coalesce(error, F.when(lights.isNotNull(), first)).alias("error"), F.coalesce(slots(t, W.SLOT_URGENCY), F.lit("low")).alias("urgency"),
    )


def how_to(df: DataFrame, key: str, title: Column, intro: Column, steps: Column) -> DataFrame:
    """(key, question, answer) of a how-to: its title as a question, the introduction and numbered steps as the answer."""
    body = F.array_join(F.transform(steps, lambda s, i: F.concat((i + 1).cast("string"), F.lit(". "), s)), "\n")
    q = F.when(F.lower(title).startswith("how to"), F.concat(title, F.lit("?"))).otherwise(F.concat(F.lit("How to "), F.lower(title), F.lit("?")))
    return df.select(key, q.alias("question"), F.concat_ws("\n", F.when(F.trim(intro) != "", F.trim(intro)), body).alias("answer"))


def report_rows(t: Column) -> Column:
    """The rows (array of cells) of a fenced benchmark report, told by two blanks between cells; other lines are left out."""
    fence = F.regexp_extract(t, r"(?s)## Tasks\s*```\s*(.*?)```", 1)
    lines = F.filter(F.split(fence, "\n"), lambda x: F.trim(x) != "")
    return F.transform(lines, lambda x: F.split(F.trim(x), r"\s{2,}"))


def sections(t: Column, group: int = 5) -> Column:
    """Parts of a transcript: between blank lines, or ``group`` lines that aren't blank each where there is none."""
    parts = F.filter(F.transform(F.split(X.strip(t), r"\n(?U:\s)*\n"), X.strip), lambda x: x != "")
    lines = F.filter(F.split(t, BREAKS), lambda x: X.strip(x) != "")
    grouped = X.let(lines, lambda v: F.transform(F.sequence(F.lit(0), F.greatest(F.floor((F.size(v) - 1) / group), F.lit(0)).cast("int")), lambda i: F.array_join(F.slice(v, i * group + 1, group), "\n")))
    return F.when(F.size(parts) > 1, parts).otherwise(grouped)

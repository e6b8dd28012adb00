"""Functions that no built-in expresses, as Arrow pandas UDFs. Null gives null."""

from __future__ import annotations

import difflib
import json
import re
import unicodedata
from urllib.parse import unquote_to_bytes

import pandas as pd
from pyspark.sql import functions as F
from pyspark.sql import types as T

from corpusloom.functions.wordlists import NO_TOOLS, REDACT


def _each(fn):
    return lambda s: s.map(lambda x: None if x is None else fn(x))


@F.pandas_udf(T.StringType())
def nfc(s: pd.Series) -> pd.Series:
    """Unicode normal form C."""
    return _each(lambda t: unicodedata.normalize("NFC", t))(s)


def _unquote(t: str) -> str:
    for _ in range(4):
        if not re.search("%[0-9A-Fa-f]{2}", t):
            break
        u = unquote_to_bytes(t).decode("utf-8", "replace")
        if u == t:
            break
        t = u
    return t


@F.pandas_udf(T.StringType())
def percent_decoded(s: pd.Series) -> pd.Series:
    """percent escapes decoded, up to four times over; malformed ones and plus signs stay."""
    return _each(_unquote)(s)


def utf8_prefix(n: int):
    """the longest prefix of at most ``n`` UTF-8 bytes that ends at a character."""

    @F.pandas_udf(T.StringType())
    def prefix(s: pd.Series) -> pd.Series:
        return _each(lambda t: t.encode()[:n].decode("utf-8", "ignore"))(s)

    return prefix


def tokenizer_counts(path: str):
    """tokens by a tokenizer file, special tokens' strings being ordinary text."""

    @F.pandas_udf(T.LongType())
    def count(s: pd.Series) -> pd.Series:
        from tokenizers import Tokenizer

        t = Tokenizer.from_file(path)
        t.encode_special_tokens = True
        texts = [x or "" for x in s]
        return pd.Series([len(e.ids) for e in t.encode_batch(texts, add_special_tokens=False)]).where(s.notna(), None)

    return count


def _loop(t: str, period: int = 1024, least: int = 4, chars: int = 60) -> bool:
    n = len(t)
    for p in range(1, min(period, n // least) + 1):
        need = max(p * (least - 1), chars - p)
        run = 0
        # Whether the text's tail repeats with this period.
        while run < need and n - 1 - run - p >= 0 and t[n - 1 - run] == t[n - 1 - run - p]:
            run += 1
        if run >= need and run + p >= max(chars, p * least):
            return True
    return False


@F.pandas_udf(T.BooleanType())
def ends_in_loop(s: pd.Series) -> pd.Series:
    """Whether a text ends in a piece of up to 1024 characters repeated four times or more, 60 characters at least in all."""
    return _each(_loop)(s)


def _chunks(t: str, limit: int) -> list[str]:
    out, current = [], ""
    for p in (x.strip() for x in re.split(r"\n\s*\n", t)):
        if not p:
            continue
        if current and len(current) + 2 + len(p) <= limit:
            current += "\n\n" + p
            continue
        if current:
            out.append(current)
        while len(p) > limit:
            cut = max(p.rfind("\n", 0, limit), p.rfind(" ", 0, limit))
            cut = cut if cut > 0 else limit
            out.append(p[:cut].strip())
            p = p[cut:].strip()
        current = p
    if current:
        out.append(current)
    return [x for x in out if x]


def chunks(limit: int = 500):
    """Paragraphs joined up to a limit of characters; longer ones split at the last break or blank before it."""

    @F.pandas_udf(T.ArrayType(T.StringType()))
    def split(s: pd.Series) -> pd.Series:
        return s.map(lambda t: [] if t is None else _chunks(t, limit))

    return split


_KINDS = tuple((kind, re.compile(rx, re.IGNORECASE)) for kind, rx in REDACT.items())


def _redact(t: str) -> str:
    taken: list[tuple[int, int, str]] = []
    for kind, rx in _KINDS:
        free = [(m.start(), m.end(), kind) for m in rx.finditer(t)]
        taken += [x for x in free if all(x[1] <= a or x[0] >= b for a, b, _ in taken)]
    out, at = [], 0
    for a, b, kind in sorted(taken):
        out += [t[at:a], f"[REDACTED-{kind}]"]
        at = b
    return "".join([*out, t[at:]])


@F.pandas_udf(T.StringType())
def redacted(s: pd.Series) -> pd.Series:
    """Personal data replaced by its kind; where two kinds overlap the earlier kind has precedence."""
    return _each(_redact)(s)


def _table(t: str) -> list[list[str]]:
    lines = [x for x in t.split("\n") if x.strip()]
    if not lines:
        return []
    head = lines[0]
    if "|" in head:
        rows = [[c.strip() for c in x.strip().strip("|").split("|")] for x in lines]
        return [r for r in rows if not all(set(c) <= set("-: ") for c in r)]
    sep = r"\t" if "\t" in head else "," if "," in head else r"\s{2,}"
    return [[c.strip() for c in re.split(sep, x.strip())] for x in lines]


@F.pandas_udf(T.ArrayType(T.ArrayType(T.StringType())))
def table_rows(s: pd.Series) -> pd.Series:
    """Rows and cells of a table written with bars, tabs, commas or two blanks, told by its first line."""
    return s.map(lambda t: [] if t is None else _table(t))


def _repair(t: str) -> dict | None:
    """JSON of an object, mended step by step: doubled quotes before a value, commas before a closing sign, closing braces that lack, control signs."""
    steps = (
        lambda x: x, lambda x: re.sub(r'(:\s*)""(?=[^",}\]\s])', r'\1"', x), lambda x: re.sub(r",\s*([}\]])", r"\1", x), lambda x: x + "}" * max(0, x.count("{") - x.count("}")), lambda x: re.sub(r"[\x00-\x08\x0b\x0c\x0e-\x1f]", "", x),
        lambda x: re.sub(r"(?<![\\\w])'|'(?![\w])", '"', x),
    )
    for step in steps:
        t = step(t)
        try:
            v = json.loads(t, strict=False)
            return v if isinstance(v, dict) else None
        except ValueError:
            continue
    return None


_ARGUMENT = re.compile(r"""(\w+)\s*=\s*("(?:[^"\\]|\\.)*"|'(?:[^'\\]|\\.)*'|\[[^\]]*\]|\{[^}]*\}|[^,]+)""", re.S)


def _value(t: str):
    """A keyword's value: a quoted text, a number, a truth value or JSON; anything else as it stands."""
    t = t.strip()
    if t[:1] in "'\"" and len(t) > 1 and t[-1] == t[0]:
        return t[1:-1].replace("\\" + t[0], t[0])
    try:
        return json.loads({"True": "true", "False": "false", "None": "null"}.get(t, t))
    except ValueError:
        return t


def _said(name: str, arguments: object) -> str:
    return json.dumps({"name": name, "arguments": arguments}, ensure_ascii=False, sort_keys=True)


def _call(t: str) -> str | None:
    for m in (re.search(r"<\|tool_call_start\|>(.*?)(?:<\|tool_call_end\|>|$)", t, re.S), re.search(r"```(?:json)?\s*(\{.*?\})\s*```", t, re.S)):
        if m:
            t = m.group(1)
            break
    m = re.search(r"Tool:\s*([\w.]+)\s*\n\s*Arguments:\s*(\{.*)", t, re.S)
    if m:
        return _said(m.group(1), _repair(m.group(2).strip()) or {})
    m = re.search(r"\[?\s*([A-Za-z_][\w.]*)\((.*)\)\s*\]?\s*$", t.strip(), re.S)
    if m:
        return _said(m.group(1), {k: _value(v) for k, v in _ARGUMENT.findall(m.group(2))})
    if "{" in t:
        v = _repair(t[t.index("{") : t.rindex("}") + 1] if "}" in t else t[t.index("{") :])
        if v and isinstance(v.get("name"), str):
            return _said(v["name"], v.get("arguments", v.get("parameters", {})))
    for name in re.findall(r"`([a-z_]+\.[a-z_]+)`", t):
        if name.split(".")[1] not in NO_TOOLS:
            return _said(name, {})
    return None


@F.pandas_udf(T.StringType())
def tool_call(s: pd.Series) -> pd.Series:
    """The tool call of a reply (JSON, marked, fenced, named lines, bracketed or a dotted name between backticks) as JSON of name and arguments; null without one."""
    return _each(lambda t: _call(re.sub(r"(?s)<think>.*?</think>", "", t)))(s)


@F.pandas_udf(T.ArrayType(T.StructType([T.StructField(c, T.StringType()) for c in ("op", "a", "b")])))
def line_diff(a: pd.Series, b: pd.Series) -> pd.Series:
    """Opcodes that turn the lines of one text into those of another."""

    def diff(x: str, y: str) -> list[dict]:
        p, q = x.split("\n"), y.split("\n")
        return [{"op": op, "a": "\n".join(p[i1:i2]), "b": "\n".join(q[j1:j2])} for op, i1, i2, j1, j2 in difflib.SequenceMatcher(None, p, q).get_opcodes() if op != "equal"]

    return pd.Series([None if x is None or y is None else diff(x, y) for x, y in zip(a, b, strict=True)])

"""Workbooks (xlsx) and documents (docx): zipped XML, read without any further library."""

from __future__ import annotations

import io
import re
import zipfile
from collections.abc import Iterator
from xml.etree import ElementTree

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

_MAIN = "{http://schemas.openxmlformats.org/spreadsheetml/2006/main}"
_REL = "{http://schemas.openxmlformats.org/officeDocument/2006/relationships}id"
_W = "{http://schemas.openxmlformats.org/wordprocessingml/2006/main}"


def _column(ref: str) -> int:
    n = 0
    for ch in re.match("[A-Z]*", ref).group():
        n = n * 26 + ord(ch) - 64
    return n - 1


def sheet_rows(data: bytes, sheet: str | None = None) -> list[list[str | None]]:
    """Rows of a workbook's sheet (the first one unless it has one of that name), each cell as a text; rows and cells that the file leaves out are empty.
    Dates are the numbers they are stored as; formulas have their stored result."""
    with zipfile.ZipFile(io.BytesIO(data)) as z:
        read = lambda name: ElementTree.fromstring(z.read(name))
        sheets = [(s.get("name"), s.get(_REL)) for s in read("xl/workbook.xml").iter(f"{_MAIN}sheet")]
        if not sheets:
            return []
        target = dict(sheets).get(sheet, sheets[0][1])
        path = next(r.get("Target") for r in read("xl/_rels/workbook.xml.rels") if r.get("Id") == target)
        path = path.lstrip("/") if path.startswith("/") else "xl/" + path
        text = lambda e: "".join(t.text or "" for t in e.iter(f"{_MAIN}t"))
        shared = [text(e) for e in read("xl/sharedStrings.xml").iter(f"{_MAIN}si")] if "xl/sharedStrings.xml" in z.namelist() else []
        rows: list[list[str | None]] = []
        for row in read(path).iter(f"{_MAIN}row"):
            while len(rows) + 1 < int(row.get("r") or 0):
                rows.append([])
            cells: list[str | None] = []
            for c in row.iter(f"{_MAIN}c"):
                at = _column(c.get("r") or "")
                cells += [None] * (max(at, len(cells)) - len(cells))
                kind, v = c.get("t"), c.findtext(f"{_MAIN}v")
                cells.append(shared[int(v)] if kind == "s" and v else text(c) if kind == "inlineStr" else {"1": "true", "0": "false"}.get(v, v) if kind == "b" else v)
            rows.append(cells)
    width = max(map(len, rows), default=0)
    return [r + [None] * (width - len(r)) for r in rows]


def _header(rows: list[list[str | None]]) -> list[str]:
    return [f"col_{i}" if h is None else h for i, h in enumerate(rows[0])] if rows else []


def read_xlsx(spark: SparkSession, path: str, sheet: str | None = None) -> DataFrame:
    """Rows of workbooks, all columns texts. Each workbook's first row names its columns, ``col_0`` and so on where it doesn't; the columns of
    the result are those of the first workbook by path (of which the driver reads the names). No workbook, or an empty one first: no columns' worth of rows."""
    files = spark.read.format("binaryFile").load(path).select("path", "content")

    def names(it: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for x in it:
            yield pd.DataFrame({"names": [_header(sheet_rows(bytes(c), sheet)) for c in x["content"]]})

    first = files.orderBy("path").limit(1).mapInPandas(names, "names array<string>").first()
    columns = list(dict.fromkeys(first.names)) if first else []
    schema = T.StructType([T.StructField(c, T.StringType()) for c in columns] or [T.StructField("col_0", T.StringType())])

    def rows(it: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for x in it:
            for c in x["content"]:
                r = sheet_rows(bytes(c), sheet)
                head = _header(r)
                yield pd.DataFrame({n: [row[head.index(n)] if n in head else None for row in r[1:]] for n in schema.names}, columns=schema.names, dtype=object)

    return files.mapInPandas(rows, schema)


def document_text(data: bytes) -> str:
    """The paragraphs of a docx document's body, a line each; tables are left out."""
    with zipfile.ZipFile(io.BytesIO(data)) as z:
        body = ElementTree.fromstring(z.read("word/document.xml")).find(f"{_W}body")
    signs = {f"{_W}tab": "\t", f"{_W}br": "\n", f"{_W}cr": "\n"}
    say = lambda p: "".join(e.text or "" if e.tag == f"{_W}t" else signs.get(e.tag, "") for e in p.iter())
    return "\n".join(say(p) for p in (body.findall(f"{_W}p") if body is not None else []))


def text_or_none(content: bytes | None) -> str | None:
    """The text of a docx file; none where the file is none."""
    try:
        return None if content is None else document_text(bytes(content))
    except (zipfile.BadZipFile, KeyError, ElementTree.ParseError):
        return None


@F.pandas_udf(T.StringType())
def docx_text(content: pd.Series) -> pd.Series:
    """The text of docx files; null where a file is none."""
    return content.map(text_or_none)

"""Sources, sinks and streams."""

from __future__ import annotations

import os

import pytest
from pyspark.sql import functions as F

from corpusloom.sources import io
from corpusloom.streaming import streams as T
from tests.conftest import rows


def write(path, text):
    path.write_bytes(text if isinstance(text, bytes) else text.encode())
    return str(path)


def test_json_lines(spark, tmp_path):
    p = write(tmp_path / "a.jsonl", '{"text":"अ","src":"s"}\nnot json\n\n{"text":"b","key":"k","extra":1}\n')
    assert rows(io.read_jsonl(spark, p, io.RAW, strict=False)) == [("b", None, "k"), ("अ", "s", None)]
    with pytest.raises(Exception):
        io.read_jsonl(spark, p, io.RAW).collect()
    out = str(tmp_path / "out")
    io.write_jsonl(io.read_jsonl(spark, p, io.RAW, strict=False), out)
    assert rows(io.read_jsonl(spark, out, io.RAW)) == [("b", None, "k"), ("अ", "s", None)]


def test_globs_lines_and_files(spark, tmp_path):
    for n in ("a.jsonl", "b.jsonl", "train_v1.jsonl"):
        write(tmp_path / n, f'{{"text":"{n}"}}\n')
    assert rows(io.read_glob(spark, str(tmp_path / "*.jsonl"), io.RAW, ["train_v1"]), "text", "file") == [("a.jsonl", "a.jsonl"), ("b.jsonl", "b.jsonl")]
    bad = write(tmp_path / "x.txt", b"ok\n\xff\xfe\nlast")
    assert [r.value for r in io.read_lines(spark, bad).collect()] == ["ok", "��", "last"]
    (tmp_path / "skip").mkdir()
    write(tmp_path / "skip" / "y.txt", "y")
    names = {os.path.basename(r.path) for r in io.list_files(spark, str(tmp_path), ["skip"], ["jsonl"]).collect()}
    assert names == {"x.txt"}


def test_csv(spark, tmp_path):
    p = write(tmp_path / "p.csv", "q,a,z\n hello , there,1\n,empty,2\nx,,3\n")
    assert rows(io.read_pairs_csv(spark, p, "q", "a")) == [("hello", "there")]
    df = spark.createDataFrame([('a "q"', "x,y", None), ("l", "", "z")], "a string, b string, c string")
    io.write_csv(df, str(tmp_path / "c"))
    assert rows(spark.read.csv(str(tmp_path / "c"), header=True, escape='"')) == [('a "q"', "x,y", None), ("l", None, "z")]
    assert io.read_delimited(spark, write(tmp_path / "t.tsv", "a\t\tb\n1\t2\t3\n"), "\t").columns == ["a", "col_1", "b"]


def test_tables(spark, tmp_path):
    df = spark.createDataFrame([(1, True)], "`a b` int, ok boolean")
    io.write_table(df, str(tmp_path / "t"))
    got = spark.read.parquet(str(tmp_path / "t"))
    assert got.columns == ["a_b", "ok"] and rows(got) == [(1, 1)]
    assert io.read_columns(spark, str(tmp_path / "t"), ["missing"]) is None
    with pytest.raises(ValueError):
        io.require_splits({"train": df}, ["train", "test"], ["ok"])
    with pytest.raises(ValueError):
        io.require_splits({"train": df}, ["train"], ["zzz"])


def test_read_only_sql(spark):
    spark.createDataFrame([(1, "Widget", 9.99), (2, "Gadget", 24.99), (3, "Doohickey", 4.50)], "id int, name string, price double").createOrReplaceTempView("products")
    assert rows(io.read_only_sql(spark, "SELECT name FROM products WHERE price > 10")) == [("Gadget",)]
    assert io.read_only_sql(spark, "WITH c AS (SELECT * FROM products WHERE price < 10) SELECT * FROM c").count() == 2
    for bad in ("INSERT INTO products VALUES (4, 'x', 1)", "SELECT 1; DROP TABLE products", "DELETE FROM products"):
        with pytest.raises(ValueError):
            io.check_read_only(bad)
    io.check_read_only("SELECT updated_at FROM t WHERE x = 'drop table'")
    with pytest.raises(ValueError):
        io.check_read_only("SELECT updated_at FROM t", strict=True)


def test_upsert(spark):
    cur = spark.createDataFrame([(1, "a", 1), (2, "b", 1)], "k int, v string, t int")
    new = spark.createDataFrame([(1, "A", 2, False), (2, "b", 2, True), (3, "c", 1, None)], "k int, v string, t int, deleted boolean")
    assert rows(io.upsert(cur, new, "k", "t"), "k", "v") == [(1, "A"), (3, "c")]


def test_streams_write_each_row_once(spark, tmp_path):
    src, out, ck = tmp_path / "in", str(tmp_path / "out"), str(tmp_path / "ck")
    src.mkdir()
    write(src / "1.json", '{"text":"a","key":"1"}\n{"text":"a2","key":"1"}\n')
    run = lambda: T.append_new(T.watch(spark, str(src), io.RAW), out, ck, "key").awaitTermination()
    run()
    write(src / "2.json", '{"text":"again","key":"1"}\n{"text":"b","key":"2"}\n')
    run()
    run()
    assert rows(spark.read.parquet(out), "key") == [("1",), ("2",)]
    T.append(T.watch(spark, str(src), io.RAW, glob="*.json"), str(tmp_path / "all"), str(tmp_path / "ck2")).awaitTermination()
    assert spark.read.parquet(str(tmp_path / "all")).count() == 4


def test_stream_windows(spark, tmp_path):
    src = tmp_path / "ev"
    spark.createDataFrame([(1, "2026-01-01 00:10:00", "a", 1.0), (2, "2026-01-01 00:50:00", "a", 2.0), (3, "2026-01-01 02:10:00", "a", 4.0), (3, "2026-01-01 02:10:00", "a", 4.0)], "id int, ts string, k string, value double").select("id", F.expr("cast(ts as timestamp_ntz) ts"), "k", "value").write.parquet(str(src))
    schema = spark.read.parquet(str(src)).schema

    def collect(df, name, mode):
        q = df.writeStream.format("memory").queryName(name).outputMode(mode).trigger(availableNow=True).start()
        q.awaitTermination()
        return spark.table(name)

    stream = lambda: spark.readStream.schema(schema).parquet(str(src))
    assert rows(collect(T.tumbling(stream(), "ts", "k"), "w1", "complete"), "n", "total") == [(2, 3.0), (2, 8.0)]
    assert collect(T.distinct_within(stream(), "id", "ts", "4 hours"), "w2", "append").count() == 3
    T.write_running_stats(stream(), "k", "value", str(tmp_path / "stats"), str(tmp_path / "ck3")).awaitTermination()
    assert rows(spark.read.parquet(str(tmp_path / "stats")), "k", "n", "mean", "p95") == [("a", 4, 2.75, 4.0)]
    assert rows(T.running_stats(spark.createDataFrame([("a", v) for v in range(1, 41)] + [("b", None), ("c", 7)], "k string, v int"), "k", "v")) == [("a", 40, 20, 39), ("c", 1, 7, 7)]
    assert rows(T.sessions(spark.read.parquet(str(src)), "ts", "k"), "n") == [(1,), (1,), (2,)]


W = 'xmlns:w="http://schemas.openxmlformats.org/wordprocessingml/2006/main"'
M = 'xmlns="http://schemas.openxmlformats.org/spreadsheetml/2006/main" xmlns:r="http://schemas.openxmlformats.org/officeDocument/2006/relationships"'


def packed(files: dict[str, str]) -> bytes:
    import io as bytes_io
    import zipfile

    out = bytes_io.BytesIO()
    with zipfile.ZipFile(out, "w") as z:
        for name, text in files.items():
            z.writestr(name, text)
    return out.getvalue()


def workbook(second: str, strings: str = "") -> bytes:
    return packed({
        "xl/workbook.xml": f'<workbook {M}><sheets><sheet name="one" r:id="a"/><sheet name="two" r:id="b"/></sheets></workbook>', "xl/sharedStrings.xml": f"<sst {M}>{strings}</sst>", "xl/worksheets/s1.xml": f"<worksheet {M}><sheetData>{second}</sheetData></worksheet>",
        "xl/_rels/workbook.xml.rels": '<Relationships><Relationship Id="a" Target="worksheets/s1.xml"/><Relationship Id="b" Target="/xl/s2.xml"/></Relationships>', "xl/s2.xml": f'<worksheet {M}><sheetData><row r="1"><c r="A1" t="str"><v>z</v></c></row></sheetData></worksheet>',
    })


def test_workbooks(spark, tmp_path):
    from corpusloom.sources.office import read_xlsx, sheet_rows

    head = '<row r="1"><c r="A1" t="s"><v>0</v></c><c r="C1" t="inlineStr"><is><t>size</t></is></c></row>'
    one = workbook(head + '<row r="2"><c r="A2" t="s"><v>1</v></c><c r="B2"><v>2.5</v></c><c r="C2" t="b"><v>1</v></c></row><row r="4"><c r="C4"><v>7</v></c></row>', "<si><t>name</t></si><si><r><t>हिं</t></r><r><t>दी</t></r></si>")
    two = workbook('<row r="1"><c r="A1" t="str"><v>size</v></c><c r="B1" t="str"><v>other</v></c></row><row r="2"><c r="A2"><v>9</v></c></row>')
    assert sheet_rows(one) == [["name", None, "size"], ["हिंदी", "2.5", "true"], [None] * 3, [None, None, "7"]] and sheet_rows(one, "two") == [["z"]] and sheet_rows(one, "lost") == sheet_rows(one)
    (tmp_path / "w").mkdir()
    write(tmp_path / "w" / "a.xlsx", one)
    write(tmp_path / "w" / "b.xlsx", two)
    df = read_xlsx(spark, str(tmp_path / "w"))
    assert df.columns == ["name", "col_1", "size"]
    assert rows(df) == sorted([("हिंदी", "2.5", "true"), (None, None, None), (None, None, "7"), (None, None, "9")], key=str)
    write(tmp_path / "w" / "0.xlsx", workbook(""))
    assert read_xlsx(spark, str(tmp_path / "w" / "0.xlsx")).count() == 0


def test_documents_and_depth(spark, tmp_path):
    (tmp_path / "a" / "b").mkdir(parents=True)
    write(tmp_path / "a" / "x.txt", b"line\n\xff two")
    write(tmp_path / "a" / "b" / "y.HTML", "<p>one</p><script>no</script> &lt;")
    write(tmp_path / "a" / "z.pdf", "%PDF")
    write(tmp_path / "a" / "q.docx", packed({"word/document.xml": f'<w:document {W}><w:body><w:p><w:r><w:t>first</w:t><w:tab/><w:t>line</w:t></w:r></w:p><w:tbl><w:p><w:t>no</w:t></w:p></w:tbl><w:p/><w:p><w:r><w:t>दो</w:t></w:r></w:p></w:body></w:document>'}))
    write(tmp_path / "a" / "bad.docx", "no zip")
    assert rows(io.read_documents(spark, str(tmp_path / "a")), "kind", "text") == [("docx", "first\tline\n\nदो"), ("docx", None), ("html", "one &lt;"), ("text", "line\n\ufffd two")]
    for n in ("q.docx", "bad.docx"):
        (tmp_path / "a" / n).unlink()
    names = lambda d: sorted(os.path.basename(r.path) for r in io.list_files(spark, str(tmp_path / "a"), most_depth=d).collect())
    assert names(1) == ["x.txt", "z.pdf"] and names(2) == ["x.txt", "y.HTML", "z.pdf"] == names(None)


def test_documents_are_listed_in_tasks(spark, tmp_path):
    import gzip

    a = tmp_path / "a b"
    (a / "deep" / "er").mkdir(parents=True)
    (a / "_skipped").mkdir()
    for n in range(40):
        write(a / "deep" / f"{n}.txt", f"text {n}")
    write(a / "deep" / "er" / "p.htm", "<p>one</p>two")
    for n in ("_skipped/x.txt", ".x.txt", "_x.txt", "x.PDF"):
        write(a / n, "no")
    write(a / "packed.txt.gz", gzip.compress("पाठ".encode()))
    some = [("html", "one two"), *(("text", f"text {n}") for n in range(40)), ("text", "पाठ")]
    df = io.read_documents(spark, str(a))
    assert df.inputFiles() == [] and rows(df, "kind", "text") == sorted(some, key=str)
    assert rows(io.read_documents(spark, f"{tmp_path}/*"), "kind", "text") == rows(io.read_documents(spark, f"file://{a}"), "kind", "text") == sorted(some, key=str)
    (a / "deep" / "empty.txt").write_bytes(b"")
    assert rows(io.read_documents(spark, str(a)), "kind", "text") == sorted([*some, ("text", "")], key=str)
    assert {r.path for r in df.collect()} <= {r.path for r in io.list_files(spark, str(a)).collect()} | {f"file:{a}/deep/empty.txt"}


def test_documents_are_held_up_to_some_bytes(tmp_path):
    import pyarrow as pa

    files = [write(tmp_path / f"{n}.txt", "x" * 10).encode() for n in range(7)]
    given = [pa.RecordBatch.from_pydict({"file": pa.array(f, pa.binary())}) for f in (files[:5], files[5:])]
    assert [b.num_rows for b in io._texts(given, 30)] == [3, 3, 1] and [b.num_rows for b in io._texts(given)] == [7]
    (tmp_path / "a.zst").write_bytes(b"")
    with pytest.raises(ValueError):
        list(io._texts([pa.RecordBatch.from_pydict({"file": [os.fsencode(tmp_path / "a.zst")]})]))


def test_clusters_must_name_a_checkpoint_folder():
    from types import SimpleNamespace

    from corpusloom.sources.checkpoint import scratch

    for master in ("yarn", "spark://h:1", "local-cluster[2,1,1024]"):
        bare = SimpleNamespace(sparkContext=SimpleNamespace(master=master, getCheckpointDir=lambda: None), conf=SimpleNamespace(get=lambda *_: None))
        with pytest.raises(ValueError):
            scratch(bare, "x")

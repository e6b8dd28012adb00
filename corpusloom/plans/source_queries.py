"""Queries of sources, sinks and streams: tables go out in a form and come back from it. Files lie in the folder of checkpoints."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from corpusloom.functions import text as X
from corpusloom.functions import udfs as U
from corpusloom.operators import extract as E
from corpusloom.operators import gates as G
from corpusloom.plans.registry import Tables, query
from corpusloom.sources import io
from corpusloom.sources.checkpoint import scratch
from corpusloom.streaming import streams

c = F.col
_PAIR = T.StructType([T.StructField("row_id", T.LongType()), *(T.StructField(n, T.StringType()) for n in ("instruction", "response", "src"))])


def _pairs(t: Tables) -> DataFrame:
    return t.train_smoke.select("row_id", "instruction", "response", "src")


def _moved(t: Tables, files: str, to: str, name: str) -> None:
    """Moves the files that were written to ``files`` into the folder ``to``, under names that begin so."""
    jvm, conf = t.spark.sparkContext._jvm, t.spark.sparkContext._jsc.hadoopConfiguration()
    path = jvm.org.apache.hadoop.fs.Path
    fs = path(files).getFileSystem(conf)
    fs.mkdirs(path(to))
    for i, f in enumerate(sorted(s.getPath().toString() for s in fs.listStatus(path(files)) if s.getPath().getName().startswith("part-"))):
        fs.rename(path(f), path(f"{to}/{name}-{i:05}.jsonl"))


@query("s01_jsonl_strict", "SELECT row_id, instruction, response, src FROM train_smoke")
def _(t):
    out = scratch(t.spark, "s01")
    io.write_jsonl(_pairs(t), out)
    return io.read_jsonl(t.spark, out, _PAIR)


@query("s02_jsonl_lenient", "SELECT row_id, instruction, response, src FROM train_smoke")
def _(t):
    """Beside each good line a cut one and one that is no JSON at all."""
    out = scratch(t.spark, "s02")
    line = F.to_json(F.struct("row_id", "instruction", "response", "src"))
    _pairs(t).select(F.explode(F.array(line, F.left(line, F.length(line) - 3), F.lit("no json"))).alias("value")).write.text(out)
    return io.read_jsonl(t.spark, out, _PAIR, strict=False)


@query("s03_glob", "SELECT pool_id AS row_id, instruction, 'pool' AS file FROM pool_todo")
def _(t):
    """Of a folder with two kinds of files, those whose names don't begin with the excluded word."""
    a, b, out = (scratch(t.spark, f"s03{x}") for x in "abc")
    io.write_jsonl(t.pool_todo.select(c("pool_id").alias("row_id"), "instruction"), a)
    io.write_jsonl(t.train_smoke.select("row_id", "instruction"), b)
    _moved(t, a, out, "pool")
    _moved(t, b, out, "train_v1")
    got = io.read_glob(t.spark, f"{out}/*.jsonl", _PAIR, ["train_v1"])
    return got.select("row_id", "instruction", F.substring_index("file", "-", 1).alias("file"))


@query("s04_lines", "SELECT p_name || ' ' || p_partkey AS value FROM part")
def _(t):
    out = scratch(t.spark, "s04")
    t.part.select(F.concat_ws(" ", "p_name", c("p_partkey").cast("string")).alias("value")).write.text(out)
    return io.read_lines(t.spark, out)


@query("s05_pairs_csv", "SELECT trim(p_name) instruction, trim(p_brand) response FROM part WHERE p_size <> 7")
def _(t):
    """A file with blanks about the values, and rows with an empty side."""
    out = scratch(t.spark, "s05")
    io.write_csv(t.part.select(F.concat(F.lit("  "), "p_name", F.lit(" ")).alias("q"), F.when(c("p_size") == 7, " ").otherwise(F.concat(F.lit(" "), "p_brand")).alias("a"), "p_type"), out)
    return io.read_pairs_csv(t.spark, out, "q", "a")


@query("s06_records_csv", "SELECT o_orderkey, o_orderpriority, o_totalprice FROM orders")
def _(t):
    out = scratch(t.spark, "s06")
    io.write_csv(t.orders.select("o_orderpriority", "o_orderkey", "o_totalprice"), out)
    return io.read_delimited(t.spark, out).select(c("o_orderkey").cast("long"), "o_orderpriority", c("o_totalprice").cast("double"))


@query("s08_pruned", "SELECT l_orderkey, l_quantity FROM lineitem")
def _(t):
    return io.read_columns(t.spark, f"{t.folder}/lineitem.parquet", ["l_orderkey", "l_quantity"])


@query("s09_sheet", "SELECT s_suppkey::varchar col_0, s_name AS name, s_nationkey::varchar col_2 FROM supplier")
def _(t):
    """A sheet cut by tabs whose first and last columns have no name."""
    out = scratch(t.spark, "s09")
    rows = t.supplier.select(F.concat_ws("\t", c("s_suppkey").cast("string"), "s_name", c("s_nationkey").cast("string")).alias("value"))
    # A sheet is one file, its header first.
    t.spark.range(1).select(F.lit("\tname\t").alias("value")).union(rows).coalesce(1).write.text(out)
    return io.read_delimited(t.spark, out, "\t")


@query("s11_table", "SELECT event_id AS event_id, event_type AS event_type, (value > 50)::int AS is_high_ FROM events")
def _(t):
    out = scratch(t.spark, "s11")
    io.write_table(t.events.select("event_id", c("event_type").alias("event type"), (c("value") > 50).alias("is.high?")), out)
    return t.spark.read.parquet(out)


@query("s12_csv", """SELECT row_id, nullif(regexp_replace(instruction, '[\r\n]', ' ', 'g'), '') instruction, nullif(src, '') src FROM train_smoke""")
def _(t):
    """Quotes, commas and nulls; an empty text comes back as null, as both are written alike."""
    out = scratch(t.spark, "s12")
    io.write_csv(t.train_smoke.select("row_id", F.regexp_replace("instruction", "[\r\n]", " ").alias("instruction"), "src"), out)
    return t.spark.read.schema("row_id long, instruction string, src string").csv(out, header=True, escape='"', ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False)


@query("s13_jsonl", "SELECT key, instruction, category FROM pool_todo")
def _(t):
    out = scratch(t.spark, "s13")
    io.write_jsonl(t.pool_todo.select("key", "instruction", "category"), out)
    return t.spark.read.schema("key string, instruction string, category string").json(out)


@query("s14_appended", "SELECT n_nationkey, n_name, NULL::varchar AS note FROM nation UNION ALL SELECT r_regionkey, r_name, 'region' FROM region")
def _(t):
    """Two writes into one table, of which the first lacks a column."""
    out = scratch(t.spark, "s14")
    io.write_csv(t.nation.select("n_nationkey", "n_name", F.lit(None).cast("string").alias("note")), out)
    io.write_csv(t.region.select(c("r_regionkey").alias("n_nationkey"), c("r_name").alias("n_name"), F.lit("region").alias("note")), out, "append")
    return t.spark.read.schema("n_nationkey int, n_name string, note string").csv(out, header=True)


@query("s16_html_text", "SELECT p_partkey, p_name || ' &amp; ' || p_brand AS plain FROM part")
def _(t):
    page = F.concat(F.lit("<html><head><style>b { c }</style><SCRIPT src='x'>var a = '<p>';\n</script></head><body><h1>"), "p_name", F.lit("</h1>\n <p class=\"q\">&amp;\t"), "p_brand", F.lit("</p></body></html>"))
    return t.part.select("p_partkey", E.html_text(page).alias("plain"))


@query("s17_documents", "SELECT 'text' AS kind, p_name || chr(10) || p_brand AS text FROM part WHERE p_size < 25 UNION ALL SELECT 'html', p_type || ' ' || p_name FROM part WHERE p_size >= 25")
def _(t):
    """Files of text and of pages, told by their names, each one document. A folder has a thousand of them and one task that writes it."""
    out = scratch(t.spark, "s17")
    page, folder = c("p_size") >= 25, F.floor(c("p_partkey") / 1000).cast("string")
    name = F.concat(folder, F.lit("/"), c("p_partkey").cast("string"), F.when(page, ".html").otherwise(".txt"))
    text = F.when(page, F.concat(F.lit("<p>"), "p_type", F.lit("</p><b>"), "p_name", F.lit("</b>"))).otherwise(F.concat_ws("\n", "p_name", "p_brand"))
    io.write_files(t.part.where("p_size IS NOT NULL").repartition(t.spark.sparkContext.defaultParallelism, folder).select(name.alias("name"), text.alias("text")), out)
    return io.read_documents(t.spark, out).select("kind", "text")


@query("s18_files", "SELECT n_nationkey || '.txt' AS name, length(n_name) AS length FROM nation")
def _(t):
    """Of files in several folders, those that aren't in a skipped one and have no skipped extension."""
    out = scratch(t.spark, "s18")
    k = c("n_nationkey").cast("string")
    for folder, ext in (("keep/deep", ".txt"), ("keep", ".png"), ("node_modules", ".txt")):
        io.write_files(t.nation.select(F.concat(F.lit(folder + "/"), k, F.lit(ext)).alias("name"), c("n_name").alias("text")), out)
    got = io.list_files(t.spark, out, ["node_modules"], ["png"])
    return got.select(F.substring_index("path", "/", -1).alias("name"), c("length").cast("long").alias("length"))


@query("s21_splits", "SELECT doc_id, CASE WHEN doc_id % 10 = 0 THEN 'test' WHEN doc_id % 10 = 1 THEN 'validation' ELSE 'train' END split FROM documents")
def _(t):
    d = t.documents.select("doc_id", "text")
    parts = io.require_splits({"train": d.where("doc_id % 10 > 1"), "validation": d.where("doc_id % 10 = 1"), "test": d.where("doc_id % 10 = 0")}, ["train", "validation", "test"], ["doc_id", "text"])
    return parts["train"].select("doc_id", F.lit("train").alias("split")).unionByName(parts["validation"].select("doc_id", F.lit("validation").alias("split"))).unionByName(parts["test"].select("doc_id", F.lit("test").alias("split")))


@query("s22_report_rows", "SELECT p_partkey, unnest(['task a', 'task b']) AS task, unnest([p_size::varchar, p_brand]) AS result FROM part")
def _(t):
    report = F.concat(F.lit("# Run\n\n## Tasks\n```\ntask a   "), c("p_size").cast("string"), F.lit("\n\n  task b    "), "p_brand", F.lit("\n```\n## Breakdown\nx   y\n"))
    return t.part.select("p_partkey", F.explode(E.report_rows(report)).alias("r")).select("p_partkey", c("r")[0].alias("task"), c("r")[1].alias("result"))


@query("f19_tokens")
def _(t):
    return t.documents.select("doc_id", U.tokenizer_counts("/opt/tokenizers/byte_bpe_50k.json")("text").alias("tokens"))


@query("f31_corner_boxes", "SELECT p_partkey, least(1.0::double, p_size / 100) x1, 0.25::double y1, least(1.0::double, p_size / 100 + 0.6::double) x2, 1.0::double y2 FROM part")
def _(t):
    x = c("p_size") / 100
    corners = F.array(x, F.lit(0.5), x + 0.6, F.lit(0.25), x + 0.2, F.lit(1.5), x + 0.1, F.lit(0.75))
    return t.part.select("p_partkey", X.corner_box(corners).alias("b")).select("p_partkey", *(c("b")[i].alias(n) for i, n in enumerate(("x1", "y1", "x2", "y2"))))


@query("gate27_auto_rules", """SELECT event_id, 'z_score' AS rule, 'value' AS field, 'outlier' detail FROM events WHERE abs((value - (SELECT avg(value) FROM events)) / (SELECT stddev_pop(value) FROM events)) > 2
 UNION ALL SELECT event_id, 'missing', 'value', 'missing' FROM events WHERE value IS NULL""")
def _(t):
    d = t.events.select("event_id", "value")
    rules = [r for r in G.auto_rules(d) if r["field"] == "value"]
    return G.anomalies(d, "event_id", rules).drop("value")


# ---- streams: each runs until it has read all there is, and is started again where that must change nothing


def _events(t: Tables) -> DataFrame:
    """Events as JSON files, and the folder they lie in."""
    out = scratch(t.spark, "events")
    io.write_jsonl(t.events.select("event_id", "user_id", "event_type", "value"), out)
    return streams.watch(t.spark, out, T.StructType([T.StructField("event_id", T.LongType()), T.StructField("user_id", T.LongType()), T.StructField("event_type", T.StringType()), T.StructField("value", T.DoubleType())]), glob="*.json")


def _read(t: Tables, out: str, schema: str) -> DataFrame:
    return t.spark.read.schema(schema).parquet(out)


def _twice(t: Tables, start) -> str:
    out, checkpoint = scratch(t.spark, "out"), scratch(t.spark, "offsets")
    t.spark.createDataFrame([], start[1]).write.mode("append").parquet(out)  # a stream without rows writes nothing
    for _ in range(2):
        start[0](out, checkpoint).awaitTermination()
    return out


@query("t01_resumed_append", "SELECT event_id, value FROM events")
def _(t):
    s = _events(t).select("event_id", "value")
    out = _twice(t, (lambda o, k: streams.append(s, o, k), s.schema))
    return t.spark.read.schema(s.schema).parquet(out)


@query("t02_by_key", "SELECT DISTINCT user_id FROM events")
def _(t):
    s = _events(t).select("user_id")
    return _read(t, _twice(t, (lambda o, k: streams.append_new(s, o, k, "user_id"), s.schema)), "user_id long")


@query("t03_rest_of_pool", "SELECT DISTINCT pool_id FROM pool_todo")
def _(t):
    """What another run has done is left out: the output begins with the teacher's prompts, of which none is made again."""
    src, out, checkpoint = (scratch(t.spark, x) for x in ("pool", "out", "offsets"))
    io.write_jsonl(t.pool_todo.select("pool_id"), src)
    schema = T.StructType([T.StructField("pool_id", T.LongType())])
    t.pool_todo.where("key is null or category is not null").select("pool_id").write.parquet(out)
    streams.append_new(streams.watch(t.spark, src, schema), out, checkpoint, "pool_id").awaitTermination()
    return t.spark.read.schema(schema).parquet(out)


@query("t04_watched_once", "SELECT event_type, count(*) n FROM events GROUP BY 1")
def _(t):
    s = _events(t).select("event_id", "event_type")
    out = _twice(t, (lambda o, k: streams.append(s, o, k), s.schema))
    return t.spark.read.schema(s.schema).parquet(out).groupBy("event_type").agg(F.count("*").alias("n"))


@query("t05_watched_glob", "SELECT n_nationkey FROM nation")
def _(t):
    """Files of another name aren't read."""
    src = scratch(t.spark, "watched")
    k = c("n_nationkey").cast("string")
    io.write_files(t.nation.select(F.concat(k, F.lit(".json")).alias("name"), F.concat(F.lit('{"n_nationkey": '), k, F.lit("}")).alias("text")), src)
    io.write_files(t.nation.select(F.concat(k, F.lit(".part")).alias("name"), F.lit('{"n_nationkey": -1}').alias("text")), src)
    s = streams.watch(t.spark, src, T.StructType([T.StructField("n_nationkey", T.IntegerType())]), glob="*.json")
    return _read(t, _twice(t, (lambda o, k: streams.append(s, o, k), s.schema)), "n_nationkey int")


@query("t06_predictions", "SELECT event_id, CASE WHEN value > 50 THEN 'high' ELSE 'low' END risk FROM events")
def _(t):
    s = _events(t).select("event_id", "value")
    make = lambda d: d.select("event_id", F.when(c("value") > 50, "high").otherwise("low").alias("risk"))
    out = _twice(t, (lambda o, k: streams.append_new(s, o, k, "event_id", make), "event_id long, risk string"))
    return _read(t, out, "event_id long, risk string")


@query("t08_in_intervals", "SELECT user_id, count(*) n FROM events GROUP BY user_id")
def _(t):
    s = _events(t).select("event_id", "user_id")
    out, checkpoint = scratch(t.spark, "out"), scratch(t.spark, "offsets")
    t.spark.createDataFrame([], s.schema).write.mode("append").parquet(out)
    q = streams.append(s, out, checkpoint, once=False, every="1 second")
    q.processAllAvailable()
    q.stop()
    return t.spark.read.schema(s.schema).parquet(out).groupBy("user_id").agg(F.count("*").alias("n"))


@query("t10_running_stats", """SELECT event_type, count(*) n, round(avg(value), 6) AS mean, list_sort(list(value))[least(count(*), floor(count(*) * 0.95)::bigint + 1)] p95 FROM events WHERE value IS NOT NULL GROUP BY event_type""")
def _(t):
    out = scratch(t.spark, "stats")
    streams.stats_of_counts(t.spark.createDataFrame([], "event_type string, value double, n long"), "event_type").write.mode("append").parquet(out)
    streams.write_running_stats(_events(t), "event_type", "value", out, scratch(t.spark, "offsets")).awaitTermination()
    return t.spark.read.parquet(out).select("event_type", "n", F.round("mean", 6).alias("mean"), "p95")

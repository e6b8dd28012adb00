"""Sources and sinks."""

from __future__ import annotations

import bz2
import gzip
import os
import re
import zlib
from collections.abc import Iterable, Iterator, Sequence
from itertools import islice

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

_MESSAGE = T.StructType([T.StructField("role", T.StringType()), T.StructField("content", T.StringType())])
#: Explicit schemas: nothing is inferred from the first row.
RAW = T.StructType([T.StructField(c, T.StringType()) for c in ("text", "src", "key")])
PAIR = T.StructType([T.StructField(c, T.StringType()) for c in ("instruction", "response", "src")])
PROMPT = T.StructType([T.StructField(c, T.StringType()) for c in ("key", "instruction", "plang", "src", "category")])
CONVERSATION = T.StructType([T.StructField("key", T.StringType()), T.StructField("messages", T.ArrayType(_MESSAGE)), T.StructField("src", T.StringType())])


def read_jsonl(spark: SparkSession, paths: str | Sequence[str], schema: T.StructType, strict: bool = True) -> DataFrame:
    """JSON lines; a bad line raises an error, or is skipped if not ``strict``."""
    if strict:
        return spark.read.schema(schema).option("mode", "FAILFAST").json(paths)
    bad = "_corrupt_record"
    return spark.read.schema(T.StructType([*schema.fields, T.StructField(bad, T.StringType())])).option("mode", "PERMISSIVE").json(paths).where(F.col(bad).isNull()).drop(bad)


def read_glob(spark: SparkSession, pattern: str, schema: T.StructType, skip_prefixes: Sequence[str] = ()) -> DataFrame:
    """S3: files of a pattern but those whose names begin so; ``file`` is the file's name, by which keep-first orders."""
    df = spark.read.schema(schema).json(pattern).select("*", F.col("_metadata.file_name").alias("file"))
    for p in skip_prefixes:
        df = df.where(~F.col("file").startswith(p))
    return df


def read_lines(spark: SparkSession, path: str) -> DataFrame:
    """Lines of text; bytes that aren't UTF-8 become U+FFFD."""
    return spark.read.text(path)


def read_pairs_csv(spark: SparkSession, path: str, left: str, right: str) -> DataFrame:
    """Two columns of a CSV with a header, one line a record, trimmed; rows with either side empty are dropped."""
    df = spark.read.csv(path, header=True, multiLine=False)
    return df.select(F.trim(left).alias("instruction"), F.trim(right).alias("response")).where("instruction != '' and response != ''")


def read_delimited(spark: SparkSession, path: str, sep: str = ",") -> DataFrame:
    """A sheet with a header; columns without a name are col_0, col_1 and so on."""
    df = spark.read.csv(path, header=True, sep=sep)
    return df.toDF(*(f"col_{i}" if not c or c.startswith("_c") else c for i, c in enumerate(df.columns)))


def read_columns(spark: SparkSession, path: str, columns: Sequence[str]) -> DataFrame | None:
    """The columns asked for, none if one is missing; others are never read."""
    df = spark.read.parquet(path)
    return df.select(*columns) if set(columns) <= set(df.columns) else None


_FORBIDDEN = "INSERT UPDATE DELETE DROP ALTER CREATE REPLACE ATTACH DETACH PRAGMA".split()


def check_read_only(sql: str, strict: bool = False) -> None:
    """Raises unless a statement begins with SELECT or WITH and has no writing keyword outside quotes. ``strict`` takes
    keywords inside other words too (so a column updated_at is rejected)."""
    bare = re.sub(r"'(?:[^']|'')*'", "''", sql).upper()
    if not re.match(r"\s*(SELECT|WITH)\b", bare):
        raise ValueError("only SELECT and WITH")
    for k in _FORBIDDEN:
        if (k in bare) if strict else re.search(rf"\b{k}\b", bare):
            raise ValueError(f"not allowed: {k}")


def read_only_sql(spark: SparkSession, sql: str, strict: bool = False) -> DataFrame:
    """The result of a read-only statement."""
    check_read_only(sql, strict)
    return spark.sql(sql)


def clean_names(df: DataFrame) -> DataFrame:
    """Columns with names of letters, digits and underscores only, booleans as 0 and 1."""
    return df.select(*((F.col(f"`{c}`").cast("int") if t == "boolean" else F.col(f"`{c}`")).alias(re.sub(r"\W", "_", c)) for c, t in df.dtypes))


def write_table(df: DataFrame, path: str, mode: str = "errorifexists") -> None:
    """A table of files."""
    clean_names(df).write.mode(mode).parquet(path)


def write_csv(df: DataFrame, path: str, mode: str = "errorifexists") -> None:
    """CSV with a header; quotes where needed, nulls empty, blanks kept."""
    df.write.mode(mode).csv(path, header=True, quoteAll=False, escape='"', emptyValue="", nullValue="", ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False)


def write_jsonl(df: DataFrame, path: str, mode: str = "errorifexists", keep_nulls: bool = True) -> None:
    """JSON lines in UTF-8."""
    df.write.mode(mode).option("ignoreNullFields", str(not keep_nulls).lower()).json(path)


def list_files(spark: SparkSession, path: str, skip_dirs: Sequence[str] = (), skip_extensions: Sequence[str] = (), most_bytes: int = 10 << 20, most_depth: int | None = None) -> DataFrame:
    """(path, length, modificationTime) of files under a folder, at most so many folders below it; contents are never read."""
    df = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path).select("path", "length", "modificationTime")
    for d in skip_dirs:
        df = df.where(~F.contains("path", F.lit(f"/{d}/")))
    if skip_extensions:
        df = df.where(~F.lower(F.regexp_extract("path", r"\.([^./]+)$", 1)).isin(list(skip_extensions)))
    if most_depth is not None:
        below = F.substring_index("path", path.rstrip("/").rsplit("/", 1)[-1] + "/", -1)
        df = df.where(F.size(F.split(below, "/")) <= most_depth)
    return df.where(F.col("length") <= most_bytes)


def write_files(df: DataFrame, folder: str) -> None:
    """Writes each row of (name, text) as a file of its own, from the tasks that hold the rows; the folder must be one that all executors share."""
    local = folder.removeprefix("file:")
    local = "/" + local.lstrip("/") if folder.startswith("file:") else local

    def put(rows) -> None:
        for r in rows:
            path = os.path.join(local, r["name"])
            os.makedirs(os.path.dirname(path), exist_ok=True)
            with open(path, "w", encoding="utf-8", newline="") as f:
                f.write(r["text"] or "")

    os.makedirs(local, exist_ok=True)
    df.select("name", "text").foreachPartition(put)


def _mounted(spark: SparkSession, folder: str) -> str | None:
    """The path of a folder in a file system that is mounted, where tasks can look themselves; none if it lies elsewhere (hdfs, s3a) or is a pattern."""
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
    uri = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).makeQualified(path).toUri()
    return uri.getPath() if uri.getScheme() == "file" and os.path.isdir(uri.getPath()) else None


def _walk(folder: str) -> Iterator[bytes]:
    """Paths of the files under a folder but those Spark's readers hide (names that begin with a dot, or an underscore if no = follows), as bytes, since a
    name need not be UTF-8."""
    folders = [os.fsencode(folder)]
    while folders:
        with os.scandir(folders.pop()) as entries:
            for e in entries:
                if e.name.startswith(b".") or e.name.startswith(b"_") and b"=" not in e.name or e.name.endswith(b"._COPYING_"):
                    continue
                if e.is_dir():
                    folders.append(e.path)
                elif e.is_file():
                    yield e.path


#: What Spark's readers unpack by a file's name; those without a function can't be unpacked here.
_PACKED = {b".gz": gzip.decompress, b".bz2": bz2.decompress, b".deflate": zlib.decompress, b".lz4": None, b".snappy": None, b".zst": None}


def _content(file: bytes) -> bytes:
    with open(file, "rb") as f:
        data = f.read()
    if (end := os.path.splitext(file)[1]) not in _PACKED:
        return data
    if not (unpacked := _PACKED[end]):
        raise ValueError(f"can't unpack {os.fsdecode(file)}")
    return unpacked(data)


def _texts(batches: Iterable[pa.RecordBatch], most_bytes: int = 8 << 20) -> Iterator[pa.RecordBatch]:
    """(path, text) of files whose paths are given; what is held at once ends with the file that reaches so many bytes."""
    from corpusloom.sources.office import text_or_none

    paths, texts, held = [], [], 0
    for file in (f for b in batches for f in b.column(0).to_pylist()):
        data = _content(file)
        paths.append("file:" + file.decode("utf-8", "replace"))
        texts.append(text_or_none(data) if file.lower().endswith(b".docx") else data.decode("utf-8", "replace"))
        held += len(data)
        if held >= most_bytes or len(paths) == 10_000:
            yield pa.RecordBatch.from_pydict({"path": pa.array(paths, pa.string()), "text": pa.array(texts, pa.string())})
            paths, texts, held = [], [], 0
    if paths:
        yield pa.RecordBatch.from_pydict({"path": pa.array(paths, pa.string()), "text": pa.array(texts, pa.string())})


def _mounted_texts(spark: SparkSession, folder: str) -> DataFrame:
    """(path, text) of the files under a mounted folder. One task lists them and hands the names on; the driver, whose index would hold
    an entry for each file, sees none of them."""

    def names(_: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        files = (f for f in _walk(folder) if not f.lower().endswith(b".pdf"))
        while some := list(islice(files, 10_000)):
            yield pa.RecordBatch.from_pydict({"file": pa.array(some, pa.binary())})

    tasks = max(spark.sparkContext.defaultParallelism, int(spark.conf.get("spark.sql.shuffle.partitions")))
    return spark.range(0, 1, 1, 1).mapInArrow(names, "file binary").repartition(tasks, "file").mapInArrow(_texts, "path string, text string")


def read_documents(spark: SparkSession, folder: str) -> DataFrame:
    """(path, kind, text) of the files of a folder, each one document: pages without their marks (S16), paragraphs of docx files, anything else as plain
    text (bytes that aren't UTF-8 become U+FFFD). No reader of pdf is installed: those are left out. In a file system that all executors have mounted,
    tasks list and read the files, whatever their number; elsewhere Spark's readers do, which leave out empty files and of which the driver holds an entry a file."""
    from corpusloom.operators.extract import html_text
    from corpusloom.sources.office import docx_text

    ext = F.lower(F.regexp_extract("path", r"\.([^./]+)$", 1))
    if local := _mounted(spark, folder):
        found = _mounted_texts(spark, local)
    else:
        plain = spark.read.text(folder, wholetext=True, recursiveFileLookup=True).select(F.col("_metadata.file_path").alias("path"), F.col("value").alias("text")).where(~ext.isin("pdf", "docx"))
        packed = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", "*.[dD][oO][cC][xX]").load(folder)
        found = plain.unionByName(packed.select("path", docx_text("content").alias("text")))
    kind = F.when(ext.isin("htm", "html"), "html").when(ext == "docx", "docx").otherwise("text")
    return found.select("path", kind.alias("kind"), F.when(kind == "html", html_text(F.col("text"))).otherwise(F.col("text")).alias("text"))


def name_matches(name: Column, pattern: str) -> Column:
    """Whether a name has a glob pattern anywhere, whatever its case."""
    return name.rlike("(?i)" + ".*".join(re.escape(p).replace(r"\?", ".") for p in pattern.split("*")))


def require_splits(splits: dict[str, DataFrame], names: Sequence[str], columns: Sequence[str]) -> dict[str, DataFrame]:
    """Raises if a split or one of its columns is missing."""
    for n in names:
        if n not in splits:
            raise ValueError(f"no split {n}")
        if lost := set(columns) - set(splits[n].columns):
            raise ValueError(f"{n} lacks {sorted(lost)}")
    return splits


def upsert(current: DataFrame, changes: DataFrame, key: str, version: str) -> DataFrame:
    """Current rows and changes, of each key the latest version; a change whose ``deleted`` is true removes its key.
    The result is written elsewhere: Spark can't overwrite what it reads."""
    both = current.withColumn("deleted", F.lit(False)).withColumn("_new", F.lit(0)).unionByName(changes.withColumn("_new", F.lit(1)), allowMissingColumns=True)
    row = F.struct(*both.columns)
    last = both.groupBy(key).agg(F.max_by(row, F.struct(version, "_new")).alias("_r")).select("_r.*")
    return last.where(~F.coalesce("deleted", F.lit(False))).select(*current.columns)

"""Shared parts of the llm operators: table reading, bounded samples, label spellings, Arrow mapping."""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

LANGS = ("hi", "hinglish", "en", "mr", "bn", "ta")

# Spellings of the six languages in label columns, compared in lower case and without blanks.
LABELS = {
    "hi": ("hi", "hin", "hindi", "hi-deva", "hi_in", "hi-in", "हिन्दी", "हिंदी"),
    "hinglish": ("hinglish", "hinglish_p", "hi-latn", "hi_latn", "hin-latn", "hin_latn", "roman hindi", "romanised hindi", "romanized hindi"),
    "en": ("en", "eng", "english", "en-us", "en-gb", "en-in", "en_us", "en_gb", "en_in"),
    "mr": ("mr", "mar", "marathi", "mr-in", "mr_in", "mr-deva", "मराठी"),
    "bn": ("bn", "ben", "bengali", "bangla", "bn-in", "bn_in", "bn-beng", "বাংলা"),
    "ta": ("ta", "tam", "tamil", "ta-in", "ta_in", "ta-taml", "தமிழ்"),
}


def canonical_label(label: Column) -> Column:
    """Code of the six for any spelling in LABELS; null for null, blank, placeholder and unknown labels."""
    pairs = [F.lit(x) for code, spellings in LABELS.items() for s in spellings for x in (s, code)]
    return F.try_element_at(F.create_map(*pairs), F.lower(F.trim(label)))


def table(spark: SparkSession, sf_dir: str, name: str, *columns: str) -> DataFrame:
    df = spark.read.parquet(f"{sf_dir}/{name}.parquet")
    return df.select(*columns) if columns else df


def bounded_sample(df: DataFrame, key: str, bound: int) -> DataFrame:
    """At most about ``bound`` rows (never more than twice that), chosen by a hash of ``key``: the same rows in every run.

    Counting the rows of a Parquet table reads footers only. All rows are taken where there are no more than ``bound``.
    """
    n = df.count()
    m = max(1, math.ceil(n / bound))
    if m > 1:
        df = df.where(F.pmod(F.xxhash64(key), F.lit(m)) == 0)
    return df.limit(2 * bound)


def map_arrow(df: DataFrame, fn: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]], schema: str) -> DataFrame:
    return df.mapInArrow(fn, schema)


def shared(spark: SparkSession, value: object):
    """A broadcast variable of a model whose size its parameters bound."""
    return spark.sparkContext.broadcast(value)

"""Deduplication. Keep-first operators take explicit order columns; ties are broken by all of them, so give a unique last one."""

from __future__ import annotations

from collections.abc import Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusloom.functions import text as X


def keep_first(df: DataFrame, key: Column, order: Sequence[str], drop_null: bool = False) -> DataFrame:
    """The first row of each key in the given order. Null keys are one key, or dropped.

    A group is reduced with ``min`` before it is shuffled, so that a key of any size moves one row from each task.
    """
    cols = df.columns
    d = df.withColumn("_key", key)
    if drop_null:
        d = d.where(F.col("_key").isNotNull())
    row = F.struct(*(F.col(c) for c in cols))
    order_struct = F.struct(*(F.col(o) for o in order))
    return d.groupBy("_key").agg(F.min_by(row, order_struct).alias("_row")).select(*(F.col("_row")[c].alias(c) for c in cols))


def normal_text(t: Column) -> Column:
    """Lower-case text without outer white space, null if nothing is left."""
    s = F.lower(F.regexp_replace(t, r"(?U)^\s+|\s+$", ""))
    return F.when(s != "", s)


def by_text(df: DataFrame, text: str, order: Sequence[str]) -> DataFrame:
    """The first row of each text, whatever its case and outer white space; empty texts are dropped."""
    return keep_first(df, normal_text(F.col(text)), order, drop_null=True)


def by_conversation(df: DataFrame, messages: str, order: Sequence[str]) -> DataFrame:
    """The first of conversations whose turns are all alike."""
    return keep_first(df, F.transform(F.col(messages), lambda m: F.coalesce(F.lower(F.trim(m.content)), F.lit(""))), order)


def across_pools(pools: Sequence[DataFrame], key: Sequence[str], order: Sequence[str]) -> DataFrame:
    """The first row of each key over pools in order of priority."""
    out = None
    for i, p in enumerate(pools):
        p = p.withColumn("pool_rank", F.lit(i))
        out = p if out is None else out.unionByName(p, allowMissingColumns=True)
    return keep_first(out, F.struct(*(normal_text(F.col(k)) for k in key)), ["pool_rank", *order])


def prefer(winner: DataFrame, other: DataFrame, key: str) -> DataFrame:
    """All rows of ``winner`` and those of ``other`` whose key it doesn't have."""
    return winner.unionByName(other.join(winner.select(key).distinct(), key, "left_anti").select(*other.columns), allowMissingColumns=True)


def duplicate_count(df: DataFrame, text: str) -> DataFrame:
    """Rows, distinct texts and duplicates."""
    t = F.lower(F.trim(F.col(text)))
    return df.agg(F.count(t).alias("n_rows"), F.countDistinct(t).alias("n_distinct"), (F.count(t) - F.countDistinct(t)).alias("n_duplicates"))


def groups(df: DataFrame, key: Column, item: str, least: int = 2) -> DataFrame:
    """Keys with at least ``least`` rows: how many, and the least and greatest item of each."""
    return df.groupBy(key.alias("key")).agg(F.count("*").alias("n"), F.min(item).alias("first"), F.max(item).alias("last")).where(F.col("n") >= least)


def record_similarity(a: dict[str, Column], b: dict[str, Column]) -> Column:
    """Mean similarity of fields: equal 1, either null 0, texts by edit distance."""
    parts = [F.when(a[f].eqNullSafe(b[f]), 1.0).when(a[f].isNull() | b[f].isNull(), 0.0).otherwise(X.edit_similarity(a[f].cast("string"), b[f].cast("string"))) for f in a]
    total = parts[0]
    for p in parts[1:]:
        total = total + p
    return total / len(parts)


def fuzzy_groups(df: DataFrame, row: str, fields: Sequence[str], threshold: float, block: Column) -> DataFrame:
    """(row, group) by greedy clustering: in order of rows, an unmatched row takes all later unmatched rows of its block that are
    similar enough to it; not transitive. Equal records are one representative first, whatever their number, and only
    representatives are compared, in one task for each block: ``block`` must hold what may match and stay small.
    """
    whole = F.struct(*(F.col(f) for f in fields))
    d = df.select(F.col(row).alias("_row"), block.alias("_block"), whole.alias("_record"))
    reps = d.groupBy("_block", "_record").agg(F.min("_row").alias("_first"))

    def cluster(x: pd.DataFrame) -> pd.DataFrame:
        x = x.sort_values("_first").reset_index(drop=True)
        records = [tuple(r) for r in x["_record"].map(lambda r: tuple(r.values()) if isinstance(r, dict) else tuple(r))]
        group = [-1] * len(x)
        for i, a in enumerate(records):
            if group[i] >= 0:
                continue
            group[i] = i
            for j in range(i + 1, len(records)):
                if group[j] < 0 and _similar(a, records[j], threshold):
                    group[j] = i
        x["_group"] = [x["_first"][g] for g in group]
        return x[["_block", "_first", "_group"]]

    t = dict(reps.dtypes)
    found = reps.groupBy("_block").applyInPandas(cluster, f"_block {t['_block']}, _first {t['_first']}, _group {t['_first']}")
    named = reps.join(found, ["_block", "_first"]).select("_block", F.col("_record").alias("_r"), "_group")
    return d.join(named, d["_block"].eqNullSafe(named["_block"]) & d["_record"].eqNullSafe(named["_r"])).select(F.col("_row").alias(row), F.col("_group").alias("group"))


def _similar(a: tuple, b: tuple, threshold: float) -> bool:
    total, left = 0.0, len(a)
    for x, y in zip(a, b, strict=True):
        left -= 1
        if x == y:
            total += 1
        elif x is not None and y is not None and isinstance(x, str) and isinstance(y, str):
            total += _edit(x.strip().lower(), y.strip().lower(), threshold * len(a) - total - left)
        if total + left < threshold * len(a) - 1e-12:
            return False
    return total >= threshold * len(a) - 1e-12


def _edit(x: str, y: str, need: float) -> float:
    if x == y:
        return 1.0
    n = max(len(x), len(y))
    if 1 - abs(len(x) - len(y)) / n < need:  # the distance is the difference of lengths at least
        return 0.0
    row = list(range(len(y) + 1))
    for i, cx in enumerate(x, 1):
        prev, row[0] = row[0], i
        for j, cy in enumerate(y, 1):
            prev, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, prev + (cx != cy))
    return 1 - row[-1] / n


def merged_pools(pools: Sequence[DataFrame], text: str, lang: str, order: Sequence[str]) -> DataFrame:
    """Rows of all pools, the first of each text, with a new ``key`` from language and text."""
    out = pools[0]
    for p in pools[1:]:
        out = out.unionByName(p, allowMissingColumns=True)
    kept = by_text(out, text, order)
    return kept.withColumn("key", X.sha1_key(F.concat(F.coalesce(F.col(lang), F.lit("")), F.lit("|"), F.trim(F.col(text)))))

"""Set operations."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def union_tagged(sources: dict[str, DataFrame], tag: str = "src") -> DataFrame:
    """All rows with their source's name; columns that a source lacks are null."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), (d.withColumn(tag, F.lit(n)) for n, d in sources.items()))


def missing_from(candidates: DataFrame, known: DataFrame, key: str) -> DataFrame:
    """Distinct candidates that aren't known; null is never known."""
    return candidates.select(key).distinct().join(known.select(key), key, "left_anti")


def overlap(a: Column, b: Column) -> Column:
    """Distinct elements of both arrays, over those of the first; 0 if it has none."""
    return F.coalesce(F.try_divide(F.size(F.array_intersect(a, b)), F.size(F.array_distinct(a))), F.lit(0.0))

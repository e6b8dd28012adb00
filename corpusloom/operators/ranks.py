"""Exact places within groups of any size: no task holds a hot group."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from corpusloom.sources.checkpoint import checkpointed


def ranged(df: DataFrame, by: Sequence[str], order: Sequence[str]) -> DataFrame:
    """``df`` with ``_p``: the number of the range of (by, order) that a row lies in. A hot group spans many ranges, in order; equal rows share one.

    The ranges come from a sample of the rows, so they are written to the checkpoint folder: whoever reads them again sees the same.
    """
    return checkpointed(df.repartitionByRange(*by, *order).withColumn("_p", F.spark_partition_id()))


def with_before(df: DataFrame, by: Sequence[str], per_range: DataFrame) -> DataFrame:
    """``df`` (of ``ranged``) with the other columns of ``per_range``, one row for each group and range."""
    if not by:  # as many rows as ranges
        return df.join(F.broadcast(per_range), "_p")
    p = per_range.select(*(F.col(b).alias(f"_by_{i}") for i, b in enumerate(by)), F.col("_p").alias("_q"), *(c for c in per_range.columns if c not in (*by, "_p")))
    same = df["_p"] == p["_q"]
    for i, b in enumerate(by):
        same = same & df[b].eqNullSafe(p[f"_by_{i}"])
    return df.join(p, same).drop("_q", *(f"_by_{i}" for i in range(len(by))))


def running(df: DataFrame, by: Sequence[str], order: Sequence[str], weight: str) -> DataFrame:
    """``df`` with ``_upto``: the sum of ``weight`` over the rows of its group up to each row, and ``_all``: over the whole group. Rows that are equal
    in ``order`` come one after another in any order."""
    s = ranged(df, by, order)
    n = s.groupBy(*by, "_p").agg(F.sum(weight).alias("_n"))
    g = Window.partitionBy(*by)
    before = n.select(*by, "_p", (F.sum("_n").over(g.orderBy("_p")) - F.col("_n")).alias("_before"), F.sum("_n").over(g).alias("_all"))  # a row for each range of a group
    inner = F.sum(weight).over(Window.partitionBy(*by, "_p").orderBy(*order).rowsBetween(Window.unboundedPreceding, 0))
    return with_before(s, by, before).withColumn("_upto", F.col("_before") + inner).drop("_before", "_p")


def place(df: DataFrame, by: Sequence[str], order: Sequence[str]) -> DataFrame:
    """``df`` with ``_place``: each row's place, from 1, in its group. Rows that are equal in ``order`` come one after another in any order."""
    return running(df.withColumn("_one", F.lit(1)), by, order, "_one").withColumnRenamed("_upto", "_place").drop("_one", "_all")


def neighbours(df: DataFrame, by: Sequence[str], order: Sequence[str], value: str) -> DataFrame:
    """``df`` with ``_previous`` and ``_next``: ``value`` of the rows before and after each row of its group, null at the ends."""
    s = ranged(df, by, order)
    at = F.struct(*order)
    v = F.struct(F.col(value).alias("v"))  # a null value is one, too
    edge = s.groupBy(*by, "_p").agg(F.min_by(v, at).alias("_first"), F.max_by(v, at).alias("_last"))
    g = Window.partitionBy(*by).orderBy("_p")
    edge = edge.select(*by, "_p", F.lag("_last").over(g)["v"].alias("_from"), F.lead("_first").over(g)["v"].alias("_to"))
    w = Window.partitionBy(*by, "_p").orderBy(*order)
    d = with_before(s, by, edge).withColumn("_lag", F.lag(v).over(w)).withColumn("_lead", F.lead(v).over(w))
    pick = lambda near, far: F.when(F.col(near).isNotNull(), F.col(near)["v"]).otherwise(F.col(far))
    return d.withColumn("_previous", pick("_lag", "_from")).withColumn("_next", pick("_lead", "_to")).drop("_lag", "_lead", "_from", "_to", "_p")

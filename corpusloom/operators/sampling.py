"""Sampling, quotas and splits. Chance is a hash of a seed and a key: the same rows in every run, however they are partitioned."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def chance_order(key: Column, seed: int) -> Column:
    """L3: a text by whose order rows are shuffled."""
    return F.sha1(F.encode(F.concat(F.lit(f"{seed}|"), key.cast("string")), "UTF-8"))


def uniform(key: Column) -> Column:
    """A number from 0 to 1 by the first 32 bits of a key's SHA-1."""
    return F.conv(F.substring(F.sha1(F.encode(key.cast("string"), "UTF-8")), 1, 8), 16, 10).cast("double") / float(1 << 32)


#: Buckets that a group's order of chance is cut into: hex digits of the SHA-1.
DIGITS = 3


def chance_rank(df: DataFrame, by: Sequence[str], key: Column, seed: int) -> DataFrame:
    """``df`` with ``_rank``: each row's exact place, from 1, in its group's order of chance, and ``_size``: its group's rows.

    A group of any size is cut into 4096 buckets by the first digits of the chance: buckets are counted, and rows are only
    sorted within one, so that no task holds a hot group.
    """
    d = df.withColumn("_chance", chance_order(key, seed)).withColumn("_bucket", F.left("_chance", F.lit(DIGITS))).withColumn("_key", key)
    counts = d.groupBy(*by, "_bucket").agg(F.count("*").alias("_n"))
    w = Window.partitionBy(*by)
    before = counts.select(*(F.col(b).alias(f"_by_{b}") for b in by), F.col("_bucket").alias("_b"), (F.sum("_n").over(w.orderBy("_bucket")) - F.col("_n")).alias("_before"), F.sum("_n").over(w).alias("_size"))
    same = d["_bucket"] == before["_b"]
    for b in by:
        same = same & d[b].eqNullSafe(before[f"_by_{b}"])
    inner = F.row_number().over(Window.partitionBy(*by, "_bucket").orderBy("_chance", "_key"))
    return d.join(before, same).withColumn("_rank", F.col("_before") + inner).select(*df.columns, "_rank", "_size")


def first_k(df: DataFrame, by: Sequence[str], order: Sequence[Column], k: int) -> DataFrame:
    """``k`` rows of each group in order. A limit by rank prunes within tasks before the shuffle."""
    return df.withColumn("_r", F.row_number().over(Window.partitionBy(*by).orderBy(*order))).where(F.col("_r") <= k).drop("_r")


def sample_each(df: DataFrame, by: Sequence[str], key: Column, seed: int, k: int) -> DataFrame:
    """L1: ``k`` rows of each group in order of chance."""
    return chance_rank(df, by, key, seed).where(F.col("_rank") <= k).drop("_rank", "_size")


def quotas(df: DataFrame, group: str, wanted: Mapping[str, int], key: Column, seed: int) -> DataFrame:
    """As many rows of each group as it is given, in order of chance; groups without a quota give none."""
    q = F.try_element_at(F.create_map(*[F.lit(x) for kv in wanted.items() for x in kv]), F.col(group))
    return chance_rank(df.where(q.isNotNull()), [group], key, seed).where(F.col("_rank") <= q).drop("_rank", "_size")


def shortage(taken: DataFrame, group: str, wanted: Mapping[str, int]) -> DataFrame:
    """L2: (group, quota, taken, short)."""
    q = taken.sparkSession.createDataFrame([(k, v) for k, v in wanted.items()], f"{group} string, quota int")
    return q.join(taken.groupBy(group).agg(F.count("*").alias("taken")), group, "left").select(group, "quota", F.coalesce("taken", F.lit(0)).alias("taken"), (F.col("quota") - F.coalesce("taken", F.lit(0))).alias("short"))


def stratified(df: DataFrame, stratum: str, key: Column, share: float, seed: int) -> DataFrame:
    """``split`` train for round(n share) rows of each stratum (half-even), test for the others."""
    r = chance_rank(df, [stratum], key, seed)
    return r.withColumn("split", F.when(F.col("_rank") <= F.bround(F.col("_size") * share), "train").otherwise("test")).drop("_rank", "_size")


def stratified_exact(df: DataFrame, stratum: str, key: Column, test_share: float, seed: int) -> DataFrame:
    """``split`` train or test, of which test has ceil(n share) rows of all. Each stratum gives to train what its size is worth, cut to a whole
    number; what is then missing comes from the strata with the largest remainders, of equal ones from the first by name. A null stratum is one."""
    n = df.groupBy(stratum).agg(F.count("*").alias("_c"))
    one = Window.partitionBy()  # one row for each stratum
    n = n.withColumn("_n", F.sum("_c").over(one)).withColumn("_train", F.col("_n") - F.ceil(F.col("_n") * F.lit(test_share)))
    n = n.withColumn("_low", F.floor(F.col("_c") * F.col("_train") / F.col("_n"))).withColumn("_rest", (F.col("_c") * F.col("_train")) % F.col("_n")).withColumn("_more", F.col("_train") - F.sum("_low").over(one))
    take = F.col("_low") + (F.row_number().over(Window.orderBy(F.col("_rest").desc(), stratum)) <= F.col("_more")).cast("long")
    q = n.select(F.col(stratum).alias("_stratum"), take.alias("_take"))
    r = chance_rank(df, [stratum], key, seed)
    r = r.join(q, F.col(stratum).eqNullSafe(F.col("_stratum")))
    return r.withColumn("split", F.when(F.col("_rank") <= F.col("_take"), "train").otherwise("test")).select(*df.columns, "split")


def three_way(df: DataFrame, stratum: str, key: Column, seed: int) -> DataFrame:
    """Eval and test take a tenth each from the front, at least one each in strata of three or more; of two one goes to test; one alone is train."""
    n, r = F.col("_size"), F.col("_rank")
    tenth = F.greatest(F.lit(1), F.floor(n * 0.1))
    return chance_rank(df, [stratum], key, seed).withColumn("split", F.when(n == 1, "train").when(n == 2, F.when(r == 1, "test").otherwise("train")).when(r <= tenth, "eval").when(r <= 2 * tenth, "test").otherwise("train")).drop("_rank", "_size")


def uniform_split(df: DataFrame, key: Column, share: float) -> DataFrame:
    """``split`` test for about a share of rows, by chance."""
    return df.withColumn("split", F.when(uniform(key) < share, "test").otherwise("train"))


def time_split(df: DataFrame, at: str, cutoff: Column) -> DataFrame:
    """Train before the cutoff, test from it on; null times are null."""
    return df.withColumn("split", F.when(F.col(at) < cutoff, "train").when(F.col(at) >= cutoff, "test"))


def weighted_choice(key: Column, choices: Sequence[str], weights: Sequence[float]) -> Column:
    """A choice by weight, the same for equal keys."""
    u, total, out = uniform(key), 0.0, None
    for c, w in zip(choices, weights, strict=True):
        total += w
        out = F.when(u < total, c) if out is None else out.when(u < total, c)
    return out.otherwise(choices[-1])


def reinforced(df: DataFrame, times: Column) -> DataFrame:
    """Rows repeated ``times`` times."""
    return df.withColumn("_copy", F.explode(F.sequence(F.lit(1), F.greatest(times, F.lit(1))))).drop("_copy")


def demote_and_cap(df: DataFrame, demoted: Column, anchor: Column, share: float, key: Column, seed: int) -> DataFrame:
    """Rows that aren't demoted, and of the demoted ones a seeded sample of at most a share of the anchor rows' number.

    The rank that the sample ends at comes from an exact count and an order of chance.
    """
    size = df.agg(F.floor(F.count_if(anchor) * share).alias("_cap"))
    cap = int(size.first()[0] or 0)
    back = df.where(demoted).orderBy(chance_order(key, seed), key).limit(cap)
    return df.where(~F.coalesce(demoted, F.lit(False))).unionByName(back)


def shuffled_head(parts: Sequence[DataFrame], key: str, seed: int, n: int) -> DataFrame:
    """The first ``n`` rows of all parts in order of chance."""
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out.orderBy(chance_order(F.col(key), seed), key).limit(n)


def first_passing(df: DataFrame, test: Column, order: Sequence[str], n: int) -> DataFrame:
    """L4: the first ``n`` rows in order of those that pass; each task keeps its own ``n`` before any row is moved."""
    return df.where(test).orderBy(*order).limit(n)

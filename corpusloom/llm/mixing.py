"""Problem 3: sources mixed to target weights, by pivotal dependent rounding.

Every record of a source has the same number of copies on average. Its whole part is given to all; the fractions are rounded
by pivotal steps: of two records with fractions, one passes size to the other until one of them is 0 or 1, up or down by
chance so that each keeps its mean. The total size of a source therefore hardly moves. A task leaves one open record for each source;
these are combined in a tree of small groups until one is left, which is drawn.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusloom.llm import textvec as T
from corpusloom.llm.common import shared, table
from corpusloom.llm.tokens import canonical_source
from corpusloom.sources.checkpoint import checkpointed

SEED = 20240117
#: Open records that a task of the reduction tree combines, at most (for each source).
FAN_IN = 64


def copies(available: dict[str, float], share: dict[str, float], most: dict[str, int], total: float | None = None) -> dict[str, float]:
    """Mean copies of a record of each source, so that the sources' sizes are as their shares of ``total``.

    ``total`` is the size of all listed sources unless given. A source that would need more than its most copies gets
    these, and what it lacks goes to the others in proportion to their shares (a source without records lacks all).
    """
    listed = {s: a for s, a in available.items() if a > 0 and share.get(s, 0) > 0 and most.get(s, 0) > 0}
    rest = float(sum(listed.values()) if total is None else total)
    out, open_ = {}, set(listed)
    while open_:
        whole = sum(share[s] for s in open_)
        full = {s for s in open_ if rest * share[s] / whole >= listed[s] * most[s] * (1 - 1e-12)}
        if not full:
            out.update({s: rest * share[s] / whole / listed[s] for s in open_})
            break
        for s in full:
            out[s] = float(most[s])
            rest -= listed[s] * most[s]
        open_ -= full
        rest = max(rest, 0.0)
    return out


def pivotal(p: list[float], size: list[float], draw: list[float], carry: tuple[int, float, float] | None = None) -> tuple[np.ndarray, tuple[int, float, float] | None]:
    """One pass of pivotal steps over fractions ``p`` of records of ``size``: the rounded ones, and the open record (index,
    fraction, size). ``carry`` is an open record from before, with index -1; its outcome is the last place of the result."""
    out = np.zeros(len(p) + 1, dtype=np.int64)
    open_ = carry
    for j, (pj, sj, u) in enumerate(zip(p, size, draw, strict=True)):
        if pj <= 1e-12 or pj >= 1 - 1e-12:
            out[j] = round(pj)
            continue
        if open_ is None:
            open_ = (j, pj, sj)
            continue
        i, pi, si = open_
        r = sj / si
        up = min(1 - pi, pj * r)
        down = min(pi, (1 - pj) * r)
        if u * (up + down) < down:
            pi, pj = pi + up, pj - up / r
        else:
            pi, pj = pi - down, pj + down / r
        pi_done = pi <= 1e-12 or pi >= 1 - 1e-12
        pj_done = pj <= 1e-12 or pj >= 1 - 1e-12
        if pi_done:
            out[i] = round(pi)
        if pj_done:
            out[j] = round(pj)
        open_ = None if pi_done and pj_done else ((j, pj, sj) if pi_done else (i, pi, si))
    return out, open_


def _draws(ids: np.ndarray, salt: int) -> np.ndarray:
    h = T.mix(ids.astype(np.int64).view(np.uint64) * np.uint64(0x9E3779B97F4A7C15) + np.uint64(SEED + salt))
    return (h >> np.uint64(11)).astype(np.float64) / float(1 << 53)


def source_sizes(pairs: DataFrame, mix: DataFrame) -> DataFrame:
    """(src, domain, target_share, max_repeats, records, available): all listed sources and all that have records. Responses without a visible character don't count."""
    have = _records(pairs).groupBy("src").agg(F.count("*").alias("records"), F.sum(F.length("response")).alias("available"))
    targets = mix.groupBy(canonical_source(F.col("src")).alias("src")).agg(F.min("domain").alias("domain"), F.sum("target_share").alias("target_share"), F.max("max_repeats").alias("max_repeats"))
    return targets.join(have, "src", "full_outer").fillna(0, ["target_share", "max_repeats", "records", "available"])


def _records(pairs: DataFrame) -> DataFrame:
    return pairs.select("row_id", canonical_source(F.col("src")).alias("src"), "response").where(F.col("response").isNotNull() & F.col("response").rlike(r"(?U)\S"))


_ROWS = "row_id long, src string, size double, copies long, fraction double, task long"


def _combine(level: int, last: bool):
    def combine(x: pd.DataFrame) -> pd.DataFrame:
        x = x.sort_values(["task", "row_id"], kind="stable").reset_index(drop=True)
        ids = x["row_id"].to_numpy()
        done, left = pivotal(x["fraction"].tolist(), x["size"].tolist(), _draws(ids, level).tolist())
        x["copies"] += done[:-1]
        x["fraction"] = np.nan
        if left is not None:
            if last:
                x.loc[left[0], "copies"] += int(_draws(ids, 1000)[left[0]] < left[1])
            else:
                x.loc[left[0], "fraction"] = left[1]
        x["task"] = x["task"] // FAN_IN
        return x

    return combine


def mixture(pairs: DataFrame, mix: DataFrame, total: float | None = None) -> DataFrame:
    """(row_id, src, size, copies): how often each record is used; records not used have 0 copies.

    ``pairs`` has row_id, src and response; size is the response's characters. Sources are told by ``canonical_source``. Records of
    sources that ``mix`` doesn't list, and those with a null or blank response, get no row. Repeated rows are records of their own; an
    empty table on either side gives no row. The outcome depends on row_ids and on the tasks' order of rows only.
    """
    spark = pairs.sparkSession
    # One row for each source: as many as the mix lists.
    rows = source_sizes(pairs, mix).where("target_share > 0").collect()
    mean = copies({r.src: float(r.available) for r in rows}, {r.src: r.target_share for r in rows}, {r.src: r.max_repeats for r in rows}, total)
    held = shared(spark, mean)

    def first(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task = TaskContext.get().partitionId()
        carry: dict[str, tuple[int, float, float]] = {}
        owner: dict[str, int] = {}

        def batch(ids, src, size, n, fraction) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(src, pa.string()), pa.array(size, pa.float64()), pa.array(n, pa.int64()), pa.array(fraction, pa.float64()), pa.array([task] * len(ids), pa.int64())], names=["row_id", "src", "size", "copies", "fraction", "task"])

        for b in T.slices(it, "response"):
            src = np.array(b.column("src").to_pylist(), dtype=object)
            ids = b.column("row_id").to_numpy(zero_copy_only=False)
            size = pc.utf8_length(b.column("response")).to_numpy(zero_copy_only=False).astype(float)
            draw = _draws(ids, 0)
            for s in sorted(set(src) & set(held.value)):
                at = np.flatnonzero(src == s)
                base = math.floor(held.value[s] + 1e-12)
                f = held.value[s] - base
                done, open_ = pivotal([f] * len(at), size[at].tolist(), draw[at].tolist(), carry.get(s))
                use = np.ones(len(at), dtype=bool)
                if s in carry:
                    if open_ is None or open_[0] != -1:  # the record carried so far is settled
                        yield batch([owner[s]], [s], [carry[s][2]], [base + int(done[-1])], [None])
                        del carry[s]
                    else:
                        carry[s] = open_
                if open_ is not None and open_[0] >= 0:
                    use[open_[0]] = False
                    carry[s], owner[s] = (-1, open_[1], open_[2]), int(ids[at][open_[0]])
                if use.any():
                    yield batch(ids[at][use], [s] * int(use.sum()), size[at][use], base + done[:-1][use], [None] * int(use.sum()))
        for s, (_, f, size_) in carry.items():
            yield batch([owner[s]], [s], [size_], [math.floor(held.value[s] + 1e-12)], [f])

    rounded = checkpointed(_records(pairs).mapInArrow(first, _ROWS))
    settled = "fraction is null or isnan(fraction)"
    parts = [rounded.where(settled)]
    # Each level of the tree combines the open records of FAN_IN tasks; the last one draws what stays open.
    open_, tasks = rounded.where(f"not ({settled})"), rounded.rdd.getNumPartitions()
    level = 0
    while True:
        level += 1
        last = tasks <= FAN_IN

        step = open_.groupBy("src", F.floor(F.col("task") / FAN_IN).alias("node")).applyInPandas(_combine(level, last), _ROWS)
        if last:
            parts.append(step)
            break
        step = checkpointed(step)
        parts.append(step.where(settled))
        open_, tasks = step.where(f"not ({settled})"), -(-tasks // FAN_IN)
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out.select("row_id", "src", "size", "copies")


def shares(pairs: DataFrame, mix: DataFrame, mixed: DataFrame) -> DataFrame:
    """(src, domain, target_share, max_repeats, records, available, used, most_copies, size, actual_share, share_error) of each source, listed or not."""
    got = mixed.groupBy("src").agg(F.count_if(F.col("copies") > 0).alias("used"), F.max("copies").alias("most_copies"), F.sum(F.col("size") * F.col("copies")).alias("size"))
    t = source_sizes(pairs, mix).join(got, "src", "left").fillna(0, ["used", "most_copies", "size"])
    whole = got.agg(F.sum("size").alias("whole"))  # one row
    t = t.join(F.broadcast(whole), F.lit(True), "left").withColumn("actual_share", F.coalesce(F.try_divide("size", "whole"), F.lit(0.0))).drop("whole")
    return t.withColumn("share_error", F.col("actual_share") - F.col("target_share"))


def _tables(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    return table(spark, sf_dir, "train_smoke", "row_id", "src", "response"), table(spark, sf_dir, "source_mix")


def p3_mixture(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixture(*_tables(spark, sf_dir)).where("copies > 0")


def p3_shares(spark: SparkSession, sf_dir: str) -> DataFrame:
    pairs, mix = _tables(spark, sf_dir)
    return shares(pairs, mix, mixture(pairs, mix))

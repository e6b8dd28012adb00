"""Positional operators on arrays and windows."""

from __future__ import annotations

from collections.abc import Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from corpusloom.operators.ranks import neighbours, place


def first_by_role(messages: Column, role: str) -> Column:
    """Content of the first message of a role, null without one."""
    return F.try_element_at(F.filter(messages, lambda m: m.role == role), F.lit(1)).content


def last_by_role(messages: Column, role: str) -> Column:
    return F.try_element_at(F.filter(messages, lambda m: m.role == role), F.lit(-1)).content


def last_pair(messages: Column) -> tuple[Column, Column]:
    """Contents of the last two messages, null where there are fewer."""
    return F.try_element_at(messages, F.lit(-2)).content, F.try_element_at(messages, F.lit(-1)).content


def first_valid_pair(pairs: Column) -> Column:
    """The first of an array of [prompt, answer] arrays whose both sides are there and not blank, trimmed."""
    side = lambda p, k: F.trim(F.coalesce(F.try_element_at(p, F.lit(k)), F.lit("")))
    good = F.filter(pairs, lambda p: (side(p, 1) != "") & (side(p, 2) != ""))
    first = F.try_element_at(good, F.lit(1))
    return F.when(first.isNotNull(), F.struct(side(first, 1).alias("prompt"), side(first, 2).alias("answer")))


def merged_intervals(df: DataFrame, by: Sequence[str], start: str, end: str) -> DataFrame:
    """Unions of intervals that overlap or touch, by group. Intervals without a start or end are dropped."""
    d = df.where(F.col(start).isNotNull() & F.col(end).isNotNull()).select(*by, F.col(start).alias("_s"), F.col(end).alias("_e"))
    w = Window.partitionBy(*by).orderBy("_s", "_e")
    d = d.withColumn("_top", F.max("_e").over(w.rowsBetween(Window.unboundedPreceding, -1)))
    d = d.withColumn("_block", F.sum((F.col("_top").isNull() | (F.col("_s") > F.col("_top"))).cast("int")).over(w))
    return d.groupBy(*by, "_block").agg(F.min("_s").alias(start), F.max("_e").alias(end)).drop("_block")


def free_slots(busy: DataFrame, by: Sequence[str], start: str, end: str, day_start: Column, day_end: Column, least_minutes: int = 30) -> DataFrame:
    """Gaps of at least so many minutes between merged intervals, within the day's bounds (timestamps by group)."""
    d = busy.select(*by, day_start.alias("_d0"), day_end.alias("_d1"), F.greatest(F.col(start), day_start).alias("_s"), F.least(F.col(end), day_end).alias("_e"))
    m = merged_intervals(d.where("_s < _e"), [*by, "_d0", "_d1"], "_s", "_e")
    w = Window.partitionBy(*by, "_d0", "_d1").orderBy("_s")
    gaps = m.select(*by, F.coalesce(F.lag("_e").over(w), F.col("_d0")).alias("slot_start"), F.col("_s").alias("slot_end"))
    tail = m.groupBy(*by, "_d0", "_d1").agg(F.max("_e").alias("slot_start")).select(*by, "slot_start", F.col("_d1").alias("slot_end"))
    minutes = F.floor((F.unix_micros(F.col("slot_end").cast("timestamp")) - F.unix_micros(F.col("slot_start").cast("timestamp"))) / 60e6 + 0.5).cast("long")
    return gaps.unionByName(tail).withColumn("minutes", minutes).where((F.col("slot_end") > F.col("slot_start")) & (F.col("minutes") >= least_minutes))


def first_fit(slots: DataFrame, by: Sequence[str], preferred: Column) -> DataFrame:
    """The first slot of the preferred ones, else the first."""
    s = F.struct("slot_start", "slot_end", "minutes")
    return slots.groupBy(*by).agg(F.min_by(s, F.struct((~preferred).alias("p"), F.col("slot_start").alias("s"))).alias("_x")).select(*by, "_x.*")


def carried(df: DataFrame, by: Sequence[str], order: Sequence[str], label: str, name: str) -> DataFrame:
    """The last label seen up to each row."""
    return df.withColumn(name, F.last(label, ignorenulls=True).over(Window.partitionBy(*by).orderBy(*order)))


def with_context(df: DataFrame, by: Sequence[str], order: Sequence[str], line: str, name: str) -> DataFrame:
    """The trimmed lines before, at and after each row, blank ones left out. Hot groups are cut into ranges."""
    clean = lambda c: F.when(F.trim(c) != "", F.trim(c))
    d = neighbours(df, by, order, line)
    return d.withColumn(name, F.concat_ws(" ", clean(F.col("_previous")), clean(F.col(line)), clean(F.col("_next")))).drop("_previous", "_next")


def length_batches(df: DataFrame, length: str, order: str, size: int = 16) -> DataFrame:
    """Rows in batches of one length class: sorted by length, cut by ``size``; the ragged tail has the last number.

    Places are those within ranges of (length, order) after the counts of the ranges before, so no task sorts all rows or all of one length.
    """
    return place(df, [], [length, order]).withColumn("batch", F.floor((F.col("_place") - 1) / size)).drop("_place")


def padded_positions(df: DataFrame, batch: str, length: str) -> DataFrame:
    """Positions when every batch is padded to its longest row, and when none is."""
    b = df.groupBy(batch).agg((F.count("*") * F.max(length)).alias("p"), F.sum(length).alias("t"))
    return b.agg(F.sum("p").alias("padded"), F.sum("t").alias("tokens"))


def greedy_share(df: DataFrame, by: Sequence[str], tokens: str, budget: str, order: Sequence[str]) -> DataFrame:
    """By group, rows in order of length, longest first, of which each is kept that still fits the budget (greedy, skipping).

    Exact skipping is sequential. Equal lengths are counted, so the pass goes over distinct lengths, whatever the number of rows:
    of a length as many rows are kept, in order, as the budget then holds.
    """
    c = df.groupBy(*by, tokens).agg(F.count("*").alias("_n"), F.max(budget).alias("_b"))

    def passes(x: pd.DataFrame) -> pd.DataFrame:
        x = x.sort_values(tokens, ascending=False).reset_index(drop=True)
        left, take = float(x["_b"].iloc[0]), []
        for t, n in zip(x[tokens], x["_n"], strict=True):
            k = int(n) if t <= 0 else int(min(n, left // t))
            left -= k * t
            take.append(k)
        x["_take"] = take
        return x

    t = dict(c.dtypes)
    got = c.groupBy(*by).applyInPandas(passes, ", ".join(f"{k} {t[k]}" for k in c.columns) + ", _take long").select(*by, tokens, "_take")
    # Of a length that is kept or left as a whole no row needs a place; of each group at most a few lengths are cut.
    whole = got.join(c.select(*by, tokens, "_n"), [*by, tokens])
    kept = df.join(whole.where("_take = _n").select(*by, tokens), [*by, tokens], "left_semi")
    cut = place(df.join(whole.where("_take > 0 and _take < _n").select(*by, tokens, "_take"), [*by, tokens]), [*by, tokens], order)
    return kept.unionByName(cut.where(F.col("_place") <= F.col("_take")).select(*df.columns))


def trimmed_turns(messages: Column, tokens: Column, cap: int, least: int = 4) -> Column:
    """The longest of the conversation, it less its last pair, and so on down to ``least`` messages, whose ``tokens`` (an array of each
    message's) sum to the cap at most; null if none does."""
    n = F.size(messages)
    sizes = F.filter(F.sequence(F.lit(0), F.greatest(n, F.lit(0))), lambda k: (n - k >= F.least(n, F.lit(least))) & (k % 2 == 0))
    total = lambda k: F.aggregate(F.slice(tokens, 1, n - k), F.lit(0).cast("long"), lambda a, x: a + x)
    fit = F.filter(sizes, lambda k: total(k) <= cap)
    return F.when(F.size(fit) > 0, F.slice(messages, 1, n - F.try_element_at(fit, F.lit(1))))


def prefix_within(df: DataFrame, by: Sequence[str], order: Sequence[str], tokens: str, budget: int, extra: int = 2) -> DataFrame:
    """By group, the rows before the first that would pass the budget, ``extra`` tokens being added for each."""
    w = Window.partitionBy(*by).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    return df.withColumn("_run", F.sum(F.col(tokens) + extra).over(w)).where(F.col("_run") <= budget).drop("_run")


def newest(df: DataFrame, by: Sequence[str], order: str, n: int) -> DataFrame:
    """The last ``n`` rows of each group."""
    return df.withColumn("_r", F.row_number().over(Window.partitionBy(*by).orderBy(F.col(order).desc()))).where(F.col("_r") <= n).drop("_r")


def oldest(df: DataFrame, by: Sequence[str], order: str, n: int, skip: Column) -> DataFrame:
    """The first ``n`` rows of each group of those not to skip."""
    return df.where(~skip).withColumn("_r", F.row_number().over(Window.partitionBy(*by).orderBy(order))).where(F.col("_r") <= n).drop("_r")


def eviction(df: DataFrame, session: str, order: str, tokens: str, keep: int = 10, budget: int = 32768 - 900 - 2000 - 2000 - 768, threshold: int = 5000) -> DataFrame:
    """By session its tokens, what is left of the budget, whether that is under the threshold and how many rows beyond the
    newest ``keep`` (system rows not counted) may go."""
    t = df.groupBy(session).agg(F.sum(tokens).alias("tokens"), F.greatest(F.lit(0), F.count_if(F.col("role") != "system") - keep).alias("evictable"))
    return t.select(session, "tokens", (F.lit(budget) - F.col("tokens")).alias("left_over"), ((F.lit(budget) - F.col("tokens")) < threshold).alias("tight"), "evictable")


def compressed_history(df: DataFrame, by: Sequence[str], order: str, content: str, window: int, short: Column) -> DataFrame:
    """Rows older than the newest ``window`` have their one-line form, others their content. Rows as old as the oldest of the newest
    count as new. The newest rows are picked within tasks first, so a hot group moves a few rows of each."""
    keys = [f"_k{i}" for i in range(len(by))]
    limit = newest(df, by, order, window).groupBy(*by).agg(F.min(order).alias("_from")).toDF(*keys, "_from")
    same = F.lit(True)
    for b, k in zip(by, keys, strict=True):
        same = same & F.col(b).eqNullSafe(F.col(k))
    d = df.join(limit, same, "left")
    return d.withColumn("view", F.when(F.col(order) < F.col("_from"), short).otherwise(F.col(content))).select(*df.columns, "view")


def rolling_band(df: DataFrame, by: Sequence[str], order: Sequence[str], value: str, rows: int = 10) -> DataFrame:
    """Mean and sample deviation (0 for one row) of the last ``rows`` rows."""
    w = Window.partitionBy(*by).orderBy(*order).rowsBetween(-(rows - 1), 0)
    return df.withColumn("mean", F.avg(value).over(w)).withColumn("deviation", F.coalesce(F.stddev_samp(value).over(w), F.lit(0.0)))


def variants(df: DataFrame, by: Sequence[str], order: Sequence[str], n: int) -> DataFrame:
    """A variant from 0 to n - 1 by place within its group."""
    return place(df, by, order).withColumn("variant", F.pmod(F.col("_place") - 1, F.lit(n))).drop("_place")

"""Joins and lookups."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from corpusloom.operators.dedup import keep_first
from corpusloom.operators.ranks import place
from corpusloom.sources.checkpoint import checkpointed


def first_source(rows: DataFrame, pool: DataFrame, text: str, value: str, order: Sequence[str]) -> DataFrame:
    """Rows with ``found``: the value of the first pool row with the same trimmed text, null without one."""
    key = F.trim(F.col(text))
    index = keep_first(pool.select(text, value, *order), key, order).select(key.alias("_k"), F.col(value).alias("found"))
    return rows.join(index, F.trim(rows[text]) == F.col("_k"), "left").drop("_k")


def not_done(todo: DataFrame, done: DataFrame, key: str) -> DataFrame:
    """Rows of ``todo`` whose key isn't done. A null key is never done."""
    return todo.join(done.select(key), key, "left_anti")


def with_parent(children: DataFrame, parents: DataFrame, child_key: str, parent_key: str) -> DataFrame:
    """Each child with its one parent."""
    return children.join(parents, children[child_key] == parents[parent_key])


def reconcile(indexed: DataFrame, found: DataFrame, path: str, hash_: str) -> DataFrame:
    """(path, state): added, updated, removed or unchanged."""
    a, b = indexed.select(F.col(path).alias("path"), F.col(hash_).alias("_a"), F.lit(True).alias("_in")), found.select(F.col(path).alias("path"), F.col(hash_).alias("_b"), F.lit(True).alias("_on"))
    state = F.when(F.col("_in").isNull(), "added").when(F.col("_on").isNull(), "removed").when(F.col("_a").eqNullSafe(F.col("_b")), "unchanged").otherwise("updated")
    return a.join(b, "path", "full_outer").select("path", state.alias("state"))


def compare_runs(baseline: DataFrame, candidate: DataFrame, key: str, passed: str, order: str) -> DataFrame:
    """(key, change): regression or improvement; of repeated ids the last counts."""
    last = lambda d, name: d.groupBy(key).agg(F.max_by(passed, order).alias(name))
    change = F.when(F.col("_a") & ~F.col("_b"), "regression").when(~F.col("_a") & F.col("_b"), "improvement")
    return last(baseline, "_a").join(last(candidate, "_b"), key).select(key, change.alias("change")).where("change is not null")


def fill_neighbours(wanted: DataFrame, key: str, listed: str, pool: DataFrame, item: str, k: int) -> DataFrame:
    """(key, item, rank): the listed neighbours first, filled up to ``k`` with other pool items in order of chance.

    The pool lies on a ring, in order of a hash; each key begins at a place of its own and takes as many items as it may need, so no
    key meets the whole pool. Listed items that come up again are skipped. A null or empty list is filled altogether.
    """
    items = place(pool.select(item).where(F.col(item).isNotNull()).distinct().withColumn("_h", F.sha1(F.encode(F.col(item).cast("string"), "UTF-8"))), [], ["_h", item])
    size = items.agg(F.count("*").alias("_size"))  # one row
    have = F.coalesce(F.col(listed), F.array().cast(dict(wanted.dtypes)[listed]))
    begin = F.conv(F.substring(F.sha1(F.encode(F.col(key).cast("string"), "UTF-8")), 1, 8), 16, 10).cast("long")
    w = wanted.select(key, have.alias("_have")).join(F.broadcast(size), F.lit(True)).where("_size > 0")
    steps = F.sequence(F.lit(0), F.least(F.lit(k) + F.size("_have"), "_size") - 1)
    turn = w.select(key, "_have", F.explode(steps).alias("_i"), "_size").withColumn("_place", F.pmod(begin + F.col("_i"), F.col("_size")) + 1)
    fill = turn.join(items.select("_place", item), "_place").where(~F.array_contains("_have", F.col(item))).select(key, (F.col("_i") + (1 << 20)).cast("long").alias("_at"), item)
    own = wanted.select(key, F.posexplode(listed).alias("_at", item)).select(key, F.col("_at").cast("long").alias("_at"), item)
    r = F.row_number().over(Window.partitionBy(key).orderBy("_at"))
    return own.unionByName(fill).withColumn("rank", r).where(F.col("rank") <= k).select(key, item, "rank")


def weight_or_margins(cells: DataFrame, weights: DataFrame, keys: Sequence[str], default: float = 0.5) -> DataFrame:
    """Each cell's weight; where it is missing the mean of its keys' marginal means, ``default`` for those that are missing."""
    out = cells.join(weights.select(*keys, "weight"), list(keys), "left")
    terms = []
    for k in keys:
        out = out.join(weights.groupBy(k).agg(F.avg("weight").alias(f"_m_{k}")), k, "left")
        terms.append(F.coalesce(F.col(f"_m_{k}"), F.lit(default)))
    total = terms[0]
    for t in terms[1:]:
        total = total + t
    return out.select(*cells.columns, F.coalesce("weight", total / len(terms)).alias("weight"))


def lookup(value: Column, mapping: dict[str, str], default: str) -> Column:
    """The mapped value, or the default."""
    return F.coalesce(F.try_element_at(F.create_map(*[F.lit(x) for kv in mapping.items() for x in kv]), value), F.lit(default))


def jobs(*dimensions: DataFrame) -> DataFrame:
    """All combinations of small dimensions, in order of a hash."""
    out = dimensions[0]
    for d in dimensions[1:]:
        out = out.crossJoin(F.broadcast(d))
    return out


def numbered(df: DataFrame, prefix: str, order: Sequence[str]) -> DataFrame:
    """Running keys ``prefix:n`` in the given order.

    Numbers are places in sorted partitions plus the counts before them, so that no task sees all rows. The sorted rows
    are checkpointed: both uses see the same partitions.
    """
    s = checkpointed(df.orderBy(*order).withColumn("_p", F.spark_partition_id()).withColumn("_i", F.monotonically_increasing_id()))
    counts = s.groupBy("_p").agg(F.count("*").alias("_n"), F.min("_i").alias("_lo"))
    before = counts.alias("a").join(F.broadcast(counts.alias("b")), F.col("b._p") < F.col("a._p"), "left").groupBy("a._p", "a._lo").agg(F.coalesce(F.sum("b._n"), F.lit(0)).alias("_before"))
    return s.join(F.broadcast(before), "_p").withColumn("key", F.concat(F.lit(prefix + ":"), (F.col("_before") + F.col("_i") - F.col("_lo") + 1).cast("string"))).drop("_p", "_i", "_lo", "_before")


def under_path(path: Column, prefix: str, like: bool = False) -> Column:
    """Whether a path lies under a prefix; ``like`` takes ASCII case and % and _ of the prefix as SQL's LIKE does."""
    return path.ilike(prefix + "%") if like else path.startswith(prefix)


def with_parent_row(nodes: DataFrame, key: str, parent: str, columns: Sequence[str]) -> DataFrame:
    """Nodes of a tree with their parent's columns as ``parent_...``, null for roots and lost parents."""
    p = nodes.select(F.col(key).alias("_pk"), *(F.col(c).alias(f"parent_{c}") for c in columns))
    return nodes.join(p, nodes[parent] == F.col("_pk"), "left").drop("_pk")

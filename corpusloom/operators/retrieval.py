"""Retrieval over embeddings and terms."""

from __future__ import annotations

import re
from collections.abc import Mapping, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from corpusloom.functions import text as X


def dot(a: Column, b: Column) -> Column:
    return F.aggregate(F.zip_with(a, b, lambda x, y: x.cast("double") * y.cast("double")), F.lit(0.0), lambda s, x: s + x)


def norm(a: Column) -> Column:
    return F.sqrt(dot(a, a))


def cosine(a: Column, b: Column) -> Column:
    """R2: cosine similarity, 0 if either has no length; vectors of unequal lengths raise an error, null gives null."""
    n = norm(a) * norm(b)
    return F.when(F.size(a) != F.size(b), F.raise_error("lengths differ").cast("double")).when(n == 0, 0.0).otherwise(dot(a, b) / n)


def top_k(vectors: DataFrame, key: str, vector: str, query: Sequence[float] | None, k: int, least: float | None = None) -> DataFrame:
    """The ``k`` rows most similar to one vector (score rounded to 6 places, then by key), of those that reach ``least``; none without a vector."""
    if query is None:
        return vectors.select(key, F.lit(0.0).alias("score")).limit(0)
    s = vectors.where(F.col(vector).isNotNull()).select(key, F.round(cosine(F.col(vector), F.array(*map(F.lit, map(float, query)))), 6).alias("score"))
    if least is not None:
        s = s.where(F.col("score") >= least)
    return s.orderBy(F.col("score").desc(), key).limit(k)


def top_k_each(vectors: DataFrame, key: str, vector: str, queries: DataFrame, k: int, block: int = 2048) -> DataFrame:
    """(query, key, score, rank): the ``k`` rows most similar to each row of ``queries``, itself left out.

    Queries are taken in blocks, each broadcast (``block`` vectors at most) against all rows; a task keeps the k best of
    each query before anything is shuffled.
    """
    spark = vectors.sparkSession
    q = queries.where(F.col(vector).isNotNull()).select(key, vector)
    n = max(1, -(-q.count() // block))
    out = None
    kt = dict(vectors.dtypes)[key]
    for i in range(n):
        part = q.where(F.pmod(F.xxhash64(key), F.lit(n)) == i).toPandas() if n > 1 else q.toPandas()
        if not len(part):
            continue
        held = spark.sparkContext.broadcast((part[key].to_numpy(), np.stack(part[vector].to_numpy()).astype(np.float64)))

        def best(it, held=held):
            ids, m = held.value
            m = m / np.maximum(np.linalg.norm(m, axis=1, keepdims=True), 1e-300)
            top: dict[int, list] = {}
            for b in it:
                v = np.stack(b[vector].to_numpy()).astype(np.float64)
                s = np.round(v / np.maximum(np.linalg.norm(v, axis=1, keepdims=True), 1e-300) @ m.T, 6)
                own = b[key].to_numpy()
                for j in range(len(ids)):
                    col = np.where(own == ids[j], -np.inf, s[:, j])
                    take = np.argpartition(-col, min(k, len(col) - 1))[: k + 1] if len(col) > k + 1 else np.arange(len(col))
                    # All that tie with the last one stay, so that keys decide ties over all tasks.
                    at = np.flatnonzero(col >= np.sort(col[take])[::-1][: k][-1])
                    top.setdefault(j, []).extend((float(col[x]), own[x]) for x in at if np.isfinite(col[x]))
                    top[j] = sorted(top[j], key=lambda t: (-t[0], t[1]))[:k]
            rows = [(ids[j], own, score) for j, found in top.items() for score, own in found]
            yield pd.DataFrame(rows, columns=["query", key, "score"])

        step = vectors.where(F.col(vector).isNotNull()).select(key, vector).mapInPandas(best, f"query {kt}, {key} {kt}, score double")
        out = step if out is None else out.unionByName(step)
    if out is None:
        return spark.createDataFrame([], f"query {kt}, {key} {kt}, score double, rank int")
    w = Window.partitionBy("query").orderBy(F.col("score").desc(), key)
    return out.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k)


def mean_pooled(vectors: Column) -> Column:
    """The mean of an array of vectors, with length 1 (as it is if it has none)."""

    def mean(v: Column) -> Column:
        first = F.transform(F.get(v, F.lit(0)), lambda x: x.cast("double"))
        total = F.aggregate(F.slice(v, 2, F.greatest(F.size(v) - 1, F.lit(0))), first, lambda a, x: F.zip_with(a, x, lambda p, q: p + q))
        return F.transform(total, lambda x: x / F.size(v))

    def unit(m: Column) -> Column:
        return X.let(norm(m), lambda n: F.when(n > 0, F.transform(m, lambda x: x / n)).otherwise(m))

    return X.let(X.let(vectors, mean), unit)


def bm25(docs: DataFrame, key: str, fields: Mapping[str, int], query: str, stopwords: Sequence[str], k1: float = 1.5, b: float = 0.75) -> DataFrame:
    """(key, score) of documents with any term of the query. A field's terms count as often as its weight; a term that the query repeats counts each time."""
    w = list(stopwords)
    terms = F.flatten(F.array(*(F.flatten(F.array_repeat(X.search_terms(F.coalesce(F.col(f), F.lit("")), w), n)) for f, n in fields.items())))
    d = docs.select(key, terms.alias("_t")).withColumn("_dl", F.size("_t"))
    q = docs.sparkSession.range(1).select(X.search_terms(F.lit(query), w).alias("q")).first().q
    if not q:
        return d.select(key, F.lit(0.0).alias("score")).limit(0)
    each = {t: q.count(t) for t in q}

    def times(term: str) -> Column:
        return F.size(F.filter("_t", lambda x: x == term))

    tf = [times(t).alias(f"_f{i}") for i, t in enumerate(each)]
    d = d.select(key, "_dl", *tf)
    stats = d.agg(F.count("*").alias("_n"), F.avg("_dl").alias("_avg"), *(F.count_if(F.col(f"_f{i}") > 0).alias(f"_d{i}") for i in range(len(each))))
    j = d.join(F.broadcast(stats), F.lit(True))
    score = F.lit(0.0)
    for i, repeats in enumerate(each.values()):
        f, df = F.col(f"_f{i}"), F.col(f"_d{i}")
        idf = F.log((F.col("_n") - df + 0.5) / (df + 0.5) + 1)
        score = score + repeats * idf * f * (k1 + 1) / (f + k1 * (1 - b + b * F.col("_dl") / F.greatest(F.col("_avg"), F.lit(1e-9))))
    return j.select(key, score.alias("score")).where("score > 0")


def phrase_score(query: Column, phrase: Column, bonus: float = 0.05) -> Column:
    """The mean of recall and precision of a phrase's terms in a query's, with a bonus for a whole match."""
    common = F.size(F.array_intersect(query, phrase))
    r, p = F.coalesce(F.try_divide(common, F.size(F.array_distinct(phrase))), F.lit(0.0)), F.coalesce(F.try_divide(common, F.size(F.array_distinct(query))), F.lit(0.0))
    return (r + p) / 2 + F.when(r == 1, bonus).otherwise(0.0)


def with_priors(scored: DataFrame, key: str, hints: Mapping[str, tuple[Column, float]], k: int = 3, pool: int = 16) -> DataFrame:
    """The best ``pool`` rows by score with the priors of their hints added, and of these the best ``k``."""
    d = scored.orderBy(F.col("score").desc(), key).limit(pool)
    total = F.col("score")
    for cond, weight in hints.values():
        total = total + F.when(cond, weight).otherwise(0.0)
    return d.withColumn("total", total).orderBy(F.col("total").desc(), key).limit(k)


def max_sim(query: Column, doc: Column) -> Column:
    """Mean over query vectors of the best dot product with a document vector; 0 without either."""
    best = F.transform(query, lambda q: F.array_max(F.transform(doc, lambda d: dot(q, d))))
    return F.when((F.size(query) > 0) & (F.size(doc) > 0), F.aggregate(best, F.lit(0.0), lambda a, x: a + x) / F.size(query)).otherwise(0.0)


def keyword_match(items: DataFrame, key: str, keywords: str, query: str) -> DataFrame:
    """The one best row by keywords in the query (2 for a phrase, 1 for a word) with its confidence; no row if it is below 1 or not the only best."""
    q = query.lower()
    tokens = re.findall(r"\w+", q)
    s = F.aggregate(F.transform(keywords, lambda w: F.when(F.contains(w, F.lit(" ")), F.when(F.contains(F.lit(q), F.lower(w)), 2.0).otherwise(0.0)).otherwise(F.when(F.lower(w).isin(tokens), 1.0).otherwise(0.0))), F.lit(0.0), lambda a, x: a + x)
    two = items.select(key, s.alias("score")).where("score >= 1").orderBy(F.col("score").desc(), key).limit(2)
    w = Window.orderBy(F.col("score").desc(), key)  # two rows
    m = two.withColumn("margin", F.col("score") - F.coalesce(F.lead("score").over(w), F.lit(0.0))).withColumn("_r", F.row_number().over(w)).where("_r = 1 and margin > 0")
    return m.select(key, "score", F.greatest(F.lit(0.5), F.least(F.lit(1.0), (F.col("score") + F.col("margin")) / (F.col("score") + F.col("margin") + 4))).alias("confidence"))


def faithfulness(answer: Column, source: Column, stopwords: Sequence[str], least: float = 0.10) -> Column:
    """Whether the Jaccard similarity of the texts' word pairs reaches a threshold; true without a source, false without pairs."""

    def compare(p: Column) -> Column:
        j = F.try_divide(F.size(F.array_intersect(p["a"], p["b"])), F.size(F.array_union(p["a"], p["b"])))
        return F.when((F.size(p["a"]) == 0) | (F.size(p["b"]) == 0), False).otherwise(j >= least)

    sets = F.struct(X.bigram_set(answer, list(stopwords)).alias("a"), X.bigram_set(source, list(stopwords)).alias("b"))
    return F.when(source.isNull(), True).otherwise(X.let(sets, compare))

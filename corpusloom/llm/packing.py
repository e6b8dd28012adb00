"""Problem 6: documents into training sequences of a fixed capacity, by best-two-fit.

Each task packs the documents it reads, in blocks, so that nothing is shuffled: a block of BLOCK documents leaves room over in
its last sequences only.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusloom.llm import textvec as T
from corpusloom.llm import tokens as K
from corpusloom.llm.common import shared, table

#: Tokens of a sequence, and documents that are packed together, at most.
CAPACITY, BLOCK = 2048, 1 << 16


def pack(sizes: list[int], capacity: int) -> list[list[int]]:
    """Bins of indices of ``sizes`` (each from 1 to ``capacity``).

    A bin takes the largest document that fits until none does. Then its smallest document gives way to two unpacked
    ones that fill the gap better, the best such pair, as long as there is one. Unpacked sizes are bit sets, in which the
    largest size up to a limit and a pair of a given sum are found in a few steps.
    """
    place: dict[int, list[int]] = {}
    for i, s in enumerate(sizes):
        place.setdefault(s, []).append(i)
    have, back = 0, 0  # bit s: a document of size s; bit capacity - s: the same
    for s in place:
        have |= 1 << s
        back |= 1 << (capacity - s)
    bins = []

    def take(s: int) -> int:
        nonlocal have, back
        i = place[s].pop()
        if not place[s]:
            have ^= 1 << s
            back ^= 1 << (capacity - s)
        return i

    def put(s: int, i: int) -> None:
        nonlocal have, back
        place[s].append(i)
        have |= 1 << s
        back |= 1 << (capacity - s)

    while have:
        inside: list[tuple[int, int]] = []
        left = capacity
        while True:
            s = (have & ((1 << (left + 1)) - 1)).bit_length() - 1
            if s <= 0:
                break
            inside.append((s, take(s)))
            left -= s
        while left and have and len(inside) > 1:
            small = inside[-1][0]
            gap = left + small
            pair = None
            for total in range(gap, small, -1):
                both = have & (back >> (capacity - total)) & ((1 << total) - 1)
                if total % 2 == 0 and both >> (total // 2) & 1 and len(place[total // 2]) < 2:
                    both ^= 1 << (total // 2)
                if both:
                    a = both.bit_length() - 1
                    pair = (a, total - a)
                    break
            if pair is None:
                break
            put(*inside.pop())
            for s in pair:
                inside.append((s, take(s)))
            inside.sort(reverse=True)
            left = capacity - sum(s for s, _ in inside)
        bins.append([i for _, i in inside])
    return bins


def pieces(count: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Document, first token and length of each piece: a document is divided only if it alone exceeds the capacity."""
    n = -(-count // capacity)
    doc = np.repeat(np.arange(len(count)), n)
    k = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
    start = k * capacity
    return doc, start, np.minimum(capacity, count[doc] - start)


def sequences(documents: DataFrame, capacity: int = CAPACITY, vocabulary: str = K.VOCABULARY, block: int = BLOCK) -> DataFrame:
    """(doc_id, part, first_token, tokens, sequence): where each document, or each part of one longer than ``capacity``, goes.

    Null and empty texts have no tokens and no row. Repeated documents are packed each; an empty table gives no row; other
    columns are ignored. A sequence's number holds the task's and the block's; equal inputs in equal splits give equal numbers.
    """
    held = shared(documents.sparkSession, open(vocabulary, "rb").read())

    def flush(ids: list[pa.Array], counts: list[np.ndarray], base: int) -> tuple[pa.RecordBatch, int]:
        doc, start, size = pieces(np.concatenate(counts), capacity)
        bins = pack(size.tolist(), capacity)
        order = np.array([i for b in bins for i in b], dtype=np.int64)
        number = np.repeat(np.arange(len(bins)), [len(b) for b in bins]) + base
        doc, start, size = doc[order], start[order], size[order]
        out = pa.RecordBatch.from_arrays([pa.concat_arrays(ids).take(pa.array(doc)), pa.array(start // capacity), pa.array(start), pa.array(size), pa.array(number)], names=["doc_id", "part", "first_token", "tokens", "sequence"])
        return out, base + len(bins)

    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = K.exact_counter(held.value)
        base = TaskContext.get().partitionId() << 40
        ids, counts, n = [], [], 0
        for b in T.slices(it, "text"):
            ids.append(b.column("doc_id"))
            counts.append(counter(b.column("text")))
            n += b.num_rows
            if n >= block:
                out, base = flush(ids, counts, base)
                yield out
                ids, counts, n = [], [], 0
        if n:
            yield flush(ids, counts, base)[0]

    return documents.select("doc_id", "text").mapInArrow(run, "doc_id long, part long, first_token long, tokens long, sequence long")


def fill(packed: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """Sequences, parts, tokens, capacity used and sequences that are over-full (none)."""
    s = packed.groupBy("sequence").agg(F.count("*").alias("parts"), F.sum("tokens").alias("tokens"))
    return s.agg(F.count("*").alias("sequences"), F.sum("parts").alias("parts"), F.sum("tokens").alias("tokens"), (F.sum("tokens") / (F.count("*") * capacity)).alias("filled"), F.count_if(F.col("tokens") > capacity).alias("over_full"))


def p6_sequences(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sequences(table(spark, sf_dir, "documents", "doc_id", "text"))


def p6_fill(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fill(p6_sequences(spark, sf_dir))

"""Problem 7: evaluation texts inside training documents, by a broadcast hash set of the items' n-grams.

Items that are equal once normalised are one class, whose members are joined to its leaks at the end. The set has two kinds of
n-grams of the classes: runs of RUN words that one class alone has, whose hit is verified word by word, and single words that
(almost) one class alone has, its names and figures, of which a document must hold a good part before it is verified by the longest
common subsequence of item and document window. What classes have in common is counted by a groupBy, and never on the driver.
``cleaned`` takes the verified spans out of the documents.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusloom.llm import textvec as T
from corpusloom.llm.common import shared, table
from corpusloom.sources.checkpoint import checkpointed

#: Consecutive words that are a leak; share of an item's words that, in order, are one.
RUN, HALF = 12, 0.5
#: A word belongs to an item if no more items than this have it; share (and number) of its own words that a leak in pieces has.
OWNERS, OWN_SHARE, OWN_LEAST = 2, 0.35, 4
#: Bytes of item text that are broadcast at once; more items are taken in blocks of this size, each against all documents.
BLOCK_BYTES = 32 << 20
#: A document of whose words at least this share leaked is dropped as a whole, others lose the leaked spans only.
DROP_SHARE = 0.5
_TABLE_BITS = 22


def normal_words(col: pa.Array) -> tuple[T.Words, np.ndarray, T.Codes]:
    """Words of folded texts, the place in the column's own code points of each folded one, and these code points."""
    raw = T.codes(col)
    c = T.take(T.tables()[0], raw.c)
    return T.words(raw.keep(c != 0, c)), np.flatnonzero(c != 0), raw


def _ngrams(w: T.Words, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Hash and first word of each run of n words."""
    h = T.ngram_hash(w.hash, n) if n > 1 else w.hash
    at = np.flatnonzero(w.row[: len(h)] == w.row[n - 1 :]) if len(h) else np.zeros(0, np.int64)
    return h[at], at


class Items:
    """The hash sets of a block of classes: their texts, and the (class, hash) of runs and of words that are their own."""

    def __init__(self, ids: np.ndarray, texts: pa.Array, own_runs: np.ndarray, own_words: tuple[np.ndarray, np.ndarray]):
        w = normal_words(texts)[0]
        self.ids = ids
        self.first, self.hash = w.first, w.hash
        key, at = _ngrams(w, RUN)
        mine = np.isin(key, own_runs)
        self.run_keys, one = np.unique(key[mine], return_index=True)
        self.run_at = at[mine][one]  # its first word
        self.run_item = w.row[self.run_at]
        place = np.argsort(ids)
        item = place[np.searchsorted(ids[place], own_words[0])] if len(own_words[0]) else np.zeros(0, np.int64)
        order = np.argsort(own_words[1], kind="stable")
        self.own_keys, self.own_item = own_words[1][order], item[order]
        self.own_count = np.bincount(self.own_item, minlength=len(ids))
        self.length = np.diff(self.first)
        self.table = np.zeros(1 << _TABLE_BITS, dtype=bool)
        self.table[(np.concatenate([self.run_keys, self.own_keys]) >> np.uint64(64 - _TABLE_BITS)).astype(np.int64)] = True

    def maybe(self, h: np.ndarray) -> np.ndarray:
        """Places whose hash may be in the set; most of the corpus ends here."""
        return np.flatnonzero(self.table[(h >> np.uint64(64 - _TABLE_BITS)).astype(np.int64)])


def classes(benchmark: DataFrame) -> DataFrame:
    """(item_id, class, text) of each item with a word; equal normalised texts have the same class."""

    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in T.slices(it, "text"):
            w = normal_words(b.column("text"))[0]
            start = np.zeros(len(w) + 1, dtype=np.uint64)
            # Order counts: each word's hash is turned by its place.
            np.cumsum(T.mix(w.hash + (np.arange(len(w)) - w.first[w.row]).astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)), out=start[1:])
            key = (start[w.first[1:]] - start[w.first[:-1]]).view(np.int64)
            some = pa.array(np.flatnonzero(np.diff(w.first) > 0))
            yield pa.RecordBatch.from_arrays([b.column("item_id").take(some), pa.array(key).take(some), b.column("text").take(some)], names=["item_id", "class", "text"])

    return benchmark.select(F.col("item_id").cast("long").alias("item_id"), "text").where("text is not null").mapInArrow(run, "item_id long, class long, text string")


def own_ngrams(texts: DataFrame) -> DataFrame:
    """(class, kind, hash) of the runs (kind 1) that one class has alone and of the words (kind 0) that at most OWNERS have."""

    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in T.slices(it, "text"):
            w = normal_words(b.column("text"))[0]
            for kind, n in ((0, 1), (1, RUN)):
                key, at = _ngrams(w, n)
                if len(key):
                    key, row = np.unique(np.stack([key, w.row[at].astype(np.uint64)]), axis=1)
                    yield pa.RecordBatch.from_arrays([b.column("class").take(pa.array(row.astype(np.int64))), pa.array([kind] * len(key), pa.int32()), pa.array(key.view(np.int64))], names=["class", "kind", "hash"])

    n = texts.mapInArrow(run, "class long, kind int, hash long").groupBy("kind", "hash").agg(F.count("*").alias("n"), F.min("class").alias("a"), F.max("class").alias("b"))
    n = n.where((F.col("n") == 1) | ((F.col("kind") == 0) & (F.col("n") <= OWNERS)))
    return n.select(F.explode(F.array_distinct(F.array("a", "b"))).alias("class"), "kind", "hash")


def subsequence(item: np.ndarray, words: np.ndarray) -> int:
    """Length of the longest common subsequence of two sequences of hashes (bit-parallel, a word a step)."""
    masks: dict[int, int] = {}
    for i, h in enumerate(item.tolist()):
        masks[h] = masks.get(h, 0) | (1 << i)
    n = len(item)
    full = (1 << n) - 1
    v = full
    for h in words.tolist():
        m = masks.get(h)
        if m:
            u = v & m
            v = ((v + u) | (v - u)) & full
    return n - v.bit_count()


def extent(item: np.ndarray, words: np.ndarray) -> tuple[int, int]:
    """First and one past the last place in ``words`` of a longest common subsequence with ``item``."""
    most = subsequence(item, words)
    low, high = 0, len(words)
    while low < high:  # the shortest beginning that holds it
        mid = (low + high) // 2
        low, high = (low, mid) if subsequence(item, words[:mid]) == most else (mid + 1, high)
    end = low
    low, high = 0, end
    while low < high:  # the latest start
        mid = (low + high + 1) // 2
        low, high = (mid, high) if subsequence(item, words[mid:end]) == most else (low, mid - 1)
    return low, end


def pieces(items: Items, item: int, h: np.ndarray, every: bool = False) -> list[tuple[int, int]]:
    """Spans of a document's words ``h`` that hold at least half of the item's words in order about one of the item's own words:
    from an item's length before it to twice that after it. Every own word with enough others after it is tried; the first span only,
    unless ``every``, which gives all that don't overlap, each cut down to the words that match."""
    a, b = items.first[item], items.first[item + 1]
    own = items.own_keys[items.own_item == item]
    mine = items.hash[a:b]
    need_own = max(OWN_LEAST, OWN_SHARE * len(own))
    n, size = int(b - a), 2 * int(b - a) + 20
    places = np.flatnonzero(np.isin(h, own))
    # No subsequence is longer than the number of the window's words that the item has.
    inside = np.concatenate([[0], np.cumsum(np.isin(h, mine))])
    s, e = np.maximum(0, places - n), np.minimum(len(h), places + size)
    stop = np.searchsorted(places, places + size)
    out: list[tuple[int, int]] = []
    for k in np.flatnonzero((inside[e] - inside[s] >= HALF * n) & (stop - np.arange(len(places)) >= need_own)).tolist():
        if out and places[k] < out[-1][1] or len(np.unique(h[places[k : stop[k]]])) < need_own:
            continue
        begin = max(int(s[k]), out[-1][1] if out else 0)
        if subsequence(mine, h[begin : e[k]]) >= HALF * n:
            if not every:
                return [(begin, int(e[k]))]
            x, y = extent(mine, h[begin : e[k]])
            out.append((begin + x, begin + y))
    return out


def in_pieces(items: Items, item: int, h: np.ndarray) -> bool:
    """Whether ``pieces`` finds a span."""
    return bool(pieces(items, item, h))


def scan(w: T.Words, items: Items, every: bool = False) -> list[tuple[int, int, int, int]]:
    """(row, item, first word, one past the last) of leaks in the words of a column of texts: one for each row and item, or every span."""
    if not len(w):
        return []
    h = w.hash
    found: list[tuple[int, int, int, int]] = []
    runs = T.ngram_hash(h, RUN)
    if len(runs) and len(items.run_keys):
        at = items.maybe(runs)
        at = at[(w.row[at] == w.row[at + RUN - 1])]
        k = np.minimum(np.searchsorted(items.run_keys, runs[at]), len(items.run_keys) - 1)
        ok = items.run_keys[k] == runs[at]
        at, k = at[ok], k[ok]
        step = np.arange(RUN)
        same = (h[at[:, None] + step] == items.hash[items.run_at[k][:, None] + step]).all(axis=1)  # verified word by word
        at, item = at[same], items.run_item[k[same]]
        order = np.lexsort((at, item, w.row[at]))
        at, item = at[order], item[order]
        new = np.ones(len(at), dtype=bool)
        new[1:] = (w.row[at[1:]] != w.row[at[:-1]]) | (item[1:] != item[:-1]) | (at[1:] > at[:-1] + RUN)
        a = np.flatnonzero(new)
        last = np.append(a[1:], len(at))[: len(a)] - 1
        found += zip(w.row[at[a]].tolist(), item[a].tolist(), at[a].tolist(), (at[last] + RUN).tolist(), strict=True)
    known = {f[:2] for f in found}
    at = items.maybe(h)
    left, right = np.searchsorted(items.own_keys, h[at]), np.searchsorted(items.own_keys, h[at], side="right")
    n = right - left
    at = np.repeat(at, n)
    key = np.repeat(left, n) + np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
    if len(at):
        # Each word of an item counts once for a document.
        row, word = np.unique(np.stack([w.row[at], key]), axis=1)
        pair, count = np.unique(np.stack([row, items.own_item[word]]), axis=1, return_counts=True)
        good = count >= np.maximum(OWN_LEAST, OWN_SHARE * items.own_count[pair[1]])
        for r, i in zip(pair[0][good].tolist(), pair[1][good].tolist(), strict=True):
            if every or (r, i) not in known:
                first = int(w.first[r])
                found += [(r, i, first + a, first + b) for a, b in pieces(items, i, h[first : w.first[r + 1]], every)]
    return found


def _blocks(members: DataFrame, block_bytes: int) -> Iterator[Items]:
    """The classes of ``members`` (item_id, class, text) in blocks of bounded size."""
    texts = checkpointed(members.groupBy("class").agg(F.min_by("text", F.struct("item_id", "text")).alias("text")))
    own = checkpointed(own_ngrams(texts))
    size = texts.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    n = max(1, -(-int(size) // block_bytes))
    mine = F.pmod(F.xxhash64("class"), F.lit(n))
    for i in range(n):
        t = texts.where(mine == i).toArrow()
        if t.num_rows:
            g = own.where(mine == i).toArrow()
            kind, key, cls = g["kind"].to_numpy(), g["hash"].to_numpy().view(np.uint64), g["class"].to_numpy()
            yield Items(t["class"].to_numpy(), t["text"].combine_chunks(), np.unique(key[kind == 1]), (cls[kind == 0], key[kind == 0]))


def leaks(documents: DataFrame, benchmark: DataFrame, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """(doc_id, item_id) of each document that holds a passage of an item.

    ``documents`` has doc_id and text, ``benchmark`` item_id and text; other columns are ignored. Null and blank texts
    on either side match nothing; an item shorter than RUN words can only leak by half of its words; equal items
    are one class and leak together; repeated documents count each; an
    empty table gives no row. The items' size is summed first: up to ``block_bytes`` are broadcast at once, more in
    as many blocks, and each block goes against all documents.
    """
    members = checkpointed(classes(benchmark))
    out = None

    def run(it: Iterator[pa.RecordBatch], items: Items) -> Iterator[pa.RecordBatch]:
        for b in T.slices(it, "text"):
            found = sorted({f[:2] for f in scan(normal_words(b.column("text"))[0], items)})
            if found:
                rows, of = zip(*found, strict=True)
                yield pa.RecordBatch.from_arrays([b.column("doc_id").take(pa.array(rows)), pa.array(items.ids[list(of)])], names=["doc_id", "class"])

    for items in _blocks(members, block_bytes):
        held = shared(documents.sparkSession, items)
        part = documents.select("doc_id", "text").mapInArrow(lambda it, held=held: run(it, held.value), "doc_id long, class long")
        out = part if out is None else out.unionByName(part)
    if out is None:
        return documents.sparkSession.createDataFrame([], "doc_id long, item_id long")
    return out.join(members.select("class", "item_id"), "class").select("doc_id", "item_id")


def cleaned(documents: DataFrame, benchmark: DataFrame, drop_share: float = DROP_SHARE, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """(doc_id, action, words, leaked_words, text): documents without the passages of items.

    ``action`` is ``kept`` (nothing leaked, the text is unchanged, null or not), ``cut`` (the leaked spans and the signs right after them are replaced by one blank each) or
    ``dropped`` (at least ``drop_share`` of the words leaked; the text is null). Every span counts, also a second copy of the same item.
    Blocks of items follow each other in one pass over the documents; nothing is shuffled.
    """
    spans = "array<struct<a:long,b:long>>"
    df = documents.select("doc_id", "text", F.array().cast(spans).alias("spans"))

    def find(it: Iterator[pa.RecordBatch], items: Items) -> Iterator[pa.RecordBatch]:
        for b in T.slices(it, "text"):
            w = normal_words(b.column("text"))[0]
            held = b.column("spans").to_pylist()
            for r, _, a, e in scan(w, items, every=True):
                held[r] = [*held[r], {"a": a - int(w.first[r]), "b": e - int(w.first[r])}]
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), b.column("text"), pa.array(held, b.schema.field("spans").type)], names=["doc_id", "text", "spans"])

    def cut(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in T.slices(it, "text"):
            w, place, raw = normal_words(b.column("text"))
            n = np.diff(w.first)
            lost = np.zeros(b.num_rows, dtype=np.int64)
            action, texts = np.full(b.num_rows, "kept", dtype=object), b.column("text").to_pylist()
            lengths = b.column("spans").value_lengths().to_numpy(zero_copy_only=False)
            for r in np.flatnonzero(lengths).tolist():
                gone = np.zeros(int(n[r]) + 1, dtype=np.int64)
                for x in b.column("spans")[r].as_py():
                    gone[x["a"]] += 1
                    gone[x["b"]] -= 1
                gone = np.cumsum(gone)[:-1] > 0
                lost[r] = gone.sum()
                if lost[r] >= drop_share * n[r]:
                    action[r], texts[r] = "dropped", None
                    continue
                edge = np.flatnonzero(np.diff(np.concatenate([[False], gone, [False]]).astype(np.int8))).reshape(-1, 2) + int(w.first[r])
                text, parts, at = texts[r], [], 0
                for a, e in edge.tolist():
                    parts.append(text[at : int(place[w.start[a]]) - int(raw.start[r])])
                    at = int(place[w.end[e - 1] - 1]) + 1 - int(raw.start[r])
                    while at < len(text) and not text[at].isspace() and not text[at].isalnum():
                        at += 1  # the stop after it
                action[r], texts[r] = "cut", " ".join([*(p.rstrip() for p in parts), text[at:].lstrip()])
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), pa.array(action, pa.string()), pa.array(n), pa.array(lost), pa.array(texts, pa.string())], names=["doc_id", "action", "words", "leaked_words", "text"])

    for items in _blocks(checkpointed(classes(benchmark)), block_bytes):
        held = shared(documents.sparkSession, items)
        df = df.mapInArrow(lambda it, held=held: find(it, held.value), f"doc_id long, text string, spans {spans}")
    return df.mapInArrow(cut, "doc_id long, action string, words long, leaked_words long, text string")


def p7_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return leaks(table(spark, sf_dir, "documents", "doc_id", "text"), table(spark, sf_dir, "benchmark", "item_id", "text"))


def p7_cleaned(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cleaned(table(spark, sf_dir, "documents", "doc_id", "text"), table(spark, sf_dir, "benchmark", "item_id", "text"))

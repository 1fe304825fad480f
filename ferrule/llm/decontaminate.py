"""Benchmark decontamination by SimHash windows of the items' sizes.

For each benchmark item, windows of as many words as the item has are compared with it.  A window's
fingerprint is the 64-bit SimHash of its weighted five-word shingles; fingerprints are looked up in a
multi-index: eight blocks of eight bits, and for each block a table of all items whose block lies within
``radius // 8`` bits, so by the pigeonhole principle every item within ``radius`` is found.  What it
finds is verified exactly: the weighted Jaccard similarity of the shingle multisets, at least
``similarity``.  A shingle weighs log(1 + min(items / items having it, ``RARE``)), counted by Spark over the
whole benchmark.  Shingles that no item or only one has weigh the most, so only those of more items need a table, and
with ``RARE`` at most ``RARE`` times as many shingles as an average item has can be in it, however many items there are.

A window can only be similar if the text holds enough of the item's shingle weight, so windows are
taken only around texts' shingles that occur in an item (looked up for every shingle of every text).
Items are indexed and broadcast in blocks of about ``BLOCK`` items or ``BLOCK_BYTES`` of text, one after the other: a block's
finds are stored before the next is built.  How the items fall into blocks changes no result.  With one block documents
are not shuffled; with more they are joined to the finds by the SHA-256 of their text.

Defined cases: null or empty items match nothing; items with fewer than five words are one shingle,
found where the text has exactly these words in a row; texts shorter than an item are one window;
null and empty texts have no item; repeated items are reported by each of their ids; null item ids
are ignored; rows with a null doc_id are checked like any other, and repeated rows each have their answer; without
items or without documents nothing is found; columns of the documents keep their names, whatever these are.
"""

from __future__ import annotations

import math
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, LongType, StructField, StructType

from ferrule.llm.common import Words, give_back, map_arrow, map_batches, mix, parts, signed, slices, stored

#: Items, and bytes of their texts, that are indexed and broadcast at once, about.
BLOCK = 20_000
BLOCK_BYTES = 1 << 23
SHINGLE = 5
#: Bytes of text handled at once; windows whose SimHashes are taken at once span about so many shingles, or the item's size.
SLICE = 1 << 18
SPAN = 1 << 12
#: Shingles of fewer items than one in ``RARE`` all weigh the same.
RARE = 1000
_BITS = np.uint64(1) << np.arange(64, dtype=np.uint64)


def simhash(shingles: np.ndarray, weights: np.ndarray, starts: np.ndarray, size: int) -> np.ndarray:
    """SimHash of ``size`` consecutive shingles from each start on."""
    sign = np.where(mix(shingles)[:, None] & _BITS, 1.0, -1.0) * weights[:, None]
    total = np.concatenate([np.zeros((1, 64)), np.cumsum(sign, 0)])
    return ((total[starts + size] - total[starts] > 1e-9) * _BITS).sum(1, dtype=np.uint64)


def _sets(column: pa.Array):
    """(row, number of words, shingles) of every text that has words."""
    row = 0
    for a, b, data, off in slices(column, SLICE):
        w = Words(data, off, lower=True)
        h = w.windows(SHINGLE)
        for d in range(b - a):
            s, e = w.first[d], w.first[d + 1]
            if e > s:
                yield row + d, int(e - s), h[s:e - SHINGLE + 1].copy() if e - s >= SHINGLE else np.array([w.span(s, e, salt=int(e - s))])
        row += b - a


class Weights:
    """Weights of shingles, by the number of items (of all blocks) that have them."""

    def __init__(self, items: int, keys: np.ndarray, df: np.ndarray):
        order = np.argsort(keys)
        self.keys, self.most = keys[order], math.log(1 + min(items, RARE))
        self.of_keys = np.log1p(np.minimum(items / df[order], RARE))

    def __call__(self, s: np.ndarray) -> np.ndarray:
        if not len(self.keys):
            return np.full(len(s), self.most)
        at = np.minimum(np.searchsorted(self.keys, s), len(self.keys) - 1)
        return np.where(self.keys[at] == s, self.of_keys[at], self.most)


def _weights(items: DataFrame) -> Weights:
    def count(b):
        every = [np.unique(s) for _, _, s in _sets(b.column(0))]
        if every:
            g, c = np.unique(np.concatenate(every), return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array([None, *signed(g).tolist()], pa.int64()), pa.array([len(every), *c.tolist()], pa.int64())],
                                             ["g", "df"])
    df = map_arrow(items.select("text"), count, "g long, df long").groupBy("g").agg(F.sum("df").alias("df"))
    n = df.filter("g is null").agg(F.coalesce(F.sum("df"), F.lit(0))).first()[0]
    common = df.filter(f"g is not null and df > 1 and df > {n} / {RARE}").toArrow()
    return Weights(n, common["g"].to_numpy().astype(np.int64).view(np.uint64), common["df"].to_numpy())


class _Index:
    """One block of items: shingles by fingerprint, and the multi-index of each item size."""

    def __init__(self, items: list[tuple[int, str]], weight: Weights, similarity: float, radius: int):
        self.weight, self.similarity, self.radius = weight, similarity, radius
        found = list(_sets(pa.array([t for _, t in items], pa.string())))
        self.ids, self.words = [items[row][0] for row, _, _ in found], [m for _, m, _ in found]
        self.sets = sets = [s for _, _, s in found]
        self.keys = np.unique(np.concatenate([np.empty(0, np.uint64), *sets]))
        self.total = [self.weight(s).sum() for s in sets]
        self.holders = defaultdict(list)
        for i, s in enumerate(sets):
            for x in set(s.tolist()):
                self.holders[x].append(i)
        self.bitmap = np.zeros(1 << 20, dtype=bool)
        self.bitmap[(self.keys & np.uint64((1 << 20) - 1)).astype(np.int64)] = True
        self.short = sorted({m for m in self.words if m < SHINGLE})
        near = [v for v in range(256) if v.bit_count() <= radius // 8]
        self.tables: dict[int, tuple[np.ndarray, list[list[list[int]]], np.ndarray]] = {}
        for m in {m for m in self.words if m >= SHINGLE}:
            own = [i for i, x in enumerate(self.words) if x == m]
            prints = np.array([simhash(sets[i], self.weight(sets[i]), np.array([0]), len(sets[i]))[0] for i in own], dtype=np.uint64)
            blocks = [[[] for _ in range(256)] for _ in range(8)]
            for k, f in enumerate(prints.tolist()):
                for b in range(8):
                    for v in near:
                        blocks[b][((f >> (8 * b)) & 255) ^ v].append(k)
            self.tables[m] = (prints, blocks, np.array(own))

    def known(self, h: np.ndarray) -> np.ndarray:
        """Positions of shingles that occur in an item."""
        if not len(self.keys):
            return np.empty(0, np.int64)
        p = np.flatnonzero(self.bitmap[(h & np.uint64((1 << 20) - 1)).astype(np.int64)])
        at = np.minimum(np.searchsorted(self.keys, h[p]), len(self.keys) - 1)
        return p[self.keys[at] == h[p]]

    def similar(self, item: int, window: np.ndarray) -> float:
        """Weighted Jaccard similarity of the multisets."""
        a, b = Counter(self.sets[item].tolist()), Counter(window.tolist())
        keys = np.array(sorted(a.keys() | b.keys()), dtype=np.uint64)
        w = self.weight(keys)
        lo = np.array([min(a[int(k)], b[int(k)]) for k in keys])
        hi = np.array([max(a[int(k)], b[int(k)]) for k in keys])
        return float((lo * w).sum() / (hi * w).sum())

    def matches(self, h: np.ndarray, hits: np.ndarray) -> set[int]:
        """Items found in a text with shingles h, of which those at ``hits`` occur in items."""
        where = defaultdict(list)
        for p in hits.tolist():
            for i in self.holders[int(h[p])]:
                where[i].append(p)
        found: set[int] = set()
        for m, group in _by(where, lambda i: self.words[i]).items():
            if m < SHINGLE:
                continue
            size = m - SHINGLE + 1
            starts: set[int] = set()
            for i in group:
                inside = np.unique(h[where[i]])
                if self.weight(inside).sum() < self.similarity * self._distinct(i):
                    continue                                 # the whole text lacks too much of the item
                for p in where[i]:
                    starts.update(range(max(0, p - size + 1), min(p, max(0, len(h) - size)) + 1))
            if not starts:
                continue
            at = np.array(sorted(starts))
            size = min(size, len(h))
            own, blocks, items = self.tables[m]
            for s, f in self._prints(h, at, size):
                near = {k for b in range(8) for k in blocks[b][(f >> (8 * b)) & 255]}
                for k in near:
                    i = int(items[k])
                    if i not in found and (f ^ int(own[k])).bit_count() <= self.radius and \
                            self.similar(i, h[s:s + size]) >= self.similarity:
                        found.add(i)
        return found

    def _prints(self, h: np.ndarray, at: np.ndarray, size: int):
        """(start, SimHash) of the windows of this size, taken over a part of the text at a time: 64 numbers a shingle."""
        a = 0
        while a < len(at):
            b = int(np.searchsorted(at, at[a] + max(SPAN, size), side="right"))
            part = h[at[a]:at[b - 1] + size]
            yield from zip(at[a:b].tolist(), simhash(part, self.weight(part), at[a:b] - at[a], size).tolist())
            a = b

    def _distinct(self, i: int) -> float:
        """Weight of the item if no shingle repeats in it; else 0: no bound from distinct shingles."""
        return self.total[i] if len(np.unique(self.sets[i])) == len(self.sets[i]) else 0.0


def _by(keys, of):
    out = defaultdict(list)
    for k in keys:
        out[of(k)].append(k)
    return out


def _find(index: _Index, column: pa.Array) -> list[list[int]]:
    """Sorted item ids for each text."""
    out = []
    for a, b, data, off in slices(column, SLICE):
        w = Words(data, off, lower=True)
        h = w.windows(SHINGLE)
        n = np.diff(w.first)
        last = np.repeat(w.first[1:] - SHINGLE, n)                # last start inside the text
        p = index.known(h)
        p = p[p <= last[p]] if len(p) else p
        found: dict[int, set[int]] = defaultdict(set)
        if len(p):
            doc = np.searchsorted(w.first, p, side="right") - 1
            for d in np.unique(doc).tolist():
                s = w.first[d]
                found[d] |= index.matches(h[s:w.first[d + 1] - SHINGLE + 1], p[doc == d] - s)
        for m in index.short:
            g = w.windows(m, salt=m)
            q = index.known(g)
            q = q[q <= np.repeat(w.first[1:] - m, n)[q]] if len(q) else q
            for x in q.tolist():
                found[int(np.searchsorted(w.first, x, side="right") - 1)] |= {
                    i for i in index.holders[int(g[x])] if index.words[i] == m}
        out += [sorted({index.ids[i] for i in found[d]}) if d in found else [] for d in range(b - a)]
    return out


def _blocks(spark: SparkSession, benchmark: DataFrame, similarity: float, radius: int):
    """The broadcast index of each block of items, one at a time."""
    items = stored(spark, benchmark.select(F.col("item_id").cast("long").alias("item_id"), "text").filter(
        "item_id is not null and text is not null").distinct(), "items")
    n, size = items.agg(F.count("*"), F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()
    blocks = max(1, -(-n // BLOCK), -(-size // BLOCK_BYTES))
    weight = _weights(items)
    for k in range(blocks):
        rows = items.filter(F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks)) == k).collect()
        yield k + 1 == blocks, spark.sparkContext.broadcast(_Index([(r.item_id, r.text) for r in rows], weight, similarity, radius))


def with_items(spark: SparkSession, docs: DataFrame, benchmark: DataFrame, text_col: str = "text", out: str = "items",
               similarity: float = 0.8, radius: int = 23) -> DataFrame:
    """``docs`` and one more column: the sorted ids of the benchmark items that its text contains."""
    kind = ArrayType(LongType())
    finds = []
    for last, index in _blocks(spark, benchmark, similarity, radius):
        if last and not finds:
            at = docs.columns.index(text_col)

            def run(batches, index=index):
                for b in batches:
                    if b.num_rows:
                        found = pa.array(_find(index.value, b.column(at)), pa.list_(pa.int64()))
                        yield from parts(pa.RecordBatch.from_arrays([*b.columns, found], [*b.schema.names, out]))
                        del b, found
                        give_back()
            return map_batches(docs, run, StructType([*docs.schema.fields, StructField(out, kind)]))

        def pairs(b, index=index):
            found = _find(index.value, b.column(0))
            hit = [i for i, x in enumerate(found) if x]
            yield pa.RecordBatch.from_arrays([b.column(0).take(pa.array(hit, pa.int64())), pa.array([found[i] for i in hit], pa.list_(pa.int64()))],
                                             ["text", "found"])
        texts = docs.select(F.col(text_col).alias("text"))
        finds.append(stored(spark, map_arrow(texts, pairs, "text string, found array<long>").select(
            F.sha2("text", 256).alias("key"), "found").distinct(), "found"))
        index.destroy()
    every = finds[0]
    for p in finds[1:]:
        every = every.unionAll(p)
    # distinct ids of one text: at most the items
    every = every.select("key", F.explode("found").alias("item")).groupBy("key").agg(F.sort_array(F.collect_set("item")).alias("found"))
    key, names = "key_", docs.columns
    while key in names or key == out:
        key += "_"
    joined = docs.withColumn(key, F.sha2(F.col(text_col), 256)).join(every.select(F.col("key").alias(key), F.col("found").alias(key + "f")), key, "left")
    return joined.select(*names, F.coalesce(F.col(key + "f"), F.array().cast(kind)).alias(out))


def contamination(spark: SparkSession, docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, contaminated, n_items, items) of every row of ``docs``."""
    d = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    return with_items(spark, d, benchmark).select("doc_id", (F.size("items") > 0).alias("contaminated"),
                                                  F.size("items").cast("long").alias("n_items"), "items")


def keep_clean(spark: SparkSession, docs: DataFrame, benchmark: DataFrame, text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that contain no benchmark item."""
    name = "items_"
    while name in docs.columns:
        name += "_"
    return with_items(spark, docs, benchmark, text_col, name).filter(F.size(name) == 0).select(*docs.columns)

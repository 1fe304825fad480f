"""Line dedup: lines that other documents hold too stay only in the document with the smallest id.

Method.  A line's key is the line without white space at its ends, A-Z lower-cased; it is hashed to 128 bits.  One
grouped pass over the hashes finds the keys of two or more documents, the smallest id that holds each and the number of
its lines.  These distinct hashes are dealt into shards of about ``SHARD_KEYS``; each shard is a minimal perfect hash
(levels of bit arrays, the slot is the rank of the key's bit) that indexes flat arrays of fingerprints, counts and
owners.  Documents then probe the arrays with packed lists of their hashes: a hash whose slot holds another fingerprint
is no key of the shard.  No line is joined to a line, and no text leaves its row until the answers come back.

Scale.  A line that a third of all documents hold is one row of each map task when it is counted, and one slot of one
shard.  Its probes are many, so the probes of a shard are dealt over as many tasks as they fill (``PROBES`` each), and
every one of these tasks gets a copy of the shard (about 3 MB).  The driver keeps one integer for each shard, that is
for about 131,000 repeated keys.

Defined cases: a null or empty text is one empty line; keys of fewer than ``min_chars`` code points always stay; rows
that share an id are one document, so lines that only they share stay; rows with a null id are one document too, whose
id comes after all others; equal rows get equal results; an empty table gives an empty one; other columns are not read.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ferrule.llm.common import lists, map_arrow, mix, stored

#: Keys of a shard, about; probes that a task answers with one copy of a shard, about.
SHARD_KEYS = 1 << 17
PROBES = 1 << 18
#: Lines of a document in one row of hashes.
_CHUNK = 1 << 16
_SPACE = b" \t\n\x0b\x0c\r"
_LAST = (1 << 63) - 1


def lines(text: bytes) -> Iterator[bytes]:
    start = 0
    while (end := text.find(b"\n", start)) >= 0:
        yield text[start:end]
        start = end + 1
    yield text[start:]


def key_of(line: bytes, min_chars: int) -> bytes | None:
    """The line's key, or None if it is too short to count."""
    k = line.strip(_SPACE).lower()                    # bytes: only A-Z change
    if len(k) < min_chars or (len(k) < 4 * min_chars and len(k.decode()) < min_chars):
        return None
    return k


class PerfectHash:
    """Slots 0..n-1 for n distinct pairs of uint64; any other pair gets some slot, or -1.

    Each level has two bits for every key that is left; keys alone at their place keep it, the others go on.
    """

    def __init__(self, sizes: np.ndarray, words: np.ndarray, ranks: np.ndarray):
        self.sizes, self.words, self.ranks = sizes, words, ranks

    @staticmethod
    def _place(a: np.ndarray, b: np.ndarray, level: int, size: int) -> np.ndarray:
        salt = np.uint64((0x9E3779B97F4A7C15 * (level + 1)) & 0xFFFFFFFFFFFFFFFF)
        return (mix(a ^ mix(b + salt)) % np.uint64(size)).astype(np.int64)

    @classmethod
    def build(cls, a: np.ndarray, b: np.ndarray) -> PerfectHash:
        sizes, words = [], []
        while len(a):
            size = 64 * -(-2 * len(a) // 64)
            at = cls._place(a, b, len(sizes), size)
            alone = np.bincount(at, minlength=size) == 1
            words.append(np.packbits(alone, bitorder="little").view(np.uint64))
            sizes.append(size)
            left = ~alone[at]
            a, b = a[left], b[left]
        flat = np.concatenate(words) if words else np.empty(0, np.uint64)
        before = np.cumsum(np.bitwise_count(flat), dtype=np.int64) - np.bitwise_count(flat)
        return cls(np.array(sizes, np.int64), flat, before.astype(np.int32))

    def slots(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        out = np.full(len(a), -1, dtype=np.int64)
        open_, base = np.arange(len(a)), 0
        for level, size in enumerate(self.sizes.tolist()):
            at = self._place(a[open_], b[open_], level, size)
            word, bit = base + (at >> 6), (at & 63).astype(np.uint64)
            here = (self.words[word] >> bit) & np.uint64(1) != 0
            w, k = word[here], bit[here]
            below = self.words[w] & ((np.uint64(1) << k) - np.uint64(1))
            out[open_[here]] = self.ranks[w] + np.bitwise_count(below)
            open_, base = open_[~here], base + size // 64
        return out


def _hashed(docs: DataFrame, min_chars: int) -> DataFrame:
    """(row, doc, line, a, b): line numbers and the two halves of the hashes of each document's keys."""
    def run(batch):
        row, doc, text = (batch.column(k) for k in range(3))
        out: list[tuple] = []
        held = 0

        def emit():
            nonlocal held
            n = np.array([len(o[2]) for o in out])
            h = np.frombuffer(b"".join(d for o in out for d in o[3]), dtype="<i8").reshape(-1, 2)
            result = pa.RecordBatch.from_arrays(
                [pa.array([o[0] for o in out], pa.int64()), pa.array([o[1] for o in out], pa.int64()),
                 lists(np.fromiter((x for o in out for x in o[2]), np.int32, int(n.sum())), n),
                 lists(h[:, 0].copy(), n), lists(h[:, 1].copy(), n)], ["row", "doc", "line", "a", "b"])
            out.clear()
            held = 0
            return result

        for i in range(batch.num_rows):
            r, d = row[i].as_py(), doc[i].as_py()
            numbers, hashes = [], []
            for no, line in enumerate(lines(text[i].as_py() or b"")):
                k = key_of(line, min_chars)
                if k is not None:
                    numbers.append(no)
                    hashes.append(xxhash.xxh3_128_digest(k))
                    if len(numbers) == _CHUNK:
                        out.append((r, d, numbers, hashes))
                        yield emit()
                        numbers, hashes = [], []
            if numbers:
                out.append((r, d, numbers, hashes))
                held += len(numbers)
                if held >= _CHUNK:
                    yield emit()
        if out:
            yield emit()
    return map_arrow(docs.select("row", "doc", F.col("text").cast("binary")), run,
                     "row long, doc long, line array<int>, a array<long>, b array<long>")


def _shard_sql(shards: int, col: str = "a") -> str:
    return f"cast(shiftright(shiftrightunsigned({col}, 32) * {shards}L, 32) as int)"


def _shard(a: np.ndarray, shards: int) -> np.ndarray:
    return (((a >> np.uint64(32)) * np.uint64(shards)) >> np.uint64(32)).astype(np.int32)


def _index(keys: DataFrame) -> DataFrame:
    """One row for each shard: its perfect hash and the arrays that it indexes."""
    def run(batches):
        shard, held = None, []

        def emit():
            a, b, n, owner = (np.concatenate(x) for x in zip(*held))
            mph = PerfectHash.build(a, b)
            at = mph.slots(a, b)
            prints, counts, owners = np.empty_like(b), np.empty_like(n), np.empty_like(owner)
            prints[at], counts[at], owners[at] = b, n, owner
            one = [mph.sizes, mph.words.view(np.int64), mph.ranks, prints.view(np.int64), np.minimum(counts, 2**31 - 1).astype(np.int32), owners]
            return pa.RecordBatch.from_arrays([pa.array([shard], pa.int32()), *[lists(x, np.array([len(x)])) for x in one]],
                                              ["shard", "sizes", "words", "ranks", "prints", "counts", "owners"])
        for t in batches:
            s = t.column(0).to_numpy()
            cols = [t.column(1).to_numpy().view(np.uint64), t.column(2).to_numpy().view(np.uint64), t.column(3).to_numpy(), t.column(4).to_numpy()]
            cuts = [0, *(np.flatnonzero(s[1:] != s[:-1]) + 1).tolist(), len(s)]
            for i, j in zip(cuts[:-1], cuts[1:]):
                if j > i:
                    if s[i] != shard and held:
                        yield emit()
                        held = []
                    shard = int(s[i])
                    held.append([c[i:j].copy() for c in cols])
        if held:
            yield emit()
    return (keys.repartition("shard").sortWithinPartitions("shard").select("shard", "a", "b", "n", "owner")
            .mapInArrow(run, "shard int, sizes array<long>, words array<long>, ranks array<int>, prints array<long>, counts array<int>, owners array<long>"))


def _probes(hashed: DataFrame, shards: int, copies: np.ndarray) -> DataFrame:
    """(shard, salt, row, doc, line, a, b): each document's hashes, packed by the shard that they ask."""
    def run(t):
        row, doc = t.column(0).to_numpy(), t.column(1)
        off = t.column(2).offsets.to_numpy().astype(np.int64)
        line, a, b = (t.column(k).flatten().to_numpy() for k in (2, 3, 4))
        who = np.repeat(np.arange(t.num_rows), np.diff(off))
        s = _shard(a.view(np.uint64), shards)
        order = np.lexsort((s, who))
        who, s = who[order], s[order]
        first = np.flatnonzero(np.append(True, (who[1:] != who[:-1]) | (s[1:] != s[:-1]))) if len(s) else np.empty(0, np.int64)
        n = np.diff(np.append(first, len(s)))
        w, sh = who[first], s[first]
        salt = (mix(row[w].view(np.uint64)) % copies[sh].astype(np.uint64)).astype(np.int32)
        yield pa.RecordBatch.from_arrays(
            [pa.array(sh), pa.array(salt), pa.array(row[w]), doc.take(pa.array(w)), lists(line[order], n), lists(a[order], n), lists(b[order], n)],
            ["shard", "salt", "row", "doc", "line", "a", "b"])
    return map_arrow(hashed, run, "shard int, salt int, row long, doc long, line array<int>, a array<long>, b array<long>")


def _answers(index: DataFrame, probes: DataFrame) -> DataFrame:
    """(row, line): the numbers of each row's lines that go, by the arrays of their shards."""
    mph = ["sizes", "words", "ranks", "prints", "counts", "owners"]
    ask = ["row", "doc", "line", "a", "b"]
    both = (index.withColumn("kind", F.lit(0)).unionByName(probes.withColumn("kind", F.lit(1)), allowMissingColumns=True)
            .repartition("shard", "salt").sortWithinPartitions("shard", "salt", "kind").select("shard", "salt", "kind", *mph, *ask))

    def run(batches):
        at, table, prints, counts, owners = None, None, None, None, None
        for t in batches:
            shard, salt, kind = (t.column(k).to_numpy() for k in range(3))
            cuts = np.flatnonzero((shard[1:] != shard[:-1]) | (salt[1:] != salt[:-1]) | (kind[1:] != kind[:-1])) + 1
            cuts = [0, *cuts.tolist(), t.num_rows]
            for i, j in zip(cuts[:-1], cuts[1:]):
                if j == i:
                    continue
                if kind[i] == 0:
                    at = (shard[i], salt[i])
                    sizes, words, ranks, prints, counts, owners = (t.column(3 + k)[i].values.to_numpy().copy() for k in range(6))
                    table, prints = PerfectHash(sizes, words.view(np.uint64), ranks), prints.view(np.uint64)
                elif at == (shard[i], salt[i]):               # else: a shard without keys
                    part = t.slice(i, j - i)
                    row, doc, lists_ = part.column(9), part.column(10).fill_null(_LAST).to_numpy(), part.column(11)
                    size = lists_.value_lengths().to_numpy()
                    line, a, b = (part.column(k).flatten().to_numpy() for k in (11, 12, 13))
                    a, b = a.view(np.uint64), b.view(np.uint64)
                    slot = table.slots(a, b)
                    gone = (slot >= 0) & (prints[slot] == b) & (counts[slot] >= 2) & (owners[slot] < np.repeat(doc, size))
                    n = np.bincount(np.repeat(np.arange(len(size)), size)[gone], minlength=len(size))
                    some = n > 0
                    if some.any():
                        yield pa.RecordBatch.from_arrays([row.filter(pa.array(some)), lists(line[gone], n[some])], ["row", "line"])
    return both.mapInArrow(run, "row long, line array<int>")


def _drop(docs: DataFrame) -> DataFrame:
    def run(t):
        out_text, n_lines, n_gone = [], [], []
        for i in range(t.num_rows):
            text, gone = t.column(1)[i].as_py() or b"", t.column(2)[i]
            n_lines.append(text.count(b"\n") + 1)
            gone = set(gone.values.to_pylist()) if gone.is_valid else ()
            n_gone.append(len(gone))
            out_text.append(b"\n".join(x for k, x in enumerate(lines(text)) if k not in gone) if gone else text)
        yield pa.RecordBatch.from_arrays([t.column(0), pa.array(out_text, pa.binary()).cast(pa.string()), pa.array(n_lines, pa.int64()),
                                          pa.array(n_gone, pa.int64())], ["doc_id", "text", "n_lines", "n_dropped"])
    return map_arrow(docs, run, "doc_id long, text string, n_lines long, n_dropped long")


def dedup_lines(spark: SparkSession, docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_chars: int = 10) -> DataFrame:
    """(doc_id, text, n_lines, n_dropped) for each row: the text without the lines that a smaller id holds."""
    docs = docs.select(F.col(id_col).cast("long").alias("doc"), F.col(text_col).alias("text")).withColumn("row", F.xxhash64("doc", "text"))
    hashed = stored(spark, _hashed(docs, min_chars), "line-hashes")
    each = hashed.select(F.coalesce("doc", F.lit(_LAST)).alias("doc"), F.explode(F.arrays_zip("a", "b")).alias("k"))
    keys = (each.groupBy("k.a", "k.b").agg(F.min("doc").alias("owner"), F.max("doc").alias("last"), F.count("*").alias("n"))
            .filter("owner < last").drop("last"))
    keys = stored(spark, keys, "line-keys")
    shards = max(1, math.ceil(keys.count() / SHARD_KEYS))
    index = stored(spark, _index(keys.withColumn("shard", F.expr(_shard_sql(shards)))), "line-index")
    asked = hashed.select(F.explode("a").alias("a")).groupBy(F.expr(_shard_sql(shards)).alias("shard")).count().collect()
    copies = np.ones(shards, dtype=np.int64)
    for r in asked:
        copies[r["shard"]] = -(-r["count"] // PROBES)
    copy_of = spark.createDataFrame([(s, int(c)) for s, c in enumerate(copies)], "shard int, copies int")
    index = (index.join(F.broadcast(copy_of), "shard").withColumn("salt", F.explode(F.sequence(F.lit(0), F.col("copies") - 1)))
             .drop("copies"))
    gone = stored(spark, _answers(index, _probes(hashed, shards, copies)), "line-answers")
    gone = stored(spark, gone.groupBy("row").agg(F.flatten(F.collect_set("line")).alias("gone")), "lines-gone")
    return _drop(docs.join(gone, "row", "left").select("doc", F.col("text").cast("binary"), "gone"))


def digest(deduped: DataFrame) -> DataFrame:
    return deduped.select("doc_id", "n_lines", "n_dropped", F.sha2("text", 256).alias("kept_sha256"))

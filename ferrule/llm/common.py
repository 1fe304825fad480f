"""Shared helpers: tables, written intermediates, Arrow text access and vectorised word fingerprints.

Words are maximal runs of bytes other than ``\\x20`` and ``\\x09``-``\\x0D`` (UTF-8 never uses those
bytes inside a character, so splitting bytes equals splitting characters).  A word's fingerprint is a
64-bit polynomial over per-byte random values, taken from one prefix sum over the whole batch; a
window's fingerprint is the same construction over word fingerprints.
"""

from __future__ import annotations

import ctypes
import uuid
from collections.abc import Callable, Iterator
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ferrule.session import ensure_checkpoint_dir

#: Bytes of text handled at once inside a task: bounds the temporary arrays (about 60 bytes a byte).
SLICE_BYTES = 1 << 20
#: Bytes of rows that a worker gets at once, or one row.  The executor holds such a batch twice outside its heap (as columns
#: and as a message) and the worker once more, for each task; Spark's own limit is 64 MB.
BATCH_BYTES = 2 << 20
_BATCH = "spark.sql.execution.arrow.maxBytesPerBatch"
#: Rows of whole texts that a task gives back at once.
GIVEN_ROWS = 512

_rng = np.random.default_rng(20240501)
_BYTE = _rng.integers(0, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_SEP = np.zeros(256, dtype=bool)
_SEP[[0x20, 9, 10, 11, 12, 13]] = True
_BASE = {"byte": 0x9E3779B97F4A7C15 | 5, "word": 0xD1342543DE82EF95 | 5}
try:
    _LIBC = ctypes.CDLL("libc.so.6")
    _LIBC.malloc_trim(0)
except (OSError, AttributeError):            # another C library
    _LIBC = None
_POW: dict[str, tuple[np.ndarray, np.ndarray]] = {}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_path(spark: SparkSession, name: str) -> str:
    """A new folder under the shared checkpoint folder."""
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/llm-{name}-{uuid.uuid4().hex[:12]}"


def stored(spark: SparkSession, df: DataFrame, name: str, **options: str) -> DataFrame:
    """Cut the lineage: write to the shared folder as Parquet and read it back."""
    path = shared_path(spark, name)
    df.write.options(**options).parquet(path)
    spark.sparkContext._jvm.System.gc()        # the driver's garbage holds the shuffle files of this write
    return spark.read.schema(df.schema).parquet(path)


def _powers(kind: str, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of an odd base and of its inverse mod 2^64, at least n of them."""
    have = _POW.get(kind)
    if have is None or len(have[0]) < n:
        n = max(n, 1 << 16)
        b = _BASE[kind]
        out = []
        for x in (b, pow(b, -1, 1 << 64)):
            p = np.full(n, x, dtype=np.uint64)
            p[0] = 1
            out.append(np.cumprod(p, dtype=np.uint64))
        have = _POW[kind] = (out[0], out[1])
    return have


def mix(x: np.ndarray) -> np.ndarray:
    """splitmix64 finaliser (a bijection)."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _spans(values: np.ndarray, starts: np.ndarray, ends: np.ndarray, kind: str) -> np.ndarray:
    """Polynomial fingerprints of values[start:end] for each pair."""
    n = len(values)
    p, inv = _powers(kind, n + 1)
    h = np.empty(n + 1, dtype=np.uint64)
    h[0] = 0
    np.cumsum(values * p[:n], out=h[1:])
    return mix((h[ends] - h[starts]) * inv[starts])


class Words:
    """Words of several documents: byte starts/ends, fingerprints and the word range of each one."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray, lower: bool = False):
        self.data = data
        if lower:
            data = _LOWER[data]
        word = ~_SEP[data]
        before = np.empty_like(word)
        before[:1] = False
        before[1:] = word[:-1]
        after = np.empty_like(word)
        after[-1:] = False
        after[:-1] = word[1:]
        inner = offsets[(offsets > 0) & (offsets < len(data))]
        before[inner] = False
        after[inner - 1] = False
        self.starts = np.flatnonzero(word & ~before)
        self.ends = np.flatnonzero(word & ~after) + 1
        self.first = np.searchsorted(self.starts, offsets)      # word range of document d: first[d]:first[d+1]
        self.hash = _spans(_BYTE[data], self.starts, self.ends, "byte") if len(data) else np.empty(0, np.uint64)

    def windows(self, k: int, salt: int = 0) -> np.ndarray:
        """Fingerprint of the k words from each word on (the last k-1 are meaningless)."""
        n = len(self.hash)
        s = np.arange(n)
        return _spans(self.hash + np.uint64(salt), s, np.minimum(s + k, n), "word")

    def span(self, a: int, b: int, salt: int = 0) -> np.uint64:
        return _spans(self.hash[a:b] + np.uint64(salt), np.array([0]), np.array([b - a]), "word")[0]

    def text(self, a: int, b: int) -> bytes:
        """Words a..b joined by one space."""
        d = self.data
        return b" ".join([d[s:e].tobytes() for s, e in zip(self.starts[a:b], self.ends[a:b])])


def slices(column: pa.Array, limit: int = SLICE_BYTES) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(row from, row to, bytes, offsets) of a string column, at most ``limit`` bytes or one row at once.
    Null counts as empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.null_count:
        column = column.fill_null("")
    if not len(column):
        return
    wide = pa.types.is_large_string(column.type)
    off = np.frombuffer(column.buffers()[1], dtype=np.int64 if wide else np.int32)
    off = off[column.offset:column.offset + len(column) + 1].astype(np.int64)
    buf = column.buffers()[2]
    data = np.frombuffer(buf, dtype=np.uint8) if buf is not None and buf.size else np.empty(0, np.uint8)
    a = 0
    while a < len(column):
        b = max(a + 1, int(np.searchsorted(off, off[a] + limit, side="right")) - 1)
        yield a, b, data[off[a]:off[b]], off[a:b + 1] - off[a]
        a = b


def signed(x: np.ndarray) -> np.ndarray:
    return x.astype(np.uint64).view(np.int64)


def lists(values: np.ndarray, counts: np.ndarray) -> pa.ListArray:
    off = np.zeros(len(counts) + 1, dtype=np.int32)
    np.cumsum(counts, out=off[1:])
    return pa.ListArray.from_arrays(pa.array(off), pa.array(values))


def give_back() -> None:
    """Return freed memory to the system: workers outlive their task, and several of them share an executor."""
    pa.default_memory_pool().release_unused()
    if _LIBC is not None:
        _LIBC.malloc_trim(0)


def parts(b: pa.RecordBatch, rows: int = GIVEN_ROWS) -> Iterator[pa.RecordBatch]:
    """The batch a few rows at a time, not copied: the executor reads each batch that a task gives back as a whole."""
    for a in range(0, b.num_rows, rows):
        yield b.slice(a, rows)


def map_batches(df: DataFrame, fn: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]], schema) -> DataFrame:
    """mapInArrow with batches of ``BATCH_BYTES``; a session that sets Spark's limit itself keeps its own.

    Spark reads the limit from the session when the rows are made, so it is set there and stays set.
    """
    conf = df.sparkSession.conf
    if conf.get(_BATCH, None) is None:
        conf.set(_BATCH, str(BATCH_BYTES))
    return df.mapInArrow(fn, schema)


def map_arrow(df: DataFrame, fn: Callable[[pa.RecordBatch], Iterator[pa.RecordBatch]], schema: str) -> DataFrame:
    """map_batches with one function call per batch."""
    def run(batches):
        for b in batches:
            if b.num_rows:
                yield from fn(b)
                del b
                give_back()
    return map_batches(df, run, schema)


def crc_mod(col, n: int):
    """crc32 of the id as text, mod n (null id: null)."""
    return F.crc32(col.cast("string").cast("binary")) % F.lit(n)


class UnitCache:
    """Token ids of text units by the unit's fingerprint, in flat arrays; emptied when full."""

    def __init__(self, dtype, limit: int):
        self.dtype, self.limit = np.dtype(dtype), limit
        self.clear()

    def clear(self) -> None:
        self.slot: dict[int, int] = {}
        self.start, self.count = np.empty(1 << 16, np.int64), np.empty(1 << 16, np.int64)
        self.flat, self.used = np.empty(1 << 18, self.dtype), 0

    def add(self, keys: list[int], counts: np.ndarray, ids: np.ndarray) -> None:
        n, m = len(self.slot), len(keys)
        while n + m > len(self.start):
            self.start, self.count = np.resize(self.start, 2 * len(self.start)), np.resize(self.count, 2 * len(self.count))
        while self.used + len(ids) > len(self.flat):
            self.flat = np.resize(self.flat, 2 * len(self.flat))
        self.start[n:n + m] = self.used + np.cumsum(counts) - counts
        self.count[n:n + m] = counts
        self.flat[self.used:self.used + len(ids)] = ids
        self.used += len(ids)
        self.slot.update(zip(keys, range(n, n + m)))

    def find(self, keys: list[int]) -> np.ndarray:
        """Slots, -1 where unknown; call before ``add`` of a batch's units."""
        if len(self.slot) + len(keys) > self.limit and self.slot:
            self.clear()
        return np.fromiter(map(self.slot.get, keys, repeat(-1)), np.int64, len(keys))

    def gather(self, slots: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(ids of the units one after the other, where each unit begins and the last ends)."""
        count = self.count[slots]
        at = np.concatenate([[0], np.cumsum(count)])
        return self.flat[np.repeat(self.start[slots] - at[:-1], count) + np.arange(at[-1])], at


class Membership:
    """A bitmap of hashed values: ``in`` for all that were put in, and for a few others.

    Built by grouped bit_or, so only the words of the bitmap reach the driver: at most ``2**most`` bits.
    """

    def __init__(self, values: DataFrame, least: int = 16, most: int = 25):
        name = values.columns[0]
        n = values.agg(F.count("*")).first()[0]
        self.bits = min(most, max(least, (16 * n).bit_length()))
        # the place is computed the same way in ``mask``: signed shift and mask of the mixed value
        words = map_arrow(values.select(F.col(name).cast("long").alias("v")), self._places, "w long, m long")
        words = words.groupBy("w").agg(F.expr("bit_or(m)").alias("m")).toArrow()
        table = np.zeros(1 << (self.bits - 6), dtype=np.uint64)
        table[words.column("w").to_numpy()] = words.column("m").to_numpy().view(np.uint64)
        self.table = values.sparkSession.sparkContext.broadcast(table)

    def _at(self, v: np.ndarray) -> np.ndarray:
        return (mix(v.view(np.uint64) + np.uint64(0x51ED270B)) >> np.uint64(64 - self.bits)).astype(np.int64)

    def _places(self, b: pa.RecordBatch):
        at = np.unique(self._at(b.column(0).drop_null().to_numpy()))
        w, first = np.unique(at >> 6, return_index=True)
        if len(w):
            m = np.bitwise_or.reduceat(np.uint64(1) << (at & 63).astype(np.uint64), first)
            yield pa.RecordBatch.from_arrays([pa.array(w), pa.array(signed(m))], ["w", "m"])

    def __getstate__(self):
        return {"bits": self.bits, "table": self.__dict__.get("table")}

    def mask(self, v: np.ndarray) -> np.ndarray:
        """Which of the values (int64) may be members; for use inside tasks."""
        at = self._at(v)
        return (self.table.value[at >> 6] >> (at & 63).astype(np.uint64)) & np.uint64(1) != 0

    def rows(self, df: DataFrame) -> DataFrame:
        """Rows of ``df`` whose first column (a long) may be a member; nulls are none."""
        def run(b):
            v = b.column(0)
            keep = self.mask(v.fill_null(0).to_numpy()) & v.is_valid().to_numpy(zero_copy_only=False)
            if keep.any():
                yield from parts(b.filter(pa.array(keep)))
        return map_arrow(df, run, df.schema)

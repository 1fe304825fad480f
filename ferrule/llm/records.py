"""Token-ID output as length-delimited binary records, with an offset index for shuffled reads.

A shard ``part-PPPPP-RRR.rec`` is a sequence of frames in ascending doc_id order:

    uint64 length | uint32 masked crc32 of the 8 length bytes | payload | uint32 masked crc32 of the payload

all little-endian, where masked(c) = ((c >> 15 | c << 17) + 0xa282ead8) mod 2^32, and the payload is int64
doc_id, uint8 null flag of the id, uint8 bytes per token (2 or 4), then the token ids.  Beside it ``.idx``
holds one (int64 frame offset, int64 tokens before it in the shard) pair for each frame and a last pair for the
end, so any record can be read alone.  The manifest (a Parquet table) names the shards in order.

Tasks own one range of doc_id each (rows of one id are dealt further by a hash of the text), write under
a name of their attempt and rename at the end: a task that runs again replaces its own shard.  Shards
are cut at ``SHARD_BYTES``; a task holds a few megabytes at once.

Encoding.  White space before a word belongs to the unit "white space + word", which the byte-level
pre-tokenizer always splits from what precedes it; so does it an ASCII punctuation mark (no apostrophe) after a letter
or digit, where a further unit begins.  Each distinct unit is encoded by the tokenizers library and remembered in the
worker.  Texts where that does not hold (Unicode white space, special tokens) are encoded whole.

Defined cases: null and empty texts are records with the end id only; a null doc_id comes first; rows that
share an id are separate records, in the order of a hash of their texts; an empty table has no shard; other columns are not read.
"""

from __future__ import annotations

import os
import re
import struct
import zlib

import numpy as np
import pyarrow as pa
from pyarrow import fs as pafs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ferrule.llm.common import _BYTE, _SEP, UnitCache, _spans, shared_path, slices, stored

SHARD_BYTES = 64 << 20
#: Distinct units remembered by a worker.
CACHE_UNITS = 800_000
_SLICE = 2 << 20
_HEAD = struct.Struct("<QI")
_BODY = struct.Struct("<qBB")
_CRC = struct.Struct("<I")
#: Characters that the pre-tokenizer takes for white space and a split at ASCII white space does not, in UTF-8 as numbers
#: of three bytes, by the number of bytes that count.
_ODD_SPACE: dict[int, list[int]] = {1: [], 2: [], 3: []}
for _c in (chr(c) for c in range(0x3001)):
    _b = _c.encode("utf-8", "surrogatepass")
    if _c.isspace() and not _SEP[_b[0]]:
        _ODD_SPACE[len(_b)].append(int.from_bytes(_b, "big"))
_ODD_FIRST = np.zeros(256, dtype=bool)
_ODD_FIRST[[c >> 8 * (n - 1) for n, group in _ODD_SPACE.items() for c in group]] = True
#: ASCII punctuation at which a unit may begin; the apostrophe may belong to what precedes it.
_MARK = np.zeros(256, dtype=bool)
_MARK[[c for c in range(0x21, 0x7F) if not chr(c).isalnum() and c != 0x27]] = True
_ALNUM = np.zeros(256, dtype=bool)
_ALNUM[[c for c in range(0x80) if chr(c).isalnum()]] = True
#: Second bytes of the letters that UTF-8 writes as C3 and one byte more.
_LATIN = np.zeros(256, dtype=bool)
_LATIN[[c for c in range(0x80, 0xC0) if chr(c + 0x40).isalpha()]] = True
#: A unit that ends before any mark: set before units that begin with one, which a join would add to the unit before.
_GUARD = b" a"


def _odd_spaces(data: np.ndarray) -> np.ndarray:
    """Where such a character begins."""
    at = np.flatnonzero(_ODD_FIRST[data])
    code = np.zeros(len(at), dtype=np.int64)
    odd = np.zeros(len(at), dtype=bool)
    for n in (1, 2, 3):
        code = code << 8 | data[np.minimum(at + n - 1, len(data) - 1)]
        odd |= np.isin(code, _ODD_SPACE[n])
    return at[odd]


def masked(data: bytes) -> int:
    c = zlib.crc32(data)
    return (((c >> 15) | (c << 17)) + 0xA282EAD8) & 0xFFFFFFFF


def frame(body: bytes) -> bytes:
    size = struct.pack("<Q", len(body))
    return size + _CRC.pack(masked(size)) + body + _CRC.pack(masked(body))


def unframe(read) -> bytes | None:
    """The next payload, by a function that reads n bytes; None at the end."""
    head = read(_HEAD.size)
    if not head:
        return None
    size, crc = _HEAD.unpack(head)
    if masked(head[:8]) != crc:
        raise ValueError("a record's length is damaged")
    body = read(size)
    if len(body) != size or masked(body) != _CRC.unpack(read(4))[0]:
        raise ValueError("a record is damaged")
    return body


def payload(doc: int | None, ids: np.ndarray) -> bytes:
    return _BODY.pack(doc or 0, doc is None, ids.dtype.itemsize) + ids.tobytes()


def parse(body: bytes) -> tuple[int | None, np.ndarray]:
    doc, null, width = _BODY.unpack_from(body)
    return None if null else doc, np.frombuffer(body, dtype=f"<u{width}", offset=_BODY.size)


class UnitEncoder:
    """Token ids of texts by a byte-level BPE tokenizer file, each distinct unit encoded once."""

    def __init__(self, path: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self.tok = Tokenizer.from_file(path)
        self.special = [t.content.encode() for t in self.tok.get_added_tokens_decoder().values()]
        size = self.tok.get_vocab_size()
        self.dtype = np.dtype("<u2") if size <= 1 << 16 else np.dtype("<u4")
        self.width = np.zeros(size, dtype=np.int64)              # bytes of text behind each id
        for t, i in self.tok.get_vocab().items():
            self.width[i] = len(t)                               # one character for each byte
        self.units = UnitCache(self.dtype, CACHE_UNITS)

    def _ids(self, units: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """(number of ids of each unit, all ids) of units that the pre-tokenizer splits from one another."""
        ids = np.array(self.tok.encode_batch_fast([b"".join(units).decode("utf-8")], add_special_tokens=False)[0].ids, dtype=np.int64)
        ends = np.searchsorted(np.cumsum(self.width[ids]), np.cumsum([len(u) for u in units]), side="left") + 1
        return np.diff(ends, prepend=0), ids

    def _learn(self, hashes: list[int], units: list[bytes], guarded: bool = False) -> None:
        if guarded:
            counts, ids = self._ids([x for u in units for x in (_GUARD, u)])
            unit = np.arange(len(counts)) % 2 == 1
            self.units.add(hashes, counts[unit], ids[np.repeat(unit, counts)])
        else:
            self.units.add(hashes, *self._ids(units))

    def encode(self, data: np.ndarray, off: np.ndarray) -> list[np.ndarray]:
        """Ids of each text of a slice."""
        raw = data.tobytes()
        odd = set(_odd_spaces(data).tolist())
        for s in self.special:
            odd.update(m.start() for m in re.finditer(re.escape(s), raw))
        whole = {int(np.searchsorted(off, p, side="right")) - 1 for p in odd}
        out: list[np.ndarray] = []
        if len(data):
            sep = _SEP[data]
            first = sep.copy()
            first[1:] &= ~sep[:-1]
            first[off[:-1][off[:-1] < len(data)]] = True
            letter = _ALNUM[data]
            letter[1:] |= _LATIN[data[1:]] & (data[:-1] == 0xC3)
            first[1:] |= _MARK[data[1:]] & letter[:-1]
            s = np.flatnonzero(first)
            e = np.append(s[1:], len(data))
            h, at, inv = np.unique(_spans(_BYTE[data], s, e, "byte"), return_index=True, return_inverse=True)
            keys = h.tolist()
            slot = self.units.find(keys)
            new = np.flatnonzero(slot < 0)
            if len(new):
                # units that begin with white space or a mark and end as words do are encoded in one string; the others alone
                strange = inv[np.searchsorted(s, list(odd), side="right") - 1] if odd else np.empty(0, np.int64)
                begin, joins = data[s[at[new]]], ~sep[e[at[new]] - 1] & ~np.isin(new, strange)
                space, mark = joins & _SEP[begin], joins & _MARK[begin]
                for some, guarded in ((new[space], False), (new[mark], True)):
                    for a in range(0, len(some), 4096):
                        part = some[a:a + 4096].tolist()
                        self._learn([keys[k] for k in part], [raw[s[at[k]]:e[at[k]]] for k in part], guarded)
                for k in new[~space & ~mark].tolist():
                    self._learn([keys[k]], [raw[s[at[k]]:e[at[k]]]])
                slot[new] = [self.units.slot[keys[k]] for k in new.tolist()]
            ids, total = self.units.gather(slot[inv])
            bound = total[np.searchsorted(s, off)]
        else:
            ids, bound = np.empty(0, self.dtype), np.zeros(len(off), np.int64)
        for d in range(len(off) - 1):
            if d in whole:
                text = raw[off[d]:off[d + 1]].decode("utf-8")
                out.append(np.array(self.tok.encode(text, add_special_tokens=False).ids, dtype=self.dtype))
            else:
                out.append(ids[bound[d]:bound[d + 1]])
        return out


_ENCODERS: dict[str, UnitEncoder] = {}


def _encoder(path: str) -> UnitEncoder:
    if path not in _ENCODERS:
        _ENCODERS[path] = UnitEncoder(path)
    return _ENCODERS[path]


class _Shards:
    """Shards of one task."""

    def __init__(self, root: str, part: int, attempt: int):
        self.fs, self.root = pafs.FileSystem.from_uri(root)
        self.part, self.attempt, self.roll, self.file = part, attempt, 0, None

    def _name(self, ext: str, tmp: bool = False) -> str:
        return f"{self.root}/part-{self.part:05d}-{self.roll:03d}{ext}" + (f".{self.attempt}.tmp" if tmp else "")

    def add(self, body: bytes, tokens: int):
        if self.file is None:
            self.file = self.fs.open_output_stream(self._name(".rec", True), buffer_size=1 << 20)
            self.index, self.at, self.tokens = [], 0, 0
        self.index.append((self.at, self.tokens))
        f = frame(body)
        self.file.write(f)
        self.at += len(f)
        self.tokens += tokens
        return self.close() if self.at >= SHARD_BYTES else None

    def close(self):
        """(part, roll, file, records, tokens, bytes) of the shard that ends here."""
        if self.file is None:
            return None
        self.file.close()
        self.file = None
        index = np.array([*self.index, (self.at, self.tokens)], dtype="<i8").tobytes()
        with self.fs.open_output_stream(self._name(".idx", True)) as f:
            f.write(frame(index))
        for ext in (".rec", ".idx"):
            self.fs.move(self._name(ext, True), self._name(ext))
        done = (self.part, self.roll, os.path.basename(self._name("")), len(self.index), self.tokens, self.at)
        self.roll += 1
        return done


def _manifest(rows) -> pa.RecordBatch:
    kinds = (pa.int32(), pa.int32(), pa.string(), pa.int64(), pa.int64(), pa.int64())
    return pa.RecordBatch.from_arrays([pa.array([r[k] for r in rows], t) for k, t in enumerate(kinds)],
                                      ["part", "roll", "name", "records", "tokens", "bytes"])


def write_tokens(spark: SparkSession, docs: DataFrame, root: str, tokenizer: str, id_col: str = "doc_id", text_col: str = "text",
                 end_id: int = 2) -> DataFrame:
    """Write the shards under ``root`` (a folder that all executors reach); the stored manifest."""
    scheme_fs, path = pafs.FileSystem.from_uri(root)
    scheme_fs.create_dir(path, recursive=True)

    def run(batches):
        task = TaskContext.get()
        out = _Shards(root, task.partitionId(), task.taskAttemptId())
        enc = _encoder(tokenizer)
        end = np.array([end_id], dtype=enc.dtype)
        done = []
        for b in batches:
            ids = b.column(0).to_pylist()
            for a, z, data, off in slices(b.column(1), _SLICE):
                for d, x in zip(ids[a:z], enc.encode(data, off)):
                    done.append(out.add(payload(d, np.concatenate([x, end])), len(x) + 1))
        done = [x for x in [*done, out.close()] if x]
        if done:
            yield _manifest(done)
    rows = (docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text")).withColumn("h", F.xxhash64("text"))
            .repartitionByRange("id", "h").sortWithinPartitions("id", "h", "text").select("id", "text"))
    return stored(spark, rows.mapInArrow(run, "part int, roll int, name string, records long, tokens long, bytes long"), "manifest")


def read_tokens(spark: SparkSession, root: str, manifest: DataFrame) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32) of every record, from the files: checksums are verified.

    The manifest has a row for each shard; only these are collected, to number the shards' first tokens.
    """
    shards, start = [], 0
    for r in sorted(manifest.collect(), key=lambda r: (r.part, r.roll)):
        shards.append((r.name, start))
        start += r.tokens

    def run(batches):
        f, path = pafs.FileSystem.from_uri(root)
        for b in batches:
            for name, first in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                out = []
                with f.open_input_stream(f"{path}/{name}.rec", buffer_size=4 << 20) as s:
                    while (body := unframe(s.read)) is not None:
                        doc, ids = parse(body)
                        out.append((doc, first, len(ids), zlib.crc32(ids.astype("<u4").tobytes())))
                        first += len(ids)
                yield pa.RecordBatch.from_arrays([pa.array([x[k] for x in out], pa.int64()) for k in range(4)],
                                                 ["doc_id", "start", "n_tokens", "ids_crc32"])
    if not shards:
        return spark.createDataFrame([], "doc_id long, start long, n_tokens long, ids_crc32 long")
    return (spark.createDataFrame(shards, "name string, first long").repartition(len(shards), "name")
            .mapInArrow(run, "doc_id long, start long, n_tokens long, ids_crc32 long"))


def read_record(root: str, name: str, k: int) -> tuple[int | None, np.ndarray]:
    """Record k of a shard (doc_id, ids), by its index alone: the shuffled read."""
    f, path = pafs.FileSystem.from_uri(root)
    with f.open_input_file(f"{path}/{name}.idx") as s:
        index = np.frombuffer(unframe(s.read), dtype="<i8").reshape(-1, 2)
    with f.open_input_file(f"{path}/{name}.rec") as s:
        s.seek(int(index[k, 0]))
        return parse(unframe(s.read))


def token_records(spark: SparkSession, docs: DataFrame, tokenizer: str) -> DataFrame:
    """Write ``docs`` and read the files back: (doc_id, start, n_tokens, ids_crc32)."""
    root = shared_path(spark, "records")
    return read_tokens(spark, root, write_tokens(spark, docs, root, tokenizer))

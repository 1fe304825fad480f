"""SentencePiece encoding and decoding by suffix-array matching.

A batch's distinct units (a run of word marks and what follows up to the next) are concatenated and
indexed by a suffix array over the first ``longest piece`` characters.  Every piece of the vocabulary is
looked up there by binary search; its range of suffixes gives all its occurrences, that is, the edges
from position to position + length.  The edges sorted by position form the lattice that is then
relaxed.  The model is a BPE one, so relaxing follows its rule and not a best path: of all edges that span two
neighbouring symbols, the one with the best score, leftmost first, joins them, until none is left.
Characters without a piece become byte pieces (or the unknown piece if the model has none).

Only models that leave the text as it is but for a word mark in front and for spaces, and whose pieces
hold no mark after another character, are accepted; others raise ValueError.

Defined cases: null text encodes like an empty one, as no ids; decoding no ids gives an empty text; a word mark
(U+2581) in the text decodes as a space; units longer than ``LONG`` characters are relaxed one at a time;
repeated rows each have their ids, an empty table has none, and other columns are not read.
"""

from __future__ import annotations

import heapq

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ferrule.llm.common import UnitCache, _spans, lists, map_arrow, mix

MARK = "▁"
LONG = 256
CACHE_UNITS = 400_000
#: Characters of text handled at once inside a task.
SLICE_CHARS = 250_000
#: Characters of new units indexed by one suffix array (about 250 bytes each).
INDEX_CHARS = 64_000
_NONE = np.int32(2 ** 31 - 1)


class Pieces:
    """A vocabulary and its encoder and decoder."""

    def __init__(self, path: str):
        import sentencepiece

        sp = sentencepiece.SentencePieceProcessor(model_file=path)
        ids = range(sp.get_piece_size())
        normal = [i for i in ids if not (sp.is_byte(i) or sp.is_control(i) or sp.is_unknown(i) or sp.is_unused(i))]
        text = {i: sp.id_to_piece(i) for i in normal}
        if any(MARK in p.lstrip(MARK) for p in text.values()) or sp.encode("a  b Ａ ", out_type=str)[0][:1] != MARK \
                or sp.decode(sp.encode("a  b Ａ ")) != "a  b Ａ ":
            raise ValueError("the model normalises text or has pieces across words")
        order = sorted(normal, key=lambda i: (-sp.get_score(i), i))
        self.of_rank = np.array(order, dtype=np.int32)           # piece id by rank of its score
        self.longest = max(map(len, text.values()))
        self.kind = f"U{self.longest}"
        names = sorted((text[i], r) for r, i in enumerate(order))
        self.low = np.array([n for n, _ in names], dtype=self.kind)
        self.high = np.array([n + "\U0010ffff" for n, _ in names], dtype=f"U{self.longest + 1}")
        self.rank = np.array([r for _, r in names], dtype=np.int32)
        self.length = np.array([len(n) for n, _ in names])
        bytes_of = {bytes([b]): i for b in range(256) for i in [sp.piece_to_id(f"<0x{b:02X}>")] if sp.is_byte(i)}
        self.fallback = (lambda c: [bytes_of[bytes([b])] for b in c.encode("utf-8", "surrogatepass")]) if len(bytes_of) == 256 \
            else (lambda c: [sp.unk_id()])
        raw = [b""] * len(ids)
        for i, p in text.items():
            raw[i] = p.replace(MARK, " ").encode()
        for b, i in bytes_of.items():
            raw[i] = b
        self.raw = np.frombuffer(b"".join(raw), dtype=np.uint8)
        self.raw_size = np.array([len(b) for b in raw], dtype=np.int64)
        self.raw_at = np.cumsum(self.raw_size) - self.raw_size
        self.units = UnitCache(np.int32, CACHE_UNITS)

    # --- the suffix array and its edges ---

    def _suffixes(self, cp: np.ndarray) -> np.ndarray:
        """Positions in the order of their next ``longest`` characters."""
        rank = np.unique(cp, return_inverse=True)[1].astype(np.int64)
        k, n = 1, len(cp)
        while k < self.longest:
            key = rank * (n + 1)
            key[:n - k] += rank[k:] + 1
            rank = np.unique(key, return_inverse=True)[1].astype(np.int64)
            k *= 2
        return np.argsort(rank, kind="stable")

    def _edges(self, cp: np.ndarray) -> np.ndarray:
        """Best rank of a piece by start and length (column 0 unused)."""
        order = self._suffixes(cp)
        n = len(cp)
        wide = np.zeros(n + self.longest + 1, dtype=np.uint32)
        wide[:n] = cp
        view = np.lib.stride_tricks.sliding_window_view(wide, self.longest)[:n]
        keys = np.ascontiguousarray(view[order]).view(self.kind).ravel()
        first = np.searchsorted(keys, self.low, side="left")
        last = np.searchsorted(keys.astype(self.high.dtype) if self.longest < 2 else keys, self.high, side="left")
        count = last - first
        at = np.cumsum(count) - count
        start = order[np.repeat(first - at, count) + np.arange(count.sum())]
        piece = np.repeat(np.arange(len(count)), count)
        by = np.argsort(start, kind="stable")                    # edges by position
        start, piece = start[by], piece[by]
        edges = np.full((n, self.longest + 1), _NONE, dtype=np.int32)
        edges[start, self.length[piece]] = self.rank[piece]
        return edges

    # --- relaxing ---

    def _relax(self, edges: np.ndarray, first: np.ndarray, size: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(start, length) of the symbols of all units, by position."""
        done_s, done_e = [], []
        for f, m in zip(first[size > LONG].tolist(), size[size > LONG].tolist()):
            s, e = self._relax_one(edges, f, m)
            done_s.append(s)
            done_e.append(e)
        first, size = first[size <= LONG], size[size <= LONG]
        unit = np.repeat(np.arange(len(first)), size)
        s = np.repeat(first - (np.cumsum(size) - size), size) + np.arange(size.sum())
        e = s + 1
        while len(s):
            rank = np.full(len(s), _NONE, dtype=np.int32)
            reach = e[1:] - s[:-1]
            pair = np.flatnonzero((unit[1:] == unit[:-1]) & (reach <= self.longest))
            rank[pair] = edges[s[pair], reach[pair]]
            head = np.flatnonzero(np.diff(unit, prepend=-1))
            best = np.minimum.reduceat(rank, head)
            each = np.repeat(best, np.diff(np.append(head, len(s))))
            open_ = each != _NONE
            done_s.append(s[~open_])
            done_e.append(e[~open_])
            s, e, unit, rank, each = s[open_], e[open_], unit[open_], rank[open_], each[open_]
            if not len(s):
                break
            hit = np.flatnonzero(rank == each)
            hit = hit[np.diff(unit[hit], prepend=-1) != 0]       # the leftmost of each unit
            e[hit] = e[hit + 1]
            keep = np.ones(len(s), dtype=bool)
            keep[hit + 1] = False
            s, e, unit = s[keep], e[keep], unit[keep]
        s, e = np.concatenate(done_s or [np.empty(0, np.int64)]), np.concatenate(done_e or [np.empty(0, np.int64)])
        by = np.argsort(s)
        return s[by], e[by] - s[by]

    def _relax_one(self, edges: np.ndarray, first: int, size: int) -> tuple[np.ndarray, np.ndarray]:
        """The same for one long unit, with an agenda of edges."""
        end = {p: p + 1 for p in range(first, first + size)}
        before = {p + 1: p for p in end}
        agenda: list[tuple[int, int, int]] = []

        def offer(p):
            q = end.get(p)
            z = end.get(q)
            if z is not None and z - p <= self.longest and edges[p, z - p] != _NONE:
                heapq.heappush(agenda, (int(edges[p, z - p]), p, z))
        for p in range(first, first + size - 1):
            offer(p)
        while agenda:
            _, p, z = heapq.heappop(agenda)
            q = end.get(p)
            if q is None or q == z or end.get(q) != z:
                continue
            del end[q]
            end[p], before[z] = z, p
            offer(p)
            if p in before and before[p] in end and end[before[p]] == p:
                offer(before[p])
        s = np.array(sorted(end))
        return s, np.array([end[p] for p in s.tolist()])

    # --- texts ---

    def _learn(self, keys: list[int], units: list[np.ndarray]) -> None:
        size = np.array([len(u) for u in units])
        cp = np.zeros(int(size.sum()) + len(units), dtype=np.uint32)
        first = np.cumsum(size + 1) - size - 1                   # a zero after each unit
        cp[np.repeat(first - (np.cumsum(size) - size), size) + np.arange(size.sum())] = np.concatenate(units)
        edges = self._edges(cp)
        s, length = self._relax(edges, first, size)
        rank = edges[s, length]
        known = rank != _NONE
        unit = np.searchsorted(first, s, side="right") - 1
        ids = np.where(known, self.of_rank[np.where(known, rank, 0)], -1)
        width = np.ones(len(s), dtype=np.int64)
        strange = np.flatnonzero(~known)
        if len(strange):                                         # characters without a piece
            parts = {c: self.fallback(chr(c)) for c in np.unique(cp[s[strange]]).tolist()}
            more = [parts[c] for c in cp[s[strange]].tolist()]
            width[strange] = [len(x) for x in more]
            ids = np.repeat(ids, width)
            ids[ids < 0] = [i for x in more for i in x]
        self.units.add(keys, np.bincount(unit, width, len(units)).astype(np.int64), ids)

    def encode(self, texts: list[str | None]) -> list[np.ndarray]:
        """Ids of each text."""
        parts = [MARK + t.replace(" ", MARK) if t else "" for t in texts]
        bound = np.concatenate([[0], np.cumsum([len(p) for p in parts])]).astype(np.int64)
        cp = np.frombuffer("".join(parts).encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
        if not len(cp):
            return [np.empty(0, np.int32) for _ in texts]
        mark = cp == ord(MARK)
        first = mark.copy()
        first[1:] &= ~mark[:-1]
        first[bound[:-1][np.diff(bound) > 0]] = True
        s = np.flatnonzero(first)
        e = np.append(s[1:], len(cp))
        h, at, inv = np.unique(_spans(mix(cp.astype(np.uint64) + np.uint64(1)), s, e, "byte"), return_index=True, return_inverse=True)
        keys = h.tolist()
        slot = self.units.find(keys)
        new = np.flatnonzero(slot < 0)
        if len(new):
            size = np.cumsum(e[at[new]] - s[at[new]] + 1)
            for part in np.split(new, np.flatnonzero(np.diff(size // INDEX_CHARS)) + 1):
                self._learn([keys[k] for k in part.tolist()], [cp[s[at[k]]:e[at[k]]] for k in part.tolist()])
            slot[new] = [self.units.slot[keys[k]] for k in new.tolist()]
        ids, total = self.units.gather(slot[inv])
        cut = total[np.searchsorted(s, bound)]
        return [ids[cut[d]:cut[d + 1]] for d in range(len(texts))]

    def decode(self, ids: np.ndarray) -> str:
        size = self.raw_size[ids]
        at = np.cumsum(size) - size
        out = self.raw[np.repeat(self.raw_at[ids] - at, size) + np.arange(size.sum())].tobytes()
        text = out.decode("utf-8", "surrogatepass" if b"\xed" in out else "replace")
        return text[1:] if text[:1] == " " else text


_MODELS: dict[str, Pieces] = {}


def _model(path: str) -> Pieces:
    if path not in _MODELS:
        _MODELS[path] = Pieces(path)
    return _MODELS[path]


def _slices(texts: list[str | None]):
    part, size = [], 0
    for t in texts:
        part.append(t)
        size += len(t or "")
        if size >= SLICE_CHARS:
            yield part
            part, size = [], 0
    if part:
        yield part


def encode(docs: DataFrame, model: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n_tokens, ids, round_trip) of every row; round_trip: decoding the ids gives the text back."""
    d = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))

    def run(b):
        p, row = _model(model), 0
        for texts in _slices(b.column(1).to_pylist()):
            ids = p.encode(texts)
            same = [p.decode(x) == (t or "").replace(MARK, " ") for x, t in zip(ids, texts)]
            n = np.array([len(x) for x in ids], dtype=np.int64)
            yield pa.RecordBatch.from_arrays([b.column(0).slice(row, len(texts)), pa.array(n), lists(np.concatenate(ids).astype(np.int32), n),
                                              pa.array(same)], ["doc_id", "n_tokens", "ids", "round_trip"])
            row += len(texts)
    return map_arrow(d, run, "doc_id long, n_tokens long, ids array<int>, round_trip boolean")


def decode(rows: DataFrame, model: str, ids_col: str = "ids", out: str = "text") -> DataFrame:
    """(doc_id, text) from rows of (doc_id, ids)."""
    def run(b):
        p = _model(model)
        texts = [p.decode(np.array(x if x is not None else [], dtype=np.int64)) for x in b.column(1).to_numpy(zero_copy_only=False)]
        yield pa.RecordBatch.from_arrays([b.column(0), pa.array(texts, pa.string())], ["doc_id", out])
    return map_arrow(rows.select(F.col("doc_id").cast("long").alias("doc_id"), ids_col), run, f"doc_id long, {out} string")

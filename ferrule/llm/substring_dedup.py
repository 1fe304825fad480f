"""Substring dedup: remove every word of a window of words that occurs anywhere else too.

Equal windows of ``WINDOW`` words hold the same anchors (the runs of ``ANCHOR`` words with the least fingerprint
among those inside the window), so each occurrence of a window is known from an anchor and the words around it.
Anchors that occur once are dropped by a count.  Where all occurrences of an anchor have the same surroundings, all
windows around it are repeated.  For the others the distinct surroundings of an anchor form one reference shard:
a suffix automaton is built over them, with the number of occurrences at each state, and the surroundings stream
through it; where the matching length reaches the window's, the state's count says whether the window occurs again.
The repeated windows of a document join into maximal spans, which are cut out of its text.

A single broadcast automaton of the whole corpus would have no size bound, so each shard's automaton lives in the task
that holds the shard.  Anchors with more than ``SHARD`` distinct surroundings (a passage in very many texts) are no
shard of one task: their windows are counted by fingerprint, with partial sums before the shuffle.  Nothing is capped.
The occurrences of the commonest anchors are not shuffled by anchor: that these occur again is broadcast to them.

Words are compared by 64-bit fingerprints where they are counted and as they are inside the automata.

Defined cases: null and empty texts have no words and keep none; texts shorter than the window keep all words; a null
id is a document like any other; repeated rows are copies of each other, so their windows are repeated.  Rows are told
apart by a fingerprint of id and text, so a shared or null id makes no long list.  Other columns are not read.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ferrule.llm.common import Words, _spans, lists, map_arrow, mix, signed, slices, stored

WINDOW, ANCHOR = 35, 16
#: Words on either side of an anchor that a window can hold, and windows around an anchor.
SIDE = WINDOW - ANCHOR
AROUND = SIDE + 1
SHARD = 1000
#: Anchors that hold more than one part in so many of all repeated occurrences are broadcast: fewer than this number.
HOT = 1000


def _slide(x: np.ndarray, k: int, best) -> np.ndarray:
    """best over each k consecutive values."""
    out, width = x, 1
    while width * 2 <= k:
        out = best(out[:-width], out[width:])
        width *= 2
    return best(out[:len(x) - k + 1], out[k - width:]) if width < k else out


def _anchors(h: np.ndarray) -> np.ndarray:
    """Positions of the anchors among the fingerprints of a text's runs of ANCHOR words."""
    if len(h) < AROUND:
        return np.empty(0, np.int64)
    least = _slide(h, AROUND, np.minimum)                       # by window
    pad = np.zeros(AROUND - 1, dtype=h.dtype)
    return np.flatnonzero(_slide(np.concatenate([pad, least, pad]), AROUND, np.maximum) == h)


def _text_key(w: Words, a: int, b: int) -> int:
    """31 bits of a text's word sequence: tells rows apart that share an id."""
    return int(w.span(a, b, salt=7) >> np.uint64(33)) if b > a else 0


def _signatures(docs: DataFrame) -> DataFrame:
    def run(b):
        at, anchors, around, n = [], [], [], []
        for x, y, data, off in slices(b.column(1)):
            w = Words(data, off)
            runs = w.windows(ANCHOR)
            for d in range(y - x):
                s, e = int(w.first[d]), int(w.first[d + 1])
                j = _anchors(runs[s:e - ANCHOR + 1]) if e - s >= WINDOW else np.empty(0, np.int64)
                n.append(len(j))
                if len(j):
                    lo, hi = np.maximum(j - SIDE, 0), np.minimum(j + WINDOW, e - s)
                    c = mix(_spans(w.hash[s:e], lo, hi, "word") + (j - lo).astype(np.uint64) * np.uint64(64) + (hi - j).astype(np.uint64))
                    at.append((_text_key(w, s, e) << 31) | j)
                    anchors.append(signed(runs[s + j]))
                    around.append(signed(c))
        join = lambda parts: np.concatenate(parts) if parts else np.empty(0, np.int64)
        n = np.array(n)
        yield pa.RecordBatch.from_arrays([b.column(0), lists(join(anchors), n), lists(join(around), n), lists(join(at), n)],
                                         ["row", "a", "c", "at"])
    return map_arrow(docs, run, "row long, a array<long>, c array<long>, at array<long>").filter("size(a) > 0")


class SuffixAutomaton:
    """Suffix automaton of several sequences with weights; ``count`` is the weight of a state's occurrences."""

    def __init__(self, sequences: list[list[int]], weights: list[int]):
        self.next: list[dict[int, int]] = [{}]
        self.link, self.length, self.count = [-1], [0], [0]
        for seq, k in zip(sequences, weights):
            last = 0
            for c in seq:
                last = self._extend(last, c)
                self.count[last] += k
        for q in sorted(range(1, len(self.next)), key=self.length.__getitem__, reverse=True):
            self.count[self.link[q]] += self.count[q]

    def _extend(self, last: int, c: int) -> int:
        nxt, link, length = self.next, self.link, self.length
        if c in nxt[last]:
            q = nxt[last][c]
            return q if length[q] == length[last] + 1 else self._clone(last, q, c)
        new = len(nxt)
        nxt.append({})
        link.append(0)
        length.append(length[last] + 1)
        self.count.append(0)
        p = last
        while p >= 0 and c not in nxt[p]:
            nxt[p][c] = new
            p = link[p]
        if p >= 0:
            q = nxt[p][c]
            link[new] = q if length[q] == length[p] + 1 else self._clone(p, q, c)
        return new

    def _clone(self, p: int, q: int, c: int) -> int:
        new = len(self.next)
        self.next.append(dict(self.next[q]))
        self.link.append(self.link[q])
        self.length.append(self.length[p] + 1)
        self.count.append(0)
        self.link[q] = new
        while p >= 0 and self.next[p].get(c) == q:
            self.next[p][c] = new
            p = self.link[p]
        return new

    def repeated(self, seq: list[int], least: int) -> list[bool]:
        """For each position: do the ``least`` symbols up to it occur with a weight of two or more?"""
        q, m, out = 0, 0, []
        for c in seq:
            while q and c not in self.next[q]:
                q = self.link[q]
                m = self.length[q]
            if c in self.next[q]:
                q, m = self.next[q][c], m + 1
            while q and self.length[self.link[q]] >= least:
                q = self.link[q]
                m = self.length[q]
            out.append(m >= least and self.count[q] >= 2)
        return out


def _shard_masks(group: list[tuple[int, int, int, list[bytes]]]) -> list[tuple[int, int]]:
    """(c, mask) of an anchor's surroundings (c, occurrences, words left of the anchor, words); bit i of the mask: the
    window that starts SIDE - i words before the anchor occurs again."""
    ids: dict = {}
    seqs = []
    for _, _, left, words in group:
        # a symbol is a word and its place from the anchor; the anchor itself is one symbol
        rest = [*enumerate(words[:left], -left), (0, b""), *enumerate(words[left + ANCHOR:], 1)]
        seqs.append([ids.setdefault(x, len(ids)) for x in rest])
    auto = SuffixAutomaton(seqs, [k for _, k, _, _ in group])
    out = []
    for (c, _, left, _), seq in zip(group, seqs):
        mask = 0
        for p, yes in enumerate(auto.repeated(seq, SIDE + 1)):  # the symbols of a window: SIDE words and the anchor
            start = left - (p - SIDE)                           # words of the window before the anchor
            if yes and 0 <= start <= SIDE:
                mask |= 1 << start
        out.append((c, mask))
    return out


def _masks(rows: DataFrame) -> DataFrame:
    """(a, c, mask) of the surroundings (a, c, k, left, words), by one automaton for each a."""
    def run(batches):
        key, group, out = None, [], []
        for b in batches:
            cols = [b.column(i).to_pylist() for i in range(5)]
            for a, c, k, left, words in zip(*cols):
                if a != key and group:
                    out += [(key, *x) for x in _shard_masks(group)]
                    group = []
                key = a
                group.append((c, k, left, words.split(b" ")))
            if out:
                yield pa.RecordBatch.from_arrays([pa.array([x[i] for x in out], t) for i, t in enumerate((pa.int64(), pa.int64(), pa.int32()))],
                                                 ["a", "c", "mask"])
                out = []
        if group:
            out = [(key, *x) for x in _shard_masks(group)]
            yield pa.RecordBatch.from_arrays([pa.array([x[i] for x in out], t) for i, t in enumerate((pa.int64(), pa.int64(), pa.int32()))],
                                             ["a", "c", "mask"])
    return rows.repartition("a").sortWithinPartitions("a", "c").mapInArrow(run, "a long, c long, mask int")


def _surroundings(found: DataFrame) -> DataFrame:
    """(a, c, k, big, left, words) from rows (text, list of places in it)."""
    def run(b):
        places = b.column(1).to_pylist()
        for x, y, data, off in slices(b.column(0)):
            w = Words(data, off)
            out = []
            for d in range(y - x):
                s, e = int(w.first[d]), int(w.first[d + 1])
                key = _text_key(w, s, e)
                for p in places[x + d]:
                    j = p["at"] & 0x7FFFFFFF
                    if p["at"] >> 31 == key:
                        lo = max(j - SIDE, 0)
                        out.append((p["a"], p["c"], p["k"], p["big"], j - lo, w.text(s + lo, min(s + j + WINDOW, e))))
            kinds = (pa.int64(), pa.int64(), pa.int64(), pa.bool_(), pa.int32(), pa.binary())
            yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in out], t) for i, t in enumerate(kinds)],
                                             ["a", "c", "k", "big", "left", "words"])
    return map_arrow(found, run, "a long, c long, k long, big boolean, left int, words binary")


def _windows(rows: DataFrame) -> DataFrame:
    """(a, c, k, bit, g): the windows of each of the surroundings, by two fingerprints in g."""
    def run(b):
        for a, c, k, left, words in zip(*(b.column(i).to_pylist() for i in range(5))):
            data = np.frombuffer(words, dtype=np.uint8)
            w = Words(data, np.array([0, len(data)]))
            n = len(w.hash) - WINDOW + 1
            one, two = signed(w.windows(WINDOW)[:n]), signed(w.windows(WINDOW, salt=99)[:n])
            for x in range(n):
                bit = left - x
                if 0 <= bit <= SIDE:
                    yield a, c, k, bit, int(one[x]), int(two[x])

    def batches(b):
        out = list(run(b))
        kinds = (pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.int64())
        yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in out], t) for i, t in enumerate(kinds)], ["a", "c", "k", "bit", "g", "g2"])
    return map_arrow(rows.select("a", "c", "k", "left", "words"), batches, "a long, c long, k long, bit int, g long, g2 long")


def _repeated(spark: SparkSession, one: DataFrame) -> DataFrame:
    """The occurrences (row, a, c, at) whose anchor occurs again, and whether its surroundings differ."""
    again = stored(spark, one.groupBy("a").agg(F.count("*").alias("k"), F.min("c").alias("lo"), F.max("c").alias("hi")).filter("k > 1")
                   .select("a", "k", (F.col("lo") != F.col("hi")).alias("differ")), "repeated")
    total = again.agg(F.sum("k")).first()[0] or 0
    hot = F.broadcast(again.filter(F.col("k") * HOT > total).select("a", "differ"))
    rest = again.filter(F.col("k") * HOT <= total).select("a", "differ")
    return one.join(hot, "a").unionByName(one.join(hot, "a", "left_anti").join(rest, "a"))


def spans_to_remove(spark: SparkSession, docs: DataFrame) -> DataFrame:
    """(row, places): the anchors (at, mask) of each text of (row, text) around which windows are repeated."""
    sig = stored(spark, _signatures(docs), "anchors")
    one = sig.select("row", F.explode(F.arrays_zip("a", "c", "at")).alias("x")).select("row", "x.a", "x.c", "x.at")
    occ = stored(spark, _repeated(spark, one), "occurrences")
    same = occ.filter("not differ").select("row", "at", F.lit((1 << AROUND) - 1).alias("mask"))
    differ = occ.filter("differ")
    kinds = stored(spark, differ.groupBy("a", "c").agg(F.count("*").alias("k"), F.min(F.struct("row", "at")).alias("x")), "kinds")
    # stored, so that the join below has a plain shuffle on both sides, which may be split
    big = stored(spark, kinds.groupBy("a").agg((F.count("*") > SHARD).alias("big")), "sizes")
    ask = (kinds.join(big, "a").select(F.col("x.row").alias("row"), F.struct("a", "c", "k", "big", F.col("x.at").alias("at")).alias("p"))
           .groupBy("row").agg(F.collect_list("p").alias("places")))
    around = stored(spark, _surroundings(docs.join(ask, "row").select("text", "places")), "surroundings")
    masks = _masks(around.filter("not big").select("a", "c", "k", "left", "words"))
    win = stored(spark, _windows(around.filter("big")), "windows")
    often = stored(spark, win.groupBy("a", "bit", "g", "g2").agg(F.sum("k").alias("n")).filter("n > 1").drop("n"), "often")
    more = (win.join(often, ["a", "bit", "g", "g2"], "left_semi").groupBy("a", "c")
            .agg(F.expr("bit_or(shiftleft(1, bit))").alias("mask")))
    decided = stored(spark, masks.unionByName(more).filter("mask <> 0"), "masks")
    parts = differ.select("a", "c", "row", "at").join(decided, ["a", "c"]).select("row", "at", "mask")
    return (same.unionByName(parts).distinct().groupBy("row").agg(F.collect_list(F.struct("at", "mask")).alias("places")))


def _keep(w: Words, places: pa.ListArray) -> np.ndarray:
    """Which words of the texts stay, given each text's places."""
    count = pc.fill_null(pc.list_value_length(places), 0).to_numpy()
    flat = places.flatten()
    at, mask = (flat.field(k).to_numpy() for k in range(2))
    doc = np.repeat(np.arange(len(count)), count)
    key = np.zeros(len(count), dtype=np.int64)
    for d in np.flatnonzero(count).tolist():
        key[d] = _text_key(w, int(w.first[d]), int(w.first[d + 1]))
    mine = at >> 31 == key[doc]
    j, mask, doc = at[mine] & 0x7FFFFFFF, mask[mine], doc[mine]
    begin, last = w.first[doc], w.first[doc + 1] - w.first[doc] - WINDOW
    start = np.zeros(len(w.starts) + WINDOW, dtype=np.int32)    # WINDOW places in front: no window covers what is before it
    for i in range(AROUND):
        x = j - i
        some = (mask >> i & 1 != 0) & (x >= 0) & (x <= last)
        start[WINDOW + begin[some] + x[some]] = 1
    windows = np.cumsum(start)
    return windows[WINDOW:] == windows[:len(w.starts)]


def _join(w: Words, off: np.ndarray, keep: np.ndarray) -> tuple[np.ndarray, pa.StringArray]:
    """(number of kept words of each text, these joined by one space)."""
    before = np.concatenate([[0], np.cumsum(keep)])[w.first]
    start, end = w.starts[keep], w.ends[keep]
    last = np.zeros(len(start), dtype=bool)
    last[before[1:][np.diff(before) > 0] - 1] = True
    step = np.zeros(len(w.data) + 1, dtype=np.int8)
    step[start] += 1
    step[end + ~last] -= 1                                      # the byte after a word becomes the space
    inside = np.cumsum(step[:-1], dtype=np.int8) != 0
    data = w.data.copy()
    data[end[~last]] = 0x20
    at = np.concatenate([[0], np.cumsum(inside)])[off].astype(np.int32)
    texts = pa.StringArray.from_buffers(len(off) - 1, pa.py_buffer(at), pa.py_buffer(data[inside]))
    return np.diff(before), texts


def dedup(spark: SparkSession, docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n_words, n_removed, kept): the kept words of every row of ``docs``, joined by one space."""
    d = docs.select(F.col(id_col).cast("long").alias("doc"), F.col(text_col).alias("text"))
    d = d.withColumn("row", F.xxhash64(F.col("doc").isNull(), "doc", "text"))
    rows = d.join(spans_to_remove(spark, d.select("row", "text")), "row", "left").select("doc", "text", "places")

    def run(b):
        for x, y, data, off in slices(b.column(1)):
            w = Words(data, off)
            kept, texts = _join(w, off, _keep(w, b.column(2).slice(x, y - x)))
            n = np.diff(w.first)
            yield pa.RecordBatch.from_arrays([b.column(0).slice(x, y - x), pa.array(n, pa.int64()), pa.array(n - kept, pa.int64()), texts],
                                             ["doc_id", "n_words", "n_removed", "kept"])
    return map_arrow(rows, run, "doc_id long, n_words long, n_removed long, kept string")


def digest(rows: DataFrame) -> DataFrame:
    """(doc_id, n_words, n_removed, kept_sha256)."""
    return rows.select("doc_id", "n_words", "n_removed", F.sha2(F.encode("kept", "UTF-8"), 256).alias("kept_sha256"))

"""N-gram Jaccard join: exact links between documents whose shingle sets overlap enough.

Method.  A document's set is its distinct word shingles as 64-bit fingerprints, in one global order
(frequent shingles last, else by fingerprint).  Two sets that link share a shingle in their prefixes
(the first n - ceil(t n) + 1 elements), so candidates come from joins on prefix shingles; the number of
shared prefix shingles bounds the whole overlap and removes most of them.  Each set also has a sketch,
about a bit a shingle: the parity of its shingles at each place.  Places where two sketches differ are a
lower bound of the shingles that only one set has, which removes nearly all other candidates before
their texts are moved.  Each remaining candidate is decided exactly: the sets compared with one probe form a trie (sorted sets, shared prefixes walked
once), along which the partial overlap is carried, and a subtree ends when the elements left cannot
reach the needed overlap.

Scale.  Equal sets are one node.  A first round links every node to the least node of its size class
for each of its first shingles only (at most as many rows as postings), so a huge group of near
copies becomes one component; the exact second round then needs only pairs between different
components.  Shingles in more than
``frequent`` components, or in more than ``frequent`` of the sets that consist of little else, go last
in the order: for them no pairs are made unless a set consists of little else, and those pairs come
from a join that Spark splits by itself.  Two sets that share nothing but frequent shingles have at
most as many in common as the poorer one has frequent shingles, so a large group of texts that are
similar, but less than the threshold asks, is left out inside that join.  That order is a hint: it
changes the candidates, never the links.

Defined cases: null or empty texts have an empty set and link with nothing; texts with fewer words
than the shingle size have one shingle, the whole sequence; a null id links with nothing; rows that
share an id are one node with the links of all its rows; other columns are not read.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ferrule.llm.common import Membership, Words, give_back, lists, map_arrow, map_batches, mix, parts, signed, slices, stored
from ferrule.llm.components import components

#: At most so many frequent shingles are put last in the order (8 bytes each, broadcast).
FREQUENT_MAX = 200_000
#: Shingles of each set that the first round looks at.
FIRST = 16
#: Candidates of one probe are dealt over so many groups.
SALTS = 64
#: Bytes of text handled at once: several of these steps run in one task, each with a worker of its own.
SLICE = 1 << 18
#: Documents whose whole sets are sent out at once.
PART = 256
_TRIE_STEP = 128
_TRIE_BATCH = 256


def shingle_sets(column: pa.Array, size: int):
    """(row, sorted distinct shingle fingerprints as int64) for each text of the column."""
    row = 0
    for a, b, data, off in slices(column, SLICE):
        w = Words(data, off, lower=True)
        h = signed(w.windows(size, salt=size))
        for d in range(b - a):
            s, e = w.first[d], w.first[d + 1]
            if e - s >= size:
                yield row, np.unique(h[s:e - size + 1])
            elif e > s:
                yield row, signed(np.array([w.span(s, e, salt=int(e - s))]))
            else:
                yield row, np.empty(0, np.int64)
            row += 1


class Threshold:
    """Integer arithmetic of: percent * union <= 100 * intersection."""

    def __init__(self, percent: int):
        self.percent = percent

    def prefix(self, n: int) -> int:
        return n - (self.percent * n + 99) // 100 + 1

    def kept(self, n: int) -> int:
        """Elements kept of a set: the prefix, and room for frequent shingles that move to the end."""
        return n if n <= 64 else min(n, self.prefix(n) * 21 // 20 + 2)

    def need(self, a: int, b: int) -> int:
        return -(-self.percent * (a + b) // (100 + self.percent))


def sketch(mixed: np.ndarray) -> np.ndarray:
    """Parity of the elements at each of 64 places or more: the first power of two above their number.

    Halves joined by exclusive or are the sketch of half the length.
    """
    places = 1 << max(6, len(mixed).bit_length())
    odd = np.bincount((mixed & np.uint64(places - 1)).astype(np.int64), minlength=places).astype(np.uint8) & 1
    return np.packbits(odd, bitorder="little").view(np.int64)


def _signatures(docs: DataFrame, size: int, t: Threshold) -> DataFrame:
    def run(b):
        n, h1, h2, pre, bits = [], [], [], [], []
        for row, s in shingle_sets(b.column(1), size):
            u = s.view(np.uint64)
            m = mix(u)
            n.append(len(s))
            h1.append(m.sum(dtype=np.uint64))
            h2.append(mix(u ^ np.uint64(0xA5A5A5A5DEADBEEF)).sum(dtype=np.uint64))
            pre.append(s[:t.kept(len(s))])
            bits.append(sketch(m))
        yield pa.RecordBatch.from_arrays(
            [b.column(0), pa.array(n, pa.int64()), pa.array(signed(np.array(h1))), pa.array(signed(np.array(h2))),
             lists(np.concatenate(pre), np.array([len(p) for p in pre])),
             lists(np.concatenate(bits), np.array([len(p) for p in bits]))], ["doc", "n", "h1", "h2", "pre", "bits"])
    return map_arrow(docs, run, "doc long, n long, h1 long, h2 long, pre array<long>, bits array<long>")


def _postings(sig: DataFrame, rep: Membership, first: int | None = None, having: Membership | None = None) -> DataFrame:
    """(s, doc, n): the kept shingles, or the first so many, of each representative."""
    def run(b):
        doc, n, pre = b.column(0), b.column(1).to_numpy(), b.column(2)
        keep = rep.mask(doc.fill_null(0).to_numpy()) & doc.is_valid().to_numpy(zero_copy_only=False) & (n > 0)
        off, flat = pre.offsets.to_numpy().astype(np.int64), pre.values.to_numpy(zero_copy_only=False)
        size = np.where(keep, np.diff(off), 0)
        if first is not None:
            size = np.minimum(size, first)
        at = np.repeat(off[:-1] - (np.cumsum(size) - size), size) + np.arange(size.sum())
        row, s = np.repeat(np.arange(b.num_rows), size), flat[at]
        if having is not None:
            yes = having.mask(s)
            row, s = row[yes], s[yes]
        for a in range(0, len(s), 1 << 18):                      # bounded batches
            r = row[a:a + (1 << 18)]
            yield pa.RecordBatch.from_arrays([pa.array(s[a:a + (1 << 18)]), doc.take(pa.array(r)), pa.array(n[r])], ["s", "doc", "n"])
    return map_arrow(sig.select("doc", "n", "pre"), run, "s long, doc long, n long")


def _by_trie(probe: np.ndarray, cands: list[tuple[int, np.ndarray]], t: Threshold) -> list[int]:
    """Ids of the candidates that link with the probe."""
    out = []
    old, seen = np.empty(0, np.int64), np.zeros(1, np.int64)      # last path; overlap at each depth walked
    for cid, s in sorted(cands, key=lambda c: c[1].tobytes()):
        m = min(len(old), len(s), len(seen) - 1)
        differ = np.flatnonzero(old[:m] != s[:m])
        depth = int(differ[0]) if len(differ) else m              # the shared part of the path is not walked again
        path, need = [seen[:depth + 1]], t.need(len(probe), len(s))
        have = int(seen[depth])
        while depth < len(s) and have + min(len(s) - depth, len(probe) - have) >= need:
            step = s[depth:depth + _TRIE_STEP]
            at = np.minimum(np.searchsorted(probe, step), len(probe) - 1)
            path.append(have + np.cumsum(probe[at] == step))
            have, depth = int(path[-1][-1]), depth + len(step)
        old, seen = s, np.concatenate(path)
        if depth == len(s) and have >= need:
            out.append(cid)
    return out


def _may_link(spark: SparkSession, sig: DataFrame, pairs: DataFrame, t: Threshold) -> DataFrame:
    """(a, b, salt): the pairs of which some rows' sketches leave room for a link."""
    p = stored(spark, pairs.select("a", "b", F.pmod(F.xxhash64("b"), F.lit(SALTS)).cast("int").alias("salt")), "pairs")
    ids = p.select(F.explode(F.array("a", "b")).alias("id")).distinct()
    rows = Membership(ids).rows(sig.select("doc", "n", "bits").filter("n > 0"))
    probe = (p.select("a", "salt").distinct()                    # the rows of a probe with many candidates are dealt out
             .join(rows.select(F.col("doc").alias("a"), F.col("n").alias("na"), F.col("bits").alias("x")), "a"))
    both = (p.join(rows.select(F.col("doc").alias("b"), F.col("n").alias("nb"), F.col("bits").alias("y")), "b")
            .join(probe, ["a", "salt"])
            .filter(f"100 * least(na, nb) >= {t.percent} * greatest(na, nb)"))
    k = F.least(F.size("x"), F.size("y"))                        # longer ones than twice that are not compared

    def cut(bits):
        return F.when(F.size(bits) > k, F.zip_with(F.slice(bits, F.lit(1), k), F.slice(bits, k + 1, k),
                                                   lambda v, w: v.bitwiseXOR(w))).otherwise(F.col(bits))
    differ = F.aggregate(F.zip_with(cut("x"), cut("y"), lambda v, w: F.bit_count(v.bitwiseXOR(w))), F.lit(0),
                         lambda acc, v: acc + v)
    whole = F.col("na") + F.col("nb")
    room = ((whole - differ) * (100 + t.percent) >= 2 * t.percent * whole) | (F.greatest(F.size("x"), F.size("y")) > 2 * k)
    return both.filter(room).select("a", "b", "salt").distinct()


def _verify(spark: SparkSession, docs: DataFrame, sig: DataFrame, pairs: DataFrame, size: int, t: Threshold) -> DataFrame:
    """The pairs (a, b) that link."""
    p = stored(spark, _may_link(spark, sig, pairs, t), "pairs")
    ask = (p.select(F.col("a").alias("id"), "a", "salt", F.lit(0).alias("kind")).distinct()
           .unionByName(p.select(F.col("b").alias("id"), "a", "salt", F.lit(1).alias("kind"))))
    texts = Membership(ask.select("id").distinct()).rows(docs)   # before the shuffle of texts
    rows = (ask.join(texts, F.col("id") == F.col("doc")).select("a", "salt", "kind", "id", "text")
            .repartition("a", "salt").sortWithinPartitions("a", "salt", "kind", "id"))

    def run(batches):
        key, probes, cands, out = None, [], [], []

        def flush():
            for s in probes:
                out.extend((key[0], c) for c in _by_trie(s, cands, t))
            cands.clear()

        for b in batches:
            if not b.num_rows:
                continue
            a, salt, kind, ids = (b.column(k).to_numpy() for k in range(4))
            for row, s in shingle_sets(b.column(4), size):
                k = (int(a[row]), int(salt[row]))
                if k != key:
                    flush()
                    key, probes = k, []
                if not len(s):
                    continue
                if kind[row] == 0:
                    probes.append(s)
                else:
                    cands.append((int(ids[row]), s))
                    if len(cands) >= _TRIE_BATCH:
                        flush()
            if out:
                yield pa.RecordBatch.from_arrays([pa.array([x for x, _ in out], pa.int64()),
                                                  pa.array([y for _, y in out], pa.int64())], ["a", "b"])
                out.clear()
            give_back()
        flush()
        if out:
            yield pa.RecordBatch.from_arrays([pa.array([x for x, _ in out], pa.int64()),
                                              pa.array([y for _, y in out], pa.int64())], ["a", "b"])
    return map_batches(rows, run, "a long, b long").distinct()


def _is_in(values: np.ndarray, ordered: np.ndarray) -> np.ndarray:
    """Which values are in a sorted array."""
    if not len(ordered):
        return np.zeros(len(values), dtype=bool)
    return ordered[np.minimum(np.searchsorted(ordered, values), len(ordered) - 1)] == values


def _cuts(sig: DataFrame, rep: Membership, frequent: np.ndarray, t: Threshold) -> DataFrame:
    """Where each representative's prefix ends in the order (frequent, fingerprint).  ``short``: the kept elements do not reach it.
    ``n_late``: a bound of the set's frequent shingles, exact where the prefix reaches into them."""
    def run(b):
        doc = b.column(0)
        keep = rep.mask(doc.fill_null(0).to_numpy()) & doc.is_valid().to_numpy(zero_copy_only=False) & (b.column(1).to_numpy() > 0)
        b = b.filter(pa.array(keep))
        n, pre = b.column(1).to_numpy(), b.column(2)
        off, flat = pre.offsets.to_numpy(), pre.values.to_numpy(zero_copy_only=False)
        late = _is_in(flat, frequent)
        cut, cut_late, short, n_late = [], [], [], []
        low = np.iinfo(np.int64).min
        for i in range(b.num_rows):
            s, f = flat[off[i]:off[i + 1]], late[off[i]:off[i + 1]]
            want, first = t.prefix(int(n[i])), s[~f]
            if len(first) >= want:
                cut.append(first[want - 1])
                cut_late.append(low)
                short.append(False)
                n_late.append(n[i])
            else:
                whole = len(s) == n[i]
                n_late.append(int(f.sum()) if whole else n[i])
                cut.append(np.iinfo(np.int64).max)
                cut_late.append(s[f][want - len(first) - 1] if whole else low)
                short.append(not whole)
        yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(cut, pa.int64()), pa.array(cut_late, pa.int64()),
                                          pa.array(short), pa.array(n_late, pa.int64())],
                                         ["doc", "n", "cut", "cut_late", "short", "n_late"])
    return map_arrow(sig.select("doc", "n", "pre"), run,
                     "doc long, n long, cut long, cut_late long, short boolean, n_late long")


def links(spark: SparkSession, docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", size: int = 4,
          percent: int = 85, frequent: int = 40) -> tuple[DataFrame, DataFrame]:
    """(documents, links): (doc, n, rep) for each row, rep the least id with an equal set; and the pairs
    (a, b) of representatives found to link.  The pairs connect everything that links, but pairs inside
    a component that the first round had already connected are not all listed."""
    t = Threshold(percent)
    docs = docs.select(F.col(id_col).cast("long").alias("doc"), F.col(text_col).alias("text"))
    sig = stored(spark, _signatures(docs, size, t), "signatures")
    known = sig.filter("n > 0 and doc is not null")
    cls = known.groupBy("n", "h1", "h2").agg(F.min("doc").alias("rep"))
    members = stored(spark, sig.select("doc", "n", "h1", "h2").join(cls, ["n", "h1", "h2"], "left").select("doc", "n", "rep"),
                     "members")
    # copies are left out by a bitmap of the representatives: one that passes by chance is only one node more
    rep = Membership(members.filter("rep is not null").select("rep").distinct())

    # first round: each node and the least node of its size class for each of its first shingles; a lead of another
    # size is seldom like all the texts of a large group, and would leave the group's members apart
    size_class = F.col("n") if percent >= 100 else F.floor(F.log(F.col("n")) / F.lit(math.log(100 / percent)))
    few = _postings(sig, rep, FIRST).withColumn("cls", size_class)
    lead = few.groupBy("s", "cls").agg(F.count("*").alias("c"), F.min("doc").alias("a")).filter("c > 1").drop("c")
    near = (few.join(lead, ["s", "cls"]).filter("doc <> a")
            .groupBy("a", F.col("doc").alias("b")).agg(F.count("*").alias("c"), F.min("n").alias("n"))
            .filter(f"4 * c >= least({FIRST}, n)"))
    first = stored(spark, _verify(spark, docs, sig, near, size, t), "links")
    comp = components(spark, first)

    # second round: exact, between components
    by_doc = comp.select(F.col("node").alias("doc"), "component")
    twice = _postings(sig, rep).groupBy("s").agg(F.count("*").alias("c")).filter("c > 1")    # rows of one id are left out below
    found = _postings(sig, rep, having=Membership(stored(spark, twice.select("s"), "twice")))
    shared = stored(spark, found.join(by_doc, "doc", "left").select("s", "doc", F.coalesce("component", "doc").alias("comp")), "shared")
    several = stored(spark, shared.select("s", "comp").distinct().groupBy("s").agg(F.count("*").alias("k")).filter("k > 1"), "several")
    many = stored(spark, several.filter(F.col("k") > frequent).orderBy(F.desc("k"), "s").limit(FREQUENT_MAX).select("s"), "frequent")
    late = _ordered(many)
    short = stored(spark, _cuts(sig, rep, late, t).filter("short").select("doc").distinct(), "short")
    if not short.isEmpty():              # sets of little else: what is frequent in them beyond their kept elements, too
        more = (_whole_sets(docs, Membership(short), size).groupBy("s").agg(F.count("*").alias("k"))
                .filter(F.col("k") > frequent).join(many, "s", "left_anti")
                .orderBy(F.desc("k"), "s").limit(max(0, FREQUENT_MAX - len(late))).select("s"))
        many = stored(spark, many.unionByName(more), "frequent")
        late = _ordered(many)
    cuts = stored(spark, _cuts(sig, rep, late, t), "cuts")
    short = cuts.filter("short").select("doc").distinct()
    some = not short.isEmpty()
    place = cuts.join(by_doc, "doc", "left").withColumn("comp", F.coalesce("component", "doc")).drop("component", "short")
    flag = F.broadcast(many.withColumn("late", F.lit(True)))
    rows = shared.select("s", "doc").join(several.select("s"), "s", "left_semi")
    low = F.lit(np.iinfo(np.int64).min)
    if some:                                                 # elements of these sets beyond the kept ones
        rest = stored(spark, _whole(docs, Membership(short), late, size, t), "rest")
        extra = Membership(rest.select("s").distinct())      # what passes by chance is a posting all the same
        rows = (rows.unionByName(_postings(sig, rep, having=extra).select("s", "doc"))
                .unionByName(rest.select("s", "doc")))       # repeated ones are left out with their places, by document
        ends = rest.groupBy("doc").agg(F.max(F.struct(F.col("late").cast("int").alias("late"), "s")).alias("e"),
                                       F.max("n_late").alias("l"))
        place = (place.join(ends, "doc", "left")
                 .withColumn("cut", F.when(F.col("e.late") == 0, F.col("e.s")).otherwise(F.col("cut")))
                 .withColumn("cut_late", F.when(F.col("e.late") == 1, F.col("e.s")).when(F.col("e.late") == 0, low)
                             .otherwise(F.col("cut_late")))
                 .withColumn("n_late", F.coalesce("l", "n_late")).drop("e", "l"))
    # a frequent shingle finds nothing for a set with fewer frequent shingles than any link of its size needs
    rows = (rows.join(flag, "s", "left").join(place, "doc")
            .filter(f"(late is null and s <= cut) or (late and s <= cut_late and 100 * n_late >= {percent} * n)")
            .select("s", "doc", "n", "comp", "n_late", F.coalesce("late", F.lit(False)).alias("late"),
                    F.struct((F.col("cut_late") > low).alias("f"),
                             F.when(F.col("cut_late") > low, F.col("cut_late")).otherwise(F.col("cut")).alias("at")).alias("end"))
            .distinct())
    x, y = rows.alias("x"), rows.alias("y")
    fits = f"least(x.n_late, y.n_late) * {100 + percent} >= {percent} * (x.n + y.n)"
    both = (x.join(y, F.expr("x.s = y.s and x.doc < y.doc and x.comp <> y.comp and "
                             f"100 * least(x.n, y.n) >= {percent} * greatest(x.n, y.n) and (not x.late or {fits})"))
            .select(F.col("x.doc").alias("a"), F.col("y.doc").alias("b"), F.col("x.n").alias("na"), F.col("y.n").alias("nb"),
                    F.when(F.col("x.end") <= F.col("y.end"), F.col("x.n")).otherwise(F.col("y.n")).alias("nq"),
                    F.when(F.expr(f"x.end.f and y.end.f and not ({fits})"), F.least("x.n_late", "y.n_late")).alias("rest"))
            .groupBy("a", "b", "na", "nb", "nq", "rest").agg(F.count("*").alias("c")))
    # Common elements up to the earlier end are counted in c; beyond it only n - prefix elements are left.  Where
    # frequent shingles were left out, c has all the others, and ``rest`` bounds the frequent ones in common.
    left = f"coalesce(rest, ({percent} * nq + 99) div 100 - 1)"
    both = both.filter(f"(c + {left}) * {100 + percent} >= {percent} * (na + nb)").select("a", "b").distinct()
    second = stored(spark, _verify(spark, docs, sig, both, size, t), "links")
    return members, first.unionByName(second)


def _ordered(shingles: DataFrame) -> np.ndarray:
    """At most FREQUENT_MAX shingles as a sorted array."""
    return np.sort(np.array([r.s for r in shingles.collect()], dtype=np.int64))


def _parts(b: pa.RecordBatch, some: Membership):
    """The batch's rows of these documents, a few at a time: read in one step, so that no task needs two workers."""
    ids = b.column(0)
    keep = np.flatnonzero(some.mask(ids.fill_null(0).to_numpy()) & ids.is_valid().to_numpy(zero_copy_only=False))
    for a in range(0, len(keep), PART):
        yield b.take(pa.array(keep[a:a + PART]))


def _whole_sets(docs: DataFrame, some: Membership, size: int) -> DataFrame:
    """(s): one row for each shingle of each set of these documents."""
    def run(b):
        for part in _parts(b, some):
            sets = [s for _, s in shingle_sets(part.column(1), size)]
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(sets))], ["s"])
    return map_arrow(docs.select("doc", "text"), run, "s long")


def _whole(docs: DataFrame, some: Membership, frequent: np.ndarray, size: int, t: Threshold) -> DataFrame:
    """(doc, s, late, n_late): the prefix of these documents' whole sets, and how many frequent shingles the set has."""
    def run(b):
        for part in _parts(b, some):
            ps, fs, k, n = [], [], [], []
            for _, s in shingle_sets(part.column(1), size):
                late = _is_in(s, frequent)
                first = np.argsort(late, kind="stable")[:t.prefix(len(s))]
                ps.append(s[first])
                fs.append(late[first])
                k.append(len(first))
                n.append(int(late.sum()))
            yield pa.RecordBatch.from_arrays([pa.array(np.repeat(part.column(0).to_numpy(), k)), pa.array(np.concatenate(ps)),
                                              pa.array(np.concatenate(fs)), pa.array(np.repeat(np.array(n, np.int64), k))],
                                             ["doc", "s", "late", "n_late"])
    return map_arrow(docs.select("doc", "text"), run, "doc long, s long, late boolean, n_late long")


def link_components(spark: SparkSession, docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", size: int = 4,
                    percent: int = 85) -> DataFrame:
    """(doc_id, n_shingles, component_id) for each row of ``docs``."""
    members, pairs = links(spark, docs, id_col, text_col, size, percent)
    edges = (members.filter("rep <> doc").select(F.col("doc").alias("a"), F.col("rep").alias("b"))
             .unionByName(pairs))
    comp = components(spark, edges).select(F.col("node").alias("doc"), "component")
    return (members.join(comp, "doc", "left")
            .select(F.col("doc").alias("doc_id"), F.col("n").alias("n_shingles"),
                    F.coalesce("component", "doc").alias("component_id")))


def _told_apart(docs: DataFrame, id_col: str, gone: DataFrame, again: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The rows of ``docs`` that surely stay, and those that joins must decide.  Bitmaps of the ids tell most rows without
    moving them: one of the ids that may go, one of those that it holds by chance or that only repeat."""
    some = Membership(gone.unionByName(again.select(F.col("again_").alias("gone_"))), least=22)
    key = "key_"
    while key in docs.columns:
        key += "_"
    ids = some.rows(docs.select(F.col(id_col).cast("long").alias(key), F.col(id_col).alias(key + "i")))
    left = Membership(ids.join(gone, F.col(key + "i") == F.col("gone_"), "left_anti").select(key).distinct(), least=22)
    rows = docs.select(F.col(id_col).cast("long").alias(key), "*")

    def rows_of(doubt: bool):
        def run(batches):
            for b in batches:
                for p in parts(b):
                    v, valid = p.column(0).fill_null(0).to_numpy(), p.column(0).is_valid().to_numpy(zero_copy_only=False)
                    held = some.mask(v) & valid
                    yes = held & left.mask(v) if doubt else ~held
                    if yes.any():
                        yield p.filter(pa.array(yes))
                del b
                give_back()
        return map_batches(rows, run, rows.schema).drop(key)
    return rows_of(False), rows_of(True)


def keep_one(spark: SparkSession, docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", size: int = 5,
             percent: int = 80) -> DataFrame:
    """The rows of ``docs`` that have the least id of their component; rows with a null id stay.

    Of rows that share this id and the text one stays, the first by their JSON; rows that share the id but hold
    different texts all stay, whether they are alike or not.
    """
    comp = stored(spark, link_components(spark, docs, id_col, text_col, size, percent), "components")
    gone = comp.filter("doc_id <> component_id").select(F.col("doc_id").alias("gone_")).distinct()
    again = comp.groupBy("doc_id").agg(F.count("*").alias("k")).filter("k > 1 and doc_id is not null").select(F.col("doc_id").alias("again_"))
    sure, doubtful = _told_apart(docs, id_col, gone, again)
    kept = doubtful.join(gone, doubtful[id_col] == F.col("gone_"), "left_anti")
    if again.isEmpty():
        return sure.union(kept)
    twice = kept[id_col] == F.col("again_")
    name = "row_"
    while name in docs.columns:
        name += "_"
    # row_number = 1: each task sends one row of a group
    equal = Window.partitionBy(id_col, text_col).orderBy(F.to_json(F.struct(*docs.columns)))
    first = (kept.join(again, twice, "left_semi").withColumn(name, F.row_number().over(equal)).filter(F.col(name) == 1).drop(name))
    return sure.union(kept.join(again, twice, "left_anti")).union(first)

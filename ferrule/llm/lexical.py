"""Ranked lexical search: the k best documents of each item, term at a time with limited accumulators.

Method.  One pass over the documents makes inverted blocks: for some ``BLOCK_DOCS`` documents, the postings of every
term that an item asks for.  From these come the document frequencies, and from them the weights.  A second pass reads
the blocks and evaluates each item term at a time, rarest first: a posting adds its exact contribution to the
document's accumulator, or makes one.  After each term the sum of the largest contributions of the remaining terms
bounds every document that has no accumulator yet; once that is below the kth best partial score (of the block, or the
kth best score of the blocks before), no more accumulators are made, and the survivors are completed exactly.

Scale.  Blocks are cut out of the stream of documents where it is read: no posting is shuffled, so a term that half of
all documents hold is no hot key.  Items are broadcast in blocks of about ``ITEMS``; each block of items reads the
documents once more.  Only the k best of a task are ranked over all tasks, in two steps.

Arithmetic: integers, as the scores are defined; weights floor(1000 ln((2N+2)/(2df+1))).

Defined cases: null and empty texts have no term and are not counted in N; rows that share a doc_id are separate
documents; among equal scores a null doc_id comes last; rows that share an item_id are one item with the terms of all of
them (a null item_id is one item, too); items without terms, and empty tables, give no rows; other columns are not read.
"""

from __future__ import annotations

import math
import re
from array import array
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ferrule.llm.common import lists, map_arrow, stored

BLOCK_DOCS = 4096
#: A block also ends here, so that many long documents do not make it large.
_BLOCK_POSTINGS = 2 << 20
ITEMS = 2000
_SALTS = 64
_LAST = (1 << 63) - 1
_LONG = 1 << 20
# UTF-8 never uses bytes below 0x80 inside a character, so a class over bytes finds the same terms
TERM = re.compile(rb"[0-9a-z\x80-\xff]+")


def terms(text: bytes) -> Counter:
    """How often each term occurs; only A-Z are lower-cased."""
    if len(text) <= _LONG:
        return Counter(TERM.findall(text.lower()))
    return Counter(m[0].lower() for m in re.finditer(rb"[0-9A-Za-z\x80-\xff]+", text))


def _inverted(docs: DataFrame, vocabulary) -> DataFrame:
    """One row for each block: its documents with a term of the vocabulary, and the postings by term."""
    def run(batches):
        vocab = vocabulary.value
        docs_, size, place, term, tf = [], array("q"), array("i"), array("i"), array("q")
        n_docs = n_terms = 0

        def emit():
            t = np.frombuffer(term, np.int32) if len(term) else np.empty(0, np.int32)
            order = np.argsort(t, kind="stable")
            ids, count = np.unique(t, return_counts=True)
            cell = [ids.astype(np.int32), count.astype(np.int32), np.array(place, np.int32)[order], np.array(tf, np.int64)[order], np.array(size, np.int64)]
            return pa.RecordBatch.from_arrays(
                [pa.array([n_docs], pa.int64()), pa.array([n_terms], pa.int64()), pa.array([docs_], pa.list_(pa.int64())),
                 *[lists(x, np.array([len(x)])) for x in cell]], ["n_docs", "n_terms", "docs", "term", "df", "place", "tf", "size"])
        for b in batches:
            for i in range(b.num_rows):
                have = terms(b.column(1)[i].as_py() or b"")
                if not have:
                    continue
                n = have.total()
                n_docs += 1
                n_terms += n
                found = have.keys() & vocab.keys()
                if found:
                    place.extend([len(docs_)] * len(found))
                    term.extend(map(vocab.__getitem__, found))
                    tf.extend(map(have.__getitem__, found))
                    docs_.append(b.column(0)[i].as_py())
                    size.append(n)
                if len(docs_) >= BLOCK_DOCS or len(place) >= _BLOCK_POSTINGS:
                    yield emit()
                    docs_, size, place, term, tf = [], array("q"), array("i"), array("i"), array("q")
                    n_docs = n_terms = 0
        if n_docs:
            yield emit()
    return docs.mapInArrow(run, "n_docs long, n_terms long, docs array<long>, term array<int>, df array<int>, place array<int>, "
                                "tf array<long>, size array<long>")


class Block:
    """A block's postings with the exact contribution of each."""

    def __init__(self, ids, docs, df, place, tf, size, weight: dict[int, int], n: int, length: int):
        self.docs = docs
        self.at = {int(t): k for k, t in enumerate(ids)}
        self.start = np.concatenate([[0], np.cumsum(df, dtype=np.int64)])
        if 50 * n * int(size.max(initial=0)) < 1 << 63:
            m = 50 + 50 * size * n // length
        else:
            m = np.array([50 + 50 * int(s) * n // length for s in size], dtype=np.int64)
        w = np.repeat(np.array([weight[int(t)] for t in ids], dtype=np.int64), df)
        self.place = place
        self.add = w * (1_000_000_000 * tf // (1000 * tf + 20 * m[place]))
        self.most = np.maximum.reduceat(self.add, self.start[:-1]) if len(self.add) else np.empty(0, np.int64)

    def best(self, query: list[int], k: int, floor: int) -> tuple[np.ndarray, np.ndarray]:
        """(places, scores) of all documents that may be among the k best; ``floor``: the kth best score known.
        ``query``: term ids, rarest first."""
        rows = [self.at[t] for t in query if t in self.at]
        rest = np.cumsum([int(self.most[r]) for r in rows][::-1])[::-1].tolist() + [0]    # bound of the terms from i on
        score = np.zeros(len(self.docs), dtype=np.int64)
        alive = None                                          # places with an accumulator, once no more are made
        if rest[0] < floor:
            return np.empty(0, np.int64), np.empty(0, np.int64)
        for i, r in enumerate(rows):
            p, v = self.place[self.start[r]:self.start[r + 1]], self.add[self.start[r]:self.start[r + 1]]
            if alive is None:
                score[p] += v
                if rest[i + 1] < max(floor, int(score.max())):
                    have = np.flatnonzero(score)
                    kth = int(np.partition(score[have], len(have) - k)[len(have) - k]) if len(have) >= k else 0
                    if rest[i + 1] < max(floor, kth):
                        alive = have
            else:
                at = np.minimum(np.searchsorted(p, alive), len(p) - 1)
                hit = p[at] == alive
                score[alive[hit]] += v[at[hit]]
        if alive is None:
            alive = np.flatnonzero(score)
        return alive, score[alive]


class Best:
    """The k best of one item: score down, then doc up."""

    def __init__(self, k: int):
        self.k, self.doc, self.score = k, np.empty(0, np.int64), np.empty(0, np.int64)

    @property
    def floor(self) -> int:
        return int(self.score[-1]) if len(self.score) == self.k else 0

    def put(self, doc: np.ndarray, score: np.ndarray) -> None:
        good = (score >= self.floor) & (score > 0)
        doc, score = np.concatenate([self.doc, doc[good]]), np.concatenate([self.score, score[good]])
        order = np.lexsort((doc, -score))[:self.k]
        self.doc, self.score = doc[order], score[order]


def top_documents(spark: SparkSession, docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                  item_col: str = "item_id", item_text_col: str = "text", k: int = 50) -> DataFrame:
    """(item_id, rank, doc_id, score): the k best documents of each item with a score above 0."""
    docs = docs.select(F.col(id_col).cast("long").alias("doc"), F.col(text_col).cast("binary").alias("text"))
    items = items.select(F.col(item_col).cast("long").alias("item"), F.col(item_text_col).cast("binary").alias("text"))

    def split(b):
        rows = [(b.column(0)[i].as_py(), sorted(terms(b.column(1)[i].as_py() or b""))) for i in range(b.num_rows)]
        yield pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows], pa.int64()), pa.array([r[1] for r in rows], pa.list_(pa.binary()))], ["item", "terms"])
    asked = (map_arrow(items, split, "item long, terms array<binary>").select("item", F.explode("terms").alias("term"))
             .groupBy("item").agg(F.collect_set("term").alias("terms")))
    asked = stored(spark, asked, "items")
    groups = max(1, -(-asked.count() // ITEMS))
    found = None
    for g in range(groups):
        rows = asked.filter(F.pmod(F.xxhash64("item"), F.lit(groups)) == g).collect()
        part = _search(spark, docs, [(r["item"], [bytes(t) for t in r["terms"]]) for r in rows], k)
        found = part if found is None else found.unionByName(part)
    best = Window.orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
    some = (found.withColumn("salt", F.pmod(F.xxhash64("doc_id", "score"), F.lit(_SALTS)))
            .withColumn("rank", F.row_number().over(best.partitionBy("item_id", "salt"))).filter(F.col("rank") <= k))
    return (some.withColumn("rank", F.row_number().over(best.partitionBy("item_id")).cast("int")).filter(F.col("rank") <= k)
            .select("item_id", "rank", "doc_id", "score"))


def _search(spark: SparkSession, docs: DataFrame, asked: list[tuple], k: int) -> DataFrame:
    """(item_id, doc_id, score): of each task, the k best documents of each of these items."""
    vocab = {t: i for i, t in enumerate(sorted({t for _, ts in asked for t in ts}))}
    blocks = stored(spark, _inverted(docs, spark.sparkContext.broadcast(vocab)), "postings")
    total = blocks.agg(F.sum("n_docs"), F.sum("n_terms")).first()
    n, length = int(total[0] or 0), int(total[1] or 0)
    df = {r["t"]: r["df"] for r in blocks.select(F.explode(F.arrays_zip("term", "df")).alias("x"))
          .groupBy(F.col("x.term").alias("t")).agg(F.sum("x.df").alias("df")).collect()}
    weight = {t: math.floor(1000 * math.log((2 * n + 2) / (2 * d + 1))) for t, d in df.items()}
    queries = [(item, sorted((vocab[t] for t in ts if vocab[t] in df), key=lambda t: (df[t], t))) for item, ts in asked]
    shared = spark.sparkContext.broadcast((queries, weight))

    def run(batches):
        queries, weight = shared.value
        best = [Best(k) for _ in queries]
        for b in batches:
            for i in range(b.num_rows):
                docs_ = b.column(0)[i].values.fill_null(_LAST).to_numpy()
                cell = [b.column(c)[i].values.to_numpy() for c in range(1, 6)]
                block = Block(cell[0], docs_, *cell[1:], weight, n, length)
                for q, (_, ts) in enumerate(queries):
                    at, score = block.best(ts, k, best[q].floor)
                    if len(at):
                        best[q].put(docs_[at], score)
        doc = np.concatenate([x.doc for x in best]) if best else np.empty(0, np.int64)
        size = [len(x.doc) for x in best]
        if len(doc):
            yield pa.RecordBatch.from_arrays(
                [pa.array([item for (item, _), s in zip(queries, size) for _ in range(s)], pa.int64()),
                 pa.array(doc, mask=doc == _LAST), pa.array(np.concatenate([x.score for x in best]))], ["item_id", "doc_id", "score"])
    return blocks.select("docs", "term", "df", "place", "tf", "size").mapInArrow(run, "item_id long, doc_id long, score long")

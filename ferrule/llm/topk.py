"""Exact top-k inner products by a dual-tree search over cover trees.

Vectors are made integer, floor(scale * x), and hashed into blocks of some ``BLOCK`` rows; a task builds a cover
tree of each of its blocks (every node: a centre, the exact covering radius of its points, children
chosen farthest first until they cover half of it) and another of the queries.  Pairs of nodes are
visited best bound first; for centres a, b and covering radii r, s no product exceeds
a.b + |a| s + |b| r + r s, and where that is below the worst kth score of the query group the pair is
pruned.  What each task found best is merged by one grouped ranking.  Queries are broadcast in blocks of
at most ``QUERIES`` rows, so memory does not grow with the table; every row is searched.

Defined cases: vectors that are null or hold a null or non-finite component take no part, nor do
null ids; rows that share an id are candidates each, and none of them for a query of that id; equal queries
count once, and different queries of one id are ranked together; only vectors of the same length are compared; with fewer than k candidates all are returned;
equal scores go by the smaller id; other columns, whatever their names, are not read.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ferrule.llm.common import stored

BLOCK = 4096
QUERIES = 20_000
LEAF = 64
FAN_OUT = 16


class _Node:
    __slots__ = ("centre", "norm", "radius", "points", "children")

    def __init__(self, x: np.ndarray, points: np.ndarray, first: int):
        self.centre = x[first]
        self.norm = float(np.sqrt((self.centre ** 2).sum()))
        d = np.sqrt(((x[points] - self.centre) ** 2).sum(1))
        self.radius = float(d.max()) * (1 + 1e-12)
        self.points, self.children = points, []
        if len(points) <= LEAF or self.radius == 0:
            return
        chosen, nearest, owner = [first], d, np.zeros(len(points), np.int64)
        while len(chosen) < FAN_OUT and nearest.max() > self.radius / 2:
            new = int(nearest.argmax())
            away = np.sqrt(((x[points] - x[points[new]]) ** 2).sum(1))
            owner = np.where(away < nearest, len(chosen), owner)
            nearest = np.minimum(nearest, away)
            chosen.append(int(points[new]))
        self.children = [_Node(x, points[owner == k], c) for k, c in enumerate(chosen) if (owner == k).any()]


class _Best:
    """The k best of each query so far."""

    def __init__(self, n: int, k: int):
        self.k, self.kth = k, np.full(n, -np.inf)
        self.rows: list[list[tuple]] = [[] for _ in range(n)]

    def add(self, q: int, scores, ids) -> None:
        best = sorted(self.rows[q] + [(-int(s), int(i)) for s, i in zip(scores, ids)])[:self.k]
        self.rows[q] = best
        if len(best) == self.k:
            self.kth[q] = float(-best[-1][0])


def _search(qx, qids, tree_q, dx, dids, tree_d, best: _Best) -> None:
    def bound(a: _Node, b: _Node) -> float:
        v = float(a.centre @ b.centre) + a.norm * b.radius + b.norm * a.radius + a.radius * b.radius
        return v + 1e-9 * (abs(v) + a.norm * b.norm + 1)

    stack = [(bound(tree_q, tree_d), tree_q, tree_d)]
    while stack:
        top, a, b = stack.pop()
        q = a.points
        if top < best.kth[q].min():
            continue
        if not a.children and not b.children:
            s = qx[a.points] @ dx[b.points].T
            same = qids[a.points][:, None] == dids[b.points][None, :]
            good = (s >= best.kth[q][:, None]) & ~same
            for r in np.flatnonzero(good.any(1)):
                c = np.flatnonzero(good[r])
                if len(c) > 4 * best.k:              # ties with the kth stay
                    cut = np.partition(s[r, c], len(c) - best.k)[len(c) - best.k]
                    c = c[s[r, c] >= cut]
                best.add(int(q[r]), s[r, c], dids[b.points][c])
        elif b.children and (not a.children or b.radius >= a.radius):
            stack += sorted(((bound(a, c), a, c) for c in b.children), key=lambda x: x[0])
        else:
            stack += sorted(((bound(c, b), c, b) for c in a.children), key=lambda x: x[0])


def top_k(spark: SparkSession, vectors: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding", k: int = 5,
          every: int = 50, scale: int = 256) -> DataFrame:
    """(query_id, rank, vec_id, score): the k best of all other rows for each row whose id is divisible by ``every``."""
    x = F.col(vec_col).cast("array<double>")
    v = (vectors.select(F.col(id_col).cast("long").alias("id"), x.alias("x"))
         .filter("id is not null and x is not null and forall(x, v -> v is not null and not isnan(v) and abs(v) < double('Infinity'))")
         .select("id", F.transform("x", lambda c: F.floor(c * scale).cast("double")).alias("x")))
    # dealt by a row's number too, so that many equal rows do not make one block; stored, so the numbers stay
    v = stored(spark, v.withColumn("part", F.xxhash64("id", "x", F.monotonically_increasing_id())), "vectors")
    n, nq = v.agg(F.count("*"), F.count_if(F.col("id") % every == 0)).first()
    blocks, qblocks = max(1, -(-n // BLOCK)), max(1, -(-nq // QUERIES))
    dealt = v.withColumn("part", F.pmod("part", F.lit(blocks))).repartition(blocks, "part").sortWithinPartitions("part")
    found = None
    for qb in range(qblocks):
        rows = v.filter(f"id % {every} = 0").filter(F.pmod(F.xxhash64("id", F.lit(1)), F.lit(qblocks)) == qb).select("id", "x").distinct().collect()
        by_dim: dict[int, tuple[np.ndarray, np.ndarray]] = {}
        for dim in {len(r.x) for r in rows}:
            own = [r for r in rows if len(r.x) == dim]
            by_dim[dim] = (np.array([r.id for r in own], dtype=np.int64), np.array([r.x for r in own], dtype=np.float64).reshape(len(own), dim))
        queries = spark.sparkContext.broadcast(by_dim)

        def search(batches, queries=queries):
            trees, best = {}, {}
            for dim, (qids, qx) in queries.value.items():
                trees[dim] = _Node(qx, np.arange(len(qids)), 0)
                best[dim] = _Best(len(qids), k)

            def block(ids, xs):
                size = np.array([len(r) for r in xs])
                for dim in set(size.tolist()) & trees.keys():
                    own = np.flatnonzero(size == dim)
                    dids, dx = ids[own], np.array([xs[i] for i in own], dtype=np.float64).reshape(len(own), dim)
                    qids, qx = queries.value[dim]
                    exact = dim * np.abs(dx).max(initial=0) * np.abs(qx).max(initial=0) < 2.0 ** 53
                    if not exact:                            # beyond float64: Python integers
                        _search_exact(qx, qids, dx, dids, best[dim])
                    else:
                        _search(qx, qids, trees[dim], dx, dids, _Node(dx, np.arange(len(own)), 0), best[dim])

            key, ids, xs = None, [], []
            for b in batches:
                for p, i, r in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), b.column(2).to_numpy(zero_copy_only=False)):
                    if p != key and ids:
                        block(np.array(ids, dtype=np.int64), xs)
                        ids, xs = [], []
                    key = p
                    ids.append(i)
                    xs.append(r)
            if ids:
                block(np.array(ids, dtype=np.int64), xs)
            out = [(int(queries.value[dim][0][q]), i, -s) for dim in best for q, r in enumerate(best[dim].rows) for s, i in r]
            lim = (1 << 63) - 1
            if out:
                yield pa.RecordBatch.from_arrays([pa.array([o[0] for o in out], pa.int64()), pa.array([o[1] for o in out], pa.int64()),
                                                  pa.array([max(-lim, min(lim, o[2])) for o in out], pa.int64())], ["query_id", "vec_id", "score"])
        part = stored(spark, dealt.select("part", "id", "x").mapInArrow(search, "query_id long, vec_id long, score long"), "best")
        found = part if found is None else found.unionByName(part)
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")).cast("int")
    return found.withColumn("rank", rank).filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def _search_exact(qx, qids, dx, dids, best: _Best) -> None:
    """Components so large that float64 products are not exact: Python integers, one query at a time."""
    d = [[int(c) for c in row] for row in dx]
    for q, row in enumerate(qx):
        a = [int(c) for c in row]
        s = [sum(x * y for x, y in zip(a, r)) for r in d]
        keep = [j for j in range(len(d)) if dids[j] != qids[q]]
        best.add(q, [s[j] for j in keep], [dids[j] for j in keep])

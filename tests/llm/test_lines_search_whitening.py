"""Operators 11 to 13 against brute force on small rows: nulls, empty and long texts, ties, repeated rows, empty tables
and other columns with names that the operators use themselves."""

import collections
import hashlib
import math
import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from ferrule.checks.compare import duck
from ferrule.llm import lexical, line_dedup, queries, whitening

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
ASCII_LOWER = {c: c + 32 for c in range(65, 91)}
SPACE = "\x20\x09\x0a\x0b\x0c\x0d"


def docs(spark, rows):
    return spark.createDataFrame([(i, t, 1, 2, "x", 3, 4.0) for i, t in rows],
                                 "doc_id long, text string, row int, doc int, line string, shard int, score double")


def texts(seed, n=120):
    r = random.Random(seed)
    pool = [f"Shared line number {k} of the site" for k in range(12)] + ["short", "exactly10!", "ninechars", "Ä" * 9, "é" * 10, "", "  "]
    rows = []
    for i in range(n):
        own = [r.choice(pool) if r.random() < 0.6 else f"own line {r.randrange(10 ** 9)}" for _ in range(r.randrange(0, 9))]
        rows.append((i, "\n".join(r.choice(["", " ", "\t"]) + (x.upper() if r.random() < .2 and x.isascii() else x) + r.choice(["", "\r"]) for x in own)))
    rows += [(500, None), (501, ""), (502, "\n\n"), (503, "no end of line   "), (7, rows[7][1]), (7, "Shared line number 3 of the site"),
             (None, "Shared line number 4 of the site\nonly null ids hold this"), (None, "only null ids hold this"),
             (504, "twice in one text\ntwice in one text"), (505, "Non ASCII SPACE "), (506, "non ascii space "),
             (507, "x" * 200_000 + "\n" + "shared line NUMBER 1 of the site\n" * 3000)]
    r.shuffle(rows)
    return rows


def brute_lines(rows, least=10):
    def key(line):
        return line.strip(SPACE).translate(ASCII_LOWER)
    last = 2 ** 63 - 1
    owner = {}
    for i, t in rows:
        for line in (t or "").split("\n"):
            k = key(line)
            if len(k) >= least:
                owner[k] = min(owner.get(k, last), last if i is None else i)
    out = []
    for i, t in rows:
        ls = (t or "").split("\n")
        kept = [x for x in ls if not owner.get(key(x), last) < (last if i is None else i)]
        out.append((i, len(ls), len(ls) - len(kept), hashlib.sha256("\n".join(kept).encode()).hexdigest()))
    return collections.Counter(out)


@pytest.mark.parametrize("shard_keys,probes,chunk", [(line_dedup.SHARD_KEYS, line_dedup.PROBES, 1 << 16), (3, 5, 7)])
def test_line_dedup(spark, monkeypatch, shard_keys, probes, chunk):
    monkeypatch.setattr(line_dedup, "SHARD_KEYS", shard_keys)
    monkeypatch.setattr(line_dedup, "PROBES", probes)
    monkeypatch.setattr(line_dedup, "_CHUNK", chunk)
    rows = texts(1)
    got = line_dedup.digest(line_dedup.dedup_lines(spark, docs(spark, rows).repartition(5))).collect()
    assert collections.Counter(tuple(r) for r in got) == brute_lines(rows)
    assert line_dedup.digest(line_dedup.dedup_lines(spark, docs(spark, []))).count() == 0


def test_perfect_hash():
    a, b = (np.random.default_rng(s).integers(0, 1 << 63, 5000, dtype=np.uint64) for s in (3, 4))
    p = line_dedup.PerfectHash.build(a, b)
    assert sorted(p.slots(a, b).tolist()) == list(range(5000))
    other = p.slots(a, b + np.uint64(1))
    assert other.min() >= -1 and other.max() < 5000
    assert line_dedup.PerfectHash.build(a[:0], b[:0]).slots(a, b).tolist() == [-1] * 5000


@pytest.mark.parametrize("array", ["prints", "counts", "owners"])
def test_line_dedup_is_decided_by_the_arrays(spark, monkeypatch, array):
    """An index whose fingerprints, counts or owners are spoilt drops nothing."""
    index = line_dedup._index
    spoilt = {"prints": "transform(prints, x -> x + 1)", "counts": "transform(counts, x -> 1)", "owners": "transform(owners, x -> 9223372036854775807L)"}
    monkeypatch.setattr(line_dedup, "_index", lambda keys: index(keys).withColumn(array, F.expr(spoilt[array])))
    rows = texts(2, 40)
    assert sum(r[2] for r in brute_lines(rows)) > 0
    assert {r.n_dropped for r in line_dedup.dedup_lines(spark, docs(spark, rows)).collect()} == {0}


def brute_search(rows, items, k):
    have = [(i, collections.Counter(TERM.findall((t or "").translate(ASCII_LOWER)))) for i, t in rows]
    have = [(i, c) for i, c in have if c]
    n, length = len(have), sum(sum(c.values()) for _, c in have)
    df = collections.Counter(t for _, c in have for t in c)
    asked = collections.defaultdict(set)
    for i, t in items:
        asked[i] |= set(TERM.findall((t or "").translate(ASCII_LOWER)))
    out = []
    for item, ts in asked.items():
        scored = []
        for i, c in have:
            m = 100 - 50 + (50 * sum(c.values()) * n) // length
            s = sum(math.floor(1000 * math.log((2 * n + 2) / (2 * df[t] + 1))) * ((10 ** 9 * c[t]) // (1000 * c[t] + 20 * m)) for t in ts if t in c)
            if s > 0:
                scored.append((-s, 2 ** 63 if i is None else i, i))
        out += [(item, r, i, -s) for r, (s, _, i) in enumerate(sorted(scored, key=lambda x: x[:2])[:k], 1)]
    return collections.Counter(out)


def search_rows(seed, n=300):
    r = random.Random(seed)
    words = [f"t{int(r.paretovariate(0.6))}" for _ in range(4000)]
    rows = [(i, " ".join(r.choice(words) + r.choice(["", ".", ",", "-Ä"]) for _ in range(r.choice([0, 3, 30, 120])))) for i in range(n)]
    rows += [(900, None), (901, "..."), (902, "T1 " * 400_000), (5, rows[5][1]), (None, rows[9][1]), (None, rows[10][1]), (903, "été ÉTÉ t1_t2"), (904, rows[9][1])]
    items = [(j, " ".join(r.choice(words) for _ in range(r.choice([1, 5, 40])))) for j in range(25)]
    return rows, items + [(100, None), (101, ""), (102, "nowhere"), (3, "t1 t2 t3"), (None, "t2 été"), (103, "T1 t1, T1!")]


@pytest.mark.parametrize("k,block,items_block", [(50, 4096, 2000), (4, 37, 6)])
def test_lexical_search(spark, monkeypatch, k, block, items_block):
    monkeypatch.setattr(lexical, "BLOCK_DOCS", block)
    monkeypatch.setattr(lexical, "ITEMS", items_block)
    rows, items = search_rows(3)
    d = docs(spark, rows).repartition(4)
    it = spark.createDataFrame([(i, t, "x", 7) for i, t in items], "item_id long, text string, term string, rank int")
    got = lexical.top_documents(spark, d, it, k=k).collect()
    assert collections.Counter(tuple(r) for r in got) == brute_search(rows, items, k)
    assert lexical.top_documents(spark, docs(spark, []), it).count() == 0
    assert lexical.top_documents(spark, d, it.limit(0)).count() == 0


def test_no_accumulators_beyond_the_bound():
    """Rare term first; the frequent one can then reach no kth score, and only survivors are completed."""
    place = np.array([3, 8, *range(100)], dtype=np.int32)
    args = (np.array([0, 1]), np.arange(100), np.array([2, 100]), place, np.ones(102, np.int64), np.full(100, 10, np.int64), {0: 9000, 1: 100}, 100, 1000)
    at, score = lexical.Block(*args).best([0, 1], 2, 0)
    assert at.tolist() == [3, 8] and len(set(score.tolist())) == 1
    assert len(lexical.Block(*args).best([0, 1], 3, 0)[0]) == 100
    assert len(lexical.Block(*args).best([0, 1], 3, 10 ** 12)[0]) == 0


def whitened_rows(n=400, d=40, seed=5):
    g = np.random.default_rng(seed)
    x = g.normal(size=(n, d)) @ (g.normal(size=(d, d)) * np.linspace(0.2, 2, d))
    return [(i, v.tolist()) for i, v in enumerate(x)]


def vectors(spark, rows):
    return spark.createDataFrame([(i, v, 1, 2.0, "x") for i, v in rows], "vec_id long, embedding array<double>, idx int, n double, part string")


def test_whitening(spark, monkeypatch):
    monkeypatch.setattr(whitening, "_BLOCK_BYTES", 40 * 8 * 32)      # 13 row blocks
    rows = whitened_rows()
    rows += [(7, rows[7][1]), (None, rows[8][1]), (900, None), (901, [1.0, None] + [0.0] * 38), (902, [float("nan")] * 40), (903, [float("-inf")] * 40), (904, [])]
    good = [(i, v) for i, v in rows if v and all(c is not None and math.isfinite(c) for c in v)]
    x = [[math.floor(64 * c) + 1_000_000 for c in v] for _, v in good]
    n, s = len(x), [sum(c) for c in zip(*x)]
    z = np.array([[c - t / n for c, t in zip(v, s)] for v in x])
    values, axes = np.linalg.eigh(z.T @ z / n)
    values, axes = values[::-1], axes[:, ::-1]
    want = z @ axes / np.sqrt(values)
    out = whitening.whiten(spark, vectors(spark, rows).repartition(3)).collect()
    assert len(out) == len(good) * 32 and {r.n for r in out} == {n}
    assert max(r.identity_error for r in out) < 1e-9 and len({r.identity_error for r in out}) == 1
    by_id = collections.defaultdict(list)
    for r in out:
        by_id[r.vec_id].append(r)
    sign = {}
    for (i, _), v, w in zip(good, x, want):
        own = by_id[i]
        assert {int(r.deviation) for r in own} == {sum((n * c - t) ** 2 for c, t in zip(v, s))}
        for r in own:
            k = r.component - 1
            sign.setdefault(k, math.copysign(1, r.whitened * w[k]))
            assert abs(r.whitened - sign[k] * w[k]) < 1e-8
            assert abs(r.explained / (values[k] / values.sum()) - 1) < 1e-9


def test_whitening_without_variance_and_other_lengths(spark):
    assert whitening.whiten(spark, vectors(spark, [])).count() == 0
    assert whitening.whiten(spark, vectors(spark, [(1, [1.0, 2.0])])).count() == 0
    assert whitening.whiten(spark, vectors(spark, [(1, [1.0, 2.0])] * 5)).count() == 0
    out = whitening.whiten(spark, vectors(spark, [(i, [float(i), 3.0]) for i in range(10)] + [(20 + i, [float(i % 3)]) for i in range(9)])).collect()
    assert collections.Counter(r.component for r in out) == {1: 19}
    assert sorted({(r.n, round(r.explained, 9)) for r in out}) == [(9, 1.0), (10, 1.0)]


def test_whitening_deviation_beyond_64_bits(spark):
    rows = [(0, [0.0, 1e13]), (1, [1.0, -1e13]), (2, [5.0, 0.0])]
    x = [[math.floor(64 * c) + 1_000_000 for c in v] for _, v in rows]
    s = [sum(c) for c in zip(*x)]
    try:
        out = {r.vec_id: int(r.deviation) for r in whitening.whiten(spark, vectors(spark, rows)).collect()}
    except Exception as e:                                   # squares beyond 64 bits are an error, not a wrong number
        assert "OVERFLOW" in str(e).upper()
    else:
        assert out == {i: sum((3 * c - t) ** 2 for c, t in zip(v, s)) for (i, _), v in zip(rows, x)}


@pytest.mark.parametrize("name", ["op12_lexical_search", "op13_line_dedup"])
def test_sql_agrees(spark, name):
    sf = "/root/testdata/sf0.001"
    got = collections.Counter(tuple(r) for r in queries.QUERIES[name](spark, sf).collect())
    df = queries.QUERIES[name](spark, sf)
    want = duck(sf).execute(f"SELECT {', '.join(df.columns)} FROM ({queries.ORACLE[name]})").fetchall()
    assert got == collections.Counter(want)

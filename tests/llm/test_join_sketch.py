"""op2's sketches: what they rule out is ruled out rightly, and what they rule out moves no text."""

import itertools
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from ferrule.llm import jaccard_join
from ferrule.llm.common import Membership, mix


def _docs(spark, rows):
    return spark.createDataFrame(rows, "doc long, text string")


def _changed(r, words, k, mark):
    w = list(words)
    for i in r.sample(range(len(w)), k):
        w[i] = f"{mark}{i}"
    return w


def test_differing_places_never_exceed_the_difference():
    r = np.random.default_rng(3)
    for n, m in ((5, 6), (60, 70), (100, 200), (1000, 1100)):
        a = r.integers(0, 1 << 62, n, dtype=np.uint64)
        b = np.concatenate([a[:n // 2], r.integers(0, 1 << 62, m - n // 2, dtype=np.uint64)])
        x, y = jaccard_join.sketch(mix(a)), jaccard_join.sketch(mix(b))
        while len(y) > len(x):
            y = y[:len(y) // 2] ^ y[len(y) // 2:]
        differ = sum(int(v).bit_count() for v in (x ^ y).view(np.uint64))
        assert differ <= len(np.setxor1d(a, b))
        assert (differ - len(np.setxor1d(a, b))) % 2 == 0


@pytest.mark.parametrize("percent", [20, 85])
def test_sketches_keep_all_links_and_drop_most_others(spark, percent):
    r = random.Random(7)
    texts = {}
    for base in range(4):
        words = [f"b{base}w{k}" for k in range(400)]
        for k in range(8):                               # from equal to very different
            texts[len(texts)] = _changed(r, words, (0, 2, 5, 9, 20, 30, 60, 150)[k], f"x{len(texts)}_")
    texts[50], texts[51] = [f"s{k}" for k in range(63)], [f"s{k}" for k in range(303)]   # lengths more than twice apart
    rows = [(i, " ".join(w)) for i, w in texts.items()] + [(0, " ".join(texts[8])), (None, "a b c d e"), (60, None), (61, "")]
    sets = {}
    for i, t in rows:
        w = (t or "").split()
        if i is not None and w:
            sets.setdefault(i, []).append({tuple(w[j:j + 4]) for j in range(len(w) - 3)})
    t = jaccard_join.Threshold(percent)
    d = _docs(spark, rows)
    sig = jaccard_join._signatures(d, 4, t)
    every = [(a, b) for a, b in itertools.combinations(sorted(sets), 2)]
    pairs = spark.createDataFrame(every, "a long, b long")
    true = {(a, b) for a, b in every
            if any(100 * len(x & y) >= percent * len(x | y) for x in sets[a] for y in sets[b])}
    kept = {(x.a, x.b) for x in jaccard_join._may_link(spark, sig, pairs, t).collect()}
    assert true <= kept
    if percent == 85:
        assert len(kept) < len(true) + 20 < len(every) / 4   # before, the texts of all of them were moved
    else:
        assert (50, 51) in true
    assert {(x.a, x.b) for x in jaccard_join._verify(spark, d, sig, pairs, 4, t).collect()} == true


def test_whole_sets_need_one_worker_a_task_and_large_batches(spark):
    rows = [(i, f"a{i} b c d e f{i} g h") for i in range(600)] + [(None, "a b c d e"), (700, None), (701, "")]
    d = _docs(spark, rows)
    t = jaccard_join.Threshold(85)
    some = Membership(d.filter("doc < 300 or doc >= 700").select("doc"))
    late = np.sort(np.concatenate([s for _, s in jaccard_join.shingle_sets(
        d.filter("doc = 1").select("text").toArrow().column(0), 4)])[2:3])
    whole = jaccard_join._whole(d, some, late, 4, t)
    assert whole._jdf.queryExecution().executedPlan().toString().count("MapInArrow") == 1
    assert jaccard_join._whole_sets(d, some, 4)._jdf.queryExecution().executedPlan().toString().count("MapInArrow") == 1
    got = {x.doc: x.s for x in whole.groupBy("doc").agg(F.sort_array(F.collect_list("s")).alias("s")).collect()}
    text = d.filter("doc is not null").toArrow()
    want = {}
    for row, s in jaccard_join.shingle_sets(text.column("text"), 4):
        keep = np.isin(s, late)
        if len(s):
            want[text.column("doc")[row].as_py()] = sorted(np.concatenate([s[~keep], s[keep]])[:t.prefix(len(s))].tolist())
    assert set(got) >= set(range(300)) and all(got[i] == want[i] for i in got)

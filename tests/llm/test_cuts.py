"""Substring dedup on cases that one slice, one id or one anchor does not show."""

import collections
import hashlib
import random
import re

import pytest

from ferrule.llm import substring_dedup

WORD = re.compile(r"[^\x20\x09-\x0D]+")
WINDOW = substring_dedup.WINDOW


def _brute(rows):
    words = [(i, WORD.findall(t or "")) for i, t in rows]
    seen = collections.Counter(tuple(w[j:j + WINDOW]) for _, w in words for j in range(len(w) - WINDOW + 1))
    out = []
    for i, w in words:
        gone = [False] * len(w)
        for j in range(len(w) - WINDOW + 1):
            if seen[tuple(w[j:j + WINDOW])] > 1:
                gone[j:j + WINDOW] = [True] * WINDOW
        out.append((i, len(w), sum(gone), hashlib.sha256(" ".join(x for x, g in zip(w, gone) if not g).encode()).hexdigest()))
    return sorted(map(str, out))


@pytest.fixture(scope="module")
def cut_rows():
    """A passage that most texts hold, in other surroundings each; shared and null ids; odd separators."""
    r = random.Random(11)
    passage = [f"p{k}" for k in range(60)]
    rows = []
    for i in range(160):
        w = [f"w{r.randrange(10 ** 6)}" for _ in range(r.randint(0, 90))]
        if i % 4:
            at = r.randint(0, len(w))
            w[at:at] = passage
        sep = ["\n", "\t ", " ", "  "][i % 4]
        rows.append((None if i % 7 == 0 else i // 3, (" " if i % 5 == 0 else "") + sep.join(w) + ("\n" if i % 6 == 0 else "")))
    return [*rows, rows[1], rows[1], (7, None), (7, ""), (None, "é ß 日本 " * 40), (3, " ".join(passage[:35])), (3, " ".join(passage[:34]))]


@pytest.mark.parametrize("shard,hot", [(1000, 1000), (5, 1000), (1000, 1)])
def test_cuts_with_a_common_passage(spark, cut_rows, monkeypatch, shard, hot):
    monkeypatch.setattr(substring_dedup, "SHARD", shard)
    monkeypatch.setattr(substring_dedup, "HOT", hot)
    docs = spark.createDataFrame([(i, t, "x") for i, t in cut_rows], "doc_id long, text string, row string")
    out = substring_dedup.digest(substring_dedup.dedup(spark, docs)).collect()
    assert sorted(str(tuple(x)) for x in out) == _brute(cut_rows)


def test_cuts_over_several_slices(spark):
    r = random.Random(3)
    passage = " ".join(f"q{k}" for k in range(50))
    rows = [(i, " ".join(f"w{r.randrange(10 ** 7)}" for _ in range(400)) + (f" {passage} end{i}" if i % 9 == 0 else "")) for i in range(900)]
    rows.append((1000, " ".join(f"v{k}" for k in range(300_000)) + " " + passage))
    docs = spark.createDataFrame(rows, "doc_id long, text string").coalesce(1)      # a batch of some 5 MB
    out = substring_dedup.digest(substring_dedup.dedup(spark, docs)).collect()
    assert sorted(str(tuple(x)) for x in out) == _brute(rows)

"""What the pipeline's stages hold at once in a worker, and which rows they move."""

import random
import tracemalloc

import numpy as np
import pyarrow as pa

from ferrule.llm import common, decontaminate, jaccard_join, pieces
from ferrule.llm.common import GIVEN_ROWS, Membership, map_arrow, parts


def _index(text):
    return decontaminate._Index([(1, text)], decontaminate.Weights(1, np.empty(0, np.uint64), np.empty(0, np.int64)), 0.8, 23)


def _peak(index, texts):
    decontaminate._find(index, pa.array(texts))          # tables of powers
    tracemalloc.start()
    try:
        return decontaminate._find(index, pa.array(texts)), tracemalloc.get_traced_memory()[1] / 1e6
    finally:
        tracemalloc.stop()


def test_decontamination_holds_a_part_of_a_long_text():
    item = " ".join(f"w{k}" for k in range(40))
    half = item.split()[:20]
    # parts of the item at both ends and the whole of it in the middle: windows are far apart
    filler = [" ".join(f"{c}{k}" for k in range(15_000)) for c in "xy"]
    text = " ".join([*half, filler[0], item, filler[1], *half])
    found, mb = _peak(_index(item), [text, None, filler[0]])
    assert found == [[1], [], []]
    assert mb < 20                                       # 48 MB with all shingles' signs at once


def test_prints_are_the_same_over_parts(monkeypatch):
    item = " ".join(f"w{k % 17}" for k in range(60))
    r = random.Random(4)
    text = " ".join([*(f"w{r.randrange(17)}" for _ in range(3000)), item, *(f"w{r.randrange(17)}" for _ in range(3000))])
    index, h = _index(item), next(decontaminate._sets(pa.array([text])))[2]
    at = np.array(sorted(r.sample(range(len(h) - 56), 900)))
    whole = decontaminate.simhash(h, index.weight(h), at, 56).tolist()
    monkeypatch.setattr(decontaminate, "SPAN", 64)
    assert list(index._prints(h, at, 56)) == list(zip(at.tolist(), whole))
    assert decontaminate._find(index, pa.array([text])) == [[1]]


def test_decontamination_holds_a_slice_of_a_batch():
    texts = [" ".join(f"v{i}x{k}" for k in range(250)) for i in range(2000)]          # about 4 MB
    found, mb = _peak(_index("some words that no text of these has"), texts)
    assert not any(found)
    assert mb < 20                                       # 36 MB with slices of 1 MB


def test_workers_give_back_few_rows_at_once(spark):
    rows = spark.range(3 * GIVEN_ROWS).coalesce(1).selectExpr("id", "repeat('t', 9) as text")
    passed = Membership(rows.select("id")).rows(rows)
    assert passed.count() == 3 * GIVEN_ROWS
    kept = decontaminate.keep_clean(spark, rows, spark.createDataFrame([(1, "a b c d e f")], "item_id long, text string"))
    assert kept.count() == 3 * GIVEN_ROWS
    b = pa.RecordBatch.from_arrays([pa.array(range(3 * GIVEN_ROWS + 1))], ["n"])
    assert [p.num_rows for p in parts(b)] == [GIVEN_ROWS] * 3 + [1] and not list(parts(b.slice(0, 0)))


def test_keep_one_moves_only_doubtful_rows(spark):
    text = [" ".join(f"t{i % 90}w{k}" for k in range(30)) for i in range(100)]        # ten copies
    rows = [*((i, t) for i, t in enumerate(text)), (None, text[0]), (95, "other words of this id"), (3, text[3]), (5, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    want = sorted(map(str, [*rows[:90], (None, text[0]), (5, None)]))
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        assert sorted(str(tuple(x)) for x in jaccard_join.keep_one(spark, docs).collect()) == want
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
    gone = spark.range(90, 100).toDF("gone_")
    again = spark.createDataFrame([(3,), (5,), (95,)], "again_ long")
    sure, doubtful = jaccard_join._told_apart(docs, "doc_id", gone, again)
    ids = [x.doc_id for x in doubtful.collect()]
    assert sorted(ids) == [3, 3, 5, 5] and sure.count() == len(rows) - len(ids) - 11  # 11 rows surely go


def test_workers_get_few_bytes_at_once(spark, tmp_path):
    spark.range(3000).selectExpr("id", "repeat('some text', 900) as text").coalesce(1).write.parquet(f"{tmp_path}/rows")
    rows = spark.read.parquet(f"{tmp_path}/rows")                  # 24 MB, in Spark's form one batch

    def size(b):
        yield pa.RecordBatch.from_arrays([pa.array([b.num_rows]), pa.array([b.nbytes])], ["n", "size"])

    limit = "spark.sql.execution.arrow.maxBytesPerBatch"
    old = spark.conf.get(limit, None)
    spark.conf.unset(limit)
    try:
        got = map_arrow(rows, size, "n long, size long").collect()
        assert sum(x.n for x in got) == 3000
        assert max(x.size for x in got) < common.BATCH_BYTES + 20_000  # the last row may go beyond
        spark.conf.set(limit, "8m")                                # a limit of the session's own stays
        own = map_arrow(rows, size, "n long, size long").collect()
        assert 4_000_000 < max(x.size for x in own) < 8_500_000 and sum(x.n for x in own) == 3000
    finally:
        spark.conf.set(limit, old) if old else spark.conf.unset(limit)


def test_pieces_index_few_characters_at_once():
    import public_tokenizers

    model = pieces.Pieces(public_tokenizers.path("piece_bpe_32k.model"))
    r = random.Random(8)
    texts = [" ".join("".join(r.choices("abcdefghijklmnopqrstuvwxyz", k=9)) for _ in range(1000)) for _ in range(45)]
    tracemalloc.start()
    try:
        found = [x for some in pieces._slices(texts) for x in model.encode(some)]
        mb = tracemalloc.get_traced_memory()[1] / 1e6
    finally:
        tracemalloc.stop()
    assert [model.decode(x) for x in found] == texts
    assert mb < 45                                       # 73 MB with slices of 500,000 and indexes of 250,000 characters

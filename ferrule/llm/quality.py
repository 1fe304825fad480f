"""Quality classifier: regularised quadratic discriminant over transformed document statistics.

Each class has a Gaussian over ``FEATURES`` whose covariance is shrunk first towards the pooled one and
then towards a scaled identity; a document's score is the logistic of the difference of the two
log densities plus the log prior ratio.  The Mahalanobis terms use the inverse Cholesky factors, which
are computed once per model.  The sufficient statistics (count, sum, sum of products by class) are
added up by Spark over all labelled rows; only these few hundred numbers reach the driver.

Defined cases: null and empty texts have all-zero counts and get a score like any other text; a null
id never trains and is not held out; labels that are null or not 0/1 are ignored; a document with
several label rows counts once for each; without labelled rows every score is 0.5, with one class
only it is (n1 + 1) / (n + 2).  Other columns of the input are neither read nor changed.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StructField, StructType

from ferrule.llm.common import Words, crc_mod, give_back, map_batches, parts, slices, stored

#: Byte classes: lower, upper, digit, space, line end, sentence punctuation, other ASCII, non-ASCII.
_CLASS = np.full(256, 6, dtype=np.int64)
_CLASS[97:123] = 0
_CLASS[65:91] = 1
_CLASS[48:58] = 2
_CLASS[[32, 9, 11, 12, 13]] = 3
_CLASS[10] = 4
_CLASS[[ord(c) for c in ".,;:!?'\"-()"]] = 5
_CLASS[128:] = 7

#: Bytes of text handled at once.
SLICE = 1 << 18
FEATURES = ("log_bytes", "log_words", "upper", "digit", "space", "lines", "punctuation", "symbol", "non_ascii",
            "word_length", "word_length_spread", "distinct_words", "top_word", "distinct_pairs", "symbol_words",
            "byte_entropy")


def _share(a, n):
    """Square root of a share: a variance-stabilising transform of counts."""
    return np.sqrt(a / np.maximum(n, 1))


def features(column: pa.Array) -> np.ndarray:
    """One row of ``FEATURES`` for each text of the column; whole texts are counted."""
    out = []
    for a, b, data, off in slices(column, SLICE):
        m = b - a
        size = np.diff(off)
        doc = np.repeat(np.arange(m), size)
        hist = np.bincount(doc * 256 + data, minlength=m * 256).reshape(m, 256).astype(float)
        c = np.stack([hist[:, _CLASS == k].sum(1) for k in range(8)], 1)
        p = hist / np.maximum(size, 1)[:, None]
        entropy = -(p * np.log2(np.where(p > 0, p, 1))).sum(1)
        w = Words(data, off)
        n = np.diff(w.first)
        length = (w.ends - w.starts).astype(float)
        wdoc = np.repeat(np.arange(m), n)
        mean = np.bincount(wdoc, length, m) / np.maximum(n, 1)
        spread = np.sqrt(np.maximum(np.bincount(wdoc, length ** 2, m) / np.maximum(n, 1) - mean ** 2, 0))
        odd = np.concatenate([[0], np.cumsum(_CLASS[data] == 6)])
        odd_words = np.bincount(wdoc, odd[w.ends] > odd[w.starts], m)
        pairs = w.windows(2)
        distinct, top, two = np.zeros(m), np.zeros(m), np.zeros(m)
        for d in range(m):
            h = w.hash[w.first[d]:w.first[d + 1]]
            if len(h):
                _, k = np.unique(h, return_counts=True)
                distinct[d], top[d] = len(k), k.max()
                two[d] = len(np.unique(pairs[w.first[d]:w.first[d + 1] - 1])) if len(h) > 1 else 1
        out.append(np.stack([np.log1p(size), np.log1p(n), _share(c[:, 1], size), _share(c[:, 2], size),
                             _share(c[:, 3], size), _share(c[:, 4], size), _share(c[:, 5], size), _share(c[:, 6], size),
                             _share(c[:, 7], size), np.log1p(mean), np.log1p(spread), distinct / np.maximum(n, 1),
                             _share(top, n), two / np.maximum(n - 1, 1), _share(odd_words, n), entropy], 1))
    return np.concatenate(out) if out else np.zeros((0, len(FEATURES)))


@dataclass
class Discriminant:
    """Two Gaussians with cached inverse Cholesky factors; or a constant score."""

    constant: float | None = None
    mean: np.ndarray | None = None           # (2, d)
    whiten: np.ndarray | None = None         # (2, d, d): inverse Cholesky factors
    offset: np.ndarray | None = None         # (2,): log prior minus half the log determinant

    def score(self, x: np.ndarray) -> np.ndarray:
        if self.constant is not None:
            return np.full(len(x), self.constant)
        g = [self.offset[k] - 0.5 * (((x - self.mean[k]) @ self.whiten[k].T) ** 2).sum(1) for k in (0, 1)]
        return 1 / (1 + np.exp(-np.clip(g[1] - g[0], -35, 35)))


def fit(rows: DataFrame, to_pooled: float = 0.3, to_identity: float = 0.02) -> Discriminant:
    """Fit on a DataFrame (x array<double>, y int).  ``to_pooled`` and ``to_identity``: the shrinkages."""
    d = len(FEATURES)

    def sums(batches):
        acc = np.zeros((2, 1 + d + d * d))
        for b in batches:
            x = b.column("x").flatten().to_numpy(zero_copy_only=False).reshape(-1, d)
            y = b.column("y").to_numpy(zero_copy_only=False)
            for k in (0, 1):
                z = x[y == k]
                acc[k] += np.concatenate([[len(z)], z.sum(0), (z.T @ z).ravel()])
        k, i = np.nonzero(acc)
        yield pa.RecordBatch.from_arrays([pa.array(k.astype(np.int32)), pa.array(i.astype(np.int32)),
                                          pa.array(acc[k, i])], ["y", "i", "v"])

    acc = np.zeros((2, 1 + d + d * d))
    for r in rows.mapInArrow(sums, "y int, i int, v double").groupBy("y", "i").agg(F.sum("v").alias("v")).collect():
        acc[r.y, r.i] = r.v
    n = acc[:, 0]
    if min(n) < 2:
        return Discriminant(constant=0.5 if not n.sum() else float((n[1] + 1) / (n.sum() + 2)))
    mean = acc[:, 1:1 + d] / n[:, None]
    cov = [acc[k, 1 + d:].reshape(d, d) / n[k] - np.outer(mean[k], mean[k]) for k in (0, 1)]
    pooled = (n[0] * cov[0] + n[1] * cov[1]) / n.sum()
    ridge = np.diag(np.diag(pooled) + 1e-9)                # the identity in units of each statistic
    whiten, offset = [], []
    for k in (0, 1):
        s = (1 - to_pooled) * cov[k] + to_pooled * pooled
        chol = np.linalg.cholesky((1 - to_identity) * s + to_identity * ridge)
        whiten.append(np.linalg.inv(chol))
        offset.append(np.log(n[k] / n.sum()) - np.log(np.diag(chol)).sum())
    return Discriminant(mean=mean, whiten=np.stack(whiten), offset=np.array(offset))


def _with_features(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    def run(batches):
        for b in batches:
            if b.num_rows:
                x = features(b.column(1))
                yield pa.RecordBatch.from_arrays(
                    [b.column(0), pa.ListArray.from_arrays(pa.array(np.arange(len(x) + 1, dtype=np.int32) * x.shape[1]),
                                                           pa.array(x.ravel()))], ["id", "x"])
                give_back()
    return map_batches(docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("t")), run,
                       "id long, x array<double>")


def _labelled(feats: DataFrame, labels: DataFrame, label: str, folds: int, held: int) -> DataFrame:
    y = (labels.select(F.col("doc_id").cast("long").alias("id"), F.col(label).cast("int").alias("y"))
         .filter("y in (0, 1) and id is not null").filter(crc_mod(F.col("id"), folds) != held))
    return feats.join(y, "id").select("x", "y")


def score_documents(spark: SparkSession, docs: DataFrame, labels: DataFrame, id_col: str = "doc_id",
                    text_col: str = "text", label: str = "quality", folds: int = 3, held: int = 1) -> DataFrame:
    """(doc_id, held_out, score, predicted) of every row of ``docs``; learns from the other folds only."""
    feats = stored(spark, _with_features(docs, id_col, text_col), "quality")
    model = fit(_labelled(feats, labels, label, folds, held))

    def run(batches):
        for b in batches:
            if b.num_rows:
                x = b.column("x").flatten().to_numpy(zero_copy_only=False).reshape(-1, len(FEATURES))
                yield pa.RecordBatch.from_arrays([b.column("id"), pa.array(model.score(x))], ["doc_id", "score"])
    return feats.mapInArrow(run, "doc_id long, score double").select(
        "doc_id", F.coalesce(crc_mod(F.col("doc_id"), folds) == held, F.lit(False)).alias("held_out"), "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"))


def keep_good(spark: SparkSession, docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
              label: str = "quality", folds: int = 3, held: int = 1) -> DataFrame:
    """The rows of ``docs`` with a score of at least 0.5, all their columns unchanged."""
    y = labels.select(F.col("doc_id").cast("long").alias("id")).distinct()
    known = _with_features(docs, id_col, text_col).join(y, "id", "left_semi")
    model = fit(_labelled(stored(spark, known, "quality"), labels, label, folds, held))
    name = "score_"
    while name in docs.columns:
        name += "_"
    at = docs.columns.index(text_col)

    def run(batches):
        for b in batches:
            if b.num_rows:
                keep = pa.array(model.score(features(b.column(at))))
                yield from parts(pa.RecordBatch.from_arrays([*b.columns, keep], [*b.schema.names, name]))
                del b
                give_back()
    schema = StructType([*docs.schema.fields, StructField(name, DoubleType())])
    return map_batches(docs, run, schema).filter(F.col(name) >= 0.5).select(*docs.columns)

"""Language identification by language-bitmask n-gram filters.

Training counts the character 4-grams of each language (letters in lower case, anything else one
space) and keeps the ``per_language`` commonest of each language that are not far commoner in another one.
They go into one bit-sliced Bloom filter: a row of bits for each position, a bit for each language, so that the AND
of a gram's rows returns all languages that may contain it.  A text's languages are counted over all
its grams, each count is corrected for that language's false positives, (c - n f) / (1 - f), and the
largest wins; the score is its share of all corrected counts.

Training takes at most about ``train_docs`` labelled rows (those with the smallest id hashes); every
text is predicted from all of its grams.  The filter has a fixed size and is broadcast.

Defined cases: null text or a text without a letter is ``und`` with score 0; a null id never trains
and is not held out; a text none of whose grams is known gets the commonest trained language with
score 0; with no training rows every text is ``und``; ties go to the language commoner in training; repeated rows each have
their answer, an empty table has none, and other columns, whatever their names, are not read.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ferrule.llm.common import SLICE_BYTES, crc_mod, map_arrow, mix, signed, stored

GRAM = 4
_LETTER: np.ndarray | None = None


def _letters() -> np.ndarray:
    global _LETTER
    if _LETTER is None:
        _LETTER = np.fromiter((chr(c).isalpha() for c in range(0x110000)), dtype=bool, count=0x110000)
    return _LETTER


def grams(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row of each gram, gram fingerprint, row has a letter)."""
    parts = [(t or "").lower() for t in texts]
    size = np.fromiter((len(p) + 3 for p in parts), dtype=np.int64, count=len(parts))
    cp = np.frombuffer(("  " + "   ".join(parts) + " ").encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
    letter = _letters()[cp]
    row = np.repeat(np.arange(len(parts)), size)
    cp = np.where(letter, cp, np.uint32(32))
    start = np.concatenate([[0], np.cumsum(size)[:-1]])
    keep = letter.copy()
    keep[1:] |= letter[:-1]                                    # one space after each word,
    keep[start] = keep[start + 1] = True                       # two in front of the text
    has = np.bincount(row, letter, len(parts)) > 0
    cp, row = cp[keep].astype(np.uint64), row[keep]
    n = len(cp) - GRAM + 1
    if n <= 0:
        return np.empty(0, np.int64), np.empty(0, np.uint64), has
    g = cp[:n] | (cp[1:n + 1] << np.uint64(21)) | (cp[2:n + 2] << np.uint64(42))
    g = mix(g) + cp[3:n + 3] * np.uint64(0x9E3779B97F4A7C15)
    inside = row[:n] == row[GRAM - 1:]
    return row[:n][inside], mix(g[inside]), has


def _text_slices(column: pa.Array):
    a, texts, size = 0, [], 0
    for i, t in enumerate(column.to_pylist()):
        texts.append(t)
        size += len(t or "")
        if size >= SLICE_BYTES:
            yield a, texts
            a, texts, size = i + 1, [], 0
    if texts:
        yield a, texts


@dataclass
class LanguageFilter:
    languages: list[str]                     # commonest in training first
    bits: int                                # log2 of the number of rows
    rows: list[np.ndarray]                   # a word of bits for every 8 languages, one row for each position
    false_rate: np.ndarray
    hashes: int = 2

    def positions(self, g: np.ndarray):
        return [((g >> np.uint64(j * 24)) & np.uint64((1 << self.bits) - 1)).astype(np.int64) for j in range(self.hashes)]

    def counts(self, row: np.ndarray, g: np.ndarray, n: int) -> np.ndarray:
        at = self.positions(g)
        out = np.zeros((n, len(self.languages)))
        for w, rows in enumerate(self.rows):
            mask = rows[at[0]]
            for p in at[1:]:
                mask = mask & rows[p]
            for k in range(w * 8, min(w * 8 + 8, len(self.languages))):
                out[:, k] = np.bincount(row[(mask >> np.uint8(k - w * 8)) & np.uint8(1) != 0], minlength=n)
        return out

    def predict(self, texts: list[str | None]) -> tuple[list[str], np.ndarray]:
        row, g, has = grams(texts)
        n = len(texts)
        if not self.languages:
            return ["und"] * n, np.zeros(n)
        total = np.bincount(row, minlength=n)[:, None]
        c = np.maximum((self.counts(row, g, n) - total * self.false_rate) / (1 - self.false_rate), 0)
        best = c.argmax(1)
        s = c.sum(1)
        score = np.where(has & (s > 0), c.max(1) / np.where(s > 0, s, 1), 0.0)
        return [self.languages[b] if h else "und" for b, h in zip(best, has)], score


def fit(docs: DataFrame, train_docs: int = 20_000, per_language: int = 40_000, bits: int = 20) -> LanguageFilter:
    """Learn from (id, text, lang) rows.  ``per_language``: grams kept of each language (bounds the filter's fill)."""
    rows = docs.filter("text is not null and lang is not null and id is not null")
    n = rows.agg(F.count("*")).first()[0]
    if n > train_docs:
        rows = rows.filter(F.pmod(F.xxhash64("id"), F.lit(1_000_000)) < int(1_000_000 * train_docs / n) + 1)

    def count(b):
        langs = b.column(1).to_pylist()
        for a, texts in _text_slices(b.column(0)):
            row, g, _ = grams(texts)
            names = sorted(set(langs[a:a + len(texts)]))
            code = np.array([names.index(x) for x in langs[a:a + len(texts)]])[row]
            for k, name in enumerate(names):
                u, c = np.unique(g[code == k], return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array([name] * len(u), pa.string()), pa.array(signed(u)), pa.array(c)],
                                                 ["lang", "g", "c"])
    spark = docs.sparkSession
    counts = stored(spark, map_arrow(rows.select("text", "lang"), count, "lang string, g long, c long").groupBy("lang", "g").agg(
        F.sum("c").alias("c")), "grams")
    totals = {r.lang: r.c for r in counts.groupBy("lang").agg(F.sum("c").alias("c")).collect()}
    languages = sorted(totals, key=lambda x: (-totals[x], x))
    f = LanguageFilter(languages, bits, [np.zeros(1 << bits, np.uint8) for _ in range((len(languages) + 7) // 8)],
                       np.zeros(max(1, len(languages))))
    if not languages:
        return f
    share = counts.join(F.broadcast(spark.createDataFrame(list(totals.items()), "lang string, total long")), "lang").withColumn(
        "p", F.col("c") / F.col("total"))
    top = share.groupBy("g").agg(F.max("p").alias("most"))
    own = share.join(top, "g").filter("c >= 3 and p >= 0.1 * most")
    place = F.row_number().over(Window.partitionBy("lang").orderBy(F.desc("c"), "g"))
    kept = own.select("lang", "g", place.alias("place")).filter(F.col("place") <= per_language).select("lang", "g").toArrow()
    names, g = np.array(kept["lang"].to_pylist(), dtype=object), kept["g"].to_numpy().astype(np.int64).view(np.uint64)
    for k, name in enumerate(languages):
        for p in f.positions(g[names == name]):
            f.rows[k // 8][p] |= np.uint8(1 << (k % 8))
    f.false_rate = np.array([((f.rows[k // 8] >> np.uint8(k % 8)) & 1).mean() ** f.hashes for k in range(len(languages))])
    return f


def identify(spark: SparkSession, docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang",
             folds: int = 4, held: int = 2, train_docs: int = 20_000) -> DataFrame:
    """(doc_id, held_out, lang_pred, score) of every row of ``docs``; learns from the other folds only."""
    d = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"), F.col(lang_col).alias("lang"))
    model = spark.sparkContext.broadcast(fit(d.filter(crc_mod(F.col("id"), folds) != held), train_docs))

    def run(b):
        names, scores = [], []
        for _, texts in _text_slices(b.column(1)):
            x, s = model.value.predict(texts)
            names += x
            scores.append(s)
        yield pa.RecordBatch.from_arrays([b.column(0), pa.array(names, pa.string()), pa.array(np.concatenate(scores))],
                                         ["doc_id", "lang_pred", "score"])
    out = map_arrow(d.select("id", "text"), run, "doc_id long, lang_pred string, score double")
    return out.select("doc_id", F.coalesce(crc_mod(F.col("doc_id"), folds) == held, F.lit(False)).alias("held_out"), "lang_pred", "score")

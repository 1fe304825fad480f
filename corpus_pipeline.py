"""The training-data pipeline: five stages over ``documents``, each written and read again.

Every stage keeps all columns, whatever their names (the last has columns of its own), and gives an empty table for one.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from ferrule.llm import decontaminate, jaccard_join, pieces, quality, secrets
from ferrule.llm.common import stored, table


def quality_stage(spark, docs, sf_dir):
    """Documents that the classifier accepts.  Null and empty texts are scored like others; each repeated row is decided alike."""
    return quality.keep_good(spark, docs, table(spark, sf_dir, "labels"))


def dedup_stage(spark, docs, sf_dir):
    """One document of each group of near copies (five words, similarity 0.8): the least id.

    Rows with a null id stay, and so do null and empty texts, which are like nothing; of rows with one id and text one stays.
    """
    return jaccard_join.keep_one(spark, docs)


def decontamination_stage(spark, docs, sf_dir):
    """Documents that contain no benchmark item.  Null and empty texts contain none; null ids and repeated rows are decided by their text."""
    return decontaminate.keep_clean(spark, docs, table(spark, sf_dir, "benchmark"))


def secrets_stage(spark, docs, sf_dir):
    """All documents, with their credentials replaced by a mark; n_chars follows the new text.

    Every row stays; null and empty texts stay as they are (n_chars null and 0).
    """
    return secrets.redact(spark, docs).withColumn("n_chars", F.length("text").cast("long")).select(*docs.columns)


def tokens_stage(spark, docs, sf_dir):
    """(doc_id, n_tokens, ids, round_trip) of every document, one row each; null and empty texts have no ids."""
    import public_tokenizers

    return pieces.encode(docs, public_tokenizers.path("piece_bpe_32k.model"))


STAGES = [("quality", quality_stage), ("jaccard_dedup", dedup_stage), ("decontamination", decontamination_stage),
          ("secrets", secrets_stage), ("sentencepiece", tokens_stage)]


def run(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stored(spark, stage(spark, docs, sf_dir), name)
    return docs


ORACLE_SQL = None                      # trained models and a tokenizer: no SQL
QUERIES = {"pipeline": run}
ORACLE: dict[str, str] = {}

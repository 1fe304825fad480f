"""Tables stored with match keys, so that case-insensitive text filters reach the scan.

The source server compares text without regard to case and trailing blanks.  ``upper(rtrim(x)) IN (...)`` gives
the same answer on any table, but no Parquet reader can use it.  A table that is read often is therefore stored once
with a normalised copy of each text column that jobs filter on (``<column>__key``) and, inside each file, in the
order of those keys, so that row-group statistics are narrow.  ``ci_in(..., df=table)`` and its relatives then filter
on the stored key: a plain comparison, pushed to the scan.  Everything else about the table is unchanged
(``visible`` lists its own columns), and jobs give the same rows with and without keys.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession

from ferrule.functions.semantics import KEY_SUFFIX, ci_key

__all__ = ["with_match_keys", "store", "load", "visible"]


def with_match_keys(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    return df.withColumns({c + KEY_SUFFIX: ci_key(c) for c in cols})


def store(df: DataFrame, path: str, cols: Sequence[str], mode: str = "error") -> None:
    """Write ``df`` with match keys for ``cols``; rows are ordered by them within each file (no shuffle)."""
    keyed = with_match_keys(df, cols)
    keyed.sortWithinPartitions(*[c + KEY_SUFFIX for c in cols]).write.mode(mode).parquet(path)


def load(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def visible(df: DataFrame) -> list[str]:
    """The table's own columns, without match keys."""
    return [c for c in df.columns if not c.endswith(KEY_SUFFIX)]

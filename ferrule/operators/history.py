"""Status histories and point-in-time snapshots.

Histories hold many rows per key with an effective timestamp.  The operators reduce them to one
(or a few tied) rows per key *before* anything is joined, so later joins see one row per key:

* ``latest_per_key`` keeps the rows with the greatest order value per key, ties kept.  It is a
  ``rank() = 1`` filter, which Spark plans as a partial ``WindowGroupLimit`` before the shuffle:
  each map task forwards only its own top-ranked rows per key, so a key holding a third of all rows
  ships a handful of rows, not a third of the table.
* ``snapshots`` takes the state of every key at several points in time in one grouped pass, without a window and a
  scan for each date.
* ``conditional_max`` / ``window_bounds_agg`` compute several MIN/MAX-with-a-condition columns in a
  single ``groupBy`` (partial aggregation on the map side), instead of one aggregate + join each.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ferrule.functions.semantics import col_, date_lit, ts_lit

__all__ = ["latest_per_key", "snapshot", "snapshots", "conditional_max", "window_bounds_agg", "compare_snapshots", "compare_states"]


def _keys(keys) -> list[str]:
    return [keys] if isinstance(keys, str) else list(keys)


def latest_per_key(df: DataFrame, keys, order_col, ties: bool = True) -> DataFrame:
    """Rows whose ``order_col`` is the greatest of their key.

    ``ties=True`` keeps every tied row (the semantics of a self-join on the group max);
    ``ties=False`` keeps one row per key (then add a tie-break column to ``order_col`` for a
    deterministic pick: pass a list ``[order_col, tie_break]``).
    """
    order = [col_(c).desc() for c in (order_col if isinstance(order_col, (list, tuple)) else [order_col])]
    w = Window.partitionBy(*_keys(keys)).orderBy(*order)
    fn = F.rank() if ties else F.row_number()
    return df.withColumn("_r", fn.over(w)).where(F.col("_r") == 1).drop("_r")


def _until(eff_col, as_of) -> Column:
    if isinstance(as_of, dt.datetime):
        return col_(eff_col) <= ts_lit(as_of)
    return col_(eff_col).cast("date") <= date_lit(as_of)


def snapshot(df: DataFrame, key, eff_col: str, as_of, ties: bool = True, tie_break=None) -> DataFrame:
    """State of every key as of a point in time: latest row with ``eff_col <= as_of``.

    ``as_of`` is a date (or a date Column, e.g. a scalar subquery) -> the whole day is included,
    or a datetime -> compared as a timestamp.  ``ties=False`` keeps one row per key, picked by the
    greatest ``tie_break`` among tied rows.  The filter is a plain comparison on the stored column,
    so it reaches the Parquet scan (and partition pruning when the history is stored partitioned by
    effective month).
    """
    cond = _until(eff_col, as_of)
    order = [eff_col] + ([tie_break] if tie_break is not None else [])
    return latest_per_key(df.where(cond), key, order, ties=ties)


def snapshots(df: DataFrame, key, eff_col: str, as_of: Mapping[str, object], cols: Sequence[str], tie_break=None) -> DataFrame:
    """State of every key at each of the named points in time: (key, <name> struct of ``cols``), NULL where a key
    has no row yet.

    One scan and one grouping: for each date ``max_by(cols, (eff, tie_break))`` over the rows up to it, with partial
    aggregation, so a key with a third of all rows sends one row from each task.  The filter on the latest date
    reaches the scan.  Tied rows count once, as ``snapshot(ties=False)`` does.
    """
    order = F.struct(col_(eff_col), *([] if tie_break is None else [col_(tie_break)]))
    until = {name: _until(eff_col, a) for name, a in as_of.items()}
    state = F.struct(*[col_(c) for c in cols])
    return (df.where(reduce(Column.__or__, until.values())).groupBy(*_keys(key))
            .agg(*[F.max_by(state, F.when(cond, order)).alias(name) for name, cond in until.items()]))


def compare_states(df: DataFrame, key, eff_col: str, new, old, cols: Sequence[str], tie_break=None,
                   new_prefix: str = "new_", old_prefix: str = "old_") -> DataFrame:
    """``compare_snapshots`` of two dates of one history, read once: keys with a state at ``new``."""
    s = snapshots(df, key, eff_col, {"_new": new, "_old": old}, cols, tie_break).where(F.col("_new").isNotNull())
    return s.select(*_keys(key), *[F.col(f"_new.{c}").alias(new_prefix + c) for c in cols],
                    *[F.col(f"_old.{c}").alias(old_prefix + c) for c in cols])


def conditional_max(df: DataFrame, keys, value_col, conditions: Mapping[str, Column | None]) -> DataFrame:
    """One pass: ``max(value) filter (where cond)`` for each named condition, grouped by key."""
    v = col_(value_col)
    aggs = [F.max(v if cond is None else F.when(cond, v)).alias(name) for name, cond in conditions.items()]
    return df.groupBy(*_keys(keys)).agg(*aggs)


def window_bounds_agg(df: DataFrame, keys, date_col, lo, hi, min_name: str = "min_date",
                      max_name: str = "max_date") -> DataFrame:
    """First and last ``date_col`` per key whose calendar date lies in ``[lo, hi]`` (one pass).

    ``CAST(ts AS DATE) BETWEEN lo AND hi`` is unwrapped by Catalyst into a half-open timestamp range
    and pushed to the Parquet scan.
    """
    d = col_(date_col)
    inside = d.cast("date").between(date_lit(lo), date_lit(hi))
    return (df.where(inside).groupBy(*_keys(keys))
            .agg(F.min(d).alias(min_name), F.max(d).alias(max_name)))


def compare_snapshots(new: DataFrame, old: DataFrame, key, cols: Sequence[str],
                      new_prefix: str = "new_", old_prefix: str = "old_") -> DataFrame:
    """Join two snapshots of the same keys (e.g. month end vs month start), old side optional."""
    keys = _keys(key)
    n = new.select(*keys, *[F.col(c).alias(new_prefix + c) for c in cols])
    o = old.select(*keys, *[F.col(c).alias(old_prefix + c) for c in cols])
    return n.join(o, keys, "left")

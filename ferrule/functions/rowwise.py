"""Row-wise aggregates over a set of columns (MAX/MIN/COUNT over a per-row VALUES list)."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from ferrule.functions.semantics import ci_in, col_

__all__ = ["row_max", "row_min", "row_count", "by_kind"]


def row_max(cols: Sequence) -> Column:
    """Greatest non-NULL value of the columns; all NULL -> NULL."""
    cols = [col_(c) for c in cols]
    return cols[0] if len(cols) == 1 else F.greatest(*cols)


def row_min(cols: Sequence) -> Column:
    cols = [col_(c) for c in cols]
    return cols[0] if len(cols) == 1 else F.least(*cols)


def row_count(cols: Sequence) -> Column:
    """Number of non-NULL values among the columns."""
    out = None
    for c in cols:
        t = col_(c).isNotNull().cast("int")
        out = t if out is None else out + t
    return out


def by_kind(kind, sets: Mapping[str, Sequence], default: Sequence, fn: Callable[[Sequence], Column]) -> Column:
    """Apply ``fn`` to a column set chosen by the row's kind (case-insensitive), else ``default``."""
    expr = None
    for value, cols in sets.items():
        cond = ci_in(kind, [value])
        expr = F.when(cond, fn(cols)) if expr is None else expr.when(cond, fn(cols))
    return expr.otherwise(fn(default)) if expr is not None else fn(default)

"""Ordered decision tables compiled to one CASE expression.

A rule table is data: an ordered list of ``Rule(condition, label)``.  ``first_match`` compiles it to
``CASE WHEN .. THEN .. END`` (first true condition wins; a NULL condition counts as false), and
``rule_hits`` uses the same list to count how many rows each rule decided, which proves which rules
are live and which are dead on a data set.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ferrule.functions.semantics import col_

__all__ = ["Rule", "first_match", "rule_index", "band", "rule_hits"]


@dataclass(frozen=True)
class Rule:
    when: Column
    label: str | None
    name: str = ""


def first_match(rules: Sequence[Rule], default: str | Column | None = None) -> Column:
    expr = None
    for r in rules:
        val = F.lit(r.label)
        expr = F.when(r.when, val) if expr is None else expr.when(r.when, val)
    if default is None:
        return expr
    return expr.otherwise(default if isinstance(default, Column) else F.lit(default))


def rule_index(rules: Sequence[Rule]) -> Column:
    """1-based number of the rule that decides the row; 0 = fell through to the default."""
    expr = None
    for i, r in enumerate(rules, start=1):
        expr = F.when(r.when, F.lit(i)) if expr is None else expr.when(r.when, F.lit(i))
    return expr.otherwise(F.lit(0))


def band(c, bands: Sequence[tuple], default: str | None = "Error") -> Column:
    """Classify into closed bands ``(lo, hi, label)``; ``None`` = unbounded.  Gaps fall to default.

    Unlike ``Bucketizer`` this keeps gaps (96.495 lies in no band) and NULL goes to ``default``.
    """
    c = col_(c)
    rules = []
    for lo, hi, label in bands:
        cond = None
        if lo is not None:
            cond = c >= F.lit(lo)
        if hi is not None:
            h = c <= F.lit(hi)
            cond = h if cond is None else (cond & h)
        rules.append(Rule(cond if cond is not None else F.lit(True), label))
    return first_match(rules, default)


def rule_hits(df: DataFrame, rules: Sequence[Rule], table: str = "", n: Column | None = None) -> DataFrame:
    """Rows decided by each rule: (table, rule, label, n); rule 0 is the ELSE branch.

    ``n``: how many rows each row stands for (default one).  One aggregation with map-side combine, so a
    dominant rule costs no more than a rare one.
    """
    labels = F.create_map(*[x for i, r in enumerate(rules, start=1)
                            for x in (F.lit(i), F.lit(r.label))])
    return (df.select(rule_index(rules).alias("rule"), (F.lit(1) if n is None else n).cast("long").alias("n"))
            .groupBy("rule").agg(F.sum("n").alias("n"))
            .select(F.lit(table).alias("table"), "rule",
                    F.coalesce(labels[F.col("rule")], F.lit("ELSE")).alias("label"), "n"))

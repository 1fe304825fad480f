"""Bonus scrub: first/last submission and last denial per loan inside a month, then a final status.

Plan: both per-loan aggregates are computed *before* the join (one grouped pass over submissions
for first and last, one over denials), so the status snapshot is joined to at most one row per loan
from each side.  The snapshot is the driving table and stays unshuffled when the others are small
enough for AQE to broadcast.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ferrule.functions.rules import Rule, first_match, rule_hits
from ferrule.operators.history import snapshot, window_bounds_agg

# Fixed values of the report.
RESOLVED_CODE = 72
DEFAULT_START = dt.date(2020, 2, 1)
DEFAULT_END = dt.date(2020, 2, 29)


def final_status_rules() -> list[Rule]:
    code, last = F.col("status_code"), F.col("max_submitted")
    return [
        Rule(code == RESOLVED_CODE, "Resolved", "code 72"),
        Rule((code == 0) & last.isNotNull(), "Resolved", "code 0 with a submission"),
        Rule(code != 0, "Resolved", "any other code"),
    ]


def status_as_of(tables: dict[str, DataFrame], end) -> DataFrame:
    """The status snapshot as of ``end``: given directly (``status_snapshot``), or taken from a
    ``status_history`` (loan_nbr, status_code, status_description, eff_dttm) as the latest row per
    loan on or before that day (one row per loan; the greatest status code breaks ties)."""
    if "status_snapshot" in tables:
        return tables["status_snapshot"]
    h = tables["status_history"]
    return snapshot(h, "loan_nbr", "eff_dttm", end, ties=False, tie_break="status_code") \
        .select("loan_nbr", "status_code", "status_description")


def rule_coverage(tables: dict[str, DataFrame], start=DEFAULT_START, end=DEFAULT_END) -> DataFrame:
    """Rows decided by each final-status rule (rule 0 = ELSE, 'Pending')."""
    return rule_hits(run(tables, start, end, ordered=False), final_status_rules(), "BONUS")


def run(tables: dict[str, DataFrame], start=DEFAULT_START, end=DEFAULT_END, ordered: bool = True) -> DataFrame:
    """tables: ``status_snapshot`` (loan_nbr, status_code, status_description) as of ``end`` or a
    ``status_history`` to take it from, ``submissions`` (loan_nbr, dt_sbmt_to_hud),
    ``denials`` (loan_nbr, hud_prelim_ttl_dny_dt)."""
    subs = window_bounds_agg(tables["submissions"], "loan_nbr", "dt_sbmt_to_hud", start, end,
                             "min_submitted", "max_submitted")
    den = (tables["denials"].where(F.col("hud_prelim_ttl_dny_dt").isNotNull())
           .transform(lambda d: window_bounds_agg(d, "loan_nbr", "hud_prelim_ttl_dny_dt", start, end,
                                                  "_first_denial", "denial_dt"))
           .drop("_first_denial"))
    out = (status_as_of(tables, end).join(subs, "loan_nbr", "left").join(den, "loan_nbr", "left")
           .select("loan_nbr", "status_code", "status_description", "min_submitted", "max_submitted",
                   F.col("denial_dt").cast("date").alias("denial_dt"),
                   first_match(final_status_rules(), "Pending").alias("final_status")))
    if ordered:
        # two status values: the loan number keeps the range partitioning of the sort balanced
        out = out.orderBy(F.col("final_status"), F.col("status_code").desc(), F.col("max_submitted").desc(),
                          F.col("loan_nbr"))
    return out

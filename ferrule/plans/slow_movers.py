"""Slow movers: exceptions of the month (loss drafts, forced insurance, repayment issues) with the
loan's month-end and month-start snapshot, the latest status row of each exception, and when it was
last opened / closed.

Plan: the qualifying history is filtered once (filter + date bound reach the scan); one grouped
pass computes the last effective time, the last open-status time and the last close inside the
period per exception (map-side partial aggregation, so a hot exception costs one row per task);
the latest status rows come from ``rank() = 1`` (partial WindowGroupLimit before the shuffle).  Both
are hash-partitioned on ``excp_id`` and join without a new exchange; only then is the result joined
to the loans' states at both ends of the period, which one grouped pass over the loan history gives.
"""

from __future__ import annotations


from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ferrule.functions.semantics import ci_in, ci_not_in, date_lit, yyyymmdd
from ferrule.operators.history import latest_per_key, snapshots

# ---- fixed values of the report ---------------------------------------------------------------
CLOSED_STATUSES = ("RESOLVED", "CLOSED", "NOT VALID", "CLOSED WITH VENDOR", "INCURABLE")
DOCUMENTS = ("Loss Draft",)
ISSUES = ("Forced Placed Insurance", "Not enough repays")
NO_EXCEPTION = "No Exception"


def period_bounds(business_dates: DataFrame, as_of, date_col: str = "bus_proc_dt",
                  strict_year: bool = False) -> DataFrame:
    """One row (bom, eom, bom_int, eom_int) for the month before ``as_of``.

    bom = first day of the previous month (correct in January, unlike text built from month-1).
    eom = last business date whose month is the previous month; as written that is *any year*
    (in January: December); ``strict_year=True`` restricts it to the previous month itself.
    """
    a = date_lit(as_of)
    bom = F.trunc(F.add_months(a, -1), "MM")
    d = F.col(date_col)
    if strict_year:
        cond = d.cast("date").between(bom, F.last_day(bom))
    else:
        cond = F.month(d) == F.month(F.add_months(a, -1))
    eom = business_dates.agg(F.max(F.when(cond, d)).cast("date").alias("eom"))
    return eom.select(bom.alias("bom"), "eom", yyyymmdd(bom).alias("bom_int"), yyyymmdd(F.col("eom")).alias("eom_int"))


def run_for_month(tables: dict[str, DataFrame], as_of, strict_year: bool = False,
                  eom_inclusive: bool = False) -> DataFrame:
    """The whole report for the month before ``as_of``, bounds taken from ``business_dates``.

    Like the report's ``SET @EOM = (SELECT MAX(...))``, the one-row bounds aggregate is read once
    and its two dates become literals: every later filter on the effective time then reaches the
    Parquet scan (and prunes month partitions), which a scalar subquery in each filter would not.
    """
    b = period_bounds(tables["business_dates"], as_of, strict_year=strict_year).first()
    return run(tables, b["bom"], b["eom"], eom_inclusive)


def qualifying_history(history: DataFrame, eom) -> DataFrame:
    cond = (ci_in("doc_desc", DOCUMENTS, history) | ci_in("issu_desc", ISSUES, history)) & \
        (F.col("eff_dttm").cast("date") <= date_lit(eom))
    return history.where(cond)


def exception_bounds(hist: DataFrame, bom, eom) -> DataFrame:
    """Per exception: last effective time, last open-status time, last close inside [bom, eom]."""
    eff, st = F.col("eff_dttm"), F.col("excp_sts_desc")
    closed_in = ci_in(st, CLOSED_STATUSES) & eff.cast("date").between(date_lit(bom), date_lit(eom))
    return hist.groupBy("excp_id").agg(F.max(eff).alias("end_excp"),
                                        F.max(F.when(ci_not_in(st, CLOSED_STATUSES), eff)).alias("open_excp"),
                                        F.max(F.when(closed_in, eff)).alias("close_excp"))


def loan_states(tables: dict[str, DataFrame], bom, eom) -> DataFrame:
    """(loan_nbr, eom_mca, eom_loan_status, bom_mca) of the loans known at the end of the period."""
    if "eom_loans" in tables:
        end = tables["eom_loans"].select("loan_nbr", F.col("mca_percent").alias("eom_mca"), F.col("loan_status").alias("eom_loan_status"))
        return end.join(tables["bom_loans"].select("loan_nbr", F.col("mca_percent").alias("bom_mca")), "loan_nbr", "left")
    h = tables["loan_history"]
    both = snapshots(h, "loan_nbr", "eff_dttm", {"eom": eom, "bom": bom}, ["mca_percent", "loan_status"],
                     tie_break="seq" if "seq" in h.columns else None)
    return both.where(F.col("eom").isNotNull()).select(
        "loan_nbr", F.col("eom.mca_percent").alias("eom_mca"), F.col("eom.loan_status").alias("eom_loan_status"),
        F.col("bom.mca_percent").alias("bom_mca"))


def run(tables: dict[str, DataFrame], bom, eom, eom_inclusive: bool = False) -> DataFrame:
    """tables: ``exception_history`` (excp_id, loan_nbr, doc_desc, issu_desc, excp_sts_desc,
    eff_dttm, excp_rqst_dttm), and the loans at both ends of the period: ``eom_loans`` (loan_nbr, mca_percent,
    loan_status) and ``bom_loans`` (loan_nbr, mca_percent) as the warehouse's snapshot functions give them, or a
    ``loan_history`` (loan_nbr, mca_percent, loan_status, eff_dttm, and ``seq`` to order rows of one time)
    from which both are taken in one pass.

    ``bom``/``eom`` are dates or date Columns (e.g. ``period_bounds(...).select('eom').scalar()``).
    As written, a close during the EOM day after midnight is dropped (the close time is compared
    with EOM midnight); ``eom_inclusive=True`` keeps it.
    """
    hist = qualifying_history(tables["exception_history"], eom)
    latest = latest_per_key(hist, "excp_id", "eff_dttm", ties=True)
    bounds = exception_bounds(hist, bom, eom)
    close = F.col("close_excp")
    if eom_inclusive:
        in_period = close.cast("date").between(date_lit(bom), date_lit(eom))
    else:
        in_period = close.between(date_lit(bom).cast("timestamp_ntz"), date_lit(eom).cast("timestamp_ntz"))
    keep = in_period | (close.isNull() & ci_not_in("excp_sts_desc", CLOSED_STATUSES))
    j = latest.join(bounds, "excp_id", "inner").where(keep).join(loan_states(tables, bom, eom), "loan_nbr", "inner")
    return j.select("loan_nbr", "eom_mca", "eom_loan_status", "bom_mca", "excp_id",
                    date_lit(bom).alias("month"), F.coalesce(F.col("doc_desc"), F.lit(NO_EXCEPTION)).alias("doc_desc"),
                    "issu_desc", "excp_sts_desc", "eff_dttm",
                    F.coalesce(F.col("open_excp"), F.col("excp_rqst_dttm")).alias("open_excp"), "close_excp").distinct()

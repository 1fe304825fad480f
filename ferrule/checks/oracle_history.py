"""DuckDB oracle for the slow-mover report and the history operators: one windowed pass over the exception
history, one grouped pass over the loan history."""

from __future__ import annotations

from ferrule.checks.oracle_letters import ci, up
from ferrule.checks.oracle_views import with_views

BOM, EOM = "DATE '2024-01-10'", "DATE '2024-01-20'"
CLOSED = up("RESOLVED", "CLOSED", "NOT VALID", "CLOSED WITH VENDOR", "INCURABLE")


def _state(name: str, d: str) -> str:
    return f"arg_max(row(mca_percent, loan_status), row(eff_dttm, seq)) FILTER (CAST(eff_dttm AS DATE) <= {d}) AS {name}"


def states(new: str, old: str) -> str:
    """Every loan's state at two dates, from one grouping."""
    return f"""SELECT loan_nbr, a[1] AS new_mca_percent, a[2] AS new_loan_status, b[1] AS old_mca_percent, b[2] AS old_loan_status
FROM (SELECT loan_nbr, {_state('a', new)}, {_state('b', old)} FROM v_loan_history GROUP BY loan_nbr) WHERE a IS NOT NULL"""


def slow_sql(bom: str, eom: str) -> str:
    closed = f"{ci('excp_sts_desc')} IN ({CLOSED})"
    return f"""SELECT DISTINCT loan_nbr, new_mca_percent AS eom_mca, new_loan_status AS eom_loan_status, old_mca_percent AS bom_mca, excp_id,
 {bom} AS month, coalesce(doc_desc, 'No Exception') AS doc_desc, issu_desc, excp_sts_desc, eff_dttm,
 coalesce(last_open, excp_rqst_dttm) AS open_excp, last_closed AS close_excp
FROM (SELECT *, max(eff_dttm) OVER each AS newest, max(eff_dttm) FILTER (NOT is_closed) OVER each AS last_open,
       max(eff_dttm) FILTER (is_closed AND CAST(eff_dttm AS DATE) >= {bom}) OVER each AS last_closed
      FROM (SELECT *, {closed} AS is_closed FROM v_exception_history
            WHERE CAST(eff_dttm AS DATE) <= {eom} AND excp_id IS NOT NULL
             AND ({ci('doc_desc')} = 'LOSS DRAFT' OR {ci('issu_desc')} IN ('FORCED PLACED INSURANCE', 'NOT ENOUGH REPAYS')))
      WINDOW each AS (PARTITION BY excp_id)) AS h
JOIN ({states(eom, bom)}) AS s USING (loan_nbr)
WHERE eff_dttm = newest AND CASE WHEN last_closed IS NULL THEN NOT is_closed ELSE last_closed <= CAST({eom} AS TIMESTAMP) END"""


SLOW = slow_sql(BOM, EOM)
# month before 2024-02-15: first of January, and the last January processing date (any year)
MONTH_BOM = "DATE '2024-01-01'"
MONTH_EOM = "(SELECT CAST(max(bus_proc_dt) AS DATE) FROM v_event_dates WHERE month(bus_proc_dt) = 1)"

ORACLE = {
    "period_bounds": with_views("""SELECT DATE '2001-08-01' AS bom, eom,
 CAST(strftime(DATE '2001-08-01', '%Y%m%d') AS INTEGER) AS bom_int, CAST(strftime(eom, '%Y%m%d') AS INTEGER) AS eom_int
FROM (SELECT CAST(max(bus_proc_dt) AS DATE) AS eom FROM v_business_dates WHERE month(bus_proc_dt) = month(DATE '2001-09-01') - 1)"""),
    "latest_per_key": with_views("SELECT * FROM v_exception_history QUALIFY rank() OVER (PARTITION BY excp_id ORDER BY eff_dttm DESC) = 1"),
    "snapshot_compare": with_views(states(EOM, BOM)),
    "snapshot_parameters": with_views(f"""SELECT loan_nbr, new_mca_percent AS eom_mca, old_mca_percent AS bom_mca,
 new_mca_percent - old_mca_percent AS change FROM ({states(EOM, BOM)}) AS s"""),
    "slow_movers": with_views(SLOW),
    "slow_movers_month": with_views(slow_sql(MONTH_BOM, MONTH_EOM)),
}

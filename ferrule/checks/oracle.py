"""DuckDB oracle SQL for every registered query, written independently of the jobs."""

from __future__ import annotations

from ferrule.checks.oracle_views import with_views
from ferrule.checks.oracle_letters import ORACLE as _LETTERS
from ferrule.checks.oracle_documents import ORACLE as _DOCS
from ferrule.checks.oracle_history import ORACLE as _HIST
from ferrule.checks.oracle_hr_climate import ORACLE as _HRC

ORACLE: dict[str, str] = {}


# submissions and denials inside the window, one grouping for both
_WINDOW = """SELECT loan_nbr, min(sent) AS min_submitted, max(sent) AS max_submitted, CAST(max(denied) AS DATE) AS denial_dt
FROM (SELECT loan_nbr, dt_sbmt_to_hud AS sent, NULL AS denied FROM v_submissions
      UNION ALL SELECT loan_nbr, NULL, hud_prelim_ttl_dny_dt FROM v_denials) AS happened
WHERE coalesce(sent, denied) >= TIMESTAMP '2000-02-01' AND coalesce(sent, denied) < TIMESTAMP '2000-03-01' GROUP BY loan_nbr"""

_AS_OF_END = """SELECT loan_nbr, s[1] AS status_code, s[2] AS status_description FROM (
 SELECT loan_nbr, arg_max(row(status_code, status_description), row(eff_dttm, coalesce(status_code, -1))) AS s
 FROM v_status_history WHERE eff_dttm < TIMESTAMP '2000-03-01' GROUP BY loan_nbr)"""


def _bonus(status: str) -> str:
    return f"""SELECT loan_nbr, status_code, status_description, min_submitted, max_submitted, denial_dt,
 CASE WHEN status_code IS NULL OR (status_code = 0 AND max_submitted IS NULL) THEN 'Pending' ELSE 'Resolved' END AS final_status
FROM ({status}) AS s LEFT JOIN ({_WINDOW}) AS w USING (loan_nbr)"""


ORACLE["bonus_status"] = with_views(_bonus("SELECT * FROM v_status_snapshot"))
ORACLE["bonus_status_history"] = with_views(_bonus(_AS_OF_END))
ORACLE["bonus_rule_hits"] = with_views(f"""SELECT 'BONUS' AS "table", CAST(rule AS INTEGER) AS rule, CASE rule WHEN 0 THEN 'ELSE' ELSE 'Resolved' END AS label,
 count(*) AS n FROM (SELECT CASE WHEN final_status = 'Pending' THEN 0 WHEN status_code = 72 THEN 1 WHEN status_code = 0 THEN 2 ELSE 3 END AS rule
 FROM ({_bonus("SELECT * FROM v_status_snapshot")}) AS b) AS r GROUP BY rule""")

ORACLE["window_min_max"] = with_views("""
SELECT loan_nbr, min(dt_sbmt_to_hud) AS min_submitted, max(dt_sbmt_to_hud) AS max_submitted
FROM v_submissions WHERE CAST(dt_sbmt_to_hud AS DATE) BETWEEN DATE '2000-02-01' AND DATE '2000-02-29'
GROUP BY loan_nbr
""")

ORACLE.update(_LETTERS)
ORACLE.update(_DOCS)
ORACLE.update(_HIST)
ORACLE.update(_HRC)

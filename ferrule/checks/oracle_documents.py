"""DuckDB oracle for the document scrub, from its contracts: documents are counted against the listed ids
first, then matched to what the base rows ask for."""

from __future__ import annotations

from ferrule.checks.oracle_letters import GC, LEDGER, NONGC, NOW, TODAY, ci
from ferrule.checks.oracle_views import with_views


# fixed values: a document's shown name, its code, its second code, and the letter sets besides the gift-card ones
KINDS = """SELECT * FROM (VALUES ('TRUST - HACG', 'Trust', NULL, NULL, 0), ('TRUST', 'Trust', 'Trust', NULL, 0), ('HOA', NULL, 'HOADOCS', NULL, 2),
 ('CURRENT OCC CERT', NULL, 'OCCERT', NULL, 1), ('DEATH CERT HACG', 'Death Cert', NULL, NULL, 0), ('DEATH CERT', 'Death Cert', 'C.DEATH', NULL, 0),
 ('PROOF OF REPAIR', NULL, 'REPAIRS', 'REPAIRINS', 0)) AS k(kind, shown, own_code, second_code, letter_sets)"""


def _first_letter(sets: str) -> str:
    return (f"CAST(list_min([{', '.join(GC)}] || CASE WHEN {sets} >= 1 THEN [{', '.join(NONGC)}] ELSE [] END"
            f" || CASE WHEN {sets} = 2 THEN [{', '.join(LEDGER)}] ELSE [] END) AS DATE)")


OPEN_EXCEPTIONS = f"""SELECT loan_number, exception_id, coalesce(shown, document) AS document, issue, exception_status,
 exception_status_updated_by, own_code AS excp_fn_code, second_code AS por_fn_code_2, {_first_letter('letter_sets')} AS min_letter_date,
 CAST(exception_request_date AS DATE) AS exception_request_date, CAST(exception_status_date AS DATE) AS exception_status_date
FROM v_exceptions JOIN kinds_asked ON kind = {ci('document')}
WHERE {ci('exception_status')} <> ALL (SELECT unnest(['RESOLVED', 'CLOSED', 'NOT VALID', 'CLOSED WITH VENDOR']))"""

# an assignment row decides whether its loan is open; the roster only adds columns
ASSIGNED = f"""SELECT loan_number, hud_assigned_to, hud_preliminary_title_approval, mgr_nm, st_loc, 'Not Submitted' AS status
FROM v_assignment LEFT JOIN v_roster ON {ci('agnt_nm')} = {ci('hud_assigned_to')}
WHERE NOT {ci('hud_status')} = ANY (SELECT unnest(['HUD APPROVED', 'PKG SUBMITTED TO HUD', 'RESUBMITTED TO HUD', 'REBUTTAL TO HUD']))"""

LOANS = f"""SELECT *, CASE WHEN mca_pct IS NULL THEN 'Error' ELSE concat(CASE WHEN mca_pct < 97.5 THEN '<' ELSE '>=' END, ' 97.5') END AS mca_flag
FROM v_loan_status LEFT JOIN v_workable USING (loan_number) LEFT JOIN v_exception_total USING (loan_number)
WHERE tag_2 IS NULL AND incurable_flag = '0' AND {ci('loan_status')} = 'ACTIVE' AND coalesce({ci('"group"')} IN (
 'GRP 1 NSM BALANCE SHEET', 'GRP 2 FNMA', 'GRP 3 GNMA EXCL BOFA', 'GRP 4 TRUST / PRIVATE EXLC BOFA'), true)"""

BASE = f"""SELECT loan_number, {NOW} AS refreshed, document, issue, exception_request_date,
 CAST({TODAY} - exception_request_date AS INTEGER) AS aged, tag_2, incurable_flag, loan_status, stage, mca_pct AS mca, mca_flag,
 exception_id, final_review_assigned_to, hud_assigned_to, mgr_nm, st_loc, open_exceptions, open_curative, open_hacg, status,
 excp_fn_code, por_fn_code_2, final_review_status, hud_preliminary_title_approval, exception_status, exception_status_updated_by,
 exception_status_date, min_letter_date
FROM open_exceptions_asked JOIN loans_open USING (loan_number) JOIN assigned USING (loan_number)"""

# How often each invalid id is listed for a loan; a document listed k of n times stands for k Invalid rows and
# n - k Valid ones, and for one Valid row where the loan lists nothing.
LISTED = f"""SELECT loan_nbr AS loan, {ci('guid')} AS id, count(*) AS k FROM v_invalid_documents GROUP BY ALL"""

# fixed expression: leading zeros go, inner blanks turn into zeros
_KEY = "replace(ltrim(replace(d.loan_key, '0', ' ')), ' ', '0')"

STORED = f"""SELECT *, CASE WHEN n = 0 THEN 1 ELSE n - k END AS valid_rows, k AS invalid_rows FROM (
 SELECT {_KEY} AS loan, {ci('d.doc_type_cd')} AS code, d.obj_id, d.cre_dt, {ci('d.original_doc_nm')} AS kind,
  12 * (year({TODAY}) - year(d.cre_dt)) + month({TODAY}) - month(d.cre_dt) AS months,
  coalesce((SELECT sum(k) FROM listed l WHERE l.loan = {_KEY}), 0) AS n,
  coalesce((SELECT sum(k) FROM listed l WHERE l.loan = {_KEY}
            AND l.id = upper(rtrim(concat('{{', d.obj_id, '}}'), ' '))), 0) AS k
 FROM v_document_repository d) AS counted"""

TYPES = """SELECT * FROM (VALUES ('OCCERT', 'Current OCC Cert'), ('TRUST', 'Trust'), ('HOADOCS', 'HOA'), ('C.DEATH', 'Death Cert'),
 ('REPAIRINS', 'Proof of Repair'), ('REPAIRS', 'Proof of Repair')) AS kinds(kind, invalid_excp_type)"""

# a base row asks for its own code at any age, and for its second code only among recent documents
ASKED = f"""SELECT loan_number, exception_id, document, {ci('excp_fn_code')} AS code, 1000000 AS within FROM base
 UNION ALL SELECT loan_number, exception_id, document, coalesce(por_fn_code_2, 'NOTPOREXCEPTION'), 10 FROM base"""

MATCHED = """SELECT a.loan_number, a.exception_id, a.document, s.obj_id, s.cre_dt, t.invalid_excp_type, s.valid_rows, s.invalid_rows
FROM stored s JOIN asked a ON s.loan = a.loan_number AND s.code = a.code AND abs(s.months) <= a.within LEFT JOIN kinds t USING (kind)"""

NEWEST = """SELECT exception_id, max(cre_dt) FILTER (valid_rows > 0) AS good, max(cre_dt) FILTER (invalid_rows > 0) AS bad
FROM matched GROUP BY exception_id"""


def latest(key: str) -> str:
    return f"""SELECT b.loan_number, b.refreshed, b.mca, b.mca_flag, concat('{{', m.obj_id, '}}') AS guid, m.cre_dt AS date_created,
 b.document, b.issue, b.exception_request_date, CAST(sum(m.valid_rows + m.invalid_rows) AS BIGINT) AS n_rows
FROM newest n JOIN base b USING (exception_id) JOIN matched m ON m.{key} = b.{key} AND m.cre_dt = n.good
WHERE n.bad IS NULL OR n.good > n.bad GROUP BY ALL"""


def latest_rows(key: str) -> str:
    return f"""SELECT b.loan_number, b.refreshed, b.mca, b.mca_flag, concat('{{', m.obj_id, '}}') AS guid, m.cre_dt AS date_created,
 b.document, b.issue, b.exception_request_date
FROM newest n JOIN base b USING (exception_id) JOIN matched m ON m.{key} = b.{key} AND m.cre_dt = n.good,
 range(CAST(m.valid_rows + m.invalid_rows AS BIGINT)) AS copies
WHERE n.bad IS NULL OR n.good > n.bad"""


COUNTS = """SELECT loan_number, obj_id, invalid_excp_type, cre_dt, CAST(sum(valid_rows) AS BIGINT) AS n_valid,
 CAST(sum(invalid_rows) AS BIGINT) AS n_invalid FROM matched GROUP BY ALL"""

DATED = "SELECT exception_id, good AS valid_dt, bad AS invalid_dt FROM newest WHERE exception_id IS NOT NULL"

MATCH = """SELECT loan_number, exception_id, document, obj_id, invalid_excp_type, cre_dt, f.flag AS invalid_flag,
 CAST(sum(f.n) AS BIGINT) AS n_rows
FROM (SELECT *, unnest([{'flag': 'Valid', 'n': valid_rows}, {'flag': 'Invalid', 'n': invalid_rows}]) AS f FROM matched) AS flagged
WHERE f.n > 0 GROUP BY ALL"""

CTES = [("kinds_asked", KINDS), ("open_exceptions_asked", OPEN_EXCEPTIONS), ("assigned", ASSIGNED), ("loans_open", LOANS), ("base", BASE), ("listed", LISTED), ("stored", STORED), ("kinds", TYPES), ("asked", ASKED), ("matched", MATCHED),
        ("newest", NEWEST)]

ORACLE = {
    "open_exception_base": with_views("SELECT * FROM base", *CTES),
    "document_match": with_views(MATCH, *CTES),
    "latest_valid_document": with_views(latest_rows("loan_number"), *CTES),
    "latest_valid_by_exception": with_views(latest_rows("exception_id"), *CTES),
    "document_counts": with_views(COUNTS, *CTES),
    "exception_document_dates": with_views(DATED, *CTES),
    "row_min_date": with_views(f"""SELECT exception_id, document, {_first_letter('coalesce(letter_sets, 0)')} AS min_letter_date
FROM v_exceptions LEFT JOIN kinds_asked ON kind = {ci('document')}""", ("kinds_asked", KINDS)),
}

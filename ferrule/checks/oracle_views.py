"""DuckDB mirrors of ``ferrule.sources.adapter`` (same role views, written as SQL CTEs).

``with_views(sql, *names)`` prefixes a query with the CTEs it needs (dependencies included), over
the pre-registered driver views (customer, orders, lineitem, ...).
"""

from __future__ import annotations

import re

ISSUES_SQL = """CASE o_orderkey % 9 WHEN 0 THEN 'Missing' WHEN 1 THEN 'Missing Contact Info'
 WHEN 2 THEN 'Authorization Received - Invalid' WHEN 3 THEN 'BCR- Authorization required'
 WHEN 4 THEN 'BCR- Missing Contact information' WHEN 5 THEN 'BCR- No HOA required'
 WHEN 6 THEN 'BCR- Uncooperative-Unresponsive' WHEN 7 THEN 'BCR- Authorization Received'
 ELSE 'Authorization Received - Valid' END"""

HUD_SQL = """CASE c_custkey % 5 WHEN 0 THEN 'Not Started' WHEN 1 THEN 'HUD Denied' WHEN 2 THEN 'Not Started'
 WHEN 3 THEN 'Pkg Submitted to HUD' ELSE 'HUD Approved' END"""

MCA = "(90.0 + CAST({k} * 37 % 1100 AS DOUBLE) / 100.0)"

VIEWS: dict[str, str] = {}

VIEWS["v_loan_status"] = f"""SELECT CAST(c_custkey AS VARCHAR) AS loan_number,
 CASE WHEN c_acctbal < 0 THEN 'Inactive' ELSE 'Active' END AS loan_status,
 CASE WHEN c_nationkey = 24 THEN 'Litigation' END AS tag_2,
 CASE WHEN c_nationkey = 23 THEN '1' ELSE '0' END AS incurable_flag,
 CASE WHEN c_nationkey = 22 THEN 'Grp 5 Excluded' ELSE CASE c_mktsegment WHEN 'AUTOMOBILE' THEN 'Grp 1 NSM Balance Sheet'
   WHEN 'BUILDING' THEN 'Grp 2 FNMA' WHEN 'FURNITURE' THEN 'Grp 3 GNMA excl BofA'
   WHEN 'HOUSEHOLD' THEN 'Grp 4 Trust / Private exlc BofA' END END AS "group",
 'Stage ' || CAST(c_nationkey AS VARCHAR) AS stage,
 CASE WHEN c_nationkey = 21 THEN CAST(NULL AS DOUBLE) ELSE {MCA.format(k='c_custkey')} END AS mca_pct
FROM customer"""

VIEWS["v_hud_status"] = f"""SELECT CAST(c_custkey AS VARCHAR) AS loan_number, {HUD_SQL} AS hud_status,
 'Agent ' || CAST(c_custkey % 7 AS VARCHAR) AS hud_assigned_to FROM customer
UNION ALL SELECT CAST(c_custkey AS VARCHAR), 'HUD Denied', 'Agent 9' FROM customer WHERE c_custkey % 53 = 0"""

VIEWS["v_workable"] = """SELECT CAST(c_custkey AS VARCHAR) AS loan_number,
 CASE WHEN c_acctbal > 5000 THEN 'Pending QC' ELSE 'Complete' END AS final_review_status,
 'Reviewer ' || CAST(c_custkey % 3 AS VARCHAR) AS final_review_assigned_to FROM customer"""

VIEWS["v_loan_master"] = f"""SELECT CAST(c_custkey AS VARCHAR) AS loan_nbr,
 CASE WHEN c_nationkey = 21 THEN CAST(NULL AS DOUBLE) ELSE {MCA.format(k='c_custkey')} END AS mca_percent,
 CAST(DATE '2001-09-01' + to_months(CAST(c_custkey % 12 AS INTEGER)) AS TIMESTAMP) AS curr_year_anniversary,
 CAST(DATE '2001-09-01' + to_months(CAST((c_custkey + 6) % 12 AS INTEGER)) AS TIMESTAMP) AS next_year_anniversary,
 'Status ' || c_mktsegment AS status_description,
 CASE c_custkey % 6 WHEN 0 THEN 'PO Box ' || CAST(c_custkey AS VARCHAR) WHEN 1 THEN 'P.O. BOX ' || CAST(c_custkey AS VARCHAR)
   WHEN 2 THEN 'p o box ' || CAST(c_custkey AS VARCHAR) WHEN 3 THEN 'P. O. Box ' || CAST(c_custkey AS VARCHAR)
   ELSE CAST(c_custkey AS VARCHAR) || ' Main St' END AS borrower_mail_address,
 'City ' || CAST(c_nationkey AS VARCHAR) AS borrower_mail_city,
 CASE WHEN c_nationkey = 3 THEN 'PR' ELSE 'N' || CAST(c_nationkey AS VARCHAR) END AS borrower_mail_state,
 CASE WHEN c_nationkey = 20 THEN CAST(NULL AS VARCHAR)
   WHEN c_custkey % 3 = 0 THEN lpad(CAST(c_custkey AS VARCHAR), 9, '0')
   WHEN c_custkey % 3 = 1 THEN lpad(CAST(c_custkey % 100000 AS VARCHAR), 5, '0') || '   '
   ELSE lpad(CAST(c_custkey % 100000 AS VARCHAR), 5, '0') END AS borrower_mail_zip_code,
 CAST(c_custkey AS VARCHAR) || ' Property Rd' AS prop_address,
 'Town ' || CAST(c_nationkey AS VARCHAR) AS prop_city,
 'N' || CAST(c_nationkey AS VARCHAR) AS prop_state,
 CASE WHEN c_custkey % 2 = 0 THEN lpad(CAST(c_custkey AS VARCHAR), 9, '0')
   ELSE lpad(CAST(c_custkey % 100000 AS VARCHAR), 5, '0') END AS prop_zip_code
FROM customer"""

_MX = "max(CASE WHEN {c} THEN l_shipdate END) AS {n}"
VIEWS["v_letter_dates"] = "SELECT l_orderkey, " + ",\n ".join(_MX.format(c=c, n=n) for c, n in [
    ("l_linenumber = 1", "gift_card_letter_sent"), ("l_linenumber = 2", "gift_card_letter_sent_2"),
    ("l_linenumber = 3", "gift_card_letter_sent_3"),
    ("l_linenumber = 5 AND l_returnflag = 'A'", "sent_for_gift_card_processing"),
    ("l_linenumber = 3 AND l_returnflag = 'N'", "document_returned"),
    ("l_linenumber = 4 AND l_returnflag = 'N'", "ledger_letter_document_returned"),
    ("l_linenumber = 4", "ledger_letter_sent_1"), ("l_linenumber = 5", "ledger_letter_sent_2"),
    ("l_linenumber = 6", "ledger_letter_sent_3"),
    ("l_linenumber = 6 AND l_returnflag = 'A'", "ledger_sent_for_gift_card_processing"),
    ("l_linenumber = 7", "non_gc_letter_sent_1"), ("l_linenumber = 1 AND l_returnflag = 'R'", "non_gc_letter_sent_2"),
    ("l_linenumber = 2 AND l_returnflag = 'R'", "non_gc_letter_sent_3"),
    ("l_linenumber = 3 AND l_returnflag = 'A'", "non_gc_letter_document_returned"),
    ("l_linenumber = 7 AND l_returnflag = 'A'", "sent_to_inspection_vendor"),
]) + "\nFROM lineitem GROUP BY l_orderkey"

VIEWS["v_exceptions"] = f"""SELECT CASE WHEN o_orderkey % 97 = 0 THEN NULL WHEN o_orderkey // 2 % 89 = 0 THEN o_orderkey // 2 * 2
   ELSE o_orderkey END AS exception_id, CAST(o_custkey AS VARCHAR) AS loan_number,
 CASE substring(o_orderpriority, 1, 1) WHEN '1' THEN 'HOA' WHEN '2' THEN 'Current OCC Cert'
   WHEN '3' THEN CASE WHEN o_orderkey % 2 = 0 THEN 'Death Cert HACG' ELSE 'Death Cert' END
   WHEN '4' THEN CASE WHEN o_orderkey % 2 = 0 THEN 'Trust - HACG' ELSE 'TRUST' END
   ELSE 'Proof of Repair' END AS document,
 {ISSUES_SQL} AS issue,
 CASE o_orderstatus WHEN 'F' THEN CASE WHEN o_orderkey % 4 = 0 THEN 'Resolved' ELSE 'CLOSED' END
   WHEN 'O' THEN 'Open' ELSE 'In Process' END AS exception_status,
 o_orderdate + INTERVAL 1 DAY AS exception_status_date,
 'User ' || CAST(o_orderkey % 5 AS VARCHAR) AS exception_status_updated_by,
 'Agent ' || CAST(o_orderkey % 7 AS VARCHAR) AS exception_assigned_to,
 o_orderdate AS exception_request_date,
 CASE o_orderkey % 3 WHEN 0 THEN 'Report/Inspection complete repairs are not complete'
   WHEN 2 THEN 'Repairs complete' END AS proof_of_repairs_status,
 'Borrower ' || CAST(o_custkey AS VARCHAR) AS borrower_name,
 CASE WHEN o_custkey % 2 = 0 THEN 'Co-Borrower ' || CAST(o_custkey AS VARCHAR) END AS coborrower_name,
 d.* EXCLUDE (l_orderkey)
FROM orders LEFT JOIN v_letter_dates d ON o_orderkey = d.l_orderkey"""

VIEWS["v_assignment"] = f"""SELECT CAST(c_custkey AS VARCHAR) AS loan_number, {HUD_SQL} AS hud_status,
 'Agent ' || CAST(c_custkey % 7 AS VARCHAR) AS hud_assigned_to,
 CASE WHEN c_acctbal > 8000 THEN 'Approved' END AS hud_preliminary_title_approval FROM customer"""

VIEWS["v_exception_total"] = """SELECT CAST(o_custkey AS VARCHAR) AS loan_number,
 CAST(count(CASE WHEN o_orderstatus <> 'F' THEN 1 END) AS INTEGER) AS open_exceptions,
 CAST(count(CASE WHEN o_orderstatus <> 'F' AND substring(o_orderpriority,1,1) = '5' THEN 1 END) AS INTEGER) AS open_curative,
 CAST(count(CASE WHEN o_orderstatus <> 'F' AND substring(o_orderpriority,1,1) IN ('3','4') THEN 1 END) AS INTEGER) AS open_hacg
FROM orders GROUP BY o_custkey"""

VIEWS["v_roster"] = """SELECT 'Agent ' || CAST(n_nationkey AS VARCHAR) AS agnt_nm,
 'Manager ' || CAST(n_regionkey AS VARCHAR) AS mgr_nm, n_name AS st_loc FROM nation"""

_CODE = ("CASE l_linenumber WHEN 1 THEN 'OCCERT' WHEN 2 THEN 'Trust' WHEN 3 THEN 'HOADOCS' WHEN 4 THEN 'C.DEATH' "
         "WHEN 5 THEN 'REPAIRS' WHEN 6 THEN 'REPAIRINS' WHEN 7 THEN 'OTHER' END")
_OBJ = "concat_ws('-', CAST(l_orderkey AS VARCHAR), CAST(l_linenumber AS VARCHAR), CAST(l_partkey AS VARCHAR))"
VIEWS["v_document_repository"] = f"""SELECT lpad(CAST(o_custkey AS VARCHAR), 10, '0') AS loan_key,
 {_CODE} AS doc_type_cd, upper({_CODE}) AS original_doc_nm, {_OBJ} AS obj_id, l_shipdate AS cre_dt
FROM lineitem JOIN orders ON l_orderkey = o_orderkey"""

VIEWS["v_invalid_documents"] = f"""SELECT CAST(o_custkey AS VARCHAR) AS loan_nbr, '{{' || {_OBJ} || '}}' AS guid
FROM lineitem JOIN orders ON l_orderkey = o_orderkey WHERE l_returnflag = 'R' AND l_discount = 0"""

VIEWS["v_status_snapshot"] = """SELECT CAST(c_custkey AS VARCHAR) AS loan_nbr,
 CAST(CASE c_custkey % 4 WHEN 0 THEN 72 WHEN 1 THEN 0 WHEN 2 THEN 3 END AS INTEGER) AS status_code,
 'Status ' || c_mktsegment AS status_description FROM customer"""

VIEWS["v_status_history"] = """SELECT CAST(o_custkey AS VARCHAR) AS loan_nbr,
 CAST(CASE substring(o_orderpriority, 1, 1) WHEN '1' THEN 72 WHEN '2' THEN 0 WHEN '3' THEN 3 WHEN '4' THEN 5 END AS INTEGER)
   AS status_code,
 'Priority ' || o_orderpriority AS status_description, o_orderdate AS eff_dttm FROM orders"""

VIEWS["v_submissions"] = "SELECT CAST(o_custkey AS VARCHAR) AS loan_nbr, o_orderdate AS dt_sbmt_to_hud FROM orders"

VIEWS["v_denials"] = """SELECT CAST(o_custkey AS VARCHAR) AS loan_nbr,
 CASE WHEN o_orderstatus = 'F' THEN o_orderdate END AS hud_prelim_ttl_dny_dt FROM orders"""

VIEWS["v_exception_history"] = """SELECT event_id // 4 AS excp_id, CAST(event_id // 8 AS VARCHAR) AS loan_nbr,
 CASE event_type WHEN 'click' THEN 'Loss Draft' WHEN 'view' THEN 'LOSS DRAFT' ELSE 'Occupancy Cert' END AS doc_desc,
 CASE WHEN value < 10 THEN 'Forced Placed Insurance' WHEN value < 20 THEN 'Not enough repays' ELSE 'Other' END AS issu_desc,
 CASE event_type WHEN 'signup' THEN 'CLOSED' WHEN 'purchase' THEN 'Resolved' WHEN 'error' THEN 'In Process'
   ELSE 'New Exception' END AS excp_sts_desc,
 ts AS eff_dttm, ts - INTERVAL 7 DAY AS excp_rqst_dttm
FROM events"""

VIEWS["v_loan_history"] = f"""SELECT CAST(o_custkey AS VARCHAR) AS loan_nbr, o_orderkey AS seq,
 {MCA.format(k='o_orderkey')} AS mca_percent,
 CASE o_orderstatus WHEN 'F' THEN 'Closed' WHEN 'O' THEN 'Active' ELSE 'Pending' END AS loan_status,
 CAST(CAST(o_orderdate AS DATE) + INTERVAL 288 MONTH AS TIMESTAMP) AS eff_dttm
FROM orders"""

VIEWS["v_business_dates"] = "SELECT o_orderdate AS bus_proc_dt FROM orders"

VIEWS["v_event_dates"] = "SELECT ts AS bus_proc_dt FROM events"

VIEWS["v_employees"] = """SELECT c_custkey AS emp_no,
 CAST(h.hire_date - INTERVAL 300 MONTH AS DATE) AS birth_date,
 string_split(p_name, ' ')[1] AS first_name, string_split(p_name, ' ')[2] AS last_name,
 CASE WHEN c_custkey % 2 = 0 THEN 'M' ELSE 'F' END AS gender, h.hire_date
FROM customer LEFT JOIN part ON c_custkey = p_partkey
LEFT JOIN (SELECT o_custkey, CAST(min(o_orderdate) AS DATE) AS hire_date FROM orders GROUP BY o_custkey) h
  ON c_custkey = h.o_custkey"""

VIEWS["v_departments"] = "SELECT 'd' || lpad(CAST(n_nationkey AS VARCHAR), 3, '0') AS dept_no, n_name AS dept_name FROM nation"

VIEWS["v_dept_emp"] = """SELECT c_custkey AS id, c_custkey AS emp_no, 'd' || lpad(CAST(c_nationkey AS VARCHAR), 3, '0') AS dept_no,
 DATE '1990-01-01' AS from_date, DATE '9999-01-01' AS to_date FROM customer"""

VIEWS["v_salaries"] = """SELECT o_orderkey AS id, o_custkey AS emp_no, o_totalprice AS salary,
 CAST(o_orderdate AS DATE) AS from_date, DATE '9999-01-01' AS to_date FROM orders"""

VIEWS["v_titles"] = """SELECT c_custkey AS id, c_custkey AS emp_no, c_mktsegment AS title,
 DATE '1990-01-01' AS from_date, DATE '9999-01-01' AS to_date FROM customer"""

VIEWS["v_dept_manager"] = """SELECT 'd' || lpad(CAST(s.s_nationkey AS VARCHAR), 3, '0') AS dept_no, s.s_suppkey AS emp_no,
 DATE '1990-01-01' AS from_date,
 CASE WHEN s.s_suppkey = t.top_key THEN DATE '9999-01-01' ELSE DATE '2000-01-01' END AS to_date
FROM supplier s LEFT JOIN (SELECT s_nationkey, max(s_suppkey) AS top_key FROM supplier GROUP BY s_nationkey) t
  ON s.s_nationkey = t.s_nationkey"""

VIEWS["v_station"] = """SELECT s_name AS station, s_name || ', NATION ' || CAST(s_nationkey AS VARCHAR) AS name,
 20.0 + CAST(s_nationkey AS DOUBLE) / 10.0 AS latitude, -150.0 - CAST(s_suppkey % 10 AS DOUBLE) / 10.0 AS longitude,
 s_acctbal AS elevation FROM supplier"""

VIEWS["v_measurement"] = """SELECT event_id AS id, s_name AS station, CAST(ts AS DATE) AS date,
 CASE WHEN event_type = 'error' THEN CAST(NULL AS DOUBLE) ELSE value END AS prcp, value AS tobs
FROM events JOIN supplier ON user_id % (SELECT count(*) FROM supplier) = s_suppkey"""

VIEWS["v_price_series"] = "SELECT CAST(o_orderdate AS DATE) AS date, o_totalprice AS tobs FROM orders"

_REF = re.compile(r"\bv_[a-z_]+\b")


def _deps(name: str) -> list[str]:
    return [m for m in dict.fromkeys(_REF.findall(VIEWS[name])) if m in VIEWS and m != name]


def with_views(sql: str, *extra_ctes: tuple[str, str]) -> str:
    """Prefix ``sql`` with CTEs for every adapter view it references (dependencies first).

    ``extra_ctes`` are (name, sql) job-level CTEs that may themselves reference adapter views.
    """
    order: list[str] = []

    def visit(n):
        for dname in _deps(n):
            visit(dname)
        if n not in order:
            order.append(n)

    text = sql + " ".join(s for _, s in extra_ctes)
    for n in dict.fromkeys(_REF.findall(text)):
        if n in VIEWS:
            visit(n)
    parts = [f"{n} AS ({VIEWS[n]})" for n in order] + [f"{n} AS ({s})" for n, s in extra_ctes]
    return ("WITH " + ",\n".join(parts) + "\n" + sql) if parts else sql

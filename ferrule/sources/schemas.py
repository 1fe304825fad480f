"""Typed table definitions (the declared HR/climate schemas and the loan tables inferred from use).

File readers make every column nullable; the NOT NULL declarations are therefore checked with
``ferrule.operators.quality.null_counts`` instead of being trusted.  CHAR(n) columns are plain
strings (Spark file readers reject char/varchar schemas).
"""

from pyspark.sql.types import (DateType, DoubleType, IntegerType, LongType, StringType, StructField,
                               StructType, TimestampNTZType)


def _s(*fields, nullable=True):
    return StructType([StructField(n, t, nullable) for n, t in fields])


S, I, L, D, DT, TS = StringType(), IntegerType(), LongType(), DoubleType(), DateType(), TimestampNTZType()

# The letter-date columns of the exception table, in report order.
LETTER_DATE_COLUMNS = [
    "gift_card_letter_sent", "gift_card_letter_sent_2", "gift_card_letter_sent_3",
    "sent_for_gift_card_processing", "document_returned", "ledger_letter_document_returned",
    "ledger_letter_sent_1", "ledger_letter_sent_2", "ledger_letter_sent_3",
    "ledger_sent_for_gift_card_processing", "non_gc_letter_sent_1", "non_gc_letter_sent_2",
    "non_gc_letter_sent_3", "non_gc_letter_document_returned",
]

SCHEMAS = {
    # HR schema (declared NOT NULL everywhere)
    "departments": _s(("dept_no", S), ("dept_name", S), nullable=False),
    "dept_manager": _s(("dept_no", S), ("emp_no", I), ("from_date", DT), ("to_date", DT), nullable=False),
    "dept_emp": _s(("id", L), ("emp_no", I), ("dept_no", S), ("from_date", DT), ("to_date", DT), nullable=False),
    "employees": _s(("emp_no", I), ("birth_date", DT), ("first_name", S), ("last_name", S), ("gender", S),
                    ("hire_date", DT), nullable=False),
    "salaries": _s(("id", L), ("emp_no", I), ("salary", D), ("from_date", DT), ("to_date", DT), nullable=False),
    "titles": _s(("id", L), ("emp_no", I), ("title", S), ("from_date", DT), ("to_date", DT), nullable=False),
    # climate
    "station": _s(("station", S), ("name", S), ("latitude", D), ("longitude", D), ("elevation", D)),
    "measurement": _s(("id", L), ("station", S), ("date", DT), ("prcp", D), ("tobs", D)),
    # loan tables (types inferred from use)
    "loan_status": _s(("loan_number", S), ("loan_status", S), ("tag_2", S), ("incurable_flag", S), ("group", S),
                      ("stage", S), ("mca_pct", D)),
    "hud_status": _s(("loan_number", S), ("hud_status", S), ("hud_assigned_to", S)),
    "workable": _s(("loan_number", S), ("final_review_status", S), ("final_review_assigned_to", S)),
    "loan_master": _s(("loan_nbr", S), ("mca_percent", D), ("curr_year_anniversary", TS),
                      ("next_year_anniversary", TS), ("status_description", S), ("borrower_mail_address", S),
                      ("borrower_mail_city", S), ("borrower_mail_state", S), ("borrower_mail_zip_code", S),
                      ("prop_address", S), ("prop_city", S), ("prop_state", S), ("prop_zip_code", S)),
    "exceptions": _s(("exception_id", L), ("loan_number", S), ("document", S), ("issue", S), ("exception_status", S),
                     ("exception_status_date", TS), ("exception_status_updated_by", S), ("exception_assigned_to", S),
                     ("exception_request_date", TS), ("proof_of_repairs_status", S), ("borrower_name", S), ("coborrower_name", S),
                     *[(c, TS) for c in LETTER_DATE_COLUMNS], ("sent_to_inspection_vendor", TS)),
    "assignment": _s(("loan_number", S), ("hud_status", S), ("hud_assigned_to", S), ("hud_preliminary_title_approval", S)),
    "exception_total": _s(("loan_number", S), ("open_exceptions", I), ("open_curative", I), ("open_hacg", I)),
    "roster": _s(("agnt_nm", S), ("mgr_nm", S), ("st_loc", S)),
    "invalid_documents": _s(("loan_nbr", S), ("guid", S)),
    "document_repository": _s(("loan_key", S), ("doc_type_cd", S), ("original_doc_nm", S), ("obj_id", S), ("cre_dt", TS)),
    "submissions": _s(("loan_nbr", S), ("dt_sbmt_to_hud", TS)),
    "denials": _s(("loan_nbr", S), ("hud_prelim_ttl_dny_dt", TS)),
    "status_snapshot": _s(("loan_nbr", S), ("status_code", I), ("status_description", S)),
    "status_history": _s(("loan_nbr", S), ("status_code", I), ("status_description", S), ("eff_dttm", TS)),
    "loan_history": _s(("loan_nbr", S), ("seq", L), ("mca_percent", D), ("loan_status", S), ("eff_dttm", TS)),
    "eom_loans": _s(("loan_nbr", S), ("mca_percent", D), ("loan_status", S)),
    "bom_loans": _s(("loan_nbr", S), ("mca_percent", D)),
    "business_dates": _s(("bus_proc_dt", TS)),
    "exception_history": _s(("excp_id", L), ("loan_nbr", S), ("doc_desc", S), ("issu_desc", S),
                            ("excp_sts_desc", S), ("eff_dttm", TS), ("excp_rqst_dttm", TS)),
}

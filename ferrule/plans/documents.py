"""Document scrub: match open exceptions to repository documents, flag documents listed as
invalid, and keep the newest valid document per exception.

The source report builds ``#INVALID`` as base ⋈ invalid-ids(loan) ⋈ documents(loan): every
document is repeated once per invalid id of its loan, flagged 'Invalid' against the id it equals and
'Valid' against every other id (or once 'Valid' when the loan has no ids).  The final step joins each
exception to *all* ``#INVALID`` rows of its loan.  Both products are quadratic for a loan with many
exceptions, documents or ids, so nothing here pairs exceptions with documents:

* ``asks``: what the base rows ask for, grouped by (loan, document code), with the number of rows that
  ask at any age and of those that ask among recent documents only (the report's second code);
* ``asked_documents``: each document once, with the number of base rows that ask for it (``n_asking``)
  and the rows it stands for against the loan's invalid ids: ``n_match`` (ids equal to its guid) 'Invalid'
  rows and ``n_ids - n_match`` 'Valid' ones, or 1 'Valid' row when the loan lists nothing;
* ``exception_dates``: newest valid and newest invalid date for each (loan, code), and from there for each
  exception through the codes it asks for;
* ``latest_valid``: base rows grouped by what the report shows, joined to the documents of that date; a
  row the report repeats is one row with ``n_rows``;
* ``latest_valid_rows``: the report's rows, as often as it shows them.

No step makes more rows than there are documents, or codes asked for; only the last ones have a row for each
shown exception and newest document.  ``document_match`` lists the report's pairs themselves, for those who want them.
"""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ferrule.functions.rowwise import by_kind, row_min
from ferrule.functions.rules import Rule, first_match
from ferrule.functions.semantics import (braced, ci_in, ci_key, ci_not_in, date_lit, day_diff, in_or_null, month_diff,
                                         recode, strip_zeros, ts_lit, SENTINEL_NEVER_DATE)
from ferrule.plans.letters import GC, LEDGER, NON_GC
from ferrule.plans import JobResult
from ferrule.sources.io import materialize

# ---- fixed values of the report ---------------------------------------------------------------
GROUPS = ("Grp 1 NSM Balance Sheet", "Grp 2 FNMA", "Grp 3 GNMA excl BofA", "Grp 4 Trust / Private exlc BofA")
DOCUMENTS = ("Trust - HACG", "Trust", "Current OCC Cert", "HOA", "Death Cert HACG", "Death Cert", "Proof of Repair")
CLOSED_STATUSES = ("RESOLVED", "CLOSED", "NOT VALID", "CLOSED WITH VENDOR")
HUD_EXCLUDED = ("HUD Approved", "Pkg Submitted to HUD", "Resubmitted to HUD", "Rebuttal to HUD")
SUBMITTED = ("Pkg Submitted to HUD", "resubmitted to hud", "rebuttal to hud")
DOCUMENT_NAMES = [(("Trust", "Trust - HACG"), "Trust"), (("Death Cert", "Death Cert HACG"), "Death Cert")]
DOCUMENT_CODES = [("Current OCC Cert", "OCCERT"), ("TRUST", "Trust"), ("HOA", "HOADOCS"),
                  ("Death Cert", "C.DEATH"), ("Proof of Repair", "REPAIRS")]
REPAIR_INSPECTION_CODE = "REPAIRINS"
NO_SECOND_CODE = "NOTPOREXCEPTION"
INVALID_TYPES = [("OCCERT", "Current OCC Cert"), ("TRUST", "Trust"), ("HOADOCS", "HOA"), ("C.DEATH", "Death Cert"),
                 (("REPAIRINS", "REPAIRS"), "Proof of Repair")]
MIN_DATE_SETS = {"HOA": GC + LEDGER + NON_GC, "Current OCC Cert": GC + NON_GC}


@dataclass
class DocumentParams:
    as_of: dt.date | dt.datetime | None = None
    groups: tuple = GROUPS
    documents: tuple = DOCUMENTS
    closed_statuses: tuple = CLOSED_STATUSES
    hud_excluded: tuple = HUD_EXCLUDED
    mca_cut: float = 97.5
    recency_months: int = 10
    match_on: str = "loan"          # 'loan' = as written; 'exception' = only the exception's own documents

    def __post_init__(self):
        if self.as_of is None:          # one run, one clock reading
            self.as_of = dt.datetime.now().replace(microsecond=0)
        if self.match_on not in ("loan", "exception"):
            raise ValueError(f"match_on must be 'loan' or 'exception', not {self.match_on!r}")

    @property
    def run_ts(self) -> dt.datetime:
        a = self.as_of
        return a if isinstance(a, dt.datetime) else dt.datetime(a.year, a.month, a.day)


def base(t: dict[str, DataFrame], p: DocumentParams) -> DataFrame:
    """Open exceptions of the workable population with assignment, totals and roster (D1-D3)."""
    e, a, c = t["exceptions"], t["loan_status"], t["assignment"]
    e = e.where(ci_in("document", p.documents, e) & ci_not_in("exception_status", p.closed_statuses, e))
    a = a.where(ci_in("loan_status", ["Active"], a) & F.col("tag_2").isNull()
                & F.col("incurable_flag").isin("0") & in_or_null("group", p.groups, df=a))
    c = c.where(ci_not_in("hud_status", p.hud_excluded, c))              # NULL status fails, so inner
    r = t["roster"]
    j = (a.join(t["workable"], "loan_number", "left")
         .join(e, "loan_number", "inner")                                 # WHERE document IS NOT NULL
         .join(c, "loan_number", "inner")
         .join(t["exception_total"], "loan_number", "left")
         .join(r, ci_key("hud_assigned_to") == ci_key(r.agnt_nm), "left"))
    doc = F.col("document")
    mca = F.col("mca_pct")
    return j.select(
        "loan_number", ts_lit(p.run_ts).alias("refreshed"),
        recode(doc, DOCUMENT_NAMES, default=doc, null_value="No Issue").alias("document"),
        "issue", F.col("exception_request_date").cast("date").alias("exception_request_date"),
        day_diff("exception_request_date", date_lit(p.run_ts.date())).alias("aged"),
        "tag_2", "incurable_flag", "loan_status", "stage", F.col("mca_pct").alias("mca"),
        first_match([Rule(mca >= p.mca_cut, f">= {p.mca_cut}"), Rule(mca < p.mca_cut, f"< {p.mca_cut}")], "Error")
        .alias("mca_flag"),
        "exception_id", "final_review_assigned_to", "hud_assigned_to", "mgr_nm", "st_loc",
        "open_exceptions", "open_curative", "open_hacg",
        first_match([Rule(ci_in("hud_status", SUBMITTED), "Submitted"), Rule(ci_in("hud_status", ["hud approved"]), "HUD Approved")],
                    "Not Submitted").alias("status"),
        recode(doc, [(v, c) for v, c in DOCUMENT_CODES]).alias("excp_fn_code"),
        F.when(ci_in(doc, ["Proof of Repair"]), F.lit(REPAIR_INSPECTION_CODE)).alias("por_fn_code_2"),
        "final_review_status", "hud_preliminary_title_approval", "exception_status", "exception_status_updated_by",
        F.col("exception_status_date").cast("date").alias("exception_status_date"),
        by_kind(doc, MIN_DATE_SETS, GC, row_min).cast("date").alias("min_letter_date"),
    )


def min_letter_date(exceptions: DataFrame) -> DataFrame:
    """Earliest letter date per exception over the document's letter columns (A10)."""
    return exceptions.select("exception_id", "document",
                             by_kind(F.col("document"), MIN_DATE_SETS, GC, row_min).cast("date").alias("min_letter_date"))


def offers(b: DataFrame, *keep: str) -> DataFrame:
    """Each base row's two document codes: its own at any age, the second one among recent documents only."""
    codes = F.explode(F.array(
        F.struct(ci_key("excp_fn_code").alias("code"), F.lit(False).alias("recent_only")),
        F.struct(ci_key(F.coalesce(F.col("por_fn_code_2"), F.lit(NO_SECOND_CODE))).alias("code"), F.lit(True).alias("recent_only"))))
    return b.select(*keep, codes.alias("o")).where(F.col("o.code").isNotNull()).select(*keep, "o.code", "o.recent_only")


def asks(b: DataFrame) -> DataFrame:
    """(loan_number, code, n_any, n_recent): base rows that ask for a code at any age, or among recent documents."""
    return offers(b, "loan_number").groupBy("loan_number", "code").agg(
        F.count_if(~F.col("recent_only")).alias("n_any"), F.count_if("recent_only").alias("n_recent"))


def _documents(t: dict[str, DataFrame], p: DocumentParams) -> DataFrame:
    recent = F.abs(month_diff(date_lit(p.run_ts.date()), F.col("cre_dt").cast("date"))) <= p.recency_months
    return t["document_repository"].select(strip_zeros("loan_key").alias("loan_number"), ci_key("doc_type_cd").alias("code"),
                                           "original_doc_nm", "obj_id", "cre_dt", recent.alias("recent"))


def _listed(t: dict[str, DataFrame]) -> tuple[DataFrame, DataFrame]:
    """Invalid ids by loan (``n_ids``), and by loan and guid (``n_match``)."""
    # one grouping by (loan, guid) gives both
    ids = t["invalid_documents"].groupBy(F.col("loan_nbr").alias("loan_number"), ci_key("guid").alias("_guid")) \
        .agg(F.count(F.lit(1)).alias("_n"))
    return (ids.groupBy("loan_number").agg(F.sum("_n").alias("n_ids")),
            ids.where(F.col("_guid").isNotNull()).select("loan_number", "_guid", F.col("_n").alias("n_match")))


def _with_listed(m: DataFrame, per_guid: DataFrame) -> DataFrame:
    """Add the rows a document stands for against its loan's ``n_ids`` invalid ids: ``n_valid`` and ``n_invalid``."""
    n_ids, n_match = F.coalesce("n_ids", F.lit(0)), F.coalesce("n_match", F.lit(0))
    # a document of a loan that lists nothing has nothing to look up
    return (m.withColumn("_guid", F.when(n_ids > 0, ci_key(braced("obj_id"))))
            .join(per_guid, ["loan_number", "_guid"], "left")
            .withColumn("n_valid", F.when(n_ids == 0, F.lit(1)).otherwise(n_ids - n_match)).withColumn("n_invalid", n_match)
            .drop("_guid", "n_ids", "n_match"))


def asked_documents(b: DataFrame, t: dict[str, DataFrame], p: DocumentParams) -> DataFrame:
    """Repository documents that some base row asks for, each once: loan_number, code, original_doc_nm, obj_id, cre_dt,
    recent, n_any, n_asking, n_valid, n_invalid."""
    per_loan, per_guid = _listed(t)
    # the ids of a loan come with what it asks for, so that documents are joined once less
    d = _documents(t, p).join(asks(b).join(per_loan, "loan_number", "left"), ["loan_number", "code"])
    asking = F.col("n_any") + F.when(F.col("recent"), F.col("n_recent")).otherwise(0)
    return _with_listed(d.withColumn("n_asking", asking).where(F.col("n_asking") > 0).drop("n_recent"), per_guid)


def document_counts(d: DataFrame) -> DataFrame:
    """The report's ``#INVALID`` rows by document, over all exceptions that match it."""
    return (d.groupBy("loan_number", "obj_id", recode("original_doc_nm", INVALID_TYPES).alias("invalid_excp_type"), "cre_dt")
            .agg(F.sum(F.col("n_asking") * F.col("n_valid")).cast("long").alias("n_valid"),
                 F.sum(F.col("n_asking") * F.col("n_invalid")).cast("long").alias("n_invalid")))


def exception_dates(b: DataFrame, d: DataFrame) -> DataFrame:
    """(exception_id, valid_dt, invalid_dt): newest valid and newest invalid document of each exception."""
    dt_ = F.col("cre_dt")
    valid, invalid, recent = F.col("n_valid") > 0, F.col("n_invalid") > 0, F.col("recent")
    newest = d.groupBy("loan_number", "code").agg(
        F.max(F.when(valid, dt_)).alias("valid"), F.max(F.when(invalid, dt_)).alias("invalid"),
        F.max(F.when(valid & recent, dt_)).alias("valid_recent"), F.max(F.when(invalid & recent, dt_)).alias("invalid_recent"))

    def newest_of(name):
        return F.max(F.when(F.col("recent_only"), F.col(f"{name}_recent")).otherwise(F.col(name))).alias(f"{name}_dt")
    return (offers(b, "loan_number", "exception_id").where(F.col("exception_id").isNotNull())
            .join(newest, ["loan_number", "code"])
            .groupBy("exception_id").agg(newest_of("valid"), newest_of("invalid"))
            .where(F.col("valid_dt").isNotNull() | F.col("invalid_dt").isNotNull()))


def matches(b: DataFrame, t: dict[str, DataFrame], p: DocumentParams) -> DataFrame:
    """The pairs themselves: one row per (base row, matching document) with the rows it stands for."""
    per_loan, per_guid = _listed(t)
    o = offers(b, "loan_number", "exception_id", "document").join(per_loan, "loan_number", "left")
    m = _documents(t, p).join(o, ["loan_number", "code"]).where(~F.col("recent_only") | F.col("recent"))
    return _with_listed(m.select("loan_number", "exception_id", "document", "obj_id", "original_doc_nm", "cre_dt", "n_ids"), per_guid)


def document_match(m: DataFrame) -> DataFrame:
    """The source's ``#INVALID`` rows, grouped: (exception, document, flag) -> number of rows."""
    flags = F.explode(F.array(F.struct(F.lit("Valid").alias("invalid_flag"), F.col("n_valid").alias("n")),
                              F.struct(F.lit("Invalid").alias("invalid_flag"), F.col("n_invalid").alias("n"))))
    keys = ["loan_number", "exception_id", "document", "obj_id", "invalid_excp_type", "cre_dt"]
    return (m.select("loan_number", "exception_id", "document", "obj_id",
                     recode("original_doc_nm", INVALID_TYPES).alias("invalid_excp_type"), "cre_dt",
                     flags.alias("f"))
            .where(F.col("f.n") > 0)
            .groupBy(*keys, F.col("f.invalid_flag").alias("invalid_flag"))
            .agg(F.sum("f.n").cast("long").alias("n_rows")))


SHOWN = ["loan_number", "refreshed", "mca", "mca_flag", "document", "issue", "exception_request_date"]
REPORT = ["loan_number", "refreshed", "mca", "mca_flag", "guid", "date_created", "document", "issue", "exception_request_date"]
ASKING = ["exception_id", "excp_fn_code", "por_fn_code_2"]
#: Copies of one report row that are made in one place; more of them are sorted as rows of their own.
COPIES = 10_000


def _newest(b: DataFrame, d: DataFrame, p: DocumentParams) -> tuple[DataFrame, DataFrame, list[str]]:
    """Base rows whose newest valid document is later than their newest invalid one, with its date; the documents of a
    key and date with ``_n_doc``, the ``#INVALID`` rows they stand for; and the columns that join the two."""
    never = ts_lit(SENTINEL_NEVER_DATE)
    dates = exception_dates(b, d).where(F.col("valid_dt") > F.coalesce(F.col("invalid_dt"), never)).select("exception_id", "valid_dt")
    rows = F.col("n_valid") + F.col("n_invalid")
    if p.match_on == "loan":
        # every document of the loan at that date, whichever exception asked for it
        key = "loan_number"
        docs = d.groupBy("loan_number", F.col("cre_dt").alias("valid_dt"), "obj_id").agg(F.sum(F.col("n_asking") * rows).alias("_n_doc"))
    else:
        key = "exception_id"
        own = (offers(b, "exception_id", "loan_number").groupBy("exception_id", "loan_number", "code", "recent_only")
               .agg(F.count(F.lit(1)).alias("_n_off")).join(dates, "exception_id"))
        docs = (own.join(d.withColumnRenamed("cre_dt", "valid_dt"), ["loan_number", "code", "valid_dt"])
                .where(~F.col("recent_only") | F.col("recent"))
                .groupBy("exception_id", "valid_dt", "obj_id").agg(F.sum(F.col("_n_off") * rows).alias("_n_doc")))
    return b.select(*SHOWN, "exception_id").join(dates, "exception_id"), docs, [key, "valid_dt"]


def _order() -> list:
    """The whole key, so that the order is unique and a range can split any value."""
    return ["document", F.desc("mca"), "loan_number", "guid", "date_created", "issue", "exception_request_date"]


def latest_valid(b: DataFrame, d: DataFrame, p: DocumentParams, ordered: bool = True) -> DataFrame:
    """Newest valid document per exception, later than its newest invalid one (D5), counted.

    One row for each row the report shows, with ``n_rows``, the number of times it shows it: the base
    rows with these values times the ``#INVALID`` rows of the document.
    """
    a, docs, keys = _newest(b, d, p)
    a = a.groupBy(*dict.fromkeys([*SHOWN, *keys])).agg(F.count(F.lit(1)).alias("_n_base"))
    out = (a.join(docs, keys)
           .groupBy(*SHOWN, braced("obj_id").alias("guid"), F.col("valid_dt").alias("date_created"))
           .agg(F.sum(F.col("_n_base") * F.col("_n_doc")).cast("long").alias("n_rows")).select(*REPORT, "n_rows"))
    return out.orderBy(*_order()) if ordered else out


def latest_valid_rows(b: DataFrame, d: DataFrame, p: DocumentParams, ordered: bool = True) -> DataFrame:
    """The report itself (D5): its rows as often as it shows them, each base row with each ``#INVALID`` row."""
    a, docs, keys = _newest(b, d, p)
    n = F.col("_n_doc")
    out = (a.join(docs, keys).withColumn("guid", braced("obj_id")).withColumnRenamed("valid_dt", "date_created")
           .select(*REPORT, "_n_doc", F.explode(F.sequence(F.lit(0).cast("long"), F.expr(f"(_n_doc - 1) div {COPIES}"))).alias("_part")))
    if ordered:                      # before the copies are made
        out = out.orderBy(*_order(), "_part")
    return out.select(*REPORT, F.explode(F.sequence(F.lit(1).cast("long"), F.least(F.lit(COPIES), n - F.col("_part") * COPIES))).alias("_copy")) \
        .select(*REPORT)


def run(tables: dict[str, DataFrame], params: DocumentParams | None = None, ordered: bool = True,
        materialized: bool = True) -> JobResult:
    """tables: loan_status, workable, exceptions, assignment, exception_total, roster,
    invalid_documents, document_repository.

    The newest-valid step reads the base three times and the asked documents twice; with
    ``materialized`` it reads one checkpointed copy of each, with the columns that it reads and no others (the base
    has 28, some of them from further joins and groupings).  Single-reader outputs use the plain plans.
    """
    p = params or DocumentParams()
    r: JobResult

    def mat(d):
        return materialize(d) if materialized else d

    r = JobResult({
        # single-reader outputs: plain plans
        "base": lambda: base(tables, p),
        "matches": lambda: document_match(matches(r["base"], tables, p)),
        # read several times: one materialised copy each (not force-partitioned: a loan or exception may
        # hold a large share of the rows)
        "_offers_m": lambda: mat(base(tables, p).select("loan_number", *ASKING)),
        "_base_m": lambda: mat(base(tables, p).select(*SHOWN, *ASKING)),
        "_asked_m": lambda: mat(asked_documents(r["_base_m"], tables, p).drop("original_doc_nm", "n_any")),
        "document_counts": lambda: document_counts(asked_documents(r["base"], tables, p)),
        "exception_dates": lambda: exception_dates(r["_offers_m"], asked_documents(r["_offers_m"], tables, p)),
        "latest_valid": lambda: latest_valid(r["_base_m"], r["_asked_m"], p, ordered),
        "latest_valid_rows": lambda: latest_valid_rows(r["_base_m"], r["_asked_m"], p, ordered),
    })
    return r

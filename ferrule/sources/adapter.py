"""Driver tables in the roles the jobs expect.

The jobs were written against loan-servicing, HR and weather tables that do not ship.  The checks
run the *real* job code over column-renaming views of the driver's TPC-H-like tables; every view is
a lazy projection/aggregation of those tables, so the work grows with the scale factor.
The DuckDB mirror of each view lives in ``ferrule.checks.oracle_views`` and must stay in step.

Fixed parameters of the mapping (not of the jobs): ``AS_OF`` = 2001-09-01 for the loan jobs.
Every ``%`` below assigns a value (a status, an issue, a group); none filters rows.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ferrule.functions.semantics import braced
from ferrule.sources import matchable
from ferrule.sources.scope import table_path

AS_OF = dt.date(2001, 9, 1)
AS_OF_TS = dt.datetime(2001, 9, 1)

# The HOA issue list admitted by the letter job, plus one value it does not admit.
ISSUES = ["Missing", "Missing Contact Info", "Authorization Received - Invalid",
          "BCR- Authorization required", "BCR- Missing Contact information", "BCR- No HOA required",
          "BCR- Uncooperative-Unresponsive", "BCR- Authorization Received",
          "Authorization Received - Valid"]

DRIVER_TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events"]


class Driver:
    """Lazy access to the driver Parquet tables of one scale factor directory.

    Table and view DataFrames are plans, not data: they are built once per session and directory
    (file listing, footer reads and expression construction happen on the driver) and reused.
    """

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root
        self._t: dict[str, DataFrame] = {}
        self._views: dict[str, DataFrame] = {}

    def __getitem__(self, name: str) -> DataFrame:
        if name not in self._t:
            self._t[name] = self.spark.read.parquet(f"{self.root}/{name}.parquet")
        return self._t[name]


_DRIVERS: dict[tuple, Driver] = {}


def driver(spark: SparkSession, root: str) -> Driver:
    key = (spark.sparkContext.applicationId, root)
    if key not in _DRIVERS:
        _DRIVERS[key] = Driver(spark, root)
    return _DRIVERS[key]


def _view(fn):
    """Build a role view once per Driver."""
    def wrapper(d: Driver) -> DataFrame:
        if fn.__name__ not in d._views:
            d._views[fn.__name__] = fn(d)
        return d._views[fn.__name__]
    wrapper.__name__, wrapper.__doc__ = fn.__name__, fn.__doc__
    return wrapper


def stored(d: Driver, view, *match: str) -> DataFrame:
    """A role view stored once for a session with match keys for its filtered text columns, and read back."""
    key = f"{view.__name__}__stored"
    if key not in d._views:
        path = table_path(d.spark, view.__name__)
        matchable.store(view(d), path, match)
        d._views[key] = matchable.load(d.spark, path)
    return d._views[key]


def _s(c) -> F.Column:
    return F.col(c).cast("string")


def _pick(c, values: list[str]) -> F.Column:
    """values[c % len(values)] as a CASE expression (a mapping, not a filter)."""
    m = F.col(c) % len(values)
    e = None
    for i, v in enumerate(values):
        e = F.when(m == i, F.lit(v)) if e is None else e.when(m == i, F.lit(v))
    return e


def _mca(key: str) -> F.Column:
    return F.lit(90.0) + (F.col(key) * 37 % 1100).cast("double") / F.lit(100.0)


# ---- W1/W2 loan roles ---------------------------------------------------------------------------

@_view
def loan_status(d: Driver) -> DataFrame:
    c = d["customer"]
    seg = (F.when(F.col("c_mktsegment") == "AUTOMOBILE", "Grp 1 NSM Balance Sheet")
           .when(F.col("c_mktsegment") == "BUILDING", "Grp 2 FNMA")
           .when(F.col("c_mktsegment") == "FURNITURE", "Grp 3 GNMA excl BofA")
           .when(F.col("c_mktsegment") == "HOUSEHOLD", "Grp 4 Trust / Private exlc BofA"))
    return c.select(
        _s("c_custkey").alias("loan_number"),
        F.when(F.col("c_acctbal") < 0, "Inactive").otherwise("Active").alias("loan_status"),
        F.when(F.col("c_nationkey") == 24, "Litigation").alias("tag_2"),
        F.when(F.col("c_nationkey") == 23, "1").otherwise("0").alias("incurable_flag"),
        F.when(F.col("c_nationkey") == 22, "Grp 5 Excluded").otherwise(seg).alias("group"),
        F.concat(F.lit("Stage "), _s("c_nationkey")).alias("stage"),
        F.when(F.col("c_nationkey") == 21, F.lit(None).cast("double")).otherwise(_mca("c_custkey")).alias("mca_pct"),
    )


@_view
def hud_status(d: Driver) -> DataFrame:
    """One row for each loan, and a second one for some: those loans repeat in the population."""
    c = d["customer"]
    status = _pick("c_custkey", ["Not Started", "HUD Denied", "Not Started", "Pkg Submitted to HUD", "HUD Approved"])
    agent = F.concat(F.lit("Agent "), (F.col("c_custkey") % 7).cast("string"))
    second = F.col("second") == 1
    return (c.withColumn("second", F.explode(F.sequence(F.lit(0), F.when(F.col("c_custkey") % 53 == 0, 1).otherwise(0))))
            .select(_s("c_custkey").alias("loan_number"), F.when(second, "HUD Denied").otherwise(status).alias("hud_status"),
                    F.when(second, "Agent 9").otherwise(agent).alias("hud_assigned_to")))


@_view
def workable(d: Driver) -> DataFrame:
    c = d["customer"]
    return c.select(
        _s("c_custkey").alias("loan_number"),
        F.when(F.col("c_acctbal") > 5000, "Pending QC").otherwise("Complete").alias("final_review_status"),
        F.concat(F.lit("Reviewer "), (F.col("c_custkey") % 3).cast("string")).alias("final_review_assigned_to"),
    )


@_view
def loan_master(d: Driver) -> DataFrame:
    c = d["customer"]
    k = F.col("c_custkey")
    ks = _s("c_custkey")
    as_of = F.lit(AS_OF)
    addr = (F.when(k % 6 == 0, F.concat(F.lit("PO Box "), ks))
            .when(k % 6 == 1, F.concat(F.lit("P.O. BOX "), ks))
            .when(k % 6 == 2, F.concat(F.lit("p o box "), ks))
            .when(k % 6 == 3, F.concat(F.lit("P. O. Box "), ks))
            .otherwise(F.concat(ks, F.lit(" Main St"))))
    zip5 = F.lpad((k % 100000).cast("string"), 5, "0")
    bzip = (F.when(F.col("c_nationkey") == 20, F.lit(None).cast("string"))
            .when(k % 3 == 0, F.lpad(ks, 9, "0"))
            .when(k % 3 == 1, F.concat(zip5, F.lit("   ")))
            .otherwise(zip5))
    return c.select(
        ks.alias("loan_nbr"),
        F.when(F.col("c_nationkey") == 21, F.lit(None).cast("double")).otherwise(_mca("c_custkey")).alias("mca_percent"),
        F.add_months(as_of, (k % 12).cast("int")).cast("timestamp_ntz").alias("curr_year_anniversary"),
        F.add_months(as_of, ((k + 6) % 12).cast("int")).cast("timestamp_ntz").alias("next_year_anniversary"),
        F.concat(F.lit("Status "), F.col("c_mktsegment")).alias("status_description"),
        addr.alias("borrower_mail_address"),
        F.concat(F.lit("City "), _s("c_nationkey")).alias("borrower_mail_city"),
        F.when(F.col("c_nationkey") == 3, "PR").otherwise(F.concat(F.lit("N"), _s("c_nationkey"))).alias("borrower_mail_state"),
        bzip.alias("borrower_mail_zip_code"),
        F.concat(ks, F.lit(" Property Rd")).alias("prop_address"),
        F.concat(F.lit("Town "), _s("c_nationkey")).alias("prop_city"),
        F.concat(F.lit("N"), _s("c_nationkey")).alias("prop_state"),
        F.when(k % 2 == 0, F.lpad(ks, 9, "0")).otherwise(zip5).alias("prop_zip_code"),
    )


@_view
def letter_dates(d: Driver) -> DataFrame:
    """Letter/processing dates per order: one grouped pass over lineitem (partial aggregation)."""
    li = d["lineitem"]
    ln, rf, sd = F.col("l_linenumber"), F.col("l_returnflag"), F.col("l_shipdate")

    def mx(cond, name):
        return F.max(F.when(cond, sd)).alias(name)

    return li.groupBy("l_orderkey").agg(
        mx(ln == 1, "gift_card_letter_sent"), mx(ln == 2, "gift_card_letter_sent_2"), mx(ln == 3, "gift_card_letter_sent_3"),
        mx((ln == 5) & (rf == "A"), "sent_for_gift_card_processing"),
        mx((ln == 3) & (rf == "N"), "document_returned"),
        mx((ln == 4) & (rf == "N"), "ledger_letter_document_returned"),
        mx(ln == 4, "ledger_letter_sent_1"), mx(ln == 5, "ledger_letter_sent_2"), mx(ln == 6, "ledger_letter_sent_3"),
        mx((ln == 6) & (rf == "A"), "ledger_sent_for_gift_card_processing"),
        mx(ln == 7, "non_gc_letter_sent_1"), mx((ln == 1) & (rf == "R"), "non_gc_letter_sent_2"),
        mx((ln == 2) & (rf == "R"), "non_gc_letter_sent_3"),
        mx((ln == 3) & (rf == "A"), "non_gc_letter_document_returned"),
        mx((ln == 7) & (rf == "A"), "sent_to_inspection_vendor"),
    )


@_view
def exceptions(d: Driver) -> DataFrame:
    """Exceptions are orders; some have no id, and some pairs of neighbours (mostly of different loans) share one."""
    o = d["orders"]
    k = F.col("o_orderkey")
    exception_id = F.when(k % 97 == 0, F.lit(None).cast("long")).when(F.floor(k / 2) % 89 == 0, k - k % 2).otherwise(k)
    pr = F.substring("o_orderpriority", 1, 1)
    doc = (F.when(pr == "1", "HOA").when(pr == "2", "Current OCC Cert")
           .when(pr == "3", F.when(k % 2 == 0, "Death Cert HACG").otherwise("Death Cert"))
           .when(pr == "4", F.when(k % 2 == 0, "Trust - HACG").otherwise("TRUST"))
           .otherwise("Proof of Repair"))
    status = (F.when(F.col("o_orderstatus") == "F", F.when(k % 4 == 0, "Resolved").otherwise("CLOSED"))
              .when(F.col("o_orderstatus") == "O", "Open").otherwise("In Process"))
    repairs = (F.when(k % 3 == 0, "Report/Inspection complete repairs are not complete")
               .when(k % 3 == 2, "Repairs complete"))
    base = o.select(
        k.alias("_order"), exception_id.alias("exception_id"), _s("o_custkey").alias("loan_number"), doc.alias("document"),
        _pick("o_orderkey", ISSUES).alias("issue"), status.alias("exception_status"),
        (F.col("o_orderdate") + F.expr("INTERVAL 1 DAY")).alias("exception_status_date"),
        F.concat(F.lit("User "), (k % 5).cast("string")).alias("exception_status_updated_by"),
        F.concat(F.lit("Agent "), (k % 7).cast("string")).alias("exception_assigned_to"),
        F.col("o_orderdate").alias("exception_request_date"),
        repairs.alias("proof_of_repairs_status"),
        F.concat(F.lit("Borrower "), _s("o_custkey")).alias("borrower_name"),
        F.when(F.col("o_custkey") % 2 == 0, F.concat(F.lit("Co-Borrower "), _s("o_custkey"))).alias("coborrower_name"),
    )
    dates = letter_dates(d)
    return base.join(dates, base._order == dates.l_orderkey, "left").drop("l_orderkey", "_order")


# W2 roles
@_view
def assignment(d: Driver) -> DataFrame:
    c = d["customer"]
    return c.select(
        _s("c_custkey").alias("loan_number"),
        _pick("c_custkey", ["Not Started", "HUD Denied", "Not Started", "Pkg Submitted to HUD", "HUD Approved"]).alias("hud_status"),
        F.concat(F.lit("Agent "), (F.col("c_custkey") % 7).cast("string")).alias("hud_assigned_to"),
        F.when(F.col("c_acctbal") > 8000, "Approved").alias("hud_preliminary_title_approval"),
    )


@_view
def exception_total(d: Driver) -> DataFrame:
    o = d["orders"]
    open_ = F.col("o_orderstatus") != "F"
    pr = F.substring("o_orderpriority", 1, 1)
    return o.groupBy("o_custkey").agg(
        F.count(F.when(open_, 1)).cast("int").alias("open_exceptions"),
        F.count(F.when(open_ & (pr == "5"), 1)).cast("int").alias("open_curative"),
        F.count(F.when(open_ & pr.isin("3", "4"), 1)).cast("int").alias("open_hacg"),
    ).select(_s("o_custkey").alias("loan_number"), "open_exceptions", "open_curative", "open_hacg")


@_view
def roster(d: Driver) -> DataFrame:
    n = d["nation"]
    return n.select(F.concat(F.lit("Agent "), _s("n_nationkey")).alias("agnt_nm"),
                    F.concat(F.lit("Manager "), _s("n_regionkey")).alias("mgr_nm"),
                    F.col("n_name").alias("st_loc"))


DOC_TYPES = ["OCCERT", "Trust", "HOADOCS", "C.DEATH", "REPAIRS", "REPAIRINS", "OTHER"]


@_view
def _documents_base(d: Driver) -> DataFrame:
    li, o = d["lineitem"], d["orders"]
    j = li.join(o.select("o_orderkey", "o_custkey"), li.l_orderkey == o.o_orderkey)
    return j


@_view
def document_repository(d: Driver) -> DataFrame:
    j = _documents_base(d)
    code = None
    for i, v in enumerate(DOC_TYPES, start=1):
        code = F.when(F.col("l_linenumber") == i, v) if code is None else code.when(F.col("l_linenumber") == i, v)
    return j.select(
        F.lpad(_s("o_custkey"), 10, "0").alias("loan_key"),
        code.alias("doc_type_cd"),
        F.upper(code).alias("original_doc_nm"),
        F.concat_ws("-", _s("l_orderkey"), _s("l_linenumber"), _s("l_partkey")).alias("obj_id"),
        F.col("l_shipdate").alias("cre_dt"),
    )


@_view
def invalid_documents(d: Driver) -> DataFrame:
    j = _documents_base(d).where((F.col("l_returnflag") == "R") & (F.col("l_discount") == 0))
    return j.select(_s("o_custkey").alias("loan_nbr"),
                    braced(F.concat_ws("-", _s("l_orderkey"), _s("l_linenumber"), _s("l_partkey"))).alias("guid"))


# ---- W3 bonus roles -----------------------------------------------------------------------------

@_view
def status_snapshot(d: Driver) -> DataFrame:
    c = d["customer"]
    m = F.col("c_custkey") % 4
    code = F.when(m == 0, 72).when(m == 1, 0).when(m == 2, 3)
    return c.select(_s("c_custkey").alias("loan_nbr"), code.cast("int").alias("status_code"),
                    F.concat(F.lit("Status "), F.col("c_mktsegment")).alias("status_description"))


@_view
def status_history(d: Driver) -> DataFrame:
    """Loan status history: one row per order, effective on the order date."""
    o = d["orders"]
    pr = F.substring("o_orderpriority", 1, 1)
    code = F.when(pr == "1", 72).when(pr == "2", 0).when(pr == "3", 3).when(pr == "4", 5)
    return o.select(_s("o_custkey").alias("loan_nbr"), code.cast("int").alias("status_code"),
                    F.concat(F.lit("Priority "), F.col("o_orderpriority")).alias("status_description"),
                    F.col("o_orderdate").alias("eff_dttm"))


@_view
def submissions(d: Driver) -> DataFrame:
    o = d["orders"]
    return o.select(_s("o_custkey").alias("loan_nbr"), F.col("o_orderdate").alias("dt_sbmt_to_hud"))


@_view
def denials(d: Driver) -> DataFrame:
    o = d["orders"]
    return o.select(_s("o_custkey").alias("loan_nbr"),
                    F.when(F.col("o_orderstatus") == "F", F.col("o_orderdate")).alias("hud_prelim_ttl_dny_dt"))


# ---- W4 slow-mover roles ------------------------------------------------------------------------

@_view
def exception_history(d: Driver) -> DataFrame:
    e = d["events"]
    x = F.expr("event_id div 4")                 # four events for an exception, two exceptions for a loan
    et = F.col("event_type")
    return e.select(
        x.alias("excp_id"), F.expr("event_id div 8").cast("string").alias("loan_nbr"),
        F.when(et == "click", "Loss Draft").when(et == "view", "LOSS DRAFT").otherwise("Occupancy Cert").alias("doc_desc"),
        F.when(F.col("value") < 10, "Forced Placed Insurance").when(F.col("value") < 20, "Not enough repays")
         .otherwise("Other").alias("issu_desc"),
        F.when(et == "signup", "CLOSED").when(et == "purchase", "Resolved").when(et == "error", "In Process")
         .otherwise("New Exception").alias("excp_sts_desc"),
        F.col("ts").alias("eff_dttm"),
        (F.col("ts") - F.expr("INTERVAL 7 DAYS")).alias("excp_rqst_dttm"),
    )


@_view
def loan_history(d: Driver) -> DataFrame:
    """Loan master history: one row per order, effective 24 years after the order date."""
    o = d["orders"]
    st = F.col("o_orderstatus")
    return o.select(
        _s("o_custkey").alias("loan_nbr"), F.col("o_orderkey").alias("seq"),
        _mca("o_orderkey").alias("mca_percent"),
        F.when(st == "F", "Closed").when(st == "O", "Active").otherwise("Pending").alias("loan_status"),
        F.add_months(F.col("o_orderdate").cast("date"), 288).cast("timestamp_ntz").alias("eff_dttm"),
    )


@_view
def business_dates(d: Driver) -> DataFrame:
    return d["orders"].select(F.col("o_orderdate").alias("bus_proc_dt"))


@_view
def event_dates(d: Driver) -> DataFrame:
    """Processing dates of the exception history (the events' time stamps)."""
    return d["events"].select(F.col("ts").alias("bus_proc_dt"))


# ---- W5 HR roles --------------------------------------------------------------------------------

@_view
def employees(d: Driver) -> DataFrame:
    c, p, o = d["customer"], d["part"], d["orders"]
    hire = o.groupBy("o_custkey").agg(F.min("o_orderdate").cast("date").alias("hire_date"))
    j = (c.join(p.select("p_partkey", "p_name"), c.c_custkey == p.p_partkey, "left")
         .join(hire, c.c_custkey == hire.o_custkey, "left"))
    words = F.split(F.col("p_name"), " ")
    return j.select(
        F.col("c_custkey").alias("emp_no"),
        F.add_months(F.col("hire_date"), -300).alias("birth_date"),
        F.get(words, 0).alias("first_name"), F.get(words, 1).alias("last_name"),      # NULL when missing
        F.when(F.col("c_custkey") % 2 == 0, "M").otherwise("F").alias("gender"),
        F.col("hire_date"),
    )


def _dept_no(c) -> F.Column:
    return F.concat(F.lit("d"), F.lpad(F.col(c).cast("string"), 3, "0"))


@_view
def departments(d: Driver) -> DataFrame:
    return d["nation"].select(_dept_no("n_nationkey").alias("dept_no"), F.col("n_name").alias("dept_name"))


@_view
def dept_emp(d: Driver) -> DataFrame:
    return d["customer"].select(F.col("c_custkey").alias("id"), F.col("c_custkey").alias("emp_no"),
                                _dept_no("c_nationkey").alias("dept_no"),
                                F.lit(dt.date(1990, 1, 1)).alias("from_date"), F.lit(dt.date(9999, 1, 1)).alias("to_date"))


@_view
def salaries(d: Driver) -> DataFrame:
    return d["orders"].select(F.col("o_orderkey").alias("id"), F.col("o_custkey").alias("emp_no"),
                              F.col("o_totalprice").alias("salary"), F.col("o_orderdate").cast("date").alias("from_date"),
                              F.lit(dt.date(9999, 1, 1)).alias("to_date"))


@_view
def titles(d: Driver) -> DataFrame:
    return d["customer"].select(F.col("c_custkey").alias("id"), F.col("c_custkey").alias("emp_no"),
                                F.col("c_mktsegment").alias("title"), F.lit(dt.date(1990, 1, 1)).alias("from_date"),
                                F.lit(dt.date(9999, 1, 1)).alias("to_date"))


@_view
def dept_manager(d: Driver) -> DataFrame:
    s = d["supplier"]
    top = s.groupBy("s_nationkey").agg(F.max("s_suppkey").alias("top_key"))
    j = s.join(top, "s_nationkey", "left")
    return j.select(_dept_no("s_nationkey").alias("dept_no"), F.col("s_suppkey").alias("emp_no"),
                    F.lit(dt.date(1990, 1, 1)).alias("from_date"),
                    F.when(F.col("s_suppkey") == F.col("top_key"), F.lit(dt.date(9999, 1, 1)))
                     .otherwise(F.lit(dt.date(2000, 1, 1))).alias("to_date"))


# ---- W6 climate roles ---------------------------------------------------------------------------

@_view
def station(d: Driver) -> DataFrame:
    """Stations are suppliers (the station list grows with the scale factor)."""
    s = d["supplier"]
    return s.select(F.col("s_name").alias("station"),
                    F.concat(F.col("s_name"), F.lit(", NATION "), _s("s_nationkey")).alias("name"),
                    (F.lit(20.0) + F.col("s_nationkey").cast("double") / F.lit(10.0)).alias("latitude"),
                    (F.lit(-150.0) - (F.col("s_suppkey") % 10).cast("double") / F.lit(10.0)).alias("longitude"),
                    F.col("s_acctbal").alias("elevation"))


@_view
def measurement(d: Driver) -> DataFrame:
    """Observations are events; a user reports to station ``user_id % (number of stations)``."""
    e, s = d["events"], d["supplier"]
    # the number of stations is a parameter of the mapping, read once per session (a Parquet
    # row count answered from the file footers)
    if "_n_stations" not in d._views:
        d._views["_n_stations"] = s.count()
    keyed = e.withColumn("_station_key", F.col("user_id") % F.lit(d._views["_n_stations"]))
    j = keyed.join(s.select("s_suppkey", "s_name"), keyed._station_key == s.s_suppkey)
    return j.select(F.col("event_id").alias("id"), F.col("s_name").alias("station"),
                    F.col("ts").cast("date").alias("date"),
                    F.when(F.col("event_type") == "error", F.lit(None).cast("double")).otherwise(F.col("value")).alias("prcp"),
                    F.col("value").alias("tobs"))


@_view
def price_series(d: Driver) -> DataFrame:
    """Multi-year daily series (1995-2001): order date and total price as the observation."""
    return d["orders"].select(F.col("o_orderdate").cast("date").alias("date"), F.col("o_totalprice").alias("tobs"))

"""Letter drop: pick the loan population, scrub open exceptions, decide per exception which letter
to send through three ordered rule tables (HOA, occupancy certificate, death/trust/repair), choose
templates per loan, and emit the mailing manifest.

Physical shape.  The report scrubs the exceptions with the population, joins the population to the
result again for each rule table, joins three rule tables back by exception id, and joins five of them by
loan.  Here the population meets the exceptions once:

* ``scrub_pairs`` is that one join: a row for each (loan row, exception) of a loan whose scrub keeps the
  exception, with the population columns, and ``n_kept``, the number of times the report's scrubbed table
  holds the exception (the loan rows that admit it).  Loan rows are counted by loan and threshold before the
  join, so no pair of loan rows is ever made;
* the HOA and OCC tables are filters of it, the NTS table joins it to itself by exception id as the report does;
* the final flags come from one grouping by exception id that carries each table's flags with their counts:
  a repeated id multiplies the rows exactly as the report's joins do, and a NULL id matches nothing;
* the template report counts rows per (loan, kind, template) and multiplies the counts of the kinds
  (``n_rows``), which is the report's row product without its rows.

A row that the report repeats is repeated only at the boundary (``_repeated``); inside, it has a count.
Rule tables are data (``Rule`` lists); ``rule_coverage`` counts the rows each rule decides.
"""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ferrule.functions.rowwise import by_kind, row_count, row_max
from ferrule.functions.rules import Rule, first_match, rule_hits
from ferrule.functions.semantics import (address_class, ci_eq, ci_in, ci_not_in, date_lit, day_diff,
                                         in_or_null, month_diff, real, ts_lit, us_date, zip4)
from ferrule.plans import JobResult
from ferrule.sources.io import materialize
from ferrule.sources.matchable import visible
from ferrule.sources.schemas import LETTER_DATE_COLUMNS

# ---- fixed values of the report ---------------------------------------------------------------
GROUPS = ("Grp 1 NSM Balance Sheet", "Grp 3 GNMA excl BofA", "Grp 2 FNMA", "Grp 4 Trust / Private exlc BofA")
HUD_STATUSES = ("Not Started", "HUD Denied")
CLOSED_STATUSES = ("CLOSED", "RESOLVED", "NOT VALID", "INCURABLE", "CLOSED WITH VENDOR")
HOA_ISSUES = ("Missing", "Missing Contact Info", "Authorization Received - Invalid", "BCR- Authorization required",
              "BCR- Missing Contact information", "BCR- No HOA required", "BCR- Uncooperative-Unresponsive",
              "BCR- Authorization Received")
NON_GC_ISSUES = ("Missing Contact Info", "Authorization Received - Invalid")
VALID_AUTH_ISSUE = "Authorization Received - Valid"
REPAIRS_INCOMPLETE = "Report/Inspection complete repairs are not complete"
NTS_DOCUMENTS = ("Death Cert HACG", "Trust - HACG", "Proof of Repair")
SCRUBBED_DOCUMENTS = ("HOA", "Current OCC Cert", *NTS_DOCUMENTS)
DNS = "DO_NOT_SEND"
AMOUNT = "50"

GC = ["gift_card_letter_sent", "gift_card_letter_sent_2", "gift_card_letter_sent_3"]
LEDGER = ["ledger_letter_sent_1", "ledger_letter_sent_2", "ledger_letter_sent_3"]
NON_GC = ["non_gc_letter_sent_1", "non_gc_letter_sent_2", "non_gc_letter_sent_3"]
# letter columns whose latest value is the "last letter" date, by document kind
MAX_DATE_SETS = {"HOA": GC + LEDGER + NON_GC, "Current OCC Cert": GC + NON_GC}
DEFAULT_MAX_DATE_SET = GC
LTR_COUNT_SET = GC + NON_GC

TEMPLATES = {
    "hoa_template": [(("Send Ledger 1", "Send Ledger 2", "Send Ledger 3"), "94-13 CHP HOA Ledger Template"),
                     (("Send Non GC 1", "Send Non GC 2", "Send Non GC 3"), "94-32 CHP HOA - No Gift Card Template")],
    "occ_template": [(("Send GC 1", "Send GC 2", "Send GC 3"), "93-71 CHP Annual Occupancy Cert with gift card Template"),
                     (("Send Non GC 1", "Send Non GC 2", "Send Non GC 3"),
                      "94-31 CHP Annual Occupancy Cert-No Gift Card Template")],
    "dc_template": [(("Send GC 1", "Send GC 2", "Send GC 3"), "93-65 CHP Death Certificate Template")],
    "trust_template": [(("Send GC 1", "Send GC 2", "Send GC 3"), "93-63 Trust_Giftcard Letter Template")],
    "por_template": [(("Send GC 1",), "93-62 CHP Proof of Repairs Template_5.21.2019"),
                     (("Send GC 2", "Send GC 3"), "93-75 CHP No contact Proof of Repair_5.21.2019")],
}
TEMPLATE_DOCUMENT = {"dc_template": "Death Cert HACG", "trust_template": "Trust - HACG",
                     "por_template": "Proof of Repair"}


@dataclass
class LetterParams:
    as_of: dt.date | dt.datetime | None = None          # run time; default = today
    groups: tuple = GROUPS
    hud_statuses: tuple = HUD_STATUSES
    closed_statuses: tuple = CLOSED_STATUSES
    hoa_issues: tuple = HOA_ISSUES

    def __post_init__(self):
        if self.as_of is None:          # one run, one clock reading
            self.as_of = dt.datetime.now().replace(microsecond=0)

    @property
    def run_ts(self) -> dt.datetime:
        a = self.as_of
        return a if isinstance(a, dt.datetime) else dt.datetime(a.year, a.month, a.day)

    @property
    def run_date(self) -> dt.date:
        return self.run_ts.date()


def mca_flag(c) -> Column:
    """Band of the raw percent; values in the gaps (96.495, 99.995) and NULL are 'Error'."""
    return first_match([
        Rule(c < 95, "< 95"),
        Rule(c.between(95, 96.49), "95 < 96.5"),
        Rule(c.between(96.5, 97.49), "96.5 < 97.5"),
        Rule(c.between(97.5, 99.99), "97.5 < 100"),
        Rule(c >= 100, ">= 100"),
    ], "Error")


# ---- L1 population ------------------------------------------------------------------------------

def population(t: dict[str, DataFrame], p: LetterParams) -> DataFrame:
    a, b = t["loan_status"], t["hud_status"]
    a = a.where(ci_in("loan_status", ["Active"], a) & F.col("tag_2").isNull()
                & F.col("incurable_flag").isin("0") & in_or_null("group", p.groups, df=a))
    b = b.where(ci_in("hud_status", p.hud_statuses, b))
    d = t["loan_master"].withColumnRenamed("loan_nbr", "loan_number")
    j = (a.join(b, "loan_number", "inner")                       # WHERE on B turns the left join inner
         .join(t["workable"], "loan_number", "left")
         .join(d, "loan_number", "left"))
    today = date_lit(p.run_date)
    return j.select(
        "loan_number", "loan_status", "tag_2", "incurable_flag",
        real("mca_percent").alias("mca"), mca_flag(F.col("mca_percent")).alias("mca_flag"),
        "hud_status", "final_review_status", "hud_assigned_to", "final_review_assigned_to", "group",
        "curr_year_anniversary", "next_year_anniversary",
        F.abs(month_diff(today, "curr_year_anniversary")).alias("curr_anni"),
        F.abs(month_diff(today, "next_year_anniversary")).alias("next_anni"),
    )


# ---- L2 exception scrub -------------------------------------------------------------------------

#: The scrub admits an exception by its document and the loan's percent; so many loan rows reach each bound.
BOUNDS = {95: "_n95", 96: "_n96"}


def _admitted(p: LetterParams) -> dict[int, Column]:
    """Percent bound -> the exceptions it applies to (each exception has at most one bound)."""
    doc = F.col("document")
    repairs = ci_not_in(F.coalesce(F.col("proof_of_repairs_status"), F.lit("No Status")), [REPAIRS_INCOMPLETE])
    return {95: ci_in(doc, ["Current Occ Cert", "Death Cert HACG", "Trust - HACG"]) | (ci_in(doc, ["Proof of Repair"]) & repairs),
            96: ci_in(doc, ["HOA"]) & ci_in("issue", p.hoa_issues)}


def loan_rows(pop: DataFrame) -> DataFrame:
    """Population rows, equal ones once (``n_loan``), with the number of the loan's rows that reach each bound."""
    of_loan = Window.partitionBy("loan_number")
    mca, n = F.col("mca"), F.col("n_loan")
    return pop.groupBy(*pop.columns).agg(F.count(F.lit(1)).alias("n_loan")).select(
        "*", *[F.sum(F.when(mca >= k, n).otherwise(0)).over(of_loan).alias(c) for k, c in BOUNDS.items()])


def scrub_pairs(t: dict[str, DataFrame], loans: DataFrame, p: LetterParams) -> DataFrame:
    """Every (loan row, exception) of a loan with a row that admits the exception (L2, and the join of L3-L6).

    Columns of ``loan_rows`` and of the exceptions, ``max_date``, ``ltr_count``, ``n_kept`` (rows of the exception
    in the scrubbed table) and ``admits`` (whether this loan row is one that admits it).  ``loans`` should be a stored
    table: then both sides of the join are plain shuffles, and AQE splits a loan that holds many exceptions.
    """
    mca = F.col("mca")
    kept, admits = F.lit(0), F.lit(False)
    for k, cond in _admitted(p).items():
        cond = F.coalesce(cond, F.lit(False))
        kept = F.when(cond, F.col(BOUNDS[k])).otherwise(kept)
        admits = admits | (cond & F.coalesce(mca >= k, F.lit(False)))
    doc = F.col("document")
    e = t["exceptions"]
    # the documents that any branch admits: implied by the branches, and a filter that can reach the scan
    e = e.where(ci_not_in("exception_status", p.closed_statuses, e) & ci_in("document", SCRUBBED_DOCUMENTS, e))
    return (loans.join(e, "loan_number", "inner")
            .select("*", kept.cast("long").alias("n_kept"), admits.alias("admits"),
                    by_kind(doc, MAX_DATE_SETS, DEFAULT_MAX_DATE_SET, row_max).alias("max_date"),
                    row_count(LTR_COUNT_SET).alias("ltr_count"))
            .where(F.col("n_kept") > 0).drop(*BOUNDS.values()))


def _repeated(df: DataFrame, n: Column) -> DataFrame:
    """Each row as often as the report holds it (almost always once)."""
    return df.withColumn("_copy", F.explode(F.sequence(F.lit(1), n.cast("int")))).drop("_copy")


def exception_scrub(t: dict[str, DataFrame], pop: DataFrame, p: LetterParams) -> DataFrame:
    """The scrubbed exceptions: a row for each loan row that admits the exception."""
    cols = [*visible(t["exceptions"]), "max_date", "ltr_count"]
    return _repeated(scrub_pairs(t, materialize(loan_rows(pop)), p).where("admits"), F.col("n_loan")).select(*cols)


# ---- L3-L5 rule tables --------------------------------------------------------------------------

def _age(p: LetterParams) -> Column:
    """DATEDIFF(DAY, max_date, today): days since the last letter (negative = future date)."""
    return day_diff(F.col("max_date"), date_lit(p.run_date))


def hoa_rules(p: LetterParams) -> list[Rule]:
    mca, age, issue = F.col("mca"), _age(p), F.col("issue")
    nn, nul = (lambda c: F.col(c).isNotNull()), (lambda c: F.col(c).isNull())
    non_gc_issue = ci_in(issue, NON_GC_ISSUES)
    valid_auth = ci_in(issue, [VALID_AUTH_ISSUE])
    return [
        Rule(mca < 95.5, DNS, "mca below 95.5"),
        Rule(F.abs(age) < 30, DNS, "letter within 30 days"),
        Rule(nn("sent_for_gift_card_processing") & nn("ledger_sent_for_gift_card_processing"), DNS, "both processed"),
        Rule(nn("sent_for_gift_card_processing") & (mca < 97) & valid_auth, DNS, "valid auth, gc processed"),
        Rule(nn("non_gc_letter_document_returned") & (mca < 97) & valid_auth, DNS, "valid auth, doc returned"),
        Rule(age <= 20, DNS, "age <= 20"),
        Rule((mca >= 96) & nul("non_gc_letter_sent_1") & non_gc_issue, "Send Non GC 1"),
        Rule((mca >= 96) & nul("non_gc_letter_sent_2") & non_gc_issue, "Send Non GC 2"),
        Rule((mca >= 96) & nul("non_gc_letter_sent_3") & non_gc_issue, "Send Non GC 3"),
        Rule((mca >= 96) & nn("non_gc_letter_sent_3") & non_gc_issue, "Incurable Review - Send Non GC 3"),
        Rule((mca >= 97) & nul("ledger_letter_sent_1"), "Send Ledger 1"),
        Rule((mca >= 97) & nul("ledger_letter_sent_2"), "Send Ledger 2"),
        Rule((mca >= 97) & nul("ledger_letter_sent_3"), "Send Ledger 3"),
        Rule((mca >= 97) & nn("ledger_letter_sent_3"), "Send Ledger 3 - Incurable Review"),
        Rule((mca >= 96.5) & (mca < 97) & nn("sent_for_gift_card_processing"), DNS, "96.5-97 processed"),
    ]


def occ_rules(p: LetterParams) -> list[Rule]:
    mca, age = F.col("mca"), _age(p)
    nn, nul = (lambda c: F.col(c).isNotNull()), (lambda c: F.col(c).isNull())
    hi, lo = mca >= 96.5, mca < 96.5
    return [
        Rule(hi & (age <= 20), DNS, "high mca, age <= 20"),
        Rule(lo & (age <= 30), DNS, "low mca, age <= 30"),
        Rule(hi & nn("sent_for_gift_card_processing"), "Review to Reopen"),
        Rule(hi & nul("gift_card_letter_sent"), "Send GC 1"),
        Rule(hi & nul("gift_card_letter_sent_2"), "Send GC 2"),
        Rule(hi & nul("gift_card_letter_sent_3"), "Send GC 3"),
        Rule(hi & nn("gift_card_letter_sent_3") & (nn("sent_to_inspection_vendor") | nn("ledger_letter_sent_1")),
             DNS, "gc3 sent, inspection or ledger"),
        Rule(hi & nn("gift_card_letter_sent_3") & nn("sent_to_inspection_vendor") & nn("ledger_letter_document_returned"),
             "Send GC 3 - Incurable Review"),
        Rule(lo & (F.col("curr_anni").isin(0, 1) | F.col("next_anni").isin(0, 1)), DNS, "near anniversary"),
        Rule(lo & nul("non_gc_letter_sent_1") & (age >= 30), "Send Non GC 1"),
        Rule(lo & nul("non_gc_letter_sent_2") & (age >= 30), "Send Non GC 2"),
        Rule(lo & nul("non_gc_letter_sent_3") & (age >= 30), "Send Non GC 3"),
        Rule(lo & (age >= 30) & nn("non_gc_letter_sent_3"), DNS, "non gc 3 sent"),
    ]


def nts_rules(p: LetterParams) -> list[Rule]:
    age = _age(p)
    nn, nul = (lambda c: F.col(c).isNotNull()), (lambda c: F.col(c).isNull())
    return [
        Rule(age < 45, DNS, "age < 45"),
        Rule(nn("sent_for_gift_card_processing"), "Review to Reopen"),
        Rule(nul("gift_card_letter_sent"), "Send GC 1"),
        Rule(nul("gift_card_letter_sent_2"), "Send GC 2"),
        Rule(nul("gift_card_letter_sent_3"), "Send GC 3"),
        Rule(nn("gift_card_letter_sent_3") & nn("sent_to_inspection_vendor") & ci_in("document", ["Proof of Repair"]),
             DNS, "gc3 sent, inspection, repair"),
        Rule(nn("gift_card_letter_sent_3"), "Send GC 3 - Incurable Review"),
    ]


def _dated(cols) -> list[Column]:
    return [F.col(c).cast("date").alias(c) for c in cols]


def hoa_rows(j: DataFrame) -> DataFrame:
    return j.where(ci_eq("document", "HOA") & (F.col("mca") >= 96))


def occ_rows(j: DataFrame) -> DataFrame:
    return j.where(ci_eq("document", "Current OCC Cert") & (F.col("mca") >= 95))


def _flagged(j: DataFrame, rules: list[Rule]) -> DataFrame:
    """Rows of a rule table with their flag and ``_n``, how often the report holds the row."""
    return j.withColumn("send_flag", first_match(rules, DNS)).withColumn("_n", F.col("n_loan") * F.col("n_kept"))


def _nts_exceptions(j: DataFrame) -> DataFrame:
    """Scrubbed death/trust/repair exceptions: the rows that admit them, once each (``_n_c``: rows of the scrubbed table)."""
    return j.where(F.col("admits") & ci_in("document", NTS_DOCUMENTS)).withColumn("_n_c", F.col("n_loan"))


_LOAN_SIDE = ["loan_number", "loan_status", "tag_2", "incurable_flag", "mca"]


def nts_rows(j: DataFrame) -> DataFrame:
    """Loan -> exception id -> exception (NTS): the loan columns of the rows that hold an id with the exceptions of that id."""
    loans = (j.where(F.col("mca") >= 95).groupBy("exception_id", *_LOAN_SIDE)
             .agg(F.sum(F.col("n_loan") * F.col("n_kept")).alias("_n_b")))
    return (_nts_exceptions(j).drop(*_LOAN_SIDE).join(loans, "exception_id", "inner")
            .withColumn("_n", F.col("_n_b") * F.col("_n_c")))


def _shown(p: LetterParams) -> list:
    return ["loan_number", date_lit(p.run_date).alias("today"), "loan_status", "tag_2", "incurable_flag", real("mca").alias("mca"), "send_flag",
            "exception_id"]


def _rest(p: LetterParams) -> list:
    return ["document", "exception_status", "issue", *_dated(LETTER_DATE_COLUMNS), F.col("max_date").cast("date").alias("max_date")]


def hoa_frame(j: DataFrame, p: LetterParams) -> DataFrame:
    # as written, the day difference of this report carries the name of the letter count
    return _repeated(_flagged(hoa_rows(j), hoa_rules(p)), F.col("_n")).select(
        *_shown(p), *_rest(p), day_diff(date_lit(p.run_date), F.col("max_date")).alias("ltr_count"))


def occ_frame(j: DataFrame, p: LetterParams) -> DataFrame:
    return _repeated(_flagged(occ_rows(j), occ_rules(p)), F.col("_n")).select(*_shown(p), *_rest(p), "ltr_count")


def nts_frame(j: DataFrame, p: LetterParams) -> DataFrame:
    rows = nts_rows(j).withColumn("send_flag", first_match(nts_rules(p), DNS))
    return _repeated(rows, F.col("_n")).select(*_shown(p), "proof_of_repairs_status", "sent_to_inspection_vendor", *_rest(p), "ltr_count")


# ---- L6 final, L7 templates, L9 manifest --------------------------------------------------------

def flag_counts(j: DataFrame, p: LetterParams) -> DataFrame:
    """(exception_id, hoa, occ, nts): the flags each rule table holds for an id, with the number of its rows.

    The NTS table holds each scrubbed exception of an id once for each of the loan rows that hold the id.
    """
    doc_nts = F.col("admits") & ci_in("document", NTS_DOCUMENTS)
    rows = F.col("n_loan") * F.col("n_kept")

    def entry(kind, cond, flag, n):
        return F.struct(F.lit(kind).alias("kind"), F.when(cond, flag).alias("flag"), n.alias("n"))
    kinds = F.array(
        entry("hoa", ci_eq("document", "HOA") & (F.col("mca") >= 96), first_match(hoa_rules(p), DNS), rows),
        entry("occ", ci_eq("document", "Current OCC Cert") & (F.col("mca") >= 95), first_match(occ_rules(p), DNS), rows),
        entry("nts", doc_nts, first_match(nts_rules(p), DNS), F.col("n_loan")),
        entry("loans", F.col("mca") >= 95, F.lit(""), rows))
    one = (j.where(F.col("exception_id").isNotNull())
           .select("exception_id", F.explode(F.filter(kinds, lambda k: k["flag"].isNotNull())).alias("k"))
           .groupBy("exception_id", "k.kind", "k.flag").agg(F.sum("k.n").alias("n")))
    lists = one.groupBy("exception_id").agg(
        *[F.collect_list(F.when(F.col("kind") == k, F.struct("flag", "n"))).alias(k) for k in ("hoa", "occ", "nts")],
        F.coalesce(F.sum(F.when(F.col("kind") == "loans", F.col("n"))), F.lit(0)).alias("_loans"))
    nts = F.when(F.col("_loans") > 0, F.transform("nts", lambda x: F.struct(x["flag"].alias("flag"), (x["n"] * F.col("_loans")).alias("n"))))
    return lists.select("exception_id", "hoa", "occ", F.coalesce(nts, F.filter("nts", lambda x: F.lit(False))).alias("nts"))


def final_counts(j: DataFrame, p: LetterParams) -> DataFrame:
    """Scrubbed exceptions with the flag of the first table that holds their id, and ``_n`` rows of each."""
    counts = flag_counts(j, p)

    def rows(k):                       # a left join keeps one row where a table has none
        return F.greatest(F.aggregate(k, F.lit(0).cast("long"), lambda s, x: s + x["n"]), F.lit(1))
    first = (F.when(F.size("hoa") > 0, F.transform("hoa", lambda x: F.struct(x["flag"].alias("flag"), (x["n"] * rows("occ") * rows("nts")).alias("n"))))
             .when(F.size("occ") > 0, F.transform("occ", lambda x: F.struct(x["flag"].alias("flag"), (x["n"] * rows("nts")).alias("n"))))
             .when(F.size("nts") > 0, F.col("nts")))
    flags = counts.select("exception_id", first.alias("_flags"))
    none = F.array(F.struct(F.lit(None).cast("string").alias("flag"), F.lit(1).cast("long").alias("n")))
    out = j.join(flags, "exception_id", "left").withColumn("_flag", F.explode(F.coalesce("_flags", none)))
    return out.withColumn("send_flag", F.col("_flag.flag")).withColumn("_n", F.col("_flag.n") * F.col("n_loan") * F.col("n_kept"))


def _final_columns(exceptions: DataFrame) -> list:
    return ["send_flag", F.col("mca").alias("mca_percent"), *visible(exceptions), "max_date", "ltr_count"]


def final_flags(final: DataFrame, exceptions: DataFrame) -> DataFrame:
    return _repeated(final, F.col("_n")).select(*_final_columns(exceptions))


def _template(col: str, flag: Column, doc: Column | None) -> Column:
    e = None
    for flags, name in TEMPLATES[col]:
        cond = flag.isin(list(flags))
        if doc is not None:
            cond = ci_in(doc, [TEMPLATE_DOCUMENT[col]]) & cond
        e = F.when(cond, F.lit(name)) if e is None else e.when(cond, F.lit(name))
    return e


TEMPLATE_COLUMNS = ["hoa_template", "occ_template", "dc_template", "trust_template", "por_template"]


def letter_templates(loans: DataFrame, j: DataFrame, p: LetterParams) -> DataFrame:
    """Template combinations per loan, with ``n_rows``: how many rows of the report's product show them.

    Rows are counted by (loan, kind, template) first, so a kind has at most three entries of a loan; a combination's
    rows are the product of its entries' counts and of the loan's rows in the population.  The product of five counts
    can pass 64 bits, so ``n_rows`` is a decimal.
    """
    flag = F.col("send_flag")
    nts = nts_rows(j).withColumn("send_flag", first_match(nts_rules(p), DNS))
    doc_kind = F.lit(None).cast("string")
    doc_template = F.lit(None).cast("string")
    for col, doc in TEMPLATE_DOCUMENT.items():
        doc_kind = F.when(ci_in("document", [doc]), F.lit(col)).otherwise(doc_kind)
        doc_template = F.when(ci_in("document", [doc]), _template(col, flag, F.col("document"))).otherwise(doc_template)
    rows = (_flagged(hoa_rows(j), hoa_rules(p)).select("loan_number", F.lit("hoa_template").alias("kind"), _template("hoa_template", flag, None).alias("tpl"), "_n")
            .unionByName(_flagged(occ_rows(j), occ_rules(p)).select("loan_number", F.lit("occ_template").alias("kind"), _template("occ_template", flag, None).alias("tpl"), "_n"))
            .unionByName(nts.select("loan_number", doc_kind.alias("kind"), doc_template.alias("tpl"), "_n")))
    bags = (rows.groupBy("loan_number", "kind", "tpl").agg(F.sum("_n").alias("n")).groupBy("loan_number")
            .agg(*[F.collect_list(F.when(F.col("kind") == k, F.struct("tpl", F.col("n").cast("decimal(38,0)").alias("n")))).alias(k)
                   for k in TEMPLATE_COLUMNS]))
    out = loans.groupBy("loan_number").agg(F.sum("n_loan").cast("decimal(38,0)").alias("n_rows")).join(bags, "loan_number", "left")
    none = F.array(F.struct(F.lit(None).cast("string").alias("tpl"), F.lit(1).cast("decimal(38,0)").alias("n")))
    for k in TEMPLATE_COLUMNS:         # a kind without rows is one NULL template
        out = out.withColumn(k, F.explode(F.when(F.size(k) > 0, F.col(k)).otherwise(none)))
        out = out.withColumn("n_rows", (F.col("n_rows") * F.col(f"{k}.n")).cast("decimal(38,0)"))
    return out.select("loan_number", *[F.col(f"{k}.tpl").alias(k) for k in TEMPLATE_COLUMNS], "n_rows")


def manifest(final: DataFrame, master: DataFrame, p: LetterParams, ordered: bool = True) -> DataFrame:
    # NULL flag is dropped too; only the loan's percent from the master is shown
    a = final.where(~F.col("send_flag").isin(DNS)).select("document", "send_flag", "exception_id", "loan_number", "borrower_name", "coborrower_name")
    cmt = master.withColumnRenamed("loan_nbr", "_cmt_loan")                # percent comes from the master
    j = a.join(cmt, a.loan_number == cmt._cmt_loan, "left")
    out = j.select(
        "document", ts_lit(p.run_ts).alias("refreshed"), "send_flag", F.lit(AMOUNT).alias("amount"),
        us_date(date_lit(p.run_date)).alias("letter_date"), "exception_id", F.col("_cmt_loan").alias("loan_nbr"),
        F.col("borrower_name").alias("borr1"), F.coalesce(F.col("coborrower_name"), F.lit(" ")).alias("borr2"),
        "status_description", "borrower_mail_address", "borrower_mail_city", "borrower_mail_state",
        zip4("borrower_mail_zip_code").alias("borrower_mail_zip_code"),
        "prop_address", "prop_city", "prop_state", zip4("prop_zip_code").alias("prop_zip_code"),
        address_class("borrower_mail_state", "borrower_mail_address").alias("po_box_flag"),
        F.col("mca_percent").alias("mca_percent"),
    ).distinct()
    if ordered:
        # document and address class have a handful of values: the ids let the range partitioner split
        # a dominant document across tasks, and make the order of repeated exception ids definite
        out = out.orderBy("document", "po_box_flag", "exception_id", "loan_nbr", "send_flag")
    return out


def rule_coverage(j: DataFrame, p: LetterParams) -> DataFrame:
    """Rows decided by each rule of the three tables (rule 0 = ELSE)."""
    n = F.col("n_loan") * F.col("n_kept")
    return (rule_hits(hoa_rows(j), hoa_rules(p), "HOA", n).unionByName(rule_hits(occ_rows(j), occ_rules(p), "OCC", n))
            .unionByName(rule_hits(nts_rows(j), nts_rules(p), "NTS", F.col("_n"))))


def run(tables: dict[str, DataFrame], params: LetterParams | None = None, ordered: bool = True,
        materialized: bool = True) -> JobResult:
    """tables: loan_status, hud_status, workable, loan_master, exceptions.

    Returns population, exceptions, hoa, occ, nts, final, templates, manifest, rule_hits (each
    built on first access, see ``JobResult``).  The population with its counts is stored (a row for each loan), so
    that its join with the exceptions is one of two plain shuffles; outputs that read the joined pairs several
    times share one stored copy of them.  Every source table is read once.
    """
    p = params or LetterParams()
    r: JobResult

    def mat(df):
        return materialize(df) if materialized else df

    r = JobResult({
        "population": lambda: population(tables, p),
        "exceptions": lambda: _repeated(r["_pairs"].where("admits"), F.col("n_loan")).select(*visible(tables["exceptions"]), "max_date", "ltr_count"),
        "hoa": lambda: hoa_frame(r["_pairs"], p),
        "occ": lambda: occ_frame(r["_pairs"], p),
        # stored once (not force-partitioned: later joins shuffle anyway, and a hot loan would become one task)
        "_loans_m": lambda: mat(loan_rows(population(tables, p))),
        "_pairs": lambda: scrub_pairs(tables, r["_loans_m"], p),
        "_pairs_m": lambda: mat(r["_pairs"]),
        "nts": lambda: nts_frame(r["_pairs_m"], p),
        "final": lambda: final_flags(final_counts(r["_pairs_m"], p), tables["exceptions"]),
        "templates": lambda: letter_templates(r["_loans_m"], r["_pairs_m"], p),
        "manifest": lambda: manifest(final_counts(r["_pairs_m"], p), tables["loan_master"], p, ordered),
        "rule_hits": lambda: rule_coverage(r["_pairs_m"], p),
    })
    return r

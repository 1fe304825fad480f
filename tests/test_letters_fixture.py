"""Letter drop on a generated fixture of boundary rows, against the report's SQL run by DuckDB.

The fixture crosses the boundary values listed in FIXTURES.md: percent edges (incl. 96.49999999 and
the band gaps), letter ages around every threshold (19-21, 29-31, 44-46, future dates, no dates),
letter-slot patterns, every admitted issue plus an unadmitted one and NULL, closed statuses in other
letter case and NULL, document spellings, groups, anniversaries, zip and PO-box forms, a NULL
co-borrower, two exceptions of one kind on a loan and a repeated exception id.
"""
import datetime as dt
import itertools

import duckdb
import pytest
from pyspark.sql import functions as F

from ferrule.checks import oracle_letters as OL
from ferrule.checks.compare import compare
from ferrule.plans import letters as L
from ferrule.sources.schemas import LETTER_DATE_COLUMNS

AS_OF = dt.datetime(2001, 9, 1)
MCAS = [94.999, 95.0, 95.5, 96.0, 96.2, 96.49, 96.495, 96.49999999, 96.5, 96.8, 97.0, 97.49, 97.495, 97.5,
        99.99, 99.995, 100.0, None]
GROUPS = ["Grp 1 NSM Balance Sheet", "grp 2 fnma", None, "Grp 4 Trust / Private exlc BofA", "Other"]
HUD = ["Not Started", "HUD Denied", "not started", "Pkg Submitted to HUD"]
DOCS = ["HOA", "Current OCC Cert", "Current Occ Cert", "Death Cert HACG", "Trust - HACG", "Proof of Repair",
        "TRUST", None]
STATUS = ["Open", "In Process", "closed", "Resolved", "Incurable", None, "CLOSED WITH VENDOR", "Open"]
ISSUES = ["Missing", "Missing Contact Info", "Authorization Received - Invalid", "BCR- Authorization required",
          "BCR- Missing Contact information", "BCR- No HOA required", "BCR- Uncooperative-Unresponsive",
          "BCR- Authorization Received", "Authorization Received - Valid", None]
AGES = [None, 19, 20, 21, 29, 30, 31, 44, 45, 46, -10, -40, 400]
SLOTS = [[], ["gift_card_letter_sent"], ["gift_card_letter_sent", "gift_card_letter_sent_2"],
         ["gift_card_letter_sent", "gift_card_letter_sent_2", "gift_card_letter_sent_3"],
         ["ledger_letter_sent_1"], ["ledger_letter_sent_1", "ledger_letter_sent_2", "ledger_letter_sent_3"],
         ["non_gc_letter_sent_1"], ["non_gc_letter_sent_1", "non_gc_letter_sent_2", "non_gc_letter_sent_3"],
         ["gift_card_letter_sent", "gift_card_letter_sent_2", "gift_card_letter_sent_3", "sent_to_inspection_vendor"],
         ["gift_card_letter_sent_3", "ledger_letter_document_returned", "sent_to_inspection_vendor"],
         ["sent_for_gift_card_processing"], ["sent_for_gift_card_processing", "ledger_sent_for_gift_card_processing"],
         ["non_gc_letter_document_returned", "non_gc_letter_sent_2"]]
ZIPS = ["123456789", "12345", "12345   ", None]
ADDRS = ["PO Box 1", "PO BOX 1", "P.O. Box 1", "P O Box 1", "P. O. BOX 1", "1 Main St"]


def fixture(spark):
    loans, hud, work, master, exc = [], [], [], [], []
    eid = itertools.count(1000)
    for i, mca in enumerate(MCAS * 3):
        k = str(i)
        loans.append((k, "Active" if i % 7 else "active", None, "0", GROUPS[i % len(GROUPS)], "S", mca))
        hud.append((k, HUD[i % len(HUD)], f"A{i % 3}"))
        work.append((k, "F", "R"))
        master.append((k, mca, AS_OF.replace(month=(9 + i % 3 - 1) % 12 + 1), dt.datetime(2002, (i % 12) + 1, 1),
                       "S", ADDRS[i % len(ADDRS)], "C", "PR" if i % 9 == 4 else "N1", ZIPS[i % len(ZIPS)],
                       "P", "PC", "PS", ZIPS[(i + 1) % len(ZIPS)]))
        for j, doc in enumerate(DOCS):
            for r in range(3):
                n = (i * len(DOCS) + j) * 3 + r
                slots = SLOTS[(3 * i + 5 * j + 7 * r) % len(SLOTS)]
                age = AGES[(5 * i + j + 4 * r) % len(AGES)]
                when = None if age is None else AS_OF - dt.timedelta(days=age, hours=(n % 3) * 5)
                dates = {c: (when if c in slots else None) for c in LETTER_DATE_COLUMNS + ["sent_to_inspection_vendor"]}
                if not slots and age is not None:
                    dates["gift_card_letter_sent"] = when
                row = [next(eid), k, doc, ISSUES[(i + 3 * j + r) % len(ISSUES)], STATUS[(3 * i + j + 2 * r) % len(STATUS)],
                       ["Report/Inspection complete repairs are not complete", None, "Done"][n % 3],
                       f"B{k}", None if n % 4 == 0 else f"C{k}"] + \
                    [dates[c] for c in LETTER_DATE_COLUMNS + ["sent_to_inspection_vendor"]]
                exc.append(tuple(row))
                if doc == "HOA" and i % 4 == 1 and r == 0:   # a second exception of the same kind on the loan
                    exc.append(tuple([next(eid)] + row[1:]))
    exc.append(tuple([exc[5][0]] + list(exc[40][1:])))   # a repeated exception id on another loan
    for n, i in enumerate(range(0, 800, 9)):                # ids shared by exceptions of other documents and loans, and NULL ids
        exc.append(tuple([None if n % 4 == 3 else exc[i][0]] + list(exc[i + 389][1:])))
    hud.append(("1", "Not Started", "A9"))                 # a second HUD row: loan 1 repeats in the population
    for k in ("6", "8", "24"):                             # and two percents for one loan, on different sides of a bound
        master.append((k, 95.25 if k != "6" else 96.75, *master[int(k)][2:]))
    s = spark.createDataFrame
    ts = "timestamp_ntz"
    t = {
        "loan_status": s(loans, "loan_number string, loan_status string, tag_2 string, incurable_flag string, "
                                "`group` string, stage string, mca_pct double"),
        "hud_status": s(hud, "loan_number string, hud_status string, hud_assigned_to string"),
        "workable": s(work, "loan_number string, final_review_status string, final_review_assigned_to string"),
        "loan_master": s(master, f"loan_nbr string, mca_percent double, curr_year_anniversary {ts}, "
                                 f"next_year_anniversary {ts}, status_description string, borrower_mail_address string, "
                                 "borrower_mail_city string, borrower_mail_state string, borrower_mail_zip_code string, "
                                 "prop_address string, prop_city string, prop_state string, prop_zip_code string"),
        "exceptions": s(exc, "exception_id long, loan_number string, document string, issue string, exception_status string, "
                             "proof_of_repairs_status string, borrower_name string, coborrower_name string, "
                             + ", ".join(f"{c} {ts}" for c in LETTER_DATE_COLUMNS + ["sent_to_inspection_vendor"])),
    }
    return t


@pytest.fixture(scope="module")
def setup(spark):
    t = fixture(spark)
    con = duckdb.connect()
    for name, df in t.items():
        con.register(f"v_{name}", df.toArrow())
    out = L.run(t, L.LetterParams(as_of=AS_OF), ordered=False)
    return out, con


def sql(body):
    ctes = ",\n".join(f"{n} AS ({q})" for n, q in OL.CTES)
    return f"WITH {ctes}\n{body}"


@pytest.mark.parametrize("part", list(OL.PARTS))
def test_fixture_matches_report_sql(setup, part):
    out, con = setup
    got = out[part].withColumn("n_rows", F.col("n_rows").cast("long")) if part == "templates" else out[part]
    r = compare(got, con, sql(OL.PARTS[part]))
    assert r["cols_match"], r
    assert r["spark_rows"] == r["duck_rows"] and r["spark_rows"] > 0, r
    assert r["values_match"], r


def test_fixture_reaches_many_rules(setup):
    out, _ = setup
    hit = {(r.table, r.rule) for r in out["rule_hits"].collect()}
    assert len(hit) >= 20


def test_fixture_population_repeats_a_loan(setup):
    out, _ = setup
    counts = {r.loan_number: r["count"] for r in out["population"].groupBy("loan_number").count().collect()}
    assert counts.get("1") == 2
    percents = out["population"].groupBy("loan_number").agg(F.countDistinct("mca").alias("n")).where("n > 1")
    assert percents.count() >= 2
    ids = out["exceptions"].groupBy("exception_id").agg(F.countDistinct("loan_number").alias("n")).where("n > 1 or exception_id is null")
    assert ids.count() >= 3

import datetime as dt


from conftest import SF001, SF01
from ferrule.plans import letters as L
from ferrule.sources.schemas import LETTER_DATE_COLUMNS

import __spark_entry__ as E

AS_OF = dt.datetime(2001, 9, 1)
DEAD = {("HOA", 1), ("HOA", 4), ("HOA", 5), ("OCC", 8), ("NTS", 0)}
N_RULES = {"HOA": 15, "OCC": 13, "NTS": 7}


def test_rule_coverage_live_and_dead(spark):
    hits = {}
    for sf in (SF01, SF001):
        for r in E.queries()["rule_hits"](spark, sf).collect():
            hits[(r.table, r.rule)] = hits.get((r.table, r.rule), 0) + r.n
    for key in DEAD:
        assert hits.get(key, 0) == 0, key
    live = {(t, i) for t, n in N_RULES.items() for i in range(0, n + 1)} - DEAD
    assert live <= set(hits), sorted(live - set(hits))


def test_final_keeps_every_scrubbed_exception(spark):
    q = E.queries()
    assert q["final_flags"](spark, SF001).count() >= q["exception_scrub"](spark, SF001).count()
    flags = {r.send_flag for r in q["letter_manifest"](spark, SF001).collect()}
    assert "DO_NOT_SEND" not in flags and None not in flags


def _tables(spark, loans, exceptions):
    ls = spark.createDataFrame([(k, "Active", None, "0", g, "S", m) for k, g, m, *_ in loans],
                               "loan_number string, loan_status string, tag_2 string, incurable_flag string, "
                               "`group` string, stage string, mca_pct double")
    hud = spark.createDataFrame([(k, "Not Started", "A") for k, *_ in loans],
                                "loan_number string, hud_status string, hud_assigned_to string")
    wk = spark.createDataFrame([(k, "Complete", "R") for k, *_ in loans],
                               "loan_number string, final_review_status string, final_review_assigned_to string")
    master = spark.createDataFrame(
        [(k, m, dt.datetime(2001, 9 + 0, 1) if ca == 0 else dt.datetime(2002, 2, 1), dt.datetime(2002, 8, 1),
          "S", addr, "C", st, z, "P", "PC", "PS", z) for k, g, m, ca, addr, st, z in loans],
        "loan_nbr string, mca_percent double, curr_year_anniversary timestamp_ntz, next_year_anniversary timestamp_ntz, "
        "status_description string, borrower_mail_address string, borrower_mail_city string, borrower_mail_state string, "
        "borrower_mail_zip_code string, prop_address string, prop_city string, prop_state string, prop_zip_code string")
    cols = ["exception_id", "loan_number", "document", "issue", "exception_status", "proof_of_repairs_status",
            "borrower_name", "coborrower_name"] + LETTER_DATE_COLUMNS + ["sent_to_inspection_vendor"]
    rows = []
    for e in exceptions:
        base = [e["id"], e["loan"], e["doc"], e.get("issue"), e.get("status", "Open"), e.get("repairs"), "B", None]
        rows.append(tuple(base + [e.get(c) for c in LETTER_DATE_COLUMNS + ["sent_to_inspection_vendor"]]))
    schema = ", ".join(f"{c} {'long' if c == 'exception_id' else 'string' if i < 8 else 'timestamp_ntz'}"
                       for i, c in enumerate(cols))
    exc = spark.createDataFrame(rows, schema)
    return {"loan_status": ls, "hud_status": hud, "workable": wk, "loan_master": master, "exceptions": exc}


def days_ago(n):
    return AS_OF - dt.timedelta(days=n)


def test_letter_scenarios(spark):
    loans = [  # loan, group, mca, curr anniversary months away, address, state, zip
        ("1", "Grp 2 FNMA", 97.2, 5, "PO Box 7", "N1", "123456789"),
        ("2", None, 96.2, 5, "p. o. box 3", "N1", "12345"),
        ("3", "Grp 2 FNMA", 96.0, 5, "1 Main", "N1", "12345   "),
        ("4", "Grp 2 FNMA", 95.5, 5, "PO Box 1", "PR", None),
        ("5", "Other group", 99.0, 5, "1 Main", "N1", "12345"),
    ]
    exceptions = [
        dict(id=10, loan="1", doc="HOA", issue="Missing"),                                     # -> Send Ledger 1
        dict(id=20, loan="2", doc="hoa", issue="Missing Contact Info", non_gc_letter_sent_1=days_ago(40)),
        dict(id=30, loan="3", doc="Current Occ Cert"),                                         # no letter -> else
        dict(id=31, loan="3", doc="Current OCC Cert", status="closed"),                        # scrubbed out
        dict(id=40, loan="4", doc="Death Cert HACG", gift_card_letter_sent=days_ago(50)),      # -> Send GC 2
        dict(id=41, loan="4", doc="Proof of Repair", repairs="Report/Inspection complete repairs are not complete"),
        dict(id=50, loan="5", doc="HOA", issue="Missing"),                                     # group excluded
    ]
    out = L.run(_tables(spark, loans, exceptions), L.LetterParams(as_of=AS_OF))
    final = {r.exception_id: r.send_flag for r in out["final"].collect()}
    assert final == {10: "Send Ledger 1", 20: "Send Non GC 2", 30: "DO_NOT_SEND", 40: "Send GC 2"}
    man = {r.exception_id: (r.borrower_mail_zip_code, r.po_box_flag, r.letter_date, r.amount)
           for r in out["manifest"].collect()}
    assert man == {10: ("12345-6789", "PO BOX", "09/01/2001", "50"), 20: ("12345", "PO BOX", "09/01/2001", "50"),
                   40: (None, "PR Address", "09/01/2001", "50")}
    tpl = {(r.loan_number, r.hoa_template, r.dc_template) for r in out["templates"].collect()}
    assert ("1", "94-13 CHP HOA Ledger Template", None) in tpl
    assert ("4", None, "93-65 CHP Death Certificate Template") in tpl


def test_template_rows_are_the_report_product(spark):
    """Three HOA exceptions (two templates), two repairs, a loan without any: rows multiply, NULL kinds count once."""
    loans = [("1", "Grp 2 FNMA", 97.2, 5, "PO Box 7", "N1", "12345"), ("2", None, 96.2, 5, "1 Main", "N1", "12345")]
    exceptions = [dict(id=10, loan="1", doc="HOA", issue="Missing"), dict(id=11, loan="1", doc="HOA", issue="Missing"),
                  dict(id=12, loan="1", doc="HOA", issue="Missing Contact Info"),
                  dict(id=13, loan="1", doc="Proof of Repair"), dict(id=14, loan="1", doc="Proof of Repair")]
    t = _tables(spark, loans, exceptions)
    t["hud_status"] = t["hud_status"].unionByName(t["hud_status"].where("loan_number = '2'"))
    out = L.run(t, L.LetterParams(as_of=AS_OF))["templates"].collect()
    got = {(r.loan_number, (r.hoa_template or "")[:5], (r.por_template or "")[:5]): int(r.n_rows) for r in out}
    assert got == {("1", "94-13", "93-62"): 4, ("1", "94-32", "93-62"): 2, ("2", "", ""): 2}
    # a hot loan: five million rows of each kind would be a product beyond 64 bits; only counts are multiplied
    many = [dict(id=i, loan="1", doc=d, issue="Missing") for i, d in enumerate(["HOA", "Current OCC Cert", "Death Cert HACG", "Trust - HACG", "Proof of Repair"] * 40)]
    out = L.run(_tables(spark, loans[:1], many), L.LetterParams(as_of=AS_OF))["templates"].collect()
    assert [int(r.n_rows) for r in out] == [40 ** 5]


def test_each_table_is_read_once(spark):
    from ferrule.checks import queries as Q
    from ferrule.sources import adapter as A
    d = A.Driver(spark, SF001)
    for part in ("hoa", "occ"):
        plan = L.run(Q._letter_tables(d), L.LetterParams(as_of=AS_OF))[part]._jdf.queryExecution().optimizedPlan().toString()
        assert plan.count("l_shipdate") and plan.count("Relation [l_") == 1 and plan.count("Relation [o_") == 1, plan
    for part in ("nts", "final", "manifest", "rule_hits"):             # from the one materialised join
        plan = L.run(Q._letter_tables(d), L.LetterParams(as_of=AS_OF))[part]._jdf.queryExecution().optimizedPlan().toString()
        assert "Relation [l_" not in plan and "Relation [o_" not in plan, part


def test_null_and_repeated_exception_ids_follow_the_join_form(spark):
    loans = [("1", "Grp 2 FNMA", 97.2, 5, "PO Box 7", "N1", "12345")]
    for ids, want, sent in (([10, None], [(10, "Send Ledger 1"), (None, None)], [10]),
                            ([10, 10], [(10, "Send Ledger 1")] * 4, [10])):
        exceptions = [dict(id=i, loan="1", doc="HOA", issue="Missing") for i in ids]
        out = L.run(_tables(spark, loans, exceptions), L.LetterParams(as_of=AS_OF))
        assert sorted(((r.exception_id, r.send_flag) for r in out["final"].collect()), key=str) == sorted(want, key=str)
        assert [r.exception_id for r in out["manifest"].collect()] == sent

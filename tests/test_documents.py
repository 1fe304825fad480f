import collections
import datetime as dt

import duckdb
import pandas as pd
import pytest
from pyspark.sql import functions as F

from ferrule.checks import oracle_documents as OD
from ferrule.plans import documents as DOC

AS_OF = dt.datetime(2001, 9, 1)
T = dt.datetime


def fixture():
    loans = ["1", "2", "3", "0"]
    ls = pd.DataFrame({"loan_number": loans, "loan_status": "Active", "tag_2": None, "incurable_flag": "0",
                       "group": "Grp 2 FNMA", "stage": "S", "mca_pct": [97.5, 96.0, None, 99.0]})
    wk = pd.DataFrame({"loan_number": loans, "final_review_status": "F", "final_review_assigned_to": "R"})
    # loan 3 has two assignment rows, so its base rows (and everything built on them) repeat
    asg = pd.DataFrame({"loan_number": loans + ["3"], "hud_status": ["Not Started"] * 4 + ["HUD Denied"],
                        "hud_assigned_to": "Agent 1", "hud_preliminary_title_approval": None})
    tot = pd.DataFrame({"loan_number": loans, "open_exceptions": 1, "open_curative": 0, "open_hacg": 0})
    roster = pd.DataFrame({"agnt_nm": ["Agent 1"], "mgr_nm": ["M"], "st_loc": ["X"]})
    exc = pd.DataFrame([
        (100, "1", "Current OCC Cert", "Open"), (101, "1", "Current OCC Cert", "Open"),
        (200, "2", "HOA", "Open"), (201, "2", "TRUST", "In Process"),
        (300, "3", "Proof of Repair", "Open"), (400, "0", "HOA", "Open"), (401, "1", "Death Cert", "RESOLVED"),
    ], columns=["exception_id", "loan_number", "document", "exception_status"])
    exc["issue"] = "I"
    for c in ["exception_request_date", "exception_status_date"]:
        exc[c] = T(2001, 1, 1)
    exc["exception_status_updated_by"] = "U"
    for c in DOC.GC + DOC.LEDGER + DOC.NON_GC:
        exc[c] = pd.NaT
    docs = pd.DataFrame([
        ("0000000001", "OCCERT", "OCCERT", "a1", T(2001, 1, 1)),
        ("0000000001", "OCCERT", "OCCERT", "a2", T(2001, 3, 1)),
        ("0000000001", "OCCERT", "OCCERT", "a3", T(2001, 5, 1)),     # newest is invalid
        ("2", "HOADOCS", "HOADOCS", "b1", T(2000, 1, 1)),
        ("00000002", "Trust", "TRUST", "b2", T(2000, 1, 1)),          # same date as b1
        ("0000000003", "REPAIRINS", "REPAIRINS", "c1", T(1999, 1, 1)),  # too old for the second code
        ("0000000003", "REPAIRINS", "REPAIRINS", "c2", T(2000, 11, 1)),  # exactly 10 months
        ("0000000003", "REPAIRS", "REPAIRS", "c3", T(1998, 1, 1)),
        ("0000000003", "REPAIRS", "REPAIRS", "c4", T(1998, 1, 1)),
        ("0000000000", "HOADOCS", "HOADOCS", "z1", T(2001, 1, 1)),     # key of only zeros matches nothing
        ("000120 3", "OCCERT", "OCCERT", "w1", T(2001, 1, 1)),
    ], columns=["loan_key", "doc_type_cd", "original_doc_nm", "obj_id", "cre_dt"])
    inv = pd.DataFrame([("1", "{a3}"), ("1", "{zz}"), ("3", "{c4}"), ("3", None)], columns=["loan_nbr", "guid"])
    return {"loan_status": ls, "workable": wk, "assignment": asg, "exception_total": tot, "roster": roster,
            "exceptions": exc, "document_repository": docs, "invalid_documents": inv}


def brute_force(tables, sql):
    con = duckdb.connect()
    names = {"loan_status": "v_loan_status", "workable": "v_workable", "assignment": "v_assignment",
             "exception_total": "v_exception_total", "roster": "v_roster", "exceptions": "v_exceptions",
             "document_repository": "v_document_repository", "invalid_documents": "v_invalid_documents"}
    for k, pdf in tables.items():
        con.register(names[k], pdf)
    ctes = ", ".join(f"{name} AS ({body})" for name, body in OD.CTES)
    return con.execute(f"WITH {ctes} {sql}").fetchall()


def fan_out(pdfs):
    """(loan, document, flag) -> rows, one row at a time: each matched document against each id listed for its loan."""
    base = brute_force(pdfs, "SELECT loan_number, code, within FROM asked")
    rows = collections.Counter()
    for d in pdfs["document_repository"].itertuples():
        loan = d.loan_key.replace("0", " ").lstrip().replace(" ", "0")
        ids = list(pdfs["invalid_documents"].query("loan_nbr == @loan").guid) or [None]
        age = 12 * (AS_OF.year - d.cre_dt.year) + AS_OF.month - d.cre_dt.month
        for b in base:
            if b[0] == loan and b[1] == d.doc_type_cd.upper() and abs(age) <= b[2]:
                for i in ids:
                    rows[loan, d.obj_id, "Invalid" if (i or "").upper() == f"{{{d.obj_id}}}".upper() else "Valid"] += 1
    return dict(rows)


def norm(rows):
    return sorted(tuple(None if (isinstance(v, float) and v != v) else v for v in r) for r in rows)


def to_spark(spark, pdf):
    def typ(c):
        d = pdf[c].dtype
        if str(d).startswith("datetime64"):
            return "timestamp_ntz"
        if str(d) in ("int64", "int32"):
            return "long"
        if str(d) == "float64":
            return "double"
        return "string"
    schema = ", ".join(f"`{c}` {typ(c)}" for c in pdf.columns)
    rows = [tuple(None if (v is pd.NaT or (isinstance(v, float) and v != v)) else
                  (v.to_pydatetime() if isinstance(v, pd.Timestamp) else v) for v in r)
            for r in pdf.itertuples(index=False)]
    return spark.createDataFrame(rows, schema)


def test_count_based_fan_out_equals_brute_force(spark):
    pdfs = fixture()
    for c in DOC.GC + DOC.LEDGER + DOC.NON_GC:
        pdfs["exceptions"][c] = pd.Series([pd.NaT] * len(pdfs["exceptions"]), dtype="datetime64[us]")
    sdfs = {k: to_spark(spark, v) for k, v in pdfs.items()}
    out = DOC.run(sdfs, DOC.DocumentParams(as_of=AS_OF))
    got = norm(tuple(r) for r in out["matches"].select(
        "loan_number", "exception_id", "document", "obj_id", "invalid_excp_type", "cre_dt", "invalid_flag", "n_rows").collect())
    want = norm(brute_force(pdfs, OD.MATCH))
    rows = collections.Counter()
    for r in got:                                       # a document may match several exceptions of its loan
        rows[r[0], r[3], r[6]] += r[7]
    assert dict(rows) == fan_out(pdfs)
    assert got == want and len(got) > 5
    got = norm(tuple(r) for r in out["latest_valid"].select("loan_number", "guid", "date_created", "document", "n_rows").collect())
    want = norm(brute_force(pdfs, "SELECT loan_number, guid, date_created, document, n_rows FROM (" + OD.latest("loan_number") + ")"))
    assert got == want
    # the loan whose newest document is invalid gets nothing; the zero key gets nothing
    assert {r[0] for r in got} == {"2", "3"}


def report_rows(pdfs, by_loan):
    """The final report, one row at a time as it is written: base x #INVALID of the loan, with the exception's dates."""
    base = brute_force(pdfs, "SELECT loan_number, exception_id, document, issue, upper(excp_fn_code), upper(coalesce(por_fn_code_2, 'NOTPOREXCEPTION')) FROM base")
    invalid = []
    for loan, exc, document, issue, own, second in base:
        for d in pdfs["document_repository"].itertuples():
            age = 12 * (AS_OF.year - d.cre_dt.year) + AS_OF.month - d.cre_dt.month
            code = d.doc_type_cd.upper()
            if d.loan_key.replace("0", " ").lstrip().replace(" ", "0") != loan or not (code == own or (code == second and abs(age) <= 10)):
                continue
            for guid in list(pdfs["invalid_documents"].query("loan_nbr == @loan").guid) or [None]:
                invalid.append((loan, exc, d.obj_id, d.cre_dt, (guid or "").upper() == f"{{{d.obj_id}}}".upper()))
    out = collections.Counter()
    for loan, exc, document, issue, *_ in base:
        good = max((r[3] for r in invalid if exc is not None and r[1] == exc and not r[4]), default=None)
        bad = max((r[3] for r in invalid if exc is not None and r[1] == exc and r[4]), default=dt.datetime(1900, 1, 1))
        if good is not None and good > bad:
            for r in invalid:
                if (r[0] == loan if by_loan else r[1] == exc) and r[3] == good:
                    out[loan, f"{{{r[2]}}}", r[3], document, issue] += 1
    return out


def with_odd_ids(pdfs):
    """Exceptions with a NULL id, and an id that two exceptions of different loans and documents share."""
    exc = pdfs["exceptions"]
    more = exc[exc.exception_id.isin([200, 300])].copy()
    more["exception_id"] = more["exception_id"].map({200: None, 300: 201})
    pdfs["exceptions"] = pd.concat([exc.astype({"exception_id": "Int64"}), more.astype({"exception_id": "Int64"})], ignore_index=True).astype({"exception_id": "float64"})
    for c in ["exception_request_date", "exception_status_date", *DOC.GC, *DOC.LEDGER, *DOC.NON_GC]:
        pdfs["exceptions"][c] = pd.to_datetime(pdfs["exceptions"][c]).astype("datetime64[us]")
    return pdfs


@pytest.mark.parametrize("match_on", ["loan", "exception"])
def test_latest_valid_counts_the_rows_of_the_report(spark, match_on):
    pdfs = with_odd_ids(fixture())
    sdfs = {k: to_spark(spark, v) for k, v in pdfs.items()}
    out = DOC.run(sdfs, DOC.DocumentParams(as_of=AS_OF, match_on=match_on))["latest_valid"]
    got = {(r.loan_number, r.guid, r.date_created, r.document, r.issue): r.n_rows for r in out.collect()}
    want = report_rows(pdfs, match_on == "loan")
    assert got == {(a, b, c.to_pydatetime(), d, e): n for (a, b, c, d, e), n in want.items()}
    assert max(got.values()) > 1


@pytest.mark.parametrize("copies", [10_000, 2])
@pytest.mark.parametrize("match_on", ["loan", "exception"])
def test_latest_valid_rows_are_the_rows_of_the_report(spark, monkeypatch, match_on, copies):
    monkeypatch.setattr(DOC, "COPIES", copies)
    pdfs = with_odd_ids(fixture())
    sdfs = {k: to_spark(spark, v) for k, v in pdfs.items()}
    out = DOC.run(sdfs, DOC.DocumentParams(as_of=AS_OF, match_on=match_on))["latest_valid_rows"]
    rows = out.collect()
    got = collections.Counter((r.loan_number, r.guid, r.date_created, r.document, r.issue) for r in rows)
    want = report_rows(pdfs, match_on == "loan")
    assert got == {(a, b, c.to_pydatetime(), d, e): n for (a, b, c, d, e), n in want.items()}
    assert max(got.values()) > 2 and [r.document for r in rows] == sorted(r.document for r in rows)


@pytest.mark.parametrize("name", ["latest_valid_document", "latest_valid_by_exception"])
def test_registered_reports_repeat_rows(spark, name):
    from ferrule.checks.oracle import ORACLE
    from ferrule.checks.queries import QUERIES
    assert "range(" in ORACLE[name] and "n_rows" not in QUERIES[name](spark, "/root/testdata/sf0.001").columns


def test_stored_base_has_only_the_columns_that_are_read(spark):
    pdfs = with_odd_ids(fixture())
    out = DOC.run({k: to_spark(spark, v) for k, v in pdfs.items()}, DOC.DocumentParams(as_of=AS_OF))
    assert out["_base_m"].columns == [*DOC.SHOWN, "exception_id", "excp_fn_code", "por_fn_code_2"]
    assert out["_offers_m"].columns == ["loan_number", "exception_id", "excp_fn_code", "por_fn_code_2"]
    assert not {"original_doc_nm", "n_any"} & set(out["_asked_m"].columns)
    got = {r.exception_id: (r.valid_dt, r.invalid_dt) for r in out["exception_dates"].collect()}
    assert got == {e: (good, bad) for e, good, bad in brute_force(pdfs, OD.DATED)} and len(got) > 3


def output_rows(df):
    """Rows out of every operator of the executed plan (after the action)."""
    found = []

    def walk(p):
        for unwrap in ("executedPlan", "plan"):
            if p.nodeName() in ("AdaptiveSparkPlan", "ResultQueryStage", "ShuffleQueryStage", "BroadcastQueryStage", "TableCacheQueryStage") and hasattr(p, unwrap):
                try:
                    return walk(getattr(p, unwrap)())
                except Exception:                              # the other accessor is the right one
                    continue
        m = p.metrics().get("numOutputRows")
        if m.isDefined():
            found.append((p.nodeName(), m.get().value()))
        for i in range(p.children().size()):
            walk(p.children().apply(i))
    qe = df._jdf.queryExecution()
    qe.toRdd().count()
    walk(qe.executedPlan())
    return found


def test_no_operator_pairs_the_exceptions_of_a_hot_loan_with_its_documents(spark):
    n = 3000
    k = F.when(F.col("id") % 2 == 0, "7").otherwise((100 + F.col("id")).cast("string"))
    exc = spark.range(n).select(F.col("id").alias("exception_id"), k.alias("loan_number"), F.lit("HOA").alias("document"), F.lit("I").alias("issue"))
    base = exc.select("*", F.lit(AS_OF).cast("timestamp_ntz").alias("refreshed"), F.lit(97.0).alias("mca"), F.lit("< 97.5").alias("mca_flag"),
                      F.lit(AS_OF.date()).alias("exception_request_date"), F.lit("HOADOCS").alias("excp_fn_code"), F.lit(None).cast("string").alias("por_fn_code_2"))
    docs = spark.range(n).select(k.alias("loan_key"), F.lit("HOADOCS").alias("doc_type_cd"), F.lit("HOADOCS").alias("original_doc_nm"),
                                 F.col("id").cast("string").alias("obj_id"), F.timestamp_seconds(F.col("id") * 86400).cast("timestamp_ntz").alias("cre_dt"))
    listed = spark.createDataFrame([("7", "{1}")] * 5, "loan_nbr string, guid string")
    p = DOC.DocumentParams(as_of=AS_OF)
    d = DOC.asked_documents(base, {"document_repository": docs, "invalid_documents": listed}, p)
    out = DOC.latest_valid(base, d, p, ordered=False)
    rows = output_rows(out)
    assert len(rows) > 10 and max(r[1] for r in rows) <= 2 * n, rows
    assert out.agg(F.sum("n_rows")).first()[0] == (n // 2) ** 2 * 5 + n // 2      # as many rows as the report would show

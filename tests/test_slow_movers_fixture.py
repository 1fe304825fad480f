"""Slow movers on a boundary fixture, against the report-shaped SQL run by DuckDB."""
import datetime as dt
import itertools

import duckdb

from ferrule.checks import oracle_history as OH
from ferrule.checks.compare import compare
from ferrule.plans import slow_movers as SM

T = dt.datetime
BOM, EOM = dt.date(2024, 1, 10), dt.date(2024, 1, 20)
STATUSES = ["Open", "CLOSED", "resolved", "Not Valid", "In Process", None, "INCURABLE"]
EFFS = [T(2024, 1, 5), T(2024, 1, 9, 23, 59), T(2024, 1, 10), T(2024, 1, 15, 12), T(2024, 1, 20),
        T(2024, 1, 20, 10), T(2024, 1, 21), T(2023, 12, 31)]
DOCS = ["Loss Draft", "loss draft", "Occupancy", None]
ISSUES = ["Forced Placed Insurance", "Not enough repays", "Other", None]


def fixture(spark):
    rows = []
    n = itertools.count()
    for e in range(60):
        for k in range(1 + e % 4):
            i = next(n)
            eff = EFFS[(e + 3 * k) % len(EFFS)]
            rows.append((e, str(e % 17), DOCS[(e + k) % len(DOCS)], ISSUES[(e // 2 + k) % len(ISSUES)],
                         STATUSES[(e + 2 * k) % len(STATUSES)], eff, T(2023, 12, 1) if i % 5 else None))
        if e % 9 == 0:                         # a tie on the last effective time
            last = max(r[5] for r in rows if r[0] == e)
            rows.append((e, str(e % 17), "Loss Draft", "Other", "Open", last, T(2023, 12, 2)))
    hist = spark.createDataFrame(rows, "excp_id long, loan_nbr string, doc_desc string, issu_desc string, "
                                       "excp_sts_desc string, eff_dttm timestamp_ntz, excp_rqst_dttm timestamp_ntz")
    loans = spark.createDataFrame(
        [(str(k), s, 90.0 + k + s / 10, ["Active", "Closed"][s % 2], eff)
         for k in range(20) for s, eff in enumerate([T(2023, 6, 1), T(2024, 1, 12), T(2024, 1, 25)])
         if not (k == 5 and s == 0)],
        "loan_nbr string, seq long, mca_percent double, loan_status string, eff_dttm timestamp_ntz")
    return {"exception_history": hist, "loan_history": loans}


def test_slow_movers_fixture_matches_report_sql(spark):
    t = fixture(spark)
    con = duckdb.connect()
    for name, df in t.items():
        con.register(f"v_{name}", df.toPandas())
    got = SM.run(t, BOM, EOM)
    r = compare(got, con, OH.slow_sql("DATE '2024-01-10'", "DATE '2024-01-20'"))
    assert r["cols_match"] and r["spark_rows"] == r["duck_rows"] > 10 and r["values_match"], r

"""Intermediates that are deleted, match keys that reach the scan, bad CSV lines, checks observed by a write, positions,
parameters."""
import datetime as dt
import os

import pytest
from pyspark.sql import functions as F

from conftest import SF01
from ferrule.functions import sql as FSQL
from ferrule.functions.semantics import ci_in, ci_not_in, in_or_null, money_text
from ferrule.operators import history as H
from ferrule.operators import quality as Q
from ferrule.operators.stats import nth_row
from ferrule.plans import slow_movers as SM
from ferrule.session import ensure_checkpoint_dir
from ferrule.sources import adapter as A
from ferrule.sources import matchable
from ferrule.sources.io import load_csv, materialize
from ferrule.sources.schemas import SCHEMAS
from ferrule.sources.scope import Intermediates, exists, table_path

T = dt.datetime


@pytest.fixture
def folder(spark):
    """The checkpoint folder; ``left`` tells what a test adds to it."""
    path = ensure_checkpoint_dir(spark)
    os.makedirs(path, exist_ok=True)
    BEFORE.clear()
    BEFORE.update(os.listdir(path))
    return path


BEFORE: set[str] = set()


def left(folder):
    return [x for x in os.listdir(folder) if x.startswith("ferrule-") and x not in BEFORE]


def test_intermediates_are_deleted_with_their_block(spark, folder):
    with Intermediates():
        outer = materialize(spark.range(10))
        with Intermediates():
            assert materialize(spark.range(5)).count() == 5 and len(left(folder)) == 2
        assert len(left(folder)) == 1 and outer.count() == 10
    assert left(folder) == []
    with pytest.raises(ZeroDivisionError), Intermediates():
        materialize(spark.range(5))
        raise ZeroDivisionError
    assert left(folder) == []


@pytest.mark.parametrize("fails", [False, True])
def test_jobs_leave_nothing_behind(spark, folder, tmp_path, fails):
    from ferrule import __main__ as cli
    from ferrule.checks import queries as QU
    with Intermediates():
        specs = []
        for name, df in QU._document_tables(A.Driver(spark, "/root/testdata/sf0.001")).items():
            df.write.parquet(str(tmp_path / name))
            specs += ["--table", f"{name}={tmp_path / name}"]
    args = ["documents", *specs, "--as-of", "2001-09-01", "--out", str(tmp_path / "out"), "--output", "latest_valid"]
    if fails:
        with pytest.raises(KeyError):
            cli.main([*args, "--output", "no such output"], spark)
    else:
        assert cli.main(args, spark) == ["latest_valid"]
        assert spark.read.parquet(str(tmp_path / "out" / "latest_valid")).count() > 0
    assert left(folder) == []


def pushed(df):
    plan = df._jdf.queryExecution().executedPlan().toString()
    return " ".join(line for line in plan.splitlines() if "PushedFilters" in line)


def test_text_filters_reach_the_scan(spark):
    from ferrule.checks import queries as QU
    found = pushed(QU.QUERIES["base_population"](spark, SF01))
    assert "loan_status__key" in found and "hud_status__key" in found and "group__key" in found
    found = pushed(QU.QUERIES["open_exception_base"](spark, SF01))
    assert "document__key" in found and "exception_status__key" in found and "hud_status__key" in found
    found = pushed(QU.QUERIES["slow_movers"](spark, SF01))
    assert "doc_desc__key" in found and "issu_desc__key" in found


def test_match_keys_give_the_same_rows(spark, tmp_path):
    rows = [(i, s) for i, s in enumerate(["Open", "open  ", "OPEN", "Closed", None, "", " open", "Öffnen", "öffnen"])]
    df = spark.createDataFrame(rows, "i int, s string")
    matchable.store(df, str(tmp_path / "t"), ["s"])
    kept = matchable.load(spark, str(tmp_path / "t"))
    assert matchable.visible(kept) == ["i", "s"]
    for make in (lambda d: ci_in("s", ["open", "öffnen"], d), lambda d: ci_not_in("s", ["OPEN"], d), lambda d: in_or_null("s", ["open "], df=d)):
        assert sorted(r.i for r in kept.where(make(kept)).collect()) == sorted(r.i for r in df.where(make(df)).collect())
        assert sorted(r.i for r in kept.where(make(None)).collect()) == sorted(r.i for r in df.where(make(None)).collect())


def test_snapshots_in_one_pass(spark):
    rows = [(k, s, v, T(2024, 1, d, h)) for k, s, v, d, h in
            [("a", 1, 1.0, 1, 0), ("a", 2, 2.0, 1, 0), ("a", 3, 3.0, 5, 23), ("b", 4, None, 5, 0), ("c", 5, 5.0, 9, 0), (None, 6, 6.0, 2, 0)]]
    df = spark.createDataFrame(rows, "k string, seq long, v double, eff timestamp_ntz")
    out = {r.k: (r.x and r.x.v, r.y and r.y.v, r.x is None) for r in
           H.snapshots(df, "k", "eff", {"x": dt.date(2024, 1, 4), "y": T(2024, 1, 5, 12)}, ["v"], "seq").collect()}
    assert out == {"a": (2.0, 2.0, False), "b": (None, None, True), None: (6.0, 6.0, False)}
    d = A.driver(spark, SF01)
    h = A.loan_history(d)
    one = H.compare_states(h, "loan_nbr", "eff_dttm", dt.date(2024, 1, 20), dt.date(2024, 1, 10), ["mca_percent", "loan_status"], "seq")
    new, old = (H.snapshot(h, "loan_nbr", "eff_dttm", x, ties=False, tie_break="seq") for x in (dt.date(2024, 1, 20), dt.date(2024, 1, 10)))
    two = H.compare_snapshots(new, old, "loan_nbr", ["mca_percent", "loan_status"])
    assert one.exceptAll(two).count() == 0 and two.exceptAll(one).count() == 0
    plan = one._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Relation [") == 1 and "Window" not in plan


def test_slow_movers_with_given_snapshots(spark):
    d = A.driver(spark, SF01)
    bom, eom = dt.date(2024, 1, 10), dt.date(2024, 1, 20)
    t = {"exception_history": A.exception_history(d), "loan_history": A.loan_history(d)}
    states = SM.loan_states(t, bom, eom)
    given = {"exception_history": t["exception_history"],
             "eom_loans": states.select("loan_nbr", F.col("eom_mca").alias("mca_percent"), F.col("eom_loan_status").alias("loan_status")),
             "bom_loans": states.where("bom_mca is not null").select("loan_nbr", F.col("bom_mca").alias("mca_percent"))}
    a, b = SM.run(t, bom, eom), SM.run(given, bom, eom)
    assert a.count() > 10 and a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


def test_csv_with_bad_lines(spark, folder, tmp_path):
    names = [f.name for f in SCHEMAS["exceptions"]]
    empty = "," * (len(names) - 3)
    (tmp_path / "exceptions.csv").write_text("\n".join([",".join(names), f'7,1,"HOA, new"{empty}', f"x,1,HOA{empty}", "8,1", ""]))
    rows, rejects = load_csv(spark, str(tmp_path / "exceptions.csv"), SCHEMAS["exceptions"])
    assert [(r.exception_id, r.document, r.issue) for r in rows.collect()] == [(7, "HOA, new", None)]
    assert sorted(r.line[:5] for r in rejects.collect()) == ["8,1", "x,1,H"]
    assert rows.columns == [f.name for f in SCHEMAS["exceptions"]]
    (tmp_path / "empty.csv").write_text("loan_nbr,guid\n")
    rows, rejects = load_csv(spark, str(tmp_path / "empty.csv"), SCHEMAS["invalid_documents"])
    assert rows.count() == 0 and rejects.count() == 0


def test_every_job_input_has_a_schema():
    for name in ("exceptions", "assignment", "exception_total", "roster", "invalid_documents", "document_repository", "submissions", "denials",
                 "status_snapshot", "status_history", "loan_history", "business_dates"):
        assert len(SCHEMAS[name].fields) >= 1


def test_checked_write_counts_with_the_write(spark, folder, tmp_path):
    parent = spark.createDataFrame([(1,), (1,), (2,), (None,)], "k long")
    df = spark.createDataFrame([(1, "a"), (3, None), (None, "c"), (3, "d"), (2, None)], "k long, v string")
    got = Q.write_checked(df, str(tmp_path / "t"), None, {"p": ("k", parent, "k")})
    assert got == {"n_rows": 5, "null_k": 1, "null_v": 2, "orphans_p": 2}
    back = spark.read.parquet(str(tmp_path / "t"))
    assert back.columns == ["k", "v"] and back.count() == 5
    assert Q.write_checked(df.limit(0), str(tmp_path / "e")) == {"n_rows": 0, "null_k": 0, "null_v": 0}


@pytest.mark.parametrize("n", [0, 1, 499, 777, 998, 999, 1000])
def test_nth_row_anywhere(spark, n):
    df = spark.range(1000).select(((F.col("id") * 7919) % 1000).alias("x"), F.lit(3).alias("same")).repartition(7)
    assert [r.x for r in nth_row(df, [F.col("same"), F.col("x").desc()], n).collect()] == ([999 - n] if n < 1000 else [])


def test_sql_parameters_are_bound_not_pasted(spark):
    df = spark.createDataFrame([("a'b", dt.date(2024, 1, 5)), ("c", dt.date(2024, 2, 5))], "k string, d date")
    out = FSQL.run_sql(spark, "SELECT k FROM {t} WHERE d <= :until AND k = :name", {"until": dt.date(2024, 1, 31), "name": "a'b"}, t=df)
    assert [r.k for r in out.collect()] == ["a'b"]
    assert FSQL.run_sql(spark, "SELECT k FROM {t} WHERE k = :name", {"name": "' OR 1=1 --"}, t=df).count() == 0


def test_money_text_from_a_million_on(spark):
    cases = {12345678.0: "$1.2345678e+07", 1e6: "$1e+06", 1234567.5: "$1.2345675e+06", 1234568.0: "$1.234568e+06", 999999.0: "$999999", -2.5e9: "$-2.5e+09",
             3.0e12: "$3e+12", 0.0: "$0", 43903968.0: "$4.3903968e+07", 60117.0: "$60117", 1.5: "$1.5"}
    df = spark.createDataFrame([(x,) for x in cases], "x double")
    FSQL.register_functions(spark)
    got = {r.x: (r.a, r.b) for r in df.select("x", money_text("x").alias("a"), F.expr("money_text(x)").alias("b")).collect()}
    assert got == {x: (t, t) for x, t in cases.items()}


def test_exists_and_paths(spark, folder):
    assert exists(spark, folder) and not exists(spark, folder + "/none")
    with Intermediates():
        assert table_path(spark, "x").startswith(folder)

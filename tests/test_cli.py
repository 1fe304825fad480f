import datetime as dt

from ferrule.__main__ import main


def test_cli_runs_a_job_and_writes_outputs(spark, tmp_path):
    T = dt.datetime
    d = tmp_path / "in"
    spark.createDataFrame([("A", 72, "s"), ("B", 0, "s")], "loan_nbr string, status_code int, status_description string") \
        .write.parquet(str(d / "status"))
    spark.createDataFrame([("B", T(2020, 2, 29, 23, 59))], "loan_nbr string, dt_sbmt_to_hud timestamp_ntz") \
        .write.parquet(str(d / "subs"))
    spark.createDataFrame([("A", None)], "loan_nbr string, hud_prelim_ttl_dny_dt timestamp_ntz").write.parquet(str(d / "den"))
    out = tmp_path / "out"
    names = main(["bonus", "--table", f"status_snapshot={d / 'status'}", "--table", f"submissions={d / 'subs'}",
                  "--table", f"denials={d / 'den'}", "--start", "2020-02-01", "--end", "2020-02-29",
                  "--out", str(out)], spark=spark)
    assert names == ["status"]
    got = {r.loan_nbr: r.final_status for r in spark.read.parquet(str(out / "status")).collect()}
    assert got == {"A": "Resolved", "B": "Resolved"}


def test_cli_reads_declared_csv_tables(spark, tmp_path):
    (tmp_path / "employees.csv").write_text(
        "emp_no,birth_date,first_name,last_name,gender,hire_date\n"
        "1,1960-01-01,Hercules,Baer,M,1986-03-01\n2,1961-01-01,Ann,Bee,F,1987-01-01\n")
    out = tmp_path / "out"
    main(["employees", "--table", f"employees={tmp_path / 'employees.csv'}", "--output", "name_prefix",
          "--output", "hired_in_year", "--out", str(out), "--format", "json"], spark=spark)
    assert spark.read.json(str(out / "name_prefix")).count() == 1
    assert spark.read.json(str(out / "hired_in_year")).count() == 1


def test_cli_letters_end_to_end_equals_registered_query(spark, tmp_path):
    from conftest import SF001
    from ferrule.sources import adapter as A
    import __spark_entry__ as E

    d = A.driver(spark, SF001)
    args = ["letters", "--as-of", "2001-09-01", "--out", str(tmp_path / "out"), "--output", "manifest"]
    for name, fn in [("loan_status", A.loan_status), ("hud_status", A.hud_status), ("workable", A.workable),
                     ("loan_master", A.loan_master), ("exceptions", A.exceptions)]:
        path = tmp_path / "in" / name
        fn(d).write.parquet(str(path))
        args += ["--table", f"{name}={path}"]
    main(args, spark=spark)
    written = spark.read.parquet(str(tmp_path / "out" / "manifest"))
    expected = E.queries()["letter_manifest"](spark, SF001)
    written = written.select(*expected.columns)
    for c, t in expected.dtypes:
        if t == "timestamp_ntz":
            written = written.withColumn(c, written[c].cast("timestamp_ntz"))
    assert written.count() == expected.count() > 0
    assert written.exceptAll(expected).count() == 0 and expected.exceptAll(written).count() == 0

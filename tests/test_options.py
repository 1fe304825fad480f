"""Job parameters that switch between the behaviour as written and the intended form."""
import datetime as dt

from conftest import SF01
from ferrule.plans import documents as DOC, employees as EMP, slow_movers as SM
from ferrule.sources import adapter as A


def test_period_bounds_january_and_strict_year(spark):
    dates = spark.createDataFrame([(dt.datetime(2019, 12, 31),), (dt.datetime(2020, 1, 15),), (dt.datetime(2020, 2, 20),),
                                   (dt.datetime(2021, 2, 27),)], "bus_proc_dt timestamp_ntz")
    r = SM.period_bounds(dates, dt.date(2020, 1, 10)).collect()[0]
    assert (r.bom, r.eom, r.bom_int) == (dt.date(2019, 12, 1), dt.date(2019, 12, 31), 20191201)   # January: the December before
    r = SM.period_bounds(dates, dt.date(2020, 1, 10), strict_year=True).collect()[0]
    assert r.eom == dt.date(2019, 12, 31)
    r = SM.period_bounds(dates, dt.date(2020, 3, 1)).collect()[0]
    assert r.eom == dt.date(2021, 2, 27)                                                # any year, as written
    r = SM.period_bounds(dates, dt.date(2020, 3, 1), strict_year=True).collect()[0]
    assert (r.eom, r.eom_int) == (dt.date(2020, 2, 20), 20200220)


def test_slow_movers_eom_day_close(spark):
    T = dt.datetime
    hist = spark.createDataFrame([
        (1, "10", "Loss Draft", "x", "Open", T(2024, 1, 5), T(2024, 1, 1)),
        (1, "10", "Loss Draft", "x", "CLOSED", T(2024, 1, 20, 10), T(2024, 1, 1)),
        (2, "10", "Loss Draft", "x", "Open", T(2024, 1, 5), T(2024, 1, 1)),
        (2, "10", "Loss Draft", "x", "RESOLVED", T(2024, 1, 20, 0), T(2024, 1, 1)),
        (3, "10", "Other", "Not enough repays", "Open", T(2024, 1, 6), T(2024, 1, 2)),
    ], "excp_id long, loan_nbr string, doc_desc string, issu_desc string, excp_sts_desc string, "
       "eff_dttm timestamp_ntz, excp_rqst_dttm timestamp_ntz")
    loans = spark.createDataFrame([("10", 1, 97.0, "Active", T(2023, 1, 1))],
                                  "loan_nbr string, seq long, mca_percent double, loan_status string, eff_dttm timestamp_ntz")
    t = {"exception_history": hist, "loan_history": loans}
    bom, eom = dt.date(2024, 1, 10), dt.date(2024, 1, 20)
    as_written = sorted(r.excp_id for r in SM.run(t, bom, eom).collect())
    inclusive = sorted(r.excp_id for r in SM.run(t, bom, eom, eom_inclusive=True).collect())
    assert as_written == [2, 3] and inclusive == [1, 2, 3]


def test_document_match_on_exception_is_a_subset(spark):
    d = A.driver(spark, SF01)
    t = {"loan_status": A.loan_status(d), "workable": A.workable(d), "exceptions": A.exceptions(d),
         "assignment": A.assignment(d), "exception_total": A.exception_total(d), "roster": A.roster(d),
         "invalid_documents": A.invalid_documents(d), "document_repository": A.document_repository(d)}
    # an id that exceptions of two loans share also picks up the other loan's documents
    once = t["exceptions"].groupBy("exception_id").count().where("count = 1").select("exception_id")
    t["exceptions"] = t["exceptions"].join(once, "exception_id")
    loose = DOC.run(t, DOC.DocumentParams(as_of=A.AS_OF_TS), ordered=False)["latest_valid"]
    tight = DOC.run(t, DOC.DocumentParams(as_of=A.AS_OF_TS, match_on="exception"), ordered=False)["latest_valid"]
    def rows(df):
        return {tuple(r)[:-1]: r.n_rows for r in df.collect()}
    loose, tight = rows(loose), rows(tight)
    assert 0 < len(tight) < len(loose)
    assert all(n <= loose[k] for k, n in tight.items())


def test_name_frequency_ascending_as_coded(spark):
    d = A.driver(spark, SF01)
    t = {"employees": A.employees(d)}
    asc = [r.count_of_last_name for r in EMP.name_frequency(t, descending=False).collect()]
    desc = [r.count_of_last_name for r in EMP.name_frequency(t).collect()]
    assert asc == sorted(asc) and desc == sorted(desc, reverse=True)


def test_slow_movers_month_from_business_dates(spark):
    T = dt.datetime
    hist = spark.createDataFrame([
        (1, "10", "Loss Draft", "x", "Open", T(2024, 1, 5), T(2024, 1, 1)),
        (1, "10", "Loss Draft", "x", "CLOSED", T(2024, 1, 20, 0), T(2024, 1, 1)),
        (2, "10", "Loss Draft", "x", "Open", T(2024, 1, 25), T(2024, 1, 1)),
        (3, "10", "Loss Draft", "x", "Open", T(2024, 2, 2), T(2024, 1, 1)),
    ], "excp_id long, loan_nbr string, doc_desc string, issu_desc string, excp_sts_desc string, "
       "eff_dttm timestamp_ntz, excp_rqst_dttm timestamp_ntz")
    loans = spark.createDataFrame([("10", 1, 97.0, "Active", T(2023, 1, 1))],
                                  "loan_nbr string, seq long, mca_percent double, loan_status string, eff_dttm timestamp_ntz")
    bdates = spark.createDataFrame([(T(2024, 1, 2),), (T(2024, 1, 30),), (T(2024, 2, 1),)], "bus_proc_dt timestamp_ntz")
    t = {"exception_history": hist, "loan_history": loans, "business_dates": bdates}
    got = SM.run_for_month(t, dt.date(2024, 2, 15))
    want = SM.run(t, dt.date(2024, 1, 1), dt.date(2024, 1, 30))
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect()))
    assert sorted(r.excp_id for r in got.collect()) == [1, 2]


def test_slow_movers_january_as_written_is_empty(spark):
    T = dt.datetime
    hist = spark.createDataFrame([(1, "10", "Loss Draft", "x", "Open", T(2023, 12, 5), T(2023, 12, 1))],
                                 "excp_id long, loan_nbr string, doc_desc string, issu_desc string, "
                                 "excp_sts_desc string, eff_dttm timestamp_ntz, excp_rqst_dttm timestamp_ntz")
    loans = spark.createDataFrame([("10", 1, 97.0, "Active", T(2023, 1, 1))],
                                  "loan_nbr string, seq long, mca_percent double, loan_status string, eff_dttm timestamp_ntz")
    bdates = spark.createDataFrame([(T(2023, 12, 29),)], "bus_proc_dt timestamp_ntz")
    t = {"exception_history": hist, "loan_history": loans, "business_dates": bdates}
    assert SM.run_for_month(t, dt.date(2024, 1, 15)).count() == 1               # January: the December before
    assert SM.run_for_month(t, dt.date(2024, 1, 15), strict_year=True).count() == 1

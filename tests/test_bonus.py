import datetime as dt

from pyspark.sql import functions as F

from ferrule.plans import bonus

T = dt.datetime


def test_bonus_boundaries(spark):
    snap = spark.createDataFrame([("A", 72), ("B", 0), ("C", 0), ("D", 3), ("E", None), ("F", None)],
                                 "loan_nbr string, status_code int").withColumn("status_description", F.lit("s"))
    subs = spark.createDataFrame([
        ("B", T(2020, 2, 29, 23, 59)),      # last minute of the last day counts (calendar date)
        ("B", T(2020, 2, 1, 0, 0)),
        ("C", T(2020, 3, 1, 0, 0)),         # outside the window
        ("E", T(2020, 2, 10)),
    ], "loan_nbr string, dt_sbmt_to_hud timestamp_ntz")
    den = spark.createDataFrame([("A", T(2020, 1, 31, 23, 0)), ("A", T(2020, 2, 2, 8, 0)), ("D", None)],
                                "loan_nbr string, hud_prelim_ttl_dny_dt timestamp_ntz")
    out = bonus.run({"status_snapshot": snap, "submissions": subs, "denials": den},
                    dt.date(2020, 2, 1), dt.date(2020, 2, 29)).collect()
    got = {r.loan_nbr: (r.min_submitted, r.max_submitted, r.denial_dt, r.final_status) for r in out}
    assert got == {
        "A": (None, None, dt.date(2020, 2, 2), "Resolved"),                        # code 72
        "B": (T(2020, 2, 1), T(2020, 2, 29, 23, 59), None, "Resolved"),            # code 0 with a submission
        "C": (None, None, None, "Pending"),                                        # code 0, submission outside
        "D": (None, None, None, "Resolved"),                                       # any other code
        "E": (T(2020, 2, 10), T(2020, 2, 10), None, "Pending"),                   # NULL code
        "F": (None, None, None, "Pending"),
    }
    # report order: status, code descending, last submission descending
    assert [r.loan_nbr for r in out] == ["C", "E", "F", "A", "D", "B"]


def test_bonus_takes_the_status_snapshot_from_a_history(spark):
    hist = spark.createDataFrame([
        ("A", 0, "s0", T(2020, 1, 1)), ("A", 72, "s72", T(2020, 2, 29, 18)),     # same day as the end: counts
        ("B", 3, "s3", T(2020, 2, 1)), ("B", 0, "late", T(2020, 3, 1)),         # after the end: ignored
    ], "loan_nbr string, status_code int, status_description string, eff_dttm timestamp_ntz")
    subs = spark.createDataFrame([], "loan_nbr string, dt_sbmt_to_hud timestamp_ntz")
    den = spark.createDataFrame([], "loan_nbr string, hud_prelim_ttl_dny_dt timestamp_ntz")
    out = bonus.run({"status_history": hist, "submissions": subs, "denials": den},
                    dt.date(2020, 2, 1), dt.date(2020, 2, 29)).collect()
    assert {(r.loan_nbr, r.status_code, r.final_status) for r in out} == {("A", 72, "Resolved"), ("B", 3, "Resolved")}

import datetime as dt

from pyspark.sql import functions as F

from ferrule.operators.history import (compare_snapshots, conditional_max, latest_per_key, snapshot,
                                       window_bounds_agg)

T = dt.datetime


def hist(spark):
    rows = [(1, T(2024, 1, 5), "Open", 1), (1, T(2024, 1, 9), "CLOSED", 2), (1, T(2024, 1, 9), "Open", 3),
            (2, T(2024, 1, 3), "Open", 4), (2, T(2024, 1, 20, 10), "CLOSED", 5), (3, T(2024, 2, 1), "Open", 6)]
    return spark.createDataFrame(rows, "k long, eff timestamp_ntz, st string, seq long")


def test_latest_per_key_keeps_ties(spark):
    got = sorted((r.k, r.seq) for r in latest_per_key(hist(spark), "k", "eff").collect())
    assert got == [(1, 2), (1, 3), (2, 5), (3, 6)]
    one = sorted((r.k, r.seq) for r in latest_per_key(hist(spark), "k", ["eff", "seq"], ties=False).collect())
    assert one == [(1, 3), (2, 5), (3, 6)]


def test_latest_per_key_plans_partial_group_limit(spark):
    plan = latest_per_key(hist(spark), "k", "eff")._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan


def test_snapshot_includes_whole_as_of_day(spark):
    s = snapshot(hist(spark), "k", "eff", dt.date(2024, 1, 20), ties=False, tie_break="seq")
    assert sorted((r.k, r.seq) for r in s.collect()) == [(1, 3), (2, 5)]
    s = snapshot(hist(spark), "k", "eff", T(2024, 1, 20), ties=False, tie_break="seq")
    assert sorted((r.k, r.seq) for r in s.collect()) == [(1, 3), (2, 4)]


def test_conditional_max_one_pass(spark):
    df = conditional_max(hist(spark), "k", "eff", {"last": None, "last_open": F.col("st") == "Open",
                                                    "last_closed": F.col("st") == "CLOSED"})
    got = {r.k: (r.last, r.last_open, r.last_closed) for r in df.collect()}
    assert got[1] == (T(2024, 1, 9), T(2024, 1, 9), T(2024, 1, 9))
    assert got[3] == (T(2024, 2, 1), T(2024, 2, 1), None)
    assert "SortMergeJoin" not in df._jdf.queryExecution().executedPlan().toString()


def test_window_bounds_by_calendar_date(spark):
    rows = [("a", T(2020, 2, 29, 23, 59)), ("a", T(2020, 2, 1)), ("a", T(2020, 3, 1)), ("b", T(2020, 1, 31, 23, 59))]
    df = spark.createDataFrame(rows, "k string, d timestamp_ntz")
    got = {r.k: (r.min_date, r.max_date) for r in window_bounds_agg(df, "k", "d", "2020-02-01", "2020-02-29").collect()}
    assert got == {"a": (T(2020, 2, 1), T(2020, 2, 29, 23, 59))}


def test_compare_snapshots_keeps_new_keys(spark):
    new = spark.createDataFrame([(1, 10.0), (2, 20.0)], "k long, v double")
    old = spark.createDataFrame([(1, 9.0)], "k long, v double")
    got = sorted(tuple(r) for r in compare_snapshots(new, old, "k", ["v"]).collect())
    assert got == [(1, 10.0, 9.0), (2, 20.0, None)]

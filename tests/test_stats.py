import datetime as dt
import math

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from ferrule.operators.stats import (count_by, daily_normals, exact_quantiles, histogram, nth_row, range_stats,
                                     summary, two_month_t)


@pytest.mark.parametrize("values,bins", [
    (list(np.random.default_rng(1).normal(70, 5, 500).round(1)), 12),
    ([1.0, 1.0, 1.0], 12),
    ([0.0, 0.1, 0.2, 0.30000000000000004, 1.0], 10),
    (list(np.random.default_rng(2).uniform(-3, 7, 333)), 7),
])
def test_histogram_matches_numpy(spark, values, bins):
    df = spark.createDataFrame([(float(v),) for v in values] + [(None,)], "x double")
    got = histogram(df, "x", bins).orderBy("bin").collect()
    counts, edges = np.histogram(np.array(values), bins=bins)
    assert [r["count"] for r in got] == list(counts)
    assert [r.lower for r in got] == list(edges[:-1])
    assert [r.upper for r in got] == list(edges[1:])


def test_histogram_empty_input(spark):
    df = spark.createDataFrame([(None,)], "x double")
    assert histogram(df, "x", 12).count() == 0


@pytest.mark.parametrize("values", [
    list(np.random.default_rng(3).normal(0, 1, 301)),
    [5.0] * 40 + [1.0, 2.0],                       # one value holds most rows
    [3.0],
])
def test_exact_quantiles_match_numpy(spark, values):
    df = spark.createDataFrame([(float(v),) for v in values], "x double").repartition(5)
    probs = [0.0, 0.25, 0.5, 0.75, 1.0]
    got = {r.p: r.value for r in exact_quantiles(df, "x", probs).collect()}
    for p in probs:
        assert math.isclose(got[p], float(np.percentile(values, p * 100)), rel_tol=1e-12, abs_tol=1e-12)


def test_summary_matches_pandas_describe(spark):
    values = list(np.random.default_rng(4).gamma(2.0, 1.5, 200).round(2))
    df = spark.createDataFrame([(float(v),) for v in values] + [(None,)], "x double")
    r = summary(df, "x").collect()[0]
    d = pd.Series(values).describe()
    for ours, theirs in [("count", "count"), ("mean", "mean"), ("std", "std"), ("min", "min"), ("p25", "25%"),
                         ("p50", "50%"), ("p75", "75%"), ("max", "max")]:
        assert math.isclose(float(r[ours]), float(d[theirs]), rel_tol=1e-9), ours


def test_range_stats_and_empty_range(spark):
    rows = [(dt.date(2017, 8, 1), 70.0), (dt.date(2017, 8, 23), 80.0), (dt.date(2017, 8, 24), None)]
    df = spark.createDataFrame(rows, "date date, tobs double")
    r = range_stats(df, "date", "tobs", "2017-08-01", "2017-08-23").collect()[0]
    assert (r.tmin, r.tavg, r.tmax) == (70.0, 75.0, 80.0)
    r = range_stats(df, "date", "tobs", "2018-01-01").collect()
    assert len(r) == 1 and tuple(r[0]) == (None, None, None)


def test_count_by_descending_with_tie_break(spark):
    df = spark.createDataFrame([("b",), ("a",), ("b",), ("a",), ("c",), (None,)], "n string")
    got = [tuple(r) for r in count_by(df, "n", "n", "cnt").collect()]
    assert got == [("a", 2), ("b", 2), ("c", 1), (None, 0)]


def test_nth_row(spark):
    df = spark.createDataFrame([(i,) for i in range(100, 0, -1)], "x int").repartition(4)
    assert nth_row(df, [F.col("x")], 10).collect()[0].x == 11


def test_daily_normals_and_t(spark):
    rows = [(dt.date(y, m, d), float(y + m + d)) for y in (2015, 2016) for m in (6, 12) for d in (1, 2)]
    df = spark.createDataFrame(rows, "date date, tobs double")
    n = {r.day: (r.tmin, r.tavg, r.tmax) for r in daily_normals(df, "date", "tobs", start="2020-06-01", stop="2020-06-01").collect()}
    assert n == {"06-01": (2022.0, 2022.5, 2023.0)}
    r = two_month_t(df, "date", "tobs").collect()[0]
    a = np.array([v for (d, v) in rows if d.month == 6])
    b = np.array([v for (d, v) in rows if d.month == 12])
    se = a.var(ddof=1) / len(a) + b.var(ddof=1) / len(b)
    assert math.isclose(r.t, (a.mean() - b.mean()) / math.sqrt(se), rel_tol=1e-9)


def test_t_pvalue_known_values():
    from ferrule.operators.stats import t_pvalue
    assert math.isclose(t_pvalue(2.0, 10.0), 0.073388, abs_tol=1e-6)
    assert math.isclose(t_pvalue(1.959964, 1e7), 0.05, abs_tol=1e-5)
    assert math.isclose(t_pvalue(0.0, 5.0), 1.0, abs_tol=1e-12)
    assert t_pvalue(None, 3.0) is None


def test_with_t_pvalue_column(spark):
    from ferrule.operators.stats import with_t_pvalue
    df = spark.createDataFrame([(2.0, 10.0), (None, 4.0)], "t double, dof double")
    got = [r.p_value for r in with_t_pvalue(df).collect()]
    assert math.isclose(got[0], 0.073388, abs_tol=1e-6) and got[1] is None

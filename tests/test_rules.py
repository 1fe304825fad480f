from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

from ferrule.functions.rules import Rule, band, first_match, rule_hits
from ferrule.plans.letters import mca_flag

BOUNDARY = [(94.999, "< 95"), (95.0, "95 < 96.5"), (96.49, "95 < 96.5"), (96.495, "Error"),
            (96.5, "96.5 < 97.5"), (97.0, "96.5 < 97.5"), (97.49, "96.5 < 97.5"), (97.495, "Error"),
            (97.5, "97.5 < 100"), (99.99, "97.5 < 100"), (99.995, "Error"), (100.0, ">= 100"), (None, "Error")]


def test_mca_band_boundaries(spark):
    df = spark.createDataFrame([(v,) for v, _ in BOUNDARY], "x double")
    got = [r[0] for r in df.select(mca_flag(F.col("x"))).collect()]
    assert got == [label for _, label in BOUNDARY]


@settings(max_examples=30, deadline=None)
@given(st.lists(st.floats(min_value=80, max_value=110, allow_nan=False), min_size=1, max_size=40))
def test_each_value_in_at_most_one_band(spark, values):
    bands = [(None, 94.999999, "< 95"), (95, 96.49, "a"), (96.5, 97.49, "b"), (97.5, 99.99, "c"), (100, None, "d")]
    df = spark.createDataFrame([(v,) for v in values], "x double")
    conds = [((F.col("x") >= lo) if lo is not None else F.lit(True)) & ((F.col("x") <= hi) if hi is not None else F.lit(True))
             for lo, hi, _ in bands]
    n_in = sum(c.cast("int") for c in conds)
    for r in df.select(n_in.alias("n"), band(F.col("x"), bands).alias("b")).collect():
        assert r.n <= 1
        assert (r.b == "Error") == (r.n == 0)


def test_first_match_order_and_hits(spark):
    df = spark.createDataFrame([(1,), (5,), (10,), (None,)], "x int")
    rules = [Rule(F.col("x") > 3, "big"), Rule(F.col("x") > 8, "bigger (dead)"), Rule(F.col("x") < 3, "small")]
    got = [r[0] for r in df.select(first_match(rules, "other")).collect()]
    assert got == ["small", "big", "big", "other"]
    hits = {r.rule: r.n for r in rule_hits(df, rules, "t").collect()}
    assert hits == {1: 2, 3: 1, 0: 1}

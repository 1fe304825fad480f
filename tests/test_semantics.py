import datetime as dt

from pyspark.sql import functions as F

from ferrule.functions import semantics as S


def one(spark, expr, rows, schema):
    return [r[0] for r in spark.createDataFrame(rows, schema).select(expr.alias("v")).collect()]


def test_day_diff_counts_boundaries(spark):
    rows = [(dt.datetime(2020, 1, 1, 23, 0), dt.datetime(2020, 1, 2, 1, 0)),
            (dt.datetime(2020, 1, 2, 0, 0), dt.datetime(2020, 1, 1, 23, 59)),
            (None, dt.datetime(2020, 1, 1))]
    assert one(spark, S.day_diff("a", "b"), rows, "a timestamp_ntz, b timestamp_ntz") == [1, -1, None]


def test_month_diff_counts_boundaries(spark):
    rows = [(dt.date(2020, 1, 31), dt.date(2020, 2, 1)), (dt.date(2020, 2, 1), dt.date(2020, 2, 29)),
            (dt.date(2021, 3, 1), dt.date(2020, 1, 1))]
    assert one(spark, S.month_diff("a", "b"), rows, "a date, b date") == [1, 0, -14]


def test_real_is_four_byte_float(spark):
    v = one(spark, S.real("x"), [(96.49999999,), (96.49,)], "x double")
    assert v[0] == 96.5 and v[1] < 96.5


def test_money_text(spark):
    v = one(spark, S.money_text("x"), [(60117.0,), (60117.5,), (112946.26,)], "x double")
    assert v == ["$60117", "$60117.5", "$112946.26"]


def test_zip4(spark):
    v = one(spark, S.zip4("z"), [("123456789",), ("12345",), ("12345   ",), (None,)], "z string")
    assert v == ["12345-6789", "12345", "12345   ", None]


def test_strip_zeros(spark):
    v = one(spark, S.strip_zeros("k"), [("000123",), ("123",), ("0000",), ("000120 3",)], "k string")
    assert v == ["123", "123", "", "12003"]


def test_date_formats(spark):
    rows = [(dt.date(2020, 2, 3),)]
    assert one(spark, S.us_date("d"), rows, "d date") == ["02/03/2020"]
    assert one(spark, S.yyyymmdd("d"), rows, "d date") == [20200203]
    assert one(spark, S.same_day_last_year("d"), [(dt.date(2020, 2, 29),)], "d date") == [dt.date(2019, 2, 28)]


def test_address_class(spark):
    rows = [("N1", "PO Box 1"), ("N1", "PO BOX 1"), ("N1", "P.O. Box 1"), ("N1", "P O Box 1"),
            ("N1", "P. O. BOX 1"), ("PR", "PO Box 9"), ("N1", "12 Main St"), ("N1", "POX Box 1")]
    v = one(spark, S.address_class("s", "a"), rows, "s string, a string")
    assert v == ["PO BOX"] * 5 + ["PR Address", "Standard Address", "Standard Address"]


def test_sentinel_date_text(spark):
    v = one(spark, S.sentinel_date_text("d"), [(dt.date(9999, 1, 1),), (dt.date(1991, 10, 1),)], "d date")
    assert v == ["Still Employeed", "1991-10-01"]


def test_case_insensitive_in_and_null(spark):
    rows = [("Current Occ Cert",), ("current occ cert  ",), ("HOA",), (None,)]
    v = one(spark, S.ci_in("d", ["Current OCC Cert"]), rows, "d string")
    assert v == [True, True, False, None]
    v = one(spark, S.ci_not_in("d", ["CLOSED"]), [("closed",), ("Open",), (None,)], "d string")
    assert v == [False, True, None]


def test_recode_default_and_null(spark):
    m = [(("Trust", "Trust - HACG"), "Trust"), (("Death Cert", "Death Cert HACG"), "Death Cert")]
    rows = [("TRUST",), ("Death Cert HACG",), ("HOA",), (None,)]
    v = one(spark, S.recode(F.col("d"), m, default=F.col("d"), null_value="No Issue"), rows, "d string")
    assert v == ["Trust", "Death Cert", "HOA", "No Issue"]


def test_ci_like_and_in_or_null(spark):
    rows = [("PR",), ("xpr",), ("P.R.",), (None,)]
    assert one(spark, S.ci_like("s", "%PR%"), rows, "s string") == [True, True, False, None]
    rows = [("Grp 2 FNMA",), ("grp 2 fnma",), ("Other",), (None,)]
    assert one(spark, S.in_or_null("g", ["Grp 2 FNMA"]), rows, "g string") == [True, True, False, True]
    assert one(spark, S.in_or_null("g", ["Grp 2 FNMA"], ci=False), rows, "g string") == [True, False, False, True]

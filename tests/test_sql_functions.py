import datetime as dt


from ferrule.functions import semantics as S
from ferrule.functions.sql import register_functions, register_snapshot

T = dt.datetime


def test_sql_functions_agree_with_column_helpers(spark):
    register_functions(spark)
    rows = [(T(2020, 1, 31, 23, 0), T(2020, 2, 1, 1, 0), dt.date(2020, 2, 29), "000120 3", "123456789", 60117.0,
             "PO BOX 9", "PR", " hoa  "),
            (T(2021, 3, 1), T(2020, 1, 1), dt.date(9999, 1, 1), "0000", "12345   ", 112946.26, "P. O. box 2", "N1", "Trust"),
            (None, T(2020, 1, 1), None, None, None, None, None, None, None)]
    df = spark.createDataFrame(rows, "a timestamp_ntz, b timestamp_ntz, d date, k string, z string, x double, "
                                     "addr string, st string, s string")
    df.createOrReplaceTempView("ferrule_sql_fixture")
    via_sql = spark.sql("""SELECT day_diff(a, b), month_diff(a, b), yyyymmdd(d), us_date(d), same_day_last_year(d),
        zip4(z), strip_zeros(k), braced(k), money_text(x), sentinel_date_text(d), address_class(st, addr), ci_key(s)
        FROM ferrule_sql_fixture""").collect()
    via_cols = df.select(S.day_diff("a", "b"), S.month_diff("a", "b"), S.yyyymmdd("d"), S.us_date("d"),
                         S.same_day_last_year("d"), S.zip4("z"), S.strip_zeros("k"), S.braced("k"),
                         S.money_text("x"), S.sentinel_date_text("d"), S.address_class("st", "addr"),
                         S.ci_key("s")).collect()
    assert [tuple(r) for r in via_sql] == [tuple(r) for r in via_cols]


def test_snapshot_table_function(spark):
    rows = [("L1", 1, T(2024, 1, 5)), ("L1", 2, T(2024, 1, 20, 23)), ("L1", 3, T(2024, 1, 21)),
            ("L2", 4, T(2024, 1, 9)), ("L2", 5, T(2024, 1, 9))]
    spark.createDataFrame(rows, "loan string, seq long, eff timestamp_ntz").createOrReplaceTempView("ferrule_hist")
    register_snapshot(spark, "hist_at", "ferrule_hist", "loan", "eff")
    got = sorted((r.loan, r.seq) for r in spark.sql("SELECT * FROM hist_at(DATE'2024-01-20')").collect())
    assert got == [("L1", 2), ("L2", 4), ("L2", 5)]                  # whole as-of day, ties kept
    register_snapshot(spark, "hist_at1", "ferrule_hist", "loan", "eff", ties=False, tie_break="seq")
    got = sorted((r.loan, r.seq) for r in spark.sql("SELECT * FROM hist_at1(DATE'2024-01-20')").collect())
    assert got == [("L1", 2), ("L2", 5)]

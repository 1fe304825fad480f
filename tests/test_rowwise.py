import datetime as dt

from pyspark.sql import functions as F

from ferrule.functions.rowwise import by_kind, row_count, row_max, row_min

D1, D2, D3 = dt.date(2020, 1, 1), dt.date(2020, 5, 1), dt.date(2021, 1, 1)


def test_row_aggregates_ignore_null(spark):
    df = spark.createDataFrame([(D1, None, D2), (None, None, None), (D3, D1, None)], "a date, b date, c date")
    r = df.select(row_max(["a", "b", "c"]).alias("mx"), row_min(["a", "b", "c"]).alias("mn"),
                  row_count(["a", "b", "c"]).alias("n")).collect()
    assert [(x.mx, x.mn, x.n) for x in r] == [(D2, D1, 2), (None, None, 0), (D3, D1, 2)]


def test_by_kind_picks_column_set_case_insensitively(spark):
    df = spark.createDataFrame([("hoa", D1, D3), ("Current OCC Cert", D1, D3), ("Other", D1, D3)],
                               "k string, a date, b date")
    e = by_kind(F.col("k"), {"HOA": ["a", "b"], "Current OCC Cert": ["a"]}, ["b"], row_max)
    assert [r[0] for r in df.select(e).collect()] == [D3, D1, D3]

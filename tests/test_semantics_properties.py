"""The dialect helpers against plain-Python statements of the source semantics, on generated data."""
import datetime as dt

from hypothesis import given, settings, strategies as st

from ferrule.functions import semantics as S

texts = st.text(alphabet="0 1a", max_size=10)
stamps = st.datetimes(min_value=dt.datetime(1990, 1, 1), max_value=dt.datetime(2030, 12, 31))


def strip_zeros_py(x):                   # REPLACE(LTRIM(REPLACE(x,'0',' ')),' ','0')
    return x.replace("0", " ").lstrip(" ").replace(" ", "0")


def zip4_py(z):
    return z[:5] + "-" + z[5:9] if len(z.rstrip(" ")) > 5 else z


@settings(max_examples=8, deadline=None)
@given(st.lists(st.tuples(texts, stamps, stamps), min_size=1, max_size=60))
def test_helpers_match_source_semantics(spark, rows):
    df = spark.createDataFrame(rows, "x string, a timestamp_ntz, b timestamp_ntz")
    got = df.select(S.strip_zeros("x"), S.zip4("x"), S.day_diff("a", "b"), S.month_diff("a", "b"),
                    S.ci_key("x")).collect()
    for (x, a, b), r in zip(rows, got):
        assert r[0] == strip_zeros_py(x)
        assert r[1] == zip4_py(x)
        assert r[2] == (b.date() - a.date()).days                               # day boundaries crossed
        assert r[3] == (b.year * 12 + b.month) - (a.year * 12 + a.month)        # month boundaries crossed
        assert r[4] == x.rstrip(" ").upper()

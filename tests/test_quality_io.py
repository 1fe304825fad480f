import json

from ferrule.operators.quality import fk_orphans, null_counts, pk_violations
from ferrule.sources.io import read_csv, to_json_rows, with_row_id
from ferrule.sources.schemas import SCHEMAS

STATION_CSV = '''station,name,latitude,longitude,elevation
S1,"NORTH FIELD 1.5, HI US",21.2,-157.8,3
S2,"EAST, SOUTH, HI US",21.4,-157.9,
S3,PLAIN,21.5,-158.0,306.6
'''

MANAGER_CSV = '''"dept_no","emp_no","from_date","to_date"
"d900",7,"2001-02-03","2004-05-06"
"d901",8,"2004-05-06","9999-01-01"
'''


def test_read_csv_quoted_commas_and_dates(spark, tmp_path):
    p = tmp_path / "station.csv"
    p.write_text(STATION_CSV)
    df = read_csv(spark, str(p), SCHEMAS["station"])
    rows = df.collect()
    assert [r.name for r in rows] == ["NORTH FIELD 1.5, HI US", "EAST, SOUTH, HI US", "PLAIN"]
    assert rows[1].elevation is None and rows[2].elevation == 306.6
    p2 = tmp_path / "dm.csv"
    p2.write_text(MANAGER_CSV)
    dm = read_csv(spark, str(p2), SCHEMAS["dept_manager"])
    assert str(dm.agg({"to_date": "max"}).collect()[0][0]) == "9999-01-01"


def test_json_rows_keep_nulls(spark):
    df = spark.createDataFrame([("S1", None), ("S2", 3.5)], "station string, elevation double")
    out = [json.loads(r.json) for r in to_json_rows(df).collect()]
    assert out == [{"station": "S1", "elevation": None}, {"station": "S2", "elevation": 3.5}]


def test_row_ids_unique(spark):
    df = with_row_id(spark.range(1000).repartition(7), "rid")
    assert df.select("rid").distinct().count() == 1000


def test_quality_checks(spark):
    parent = spark.createDataFrame([(1,), (2,)], "k long")
    child = spark.createDataFrame([(1, "a"), (3, "b"), (None, "c"), (3, "d")], "k long, v string")
    assert sorted(r.v for r in fk_orphans(child, "k", parent).collect()) == ["b", "d"]
    assert [(r.k, r.n) for r in pk_violations(child, "k").collect()] == [(3, 2)]
    assert null_counts(child).collect()[0].asDict() == {"k": 1, "v": 0}


def test_read_table_qualified(spark):
    from ferrule.sources.io import read_table
    spark.range(3).createOrReplaceGlobalTempView("ferrule_ids")
    assert read_table(spark, "global_temp.ferrule_ids").count() == 3


def test_write_json_rows_keeps_nulls(spark, tmp_path):
    from ferrule.sources.io import write_json_rows
    df = spark.createDataFrame([("S1", None)], "station string, elevation double")
    write_json_rows(df, str(tmp_path / "out"))
    text = "".join(p.read_text() for p in (tmp_path / "out").glob("part-*"))
    assert json.loads(text.strip()) == {"station": "S1", "elevation": None}


def test_read_csv_tables_and_not_null_check(spark, tmp_path):
    from ferrule.sources.io import read_csv_tables
    (tmp_path / "departments.csv").write_text('"dept_no","dept_name"\n"d001","Marketing"\n"d002",\n')
    (tmp_path / "dept_manager.csv").write_text(MANAGER_CSV)
    t = read_csv_tables(spark, str(tmp_path))
    assert sorted(t) == ["departments", "dept_manager"]
    assert null_counts(t["departments"]).collect()[0].asDict() == {"dept_no": 0, "dept_name": 1}
    assert t["dept_manager"].count() == 2

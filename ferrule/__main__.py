"""Run one job on stored tables and write its outputs (for ``spark-submit``).

    spark-submit --py-files ferrule.zip -m ferrule letters \\
        --table loan_status=s3://.../loan_status --table exceptions=s3://.../exceptions ... \\
        --as-of 2001-09-01 --out s3://.../letters/2001-09-01

Each ``--table name=path`` is read as Parquet, or as CSV with the declared schema when the path
ends in ``.csv``.  Every output is written by the executors as Parquet under ``--out/<output>``
(``--format json`` writes JSON lines with NULLs kept).  Nothing is collected to the driver.
"""

from __future__ import annotations

import argparse
import datetime as dt

from pyspark.sql import DataFrame, SparkSession

from ferrule.plans import JobResult, bonus, climate, documents, employees, letters, slow_movers
from ferrule.sources.io import read_csv, write_json_rows
from ferrule.sources.schemas import SCHEMAS
from ferrule.sources.scope import Intermediates


def _date(s: str) -> dt.date:
    return dt.date.fromisoformat(s)


def _employees(t, a) -> JobResult:
    return JobResult({
        "salary_report": lambda: employees.salary_report(t),
        "hired_in_year": lambda: employees.hired_in_year(t, a.year),
        "managers": lambda: employees.managers(t),
        "employee_departments": lambda: employees.employee_departments(t),
        "name_prefix": lambda: employees.name_prefix(t),
        "sales": lambda: employees.employee_departments(t, ["d007"]),
        "sales_and_development": lambda: employees.employee_departments(t, ["d007", "d005"]),
        "name_frequency": lambda: employees.name_frequency(t),
        "salary_histogram": lambda: employees.salary_histogram(t),
        "avg_salary_by_title": lambda: employees.avg_salary_by_title(t),
    })


def _climate(t, a) -> JobResult:
    start, end = a.start, a.end
    m = lambda: t["measurement"]
    s = lambda: t["station"]
    return JobResult({
        "daily_mean": lambda: climate.daily_mean(m(), start, end),
        "precipitation": lambda: climate.precipitation_rows(m(), start, end),
        "station_count": lambda: climate.station_count(s()),
        "station_activity": lambda: climate.station_activity(m()),
        "top_station_hist": lambda: climate.top_station_hist(m(), start),
        "stations": lambda: climate.station_list(s()),
        "date_values": lambda: climate.date_values(m()),
        "tobs_last_year": lambda: climate.last_year_values(m()),
        "temps_from_start": lambda: climate.temperature_stats(m(), start),
        "temps_in_range": lambda: climate.temperature_stats(m(), start, end),
        "precipitation_summary": lambda: climate.precipitation_summary(m(), start, end),
        "trip_last_year": lambda: climate.trip_last_year(m(), start, end),
        "daily_normals": lambda: climate.daily_normals(m(), start, end),
        "rain_per_station": lambda: climate.rain_per_station(m(), s(), start, end),
        "june_december": lambda: climate.june_december(m()),
    })


JOBS = {
    "letters": lambda t, a: letters.run(t, letters.LetterParams(as_of=a.as_of)),
    "documents": lambda t, a: documents.run(t, documents.DocumentParams(as_of=a.as_of, match_on=a.match_on)),
    "bonus": lambda t, a: JobResult({"status": lambda: bonus.run(t, a.start, a.end)}),
    "slow-movers": lambda t, a: JobResult({"report": lambda: slow_movers.run_for_month(
        t, a.as_of, strict_year=a.strict_year, eom_inclusive=a.eom_inclusive)}),
    "employees": _employees,
    "climate": _climate,
}


def parse(argv=None) -> argparse.Namespace:
    ap = argparse.ArgumentParser(prog="ferrule")
    ap.add_argument("job", choices=sorted(JOBS))
    ap.add_argument("--table", action="append", default=[], metavar="NAME=PATH")
    ap.add_argument("--out", required=True)
    ap.add_argument("--format", choices=["parquet", "json"], default="parquet")
    ap.add_argument("--output", action="append", default=None, help="only these outputs (default: all public)")
    ap.add_argument("--as-of", type=_date, default=None)
    ap.add_argument("--start", type=_date, default=None)
    ap.add_argument("--end", type=_date, default=None)
    ap.add_argument("--year", type=int, default=1986)
    ap.add_argument("--match-on", choices=["loan", "exception"], default="loan")
    ap.add_argument("--eom-inclusive", action="store_true")
    ap.add_argument("--strict-year", action="store_true", help="last business date of the month itself, not of that month in any year")
    return ap.parse_args(argv)


def main(argv=None, spark: SparkSession | None = None) -> list[str]:
    a = parse(argv)
    if spark is None:
        from ferrule.session import get_session
        spark = get_session(app_name=f"ferrule-{a.job}")
    tables = {}
    for spec in a.table:
        name, path = spec.split("=", 1)
        tables[name] = read_csv(spark, path, SCHEMAS[name]) if path.endswith(".csv") else spark.read.parquet(path)
    with Intermediates():                    # what the job stores on its way is deleted when it ends, or fails
        outputs = JOBS[a.job](tables, a)
        names = a.output or [n for n in outputs if not n.startswith("_")]
        for n in names:
            path = f"{a.out.rstrip('/')}/{n}"
            if a.format == "json":
                write_json_rows(outputs[n], path)
            else:
                outputs[n].write.mode("overwrite").parquet(path)
    return names

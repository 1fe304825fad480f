"""Employee analysis: eight listing/count queries over a six-table HR schema plus the salary
histogram and average salary by title.

Joins are plain equi-joins on ``emp_no`` / ``dept_no``; ``departments`` is a small dimension that
AQE broadcasts from its runtime size.  Filters use forms that reach the Parquet scan: a hire-year
filter is a half-open date range (not ``year(d) = y``), a first-letter filter is ``startswith``.
Sorts are the report order and run last; each ends in a unique key, so a dominant leading value
cannot pin the range partitioning of the sort to one task.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ferrule.functions.semantics import money_text, sentinel_date_text
from ferrule.operators.stats import count_by, histogram

STILL_EMPLOYED = "Still Employeed"     # fixed label, spelled as in the source report


def salary_report(t: dict[str, DataFrame]) -> DataFrame:
    """H1: employee number, names, gender and salary as '$' text."""
    return (t["employees"].join(t["salaries"], "emp_no")
            .select("emp_no", "last_name", "first_name", "gender", money_text("salary").alias("salary")))


def hired_in_year(t: dict[str, DataFrame], year: int = 1986, ordered: bool = True) -> DataFrame:
    """H2: employees hired in ``year``, by hire date."""
    d = F.col("hire_date")
    out = (t["employees"].where((d >= F.lit(dt.date(year, 1, 1))) & (d < F.lit(dt.date(year + 1, 1, 1))))
           .select("emp_no", "last_name", "first_name", "hire_date"))
    return out.orderBy("hire_date", "emp_no") if ordered else out


def managers(t: dict[str, DataFrame], ordered: bool = True) -> DataFrame:
    """H3: manager of each department with employment start and end (sentinel -> label)."""
    j = t["departments"].join(t["dept_manager"], "dept_no").join(t["employees"], "emp_no")
    out = j.select("dept_no", "dept_name", "emp_no", "last_name", "first_name",
                   F.col("hire_date").alias("start_date"),
                   sentinel_date_text("to_date", label=STILL_EMPLOYED).alias("end_date"), "to_date")
    if ordered:
        out = out.orderBy(F.col("to_date").desc(), "dept_no", "emp_no")
    return out.drop("to_date")


def employee_departments(t: dict[str, DataFrame], dept_nos: Sequence[str] | None = None,
                         ordered: bool = True) -> DataFrame:
    """H4 (all departments), H6/H7 (only ``dept_nos``): employee number, names, department name."""
    de = t["dept_emp"]
    dp = t["departments"]
    if dept_nos is not None:
        de = de.where(F.col("dept_no").isin(list(dept_nos)))
        dp = dp.where(F.col("dept_no").isin(list(dept_nos)))
    out = (t["employees"].join(de.select("emp_no", "dept_no"), "emp_no").join(dp, "dept_no")
           .select("emp_no", "last_name", "first_name", "dept_name"))
    if ordered:
        out = out.orderBy("emp_no") if dept_nos is not None and len(dept_nos) == 1 else out.orderBy("dept_name", "emp_no")
    return out


def name_prefix(t: dict[str, DataFrame], first_name: str = "Hercules", last_prefix: str = "B",
                ordered: bool = True) -> DataFrame:
    """H5: exact first name and last-name prefix (case-sensitive)."""
    out = t["employees"].where((F.col("first_name") == first_name) & F.col("last_name").startswith(last_prefix))
    return out.orderBy("last_name", "emp_no") if ordered else out


def name_frequency(t: dict[str, DataFrame], descending: bool = True) -> DataFrame:
    """H8: how many employees share each last name; descending as the task asks (the script's
    ascending order is ``descending=False``); ties broken by name."""
    return count_by(t["employees"], "last_name", "last_name", "count_of_last_name", descending=descending)


def salary_histogram(t: dict[str, DataFrame], bins: int = 10) -> DataFrame:
    """H9: equal-width salary histogram."""
    return histogram(t["salaries"], "salary", bins)


def avg_salary_by_title(t: dict[str, DataFrame]) -> DataFrame:
    """H10: average salary per title (salaries ⋈ titles on emp_no)."""
    return (t["salaries"].join(t["titles"].select("emp_no", "title"), "emp_no")
            .groupBy("title").agg(F.avg("salary").alias("avg_salary")))

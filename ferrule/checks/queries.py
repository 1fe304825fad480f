"""Registered queries: each takes (spark, sf_dir) and returns a DataFrame over the driver tables.

Every query runs the library's job/operator code on adapter views of the whole driver tables.
Computed columns are aliased to the names used by the DuckDB oracle in ``ferrule.checks.oracle``.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ferrule.functions import sql as FSQL
from ferrule.functions.semantics import money_text
from ferrule.operators import history as H
from ferrule.operators import quality as Q
from ferrule.operators.stats import nth_row
from ferrule.plans import bonus
from ferrule.plans import climate as CL
from ferrule.plans import documents as DOC
from ferrule.plans import employees as EMP
from ferrule.plans import letters as L
from ferrule.plans import slow_movers as SM
from ferrule.sources import adapter as A
from ferrule.sources.io import load_csv, to_json_rows
from ferrule.sources.scope import Intermediates, table_path

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

# Fixed parameters of the checks (date windows shifted into the range of the driver data).
BONUS_START, BONUS_END = dt.date(2000, 2, 1), dt.date(2000, 2, 29)


def register(name: str):
    def deco(fn):
        QUERIES[name] = fn
        return fn
    return deco


def _bonus_tables(d: A.Driver) -> dict[str, DataFrame]:
    return {"status_snapshot": A.status_snapshot(d), "submissions": A.submissions(d), "denials": A.denials(d)}


@register("bonus_status")
def q_bonus_status(spark, sf_dir):
    d = A.driver(spark, sf_dir)
    return bonus.run(_bonus_tables(d), BONUS_START, BONUS_END)


@register("bonus_status_history")
def q_bonus_status_history(spark, sf_dir):
    """The bonus report with its status snapshot taken from a history as of the window end."""
    d = A.driver(spark, sf_dir)
    return bonus.run({"status_history": A.status_history(d), "submissions": A.submissions(d),
                      "denials": A.denials(d)}, BONUS_START, BONUS_END)


@register("bonus_rule_hits")
def q_bonus_rule_hits(spark, sf_dir):
    d = A.driver(spark, sf_dir)
    return bonus.rule_coverage(_bonus_tables(d), BONUS_START, BONUS_END)


@register("window_min_max")
def q_window_min_max(spark, sf_dir):
    d = A.driver(spark, sf_dir)
    return H.window_bounds_agg(A.submissions(d), "loan_nbr", "dt_sbmt_to_hud", BONUS_START, BONUS_END,
                               "min_submitted", "max_submitted")


# ---- W1 letter drop -----------------------------------------------------------------------------


def _letter_tables(d: A.Driver) -> dict[str, DataFrame]:
    return {"loan_status": A.loan_status(d), "hud_status": A.hud_status(d), "workable": A.workable(d),
            "loan_master": A.loan_master(d), "exceptions": A.exceptions(d)}


def _letters(spark, sf_dir) -> dict[str, DataFrame]:
    d = A.driver(spark, sf_dir)
    return L.run(_letter_tables(d), L.LetterParams(as_of=A.AS_OF_TS))


@register("base_population")
def q_base_population(spark, sf_dir):
    """Read from tables stored with match keys, so that the text filters reach their scans."""
    d = A.driver(spark, sf_dir)
    t = _letter_tables(d) | {"loan_status": A.stored(d, A.loan_status, "loan_status", "group"),
                             "hud_status": A.stored(d, A.hud_status, "hud_status")}
    return L.population(t, L.LetterParams(as_of=A.AS_OF_TS))


@register("exception_scrub")
def q_exception_scrub(spark, sf_dir):
    t = _letter_tables(A.driver(spark, sf_dir))
    p = L.LetterParams(as_of=A.AS_OF_TS)
    return L.exception_scrub(t, L.population(t, p), p)


for _key, _part in [("hoa_flags", "hoa"),
                    ("occ_flags", "occ"), ("nts_flags", "nts"), ("final_flags", "final"),
                    ("letter_manifest", "manifest")]:
    def _mk(part):
        def q(spark, sf_dir):
            return _letters(spark, sf_dir)[part]
        q.__name__ = f"q_{part}"
        return q
    QUERIES[_key] = _mk(_part)


@register("letter_templates")
def q_letter_templates(spark, sf_dir):
    out = _letters(spark, sf_dir)["templates"]
    return out.withColumn("n_rows", F.col("n_rows").cast("long"))      # no loan of these tables passes 64 bits


@register("rule_hits")
def q_rule_hits(spark, sf_dir):
    return _letters(spark, sf_dir)["rule_hits"]


# ---- W2 document scrub --------------------------------------------------------------------------


def _document_tables(d: A.Driver) -> dict[str, DataFrame]:
    return {"loan_status": A.loan_status(d), "workable": A.workable(d), "exceptions": A.exceptions(d),
            "assignment": A.assignment(d), "exception_total": A.exception_total(d), "roster": A.roster(d),
            "invalid_documents": A.invalid_documents(d), "document_repository": A.document_repository(d)}


def _documents(spark, sf_dir):
    return DOC.run(_document_tables(A.driver(spark, sf_dir)), DOC.DocumentParams(as_of=A.AS_OF_TS))


@register("open_exception_base")
def q_open_exception_base(spark, sf_dir):
    """Read from tables stored with match keys, so that the text filters reach their scans."""
    d = A.driver(spark, sf_dir)
    t = _document_tables(d) | {"loan_status": A.stored(d, A.loan_status, "loan_status", "group"),
                               "exceptions": A.stored(d, A.exceptions, "document", "exception_status"),
                               "assignment": A.stored(d, A.assignment, "hud_status")}
    return DOC.run(t, DOC.DocumentParams(as_of=A.AS_OF_TS))["base"]


@register("document_match")
def q_document_match(spark, sf_dir):
    return _documents(spark, sf_dir)["matches"]


@register("document_counts")
def q_document_counts(spark, sf_dir):
    return _documents(spark, sf_dir)["document_counts"]


@register("exception_document_dates")
def q_exception_document_dates(spark, sf_dir):
    return _documents(spark, sf_dir)["exception_dates"]


@register("latest_valid_document")
def q_latest_valid_document(spark, sf_dir):
    return _documents(spark, sf_dir)["latest_valid_rows"]


@register("latest_valid_by_exception")
def q_latest_valid_by_exception(spark, sf_dir):
    """The tight form: an exception only picks up its own documents."""
    t = _document_tables(A.driver(spark, sf_dir))
    return DOC.run(t, DOC.DocumentParams(as_of=A.AS_OF_TS, match_on="exception"))["latest_valid_rows"]


@register("row_min_date")
def q_row_min_date(spark, sf_dir):
    return DOC.min_letter_date(A.exceptions(A.driver(spark, sf_dir)))


# ---- W4 slow movers -----------------------------------------------------------------------------

SM_BOM, SM_EOM = dt.date(2024, 1, 10), dt.date(2024, 1, 20)


@register("period_bounds")
def q_period_bounds(spark, sf_dir):
    return SM.period_bounds(A.business_dates(A.driver(spark, sf_dir)), A.AS_OF)


@register("latest_per_key")
def q_latest_per_key(spark, sf_dir):
    return H.latest_per_key(A.exception_history(A.driver(spark, sf_dir)), "excp_id", "eff_dttm", ties=True)


@register("snapshot_compare")
def q_snapshot_compare(spark, sf_dir):
    loans = A.loan_history(A.driver(spark, sf_dir))
    return H.compare_states(loans, "loan_nbr", "eff_dttm", SM_EOM, SM_BOM, ["mca_percent", "loan_status"], tie_break="seq")


@register("snapshot_parameters")
def q_snapshot_parameters(spark, sf_dir):
    """Both ends of the period in SQL, the script's variables bound as parameters."""
    return FSQL.run_sql(spark, """
        SELECT loan_nbr, eom.mca_percent AS eom_mca, bom.mca_percent AS bom_mca, eom.mca_percent - bom.mca_percent AS change
        FROM (SELECT loan_nbr,
                     max_by(struct(mca_percent), struct(eff_dttm, seq)) FILTER (WHERE CAST(eff_dttm AS DATE) <= :eom) AS eom,
                     max_by(struct(mca_percent), struct(eff_dttm, seq)) FILTER (WHERE CAST(eff_dttm AS DATE) <= :bom) AS bom
              FROM {loans} WHERE CAST(eff_dttm AS DATE) <= greatest(:bom, :eom) GROUP BY loan_nbr)
        WHERE eom IS NOT NULL""", {"bom": SM_BOM, "eom": SM_EOM}, loans=A.loan_history(A.driver(spark, sf_dir)))


@register("slow_movers")
def q_slow_movers(spark, sf_dir):
    """The exception history is stored with match keys, so that its text filters reach the scan."""
    d = A.driver(spark, sf_dir)
    history = A.stored(d, A.exception_history, "doc_desc", "issu_desc")
    return SM.run({"exception_history": history, "loan_history": A.loan_history(d)}, SM_BOM, SM_EOM)


@register("slow_movers_month")
def q_slow_movers_month(spark, sf_dir):
    """The report for the month before 2024-02-15, bounds derived from the processing dates."""
    d = A.driver(spark, sf_dir)
    return SM.run_for_month({"exception_history": A.exception_history(d), "loan_history": A.loan_history(d),
                             "business_dates": A.event_dates(d)}, dt.date(2024, 2, 15))


def _round(df: DataFrame, digits: dict[str, int]) -> DataFrame:
    """Presentation rounding of floating aggregates (summation order differs between engines)."""
    return df.select(*[F.round(c, digits[c]).alias(c) if c in digits else F.col(c) for c in df.columns])


# ---- W5 employees -------------------------------------------------------------------------------


def _hr(spark, sf_dir) -> dict[str, DataFrame]:
    d = A.driver(spark, sf_dir)
    return {"employees": A.employees(d), "departments": A.departments(d), "dept_emp": A.dept_emp(d),
            "salaries": A.salaries(d), "titles": A.titles(d), "dept_manager": A.dept_manager(d)}


HIRE_YEAR, FIRST_NAME, LAST_PREFIX = 1996, "red", "b"


@register("emp_salary")
def q_emp_salary(spark, sf_dir):
    return EMP.salary_report(_hr(spark, sf_dir))


@register("money_exponent")
def q_money_exponent(spark, sf_dir):
    """Amounts from 1e6 on are written with an exponent."""
    o = A.driver(spark, sf_dir)["orders"]
    return o.select("o_orderkey", money_text(F.col("o_totalprice") * 100).alias("price_text"))


@register("hired_in_year")
def q_hired_in_year(spark, sf_dir):
    return EMP.hired_in_year(_hr(spark, sf_dir), HIRE_YEAR)


@register("managers")
def q_managers(spark, sf_dir):
    return EMP.managers(_hr(spark, sf_dir))


@register("emp_department")
def q_emp_department(spark, sf_dir):
    return EMP.employee_departments(_hr(spark, sf_dir))


@register("name_prefix")
def q_name_prefix(spark, sf_dir):
    return EMP.name_prefix(_hr(spark, sf_dir), FIRST_NAME, LAST_PREFIX)


@register("one_department")
def q_one_department(spark, sf_dir):
    return EMP.employee_departments(_hr(spark, sf_dir), ["d007"])


@register("two_departments")
def q_two_departments(spark, sf_dir):
    return EMP.employee_departments(_hr(spark, sf_dir), ["d007", "d005"])


@register("name_frequency")
def q_name_frequency(spark, sf_dir):
    return EMP.name_frequency(_hr(spark, sf_dir))


@register("salary_histogram")
def q_salary_histogram(spark, sf_dir):
    return EMP.salary_histogram(_hr(spark, sf_dir), 10)


@register("avg_by_title")
def q_avg_by_title(spark, sf_dir):
    return _round(EMP.avg_salary_by_title(_hr(spark, sf_dir)), {"avg_salary": 4})


# ---- W6 climate ---------------------------------------------------------------------------------

C_START, C_END = dt.date(2024, 1, 5), dt.date(2024, 1, 25)
C_SINCE = dt.date(2024, 1, 10)
TRIP_START, TRIP_END = dt.date(2001, 2, 1), dt.date(2001, 2, 14)          # price series trip
RAIN_START, RAIN_END = dt.date(2025, 1, 10), dt.date(2025, 1, 16)          # measured one year earlier


def _m(spark, sf_dir):
    return A.measurement(A.driver(spark, sf_dir))


@register("daily_mean")
def q_daily_mean(spark, sf_dir):
    return _round(CL.daily_mean(_m(spark, sf_dir), C_START, C_END), {"precipitation": 4})


@register("precipitation_rows")
def q_precipitation_rows(spark, sf_dir):
    return CL.precipitation_rows(_m(spark, sf_dir), C_START, C_END)


@register("station_count")
def q_station_count(spark, sf_dir):
    return CL.station_count(A.station(A.driver(spark, sf_dir)))


@register("station_activity")
def q_station_activity(spark, sf_dir):
    return CL.station_activity(_m(spark, sf_dir))


@register("top_station_hist")
def q_top_station_hist(spark, sf_dir):
    return CL.top_station_hist(_m(spark, sf_dir), C_SINCE, 12)


@register("station_list")
def q_station_list(spark, sf_dir):
    return CL.station_list(A.station(A.driver(spark, sf_dir)))


@register("top_station_name")
def q_top_station_name(spark, sf_dir):
    d = A.driver(spark, sf_dir)
    return CL.top_station_name(A.measurement(d), A.station(d))


@register("date_values")
def q_date_values(spark, sf_dir):
    return CL.date_values(_m(spark, sf_dir))


@register("last_year_values")
def q_last_year_values(spark, sf_dir):
    return CL.last_year_values(A.price_series(A.driver(spark, sf_dir)))


@register("range_stats_open")
def q_range_stats_open(spark, sf_dir):
    return _round(CL.temperature_stats(_m(spark, sf_dir), dt.date(2024, 1, 20)), {"tavg": 4})


@register("range_stats_closed")
def q_range_stats_closed(spark, sf_dir):
    return _round(CL.temperature_stats(_m(spark, sf_dir), dt.date(2024, 1, 10), dt.date(2024, 1, 15)), {"tavg": 4})


@register("summary_stats")
def q_summary_stats(spark, sf_dir):
    return _round(CL.precipitation_summary(_m(spark, sf_dir), C_START, C_END),
                  {"mean": 6, "std": 6, "p25": 6, "p50": 6, "p75": 6})


@register("same_dates_last_year")
def q_same_dates_last_year(spark, sf_dir):
    return _round(CL.trip_last_year(A.price_series(A.driver(spark, sf_dir)), TRIP_START, TRIP_END), {"tavg": 4})


@register("daily_normals")
def q_daily_normals(spark, sf_dir):
    return _round(CL.daily_normals(A.price_series(A.driver(spark, sf_dir)), TRIP_START, TRIP_END), {"tavg": 4})


@register("rain_per_station")
def q_rain_per_station(spark, sf_dir):
    d = A.driver(spark, sf_dir)
    return _round(CL.rain_per_station(A.measurement(d), A.station(d), RAIN_START, RAIN_END), {"total_prcp": 4})


@register("two_month_t")
def q_two_month_t(spark, sf_dir):
    return _round(CL.june_december(A.price_series(A.driver(spark, sf_dir))),
                  {"mean1": 4, "mean2": 4, "var1": 0, "var2": 0, "t": 6, "dof": 4})


@register("nth_row")
def q_nth_row(spark, sf_dir):
    return _round(CL.nth_daily_mean(_m(spark, sf_dir), C_START, C_END, 10), {"precipitation": 4})


@register("middle_row")
def q_middle_row(spark, sf_dir):
    """The order at the middle position of all orders by price."""
    o = A.driver(spark, sf_dir)["orders"].select("o_orderkey", "o_totalprice")
    return nth_row(o, [F.desc("o_totalprice"), F.col("o_orderkey")], o.count() // 2)


# ---- sources, sinks and data quality ---------------------------------------------------------------------


@register("json_rows")
def q_json_rows(spark, sf_dir):
    """The JSON rows parsed back with their types: the text itself differs between engines (float text)."""
    st = A.station(A.driver(spark, sf_dir))
    rows = to_json_rows(st)
    return rows.select(F.from_json(rows.columns[0], st.schema).alias("r")).select("r.*")


CSV_SCHEMA = "c_custkey long, c_name string, c_nationkey int, c_acctbal double"


def _csv_of_customers(spark, sf_dir) -> tuple[DataFrame, DataFrame]:
    """The customers as a CSV with quoted commas and quotes; some lines hold a text for a number, lack a field or have
    two too many."""
    c = A.driver(spark, sf_dir)["customer"]
    k = F.col("c_custkey")
    line = F.concat_ws(",", k.cast("string"), F.concat(F.lit('"'), "c_name", F.lit(', ""of"" '), "c_mktsegment", F.lit('"')),
                       F.col("c_nationkey").cast("string"),
                       F.when(k % 43 == 0, F.lit(None).cast("string")).when(k % 41 == 0, F.lit("n/a")).otherwise(F.col("c_acctbal").cast("string")),
                       F.when(k % 47 == 0, F.lit("more,more")))
    path = table_path(spark, "csv")
    c.select(line.alias("value")).write.text(path)
    return load_csv(spark, path, CSV_SCHEMA, header=False)


@register("csv_rows")
def q_csv_rows(spark, sf_dir):
    return _csv_of_customers(spark, sf_dir)[0]


@register("csv_rejects")
def q_csv_rejects(spark, sf_dir):
    return _csv_of_customers(spark, sf_dir)[1]


@register("checked_write")
def q_checked_write(spark, sf_dir):
    """Constraint counts of the exception table, observed while it is written."""
    d = A.driver(spark, sf_dir)
    active = A.loan_status(d).where("loan_status = 'Active'")
    with Intermediates():
        counts = Q.write_checked(A.exceptions(d), table_path(spark, "checked"),
                                 ["exception_id", "loan_number", "proof_of_repairs_status", "coborrower_name", "non_gc_letter_sent_3"],
                                 {"active_loan": ("loan_number", active, "loan_number")})
    return spark.createDataFrame([tuple(counts.values())], ", ".join(f"{c} long" for c in counts))


@register("unlabelled_documents")
def q_unlabelled_documents(spark, sf_dir):
    """Documents without a label: orphans of a reference that is not complete."""
    d = A.driver(spark, sf_dir)
    return Q.fk_orphans(d["documents"].select("doc_id", "source"), "doc_id", d["labels"])


@register("null_check")
def q_null_check(spark, sf_dir):
    return Q.null_counts(A.driver(spark, sf_dir)["lineitem"])


@register("pk_violations")
def q_pk_violations(spark, sf_dir):
    return Q.pk_violations(A.driver(spark, sf_dir)["lineitem"], ["l_orderkey", "l_linenumber"])


@register("fk_orphans")
def q_fk_orphans(spark, sf_dir):
    d = A.driver(spark, sf_dir)
    return Q.fk_orphans(d["lineitem"], "l_orderkey", d["orders"], "o_orderkey")


# ---- SQL surface --------------------------------------------------------------------------------


@register("sql_functions")
def q_sql_functions(spark, sf_dir):
    """The dialect helpers called from Spark SQL over whole orders ⋈ customer."""
    d = A.driver(spark, sf_dir)
    FSQL.register_functions(spark)
    d["orders"].createOrReplaceTempView("ferrule_orders")
    d["customer"].createOrReplaceTempView("ferrule_customer")
    return spark.sql("""
        SELECT o.o_orderkey,
               day_diff(o.o_orderdate, TIMESTAMP_NTZ'2001-09-01 00:00:00') AS age_days,
               month_diff(o.o_orderdate, TIMESTAMP_NTZ'2001-09-01 00:00:00') AS age_months,
               yyyymmdd(CAST(o.o_orderdate AS DATE)) AS order_int,
               us_date(CAST(o.o_orderdate AS DATE)) AS order_text,
               same_day_last_year(CAST(o.o_orderdate AS DATE)) AS year_before,
               money_text(o.o_totalprice) AS price_text,
               strip_zeros(lpad(CAST(o.o_custkey AS STRING), 10, '0')) AS loan_key,
               braced(CAST(o.o_orderkey AS STRING)) AS guid,
               zip4(lpad(CAST(c.c_custkey AS STRING), 9, '0')) AS zip,
               ci_key(c.c_mktsegment) AS segment_key,
               address_class(CASE WHEN c.c_nationkey = 3 THEN 'PR' ELSE 'N' END,
                             CASE WHEN c.c_custkey % 2 = 0 THEN 'P.O. Box 1' ELSE '1 Main St' END) AS po_box_flag
        FROM ferrule_orders o JOIN ferrule_customer c ON o.o_custkey = c.c_custkey""")


@register("snapshot_sql")
def q_snapshot_sql(spark, sf_dir):
    """Loan state as of a date through the SQL table function (one row per loan)."""
    d = A.driver(spark, sf_dir)
    A.loan_history(d).createOrReplaceTempView("ferrule_loan_history")
    FSQL.register_snapshot(spark, "loan_snapshot", "ferrule_loan_history", "loan_nbr", "eff_dttm",
                           ties=False, tie_break="seq")
    return spark.sql("SELECT loan_nbr, mca_percent, loan_status, eff_dttm FROM loan_snapshot(DATE'2024-01-20')")

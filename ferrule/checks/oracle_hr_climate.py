"""DuckDB oracle for the employee and climate analyses, statistics and data-quality checks."""

from __future__ import annotations

from ferrule.checks.oracle_views import with_views


def hist_sql(source: str, col: str, bins: int) -> str:
    """numpy-rule equal-width histogram over ``SELECT ... FROM`` source (one row per bin)."""
    b = float(bins)

    def edge(k):
        return f"(CASE WHEN {k} = {bins} THEN hi ELSE {k} * ((hi - lo) / {b}) + lo END)"

    return f"""SELECT * FROM (WITH vals AS (SELECT CAST({col} AS DOUBLE) AS x FROM ({source}) s WHERE {col} IS NOT NULL),
rng AS (SELECT CASE WHEN min(x) = max(x) THEN min(x) - 0.5 ELSE min(x) END AS lo,
               CASE WHEN min(x) = max(x) THEN max(x) + 0.5 ELSE max(x) END AS hi FROM vals),
i0 AS (SELECT x, lo, hi, CAST(floor((x - lo) / (hi - lo) * {b}) AS INTEGER) AS i FROM vals, rng),
i1 AS (SELECT x, lo, hi, CASE WHEN i >= {bins} THEN {bins - 1} ELSE i END AS i FROM i0),
i2 AS (SELECT x, lo, hi, CASE WHEN x < {edge('i')} THEN i - 1 ELSE i END AS i FROM i1),
i3 AS (SELECT CASE WHEN x >= {edge('(i + 1)')} AND i <> {bins - 1} THEN i + 1 ELSE i END AS i FROM i2),
cnt AS (SELECT i, count(*) AS c FROM i3 GROUP BY i),
allb AS (SELECT CAST(g.i AS INTEGER) AS i, lo, hi FROM rng, range(0, {bins}) g(i) WHERE lo IS NOT NULL)
SELECT CAST(allb.i + 1 AS INTEGER) AS bin, {edge('allb.i')} AS lower, {edge('(allb.i + 1)')} AS upper,
       CAST(coalesce(cnt.c, 0) AS BIGINT) AS count
FROM allb LEFT JOIN cnt ON allb.i = cnt.i)"""


_F = "CAST(s.salary AS FLOAT)"
# PostgreSQL prints a REAL as the shortest text that reads back as the same REAL
_SHORTEST = "CASE " + " ".join(
    f"WHEN CAST(printf('%.{p}g', CAST({_F} AS DOUBLE)) AS FLOAT) = {_F} THEN printf('%.{p}g', CAST({_F} AS DOUBLE))"
    for p in range(1, 10)) + " END"
_MONEY = (f"'$' || CASE WHEN {_F} = floor({_F}) THEN CAST(CAST({_F} AS BIGINT) AS VARCHAR) ELSE {_SHORTEST} END")

# PostgreSQL's text of a REAL from 1e6 on: the fewest digits nearer to it than half the gap to the next REAL
_LARGE = "CASE " + " ".join(
    f"WHEN abs(CAST(printf('%.{p}e', CAST({{x}} AS DOUBLE)) AS DOUBLE) - {{x}}) < pow(2, floor(log2({{x}})) - 24) THEN printf('%.{p}e', CAST({{x}} AS DOUBLE))"
    for p in range(9)) + " END"


def _works_in(only: str = "true") -> str:
    """Employees by department: the assignments of the wanted departments, then names."""
    return f"""SELECT emp_no, last_name, first_name, dept_name
FROM (SELECT emp_no, dept_name FROM v_dept_emp JOIN v_departments USING (dept_no) WHERE {only}) AS w JOIN v_employees USING (emp_no)"""


TOP = "(SELECT station FROM v_measurement GROUP BY station ORDER BY count(id) DESC, station LIMIT 1)"
DAILY = ("SELECT date, round(avg(prcp), 4) AS precipitation FROM v_measurement "
         "WHERE date BETWEEN DATE '2024-01-05' AND DATE '2024-01-25' GROUP BY date")

_MONEY_O = _MONEY.replace("s.salary", "o.o_totalprice")
_POB = " OR ".join(f"upper(addr) LIKE '{p.upper()}%'" for p in ("PO Box", "P.O. Box", "P O Box", "P. O. BOX"))

ORACLE = {
    "sql_functions": f"""SELECT o.o_orderkey,
 CAST(date_diff('day', CAST(o.o_orderdate AS DATE), DATE '2001-09-01') AS INTEGER) AS age_days,
 CAST((2001 * 12 + 9) - (year(o.o_orderdate) * 12 + month(o.o_orderdate)) AS INTEGER) AS age_months,
 CAST(strftime(o.o_orderdate, '%Y%m%d') AS INTEGER) AS order_int,
 strftime(o.o_orderdate, '%m/%d/%Y') AS order_text,
 CAST(CAST(o.o_orderdate AS DATE) - INTERVAL 12 MONTH AS DATE) AS year_before,
 {_MONEY_O} AS price_text,
 replace(ltrim(replace(lpad(CAST(o.o_custkey AS VARCHAR), 10, '0'), '0', ' ')), ' ', '0') AS loan_key,
 '{{' || CAST(o.o_orderkey AS VARCHAR) || '}}' AS guid,
 CASE WHEN length(rtrim(lpad(CAST(c.c_custkey AS VARCHAR), 9, '0'))) > 5
      THEN substring(lpad(CAST(c.c_custkey AS VARCHAR), 9, '0'), 1, 5) || '-' || substring(lpad(CAST(c.c_custkey AS VARCHAR), 9, '0'), 6, 4)
      ELSE lpad(CAST(c.c_custkey AS VARCHAR), 9, '0') END AS zip,
 upper(rtrim(c.c_mktsegment)) AS segment_key,
 CASE WHEN c.c_nationkey = 3 THEN 'PR Address'
      WHEN c.c_custkey % 2 = 0 THEN 'PO BOX' ELSE 'Standard Address' END AS po_box_flag
FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey""",
    "snapshot_sql": with_views("""SELECT loan_nbr, mca_percent, loan_status, eff_dttm FROM (
 SELECT *, row_number() OVER (PARTITION BY loan_nbr ORDER BY eff_dttm DESC, seq DESC) AS rn
 FROM v_loan_history WHERE CAST(eff_dttm AS DATE) <= DATE '2024-01-20') WHERE rn = 1"""),
    "emp_salary": with_views(f"SELECT emp_no, last_name, first_name, gender, {_MONEY} AS salary FROM v_salaries s JOIN v_employees USING (emp_no)"),
    "money_exponent": f"""SELECT o_orderkey, concat('$', CASE WHEN v < 1000000 THEN CAST(CAST(v AS BIGINT) AS VARCHAR) ELSE {_LARGE.format(x='v')} END)
  AS price_text FROM (SELECT o_orderkey, CAST(o_totalprice * 100 AS FLOAT) AS v FROM orders) AS cents""",
    "hired_in_year": with_views("""SELECT emp_no, last_name, first_name, hire_date FROM v_employees
WHERE hire_date BETWEEN DATE '1996-01-01' AND DATE '1996-12-31'"""),
    "managers": with_views("""SELECT dept_no, dept_name, emp_no, last_name, first_name, hire_date AS start_date,
 coalesce(CAST(nullif(to_date, DATE '9999-01-01') AS VARCHAR), 'Still Employeed') AS end_date
FROM v_dept_manager JOIN v_employees USING (emp_no) JOIN v_departments USING (dept_no)"""),
    "emp_department": with_views(_works_in()),
    "name_prefix": with_views("SELECT * FROM v_employees WHERE starts_with(last_name, 'b') AND first_name = 'red'"),
    "one_department": with_views(_works_in("dept_no = 'd007'")),
    "two_departments": with_views(_works_in("list_contains(['d007', 'd005'], dept_no)")),
    "name_frequency": with_views("SELECT last_name, count(last_name) AS count_of_last_name FROM v_employees GROUP BY last_name"),
    "salary_histogram": with_views(hist_sql("SELECT salary FROM v_salaries", "salary", 10)),
    "avg_by_title": with_views("""SELECT t.title, round(avg(s.salary), 4) AS avg_salary
FROM v_salaries s JOIN v_titles t ON s.emp_no = t.emp_no GROUP BY t.title"""),
    "daily_mean": with_views(DAILY),
    "precipitation_rows": with_views("""SELECT date, prcp AS precipitation FROM v_measurement
WHERE date BETWEEN DATE '2024-01-05' AND DATE '2024-01-25'"""),
    "json_rows": with_views("SELECT * FROM v_station"),
    "station_count": with_views("SELECT count(*) AS station_count FROM v_station"),
    "station_activity": with_views("SELECT station, count(id) AS n FROM v_measurement GROUP BY station"),
    "top_station_hist": with_views(hist_sql(
        f"SELECT tobs FROM v_measurement WHERE station = {TOP} AND date >= DATE '2024-01-10'", "tobs", 12)),
    "station_list": with_views("SELECT station, name, latitude, longitude, elevation FROM v_station"),
    "top_station_name": with_views(f"SELECT s.station, s.name FROM v_station s WHERE s.station = {TOP}"),
    "date_values": with_views("SELECT date, prcp AS precipitation FROM v_measurement"),
    "last_year_values": with_views("""SELECT date, tobs FROM v_price_series
WHERE date >= (SELECT CAST(max(date) - INTERVAL 12 MONTH AS DATE) FROM v_price_series)"""),
    "range_stats_open": with_views("""SELECT min(tobs) AS tmin, round(avg(tobs), 4) AS tavg, max(tobs) AS tmax
FROM v_measurement WHERE date >= DATE '2024-01-20'"""),
    "range_stats_closed": with_views("""SELECT min(tobs) AS tmin, round(avg(tobs), 4) AS tavg, max(tobs) AS tmax
FROM v_measurement WHERE date >= DATE '2024-01-10' AND date <= DATE '2024-01-15'"""),
    "summary_stats": with_views("""SELECT count(prcp) AS count, round(avg(prcp), 6) AS mean, round(stddev_samp(prcp), 6) AS std,
 min(prcp) AS min, round(quantile_cont(prcp, 0.25), 6) AS p25, round(quantile_cont(prcp, 0.5), 6) AS p50,
 round(quantile_cont(prcp, 0.75), 6) AS p75, max(prcp) AS max
FROM v_measurement WHERE date BETWEEN DATE '2024-01-05' AND DATE '2024-01-25'"""),
    "same_dates_last_year": with_views("""SELECT min(tobs) AS tmin, round(avg(tobs), 4) AS tavg, max(tobs) AS tmax
FROM v_price_series WHERE date >= DATE '2000-02-01' AND date <= DATE '2000-02-14'"""),
    "daily_normals": with_views("""SELECT strftime(date, '%m-%d') AS day, min(tobs) AS tmin, round(avg(tobs), 4) AS tavg,
 max(tobs) AS tmax FROM v_price_series
WHERE strftime(date, '%m-%d') IN (SELECT strftime(d, '%m-%d') FROM range(DATE '2001-02-01', DATE '2001-02-15', INTERVAL 1 DAY) g(d))
GROUP BY 1"""),
    "rain_per_station": with_views("""SELECT s.station, s.name, s.latitude, s.longitude, s.elevation, round(r.total_prcp, 4) AS total_prcp
FROM (SELECT station, sum(prcp) AS total_prcp FROM v_measurement
      WHERE date BETWEEN DATE '2024-01-10' AND DATE '2024-01-16' GROUP BY station) r
JOIN v_station s ON r.station = s.station"""),
    "two_month_t": with_views("""SELECT n1, round(mean1, 4) AS mean1, round(var1, 0) AS var1, n2, round(mean2, 4) AS mean2,
 round(var2, 0) AS var2, round((mean1 - mean2) / sqrt(var1 / n1 + var2 / n2), 6) AS t,
 round(pow(var1 / n1 + var2 / n2, 2) / (pow(var1 / n1, 2) / (n1 - 1) + pow(var2 / n2, 2) / (n2 - 1)), 4) AS dof
FROM (SELECT count(CASE WHEN month(date) = 6 THEN tobs END) AS n1, avg(CASE WHEN month(date) = 6 THEN tobs END) AS mean1,
             var_samp(CASE WHEN month(date) = 6 THEN tobs END) AS var1,
             count(CASE WHEN month(date) = 12 THEN tobs END) AS n2, avg(CASE WHEN month(date) = 12 THEN tobs END) AS mean2,
             var_samp(CASE WHEN month(date) = 12 THEN tobs END) AS var2 FROM v_price_series)"""),
    "nth_row": with_views(f"SELECT * FROM ({DAILY}) ORDER BY date LIMIT 1 OFFSET 10"),
    "middle_row": "SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 1 OFFSET (SELECT count(*) // 2 FROM orders)",
    "csv_rows": "SELECT c_custkey, c_name || ', \"of\" ' || c_mktsegment AS c_name, c_nationkey, c_acctbal FROM customer "
                "WHERE c_custkey % 41 <> 0 AND c_custkey % 43 <> 0 AND c_custkey % 47 <> 0",
    "csv_rejects": """SELECT concat_ws(',', c_custkey, '"' || c_name || ', ""of"" ' || c_mktsegment || '"', c_nationkey,
 CASE WHEN c_custkey % 43 = 0 THEN NULL WHEN c_custkey % 41 = 0 THEN 'n/a' ELSE CAST(c_acctbal AS VARCHAR) END,
 CASE WHEN c_custkey % 47 = 0 THEN 'more,more' END) AS line
FROM customer WHERE c_custkey % 41 = 0 OR c_custkey % 43 = 0 OR c_custkey % 47 = 0""",
    "checked_write": with_views("SELECT count(*) AS n_rows, " + ", ".join(f"count(*) FILTER ({c} IS NULL) AS null_{c}" for c in
                                ["exception_id", "loan_number", "proof_of_repairs_status", "coborrower_name", "non_gc_letter_sent_3"])
                                + """, count(*) FILTER (NOT EXISTS (SELECT 1 FROM customer WHERE c_acctbal >= 0 AND CAST(c_custkey AS VARCHAR) = loan_number))
 AS orphans_active_loan FROM v_exceptions"""),
    "unlabelled_documents": "SELECT doc_id, source FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels)",
    "null_check": """SELECT """ + ", ".join(
        f"count(*) FILTER (WHERE {c} IS NULL) AS {c}" for c in
        ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_extendedprice", "l_discount",
         "l_tax", "l_returnflag", "l_linestatus", "l_shipdate"]) + " FROM lineitem",
    "pk_violations": """SELECT l_orderkey, l_linenumber, count(*) AS n FROM lineitem GROUP BY l_orderkey, l_linenumber
HAVING count(*) > 1""",
    "fk_orphans": """SELECT l.* FROM lineitem l WHERE l.l_orderkey IS NOT NULL
AND NOT EXISTS (SELECT 1 FROM orders o WHERE o.o_orderkey = l.l_orderkey)""",
}

"""The dialect helpers as Spark SQL functions, for users who keep writing SQL.

``register_functions(spark)`` creates temporary SQL functions whose bodies are SQL expressions: the
optimizer inlines them like any built-in, so a query written the way the source reports were
written (``SELECT day_diff(max_date, :today) ...``) runs entirely on the JVM.  Each body mirrors the
Column helper of the same name in ``ferrule.functions.semantics`` (tests check they agree).

``register_snapshot(spark, name, view, key, eff_col)`` creates a SQL *table function*
``name(as_of DATE)``: the state of every key as of a date, like the parameterised snapshot views
the reports call.  It plans as a filter on the stored column plus ``rank() = 1`` (partial
WindowGroupLimit before the shuffle).
"""

from __future__ import annotations

from pyspark.sql import SparkSession

# Fixed values shared with the Column helpers: sentinel date and label, PO-box prefixes.
_PO_BOX = " OR ".join(f"upper(addr) LIKE '{p.upper()}%'" for p in ("PO Box", "P.O. Box", "P O Box", "P. O. BOX"))

# shortest text of a REAL: fixed point below 1e6, from there on mantissa and exponent
_REAL, _SIZE = "CAST(x AS FLOAT)", "CAST(abs(CAST(x AS FLOAT)) AS DOUBLE)"
_LARGE = " ".join(f"WHEN abs(CAST(format_string('%.{d}e', {_SIZE}) AS DOUBLE) - {_SIZE}) < pow(2D, floor(log2({_SIZE})) - 24) "
                  f"THEN format_string('%.{d}e', {_SIZE})" for d in range(9))
_MONEY = f"""concat('$', CASE WHEN isnan({_REAL}) OR {_SIZE} = double('Infinity') THEN CAST({_REAL} AS STRING)
 WHEN {_SIZE} >= 1e6D THEN concat(CASE WHEN {_REAL} < 0 THEN '-' ELSE '' END, CASE {_LARGE} END)
 WHEN {_REAL} = floor({_REAL}) THEN CAST(CAST({_REAL} AS BIGINT) AS STRING) ELSE CAST({_REAL} AS STRING) END)"""

FUNCTIONS: dict[str, str] = {
    "ci_key": "(x STRING) RETURNS STRING RETURN upper(rtrim(x))",
    "day_diff": "(a TIMESTAMP_NTZ, b TIMESTAMP_NTZ) RETURNS INT RETURN datediff(CAST(b AS DATE), CAST(a AS DATE))",
    "month_diff": "(a TIMESTAMP_NTZ, b TIMESTAMP_NTZ) RETURNS INT "
                  "RETURN (year(b) * 12 + month(b)) - (year(a) * 12 + month(a))",
    "yyyymmdd": "(d DATE) RETURNS INT RETURN CAST(date_format(d, 'yyyyMMdd') AS INT)",
    "us_date": "(d DATE) RETURNS STRING RETURN date_format(d, 'MM/dd/yyyy')",
    "same_day_last_year": "(d DATE) RETURNS DATE RETURN add_months(d, -12)",
    "zip4": "(z STRING) RETURNS STRING RETURN CASE WHEN length(rtrim(z)) > 5 "
            "THEN concat(substring(z, 1, 5), '-', substring(z, 6, 4)) ELSE z END",
    "strip_zeros": "(x STRING) RETURNS STRING RETURN replace(ltrim(replace(x, '0', ' ')), ' ', '0')",
    "braced": "(x STRING) RETURNS STRING RETURN concat('{', x, '}')",
    "money_text": "(x DOUBLE) RETURNS STRING RETURN " + _MONEY,
    "sentinel_date_text": "(d DATE) RETURNS STRING RETURN CASE WHEN d = DATE'9999-01-01' THEN 'Still Employeed' "
                          "ELSE CAST(d AS STRING) END",
    "address_class": f"(state STRING, addr STRING) RETURNS STRING RETURN CASE WHEN upper(state) LIKE '%PR%' "
                     f"THEN 'PR Address' WHEN {_PO_BOX} THEN 'PO BOX' ELSE 'Standard Address' END",
}


def register_functions(spark: SparkSession) -> list[str]:
    """Create (or replace) the temporary SQL functions; returns their names."""
    for name, body in FUNCTIONS.items():
        spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {name}{body}")
    return list(FUNCTIONS)


def run_sql(spark: SparkSession, text: str, params: dict | None = None, **tables):
    """Run a report's SQL with its script variables as parameters and its tables as DataFrames.

    ``:name`` in the text is a parameter marker: the value is bound as a typed literal, never pasted into the
    text, so a date stays a DATE and reaches the scan like any other literal.  ``{name}`` stands for a table given
    by keyword, so that a query does not depend on temporary views of the session.
    """
    return spark.sql(text, args=params or {}, **tables)


def register_snapshot(spark: SparkSession, name: str, view: str, key: str, eff_col: str,
                      ties: bool = True, tie_break: str | None = None) -> None:
    """SQL table function ``name(as_of DATE)`` = latest row per ``key`` with ``eff_col`` on or before
    ``as_of`` (whole day included).  ``ties=False`` keeps one row per key (greatest ``tie_break``)."""
    schema = spark.table(view).schema
    cols = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)
    names = ", ".join(f"`{f.name}`" for f in schema.fields)
    order = f"`{eff_col}` DESC" + (f", `{tie_break}` DESC" if tie_break else "")
    fn = "rank()" if ties else "row_number()"
    spark.sql(f"""CREATE OR REPLACE TEMPORARY FUNCTION {name}(as_of DATE) RETURNS TABLE({cols})
RETURN SELECT {names} FROM (SELECT *, {fn} OVER (PARTITION BY `{key}` ORDER BY {order}) AS _snapshot_rank
                            FROM {view} WHERE CAST(`{eff_col}` AS DATE) <= as_of)
WHERE _snapshot_rank = 1""")

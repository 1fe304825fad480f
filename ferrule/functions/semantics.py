"""Scalar semantics of the source dialects, written as built-in Spark Column expressions.

The source jobs ran on SQL Server (case-insensitive collation, boundary-counting DATEDIFF,
4-byte REAL casts), PostgreSQL and SQLite.  Each helper here reproduces one of those behaviours
exactly with JVM-side functions, so no Python runs per row.
"""

from __future__ import annotations

import datetime as _dt
from collections.abc import Iterable, Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F

__all__ = [
    "KEY_SUFFIX", "col_", "ci_key", "ci_eq", "ci_in", "ci_not_in", "in_or_null", "ci_like",
    "day_diff", "month_diff", "yyyymmdd", "us_date", "same_day_last_year", "as_date",
    "real", "money_text", "zip4", "strip_zeros", "braced", "sentinel_date_text",
    "address_class", "recode", "date_lit", "ts_lit",
]

# Fixed values of the source reports.
SENTINEL_OPEN_DATE = _dt.date(9999, 1, 1)        # "still open / still employed"
SENTINEL_NEVER_DATE = _dt.date(1900, 1, 1)       # "never happened"
PO_BOX_PREFIXES = ("PO Box", "P.O. Box", "P O Box", "P. O. BOX")


def col_(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def date_lit(d) -> Column:
    """A DATE literal from a date, datetime or ISO string."""
    if isinstance(d, Column):
        return d.cast("date")
    if d is None:
        return F.lit(None).cast("date")
    if isinstance(d, _dt.datetime):
        d = d.date()
    if isinstance(d, str):
        d = _dt.date.fromisoformat(d)
    return F.lit(d)


def ts_lit(t) -> Column:
    """A TIMESTAMP_NTZ literal (the loan tables carry wall-clock datetimes without zone)."""
    if isinstance(t, Column):
        return t
    if isinstance(t, str):
        t = _dt.datetime.fromisoformat(t)
    elif isinstance(t, _dt.date) and not isinstance(t, _dt.datetime):
        t = _dt.datetime(t.year, t.month, t.day)
    # from text, so the Python process time zone never shifts the wall-clock value
    return F.lit(t.isoformat(sep=" ")).cast("timestamp_ntz")


def as_date(c) -> Column:
    return col_(c).cast("date")


# ---- case-insensitive comparison (server collation) -------------------------------------------
# The reports compare 'Current Occ Cert' with 'Current OCC Cert' and 'TRUST' with 'Trust' and expect
# a match; trailing blanks are also ignored by that collation.  We compare on upper(rtrim(x)).

#: A table may hold the match key of its text column ``x`` as ``x__key`` (``ferrule.sources.matchable``).
KEY_SUFFIX = "__key"


def ci_key(c, df=None) -> Column:
    """Match key of a text column: ``upper(rtrim(x))``, or the stored key if ``df`` has one for the column."""
    if df is not None and isinstance(c, str) and c + KEY_SUFFIX in df.columns:
        return df[c + KEY_SUFFIX]
    return F.upper(F.rtrim(col_(c)))


def _norm(v: str) -> str:
    return v.rstrip(" ").upper()


def ci_eq(a, b) -> Column:
    if isinstance(b, str):
        return ci_key(a) == F.lit(_norm(b))
    return ci_key(a) == ci_key(b)


def ci_in(c, values: Iterable[str], df=None) -> Column:
    """``IN``; with ``df`` given, on the table's stored match key where it has one (pushed to the scan)."""
    return ci_key(c, df).isin([_norm(v) for v in values])


def ci_not_in(c, values: Iterable[str], df=None) -> Column:
    """``NOT IN``: a NULL input gives NULL, which a filter treats as false."""
    return ~ci_in(c, values, df)


def in_or_null(c, values: Iterable[str], ci: bool = True, df=None) -> Column:
    return (ci_in(c, values, df) if ci else col_(c).isin(list(values))) | col_(c).isNull()


def ci_like(c, pattern: str) -> Column:
    """Case-insensitive LIKE: '%' and '_' are the only wildcards, '.' is literal."""
    return F.upper(col_(c)).like(pattern.upper())


# ---- date arithmetic ---------------------------------------------------------------------------

def day_diff(a, b) -> Column:
    """``DATEDIFF(DAY, a, b)``: day boundaries crossed from a to b (23:00 -> 01:00 is 1)."""
    return F.datediff(col_(b).cast("date"), col_(a).cast("date"))


def month_diff(a, b) -> Column:
    """``DATEDIFF(MONTH, a, b)``: month boundaries crossed (Jan 31 -> Feb 1 is 1)."""
    a, b = col_(a), col_(b)
    return (F.year(b) * 12 + F.month(b)) - (F.year(a) * 12 + F.month(a))


def yyyymmdd(d) -> Column:
    """Date -> yyyymmdd integer, e.g. 2020-02-03 -> 20200203."""
    return F.date_format(col_(d), "yyyyMMdd").cast("int")


def us_date(d) -> Column:
    """``CONVERT(varchar(10), d, 101)`` -> 'MM/dd/yyyy'."""
    return F.date_format(col_(d).cast("date"), "MM/dd/yyyy")


def same_day_last_year(d) -> Column:
    """Same calendar day one year earlier; Feb 29 falls back to Feb 28."""
    return F.add_months(col_(d).cast("date"), -12)


# ---- numeric / text formatting -----------------------------------------------------------------

def real(c) -> Column:
    """``CAST(x AS FLOAT(2))``: a 4-byte REAL, not a 2-decimal rounding (96.49999999 -> 96.5)."""
    return col_(c).cast("float")


def money_text(c) -> Column:
    """``concat('$', CAST(x AS real))`` as PostgreSQL prints it: the shortest text of the REAL, integral values
    without '.0', and from 1e6 on with an exponent (``$1.234567e+06``): the fewest digits that are nearer to the
    value than half its distance to the next REAL."""
    f = col_(c).cast("float")
    x = F.abs(f).cast("double")
    half_gap = F.pow(F.lit(2.0), F.floor(F.log2(x)) - 24)
    texts = [F.format_string(f"%.{digits}e", x) for digits in range(9)]
    large = F.coalesce(*[F.when(F.abs(t.cast("double") - x) < half_gap, t) for t in texts])
    txt = (F.when(F.isnan(f) | (x == float("inf")), f.cast("string"))
           .when(x >= 1e6, F.concat(F.when(f < 0, "-").otherwise(""), large))
           .when(f == F.floor(f), f.cast("bigint").cast("string")).otherwise(f.cast("string")))
    return F.concat(F.lit("$"), txt)


def zip4(c) -> Column:
    """ZIP+4: more than 5 significant characters -> 'ddddd-dddd'; trailing blanks do not count."""
    c = col_(c)
    return F.when(F.length(F.rtrim(c)) > 5,
                  F.concat(F.substring(c, 1, 5), F.lit("-"), F.substring(c, 6, 4))).otherwise(c)


def strip_zeros(c) -> Column:
    """``REPLACE(LTRIM(REPLACE(x,'0',' ')),' ','0')``: drop leading zeros (and leading blanks).

    Differs from ltrim('0', x) when x holds blanks ('000120 3' -> '12003'); all zeros -> ''.
    """
    c = col_(c)
    return F.replace(F.ltrim(F.replace(c, F.lit("0"), F.lit(" "))), F.lit(" "), F.lit("0"))


def braced(c) -> Column:
    """'{' + id + '}' with NULL propagation."""
    return F.concat(F.lit("{"), col_(c), F.lit("}"))


def sentinel_date_text(d, sentinel=SENTINEL_OPEN_DATE, label: str = "Still Employeed") -> Column:
    """Open-ended sentinel date -> label, any other date -> ISO text."""
    d = col_(d).cast("date")
    return F.when(d == date_lit(sentinel), F.lit(label)).otherwise(d.cast("string"))


def address_class(state, address, prefixes: Iterable[str] = PO_BOX_PREFIXES) -> Column:
    """'PR Address' for a state containing PR, then 'PO BOX' for the PO-box prefixes, else standard."""
    addr = F.upper(col_(address))
    po = None
    for p in prefixes:
        cond = addr.startswith(p.upper())
        po = cond if po is None else (po | cond)
    return (F.when(F.upper(col_(state)).contains("PR"), F.lit("PR Address"))
            .when(po, F.lit("PO BOX"))
            .otherwise(F.lit("Standard Address")))


def recode(c, mapping: Mapping[str, str | Iterable[str]] | Iterable[tuple], default=None,
           null_value: str | None = None, ci: bool = True) -> Column:
    """Value -> code through an ordered map (first match wins).

    ``mapping`` is {result: value-or-values} or a list of (values, result) pairs.  ``default`` may be
    a literal, a Column (e.g. the input itself) or None (-> NULL); ``null_value`` labels NULL input.
    """
    c = col_(c)
    pairs = []
    if isinstance(mapping, Mapping):
        for out, vals in mapping.items():
            pairs.append(([vals] if isinstance(vals, str) else list(vals), out))
    else:
        for vals, out in mapping:
            pairs.append(([vals] if isinstance(vals, str) else list(vals), out))
    expr = None
    if null_value is not None:
        expr = F.when(c.isNull(), F.lit(null_value))
    for vals, out in pairs:
        cond = ci_in(c, vals) if ci else c.isin(vals)
        expr = F.when(cond, F.lit(out)) if expr is None else expr.when(cond, F.lit(out))
    if default is None:
        return expr
    return expr.otherwise(default if isinstance(default, Column) else F.lit(default))

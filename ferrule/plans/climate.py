"""Climate analysis: precipitation/temperature aggregates per date and station, the most active
station and its temperature histogram, date-range statistics (open and closed ranges), and the
optional analyses (summary statistics, last year's trip dates, daily normals, rainfall per
station, June/December t statistic).

The most active station is a one-row DataFrame (top-1 by count with a tie-break), used through an
equi-join against that single broadcast row, so no value is collected to the driver between steps.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ferrule.functions.semantics import date_lit, same_day_last_year
from ferrule.operators.stats import (count_by, daily_normals as _normals, histogram, nth_row, range_stats,
                                     summary, top_1, two_month_t, with_t_pvalue)


def daily_mean(m: DataFrame, start, end) -> DataFrame:
    """Mean precipitation per date in the closed range [start, end] (NULLs skipped)."""
    return (m.where(F.col("date").between(date_lit(start), date_lit(end)))
            .groupBy("date").agg(F.avg("prcp").alias("precipitation")))


def precipitation_rows(m: DataFrame, start, end, ordered: bool = True) -> DataFrame:
    """The text version of the one-year query: plain (date, prcp) rows in [start, end], by date."""
    out = m.where(F.col("date").between(date_lit(start), date_lit(end)))
    if ordered:                                        # the last keys make the order unique
        out = out.orderBy("date", "prcp", *[c for c in ("station", "id") if c in out.columns])
    return out.select("date", F.col("prcp").alias("precipitation"))


def station_count(stations: DataFrame) -> DataFrame:
    return stations.agg(F.count(F.lit(1)).alias("station_count"))


def station_activity(m: DataFrame) -> DataFrame:
    """Observations per station, most active first (ties by station)."""
    return count_by(m, "station", "id", "n", descending=True)


def top_station(m: DataFrame) -> DataFrame:
    """One row: the station with most observations (lowest id among ties)."""
    return top_1(m.groupBy("station").agg(F.count("id").alias("n")), [F.col("n").desc(), F.col("station").asc()])


def top_station_temps(m: DataFrame, since) -> DataFrame:
    top = F.broadcast(top_station(m).select("station"))          # exactly one row
    return m.where(F.col("date") >= date_lit(since)).join(top, "station").select("date", "tobs")


def top_station_hist(m: DataFrame, since, bins: int = 12) -> DataFrame:
    return histogram(top_station_temps(m, since), "tobs", bins)


def station_list(stations: DataFrame) -> DataFrame:
    return stations.select("station", "name", "latitude", "longitude", "elevation")


def top_station_name(m: DataFrame, stations: DataFrame) -> DataFrame:
    return F.broadcast(top_station(m).select("station")).join(stations.select("station", "name"), "station")


def date_values(m: DataFrame, value: str = "prcp", name: str = "precipitation") -> DataFrame:
    """Every (date, value) row, NULL values kept."""
    return m.select("date", F.col(value).alias(name))


def last_year_values(m: DataFrame) -> DataFrame:
    """(date, tobs) from the same day one year before the latest date on.

    The latest date is read first (one row), so that the bound is a literal and reaches the scan.
    """
    latest = m.agg(F.max("date").cast("date")).first()[0]
    since = same_day_last_year(F.lit(latest).cast("date"))
    return m.where(F.col("date") >= since).select("date", "tobs")


def temperature_stats(m: DataFrame, start, stop=None) -> DataFrame:
    """TMIN/TAVG/TMAX for dates >= start (and <= stop when given)."""
    return range_stats(m, "date", "tobs", start, stop)


def precipitation_summary(m: DataFrame, start, end) -> DataFrame:
    return summary(m.where(F.col("date").between(date_lit(start), date_lit(end))), "prcp")


def trip_last_year(m: DataFrame, start, end) -> DataFrame:
    """TMIN/TAVG/TMAX over the trip dates shifted one year back (Feb 29 -> Feb 28)."""
    return range_stats(m, "date", "tobs", same_day_last_year(date_lit(start)), same_day_last_year(date_lit(end)))


def daily_normals(m: DataFrame, start, end) -> DataFrame:
    """Min/avg/max per calendar day 'MM-dd' over all years, for the days of the trip."""
    return _normals(m, "date", "tobs", start=start, stop=end)


def rain_per_station(m: DataFrame, stations: DataFrame, start, end) -> DataFrame:
    """Total rainfall per station over last year's trip dates, with the station attributes."""
    lo, hi = same_day_last_year(date_lit(start)), same_day_last_year(date_lit(end))
    rain = m.where(F.col("date").between(lo, hi)).groupBy("station").agg(F.sum("prcp").alias("total_prcp"))
    return (rain.join(stations, "station")
            .select("station", "name", "latitude", "longitude", "elevation", "total_prcp")
            .orderBy(F.col("total_prcp").desc_nulls_last(), F.col("station")))


def june_december(m: DataFrame, m1: int = 6, m2: int = 12, with_p: bool = False) -> DataFrame:
    """Welch t statistic (and optionally its two-sided p-value) of month m1 vs month m2."""
    out = two_month_t(m, "date", "tobs", m1, m2)
    return with_t_pvalue(out) if with_p else out


def nth_daily_mean(m: DataFrame, start, end, n: int) -> DataFrame:
    """Row ``n`` (0-based) of the per-date means ordered by date (``iloc[n]``)."""
    return nth_row(daily_mean(m, start, end), [F.col("date")], n)

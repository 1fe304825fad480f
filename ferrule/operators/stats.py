"""Aggregate statistics: grouped means/counts, top-1, positional rows, range stats, histograms,
exact quantiles, calendar-day normals and a two-sample t statistic.

All of these reduce on the executors; at most a handful of rows (bins, quantiles, one stats row)
ever reach the driver, and only when the caller collects the result.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

import pandas as pd

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ferrule.functions.semantics import col_, date_lit

__all__ = ["mean_by", "count_by", "top_1", "nth_row", "range_stats", "histogram", "exact_quantiles",
           "summary", "daily_normals", "two_month_t", "t_pvalue", "with_t_pvalue", "date_range"]


def mean_by(df: DataFrame, key, c, name: str = "mean") -> DataFrame:
    """AVG per key; NULL values are skipped, an all-NULL key gives NULL."""
    return df.groupBy(key).agg(F.avg(col_(c)).alias(name))


def count_by(df: DataFrame, key, c=None, name: str = "n", descending: bool = True,
             tie_break: bool = True) -> DataFrame:
    """COUNT(c) per key (NULL not counted; ``c=None`` counts rows), sorted by the count.

    The sort is the report order and runs on the already-aggregated (one row per key) result.
    """
    cnt = F.count(F.lit(1)) if c is None else F.count(col_(c))
    out = df.groupBy(key).agg(cnt.alias(name))
    order = [F.col(name).desc() if descending else F.col(name).asc()]
    if tie_break:
        order.append(F.col(key).asc())
    return out.orderBy(*order)


def top_1(df: DataFrame, order: Sequence[Column]) -> DataFrame:
    """The first row in ``order`` (add a tie-break so ties pick deterministically).

    Planned as TakeOrderedAndProject: each task keeps its best row, one row per task is merged.
    """
    return df.orderBy(*order).limit(1)


def nth_row(df: DataFrame, order: Sequence[Column], n: int) -> DataFrame:
    """Row at 0-based position ``n`` of the sorted frame (``iloc[n]``); no row when it is shorter.

    The frame is range-sorted and stored with each row's partition and place; the sizes of the partitions (one row
    each) give the position of each partition's first row, and one filter finds the row.  No task holds more than a
    partition, whatever ``n`` is.  ``order`` should end in a unique column: it makes the position definite and
    lets the ranges split equal values.
    """
    from ferrule.sources.io import materialize

    place = F.monotonically_increasing_id().bitwiseAND((1 << 33) - 1)
    s = materialize(df.orderBy(*order).withColumn("_part", F.spark_partition_id()).withColumn("_place", place))
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    first = (s.groupBy("_part").agg(F.count(F.lit(1)).alias("_size"))
             .select("_part", F.coalesce(F.sum("_size").over(before), F.lit(0)).alias("_first")))
    return (s.join(F.broadcast(first), "_part").where(F.col("_first") + F.col("_place") == F.lit(n))
            .drop("_part", "_place", "_first"))


def range_stats(df: DataFrame, date_col, c, start, stop=None,
                names: tuple[str, str, str] = ("tmin", "tavg", "tmax")) -> DataFrame:
    """MIN/AVG/MAX of ``c`` for dates >= start (and <= stop when given); empty range -> one NULL row."""
    v = col_(c)
    return date_range(df, date_col, start, stop).agg(F.min(v).alias(names[0]), F.avg(v).alias(names[1]),
                                                     F.max(v).alias(names[2]))


def histogram(df: DataFrame, c, bins: int = 12) -> DataFrame:
    """Equal-width histogram with numpy's binning rules, one row per bin (empty bins included).

    Edges are ``lo + k*(hi-lo)/bins`` with the last edge exactly ``hi``; the last bin is closed on
    the right; when all values are equal the range is widened to ``[v-0.5, v+0.5]``.  Output:
    (bin 1..bins, lower, upper, count).  Plan: one aggregate gives the range (a scalar subquery,
    referenced once and attached to the rows through a generator, so it runs once); one grouped
    count with map-side combine gives the bins; the at most ``bins`` result rows get their edges
    from a window over those rows.
    """
    vals = df.select(col_(c).cast("double").alias("x")).where(F.col("x").isNotNull())
    a, b = F.min("x"), F.max("x")
    r = vals.select(F.struct(F.when(a == b, a - 0.5).otherwise(a).alias("lo"),
                             F.when(a == b, b + 0.5).otherwise(b).alias("hi")).alias("r")).scalar()
    nb = F.lit(float(bins))
    lo, hi, x, i = F.col("lo"), F.col("hi"), F.col("x"), F.col("i")

    def edge(k):
        return F.when(k == bins, hi).otherwise(k * ((hi - lo) / nb) + lo)

    # numpy: i = floor((x-lo)/(hi-lo)*bins) clamped to the last bin, then one step down when x lies
    # below the bin's lower edge, else one step up when x reaches the next edge (not for the last
    # bin); the two corrections exclude each other, so the expression stays flat.
    i1 = F.least(F.floor((x - lo) / (hi - lo) * nb).cast("int"), F.lit(bins - 1))
    idx = (vals.select("x", F.inline(F.array(r)))
           .select("x", "lo", "hi", i1.alias("i"))
           .select("lo", "hi", F.when(x < edge(i), i - 1).when((x >= edge(i + 1)) & (i != bins - 1), i + 1)
                   .otherwise(i).alias("i")))
    counts = idx.groupBy("i").agg(F.count(F.lit(1)).alias("count"), F.max("lo").alias("lo"), F.max("hi").alias("hi"))
    # the bin list has `bins` rows (a parameter, not data); the range reaches empty bins through a
    # window over these few rows, and an empty input yields no bins at all
    everything = Window.partitionBy()
    out = (df.sparkSession.range(bins).select(F.col("id").cast("int").alias("i"))
           .join(counts, "i", "left")
           .select("i", "count", F.max("lo").over(everything).alias("lo"), F.max("hi").over(everything).alias("hi"))
           .where(lo.isNotNull()))
    return out.select((i + 1).alias("bin"), edge(i).alias("lower"), edge(i + 1).alias("upper"),
                      F.coalesce(F.col("count"), F.lit(0)).cast("long").alias("count"))


def exact_quantiles(df: DataFrame, c, probs: Sequence[float]) -> DataFrame:
    """Exact quantiles with linear interpolation (pandas/numpy default), fully distributed.

    1. count per distinct value (map-side combine collapses a hot value to one row);
    2. range-sort the distinct values and materialise them (stable partition ids);
    3. running count inside each sorted partition + offsets of the partitions (one row each)
       give every distinct value its rank interval [lo_rank, hi_rank);
    4. only the values whose interval holds one of the 2 ranks each quantile needs are kept
       (a filter), and a one-row aggregate interpolates.
    Output: (p, value), one row per requested probability.
    """
    from ferrule.sources.io import materialize

    vals = df.select(col_(c).cast("double").alias("x")).where(F.col("x").isNotNull())
    dist = vals.groupBy("x").agg(F.count(F.lit(1)).alias("m"))
    s = materialize(dist.orderBy("x").withColumn("pid", F.spark_partition_id()))
    local = Window.partitionBy("pid").orderBy("x").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    per_part = s.groupBy("pid").agg(F.sum("m").alias("pm"))
    # one row per partition: the offsets are computed in one task over a partition-count-sized table
    # ... and the total count n rides along in the same partition-count-sized table
    offsets = per_part.select("pid", F.coalesce(F.sum("pm").over(
        Window.orderBy("pid").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("off"),
        F.sum("pm").over(Window.partitionBy()).alias("n"))
    ranked = (s.withColumn("cum", F.sum("m").over(local))
              .join(F.broadcast(offsets), "pid")
              .select("x", "n", (F.col("off") + F.col("cum") - F.col("m")).alias("lo_rank"),
                      (F.col("off") + F.col("cum")).alias("hi_rank")))
    n = F.col("n")
    h = [(n - 1) * F.lit(float(p)) for p in probs]
    k_lo = [F.floor(x).cast("long") for x in h]
    k_hi = [F.ceil(x).cast("long") for x in h]
    lo_r, hi_r, x = F.col("lo_rank"), F.col("hi_rank"), F.col("x")
    holds = None
    for k in k_lo + k_hi:
        cond = (k >= lo_r) & (k < hi_r)
        holds = cond if holds is None else holds | cond
    hit = ranked.where(holds)

    def at(k):
        return F.max(F.when((k >= lo_r) & (k < hi_r), x))

    # every kept row carries the same n, so max(h) is h
    row = hit.agg(*[F.struct(F.lit(float(p)).alias("p"),
                             (at(k_lo[i]) + (F.max(h[i]) - F.max(k_lo[i])) * (at(k_hi[i]) - at(k_lo[i]))).alias("value"))
                    .alias(f"q{i}") for i, p in enumerate(probs)])
    return row.select(F.explode(F.array(*[F.col(f"q{i}") for i in range(len(probs))])).alias("q")).select("q.p", "q.value")


def summary(df: DataFrame, c, probs: Sequence[float] = (0.25, 0.5, 0.75)) -> DataFrame:
    """pandas ``describe()`` of one column as one row: count, mean, std (sample), min, quartiles, max."""
    v = col_(c).cast("double")
    base = df.agg(F.count(v).alias("count"), F.avg(v).alias("mean"), F.stddev_samp(v).alias("std"),
                  F.min(v).alias("min"), F.max(v).alias("max"))
    q = exact_quantiles(df, c, probs)
    names = [f"p{int(round(p * 100))}" for p in probs]
    # the quartiles travel as one struct scalar subquery over the (one row per p) quantile table
    qs = q.agg(F.struct(*[F.max(F.when(F.col("p") == float(p), F.col("value"))).alias(nm)
                          for p, nm in zip(probs, names)])).scalar()
    return base.select("count", "mean", "std", "min", "max", F.inline(F.array(qs))) \
        .select("count", "mean", "std", "min", *names, "max")


def daily_normals(df: DataFrame, date_col, c, days: DataFrame | Sequence[str] | None = None,
                  start=None, stop=None) -> DataFrame:
    """MIN/AVG/MAX of ``c`` per calendar day 'MM-dd' over all years.

    The days of interest are a DataFrame with a ``day`` column ('MM-dd'), a list of such strings,
    or the days of the closed date range [start, stop].  They are applied as a semi-join after the
    per-day aggregate (at most 366 groups), so only wanted days are returned.
    """
    d = col_(date_col)
    agg = (df.groupBy(F.date_format(d, "MM-dd").alias("day"))
           .agg(F.min(col_(c)).alias("tmin"), F.avg(col_(c)).alias("tavg"), F.max(col_(c)).alias("tmax")))
    if days is None and start is not None:
        spark = df.sparkSession
        days = spark.range(1).select(F.explode(F.sequence(date_lit(start), date_lit(stop))).alias("d")) \
            .select(F.date_format("d", "MM-dd").alias("day"))
    elif days is not None and not isinstance(days, DataFrame):
        days = df.sparkSession.createDataFrame([(x,) for x in days], "day string")
    if days is None:
        return agg
    return agg.join(days.select("day").distinct(), "day", "left_semi")


def two_month_t(df: DataFrame, date_col, c, m1: int = 6, m2: int = 12) -> DataFrame:
    """Welch two-sample t statistic of ``c`` between calendar months m1 and m2 (all years).

    One aggregation pass produces n, mean and sample variance of both months; t and the
    Welch-Satterthwaite degrees of freedom are column arithmetic on that single row.
    """
    d, v = col_(date_col), col_(c)
    mo = F.month(d)
    a = df.agg(F.count(F.when(mo == m1, v)).alias("n1"), F.avg(F.when(mo == m1, v)).alias("mean1"),
               F.var_samp(F.when(mo == m1, v)).alias("var1"),
               F.count(F.when(mo == m2, v)).alias("n2"), F.avg(F.when(mo == m2, v)).alias("mean2"),
               F.var_samp(F.when(mo == m2, v)).alias("var2"))
    se1 = F.col("var1") / F.col("n1")
    se2 = F.col("var2") / F.col("n2")
    t = (F.col("mean1") - F.col("mean2")) / F.sqrt(se1 + se2)
    dof = (se1 + se2) ** 2 / (se1 ** 2 / (F.col("n1") - 1) + se2 ** 2 / (F.col("n2") - 1))
    return a.select("*", t.alias("t"), dof.alias("dof"))


def _betacf(a: float, b: float, x: float, itmax: int = 500, eps: float = 1e-15) -> float:
    """Continued fraction of the incomplete beta function (modified Lentz)."""
    tiny = 1e-300
    qab, qap, qam = a + b, a + 1.0, a - 1.0
    c, d = 1.0, 1.0 - qab * x / qap
    d = 1.0 / (d if abs(d) > tiny else tiny)
    h = d
    for m in range(1, itmax + 1):
        m2 = 2 * m
        for aa in (m * (b - m) * x / ((qam + m2) * (a + m2)), -(a + m) * (qab + m) * x / ((a + m2) * (qap + m2))):
            d = 1.0 + aa * d
            d = 1.0 / (d if abs(d) > tiny else tiny)
            c = 1.0 + aa / c
            c = c if abs(c) > tiny else tiny
            h *= d * c
        if abs(d * c - 1.0) < eps:
            break
    return h


def betainc_regularized(a: float, b: float, x: float) -> float:
    if x <= 0.0:
        return 0.0
    if x >= 1.0:
        return 1.0
    lbt = math.lgamma(a + b) - math.lgamma(a) - math.lgamma(b) + a * math.log(x) + b * math.log1p(-x)
    if x < (a + 1.0) / (a + b + 2.0):
        return math.exp(lbt) * _betacf(a, b, x) / a
    return 1.0 - math.exp(lbt) * _betacf(b, a, 1.0 - x) / b


def t_pvalue(t: float | None, dof: float | None) -> float | None:
    """Two-sided p-value of a t statistic with ``dof`` degrees of freedom (scalar helper)."""
    if t is None or dof is None or not math.isfinite(t) or not dof > 0:
        return None
    return betainc_regularized(dof / 2.0, 0.5, dof / (dof + t * t))


def with_t_pvalue(df: DataFrame, t: str = "t", dof: str = "dof", name: str = "p_value") -> DataFrame:
    """Add the two-sided p-value column to a t-statistic result (Arrow-batched; the input of a
    t test is one aggregated row, so this never touches raw data)."""
    @F.pandas_udf("double")
    def _p(ts: pd.Series, ds: pd.Series) -> pd.Series:
        return pd.Series([t_pvalue(None if pd.isna(a) else float(a), None if pd.isna(b) else float(b))
                          for a, b in zip(ts, ds)], dtype="float64")

    return df.withColumn(name, _p(F.col(t), F.col(dof)))


def date_range(df: DataFrame, date_col, start=None, stop=None) -> DataFrame:
    """Rows with ``start <= date`` and, when given, ``date <= stop`` (both ends inclusive)."""
    d = col_(date_col)
    if start is not None:
        df = df.where(d >= date_lit(start))
    if stop is not None:
        df = df.where(d <= date_lit(stop))
    return df

"""A key holding a third of all rows: AQE splits it in the joins, and results do not change."""
import datetime as dt

from pyspark.sql import functions as F

from ferrule.operators.history import latest_per_key
from ferrule.plans import letters as L
from ferrule.sources.schemas import LETTER_DATE_COLUMNS

HOT = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.advisoryPartitionSizeInBytes": "64k",
       "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "64k",
       "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2", "spark.sql.shuffle.partitions": "16"}


def with_conf(spark, conf, fn):
    old = {k: spark.conf.get(k, None) for k in conf}
    try:
        for k, v in conf.items():
            spark.conf.set(k, v)
        return fn()
    finally:
        for k, v in old.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def skewed_exceptions(spark, n=60000):
    ts = F.timestamp_seconds(F.col("id") * 3600).cast("timestamp_ntz")
    return spark.range(n).select(
        F.col("id").alias("exception_id"),
        F.when(F.col("id") % 3 == 0, F.lit("7")).otherwise((F.col("id") % 3000).cast("string")).alias("loan_number"),
        F.when(F.col("id") % 2 == 0, F.lit("HOA")).otherwise(F.lit("Current OCC Cert")).alias("document"),
        F.lit("Missing").alias("issue"), F.lit("Open").alias("exception_status"),
        F.lit(None).cast("string").alias("proof_of_repairs_status"),
        *[F.when(F.col("id") % (i + 2) == 0, ts).alias(c) for i, c in enumerate(LETTER_DATE_COLUMNS)])


def final_plan(df):
    qe = df._jdf.queryExecution()
    n = qe.executedPlan().execute().count()
    return n, qe.executedPlan().toString().split("== Initial Plan ==")[0]


def test_hot_loan_is_split_and_result_unchanged(spark):
    pop = spark.range(3000).select(F.col("id").cast("string").alias("loan_number"), F.lit(97.0).cast("float").alias("mca"))
    exc = skewed_exceptions(spark)
    p = L.LetterParams(as_of=dt.datetime(2001, 9, 1))

    def run():
        df = L.exception_scrub({"exceptions": exc}, pop, p)
        n, plan = final_plan(df)
        return n, plan, sorted(tuple(r) for r in df.select("exception_id", "max_date", "ltr_count").collect())

    n_hot, plan_hot, rows_hot = with_conf(spark, HOT, run)
    n_ref, _, rows_ref = with_conf(spark, {**HOT, "spark.sql.adaptive.skewJoin.enabled": "false"}, run)
    assert "skew=true" in plan_hot
    assert n_hot == n_ref == 60000 and rows_hot == rows_ref


def test_latest_per_key_with_a_hot_key(spark):
    df = spark.range(90000).select(F.when(F.col("id") % 3 == 0, F.lit(0)).otherwise(F.col("id") % 500).alias("k"),
                                   (F.col("id") % 977).alias("t"), F.col("id").alias("v"))
    got = with_conf(spark, HOT, lambda: sorted(tuple(r) for r in latest_per_key(df, "k", "t").collect()))
    mx = df.groupBy("k").agg(F.max("t").alias("t"))
    want = sorted(tuple(r) for r in df.join(mx, ["k", "t"]).select("k", "t", "v").collect())
    assert got == want

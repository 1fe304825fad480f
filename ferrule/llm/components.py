"""Connected components of an edge table by alternating large-star and small-star joins.

The edges never reach the driver: every round is grouping and joining, and is written to the shared
folder.  A node's star is aggregated as a minimum (map-side combine), so a hub with many neighbours
is no single group anywhere.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ferrule.llm.common import stored


def _large_star(e: DataFrame) -> DataFrame:
    both = e.unionByName(e.select(F.col("b").alias("a"), F.col("a").alias("b")))
    low = both.groupBy("a").agg(F.least(F.min("b"), F.first("a")).alias("m"))
    return (both.filter(F.col("b") > F.col("a")).join(low, "a")
            .select(F.col("b").alias("a"), F.col("m").alias("b")).filter("a <> b").distinct())


def _small_star(e: DataFrame) -> DataFrame:
    down = e.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    low = down.groupBy("a").agg(F.min("b").alias("m"))
    return (down.join(low, "a").select(F.explode(F.array(F.struct(F.col("a").alias("a"), F.col("m").alias("b")),
                                                         F.struct(F.col("b").alias("a"), F.col("m").alias("b"))))
                                       .alias("x")).select("x.a", "x.b").filter("a <> b").distinct())


def components(spark: SparkSession, edges: DataFrame, a: str = "a", b: str = "b", rounds: int = 64) -> DataFrame:
    """(node, component): the smallest node reachable, for each node with at least one edge.

    Null ends and loops are no edges; repeated edges count once; an empty table gives an empty one.
    """
    e = stored(spark, edges.select(F.col(a).cast("long").alias("a"), F.col(b).cast("long").alias("b"))
               .filter("a is not null and b is not null and a <> b")
               .select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "edges")
    for _ in range(rounds):
        n = e.agg(F.count("*"), F.countDistinct("a")).first()
        if n[0] == n[1] and e.join(e.select(F.col("a").alias("b")), "b", "left_semi").isEmpty():
            break                                        # one parent each and no parent is a child: stars
        e = stored(spark, _small_star(_large_star(e)), "edges")
    else:
        raise RuntimeError(f"components did not settle in {rounds} rounds")
    return (e.select(F.col("a").alias("node"), F.col("b").alias("component"))
            .unionByName(e.select(F.col("b").alias("node"), F.col("b").alias("component"))).distinct())

"""Shared helpers: table reading and connected components."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from assetpulse.session import materialize

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def ascii_lower(text: str = "text") -> str:
    """SQL expression: null is empty, A-Z lower-cased; lower() is the same and faster where all is ASCII."""
    return (
        f"CASE WHEN octet_length(coalesce({text}, '')) = length(coalesce({text}, '')) "
        f"THEN lower(coalesce({text}, '')) ELSE translate({text}, '{UPPER}', '{LOWER}') END"
    )


def connected_components(edges: DataFrame) -> DataFrame:
    """edges(a, b), any order, repeats allowed -> (node, root), root the smallest node reachable.

    Large-star and small-star rounds until nothing changes. Each round is checkpointed; the minima are written
    before the join, so that both join sides are plain shuffles, which adaptive execution splits where a node is hot.
    """
    pairs = materialize(
        edges.where("a <> b").selectExpr("greatest(a, b) AS u", "least(a, b) AS v").distinct()
    )  # u > v
    state = None
    while True:
        both = pairs.union(pairs.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = materialize(both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m")))
        large = both.join(least, "u").where("v > u").selectExpr("v AS u", "m AS v")
        large = materialize(large.where("u <> v").distinct())
        least = materialize(large.groupBy("u").agg(F.min("v").alias("m")))
        small = large.join(least, "u").selectExpr("explode(array(struct(u AS u, m AS v), struct(v AS u, m AS v))) AS e")
        pairs = materialize(small.select("e.u", "e.v").where("u <> v").distinct())
        now = pairs.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if now == state:
            return pairs.select(F.col("u").alias("node"), F.col("v").alias("root"))
        state = now

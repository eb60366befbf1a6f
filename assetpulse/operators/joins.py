"""Join operators.

No side is hinted for broadcast unless its row count is bounded by construction: Spark broadcasts
below spark.sql.autoBroadcastJoinThreshold, from file statistics or from measured shuffle sizes, and
otherwise runs sort-merge joins whose hot partitions adaptive execution splits.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from assetpulse.constants import ASSET


def restrict_to(df: DataFrame, ids: DataFrame, column: str = ASSET, id_column: str | None = None) -> DataFrame:
    """Rows whose id is in the list. The list is deduplicated before the shuffle."""
    keys = ids.select(F.col(id_column or ids.columns[0]).alias(column)).distinct()
    return df.join(keys, column, "left_semi")


def not_in(df: DataFrame, column: str, ids: DataFrame, id_column: str) -> DataFrame:
    """SQL NOT IN, with its null rules, on any size of list.

    The built-in null-aware anti join has to broadcast the whole list. Here a plain anti join drops the
    matches, and a one-row summary of the list supplies the null rules: a null in the list leaves no
    rows, and a null key survives only an empty list.
    """
    summary = ids.agg(
        F.count("*").alias("size"), F.coalesce(F.max(F.col(id_column).isNull()), F.lit(False)).alias("has_null")
    )
    keys = ids.select(F.col(id_column).alias(column)).dropna().distinct()
    verdict = F.struct("size", "has_null")
    rules = summary.select(verdict.alias("rules")).scalar()
    return (
        df.join(keys, column, "left_anti")
        .withColumn("list_rules", rules)
        .filter(~F.col("list_rules.has_null") & ((F.col("list_rules.size") == 0) | F.col(column).isNotNull()))
        .drop("list_rules")
    )


def first_per_key(dim: DataFrame, key: str, columns: list[str]) -> DataFrame:
    """One row per non-null key: the least row, as tables have no file order."""
    row = F.struct(*columns)
    one = dim.filter(F.col(key).isNotNull()).groupBy(key).agg(F.min(row).alias("row"))
    return one.select(key, *[F.col(f"row.{column}").alias(column) for column in columns])


def encode(df: DataFrame, code_map: DataFrame, column: str, id_column: str = "id") -> DataFrame:
    """Replace a name by its id from a map; unknown names become null. Of repeated names the largest id counts."""
    one = code_map.groupBy(F.col(column).alias("map_key")).agg(F.max(id_column).alias("map_id"))
    order = [F.col("map_id").alias(column) if name == column else F.col(name) for name in df.columns]
    return df.join(one, F.col(column) == F.col("map_key"), "left").select(*order)

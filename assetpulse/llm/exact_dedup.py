"""Exact duplicates by content-defined chunk recipes; DataFrame functions only."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from assetpulse.llm.common import ascii_lower
from assetpulse.session import materialize

#: A chunk ends at the first place past the minimum that follows one of these letters and a blank, else at the maximum.
CHUNK = r"(?s).{512,4096}?(?<=[g-m][ \n])|(?s).{1,4096}"


def exact_groups(docs: DataFrame, id_col: str = "doc_id", hash_bits: int = 64) -> DataFrame:
    """One row per input row: id, keep_id, group_size, kept, text_sha256, n_chunks.

    Texts are cut at places that their content fixes. A chunk's identifier is its hash and, where chunks with other
    bytes share that hash, its number among them: distinct chunks meet once, by content, after a map-side combine.
    Documents are equal when their ordered identifier lists are; only those lists are compared and moved.
    Null text counts as empty. The row with the largest id stays; of rows that repeat it, all are marked kept. Rows
    without id stay only in a group without any id.
    """
    base = docs.select(F.col(id_col).alias("_id"), F.expr(ascii_lower()).alias("_text"))
    chunked = base.withColumn("_chunks", F.regexp_extract_all("_text", F.lit(CHUNK), F.lit(0)))
    shift = f"shiftrightunsigned(xxhash64(c), {64 - hash_bits})"
    distinct = chunked.select(F.explode("_chunks").alias("c")).selectExpr(f"{shift} AS h", "c").groupBy("h", "c").agg(F.count("*").alias("n"))
    shared = distinct.groupBy("h").agg(F.count("*").alias("k")).where("k > 1").select("h")
    clashes = materialize(shared)
    if clashes.isEmpty():
        recipes = chunked.selectExpr("_id", "sha2(_text, 256) AS text_sha256", f"transform(_chunks, c -> struct({shift} AS h, 0L AS k)) AS recipe")
    else:
        listed = materialize(clashes.join(distinct.select("h", "c"), "h"))
        numbered = listed.select("h", "c", F.expr("dense_rank() OVER (PARTITION BY h ORDER BY c)").cast("long").alias("k"))
        keyed = materialize(base.select(F.monotonically_increasing_id().alias("row"), "_id", F.sha2("_text", 256).alias("text_sha256"), F.regexp_extract_all("_text", F.lit(CHUNK), F.lit(0)).alias("_chunks")))
        places = keyed.selectExpr("row", "posexplode(_chunks) AS (p, c)").selectExpr("row", "p", f"{shift} AS h", "c")
        ids = places.join(numbered, ["h", "c"], "left").selectExpr("row", "struct(p, h, coalesce(k, 0L) AS k) AS s")
        lists = ids.groupBy("row").agg(F.sort_array(F.collect_list("s")).alias("s"))
        recipes = keyed.select("row", "_id", "text_sha256").join(lists, "row", "left").selectExpr(
            "_id", "text_sha256", "transform(coalesce(s, array()), x -> struct(x.h AS h, x.k AS k)) AS recipe"
        )
    rows = materialize(recipes)
    groups = materialize(rows.groupBy("recipe").agg(F.max("_id").alias("keep_id"), F.count("*").alias("group_size")))
    joined = rows.join(groups, "recipe")
    return joined.select(
        F.col("_id").alias(id_col), "keep_id", "group_size", F.col("_id").eqNullSafe(F.col("keep_id")).alias("kept"), "text_sha256", F.size("recipe").alias("n_chunks"),
    )


def op3_exact_dedup(spark, sf_dir):
    from assetpulse.llm.common import table

    return exact_groups(table(spark, sf_dir, "documents")).drop("n_chunks")


SQL = """
WITH d AS (SELECT doc_id, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS t FROM documents)
SELECT doc_id, max(doc_id) OVER (PARTITION BY t) AS keep_id, count(*) OVER (PARTITION BY t) AS group_size,
       doc_id = max(doc_id) OVER (PARTITION BY t) AS kept, sha256(t) AS text_sha256
FROM d
"""

"""Corpus pipeline: quality, exact and near duplicates, source mix, packing."""

from __future__ import annotations

import uuid

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from assetpulse.llm import mixing
from assetpulse.llm.exact_dedup import exact_groups
from assetpulse.llm.mixing import LEVELS, SHARE, mix
from assetpulse.llm.packing import WEIGHTS, pack, pieces_of
from assetpulse.llm.quality import score, train
from assetpulse.llm.simhash import near_groups
from assetpulse.session import use_checkpoint_dir

PLACE = ["_file", "_at"]


def whole_row(docs: DataFrame) -> Column:
    """All of a row as one column, so that the stages' own columns clash with none of its names."""
    return F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_row")


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows that score 0.5 or more. Null and empty texts score as the empty text; equal texts score alike, so repeated rows
    stay or go together; no rows give none."""
    model = train(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return score(docs.select(whole_row(docs), "text"), model).where("quality_score >= 0.5").select("_row.*")


def with_place(docs: DataFrame) -> DataFrame:
    """_row, doc_id, text, _file and _at, a row's file and its place there: the same at each read, and no two rows share them.
    Rows that do not come straight from files are written first."""
    try:
        hidden = docs.metadataColumn("_metadata")
        places = hidden.getField("file_path").alias("_file"), hidden.getField("row_index").alias("_at")
        return docs.select(whole_row(docs), "doc_id", "text", *places)
    except AnalysisException:
        use_checkpoint_dir(docs.sparkSession)
        folder = f"{docs.sparkSession.sparkContext.getCheckpointDir()}/rows-{uuid.uuid4()}"
        docs.write.parquet(folder)
        return with_place(docs.sparkSession.read.parquet(folder))


def exact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row per group of equal texts: the largest doc_id, of its repeats the last by file and place. A row without
    doc_id stays only in a group without any, there again the last."""
    placed = with_place(docs)
    groups = exact_groups(placed.withColumn("_key", F.struct("doc_id", *PLACE)), "_key")
    return placed.join(groups.where("kept").select("_key.*").select(*PLACE), PLACE, "left_semi").select("_row.*")


def simhash(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row per component of near texts: the smallest doc_id, of its repeats the first by file and place. A row without
    doc_id stays only in a component without any, there again the first."""
    placed = with_place(docs)
    groups = near_groups(placed, 4, 4, tuple(PLACE))
    return placed.join(groups.where("doc_id <=> component_id").select("doc_id.*").select(*PLACE), PLACE, "left_semi").select("_row.*")


def sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """op4_mix's weights and share: a leaf within its budget gives every row, a leaf over it a seeded prefix. One epoch, so
    that no row comes out twice after the duplicates are gone."""
    return mix(docs, LEVELS, mixing.WEIGHTS, share=SHARE, epochs=1).select(*docs.columns)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """A row per piece, with its sequence and offset. Null and empty texts are one token; repeated rows are packed each; pieces
    of one length go by doc_id and piece; no rows give none."""
    import public_tokenizers

    return pack(pieces_of(docs, public_tokenizers.path("word_bpe_49k.json"), with_ids=False), weights=WEIGHTS)


STAGES = [("quality", quality), ("exact_dedup", exact), ("simhash", simhash), ("mixing", sources), ("packing", packing)]

#: A fitted model, SimHash components and packing are beyond SQL; tests compare the stages with plain versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Of a group of equal or near texts one row stays, also where ids are null or repeated. Each stage's rows are written under the shared checkpoint folder and read by the next."""
    use_checkpoint_dir(spark)
    folder = f"{spark.sparkContext.getCheckpointDir()}/pipeline-{uuid.uuid4()}"
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        stage(spark, docs, sf_dir).write.parquet(f"{folder}/{name}")
        docs = spark.read.parquet(f"{folder}/{name}")
    return docs

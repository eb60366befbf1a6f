"""File sources and sinks."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence
from concurrent.futures import ThreadPoolExecutor
from functools import reduce
from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from assetpulse.constants import ASSET, DATE, ZERO_DATE
from assetpulse.functions import as_date

__all__ = [
    "read_csv",
    "read_id_list",
    "drop_any_null",
    "valid_dates",
    "write_csv",
    "write_dated",
    "write_facts",
]


HEADER_READERS = 16  # files whose header is looked at at a time


def read_csv(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """CSV files, each with a header line; the declared columns are found by name in every file, others are ignored, a file
    that lacks one is an error. Files of a folder may have their columns in different orders.

    Only the headers are looked at first, one line of each file: the driver lists the files as for any read, and groups them
    by header. Each group is one scan; every column is text until it is cast. Text that is not of the declared type fails
    the job. Files without any line are left out."""
    names = [field.name for field in schema.fields]
    groups: dict[tuple[str, ...], list[str]] = {}
    for file, header in _headers(spark, path):
        missing = [name for name in names if name not in header]
        if missing:
            raise ValueError(f"{file} lacks the columns {missing}")
        groups.setdefault(header, []).append(file)
    parts = [_text(spark, files).select(*[F.col(f"`{field.name}`").cast(field.dataType).alias(field.name) for field in schema.fields]) for files in groups.values()]
    return reduce(DataFrame.unionByName, parts) if parts else spark.createDataFrame([], schema)


def _text(spark: SparkSession, files: Sequence[str]) -> DataFrame:
    return spark.read.option("header", True).option("inferSchema", False).csv(list(files))


def _headers(spark: SparkSession, path: str) -> list[tuple[str, tuple[str, ...]]]:
    """(file, column names) of each file with a line, in the order of the file names."""
    files = sorted(unquote(file) for file in spark.read.text(path).inputFiles())
    with ThreadPoolExecutor(HEADER_READERS) as pool:
        found = zip(files, pool.map(lambda file: tuple(_text(spark, [file]).columns), files), strict=True)
        return [(file, header) for file, header in found if header]


def read_id_list(spark: SparkSession, path: str, header: bool) -> DataFrame:
    """One-column id list. With header, the first line of each file is its name, even if that is a number such as 0;
    other lines that are no number are dropped."""
    lines = spark.read.schema("id STRING").option("header", header).option("enforceSchema", True).csv(path)
    return lines.select(F.expr("try_cast(trim(id) AS BIGINT)").alias("id")).dropna()


def drop_any_null(df: DataFrame) -> DataFrame:
    """Rows with a null in any column go; apply before projecting columns away."""
    return df.dropna("any")


def valid_dates(df: DataFrame, column: str) -> DataFrame:
    """Drop null and zero dates and parse the rest, without any time zone; filtering comes before parsing."""
    text = F.col(column).cast("string")
    kept = df.filter(text.isNotNull() & ~text.contains(ZERO_DATE))
    return kept.withColumn(column, text.try_cast("timestamp_ntz"))


def write_csv(df: DataFrame, path: str, mode: str = "errorifexists") -> None:
    df.write.mode(mode).option("header", True).csv(path)


def write_dated(df: DataFrame, path: str, as_of: dt.date | str, file_format: str = "parquet") -> None:
    """Write under as_of=...; only that date's folder is replaced when the run is repeated."""
    writer = df.withColumn("as_of", as_date(as_of)).write.partitionBy("as_of").mode("overwrite")
    if file_format == "csv":
        writer = writer.option("header", True)
    writer.option("partitionOverwriteMode", "dynamic").format(file_format).save(path)


def write_facts(facts: DataFrame, path: str, mode: str = "errorifexists") -> None:
    """Facts sorted by (date, asset) as CSV: the range sort is paid here and nowhere else."""
    write_csv(facts.orderBy(DATE, ASSET), path, mode)

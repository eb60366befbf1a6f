"""Database source and sink over Spark's JDBC format. Connection options always come from the caller."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from assetpulse.constants import SOURCE_TABLES
from assetpulse.session import materialize

__all__ = ["jdbc_read_options", "read_table", "extract_tables", "checked_for_sink", "append_table", "append_once"]

FETCH_ROWS = 10_000  # rows per round trip when reading
BATCH_ROWS = 50_000  # rows per insert batch


def jdbc_read_options(
    options: Mapping[str, str],
    table: str,
    partition: Mapping[str, str | int] | None = None,
) -> dict[str, str]:
    """Reader options; partition names partitionColumn, lowerBound, upperBound and numPartitions."""
    merged = {"fetchsize": str(FETCH_ROWS), **options, "dbtable": table}
    if partition:
        missing = {"partitionColumn", "lowerBound", "upperBound", "numPartitions"} - set(partition)
        if missing:
            raise ValueError(f"partition settings lack {sorted(missing)}")
        merged.update({key: str(value) for key, value in partition.items()})
    return merged


def read_table(
    spark: SparkSession,
    options: Mapping[str, str],
    table: str,
    columns: Sequence[str] | None = None,
    partition: Mapping[str, str | int] | None = None,
) -> DataFrame:
    """Table scan; the column list is pushed into the database query."""
    df = spark.read.format("jdbc").options(**jdbc_read_options(options, table, partition)).load()
    return df.select(*columns) if columns else df


def extract_tables(
    spark: SparkSession,
    options: Mapping[str, str],
    out: str,
    partitions: Mapping[str, Mapping[str, str | int]],
    tables: Sequence[str] = tuple(SOURCE_TABLES),
) -> DataFrame:
    """Copy tables to parquet under out/<table> and return (table, rows).

    Counts are read from the written parquet footers, so the database is read once. A table without
    partition settings would be read by one task; that is refused.
    """
    unpartitioned = [table for table in tables if table not in partitions]
    if unpartitioned:
        raise ValueError(f"no partition settings for {unpartitioned}")
    counts = None
    for table in tables:
        target = f"{out}/{table}"
        read_table(spark, options, table, partition=partitions[table]).write.mode("overwrite").parquet(target)
        rows = spark.read.parquet(target).agg(F.lit(table).alias("table"), F.count("*").alias("rows"))
        counts = rows if counts is None else counts.unionByName(rows)
    return counts


def _checked(field: T.StructField, widths: str) -> Column:
    value = F.col(field.name).cast(field.dataType)
    if not field.nullable:
        value = F.coalesce(value, F.raise_error(f"null in not-null column {field.name}").cast(field.dataType))
    limit = (field.metadata or {}).get("max_length")
    if limit and widths == "truncate":
        value = F.substring(value, 1, limit)
    elif limit and widths == "fail":
        too_long = F.raise_error(f"value longer than {limit} in column {field.name}").cast("string")
        value = F.when(F.length(value) > limit, too_long).otherwise(value)
    return value.alias(field.name)


def checked_for_sink(df: DataFrame, schema: T.StructType, widths: str = "fail") -> DataFrame:
    """Cast to the declared columns; a null fails the job, in the writing pass itself.

    widths says what becomes of a string over its declared length: fail, truncate, or widen (it is passed on as it
    is, for a table with wider columns)."""
    if widths not in ("fail", "truncate", "widen"):
        raise ValueError(f"unknown width policy {widths!r}")
    return df.select(*[_checked(field, widths) for field in schema.fields])


def append_table(
    df: DataFrame,
    schema: T.StructType,
    options: Mapping[str, str],
    table: str,
    writers: int | None = None,
    widths: str = "fail",
) -> None:
    """Append in insert batches; writers bounds the number of open connections.

    Rows are dealt to the writers by a shuffle, so that the stages before keep all their tasks. A task that runs again after
    an executor was lost appends its rows again; append_once does not."""
    checked = checked_for_sink(df, schema, widths)
    if writers:
        checked = checked.repartition(writers)
    merged = {"batchsize": str(BATCH_ROWS), **options, "dbtable": table}
    checked.write.format("jdbc").options(**merged).mode("append").save()


ROW_KEY = "row_key"


def keyed_rows(df: DataFrame) -> DataFrame:
    """df, written once to the shared folder, with a key per row that a task which runs again gives again."""
    return materialize(df).withColumn(ROW_KEY, F.monotonically_increasing_id())


def publish_statements(table: str, staging: str, run: str, columns: Sequence[str]) -> tuple[list[str], list[str], list[str]]:
    """SQL before, inside and after the one transaction that makes a run's rows part of the table. A second run of the same name
    breaks the ledger's key, and with it the transaction."""
    names = ", ".join(columns)
    once = f"SELECT DISTINCT {ROW_KEY}, {names} FROM {staging}"
    return (
        [f"CREATE TABLE IF NOT EXISTS {table}_runs (run VARCHAR(64) PRIMARY KEY)"],
        [f"INSERT INTO {table}_runs VALUES ('{run}')", f"INSERT INTO {table} ({names}) SELECT {names} FROM ({once}) AS once"],
        [f"DROP TABLE {staging}"],
    )


def stage_rows(df: DataFrame, options: Mapping[str, str], staging: str) -> None:
    """A new staging table with df's rows, some of them more than once if tasks ran again."""
    df.write.format("jdbc").options(**{"batchsize": str(BATCH_ROWS), **options, "dbtable": staging}).mode("overwrite").save()


def run_statements(spark: SparkSession, options: Mapping[str, str], statements: tuple[list[str], list[str], list[str]]) -> None:
    """Runs SQL on one connection of the driver; the middle list is one transaction."""
    properties = spark._jvm.java.util.Properties()
    for name, value in options.items():
        properties.setProperty(name, value)
    connection = spark._jvm.java.sql.DriverManager.getConnection(options["url"], properties)
    try:
        for part, alone in zip(statements, (True, False, True), strict=True):
            connection.setAutoCommit(alone)
            for text in part:
                connection.createStatement().execute(text)
            if not alone:
                connection.commit()
    finally:
        connection.close()


def append_once(
    df: DataFrame,
    schema: T.StructType,
    options: Mapping[str, str],
    table: str,
    run: str,
    writers: int | None = None,
    widths: str = "fail",
    stage: Callable[[DataFrame, Mapping[str, str], str], None] = stage_rows,
    publish: Callable[[SparkSession, Mapping[str, str], tuple], None] = run_statements,
) -> None:
    """Append each row once, also where tasks run again, and each run once.

    Rows get keys and go to a staging table of the run; a task that runs again adds the same rows with the same keys. One
    transaction then enters the run in the table's ledger and copies one row per key. A job that fails before it leaves the
    table as it was and can be run again; after it, the same run is refused. `run` is a plain word (letters, digits, _)."""
    if not run.replace("_", "").isalnum():
        raise ValueError(f"run {run!r} is not a plain word")
    keyed = keyed_rows(checked_for_sink(df, schema, widths))
    staging = f"{table}_{run}"
    stage(keyed.repartition(writers) if writers else keyed, options, staging)
    publish(df.sparkSession, options, publish_statements(table, staging, run, [field.name for field in schema.fields]))

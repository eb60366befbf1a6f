"""Session settings and lineage cuts."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def build_session(app_name: str = "assetpulse", master: str | None = None, **conf: str) -> SparkSession:
    """Session with the settings this package relies on; keyword arguments override with '__' for '.'."""
    builder = (
        SparkSession.builder.appName(app_name)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.cleaner.referenceTracking.cleanCheckpoints", "true")
    )
    if master:
        builder = builder.master(master)
    for key, value in conf.items():
        builder = builder.config(key.replace("__", "."), value)
    return builder.getOrCreate()


def use_checkpoint_dir(spark: SparkSession) -> None:
    """Point checkpoints at the shared folder in spark.checkpoint.dir; where it is unset, on one machine, at one under the
    warehouse. A cluster without the setting is refused: its machines need not share the default warehouse folder."""
    context = spark.sparkContext
    if context.getCheckpointDir():
        return
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if not shared and not context.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    context.setCheckpointDir(shared or spark.conf.get("spark.sql.warehouse.dir").rstrip("/") + "/_checkpoints")


def materialize(df: DataFrame) -> DataFrame:
    """Reliable checkpoint: df is computed once, and a lost executor rereads the files."""
    use_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)

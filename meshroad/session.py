"""Session settings and the shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

# Broadcast budget for an index or dimension whose size has been measured.
BROADCAST_BYTES = 128 * 1024 * 1024

SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
}
# Small local inputs: let a stage keep as many tasks as there are cores.
LOCAL_SETTINGS = {
    "spark.sql.adaptive.coalescePartitions.minPartitionSize": "64KB",
    "spark.sql.files.openCostInBytes": "524288",
}


def local_session(cores: str | int = "*", shuffle_partitions: int = 8, **extra: str) -> SparkSession:
    """A session for tests and single-node runs; on a cluster the submitted one is used as it is."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]").appName("meshroad")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", extra.pop("driver_memory", "8g"))
    )
    for key, value in {**SETTINGS, **LOCAL_SETTINGS, **extra}.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def scratch_dir(spark: SparkSession) -> str:
    """The folder all executors share, as named by `spark.checkpoint.dir`.

    A machine-local folder is made only for a local master with the setting unset.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    made = tempfile.mkdtemp(prefix="run-", dir="/tmp")
    spark.conf.set("spark.checkpoint.dir", made)
    return made


def new_table_path(spark: SparkSession, name: str) -> str:
    return f"{scratch_dir(spark)}/{name}-{uuid.uuid4().hex}"


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Write `df` to the shared folder and read it back: computed once, lineage cut, size known."""
    path = new_table_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)

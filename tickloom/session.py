"""Session settings and the shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_DIR = "spark.checkpoint.dir"
ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def local_session(cores: str | int = "*", **conf: str) -> SparkSession:
    """A local session for tests and the bench; clusters bring their own."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("tickloom")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "8g")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.streaming.metricsEnabled", "false")
    )
    for key, value in conf.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def use_utc(spark: SparkSession) -> None:
    """Pin the session zone: zone-less tables hold UTC wall time."""
    if spark.conf.get("spark.sql.session.timeZone") != "UTC":
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def use_rocksdb(spark: SparkSession) -> None:
    """Keep streaming state off-heap and commit changes only; for streams started afterwards."""
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", ROCKSDB)
    spark.conf.set("spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled", "true")


def scratch(spark: SparkSession, tag: str) -> str:
    """A fresh folder path below the shared folder the cluster names.

    Only a local session may fall back to a temporary folder; a cluster without
    ``spark.checkpoint.dir`` is refused, because an executor's own disk is gone
    when the executor is lost.
    """
    context = spark.sparkContext
    base = spark.conf.get(CHECKPOINT_DIR, None) or context.getCheckpointDir()
    if not base:
        if not context.master.startswith("local"):
            raise ValueError(f"set {CHECKPOINT_DIR} to a folder all executors share")
        context.setCheckpointDir(tempfile.mkdtemp(prefix="tickloom-"))
        base = context.getCheckpointDir()
    return f"{base.rstrip('/')}/tickloom/{tag}-{uuid.uuid4().hex}"


def staged(df: DataFrame) -> DataFrame:
    """Write ``df`` to the shared scratch folder and read it back.

    For results that several branches of a plan need: they are computed once, in
    columns, and outlive lost executors. The folder is left to whatever expires the
    checkpoint folder.
    """
    path = scratch(df.sparkSession, "staged")
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)

"""Starting streams and keeping what micro-batches write."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T
from pyspark.sql.streaming import StreamingQuery

AVAILABLE_NOW = {"availableNow": True}
EVERY_MINUTE = {"processingTime": "1 minute"}


def start_topic(
    messages: DataFrame,
    topic: str,
    checkpoint: str,
    options: Mapping[str, str] | None = None,
    *,
    mode: str = "append",
    trigger: Mapping | None = None,
    fmt: str = "kafka",
) -> StreamingQuery:
    """Write ``key, value`` messages to a topic (a folder for file formats)."""
    writer = messages.select("key", "value").writeStream.format(fmt).options(**(options or {}))
    writer = writer.outputMode(mode).option("checkpointLocation", checkpoint)
    writer = writer.option("topic" if fmt == "kafka" else "path", topic)
    return (writer.trigger(**trigger) if trigger else writer).start()


def start_batches(
    df: DataFrame,
    handle: Callable[[DataFrame, int], None],
    checkpoint: str,
    *,
    mode: str = "update",
    trigger: Mapping | None = None,
    skip_empty: bool = True,
) -> StreamingQuery:
    """Hand every micro-batch, or every non-empty one, to ``handle``.

    The batch is persisted first: a handler with several actions must not run the
    stream's plan again for each of them.
    """

    def keep_and_handle(batch: DataFrame, batch_id: int) -> None:
        batch = batch.persist()
        try:
            if not (skip_empty and batch.isEmpty()):
                handle(batch, batch_id)
        finally:
            batch.unpersist()

    writer = df.writeStream.foreachBatch(keep_and_handle).outputMode(mode).option("checkpointLocation", checkpoint)
    return (writer.trigger(**trigger) if trigger else writer).start()


def start_console(df: DataFrame, checkpoint: str, *, mode: str = "update", trigger: Mapping | None = None) -> StreamingQuery:
    """Print the schema and then every micro-batch."""
    df.printSchema()
    writer = df.writeStream.format("console").option("truncate", False).outputMode(mode)
    writer = writer.option("checkpointLocation", checkpoint)
    return (writer.trigger(**trigger) if trigger else writer).start()


def wait(query: StreamingQuery, timeout: float | None = None) -> bool:
    """Block until the stream ends; with a timeout, stop it then and return False."""
    if timeout is None:
        query.awaitTermination()
        return True
    ended = query.awaitTermination(timeout)
    if not ended:
        query.stop()
    return ended


class BatchTable:
    """A Parquet log with one folder per micro-batch; a repeated batch replaces its own folder."""

    def __init__(self, path: str, partition_by: Sequence[str] = ()):
        self.path, self.partition_by = path, list(partition_by)

    def write(self, rows: DataFrame, batch_id: int) -> None:
        writer = rows.write.mode("overwrite").partitionBy(*self.partition_by)
        writer.parquet(f"{self.path}/batch_id={batch_id}")

    def read(self, spark: SparkSession, schema: T.StructType) -> DataFrame:
        """All batches; an empty table where none was written yet."""
        with_batch = T.StructType([*schema.fields, T.StructField("batch_id", T.LongType())])
        folder = spark._jvm.org.apache.hadoop.fs.Path(self.path)
        if not folder.getFileSystem(spark._jsc.hadoopConfiguration()).exists(folder):
            return spark.createDataFrame([], with_batch)
        return spark.read.schema(with_batch).parquet(self.path)


def newest_per_key(log: DataFrame, keys: Sequence[str], version: str = "batch_id") -> DataFrame:
    """Fold a log of refreshed rows to the last one per key (one row per key and version)."""
    values = [c for c in log.columns if c not in (*keys, version)]
    return log.groupBy(*keys).agg(*(F.max_by(c, version).alias(c) for c in values))

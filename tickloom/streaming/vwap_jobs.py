"""Streaming VWAP: every window once when closed, refreshed windows, or the newest closed one."""

from __future__ import annotations

from collections.abc import Callable, Mapping
from datetime import datetime, timezone

from pyspark.sql import Column, DataFrame, functions as F, types as T
from pyspark.sql.streaming import StreamingQuery

from tickloom.operators.vwap import flat_windows, latest_closed, vwap, vwap_messages
from tickloom.sources.manifests import Ledger
from tickloom.sources.topics import write_topic
from tickloom.streaming.runners import EVERY_MINUTE, start_batches, start_topic


def stream_vwap(ticks: DataFrame, watermark: str = "2 minutes", **settings) -> DataFrame:
    """Flat VWAP windows of a tick stream; settings as for ``vwap``."""
    return flat_windows(vwap(ticks, watermark=watermark, **settings))


def publish_vwap(
    ticks: DataFrame,
    topic: str,
    checkpoint: str,
    options: Mapping[str, str] | None = None,
    *,
    watermark: str = "2 minutes",
    mode: str = "append",
    calculation_time: bool = True,
    volume_sum: bool = True,
    trigger: Mapping | None = None,
    fmt: str = "kafka",
    **settings,
) -> StreamingQuery:
    """Send windows to a topic: once each with ``append``, at every refresh with ``update``.

    ``watermark='0 seconds'`` closes a window as soon as a later event is seen. In append
    mode ticks are summed per slide first (``nested``).
    """
    settings.setdefault("nested", mode == "append")
    messages = vwap_messages(stream_vwap(ticks, watermark, **settings), calculation_time, volume_sum)
    return start_topic(messages, topic, checkpoint, options, mode=mode, trigger=trigger, fmt=fmt)


def publish_newest(
    ticks: DataFrame,
    checkpoint: str,
    send: Callable[[DataFrame, int], None] | None = None,
    *,
    topic: str | None = None,
    options: Mapping[str, str] | None = None,
    fmt: str = "kafka",
    watermark: str = "5 minutes",
    as_of: datetime | Column | Callable[[int], datetime | Column] | None = None,
    state: str | None = None,
    trigger: Mapping | None = EVERY_MINUTE,
    **settings,
) -> StreamingQuery:
    """Per micro-batch, publish each symbol's newest window that has ended by ``as_of`` (now).

    ``send`` gets the windows and the batch id; without it they go to ``topic``, a batch
    that is repeated after its delivery was noted once only. ``as_of``
    may depend on the batch id. A window that is still open at its last refresh is
    remembered, with each symbol's last published one, and is published by the first
    batch after its end; a window older than what was published is not. The memory lies in
    two folders below ``state`` (default: beside the checkpoint) used in turn, so it
    survives restarts, and a repeated batch publishes the same.
    """
    state = state or f"{checkpoint.rstrip('/')}-newest"
    flat = stream_vwap(ticks, watermark, **settings)
    memory = T.StructType([*flat.schema.fields, T.StructField("_fresh", T.BooleanType())])

    def to_topic(windows: DataFrame, batch_id: int) -> None:
        messages = vwap_messages(windows, calculation_time=False, volume_sum=False)
        send_once(messages, batch_id, f"{state}/delivered", topic, options, fmt=fmt)

    deliver = send or to_topic

    def handle(batch: DataFrame, batch_id: int) -> None:
        rows = batch.withColumns({"_fresh": F.lit(True), "_refreshed": F.lit(1)})
        if batch_id > 0:
            kept = batch.sparkSession.read.schema(memory).parquet(f"{state}/slot={(batch_id - 1) % 2}")
            rows = rows.unionByName(kept.withColumn("_refreshed", F.lit(0)))
        rest = [c for c in rows.columns if c not in ("symbol", "window_end", "_refreshed")]
        rows = rows.groupBy("symbol", "window_end").agg(*(F.max_by(c, "_refreshed").alias(c) for c in rest)).persist()
        by = _moment(as_of(batch_id) if callable(as_of) else as_of)
        newest = latest_closed(rows, by).persist()
        try:
            fresh = newest.filter("_fresh").select(*batch.columns)
            if not fresh.isEmpty():
                deliver(fresh, batch_id)
            done = newest.withColumn("_fresh", F.lit(False)).unionByName(rows.filter(F.col("window_end") > by))
            done.select(*memory.fieldNames()).write.mode("overwrite").parquet(f"{state}/slot={batch_id % 2}")
        finally:
            newest.unpersist()
            rows.unpersist()

    return start_batches(flat, handle, checkpoint, mode="update", trigger=trigger, skip_empty=False)


def send_once(
    messages: DataFrame, batch_id: int, ledger: str, topic: str, options: Mapping[str, str] | None = None, *, fmt: str = "kafka"
) -> bool:
    """Write a micro-batch's messages to a topic unless ``ledger`` says that was done; False where it was.

    A stream repeats its last batch when it stopped before its checkpoint was written.
    Only a stop between the end of the write and the note can still repeat messages.
    """
    delivered = Ledger(messages.sparkSession, ledger)
    if delivered.has(batch_id):
        return False
    write_topic(messages, topic, options, fmt=fmt)
    delivered.add(batch_id)
    return True


def _moment(as_of: datetime | Column | None) -> Column:
    if as_of is None:
        as_of = datetime.now(timezone.utc).replace(tzinfo=None)
    return F.lit(as_of).cast("timestamp_ntz") if isinstance(as_of, datetime) else as_of

"""The market views of the test tables.

``events`` are ticks of five symbols, ``orders`` make daily bars of five symbols.
"""

from __future__ import annotations

from datetime import datetime, timedelta

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from tickloom.functions.numbers import to_double
from tickloom.operators.bars import ohlcv
from tickloom.operators.candles import clean_ticks
from tickloom.schemas import BAR_COLUMNS
from tickloom.session import scratch

ROWS_PER_SLICE = 5_000_000

EVENTS = T.StructType(
    [
        T.StructField("event_id", T.LongType()),
        T.StructField("ts", T.TimestampNTZType()),
        T.StructField("user_id", T.LongType()),
        T.StructField("event_type", T.StringType()),
        T.StructField("value", T.DoubleType()),
        T.StructField("props", T.StringType()),
    ]
)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def raw_ticks(events: DataFrame) -> DataFrame:
    """Events as ticks, nothing filtered. ``json_tuple`` reads the text once per row, also below filters."""
    read = events.select("event_type", "ts", "value", "event_id", F.json_tuple("props", "k").alias("k"))
    return read.select(
        F.col("event_type").alias("symbol"),
        F.col("ts").alias("event_timestamp"),
        F.col("value").alias("price"),
        to_double("k").alias("volume"),
        "event_id",
    )


def ticks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return clean_ticks(raw_ticks(table(spark, sf_dir, "events")))


def event_stream(spark: SparkSession, path: str, files_per_batch: int | None = None) -> DataFrame:
    """Events files read as a stream; without a limit all files there now make one micro-batch."""
    reader = spark.readStream.schema(EVENTS)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.parquet(path)


def _slice_bounds(events: DataFrame, least: int, rows_per_slice: int) -> list[datetime]:
    """Lower bounds of slices of about equally many rows, and a bound after the last event.

    Cut at quantiles of the time, so neither a crowded hour nor an outlying time makes a
    slice large. A moment that spans several quantiles gets a slice of its own.
    """
    micros = F.unix_micros(F.col("ts").cast("timestamp"))
    n = events.agg(F.count("ts").alias("n")).first().n
    parts = max(least, -(-n // rows_per_slice))
    shares = F.array(*[F.lit(i / parts) for i in range(parts)])
    facts = events.agg(F.percentile_approx(micros, shares, 100 * parts).alias("cuts"), F.min(micros).alias("lo"), F.max(micros).alias("hi")).first()
    if facts.lo is None:
        return []
    cuts = [facts.lo, *facts.cuts[1:]]
    crowded = {a for a, b in zip(cuts, cuts[1:], strict=False) if a == b}
    bounds = sorted({*cuts, *(c + 1 for c in crowded), facts.hi + 1})
    return [datetime(1970, 1, 1) + timedelta(microseconds=m) for m in bounds]


def write_slices(events: DataFrame, path: str, least: int = 4, rows_per_slice: int = ROWS_PER_SLICE) -> list[datetime]:
    """Write the events in at least ``least`` slices of time, oldest first, as files a stream reads one by one.

    Returns the slices' bounds. Events without a time come before them. The events are read
    once and dealt into a folder per slice; each slice is then written from its own folder,
    after the one before: streams take files by age. A slice is one file, but for those without
    a time and for a crowded moment, whose rows need no order: they have one per ``rows_per_slice`` rows.
    """
    spark, dealt = events.sparkSession, scratch(events.sparkSession, "dealt")
    bounds = _slice_bounds(events, least, rows_per_slice)
    stamps = [F.lit(b).cast("timestamp_ntz") for b in bounds[1:-1]]
    number = F.size(F.filter(F.array(*stamps), lambda b: b <= F.col("ts"))) if stamps else F.lit(0)
    number = F.when(F.col("ts").isNull(), -1).otherwise(number)
    events.withColumn("_slice", number).write.partitionBy("_slice").parquet(dealt)
    sizes = {r[0]: r[1] for r in spark.read.parquet(dealt).groupBy("_slice").count().collect()}
    for i in sorted(sizes):
        part = spark.read.schema(events.schema).parquet(f"{dealt}/_slice={i}")
        alike = i < 0 or bounds[i + 1] - bounds[i] == timedelta(microseconds=1)
        files = -(-sizes[i] // rows_per_slice) if alike else 1
        (part.coalesce(1) if files == 1 else part.repartition(files)).write.mode("append").parquet(path)
    return bounds


_SLICES: dict[tuple[str, str], tuple[str, list[datetime]]] = {}


def event_slices(spark: SparkSession, sf_dir: str) -> tuple[str, list[datetime]]:
    """The events cut by time into at least four files, and the cuts' bounds; written once in an application."""
    key = (spark.sparkContext.applicationId, sf_dir)
    if key not in _SLICES:
        path = scratch(spark, "slices")
        _SLICES[key] = path, write_slices(table(spark, sf_dir, "events"), path)
    return _SLICES[key]


def sliced_tick_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ticks in several micro-batches, one slice of time each."""
    return stream_ticks(event_stream(spark, event_slices(spark, sf_dir)[0], 1))


def events_path(sf_dir: str) -> str:
    """The events table as a glob, since a stream takes a single file only through one."""
    return f"{sf_dir}/{{events}}.parquet"


def stream_ticks(events: DataFrame) -> DataFrame:
    """Streamed events as ticks, times as instants."""
    return clean_ticks(raw_ticks(events).withColumn("event_timestamp", F.col("event_timestamp").cast("timestamp")))


def tick_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stream_ticks(event_stream(spark, events_path(sf_dir)))


def daily_bars(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders by priority and day. Order dates have no time, so the key alone orders a day."""
    orders = table(spark, sf_dir, "orders").select(
        F.col("o_orderpriority").alias("symbol"), "o_orderdate", "o_totalprice", "o_orderkey"
    )
    return ohlcv(orders, "1D", time="o_orderdate", price="o_totalprice", volume=F.lit(1.0), order="o_orderkey")


def candle_topic(events: DataFrame, only: int | None = None) -> DataFrame:
    """Events as topic rows in four message forms, by event id or all in the form ``only``:

    simplified with microseconds; raw kline (finished for even volumes); simplified
    with bare numbers and whole seconds; simplified with neither symbol nor time.
    """
    t = raw_ticks(events)
    at = F.col("event_timestamp").cast("timestamp")
    price, volume = F.col("price").cast("string"), F.col("volume").cast("string")
    micros = F.date_format(at, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'").alias("@timestamp")
    seconds = F.date_format(at, "yyyy-MM-dd'T'HH:mm:ss'Z'").alias("@timestamp")
    kline = F.struct(
        F.unix_millis(at).alias("T"),
        F.col("symbol").alias("s"),
        F.lit("1m").alias("i"),
        price.alias("c"),
        volume.alias("v"),
        (F.col("volume") % 2 == 0).alias("x"),
    )
    forms = [
        F.struct("symbol", micros, price.alias("close"), volume.alias("volume")),
        F.struct(F.lit("kline").alias("e"), F.col("symbol").alias("s"), kline.alias("k")),
        F.struct("symbol", seconds, F.col("price").alias("close"), "volume"),
        F.struct(price.alias("close"), volume.alias("volume")),
    ]
    form = F.col("event_id") % 4 if only is None else F.lit(only)
    value = F.when(form == 0, F.to_json(forms[0]))
    for i, shape in enumerate(forms[1:], 1):
        value = value.when(form == i, F.to_json(shape))
    return t.select(
        F.col("symbol").cast("binary").alias("key"),
        value.cast("binary").alias("value"),
        F.lit("candles").alias("topic"),
        F.lit(0).alias("partition"),
        F.col("event_id").alias("offset"),
        at.alias("timestamp"),
    )


def bars_with_year(bars: DataFrame) -> DataFrame:
    return bars.select(*BAR_COLUMNS, F.year("datetime").alias("year"))

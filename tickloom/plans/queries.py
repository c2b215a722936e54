"""Every registered query: ``(spark, sf_dir) -> DataFrame``."""

from __future__ import annotations

import uuid
from collections.abc import Callable
from datetime import datetime, timedelta

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F, types as T

from tickloom.functions.text import format_symbol, search_hits
from tickloom.functions.times import iso_to_millis, millis_to_iso, ntz, order_key, parse_candle_time
from tickloom.operators.bars import bar_history, last_n_bars, ohlcv, rollup_bars
from tickloom.operators.blocks import with_blocks
from tickloom.operators.candles import normalise_candles, only_symbols, publish_candles
from tickloom.operators.indicators import EMA_ROWS, ema_of_array, ordered_history, with_indicators
from tickloom.operators.measures import flat_dimensions, latest_measures, measures_long
from tickloom.operators.pairing import compact_quotes, pair_asof, pair_latest, quote_messages, vwap_arrivals
from tickloom.operators.vwap import flat_windows, latest_closed, vwap, vwap_messages
from tickloom.plans import views
from tickloom.plans.medallion import bronze_to_silver, gold, silver_to_gold
from tickloom.schemas import BAR, BAR_COLUMNS, VWAP_MESSAGE
from tickloom.session import scratch, staged, use_rocksdb
from tickloom.sources import catalog, files
from tickloom.sources.payloads import bars_to_payload, payload_to_bars
from tickloom.sources.topics import as_text, read_topic, stream_topic, write_topic
from tickloom.streaming import pair_jobs
from tickloom.streaming.runners import AVAILABLE_NOW, BatchTable, newest_per_key, start_batches
from tickloom.streaming.stores import MeasureStore, merge_measures
from tickloom.streaming.vwap_jobs import publish_newest, publish_vwap, stream_vwap

Query = Callable[[SparkSession, str], DataFrame]

WINDOW_COLUMNS = ["symbol", "window_start", "window_end", "weighted_price_sum", "volume_sum", "vwap"]
GOLD_COLUMNS = ["SMA_200", "EMA_50", "RSI_14", "MACD"]


def _rounded(df: DataFrame, places: int, *names: str) -> DataFrame:
    return df.withColumns({n: F.round(n, places) for n in names})


PLACES = {"EMA_50": 4, "EMA_12": 5, "EMA_26": 4, "MACD": 4, "RSI_14": 8, "SMA_200": 6}


def _shown(df: DataFrame, *names: str) -> DataFrame:
    """Round computed indicators for comparison.

    A mean of two-decimal prices can lie exactly between two roundings, where the
    order of summation would decide; for the SMA a lift, far above that noise and far
    below the last place, decides such ties alike on both sides.
    """
    lift = {"SMA_200": 1e-9}
    return df.withColumns({n: F.round(F.col(n) + lift.get(n, 0.0), PLACES[n]) for n in names})


# -- ticks and candles -----------------------------------------------------


def q_ticks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return views.ticks(spark, sf_dir)


def q_symbol_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return only_symbols(views.ticks(spark, sf_dir), ["purchase"])


def q_normalise_candles(spark: SparkSession, sf_dir: str) -> DataFrame:
    clean = normalise_candles(views.candle_topic(views.table(spark, sf_dir, "events")), closed_only=False)
    return clean.withColumn("event_timestamp", ntz("event_timestamp"))


def q_closed_candles(spark: SparkSession, sf_dir: str) -> DataFrame:
    clean = normalise_candles(views.candle_topic(views.table(spark, sf_dir, "events")), closed_only=True)
    return clean.withColumn("event_timestamp", ntz("event_timestamp"))


def q_publish_candles(spark: SparkSession, sf_dir: str) -> DataFrame:
    return publish_candles(views.candle_topic(views.table(spark, sf_dir, "events"), only=1))


# -- scalar functions ------------------------------------------------------


def q_parse_times(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Event times written in three ways, one of them unreadable."""
    at = F.col("ts").cast("timestamp")
    written = (
        F.when(F.col("event_id") % 3 == 0, F.date_format(at, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'"))
        .when(F.col("event_id") % 3 == 1, F.date_format(at, "yyyy-MM-dd'T'HH:mm:ss'Z'"))
        .otherwise(F.date_format(at, "dd/MM/yyyy HH:mm"))
    )
    events = views.table(spark, sf_dir, "events").select("event_id", written.alias("written"))
    return events.select("event_id", ntz(parse_candle_time("written")).alias("parsed"))


def q_epoch_iso(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = views.table(spark, sf_dir, "events")
    out = events.select("event_id", F.unix_millis(F.col("ts").cast("timestamp")).alias("ms"))
    out = out.withColumn("iso", millis_to_iso("ms"))
    return out.withColumn("back_ms", iso_to_millis("iso"))


def q_format_symbol(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers as instruments: some already carry an exchange, some are futures."""
    c = views.table(spark, sf_dir, "customer")
    raw = F.when(F.col("c_custkey") % 3 == 0, F.concat(F.lit("X:"), F.col("c_name"))).otherwise(F.col("c_name"))
    contract = F.when(F.col("c_custkey") % 2 == 0, F.col("c_nationkey"))
    return c.select("c_custkey", format_symbol(raw, F.col("c_mktsegment"), contract).alias("full_symbol"))


def q_strip_markup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Parts as symbol-search replies with the brand marked, read back."""
    p = views.table(spark, sf_dir, "part")
    hit = F.struct(
        F.concat(F.lit("<em>"), F.col("p_brand"), F.lit("</em>"), F.col("p_partkey").cast("string")).alias("symbol"),
        F.col("p_name").alias("description"),
        F.col("p_type").alias("exchange"),
    )
    replies = p.select("p_partkey", F.to_json(F.array(hit)).alias("reply"))
    return replies.select("p_partkey", F.explode(search_hits(F.col("reply"))).alias("h")).select(
        "p_partkey", "h.symbol", "h.description", "h.exchange"
    )


def q_payload_to_bars(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Daily bars written as one history payload per symbol and month, read back."""
    month = F.date_format("datetime", "yyyy-MM")
    return payload_to_bars(bars_to_payload(views.daily_bars(spark, sf_dir), month))


# -- bars ------------------------------------------------------------------


def _bars(size: str) -> Query:
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        return ohlcv(views.ticks(spark, sf_dir), size, order=order_key("event_timestamp", "event_id"))

    return query


def q_bars_rollup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Monthly bars from daily ones."""
    daily = ohlcv(views.ticks(spark, sf_dir), "1D", order=order_key("event_timestamp", "event_id"))
    return rollup_bars(daily, "1M")


def q_daily_bars(spark: SparkSession, sf_dir: str) -> DataFrame:
    return views.daily_bars(spark, sf_dir)


def q_last_n_bars(spark: SparkSession, sf_dir: str) -> DataFrame:
    return last_n_bars(staged(views.daily_bars(spark, sf_dir)), 1460, "1D")


def _last_n_of_known(n: int) -> Query:
    """Some bars lack their symbol, some their time; they belong to no series."""

    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        bars, day = views.daily_bars(spark, sf_dir), F.dayofmonth("datetime")
        bars = bars.withColumns(
            {
                "symbol": F.when(day != 13, F.col("symbol")),
                "datetime": F.when(day != 17, F.col("datetime")),
            }
        )
        return last_n_bars(staged(bars), n, "1D")

    return query


def q_bar_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last 200 hourly bars of one instrument, its name put together like a user's request."""
    ticks = views.ticks(spark, sf_dir).withColumn("symbol", F.concat(F.lit("EVT:"), F.col("symbol")))
    return bar_history(ticks, "purchase", "EVT", "1H", 200, order=order_key("event_timestamp", "event_id"))


# -- indicators ------------------------------------------------------------


def _indicators(*names: str, keep: tuple[str, ...] = ("symbol", "datetime", "close")) -> Query:
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        bars = staged(views.daily_bars(spark, sf_dir).select(*keep))
        return _shown(with_indicators(bars, names), *names)

    return query


def q_returns(spark: SparkSession, sf_dir: str) -> DataFrame:
    names = ("prev_close", "delta", "gain", "loss")
    bars = staged(views.daily_bars(spark, sf_dir).select("symbol", "datetime", "close"))
    return _rounded(with_indicators(bars, names), 2, *names)


def q_indicators(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _shown(with_indicators(staged(views.bars_with_year(views.daily_bars(spark, sf_dir)))), *GOLD_COLUMNS)


def q_indicators_irregular(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Indicators over single ticks, which no interval spaces, in the order of their ids at one time."""
    events = views.table(spark, sf_dir, "events")
    ticks = events.select(F.col("event_type").alias("symbol"), F.col("ts").alias("datetime"), F.col("value").alias("close"), "event_id")
    return _shown(with_indicators(ticks, ("SMA_200", "RSI_14"), size=None, order=("event_id",)), "SMA_200", "RSI_14")


def q_ema_from_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    """EMA_50 folded over arrays of up to 300 closes, block by block."""
    bars = staged(views.daily_bars(spark, sf_dir).select("symbol", "datetime", "close"))
    cut = with_blocks(bars, "symbol", "datetime", 86400, EMA_ROWS[50] - 1)
    frame = Window.partitionBy("symbol", "_block").orderBy("datetime").rowsBetween(1 - EMA_ROWS[50], 0)
    folded = cut.withColumn("EMA_50", ema_of_array(ordered_history("close", "datetime", frame), 50))
    return _shown(folded.filter(~F.col("_halo")).select("symbol", "datetime", "close", "EMA_50"), "EMA_50")


# -- VWAP ------------------------------------------------------------------


def _windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _show_windows(flat_windows(vwap(views.ticks(spark, sf_dir))))


def _show_windows(windows: DataFrame) -> DataFrame:
    return _rounded(windows.select(*WINDOW_COLUMNS), 4, "weighted_price_sum")


def q_vwap_sliding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _windows(spark, sf_dir)


def q_vwap_plain(spark: SparkSession, sf_dir: str) -> DataFrame:
    """No volume filter, not rounded by the operator but here, to compare."""
    raw = views.raw_ticks(views.table(spark, sf_dir, "events"))
    raw = raw.withColumn("price_x_volume", F.col("price") * F.col("volume"))
    windows = flat_windows(vwap(raw, positive_volume=False, round_to=None))
    return _rounded(windows.select("symbol", "window_start", "window_end", "vwap"), 8, "vwap")


def q_vwap_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vwap_messages(_windows(spark, sf_dir))


def _newest_event(spark: SparkSession, sf_dir: str) -> datetime:
    return views.table(spark, sf_dir, "events").agg(F.max("ts")).first()[0]


def q_vwap_latest_closed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """As of the newest event; later ticks cannot be in a window closed by then."""
    as_of = _newest_event(spark, sf_dir)
    ticks = views.ticks(spark, sf_dir).filter(F.col("event_timestamp") < F.lit(as_of).cast("timestamp_ntz"))
    return _show_windows(latest_closed(flat_windows(vwap(ticks)), as_of))


# -- pairing and measures --------------------------------------------------


def _pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    ticks = views.ticks(spark, sf_dir)
    quotes = compact_quotes(quote_messages(ticks, seq="event_id"), distinct=True)
    return pair_latest(quotes.unionByName(vwap_arrivals(_windows(spark, sf_dir), grid="1 minute")), grain="1 day")


def q_pair_asof(spark: SparkSession, sf_dir: str) -> DataFrame:
    windows = _windows(spark, sf_dir).select("symbol", "window_end", "vwap")
    return pair_asof(windows, views.ticks(spark, sf_dir), slide="1 minute", order="event_id")


def q_pair_asof_offgrid(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Windows that end half a minute off the grid."""
    windows = _windows(spark, sf_dir).select("symbol", "window_end", "vwap")
    windows = windows.withColumn("window_end", F.col("window_end") + F.expr("interval 30 seconds"))
    return pair_asof(windows, views.ticks(spark, sf_dir), order="event_id")


def q_pair_topics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pairs from two topics; some messages lack a price, a bound or a value and are skipped."""
    rows = views.candle_topic(views.table(spark, sf_dir, "events"))
    empty = F.col("offset") % 7 == 0
    rows = rows.withColumn("value", F.when(empty, F.lit("{}").cast("binary")).otherwise(F.col("value")))
    windows = _windows(spark, sf_dir)
    lacking = F.minute("window_end") % 5
    messages = vwap_messages(
        windows.withColumns(
            {
                "window_start": F.when(lacking == 0, None).otherwise(F.col("window_start")),
                "vwap": F.when(lacking == 1, None).otherwise(F.col("vwap")),
                "at": F.col("window_end").cast("timestamp"),
            }
        ),
        extra=("at",),
    )
    vwaps = messages.select(
        F.col("key").cast("binary").alias("key"), F.col("value").cast("binary").alias("value"), F.col("at").alias("timestamp"), F.lit(0).alias("offset")
    )
    quotes = pair_jobs.quotes_from_topic(rows)
    return pair_latest(quotes.unionByName(pair_jobs.vwaps_from_topic(vwaps)), grain="1 day")


def q_pair_latest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _pairs(spark, sf_dir)


DIMENSIONS = ["symbol", "source_topic", "window_start", "window_end", "event_ts"]


def _by_window_end() -> Column:
    return F.unix_millis(F.col("window_end").cast("timestamp"))


def q_measures_long(spark: SparkSession, sf_dir: str) -> DataFrame:
    return flat_dimensions(measures_long(_pairs(spark, sf_dir), version=_by_window_end()), DIMENSIONS)


def q_measures_latest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every tick rewrites its hour's close; the newest version of each hour stays."""
    records = views.ticks(spark, sf_dir).select(
        F.create_map(F.lit("symbol"), F.col("symbol")).alias("dimensions"),
        F.lit("close").alias("measure_name"),
        F.col("price").alias("measure_value"),
        F.window("event_timestamp", "1 hour")["end"].alias("time"),
        F.unix_micros(F.col("event_timestamp").cast("timestamp")).alias("version"),
    )
    return flat_dimensions(latest_measures(records), ["symbol"])


# -- files, layers, catalog ------------------------------------------------


def q_csv_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch(spark, "csv")
    files.write_csv_by_year(views.daily_bars(spark, sf_dir), path)
    return files.read_csv(spark, path, T.StructType([*BAR.fields, T.StructField("year", T.IntegerType())]))


def q_silver_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch(spark, "silver")
    bronze = views.daily_bars(spark, sf_dir).withColumn("partition_0", F.lit("bronze"))
    bronze_to_silver(bronze, path)
    return files.read_parquet(spark, path)


def q_gold_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bars to silver, silver to gold, gold read back."""
    silver_path, gold_path = scratch(spark, "silver"), scratch(spark, "gold")
    bronze_to_silver(views.bars_with_year(views.daily_bars(spark, sf_dir)), silver_path)
    silver_to_gold(spark, silver_path, gold_path)
    return _shown(files.read_parquet(spark, gold_path), *GOLD_COLUMNS)


def q_gold_text_times(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Times as text, those of the 13th of a month unreadable and left out."""
    bars = views.bars_with_year(views.daily_bars(spark, sf_dir))
    text = F.when(F.dayofmonth("datetime") == 13, "never").otherwise(F.date_format("datetime", "yyyy-MM-dd HH:mm:ss"))
    return _shown(gold(staged(bars.withColumn("datetime", text))), *GOLD_COLUMNS)


def q_land_csv(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Yearly files landed in two calls, and the first year once more: every row once."""
    by_year, named, landed = (scratch(spark, tag) for tag in ("csv", "named", "landed"))
    files.write_csv_by_year(views.daily_bars(spark, sf_dir), by_year)
    years = files.name_by_year(spark, by_year, named)
    for pattern in (f"*_{years[0]}.csv", f"*_{{{','.join(years[1:])}}}.csv", f"*_{years[0]}.csv"):
        files.land_csv(spark, f"{named}/{pattern}", landed)
    return files.read_landed(spark, landed).drop("file")


def q_catalog_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch(spark, "bronze")
    files.write_csv_by_year(views.daily_bars(spark, sf_dir), path)
    name = f"bars_{uuid.uuid4().hex}"
    catalog.register_table(spark, name, "bars", path, location=scratch(spark, "database"))
    try:
        found = catalog.scan_table(spark, name, "bars")
        return staged(found.select(ntz("datetime").alias("datetime"), *BAR_COLUMNS[1:], "year"))
    finally:
        spark.sql(f"DROP DATABASE `{name}` CASCADE")


# -- streaming -------------------------------------------------------------


def _run_windows(spark: SparkSession, windows: DataFrame, mode: str) -> DataFrame:
    """Run a window stream over what is there now and fold its log to one row per window."""
    use_rocksdb(spark)
    log = BatchTable(scratch(spark, "windows"))
    query = start_batches(windows, log.write, scratch(spark, "checkpoint"), mode=mode, trigger=AVAILABLE_NOW)
    query.awaitTermination()
    written = log.read(spark, windows.schema)
    if mode == "append":
        return written.drop("batch_id")
    return newest_per_key(written, ["symbol", "window_start", "window_end"])


def _vwap_stream(watermark: str, mode: str) -> Query:
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        windows = stream_vwap(views.sliced_tick_stream(spark, sf_dir), watermark, nested=mode == "append")
        return _show_windows(_run_windows(spark, windows, mode))

    return query


def q_vwap_stream_latest(spark: SparkSession, sf_dir: str) -> DataFrame:
    use_rocksdb(spark)
    as_of = _newest_event(spark, sf_dir)
    log = BatchTable(scratch(spark, "newest"))
    ticks = views.tick_stream(spark, sf_dir)
    publish_newest(ticks, scratch(spark, "checkpoint"), log.write, as_of=as_of, trigger=AVAILABLE_NOW).awaitTermination()
    written = log.read(spark, stream_vwap(ticks).schema)
    return _show_windows(newest_per_key(written, ["symbol"]))


def q_vwap_stream_sparse(spark: SparkSession, sf_dir: str) -> DataFrame:
    """At least four micro-batches; one symbol falls silent after a quarter of the time.

    Its last window closes after its last refresh, and is published by a later batch.
    """
    use_rocksdb(spark)
    events = views.table(spark, sf_dir, "events")
    path, bounds = views.event_slices(spark, sf_dir)
    quarter = bounds[0] + (bounds[-1] - timedelta(microseconds=1) - bounds[0]) / 4
    silent = F.col("symbol") == "purchase"
    last = events.filter((F.col("event_type") == "purchase") & (F.col("ts") < F.lit(quarter).cast("timestamp_ntz"))).agg(F.max("ts")).first()[0]
    ticks = views.stream_ticks(views.event_stream(spark, path, 1))
    ticks = ticks.filter(~silent | (F.col("event_timestamp") < F.lit(quarter).cast("timestamp_ntz").cast("timestamp")))
    closing = [min(bounds[1], last + timedelta(seconds=1)), *bounds[2:]]
    log = BatchTable(scratch(spark, "newest"))
    as_of = lambda batch_id: closing[min(batch_id, len(closing) - 1)]
    publish_newest(ticks, scratch(spark, "checkpoint"), log.write, as_of=as_of, trigger=AVAILABLE_NOW).awaitTermination()
    written = log.read(spark, stream_vwap(ticks).schema)
    return _show_windows(newest_per_key(written, ["symbol"]))


def q_topic_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Closed candles written to a topic (a folder stands for it) and read back between its bounds."""
    topic = scratch(spark, "topic")
    write_topic(publish_candles(views.candle_topic(views.table(spark, sf_dir, "events"), only=1)), topic, fmt="parquet")
    schema = T.StructType([T.StructField("key", T.StringType()), T.StructField("value", T.StringType())])
    return as_text(read_topic(spark, topic, fmt="parquet", schema=schema))


def q_topic_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Candle messages streamed from a topic, one file per trigger."""
    path, _ = views.event_slices(spark, sf_dir)
    topic, log = scratch(spark, "topic"), BatchTable(scratch(spark, "candles"))
    events = spark.readStream.schema(views.EVENTS).option("maxFilesPerTrigger", 1).parquet(path)
    rows = views.candle_topic(events).writeStream.format("parquet").option("checkpointLocation", scratch(spark, "checkpoint"))
    rows.trigger(**AVAILABLE_NOW).start(topic).awaitTermination()
    clean = normalise_candles(stream_topic(spark, topic, max_per_trigger=1, fmt="parquet"), closed_only=False)
    start_batches(clean, log.write, scratch(spark, "checkpoint"), mode="append", trigger=AVAILABLE_NOW).awaitTermination()
    return log.read(spark, clean.schema).drop("batch_id").withColumn("event_timestamp", ntz("event_timestamp"))


def _halves(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, Column]:
    """The events and the middle of their time span (one row of two bounds)."""
    events = views.table(spark, sf_dir, "events")
    bounds = events.agg(F.min("ts").alias("lo"), F.max("ts").alias("hi")).first()
    return events, F.lit(bounds.lo + (bounds.hi - bounds.lo) / 2).cast("timestamp_ntz")


def q_vwap_stream_late(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All events, then the first half of them once more: the repeats are too late to count."""
    use_rocksdb(spark)
    events, middle = _halves(spark, sf_dir)
    late, checkpoint = scratch(spark, "late"), scratch(spark, "checkpoint")
    log = BatchTable(scratch(spark, "windows"))
    for part in (events.limit(0), events.filter(F.col("ts") < middle)):
        files.write_parquet(part, late, mode="append")
        arriving = views.event_stream(spark, views.events_path(sf_dir)).unionByName(views.event_stream(spark, late))
        windows = stream_vwap(views.stream_ticks(arriving), "2 minutes")
        start_batches(windows, log.write, checkpoint, mode="append", trigger=AVAILABLE_NOW).awaitTermination()
    return _show_windows(log.read(spark, windows.schema))


def q_vwap_stream_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Candle messages of all forms in, VWAP messages out, each closed window once."""
    use_rocksdb(spark)
    out = scratch(spark, "topic")
    events = views.event_stream(spark, views.events_path(sf_dir))
    ticks = normalise_candles(views.candle_topic(events))
    publish_vwap(ticks, out, scratch(spark, "checkpoint"), trigger=AVAILABLE_NOW, fmt="json").awaitTermination()
    message = F.from_json("value", VWAP_MESSAGE)
    written = spark.read.schema("key string, value string").json(out).select("key", message.alias("m"))
    return written.select(
        "key",
        ntz(F.to_timestamp("m.calculation_time")).alias("calculation_time"),
        ntz(F.to_timestamp("m.window_start")).alias("window_start"),
        ntz(F.to_timestamp("m.window_end")).alias("window_end"),
        "m.symbol",
        F.col("m.vwap").cast("double").alias("vwap"),
        F.col("m.volume_sum").cast("double").alias("volume_sum"),
    )


def _stream_pairs(spark: SparkSession, sf_dir: str, on_pairs: Callable[[DataFrame, int], None]) -> None:
    """Quotes and VWAP windows arriving in two steps; the slots survive the restart between them."""
    ticks = views.ticks(spark, sf_dir)
    quotes = compact_quotes(quote_messages(ticks, seq="event_id"), distinct=True)
    messages = staged(quotes.unionByName(vwap_arrivals(_windows(spark, sf_dir), grid="1 minute")))
    _, middle = _halves(spark, sf_dir)
    source, state, checkpoint = scratch(spark, "messages"), scratch(spark, "slots"), scratch(spark, "checkpoint")
    for part in (messages.filter(F.col("arrival") < middle), messages.filter(F.col("arrival") >= middle)):
        files.write_parquet(part, source, mode="append")
        arriving = spark.readStream.schema(pair_jobs.PENDING).parquet(source)
        pair_jobs.stream_pairs(
            arriving, state, checkpoint, on_pairs, trigger=AVAILABLE_NOW
        ).awaitTermination()


def q_pair_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    log = BatchTable(scratch(spark, "pairs"))
    _stream_pairs(spark, sf_dir, log.write)
    return log.read(spark, pair_jobs.PAIR).drop("batch_id")


def q_pair_asof_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Windows and ticks as two streams of the same slices of time, paired by event time in four micro-batches or more."""
    use_rocksdb(spark)
    path, bounds = views.event_slices(spark, sf_dir)
    ends, windows = scratch(spark, "ends"), staged(_windows(spark, sf_dir))
    for lo, hi in zip(bounds, [*bounds[1:-1], datetime.max], strict=False):
        span = (F.col("window_end") >= F.lit(lo).cast("timestamp_ntz")) & (F.col("window_end") < F.lit(hi).cast("timestamp_ntz"))
        files.write_parquet(windows.filter(span).coalesce(1), ends, mode="append")
    streamed = spark.readStream.schema(windows.schema).option("maxFilesPerTrigger", 1).parquet(ends)
    ticks = views.stream_ticks(views.event_stream(spark, path, 1))
    pairs = pair_jobs.stream_asof(streamed, ticks, max_age="10 minutes", order="event_id")
    log = BatchTable(scratch(spark, "pairs"))
    start_batches(pairs, log.write, scratch(spark, "checkpoint"), mode="append", trigger=AVAILABLE_NOW).awaitTermination()
    return log.read(spark, pairs.schema).drop("batch_id")


def q_measures_store(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Streamed pairs kept as measures in runs that merge; the store read at its highest versions."""
    path = scratch(spark, "measures")
    _stream_pairs(spark, sf_dir, merge_measures(path, fan_in=2, version=_by_window_end()))
    return flat_dimensions(MeasureStore(spark, path).read(), DIMENSIONS)


QUERIES: dict[str, Query] = {
    "ticks": q_ticks,
    "symbol_filter": q_symbol_filter,
    "normalise_candles": q_normalise_candles,
    "closed_candles": q_closed_candles,
    "publish_candles": q_publish_candles,
    "parse_times": q_parse_times,
    "epoch_iso": q_epoch_iso,
    "format_symbol": q_format_symbol,
    "strip_markup": q_strip_markup,
    "payload_to_bars": q_payload_to_bars,
    "vwap_sliding": q_vwap_sliding,
    "vwap_plain": q_vwap_plain,
    "vwap_json": q_vwap_json,
    "vwap_latest_closed": q_vwap_latest_closed,
    "bars_1m": _bars("1"),
    "bars_3m": _bars("3"),
    "bars_5m": _bars("5"),
    "bars_15m": _bars("15"),
    "bars_30m": _bars("30"),
    "bars_45m": _bars("45"),
    "bars_1h": _bars("1H"),
    "bars_2h": _bars("2H"),
    "bars_3h": _bars("3H"),
    "bars_4h": _bars("4H"),
    "bars_daily": _bars("1D"),
    "bars_weekly": _bars("1W"),
    "bars_monthly": _bars("1M"),
    "bars_rollup": q_bars_rollup,
    "daily_bars": q_daily_bars,
    "last_n_bars": q_last_n_bars,
    "last_n_bars_1000": _last_n_of_known(1000),
    "last_n_bars_1001": _last_n_of_known(1001),
    "bar_history": q_bar_history,
    "returns": q_returns,
    "sma_200": _indicators("SMA_200"),
    "rsi_14": _indicators("RSI_14"),
    "ema_50": _indicators("EMA_50"),
    "ema_from_history": q_ema_from_history,
    "macd": _indicators("EMA_12", "EMA_26", "MACD"),
    "indicators": q_indicators,
    "indicators_irregular": q_indicators_irregular,
    "pair_asof": q_pair_asof,
    "pair_asof_offgrid": q_pair_asof_offgrid,
    "pair_latest": q_pair_latest,
    "pair_topics": q_pair_topics,
    "measures_long": q_measures_long,
    "measures_latest": q_measures_latest,
    "csv_roundtrip": q_csv_roundtrip,
    "silver_roundtrip": q_silver_roundtrip,
    "gold_roundtrip": q_gold_roundtrip,
    "gold_text_times": q_gold_text_times,
    "land_csv": q_land_csv,
    "catalog_scan": q_catalog_scan,
    "topic_roundtrip": q_topic_roundtrip,
    "topic_stream": q_topic_stream,
    "vwap_stream_append": _vwap_stream("2 minutes", "append"),
    "vwap_stream_append0": _vwap_stream("0 seconds", "append"),
    "vwap_stream_update": _vwap_stream("5 minutes", "update"),
    "vwap_stream_latest": q_vwap_stream_latest,
    "vwap_stream_sparse": q_vwap_stream_sparse,
    "vwap_stream_late": q_vwap_stream_late,
    "vwap_stream_json": q_vwap_stream_json,
    "pair_stream": q_pair_stream,
    "pair_asof_stream": q_pair_asof_stream,
    "measures_store": q_measures_store,
}

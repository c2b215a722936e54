"""Pairing quotes with VWAP windows: by event time and by arrival.

Both work on consecutive grains of one symbol's rows, so a symbol with most of the
rows is spread over many tasks; what has to cross a grain border is carried by a
table with one row per (symbol, grain). A grain is a span of time where the rows in
it are bounded, else (``grain=None``) a piece of about equally many rows, whose border may
lie between two rows of one second.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from tickloom.functions.times import duration_seconds, on_grid, order_key
from tickloom.operators.blocks import with_pieces
from tickloom.session import staged

# How a result that two branches need is kept; ``staged`` writes it to the shared folder.
Stage = Callable[[DataFrame], DataFrame]

QUOTE, VWAP = 0, 1
ARRIVAL_ORDER = ("arrival", "side", "seq")
PAYLOAD = ("side", "value", "window_start", "window_end")
MESSAGE_COLUMNS = ("symbol", *ARRIVAL_ORDER, "value", "window_start", "window_end")


def _no_time() -> Column:
    return F.lit(None).cast("timestamp_ntz")


def _with_grains(rows: DataFrame, time: str, grain: str | None, order: Sequence[str], stage: Stage) -> DataFrame:
    if grain is None:
        return with_pieces(rows, "symbol", time, order=order, stage=stage).withColumnRenamed("_piece", "_grain")
    return rows.withColumn("_grain", F.window(time, grain)["start"])


# -- by event time ---------------------------------------------------------


def pair_asof(
    windows: DataFrame,
    quotes: DataFrame,
    slide: str | None = None,
    grain: str | None = None,
    *,
    time: str = "event_timestamp",
    price: str = "price",
    order: str | None = None,
    stage: Stage = staged,
) -> DataFrame:
    """Give each window the last quote of its symbol with ``time < window_end``.

    By default windows may end anywhere: quotes stay as they are, and grains are cut
    by row count. Where all windows end on a grid, ``slide`` names it: quotes are then
    cut down to the last one per slide, map-side, before they meet the windows, and a
    grain is 1500 slides; a window that ends off the grid fails the query. ``order``, a
    whole number that differs between quotes of equal time, decides between them and
    keeps the cut in fixed-width hash aggregates; without it the larger price
    counts. Windows without an earlier quote, and rows without symbol or time, are
    left out.

    A quote sorts by its time, so "the last one so far" is a running maximum: within
    a grain by a window, over earlier grains by the carry table.
    """
    at = F.col(time).cast("timestamp_ntz")
    seq = F.col(order) if order else F.lit(0)
    quote = F.struct(at.alias("quote_time"), seq.alias("seq"), F.col(price).alias("close"))
    if slide is None:
        rank, quote_rows = 1, quotes.select("symbol", at.alias("_at"), quote.alias("_quote"))
    else:
        rank = -1
        grain = grain or f"{1500 * (duration_seconds(slide) or 60)} seconds"
        step_end = F.window(time, slide)["end"].cast("timestamp_ntz")
        steps = quotes.filter(at.isNotNull()).groupBy("symbol", step_end.alias("_at"))
        if order:
            key = order_key(at, seq)
            last = [F.max_by(c, key).alias(n) for c, n in ((at, "quote_time"), (seq, "seq"), (F.col(price), "close"))]
            quote_rows = steps.agg(*last).select("symbol", "_at", F.struct("quote_time", "seq", "close").alias("_quote"))
        else:
            quote_rows = steps.agg(F.max(quote).alias("_quote"))
        windows = windows.withColumn("window_end", on_grid(F.col("window_end"), slide))
    kept = [c for c in windows.columns if c != "symbol"]
    window_rows = windows.select(
        "symbol", F.col("window_end").alias("_at"), F.lit(0).alias("_rank"), F.struct(*kept).alias("_window")
    )
    rows = quote_rows.withColumn("_rank", F.lit(rank)).unionByName(window_rows, allowMissingColumns=True)

    so_far = Window.partitionBy("symbol", "_grain").orderBy("_at", "_rank")
    earlier = Window.partitionBy("symbol").orderBy("_grain").rowsBetween(Window.unboundedPreceding, -1)
    local = stage(
        _with_grains(rows, "_at", grain, ("_rank", "_quote"), stage)
        .withColumn("_last", F.max("_quote").over(so_far))
        .select("symbol", "_grain", "_window", "_last")
    )
    ends = local.groupBy("symbol", "_grain")
    if order:
        key, parts = order_key(F.col("_last.quote_time"), F.col("_last.seq")), ("quote_time", "seq", "close")
        ends = ends.agg(*(F.max_by(f"_last.{c}", key).alias(c) for c in parts))
        tail = F.when(F.col("quote_time").isNotNull(), F.struct(*parts))
        ends = ends.select("symbol", "_grain", tail.alias("_tail"))
    else:
        ends = ends.agg(F.max("_last").alias("_tail"))
    carry = (
        ends.select("symbol", "_grain", F.max("_tail").over(earlier).alias("_before"))
    )
    return (
        local.filter(F.col("_window").isNotNull())
        .join(carry, ["symbol", "_grain"])
        .withColumn("_last", F.coalesce("_last", "_before"))
        .filter(F.col("_last").isNotNull())
        .select("symbol", *(F.col(f"_window.{c}") for c in kept), "_last.quote_time", "_last.close")
    )


# -- by arrival ------------------------------------------------------------


def quote_messages(
    ticks: DataFrame, time: str = "event_timestamp", price: str = "price", seq: str | None = None
) -> DataFrame:
    """Ticks as quote messages; those without a price are no quotes."""
    return ticks.filter(F.col(price).isNotNull()).select(
        "symbol",
        F.col(time).cast("timestamp_ntz").alias("arrival"),
        F.lit(QUOTE).alias("side"),
        (F.col(seq).cast("long") if seq else F.lit(0).cast("long")).alias("seq"),
        F.col(price).alias("value"),
        _no_time().alias("window_start"),
        _no_time().alias("window_end"),
    )


def vwap_arrivals(
    windows: DataFrame, time: str = "window_end", seq: str | None = None, grid: str | None = None
) -> DataFrame:
    """Flat windows as VWAP messages; those lacking a value or a bound are skipped.

    ``grid`` is what ``compact_quotes`` was given: an arrival off it fails the query.
    """
    if grid is not None:
        windows = windows.withColumn(time, on_grid(F.col(time), grid))
    whole = F.col("vwap").isNotNull() & F.col("window_start").isNotNull() & F.col("window_end").isNotNull()
    return windows.filter(whole).select(
        "symbol",
        F.col(time).cast("timestamp_ntz").alias("arrival"),
        F.lit(VWAP).alias("side"),
        (F.col(seq).cast("long") if seq else F.lit(0).cast("long")).alias("seq"),
        F.col("vwap").alias("value"),
        "window_start",
        "window_end",
    )


def compact_quotes(messages: DataFrame, grid: str = "1 minute", distinct: bool = False) -> DataFrame:
    """First and last quote per symbol and grid step; enough when VWAPs arrive on the grid.

    Have ``vwap_arrivals(grid=)`` check that they do. ``distinct`` promises that no two
    quotes of a symbol share time and ``seq``; the ends are then found by fixed-width
    hash aggregates.

    Between two VWAP messages only the first quote can complete a pair and only
    the last one can be remembered, and a run of two tells the same as a longer
    one. A step holds the quotes after the previous grid point up to and including
    its own, since a quote arriving with a VWAP message is taken first.
    """
    step = F.window(F.col("arrival") - F.expr("interval 1 microsecond"), grid)["start"]
    row, steps = F.struct("arrival", "seq", "value"), messages.groupBy("symbol", step.alias("_step"))
    if distinct:
        key, parts = order_key(F.col("arrival"), F.col("seq")), ("arrival", "seq", "value")
        ends = steps.agg(
            *(F.min_by(c, key).alias(f"a_{c}") for c in parts),
            *(F.max_by(c, key).alias(f"b_{c}") for c in parts),
            F.count(F.lit(1)).alias("_n"),
        ).select(
            "symbol",
            F.struct(*(F.col(f"a_{c}").alias(c) for c in parts)).alias("_first"),
            F.struct(*(F.col(f"b_{c}").alias(c) for c in parts)).alias("_last"),
            "_n",
        )
    else:
        ends = steps.agg(F.min(row).alias("_first"), F.max(row).alias("_last"), F.count(F.lit(1)).alias("_n"))
    kept = F.when(F.col("_n") == 1, F.array("_first")).otherwise(F.array("_first", "_last"))
    return ends.select("symbol", F.explode(kept).alias("m")).select(
        "symbol",
        "m.arrival",
        F.lit(QUOTE).alias("side"),
        "m.seq",
        "m.value",
        _no_time().alias("window_start"),
        _no_time().alias("window_end"),
    )


def fold_arrivals(messages: DataFrame, grain: str | None = None, stage: Stage = staged) -> DataFrame:
    """Run the two-slot pairing over messages in arrival order; adds ``before`` and ``emits``.

    A message overwrites its slot; when both slots are full they are paired and
    emptied. So a pair can only arise at a message of the other side than the one
    ``before`` it, and does so exactly if that one did not emit itself: in an
    unbroken run of side changes every second message emits, starting with the
    first change. The place of the last message that was no change therefore
    decides, and that is a running maximum: within a grain by a window, over
    earlier grains by the carry table. Given a ``grain``, the messages are shuffled
    once.
    """
    in_grain = Window.partitionBy("symbol", "_grain").orderBy(*ARRIVAL_ORDER, "value")
    so_far = in_grain.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    grains = Window.partitionBy("symbol").orderBy("_grain")
    earlier = grains.rowsBetween(Window.unboundedPreceding, -1)

    payload = F.struct(*PAYLOAD)
    unchanged = F.when((F.col("_i") > 1) & (F.col("_prev.side") == F.col("side")), F.col("_i"))
    local = stage(
        _with_grains(messages.select(*MESSAGE_COLUMNS), "arrival", grain, (*ARRIVAL_ORDER[1:], "value"), stage)
        .withColumns({"_i": F.row_number().over(in_grain), "_prev": F.lag(payload).over(in_grain)})
        .withColumn("_unchanged", F.max(unchanged).over(so_far))
    )
    # A grain's first message is compared with the last one of the grain before.
    starts = F.col("_before").isNull() | (F.col("_before.side") == F.col("_first_side"))
    carry = (
        local.groupBy("symbol", "_grain")
        .agg(
            F.count(F.lit(1)).alias("_n"),
            F.min_by("side", "_i").alias("_first_side"),
            *(F.max_by(c, "_i").alias(c) for c in PAYLOAD),
            F.max("_unchanged").alias("_unchanged_at"),
        )
        .withColumn("_tail", payload)
        .withColumns({"_before": F.lag("_tail").over(grains), "_offset": F.coalesce(F.sum("_n").over(earlier), F.lit(0))})
        .withColumn("_start", F.when(starts, F.lit(1)))
        .withColumn("_reset", F.col("_offset") + F.coalesce("_unchanged_at", "_start"))
        .select("symbol", "_grain", "_before", "_offset", "_start", F.max("_reset").over(earlier).alias("_carried"))
    )
    run = F.coalesce(F.col("_offset") + F.coalesce("_unchanged", "_start"), F.col("_carried"))
    return (
        local.join(carry, ["symbol", "_grain"])
        .withColumn("before", F.coalesce("_prev", "_before"))
        .withColumn("emits", (F.col("_offset") + F.col("_i") - run) % 2 == 1)
        .select(*MESSAGE_COLUMNS, "before", "emits")
    )


def pairs_of(folded: DataFrame) -> DataFrame:
    """The emitted pairs of folded messages."""
    quote_last = F.col("side") == QUOTE
    vwap = F.when(quote_last, F.col("before")).otherwise(F.struct("side", "value", "window_start", "window_end"))
    return (
        folded.filter("emits")
        .withColumn("_vwap", vwap)
        .select(
            "symbol",
            F.col("arrival").alias("paired_at"),
            F.when(quote_last, F.col("value")).otherwise(F.col("before.value")).alias("close"),
            F.col("_vwap.value").alias("vwap"),
            "_vwap.window_start",
            "_vwap.window_end",
        )
    )


def pair_latest(messages: DataFrame, grain: str | None = None, stage: Stage = staged) -> DataFrame:
    """Pairs of the two-slot pairing, one row each."""
    return pairs_of(fold_arrivals(messages, grain, stage))


def pending(folded: DataFrame) -> DataFrame:
    """The filled slot each symbol is left with, as a message (none if it is empty)."""
    rest = [c for c in MESSAGE_COLUMNS if c != "symbol"]
    newest = F.max_by(F.struct(*rest, "emits"), F.struct(*ARRIVAL_ORDER, "value"))
    return folded.groupBy("symbol").agg(newest.alias("m")).filter(~F.col("m.emits")).select("symbol", *(f"m.{c}" for c in rest))

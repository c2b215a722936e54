"""SMA, truncated EMA, RSI and MACD.

All frames count rows. A trailing sum over ``L`` rows is put together from shorter
ones laid end to end,

    S[v + w](t) = S[v](t) + d**v * S[w](t - v),

four equal ones per step and then the powers of four that make up ``L``; ``d`` is 1
for a plain sum and the decay for an exponential one. That is some log(L) ``lag``
columns in place of an array (or a rescanned frame) of ``L`` values per row, it
never subtracts, and all indicators share the same window steps, one sort and one
exchange. Rows before the start of a series count as 0; a NULL value makes
exactly the sums that contain it NULL.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window, WindowSpec, functions as F

from tickloom.operators.blocks import ROWS_PER_BLOCK, ROWS_PER_COUNTED_BLOCK, ROWS_PER_CUT, ROWS_PER_GRAIN, with_blocks, with_counted_blocks
from tickloom.schemas import Interval, interval

# Sums joined per window step: a window step costs more than a lag column.
RADIX = 4

# Frame lengths of the indicator set.
SMA_ROWS = 200
RSI_ROWS = 14
EMA_ROWS = {50: 300, 12: 200, 26: 300}


@dataclass(frozen=True)
class Trailing:
    """``name`` = sum over the last ``rows`` rows of ``source``, weight ``decay**age``."""

    name: str
    source: str
    rows: int
    decay: float = 1.0


def _pieces(rows: int) -> list[int]:
    """Powers of ``RADIX`` that add up to ``rows``, largest first."""
    pieces, width = [], 1
    while rows:
        rows, digit = divmod(rows, RADIX)
        pieces = [width] * digit + pieces
        width *= RADIX
    return pieces


def trailing_sums(df: DataFrame, sums: Sequence[Trailing], over: WindowSpec) -> DataFrame:
    """Add every trailing sum, one window step per power of ``RADIX`` for all of them together."""

    def part(s: Trailing, width: int) -> str:
        return s.source if width == 1 else f"_{s.name}_{width}"

    def shifted(s: Trailing, width: int, by: int) -> Column:
        return F.lit(s.decay**by) * F.lag(part(s, width), by, 0.0).over(over)

    def joined(s: Trailing, pieces: Sequence[int]) -> Column:
        """Sums of these widths end to end, newest first."""
        age, total = pieces[0], F.col(part(s, pieces[0]))
        for piece in pieces[1:]:
            total = total + shifted(s, piece, age)
            age += piece
        return total

    keep = df.columns
    width = 1
    while any(RADIX * width <= s.rows for s in sums):
        df = df.withColumns(
            {part(s, RADIX * width): joined(s, [width] * RADIX) for s in sums if RADIX * width <= s.rows}
        )
        width *= RADIX
    return df.select(*keep, *(joined(s, _pieces(s.rows)).alias(s.name) for s in sums))


def ema_decay(span: int) -> float:
    return 1.0 - 2.0 / (span + 1.0)


def ema_from_sum(total: Column, rows_so_far: Column, span: int, rows: int) -> Column:
    """Divide a decayed sum by the weights of the rows it covers (fewer at the start)."""
    d = ema_decay(span)
    covered = F.least(rows_so_far, F.lit(rows))
    return total * F.lit(1.0 - d) / (F.lit(1.0) - F.pow(F.lit(d), covered))


def _series(
    bars: DataFrame, halo: int, size: str | Interval | None, key: str, time: str, order: Sequence[str], rows_per_grain: int | None, rows_per_block: int | None
) -> tuple[DataFrame, WindowSpec]:
    """Rows and the window to compute over: blocks of a stretch of time where ``size`` bounds it, else of counted rows."""
    if size is None:
        cut = with_counted_blocks(bars, key, time, halo, order, rows_per_grain or ROWS_PER_CUT, rows_per_block or ROWS_PER_COUNTED_BLOCK)
    else:
        cut = with_blocks(bars, key, time, interval(size).seconds, halo, rows_per_grain or ROWS_PER_GRAIN, rows_per_block or ROWS_PER_BLOCK)
    return cut, Window.partitionBy(key, "_block").orderBy(time, *order)


def with_indicators(
    bars: DataFrame,
    names: Sequence[str] = ("SMA_200", "EMA_50", "RSI_14", "MACD"),
    *,
    size: str | Interval | None = "1D",
    key: str = "symbol",
    time: str = "datetime",
    close: str = "close",
    order: Sequence[str] = (),
    rows_per_grain: int | None = None,
    rows_per_block: int | None = None,
) -> DataFrame:
    """Add indicator columns to bars, one series per ``key``.

    ``names`` may hold ``prev_close, delta, gain, loss, SMA_200, EMA_50, EMA_12,
    EMA_26, MACD, RSI_14``. ``size`` is the bar interval, which bounds the rows in
    a stretch of time and so lets the series be cut in blocks. With ``None`` (rows not
    spaced by an interval) the blocks come from counted rows, also where one second
    holds most of a series; that reads the rows twice and keeps them in between.
    ``order`` names columns that order rows of one time.

    Average gain and loss are simple means over 14 rows; no loss gives RSI 100.
    The SMA skips NULL closes, an EMA over a NULL is NULL. Bars without a key or a
    time belong to no series and are left out.
    """
    columns = bars.columns
    unknown = [n for n in names if n not in HALO]
    if unknown:
        raise ValueError(f"unknown indicators {unknown}; any of {', '.join(HALO)}")
    wanted = set(names)
    halo = max(HALO[n] for n in names)
    df, over = _series(bars, halo, size, key, time, order, rows_per_grain, rows_per_block)
    df = df.withColumns({"_row": F.row_number().over(over), "prev_close": F.lag(close).over(over)})
    delta = F.col(close) - F.col("prev_close")
    df = df.withColumn("delta", delta).withColumns(
        {
            "gain": F.when(F.col("delta") > 0, F.col("delta")).otherwise(0.0),
            "loss": F.when(F.col("delta") < 0, -F.col("delta")).otherwise(0.0),
            "_value": F.coalesce(F.col(close), F.lit(0.0)),
            "_known": F.col(close).isNotNull().cast("double"),
        }
    )

    sums, results = [], {n: F.col(n) for n in names if n in ("prev_close", "delta", "gain", "loss")}
    if "SMA_200" in wanted:
        sums += [Trailing("_sum", "_value", SMA_ROWS), Trailing("_count", "_known", SMA_ROWS)]
        results["SMA_200"] = F.try_divide(F.col("_sum"), F.col("_count"))
    if "RSI_14" in wanted:
        sums += [Trailing("_gain", "gain", RSI_ROWS), Trailing("_loss", "loss", RSI_ROWS)]
        strength = F.col("_gain") / F.col("_loss")
        results["RSI_14"] = F.when(F.col("_loss") == 0, 100.0).otherwise(100.0 - 100.0 / (1.0 + strength))
    ema = {}
    for span, rows in EMA_ROWS.items():
        if f"EMA_{span}" in wanted or (span in (12, 26) and "MACD" in wanted):
            sums.append(Trailing(f"_ema{span}", close, rows, ema_decay(span)))
            ema[span] = ema_from_sum(F.col(f"_ema{span}"), F.col("_row"), span, rows)
            if f"EMA_{span}" in wanted:
                results[f"EMA_{span}"] = ema[span]
    if "MACD" in wanted:
        results["MACD"] = ema[12] - ema[26]

    df = trailing_sums(df, sums, over) if sums else df
    return df.filter(~F.col("_halo")).select(*columns, *(results[n].alias(n) for n in names))


# Rows a kept row looks back over; gains need one more for the previous close.
HALO = {
    "prev_close": 1,
    "delta": 1,
    "gain": 1,
    "loss": 1,
    "SMA_200": SMA_ROWS - 1,
    "RSI_14": RSI_ROWS,
    "MACD": max(EMA_ROWS[12], EMA_ROWS[26]) - 1,
    **{f"EMA_{span}": rows - 1 for span, rows in EMA_ROWS.items()},
}


def ordered_history(value: str, time: str, over: WindowSpec) -> Column:
    """Values of a bounded frame as an array, oldest first; NULL values keep their place."""
    pairs = F.sort_array(F.collect_list(F.struct(F.col(time).alias("k"), F.col(value).alias("v"))).over(over))
    return F.transform(pairs, lambda p: p["v"])


def ema_of_array(values: Column, span: int) -> Column:
    """EMA of an array, newest value last, weights renormalised; empty or NULL gives NULL."""
    d = ema_decay(span)
    folded = F.aggregate(values, F.lit(0.0), lambda acc, v: acc * F.lit(d) + v)
    weights = (F.lit(1.0) - F.pow(F.lit(d), F.size(values))) / F.lit(1.0 - d)
    return F.when(F.size(values) > 0, folded / weights)

"""Cutting long series into bounded pieces.

A window partitioned by symbol alone sends a whole symbol to one task. The
functions here cut each series along time so that every task gets a bounded
number of rows, whatever share of the table one symbol holds.

A *grain* is a fixed span of time. Bars come at most once per interval, so a
grain of ``r`` intervals holds at most ``r`` rows of a symbol: the bound follows
from the data model, not from measuring. Grain counts combine map-side, and the
grain table is smaller than the series by up to that factor. Rows that come at any
rate are cut by measured counts instead (``with_pieces``).
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from tickloom.session import staged

# A block with its halo of up to 299 rows and a grain too many at either end stays
# below the 4096 rows a window step buffers without going through its spillable sorter.
ROWS_PER_GRAIN = 128
ROWS_PER_BLOCK = 3500
ROWS_PER_PIECE = 250_000
# Rows without an interval: whole pieces lead a block, so blocks are many times as long.
ROWS_PER_CUT = 4_000
ROWS_PER_COUNTED_BLOCK = 100_000
PIECES_PER_STRETCH = 4096
PIECE_STEP = 1 << 31  # numbers between two pieces, for the parts of a crowded moment


def in_a_series(df: DataFrame, key: str, time: str) -> DataFrame:
    """Rows that have a key and a time; the others belong to no series."""
    return df.filter(F.col(key).isNotNull() & F.col(time).isNotNull())


def grain_start(time: Column | str, seconds: int) -> Column:
    """Start of the grain holding ``time``."""
    return F.window(time, f"{seconds} seconds")["start"]


def _grain_counts(df: DataFrame, key: str, time: str, seconds: int) -> DataFrame:
    return df.groupBy(key, grain_start(time, seconds).alias("_grain")).agg(F.count(F.lit(1)).alias("_n"))


def with_blocks(
    df: DataFrame,
    key: str,
    time: str,
    bar_seconds: int,
    halo: int,
    rows_per_grain: int = ROWS_PER_GRAIN,
    rows_per_block: int = ROWS_PER_BLOCK,
) -> DataFrame:
    """Add ``_block`` and ``_halo``: consecutive blocks, each led by its halo.

    Every row appears once with ``_halo`` false. Rows near the end of a block
    appear again, ``_halo`` true, in the next one, so that a frame reaching back
    up to ``halo`` rows finds them. A series' first block has no halo, hence
    frames at its start stay partial exactly as in an uncut window.

    A grain starting at row ``s`` with ``n`` rows belongs to block ``s div B``.
    A later block starting at row ``t`` needs it only if ``t - (s + n) < halo``,
    and then ``t div B <= (s + n + halo - 1) div B``: the copies below cover that
    for any grain size, so the bounds matter for balance and never for the result.
    Rows without a key or a time are left out.
    """
    df = in_a_series(df, key, time)
    seconds = bar_seconds * rows_per_grain
    before = Window.partitionBy(key).orderBy("_grain").rowsBetween(Window.unboundedPreceding, -1)
    first_row = F.coalesce(F.sum("_n").over(before), F.lit(0))
    grains = _grain_counts(df, key, time, seconds).withColumn("_first", first_row)
    return _in_blocks(df.withColumn("_grain", grain_start(time, seconds)), grains, key, halo, rows_per_block)


def _in_blocks(df: DataFrame, grains: DataFrame, key: str, halo: int, rows_per_block: int) -> DataFrame:
    """Rows (with ``_grain``) in the blocks that hold their grain, or need it as halo; ``grains`` knows ``_first`` and ``_n``."""
    ends = grains.select(
        F.col(key),
        "_grain",
        F.expr(f"_first div {rows_per_block}").alias("_own"),
        F.expr(f"(_first + _n + {halo - 1}) div {rows_per_block}").alias("_last"),
    )
    placed = df.join(ends, [key, "_grain"])
    blocks = placed.withColumn("_block", F.explode(F.sequence("_own", F.greatest("_own", "_last"))))
    return blocks.withColumn("_halo", F.col("_block") != F.col("_own")).drop("_grain", "_own", "_last")


def with_counted_blocks(
    df: DataFrame,
    key: str,
    time: str,
    halo: int,
    order: Sequence[str] = (),
    rows_per_piece: int = ROWS_PER_CUT,
    rows_per_block: int = ROWS_PER_COUNTED_BLOCK,
    stage: Callable[[DataFrame], DataFrame] = staged,
) -> DataFrame:
    """``with_blocks`` for rows that no interval spaces: exact ranks from counts, not from a window over a series.

    The rows are cut into pieces at measured counts (``with_pieces``), also within a second, and
    kept by ``stage``; the first rank of a piece is the number of rows in those before it,
    added up within stretches of pieces and over the stretches. ``order`` names
    columns that order the rows of one time; without it their order is any.
    """
    cut = stage(with_pieces(df, key, time, rows_per_piece, order=(time, *order), stage=stage).withColumnRenamed("_piece", "_grain"))
    stretch = F.floor(F.col("_grain") / (PIECES_PER_STRETCH * PIECE_STEP)).alias("_stretch")
    pieces = stage(cut.groupBy(key, "_grain").agg(F.count(F.lit(1)).alias("_n"))).select("*", stretch)
    inside = Window.partitionBy(key, "_stretch").orderBy("_grain").rowsBetween(Window.unboundedPreceding, -1)
    earlier = Window.partitionBy(key).orderBy("_stretch").rowsBetween(Window.unboundedPreceding, -1)
    stretches = pieces.groupBy(key, "_stretch").agg(F.sum("_n").alias("_rows"))
    stretches = stretches.select(key, "_stretch", F.coalesce(F.sum("_rows").over(earlier), F.lit(0)).alias("_before"))
    ranked = pieces.withColumn("_inside", F.coalesce(F.sum("_n").over(inside), F.lit(0))).join(stretches, [key, "_stretch"])
    return _in_blocks(cut, ranked.withColumn("_first", F.col("_before") + F.col("_inside")), key, halo, rows_per_block)


def newest_rows(
    df: DataFrame, key: str, time: str, bar_seconds: int, n: int, rows_per_grain: int = ROWS_PER_GRAIN
) -> DataFrame:
    """The last ``n`` rows of each key; rows without a key or a time are left out.

    A row's rank is the number of rows in newer grains and its place in its own.
    """
    seconds = bar_seconds * rows_per_grain
    after = Window.partitionBy(key).orderBy(F.col("_grain").desc()).rowsBetween(Window.unboundedPreceding, -1)
    wanted = (
        _grain_counts(in_a_series(df, key, time), key, time, seconds)
        .withColumn("_newer", F.coalesce(F.sum("_n").over(after), F.lit(0)))
        .filter(F.col("_newer") < n)
        .select(key, "_grain", "_newer")
    )
    placed = in_a_series(df, key, time).withColumn("_grain", grain_start(time, seconds)).join(wanted, [key, "_grain"])
    newest = Window.partitionBy(key, "_grain").orderBy(F.col(time).desc())
    rank = F.col("_newer") + F.row_number().over(newest)
    return placed.withColumn("_rank", rank).filter(F.col("_rank") <= n).select(*df.columns)


def with_pieces(
    df: DataFrame,
    key: str,
    time: str,
    rows: int | None = None,
    seconds: int = 1,
    order: Sequence[str] = (),
    stage: Callable[[DataFrame], DataFrame] = staged,
) -> DataFrame:
    """Add ``_piece``: consecutive pieces of about ``rows`` rows of each key, however dense.

    For rows without an interval that bounds them. Rows are counted per moment (a
    second), moments are added up to pieces, so a crowded hour falls into many pieces
    and a quiet year into one. The running count is taken within spans of an hour and
    over the spans, so that no task orders all the moments of a key. Rows without a
    key or a time are left out.

    ``order`` names columns that order the rows of one time. With it a moment of more than
    ``rows`` rows is cut as well, at sampled splitters of time and ``order``: such rows alone
    are dealt by range, and each range is a piece after what the key has before. Rows
    equal in time and ``order`` stay together. Where no moment is that crowded, nothing
    is dealt. The moments are kept by ``stage``, since whether there are crowded ones is asked first.
    """
    df = in_a_series(df, key, time)
    rows = rows or ROWS_PER_PIECE
    moments = df.groupBy(key, grain_start(time, seconds).alias("_moment")).agg(F.count(F.lit(1)).alias("_n"))
    moments = stage(moments) if order else moments
    moments = moments.withColumn("_span", grain_start("_moment", seconds * 3600))
    earlier_spans = Window.partitionBy(key).orderBy("_span").rowsBetween(Window.unboundedPreceding, -1)
    earlier_moments = Window.partitionBy(key, "_span").orderBy("_moment").rowsBetween(Window.unboundedPreceding, -1)
    spans = (
        moments.groupBy(key, "_span")
        .agg(F.sum("_n").alias("_rows"))
        .select(key, "_span", F.coalesce(F.sum("_rows").over(earlier_spans), F.lit(0)).alias("_before"))
    )
    places = (
        moments.withColumn("_inside", F.coalesce(F.sum("_n").over(earlier_moments), F.lit(0)))
        .join(spans, [key, "_span"])
        .select(key, "_moment", F.expr(f"(_before + _inside) div {rows}").alias("_piece"), (F.col("_n") > rows).alias("_crowded"))
    )
    placed = df.withColumn("_moment", grain_start(time, seconds)).join(places, [key, "_moment"]).drop("_moment")
    if not order:
        return placed.drop("_crowded")
    # a crowded moment ends every piece number it starts in, so the numbers between are free for its parts
    placed = placed.withColumn("_piece", F.col("_piece") * F.lit(PIECE_STEP))
    crowd = moments.filter(F.col("_n") > rows).agg(F.sum("_n").alias("n")).first().n
    if not crowd:
        return placed.drop("_crowded")
    dealt = placed.filter("_crowded").repartitionByRange(-(-crowd // rows), key, time, *order)
    dealt = dealt.withColumn("_piece", F.col("_piece") + 1 + F.spark_partition_id())
    return placed.filter(~F.col("_crowded")).unionByName(dealt).drop("_crowded")

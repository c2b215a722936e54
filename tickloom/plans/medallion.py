"""Bronze (CSV) to silver (Parquet) to gold (indicators by year)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F

from tickloom.functions.times import parse_time
from tickloom.operators.candles import only_symbols
from tickloom.operators.indicators import with_indicators
from tickloom.schemas import BAR_COLUMNS, Interval
from tickloom.sources.files import write_parquet, write_parquet_by_year


def silver(bronze: DataFrame, dropped: Sequence[str] = ("partition_0",)) -> DataFrame:
    """Bronze rows without crawler leftovers."""
    return bronze.drop(*dropped)


def bronze_to_silver(bronze: DataFrame, path: str, dropped: Sequence[str] = ("partition_0",)) -> None:
    write_parquet(silver(bronze, dropped), path)


def gold(table: DataFrame, symbols: Sequence[str] | None = None, size: str | Interval | None = "1D") -> DataFrame:
    """Silver bars plus the indicator set; rows without a readable time are left out."""
    bars = table.select(*BAR_COLUMNS, "year")
    if dict(bars.dtypes)["datetime"] == "string":
        bars = bars.withColumn("datetime", parse_time("datetime"))
    bars = bars.withColumn("datetime", F.col("datetime").cast("timestamp_ntz")).filter(F.col("datetime").isNotNull())
    return with_indicators(only_symbols(bars, symbols), size=size)


def silver_to_gold(
    spark: SparkSession, source: str, path: str, symbols: Sequence[str] | None = None, size: str | Interval | None = "1D"
) -> None:
    write_parquet_by_year(gold(spark.read.parquet(source), symbols, size), path)

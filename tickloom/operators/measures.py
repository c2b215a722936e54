"""Long-format measure records with versions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from tickloom.functions.times import now_millis
from tickloom.schemas import MEASURE


def measures_long(
    pairs: DataFrame,
    quote_source: str = "quotes",
    vwap_source: str = "vwap",
    version: Column | None = None,
) -> DataFrame:
    """One ``close`` and one ``vwap`` record per pair.

    ``version`` defaults to now in milliseconds; the vwap record's is one higher.
    """
    version = now_millis() if version is None else version
    start, end = F.col("window_start").cast("string"), F.col("window_end").cast("string")

    def record(name: str, source: str, bump: int, *extra: Column) -> Column:
        dimensions = F.create_map(
            F.lit("symbol"), F.col("symbol"),
            F.lit("source_topic"), F.lit(source),
            F.lit("window_start"), start,
            F.lit("window_end"), end,
            *extra,
        )
        return F.struct(
            dimensions.alias("dimensions"),
            F.lit(name).alias("measure_name"),
            F.col(name).cast("double").alias("measure_value"),
            F.col("window_end").cast("timestamp_ntz").alias("time"),
            (version + bump).alias("version"),
        )

    records = F.array(record("close", quote_source, 0, F.lit("event_ts"), end), record("vwap", vwap_source, 1))
    return pairs.select(F.explode(records).alias("r")).select("r.*")


def flat_dimensions(measures: DataFrame, names: Sequence[str]) -> DataFrame:
    """Dimensions as columns, for tables and joins."""
    rest = [c for c in measures.columns if c != "dimensions"]
    return measures.select(*(F.col("dimensions").getItem(n).alias(n) for n in names), *rest)


def latest_measures(measures: DataFrame) -> DataFrame:
    """Highest version per (dimensions, measure name, time).

    Many versions of one record combine map-side; two values under the same
    version resolve to the larger one, so reruns agree.
    """
    newest = F.max(F.struct("version", "measure_value"))
    return (
        measures.groupBy("dimensions", "measure_name", "time")
        .agg(newest.alias("m"))
        .select("dimensions", "measure_name", "m.measure_value", "time", "m.version")
        .select(*MEASURE.fieldNames())
    )

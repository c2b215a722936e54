"""Small helpers that several operators share."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F


ARROW_ROWS = "spark.sql.execution.arrow.maxRecordsPerBatch"
TEXTS_PER_BATCH = 500


def for_texts(spark: SparkSession) -> None:
    """Have this session hand whole texts to Python in batches of 500 rows at most.

    The default of 10,000 rows is meant for numbers; of texts with some kilobytes each, a
    batch that size takes several buffers of its tens of megabytes on both sides.
    """
    if not 0 < int(spark.conf.get(ARROW_ROWS)) <= TEXTS_PER_BATCH:
        spark.conf.set(ARROW_ROWS, str(TEXTS_PER_BATCH))


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    for_texts(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def fresh(df: DataFrame, *names: str) -> list[str]:
    """Column names like ``names`` that clash with no column of ``df``."""
    taken = {c.lower() for c in df.columns}
    out = []
    for name in names:
        while name.lower() in taken:
            name = f"_{name}"
        taken.add(name.lower())
        out.append(name)
    return out


def ascii_lower(text: Column | str) -> Column:
    """A-Z in lower case, every other character as it is."""
    return F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def quoted(name: str) -> Column:
    """The top-level column called ``name``, dots and all."""
    return F.col("`" + name.replace("`", "``") + "`")

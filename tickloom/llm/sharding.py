"""Proportional stratified interleaving of rows into shards that match the mixture."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from tickloom.llm.common import fresh, quoted
from tickloom.session import staged

ROWS_PER_BUCKET = 4_000


def interleave(
    rows: DataFrame,
    n_shards: int,
    *,
    source: str = "source",
    order: list[str],
    seed: int = 0,
    shard: str = "shard",
    slot: str = "slot",
    rows_per_bucket: int = ROWS_PER_BUCKET,
) -> DataFrame:
    """``rows`` with a ``shard`` (from 0) and a gapless ``slot`` in it (from 0).

    Rows of each source are put in a seeded order (a hash of the ``order`` columns,
    then those columns), the row of rank r among n gets the fractional rank
    (r + 0.5) / n, all rows are sorted by it, and the sorted rows are cut into
    ``n_shards`` runs. Shard sizes differ by one row at most, and each run holds of
    each source its share of all rows, give or take one row.

    No source meets in one task: the seeded hash is uniform, so equal ranges of it
    hold about ``rows_per_bucket`` rows whatever the source, and equal ranges of the
    fractional rank hold as many. Ranks are counted within a range and added to the
    sizes of the ranges before it; that table has one row per range (and source).

    NULL sources are a source of their own, NULLs in ``order`` are values like others,
    rows alike in all ``order`` columns stay neighbours in any order, an empty input
    gives an empty result. More shards than rows leave shards empty.
    """
    if n_shards < 1:
        raise ValueError("n_shards must be at least 1")
    group, key, bucket, rank, size, start, frac = fresh(rows, "_group", "_key", "_bucket", "_rank", "_n", "_start", "_f")
    total = rows.count()
    buckets = max(1, -(-total // rows_per_bucket))
    src = quoted(source).cast("string")
    keyed = rows.withColumn(group, F.when(src.isNull(), F.lit("-")).otherwise(F.concat(F.lit("+"), src)))
    keyed = keyed.withColumn(key, F.xxhash64(F.lit(seed), *[quoted(c) for c in order]))
    # the upper 32 bits of a uniform hash, as a range number
    keyed = keyed.withColumn(bucket, F.expr(f"shiftrightunsigned(`{key}`, 32) * {buckets}L div 4294967296L"))
    keyed = staged(keyed)

    ties = [quoted(c) for c in order]
    sizes = keyed.groupBy(group, bucket).agg(F.count("*").alias(size))
    before = Window.partitionBy(group).orderBy(bucket).rowsBetween(Window.unboundedPreceding, -1)
    sizes = sizes.select(
        group,
        bucket,
        F.coalesce(F.sum(size).over(before), F.lit(0)).alias(start),
        F.sum(size).over(Window.partitionBy(group)).alias(size),
    )
    within = Window.partitionBy(group, bucket).orderBy(key, *ties)
    ranked = keyed.withColumn(rank, F.row_number().over(within) - 1).join(sizes, [group, bucket])
    ranked = ranked.withColumn(frac, (F.col(start) + F.col(rank) + 0.5) / F.col(size))
    ranked = ranked.withColumn(bucket, F.floor(F.col(frac) * buckets)).drop(rank, start, size)

    sizes = ranked.groupBy(bucket).agg(F.count("*").alias(size))
    ahead = Window.orderBy(bucket).rowsBetween(Window.unboundedPreceding, -1)
    sizes = sizes.select(bucket, F.coalesce(F.sum(size).over(ahead), F.lit(0)).alias(start))
    within = Window.partitionBy(bucket).orderBy(frac, F.xxhash64(F.lit(seed), group), group, key, *ties)
    placed = ranked.withColumn(rank, F.row_number().over(within) - 1).join(sizes, bucket)
    at = F.col(start) + F.col(rank)
    placed = placed.withColumn(shard, F.floor(at * n_shards / F.lit(total)).cast("int"))
    # the division above is in doubles: step back or on where it crossed a border
    first = lambda s: F.expr(f"({s} * {total}L + {n_shards - 1}L) div {n_shards}L")
    number = F.col(shard)
    number = (
        F.when(at < first(f"cast(`{shard}` as bigint)"), number - 1)
        .when(at >= first(f"cast(`{shard}` + 1 as bigint)"), number + 1)
        .otherwise(number)
    )
    placed = placed.withColumn(shard, number)
    placed = placed.withColumn(slot, at - first(f"cast(`{shard}` as bigint)"))
    return placed.select(*[quoted(c) for c in rows.columns], shard, slot)

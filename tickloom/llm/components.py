"""Connected components of links, and bounded bitmaps of keys."""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.pandas.functions import ArrowUDFType

from tickloom.session import staged

BITS = 1 << 26  # of a bitmap: 8 MB, whatever it holds
CHUNKS = 64


def components(edges: DataFrame) -> DataFrame:
    """(node, root): the smallest node that each node of ``edges`` (a, b: long) reaches.

    Alternating large-star and small-star steps until nothing changes; every step is a
    minimum per node, combined before it moves, and a plain join on the node, so a hub
    with a third of all links is split like any hot key. Steps are written to the
    shared folder. Nodes without a link to another node are not in the result.
    """
    links = staged(edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct())
    before = None
    while True:
        mark = links.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if mark == before or not mark[0]:
            break
        before = mark
        both = links.unionAll(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        large = both.join(least, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(least, "a").where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
        links = staged(small.unionAll(least.select("a", F.col("m").alias("b"))).distinct())
    stars = links.select(F.col("a").alias("node"), F.col("b").alias("root"))
    return stars.unionAll(stars.select(F.col("root").alias("node"), "root").distinct())


def _slot(values: np.ndarray, size: int) -> np.ndarray:
    mixed = values.astype(np.int64).view(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    return (mixed >> np.uint64(64 - size.bit_length() + 1)).astype(np.int64)


def roomy(keys: int, most: int = BITS) -> int:
    """Bits of a bitmap with 32 or more for each key, as far as ``most`` allows."""
    return min(most, 1 << max(16, (32 * keys).bit_length()))


def bitmap(keys: DataFrame, size: int = BITS) -> np.ndarray:
    """A bitmap of ``size`` bits (a power of two from 2**9 on) with one set for each value of the only column of ``keys``: a long, or the first eight of its bytes."""
    width = size // 8 // CHUNKS

    def mark(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = np.zeros(size, bool)
        for batch in batches:
            column = batch.column(0).drop_null()
            if pa.types.is_integer(column.type):
                values = column.to_numpy(zero_copy_only=False)
            else:
                values = np.frombuffer(b"".join(v.as_py()[:8] for v in column), np.int64)
            bits[_slot(values, size)] = True
        packed = np.packbits(bits).reshape(CHUNKS, width)
        some = np.flatnonzero(packed.any(axis=1))
        yield pa.RecordBatch.from_arrays([pa.array(some, pa.int64()), pa.array([zlib.compress(packed[i].tobytes(), 1) for i in some], pa.binary())], names=["chunk", "bits"])

    def merge(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        out = np.zeros(width, np.uint8)
        for part in rows["bits"]:
            out |= np.frombuffer(zlib.decompress(part), np.uint8)
        return pd.DataFrame({"chunk": [key[0]], "bits": [zlib.compress(out.tobytes(), 1)]})

    chunks = keys.mapInArrow(mark, "chunk long, bits binary").groupBy("chunk").applyInPandas(merge, "chunk long, bits binary")
    out = np.zeros((CHUNKS, width), np.uint8)
    for row in chunks.collect():
        out[row.chunk] = np.frombuffer(zlib.decompress(row.bits), np.uint8)
    return out.reshape(-1)


def maybe_in(values: np.ndarray, bits: np.ndarray) -> np.ndarray:
    """False where a value is surely not in the bitmap."""
    slot = _slot(values, 8 * len(bits))
    return (bits[slot >> 3] >> (7 - (slot & 7)).astype(np.uint8)) & 1 == 1


def maybe(key: Column, docs: DataFrame, bits: np.ndarray) -> Column:
    """False where ``key`` (long) is surely not in the bitmap; True for NULL."""
    held = docs.sparkSession.sparkContext.broadcast(bits)

    def test(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            found = maybe_in(batch.fill_null(0).to_numpy(zero_copy_only=False), held.value)
            yield pa.array(found | batch.is_null().to_numpy(zero_copy_only=False))

    return F.arrow_udf(test, "boolean", ArrowUDFType.SCALAR_ITER)(key)

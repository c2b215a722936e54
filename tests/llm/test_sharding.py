"""Interleaving against a plain sort by fractional rank."""

from collections import Counter

import pytest
from pyspark.sql import functions as F

from tickloom.llm import sharding
from tickloom.llm.queries import op9_interleave


def check(rows, n):
    sizes = Counter(r.shard for r in rows)
    total = len(rows)
    assert all(0 <= r.shard < n for r in rows)
    assert max(sizes.values(), default=0) - min((sizes.get(i, 0) for i in range(n)), default=0) <= 1
    assert sum(sizes.values()) == total
    for shard in sizes:
        assert sorted(r.slot for r in rows if r.shard == shard) == list(range(sizes[shard]))


@pytest.mark.parametrize(("rows_per_bucket", "n"), [(10, 7), (50, 16), (10_000, 1), (10_000, 500)])
def test_matches_a_plain_sort(spark, rows_per_bucket, n):
    df = spark.range(400).select(
        "id", F.when(F.col("id") % 3 == 0, "hot").when(F.col("id") % 50 == 1, None).otherwise(F.concat(F.lit("s"), F.col("id") % 9)).alias("source")
    )
    hashed = {r.id: r.h for r in df.select("id", F.xxhash64(F.lit(3), "id").alias("h")).collect()}
    groups = {r.g: r.h for r in df.select(F.coalesce(F.concat(F.lit("+"), "source"), F.lit("-")).alias("g")).distinct().select("g", F.xxhash64(F.lit(3), "g").alias("h")).collect()}
    rows = sharding.interleave(df, n, order=["id"], seed=3, rows_per_bucket=rows_per_bucket).collect()
    check(rows, n)
    by_source = {}
    for r in rows:
        by_source.setdefault("-" if r.source is None else "+" + r.source, []).append(r.id)
    order = []
    for g, ids in by_source.items():
        # ranges of the hash's upper half first, as the operator cuts them
        ids.sort(key=lambda i: (((hashed[i] % (1 << 64)) >> 32) * -(-400 // rows_per_bucket) >> 32, hashed[i]))
        order += [((k + 0.5) / len(ids), groups[g], g, hashed[i], i) for k, i in enumerate(ids)]
    order.sort()
    first = [-(-s * 400 // n) for s in range(n + 1)]
    place = {i: at for at, (*_, i) in enumerate(order)}
    assert all(first[r.shard] + r.slot == place[r.id] for r in rows)


def test_every_shard_has_the_mixture(spark):
    sf = "/root/testdata/sf0.01"
    rows = op9_interleave(spark, sf).collect()
    check(rows, 16)
    docs = {r.doc_id: r for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    import zlib

    assert sorted(r.doc_id for r in rows) == sorted(docs)
    whole = Counter(d.source for d in docs.values())
    mixed = Counter((r.shard, docs[r.doc_id].source) for r in rows)
    for shard in range(16):
        for source, n in whole.items():
            assert abs(mixed[shard, source] - n / 16) <= 1.5
    for r in rows:
        body = docs[r.doc_id].text.encode()
        assert (r.size, r.text_crc32, r.law, r.grown_shard) == (len(body) + 1, zlib.crc32(body), "rows", None)


def test_edges(spark):
    df = spark.createDataFrame([(1, None, "a")] * 5 + [(None, "s", "b")] * 3, "id long, source string, _bucket string")
    rows = sharding.interleave(df, 3, order=["id"]).collect()
    check(rows, 3)
    assert sorted(str(r.id) for r in rows) == ["1"] * 5 + ["None"] * 3 and rows[0].__fields__ == ["id", "source", "_bucket", "shard", "slot"]
    assert sharding.interleave(df.limit(0), 3, order=["id"]).count() == 0
    with pytest.raises(ValueError):
        sharding.interleave(df, 0, order=["id"])

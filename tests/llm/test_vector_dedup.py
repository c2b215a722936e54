"""Linked vectors against all pairs."""

import numpy as np
import pytest

from tickloom.llm import vector_dedup


def brute(rows, least=0.9):
    n = len(rows)
    units = []
    for _, v in rows:
        ok = v and all(x is not None and np.isfinite(x) for x in v) and any(v)
        x = np.array(v, float) / np.abs(np.array(v, float)).max() if ok else None
        units.append(x / np.sqrt(x @ x) if ok else None)
    root, links = list(range(n)), [0] * n

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a in range(n):
        for b in range(a + 1, n):
            if units[a] is not None and units[b] is not None and len(units[a]) == len(units[b]) and units[a] @ units[b] >= least:
                links[a] += 1
                links[b] += 1
                root[find(a)] = find(b)
    small = {}
    for i, (key, _) in enumerate(rows):
        if key is not None:
            small[find(i)] = min(small.get(find(i), key), key)
    return sorted(((k, links[i], small.get(find(i)), k == small.get(find(i))) for i, (k, _) in enumerate(rows)), key=str)


def result(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def near(rng, base, cosine):
    off = rng.normal(size=len(base))
    off -= base * (off @ base)
    off /= np.linalg.norm(off)
    return cosine * base + np.sqrt(1 - cosine**2) * off


@pytest.fixture(scope="module")
def rows():
    rng = np.random.default_rng(2)
    out = [rng.normal(size=64) for _ in range(250)]
    hub = out[0] / np.linalg.norm(out[0])
    out += [near(rng, hub, c) * rng.uniform(0.1, 10) for c in rng.uniform(0.96, 1, 150)]  # a third: one hot group
    for v in out[1:60]:
        out.append(near(rng, v / np.linalg.norm(v), rng.choice([0.85, 0.895, 0.905, 0.92, 0.95])))
    out += [out[5].copy() for _ in range(40)]
    chain = out[7] / np.linalg.norm(out[7])
    for _ in range(6):
        chain = near(rng, chain, 0.93)
        out.append(chain)
    return [(i * 3 % 1009, [float(x) for x in v]) for i, v in enumerate(out)]


def test_equals_all_pairs(spark, rows):
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got, want = result(vector_dedup.link_vectors(df)), brute(rows)
    found, there = sum(r[1] for r in got), sum(r[1] for r in want)
    assert found <= there and found >= 0.99 * there
    assert [r[0] for r in got] == [r[0] for r in want]
    assert np.mean([a == b for a, b in zip(got, want, strict=True)]) > 0.98


def test_small_tiles_find_the_same(spark, rows, monkeypatch):
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    whole = result(vector_dedup.link_vectors(df))
    monkeypatch.setattr(vector_dedup, "BUCKET_TILE", 16)
    monkeypatch.setattr(vector_dedup, "VECTOR_TILE", 16)
    assert result(vector_dedup.link_vectors(df)) == whole


def test_edges(spark):
    bad = [None, [], [0.0, 0.0], [float("nan"), 1.0], [float("inf"), 1.0], [None, 1.0]]
    rows = [(i, v) for i, v in enumerate(bad)] + [
        (20, [1.0, 0.0]), (21, [1e-300, 0.0]), (22, [1e300, 1e299]), (23, [1.0, 0.0, 0.0]), (23, [1.0, 0.0]), (None, [1.0, 0.0]), (24, [-1.0, 0.0]),
    ]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").selectExpr("*", "1 AS node", "2 AS root")
    assert result(vector_dedup.link_vectors(df)) == brute([(k, v) for k, v in rows])
    assert vector_dedup.link_vectors(df.limit(0)).count() == 0


def test_query(spark):
    from tickloom.llm.queries import op1_near_vectors

    sf = "/root/testdata/sf0.01"
    rows = [(r.vec_id, r.embedding) for r in spark.read.parquet(f"{sf}/embeddings.parquet").collect()]
    assert result(op1_near_vectors(spark, sf)) == brute(rows)


def test_blocks():
    for n in (10, 10_000, 10**6, 10**9):
        widths = vector_dedup.blocks_for(n)
        assert sum(widths) == 64 and len(widths) * (vector_dedup.RADIUS // len(widths) + 1) > vector_dedup.RADIUS


def test_only_what_links_is_grouped(spark, monkeypatch):
    """Vectors with a cosine of 0.8, whose codes are near, are not joined before they are compared."""
    rng = np.random.default_rng(6)
    chain = [rng.normal(size=64)]
    for _ in range(150):
        chain.append(near(rng, chain[-1] / np.linalg.norm(chain[-1]), 0.8))
    rows = [(i, [float(x) for x in v]) for i, v in enumerate(chain)] + [(200, [float(2 * x) for x in near(rng, chain[9], 0.95)])]
    joined = []
    monkeypatch.setattr(vector_dedup, "components", lambda edges, own=vector_dedup.components: joined.append(edges.count()) or own(edges))
    got = result(vector_dedup.link_vectors(spark.createDataFrame(rows, "vec_id long, embedding array<double>")))
    assert got == brute(rows)
    assert joined == [1, 1]


def test_many_buckets_find_the_same(spark, rows, monkeypatch):
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    whole = result(vector_dedup.link_vectors(df))
    monkeypatch.setattr(vector_dedup, "FEW", 0)
    monkeypatch.setattr(vector_dedup, "SAMPLE", 100)
    got = result(vector_dedup.link_vectors(df))
    assert [r[0] for r in got] == [r[0] for r in whole]
    assert np.mean([a == b for a, b in zip(got, whole, strict=True)]) > 0.99


def test_linked_vectors_share_a_bucket():
    rng = np.random.default_rng(8)
    a = vector_dedup.unit(rng.normal(size=(2000, 64)))
    b = vector_dedup.unit(np.array([near(rng, v, 0.9) for v in a]))
    model = np.zeros(64), vector_dedup.itq(a, 64, 7)
    for n in (50_000, 1_000_000):
        table = vector_dedup.words(vector_dedup.buckets_for(n), 7)
        found = [vector_dedup.probes(x, model, table) for x in (a, b)]
        scores = (a[:50] @ model[1]) @ table.T
        assert (np.sort(found[0][:50], axis=1) == np.sort(np.argsort(-scores, axis=1)[:, : vector_dedup.PROBES], axis=1)).all()
        assert (found[0][:, :, None] == found[1][:, None, :]).any(axis=(1, 2)).mean() > 0.995
        apart = found[0][:, :, None] == np.roll(found[0], 1, axis=0)[:, None, :]
        assert apart.any(axis=(1, 2)).mean() < 1500 / len(table)


@pytest.mark.parametrize("dim", [1, 2, 64, 300])
def test_copies_and_single_precision_lose_no_link(dim):
    rng = np.random.default_rng(dim)
    x = vector_dedup.unit(rng.normal(size=(700, dim)) * rng.pareto(1, size=(700, dim)))
    x[300:] = vector_dedup.unit(x[:400] + rng.normal(size=(400, dim)) * 0.3 / np.sqrt(dim))
    least = float(np.sort((x @ x.T)[np.triu_indices(700, 1)])[-301:-299].mean())  # close to that of two pairs
    want = x @ x.T >= least
    assert (vector_dedup._exactly(least)(x, x.copy()) == want).all()
    copies = np.rint(x * (127 / np.abs(x).max(axis=1, keepdims=True))).astype(np.float32)
    bound = vector_dedup._loosened(least, copies)
    copies /= np.linalg.norm(copies, axis=1, keepdims=True)
    assert (copies @ copies.T)[want].min() >= bound
    edges = [(int(p), int(q)) for u, v in vector_dedup._forest(vector_dedup._hits(x, None, vector_dedup._exactly(least)), 700) for p, q in zip(u, v, strict=True)]
    assert all(want[e] for e in edges)
    reach = want | np.eye(700, dtype=bool)
    for _ in range(10):
        reach = reach.astype(np.float32) @ reach.astype(np.float32) > 0
    assert len(edges) == 700 - len(np.unique(reach.argmax(axis=1)))

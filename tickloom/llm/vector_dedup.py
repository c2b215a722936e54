"""Near-duplicate vectors by iterative quantisation and Hamming tables.

A rotation of the vectors' principal axes is learned so that the signs of the rotated
coordinates lose least (iterative quantisation); the centre is the median,
kept short, so the signs are balanced while angles hardly change, even within a crowd.
The buckets of the table are random words of 64 bits of random weight, some ``WORDS`` times
the square root of the number of vectors. A vector goes to the ``PROBES`` words it agrees with
best, every bit counted by its weight and by how far the coordinate is from its other sign.

A bucket's vectors are compared right there, by eight-bit copies and a bound that no
rounding can push a link below, so only what (almost) links is joined into groups; only a
spanning forest of them is written, never all pairs. Inside a group the original vectors
are compared, in double precision wherever that could matter, tile by tile; links are counted
in the tile and again only a spanning forest leaves it.

Buckets and groups larger than a tile are dealt out as pairs of tiles. Copies of one
vector are one node with a multiplicity.
"""

from __future__ import annotations

from collections.abc import Iterator
from math import comb, isqrt

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, functions as F

from tickloom.llm.common import quoted
from tickloom.llm.components import bitmap, components, maybe, roomy
from tickloom.session import staged

SAMPLE = 16_384  # vectors that the rotation is learned from, at most
ITERATIONS = 40
SHIFT = 0.25  # the centre's length at most, so that no crowd of unit vectors lies at the centre
RADIUS = 15  # of 64 bits, what ``blocks_for`` guarantees
FEW = 4096  # vectors up to which there is a single bucket
WORDS, PROBES = 6, 12  # buckets for the square root of the number of vectors; those a vector goes to
BUCKET_TILE, VECTOR_TILE = 32_768, 8192
ROWS_PER_PART = 40_000
BLOCK = 512  # rows compared at once
UPPER = np.triu(np.ones((BLOCK, BLOCK), bool), 1)


def itq(sample: np.ndarray, bits: int, seed: int) -> np.ndarray:
    """(dimension x bits) projection whose signs are the code; more bits than dimensions repeat with other rotations."""
    rng = np.random.default_rng(seed)
    n, dim = sample.shape
    _, _, axes = np.linalg.svd(sample.T @ sample / max(n, 1) + 1e-12 * np.eye(dim))
    out = []
    while sum(p.shape[1] for p in out) < bits:
        width = min(dim, bits - sum(p.shape[1] for p in out))
        basis = axes[:width].T if width < dim else axes.T
        flat = sample @ basis
        turn = np.linalg.qr(rng.normal(size=(width, width)))[0]
        for _ in range(ITERATIONS if n else 0):
            signs = np.where(flat @ turn >= 0, 1.0, -1.0)
            u, _, v = np.linalg.svd(signs.T @ flat)
            turn = (u @ v).T
        out.append(basis @ turn)
    return np.hstack(out)


def unit(rows: np.ndarray) -> np.ndarray:
    """Rows scaled to length 1, by their largest component first so that no square over- or underflows."""
    rows = rows / np.abs(rows).max(axis=1, keepdims=True)
    return rows / np.sqrt((rows * rows).sum(axis=1, keepdims=True))


def fit(vectors: DataFrame, seed: int, n: int) -> dict[int, tuple[np.ndarray, np.ndarray]]:
    """dimension -> (centre, projection to 64 bits), learned from at most ``SAMPLE`` of the ``n`` vectors by hash order."""
    order = F.xxhash64("e")
    rows = []
    if n > 4 * SAMPLE:  # those with the least hashes, without bringing so many of every task together
        least = -(2**63) + 2**64 * 2 * SAMPLE // n
        rows = vectors.where(order < F.lit(least)).select("e").orderBy(order).limit(SAMPLE).toArrow().column(0).to_pylist()
    if len(rows) < SAMPLE:
        rows = vectors.select("e").orderBy(order).limit(SAMPLE).toArrow().column(0).to_pylist()
    by_dim: dict[int, list] = {}
    for row in rows:
        by_dim.setdefault(len(row), []).append(row)
    out = {}
    for dim, own in by_dim.items():
        sample = unit(np.array(own, np.float64))
        centre = np.median(sample, axis=0)
        centre *= min(1.0, SHIFT / max(np.linalg.norm(centre), 1e-12))
        out[dim] = centre, itq(sample - centre, 64, seed)
    return out


def blocks_for(n: int) -> list[int]:
    """Widths of the blocks of a 64-bit code: the number of blocks that costs ``n`` vectors least."""

    def cost(m: int) -> float:
        width = 64 / m
        entries = m * sum(comb(round(width), i) for i in range(RADIUS // m + 1)) / 2
        return entries * (1 + 0.004 * n / 2**width)

    m = min((8, 6, 5, 4), key=cost)
    return [64 // m + (i < 64 % m) for i in range(m)]


def buckets_for(n: int) -> int:
    """The number of buckets for ``n`` vectors: finding a vector's buckets then costs about as much as comparing in them."""
    return 1 if n <= FEW else 32 * max(PROBES, -(-WORDS * isqrt(n) // 32))


def words(count: int, seed: int) -> np.ndarray:
    """(count x 64) words: signs times weights, all of one length."""
    out = np.random.default_rng(seed).normal(size=(count, 64))
    return (out / np.linalg.norm(out, axis=1, keepdims=True)).astype(np.float32)


def probes(rows: np.ndarray, model: tuple | None, table: np.ndarray) -> np.ndarray:
    """For every row (of length 1) the ``PROBES`` words of ``table`` that it agrees with best, or all if there are fewer."""
    if len(table) <= PROBES:
        return np.tile(np.arange(len(table)), (len(rows), 1))
    dim = rows.shape[1]
    centre, turn = model or (0.0, np.random.default_rng(dim).normal(size=(dim, 64)))
    score = ((rows - centre) @ turn).astype(np.float32) @ table.T
    step = len(table) // 32
    runs = score.reshape(len(rows), 32, step)  # every ``step``-th word is a run; the best words lie in the runs with the best maxima
    some = np.argpartition(-runs.max(axis=1), PROBES - 1, axis=1)[:, :PROBES]
    best = np.take_along_axis(runs, some[:, None, :], axis=2).reshape(len(rows), -1)
    at = np.argpartition(-best, PROBES - 1, axis=1)[:, :PROBES]
    return at // PROBES * step + np.take_along_axis(some, at % PROBES, axis=1)


def _prints(model: dict, count: int, seed: int):
    """An eight-bit copy of every vector, and its buckets: numbers of words above the dimension."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = words(count, seed)
        for batch in batches:
            for lo in range(0, batch.num_rows, 256):
                part = batch.slice(lo, 256)
                sizes = pc.list_value_length(part.column(1)).to_numpy(zero_copy_only=False)
                for dim in np.unique(sizes).tolist():
                    at = np.flatnonzero(sizes == dim)
                    flat = part.column(1).take(pa.array(at)).flatten().to_numpy(zero_copy_only=False)
                    rows = unit(flat.astype(np.float64).reshape(-1, dim))
                    where = (probes(rows, model.get(dim), table).astype(np.int64) << 32) + dim
                    copy = np.rint(rows * (127 / np.abs(rows).max(axis=1, keepdims=True))).astype(np.int8)
                    yield pa.RecordBatch.from_arrays(
                        [part.column(0).take(pa.array(at)), pa.array([c.tobytes() for c in copy], pa.binary()), pa.array(list(where), pa.list_(pa.int64()))],
                        names=["node", "copy", "buckets"],
                    )

    return run


def _tiled(rows: DataFrame, group: str, key: str, tile: int, per_part: int) -> DataFrame:
    """``rows`` once for each pair of tiles (i <= j) of their group that they belong to, with a ``part`` to work in.

    Groups of up to ``tile`` rows are one tile. Sizes are counted first; larger groups are few,
    a row for every ``tile`` of ``rows`` at most. A part holds many
    small groups or a few tiles of a large one.
    """
    sizes = rows.groupBy(group).agg(F.count("*").alias("_m"))
    total = rows.count()
    large = [(r[group], -(-r["_m"] // tile)) for r in sizes.where(F.col("_m") > tile).collect()]
    if large:
        total += sum(tile * k * (k - 1) for _, k in large)
        tiles = rows.sparkSession.createDataFrame(large, f"{group} long, _k int")
        wide = rows.join(tiles, group, "left").withColumn("_k", F.coalesce("_k", F.lit(1)))
        own = F.pmod(F.xxhash64(key), F.col("_k")).cast("int")
        wide = wide.withColumn("own", own).withColumn("other", F.explode(F.sequence(F.lit(0), F.col("_k") - 1)))
        wide = wide.withColumn("i", F.least("own", "other")).withColumn("j", F.greatest("own", "other")).drop("_k", "other")
    else:
        wide = rows.select("*", *(F.lit(0).alias(c) for c in ("own", "i", "j")))
    return wide.withColumn("part", F.pmod(F.xxhash64(group, "i", "j"), F.lit(-(-total // per_part) or 1)))


def _runs(rows: pd.DataFrame, by: list[str]) -> Iterator[np.ndarray]:
    order = np.lexsort([rows[c].to_numpy() for c in reversed(by)])
    if len(order):
        keys = rows[by].to_numpy()[order]
        cut = np.flatnonzero((keys[1:] != keys[:-1]).any(axis=1)) + 1
        yield from np.split(order, cut)


def _hits(left: np.ndarray, right: np.ndarray | None, test) -> Iterator[tuple[int, int, np.ndarray]]:
    """(first row, first column, links) of blocks of ``left`` x ``right``; without ``right``, of ``left`` with itself, each pair once."""
    alone, right = right is None, left.copy() if right is None else right  # a product with itself is the slower one
    for lo in range(0, len(left), BLOCK):
        if not alone:
            yield lo, 0, test(left[lo : lo + BLOCK], right)
        else:
            hit = test(left[lo : lo + BLOCK], right[lo:])
            own = hit[:, :BLOCK]
            own &= UPPER[: own.shape[0], : own.shape[1]]
            yield lo, lo, hit


def _forest(hits: Iterator[tuple[int, int, np.ndarray]], n: int, across: int = 0) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(rows, others): a spanning forest of the links on 0..n-1; columns count from ``across``."""
    label = np.arange(n)
    for lo, first, hit in hits:
        for u in np.flatnonzero(hit.any(axis=1)).tolist():
            to = np.flatnonzero(hit[u]) + first + across
            of = label[to]
            own = label[lo + u]
            new, at = np.unique(of[of != own], return_index=True)
            if len(new):
                yield np.full(len(new), lo + u), to[of != own][at]
                label[np.isin(label, new)] = own


def _halves(own: np.ndarray, i: int, j: int) -> tuple[np.ndarray, np.ndarray | None]:
    """Positions of the rows of the two tiles of a pair; of one tile alone, all and None."""
    return (np.arange(len(own)), None) if i == j else (np.flatnonzero(own == i), np.flatnonzero(own == j))


def _loosened(least: float, copies: np.ndarray) -> float:
    """The cosine of two eight-bit copies from which on their vectors may have a cosine of ``least``."""
    half = np.sqrt(copies.shape[1]) / 2  # length of what rounding took away, at most
    off = np.arcsin(np.minimum(1.0, half / np.maximum(np.linalg.norm(copies, axis=1) - half, half)))
    return float(np.cos(min(np.pi, np.arccos(np.clip(least, -1.0, 1.0)) + 2 * off.max()))) - 1e-4


def _candidates(least: float):
    """A spanning forest of what may link, by eight-bit copies, in every tile pair of a part."""

    def run(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        node, copy, bucket = rows["node"].to_numpy(), rows["copy"].to_numpy(), rows["bucket"].to_numpy()
        own, i, j = rows["own"].to_numpy(), rows["i"].to_numpy(), rows["j"].to_numpy()
        out = [np.zeros((0, 2), np.int64)]
        for at in _runs(rows, ["bucket", "i", "j"]):
            a, b = _halves(own[at], i[at[0]], j[at[0]])
            if len(at) < 2 or b is not None and not (len(a) and len(b)):
                continue
            x = np.frombuffer(b"".join(copy[at]), np.int8).reshape(len(at), bucket[at[0]] & 0xFFFFFFFF).astype(np.float32)
            from_ = _loosened(least, x)
            x /= np.linalg.norm(x, axis=1, keepdims=True)
            ids = node[at] if b is None else node[at][np.concatenate([a, b])]
            hits = _hits(x[a], None if b is None else x[b], lambda u, v, from_=from_: u @ v.T >= from_)
            out.extend(np.stack([ids[u], ids[v]], axis=1) for u, v in _forest(hits, len(ids), 0 if b is None else len(a)))
        return pd.DataFrame(np.concatenate(out), columns=["a", "b"])

    return run


def _exactly(least: float):
    """Which rows of two blocks have a cosine of ``least``: in single precision, and again in double where that leaves doubt."""

    def test(left: np.ndarray, right: np.ndarray) -> np.ndarray:
        rough = left.astype(np.float32) @ right.astype(np.float32).T
        doubt = 2e-7 * (left.shape[1] + 8)
        hit = rough >= least
        u, v = np.nonzero(np.abs(rough - least) < doubt)
        if 0 < len(u) <= 4096:
            hit[u, v] = np.einsum("ij,ij->i", left[u], right[v]) >= least
        elif len(u):
            hit = left @ right.T >= least
        return hit

    return test


def _linked(least: float):
    """Per tile pair: how many vectors each one links with, and a spanning forest of the links."""

    def run(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        node, many, own = rows["node"].to_numpy(), rows["many"].to_numpy(), rows["own"].to_numpy()
        i, j = rows["i"].to_numpy(), rows["j"].to_numpy()
        out = [np.zeros((0, 3), np.int64)]
        for at in _runs(rows, ["root", "i", "j"]):
            vectors = rows["e"].iloc[at].tolist()
            sizes = np.array([len(v) for v in vectors])
            for dim in np.unique(sizes):
                mine = at[sizes == dim]
                x = unit(np.array([v for v in vectors if len(v) == dim], np.float64))
                a, b = _halves(own[mine], i[at[0]], j[at[0]])
                if b is not None and not (len(a) and len(b)):
                    continue
                take, across = (a, 0) if b is None else (np.concatenate([a, b]), len(a))
                ids, times = node[mine][take], many[mine][take]
                counts = np.zeros(len(take), np.int64)

                def counted(hits, counts=counts, times=times, across=across):
                    for lo, first, hit in hits:
                        row, col = slice(lo, lo + hit.shape[0]), slice(first + across, first + across + hit.shape[1])
                        if hit.any():
                            counts[row] += hit @ times[col]
                            counts[col] += times[row] @ hit
                        yield lo, first, hit

                hits = counted(_hits(x[a], None if b is None else x[b], _exactly(least)))
                out.extend(np.stack([ids[u], ids[v], np.zeros(len(u), np.int64)], axis=1) for u, v in _forest(hits, len(take), across))
                some = np.flatnonzero(counts)
                out.append(np.stack([ids[some], np.full(len(some), -1), counts[some]], axis=1))
        return pd.DataFrame(np.concatenate(out), columns=["a", "b", "n"])

    return run


def link_vectors(vectors: DataFrame, *, key: str = "vec_id", vector: str = "embedding", least: float = 0.9, seed: int = 7) -> DataFrame:
    """One row per row of ``vectors``: vec_id, n_links, component_id, kept.

    Two rows link when the cosine of their vectors is at least ``least``. Vectors that are
    NULL, empty, zero, or hold a NULL or a number that is not finite link with nothing, and so do
    vectors of different dimensions with each other. Ids may repeat or be NULL: each
    row is a vector; component_id is the least id in its component that is not NULL.
    Every row is indexed; only the rotation is learned from a sample.
    """
    e = quoted(vector)
    fine = e.isNotNull() & (F.size(e) > 0) & F.forall(e, lambda v: F.abs(v) < float("inf"))  # NaN is more, NULL is not known
    fine = F.coalesce(fine & F.exists(e, lambda v: v != 0), F.lit(False))
    base = vectors.select(quoted(key).cast("long").alias("vec_id"), F.when(fine, e).alias("e"))
    base = base.select("*", F.xxhash64("e").alias("k0"), F.xxhash64(F.lit(1), "e").alias("k1"), F.monotonically_increasing_id().alias("row"))
    base = staged(base)
    there = base.where("e is not null")
    same = staged(there.groupBy("k0", "k1").agg(F.min("row").alias("node"), F.count("*").alias("many")))
    repeats = same.where("many > 1")
    n, copied = same.agg(F.count("*"), F.count_if(F.col("many") > 1)).first()
    nodes = there.select(F.col("row").alias("node"), "e", "k0")
    if copied:  # only first rows of vectors that may come again move
        bits = bitmap(repeats.select("k0"), roomy(copied))
        first = staged(same.where(maybe(F.col("k0"), same, bits)).select("node", "many"))
        again, chosen = maybe(F.col("k0"), base, bits), maybe(F.col("node"), base, bitmap(first.select("node"), roomy(first.count())))
        among = nodes.where(again & chosen).join(first, "node").select("node", "e", "many")
        nodes = nodes.where(~again).select("node", "e", F.lit(1).cast("long").alias("many")).unionAll(among)
    else:
        nodes = nodes.select("node", "e", F.lit(1).cast("long").alias("many"))

    prints = nodes.select("node", "e").mapInArrow(_prints(fit(nodes, seed, n), buckets_for(n), seed), "node long, copy binary, buckets array<long>")
    entries = staged(prints).select("node", "copy", F.explode("buckets").alias("bucket"))
    tiled = _tiled(entries, "bucket", "node", BUCKET_TILE, ROWS_PER_PART)
    groups = staged(components(tiled.groupBy("part").applyInPandas(_candidates(least), "a long, b long")))

    near = maybe(F.col("node"), nodes, bitmap(groups.select("node"), roomy(groups.count())))
    members = staged(nodes.where(near).join(groups, "node"))
    tiled = _tiled(members, "root", "node", VECTOR_TILE, ROWS_PER_PART // 8)
    found = staged(tiled.groupBy("part").applyInPandas(_linked(least), "a long, b long, n long"))
    roots = components(found.where("b >= 0").select("a", "b"))
    counts = found.where("b < 0").groupBy(F.col("a").alias("node")).agg(F.sum("n").alias("others"))

    placed = base.select("vec_id", "k0", "k1", "row", F.col("e").isNotNull().alias("fine")).join(repeats.withColumn("fine", F.lit(True)), ["k0", "k1", "fine"], "left")
    placed = placed.withColumn("node", F.coalesce("node", F.when(F.col("fine"), F.col("row"))))
    placed = placed.join(roots, "node", "left").join(counts, "node", "left")
    links = F.coalesce(F.col("others"), F.lit(0)) + F.coalesce(F.col("many") - 1, F.lit(0))
    placed = staged(placed.select("vec_id", links.cast("long").alias("n_links"), F.coalesce("root", "node", "row").alias("root")))
    least_id = placed.groupBy("root").agg(F.min("vec_id").alias("component_id"))
    out = placed.join(least_id, "root").select("vec_id", "n_links", "component_id")
    return out.withColumn("kept", F.col("vec_id").eqNullSafe(F.col("component_id")))

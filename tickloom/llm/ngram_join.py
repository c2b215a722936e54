"""Exact n-gram Jaccard join with adaptive multi-match prefixes.

Every text becomes the set of hashes of its distinct word shingles; texts with equal
sets are one node. Shingles have a global order: first those whose estimated number of
documents is low, by a sketch of counts over all documents, then by hash. Two sets of
n and m shingles can only be similar if they share at least l shingles among the first
n - ceil(t n) + l and m - ceil(t m) + l of them, for any l. Each document picks its own l where
the estimated cost of longer postings and of the candidates that remain is least, and
a pair must share as many prefix shingles as the smaller of its two l demands.

Candidates are found in rounds. In the first ones each node is compared with one head of
each of its postings, at first the node that meets most others (an original rather
than its edited copies), then nodes drawn at random; what they link falls into
components. Nodes that share most with the same head form a cluster, where those outside
the largest component are compared with all others in tiles. The last round compares
the pairs of a posting that are in different components and clusters, of sizes near each
other, and not already kept apart by the prefix shingles that their own components
alone hold: documents that share a passage and little else. Pairs of a long posting are
compared in tiles too. So no link between
components is missed, while a large group of near copies costs a few comparisons per
member and no written pairs. Every candidate is verified on the whole sets.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F
from pyspark.sql.pandas.functions import ArrowUDFType

from tickloom.llm.common import fresh, quoted
from tickloom.llm.components import bitmap, components, maybe, maybe_in, roomy
from tickloom.session import staged

WORDS = 5
PERCENT = 80
SKETCH = 1 << 22  # counters of the document-count sketch
SKETCH_CHUNKS = 64
HEAD_ROUNDS = 2
TILE = 512  # nodes of a tile
SHORT = 32  # entries of a posting whose pairs are joined; longer ones are compared in tiles
VERIFY_COST, UNSEEN = 20.0, 0.2  # of a candidate against a posting entry; expected partners of a rare shingle

_M = (1 << 64) - 1
_P = 0x9E3779B97F4A7C15 | 1
_LOWER = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))
_SPACE = np.isin(np.arange(256), [9, 10, 11, 12, 13, 32])


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class Shingler:
    """Sorted distinct shingle hashes of texts, whole texts at a time in vectors."""

    def __init__(self, size: int = WORDS):
        self.size = size
        self._grow(1 << 16)

    def _grow(self, n: int) -> None:
        self.powers = np.cumprod(np.full(n, _P, np.uint64))
        self.inverse = np.cumprod(np.full(n, pow(_P, -1, 1 << 64), np.uint64))

    def __call__(self, text: str | None) -> np.ndarray:
        data = np.frombuffer((text or "").encode("utf-8", "surrogatepass").translate(_LOWER), np.uint8)
        n = len(data)
        if n > len(self.powers):
            self._grow(2 * n)
        inside = np.zeros(n + 2, bool)
        inside[1:-1] = ~_SPACE[data]
        border = np.flatnonzero(inside[1:] != inside[:-1])
        start, stop = border[::2], border[1::2]
        if not len(start):
            return np.zeros(0, np.uint64)
        total = np.zeros(n + 1, np.uint64)
        np.cumsum((data.astype(np.uint64) + np.uint64(1)) * self.powers[:n], out=total[1:])
        words = _mixed((total[stop] - total[start]) * self.inverse[start] + (stop - start).astype(np.uint64))
        k = min(self.size, len(words))
        rolled = np.full(len(words) - k + 1, k, np.uint64)
        for i in range(k):
            rolled = rolled * np.uint64(_P) + words[i : len(words) - k + 1 + i]
        return np.unique(_mixed(rolled))


def _sketch(docs: DataFrame, size: int) -> np.ndarray:
    """Estimated documents per counter beyond chance, in steps of a quarter of a power of two; 0 for rare."""
    width = SKETCH // SKETCH_CHUNKS
    shift = np.uint64(64 - (SKETCH.bit_length() - 1))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingles, sums, held, n = Shingler(size), np.zeros(SKETCH, np.uint32), [], 0

        def add() -> None:
            np.add(sums, np.bincount(np.concatenate(held), minlength=SKETCH).astype(np.uint32), out=sums)
            held.clear()

        for batch in batches:
            for text in batch.column(0):
                slots = (shingles(text.as_py()) >> shift).astype(np.int64)
                held.append(slots)
                n += len(slots)
                if n > 2_000_000:
                    add()
                    n = 0
        if held:
            add()
        parts = sums.reshape(SKETCH_CHUNKS, width)
        some = np.flatnonzero(parts.any(axis=1))
        yield pa.RecordBatch.from_arrays([pa.array(some, pa.int64()), pa.array([zlib.compress(parts[i].tobytes(), 1) for i in some], pa.binary())], names=["chunk", "counts"])

    def merge(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        out = np.zeros(width, np.int64)
        for part in rows["counts"]:
            out += np.frombuffer(zlib.decompress(part), np.uint32)
        return pd.DataFrame({"chunk": [key[0]], "sum": [int(out.sum())], "counts": [zlib.compress(out.astype(np.int64).tobytes(), 1)]})

    merged = staged(docs.mapInArrow(count, "chunk long, counts binary").groupBy("chunk").applyInPandas(merge, "chunk long, sum long, counts binary"))
    mean = (merged.agg(F.sum("sum")).first()[0] or 0) / SKETCH
    noise = mean + 4 * np.sqrt(mean) + 1

    def coarse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for part in batch.column(1):
                counts = np.frombuffer(zlib.decompress(part.as_py()), np.int64)
                steps = np.where(counts > noise, 4 * np.log2(np.maximum(counts - mean, 2)), 0)
                out.append(zlib.compress(np.minimum(steps, 255).astype(np.uint8).tobytes(), 1))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(out, pa.binary())], names=["chunk", "steps"])

    table = np.zeros((SKETCH_CHUNKS, width), np.uint8)
    for row in merged.select("chunk", "counts").mapInArrow(coarse, "chunk long, steps binary").collect():  # SKETCH bytes
        table[row.chunk] = np.frombuffer(zlib.decompress(row.steps), np.uint8)
    return table.reshape(-1)


def prefix(hashes: np.ndarray, steps: np.ndarray, percent: int = PERCENT) -> tuple[int, np.ndarray]:
    """How many prefix shingles a partner must share, and the prefix, rarest shingles first."""
    n = len(hashes)
    rare = steps[(hashes >> np.uint64(64 - (SKETCH.bit_length() - 1))).astype(np.int64)]
    order = np.argsort(rare, kind="stable")  # hashes are sorted: ties by hash
    shortest = n - -(-percent * n // 100) + 1
    partners = np.exp2(rare[order] / 4.0)
    partners[rare[order] == 0] = UNSEEN
    postings = np.cumsum(partners)[shortest - 1 :]
    demand = np.arange(1, len(postings) + 1)
    costs = shortest - 1 + demand + postings + VERIFY_COST * postings / demand
    best = int(np.argmin(costs))
    return best + 1, hashes[order[: shortest + best]]


def _profiles(docs: DataFrame, size: int, percent: int) -> DataFrame:
    held = docs.sparkSession.sparkContext.broadcast(_sketch(docs.select("text"), size))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingles, steps = Shingler(size), held.value
        for batch in batches:
            for lo in range(0, batch.num_rows, 512):
                part = batch.slice(lo, 512)
                count, key, demand, first = [], [], [], []
                for text in part.column(1):
                    hashes = shingles(text.as_py())
                    count.append(len(hashes))
                    if len(hashes):
                        key.append(hashlib.blake2b(hashes.tobytes(), digest_size=16).digest())
                        asked, begin = prefix(hashes, steps, percent)
                        demand.append(asked)
                        first.append(begin.view(np.int64))
                    else:
                        key.append(None)
                        demand.append(0)
                        first.append(np.zeros(0, np.int64))
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), pa.array(count, pa.int64()), pa.array(key, pa.binary()), pa.array(demand, pa.int32()), pa.array(first, pa.list_(pa.int64()))],
                    names=["doc_id", "n", "key", "demand", "prefix"],
                )

    return docs.select("doc_id", "text").mapInArrow(run, "doc_id long, n long, key binary, demand int, prefix array<long>")


def _sets(docs: DataFrame, wanted: DataFrame, most: int, size: int) -> DataFrame:
    """(key, hashes) of the sets of ``wanted`` (key, doc_id), each once; made again from those rows' texts.

    A bitmap of the ids, with room for ``most``, keeps other texts from being read into words; the join decides.
    """
    held = docs.sparkSession.sparkContext.broadcast(bitmap(wanted.where("doc_id is not null").select("doc_id"), roomy(most)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingles = Shingler(size)
        for batch in batches:
            ids = batch.column(0)
            some = maybe_in(ids.fill_null(0).to_numpy(zero_copy_only=False), held.value) | ids.is_null().to_numpy(zero_copy_only=False)
            rows = np.flatnonzero(some)
            for lo in range(0, len(rows), 512):
                key, sets = [], []
                for row in rows[lo : lo + 512].tolist():
                    hashes = shingles(batch.column(1)[row].as_py())
                    if len(hashes):
                        key.append(hashlib.blake2b(hashes.tobytes(), digest_size=16).digest())
                        sets.append(hashes.view(np.int64))
                yield pa.RecordBatch.from_arrays([pa.array(key, pa.binary()), pa.array(sets, pa.list_(pa.int64()))], names=["key", "hashes"])

    made = docs.select("doc_id", "text").mapInArrow(run, "key binary, hashes array<long>")
    return staged(made.join(wanted.select("key").distinct(), "key", "left_semi").dropDuplicates(["key"]))


def _within(percent: int):
    """Links between the nodes of a part's tile pairs: each outsider against all of other roots, one link per root."""

    def run(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        out: list[tuple[int, int]] = []
        for _, tile in rows.groupby(["cluster", "i", "j"], sort=False):
            if tile["root"].nunique() < 2:
                continue
            sets = [np.asarray(h) for h in tile["hashes"]]
            size = np.array([len(h) for h in sets])
            owner, flat = np.repeat(np.arange(len(sets)), size), np.concatenate(sets)
            order = np.argsort(flat, kind="stable")
            owner, flat = owner[order], flat[order]
            node, root, own = (tile[c].to_numpy() for c in ("node", "root", "own"))
            cross = tile["i"].iloc[0] != tile["j"].iloc[0]
            for x in np.flatnonzero(own == tile["i"].iloc[0]):
                lo, hi = np.searchsorted(flat, sets[x], "left"), np.searchsorted(flat, sets[x], "right")
                many = hi - lo
                at = np.repeat(lo - np.concatenate([[0], np.cumsum(many)[:-1]]), many) + np.arange(many.sum())
                both = np.bincount(owner[at], minlength=len(sets))
                hit = (100 * both >= percent * (size + size[x] - both)) & (root != root[x])
                if cross:
                    hit &= own != own[x]
                for r in np.unique(root[hit]):
                    out.append((int(node[x]), int(node[hit & (root == r)][0])))
        return pd.DataFrame(out, columns=["a", "b"], dtype=np.int64)

    return run


def _outsiders(members: DataFrame) -> DataFrame:
    """``members`` (cluster, node, root, size) for every pair of tiles in which a node outside its cluster's largest root is compared.

    The largest root's nodes are dealt to tiles of their own, which never meet each other.
    """
    counts = members.groupBy("cluster", "root").agg(F.count("*").alias("m"))
    main = counts.groupBy("cluster").agg(F.max_by("root", F.struct("m", "root")).alias("main"), F.max("m").alias("inner"), F.sum("m").alias("all"))
    main = main.where("all > inner")
    tiles = lambda c: F.ceil(F.col(c) / TILE).cast("int")
    dealt = members.join(main, "cluster").withColumn("out", F.ceil((F.col("all") - F.col("inner")) / TILE).cast("int"))
    dealt = dealt.withColumn("inn", tiles("inner"))
    inside = F.col("root") == F.col("main")
    place = F.xxhash64("node")
    own = F.when(inside, F.col("out") + F.pmod(place, F.col("inn"))).otherwise(F.pmod(place, F.col("out"))).cast("int")
    last = F.when(inside, F.col("out") - 1).otherwise(F.col("out") + F.col("inn") - 1)
    dealt = dealt.withColumn("own", own).withColumn("other", F.explode(F.sequence(F.lit(0), last)))
    return dealt.select("cluster", "node", "root", "own", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"))


def _needed(n: Column, m: Column, percent: int) -> Column:
    """The shared shingles of a link between sets of n and m."""
    return F.ceil(percent * (n + m) / (100 + percent))


def _common(percent: int):
    """Pairs of a part's tile pairs that share enough of their lists to link, each outsider against all of other roots and clusters."""

    def run(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        out: list[tuple[np.ndarray, np.ndarray]] = []
        for _, tile in rows.groupby(["posting", "i", "j"], sort=False):
            lists = [np.asarray(h) for h in tile["shingles"]]
            places = [np.asarray(p) for p in tile["places"]]
            many = np.array([len(h) for h in lists])
            owner, flat, place = np.repeat(np.arange(len(lists)), many), np.concatenate(lists), np.concatenate(places)
            order = np.argsort(flat, kind="stable")
            owner, flat, place = owner[order], flat[order], place[order]
            node, root, cluster, own, size, most, demand, home = (tile[c].to_numpy() for c in ("node", "root", "cluster", "own", "n", "most", "demand", "home"))
            first, last_x, last_y = tile["i"].iloc[0], np.zeros(len(tile), np.int64), np.zeros(len(tile), np.int64)
            cross = first != tile["j"].iloc[0]
            for x in np.flatnonzero(own == first):
                fit = (root != root[x]) & (cluster != cluster[x]) & (home | home[x])
                asked = -(-percent * (size + size[x]) // (100 + percent))
                fit &= np.minimum(most, most[x]) >= asked
                if cross:
                    fit &= own != own[x]
                if not fit.any():
                    continue
                lo, hi = np.searchsorted(flat, lists[x], "left"), np.searchsorted(flat, lists[x], "right")
                met = hi - lo
                at = np.repeat(lo - np.concatenate([[0], np.cumsum(met)[:-1]]), met) + np.arange(met.sum())
                shares = np.bincount(owner[at], minlength=len(tile))
                last_x[owner[at]] = np.repeat(places[x], met)  # lists are in order of place: the last one stays
                last_y[owner[at]] = place[at]
                left = np.minimum(size[x] - (last_x + 1 - shares), size - (last_y + 1 - shares))
                hit = fit & (shares >= np.maximum(1, np.minimum(demand, demand[x]))) & (left >= asked)
                out.append((np.minimum(node[hit], node[x]), np.maximum(node[hit], node[x])))
        if not out:
            return pd.DataFrame({"a": [], "b": []}, dtype=np.int64)
        return pd.DataFrame({"a": np.concatenate([a for a, _ in out]), "b": np.concatenate([b for _, b in out])}).drop_duplicates()

    return run


def _meetings(still: DataFrame, percent: int) -> DataFrame:
    """Pairs (a, b, shares, last_a, last_b) of ``still`` (shingle, node, pos, n, demand, root, cluster) that may link, each once.

    They are of other roots and clusters, and of sizes near each other. A pair that
    links has a shingle among the first n - ceil(t n) + 1 of both: there it meets, and is then
    judged by all the prefix shingles that both have. Of a node's prefix, the
    shingles in no posting of several roots are missing in every partner, so what a
    partner can share is known before: documents with a passage in common and too much
    besides do not meet. In postings of up to ``SHORT`` entries the pairs are joined, at
    most ``SHORT`` for an entry; longer ones are compared in tiles, which write no pair but
    those that share as many as they must.
    """
    rank = F.row_number().over(Window.partitionBy("node").orderBy("pos"))
    still = still.withColumn("most", F.col("n") - (F.col("pos") + 1 - rank))
    band = F.floor(F.log(F.col("n").cast("double")) / float(np.log(1.0001 * 100 / percent))).cast("int")  # partners are of one band or two in a row
    still = staged(still.where(F.col("most") >= F.ceil(percent * F.col("n") / 100)).withColumn("band", band))
    entry = F.sort_array(F.collect_list(F.struct("pos", "shingle")))
    lists = still.groupBy("node").agg(entry.alias("entries"), F.first("n").alias("n"), F.first("demand").alias("demand"))
    lists = lists.select("node", "n", "demand", F.col("entries.shingle").alias("shingles"), F.col("entries.pos").alias("places"))
    lists = staged(lists)

    early = still.where(F.col("pos") <= F.col("n") - F.ceil(percent * F.col("n") / 100))
    sizes = early.groupBy("shingle").agg(F.count("*").alias("many"), F.min("root").alias("lo"), F.max("root").alias("hi"))
    early = staged(early.join(sizes.where("lo <> hi").select("shingle", "many"), "shingle"))

    short = early.where(F.col("many") <= SHORT)
    of = lambda s: short.select("shingle", "band", *[F.col(c).alias(f"{c}_{s}") for c in ("node", "root", "cluster", "n", "most")])
    left = of("a").where(F.col("most_a") >= _needed(F.col("n_a"), F.col("n_a"), percent))
    left = left.withColumn("band", F.explode(F.array("band", F.col("band") + 1)))
    smaller = (F.col("n_a") < F.col("n_b")) | ((F.col("n_a") == F.col("n_b")) & (F.col("node_a") < F.col("node_b")))
    enough = F.least("most_a", "most_b") >= _needed(F.col("n_a"), F.col("n_b"), percent)
    joined = left.join(of("b"), ["shingle", "band"]).where(smaller & F.expr("root_a <> root_b and cluster_a <> cluster_b") & enough)
    joined = joined.select(F.least("node_a", "node_b").alias("a"), F.greatest("node_a", "node_b").alias("b"))

    # an entry is at home in its own band and a guest in the one before: guests do not meet each other there
    crowd = early.where(F.col("many") > SHORT)
    crowd = crowd.withColumn("home", F.explode(F.array(F.lit(True), F.lit(False))))
    posting = F.xxhash64("shingle", F.col("band") - F.when(F.col("home"), 0).otherwise(1))
    crowd = crowd.select(posting.alias("posting"), "node", "root", "cluster", "most", "home")
    alive = crowd.groupBy("posting").agg(F.max("home").alias("any")).where("any").select("posting")
    crowd = staged(crowd.join(alive, "posting"))
    tiled = staged(_outsiders(crowd.withColumnRenamed("cluster", "own_cluster").withColumnRenamed("posting", "cluster")).withColumnRenamed("cluster", "posting"))
    parts = -(-tiled.count() // TILE) or 1
    tiled = tiled.join(crowd.drop("root"), ["posting", "node"]).join(lists, "node")
    tiled = tiled.withColumn("part", F.pmod(F.xxhash64("posting", "i", "j"), F.lit(parts)))
    compared = tiled.groupBy("part").applyInPandas(_common(percent), "a long, b long")

    pairs = staged(joined.unionAll(compared).distinct())
    side = lambda s: lists.select(F.col("node").alias(s), F.col("shingles").alias(f"shingles_{s}"), F.col("places").alias(f"places_{s}"))
    pairs = pairs.join(side("a"), "a").join(side("b"), "b")
    pairs = pairs.withColumn("both", F.array_intersect("shingles_a", "shingles_b"))
    last = lambda s: F.element_at(f"places_{s}", F.array_position(f"shingles_{s}", F.element_at("both", -1)).cast("int"))
    return pairs.select("a", "b", F.size("both").cast("long").alias("shares"), last("a").alias("last_a"), last("b").alias("last_b"))


def similar_sets(docs: DataFrame, *, key: str = "doc_id", text: str = "text", size: int = WORDS, percent: int = PERCENT) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_shingles, component_id.

    Words are runs of characters other than space and the controls 9 to 13, A-Z in lower
    case; a set holds the distinct shingles of ``size`` words, or the whole sequence of
    a shorter text. Two rows link when 100 * intersection >= ``percent`` * union;
    component_id is the least id reachable by links. Texts without words (NULL, empty)
    have the empty set and link with nothing; rows with NULL ids take part, and their
    component's id is the least id in it that is not NULL. Repeated rows are copies.
    Shingles count as equal when their 64-bit hashes are.
    """
    placed = _placed(docs, key, text, size, percent)
    least = placed.groupBy("root").agg(F.min("doc_id").alias("component_id"))
    return placed.join(least, "root").select("doc_id", F.col("n").alias("n_shingles"), "component_id")


def _placed(docs: DataFrame, key: str, text: str, size: int, percent: int) -> DataFrame:
    """One row per row of ``docs``: doc_id, n shingles, the key of its set (NULL of the empty one), and a number of its component."""
    rows = docs.select(quoted(key).cast("long").alias("doc_id"), quoted(text).cast("string").alias("text"))
    needed = lambda n, m: _needed(n, m, percent)
    base = staged(_profiles(rows, size, percent).withColumn("row", F.monotonically_increasing_id()))
    nodes = staged(base.where("n > 0").groupBy("key").agg(F.min("row").alias("node")))
    own = base.join(nodes.select(F.col("node").alias("row")), "row", "left_semi").withColumnRenamed("row", "node")
    entries = own.select("node", F.posexplode("prefix").alias("pos", "shingle"))
    posted = entries.groupBy("shingle").agg(F.count("*").alias("many")).where("many > 1").select("shingle")
    met = entries.join(posted, "shingle")
    # shingles met nowhere else are missing in every partner: an entry after too many of them leads to no link
    rank = F.row_number().over(Window.partitionBy("node").orderBy("pos"))
    met = staged(met.join(own.select("node", "n"), "node").withColumn("alone", F.col("pos") + 1 - rank))
    smallest = met.groupBy("shingle").agg(F.min("n").alias("least_n"))
    shared = met.join(smallest, "shingle").where(F.col("n") - F.col("alone") >= needed(F.col("n"), F.col("least_n")))
    shared = staged(shared.select("shingle", "node", "pos", "n"))
    facts = staged(own.select("node", "doc_id", "n", "demand", "key").join(shared.groupBy("node").agg(F.count("*").alias("met")), "node"))

    def plausible(pairs: DataFrame, part: float) -> DataFrame:
        """Pairs (a, b, shares, last_a, last_b) that may link, with their facts.

        They share this part of what they demand, and what is left of each set when the
        prefix shingles before the last shared one that the other lacks are taken away
        is large enough.
        """
        of = lambda side: facts.select(*[F.col(c).alias(f"{c}_{side}") for c in ("doc_id", "n", "demand", "key")], F.col("node").alias(side))
        both = pairs.join(of("a"), "a").join(of("b"), "b")
        asked = needed(F.col("n_a"), F.col("n_b"))
        left = F.least(*[F.col(f"n_{s}") - (F.col(f"last_{s}") + 1 - F.col("shares")) for s in "ab"])
        left = left if part == 1.0 else F.least("n_a", "n_b")
        return staged(both.where((F.col("shares") >= part * F.least("demand_a", "demand_b")) & (left >= asked)))

    def linked(pairs: DataFrame) -> DataFrame:
        """The pairs (a, b) whose whole sets are similar."""
        side = lambda s: pairs.select(F.col(f"key_{s}").alias("key"), F.col(f"doc_id_{s}").alias("doc_id"))
        sets = _sets(rows, side("a").unionAll(side("b")).distinct(), 2 * pairs.count(), size)
        of = lambda s: sets.select(F.col("key").alias(f"key_{s}"), F.col("hashes").alias(f"set_{s}"))
        both = pairs.select("a", "b", "n_a", "n_b", "key_a", "key_b").join(of("a"), "key_a").join(of("b"), "key_b")
        inner = F.size(F.array_intersect("set_a", "set_b"))
        return both.where(100 * inner >= percent * (F.col("n_a") + F.col("n_b") - inner)).select("a", "b")

    def parted(roots: DataFrame | None) -> DataFrame:
        """Entries of the postings whose nodes are not yet of one component, with their roots."""
        if roots is None:
            return shared.withColumn("root", F.col("node"))
        placed = shared.join(roots, "node", "left").select("shingle", "node", "pos", "n", F.coalesce("root", "node").alias("root"))
        ends = placed.groupBy("shingle").agg(F.min("root").alias("lo"), F.max("root").alias("hi"))
        return staged(placed.join(ends.where("lo <> hi").select("shingle"), "shingle"))

    links = clusters = roots = None
    for turn in range(HEAD_ROUNDS):
        still = parted(roots)
        order = F.col("met") if turn == 0 else F.xxhash64("node", F.lit(turn))
        ranked = still.join(facts.select("node", "met"), "node") if turn == 0 else still
        heads = ranked.groupBy("shingle").agg(F.max_by("node", order).alias("head"), F.max_by("root", order).alias("head_root"))
        beside = still.join(heads, "shingle").where("node <> head and root <> head_root")
        pairs = beside.groupBy(F.col("head").alias("a"), F.col("node").alias("b")).agg(F.count("*").alias("shares"))
        pairs = plausible(pairs, 0.5)
        if turn == 0:  # a node's cluster: the head it shares most with
            clusters = staged(pairs.groupBy(F.col("b").alias("node")).agg(F.max_by("a", F.struct("shares", "a")).alias("cluster")))
        found = linked(pairs)
        links = staged(found if links is None else links.unionAll(found))
        roots = components(links)

    # within clusters all whole sets meet in tiles, without writing pairs
    members = clusters.join(roots, "node", "left").select("cluster", "node", F.coalesce("root", "node").alias("root"))
    tiled = staged(_outsiders(members).join(facts.select("node", "key", "doc_id"), "node"))
    entered = tiled.count()
    sets = _sets(rows, tiled.select("key", "doc_id").distinct(), entered, size)
    parts = -(-entered // TILE) or 1
    tiled = tiled.join(sets, "key").withColumn("part", F.pmod(F.xxhash64("cluster", "i", "j"), F.lit(parts)))
    found = tiled.select("part", "cluster", "i", "j", "node", "root", "own", "hashes").groupBy("part").applyInPandas(_within(percent), "a long, b long")
    links = staged(links.unionAll(found))

    # between clusters the pairs of a posting meet that the shingles no other root has leave possible
    still = parted(components(links)).join(clusters, "node", "left").withColumn("cluster", F.coalesce("cluster", -F.col("node") - 1))
    pairs = _meetings(still.join(facts.select("node", "demand"), "node"), percent)
    links = staged(links.unionAll(linked(plausible(pairs, 1.0))))
    roots = components(links)

    placed = base.select("doc_id", "n", "key", "row").join(nodes, "key", "left").join(roots, "node", "left")
    return staged(placed.select("doc_id", "n", "key", F.coalesce("root", "node", F.col("row")).alias("root")))


def _set_key(text: Column, size: int) -> Column:
    """The key of a text's set, NULL of the empty one."""

    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        shingles = Shingler(size)
        for batch in batches:
            sets = (shingles(value.as_py()) for value in batch)
            yield pa.array([hashlib.blake2b(s.tobytes(), digest_size=16).digest() if len(s) else None for s in sets], pa.binary())

    return F.arrow_udf(run, "binary", ArrowUDFType.SCALAR_ITER)(text)


def one_of_each(docs: DataFrame, *, key: str = "doc_id", text: str = "text", size: int = WORDS, percent: int = PERCENT) -> DataFrame:
    """The rows of ``docs`` that stay when each group of similar texts keeps its row with the least id.

    A row goes only if its own group keeps another one, whatever other rows have its id:
    different texts under one id, or without id (NULL), are judged apart. A group without
    ids keeps one row, and so does one whose least id is repeated in it. Texts without
    words are in no group, and all stay.
    Only rows that may go, or may repeat, are shuffled; the rest pass a bitmap of those.
    Rows whose id does not tell them apart are known by id and set of shingles.
    """
    placed = _placed(docs, key, text, size, percent).where("n > 0")
    least = placed.groupBy("root").agg(F.min("doc_id").alias("component_id"))
    placed = placed.join(least, "root").withColumn("stays", F.col("doc_id").eqNullSafe(F.col("component_id")))
    by_id = placed.where("doc_id is not null").groupBy("doc_id").agg(F.count("*").alias("rows"), F.max(F.col("stays").cast("int")).alias("any"))
    odd = staged(by_id.where("rows > 1 or any = 0").select("doc_id", F.col("any").alias("stay")))
    label = lambda set_key, doc_id: F.concat(F.hex(set_key), F.lit(":"), F.coalesce(doc_id.cast("string"), F.lit("")))
    unclear = placed.join(odd.where("stay = 1").select("doc_id"), "doc_id", "left_semi").unionByName(placed.where("doc_id is null").select("doc_id", *[c for c in placed.columns if c != "doc_id"]))
    unclear = staged(unclear.groupBy("doc_id", "root", "key").agg(F.max(F.col("stays").cast("int")).alias("stays")))
    first = unclear.where("stays = 1").groupBy("root").agg(F.min(F.hex("key")).alias("first"))
    judged = unclear.join(first, "root", "left")
    gone = judged.where("stays = 0 or hex(key) <> first").select(label(F.col("key"), F.col("doc_id")).alias("_gone"))

    doubt, known, stay, own = fresh(docs, "_doubted", "_known", "_stay", "_own")
    number = quoted(key).cast("long")
    words = F.coalesce(quoted(text).cast("string"), F.lit("")).rlike(r"[^ \x09-\x0d]")
    flagged = docs.withColumn(doubt, maybe(number, docs, bitmap(odd.select("doc_id"), roomy(odd.count()))) & words)
    sure = flagged.where(~F.col(doubt)).drop(doubt)
    again = flagged.where(F.col(doubt)).drop(doubt)
    facts = odd.select(F.col("doc_id").alias(known), F.col("stay").alias(stay))
    named = again.where(number.isNotNull()).join(facts, number == F.col(known), "left").where(F.col(stay).isNull() | (F.col(stay) == 1))
    nameless = again.where(number.isNull()).withColumn(known, F.lit(None).cast("long")).withColumn(stay, F.lit(1))
    again = named.unionByName(nameless)
    apart = _set_key(F.when(F.col(stay) == 1, quoted(text).cast("string")), size)
    again = again.withColumn(own, apart).withColumn(own, F.coalesce(label(F.col(own), number), number.cast("string")))
    again = again.dropDuplicates([own]).join(gone.withColumnRenamed("_gone", own), own, "left_anti")
    return sure.unionByName(again.drop(known, stay, own))

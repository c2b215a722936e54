"""Best-fit packing of tokenised documents by a grouping genetic algorithm on islands.

Documents are tokenised in one map over the rows and cut into pieces; pieces are dealt
at random into packing groups of bounded size, and each group is a bin packing problem
of its own, described by how many pieces it has of each length. Several islands evolve
packings of a group side by side as rows of a DataFrame: a crossover injects whole
well-filled bins of one parent into the other, drops the bins that hold a piece twice
and best-fits what they displace. Between epochs every island sends its elite to the
next one. The best packing of a group is dealt out to its pieces; the pieces of bins
that stayed under-filled are pooled over all groups and packed again, until one group
is left or pooling no longer shrinks them.
"""

from __future__ import annotations

import json
import zlib
from bisect import bisect_left, insort
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from tickloom.llm.common import quoted
from tickloom.session import staged

PIECES_PER_GROUP = 8192
ISLANDS, EPOCHS = 3, 2
POPULATION, GENERATIONS = 4, 5
WELL_FILLED, POOLED = 0.995, 0.98

# fixed value: how the byte-level tokenizer splits text
BYTE_LEVEL_SPLIT = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"


def byte_symbols() -> dict[str, int]:
    """The printable character that stands for each byte in a byte-level vocabulary."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


def encoder(spec: str):
    """text -> uint32 ids for a tokenizer's JSON.

    A byte-level BPE whose ids follow its merges, as a public vocabulary has them, runs
    on the faster library with the same ids; any other tokenizer runs as it is.
    """
    parsed = json.loads(spec)
    model, split = parsed["model"], parsed.get("pre_tokenizer") or {}
    vocab = model.get("vocab")
    by_rank = (
        model.get("type") == "BPE"
        and split.get("type") == "ByteLevel"
        and split.get("use_regex", True)
        and not split.get("add_prefix_space")
        and not parsed.get("normalizer")
        and not model.get("ignore_merges")
    )
    if by_rank:
        merged = [vocab["".join(m) if isinstance(m, list) else m.replace(" ", "")] for m in model["merges"]]
        by_rank = all(a < b for a, b in zip(merged, merged[1:], strict=False))
    special = {t["content"]: t["id"] for t in parsed.get("added_tokens", [])}
    slow = []

    def plainly(text: str) -> np.ndarray:
        if not slow:  # where the faster library does, it is never made
            from tokenizers import Tokenizer

            slow.append(Tokenizer.from_str(spec))
        return np.array(slow[0].encode(text, add_special_tokens=False).ids, dtype=np.uint32)

    if not by_rank:
        return plainly

    import tiktoken

    symbols = byte_symbols()
    ranks = {bytes(symbols[c] for c in token): n for token, n in vocab.items() if token not in special}
    fast = tiktoken.Encoding("bpe", pat_str=BYTE_LEVEL_SPLIT, mergeable_ranks=ranks, special_tokens=special)
    allowed = set(special)

    def run(text: str) -> np.ndarray:
        try:
            return fast.encode_to_numpy(text, allowed_special=allowed)
        except ValueError:  # its pattern needs a stack as deep as a run of white space is long
            return plainly(text)

    return run


def tokenise(
    docs: DataFrame, tokenizer: str, *, key: str = "doc_id", text: str = "text", limit: int = 2048, end: int = 0, ids: bool = False
) -> DataFrame:
    """Pieces of every document: key, piece, start, length, ids_crc32, and ``ids`` if wanted.

    A document's tokens are those of its whole text and the token ``end``. Longer ones
    than ``limit`` are cut into pieces of ``limit`` tokens, of which the first may be
    shorter. NULL text is empty: one piece that holds ``end`` alone. Texts are encoded
    whole, however long they or their runs of one character are. ``tokenizer`` is
    the path of a tokenizer's JSON on the driver; its content travels with the job.
    """
    with open(tokenizer, encoding="utf-8") as file:
        spec = docs.sparkSession.sparkContext.broadcast(file.read())  # a fixed vocabulary

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(spec.value)
        for batch in batches:
            for lo in range(0, batch.num_rows, 512):
                part = batch.slice(lo, 512)
                rows, piece, start, length, crc, held = [], [], [], [], [], []
                for row, value in enumerate(part.column(1)):
                    tokens = np.append(encode(value.as_py() or ""), np.uint32(end)).astype("<u4")
                    at = 0
                    for n, stop in enumerate(range((len(tokens) - 1) % limit + 1, len(tokens) + 1, limit)):
                        own = tokens[at:stop]
                        rows.append(row)
                        piece.append(n)
                        start.append(at)
                        length.append(stop - at)
                        crc.append(zlib.crc32(own.tobytes()))
                        if ids:
                            held.append(own.astype(np.int32))
                        at = stop
                columns = [
                    part.column(0).take(pa.array(rows, pa.int64())),
                    pa.array(piece, pa.int32()),
                    pa.array(start, pa.int64()),
                    pa.array(length, pa.int64()),
                    pa.array(crc, pa.int64()),
                ]
                names = ["key", "piece", "start", "length", "ids_crc32"]
                if ids:
                    columns.append(pa.array(held, pa.list_(pa.int32())))
                    names.append("ids")
                yield pa.RecordBatch.from_arrays(columns, names=names)

    kind = dict(docs.select(quoted(key)).dtypes)[key]
    schema = f"key {kind}, piece int, start long, length long, ids_crc32 long" + ", ids array<int>" * ids
    return docs.select(quoted(key), quoted(text).cast("string")).mapInArrow(cut, schema).withColumnRenamed("key", key)


def best_fit(sizes: list[int], bins: list[list[int]], limit: int) -> list[list[int]]:
    """Put ``sizes`` (largest first) where they leave the least room, opening bins as needed."""
    room = sorted((limit - sum(b), i) for i, b in enumerate(bins))
    for size in sorted(sizes, reverse=True):
        at = bisect_left(room, (size, -1))
        if at < len(room):
            left, i = room.pop(at)
            bins[i].append(size)
        else:
            left, i = limit, len(bins)
            bins.append([size])
        if left > size:
            insort(room, (left - size, i))
    return bins


def crossed(mother: list[list[int]], father: list[list[int]], supply: np.ndarray, limit: int, rng) -> list[list[int]]:
    """``mother`` with a share of ``father``'s well-filled bins in place of those they overlap."""
    good = [b for b in father if sum(b) >= WELL_FILLED * limit]
    if good:
        first, share = rng.integers(len(good)), 1 + rng.integers(max(1, len(good) // 2))
        good = [good[(first + i) % len(good)] for i in range(min(share, len(good)))]
    left = supply.tolist()
    child = []
    for b in good:
        child.append(list(b))
        for size in b:
            left[size] -= 1
    for b in sorted(mother, key=sum, reverse=True):
        taken = 0
        for size in b:
            if left[size] <= 0:
                break
            left[size] -= 1
            taken += 1
        if taken == len(b):
            child.append(list(b))
        else:
            for size in b[:taken]:
                left[size] += 1
    displaced = [size for size, n in enumerate(left) for _ in range(n)]
    return best_fit(displaced, child, limit)


def shaken(packing: list[list[int]], limit: int, rng) -> list[list[int]]:
    """The worst-filled bins and a few others emptied and best-fitted anew."""
    order = sorted(packing, key=sum)
    n = max(2, len(order) // 20)
    rest = order[n:]
    drop = set(rng.integers(len(rest), size=n).tolist()) if rest else set()
    kept = [list(b) for i, b in enumerate(rest) if i not in drop]
    loose = [s for b in order[:n] for s in b] + [s for i in drop for s in rest[i]]
    rng.shuffle(loose)
    fits = [[]]
    for size in loose[: len(loose) // 3]:  # some in random order, the rest largest first
        if sum(fits[-1]) + size > limit:
            fits.append([])
        fits[-1].append(size)
    return best_fit(loose[len(loose) // 3 :], kept + [b for b in fits if b], limit)


def cost(packing: list[list[int]], limit: int) -> tuple[int, float]:
    """Bins, then how evenly they are filled (fuller bins beside emptier ones are better)."""
    return len(packing), -sum((sum(b) / limit) ** 2 for b in packing)


def evolve(sizes: list[int], guests: list[list[list[int]]], limit: int, seed: int) -> list[list[int]]:
    """The best packing of ``sizes`` an island finds, starting from best-fit and from ``guests``."""
    fewest = -(-sum(sizes) // limit)
    people = [*guests] or [best_fit(sizes, [], limit)]
    best = min(people, key=lambda p: cost(p, limit))
    if len(best) <= fewest:
        return best
    rng = np.random.default_rng(seed)
    supply = np.bincount(sizes, minlength=limit + 1)
    while len(people) < POPULATION:
        people.append(shaken(people[0], limit, rng))
    for _ in range(GENERATIONS):
        people.sort(key=lambda p: cost(p, limit))
        if len(people[0]) <= fewest:
            break
        a, b = rng.choice(len(people), 2, replace=False)
        people[-1] = crossed(people[a], people[b], supply, limit, rng)
        people[-2] = shaken(people[0], limit, rng)
    return min(people, key=lambda p: cost(p, limit))


def _unflat(flat: list[int], counts: list[int]) -> list[list[int]]:
    out, at = [], 0
    for n in counts:
        out.append(flat[at : at + n])
        at += n
    return out


def _island(limit: int, epoch: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                sizes = np.repeat(row["sizes"], row["counts"]).tolist()
                guests = [_unflat(g["flat"], g["bins"]) for g in row["guests"] or []]
                best = evolve(sizes, guests, limit, seed=row["grp"] * 1009 + row["island"] * 31 + epoch)
                n, spread = cost(best, limit)
                out = {
                    "grp": [row["grp"]],
                    "island": [row["island"]],
                    "sizes": pa.array([row["sizes"]], pa.list_(pa.int64())),
                    "counts": pa.array([row["counts"]], pa.list_(pa.int64())),
                    "flat": pa.array([[s for b in best for s in b]], pa.list_(pa.int32())),
                    "bins": pa.array([[len(b) for b in best]], pa.list_(pa.int32())),
                    "n": pa.array([n], pa.int32()),
                    "spread": [spread],
                }
                yield pa.RecordBatch.from_pydict(out)

    return run


def _deal(limit: int, level: int):
    """Place a group's pieces into the bins of its best packing, length by length."""

    def run(key, pieces, best):
        flat, counts = np.array(best["flat"].iloc[0]), np.array(best["bins"].iloc[0])
        number = np.repeat(np.arange(len(counts)), counts)
        ends = np.cumsum(flat)
        first = np.concatenate([[0], ends[:-1]])
        offset = first - first[np.concatenate([[0], np.cumsum(counts)[:-1]])][number]
        fill = np.bincount(number, weights=flat)[number]
        mine, slots = np.argsort(pieces["length"].to_numpy(), kind="stable"), np.argsort(flat, kind="stable")
        place = np.empty(len(mine), dtype=np.int64)
        place[mine] = slots
        return pieces.drop(columns="grp").assign(
            sequence_id=(level << 56) + (int(key[0]) << 20) + number[place], offset=offset[place], fill=fill[place].astype(np.int64)
        )

    return run


def pack(pieces: DataFrame, *, limit: int = 2048, per_group: int = PIECES_PER_GROUP, islands: int = ISLANDS, epochs: int = EPOCHS) -> DataFrame:
    """``pieces`` (with a ``length`` from 1 to ``limit``) with ``sequence_id`` and ``offset``.

    Every piece is placed once, offsets are gapless from 0 and no sequence holds more
    than ``limit``. Repeated rows are pieces of their own. Groups are dealt by a hash of
    a row number, so no value can crowd one; other columns ride along. The empty table
    gives an empty result.
    """
    kept = [c for c in pieces.columns if c not in ("length", "sequence_id", "offset")]
    ride = [quoted(c).alias(f"c{i}") for i, c in enumerate(kept)]  # numbered, so none can clash
    rows = staged(pieces.select(*ride, quoted("length").cast("long").alias("length"), F.monotonically_increasing_id().alias("row")))
    nowhere = [F.lit(None).cast("long").alias(c) for c in ("sequence_id", "offset", "fill")]
    done, level, groups, before = rows.limit(0).select("*", *nowhere), 0, -(-rows.count() // per_group), None
    while groups and (before is None or groups < before):
        dealt = rows.withColumn("grp", F.pmod(F.xxhash64("row"), F.lit(groups)))
        placed = staged(_packed(dealt, limit, level, islands, epochs))
        pool = placed.where(F.col("fill") < POOLED * limit)
        before, groups, level = groups, -(-pool.count() // per_group), level + 1
        if before == 1 or groups >= before:
            done = done.unionByName(placed)
            break
        done = done.unionByName(placed.where(F.col("fill") >= POOLED * limit))
        rows = pool.drop("sequence_id", "offset", "fill")
    return done.select(*[F.col(f"c{i}").alias(c) for i, c in enumerate(kept)], "length", "sequence_id", "offset")


def _packed(rows: DataFrame, limit: int, level: int, islands: int, epochs: int) -> DataFrame:
    by_size = rows.groupBy("grp", "length").agg(F.count("*").alias("n"))  # at most limit rows a group
    problems = by_size.groupBy("grp").agg(F.sort_array(F.collect_list(F.struct("length", "n"))).alias("h"))
    every = F.sequence(F.lit(0).cast("long"), F.lit(islands - 1).cast("long"))
    guests = F.lit(None).cast("array<struct<flat: array<int>, bins: array<int>>>")
    state = problems.select(
        "grp", F.explode(every).alias("island"), F.col("h.length").alias("sizes"), F.col("h.n").alias("counts"), guests.alias("guests")
    )
    result = "grp long, island long, sizes array<long>, counts array<long>, flat array<int>, bins array<int>, n int, spread double"
    for epoch in range(epochs):
        elites = state.repartition("grp", "island").mapInArrow(_island(limit, epoch), result)
        met = elites.withColumn("island", F.explode(F.array("island", (F.col("island") + 1) % islands)))
        state = met.groupBy("grp", "island").agg(
            F.any_value("sizes").alias("sizes"), F.any_value("counts").alias("counts"), F.collect_list(F.struct("flat", "bins")).alias("guests")
        )  # two guests
    best = elites.groupBy("grp").agg(F.min_by(F.struct("flat", "bins"), F.struct("n", "spread", "island")).alias("b"))
    best = best.select("grp", "b.flat", "b.bins")
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema if f.name != "grp")
    schema = f"{fields}, sequence_id long, offset long, fill long"
    return rows.groupBy("grp").cogroup(best.groupBy("grp")).applyInPandas(_deal(limit, level), schema)

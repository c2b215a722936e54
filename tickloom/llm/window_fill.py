"""Packing by non-negative least squares: combinations of few lengths that fill windows.

Documents are tokenised in one map and cut into whole windows, a body of whole units
and a tail shorter than a unit, so that however large the corpus, its histogram of
lengths has at most ``limit / unit + unit`` entries. All combinations of up to three
lengths that exactly fill a window (of 1, 2, 4 ... units, or of as many tokens inside a
unit) are the columns of a non-negative least-squares problem: how often must each be
used to come nearest the histogram? Its solution has no more combinations than there
are lengths. It is rounded to what the histogram holds, and the residual counts are
best-fitted, largest length first.

The plan knows lengths and counts only. A piece finds its place by its rank among
those of its length: ranks are counted in the tokenising tasks and offset by the counts
of the tasks before, so no rows are sorted, gathered or dealt anew. Filled windows are laid
end to end, the largest first; as their lengths are powers of two, none crosses the
border of a sequence, and the small ones add up to whole sequences as well.
"""

from __future__ import annotations

import json
import re
import unicodedata
import zlib
from bisect import bisect_left
from collections.abc import Callable, Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window, functions as F

from tickloom.llm.common import quoted
from tickloom.session import staged

LIMIT, UNIT, DEPTH = 4096, 16, 3
CACHED_WORDS, SEGMENT = 1_000_000, 1 << 20

# fixed value: how the word tokenizer splits normalised text
WORD_SPLIT = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
SPACES = "\t\n\x0b\x0c\r \x85\xa0"
PLAIN_END = 0x250  # below: Latin letters, which composing leaves as they are


def _word_pattern() -> re.Pattern:
    """``WORD_SPLIT`` for characters below ``PLAIN_END`` and what they become in lower case.

    No two alternatives begin alike, so the likeliest is tried first.
    """
    kind = lambda c: unicodedata.category(chr(c))[0]
    letters, numbers = ("".join(re.escape(chr(c)) for c in range(PLAIN_END) if kind(c) == k) for k in "LN")
    *short, words, number, other = WORD_SPLIT.split("|")
    split = "|".join([words, number, *short, other])
    return re.compile(split.replace(r"\p{L}", letters).replace(r"\p{N}", numbers).replace(r"\s", re.escape(SPACES)))


class Words:
    """word -> its ids as bytes; words are encoded by the tokenizer once, all new ones of a call together."""

    def __init__(self, encode: Callable[[str], np.ndarray], last: np.ndarray):
        self.encode, self.last, self.held = encode, last, {}

    def __call__(self, words: list[list[str]]) -> list[bytes]:
        if len(self.held) > CACHED_WORDS:
            self.held = {}
        new = list(set(chain.from_iterable(words)).difference(self.held))
        if new:
            ids = self.encode(" ".join(new))  # every word ends in an id that ends words
            stops = (4 * (np.flatnonzero(self.last[ids]) + 1)).tolist()
            packed = ids.tobytes()
            self.held.update(zip(new, (packed[a:b] for a, b in zip([0, *stops], stops, strict=False)), strict=True))
        return [b"".join(map(self.held.__getitem__, own)) for own in words]


def word_encoder(spec: str) -> Callable[[list[str]], list[bytes]]:
    """texts -> their ids as little-endian unsigned 32-bit numbers, for a tokenizer's JSON.

    A tokenizer that folds case, drops white space, splits at ``WORD_SPLIT`` and marks the
    ends of words gives each word the same ids wherever it stands, so words are looked up
    and only new ones are encoded. Texts with characters from ``PLAIN_END`` on or with
    special tokens, and all texts of other tokenizers, go through the tokenizer itself.
    """
    from tokenizers import Tokenizer

    parsed = json.loads(spec)
    slow, model = Tokenizer.from_str(spec), parsed["model"]
    encode = lambda text: np.array(slow.encode_batch_fast([text], add_special_tokens=False)[0].ids, dtype="<u4")
    each = lambda texts: [encode(text).tobytes() for text in texts]
    folds = (parsed.get("normalizer") or {}).get("normalizers") == [
        {"type": "NFC"}, {"type": "Replace", "pattern": {"Regex": r"\s+"}, "content": " "}, {"type": "Lowercase"}
    ]
    steps = (parsed.get("pre_tokenizer") or {}).get("pretokenizers") or [{}]
    splits = steps[0] == {"type": "Split", "pattern": {"Regex": WORD_SPLIT}, "behavior": "Removed", "invert": True}
    others = [s for s in steps[1:] if s.get("type") != "ByteLevel" or s.get("add_prefix_space") or s.get("use_regex", True)]
    mark = model.get("end_of_word_suffix")
    if not folds or not splits or others or not mark:
        return each
    last = np.zeros(1 + max(model["vocab"].values()), bool)
    last[[n for token, n in model["vocab"].items() if token.endswith(mark)]] = True
    words, pattern = Words(encode, last), _word_pattern()
    special = [t["content"] for t in parsed.get("added_tokens", [])]
    space, beyond = re.compile(f"[{SPACES}]"), re.compile(f"[^\x00-{chr(PLAIN_END - 1)}]")

    def segments(text: str) -> Iterator[str]:
        at = 0
        while len(text) - at > SEGMENT:  # no token holds white space
            cut = space.search(text, at + SEGMENT)
            if not cut:
                break
            yield text[at : cut.start()]
            at = cut.start()
        yield text[at:]

    def plain(text: str) -> bool:
        return not beyond.search(text) and not any(mark in text for mark in special)

    def run(texts: list[str]) -> list[bytes]:
        out = [b""] * len(texts)
        short = [i for i, text in enumerate(texts) if len(text) <= SEGMENT and plain(text)]
        for i, ids in zip(short, words([pattern.findall(texts[i].lower()) for i in short]), strict=True):
            out[i] = ids
        for i in sorted(set(range(len(texts))).difference(short)):
            out[i] = b"".join(words([pattern.findall(s.lower())])[0] if plain(s) else encode(s).tobytes() for s in segments(texts[i]))
        return out

    return run


def cut_lengths(n: int, limit: int, unit: int) -> list[int]:
    """Whole windows, then the whole units of the rest, then what is left."""
    rest = n % limit
    return [limit] * (n // limit) + [length for length in (rest - rest % unit, rest % unit) if length]


def tokenise(
    docs: DataFrame, tokenizer: str, *, key: str = "doc_id", text: str = "text", limit: int = LIMIT, unit: int = UNIT, end: int = 2, ids: bool = False
) -> DataFrame:
    """Pieces of every document: key, start, length, ids_crc32, doc_tokens, ``ids`` if wanted; ``part`` and ``nth`` tell them apart.

    A document's tokens are those of its whole text and ``end``; NULL text is empty.
    ``nth`` counts the pieces of a length within the task ``part``; write the result
    before using them, as ``pack`` does.
    """
    with open(tokenizer, encoding="utf-8") as file:
        spec = docs.sparkSession.sparkContext.broadcast(file.read())  # a fixed vocabulary

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if not hasattr(spec, "encode"):  # a broadcast outlives the task in its worker, and with it the words it has met
            spec.encode = word_encoder(spec.value)
        encode, last = spec.encode, np.array([end], "<u4").tobytes()
        seen, task = [0] * (limit + 1), TaskContext.get().partitionId()
        for batch in batches:
            for lo in range(0, batch.num_rows, 512):
                part = batch.slice(lo, 512)
                rows, start, length, crc, whole, nth, held = [], [], [], [], [], [], []
                for row, own_ids in enumerate(encode([value.as_py() or "" for value in part.column(1)])):
                    tokens = memoryview(own_ids + last)
                    at = 0
                    for size in cut_lengths(len(tokens) // 4, limit, unit):
                        own = tokens[4 * at : 4 * (at + size)]
                        rows.append(row)
                        start.append(at)
                        length.append(size)
                        crc.append(zlib.crc32(own))
                        whole.append(len(tokens) // 4)
                        nth.append(seen[size])
                        seen[size] += 1
                        if ids:
                            held.append(np.frombuffer(own, "<i4"))
                        at += size
                columns = [part.column(0).take(pa.array(rows, pa.int64()))]
                columns += [pa.array(c, pa.int64()) for c in (start, length, crc, whole)]
                names = ["key", "start", "length", "ids_crc32", "doc_tokens"]
                if ids:
                    columns.append(pa.array(held, pa.list_(pa.int32())))
                    names.append("ids")
                columns += [pa.array([task] * len(rows), pa.int32()), pa.array(nth, pa.int64())]
                yield pa.RecordBatch.from_arrays(columns, names=[*names, "part", "nth"])

    kind = dict(docs.select(quoted(key)).dtypes)[key]
    schema = f"key {kind}, start long, length long, ids_crc32 long, doc_tokens long" + ", ids array<int>" * ids + ", part int, nth long"
    rows = docs.select(quoted(key).alias("key"), quoted(text).cast("string").alias("text"))
    return rows.mapInArrow(cut, schema).withColumnRenamed("key", key)


def combinations(present: list[int], window: int, depth: int = DEPTH) -> list[tuple[int, ...]]:
    """All ascending tuples of at most ``depth`` lengths, of those ``present``, that add up to ``window``."""
    have = set(present)

    def grow(head: tuple[int, ...], least: int, rest: int, more: int) -> Iterator[tuple[int, ...]]:
        if rest in have and rest >= least:
            yield (*head, rest)
        if more > 1:
            for size in present[bisect_left(present, least) :]:
                if 2 * size > rest:
                    break
                yield from grow((*head, size), size, rest - size, more - 1)

    return list(grow((), 1, window, depth))


def nnls(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """x >= 0 that makes |a x - b| least: columns enter by their gradient, and leave when they would turn negative."""
    x, inside = np.zeros(a.shape[1]), np.zeros(a.shape[1], bool)
    enough = 1e-9 * max(1.0, float(np.abs(a.T @ b).max(initial=0)))
    for _ in range(8 * a.shape[0]):
        gradient = a.T @ (b - a @ x)
        gradient[inside] = 0
        best = int(np.argmax(gradient)) if len(gradient) else 0
        if not len(gradient) or gradient[best] <= enough:
            break
        inside[best] = True
        while True:
            some = np.flatnonzero(inside)
            solved = np.linalg.lstsq(a[:, some], b, rcond=None)[0]
            if (solved > 0).all():
                x[:] = 0
                x[some] = solved
                break
            falling = solved <= 0
            step = np.min(x[some][falling] / np.maximum(x[some][falling] - solved[falling], 1e-300))
            x[some] += step * (solved - x[some])
            gone = some[falling & (x[some] <= 1e-12 * max(1.0, float(b.max())))]
            x[gone] = 0
            inside[gone] = False
            if best in gone or not len(gone):
                return x
    return x


def filled(counts: dict[int, int], window: int, depth: int = DEPTH) -> list[tuple[tuple[int, ...], int]]:
    """(combination, how often) that fill windows of 1, 2, 4 ... ``window``; never more than ``counts`` holds."""
    sizes = sorted(s for s, n in counts.items() if n)
    columns, w = [], 1
    while w <= window and sizes:
        columns += combinations(sizes, w, depth)
        w *= 2
    if not columns:
        return []
    row = {s: i for i, s in enumerate(sizes)}
    a = np.zeros((len(sizes), len(columns)))
    for j, combination in enumerate(columns):
        for s in combination:
            a[row[s], j] += 1
    left = np.array([counts[s] for s in sizes], np.int64)
    x = nnls(a, left.astype(float))
    out = []
    for j in np.argsort(-x, kind="stable"):
        if x[j] < 0.5:
            break
        need = a[:, j].astype(np.int64)
        often = min(int(x[j] + 0.5), int((left[need > 0] // need[need > 0]).min()))
        if often:
            left -= often * need
            out.append((columns[j], often))
    return out


def best_fit(counts: dict[int, int], limit: int, room: int) -> list[tuple[list[tuple[int, int]], int, bool]]:
    """(lengths with their numbers, how many bins alike, whether it is the opened one) for all of ``counts``.

    Largest length first into the fullest bin that takes it. Bins that hold the same are
    one entry, so the work grows with the lengths, not with the counts. One bin is open
    with ``room`` left.
    """
    bins: dict[int, list[list]] = {room: [[[], 1, True]]} if room else {}
    rooms = sorted(bins)
    done = []

    def put(space: int, entry: list) -> None:
        if not space:
            done.append(tuple(entry))
            return
        if space not in bins:
            bins[space] = []
            rooms.insert(bisect_left(rooms, space), space)
        bins[space].append(entry)

    for size in sorted(counts, reverse=True):
        n = counts[size]
        while n:
            at = bisect_left(rooms, size)
            if at < len(rooms):
                space = rooms[at]
                held, alike, opened = bins[space].pop()
                if not bins[space]:
                    del bins[space], rooms[at]
            else:
                space, held, alike, opened = limit, [], n, False
            each = min(space // size, n)
            often = min(alike, n // each)
            if alike > often and (held or opened):
                put(space, [held, alike - often, opened])
            put(space - each * size, [[*held, (size, each)], often, opened])
            n -= often * each
    return done + [tuple(entry) for entries in bins.values() for entry in entries if entry[0]]


def plan(counts: dict[int, int], limit: int = LIMIT, unit: int = UNIT, depth: int = DEPTH) -> np.ndarray:
    """Where the pieces of each length go: rows (length, first rank, number side by side, base, stride).

    The r-th piece of a length, t = r - first rank, lies at token
    base + t // number * stride + t % number * length of all sequences laid end to end.
    """
    left = {length: int(n) for length, n in counts.items() if n}
    runs = [(((limit, 1),), left.pop(limit), limit)] if limit in left else []
    for scale, window in ((unit, limit // unit), (1, unit)):
        own = {length // scale: n for length, n in left.items() if (length % unit == 0) == (scale == unit)}
        for combination, often in filled(own, window, depth):
            times = {s * scale: combination.count(s) for s in combination}
            runs.append((tuple(times.items()), often, scale * sum(combination)))
            for length, n in times.items():
                left[length] -= often * n
    entries, at, ranks = [], 0, dict.fromkeys(counts, 0)

    def lay(held: list[tuple[int, int]], base: int, stride: int, often: int) -> None:
        for length, n in held:
            entries.append((length, ranks[length], n, base, stride))
            ranks[length] += often * n
            base += length * n

    for held, often, size in sorted(runs, key=lambda r: -r[2]):
        lay(held, at, size, often)
        at += often * size
    begun = at % limit
    after = at - begun + (limit if begun else 0)
    for held, often, opened in best_fit({length: n for length, n in left.items() if n}, limit, limit - begun if begun else 0):
        lay(held, at if opened else after, limit, often)
        after += 0 if opened else often * limit
    return np.array(sorted(entries), np.int64).reshape(-1, 5)


def pack(pieces: DataFrame, *, limit: int = LIMIT, unit: int = UNIT, depth: int = DEPTH) -> DataFrame:
    """``pieces`` as ``tokenise`` gives them, with sequence_id and offset in place of part and nth.

    Every piece is placed once; offsets are gapless from 0; no sequence holds more than
    ``limit`` tokens. All sequences are full but the last of the exact windows and some of
    the best-fitted residual. The empty table gives an empty result; repeated rows are pieces of
    their own.

    Only the histogram (at most ``limit / unit + unit`` rows) reaches the driver, and the plan
    sent to the tasks holds a few entries for each of its lengths, whatever the corpus.
    A hot length is no hot key: ranks come from counts by task.
    """
    if limit & (limit - 1) or unit & (unit - 1) or not 0 < unit <= limit:
        raise ValueError("limit and unit must be powers of two, the unit within the limit")
    rows = staged(pieces)
    held = rows.groupBy("part", "length").agg(F.count("*").alias("n"))
    earlier = Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    held = staged(held.withColumn("before", F.coalesce(F.sum("n").over(earlier), F.lit(0))))
    histogram = {r.length: r.n for r in held.groupBy("length").agg(F.sum("n").alias("n")).collect()}
    entries = rows.sparkSession.sparkContext.broadcast(plan(histogram, limit, unit, depth))

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        length, first, number, base, stride = entries.value.T
        starts = (length << 48) | first
        for batch in batches:
            own, rank = (batch.column(batch.num_columns - i).to_numpy() for i in (2, 1))
            at = np.searchsorted(starts, (own << 48) | rank, "right") - 1
            t = rank - first[at]
            token = base[at] + t // number[at] * stride[at] + t % number[at] * own
            columns = [*batch.columns[:-2], pa.array(token // limit), pa.array(token % limit)]
            yield pa.RecordBatch.from_arrays(columns, names=[*batch.schema.names[:-2], "sequence_id", "offset"])

    kept = [c for c in rows.columns if c not in ("part", "nth")]
    numbered = [quoted(c).alias(f"c{i}") for i, c in enumerate(kept)]  # numbered, so none can clash
    ranked = rows.join(held.select("part", "length", "before"), ["part", "length"])
    ranked = ranked.select(*numbered, F.col("length").alias("own"), (F.col("before") + F.col("nth")).alias("rank"))
    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in ranked.schema.fields[:-2])
    placed = ranked.mapInArrow(place, f"{schema}, sequence_id long, offset long")
    return placed.select(*[F.col(f"c{i}").alias(c) for i, c in enumerate(kept)], "sequence_id", "offset")


def padding(lengths: dict[int, int], limit: int = LIMIT) -> int:
    """Tokens of padding of sequences {length: how many}: up to ``limit``, none at a power of two."""
    return sum(n * (limit - length) for length, n in lengths.items() if length & (length - 1))



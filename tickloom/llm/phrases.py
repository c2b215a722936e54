"""Collocations: exact counts of all frequent phrases, found through Misra-Gries summaries.

The first passes summarise, words and pairs first, then longer phrases made of pairs that
survived. Every run of so many words within a piece is hashed with its language, and the
hash range is cut into partitions of bounded mass. Tasks keep, for
each partition, a Misra-Gries summary: when it has more counters than its capacity,
the count of the first one beyond is taken from all, and those left with nothing go.
Summaries of tasks are merged by adding and cutting once more. The capacity exceeds a
partition's mass divided by the threshold, so that all that is ever taken from one counter
stays below the threshold; what was taken is added up and checked, and should hot
phrases ever spread so unevenly that it is not, the pass is done again with twice the capacity.
Hence no frequent phrase is lost.

The last pass counts the survivors exactly, by their texts, in all documents.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from tickloom.llm.common import quoted
from tickloom.llm.components import bitmap, maybe_in, roomy
from tickloom.session import staged

LONGEST = 4
MIN_COUNT = 30
PERCENT = 80
TOP = 2000
SCALE = 2_000_000
PARTITION_MASS = 2_000_000  # occurrences of a hash partition, about
HELD = 2_000_000  # counters or occurrences a task holds before it merges or hands on
NAMED = 1_000_000  # texts of phrases a task holds before it hands them on
COMBINED = 32_000_000  # words whose exact counts one task combines, about
BLOCK = 500_000  # words hashed at a time
RANKS = (4096, 64)  # groups in which the first of a language are found before they meet

Known = tuple[np.ndarray, int]  # a bitmap of coded hashes, and their number of partitions
_P = np.uint64(0x9E3779B97F4A7C15)
_LOWER = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))
_ENDS = np.isin(np.arange(256), [ord(c) for c in ".,;:!?\n\x0b\x0c\r"])
_GAPS = _ENDS | np.isin(np.arange(256), [9, 32])


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _words(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First and end byte of every word."""
    inside = np.zeros(len(data) + 2, bool)
    inside[1:-1] = ~_GAPS[data]
    border = np.flatnonzero(inside[1:] != inside[:-1])
    return border[::2], border[1::2]


class Phrases:
    """Hashes of the phrases of some texts, for each of the ``sizes`` (in words), block by block.

    Where a bitmap of ``known`` hashes is given, phrases of more than two words come only
    where all pairs of neighbours in them are known: a longer phrase is no more frequent.
    """

    def __init__(self, sizes: Sequence[int], known: Known | None = None):
        self.sizes, self.known = sizes, known
        self.powers = np.cumprod(np.full(256, _P, np.uint64))

    def _hashed(self, data: np.ndarray, start: np.ndarray, stop: np.ndarray) -> np.ndarray:
        size = stop - start
        most = int(size.max(initial=1))
        if most > len(self.powers):
            self.powers = np.cumprod(np.full(2 * most, _P, np.uint64))
        first = np.cumsum(size) - size
        place = np.arange(int(size.sum())) - np.repeat(first, size)
        values = data[np.repeat(start, size) + place].astype(np.uint64) + np.uint64(1)
        return _mixed(np.add.reduceat(values * self.powers[place], first) + size.astype(np.uint64))

    def __call__(self, texts: list[bytes], salts: list[int]) -> Iterator[tuple[int, np.ndarray, np.ndarray, np.ndarray, np.ndarray, bytes]]:
        """(words, hashes, first byte, end byte, text number) of the phrases, and the bytes they lie in.

        Lower-cased texts stand one after the other with a piece's end between them. Blocks
        overlap by the words that a phrase can reach over, so memory beside the texts'
        own bytes and word borders is bounded.
        """
        joined = b"\n".join(texts).translate(_LOWER)
        data = np.frombuffer(joined, np.uint8)
        start, stop = _words(data)
        ends = np.flatnonzero(_ENDS[data])
        text_ends = np.cumsum([len(t) + 1 for t in texts])
        salt = np.array(salts, np.uint64)
        longest = max(self.sizes)
        for lo in range(0, len(start), BLOCK):
            own = min(BLOCK, len(start) - lo)  # phrases that start beyond are the next block's
            s, e = start[lo : lo + own + longest - 1], stop[lo : lo + own + longest - 1]
            words = self._hashed(data, s, e)
            piece, text = np.searchsorted(ends, s), np.searchsorted(text_ends, s, "right")
            rolled = _mixed(words + salt[text])
            fine = pairs = None
            for n in range(1, longest + 1):
                m = len(s) - n + 1
                if m <= 0:
                    break
                if n > 1:
                    rolled = _mixed(rolled[:m] * _P + words[n - 1 :])
                    fine = piece[:m] == piece[n - 1 :] if self.known is None or n == 2 else fine[:m] & pairs[n - 2 : n - 2 + m]
                if n == 2 and self.known is not None and longest > 2:
                    pairs = fine & _is_known(rolled, self.known)
                if n in self.sizes:
                    at = np.arange(min(m, own)) if fine is None else np.flatnonzero(fine[:own])
                    yield n, rolled[at], s[at], e[at + n - 1], text[at], joined
                if n == 2 and pairs is not None:
                    fine = pairs


def _salt(lang: str) -> int:
    """A number for a language, mixed into its hashes."""
    out = 1469598103934665603
    for b in lang.encode("utf-8", "surrogatepass"):
        out = (out ^ b) * 1099511628211 % (1 << 64)
    return out


def _coded(hashes: np.ndarray, parts: int) -> np.ndarray:
    """The hash partition, one of equal ranges of the upper half, and the lower half.

    Enough to tell the phrases of a partition apart, whose number is bounded; two that fall
    together have the sum of their counts, so neither is lost.
    """
    part = ((hashes >> np.uint64(32)) * np.uint64(parts)) >> np.uint64(32)
    return (part << np.uint64(32)) | (hashes & np.uint64(0xFFFFFFFF))


def _is_known(hashes: np.ndarray, known: Known) -> np.ndarray:
    bits, parts = known
    return maybe_in(_coded(hashes, parts).view(np.int64), bits)


def _added(hashes: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct hashes and the sums of their counts."""
    order = np.argsort(hashes, kind="stable")
    hashes, counts = hashes[order], counts[order]
    first = np.flatnonzero(np.diff(hashes, prepend=hashes[:1] ^ np.uint64(1)) != 0) if len(hashes) else np.zeros(0, np.int64)
    return hashes[first], np.add.reduceat(counts, first) if len(first) else counts


def cut(counts: np.ndarray, capacity: int) -> int:
    """What a summary with these counters must take from each to keep at most ``capacity``."""
    return int(np.partition(counts, len(counts) - capacity - 1)[len(counts) - capacity - 1]) if len(counts) > capacity else 0


class Summaries:
    """One Misra-Gries summary per hash partition, all in one sorted array of coded hashes."""

    def __init__(self, capacity: int):
        self.capacity = capacity
        self.hashes, self.counts = np.zeros(0, np.uint64), np.zeros(0, np.int64)
        self.taken: dict[int, int] = {}

    def add(self, hashes: np.ndarray, counts: np.ndarray) -> None:
        self.hashes, self.counts = _added(np.concatenate([self.hashes, hashes]), np.concatenate([self.counts, counts]))
        for p, lo, hi in self.ranges():
            less = cut(self.counts[lo:hi], self.capacity)
            if less:
                self.counts[lo:hi] -= less
                self.taken[p] = self.taken.get(p, 0) + less
        some = self.counts > 0
        if not some.all():
            self.hashes, self.counts = self.hashes[some], self.counts[some]

    def ranges(self) -> list[tuple[int, int, int]]:
        part = self.hashes >> np.uint64(32)
        first = np.flatnonzero(np.diff(part, prepend=part[:1] + np.uint64(1)) != 0).tolist()
        return [(int(part[lo]), lo, hi) for lo, hi in zip(first, [*first[1:], len(part)])]

    def handed_on(self) -> Iterator[pa.RecordBatch]:
        """A row per partition: its counters, and what was taken from each; empties the summaries."""
        for p, lo, hi in self.ranges():
            yield self._row(p, self.hashes[lo:hi], self.counts[lo:hi], self.taken.pop(p, 0))
        for p, taken in self.taken.items():
            yield self._row(p, self.hashes[:0], self.counts[:0], taken)
        self.hashes, self.counts, self.taken = self.hashes[:0], self.counts[:0], {}

    @staticmethod
    def _row(p: int, hashes: np.ndarray, counts: np.ndarray, taken: int) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays(
            [pa.array([p], pa.int64()), pa.array([hashes.astype(np.uint32).tobytes()], pa.binary()), pa.array([counts.tobytes()], pa.binary()), pa.array([taken], pa.int64())],
            names=["part", "hashes", "counts", "taken"],
        )


def _texts(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[list[str], list[bytes], list[int]]]:
    """Languages, texts and salts, some megabytes or one long text at a time."""
    salts: dict[str, int] = {}
    for batch in batches:
        langs, texts, size = [], [], 0
        for lang, text in zip(batch.column(0), batch.column(1), strict=True):
            langs.append(lang.as_py())
            texts.append(text.as_py())
            size += len(texts[-1])
            if size > 4 << 20:
                yield langs, texts, [salts.setdefault(x, _salt(x)) for x in langs]
                langs, texts, size = [], [], 0
        if texts:
            yield langs, texts, [salts.setdefault(x, _salt(x)) for x in langs]


def survivors(
    rows: DataFrame, mass: int, sizes: Sequence[int], parts: int, *, known: Known | None = None, min_count: int = MIN_COUNT
) -> DataFrame:
    """(hash: coded) of all phrases of ``rows`` (lang, text: binary) that may occur ``min_count`` times; all that do are there.

    ``mass`` is at least the number of occurrences of phrases of these ``sizes``, and
    ``parts`` the number of hash partitions; ``known`` is for ``Phrases``. Summaries that a task can hold
    in any case are not made smaller than that.
    """
    held = None if known is None else rows.sparkSession.sparkContext.broadcast(known)
    capacity = max(mass // parts // min_count + 1, 2 * HELD // parts)
    capacity += capacity // 8 + 64  # hashes deal the mass nearly evenly

    def summed(capacity: int):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            phrases, summaries, waiting, n = Phrases(sizes, held and held.value), Summaries(capacity), [], 0

            def add() -> None:
                hashes = _coded(np.concatenate(waiting), parts)
                waiting.clear()
                summaries.add(*np.unique(hashes, return_counts=True))

            for _, texts, salts in _texts(batches):
                for _, hashes, *_ in phrases(texts, salts):
                    waiting.append(hashes)
                    n += len(hashes)
                if n > HELD:
                    add()
                    n = 0
                    if len(summaries.hashes) > HELD:
                        yield from summaries.handed_on()
            if waiting:
                add()
            yield from summaries.handed_on()

        return run

    def merged(capacity: int):
        def run(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
            hashes = np.concatenate([np.frombuffer(b, np.uint32) for b in rows["hashes"]]).astype(np.uint64) | np.uint64(key[0] << 32)
            counts = np.concatenate([np.frombuffer(b, np.int64) for b in rows["counts"]])
            hashes, counts = _added(hashes, counts)
            less = cut(counts, capacity)
            taken = int(rows["taken"].sum()) + less
            some = (counts > less) & (counts - less + taken >= min_count)  # the others' true count is too low
            return pd.DataFrame({"taken": [taken], "hashes": [hashes[some].tobytes()]})

        return run

    while True:
        made = rows.mapInArrow(summed(capacity), "part long, hashes binary, counts binary, taken long")
        summaries = staged(made.groupBy("part").applyInPandas(merged(capacity), "taken long, hashes binary"))
        if (summaries.agg(F.max("taken")).first()[0] or 0) < min_count:
            break
        capacity *= 2

    def flat(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for packed in batch.column(0):
                yield pa.RecordBatch.from_arrays([pa.array(np.frombuffer(packed.as_py(), np.int64))], names=["hash"])

    return summaries.select("hashes").mapInArrow(flat, "hash long")


class _Counts:
    """Counts of the phrases a task has met, and for each new hash its text."""

    def __init__(self) -> None:
        self.hashes, self.counts, self.at = np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(0, np.int64)
        self.langs: list[str] = []
        self.phrases: list[bytes] = []
        self.words = bytearray()

    def add(self, words: int, hashes: np.ndarray, start: np.ndarray, stop: np.ndarray, langs: np.ndarray, joined: bytes) -> None:
        found, first, n = np.unique(hashes, return_index=True, return_counts=True)
        place = np.searchsorted(self.hashes, found)
        known = np.append(self.hashes, np.uint64(0))[place] == found
        known &= place < len(self.hashes)
        self.counts[place[known]] += n[known]
        new = np.flatnonzero(~known)
        at = first[new]
        self.phrases += [b" ".join(joined[lo:hi].split()) for lo, hi in zip(start[at].tolist(), stop[at].tolist(), strict=True)]
        self.langs += langs[at].tolist()
        self.words += bytes([words]) * len(new)
        self.at = np.insert(self.at, place[new], np.arange(len(self.phrases) - len(new), len(self.phrases)))
        self.hashes = np.insert(self.hashes, place[new], found[new])
        self.counts = np.insert(self.counts, place[new], n[new])

    def handed_on(self) -> pa.RecordBatch:
        counts = np.zeros(len(self.phrases), np.int64)
        counts[self.at] = self.counts
        words = np.frombuffer(bytes(self.words), np.uint8).astype(np.int32)
        columns = [pa.array(self.langs, pa.string()), pa.array([p.decode("utf-8", "replace") for p in self.phrases], pa.string()), pa.array(words), pa.array(counts)]
        self.__init__()
        return pa.RecordBatch.from_arrays(columns, names=["lang", "phrase", "words", "n"])


def _counted(rows: DataFrame, kept: Known, longest: int, total: int) -> DataFrame:
    """(lang, phrase, words, n): the counts per task of all phrases that may be among those kept.

    A frequent phrase is a row of each task that meets it. So the ``total`` words are not
    dealt by the many splits of the input, but to as many tasks as run at once, or to a
    multiple of that where a task's share would be too long.
    """
    context = rows.sparkSession.sparkContext
    held, cores = context.broadcast(kept), context.defaultParallelism
    rows = rows.coalesce(cores * max(1, -(-total // (cores * COMBINED))))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        phrases, counts = Phrases(range(1, longest + 1), held.value), _Counts()
        for langs, texts, salts in _texts(batches):
            named = np.array(langs, object)
            for words, hashes, start, stop, text, joined in phrases(texts, salts):
                some = np.flatnonzero(_is_known(hashes, held.value))
                counts.add(words, hashes[some], start[some], stop[some], named[text[some]], joined)
                if len(counts.phrases) > NAMED:
                    yield counts.handed_on()
        yield counts.handed_on()

    return rows.mapInArrow(run, "lang string, phrase string, words int, n long")


def _totals(rows: DataFrame) -> DataFrame:
    """(lang, n): all words of each language."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for langs, texts, _ in _texts(batches):
            joined = np.frombuffer(b"\n".join(texts), np.uint8)
            text = np.searchsorted(np.cumsum([len(t) + 1 for t in texts]), _words(joined)[0], "right")
            yield pa.RecordBatch.from_arrays([pa.array(langs, pa.string()), pa.array(np.bincount(text, minlength=len(langs)))], names=["lang", "n"])

    return rows.mapInArrow(run, "lang string, n long").groupBy("lang").agg(F.sum("n").alias("n"))


def _marked(hashes: DataFrame, parts: int) -> Known:
    """A bitmap of 32 bits or more for each hash, 32 MB at most; it only spares work, and may hold more."""
    return bitmap(hashes, roomy(hashes.count(), 1 << 28)), parts


def frequent_phrases(rows: DataFrame, words: int, *, longest: int = LONGEST, min_count: int = MIN_COUNT, partition_mass: int = PARTITION_MASS) -> DataFrame:
    """(lang, phrase, words, f): every phrase of up to ``longest`` words that occurs ``min_count`` times, exactly counted.

    Words and pairs are summarised first, then longer phrases whose pairs all survived.
    In the exact pass a phrase is counted in all texts or in none.
    """
    short = min(longest, 2)
    parts = max(1, -(-words * short // partition_mass))
    found = staged(survivors(rows, words * short, range(1, short + 1), parts, min_count=min_count))
    if longest > 2:
        more = survivors(rows, words * (longest - 2), range(3, longest + 1), parts, known=_marked(found, parts), min_count=min_count)
        found = staged(found.unionAll(more))
    counts = _counted(rows, _marked(found, parts), longest, words).groupBy("lang", "phrase", "words").agg(F.sum("n").alias("f"))
    return counts.where(F.col("f") >= min_count)


def _wide(count: Column | str) -> Column:
    return (F.col(count) if isinstance(count, str) else count).cast("decimal(28,0)")


def collocations(
    docs: DataFrame,
    *,
    text: str = "text",
    lang: str = "lang",
    unknown: str = "und",
    longest: int = LONGEST,
    min_count: int = MIN_COUNT,
    percent: int = PERCENT,
    top: int = TOP,
    partition_mass: int = PARTITION_MASS,
) -> DataFrame:
    """The first ``top`` collocations of each language: lang, rank, phrase, a, l, r, n, score.

    A-Z are lower-cased; texts fall into pieces at ``.,;:!?`` and line ends, pieces into
    words at spaces and tabs. A phrase of 2 to ``longest`` words with a >= ``min_count``
    occurrences within pieces is a candidate; cut after its first k words into parts
    with l and r occurrences, it scores floor(2000000 a / (l + r)), and the cut that scores
    lowest counts (the first of equal ones). Candidates inside a longer phrase that has
    at least ``percent`` of 100 of their occurrences are dropped. n counts all words.
    Equal scores are ordered by a, then by the bytes of the phrase.

    A NULL language is ``unknown``, NULL text is empty; repeated rows count each time;
    other columns are not read. No text, or no frequent phrase, gives an empty result.
    Texts are read whole, one long text or some megabytes of short ones at a time; a task holds
    some ten bytes for each byte of those.
    A hot phrase is one counter of each task; a hot language is cut by hash like any other,
    also where its first phrases are found. Hashes have 64 bits; phrases of one task count as
    equal when theirs are.
    """
    rows = docs.select(F.coalesce(quoted(lang).cast("string"), F.lit(unknown)).alias("lang"), F.coalesce(quoted(text).cast("string"), F.lit("")).cast("binary").alias("text"))
    totals = staged(_totals(rows))
    words = totals.agg(F.sum("n")).first()[0] or 0
    frequent = staged(frequent_phrases(rows, words, longest=longest, min_count=min_count, partition_mass=partition_mass))
    several = frequent.where("words > 1")

    word = F.split("phrase", " ")
    run = lambda first, n: F.array_join(F.slice(word, first, n), " ")
    k = F.col("k")
    cuts = several.withColumn("k", F.explode(F.sequence(F.lit(1), F.col("words") - 1)))
    cuts = cuts.select("lang", "phrase", F.col("f").alias("a"), "k", run(F.lit(1), k).alias("head"), run(k + 1, F.col("words") - k).alias("rest"))
    part = lambda name, n: frequent.select("lang", F.col("phrase").alias(name), F.col("f").alias(n))
    cuts = cuts.join(part("head", "l"), ["lang", "head"]).join(part("rest", "r"), ["lang", "rest"])
    cuts = cuts.withColumn("wide", _wide("a") * F.lit(SCALE)).withColumn("both", _wide("l") + _wide("r"))
    order = F.expr("wide div both") * longest + k
    best = cuts.withColumn("order", order).groupBy("lang", "phrase").agg(
        F.min("a").alias("a"), F.min("order").alias("order"), F.min_by("l", "order").alias("l"), F.min_by("r", "order").alias("r")
    )
    scored = best.withColumn("score", F.expr(f"(order - 1) div {longest}"))

    inner = F.flatten(F.transform(F.sequence(F.lit(2), F.col("words") - 1), lambda n: F.transform(F.sequence(F.lit(1), F.col("words") - n + 1), lambda i: run(i, n))))
    longer = frequent.where("words > 2").select("lang", F.explode(inner).alias("phrase"), "f")
    covers = longer.groupBy("lang", "phrase").agg(F.max("f").alias("cover"))
    covered = _wide(F.coalesce("cover", F.lit(0))) * 100 >= _wide("a") * percent
    rest = scored.join(covers, ["lang", "phrase"], "left").where(~covered)

    # the first of a language: those of many groups, of few, then of all
    ranked = rest.withColumn("_group", F.pmod(F.xxhash64("phrase"), F.lit(RANKS[0])))
    for groups in (*RANKS, 1):
        keys = ["lang"] if groups == 1 else ["lang", F.col("_group") % groups]
        by = Window.partitionBy(*keys).orderBy(F.desc("score"), F.desc("a"), "phrase")
        ranked = ranked.withColumn("rank", F.row_number().over(by).cast("long")).where(F.col("rank") <= top)
    return ranked.join(totals, "lang").select("lang", "rank", "phrase", "a", "l", "r", "n", "score")

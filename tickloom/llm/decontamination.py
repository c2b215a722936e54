"""Benchmark decontamination by SimHash of item-sized windows.

Items and texts are read as words (letters and digits, any case, punctuation around
them dropped) and compared by the five-word shingles in an item and in a window of as
many words as the item has, or with the whole text where that is shorter. A window's fingerprint is the SimHash of its shingles, each
weighing as many units as its words have characters. The items' fingerprints are
indexed in four tables, one per 16-bit block: two fingerprints within ``RADIUS`` of 64 bits
are within a quarter of that in some block, so the tables return every item within the
radius. Those are verified by the exact weighted Jaccard similarity of the two bags of
shingles.

Most windows share no shingle with any item, and a window whose shared shingles weigh
too little cannot reach the threshold; both are passed over before a fingerprint is
made, without loss. Benchmarks of any size are used in blocks of bounded size, each
against all texts.
"""

from __future__ import annotations

import zlib
from collections import Counter, defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.pandas.functions import ArrowUDFType

from tickloom.llm.common import fresh, quoted

WORDS = 5
LEAST = 0.8
RADIUS = 23  # of 64 bits; at the threshold the expected distance is under 10, its deviation about 3
BLOCK_WORDS = 2_000_000  # words of the benchmark that are indexed at once

_M1, _M2 = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)
_P = np.uint64(0x9E3779B97F4A7C15)


def plain(token: str) -> str:
    """A lower-case token without what stands around its letters and digits."""
    start, stop = 0, len(token)
    while start < stop and not token[start].isalnum():
        start += 1
    while stop > start and not token[stop - 1].isalnum():
        stop -= 1
    return token[start:stop]


def words_of(text: str | None) -> list[str]:
    return [w for w in map(plain, (text or "").lower().split()) if w]


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * _M1
    x = (x ^ (x >> np.uint64(27))) * _M2
    return x ^ (x >> np.uint64(31))


def word_number(word: str) -> int:
    """64 bits for a word: two checksums of its bytes."""
    data = word.encode("utf-8", "surrogatepass")
    return zlib.crc32(data) | (zlib.crc32(data, 0x5BD1E995) << 32)


def shingles(numbers: np.ndarray, sizes: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes and weights of the runs of ``k`` words."""
    n = len(numbers) - k + 1
    rolled, weight = np.full(n, k, np.uint64), np.zeros(n, np.int64)
    for i in range(k):
        rolled = rolled * _P + numbers[i : i + n]
        weight += sizes[i : i + n]
    return _mixed(rolled), weight


def _spread(hashes: np.ndarray, weight: np.ndarray) -> np.ndarray:
    """(n x 64): a shingle's weight, negative where its hash has a 0."""
    bits = np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
    return (bits.astype(np.int64) * 2 - 1) * weight[:, None]


def _pack(sums: np.ndarray) -> np.ndarray:
    """Fingerprints from summed weights, as four blocks of 16 bits."""
    return np.packbits(sums > 0, axis=1, bitorder="little").view(np.uint16)


def _in(values: np.ndarray, known: np.ndarray) -> np.ndarray:
    """Which values are in a sorted array."""
    return known[np.minimum(np.searchsorted(known, values), len(known) - 1)] == values


class Tables:
    """Items of one size in words, by the blocks of their fingerprints."""

    def __init__(self, items: list[int], prints: np.ndarray):
        self.items, self.prints = np.array(items), prints
        self.values, self.slots = [], []
        for j in range(4):
            values, slot = np.unique(prints[:, j], return_inverse=True)
            self.values.append(values)  # at most 2**16
            order = np.argsort(slot, kind="stable")
            self.slots.append((order, np.searchsorted(slot[order], np.arange(len(values) + 1))))

    def near(self, own: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(row of ``own``, item) for all fingerprints within the radius of each other."""
        pairs = []
        for j in range(4):
            order, cut = self.slots[j]
            row, value = np.nonzero(np.bitwise_count(self.values[j][None, :] ^ own[:, j, None]) <= RADIUS // 4)
            many = cut[value + 1] - cut[value]
            first = np.repeat(cut[value] - np.concatenate([[0], np.cumsum(many)[:-1]]), many)
            pairs.append(np.repeat(row, many) * len(order) + order[first + np.arange(many.sum())])
        row, at = np.divmod(np.unique(np.concatenate(pairs)), len(self.items))
        close = np.bitwise_count(self.prints[at] ^ own[row]).sum(axis=1) <= RADIUS
        return row[close], self.items[at[close]]


class Index:
    """A block of a benchmark: its shingles, and tables of fingerprints by item size."""

    def __init__(self, texts: list[str], least: float = LEAST):
        self.least = least
        self.vocabulary: dict[str, int] = {}
        self.bags: list[Counter] = []
        self.weights: list[int] = []
        self.lengths: list[int] = []
        by_size: dict[int, list[int]] = defaultdict(list)
        prints, known = [], defaultdict(set)
        for n, text in enumerate(texts):
            words = words_of(text)
            for w in words:
                self.vocabulary.setdefault(w, len(self.vocabulary) + 1)
            numbers = np.array([word_number(w) for w in words], np.uint64)
            sizes = np.array([len(w) for w in words], np.int64)
            k = min(WORDS, len(words))
            hashes, weight = shingles(numbers, sizes, k) if k else (np.zeros(0, np.uint64), np.zeros(0, np.int64))
            self.bags.append(Counter(hashes.tolist()))
            self.weights.append(int(weight.sum()))
            self.lengths.append(len(words))
            prints.append(_pack(_spread(hashes, weight).sum(axis=0)[None, :])[0])
            if k:
                by_size[len(words)].append(n)
                known[k].update(hashes.tolist())
        self.numbers = np.array([0, *map(word_number, self.vocabulary)], np.uint64)
        self.sizes = np.array([0, *map(len, self.vocabulary)], np.int64)
        self.known = {k: np.array(sorted(v), np.uint64) for k, v in known.items()}
        self.known_by_size = {w: np.array(sorted({h for n in own for h in self.bags[n]}), np.uint64) for w, own in by_size.items()}
        self.tables = {w: Tables(own, np.array([prints[n] for n in own])) for w, own in by_size.items()}
        self.lightest = {w: min(self.weights[n] for n in own) for w, own in by_size.items()}

    def leaks(self, tokens: list[str], codes: np.ndarray) -> dict[int, tuple[float, int]]:
        """Item -> (similarity, first word) of its most similar window, where it reaches the threshold.

        ``codes`` number the words as ``Words`` does, 0 for words that the benchmark lacks.
        """
        best: dict[int, tuple[float, int]] = {}
        inside = codes > 0
        for k, known in self.known.items():
            n = len(codes) - k + 1
            if n < 1:
                continue
            runs = inside[:n].copy()
            for i in range(1, k):
                runs &= inside[i : i + n]
            at = np.flatnonzero(runs)
            if not len(at):
                continue
            rolled, weight = np.full(len(at), k, np.uint64), np.zeros(len(at), np.int64)
            for i in range(k):
                code = codes[at + i]
                rolled = rolled * _P + self.numbers[code]
                weight += self.sizes[code]
            rolled = _mixed(rolled)
            hit = _in(rolled, known)
            if hit.any():
                self._windows(k, tokens, codes, at[hit], rolled[hit], weight[hit], best)
        return best

    def _windows(self, k: int, tokens: list[str], codes: np.ndarray, at: np.ndarray, found: np.ndarray, worth: np.ndarray, best: dict) -> None:
        hashes = weight = None
        for w, tables in self.tables.items():
            if min(WORDS, w) != k:
                continue
            span = min(w, len(codes))  # a text shorter than the item is its only window
            mine = _in(found, self.known_by_size[w])
            if not mine.any():
                continue
            hits, total = at[mine], np.concatenate([[0], np.cumsum(worth[mine])])
            need = self.least * self.lightest[w]  # of shared shingles in a window
            starts = np.unique((hits[:, None] - np.arange(span - k + 1)[None, :]).ravel())
            starts = starts[(starts >= 0) & (starts + span <= len(codes))]
            lo, hi = np.searchsorted(hits, starts), np.searchsorted(hits, starts + (span - k), side="right")
            starts = starts[total[hi] - total[lo] >= need]
            if not len(starts):
                continue
            if hashes is None:
                numbers, sizes = self.numbers[codes], self.sizes[codes]
                for i in np.flatnonzero(codes == 0):
                    word = plain(tokens[i])
                    numbers[i], sizes[i] = word_number(word), len(word)
                hashes, weight = shingles(numbers, sizes, k)
            for part in np.split(starts, np.flatnonzero(np.diff(starts) > 4 * span) + 1):
                first, last = part[0], part[-1] + span - k + 1
                sums = np.zeros((last - first + 1, 64), np.int64)
                np.cumsum(_spread(hashes[first:last], weight[first:last]), axis=0, out=sums[1:])
                rows, items = tables.near(_pack(sums[part - first + span - k + 1] - sums[part - first]))
                for start, item in zip(part[rows].tolist(), items.tolist(), strict=True):
                    if best.get(item, (0.0, 0))[0] < 1.0:
                        score = self.similarity(item, hashes, weight, start, span - k + 1)
                        if score >= self.least and score > best.get(item, (0.0, 0))[0]:
                            best[item] = score, start

    def similarity(self, item: int, hashes: np.ndarray, weight: np.ndarray, start: int, n: int) -> float:
        """Weighted Jaccard similarity of an item's bag and a window's."""
        bag = Counter(hashes[start : start + n].tolist())
        worth = dict(zip(hashes[start : start + n].tolist(), weight[start : start + n].tolist(), strict=True))
        own = self.bags[item]
        both = sum(worth[h] * min(c, own[h]) for h, c in bag.items() if h in own)
        return both / (self.weights[item] + sum(worth[h] * c for h, c in bag.items()) - both)


class Words(dict):
    """token -> its word's number in the benchmark, 0 for other words, -1 for tokens without letters or digits."""

    def __init__(self, vocabulary: dict[str, int], most: int = 600_000):
        super().__init__()
        self.vocabulary, self.most = vocabulary, most

    def __missing__(self, token: str) -> int:
        if len(self) >= self.most:
            self.clear()
        word = plain(token)
        value = self[token] = self.vocabulary.get(word, 0) if word else -1
        return value


def find_in(text: str | None, index: Index, words: Words) -> list[dict]:
    """The items that leak into a text, each with its best window."""
    tokens = (text or "").lower().split()
    codes = np.fromiter(map(words.__getitem__, tokens), np.int64, len(tokens))
    real = codes >= 0
    if not real.all():
        codes, tokens = codes[real], [t for t, r in zip(tokens, real, strict=True) if r]
    found = index.leaks(tokens, codes)
    return [{"at": i, "start": s, "n_words": min(index.lengths[i], len(tokens)), "similarity": sim} for i, (sim, s) in sorted(found.items())]


def leaks(text: Column, docs: DataFrame, items: DataFrame, *, item: str = "item_id", body: str = "text", least: float = LEAST) -> Column:
    """array of (item_id, start, n_words, similarity): the items found in a text, with their best window.

    An item is found where a window of as many words, or the whole of a shorter text,
    reaches the weighted similarity ``least``; of equally similar windows the first counts. Items of fewer than five
    words are compared as a whole, items without words (NULL, empty) are never found.
    Items alike in id and text count once, others that share an id are reported each.
    Texts without words give the empty array.
    """
    own = items.select(quoted(item).cast("long").alias("item_id"), quoted(body).cast("string").alias("text")).where("text is not null").distinct()
    total = own.agg(F.sum(F.size(F.split("text", r"\s+")).cast("long"))).first()[0] or 0
    blocks = -(-total // BLOCK_WORDS)
    own = own.withColumn("block", F.pmod(F.xxhash64("item_id", "text"), F.lit(max(blocks, 1))))
    kind = pa.struct([("item_id", pa.int64()), ("start", pa.int64()), ("n_words", pa.int64()), ("similarity", pa.float64())])
    out = F.array().cast("array<struct<item_id: bigint, start: bigint, n_words: bigint, similarity: double>>")
    for block in range(blocks):
        rows = own.where(F.col("block") == block).orderBy("item_id", "text").select("item_id", "text").collect()  # about BLOCK_WORDS words
        ids = [r.item_id for r in rows]
        held = docs.sparkSession.sparkContext.broadcast((ids, [r.text for r in rows]))

        def search(batches: Iterator[pa.Array], held=held) -> Iterator[pa.Array]:
            ids, texts = held.value
            index = Index(texts, least)
            words = Words(index.vocabulary)
            for batch in batches:
                found = (find_in(t.as_py(), index, words) for t in batch)
                yield pa.array([[{"item_id": ids[f.pop("at")], **f} for f in row] for row in found], pa.list_(kind))

        out = F.concat(out, F.arrow_udf(search, "array<struct<item_id: bigint, start: bigint, n_words: bigint, similarity: double>>", ArrowUDFType.SCALAR_ITER)(text))
    return out


def find_leaks(docs: DataFrame, items: DataFrame, *, key: str = "doc_id", text: str = "text", least: float = LEAST) -> DataFrame:
    """One row per document and item found in it: doc_id, item_id, start, n_words, similarity.

    One map over the documents per block of the benchmark, no shuffle: a passage in a
    third of all documents is met in each of them on its own.
    """
    found = docs.select(quoted(key).alias("doc_id"), F.explode(leaks(quoted(text).cast("string"), docs, items, least=least)).alias("f"))
    return found.select("doc_id", "f.item_id", "f.start", "f.n_words", "f.similarity")


def without_leaks(docs: DataFrame, items: DataFrame, *, text: str = "text", least: float = LEAST) -> DataFrame:
    """The rows of ``docs`` in whose text no item is found."""
    (found,) = fresh(docs, "_leaks")
    marked = docs.withColumn(found, leaks(quoted(text).cast("string"), docs, items, least=least))
    return marked.where(F.size(found) == 0).drop(found)

"""Fill-in-middle rearrangement of texts, cut by an indexable skip list over their units.

A unit is a run of the letters A-Z, a-z or one other code point. The units of a text lie in
a skip list: the lowest lane links each unit to the next, and every lane above holds
about one of ``FAN`` nodes of the lane below, chosen by a hash of its rank. Each link
carries how many units and how many code points it passes. The place after the k-th
unit is found from the top lane: links are followed while their units fit into what is
left of k, then the search goes down a lane; the code points passed add up to the cut.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from tickloom.llm.common import quoted

PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
FAN = 16


class SkipList:
    """Rank -> place among the units of one text."""

    def __init__(self, text: str, fan: int = FAN):
        points = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)
        low = points | 32
        letter = (low >= 97) & (low <= 122) & (points < 128)
        opens = ~letter
        opens[1:] |= ~letter[:-1]
        opens[:1] = True
        at = np.flatnonzero(opens).astype(np.int32)  # a text has fewer than 2**31 code points
        self.units, self.points = len(at), len(points)
        rank = np.arange(len(at), dtype=np.int32)
        # a lane: units and code points from the head or a node to the next node, and where a node lies on the lane below
        self.lanes: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        stop = np.append(at[1:], np.int32(len(points)))  # the node of a unit stands at its end
        below = rank
        while True:
            self.lanes.append((np.diff(rank, prepend=np.int32(-1)), np.diff(stop, prepend=np.int32(0)), below))
            if len(rank) < fan:
                break
            up = self._drawn(rank, len(self.lanes)) < np.uint64((1 << 32) // fan)
            if not up.any():
                break
            below, rank, stop = np.flatnonzero(up).astype(np.int32), rank[up], stop[up]

    @staticmethod
    def _drawn(rank: np.ndarray, lane: int) -> np.ndarray:
        x = (rank.astype(np.uint64) + np.uint64(lane << 32)) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(29))) * np.uint64(0x94D049BB133111EB)
        return x >> np.uint64(32)

    def place(self, units: int) -> int:
        """Code points of the first ``units`` units."""
        if not 0 <= units <= self.units:
            raise IndexError(units)
        left, passed, at = units, 0, 0  # ``at``: the next link on this lane
        for level in range(len(self.lanes) - 1, -1, -1):
            width, points, below = self.lanes[level]
            while at < len(width) and width[at] <= left:
                left -= int(width[at])
                passed += int(points[at])
                at += 1
            if level:
                at = int(below[at - 1]) + 1 if at else 0
        return passed


def draws(seed: int, key: object) -> list[int]:
    """Four numbers below 2**32 that depend on the seed and the decimal key alone."""
    digest = hashlib.sha256(f"{seed}:{'' if key is None else key}".encode()).hexdigest()
    return [int(digest[i : i + 8], 16) for i in range(0, 32, 8)]


def arranged(text: str, key: object, seed: int, rate: int, spm: int) -> tuple[int, str, int | None, int | None, str]:
    """Units, form, code points of prefix and middle (None where plain), and the rearranged text."""
    listed = SkipList(text)
    first, second, third, fourth = draws(seed, key)
    if not text or any(mark in text for mark in (PREFIX, SUFFIX, MIDDLE)) or third % 100 >= rate:
        return listed.units, "plain", None, None, text
    cuts = sorted(h % (listed.units + 1) for h in (first, second))
    a, b = (listed.place(cut) for cut in cuts)
    prefix, middle, suffix = text[:a], text[a:b], text[b:]
    if fourth % 100 < spm:
        return listed.units, "spm", a, b - a, f"{SUFFIX}{suffix}{PREFIX}{prefix}{MIDDLE}{middle}"
    return listed.units, "psm", a, b - a, f"{PREFIX}{prefix}{SUFFIX}{suffix}{MIDDLE}{middle}"


def fill_in_middle(docs: DataFrame, *, key: str = "doc_id", text: str = "text", seed: int = 1, rate: int = 90, spm: int = 20) -> DataFrame:
    """One row per row of ``docs``: the key, n units, form, prefix_chars, middle_chars, output.

    Of 100 texts about ``rate`` are cut into prefix, middle and suffix at two units drawn
    by a hash of ``seed`` and key, ``spm`` of 100 of those in the order suffix, prefix,
    middle (``spm``), the others prefix, suffix, middle (``psm``). The rest stays
    ``plain``, and so do empty texts and those that hold one of the three marks. Lengths
    are code points, NULL where plain. NULL text is empty; rows with the NULL key are
    all drawn alike, by the empty key; repeated rows give repeated rows. The empty table
    gives an empty result. No other column is read.

    One map over the rows: nothing is shuffled, so nothing can be skewed. Texts of any
    length are handled whole, one at a time, in some 25 bytes of task memory a code point.
    """
    kind = dict(docs.select(quoted(key)).dtypes)[key]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo in range(0, batch.num_rows, 256):
                part = batch.slice(lo, 256)
                rows = [
                    arranged(value.as_py() or "", name.as_py(), seed, rate, spm)
                    for name, value in zip(part.column(1), part.column(2), strict=True)
                ]
                n, form, prefix, middle, output = zip(*rows, strict=True)
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), pa.array(n, pa.int64()), pa.array(form, pa.string()), pa.array(prefix, pa.int64()), pa.array(middle, pa.int64()), pa.array(output, pa.string())],
                    names=["key", "n", "form", "prefix_chars", "middle_chars", "output"],
                )

    rows = docs.select(quoted(key).alias("key"), quoted(key).cast("string").alias("name"), quoted(text).cast("string").alias("text"))
    made = rows.mapInArrow(run, f"key {kind}, n long, form string, prefix_chars long, middle_chars long, output string")
    return made.withColumnRenamed("key", key)


def restored(output: Column, form: Column) -> Column:
    """The text that ``output`` was made from. A text that is not plain holds no mark, so each mark occurs once."""
    part = lambda first, last: F.split_part(F.split_part(output, F.lit(first), F.lit(2)), F.lit(last), F.lit(1))
    middle = F.split_part(output, F.lit(MIDDLE), F.lit(2))
    return (
        F.when(form == "psm", F.concat(part(PREFIX, SUFFIX), middle, part(SUFFIX, MIDDLE)))
        .when(form == "spm", F.concat(part(PREFIX, MIDDLE), middle, part(SUFFIX, PREFIX)))
        .otherwise(output)
    )

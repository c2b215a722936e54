"""Bounded reads of a topic that go on where the last one ended.

A poll is a stretch of offsets per partition. What it will read is noted first, then its
rows are handed over, then it is noted as done: a poll that dies in between is handed
over again under the same number with the same rows, so a handler that writes by number,
or keeps a ledger, has each message once.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping

import json

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from tickloom.schemas import TOPIC_ROW
from tickloom.sources.manifests import Manifest
from tickloom.sources.topics import read_topic

Stretch = dict[str, tuple[int, int]]  # partition -> first offset, and the one after the last


def _shares(partitions: list[str], most: int, turn: int) -> dict[str, int]:
    """How many records each partition may give; which ones give one more goes round with ``turn``."""
    first = turn % len(partitions)
    order = partitions[first:] + partitions[:first]
    return {p: most // len(order) + (i < most % len(order)) for i, p in enumerate(order)}


def _inside(stretch: Stretch) -> Column:
    """Whether a row is in the stretch: one short condition per partition, which files are pruned by."""
    found = F.lit(False)
    for partition, (start, end) in sorted(stretch.items()):
        found |= (F.col("partition") == int(partition)) & (F.col("offset") >= start) & (F.col("offset") < end)
    return found


class TopicPolls:
    """A topic's reader with a position kept in the folder ``held``.

    ``max_records`` limits a poll over all partitions; they share it evenly, and what one
    does not need another gets in the same poll. Gaps between offsets
    (compacted topics) cost nothing. Topics without new messages give no poll. The
    driver holds three numbers per partition.
    """

    def __init__(
        self,
        spark: SparkSession,
        topic: str,
        held: str,
        options: Mapping[str, str] | None = None,
        *,
        max_records: int | None = None,
        fmt: str = "kafka",
        schema: T.StructType = TOPIC_ROW,
    ):
        if max_records is not None and max_records < 1:
            raise ValueError("max_records must be 1 or more")
        self._spark, self._topic, self._options, self._fmt, self._schema = spark, topic, options, fmt, schema
        self._most = max_records
        self._manifest = Manifest(spark, held)

    def _state(self) -> dict:
        return self._manifest.read() or {"polls": 0, "next": {}, "planned": None}

    def _read(self, starts: Mapping[str, int], ends: Mapping[str, int] | None = None) -> DataFrame:
        if self._fmt != "kafka" or not starts:
            return read_topic(self._spark, self._topic, self._options, fmt=self._fmt, schema=self._schema)
        bound = lambda offsets: json.dumps({self._topic: {p: offsets[p] for p in sorted(offsets)}})
        if ends is None:  # partitions that are new to the reader are not among ``starts``: from their beginning
            return read_topic(self._spark, self._topic, self._options, fmt=self._fmt)
        partitions = [int(p) for p in ends]
        return read_topic(self._spark, self._topic, self._options, partitions=partitions, starting=bound(starts), ending=bound(ends), fmt=self._fmt)

    def _plan(self, state: dict) -> Stretch:
        """The next stretch: of each partition's new offsets the first that its share allows."""
        rows = self._read(state["next"]).select("partition", "offset")
        known = {int(p): n for p, n in state["next"].items()}
        if known:
            past = F.coalesce(*[F.when(F.col("partition") == p, F.lit(n)) for p, n in sorted(known.items())], F.lit(0))
            rows = rows.where(F.col("offset") >= past)
        ahead = {str(r.partition): r for r in rows.groupBy("partition").agg(F.min("offset").alias("lo"), F.max("offset").alias("hi"), F.count("*").alias("many")).collect()}
        if not ahead:
            return {}
        if self._most is None:
            return {p: (r.lo, r.hi + 1) for p, r in ahead.items()}
        waiting, left, taken = sorted(ahead, key=int), self._most, dict.fromkeys(ahead, 0)
        while left and waiting:
            for p, share in _shares(waiting, left, state["polls"]).items():
                gives = min(share, ahead[p].many - taken[p])
                taken[p] += gives
                left -= gives
            waiting = [p for p in waiting if taken[p] < ahead[p].many]
        # offsets may have gaps, so a stretch of as many offsets as records never holds too many
        return {p: (r.lo, r.hi + 1 if taken[p] == r.many else r.lo + taken[p]) for p, r in ahead.items() if taken[p]}

    def poll(self, handle: Callable[[DataFrame, int], None]) -> bool:
        """Hand the next rows to ``handle(rows, number)``; False where there are none."""
        state = self._state()
        if state["planned"] is None:
            stretch = self._plan(state)
            if not stretch:
                return False
            state = {**state, "planned": stretch}
            self._manifest.put(state)
        stretch = {p: (start, end) for p, (start, end) in state["planned"].items()}
        starts, ends = ({p: s[i] for p, s in stretch.items()} for i in (0, 1))
        handle(self._read(starts, ends).where(_inside(stretch)), state["polls"])
        self._manifest.put({"polls": state["polls"] + 1, "next": {**state["next"], **ends}, "planned": None})
        return True

    def drain(self, handle: Callable[[DataFrame, int], None]) -> int:
        """Poll until nothing is new; how many polls there were."""
        polls = 0
        while self.poll(handle):
            polls += 1
        return polls

"""A store of versioned measures that stays small: sorted runs, merged in tiers."""

from __future__ import annotations

import uuid
from collections.abc import Callable
from datetime import date

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from tickloom.operators.measures import latest_measures, measures_long
from tickloom.schemas import MEASURE
from tickloom.sources.manifests import Manifest

STORED = T.StructType([*MEASURE.fields, T.StructField("day", T.DateType())])
FAN_IN = 8


class MeasureStore:
    """Runs of measure records, of which a manifest names those that count.

    Each micro-batch adds a run; ``fan_in`` runs of a tier are merged into one of the
    next, which keeps only the highest version of each record. So n batches leave
    at most (fan_in - 1) runs in each of log(n) tiers, and a record is rewritten once per tier.

    A run is written under a fresh name before the manifest names it, and removed only when
    no kept manifest names it any more: a write or a merge that dies half-way changes nothing
    and its folder is cleared by a later one. A repeated batch is passed over.
    Runs are partitioned by day and sorted by time within files, so ``since``
    prunes folders and row groups.
    """

    def __init__(self, spark: SparkSession, path: str, fan_in: int = FAN_IN):
        if fan_in < 2:
            raise ValueError("fan_in must be at least 2")
        self.spark, self.path, self.fan_in = spark, path.rstrip("/"), fan_in
        self._manifest = Manifest(spark, f"{self.path}/_manifest")

    def _state(self) -> dict:
        return self._manifest.read() or {"last": -1, "runs": []}

    def _write_run(self, records: DataFrame) -> str:
        name = f"run-{uuid.uuid4().hex}"
        sorted_rows = records.select(*MEASURE.fieldNames(), F.to_date("time").alias("day")).hint("rebalance", F.col("day"))
        sorted_rows.sortWithinPartitions("day", "time").write.partitionBy("day").parquet(f"{self.path}/{name}")
        return name

    def _read_runs(self, runs: list[dict]) -> DataFrame:
        parts = [self.spark.read.schema(STORED).parquet(f"{self.path}/{run['name']}") for run in runs]
        whole = parts[0]
        for part in parts[1:]:
            whole = whole.unionByName(part)
        return whole

    def write(self, records: DataFrame, batch_id: int) -> bool:
        """Add a micro-batch's records; False where it is there already."""
        state = self._state()
        if batch_id <= state["last"]:
            return False
        run = {"name": self._write_run(latest_measures(records)), "tier": 0}
        self._manifest.put({"last": batch_id, "runs": [*state["runs"], run]})
        self.merge()
        return True

    def merge(self) -> None:
        """Merge every tier that is full, then clear folders that no kept manifest names."""
        state, merged = self._state(), False
        while full := [t for t in {r["tier"] for r in state["runs"]} if self._count(state, t) >= self.fan_in]:
            state, merged = self._merge_tier(state, min(full)), True
        if merged:
            self._clear()

    @staticmethod
    def _count(state: dict, tier: int) -> int:
        return sum(run["tier"] == tier for run in state["runs"])

    def _merge_tier(self, state: dict, tier: int) -> dict:
        own = [run for run in state["runs"] if run["tier"] == tier]
        run = {"name": self._write_run(latest_measures(self._read_runs(own))), "tier": tier + 1}
        state = state | {"runs": [r for r in state["runs"] if r["tier"] != tier] + [run]}
        self._manifest.put(state)
        return state

    def _clear(self) -> None:
        named = {run["name"] for held in self._manifest.all() for run in held["runs"]}
        for name in self._manifest.folders(self.path):
            if name.startswith("run-") and name not in named:
                self._manifest.remove(f"{self.path}/{name}")

    def read(self, since: date | None = None) -> DataFrame:
        """Current records, the highest version of each; ``since`` prunes days."""
        runs = self._state()["runs"]
        rows = self._read_runs(runs) if runs else self.spark.createDataFrame([], STORED)
        return latest_measures(rows if since is None else rows.filter(F.col("day") >= F.lit(since)))


def merge_measures(path: str, fan_in: int = FAN_IN, **settings) -> Callable[[DataFrame, int], None]:
    """A pair handler that keeps long measure records in a ``MeasureStore``."""

    def handle(pairs: DataFrame, batch_id: int) -> None:
        MeasureStore(pairs.sparkSession, path, fan_in).write(measures_long(pairs, **settings), batch_id)

    return handle

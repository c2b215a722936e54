"""Small numbered documents beside a table: what of its folders counts.

A table's data lies in folders that are never changed once written. A manifest names
those that count; it is written whole under the next number and then put in place by a
rename, so a reader sees one state or the next, and a writer that dies in
between leaves the last one standing. One writer at a time is assumed, as a streaming query is.
"""

from __future__ import annotations

import json
import re
import uuid
from typing import Any

from pyspark.sql import SparkSession

KEPT = 3  # newest manifests that stay, for readers that have just begun


class Manifest:
    """The newest document of a folder, and its successors."""

    def __init__(self, spark: SparkSession, path: str):
        self._jvm, self._conf = spark._jvm, spark._jsc.hadoopConfiguration()
        self.path = path.rstrip("/")
        self._system = self._at("").getFileSystem(self._conf)

    def _at(self, name: str) -> Any:
        return self._jvm.org.apache.hadoop.fs.Path(f"{self.path}/{name}" if name else self.path)

    def _numbers(self) -> list[int]:
        if not self._system.exists(self._at("")):
            return []
        names = (f.getPath().getName() for f in self._system.listStatus(self._at("")))
        return sorted(int(m[1]) for m in (re.fullmatch(r"(\d{12})\.json", n) for n in names) if m)

    def read(self, number: int | None = None) -> dict | None:
        """The document of this number, by default the newest; None where there is none."""
        numbers = self._numbers()
        if not numbers:
            return None
        stream = self._system.open(self._at(f"{numbers[-1] if number is None else number:012d}.json"))
        try:
            return json.loads(self._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))
        finally:
            stream.close()

    def put(self, document: dict) -> None:
        """Make this document the newest."""
        numbers = self._numbers()
        following = (numbers[-1] if numbers else 0) + 1
        draft, final = self._at(f"_draft-{uuid.uuid4().hex}"), self._at(f"{following:012d}.json")
        self._system.mkdirs(self._at(""))
        stream = self._system.create(draft, False)
        try:
            stream.write(bytearray(json.dumps(document).encode()))
        finally:
            stream.close()
        if self._system.exists(final) or not self._system.rename(draft, final):
            self._system.delete(draft, False)
            raise RuntimeError(f"another writer has put {final}")
        for old in numbers[: max(0, len(numbers) + 1 - KEPT)]:
            self._system.delete(self._at(f"{old:012d}.json"), False)

    def all(self) -> list[dict]:
        """The documents that are kept, oldest first."""
        return [d for d in (self.read(n) for n in self._numbers()) if d is not None]

    def folders(self, path: str) -> list[str]:
        """Names of the folders in ``path``."""
        at = self._jvm.org.apache.hadoop.fs.Path(path)
        return sorted(f.getPath().getName() for f in self._system.listStatus(at)) if self._system.exists(at) else []

    def remove(self, path: str) -> None:
        self._system.delete(self._jvm.org.apache.hadoop.fs.Path(path), True)


class Ledger:
    """Which micro-batches have been delivered; their numbers only rise, so the last one tells."""

    def __init__(self, spark: SparkSession, path: str):
        self._manifest = Manifest(spark, path)

    def has(self, batch_id: int) -> bool:
        held = self._manifest.read()
        return held is not None and batch_id <= held["last"]

    def add(self, batch_id: int) -> None:
        self._manifest.put({"last": batch_id})

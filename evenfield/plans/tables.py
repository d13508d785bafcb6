"""Versioned tables of a run's results: a manifest of versions, each a folder of Parquet that nobody writes to again.

A commit writes a new folder first and then the next number's manifest file, which can be created once. A writer that crashes before
leaves the table as it was; of two writers of one version one succeeds, and the other reads the new version, makes its rows from that
and tries again, so neither loses rows. The last versions' folders stay for readers that began with them.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from ..sources import files

#: Versions whose rows are kept.
KEPT = 3


class Tables:
    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root

    def path(self, name: str) -> str:
        return f"{self.root}/{name}.table"

    def _manifest(self, name: str, version: int) -> str:
        return f"{self.path(name)}/_versions/{version:010d}.json"

    def versions(self, name: str) -> list[int]:
        return [int(n[:-5]) for n in files.names(f"{self.path(name)}/_versions") if n.endswith(".json")]

    def has(self, name: str) -> bool:
        return bool(self.versions(name))

    def folder(self, name: str, version: int | None = None) -> str:
        """Where a version's rows are; the last one's by default."""
        return f"{self.path(name)}/{files.read_json(self._manifest(name, self.versions(name)[-1] if version is None else version))['folder']}"

    def read(self, name: str, version: int | None = None) -> DataFrame:
        return self.spark.read.parquet(self.folder(name, version))

    def commit(self, name: str, make: Callable[[DataFrame | None], DataFrame], tries: int = 20) -> DataFrame:
        """Writes what ``make`` makes of the last version (None if there is none) as the next one, and reads it."""
        for _ in range(tries):
            held = self.versions(name)
            last = held[-1] if held else 0
            own = f"data-{uuid.uuid4().hex}"
            folder = f"{self.path(name)}/{own}"
            make(self.read(name, last) if held else None).write.parquet(folder)
            if files.create_new(self._manifest(name, last + 1), json.dumps({"version": last + 1, "folder": own}).encode()):
                for old in held[: -(KEPT - 1)]:
                    files.drop(self.folder(name, old))
                return self.spark.read.parquet(folder)
            files.drop(folder)  # another writer was first
        raise RuntimeError(f"{self.path(name)} was written by others {tries} times meanwhile")

    def clean(self, name: str) -> list[str]:
        """Drops folders that no kept version has: those of writers that crashed. Not while others write."""
        known = {self.folder(name, v).rpartition("/")[2] for v in self.versions(name)[-KEPT:]}
        gone = [n for n in files.names(self.path(name)) if n.startswith("data-") and n not in known]
        for n in gone:
            files.drop(f"{self.path(name)}/{n}")
        return gone

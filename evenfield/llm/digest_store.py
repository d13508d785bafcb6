"""A kept index of text digests that batches of documents are merged into: the log-structured part of exact deduplication over time.

Each batch is deduplicated by ``exact_dedup``, bytes verified, and becomes a level: its digests, sorted in each file, beside a filter of them. A batch
probes the filter of every earlier level and is joined only with those digests that the filter may hold, so batches of new texts read
filters and no level. When there are more than ``FANOUT`` levels they are compacted into one. The list of levels is a versioned table: a
batch that fails adds nothing, and of two batches at once the second probes the first one's level too.

What was kept stays kept: a text that an earlier batch had isn't kept again, whatever the ids, and its keep_id is the earlier one's. Across batches
texts are told apart by SHA-256 alone, as those of earlier batches aren't there any more. Within a batch all is as in ``exact_dedup``: nulls
are empty texts, an empty batch adds no level, further columns don't matter.
"""

from __future__ import annotations

import uuid
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..plans.tables import Tables
from .exact_dedup import DigestIndex, digest_filter, held_by, join_hot

FANOUT = 4


class DigestStore:
    def __init__(self, spark: SparkSession, folder: str, fanout: int = FANOUT):
        self.spark, self.folder, self.fanout = spark, folder, fanout
        self.tables = Tables(spark, folder)

    def levels(self) -> list[tuple[int, str]]:
        """(rank, name) of the levels, the oldest first; some more than ``fanout`` rows at most."""
        if not self.tables.has("levels"):
            return []
        return sorted((r["rank"], r["name"]) for r in self.tables.read("levels").collect())

    def _level(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.folder}/{name}/digests")

    def _write(self, rows: DataFrame) -> str:
        name = f"level-{uuid.uuid4().hex}"
        rows.select("digest", "keep_id", "group_size").sortWithinPartitions("digest").write.parquet(f"{self.folder}/{name}/digests")
        digest_filter(self._level(name)).write.parquet(f"{self.folder}/{name}/filter")
        return name

    def found_in(self, name: str, rank: int, digests: DataFrame) -> DataFrame:
        """(digest, rank, keep_id, group_size) of those of ``digests`` that a level has."""
        asked = held_by(digests, self.spark.read.parquet(f"{self.folder}/{name}/filter")).filter("held").select("digest")
        return asked.join(self._level(name), "digest").select("digest", F.lit(rank).alias("rank"), "keep_id", "group_size")

    def merge(self, docs: DataFrame) -> DataFrame:
        """doc_id, keep_id, group_size (rows with the text so far, this batch included), kept, seen (by an earlier batch) of each document."""
        index = DigestIndex(docs)
        fates = index._kept(index.result(), "fates")
        own = fates.groupBy("digest").agg(F.min("keep_id").alias("keep_id"), F.count(F.lit(1)).alias("group_size"))
        if own.isEmpty():
            return fates.select("doc_id", "keep_id", "group_size", "kept", F.lit(False).alias("seen"))
        name, probed = self._write(own), {}

        def added(before: DataFrame | None) -> DataFrame:
            probed["levels"] = self.levels()
            rows = [*probed["levels"], (max((r for r, _ in probed["levels"]), default=0) + 1, name)]
            return self.spark.createDataFrame(rows, "rank long, name string").coalesce(1)

        self.tables.commit("levels", added)  # made anew if another batch was first, so ``probed`` is what this one follows
        old = [self.found_in(n, r, self._level(name)) for r, n in probed["levels"]]
        if old:
            met = reduce(DataFrame.unionByName, old).groupBy("digest").agg(F.min_by("keep_id", "rank").alias("old_id"), F.sum("group_size").alias("old_size"))
            met = index._kept(met.join(own.select("digest", F.col("group_size").alias("own_size")), "digest"), "met")
            fates = join_hot(fates, met, "digest", "own_size")
        else:
            fates = fates.select("*", *(F.lit(None).cast("long").alias(c) for c in ("old_id", "old_size", "own_size")))
        seen = F.col("old_size").isNotNull()
        result = fates.select("doc_id", F.when(seen, F.col("old_id")).otherwise(F.col("keep_id")).alias("keep_id"), (F.col("group_size") + F.coalesce("old_size", F.lit(0))).alias("group_size"), (F.col("kept") & ~seen).alias("kept"), seen.alias("seen"))
        result = index._kept(result, "result")
        if len(probed["levels"]) + 1 > self.fanout:
            self.compact()
        return result

    def compact(self) -> None:
        """All levels as one: of a digest the oldest level's keep_id and the sum of rows stay."""

        def merged(before: DataFrame) -> DataFrame:
            held = self.levels()
            rows = reduce(DataFrame.unionByName, (self._level(n).withColumn("rank", F.lit(r)) for r, n in held))
            name = self._write(rows.groupBy("digest").agg(F.min_by("keep_id", "rank").alias("keep_id"), F.sum("group_size").alias("group_size")))
            return self.spark.createDataFrame([(held[-1][0], name)], "rank long, name string").coalesce(1)

        self.tables.commit("levels", merged)

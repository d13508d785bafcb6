"""New tiles as a stream: each batch adds sums per pixel column and histograms to the tables that hold them.

A batch of a query that runs again replaces what it wrote before, since it is kept under its number. Readers sum over
batches and judge then, so a tile may arrive in any number of files and batches.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..model import VOXEL
from ..operators import emptiness, thresholds


def watch(spark: SparkSession, source: str, results: str, limits: DataFrame) -> StreamingQuery:
    """Follows Parquet files of ``model.VOXEL`` in ``source``; partial sums go to ``results``."""
    arriving = spark.readStream.schema(VOXEL).parquet(source)

    def add(batch: DataFrame, number: int) -> None:
        emptiness.column_sums(batch, limits).write.mode("overwrite").parquet(f"{results}/columns/batch={number}")
        thresholds.histogram(batch, "setup").write.mode("overwrite").parquet(f"{results}/histograms/batch={number}")

    return arriving.writeStream.foreachBatch(add).option("checkpointLocation", f"{results}/_progress").trigger(availableNow=True).start()


def pixels(spark: SparkSession, results: str, floor: float = 0.02) -> DataFrame:
    """(camera, y, x, phi, bg_sum, bg_count) of all that has arrived."""
    rows = spark.read.parquet(f"{results}/columns").groupBy("camera", "setup", "y", "x").agg(*(F.sum(c).alias(c) for c in emptiness.SUMS))
    return emptiness.by_pixel(emptiness.judged(rows, floor))


def tile_thresholds(spark: SparkSession, results: str, mode: str | float = "li") -> DataFrame:
    """(setup, threshold) of all tiles that have arrived."""
    return thresholds.resolve(spark.read.parquet(f"{results}/histograms").groupBy("setup", "v").agg(F.sum("n").alias("n")), mode, "setup")

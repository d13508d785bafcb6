"""Where the camera frame stays empty: per tile, per frame pixel, and how dark it is there."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def columns(voxels: DataFrame, thresholds: DataFrame, floor: float = 0.02) -> DataFrame:
    """(camera, setup, y, x, is_empty, below): a pixel column is empty if less than ``floor`` of it is above the threshold.

    ``below`` is the mean of what lies under the threshold; a voxel at the threshold is neither above nor under.
    """
    return judged(column_sums(voxels, thresholds), floor)


SUMS = ("n", "n_above", "n_below", "sum_below")


def column_sums(voxels: DataFrame, thresholds: DataFrame) -> DataFrame:
    """(camera, setup, y, x) with SUMS, which add up over parts of a column."""
    rows = voxels.join(F.broadcast(thresholds.select("camera", "threshold")), "camera")  # a row per camera
    above, below = F.col("v") > F.col("threshold"), F.col("v") < F.col("threshold")
    return rows.groupBy("camera", "setup", "y", "x").agg(F.count(F.lit(1)).alias("n"), F.sum(above.cast("long")).alias("n_above"), F.sum(below.cast("long")).alias("n_below"), F.sum(F.when(below, F.col("v").cast("double")).otherwise(0.0)).alias("sum_below"))


def judged(sums: DataFrame, floor: float) -> DataFrame:
    below = F.when(F.col("n_below") > 0, F.col("sum_below") / F.col("n_below"))
    return sums.select("camera", "setup", "y", "x", (F.col("n_above") / F.col("n") < floor).alias("is_empty"), below.alias("below"))


def by_tile(cols: DataFrame) -> DataFrame:
    """(camera, setup, empty_area): the part of the frame that a tile leaves empty."""
    return cols.groupBy("camera", "setup").agg(F.avg(F.col("is_empty").cast("double")).alias("empty_area"))


def by_pixel(cols: DataFrame) -> DataFrame:
    """(camera, y, x, phi, bg_sum, bg_count): the part of tiles empty there, and the background seen in those."""
    seen = F.col("is_empty") & F.col("below").isNotNull()
    tiles = cols.groupBy("camera", "y", "x").agg(F.avg(F.col("is_empty").cast("double")).alias("phi"), F.sum(F.when(seen, F.col("below")).otherwise(0.0)).alias("bg_sum"), F.sum(seen.cast("long")).alias("bg_count"))
    return tiles


def background_level(pixels: DataFrame, percent: float = 5.0) -> DataFrame:
    """(camera, level, n_pixels): a low percentile of the pixels' mean background; null where no pixel was ever empty."""
    mean = F.when(F.col("bg_count") > 0, F.col("bg_sum") / F.col("bg_count"))
    return pixels.groupBy("camera").agg(F.percentile(mean, F.lit(percent / 100)).alias("level"), F.count(mean).alias("n_pixels"))


def report(tiles: DataFrame) -> DataFrame:
    """Least, middle and largest empty area of each camera."""
    return tiles.groupBy("camera").agg(F.min("empty_area").alias("least"), F.percentile("empty_area", F.lit(0.5)).alias("middle"), F.max("empty_area").alias("most"))

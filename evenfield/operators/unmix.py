"""Quantile stacks with the empty tiles' background taken out, and their choice of layout."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.columns import unmixed
from .orderstats import MIN_DEPTH, camera_depth


def unmix(planes: DataFrame, pixels: DataFrame, background: DataFrame) -> DataFrame:
    """(camera, plane, y, x, v): planes with phi and background joined in.

    ``background`` is (camera, level) for one level a camera, or (camera, plane, level) for one a plane.
    """
    keys = [c for c in ("camera", "plane") if c in background.columns]
    rows = planes.join(pixels.select("camera", "y", "x", "phi"), ["camera", "y", "x"], "left")
    rows = rows.join(F.broadcast(background.select(*keys, F.col("level").alias("bg"))), keys, "left")  # 21 rows a camera at most
    known = F.col("phi").isNotNull() & F.col("bg").isNotNull()
    return rows.select("camera", "plane", "y", "x", F.when(known, unmixed(F.col("v").cast("double"), F.col("phi"), F.col("bg"))).otherwise(F.col("v").cast("double")).alias("v"))


def shallow_cameras(voxels: DataFrame) -> DataFrame:
    """(camera): those with too few planes for order statistics, whose raw planes are stacked instead."""
    return camera_depth(voxels).filter(F.col("depth") < MIN_DEPTH).select("camera")

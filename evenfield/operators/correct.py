"""The one correcting pass: flat and dark fields, and each tile's rescaling, in one expression and one rounding."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.columns import to_uint16


def floored(fields: DataFrame, least: float = 1e-3) -> DataFrame:
    """Fields of which a camera's flat is not below ``least`` anywhere, if it was zero or less somewhere."""
    low = fields.groupBy("camera").agg(F.min("flat").alias("lowest"))
    rows = fields.join(F.broadcast(low), "camera")  # a row per camera
    return rows.select("camera", "y", "x", F.when(F.col("lowest") <= 0, F.greatest("flat", F.lit(least))).otherwise(F.col("flat")).alias("flat"), "dark")


def coefficients(fields: DataFrame) -> DataFrame:
    """(camera, y, x, slope, shift): (v - dark) / flat as v * slope + shift."""
    return floored(fields).select("camera", "y", "x", (1.0 / F.col("flat")).alias("slope"), (-F.col("dark") / F.col("flat")).alias("shift"))


def rescaling(targets: DataFrame, max_gain_scale: float = 8.0) -> DataFrame:
    """(setup, mode, thr, mean, scale, target_mean) of each tile; empty tiles have mode none."""
    mode = F.when(F.col("kind") == "empty", "none").otherwise(F.col("kind"))
    scale = F.least(F.col("target_std") / F.col("corrected_std"), F.lit(max_gain_scale))
    return targets.select("setup", mode.alias("mode"), F.col("threshold").alias("thr"), F.col("corrected_mean").alias("mean"), scale.alias("scale"), "target_mean")


def correct(voxels: DataFrame, fields: DataFrame | None = None, tiles: DataFrame | None = None) -> DataFrame:
    """voxels with v corrected by ``fields``, ``tiles`` (of ``rescaling``), or both at once. Tiles not listed aren't rescaled.

    Fields have a row per camera pixel and tiles one per setup: the number of voxels over the depth and the frame. Both
    are joined without dealing the voxels anew wherever Spark finds them small enough to broadcast.
    """
    rows = voxels
    if fields is not None:
        rows = rows.join(coefficients(fields), ["camera", "y", "x"])
    if tiles is not None:
        rows = rows.join(F.broadcast(tiles), "setup", "left")  # a row per setup
    raw = F.col("v").cast("double")
    plain = raw * F.col("slope") + F.col("shift") if fields is not None else raw
    out = plain
    if tiles is not None:
        moved = lambda c: (c - F.col("mean")) * F.col("scale") + F.col("target_mean")
        if fields is not None:
            base = F.col("target_mean") - F.col("mean") * F.col("scale")
            whole = F.greatest(raw * (F.col("slope") * F.col("scale")) + (F.col("shift") * F.col("scale") + base), base)
            kept = F.when(F.col("thr") < 0, F.greatest(plain, F.lit(0.0))).otherwise(plain)
            split = F.when(kept > F.col("thr"), kept * F.col("scale") + base).otherwise(kept)
        else:
            whole, split = moved(raw), F.when(raw > F.col("thr"), moved(raw)).otherwise(raw)
        out = F.when(F.col("mode") == "uniform", whole).when(F.col("mode") == "bimodal", split).otherwise(plain)
    return rows.select(*(c if c != "v" else to_uint16(out).alias("v") for c in voxels.columns))

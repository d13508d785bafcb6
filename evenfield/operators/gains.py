"""Gains of cameras or tiles from pair constraints, and the brightness that all tiles are brought to."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def grouped_constraints(found: DataFrame, groups: DataFrame) -> DataFrame:
    """(ga, gb, s_w, s_wd): constraints between different groups, summed by pair of groups, with weights over their median.

    Each task's sums are partial aggregates; what is left is a row per pair of groups.
    """
    side = lambda s: F.broadcast(groups.select(F.col("setup").alias(s), F.col("grp").alias(f"g{s}")))  # noqa: E731  a row per setup
    rows = found.join(side("a"), "a").join(side("b"), "b").filter("ga != gb")
    middle = rows.agg(F.percentile("w", F.lit(0.5)).alias("m"))
    rows = rows.crossJoin(F.broadcast(middle)).withColumn("u", F.col("w") / F.col("m"))  # one row
    return rows.groupBy("ga", "gb").agg(F.sum("u").alias("s_w"), F.sum(F.col("u") * F.col("d")).alias("s_wd"))


def balanced(a: np.ndarray, b: np.ndarray, w: np.ndarray, wd: np.ndarray, n: int, lam: float) -> np.ndarray:
    """The least squares of w * (g_a - g_b) - wd with lam * g**2, by conjugate gradients scaled by the diagonal."""
    add = lambda at, x: np.bincount(at, x, minlength=n)
    diagonal = lam + add(a, w) + add(b, w)
    times = lambda g: diagonal * g - add(a, w * g[b]) - add(b, w * g[a])
    rest = add(a, wd) - add(b, wd)
    out, least = np.zeros(n), 1e-15 * np.linalg.norm(rest)
    if not n or not least:
        return out
    scaled = rest / diagonal
    way, size = scaled.copy(), rest @ scaled
    for _ in range(20 * n + 100):
        if np.linalg.norm(rest) <= least:
            break
        pushed = times(way)
        step = size / (way @ pushed)
        out += step * way
        rest -= step * pushed
        scaled = rest / diagonal
        size, before = rest @ scaled, size
        way = scaled + size / before * way
        if not size:
            break
    return out


def solve(found: DataFrame, groups: DataFrame, lam: float) -> DataFrame:
    """(setup, gain): minimises the weighted squares of g_a - g_b - d plus lam * g**2 over log gains g, then exp.

    The normal equations are summed in Spark; only a row per pair of overlapping groups reaches the driver, and the system
    that is solved there holds no more numbers than those. Groups without a constraint have gain 1.
    """
    spark = groups.sparkSession
    sums = grouped_constraints(found, groups).collect()
    names = sorted({r[k] for r in sums for k in ("ga", "gb")})
    at = {g: k for k, g in enumerate(names)}
    a, b = (np.array([at[r[k]] for r in sums], np.int64) for k in ("ga", "gb"))
    logs = balanced(a, b, np.array([r["s_w"] for r in sums]), np.array([r["s_wd"] for r in sums]), len(names), lam)
    table = spark.createDataFrame([(int(g), float(np.exp(x))) for g, x in zip(names, logs)], "grp int, g double")
    return groups.join(F.broadcast(table), "grp", "left").select("setup", F.coalesce("g", F.lit(1.0)).alias("gain"))  # a row per group


def targets(tiles: DataFrame, gains: DataFrame) -> DataFrame:
    """tiles with gain, target_mean, target_std, corrected_mean and corrected_std.

    The targets are medians over tiles that aren't empty of mean / gain and std / gain, of the foreground for bimodal tiles
    and of all voxels for uniform ones.
    """
    rows = tiles.join(gains, "setup", "left").withColumn("gain", F.coalesce("gain", F.lit(1.0)))
    pick = lambda fore, all_: F.when(F.col("kind") == "bimodal", F.col(fore)).when(F.col("kind") == "uniform", F.col(all_))
    middle = rows.agg(F.percentile(pick("mean", "all_mean") / F.col("gain"), F.lit(0.5)).alias("target_mean"), F.percentile(pick("std", "all_std") / F.col("gain"), F.lit(0.5)).alias("target_std"))
    rows = rows.crossJoin(F.broadcast(middle))  # one row
    return rows.withColumn("corrected_mean", F.col("gain") * F.col("target_mean")).withColumn("corrected_std", F.col("gain") * F.col("target_std"))


def camera_summary(gains: DataFrame, cameras: DataFrame) -> DataFrame:
    return gains.join(cameras, "setup").groupBy("camera").agg(F.percentile("gain", F.lit(0.5)).alias("median_gain"), F.min("gain").alias("min_gain"), F.max("gain").alias("max_gain"), F.count(F.lit(1)).alias("n_tiles"))

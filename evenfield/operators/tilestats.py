"""Moments of each tile above and below its threshold, and what kind of tile it is."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

NAN = float("nan")


@dataclass(frozen=True)
class Limits:
    min_tile_fraction: float = 0.001
    min_tile_foreground: int = 256
    min_uniform_std: float = 10.0
    min_background_area: float = 0.02
    max_gain_scale: float = 8.0


def moments(voxels: DataFrame, thresholds: DataFrame) -> DataFrame:
    """One row per setup: population moments of foreground (v > threshold), background and all; NaN for an empty class."""
    v = F.col("v").cast("double")
    rows = voxels.join(F.broadcast(thresholds.select("setup", "threshold")), "setup")  # a row per setup
    fore, back = F.when(v > F.col("threshold"), v), F.when(v <= F.col("threshold"), v)
    found = rows.groupBy("setup", "threshold").agg(
        F.avg(fore).alias("mean"), F.stddev_pop(fore).alias("std"), F.avg(back).alias("bg_mean"), F.stddev_pop(back).alias("bg_std"),
        F.avg(v).alias("all_mean"), F.stddev_pop(v).alias("all_std"), F.count(fore).alias("n_foreground"), F.count(F.lit(1)).alias("n_voxels"),
    )
    return with_separation(found)


def moments_of_counts(levels: DataFrame, thresholds: DataFrame) -> DataFrame:
    """The same from the histogram (setup, v, n) that the thresholds come from, so that voxels aren't read again."""
    rows = levels.join(F.broadcast(thresholds.select("setup", "threshold")), "setup")  # a row per setup
    v, n = F.col("v").cast("double"), F.col("n").cast("double")
    above = v > F.col("threshold")
    classes = {"mean": above, "bg_mean": ~above, "all_mean": F.lit(True)}
    means = rows.groupBy("setup", "threshold").agg(*((F.sum(F.when(c, n * v)) / F.sum(F.when(c, n))).alias(m) for m, c in classes.items()), F.sum(F.when(above, F.col("n")).otherwise(0)).alias("n_foreground"), F.sum("n").alias("n_voxels"))
    around = rows.join(F.broadcast(means.drop("threshold")), "setup")  # a row per setup
    off = lambda m, c: F.sqrt(F.sum(F.when(c, n * (v - F.col(m)) * (v - F.col(m)))) / F.sum(F.when(c, n))).alias(m.replace("mean", "std"))
    return with_separation(means.join(around.groupBy("setup").agg(*(off(m, c) for m, c in classes.items())), "setup"))


def with_separation(found: DataFrame) -> DataFrame:
    """Moments with NaN for an empty class, and how far the classes are apart."""
    for name in ("mean", "std", "bg_mean", "bg_std"):
        found = found.withColumn(name, F.coalesce(name, F.lit(NAN)))
    return found.withColumn("separation", (F.col("mean") - F.col("bg_mean")) / (F.col("bg_std") + 1e-6))


def kind(lim: Limits = Limits()) -> Column:
    """empty, bimodal or uniform, from a tile's moments and its empty_area."""
    enough = F.when(F.coalesce(F.col("n_voxels"), F.lit(0)) > 0, F.col("n_foreground") >= lim.min_tile_fraction * F.col("n_voxels")).otherwise(F.col("n_foreground") >= lim.min_tile_foreground)
    finite = lambda c: F.col(c).isNotNull() & ~F.isnan(c) & (F.abs(F.col(c)) != float("inf"))
    signal = enough & finite("mean") & finite("std") & (F.col("std") > 0) & finite("all_std") & (F.col("all_std") >= lim.min_uniform_std)
    measured = F.when(finite("empty_area"), F.lit(True)).otherwise(F.raise_error(F.lit("a tile has no empty_area; measure emptiness first")))
    return F.when(measured & ~signal, "empty").when(F.col("empty_area") >= lim.min_background_area, "bimodal").otherwise("uniform")


def classified(stats: DataFrame, empty_area: DataFrame, lim: Limits = Limits()) -> DataFrame:
    """Tile statistics with empty_area and kind."""
    return stats.join(empty_area.select("setup", "empty_area"), "setup", "left").withColumn("kind", kind(lim))


def merged_records(new: DataFrame, old: DataFrame) -> DataFrame:
    """Records of two writers by setup: a column's new value, or the old one where the new is null or absent."""
    both = new.alias("n").join(old.alias("o"), F.col("n.setup") == F.col("o.setup"), "full_outer")
    columns = [F.coalesce("n.setup", "o.setup").alias("setup")]
    for c in dict.fromkeys([*new.columns, *old.columns]):
        if c != "setup":
            sides = [F.col(f"{s}.{c}") for s, cols in (("n", new.columns), ("o", old.columns)) if c in cols]
            columns.append(F.coalesce(*sides).alias(c))
    return both.select(*columns)

"""Brightness of overlapping tiles over the tissue they share: one constraint on their gains a pair."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .geometry import AXES


def floors(catalogue: DataFrame, setting: str | float = "tile") -> DataFrame:
    """(setup, thr): each tile's own threshold, a method's from its catalogue, or one number for all."""
    if not isinstance(setting, str):
        return catalogue.select("setup", F.lit(float(setting)).alias("thr"))
    if setting not in ("tile", "otsu", "li"):
        raise ValueError(f"{setting!r} is no floor; it is tile, otsu, li or a number")
    return catalogue.select("setup", F.col("threshold" if setting == "tile" else setting).alias("thr"))


def usable_pairs(pairs: DataFrame, usable: DataFrame) -> DataFrame:
    """Pairs of which both tiles are in ``usable`` (setup)."""
    return pairs.join(usable.select(F.col("setup").alias("a")), "a", "left_semi").join(usable.select(F.col("setup").alias("b")), "b", "left_semi")


def _side(voxels: DataFrame, ranges: DataFrame, side: str) -> DataFrame:
    """(a, b, dx, dy, dz, v): the side's voxels in range, by their distance from its beginning.

    A table of voxels is small as a file, so Spark would take it for the side to broadcast; the ranges are.
    """
    inside = [(F.col(c) >= F.col(f"lo_{c}")) & (F.col(c) < F.col(f"hi_{c}")) for c in AXES]
    own = voxels.select(F.col("setup").alias("own"), *AXES, "v")
    rows = own.join(F.broadcast(ranges), (F.col(side) == F.col("own")) & inside[0] & inside[1] & inside[2])  # a row per pair
    return rows.select("a", "b", *((F.col(c) - F.col(f"lo_{c}")).alias(f"d{c}") for c in AXES), F.col("v").cast("double").alias(f"v{side}"))


def matched(voxels: DataFrame, ranges_a: DataFrame, ranges_b: DataFrame, thresholds: DataFrame) -> DataFrame:
    """(a, b, thr, va, vb) of voxels that both sides have at one place; thr is the larger of the two tiles' floors."""
    both = _side(voxels, ranges_a, "a").join(_side(voxels, ranges_b, "b").hint("merge"), ["a", "b", "dx", "dy", "dz"])  # voxels on both sides: dealt, not broadcast
    return with_floor(both, thresholds).select("a", "b", "thr", "va", "vb")


def with_floor(rows: DataFrame, thresholds: DataFrame) -> DataFrame:
    thr = lambda s: F.broadcast(thresholds.select(F.col("setup").alias(s), F.col("thr").alias(f"thr_{s}")))  # noqa: E731  a row per setup
    return rows.join(thr("a"), "a").join(thr("b"), "b").withColumn("thr", F.greatest("thr_a", "thr_b"))


def intersection(voxels: DataFrame, ranges_a: DataFrame, ranges_b: DataFrame, thresholds: DataFrame) -> DataFrame:
    """(a, b, thr, n_a, n_b, n_overlap, n_overlap_b, med_a, med_b) over the voxels that both tiles have above the floor."""
    rows = matched(voxels, ranges_a, ranges_b, thresholds)
    fore = (F.col("va") > F.col("thr")) & (F.col("vb") > F.col("thr"))
    return rows.groupBy("a", "b", "thr").agg(
        F.count(F.when(fore, 1)).alias("n_a"), F.count(F.when(fore, 1)).alias("n_b"), F.count(F.lit(1)).alias("n_overlap"), F.count(F.lit(1)).alias("n_overlap_b"),
        F.percentile(F.when(fore, F.col("va")), F.lit(0.5)).alias("med_a"), F.percentile(F.when(fore, F.col("vb")), F.lit(0.5)).alias("med_b"),
    )


def independent(voxels: DataFrame, ranges_a: DataFrame, ranges_b: DataFrame, thresholds: DataFrame) -> DataFrame:
    """The same of each tile's own voxels above the floor; nothing is matched, so no voxel join is made."""
    parts = []
    for side, ranges in (("a", ranges_a), ("b", ranges_b)):
        rows = with_floor(_side(voxels, ranges, side), thresholds)
        fore = F.col(f"v{side}") > F.col("thr")
        parts.append(rows.groupBy("a", "b", "thr").agg(F.count(F.when(fore, 1)).alias(f"n_{side}"), F.count(F.lit(1)).alias("n_overlap" if side == "a" else "n_overlap_b"), F.percentile(F.when(fore, F.col(f"v{side}")), F.lit(0.5)).alias(f"med_{side}")))
    return parts[0].join(parts[1], ["a", "b", "thr"]).select("a", "b", "thr", "n_a", "n_b", "n_overlap", "n_overlap_b", "med_a", "med_b")


def gated(found: DataFrame, min_foreground: int = 256, min_fraction: float = 0.001) -> DataFrame:
    """found with reason: null for a pair to be trusted, or what it lacks and how much of it there is."""
    least = F.least("n_a", "n_b")
    thin = lambda n, all_: F.when(F.col(n) < min_fraction * F.col(all_), F.format_string("fraction %d of %d", n, all_))
    few = F.when(least < min_foreground, F.format_string(f"foreground %d of {min_foreground}", least))
    return found.withColumn("reason", F.coalesce(few, thin("n_a", "n_overlap"), thin("n_b", "n_overlap_b")))


def constraints(found: DataFrame) -> DataFrame:
    """(a, b, d, w) of trusted pairs: the log ratio of medians, weighed by the smaller foreground."""
    good = found.filter("reason is null") if "reason" in found.columns else found
    return good.select("a", "b", (F.ln("med_a") - F.ln("med_b")).alias("d"), F.least("n_a", "n_b").cast("double").alias("w"))


def drift(voxels: DataFrame, ranges_a: DataFrame, ranges_b: DataFrame, thresholds: DataFrame, tolerance: float = 0.15) -> DataFrame:
    """(a, b, n, ratio_low, ratio_high, unstable): whether b / a is the same on the dim and the bright half of a."""
    rows = matched(voxels, ranges_a, ranges_b, thresholds).filter((F.col("va") > F.col("thr")) & (F.col("vb") > F.col("thr")))
    split = rows.groupBy("a", "b").agg(F.percentile("va", F.lit(0.5)).alias("split"), F.count(F.lit(1)).alias("n"))
    rows = rows.join(F.broadcast(split), ["a", "b"]).withColumn("r", F.col("vb") / F.greatest("va", F.lit(1e-12)))  # a row per pair
    # medians from counts of equal ratios, summed before a pair's meet; their order is a sort that can spill
    half = rows.groupBy("a", "b", "n", (F.col("va") <= F.col("split")).alias("low"), "r").agg(F.count(F.lit(1)).alias("c"))
    own = Window.partitionBy("a", "b", "low")
    half = half.withColumn("up_to", F.sum("c").over(own.orderBy("r"))).withColumn("total", F.sum("c").over(own))
    at = lambda rank: F.when((F.col("up_to") >= rank) & (F.col("up_to") - F.col("c") < rank), F.col("r"))
    halves = half.groupBy("a", "b", "n", "low").agg(F.max("total").alias("total"), ((F.max(at(F.floor((F.col("total") + 1) / 2))) + F.max(at(F.floor(F.col("total") / 2) + 1))) / 2).alias("middle"))
    of = lambda low, c: F.max(F.when(F.col("low") == low, F.col(c)))
    found = halves.groupBy("a", "b", "n").agg(of(True, "middle").alias("ratio_low"), of(False, "middle").alias("ratio_high"), F.coalesce(of(True, "total"), F.lit(0)).alias("n_low"), F.coalesce(of(False, "total"), F.lit(0)).alias("n_high"))
    judged = (F.col("n") >= 128) & (F.col("n_low") >= 32) & (F.col("n_high") >= 32)
    return found.select("a", "b", "n", "ratio_low", "ratio_high", F.coalesce(judged & (F.col("ratio_low") > 0) & (F.abs(F.col("ratio_high") / F.col("ratio_low") - 1) > tolerance), F.lit(False)).alias("unstable"))

"""Histogram thresholds: Otsu, minimum cross-entropy (Li), a number, or the pooled one."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

METHODS = ("otsu", "li")


def histogram(voxels: DataFrame, *keys: str, value: str = "v") -> DataFrame:
    """(keys, v, n): at most 65536 rows a key; partial aggregation keeps the shuffle to that."""
    level = F.rint(F.least(F.greatest(F.col(value), F.lit(0)), F.lit(65535))).cast("int") if dict(voxels.dtypes)[value] in ("float", "double") else F.col(value)
    return voxels.groupBy(*keys, level.alias("v")).agg(F.count(F.lit(1)).alias("n"))


#: Equal bins between the least and the largest value, in which values that aren't counts are looked at.
BINS = 256


def binned(values: DataFrame, *keys: str, value: str = "v") -> DataFrame:
    """(keys, v, n) of real values: centers of BINS equal bins over each key's own range, which a first pass finds.

    A key of one value has that value. The last bin is closed; null and NaN don't count.
    """
    held = values.filter(~F.isnan(F.col(value).cast("double"))).select(*keys, F.col(value).cast("double").alias("v"))
    ends = held.groupBy(*keys).agg(F.min("v").alias("least"), F.max("v").alias("most"))
    rows = held.join(F.broadcast(ends), list(keys))  # a row per key
    number = F.least(F.floor((F.col("v") - F.col("least")) / (F.col("most") - F.col("least")) * BINS), F.lit(BINS - 1))
    counts = rows.groupBy(*keys, "least", "most", F.when(F.col("most") > F.col("least"), number).alias("bin")).agg(F.count(F.lit(1)).alias("n"))
    center = F.col("least") + (F.col("bin") + 0.5) * ((F.col("most") - F.col("least")) / BINS)
    return counts.select(*keys, F.coalesce(center, "least").alias("v"), "n")


def otsu(levels: DataFrame, *keys: str) -> DataFrame:
    """(keys, otsu): the lowest level that maximises the variance between the classes v <= level and v > level."""
    part = Window.partitionBy(*keys)
    upto = part.orderBy("v").rowsBetween(Window.unboundedPreceding, 0)
    n, s = F.col("n").cast("double"), (F.col("n") * F.col("v")).cast("double")
    rows = levels.select(*keys, "v", F.sum(n).over(upto).alias("w0"), F.sum(s).over(upto).alias("s0"), F.sum(n).over(part).alias("w"), F.sum(s).over(part).alias("s"))
    apart = F.col("s0") / F.col("w0") - (F.col("s") - F.col("s0")) / (F.col("w") - F.col("w0"))
    between = F.when(F.col("w0") < F.col("w"), F.col("w0") * (F.col("w") - F.col("w0")) * apart * apart).otherwise(F.lit(-1.0))
    return rows.select(*keys, "v", between.alias("b")).groupBy(*keys).agg(F.max(F.struct(F.col("b"), (-F.col("v")).alias("m"))).alias("top")).select(*keys, (-F.col("top.m")).cast("double").alias("otsu"))


def li(levels: DataFrame, *keys: str, rounds: int = 200) -> DataFrame:
    """(keys, li): the fixed point of the logarithmic mean of the class means, from the mean on, to half a count.

    Levels are shifted by the lowest. The histogram of a key is one array of at most 65536 entries.
    """
    rows = levels.groupBy(*keys).agg(F.collect_list(F.struct(F.col("v").cast("double").alias("v"), F.col("n").cast("double").alias("n"))).alias("h"), F.min("v").alias("low"), F.max("v").alias("high"))
    rows = rows.withColumn("h", F.expr("transform(h, e -> named_struct('v', e.v - low, 'n', e.n))"))
    rows = rows.withColumn("t", F.expr("aggregate(h, 0D, (s, e) -> s + e.v * e.n) / aggregate(h, 0D, (s, e) -> s + e.n)"))
    sums = "aggregate(h, named_struct('n', 0D, 's', 0D), (s, e) -> if(e.v > a.t, named_struct('n', s.n + e.n, 's', s.s + e.v * e.n), s))"
    below = "aggregate(h, named_struct('n', 0D, 's', 0D), (s, e) -> if(e.v <= a.t, named_struct('n', s.n + e.n, 's', s.s + e.v * e.n), s))"
    step = f"""if(a.done, a, transform(array(named_struct('f', {sums}, 'b', {below})), c -> if(c.b.s = 0, named_struct('t', a.t, 'done', true),
        transform(array((c.b.s / c.b.n - c.f.s / c.f.n) / (ln(c.b.s / c.b.n) - ln(c.f.s / c.f.n))), t -> named_struct('t', t, 'done', abs(t - a.t) <= 0.5))[0]))[0])"""
    fixed = F.expr(f"aggregate(sequence(1, {rounds}), named_struct('t', t, 'done', low = high), (a, k) -> {step}).t + low")
    return rows.select(*keys, fixed.alias("li"))


def catalogue(levels: DataFrame, *keys: str, bins: DataFrame | None = None) -> DataFrame:
    """Both thresholds of each key, from one histogram, or Otsu's from the ``bins`` of values that aren't counts."""
    return otsu(levels if bins is None else bins, *keys).join(li(levels, *keys), list(keys))


def resolve(levels: DataFrame, mode: str | float, *keys: str, bins: DataFrame | None = None) -> DataFrame:
    """(keys, threshold) by method, or the number itself for every key."""
    if not isinstance(mode, str):
        return levels.select(*keys).distinct().withColumn("threshold", F.lit(float(mode)))
    if mode not in METHODS:
        raise ValueError(f"{mode!r} is no threshold method; there are {METHODS}, or a number")
    found = otsu(levels if bins is None else bins, *keys) if mode == "otsu" else li(levels, *keys)
    return found.withColumnRenamed(mode, "threshold")


def sample_step(sample_voxels: int, z_step: int, step: int) -> Column:
    """Of (camera, nz, ny, nx), a row per setup: every how many of a setup's strided voxels are taken, so that it has its share of a camera's."""
    share = F.greatest(F.lit(1), F.floor(F.lit(sample_voxels) / F.count(F.lit(1)).over(Window.partitionBy("camera"))))
    taken = F.ceil(F.ceil(F.col("nz") / z_step) * F.col("ny") * F.col("nx") / step)
    return F.greatest(F.lit(1), F.ceil(taken / share))


def pooled(voxels: DataFrame, mode: str | float = "otsu", sample_voxels: int = 32_000_000, z_step: int = 4, step: int = 7) -> DataFrame:
    """(camera, threshold) from a strided sample: every 4th plane, every 7th voxel of these, then an even share a setup."""
    if not isinstance(mode, str):
        return voxels.select("camera").distinct().withColumn("threshold", F.lit(float(mode)))
    sizes = voxels.groupBy("camera", "setup").agg((F.max("z") + 1).alias("nz"), (F.max("y") + 1).alias("ny"), (F.max("x") + 1).alias("nx"))
    sizes = sizes.withColumn("keep", sample_step(sample_voxels, z_step, step))
    rows = voxels.filter(F.col("z") % z_step == 0).join(F.broadcast(sizes), ["camera", "setup"])  # a row per setup
    flat = F.expr(f"(z div {z_step}) * ny * nx + y * nx + x")
    rows = rows.withColumn("flat", flat).filter(F.col("flat") % step == 0).filter(F.expr(f"(flat div {step}) % keep = 0"))
    return resolve(histogram(rows, "camera"), mode, "camera")

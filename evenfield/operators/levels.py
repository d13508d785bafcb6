"""Pyramids, and fields brought to a level or another frame."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.columns import cell
from ..functions.numeric import axis_weights


def downsample(voxels: DataFrame, fz: int, fy: int, fx: int) -> DataFrame:
    """Means of blocks, rounded half to even; blocks at the end average what they have."""
    keys = [c for c in voxels.columns if c not in ("z", "y", "x", "v")]
    return voxels.groupBy(*keys, cell("z", fz).alias("z"), cell("y", fy).alias("y"), cell("x", fx).alias("x")).agg(F.rint(F.avg("v")).cast("int").alias("v"))


def level_factors(shapes: DataFrame) -> DataFrame:
    """(setup, level, fz, fy, fx) from (setup, level, nz, ny, nx): how many times smaller than level 0, rounded half to even."""
    first = shapes.filter("level = 0").select("setup", *(F.col(f"n{c}").alias(f"n{c}0") for c in "zyx"))
    rows = shapes.join(F.broadcast(first), "setup")  # a row per setup
    return rows.select("setup", "level", *(F.greatest(F.bround(F.col(f"n{c}0") / F.col(f"n{c}")), F.lit(1)).cast("int").alias(f"f{c}") for c in "zyx"))


def coarsest_level(shapes: list[tuple[int, int, int]], min_frame: int = 96) -> int:
    """The coarsest level, of (nz, ny, nx) each, whose frame is still ``min_frame`` wide and high; 0 if none is."""
    return max((k for k, (_, ny, nx) in enumerate(shapes) if min(ny, nx) >= min_frame), default=0)


def block_mean(fields: DataFrame, fy: int, fx: int, *values: str) -> DataFrame:
    """A field at a coarser level: means of its blocks."""
    return fields.groupBy("camera", cell("y", fy).alias("y"), cell("x", fx).alias("x")).agg(*(F.avg(c).alias(c) for c in values))


def fitted_to(fields: DataFrame, ny: int, nx: int) -> DataFrame:
    """A field cut to a frame, or continued to it by its last row and column."""
    spark = fields.sparkSession
    last = fields.groupBy("camera").agg(F.max("y").alias("ly"), F.max("x").alias("lx"))
    frame = spark.range(ny * nx).select(F.expr(f"cast(id div {nx} as int)").alias("ty"), F.expr(f"cast(id % {nx} as int)").alias("tx"))
    want = frame.crossJoin(F.broadcast(last)).select("camera", "ty", "tx", F.least("ty", "ly").alias("y"), F.least("tx", "lx").alias("x"))  # a row per camera
    return want.join(fields, ["camera", "y", "x"]).drop("y", "x").withColumnRenamed("ty", "y").withColumnRenamed("tx", "x")


def weight_table(spark: SparkSession, n_in: int, n_out: int, name: str) -> DataFrame:
    """(name, to, w): how much of each input position goes into each output position of a bilinear resize."""
    low, high, share = axis_weights(n_in, n_out)
    rows = [(int(i), k, float(w)) for k in range(n_out) for i, w in ((low[k], 1 - share[k]), (high[k], share[k])) if w]
    return spark.createDataFrame(rows, f"{name} int, to_{name} int, w_{name} double")


def resize(fields: DataFrame, frame: tuple[int, int], out: tuple[int, int], value: str) -> DataFrame:
    """(camera, y, x, value): bilinear resize with the corners of both frames aligned, one axis after the other."""
    spark, rows = fields.sparkSession, fields
    for name, n_in, n_out in (("y", frame[0], out[0]), ("x", frame[1], out[1])):
        table = F.broadcast(weight_table(spark, n_in, n_out, name))  # two rows an output position
        other = "x" if name == "y" else "y"
        rows = rows.join(table, name).groupBy("camera", F.col(f"to_{name}").alias(name), other).agg(F.sum(F.col(f"w_{name}") * F.col(value)).alias(value))
    return rows.select("camera", "y", "x", value)


def dct2(fields: DataFrame, frame: tuple[int, int], value: str) -> DataFrame:
    """(camera, u, v, coefficient): the orthonormal two-dimensional DCT-II, by joins with the basis of each axis."""
    from ..functions.numeric import dct_basis

    spark, rows = fields.sparkSession, fields
    for name, freq, n in (("y", "u", frame[0]), ("x", "v", frame[1])):
        basis = dct_basis(n)
        table = spark.createDataFrame([(i, k, float(basis[k, i])) for k in range(n) for i in range(n)], f"{name} int, {freq} int, b double")
        keep = "x" if name == "y" else "u"
        rows = rows.join(F.broadcast(table), name).groupBy("camera", freq, keep).agg(F.sum(F.col("b") * F.col(value)).alias(value))  # n * n rows
    return rows.select("camera", "u", "v", F.col(value).alias("coefficient"))


def histogram_entropy(values: DataFrame, low: float, high: float, bins: int = 1000) -> DataFrame:
    """(camera, entropy) of the density of v in low .. high; infinite where nothing lies there. The last bin is closed."""
    inside = values.filter((F.col("v") >= low) & (F.col("v") <= high))
    width = (high - low) / bins
    number = F.least(F.floor((F.col("v") - low) / F.lit(width)), F.lit(bins - 1))
    counts = inside.groupBy("camera", number.alias("bin")).agg(F.count(F.lit(1)).alias("n"))
    total = counts.groupBy("camera").agg(F.sum("n").alias("all"))
    p = F.col("n") / F.col("all") / F.lit(width)
    found = counts.join(F.broadcast(total), "camera").groupBy("camera").agg((-F.sum(p * F.ln(p)) * F.lit(width)).alias("entropy"))  # a row per camera
    return values.select("camera").distinct().join(found, "camera", "left").withColumn("entropy", F.coalesce("entropy", F.lit(float(np.inf))))

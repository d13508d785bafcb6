"""The tables that operators read and write.

``voxel(camera, setup, z, y, x, v)`` is the definitional layout: v is 0..65535 in an INT. ``chunk`` rows hold a block of
voxels each as little-endian uint16 bytes; ``sources.chunks`` converts between the two.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

VOXEL = "camera int, setup int, z int, y int, x int, v int"
CHUNK = "setup int, level int, z0 int, y0 int, x0 int, dz int, dy int, dx int, data binary"
#: The 21 quantile levels, in percent.
LEVELS = tuple(range(0, 101, 5))
#: Frame side and setups per camera of the voxel view of the embeddings table, and the world distance of its tiles.
SIDE, PER_CAMERA, STEP = 8, 5, 6


def embedding_voxels(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The embeddings table as 8 x 8 frames: a label is a setup, its vectors in order of vec_id are the z planes."""
    rows = spark.read.parquet(f"{sf_dir}/embeddings.parquet")
    z = (F.row_number().over(Window.partitionBy("label").orderBy("vec_id")) - 1).cast("int")
    long = rows.withColumn("z", z).select(F.col("label").cast("int").alias("setup"), "z", F.posexplode("embedding").alias("i", "e"))
    v = F.rint((F.col("e").cast("double") + 1) * 1000)
    return long.select(
        F.expr(f"cast(setup div {PER_CAMERA} as int)").alias("camera"), "setup", "z",
        F.expr(f"cast(i div {SIDE} as int)").alias("y"), F.expr(f"cast(i % {SIDE} as int)").alias("x"),
        F.least(F.greatest(v, F.lit(0.0)), F.lit(65535.0)).cast("int").alias("v"),
    )


def tiles_in_a_row(voxels: DataFrame) -> DataFrame:
    """(setup, size_*, affine): the geometry of the voxel view, each tile STEP columns after the one before."""
    sizes = voxels.groupBy("setup").agg(*((F.max(c) + 1).alias(f"size_{c}") for c in "xyz"))
    one, zero = F.lit(1.0), F.lit(0.0)
    affine = F.array(one, zero, zero, (F.col("setup") * STEP).cast("double"), zero, one, zero, zero, zero, zero, one, zero)
    return sizes.select("setup", "size_x", "size_y", "size_z", affine.alias("affine"))

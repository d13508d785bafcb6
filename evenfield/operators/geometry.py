"""Where tiles lie in the world, which overlap, and in which of their own voxels.

A tile is (setup, size_x, size_y, size_z, affine): 12 numbers, the rows of a 3 x 4 matrix from pixels to the world.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DoubleType

AXES = "xyz"


def compose(affines: list[list[float]]) -> list[float]:
    """The product of 3 x 4 matrices; the last listed acts first."""
    whole = np.eye(4)
    for a in affines:
        whole = whole @ np.vstack([np.asarray(a, float).reshape(3, 4), [0, 0, 0, 1]])
    return whole[:3].ravel().tolist()


@F.pandas_udf(ArrayType(DoubleType()))
def inverse_affine(affine: pd.Series) -> pd.Series:
    matrices = np.zeros((len(affine), 4, 4))
    matrices[:, :3] = np.array(affine.tolist(), float).reshape(-1, 3, 4)
    matrices[:, 3, 3] = 1
    return pd.Series(np.linalg.inv(matrices)[:, :3].reshape(-1, 12).tolist())


def _moved(affine: str, row: int, x: Column, y: Column, z: Column) -> Column:
    a = lambda k: F.get(F.col(affine), F.lit(4 * row + k))
    return a(0) * x + a(1) * y + a(2) * z + a(3)


def _corners(affine: str, low: list[Column], high: list[Column], row: int) -> tuple[Column, Column]:
    places = [_moved(affine, row, x, y, z) for x in (low[0], high[0]) for y in (low[1], high[1]) for z in (low[2], high[2])]
    return F.least(*places), F.greatest(*places)


def world_boxes(tiles: DataFrame) -> DataFrame:
    """tiles with min_* and max_*: the box around the eight moved corners."""
    low, high = [F.lit(0.0)] * 3, [F.col(f"size_{c}").cast("double") for c in AXES]
    out = {}
    for row, c in enumerate(AXES):
        out[f"min_{c}"], out[f"max_{c}"] = _corners("affine", low, high, row)
    return tiles.withColumns(out)


def overlap_pairs(boxes: DataFrame) -> DataFrame:
    """(a, b, min_*, max_*): pairs a < b whose boxes share a volume, and the box they share.

    Boxes are dealt to the cells of a grid as wide as the largest box, eight cells at most each, and joined by cell; a
    pair is told only in the cell that holds its shared box's lower corner. No product of all tiles is formed.
    """
    widths = boxes.agg(*(F.greatest(F.max(F.col(f"max_{c}") - F.col(f"min_{c}")), F.lit(1e-9)).alias(f"w_{c}") for c in AXES))
    rows = boxes.crossJoin(F.broadcast(widths))  # one row
    for c in AXES:
        rows = rows.withColumn(f"c_{c}", F.explode(F.sequence(F.floor(F.col(f"min_{c}") / F.col(f"w_{c}")), F.floor(F.col(f"max_{c}") / F.col(f"w_{c}")))))
    side = lambda s: rows.select(F.col("setup").alias(s), *(F.col(f"c_{c}") for c in AXES), *(F.col(f"w_{c}").alias(f"{s}_w_{c}") for c in AXES), *(F.col(f"{m}_{c}").alias(f"{s}_{m}_{c}") for m in ("min", "max") for c in AXES))
    both = side("a").join(side("b"), [f"c_{c}" for c in AXES]).filter("a < b")
    for c in AXES:
        both = both.withColumn(f"min_{c}", F.greatest(f"a_min_{c}", f"b_min_{c}")).withColumn(f"max_{c}", F.least(f"a_max_{c}", f"b_max_{c}"))
        both = both.filter((F.col(f"max_{c}") > F.col(f"min_{c}")) & (F.floor(F.col(f"min_{c}") / F.col(f"a_w_{c}")) == F.col(f"c_{c}")))
    return both.select("a", "b", *(f"{m}_{c}" for m in ("min", "max") for c in AXES))


def pixel_ranges(pairs: DataFrame, tiles: DataFrame, side: str, factors: tuple[int, int, int] = (1, 1, 1)) -> DataFrame:
    """(a, b, lo_*, hi_*): the voxels of one side's tile, at a level of these factors (x, y, z), that a pair's shared box covers."""
    own = tiles.select(F.col("setup").alias(side), inverse_affine("affine").alias("inverse"), *(f"size_{c}" for c in AXES))
    rows = pairs.join(own, side)
    low, high = [F.col(f"min_{c}") for c in AXES], [F.col(f"max_{c}") for c in AXES]
    out = {}
    for row, (c, f) in enumerate(zip(AXES, factors)):
        least, most = _corners("inverse", low, high, row)
        size = F.col(f"size_{c}")
        clipped = lambda v, size=size: F.least(F.greatest(v, F.lit(0.0)), size)
        shape = F.ceil(size / f)
        out[f"lo_{c}"] = F.least(F.greatest(F.floor(clipped(least) / f), F.lit(0)), shape).cast("int")
        out[f"hi_{c}"] = F.least(F.ceil(clipped(most) / f), shape).cast("int")
    return rows.withColumns(out).select("a", "b", *(f"{m}_{c}" for m in ("lo", "hi") for c in AXES))

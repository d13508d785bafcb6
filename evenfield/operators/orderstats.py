"""Order statistics of pixel columns: blockwise sorted averages, merged across setups, and their R-7 quantiles."""

from __future__ import annotations

from collections.abc import Iterator
from fractions import Fraction
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..model import LEVELS

MIN_DEPTH = 21
#: Ranks of columns up to so many times 21 values are taken from a table.
MOST_BLOCKS = 1000


def block_size(depth: int) -> int:
    """Samples per block for columns of this depth: the largest multiple of 21 below it."""
    if depth <= MIN_DEPTH:
        raise ValueError(f"{depth} planes are too few; {MIN_DEPTH + 1} are needed for {MIN_DEPTH} levels")
    return min(depth, (depth - 1) // MIN_DEPTH * MIN_DEPTH)


def block_size_column(depth: Column) -> Column:
    return (F.floor((depth - 1) / MIN_DEPTH) * MIN_DEPTH).cast("int")


def r7_position(n: int, q: float) -> tuple[int, float]:
    """(rank from 1, weight of the next rank) of a quantile among n values by the R-7 rule: n * q + (1 - q), rounded once."""
    place = float(n * Fraction(q) + Fraction(1.0 - q))
    rank = min(max(int(place), 1), max(n - 1, 1))
    return rank, min(max(place - rank, 0.0), 1.0)


@lru_cache(maxsize=1)
def _positions() -> list[tuple[int, list[int], list[float]]]:
    found = [(n, [r7_position(n, q / 100) for q in LEVELS]) for n in range(MIN_DEPTH, MIN_DEPTH * MOST_BLOCKS + 1, MIN_DEPTH)]
    return [(n, [r for r, _ in places], [w for _, w in places]) for n, places in found]


def with_quantiles(rows: DataFrame) -> DataFrame:
    """rows (with value) and qs, the 21 quantiles (1 - w) * low + w * high of each value array.

    Ranks and weights are the same for all arrays of a length; lengths are multiples of 21, and the table that is
    broadcast has a row, rounded once, for each up to MOST_BLOCKS of them. Those of longer arrays are computed where they
    are, which may round the last bit of a weight otherwise.
    """
    table = rows.sparkSession.createDataFrame(_positions(), "of_size int, ranks array<int>, weights array<double>")
    rows = rows.withColumn("sorted", F.array_sort("value")).withColumn("p", F.size("value"))
    rows = rows.join(F.broadcast(table), F.col("p") == F.col("of_size"), "left")
    parts = F.array(*(F.lit(q / 100) for q in LEVELS))
    rank = lambda q: F.least(F.greatest((F.col("p") * q + (1 - q)).cast("int"), F.lit(1)), F.col("p") - 1)
    weight = lambda q: F.least(F.greatest(F.col("p") * q + (1 - q) - rank(q), F.lit(0.0)), F.lit(1.0))
    rows = rows.withColumn("ranks", F.coalesce("ranks", F.transform(parts, rank))).withColumn("weights", F.coalesce("weights", F.transform(parts, weight)))
    return rows.withColumn("qs", F.expr("zip_with(ranks, weights, (r, w) -> (1 - w) * get(sorted, r - 1) + w * get(sorted, r))")).drop("sorted", "p", "of_size", "ranks", "weights")


def camera_depth(voxels: DataFrame) -> DataFrame:
    """(camera, depth): the smallest depth of a camera's setups."""
    return voxels.groupBy("camera", "setup").agg((F.max("z") + 1).alias("n")).groupBy("camera").agg(F.min("n").alias("depth"))


def fit(voxels: DataFrame) -> DataFrame:
    """(camera, setup, y, x, value, n, vmin, vmax) of every column of cameras deep enough.

    ``value`` averages the sorted blocks of the first whole blocks; n, vmin and vmax are over all samples. A column is
    an array of at most the camera's depth, so it is one row's memory.
    """
    depth = F.broadcast(camera_depth(voxels).filter(F.col("depth") > MIN_DEPTH))  # a row per camera
    rows = voxels.join(depth, "camera").filter("z < depth").groupBy("camera", "setup", "y", "x", "depth").agg(F.array_sort(F.collect_list(F.struct("z", "v"))).alias("zv"))
    rows = rows.withColumn("p", block_size_column(F.col("depth"))).withColumn("vals", F.expr("transform(zv, s -> cast(s.v as double))"))
    rows = rows.withColumn("blocks", F.expr("transform(sequence(0, cast(floor(depth / p) as int) - 1), i -> array_sort(slice(vals, i * p + 1, p)))"))
    value = F.expr("transform(sequence(0, p - 1), k -> aggregate(blocks, 0D, (s, b) -> s + get(b, k)) / size(blocks))")
    return rows.select("camera", "setup", "y", "x", value.alias("value"), F.size("vals").alias("n"), F.array_min("vals").cast("int").alias("vmin"), F.array_max("vals").cast("int").alias("vmax"))


#: Pixels that are folded together are those of a square of this side, in one task.
FOLD_SIDE = 16


def merge(fits: DataFrame) -> DataFrame:
    """(camera, y, x, value, n, vmin, vmax): fits of several setups as one, folded strictly in setup order, so that sums round alike on every run.

    Squares of pixels are dealt to tasks and sorted by setup; a task folds one setup after the other into the square's
    running values, so its memory is that of a square whatever the number of setups.
    """
    keys = ["camera", "sy", "sx"]
    rows = fits.select("camera", F.expr(f"cast(y div {FOLD_SIDE} as int)").alias("sy"), F.expr(f"cast(x div {FOLD_SIDE} as int)").alias("sx"), "setup", "y", "x", "n", "vmin", "vmax", "value")
    rows = rows.repartition(*keys).sortWithinPartitions(*keys, "setup", "y", "x")

    def fold(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, held = None, _Square()
        for batch in batches:
            at = np.stack([batch.column(c).to_numpy() for c in (*keys, "setup")]) if len(batch) else np.empty((4, 0), int)
            edges = np.flatnonzero(np.any(at[:, 1:] != at[:, :-1], axis=0)) + 1
            for a, b in zip([0, *edges], [*edges, len(batch)]):
                if a == b:
                    continue
                square = tuple(at[:3, a].tolist())
                if own is not None and square != own:
                    yield held.told(own[0])
                    held = _Square()
                own = square
                held.add(batch.slice(a, b - a))
        if own is not None:
            yield held.told(own[0])

    return rows.mapInArrow(fold, "camera int, y int, x int, value array<double>, n long, vmin int, vmax int")


class _Square:
    """Running values of a square's pixels."""

    def __init__(self):
        self.value: np.ndarray | None = None
        self.n = np.zeros(FOLD_SIDE**2)
        self.vmin, self.vmax = np.full(FOLD_SIDE**2, 1 << 31), np.full(FOLD_SIDE**2, -1)
        self.y, self.x = np.zeros((2, FOLD_SIDE**2), np.int32)

    def add(self, batch: pa.RecordBatch) -> None:
        """Rows of one setup, in which a pixel occurs once."""
        y, x, n = (batch.column(c).to_numpy() for c in ("y", "x", "n"))
        at = y % FOLD_SIDE * FOLD_SIDE + x % FOLD_SIDE
        value = batch.column("value").flatten().to_numpy().reshape(len(at), -1)
        if self.value is None:
            self.value = np.zeros((FOLD_SIDE**2, value.shape[1]))
        before, total = self.value[at], self.n[at] + n
        self.value[at] = np.where((self.n[at] == 0)[:, None], value, before + (n / total)[:, None] * (value - before))
        self.n[at], self.y[at], self.x[at] = total, y, x
        self.vmin[at] = np.minimum(self.vmin[at], batch.column("vmin").to_numpy())
        self.vmax[at] = np.maximum(self.vmax[at], batch.column("vmax").to_numpy())

    def told(self, camera: int) -> pa.RecordBatch:
        k = np.flatnonzero(self.n)
        value = self.value[k]
        lists = pa.ListArray.from_arrays(pa.array((np.arange(len(k) + 1) * value.shape[1]).astype(np.int32)), pa.array(value.ravel()))
        columns = [pa.array(np.full(len(k), camera, np.int32)), pa.array(self.y[k]), pa.array(self.x[k]), lists, pa.array(self.n[k].astype(np.int64)), pa.array(self.vmin[k].astype(np.int32)), pa.array(self.vmax[k].astype(np.int32))]
        return pa.RecordBatch.from_arrays(columns, ["camera", "y", "x", "value", "n", "vmin", "vmax"])


def quantile_planes(merged: DataFrame, *keys: str) -> DataFrame:
    """Rows (keys, plane, v): 21 rounded quantiles of every merged column."""
    return with_quantiles(merged).select(*keys, F.posexplode("qs").alias("plane", "q")).select(*keys, "plane", F.rint("q").cast("int").alias("v"))


def column_stats(voxels: DataFrame) -> DataFrame:
    """The 21 planes of every camera."""
    return quantile_planes(merge(fit(voxels)), "camera", "y", "x")


def column_extrema(voxels: DataFrame) -> DataFrame:
    merged = merge(fit(voxels))
    return merged.select("camera", "y", "x", F.col("vmin").alias("minimum"), F.col("vmax").alias("maximum"), "n")


def background_profile(fits: DataFrame, thresholds: DataFrame, stride: int = 8) -> DataFrame:
    """(camera, plane, level, n_columns): mean quantiles of columns that never reach the camera's threshold.

    Every ``stride``-th pixel of either axis is looked at; sums and counts are partial aggregates.
    """
    rows = fits.filter((F.col("x") % stride == 0) & (F.col("y") % stride == 0)).join(F.broadcast(thresholds.select("camera", "threshold")), "camera").filter("vmax < threshold")
    rows = with_quantiles(rows).select("camera", F.posexplode("qs").alias("plane", "q"))
    return rows.groupBy("camera", "plane").agg(F.avg("q").alias("level"), F.count(F.lit(1)).alias("n_columns"))


def raw_stack(voxels: DataFrame) -> DataFrame:
    """(camera, plane, y, x, v): all planes of all setups, cropped to the camera's depth, for cameras too shallow for columns."""
    depth = F.broadcast(camera_depth(voxels))
    order = voxels.select("camera", "setup").distinct().groupBy("camera").agg(F.sort_array(F.collect_set("setup")).alias("setups"))
    rows = voxels.join(depth, "camera").filter("z < depth").join(F.broadcast(order), "camera")
    return rows.select("camera", F.expr("cast((array_position(setups, setup) - 1) * depth + z as int)").alias("plane"), "y", "x", "v")

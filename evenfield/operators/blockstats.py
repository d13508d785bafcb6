"""Statistics of tiles and of the frame on chunk rows: thresholds, moments and emptiness without a row per voxel.

Each task sums what its chunks hold, so what is shuffled goes with levels, bins, setups and pixels of a chunk's plane, not with voxels. The twins
on long voxel rows (``thresholds``, ``tilestats``, ``emptiness``) define the results. ``kind`` is the chunks' type: ``<u2``
of counts as stored, ``<f8`` of corrected voxels.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import thresholds
from .blocks import SHAPE, histogram
from .tilestats import with_separation

ENDS = "setup int, least double, most double"


def _by_setup(batch: pa.RecordBatch, kind: str, *more: str) -> Iterator[tuple]:
    """(setup, values, more ...) of each chunk; NaN doesn't count."""
    for row in zip(batch.column("setup").to_pylist(), batch.column("data"), *(batch.column(c).to_pylist() for c in more)):
        values = np.frombuffer(row[1].as_buffer(), kind)
        yield row[0], values if kind == "<u2" else values[~np.isnan(values)], *row[2:]


def ends(chunks: DataFrame, kind: str = "<f8") -> DataFrame:
    """(setup, least, most): the range of each tile's values."""

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [(s, float(v.min()), float(v.max())) for s, v in _by_setup(batch, kind) if len(v)]
            columns = list(zip(*found)) or [(), (), ()]
            yield pa.RecordBatch.from_arrays([pa.array(columns[0], pa.int32()), pa.array(columns[1], pa.float64()), pa.array(columns[2], pa.float64())], ["setup", "least", "most"])

    return chunks.select("setup", "data").mapInArrow(find, ENDS).groupBy("setup").agg(F.min("least").alias("least"), F.max("most").alias("most"))


def counts(chunks: DataFrame, kind: str = "<u2") -> DataFrame:
    """(setup, binned, v, n): the histogram of levels of each tile, and for real values that of equal bins over its range too.

    Counts are read once; real values twice, for their range first.
    """
    if kind == "<u2":
        return histogram(chunks).select("setup", F.lit(False).alias("binned"), F.col("v").cast("double").alias("v"), "n")
    bins = thresholds.BINS

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            held: dict[int, tuple[np.ndarray, np.ndarray, float, float]] = {}
            for setup, v, least, most in _by_setup(batch, kind, "least", "most"):
                if setup not in held:
                    held[setup] = np.zeros(65536, np.int64), np.zeros(bins, np.int64), least, most
                levels, binned = held[setup][:2]
                levels += np.bincount(np.rint(np.clip(v, 0, 65535)).astype(np.int64), minlength=65536)
                place = np.minimum(np.floor((v - least) / (most - least) * bins), bins - 1) if most > least else np.zeros(len(v))
                binned += np.bincount(place.astype(np.int64), minlength=bins)
            for setup, (levels, binned, least, most) in held.items():
                centers = least + (np.arange(bins) + 0.5) * ((most - least) / bins)
                for told, values, n in ((False, np.arange(65536.0), levels), (True, centers, binned)):
                    at = np.flatnonzero(n)
                    yield pa.RecordBatch.from_arrays([pa.array(np.full(len(at), setup, np.int32)), pa.array(np.full(len(at), told)), pa.array(values[at]), pa.array(n[at])], ["setup", "binned", "v", "n"])

    rows = chunks.select("setup", "data").join(F.broadcast(ends(chunks, kind)), "setup")  # a row per setup
    return rows.mapInArrow(count, "setup int, binned boolean, v double, n long").groupBy("setup", "binned", "v").agg(F.sum("n").alias("n"))


def moments(chunks: DataFrame, limits: DataFrame, kind: str = "<f8") -> DataFrame:
    """``tilestats.moments`` of real values: sums of each class about the tile's threshold, added over tasks.

    Sums are taken about the threshold, which lies among the values, so that squares don't swallow a tile's spread.
    """
    names = [f"{s}_{c}" for c in ("fore", "back") for s in ("n", "s", "q")]

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            held: dict[tuple[int, float], np.ndarray] = {}
            for setup, v, threshold in _by_setup(batch, kind, "threshold"):
                off, above = v.astype(np.float64) - threshold, v > threshold
                own = np.array([f(x) for x in (off[above], off[~above]) for f in (len, np.sum, lambda y: np.dot(y, y))], np.float64)
                held[setup, threshold] = held.get((setup, threshold), 0) + own
            keys, sums = list(held), np.array(list(held.values())).reshape(-1, 6)
            yield pa.RecordBatch.from_arrays([pa.array([k for k, _ in keys], pa.int32()), pa.array([t for _, t in keys], pa.float64()), *(pa.array(sums[:, k]) for k in range(6))], ["setup", "threshold", *names])

    rows = chunks.select("setup", "data").join(F.broadcast(limits.select("setup", F.col("threshold").cast("double").alias("threshold"))), "setup")  # a row per setup
    sums = rows.mapInArrow(add, "setup int, threshold double, " + ", ".join(f"{n} double" for n in names)).groupBy("setup", "threshold").agg(*(F.sum(n).alias(n) for n in names))
    for s in "nsq":
        sums = sums.withColumn(f"{s}_all", F.col(f"{s}_fore") + F.col(f"{s}_back"))

    def stats(c: str, mean: str, std: str) -> list:
        n, s, q = (F.col(f"{x}_{c}") for x in "nsq")
        spread = F.greatest(q / n - (s / n) * (s / n), F.lit(0.0))
        return [F.when(n > 0, F.col("threshold") + s / n).alias(mean), F.when(n > 0, F.sqrt(spread)).alias(std)]

    return with_separation(sums.select("setup", "threshold", *stats("fore", "mean", "std"), *stats("back", "bg_mean", "bg_std"), *stats("all", "all_mean", "all_std"), F.col("n_fore").cast("long").alias("n_foreground"), F.col("n_all").cast("long").alias("n_voxels")))


def pooled(chunks: DataFrame, cameras: DataFrame, mode: str | float = "otsu", sample_voxels: int = 32_000_000, z_step: int = 4, step: int = 7) -> DataFrame:
    """``thresholds.pooled`` on chunks of counts: each task counts those of its voxels that the strides meet."""
    if not isinstance(mode, str):
        return cameras.select("camera").distinct().withColumn("threshold", F.lit(float(mode)))
    sizes = chunks.groupBy("setup").agg(*(F.max(F.col(f"{c}0") + F.col(f"d{c}")).alias(f"n{c}") for c in "zyx")).join(F.broadcast(cameras), "setup")
    sizes = sizes.withColumn("keep", thresholds.sample_step(sample_voxels, z_step, step))
    where = ["z0", "y0", "x0", *SHAPE, "camera", "ny", "nx", "keep"]

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            held: dict[int, np.ndarray] = {}
            for _, v, z0, y0, x0, dz, dy, dx, camera, ny, nx, keep in _by_setup(batch, "<u2", *where):
                z, y, x = z0 + np.arange(dz), y0 + np.arange(dy), x0 + np.arange(dx)
                planes = np.flatnonzero(z % z_step == 0)
                flat = (z[planes] // z_step)[:, None, None] * (ny * nx) + y[:, None] * nx + x
                taken = v.reshape(dz, dy, dx)[planes][(flat % step == 0) & (flat // step % keep == 0)]
                held[camera] = held.get(camera, 0) + np.bincount(taken, minlength=65536)
            for camera, n in held.items():
                at = np.flatnonzero(n)
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(at), camera, np.int32)), pa.array(at.astype(np.int32)), pa.array(n[at])], ["camera", "v", "n"])

    rows = chunks.filter(f"(z0 + {z_step - 1}) div {z_step} * {z_step} < z0 + dz").join(F.broadcast(sizes), "setup").select("setup", "data", *where)  # a row per setup
    levels = rows.mapInArrow(count, "camera int, v int, n long").groupBy("camera", "v").agg(F.sum("n").alias("n"))
    return thresholds.resolve(levels, mode, "camera")


def column_sums(chunks: DataFrame, cameras: DataFrame, limits: DataFrame) -> DataFrame:
    """``emptiness.column_sums`` on chunks: a row per pixel of a chunk's plane, whatever its depth."""
    rows = chunks.select("setup", "y0", "x0", *SHAPE, "data").join(F.broadcast(cameras), "setup").join(F.broadcast(limits.select("camera", F.col("threshold").cast("double").alias("threshold"))), "camera")  # a row per setup, per camera
    names = ["n", "n_above", "n_below", "sum_below"]

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for setup, v, y0, x0, dz, dy, dx, camera, threshold in _by_setup(batch, "<u2", "y0", "x0", *SHAPE, "camera", "threshold"):
                block = v.reshape(dz, dy * dx)
                below = block < threshold
                y, x = np.indices((dy, dx), np.int32).reshape(2, -1)
                sums = [np.full(dy * dx, dz), (block > threshold).sum(axis=0), below.sum(axis=0), np.where(below, block, 0).sum(axis=0, dtype=np.float64)]
                keys = [np.full(dy * dx, camera, np.int32), np.full(dy * dx, setup, np.int32), y + np.int32(y0), x + np.int32(x0)]
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in (*keys, *sums)], ["camera", "setup", "y", "x", *names])

    found = rows.mapInArrow(add, "camera int, setup int, y int, x int, n long, n_above long, n_below long, sum_below double")
    return found.groupBy("camera", "setup", "y", "x").agg(*(F.sum(n).alias(n) for n in names))

"""Chunk operators against their twins on long voxel rows."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from evenfield.operators import blocks, correct, levels, orderstats, thresholds
from evenfield.sources import stores

SIZE = (8, 4, 4)


@pytest.fixture(scope="module")
def data(spark):
    rng = np.random.default_rng(8)
    rows = [(s // 2, s, z, y, x, int(v)) for s in range(4) for (z, y, x), v in np.ndenumerate(rng.integers(0, 3000, (43 + s % 2, 6, 7)))]
    voxels = spark.createDataFrame(rows, "camera int, setup int, z int, y int, x int, v int").cache()
    cameras = voxels.select("camera", "setup").distinct().cache()
    return voxels, stores.to_chunks(voxels, SIZE).cache(), cameras


def same(a, b):
    a = a.select(b.columns)
    return a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


def fields(voxels):
    frame = voxels.select("camera", "y", "x").distinct()
    return frame.select("camera", "y", "x", (1 + 0.02 * F.col("x") - 0.03 * F.col("y")).alias("flat"), (20.0 + F.col("camera")).alias("dark"))


def test_histogram(data):
    voxels, chunks, _ = data
    assert same(blocks.histogram(chunks), thresholds.histogram(voxels, "setup"))


def test_fit(data):
    voxels, chunks, cameras = data
    assert same(blocks.fit(chunks, cameras), orderstats.fit(voxels))


@pytest.mark.parametrize("with_fields,with_tiles", [(True, False), (False, True), (True, True)])
def test_correct(spark, data, with_fields, with_tiles):
    voxels, chunks, cameras = data
    tiles = spark.createDataFrame([(0, "uniform", 9.0, 900.0, 2.0, 1500.0), (1, "bimodal", 1000.0, 800.0, 1.5, 1200.0), (2, "none", 0.0, 0.0, 1.0, 1.0), (3, "bimodal", -1.0, 800.0, 1.5, 1200.0)], "setup int, mode string, thr double, mean double, scale double, target_mean double")
    own, listed = fields(voxels) if with_fields else None, tiles if with_tiles else None
    found = stores.to_voxels(blocks.correct(chunks, cameras, own, listed, SIZE[1:]), cameras)
    assert same(found, correct.correct(voxels, own, listed))


def test_downsample(data):
    voxels, chunks, cameras = data
    found = stores.to_voxels(blocks.downsample(chunks, 4, 2, 2, 1), cameras)
    assert same(found, levels.downsample(voxels, 4, 2, 2))
    with pytest.raises(Exception, match="divide"):
        blocks.downsample(chunks, 3, 1, 1, 1).count()

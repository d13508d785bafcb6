"""Tile and frame statistics of chunk rows against their twins on voxel rows."""

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from evenfield.functions.columns import basic_corrected
from evenfield.operators import blocks, blockstats, emptiness, thresholds, tilestats
from evenfield.sources import stores

SIZE = (8, 4, 4)


@pytest.fixture(scope="module")
def data(spark):
    rng = np.random.default_rng(5)
    rows = []
    for s in range(4):
        tile = rng.integers(0, 300, (43 + s % 2, 6, 7)) + 2000 * (rng.random((43 + s % 2, 6, 7)) < 0.3)
        rows += [(s // 2, s, z, y, x, 77 if s == 3 else int(v)) for (z, y, x), v in np.ndenumerate(tile)]  # the last tile has one value
    voxels = spark.createDataFrame(rows, "camera int, setup int, z int, y int, x int, v int").cache()
    return voxels, stores.to_chunks(voxels, SIZE).cache(), voxels.select("camera", "setup").distinct().cache()


def real(voxels):
    """The chunks and rows of one correction."""
    frame = voxels.select("camera", "y", "x").distinct()
    fields = frame.select("camera", "y", "x", (1 + 0.02 * F.col("x") - 0.03 * F.col("y")).alias("flat"), (20.0 + F.col("camera")).alias("dark"))
    rows = voxels.join(fields, ["camera", "y", "x"])
    return fields, rows.select("camera", "setup", "z", "y", "x", basic_corrected(F.col("v").cast("double"), F.col("flat"), F.col("dark")).alias("v"))


def alike(a, b, *keys, rtol=1e-9):
    a, b = (x.toPandas().sort_values(list(keys)).reset_index(drop=True) for x in (a, b))
    assert len(a) and set(a.columns) == set(b.columns)
    pd.testing.assert_frame_equal(a[sorted(a.columns)], b[sorted(a.columns)], rtol=rtol, atol=1e-9, check_dtype=False)


def test_moments_of_counts(data):
    voxels, chunks, _ = data
    counts = blockstats.counts(chunks)
    limits = thresholds.otsu(counts, "setup").withColumnRenamed("otsu", "threshold")
    alike(limits, thresholds.otsu(thresholds.histogram(voxels, "setup"), "setup").withColumnRenamed("otsu", "threshold"), "setup")
    want = tilestats.moments(voxels, limits)
    alike(tilestats.moments_of_counts(counts, limits), want, "setup")
    alike(blockstats.moments(chunks, limits, "<u2"), want, "setup")
    assert np.isnan(want.filter("setup = 3").first()["mean"])  # a class without voxels


def test_real_values(data):
    voxels, chunks, cameras = data
    fields, rows = real(voxels)
    corrected = blocks.corrected_reals(chunks, cameras, fields, SIZE[1:])
    counts = blockstats.counts(corrected, "<f8")
    alike(counts.filter("not binned").drop("binned"), thresholds.histogram(rows, "setup"), "setup", "v")
    alike(counts.filter("binned").drop("binned"), thresholds.binned(rows, "setup"), "setup", "v")
    limits = thresholds.catalogue(counts.filter("not binned").select("setup", "v", "n"), "setup", bins=counts.filter("binned").drop("binned")).withColumnRenamed("otsu", "threshold")
    alike(blockstats.moments(corrected, limits), tilestats.moments(rows, limits), "setup")


def test_values_far_from_zero_keep_their_spread(spark):
    v = 1e9 + np.random.default_rng(1).normal(0, 1, 512)
    chunk = spark.createDataFrame([(0, 0, 0, 0, 0, 8, 8, 8, bytearray(v.tobytes()))], "setup int, level int, z0 int, y0 int, x0 int, dz int, dy int, dx int, data binary")
    got = blockstats.moments(chunk, spark.createDataFrame([(0, 1e9)], "setup int, threshold double")).first()
    assert got["all_std"] == pytest.approx(v.std(), rel=1e-6) and got["n_foreground"] == (v > 1e9).sum()


@pytest.mark.parametrize("sample", [32_000_000, 40])
def test_pooled_threshold(data, sample):
    voxels, chunks, cameras = data
    for mode in ("otsu", "li", 500.0):
        alike(blockstats.pooled(chunks, cameras, mode, sample), thresholds.pooled(voxels, mode, sample), "camera")


def test_columns_of_the_frame(spark, data):
    voxels, chunks, cameras = data
    limits = spark.createDataFrame([(0, 250.0), (1, 77.0)], "camera int, threshold double")
    alike(blockstats.column_sums(chunks, cameras, limits), emptiness.column_sums(voxels, limits), "setup", "y", "x")


def test_no_chunks_and_not_a_number(spark, data):
    _, chunks, cameras = data
    none = chunks.limit(0)
    assert blockstats.counts(none).count() == blockstats.counts(none, "<f8").count() == 0
    assert blockstats.moments(none, spark.createDataFrame([(0, 1.0)], "setup int, threshold double")).count() == 0
    v = np.array([np.nan, 1.0, 2.0, np.nan])
    chunk = spark.createDataFrame([(0, 0, 0, 0, 0, 1, 2, 2, bytearray(v.tobytes())), (1, 0, 0, 0, 0, 1, 1, 2, bytearray(v[[0, 3]].tobytes()))], chunks.schema)
    assert {(r.setup, r.n_voxels, r.all_mean) for r in blockstats.moments(chunk, spark.createDataFrame([(0, 1.0)], "setup int, threshold double")).collect()} == {(0, 2, 1.5)}
    assert {(r.setup, r.least, r.most) for r in blockstats.ends(chunk).collect()} == {(0, 1.0, 2.0)}

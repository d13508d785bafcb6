"""Chunk-level pairs, folds, pyramids and selection against their definitions."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from evenfield.model import CHUNK
from evenfield.operators import blockpairs, blocks, levels, orderstats, pairs, selection, thresholds
from evenfield.sources import stores


def tiles(spark, sizes, seed=0):
    """Voxel rows of random tiles."""
    rng = np.random.default_rng(seed)
    rows = []
    for s, size in enumerate(sizes):
        v = rng.integers(50, 400, size)
        rows += [(0, s, *map(int, at), int(v[at])) for at in np.ndindex(*size)]
    return spark.createDataFrame(rows, "camera int, setup int, z int, y int, x int, v int")


RANGES = "a int, b int, lo_x int, hi_x int, lo_y int, hi_y int, lo_z int, hi_z int"


@pytest.fixture(scope="module")
def overlap(spark):
    voxels = tiles(spark, [(9, 10, 12), (9, 11, 12), (8, 10, 9)]).cache()
    a = spark.createDataFrame([(0, 1, 5, 12, 0, 10, 1, 9), (0, 2, 3, 11, 2, 9, 0, 8), (1, 2, 0, 4, 0, 4, 0, 4)], RANGES)
    b = spark.createDataFrame([(0, 1, 0, 6, 1, 11, 0, 8), (0, 2, 0, 9, 0, 8, 0, 7), (1, 2, 5, 9, 6, 10, 4, 8)], RANGES)
    thr = spark.createDataFrame([(0, 120.0), (1, 180.0), (2, 90.5)], "setup int, thr double")
    return voxels, a, b, thr


def rows_of(df):
    return sorted(tuple(r) for r in df.collect())


@pytest.mark.parametrize("size", [(4, 4, 4), (3, 5, 7), (16, 16, 16)])
def test_pairs_of_chunks_are_those_of_voxels(spark, overlap, size):
    voxels, a, b, thr = overlap
    chunks = stores.to_chunks(voxels, size)
    crops = blockpairs.matched(chunks, a, b, thr, size)
    assert rows_of(crops.found()) == rows_of(pairs.intersection(voxels, a, b, thr))
    assert rows_of(crops.drift()) == rows_of(pairs.drift(voxels, a, b, thr))
    assert rows_of(blockpairs.alone(chunks, a, b, thr, size).found()) == rows_of(pairs.independent(voxels, a, b, thr))


def test_what_is_shuffled_are_overlapping_chunks(spark, overlap):
    voxels, a, b, thr = overlap
    size = (4, 4, 4)
    crops = blockpairs.matched(stores.to_chunks(voxels, size), a, b, thr, size)
    held = crops.rows.agg(F.sum(F.length("va")), F.sum(F.length("vb"))).first()
    n = pairs.matched(voxels, a, b, thr).count()
    assert tuple(held) == (2 * n, 2 * n)


def test_pairs_of_real_values(spark, overlap):
    voxels, a, b, thr = overlap
    real = voxels.withColumn("v", F.col("v") * 0.37 + F.col("x") / 3)
    thr = thr.withColumn("thr", F.col("thr") * 0.4)
    size = (4, 8, 8)
    whole = real.groupBy("setup", F.expr("z div 4").alias("cz"), F.expr("y div 8").alias("cy"), F.expr("x div 8").alias("cx"))

    def one(pdf):
        at = pdf[["z", "y", "x"]].to_numpy()
        low = at.min(axis=0)
        block = np.zeros(at.max(axis=0) - low + 1)
        block[tuple((at - low).T)] = pdf["v"]
        return pdf.head(1)[["setup"]].assign(level=0, z0=low[0], y0=low[1], x0=low[2], dz=block.shape[0], dy=block.shape[1], dx=block.shape[2], data=[block.tobytes()])

    crops = blockpairs.matched(whole.applyInPandas(one, CHUNK), a, b, thr, size, "<f8")
    assert rows_of(crops.found()) == rows_of(pairs.intersection(real, a, b, thr))
    assert rows_of(crops.drift()) == rows_of(pairs.drift(real, a, b, thr))


@pytest.mark.parametrize("part", [0.5, 0.05, 0.0, 1.0])
def test_selection_is_percentile_to_the_bit(spark, part):
    rng = np.random.default_rng(1)
    rows = [(k % 3, None if k % 17 == 0 else float(v)) for k, v in enumerate(np.concatenate([rng.normal(size=500) * 10.0 ** rng.integers(-12, 12, 500), np.repeat([0.0, -0.0, 7.5, -3.25], 30), rng.integers(0, 5, 200)]))]
    rows += [(7, 3.0), (8, None), (None, 2.0), (None, 4.0)]
    df = spark.createDataFrame(rows, "g int, v double").repartition(8)
    found = {r.g: (r.n, r.result) for r in selection.percentiles(df, ["g"], "v", part).collect()}
    want = {r.g: (r.n, r.p) for r in df.groupBy("g").agg(F.count("v").alias("n"), F.percentile("v", F.lit(part)).alias("p")).collect() if r.n}
    assert found == want


def test_a_group_is_spread_over_tasks_and_bits_keep_order(spark):
    df = spark.range(0, 20_000, 1, 8).select(F.lit(1).alias("g"), (F.rand(3) * 100).alias("v")).cache()
    got = selection.percentiles(df, ["g"], "v").first()
    assert got.result == df.agg(F.percentile("v", F.lit(0.5))).first()[0] and df.rdd.getNumPartitions() == 8
    v = np.array([-np.inf, -1e300, -1.0, -5e-324, 0.0, 5e-324, 1e-9, 2.0, np.inf])
    bits = selection.to_bits(v)
    assert (np.diff(bits) > 0).all() and (selection.from_bits(bits) == v).all()


def test_merge_folds_in_order_whatever_the_number_of_setups(spark):
    rng = np.random.default_rng(2)
    value = rng.normal(size=(40, 6, 21))
    n = rng.integers(22, 60, 40)
    rows = [(0, s, k // 3 * 9, k % 3 * 17, value[s, k].tolist(), int(n[s]), k, 100 - s) for s in range(40) for k in range(6)]
    df = spark.createDataFrame(rows, "camera int, setup int, y int, x int, value array<double>, n int, vmin int, vmax int").repartition(7)
    got = {(r.y, r.x): r for r in orderstats.merge(df).collect()}
    for k in range(6):
        own, total = value[0, k], float(n[0])
        for s in range(1, 40):
            own = own + (n[s] / (total + n[s])) * (value[s, k] - own)
            total += n[s]
        r = got[k // 3 * 9, k % 3 * 17]
        assert r.value == own.tolist() and (r.n, r.vmin, r.vmax) == (n.sum(), k, 100)


@pytest.mark.parametrize("size,out", [((4, 4, 4), (4, 4, 4)), ((3, 5, 7), (4, 4, 4)), ((8, 16, 16), (2, 3, 5))])
def test_all_levels_from_one_reading(spark, size, out):
    voxels = tiles(spark, [(9, 10, 13), (7, 11, 12)]).cache()
    sizes = spark.createDataFrame([(0, 9, 10, 13), (1, 7, 11, 12)], "setup int, nz int, ny int, nx int")
    factors = {0: (1, 1, 1), 1: (1, 2, 2), 2: (2, 3, 4), 3: (4, 4, 4)}
    found = blocks.pyramid(stores.to_chunks(voxels, size), sizes, factors, out).cache()
    assert found._jdf.queryExecution().optimizedPlan().toString().count("MapInArrow") == 1
    for level, three in factors.items():
        own = found.filter(F.col("level") == level)
        assert all(r.z0 % out[0] == 0 and r.y0 % out[1] == 0 and r.x0 % out[2] == 0 for r in own.collect())
        want = levels.downsample(voxels, *three).select("camera", "setup", "z", "y", "x", "v")
        assert rows_of(stores.to_voxels(own)) == rows_of(want)


def test_chunks_are_cut_and_spread_many_at_a_time(spark):
    voxels = tiles(spark, [(1500, 5, 6), (9, 10, 13)]).filter("(z + y * x) % 7 != 3").cache()
    cut = stores.to_chunks(voxels, (2, 4, 4))
    assert "FlatMapGroupsInPandas" not in cut._jdf.queryExecution().optimizedPlan().toString()  # a call of Python for each chunk
    found = stores.to_voxels(cut.withColumn("level", F.col("level") + 3), None, "level")
    assert found.filter("level != 3").count() == 0
    held = found.select("setup", "z", "y", "x", "v")
    want = voxels.select("setup", "z", "y", "x", "v")
    assert want.exceptAll(held).count() == 0 and held.join(want, ["setup", "z", "y", "x"], "left_anti").filter("v != 0").count() == 0
    assert cut.groupBy("setup", "z0", "y0", "x0").count().filter("count > 1").count() == 0
    large = stores.to_chunks(voxels, (1 << 20, 1 << 20, 1 << 20)).collect()
    assert sorted((r.setup, r.dz, r.dy, r.dx) for r in large) == [(0, 1500, 5, 6), (1, 9, 10, 13)]


def test_otsu_of_real_values(spark):
    rng = np.random.default_rng(4)
    v = np.concatenate([rng.normal(10, 1, 400), rng.normal(30.5, 3, 300)])
    df = spark.createDataFrame([(0, float(x)) for x in v] + [(1, 2.5), (1, 2.5)], "setup int, v double")
    counts, edges = np.histogram(v, 256)
    centers = (edges[:-1] + edges[1:]) / 2
    w0, w1 = np.cumsum(counts), np.cumsum(counts[::-1])[::-1]
    with np.errstate(all="ignore"):
        m0, m1 = np.cumsum(counts * centers) / w0, (np.cumsum((counts * centers)[::-1]) / w1[::-1])[::-1]
    between = w0[:-1] * w1[1:] * (m0[:-1] - m1[1:]) ** 2
    got = {r.setup: r.otsu for r in thresholds.otsu(thresholds.binned(df, "setup"), "setup").collect()}
    assert got[0] == pytest.approx(centers[np.nanargmax(between)]) and got[1] == 2.5

"""Operators against plain numpy, and against published or closed-form values."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from evenfield.functions import numeric
from evenfield.functions.columns import to_uint16
from evenfield.model import LEVELS
from evenfield.operators import correct, emptiness, gains, geometry, levels, orderstats, pairs, thresholds, tilestats, unmix
from evenfield.plans import flatfield


def table(spark, volumes, camera=lambda s: 0):
    rows = [(camera(s), s, int(z), int(y), int(x), int(v[z, y, x])) for s, v in volumes.items() for z, y, x in np.ndindex(v.shape)]
    return spark.createDataFrame(rows, "camera int, setup int, z int, y int, x int, v int").cache()


def block_average(a, p):
    n = len(a) // p
    return np.sort(np.asarray(a[: n * p], float).reshape(n, p), axis=1).mean(axis=0)


@pytest.mark.parametrize("depth,expected", [(22, 21), (42, 21), (43, 42), (63, 42), (945, 924)])
def test_block_size(depth, expected):
    assert orderstats.block_size(depth) == expected


@pytest.mark.parametrize("depth", [0, 20, 21])
def test_block_size_refuses_shallow_columns(depth):
    with pytest.raises(ValueError):
        orderstats.block_size(depth)


@pytest.mark.parametrize("depth", [30, 42, 63])
def test_column_stats_match_numpy(spark, depth):
    rng = np.random.default_rng(depth)
    vols = {s: rng.integers(0, 5000, (depth, 2, 3)) for s in range(3)}
    p = orderstats.block_size(depth)
    found = {(r["y"], r["x"], r["plane"]): r["v"] for r in orderstats.column_stats(table(spark, vols)).collect()}
    assert len(found) == 2 * 3 * 21
    for y in range(2):
        for x in range(3):
            merged, n = None, 0
            for s in range(3):
                value = block_average(vols[s][:, y, x], p)
                n += depth
                merged = value if merged is None else merged + depth / n * (value - merged)
            for k, q in enumerate(LEVELS):
                assert abs(found[y, x, k] - np.rint(np.quantile(merged, q / 100))) <= (abs(np.quantile(merged, q / 100) % 1 - 0.5) < 1e-9)


def test_shallow_cameras_are_stacked_raw(spark):
    vols = {0: np.arange(2 * 2 * 2).reshape(2, 2, 2), 1: np.ones((3, 2, 2), int)}
    rows = table(spark, vols)
    assert [r["camera"] for r in unmix.shallow_cameras(rows).collect()] == [0]
    stack = orderstats.raw_stack(rows)
    assert {r["plane"] for r in stack.collect()} == {0, 1, 2, 3}
    assert orderstats.column_stats(rows).count() == 0


def reference_li(v):
    low = v.min()
    v = v - low
    t, was = v.mean(), -1e9
    while abs(t - was) > 0.5:
        was, back, fore = t, v[v <= t].mean(), v[v > t].mean()
        if back == 0:
            break
        t = (back - fore) / (np.log(back) - np.log(fore))
    return t + low


def reference_otsu(v):
    best, at = -1, None
    for t in np.unique(v)[:-1]:
        a, b = v[v <= t], v[v > t]
        score = len(a) * len(b) * (a.mean() - b.mean()) ** 2
        if score > best:
            best, at = score, t
    return at


def test_thresholds_on_a_heavy_tail(spark):
    rng = np.random.default_rng(0)
    v = rng.poisson(4, 4 * 32 * 32).astype(float)
    tail = rng.random(v.size) < 0.03
    v[tail] += rng.lognormal(6, 1.2, tail.sum())
    v = v.clip(0, 65535).astype(int)
    found = thresholds.catalogue(thresholds.histogram(table(spark, {0: v.reshape(4, 32, 32), 1: v.reshape(4, 32, 32) + 500}), "setup"), "setup").collect()
    for r in found:
        own = v + 500 * r["setup"]
        assert r["otsu"] == reference_otsu(own)
        assert r["li"] == pytest.approx(reference_li(own), abs=1e-6)
    li, otsu = found[0]["li"], found[0]["otsu"]
    assert li < otsu / 4  # the tail draws Otsu's threshold into it, not Li's


def test_three_levels_and_a_constant_tile(spark):
    three = np.full((4, 64, 64), 100)
    three[0, :8] = 800
    three[0, 8:10] = 4000
    vols = {0: three[:, ::4, ::4], 1: np.full((2, 4, 4), 7)}
    found = {r["setup"]: r for r in thresholds.catalogue(thresholds.histogram(table(spark, vols), "setup"), "setup").collect()}
    assert found[1]["otsu"] == 7 and found[1]["li"] == 7
    assert found[0]["li"] == pytest.approx(reference_li(vols[0].ravel().astype(float)))


def test_a_number_is_the_threshold_of_all(spark):
    rows = table(spark, {0: np.ones((1, 2, 2), int), 1: np.ones((1, 2, 2), int)})
    assert {r["threshold"] for r in thresholds.resolve(thresholds.histogram(rows, "setup"), 5, "setup").collect()} == {5.0}
    with pytest.raises(ValueError):
        thresholds.resolve(rows, "mean", "setup")


def test_moments_and_kinds(spark):
    rng = np.random.default_rng(2)
    vols = {0: rng.integers(0, 4000, (4, 8, 8)), 1: np.full((4, 8, 8), 50), 2: rng.integers(2000, 4000, (4, 8, 8))}
    rows = table(spark, vols)
    own = spark.createDataFrame([(0, 1000.0), (1, 1000.0), (2, 1000.0)], "setup int, threshold double")
    stats = tilestats.moments(rows, own)
    by = {r["setup"]: r for r in stats.collect()}
    fore = vols[0][vols[0] > 1000]
    assert by[0]["mean"] == pytest.approx(fore.mean()) and by[0]["std"] == pytest.approx(fore.std())
    assert np.isnan(by[1]["mean"]) and by[1]["n_foreground"] == 0
    areas = spark.createDataFrame([(0, 0.3), (1, 0.9), (2, 0.0)], "setup int, empty_area double")
    assert {r["setup"]: r["kind"] for r in tilestats.classified(stats, areas).collect()} == {0: "bimodal", 1: "empty", 2: "uniform"}
    with pytest.raises(Exception, match="empty_area"):
        tilestats.classified(stats, areas.filter("setup = 0")).collect()


def test_records_of_two_writers_merge(spark):
    new = spark.createDataFrame([(1, 5.0, None), (2, 6.0, 1)], "setup int, mean double, k int")
    old = spark.createDataFrame([(1, 4.0, 9, 0.5), (3, 1.0, 2, 0.1)], "setup int, mean double, k int, empty_area double")
    assert {tuple(r) for r in tilestats.merged_records(new, old).collect()} == {(1, 5.0, 9, 0.5), (2, 6.0, 1, None), (3, 1.0, 2, 0.1)}


def test_emptiness_counts_neither_side_at_the_threshold(spark):
    v = np.array([[[10, 10]], [[10, 5]], [[10, 4]]])
    cols = emptiness.columns(table(spark, {0: v}), spark.createDataFrame([(0, 10.0)], "camera int, threshold double"))
    found = {r["x"]: r for r in cols.collect()}
    assert found[0]["is_empty"] and found[0]["below"] is None
    assert found[1]["is_empty"] and found[1]["below"] == 4.5
    pixels = emptiness.by_pixel(cols)
    assert emptiness.background_level(pixels).first()["level"] == 4.5
    assert emptiness.background_level(pixels.filter("bg_count = 0")).first()["level"] is None


def test_unmixing_takes_the_background_out(spark):
    planes = spark.createDataFrame([(0, 0, 0, 0, 100.0), (0, 0, 0, 1, 100.0)], "camera int, plane int, y int, x int, v double")
    pixels = spark.createDataFrame([(0, 0, 0, 0.5), (0, 0, 1, 1.0)], "camera int, y int, x int, phi double")
    found = {r["x"]: r["v"] for r in unmix.unmix(planes, pixels, spark.createDataFrame([(0, 60.0)], "camera int, level double")).collect()}
    assert found[0] == pytest.approx(140) and found[1] == pytest.approx((100 - 0.9 * 60) / 0.1)


def tile_rows(spark, places, size=(4, 8, 8)):
    rows = [(s, size[2], size[1], size[0], [1.0, 0.0, 0.0, float(x), 0.0, 1.0, 0.0, float(y), 0.0, 0.0, 1.0, float(z)]) for s, (x, y, z) in places.items()]
    return spark.createDataFrame(rows, "setup int, size_x int, size_y int, size_z int, affine array<double>")


def test_overlaps_are_those_of_all_pairs(spark):
    rng = np.random.default_rng(5)
    places = {k: rng.uniform(-40, 40, 3) for k in range(60)}
    found = geometry.overlap_pairs(geometry.world_boxes(tile_rows(spark, places))).collect()
    size = np.array([8, 8, 4])
    expected = {(a, b) for a in places for b in places if a < b and (np.minimum(places[a], places[b]) + size > np.maximum(places[a], places[b])).all()}
    assert len(found) == len(expected) and {(r["a"], r["b"]) for r in found} == expected


def test_touching_tiles_do_not_overlap(spark):
    assert geometry.overlap_pairs(geometry.world_boxes(tile_rows(spark, {0: (0, 0, 0), 1: (8, 0, 0)}))).count() == 0


def test_composed_affines_act_last_first():
    double, move = [2, 0, 0, 0, 0, 2, 0, 0, 0, 0, 2, 0], [1, 0, 0, 3, 0, 1, 0, 0, 0, 0, 1, 0]
    assert geometry.compose([double, move])[3] == 6


@pytest.mark.parametrize("estimator", [pairs.intersection, pairs.independent])
def test_a_pair_of_gain_two(spark, estimator):
    rng = np.random.default_rng(1)
    shared = rng.integers(600, 4000, (4, 8, 4))
    a, b = np.full((4, 8, 8), 100), np.full((4, 8, 8), 100)
    a[:, :, 4:], b[:, :, :4] = shared * 2, shared
    tiles = tile_rows(spark, {0: (0, 0, 0), 1: (4, 0, 0)})
    found = geometry.overlap_pairs(geometry.world_boxes(tiles))
    sides = [geometry.pixel_ranges(found, tiles, s) for s in "ab"]
    floors = spark.createDataFrame([(0, 500.0), (1, 500.0)], "setup int, thr double")
    rows = table(spark, {0: a, 1: b})
    measured = pairs.gated(estimator(rows, *sides, floors), 64)
    link = pairs.constraints(measured).first()
    assert link["d"] == pytest.approx(np.log(2)) and link["w"] == 128
    assert pairs.gated(measured.drop("reason"), 1000).first()["reason"].startswith("foreground ")
    assert not pairs.drift(rows, *sides, floors).first()["unstable"]


@pytest.mark.parametrize("estimator,sides", [(pairs.intersection, 2), (pairs.independent, 2), (pairs.drift, 4)])
def test_voxels_of_a_small_file_are_not_broadcast(spark, tmp_path, estimator, sides):
    spark.range(1 << 12).selectExpr("cast(id % 2 as int) as setup", "cast(id as int) as z", "0 as y", "0 as x", "7 as v").write.parquet(f"{tmp_path}/voxels")
    ranges = spark.createDataFrame([(0, 1, 0, 0, 0, 1, 1, 9)], "a int, b int, lo_x int, lo_y int, lo_z int, hi_x int, hi_y int, hi_z int")
    found = estimator(spark.read.parquet(f"{tmp_path}/voxels"), ranges, ranges, spark.createDataFrame([(0, 5.0), (1, 5.0)], "setup int, thr double"))
    joins = [line for line in found._jdf.queryExecution().sparkPlan().toString().split("\n") if "Join" in line]
    of_setups = [line for line in joins if "[own#" in line]
    assert len(of_setups) == sides and all("BroadcastHashJoin [own#" in line and "BuildRight" in line for line in of_setups)
    assert all("SortMergeJoin" in line for line in joins if "dx#" in line.split("], [")[0] and "[own#" not in line)


def test_a_ratio_that_moves_is_flagged(spark):
    base = np.concatenate([np.full(128, 600), np.full(128, 4000)]).reshape(4, 8, 8)
    other = np.where(base == 600, 200, 3800)
    tiles = tile_rows(spark, {0: (0, 0, 0), 1: (0, 0, 0)})
    found = geometry.overlap_pairs(geometry.world_boxes(tiles))
    sides = [geometry.pixel_ranges(found, tiles, s) for s in "ab"]
    assert pairs.drift(table(spark, {0: base, 1: other}), *sides, spark.createDataFrame([(0, 100.0), (1, 100.0)], "setup int, thr double")).first()["unstable"]


def test_gains_match_dense_least_squares(spark):
    rng = np.random.default_rng(3)
    links = [(a, b, float(rng.normal()), float(rng.integers(10, 100))) for a in range(6) for b in range(a + 1, 6) if rng.random() < 0.8]
    groups = spark.createDataFrame([(s, s) for s in range(7)], "setup int, grp int")
    found = {r["setup"]: r["gain"] for r in gains.solve(spark.createDataFrame(links, "a int, b int, d double, w double"), groups, 0.1).collect()}
    middle = np.median([w for *_, w in links])
    rows, right = [], []
    for a, b, d, w in links:
        row = np.zeros(7)
        row[a], row[b] = np.sqrt(w / middle), -np.sqrt(w / middle)
        rows.append(row)
        right.append(np.sqrt(w / middle) * d)
    logs = np.linalg.lstsq(np.vstack([*rows, np.sqrt(0.1) * np.eye(7)]), np.array([*right, *[0.0] * 7]), rcond=None)[0]
    for s in range(7):
        assert found[s] == pytest.approx(np.exp(logs[s]), rel=1e-9)
    assert found[6] == 1


def test_correction_branches(spark):
    rows = spark.createDataFrame([(0, s, 0, 0, x, v) for s in range(4) for x, v in enumerate((0, 50, 300, 65535))], "camera int, setup int, z int, y int, x int, v int")
    fields = spark.createDataFrame([(0, 0, x, 0.5 + 0.25 * x, 20.0) for x in range(4)], "camera int, y int, x int, flat double, dark double")
    tiles = spark.createDataFrame([(0, "uniform", 9.0, 200.0, 2.0, 150.0), (1, "bimodal", 100.0, 200.0, 2.0, 150.0), (2, "none", 0.0, 0.0, 1.0, 150.0)], "setup int, mode string, thr double, mean double, scale double, target_mean double")
    flat, raw = np.array([0.5, 0.75, 1.0, 1.25]), np.array([0, 50, 300, 65535.0])
    done = lambda c: np.rint(np.clip(c, 0, 65535)).astype(int).tolist()
    both = {s: [r["v"] for r in correct.correct(rows, fields, tiles).filter(F.col("setup") == s).orderBy("x").collect()] for s in range(4)}
    plain = (raw - 20) / flat
    assert both[0] == done((np.maximum(plain, 0) - 200) * 2 + 150)
    assert both[1] == done(np.where(plain > 100, (plain - 200) * 2 + 150, plain))
    assert both[2] == both[3] == done(plain)
    alone = {s: [r["v"] for r in correct.correct(rows, None, tiles).filter(F.col("setup") == s).orderBy("x").collect()] for s in range(4)}
    assert alone[0] == done((raw - 200) * 2 + 150)
    assert alone[1] == done(np.where(raw > 100, (raw - 200) * 2 + 150, raw))
    assert alone[3] == done(raw)


def test_many_gains_by_conjugate_gradients():
    rng = np.random.default_rng(3)
    n = 400
    a, b = rng.integers(0, n, 1500), rng.integers(0, n, 1500)
    a, b = a[a != b], b[a != b]
    w, d = rng.random(len(a)) + 0.1, rng.normal(size=len(a))
    dense, right = np.eye(n) * 0.1, np.zeros(n)
    for i, j, x, y in zip(a, b, w, d):
        dense[[i, j], [i, j]] += x
        dense[i, j] -= x
        dense[j, i] -= x
        right[i] += x * y
        right[j] -= x * y
    assert np.allclose(gains.balanced(a, b, w, w * d, n, 0.1), np.linalg.solve(dense, right), rtol=1e-10, atol=1e-12)
    assert not gains.balanced(a[:0], b[:0], w[:0], d[:0], 0, 0.1).size


def test_quantiles_of_columns_beyond_the_table(spark, monkeypatch):
    rows = spark.createDataFrame([([float(x) for x in np.random.default_rng(k).integers(0, 65536, 21 * k)],) for k in (1, 3, 7)], "value array<double>")
    whole = [r["qs"] for r in orderstats.with_quantiles(rows).collect()]
    orderstats._positions.cache_clear()
    monkeypatch.setattr(orderstats, "MOST_BLOCKS", 2)
    some = [r["qs"] for r in orderstats.with_quantiles(rows).collect()]
    orderstats._positions.cache_clear()
    assert np.allclose(whole, some, rtol=1e-12)


def test_gain_scale_is_clamped(spark):
    one = spark.createDataFrame([(0, "uniform", 0.0, 10.0, 1.0, 100.0, 50.0)], "setup int, kind string, threshold double, corrected_mean double, corrected_std double, target_mean double, target_std double")
    assert correct.rescaling(one).first()["scale"] == 8.0


def test_flat_floor_only_where_a_flat_is_not_positive(spark):
    rows = spark.createDataFrame([(0, 0, 0, 0.0, 1.0), (0, 0, 1, 0.0005, 1.0), (1, 0, 0, 0.0005, 1.0)], "camera int, y int, x int, flat double, dark double")
    assert {(r["camera"], r["x"]): r["flat"] for r in correct.floored(rows).collect()} == {(0, 0): 0.001, (0, 1): 0.001, (1, 0): 0.0005}


def test_downsampling_averages_what_is_there(spark):
    v = np.arange(3 * 5 * 4).reshape(3, 5, 4) * 7
    found = {(r["z"], r["y"], r["x"]): r["v"] for r in levels.downsample(table(spark, {0: v}), 2, 2, 2).collect()}
    assert len(found) == 2 * 3 * 2
    for (z, y, x), got in found.items():
        assert got == np.rint(v[2 * z : 2 * z + 2, 2 * y : 2 * y + 2, 2 * x : 2 * x + 2].mean())


def test_ties_round_to_even(spark):
    found = [r["v"] for r in spark.createDataFrame([(0.5,), (1.5,), (2.5,), (-3.0,), (70000.0,)], "a double").select(to_uint16(F.col("a")).alias("v")).collect()]
    assert found == [0, 2, 2, 0, 65535]


def test_coarsest_adequate_level():
    assert levels.coarsest_level([(9, 400, 400), (9, 200, 200), (9, 100, 100), (9, 50, 50)]) == 2
    assert levels.coarsest_level([(9, 60, 60)]) == 0


def test_cosine_transform_is_orthonormal():
    rng = np.random.default_rng(0)
    x = rng.normal(size=(24, 16)).astype(np.float32)
    y = numeric.dct2(x)
    assert np.linalg.norm(y) == pytest.approx(np.linalg.norm(x), rel=1e-5)
    assert np.abs(numeric.idct2(y) - x).max() < 1e-5


def test_resizing_a_ramp_keeps_it():
    ramp = np.tile(np.arange(32, dtype=float), (3, 1))
    assert np.allclose(numeric.resize(ramp, (3, 16))[0], np.arange(16) * 2 + 0.5)
    assert numeric.resize(ramp, (3, 64)).max() == 31


def vignetted(n=21, side=64, dark=0.0, seed=0):
    rng = np.random.default_rng(seed)
    y, x = np.indices((side, side))
    flat = 1 + 0.25 * np.cos(np.pi * (y - side / 2) / side) * np.cos(np.pi * (x - side / 2) / side)
    flat /= flat.mean()
    frames = np.stack([(rng.random((side, side)) ** 8 * 200 + 100 + 10 * k) * flat + dark for k in range(n)])
    return frames.astype(np.float32), flat


def test_fit_finds_the_flat_field():
    frames, flat = vignetted()
    found, _ = flatfield.fit_fields(frames, flatfield.FitParams(dark=False))
    assert found.mean() == pytest.approx(1, abs=1e-4)
    assert np.corrcoef(found.ravel(), flat.ravel())[0, 1] > 0.95
    assert np.abs(found - flat).max() < 0.1


def test_a_given_dark_field_is_held():
    frames, flat = vignetted(dark=120.0)
    found, dark = flatfield.fit_fields(frames, flatfield.FitParams(fixed_dark=120.0))
    assert np.allclose(dark, 120, rtol=1e-4)
    assert np.corrcoef(found.ravel(), flat.ravel())[0, 1] > 0.95


def test_fit_comes_back_in_the_frame_asked_for():
    frames, _ = vignetted(side=40)
    flat, dark = flatfield.fit_fields(frames, flatfield.FitParams(working_size=32), (80, 80))
    assert flat.shape == dark.shape == (80, 80)


def test_an_empty_stack_is_refused():
    with pytest.raises(ValueError):
        flatfield.fit_fields(np.zeros((3, 8, 8)))


def test_tuning_fits_each_candidate_once():
    frames, _ = vignetted(n=6, side=32)
    tuner = flatfield.Tuner(frames, flatfield.FitParams(iterations=20, rounds=1))
    lam, multiplier = tuner.best((0.5, 2.0), (0.5, 1.0, 2.0))
    assert multiplier in (0.5, 1.0, 2.0) and lam == pytest.approx(multiplier * tuner.base)
    assert len(tuner.costs) == 3
    noisy = np.ones((128, 128)) + np.random.default_rng(0).normal(0, 0.2, (128, 128))
    assert flatfield.rough_part(noisy) > flatfield.rough_part(np.ones((128, 128)))
    assert flatfield.entropy(np.zeros(3), 5, 6) == float("inf")

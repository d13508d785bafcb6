import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from evenfield import __main__ as cli
from evenfield import config
from evenfield.plans import pipeline
from evenfield.sources import spimdata, stores
from evenfield.streaming import tiles as streaming

XML = """<SpimData><SequenceDescription><ViewSetups>
<ViewSetup><id>0</id><size>8 8 24</size><voxelSize><unit>um</unit><size>0.1 0.2 0.4</size></voxelSize></ViewSetup>
<ViewSetup><id>1</id><size>8 8 24</size><voxelSize><unit>furlong</unit><size>1 1 1</size></voxelSize></ViewSetup>
</ViewSetups></SequenceDescription><ViewRegistrations>
<ViewRegistration timepoint="0" setup="0"><ViewTransform type="affine"><affine>1 0 0 5 0 1 0 0 0 0 1 0</affine></ViewTransform></ViewRegistration>
<ViewRegistration timepoint="0" setup="1"><ViewTransform type="affine"><affine>1 0 0 4 0 1 0 0 0 0 1 0</affine></ViewTransform><ViewTransform type="affine"><affine>1 0 0 7 0 1 0 0 0 0 1 0</affine></ViewTransform></ViewRegistration>
<ViewRegistration timepoint="1" setup="1"><ViewTransform type="affine"><affine>9 0 0 4 0 1 0 0 0 0 1 0</affine></ViewTransform></ViewRegistration>
</ViewRegistrations></SpimData>"""


def volume(setup):
    rng = np.random.default_rng(setup)
    v = rng.integers(90, 110, (24, 8, 8))
    v[:, 2:] += rng.integers(300, 900, (24, 6, 8)) * (setup + 1)
    return v


def voxels(spark):
    rows = [(s // 2, s, int(z), int(y), int(x), int(v[z, y, x])) for s in range(4) for v in [volume(s)] for z, y, x in np.ndindex(v.shape)]
    return spark.createDataFrame(rows, "camera int, setup int, z int, y int, x int, v int").cache()


def geometry(spark):
    return spark.createDataFrame([(s, 8, 8, 24, [1.0, 0.0, 0.0, 4.0 * s, 0.0, 1.0, 0.0, 0.0, 0.0, 0.0, 1.0, 0.0]) for s in range(4)], "setup int, size_x int, size_y int, size_z int, affine array<double>")


def test_geometry_file(spark, tmp_path):
    (tmp_path / "dataset.xml").write_text(XML)
    found = {r["setup"]: r for r in spimdata.setups(spark, str(tmp_path / "dataset.xml")).collect()}
    assert (found[0]["um_z"], found[0]["um_y"], found[0]["um_x"]) == (0.4, 0.2, 0.1)
    assert found[1]["um_x"] is None and found[1]["size_z"] == 24
    moved = {r["setup"]: r["affine"] for r in spimdata.registrations(spark, str(tmp_path / "dataset.xml")).collect()}
    assert moved[0][3] == 5 and moved[1][3] == 11
    assert spimdata.tiles(spark, str(tmp_path / "dataset.xml")).count() == 2


def test_translations_are_taken_over(tmp_path):
    (tmp_path / "a.xml").write_text(XML)
    (tmp_path / "b.xml").write_text(XML.replace("1 0 0 5 0", "1 0 0 77 0"))
    assert "1 0 0 5 0" in spimdata.sync_translations(tmp_path / "a.xml", tmp_path / "b.xml", {0: 0})


def test_whole_pipeline(spark, tmp_path):
    settings = config.Settings(results_root=str(tmp_path / "results"), output_path=str(tmp_path / "out"), output_format="zarr3", setup_ids=((0, 1), (2, 3)), chunk_size=(8, 8, 8), shard_size=(8, 8, 16),
                               stats_scale=0, tile_threshold="li", min_overlap_foreground=16, basic=config.Fitting(autotune=False, max_iterations=30, max_reweighting_iterations=2))
    source = {"voxels": lambda: voxels(spark), "tiles": geometry(spark)}
    assert pipeline.run(spark, settings, "both", **source) == list(pipeline.PIPELINES["both"])
    now = pipeline.Run(spark, settings, True, **source)
    planes = {r["plane"]: r["v"] for r in now.read("column_stats").filter("camera = 0 and y = 4 and x = 4").collect()}
    assert [planes[k] for k in range(21)] == sorted(planes.values())
    flat = np.array([r["flat"] for r in now.read("fields").filter("camera = 0").collect()])
    assert flat.mean() == pytest.approx(1, abs=1e-3)
    assert now.read("pairs").count() == 3 and now.read("targets").count() == 4
    corrected = now.corrected("both")
    assert corrected.count() == 4 * 24 * 64
    stored = stores.to_voxels(stores.chunks(spark, str(tmp_path / "out"), "zarr3", [0, 1, 2, 3])).select("setup", "z", "y", "x", "v")
    assert stored.exceptAll(corrected.select("setup", "z", "y", "x", "v")).count() == 0
    with pytest.raises(RuntimeError, match="apply_basic"):
        pipeline.Run(spark, settings, False, **source).int_aggregate()
    again = config.Settings(**{**settings.__dict__, "output_format": "tiff", "output_path": str(tmp_path / "tiff")})
    pipeline.Run(spark, again, True, **source).correct("basic")
    assert len(list((tmp_path / "tiff").glob("*.ome.tif"))) == 4


def test_coarse_levels_and_exports(spark, tmp_path):
    from evenfield.sources import tiff

    fit = config.Fitting(autotune=False, max_iterations=10, max_reweighting_iterations=1)
    settings = config.Settings(results_root=str(tmp_path), setup_ids=((0, 1), (2, 3)), stats_scale=1, basic_stats_level=1, basic_unmix_empty=True, tile_threshold="pooled", min_overlap_foreground=4, gain_grouping="tile", gain_estimator="independent", basic=fit)
    source = {"voxels": lambda: voxels(spark), "tiles": geometry(spark)}
    pipeline.run(spark, settings, "both", None, "int-aggregate", **source)
    now = pipeline.Run(spark, settings, True, **source)
    assert now.read("fields").count() == 2 * 64 and now.read("fields_coarse").count() == 2 * 16
    assert now.read("tile_stats").first()["n_voxels"] == 24 * 16
    now.stage("export", "auto")
    flat = tiff.read_plane(tmp_path / "camera1/Flat-field.tif", (8, 8))
    assert flat.shape == (8, 8) and len(tiff.read(tmp_path / "camera2/qstack.tif")[0]) == 21
    assert (tmp_path / "intensity_target.json").exists()


def test_from_store_to_store(spark, tmp_path):
    """The chunk path, with a pyramid, gives what the long path gives; chunks that don't fit are cut anew."""
    from evenfield.operators import levels

    source = voxels(spark)
    shapes = {s: (24, 8, 8) for s in range(4)}
    stores.write(stores.to_chunks(source, (8, 4, 4)), str(tmp_path / "in"), "n5", shapes, (8, 4, 4), (8, 4, 4))
    small = levels.downsample(source, 2, 2, 2)
    stores.write(stores.to_chunks(small, (8, 4, 4), 1), str(tmp_path / "in"), "n5", {s: (12, 4, 4) for s in shapes}, (8, 4, 4), (8, 4, 4), 1)
    expected = None
    for name, chunk in (("same", (4, 4, 8)), ("other", (3, 4, 8))):
        settings = config.Settings(results_root=str(tmp_path / "results"), input_path=str(tmp_path / "in"), input_format="n5", output_path=str(tmp_path / name), output_format="zarr3_zyx", setup_ids=((0, 1), (2, 3)), chunk_size=chunk, shard_size=(2 * chunk[0], 8, 16), stats_scale=0, min_overlap_foreground=16, basic=config.Fitting(autotune=False, max_iterations=20, max_reweighting_iterations=1))
        now = pipeline.Run(spark, settings, False, tiles=geometry(spark))
        if expected is None:
            for stage in ("emptiness", "stats", "qstack", "basic", "int-stats", "int-aggregate"):
                now.stage(stage, "auto")
            expected = now.corrected("both")
        now.correct("both")
        assert now.has("corrected_chunks") and not now.has("corrected")
        for level, rows in ((0, expected), (1, levels.downsample(expected, 2, 2, 2))):
            found = stores.to_voxels(stores.chunks(spark, str(tmp_path / name), "zarr3_zyx", [0, 1, 2, 3], level), now.cameras)
            assert found.select(rows.columns).exceptAll(rows).count() == 0


def test_a_part_of_the_dataset(spark, tmp_path):
    fit = config.Fitting(autotune=False, max_iterations=10, max_reweighting_iterations=1)
    settings = config.Settings(results_root=str(tmp_path), setup_ids=((0, 1), (2, 3)), stats_scale=0, tile_threshold="li", basic=fit)
    whole = pipeline.Run(spark, settings, voxels=lambda: voxels(spark))
    for stage in ("emptiness", "stats", "qstack", "basic", "int-stats"):
        whole.stage(stage, "auto")
    before = {name: whole.read(name).toPandas() for name in ("column_stats", "fields", "tile_stats")}
    brighter = lambda: voxels(spark).selectExpr("camera", "setup", "z", "y", "x", "v + 100 as v")
    part = pipeline.Run(spark, settings, voxels=brighter, only_cameras=[1])
    for stage in ("stats", "qstack", "basic"):
        part.stage(stage, "auto")
    pipeline.Run(spark, settings, voxels=brighter, only_setups=[2]).stage("int-stats", "auto")
    after = {name: whole.read(name).toPandas() for name in before}
    for name, key, changed in (("column_stats", "camera", 1), ("tile_stats", "setup", 2)):
        value = "v" if key == "camera" else "all_mean"
        assert len(after[name]) == len(before[name])
        for k, rows in before[name].groupby(key):
            shift = after[name][after[name][key] == k][value].mean() - rows[value].mean()
            assert shift == pytest.approx(100 if k == changed else 0, abs=1e-6)
    assert len(after["fields"]) == len(before["fields"])
    for wrong in ({"only_cameras": [7]}, {"only_setups": [9]}, {"only_cameras": [0], "only_setups": [3]}):
        with pytest.raises(ValueError):
            pipeline.Run(spark, settings, **wrong)
    with pytest.raises(ValueError, match="cameras"):
        pipeline.Run(spark, settings, only_setups=[1]).stage("stats", "auto")
    with pytest.raises(ValueError, match="whole"):
        part.stage("int-aggregate", "auto")


def test_what_is_out_of_date_is_told(spark, tmp_path):
    settings = config.Settings(results_root=str(tmp_path), setup_ids=((0, 1), (2, 3)), stats_scale=0, tile_threshold="li", basic=config.Fitting(autotune=False, max_iterations=5, max_reweighting_iterations=1))
    now = pipeline.Run(spark, settings, voxels=lambda: voxels(spark))
    now.stage("emptiness", "auto")
    other = config.replace(settings, empty_occupancy_floor=0.5)
    with pytest.warns(UserWarning, match="other settings"):
        pipeline.Run(spark, other, voxels=lambda: voxels(spark)).stage("emptiness", "auto")
    now.stage("stats", "auto")
    now.stage("qstack", "auto")
    with pytest.warns(UserWarning, match="frame"):
        pipeline.Run(spark, settings, voxels=lambda: voxels(spark).filter("x < 6")).stage("basic", "auto")


def test_a_penalty_at_the_edge_is_told(spark, tmp_path, monkeypatch):
    settings = config.Settings(results_root=str(tmp_path), setup_ids=((0, 1), (2, 3)))
    now = pipeline.Run(spark, settings, voxels=lambda: voxels(spark))
    tuned = spark.createDataFrame([(0, 0.5, 10.0), (1, 0.5, 1.0)], "camera int, lam double, multiplier double")
    monkeypatch.setattr(pipeline.flatfield, "tune_cameras", lambda *_: tuned)
    with pytest.warns(UserWarning, match="camera 0") as told:
        assert now.tuned(None, None) == {0: 0.5, 1: 0.5}
    assert sum("edge" in str(w.message) for w in told) == 1


def test_files_of_some_cameras_are_refused(spark, tmp_path):
    from evenfield.sources import tiff

    settings = config.Settings(results_root=str(tmp_path / "results"), setup_ids=((0, 1), (2, 3)))
    now = pipeline.Run(spark, settings, voxels=lambda: voxels(spark))
    assert now.take(str(tmp_path / "none")) == []
    for name in tiff.FIELDS.values():
        tiff.write_plane(tmp_path / f"own/camera1/{name}.tif", np.ones((8, 8)))
    with pytest.raises(RuntimeError, match="only"):
        now.take(str(tmp_path / "own"))
    for name in tiff.FIELDS.values():
        tiff.write_plane(tmp_path / f"own/camera2/{name}.tif", np.ones((8, 8)))
    assert now.take(str(tmp_path / "own")) == ["fields"] and now.read("fields").count() == 128


def test_names_of_the_package():
    import evenfield

    assert evenfield.Settings is config.Settings and evenfield.Run is pipeline.Run
    with pytest.raises(AttributeError):
        evenfield.nothing


def test_plans_and_modes():
    assert pipeline.plan("basic", "qstack", "basic") == ["qstack", "basic"]
    for wrong in (("none",), ("basic", "correct", "stats"), ("basic", "int-stats")):
        with pytest.raises(ValueError):
            pipeline.plan(*wrong)
    assert pipeline.resolve_mode("auto", True, True) == "both"
    assert pipeline.resolve_mode("auto", False, True) == "intensity"
    for mode, fields, target in (("auto", False, False), ("basic", False, True), ("both", True, False)):
        with pytest.raises(RuntimeError):
            pipeline.resolve_mode(mode, fields, target)


def test_settings(tmp_path):
    path = tmp_path / "i.toml"
    path.write_text('[illumination]\nresults_root = "r"\nlast_setup = 4\nsetups_per_camera = 2\nautotune = false\n[illumination.basic]\nlambda = 0.5\n')
    s = config.load(path)
    assert s.cameras == [[0, 1], [2, 3], [4]] and s.camera_of(3) == 1
    assert s.basic.lam == 0.5 and not s.basic.autotune and s.penalty == 1e-6
    config.save(s, path, gain_grouping="tile", gain_lambda=0.0)
    assert config.load(path).penalty == 0.0 and config.load(path).basic.lam == 0.5
    for text in ('input_format = "tiff"', 'format = "n5"', "nothing = 1", 'gain_floor = "mean"'):
        path.write_text(f"[illumination]\n{text}\n")
        with pytest.raises(ValueError):
            config.load(path)


def test_command_line(tmp_path, capsys):
    path = tmp_path / "i.toml"
    path.write_text('[anything]\nresults_root = "r"\ninput_intensity_path = "in"\nlsf_project = "p"\n')
    assert cli.main(["--config", str(path), "run", "both", "--start-at", "basic", "--dry-run"]) == 0
    assert capsys.readouterr().out.split() == ["basic", "int-stats", "int-aggregate", "correct"]
    cli.main(["--config", str(path), "submit", "both", "--executors", "4"])
    assert "--num-executors 4" in capsys.readouterr().out
    cli.main(["--config", str(path), "set", "tile_threshold=500", "gain_grouping=tile"])
    assert config.load(path).tile_threshold == 500 and config.load(path).input_path == "in"


def test_tiles_that_arrive_add_up(spark, tmp_path):
    from evenfield.operators import emptiness, thresholds

    rows = voxels(spark)
    limits = spark.createDataFrame([(0, 200.0), (1, 200.0)], "camera int, threshold double")
    for part in (0, 1, 2):  # every tile arrives in three batches
        rows.filter(f"(z + setup) % 3 = {part}").coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
        streaming.watch(spark, str(tmp_path / "in"), str(tmp_path / "out"), limits).awaitTermination(120)
    found = {tuple(r) for r in streaming.pixels(spark, str(tmp_path / "out")).select("camera", "y", "x", "phi", "bg_count").collect()}
    assert found == {tuple(r) for r in emptiness.by_pixel(emptiness.columns(rows, limits)).select("camera", "y", "x", "phi", "bg_count").collect()}
    whole = thresholds.resolve(thresholds.histogram(rows, "setup"), "otsu", "setup")
    assert {tuple(r) for r in streaming.tile_thresholds(spark, str(tmp_path / "out"), "otsu").collect()} == {tuple(r) for r in whole.collect()}


def test_each_camera_gets_its_own_measured_dark(spark):
    from evenfield.plans import flatfield

    rows = [(c, p, y, x, 100.0 * (c + 1) + 40 * p + y) for c in (0, 1) for p in range(4) for y in range(6) for x in range(5)]
    stack = spark.createDataFrame(rows, "camera int, plane int, y int, x int, v double")
    found = flatfield.fit_cameras(stack, flatfield.FitParams(iterations=20, rounds=1), darks={0: 30.0, 1: 75.0})
    assert {(r["camera"], round(r["dark"], 3)) for r in found.collect()} == {(0, 30.0), (1, 75.0)}


def test_chunk_level_pairs_in_a_run(spark, tmp_path):
    """Stages on a store give what they give on long rows, raw and corrected."""
    source = voxels(spark).cache()
    stores.write(stores.to_chunks(source, (8, 4, 4)), str(tmp_path / "in"), "n5", {s: (24, 8, 8) for s in range(4)}, (8, 4, 4), (8, 4, 4))
    own = dict(setup_ids=((0, 1), (2, 3)), stats_scale=0, min_overlap_foreground=16, basic=config.Fitting(autotune=False, max_iterations=10, max_reweighting_iterations=1))
    stages = ("emptiness", "stats", "qstack", "basic", "int-stats", "int-aggregate")
    for estimator, apply_basic in (("intersection", False), ("independent", False), ("intersection", True)):
        place = tmp_path / f"{estimator}-{apply_basic}"
        stored = pipeline.Run(spark, config.Settings(results_root=str(place / "a"), input_path=str(tmp_path / "in"), input_format="n5", gain_estimator=estimator, **own), apply_basic, tiles=geometry(spark))
        long = pipeline.Run(spark, config.Settings(results_root=str(place / "b"), gain_estimator=estimator, **own), apply_basic, voxels=lambda: source, tiles=geometry(spark))
        for stage in stages:
            stored.stage(stage, "auto")
            if stage == "int-stats" and apply_basic:  # the two paths' fields differ in the last bits
                long.keep("fields", stored.read("fields"))
            long.stage(stage, "auto")
        for name in ("pair_medians", "pair_drift", "targets"):
            if stored.has(name):
                a, b = (r.read(name).toPandas().sort_values(["a", "b"] if name != "targets" else "setup").reset_index(drop=True) for r in (stored, long))
                pd.testing.assert_frame_equal(a, b[a.columns], rtol=1e-9)
            else:
                assert not long.has(name)


def test_one_changed_file_touches_one_tile(spark, tmp_path):
    source = voxels(spark).cache()
    shapes = {s: (24, 8, 8) for s in range(4)}
    write = lambda rows, part: stores.write(stores.to_chunks(rows, (8, 4, 4)), str(tmp_path / "in"), "n5", part, (8, 4, 4), (8, 4, 4))
    write(source, shapes)
    settings = config.Settings(results_root=str(tmp_path / "out"), input_path=str(tmp_path / "in"), input_format="n5", setup_ids=((0, 1), (2, 3)), stats_scale=0, tile_threshold="li")
    now = pipeline.Run(spark, settings)
    assert now.refresh_tile_stats() == [0, 1, 2, 3] and now.refresh_tile_stats() == []
    brighter = source.withColumn("v", F.when((F.col("setup") == 2) & (F.col("z") < 8) & (F.col("y") < 4) & (F.col("x") < 4), F.col("v") + 100).otherwise(F.col("v")))
    write(brighter.filter("setup = 2"), {2: shapes[2]})
    assert now.refresh_tile_stats() == [2]
    whole = pipeline.Run(spark, settings.__class__(**(settings.__dict__ | {"results_root": str(tmp_path / "whole")})))
    whole.int_stats()
    a, b = (r.read("tile_stats").toPandas().sort_values("setup").reset_index(drop=True) for r in (now, whole))
    pd.testing.assert_frame_equal(a, b[a.columns])


def test_emptiness_that_fails_is_told_only(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(pipeline.Run, "emptiness", lambda self: 1 / 0)
    settings = config.Settings(results_root=str(tmp_path), setup_ids=((0, 1), (2, 3)), stats_scale=0)
    with pytest.warns(UserWarning, match="emptiness failed"):
        assert pipeline.run(spark, settings, "basic", stop_after="stats", voxels=lambda: voxels(spark)) == ["emptiness", "stats"]


def test_an_empty_part_from_its_old_place_is_turned_to_the_planes(spark, tmp_path):
    from evenfield.sources import tiff

    y, x = np.indices((6, 9))
    phi = (y / 20 + x / 40).astype(np.float32)
    for camera in (1, 2):
        tiff.write_plane(tmp_path / f"basic_empty_fraction_camera{camera}.tif", phi.T)
    now = pipeline.Run(spark, config.Settings(results_root=str(tmp_path / "out"), setup_ids=((0, 1), (2, 3))), voxels=lambda: voxels(spark))
    assert now.take(str(tmp_path)) == ["empty_pixels"]
    planes = spark.createDataFrame([(c, 5, 8) for c in (0, 1)], "camera int, y int, x int")
    with pytest.warns(UserWarning, match="turned"):
        found = now._in_frame(now.read("empty_pixels"), planes).toPandas()
    assert len(found) == 2 * phi.size and np.allclose(found["phi"], phi[found["y"], found["x"]])

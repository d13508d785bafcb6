"""The Spark source and sink of chunk stores: fill values, pruning before files are opened, jobs that fail."""

import json

import numpy as np
import pytest
from pyspark.sql import functions as F
from pyspark.sql.datasource import EqualTo, GreaterThanOrEqual, In, LessThan

from evenfield.model import CHUNK
from evenfield.operators import blocks, levels, orderstats, thresholds
from evenfield.sources import files, source, stores

SIZE, CHUNKS, SHARD = (48, 8, 8), (16, 4, 4), (32, 8, 8)


def sparse(spark, setup=0):
    """Chunk rows of which planes 16 to 31 and one corner are zero, and are left out."""
    rng = np.random.default_rng(setup)
    volume = rng.integers(100, 5000, SIZE).astype("<u2")
    volume[16:32] = 0
    volume[:16, :4, :4] = 0
    rows = []
    for z in range(0, 48, 16):
        for y in (0, 4):
            for x in (0, 4):
                block = volume[z : z + 16, y : y + 4, x : x + 4]
                if block.any():
                    rows.append((setup, 0, z, y, x, *block.shape, block.tobytes()))
    return volume, spark.createDataFrame(rows, CHUNK)


def dense(rows):
    found = np.full(SIZE, 65535, np.uint16)
    for r in rows.collect():
        found[r.z0 : r.z0 + r.dz, r.y0 : r.y0 + r.dy, r.x0 : r.x0 + r.dx] = np.frombuffer(r.data, "<u2").reshape(r.dz, r.dy, r.dx)
    return found


@pytest.mark.parametrize("fmt", stores.FORMATS)
def test_what_is_not_stored_is_zeros(spark, tmp_path, fmt):
    volume, rows = sparse(spark)
    stores.write(rows, str(tmp_path), fmt, {0: SIZE}, CHUNKS, SHARD)
    found = stores.chunks(spark, str(tmp_path), fmt, [0])
    assert (dense(found) == volume).all() and found.count() == 12
    cameras = spark.createDataFrame([(0, 0)], "setup int, camera int")
    long = stores.to_voxels(found, cameras)
    assert long.count() == volume.size
    for fit in (blocks.fit(found, cameras), orderstats.fit(long)):
        assert {(r.n, r.vmin) for r in fit.collect()} == {(48, 0)}
    for counts in (blocks.histogram(found), thresholds.histogram(long, "setup")):
        assert counts.filter("v = 0").first()["n"] == (volume == 0).sum()
    small = stores.to_voxels(blocks.downsample(found, 2, 2, 2, 1), cameras)
    assert small.exceptAll(levels.downsample(long, 2, 2, 2).select(small.columns)).isEmpty() and small.count() == volume.size // 8


def test_an_array_without_files_and_a_fill_value(spark, tmp_path):
    stores.create(str(tmp_path), "zarr3", 0, (5, 4, 4), (4, 4, 4), (8, 4, 4))
    assert [(r.z0, r.dz) for r in stores.chunks(spark, str(tmp_path), "zarr3", [0]).orderBy("z0").collect()] == [(0, 4), (4, 1)]
    path = tmp_path / "s0-t0.zarr/0/zarr.json"
    path.write_text(json.dumps(json.loads(path.read_text()) | {"fill_value": 7}))
    assert {r.v for r in stores.to_voxels(stores.chunks(spark, str(tmp_path), "zarr3", [0])).collect()} == {7}


@pytest.mark.parametrize("fmt", ["n5", "zarr2", "zarr3"])
def test_filters_reach_the_files(spark, tmp_path, fmt, monkeypatch):
    volume, rows = sparse(spark)
    root = str(tmp_path)
    stores.write(rows.unionByName(sparse(spark, 3)[1]), root, fmt, {0: SIZE, 3: SIZE}, CHUNKS, SHARD)
    for found in (source.load(spark, root, fmt, rows="voxels", pushdown="true").filter("setup = 0 and z >= 40 and y < 3 and x >= 1"), source.load(spark, root, fmt, rows="voxels", setups="0", z="40:", y=":3", x="1:8")):
        assert found.count() == 8 * 3 * 7
        assert found.agg(F.sum("v")).first()[0] == volume[40:, :3, 1:].sum()
    opened = []
    monkeypatch.setattr(files, "read", lambda path, own=files.read: opened.append(path) or own(path))
    reader = source.PushingReader({"path": root, "layout": fmt, "rows": "voxels"})
    left = list(reader.pushFilters([EqualTo(("setup",), 0), In(("level",), (0, 1)), GreaterThanOrEqual(("z",), 40), LessThan(("y",), 3)]))
    assert [type(f) for f in left] == [GreaterThanOrEqual, LessThan]  # those on setup and level are done with
    parts = list(reader.partitions())
    assert {p.setup for p in parts} == {0}
    opened.clear()
    read = sum(b.num_rows for p in parts for b in reader.read(p))
    stored = (32, 8, 8) if fmt == "zarr3" else CHUNKS
    met = [(z, y, x) for z in range(0, 48, stored[0]) for y in range(0, 8, stored[1]) for x in range(0, 8, stored[2]) if z + stored[0] > 40 and y < 3]
    assert len(opened) == len(met) == sum(p.end - p.first for p in parts)
    assert read == 16 * 4 * 8  # chunks within a shard are chosen too


def test_files_that_are_not_asked_for_are_not_opened(spark, tmp_path):
    _, rows = sparse(spark)
    stores.write(rows, str(tmp_path), "zarr2", {0: SIZE}, CHUNKS, SHARD)
    for path in (tmp_path / "s0-t0.zarr/0/0/0/0").rglob("*"):
        if path.is_file():
            path.write_bytes(b"damaged")
    assert stores.chunks(spark, str(tmp_path), "zarr2", [0], box=((32, 48), (0, 8), (0, 8))).count() == 4
    assert source.load(spark, str(tmp_path), "zarr2", pushdown="true").filter("z0 >= 32").count() == 4
    assert source.load(spark, str(tmp_path), "zarr2", pushdown="true").filter("setup = 5").count() == 0
    with pytest.raises(Exception):
        stores.chunks(spark, str(tmp_path), "zarr2", [0]).collect()


def test_one_table_under_several_filters(spark, tmp_path):
    _, rows = sparse(spark)
    stores.write(rows, str(tmp_path), "n5", {0: SIZE}, CHUNKS, SHARD)
    table = stores.chunks(spark, str(tmp_path), "n5", [0])
    assert table.filter("z0 >= 32").unionByName(table.filter("z0 < 16")).count() == 8 and table.count() == 12


def test_a_job_that_fails_leaves_the_store(spark, tmp_path):
    _, rows = sparse(spark)
    stores.write(rows, str(tmp_path), "zarr3", {0: SIZE}, CHUNKS, SHARD)
    kept = {p: p.read_bytes() for p in tmp_path.rglob("*") if p.is_file()}
    seen = tmp_path.parent / f"{tmp_path.name}-seen"

    def fails(batches):
        for batch in batches:
            for k in range(batch.num_rows):
                if batch.column("z0")[k].as_py() == 32:
                    seen.write_text("half of the files were written")
                    raise RuntimeError("a task is lost half way")
                yield batch.slice(k, 1)

    broken = rows.orderBy("z0", "y0", "x0").coalesce(1).withColumn("dz", F.col("dz")).mapInArrow(fails, CHUNK)
    with pytest.raises(Exception, match="half way"):
        source.save(broken, str(tmp_path), "zarr3", {0: SIZE}, CHUNKS, SHARD)
    assert seen.exists()
    assert kept == {p: p.read_bytes() for p in tmp_path.rglob("*") if p.is_file()}
    with pytest.raises(Exception, match="already"):
        rows.write.format(source.NAME).mode("append").options(layout="zarr3", shapes=json.dumps({"0": SIZE}), chunk="16,4,4", shard="32,8,8").save(str(tmp_path))
    assert kept == {p: p.read_bytes() for p in tmp_path.rglob("*") if p.is_file()}


def test_rows_that_are_not_sorted_by_file_are_refused(spark, tmp_path):
    _, rows = sparse(spark)
    mixed = rows.orderBy("x0", "y0", "z0").coalesce(1)
    again = mixed.unionByName(mixed).coalesce(1)
    with pytest.raises(Exception, match="sorted"):
        source.save(again, str(tmp_path), "n5", {0: SIZE}, CHUNKS, SHARD)
    assert not [p for p in tmp_path.rglob("*") if p.is_file()]


def test_setups_and_levels_that_are_there(spark, tmp_path):
    for setup in (2, 11):
        for level, shape in enumerate([(8, 8, 8), (4, 4, 4)]):
            stores.create(str(tmp_path), "n5", setup, shape, (4, 4, 4), level=level)
    found = source.load(spark, str(tmp_path), "n5", levels="all")
    assert {tuple(r) for r in found.groupBy("setup", "level").count().collect()} == {(2, 0, 8), (2, 1, 1), (11, 0, 8), (11, 1, 1)}
    assert found.filter("level = 1 and setup > 5").count() == 1

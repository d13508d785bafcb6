import json

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from evenfield.model import CHUNK
from evenfield.sources import codecs, files, stores, tiff

Z, Y, X = 20, 17, 23


def volume(setup=0, shape=(Z, Y, X)):
    z, y, x = np.indices(shape)
    return ((1009 * x + 101 * y + 7 * z + 37 * setup) % 4096).astype(np.uint16)


def voxels(spark, setups=(0, 1), shape=(Z, Y, X)):
    rows = []
    for s in setups:
        v = volume(s, shape)
        rows += [(0, s, int(z), int(y), int(x), int(v[z, y, x])) for z, y, x in np.ndindex(v.shape)]
    return spark.createDataFrame(rows, "camera int, setup int, z int, y int, x int, v int")


@pytest.mark.parametrize("fmt", stores.FORMATS)
def test_what_is_written_reads_back(spark, tmp_path, fmt):
    source = voxels(spark).cache()
    chunk, shard = (4, 8, 8), (8, 16, 16)
    stores.write(stores.to_chunks(source, chunk), str(tmp_path), fmt, {0: (Z, Y, X), 1: (Z, Y, X)}, chunk, shard)
    stores.write_group(str(tmp_path), fmt, 0, [(1, 1, 1)])
    assert stores.size_zyx(str(tmp_path), fmt, 1) == (Z, Y, X)
    found = stores.to_voxels(stores.chunks(spark, str(tmp_path), fmt, [0, 1])).filter("z < 20 and y < 17 and x < 23")
    assert found.count() == 2 * Z * Y * X
    assert found.exceptAll(source).count() == 0


def test_a_missing_file_is_zeros(spark, tmp_path):
    found = stores.create(str(tmp_path), "zarr2", 0, (4, 4, 4), (4, 4, 4))
    (row,) = stores.chunks(spark, str(tmp_path), "zarr2", [0]).collect()
    assert (row.dz, row.dy, row.dx, bytes(row.data)) == (4, 4, 4, bytes(128))
    assert found.zyx(found.shape) == (4, 4, 4)


def test_pyramid_shapes_end_at_the_first_missing_level(tmp_path):
    for level, shape in enumerate([(8, 8, 8), (4, 4, 4)]):
        stores.create(str(tmp_path), "n5", 3, shape, (4, 4, 4), level=level)
    assert stores.pyramid_shapes(str(tmp_path), "n5", 3) == [(8, 8, 8), (4, 4, 4)]


def test_group_metadata_places_pixels_by_half(tmp_path):
    stores.write_group(str(tmp_path), "zarr3_zyx", 0, [(1, 1, 1), (2, 2, 4)])
    scales = json.loads((tmp_path / "s0-t0.zarr/zarr.json").read_text())["attributes"]["ome"]["multiscales"][0]
    assert [a["name"] for a in scales["axes"]] == ["z", "y", "x"]
    assert scales["datasets"][1]["coordinateTransformations"] == [{"type": "scale", "scale": [2.0, 2.0, 4.0]}, {"type": "translation", "translation": [0.5, 0.5, 1.5]}]


def test_zarr3_is_found_by_its_own_metadata(tmp_path):
    stores.create(str(tmp_path), "zarr3_zyx", 0, (4, 4, 4), (4, 4, 4))
    stores.write_group(str(tmp_path), "zarr3_zyx", 0, [(1, 1, 1)])
    assert stores.located(str(tmp_path), "zarr3", 0, 0)[1] == "zyx"


@pytest.mark.parametrize(
    ("array", "axes", "expected"),
    [
        ({"shape": [4, 5, 6], "dimension_names": ["Z", "Y", "X"]}, [], "zyx"),
        ({"shape": [6, 5, 4]}, ["X", "y", "z"], "xyz"),
        ({"shape": [1, 1, 4, 5, 6], "dimension_names": ["T", "C", "Z", "Y", "X"]}, [], "tczyx"),
        ({"shape": [1, 4, 1, 5, 6], "dimension_names": ["t", "z", "c", "y", "x"]}, [], "tzcyx"),
        ({"shape": [1, 1, 4, 5, 6]}, [], "tczyx"),
        ({"shape": [1, 1, 4, 5, 6], "dimension_names": [None] * 5}, [], "tczyx"),
    ],
)
def test_axes_by_name_in_either_case(array, axes, expected):
    assert stores.axis_order(array, {"axes": [{"name": a} for a in axes]}, "here") == expected


def test_axes_that_are_not_known():
    with pytest.raises(ValueError):
        stores.axis_order({"shape": [4, 5], "dimension_names": ["y", "x"]}, {}, "here")


def test_crc32c_known_value():
    assert codecs.crc32c(b"123456789") == 0xE3069283


def test_a_damaged_shard_index_is_refused():
    data = bytearray(codecs.pack_shard([b"abc", None]))
    assert codecs.unpack_shard(bytes(data), 2) == [b"abc", None]
    data[-6] ^= 1
    with pytest.raises(ValueError):
        codecs.unpack_shard(bytes(data), 2)


@pytest.mark.parametrize("compression", [None, "deflate", "zstd", "lzw"])
def test_tiff_round_trip(tmp_path, compression):
    planes = list(volume())
    assert tiff.write_tile(tmp_path / "t.tif", planes, (Z, Y, X), (0.4, 0.2, 0.1), compression) == Z
    found, text = tiff.read(tmp_path / "t.tif")
    assert len(found) == Z and all((a == b).all() for a, b in zip(found, planes))
    assert 'PhysicalSizeZ="0.4"' in text and 'SizeX="23"' in text


def foreign_tiff(path, planes, end=">", tile=None, rows=None, predictor=1, compression=1, big=False):
    """A TIFF as other programs write it: tiles or strips of some rows, a predictor, either byte order."""
    import struct
    import zlib

    out, kind = bytearray(), planes[0].dtype
    word, room = ("Q", 8) if big else ("I", 4)
    out += {"<": b"II", ">": b"MM"}[end] + (struct.pack(end + "HHHQ", 43, 8, 0, 0) if big else struct.pack(end + "HI", 42, 0))
    link = len(out) - room
    for plane in planes:
        ny, nx = plane.shape
        bh, bw = tile or (rows or ny, nx)
        offsets, sizes = [], []
        for y in range(0, ny, bh):
            for x in range(0, nx, bw):
                part = plane[y : y + bh, x : x + bw]
                if tile:
                    part = np.pad(part, ((0, bh - part.shape[0]), (0, bw - part.shape[1])))
                if predictor == 2:
                    part = np.diff(part, axis=1, prepend=np.zeros((len(part), 1), kind))
                raw = part.astype(kind.newbyteorder(end)).tobytes()
                if predictor == 3:
                    spread = np.frombuffer(part.astype(kind.newbyteorder(">")).tobytes(), np.uint8).reshape(len(part), -1, kind.itemsize).transpose(0, 2, 1).reshape(len(part), -1)
                    raw = np.diff(spread, axis=1, prepend=np.zeros((len(part), 1), np.uint8)).tobytes()
                raw = {1: bytes, 5: codecs.lzw_encode, 8: zlib.compress}[compression](raw)
                offsets.append(len(out))
                sizes.append(len(raw))
                out += raw
        lists = {}
        for tag, values in ((324 if tile else 273, offsets), (325 if tile else 279, sizes)):
            lists[tag] = (4, values)
        tags = {256: (4, [nx]), 257: (4, [ny]), 258: (3, [8 * kind.itemsize]), 259: (3, [compression]), 262: (3, [1]), 317: (3, [predictor]), 339: (3, [{"u": 1, "f": 3}[kind.kind]])} | lists
        tags |= {322: (4, [bw]), 323: (4, [bh])} if tile else {278: (4, [bh])}
        entries = b""
        for tag in sorted(tags):
            code, values = tags[tag]
            packed = struct.pack(f"{end}{len(values)}{'I' if code == 4 else 'H'}", *values)
            if len(packed) > room:
                at, packed = len(out), (out := out + packed) and struct.pack(end + word, len(out) - len(packed))
            entries += struct.pack(end + ("HHQ" if big else "HHI"), tag, code, len(values)) + packed.ljust(room, b"\0")
        struct.pack_into(end + word, out, link, len(out))
        out += struct.pack(end + ("Q" if big else "H"), len(tags)) + entries
        link = len(out)
        out += bytes(room)
    path.write_bytes(out)


@pytest.mark.parametrize("end", ["<", ">"])
@pytest.mark.parametrize("options", [{"rows": 4}, {"tile": (16, 16)}, {"tile": (16, 16), "predictor": 2, "compression": 5}, {"rows": 3, "predictor": 2, "compression": 8, "big": True}, {"tile": (16, 32), "predictor": 3, "compression": 8}])
def test_tiffs_of_others(tmp_path, end, options):
    planes = [(v / 7).astype(np.float32) if options.get("predictor") == 3 else v for v in volume()[:3]]
    foreign_tiff(tmp_path / "f.tif", planes, end, **options)
    found, _ = tiff.read(tmp_path / "f.tif")
    assert len(found) == 3 and all((a == b).all() for a, b in zip(found, planes))


def test_one_file_is_read_by_many_tasks(spark, tmp_path, monkeypatch):
    """Strips go to tasks by their bytes; a task sees its own ranges, and the driver and the index no plane."""
    monkeypatch.setattr(tiff, "TASK_BYTES", 4000)
    foreign_tiff(tmp_path / "s3-t0.ome.tif", list(volume()), rows=5)
    rows = tiff.tile_planes(spark, str(tmp_path), [3])
    assert rows.rdd.getNumPartitions() == 4 and rows.count() == 20 * 4
    found = stores.to_voxels(rows).select("z", "y", "x", "v").toPandas()
    assert (volume()[found["z"], found["y"], found["x"]] == found["v"]).all() and len(found) == Z * Y * X
    index = tiff.segments(spark, {3: str(tmp_path / "s3-t0.ome.tif")})
    assert index.agg(F.sum("n_bytes")).first()[0] == 2 * Z * Y * X


def test_small_segments_are_dealt_and_sent_many_at_a_time(spark, tmp_path, monkeypatch):
    """Planes of a few bytes go to tasks by their number too, and a task sends on a batch of many."""
    monkeypatch.setattr(tiff, "TASK_SEGMENTS", 30)
    planes = np.arange(200 * 6, dtype=np.uint16).reshape(200, 2, 3)
    tiff.write_tile(tmp_path / "s3-t0.ome.tif", list(planes), planes.shape)
    rows = tiff.tile_planes(spark, str(tmp_path), [3])
    assert rows.rdd.getNumPartitions() == 7
    sent = rows.mapInArrow(lambda batches: (pa.RecordBatch.from_arrays([pa.array([len(b)])], ["n"]) for b in batches), "n long").toPandas()["n"]
    assert sent.sum() == 200 and len(sent) <= 7
    found = stores.to_voxels(rows).toPandas()
    assert (planes[found["z"], found["y"], found["x"]] == found["v"]).all() and len(found) == planes.size


def test_tiles_of_packed_planes_are_as_written_by_one(spark, tmp_path):
    """Planes come packed and in any order; files are those that ``write_tile`` makes, whatever the setups' numbers are."""
    cube, sizes = volume(), {s: (Z, Y, X) for s in (0, 3, 17, 40)}
    rows = [(s, 0, z, 0, 0, 1, Y, X, bytearray(cube[z].astype("<u2").tobytes())) for s in sizes for z in reversed(range(Z))]
    tiff.write_tiles(spark.createDataFrame(rows, CHUNK), str(tmp_path / "out"), sizes, {3: (0.4, 0.2, 0.1)}, "deflate")
    for s in sizes:
        tiff.write_tile(tmp_path / "one.tif", list(cube), (Z, Y, X), {3: (0.4, 0.2, 0.1)}.get(s), "deflate")
        assert (tmp_path / f"out/s{s}-t0.ome.tif").read_bytes() == (tmp_path / "one.tif").read_bytes()


def test_a_file_is_written_without_looking_back(tmp_path, monkeypatch):
    """Its bytes go out in order, so that a page costs no seek; a short description lies in its tag."""

    class Forward(list):
        def write(self, data):
            self.append(bytes(data))

    from contextlib import contextmanager

    out = Forward()

    @contextmanager
    def whole(path):
        yield out

    planes = list(volume())
    with monkeypatch.context() as m:
        m.setattr(files, "whole", whole)
        assert tiff.write("nowhere", planes, "zstd", "short") == Z
    (tmp_path / "f.tif").write_bytes(b"".join(out))
    found, text = tiff.read(tmp_path / "f.tif")
    assert text == "short" and all((a == b).all() for a, b in zip(found, planes))


def test_a_plane_in_tiles_is_turned_to_the_frame(spark, tmp_path):
    plane = np.arange(20 * 37, dtype=np.float32).reshape(20, 37)
    foreign_tiff(tmp_path / "p.tif", [plane.T], tile=(16, 16))
    rows = tiff.camera_planes(spark, {0: str(tmp_path / "p.tif")}, "v", (20, 37)).toPandas()
    assert (plane[rows["y"], rows["x"]] == rows["v"]).all() and len(rows) == plane.size
    with pytest.raises(Exception, match="not"):
        tiff.camera_planes(spark, {0: str(tmp_path / "p.tif")}, "v", (20, 36)).collect()


def test_planes_are_turned_to_the_frame(tmp_path):
    plane = np.arange(12, dtype=np.float32).reshape(3, 4)
    tiff.write_plane(tmp_path / "p.tif", plane.T)
    assert (tiff.read_plane(tmp_path / "p.tif", (3, 4)) == plane).all()
    with pytest.raises(ValueError):
        tiff.read_plane(tmp_path / "p.tif", (5, 5))


@pytest.mark.parametrize("fmt", ["n5", "zarr2", "zarr3"])
def test_a_store_by_uri(spark, tmp_path, fmt):
    source = voxels(spark, (0,)).cache()
    root, chunk, shard = f"file://{tmp_path}/store", (4, 8, 8), (8, 16, 16)
    stores.write(stores.to_chunks(source, chunk), root, fmt, {0: (Z, Y, X)}, chunk, shard)
    assert stores.pyramid_shapes(root, fmt, 0) == [(Z, Y, X)]
    assert stores.to_voxels(stores.chunks(spark, root, fmt, [0])).exceptAll(source).count() == 0


def test_a_file_is_whole_or_absent(tmp_path):
    with pytest.raises(RuntimeError):
        with files.whole(f"{tmp_path}/deep/f") as out:
            out.write(b"half")
            raise RuntimeError
    assert not files.exists(f"{tmp_path}/deep/f") and not list((tmp_path / "deep").iterdir())
    files.write(f"file://{tmp_path}/deep/f", b"whole")
    assert files.read(f"{tmp_path}/deep/f") == b"whole"


@pytest.mark.parametrize("fmt", ["n5", "zarr2", "zarr3"])
def test_an_open_group_stays_as_it_is(tmp_path, fmt):
    stores.open_group(str(tmp_path), fmt, 2)
    stores.write_group(str(tmp_path), fmt, 2, [(1, 1, 1)])
    kept = {p: p.read_bytes() for p in tmp_path.rglob("*") if p.is_file()}
    stores.open_group(str(tmp_path), fmt, 2)
    assert kept == {p: p.read_bytes() for p in tmp_path.rglob("*") if p.is_file()}

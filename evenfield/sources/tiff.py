"""Planes and tiles as TIFF: float32 planes (fields, maps), and tiles as BigTIFF with OME metadata, plane by plane.

A file is read by its index: ``segments`` reads directories alone, by byte ranges, and gives a row for each strip or tile of a page; these rows are
dealt to tasks, which fetch and decode their own ranges. So a file may be larger than any task's memory, and one file is many tasks' work.
Classic and BigTIFF of either byte order, one sample a pixel, strips or tiles, no compression, deflate, zstd or lzw, predictors 1 to 3.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from html import escape
from itertools import groupby, islice
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.numeric import gathered, rows_of
from ..model import CHUNK
from ..operators.blocks import mapped
from ..session import shared_folder
from . import files
from .codecs import compress, decompress, lzw_decode, lzw_encode

# TIFF's numbers for compressions and sample formats.
COMPRESSION = {None: 1, "lzw": 5, "deflate": 8, "zstd": 50000}
DEFLATE_TOO = 32946
SAMPLE = {"u": 1, "i": 2, "f": 3}
# What a camera's fields are called in an exported folder.
FIELDS = {"flat": "Flat-field", "dark": "Dark-field"}


def ome_xml(shape: tuple[int, int, int], voxel_um: tuple[float, float, float] | None) -> str:
    nz, ny, nx = shape
    sizes = "" if voxel_um is None else "".join(f' PhysicalSize{c}="{v:g}" PhysicalSize{c}Unit="{escape("µm")}"' for c, v in zip("ZYX", voxel_um))
    return (f'<?xml version="1.0" encoding="UTF-8"?><OME xmlns="http://www.openmicroscopy.org/Schemas/OME/2016-06"><Image ID="Image:0"><Pixels ID="Pixels:0" DimensionOrder="XYZCT" Type="uint16" '
            f'SizeX="{nx}" SizeY="{ny}" SizeZ="{nz}" SizeC="1" SizeT="1"{sizes}><TiffData/></Pixels></Image></OME>')  # fmt: skip


def packed(plane: np.ndarray, compression: str | None) -> bytes:
    """A plane's bytes as its page holds them."""
    if compression not in COMPRESSION:
        raise ValueError(f"compression {compression!r} is none of {tuple(COMPRESSION)}")
    raw = np.ascontiguousarray(plane).astype(plane.dtype.newbyteorder("<")).tobytes()
    return zlib.compress(raw) if compression == "deflate" else lzw_encode(raw) if compression == "lzw" else compress(raw, compression)


def write(path: str | Path, planes: Iterable[np.ndarray], compression: str | None = None, description: str | None = None) -> int:
    """Writes planes as they come, one page each, in BigTIFF; returns how many."""
    if compression not in COMPRESSION:
        raise ValueError(f"compression {compression!r} is none of {tuple(COMPRESSION)}")
    return write_packed(path, ((p.shape, p.dtype, packed(p, compression)) for p in planes), compression, description)


def write_packed(path: str | Path, pages: Iterable[tuple[tuple[int, int], np.dtype, bytes]], compression: str | None = None, description: str | None = None) -> int:
    """``write`` of pages (shape, dtype, data) that are packed already. A directory names the place of the next one, so it is
    written when the next page's data have come: the file is written from its begin to its end, without a look back."""
    count, at, directory = 0, 16, struct.pack("<2sHHH", b"II", 43, 8, 0)  # the header ends with a link, as directories do
    with files.whole(path) as out:
        for shape, kind, data in pages:
            tags = [(256, 4, 1, shape[1]), (257, 4, 1, shape[0]), (258, 3, 1, 8 * kind.itemsize), (259, 3, 1, COMPRESSION[compression]), (262, 3, 1, 1), (273, 16, 1, at), (277, 3, 1, 1), (278, 4, 1, shape[0]), (279, 16, 1, len(data)), (339, 3, 1, SAMPLE[kind.kind])]
            text = description.encode() + b"\0" if description and not count else b""
            if text:
                tags.insert(5, (270, 2, len(text), at + len(data) if len(text) > 8 else int.from_bytes(text, "little")))
            here = at + len(data) + len(text)
            out.write(directory + struct.pack("<Q", here))
            out.write(data)
            out.write(text)
            directory = struct.pack("<Q" + "HHQQ" * len(tags), len(tags), *(v for tag in tags for v in tag))
            at, count = here + len(directory) + 8, count + 1
        out.write(directory + struct.pack("<Q", 0))
    return count


_SIZE = {1: 1, 2: 1, 3: 2, 4: 4, 5: 8, 6: 1, 8: 2, 9: 4, 11: 4, 12: 8, 13: 4, 16: 8, 17: 8, 18: 8}
_CODE = {1: "B", 3: "H", 4: "I", 6: "b", 8: "h", 9: "i", 11: "f", 12: "d", 13: "I", 16: "Q", 17: "q", 18: "Q"}


@dataclass(frozen=True)
class Page:
    """One directory: a plane's size and kind, and where its strips or tiles are."""

    height: int
    width: int
    kind: str  # numpy's name, byte order included
    compression: int
    predictor: int
    block: tuple[int, int]  # of a strip or tile as it is stored
    tiled: bool
    offsets: tuple[int, ...]
    sizes: tuple[int, ...]

    def place(self, k: int) -> tuple[int, int, int, int]:
        """(y0, x0, height, width) of strip or tile k within the plane."""
        across = -(-self.width // self.block[1])
        y, x = k // across * self.block[0], k % across * self.block[1]
        return y, x, min(self.block[0], self.height - y), min(self.block[1], self.width - x)


def directories(path: str | Path) -> tuple[list[Page], str | None]:
    """(pages, description): only directories are read, not the planes."""
    pages, description = [], None
    with files.opened(path) as f:

        def piece(at: int, n: int) -> bytes:
            f.seek(at)
            return f.read(n)

        head = piece(0, 16)
        if head[:2] not in (b"II", b"MM"):
            raise ValueError(f"{path} is no TIFF")
        end = {b"II": "<", b"MM": ">"}[head[:2]]
        big = struct.unpack(end + "H", head[2:4])[0] == 43
        word, step, room = ("Q", 20, 8) if big else ("I", 12, 4)
        at = struct.unpack(end + word, head[8:16] if big else head[4:8])[0]
        while at:
            first = 8 if big else 2
            n = struct.unpack(end + ("Q" if big else "H"), piece(at, first))[0]
            body = piece(at + first, n * step + room)
            tags = {}
            for k in range(n):
                tag, kind, count = struct.unpack_from(end + ("HHQ" if big else "HHI"), body, k * step)
                held = body[k * step + step - room : (k + 1) * step]
                if _SIZE.get(kind, 1) * count > room:
                    held = piece(struct.unpack(end + word, held)[0], _SIZE.get(kind, 1) * count)
                tags[tag] = held[:count].rstrip(b"\0").decode(errors="replace") if kind == 2 else struct.unpack_from(f"{end}{count}{_CODE.get(kind, 'B')}", held)
            at = struct.unpack_from(end + word, body, n * step)[0]
            one = lambda tag, default, tags=tags: tags.get(tag, (default,))[0]
            if one(277, 1) != 1:
                raise ValueError(f"{path}: {one(277, 1)} samples a pixel aren't supported")
            if one(259, 1) not in (*COMPRESSION.values(), DEFLATE_TOO):
                raise ValueError(f"{path}: compression {one(259, 1)} isn't known")
            tiled, height, width = 322 in tags, one(257, 0), one(256, 0)
            block = (one(323, 0), one(322, 0)) if tiled else (min(one(278, height), height), width)
            kind = f"{end}{ {1: 'u', 2: 'i', 3: 'f'}[one(339, 1)]}{one(258, 8) // 8}"
            pages.append(Page(height, width, kind, one(259, 1), one(317, 1), block, tiled, tags[324 if tiled else 273], tags[325 if tiled else 279]))
            description = description or tags.get(270)
    return pages, description


def decoded(data: bytes, kind: str, compression: int, predictor: int, block: tuple[int, int], size: tuple[int, int], tiled: bool) -> np.ndarray:
    """The plane's part that one strip or tile holds."""
    if compression != 1:
        data = lzw_decode(data) if compression == 5 else decompress(data, "zstd") if compression == 50000 else zlib.decompress(data)
    rows, across = (block if tiled else (size[0], block[1]))  # the last strip is shorter, tiles are whole
    found = np.dtype(kind)
    if predictor == 3:  # differences of bytes, most significant ones first
        steps = np.frombuffer(data, np.uint8)[: rows * across * found.itemsize].reshape(rows, -1)
        spread = np.cumsum(steps, axis=1, dtype=np.uint8).reshape(rows, found.itemsize, across)
        values = np.ascontiguousarray(spread.transpose(0, 2, 1)).view(found.newbyteorder(">")).reshape(rows, across)
    else:
        values = np.frombuffer(data, found)[: rows * across].reshape(rows, across)
        if predictor == 2:
            values = np.cumsum(values, axis=1, dtype=found.newbyteorder("="))
    return values[: size[0], : size[1]]


def read(path: str | Path) -> tuple[list[np.ndarray], str | None]:
    """(planes, description) of a file that fits into memory."""
    pages, description = directories(path)
    planes = []
    with files.opened(path) as f:
        for p in pages:
            plane = np.zeros((p.height, p.width), p.kind)
            for k, (at, n) in enumerate(zip(p.offsets, p.sizes)):
                y, x, h, w = p.place(k)
                f.seek(at)
                plane[y : y + h, x : x + w] = decoded(f.read(n), p.kind, p.compression, p.predictor, p.block, (h, w), p.tiled)
            planes.append(plane)
    return planes, description


SEGMENT = "id int, path string, page int, offset long, n_bytes long, y0 int, x0 int, h int, w int, ny int, nx int, kind string, compression int, predictor int, bh int, bw int, tiled boolean"
#: Bytes of strips or tiles that a task reads, about.
TASK_BYTES = 1 << 25
#: Of small strips or tiles, so many at most: each costs time of its own. And so many of them are sent on at once.
TASK_SEGMENTS, BATCH_SEGMENTS = 1 << 14, 1 << 12


def segments(spark: SparkSession, paths: dict[int, str]) -> DataFrame:
    """The index of some files, by an id of each: a row for each strip or tile, from directories alone; a task per file."""

    def index(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = [c.split()[0] for c in SEGMENT.split(", ")]
        for batch in batches:
            for own, path in zip(batch.column("id").to_pylist(), batch.column("path").to_pylist()):
                rows = ((own, path, number, at, n, *p.place(k), p.height, p.width, p.kind, p.compression, p.predictor, *p.block, p.tiled) for number, p in enumerate(directories(path)[0]) for k, (at, n) in enumerate(zip(p.offsets, p.sizes)))
                while part := list(islice(rows, BATCH_SEGMENTS)):
                    yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*part), schema)], names)

    kinds = {"int": pa.int32(), "long": pa.int64(), "string": pa.string(), "boolean": pa.bool_()}
    schema = pa.schema([(c.split()[0], kinds[c.split()[1]]) for c in SEGMENT.split(", ")])
    return spark.createDataFrame(list(paths.items()), "id int, path string").repartition(max(1, len(paths)), "id").mapInArrow(index, SEGMENT)


def _spread(spark: SparkSession, paths: dict[int, str], make, schema: str) -> DataFrame:
    """``make`` of lists of (segment, its part of the plane), in tasks of about TASK_BYTES or TASK_SEGMENTS whatever file they lie in."""
    rows = segments(spark, paths)
    folder = shared_folder(spark, "segments")
    rows.write.parquet(folder)
    rows = spark.read.parquet(folder)
    total, n = rows.agg(F.coalesce(F.sum("n_bytes"), F.lit(0)), F.count(F.lit(1))).first()
    rows = rows.repartition(max(1, -(-total // TASK_BYTES), -(-n // TASK_SEGMENTS)), "path", "page", "offset").sortWithinPartitions("path", "offset")

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def parts():
            at, f = None, None
            for batch in batches:
                for r in rows_of(batch):
                    if r["path"] != at:
                        at, f = r["path"], files.opened(r["path"])
                    f.seek(r["offset"])
                    yield r, decoded(f.read(r["n_bytes"]), r["kind"], r["compression"], r["predictor"], (r["bh"], r["bw"]), (r["h"], r["w"]), r["tiled"])

        return gathered(parts(), lambda part: part[1].nbytes, make)

    return rows.mapInArrow(work, schema)


def write_plane(path: str | Path, plane: np.ndarray) -> None:
    write(path, [np.asarray(plane, np.float32)])


def read_plane(path: str | Path, frame: tuple[int, int] | None = None) -> np.ndarray:
    """One float32 plane; given the frame, a plane stored the other way round is turned, and any other size refused."""
    planes, _ = read(path)
    if len(planes) != 1:
        raise ValueError(f"{path} has {len(planes)} planes, not one")
    return oriented(planes[0], frame, path)


def oriented(plane: np.ndarray, frame: tuple[int, int] | None, path: str | Path) -> np.ndarray:
    plane = plane.astype(np.float32)
    if frame and plane.shape != frame:
        if plane.T.shape != frame:
            raise ValueError(f"{path} is {plane.shape}, not {frame}")
        plane = np.ascontiguousarray(plane.T)
    return plane


def write_tile(path: str | Path, planes: Iterable[np.ndarray], shape: tuple[int, int, int], voxel_um=None, compression: str | None = "zstd") -> int:
    """A tile's z planes as OME-TIFF."""
    return write(path, (np.asarray(p, np.uint16) for p in planes), compression, ome_xml(shape, voxel_um))


def tile_path(root: str, setup: int) -> str:
    return f"{root}/s{setup}-t0.ome.tif"


def write_tiles(planes: DataFrame, root: str, sizes: dict[int, tuple[int, int, int]], voxel_um: dict[int, tuple] | None = None, compression: str | None = "zstd") -> None:
    """Writes chunk rows of a whole plane each as a file per setup. Planes are packed where they are made; a file is written by one
    task of its own, which holds a page at a time."""
    if compression not in COMPRESSION:
        raise ValueError(f"compression {compression!r} is none of {tuple(COMPRESSION)}")
    um = voxel_um or {}
    two = np.dtype("<u2")

    def pack(r: dict) -> dict:
        return r | {"data": packed(np.frombuffer(r["data"], two).reshape(r["dy"], r["dx"]), compression)}

    def sink(rows) -> None:
        for setup, own in groupby(rows, key=lambda r: r["setup"]):
            write_packed(tile_path(root, setup), (((r["dy"], r["dx"]), two, r["data"]) for r in own), compression, ome_xml(sizes[setup], um.get(setup)))

    ready = planes.mapInArrow(lambda batches: mapped(batches, pack), CHUNK).select("setup", "z0", "dy", "dx", "data")
    number = F.array_position(F.lit(sorted(sizes)), F.col("setup")).cast("int") - 1
    ready.repartitionById(max(1, len(sizes)), number).sortWithinPartitions("setup", "z0").foreachPartition(sink)


def tile_planes(spark: SparkSession, root: str, setups: list[int]) -> DataFrame:
    """Rows of ``model.CHUNK``, one for each strip or tile of a plane, of the tiles that ``write_tiles`` wrote."""

    def chunks(parts: list[tuple[dict, np.ndarray]]) -> pa.RecordBatch:
        values = zip(*((r["id"], 0, r["page"], r["y0"], r["x0"], 1, *part.shape) for r, part in parts))
        data = [np.ascontiguousarray(part).astype("<u2").tobytes() for _, part in parts]
        return pa.RecordBatch.from_arrays([*(pa.array(v, pa.int32()) for v in values), pa.array(data, pa.binary())], ["setup", "level", "z0", "y0", "x0", "dz", "dy", "dx", "data"])

    return _spread(spark, {s: tile_path(root, s) for s in setups}, chunks, CHUNK)


def camera_planes(spark: SparkSession, paths: dict[int, str], value: str, frame: tuple[int, int] | None = None) -> DataFrame:
    """(camera, plane, y, x, value) of a user's own TIFFs, one per camera: a field's one plane or a quantile stack's many.

    Given the frame, planes stored the other way round are turned, and any other size is refused.
    """

    def pixels(parts: list[tuple[dict, np.ndarray]]) -> pa.RecordBatch:
        columns = []
        for r, part in parts:
            y, x = np.indices(part.shape, np.int32).reshape(2, -1)
            y, x = y + np.int32(r["y0"]), x + np.int32(r["x0"])
            if frame and (r["ny"], r["nx"]) != frame:
                if (r["nx"], r["ny"]) != frame:
                    raise ValueError(f"{r['path']} is {(r['ny'], r['nx'])}, not {frame}")
                y, x = x, y
            columns.append((*(np.full(y.size, n, np.int32) for n in (r["id"], r["page"])), y, x, part.astype(np.float32).ravel()))
        return pa.RecordBatch.from_arrays([pa.array(np.concatenate(c)) for c in zip(*columns)], ["camera", "plane", "y", "x", value])

    return _spread(spark, paths, pixels, f"camera int, plane int, y int, x int, {value} float")


def fields(spark: SparkSession, folder: str, cameras: int, frame: tuple[int, int] | None = None) -> DataFrame:
    """(camera, y, x, flat, dark) of the fields in a folder as ``export`` lays it out."""
    found = {v: camera_planes(spark, {c: f"{folder}/camera{c + 1}/{name}.tif" for c in range(cameras)}, v, frame) for v, name in FIELDS.items()}
    return found["flat"].join(found["dark"], ["camera", "plane", "y", "x"]).filter("plane = 0").drop("plane")

"""Multiscale chunk stores of uint16 volumes, read and written in the public n5, zarr 2 and zarr 3 layouts.

``chunks(spark, root, format, setups, level)`` gives the rows of ``model.CHUNK``, a task per run of stored chunks or shards,
and ``write(chunk rows, …)`` writes a store: rows are dealt by shard, so a file has one writer, which a task that runs
again replaces whole. Both go through the Spark source and sink in ``source``. What isn't stored, whole files as well as
chunks within a shard, is the array's fill value.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from itertools import product

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.numeric import binaries, group_starts, on_frames, spans, whole_groups, within
from ..model import CHUNK
from . import codecs, files
from .files import write_json

# The formats' metadata files, axis orders and places.
PLACES = {
    "n5": ("attributes.json", "xyz", "setup{setup}/timepoint0/s{level}"),
    "zarr2": (".zarray", "tczyx", "s{setup}-t0.zarr/{level}"),
    "zarr3_unsharded": ("zarr.json", "tczyx", "s{setup}-t0.zarr/{level}"),
    "zarr3": ("zarr.json", "tczyx", "s{setup}-t0.zarr/{level}"),
    "zarr3_zyx": ("zarr.json", "zyx", "s{setup}-t0.zarr/{level}"),
    "zarr3_raw": ("zarr.json", "xyz", "s{setup}-t0.zarr/raw/s{level}"),
}
FORMATS = tuple(PLACES)


@dataclass(frozen=True)
class Layout:
    """One stored array: sizes are in its own axis order."""

    path: str
    format: str
    order: str
    shape: tuple[int, ...]
    chunk: tuple[int, ...]
    shard: tuple[int, ...] | None
    compression: str | None
    dtype: str
    keys: str  # how a chunk's file is named: default, flat or dotted
    fill: int = 0  # what is read where nothing is stored

    def zyx(self, values: tuple[int, ...]) -> tuple[int, int, int]:
        return tuple(values[self.order.index(c)] for c in "zyx")

    def own(self, z: int, y: int, x: int, other: int) -> tuple[int, ...]:
        return tuple({"z": z, "y": y, "x": x}.get(c, other) for c in self.order)

    def file(self, number: tuple[int, ...]) -> str:
        parts = [str(k) for k in number]
        if self.keys == "default":
            parts.insert(0, "c")
        return f"{self.path}/{('.' if self.keys == 'dotted' else '/').join(parts)}"

    def canonical(self, block: np.ndarray) -> np.ndarray:
        """A stored block as (z, y, x)."""
        axes = [self.order.index(c) for c in "zyx"]
        rest = [k for k in range(len(self.order)) if k not in axes]
        return block.transpose(*rest, *axes).reshape([block.shape[a] for a in axes])

    def stored(self, block: np.ndarray) -> np.ndarray:
        """A (z, y, x) block in the array's own order."""
        full = block.reshape((1,) * (len(self.order) - 3) + block.shape)
        named = [c for c in self.order if c not in "zyx"] + list("zyx")
        return full.transpose([named.index(c) for c in self.order])


def place(root: str, fmt: str, setup: int, level: int) -> str:
    """Where an array is by the format's rule."""
    return f"{root}/{PLACES[fmt][2].format(setup=setup, level=level)}"


def axis_order(array: dict, scales: dict, path: str) -> str:
    """A letter for each axis, from the array's own names, else from the group's axes; names count in either case.

    NGFF orders time, channel, then space; an array of five axes that has no names is taken for that.
    """
    rank = len(array["shape"])
    for names in (array.get("dimension_names"), [a["name"] for a in scales.get("axes", [])]):
        order = "".join((n or "?").lower()[:1] for n in names or [])
        if len(order) == rank and set("zyx") <= set(order) and len(set(order)) == rank and all(n == 1 for c, n in zip(order, array["shape"]) if c not in "zyx"):
            return order
    if rank == 5:
        return "tczyx"
    raise ValueError(f"{path}: axes {array.get('dimension_names') or scales.get('axes')} aren't supported")


def located(root: str, fmt: str, setup: int, level: int) -> tuple[str, str]:
    """(path, axis order): from a zarr 3 group's own multiscale metadata where it has some, else by the format's rule."""
    if fmt.startswith("zarr3"):
        group = f"{root}/s{setup}-t0.zarr"
        try:
            scales = files.read_json(f"{group}/zarr.json")["attributes"]["ome"]["multiscales"][0]
            path = f"{group}/{scales['datasets'][level]['path']}"
            meta = files.read_json(f"{path}/zarr.json")
        except (OSError, KeyError, IndexError, ValueError):
            return place(root, fmt, setup, level), PLACES[fmt][1]
        return path, axis_order(meta, scales, path)
    return place(root, fmt, setup, level), PLACES[fmt][1]


def layout(root: str, fmt: str, setup: int, level: int = 0) -> Layout:
    if fmt not in PLACES:
        raise ValueError(f"format {fmt!r} is none of {FORMATS}")
    path, order = located(root, fmt, setup, level)
    meta = files.read_json(f"{path}/{PLACES[fmt][0]}")
    if fmt == "n5":
        return Layout(path, fmt, order, tuple(meta["dimensions"]), tuple(meta["blockSize"]), None, meta.get("compression", {}).get("type", "raw"), meta["dataType"], "flat")
    if fmt == "zarr2":
        name = (meta.get("compressor") or {}).get("id")
        return Layout(path, fmt, order, tuple(meta["shape"]), tuple(meta["chunks"]), None, name, meta["dtype"], "flat" if meta.get("dimension_separator", ".") == "/" else "dotted", int(meta.get("fill_value") or 0))
    fill = int(meta.get("fill_value") or 0)
    outer = tuple(meta["chunk_grid"]["configuration"]["chunk_shape"])
    names = [c["name"] for c in meta["codecs"]]
    if names == ["sharding_indexed"]:
        inner = meta["codecs"][0]["configuration"]
        packing = [c["name"] for c in inner["codecs"] if c["name"] != "bytes"]
        return Layout(path, fmt, order, tuple(meta["shape"]), tuple(inner["chunk_shape"]), outer, packing[0] if packing else None, meta["data_type"], "default", fill)
    packing = [n for n in names if n != "bytes"]
    return Layout(path, fmt, order, tuple(meta["shape"]), outer, None, packing[0] if packing else None, meta["data_type"], "default", fill)


def size_zyx(root: str, fmt: str, setup: int, level: int = 0) -> tuple[int, int, int]:
    """From metadata alone."""
    found = layout(root, fmt, setup, level)
    return found.zyx(found.shape)


def setups(root: str, fmt: str) -> list[int]:
    """The numbers of the setups that a store has a folder of."""
    before, after = PLACES[fmt][2].split("/")[0].split("{setup}")
    inner = [n[len(before) : len(n) - len(after)] for n in files.names(root) if n.startswith(before) and n.endswith(after)]
    return sorted(int(n) for n in inner if n.isdigit())


def pyramid_shapes(root: str, fmt: str, setup: int) -> list[tuple[int, int, int]]:
    """(nz, ny, nx) of each level until one is missing."""
    out = []
    while True:
        try:
            out.append(size_zyx(root, fmt, setup, len(out)))
        except FileNotFoundError:
            return out


def group_scales(root: str, fmt: str, setup: int) -> list[tuple[tuple[float, ...], tuple[float, ...] | None]]:
    """((sz, sy, sx), (tz, ty, tx)) of each level by the group's own metadata; n5 has no translations."""
    if fmt == "n5":
        return [(tuple(float(v) for v in three[::-1]), None) for three in files.read_json(f"{root}/setup{setup}/timepoint0/attributes.json")["downsamplingFactors"]]
    group = f"{root}/s{setup}-t0.zarr"
    meta = files.read_json(f"{group}/.zattrs") if fmt == "zarr2" else files.read_json(f"{group}/zarr.json")["attributes"]["ome"]
    named = ({t["type"]: tuple(t[t["type"]][-3:]) for t in d["coordinateTransformations"]} for d in meta["multiscales"][0]["datasets"])
    return [(t["scale"], t.get("translation")) for t in named]


#: (low, end) of the places that are asked for along z, y and x.
Box = tuple[tuple[int, int], tuple[int, int], tuple[int, int]]


def read_block(found: Layout, number: tuple[int, ...], box: Box | None = None) -> Iterator[tuple[tuple[int, int, int], np.ndarray]]:
    """((z0, y0, x0), block) of every chunk that one stored file is the place of, as far as it lies in the array.

    Chunks that aren't stored are blocks of the fill value. Those outside of ``box`` are neither decoded nor given.
    """
    try:
        data = files.read(found.file(number))
    except FileNotFoundError:
        data = None
    dtype = found.dtype if found.dtype.startswith((">", "<")) else "<u2"
    if found.shard:
        grid = tuple(s // c for s, c in zip(found.shard, found.chunk))
        parts = codecs.unpack_shard(data, int(np.prod(grid))) if data is not None else [None] * int(np.prod(grid))
        held = [(tuple(n * s + k * c for n, s, k, c in zip(number, found.shard, at, found.chunk)), part) for at, part in zip(product(*map(range, grid)), parts)]
    else:
        held = [(tuple(n * c for n, c in zip(number, found.chunk)), data)]
    for start, part in held:
        size = tuple(min(c, s - a) for c, s, a in zip(found.chunk, found.shape, start))
        if min(size) <= 0:
            continue  # a shard's chunk beyond the array
        place_, extent = found.zyx(start), found.zyx(size)
        if box and any(p + n <= low or p >= end for p, n, (low, end) in zip(place_, extent, box)):
            continue
        whole = None
        if part is not None:
            whole = codecs.read_n5_block(part, found.compression) if found.format == "n5" else np.frombuffer(codecs.decompress(part, found.compression), dtype).reshape(found.chunk)
            whole = whole[tuple(map(slice, size))]
        if whole is None or whole.shape != size:  # not stored, or only its beginning
            block = np.full(size, found.fill, np.uint16)
            if whole is not None:
                block[tuple(map(slice, whole.shape))] = whole
            whole = block
        yield place_, found.canonical(whole)


def chunks(spark: SparkSession, root: str, fmt: str, setups: list[int], level: int = 0, files_per_task: int | None = None, box: Box | None = None) -> DataFrame:
    """Rows of ``model.CHUNK`` of all chunks of these setups; ``box`` leaves out the files that lie outside of it."""
    from . import source

    more = {"files_per_task": str(files_per_task)} if files_per_task else {}
    more |= {c: f"{low}:{end}" for c, (low, end) in zip("zyx", box or ())}
    return source.load(spark, root, fmt, setups=",".join(map(str, setups)), levels=str(level), **more)


def fingerprints(spark: SparkSession, root: str, fmt: str, setups: list[int], level: int = 0) -> DataFrame:
    """(setup, level, file, n_bytes, sha256) of every stored file of these setups; files that aren't there have no row."""
    from . import source

    return source.load(spark, root, fmt, setups=",".join(map(str, setups)), levels=str(level), rows="files")


#: Voxels that are worked on at once; a chunk of more is taken alone.
MOST_CELLS = 1 << 18


def to_voxels(rows: DataFrame, cameras: DataFrame | None = None, *more: str) -> DataFrame:
    """Rows of ``model.VOXEL`` (camera 0 without ``cameras``) with the whole numbers ``more`` of their chunks, some chunks at a time."""
    own = ["setup", *more]

    def spread(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            col = {n: np.asarray(batch.column(n)).astype(np.int64) for n in (*own, "z0", "y0", "x0", "dz", "dy", "dx")}
            sizes = col["dz"] * col["dy"] * col["dx"]
            for first, end in spans(sizes, MOST_CELLS):
                values = np.frombuffer(b"".join(batch.column("data").slice(first, end - first).to_pylist()), "<u2")
                owner, place = within(sizes[first:end])
                for a in range(0, len(values), MOST_CELLS):
                    k, i = owner[a : a + MOST_CELLS] + first, place[a : a + MOST_CELLS]
                    dx, dy = col["dx"][k], col["dy"][k]
                    part = [*(col[n][k] for n in own), i // (dx * dy) + col["z0"][k], i // dx % dy + col["y0"][k], i % dx + col["x0"][k], values[a : a + MOST_CELLS]]
                    yield pa.RecordBatch.from_arrays([pa.array(p.astype(np.int32)) for p in part], [*own, "z", "y", "x", "v"])

    long = rows.mapInArrow(spread, ", ".join(f"{c} int" for c in (*own, "z", "y", "x", "v")))
    long = long.join(F.broadcast(cameras), "setup") if cameras is not None else long.withColumn("camera", F.lit(0))
    return long.select("camera", "setup", *more, "z", "y", "x", "v")


def to_chunks(voxels: DataFrame, size: tuple[int, int, int], level: int = 0) -> DataFrame:
    """Rows of ``model.CHUNK``, a task's memory holding some chunks at a time, or one large one; voxels that aren't there are zero."""
    keys = ["setup", "cz", "cy", "cx"]
    keyed = voxels.select("setup", *(F.expr(f"cast({c} div {n} as int)").alias(f"c{c}") for c, n in zip("zyx", size)), "z", "y", "x", "v")
    names = [c.split()[0] for c in CHUNK.split(", ")]

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in whole_groups(batches, keys):
            first = group_starts(rows, keys)
            setup, v = np.asarray(rows.column("setup"))[first], np.asarray(rows.column("v")).astype("<u2")
            number = [np.asarray(rows.column(f"c{c}")).astype(np.int64) * n for c, n in zip("zyx", size)]
            at = [np.asarray(rows.column(c)) - start for c, start in zip("zyx", number)]
            shape = [np.maximum.reduceat(a, first) + 1 for a in at]
            room, ends = shape[0] * shape[1] * shape[2], np.append(first[1:], len(v))
            for a, b in spans(room, MOST_CELLS):
                own = slice(first[a], ends[b - 1])
                k = np.repeat(np.arange(a, b), ends[a:b] - first[a:b])
                flat = np.zeros(room[a:b].sum(), "<u2")
                flat[(np.cumsum(room[a:b]) - room[a:b])[k - a] + (at[0][own] * shape[1][k] + at[1][own]) * shape[2][k] + at[2][own]] = v[own]
                columns = [setup[a:b], np.full(b - a, level), *(n[first[a:b]] for n in number), *(n[a:b] for n in shape)]
                yield pa.RecordBatch.from_arrays([*(pa.array(c.astype(np.int32)) for c in columns), binaries(flat, room[a:b])], names)

    return keyed.repartition(*keys).sortWithinPartitions(*keys).mapInPandas(on_frames(cut), CHUNK)


def metadata(fmt: str, shape: tuple[int, int, int], chunk: tuple[int, int, int] = (64, 128, 128), shard: tuple[int, int, int] = (256, 512, 512)) -> dict:
    """An array's metadata; sizes are (z, y, x). Shards are used by zarr3, zarr3_zyx and zarr3_raw."""
    order = PLACES[fmt][1]
    named = lambda v: [int({"z": v[0], "y": v[1], "x": v[2]}.get(c, 1)) for c in order]
    shard = tuple(-(-s // c) * c for s, c in zip(shard, chunk))
    packing = [{"name": "bytes", "configuration": {"endian": "little"}}, {"name": "zstd", "configuration": {"level": 3}}]
    if fmt == "n5":
        return {"dimensions": named(shape), "blockSize": named(chunk), "dataType": "uint16", "compression": {"type": "gzip"}}
    if fmt == "zarr2":
        return {"zarr_format": 2, "shape": named(shape), "chunks": named(chunk), "dtype": ">u2", "fill_value": 0, "order": "C", "filters": None, "dimension_separator": "/", "compressor": {"id": "zstd", "level": 3}}
    sharded = fmt != "zarr3_unsharded"
    inner = {"name": "sharding_indexed", "configuration": {"chunk_shape": named(chunk), "codecs": packing, "index_codecs": [packing[0], {"name": "crc32c"}], "index_location": "end"}}
    return {"zarr_format": 3, "node_type": "array", "data_type": "uint16", "shape": named(shape), "fill_value": 0, "chunk_grid": {"name": "regular", "configuration": {"chunk_shape": named(shard if sharded else chunk)}},
            "chunk_key_encoding": {"name": "default", "configuration": {"separator": "/"}}, "codecs": [inner] if sharded else packing, "dimension_names": list(order)}


def create(root: str, fmt: str, setup: int, shape: tuple[int, int, int], chunk: tuple[int, int, int] = (64, 128, 128), shard: tuple[int, int, int] = (256, 512, 512), level: int = 0) -> Layout:
    """Writes an array's metadata; an array without files is zeros."""
    path, meta = place(root, fmt, setup, level), metadata(fmt, shape, chunk, shard)
    write_json(f"{path}/{PLACES[fmt][0]}", meta)
    return layout_at(path, fmt, meta)


def layout_at(path: str, fmt: str, meta: dict) -> Layout:
    """The layout of an array just created."""
    order = PLACES[fmt][1]
    if fmt == "n5":
        return Layout(path, fmt, order, tuple(meta["dimensions"]), tuple(meta["blockSize"]), None, "gzip", "uint16", "flat")
    if fmt == "zarr2":
        return Layout(path, fmt, order, tuple(meta["shape"]), tuple(meta["chunks"]), None, "zstd", ">u2", "flat")
    outer = tuple(meta["chunk_grid"]["configuration"]["chunk_shape"])
    if fmt == "zarr3_unsharded":
        return Layout(path, fmt, order, tuple(meta["shape"]), outer, None, "zstd", "uint16", "default")
    return Layout(path, fmt, order, tuple(meta["shape"]), tuple(meta["codecs"][0]["configuration"]["chunk_shape"]), outer, "zstd", "uint16", "default")


def encode(found: Layout, blocks: list[tuple[tuple[int, int, int], np.ndarray]], number: tuple[int, ...]) -> bytes:
    """The bytes of one stored file from (z, y, x) blocks that lie in it."""
    outer = found.shard or found.chunk
    start = found.zyx(tuple(n * s for n, s in zip(number, outer)))
    whole = np.zeros(found.zyx(outer), np.uint16)
    for at, block in blocks:
        whole[tuple(slice(a - s, a - s + n) for a, s, n in zip(at, start, block.shape))] = block
    full = found.stored(whole)
    if found.format == "n5":
        room = tuple(slice(0, min(s, a - n * s)) for s, a, n in zip(outer, found.shape, number))
        return codecs.n5_block(full[room], found.compression)
    dtype = found.dtype if found.dtype.startswith((">", "<")) else "<u2"
    pack = lambda b: codecs.compress(np.ascontiguousarray(b).astype(dtype).tobytes(), found.compression)
    if not found.shard:
        return pack(full)
    grid = tuple(s // c for s, c in zip(found.shard, found.chunk))
    parts = (full[tuple(slice(k * c, k * c + c) for k, c in zip(at, found.chunk))] for at in product(*map(range, grid)))
    return codecs.pack_shard([pack(p) if p.any() else None for p in parts])


def write(rows: DataFrame, root: str, fmt: str, shapes: dict[int, tuple[int, int, int]], chunk=(64, 128, 128), shard=(256, 512, 512), level: int = 0) -> None:
    """Writes chunk rows as one level of a store, which takes the place of what is there when all of it is written.

    Chunks may not cross the stored files' borders. Chunks that are missing or zero aren't stored in shards.
    """
    from . import source

    for s in shapes:
        open_group(root, fmt, s)
    shard = tuple(-(-s // c) * c for s, c in zip(shard, chunk))
    outer = chunk if fmt in ("n5", "zarr2", "zarr3_unsharded") else shard
    keyed = rows.select("*", *(F.expr(f"cast({c}0 div {n} as int)").alias(f"f{c}") for c, n in zip("zyx", outer)))
    files_ = ["setup", "fz", "fy", "fx"]
    dealt = keyed.repartition(*files_).sortWithinPartitions(*files_).drop("fz", "fy", "fx")
    source.save(dealt, root, fmt, shapes, chunk, shard, level)


def open_group(root: str, fmt: str, setup: int) -> None:
    """The bare group of a setup, so that viewers find it while it is being written; what is there already stays."""
    if fmt == "n5":
        nodes = {f"{root}/attributes.json": {"n5": "2.0.0"}}
    elif fmt == "zarr2":
        nodes = {f"{at}/.zgroup": {"zarr_format": 2} for at in (root, f"{root}/s{setup}-t0.zarr")}
    else:
        nodes = {f"{at}/zarr.json": {"zarr_format": 3, "node_type": "group"} for at in (root, f"{root}/s{setup}-t0.zarr")}
    for at, node in nodes.items():
        if not files.exists(at):
            write_json(at, node)


def write_group(root: str, fmt: str, setup: int, factors: list[tuple[int, int, int]]) -> None:
    """The multiscale metadata of a setup, from each level's (fz, fy, fx)."""
    if fmt == "n5":
        steps = [[float(fx), float(fy), float(fz)] for fz, fy, fx in factors]
        write_json(f"{root}/attributes.json", {"n5": "2.0.0"})
        write_json(f"{root}/setup{setup}/timepoint0/attributes.json", {"downsamplingFactors": steps, "scales": steps})
        return
    space = [{"type": "space", "name": c, "unit": "micrometer"} for c in "zyx"]
    axes = space if PLACES[fmt][1] == "zyx" else [{"type": "time", "name": "t", "unit": "millisecond"}, {"type": "channel", "name": "c"}, *space]
    scales = [[1.0] * (len(axes) - 3) + [float(f) for f in three] for three in factors]
    datasets = [{"path": str(k) if fmt != "zarr3_raw" else f"raw/s{k}", "coordinateTransformations": [{"type": "scale", "scale": s}, {"type": "translation", "translation": [max(f / 2 - 0.5, 0.0) for f in s]}]} for k, s in enumerate(scales)]
    whole = {"name": "/", "axes": axes, "datasets": datasets, "coordinateTransformations": [{"type": "scale", "scale": [1.0] * len(axes)}]}
    group = f"{root}/s{setup}-t0.zarr"
    if fmt == "zarr2":
        for place_ in (root, group):
            write_json(f"{place_}/.zgroup", {"zarr_format": 2})
        write_json(f"{group}/.zattrs", {"multiscales": [{"version": "0.4", **whole}]})
    else:
        write_json(f"{root}/zarr.json", {"zarr_format": 3, "node_type": "group"})
        write_json(f"{group}/zarr.json", {"zarr_format": 3, "node_type": "group", "attributes": {"ome": {"version": "0.5", "multiscales": [whole]}}})

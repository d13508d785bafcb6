"""The bulk operators on chunk rows: a block of voxels is one row of bytes, and numpy works on whole blocks.

Long voxel rows define what these compute (tests hold each against its twin), but a tile of billions of voxels is a few
thousand chunk rows here. Nothing is dealt by voxel: histograms and moments are summed in the task that read the
chunk, corrections meet their coefficients as blocks of the same place, and order statistics deal whole chunks by
their place in the plane, once.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from itertools import product

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.numeric import binaries, gathered, group_starts, on_frames, rows_of, spans, whole_groups, within
from ..model import CHUNK
from .correct import coefficients
from .orderstats import block_size

SHAPE = ["dz", "dy", "dx"]


def _block(row) -> np.ndarray:
    return np.frombuffer(row["data"], "<u2").reshape(row["dz"], row["dy"], row["dx"])


def _chunk_batch(rows: list[dict]) -> pa.RecordBatch:
    names = ["setup", "level", "z0", "y0", "x0", *SHAPE]
    return pa.RecordBatch.from_arrays([*(pa.array([r[n] for r in rows], pa.int32()) for n in names), pa.array([r["data"] for r in rows], pa.binary())], [*names, "data"])


def mapped(batches: Iterator[pa.RecordBatch], work: Callable[[dict], dict]) -> Iterator[pa.RecordBatch]:
    """Chunk rows made one by one of others."""
    return gathered((work(r) for batch in batches for r in rows_of(batch)), lambda r: len(r["data"]), _chunk_batch)


def histogram(chunks: DataFrame) -> DataFrame:
    """(setup, v, n): each task counts its chunks' levels, 65536 counters a setup at a time."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            held: dict[int, np.ndarray] = {}
            for setup, data in zip(batch.column("setup").to_pylist(), batch.column("data")):
                counts = np.bincount(np.frombuffer(data.as_buffer(), "<u2"), minlength=65536)
                held[setup] = held[setup] + counts if setup in held else counts
            for setup, counts in held.items():
                v = np.flatnonzero(counts)
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(v), setup, np.int32)), pa.array(v.astype(np.int32)), pa.array(counts[v])], ["setup", "v", "n"])

    return chunks.select("setup", "data").mapInArrow(count, "setup int, v int, n long").groupBy("setup", "v").agg(F.sum("n").alias("n"))


def fit(chunks: DataFrame, cameras: DataFrame) -> DataFrame:
    """(camera, setup, y, x, value, n, vmin, vmax) as ``orderstats.fit`` gives them: whole chunks dealt by place in the plane.

    A task holds one pile of chunks, the depth of a tile over a chunk's width and height. Piles of one place have to be cut alike along z.
    """
    tall = chunks.groupBy("setup").agg(F.max(F.col("z0") + F.col("dz")).alias("n")).join(F.broadcast(cameras), "setup")
    depth = tall.groupBy("camera").agg(F.min("n").alias("depth")).filter("depth > 21")
    rows = chunks.join(F.broadcast(cameras), "setup").join(F.broadcast(depth), "camera").filter("z0 < depth")  # a row per setup, per camera

    def one(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("z0")
        first = pdf.iloc[0]
        pile = np.concatenate([_block(r) for r in pdf.to_dict("records")])[: int(first["depth"])]
        n, p = len(pile), block_size(int(first["depth"]))
        value = np.sort(pile[: n // p * p].reshape(n // p, p, *pile.shape[1:]), axis=1).sum(axis=0, dtype=np.float64) / (n // p)
        y, x = np.indices(pile.shape[1:]).reshape(2, -1)
        return pd.DataFrame({"camera": int(first["camera"]), "setup": int(first["setup"]), "y": y + int(first["y0"]), "x": x + int(first["x0"]), "value": list(value.reshape(p, -1).T), "n": n, "vmin": pile.min(axis=0).ravel().astype(int), "vmax": pile.max(axis=0).ravel().astype(int)})

    return rows.groupBy("setup", "y0", "x0").applyInPandas(one, "camera int, setup int, y int, x int, value array<double>, n int, vmin int, vmax int")


def plane_blocks(planes: DataFrame, height: int, width: int, first: str, second: str) -> DataFrame:
    """(camera, y0, x0, first, second): two values of each pixel as float64 blocks of the chunks' size."""
    keyed = planes.withColumn("y0", F.expr(f"cast(y div {height} as int) * {height}")).withColumn("x0", F.expr(f"cast(x div {width} as int) * {width}"))

    def one(pdf: pd.DataFrame) -> pd.DataFrame:
        head = pdf.iloc[0]
        y, x = pdf["y"] - int(head["y0"]), pdf["x"] - int(head["x0"])
        held = np.zeros((2, y.max() + 1, x.max() + 1))
        held[0, y, x], held[1, y, x] = pdf[first], pdf[second]
        return pd.DataFrame({"camera": [int(head["camera"])], "y0": [int(head["y0"])], "x0": [int(head["x0"])], first: [held[0].tobytes()], second: [held[1].tobytes()]})

    return keyed.groupBy("camera", "y0", "x0").applyInPandas(one, f"camera int, y0 int, x0 int, {first} binary, {second} binary")


def field_blocks(fields: DataFrame, height: int, width: int) -> DataFrame:
    """(camera, y0, x0, slope, shift): the correcting coefficients as blocks."""
    return plane_blocks(coefficients(fields), height, width, "slope", "shift")


def corrected_reals(chunks: DataFrame, cameras: DataFrame, fields: DataFrame, size: tuple[int, int] = (128, 128)) -> DataFrame:
    """Chunk rows of (v - dark) / flat, not below zero, as float64: what statistics of corrected voxels see."""
    rows = chunks.join(F.broadcast(cameras), "setup").join(plane_blocks(fields.select("camera", "y", "x", "flat", "dark"), *size, "flat", "dark"), ["camera", "y0", "x0"])  # a row per setup

    def one(r: dict) -> dict:
        raw = _block(r).astype(np.float64)
        flat, dark = (np.frombuffer(r[c]).reshape(raw.shape[1:]) for c in ("flat", "dark"))
        return r | {"data": np.maximum((raw - dark) / flat, 0).tobytes()}

    return rows.mapInArrow(lambda batches: mapped(batches, one), CHUNK)


def correct(chunks: DataFrame, cameras: DataFrame, fields: DataFrame | None = None, tiles: DataFrame | None = None, size: tuple[int, int] = (128, 128)) -> DataFrame:
    """Chunk rows corrected as ``correct.correct`` does voxels; ``size`` is the chunks' height and width.

    Chunks meet their coefficients by one join on (camera, y0, x0), their tile's numbers by one on setup.
    """
    rows = chunks.join(F.broadcast(cameras), "setup")  # a row per setup
    rows = rows.join(field_blocks(fields, *size), ["camera", "y0", "x0"]) if fields is not None else rows.withColumn("slope", F.lit(None).cast("binary")).withColumn("shift", F.lit(None).cast("binary"))
    if tiles is not None:
        rows = rows.join(F.broadcast(tiles), "setup", "left")  # a row per setup
    else:
        rows = rows.withColumns({"mode": F.lit(None).cast("string")} | {c: F.lit(None).cast("double") for c in ("thr", "mean", "scale", "target_mean")})

    def one(r: dict) -> bytes:
        raw = _block(r).astype(np.float64)
        plane = lambda c: np.frombuffer(r[c]).reshape(raw.shape[1:])
        joint = r["slope"] is not None
        out = raw * plane("slope") + plane("shift") if joint else raw
        if r["mode"] in ("uniform", "bimodal"):
            base = r["target_mean"] - r["mean"] * r["scale"]
            if r["mode"] == "uniform":
                out = np.maximum(raw * (plane("slope") * r["scale"]) + (plane("shift") * r["scale"] + base), base) if joint else (raw - r["mean"]) * r["scale"] + r["target_mean"]
            elif joint:
                out = np.maximum(out, 0) if r["thr"] < 0 else out
                out = np.where(out > r["thr"], out * r["scale"] + base, out)
            else:
                out = np.where(raw > r["thr"], (raw - r["mean"]) * r["scale"] + r["target_mean"], raw)
        return np.rint(np.clip(out, 0, 65535)).astype("<u2").tobytes()

    return rows.mapInArrow(lambda batches: mapped(batches, lambda r: r | {"data": one(r)}), CHUNK)


def pyramid(chunks: DataFrame, sizes: DataFrame, factors: dict[int, tuple[int, int, int]], out: tuple[int, int, int] = (64, 128, 128)) -> DataFrame:
    """Chunk rows of all levels in ``factors`` (level: (fz, fy, fx)), cut to whole chunks of size ``out``, from one reading of level 0.

    ``sizes`` is (setup, nz, ny, nx). Each input chunk is summed in the task that read it, for every level at once, into the output chunks that
    it meets; the parts of an output chunk then meet in one shuffle, dealt by their place, and are divided by the voxels that
    each coarse voxel has within the tile. So neither sizes nor factors need to divide anything. Parts are sums of four bytes a
    coarse voxel, and of two where the factors are one, which only cuts chunks anew.
    """
    if max(int(np.prod(f)) for f in factors.values()) * 65535 >= 1 << 32:
        raise ValueError("a coarse voxel may hold 65536 voxels at most")

    def parts(batch: pa.RecordBatch) -> Iterator[tuple]:
        for r in rows_of(batch):
            block, start = _block(r), (r["z0"], r["y0"], r["x0"])
            for level, three in factors.items():
                sums, kind = block, "<u2"
                low = [s // f for s, f in zip(start, three)]
                if three != (1, 1, 1):
                    sums, kind = block.astype(np.uint32), "<u4"
                    for axis, f in enumerate(three):
                        edges = np.arange(-(start[axis] % f), block.shape[axis], f)
                        sums = np.add.reduceat(sums, np.maximum(edges, 0), axis)
                yield from _parts(r["setup"], level, low, sums, kind, out)

    def part_batch(rows: list[tuple]) -> pa.RecordBatch:
        columns = list(zip(*rows))
        return pa.RecordBatch.from_arrays([*(pa.array(c, pa.int32()) for c in columns[:-1]), pa.array(columns[-1], pa.binary())], ["setup", "level", "cz", "cy", "cx", "z0", "y0", "x0", *SHAPE, "data"])

    schema = "setup int, level int, cz int, cy int, cx int, z0 int, y0 int, x0 int, dz int, dy int, dx int, data binary"
    rows = chunks.mapInArrow(lambda batches: gathered((p for b in batches for p in parts(b)), lambda p: len(p[-1]), part_batch), schema)
    rows = rows.join(F.broadcast(sizes.select("setup", "nz", "ny", "nx")), "setup")  # a row per setup
    keys = ["level", "setup", "cz", "cy", "cx"]

    def whole(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in whole_groups(batches, keys):
            level_of = np.asarray(table.column("level"))
            for level in np.unique(level_of).tolist():
                own = np.flatnonzero(level_of == level)
                yield from _whole_chunks(table.slice(own[0], len(own)), level, factors[level], out)

    return rows.repartition(*keys).sortWithinPartitions(*keys).mapInPandas(on_frames(whole), CHUNK)


def _whole_chunks(rows: pa.Table, level: int, three: tuple[int, int, int], out: tuple[int, int, int]) -> Iterator[pa.RecordBatch]:
    """A level's output chunks from all their parts, sorted by chunk."""
    first = group_starts(rows, ["setup", "cz", "cy", "cx"])
    ends = np.append(first[1:], len(rows))
    col = {n: np.asarray(rows.column(n)).astype(np.int64) for n in rows.schema.names if n != "data"}
    n = [col[f"n{c}"][first] for c in "zyx"]
    start = [col[f"c{c}"][first] * o for c, o in zip("zyx", out)]
    size = [np.minimum(o, -(-m // f) - s) for o, m, f, s in zip(out, n, three, start)]
    room, pieces = size[0] * size[1] * size[2], col["dz"] * col["dy"] * col["dx"]
    for a, b in spans(room, 1 << 18):
        p = slice(first[a], ends[b - 1])
        owner, k = within(pieces[p])
        at = [k // (col["dy"][p] * col["dx"][p])[owner] + col["z0"][p][owner], k // col["dx"][p][owner] % col["dy"][p][owner] + col["y0"][p][owner], k % col["dx"][p][owner] + col["x0"][p][owner]]
        g = np.repeat(np.arange(a, b), ends[a:b] - first[a:b])[owner]
        z, y, x = (v - s[g] for v, s in zip(at, start))
        values = np.frombuffer(b"".join(rows.column("data").slice(first[a], ends[b - 1] - first[a]).to_pylist()), "<u2" if three == (1, 1, 1) else "<u4")
        base = np.cumsum(room[a:b]) - room[a:b]
        total = np.bincount(base[g - a] + (z * size[1][g] + y) * size[2][g] + x, values, room[a:b].sum())  # sums below 2**53 are exact
        g, k = within(room[a:b])
        g += a
        counts = 1.0
        for m, f, v, s in zip(n, three, (k // (size[1] * size[2])[g], k // size[2][g] % size[1][g], k % size[2][g]), start):  # voxels within the tile, an axis at a time
            counts = counts * np.minimum(f, m[g] - (s[g] + v) * f)
        columns = [col["setup"][first[a:b]], np.full(b - a, level), *(s[a:b] for s in start), *(s[a:b] for s in size)]
        yield pa.RecordBatch.from_arrays([*(pa.array(c.astype(np.int32)) for c in columns), binaries(np.rint(total / counts).astype("<u2"), room[a:b])], ["setup", "level", "z0", "y0", "x0", *SHAPE, "data"])


def _parts(setup: int, level: int, low: list[int], sums: np.ndarray, kind: str, out: tuple[int, int, int]) -> Iterator[tuple]:
    """A level's sums, cut at the borders of output chunks."""
    spans_ = [[(c, max(a, c * o), min(a + n, (c + 1) * o)) for c in range(a // o, (a + n - 1) // o + 1)] for a, n, o in zip(low, sums.shape, out)]
    for (cz, za, zb), (cy, ya, yb), (cx, xa, xb) in product(*spans_):
        piece = sums[za - low[0] : zb - low[0], ya - low[1] : yb - low[1], xa - low[2] : xb - low[2]]
        yield setup, level, cz, cy, cx, za, ya, xa, *piece.shape, np.ascontiguousarray(piece).astype(kind).tobytes()


def downsample(chunks: DataFrame, fz: int, fy: int, fx: int, level: int) -> DataFrame:
    """The next level's chunks from chunks whose beginnings the factors divide: each shrinks in its own task, nothing is shuffled."""

    def shrink(block: np.ndarray) -> np.ndarray:
        sums, counts = block.astype(np.float64), np.ones(block.shape)
        for axis, f in enumerate((fz, fy, fx)):
            at = np.arange(0, block.shape[axis], f)
            sums, counts = np.add.reduceat(sums, at, axis), np.add.reduceat(counts, at, axis)
        return np.rint(sums / counts).astype("<u2")

    def one(r: dict) -> dict:
        if r["z0"] % fz or r["y0"] % fy or r["x0"] % fx:
            raise ValueError(f"a chunk begins at {r['z0'], r['y0'], r['x0']}, which {fz, fy, fx} doesn't divide")
        small = shrink(_block(r))
        return {"setup": r["setup"], "level": level, "z0": r["z0"] // fz, "y0": r["y0"] // fy, "x0": r["x0"] // fx, "dz": small.shape[0], "dy": small.shape[1], "dx": small.shape[2], "data": small.tobytes()}

    return chunks.mapInArrow(lambda batches: mapped(batches, one), CHUNK)

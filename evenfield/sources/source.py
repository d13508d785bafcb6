"""Chunk stores as a source and sink of Spark, for ``spark.read.format("evenfield")`` and ``df.write.format("evenfield")``.

Reading: options ``path``, ``layout`` (one of ``stores.FORMATS``), ``setups`` and ``levels`` (numbers with commas, or all that are there),
``z``, ``y`` and ``x`` (``low:end``, either may be left out), ``rows`` (``chunks``, ``voxels`` or ``files``: a row and hash per stored file) and ``files_per_task``. A partition is a run of the stored
files' numbers, told by its ends, so the driver holds a row per task and never a list of files. Ranges choose files, and chunks
within a shard, before any is opened; voxel rows are cut to them, chunk rows are whole. What isn't stored gives rows of the fill value.

With the option ``pushdown`` filters on setup, level and z, y, x (z0, y0, x0 of chunks) do the same. Spark 4.1 keeps the filters of a relation's
first scan for its later ones, so this is for a DataFrame that is read by one scan: ``load`` anew for each other filter. It is off unless asked for.

Writing: chunk rows dealt and sorted by stored file (``stores.write`` does that), options ``path``, ``layout``, ``level``, ``shapes`` (json:
(z, y, x) of each setup), ``chunk`` and ``shard``. Files gather in a folder of the job beside the array, each put there whole, so a task that
runs again changes nothing. The job's commit moves a folder per setup into place; a job that fails leaves the store as it was.
"""

from __future__ import annotations

import hashlib
import json
import uuid
from collections.abc import Callable, Iterable, Iterator, Sequence
from dataclasses import dataclass
from itertools import product

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, DataSourceReader, EqualTo, Filter, GreaterThan, GreaterThanOrEqual, In, InputPartition, LessThan, LessThanOrEqual, WriterCommitMessage
from pyspark.sql.types import StructType

from ..functions.numeric import gathered, rows_of
from ..model import CHUNK
from . import files, stores

NAME = "evenfield"
FILES = "setup int, level int, file string, n_bytes long, sha256 string"
VOXELS = "setup int, level int, z int, y int, x int, v int"
#: Tasks that a read is cut into at most, files of a task at least, and bytes that it holds about, where a file counts as FILE_BYTES at least.
MOST_TASKS, FEWEST_FILES, TASK_BYTES, FILE_BYTES = 50_000, 8, 1 << 22, 1 << 14
#: Voxel rows of a batch.
VOXEL_ROWS = 1 << 16
FAR = 1 << 31


@dataclass
class Files(InputPartition):
    """Files number ``first`` to ``end`` of a box of an array's grid of files, counted in the array's own order."""

    setup: int
    level: int
    layout: stores.Layout
    low: tuple[int, ...]
    size: tuple[int, ...]
    first: int
    end: int

    def numbers(self) -> Iterator[tuple[int, ...]]:
        for k in range(self.first, self.end):
            yield tuple(int(a) + b for a, b in zip(np.unravel_index(k, self.size), self.low))


def _range(text: str) -> tuple[int, int]:
    """(low, end) of ``low:end``."""
    low, _, end = text.partition(":")
    return int(low or -FAR), int(end or FAR)


def _limits(f: Filter) -> tuple[str, Callable[[int], bool], tuple[int, int]] | None:
    """(column, test, (low, end) of what passes) of a comparison with a number; None for other filters."""
    if len(getattr(f, "attribute", ())) != 1 or not isinstance(f, (EqualTo, In, GreaterThan, GreaterThanOrEqual, LessThan, LessThanOrEqual)):
        return None
    v = f.value
    if isinstance(f, In):
        held = {x for x in v if x is not None}
        return f.attribute[0], held.__contains__, (min(held, default=0), max(held, default=-1) + 1)
    if v is None:
        return None
    return f.attribute[0], *{
        EqualTo: (v.__eq__, (v, v + 1)), GreaterThan: (lambda x: x > v, (v + 1, FAR)), GreaterThanOrEqual: (lambda x: x >= v, (v, FAR)),
        LessThan: (lambda x: x < v, (-FAR, v)), LessThanOrEqual: (lambda x: x <= v, (-FAR, v + 1)),
    }[type(f)]


class StoreReader(DataSourceReader):
    def __init__(self, options: dict[str, str]):
        self.root, self.format = options["path"], options["layout"]
        self.rows = options.get("rows", "chunks")
        if self.rows not in ("chunks", "voxels", "files"):
            raise ValueError(f"rows {self.rows!r} are none of chunks, voxels and files")
        self.voxels = self.rows == "voxels"
        self.setups, self.levels = options.get("setups"), options.get("levels", "0")
        self.files_per_task = int(options.get("files_per_task", 0))
        self.tests: list[tuple[str, Callable[[int], bool]]] = []
        self.box = [_range(options.get(c, "")) for c in "zyx"]
        self.asked = tuple(self.box)

    def pushed(self, filters: list[Filter]) -> Iterable[Filter]:
        axes = [c if self.voxels else f"{c}0" for c in "zyx"]
        for f in filters:
            found = _limits(f)
            if found and found[0] in ("setup", "level"):
                self.tests.append(found[:2])
                continue
            if found and found[0] in axes:  # whole chunks are chosen; what remains is Spark's
                k = axes.index(found[0])
                self.box[k] = (max(self.box[k][0], found[2][0]), min(self.box[k][1], found[2][1]))
            yield f

    def arrays(self) -> Iterator[tuple[int, int, stores.Layout]]:
        """(setup, level, layout) of what is asked for; metadata of no other array is read."""
        passes = lambda name, v: all(test(v) for column, test in self.tests if column == name)
        setups = [int(s) for s in self.setups.split(",")] if self.setups else stores.setups(self.root, self.format)
        for setup in setups:
            if not passes("setup", setup):
                continue
            levels = range(len(stores.pyramid_shapes(self.root, self.format, setup))) if self.levels == "all" else [int(v) for v in self.levels.split(",")]
            for level in levels:
                if passes("level", level):
                    yield setup, level, stores.layout(self.root, self.format, setup, level)

    def partitions(self) -> Sequence[InputPartition]:
        boxes = []
        for setup, level, found in self.arrays():
            outer = found.shard or found.chunk
            low, size = [], []
            for c, n, o in zip(found.order, found.shape, outer):
                a, b = self.box["zyx".index(c)] if c in "zyx" else (-FAR, FAR)
                a, b = max(0, a) // o, -(-min(n, b) // o)
                low.append(a)
                size.append(max(0, b - a))
            if min(size) > 0:
                boxes.append(Files(setup, level, found, tuple(low), tuple(size), 0, int(np.prod(size, dtype=object))))
        fewest = max(FEWEST_FILES, -(-sum(b.end for b in boxes) // MOST_TASKS))
        bytes_ = lambda b: max(FILE_BYTES, 2 * int(np.prod(b.layout.shard or b.layout.chunk, dtype=object)))
        steps = [self.files_per_task or max(fewest, TASK_BYTES // bytes_(b)) for b in boxes]
        return [Files(b.setup, b.level, b.layout, b.low, b.size, k, min(k + step, b.end)) for b, step in zip(boxes, steps) for k in range(0, b.end, step)]

    def read(self, partition: Files | None) -> Iterator[pa.RecordBatch]:
        if partition is None:  # nothing is left to read
            return
        box = tuple(self.box)
        if self.rows == "chunks":
            blocks = (b for number in partition.numbers() for b in stores.read_block(partition.layout, number, box))
            yield from gathered(blocks, lambda b: b[1].nbytes, lambda held: _chunks(partition.setup, partition.level, held))
            return
        for number in partition.numbers():
            if self.rows == "files":
                yield from _file(partition, number)
                continue
            for place, block in stores.read_block(partition.layout, number, box):
                cut = tuple(slice(max(0, low - p), max(0, end - p)) for p, (low, end) in zip(place, self.asked))
                place = tuple(max(p, low) for p, (low, _) in zip(place, self.asked))
                yield from _voxels(partition.setup, partition.level, place, block[cut])


class PushingReader(StoreReader):
    def pushFilters(self, filters: list[Filter]) -> Iterable[Filter]:
        yield from self.pushed(filters)


def _file(partition: Files, number: tuple[int, ...]) -> Iterator[pa.RecordBatch]:
    path = partition.layout.file(number)
    try:
        data = files.read(path)
    except FileNotFoundError:
        return
    name = path.removeprefix(f"{partition.layout.path}/")
    columns = [pa.array([partition.setup], pa.int32()), pa.array([partition.level], pa.int32()), pa.array([name]), pa.array([len(data)], pa.int64()), pa.array([hashlib.sha256(data).hexdigest()])]
    yield pa.RecordBatch.from_arrays(columns, ["setup", "level", "file", "n_bytes", "sha256"])


def _chunks(setup: int, level: int, held: list[tuple[tuple[int, int, int], np.ndarray]]) -> pa.RecordBatch:
    values = zip(*((setup, level, *place, *block.shape) for place, block in held))
    data = [np.ascontiguousarray(block).astype("<u2").tobytes() for _, block in held]
    return pa.RecordBatch.from_arrays([*(pa.array(v, pa.int32()) for v in values), pa.array(data, pa.binary())], ["setup", "level", "z0", "y0", "x0", "dz", "dy", "dx", "data"])


def _voxels(setup: int, level: int, place: tuple[int, int, int], block: np.ndarray) -> Iterator[pa.RecordBatch]:
    flat = np.ascontiguousarray(block).ravel()
    for a in range(0, len(flat), VOXEL_ROWS):
        v = flat[a : a + VOXEL_ROWS]
        at = np.unravel_index(np.arange(a, a + len(v)), block.shape)
        columns = [np.full(len(v), setup), np.full(len(v), level), *(i + p for i, p in zip(at, place)), v]
        yield pa.RecordBatch.from_arrays([pa.array(c.astype(np.int32)) for c in columns], ["setup", "level", "z", "y", "x", "v"])


@dataclass
class Written(WriterCommitMessage):
    n_files: int
    n_bytes: int


class StoreWriter(DataSourceArrowWriter):
    def __init__(self, options: dict[str, str], overwrite: bool):
        self.root, self.format, self.level = options["path"], options["layout"], int(options.get("level", 0))
        self.shapes = {int(k): tuple(v) for k, v in json.loads(options["shapes"]).items()}
        three = lambda name, default: tuple(int(v) for v in options.get(name, default).split(","))
        self.chunk, self.shard = three("chunk", "64,128,128"), three("shard", "256,512,512")
        self.overwrite, self.job = overwrite, uuid.uuid4().hex

    def metadata(self, setup: int) -> dict:
        return stores.metadata(self.format, self.shapes[setup], self.chunk, self.shard)

    def aside(self, setup: int) -> str:
        folder, _, name = stores.place(self.root, self.format, setup, self.level).rpartition("/")
        return f"{folder}/.{name}-{self.job}"

    def write(self, iterator: Iterator[pa.RecordBatch]) -> Written:
        own: tuple | None = None
        blocks, done, layouts, n_bytes = [], set(), {}, 0

        def close() -> int:
            setup, number = own
            data = stores.encode(layouts[setup], blocks, number)
            files.write(layouts[setup].file(number), data)
            done.add(own)
            return len(data)

        for batch in iterator:
            for r in rows_of(batch):  # blocks of one file at a time, so memory is bounded by a file and a batch
                setup = r["setup"]
                if setup not in layouts:
                    if setup not in self.shapes:
                        raise ValueError(f"setup {setup} has no shape")
                    layouts[setup] = stores.layout_at(self.aside(setup), self.format, self.metadata(setup))
                found = layouts[setup]
                outer = found.zyx(found.shard or found.chunk)
                number = found.own(*(r[f"{c}0"] // n for c, n in zip("zyx", outer)), 0)
                if own != (setup, number):
                    if own:
                        n_bytes += close()
                    own, blocks = (setup, number), []
                    if own in done:
                        raise ValueError("chunk rows aren't sorted by the files that they go to")
                blocks.append(((r["z0"], r["y0"], r["x0"]), np.frombuffer(r["data"], "<u2").reshape(r["dz"], r["dy"], r["dx"])))
        if own:
            n_bytes += close()
        return Written(len(done), n_bytes)

    def commit(self, messages: list[Written | None]) -> None:
        targets = {setup: stores.place(self.root, self.format, setup, self.level) for setup in self.shapes}
        if not self.overwrite and (there := [t for t in targets.values() if files.exists(t)]):
            raise ValueError(f"{there[0]} is there already; write with mode overwrite")
        for setup in self.shapes:  # arrays that have no rows are there without files
            files.write_json(f"{self.aside(setup)}/{stores.PLACES[self.format][0]}", self.metadata(setup))
        for setup, target in targets.items():
            aside = self.aside(setup)
            if files.exists(target):
                files.move(target, f"{aside}-old")
            files.move(aside, target)
            files.drop(f"{aside}-old")

    def abort(self, messages: list[Written | None]) -> None:
        for setup in self.shapes:
            files.drop(self.aside(setup))


class StoreSource(DataSource):
    @classmethod
    def name(cls) -> str:
        return NAME

    def schema(self) -> str:
        return {"voxels": VOXELS, "files": FILES}.get(self.options.get("rows"), CHUNK)

    def reader(self, schema: StructType) -> DataSourceReader:
        return (PushingReader if self.options.get("pushdown") == "true" else StoreReader)(dict(self.options))

    def writer(self, schema: StructType, overwrite: bool) -> StoreWriter:
        return StoreWriter(dict(self.options), overwrite)


def register(spark: SparkSession) -> None:
    """Makes the format known to a session."""
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    spark.dataSource.register(StoreSource)


def load(spark: SparkSession, root: str, layout: str, **options: str) -> DataFrame:
    if layout not in stores.FORMATS:
        raise ValueError(f"format {layout!r} is none of {stores.FORMATS}")
    register(spark)
    return spark.read.format(NAME).options(layout=layout, **options).load(root)


def save(rows: DataFrame, root: str, layout: str, shapes: dict[int, tuple[int, int, int]], chunk: tuple[int, int, int], shard: tuple[int, int, int], level: int = 0) -> None:
    register(rows.sparkSession)
    text = lambda v: ",".join(map(str, v))
    options = {"layout": layout, "level": str(level), "shapes": json.dumps({str(k): list(map(int, v)) for k, v in shapes.items()}), "chunk": text(chunk), "shard": text(shard)}
    rows.select(*(c.split()[0] for c in CHUNK.split(", "))).write.format(NAME).mode("overwrite").options(**options).save(root)

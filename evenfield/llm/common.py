"""Small helpers the corpus operators share: table access, lineage cuts and the words of a text."""

from __future__ import annotations

import contextlib
import ctypes
import gc
import re
import tempfile
from collections.abc import Callable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: A word is a longest run of characters other than these.
WORD_SEPARATORS = b"\x20\x09\x0a\x0b\x0c\x0d"
#: Bytes of text that the vectorised kernels hold at a time; their arrays take some 50 times as much.
BLOCK_BYTES = 1 << 18
#: Bytes of a batch on its way between Spark and a Python task; a longer row is a batch of its own.
BATCH_BYTES = 1 << 22


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def shared_folder(spark: SparkSession) -> str:
    """The folder that the cluster names in ``spark.checkpoint.dir``; one is made only where that is unset and the master is local."""
    context = spark.sparkContext
    if context.getCheckpointDir() is None:
        named = context.getConf().get("spark.checkpoint.dir")
        if not named and not re.match(r"local(\[|$)", context.master):
            raise ValueError("spark.checkpoint.dir must name a folder that the driver and all executors share")
        context.setCheckpointDir(named or tempfile.mkdtemp(prefix="checkpoints-"))
    return context.getCheckpointDir()


def free_shuffles(spark: SparkSession) -> None:
    """Has the driver drop its handles of earlier steps: their shuffle files are deleted only then, and would otherwise lie on the
    executors' disks beside the next step's."""
    gc.collect()
    spark.sparkContext._jvm.System.gc()


def cut(df: DataFrame) -> DataFrame:
    """``df``, computed once and kept in the shared folder, so a lost executor costs no recomputation."""
    shared_folder(df.sparkSession)
    free_shuffles(df.sparkSession)
    return df.checkpoint(eager=True)


def map_batches(df: DataFrame, work: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]], schema) -> DataFrame:
    """``df.mapInArrow`` in batches bounded by bytes, whatever the length of texts; a task's free memory goes back at its end,
    as workers live on from task to task."""
    df.sparkSession.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", BATCH_BYTES)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from work(batches)
        pa.default_memory_pool().release_unused()
        with contextlib.suppress(OSError, AttributeError):  # other C libraries have no such call
            ctypes.CDLL(None).malloc_trim(0)

    return df.mapInArrow(run, schema)


def as_row(df: DataFrame) -> Column:
    """All columns of ``df`` as one, so that whatever they are called they don't clash with those that work is done in."""
    return F.struct(*(F.col(f"`{c}`") for c in df.columns)).alias("row")


def from_row(df: DataFrame, columns: list[str]) -> DataFrame:
    """The columns that ``as_row`` took."""
    return df.select(*(F.col("row").getField(c).alias(c) for c in columns))


def drop_folder(spark: SparkSession, folder: str) -> None:
    """Deletes a folder of the shared store that no later step reads."""
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def small_or_not(rows: DataFrame, most: int = 500_000) -> DataFrame:
    """``rows`` written out, and marked for broadcast only if they were found to be at most ``most``; else joined by shuffle."""
    rows = cut(rows)
    return F.broadcast(rows) if rows.count() <= most else rows


def computed_once(rows: DataFrame, name: str, value: Column, *keep: str) -> DataFrame:
    """``keep`` columns and ``value``, which later steps read and the optimizer can't inline into them, once per use.

    A one-element explode is a step that predicates on its output aren't pushed below.
    """
    return rows.select(*keep, F.explode(F.array(value)).alias(name))


def whole_text(column: str = "text") -> Column:
    """The text, with null counted as empty."""
    return F.coalesce(F.col(column), F.lit(""))


# --------------------------------------------------------------------------- words by numpy


def _mix(h: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit values that spreads every bit (shift, multiply, shift)."""
    h = h ^ (h >> np.uint64(31))
    h = h * np.uint64(0x7FB5D329728EA185)
    h = h ^ (h >> np.uint64(27))
    h = h * np.uint64(0x81DADEF4BC2DD44D)
    return h ^ (h >> np.uint64(33))


mix = _mix
_BYTE = _mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))
_BASE = 0xD6E8FEB86659FD93
_SEPARATOR = np.zeros(256, bool)
_SEPARATOR[list(WORD_SEPARATORS)] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


@lru_cache(maxsize=1)
def _power_tables() -> tuple[np.ndarray, np.ndarray]:
    """The powers of the base and of its inverse, for ranges of BLOCK_BYTES at most."""
    out = []
    for base in (_BASE, pow(_BASE, -1, 1 << 64)):
        table = np.full(BLOCK_BYTES + 1, base, np.uint64)
        table[0] = 1
        out.append(np.multiply.accumulate(table))
    return out[0], out[1]


def _long_sum(part: np.ndarray) -> np.uint64:
    """The sum that ``hash_ranges`` makes of a range, in pieces of BLOCK_BYTES."""
    up, total = _power_tables()[0], 0
    for at in range(0, len(part), BLOCK_BYTES):
        piece = part[at : at + BLOCK_BYTES]
        total += int((_BYTE[piece] * up[: len(piece)]).sum(dtype=np.uint64)) * pow(_BASE, at, 1 << 64)
    return np.uint64(total & ((1 << 64) - 1))


def hash_ranges(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each ascending byte range of ``data``; equal bytes give equal hashes. Memory depends on BLOCK_BYTES only."""
    up, down = _power_tables()
    sums_of = np.empty(len(starts), np.uint64)
    k = 0
    while k < len(starts):
        base = starts[k]
        if ends[k] - base > BLOCK_BYTES:
            sums_of[k] = _long_sum(data[base : ends[k]])
            k += 1
            continue
        stop = max(k + 1, int(np.searchsorted(ends, base + BLOCK_BYTES, "right")))
        last = int(ends[stop - 1])
        sums = np.zeros(last - base + 1, np.uint64)
        np.cumsum(_BYTE[data[base:last]] * up[: last - base], out=sums[1:])
        s, e = starts[k:stop] - base, ends[k:stop] - base
        sums_of[k:stop] = (sums[e] - sums[s]) * down[s]
        k = stop
    return _mix(sums_of + (ends - starts).astype(np.uint64))


class WordBlock:
    """The words of a block of texts: byte ranges, hashes and which text each belongs to."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray, lower: bool = False):
        self.data, self.offsets = (_LOWER[data] if lower else data), offsets
        self.n_texts = len(offsets) - 1
        word = ~_SEPARATOR[data]
        self.in_word = word
        starts, last = word.copy(), word.copy()
        starts[1:] &= ~word[:-1]
        last[:-1] &= ~word[1:]
        inner = offsets[1:-1][(offsets[1:-1] > 0) & (offsets[1:-1] < len(data))]
        starts[inner] = word[inner]
        last[inner - 1] = word[inner - 1]
        self.starts, self.ends = np.flatnonzero(starts), np.flatnonzero(last) + 1
        self.word_offsets = np.searchsorted(self.starts, offsets)
        self.n_words = np.diff(self.word_offsets)
        self.text_of = np.repeat(np.arange(self.n_texts), self.n_words)
        self.hashes = hash_ranges(self.data, self.starts, self.ends)

    def windows(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        """First word and hash of every window of ``n`` words that lies in one text."""
        m = len(self.hashes) - n + 1
        if m <= 0:
            return np.empty(0, np.int64), np.empty(0, np.uint64)
        first = np.flatnonzero(self.text_of[: m] == self.text_of[n - 1 :])
        h = np.zeros(m, np.uint64)
        for k in range(n):
            h = h * np.uint64(0xA0761D6478BD642F) + self.hashes[k : k + m]
        return first, _mix(h[first] + np.uint64(n))

    def per_text(self, flags: np.ndarray) -> np.ndarray:
        """Number of flagged bytes of each text."""
        held = np.diff(self.offsets) > 0
        out = np.zeros(self.n_texts, np.int64)
        if held.any():
            out[held] = np.add.reduceat(flags, self.offsets[:-1][held], dtype=np.int64)
        return out


def text_blocks(column: pa.Array, most: int = BLOCK_BYTES, rows: int = 4096) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first, end, bytes, offsets) of runs of texts of about ``most`` bytes, ``rows`` at most; a longer text is a run of its own."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = pc.fill_null(column, "")
    wide = pa.types.is_large_string(column.type)
    _, where, data = column.buffers()
    n = len(column)
    if n == 0:
        return
    offsets = np.frombuffer(where, np.int64 if wide else np.int32)[column.offset : column.offset + n + 1].astype(np.int64)
    data = np.frombuffer(data, np.uint8) if data is not None else np.empty(0, np.uint8)
    first = 0
    while first < n:
        end = max(first + 1, int(np.searchsorted(offsets, offsets[first] + most, "right")) - 1)
        end = min(end, n, first + rows)
        yield first, end, data[offsets[first] : offsets[end]], offsets[first : end + 1] - offsets[first]
        first = end


def repeated(keys: np.ndarray) -> np.ndarray:
    """Flags the entries whose key occurs more than once."""
    out = np.zeros(len(keys), bool)
    if len(keys) > 1:
        order = np.argsort(keys)
        same = keys[order][1:] == keys[order][:-1]
        out[order[1:][same]] = True
        out[order[:-1][same]] = True
    return out


def word_list(text: str | None) -> list[str]:
    """The words of a text in plain Python, for tests and small inputs."""
    return [w for w in (text or "").translate(str.maketrans("\t\n\v\f\r", "     ")).split(" ") if w]

"""Numpy kernels: cosine transforms, bilinear resizing and soft thresholds of planes."""

from __future__ import annotations

from functools import lru_cache

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa


@lru_cache(maxsize=16)
def dct_basis(n: int) -> np.ndarray:
    """Rows are the orthonormal DCT-II basis of n points."""
    k = np.arange(n)
    basis = np.cos(np.pi * np.outer(k, 2 * k + 1) / (2 * n)) * np.sqrt(2 / n)
    basis[0] /= np.sqrt(2)
    return basis


def dct2(plane: np.ndarray) -> np.ndarray:
    h, w = plane.shape
    return (dct_basis(h) @ plane @ dct_basis(w).T).astype(np.float32)


def idct2(coefficients: np.ndarray) -> np.ndarray:
    h, w = coefficients.shape
    return (dct_basis(h).T @ coefficients @ dct_basis(w)).astype(np.float32)


def soft(x: np.ndarray, threshold) -> np.ndarray:
    return np.copysign(np.maximum(np.abs(x) - threshold, 0), x).astype(x.dtype)


def axis_weights(n_in: int, n_out: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """For each output position the two input positions it lies between and the share of the second; outer edges align."""
    place = np.clip(n_in / n_out * (np.arange(n_out) + 0.5) - 0.5, 0, n_in - 1)
    low = np.minimum(np.floor(place).astype(int), max(n_in - 2, 0))
    return low, np.minimum(low + 1, n_in - 1), place - low


def resize(planes: np.ndarray, out: tuple[int, int]) -> np.ndarray:
    """The leading two axes resized bilinearly, in double precision until the end."""
    found = np.asarray(planes, float)
    for axis, n in enumerate(out):
        if found.shape[axis] != n:
            low, high, share = axis_weights(found.shape[axis], n)
            share = share.reshape([-1 if k == axis else 1 for k in range(found.ndim)])
            found = np.take(found, low, axis) * (1 - share) + np.take(found, high, axis) * share
    return np.ascontiguousarray(found, np.float32)


def group_starts(rows: pa.Table | pa.RecordBatch, keys: list[str]) -> np.ndarray:
    """Where groups of equal whole-number keys begin among sorted rows."""
    at = np.stack([np.asarray(rows.column(k)) for k in keys])
    return np.flatnonzero(np.concatenate([np.ones(min(1, at.shape[1]), bool), np.any(at[:, 1:] != at[:, :-1], axis=0)]))


def whole_groups(batches: Iterator[pa.RecordBatch], keys: list[str]) -> Iterator[pa.Table]:
    """Rows sorted by keys as tables that end where a group ends; what is held is a group and a batch."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        if not len(batch):
            continue
        cut = int(group_starts(batch, keys)[-1])
        if not cut and held and all(batch.column(k)[0] == held[0].column(k)[0] for k in keys):
            held.append(batch)
            continue
        if head := [*held, *([batch.slice(0, cut)] if cut else [])]:
            yield pa.Table.from_batches(head).combine_chunks()
        held = [batch.slice(cut)]
    if held:
        yield pa.Table.from_batches(held).combine_chunks()


def on_frames(work):
    """``work`` on batches, for ``mapInPandas``: where rows that were dealt and sorted are put together, apart from the ``mapInArrow`` that reads chunks."""

    def run(frames: Iterator) -> Iterator:
        for batch in work(pa.RecordBatch.from_pandas(f, preserve_index=False) for f in frames):
            yield batch.to_pandas()

    return run


def spans(sizes: np.ndarray, most: int) -> Iterator[tuple[int, int]]:
    """(first, end) of runs of things that hold ``most`` together, or of one that holds more."""
    ends, a = np.cumsum(sizes), 0
    while a < len(sizes):
        b = max(a + 1, int(np.searchsorted(ends, (ends[a - 1] if a else 0) + most, "right")))
        yield a, b
        a = b


def within(sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(owner, place): of the members of things of these sizes, one thing after the other."""
    owner = np.repeat(np.arange(len(sizes)), sizes)
    return owner, np.arange(len(owner)) - np.repeat(np.cumsum(sizes) - sizes, sizes)


def binaries(data: np.ndarray, sizes: np.ndarray) -> pa.Array:
    """One array's values as binary rows of so many values each."""
    ends = np.concatenate([[0], np.cumsum(sizes)]) * data.itemsize
    return pa.Array.from_buffers(pa.binary(), len(sizes), [None, pa.py_buffer(ends.astype(np.int32)), pa.py_buffer(data)])


#: Bytes of a batch that is sent on; a chunk of more goes alone.
BATCH_BYTES = 1 << 20


def rows_of(batch: pa.RecordBatch) -> Iterator[dict]:
    """A batch's rows, binaries as they lie in it."""
    kept = [batch.column(n) if pa.types.is_binary(f.type) or pa.types.is_large_binary(f.type) else batch.column(n).to_pylist() for n, f in zip(batch.schema.names, batch.schema)]
    for row in zip(*kept):
        yield {n: (v.as_buffer() if isinstance(v, (pa.BinaryScalar, pa.LargeBinaryScalar)) else v) for n, v in zip(batch.schema.names, row)}


def gathered(rows: Iterator, size: Callable[..., int], made: Callable[[list], pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows as batches of about BATCH_BYTES: a batch for each small chunk would cost more than the work on it."""
    held, n = [], 0
    for r in rows:
        held.append(r)
        n += size(r)
        if n >= BATCH_BYTES:
            yield made(held)
            held, n = [], 0
    if held:
        yield made(held)

"""Whitening of embeddings by the eigenvectors of their covariance, found by cyclic Jacobi rotations.

* Entries become integers, floor(256 c). The fit list is each distinct vector once, so copies weigh nothing.
* Tasks sum the list, then products of vectors centred on the integers next to its mean. These sums are integers and exact,
  in limbs of 30 bits, so the covariance is the same for any number of tasks and rounded once.
* The driver turns the symmetric matrix (dimension squared, whatever the number of rows) by Jacobi rotations in cyclic order, d / 2 disjoint
  planes at a time, until each off-diagonal entry is below a rounding error of the geometric mean of its diagonal ones. That
  criterion gives small eigenvalues to the same relative accuracy as large ones.
* Eigenvectors over the roots of eigenvalues, by falling eigenvalue, go to the tasks (dimension times components), which whiten every row.

Rows whose vector is null or holds null or non-finite entries are dropped; so are those of another dimension than the commonest
(the least of several), and empty ones. Entries beyond a long's range take its ends; a deviation beyond it is null. Components whose eigenvalue is
zero to rounding can't be whitened and aren't returned, so a list of one vector gives no rows, as does an empty table. Equal
eigenvalues are in the order of the dimensions they come from. Rows that repeat vec_id, and null ones, are whitened each; further columns don't matter.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import map_batches, read_table, shared_folder

SCALE, COMPONENTS = 256, 4
#: Vectors that a task works on at a time, bits of a limb, limbs of a sum.
ROWS, BITS, LIMBS = 4096, 30, 6
EXACT = 1 << 53


def jacobi(matrix: np.ndarray, sweeps: int = 60) -> tuple[np.ndarray, np.ndarray]:
    """(eigenvalues, unit eigenvectors as columns) of a symmetric positive semidefinite matrix, by falling eigenvalue."""
    a = np.array(matrix, np.float64)
    d = len(a)
    v = np.eye(d)
    ring = list(range(d + d % 2))
    for _ in range(sweeps):
        turned = False
        for _ in range(len(ring) - 1):  # every pair once: a round robin of disjoint pairs
            pairs = [(min(x, y), max(x, y)) for x, y in zip(ring[: len(ring) // 2], ring[::-1]) if max(x, y) < d]
            ring = [ring[0], ring[-1], *ring[1:-1]]
            p, q = (np.array(x) for x in zip(*pairs)) if pairs else (np.empty(0, int),) * 2
            apq = a[p, q]
            turn = np.abs(apq) > np.finfo(float).eps * np.sqrt(np.abs(a[p, p] * a[q, q]))
            p, q, apq = p[turn], q[turn], apq[turn]
            if not len(p):
                continue
            turned = True
            theta = (a[q, q] - a[p, p]) / (2 * apq)
            t = np.where(theta >= 0, 1.0, -1.0) / (np.abs(theta) + np.hypot(theta, 1))
            c = 1 / np.hypot(t, 1)
            s = c * t
            for m in (a, v):
                left, right = m[:, p].copy(), m[:, q].copy()
                m[:, p], m[:, q] = c * left - s * right, s * left + c * right
            upper, lower = a[p].copy(), a[q].copy()
            a[p], a[q] = c[:, None] * upper - s[:, None] * lower, s[:, None] * upper + c[:, None] * lower
            a[p, q] = a[q, p] = 0.0
        if not turned:
            break
    order = np.argsort(-np.diag(a), kind="stable")
    return np.diag(a)[order], v[:, order]


def _limbs(value: int) -> list[int]:
    """Limbs of BITS bits, the last with the sign."""
    out = []
    for _ in range(LIMBS - 1):
        out.append(value & ((1 << BITS) - 1))
        value >>= BITS
    return [*out, value]


def _from_limbs(limbs: list[int]) -> int:
    return sum(int(v) << (BITS * k) for k, v in enumerate(limbs))


def _vectors(column: pa.Array, d: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, d)


def _product(y: np.ndarray) -> np.ndarray:
    """y' y of integers, exact: by floats where all sums stay below 2 ** 53, else by Python's integers."""
    most = int(np.abs(y).max(initial=0)) if y.dtype != object else EXACT
    if most * most * len(y) < EXACT:
        f = y.astype(np.float64)
        return (f.T @ f).astype(np.int64).astype(object)
    y = y.astype(object)
    return y.T.dot(y)


class Whitening:
    """The fit of one table's vectors."""

    def __init__(self, table: DataFrame, components: int | None = COMPONENTS):
        self.spark = table.sparkSession
        c = F.col("embedding")
        finite = c.isNotNull() & F.forall(c, lambda e: F.coalesce(~F.isnan(e.cast("double")) & (F.abs(e.cast("double")) < float("inf")), F.lit(False)))
        rows = table.filter(finite).select("vec_id", F.transform(c, lambda e: F.floor(e.cast("double") * SCALE)).alias("x"))
        sizes = rows.groupBy(F.size("x").alias("d")).count().filter("d > 0").orderBy(F.col("count").desc(), "d").limit(1).collect()
        self.d = sizes[0]["d"] if sizes else 0
        self.rows = rows.filter(F.size("x") == self.d) if self.d else rows.filter("false")
        if self.d:
            self._fit(components)

    def _fit(self, components: int | None) -> None:
        folder = f"{shared_folder(self.spark)}/vectors-{uuid.uuid4().hex}"
        self.rows.select("x").distinct().write.parquet(folder)
        self.fit_list = self.spark.read.parquet(folder)
        d = self.d

        def totals(x: np.ndarray) -> list[tuple[int, int, int]]:
            far = np.abs(x.astype(float)).max(initial=0) * len(x) >= EXACT
            return [(0, k, int(v)) for k, v in enumerate((x.astype(object) if far else x).sum(axis=0))] + [(1, 0, len(x))]

        first = self._sums(totals)
        self.n, self.sums = first[1, 0], [first[0, k] for k in range(d)]
        centre = [(2 * s + self.n) // (2 * self.n) for s in self.sums]  # the integer next to the mean
        upper = np.triu_indices(d)

        def products(x: np.ndarray) -> list[tuple[int, int, int]]:
            far = np.abs(x.astype(float)).max(initial=0) + max(map(abs, centre)) >= EXACT
            y = (x.astype(object) if far else x) - np.array(centre, object if far else np.int64)
            p = _product(y)
            sums = y.sum(axis=0)
            return [(2 + i, j, int(p[i, j])) for i, j in zip(*upper)] + [(0, k, int(v)) for k, v in enumerate(sums)]

        second = self._sums(products)
        n, off = self.n, [second[0, k] for k in range(d)]
        covariance = np.zeros((d, d))
        for i, j in zip(*upper):  # exact integers, rounded once
            covariance[i, j] = covariance[j, i] = (n * second[2 + i, j] - off[i] * off[j]) / (n * n)
        self.covariance = covariance
        values, vectors = jacobi(covariance)
        trace = float(np.trace(covariance))
        good = values > np.finfo(float).eps * d * max(values[0], 0.0)
        k = int(good.sum()) if components is None else min(components, int(good.sum()))
        self.values, self.vectors, self.explained = values[:k], vectors[:, :k], values[:k] / trace if k else values[:0]
        self.matrix = self.vectors / np.sqrt(self.values)
        self.mean = np.array([s / self.n for s in self.sums])

    def _sums(self, parts) -> dict[tuple[int, int], int]:
        """The sums over the fit list of (i, j, integer) that ``parts`` makes of some vectors: a row per task and place, added by Spark."""
        d = self.d

        def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            held: dict[tuple[int, int], int] = {}
            for batch in batches:
                x = _vectors(batch.column("x"), d)
                for at in range(0, len(x), ROWS):
                    for i, j, v in parts(x[at : at + ROWS]):
                        held[i, j] = held.get((i, j), 0) + v
            keys = list(held)
            limbs = [_limbs(held[k]) for k in keys]
            columns = [pa.array([k[0] for k in keys], pa.int32()), pa.array([k[1] for k in keys], pa.int32()), *(pa.array([v[m] for v in limbs], pa.int64()) for m in range(LIMBS))]
            yield pa.RecordBatch.from_arrays(columns, ["i", "j", *(f"v{m}" for m in range(LIMBS))])

        found = map_batches(self.fit_list, work, "i int, j int, " + ", ".join(f"v{m} long" for m in range(LIMBS)))
        found = found.groupBy("i", "j").agg(*(F.sum(f"v{m}").alias(f"v{m}") for m in range(LIMBS)))
        return {(r["i"], r["j"]): _from_limbs(r[2:]) for r in found.collect()}  # dimension squared rows

    def whitened(self, x: np.ndarray) -> np.ndarray:
        return (x - self.mean) @ self.matrix

    def identity_error(self) -> float | None:
        """The largest absolute entry of the whitened fit list's covariance minus the identity."""
        d, k, mean, matrix = self.d, len(self.values), self.mean, self.matrix
        if not k:
            return None

        def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            total, products = np.zeros(k), np.zeros((k, k))
            for batch in batches:
                w = (_vectors(batch.column("x"), d) - mean) @ matrix
                total, products = total + w.sum(axis=0), products + w.T @ w
            yield pa.RecordBatch.from_arrays([pa.array(total.tolist() + products.ravel().tolist())], ["v"])

        rows = map_batches(self.fit_list, lambda batches: _numbered(work(batches)), "at int, v double").groupBy("at").agg(F.sum("v").alias("v")).collect()
        sums = np.array([r["v"] for r in sorted(rows, key=lambda r: r["at"])])
        m, products = sums[:k] / self.n, sums[k:].reshape(k, k) / self.n
        return float(np.abs(products - np.outer(m, m) - np.eye(k)).max())

    def apply(self) -> DataFrame:
        """vec_id, deviation and whitened (an entry per component) of every row that is whole."""
        d, n, mean, matrix = self.d, self.n, self.mean, self.matrix
        sums = [int(s) for s in self.sums]
        kind = self.rows.schema["vec_id"].dataType.simpleString()

        def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                x = _vectors(batch.column("x"), d)
                most = int(np.abs(x.astype(float)).max(initial=0)) + 1
                far = n * most + max(map(abs, sums))
                if far * far * d < 1 << 63:
                    away = x * n - np.array(sums, np.int64)
                    deviation = pa.array((away * away).sum(axis=1))
                else:
                    exact = [sum((n * int(v) - s) ** 2 for v, s in zip(row, sums)) for row in x.tolist()]
                    deviation = pa.array([v if v < 1 << 63 else None for v in exact], pa.int64())
                w = (x - mean) @ matrix
                lists = pa.ListArray.from_arrays(pa.array((np.arange(len(x) + 1) * w.shape[1]).astype(np.int32)), pa.array(np.ascontiguousarray(w).ravel()))
                yield pa.RecordBatch.from_arrays([batch.column("vec_id"), deviation, lists], ["vec_id", "deviation", "whitened"])

        return map_batches(self.rows, work, f"vec_id {kind}, deviation long, whitened array<double>")


def _numbered(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(batch.num_rows, dtype=np.int32)), batch.column("v")], ["at", "v"])


def op12_embedding_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    table = read_table(spark, sf_dir, "embeddings")
    fit = Whitening(table)
    columns = "vec_id {}, component int, n long, deviation long, whitened double, explained double, identity_error double".format(table.schema["vec_id"].dataType.simpleString())
    if not fit.d or not len(fit.values):
        return spark.createDataFrame([], columns)
    explained = F.array(*(F.lit(float(v)) for v in fit.explained))
    rows = fit.apply().select("vec_id", "deviation", F.posexplode("whitened").alias("at", "whitened"))
    return rows.select("vec_id", (F.col("at") + 1).alias("component"), F.lit(int(fit.n)).cast("long").alias("n"), "deviation", "whitened", explained[F.col("at")].alias("explained"), F.lit(fit.identity_error()).alias("identity_error"))

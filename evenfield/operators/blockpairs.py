"""Brightness of overlapping tiles on chunk rows: pairs of chunks meet as cropped blocks, never as voxels.

The box of a pair in each tile gives, by division, the chunks that it crosses, and for each chunk of one side those of the other that lie
at the same places: an index of intervals by arithmetic, which reads no data. A chunk is cropped where it was read, once for all
pairs that ask for it, and the two crops of a place meet by one join; what is shuffled are the overlaps, two bytes a voxel and side.

Medians are found by radix selection over the crops (16 bits at once for stored counts, four rounds for corrected values and for
ratios), so no pair's values meet in a task. The driver holds a row per pair.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import shared_folder
from .geometry import AXES
from .pairs import with_floor
from .selection import from_bits, to_bits

_REQUEST = "struct<a:int,b:int,pz:int,py:int,px:int,oz:int,oy:int,ox:int,nz:int,ny:int,nx:int>"
_FOUND = "a int, b int, thr double, n_a long, n_b long, n_overlap long, n_overlap_b long, med_a double, med_b double"
_DRIFT = "a int, b int, n long, ratio_low double, ratio_high double, unstable boolean"


def _cells(rows: DataFrame, c: str, first: str, end: str, size: int) -> DataFrame:
    """``rows`` for each chunk along an axis that first to end crosses."""
    return rows.filter(f"{end} > {first}").withColumn(f"cell_{c}", F.explode(F.expr(f"sequence(cast({first} div {size} as int), cast(({end} - 1) div {size} as int))")))


def matched_requests(ranges_a: DataFrame, ranges_b: DataFrame, size: tuple[int, int, int]) -> DataFrame:
    """(a, b, and of each axis: p, n, cell_a, cell_b): blocks that lie in one chunk of either tile, by their place p in the pair's box."""
    side = lambda rows, s: rows.select("a", "b", *(F.col(f"{m}_{c}").alias(f"{m}_{s}_{c}") for m in ("lo", "hi") for c in AXES))
    rows = side(ranges_a, "a").join(side(ranges_b, "b"), ["a", "b"])
    for c, n in zip(AXES, size[::-1]):
        rows = rows.withColumn("end", F.expr(f"lo_a_{c} + least(hi_a_{c} - lo_a_{c}, hi_b_{c} - lo_b_{c})"))
        rows = _cells(rows, c, f"lo_a_{c}", "end", n).withColumnRenamed(f"cell_{c}", f"cell_a_{c}")
        rows = rows.withColumn("from", F.expr(f"greatest(cell_a_{c} * {n} - lo_a_{c}, 0) + lo_b_{c}")).withColumn("till", F.expr(f"least((cell_a_{c} + 1) * {n}, end) - lo_a_{c} + lo_b_{c}"))
        rows = _cells(rows, c, "from", "till", n).withColumnRenamed(f"cell_{c}", f"cell_b_{c}")
        rows = rows.withColumn(f"p{c}", F.expr(f"greatest(from, cell_b_{c} * {n}) - lo_b_{c}")).withColumn(f"n{c}", F.expr(f"least(till, (cell_b_{c} + 1) * {n}) - lo_b_{c} - p{c}"))
    return rows.drop("end", "from", "till")


def _of_side(requests: DataFrame, side: str, size: tuple[int, int, int]) -> DataFrame:
    """(setup, z0, y0, x0, asked): what is asked of each chunk of one side, at most some blocks for each neighbour of its tile."""
    place = {c: F.col(f"cell_{side}_{c}") * n for c, n in zip(AXES, size[::-1])}
    offset = {c: F.col(f"lo_{side}_{c}") + F.col(f"p{c}") - place[c] for c in AXES}
    asked = F.struct("a", "b", *(F.col(f"p{c}").alias(f"p{c}") for c in "zyx"), *(offset[c].alias(f"o{c}") for c in "zyx"), *(F.col(f"n{c}") for c in "zyx")).cast(_REQUEST)
    return requests.select(F.col(side).alias("setup"), *(place[c].cast("int").alias(f"{c}0") for c in "zyx"), asked.alias("asked")).groupBy("setup", "z0", "y0", "x0").agg(F.collect_list("asked").alias("asked"))


def crops(chunks: DataFrame, asked: DataFrame, dtype: str = "<u2") -> DataFrame:
    """(a, b, pz, py, px, data): the blocks that are asked for, cut from their chunks."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(batch.num_rows):  # a chunk at a time
                (r,) = batch.slice(k, 1).to_pylist()
                block = np.frombuffer(r["data"], dtype).reshape(r["dz"], r["dy"], r["dx"])
                found = [(q, block[q["oz"] : q["oz"] + q["nz"], q["oy"] : q["oy"] + q["ny"], q["ox"] : q["ox"] + q["nx"]].tobytes()) for q in r["asked"]]
                columns = [pa.array([q[c] for q, _ in found], pa.int32()) for c in ("a", "b", "pz", "py", "px")]
                yield pa.RecordBatch.from_arrays([*columns, pa.array([d for _, d in found], pa.binary())], ["a", "b", "pz", "py", "px", "data"])

    rows = chunks.select("setup", "z0", "y0", "x0", "dz", "dy", "dx", "data").join(asked, ["setup", "z0", "y0", "x0"])
    return rows.mapInArrow(work, "a int, b int, pz int, py int, px int, data binary")


class Crops:
    """The crops of a table's pairs, kept in the shared folder, and their statistics.

    Rows are (a, b, thr, va, vb): the bytes of both sides of one block, or of one side alone for the independent form.
    """

    def __init__(self, rows: DataFrame, dtype: str):
        self.spark, self.dtype = rows.sparkSession, dtype
        path = shared_folder(self.spark, "crops")
        rows.write.parquet(path)
        self.rows = self.spark.read.parquet(path)

    def counts(self, kinds: dict[str, int], shift: int, within: dict | None = None, split: dict | None = None) -> DataFrame:
        """(a, b, kind, prefix, bucket, c): counts of values by their leading bits, of those kinds and prefixes that are sought.

        ``kinds`` has each kind's bits: a and b are the voxels above the floor, low and high their ratios on either side of ``split``.
        Where nothing is sought yet, kinds all_a and all_b count all voxels.
        """
        dtype = self.dtype

        def values(a: int, b: int, thr: float, va: np.ndarray | None, vb: np.ndarray | None) -> Iterator[tuple[str, np.ndarray]]:
            fore = np.logical_and.reduce([v > thr for v in (va, vb) if v is not None])
            if "low" in kinds:
                va, vb, cut_at = va[fore].astype(float), vb[fore].astype(float), split.get((a, b))
                ratio = vb / np.maximum(va, 1e-12)
                yield "low", ratio[va <= cut_at] if cut_at is not None else ratio[:0]
                yield "high", ratio[va > cut_at] if cut_at is not None else ratio[:0]
                return
            for kind, v in (("a", va), ("b", vb)):
                if v is not None:
                    yield kind, v[fore]
                    if within is None:
                        yield f"all_{kind}", np.zeros(v.size, np.uint16)

        def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                out: list[tuple] = []
                for k in range(batch.num_rows):
                    (r,) = batch.slice(k, 1).to_pylist()
                    va, vb = (None if r[c] is None else np.frombuffer(r[c], dtype) for c in ("va", "vb"))
                    for kind, v in values(r["a"], r["b"], r["thr"], va, vb):
                        bits = v.astype(np.int64) if v.dtype.itemsize == 2 else to_bits(v)
                        own = 0 if v.dtype.itemsize == 2 else shift
                        prefix = bits >> (own + 16) if own + 16 < 64 else np.zeros_like(bits)
                        if within is not None:
                            sought = within.get((r["a"], r["b"], kind), ())
                            bits, prefix = (x[np.isin(prefix, list(sought))] for x in (bits, prefix))
                        bucket, first, n = np.unique(bits >> own, return_index=True, return_counts=True)
                        out.append((r["a"], r["b"], kind, prefix[first], bucket, n))
                sizes = [len(o[4]) for o in out]
                spread = lambda j, kind: pa.array(np.repeat(np.array([o[j] for o in out]), sizes).tolist() if kind == pa.string() else np.repeat([o[j] for o in out], sizes), kind)
                joined = lambda j: pa.array(np.concatenate([o[j] for o in out]).astype(np.int64) if out else np.empty(0, np.int64))
                yield pa.RecordBatch.from_arrays([spread(0, pa.int32()), spread(1, pa.int32()), spread(2, pa.string()), joined(3), joined(4), joined(5)], ["a", "b", "kind", "prefix", "bucket", "c"])

        rows = self.rows.mapInArrow(work, "a int, b int, kind string, prefix long, bucket long, c long")
        return rows.groupBy("a", "b", "kind", "prefix", "bucket").agg(F.sum("c").alias("c"))

    def medians(self, kinds: dict[str, int], split: dict | None = None) -> tuple[dict, dict]:
        """({(a, b, kind): median}, {(a, b, kind): number of values}), a few rows a pair, to the bit what percentile gives."""
        keys, sizes, targets = ["a", "b", "kind"], {}, {}
        bits = max(kinds.values())
        for shift in range(bits - 16, -1, -16):
            if not targets:
                counts = self.counts(kinds, shift, None, split)
                n = F.sum("c").over(Window.partitionBy(*keys))
                rows = counts.withColumn("n", n).withColumn("which", F.explode(F.array(F.lit(0), F.lit(1)))).withColumn("left", F.expr("if(which = 0, (n - 1) div 2, n div 2)"))
            else:
                within: dict[tuple, set] = {}
                for (a, b, kind, _), (prefix, _) in targets.items():
                    within.setdefault((a, b, kind), set()).add(prefix)
                table = pd.DataFrame([(*k, *v, sizes[k[:3]]) for k, v in targets.items()], columns=[*keys, "which", "prefix", "left", "n"])
                sought = self.spark.createDataFrame(table, "a int, b int, kind string, which int, prefix long, left long, n long")
                rows = self.counts(kinds, shift, within, split).join(F.broadcast(sought), [*keys, "prefix"])  # two rows a pair and kind
            rows = rows.withColumn("up_to", F.sum("c").over(Window.partitionBy(*keys, "which").orderBy("bucket")))
            picked = rows.filter("up_to > left and up_to - c <= left").selectExpr(*keys, "which", "bucket", "left - up_to + c as left", "n").collect()
            targets = {(r["a"], r["b"], r["kind"], r["which"]): (r["bucket"], r["left"]) for r in picked}
            sizes |= {(r["a"], r["b"], r["kind"]): r["n"] for r in picked}  # of all kinds by the first round
        value = lambda kind, bucket: float(bucket) if kinds.get(kind, 16) == 16 else float(from_bits(np.array([bucket]))[0])
        both = {k: [value(k[2], targets[*k, w][0]) for w in (0, 1)] for k in sizes if k[2] in kinds}
        return {k: v[0] if v[0] == v[1] else 0.5 * v[0] + 0.5 * v[1] for k, v in both.items()}, sizes

    def brightness(self) -> tuple[dict, dict]:
        bits = 16 if self.dtype == "<u2" else 64
        if not hasattr(self, "_brightness"):
            self._brightness = self.medians({"a": bits, "b": bits})
        return self._brightness

    def found(self) -> DataFrame:
        """What ``pairs.intersection`` and ``pairs.independent`` give, from what the crops hold."""
        med, n = self.brightness()
        thr = {(r["a"], r["b"]): r["thr"] for r in self.rows.select("a", "b", "thr").distinct().collect()}  # a row per pair
        rows = [(a, b, t, n.get((a, b, "a"), 0), n.get((a, b, "b"), 0), n[a, b, "all_a"], n[a, b, "all_b"], med.get((a, b, "a")), med.get((a, b, "b"))) for (a, b), t in sorted(thr.items()) if (a, b, "all_a") in n and (a, b, "all_b") in n]
        return self.spark.createDataFrame(rows, _FOUND)

    def drift(self, tolerance: float = 0.15) -> DataFrame:
        """What ``pairs.drift`` gives, from the same crops."""
        med, n = self.brightness()
        split = {(a, b): v for (a, b, kind), v in med.items() if kind == "a"}
        ratio, sizes = self.medians({"low": 64, "high": 64}, split)
        rows = []
        for a, b in sorted(split):
            low, high = (ratio.get((a, b, k)) for k in ("low", "high"))
            enough = n[a, b, "a"] >= 128 and all(sizes.get((a, b, k), 0) >= 32 for k in ("low", "high"))
            rows.append((a, b, n[a, b, "a"], low, high, bool(enough and low > 0 and abs(high / low - 1) > tolerance)))
        return self.spark.createDataFrame(rows, _DRIFT)


def matched(chunks: DataFrame, ranges_a: DataFrame, ranges_b: DataFrame, thresholds: DataFrame, size: tuple[int, int, int], dtype: str = "<u2") -> Crops:
    """Crops of the places that both sides of a pair have; ``size`` is that of whole chunks (z, y, x)."""
    requests = matched_requests(ranges_a, ranges_b, size)
    a, b = (crops(chunks, _of_side(requests, s, size), dtype).withColumnRenamed("data", f"v{s}") for s in "ab")
    return Crops(with_floor(a.join(b, ["a", "b", "pz", "py", "px"]), thresholds).select("a", "b", "thr", "va", "vb"), dtype)


def alone(chunks: DataFrame, ranges_a: DataFrame, ranges_b: DataFrame, thresholds: DataFrame, size: tuple[int, int, int], dtype: str = "<u2") -> Crops:
    """Crops of each side's own voxels in a pair's box; nothing is joined."""
    sides = []
    for s, ranges in (("a", ranges_a), ("b", ranges_b)):
        requests = ranges.select("a", "b", *(F.col(f"{m}_{c}").alias(f"{m}_{s}_{c}") for m in ("lo", "hi") for c in AXES))
        for c, n in zip(AXES, size[::-1]):
            requests = _cells(requests, c, f"lo_{s}_{c}", f"hi_{s}_{c}", n).withColumnRenamed(f"cell_{c}", f"cell_{s}_{c}")
            requests = requests.withColumn(f"p{c}", F.expr(f"greatest(cell_{s}_{c} * {n} - lo_{s}_{c}, 0)")).withColumn(f"n{c}", F.expr(f"least((cell_{s}_{c} + 1) * {n}, hi_{s}_{c}) - lo_{s}_{c} - p{c}"))
        data = {t: F.col("data") if t == s else F.lit(None).cast("binary") for t in "ab"}
        sides.append(crops(chunks, _of_side(requests, s, size), dtype).select("a", "b", data["a"].alias("va"), data["b"].alias("vb")))
    return Crops(with_floor(sides[0].unionByName(sides[1]), thresholds).select("a", "b", "thr", "va", "vb"), dtype)

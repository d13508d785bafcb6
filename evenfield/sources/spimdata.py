"""Geometry files (SpimData XML) as rows."""

from __future__ import annotations

import re
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from . import files

SETUP = "id int, size string, voxelSize struct<unit: string, size: string>"
REGISTRATION = "_timepoint string, _setup int, ViewTransform array<struct<_type: string, affine: string>>"
MICROMETRES = ("um", "µm", "μm", "micrometer", "micrometre", "micron")


def _numbers(text: Column) -> Column:
    return F.transform(F.split(F.trim(text), r"\s+"), lambda s: s.cast("double"))


def setups(spark: SparkSession, path: str) -> DataFrame:
    """(setup, size_x, size_y, size_z, um_z, um_y, um_x): voxel sizes are null where missing or in another unit."""
    rows = spark.read.schema(SETUP).option("rowTag", "ViewSetup").xml(path)
    size, voxel = _numbers(F.col("size")), _numbers(F.col("voxelSize.size"))
    known = F.lower(F.trim(F.coalesce("voxelSize.unit", F.lit("um")))).isin(*MICROMETRES)
    names = dict(zip("xyz", range(3)))
    return rows.select(F.col("id").alias("setup"), *(F.get(size, F.lit(k)).cast("int").alias(f"size_{c}") for c, k in names.items()), *(F.when(known, F.get(voxel, F.lit(names[c]))).alias(f"um_{c}") for c in "zyx"))


def registrations(spark: SparkSession, path: str) -> DataFrame:
    """(setup, affine): each setup's affine transforms at timepoint 0 composed, the last listed acting first."""
    rows = spark.read.schema(REGISTRATION).option("rowTag", "ViewRegistration").xml(path).filter("_timepoint = '0'")
    listed = F.transform(F.filter("ViewTransform", lambda t: t["_type"] == "affine"), lambda t: _numbers(t["affine"]))
    one = F.array(*(F.lit(float(i == j)) for i in range(3) for j in range(4)))

    def after(m: Column, a: Column) -> Column:
        cell = lambda r, c: sum((F.get(m, F.lit(4 * r + k)) * F.get(a, F.lit(4 * k + c)) for k in range(3)), F.get(m, F.lit(4 * r + 3)) if c == 3 else F.lit(0.0))
        return F.array(*(cell(r, c) for r in range(3) for c in range(4)))

    return rows.select(F.col("_setup").alias("setup"), F.aggregate(listed, one, after).alias("affine"))


def tiles(spark: SparkSession, path: str) -> DataFrame:
    """(setup, size_*, affine) as the geometry operators take them."""
    return setups(spark, path).select("setup", "size_x", "size_y", "size_z").join(registrations(spark, path), "setup")


def sync_translations(main: str | Path, subset: str | Path, pairs: dict[int, int]) -> str:
    """The text of ``subset`` with the translations of its setups' calibrated affines taken from ``main``'s setups."""
    pattern = lambda setup: re.compile(rf'(<ViewRegistration[^>]*setup="{setup}"[^>]*>.*?<affine>)([^<]*)(</affine>.*?</ViewRegistration>)', re.S)
    source, out = files.read(main).decode(), files.read(subset).decode()
    for own, other in pairs.items():
        found = pattern(other).search(source)
        if not found:
            raise ValueError(f"{main} has no registration of setup {other}")
        moved = found[2].split()

        def put(m: re.Match, moved=moved) -> str:
            now = m[2].split()
            for k in (3, 7, 11):
                now[k] = moved[k]
            return m[1] + " ".join(now) + m[3]

        out, n = pattern(own).subn(put, out, count=1)
        if not n:
            raise ValueError(f"{subset} has no registration of setup {own}")
    return out

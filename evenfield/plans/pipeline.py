"""The stages of illumination correction as one program: each stage's result is a table in the results folder.

Stages read what earlier ones wrote, so a run can begin or stop at any of them; tables are versioned (``tables``), and
emptiness, which is dear and always the same, isn't measured again if its table is there.
"""

from __future__ import annotations

import json
import warnings
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..config import Settings
from ..functions.columns import basic_corrected
from ..operators import correct as correcting
from ..operators import blockpairs, blocks, blockstats, emptiness, gains, geometry, levels, orderstats, pairs, thresholds, tilestats, unmix
from ..sources import files, spimdata, stores, tiff
from . import flatfield
from .tables import Tables

EMPTY_NAME = "Empty-fraction"
# Fixed value: where older result folders have a camera's empty part.
OLD_EMPTY = "basic_empty_fraction_camera{camera}.tif"
PIPELINES = {
    "basic": ("emptiness", "stats", "qstack", "basic", "correct"),
    "intensity": ("emptiness", "int-stats", "int-aggregate", "correct"),
    "both": ("emptiness", "stats", "qstack", "basic", "int-stats", "int-aggregate", "correct"),
}


def plan(pipeline: str, start_at: str | None = None, stop_after: str | None = None) -> list[str]:
    if pipeline not in PIPELINES:
        raise ValueError(f"pipeline {pipeline!r} is none of {tuple(PIPELINES)}")
    stages = PIPELINES[pipeline]
    for name in (start_at, stop_after):
        if name and name not in stages:
            raise ValueError(f"{name!r} is no stage of {pipeline}: {stages}")
    first = stages.index(start_at) if start_at else 0
    last = stages.index(stop_after) + 1 if stop_after else len(stages)
    if first >= last:
        raise ValueError(f"{start_at} comes after {stop_after}")
    return list(stages[first:last])


def resolve_mode(requested: str, has_fields: bool, has_target: bool) -> str:
    """Which corrections a run applies, from what there is."""
    if requested == "auto":
        found = {(True, True): "both", (True, False): "basic", (False, True): "intensity"}.get((has_fields, has_target))
        if not found:
            raise RuntimeError("there is nothing to correct with: neither fields nor targets")
        return found
    if requested not in ("basic", "intensity", "both"):
        raise ValueError(f"mode {requested!r} is none of auto, basic, intensity, both")
    if requested != "intensity" and not has_fields:
        raise RuntimeError(f"mode {requested} needs fields; run basic first")
    if requested != "basic" and not has_target:
        raise RuntimeError(f"mode {requested} needs targets; run int-aggregate first")
    return requested


class Run:
    """One dataset's stages. ``voxels`` gives its voxels; without it they are read from the settings' store.

    ``only_cameras`` and ``only_setups`` restrict a run to a part of the dataset; its rows replace those of the same part in
    the tables, where the others stay. Single setups are for the stages that treat each by itself.
    """

    def __init__(self, spark: SparkSession, settings: Settings, apply_basic: bool = False, voxels: Callable[[], DataFrame] | None = None, tiles: DataFrame | None = None, only_cameras: list[int] | None = None, only_setups: list[int] | None = None):
        self.spark, self.settings, self.apply_basic = spark, settings, apply_basic
        self.tables = Tables(spark, settings.results_root)
        self._voxels, self._tiles = voxels, tiles
        rows = [(s, c) for c, group in enumerate(settings.cameras) for s in group]
        known = {"cameras": {c for _, c in rows}, "setups": {s for s, _ in rows}}
        for name, asked in (("cameras", only_cameras), ("setups", only_setups)):
            if unknown := set(asked or ()) - known[name]:
                raise ValueError(f"{name} {sorted(unknown)} aren't in the settings")
        self.partial, self.single = only_cameras is not None or only_setups is not None, only_setups is not None
        rows = [(s, c) for s, c in rows if (only_cameras is None or c in only_cameras) and (only_setups is None or s in only_setups)]
        if not rows:
            raise ValueError("no setup is left to run on")
        self.setups = [s for s, _ in rows]
        self.cameras = spark.createDataFrame(rows, "setup int, camera int")

    # ------------------------------------------------------------- tables

    def has(self, name: str) -> bool:
        return self.tables.has(name)

    def read(self, name: str) -> DataFrame:
        if not self.has(name):
            raise RuntimeError(f"{self.tables.path(name)} isn't there; run the stage that writes it first")
        return self.tables.read(name)

    def keep(self, name: str, rows: DataFrame) -> DataFrame:
        """Writes a table and reads it again; a part's run replaces the part's rows and reads those only."""
        key = next((k for k in ("setup", "camera") if k in rows.columns), None)
        if not (self.partial and key):
            return self.tables.commit(name, lambda _: rows)

        def replaced(before: DataFrame | None) -> DataFrame:
            if before is None:
                return rows
            others = before.join(F.broadcast(self.cameras.select(key).distinct()), key, "left_anti")  # a row per setup
            return rows.unionByName(others, allowMissingColumns=True)

        return self.mine(self.tables.commit(name, replaced))

    def mine(self, rows: DataFrame) -> DataFrame:
        """The rows of the part of the dataset that this run is for."""
        if not self.partial:
            return rows
        key = "setup" if "setup" in rows.columns else "camera"
        return rows.join(F.broadcast(self.cameras.select(key).distinct()), key, "left_semi")  # a row per setup

    def voxels(self, level: int = 0) -> DataFrame:
        if self._voxels is not None:
            return self.mine(self._voxels())
        s = self.settings
        return stores.to_voxels(stores.chunks(self.spark, s.input_path, s.input_format, self.setups, level), self.cameras)

    def chunks(self, level: int = 0) -> DataFrame | None:
        """The stored chunks of a level, where voxels come from a store of whole levels; bulk stages work on these."""
        s = self.settings
        if self._voxels is not None or level >= len(stores.pyramid_shapes(s.input_path, s.input_format, s.setups[0])):
            return None
        return stores.chunks(self.spark, s.input_path, s.input_format, self.setups, level)

    def at_level(self, level: int) -> tuple[DataFrame, tuple[int, int, int]]:
        """The voxels of a level and its (z, y, x) factors: the stored level, or level 0 averaged in the plane by powers of two."""
        if not level:
            return self.voxels(), (1, 1, 1)
        s = self.settings
        if self._voxels is None:
            shapes = stores.pyramid_shapes(s.input_path, s.input_format, s.setups[0])
            if level < len(shapes):
                return self.voxels(level), tuple(max(round(a / b), 1) for a, b in zip(shapes[0], shapes[level]))
        return levels.downsample(self.voxels(), 1, 2**level, 2**level), (1, 2**level, 2**level)

    def frame(self, level: int = 0) -> tuple[int, int]:
        """(ny, nx) of a level, from a store's metadata where there is one."""
        s = self.settings
        if self._voxels is None:
            shapes = [shape[1:] for shape in stores.pyramid_shapes(s.input_path, s.input_format, self.setups[0])]
            if level < len(shapes):
                return shapes[level]
            full = shapes[0]
        else:
            full = self.voxels().filter("z = 0").agg(F.max("y") + 1, F.max("x") + 1).first()
        return tuple(-(-n // 2**level) for n in full)

    def coarse_level(self) -> int:
        """The level that emptiness is measured at: the coarsest stored one whose frame is wide enough."""
        s = self.settings
        return 0 if self._voxels is not None else levels.coarsest_level(stores.pyramid_shapes(s.input_path, s.input_format, s.setups[0]))

    def tiles(self) -> DataFrame:
        return self._tiles if self._tiles is not None else spimdata.tiles(self.spark, self.settings.dataset_xml)

    def seen(self) -> tuple[DataFrame, tuple[int, int, int]]:
        """The voxels as the intensity stages see them, at their level, corrected by the fields if these are applied."""
        rows, factors = self.at_level(self.settings.stats_scale)
        if not self.apply_basic:
            return rows, factors
        fields = correcting.floored(self.read("fields"), self.settings.flat_floor)
        if factors[1:] != (1, 1):
            fields = levels.block_mean(fields, factors[1], factors[2], "flat", "dark")
        rows = rows.join(fields, ["camera", "y", "x"])
        return rows.select("camera", "setup", "z", "y", "x", basic_corrected(F.col("v").cast("double"), F.col("flat"), F.col("dark")).alias("v")), factors

    def seen_chunks(self) -> tuple[DataFrame, tuple[int, int, int], str] | None:
        """What ``seen`` gives as chunk rows, their size and kind, where voxels come from a store of chunks of one size."""
        s = self.settings
        rows = self.chunks(s.stats_scale)
        sizes = {found.zyx(found.chunk) for found in (stores.layout(s.input_path, s.input_format, k, s.stats_scale) for k in self.setups)} if rows is not None else set()
        if len(sizes) != 1:
            return None
        size = sizes.pop()
        if not self.apply_basic:
            return rows, size, "<u2"
        shapes = stores.pyramid_shapes(s.input_path, s.input_format, s.setups[0])
        fields = correcting.floored(self.read("fields"), s.flat_floor)
        factors = tuple(max(round(a / b), 1) for a, b in zip(shapes[0], shapes[s.stats_scale]))
        if factors[1:] != (1, 1):
            fields = levels.block_mean(fields, factors[1], factors[2], "flat", "dark")
        return blocks.corrected_reals(rows, self.cameras, fields, size[1:]), size, "<f8"

    # ------------------------------------------------------------- stages

    def emptiness(self) -> None:
        basis = self.empty_basis()
        if not self.partial and self.has("empty_tiles") and self.has("empty_pixels"):
            if not self.has("empty_basis") or self.read("empty_basis").first()["basis"] == basis:
                return
            warnings.warn("emptiness was measured with other settings; it is measured again", stacklevel=2)
        s, level = self.settings, self.coarse_level()
        mode = "otsu" if s.tile_threshold == "pooled" else s.tile_threshold
        if (stored := self.chunks(level)) is not None:
            limits = self.keep("empty_threshold", blockstats.pooled(stored, self.cameras, mode, s.otsu_sample_voxels))
            cols = emptiness.judged(blockstats.column_sums(stored, self.cameras, limits), s.empty_occupancy_floor)
        else:
            voxels = self.at_level(level)[0]
            limits = self.keep("empty_threshold", thresholds.pooled(voxels, mode, s.otsu_sample_voxels))
            cols = emptiness.columns(voxels, limits, s.empty_occupancy_floor)
        self.keep("empty_tiles", emptiness.by_tile(cols))
        pixels = self.keep("empty_pixels", emptiness.by_pixel(cols))
        self.keep("background", emptiness.background_level(pixels, s.background_percentile))
        self.keep("empty_basis", self.spark.createDataFrame([(basis,)], "basis string"))

    def empty_basis(self) -> str:
        """What the measured emptiness depends on, so that a change of it is seen."""
        names = ("input_path", "input_format", "tile_threshold", "empty_occupancy_floor", "otsu_sample_voxels", "background_percentile")
        return json.dumps({n: getattr(self.settings, n) for n in names} | {"cameras": self.settings.cameras})

    def warn_of_sizes(self) -> None:
        """Setups of a camera are cropped to the smallest; that is told."""
        s = self.settings
        if self._voxels is not None:
            return
        for camera, group in enumerate(s.cameras):
            sizes = {stores.size_zyx(s.input_path, s.input_format, k, s.basic_stats_level) for k in group if k in self.setups}
            if len(sizes) > 1:
                warnings.warn(f"camera {camera}'s setups differ in size {sorted(sizes)}; the smallest counts", stacklevel=3)

    def stats(self) -> None:
        level = self.settings.basic_stats_level
        self.warn_of_sizes()
        stored = self.chunks(level)
        fits = blocks.fit(stored, self.cameras) if stored is not None else orderstats.fit(self.at_level(level)[0])
        fits = self.keep("column_fits", fits)
        merged = orderstats.merge(fits)
        self.keep("column_stats", orderstats.quantile_planes(merged, "camera", "y", "x"))
        self.keep("column_extrema", merged.select("camera", "y", "x", "vmin", "vmax", "n"))
        if self.has("empty_threshold"):
            self.keep("background_profile", orderstats.background_profile(fits, self.read("empty_threshold")))

    def qstack(self) -> None:
        planes = self.mine(self.read("column_stats"))
        if self.settings.basic_unmix_empty:
            profile = self.read("background_profile") if self.has("background_profile") else self.read("background")
            stack = unmix.unmix(planes, self._in_frame(self.read("empty_pixels"), planes), profile)
        else:
            stack = planes.select("camera", "plane", "y", "x", F.col("v").cast("double").alias("v"))
        voxels = self.at_level(self.settings.basic_stats_level)[0]
        few = [r["camera"] for r in unmix.shallow_cameras(self.last_planes(voxels)).collect()]  # a row per camera
        if few:
            shallow = orderstats.raw_stack(voxels.filter(F.col("camera").isin(few)))
            stack = stack.unionByName(shallow.withColumn("v", F.col("v").cast("double")))
        self.keep("qstack", stack)

    def last_planes(self, voxels: DataFrame) -> DataFrame:
        """(camera, setup, z) of each setup's last plane: from a store's metadata, or else from ``voxels``."""
        s, level = self.settings, self.settings.basic_stats_level
        if self.chunks(level) is None:
            return voxels
        depth = self.spark.createDataFrame([(k, stores.size_zyx(s.input_path, s.input_format, k, level)[0] - 1) for k in self.setups], "setup int, z int")
        return self.cameras.join(depth, "setup")

    def _in_frame(self, pixels: DataFrame, planes: DataFrame) -> DataFrame:
        """The empty part of each pixel, resized from the frame it was measured in to that of the planes."""
        frame = lambda rows: tuple(rows.agg(F.max("y") + 1, F.max("x") + 1).first())
        own, wanted = frame(pixels), frame(planes)
        if (own[0] > own[1]) != (wanted[0] > wanted[1]):  # its sizes are a level's, so only the aspect can tell
            warnings.warn(f"the empty part's frame {own} lies across the planes' {wanted} and is turned", stacklevel=3)
            turned = {"y": "x", "x": "y"}
            pixels, own = pixels.select(*(F.col(c).alias(turned.get(c, c)) for c in pixels.columns)), own[::-1]
        return pixels if own == wanted else levels.resize(pixels.select("camera", "y", "x", "phi"), own, wanted, "phi")

    def basic(self) -> None:
        s = self.settings
        darks = self.measured_darks() if s.basic.override_darkfield is True else None
        factors = self.at_level(s.basic_stats_level)[1]
        stack, params = self.mine(self.read("qstack")), s.basic.params()
        frame, expected = tuple(stack.agg(F.max("y") + 1, F.max("x") + 1).first()), self.frame(s.basic_stats_level)
        if frame != expected:
            warnings.warn(f"the stack's frame is {frame}, the data's {expected}: it may be of an earlier run", stacklevel=2)
        lams = self.tuned(stack, params) if s.basic.autotune and not params.lam else None
        fields = flatfield.fit_cameras(stack, params, darks=darks, lams=lams)
        if factors[1:] != (1, 1):  # fitted on a coarse level: brought to the full frame
            fields = self.keep("fields_coarse", fields)
            full = self.frame()
            own = tuple(fields.agg(F.max("y") + 1, F.max("x") + 1).first())
            flat, dark = (levels.resize(fields.select("camera", "y", "x", c), own, full, c) for c in ("flat", "dark"))
            fields = flat.join(dark, ["camera", "y", "x"])
        fields = self.keep("fields", fields)
        if self.has("background"):
            self.keep("dark_check", flatfield.collapsed_dark(fields, self.read("background")))

    def tuned(self, stack: DataFrame, params: flatfield.FitParams) -> dict[int, float]:
        """Each camera's tuned penalty, kept as a table; one at an edge of the grid is told, as a better one may lie beyond."""
        found = self.keep("penalties", flatfield.tune_cameras(stack, params)).collect()  # a row per camera
        for r in found:
            if r["multiplier"] in (min(flatfield.FINE), max(flatfield.FINE)):
                warnings.warn(f"camera {r['camera']}'s penalty is at the edge of the grid: {r['multiplier']:g} times the default", stacklevel=3)
        return {r["camera"]: r["lam"] for r in found}

    def measured_darks(self) -> dict[int, float]:
        """Each camera's own measured background level, which overrides its dark field."""
        levels_of = {r["camera"]: r["level"] for r in self.read("background").collect()} if self.has("background") else {}  # a row per camera
        wanted = [r["camera"] for r in self.cameras.select("camera").distinct().collect()]
        missing = sorted(c for c in wanted if levels_of.get(c) is None)
        if missing:
            raise ValueError(f"override_darkfield needs a measured background of cameras {missing}; run emptiness first, or give a number")
        return {c: float(levels_of[c]) for c in wanted}

    def refresh_tile_stats(self) -> list[int]:
        """Tile statistics anew of the setups of which a stored file was added, changed or removed since the last time; the others' stay.

        Files are told apart by hashes of what they hold, which are kept as a table. Returns the setups that were measured.
        """
        s, keys = self.settings, ["setup", "level", "file", "sha256"]
        now = self.keep("tile_stats_files_now", stores.fingerprints(self.spark, s.input_path, s.input_format, self.setups, s.stats_scale))
        changed = set(self.setups)
        if self.has("tile_stats_files") and self.has("tile_stats"):
            before = self.mine(self.read("tile_stats_files"))
            moved = now.join(before, keys, "left_anti").select("setup").unionByName(before.join(now, keys, "left_anti").select("setup"))
            measured = {r["setup"] for r in self.mine(self.read("tile_stats")).select("setup").distinct().collect()}  # a row per setup
            changed = {r["setup"] for r in moved.distinct().collect()} | (set(self.setups) - measured)
        if changed:
            Run(self.spark, s, self.apply_basic, self._voxels, self._tiles, only_setups=sorted(changed)).int_stats()
            self.keep("tile_stats_files", now)
        return sorted(changed)

    def int_stats(self) -> None:
        s = self.settings
        stored, kind = self.chunks(s.stats_scale), "<u2"
        if stored is not None and self.apply_basic:
            stored, _, kind = self.seen_chunks() or (None, None, None)
        if stored is not None:
            counted = self.keep("tile_counts", blockstats.counts(stored, kind))  # one reading for thresholds and, of counts, for moments
            counts = counted.filter("not binned").select("setup", F.col("v").cast("int").alias("v"), "n")
            bins = counted.filter("binned").drop("binned")
        else:
            voxels = self.seen()[0]
            counts, bins = thresholds.histogram(voxels, "setup"), thresholds.binned(voxels, "setup") if self.apply_basic else None
        bins = bins if self.apply_basic else None  # corrected values are no counts
        found = self.keep("thresholds", thresholds.catalogue(counts, "setup", bins=bins))
        if s.tile_threshold == "pooled":
            own = self.cameras.join(self.read("empty_threshold"), "camera").select("setup", "threshold")
        elif isinstance(s.tile_threshold, str):
            own = found.select("setup", F.col(s.tile_threshold).alias("threshold"))
        else:
            own = self.cameras.select("setup", F.lit(float(s.tile_threshold)).alias("threshold"))
        if stored is None:
            measured = tilestats.moments(voxels, own)
        else:
            measured = blockstats.moments(stored, own, kind) if self.apply_basic else tilestats.moments_of_counts(counts, own)
        self.keep("tile_stats", measured.withColumn("apply_basic", F.lit(self.apply_basic)))

    def int_aggregate(self) -> None:
        s = self.settings
        stats = self.read("tile_stats")
        self.same_basis(stats)
        tiles = self.keep("tiles", tilestats.classified(stats, self.read("empty_tiles"), s.limits))
        boxes = geometry.world_boxes(self.tiles())
        usable = tiles.filter("kind != 'empty'").select("setup")
        found = self.keep("pairs", pairs.usable_pairs(geometry.overlap_pairs(boxes), usable))
        floor = "tile" if s.gain_floor == "threshold" else s.gain_floor
        floors = pairs.floors(stats.select("setup", "threshold").join(self.read("thresholds"), "setup"), floor)
        voxels, factors = self.seen()
        sides = [geometry.pixel_ranges(found, self.tiles(), side, factors[::-1]) for side in "ab"]
        matched = s.gain_estimator == "intersection"
        if (seen := self.seen_chunks()) is not None:
            crops = (blockpairs.matched if matched else blockpairs.alone)(seen[0], *sides, floors, *seen[1:])
            found, drift = crops.found(), crops.drift if matched else None
        else:
            found = (pairs.intersection if matched else pairs.independent)(voxels, *sides, floors)
            drift = (lambda: pairs.drift(voxels, *sides, floors)) if matched else None
        measured = self.keep("pair_medians", pairs.gated(found, s.min_overlap_foreground, s.min_overlap_fraction))
        if drift:
            self.keep("pair_drift", drift())
        groups = self.cameras.select("setup", F.col("camera" if s.gain_grouping == "camera" else "setup").alias("grp"))
        solved = self.keep("gains", gains.solve(pairs.constraints(measured), groups, s.penalty))
        self.keep("gain_summary", gains.camera_summary(solved, self.cameras))
        self.keep("targets", gains.targets(tiles, solved))

    def same_basis(self, stats: DataFrame) -> None:
        """Statistics of corrected voxels aren't mixed with raw ones."""
        if stats.filter(F.coalesce("apply_basic", F.lit(False)) != self.apply_basic).limit(1).count():
            raise RuntimeError(f"tile statistics were made with apply_basic = {not self.apply_basic}; run int-stats again")

    def corrected(self, mode: str = "auto") -> DataFrame:
        mode = resolve_mode(mode, self.has("fields"), self.has("targets"))
        fields = self.read("fields") if mode != "intensity" else None
        tiles = correcting.rescaling(self.read("targets"), self.settings.max_gain_scale) if mode != "basic" else None
        return correcting.correct(self.voxels(), fields, tiles)

    def correct(self, mode: str = "auto") -> None:
        """The corrected voxels, written to the settings' output store with its pyramid, or as a table without one."""
        s = self.settings
        if s.output_path and s.out_format != "tiff" and self.chunks() is not None:
            self._correct_chunks(mode)
            return
        rows = self.corrected(mode)
        if not s.output_path:
            self.keep("corrected", rows)
            return
        rows = self.keep("corrected", rows)
        sizes = {r["setup"]: (r["z"], r["y"], r["x"]) for r in rows.groupBy("setup").agg(*((F.max(c) + 1).alias(c) for c in "zyx")).collect()}  # a row per setup
        if s.out_format == "tiff":
            self._write_tiffs(rows, sizes)
            return
        chunk, shard = s.chunk_size[::-1], s.shard_size[::-1]
        shapes = {k: stores.pyramid_shapes(s.input_path, s.input_format, k) if s.input_path else [v] for k, v in sizes.items()}
        deepest = max(map(len, shapes.values()))
        for level in range(deepest):
            own = {k: v[level] for k, v in shapes.items() if level < len(v)}
            factors = {k: tuple(max(round(a / b), 1) for a, b in zip(shapes[k][0], v)) for k, v in own.items()}
            for f in set(factors.values()):
                part = [k for k in own if factors[k] == f]
                small = rows.filter(F.col("setup").isin(part))
                small = levels.downsample(small, *f) if f != (1, 1, 1) else small
                stores.write(stores.to_chunks(small, chunk, level), s.output_path, s.out_format, {k: own[k] for k in part}, chunk, shard, level)
        for k, found in shapes.items():
            stores.write_group(s.output_path, s.out_format, k, [tuple(max(round(a / b), 1) for a, b in zip(found[0], v)) for v in found])

    def _correct_chunks(self, mode: str) -> None:
        """Store to store without long rows. The corrected chunks are kept as a table; all coarse levels come from one reading of it,
        and chunks that don't fit the output's are cut anew."""
        s = self.settings
        shapes = {k: stores.pyramid_shapes(s.input_path, s.input_format, k) for k in self.setups}
        sizes = self.spark.createDataFrame([(k, *map(int, v[0])) for k, v in shapes.items()], "setup int, nz int, ny int, nx int")
        chunk, shard = s.chunk_size[::-1], s.shard_size[::-1]
        stored = {f.zyx(f.chunk) for f in (stores.layout(s.input_path, s.input_format, k) for k in self.setups)}
        own = stored.pop() if len(stored) == 1 else chunk
        rows = self.chunks() if not stored else blocks.pyramid(self.chunks(), sizes, {0: (1, 1, 1)}, chunk)
        mode = resolve_mode(mode, self.has("fields"), self.has("targets"))
        fields = self.read("fields") if mode != "intensity" else None
        tiles = correcting.rescaling(self.read("targets"), s.max_gain_scale) if mode != "basic" else None
        rows = self.keep("corrected_chunks", blocks.correct(rows, self.cameras, fields, tiles, own[1:]))
        factors = {k: tuple(tuple(max(round(a / b), 1) for a, b in zip(v[0], x)) for x in v) for k, v in shapes.items()}
        for steps in sorted(set(factors.values())):  # setups of equal factors together; most often all
            part = [k for k in self.setups if factors[k] == steps]
            base = rows.filter(F.col("setup").isin(part))
            asked = {level: three for level, three in enumerate(steps) if level or any(c % o for c, o in zip(chunk, own))}
            cut = self.keep("corrected_levels", blocks.pyramid(base, sizes, asked, chunk)) if asked else None
            for level in range(len(steps)):
                found = cut.filter(F.col("level") == level) if level in asked else base
                stores.write(found, s.output_path, s.out_format, {k: shapes[k][level] for k in part}, chunk, shard, level)
            for k in part:
                stores.write_group(s.output_path, s.out_format, k, list(steps))

    def _write_tiffs(self, rows: DataFrame, sizes: dict[int, tuple[int, int, int]]) -> None:
        s, um = self.settings, {}
        if s.dataset_xml and files.exists(s.dataset_xml):
            um = {r["setup"]: (r["um_z"], r["um_y"], r["um_x"]) for r in spimdata.setups(self.spark, s.dataset_xml).collect() if r["um_x"] is not None}
        tiff.write_tiles(stores.to_chunks(rows, (1, 1 << 20, 1 << 20)), s.output_path, sizes, um, s.tiff_compression)

    def export(self, folder: str) -> None:
        """The small results as files: each camera's fields and empty part as TIFF planes, gains and targets as JSON."""
        import numpy as np

        names = {v: ("fields", name) for v, name in tiff.FIELDS.items()} | {"phi": ("empty_pixels", EMPTY_NAME)}
        for value, (table, name) in names.items():
            if not self.has(table):
                continue
            for camera in range(len(self.settings.cameras)):  # a camera's plane at a time
                rows = self.read(table).filter(F.col("camera") == camera).select("y", "x", value).toPandas()
                if len(rows):
                    plane = np.zeros((rows["y"].max() + 1, rows["x"].max() + 1), np.float32)
                    plane[rows["y"], rows["x"]] = rows[value]
                    tiff.write_plane(f"{folder}/camera{camera + 1}/{name}.tif", plane)
        if self.has("qstack"):
            for camera in range(len(self.settings.cameras)):
                rows = self.read("qstack").filter(F.col("camera") == camera).toPandas()
                if len(rows):
                    stack = np.zeros([rows[c].max() + 1 for c in ("plane", "y", "x")], np.uint16)
                    stack[rows["plane"], rows["y"], rows["x"]] = np.rint(rows["v"])
                    tiff.write(f"{folder}/camera{camera + 1}/qstack.tif", list(stack))
        if self.has("targets"):
            rows = self.read("targets").toPandas()  # a row per setup
            files.write_json(f"{folder}/intensity_target.json", {"apply_basic": self.apply_basic, "setups": {str(r["setup"]): {k: (None if v != v else v) for k, v in r.items()} for r in rows.to_dict("records")}, "limits": self.settings.limits.__dict__})

    def take(self, folder: str) -> list[str]:
        """Tables from a user's own files in a folder as ``export`` lays it out: fields, empty parts and quantile stacks.

        What every camera has there is taken; the names of the tables are returned. Files of some cameras only are refused.
        """
        cameras, taken = range(len(self.settings.cameras)), []

        def paths(name: str) -> dict[int, str] | None:
            found = {c: f"{folder}/camera{c + 1}/{name}.tif" for c in cameras}
            if name == EMPTY_NAME:
                old = {c: f"{folder}/{OLD_EMPTY.format(camera=c + 1)}" for c in cameras}
                found = {c: old[c] if not files.exists(found[c]) and files.exists(old[c]) else found[c] for c in cameras}
            there = [c for c in cameras if files.exists(found[c])]
            if there and len(there) < len(found):
                raise RuntimeError(f"{folder} has {name}.tif of cameras {there} only")
            return found if there else None

        if paths(tiff.FIELDS["flat"]) and paths(tiff.FIELDS["dark"]):
            taken.append("fields")
            self.keep("fields", tiff.fields(self.spark, folder, len(cameras)))
        if found := paths(EMPTY_NAME):
            taken.append("empty_pixels")
            self.keep("empty_pixels", tiff.camera_planes(self.spark, found, "phi").drop("plane"))
        if found := paths("qstack"):
            taken.append("qstack")
            self.keep("qstack", tiff.camera_planes(self.spark, found, "v"))
        return taken

    def stage(self, name: str, mode: str) -> None:
        if self.single and name not in ("int-stats", "correct"):
            raise ValueError(f"{name} takes cameras, not single setups")
        if self.partial and name == "int-aggregate":
            raise ValueError("int-aggregate takes the whole dataset")
        if name == "correct":
            self.correct(mode)
        elif name == "export":
            self.export(self.settings.results_root)
        else:
            getattr(self, name.replace("-", "_"))()


def run(spark: SparkSession, settings: Settings, pipeline: str = "basic", start_at: str | None = None, stop_after: str | None = None, dry_run: bool = False, **source) -> list[str]:
    """Runs a pipeline's stages in order and returns their names; a dry run only names them."""
    stages = plan(pipeline, start_at, stop_after)
    if not dry_run:
        now = Run(spark, settings, apply_basic=pipeline == "both", **source)
        for name in stages:
            try:
                now.stage(name, pipeline)
            except Exception as failed:
                if name != "emptiness":
                    raise
                # what it measures is advice: later stages do without, or say what they lack
                warnings.warn(f"emptiness failed and is left out: {failed}", stacklevel=2)
    return stages

"""Settings of a dataset, read from a TOML file over defaults; unknown names and values are refused."""

from __future__ import annotations

import os
import tomllib
from dataclasses import asdict, dataclass, field, fields, replace
from pathlib import Path

from .operators.tilestats import Limits
from .plans.flatfield import FitParams
from .sources.stores import FORMATS

#: The table of the settings (without it, the first table that has a results_root) and the sub-table of the fit.
TABLE, FIT = "illumination", "basic"
# Other names of settings, and those of job schedulers and file layouts that mean nothing here.
OTHER_NAMES = {"input_intensity_path": "input_path", "output_intensity_path": "output_path"}
IGNORED = frozenset("chunks_per_job max_concurrent_cores output_stem error_stem setups_per_row qstacks_dir z_batch input_basic_path output_basic_path tiff_slab_planes".split())
IGNORED_STARTS = ("lsf_", "n_cores_")


@dataclass(frozen=True)
class Fitting:
    estimate_darkfield: bool = True
    lam: float = 0.0
    lambda_darkfield: float = 0.0
    autotune: bool = True
    max_iterations: int = 500
    optimization_tol: float = 1e-6
    reweight_tol: float = 1e-3
    max_reweighting_iterations: int = 10
    epsilon: float = 0.1
    working_size: int = 0
    override_darkfield: bool | float = False

    def params(self) -> FitParams:
        """The fit's parameters; a dark field that is given as a number overrides the fitted one (measured ones: ``measured_darks``)."""
        fixed = None if isinstance(self.override_darkfield, bool) else float(self.override_darkfield)
        return FitParams(self.lam, self.lambda_darkfield, self.estimate_darkfield, fixed, self.working_size, self.max_iterations, self.optimization_tol, self.max_reweighting_iterations, self.reweight_tol, self.epsilon)


@dataclass(frozen=True)
class Settings:
    results_root: str = "results"
    input_path: str = ""
    output_path: str = ""
    input_format: str = "zarr2"
    output_format: str = ""
    dataset_xml: str = ""
    setup_ids: tuple[tuple[int, ...], ...] = ()
    last_setup: int = 0
    setups_per_camera: int = 1
    chunk_size: tuple[int, int, int] = (128, 128, 64)  # x, y, z
    shard_size: tuple[int, int, int] = (512, 512, 256)
    stats_scale: int = 2
    basic_stats_level: int = 0
    basic_unmix_empty: bool = False
    apply_basic: bool | None = None
    gain_grouping: str = "camera"
    gain_estimator: str = "intersection"
    gain_lambda: float | None = None
    gain_floor: str | float = "tile"
    tile_threshold: str | float = "li"
    min_overlap_foreground: int = 256
    min_overlap_fraction: float = 0.001
    min_tile_foreground: int = 256
    min_tile_fraction: float = 0.001
    min_uniform_std: float = 10.0
    min_background_area: float = 0.02
    max_gain_scale: float = 8.0
    empty_occupancy_floor: float = 0.02
    otsu_sample_voxels: int = 32_000_000
    background_percentile: float = 5.0
    flat_floor: float = 1e-3
    tiff_compression: str | None = "zstd"
    basic: Fitting = field(default_factory=Fitting)

    def __post_init__(self) -> None:
        for name, allowed in (("input_format", FORMATS), ("output_format", ("", "tiff", *FORMATS)), ("gain_grouping", ("camera", "tile")), ("gain_estimator", ("intersection", "independent"))):
            if getattr(self, name) not in allowed:
                raise ValueError(f"{name} = {getattr(self, name)!r} is none of {allowed}")
        for name, allowed in (("tile_threshold", ("otsu", "li", "pooled")), ("gain_floor", ("tile", "threshold", "otsu", "li"))):
            value = getattr(self, name)
            if isinstance(value, str) and value not in allowed:
                raise ValueError(f"{name} = {value!r} is none of {allowed}, and no number")

    @property
    def cameras(self) -> list[list[int]]:
        """Setups by camera: the listed groups, or runs of ``setups_per_camera``."""
        if self.setup_ids:
            return [list(g) for g in self.setup_ids]
        n = self.setups_per_camera
        return [list(range(a, min(a + n, self.last_setup + 1))) for a in range(0, self.last_setup + 1, n)]

    @property
    def setups(self) -> list[int]:
        return [s for g in self.cameras for s in g]

    def camera_of(self, setup: int) -> int:
        for k, group in enumerate(self.cameras):
            if setup in group:
                return k
        raise ValueError(f"setup {setup} belongs to no camera")

    @property
    def penalty(self) -> float:
        """The gain solve's, where none is set: hardly any for cameras, some for tiles."""
        return self.gain_lambda if self.gain_lambda is not None else {"camera": 1e-6, "tile": 0.1}[self.gain_grouping]

    @property
    def limits(self) -> Limits:
        return Limits(self.min_tile_fraction, self.min_tile_foreground, self.min_uniform_std, self.min_background_area, self.max_gain_scale)

    @property
    def out_format(self) -> str:
        return self.output_format or self.input_format


def from_tables(tables: dict) -> Settings:
    found = tables.get(TABLE) or next((t for t in tables.values() if isinstance(t, dict) and "results_root" in t), {})
    own = {OTHER_NAMES.get(k, k): v for k, v in found.items() if k not in IGNORED and not k.startswith(IGNORED_STARTS)}
    fit = dict(own.pop(FIT, {}))
    if "format" in own:
        raise ValueError("format is named input_format (and output_format)")
    if own.get("input_format") == "tiff":
        raise ValueError("tiff is written only, not read")
    names = {f.name for f in fields(Fitting)}
    if "lambda" in fit:
        fit["lam"] = fit.pop("lambda")
    for name in [k for k in own if k in names]:  # settings of the fit that stand in the outer table
        fit.setdefault(name, own.pop(name))
    for given, kind in ((own, Settings), (fit, Fitting)):
        unknown = set(given) - {f.name for f in fields(kind)}
        if unknown:
            raise ValueError(f"unknown settings: {', '.join(sorted(unknown))}")
    for name in ("results_root", "input_path", "output_path", "dataset_xml"):
        if name in own:
            own[name] = own[name].replace("$HOME", os.path.expanduser("~"))
    for name in ("chunk_size", "shard_size"):
        if name in own:
            own[name] = tuple(own[name])
    if "setup_ids" in own:
        own["setup_ids"] = tuple(tuple(g) for g in own["setup_ids"])
    return Settings(**own, basic=Fitting(**fit))


def load(path: str | Path) -> Settings:
    with open(path, "rb") as f:
        try:
            return from_tables(tomllib.load(f))
        except tomllib.TOMLDecodeError as wrong:
            raise ValueError(f"{path} is no valid TOML: {wrong}") from wrong


def _toml(value) -> str:
    if isinstance(value, bool):
        return str(value).lower()
    if isinstance(value, str):
        return '"' + value.replace("\\", "\\\\").replace('"', '\\"') + '"'
    if isinstance(value, (list, tuple)):
        return "[" + ", ".join(map(_toml, value)) + "]"
    return repr(value)


def save(settings: Settings, path: str | Path, **changes) -> Settings:
    """Writes settings, those that differ from the defaults, with the changes made."""
    settings = replace(settings, **changes)
    now, plain = asdict(settings), asdict(Settings())
    lines = [f"[{TABLE}]"] + [f"{k} = {_toml(v)}" for k, v in now.items() if k != "basic" and v != plain[k] and v is not None]
    fit = [f"{'lambda' if k == 'lam' else k} = {_toml(v)}" for k, v in now["basic"].items() if v != plain["basic"][k]]
    if fit:
        lines += ["", f"[{TABLE}.{FIT}]", *fit]
    Path(path).write_text("\n".join(lines) + "\n")
    return settings

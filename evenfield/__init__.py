"""Illumination correction of tiled microscopy volumes on Spark, and corpus operators (``evenfield.llm``).

What most programs need is here by name and loaded when it is first used.
"""

from importlib import import_module

_HOME = {"Settings": "config", "load": "config", "save": "config", "Run": "plans.pipeline", "run": "plans.pipeline", "FitParams": "plans.flatfield", "fit_fields": "plans.flatfield", "fit_cameras": "plans.flatfield", "correct": "operators.correct", "chunks": "sources.stores", "to_voxels": "sources.stores"}
__all__ = sorted(_HOME)


def __getattr__(name: str):
    if name not in _HOME:
        raise AttributeError(f"module {__name__!r} has no attribute {name!r}")
    home = import_module(f".{_HOME[name]}", __name__)
    return getattr(home, name)


def __dir__() -> list[str]:
    return sorted({*globals(), *_HOME})

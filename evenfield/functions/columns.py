"""Scalar expressions on columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

TOP = 65535.0


def to_uint16(value: Column) -> Column:
    """Clipped to 0..65535, then rounded half to even."""
    return F.rint(F.least(F.greatest(value, F.lit(0.0)), F.lit(TOP))).cast("int")


def shrink(value: Column, threshold: Column) -> Column:
    """Soft threshold: towards zero by ``threshold``, and zero within it."""
    return F.signum(value) * F.greatest(F.abs(value) - threshold, F.lit(0.0))


def basic_corrected(raw: Column, flat: Column, dark: Column) -> Column:
    """(raw - dark) / flat, not below zero."""
    return F.greatest((raw - dark) / flat, F.lit(0.0))


def library_corrected(raw: Column, flat: Column, dark: Column, offset: float = 0.0, multiplier: float = 1.0) -> Column:
    """((raw - dark) / flat + offset) * multiplier, not clamped."""
    return ((raw - dark) / flat + offset) * multiplier


def unmixed(value: Column, empty_part: Column, background: Column, most: float = 0.9) -> Column:
    """A quantile with the background's share of it taken out: (q - p * bg) / (1 - p), p at most ``most``, within uint16."""
    p = F.least(empty_part, F.lit(most))
    return F.least(F.greatest((value - p * background) / (1 - p), F.lit(0.0)), F.lit(TOP))


def cell(column: str, factor: int) -> Column:
    """The number of the block of ``factor`` that a coordinate lies in."""
    return F.expr(f"cast({column} div {factor} as int)")

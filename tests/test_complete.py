"""Tiles that arrive as a stream in any order, told when whole."""

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from evenfield.operators import emptiness
from evenfield.streaming import complete

SIZES = {0: (5, 7, 6), 1: (4, 9, 5)}


@pytest.fixture(scope="module")
def tiles(spark):
    rng = np.random.default_rng(7)
    rows = [(s, s, *map(int, at), int(rng.integers(0, 100))) for s, size in SIZES.items() for at in np.ndindex(*size)]
    voxels = spark.createDataFrame(rows, "camera int, setup int, z int, y int, x int, v int").cache()
    limits = spark.createDataFrame([(0, 50.0), (1, 20.0)], "camera int, threshold double")
    sizes = spark.createDataFrame([(s, *n) for s, n in SIZES.items()], "setup int, nz int, ny int, nx int")
    return voxels, limits, sizes


def rows_of(df):
    return sorted(tuple(r) for r in df.select("camera", "setup", "y", "x", *emptiness.SUMS).collect())


def test_any_order_and_split_of_arrivals_gives_the_batch_result(spark, tiles, tmp_path):
    voxels, limits, sizes = tiles
    want = rows_of(emptiness.column_sums(voxels, limits))
    parts = voxels.withColumn("part", F.pmod(F.xxhash64("setup", "z", "y", "x"), F.lit(3)))
    for k in (0, 1):
        parts.filter(F.col("part") == k).drop("part").orderBy(F.desc("z"), "x").coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
    watch = lambda: complete.follow(spark, str(tmp_path / "in"), str(tmp_path / "out"), limits, sizes, side=4, files_per_batch=1).awaitTermination()
    watch()
    read = lambda: spark.read.schema(complete.OUT).parquet(str(tmp_path / "out/columns"))
    assert not set(rows_of(read())) - set(want)  # squares that are whole by now, if any
    parts.filter(F.col("part") == 2).drop("part").coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
    watch()
    assert rows_of(read()) == want and read().filter("not complete").count() == 0
    watch()
    assert rows_of(read()) == want  # told once


class Held:
    """A value of state, as the engine keeps it."""

    def __init__(self):
        self.value = None

    def exists(self):
        return self.value is not None

    def get(self):
        return self.value

    def update(self, value):
        self.value = value

    def clear(self):
        self.value = None


class Handle:
    def __init__(self):
        self.timers = []

    def getValueState(self, name, schema):
        return Held()

    def registerTimer(self, at):
        self.timers.append(at)

    def deleteTimer(self, at):
        self.timers.remove(at)


class Clock:
    def __init__(self, now):
        self.now = now

    def getCurrentProcessingTimeInMs(self):
        return self.now


def test_a_square_that_never_ends_is_told_by_its_timer():
    handle, sums = Handle(), complete.SquareSums(side=2, patience=1000)
    sums.init(handle)
    rows = lambda *v: iter([pd.DataFrame({"y": [2, 3], "x": [0, 1], "v": v, "threshold": 5.0, "wanted": 8})])
    key = (1, 4, 1, 0)
    assert list(sums.handleInputRows(key, rows(3, 9), Clock(100))) == [] and handle.timers == [1100]
    assert list(sums.handleInputRows(key, rows(7, 4), Clock(600))) == [] and handle.timers == [1600]
    (found,) = sums.handleExpiredTimer(key, Clock(1600), None)
    assert found.values.tolist() == [[1, 4, 2, 0, 2, 1, 1, 3.0, False], [1, 4, 3, 1, 2, 1, 1, 4.0, False]]
    assert list(sums.handleExpiredTimer(key, Clock(1700), None)) == []
    handle.timers.clear()
    for _ in range(3):
        assert list(sums.handleInputRows(key, rows(1, 1), Clock(2000))) == []
    (found,) = sums.handleInputRows(key, rows(1, 1), Clock(2000))
    assert found["complete"].all() and found["n"].tolist() == [4, 4] and handle.timers == []

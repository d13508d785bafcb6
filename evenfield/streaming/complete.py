"""Tiles that arrive as a stream, told when they are whole: sums per pixel column are state, and go out once all planes have come.

The state's key is a square of a tile's pixels, so a tile's state is spread over tasks and a key's is some hundred kilobytes. Sums don't depend on
the order in which rows come nor on how they are split into batches. A square that gets no more rows for ``patience`` is told as
it is, with complete = false, by a timer. Needs the RocksDB state store, which ``follow`` sets.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

from ..model import VOXEL
from ..operators.emptiness import SUMS

SIDE = 128
OUT = "camera int, setup int, y int, x int, n long, n_above long, n_below long, sum_below double, complete boolean"
PROVIDER = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


class SquareSums(StatefulProcessor):
    """Sums of one square's pixel columns; ``patience`` is in milliseconds, 0 for ever."""

    def __init__(self, side: int = SIDE, patience: int = 0):
        self.side, self.patience = side, patience

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.sums = handle.getValueState("sums", "sums binary, seen long, wanted long")
        self.timer = handle.getValueState("timer", "at long")

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        held, seen, wanted = self._held()
        for part in rows:
            at = (part["y"] % self.side * self.side + part["x"] % self.side).to_numpy()
            v, limit = part["v"].to_numpy(), part["threshold"].to_numpy()
            below = v < limit
            for k, weight in enumerate((None, v > limit, below, np.where(below, v, 0))):
                held[k] += np.bincount(at, weight, minlength=self.side**2)
            seen, wanted = seen + len(part), int(part["wanted"].iloc[0])
        self._stop()
        if seen >= wanted:
            yield self._told(key, held, True)
            self.sums.clear()
            return
        self.sums.update((held.tobytes(), seen, wanted))
        if self.patience:
            at = int(timerValues.getCurrentProcessingTimeInMs()) + self.patience
            self.handle.registerTimer(at)
            self.timer.update((at,))

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        if self.sums.exists():
            held, _, _ = self._held()
            yield self._told(key, held, False)
            self.sums.clear()
            self.timer.clear()

    def close(self) -> None:
        pass

    def _held(self) -> tuple[np.ndarray, int, int]:
        if not self.sums.exists():
            return np.zeros((len(SUMS), self.side**2)), 0, 0
        data, seen, wanted = self.sums.get()
        return np.frombuffer(bytes(data)).reshape(len(SUMS), -1).copy(), seen, wanted

    def _stop(self) -> None:
        """More rows came: the timer of the last ones doesn't count."""
        if self.timer.exists():
            self.handle.deleteTimer(self.timer.get()[0])
            self.timer.clear()

    def _told(self, key, held: np.ndarray, complete: bool) -> pd.DataFrame:
        camera, setup, sy, sx = (int(k) for k in key)
        k = np.flatnonzero(held[0])
        columns = {"camera": camera, "setup": setup, "y": k // self.side + sy * self.side, "x": k % self.side + sx * self.side}
        whole = {name: held[j][k].astype(np.int64) if name != "sum_below" else held[j][k] for j, name in enumerate(SUMS)}
        return pd.DataFrame(columns | whole | {"complete": complete})


def column_sums(voxels: DataFrame, limits: DataFrame, sizes: DataFrame, side: int = SIDE, patience: int = 0) -> DataFrame:
    """The stream of whole columns' sums, as ``emptiness.column_sums`` has them, from a stream of ``model.VOXEL``.

    ``limits`` is (camera, threshold), ``sizes`` (setup, nz, ny, nx); both are joined where the rows arrive.
    """
    rows = voxels.join(F.broadcast(limits.select("camera", "threshold")), "camera").join(F.broadcast(sizes.select("setup", "nz", "ny", "nx")), "setup")  # rows per camera and setup
    rows = rows.withColumn("sy", F.expr(f"cast(y div {side} as int)")).withColumn("sx", F.expr(f"cast(x div {side} as int)"))
    wanted = F.col("nz") * F.least(F.lit(side), F.col("ny") - F.col("sy") * side) * F.least(F.lit(side), F.col("nx") - F.col("sx") * side)
    rows = rows.select("camera", "setup", "sy", "sx", "y", "x", "v", F.col("threshold").cast("double").alias("threshold"), wanted.cast("long").alias("wanted"))
    return rows.groupBy("camera", "setup", "sy", "sx").transformWithStateInPandas(SquareSums(side, patience), OUT, "Append", "ProcessingTime" if patience else "None")


def follow(spark: SparkSession, source: str, results: str, limits: DataFrame, sizes: DataFrame, side: int = SIDE, patience: int = 0, files_per_batch: int = 100) -> StreamingQuery:
    """Follows Parquet files of ``model.VOXEL``; whole columns' sums go to ``results``/columns, once each."""
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", PROVIDER)
    arriving = spark.readStream.schema(VOXEL).option("maxFilesPerTrigger", files_per_batch).parquet(source)
    found = column_sums(arriving, limits, sizes, side, patience)
    return found.writeStream.format("parquet").option("path", f"{results}/columns").option("checkpointLocation", f"{results}/_progress").outputMode("append").trigger(availableNow=True).start()

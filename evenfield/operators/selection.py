"""Exact order statistics of groups that no task holds, by radix selection on the bits of doubles.

A double becomes a long of the same order. Counts by its leading 16 bits are summed before they are shuffled; the bucket that
holds the rank is refined by the next 16, and after four rounds the value stands. A group's rows are spread over all
tasks in every round, and what meets is a bucket's counts, 65 536 rows at most.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, LongType, StructField, StructType

from ..session import shared_folder

WIDTH = 16
_FLIP = np.int64(0x7FFFFFFFFFFFFFFF)


def to_bits(values: np.ndarray) -> np.ndarray:
    """Longs in the order of doubles; both zeros are one, NaN is above all."""
    bits = (np.asarray(values, np.float64) + 0.0).view(np.int64)
    return np.where(bits < 0, bits ^ _FLIP, bits)


def from_bits(bits: np.ndarray) -> np.ndarray:
    bits = np.asarray(bits, np.int64)
    return np.where(bits < 0, bits ^ _FLIP, bits).view(np.float64)


def _mapped(rows: DataFrame, source: str, target: str, work, kind) -> DataFrame:
    """``rows`` with the column ``source`` made into ``target`` by numpy."""
    names = rows.columns
    fields = [StructField(target, kind) if f.name == source else f for f in rows.schema]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            columns = [pa.array(work(batch.column(n).to_numpy(zero_copy_only=False))) if n == source else batch.column(n) for n in names]
            yield pa.RecordBatch.from_arrays(columns, [target if n == source else n for n in names])

    return rows.mapInArrow(run, StructType(fields))


def _kept(rows: DataFrame, name: str) -> DataFrame:
    path = shared_folder(rows.sparkSession, name)
    rows.write.parquet(path)
    return rows.sparkSession.read.parquet(path)


def percentiles(rows: DataFrame, keys: list[str], value: str, part: float = 0.5) -> DataFrame:
    """(keys, n, result): what ``percentile(value, part)`` is of each group, to the bit; nulls don't count.

    ``rows`` are written once, as keys and bits, and read once a round.
    """
    held = rows.filter(F.col(value).isNotNull()).select(*keys, F.col(value).cast("double").alias("value"))
    bits = _kept(_mapped(held, "value", "bits", to_bits, LongType()), "selection")
    place = (F.col("n") - 1) * F.lit(float(part))
    sizes = bits.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))
    targets = sizes.select(*keys, "n", place.alias("place"), F.explode(F.array_distinct(F.array(F.floor(place), F.ceil(place)))).alias("rank"))
    targets = _kept(targets.select("*", F.lit(0).cast("long").alias("prefix"), F.col("rank").alias("left")), "selection")
    same = lambda a, b: [F.col(f"{a}.{k}").eqNullSafe(F.col(f"{b}.{k}")) for k in keys]
    for shift in range(64 - WIDTH, -1, -WIDTH):
        prefix = F.shiftright("bits", shift + WIDTH) if shift + WIDTH < 64 else F.lit(0).cast("long")
        own = bits.select(*keys, prefix.alias("prefix"), F.shiftright("bits", shift).alias("bucket"))
        sought = targets.select(*keys, "prefix").distinct()  # one or two rows a group
        own = own.alias("r").join(sought.alias("t"), [*same("r", "t"), F.col("r.prefix") == F.col("t.prefix")], "left_semi")
        counts = own.groupBy(*keys, "prefix", "bucket").agg(F.count(F.lit(1)).alias("c"))
        met = counts.alias("r").join(targets.alias("t"), [*same("r", "t"), F.col("r.prefix") == F.col("t.prefix")]).select("t.*", "r.bucket", "r.c")
        up_to = F.sum("c").over(Window.partitionBy(*keys, "rank").orderBy("bucket"))
        met = met.withColumn("up_to", up_to).filter((F.col("up_to") > F.col("left")) & (F.col("up_to") - F.col("c") <= F.col("left")))
        targets = _kept(met.select(*keys, "n", "place", "rank", F.col("bucket").alias("prefix"), (F.col("left") - F.col("up_to") + F.col("c")).alias("left")), "selection")
    found = _mapped(targets.select(*keys, "n", "place", "rank", "prefix"), "prefix", "found", from_bits, DoubleType())
    weight = F.when(F.col("rank") == F.floor("place"), F.when(F.ceil("place") == F.floor("place"), 1.0).otherwise(F.ceil("place") - F.col("place"))).otherwise(F.col("place") - F.floor("place"))
    # two neighbours of one value are that value, as percentile has it
    parts = found.groupBy(*keys, "n").agg(F.sum(weight * F.col("found")).alias("mixed"), F.min("found").alias("least"), F.max("found").alias("most"))
    return parts.select(*keys, "n", F.when(F.col("least") == F.col("most"), F.col("least")).otherwise(F.col("mixed")).alias("result"))

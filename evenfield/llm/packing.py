"""Best-fit packing of tokenised documents into sequences, planned on the histogram of lengths.

A document is its ids and one end id. Documents longer than ``capacity`` are cut into pieces of ``capacity`` tokens,
the first of which may be shorter. Large-item matching: pieces above a third of the capacity share a sequence at most
by twos; the longer one opens it and the best fitting shorter one is matched to it greedily, those without a match
pair with each other. Shorter pieces then go, in falling length, into the smallest gap that takes them.

Pieces of one length are alike, so the plan needs their numbers only: a table of at most ``capacity`` counts, whatever
the data. It consists of runs: the i-th .. j-th piece of a length go, so many to a sequence, into consecutive
sequences at an offset. Each piece finds its place from its length and its number among the pieces of that length,
which is counted by (length, salt) so that no length is one task's work. Ids never leave their task.

Asked to keep the stored order (``in_order``), the plan and so the number of sequences are the same, but the order of the
documents decides who goes where: pieces of a length are numbered in that order, sequences by the piece that opens them, and
the k-th of the other pieces of a length goes into the k-th of their places. So sequences read by their numbers hold the documents
in about the order that they were stored in, as mixing left it.

Null text is an empty document (the end id alone), as are empty texts; repeated rows are packed each on their own; an empty
table gives no rows; extra columns don't matter.
"""

from __future__ import annotations

import bisect
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import cut, map_batches, read_table, shuffle_partitions
from .tokens import encoder, vocabulary_paths


@dataclass(frozen=True)
class PackParams:
    capacity: int = 2048
    end_id: int = 0
    vocabulary: str = "byte_bpe_50k"


@dataclass(frozen=True)
class Run:
    """Pieces first .. first + n - 1 of a length: ``each`` to a sequence from ``sequence`` on, the first at ``offset``."""

    length: int
    first: int
    n: int
    sequence: int
    each: int
    offset: int


def plan(counts: dict[int, int], capacity: int) -> tuple[list[Run], int]:
    """Runs that place ``counts[length]`` pieces of every length, and the number of sequences."""
    runs: list[Run] = []
    total = 0
    gaps: dict[int, list[tuple[int, int]]] = {}  # gap: runs (first, n) of sequences that have it
    order: list[int] = []
    placed = dict.fromkeys(counts, 0)

    def free(gap: int, first: int, n: int) -> None:
        if gap and n:
            if gap not in gaps:
                gaps[gap] = []
                bisect.insort(order, gap)
            gaps[gap].append((first, n))

    def fill(length: int, gap: int, first: int, n: int, pieces: int, most: int, after=free) -> int:
        """Puts ``pieces`` into ``n`` sequences of ``gap``; returns how many found room."""
        each = min(most, gap // length)
        full = min(n, pieces // each)
        if full:
            runs.append(Run(length, placed[length], full * each, first, each, capacity - gap))
            placed[length] += full * each
            after(gap - each * length, first, full)
        rest = pieces - full * each if full < n else 0
        if rest:
            rest = min(rest, each)
            runs.append(Run(length, placed[length], rest, first + full, rest, capacity - gap))
            placed[length] += rest
            after(gap - rest * length, first + full, 1)
            full += 1
        if n > full:
            free(gap, first + full, n - full)
        return full

    def best_fit(length: int, most: int, after=free) -> None:
        left = counts[length] - placed[length]
        while left:
            k = bisect.bisect_left(order, length)
            if k == len(order):
                return
            gap = order[k]
            first, n = gaps[gap].pop()
            if not gaps[gap]:
                del gaps[gap], order[k]
            before = placed[length]
            fill(length, gap, first, n, left, most, after)
            left -= placed[length] - before

    large = sorted((x for x in counts if 3 * x > capacity), reverse=True)
    small = sorted((x for x in counts if 3 * x <= capacity), reverse=True)
    for length in (x for x in large if 2 * x > capacity):
        n = counts[length]
        runs.append(Run(length, 0, n, total, 1, 0))
        placed[length] = n
        free(capacity - length, total, n)
        total += n
    # a sequence that holds two large pieces takes no third: it is set aside until the small ones come
    paired: list[tuple[int, int, int]] = []
    aside = lambda gap, first, n: paired.append((gap, first, n))
    for length in (x for x in large if 2 * x <= capacity):
        best_fit(length, 1, aside)
    single: tuple[int, int] | None = None  # (gap, sequence) that holds one piece without a partner
    for length in (x for x in large if 2 * x <= capacity):
        n = counts[length] - placed[length]
        if n and single:
            runs.append(Run(length, placed[length], 1, single[1], 1, capacity - single[0]))
            placed[length] += 1
            paired.append((single[0] - length, single[1], 1))
            single, n = None, n - 1
        if n:
            twos = n // 2
            if twos:
                runs.append(Run(length, placed[length], 2 * twos, total, 2, 0))
                placed[length] += 2 * twos
                paired.append((capacity - 2 * length, total, twos))
                total += twos
            if n % 2:
                runs.append(Run(length, placed[length], 1, total, 1, 0))
                placed[length] += 1
                single = (capacity - length, total)
                total += 1
    for gap, first, n in paired + ([(*single, 1)] if single else []):
        free(gap, first, n)
    for length in small:
        best_fit(length, capacity)
        left = counts[length] - placed[length]
        if left:
            each = capacity // length
            new = -(-left // each)
            fill(length, capacity, total, new, left, capacity)
            total += new
    return runs, total


def tokenised(docs: DataFrame, params: PackParams, *keep: str) -> DataFrame:
    """One row per piece: doc_id, piece, start, length, ids_crc32, and the ``keep`` columns of its document."""
    paths, capacity, end = vocabulary_paths(params.vocabulary), params.capacity, params.end_id
    own = ["doc_id", *keep]

    def pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(*paths)
        for batch in batches:
            out: list[list[int]] = [[], [], [], [], []]
            for row, text in enumerate(batch.column("text")):
                ids = encode(text.as_py() or "")
                ids.append(end)
                raw = np.array(ids, "<u4").tobytes()
                n = len(ids)
                at = 0
                for k in range(-(-n // capacity)):
                    stop = at + ((n - 1) % capacity + 1 if k == 0 else capacity)
                    for column, value in zip(out, (row, k, at, stop - at, zlib.crc32(raw[4 * at : 4 * stop]))):
                        column.append(value)
                    at = stop
            rows = pa.array(out[0], pa.int32())
            yield pa.RecordBatch.from_arrays([*(batch.column(c).take(rows) for c in own), pa.array(out[1], pa.int32()), *(pa.array(x, pa.int64()) for x in out[2:])], [*own, "piece", "start", "length", "ids_crc32"])

    kinds = dict(docs.dtypes)
    return map_batches(docs.select(*own, "text"), pieces, ", ".join(f"{c} {kinds[c]}" for c in own) + ", piece int, start long, length long, ids_crc32 long")


def _stored(docs: DataFrame) -> tuple[DataFrame, int]:
    """doc_id, text and place, the row's number in the order of its files (that of partitions, where it lies in none), and the rows' number."""
    try:
        rows = docs.select("doc_id", "text", F.col("_metadata.file_path").alias("file"), F.col("_metadata.row_index").alias("at"))
    except AnalysisException:
        rows = cut(docs.select("doc_id", "text").withColumn("at", F.monotonically_increasing_id()).withColumn("file", F.lpad(F.shiftright("at", 33).cast("string"), 10, "0")).withColumn("at", F.col("at").bitwiseAND((1 << 33) - 1)))
    files = cut(rows.groupBy("file").agg(F.count(F.lit(1)).alias("n")))  # a row per file
    before = files.select("file", F.coalesce(F.sum("n").over(Window.orderBy("file").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("before"))
    total = files.agg(F.sum("n")).first()[0] or 0
    return rows.join(F.broadcast(before), "file").select("doc_id", "text", (F.col("before") + F.col("at")).alias("place")), total


def _number(rows: DataFrame, key: str, order: list[str], parts: DataFrame | None = None) -> DataFrame:
    """``rows`` and each one's number among those of its key: by salt, then ``order``. ``parts`` are the counts n by key and salt."""
    parts = cut(rows.groupBy(key, "salt").agg(F.count(F.lit(1)).alias("n"))) if parts is None else parts
    before = parts.withColumn("before", F.coalesce(F.sum("n").over(Window.partitionBy(key).orderBy("salt").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
    # computed keys, so that this table's partitioning by the key alone isn't taken for the rows too
    before = before.select(F.abs(key).alias(key), F.abs("salt").alias("salt"), "before")
    numbered = rows.withColumn("own", F.row_number().over(Window.partitionBy(key, "salt").orderBy(*order)) - 1)
    return numbered.join(before, [key, "salt"]).withColumn("number", F.col("before") + F.col("own")).drop("before", "own", "salt")


def _salted(by: str, total: int, salts: int) -> Column:
    """Equal ranges of a number below ``total``."""
    return F.floor(F.col(by) * salts / max(1, total)).cast("int")


def _in_order(found: DataFrame, total: int, rows: int, salts: int) -> DataFrame:
    """The placed pieces with sequences numbered by the places of their first documents, and others moved to the places of their length in that order."""
    found = cut(found)
    opens = found.filter("offset = 0").select("sequence_id", "place", "piece", F.lit(0).alias("all")).withColumn("salt", _salted("place", rows, salts))
    ranks = cut(_number(opens, "all", ["place", "piece", "sequence_id"]).select("sequence_id", F.col("number").alias("rank")))
    opened = found.filter("offset = 0").join(ranks, "sequence_id").select("doc_id", "piece", "start", "length", "ids_crc32", F.col("rank").alias("sequence_id"), "offset")
    others = found.filter("offset > 0")
    room = others.select("length", "sequence_id", "offset").join(ranks, "sequence_id").select("length", "rank", "offset").withColumn("salt", _salted("rank", total, salts))
    room = _number(room, "length", ["rank", "offset"])
    moved = _number(others.drop("sequence_id", "offset").withColumn("salt", _salted("place", rows, salts)), "length", ["place", "piece", "doc_id"])
    moved = moved.join(room, ["length", "number"]).select("doc_id", "piece", "start", "length", "ids_crc32", F.col("rank").alias("sequence_id"), "offset")
    return opened.unionByName(moved)


def pack(docs: DataFrame, params: PackParams = PackParams(), in_order: bool = False) -> DataFrame:
    """One row per piece of every document: doc_id, piece, start, length, ids_crc32, sequence_id, offset. ``in_order``:
    sequences follow the order in which the documents are stored."""
    spark = docs.sparkSession
    salts = 4 * shuffle_partitions(spark)
    if in_order:
        docs, n_rows = _stored(docs)
        rows = cut(tokenised(docs, params, "place")).withColumn("salt", _salted("place", n_rows, salts))
        order = ["place", "piece"]
    else:
        rows = cut(tokenised(docs, params)).withColumn("salt", F.pmod(F.xxhash64("doc_id", "piece"), F.lit(salts)).cast("int"))
        order = ["doc_id", "piece", "ids_crc32"]
    parts = cut(rows.groupBy("length", "salt").agg(F.count(F.lit(1)).alias("n")))
    counts = {r["length"]: r["n"] for r in parts.groupBy("length").agg(F.sum("n").alias("n")).collect()}  # capacity rows at most
    runs, total = plan(counts, params.capacity)
    table = spark.createDataFrame([(r.length, r.first, r.first + r.n, r.sequence, r.each, r.offset) for r in runs], "length long, low long, high long, sequence long, each long, at long")
    numbered = _number(rows, "length", order, parts)
    # the runs' number depends on the capacity alone
    held = F.broadcast(table.withColumnRenamed("length", "of_length"))
    found = numbered.join(held, (F.col("length") == F.col("of_length")) & (F.col("number") >= F.col("low")) & (F.col("number") < F.col("high")))
    k = F.col("number") - F.col("low")
    kept = ["place"] if in_order else []
    found = found.select("doc_id", "piece", "start", "length", "ids_crc32", (F.col("sequence") + F.floor(k / F.col("each"))).cast("long").alias("sequence_id"), (F.col("at") + F.pmod(k, F.col("each")) * F.col("length")).cast("long").alias("offset"), *kept)
    return _in_order(found, total, n_rows, salts) if in_order else found


def op5_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(read_table(spark, sf_dir, "documents"))

"""Mixing sources to target weights by Pfair scheduling.

A source's documents, in the order of a hash of doc_id, form a stream that is cut into blocks of ``block_chars``
characters (a document belongs to the block in which it begins; every document counts one character at least). A
slot of the schedule takes one block. Target weights become fractions q / cycle; block j of a source is released at
floor((j - 1) / w) and due at ceil(j / w), and in each slot the released block of the earliest deadline runs (ties:
by the name of the source). Weights sum to 1, so every deadline is met, and after any slot a source is less than one
block away from its share of the slots. The bound is on slots: a document longer than a block leaves slots of its source
without a document of their own.

With fractions of ``cycle`` the schedule repeats after ``cycle`` slots, so only one cycle is simulated, whatever the
data; where a block runs follows from its number by arithmetic. When a source has no block left, the next phase
starts with the weights of the others in proportion: all documents are placed, none is dropped or repeated. Phases
and cycles depend on the number of sources only. More than ``cycle / 4`` sources get a longer cycle: the next power of
two that is at least four times their number.

Without ``weights`` each source's share of the characters, to the power ``temperature``, is its target. Sources that
weights don't name, or name with 0, get ``1 / cycle`` each, as every document is placed. Null sources form one source of their own; null texts are empty. Repeated
rows take a place each. An empty table gives no rows. Extra columns, whatever their names, are left alone by
``mix`` and dropped by ``schedule``.
"""

from __future__ import annotations

import heapq
from collections import defaultdict
from dataclasses import dataclass, field, replace
from fractions import Fraction

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import as_row, cut, from_row, read_table, shuffle_partitions, whole_text


#: The most numbers of a table of totals or slots that is broadcast.
MOST_TOTALS = 1 << 20


@dataclass(frozen=True)
class MixParams:
    block_chars: int = 1 << 16
    cycle: int = 4096
    temperature: float = 0.7
    weights: dict[str, float] = field(default_factory=dict)


def quotas(weights: list[float], cycle: int) -> list[int]:
    """Whole slots per cycle by largest remainders, one at least."""
    if len(weights) * 4 > cycle:
        raise ValueError(f"{len(weights)} sources need a cycle of at least {4 * len(weights)} slots")
    total = cycle / Fraction(sum(weights)).limit_denominator(10**9)
    exact = [Fraction(w).limit_denominator(10**9) * total for w in weights]
    given = [max(1, int(x)) for x in exact]
    by_need = sorted(range(len(weights)), key=lambda k: (given[k] - exact[k], k))
    while sum(given) < cycle:
        for k in by_need[: cycle - sum(given)]:
            given[k] += 1
    over = sum(given) - cycle
    most = [(exact[k] - given[k], -given[k], k) for k in range(len(given)) if given[k] > 1] if over > 0 else []
    heapq.heapify(most)
    for _ in range(over):
        k = heapq.heappop(most)[2]
        given[k] -= 1
        if given[k] > 1:
            heapq.heappush(most, (exact[k] - given[k], -given[k], k))
    return given


def pfair_cycle(given: list[int], cycle: int, left: list[int] | None = None) -> np.ndarray:
    """The source of each slot of one cycle, earliest deadline first among released blocks; no further than to where the
    first source has run the blocks it has ``left``."""
    released: dict[int, list[int]] = defaultdict(list)
    released[0] = list(range(len(given)))
    done, ready, out = [0] * len(given), [], np.empty(cycle, np.int64)
    for slot in range(cycle):
        for k in released.pop(slot, ()):
            j = done[k] + 1
            heapq.heappush(ready, (-(-j * cycle // given[k]), k))
        deadline, k = heapq.heappop(ready)
        if deadline <= slot:
            raise AssertionError("a deadline was missed")
        out[slot] = k
        done[k] += 1
        if left is not None and done[k] == left[k]:
            return out[: slot + 1]
        if done[k] < given[k]:
            released[max(slot + 1, done[k] * cycle // given[k])].append(k)
    return out


@dataclass(frozen=True)
class Phase:
    """Slots first .. first + slots - 1: cycles in which source k holds the quota[k] slots places[k] (those that the phase
    reaches); it has run before[k] blocks by then. Sources that don't run in the phase aren't named."""

    first: int
    slots: int
    before: dict[int, int]
    places: dict[int, np.ndarray]
    quota: dict[int, int]
    after: dict[int, int]


def phases(blocks: list[int], weights: list[float], cycle: int) -> list[Phase]:
    left, start, out = dict(enumerate(blocks)), 0, []
    left = {k: n for k, n in left.items() if n}
    run = {k: 0 for k in left}
    while left:
        names = sorted(left)
        given = quotas([weights[k] for k in names], cycle)
        order = pfair_cycle(given, cycle, [left[k] for k in names])
        ran = np.argsort(order, kind="stable")
        opens = np.flatnonzero(np.diff(order[ran], prepend=-1))
        places = {names[order[x[0]]]: x for x in np.split(ran, opens[1:])}
        quota = {names[i]: given[i] for i in order[ran[opens]].tolist()}
        # the first source to run its last block ends the phase
        whole = len(order) == cycle
        end = min((left[k] - 1) // quota[k] * cycle + int(places[k][(left[k] - 1) % quota[k]]) + 1 for k in names) if whole else len(order)
        before = {k: run[k] for k in places}
        for k in places:
            took = end // cycle * quota[k] + int(np.searchsorted(places[k], end % cycle))
            left[k] -= took
            run[k] += took
        out.append(Phase(start, end, before, places, quota, {k: run[k] for k in places}))
        left = {k: n for k, n in left.items() if n}
        start += end
    return out


def _thin(docs: DataFrame, salts: int, *keep: Column) -> DataFrame:
    """``keep`` and doc_id, source, src, chars, h and salt of every row: all that the schedule depends on."""
    own = docs.select(*keep, "doc_id", "source", F.coalesce(F.col("source"), F.lit("\0null")).alias("src"), F.greatest(F.length(whole_text()), F.lit(1)).cast("long").alias("chars"), F.xxhash64("doc_id").alias("h"))
    return own.withColumn("salt", F.pmod(F.col("h"), F.lit(salts)).cast("int"))


def _plan(own: DataFrame, params: MixParams):
    """(totals of each source and salt with what comes before, the schedule's rows, its slots, its cycle, the totals' number)."""
    parts = cut(own.groupBy("src", "salt").agg(F.sum("chars").alias("chars")))
    before = parts.withColumn("outer", F.coalesce(F.sum("chars").over(Window.partitionBy("src").orderBy("salt").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
    totals = sorted((r["src"], r["chars"]) for r in parts.groupBy("src").agg(F.sum("chars").alias("chars")).collect())  # a row per source
    params = replace(params, cycle=max(params.cycle, 1 << (4 * max(1, len(totals)) - 1).bit_length()))
    if params.weights:
        least = 1 / params.cycle
        weights = [max(params.weights.get(s, 0.0), 0.0) or least for s, _ in totals]
    else:
        weights = [float(c) ** params.temperature for _, c in totals]
    found = phases([-(-c // params.block_chars) for _, c in totals], weights, params.cycle)
    rows = [(totals[k][0], p, ph.before[k], ph.after[k], ph.first, at.tolist(), ph.quota[k]) for p, ph in enumerate(found) for k, at in ph.places.items()]
    return before, rows, sum(ph.slots for ph in found), params.cycle, parts.count()


def placed(docs: DataFrame, params: MixParams, *keep: Column) -> tuple[DataFrame, int]:
    """``keep``, doc_id, source, chars, start, block, phase, release, deadline and slot of every row, and the number of slots."""
    spark = docs.sparkSession
    salts = 4 * shuffle_partitions(spark)  # parts that a source's stream is sorted and counted in
    before, rows, slots, cycle, parts = _plan(_thin(docs, salts), params)
    own = _thin(docs, salts, *keep)
    w = Window.partitionBy("src", "salt").orderBy("h", "doc_id", "chars").rowsBetween(Window.unboundedPreceding, -1)
    own = own.withColumn("inner", F.coalesce(F.sum("chars").over(w), F.lit(0)))
    own = own.join(_small(before.drop("chars"), parts), ["src", "salt"]).withColumn("start", F.col("outer") + F.col("inner")).withColumn("block", F.floor(F.col("start") / F.lit(params.block_chars)).cast("long"))
    # a row per source and phase in which it runs
    table = spark.createDataFrame(rows, "src string, phase int, from_block long, to_block long, first_slot long, places array<int>, quota int")
    own = own.join(_small(table, sum(len(r[5]) for r in rows)), (own["src"] == table["src"]) & (own["block"] >= table["from_block"]) & (own["block"] < table["to_block"]))
    k = F.col("block") - F.col("from_block")
    slot = F.col("first_slot") + F.floor(k / F.col("quota")) * cycle + F.expr("element_at(places, cast(pmod(block - from_block, quota) as int) + 1)")
    release = F.col("first_slot") + F.floor(k * cycle / F.col("quota"))
    deadline = F.col("first_slot") + F.ceil((k + 1) * cycle / F.col("quota"))
    return own.withColumn("slot", slot.cast("long")).withColumn("release", release.cast("long")).withColumn("deadline", deadline.cast("long")), slots


def _small(table: DataFrame, numbers: int) -> DataFrame:
    """Marked for broadcast while it holds at most MOST_TOTALS numbers; else joined by shuffle, where skewed parts are split."""
    return F.broadcast(table) if numbers <= MOST_TOTALS else table.hint("merge")


def schedule(docs: DataFrame, params: MixParams = MixParams()) -> DataFrame:
    """One row per document: its block of its source, the block's window and slot, and the place within the block."""
    own, _ = placed(docs, params)
    return own.select("doc_id", "source", F.col("chars").alias("n_chars"), "phase", "block", "release", "deadline", "slot", (F.col("start") - F.col("block") * params.block_chars).alias("start_in_block"))


def mix(docs: DataFrame, params: MixParams = MixParams()) -> DataFrame:
    """All rows and columns of ``docs`` in the order of the schedule: partitions are runs of slots, sorted by slot."""
    own, slots = placed(docs, params, as_row(docs))
    parts = shuffle_partitions(docs.sparkSession)
    # runs of about equally many characters would need the slots' sizes; slots are about equal by design
    part = F.least(F.floor(F.col("slot") * parts / max(1, slots)), F.lit(parts - 1)).cast("int")
    own = own.select("row", "slot", "start", "doc_id")
    return from_row(own.repartitionById(parts, part).sortWithinPartitions("slot", "start", "doc_id"), docs.columns)


def op1_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    return schedule(read_table(spark, sf_dir, "documents"))

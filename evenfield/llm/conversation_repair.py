"""Repair of the structure of conversations at least cost, by a tensor of state costs over turns.

A repaired conversation's roles have initials ``(s?(ua)+)?``. Rows are kept (0), given the role user or assistant (1) or deleted (2);
an empty user or assistant row is inserted anywhere (5). Blank rows and rows whose role and text were there before must go; a
truncated row that stays costs 5 more. Of the cheapest edits those whose initials (D, I, K, R) come first in ASCII are made.

* Conversations are bucketed by length, and a bucket is time-major: at each turn the costs of what is left, from each of four
  states (nothing yet, system, user, assistant), are updated for all its conversations at once, from the last turn to the first.
* All backward costs are stored; the edits are traced forward, again for all conversations of a bucket at once.
* A task takes whole conversations as they stream by in order, and holds BATCH_ROWS rows or BATCH_BYTES bytes and one more at a time.
* A conversation of more than LONG_ROWS rows or LONG_CHARS characters isn't put together. Its rows are numbered in place by a sort
  by range, and worked on in blocks of BLOCK_ROWS: each block gives its least cost from each state to each; a fold of these
  (a row a block) gives each block the costs behind it, a second one its state; then its edits are traced. Only
  its hash, which is defined over its rows in order, is streamed through one task, a row at a time.

``conv_id`` null is a conversation; a null role or text counts as one space. Rows go by turn, nulls first; of equal turns by role, the text's
first 64 characters and a hash of the text, so rows that are wholly equal may change places. Roles that don't begin with s, u or a
can't be kept. Gaps beyond the range of a long are null. Texts may be empty or very long. An empty table gives no rows; further columns don't matter.
"""

from __future__ import annotations

import hashlib
import uuid
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import BATCH_BYTES, map_batches, read_table, shared_folder, shuffle_partitions, small_or_not

BATCH_ROWS = 1 << 14
LONG_ROWS, LONG_CHARS, BLOCK_ROWS = 1 << 12, 1 << 23, 1 << 14
SPACES = " \t\n\x0b\x0c\r"
# The costs of edits.
KEEP, REROLE, DELETE, INSERT, LATE = 0, 1, 2, 5, 5
#: States: nothing yet, after system, after user, after assistant. The role that may come next, and the state after it.
NOTHING, SYSTEM, USER, ASSISTANT = range(4)
NEXT = np.array([USER, USER, ASSISTANT, USER])
NAMES = {USER: "user", ASSISTANT: "assistant"}
END = np.array([0, 2 * INSERT, INSERT, 0], np.int64)
FAR = np.int64(1) << 40
#: A row's initial: 0 none of these, or the state after it.
INITIALS = {"s": SYSTEM, "u": USER, "a": ASSISTANT}
LETTERS = np.array(["D", "K", "R"])
_REPORT = "gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string, repaired_sha256 string"


# --------------------------------------------------------------------------- the tensor


def _after_keep(initial: np.ndarray) -> np.ndarray:
    """(…, 4): the state after keeping a row of this initial, -1 where it may not be kept."""
    out = np.full((*initial.shape, 4), -1, np.int8)
    out[initial == SYSTEM, NOTHING] = SYSTEM
    for state in (NOTHING, SYSTEM, ASSISTANT):
        out[initial == USER, state] = USER
    out[initial == ASSISTANT, USER] = ASSISTANT
    return out


def _row_costs(v: np.ndarray, initial: np.ndarray, free: np.ndarray, late: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(C, 4) costs of deleting, keeping and reroling one turn's rows, with the costs ``v`` of what follows."""
    more = np.where(late, LATE, 0)[:, None]
    after = _after_keep(initial)
    kept = np.where((after >= 0) & free[:, None], np.take_along_axis(v, np.maximum(after, 0).astype(np.int64), 1) + KEEP + more, FAR)
    rerole = np.where(free[:, None], v[:, NEXT] + REROLE + more, FAR)
    return v + DELETE, kept, rerole


def backward(initial: np.ndarray, free: np.ndarray, late: np.ndarray, real: np.ndarray, end: np.ndarray) -> np.ndarray:
    """(T + 1, C, 4): the least cost from before each turn on, inserts included; ``end`` (C, 4) is that behind the last. All others are (T, C)."""
    t, c = initial.shape
    v = np.empty((t + 1, c, 4), np.int64)
    v[t] = end
    for k in range(t - 1, -1, -1):
        best = np.minimum.reduce(_row_costs(v[k + 1], initial[k], free[k], late[k]))
        once = best[:, NEXT] + INSERT
        best = np.minimum(np.minimum(best, once), once[:, NEXT] + INSERT)
        v[k] = np.where(real[k][:, None], np.minimum(best, FAR), v[k + 1])
    return v


def trace(v: np.ndarray, initial: np.ndarray, free: np.ndarray, late: np.ndarray, real: np.ndarray, state: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(inserts before, edit as a place in LETTERS, state before both) of each turn (T, C), and the states behind the last."""
    t, c = initial.shape
    inserts, edits, before = (np.zeros((t, c), np.int8) for _ in range(3))
    at, state = np.arange(c), state.astype(np.int64)
    for k in range(t):
        before[k] = state
        delete, kept, _ = _row_costs(v[k + 1], initial[k], free[k], late[k])
        for _ in range(2):  # more than two inserts in a row come back to a state
            here = v[k][at, state]
            more = real[k] & (delete[at, state] != here) & (v[k][at, NEXT[state]] + INSERT == here)
            inserts[k] += more
            state = np.where(more, NEXT[state], state)
        here = v[k][at, state]
        gone, keep = delete[at, state] == here, kept[at, state] == here
        edits[k] = np.where(gone, 0, np.where(keep, 1, 2))
        after = np.where(gone, state, np.where(keep, _after_keep(initial[k])[at, state], NEXT[state]))
        state = np.where(real[k], after, state)
    return inserts, edits, before, state


def _initials(roles) -> np.ndarray:
    return np.array([INITIALS.get(r[:1], 0) for r in roles], np.int8)


def _illegal(first: np.ndarray, second: np.ndarray) -> np.ndarray:
    return ~(((first == SYSTEM) & (second == USER)) | ((first == USER) & (second == ASSISTANT)) | ((first == ASSISTANT) & (second == USER)))


def _inserted(state: int, n: int) -> tuple[list[tuple[str, str]], int]:
    """(role, text) of ``n`` inserted rows, and the state behind them."""
    out = []
    for _ in range(n):
        state = int(NEXT[state])
        out.append((NAMES[state], ""))
    return out, state


def repaired_rows(state: int, inserts: int, edit: int, role: str, text: str) -> list[tuple[str, str]]:
    """What one row of the input gives: inserted rows, then itself unless it is deleted."""
    out, state = _inserted(state, inserts)
    if edit:
        out.append((role if edit == 1 else NAMES[int(NEXT[state])], text))
    return out


# --------------------------------------------------------------------------- rows


def rows_of(conversations: DataFrame, damage: bool = False) -> DataFrame:
    """conv_id, turn, role, text, the columns that order equal turns, and what is blank or lacks an end.

    With ``damage``, crc32 of ``conv_id:turn`` modulo 20 tells what befalls a row: 0 drops it, 1 empties its text, 2 removes ``[.!?]``, 3 repeats
    it, 4 makes it the user's. Dropped rows are marked, so that their conversation is still known.
    """
    space = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    kind = F.crc32(F.concat(space("conv_id"), F.lit(":"), space("turn"))) % 20 if damage else F.lit(9).cast("long")
    rows = conversations.select("conv_id", F.col("turn").cast("long").alias("turn"), space("role").alias("old_role"), space("text").alias("old_text"), kind.alias("kind"))
    text = F.when(F.col("kind") <= 1, F.lit("")).when(F.col("kind") == 2, F.translate("old_text", ".!?", "")).otherwise(F.col("old_text"))
    role = F.when(F.col("kind") == 4, F.lit("user")).otherwise(F.col("old_role"))
    copies = F.explode(F.when(F.col("kind") == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0))))
    rows = rows.select("conv_id", "turn", role.alias("role"), text.alias("text"), (F.col("kind") == 0).alias("dropped"), "old_role", F.left(F.col("old_text"), F.lit(64)).alias("old_start"), F.xxhash64("old_text").alias("old_hash"), copies.alias("copy"))
    last = F.right(F.rtrim(F.col("text"), F.lit(SPACES)), F.lit(1))
    return rows.withColumn("blank", last == "").withColumn("unended", ~last.isin("", ".", "!", "?"))


def _order(*before: str) -> list[Column]:
    return [*(F.col(c) for c in before), F.col("turn").asc_nulls_first(), F.col("old_role"), F.col("old_start"), F.col("old_hash"), F.col("copy")]


def _heads(ids: pa.Array) -> np.ndarray:
    """The places where another conv_id begins."""
    if len(ids) < 2:
        return np.zeros(len(ids), np.int64)
    a, b = ids[:-1], ids[1:]
    same = pc.or_(pc.fill_null(pc.equal(a, b), False), pc.and_(pc.is_null(a), pc.is_null(b)))
    return np.concatenate(([0], np.flatnonzero(~np.asarray(same)) + 1))


def _gaps(turns: np.ndarray, held: np.ndarray) -> int | None:
    """Of ascending turns, those that are ``held``."""
    turns = turns[held]
    if not len(turns):
        return 0
    gaps = int(turns[-1]) - int(turns[0]) + 1 - (1 + int((turns[1:] != turns[:-1]).sum()))
    return gaps if gaps < 1 << 63 else None


class Piece:
    """Whole conversations in order, and their repair."""

    def __init__(self, table: pa.Table):
        table = table.combine_chunks()
        self.ids = table.column("conv_id").combine_chunks() if table.num_rows else table.column("conv_id")
        heads = _heads(self.ids)
        self.first = heads
        conv = np.zeros(table.num_rows, np.int64)
        conv[heads[1:]] = 1
        conv = np.cumsum(conv)
        stays = ~np.asarray(table.column("dropped"))
        rows = table.filter(pa.array(stays))
        self.conv, n = conv[stays], len(heads)
        self.roles, self.texts = rows.column("role").to_pylist(), rows.column("text").to_pylist()
        self.begins = np.searchsorted(self.conv, np.arange(n + 1))
        self.lengths = np.diff(self.begins)
        turn = rows.column("turn").combine_chunks()
        self.turn_held = np.asarray(turn.is_valid())
        self.turn = np.asarray(turn.fill_null(0))
        self.initial = _initials(self.roles)
        blank = np.asarray(rows.column("blank"))
        again = pd.DataFrame({"conv": self.conv, "role": self.roles, "text": self.texts}).duplicated().to_numpy() & ~blank
        self.blank, self.again, self.late = blank, again, np.asarray(rows.column("unended")) & ~blank & ~again
        self._repair()

    def _repair(self) -> None:
        n, rows = len(self.lengths), len(self.conv)
        self.inserts, self.edits, self.before = (np.zeros(rows, np.int8) for _ in range(3))
        self.cost, self.last = np.zeros(n, np.int64), np.zeros(n, np.int64)
        bucket = np.ceil(np.log2(np.maximum(self.lengths, 1))).astype(int)
        for b in np.unique(bucket[self.lengths > 0]):
            own = np.flatnonzero((bucket == b) & (self.lengths > 0))
            t = np.arange(1 << b)[:, None]
            real = t < self.lengths[own]
            place = np.where(real, self.begins[own] + t, 0)
            arrays = self.initial[place], (~self.blank & ~self.again)[place], self.late[place], real
            v = backward(*arrays, np.broadcast_to(END, (len(own), 4)))
            inserts, edits, before, state = trace(v, *arrays, np.zeros(len(own), np.int64))
            self.inserts[place[real]], self.edits[place[real]], self.before[place[real]] = inserts[real], edits[real], before[real]
            self.cost[own], self.last[own] = v[0, :, NOTHING], state

    def sums(self, flags: np.ndarray) -> np.ndarray:
        return np.diff(np.concatenate(([0], np.cumsum(flags)))[self.begins])

    def conversation(self, k: int) -> tuple[str, list[tuple[str, str]]]:
        """(audit, repaired rows) of one of them."""
        audit, out = [], []
        for r in range(self.begins[k], self.begins[k + 1]):
            more, edit = int(self.inserts[r]), int(self.edits[r])
            audit.append("I" * more + LETTERS[edit])
            out += repaired_rows(int(self.before[r]), more, edit, self.roles[r], self.texts[r])
        n = int(END[self.last[k]]) // INSERT
        audit.append("I" * n)
        return "".join(audit), out + _inserted(int(self.last[k]), n)[0]

    def report(self) -> pa.RecordBatch:
        crossing = np.zeros(len(self.conv), bool)
        crossing[1:] = (self.conv[1:] == self.conv[:-1]) & _illegal(self.initial[:-1], self.initial[1:])
        told = [self.conversation(k) for k in range(len(self.lengths))]
        gaps = [_gaps(self.turn[a:b], self.turn_held[a:b]) for a, b in zip(self.begins[:-1], self.begins[1:])]
        counts = [self.sums(f).astype(np.int64) for f in (self.blank, self.again, self.late, crossing)]
        hashes = [hashlib.sha256("\n".join(f"{role}:{text}" for role, text in out).encode()).hexdigest() for _, out in told]
        columns = [self.ids.take(pa.array(self.first)), pa.array(gaps, pa.int64()), *map(pa.array, counts), pa.array(self.cost), pa.array([a for a, _ in told], pa.string()), pa.array(hashes, pa.string())]
        return pa.RecordBatch.from_arrays(columns, ["conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"])

    def rows(self) -> pa.RecordBatch:
        """conv_id, number, role, text of the repaired rows."""
        of, number, roles, texts = [], [], [], []
        for k in range(len(self.lengths)):
            for j, (role, text) in enumerate(self.conversation(k)[1]):
                of.append(self.first[k])
                number.append(j)
                roles.append(role)
                texts.append(text)
        return pa.RecordBatch.from_arrays([self.ids.take(pa.array(of, pa.int64())), pa.array(number, pa.int64()), pa.array(roles, pa.string()), pa.array(texts, pa.string())], ["conv_id", "number", "role", "text"])


def _pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[Piece]:
    """Whole conversations of a stream that is sorted by conv_id, some at a time."""
    held: list[pa.RecordBatch] = []
    rows = size = 0
    for batch in batches:
        if batch.num_rows == 0:
            continue
        held.append(batch)
        rows, size = rows + batch.num_rows, size + batch.nbytes
        if rows >= BATCH_ROWS or size >= BATCH_BYTES:
            table = pa.Table.from_batches(held).combine_chunks()
            last = int(_heads(table.column("conv_id").combine_chunks())[-1])
            if last:
                yield Piece(table.slice(0, last))
            rest = table.slice(last).combine_chunks()
            held, rows, size = rest.to_batches(), rest.num_rows, 0
    if held:
        yield Piece(pa.Table.from_batches(held))


class Repair:
    """The conversations of one table, audited and repaired."""

    def __init__(self, rows: DataFrame, long_rows: int = LONG_ROWS, long_chars: int = LONG_CHARS, block_rows: int = BLOCK_ROWS):
        """``rows`` are those of ``rows_of``."""
        self.spark, self.all, self.block_rows = rows.sparkSession, rows, block_rows
        self.id_type = rows.schema["conv_id"].dataType
        sizes = rows.groupBy("conv_id").agg(F.count(F.lit(1)).alias("n"), F.sum(F.length("text")).alias("chars"))
        self.long = small_or_not(sizes.filter((F.col("n") > long_rows) | (F.col("chars") > long_chars)).select(F.col("conv_id").alias("long_id"), F.lit(True).alias("is_long")))
        self.any_long = not self.long.isEmpty()
        marked = rows.join(self.long, F.col("conv_id").eqNullSafe(F.col("long_id")), "left") if self.any_long else rows
        self.short = marked.filter("is_long is null").drop("long_id", "is_long") if self.any_long else rows
        self.tall = marked.filter("is_long and not dropped").drop("long_id", "is_long") if self.any_long else None

    def _columns(self, schema: str) -> T.StructType:
        return T.StructType([T.StructField("conv_id", self.id_type), *T._parse_datatype_string(schema).fields])

    def _short(self, make, schema: str) -> DataFrame:
        rows = self.short.repartition(shuffle_partitions(self.spark), "conv_id").sortWithinPartitions(*_order("conv_id"))
        rows = rows.select("conv_id", "turn", "role", "text", "dropped", "blank", "unended")
        return map_batches(rows, lambda batches: (make(p) for p in _pieces(batches)), self._columns(schema))

    def report(self) -> DataFrame:
        """A row for each conversation: faults, cost, edits and the hash of its repaired lines."""
        found = self._short(Piece.report, _REPORT)
        return found.unionByName(self._long_report()) if self.any_long else found

    def repaired(self) -> DataFrame:
        """conv_id, number, role, text of the repaired conversations."""
        found = self._short(Piece.rows, "number long, role string, text string")
        if not self.any_long:
            return found
        rows = self._long_edits().select("conv_id", "pos", F.posexplode("out").alias("k", "o")).select("conv_id", "pos", "k", "o.role", "o.text")
        rows = self._numbered(rows.withColumnRenamed("pos", "at"), [F.col("conv_id"), F.col("at"), F.col("k")])
        return found.unionByName(rows.select("conv_id", F.col("pos").alias("number"), "role", "text"))

    # ---------------------------------------------------------------- long conversations

    def _kept(self, rows: DataFrame, name: str) -> DataFrame:
        path = f"{shared_folder(self.spark)}/conversations-{uuid.uuid4().hex}/{name}"
        rows.write.parquet(path)
        return self.spark.read.parquet(path)

    def _numbered(self, rows: DataFrame, order: list) -> DataFrame:
        """``rows`` and pos, their place in their conversation, by a sort by range: no conversation is one task's."""
        n = shuffle_partitions(self.spark)
        spread = rows.withColumn("tie", F.monotonically_increasing_id()).repartitionByRange(n, *order, "tie").sortWithinPartitions(*order).drop("tie")
        rows = self._kept(spread.withColumn("own", F.monotonically_increasing_id()), "numbered").withColumn("part", F.shiftright("own", 33))
        parts = rows.groupBy("conv_id", "part").agg(F.count(F.lit(1)).alias("n"), F.min("own").alias("least"))  # a row for each task that has rows of it
        before = "coalesce(sum(n) over (partition by conv_id order by part rows between unbounded preceding and 1 preceding), 0)"
        parts = small_or_not(parts.select(F.col("conv_id").alias("id"), F.col("part").alias("of_part"), (F.expr(before) - F.col("least")).alias("shift")))
        rows = rows.join(parts, F.col("conv_id").eqNullSafe(F.col("id")) & (F.col("part") == F.col("of_part")))
        return rows.withColumn("pos", F.col("own") + F.col("shift")).drop("own", "part", "id", "of_part", "shift")

    def _long_rows(self) -> DataFrame:
        """Every row of the long ones with pos, block, again (role and text there before) and late."""
        rows = self._kept(self._numbered(self.tall, _order("conv_id")), "long")
        told = F.sha2(F.concat(F.length("role").cast("string"), F.lit(":"), F.col("role"), F.col("text")), 256)
        firsts = rows.groupBy(F.col("conv_id").alias("id"), told.alias("told")).agg(F.min("pos").alias("first_pos"))
        rows = rows.join(firsts.drop("told"), F.col("conv_id").eqNullSafe(F.col("id")) & (F.col("pos") == F.col("first_pos")), "left")
        again = F.col("first_pos").isNull() & ~F.col("blank")
        rows = rows.withColumn("again", again).withColumn("late", F.col("unended") & ~F.col("blank") & ~again)
        return self._kept(rows.withColumn("block", F.expr(f"pos div {self.block_rows}")).select("conv_id", "turn", "role", "text", "blank", "again", "late", "pos", "block"), "judged")

    def _long_edits(self) -> DataFrame:
        """conv_id, pos, audit, out (repaired rows) of each row of the long ones, what is inserted at the end with the last."""
        self.judged = self._long_rows()
        small = self.judged.select("conv_id", "block", "pos", F.left("role", F.lit(1)).alias("initial"), "blank", "again", "late")
        keys = ("conv_id", "block")

        def arrays(pdf: pd.DataFrame) -> list[np.ndarray]:
            column = lambda v: np.asarray(v)[:, None]
            return [column(_initials(pdf["initial"])), column(~(pdf["blank"] | pdf["again"])), column(pdf["late"]), np.ones((len(pdf), 1), bool)]

        def costs(pdf: pd.DataFrame) -> pd.DataFrame:
            pdf = pdf.sort_values("pos")
            four = [np.repeat(a, 4, axis=1) for a in arrays(pdf)]
            v = backward(*four, np.where(np.eye(4, dtype=bool), 0, FAR))
            initial = four[0][:, 0]
            return pdf[["conv_id", "block"]].head(1).assign(costs=[v[0].T.ravel().tolist()], illegal=int(_illegal(initial[:-1], initial[1:]).sum()), head=int(initial[0]), tail=int(initial[-1]), **{c: int(pdf[c].sum()) for c in ("blank", "again", "late")})

        def behind(pdf: pd.DataFrame) -> pd.DataFrame:
            pdf = pdf.sort_values("block")
            out, v = [], END
            for c in pdf["costs"].to_list()[::-1]:
                out.append(v)
                v = np.minimum((np.reshape(c, (4, 4)) + v).min(axis=1), FAR)
            crossing = _illegal(pdf["tail"].to_numpy()[:-1], pdf["head"].to_numpy()[1:]).sum()
            one = np.arange(len(pdf)) == 0  # sums of the conversation stand in its first block
            return pdf[["conv_id", "block", "blank", "again", "late"]].assign(behind=[x.tolist() for x in out[::-1]], illegal=pdf["illegal"] + one * crossing, cost=one * v[NOTHING])

        def exits(pdf: pd.DataFrame) -> pd.DataFrame:
            pdf = pdf.sort_values("pos")
            four = [np.repeat(a, 4, axis=1) for a in arrays(pdf)]
            end = np.broadcast_to(np.array(pdf["behind"].iloc[0]), (4, 4))
            state = trace(backward(*four, end), *four, np.arange(4))[3]
            return pdf[["conv_id", "block"]].head(1).assign(exits=[state.tolist()])

        def entries(pdf: pd.DataFrame) -> pd.DataFrame:
            pdf = pdf.sort_values("block")
            out, state = [], NOTHING
            for x in pdf["exits"]:
                out.append(state)
                state = int(x[state])
            return pdf[["conv_id", "block"]].assign(entry=out, is_last=np.arange(len(pdf)) == len(pdf) - 1)

        def edits(pdf: pd.DataFrame) -> pd.DataFrame:
            pdf = pdf.sort_values("pos")
            one, first = arrays(pdf), pdf.iloc[0]
            v = backward(*one, np.array(first["behind"])[None, :])
            inserts, edit, before, state = trace(v, *one, np.array([first["entry"]]))
            after = np.zeros(len(pdf), np.int8)
            after[-1] = END[state[0]] // INSERT if first["is_last"] else 0
            return pdf[["conv_id", "pos"]].assign(inserts=inserts[:, 0], edit=edit[:, 0], before=before[:, 0], after=after, final=int(state[0]))

        blocks = self._kept(small.groupBy(*keys).applyInPandas(costs, self._columns("block long, costs array<long>, illegal long, head int, tail int, blank long, again long, late long")), "blocks")
        self.sums = self._kept(blocks.groupBy("conv_id").applyInPandas(behind, self._columns("block long, blank long, again long, late long, behind array<long>, illegal long, cost long")), "behind")
        same = lambda rows, more: rows.join(more.withColumnRenamed("conv_id", "id").withColumnRenamed("block", "of_block"), F.col("conv_id").eqNullSafe(F.col("id")) & (F.col("block") == F.col("of_block"))).drop("id", "of_block")
        rows = same(small, self.sums.select("conv_id", "block", "behind"))
        ends = self._kept(rows.groupBy(*keys).applyInPandas(exits, self._columns("block long, exits array<int>")), "exits")
        known = ends.groupBy("conv_id").applyInPandas(entries, self._columns("block long, entry int, is_last boolean"))
        found = same(rows, known).groupBy(*keys).applyInPandas(edits, self._columns("pos long, inserts int, edit int, before int, after int, final int"))
        rows = self.judged.select("conv_id", "pos", "role", "text").join(found.withColumnRenamed("conv_id", "id").withColumnRenamed("pos", "at"), F.col("conv_id").eqNullSafe(F.col("id")) & (F.col("pos") == F.col("at")))

        def told(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                columns = (batch.column(c).to_pylist() for c in ("role", "text", "inserts", "edit", "before", "after", "final"))
                audits, out = [], []
                for role, text, inserts, edit, before, after, final in zip(*columns):
                    audits.append("I" * inserts + str(LETTERS[edit]) + "I" * after)
                    rows = repaired_rows(before, inserts, edit, role, text) + _inserted(final, after)[0]
                    out.append([{"role": r, "text": t} for r, t in rows])
                kind = pa.list_(pa.struct([("role", pa.string()), ("text", pa.string())]))
                yield pa.RecordBatch.from_arrays([batch.column("conv_id"), batch.column("pos"), pa.array(audits, pa.string()), pa.array(out, kind)], ["conv_id", "pos", "audit", "out"])

        return map_batches(rows.drop("id", "at"), told, self._columns("pos long, audit string, out array<struct<role:string,text:string>>"))

    def _long_report(self) -> DataFrame:
        edits = self._long_edits()

        def stream(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            """Audit and hash of each conversation, a row at a time in order."""
            own, audit, told, any_line = None, [], hashlib.sha256(), False
            result = lambda: pa.RecordBatch.from_arrays([own, pa.array(["".join(audit)]), pa.array([told.hexdigest()])], ["conv_id", "audit", "repaired_sha256"])
            for batch in batches:
                heads = set(_heads(batch.column("conv_id")).tolist())
                audits, out = batch.column("audit").to_pylist(), batch.column("out").to_pylist()
                for k in range(batch.num_rows):
                    if k in heads and (own is None or not own.equals(batch.column("conv_id").slice(k, 1))):
                        if own is not None:
                            yield result()
                        own, audit, told, any_line = batch.column("conv_id").slice(k, 1), [], hashlib.sha256(), False
                    audit.append(audits[k])
                    for o in out[k]:
                        told.update(("\n" * any_line + f"{o['role']}:{o['text']}").encode())
                        any_line = True
            if own is not None:
                yield result()

        ordered = edits.repartition(shuffle_partitions(self.spark), "conv_id").sortWithinPartitions("conv_id", "pos")
        hashed = map_batches(ordered, stream, self._columns("audit string, repaired_sha256 string")).withColumnRenamed("conv_id", "hashed_id")
        sums = self.sums.groupBy(F.col("conv_id").alias("sum_id")).agg(*(F.sum(c).alias(n) for c, n in (("blank", "blank"), ("again", "duplicate"), ("late", "truncated"), ("illegal", "illegal"), ("cost", "cost"))))
        turns = self.judged.filter("turn is not null").groupBy("conv_id", "turn").count().groupBy(F.col("conv_id").alias("turn_id")).agg(F.expr("try_subtract(try_add(try_subtract(max(turn), min(turn)), 1L), count(1))").alias("gaps"), F.lit(True).alias("any_turn"))
        same = lambda c: F.col("long_id").eqNullSafe(F.col(c))
        rows = self.long.join(sums, same("sum_id"), "left").join(hashed, same("hashed_id"), "left").join(turns, same("turn_id"), "left")
        zero = [F.coalesce(c, F.lit(0).cast("long")).alias(c) for c in ("blank", "duplicate", "truncated", "illegal", "cost")]
        gaps = F.when(F.col("any_turn").isNull(), F.lit(0).cast("long")).otherwise(F.col("gaps")).alias("gaps")
        return rows.select(F.col("long_id").alias("conv_id"), gaps, *zero, F.coalesce("audit", F.lit("")).alias("audit"), F.coalesce("repaired_sha256", F.sha2(F.lit(""), 256)).alias("repaired_sha256"))


def op13_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    return Repair(rows_of(read_table(spark, sf_dir, "conversations"), damage=True)).report()

"""Removal of passages that stand elsewhere too, by level-wise doubling of repeated windows.

A window is ``least`` consecutive words of one document. Windows repeated at one length alone are extended to twice it:

* Level ``least / 2``: every window of ``least`` words has an anchor, the half window of least hash in it. Equal windows
  have equal anchors at the same place, so anchors (about one word in six) are counted in place of all half windows.
* Level ``least``: windows whose anchor is repeated, and no others, are counted by 128 bits of hash.
* Levels 2, 4, 8 … times ``least``: a window is a candidate where both its halves are repeated; its key is made of theirs, so no
  text is read again. The levels end when no candidate survives. They tell each document's longest repeat.

A level (``counted``) is one aggregation by key, in which the first place and whether there are more stay, so a passage that a
third of all documents hold is a row per task. What goes back to documents are the *first* places, one a key, not the
repeats: a document's repeats are its candidates without those, so no key's rows ever meet.

Documents of equal text are found first, by 128 bits of hash: the first stands for all, and its copies go whole.

Order is by doc_id (null first), then by a hash of the text for several texts of one doc_id; rows that repeat doc_id and
text count each, the first of them stays. Words are longest runs of ``[^\\x20\\x09-\\x0D]``, unchanged. Null and empty texts have none; texts
of fewer than ``least`` words lose none. An empty table gives no rows. Further columns are kept, whatever their names.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import WordBlock, as_row, cut, drop_folder, free_shuffles, map_batches, mix, read_table, shared_folder, shuffle_partitions, text_blocks, whole_text

LEAST = 20
#: Window starts whose anchors are looked for at a time.
STARTS = 1 << 16
_KEY = ["doc_id", "d1", "d2"]
_STATE = "rank long, at array<int>, ka array<long>, kb array<long>"


def _pair(first: np.ndarray, second: np.ndarray, salt: int) -> np.ndarray:
    """The hash of a window from those of its halves."""
    return mix(first * np.uint64(0x8CB92BA72F3D8DD7) + mix(second + np.uint64(salt)))


class Windows:
    """The half windows of a block of texts, and the windows made of them."""

    def __init__(self, block: WordBlock, least: int):
        self.block, self.half, self.least = block, least // 2, least
        words, m = block.hashes, len(block.hashes) - least + 1
        self.starts = np.flatnonzero(block.text_of[:m] == block.text_of[least - 1 :]) if m > 0 else np.empty(0, np.int64)
        n = max(0, len(words) - self.half + 1)
        self.a, self.b = np.zeros(n, np.uint64), np.zeros(n, np.uint64)
        other = mix(words ^ np.uint64(0x5851F42D4C957F2D))
        for k in range(self.half if n else 0):
            self.a = self.a * np.uint64(0xA0761D6478BD642F) + words[k : k + n]
            self.b = self.b * np.uint64(0xE7037ED1A0B428DB) + other[k : k + n]
        self.a, self.b = mix(self.a), mix(self.b)

    def anchors(self) -> np.ndarray:
        """For each window, the place of its leftmost half window of least hash."""
        out = np.empty(len(self.starts), np.int64)
        if len(out):
            inner = np.lib.stride_tricks.sliding_window_view(self.a, self.least - self.half + 1)
            for at in range(0, len(out), STARTS):
                s = self.starts[at : at + STARTS]
                out[at : at + STARTS] = s + inner[s].argmin(axis=1)
        return out

    def keys(self, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        return tuple(_pair(h[starts], h[starts + self.half], salt).view(np.int64) for h, salt in ((self.a, 1), (self.b, 2)))

    def per_text(self, places: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(offsets, places within their text) of ascending places in the block."""
        offsets = np.searchsorted(places, self.block.word_offsets)
        return offsets, (places - np.repeat(self.block.word_offsets[:-1], np.diff(offsets))).astype(np.int32)


def _lists(offsets: np.ndarray, values: np.ndarray) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(offsets.astype(np.int32)), pa.array(values))


def _ints(column: pa.Array) -> list[np.ndarray]:
    """The lists of a column; null is empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    return [np.empty(0, np.int64) if not v.is_valid else v.values.to_numpy(zero_copy_only=False) for v in column]


class SubstringDedup:
    """The repeated windows of one table."""

    def __init__(self, docs: DataFrame, least: int = LEAST, longest: bool = True):
        """Without ``longest`` the levels beyond ``least`` are left out: nothing that goes depends on them."""
        if least < 2 or least % 2:
            raise ValueError("the least number of words must be even, two or more")
        self.docs, self.spark, self.least, self.longest = docs, docs.sparkSession, least, longest
        self.folder = f"{shared_folder(self.spark)}/repeats-{uuid.uuid4().hex}"

    def _kept(self, rows: DataFrame, name: str) -> DataFrame:
        free_shuffles(self.spark)
        rows.write.parquet(f"{self.folder}/{name}")
        return self.spark.read.parquet(f"{self.folder}/{name}")

    def texts(self, *more) -> DataFrame:
        """doc_id, d1, d2 (the text's hash), own_text and ``more`` columns of every row."""
        text = whole_text()
        return self.docs.select("doc_id", F.xxhash64(text).alias("d1"), F.xxhash64(F.lit("second"), text).alias("d2"), text.alias("own_text"), *more)

    def firsts(self) -> DataFrame:
        """(doc_id, d1, d2, rank, copies): the first document of each text, numbered in order, and how many rows have its text."""
        first = F.when(F.max(F.col("doc_id").isNull()), F.lit(None)).otherwise(F.min("doc_id"))
        rows = self.texts().groupBy("d1", "d2").agg(first.alias("doc_id"), F.count(F.lit(1)).alias("copies")).select(*_KEY, "copies")
        rows = rows.repartitionByRange(shuffle_partitions(self.spark), *_KEY).sortWithinPartitions(*_KEY).withColumn("row", F.monotonically_increasing_id())
        rows = cut(rows).withColumn("part", F.shiftright("row", 33))
        counts = sorted((r["part"], r["count"]) for r in rows.groupBy("part").count().collect())  # a row per partition
        before, offsets = 0, []
        for part, n in counts:
            offsets.append((part, before - (part << 33)))
            before += n
        self.n_texts = before
        offsets = self.spark.createDataFrame(offsets, "part long, shift long")
        return rows.join(F.broadcast(offsets), "part").select(*_KEY, (F.col("row") + F.col("shift")).alias("rank"), "copies")

    # ---------------------------------------------------------------- levels

    def anchors(self) -> DataFrame:
        """(doc_id, d1, d2, n_words, at, ka) of every row: the anchors of its windows."""
        least = self.least

        def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for first, end, data, offsets in text_blocks(batch.column("own_text")):
                    windows = Windows(WordBlock(data, offsets), least)
                    places = np.unique(windows.anchors())
                    cuts, at = windows.per_text(places)
                    keys = [batch.column(c).slice(first, end - first) for c in _KEY]
                    yield pa.RecordBatch.from_arrays([*keys, pa.array(windows.block.n_words), _lists(cuts, at), _lists(cuts, windows.a[places].view(np.int64))], [*_KEY, "n_words", "at", "ka"])

        kind = self.docs.schema["doc_id"].dataType.simpleString()
        return map_batches(self.texts(), work, f"doc_id {kind}, d1 long, d2 long, n_words long, at array<int>, ka array<long>")

    def windows(self, marked: DataFrame) -> DataFrame:
        """The state of level ``least``: windows whose anchor is among ``marked`` (doc_id, d1, d2, rank, at)."""
        least = self.least
        marked = marked.select(F.col("doc_id").alias("id"), F.col("d1").alias("e1"), F.col("d2").alias("e2"), "rank", "at")
        same = F.col("doc_id").eqNullSafe(F.col("id")) & (F.col("d1") == F.col("e1")) & (F.col("d2") == F.col("e2"))
        rows = self.texts().join(marked, same).select("rank", "at", "own_text")

        def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                marks, ranks = _ints(batch.column("at")), batch.column("rank")
                for first, end, data, offsets in text_blocks(batch.column("own_text")):
                    windows = Windows(WordBlock(data, offsets), least)
                    begins = windows.block.word_offsets
                    held = np.zeros(begins[-1] + 1, bool)
                    for k in range(first, end):
                        held[begins[k - first] + marks[k]] = True
                    starts = windows.starts[held[windows.anchors()]]
                    cuts, at = windows.per_text(starts)
                    ka, kb = windows.keys(starts)
                    yield pa.RecordBatch.from_arrays([ranks.slice(first, end - first), *(_lists(cuts, v) for v in (at, ka, kb))], ["rank", "at", "ka", "kb"])

        found = map_batches(rows, work, _STATE).filter(F.size("at") > 0)
        return found.dropDuplicates(["rank"]) if self.repeated_rows else found

    def counted(self, state: DataFrame, *keys: str) -> DataFrame:
        """``state`` and told: the places of it that are the first of their key, as ~place where there are no others."""
        rows = state.select("rank", F.explode(F.arrays_zip("at", *keys)).alias("w"))
        place = F.col("rank") * F.lit(self.span) + F.col("w.at")
        first = rows.select(place.alias("place"), *(F.col(f"w.{k}").alias(k) for k in keys)).groupBy(*keys).agg(F.min("place").alias("place"), F.count(F.lit(1)).alias("n"))
        at = F.expr(f"cast(place % {self.span} as int)")
        told = first.select(F.expr(f"place div {self.span}").alias("rank"), F.when(F.col("n") > 1, at).otherwise(F.bitwise_not(at)).alias("told"))
        return state.join(told.groupBy("rank").agg(F.collect_list("told").alias("told")), "rank", "left")  # as long as a document's text

    def settled(self, counted: DataFrame, length: int) -> DataFrame:
        """(rank, repeated, later, at, ka, kb): places whose window is repeated, those of them that aren't its first, and the
        candidates of twice the length, none without ``self.longest``."""
        go_on = self.longest

        def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                columns = [_ints(batch.column(c)) for c in ("at", "ka", "kb", "told")]
                for k, (at, ka, kb, told) in enumerate(zip(*columns)):
                    again = ~np.isin(at, ~told[told < 0])
                    at, ka, kb = at[again], ka[again].view(np.uint64), kb[again].view(np.uint64)
                    later = at[~np.isin(at, told[told >= 0])]
                    second = np.searchsorted(at, at + length)
                    both = np.flatnonzero((second < len(at)) & go_on)
                    both = both[at[second[both]] == at[both] + length]
                    second = second[both]
                    out = [at, later, at[both], _pair(ka[both], ka[second], 3).view(np.int64), _pair(kb[both], kb[second], 4).view(np.int64)]
                    kinds = [pa.int32()] * 3 + [pa.int64()] * 2
                    yield pa.RecordBatch.from_arrays([batch.column("rank").slice(k, 1), *(_lists(np.array([0, len(v)]), v.astype(t.to_pandas_dtype())) for v, t in zip(out, kinds))], ["rank", "repeated", "later", "at", "ka", "kb"])

        return map_batches(counted, work, "rank long, repeated array<int>, later array<int>, at array<int>, ka array<long>, kb array<long>")

    def spans(self) -> DataFrame:
        """(doc_id, d1, d2, copies, later, longest) of each first document: places of windows that are there earlier, and the
        longest length, of ``least`` doubled again and again, at which it holds a window that is there elsewhere; 0 without ``self.longest``."""
        firsts = self._kept(self.firsts(), "firsts")
        rows = self._kept(self.anchors(), "anchors")
        self.repeated_rows = not rows.groupBy(*_KEY).count().filter("count > 1").isEmpty()
        self.span = (rows.agg(F.max("n_words").alias("n")).first()["n"] or 0) + 1
        if self.span * (self.n_texts + 1) >= 1 << 63:
            raise ValueError(f"{self.n_texts} texts of up to {self.span} words are more places than a long numbers")
        same = [F.col("doc_id").eqNullSafe(F.col("id")), F.col("d1") == F.col("e1"), F.col("d2") == F.col("e2")]
        named = firsts.select(F.col("doc_id").alias("id"), F.col("d1").alias("e1"), F.col("d2").alias("e2"), "rank")
        state = rows.filter(F.size("at") > 0).join(named, same[0] & same[1] & same[2]).select("rank", "at", "ka")
        state = self._kept(state.dropDuplicates(["rank"]) if self.repeated_rows else state, "level-half")
        # repeated anchors: candidates that aren't a key's only place
        unique = F.expr("transform(filter(coalesce(told, array()), t -> t < 0), t -> ~t)")
        drop_folder(self.spark, f"{self.folder}/anchors")
        marked = self._kept(self.counted(state, "ka").select("rank", F.array_except("at", unique).alias("at")).filter(F.size("at") > 0), "marked")
        drop_folder(self.spark, f"{self.folder}/level-half")
        state = self._kept(self.windows(firsts.join(marked, "rank")), f"level-{self.least}")
        length, later, longest, read = self.least, None, [], f"level-{self.least}"
        while True:
            done = self._kept(self.settled(self.counted(state, "ka", "kb"), length), f"settled-{length}")
            drop_folder(self.spark, f"{self.folder}/{read}")
            read = f"settled-{length}"
            if later is None:
                later = self._kept(done.filter(F.size("later") > 0).select("rank", "later"), "later")
            if not self.longest:
                return firsts.join(later, "rank", "left").select(*_KEY, "copies", "later", F.lit(0).cast("long").alias("longest"))
            longest.append(self._kept(done.filter(F.size("repeated") > 0).select("rank", F.lit(length).cast("long").alias("length")), f"held-{length}"))
            state = done.select("rank", "at", "ka", "kb").filter(F.size("at") > 0)
            if state.isEmpty():
                break
            length *= 2
        held = longest[0]
        for more in longest[1:]:
            held = held.unionByName(more)
        held = held.groupBy("rank").agg(F.max("length").alias("longest"))
        return firsts.join(later, "rank", "left").join(held, "rank", "left").select(*_KEY, "copies", "later", F.coalesce("longest", F.lit(0)).cast("long").alias("longest"))

    # ---------------------------------------------------------------- result

    def result(self) -> DataFrame:
        """row (all columns of the table), n_words, n_removed, spans ((first word, end) of what went), kept_text, longest_repeat (not without ``self.longest``) of every row."""
        least = self.least
        fates = self.spans().select(F.col("doc_id").alias("id"), F.col("d1").alias("e1"), F.col("d2").alias("e2"), "copies", "later", "longest")
        same = F.col("doc_id").eqNullSafe(F.col("id")) & (F.col("d1") == F.col("e1")) & (F.col("d2") == F.col("e2"))
        rows = self.texts(as_row(self.docs)).join(fates, same, "left")

        def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                later, stands = _ints(batch.column("later")), batch.column("copies").is_valid().to_numpy(zero_copy_only=False)
                several = np.array([c or 2 for c in batch.column("copies").to_pylist()], np.int64) > 1
                longest = np.array([v or 0 for v in batch.column("longest").to_pylist()], np.int64)
                for first, end, data, offsets in text_blocks(batch.column("own_text")):
                    block = WordBlock(data, offsets)
                    n_words, begins = block.n_words, block.word_offsets
                    steps = np.zeros(begins[-1] + 1, np.int64)
                    for k in range(first, end):
                        own = begins[k - first]
                        if stands[k]:
                            if len(later[k]):
                                steps[own + later[k]] += 1  # places are distinct
                                steps[own + later[k] + least] -= 1
                        elif n_words[k - first] >= least:
                            steps[own] += 1
                            steps[begins[k - first + 1]] -= 1
                    gone = np.cumsum(steps[:-1]) > 0
                    yield _told(batch, first, end, block, gone, np.where(several[first:end], _doubled(n_words, least), longest[first:end]))

        kind = self.docs.schema.simpleString()
        found = map_batches(rows.select("row", "own_text", "copies", "later", "longest"), work, f"row {kind}, n_words long, n_removed long, spans array<struct<first:int,end:int>>, kept_text string, longest_repeat long")
        found = self._first_of_repeated_rows(found) if self.repeated_rows else found
        return found if self.longest else found.drop("longest_repeat")

    def _first_of_repeated_rows(self, found: DataFrame) -> DataFrame:
        """Rows that repeat doc_id and text: one of them stays, the others are its copies."""
        key = found.select("*", F.col("row.doc_id").alias("id"), F.xxhash64(F.coalesce("row.text", F.lit(""))).alias("e1"), F.xxhash64(F.lit("second"), F.coalesce("row.text", F.lit(""))).alias("e2"))
        key = cut(key.withColumn("number", F.monotonically_increasing_id()))
        kept = key.groupBy("id", "e1", "e2").agg(F.min("number").alias("kept_number"), F.count(F.lit(1)).alias("times")).filter("times > 1")
        kept = kept.select(F.col("kept_number"), F.col("id").alias("i"), F.col("e1").alias("f1"), F.col("e2").alias("f2"))
        rows = key.join(kept, F.col("id").eqNullSafe(F.col("i")) & (F.col("e1") == F.col("f1")) & (F.col("e2") == F.col("f2")), "left")
        copy = F.col("kept_number").isNotNull() & (F.col("number") != F.col("kept_number")) & (F.col("n_words") >= self.least)
        whole = F.array(F.struct(F.lit(0).alias("first"), F.col("n_words").cast("int").alias("end")))
        return rows.select("row", "n_words", F.when(copy, F.col("n_words")).otherwise(F.col("n_removed")).alias("n_removed"), F.when(copy, whole).otherwise(F.col("spans")).alias("spans"), F.when(copy, F.lit("")).otherwise(F.col("kept_text")).alias("kept_text"), "longest_repeat")


def _doubled(n_words: np.ndarray, least: int) -> np.ndarray:
    """The longest of ``least`` doubled again and again that so many words hold, else 0."""
    out = np.zeros(len(n_words), np.int64)
    length = least
    while (n_words >= length).any():
        out[n_words >= length] = length
        length *= 2
    return out


def _told(batch: pa.RecordBatch, first: int, end: int, block: WordBlock, gone: np.ndarray, longest: np.ndarray) -> pa.RecordBatch:
    """The result's rows of one block of texts from the flags of the words that went."""
    begins = block.word_offsets
    counts = np.concatenate(([0], np.cumsum(gone)))
    n_removed = counts[begins[1:]] - counts[begins[:-1]]
    edges = np.diff(np.concatenate(([False], gone, [False])).astype(np.int8))
    text_starts = np.zeros(len(gone) + 1, bool)
    text_starts[begins[:-1]] = True
    inside = np.concatenate(([False], gone)) & np.concatenate((gone, [False])) & text_starts  # a span doesn't go on into the next text
    opens = np.flatnonzero((edges[:] == 1) | inside)
    closes = np.flatnonzero((edges[:] == -1) | inside)
    cuts = np.searchsorted(opens, begins)
    of = np.repeat(begins[:-1], np.diff(cuts))
    spans = pa.StructArray.from_arrays([pa.array((opens - of).astype(np.int32)), pa.array((closes - of).astype(np.int32))], ["first", "end"])
    stay = np.flatnonzero(~gone)
    sizes = block.ends[stay] - block.starts[stay] + 1  # a word and a space
    ends = np.cumsum(sizes)
    source = np.arange(ends[-1] if len(ends) else 0) + np.repeat(block.starts[stay] - (ends - sizes), sizes)
    out = block.data[np.minimum(source, max(0, len(block.data) - 1))]
    out[ends - 1] = 0x20
    till = np.concatenate(([0], ends))[np.searchsorted(stay, begins)]
    texts = [out[a : max(a, b - 1)].tobytes() for a, b in zip(till[:-1], till[1:])]
    raw = pa.array(texts, pa.binary())
    n = end - first
    return pa.RecordBatch.from_arrays(
        [batch.column("row").slice(first, n), pa.array(block.n_words.astype(np.int64)), pa.array(n_removed.astype(np.int64)), pa.ListArray.from_arrays(pa.array(cuts.astype(np.int32)), spans), pa.Array.from_buffers(pa.string(), n, raw.buffers()), pa.array(longest)],
        ["row", "n_words", "n_removed", "spans", "kept_text", "longest_repeat"],
    )


def without_repeats(docs: DataFrame, least: int = LEAST) -> DataFrame:
    """``docs`` with texts that have lost the words of repeated windows; the other columns stay."""
    found = SubstringDedup(docs, least, longest=False).result()
    return found.select(*((F.col("kept_text") if c == "text" else F.col("row").getField(c)).alias(c) for c in docs.columns))


def digests(docs: DataFrame, longest: bool = True) -> DataFrame:
    """doc_id, n_words, n_removed, kept_sha256, n_spans of every row, and longest_repeat unless it isn't wanted."""
    found = SubstringDedup(docs.select("doc_id", "text"), longest=longest).result()
    return found.select("row.doc_id", "n_words", "n_removed", F.sha2("kept_text", 256).alias("kept_sha256"), *["longest_repeat"] * longest, F.size("spans").cast("long").alias("n_spans"))


def op11_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return digests(read_table(spark, sf_dir, "documents"))

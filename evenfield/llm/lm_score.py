"""Language-model scores of texts: a causal self-attention model over subword ids, and a unigram base score.

Documents whose crc32(doc_id as text) mod 5 is 1 are held out; all others teach.

Base: words and one end per text, counted over all teaching documents, smoothed by 0.5. Words of a bounded list (found
frequent in a sample; the list only decides the route) are counted and looked up in the task; every other occurrence
goes through one shuffle by word, where its count is summed and comes back. Both routes are exact.

Model: the ids of the lower-cased text in a public byte-level BPE vocabulary, and an end id. P(next) = P(class | context)
P(id | class, id before). Ids are put into classes by their counts over all teaching documents: the most frequent ones alone,
the others in classes of about equal mass. The class is predicted by the attention model of ``attention``. P(id | class, id before)
comes from counts of all pairs over all teaching documents, mixed with P(id | class);
the id before counts by itself if it is one of ``before`` frequent ones, else as one of 16 ranges of rank.

The attention model learns from every id and end of the teaching documents, in windows that don't overlap: pieces of
``piece_windows`` windows are dealt to shards. One shard trains the model that the others start from; each of these trains a replica on
its own pieces, and the replicas are averaged by what they saw, so that every piece teaches once. The number of shards grows with the corpus; replicas are summed on
the executors in ``sums`` parts, which is what the driver gets. Scoring runs windows that overlap by window - stride
positions in masked batches; each id is scored once, with at least that much context.

Null text is empty: its only token is the end. Repeated rows are scored each on their own and count each; null doc_ids
count as the text "" for the fold. doc_id is an integer. An empty table gives no rows; extra columns don't matter.
"""

from __future__ import annotations

import uuid
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import attention
from .common import WordBlock, cut, drop_folder, free_shuffles, map_batches, mix, read_table, shared_folder, text_blocks
from .exact_dedup import join_hot
from .tokens import vocabulary_paths


@dataclass(frozen=True)
class LmParams:
    vocabulary: str = "byte_bpe_50k"
    size: int = 50_257  # ids of the vocabulary; the end of a text is one more
    sample_documents: int = 2000
    frequent: int = 65_535
    single: int = 240
    classes: int = 256
    inputs: int = 4096
    before: int = 496
    pair_prior: float = 4.0  # how many counts P(id | class) is worth beside those of pairs
    width: int = 24
    window: int = 24
    stride: int = 12
    piece_windows: int = 64
    shard_windows: int = 100_000  # windows a replica learns from
    sums: int = 16
    batch: int = 256
    rate: float = 2e-2


def held_out(doc_id) -> bool:
    return zlib.crc32(str("" if doc_id is None else doc_id).encode()) % 5 == 1


def _encoder(params: LmParams):
    import base64

    import public_tokenizers
    import tiktoken

    global _encoding, _id_bytes
    if _encoding is None:
        with open(vocabulary_paths(params.vocabulary)[1], "rb") as lines:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
        _id_bytes = np.zeros(params.size, np.int64)
        _id_bytes[list(ranks.values())] = [len(x) for x in ranks]
        _encoding = tiktoken.Encoding("lm", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    return _encoding


_encoding = _id_bytes = None  # and how many bytes each id stands for


def odd_spaces(data: np.ndarray) -> np.ndarray:
    """Flags the first bytes of characters that are white space to the vocabulary's pattern but part words here nowhere."""
    out = np.zeros(len(data), bool)
    at = np.flatnonzero((data == 0xC2) | ((data >= 0xE1) & (data <= 0xE3)))
    next_two = np.append(data, np.zeros(2, np.uint8))
    a, b, c = data[at], next_two[at + 1], next_two[at + 2]
    odd = (a == 0xC2) & ((b == 0x85) | (b == 0xA0)) | (a == 0xE1) & (b == 0x9A) & (c == 0x80) | (a == 0xE3) & (b == 0x80) & (c == 0x80)
    odd |= (a == 0xE2) & ((b == 0x80) & ((c <= 0x8A) | (c == 0xA8) | (c == 0xA9) | (c == 0xAF)) | (b == 0x81) & (c == 0x9F))
    out[at[odd]] = True
    return out


class WordIds:
    """The ids of blocks of texts. A word that one space parts from the word before is cut from the text by the vocabulary's
    pattern together with that space, whatever else stands there: no match goes on from a word into white space, if the text holds
    none but that which parts words (a text that does is encoded whole).
    So listed words are encoded when they are first met, by themselves, and looked up from then on; what is left of a text
    when they are taken out is encoded as it stands, and the ids are put in order by the bytes at which they begin."""

    def __init__(self, params: LmParams, listed: int):
        self.encode = _encoder(params).encode_to_numpy
        self.begin, self.length = np.zeros(listed, np.int64), np.full(listed, -1, np.int64)
        self.ids, self.held = np.empty(1 << 16, "<u2"), 0

    def _learn(self, block: WordBlock, numbers: np.ndarray, at: np.ndarray) -> None:
        """Encodes words (their numbers in the list, and where in the block one lies) after a space."""
        for number, k in zip(numbers.tolist(), at.tolist()):
            found = self.encode(" " + block.data[block.starts[k] : block.ends[k]].tobytes().decode())
            if self.held + len(found) > len(self.ids):
                self.ids = np.concatenate([self.ids, np.empty(len(self.ids) + len(found), "<u2")])
            self.ids[self.held : self.held + len(found)] = found
            self.begin[number], self.length[number] = self.held, len(found)
            self.held += len(found)

    def of(self, block: WordBlock, number: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """All ids of the block's texts and each text's bounds in them; ``number`` is each word's in the list, -1 if it isn't there."""
        data, starts, ends = block.data, block.starts, block.ends
        even = block.per_text(odd_spaces(data)) == 0
        near = np.flatnonzero((number >= 0) & even[block.text_of] & (starts - 2 >= block.offsets[block.text_of]))
        near = near[(data[starts[near] - 1] == 0x20) & block.in_word[starts[near] - 2]]
        number = number[near]
        new = np.flatnonzero(self.length[number] < 0)
        if len(new):
            numbers, first = np.unique(number[new], return_index=True)
            self._learn(block, numbers, near[new[first]])
        length, place = self.length[number], starts[near] - 1  # a word's ids begin at its space
        step = np.zeros(len(data) + 1, np.int8)
        step[place] += 1
        step[ends[near]] -= 1
        kept = np.flatnonzero(np.cumsum(step[:-1], dtype=np.int8) == 0)
        rest, cuts = data[kept].tobytes(), np.searchsorted(kept, block.offsets).tolist()
        parts = [self.encode(rest[a:b].decode()) for a, b in zip(cuts[:-1], cuts[1:])]
        text_ends = np.concatenate([[0], np.cumsum([len(x) for x in parts])])
        words_before = np.searchsorted(near, block.word_offsets)
        many = np.concatenate([[0], np.cumsum(length)])
        bounds = text_ends + many[words_before]
        own = np.concatenate(parts) if parts else np.empty(0, "<u2")
        if not len(near):
            return own.astype("<u2"), bounds
        size = _id_bytes[own]
        began = kept[np.cumsum(size) - size] if len(own) else np.empty(0, np.int64)  # the byte at which each of these ids begins
        out = np.empty(bounds[-1], "<u2")
        out[np.arange(len(own)) + many[np.searchsorted(place, began)]] = own
        inner = np.arange(many[-1]) - np.repeat(many[:-1], length)
        out[np.repeat(np.searchsorted(began, place) + many[:-1], length) + inner] = self.ids[np.repeat(self.begin[number], length) + inner]
        return out, bounds


SCHEMA = "kind byte, row long, doc_id long, held boolean, n_words int, ids binary, frequent binary, key long, n long"


def frequent_words(docs: DataFrame, params: LmParams) -> np.ndarray:
    """Sorted hashes of words that the sampled documents hold more than once: a choice of route, not of what counts."""
    ids = docs.select("doc_id").filter("doc_id is not null").distinct().orderBy(F.xxhash64("doc_id"), "doc_id").limit(params.sample_documents)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for _, _, data, offsets in text_blocks(batch.column("text")):
                key, n = np.unique(WordBlock(data, offsets, lower=True).hashes, return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array(key.view(np.int64)), pa.array(n)], ["key", "n"])

    rows = map_batches(docs.join(F.broadcast(ids), "doc_id", "left_semi").select("text"), count, "key long, n long")  # sample_documents ids
    found = rows.groupBy("key").agg(F.sum("n").alias("n")).filter("n > 1").orderBy(F.desc("n"), "key").limit(params.frequent).toArrow()
    return np.sort(found["key"].to_numpy().view(np.uint64))


#: Listed words are found by the first bits of their hashes; of words that share these, one is listed.
SLOT_BITS = 21
SLOT_SHIFT = np.uint64(64 - SLOT_BITS)


def slot_table(words: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(number of the listed word at each slot or -1, the words and an end for -1)."""
    slots = np.full(1 << SLOT_BITS, -1, np.int32)
    slots[words >> SLOT_SHIFT] = np.arange(len(words))
    return slots, np.append(words, np.uint64(0))


def read_texts(docs: DataFrame, listed: np.ndarray, params: LmParams, with_ids: bool = True) -> DataFrame:
    """One reading of every text, kept in the shared folder. Kinds: 0 documents, 1 counts of ids, 2 counts of listed
    words, 3 occurrences of other words (key, in n whether they teach)."""
    spark = docs.sparkSession
    held_list = spark.sparkContext.broadcast(listed)
    end = params.size

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = held_list.value
        encoder = WordIds(params, len(words)) if with_ids else None
        slots, padded = slot_table(words)
        row = TaskContext.get().partitionId() << 33
        id_counts, word_counts = np.zeros(end + 1, np.int64), np.zeros(len(words), np.int64)
        for batch in batches:
            all_ids = batch.column("doc_id").to_pylist()
            for lo, hi, data, offsets in text_blocks(batch.column("text")):
                m = hi - lo
                block = WordBlock(data, offsets, lower=True)
                rows = row + np.arange(m)
                row += m
                held = np.array([held_out(d) for d in all_ids[lo:hi]], bool)
                teaches = ~held
                place = slots[block.hashes >> SLOT_SHIFT]
                is_listed = (place >= 0) & (padded[place] == block.hashes)
                word_counts += np.bincount(place[is_listed & teaches[block.text_of]], minlength=len(words))
                where = np.concatenate([[0], np.cumsum(is_listed)])[block.word_offsets].tolist()
                own = place[is_listed].astype("<u2")
                listed_in = [own[i:j].tobytes() for i, j in zip(where[:-1], where[1:])]
                found, bounds = encoder.of(block, np.where(is_listed, place, -1)) if encoder else (np.empty(0, "<u2"), np.zeros(m + 1, np.int64))
                id_counts += np.bincount(found[np.repeat(teaches, np.diff(bounds))], minlength=end + 1)
                id_counts[end] += int(teaches.sum()) if encoder else 0
                bounds = bounds.tolist()
                ids = [found[i:j].tobytes() for i, j in zip(bounds[:-1], bounds[1:])]
                yield _batch(0, m, row=rows, doc_id=batch.column("doc_id").slice(lo, m), held=held, n_words=block.n_words.astype(np.int32), ids=pa.array(ids, pa.binary()), frequent=pa.array(listed_in, pa.binary()))
                rare = ~is_listed
                if rare.any():
                    text = block.text_of[rare]
                    yield _batch(3, int(rare.sum()), row=rows[text], key=block.hashes[rare].view(np.int64), n=teaches[text].astype(np.int64))
        for kind, counts in ((1, id_counts), (2, word_counts)):
            at = np.flatnonzero(counts)
            yield _batch(kind, len(at), key=at, n=counts[at])

    folder = f"{shared_folder(spark)}/lm-{uuid.uuid4().hex}"
    map_batches(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text"), read, SCHEMA).write.parquet(folder)
    return spark.read.parquet(folder)


def _batch(kind: int, m: int, **columns) -> pa.RecordBatch:
    kinds = {"row": pa.int64(), "doc_id": pa.int64(), "held": pa.bool_(), "n_words": pa.int32(), "ids": pa.binary(), "frequent": pa.binary(), "key": pa.int64(), "n": pa.int64()}
    arrays = [pa.array(np.full(m, kind, np.int8))]
    for name, k in kinds.items():
        value = columns.get(name)
        arrays.append(pa.nulls(m, k) if value is None else value if isinstance(value, (pa.Array, pa.ChunkedArray)) else pa.array(value, k))
    return pa.RecordBatch.from_arrays(arrays, ["kind", *kinds])


@dataclass(frozen=True)
class Classes:
    """The class of each id, log10 P(id | class), and the number by which it is fed to the model."""

    of: np.ndarray
    share: np.ndarray
    input: np.ndarray
    mass: np.ndarray  # each class's share of all ids
    before: np.ndarray  # the bucket of an id that stands before another


def make_classes(counts: np.ndarray, params: LmParams) -> Classes:
    order = np.lexsort((np.arange(len(counts)), -counts))
    smoothed = counts + 0.5
    single = min(params.single, len(counts))
    of = np.empty(len(counts), np.int64)
    of[order[:single]] = np.arange(single)
    rest = order[single:]
    mass = np.cumsum(smoothed[rest])
    many = params.classes - single
    of[rest] = single + np.minimum((mass - smoothed[rest]) / mass[-1] * many, many - 1).astype(np.int64)
    total = np.bincount(of, smoothed, minlength=params.classes)
    rank = np.empty(len(counts), np.int64)
    rank[order] = np.arange(len(counts))
    fed = np.where(rank < params.inputs, rank, params.inputs + of)
    most = params.before
    bucket = np.where(rank < most, rank, most + np.minimum((rank - most) * 16 // max(1, len(counts) - most), 15))
    return Classes(of, np.log10(smoothed / total[of]), fed, total / total.sum(), bucket)


@dataclass(frozen=True)
class Pairs:
    """Counts of (bucket of the id before, id) for ids that share their class, and of (bucket, class)."""

    key: np.ndarray  # bucket * (size + 1) + id, ascending
    n: np.ndarray
    total: np.ndarray

    def log_share(self, before: np.ndarray, ids: np.ndarray, classes: Classes, prior: float) -> np.ndarray:
        """log10 P(id | class, id before)."""
        bucket, of = classes.before[before].astype(np.int64), classes.of[ids]
        share = 10.0 ** classes.share[ids]
        wanted = (bucket * len(classes.of) + ids).astype(np.int32)
        order, at = np.argsort(wanted), np.empty(len(wanted), np.int64)  # neighbours are found in memory that the one before has fetched
        at[order] = np.minimum(np.searchsorted(self.key, wanted[order]), max(0, len(self.key) - 1))
        n = np.where(self.key[at] == wanted, self.n[at], 0) if len(self.key) else 0
        return np.log10((n + prior * share) / (self.total[bucket, of] + prior))


def count_pairs(table: DataFrame, classes: Classes, params: LmParams) -> Pairs:
    """The counts over all teaching documents; a text begins after the end id. Their number is bounded by buckets times ids
    (26 million of 8 bytes), whatever the corpus, and all reach the driver."""
    size, single = params.size + 1, params.single

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            held: list[np.ndarray] = []
            for ids in batch.column("ids"):
                own = np.append(np.frombuffer(ids.as_buffer(), "<u2"), params.size).astype(np.int64)
                before = np.concatenate([[params.size], own[:-1]])
                held.append((classes.before[before] * size + own)[classes.of[own] >= single])
            key, n = np.unique(np.concatenate(held) if held else np.empty(0, np.int64), return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(key), pa.array(n)], ["key", "n"])

    rows = map_batches(table.filter("kind = 0 and not held").select("ids"), count, "key long, n long").groupBy("key").agg(F.sum("n").alias("n"))
    found = rows.select(F.col("key").cast("int"), F.col("n").cast("float")).toArrow()
    key, n = found["key"].to_numpy(), found["n"].to_numpy()
    del found
    total = np.bincount(key // size * params.classes + classes.of[key % size], n, minlength=(params.before + 16) * params.classes)
    order = np.argsort(key)
    return Pairs(key[order], n[order], total.reshape(-1, params.classes))


def input_count(params: LmParams) -> int:
    return params.inputs + params.classes + 1  # frequent ids, classes of the others, the start of a text


#: Windows that scoring takes at a time; no score depends on it.
SCORED_WINDOWS = 1024


def _laid_out(ids: list[bytes], params: LmParams, classes: Classes):
    """Flat inputs and targets of the texts, and their bounds; then each position's place where every text has room for its
    windows, which begin at multiples of ``stride``, and each text's first place and the end of all."""
    lengths = np.array([len(x) // 2 + 1 for x in ids], np.int64)
    bounds = np.concatenate([[0], np.cumsum(lengths)])
    targets = np.full(bounds[-1], params.size, np.int64)
    inside = np.ones(bounds[-1], bool)
    inside[bounds[1:] - 1] = False
    targets[inside] = np.frombuffer(b"".join(ids), "<u2")
    inputs = np.empty(bounds[-1], np.int64)
    inputs[1:] = classes.input[targets[:-1]]
    inputs[bounds[:-1]] = input_count(params) - 1
    stride, window = params.stride, params.window
    room = np.maximum(0, -(-(lengths - window) // stride)) * stride + window
    room = -(-room // stride) * stride
    first = np.concatenate([[0], np.cumsum(room)])
    return inputs, targets, bounds, np.arange(bounds[-1]) + np.repeat(first[:-1] - bounds[:-1], lengths), first


def class_scores(model: dict[str, np.ndarray], inputs: np.ndarray, of: np.ndarray, place: np.ndarray, first: np.ndarray, params: LmParams) -> np.ndarray:
    """Natural log of P(class | context) at each position (see ``_laid_out``): windows follow each other ``stride`` apart, and each
    gives its last ``stride`` positions; what comes before these in a text is a shorter window of its own."""
    w, stride, opens = params.window, params.stride, params.window - params.stride
    fed, wanted = np.zeros(first[-1], np.int64), np.zeros(first[-1], np.int64)
    fed[place], wanted[place] = inputs, of
    found = np.zeros(first[-1], np.float32)
    windows = (first[-1] - w) // stride + 1
    for lo in range(0, windows, SCORED_WINDOWS):
        n = min(SCORED_WINDOWS, windows - lo)
        part = slice(lo * stride, (lo + n - 1) * stride + w)
        found[part.start + opens : part.stop] = attention.sliding_log_probabilities(model, fed[part], wanted[part], w, stride).ravel()
    for lo in range(0, (len(first) - 1) if opens else 0, SCORED_WINDOWS):
        at = first[:-1][lo : lo + SCORED_WINDOWS, None] + np.arange(opens)
        found[at] = attention.log_probabilities(model, fed[at], wanted[at], 0)
    return found[place]


def training_pieces(table: DataFrame, params: LmParams) -> tuple[DataFrame, int]:
    """(shard, piece) of the teaching documents' pieces, and the number of shards. A piece is the ids before each of its
    positions and the last one's own; the end of a text stands before its first id too, which tells its begin."""
    end, most = params.size, params.piece_windows * params.window

    def pick(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        edge = np.array([end], "<u2").tobytes()
        for batch in batches:
            rows = mix(batch.column("row").to_numpy().view(np.uint64))
            for a in range(0, len(batch), 500):
                dealt, pieces = [], []
                for row, ids in zip(rows[a : a + 500], batch.column("ids").slice(a, 500).to_pylist()):
                    own = edge + ids + edge
                    begin = np.arange(0, len(ids) // 2 + 1, most)
                    dealt.append(mix(row + begin.astype(np.uint64)) >> np.uint64(20))
                    pieces += [own[2 * k : 2 * (k + most + 1)] for k in begin.tolist()]
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(dealt).astype(np.int64)), pa.array(pieces, pa.binary())], ["dealt", "piece"])

    teaching = table.filter("kind = 0 and not held")
    n = teaching.agg(F.sum(F.ceil((F.length("ids") / 2 + 1) / params.window))).first()[0] or 0
    shards = max(1, -(-n // params.shard_windows))
    rows = map_batches(teaching.select("row", "ids"), pick, "dealt long, piece binary")
    return rows.select(F.pmod(F.col("dealt"), F.lit(shards)).cast("int").alias("shard"), "piece"), shards


def piece_windows(pieces: list[bytes], classes: Classes, params: LmParams) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Inputs, classes and counted places of the windows of these pieces: each position is counted once."""
    w = params.window
    lengths = np.array([len(x) // 2 - 1 for x in pieces], np.int64)
    bounds = np.concatenate([[0], np.cumsum(lengths + 1)])
    ids = np.frombuffer(b"".join(pieces), "<u2")
    inputs = np.where(ids == params.size, input_count(params) - 1, classes.input[ids]).astype(np.int32)
    of = classes.of[ids].astype(np.int32)
    text, begin = attention.windows(lengths, w, w)
    place = begin[:, None] + np.arange(w)
    real = place < lengths[text][:, None]
    at = bounds[text][:, None] + np.where(real, place, 0)
    return inputs[at], of[at + 1], real


def train_model(pieces: DataFrame, shards: int, classes: Classes, params: LmParams) -> dict[str, np.ndarray]:
    """One shard's pieces train the model that the others start from; each of these trains a replica on its pieces, and they are averaged."""
    model = attention.initial(input_count(params), params.classes, params.width, params.window)
    attention.start_from_shares(model, classes.mass)
    model = _average(pieces.filter("shard = 0").repartitionById(1, F.col("shard")), model, classes, params, 0)
    return _average(pieces.filter("shard > 0").repartitionById(shards, F.col("shard")), model, classes, params, 1)


def _average(chosen: DataFrame, model: dict[str, np.ndarray], classes: Classes, params: LmParams, number: int) -> dict[str, np.ndarray]:
    held = chosen.sparkSession.sparkContext.broadcast((model, classes))

    def learn(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        (now, c), seen, shard = held.value, 0, 0
        for batch in batches:
            for a in range(0, len(batch), 1000):  # so many pieces at a time, so memory is bounded
                part = batch.slice(a, 1000)
                ids, of, counted = piece_windows(part.column("piece").to_pylist(), c, params)
                now = attention.train(now, ids, of, counted, batch=params.batch, rate=params.rate / (1 + number), seed=number)
                seen, shard = seen + int(counted.sum()), part.column("shard")[0].as_py()
        if seen:
            yield pa.RecordBatch.from_arrays([pa.array([shard % params.sums], pa.int32()), pa.array([seen]), pa.array([(attention.flat(now).astype(np.float64) * seen).tobytes()], pa.binary())], ["part", "seen", "sums"])

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen, total = 0, None
        for batch in batches:
            for n, x in zip(batch.column("seen").to_pylist(), batch.column("sums")):
                own = np.frombuffer(x.as_buffer(), np.float64)
                seen, total = seen + n, own.copy() if total is None else total + own
        if seen:
            yield pa.RecordBatch.from_arrays([pa.array([seen]), pa.array([total.tobytes()], pa.binary())], ["seen", "sums"])

    replicas = map_batches(chosen, learn, "part int, seen long, sums binary")
    sums = map_batches(replicas.repartitionById(params.sums, F.col("part")).select("seen", "sums"), add, "seen long, sums binary").toArrow()  # params.sums rows at most
    held.destroy()
    if not sums.num_rows:
        return model
    return attention.shaped(sum(np.frombuffer(x, np.float64) for x in sums["sums"].to_pylist()) / sum(sums["seen"].to_pylist()), model)


def _listed_sums(part: pa.RecordBatch, logs: np.ndarray, known: np.ndarray) -> tuple[pa.Array, pa.Array]:
    """Of each document's listed words the sum of logs and the number known."""
    listed = [np.frombuffer(x, "<u2") for x in part.column("frequent").to_pylist()]
    return pa.array([logs[x].sum() for x in listed], pa.float64()), pa.array([known[x].sum() for x in listed], pa.int64())


def base_documents(table: DataFrame, word_counts: np.ndarray) -> DataFrame:
    """row, doc_id, held, n_words, listed_sum, listed_known of each document: what ``score_documents`` gives, without the model's score."""
    held = table.sparkSession.sparkContext.broadcast((np.log10(word_counts + 0.5), word_counts > 0))
    own = ["row", "doc_id", "held", "n_words"]

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in own), *_listed_sums(batch, *held.value)], [*own, "listed_sum", "listed_known"])

    return map_batches(table.filter("kind = 0").select(*own, "frequent"), add, "row long, doc_id long, held boolean, n_words int, listed_sum double, listed_known long")


def score_documents(table: DataFrame, model: dict[str, np.ndarray], classes: Classes, pairs: Pairs, word_counts: np.ndarray, params: LmParams) -> DataFrame:
    """row, doc_id, held, n_words, listed_sum, listed_known, score of each document."""
    held = table.sparkSession.sparkContext.broadcast((model, classes, pairs, np.log10(word_counts + 0.5), word_counts > 0))

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m, c, following, logs, known = held.value
        m = attention.prepared(m)
        for batch in batches:
            sizes = np.array([len(x) for x in batch.column("ids").to_pylist()], np.int64)
            groups = np.cumsum(sizes) // (1 << 19)
            edges = np.flatnonzero(np.concatenate([[True], groups[1:] != groups[:-1], [True]]))
            for a, b in zip(edges[:-1], edges[1:]):
                part = batch.slice(a, b - a)
                inputs, targets, bounds, place, laid = _laid_out(part.column("ids").to_pylist(), params, c)
                of = c.of[targets]
                before = np.empty_like(targets)
                before[1:] = targets[:-1]  # a text's first position follows an end, its own text's or the one before
                before[bounds[:-1]] = params.size
                within = class_scores(m, inputs, of, place, laid, params) / np.log(10)
                many = np.flatnonzero(of >= params.single)  # the other classes hold one id
                within[many] += following.log_share(before[many], targets[many], c, params.pair_prior)
                total = np.add.reduceat(within, bounds[:-1])
                sums, knowns = _listed_sums(part, logs, known)
                yield pa.RecordBatch.from_arrays([part.column("row"), part.column("doc_id"), part.column("held"), part.column("n_words"), sums, knowns, pa.array(total)], ["row", "doc_id", "held", "n_words", "listed_sum", "listed_known", "score"])

    return map_batches(table.filter("kind = 0").select("row", "doc_id", "held", "n_words", "ids", "frequent"), score, "row long, doc_id long, held boolean, n_words int, listed_sum double, listed_known long, score double")


def score_texts(docs: DataFrame, params: LmParams = LmParams(), with_model: bool = True) -> DataFrame:
    """One row per document: doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score. Without the model, which no
    other column depends on, there is no score."""
    listed = frequent_words(docs, params)
    table = read_texts(docs, listed, params, with_model)
    counts = np.zeros(params.size + 1)
    found = table.filter("kind = 1").groupBy("key").agg(F.sum("n").alias("n")).toArrow()  # a row per id at most
    counts[found["key"].to_numpy()] = found["n"].to_numpy()
    word_counts = np.zeros(len(listed))
    found = table.filter("kind = 2").groupBy("key").agg(F.sum("n").alias("n")).toArrow()  # a row per listed word at most
    word_counts[found["key"].to_numpy()] = found["n"].to_numpy()
    # other words: counted before they are shuffled; each occurrence then gets its word's count, that of a hot word where it lies
    rare = table.filter("kind = 3").select("row", "key", "n")
    spark, folder = docs.sparkSession, f"{shared_folder(docs.sparkSession)}/lm-words-{uuid.uuid4().hex}"
    rare.groupBy("key").agg(F.sum("n").alias("c"), F.count(F.lit(1)).alias("occurrences")).write.parquet(folder)
    counted = spark.read.parquet(folder)
    rare = join_hot(rare.select("row", "key"), counted, "key", "occurrences")
    # summed now, so that the words' shuffles and counts are off the disks before the model's training needs these
    rare = cut(rare.groupBy("row").agg(F.sum(F.log10(F.col("c") + 0.5)).alias("rare_sum"), F.sum((F.col("c") > 0).cast("long")).alias("rare_known")))
    rare_distinct = counted.filter("c > 0").count()
    del counted
    drop_folder(spark, folder)
    teaching, teaching_words = table.filter("kind = 0 and not held").agg(F.count(F.lit(1)), F.coalesce(F.sum("n_words"), F.lit(0))).first()
    ends = float(teaching)
    n_train = int(teaching + teaching_words)
    distinct = rare_distinct + int((word_counts > 0).sum()) + int(ends > 0)
    if with_model:
        classes = make_classes(counts, params)
        free_shuffles(spark)
        model = train_model(*training_pieces(table, params), classes, params)
        free_shuffles(spark)
        scored = score_documents(table, model, classes, count_pairs(table, classes, params), word_counts, params)
    else:
        scored = base_documents(table, word_counts)
    below = float(np.log10(n_train + 0.5 * (distinct + 1)))
    end_log = float(np.log10(ends + 0.5))
    rows = scored.join(rare.select("row", "rare_sum", "rare_known"), "row", "left")
    tokens = F.col("n_words").cast("long") + 1
    base = F.col("listed_sum") + F.coalesce("rare_sum", F.lit(0.0)) + F.lit(end_log) - tokens * F.lit(below)
    known = F.col("listed_known") + F.coalesce("rare_known", F.lit(0)) + F.lit(int(ends > 0))
    return rows.select("doc_id", F.col("held").alias("held_out"), tokens.alias("n_tokens"), known.alias("n_known"), F.lit(n_train).cast("long").alias("train_tokens"), base.alias("base_score"), *["score"] * with_model)


def op7_lm_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    return score_texts(read_table(spark, sf_dir, "documents"))

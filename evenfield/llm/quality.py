"""Quality rules: counting rules, then a length-normalised log-likelihood ratio of hashed n-grams.

Word unigrams and bigrams are hashed to ``buckets`` features. The raw multinomial counts every document of
the corpus, the trusted one the documents labelled good (at most ``label_bound`` rows of each label, those
with the smallest hash of doc_id). A document's score is the mean over its features, and ``neutral`` features
of ratio 0, of log(trusted share / raw share), both smoothed. It passes at ``score >= threshold``; the threshold is fitted on
the labelled rows and lets at least 1 - ``loss`` of the good ones pass, so the verdict of a document depends on
its own text and the corpus counts only, for every document alike.

Defined cases: null text has no words and fails the base rules (fewer than 10 words); repeated rows are
judged alike, each on its own; an empty table or one without labels has no trusted counts, so the model is
neutral and the base rules alone decide; extra columns are kept by ``filter_quality`` and ignored otherwise.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import WordBlock, hash_ranges, map_batches, mix, read_table, repeated, text_blocks

SYMBOLS = b"#*$%&|<>"
_SYMBOL = np.zeros(256, bool)
_SYMBOL[list(SYMBOLS)] = True
FAILING_WORDS, FAILING_SHARE, WINDOW = 10, 20, 5


@dataclass(frozen=True)
class QualityParams:
    buckets: int = 1 << 16
    label_bound: int = 20_000
    smoothing: float = 5.0  # counts added to both sides of a ratio: features too rare to judge by weigh nothing
    loss: float = 0.002
    neutral: int = 16  # features of ratio 0 that every document is given, so a few odd words don't decide short texts


@dataclass(frozen=True)
class QualityModel:
    ratio: np.ndarray
    threshold: float


def features(block: WordBlock, buckets: int) -> tuple[np.ndarray, np.ndarray]:
    """Bucket of each unigram and bigram, and the text it belongs to."""
    first, pairs = block.windows(2)
    both = np.concatenate([block.hashes, pairs])
    return (both & np.uint64(buckets - 1)).astype(np.int64), np.concatenate([block.text_of, block.text_of[first]])


def base_counts(block: WordBlock) -> dict[str, np.ndarray]:
    data, offsets, n = block.data, block.offsets, block.n_texts
    out = {"n_words": block.n_words, "word_chars": block.per_text(block.in_word & ((data & 0xC0) != 0x80)), "n_symbols": block.per_text(_SYMBOL[data])}
    # lines: every text ends one, as does every \n
    breaks = np.flatnonzero(data == 10)
    ends = np.sort(np.concatenate([breaks, offsets[1:]]), kind="stable")
    text = np.concatenate([np.searchsorted(offsets, breaks, "right") - 1, np.arange(n)])
    text = text[np.argsort(np.concatenate([breaks, offsets[1:]]), kind="stable")]
    # a break right before a text's end and that end itself keep their order, being sorted stably by position
    order = np.lexsort((ends, text))
    ends, text = ends[order], text[order]
    starts = np.empty_like(ends)
    starts[1:] = ends[:-1] + 1
    new = np.ones(len(text), bool)
    new[1:] = text[1:] != text[:-1]
    starts[new] = offsets[text[new]]
    held = np.searchsorted(block.starts, ends) > np.searchsorted(block.starts, starts)  # lines with a word
    starts, ends, text = starts[held], ends[held], text[held]
    key = mix(hash_ranges(data, starts, ends) + mix(text.astype(np.uint64)))
    order = np.argsort(key)
    again = np.zeros(len(key), bool)
    again[order[1:]] = key[order][1:] == key[order][:-1]
    out["n_dup_lines"] = np.bincount(text[again], minlength=n)
    # words inside a window of five that the text holds more than once
    first, h = block.windows(WINDOW)
    twice = first[repeated(mix(h + mix(block.text_of[first].astype(np.uint64))))]
    cover = np.zeros(len(block.hashes) + WINDOW, np.int32)
    np.add.at(cover, twice, 1)
    np.add.at(cover, twice + WINDOW, -1)
    covered = np.cumsum(cover)[: len(block.hashes)] > 0
    out["n_repeat_words"] = np.bincount(block.text_of[covered], minlength=n)
    return out


def base_failed(found: dict[str, np.ndarray]) -> np.ndarray:
    return (found["n_words"] < FAILING_WORDS) | (100 * found["n_repeat_words"] > FAILING_SHARE * found["n_words"])


def document_scores(block: WordBlock, ratio: np.ndarray, params: QualityParams) -> np.ndarray:
    bucket, text = features(block, params.buckets)
    return np.bincount(text, ratio[bucket], minlength=block.n_texts) / (np.bincount(text, minlength=block.n_texts) + params.neutral)


def labelled_sample(spark: SparkSession, labels: DataFrame, bound: int) -> DataFrame:
    """(doc_id, good) of at most ``bound`` labelled rows of either label: a size that doesn't grow with the data."""
    rows = labels.select("doc_id", (F.col("quality") == 1).alias("good")).filter("doc_id is not null and good is not null").groupBy("doc_id").agg(F.min("good").alias("good"))
    parts = [rows.filter(F.col("good") == v).orderBy(F.xxhash64("doc_id"), "doc_id").limit(bound) for v in (True, False)]
    return parts[0].unionByName(parts[1])


def fit_quality(docs: DataFrame, labels: DataFrame, params: QualityParams = QualityParams()) -> QualityModel:
    """Counts over all of ``docs``; the labelled rows give the trusted counts and the threshold."""
    spark, n = docs.sparkSession, params.buckets
    sample = F.broadcast(labelled_sample(spark, labels, params.label_bound))
    tagged = docs.select("doc_id", "text").join(sample, "doc_id", "left").select("text", F.coalesce(F.col("good"), F.lit(False)).alias("good"))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        raw, trusted = np.zeros(n, np.int64), np.zeros(n, np.int64)
        for batch in batches:
            good = batch.column("good").to_numpy(zero_copy_only=False).astype(bool)
            for lo, hi, data, offsets in text_blocks(batch.column("text")):
                bucket, text = features(WordBlock(data, offsets), n)
                raw += np.bincount(bucket, minlength=n)
                trusted += np.bincount(bucket[good[lo:hi][text]], minlength=n)
        k = np.flatnonzero(raw)
        yield pa.RecordBatch.from_arrays([pa.array(k), pa.array(raw[k]), pa.array(trusted[k])], ["bucket", "raw", "trusted"])

    counts = map_batches(tagged, count, "bucket long, raw long, trusted long").groupBy("bucket").agg(F.sum("raw").alias("raw"), F.sum("trusted").alias("trusted")).toArrow()
    raw, trusted = np.zeros(n), np.zeros(n)
    raw[counts["bucket"].to_numpy()] = counts["raw"].to_numpy()
    trusted[counts["bucket"].to_numpy()] = counts["trusted"].to_numpy()
    if not trusted.sum():
        return QualityModel(np.zeros(n), -np.inf)
    expected = raw * (trusted.sum() / raw.sum())
    ratio = np.log((trusted + params.smoothing) / (expected + params.smoothing))
    scored = score_quality(docs.select("doc_id", "text").join(sample, "doc_id"), QualityModel(ratio, -np.inf), params, ("good",)).select("good", "score", "base_failed").toArrow()
    score = scored["score"].to_numpy()
    good = scored["good"].to_numpy(zero_copy_only=False).astype(bool) & ~scored["base_failed"].to_numpy(zero_copy_only=False).astype(bool)
    bad = ~scored["good"].to_numpy(zero_copy_only=False).astype(bool)
    return QualityModel(ratio, fit_threshold(score[good], score[bad], params.loss))


def fit_threshold(good: np.ndarray, bad: np.ndarray, loss: float) -> float:
    """Halfway from the lowest good score that must pass to the next bad score below it."""
    if not len(good) or not len(bad):
        return -np.inf
    good, bad = np.sort(good), np.sort(bad)
    most = good[int(np.floor(loss * len(good)))]
    below = bad[bad < most]
    return float((most + below[-1]) / 2) if len(below) else float(most)


def score_quality(docs: DataFrame, model: QualityModel, params: QualityParams = QualityParams(), keep: tuple[str, ...] = ()) -> DataFrame:
    """One row per document: ``keep`` columns, doc_id, the base counts, score, base_failed and kept."""
    ratio, threshold = model.ratio, model.threshold  # half a megabyte, sent with the tasks and dropped with them
    names = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
    kept = ["doc_id", *keep]
    types = dict(docs.dtypes)
    schema = ", ".join(f"`{c}` {types[c]}" for c in kept) + ", " + ", ".join(f"{c} long" for c in names) + ", score double, base_failed boolean, kept boolean"

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo, hi, data, offsets in text_blocks(batch.column("text")):
                block = WordBlock(data, offsets)
                found = base_counts(block)
                failed, value = base_failed(found), document_scores(block, ratio, params)
                own = batch.slice(lo, hi - lo)
                yield pa.RecordBatch.from_arrays([*(own.column(c) for c in kept), *(pa.array(found[c].astype(np.int64)) for c in names), pa.array(value), pa.array(failed), pa.array(~failed & (value >= threshold))], [*kept, *names, "score", "base_failed", "kept"])

    return map_batches(docs.select(*kept, "text"), score, schema)


def filter_quality(docs: DataFrame, model: QualityModel, params: QualityParams = QualityParams()) -> DataFrame:
    """The rows of ``docs`` that pass, with all their columns."""
    ratio, threshold = model.ratio, model.threshold

    def passing(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo, hi, data, offsets in text_blocks(batch.column("text")):
                block = WordBlock(data, offsets)
                ok = ~base_failed(base_counts(block)) & (document_scores(block, ratio, params) >= threshold)
                if ok.any():
                    yield batch.slice(lo, hi - lo).filter(pa.array(ok))

    return map_batches(docs, passing, docs.schema)


def op6_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, params = read_table(spark, sf_dir, "documents"), QualityParams()
    model = fit_quality(docs, read_table(spark, sf_dir, "labels"), params)
    return score_quality(docs, model, params).select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "score")

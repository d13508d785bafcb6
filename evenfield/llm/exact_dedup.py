"""Exact deduplication by a log-structured merge index of text digests, in DataFrame operations only.

* Flush: every task is a memtable of (digest, doc_id) rows; it sorts them by digest and writes them as one run into the
  shared checkpoint folder. Tasks of even and of odd number make two flushes.
* Levels: the runs of each flush are merged by digest into a level, in which the smallest doc_id and the number of rows stay.
  Partial aggregation brings a digest that a third of all rows hold down to a row per task before the shuffle.
* Filters: each level has a bitmap of its digests. A digest that the other level's filter doesn't hold is in one level only
  and is left where it is; compaction merges the others, of both levels, into the next one. ``skipped`` counts the former.
* Hits (digests of more than one row) receive byte verification: a filter of the hit digests picks the documents
  to read again; these are grouped by digest *and* whole normalised text, so texts of equal digest and different bytes part.

Filters have at most FILTER_WORDS words, whatever the data, and are broadcast. Where more digests than bits come together they hold
most, and then more is merged and read again, with the same result.

Texts are equal when identical after each run of ``[\\x20\\x09-\\x0D]`` has become one space; null counts as empty, and
nothing is trimmed. Of equal texts the smallest doc_id stays; rows that repeat a doc_id and text count each in
group_size, and one of them stays. Rows of null doc_id are compared like others; one stays if its group has no
doc_id at all. An empty table gives no rows. Further columns don't matter, whatever their names.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import as_row, from_row, read_table, shared_folder, small_or_not, whole_text

#: A run of white space that isn't just one space.
RUNS = r"[\x09-\x0D][\x20\x09-\x0D]*|\x20[\x20\x09-\x0D]+"
#: Words of 64 bits in a filter of digests: at most this many broadcast rows, whatever the data.
FILTER_WORDS = 1 << 18
FLUSHES = 2
#: Digests that hold at least one in so many rows are joined by broadcast; there are at most as many of them.
HOT_SHARE = 1000


def normalised(text: Column) -> Column:
    return F.regexp_replace(text, RUNS, " ")


def sha256_digest(text: Column) -> Column:
    return F.unhex(F.sha2(text.cast("binary"), 256))


def _slot() -> tuple[Column, Column]:
    place = F.pmod(F.xxhash64("digest"), F.lit(FILTER_WORDS * 64))
    return F.shiftright(place, 6).cast("int").alias("word"), F.pmod(place, F.lit(64)).cast("int").alias("bit")


def digest_filter(rows: DataFrame) -> DataFrame:
    """(word, marks): the bits of the rows' digests, FILTER_WORDS rows at most."""
    return rows.select(*_slot()).selectExpr("word", "shiftleft(1L, bit) as mark").groupBy("word").agg(F.bit_or("mark").alias("marks"))


def held_by(rows: DataFrame, digests: DataFrame) -> DataFrame:
    """``rows`` with held: whether the filter may hold their digest."""
    marked = rows.select("*", *_slot()).join(F.broadcast(digests), "word", "left")
    return marked.withColumn("held", F.coalesce(F.expr("(shiftrightunsigned(marks, bit) & 1L) = 1L"), F.lit(False))).drop("word", "bit", "marks")


class DigestIndex:
    """The runs of one table and what their compaction and verification found."""

    def __init__(self, docs: DataFrame, digest=sha256_digest):
        self.docs, self.spark, self.digest = docs, docs.sparkSession, digest
        self.folder = f"{shared_folder(self.spark)}/digests-{uuid.uuid4().hex}"

    def texts(self) -> DataFrame:
        held = self.docs.select(F.col("doc_id"), normalised(whole_text()).alias("text"))
        return held.select("doc_id", "text", self.digest(F.col("text")).alias("digest"))

    def flush(self) -> DataFrame:
        rows = self.texts().select("digest", "doc_id", F.monotonically_increasing_id().alias("row"), F.pmod(F.spark_partition_id(), F.lit(FLUSHES)).alias("flush"))
        return self._kept(rows.sortWithinPartitions("digest", "doc_id"), "runs")

    def _kept(self, rows: DataFrame, name: str) -> DataFrame:
        rows.write.parquet(f"{self.folder}/{name}")
        return self.spark.read.parquet(f"{self.folder}/{name}")

    def levels(self, runs: DataFrame) -> list[DataFrame]:
        """(digest, keep_id, group_size) of each flush, its runs merged."""
        merged = lambda n: runs.filter(F.col("flush") == n).groupBy("digest").agg(F.min("doc_id").alias("keep_id"), F.count(F.lit(1)).alias("group_size"))
        return [self._kept(merged(n), f"level-{n}") for n in range(FLUSHES)]

    def compact(self, runs: DataFrame) -> DataFrame:
        """(digest, keep_id, group_size) of digests that more than one row has."""
        first, second = self.levels(runs)
        probed = [held_by(first, digest_filter(second)), held_by(second, digest_filter(first))]
        both = probed[0].filter("held").unionByName(probed[1].filter("held"))
        met = both.groupBy("digest").agg(F.min("keep_id").alias("keep_id"), F.sum("group_size").alias("group_size"))
        alone = probed[0].filter("not held").unionByName(probed[1].filter("not held")).select("digest", "keep_id", "group_size")
        self.spared = alone
        return self._kept(met.unionByName(alone).filter("group_size > 1"), "hits")

    def skipped(self) -> int:
        """How many digests of the levels the filters kept out of the last compaction."""
        return self.spared.count()

    def verify(self, hits: DataFrame) -> DataFrame:
        """(digest, keep_id, group_size, n_bytes, sha512) of each text, told apart by its bytes, whose digest was hit."""
        again = held_by(self.texts(), digest_filter(hits)).filter("held")
        texts = again.groupBy("digest", "text").agg(F.min("doc_id").alias("keep_id"), F.count(F.lit(1)).alias("group_size"))
        of_text = (F.octet_length("text").alias("n_bytes"), F.sha2(F.col("text").cast("binary"), 512).alias("sha512"))
        return self._kept(texts.select("digest", "keep_id", "group_size", *of_text), "texts")

    def result(self) -> DataFrame:
        """One row per document: doc_id, keep_id, group_size, kept, digest."""
        runs = self.flush()
        texts = self.verify(self.compact(runs))
        runs = runs.drop("flush")
        parted = texts.groupBy("digest").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").select("digest")
        several = texts.filter("group_size > 1").join(parted, "digest", "left_anti")
        rows = join_hot(runs, several.select("digest", "keep_id", "group_size"), "digest", "group_size")
        if not parted.isEmpty():  # equal digests of different bytes: settled by the texts themselves
            rows = rows.join(parted, "digest", "left_anti").unionByName(self._parted(runs, texts, parted))
        # a doc_id that is there more than once with one text: its first row stays
        twice = runs.groupBy("digest", F.col("doc_id").alias("same_id")).agg(F.min("row").alias("first_row"), F.count(F.lit(1)).alias("n")).filter("n > 1").drop("n").withColumnRenamed("digest", "same_digest")
        rows = rows.join(twice, (F.col("digest") == F.col("same_digest")) & F.col("doc_id").eqNullSafe(F.col("same_id")), "left")
        alone = F.col("group_size").isNull()
        kept = alone | (F.col("doc_id").eqNullSafe(F.col("keep_id")) & (F.col("first_row").isNull() | (F.col("first_row") == F.col("row"))))
        return rows.select("doc_id", F.when(alone, F.col("doc_id")).otherwise(F.col("keep_id")).alias("keep_id"), F.coalesce("group_size", F.lit(1).cast("long")).alias("group_size"), kept.alias("kept"), "digest")

    def _parted(self, runs: DataFrame, texts: DataFrame, parted: DataFrame) -> DataFrame:
        """Rows of the documents whose digest stands for several texts; few or none, so their texts may be joined."""
        own = self.docs.select("doc_id", normalised(whole_text()).alias("text"))
        own = own.withColumn("digest", self.digest(F.col("text"))).join(parted, "digest")
        own = own.groupBy("digest", "doc_id", F.octet_length("text").alias("n_bytes"), F.sha2(F.col("text").cast("binary"), 512).alias("sha512")).agg(F.count(F.lit(1)).alias("times"))
        rows = own.join(texts.join(parted, "digest"), ["digest", "n_bytes", "sha512"]).select("digest", "doc_id", "keep_id", "group_size", F.explode(F.sequence(F.lit(1), F.col("times").cast("int"))).alias("time"))
        return rows.select("digest", "doc_id", F.when(F.col("time") == 1, F.lit(None).cast("long")).otherwise(F.lit(-1).cast("long")).alias("row"), "keep_id", "group_size")


def join_hot(rows: DataFrame, found: DataFrame, key: str, size: str) -> DataFrame:
    """``rows`` left-joined to ``found`` by ``key``, where ``found`` has a row per key and the number of ``rows`` it has.

    Keys that hold at least 1 of HOT_SHARE rows, at most HOT_SHARE of them, are joined by broadcast where the rows
    are; the others by a shuffle in which no key is large.
    """
    least = found.agg(F.sum(size).alias("total")).first()["total"] or 0
    least = max(least // HOT_SHARE, 1000)
    columns = [c for c in found.columns if c != key]
    hot = found.filter(F.col(size) >= least).select(F.col(key).alias("hot_key"), *(F.col(c).alias(f"hot_{c}") for c in columns))
    first = rows.join(F.broadcast(hot), F.col(key) == F.col("hot_key"), "left")
    rest = found.filter(F.col(size) < least).select(F.col(key).alias("rest_key"), *(F.col(c).alias(f"rest_{c}") for c in columns))
    # a hot row has its answer: its join key becomes null, which is matched with nothing and dealt by row
    scattered = F.when(F.col("hot_key").isNull(), F.col(key))
    both = first.withColumn("probe_key", scattered)
    cold = both.filter("hot_key is null").join(rest, F.col("probe_key") == F.col("rest_key"), "left")
    warm = both.filter("hot_key is not null")
    return cold.select(*rows.columns, *(F.col(f"rest_{c}").alias(c) for c in columns)).unionByName(warm.select(*rows.columns, *(F.col(f"hot_{c}").alias(c) for c in columns)))


def keep_first(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` that stay, with all their columns."""
    index = DigestIndex(docs)
    fates = index.result().groupBy(F.col("doc_id").alias("id"), F.col("digest").alias("fate")).agg(F.max("kept").alias("stays"), F.count(F.lit(1)).alias("times"))
    fates = small_or_not(fates.filter("not stays or times > 1"))
    marked = docs.select(as_row(docs), F.col("doc_id").alias("own_id"), index.digest(normalised(whole_text())).alias("own_digest"))
    own = marked.join(fates, F.col("own_id").eqNullSafe(F.col("id")) & (F.col("own_digest") == F.col("fate")), "left").filter("stays is null or stays")
    again = own.filter("times > 1")
    if not fates.filter("times > 1").isEmpty():  # repeated rows: one of each doc_id and text
        own = own.filter("times is null or times = 1").unionByName(again.dropDuplicates(["id", "fate"]))
    return from_row(own, docs.columns)


def op10_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = DigestIndex(read_table(spark, sf_dir, "documents")).result()
    return found.select("doc_id", "keep_id", "group_size", "kept", F.lower(F.hex("digest")).alias("text_sha256"))


#: DuckDB SQL of op10_exact_dedup.
ORACLE_SQL = """
WITH d AS (SELECT doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') AS t FROM documents)
SELECT doc_id, min(doc_id) OVER w AS keep_id, count(*) OVER w AS group_size, doc_id = min(doc_id) OVER w AS kept, sha256(t) AS text_sha256
FROM d WINDOW w AS (PARTITION BY t)
"""

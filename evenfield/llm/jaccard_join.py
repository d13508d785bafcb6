"""Exact Jaccard self-join of n-gram sets by partitioning the universe, and the components of its links.

Two documents link when ``100 * |A & B| >= percent * |A | B|`` for their sets of distinct n-word shingles.

* Size bands: sizes b .. floor(b / t) form a band, so a document meets smaller partners in its own band and larger
  ones in its own or the next, and gives signatures for both. Within a band two linked sets differ in at most H
  shingles.
* Universe partition: a hash deals the shingles into segments of weights v (1: the segment's subset is indexed;
  2: also the subset less any one shingle). When the weights sum to H + 1 + slack, segments whose weights sum to
  slack + 1 or more differ by less than their weight, so linked sets share a signature. The weights of a band are
  chosen by cost, from the number of its documents and the part of shingles that is hot.
* Hot shingles (a list of bounded length) are left out of the segments at first, so a signature is held by few
  documents, however many share a passage. Sets that keep little besides hot shingles (thin segments of weight
  over slack) are indexed over all shingles as well. A pair whose equal segments are all thin consists of two such
  sets, so what is thin there too (about one set in a thousand) is indexed by up to PARTITIONS independent partitions, and
  what is thin in all of them by its empty segments. A linked pair is missed by none of these.
* Equal sets share a key from the start, so copies make no pairs: a 64-bit sum of their hashes, of which a second such sum
  finds and parts the sets that share it by chance. Pairs with each group's most central member (that of the largest groups) are
  verified first, and then only members that are still in different components are compared, by parity sketches, in
  blocks of bounded size; a sketch never shows more differences than the sets have, so no link is lost, and what
  passes is verified exactly against the sets. Components come from label contraction of the links.
* Links are counted inside the components, most of them by the triangle inequality (``link_counts``), so a group of near
  copies isn't written out as pairs.

Shingles are compared as 52-bit hashes and sets as sets of these. Texts are lower-cased (A-Z). A text of fewer than n words has its
whole word sequence as its one shingle; null or wordless text has none, and links with nothing. doc_id is an integer. Rows that repeat
one count as a document each with the same id, and stay or go in ``keep_one`` by their own text; null doc_ids get no component id
of their own (null), and go where their group has a doc_id. An empty table gives an empty result; extra columns, whatever
their names, don't matter.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .components import components
from .common import WordBlock, as_row, cut, from_row, map_batches, mix, read_table, shuffle_partitions, small_or_not, text_blocks, whole_text
from .exact_dedup import join_hot


@dataclass(frozen=True)
class JaccardParams:
    words: int = 4
    percent: int = 85
    hot_share: int = 2000  # a shingle in more than one of so many documents is hot
    hot_list: int = 200_000  # the longest list of hot shingles
    filter_bits: int = 1 << 26  # of the filter for sets that occur in candidate pairs


#: Bits of a shingle's hash, so that with the number of its text (4096 to a block) it is one 64-bit value.
HASH_BITS = 52
SKETCH_WORDS = 8
#: Partitions of the universe over all shingles that are tried before empty segments are indexed.
PARTITIONS = 4
#: Bytes of text among which a shingle must be frequent to be counted as maybe hot.
HOT_BLOCK = 1 << 20
#: Members of one signature that are compared with one another in a task's memory.
GROUP_BLOCK = 4096
#: Members of a component among which all pairs are looked at, by sketches in blocks; in larger ones those that share a signature.
WHOLE_COMPONENT = 1 << 18
#: Members of a component that meet one copy of its center's set.
MEMBERS_AT_ONCE = 4096

# --------------------------------------------------------------------------- sets


def shingle_sets(data: np.ndarray, offsets: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingle hashes of each text, ascending within it, and where each text's begin."""
    block = WordBlock(data, offsets, lower=True)
    first, h = block.windows(n)
    text = block.text_of[first]
    short = np.flatnonzero((block.n_words > 0) & (block.n_words < n))
    if len(short):
        whole = np.zeros(len(short), np.uint64)
        for k in range(n - 1):
            has = block.n_words[short] > k
            at = block.word_offsets[short[has]] + k
            whole[has] = whole[has] * np.uint64(0xA0761D6478BD642F) + block.hashes[at]
        h = np.concatenate([h, mix(whole + block.n_words[short].astype(np.uint64))])
        text = np.concatenate([text, short])
    # one sort of single values: the text's number above 52 bits of hash
    both = np.sort((text.astype(np.uint64) << np.uint64(HASH_BITS)) | (h >> np.uint64(64 - HASH_BITS)))
    new = np.ones(len(both), bool)
    new[1:] = both[1:] != both[:-1]
    both = both[new]
    starts = np.arange(block.n_texts + 1, dtype=np.uint64) << np.uint64(HASH_BITS)
    bounds = np.searchsorted(both, starts[:-1])
    return both & np.uint64((1 << HASH_BITS) - 1), np.append(bounds, len(both))


def parity_sketches(h: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """SKETCH_WORDS words of bits per set, each the parity of the shingles that fall on it.

    A shingle that only one of two sets has changes one bit between them, so the number of bits in which their
    sketches differ is at most the number of shingles in which they do.
    """
    out = np.zeros((len(bounds) - 1, SKETCH_WORDS), np.uint64)
    dealt = mix(h + np.uint64(0x2545F4914F6CDD1D))
    word = (dealt >> np.uint64(32)) % np.uint64(SKETCH_WORDS)
    np.bitwise_xor.at(out.reshape(-1), np.repeat(np.arange(len(out)), np.diff(bounds)) * SKETCH_WORDS + word.astype(np.int64), np.uint64(1) << (dealt & np.uint64(63)))
    return out


def set_sums(h: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Two independent 64-bit sums of each set's hashes (0 for an empty one): its key, and what tells sets of one key apart."""
    sizes = np.diff(bounds)
    out = []
    for seed in (1, 0x3C6EF372FE94F82B):
        sums = np.zeros(len(h) + 1, np.uint64)
        np.cumsum(mix(h + np.uint64(seed)), out=sums[1:])
        out.append(np.where(sizes > 0, mix(sums[bounds[1:]] - sums[bounds[:-1]] + sizes.astype(np.uint64)), np.uint64(0)))
    return out[0], out[1]


def set_keys(h: np.ndarray, bounds: np.ndarray, parted: frozenset[tuple[int, int]] = frozenset()) -> np.ndarray:
    """A key of each set; ``parted`` are the (key, check) of sets whose key another set has too."""
    key, check = set_sums(h, bounds)
    if parted:
        for k in np.flatnonzero(np.isin(key, np.array([x for x, _ in parted], np.uint64))):
            if (int(key[k]), int(check[k])) in parted:
                key[k] = parted_key(key[k], check[k])
    return key


def parted_key(key: np.uint64, check: np.uint64) -> np.uint64:
    return mix(np.array([key ^ (check << np.uint64(1))], np.uint64))[0]


# --------------------------------------------------------------------------- bands and weights


def band_starts(largest: int, percent: int) -> list[int]:
    starts = [1]
    while starts[-1] <= largest:
        starts.append(starts[-1] * 100 // percent + 1)
    return starts


def most_apart(size: int, percent: int) -> int:
    """The most shingles in which two linked sets of at most ``size`` differ."""
    return 2 * size * (100 - percent) // (100 + percent)


@dataclass(frozen=True)
class Scheme:
    """Weights of one band's segments, the first ``doubled`` of them 2; a segment's share of the universe goes by its weight."""

    band: int
    doubled: int
    single: int
    slack: int

    @property
    def segments(self) -> int:
        return self.doubled + self.single


def choose_scheme(band: int, start: int, end: int, percent: int, documents: int, common: float) -> Scheme:
    """The cheapest weights for a band: the signatures that a document gives, plus the pairs its segments make by chance.

    Few differences leave segments of weight 1 with few shingles. Doubling some makes them larger, so that chance
    agreement is rarer, for one signature more per shingle of theirs. ``common`` is the part of all shingles that
    is hot; a pair costs as much as 1/40 of a signature.
    """
    apart = most_apart(end, percent)
    slack = 1 + apart // 50 if apart else 0
    need = apart + 1 + slack
    unit, chance = (start + end) / 2 / need, min(1.0, common + 0.05)
    found = []
    for doubled in range(min(need // 2, 4) + 1):
        single = need - 2 * doubled
        given = single + doubled * (1 + 2 * unit)
        alike = single * chance**unit + doubled * (1 + 2 * unit) * chance ** max(0.0, 2 * unit - 1)
        found.append((given + documents * alike / 40, doubled, Scheme(band, doubled, single, slack)))
    return min(found, key=lambda x: x[:2])[2]


def signatures(h: np.ndarray, bounds: np.ndarray, keys: np.ndarray, hot: np.ndarray, starts: list[int], schemes: dict[int, Scheme]) -> tuple[np.ndarray, np.ndarray]:
    """(signature, set key) rows of a block of sets."""
    sizes = np.diff(bounds)
    own = np.searchsorted(starts, sizes, "right") - 1
    is_hot = np.zeros(len(h), bool)
    if len(hot) and len(h):
        is_hot = hot[np.minimum(np.searchsorted(hot, h), len(hot) - 1)] == h
    set_of = np.repeat(np.arange(len(sizes)), sizes)
    found: list[tuple[np.ndarray, np.ndarray]] = []
    for step in (0, 1):
        band = own + step
        doubled, single, slack = (np.array([getattr(schemes[b], f) if n and b in schemes else 0 for b, n in zip(band, sizes)], np.int64) for f in ("doubled", "single", "slack"))
        use = (doubled + single > 0) & (sizes > 0)
        if not use.any():
            continue
        thin = _route(h, set_of, use, ~is_hot, band, doubled, single, keys, 0, None, found)
        rest = use & (thin > slack)
        if rest.any():
            every = np.ones(len(h), bool)
            # sets that only share thin segments are both thin, so they meet in the next partition of the universe
            for route in range(1, PARTITIONS + 1):
                thin = _route(h, set_of, rest, every, band, doubled, single, keys, route, None, found)
                rest = rest & (thin > slack)
                if not rest.any():
                    break
            else:
                _route(h, set_of, rest, every, band, doubled, single, keys, PARTITIONS, "thin", found)
    if not found:
        return np.empty(0, np.uint64), np.empty(0, np.uint64)
    return np.concatenate([a for a, _ in found]), np.concatenate([b for _, b in found])


def _route(h, set_of, use, part, band, doubled, single, keys, route, only, found) -> np.ndarray:
    """Adds the signatures of the sets in ``use`` over the shingles in ``part``; returns each set's weight of thin segments."""
    units = 2 * doubled + single
    counts = np.where(use, doubled + single, 0)
    base = np.concatenate([[0], np.cumsum(counts)])
    at = np.flatnonzero(use[set_of] & part)
    owner, token = set_of[at], h[at]
    with np.errstate(over="ignore"):
        dealt = mix(token ^ (np.uint64(0x5851F42D4C957F2D) * np.uint64(2 * max(route, 1) - 1)))
        unit = ((dealt >> np.uint64(32)) * units[owner].astype(np.uint64) >> np.uint64(32)).astype(np.int64)
        segment = np.where(unit < 2 * doubled[owner], unit // 2, unit - doubled[owner])
        place = base[owner] + segment
        value = mix(token + np.uint64(0x14057B7EF767814F))
        sums, held = np.zeros(base[-1], np.uint64), np.bincount(place, minlength=base[-1])
        np.add.at(sums, place, value)
        holder = np.repeat(np.arange(len(use)), counts)
        number = np.arange(base[-1]) - base[holder]
        salt = mix((band[holder].astype(np.uint64) << np.uint64(40)) + (number.astype(np.uint64) << np.uint64(2)) + (np.uint64(PARTITIONS + 1 if only else route) << np.uint64(56)))
        weight = np.where(number < doubled[holder], 2, 1)
        thin = np.bincount(holder, np.where(held <= weight - 1, weight, 0), minlength=len(use))
        if only == "thin":
            # empty subsets, and those of one shingle less it: all the same empty signature of their segment
            few = held <= weight - 1
            found.append((mix(salt[few]), keys[holder[few]]))
            return thin
        full = held > 0
        found.append((mix(salt[full] + sums[full]), keys[holder[full]]))
        less = (weight[place] == 2) & (held[place] > 1)
        found.append((mix(salt[place[less]] + sums[place[less]] - value[less]), keys[owner[less]]))
    return thin


# --------------------------------------------------------------------------- the join


def _key_rows(docs: DataFrame, params: JaccardParams) -> DataFrame:
    """Rows of two kinds: 0 (doc_id, the text's hash, set key and check, size, sketch) and 2 (a shingle frequent in some block of texts, its count there)."""
    n = params.words

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo, hi, data, offsets in text_blocks(batch.column("text"), most=HOT_BLOCK):
                h, bounds = shingle_sets(data, offsets, n)
                m = hi - lo
                key, told = set_sums(h, bounds)
                yield _rows(np.zeros(m, np.int8), batch.column("doc_id").slice(lo, m), batch.column("text_hash").slice(lo, m), key.view(np.int64), told.view(np.int64), np.diff(bounds), _lists(parity_sketches(h, bounds)))
                if len(h):
                    shingle, count = np.unique(h, return_counts=True)
                    often = count >= max(3, m // 250)
                    shingle, count = shingle[often], count[often]
                    none, null = pa.ListArray.from_arrays(np.zeros(len(shingle) + 1, np.int32), pa.array([], pa.int64())), pa.nulls(len(shingle), pa.int64())
                    yield _rows(np.full(len(shingle), 2, np.int8), null, null, shingle.view(np.int64), np.zeros(len(shingle), np.int64), count, none)

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_hash().alias("text_hash"), "text")
    return map_batches(rows, scan, "kind byte, doc_id long, text_hash long, key long, told long, n long, sketch array<long>")


def text_hash() -> Column:
    return F.xxhash64(whole_text())


def _lists(rows: np.ndarray) -> pa.Array:
    return pa.ListArray.from_arrays(np.arange(len(rows) + 1, dtype=np.int32) * rows.shape[1], pa.array(rows.reshape(-1).view(np.int64)))


def _rows(kind, ids, text_hash, key, told, n, sketch) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(kind), ids, text_hash, pa.array(key), pa.array(told), pa.array(n.astype(np.int64)), sketch], ["kind", "doc_id", "text_hash", "key", "told", "n", "sketch"])


class JaccardJoin:
    """The join of one table; ``classes`` is its result."""

    def __init__(self, docs: DataFrame, params: JaccardParams = JaccardParams()):
        self.docs, self.params, self.spark = docs, params, docs.sparkSession
        rows = cut(_key_rows(docs, params))
        self.rows, self.parted = self.tell_apart(rows.filter("kind = 0"))
        self.keys = self.rows.select("doc_id", "text_hash", "key", "n")
        self.sets = self.keys.filter("n > 0").groupBy("key").agg(F.min("doc_id").alias("first_id"), F.max("n").alias("n"), F.count(F.lit(1)).alias("copies"))
        total, largest, shingles = self.keys.agg(F.count(F.lit(1)), F.max("n"), F.sum("n")).first()
        least = max(16, total // params.hot_share)
        listed = rows.filter("kind = 2").groupBy("key").agg(F.sum("n").alias("n")).filter(F.col("n") >= least).orderBy(F.desc("n"), "key").limit(params.hot_list).toArrow()
        self.hot = np.sort(listed["key"].to_numpy().view(np.uint64))
        common = float(listed["n"].to_numpy().sum()) / max(1, shingles or 0)
        self.starts = edges = band_starts(int((largest or 0) * 100 // params.percent) + 1, params.percent)
        bands = self.keys.filter("n > 0").groupBy(_band_of(edges).alias("band")).agg(F.count(F.lit(1)).alias("documents")).collect()
        own = {r["band"]: r["documents"] for r in bands}
        per_band = {b: own.get(b, 0) + own.get(b - 1, 0) for b in range(len(edges) - 1)}
        self.schemes = {b: choose_scheme(b, edges[b], edges[b + 1] - 1, params.percent, n, common) for b, n in per_band.items() if n}

    def tell_apart(self, rows: DataFrame) -> tuple[DataFrame, frozenset[tuple[int, int]]]:
        """``rows`` in which different sets have different keys, and the (key, check) of sets that got another one.

        Two sets have one 64-bit key with a chance of 1 in 2**64, so hardly any are found, however many sets there are.
        """
        several = rows.filter("n > 0").groupBy("key").agg(F.min("told").alias("low"), F.max("told").alias("high")).filter("low != high")
        others = rows.join(F.broadcast(several), "key").filter("told != low").select("key", "told").distinct().collect()  # see above
        word = lambda x: np.array([x], np.int64).view(np.uint64)[0]
        for r in others:
            own = int(np.array([parted_key(word(r["key"]), word(r["told"]))]).view(np.int64)[0])
            rows = rows.withColumn("key", F.when((F.col("key") == r["key"]) & (F.col("told") == r["told"]), F.lit(own)).otherwise(F.col("key")))
        return rows, frozenset((int(word(r["key"])), int(word(r["told"]))) for r in others)

    def groups(self) -> DataFrame:
        """(sig, key): the members of every signature that several sets hold."""
        spark, n = self.spark, self.params.words
        hot, starts, schemes, parted = spark.sparkContext.broadcast(self.hot), self.starts, self.schemes, self.parted

        def give(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            seen: set[int] = set()
            for batch in batches:
                for _, _, data, offsets in text_blocks(batch.column("text")):
                    h, bounds = shingle_sets(data, offsets, n)
                    keys = set_keys(h, bounds, parted)
                    fresh = np.array([not (k in seen or seen.add(k)) for k in keys.tolist()], bool)
                    if len(seen) > 200_000:
                        seen.clear()
                    sizes = np.diff(bounds)
                    h = h[np.repeat(fresh, sizes)]
                    sig, key = signatures(h, np.concatenate([[0], np.cumsum(sizes[fresh])]), keys[fresh], hot.value, starts, schemes)
                    for a in range(0, len(sig), 100_000):
                        yield pa.RecordBatch.from_arrays([pa.array(sig[a : a + 100_000].view(np.int64)), pa.array(key[a : a + 100_000].view(np.int64))], ["sig", "key"])

        rows = map_batches(self.docs.select("text"), give, "sig long, key long")
        sorted_rows = rows.repartition(shuffle_partitions(spark), "sig").sortWithinPartitions("sig", "key")
        found = cut(map_batches(sorted_rows, shared_only, "sig long, key long"))
        hot.destroy()
        return found

    def compared(self, rows: DataFrame, inside: bool = False) -> DataFrame:
        """The pairs in a group of (sig, blocks, key, label, e, d) that may link by size and sketch, once for each block: those of
        different labels, or ``inside`` a component those of one label of which e and d don't tell."""
        rest = rows.join(self.sketches(), "key").withColumn("own", F.pmod(F.xxhash64("key"), F.col("blocks")).cast("int"))
        rest = rest.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
        rest = rest.select("sig", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"), "own", "key", "label", "n", "e", "d", "sketch")
        rest = rest.repartition(shuffle_partitions(self.spark), "sig", "i", "j").sortWithinPartitions("sig", "i", "j", "key")
        percent = self.params.percent
        return map_batches(rest, lambda batches: across(batches, percent, inside), "a long, b long")

    def run(self) -> DataFrame:
        """(key, label): the component of every set that links with another, by its smallest key; labels are keys.

        It verifies as many pairs as components need; ``link_counts`` does the rest.
        """
        self.held_groups = groups = self.groups()
        members = groups.groupBy("sig").agg(F.count(F.lit(1)).alias("members"))
        weights = groups.join(members, "sig").groupBy("key").agg(F.sum("members").alias("weight"))
        central = groups.join(weights, "key").groupBy("sig").agg(F.max(F.struct("weight", "key")).alias("top")).select("sig", F.col("top.key").alias("center"))
        stars = groups.join(central, "sig").filter("key != center").select(F.least("key", "center").alias("a"), F.greatest("key", "center").alias("b")).distinct()
        self.held_sets = sets = self.members(groups.select("key").distinct())
        self.links = links = cut(self.verified(self.near_enough(stars), sets))
        labels = components(links)
        # only groups that still span several components
        own = groups.join(labels, "key", "left").select("sig", "key", F.coalesce("label", "key").alias("label"))
        open_ = own.groupBy("sig").agg(F.min("label").alias("low"), F.max("label").alias("high"), F.count(F.lit(1)).alias("members")).filter("low != high and members > 2").select("sig", F.ceil(F.col("members") / GROUP_BLOCK).cast("int").alias("blocks"))
        pairs = cut(self.compared(own.join(open_, "sig").withColumns({"e": F.lit(0).cast("long"), "d": F.lit(0).cast("long")})).distinct())
        more = cut(self.verified(pairs, sets))
        return labels if more.isEmpty() else components(links.unionByName(more))

    def link_counts(self, labels: DataFrame) -> DataFrame:
        """(key, n_links): how many documents of other sets a set of a component links with.

        Sets a, b of n_a and n_b shingles link where they differ in s of them and (100 + percent) s <= (100 - percent) (n_a + n_b). Of
        each component's most linked set c every member's distance d is taken; s <= d_a + d_b, so with
        e = (100 + percent) d - (100 - percent) n all pairs of e_a + e_b <= 0 link, and are counted by sums over e without
        being looked at. The others are compared where they share a signature, by s >= |d_a - d_b|, by sketch, and exactly.
        """
        percent = self.params.percent
        own = labels.join(self.sets.select("key", "n", "copies"), "key")
        degrees = self.links.select(F.explode(F.array("a", "b")).alias("key")).groupBy("key").agg(F.count(F.lit(1)).alias("degree"))
        centers = cut(labels.join(degrees, "key", "left").groupBy("label").agg(F.max_by("key", F.struct(F.coalesce("degree", F.lit(0)), F.col("key"))).alias("center"), F.count(F.lit(1)).alias("members")))
        members = cut(self.distances(join_hot(own, centers, "label", "members"), centers).withColumn("e", F.lit(100 + percent) * F.col("d") - F.lit(100 - percent) * F.col("n")))
        # certain links: the copies of all members up to -e, without the set's own
        points = members.select("label", F.col("e").alias("v"), "copies", F.lit(0).alias("asked")).unionByName(members.select("label", (-F.col("e")).alias("v"), F.lit(0).cast("long").alias("copies"), F.lit(1).alias("asked")))
        sums = points.groupBy("label", "v").agg(F.sum("copies").alias("copies"), F.sum("asked").alias("asked"))
        up_to = sums.select(F.struct("label", "v").alias("place"), F.sum("copies").over(Window.partitionBy("label").orderBy("v")).alias("up_to"), "asked").filter("asked > 0")
        certain = join_hot(members.withColumn("place", F.struct(F.col("label"), (-F.col("e")).alias("v"))), cut(up_to), "place", "asked")
        certain = certain.select("key", (F.col("up_to") - F.when(F.col("e") <= 0, F.col("copies")).otherwise(F.lit(0))).alias("n_links"))
        # the others
        most = cut(members.groupBy("label").agg(F.max("e").alias("most"), F.count(F.lit(1)).alias("members")))
        unsure = cut(join_hot(members, most, "label", "members").filter("e + most > 0").select("key", "label", "e", "d"))
        of_label = unsure.groupBy("label").agg(F.count(F.lit(1)).alias("members")).filter("members > 1")
        # a component's unsure members are compared once each; those of the largest components where they share a signature, once for each
        whole = join_hot(unsure, of_label.filter(F.col("members") <= WHOLE_COMPONENT), "label", "members").filter("members is not null").withColumn("sig", F.col("label"))
        whole = whole.select("sig", "key", "label", "e", "d", F.ceil(F.col("members") / GROUP_BLOCK).cast("int").alias("blocks"))
        pairs = self.compared(whole, inside=True)
        large = of_label.filter(F.col("members") > WHOLE_COMPONENT).select("label")
        if not large.isEmpty():
            groups = self.held_groups.join(unsure.join(large, "label", "left_semi"), "key").withColumn("sig", F.xxhash64("sig", "label"))
            several = groups.groupBy("sig").agg(F.count(F.lit(1)).alias("members")).filter("members > 1").select("sig", F.ceil(F.col("members") / GROUP_BLOCK).cast("int").alias("blocks"))
            pairs = pairs.unionByName(self.compared(groups.join(several, "sig"), inside=True).distinct())
        links = cut(self.verified(cut(pairs), self.held_sets))
        copies = self.sets.select("key", "copies")
        both = links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
        found = both.join(copies.withColumnRenamed("key", "b"), "b").select(F.col("a").alias("key"), F.col("copies").alias("n_links"))
        return certain.unionByName(found).groupBy("key").agg(F.sum("n_links").alias("n_links"))

    def distances(self, own: DataFrame, centers: DataFrame) -> DataFrame:
        """Members (key, label, n, copies, center, members) with d, in how many shingles they differ from their component's center.

        A center's set is repeated for every MEMBERS_AT_ONCE members, so that those of a large component don't meet in one task.
        """
        parts = F.ceil(F.col("members") / MEMBERS_AT_ONCE).cast("int")
        left = own.join(self.held_sets, "key").withColumn("part", F.pmod(F.xxhash64("key"), parts).cast("int"))
        right = centers.join(self.held_sets.select(F.col("key").alias("center"), F.col("shingles").alias("others")), "center")
        right = right.select("label", F.explode(F.sequence(F.lit(0), parts - 1)).alias("part"), "others")
        both = left.select("key", "label", "n", "copies", "part", "shingles").join(right, ["label", "part"]).select("key", "label", "n", "copies", "shingles", "others")

        def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                d = [len(x) + len(y) - 2 * common(x, y) for x, y in set_pairs(batch)]
                yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in ("key", "label", "n", "copies")), pa.array(d, pa.int64())], ["key", "label", "n", "copies", "d"])

        return map_batches(both, measure, "key long, label long, n long, copies long, d long")

    def sketches(self) -> DataFrame:
        return self.rows.filter("n > 0").select("key", "n", "sketch").dropDuplicates(["key"])

    def near_enough(self, pairs: DataFrame) -> DataFrame:
        """The pairs whose sizes and sketches leave a link possible."""
        own = self.sketches()
        both = pairs.join(own.select(F.col("key").alias("a"), F.col("n").alias("n_a"), F.col("sketch").alias("s_a")), "a")
        both = both.join(own.select(F.col("key").alias("b"), F.col("n").alias("n_b"), F.col("sketch").alias("s_b")), "b")
        percent = self.params.percent
        both = both.filter(F.lit(100) * F.least("n_a", "n_b") >= F.lit(percent) * F.greatest("n_a", "n_b"))
        apart = "aggregate(zip_with(s_a, s_b, (x, y) -> bit_count(x ^ y)), 0, (s, x) -> s + x)"
        return both.filter(f"{apart} <= (n_a + n_b) * {100 - percent} div {100 + percent}").select("a", "b")

    def verified(self, pairs: DataFrame, sets: DataFrame) -> DataFrame:
        """The pairs (a, b) that link, checked on the whole sets."""
        percent = self.params.percent
        with_b = pairs.join(sets.withColumnRenamed("key", "b"), "b").select("a", "b", F.col("shingles").alias("others"))
        both = with_b.join(sets.withColumnRenamed("key", "a"), "a").select("a", "b", "shingles", "others")

        def check(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                good = np.zeros(len(batch), bool)
                for k, (x, y) in enumerate(set_pairs(batch)):
                    shared = common(x, y)
                    good[k] = 100 * shared >= percent * (len(x) + len(y) - shared)
                yield pa.RecordBatch.from_arrays([batch.column("a"), batch.column("b")], ["a", "b"]).filter(pa.array(good))

        return map_batches(both, check, "a long, b long")

    def members(self, wanted: DataFrame) -> DataFrame:
        """(key, shingles) of the wanted sets. A filter of bounded size keeps most others from the shuffle."""
        bits, n = self.params.filter_bits, self.params.words
        place = F.pmod(F.col("key"), F.lit(bits))
        words = wanted.select(F.shiftright(place, 6).alias("word"), F.pmod(place, F.lit(64)).cast("int").alias("bit")).selectExpr("word", "shiftleft(1L, bit) as mark")
        words = words.groupBy("word").agg(F.bit_or("mark").alias("marks")).toArrow()  # bits / 64 rows at most
        table = np.zeros(bits // 64, np.uint64)
        table[words["word"].to_numpy()] = words["marks"].to_numpy().view(np.uint64)
        held, parted = self.spark.sparkContext.broadcast(table), self.parted

        def pick(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            seen: set[int] = set()
            for batch in batches:
                for _, _, data, offsets in text_blocks(batch.column("text")):
                    h, bounds = shingle_sets(data, offsets, n)
                    keys = set_keys(h, bounds, parted)
                    at = keys & np.uint64(bits - 1)
                    maybe = np.flatnonzero(((held.value[(at >> np.uint64(6)).astype(np.int64)] >> (at & np.uint64(63))) & np.uint64(1)) == 1)
                    maybe = [k for k in maybe if bounds[k + 1] > bounds[k] and not (keys[k] in seen or seen.add(keys[k]))]
                    if len(seen) > 200_000:
                        seen.clear()
                    if maybe:
                        yield pa.RecordBatch.from_arrays([pa.array(keys[maybe].view(np.int64)), pa.array([h[bounds[k] : bounds[k + 1]].tobytes() for k in maybe], pa.binary())], ["key", "shingles"])

        found = map_batches(self.docs.select("text"), pick, "key long, shingles binary").join(wanted, "key", "left_semi")
        found = cut(found.dropDuplicates(["key"]))
        held.destroy()
        return found

    def classes(self, counted: bool = False) -> DataFrame:
        """doc_id, text_hash, n_shingles, component_id of every document, and with ``counted`` n_links: how many other documents it links with."""
        labels = self.run()
        merged = self.sets.join(labels, "key", "left").select("key", "copies", "first_id", F.coalesce("label", "key").alias("label"))
        lowest = merged.groupBy("label").agg(F.min("first_id").alias("lowest"), F.sum("copies").alias("size")).filter("size > 1")
        found = merged.join(lowest, "label").select("key", F.col("lowest").alias("component"), F.col("copies").alias("times"))
        if counted:
            found = found.join(self.link_counts(labels), "key", "left").withColumn("n_links", F.coalesce("n_links", F.lit(0)) + F.col("times") - 1)
        rows = join_hot(self.keys, cut(found), "key", "times")
        columns = ["doc_id", "text_hash", F.col("n").alias("n_shingles"), F.coalesce("component", "doc_id").alias("component_id")]
        return rows.select(*columns, *([F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links")] if counted else []))


def set_pairs(batch: pa.RecordBatch) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    for x, y in zip(batch.column("shingles"), batch.column("others")):
        yield np.frombuffer(x.as_buffer(), np.uint64), np.frombuffer(y.as_buffer(), np.uint64)


def common(x: np.ndarray, y: np.ndarray) -> int:
    """How many shingles two sets share."""
    if len(x) > len(y):
        x, y = y, x
    return int((y[np.minimum(np.searchsorted(y, x), len(y) - 1)] == x).sum())


def _band_of(starts: list[int]) -> Column:
    return F.expr("size(filter(array(" + ",".join(f"{s}L" for s in starts) + "), s -> s <= n)) - 1")


def shared_only(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of rows sorted by (sig, key), those of signatures with several keys, once each.

    It holds a batch and the last row before it, however long a signature's run is.
    """
    last: tuple[int, int] | None = None
    told = True  # whether the last row was given out

    for batch in batches:
        sig, key = batch.column("sig").to_numpy(), batch.column("key").to_numpy()
        new = np.ones(len(sig), bool)
        new[1:] = (sig[1:] != sig[:-1]) | (key[1:] != key[:-1])
        if last is not None and len(sig) and (sig[0], key[0]) == last:
            new[0] = False
        sig, key = sig[new], key[new]
        if not len(sig):
            continue
        if last is not None:
            sig, key = np.concatenate([[last[0]], sig]), np.concatenate([[last[1]], key])
        same = sig[1:] == sig[:-1]
        give = np.zeros(len(sig), bool)
        give[1:] |= same
        give[:-1] |= same
        last_given = bool(give[-1])
        if last is not None and told:
            give[0] = False
        last, told = (int(sig[-1]), int(key[-1])), last_given
        yield pa.RecordBatch.from_arrays([pa.array(sig[give]), pa.array(key[give])], ["sig", "key"])


def across(batches: Iterator[pa.RecordBatch], percent: int, inside: bool = False) -> Iterator[pa.RecordBatch]:
    """Of rows sorted by (sig, i, j), the pairs of one (sig, i, j) and different labels that may link by size and sketch; or, ``inside``
    components, of one label and neither sure to link nor sure not to by their distances from the center.

    Rows i == j compare a block's members with one another, i < j those of block i with those of block j.
    """
    names = ["sig", "i", "j", "own", "key", "label", "n", "e", "d"]

    def read(batch: pa.RecordBatch) -> list[np.ndarray]:
        sketch = batch.column("sketch").flatten().to_numpy().view(np.uint64).reshape(-1, SKETCH_WORDS)
        return [*(batch.column(c).to_numpy() for c in names), sketch]

    def pairs(held: list[np.ndarray], end: int) -> Iterator[pa.RecordBatch]:
        sig, i, j, own, key, label, n, e, d, sketch = (x[:end] for x in held)
        opens = np.flatnonzero(np.concatenate([[True], (sig[1:] != sig[:-1]) | (i[1:] != i[:-1]) | (j[1:] != j[:-1])]))
        lengths = np.diff(np.append(opens, end))
        stop = np.repeat(opens + lengths, lengths)
        at, step = np.arange(end), 1
        while True:
            at = at[at + step < stop[at]]
            if not len(at):
                return
            to = at + step
            if inside:
                ok = (label[at] == label[to]) & (e[at] + e[to] > 0) & ((100 + percent) * np.abs(d[at] - d[to]) <= (100 - percent) * (n[at] + n[to]))
            else:
                ok = label[at] != label[to]
            ok &= ((i[at] == j[at]) | (own[at] != own[to])) & (100 * np.minimum(n[at], n[to]) >= percent * np.maximum(n[at], n[to]))
            a, b = at[ok], to[ok]
            near = np.bitwise_count(sketch[a] ^ sketch[b]).sum(axis=1) <= (n[a] + n[b]) * (100 - percent) // (100 + percent)
            a, b = key[a[near]], key[b[near]]
            if len(a):
                yield pa.RecordBatch.from_arrays([pa.array(np.minimum(a, b)), pa.array(np.maximum(a, b))], ["a", "b"])
            step += 1

    held: list[np.ndarray] | None = None
    for batch in batches:
        if not len(batch):
            continue
        fresh = read(batch)
        held = fresh if held is None else [np.concatenate(x) for x in zip(held, fresh)]
        sig, i, j = held[:3]
        whole = np.flatnonzero((sig != sig[-1]) | (i != i[-1]) | (j != j[-1]))
        end = int(whole[-1]) + 1 if len(whole) else 0
        if end:
            yield from pairs(held, end)
            held = [x[end:] for x in held]
    if held is not None:
        yield from pairs(held, len(held[0]))


def keep_one(docs: DataFrame, params: JaccardParams = JaccardParams()) -> DataFrame:
    """The rows of ``docs`` that stay, with all their columns: of each component the documents of its smallest doc_id."""
    found = JaccardJoin(docs, params).classes()
    gone = found.filter("component_id is not null and (doc_id is null or component_id != doc_id)").select(F.col("doc_id").alias("gone_id"), F.col("text_hash").alias("gone_hash")).distinct()
    own = docs.select(as_row(docs), F.col("doc_id").cast("long").alias("own_id"), text_hash().alias("own_hash"))
    return from_row(own.join(small_or_not(gone), F.col("own_id").eqNullSafe(F.col("gone_id")) & (F.col("own_hash") == F.col("gone_hash")), "left_anti"), docs.columns)


def op8_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return JaccardJoin(read_table(spark, sf_dir, "documents")).classes(counted=True).drop("text_hash")


#: DuckDB SQL of op8_jaccard_join: all pairs that share a shingle, and the closure of their links.
ORACLE_SQL = """
WITH RECURSIVE w AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x20\\x09-\\x0D]+') AS ws FROM documents),
  g AS (SELECT DISTINCT doc_id, unnest(CASE WHEN len(ws) = 0 THEN [] WHEN len(ws) < 4 THEN [array_to_string(ws, ' ')] ELSE list_transform(range(1, len(ws) - 2), lambda i: array_to_string(ws[i:i + 3], ' ')) END) AS s FROM w),
  n AS (SELECT doc_id, count(*) AS n FROM g GROUP BY doc_id),
  p AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c FROM g a JOIN g b ON a.s = b.s AND a.doc_id < b.doc_id GROUP BY a.doc_id, b.doc_id),
  l AS (SELECT a, b FROM p JOIN n na ON na.doc_id = a JOIN n nb ON nb.doc_id = b WHERE 100 * c >= 85 * (na.n + nb.n - c)),
  e AS (SELECT a, b FROM l UNION ALL SELECT b, a FROM l),
  k AS (SELECT a AS doc_id, count(*) AS n_links FROM e GROUP BY a),
  r AS (SELECT doc_id, doc_id AS other FROM documents UNION SELECT r.doc_id, e.b FROM r JOIN e ON e.a = r.other)
SELECT doc_id, coalesce(max(n.n), 0) AS n_shingles, min(other) AS component_id, coalesce(max(k.n_links), 0) AS n_links
FROM r LEFT JOIN n USING (doc_id) LEFT JOIN k USING (doc_id) GROUP BY doc_id
"""

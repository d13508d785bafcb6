"""Secret scans: pattern rules, and character Markov models of random strings and of ordinary identifiers.

Rules give the base spans (assignments, access keys, long hex runs). Further spans are the runs of at least
``least`` identifier or base64 characters whose log-likelihood ratio between two first-order Markov models passes
``threshold``; runs that overlap a base span add nothing. The models are counted from labelled samples:

* random: strings made by rule from SHA-256 (base64, hexadecimal, letters and digits), and the values that the base
  rules find in the sampled documents;
* ordinary: the other runs of the sampled documents, identifiers in common styles, and decimal numbers.

``sample_documents`` rows, those of the smallest hash of doc_id, are sampled; the models are tables over 80 by 80
characters, so what reaches the driver is bounded. Scanning is one pass over whole texts in DataFrame operations.

Null text is empty: no spans. Positions are code points, ends exclusive. Repeated rows are scanned each on their own,
an empty table gives no rows (the models then rest on the made samples), and extra columns don't matter.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import read_table, whole_text

# The base patterns.
ASSIGN = r"""([pP][aA][sS][sS][wW][oO][rR][dD]|[pP][aA][sS][sS][wW][dD]|[sS][eE][cC][rR][eE][tT]|[tT][oO][kK][eE][nN]|[aA][pP][iI]_?[kK][eE][yY])["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = "AKIA[A-Z0-9]{16,}"  # a longest run of AKIA[A-Z0-9]+ of 20 characters or more
HEX = "[0-9a-f]{24,}"
KINDS = ("assign", "access", "hex", "random")
#: Identifiers in the usual styles, labelled ordinary.
IDENTIFIERS = (
    "get_user_name", "setDefaultValue", "HttpServletRequest", "max_connections_per_host", "is-valid-email", "README_FIRST", "parseIntOrNull",
    "application/x-www-form-urlencoded", "src/main/java/com/example/App", "usr/local/share/doc", "content-type", "last_modified_at", "onClickHandler",
    "AbstractSingletonProxyFactoryBean", "total_amount_in_cents", "window_size_2", "version-10-release-notes", "utf8_general_ci", "en-US", "x86_64-linux-gnu",
    "internationalization", "kubernetes-deployment-manifest", "DEFAULT_TIMEOUT_SECONDS", "test_round_trip_of_long_texts", "index/2019/11/archive-page-12",
)


@dataclass(frozen=True)
class SecretParams:
    least: int = 14
    threshold: float = 16.0
    sample_documents: int = 2000
    made: int = 3000
    smoothing: float = 0.5


RUN = "[A-Za-z0-9+/_=-]"
FIRST, SIZE = 43, 80  # '+' .. 'z'


def found(text: Column, pattern: str) -> tuple[Column, Column]:
    """All matches of a pattern and what lies around them."""
    return F.regexp_extract_all(text, F.lit(pattern), F.lit(0)), F.split(text, pattern, -1)


SPANS = "array<struct<start:int,kind:int,end:int>>"
#: Elements of a list that a step works on at a time, so that its cost grows with the list's length, not with its square.
CHUNK = 512


def none(kind: str) -> Column:
    return F.array().cast(kind)


def bound(value: Column, use) -> Column:
    """``use`` of a value that is computed once."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def placed(kind: int, matches: Column, gaps: Column) -> Column:
    """array<struct<start, kind, end>> of matches, given the text between them."""
    return bound(F.struct(matches.alias("m"), gaps.alias("g")), lambda x: _placed(kind, x["m"], x["g"]))


def _placed(kind: int, matches: Column, gaps: Column) -> Column:
    def step(state: Column, k: Column) -> Column:
        begin = state["at"] + F.length(F.get(gaps, k))
        end = begin + F.length(F.get(matches, k))
        span = F.struct(begin.alias("start"), F.lit(kind).alias("kind"), end.alias("end"))
        return F.struct(end.alias("at"), F.concat(state["out"], F.array(span)).alias("out"))

    def chunk(state: Column, q: Column) -> Column:
        own = F.sequence(q * CHUNK, F.least(q * CHUNK + CHUNK, F.size(matches)) - 1)
        some = F.aggregate(own, F.struct(state["at"].alias("at"), none(SPANS).alias("out")), step)
        return bound(some, lambda x: F.struct(x["at"].alias("at"), F.concat(state["out"], F.array(x["out"])).alias("out")))

    chunks = F.sequence(F.lit(0), F.floor((F.size(matches) - 1) / CHUNK).cast("int"))
    start = F.struct(F.lit(0).alias("at"), none(f"array<{SPANS}>").alias("out"))
    return F.when(F.size(matches) > 0, F.flatten(F.aggregate(chunks, start, chunk)["out"])).otherwise(none(SPANS))


def base_spans(text: Column) -> Column:
    """Base spans sorted by start, then kind; one pass tells the texts that have none."""
    assign, around = found(text, ASSIGN)
    values = F.regexp_extract_all(text, F.lit(ASSIGN), F.lit(2))
    spans = bound(values, lambda v: F.filter(placed(0, assign, around), lambda s, k: F.length(F.get(v, k)) >= 6))
    return F.when(F.rlike(text, F.lit(f"{ASSIGN}|{ACCESS}|{HEX}")), F.array_sort(F.concat(spans, placed(1, *found(text, ACCESS)), placed(2, *found(text, HEX))))).otherwise(none(SPANS))


def labelled_samples(docs: DataFrame, params: SecretParams) -> DataFrame:
    """(run, secret, times): the strings that the models are counted from."""
    spark = docs.sparkSession
    number = spark.range(params.made).withColumn("b", F.unhex(F.sha2(F.col("id").cast("string").cast("binary"), 256)))
    made = number.select(F.explode(F.array(F.base64("b"), F.regexp_replace(F.base64("b"), "[+/=]", ""), F.lower(F.hex("b")), F.base64(F.expr("substring(b, 1, 18)")))).alias("run"), F.lit(True).alias("secret"), F.lit(1).alias("times"))
    plain = spark.createDataFrame([(x, False, 20) for x in IDENTIFIERS], "run string, secret boolean, times int")
    decimal = number.select(F.regexp_replace(F.conv(F.substring(F.hex("b"), 1, 14), 16, 10), "-", "").alias("run"), F.lit(False).alias("secret"), F.lit(4).alias("times"))
    ids = docs.select("doc_id").filter("doc_id is not null").distinct().orderBy(F.xxhash64("doc_id"), "doc_id").limit(params.sample_documents)
    texts = docs.join(F.broadcast(ids), "doc_id", "left_semi").select(whole_text().alias("text"))  # sample_documents ids at most
    values = texts.select(F.explode(F.concat(F.regexp_extract_all("text", F.lit(ASSIGN), F.lit(2)), F.regexp_extract_all("text", F.lit(ACCESS), F.lit(0)), F.regexp_extract_all("text", F.lit(HEX), F.lit(0)))).alias("run")).filter(F.length("run") >= 12)
    rest = texts.select(F.explode(F.regexp_extract_all(F.regexp_replace(F.regexp_replace(F.regexp_replace("text", ASSIGN, " "), ACCESS, " "), HEX, " "), F.lit(RUN + "{2,}"), F.lit(0))).alias("run"))
    parts = [values.select("run", F.lit(True).alias("secret"), F.lit(1).alias("times")), rest.select("run", F.lit(False).alias("secret"), F.lit(1).alias("times"))]
    return made.unionByName(plain).unionByName(decimal).unionByName(parts[0]).unionByName(parts[1])


def fit(samples: DataFrame, params: SecretParams) -> np.ndarray:
    """log P(next | character) under the random model less that under the ordinary one, SIZE by SIZE."""
    runs = samples.groupBy("run", "secret").agg(F.sum("times").alias("times")).filter(F.length("run") > 1)
    codes = runs.select("secret", "times", F.explode(pieces(F.col("run"))).alias("piece")).select("secret", "times", codes_of(F.col("piece")).alias("c")).filter(F.size("c") > 1)
    pairs = codes.select("secret", "times", "c", F.explode(F.sequence(F.lit(1), F.size("c") - 1)).alias("k"))
    counts = pairs.groupBy("secret", F.get("c", F.col("k") - 1).alias("a"), F.get("c", "k").alias("b")).agg(F.sum("times").alias("n")).collect()  # 2 * SIZE**2 rows at most
    table = np.full((2, SIZE, SIZE), params.smoothing)
    for r in counts:
        if 0 <= r["a"] < SIZE and 0 <= r["b"] < SIZE:
            table[int(r["secret"]), r["a"], r["b"]] += r["n"]
    share = np.log(table / table.sum(axis=2, keepdims=True))
    return share[1] - share[0]


def pieces(run: Column) -> Column:
    """A run in pieces of at most 1024 characters and the one that follows: every pair of neighbours is in one piece."""
    return F.regexp_extract_all(run, F.lit("(?=(.{1,1025})).{1,1024}"), F.lit(1))


def codes_of(piece: Column) -> Column:
    """The characters' numbers from FIRST on."""
    return F.transform(F.split(piece, ""), lambda c: F.ascii(c) - FIRST)


def log_ratio(run: Column, ratio: np.ndarray) -> Column:
    """The log-likelihood ratio of a run; its cost grows with the run's length."""
    table = F.split(F.lit(",".join(f"{x:.4f}" for x in ratio.ravel())), ",").cast("array<double>")

    def of_piece(piece: Column) -> Column:
        pair = lambda c: F.zip_with(F.slice(c, 1, F.size(c) - 1), F.slice(c, 2, F.size(c) - 1), lambda a, b: F.get(table, a * SIZE + b))
        return F.aggregate(bound(codes_of(piece), pair), F.lit(0.0), lambda x, y: x + y)

    return F.when(F.length(run) < 2, F.lit(0.0)).otherwise(F.aggregate(F.transform(pieces(run), of_piece), F.lit(0.0), lambda x, y: x + y))


def outside(spans: Column, base: Column) -> Column:
    """The spans that overlap none of the base spans; both are sorted."""

    def chunk(q: Column) -> Column:
        return bound(F.slice(spans, q * CHUNK + 1, F.lit(CHUNK)), inner)

    def inner(own: Column) -> Column:
        near = F.filter(base, lambda b: (b["start"] < F.element_at(own, -1)["end"]) & (F.get(own, F.lit(0))["start"] < b["end"]))
        return bound(near, lambda n: F.filter(own, lambda s: ~F.exists(n, lambda b: (b["start"] < s["end"]) & (s["start"] < b["end"]))))

    chunks = F.transform(F.sequence(F.lit(0), F.floor((F.size(spans) - 1) / CHUNK).cast("int")), chunk)
    return F.when((F.size(spans) > 0) & (F.size(base) > 0), F.flatten(chunks)).otherwise(spans)


def scan(docs: DataFrame, ratio: np.ndarray, params: SecretParams = SecretParams()) -> DataFrame:
    """doc_id, base and all: the base spans and all spans of each document."""
    rows = docs.select("doc_id", whole_text().alias("text"))
    rows = rows.select("doc_id", base_spans(F.col("text")).alias("base"), *(c.alias(n) for n, c in zip(("runs", "around"), found(F.col("text"), RUN + f"{{{params.least},}}"))))
    flags = F.transform("runs", lambda r: log_ratio(r, ratio) >= params.threshold)
    rows = rows.select("doc_id", "base", "runs", "around", F.when(F.size("runs") > 0, flags).otherwise(none("array<boolean>")).alias("flags"))
    spans = placed(3, F.col("runs"), F.col("around"))
    rows = rows.select("doc_id", "base", F.when(F.exists("flags", lambda x: x), F.filter(spans, lambda s, k: F.get("flags", k))).otherwise(none(SPANS)).alias("random"))
    rows = rows.select("doc_id", "base", outside(F.col("random"), F.col("base")).alias("added"))
    return rows.select("doc_id", "base", F.when(F.size("added") > 0, F.array_sort(F.concat("base", "added"))).otherwise(F.col("base")).alias("all"))


def told(spans: str) -> Column:
    """kind:start:end of spans, comma-joined."""
    names = F.array(*(F.lit(k) for k in KINDS))
    return F.concat_ws(",", F.transform(spans, lambda s: F.concat_ws(":", F.get(names, s["kind"]), s["start"].cast("string"), s["end"].cast("string"))))


def op3_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, params = read_table(spark, sf_dir, "documents"), SecretParams()
    rows = scan(docs, fit(labelled_samples(docs, params), params), params)
    counts = [F.expr(f"cast(size(filter(base, s -> s.kind = {k})) as long)").alias(f"n_{KINDS[k]}") for k in range(3)]
    return rows.select("doc_id", *counts, F.sha2(told("base").cast("binary"), 256).alias("base_sha256"), told("all").alias("spans"))

"""Removal of repeated passages against brute force, and on null, empty, repeated and clashing input."""

import hashlib
import os
import random
import re

import pytest
from pyspark.sql import functions as F

from evenfield.llm.substring_dedup import SubstringDedup, op11_substring_dedup, without_repeats

SCHEMA = "doc_id long, text string"
WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute(rows, least):
    """doc_id, n_words, n_removed, kept text, longest of every row, in the order of rows' doc_id (repeated ids by place)."""
    order = sorted(range(len(rows)), key=lambda k: (rows[k][0] is not None, rows[k][0] or 0))
    words = [WORD.findall(t or "") for _, t in rows]
    seen, out = set(), {}
    for k in order:
        w, gone = words[k], set()
        for i in range(len(w) - least + 1):
            if (key := tuple(w[i : i + least])) in seen:
                gone.update(range(i, i + least))
            seen.add(key)
        out[k] = [len(w), len(gone), " ".join(x for i, x in enumerate(w) if i not in gone), 0]
    length = least
    while True:
        places = {}
        for k, w in enumerate(words):
            for i in range(len(w) - length + 1):
                places.setdefault(tuple(w[i : i + length]), []).append(k)
        hit = {k for at in places.values() if len(at) > 1 for k in at}
        if not hit:
            return sorted((repr(rows[k][0]), *out[k]) for k in out)
        for k in hit:
            out[k][3] = length
        length *= 2


def found(spark, rows, least):
    df = spark.createDataFrame(rows, SCHEMA).repartition(3)
    got = SubstringDedup(df, least).result().select("row.doc_id", "n_words", "n_removed", "kept_text", "longest_repeat").collect()
    return sorted((repr(r[0]), *r[1:]) for r in got)


def made(seed, n=60, vocabulary=30):
    rng = random.Random(seed)
    passage = [rng.choice("abcdefghij") + str(rng.randint(0, 9)) for _ in range(70)]
    rows = []
    for k in range(n):
        w = [f"w{rng.randint(0, vocabulary)}" for _ in range(rng.choice([0, 3, 19, 20, 21, 60, 200]))]
        if rng.random() < 0.4:
            at, a = rng.randint(0, len(w)), rng.randint(0, 40)
            w[at:at] = passage[a : a + rng.randint(10, 50)]
        rows.append((k, rng.choice([" ", "\n", " \t "]).join(w)))
    rows += [(100, rows[3][1]), (101, rows[3][1]), (102, rows[5][1].replace(" ", "  ")), (103, None), (104, ""), (105, " \n"), (106, " ".join(["same"] * 300)), (107, " ".join(["x", "y"] * 90)), (None, " ".join(passage)), (108, "é" * 5000)]
    return rows


@pytest.mark.parametrize("seed,least,vocabulary", [(1, 20, 1000), (2, 20, 1), (3, 6, 3), (4, 2, 4)])
def test_against_brute_force(spark, seed, least, vocabulary):
    rows = made(seed, vocabulary=vocabulary)
    assert found(spark, rows, least) == brute(rows, least)


@pytest.mark.parametrize("seed,vocabulary", [(5, 1000), (6, 1)])
def test_what_goes_needs_no_longer_level(spark, seed, vocabulary):
    """Without the longest repeat the levels beyond the least are neither counted nor made, and everything else is the same."""
    rows = made(seed, vocabulary=vocabulary)
    dedup = SubstringDedup(spark.createDataFrame(rows, SCHEMA).repartition(3), 20, longest=False)
    got = dedup.result().select("row.doc_id", "n_words", "n_removed", "kept_text").collect()
    assert sorted((repr(r[0]), *r[1:]) for r in got) == [r[:4] for r in brute(rows, 20)]
    assert {n for n in os.listdir(dedup.folder.removeprefix("file:")) if n[-1].isdigit()} == {"settled-20"}
    assert spark.read.parquet(f"{dedup.folder}/settled-20").agg(F.sum(F.size("at"))).first()[0] == 0


def test_rows_that_repeat_id_and_text(spark):
    text = " ".join(f"w{k}" for k in range(50))
    rows = [(7, text)] * 4 + [(9, text), (7, "short one"), (7, "short one"), (None, "short one")]
    got = found(spark, rows, 20)
    assert [r for r in got if r[1] == 50] == sorted([("7", 50, 0, text, 40)] + [("7", 50, 50, "", 40)] * 3 + [("9", 50, 50, "", 40)])
    assert [r for r in got if r[1] == 2] == sorted([("7", 2, 0, "short one", 0)] * 2 + [("None", 2, 0, "short one", 0)])


def test_a_long_text_and_spans(spark):
    rng = random.Random(9)
    words = [f"w{rng.randint(0, 10**6)}" for _ in range(60_000)]
    rows = [(1, " ".join(words)), (2, " ".join(["new"] + words[500:600] + ["end"] + words[40_000:40_020]))]
    got = {r.row.doc_id: r for r in SubstringDedup(spark.createDataFrame(rows, SCHEMA)).result().collect()}
    assert (got[1].n_removed, got[1].longest_repeat) == (0, 80)
    assert [tuple(s) for s in got[2].spans] == [(1, 101), (102, 122)] and got[2].kept_text == "new end"


def test_empty_table_and_clashing_columns(spark):
    assert SubstringDedup(spark.createDataFrame([], SCHEMA)).result().collect() == []
    text = " ".join(f"w{k}" for k in range(25))
    rows = spark.createDataFrame([(1, text, 5, "a"), (2, text + " more", 6, None)], "doc_id long, text string, rank int, kept_text string")
    got = without_repeats(rows)
    assert got.columns == rows.columns
    assert sorted(map(tuple, got.collect())) == [(1, text, 5, "a"), (2, "more", 6, None)]


def test_query(spark):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text").collect()]
    got = op11_substring_dedup(spark, "/root/testdata/sf0.001").select("doc_id", "n_words", "n_removed", "kept_sha256", "longest_repeat").orderBy("doc_id").collect()
    want = [(int(i), n, r, hashlib.sha256(t.encode()).hexdigest(), longest) for i, n, r, t, longest in brute(rows, 20)]
    assert [tuple(r) for r in got] == sorted(want)

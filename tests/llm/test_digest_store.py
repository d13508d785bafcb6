"""Batches merged into a kept index of digests, against brute force."""

import random
import re

import pytest

from evenfield.llm.digest_store import DigestStore

SCHEMA = "doc_id long, text string, digest int"


def batches(seed):
    rng = random.Random(seed)
    made, ids = [], iter(rng.sample(range(1000), 400))
    for _ in range(4):
        made.append([(next(ids), rng.choice([f"text {rng.randint(0, 40)}", f"text  {rng.randint(0, 40)}", "", None, "hot"]), 1) for _ in range(rng.choice([0, 5, 60]))])
    return [*made, [], [(5000, "text 1", 1), (5000, "text 1", 1), (None, "new one", 1)]]


@pytest.mark.parametrize("seed,fanout", [(1, 2), (2, 9)])
def test_batches_against_brute_force(spark, tmp_path, seed, fanout):
    store, seen = DigestStore(spark, str(tmp_path), fanout), {}
    normal = lambda t: re.sub("[ \t-\r]+", " ", t or "")
    for rows in batches(seed):
        found = store.merge(spark.createDataFrame(rows, SCHEMA).repartition(3))
        groups = {}
        for i, t, _ in rows:
            groups.setdefault(normal(t), []).append(i)
        want = []
        for t, ids in groups.items():
            first, before = min((i for i in ids if i is not None), default=None), seen.get(t)
            for i in ids:
                want.append((i, before[0] if before else first, len(ids) + (before[1] if before else 0), before is not None))
        got = found.collect()
        assert sorted(map(repr, ((r.doc_id, r.keep_id, r.group_size, r.seen) for r in got))) == sorted(map(repr, want))
        kept = [r for r in got if r.kept]
        assert len(kept) == sum(t not in seen for t in groups) and all(r.doc_id == r.keep_id and not r.seen for r in kept)
        for t, ids in groups.items():
            seen[t] = (seen[t][0], seen[t][1] + len(ids)) if t in seen else (min((i for i in ids if i is not None), default=None), len(ids))
        assert len(store.levels()) <= fanout


def test_new_texts_read_filters_only(spark, tmp_path):
    store = DigestStore(spark, str(tmp_path))
    store.merge(spark.createDataFrame([(k, f"a {k}", 0) for k in range(50)], SCHEMA))
    (rank, name), = store.levels()
    from evenfield.llm.exact_dedup import DigestIndex

    new = DigestIndex(spark.createDataFrame([(k, f"b {k}", 0) for k in range(50)], SCHEMA)).texts().select("digest")
    assert store.found_in(name, rank, new).count() == 0
    again = DigestIndex(spark.createDataFrame([(9, "a 3", 0)], SCHEMA)).texts().select("digest")
    assert [r.keep_id for r in store.found_in(name, rank, again).collect()] == [3]


def test_a_batch_that_fails_adds_nothing(spark, tmp_path, monkeypatch):
    store = DigestStore(spark, str(tmp_path))
    store.merge(spark.createDataFrame([(1, "a", 0)], SCHEMA))
    before = store.levels()
    monkeypatch.setattr(store.tables, "commit", lambda *a: 1 / 0)
    with pytest.raises(ZeroDivisionError):
        store.merge(spark.createDataFrame([(2, "b", 0)], SCHEMA))
    assert DigestStore(spark, str(tmp_path)).levels() == before

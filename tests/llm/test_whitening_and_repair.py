"""Whitening against numpy's own solver, repair of conversations against a plain forward search; both on nulls, ties and copies."""

import hashlib
import itertools
import math
import random
import re
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from evenfield.llm.conversation_repair import Repair, op13_conversation_repair, rows_of
from evenfield.llm.embedding_whitening import Whitening, jacobi, op12_embedding_whitening

VECTORS = "vec_id long, embedding array<float>"
TURNS = "conv_id long, turn long, role string, text string"

# --------------------------------------------------------------------------- whitening


def test_jacobi_of_many_kinds():
    rng = np.random.default_rng(3)
    for d in (1, 2, 3, 7, 16, 33):
        b = rng.normal(size=(d, d + 2)) * 10.0 ** rng.integers(-4, 4, d)[:, None]
        m = b @ b.T
        e, v = jacobi(m)
        assert (np.diff(e) <= 0).all() and np.abs(v.T @ v - np.eye(d)).max() < 1e-12
        assert np.abs(m @ v - v * e).max() <= 1e-12 * np.abs(m).max()
    e, v = jacobi(np.zeros((3, 3)))
    assert not e.any() and (v == np.eye(3)).all()


def test_small_eigenvalues_are_as_accurate_as_large_ones():
    scale = np.array([1e8, 1.0, 1e-8])
    core = np.array([[2, 1, 0], [1, 2, 1], [0, 1, 2.0]])
    e, _ = jacobi(core * np.outer(scale, scale))
    # by Schur complements, which are exact here: 2, 3/2 and 4/3 at the three scales, to a relative 1e-16 of the scales' ratio
    assert np.allclose(e, [2e16, 1.5, 4 / 3 * 1e-16], rtol=1e-12)


def whitening_rows(spark, rows, **more):
    return Whitening(spark.createDataFrame(rows, VECTORS).repartition(3), **more)


def test_whitening_against_numpy(spark):
    rng = np.random.default_rng(5)
    base = rng.normal(size=(300, 7)) @ rng.normal(size=(7, 7)) * 0.2
    rows = [(k, [float(v) for v in x]) for k, x in enumerate(base)]
    rows += [(1000 + k, rows[0][1]) for k in range(200)]  # copies weigh nothing
    rows += [(2000, None), (2001, [1.0, None] + [0.0] * 5), (2002, [math.nan] * 7), (2003, [math.inf] * 7), (2004, []), (2005, [1.0] * 3), (None, rows[1][1]), (3, rows[3][1])]
    fit = whitening_rows(spark, rows, components=None)
    x = np.floor(np.array([r[1] for r in rows[:300]], np.float32).astype(float) * 256).astype(int)
    distinct = np.unique(x, axis=0)
    n, s = len(distinct), distinct.sum(axis=0)
    assert (fit.n, [int(v) for v in fit.sums]) == (n, s.tolist())
    centred = distinct - s / n
    v = centred.T @ centred / n
    assert np.allclose(fit.covariance, v, rtol=1e-12)
    assert np.allclose(fit.values, np.linalg.eigvalsh(v)[::-1], rtol=1e-9)
    got = fit.apply().collect()
    assert len(got) == 502
    for r in got:
        if r.vec_id is not None and r.vec_id < 300:
            assert r.deviation == int(((n * x[r.vec_id] - s) ** 2).sum())
            assert np.allclose(np.abs(r.whitened), np.abs((x[r.vec_id] - s / n) @ fit.vectors / np.sqrt(fit.values)))
    w = (distinct - s / n) @ fit.matrix
    assert np.abs(w.T @ w / n - np.eye(7)).max() < 1e-9 and fit.identity_error() < 1e-9


def test_whitening_of_huge_entries_and_few_rows(spark):
    rows = [(0, [1e30, 0.0]), (1, [-1e30, 1.0]), (2, [0.5, -1.0])]
    fit = whitening_rows(spark, rows)
    x = [[2**63 - 1, 0], [-(2**63), 256], [128, -256]]
    s = [sum(r[k] for r in x) for k in range(2)]
    assert [int(v) for v in fit.sums] == s and len(fit.values) == 1  # the other eigenvalue is zero to rounding
    assert sorted(str(r.deviation) for r in fit.apply().collect()) == ["655873", "None", "None"]  # beyond a long: null
    assert op_rows(spark, [(1, [0.5, 0.25])]) == [] and op_rows(spark, []) == [] and op_rows(spark, [(1, None)]) == []
    far = whitening_rows(spark, [(k, [float(k) * 2.0**40, float(k % 3)]) for k in range(9)])
    assert far.identity_error() < 1e-9 and all(r.deviation is None or r.deviation >= 0 for r in far.apply().collect())


def op_rows(spark, rows):
    fit = whitening_rows(spark, rows)
    return fit.apply().collect() if fit.d and len(fit.values) else []


def test_whitening_query(spark):
    got = op12_embedding_whitening(spark, "/root/testdata/sf0.001").toPandas()
    table = spark.read.parquet("/root/testdata/sf0.001/embeddings.parquet").toPandas()
    x = np.floor(np.stack(table["embedding"]).astype(float) * 256).astype(int)
    distinct = np.unique(x, axis=0)
    n, s = len(distinct), distinct.sum(axis=0)
    v = (distinct - s / n).T @ (distinct - s / n) / n
    e = np.linalg.eigvalsh(v)[::-1]
    assert len(got) == 4 * len(table) and set(got["n"]) == {n} and got["identity_error"].iloc[0] < 1e-9
    assert np.allclose(got.groupby("component")["explained"].first(), e[:4] / e.sum(), rtol=1e-9)
    assert dict(zip(got["vec_id"], got["deviation"])) == {int(i): int(d) for i, d in zip(table["vec_id"], ((n * x - s) ** 2).sum(axis=1))}


# --------------------------------------------------------------------------- conversations


def damage(rows):
    out = []
    for c, t, role, text in rows:
        space = lambda v: " " if v is None else str(v)
        kind = zlib.crc32(f"{space(c)}:{space(t)}".encode()) % 20
        role, text = space(role), space(text)
        row = (c, t, "user" if kind == 4 else role, "" if kind == 1 else re.sub("[.!?]", "", text) if kind == 2 else text)
        out += [] if kind == 0 else [row] * (2 if kind == 3 else 1)
    return out


def brute(rows, ids):
    """The report of each id from its rows in order, by a forward search over whole edit strings."""
    out = {}
    for c in ids:
        own = sorted((r for r in rows if r[0] == c), key=lambda r: (r[1] is not None, r[1] or 0))
        faults, seen = [], set()
        for _, _, role, text in own:
            last = re.findall(r"[^\x20\x09-\x0D]", text)[-1:]
            faults.append("blank" if not last else "duplicate" if (role, text) in seen else "truncated" if last[0] not in ".!?" else "")
            seen.add((role, text))
        turns = [r[1] for r in own if r[1] is not None]
        initials = [r[2][:1] for r in own]
        best = {"": (0, "", [])}
        legal = {"": "su", "s": "u", "u": "a", "a": "u"}

        def grow(best):
            best = dict(best)
            for _ in range(3):
                for state, (cost, audit, done) in list(best.items()):
                    for name in ("user", "assistant"):
                        if name[0] in legal[state]:
                            new = (cost + 5, audit + "I", [*done, name + ":"])
                            if name[0] not in best or new[:2] < best[name[0]][:2]:
                                best[name[0]] = new
            return best

        for (_, _, role, text), fault in zip(own, faults):
            after = {}
            for state, (cost, audit, done) in grow(best).items():
                moves = [(state, cost + 2, audit + "D", done)]
                if fault not in ("blank", "duplicate"):
                    late = 5 * (fault == "truncated")
                    if role[:1] and role[:1] in legal[state]:
                        moves.append((role[:1], cost + late, audit + "K", [*done, f"{role}:{text}"]))
                    moves += [(n[0], cost + 1 + late, audit + "R", [*done, f"{n}:{text}"]) for n in ("user", "assistant") if n[0] in legal[state]]
                for state_, *new in moves:
                    if state_ not in after or tuple(new[:2]) < after[state_][:2]:
                        after[state_] = tuple(new)
            best = after
        cost, audit, done = min((v for k, v in grow(best).items() if k in ("", "a")), key=lambda v: v[:2])
        illegal = sum(a + b not in ("su", "ua", "au") for a, b in itertools.pairwise(initials))
        gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
        out[c] = (gaps, *(faults.count(f) for f in ("blank", "duplicate", "truncated")), illegal, cost, audit, hashlib.sha256("\n".join(done).encode()).hexdigest())
    return out


def made(seed, n=150, longest=12):
    rng = random.Random(seed)
    rows = []
    for c in range(n):
        for t in sorted(rng.sample(range(40), rng.randint(1, longest))):
            role = rng.choice(["system", "user", "assistant", "user", "assistant", "tool", "", None])
            text = rng.choice(["Yes.", "No", "Why?  \n", " ", "", None, "a. b", "é!", f"word {rng.randint(0, 3)}."])
            rows.append((c, t, role, text))
    rows += [(None, t, rng.choice(["user", "assistant"]), f"x{t}.") for t in range(5)] + [(9000, None, "user", "Hi."), (9001, 1, "system", "s." * 40_000)]
    return rows


def report(df):
    return {r[0]: tuple(r[1:]) for r in df.collect()}


@pytest.mark.parametrize("seed,damaged", [(1, True), (2, False), (3, True)])
def test_repair_against_brute_force(spark, seed, damaged):
    rows = made(seed)
    df = spark.createDataFrame(rows, TURNS).repartition(5)
    plain = [(c, t, " " if role is None else role, " " if text is None else text) for c, t, role, text in rows]
    want = brute(damage(rows) if damaged else plain, {r[0] for r in rows})
    assert report(Repair(rows_of(df, damaged)).report()) == want
    # the same conversations as if each were too long for one task
    assert report(Repair(rows_of(df, damaged), long_rows=0, block_rows=3).report()) == want


def test_long_and_short_in_one_table(spark):
    rows = made(6, 20) + [(5000, t, ["user", "assistant", "assistant", "system"][t * 7 % 4], f"text {t % 300}.") for t in range(2500)]
    df = spark.createDataFrame(rows, TURNS).repartition(5)
    want = brute(damage(rows), {r[0] for r in rows})
    assert report(Repair(rows_of(df, True), long_rows=1000, block_rows=256).report()) == want


def test_repaired_rows_and_extra_columns(spark):
    rows = [(1, 0, "user", "Hi."), (1, 1, "user", "What?"), (1, 2, "assistant", "Well."), (2, 5, "assistant", "So."), (3, 0, "user", "")]
    df = spark.createDataFrame([(*r, 1, "x") for r in rows], TURNS + ", pos int, block string")
    for more in ({}, {"long_rows": 0, "block_rows": 2}):
        got = sorted(map(tuple, Repair(rows_of(df), **more).repaired().collect()))
        assert got == [(1, 0, "user", "What?"), (1, 1, "assistant", "Well.")]


def test_ties_of_turns_are_ordered(spark):
    rows = [(1, None, "user", "b."), (1, None, "assistant", "a."), (1, 3, "user", "c."), (1, 3, "assistant", "d.")]
    got = {tuple(report(Repair(rows_of(spark.createDataFrame(r, TURNS).repartition(4)), **more).report())[1]) for r in (rows, rows[::-1]) for more in ({}, {"long_rows": 0, "block_rows": 1})}
    assert len(got) == 1


def test_empty_table(spark):
    assert Repair(rows_of(spark.createDataFrame([], TURNS), True)).report().collect() == []


def test_repair_query(spark):
    rows = [tuple(r) for r in spark.read.parquet("/root/testdata/sf0.001/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    assert report(op13_conversation_repair(spark, "/root/testdata/sf0.001")) == brute(damage(rows), {r[0] for r in rows})

"""Versioned tables: crashes, two writers, readers of older versions."""

import threading

import pytest

from evenfield.plans.tables import KEPT, Tables
from evenfield.sources import files


def rows_of(df):
    return sorted(tuple(r) for r in df.collect())


def numbers(spark, *values):
    return spark.createDataFrame([(v,) for v in values], "v int")


def test_a_crash_leaves_the_table(spark, tmp_path):
    tables = Tables(spark, str(tmp_path))
    tables.commit("t", lambda _: numbers(spark, 1, 2))

    def fails(batches):
        yield from batches
        raise RuntimeError("lost")

    with pytest.raises(Exception, match="lost"):
        tables.commit("t", lambda before: before.mapInArrow(fails, "v int"))
    assert rows_of(tables.read("t")) == [(1,), (2,)] and tables.versions("t") == [1]
    assert len(tables.clean("t")) == 1 and tables.clean("t") == [] and rows_of(tables.read("t")) == [(1,), (2,)]


def test_a_writer_that_was_overtaken_starts_from_the_new_version(spark, tmp_path):
    tables, other, seen = Tables(spark, str(tmp_path)), Tables(spark, str(tmp_path)), []

    def slow(before):
        seen.append(None if before is None else rows_of(before))
        if len(seen) == 1:
            other.commit("t", lambda _: numbers(spark, 5))
        return numbers(spark, 7) if before is None else before.unionByName(numbers(spark, 7))

    assert rows_of(tables.commit("t", slow)) == [(5,), (7,)]
    assert seen == [None, [(5,)]] and tables.versions("t") == [1, 2]
    assert len([n for n in files.names(tables.path("t")) if n.startswith("data-")]) == 2


def test_writers_at_once_lose_no_rows(spark, tmp_path):
    tables = Tables(spark, str(tmp_path))
    tables.commit("t", lambda _: numbers(spark))
    work = [threading.Thread(target=lambda k=k: tables.commit("t", lambda before: before.unionByName(numbers(spark, k)))) for k in range(4)]
    for w in work:
        w.start()
    for w in work:
        w.join()
    assert rows_of(tables.read("t")) == [(0,), (1,), (2,), (3,)]


def test_old_versions_stay_for_their_readers(spark, tmp_path):
    tables = Tables(spark, str(tmp_path))
    first = tables.commit("t", lambda _: numbers(spark, 0))
    for v in range(1, KEPT):
        tables.commit("t", lambda _, v=v: numbers(spark, v))
    assert rows_of(first) == [(0,)] and rows_of(tables.read("t", 2)) == [(1,)]
    tables.commit("t", lambda _: numbers(spark, 9))
    assert len([n for n in files.names(tables.path("t")) if n.startswith("data-")]) == KEPT and rows_of(tables.read("t")) == [(9,)]


def test_a_file_is_created_once(tmp_path):
    path = f"{tmp_path}/deep/f"
    assert files.create_new(path, b"one") and not files.create_new(path, b"two") and files.read(path) == b"one"
    assert [p.name for p in (tmp_path / "deep").iterdir()] == ["f"]

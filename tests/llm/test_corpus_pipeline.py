"""The pipeline's stages against brute force, each on what the one before it kept, and its queries' contracts."""

import collections
import os
import re

import pytest

import corpus_pipeline
from evenfield.llm import queries as registered

from test_documents import brute_components, brute_quality, squeezed

DATA = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(DATA), reason="the test tables aren't here")


@pytest.fixture(scope="module")
def stages(spark, tmp_path_factory):
    folder = tmp_path_factory.mktemp("stages")
    docs = spark.read.parquet(f"{DATA}/documents.parquet")
    out = [docs]
    for k, (_, stage) in enumerate(corpus_pipeline.STAGES):
        stage(spark, out[-1], DATA).write.parquet(f"{folder}/{k}")
        out.append(spark.read.parquet(f"{folder}/{k}"))
    return out


def texts(df):
    return {r["doc_id"]: r["text"] for r in df.select("doc_id", "text").collect()}


def test_stages_keep_the_columns(stages):
    assert all(df.columns == stages[0].columns for df in stages[:5])
    assert [name for name, _ in corpus_pipeline.STAGES] == ["quality_rules", "exact_dedup", "ngram_jaccard_join", "source_mixing", "best_fit_packing"]


def test_quality_stage(stages, spark):
    before, after = texts(stages[0]), texts(stages[1])
    good = {r["doc_id"] for r in spark.read.parquet(f"{DATA}/labels.parquet").filter("quality = 1").collect()}
    passing = {k for k in before if not brute_quality(before[k])[-1]}
    assert set(after) <= passing and len(after) < len(before)
    assert len(good & passing - set(after)) <= 0.02 * len(good)


def test_dedup_stage(stages):
    before, after = texts(stages[1]), texts(stages[2])
    first = {}
    for k in sorted(before):
        first.setdefault(squeezed(before[k]), k)
    assert set(after) == set(first.values())


def test_near_stage(stages):
    before, after = texts(stages[2]), texts(stages[3])
    assert set(after) == {k for k, (_, c) in brute_components(before.items()).items() if k == c}


def test_mixing_stage_keeps_all(stages):
    assert stages[4].exceptAll(stages[3]).count() == 0 and stages[4].count() == stages[3].count()


def test_packing_stage(stages):
    packed = stages[5].toPandas().sort_values(["sequence_id", "offset"])
    assert set(packed["doc_id"]) == set(texts(stages[4]))
    assert ((packed.groupby("sequence_id")["length"].cumsum() - packed["length"]) == packed["offset"]).all()
    assert packed["sequence_id"].nunique() <= -(-packed["length"].sum() // 2048) + 1


def test_packing_follows_the_mixed_order(spark, stages):
    """Sequences open in the order of the schedule, pieces of a length lie in it, and documents that weren't mixed are packed otherwise."""
    from evenfield.llm.mixing import schedule

    slots = {r["doc_id"]: (r["slot"], r["start_in_block"]) for r in schedule(stages[3]).collect()}
    packed = stages[5].toPandas().sort_values(["sequence_id", "offset"])
    assert packed["sequence_id"].tolist()[0] == 0 and packed["sequence_id"].diff().max() <= 1
    own = packed.assign(slot=[slots[d] for d in packed["doc_id"]])
    opens = own[own["offset"] == 0]["slot"].tolist()
    assert len(set(opens)) > 10 and opens == sorted(opens)
    for _, group in own[own["offset"] > 0].groupby("length"):
        assert group["slot"].tolist() == sorted(group["slot"])
    other = dict(corpus_pipeline.STAGES)["best_fit_packing"](spark, stages[3], DATA)
    columns = ["doc_id", "piece", "sequence_id"]
    assert other.select(columns).exceptAll(stages[5].select(columns)).count() > 0
    assert other.select("sequence_id").distinct().count() == packed["sequence_id"].nunique()


def test_packing_keeps_the_order_of_rows_without_files(spark):
    from evenfield.llm.packing import pack

    rows = [(k, "word " * (30 + k % 7 * 90)) for k in range(120, 0, -1)]
    found = pack(spark.createDataFrame(rows, "doc_id long, text string"), in_order=True).toPandas().sort_values(["sequence_id", "offset"])
    assert len(found) == 120 and ((found.groupby("sequence_id")["length"].cumsum() - found["length"]) == found["offset"]).all()
    opens = found[found["offset"] == 0]["doc_id"].tolist()
    assert opens == sorted(opens, reverse=True)
    assert pack(spark.createDataFrame([], "doc_id long, text string"), in_order=True).count() == 0


def test_run_gives_what_the_stages_give(spark, stages):
    found = corpus_pipeline.run(spark, DATA)
    columns = ["doc_id", "piece", "start", "length", "ids_crc32"]
    assert found.select(columns).exceptAll(stages[5].select(columns)).count() == 0 and found.count() == stages[5].count()


CONTRACT = {
    3: {"doc_id": "bigint", "n_assign": "bigint", "n_access": "bigint", "n_hex": "bigint", "base_sha256": "string", "spans": "string"},
    4: {"page_id": "bigint", "url": "string", "text": "string", "n_chars": "bigint"},
    5: {"doc_id": "bigint", "piece": "int", "start": "bigint", "length": "bigint", "ids_crc32": "bigint", "sequence_id": "bigint", "offset": "bigint"},
    6: {"doc_id": "bigint", "n_words": "bigint", "word_chars": "bigint", "n_symbols": "bigint", "n_dup_lines": "bigint", "n_repeat_words": "bigint", "base_failed": "boolean", "kept": "boolean"},
    7: {"doc_id": "bigint", "held_out": "boolean", "n_tokens": "bigint", "n_known": "bigint", "train_tokens": "bigint", "base_score": "double", "score": "double"},
    8: {"doc_id": "bigint", "n_shingles": "bigint", "component_id": "bigint"},
    9: {"conv_id": "bigint", "n_turns": "bigint", "turns_sha256": "string", "loss_chars": "bigint", "loss_sha256": "string", "formatted_chars": "bigint"},
    10: {"doc_id": "bigint", "keep_id": "bigint", "group_size": "bigint", "kept": "boolean", "text_sha256": "string"},
}


@pytest.mark.parametrize("number", range(1, 11))
def test_contracts(spark, number):
    (name,) = [n for n in registered.queries() if re.match(rf"op{number}_", n)]
    found = registered.queries()[name](spark, DATA)
    assert dict(found.dtypes).items() >= CONTRACT.get(number, {}).items()
    table = {4: "pages", 9: "conversations"}.get(number, "documents")
    source = spark.read.parquet(f"{DATA}/{table}.parquet")
    if number == 9:
        assert found.count() == source.select("conv_id").distinct().count() + 1
    elif number == 5:
        assert found.select("doc_id").distinct().count() == source.count()
    elif number != 2:
        assert found.count() == source.count()


def test_exact_dedup_equals_its_sql(spark):
    import duckdb

    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{DATA}/documents.parquet'")
    sql = con.execute(registered.oracle_sql()["op10_exact_dedup"]).fetchall()
    found = registered.queries()["op10_exact_dedup"](spark, DATA).select("doc_id", "keep_id", "group_size", "kept", "text_sha256").collect()
    assert collections.Counter(map(tuple, found)) == collections.Counter(sql)

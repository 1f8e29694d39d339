"""Stages of the pipeline on nulls, empty and very long texts, ties, repeated rows, empty tables and clashing names."""

import types

import pytest

import corpus_pipeline
from quillmark.llm import common
from tests.llm.test_llm import ODD, documents

ITEM = " ".join(f"benchword{i}" for i in range(13))
#: A document that holds the whole item in 300 words, and one of 10 MB.
HOLDS = " ".join([*(f"before{i}" for i in range(150)), *ITEM.split(), *(f"after{i}" for i in range(137))])
HUGE = " ".join(f"w{i % 99_991}" for i in range(1_500_000))
ROWS = [*ODD, (7, HOLDS, "en", "a", len(HOLDS)), (8, HUGE, "en", "a", len(HUGE))]


@pytest.fixture
def folder(spark, tmp_path):
    items = [(1, "one two three"), (2, ITEM), (3, None), (None, ""), (2, ITEM)]
    spark.createDataFrame(items, "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    return str(tmp_path)


def ids(df):
    return sorted((r["doc_id"] for r in df.select("doc_id").collect()), key=lambda i: (i is None, i))


def test_quality_stage_drops_texts_without_words_and_keeps_repeated_rows_alike(spark, folder):
    given = documents(spark, ROWS, clashing=True)
    out = corpus_pipeline.keep_good(spark, given, folder)
    assert out.columns == given.columns
    kept = ids(out)
    assert not {2, 3, 5} & set(kept) and kept.count(1) in (0, 2)


def test_near_copy_stage_keeps_one_row_of_a_group_and_all_rows_without_words(spark, folder):
    given = documents(spark, ROWS, clashing=True)
    out = corpus_pipeline.keep_one_of_each(spark, given, folder)
    assert out.columns == given.columns and ids(out) == [1, 2, 3, 4, 5, 7, 8, None]


def test_contamination_stage_drops_covered_documents_and_cuts_spans(spark, folder):
    given = documents(spark, ROWS, clashing=True)
    out = corpus_pipeline.keep_clean(spark, given, folder)
    assert out.columns == given.columns and ids(out) == [2, 3, 4, 5, 7, 8, None]
    rows = {r["doc_id"]: r for r in out.where("doc_id IN (2, 3, 7, 8)").collect()}
    assert rows[2]["text"] is None and rows[2]["n_chars"] is None and rows[3]["text"] == "" and rows[8]["text"] == HUGE
    assert "benchword" not in rows[7]["text"] and rows[7]["text"].split() == [w for w in HOLDS.split() if not w.startswith("bench")]
    assert rows[7]["n_chars"] == len(rows[7]["text"])


def test_mix_stage_keeps_texts_without_words_once(spark, folder):
    given = documents(spark, ROWS, clashing=True)
    out = corpus_pipeline.mix(spark, given, folder)
    mixed = ids(out)
    assert out.columns == given.columns and [mixed.count(i) for i in (2, 3, 5)] == [1, 1, 1]
    assert max(mixed.count(i) for i in (4, 6, 7, 8, None)) <= 3 and mixed.count(1) <= 6
    assert {tuple(r) for r in out.where("doc_id < 8").collect()} <= {tuple(r) for r in given.where("doc_id < 8").collect()}


def test_shard_stage_numbers_all_rows(spark, folder):
    given = documents(spark, ROWS, clashing=True)
    out = corpus_pipeline.shard(spark, given, folder)
    rows = out.select("doc_id", "shard", "slot", "in_0").collect()
    assert len(rows) == len(ROWS) and set(given.columns) <= set(out.columns) and {r["in_0"] for r in rows} == {"own in_0"}
    assert len({r["shard"] for r in rows if r["doc_id"] == 1}) == 1
    for shard in {r["shard"] for r in rows}:
        slots = sorted(r["slot"] for r in rows if r["shard"] == shard)
        assert slots == list(range(len(slots)))


@pytest.mark.parametrize("name, stage", corpus_pipeline.STAGES)
def test_stages_take_empty_tables(spark, folder, name, stage):
    given = documents(spark, [], clashing=True)
    out = stage(spark, given, folder)
    assert set(given.columns) <= set(out.columns) and out.count() == 0


def test_an_empty_benchmark_leaves_all_documents(spark, tmp_path):
    spark.createDataFrame([], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    given = documents(spark, ODD)
    assert ids(corpus_pipeline.keep_clean(spark, given, str(tmp_path))) == ids(given)


def test_a_cluster_without_shared_folder_is_refused():
    context = types.SimpleNamespace(master="spark://host:7077", getCheckpointDir=lambda: None)
    with pytest.raises(ValueError, match="checkpoint"):
        common.shared_dir(types.SimpleNamespace(conf={}, sparkContext=context))

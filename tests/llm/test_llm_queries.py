"""Registered queries over whole small tables: against SQL, brute force, or labels."""

import zlib

import pandas as pd
import pytest

import corpus_pipeline
from quillmark.llm import contamination, mixing, queries, secrets, similarity
from tests.llm.test_llm import python_secrets
from tests.oracle import assert_same

SMALL, MIDDLE = "/root/testdata/sf0.001", "/root/testdata/sf0.01"


def read(name, folder=SMALL):
    return pd.read_parquet(f"{folder}/{name}.parquet")


@pytest.mark.parametrize("name", sorted(queries.oracle_sql()))
def test_query_equals_its_sql(spark, name):
    assert_same(spark, queries.queries()[name], queries.oracle_sql()[name])


def test_op1_has_the_contract_columns(spark):
    out = queries.op1_rendezvous_shards(spark, SMALL).toPandas()
    assert list(out.columns[:7]) == ["doc_id", "size", "text_crc32", "law", "shard", "slot", "grown_shard"] and len(out) == len(read("documents"))
    assert ((out.grown_shard == out["shard"]) | (out.grown_shard == 24)).all() and set(out["shard"]) <= set(range(24))
    assert all(sorted(g.slot) == list(range(len(g))) for _, g in out.groupby("shard"))


def test_op4_equals_brute_force(spark):
    docs, items = read("documents"), read("benchmark")
    want = contamination.brute_force(list(docs.text), list(zip(items.item_id.astype(str), items.text, strict=True)))
    got = queries.op4_decontaminate(spark, SMALL).toPandas().set_index("doc_id")
    for i, (n, hit, named) in zip(docs.doc_id, want, strict=True):
        assert tuple(got.loc[i]) == (n, hit, len(named), contamination.sha256_of(named), hit > 0 and 20 * hit >= n)


def test_op7_equals_brute_force(spark):
    docs = read("documents")
    got = queries.op7_jaccard_join(spark, SMALL).toPandas().set_index("doc_id")
    assert {i: tuple(r) for i, r in got.iterrows()} == similarity.brute_force(dict(zip(docs.doc_id, docs.text, strict=True)), 4, 85)


def test_op8_equals_a_plain_scan(spark):
    docs = dict(zip(read("documents", MIDDLE).doc_id, read("documents", MIDDLE).text, strict=True))
    for row in queries.op8_secret_scan(spark, MIDDLE).collect():
        spans = [x for x in row["spans"].split(",") if x.split(":")[0] in [r.kind for r in secrets.BASE_RULES]]
        assert spans == [f"{k}:{a}:{b}" for a, _, b, k in python_secrets(docs[row["doc_id"]])]


def test_op3_and_op9_on_held_out_rows(spark):
    docs = read("documents", MIDDLE).set_index("doc_id")
    got = queries.op3_language_spans(spark, MIDDLE).toPandas().set_index("doc_id").join(docs)
    assert (got.held_out == [zlib.crc32(str(i).encode()) % 4 == 2 for i in got.index]).all()
    held = got[got.held_out]
    assert (held.lang == held.lang_pred).mean() > 0.98
    out = queries.op9_subword_toxicity(spark, MIDDLE).toPandas().set_index("doc_id").join(read("labels", MIDDLE).set_index("doc_id"), how="inner")
    held = out[out.held_out]
    assert (held.predicted == held.toxic).mean() > 0.85 and out.score.between(0, 1).all()


def test_op6_keeps_the_article(spark):
    out = queries.op6_page_text(spark, SMALL).toPandas().set_index("page_id")
    for page in read("pages").itertuples():
        text = out.loc[page.page_id].text
        assert "&copy;" not in text and "track(" not in text and out.loc[page.page_id].n_chars == len(text) > 0


def test_op10_follows_labels_it_never_saw(spark):
    out = queries.op10_weak_label_quality(spark, MIDDLE).toPandas().set_index("doc_id").join(read("labels", MIDDLE).set_index("doc_id"), how="inner")
    assert (out.kept == (out.quality == 1)).mean() > 0.95 and out[out.quality == 1].kept.mean() > 0.99


def test_pipeline_stages_against_brute_force(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    rows = {"documents": docs}
    for name, stage in corpus_pipeline.STAGES:
        rows[name] = docs = stage(spark, docs, SMALL).persist()
    frames = {k: v.toPandas() for k, v in rows.items()}
    good, apart, clean, mixed, sharded = (frames[n] for n, _ in corpus_pipeline.STAGES)
    labels = read("labels").set_index("doc_id").quality
    judged = frames["documents"][frames["documents"].doc_id.isin(labels.index)]
    assert sum(labels[i] != (i in set(good.doc_id)) for i in judged.doc_id) <= 0.06 * len(judged)
    classes = similarity.brute_force(dict(zip(good.doc_id, good.text, strict=True)), 5, 80)
    assert set(apart.doc_id) == {i for i, (_, c) in classes.items() if i == c}
    items = read("benchmark")
    hits = contamination.brute_force(list(apart.text), list(zip(items.item_id.astype(str), items.text, strict=True)))
    assert set(clean.doc_id) == {i for i, (n, h, _) in zip(apart.doc_id, hits, strict=True) if not (h and 20 * h >= n)}
    assert list(mixed.columns) == list(frames["documents"].columns) and set(map(tuple, mixed.itertuples(index=False))) <= set(map(tuple, clean.itertuples(index=False)))
    targets = {r["source"]: r["target"] for r in mixing.fair_queue(rows["contamination"]).collect()}
    words = mixed.text.str.split().str.len().groupby(mixed.source).sum()
    assert all(abs(words.get(s, 0) - t) <= clean[clean.source == s].text.str.split().str.len().max() for s, t in targets.items())
    assert len(sharded) == len(mixed) and sharded["shard"].between(0, 23).all()
    assert all(sorted(g.slot) == list(range(len(g))) for _, g in sharded.groupby("shard"))


def test_pipeline_runs(spark):
    assert corpus_pipeline.run(spark, SMALL).count() > 0

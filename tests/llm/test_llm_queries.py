from __future__ import annotations

import pytest

import corpus_pipeline
from cases import documents, empty, prose
from martloom.llm.queries import QUERIES
from oracle import differences

SF_DIR = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", [n for n, q in QUERIES.items() if q.sql])
def test_query_agrees_with_sql(spark, name):
    assert differences(spark, QUERIES[name], SF_DIR) == []


def test_one_query_for_each_operator():
    numbers = sorted(int(n[2:].split("_")[0]) for n in QUERIES if n.startswith("op"))
    assert numbers == list(range(1, 14))


def labelled(spark, folder, docs):
    docs.write.parquet(f"{folder}/documents.parquet")
    labels = [(i, 1, 0) for i in (0, 1, 2, 3, 11, 12, 13)] + [(i, 0, 0) for i in (17, 18, 19, 20)]
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{folder}/labels.parquet")
    return str(folder)


def test_pipeline_stages_take_effect(spark, tmp_path):
    folder = labelled(spark, tmp_path, documents(spark))
    docs, seen = spark.read.parquet(f"{folder}/documents.parquet"), {}
    names = docs.columns
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, folder)
        if name != "packing":
            assert out.columns == names
        out.write.parquet(f"{tmp_path}/out-{name}")
        docs = spark.read.parquet(f"{tmp_path}/out-{name}")
        seen[name] = docs.collect()
    ids = {name: {r["doc_id"] for r in rows} for name, rows in seen.items()}
    assert not ids["quality_rules"] & {4, 5, 6, 7, 17, 18, 19, 20}
    assert {0, 3, 11, 12, 13} <= ids["quality_classifier"]
    assert 0 in ids["near_copies"] and not ids["near_copies"] & {1, 2}
    passage = prose(60, 2)
    assert sum(passage in r["text"] for r in seen["near_copies"]) > 1
    assert sum(passage in r["text"] for r in seen["repeated_passages"]) == 1
    assert ids["packing"] == ids["repeated_passages"]


def test_pipeline_of_no_documents(spark, tmp_path):
    folder = labelled(spark, tmp_path, empty(spark))
    assert corpus_pipeline.run(spark, folder).collect() == []


def test_pipeline_drops_near_copies_of_five_words_and_four_fifths(spark):
    base, other = prose(200, 81), prose(150, 82).split()
    for at in (30, 75, 120):
        other[at] = f"changed{at}"
    apart = prose(150, 83).split()
    for at in (20, 50, 80, 110):
        apart[at] = f"changed{at}"
    texts = [base, base + " " + prose(30, 84), prose(150, 82), " ".join(other), prose(150, 83), " ".join(apart)]
    docs = spark.createDataFrame([(i, t, "en", "s", len(t)) for i, t in enumerate(texts)], documents(spark).schema)
    kept = dict(corpus_pipeline.STAGES)["near_copies"](spark, docs, "")
    assert {r["doc_id"] for r in kept.collect()} == {0, 2, 4, 5}


def test_sentencepiece_query_verifies_every_document(spark):
    assert all(r["checked"] for r in QUERIES["op9_sentencepiece"].build(spark, SF_DIR).select("checked").collect())

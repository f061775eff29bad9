"""The pipeline against its stages done by brute force, one after another."""

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from siltstone.llm import decontaminate
from siltstone.session import materialize
from tests.llm.test_decontaminate import brute as leaks
from tests.llm.test_minmax import brute as duplicates
from tests.llm.test_quality import brute as counts

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def kept(spark):
    """Documents after each stage but the last, and the result."""
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet").withColumn("_text", F.lit("clash"))
    out = [docs]
    for _, stage in corpus_pipeline.STAGES:
        docs = materialize(stage(spark, docs, FOLDER), "test-stage")
        out.append(docs)
    return out


def test_stages_are_those_asked_for(kept):
    assert [n for n, _ in corpus_pipeline.STAGES] == ["toxicity", "quality rules", "near-dedup", "decontamination", "packing"]
    for before, after in zip(kept[:4], kept[1:5], strict=True):
        assert after.columns == before.columns
        assert {r["doc_id"] for r in after.collect()} <= {r["doc_id"] for r in before.collect()}


def test_near_duplicates_and_contamination_equal_brute_force(spark, kept):
    rows = [(r["doc_id"], r["text"]) for r in kept[2].collect()]
    assert {r["doc_id"] for r in kept[3].collect()} == {d for d, _, _, keep in duplicates(rows) if keep}
    items = [(r["item_id"], r["text"]) for r in spark.read.parquet(f"{FOLDER}/benchmark.parquet").collect()]
    rows = [(r["doc_id"], r["text"]) for r in kept[3].collect()]
    assert {r["doc_id"] for r in kept[4].collect()} == {d for d, _, _, _, bad in leaks(rows, items, decontaminate.WINDOW) if not bad}


def test_quality_drops_all_that_fail_the_base_rule(kept):
    assert not [r["doc_id"] for r in kept[2].collect() if counts(r["text"])[-1]]


def test_packing_holds_every_document(kept):
    pieces = kept[5].collect()
    assert {r["doc_id"] for r in pieces} == {r["doc_id"] for r in kept[4].collect()}
    size = {}
    for r in pieces:
        size[r["sequence_id"]] = size.get(r["sequence_id"], 0) + r["length"]
    assert max(size.values()) <= 2048


def test_run_gives_the_same_documents(spark, kept):
    assert {(r["doc_id"], r["piece"], r["ids_crc32"]) for r in corpus_pipeline.run(spark, FOLDER).collect()} == {
        (r["doc_id"], r["piece"], r["ids_crc32"]) for r in kept[5].collect()
    }

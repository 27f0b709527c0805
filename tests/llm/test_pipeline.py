"""The pipeline's stages on planted cases, and its wiring."""
import corpus_pipeline as pipeline
import pytest
from pyspark.sql import functions as F

from verilens.llm import queries

SMALL = "/root/testdata/sf0.001"


def test_stages_in_order():
    assert [n for n, _ in pipeline.STAGES] == ["toxicity", "simhash_near_dedup", "decontamination", "pii", "bpe"]


@pytest.mark.parametrize("stage", [f for _, f in pipeline.STAGES[:-1]])
def test_stages_keep_columns_and_survive_odd_and_empty_tables(spark, odd, stage):
    for rows in (odd, odd.limit(0)):
        got = stage(spark, rows, SMALL)
        assert got.columns == list(pipeline.DOCUMENT)
        assert got.count() <= rows.count()


def test_one_document_of_each_group(spark, docs):
    same = "some words that are all the same in here"
    rows = docs([same, same, same, "others that stand for themselves only", None, None], ids=[5, 3, 3, 8, None, None])
    got = pipeline.one_of_each_group(spark, rows, SMALL).collect()
    assert sorted((str(r.doc_id), r.text) for r in got if r.text) == [("3", same), ("8", "others that stand for themselves only")]
    assert sum(r.text is None for r in got) == 1


def test_benchmark_items_go_and_private_data_changes(spark, docs):
    item = spark.read.parquet(f"{SMALL}/benchmark.parquet").first().text
    rows = docs([f"before it {item} and after", "clean text, call +1 (277) 555-9423 now"])
    clean = pipeline.no_benchmark_items(spark, rows, SMALL)
    assert [r.doc_id for r in clean.collect()] == [1]
    new = pipeline.private_data_replaced(spark, clean, SMALL).first()
    assert new.text.startswith("clean text, call +1 (") and "555-9423" not in new.text and len(new.text) == new.n_chars


def test_run_is_its_stages(spark):
    got = pipeline.run(spark, SMALL)
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    kept = pipeline.not_toxic(spark, docs, SMALL)
    kept = pipeline.no_benchmark_items(spark, pipeline.one_of_each_group(spark, kept, SMALL), SMALL)
    assert sorted(r.doc_id for r in got.collect()) == sorted(r.doc_id for r in kept.collect())
    toxic = spark.read.parquet(f"{SMALL}/labels.parquet").where(F.col("toxic") == 1)
    assert got.join(toxic, "doc_id").count() < 0.3 * docs.join(toxic, "doc_id").count()


def test_batches_are_bounded(spark):
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", 10_000)
    queries.QUERIES["op2_pii"](spark, SMALL)
    assert int(spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")) == queries.BATCH_DOCS

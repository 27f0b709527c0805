"""A corpus pipeline over ``documents``: each stage reads all that the one before kept.

Each function takes (spark, docs, sf_dir) and returns a DataFrame, which the
runner writes as Parquet and rereads as the next one's docs.  All but the last
return the columns of documents.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import Window

from verilens.llm import pseudonyms, simhash, templates, toxicity
from verilens.llm.queries import bounded, bpe_digests, table
from verilens.session import stored

DOCUMENT = ("doc_id", "text", "lang", "source", "n_chars")


def not_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the factorization machine doesn't predict as toxic; null text stays."""
    scored = toxicity.predictions(docs, table(spark, sf_dir, "labels"), keep=tuple(F.col(c).alias(f"doc_{k}") for k, c in enumerate(DOCUMENT)))
    return scored.where(F.col("predicted") == 0).select(*[F.col(f"doc_{k}").alias(c) for k, c in enumerate(DOCUMENT)])


def one_of_each_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each component of near fingerprints: the one with the smallest doc_id
    (null last), ties by hash; of repeated rows one stays."""
    keys = templates.document_key(F.col("doc_id"), F.col("text"))
    found = simhash.near_duplicates(docs, keep=tuple(keys))
    first = F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "k1", "k2"))
    kept = stored(found.groupBy("component").agg(first.alias("x")).select("x.k1", "x.k2"), "kept")
    rows = docs.select(*DOCUMENT, *keys).join(kept, ["k1", "k2"])
    again = Window.partitionBy("k1", "k2").orderBy("k1")  # the join has already dealt and sorted by these
    return rows.withColumn("copy", F.row_number().over(again)).where(F.col("copy") == 1).select(*DOCUMENT)


def no_benchmark_items(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a benchmark item."""
    return templates.clean_rows(docs.select(*DOCUMENT), table(spark, sf_dir, "benchmark"))


def private_data_replaced(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with pseudonyms for personal data; their formats keep n_chars as it was."""
    return pseudonyms.replaced_rows(docs.select(*DOCUMENT))


def token_ids(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, n_tokens, ids_sha256 and decoded_sha256 of each document."""
    return bpe_digests(docs)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("toxicity", bounded(not_toxic)), ("simhash_near_dedup", bounded(one_of_each_group)), ("decontamination", bounded(no_benchmark_items)),
    ("pii", bounded(private_data_replaced)), ("bpe", bounded(token_ids))]

#: SQL can't express a factorization machine, Feistel networks or BPE; see tests/llm.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), name)
    return docs

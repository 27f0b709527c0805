"""The registered queries of this package: each applies one operator, with its
production parameters, to its whole table."""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from verilens.llm import alignment, bpe, dac, embeddings, langid, pseudonyms, quality, simhash, substrings, templates, tokencount, toxicity, turns
from verilens.session import stored

BYTE_BPE = public_tokenizers.path("byte_bpe_50k.json")
BYTE_BPE_RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")
WORD_BPE = public_tokenizers.path("word_bpe_49k.json")
PIECES = public_tokenizers.path("piece_bpe_32k.model")


#: Documents and bytes of one Arrow batch at most: what a task holds in Python and in its buffers follows from it.
BATCH_DOCS, BATCH_BYTES = 1_000, 4 << 20


def bounded(work: Callable[..., DataFrame]) -> Callable[..., DataFrame]:
    """``work(spark, ...)`` in a session whose Arrow batches hold at most ``BATCH_DOCS`` rows or ``BATCH_BYTES`` bytes.

    A DataFrame is planned when it is used, so the two limits stay set in the session;
    smaller ones that the session has already are left as they are."""

    @wraps(work)
    def run(spark: SparkSession, *args) -> DataFrame:
        rows, size = "spark.sql.execution.arrow.maxRecordsPerBatch", "spark.sql.execution.arrow.maxBytesPerBatch"
        if not 0 < int(spark.conf.get(rows)) <= BATCH_DOCS:
            spark.conf.set(rows, BATCH_DOCS)
        most = spark.conf.get(size)
        if not (most.rstrip("b").isdigit() and 0 < int(most.rstrip("b")) <= BATCH_BYTES):
            spark.conf.set(size, BATCH_BYTES)
        return work(spark, *args)

    return run


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def op1_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row for each document and benchmark item that it contains."""
    return templates.contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")).drop("k1", "k2")


def op2_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with pseudonyms in its text, and their number."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return pseudonyms.replaced_rows(docs, count_col="n_replaced")


def op3_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.predictions(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op4_token_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = dac.new_folder(spark)
    dac.write(table(spark, sf_dir, "documents"), folder, WORD_BPE)
    return dac.read(spark, folder, F.crc32("ids").alias("ids_crc32"))


def op5_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    return langid.predictions(table(spark, sf_dir, "documents"))


def op6_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.predictions(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op7_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.near_duplicates(table(spark, sf_dir, "documents"))
    return found.select("doc_id", simhash.hex_digits(F.col("fp")).alias("fingerprint"), "component_id")


def op8_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token counts of every document before and after its long numbers are blanked: trees are kept with their texts, reread and edited."""
    kept = table(spark, sf_dir, "documents").select("doc_id", "text", tokencount.segment_trees(F.col("text"), BYTE_BPE_RANKS).alias("x"))
    kept = stored(kept.select("doc_id", "text", "x.n_tokens", "x.tree"), "trees")
    found = kept.withColumn("edits", tokencount.long_numbers(F.col("text")))
    found = found.select("doc_id", "n_tokens", "edits", tokencount.recounted(F.col("text"), F.col("tree"), F.col("edits"), BYTE_BPE_RANKS).alias("x"))
    return found.select("doc_id", "n_tokens", F.coalesce(F.size("edits"), F.lit(0)).alias("n_edits"), "x.n_tokens_after", "x.bytes_again")


def op9_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe_digests(table(spark, sf_dir, "documents"))


def bpe_digests(docs: DataFrame) -> DataFrame:
    found = docs.select("doc_id", bpe.round_trip(F.col("text"), BYTE_BPE).alias("x"))
    return found.select("doc_id", (F.length("x.ids") / 4).cast("long").alias("n_tokens"), F.sha2("x.ids", 256).alias("ids_sha256"),
                        F.sha2(F.col("x.decoded").cast("binary"), 256).alias("decoded_sha256"))


def op10_embeddings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embeddings.linked(table(spark, sf_dir, "embeddings"))


def op11_conversations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Faults and cheapest repair of every conversation after the planted damage."""
    return turns.repaired_after_damage(table(spark, sf_dir, "conversations"))


def op12_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return alignment.aligned(table(spark, sf_dir, "documents"), BYTE_BPE, PIECES)


def op13_substrings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substrings.without_repeats(table(spark, sf_dir, "documents"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: bounded(f) for f in (op1_decontamination, op2_pii, op3_toxicity, op4_token_ids, op5_language, op6_quality, op7_simhash,
                            op8_token_counts, op9_bpe, op10_embeddings, op11_conversations, op12_alignment, op13_substrings)}

#: Exact where the index found every link, which it does on the small table that this runs on.
ORACLE: dict[str, str] = {"op10_embeddings": """
WITH RECURSIVE valid AS (
  SELECT vec_id, label, embedding::DOUBLE[] AS v FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0 AND list_dot_product(embedding::DOUBLE[], embedding::DOUBLE[]) > 0),
links AS (
  SELECT a.vec_id AS x, b.vec_id AS y FROM valid a JOIN valid b ON a.label = b.label AND a.vec_id <> b.vec_id AND len(a.v) = len(b.v)
  WHERE list_cosine_similarity(a.v, b.v) >= 0.93),
reach AS (
  SELECT vec_id AS x, vec_id AS y FROM embeddings
  UNION SELECT reach.x, links.y FROM reach JOIN links ON reach.y = links.x),
least AS (SELECT x, min(y) AS component_id FROM reach GROUP BY x),
degree AS (SELECT x, count(*) AS n FROM links GROUP BY x)
SELECT e.vec_id, coalesce(d.n, 0)::BIGINT AS n_links, l.component_id, e.vec_id = l.component_id AS kept
FROM embeddings e JOIN least l ON l.x = e.vec_id LEFT JOIN degree d ON d.x = e.vec_id
"""}

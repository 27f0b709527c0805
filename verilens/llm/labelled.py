"""The bounded sample of labelled documents that a classifier is fitted on."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Labelled documents that a fit uses at most (those with the smallest hash of their id).
SAMPLE_DOCS = 12_000


def in_fold(id_col: Column, folds: int, fold: int) -> Column:
    """Whether crc32 of the id as text falls in a fold; false for a null id."""
    return F.coalesce(F.crc32(id_col.cast("string")) % folds == fold, F.lit(False))


def labelled_sample(docs: DataFrame, labels: DataFrame, label: str, folds: int = 5, held_fold: int = 0,
                    most: int = SAMPLE_DOCS, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, text, label 0/1) of at most ``most`` documents outside the held-out fold.

    Rows without an id or a label are left out.  A document with several label
    rows counts as 1 if any says so; of several rows with one id the smallest
    text is taken.  The ids are bounded, so they are broadcast."""
    ids = (labels.select(F.col(id_col).alias("id"), F.col(label).cast("int").alias("label"))
           .where(F.col("id").isNotNull() & F.col("label").isNotNull() & ~in_fold(F.col("id"), folds, held_fold))
           .groupBy("id").agg((F.max("label") >= 1).cast("int").alias("label"))
           .orderBy(F.xxhash64("id"), "id").limit(most))
    texts = docs.select(F.col(id_col).alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    return texts.join(F.broadcast(ids), "id").groupBy("id").agg(F.min("text").alias("text"), F.min("label").alias("label"))

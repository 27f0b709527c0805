import datetime

import pytest
from pyspark.sql import functions as F

DOCS = "doc_id long, text string, lang string, source string, n_chars long"
ODD_TEXTS = [None, "", "   \n\t", "x", "<|endoftext|> <|", "a　 b\x0b c", "ünïcödé 漢字 🙂 don't 12 ½", "\x00", "word " * 30_000, "y" * 200_000]


@pytest.fixture
def docs(spark):
    """Builds a documents table from texts; ids count up from 0."""
    def build(texts, ids=None, langs=None):
        ids = list(range(len(texts))) if ids is None else ids
        langs = langs or ["en"] * len(texts)
        return spark.createDataFrame([(i, t, g, "s", None if t is None else len(t)) for i, t, g in zip(ids, texts, langs, strict=True)], DOCS)
    return build


@pytest.fixture
def odd(docs):
    """Nulls in any column, empty, odd and long texts, repeated rows, extra columns with clashing names."""
    rows = docs(ODD_TEXTS + ODD_TEXTS[:7], ids=[*range(len(ODD_TEXTS)), None, *range(6)], langs=[None, "en", "de"] + ["fr"] * 14)
    extra = {c: F.lit(datetime.date(2024, 1, 1)) for c in ("id", "score", "fp", "k1", "pos", "x", "label", "component", "pseudonyms", "ids", "shard", "TEXT_2")}
    return rows.withColumns(extra)


@pytest.fixture
def labels(spark):
    return lambda rows: spark.createDataFrame(rows, "doc_id long, quality int, toxic int")

"""Quality by Bradley-Terry pairwise ranking (operator 6).

A document's score is linear in features of its whole text; the probability
that one document is preferred to another is the logistic function of the
difference of their scores.  Preference pairs (label 1 over label 0) come from
the sample; the logistic loss on feature differences is fitted by Newton steps.
A quantile of the sample's scores, at the share of label 0, is the threshold:
scores are mapped to 0..1 so that this quantile lands on ``THRESHOLD``.

Fit: on a bounded sample of labelled documents (``labelled.SAMPLE_DOCS``, a
parameter) and at most ``MOST_PAIRS`` seeded pairs, on the driver.  Scoring
reads whole texts of all documents on the executors.

Defined results: null and empty texts have the features of no words; with one
class only every score is the smoothed share of label 1; repeated rows score
alike; a null doc_id isn't held out; other columns are ignored; an empty table
gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import arrow_udf

from verilens.llm.labelled import SAMPLE_DOCS, in_fold, labelled_sample
from verilens.llm.textbatch import ALPHA, DIGIT, SPACE, Runs, as_strings, by_slice, flat, segment_sum, slices

THRESHOLD = 0.3
MOST_PAIRS = 60_000
L2 = 1e-3

_UPPER, _SENTENCE, _LINE = np.zeros(256, bool), np.zeros(256, bool), np.zeros(256, bool)
_UPPER[0x41:0x5B] = True
_SENTENCE[[*b".,;:?'\"()-"]] = True
_LINE[0x0A] = True
_SYMBOL = (np.arange(256) < 0x80) & ~(ALPHA | DIGIT | SPACE | _SENTENCE) & (np.arange(256) > 0x20)
FEATURES = ("log_words", "word_bytes", "upper", "digits", "sentence_marks", "symbols", "beyond_ascii", "lines_by_word",
            "distinct_words", "repeats", "repeats_two_back", "symbol_words", "long_words", "distinct_lines")


def features(texts: pa.Array) -> np.ndarray:
    """One row of ``FEATURES`` for each text."""
    raw, off = flat(as_strings(texts))
    size = np.maximum(np.diff(off), 1)
    share = lambda table: segment_sum(table[raw].astype(np.int64), off) / size
    runs = Runs(raw, off, ~SPACE[raw])
    n = np.diff(runs.off)
    one = np.maximum(n, 1)
    doc = runs.doc
    bytes_each = runs.ends - runs.starts
    width = np.int64(len(runs.distinct) + 1)

    def same(back: int) -> np.ndarray:
        hit = np.zeros(len(doc), np.int64)
        hit[back:] = (runs.codes[back:] == runs.codes[:-back]) & (doc[back:] == doc[:-back])
        return segment_sum(hit, runs.off) / one

    distinct = np.bincount(np.unique(doc * width + runs.codes) // width, minlength=len(n)) / one
    symbol = _SYMBOL[raw[runs.starts]] | _SYMBOL[raw[runs.ends - 1]] if len(doc) else np.zeros(0, bool)
    lines = Runs(raw, off, ~_LINE[raw])
    m, lwidth = np.maximum(np.diff(lines.off), 1), np.int64(len(lines.distinct) + 1)
    distinct_lines = np.bincount(np.unique(lines.doc * lwidth + lines.codes) // lwidth, minlength=len(n)) / m
    return np.stack([
        np.log1p(n), segment_sum(bytes_each, runs.off) / one, share(_UPPER), share(DIGIT), share(_SENTENCE), share(_SYMBOL),
        share(np.arange(256) >= 0x80), np.diff(lines.off) / one, np.where(n, distinct, 1) * np.log1p(np.sqrt(n)), same(1), same(2),
        segment_sum(symbol.astype(np.int64), runs.off) / one, segment_sum((bytes_each > 24).astype(np.int64), runs.off) / one,
        np.where(np.diff(lines.off), distinct_lines, 1)], axis=1)


@dataclass(frozen=True)
class Ranking:
    center: np.ndarray
    scale: np.ndarray
    weights: np.ndarray
    cut: float    # the threshold's quantile of the raw scores
    steep: float
    constant: float | None = None

    def raw(self, x: np.ndarray) -> np.ndarray:
        return np.clip((x - self.center) / self.scale, -8, 8) @ self.weights

    def scores(self, x: np.ndarray) -> np.ndarray:
        if self.constant is not None:
            return np.full(len(x), self.constant)
        z = self.steep * (self.raw(x) - self.cut) + np.log(THRESHOLD / (1 - THRESHOLD))
        return np.clip(1 / (1 + np.exp(-np.clip(z, -500, 500))), 0, 1)


def trained(x: np.ndarray, y: np.ndarray, most_pairs: int = MOST_PAIRS) -> Ranking:
    center, scale = (x.mean(axis=0), x.std(axis=0) + 1e-6) if len(x) else (np.zeros(len(FEATURES)), np.ones(len(FEATURES)))
    good, bad = np.flatnonzero(y == 1), np.flatnonzero(y == 0)
    if not len(good) or not len(bad):
        share = (len(good) + 1) / (len(y) + 2)
        return Ranking(center, scale, np.zeros(x.shape[1]), 0.0, 1.0, share)
    rng = np.random.default_rng(6)
    pairs = min(most_pairs, len(good) * len(bad))
    z = np.clip((x - center) / scale, -8, 8)
    gap = z[rng.choice(good, pairs)] - z[rng.choice(bad, pairs)]
    w = np.zeros(x.shape[1])
    for _ in range(25):
        p = 1 / (1 + np.exp(np.clip(gap @ w, -30, 30)))
        step = np.linalg.solve((gap * (p * (1 - p))[:, None]).T @ gap / pairs + L2 * np.eye(len(w)), gap.T @ p / pairs - L2 * w)
        w += step / max(1.0, np.abs(step).max())
    raw = z @ w
    # the quantile between the classes: the middle of the gap that the share of label 0 leaves in the sorted scores
    order = np.sort(raw)
    k = min(max(len(bad), 1), len(order) - 1)
    cut = float((order[k - 1] + order[k]) / 2)
    spread = float(np.median(raw[good]) - np.median(raw[bad]))
    return Ranking(center, scale, w, cut, 6 / max(abs(spread), 1e-6))


def fit(sample: DataFrame) -> Ranking:
    """The ranking for (text, label) rows; the sample must be bounded."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = 0
            for part in slices(as_strings(batch.column("text"))):
                x = features(part)
                yield pa.RecordBatch.from_arrays([pa.FixedSizeListArray.from_arrays(pa.array(x.ravel()), len(FEATURES)).cast(pa.list_(pa.float64())),
                                                  batch.column("label").slice(at, len(part)).cast(pa.int32())], names=["x", "label"])
                at += len(part)

    got = sample.select("text", "label").mapInArrow(rows, "x array<double>, label int").toArrow()
    x = np.array(got.column("x").combine_chunks().flatten().to_numpy() if got.num_rows else [], np.float64).reshape(-1, len(FEATURES))
    y = got.column("label").to_numpy()
    order = np.lexsort((*x.T, y))  # the same fit whatever order the rows come in
    return trained(x[order], y[order])


def score(text: Column, ranking: Ranking) -> Column:
    """The score of each whole text."""

    @arrow_udf("double")
    def scores(texts: pa.Array) -> pa.Array:
        return by_slice(texts, lambda part: pa.array(ranking.scores(features(part))), pa.float64())

    return scores(text)


def predictions(docs: DataFrame, labels: DataFrame, folds: int = 5, held_fold: int = 0, most: int = SAMPLE_DOCS,
                id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, held_out, score and predicted for each row of ``docs``."""
    ranking = fit(labelled_sample(docs, labels, "quality", folds, held_fold, most, id_col, text_col))
    scored = docs.select(F.col(id_col).alias("doc_id"), score(F.col(text_col), ranking).alias("score"))
    return scored.select("doc_id", in_fold(F.col("doc_id"), folds, held_fold).alias("held_out"), "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))

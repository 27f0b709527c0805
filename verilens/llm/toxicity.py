"""Toxicity by a factorization machine over hashed terms (operator 3).

Terms of a document: its distinct words in lower case and their prefixes of 3
to 6 bytes, hashed.  Terms whose document frequency differs clearly between the
classes are selected by a count over the sample (pre-aggregated before its
shuffle).  Terms that are neutral alone but come together more often in one
class are selected too: by the joint frequencies of the commonest neutral terms.
The machine adds to the linear weights the products of latent
vectors for every pair of terms that occur together, so that a pair (an insult
and the mention of a group) may weigh more than its parts.  All sums run over
words, so a batch costs one pass over its distinct words.

Fit: on a bounded sample of labelled documents (``labelled.SAMPLE_DOCS``, a
parameter) on the driver: at most ``MOST_TERMS`` + ``MOST_PAIRED`` columns, and joint frequencies of ``MOST_COMMON`` terms.  Scoring reads whole
texts of all documents on the executors.

Defined results: null and empty texts score the bias; an unlabelled or one-class
sample gives a constant score, the smoothed share of label 1; repeated rows
score alike; a null doc_id isn't held out; other columns are ignored; an empty
table gives no rows.
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
from verilens.llm.textbatch import WORD, Runs, as_strings, by_slice, flat, mixed, powers, segment_sum, slices, whole_hashes
from verilens.session import stored

BUCKET_BITS = 20
PREFIXES = (3, 4, 5, 6)
MOST_TERMS = 768
LEAST_DOCS = 3
#: Standard errors by which a term's document frequency must differ between the classes.
LEAST_Z = 4.0
#: Commonest neutral terms whose pairs are tried, documents that such a term and pair are in at least,
#: standard errors by which a pair's frequency must differ (there are two million pairs), and terms taken from pairs at most.
MOST_COMMON, LEAST_COMMON, PAIR_Z, MOST_PAIRED = 2_048, 10, 7.0, 256
FACTORS, ROUNDS, RATE, L2 = 4, 250, 0.05, 1e-4


@dataclass(frozen=True)
class Machine:
    """Bias, linear weights and latent vectors of the selected buckets."""

    buckets: np.ndarray
    bias: float
    weights: np.ndarray
    factors: np.ndarray

    def logits(self, doc: np.ndarray, term: np.ndarray, n: int) -> np.ndarray:
        """Scores of n documents from (document, selected term) pairs without repeats, by document."""
        off = np.searchsorted(doc, np.arange(n + 1))
        v = self.factors[term]
        linear = segment_sum(self.weights[term], off)
        return self.bias + linear + 0.5 * (segment_sum(v, off) ** 2 - segment_sum(v * v, off)).sum(axis=1)


def terms(texts: pa.Array) -> tuple[Runs, np.ndarray]:
    """Word runs of lower-cased texts, and the buckets of each distinct word's terms (-1: none)."""
    raw, off = flat(pa.compute.utf8_lower(texts))
    runs = Runs(raw, off, WORD[raw])
    wraw, woff = flat(runs.distinct)
    size = np.diff(woff)
    buckets = np.full((len(size), 1 + len(PREFIXES)), -1, np.int64)
    shift = np.uint64(64 - BUCKET_BITS)
    buckets[:, 0] = whole_hashes(wraw, woff) >> shift
    p = powers(max(PREFIXES))
    for column, n in enumerate(PREFIXES, 1):
        long = np.flatnonzero(size > n)
        h = np.full(len(long), n, np.uint64)
        for k in range(n):
            h += (wraw[woff[long] + k].astype(np.uint64) + np.uint64(1)) * p[k]
        buckets[long, column] = mixed(h * np.uint64(0x9E3779B97F4A7C15)) >> shift
    return runs, buckets


def _selected(texts: pa.Array, chosen: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct (document, selected term) pairs, by document; ``chosen`` has each bucket's term or -1."""
    runs, buckets = terms(texts)
    of_word = np.where(buckets >= 0, chosen[buckets], -1)
    some = (of_word >= 0).any(axis=1)
    at = np.flatnonzero(some[runs.codes])
    found = of_word[runs.codes[at]]
    doc = np.searchsorted(runs.off, at, side="right") - 1
    width = np.int64(1 << BUCKET_BITS)
    pairs = np.unique((doc[:, None] * width + found)[found >= 0])
    return pairs // width, pairs % width


def _table(buckets: np.ndarray) -> np.ndarray:
    chosen = np.full(1 << BUCKET_BITS, -1, np.int32)
    chosen[buckets] = np.arange(len(buckets))
    return chosen


def _frequencies(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Document frequencies of buckets by class, one row for each bucket of a batch."""
    for batch in batches:
        label = batch.column("label").to_numpy(zero_copy_only=False)
        at, count = 0, np.zeros((2, 1 << BUCKET_BITS), np.int64)
        for part in slices(as_strings(batch.column("text"))):
            runs, buckets = terms(part)
            doc_word = np.unique(runs.doc * np.int64(max(1, len(buckets))) + runs.codes)
            of_word = buckets[doc_word % max(1, len(buckets))]
            doc = np.repeat(doc_word // max(1, len(buckets)), of_word.shape[1])
            pairs = np.unique((doc * np.int64(1 << BUCKET_BITS) + of_word.ravel())[of_word.ravel() >= 0])
            doc, bucket = pairs >> BUCKET_BITS, pairs & ((1 << BUCKET_BITS) - 1)
            for c in (0, 1):
                count[c] += np.bincount(bucket[label[at + doc] == c], minlength=1 << BUCKET_BITS)
            at += len(part)
        some = np.flatnonzero(count.any(axis=0))
        yield pa.RecordBatch.from_arrays([pa.array(some), pa.array(count[0][some]), pa.array(count[1][some])], names=["bucket", "n0", "n1"])


def fit(sample: DataFrame, most_terms: int = MOST_TERMS) -> Machine:
    """The machine for (text, label) rows; the sample must be bounded."""
    sample = stored(sample.select("text", "label"), "toxic-sample")
    sizes = {r["label"]: r["count"] for r in sample.groupBy("label").count().collect()}
    n0, n1 = sizes.get(0, 0), sizes.get(1, 0)
    prior = float(np.log((n1 + 1) / (n0 + 1)))
    if not n0 or not n1:
        return Machine(np.zeros(0, np.int64), prior, np.zeros(0), np.zeros((0, FACTORS)))
    counted = sample.mapInArrow(_frequencies, "bucket long, n0 long, n1 long").groupBy("bucket").agg(F.sum("n0").alias("n0"), F.sum("n1").alias("n1"))
    p0, p1 = F.col("n0") / n0, F.col("n1") / n1
    every = (F.col("n0") + F.col("n1")) / (n0 + n1)
    z = F.abs(p1 - p0) / F.sqrt(every * (1 - every) * (1 / n0 + 1 / n1) + F.lit(1e-12))
    counted = stored(counted.where(F.col("n0") + F.col("n1") >= LEAST_DOCS).select("bucket", (F.col("n0") + F.col("n1")).alias("n"), z.alias("z")), "toxic-terms")
    top = counted.where(F.col("z") >= LEAST_Z).orderBy(F.desc("z"), "bucket").limit(most_terms).collect()
    neutral = counted.where((F.col("z") < LEAST_Z) & (F.col("n") >= LEAST_COMMON)).orderBy(F.desc("n"), "bucket").limit(MOST_COMMON).collect()
    common = np.array(sorted(r["bucket"] for r in neutral), np.int64)
    paired = common[paired_terms(*_term_lists(sample, common), len(common))]
    buckets = np.sort(np.concatenate([np.array([r["bucket"] for r in top], np.int64), paired]))
    off, terms_of, label = _term_lists(sample, buckets)
    x = np.zeros((len(label), len(buckets)), np.float32)
    x[np.repeat(np.arange(len(label)), np.diff(off)), terms_of] = 1
    return trained(x, label.astype(np.float32), buckets, prior)


def _term_lists(sample: DataFrame, buckets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(offsets, terms, labels) of the sample's documents; a term is a place in ``buckets``.  Bounded: the sample's documents by the buckets."""
    chosen = _table(buckets)

    def pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at, label = 0, batch.column("label")
            for part in slices(as_strings(batch.column("text"))):
                doc, term = _selected(part, chosen)
                off = np.searchsorted(doc, np.arange(len(part) + 1))
                lists = pa.ListArray.from_arrays(pa.array(off, pa.int32()), pa.array(term, pa.int32()))
                yield pa.RecordBatch.from_arrays([lists, label.slice(at, len(part)).cast(pa.int32())], names=["terms", "label"])
                at += len(part)

    rows = sample.mapInArrow(pairs, "terms array<int>, label int").toArrow()
    lists = rows.column("terms").combine_chunks()
    return lists.offsets.to_numpy(), lists.flatten().to_numpy(), rows.column("label").to_numpy()


def paired_terms(off: np.ndarray, terms_of: np.ndarray, label: np.ndarray, n: int) -> np.ndarray:
    """The terms of the pairs whose joint document frequency differs most between the classes, ``MOST_PAIRED`` of ``n`` at most."""
    both = np.zeros((2, n, n), np.float32)
    for c in (0, 1):
        docs = np.flatnonzero(label == c)
        for some in np.array_split(docs, len(docs) // 1000 + 1):
            x = np.zeros((len(some), n), np.float32)
            for row, d in enumerate(some):
                x[row, terms_of[off[d]:off[d + 1]]] = 1
            both[c] += x.T @ x
    n0, n1 = max(1, (label == 0).sum()), max(1, (label == 1).sum())
    every = both.sum(axis=0)
    share = every / (n0 + n1)
    z = np.abs(both[1] / n1 - both[0] / n0) / np.sqrt(share * (1 - share) * (1 / n0 + 1 / n1) + 1e-12)
    z[np.tril_indices(n)] = 0
    z[every < LEAST_COMMON] = 0
    a, b = np.nonzero(z >= PAIR_Z)
    best = np.lexsort((b, a, -z[a, b]))
    of_pairs = np.stack([a[best], b[best]], axis=1).ravel()
    _, first = np.unique(of_pairs, return_index=True)
    return np.sort(of_pairs[np.sort(first)[:MOST_PAIRED]])


def trained(x: np.ndarray, y: np.ndarray, buckets: np.ndarray, bias: float) -> Machine:
    """Logistic loss, by Adam on the whole sample."""
    rng = np.random.default_rng(3)
    params = [np.array([bias], np.float32), np.zeros(x.shape[1], np.float32), rng.normal(0, 0.02, (x.shape[1], FACTORS)).astype(np.float32)]
    moments = [(np.zeros_like(p), np.zeros_like(p)) for p in params]
    for step in range(1, ROUNDS + 1):
        b, w, v = params
        xv = x @ v
        logit = b[0] + x @ w + 0.5 * ((xv ** 2).sum(axis=1) - x @ (v * v).sum(axis=1))
        e = (1 / (1 + np.exp(-np.clip(logit, -30, 30))) - y) / len(y)
        ex = e @ x
        grads = [e.sum(keepdims=True), ex + L2 * w, x.T @ (e[:, None] * xv) - ex[:, None] * v + L2 * v]
        for p, g, (m, s) in zip(params, grads, moments, strict=True):
            m += 0.1 * (g - m)
            s += 0.001 * (g * g - s)
            p -= RATE * (m / (1 - 0.9 ** step)) / (np.sqrt(s / (1 - 0.999 ** step)) + 1e-8)
    b, w, v = params
    return Machine(buckets, float(b[0]), w.astype(np.float64), v.astype(np.float64))


def score(text: Column, machine: Machine) -> Column:
    """The probability of label 1 for each whole text."""

    @arrow_udf("double")
    def scores(texts: pa.Array) -> pa.Array:
        chosen = _table(machine.buckets)
        return by_slice(texts, lambda part: pa.array(1 / (1 + np.exp(-np.clip(machine.logits(*_selected(part, chosen), len(part)), -700, 700)))), pa.float64())

    return scores(text)


def predictions(docs: DataFrame, labels: DataFrame, folds: int = 5, held_fold: int = 0, threshold: float = 0.5, most: int = SAMPLE_DOCS,
                id_col: str = "doc_id", text_col: str = "text", keep: tuple[Column, ...] = ()) -> DataFrame:
    """doc_id, held_out, score and predicted for each row of ``docs``, and the columns in ``keep``."""
    machine = fit(labelled_sample(docs, labels, "toxic", folds, held_fold, most, id_col, text_col))
    scored = docs.select(F.col(id_col).alias("doc_id"), score(F.col(text_col), machine).alias("score"), *keep)
    return scored.select("doc_id", in_fold(F.col("doc_id"), folds, held_fold).alias("held_out"), "score",
                         (F.col("score") >= threshold).cast("int").alias("predicted"), *scored.columns[2:])

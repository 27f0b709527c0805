"""Language identification by error-correcting output codes (operator 5).

Every language has a codeword; one linear classifier over hashed byte n-grams
predicts each bit.  Decoding sums the classifiers' losses against each codeword
and takes the least; the loss of a bit counts by how well that bit separated the
sample.  The gap to the second codeword gives the score's certainty and an
``ambiguous`` flag.  Up to five languages all non-trivial splits are bits;
beyond, seeded random bits with the largest distance between codewords.

Words (in lower case, with a blank on either side) are scored once for each
batch; a text's features are the mean over its n-grams, so no text is cut.

Fit: on at most ``SAMPLE_DOCS`` documents, dealt evenly over the languages, on
the driver (documented bound; hashed to ``BUCKETS`` columns).

Defined results: ``und`` for null text or text without a letter (score 0); with
no language learned every text is ``und``; a null or empty lang teaches nothing;
repeated rows are predicted alike; a null doc_id isn't held out; other columns
are ignored; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from itertools import product

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.functions import arrow_udf

from verilens.llm.labelled import in_fold
from verilens.llm.textbatch import WORD, Runs, as_strings, by_slice, flat, gram_hashes, segment_sum, slices
from verilens.session import stored

SAMPLE_DOCS = 4_000
#: Ranges of the hash (2 to this power) by which a language's rows are counted.
BUCKETS = 1 << 13
GRAMS = (1, 2, 3, 4)
ROUNDS, RATE, L2 = 200, 0.05, 1e-5
#: A text is ambiguous if the best language's share is less than this.
CERTAIN = 0.6
UNDETERMINED = "und"


@dataclass(frozen=True)
class Codes:
    langs: list[str]
    words: np.ndarray   # languages x bits, +1 / -1
    trust: np.ndarray   # weight of each bit's loss
    weights: np.ndarray  # buckets x bits
    bias: np.ndarray


def codewords(n: int, seed: int = 5) -> np.ndarray:
    """n codewords of +1 and -1."""
    if n <= 5:
        bits = [b for b in product((1, -1), repeat=n) if b[0] == 1 and -1 in b]
        return np.array(bits or [(1,) * n]).T
    rng, length = np.random.default_rng(seed), int(np.ceil(10 * np.log2(n)))
    best, far = None, -1
    for _ in range(200):
        words = rng.choice((-1, 1), (n, length))
        apart = (length - words @ words.T + 2 * length * np.eye(n, dtype=int)).min()
        if apart > far:
            best, far = words, apart
    return best


def _grams(texts: pa.Array) -> tuple[Runs, np.ndarray, np.ndarray]:
    """Word runs, the n-gram buckets of the distinct words, and their offsets by word."""
    raw, off = flat(pa.compute.utf8_lower(texts))
    runs = Runs(raw, off, WORD[raw])
    wraw, woff = flat(runs.distinct)
    size = np.diff(woff)
    padded = np.full(len(wraw) + 2 * len(size), 0x20, np.uint8)
    poff = woff + 2 * np.arange(len(woff))
    padded[np.arange(len(wraw)) + np.repeat(2 * np.arange(len(size)) + 1, size)] = wraw
    parts = [gram_hashes(padded, poff, n) for n in GRAMS]
    goff = sum(o for _, o in parts)
    out = np.empty(goff[-1], np.int64)
    at = goff[:-1].copy()
    for h, o in parts:
        count = np.diff(o)
        out[np.arange(o[-1]) + np.repeat(at - o[:-1], count)] = h % np.uint64(BUCKETS)
        at += count
    return runs, out, goff


def _means(texts: pa.Array) -> Iterator[np.ndarray]:
    """Each text's share of every bucket, square-rooted."""
    runs, grams, goff = _grams(texts)
    for a, b in zip(runs.off[:-1], runs.off[1:], strict=True):
        code, times = np.unique(runs.codes[a:b], return_counts=True)
        size = (goff[1:] - goff[:-1])[code]
        at = np.arange(size.sum()) + np.repeat(goff[code] - np.concatenate([[0], np.cumsum(size)[:-1]]), size) if len(code) else np.zeros(0, np.int64)
        x = np.bincount(grams[at], np.repeat(times, size), BUCKETS)
        yield (x / max(1, x.sum())).astype(np.float32)


def sample_ids(rows: DataFrame, most: int = SAMPLE_DOCS) -> DataFrame:
    """At most ``most`` distinct (id, lang), the languages in turn, by hash of the id.

    A window over a language would bring a third of all rows into one task, so
    repeats go first (combined before the shuffle), the ids of each language are
    counted, and only hashes up to a limit that leaves about twice as many as
    needed are read (fewer than ``most`` of them would take a hash that isn't uniform).  More
    than ``most`` languages can't all be sampled: those with the smallest
    hashes are taken, which also bounds the broadcast."""
    ids = stored(rows.select("lang", "id").distinct().withColumn("h", F.xxhash64("id")), "sample-ids")
    share = (2.0 * most + 200) / F.col("n")
    limit = F.when(share >= 1, F.lit((1 << 63) - 1)).otherwise((share * float(1 << 64) - float(1 << 63)).cast("long"))
    read = (ids.groupBy("lang").agg(F.count("*").alias("n"), F.min("h").alias("least")).orderBy("least", "lang").limit(most)
            .select("lang", limit.alias("limit")))
    near = ids.join(F.broadcast(read), "lang").where(F.col("h") <= F.col("limit")).select("lang", "id", "h")
    turn = F.row_number().over(Window.partitionBy("lang").orderBy("h", "id"))
    return near.withColumn("n", turn).orderBy("n", "h", "id", "lang").limit(most).select("id", "lang")


def fit(docs: DataFrame, most: int = SAMPLE_DOCS) -> Codes | None:
    """Codes for (id, text, lang) rows, fitted on ``sample_ids``."""
    rows = docs.select("id", "text", "lang").where(F.col("text").isNotNull() & F.col("lang").isNotNull() & (F.col("lang") != "") & (F.col("lang") != UNDETERMINED))
    ids = sample_ids(rows, most)
    sample = rows.join(F.broadcast(ids), ["id", "lang"]).groupBy("id", "lang").agg(F.min("text").alias("text"))

    def features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = 0
            for part in slices(as_strings(batch.column("text")), 1 << 20):
                x = list(_means(part))
                at_bucket = [np.flatnonzero(v) for v in x]
                yield pa.RecordBatch.from_arrays([
                    batch.column("lang").slice(at, len(part)).cast(pa.string()),
                    pa.array([b.astype(np.uint16).tobytes() for b in at_bucket], pa.binary()),
                    pa.array([v[b].tobytes() for v, b in zip(x, at_bucket, strict=True)], pa.binary())], names=["lang", "buckets", "shares"])
                at += len(part)

    rows = sample.mapInArrow(features, "lang string, buckets binary, shares binary").toArrow().to_pylist()
    langs = sorted({r["lang"] for r in rows})
    if not langs:
        return None
    x = np.zeros((len(rows), BUCKETS), np.float32)
    for i, r in enumerate(rows):
        x[i, np.frombuffer(r["buckets"], np.uint16)] = np.frombuffer(r["shares"], np.float32)
    return trained(x, np.array([langs.index(r["lang"]) for r in rows]), langs)


def trained(x: np.ndarray, of: np.ndarray, langs: list[str]) -> Codes:
    words = codewords(len(langs))
    y = words[of].astype(np.float32)
    scale = np.float32(len(GRAMS) * 40)
    each = 1 / np.bincount(of, minlength=len(langs))[of]
    each = (each / each.sum()).astype(np.float32)[:, None]
    params = [np.zeros((x.shape[1], y.shape[1]), np.float32), np.zeros(y.shape[1], np.float32)]
    moments = [(np.zeros_like(p), np.zeros_like(p)) for p in params]
    x = x * scale
    for step in range(1, ROUNDS + 1):
        w, b = params
        e = -y / (1 + np.exp(np.clip(y * (x @ w + b), -30, 30))) * each
        for p, g, (m, s) in zip(params, [x.T @ e + L2 * w, e.sum(axis=0)], moments, strict=True):
            m += 0.1 * (g - m)
            s += 0.001 * (g * g - s)
            p -= RATE * (m / (1 - 0.9 ** step)) / (np.sqrt(s / (1 - 0.999 ** step)) + 1e-8)
    w, b = params
    loss = (np.logaddexp(0, -y * (x @ w + b)) * each).sum(axis=0)
    trust = 1 / (0.05 + loss)
    return Codes(langs, words, trust / trust.sum(), (w * scale).astype(np.float64), b.astype(np.float64))


def margins(texts: pa.Array, codes: Codes) -> np.ndarray:
    runs, grams, goff = _grams(texts)
    by_word = segment_sum(codes.weights[grams], goff)
    n = segment_sum(np.diff(goff)[runs.codes], runs.off)
    return segment_sum(by_word[runs.codes], runs.off) / np.maximum(n, 1)[:, None] + codes.bias


def decoded(margin: np.ndarray, codes: Codes) -> tuple[np.ndarray, np.ndarray]:
    """(number of the language with the least weighted loss, its share against the others)."""
    loss = np.stack([(np.logaddexp(0, -word * margin) * codes.trust).sum(axis=1) for word in codes.words], axis=1)
    share = np.exp(-4 * (loss - loss.min(axis=1, keepdims=True)))
    share /= share.sum(axis=1, keepdims=True)
    best = loss.argmin(axis=1)
    return best, share[np.arange(len(best)), best]


def identify(text: Column, codes: Codes | None) -> Column:
    """struct(lang_pred, score, ambiguous) of each whole text."""
    kind = pa.struct([("lang_pred", pa.string()), ("score", pa.float64()), ("ambiguous", pa.bool_())])

    def found(texts: pa.Array) -> pa.Array:
        letters = pa.compute.match_substring_regex(texts, r"\p{L}").to_numpy(zero_copy_only=False)
        if codes is None:
            best, share = np.zeros(len(texts), np.int64), np.zeros(len(texts))
            letters[:] = False
        else:
            best, share = decoded(margins(texts, codes), codes)
        names = pa.array([*(codes.langs if codes else []), UNDETERMINED], pa.string())
        share = np.where(letters, share, 0.0)
        return pa.StructArray.from_arrays([names.take(pa.array(np.where(letters, best, len(names) - 1))), pa.array(share), pa.array(letters & (share < CERTAIN))], fields=list(kind))

    @arrow_udf("lang_pred string, score double, ambiguous boolean")
    def languages(texts: pa.Array) -> pa.Array:
        return by_slice(texts, found, kind)

    return languages(text)


def predictions(docs: DataFrame, folds: int = 4, held_fold: int = 2, most: int = SAMPLE_DOCS, id_col: str = "doc_id",
                text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """doc_id, held_out, lang_pred, score and ambiguous for each row of ``docs``."""
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"), F.col(lang_col).alias("lang"))
    codes = fit(rows.where(F.col("id").isNotNull() & ~in_fold(F.col("id"), folds, held_fold)), most)
    found = docs.select(F.col(id_col).alias("doc_id"), identify(F.col(text_col), codes).alias("x"))
    return found.select("doc_id", in_fold(F.col("doc_id"), folds, held_fold).alias("held_out"), "x.lang_pred", "x.score", "x.ambiguous")

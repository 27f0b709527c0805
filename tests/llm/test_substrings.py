"""Operator 13 against windows counted one by one."""
import hashlib
import random
import re
from collections import Counter

import numpy as np
import pytest

from verilens.llm import fmindex, substrings

WINDOW = substrings.WINDOW


def expected(rows):
    words = [(i, re.findall(r"[^\x20\x09-\x0D]+", t or "")) for i, t in rows]
    seen = Counter(tuple(w[k:k + WINDOW]) for _, w in words for k in range(len(w) - WINDOW + 1))
    out = []
    for i, w in words:
        gone = set()
        for k in range(len(w) - WINDOW + 1):
            if seen[tuple(w[k:k + WINDOW])] > 1:
                gone.update(range(k, k + WINDOW))
        kept = " ".join(x for k, x in enumerate(w) if k not in gone)
        out.append((str(i), len(w), len(gone), hashlib.sha256(kept.encode()).hexdigest()))
    return sorted(out)


def result(df):
    return sorted((str(r.doc_id), r.n_words, r.n_removed, r.kept_sha256) for r in df.collect())


def corpus(seed, n=60, vocabulary=400):
    """Texts that share passages, with changes inside some copies."""
    rng = random.Random(seed)
    word = lambda: f"w{rng.randint(0, vocabulary)}"
    passages = [[word() for _ in range(rng.choice((34, 35, 36, 50, 90, 300)))] for _ in range(12)]
    texts = []
    for _ in range(n):
        parts = []
        for _ in range(rng.randint(0, 5)):
            if rng.random() < .5:
                p = list(rng.choice(passages))
                if rng.random() < .5:
                    p[rng.randrange(len(p))] = "changed"
                if rng.random() < .3:
                    p = p[rng.randint(0, 20):len(p) - rng.randint(0, 20)]
                parts += p
            else:
                parts += [word() for _ in range(rng.randint(0, 120))]
        texts.append(rng.choice((" ", "\n", "\t ")).join(parts))
    return texts


ODD = [None, "", " \n\t", "a " * 34, "a " * 35, "a " * 36, "b " * 35, "b " * 35, "c c　d " * 40, "ä ö " * 18 + "\x00 ü", "z" * 100_000, "x y z " * 20_000]


@pytest.mark.parametrize(("seed", "most"), [(1, substrings.MOST_STRETCHES), (2, 3), (3, 0)])
def test_equals_windows_counted_one_by_one(docs, seed, most):
    """Also with minimizers whose windows are counted singly."""
    texts = corpus(seed) + ODD
    rows = list(zip([*range(len(texts) - 2), None, 3], texts, strict=True))
    rows += rows[:5]
    df = docs([t for _, t in rows], ids=[i for i, _ in rows])
    assert result(substrings.without_repeats(df, most_stretches=most)) == expected(rows)


def test_odd_and_empty_tables(odd):
    rows = [(r.doc_id, r.text) for r in odd.select("doc_id", "text").collect()]
    got = substrings.without_repeats(odd, with_text=True)
    assert result(got) == expected(rows)
    assert all(hashlib.sha256(r.kept.encode()).hexdigest() == r.kept_sha256 for r in got.collect())
    assert substrings.without_repeats(odd.limit(0)).count() == 0


def test_ranges_are_those_of_sorted_suffixes():
    rng = np.random.default_rng(1)
    text = np.concatenate([np.append(rng.integers(1, 6, rng.integers(1, 40)), 0) for _ in range(30)])
    index = fmindex.FMIndex(text, 8)
    plain = text.tolist()
    for _ in range(400):
        size = int(rng.integers(1, 8))
        pattern = rng.integers(1, 6, size).tolist() if rng.random() < .5 else plain[(k := int(rng.integers(0, len(plain) - size))):k + size]
        if 0 in pattern:
            continue
        low, high = np.array([0]), np.array([index.n])
        for c in reversed(pattern):
            low, high = index.extended(np.array([c]), low, high)
        assert high[0] - low[0] == sum(plain[k:k + size] == pattern for k in range(len(plain)))


@pytest.mark.parametrize("length", [2, 5])
def test_masks_are_those_of_counted_windows(length):
    rng = np.random.default_rng(length)
    for _ in range(40):
        sizes = rng.integers(length, length + 20, 12)
        parts = [rng.integers(1, 5, s) for s in sizes]
        text = np.concatenate([np.append(p, 0) for p in parts])
        starts = np.cumsum(sizes + 1) - sizes - 1
        got = fmindex.repeated_windows(text, starts, sizes - length + 1, np.zeros(12, bool), length)
        seen = Counter(tuple(p[k:k + length]) for p in parts for k in range(len(p) - length + 1))
        want = [sum(1 << k for k in range(len(p) - length + 1) if seen[tuple(p[k:k + length])] > 1) for p in parts]
        assert got.tolist() == want

"""Operator 12 against the two libraries and plain loops."""
import hashlib
import random
from collections import Counter

import pytest
import sentencepiece
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tests.llm.conftest import ODD_TEXTS
from tests.llm.test_tokens import texts as random_texts
from verilens.llm import alignment, bpe, hotkeys
from verilens.llm.queries import BYTE_BPE, PIECES

SYMBOL = bpe.byte_symbols()


@pytest.fixture(scope="module")
def libraries():
    a = Tokenizer.from_file(BYTE_BPE)
    a.encode_special_tokens = True
    a.no_truncation()
    a.no_padding()
    return a, sentencepiece.SentencePieceProcessor(model_file=PIECES)


def tokens(libraries, text):
    """[(id, bytes)] by A and B, or none."""
    a, b = libraries
    xs = [(i, bytes(SYMBOL[c] for c in a.id_to_token(i))) for i in a.encode(" " + text, add_special_tokens=False).ids]
    ys = [(i, bytes([int(b.id_to_piece(i)[3:5], 16)]) if b.is_byte(i) else b.id_to_piece(i).replace("▁", " ").encode()) for i in b.encode(text)]
    whole = (" " + text).encode()
    return (xs, ys) if text and b"".join(x for _, x in xs) == whole == b"".join(y for _, y in ys) else ([], [])


def ends(tokens):
    at = 0
    for i, x in tokens:
        at += len(x)
        yield i, at


def expected(libraries, rows):
    found, counts = [], Counter()
    for doc_id, text in rows:
        xs, ys = (list(ends(t)) for t in tokens(libraries, text or ""))
        links = [(a, b) for a, p in xs for b, q in ys if p == q] if len(xs) < 3000 else [(a, dict((q, b) for b, q in ys)[p]) for a, p in xs if p in {q for _, q in ys}]
        counts.update(links)
        cuts = sorted({p for _, p in xs} & {q for _, q in ys})
        groups, before = [], 0
        for cut in cuts if len(xs) < 3000 else []:
            groups.append(",".join(str(a) for a, p in xs if before < p <= cut) + "|" + ",".join(str(b) for b, q in ys if before < q <= cut))
            before = cut
        found.append((doc_id, len(xs), len(ys), len(cuts), links, hashlib.sha256(";".join(groups).encode()).hexdigest() if cuts else ""))
    best = {}
    for (_, b), n in counts.items():
        best[b] = max(best.get(b, 0), n)
    return sorted((str(d), a, b, g, len(links), sum(counts[x] == best[x[1]] for x in links), sum(counts[x] for x in links), h if a < 3000 else None)
                  for d, a, b, g, links, h in found)


def result(df):
    return sorted((str(r.doc_id), r.n_a, r.n_b, r.n_groups, r.n_links, r.n_best, r.count_sum, r.groups_sha256 if r.n_a < 3000 else None) for r in df.collect())


def test_equals_the_libraries(docs, libraries):
    rng = random.Random(4)
    some = [t for t in random_texts(300, 8) if len(t) < 50_000] + ["the of and " * rng.randint(1, 9) for _ in range(30)] + ["the cat", "the cat", "the", None, "", "▁a", "a ▁ b", "   ", " ", "<s>x</s>", "<0x41>"]
    ids = [*range(len(some) - 2), None, 0]
    assert result(alignment.aligned(docs(some, ids=ids), BYTE_BPE, PIECES)) == expected(libraries, list(zip(ids, some, strict=True)))


def test_pieces_are_the_librarys(libraries):
    import pyarrow as pa

    from verilens.llm.textbatch import flat
    xs = [t for t in random_texts(4000, 2) if t and "▁" not in t] + [" ", "  ", "a ", "a   b  "]
    got, off = alignment.Pieces(PIECES).encode(*flat(pa.array([" " + t for t in xs])))
    assert [got[a:b].tolist() for a, b in zip(off, off[1:], strict=False)] == libraries[1].encode(xs)


def test_odd_rows(odd, libraries):
    rows = [(r.doc_id, r.text) for r in odd.select("doc_id", "text").collect()]
    short = [(i, t) for i, t in rows if len(t or "") < 50_000]
    got = alignment.aligned(odd, BYTE_BPE, PIECES)
    assert got.count() == len(rows)
    some = alignment.aligned(odd.where(F.coalesce(F.length("text"), F.lit(0)) < 50_000), BYTE_BPE, PIECES)
    assert result(some) == expected(libraries, short)
    assert alignment.aligned(odd.limit(0), BYTE_BPE, PIECES).count() == 0
    long = [r for r in got.collect() if r.n_a > 3000]
    assert {r.n_a for r in long} == {len(tokens(libraries, t)[0]) for t in ODD_TEXTS if len(t or "") >= 50_000 and len(tokens(libraries, t)[0]) > 3000}


def test_frequent_keys_are_salted(spark, monkeypatch):
    monkeypatch.setattr(hotkeys, "LEAST_HOT", 10)
    rows = spark.range(5000).select("id", F.when(F.col("id") % 3 == 0, F.lit(-1)).otherwise(F.col("id")).alias("k"))
    values = rows.groupBy("k").agg(F.count("*").alias("n"))
    hot = hotkeys.hot_keys(values, ["k"], "n")
    assert [r.k for r in hot.collect()] == [-1]
    got = hotkeys.joined(rows, values, ["k"], hot, ["id"])
    assert got.count() == 5000 and got.where("n > 1").select("id").distinct().count() == 1667

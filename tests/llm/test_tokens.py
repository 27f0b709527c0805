"""Operators 4, 8 and 9 against the libraries themselves."""
import hashlib
import random
import re
import time
import zlib

import numpy as np
import public_tokenizers as P
import pyarrow as pa
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tests.llm.conftest import ODD_TEXTS
from verilens.llm import bpe, dac, tokencount
from verilens.session import stored
from verilens.llm.queries import BYTE_BPE, BYTE_BPE_RANKS, QUERIES, WORD_BPE, bpe_digests

ALPHABET = " \n\t\r\x0b\x1c\x85\xa0  ​　 'sstrevmll  aabcABCÉßñ漢ǅ٣½²0123456789.,!?-_<|>endoftext́🙂\x00İΣ"


def texts(n, seed, longest=30):
    rng = random.Random(seed)
    return ["".join(rng.choice(ALPHABET) for _ in range(rng.randint(0, longest))) for _ in range(n)] + [t or "" for t in ODD_TEXTS]


def library(path):
    t = Tokenizer.from_file(path)
    t.no_truncation()
    t.no_padding()
    return t


def test_byte_pairs_are_the_librarys():
    xs = texts(6000, 1) + ["<|endoftext|>x<|endoftext|>"]
    got, off = bpe.byte_pairs(BYTE_BPE).encode(pa.array(xs))
    own = library(BYTE_BPE)
    want = [e.ids for e in own.encode_batch(xs, add_special_tokens=False)]
    assert [got[a:b].tolist() for a, b in zip(off, off[1:], strict=False)] == want
    assert bpe.byte_pairs(BYTE_BPE).decode(got, off).to_pylist() == [own.decode(x, skip_special_tokens=False) for x in want]


def test_every_token_of_the_vocabulary_encodes_to_itself():
    pairs = bpe.byte_pairs(BYTE_BPE)
    assert pairs.whole == pairs.id_of


def test_ids_that_are_no_text_decode_as_in_the_library():
    ids = np.random.default_rng(2).integers(0, 50_257, 400).astype(np.uint32)
    off = np.arange(0, 401, 4)
    own = library(BYTE_BPE)
    assert bpe.byte_pairs(BYTE_BPE).decode(ids, off).to_pylist() == [own.decode(ids[a:a + 4].tolist(), skip_special_tokens=False) for a in off[:-1]]


def test_digests_on_odd_rows(odd):
    own = library(BYTE_BPE)
    rows = odd.select("doc_id", "text").collect()
    got = bpe_digests(odd).collect()
    assert len(got) == len(rows)
    want = sorted((str(r.doc_id), hashlib.sha256(np.array(own.encode(r.text or "", add_special_tokens=False).ids, "<u4").tobytes()).hexdigest(),
                   hashlib.sha256((r.text or "").encode()).hexdigest()) for r in rows)
    assert sorted((str(r.doc_id), r.ids_sha256, r.decoded_sha256) for r in got) == want
    assert bpe_digests(odd.limit(0)).count() == 0


def test_encode_then_decode_columns(docs):
    rows = docs(["a b", None]).select(bpe.encode(F.col("text"), BYTE_BPE).alias("ids"))
    assert [r[0] for r in rows.select(bpe.decode(F.col("ids"), BYTE_BPE)).collect()] == ["a b", ""]


@pytest.mark.parametrize("most", [200, 300, 70_000, 2**31])
def test_directly_addressable_codes(most):
    ids = np.random.default_rng(3).integers(0, most, 3000).astype(np.uint32)
    block = dac.packed(ids)
    assert (dac.unpacked(block) == ids).all()
    assert all(dac.token_at(block, i) == ids[i] for i in range(0, 3000, 7))


@pytest.mark.parametrize("shards,block_ids", [(1, 50), (5, 10**6)])
def test_id_files(spark, odd, shards, block_ids):
    folder = dac.new_folder(spark)
    dac.write(odd, folder, WORD_BPE, shards=shards, block_ids=block_ids)
    got = sorted(dac.read(spark, folder).collect(), key=lambda r: r.start)
    own = library(WORD_BPE)
    order = sorted(odd.select("doc_id", "text").collect(), key=lambda r: (-1 if r.doc_id is None else r.doc_id))
    assert [r.doc_id for r in got] == [r.doc_id for r in order]
    assert [r.start for r in got] == np.concatenate([[0], np.cumsum([r.n_tokens for r in got])[:-1]]).tolist()
    ids = lambda t: np.array([*own.encode(t or "", add_special_tokens=False).ids, 2], "<u4").tobytes()
    assert sorted((str(r.doc_id), zlib.crc32(bytes(r.ids))) for r in got) == sorted((str(r.doc_id), zlib.crc32(ids(r.text))) for r in order)


def test_id_files_of_an_empty_table_and_of_one_frequent_id(spark, docs):
    for rows in (docs([]), docs([f"text {k}" for k in range(50)], ids=[1] * 10 + [7] * 30 + [9] * 10)):
        folder = dac.new_folder(spark)
        dac.write(rows, folder, WORD_BPE, shards=4)
        got = sorted(dac.read(spark, folder).collect(), key=lambda r: r.start)
        assert [r.doc_id for r in got] == sorted(r.doc_id for r in rows.collect())


def test_library_ids_of_pieces():
    xs = texts(4000, 4)
    library_ids = dac._library(WORD_BPE)
    got = library_ids.encode(pa.array(xs), 2)
    want = library(WORD_BPE).encode_batch(xs, add_special_tokens=False)
    assert [np.frombuffer(x.as_py(), library_ids.dtype).tolist() for x in got] == [[*e.ids, 2] for e in want]


def test_pieces_reach_the_library_joined():
    class Counted:
        def __init__(self, own):
            self.own, self.seen = own, 0

        def encode_batch_fast(self, xs, **options):
            self.seen += len(xs)
            return self.own.encode_batch_fast(xs, **options)

    ids = dac._Library(WORD_BPE)
    ids.tokenizer = Counted(ids.tokenizer)
    pieces = [x.encode() for k in range(500) for x in (f"wörd{k}", f"<|endoftext{k}", "|>", "", f"'s{k}", "　", f"e\u0301{k}", f"\u0301{k}")]
    got = ids._encode_pieces(pieces)
    want = library(WORD_BPE).encode_batch([p.decode() for p in pieces], add_special_tokens=False)
    assert [np.frombuffer(x, ids.dtype).tolist() for x in got] == [e.ids for e in want]
    assert ids.tokenizer.seen < len(pieces) / 10
    ids.border = (ids.border[0], "no token of its own")  # found nowhere: each piece alone
    assert ids._encode_pieces(pieces) == got
    ids.border = None
    assert ids._encode_pieces(pieces) == got


def test_counts_follow_edits():
    rng = random.Random(5)
    xs = [x for x in texts(1500, 6, 400) if 3 < len(x) < 5000]
    count = lambda t: len(tokencount._counter(BYTE_BPE_RANKS).encoding.encode_ordinary(t))
    for text, tree in zip(xs, tokencount.trees(pa.array(xs), BYTE_BPE_RANKS), strict=True):
        assert tree.total == count(text)
        cuts, edits, new, last = sorted(rng.sample(range(len(text)), 2 * rng.randint(1, min(4, len(text) // 2)))), [], "", 0
        for a, b in zip(cuts[::2], cuts[1::2], strict=True):
            put = rng.choice(["", "#", " ", "  x", "'s\n", "abc 12", "　", None])
            edits.append({"start": len(text[:a].encode()), "length": len(text[a:b].encode()), "replacement": put})
            new, last = new + text[last:a] + (put or ""), b
        new += text[last:]
        after, _ = tokencount.edited(text.encode(), tree, edits, BYTE_BPE_RANKS)
        assert (after.decode(), tree.total) == (new, count(new))


def test_an_edit_encodes_a_small_region():
    text = "some plain words here. " * 5000
    tree = tokencount.trees(pa.array([text]), BYTE_BPE_RANKS)[0]
    _, again = tokencount.edited(text.encode(), tree, [{"start": 60_000, "length": 3, "replacement": "xyz"}], BYTE_BPE_RANKS)
    assert again < 1000


def test_count_query_shape(odd):
    x = tokencount.counted(F.col("text"), BYTE_BPE_RANKS, tokencount.long_numbers(F.col("text")))
    got = odd.select("text", x.alias("n")).collect()
    count = lambda t: len(tokencount._counter(BYTE_BPE_RANKS).encoding.encode_ordinary(t))
    for r in got:
        text = r.text or ""
        assert (r.n.n_tokens, r.n.text_after) == (count(text), re.sub("[0-9]{4,}", "#", text))
        assert r.n.n_tokens_after == count(r.n.text_after) and (r.n.tree[0] if r.n.tree else 0) == r.n.n_tokens
    assert odd.limit(0).select(x).count() == 0


def test_queries_read_whole_tables(spark):
    folder = "/root/testdata/sf0.001"
    n = spark.read.parquet(f"{folder}/documents.parquet").count()
    for name in ("op4_token_ids", "op8_token_counts", "op9_bpe"):
        assert QUERIES[name](spark, folder).count() == n


def test_many_edits_of_a_long_text_are_linear():
    text = ("word and 12345 more of it, " * 220_000).encode()
    edits = [{"start": 27 * k * 13 + 9, "length": 5, "replacement": "#"} for k in range(16_000)]
    tree = tokencount.trees(pa.array([text.decode()]), BYTE_BPE_RANKS)[0]
    begin = time.perf_counter()
    after, _ = tokencount.edited(text, tree, edits, BYTE_BPE_RANKS)
    assert time.perf_counter() - begin < 30
    parts, at = [], 0
    for e in edits:
        parts += [text[at:e["start"]], b"#"]
        at = e["start"] + e["length"]
    assert after == b"".join([*parts, text[at:]])
    assert tree.total == tokencount.trees(pa.array([after.decode()]), BYTE_BPE_RANKS)[0].total


def test_kept_trees_take_edits_again_and_again(docs):
    """Trees are stored with their texts; each round rereads them and encodes only around its edits."""
    some = [t for t in texts(60, 5, 400) if len(t) < 1000] + ["so many words " * 200, "", None]
    rows = stored(docs(some).select("doc_id", "text", tokencount.segment_trees(F.col("text"), BYTE_BPE_RANKS).alias("x")), "kept")
    state = rows.select("doc_id", "text", F.col("x.n_tokens").alias("n"), F.col("x.tree").alias("tree"))
    for letter in ("o", "a"):
        places = F.transform(F.sequence(F.lit(0), F.length("text")), lambda i: F.when(F.substring("text", i + 1, 1) == letter, i))
        ascii_only = F.octet_length("text") == F.length("text")
        edits = F.transform(F.filter(places, lambda i: i.isNotNull()), lambda i: F.struct(i.alias("start"), F.lit(1).alias("length"), F.lit("0x").alias("replacement")))
        new = state.select("doc_id", tokencount.recounted(F.col("text"), F.col("tree"), F.when(ascii_only, edits), BYTE_BPE_RANKS).alias("x"))
        state = stored(new.select("doc_id", F.col("x.text_after").alias("text"), F.col("x.n_tokens_after").alias("n"), F.col("x.tree_after").alias("tree")), "edited")
    checked = state.withColumn("y", tokencount.segment_trees(F.col("text"), BYTE_BPE_RANKS)).collect()
    assert all(r.n == r.y.n_tokens for r in checked)
    assert any("0x" in (r.text or "") for r in checked)

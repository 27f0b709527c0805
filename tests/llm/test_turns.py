"""Operator 11 against a brute-force search over all edit sequences."""
import hashlib
import random
import re
import zlib

import pytest
from pyspark.sql import functions as F

from verilens.llm import turns

ROWS = "conv_id long, turn long, role string, text string"
BLANKS = " \t\n\x0b\x0c\r"


def damaged(rows):
    """conv -> its rows after damage, ordered."""
    out = {}
    for conv, turn, role, text in rows:
        have = out.setdefault(conv, [])
        role, text = " " if role is None else role, " " if text is None else text
        kind = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        if kind == 0:
            continue
        text = "" if kind == 1 else re.sub("[.!?]", "", text) if kind == 2 else text
        have += [(turn, "user" if kind == 4 else role, text)] * (2 if kind == 3 else 1)
    key = lambda r: (r[0] is not None, r[0] or 0, hashlib.sha256(f"{len(r[1])}:{r[1]}{r[2]}".encode()).digest())
    return {c: sorted(rs, key=key) for c, rs in out.items()}


def faults(rows):
    seen, out = set(), []
    for _, role, text in rows:
        body = text.strip(BLANKS)
        out.append("blank" if not body else "duplicate" if (role, text) in seen else "truncated" if body[-1] not in ".!?" else None)
        seen.add((role, text))
    return out


def cheapest(rows, found):
    """(cost, audit, repaired rows) by a forward search over (row, role pattern), without runs or matrices."""
    best = {(0, ""): (0, "", ())}  # state: the pattern's end ("" none, s, u, a)
    follow = {"": "u", "s": "u", "u": "a", "a": "u"}
    name = {"u": "user", "a": "assistant"}

    def put(table, state, value):
        if state not in table or value[:2] < table[state][:2]:
            table[state] = value

    states = {"": (0, "", ())}
    for (_, role, text), fault in [*zip(rows, found, strict=True), ((None, None, None), "end")]:
        for _ in range(3):
            for q, (cost, audit, kept) in list(states.items()):
                put(states, follow[q], (cost + 3, audit + "I", (*kept, (name[follow[q]], ""))))
        if fault == "end":
            break
        new = {}
        for q, (cost, audit, kept) in states.items():
            put(new, q, (cost + 4, audit + "D", kept))
            if fault in ("blank", "duplicate"):
                continue
            late = 3 if fault == "truncated" else 0
            if role[:1] == follow[q] or role[:1] == "s" and q == "":
                put(new, role[:1], (cost + late, audit + "K", (*kept, (role, text))))
            put(new, follow[q], (cost + late + 3, audit + "R", (*kept, (name[follow[q]], text))))
        states = new
    del best
    return min(states[q] for q in ("", "a") if q in states)


def expected(rows):
    out = []
    for conv, rs in damaged(rows).items():
        found = faults(rs)
        known = [t for t, _, _ in rs if t is not None]
        gaps = max(known) - min(known) + 1 - len(set(known)) if known else 0
        pairs = [a[1][:1] + b[1][:1] for a, b in zip(rs, rs[1:], strict=False)]
        cost, audit, kept = cheapest(rs, found)
        text = "\n".join(f"{r}:{t}" for r, t in kept)
        out.append((str(conv), gaps, *(found.count(x) for x in ("blank", "duplicate", "truncated")), sum(p not in ("su", "ua", "au") for p in pairs),
                    cost, audit, hashlib.sha256(text.encode()).hexdigest()))
    return sorted(out)


def random_rows(n, seed, convs=40, longest=9):
    rng = random.Random(seed)
    roles = ["user", "assistant", "system", "tool", "user", "assistant", None, "", "ünder"]
    texts = ["yes.", "no?", "so", "ok!", "", " \n", None, "a.b.c", "end. ", "漢。", "x" * 50 + "!"]
    rows = []
    for _ in range(n):
        rows.append((rng.choice([*range(convs), None]), rng.choice([*range(longest), None]), rng.choice(roles[:rng.choice((3, 9))]), rng.choice(texts) if rng.random() < .6 else f"t {rng.random()}."))
    return rows


def result(df):
    return sorted((str(r.conv_id), *r[1:]) for r in df.collect())


@pytest.mark.parametrize(("rows", "chunk"), [(400, 4096), (400, 3), (1, 4096)])
def test_equals_brute_force(spark, monkeypatch, rows, chunk):
    """With long and short chunks; many ranges cut conversations at their borders."""
    rows = random_rows(rows, rows + chunk)
    if chunk < 100:  # workers are forked with the module's own limits, so cut by size here
        rows = [(7 if i % 3 else c, t, r, x) for i, (c, t, r, x) in enumerate(rows)]
    df = spark.createDataFrame(rows, ROWS)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", str(chunk > 100).lower())
    try:
        assert result(turns.repaired_after_damage(df)) == expected(rows)
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")


def test_a_long_conversation_in_many_chunks(spark):
    """Alternating turns with a third of the rows wrong, over several chunks and ranges."""
    rng = random.Random(5)
    rows = [(1, i, rng.choice(["user", "assistant", "user", "assistant", "system"]), f"text {rng.randint(0, 9000)}{rng.choice(['.', '', '!'])}") for i in range(9000)]
    rows += [(2, 5, "user", "same.")] * 3000 + [(3, None, "assistant", None)] * 50 + [(c, 1, "user", "hello.") for c in range(4, 60)]
    got = result(turns.repaired_after_damage(spark.createDataFrame(rows, ROWS)))
    assert got == expected(rows)


def test_runs_equal_single_rows():
    rng = random.Random(3)
    for _ in range(300):
        symbols = [s for _ in range(rng.randint(0, 6)) for s in [rng.randint(0, 8)] * rng.choice((1, 2, 3, 40, 700))]
        runs = []
        for s in symbols:
            if runs and runs[-1][0] == s:
                runs[-1] = (s, runs[-1][1] + 1)
            else:
                runs.append((s, 1))
        one_by_one = turns.AT_END
        for s in reversed(symbols):
            one_by_one = turns.onto(turns.power(s, 0), one_by_one)
        edits, q = turns.choices(tuple((s, 1) for s in symbols), 0, turns.AT_END)
        assert turns.repaired(tuple(runs)) == (one_by_one[0], edits + turns.closing(q))


def test_clashing_columns_and_an_empty_table(spark):
    rows = random_rows(30, 9)
    df = spark.createDataFrame(rows, ROWS).withColumns({c: F.lit(1) for c in ("n", "mark", "digest", "part", "cost", "conv", "kind")})
    assert result(turns.repaired_after_damage(df)) == expected(rows)
    assert turns.repaired_after_damage(df.limit(0)).count() == 0

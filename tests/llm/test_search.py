"""Operators 1, 7 and 10 against brute force."""
import random
import re

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from verilens.llm import embeddings, simhash, templates
from verilens.llm.components import components


def roots(pairs, nodes):
    parent = {n: n for n in nodes}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x
    for a, b in pairs:
        a, b = find(a), find(b)
        parent[max(a, b)] = min(a, b)
    return {n: find(n) for n in nodes}


def plain_fingerprint(text):
    words = re.findall(rb"[^\x20\x09-\x0D]+", re.sub(rb"[A-Z]", lambda m: m[0].lower(), (text or "").encode()))
    shingles = [b" ".join(words[i:i + 3]) for i in range(len(words) - 2)] or ([b" ".join(words)] if words else [])
    h = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def test_components_of_random_edges(spark):
    rng = random.Random(1)
    pairs = [(rng.randint(-60, 60), rng.randint(-60, 60)) for _ in range(70)] + [(k, k + 1) for k in range(1000, 1200)]
    got = {r.node: r.root for r in components(spark.createDataFrame([*pairs, (None, 3)], "a long, b long")).collect()}
    want = roots(pairs, {x for p in pairs if p[0] != p[1] for x in p})
    assert got == want
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_fingerprints_and_components(odd, docs):
    assert simhash.near_duplicates(docs([])).count() == 0
    for rows in (odd, docs(["a b c d e"] * 5 + ["q"] + ["A  b\nC d e", None, ""])):
        got = simhash.near_duplicates(rows).select("doc_id", "fp", "component_id", F.lit(1)).collect()
        assert sorted(str(r.doc_id) + f"{r.fp & (1 << 64) - 1:016x}" for r in got) == sorted(
            str(r.doc_id) + f"{plain_fingerprint(r.text):016x}" for r in rows.select("doc_id", "text").collect())
        prints = {r.fp & (1 << 64) - 1 for r in got}
        group = roots([(a, b) for a in prints for b in prints if (a ^ b).bit_count() <= 2], prints)
        for r in got:
            same = [x.doc_id for x in got if group[x.fp & (1 << 64) - 1] == group[r.fp & (1 << 64) - 1] and x.doc_id is not None]
            assert r.component_id == (min(same) if same else None)


@pytest.mark.parametrize("most_members", [1024, 3])
def test_near_edges_connect_what_brute_force_connects(spark, most_members):
    rng = random.Random(2)
    prints = set()
    for _ in range(25):
        x = rng.getrandbits(64)
        for _ in range(rng.randint(1, 25)):
            prints.add(x)
            for _ in range(rng.randint(1, 3)):
                x ^= 1 << rng.randrange(64)
    signed = lambda x: x - (1 << 64) if x >> 63 else x
    df = spark.createDataFrame([(signed(x),) for x in prints], "fp long")
    edges = [(r.a, r.b) for r in simhash.near_edges(df, most_members=most_members).collect()]
    mask = (1 << 64) - 1
    near = [(signed(a), signed(b)) for a in prints for b in prints if a < b and (a ^ b).bit_count() <= 2]
    nodes = [signed(x) for x in prints]
    # an edge may lead to the root of a task's forest; it never joins different components
    assert roots(edges, nodes) == roots(near, nodes)
    assert all(isinstance(a & mask, int) for a, _ in edges)


@pytest.mark.parametrize("radius", [0, 1, 2, 3])
def test_bit_sliced_pairs(radius):
    rng = np.random.default_rng(3)
    base = rng.integers(0, 2**63, 8).astype(np.uint64)
    members = np.concatenate([b ^ (np.uint64(1) << rng.integers(0, 64, 60).astype(np.uint64)) ^ (np.uint64(1) << rng.integers(0, 64, 60).astype(np.uint64)) for b in base])
    group = np.sort(rng.integers(0, 3, len(members)))
    got = {(a, b) for i, j in simhash.near_pairs(members, group, radius) for a, b in zip(i.tolist(), j.tolist(), strict=True)}
    n = len(members)
    assert got == {(i, j) for i in range(n) for j in range(i + 1, n) if group[i] == group[j] and int(members[i] ^ members[j]).bit_count() <= radius}


def test_embeddings_against_brute_force(spark):
    rng = np.random.default_rng(4)
    rows, k = [], 0
    for label in (0, 1, None):
        for _ in range(40):
            center = rng.normal(size=16)
            for _ in range(rng.integers(1, 8)):
                rows.append((k, (center + rng.normal(size=16) * rng.choice([0.0, 0.05, 0.25])).tolist(), label))
                k += 1
    rows += [(k, None, 0), (k + 1, [0.0] * 16, 0), (k + 2, [float("nan")] * 16, 0), (k + 3, [None] * 16, 0), (k + 4, [], 0), (k + 5, [float("inf")] + [1.0] * 15, 1),
             (k + 6, [1.0, 2.0], 0), (k + 7, [1.0, 2.0], 0), (0, rows[0][1], 0), (None, rows[0][1], 0)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int").withColumns({c: F.lit("x") for c in ("v", "n", "class", "cell", "n_links")})
    unit = []
    for _, v, label in rows:
        ok = label is not None and v and all(x is not None and np.isfinite(x) for x in v) and any(v)
        unit.append(np.array(v) / np.linalg.norm(v) if ok else None)
    m = range(len(rows))
    link = [(i, j) for i in m for j in m if i < j and unit[i] is not None and unit[j] is not None and rows[i][2] == rows[j][2] and len(unit[i]) == len(unit[j]) and unit[i] @ unit[j] >= 0.93]
    group = roots(link, m)
    want = []
    for i in m:
        same = [rows[j][0] for j in m if group[j] == group[i] and rows[j][0] is not None]
        component = min(same) if same else None
        want.append((rows[i][0], sum(i in p for p in link), component, rows[i][0] is not None and rows[i][0] == component))
    key = lambda t: tuple(map(str, t))
    for kind in ({"recall": 1.0, "cell_rows": 1}, {"recall": 1.0, "block": 7, "visitors": 5}, {}):
        got = [tuple(r) for r in embeddings.linked(df, **kind).collect()]
        assert sorted(got, key=key) == sorted(want, key=key), kind
    assert embeddings.linked(df.limit(0)).count() == 0


def test_recall_on_vectors_without_clusters(spark):
    """Recall of the default radius for pairs near the threshold, the hardest to find."""
    rng = np.random.default_rng(5)
    x = rng.normal(size=(6000, 32))
    x /= np.linalg.norm(x, axis=1)[:, None]
    grid = embeddings.fit(x, 8)
    away = rng.normal(size=x.shape)
    away -= (away * x).sum(axis=1)[:, None] * x
    away /= np.linalg.norm(away, axis=1)[:, None]
    y = 0.931 * x + np.sqrt(1 - 0.931 ** 2) * away
    a, b = grid.cells(x), grid.cells(y)
    bound = grid.bound(np.where((a <= b)[:, None], x, y), np.maximum(a, b))
    assert (bound <= grid.stop).mean() > 0.97


ITEMS = ["Maria Lopez bought 12 apples for 3 dollars each and then gave 12 apples to her neighbour Jo Smith on the corner.",
         "the quick brown fox jumps over the lazy dog near the old river bank today", "too short", None, ""]


def contaminated(spark, docs, texts, items=tuple(ITEMS)):
    bench = spark.createDataFrame(list(enumerate(items)), "item_id long, text string").withColumn("h", F.lit(1))
    return sorted((r.doc_id, r.item_id, r.reparameterised) for r in templates.contaminated(docs(texts), bench).collect())


def test_templates_find_copies_and_new_parameters(spark, docs):
    filler = "Plain words that stand around it, nothing else. "
    texts = [filler, filler + ITEMS[0] + " " + filler, ITEMS[1].upper().replace(" ", ",  "),
             filler + ITEMS[0].replace("12", "99").replace("Maria Lopez", "Anna").replace("Jo Smith", "Bo Li").replace("3 dollars", "7 euros") + filler,
             ITEMS[0].replace("gave 12", "gave 13"), None, "", "too short", ITEMS[1], ITEMS[1], "the quick brown fox jumps over the lazy cat"]
    # the two-word item is found where it stands, as short items are
    assert contaminated(spark, docs, texts) == [(1, 0, False), (2, 1, False), (3, 0, True), (7, 2, False), (8, 1, False), (9, 1, False)]
    assert contaminated(spark, docs, []) == []
    assert contaminated(spark, docs, texts, ()) == []


LONG = ("We picked 3 apples from the low tree behind the barn while the other children were still asleep in the warm house above the stables"
        " and much later that day we found 3 pears under the old wall near the gate where nobody had looked for fruit all summer long.")


def test_templates_keep_the_consistent_part_of_a_contradictory_copy(spark, docs):
    texts = [LONG.replace("3 pears", "5 pears"), LONG.replace("3 apples", "5 apples"), LONG.replace("3 apples", "4 apples").replace("3 pears", "5 pears"),
             LONG.replace("3", "4"), "We picked 3 apples from the low tree and found 5 pears under the old wall"]
    assert contaminated(spark, docs, texts, (LONG,)) == [(0, 0, False), (1, 0, False), (2, 0, True), (3, 0, True)]


def test_templates_find_copies_in_another_case_or_line_width(spark, docs):
    named = "Anna met Berta near Carla while Dora and Emma saw Fritz call Gustav or Hans from Ida to Jonas by Karl."
    short = "Where did Maria Lopez live then"
    items = (named, short, LONG)
    texts = [named.lower(), named.upper(), named.title(), named.replace(" ", "\n", 7), "He asked: I wonder where did maria lopez live then", "So Where did Maria Lopez live then",
             LONG.upper(), LONG.replace("3 apples", "4\napples").replace("3", "4"), named.replace("Fritz", "Otto").lower().replace("dora", "x"), "where did maria live then"]
    assert contaminated(spark, docs, texts, items) == [(0, 0, False), (1, 0, False), (2, 0, False), (3, 0, False), (4, 1, False), (5, 1, False), (6, 2, False), (7, 2, True)]


def test_consistent_stretches_of_a_diagonal_match_brute_force():
    rng = random.Random(4)
    for _ in range(2000):
        places = sorted(rng.sample(range(30), rng.randint(1, 25)))
        pairs = [{"place": p, "a": rng.choice("xy"), "b": rng.choice("xyuv")} for p in places if rng.random() < 0.3]
        slot, own = {p["place"]: p for p in pairs}, {p["a"] for p in pairs if p["a"] == p["b"]}

        def fits(part, slot=slot, own=own):
            inside = [slot[p] for p in part if p in slot]
            return (not any(x["a"] in own and x["a"] != x["b"] for x in inside)
                    and len({x["a"] for x in inside}) == len({(x["a"], x["b"]) for x in inside}))

        spans = [(i, j) for i in range(len(places)) for j in range(i, len(places) + 1) if fits(places[i:j])]
        longest = max(j - i for i, j in spans)
        want = [{p for i, j in spans if j - i >= 5 or (i, j) == first for p in places[i:j]} for first in spans if first[1] - first[0] == longest]
        got, changed = templates.kept_places(places, pairs, 5)
        assert set(got) in want and len(set(got)) == len(got)
        assert changed == any(slot[p]["a"] != slot[p]["b"] for p in got if p in slot)


def test_clean_rows_keep_their_columns(spark, odd, docs):
    bench = spark.createDataFrame([(1, ITEMS[1])], "item_id long, text string")
    kept = templates.clean_rows(odd.unionByName(docs([ITEMS[1]]).select("*", *[F.lit(None).cast(t).alias(c) for c, t in odd.dtypes[5:]])), bench)
    assert kept.columns == odd.columns and kept.count() == odd.count()


SHORT = ["Who wrote Hamlet?", "What is 3 + 5?", "How many apples are left?", "12 34 56", "Hamlet", "誰が書いたか", "Is it 5 km, 6 km, 7 km, 8 km, 9 km or 10 km?"]


def test_short_items_are_found_word_for_word(spark, docs):
    items = spark.createDataFrame(list(enumerate(SHORT + ["", None, " .. "])), "item_id long, text string")
    rows = docs([f"Something before. {x} And after it." for x in SHORT] + ["What is 4 + 5? Who wrote hamlets? 12 34 57", "Is it 5 km, 6 km, 7 km, 8 km, 9 km or 11 km?", None, ""])
    got = {(r.doc_id, r.item_id) for r in templates.contaminated(rows, items).collect()}
    own = {(k, k) for k in range(len(SHORT))}
    # the one word "Hamlet" is in the first text too, and 13 words of the last item in another
    assert got == own | {(0, 4), (8, 6)}

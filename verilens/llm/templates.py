"""Benchmark decontamination by templates (operator 1).

A text becomes a template: its words in lower case, with numbers, names (runs
of capitalised words that don't start a sentence) and units (after a number)
replaced by typed placeholders.  As names hang on capitals and line ends, a text
has a second, literal template without names, in which a new line ends no
sentence; a match in either form counts, and the first is reported if both do.
Windows of ``WINDOW`` template words are joined
by equality with those of the benchmark; an item shorter than a window is one
window of its own length.  Matches of one document and item on one diagonal must
fill the slots consistently: one value of the item always stands against one
value of the document.  Of a diagonal that doesn't, the consistent stretches are
kept (``consistent_places``).  A document is contaminated if its consistent matches
cover at least ``COVERED`` words of an item, or the whole of a shorter one; it
is re-parameterised if some slot has another value.

Documents' windows first pass a Bloom filter of the benchmark's windows.  Its
size is bounded by ``MOST_BITS`` whatever the benchmark's size (a fuller filter
only lets more windows through to the join), so it is sent to the tasks; the
windows themselves are joined by a shuffle.

Defined results: null, empty or short texts have no windows and stay clean;
windows with fewer than ``LITERALS`` plain words are no evidence, so an item
without any other can't be matched; equal items are each reported; repeated
document rows are one document (key: doc_id and text); a null doc_id is
reported as null; other columns are ignored; an empty documents or benchmark
table gives no rows.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import arrow_udf

from verilens.llm.textbatch import ALPHA, DIGIT, WORD, Runs, as_strings, flat, mixed, slices, whole_hashes
from verilens.session import stored

WINDOW, LITERALS, COVERED = 8, 4, 13
MOST_BITS = 1 << 24
#: The forms of a text: typed placeholders with and without names; its own words, for items without a window in the others.
NAMED, LITERAL, VERBATIM = range(3)
NUMBER, NAME, UNIT = "<number>", "<name>", "<unit>"
#: Words that are units after a number.
UNITS = frozenset("""mm cm m km inch inches foot feet ft yard yards mile miles mg g kg lb lbs pound pounds ounce ounces oz ton tons tonnes ml l liter
    liters litre litres gallon gallons second seconds sec s minute minutes min hour hours hr h day days week weeks month months year years dollar dollars
    usd euro euros eur cent cents percent degrees degree celsius fahrenheit mph kmh km2 m2 m3 w kw kwh v volt volts watt watts hz khz mhz ghz kb mb gb tb
    meter meters metre metres kilometer kilometers kilogram kilograms gram grams""".split())

_END, _POINT = np.zeros(256, bool), np.zeros(256, bool)
_END[[*b".!?:;\n"]] = True
_STOP = _END.copy()  # of the literal template
_STOP[0x0A] = False
_POINT[[*b".,"]] = True

WINDOWS = "array<struct<form:int,h:long,template:string,pos:int,n:int,slots:array<string>>>"


class _Words:
    """The words of a batch, and for each distinct one its hash and kind."""

    def __init__(self, texts: pa.Array):
        self.raw, off = flat(texts)
        raw = self.raw
        kept, digit = WORD[raw], DIGIT[raw]
        kept[1:-1] |= _POINT[raw[1:-1]] & digit[:-2] & digit[2:]
        cuts = np.zeros(len(raw), bool)
        cuts[1:] = (ALPHA[raw[:-1]] & digit[1:]) | (digit[:-1] & ALPHA[raw[1:]])
        runs = Runs(raw, off, kept, cuts)
        words = runs.distinct.cast(pa.string(), safe=False) if len(runs.distinct) else pa.array([], pa.string())
        lower = pa.compute.utf8_lower(words)
        braw, boff = flat(runs.distinct)
        head = braw[boff[:-1]] if len(braw) else np.zeros(0, np.uint8)
        second = braw[np.minimum(boff[:-1] + 1, len(braw) - 1)] if len(braw) else head
        capital = ((head >= 0x41) & (head <= 0x5A)) | ((head == 0xC3) & (second >= 0x80) & (second <= 0x9E))
        capital &= pa.compute.match_substring_regex(words, r"^.\PL*\p{Ll}").to_numpy(zero_copy_only=False)
        self.runs, self.capital, self.number = runs, capital, DIGIT[head]
        self.unit = pa.compute.is_in(lower, value_set=pa.array(sorted(UNITS))).to_numpy(zero_copy_only=False)
        self.hashes = whole_hashes(*flat(lower))


class _Template:
    """The template words of a batch: ``values`` (hash of each), ``slot`` (0 plain,
    1 number, 2 name, 3 unit), ``off`` (by text), and where their bytes lie."""

    def __init__(self, words: _Words, form: int):
        self.raw, self.form, runs = words.raw, form, words.runs
        literal = form != NAMED
        code, starts, ends = runs.codes, runs.starts, runs.ends
        n = len(code)
        begins = np.zeros(n, bool)
        begins[runs.off[:-1][runs.off[:-1] < n]] = True
        # a point between digits is part of the number and ends no sentence
        ended = np.concatenate([[0], np.cumsum((_STOP if literal else _END)[self.raw])])
        fresh = begins.copy()
        fresh[1:] |= ended[starts[1:]] > ended[ends[:-1]]
        is_number = words.number[code] & (form != VERBATIM)
        is_name = np.zeros(n, bool) if literal else words.capital[code] & ~fresh
        is_unit = np.zeros(n, bool)
        is_unit[1:] = words.unit[code[1:]] & is_number[:-1] & ~fresh[1:]
        is_name &= ~is_unit
        go_on = np.zeros(n, bool)  # further words of one name
        go_on[1:] = is_name[1:] & is_name[:-1]
        kept = ~go_on
        self.starts = starts[kept]
        following = np.flatnonzero(kept)
        last = np.append(following[1:], n) - 1
        # a name reaches to the last of its words
        self.ends = np.where(is_name[following], ends[last], ends[following]) if n else ends
        self.slot = (is_number * 1 + is_name * 2 + is_unit * 3)[kept]
        self.off = np.concatenate([[0], np.cumsum(kept)])[runs.off]
        hashes = words.hashes[code[kept]] if n else np.zeros(0, np.uint64)
        marks = mixed(np.arange(1, 5, dtype=np.uint64) << np.uint64(40))
        self.values = np.where(self.slot > 0, marks[self.slot], hashes)

    def windows(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        """(first word, hash) of the windows of n words with enough plain ones."""
        count = len(self.values) - n + 1
        if count < 1:
            return np.zeros(0, np.int64), np.zeros(0, np.uint64)
        h = np.full(count, n + 2 * WINDOW * self.form, np.uint64)
        for k in range(n):
            h = h * np.uint64(0x100000001B3) + self.values[k:k + count]
        plain = np.concatenate([[0], np.cumsum(self.slot == 0)])
        ok = plain[n:] - plain[:-n] >= (min(LITERALS, n) if self.form == VERBATIM else LITERALS)
        end = np.repeat(self.off[1:], np.diff(self.off))[:count]
        ok &= np.arange(count) + n <= end
        at = np.flatnonzero(ok)
        return at, mixed(h[at])

    def row(self, at: int, n: int, h: int, first: int) -> dict:
        words, slots = [], []
        for k in range(at, at + n):
            text = self.raw[self.starts[k]:self.ends[k]].tobytes().decode("utf-8", "replace").lower()
            kind = self.slot[k]
            if kind:
                slots.append(" ".join(text.split()))
            words.append((text, NUMBER, NAME, UNIT)[kind])
        return {"form": self.form, "h": h, "template": " ".join(words), "pos": at - first, "n": n, "slots": slots}


_KIND = pa.list_(pa.struct([("form", pa.int32()), ("h", pa.int64()), ("template", pa.string()), ("pos", pa.int32()), ("n", pa.int32()), ("slots", pa.list_(pa.string()))]))


def item_windows(text: Column) -> Column:
    """struct(n_words, windows) of the forms of each benchmark item, in their order."""
    kind = pa.list_(pa.struct([("n_words", pa.int32()), ("windows", _KIND)]))

    @arrow_udf(f"array<struct<n_words:int,windows:{WINDOWS}>>")
    def found(texts: pa.Array) -> pa.Array:
        rows = []
        for part in slices(as_strings(texts)):
            for one in (part.slice(i, 1) for i in range(len(part))):
                words, forms = _Words(one), []
                for t in (_Template(words, form) for form in (NAMED, LITERAL, VERBATIM)):
                    if t.form == VERBATIM and any(f["windows"] for f in forms):
                        continue
                    n = min(WINDOW, len(t.values))
                    at, h = t.windows(n) if n else ((), ())
                    forms.append({"n_words": len(t.values), "windows": [t.row(a, n, x, 0) for a, x in zip(at, np.asarray(h, np.uint64).view(np.int64).tolist(), strict=True)]})
                rows.append(forms)
        return pa.array(rows, kind)

    return found(text)


def document_windows(text: Column, bits: np.ndarray, lengths: dict[int, list[int]]) -> Column:
    """The windows of each whole text that pass the filter ``bits`` (packed, little-endian)."""

    @arrow_udf(WINDOWS)
    def found(texts: pa.Array) -> pa.Array:
        table = np.unpackbits(bits, bitorder="little").astype(bool)
        mask, out = np.uint64(len(table) - 1), []
        for part in slices(as_strings(texts)):
            words = _Words(part)
            rows: list[list[dict]] = [[] for _ in range(len(part))]
            for form, sizes in lengths.items():
                t = _Template(words, form)
                for n in sizes:
                    at, h = t.windows(n)
                    hit = table[h & mask]
                    hit[hit] = table[(h[hit] >> np.uint64(32)) & mask]
                    doc = np.searchsorted(t.off, at[hit], side="right") - 1
                    for a, x, d in zip(at[hit].tolist(), h[hit].view(np.int64).tolist(), doc.tolist(), strict=True):
                        rows[d].append(t.row(a, n, x, int(t.off[d])))
            out.append(pa.array(rows, _KIND))
        return pa.concat_arrays(out) if out else pa.array([], _KIND)

    return found(text)


_PAIR = "array<struct<place:int,a:string,b:string>>"


def kept_places(places: list[int], pairs: list[dict], enough: int) -> tuple[list[int], bool]:
    """The places of a contradictory diagonal that count, and whether a slot there has another value.

    These are its longest consistent stretch of places and any other of at least ``enough``.
    A changed value contradicts everywhere if the item's own stands elsewhere on the diagonal."""
    same = {p["a"] for p in pairs if p["a"] == p["b"]}
    slots = {p["place"]: (p["a"], p["b"]) for p in pairs}
    found, first, seen = [], 0, {}  # seen: last index of each (value, document's value)
    others: dict[str, tuple[str, int]] = {}  # value -> its last document's value, last index of any before that
    for k, place in enumerate(places):
        if place not in slots:
            continue
        a, b = slots[place]
        if a in same and a != b:
            found.append((first, k))
            first = k + 1
            continue
        last, before = others.get(a, (b, -1))
        if last != b:
            before = seen[a, last]
        if before >= first:
            found.append((first, k))
            first = before + 1
        others[a], seen[a, b] = (b, before), k
    found.append((first, len(places)))
    longest = max(found, key=lambda x: x[1] - x[0])
    kept = sorted({place for x in found if x == longest or x[1] - x[0] >= enough for place in places[x[0]:x[1]]})
    return kept, any(slots[p][0] != slots[p][1] for p in kept if p in slots)


def consistent_places(places: Column, pairs: Column, enough: Column) -> Column:
    """struct(places, changed) by ``kept_places``; null where ``places`` is null."""
    kind = pa.struct([("places", pa.list_(pa.int32())), ("changed", pa.bool_())])

    @arrow_udf("places array<int>, changed boolean")
    def found(places: pa.Array, pairs: pa.Array, enough: pa.Array) -> pa.Array:
        rows = [None if x is None else dict(zip(("places", "changed"), kept_places(x, y, n), strict=True))
                for x, y, n in zip(places.to_pylist(), pairs.to_pylist(), enough.to_pylist(), strict=True)]
        return pa.array(rows, kind)

    return found(places, pairs.cast(_PAIR), enough)


def document_key(id_col: Column, text: Column) -> list[Column]:
    """Two hashes that name a document row, never null; equal for repeated rows only."""
    return [F.xxhash64(id_col, text).alias("k1"), F.xxhash64(text, F.lit("key"), id_col).alias("k2")]


def contaminated(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                 item_col: str = "item_id", item_text_col: str = "text", covered: int = COVERED) -> DataFrame:
    """k1, k2, doc_id, item_id, n_item_words, n_covered, reparameterised: one row for
    each document and each benchmark item that it contains."""
    spark = docs.sparkSession
    items = benchmark.select(F.col(item_col).alias("item_id"), item_windows(F.col(item_text_col)).alias("forms")).select(
        "item_id", F.col("forms")[0]["n_words"].alias("n_named"), F.explode("forms").alias("x")).select(
        "item_id", "n_named", "x.n_words", F.explode("x.windows").alias("w")).select(
        "item_id", "n_named", F.col("n_words").alias("n_item_words"), F.col("w.form").alias("form"), F.col("w.h").alias("h"), F.col("w.template").alias("template"),
        F.col("w.pos").alias("item_pos"), F.col("w.n").alias("n"), F.col("w.slots").alias("item_slots"))
    items = stored(items, "item-windows")
    sizes = items.groupBy("form", "n").agg(F.approx_count_distinct("h").alias("windows")).collect()  # WINDOW rows for each form at most
    windows = sum(r["windows"] for r in sizes)
    lengths = {form: sorted(r["n"] for r in sizes if r["form"] == form) for form in (NAMED, LITERAL, VERBATIM)}
    size = min(MOST_BITS, max(1 << 16, 1 << (32 * max(1, windows) - 1).bit_length()))
    places = F.array(F.col("h").bitwiseAND(F.lit(size - 1)), F.shiftrightunsigned("h", 32).bitwiseAND(F.lit(size - 1)))
    words = (items.select(F.explode(places).alias("p")).groupBy(F.shiftright("p", 6).alias("word"))
             .agg(F.bit_or(F.expr("shiftleft(1L, cast(p & 63 as int))")).alias("bits")).collect())  # size / 64 rows at most
    bits = np.zeros(size // 64, np.uint64)
    for r in words:
        bits[r["word"]] = np.uint64(r["bits"] & 0xFFFFFFFFFFFFFFFF)
    keys = document_key(F.col(id_col), F.col(text_col))
    found = docs.select(F.col(id_col).alias("doc_id"), *keys, document_windows(F.col(text_col), bits.view(np.uint8), lengths).alias("windows"))
    found = stored(found.where(F.size("windows") > 0), "candidate-windows").select("doc_id", "k1", "k2", F.explode("windows").alias("w"))
    found = found.select("doc_id", "k1", "k2", F.col("w.form").alias("form"), F.col("w.template").alias("template"), F.col("w.pos").alias("pos"), F.col("w.slots").alias("slots")).distinct()
    at = F.filter(F.transform(F.split("template", " "), lambda w, k: F.when(w.isin(NUMBER, NAME, UNIT), F.col("item_pos") + k)), lambda k: k.isNotNull())
    pairs = F.arrays_zip(at.alias("place"), F.col("item_slots").alias("a"), F.col("slots").alias("b"))
    matches = found.join(items, ["form", "template"]).select(
        "doc_id", "k1", "k2", "item_id", "n_named", "form", "n_item_words", (F.col("pos") - F.col("item_pos")).alias("diagonal"),
        F.sequence("item_pos", F.col("item_pos") + F.col("n") - 1).alias("places"), pairs.cast(_PAIR).alias("pairs"))
    document = ["doc_id", "k1", "k2", "item_id", "n_named"]
    form = ["form", "n_item_words"]
    by_diagonal = matches.groupBy(*document, *form, "diagonal").agg(
        F.sort_array(F.array_distinct(F.flatten(F.collect_list("places")))).alias("places"),
        F.array_distinct(F.flatten(F.collect_list("pairs"))).alias("pairs"))
    enough = F.least(F.lit(covered), F.col("n_item_words"))
    values = F.array_distinct(F.transform("pairs", lambda p: p["a"]))
    filled = F.array_distinct(F.transform("pairs", lambda p: F.struct(p["a"], p["b"])))
    split = F.size(values) < F.size(filled)
    by_diagonal = by_diagonal.withColumn("kept", consistent_places(F.when(split, F.col("places")), F.when(split, F.col("pairs")), enough))
    changed = F.exists("pairs", lambda p: p["a"] != p["b"])
    consistent = by_diagonal.select(*document, *form, F.coalesce("kept.places", "places").alias("places"), F.coalesce("kept.changed", changed).alias("changed"))

    def covering(number: int) -> Column:
        """struct(n_item_words, n_covered, reparameterised) of the rows of one form."""
        own = F.col("form") == number
        return F.struct(F.max(F.when(own, F.col("n_item_words"))).alias("n_item_words"),
                        F.size(F.array_distinct(F.flatten(F.collect_set(F.when(own, F.col("places")))))).alias("n_covered"),
                        F.max(F.when(own, F.col("changed"))).alias("reparameterised"))

    def contained(x: str) -> Column:
        return F.col(f"{x}.n_covered") >= F.least(F.lit(covered), F.col(f"{x}.n_item_words"))

    by_form = consistent.groupBy(*document).agg(covering(NAMED).alias("named"), covering(LITERAL).alias("literal"), covering(VERBATIM).alias("verbatim"))
    return (by_form.withColumn("x", F.when(contained("named"), F.col("named")).when(contained("literal"), F.col("literal")).when(contained("verbatim"), F.col("verbatim")))
            .where(F.col("x").isNotNull()).select("k1", "k2", "doc_id", "item_id", "x.n_item_words", "x.n_covered", "x.reparameterised"))


def clean_rows(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that contain no benchmark item, with all their columns."""
    keys = stored(contaminated(docs, benchmark, id_col, text_col).select("k1", "k2").distinct(), "contaminated")
    k1, k2 = ("_".join([k, *docs.columns]) for k in ("k1", "k2"))  # names that no column has
    own = document_key(F.col(f"`{id_col}`"), F.col(f"`{text_col}`"))
    rows = docs.withColumns({k1: own[0], k2: own[1]})
    return rows.join(keys, (F.col(f"`{k1}`") == keys["k1"]) & (F.col(f"`{k2}`") == keys["k2"]), "left_anti").drop(k1, k2)

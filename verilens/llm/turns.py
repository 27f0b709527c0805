"""Conversation structure repair by a run-length DP (operator 11).

Each row of a conversation is a symbol: the class of its role's initial and its
fault.  Equal neighbours are one run.  A symbol is a 4 x 4 min-plus transition
between the states of ``(s?(ua)+)?`` (nothing yet, after s, after u, after a);
a run advances by the cached binary powers of its transition.  The cheapest
edits are then unrolled block by block, each block's choices cached by its
power, state and the costs behind it.

Rows are counted by (conversation, turn, role, text), sorted by ranges of
(conversation, turn, digest) and folded in the order of the sort.  A conversation
inside one range is finished there.  One that reaches over the end of a range,
or is longer than a chunk, leaves chunks with one transition each: a pass from
its last chunk to its first carries four costs, and a pass forward unrolls the
choices and feeds the hash.  Both hold one chunk at a time.  (SHA-256 is
sequential: the kept text of one conversation passes through one task, as chunks.)

Edits and costs: Keep 0, Rerole 3, Delete 4, Insert 3; truncated rows that stay
3 more.  Blank and duplicate rows must go.

Defined results: nulls of any column count as one space in the damage's key, as
role and as text; the null conv_id is a conversation; null turns come first;
rows of one turn are ordered by the SHA-256 of role and text; equal rows follow each
other.  An empty role has no initial: it is kept by no edit.  A conversation
without rows has no faults, no edits and the hash of the empty string.  Other
columns are ignored.  An empty table gives no rows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import lru_cache
from itertools import groupby

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from verilens.session import stored

# -- the DP -------------------------------------------------------------------

NEVER = 1 << 60
#: Classes of initials, then states: nothing yet, after s, after u, after a.
S, U, A, OTHER = range(4)
NEXT = (2, 2, 3, 2)  # the state after the role that must follow
KEPT = {(0, S): 1, (0, U): 2, (1, U): 2, (2, A): 3, (3, U): 2}
LEGAL = {(S, U), (U, A), (A, U)}
#: Symbols: a class, the class of a truncated row (+ 4), a row that must go.
TRUNCATED, GONE = 4, 8
REROLE, DELETE, INSERT, LATE = 3, 4, 3, 3
ACCEPTED = (0, NEVER, NEVER, 0)
ROLE = {2: "user", 3: "assistant"}
#: Blocks of up to 2 ** this many rows keep their choices.
CACHED_POWER = 8

Vector = tuple[int, int, int, int]
Matrix = tuple[Vector, Vector, Vector, Vector]


def times(a: Matrix, b: Matrix) -> Matrix:
    return tuple(tuple(min(NEVER, *(a[i][k] + b[k][j] for k in range(4))) for j in range(4)) for i in range(4))


def onto(a: Matrix, v: Vector) -> Vector:
    """The costs before a stretch from the costs behind it."""
    return tuple(min(NEVER, *(a[i][k] + v[k] for k in range(4))) for i in range(4))


def _inserting() -> Matrix:
    rows = []
    for q in range(4):
        row = [NEVER] * 4
        row[NEXT[NEXT[q]]] = 2 * INSERT
        row[NEXT[q]] = INSERT
        row[q] = 0
        rows.append(tuple(row))
    return tuple(rows)


INSERTING = _inserting()
AT_END = onto(INSERTING, ACCEPTED)
IDENTITY: Matrix = tuple(tuple(0 if i == j else NEVER for j in range(4)) for i in range(4))


@lru_cache(maxsize=4096)
def power(symbol: int, k: int) -> Matrix:
    """The transition of 2 ** k rows of one symbol."""
    if k:
        half = power(symbol, k - 1)
        return times(half, half)
    rows = []
    for q in range(4):
        row = [NEVER] * 4
        row[q] = DELETE
        if symbol != GONE:
            late = LATE if symbol >= TRUNCATED else 0
            row[NEXT[q]] = min(row[NEXT[q]], REROLE + late)
            kept = KEPT.get((q, symbol % TRUNCATED))
            if kept is not None:
                row[kept] = min(row[kept], late)
        rows.append(tuple(row))
    return times(INSERTING, tuple(rows))


def powers_of(n: int) -> list[int]:
    return [k for k in range(n.bit_length()) if n >> k & 1]


def run_before(symbol: int, n: int, behind: Vector) -> Vector:
    for k in powers_of(n):
        behind = onto(power(symbol, k), behind)
    return behind


def transition(runs: tuple[tuple[int, int], ...]) -> Matrix:
    out = IDENTITY
    for symbol, n in runs:
        for k in powers_of(n):
            out = times(out, power(symbol, k))
    return out


def _level(v: Vector) -> Vector:
    low = min(v)
    return tuple(x - low if x < NEVER else NEVER for x in v)


def _row(symbol: int, q: int, behind: Vector) -> tuple[str, int]:
    """The least choices for one row from state q: edits up to and with the row, state after."""
    here, late, out = onto(power(symbol, 0), behind), LATE if symbol >= TRUNCATED else 0, ""
    while True:
        if DELETE + behind[q] == here[q]:
            return out + "D", q
        if INSERT + here[NEXT[q]] == here[q]:
            out, q = out + "I", NEXT[q]
            continue
        kept = KEPT.get((q, symbol % TRUNCATED))
        if kept is not None and late + behind[kept] == here[q]:
            return out + "K", kept
        return out + "R", NEXT[q]


@lru_cache(maxsize=1 << 15)
def _cached_block(symbol: int, k: int, q: int, behind: Vector) -> tuple[str, int]:
    if not k:
        return _row(symbol, q, behind)
    first, q = _cached_block(symbol, k - 1, q, _level(onto(power(symbol, k - 1), behind)))
    second, q = _cached_block(symbol, k - 1, q, behind)
    return first + second, q


def _block(symbol: int, k: int, q: int, behind: Vector, out: list[str]) -> int:
    """Append the least choices of 2 ** k rows; the state after them."""
    if k <= CACHED_POWER:
        edits, q = _cached_block(symbol, k, q, _level(behind))
        out.append(edits)
        return q
    q = _block(symbol, k - 1, q, onto(power(symbol, k - 1), behind), out)
    return _block(symbol, k - 1, q, behind, out)


def choices(runs: tuple[tuple[int, int], ...], q: int, behind: Vector) -> tuple[str, int]:
    """The least of the cheapest edits of a stretch that starts in state q, and the state after it."""
    blocks = [(symbol, k) for symbol, n in runs for k in powers_of(n)]
    costs = [behind]
    for symbol, k in reversed(blocks[1:]):
        costs.append(onto(power(symbol, k), costs[-1]))
    out: list[str] = []
    for (symbol, k), after in zip(blocks, reversed(costs), strict=False):
        q = _block(symbol, k, q, after, out)
    return "".join(out), q


def closing(q: int) -> str:
    """The inserts after the last row."""
    out = ""
    while ACCEPTED[q]:
        out, q = out + "I", NEXT[q]
    return out


@lru_cache(maxsize=1 << 15)
def repaired(runs: tuple[tuple[int, int], ...]) -> tuple[int, str]:
    """(cost, audit) of a whole conversation."""
    cost = onto(transition(runs), AT_END)[0]
    edits, q = choices(runs, 0, AT_END)
    return cost, edits + closing(q)


def lines(rows: Iterator[tuple[str, str, int, int]], edits: str, q: int) -> Iterator[str]:
    """``role:text`` of each row that the edits leave, from state q; rows are (role, text, class, copies)."""
    copies = ((role, text, kind) for role, text, kind, n in rows for _ in range(n))
    for edit in edits:
        if edit == "I":
            q = NEXT[q]
            yield ROLE[q] + ":"
            continue
        role, text, kind = next(copies)
        if edit == "K":
            q = KEPT[q, kind]
            yield f"{role}:{text}"
        elif edit == "R":
            q = NEXT[q]
            yield f"{ROLE[q]}:{text}"


# -- rows, chunks, conversations ----------------------------------------------

#: Distinct rows, and characters of text, at which a chunk is closed.
CHUNK_ROWS, CHUNK_CHARS = 4096, 1 << 20
SPACES = " \t\n\x0b\x0c\r"
OUT = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256")
_ROW = "struct<role:string,text:string,kind:int,n:long>"
CHUNK = ("conv_id long, part int, seq int, whole boolean, blank long, duplicate long, truncated long, illegal long, "
         f"first int, last int, low long, high long, turns long, runs array<struct<symbol:int,n:long>>, transition array<long>, rows array<{_ROW}>, "
         "cost long, audit string, repaired_sha256 string")
_ROWS = pa.list_(pa.struct([("role", pa.string()), ("text", pa.string()), ("kind", pa.int32()), ("n", pa.int64())]))
_CHUNK = pa.schema([
    ("conv_id", pa.int64()), ("part", pa.int32()), ("seq", pa.int32()), ("whole", pa.bool_()), *((x, pa.int64()) for x in ("blank", "duplicate", "truncated", "illegal")),
    ("first", pa.int32()), ("last", pa.int32()), ("low", pa.int64()), ("high", pa.int64()), ("turns", pa.int64()),
    ("runs", pa.list_(pa.struct([("symbol", pa.int32()), ("n", pa.int64())]))), ("transition", pa.list_(pa.int64())), ("rows", _ROWS),
    ("cost", pa.int64()), ("audit", pa.string()), ("repaired_sha256", pa.string())])


def _text_or_space(c: Column) -> Column:
    return F.coalesce(c.cast("string"), F.lit(" "))


def damaged(rows: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """(conv_id, turn, role, text, n copies) of the rows after the planted damage."""
    kind = F.crc32(F.concat(_text_or_space(F.col(conv)), F.lit(":"), _text_or_space(F.col(turn)))) % 20
    body = _text_or_space(F.col(text))
    return rows.select(F.col(conv).cast("long").alias("conv_id"), F.col(turn).cast("long").alias("turn"),
                       F.when(kind == 4, F.lit("user")).otherwise(_text_or_space(F.col(role))).alias("role"),
                       F.when(kind == 1, F.lit("")).when(kind == 2, F.translate(body, ".!?", "")).otherwise(body).alias("text"),
                       kind.alias("kind")).where(F.col("kind") != 0).select(
        "conv_id", "turn", "role", "text", F.when(F.col("kind") == 3, 2).otherwise(1).cast("long").alias("n"))


class _Chunk:
    """Distinct rows of one conversation, in order."""

    def __init__(self, conv_id: int | None):
        self.conv_id, self.rows, self.chars = conv_id, [], 0

    def add(self, turn, role, text, kind, fault, n, first) -> None:
        self.rows.append((turn, role, text, kind, fault, n, first))
        self.chars += len(text)

    @property
    def full(self) -> bool:
        return len(self.rows) >= CHUNK_ROWS or self.chars >= CHUNK_CHARS

    def row(self, part: int, seq: int, whole: bool) -> dict:
        blank = duplicate = truncated = illegal = turns = 0
        last, low, high = None, None, None
        symbols: list[tuple[int, int]] = []
        for turn, _, _, kind, fault, n, first in self.rows:
            illegal += n - 1 + (last is not None and (last, kind) not in LEGAL)
            last = kind
            if turn is not None:
                turns += turn != high
                low, high = turn if low is None else low, turn
            if fault == GONE:
                blank += n
                symbols.append((GONE, n))
                continue
            if first:
                truncated += fault == TRUNCATED
                symbols.append((kind + fault, 1))
            rest = n - first
            duplicate += rest
            if rest:
                symbols.append((GONE, rest))
        runs = tuple((symbol, sum(n for _, n in same)) for symbol, same in groupby(symbols, lambda x: x[0]))
        out = {"conv_id": self.conv_id, "part": part, "seq": seq, "whole": whole, "blank": blank, "duplicate": duplicate, "truncated": truncated,
               "illegal": illegal, "first": self.rows[0][3] if self.rows else None, "last": last, "low": low, "high": high, "turns": turns}
        texts = ((role, text, kind, n) for _, role, text, kind, _, n, _ in self.rows)
        if whole:
            cost, audit = repaired(runs)
            body = "\n".join(lines(texts, audit, 0)).encode()
            return out | {"cost": cost, "audit": audit, "repaired_sha256": hashlib.sha256(body).hexdigest()}
        return out | {"runs": [{"symbol": s, "n": n} for s, n in runs], "transition": [x for row in transition(runs) for x in row],
                      "rows": [{"role": r, "text": t, "kind": k, "n": n} for r, t, k, n in texts]}


def _out(rows: list[dict], schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_pylist(rows, schema=schema)


def _folded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sorted rows of one range to chunks; the first and last conversation may go on in another range."""
    part = TaskContext.get().partitionId()
    chunk, seq, first_conv, marked, done = None, 0, True, None, []
    for batch in batches:
        columns = (batch.column(c).to_pylist() for c in ("conv_id", "turn", "digest", "mark", "role", "text", "class", "fault", "n"))
        for conv_id, turn, digest, mark, role, text, kind, fault, n in zip(*columns, strict=True):
            if chunk is None or conv_id != chunk.conv_id:
                if chunk is not None:
                    done.append(chunk.row(part, seq, not first_conv and not seq))
                    first_conv = False
                chunk, seq, marked = _Chunk(conv_id), 0, None
            if mark == 1:
                marked = (turn, digest)
            elif mark == 2:
                if chunk.full:
                    done.append(chunk.row(part, seq, False))
                    chunk, seq = _Chunk(conv_id), seq + 1
                chunk.add(turn, role, text, kind, fault, n, marked == (turn, digest))
            if len(done) >= 256:
                yield _out(done, _CHUNK)
                done = []
    if chunk is not None:
        done.append(chunk.row(part, seq, False))
    if done:
        yield _out(done, _CHUNK)


def _costs_behind(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Chunks of a conversation from its last to its first: the costs behind and before each."""
    conv_id, behind, started = None, AT_END, False
    for batch in batches:
        found, before = [], []
        for c, flat in zip(batch.column("conv_id").to_pylist(), batch.column("transition").to_pylist(), strict=True):
            if not started or c != conv_id:
                conv_id, behind, started = c, AT_END, True
            found.append(behind)
            behind = onto(tuple(tuple(flat[4 * i:4 * i + 4]) for i in range(4)), behind)
            before.append(behind[0])
        yield pa.RecordBatch.from_arrays([batch.column("conv_id"), batch.column("part"), batch.column("seq"), pa.array(found, pa.list_(pa.int64())),
                                          pa.array(before, pa.int64())], names=["conv_id", "part", "seq", "behind", "before"])


_RESULT = pa.schema([("conv_id", pa.int64()), *((x, pa.int64()) for x in OUT[:6]), ("audit", pa.string()), ("repaired_sha256", pa.string())])
RESULT = "conv_id long, " + ", ".join(f"{x} long" for x in OUT[:6]) + ", audit string, repaired_sha256 string"


class _Conversation:
    """A conversation that is put together from its chunks, first to last."""

    def __init__(self, conv_id: int | None, cost: int):
        self.conv_id, self.cost, self.state, self.audit, self.hash, self.any = conv_id, cost, 0, [], hashlib.sha256(), False
        self.sums = dict.fromkeys(("blank", "duplicate", "truncated", "illegal", "turns"), 0)
        self.last = self.low = self.high = None

    def write(self, texts: Iterator[str]) -> None:
        for line in texts:
            self.hash.update(("\n" + line if self.any else line).encode())
            self.any = True

    def add(self, row: dict) -> None:
        for k in self.sums:
            self.sums[k] += row[k]
        if self.last is not None and row["first"] is not None:
            self.sums["illegal"] += (self.last, row["first"]) not in LEGAL
        self.last = self.last if row["last"] is None else row["last"]
        if row["low"] is not None:
            self.sums["turns"] -= row["low"] == self.high
            self.low, self.high = row["low"] if self.low is None else self.low, row["high"]
        edits, state = choices(tuple((x["symbol"], x["n"]) for x in row["runs"]), self.state, tuple(row["behind"]))
        self.write(lines(((x["role"], x["text"], x["kind"], x["n"]) for x in row["rows"]), edits, self.state))
        self.audit.append(edits)
        self.state = state

    def row(self) -> dict:
        rest = closing(self.state)
        self.write(lines(iter(()), rest, self.state))
        gaps = 0 if self.low is None else self.high - self.low + 1 - self.sums["turns"]
        return {"conv_id": self.conv_id, "gaps": gaps, **{k: self.sums[k] for k in OUT[1:5]}, "cost": self.cost,
                "audit": "".join(self.audit) + rest, "repaired_sha256": self.hash.hexdigest()}


def _put_together(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    now, done = None, []
    for batch in batches:
        for k in range(batch.num_rows):  # one chunk's rows at a time
            row = batch.slice(k, 1).to_pylist()[0]
            if now is None or row["conv_id"] != now.conv_id:
                if now is not None:
                    done.append(now.row())
                now = _Conversation(row["conv_id"], row["before"])
            now.add(row)
        if done:
            yield _out(done, _RESULT)
            done = []
    if now is not None:
        yield _out([now.row()], _RESULT)


def repairs(rows: DataFrame, every: DataFrame) -> DataFrame:
    """Faults and repair of each conversation of ``every`` (conv_id), from its rows
    (conv_id, turn, role, text, n copies): conv_id, gaps, blank, duplicate, truncated,
    illegal, cost, audit, repaired_sha256."""
    name = F.concat(F.length("role").cast("string"), F.lit(":"), F.col("role"), F.col("text"))
    tail = F.rtrim(F.col("text"), F.lit(SPACES))
    initial = F.substring("role", 1, 1)
    rows = rows.groupBy("conv_id", "turn", "role", "text").agg(F.sum("n").alias("n"))
    rows = rows.select(
        "conv_id", "turn", F.unhex(F.sha2(name, 256)).alias("digest"), F.lit(2).alias("mark"), "role", "text",
        F.when(initial == "s", S).when(initial == "u", U).when(initial == "a", A).otherwise(OTHER).alias("class"),
        F.when(tail == "", GONE).when(F.substring(tail, -1, 1).isin(".", "!", "?"), 0).otherwise(TRUNCATED).alias("fault"), "n")
    # where each role and text comes first in its conversation: one row each, however many follow
    firsts = rows.where(F.col("fault") != GONE).groupBy("conv_id", "digest").agg(
        F.when(F.count("turn") < F.count("*"), F.lit(None)).otherwise(F.min("turn")).alias("turn"))
    marks = firsts.select("conv_id", "turn", "digest", F.lit(1).alias("mark")).unionByName(
        every.select("conv_id").distinct().select("conv_id", F.lit(None).cast("long").alias("turn"), F.lit(None).cast("binary").alias("digest"), F.lit(0).alias("mark")))
    dealt = rows.unionByName(marks, allowMissingColumns=True).repartitionByRange("conv_id", "turn", "digest").sortWithinPartitions("conv_id", "turn", "digest", "mark")
    chunks = stored(dealt.mapInArrow(_folded, CHUNK), "chunks")
    gaps = F.when(F.col("low").isNull(), F.lit(0).cast("long")).otherwise(F.col("high") - F.col("low") + 1 - F.col("turns")).alias("gaps")
    whole = chunks.where("whole").select("conv_id", gaps, *OUT[1:])
    parts = chunks.where(~F.col("whole")).withColumn("conv", F.xxhash64("conv_id"))
    behind = (parts.select("conv", "conv_id", "part", "seq", "transition").repartition("conv")
              .sortWithinPartitions("conv", "conv_id", F.desc("part"), F.desc("seq"))
              .mapInArrow(_costs_behind, "conv_id long, part int, seq int, behind array<long>, before long"))
    same = parts["conv_id"].eqNullSafe(behind["conv_id"]) & (parts["part"] == behind["part"]) & (parts["seq"] == behind["seq"])
    joined = parts.join(behind, same).select(parts["*"], "behind", "before")
    together = joined.repartition("conv").sortWithinPartitions("conv", "conv_id", "part", "seq").drop("conv").mapInArrow(_put_together, RESULT)
    return whole.unionByName(together)


def repaired_after_damage(conversations: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """``repairs`` of every conversation after the planted damage."""
    every = conversations.select(F.col(conv).cast("long").alias("conv_id"))
    return repairs(damaged(conversations, conv, turn, role, text), every)

"""Repair the turn structure of conversations by cheapest edits.

Roles must follow the pattern system?, (user, assistant)+.  An iterative-deepening search tries the edits of each row depth first
in ASCII order under a cost bound that grows until a path is accepted; a table of failed states keeps how much each of them needs
at least.  The first path found is the cheapest and, of equals, the least in ASCII order.

Rows are sorted over all partitions by conversation and turn, so that a conversation of any length is spread over tasks.  One
that is cut by a partition's border, or longer than a block, is searched block by block for each pair of states that it may begin
and end in; the blocks' answers are then put together.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass, field
from functools import lru_cache

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from martkit.llm.common import cut, small_enough
from martkit.sources.tables import StageArea

# Rows of a block, and bytes of text from which on it takes no further row.
BLOCK, BLOCK_BYTES = 48, 16 << 20
# Repeated turns that may be broadcast; more are shuffled.
BROADCAST_TURNS = 500_000

# Costs of the edits, and of a truncated row that stays.
DELETE, INSERT, REROLE, TRUNCATED = 2, 5, 1, 5
BLANK_BYTES = b" \t\n\x0b\x0c\r"
ENDS = (b".", b"!", b"?")

# States of the pattern: nothing yet, after system, after user, after assistant.
START, SYSTEM, USER, ASSISTANT = range(4)
ACCEPTED = (START, ASSISTANT)
# What a row's role initial leads to; a state that is missing has no such way.
STEP = {"s": {START: SYSTEM}, "u": {START: USER, SYSTEM: USER, ASSISTANT: USER}, "a": {USER: ASSISTANT}}
LEGAL = ("su", "ua", "au")
# The role that a new or changed row takes in each state.
WANTED = {START: "user", SYSTEM: "user", USER: "assistant", ASSISTANT: "user"}
# A row for the search: initial (other letters as a blank), whether it must go, whether it is truncated.
Turn = tuple[str, bool, bool]


def damaged(rows: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """``(conv_id, present, turn, role, text, copies)`` of conversations damaged by a fixed rule, to try a repair on.

    By crc32 of ``conv_id:turn`` modulo 20: 0 drops a row (it stays as a mark that is not present, so that its conversation is known),
    1 empties its text, 2 takes its sentence ends away, 3 repeats it, 4 makes the user say it.  A null counts as one blank.
    """
    t = turns(rows, conv, turn, role, text)
    name = F.concat(F.coalesce(F.col("conv_id").cast("string"), F.lit(" ")), F.lit(":"), F.coalesce(F.col("turn").cast("string"), F.lit(" ")))
    kind = F.col("kind")
    dropped = kind == 0
    t = t.withColumn("kind", (F.crc32(name.cast("binary")) % 20).cast("int"))
    return t.select(
        "conv_id",
        (~dropped).alias("present"),
        F.when(~dropped, F.col("turn")).alias("turn"),
        F.when(dropped, "").when(kind == 4, "user").otherwise(F.col("role")).alias("role"),
        F.when(kind.isin(0, 1), "").when(kind == 2, F.translate("text", ".!?", "")).otherwise(F.col("text")).alias("text"),
        F.when(dropped, 0).when(kind == 3, 2).otherwise(1).cast("long").alias("copies"),
    )


def turns(rows: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """``(conv_id, present, turn, role, text, copies)`` of conversations as they are; a null role or text is one blank."""
    blank = lambda c: F.coalesce(F.col(f"`{c}`").cast("string"), F.lit(" "))
    return rows.select(
        F.col(f"`{conv}`").alias("conv_id"),
        F.lit(True).alias("present"),
        F.col(f"`{turn}`").cast("long").alias("turn"),
        blank(role).alias("role"),
        blank(text).alias("text"),
        F.lit(1).cast("long").alias("copies"),
    )


class _Search:
    """Cheapest edits of a stretch of rows from one state to any of some states."""

    def __init__(self, rows: tuple[Turn, ...], ends: tuple[int, ...], tail: bool):
        self.rows, self.ends, self.tail = rows, ends, tail
        # A row that must go costs a deletion, a truncated one at least that.
        self.least = [0] * (len(rows) + 1)
        for i in range(len(rows) - 1, -1, -1):
            self.least[i] = self.least[i + 1] + (DELETE if rows[i][1] or rows[i][2] else 0)
        self.failed: dict[tuple[int, int], int] = {}
        self.path: list[str] = []

    def run(self, state: int) -> tuple[int, str] | None:
        # Deleting everything and inserting a pair is always as good, where there is a way at all.
        most = DELETE * len(self.rows) + 2 * INSERT
        bound = self.least[0]
        while bound <= most:
            self.path = []
            needed = self._try(0, state, bound)
            if needed is None:
                return bound, "".join(reversed(self.path))
            bound = needed
        return None

    def _try(self, i: int, state: int, budget: int) -> int | None:
        """None if a path within the budget was found, else a cost that every path needs at least."""
        at_end = i == len(self.rows)
        if at_end and state in self.ends:
            return None
        needed = max(self.least[i], self.failed.get((i, state), 0))
        if needed > budget:
            return needed
        best = DELETE * (len(self.rows) - i) + 100 * INSERT  # more than any way costs
        for letter, cost, j, following in self._edits(i, state, at_end):
            if cost > budget:
                below = cost + self.least[j]
            else:
                rest = self._try(j, following, budget - cost)
                if rest is None:
                    self.path.append(letter)
                    return None
                below = cost + rest
            best = min(best, below)
        needed = max(needed, best)
        self.failed[(i, state)] = needed
        return needed

    def _edits(self, i: int, state: int, at_end: bool) -> Iterator[tuple[str, int, int, int]]:
        """In ASCII order of their letters."""
        if not at_end:
            yield "D", DELETE, i + 1, state
        forth = ASSISTANT if WANTED[state] == "assistant" else USER
        if not at_end or self.tail:
            yield "I", INSERT, i, forth
        if not at_end:
            initial, goes, truncated = self.rows[i]
            if not goes:
                extra = TRUNCATED if truncated else 0
                kept = STEP.get(initial, {}).get(state)
                if kept is not None:
                    yield "K", extra, i + 1, kept
                yield "R", REROLE + extra, i + 1, forth


@lru_cache(maxsize=50_000)
def cheapest(rows: tuple[Turn, ...]) -> tuple[int, str]:
    """Cost and edits of a whole conversation."""
    return _Search(rows, ACCEPTED, True).run(START) or (0, "")


@lru_cache(maxsize=5_000)
def moves(rows: tuple[Turn, ...]) -> tuple[tuple[int, int, int, str], ...]:
    """``(from, to, cost, edits)`` of a block; nothing is inserted after its last row, but before the next block's first."""
    if not rows:
        return tuple((s, s, 0, "") for s in range(4))
    found = []
    for s in range(4):
        for t in range(4):
            # Nothing leads back to the start, nor to a system row once one was passed.
            if (t == START and s != START) or (t == SYSTEM and s not in (START, SYSTEM)):
                continue
            way = _Search(rows, (t,), False).run(s)
            if way:
                found.append((s, t, *way))
    return tuple(found)


def put_together(blocks: list[tuple[tuple[int, int, int, str], ...]]) -> tuple[int, str]:
    """Cost and edits of a conversation from the moves of its blocks in order.

    Two ways that lead to different states have different edits, of which neither is the other's beginning, so the order of the
    ways so far decides before the next block's edits do.
    """
    # Per state: cost, place in the order of edits; and where each came from.
    reached = {START: (0, 0)}
    back: list[dict[int, tuple[int, str]]] = []
    for block in blocks:
        best: dict[int, tuple[int, int, str, int]] = {}
        for s, t, cost, edits in block:
            if s in reached:
                way = (reached[s][0] + cost, reached[s][1], edits, s)
                if t not in best or way < best[t]:
                    best[t] = way
        order = sorted(best, key=lambda t: best[t][1:3])
        reached = {t: (best[t][0], place) for place, t in enumerate(order)}
        back.append({t: (way[3], way[2]) for t, way in best.items()})
    closing = {START: "", ASSISTANT: "", USER: "I", SYSTEM: "II"}
    cost, _, tail, state = min((c + INSERT * len(closing[t]), place, closing[t], t) for t, (c, place) in reached.items())
    pieces = [tail]
    for came in reversed(back):
        state, edits = came[state]
        pieces.append(edits)
    return cost, "".join(reversed(pieces))


class Repaired:
    """Applies edits to rows as they come, one at a time."""

    def __init__(self, edits: str):
        self.edits, self.at, self.state = edits, 0, START

    def _insert(self) -> Iterator[tuple[str, bytes]]:
        while self.edits[self.at : self.at + 1] == "I":
            self.at += 1
            yield self._said(WANTED[self.state], b"")

    def _said(self, role: str, text: bytes) -> tuple[str, bytes]:
        self.state = STEP[role[:1]][self.state]
        return role, text

    def row(self, role: str, text: bytes) -> Iterator[tuple[str, bytes]]:
        """What is put before this row, and the row if it stays."""
        yield from self._insert()
        edit = self.edits[self.at]
        self.at += 1
        if edit == "K":
            yield self._said(role, text)
        elif edit == "R":
            yield self._said(WANTED[self.state], text)

    def rest(self) -> Iterator[tuple[str, bytes]]:
        yield from self._insert()


class _Digest:
    """Digest of ``role:text`` lines, fed as they come."""

    def __init__(self):
        self.hash, self.any = hashlib.sha256(), False

    def add(self, lines: Iterator[tuple[str, bytes]]) -> None:
        for role, text in lines:
            self.hash.update((b"\n" if self.any else b"") + role.encode() + b":")
            self.hash.update(text)
            self.any = True


@dataclass
class _Block:
    """Rows of one conversation that follow each other, and what they add up to."""

    conv: object
    rows: list[tuple[str, bytes]] = field(default_factory=list)
    codes: list[Turn] = field(default_factory=list)
    size: int = 0
    blank: int = 0
    duplicate: int = 0
    truncated: int = 0
    illegal: int = 0
    distinct: int = 0
    low: int | None = None
    high: int | None = None

    def add(self, turn: int | None, role: str, text: bytes, first: bool) -> None:
        bare = text.rstrip(BLANK_BYTES)
        blank = not bare
        duplicate = not blank and not first
        truncated = not blank and first and not bare.endswith(ENDS)
        self.blank += blank
        self.duplicate += duplicate
        self.truncated += truncated
        if self.rows:
            self.illegal += self.rows[-1][0][:1] + role[:1] not in LEGAL
        if turn is not None and turn != self.high:
            self.low = turn if self.low is None else self.low
            self.high = turn
            self.distinct += 1
        self.rows.append((role, text))
        self.codes.append((role[:1] if role[:1] in STEP else " ", blank or duplicate, truncated))
        self.size += len(text)

    @property
    def full(self) -> bool:
        return len(self.rows) >= BLOCK or self.size >= BLOCK_BYTES


def _gaps(low: int | None, high: int | None, distinct: int) -> int:
    return 0 if low is None else min(high - low + 1 - distinct, (1 << 63) - 1)


_MOVES = "array<struct<s:int,t:int,cost:long,edits:string>>"
_COUNTS = "gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string, repaired_sha256 string"
DONE, PIECE, ROW = 0, 1, 2


def _blocks(rows: DataFrame) -> DataFrame:
    """Of sorted rows: finished conversations, the blocks of the others, and the others' rows once more.

    The first and the last conversation of a partition may go on in another one.
    """
    conv = rows.schema["conv_id"].dataType.simpleString()
    schema = (
        f"conv_id {conv}, kind int, part int, seq long, no int, {_COUNTS}, low long, high long, n_turns long,"
        f" first_role string, last_role string, moves {_MOVES}, role string, text binary"
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = TaskContext.get().partitionId()
        out: list[dict] = []
        held = 0
        block: _Block | None = None
        seq, whole = 0, False

        def piece(b: _Block) -> Iterator[dict]:
            yield {
                "conv_id": b.conv, "kind": PIECE, "part": part, "seq": seq, "no": 0, "blank": b.blank, "duplicate": b.duplicate, "truncated": b.truncated,
                "illegal": b.illegal, "low": b.low, "high": b.high, "n_turns": b.distinct,
                "first_role": b.rows[0][0][:1] if b.rows else None, "last_role": b.rows[-1][0][:1] if b.rows else None,
                "moves": [dict(zip(("s", "t", "cost", "edits"), m, strict=True)) for m in moves(tuple(b.codes))],
            }
            for k, (role, text) in enumerate(b.rows):
                yield {"conv_id": b.conv, "kind": ROW, "part": part, "seq": seq, "no": k, "role": role, "text": text}

        def done(b: _Block) -> Iterator[dict]:
            cost, audit = cheapest(tuple(b.codes))
            repaired, digest = Repaired(audit), _Digest()
            for role, text in b.rows:
                digest.add(repaired.row(role, text))
            digest.add(repaired.rest())
            yield {
                "conv_id": b.conv, "kind": DONE, "gaps": _gaps(b.low, b.high, b.distinct), "blank": b.blank, "duplicate": b.duplicate,
                "truncated": b.truncated, "illegal": b.illegal, "cost": cost, "audit": audit, "repaired_sha256": digest.hash.hexdigest(),
            }

        for batch in batches:
            for row in zip(*[c.cast(pa.binary()).to_pylist() if n == "text" else c.to_pylist() for n, c in zip(batch.schema.names, batch.columns, strict=True)], strict=True):
                conv_id, present, turn, role, text, copies, first = row
                if block is None or conv_id != block.conv:
                    if block is not None:
                        out += done(block) if whole else piece(block)
                        seq += 1
                    whole = block is not None  # the first one may have begun in another partition
                    block = _Block(conv_id)
                if not present:
                    continue
                for copy in range(copies):
                    if block.full:
                        whole = False
                        held += block.size
                        out += piece(block)
                        seq += 1
                        block = _Block(conv_id)
                    block.add(turn, role, text, first and copy == 0)
                if len(out) >= 4_000 or held > BLOCK_BYTES:
                    yield pa.RecordBatch.from_pylist(out, arrow)
                    out, held = [], 0
        if block is not None:
            out += piece(block)
        if out:
            yield pa.RecordBatch.from_pylist(out, arrow)

    arrow = to_arrow_schema(StructType.fromDDL(schema))
    return rows.select("conv_id", "present", "turn", "role", "text", "copies", "first").mapInArrow(run, schema)


def _finish(parts: DataFrame) -> DataFrame:
    """The conversations that come in blocks: the blocks of each first, then its rows, which are never held together."""
    conv = parts.schema["conv_id"].dataType.simpleString()
    names = ["conv_id", "kind", "blank", "duplicate", "truncated", "illegal", "low", "high", "n_turns", "first_role", "last_role", "moves", "role", "text"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        blocks: list[tuple] = []
        total: dict = {}
        current: tuple | None = None
        repaired, digest = None, None
        done: list[dict] = []

        def begin(conv_id: object) -> None:
            nonlocal blocks, total, current, repaired, digest
            blocks, current, repaired, digest = [], (conv_id,), None, _Digest()
            total = dict.fromkeys(("blank", "duplicate", "truncated", "illegal", "n_turns"), 0) | {"low": None, "high": None, "last_role": None}

        def decide() -> None:
            nonlocal repaired
            total["cost"], total["audit"] = put_together(blocks)
            repaired = Repaired(total["audit"])
            blocks.clear()

        def finish() -> dict:
            if repaired is None:
                decide()
            digest.add(repaired.rest())
            counts = {k: total[k] for k in ("blank", "duplicate", "truncated", "illegal", "cost", "audit")}
            gaps = _gaps(total["low"], total["high"], total["n_turns"])
            return {"conv_id": current[0], "gaps": gaps, **counts, "repaired_sha256": digest.hash.hexdigest()}

        for batch in batches:
            for r in batch.to_pylist():
                if current is None or r["conv_id"] != current[0]:
                    if current is not None:
                        done.append(finish())
                    begin(r["conv_id"])
                if r["kind"] == ROW:
                    if repaired is None:
                        decide()
                    digest.add(repaired.row(r["role"], r["text"]))
                    continue
                blocks.append(tuple((m["s"], m["t"], m["cost"], m["edits"]) for m in r["moves"]))
                for k in ("blank", "duplicate", "truncated", "illegal", "n_turns"):
                    total[k] += r[k]
                if r["first_role"] is not None:
                    if total["last_role"] is not None:
                        total["illegal"] += total["last_role"] + r["first_role"] not in LEGAL
                    total["last_role"] = r["last_role"]
                if r["low"] is not None:
                    # A turn that goes on in the next block was counted twice.
                    total["n_turns"] -= total["high"] == r["low"]
                    total["low"] = r["low"] if total["low"] is None else total["low"]
                    total["high"] = r["high"]
            if len(done) >= 4_000:
                yield pa.RecordBatch.from_pylist(done, arrow)
                done = []
        if current is not None:
            done.append(finish())
        if done:
            yield pa.RecordBatch.from_pylist(done, arrow)

    schema = f"conv_id {conv}, {_COUNTS}"
    arrow = to_arrow_schema(StructType.fromDDL(schema))
    spread = parts.repartition("conv_id").sortWithinPartitions("conv_id", "kind", "part", "seq", "no")
    return spread.select(*names).mapInArrow(run, schema)


def _marked(rows: DataFrame, stage: StageArea) -> DataFrame:
    """Rows with equal ones collapsed to a number of copies, and whether the turn is the first to say so in that role."""
    said = [F.xxhash64("role", "text").alias("h1"), F.xxhash64(F.lit(1), "text", "role").alias("h2")]
    when = F.struct("turn")  # a null is the least
    again = rows.filter("present").groupBy("conv_id", *said).agg(F.min(when).alias("first"), F.max(when).alias("last"))
    again = again.filter(~F.col("first.turn").eqNullSafe(F.col("last.turn")))
    again = stage(again.select(F.col("conv_id").alias("c"), "h1", "h2", F.col("first.turn").alias("first_turn"), F.lit(True).alias("again")), "again")
    single = rows.groupBy("conv_id", "present", "turn", "role", "text").agg(F.sum("copies").alias("copies")).select("*", *said)
    same: Column = F.col("conv_id").eqNullSafe(F.col("c")) & (single["h1"] == again["h1"]) & (single["h2"] == again["h2"])
    joined = single.join(small_enough(again, BROADCAST_TURNS), same, "left")
    first = F.col("again").isNull() | F.col("turn").eqNullSafe(F.col("first_turn"))
    return joined.select("conv_id", "present", "turn", "role", "text", "copies", first.alias("first"))


def repair_report(rows: DataFrame) -> DataFrame:
    """``(conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit, repaired_sha256)`` of every conversation.

    ``rows`` is what ``turns`` or ``damaged`` return.  A conversation's rows are ordered by turn (nulls first), those of one turn by role
    and text; a null conversation id is one conversation; an empty table gives none.  Repeated rows are duplicates of each other.  A
    row's first fault counts: blank, duplicate, truncated.  A role without a letter, or with another initial than s, u or a, can be
    changed or deleted, not kept.  Gaps of more than a long holds are given as the largest long.

    A conversation may hold any share of all rows: its rows are searched in blocks on many tasks.  What one task then reads of it is
    its edits, and its texts one after the other, as one digest covers them all.
    """
    with StageArea(rows.sparkSession) as stage:
        order = ["conv_id", "present", "turn", "role", "text"]
        marked = _marked(rows, stage).repartitionByRange(*order).sortWithinPartitions(*order)
        parts = stage(_blocks(marked), "parts")
        columns = ["conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]
        return cut(parts.filter(F.col("kind") == DONE).select(*columns).unionByName(_finish(parts.filter(F.col("kind") != DONE)).select(*columns)))


def repair(rows: DataFrame) -> DataFrame:
    """``(conv_id, no, role, text)``: the repaired conversations, numbered from 0; those without a row left are gone.

    ``rows`` and cases as in ``repair_report``.
    """
    report = repair_report(rows).select("conv_id", F.col("audit"))
    order = ["turn", "role", "text"]
    with StageArea(rows.sparkSession) as stage:
        marked = _marked(rows, stage).filter("present").select("conv_id", *order, "copies")
        conv = rows.schema["conv_id"].dataType.simpleString()
        edits = report.select("conv_id", F.lit(0).alias("kind"), F.lit(None).cast("long").alias("turn"), F.lit("").alias("role"), F.col("audit").alias("text"), F.lit(1).cast("long").alias("copies"))
        both = edits.unionByName(marked.withColumn("kind", F.lit(1)))
        sorted_rows = both.repartition("conv_id").sortWithinPartitions("conv_id", "kind", *order)

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            names = ["conv_id", "no", "role", "text"]
            current, repaired, no = None, None, 0
            for batch in batches:
                out: list[tuple] = []

                def add(said: Iterator[tuple[str, bytes]]) -> None:
                    nonlocal no
                    for role, text in said:
                        out.append((current[0], no, role, text))
                        no += 1

                for r in batch.to_pylist():
                    if r["kind"] == 0:
                        if repaired is not None:
                            add(repaired.rest())
                        current, repaired, no = (r["conv_id"],), Repaired(r["text"]), 0
                        continue
                    for _ in range(r["copies"]):
                        add(repaired.row(r["role"], r["text"].encode()))
                if out:
                    yield pa.RecordBatch.from_arrays(_arrays(out, batch.schema.field("conv_id").type), names=names)
            if repaired is not None:
                out = [(current[0], no + k, role, text) for k, (role, text) in enumerate(repaired.rest())]
                if out:
                    yield pa.RecordBatch.from_arrays(_arrays(out, batch.schema.field("conv_id").type), names=names)

        return cut(sorted_rows.mapInArrow(run, f"conv_id {conv}, no long, role string, text string"))


def _arrays(rows: list[tuple], of_conv: pa.DataType) -> list[pa.Array]:
    conv, no, role, text = zip(*rows, strict=True)
    return [pa.array(conv, of_conv), pa.array(no, pa.int64()), pa.array(role, pa.string()), pa.array(text, pa.binary()).cast(pa.string(), safe=False)]

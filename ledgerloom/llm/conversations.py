"""Conversations repaired into the grammar `(s?(ua)+)?` by the cheapest edits.

A row is kept (0), given another role (3) or deleted (4; blank rows and repeats
have to be), and empty turns may be inserted anywhere (3); a truncated row that
stays adds 3. A forward Viterbi pass over the rows of a conversation holds, for
each of four states of the grammar (nothing yet, after system, after user, after
assistant), the least (cost, audit string). After each row the layer is closed
with insertions: two at most lead from any state to any other, so two rounds
do. Among equal costs the audit that is least in ASCII stays. Audits of one cost
over the same rows are never prefixes of each other, as what one has more would
be insertions, which cost; so what is least for a prefix stays least, and
stretches of rows can be solved apart and joined.

That is what keeps a conversation of any length distributed. Rows shrink to a
digest and two flags first, equal ones to a count; whether a row repeats an
earlier one comes from a join with the first of its kind; then rows are sorted into ranges
by conversation and turn, so a long conversation spans several tasks. Each task
solves its stretch from all four states, in blocks of bounded length, and the
few stretches of a conversation are joined in order. Only then are texts
shuffled, behind the audit of their conversation, and edited as they stream by:
a task holds one batch and one audit, which has a letter a row. SHA-256 of a
conversation cannot be computed in parts, so that last step passes through one task.

Order: by turn (null first), role and a digest of the text; equal rows are
interchangeable.

Defined cases: null roles and texts count as one space, a null conversation is
a conversation. A conversation whose rows are all deleted has an empty result.
Very long texts are digested where they are read. An empty table gives no rows.
Columns other than the four that are named are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass, field
from functools import lru_cache

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import mapped, parts_for, saved

KEEP, REROLE, DELETE, INSERT = 0, 3, 4, 3
TRUNCATED_COST = 3
#: States: nothing yet, after system, after user, after assistant; those after which a user or an assistant may follow.
START, SYSTEM, USER, ASSISTANT = range(4)
_NEXT = {START: USER, SYSTEM: USER, USER: ASSISTANT, ASSISTANT: USER}
#: First letters of roles by number, the last standing for all others; faults by number.
_INITIALS = "sua"
SOUND, BLANK, DUPLICATE, TRUNCATED = range(4)
#: Rows solved at once; rows in a range of the sort, on average.
BLOCK, RANGE_ROWS = 256, 50_000
EMPTY_SHA256 = hashlib.sha256(b"").hexdigest()

#: A layer: for each state the least (cost, audit) that leads there.
Layer = tuple[tuple[int, str] | None, ...]
_BEGIN: Layer = ((0, ""), None, None, None)


def _closed(layer: list) -> list:
    for _ in range(2):
        for state, to in _NEXT.items():
            if layer[state] is not None:
                cost, audit = layer[state]
                found = (cost + INSERT, audit + "I")
                if layer[to] is None or found < layer[to]:
                    layer[to] = found
    return layer


def _after(layer: list, kind: int) -> list:
    """The layer after a row: `kind` is four times its initial's number plus its fault."""
    initial, fault = divmod(kind, 4)
    out: list = [None] * 4

    def offer(to: int, cost: int, audit: str) -> None:
        if out[to] is None or (cost, audit) < out[to]:
            out[to] = (cost, audit)

    worse = TRUNCATED_COST if fault == TRUNCATED else 0
    for state, held in enumerate(layer):
        if held is None:
            continue
        cost, audit = held
        offer(state, cost + DELETE, audit + "D")
        if fault in (BLANK, DUPLICATE):
            continue
        to = _NEXT[state]
        offer(to, cost + REROLE + worse, audit + "R")
        if initial == 0 and state == START:
            offer(SYSTEM, cost + KEEP + worse, audit + "K")
        elif initial in (1, 2) and to == (USER, ASSISTANT)[initial - 1]:
            offer(to, cost + KEEP + worse, audit + "K")
    return out


@lru_cache(1 << 14)
def solved(kinds: bytes, entry: int) -> Layer:
    """The layer after rows of these kinds, entered in state `entry`."""
    layer: list = [None] * 4
    layer[entry] = (0, "")
    layer = _closed(layer)
    for kind in kinds:
        layer = _closed(_after(layer, kind))
    return tuple(layer)


def joined(layer: Layer, stretch: list[Layer]) -> Layer:
    """`layer` carried through a stretch that was solved from every state."""
    out: list = []
    for to in range(4):
        ways = [(a[0] + b[0], a[1] + b[1]) for a, table in zip(layer, stretch, strict=True) if a is not None and (b := table[to]) is not None]
        out.append(min(ways, default=None))
    return tuple(out)


def cheapest(layer: Layer) -> tuple[int, str]:
    return min(x for x in (layer[START], layer[ASSISTANT]) if x is not None)


@dataclass
class Stretch:
    """What one task has seen of a conversation: counts, edges, and the layers from each entry."""

    entries: tuple[int, ...]
    faults: list[int] = field(default_factory=lambda: [0, 0, 0, 0])
    illegal: int = 0
    first: int | None = None
    last: int | None = None
    first_turn: int | None = None
    last_turn: int | None = None
    turns: int = 0
    kinds: bytearray = field(default_factory=bytearray)
    layers: list[Layer] | None = None

    def add(self, turn: int | None, kind: int, copies: int) -> None:
        """A row, `copies` times: all but the first repeat it, unless they are blank."""
        initial, fault = divmod(kind, 4)
        if self.first is None:
            self.first = initial
        else:
            self.illegal += not _legal(self.last, initial)
        self.last = initial
        self.faults[fault] += 1
        self.kinds.append(kind)
        if turn is not None and turn != self.last_turn:
            self.turns += 1
            self.first_turn = turn if self.first_turn is None else self.first_turn
            self.last_turn = turn
        if copies > 1:
            again = BLANK if fault == BLANK else DUPLICATE
            self.faults[again] += copies - 1
            self.illegal += (copies - 1) * (not _legal(initial, initial))
            for at in range(0, copies - 1, BLOCK):
                self.kinds += bytes([initial * 4 + again]) * min(BLOCK, copies - 1 - at)
                self._solve()
        self._solve()

    def _solve(self, whole: bool = False) -> None:
        while len(self.kinds) >= BLOCK or (whole and (self.kinds or self.layers is None)):
            block, self.kinds = bytes(self.kinds[:BLOCK]), self.kinds[BLOCK:]
            if self.layers is None:
                self.entries = self.entries if whole else (START, SYSTEM, USER, ASSISTANT)
                self.layers = [solved(block, e) for e in self.entries]
            else:
                stretch = [solved(block, e) for e in range(4)]
                self.layers = [joined(a, stretch) for a in self.layers]

    def done(self, alone: bool) -> Stretch:
        """All rows solved; from the start only where no other task has rows of the conversation."""
        if self.layers is None:
            self.entries = (START,) if alone else (START, SYSTEM, USER, ASSISTANT)
        self._solve(whole=True)
        return self


def _legal(a: int, b: int) -> bool:
    return (a, b) in ((0, 1), (1, 2), (2, 1))


_STRETCH = "part int, blank bigint, duplicate bigint, truncated bigint, illegal bigint, first int, last int, first_turn bigint, last_turn bigint, turns bigint, costs array<bigint>, audits array<string>"
_REPAIR = "gaps bigint, blank bigint, duplicate bigint, truncated bigint, illegal bigint, cost bigint, audit string"


def _arrow(ddl: str) -> pa.Schema:
    from pyspark.sql import types as T
    from pyspark.sql.pandas.types import to_arrow_schema

    return to_arrow_schema(T._parse_datatype_string(ddl))


def _rows(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    for batch in batches:
        for at in range(0, len(batch), 1024):
            yield from zip(*(c.to_pylist() for c in batch.slice(at, 1024).columns), strict=True)


def _batched(rows: Iterator[dict], schema: pa.Schema, most: int = 1024, size: int = 1 << 22) -> Iterator[pa.RecordBatch]:
    held: list[dict] = []
    used = 0
    for row in rows:
        held.append(row)
        used += sum(len(x) for v in row.values() for x in (v if isinstance(v, list) else [v]) if isinstance(x, str))
        if len(held) >= most or used >= size:
            yield pa.RecordBatch.from_pylist(held, schema=schema)
            held, used = [], 0
    if held:
        yield pa.RecordBatch.from_pylist(held, schema=schema)


def _stretches(rows: DataFrame, kind: str) -> DataFrame:
    """Sorted rows (conv, turn, kind, copies) to one row for each conversation that a task has rows of."""
    out = f"conv {kind}, {_STRETCH}"
    schema = _arrow(out)

    def told(conv, s: Stretch, part: int) -> dict:
        layers = [x for layer in s.layers for x in layer]
        return {"conv": conv, "part": part, "blank": s.faults[BLANK], "duplicate": s.faults[DUPLICATE], "truncated": s.faults[TRUNCATED], "illegal": s.illegal, "first": s.first, "last": s.last, "first_turn": s.first_turn, "last_turn": s.last_turn, "turns": s.turns, "costs": [x and x[0] for x in layers], "audits": [x and x[1] for x in layers]}

    def solve(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = TaskContext.get().partitionId()

        def each() -> Iterator[dict]:
            conv, now, edge = None, None, True
            for key, turn, code, copies in _rows(batches):
                if now is None or key != conv:
                    if now is not None:
                        yield told(conv, now.done(alone=not edge), part)
                        edge = False
                    conv, now = key, Stretch((START,))
                now.add(turn, code, copies)
            if now is not None:
                yield told(conv, now.done(alone=False), part)

        yield from _batched(each(), schema)

    return rows.select("conv", "turn", "kind", "copies").transform(mapped, solve, out)


def _whole(stretches: DataFrame, kind: str) -> DataFrame:
    """Stretches, sorted by conversation and part, to one row per conversation."""
    out = f"conv {kind}, {_REPAIR}"
    schema = _arrow(out)

    def fold(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def result(conv, counts, layer, span) -> dict:
            cost, audit = cheapest(layer)
            first, last, turns = span
            return {"conv": conv, "gaps": 0 if first is None else last - first + 1 - turns, "blank": counts[0], "duplicate": counts[1], "truncated": counts[2], "illegal": counts[3], "cost": cost, "audit": audit}

        def each() -> Iterator[dict]:
            conv, layer, counts, span, before = None, None, None, None, None
            for key, _, *own, first, last, first_turn, last_turn, turns, costs, audits in _rows(batches):
                if layer is None or key != conv:
                    if layer is not None:
                        yield result(conv, counts, layer, span)
                    conv, layer, counts, span, before = key, _BEGIN, [0] * 4, (None, None, 0), None
                cells = [None if c is None else (c, a) for c, a in zip(costs, audits, strict=True)]
                tables = [tuple(cells[i : i + 4]) for i in range(0, len(cells), 4)]
                layer = joined(layer, tables) if len(tables) == 4 else tables[0]
                counts = [a + b for a, b in zip(counts, own, strict=True)]
                if before is not None:
                    counts[3] += not _legal(before, first)
                before = last
                if first_turn is not None:
                    span = (first_turn if span[0] is None else span[0], last_turn, span[2] + turns - (span[1] == first_turn))
            if layer is not None:
                yield result(conv, counts, layer, span)

        yield from _batched(each(), schema)

    return stretches.transform(mapped, fold, out)


def turns_of(rows: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text") -> DataFrame:
    """`rows` under the names used here, with the digest of their text."""
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(" "))
    return rows.select(
        F.col(conv_col).alias("conv"),
        F.col(turn_col).cast("long").alias("turn"),
        F.coalesce(F.col(role_col).cast("string"), F.lit(" ")).alias("role"),
        text.alias("text"),
        F.unhex(F.md5(text.cast("binary"))).alias("digest"),
    )


_ORDER = ("turn", "role", "digest")
_SPACES = " \t\n\x0b\x0c\r"


def diagnosed(turns: DataFrame) -> DataFrame:
    """Faults, least cost and audit of each conversation."""
    kind = turns.schema["conv"].dataType.simpleString()
    bare = F.rtrim("text", F.lit(_SPACES))
    flags = {"blank": F.length(bare) == 0, "open": ~F.right(bare, F.lit(1)).isin(".", "!", "?")}
    slim = turns.select("conv", *_ORDER, *(c.alias(n) for n, c in flags.items())).groupBy("conv", *_ORDER, "blank", "open").agg(F.count("*").alias("copies"))
    slim = saved(slim, "turns")
    firsts = slim.groupBy(F.col("conv").alias("_conv"), F.col("role").alias("_role"), F.col("digest").alias("_digest")).agg(F.min(F.struct("turn")).alias("_first"))
    known = slim.join(firsts, F.col("conv").eqNullSafe(F.col("_conv")) & (F.col("role") == F.col("_role")) & (F.col("digest") == F.col("_digest")))
    initial = F.coalesce(F.nullif(F.instr(F.lit(_INITIALS), F.left("role", F.lit(1))), F.lit(0)), F.lit(4)) - 1
    initial = F.when(F.length("role") == 0, 3).otherwise(initial)
    fault = F.when(F.col("blank"), BLANK).when(~F.col("turn").eqNullSafe(F.col("_first.turn")), DUPLICATE).when(F.col("open"), TRUNCATED).otherwise(SOUND)
    coded = known.select("conv", *_ORDER, (initial * 4 + fault).cast("int").alias("kind"), "copies")
    parts = parts_for(slim, RANGE_ROWS)
    ranged = coded.repartitionByRange(parts, "conv", *_ORDER).sortWithinPartitions("conv", *_ORDER)
    stretches = _stretches(ranged, kind)
    return _whole(stretches.repartition(parts, "conv").sortWithinPartitions("conv", "part"), kind)


def repaired(turns: DataFrame, audits: DataFrame, parts: int) -> DataFrame:
    """The conversations after their edits, row by row in order: conv, place, edit, role, text."""
    kind = turns.schema["conv"].dataType.simpleString()
    out = f"conv {kind}, place bigint, edit string, role string, text string"
    schema = _arrow(out)

    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def each() -> Iterator[dict]:
            conv, audit, at, place, state = None, "", 0, 0, START

            def inserted() -> Iterator[dict]:
                nonlocal at, place, state
                while at < len(audit) and audit[at] == "I":
                    state = _NEXT[state]
                    yield {"conv": conv, "place": place, "edit": "I", "role": ("user", "assistant")[state - USER], "text": ""}
                    at, place = at + 1, place + 1

            for key, header, role, text in _rows(batches):
                if header is not None:  # the audit comes before its rows
                    yield from inserted()
                    conv, audit, at, place, state = key, header, 0, 0, START
                    continue
                yield from inserted()
                edit, at = audit[at], at + 1
                if edit == "D":
                    continue
                state = SYSTEM if edit == "K" and role[:1] == "s" else _NEXT[state]
                yield {"conv": conv, "place": place, "edit": edit, "role": role if edit == "K" else ("user", "assistant")[state - USER], "text": text}
                place += 1
            yield from inserted()

        yield from _batched(each(), schema)

    none = F.lit(None)
    heads = audits.select("conv", F.lit(0).alias("at"), none.cast("bigint").alias("turn"), F.lit("").alias("role"), F.lit(b"").alias("digest"), "audit", F.lit("").alias("text"))
    body = turns.select("conv", F.lit(1).alias("at"), "turn", "role", "digest", none.cast("string").alias("audit"), "text")
    dealt = heads.unionByName(body).repartition(parts, "conv").sortWithinPartitions("conv", "at", *_ORDER)
    return dealt.select("conv", "audit", "role", "text").transform(mapped, apply, out)


def digests(turns: DataFrame) -> DataFrame:
    """conv and the SHA-256 of its rows as `role:text`, joined by newlines; rows come in order, as `repaired` gives them."""
    out = f"conv {turns.schema['conv'].dataType.simpleString()}, sha256 string"
    schema = _arrow(out)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def each() -> Iterator[dict]:
            conv, sha = None, None
            for key, place, role, text in _rows(batches):
                if place == 0:
                    if sha is not None:
                        yield {"conv": conv, "sha256": sha.hexdigest()}
                    conv, sha = key, hashlib.sha256()
                else:
                    sha.update(b"\n")
                sha.update(f"{role}:{text}".encode())
            if sha is not None:
                yield {"conv": conv, "sha256": sha.hexdigest()}

        yield from _batched(each(), schema)

    return turns.select("conv", "place", "role", "text").transform(mapped, run, out)


def repair_digests(turns: DataFrame) -> DataFrame:
    """One row per conversation of `turns`: faults, cost, audit and the hash of what the edits make of it."""
    audits = saved(diagnosed(turns), "audits")
    hashes = digests(repaired(turns, audits, parts_for(turns, RANGE_ROWS))).withColumnRenamed("conv", "_conv")
    return audits.join(hashes, F.col("conv").eqNullSafe(F.col("_conv")), "left").select("conv", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", F.coalesce("sha256", F.lit(EMPTY_SHA256)).alias("repaired_sha256"))

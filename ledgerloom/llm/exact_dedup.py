"""Exact deduplication by Grace hashing.

Texts are equal when they are identical after A-Z is lower-cased; a null text
counts as empty. Every task first merges equal texts of its own input in an
open-addressing table, so that a text with a third of all rows crosses the
shuffle once per task. The shuffle deals the survivors out by digest (the
first level of partitioning); a task whose bucket does not fit its table
spills what the table does not hold to 16 files by the next digest byte and
recurses on each. Tables compare complete contents, never digests alone.

Spill files are anonymous temporary files of one running task: they vanish
with it, and a rerun task makes them anew.

Defined cases: of equal texts the row with the largest id stays, a null id
counting as the smallest. Rows that repeat both the text and that id are one
document; exactly one of them stays. An empty table gives an empty result.
Columns other than the id and the text are carried, whatever their names.
"""

from __future__ import annotations

import hashlib
import pickle
import tempfile
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import ASCII_LOWER, mapped, parts_for, shuffle_parts

#: Documents that one partition of contents holds on average.
PART_ROWS = 8192
#: Bytes of text that one table holds before it spills.
TABLE_BYTES = 48 << 20
FANOUT = 16
#: Rows with the same id and text that one block writes out.
BLOCK = 100_000


def normalised(text: str | None) -> bytes:
    return (text or "").encode("utf-8", "surrogatepass").translate(ASCII_LOWER)


def text_digest(text: str | None) -> bytes:
    return hashlib.sha256(normalised(text)).digest()


@dataclass(slots=True)
class Group:
    """Rows with one text: how many, the row that stays, and how many rows share its id."""

    digest: bytes
    size: int
    ties: int
    key: int | None
    text: str | None
    row: tuple

    def rank(self) -> tuple:
        return (self.key is not None, self.key or 0)

    def absorb(self, other: Group) -> None:
        self.size += other.size
        if self.rank() == other.rank():
            self.ties += other.ties
            better = (other.text or "") > (self.text or "")
        else:
            better = other.rank() > self.rank()
            if better:
                self.ties = other.ties
        if better:
            self.key, self.text, self.row = other.key, other.text, other.row


class ContentTable:
    """Open addressing with linear probing; a slot matches only if the complete texts do."""

    def __init__(self) -> None:
        self.slots: list[Group | None] = [None] * 1024
        self.count = 0
        self.bytes = 0

    def place(self, group: Group) -> int:
        """The slot of the equal text, or else the empty slot where it would go."""
        mask = len(self.slots) - 1
        at = int.from_bytes(group.digest[-8:], "little") & mask
        content = None
        while (held := self.slots[at]) is not None:
            if held.digest == group.digest:
                content = normalised(group.text) if content is None else content
                if held.text == group.text or normalised(held.text) == content:
                    return at
            at = (at + 1) & mask
        return at

    def merge(self, group: Group) -> bool:
        held = self.slots[self.place(group)]
        if held is None:
            return False
        before = len(held.text or "")
        held.absorb(group)
        self.bytes += len(held.text or "") - before
        return True

    def insert(self, group: Group) -> None:
        if 2 * (self.count + 1) > len(self.slots):
            old, self.slots = self.slots, [None] * (2 * len(self.slots))
            for held in old:
                if held is not None:
                    self.slots[self.place(held)] = held
        self.slots[self.place(group)] = group
        self.count += 1
        self.bytes += len(group.text or "") + 400

    def groups(self) -> Iterator[Group]:
        return (held for held in self.slots if held is not None)


def combined(groups: Iterable[Group], budget: int = TABLE_BYTES) -> Iterator[Group]:
    """Merge equal texts as far as one table reaches; a full table is emitted and begun anew."""
    table = ContentTable()
    for group in groups:
        if table.merge(group):
            continue
        if table.bytes > budget:
            yield from table.groups()
            table = ContentTable()
        table.insert(group)
    yield from table.groups()


def grace(groups: Iterable[Group], budget: int = TABLE_BYTES, level: int = 0) -> Iterator[Group]:
    """Merge equal texts completely within bounded memory, spilling by one digest byte per level."""
    table, spills = ContentTable(), {}
    for group in groups:
        if table.merge(group):
            continue
        if table.bytes <= budget:
            table.insert(group)
            continue
        bucket = group.digest[level % 24] % FANOUT
        if bucket not in spills:
            spills[bucket] = tempfile.TemporaryFile()
        pickle.dump((group.digest, group.size, group.ties, group.key, group.text, group.row), spills[bucket], pickle.HIGHEST_PROTOCOL)
    yield from table.groups()
    del table
    for spill in spills.values():
        with spill:
            spill.seek(0)
            yield from grace(_spilled(spill), budget, level + 1)


def _spilled(file) -> Iterator[Group]:
    while True:
        try:
            yield Group(*pickle.load(file))
        except EOFError:
            return


def _batches(groups: Iterable[Group], schema: pa.Schema, rows: int = 512) -> Iterator[pa.RecordBatch]:
    held: list[tuple] = []
    for group in groups:
        held.append((group.digest, group.size, group.ties, *group.row))
        if len(held) == rows:
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*held), schema.types, strict=True)], schema=schema)
            held = []
    if held:
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*held), schema.types, strict=True)], schema=schema)


def kept_rows(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", table_bytes: int = TABLE_BYTES) -> DataFrame:
    """One row per distinct text: `_digest` (SHA-256 of the normalised text), `_size`, `_ties`, then all columns of the row that stays under the names c0, c1, ..."""
    from pyspark.sql.pandas.types import to_arrow_schema

    names = docs.columns
    key, text = names.index(id_col), names.index(text_col)
    renamed = docs.toDF(*(f"c{i}" for i in range(len(names))))
    out = T.StructType([T.StructField("_digest", T.BinaryType()), T.StructField("_size", T.LongType()), T.StructField("_ties", T.LongType()), *renamed.schema.fields])
    schema = to_arrow_schema(out)

    def first(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows() -> Iterator[Group]:
            for batch in batches:
                for row in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                    yield Group(text_digest(row[text]), 1, 1, row[key], row[text], row)

        return _batches(combined(rows(), table_bytes), schema)

    def last(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows() -> Iterator[Group]:
            for batch in batches:
                for digest, size, ties, *row in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                    yield Group(digest, size, ties, row[key], row[text], tuple(row))

        return _batches(grace(rows(), table_bytes), schema)

    return renamed.transform(mapped, first, out).repartition(parts_for(docs, PART_ROWS), "_digest").transform(mapped, last, out)


def drop_exact_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """`docs` with one row of each group of equal texts; all columns as they were."""
    names = docs.columns
    return kept_rows(docs, id_col, text_col).select(*(F.col(f"c{i}").alias(n) for i, n in enumerate(names)))


def exact_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of `docs`: the id, keep_id, group_size, kept and text_sha256.

    Only groups of two or more rows travel to the join, which carries digests
    and not texts; a group with many rows is split there by adaptive execution.
    """
    slim = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    id_type = slim.schema["doc_id"].dataType
    groups = (
        kept_rows(slim, "doc_id", "text")
        .where("_size > 1")
        .select(F.col("_digest").alias("g_digest"), F.col("c0").alias("g_keep"), F.col("_size").alias("g_size"), F.col("_ties").alias("g_ties"))
    )
    schema = T.StructType([T.StructField("doc_id", id_type), T.StructField("digest", T.BinaryType())])

    def digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [text_digest(x) for x in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found, pa.binary())], names=["doc_id", "digest"])

    joined = slim.transform(mapped, digests, schema).join(groups, F.col("digest") == F.col("g_digest"), "left")
    alone = F.col("g_digest").isNull()
    top = alone | F.col("doc_id").eqNullSafe(F.col("g_keep"))
    rows = joined.select(
        "doc_id",
        F.when(alone, F.col("doc_id")).otherwise(F.col("g_keep")).alias("keep_id"),
        F.when(alone, F.lit(1)).otherwise(F.col("g_size")).cast("long").alias("group_size"),
        top.alias("kept"),
        F.lower(F.hex("digest")).alias("text_sha256"),
        F.coalesce(top & (F.col("g_ties") > 1), F.lit(False)).alias("tied"),
    )
    # Rows that repeat the id that stays are the same in every column: they are counted, and written out again in blocks, of which the first row stays.
    same = ["doc_id", "keep_id", "group_size", "text_sha256"]
    counted = rows.where("tied").groupBy(*same).agg(F.count("*").alias("n"))
    blocks = counted.select(*same, "n", F.explode(F.sequence(F.lit(0).cast("long"), F.floor((F.col("n") - 1) / BLOCK))).alias("block"))
    upto = F.least("n", (F.col("block") + 1) * BLOCK) - 1
    tied = blocks.repartition(shuffle_parts(docs.sparkSession), "text_sha256", "block").select(*same, F.explode(F.sequence(F.col("block") * BLOCK, upto)).alias("nth")).withColumn("kept", F.col("nth") == 0)
    return rows.where("not tied").drop("tied").unionByName(tied.drop("nth"))

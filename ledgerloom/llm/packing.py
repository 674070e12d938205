"""Packing token ids into sequences: first-fit decreasing in randomised groups.

Documents are encoded once and dealt to groups by a seeded hash, so groups
have like mixtures and bounded size whatever source they come from. Within a
group every document gives whole sequences while it is long enough; the tails
are placed longest first, each into the first open bin with room, which a
tournament tree of bin capacities finds in logarithmic time. Then the emptiest
bins are dissolved into the gaps of the fuller ones, cutting their pieces, so
that one sequence a group is padded at most. As pieces may be cut, that alone
would give little padding; first fit keeps most tails whole.

Defined cases: a null text counts as empty and gives the end id alone. Rows
that repeat a document id are packed each for itself. An empty table gives no
rows. Columns other than the id and the text are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import mapped
from .tokenizing import encoded, ids_crc32, narrow, wide

PIECES = "doc_id bigint, start bigint, length bigint, ids_crc32 bigint, doc_tokens bigint, sequence_id bigint, offset bigint"
#: Documents that one group has on average, and groups that one task packs.
GROUP_DOCS, TASK_GROUPS = 512, 16
#: Sequences of one group are numbered from group * 2**GROUP_BITS.
GROUP_BITS = 32
#: Bytes of ids that a part of a group has at most, but for one document.
PART_BYTES = 64 << 20


class CapacityTree:
    """Tournament tree: each inner node has the largest free room below it."""

    def __init__(self, bins: int, capacity: int):
        self.leaves = 1 << max(0, (bins - 1).bit_length())
        self.room = [capacity] * (2 * self.leaves)

    def first(self, need: int) -> int:
        """The leftmost bin with at least `need` free; there always is one, as there are as many bins as pieces."""
        node = 1
        while node < self.leaves:
            node *= 2
            if self.room[node] < need:
                node += 1
        return node - self.leaves

    def take(self, bin_no: int, used: int) -> None:
        node = bin_no + self.leaves
        self.room[node] -= used
        while node > 1:
            node //= 2
            self.room[node] = max(self.room[2 * node], self.room[2 * node + 1])


def first_fit_decreasing(lengths: list[int], capacity: int) -> list[list[int]]:
    """Bins of item numbers; items are taken longest first, equal ones in their order."""
    tree, bins = CapacityTree(max(1, len(lengths)), capacity), []
    for item in sorted(range(len(lengths)), key=lambda i: (-lengths[i], i)):
        at = tree.first(lengths[item])
        tree.take(at, lengths[item])
        if at == len(bins):
            bins.append([])
        bins[at].append(item)
    return bins


def packed(lengths: list[int], capacity: int) -> list[list[tuple[int, int, int]]]:
    """Sequences of pieces (document, start, length) that hold every id of every document once."""
    full, tails = [], []
    for doc, length in enumerate(lengths):
        start = 0
        while length - start >= capacity:
            full.append([(doc, start, capacity)])
            start += capacity
        if length > start:
            tails.append((doc, start, length - start))
    bins = [[tails[i] for i in b] for b in first_fit_decreasing([t[2] for t in tails], capacity)]
    bins.sort(key=lambda b: -sum(p[2] for p in b))
    gaps = [capacity - sum(p[2] for p in b) for b in bins]
    at = 0
    while bins and at < len(bins) - 1 and sum(gaps[at:-1]) >= capacity - gaps[-1]:
        pieces = bins.pop()
        gaps.pop()
        for doc, start, length in pieces:
            while length:
                while not gaps[at]:
                    at += 1
                cut = min(length, gaps[at])
                bins[at].append((doc, start, cut))
                gaps[at] -= cut
                start, length = start + cut, length - cut
    return full + bins


def pack(docs: DataFrame, tokenizer_path: str, capacity: int = 2048, end_id: int = 1, group_docs: int = GROUP_DOCS, seed: int = 7, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per piece. A group's ids travel once, as bytes; `sequence_id` is unique over all groups."""
    slim = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    groups = max(1, -(-slim.count() // group_docs))

    def coded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, len(batch), 512):
                part = batch.slice(at, 512)
                ids = [narrow(x) for x in encoded(tokenizer_path, part.column(2).cast(pa.binary()).to_pylist(), end_id)]
                yield pa.RecordBatch.from_arrays([*part.columns[:2], pa.array(ids, pa.binary())], names=["grp", "doc_id", "ids"])

    def sequences(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        group, used, keys, ids, size = None, 0, [], [], 0
        for batch in batches:
            for g, key, value in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                # A group that repeated rows have swollen is packed in parts.
                if keys and (g != group or len(keys) >= 4 * group_docs or size > PART_BYTES):
                    out, n = _pieces((group << GROUP_BITS) + used, keys, ids, capacity)
                    yield out
                    used, keys, ids, size = used + n if g == group else 0, [], [], 0
                group = g
                keys.append(key)
                ids.append(value)
                size += len(value)
        if keys:
            yield _pieces((group << GROUP_BITS) + used, keys, ids, capacity)[0]

    drawn = F.pmod(F.xxhash64("doc_id", F.length("text"), F.lit(seed)), F.lit(groups)).alias("grp")
    return slim.select(drawn, "doc_id", "text").transform(mapped, coded, "grp bigint, doc_id bigint, ids binary").repartition(-(-groups // TASK_GROUPS), "grp").sortWithinPartitions("grp", "doc_id", F.crc32("ids")).transform(mapped, sequences, PIECES)


def _pieces(first: int, keys: list, values: list[bytes], capacity: int) -> tuple[pa.RecordBatch, int]:
    """The pieces of the documents' sequences, numbered from `first`, and how many sequences there are."""
    ids = [wide(v) for v in values]
    rows, sequences = [], packed([len(x) for x in ids], capacity)
    for number, sequence in enumerate(sequences, first):
        offset = 0
        for doc, start, length in sequence:
            rows.append((keys[doc], start, length, ids_crc32(ids[doc][start : start + length]), len(ids[doc]), number, offset))
            offset += length
    names = [c.split()[0] for c in PIECES.split(", ")]
    return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*rows, strict=True)], names=names), len(sequences)

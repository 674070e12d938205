"""Connected components by alternating large-star and small-star steps.

Each round first merges, inside every task, the links it holds into stars.
Nothing but a count and a checksum reaches the driver; rounds are written to
the shared folder, so no lineage grows.

Defined cases: nodes are longs, any two may be linked, in any order and more
than once; links with a null side or from a node to itself are ignored. Without
links there are no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import mapped, saved

LINK = "child bigint, root bigint"


def stars(child: np.ndarray, root: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Links of one task as stars around each component's smallest node."""
    nodes, at = np.unique(np.concatenate([child, root]), return_inverse=True)
    a, b = at[: len(child)], at[len(child) :]
    label = np.arange(len(nodes))
    while True:
        low = np.minimum(label[a], label[b])
        new = label.copy()
        np.minimum.at(new, a, low)
        np.minimum.at(new, b, low)
        np.minimum.at(new, label[a], low)
        np.minimum.at(new, label[b], low)
        new = new[new]
        if (new == label).all():
            break
        label = new
    far = label != np.arange(len(nodes))
    return nodes[far], nodes[label[far]]


def _contracted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    child, root, size = [], [], 0
    for batch in batches:
        child.append(batch.column(0).to_numpy())
        root.append(batch.column(1).to_numpy())
        size += len(child[-1])
        if size > 2_000_000:
            a, b = stars(np.concatenate(child), np.concatenate(root))
            child, root, size = [a], [b], len(a)
            if size > 1_000_000:
                yield pa.RecordBatch.from_arrays([pa.array(a), pa.array(b)], names=["child", "root"])
                child, root, size = [], [], 0
    if size:
        a, b = stars(np.concatenate(child), np.concatenate(root))
        yield pa.RecordBatch.from_arrays([pa.array(a), pa.array(b)], names=["child", "root"])


def _round(links: DataFrame) -> DataFrame:
    """One large-star and one small-star step over links child > root."""
    both = links.unionByName(links.select(F.col("root").alias("child"), F.col("child").alias("root")))
    least = both.groupBy("child").agg(F.min("root").alias("least")).select(F.col("child").alias("node"), F.least("child", "least").alias("least"))
    # Large star: every larger neighbour of a node links to the node's least neighbour.
    large = both.where("root > child").join(least, F.col("child") == F.col("node")).select(F.col("root").alias("child"), F.col("least").alias("root")).where("child != root").distinct()
    down = large.groupBy("child").agg(F.min("root").alias("least")).select(F.col("child").alias("node"), "least")
    # Small star: every smaller neighbour, and the node itself, links to the least one.
    joined = large.join(down, F.col("child") == F.col("node"))
    small = joined.select(F.explode(F.array(F.struct(F.col("root").alias("child"), F.col("least").alias("root")), F.struct("child", F.col("least").alias("root")))).alias("l")).select("l.*")
    return small.where("child != root").distinct()


def components(links: DataFrame, max_rounds: int = 60) -> DataFrame:
    """`links` (child, root: any two long nodes) to one row per linked node that is not the smallest of its component: child, root."""
    tidy = links.select(F.greatest("child", "root").alias("child"), F.least("child", "root").alias("root")).where("child != root")
    now = saved(tidy.transform(mapped, _contracted, LINK).distinct(), "links")

    def mark(df: DataFrame) -> tuple:
        return tuple(df.agg(F.count("*"), F.coalesce(F.bit_xor(F.xxhash64("child", "root")), F.lit(0))).first())

    before = mark(now)
    for _ in range(max_rounds):
        if not before[0]:
            return now
        now = saved(_round(now), "links")
        after = mark(now)
        if after == before:
            return now
        before = after
    raise RuntimeError(f"components have not settled after {max_rounds} rounds")

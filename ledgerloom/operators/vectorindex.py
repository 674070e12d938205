"""An index of vectors by cosine: inverted lists under centroids, exact order within what is read (TXT-10).

Centroids come from k-means on a bounded sample; every vector lies in the list of
its nearest centroid, and lists are partitions of the stored table. A search
reads the lists whose centroids are nearest to the query and orders their rows by
exact cosine. How many lists that takes for the wanted recall is found when the
index is made, from where the true neighbours of sampled queries lie. An exact
search reads on: each list knows the widest angle to its centroid, and lists
that cannot hold anything nearer than the k-th found are passed over.

Vectors that are null or zero, or hold null or non-finite entries, have no cosine and are not
indexed. All vectors of an index have one number of dimensions.
"""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .search import cosine

#: Rows that centroids are learned from, lists at most, queries that measure recall, neighbours and recall that are aimed at.
SAMPLE, MOST_LISTS, PROBED, NEIGHBOURS, RECALL = 65_536, 4096, 128, 10, 0.97
SEED = 7


@dataclass(frozen=True)
class Lists:
    """What a search needs to know of the lists: a few numbers for each, never more than MOST_LISTS."""

    centroids: np.ndarray
    radii: np.ndarray
    probes: int

    def angles(self, query: Sequence[float]) -> np.ndarray:
        q = np.asarray(query, np.float64)
        return np.arccos(np.clip(self.centroids @ (q / np.linalg.norm(q)), -1.0, 1.0))


def usable(vectors: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    """id and unit vector of the rows that have a cosine."""
    v = F.col(vector_col).cast("array<double>")
    odd = F.exists(v, lambda c: c.isNull() | F.isnan(c) | (F.abs(c) == float("inf")))
    size = F.sqrt(F.aggregate("v", F.lit(0.0), lambda s, c: s + c * c))
    return vectors.select(F.col(id_col).alias("id"), v.alias("v")).where(F.col("v").isNotNull() & ~odd).where(size > 0).select("id", F.transform("v", lambda c: c / size).alias("v"))


def learned(units: DataFrame, lists: int | None = None) -> np.ndarray:
    """Centroids by spherical k-means over the SAMPLE rows with the smallest hash of their id; about the root of the number of rows."""
    from pyspark.ml.clustering import KMeans
    from pyspark.ml.functions import array_to_vector

    lists = lists or min(MOST_LISTS, math.ceil(math.sqrt(units.count())))
    some = units.orderBy(F.xxhash64(F.col("id").cast("string")), "id").limit(SAMPLE).select(array_to_vector("v").alias("features")).repartition(units.sparkSession.sparkContext.defaultParallelism)
    model = KMeans(k=max(2, lists), seed=SEED, maxIter=8, distanceMeasure="cosine").fit(some)
    centres = np.array([c / np.linalg.norm(c) for c in model.clusterCenters() if np.linalg.norm(c) > 0])
    return centres


def listed(units: DataFrame, centroids: np.ndarray) -> DataFrame:
    """id, v, list, and the angle to the list's centroid."""
    kind = units.schema["id"].dataType.simpleString()

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, len(batch), 1024):
                part = batch.slice(at, 1024)
                near = np.asarray(part.column(1).flatten()).reshape(len(part), -1) @ centroids.T
                own = near.argmax(1)
                angle = np.arccos(np.clip(near[np.arange(len(own)), own], -1.0, 1.0))
                yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), pa.array(own.astype(np.int32)), pa.array(angle)], names=["id", "v", "list", "angle"])

    return units.mapInArrow(assign, f"id {kind}, v array<double>, list int, angle double")


def described(index: DataFrame, centroids: np.ndarray) -> DataFrame:
    """A row for each list: its centroid, the widest angle, and how many lists a search reads."""
    spark = index.sparkSession
    widest = {r.list: r.a for r in index.groupBy("list").agg(F.max("angle").alias("a")).collect()}  # MOST_LISTS rows at most
    lists = Lists(centroids, np.array([widest.get(i, -1.0) for i in range(len(centroids))]), len(centroids))
    probes = _probes(index, lists)
    return spark.createDataFrame([(i, c.tolist(), float(lists.radii[i]), probes) for i, c in enumerate(centroids)], "list int, centroid array<double>, radius double, probes int")


def _probes(index: DataFrame, lists: Lists) -> int:
    """So many nearest lists hold RECALL of the true neighbours of PROBED sampled rows."""
    queries = index.orderBy(F.xxhash64(F.col("id").cast("string"), F.lit(1)), "id").limit(PROBED).select("v").collect()
    if not queries:
        return 1
    asked = np.array([r.v for r in queries])

    def nearest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            near = np.asarray(batch.column(0).flatten()).reshape(len(batch), -1) @ asked.T
            own = np.asarray(batch.column(1))
            k = min(NEIGHBOURS + 1, len(near))
            best = np.argpartition(-near, k - 1, axis=0)[:k]
            for q in range(len(asked)):
                yield pa.RecordBatch.from_arrays([pa.array([q] * k, pa.int32()), pa.array(near[best[:, q], q]), pa.array(own[best[:, q]])], names=["q", "s", "list"])

    order = Window.partitionBy("q").orderBy(F.desc("s"))
    found = index.select("v", "list").mapInArrow(nearest, "q int, s double, list int").withColumn("n", F.row_number().over(order)).where(F.col("n").between(2, NEIGHBOURS + 1)).select("q", "list").collect()  # PROBED x NEIGHBOURS rows
    ranks = [np.argsort(np.argsort(lists.angles(v))) for v in asked]
    needed = sorted(int(ranks[r.q][r.list]) + 1 for r in found)
    return needed[min(len(needed) - 1, math.ceil(RECALL * len(needed)) - 1)] if needed else 1


def build(vectors: DataFrame, id_col: str, vector_col: str, write, lists: int | None = None) -> None:
    """Learn, deal out and describe. `write(name, df, by)` stores a frame partitioned by columns and gives it back: "vectors", then "lists"."""
    units = usable(vectors, id_col, vector_col)
    centroids = learned(units, lists) if units.limit(2).count() > 1 else np.array([r.v for r in units.collect()])
    if not len(centroids):
        return
    index = write("vectors", listed(units, centroids).hint("rebalance", "list"), ["list"])
    write("lists", described(index, centroids), [])


def read_lists(rows: DataFrame) -> Lists:
    got = sorted(rows.collect(), key=lambda r: r.list)  # MOST_LISTS rows at most
    return Lists(np.array([r.centroid for r in got]), np.array([r.radius for r in got]), got[0].probes)


def _top(index: DataFrame, some: Sequence[int], query: Sequence[float], k: int) -> DataFrame:
    near = cosine(F.col("v"), F.array(*(F.lit(float(x)) for x in query)))
    return index.where(F.col("list").isin([int(i) for i in some])).select("id", near.alias("similarity")).where("similarity IS NOT NULL").orderBy(F.desc("similarity"), "id").limit(k)


def search(index: DataFrame, lists: Lists, query: Sequence[float], k: int = NEIGHBOURS, probes: int | None = None, exact: bool = False) -> DataFrame:
    """The k most similar rows to one vector; the filter on lists reaches the partitions. With `exact`, none is missed."""
    angles = lists.angles(query)
    order = np.argsort(angles)
    some = order[: probes or lists.probes]
    first = _top(index, some, query, k)
    if not exact:
        return first
    found = first.collect()
    least = found[-1].similarity if len(found) == k else -1.0
    reach = np.cos(np.maximum(0.0, angles - lists.radii)) + 1e-9
    return _top(index, [i for i in order if lists.radii[i] >= 0 and (i in set(some.tolist()) or reach[i] >= least)], query, k)


def search_many(index: DataFrame, lists: Lists, queries: DataFrame, k: int = NEIGHBOURS, probes: int | None = None) -> DataFrame:
    """The k most similar rows to each of `queries` (query_id, v): queries go to their lists, which are joined by number."""
    take, kind = probes or lists.probes, queries.schema["query_id"].dataType.simpleString()

    def routed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            near = np.asarray(batch.column(1).flatten()).reshape(len(batch), -1) @ lists.centroids.T
            own = np.argsort(-near, axis=1)[:, :take].astype(np.int32)
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(own.tolist(), pa.list_(pa.int32()))], names=["query_id", "q", "lists"])

    sent = usable(queries, "query_id", "v").withColumnRenamed("id", "query_id").mapInArrow(routed, f"query_id {kind}, q array<double>, lists array<int>").select("query_id", "q", F.explode("lists").alias("list"))
    near = index.join(sent, "list").select("query_id", "id", cosine(F.col("v"), F.col("q")).alias("similarity"))
    order = Window.partitionBy("query_id").orderBy(F.desc("similarity"), "id")
    return near.withColumn("place", F.row_number().over(order)).where(F.col("place") <= k)

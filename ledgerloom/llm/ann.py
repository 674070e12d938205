"""Approximate nearest neighbours: one navigable small-world graph per shard.

Vectors are dealt to shards of bounded size, in rows and in bytes, by a hash of their id. A shard's
graph is hierarchical: every vector is in layer 0, and one in BRANCH of a
layer's vectors is in the next. Vectors are inserted in a drawn order, those of
the upper layers first, a block at a time. A new one chooses, among the POOL
nearest that came before it, neighbours that point in different directions;
links go both ways, and one whose places are full keeps the most diverse. The
first to come thus are linked across the whole shard. What came before is
searched exhaustively: at a shard's size one matrix product a block costs less
than a beam, and finds no worse. Each layer is one flat array of neighbour
numbers with a fixed number of places per vector. A search keeps a small beam
in the upper layers, hands all of it down, and keeps a wide one in layer 0;
many queries walk together, as numpy arrays.

How wide that beam has to be depends on the data. When a shard's graph is made,
PROBES of its vectors are searched for with beams of growing width until RECALL
of their true neighbours are found, which one matrix product gives; a shard
where the widest beam falls short is searched exhaustively.

Graphs are built once and written as one row per shard. Every query visits
every shard, in blocks that stream past one loaded shard at a time, so the
queries are never in memory together. Each shard gives a query its k nearest,
measured exactly in double precision on the original vectors, and a window
over shards merges them.

Equal vectors of a shard are one graph node with their k + 1 smallest ids.
That loses nothing, since ties go to smaller ids.

With N vectors, the N / 100 queries of a hundredth each visit N / SHARD shards:
work grows with N squared over SHARD, each visit with the logarithm of SHARD.

Defined cases: vectors that are null, empty, zero, or hold null or non-finite
components take no part, nor do rows without an id, nor vectors of another
length than most have (of lengths as common, the smallest). Of rows that
repeat an id the smallest vector, component by component, counts. A query returns all candidates where there are fewer
than k. An empty table gives no rows. Other columns are ignored. Components too large
or small for single precision are scaled within the graph; scores are measured on
what was given.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import mapped, saved

#: Vectors of one shard on average; where there are fewer than that for each core, shards are smaller, down to LEAST.
SHARD, LEAST = 1 << 16, 8192
#: Neighbours per vector in layer 0 (half in others), nearest ones to choose from, and beams of a search in the upper layers and in layer 0.
PLACES, POOL, UPPER, BEAM, BRANCH = 32, 48, 16, 128, 16
#: Bytes of a shard's vectors, in single and in double precision.
SHARD_BYTES = 100 << 20
#: Beams are doubled up to MOST; vectors that a beam is measured with, and the share of their KNOWN neighbours that it has to find.
MOST, PROBES, KNOWN, RECALL = 1024, 128, 10, 0.97
NODES = 64  # queries that walk together
INSERTED = 256  # vectors inserted together


class Graph:
    """A shard's vectors in the order of insertion, neighbour arrays of the first so many by layer, and the row that each vector was."""

    def __init__(self, vectors: np.ndarray, layers: list[np.ndarray], rows: np.ndarray, scale: float = 1.0, beam: int | None = BEAM):
        """`beam`: the width that a search needs, None where only an exhaustive one will do."""
        self.vectors, self.layers, self.rows, self.scale, self.beam = vectors, layers, rows, scale, beam

    @classmethod
    def build(cls, vectors: np.ndarray, seed: int = 3) -> Graph:
        order = np.random.default_rng(seed).permutation(len(vectors))
        most = float(np.abs(vectors).max(initial=0.0))
        scale = 1.0 if 1e-9 < most < 1e9 or not most else 1.0 / most
        ordered, layers = np.ascontiguousarray(vectors[order] * scale, np.float32), []
        while True:
            count = max(1, len(vectors) // BRANCH ** len(layers))
            layers.append(_inserted(ordered[:count], PLACES if not layers else PLACES // 2))
            if count <= BRANCH:
                return cls(ordered, layers, order, scale)

    def measured(self, beam: int, recall: float = RECALL) -> Graph:
        """The graph with the least of `beam`, twice that and so on that finds `recall` of the true neighbours of drawn vectors."""
        asked = np.random.default_rng(5).choice(len(self.vectors), min(PROBES, len(self.vectors)), replace=False)
        q, k = self.vectors[asked].astype(np.float64) / self.scale, min(KNOWN, len(self.vectors) - 1)
        if not k:
            return self
        true = self.exhaustive(q, k + 1)
        self.beam = beam
        while self.beam:
            found = np.concatenate([self.search(q[a : a + NODES], self.beam)[:, : k + 1] for a in range(0, len(q), NODES)])
            hits = [len((set(f.tolist()) & set(t.tolist())) - {own}) / k for f, t, own in zip(found, true, self.rows[asked].tolist(), strict=True)]
            if np.mean(hits) >= recall or self.beam >= len(self.vectors):
                break
            self.beam = self.beam * 2 if self.beam * 2 <= MOST else None
        return self

    def exhaustive(self, queries: np.ndarray, count: int) -> np.ndarray:
        """For each query the `count` nearest rows of all, in order."""
        q, count = queries * self.scale, min(count, len(self.vectors))
        far = np.concatenate([np.einsum("nd,nd->n", x, x) - 2 * (q @ x.T) for a in range(0, len(self.vectors), 8192) for x in [self.vectors[a : a + 8192].astype(np.float64)]], 1)
        some = np.argpartition(far, count - 1, 1)[:, :count]
        return self.rows[np.take_along_axis(some, np.argsort(np.take_along_axis(far, some, 1), 1, kind="stable"), 1)]

    def found(self, queries: np.ndarray, least: int) -> np.ndarray:
        """Rows near each query (-1: none), at least `least` where there are so many, by the graph or all of them measured."""
        return self.search(queries, max(self.beam, least)) if self.beam else self.exhaustive(queries, 4 * least + 32)

    def pack(self) -> bytes:
        import pickle

        return pickle.dumps((self.vectors, self.layers, self.rows, self.scale, self.beam), pickle.HIGHEST_PROTOCOL)

    @classmethod
    def unpack(cls, data: bytes) -> Graph:
        import pickle

        return cls(*pickle.loads(data))

    def search(self, queries: np.ndarray, beam: int) -> np.ndarray:
        """For each query the rows that its final beam holds (-1: none), nearest first."""
        q = (queries * self.scale).astype(np.float32)
        at = np.broadcast_to(np.arange(len(self.layers[-1])), (len(q), len(self.layers[-1])))  # the top layer's, all of them
        for level in range(len(self.layers) - 1, 0, -1):
            at = self._beam(q, at, level, min(UPPER, len(self.layers[level])))
        nodes = self._beam(q, at, 0, min(beam, len(self.vectors)))
        return np.where(nodes < 0, -1, self.rows[nodes])

    def _far(self, q: np.ndarray, nodes: np.ndarray) -> np.ndarray:
        """Squared distances from each query to its row of nodes; a missing node is infinitely far."""
        gap = self.vectors[np.maximum(nodes, 0)] - q[:, None, :]
        return np.where(nodes < 0, np.float32(np.inf), np.einsum("qnd,qnd->qn", gap, gap))

    def _beam(self, q: np.ndarray, entries: np.ndarray, level: int, beam: int) -> np.ndarray:
        """The nodes (-1: none) of a beam that starts from each query's entries, nearest first."""
        near, n, rows = self.layers[level], len(self.layers[level]), np.arange(len(q))[:, None]
        seen = np.zeros((len(q), n + 1), bool)  # the last column stands for missing neighbours
        seen[rows, entries] = True
        seen[:, n] = True
        far = self._far(q, entries)
        nodes = np.concatenate([entries, np.full((len(q), beam), -1)], 1)
        far = np.concatenate([far, np.full((len(q), beam), np.inf, np.float32)], 1)
        keep = np.argsort(far, 1, kind="stable")[:, :beam]
        nodes, far = nodes[rows, keep], far[rows, keep]
        open_ = nodes >= 0
        while len(some := np.flatnonzero(open_.any(1))):
            first = open_[some].argmax(1)  # beams are sorted
            open_[some, first] = False
            steps = near[nodes[some, first]]
            steps = np.where(seen[some[:, None], steps], -1, steps)
            seen[some[:, None], steps] = True
            both = np.concatenate([far[some], self._far(q[some], steps)], 1)
            keep = np.argsort(both, 1, kind="stable")[:, :beam]
            take = np.arange(len(some))[:, None]
            far[some] = both[take, keep]
            nodes[some] = np.concatenate([nodes[some], steps], 1)[take, keep]
            open_[some] = np.concatenate([open_[some], steps >= 0], 1)[take, keep]
        return nodes


def _diverse(x: np.ndarray, of: np.ndarray, pool: np.ndarray, places: int) -> np.ndarray:
    """For each vector `of`, up to `places` of its row of `pool` (-1: none): those nearer to it than to any kept before, then the nearest of the rest."""
    vectors = x[np.maximum(pool, 0)]
    gap = vectors - x[of][:, None, :]
    far = np.where(pool < 0, np.inf, np.einsum("npd,npd->np", gap, gap))
    order = np.argsort(far, 1, kind="stable")
    rows = np.arange(len(of))[:, None]
    pool, far, vectors = pool[rows, order], far[rows, order], vectors[rows, order]
    square = np.einsum("npd,npd->np", vectors, vectors)
    between = square[:, :, None] + square[:, None, :] - 2 * (vectors @ vectors.transpose(0, 2, 1))
    kept = np.zeros(pool.shape, bool)
    for p in range(pool.shape[1]):
        blocked = (kept[:, :p] & (between[:, p, :p] < far[:, p, None])).any(1)
        kept[:, p] = ~blocked & (pool[:, p] >= 0) & (kept[:, :p].sum(1) < places)
    rank = np.argsort(np.where(kept, 0, np.where(pool >= 0, 1, 2)), 1, kind="stable")[:, :places]
    return pool[rows, rank]


def _inserted(x: np.ndarray, places: int) -> np.ndarray:
    """Neighbour numbers of each row of `x`, -1 where a place is empty, after inserting the rows in order."""
    n, half = len(x), max(1, places // 2)
    out = np.full((n, places), -1, np.int32)
    used = np.zeros(n, np.int64)
    norm = np.einsum("nd,nd->n", x, x)
    for a in range(0, n, INSERTED):
        b = min(a + INSERTED, n)
        far = norm[a:b, None] + norm[None, :b] - 2 * (x[a:b] @ x[:b].T)
        far[:, a:][np.triu_indices(b - a)] = np.inf  # only what came before
        size = min(POOL, b)
        pool = np.argpartition(far, size - 1, 1)[:, :size] if size < b else np.broadcast_to(np.arange(b), far.shape)
        pool = np.where(np.isinf(np.take_along_axis(far, pool, 1)), -1, pool)
        chosen = _diverse(x, np.arange(a, b), pool, half)
        out[a:b, : chosen.shape[1]] = chosen
        used[a:b] = (chosen >= 0).sum(1)
        # The way back: into free places, or the most diverse of all where there are too few.
        to, of = chosen.ravel(), np.repeat(np.arange(a, b, dtype=np.int32), chosen.shape[1])
        of, to = of[to >= 0], to[to >= 0]
        order = np.argsort(to, kind="stable")
        of, to = of[order], to[order]
        place = np.arange(len(to)) - np.searchsorted(to, to)
        ends, more = np.unique(to, return_counts=True)
        fits = used[to] + np.repeat(more, more) <= places
        out[to[fits], (used[to] + place)[fits]] = of[fits]
        full = ends[used[ends] + more > places]
        for first in range(0, len(full), 512):
            some = full[first : first + 512]
            mine = np.isin(to, some)
            wider = np.full((len(some), int(more[np.isin(ends, some)].max())), -1, np.int32)
            wider[np.searchsorted(some, to[mine]), place[mine]] = of[mine]
            out[some] = _diverse(x, some, np.concatenate([out[some], wider], 1), places)
        used[ends] = np.minimum(used[ends] + more, places)
    return out


def usable(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """id and vector of the rows that take part."""
    bad = F.exists("vector", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    some = F.exists("vector", lambda x: x != 0)
    rows = vectors.select(F.col(id_col).cast("long").alias("id"), F.col(vector_col).alias("vector"))
    rows = rows.where(F.col("id").isNotNull() & F.col("vector").isNotNull()).where(~bad & some)
    lengths = rows.groupBy(F.size("vector").alias("length")).agg(F.count("*").alias("n"))
    most = lengths.orderBy(F.desc("n"), "length").first()
    return rows.where(F.size("vector") == (most["length"] if most else 0))


def _matrix(column: pa.Array) -> np.ndarray:
    """Rows of equal length as doubles."""
    flat = np.asarray(column.flatten().to_numpy(zero_copy_only=False), np.float64)
    return flat.reshape(len(column), -1)


def build_index(vectors: DataFrame, shard_rows: int = SHARD, keep: int = 11, beam: int = BEAM, recall: float = RECALL) -> DataFrame:
    """`vectors` (id, vector) to one row per shard: its number, its graph, its vectors as stored, and up to `keep` smallest ids of each."""
    count, width = vectors.agg(F.count("*"), F.max(F.size("vector"))).first()
    shard_rows = min(shard_rows, max(KNOWN + 1, SHARD_BYTES // (12 * (width or 1))))
    shards = max(1, math.ceil(count / shard_rows), min(vectors.sparkSession.sparkContext.defaultParallelism, count // LEAST))

    def built(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, list] = {}
        for batch in batches:
            shard, ids, rows = batch.column(0).to_numpy(), batch.column(1).to_numpy(), _matrix(batch.column(2))
            for s in np.unique(shard):
                held.setdefault(int(s), []).append((ids[shard == s], rows[shard == s]))
            for s in [s for s in held if s != int(shard[-1])]:
                yield shard_row(s, held.pop(s))
        for s, parts in held.items():
            yield shard_row(s, parts)

    def shard_row(shard: int, parts: list) -> pa.RecordBatch:
        import pickle

        ids, rows = np.concatenate([p[0] for p in parts]), np.concatenate([p[1] for p in parts])
        if len(np.unique(ids)) < len(ids):
            order = np.lexsort((*rows.T[::-1], ids))
            order = order[np.append(True, np.diff(ids[order]) != 0)]
            ids, rows = ids[order], rows[order]
        distinct, of = np.unique(rows, axis=0, return_inverse=True)
        of = of.ravel()
        order = np.lexsort((ids, of))
        place = np.arange(len(order)) - np.searchsorted(of[order], of[order])
        order = order[place < keep]
        graph = Graph.build(distinct).measured(beam, recall)
        names = (of[order].astype(np.int32), ids[order])
        return pa.RecordBatch.from_arrays([pa.array([shard], pa.int32()), pa.array([graph.pack()], pa.binary()), pa.array([pickle.dumps((distinct, names))], pa.binary())], names=["shard", "graph", "rows"])

    # Equal vectors spread over shards like any others, so a vector that a third of the rows share fills no shard.
    dealt = vectors.select(F.pmod(F.xxhash64("id"), F.lit(shards)).cast("int").alias("shard"), "id", "vector")
    return dealt.repartition(shards, "shard").sortWithinPartitions("shard").transform(mapped, built, "shard int, graph binary, rows binary")


def search_index(index: DataFrame, queries: DataFrame, k: int = 10) -> DataFrame:
    """`queries` (id, vector) to query_id, rank, vec_id, score: the k nearest found over all shards, the query's own id aside."""
    shards = index.select(F.max("shard")).first()[0]
    if shards is None:
        return queries.sparkSession.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    empty, none = F.lit(None).cast("binary"), F.lit(None)
    asked = queries.groupBy("id").agg(F.min("vector").alias("vector")).select(F.explode(F.sequence(F.lit(0), F.lit(shards))).alias("shard"), empty.alias("graph"), empty.alias("rows"), F.col("id"), F.col("vector").cast("array<double>").alias("vector"))
    held = index.select("shard", "graph", "rows", none.cast("long").alias("id"), none.cast("array<double>").alias("vector"))

    def found(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import pickle

        held_shard, graph, distinct, names = None, None, None, None
        for batch in batches:
            loads = np.flatnonzero(np.asarray(batch.column(1).is_valid()))
            for a, b in zip([0, *(loads + 1)], [*loads, len(batch)], strict=True):
                if a:
                    held_shard = batch.column(0)[a - 1].as_py()
                    graph, (distinct, names) = Graph.unpack(batch.column(1)[a - 1].as_py()), pickle.loads(batch.column(2)[a - 1].as_py())
                for c in range(a, b, NODES):
                    part = batch.slice(c, min(NODES, b - c))
                    # A shard may have no vectors; its queries then follow another shard's.
                    part = part.filter(pa.array(part.column(0).to_numpy() == held_shard))
                    if len(part):
                        yield nearest(graph, distinct, names, part.column(3).to_numpy(), _matrix(part.column(4)))

    def nearest(graph: Graph, distinct: np.ndarray, names: tuple, ids: np.ndarray, q: np.ndarray) -> pa.RecordBatch:
        nodes = graph.found(q, 2 * k)
        ends = np.searchsorted(names[0], np.arange(len(distinct) + 1))
        out = []
        for own, vector, mine in zip(ids, q, nodes, strict=True):
            mine = mine[mine >= 0]
            score = np.sqrt(((distinct[mine] - vector) ** 2).sum(1))
            best = np.argsort(score, kind="stable")[: k + 1]
            limit = score[best[-1]]
            rows = [(s, v) for node, s in zip(mine[score <= limit], score[score <= limit], strict=True) for v in names[1][ends[node] : ends[node + 1]] if v != own]
            out += [(own, v, s) for s, v in sorted(rows)[:k]]
        return pa.RecordBatch.from_arrays([pa.array([int(o[0]) for o in out], pa.int64()), pa.array([int(o[1]) for o in out], pa.int64()), pa.array([float(o[2]) for o in out])], names=["query_id", "vec_id", "score"])

    # Within a task a shard's row comes before the queries, which stream past it.
    met = held.unionByName(asked).repartition(shards + 1, "shard").sortWithinPartitions("shard", F.col("graph").isNull(), "id").select("shard", "graph", "rows", "id", "vector")
    each = met.transform(mapped, found, "query_id long, vec_id long, score double")
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy("score", "vec_id"))
    return each.withColumn("rank", rank).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def nearest_neighbours(vectors: DataFrame, is_query, k: int = 10, id_col: str = "vec_id", vector_col: str = "embedding", shard_rows: int = SHARD, beam: int = BEAM) -> DataFrame:
    """The k nearest rows found for each row that `is_query`, a condition on the column `id`, selects."""
    rows = usable(vectors, id_col, vector_col)
    index = saved(build_index(rows, shard_rows, k + 1, beam), "ann-index")
    return search_index(index, rows.where(is_query), k)

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from ledgerloom.llm.ann import Graph, nearest_neighbours, usable


def brute(rows, asked, k=10):
    out = {}
    ids = np.array([r[0] for r in rows])
    x = np.array([r[1] for r in rows], np.float64)
    for q in asked:
        d = np.sqrt(((x - x[ids == q][0]) ** 2).sum(1))
        out[q] = [(i, s) for s, i in sorted(zip(d.tolist(), ids.tolist(), strict=True)) if i != q][:k]
    return out


@pytest.mark.parametrize("shard_rows", [8192, 60])
def test_recall(spark, sf_dir, shard_rows):
    df = spark.read.parquet(f"{sf_dir}/embeddings.parquet")
    got = {}
    for r in nearest_neighbours(df, F.col("id") % 100 == 0, shard_rows=shard_rows).orderBy("query_id", "rank").collect():
        got.setdefault(r.query_id, []).append((r["rank"], r.vec_id, r.score))
    rows = [(r.vec_id, r.embedding) for r in df.collect()]
    want = brute(rows, [i for i, _ in rows if i % 100 == 0])
    assert set(got) == set(want)
    hits = 0
    for q, found in got.items():
        assert [f[0] for f in found] == list(range(1, 11))
        exact = dict(brute(rows, [q], len(rows))[q])
        assert all(math.isclose(exact[v], s, rel_tol=0, abs_tol=1e-12) for _, v, s in found)
        assert [(s, v) for _, v, s in found] == sorted((s, v) for _, v, s in found)
        hits += len({v for _, v, _ in found} & {v for v, _ in want[q]})
    assert hits >= 0.9 * 10 * len(want)


def test_defined_cases(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [1.0, 0.0]), (100, [1.0, 0.0]), (1, [1.0, 0.0]), (1, [1.0, 0.0]), (2, None), (3, [0.0, 0.0]), (4, [nan, 1.0]), (5, [inf, 1.0]), (6, [None, 1.0]), (7, []), (None, [1.0, 1.0]), (8, [0.0, 2.0]), (200, None)]
    df = spark.createDataFrame(rows, "vec_id bigint, embedding array<float>")
    assert sorted(r.id for r in usable(df).collect()) == [0, 1, 1, 8, 100]
    got = [(r.query_id, r["rank"], r.vec_id, r.score) for r in nearest_neighbours(df, F.col("id") % 100 == 0).orderBy("query_id", "rank").collect()]
    far = math.sqrt(5.0)
    assert got == [(0, 1, 1, 0.0), (0, 2, 100, 0.0), (0, 3, 8, far), (100, 1, 0, 0.0), (100, 2, 1, 0.0), (100, 3, 8, far)]
    assert nearest_neighbours(df.limit(0), F.col("id") % 100 == 0).collect() == []
    assert nearest_neighbours(df.withColumns({"id": F.lit(1), "shard": F.lit(2), "vector": F.lit(3)}), F.col("id") % 100 == 0).count() == 6


def test_a_common_vector(spark):
    rng = np.random.default_rng(2)
    rows = [(i, [0.5, 0.5, 0.5]) for i in range(0, 3000, 3)] + [(i, rng.normal(size=3).tolist()) for i in range(1, 3000, 3)]
    df = spark.createDataFrame(rows, "vec_id bigint, embedding array<double>")
    got = nearest_neighbours(df, F.col("id") % 300 == 0, shard_rows=500).where("query_id = 300").orderBy("rank").collect()
    assert [r.vec_id for r in got] == [0, 3, 6, 9, 12, 15, 18, 21, 24, 27] and all(r.score == 0 for r in got)


def test_lengths_and_repeated_ids(spark):
    """Only vectors of the commonest length take part; of an id with several, the smallest."""
    rows = [(0, [1.0, 0.0]), (1, [1.0, 0.0, 0.0]), (2, [2.0, 0.0]), (3, [1.0]), (4, [3.0, 1.0]), (4, [3.0, 0.0]), (5, [1.0, 0.0, 0.0, 1.0]), (0, [0.5, 9.0])]
    got = nearest_neighbours(spark.createDataFrame(rows, "vec_id bigint, embedding array<double>"), F.col("id") == 0).orderBy("rank").collect()
    first = math.sqrt(1.5**2 + 81)
    assert [(r.vec_id, r.score) for r in got] == [(2, first), (4, math.sqrt(2.5**2 + 81))]
    tie = spark.createDataFrame([(0, [1.0]), (1, [1.0, 2.0])], "vec_id bigint, embedding array<double>")
    assert [r.id for r in usable(tie).collect()] == [0]


def test_graph_is_hierarchical_and_reachable():
    x = np.random.default_rng(1).normal(size=(3000, 16)).astype(np.float32)
    graph = Graph.build(x)
    assert [layer.shape for layer in graph.layers] == [(3000, 32), (187, 16), (11, 16)]
    for layer in graph.layers:
        assert all(len(set(row[row >= 0])) == (row >= 0).sum() and i not in row for i, row in enumerate(layer))
        seen, open_ = {0}, [0]
        while open_:
            for j in layer[open_.pop()].tolist():
                if j >= 0 and j not in seen:
                    seen.add(j)
                    open_.append(j)
        assert len(seen) >= 0.99 * len(layer)
    found = Graph.unpack(graph.pack()).search(x[:200].astype(float), 64)
    assert (found[:, 0] == np.arange(200)).mean() > 0.99
    far = ((x[found] - x[:200, None]) ** 2).sum(2)
    assert (np.diff(far, axis=1) >= -1e-5).all()


@pytest.mark.parametrize("size", [1, 50, 64, 130, 500])
def test_recall_on_clusters(size):
    """Groups of near vectors, larger than the pool that neighbours are chosen from."""
    rng = np.random.default_rng(size)
    centres = rng.normal(size=(6000 // size, 64))
    x = np.repeat(centres, size, 0) + (0.1 * rng.normal(size=(len(centres) * size, 64)) if size > 1 else 0)
    asked = rng.choice(len(x), 100, False)
    found = Graph.build(x.astype(np.float32)).search(x[asked], 128)
    want = np.argsort(((x[asked][:, None] - x[None]) ** 2).sum(2), 1)[:, :10]
    assert np.mean([len(set(f[:10]) & set(w)) / 10 for f, w in zip(found.tolist(), want.tolist(), strict=True)]) >= 0.95


def test_the_beam_follows_the_data():
    """Data of many dimensions need a wider beam than the least; where none does, the shard is searched exhaustively."""
    rng = np.random.default_rng(6)
    x = rng.normal(size=(6000, 128))
    asked = rng.choice(len(x), 60, False)
    want = np.argsort(((x[asked][:, None] - x[None]) ** 2).sum(2), 1)[:, 1:11]

    def recall(graph):
        return np.mean([len(set(f.tolist()) & set(w)) / 10 for f, w in zip(graph.found(x[asked], 20), want.tolist(), strict=True)])

    graph = Graph.build(x)
    graph.beam = 16
    low = np.mean([len(set(f[:11].tolist()) & set(w)) / 10 for f, w in zip(graph.search(x[asked], 16), want.tolist(), strict=True)])
    assert low < 0.9 and graph.measured(16).beam > 16 and recall(graph) >= 0.95
    again = Graph.unpack(graph.pack())
    assert (again.beam, again.scale) == (graph.beam, graph.scale)
    graph.measured(16, recall=1.1)
    assert graph.beam is None and recall(graph) == 1.0


def test_components_beyond_single_precision(spark):
    rows = [(i, [1e200 * (i + 1), 1e200]) for i in range(30)] + [(100, [1e200 * 100, 0.0])]
    got = nearest_neighbours(spark.createDataFrame(rows, "vec_id bigint, embedding array<double>"), F.col("id") == 0, k=3).orderBy("rank").collect()
    assert len(got) == 3
    tiny = [(i, [1e-120 * (i + 1), 1e-120]) for i in range(30)]
    assert [r.vec_id for r in nearest_neighbours(spark.createDataFrame(tiny, "vec_id bigint, embedding array<double>"), F.col("id") == 0, k=3).orderBy("rank").collect()] == [1, 2, 3]


def test_shards_are_bounded_in_bytes(spark, monkeypatch):
    from ledgerloom.llm import ann

    monkeypatch.setattr(ann, "SHARD_BYTES", 12 * 64 * 100)
    rng = np.random.default_rng(8)
    rows = [(i, v.tolist()) for i, v in enumerate(rng.normal(size=(500, 64)))]
    index = ann.build_index(usable(spark.createDataFrame(rows, "vec_id bigint, embedding array<float>")))
    assert index.select("shard").distinct().count() == 5

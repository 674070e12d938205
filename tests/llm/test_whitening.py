import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from ledgerloom.llm import queries
from ledgerloom.llm.whitening import _deviations, fit_components, integral, whiten

SCHEMA = "vec_id bigint, embedding array<float>"


def brute(rows, k=4):
    """(n, deviations by id, projections by id, eigenvalues, trace) by numpy, from the whole covariance."""
    good = [(i, [float(np.float32(c)) for c in v]) for i, v in rows if v is not None and all(c is not None and math.isfinite(c) for c in v)]
    x = [(i, [math.floor(256 * c) for c in v]) for i, v in good]
    fit = np.array(sorted({tuple(v) for _, v in x}))
    n, sums = len(fit), [int(s) for s in fit.sum(0)]
    centred = fit - np.array([s / n for s in sums])
    values, vectors = np.linalg.eigh(centred.T @ centred / n)
    values, vectors = values[::-1], vectors[:, ::-1][:, :k]
    deviations = {i: sum((n * c - s) ** 2 for c, s in zip(v, sums, strict=True)) for i, v in x}
    white = {i: (np.array(v) - np.array([s / n for s in sums])) @ vectors / np.sqrt(values[:k]) for i, v in x}
    return n, deviations, white, values, centred, vectors


def check(df, rows, k=4):
    n, deviations, white, values, centred, _ = brute(rows, k)
    got = df.collect()
    assert len(got) == k * len(deviations) and {r.n for r in got} == {n}
    signs = {}
    for c in range(1, k + 1):
        mine = {r.vec_id: r for r in got if r.component == c}
        assert {i: r.deviation for i, r in mine.items()} == deviations
        ids = sorted(white)
        a, b = np.array([mine[i].whitened for i in ids]), np.array([white[i][c - 1] for i in ids])
        signs[c] = np.sign(a @ b)
        assert np.abs(a * signs[c] - b).max() < 1e-8
        assert {r.explained for r in mine.values()} == {next(iter(mine.values())).explained}
        assert math.isclose(next(iter(mine.values())).explained, values[c - 1] / values.sum(), rel_tol=1e-9)
    assert {r.identity_error for r in got} == {got[0].identity_error} and got[0].identity_error < 1e-9


@pytest.mark.parametrize("sf", ["sf0.001", "sf0.01"])
def test_query_equals_numpy(spark, sf):
    folder = f"/root/testdata/{sf}"
    rows = [(r.vec_id, r.embedding) for r in spark.read.parquet(f"{folder}/embeddings.parquet").collect()]
    check(queries.op13_whitening(spark, folder), rows)


def test_range_finder_suffices_where_the_spectrum_falls(spark):
    """Forty dimensions of which few carry the variance: no pass takes all dimensions, and the result is as exact."""
    rng = np.random.default_rng(3)
    scales = 8.0 * 0.35 ** np.arange(40)
    turn = np.linalg.qr(rng.standard_normal((40, 40)))[0]
    data = (rng.standard_normal((600, 40)) * scales @ turn).astype(np.float32)
    rows = [(i, [float(c) for c in v]) for i, v in enumerate(data)]
    df = spark.createDataFrame(rows, SCHEMA)
    check(whiten(df), rows)
    widths = []
    import ledgerloom.llm.whitening as W

    kept = W._summed
    try:
        W._summed = lambda fit, width, partial, shape: widths.append(shape) or kept(fit, width, partial, shape)
        x, width = integral(df)
        fit_components(x.select("x").distinct(), width)
    finally:
        W._summed = kept
    assert max(w for _, w in widths) < 40


def test_flat_spectra_take_all_dimensions(spark):
    rng = np.random.default_rng(4)
    rows = [(i, [float(np.float32(c)) for c in v]) for i, v in enumerate(rng.standard_normal((500, 32)))]
    check(whiten(spark.createDataFrame(rows, SCHEMA)), rows)
    check(whiten(spark.createDataFrame(rows, SCHEMA), passes=0), rows)


def test_copies_count_once_and_odd_rows_stay_out(spark):
    rng = np.random.default_rng(5)
    rows = [(i, [float(np.float32(c)) for c in v]) for i, v in enumerate(rng.standard_normal((60, 6)))]
    rows += [(100 + i, rows[0][1]) for i in range(90)]
    rows += [(200, None), (201, [1.0, None, 0.0, 0.0, 0.0, 0.0]), (202, [float("nan")] * 6), (203, [float("inf")] + [0.0] * 5), (204, [-0.0] * 6)]
    df = spark.createDataFrame(rows, SCHEMA).withColumns({n: F.lit(1) for n in ("x", "v", "id", "n", "component", "i", "s", "task", "block")})
    check(whiten(df), rows)


def test_defined_cases(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert whiten(empty).collect() == [] and len(whiten(empty).columns) == 7
    assert whiten(spark.createDataFrame([(1, []), (2, None)], SCHEMA)).collect() == []
    one = whiten(spark.createDataFrame([(None, [1.0, 2.0]), (5, [1.0, 2.0])], SCHEMA)).collect()
    assert len(one) == 4 and {(r.n, r.deviation, r.whitened, r.explained, r.identity_error) for r in one} == {(1, 0, None, None, None)}
    line = whiten(spark.createDataFrame([(i, [float(i), 2.0 * i, 0.0]) for i in range(5)], SCHEMA)).collect()
    assert {r.whitened is None for r in line if r.component == 1} == {False} and {r.whitened for r in line if r.component > 1} == {None}
    short = whiten(spark.createDataFrame([(1, [1.0]), (2, [0.0, 1.0]), (3, [1.0, 0.0])], SCHEMA)).collect()
    assert {r.n for r in short} == {2} and {r.deviation for r in short if r.vec_id == 1} == {r.deviation for r in short if r.vec_id == 3}


def test_deviations_are_exact_or_null():
    big = np.array([[2**40, -(2**40)], [1, 2], [3037, -3037]])
    sums = (10**12, 7)
    want = [sum((1000 * int(c) - s) ** 2 for c, s in zip(row, sums, strict=True)) for row in big]
    assert _deviations(big, 1000, sums) == [w if w < 2**63 else None for w in want]
    assert _deviations(np.array([[3, 4]]), 10, (25, 25)) == [25 + 225]

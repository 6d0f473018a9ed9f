import math
from fractions import Fraction

import numpy as np
import pytest

from innsight.llm import whitening


def brute(rows, weights="one"):
    """{id: [(deviation, whitened...)]}, eigenvalues and n, by exact sums and one dense matrix."""
    numbers = {i: tuple(math.floor(64 * float(c)) + 1_000_000 for c in v) for i, v in rows if v and all(c is not None and math.isfinite(c) for c in v)}
    copies = list(numbers.values())
    distinct = sorted(set(copies))
    weight = [copies.count(x) if weights == "count" else 1 for x in distinct]
    n, dims = sum(weight), len(distinct[0])
    sums = [sum(w * x[j] for x, w in zip(distinct, weight)) for j in range(dims)]
    centred = lambda x: np.array([float(Fraction(n * v - s, n)) for v, s in zip(x, sums)])
    c, w = np.stack([centred(x) for x in distinct]), np.array(weight, float)
    values, vectors = np.linalg.eigh((c * w[:, None]).T @ c / n)
    values, vectors = values[::-1], vectors[:, ::-1]
    deviation = {i: sum((n * v - s) ** 2 for v, s in zip(x, sums)) for i, x in numbers.items()}
    return n, values, {i: centred(x) @ vectors / np.sqrt(np.maximum(values, 1e-300)) for i, x in numbers.items()}, deviation


def compare(df, rows, weights="one", most=16):
    n, values, z, deviation = brute(rows, weights)
    got = whitening.whiten(df, weights=weights).collect()
    k = min(most, int((values > 1e-11 * values[0]).sum()))
    assert {(r.vec_id, r.component) for r in got} == {(i, c) for i in z for c in range(1, k + 1)} and len(got) == k * len(z)
    signs = {}
    for r in got:
        want = z[r.vec_id][r.component - 1]
        if abs(want) > 1e-3:
            signs.setdefault(r.component, set()).add(np.sign(want * r.whitened))
        assert abs(abs(r.whitened) - abs(want)) < 1e-6 * max(1, abs(want))
        assert r.n == n and r.deviation == deviation[r.vec_id]
        assert math.isclose(r.explained, values[r.component - 1] / values.sum(), rel_tol=1e-9) and 0 <= r.identity_error < 1e-6
    assert all(len(s) == 1 for s in signs.values())


def test_whole_table_equals_a_dense_covariance(spark):
    df = spark.read.parquet("/root/testdata/sf0.001/embeddings.parquet")
    compare(df, [(r.vec_id, r.embedding) for r in df.collect()])


@pytest.mark.parametrize("weights", ["one", "count"])
def test_copies_count_once_or_each(spark, weights):
    rng = np.random.default_rng(3)
    rows = [(i, [float(v) for v in rng.normal(size=5)]) for i in range(60)]
    rows += [(100 + k, rows[k % 3][1]) for k in range(40)] + [(200, [v + 1e-9 for v in rows[0][1]])]
    compare(spark.createDataFrame(rows, "vec_id long, embedding array<double>"), rows, weights)


def test_odd_rows_take_no_part(spark):
    good = [(k, [float(k % 3), float(k % 4), -2.5 * k]) for k in range(9)]
    odd = [(20, None), (21, []), (22, [1.0, None, 2.0]), (23, [1.0, float("nan"), 2.0]), (24, [float("inf"), 0.0, 1.0]), (25, [1.0, 2.0]), (26, [1e300, 0.0, 0.0])]
    df = spark.createDataFrame(good + odd, "vec_id long, embedding array<double>").selectExpr("*", "1 AS n", "2 AS component", "3 AS x", "4 AS print")
    compare(df, good)
    twice = spark.createDataFrame([(None, [0.0, 1.0]), (1, [1.0, 0.0]), (1, [1.0, 0.0])], "vec_id long, embedding array<float>")
    assert sorted(str(r.vec_id) for r in whitening.whiten(twice).collect()) == ["1", "1", "None"]


def test_nothing_to_whiten(spark):
    one = spark.createDataFrame([(1, [1.0, 2.0]), (2, [1.0, 2.0])], "vec_id long, embedding array<double>")
    empty = whitening.whiten(one.limit(0))
    assert whitening.whiten(one).collect() == [] and empty.collect() == []
    assert empty.columns == ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"]


def test_sums_are_exact_for_large_entries(spark):
    rows = [(1, [1e15, 3.0]), (2, [-1e15, 5.0]), (3, [1e15 - 64, 7.0])]
    n, values, z, deviation = brute(rows)
    got = whitening.whiten(spark.createDataFrame(rows, "vec_id long, embedding array<double>")).collect()
    assert {r.deviation for r in got} == {None} and all(v > 2**63 for v in deviation.values())
    vectors = whitening._lists(spark.createDataFrame(rows, "vec_id long, embedding array<double>"), "vec_id", "embedding")
    assert whitening._totals(whitening.distinct_vectors(vectors, 2), 2) == (3, [sum(math.floor(64 * v[j]) + 1_000_000 for _, v in rows) for j in (0, 1)])

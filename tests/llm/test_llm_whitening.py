"""Whitening against a dense eigendecomposition, and the iteration against matrices with known pairs."""

import math

import numpy as np
import pytest
from conftest import SMALL, rows
from pyspark.sql import functions as F

from millrace.llm import whitening
from millrace.llm.queries import QUERIES

ROWS = "vec_id bigint, embedding array<double>"


def expected(vectors, wanted=4):
    """(n, deviations, eigenvalues, vectors, trace) by numpy over the distinct x vectors."""
    x = np.floor(np.array(vectors, float) * 256).astype(np.int64)
    fit = np.unique(x, axis=0)
    n, sums = len(fit), fit.sum(axis=0)
    centred = fit - sums / n
    values, axes = np.linalg.eigh(centred.T @ centred / n)
    whitened = (x - sums / n) @ axes[:, ::-1][:, :wanted] / np.sqrt(values[::-1][:wanted])
    return n, ((n * x - sums) ** 2).sum(axis=1), values[::-1], whitened


def held_against(found, ids, vectors, wanted=4):
    n, deviations, values, whitened = expected(vectors, wanted)
    got = {(r["vec_id"], r["component"]): r for r in found}
    assert len(got) == len(found) == len(ids) * wanted
    signs = [1.0] * wanted
    for k in range(wanted):
        at = int(np.abs(whitened[:, k]).argmax())
        signs[k] = math.copysign(1, got[ids[at], k + 1]["whitened"] * whitened[at, k])
    for i, vec in enumerate(ids):
        for k in range(wanted):
            r = got[vec, k + 1]
            assert r["n"] == n and r["deviation"] == deviations[i]
            assert r["whitened"] * signs[k] == pytest.approx(whitened[i, k], abs=1e-8)
            assert r["explained"] == pytest.approx(values[k] / values.sum(), rel=1e-9)
            assert r["identity_error"] < 1e-9


@pytest.mark.parametrize("dims", [1, 2, 5, 30, 120])
def test_leading_pairs(dims):
    chance = np.random.default_rng(dims)
    turn, _ = np.linalg.qr(chance.standard_normal((dims, dims)))
    values = np.sort(chance.uniform(0, 10, dims))[::-1]
    matrix = turn * values @ turn.T
    asked = []

    def product(v):
        asked.append(v.shape[1])
        return matrix @ v

    found, vectors = whitening.leading(product, dims)
    k = min(4, dims)
    assert found == pytest.approx(values[:k], rel=1e-12)
    assert np.abs(vectors.T @ vectors - np.eye(k)).max() < 1e-13
    assert np.linalg.norm(matrix @ vectors - vectors * found, axis=0).max() < 1e-12 * values[0]
    assert max(asked) <= max(6, k)  # a block of vectors at most; the matrix itself is never asked for


def test_leading_pairs_of_tied_and_missing_eigenvalues():
    for values in ([5.0] * 10, [3.0, 3.0, 3.0, 3.0, 3.0, 1.0, 0.0, 0.0], [7.0, 0.0, 0.0, 0.0, 0.0, 0.0], [0.0] * 6):
        turn, _ = np.linalg.qr(np.random.default_rng(3).standard_normal((len(values), len(values))))
        matrix = turn * values @ turn.T
        found, vectors = whitening.leading(lambda v, m=matrix: m @ v, len(values))
        assert found == pytest.approx(values[:4], abs=1e-12)
        assert np.linalg.norm(matrix @ vectors - vectors * found, axis=0).max() < 1e-12


def test_minres_solves_the_projected_equation():
    chance = np.random.default_rng(8)
    a = chance.standard_normal((9, 9))
    a = a + a.T
    u = np.linalg.qr(chance.standard_normal((9, 2)))[0]
    rhs = chance.standard_normal(9)
    rhs -= u @ (u.T @ rhs)
    solver = whitening._minres(rhs, 0.3, u, 40)
    asked = solver.send(None)
    with pytest.raises(StopIteration) as end:
        while True:
            asked = solver.send(a @ asked)
    t = end.value.value
    left = a @ t - 0.3 * t
    assert np.linalg.norm(left - u @ (u.T @ left) - rhs) < 2e-3 * np.linalg.norm(rhs)
    assert np.abs(u.T @ t).max() < 1e-12


def test_query_equals_dense_decomposition(spark):
    table = spark.read.parquet(f"{SMALL}/embeddings.parquet").select("vec_id", "embedding").toPandas()
    found = QUERIES["op11_whitening"](spark, SMALL).collect()
    held_against(found, table["vec_id"].tolist(), table["embedding"].tolist())


def test_copies_count_once_and_bad_vectors_go(spark):
    chance = np.random.default_rng(5)
    vectors = (chance.standard_normal((40, 6)) * [5, 4, 3, 2, 1, 1] + 100).tolist()
    vectors += [vectors[0]] * 30 + [[v + 1e-9 for v in vectors[1]]]
    good = [(i, v) for i, v in enumerate(vectors)]
    bad = [(900, None), (901, [1.0, None, 2.0, 3.0, 4.0, 5.0]), (902, [float("nan")] * 6), (903, [1.0, float("inf")] + [0.0] * 4), (904, [float("-inf")] * 6)]
    df = spark.createDataFrame(good + bad, ROWS).repartition(5)
    extra = df.withColumns({"x": F.lit("x"), "component": F.lit(7), "rows": F.lit(None).cast("int")})
    held_against(whitening.whiten(extra).collect(), [i for i, _ in good], vectors)


def test_no_rows_without_directions(spark):
    for data in ([], [(1, None)], [(1, [])], [(1, [1.0, 2.0])], [(1, [1.0, 2.0]), (2, [1.0, 2.0])]):
        found = whitening.whiten(spark.createDataFrame(data, ROWS))
        assert found.count() == 0 and [f.name for f in found.schema] == [f.split()[0] for f in whitening.OUTPUT.split(", ")]


def test_lower_rank_short_vectors_and_null_ids(spark):
    data = [(None, [1.0, 2.0, 0.0]), (None, [1.0, 2.0, 0.0]), (2, [3.0, 2.0]), (3, [5.0, 2.0, 0.0, 0.0])]
    found = rows(whitening.whiten(spark.createDataFrame(data, ROWS)))
    assert [r[1] for r in found] == [1] * 4  # one direction only
    assert sorted(abs(r[4]) for r in found) == pytest.approx([0.0, 1.2247448, 1.2247448, 1.2247448], abs=1e-6)
    assert {r[2] for r in found} == {3} and {round(r[5], 12) for r in found} == {1.0}


def test_entries_and_deviations_beyond_long(spark):
    data = [(1, [1e300, 1.0]), (2, [-1e300, 2.0]), (3, [0.0, 4.0])]
    found = {r["vec_id"]: r["deviation"] for r in whitening.whiten(spark.createDataFrame(data, ROWS), wanted=1).collect()}
    assert found == {1: None, 2: None, 3: 1638401}  # entries are cut to long, sums stay exact: S = (-1, 7 * 256)

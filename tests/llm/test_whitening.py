"""Whitening against numpy's eigenvectors, exact integers and awkward vectors."""

import numpy as np
import pytest

from tickloom.llm import queries, whitening

SMALL = "/root/testdata/sf0.001"


def symmetric(values, seed=0):
    q, _ = np.linalg.qr(np.random.default_rng(seed).normal(size=(len(values),) * 2))
    return (q * np.array(values, float)) @ q.T


@pytest.mark.parametrize(
    "values",
    [
        [5.0], [2, 1], [3, 3], np.arange(1, 41), [1e12, 1e6, 1, 1e-3, 1e-3], [1, 1, 1, 1, 1e-9], [4, 4, 4, 2, 2, 0, 0],
        np.geomspace(1, 1e10, 64), [-1, 0, 1], 1 + np.arange(30) * 1e-9, [7, 7, 7, 7],
    ],
)
def test_components_are_eigenvectors(values):
    a = symmetric(values)
    a = (a + a.T) / 2
    found, axes = whitening.components(a, 8)
    want = np.sort(np.linalg.eigvalsh(a))[::-1][:8]
    size = np.linalg.norm(a)
    assert np.allclose(found, want, rtol=0, atol=1e-13 * size * len(a))
    assert np.allclose(axes.T @ axes, np.eye(len(found)), atol=1e-13 * len(a))
    assert np.abs(a @ axes - axes * found).max() < 1e-13 * size * len(a)


def test_polar_factor():
    a = symmetric([3, 1e-6, -2, -1e-9, 40])
    u = whitening.polar(a)
    values, vectors = np.linalg.eigh(a)
    assert np.allclose(u, (vectors * np.sign(values)) @ vectors.T, atol=1e-6)


def brute(vectors):
    """vec_id -> (n, deviation, whitened, explained) in order of appearance, up to sign."""
    kept = [(i, v) for i, v in vectors if v is not None and all(c is not None and np.isfinite(c) for c in v)]
    x = [[int(np.floor(1024 * float(c))) + 100_000 for c in v] for _, v in kept]
    n, sums = len(x), [sum(c) for c in zip(*x)]
    off = np.array([[a - s / n for a, s in zip(r, sums)] for r in x])
    values, axes = np.linalg.eigh(off.T @ off / n)
    order = np.argsort(-values)[:8]
    white = off @ axes[:, order] / np.sqrt(values[order])
    deviations = [sum((n * a - s) ** 2 for a, s in zip(r, sums)) for r in x]
    return n, [(i, d, w) for (i, _), d, w in zip(kept, deviations, white)], values[order] / values.sum()


def test_embeddings_by_definition(spark):
    vectors = [(r["vec_id"], r["embedding"]) for r in spark.read.parquet(f"{SMALL}/embeddings.parquet").collect()]
    n, want, explained = brute(vectors)
    found = queries.QUERIES["op12_whitening"](spark, SMALL).toPandas()
    assert len(found) == 8 * n and (found["n"] == n).all() and found["identity_error"].max() < 1e-9
    table = found.pivot(index="vec_id", columns="component", values="whitened")
    mine, theirs = table.loc[[i for i, _, _ in want]].to_numpy(), np.array([w for _, _, w in want])
    assert np.allclose(mine, theirs * np.sign((mine * theirs).sum(axis=0)), atol=1e-8)
    assert found.drop_duplicates("vec_id").set_index("vec_id")["deviation"].to_dict() == {i: d for i, d, _ in want}
    assert np.allclose(found.groupby("component")["explained"].first(), explained, rtol=1e-9)


FORM = "vec_id long, embedding array<float>, component int, n long, whitened double, place int"


def test_awkward_vectors(spark):
    rng, nan = np.random.default_rng(3), float("nan")
    good = [(k, [float(np.float32(c)) for c in rng.normal(size=3)]) for k in range(50)] + [(None, [0.0, 1.0, 2.0]), (3, [1.0, 1.0, 1.0])]
    bad = [(60, None), (61, [1.0, None, 2.0]), (62, [nan, 0.0, 0.0]), (63, [float("inf"), 0.0, 0.0]), (64, [1.0, 2.0]), (65, [])]
    df = spark.createDataFrame([(i, v, 1, 1, 1.0, 1) for i, v in good + bad], FORM)
    found = whitening.components_of_rows(whitening.whiten(df)).collect()
    n, want, _ = brute(good)
    assert n == 52 and len(found) == 3 * n and {r["n"] for r in found} == {n}
    assert sorted(r["deviation"] for r in found) == sorted(d for _, d, _ in want for _ in range(3))
    assert all(r["identity_error"] < 1e-9 for r in found)
    assert whitening.whiten(df.limit(0)).count() == 0
    assert whitening.whiten(df.where("vec_id >= 60 and vec_id < 64")).count() == 0
    same = spark.createDataFrame([(k, [1.0, 2.0]) for k in range(5)], "vec_id long, embedding array<float>")
    assert whitening.whiten(same).count() == 0
    flat = spark.createDataFrame([(k, [float(k), 2.0]) for k in range(5)], "vec_id long, embedding array<double>")
    assert {r["component"] for r in whitening.components_of_rows(whitening.whiten(flat)).collect()} == {1}


def test_large_entries_stay_exact(spark):
    vectors = [(k, [float(2**39 * (k % 3)), 1e300 if k == 4 else float(k)]) for k in range(9)]
    df = spark.createDataFrame(vectors, "vec_id long, embedding array<double>")
    found = {r["vec_id"]: r["deviation"] for r in whitening.whiten(df).collect()}
    x = [[int(np.floor(1024 * min(c, 2.0**40))) + 100_000 for c in v] for _, v in vectors]
    sums = [sum(c) for c in zip(*x)]
    exact = [sum((9 * a - s) ** 2 for a, s in zip(r, sums)) for r in x]
    assert found == {k: d if d < 2**63 else None for k, d in enumerate(exact)}

"""Spectrum slicing against a plain eigensolver; whitening against a plain computation."""

import math
from fractions import Fraction

import numpy as np
import pytest

from starloom.llm import catalog, whitening

COLUMNS = "vec_id long, embedding array<float>, component int, n string"


def symmetric(values, seed=0):
    q, _ = np.linalg.qr(np.random.default_rng(seed).standard_normal((len(values), len(values))))
    a = (q * np.array(values, dtype=float)) @ q.T
    return (a + a.T) / 2


@pytest.mark.parametrize("size", [1, 2, 3, 8, 33])
def test_inertia_counts_signs(size):
    rng = np.random.default_rng(size)
    for _ in range(30):
        a = rng.standard_normal((size, size))
        a = a + a.T
        values = np.linalg.eigvalsh(a)
        assert whitening.inertia(a) == ((values > 0).sum(), (values < 0).sum(), 0)
    assert whitening.inertia(np.zeros((size, size))) == (0, 0, size)
    assert whitening.inertia(np.array([[0.0, 1], [1, 0]])) == (1, 1, 0)


@pytest.mark.parametrize(
    "values",
    [
        [5, 4, 3, 2, 1], list(range(1, 65)), [1, 1 - 1e-9, 1 - 2e-9, 0.5, 0.1], [3, 3, 3, 1, 1, 0, 0], [7] * 6,
        [1e12, 1, 1e-3, 1e-9], [1e-30, 2e-30, 3e-30], [4], [2, 0], [1 + k * 1e-13 for k in range(9)],
    ],
)
def test_leading_eigenpairs(values):
    a = symmetric(values)
    found, vectors = whitening.leading_eigenpairs(a, 8)
    want = np.linalg.eigvalsh(a)[::-1]
    above = int((want > 8 * len(want) * np.finfo(float).eps * np.abs(a).sum(axis=1).max()).sum())
    assert len(found) == min(8, above)
    assert np.allclose(found, want[: len(found)], rtol=1e-9, atol=1e-13 * want[0])
    assert np.allclose(vectors.T @ vectors, np.eye(len(found)), atol=1e-12)
    assert np.allclose(a @ vectors, vectors * found, atol=1e-12 * want[0])


def test_no_spread():
    assert len(whitening.leading_eigenpairs(np.zeros((4, 4)), 8)[0]) == 0
    assert len(whitening.leading_eigenpairs(np.zeros((0, 0)), 8)[0]) == 0


def usable(rows):
    good = [r for r in rows if r[1] and all(c is not None and math.isfinite(c) for c in r[1])]
    return [(r[0], [math.floor(1024 * float(np.float32(c))) + 100_000 for c in r[1]]) for r in good]


def check(df, rows, components=8):
    kept = usable(rows)
    n, size = len(kept), len(kept[0][1])
    sums = [sum(x[i] for _, x in kept) for i in range(size)]
    exact = [[Fraction(x[i]) - Fraction(sums[i], n) for i in range(size)] for _, x in kept]
    y = np.array([[float(c) for c in x] for x in exact])
    values, vectors = np.linalg.eigh(y.T @ y / n)
    values, vectors = values[::-1], vectors[:, ::-1]
    count = min(components, int((values > 1e-9 * values[0]).sum()))
    got = df.collect()
    assert len(got) == n * count
    found = {k: [] for k in range(1, count + 1)}
    deviations = sorted((k, sum((n * a - s) ** 2 for a, s in zip(x, sums, strict=True))) for k, x in kept)
    for k in found:
        mine = sorted((r for r in got if r["component"] == k), key=lambda r: (r["vec_id"], r["deviation"]))
        assert [(r["vec_id"], int(r["deviation"])) for r in mine] == deviations
        assert {r["n"] for r in mine} == {n}
        assert mine[0]["explained"] == pytest.approx(values[k - 1] / values.sum(), rel=1e-9)
        want = (y @ vectors[:, k - 1]) / math.sqrt(values[k - 1])
        order = sorted(range(n), key=lambda i: (kept[i][0], sum((n * a - s) ** 2 for a, s in zip(kept[i][1], sums, strict=True))))
        have = np.array([r["whitened"] for r in mine])
        want = want[order]
        assert min(np.abs(have - want).max(), np.abs(have + want).max()) < 1e-7
    (error,) = {r["identity_error"] for r in got}
    assert error < 1e-9


@pytest.mark.parametrize("parts", [1, 5])
def test_whitening_matches_a_plain_computation(spark, parts):
    rng = np.random.default_rng(3)
    spread = symmetric(np.geomspace(1, 0.05, 12), 4)
    rows = [(k, [float(c) for c in rng.standard_normal(12) @ spread]) for k in range(300)]
    odd = [(900, None), (901, [None] * 12), (902, [float("nan")] * 12), (903, [float("inf")] + [0.0] * 11),
           (904, []), (905, [0.5, 0.25])]
    repeated = [(7, rows[7][1])] * 3
    df = spark.createDataFrame([(*r, 1, "x") for r in rows + odd + repeated], COLUMNS).repartition(parts)
    # ties of one id have one deviation
    check(whitening.whiten(df), rows + repeated)


def test_exact_sums_of_large_entries(spark):
    rng = np.random.default_rng(5)
    rows = [(k, [float(np.float32(c)) for c in rng.standard_normal(3) * 1e9]) for k in range(50)]
    check(whitening.whiten(spark.createDataFrame([(*r, 1, "x") for r in rows], COLUMNS)), rows)
    y = (rng.standard_normal((20, 3)) * 2**40).astype(np.int64)
    assert (whitening._products(y) == y.astype(object).T @ y.astype(object)).all()


def test_few_dimensions_equal_vectors_and_no_rows(spark):
    rows = [(1, [0.5, 1.0]), (2, [0.25, -1.0]), (3, [0.0, 0.75])]
    df = spark.createDataFrame([(*r, 1, "x") for r in rows], COLUMNS)
    check(whitening.whiten(df), rows)
    for few in (df.limit(0), df.filter("vec_id = 1"), df.limit(1).union(df.limit(1))):
        out = whitening.whiten(few)
        assert out.collect() == [] and out.dtypes == whitening.whiten(df).dtypes


def test_registered_query(spark):
    sf_dir = "/root/testdata/sf0.001"
    rows = [tuple(r) for r in spark.read.parquet(f"{sf_dir}/embeddings.parquet").select("vec_id", "embedding").collect()]
    df = catalog.ALL["op12_whitening"].build(spark, sf_dir)
    assert dict(df.dtypes)["deviation"] == "bigint" and df.filter("component = 8").count() == len(rows)
    check(df, rows)

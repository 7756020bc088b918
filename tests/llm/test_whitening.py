"""Whitening against a dense eigensolver and exact whole numbers."""

from __future__ import annotations

import numpy as np
import pytest

from scalargrid.llm import whitening
from scalargrid.llm.whitening import Covariance, components, whole_vectors

SCHEMA = "vec_id long, embedding array<float>, n int, component string, x binary, ids int"


def stored(spark, tmp_path, rows, name="v"):
    path = str(tmp_path / f"{name}.parquet")
    spark.createDataFrame([(i, v, 1, "c", b"", None) for i, v in rows], SCHEMA).repartition(3).write.parquet(path)
    return spark.read.parquet(path)


def whole(vectors):
    return np.floor(64 * np.array(vectors, np.float32).astype(float)).astype(np.int64) + 1_000_000


def dense(x):
    z = x - x.mean(axis=0)
    values, vectors = np.linalg.eigh(z.T @ z / len(x))
    return z, values[::-1], vectors[:, ::-1]


def check(rows, ids, x, same_ids=True):
    z, values, vectors = dense(x)
    n, k = len(x), min(32, int((values > 1e-10 * values[0]).sum()))
    assert len(rows) == n * k and {r["n"] for r in rows} == {n}
    by = sorted(rows, key=lambda r: (r["component"], r["vec_id"]))
    got = np.array([r["whitened"] for r in by]).reshape(k, n)
    order = np.argsort(ids, kind="stable")
    assert np.allclose([r["explained"] for r in by][::n], values[:k] / values.sum(), rtol=1e-9)
    assert max(r["identity_error"] for r in rows) < 1e-9
    assert np.abs(got @ got.T / n - np.eye(k)).max() < 1e-9
    sums = [int(s) for s in x.sum(axis=0)]
    exact = [sum((n * int(a) - s) ** 2 for a, s in zip(row, sums, strict=True)) for row in x]
    assert [r["deviation"] for r in by][:n] == [exact[i] for i in order]
    want = (z[order] @ vectors[:, :k] / np.sqrt(values[:k])).T
    for c in range(k):
        gap = min(abs(values[c] - values[j]) for j in range(len(values)) if j != c)
        if gap > 1e-3 * values[0]:
            assert min(np.abs(got[c] - want[c]).max(), np.abs(got[c] + want[c]).max()) < 1e-7, c
    return got


@pytest.mark.parametrize("sf", ["sf0.001", "sf0.01"])
def test_query(spark, sf):
    table = spark.read.parquet(f"/root/testdata/{sf}/embeddings.parquet").select("vec_id", "embedding").collect()
    rows = whitening.op11_chebyshev_whitening(spark, f"/root/testdata/{sf}").collect()
    check(rows, [r["vec_id"] for r in table], whole([r["embedding"] for r in table]))


def test_certificate_takes_few_passes(spark):
    vectors = whole_vectors(spark.read.parquet("/root/testdata/sf0.1/embeddings.parquet"))
    cov = Covariance(vectors)
    found = components(cov)
    assert found.residual <= whitening.TOLERANCE * found.values[0] and len(found.values) == 32 and found.passes <= 90


def test_odd_vectors(spark, tmp_path):
    rng = np.random.default_rng(3)
    good = rng.standard_normal((40, 6)).astype(np.float32).tolist()
    odd = [None, [], [1.0] * 5, [1.0] * 7, [None, *[1.0] * 5], [float("nan"), *[1.0] * 5], [float("inf"), *[1.0] * 5], [-1e30, *[1.0] * 5]]
    rows = [(i, v) for i, v in enumerate(good)] + [(100 + i, v) for i, v in enumerate(odd)] + [(5, good[5])]
    got = whitening.whitened(stored(spark, tmp_path, rows)).collect()
    assert {r["vec_id"] for r in got} == set(range(40))
    ids = [*range(40), 5]
    check([dict(r.asDict()) for r in got], ids, whole([good[i] for i in ids]))
    one = stored(spark, tmp_path, [(None, good[0]), (1, good[1]), (2, good[2])], "few")
    few = whitening.whitened(one).collect()
    assert {r["component"] for r in few} == {1, 2} and len(few) == 6 and None in {r["vec_id"] for r in few}


def test_no_scale(spark, tmp_path):
    for name, rows in (("none", []), ("nulls", [(1, None), (2, [])]), ("single", [(1, [1.0, 2.0])]), ("equal", [(1, [1.0, 2.0])] * 9)):
        got = whitening.whitened(stored(spark, tmp_path, rows, name))
        assert got.count() == 0 and got.columns[0] == "vec_id"


def test_low_rank_ties_and_wide_spectra(spark, tmp_path):
    rng = np.random.default_rng(4)
    # Rank 5 in 60 dimensions, then scales from 1 to 4000, then a spectrum of ties (plus and minus unit vectors).
    low = (rng.integers(-40, 40, (300, 5)) @ rng.integers(-3, 4, (5, 60))).astype(float) / 64
    wide = rng.standard_normal((400, 60)) * np.geomspace(1, 4000, 60)
    ties = np.concatenate([np.eye(60), -np.eye(60)]) * 8
    for name, v in (("low", low), ("wide", wide), ("ties", ties)):
        rows = [(i, r) for i, r in enumerate(v.tolist())]
        got = whitening.whitened(stored(spark, tmp_path, rows, name)).collect()
        check(got, list(range(len(v))), whole(v))


def test_many_tasks_add_up_in_groups(spark, monkeypatch):
    monkeypatch.setattr(whitening, "FAN", 1)
    vectors = whole_vectors(spark.read.parquet("/root/testdata/sf0.01/embeddings.parquet").repartition(7))
    x = whole([r["embedding"] for r in spark.read.parquet("/root/testdata/sf0.01/embeddings.parquet").collect()])
    assert vectors.n == len(x) and [s + 1_000_000 * len(x) for s in vectors.sums] == x.sum(axis=0).tolist()
    z, _, _ = dense(x)
    q = np.eye(64)[:, :5]
    assert np.allclose(Covariance(vectors).times(q), z.T @ z[:, :5] / len(x), rtol=1e-12, atol=1e-10)

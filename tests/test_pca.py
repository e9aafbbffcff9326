"""Principal components against numpy's eigenvectors."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from textmill.operators import clusters as CL
from textmill.plans import catalog as C

SF001 = "/root/testdata/sf0.001"


def exact(x, k):
    values, vectors = np.linalg.eigh(np.cov(x.T))
    return values[::-1][:k], vectors[:, ::-1][:, :k]


@pytest.mark.parametrize("d,width", [(20, 64), (120, 13)])
def test_subspace(spark, d, width):
    rng = np.random.default_rng(1)
    x = rng.standard_normal((600, d)) * np.concatenate(([9, 7, 5], np.linspace(2, 0.1, d - 3))) @ np.linalg.qr(rng.standard_normal((d, d)))[0] + 3
    df = spark.createDataFrame([(k, v.tolist()) for k, v in enumerate(x)], "vec_id long, v array<double>").repartition(5)
    model, out = CL.pca(df, "v", 3, width=width)
    values, want = exact(x, 3)
    assert np.linalg.norm(want - model.components @ (model.components.T @ want), 2) < 1e-3
    assert np.allclose(model.variances, values, rtol=1e-3) and model.rows == 600
    assert (model.passes == 1) == (width >= d)
    assert all(c[np.abs(c).argmax()] > 0 for c in model.components.T)
    for r in out.collect():
        assert np.allclose(r.projection, (x[r.vec_id] - x.mean(axis=0)) @ model.components, atol=1e-8)


def test_query_is_exact(spark):
    rows = spark.read.parquet(f"{SF001}/embeddings.parquet").select("vec_id", "embedding").collect()
    x = np.array([r.embedding for r in rows], float)
    _, want = exact(x, 3)
    want = want * np.where(want[np.abs(want).argmax(axis=0), np.arange(3)] < 0, -1, 1)
    got = {r.vec_id: r.projection for r in C.q_embedding_pca(spark, SF001).collect()}
    assert len(got) == len(rows)
    assert np.allclose([got[r.vec_id] for r in rows], (x - x.mean(axis=0)) @ want, atol=1e-6)


def test_awkward_vectors(spark):
    good = [[1.0, 2.0, 3.0], [2.0, 4.0, 1.0], [0.0, 1.0, 1.0], [0.0, 1.0, 1.0]]
    bad = [None, [], [1.0], [1.0, None, 2.0], [1.0, float("nan"), 2.0], [1.0, float("inf"), 2.0, 0.0]]
    rows = [b for pair in zip(good + good[:2], bad) for b in pair]
    df = spark.createDataFrame(list(enumerate(rows)), "vec_id long, v array<double>").coalesce(1)
    model, out = CL.pca(df, "v", 2)
    x = np.array(good + good[:2])
    assert model.rows == 6 and np.allclose(model.mean, x.mean(axis=0))
    for r in out.collect():
        if rows[r.vec_id] in bad:
            assert r.projection is None
        else:
            assert np.allclose(r.projection, (np.array(rows[r.vec_id]) - model.mean) @ model.components)
    for empty in (df.limit(0), df.where("v is null"), df.where("vec_id = 3")):
        model, out = CL.pca(empty, "v", 2)
        assert model.rows == 0 and out.where("projection is not null").count() == 0
    model, out = CL.pca(df.where("vec_id = 0"), "v", 9)
    assert model.rows == 1 and not model.variances.any() and out.first().projection == [0.0, 0.0, 0.0]

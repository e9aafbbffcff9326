"""Embedding operators: normalisation, centroids, cluster risk.

Centroid tables are bounded by the number of clusters; they travel to the
rows as one array-valued scalar subquery, so per-row distances are array
expressions (no cross join, no shuffle of the vectors).
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.barrier import materialize
from ..functions.features import let


def l2_normalise(arr) -> Column:
    """Unit vector; zero vectors stay as they are."""
    a = F.col(arr) if isinstance(arr, str) else arr
    norm = lambda v: F.sqrt(F.aggregate(v, F.lit(0.0), lambda acc, x: acc + x * x))
    return let(F.transform(a, lambda x: x.cast("double")), lambda v: let(norm(v), lambda n: F.transform(
        v, lambda x: F.when(n > 0, x / n).otherwise(x))))


def with_unit(df: DataFrame, vec: str, out: str = "unit") -> DataFrame:
    """Adds the L2-normalised vector, computing the norm once per row."""
    norm = F.sqrt(F.aggregate(F.col(vec), F.lit(0.0), lambda acc, x: acc + x.cast("double") * x.cast("double")))
    d = materialize(df, "_norm", norm)
    return d.withColumn(out, F.transform(F.col(vec), lambda x: F.when(F.col("_norm") > 0, x.cast("double") / F.col("_norm"))
                                         .otherwise(x.cast("double")))).drop("_norm")


def centroids(df: DataFrame, vec: str, group: str) -> DataFrame:
    """Per-group mean vector: explode positions, map-side-combined mean per
    (group, pos), then re-assemble the (dimension-bounded) array."""
    long = df.select(F.col(group).alias("cluster"), F.posexplode_outer(vec).alias("pos", "x")).filter(F.col("pos").isNotNull())
    means = long.groupBy("cluster", "pos").agg(F.avg(F.col("x").cast("double")).alias("m"))
    return means.groupBy("cluster").agg(
        F.transform(F.sort_array(F.collect_list(F.struct("pos", "m"))), lambda s: s["m"]).alias("centroid"))


def _sq_dist(a: Column, b: Column) -> Column:
    return F.aggregate(F.zip_with(a, b, lambda x, y: (x - y) * (x - y)), F.lit(0.0), lambda acc, v: acc + v)


def nearest_clusters(df: DataFrame, vec: str, cents: DataFrame, n: int = 1, extra_cols=("risk",)) -> DataFrame:
    """Adds ``nearest``: the ``n`` closest centroids as array<struct<dist, cluster, ...>>
    (Euclidean, ties by cluster id)."""
    fields = [F.col("cluster"), F.col("centroid")] + [F.col(c) for c in extra_cols if c in cents.columns]
    table = cents.select(F.collect_list(F.struct(*fields))).scalar()
    # Subqueries may not sit inside lambdas: project the table first; the
    # vector is materialized so the lambda does not recompute it per centroid.
    d = materialize(df.withColumn("_cents", table), "_v", F.transform(F.col(vec), lambda x: x.cast("double")))
    v = F.col("_v")
    ranked = F.transform(F.col("_cents"), lambda c: F.struct(
        F.sqrt(_sq_dist(v, c["centroid"])).alias("dist"), c["cluster"].alias("cluster"),
        *[c[e].alias(e) for e in extra_cols if e in cents.columns]))
    return d.withColumn("nearest", F.slice(F.array_sort(ranked), 1, n)).drop("_cents", "_v")


def cluster_risk(assigned: DataFrame, cluster: str = "cluster", positive: str = "is_positive") -> DataFrame:
    """Risk of a cluster = share of positive rows in it."""
    return assigned.groupBy(cluster).agg(F.avg(F.col(positive).cast("double")).alias("risk"),
                                         F.count(F.lit(1)).alias("n_rows"))


def risk_score(nearest: Column, eps: float = 1e-9) -> Column:
    """Inverse-distance-weighted mean risk of the nearest clusters."""
    w = F.transform(nearest, lambda s: F.lit(1.0) / (s["dist"] + F.lit(eps)))
    num = F.aggregate(F.zip_with(nearest, w, lambda s, x: s["risk"] * x), F.lit(0.0), lambda a, x: a + x)
    den = F.aggregate(w, F.lit(0.0), lambda a, x: a + x)
    return num / den


def kmeans(df: DataFrame, vec: str, k: int = 10, seed: int = 42, max_iter: int = 20):
    """Spark ML k-means over (normalised) embeddings; returns (model, assigned)."""
    from pyspark.ml.clustering import KMeans
    from pyspark.ml.functions import array_to_vector

    d = df.withColumn("_features", array_to_vector(l2_normalise(vec)))
    model = KMeans(k=k, seed=seed, maxIter=max_iter, featuresCol="_features", predictionCol="cluster").fit(d)
    return model, model.transform(d).drop("_features")


@dataclass(frozen=True)
class Pca:
    mean: np.ndarray        # of the vectors used
    components: np.ndarray  # dimensions by k, orthonormal columns
    variances: np.ndarray   # along the components, largest first
    rows: int               # vectors used
    passes: int             # over the input


def usable(vec: str, size: int) -> Column:
    """Whether a vector has ``size`` components, all finite numbers."""
    c = F.col(vec)
    finite = F.forall(c, lambda x: x.isNotNull() & (F.abs(x.cast("double")) < float("inf")))
    return F.coalesce((F.size(c) == size) & finite, F.lit(False))


def fit_pca(df: DataFrame, vec: str, k: int = 3, width: int = 64, tolerance: float = 1e-5, most_passes: int = 40,
            seed: int = 42) -> Pca:
    """Principal components by a randomised range finder: the covariance is
    applied to ``width`` random directions in one pass over the partitions,
    the result made orthonormal and taken as the next directions, until the
    first ``k`` turn by less than ``tolerance``.  Only dimensions x ``width``
    sums reach the driver, never a covariance matrix; up to ``width``
    dimensions one pass is exact.  A component's largest entry is positive.

    Vectors that are null, of another length than the commonest, or hold null or
    non-finite components are left out; with fewer than two left, or equal
    ones, the components are arbitrary and their variances zero."""
    sizes = df.groupBy(F.size(vec).alias("d")).count().where("d > 0").orderBy(F.desc("count"), "d").first()
    d = sizes["d"] if sizes else 0
    if not d:
        return Pca(np.zeros(0), np.zeros((0, 0)), np.zeros(0), 0, 1)
    rows, k, width = df.where(usable(vec, d)).select(F.col(vec).cast("array<double>").alias("v")), min(k, d), min(max(width, k), d)
    names = [f"y{j}" for j in range(width)]

    def apply(q: np.ndarray) -> tuple[np.ndarray, np.ndarray, int]:
        """(covariance times q, mean, rows)."""
        def partial(batches):
            y, total, n = np.zeros((d, q.shape[1])), np.zeros(d), 0
            for b in batches:
                x = b.column(0).flatten().to_numpy().reshape(-1, d)
                y += x.T @ (x @ q)
                total += x.sum(axis=0)
                n += len(x)
            yield pa.RecordBatch.from_pydict({"i": pa.array(np.arange(d), pa.int32()), "total": pa.array(total), "n": pa.array(np.full(d, n)),
                                              **{c: pa.array(y[:, j]) for j, c in enumerate(names)}})

        schema = ", ".join(["i int, total double, n long", *(f"{c} double" for c in names)])
        got = rows.mapInArrow(partial, schema).groupBy("i").agg(*[F.sum(c).alias(c) for c in ("total", "n", *names)]).toPandas()
        if got.empty or not got["n"].iloc[0]:
            return np.zeros((d, width)), np.zeros(d), 0
        got = got.sort_values("i")
        n = int(got["n"].iloc[0])
        mean = got["total"].to_numpy() / n
        return (got[names].to_numpy() - n * np.outer(mean, mean @ q)) / max(n - 1, 1), mean, n

    q = np.linalg.qr(np.random.default_rng(seed).standard_normal((d, width)))[0]
    before = None
    for passes in range(1, most_passes + 1):
        y, mean, n = apply(q)
        small = q.T @ y
        values, turn = np.linalg.eigh((small + small.T) / 2)
        top = q @ turn[:, ::-1][:, :k]
        turned = 1.0 if before is None else np.linalg.norm(before - top @ (top.T @ before), 2)
        if width == d or turned < tolerance:
            break
        before, q = top, np.linalg.qr(y)[0]
    top = top * np.where(top[np.abs(top).argmax(axis=0), np.arange(k)] < 0, -1.0, 1.0)
    return Pca(mean, top, np.maximum(values[::-1][:k], 0.0), n, passes)


def pca(df: DataFrame, vec: str, k: int = 3, **settings) -> tuple[Pca, DataFrame]:
    """(model, ``df`` with ``projection``): the vector less the mean, along the
    components of :func:`fit_pca`; null for vectors that it leaves out."""
    model = fit_pca(df, vec, k, **settings)
    d = len(model.mean)

    @F.arrow_udf("array<double>")
    def project(vectors: pa.Array) -> pa.Array:
        x = vectors.flatten().to_numpy(zero_copy_only=False).reshape(-1, d) - model.mean
        y = pa.array((x @ model.components).ravel())
        ends = np.cumsum(np.concatenate(([0], np.where(vectors.is_valid().to_numpy(zero_copy_only=False), model.components.shape[1], 0))))
        mask = pa.array(np.append(vectors.is_null().to_numpy(zero_copy_only=False), False))
        return pa.ListArray.from_arrays(pa.array(ends, pa.int32()) if not vectors.null_count else
                                        pa.array([None if m else int(e) for e, m in zip(ends, mask.to_pylist())], pa.int32()), y)

    if not d:
        return model, df.withColumn("projection", F.lit(None).cast("array<double>"))
    good = F.when(usable(vec, d), F.col(vec).cast("array<double>"))
    return model, df.withColumn("projection", project(good))

"""FTRL-proximal learning with L1 and L2 penalties on sparse rows, in shards.

The rows of a bounded training sample are dealt to shards of about
``shard_rows``.  Each shard learns on its own, several times over its rows, and the weights are
averaged, so the result does not depend on how Spark places the shards."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Settings:
    alpha: float = 0.1
    beta: float = 1.0
    l1: float = 1.0
    l2: float = 1.0
    epochs: int = 3
    shard_rows: int = 5000


class Ftrl:
    """Weights of ``size`` features (the last is the bias) for ``outputs``
    scores: one score means a logistic model, more a softmax."""

    def __init__(self, size: int, outputs: int, s: Settings):
        self.z, self.n, self.s = np.zeros((size, outputs)), np.zeros((size, outputs)), s

    def weights(self, at) -> np.ndarray:
        z, n, s = self.z[at], self.n[at], self.s
        return np.where(np.abs(z) <= s.l1, 0.0, (np.sign(z) * s.l1 - z) / ((s.beta + np.sqrt(n)) / s.alpha + s.l2))

    def learn(self, at: np.ndarray, value: np.ndarray, target: np.ndarray) -> None:
        w = self.weights(at)
        y = value @ w
        if len(y) == 1:
            p = 1 / (1 + np.exp(-np.clip(y, -35, 35)))
        else:
            p = np.exp(y - y.max())
            p /= p.sum()
        g = value[:, None] * (p - target)[None, :]
        n = self.n[at]
        self.z[at] += g - (np.sqrt(n + g * g) - np.sqrt(n)) / self.s.alpha * w
        self.n[at] = n + g * g


def flat(lists: pa.ChunkedArray | pa.ListArray) -> tuple[np.ndarray, np.ndarray]:
    """(values, offsets) of lists, without Python numbers."""
    a = pa.concat_arrays(lists.chunks) if isinstance(lists, pa.ChunkedArray) else lists
    at = a.offsets.to_numpy()
    return a.values.to_numpy()[:at[-1]], at


def fit(sample: DataFrame, size: int, outputs: int, s: Settings, seed: int = 0) -> tuple[np.ndarray, np.ndarray]:
    """(features, weights) that are not all zero after averaging the shards;
    feature ``size`` is the bias.

    ``sample``: id (any order-giving long), features array<int> without
    repeats, target int (0/1 for one output, else the class) and, unless all
    values are one, vals array<float>.  The caller bounds the number of rows."""
    def learn(t: pa.Table) -> pa.Table:
        t = t.combine_chunks()
        target = t.column("target").to_numpy()
        feats, at = flat(t.column("features"))
        values = flat(t.column("vals"))[0] if "vals" in t.column_names else None
        rows = [(at[k], at[k + 1], target[k]) for k in np.argsort(t.column("id").to_numpy(), kind="stable")]
        model, rng, eye = Ftrl(size + 1, outputs, s), np.random.default_rng(seed), np.eye(max(outputs, 2))
        for _ in range(s.epochs):
            for k in rng.permutation(len(rows)):
                first, end, y = rows[k]
                value = np.ones(end - first + 1)
                if values is not None:
                    value[:-1] = values[first:end]
                model.learn(np.append(feats[first:end], size), value, np.array([float(y)]) if outputs == 1 else eye[y])
        w = model.weights(slice(None))
        used = np.flatnonzero(np.abs(w).sum(axis=1))
        return pa.table({"feature": pa.array(used, pa.int32()), **{f"w{c}": pa.array(w[used, c]) for c in range(outputs)}})

    schema = ", ".join(["feature int", *(f"w{c} double" for c in range(outputs))])
    shards = max(1, -(-sample.count() // s.shard_rows))
    parts = (sample.withColumn("shard", F.pmod(F.xxhash64("id", F.lit("shard")), F.lit(shards)).cast("int"))
             .groupBy("shard").applyInArrow(learn, schema))
    got = (parts.groupBy("feature").agg(*(F.sum(f"w{c}").alias(f"w{c}") for c in range(outputs)))
           .toPandas().sort_values("feature"))  # at most size + 1 rows
    weights = got[[f"w{c}" for c in range(outputs)]].to_numpy(np.float64) / shards
    return got["feature"].to_numpy(np.int64), weights


def bounded(df: DataFrame, id_col: str, most: int, salt: str) -> DataFrame:
    """About ``most`` rows at the most, chosen by a hash of the id: all rows if
    there are fewer, else each with the same chance."""
    n = df.count()
    if n <= most:
        return df
    return df.where(F.pmod(F.xxhash64(F.col(id_col), F.lit(salt)), F.lit(1 << 30)) < int(most / n * (1 << 30)))

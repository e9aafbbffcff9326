"""Near-duplicate vectors by random-hyperplane signs, exact cosine check and
connected components.

Vectors of one label are hashed into several tables, each by the signs of its
own random projections; vectors that share a bucket of some table are
candidates.  Every candidate pair is checked once, in the first table in which
it meets, by its cosine in double precision.  Equal vectors are one node with
a multiplicity, buckets with one member are left out before any vector is
shuffled, and hot buckets are split in blocks.  A bucket gives counts of links
and a spanning forest, never its pairs.

The signs per table follow the largest label (log2 of its distinct vectors,
plus three), the tables follow from the signs and the wanted chance of finding
a pair that lies just at the threshold, so that chance is the same at every
size.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import components, forest, map_groups, runs, split_hot, stored

THRESHOLD = 0.93
RECALL = 0.9995   # chance to find a pair just at the threshold; closer pairs are likelier found
BLOCK = 1024
SEED = 20


def tables_for(n: int, threshold: float, recall: float) -> tuple[int, int]:
    """(signs per table, tables) for labels of at most n distinct vectors."""
    signs = min(31, max(4, math.ceil(math.log2(max(n, 2))) + 3))
    meet = (1 - math.acos(threshold) / math.pi) ** signs
    return signs, math.ceil(math.log(1 - recall) / math.log(1 - meet))


def _as_bytes(dtype: str):
    @F.arrow_udf("binary")
    def pack(vectors: pa.Array) -> pa.Array:
        """The numbers of usable vectors; null for others."""
        out = []
        for v in vectors.to_pylist():
            x = None if not v or any(y is None for y in v) else np.array(v, dtype) + 0  # -0 becomes 0
            out.append(x.tobytes() if x is not None and np.isfinite(x).all() and x.any() else None)
        return pa.array(out, pa.binary())

    return pack


def _unit(vectors: list[bytes], dtype: str) -> np.ndarray:
    x = np.frombuffer(b"".join(vectors), dtype).reshape(len(vectors), -1).astype(np.float64)
    x /= np.abs(x).max(axis=1, keepdims=True)  # no overflow or underflow in the norm
    return x / np.sqrt(np.einsum("ij,ij->i", x, x))[:, None]


def _codes(dtype: str, signs: int, tables: int, seed: int):
    @F.arrow_udf("binary")
    def codes(vectors: Iterator[pa.Array]) -> Iterator[pa.Array]:
        """32-bit codes, one for each table."""
        planes: dict[int, np.ndarray] = {}
        weight = 1 << np.arange(signs, dtype=np.int64)
        for t in vectors:
            out = []
            for v in t.to_pylist():
                x = _unit([v], dtype)[0]
                if len(x) not in planes:
                    planes[len(x)] = np.random.default_rng([seed, len(x)]).standard_normal((tables * signs, len(x)))
                bits = (planes[len(x)] @ x > 0).reshape(tables, signs)
                out.append((bits @ weight).astype("<i4").tobytes())
            yield pa.array(out, pa.binary())

    return codes


def _compare(dtype: str, threshold: float, step: int = 256):
    def check(t: pa.Table) -> Iterator[pa.RecordBatch]:
        """(a, b null, n): vectors that a links with, in this group;
        (a, b, n null): a link of the group's spanning forest."""
        grp, gid, mult = (t.column(c).to_numpy() for c in ("grp", "gid", "mult"))
        table, side, same = (t.column(c).to_numpy() for c in ("t", "side", "same"))
        label = t.column("label").to_numpy()
        vec, sig = t.column("vec"), t.column("sig")
        a, b, n = [], [], []
        for s, e in runs(grp):
            v = vec.slice(s, e - s).to_pylist()
            if len(set(map(len, v))) > 1:
                continue  # keys hold the length: two lengths meet only by a clash of 64-bit hashes
            x = _unit(v, dtype)
            code = np.frombuffer(b"".join(sig.slice(s, e - s).to_pylist()), "<i4").reshape(e - s, -1)
            rows = np.arange(e - s) if same[s] else np.flatnonzero(side[s:e] == 0)
            cols = np.arange(e - s) if same[s] else np.flatnonzero(side[s:e] == 1)
            links, hit_i, hit_j = np.zeros(e - s, np.int64), [], []
            for k in range(0, len(rows), step):
                i, j = np.nonzero(x[rows[k:k + step]] @ x[cols].T >= threshold)
                i, j = rows[k:k + step][i], cols[j]
                keep = (i < j if same[s] else np.ones(len(i), bool)) & (label[s + i] == label[s + j])
                i, j = i[keep], j[keep]
                for q in range(0, len(i), 1 << 16):  # pairs that met in an earlier table are not counted again
                    p, r = i[q:q + (1 << 16)], j[q:q + (1 << 16)]
                    first = (code[p] == code[r]).argmax(axis=1) == table[s + p]
                    hit_i.append(p[first])
                    hit_j.append(r[first])
            i, j = (np.concatenate(z) if z else np.empty(0, np.int64) for z in (hit_i, hit_j))
            if not len(i):
                continue
            np.add.at(links, i, mult[s + j])
            np.add.at(links, j, mult[s + i])
            ids = gid[s:e]
            order = np.argsort(ids, kind="stable")
            place = np.empty(e - s, np.int64)
            place[order] = np.arange(e - s)
            root = order[forest(e - s, place[i], place[j])][place]
            for k in np.flatnonzero(links):
                a.append(ids[k])
                b.append(None)
                n.append(links[k])
            for k in np.flatnonzero(ids[root] != ids):
                a.append(ids[k])
                b.append(ids[root[k]])
                n.append(None)
        if a:
            yield pa.RecordBatch.from_pydict({"a": pa.array(a, pa.int64()), "b": pa.array(b, pa.int64()), "n": pa.array(n, pa.int64())})
    return check


def near_vectors(vectors: DataFrame, threshold: float = THRESHOLD, id_col: str = "vec_id", vec_col: str = "embedding",
                 label_col: str = "label", recall: float = RECALL, block: int = BLOCK, seed: int = SEED) -> DataFrame:
    """(id, n_links, component_id, kept), a row for every row of ``vectors``.

    Only vectors of the same length and of equal, non-null labels are
    compared.  A vector that is null, empty, zero or holds nulls or non-finite
    numbers, or whose id is null, links with nothing; so its component is
    itself, and it is kept.  n_links counts the other ids that a vector links
    with; repeated rows count once and give repeated results.  Ids are taken
    as unique up to repeats; rows of one id with different vectors form one
    node of a component.  An empty table gives an empty result."""
    kind = vectors.schema[vec_col].dataType
    dtype = "<f4" if isinstance(kind, T.ArrayType) and isinstance(kind.elementType, T.FloatType) else "<f8"
    number = F.col(vec_col) if dtype == "<f4" else F.col(vec_col).cast("array<double>")
    usable = F.col(id_col).isNotNull() & F.col(label_col).isNotNull()
    rows = stored(vectors.select(F.col(id_col).cast("long").alias("id"), F.col(label_col).cast("long").alias("label"),
                                 _as_bytes(dtype)(F.when(usable, number)).alias("vec"))
                  .withColumn("digest", F.unhex(F.sha2("vec", 256))), "vectors")
    good = rows.where("vec is not null")
    nodes = good.select("id", "label", "digest").distinct().groupBy("label", "digest").agg(
        F.min("id").alias("gid"), F.count(F.lit(1)).alias("mult"))
    nodes = stored(nodes, "vector-nodes")
    most = nodes.groupBy("label").count().agg(F.max("count")).first()[0] or 1
    signs, tables = tables_for(most, threshold, recall)
    distinct = good.join(nodes, ["label", "digest"]).where("id = gid").dropDuplicates(["label", "digest"])
    coded = stored(distinct.select("gid", "label", "mult", "vec", "digest", _codes(dtype, signs, tables, seed)("vec").alias("sig")), "vector-codes")

    keys = F.array(*[F.xxhash64("label", F.octet_length("vec"), F.lit(t), F.expr(f"substring(sig, {4 * t + 1}, 4)")) for t in range(tables)])
    light = stored(coded.select("label", "digest", F.posexplode(keys).alias("t", "key")), "vector-keys")
    shared = light.groupBy("key").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("key")
    met = split_hot(light.join(shared, "key"), "key", F.col("digest"), block, "vector-hot")
    checked = map_groups(met.join(coded.select("gid", "label", "mult", "vec", "digest", "sig"), ["label", "digest"])
                         .select("grp", "side", "same", "t", "gid", "label", "mult", "vec", "sig"),
                         "grp", _compare(dtype, threshold), "a long, b long, n long")
    checked = stored(checked, "vector-links")
    counts = checked.where("n is not null").groupBy(F.col("a").alias("gid")).agg(F.sum("n").alias("n"))
    roots = components(checked.where("b is not null").select("a", "b"), "vector-components")
    per_node = nodes.join(counts, "gid", "left").select("label", "digest", "gid", (F.coalesce("n", F.lit(0)) + F.col("mult") - 1).alias("n_links"))
    per_node = per_node.join(roots.select(F.col("node").alias("gid"), "root"), "gid", "left").select(
        "label", "digest", "n_links", F.coalesce("root", "gid").alias("component"))
    out = rows.join(per_node, ["label", "digest"], "left")
    return out.select(F.col("id").alias(id_col), F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
                      F.coalesce("component", "id").alias("component_id"),
                      F.coalesce(F.col("component") == F.col("id"), F.lit(True)).alias("kept"))

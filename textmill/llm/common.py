"""Helpers shared by the operators: intermediate tables, whole texts as bytes,
splitting of hot keys, streaming over sorted groups, connected components."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import scratch_path


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def stored(df: DataFrame, name: str) -> DataFrame:
    """The frame written to the shared folder and read again: cuts lineage,
    and a lost executor costs only the tasks that read from it."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def text_bytes(text: str | Column = "text") -> Column:
    """The whole text as UTF-8 bytes; null counts as empty."""
    c = F.col(text) if isinstance(text, str) else text
    return F.coalesce(c, F.lit("")).cast("binary")


def crc_mod(id_col: str, n: int) -> Column:
    """crc32 of the id as text, modulo n; null for a null id."""
    return F.crc32(F.col(id_col).cast("string")) % n


# -- hot keys ---------------------------------------------------------------

def split_hot(df: DataFrame, key: str, member: Column, block: int, name: str) -> DataFrame:
    """Prepare groups for pairwise comparison so that no group of one key
    meets in one task.

    Keys with at most ``block`` rows keep their group.  The members of a larger
    key are dealt by hash to ceil(n / block) blocks, and every pair of blocks
    becomes a group of its own, so all pairs of the key still meet exactly
    once while no group holds more than about two blocks.  Adds ``grp`` (long,
    the group), ``side`` (0 or 1, the block within the pair) and ``same``
    (true: compare all members, false: compare side 0 with side 1).  Rows with
    a key of their own have no partner; callers drop them before."""
    hot = stored(df.groupBy(key).agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > block)
                 .select(F.col(key).alias("hot_key"), F.ceil(F.col("n") / block).cast("int").alias("nb")), name)
    alone = [F.col(key).alias("grp"), F.lit(0).alias("side"), F.lit(True).alias("same")]
    n_hot = hot.count()
    if not n_hot:
        return df.select("*", *alone)
    if n_hot <= 200_000:  # two numbers a row: a checked, small table
        hot = F.broadcast(hot)
    on = F.col(key) == F.col("hot_key")
    own = F.pmod(F.xxhash64(member, F.lit("block")), F.col("nb")).cast("int")
    dealt = (df.join(hot, on, "left")
             .withColumn("own", F.when(F.col("nb").isNotNull(), own))
             .withColumn("other", F.explode(F.coalesce(F.sequence(F.lit(0), F.col("nb") - 1), F.array(F.lit(0))))))
    lo, hi = F.least("own", "other"), F.greatest("own", "other")
    return (dealt.withColumn("grp", F.when(F.col("nb").isNull(), F.col(key)).otherwise(F.xxhash64(F.col(key), lo, hi)))
            .withColumn("side", F.when(F.col("own") > F.col("other"), 1).otherwise(0))
            .withColumn("same", F.coalesce(F.col("own") == F.col("other"), F.lit(True)))
            .drop("hot_key", "nb", "own", "other"))


def map_groups(df: DataFrame, key: str, fn: Callable[[pa.Table], Iterator[pa.RecordBatch]], schema: str) -> DataFrame:
    """Apply ``fn`` to runs of whole groups of the long column ``key``: rows
    are dealt and sorted by it, and each call gets one or more whole groups as
    a table sorted by the key.  Groups are assumed bounded (see split_hot)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        for b in batches:
            if not b.num_rows:
                continue
            k = b.column(key).to_numpy(zero_copy_only=False)
            cut = int(np.searchsorted(k, k[-1], "left"))  # rows before the last key of the batch
            if cut == 0 and held and held[-1].column(key)[-1].as_py() == k[0]:
                held.append(b)
                continue
            if cut == 0:
                if held:
                    yield from fn(pa.Table.from_batches(held))
                held = [b]
                continue
            held.append(b.slice(0, cut))
            yield from fn(pa.Table.from_batches(held))
            held = [b.slice(cut)]
        if held:
            yield from fn(pa.Table.from_batches(held))

    return df.repartition(key).sortWithinPartitions(key).mapInArrow(run, schema)


def runs(keys: np.ndarray) -> Iterator[tuple[int, int]]:
    """(start, end) of the runs of two or more equal keys."""
    edge = np.flatnonzero(np.concatenate(([True], keys[1:] != keys[:-1], [True])))
    size = np.diff(edge)
    for k in np.flatnonzero(size > 1):
        yield int(edge[k]), int(edge[k + 1])


def forest(n: int, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """For nodes 0..n-1 with links (i, j): the smallest node of each one's
    component."""
    label = np.arange(n)
    while True:
        low = np.minimum(label[i], label[j])
        new = label.copy()
        np.minimum.at(new, label[i], low)
        np.minimum.at(new, label[j], low)
        new = new[new]
        if np.array_equal(new, label):
            return label
        label = new


# -- connected components ---------------------------------------------------

def components(edges: DataFrame, name: str = "components") -> DataFrame:
    """Connected components of the links (a, b), two long columns: one row
    (node, root) per node that is not its own root, root being the smallest
    node of the component.

    Alternating star contraction: each round ties a node's larger neighbours
    to its smallest one, then its smaller neighbours to the smallest of them.
    Every round is written to the shared folder; the rounds end when the set
    of links stays as it was, which holds after O(log^2 n) of them.  Only
    counts reach the driver."""
    def state(df: DataFrame) -> tuple:
        r = df.agg(F.count(F.lit(1)), F.sum(F.pmod(F.xxhash64("a", "b"), F.lit(1 << 40)))).first()
        return r[0], r[1]

    e = stored(edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
               .where("a <> b").distinct(), name)
    before = state(e)
    while before[0]:
        both = e.unionByName(e.select(F.col("b").alias("a"), F.col("a").alias("b")))
        low = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        large = both.join(low, "a").where("b > a and b <> m").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        small = (large.join(least, "a").select(F.explode(F.array(
            F.struct(F.col("b").alias("a"), F.col("m").alias("b")),
            F.struct(F.col("a").alias("a"), F.col("m").alias("b")))).alias("l")).select("l.a", "l.b")
            .where("a <> b").distinct())
        e = stored(small, name)
        after = state(e)
        if after == before:
            break
        before = after
    return e.select(F.col("a").alias("node"), F.col("b").alias("root"))

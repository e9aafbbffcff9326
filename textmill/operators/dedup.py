"""Deduplication and cross-split leakage."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def digest(key: str) -> Column:
    """SHA-256 of a text: 32 bytes to shuffle and compare, however long the
    text is; null for null."""
    return F.unhex(F.sha2(F.col(key).cast("binary"), 256))


def dedup_keep_first(df: DataFrame, key: str = "text",
                     order: tuple[str, ...] = ("source_file", "record_id")) -> DataFrame:
    """``drop_duplicates(subset=[key], keep='first')`` with "first" made
    explicit as the smallest ``order`` tuple.  One aggregate by digest with
    map-side combine: a text repeated a billion times is one row per map task
    before the shuffle, so hot duplicates cannot skew a reducer, and texts are
    neither hashed, sorted nor compared as keys, only carried.  Texts are taken
    as equal if their SHA-256 is."""
    winner = F.min_by(F.struct(*[F.col(f"`{c}`") for c in df.columns]), F.struct(*[F.col(c) for c in order]))
    return (df.filter(F.col(key).isNotNull())
              .groupBy(digest(key).alias("_key")).agg(winner.alias("_w"))
              .select(*[F.col(f"_w.`{c}`").alias(c) for c in df.columns]))


def dedup_report(df: DataFrame, key: str = "text") -> DataFrame:
    """Rows before / after / removed by dedup on ``key`` (counted by digest)."""
    d = df.filter(F.col(key).isNotNull())
    return d.agg(F.count(F.lit(1)).alias("rows_before"),
                 F.count_distinct(digest(key)).alias("rows_after")) \
            .withColumn("removed", F.col("rows_before") - F.col("rows_after"))


def split_leakage(df: DataFrame, split_col: str = "split", key: str = "text",
                  splits: tuple[str, ...] = ("train", "validation", "test")) -> DataFrame:
    """|distinct texts(A) ∩ distinct texts(B)| for every pair of splits, in one
    shuffle: per text, one flag per split, then conditional sums."""
    flags = (df.filter(F.col(key).isNotNull())
               .groupBy(digest(key).alias("_key"))
               .agg(*[F.max((F.col(split_col) == s).cast("int")).alias(f"_in_{i}") for i, s in enumerate(splits)]))
    pairs = [(i, j) for i in range(len(splits)) for j in range(i + 1, len(splits))]
    agg = flags.agg(*[F.sum(F.col(f"_in_{i}") * F.col(f"_in_{j}")).alias(f"_p{i}_{j}") for i, j in pairs])
    rows = [F.struct(F.lit(splits[i]).alias("split_a"), F.lit(splits[j]).alias("split_b"),
                     F.coalesce(F.col(f"_p{i}_{j}"), F.lit(0)).cast("long").alias("n_shared"))
            for i, j in pairs]
    return agg.select(F.explode(F.array(*rows)).alias("r")).select("r.*")


def leakage_removed(test: DataFrame, train: DataFrame, key: str = "text") -> DataFrame:
    """Test rows whose text also occurs in train are removed (anti join)."""
    seen = train.select(digest(key).alias("_seen")).distinct()
    return test.join(seen, digest(key) == F.col("_seen"), "left_anti")


def shared_texts(a: DataFrame, b: DataFrame, key: str = "text") -> DataFrame:
    """Distinct texts present in both inputs (set intersection; null is one
    where both have it).  Digests are intersected first, so that only texts
    found in both are grouped."""
    common = a.select(digest(key).alias("_k")).intersect(b.select(digest(key).alias("_k")))
    texts = a.select(F.col(key), digest(key).alias("_d"))
    return texts.join(common, F.col("_d").eqNullSafe(F.col("_k")), "left_semi") \
                .groupBy("_d").agg(F.first(key).alias(key)).select(key)


def union_all(frames: list[DataFrame]) -> DataFrame:
    return reduce(lambda x, y: x.unionByName(y, allowMissingColumns=True), frames)

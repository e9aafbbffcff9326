"""Scalable exact ranks and row indexes.

A plain ``row_number() over (partition by label order by h)`` sends a whole
label (possibly half the data) to one task.  Here the order key is split into
buckets that are monotone in the order (a hash prefix, or a numeric range),
rows are counted per ``(group, bucket)`` in a map-side-combined aggregate,
the tiny count table is prefix-summed, and the final rank is the bucket
offset plus a ``row_number`` inside a single bucket.  The result equals the
global rank; the largest window is one bucket.

Where only "is the rank within a quota" is asked, :func:`rank_marks` finds the
order key at the quota's rank; the rows are then compared with it where they
lie, without a rank, a sort or a shuffle of their own.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

MOST_GROUPS = 100_000  # rows of a table by group that are broadcast; more are joined as the planner sees fit


def few_rows(df: DataFrame, most: int = MOST_GROUPS) -> bool:
    """Whether ``df`` has at most ``most`` rows (a count that stops there)."""
    return df.limit(most + 1).count() <= most


def hash_order(id_col, seed: int = 42) -> Column:
    """Deterministic pseudo-random order key, identical in Spark and DuckDB:
    ``md5('<seed>:<id>')`` as 32 lower-case hex digits."""
    c = F.col(id_col) if isinstance(id_col, str) else id_col
    return F.md5(F.concat(F.lit(f"{seed}:"), c.cast("string")))


def hash_bucket(h: Column, hex_digits: int = 3) -> Column:
    """Leading hex digits of a hash; monotone in the hash order."""
    return F.substring(h, 1, hex_digits)


def bucketed_rank(df: DataFrame, partition_cols: list[str], order_cols: list, bucket: Column,
                  name: str = "rank", total_name: str | None = None) -> DataFrame:
    """Add ``name`` = 1-based rank of each row within ``partition_cols`` by
    ``order_cols``.  ``bucket`` must be non-decreasing in ``order_cols``.

    How the offsets (a row for each group and bucket) are joined is left to
    the planner, which measures their size."""
    d = df.withColumn("_bkt", bucket)
    counts = d.groupBy(*partition_cols, "_bkt").agg(F.count(F.lit(1)).alias("_n"))
    w = Window.partitionBy(*partition_cols).orderBy("_bkt").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select(*partition_cols, "_bkt", F.coalesce(F.sum("_n").over(w), F.lit(0)).alias("_off"),
                            F.sum("_n").over(Window.partitionBy(*partition_cols)).alias("_tot"))
    o = offsets.alias("_o")
    cond = [F.col("_d._bkt") == F.col("_o._bkt")] + [
        F.col(f"_d.`{c}`").eqNullSafe(F.col(f"_o.`{c}`")) for c in partition_cols]
    joined = d.alias("_d").join(o, cond, "inner").select("_d.*", F.col("_o._off").alias("_off"),
                                                         F.col("_o._tot").alias("_tot"))
    w2 = Window.partitionBy(*partition_cols, "_bkt").orderBy(*order_cols)
    out = joined.withColumn(name, (F.row_number().over(w2) + F.col("_off")).cast("long")).drop("_bkt", "_off")
    return out.withColumnRenamed("_tot", total_name) if total_name else out.drop("_tot")


def hash_rank(df: DataFrame, id_col: str, partition_cols: list[str] | None = None, seed: int = 42,
              name: str = "rank", hex_digits: int = 3, total_name: str | None = None) -> DataFrame:
    """Rank by ``md5(seed:id)`` (ties by id) within ``partition_cols``;
    ``total_name`` optionally adds the group size."""
    d = df.withColumn("_h", hash_order(id_col, seed))
    out = bucketed_rank(d, partition_cols or [], [F.col("_h"), F.col(id_col)], hash_bucket(F.col("_h"), hex_digits),
                        name=name, total_name=total_name)
    return out.drop("_h")


def order_key(id_col: str, seed: int = 42) -> Column:
    """The order of :func:`hash_rank` as one value that can be compared."""
    return F.struct(hash_order(id_col, seed).alias("h"), F.col(id_col).alias("id"))


def bucket_counts(df: DataFrame, id_col: str, groups: list[str], seed: int = 42, hex_digits: int = 3) -> DataFrame:
    """Rows ``_n`` per group and hash bucket ``_bkt``."""
    return df.groupBy(*groups, hash_bucket(hash_order(id_col, seed), hex_digits).alias("_bkt")) \
             .agg(F.count(F.lit(1)).alias("_n"))


def rank_marks(df: DataFrame, id_col: str, quotas: DataFrame, names: list[str], groups: list[str], seed: int = 42,
               hex_digits: int = 3, few: bool = False) -> DataFrame:
    """A row per group: for each quota column ``name`` of ``quotas`` (a row per
    group) the column ``name_mark``, the :func:`order_key` at that rank of the
    group; the last one's where the quota exceeds the group, null where it is
    below 1 or the group is null.

    Rows are counted per bucket, and only the bucket that holds the rank is
    sorted: (group, hash, id) of about one row in 16^``hex_digits``.  ``few``
    says that the groups were counted and are few enough to broadcast."""
    counts = bucket_counts(df, id_col, groups, seed, hex_digits)
    before = Window.partitionBy(*groups).orderBy("_bkt").rowsBetween(Window.unboundedPreceding, -1)
    spans = counts.withColumn("_off", F.coalesce(F.sum("_n").over(before), F.lit(0))) \
                  .withColumn("_tot", F.sum("_n").over(Window.partitionBy(*groups)))
    which = F.posexplode(F.array(*[F.col(n).cast("long") for n in names])).alias("_which", "_quota")
    asked = quotas.select(*groups, which).filter(F.col("_quota") >= 1)
    rank = F.least(F.col("_quota"), F.col("_tot"))
    within = (F.col("_off") < rank) & (rank <= F.col("_off") + F.col("_n"))
    wanted = spans.join(asked, groups).filter(within) if groups else spans.join(asked, within)
    wanted = wanted.select(*groups, "_bkt", "_which", (rank - F.col("_off")).alias("_k"))
    keys = df.select(*groups, order_key(id_col, seed).alias("_key")) \
             .withColumn("_bkt", hash_bucket(F.col("_key.h"), hex_digits))
    near = keys.join(F.broadcast(wanted) if few else wanted, [*groups, "_bkt"])
    found = near.withColumn("_r", F.row_number().over(Window.partitionBy(*groups, "_which").orderBy("_key"))) \
                .filter(F.col("_r") == F.col("_k"))
    return found.groupBy(*groups).agg(*[F.max(F.when(F.col("_which") == i, F.col("_key"))).alias(f"{n}_mark")
                                        for i, n in enumerate(names)])


def within_quotas(df: DataFrame, id_col: str, quotas: DataFrame, names: list[str], groups: list[str], seed: int = 42,
                  hex_digits: int = 3) -> DataFrame:
    """``df`` with, for each quota column, the boolean ``name_in``: the row is
    among the first ``name`` of its group in hash order.  Rows of a group that
    ``quotas`` lacks, and of a null one, go.  Rows that repeat an id stay
    together: an id at the quota's rank is in with all its rows.

    The input is read three times (counts, the buckets asked for, the rows
    themselves), the first two for the group and id columns only; write it
    first where it is costly."""
    few = not groups or few_rows(df.select(*groups).distinct())
    marks = rank_marks(df, id_col, quotas, names, groups, seed, hex_digits, few)
    key = order_key(id_col, seed)
    if not groups:
        flags = [F.coalesce(key <= marks.select(f"{n}_mark").scalar(), F.lit(False)).alias(f"{n}_in") for n in names]
        return df.select(*[F.col(f"`{c}`") for c in df.columns], *flags)
    table = quotas.select(*groups).join(marks, groups, "left")
    out = df.join(F.broadcast(table) if few else table, groups)
    flags = [F.coalesce(key <= F.col(f"{n}_mark"), F.lit(False)).alias(f"{n}_in") for n in names]
    return out.select(*[F.col(f"`{c}`") for c in df.columns], *flags)

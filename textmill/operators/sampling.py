"""Deterministic sampling and splitting.

Order is defined by ``md5('<seed>:<id>')`` so Spark and an SQL engine agree
row for row.  Quotas are computed with integer arithmetic on a tiny per-label
count table (largest remainder, ties by label); whether a row is within its
quota is told by comparing its hash with the one at the quota's rank, and ranks
come from :mod:`ranking`, so no window ever spans a whole label.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.constants import CV_FOLDS, LEARNING_FRACTIONS, SEED, SPLIT_PERCENT, TARGET_DATASET_SIZE
from .ranking import bucket_counts, hash_order, hash_rank, order_key, rank_marks, within_quotas

def _largest_remainder(counts: DataFrame, label: str, n_col: str, total_col: str, out: str) -> DataFrame:
    """Split integer ``total_col`` over labels in proportion to ``n_col``:
    floor shares, then +1 for the largest remainders (ties: smaller label)."""
    w_all = Window.partitionBy()
    c = (counts.withColumn("_N", F.sum(n_col).over(w_all))
               .withColumn("_num", F.col(total_col) * F.col(n_col))
               .withColumn("_base", F.expr("_num div _N"))
               .withColumn("_rem", F.expr("_num % _N")))
    c = c.withColumn("_left", F.col(total_col) - F.sum("_base").over(w_all))
    c = c.withColumn("_ord", F.row_number().over(Window.orderBy(F.desc("_rem"), F.col(label))))
    return c.withColumn(out, (F.col("_base") + F.when(F.col("_ord") <= F.col("_left"), 1).otherwise(0)).cast("long")) \
            .drop("_N", "_num", "_base", "_rem", "_left", "_ord")


def label_counts(df: DataFrame, label: str) -> DataFrame:
    return df.groupBy(label).agg(F.count(F.lit(1)).alias("n_label"))


def _counted(df: DataFrame, label: str, id_col: str, seed: int) -> DataFrame:
    """:func:`label_counts` summed from the counts per bucket, which the
    selection asks for too: one pass for both."""
    return bucket_counts(df, id_col, [label], seed).groupBy(label).agg(F.sum("_n").alias("n_label"))


def split_quotas(counts: DataFrame, label: str, percents=SPLIT_PERCENT) -> DataFrame:
    """Per label: rows held out (validation+test) and rows for test."""
    _, p_val, p_test = percents
    p_hold = p_val + p_test
    c = counts.withColumn("_n_all", F.sum("n_label").over(Window.partitionBy()))
    c = c.withColumn("hold_total", F.expr(f"(_n_all * {p_hold} + 99) div 100"))
    c = _largest_remainder(c, label, "n_label", "hold_total", "hold_quota")
    c = c.withColumn("test_total", F.expr(f"(hold_total * {p_test} + {p_hold - 1}) div {p_hold}"))
    c = _largest_remainder(c, label, "hold_quota", "test_total", "test_quota")
    return c.select(label, "n_label", "hold_quota", "test_quota")


def stratified_split(df: DataFrame, label: str = "label", id_col: str = "record_id", seed: int = SEED,
                     percents=SPLIT_PERCENT) -> DataFrame:
    """Stratified train / validation / test assignment (column ``split``).

    Within each label, in hash order, the first ``test_quota`` rows go to
    test, the next up to ``hold_quota`` to validation, the rest to train.  Rows
    without a label go; rows of one id stay in one split."""
    quotas = split_quotas(_counted(df, label, id_col, seed), label, percents)
    out = within_quotas(df, id_col, quotas, ["test_quota", "hold_quota"], [label], seed)
    split = F.when(F.col("test_quota_in"), "test").when(F.col("hold_quota_in"), "validation").otherwise("train")
    return out.select(*df.columns, split.alias("split"))


def stratified_folds(df: DataFrame, label: str = "label", id_col: str = "record_id", k: int = CV_FOLDS,
                     seed: int = SEED) -> DataFrame:
    """Fold ``0..k-1``: round robin over the hash rank inside each label, so
    every fold has each label's count within one."""
    ranked = hash_rank(df, id_col, [label], seed, name="_r")
    return ranked.withColumn("fold", F.pmod(F.col("_r") - 1, F.lit(k)).cast("int")).drop("_r")


def learning_subsets(df: DataFrame, id_col: str = "record_id", fractions=LEARNING_FRACTIONS,
                     seed: int = SEED) -> DataFrame:
    """Index of the smallest nested training subset containing each row:
    subset ``i`` holds the first ``floor(fraction_i * n)`` rows in hash order."""
    total = bucket_counts(df, id_col, [], seed).agg(F.coalesce(F.sum("_n"), F.lit(0)).alias("_n"))
    names = [f"_q{i}" for i in range(len(fractions))]
    quotas = total.select(*[F.floor(F.lit(float(f)) * F.col("_n")).alias(q) for f, q in zip(fractions, names)])
    out = within_quotas(df, id_col, quotas, names, [], seed)
    subset = F.coalesce(*[F.when(F.col(f"{q}_in"), F.lit(i)) for i, q in enumerate(names)])
    return out.select(*df.columns, subset.cast("int").alias("subset"))


def subset_of(df: DataFrame, id_col: str = "record_id", fractions=LEARNING_FRACTIONS, seed: int = SEED) -> Column:
    """The ``subset`` of :func:`learning_subsets` as an expression over any
    rows with that id: the ids at the quotas' ranks are fetched (null where
    ``df`` has no rows)."""
    total = bucket_counts(df, id_col, [], seed).agg(F.coalesce(F.sum("_n"), F.lit(0)).alias("_n"))
    names = [f"_q{i}" for i in range(len(fractions))]
    quotas = total.select(*[F.floor(F.lit(float(f)) * F.col("_n")).alias(q) for f, q in zip(fractions, names)])
    marks = rank_marks(df, id_col, quotas, names, [], seed, few=True).first()
    key, kind = order_key(id_col, seed), df.schema[id_col].dataType

    def until(mark) -> Column:
        if mark is None:
            return F.lit(False)
        return key <= F.struct(F.lit(mark["h"]).cast("string").alias("h"), F.lit(mark["id"]).cast(kind).alias("id"))

    return F.coalesce(*[F.when(until(marks[f"{q}_mark"]), F.lit(i)) for i, q in enumerate(names)]).cast("int")


def stratified_sample(df: DataFrame, n: int, label: str = "label", id_col: str = "record_id",
                      seed: int = SEED) -> DataFrame:
    """Exactly ``min(n, rows)`` rows, allocated to labels by largest remainder
    (more where the id at a quota's rank repeats: its rows stay together)."""
    counts = _counted(df, label, id_col, seed).withColumn("_total", F.least(F.lit(n), F.sum("n_label").over(Window.partitionBy())))
    quotas = _largest_remainder(counts, label, "n_label", "_total", "quota").select(label, "quota")
    return within_quotas(df, id_col, quotas, ["quota"], [label], seed).filter("quota_in").select(*df.columns)


def sample_and_combine(d1: DataFrame, d2: DataFrame, id_col: str, target: int = TARGET_DATASET_SIZE,
                       seed: int = SEED) -> DataFrame:
    """All of ``d2`` plus ``min(target - |d2|, |d1|)`` rows of ``d1`` in hash order
    (none when ``|d2| >= target``); column ``origin`` says which input.
    ``|d2|`` is one scalar fetched to the driver."""
    n2 = d2.count()
    quota = d1.sparkSession.range(1).select(F.lit(max(target - n2, 0)).alias("take"))
    part1 = within_quotas(d1, id_col, quota, ["take"], [], seed).filter("take_in") \
        .select(*d1.columns).withColumn("origin", F.lit("d1"))
    return part1.unionByName(d2.withColumn("origin", F.lit("d2")), allowMissingColumns=True)


def shuffled(df: DataFrame, id_col: str, seed: int = SEED) -> DataFrame:
    """Hash-order shuffle with a new dense 0-based ``row_index``."""
    return hash_rank(df, id_col, [], seed, name="row_index").withColumn("row_index", F.col("row_index") - 1)


def balanced_resample(df: DataFrame, label: str = "label", id_col: str = "record_id", seed: int = SEED) -> DataFrame:
    """Class-balanced resampling with replacement, same total size.

    Draw ``j = 0..n-1`` goes to class ``j mod k`` (classes sorted) and picks
    the row of rank ``1 + (hash(seed:draw:j) mod n_c)`` of that class.  Only
    the numbers of rows and classes reach the driver."""
    counts = label_counts(df, label)
    n_rows, k = counts.agg(F.coalesce(F.sum("n_label"), F.lit(0)), F.count(F.lit(1))).first()
    cls = counts.select((F.row_number().over(Window.orderBy(label)) - 1).alias("_ci"), F.col(label).alias("_lab"),
                        F.col("n_label").alias("_nc"))
    draws = df.sparkSession.range(0, n_rows).select(F.col("id").alias("draw"), F.pmod(F.col("id"), F.lit(max(k, 1))).cast("int").alias("_ci"))
    d = draws.join(cls, "_ci")
    hx = F.substring(F.md5(F.concat(F.lit(f"{seed}:draw:"), F.col("draw").cast("string"))), 1, 15)
    d = d.withColumn("_pick", F.pmod(F.conv(hx, 16, 10).cast("long"), F.col("_nc")) + 1)
    ranked = hash_rank(df, id_col, [label], seed, name="_r")
    on = (F.col("d._lab") == F.col(f"r.`{label}`")) & (F.col("d._pick") == F.col("r._r"))
    return d.alias("d").join(ranked.alias("r"), on).select("d.draw", *[F.col(f"r.`{c}`") for c in df.columns])


def inspection_sample(df: DataFrame, label: str = "label", id_col: str = "record_id",
                      quotas: dict | None = None, seed: int = SEED) -> DataFrame:
    """Per-label sample with quota rebalancing: label 0 wants ``quotas[0]``,
    label 1 ``quotas[1]``; a class short of rows gives its shortfall to the
    other (which fills up to the total)."""
    quotas = quotas or {0: 3, 1: 2}
    total = sum(quotas.values())
    counts = _counted(df, label, id_col, seed)
    want = F.create_map(*[x for k, v in sorted(quotas.items()) for x in (F.lit(k), F.lit(v))])
    c = counts.withColumn("_want", F.coalesce(want[F.col(label)], F.lit(0)))
    c = c.withColumn("_got", F.least(F.col("_want"), F.col("n_label")))
    c = c.withColumn("_short", F.sum(F.col("_want") - F.col("_got")).over(Window.partitionBy()))
    c = c.withColumn("quota", F.least(F.col("n_label"), F.col("_got") + F.col("_short")))
    c = c.withColumn("quota", F.when(F.sum("quota").over(Window.partitionBy()) > total, F.col("_got")).otherwise(F.col("quota")))
    return within_quotas(df, id_col, c.select(label, "quota"), ["quota"], [label], seed).filter("quota_in") \
        .select(*df.columns)


__all__ = ["stratified_split", "stratified_folds", "learning_subsets", "subset_of", "stratified_sample",
           "sample_and_combine", "shuffled", "balanced_resample", "inspection_sample", "split_quotas",
           "hash_order"]

"""Filters, data-quality checks and stage reports."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions import features as FT
from ..functions import text as T
from ..functions.constants import (EXTREMELY_LONG_CHARS, MAX_TOKENS, MIN_CLEAN_CHARS, MIN_TOKENS, MISSING_TOKENS,
                                   VERY_LONG_CHARS)


def drop_unlabelled(df: DataFrame, text: str = "text", label: str = "label") -> DataFrame:
    return df.na.drop(subset=[text, label]).withColumn(label, F.col(label).cast("int"))


def require_rows(df: DataFrame, what: str = "dataset") -> DataFrame:
    """Raise when the input is empty (one-row probe, not a count)."""
    if df.isEmpty():
        raise RuntimeError(f"{what} is empty after cleaning; check column names and data")
    return df


def min_length(df: DataFrame, text: str = "text", n: int = MIN_CLEAN_CHARS) -> DataFrame:
    return df.filter(F.length(F.trim(F.col(text))) >= n)


def non_empty(df: DataFrame, text: str = "text") -> DataFrame:
    return df.filter(F.length(F.trim(F.col(text))) > 0)


def token_band(df: DataFrame, text: str = "text", lo: int = MIN_TOKENS, hi: int = MAX_TOKENS) -> DataFrame:
    """Keep rows whose whitespace token count is within [lo, hi]."""
    return df.filter(FT.word_count(F.col(text)).between(lo, hi))


def _missing(c) -> F.Column:
    v = F.trim(F.col(c).cast("string"))
    return v.isNull() | (v == "") | F.lower(v).isin(MISSING_TOKENS)


def completeness(df: DataFrame, row_no: str, checks=("label", "source_file", "source_name"),
                 first_n: int = 10) -> DataFrame:
    """Per check: rows with an empty / 'nan' / 'none' / 'null' value and the
    first ``first_n`` row numbers.  The example list is built from a
    ``row_number() <= first_n`` window (partial limit before the shuffle),
    never from a full collect of the group."""
    counts = df.agg(*[F.sum(_missing(c).cast("long")).alias(f"_n_{c}") for c in checks])
    counts = counts.select(F.explode(F.array(*[
        F.struct(F.lit(f"empty_{c}").alias("issue"), F.coalesce(F.col(f"_n_{c}"), F.lit(0)).alias("n_rows"))
        for c in checks])).alias("x")).select("x.*")
    hits = df.select(F.col(row_no).alias("row_no"), F.explode(F.array(*[
        F.when(_missing(c), F.lit(f"empty_{c}")) for c in checks])).alias("issue")).filter(F.col("issue").isNotNull())
    w = Window.partitionBy("issue").orderBy("row_no")
    first = hits.withColumn("_r", F.row_number().over(w)).filter(F.col("_r") <= first_n) \
                .groupBy("issue").agg(F.sort_array(F.collect_list("row_no")).alias("first_rows"))
    return counts.join(first, "issue", "left") \
                 .withColumn("first_rows", F.coalesce(F.col("first_rows"), F.array().cast("array<long>")))


def long_text(df: DataFrame, text: str, row_no: str, source: str, very: int = VERY_LONG_CHARS,
              extremely: int = EXTREMELY_LONG_CHARS, examples: int = 5) -> DataFrame:
    """Exclusive tiers (> extremely, else > very) with the tier size and the
    first ``examples`` rows of each tier."""
    n = F.length(F.col(text))
    tier = F.when(n > extremely, "extremely_long").when(n > very, "very_long")
    t = df.select(F.col(row_no).alias("row_no"), n.alias("text_length"), F.col(source).alias("source_file"),
                  tier.alias("tier")).filter(F.col("tier").isNotNull())
    w = Window.partitionBy("tier").orderBy("row_no")
    sizes = t.groupBy("tier").agg(F.count(F.lit(1)).alias("tier_rows"))
    ex = t.withColumn("example", F.row_number().over(w)).filter(F.col("example") <= examples)
    return ex.join(sizes, "tier")


def stage_report(stages: list[tuple[str, DataFrame]]) -> DataFrame:
    """Rows before / after / removed for a chain of stage outputs."""
    counts = None
    for i, (name, d) in enumerate(stages):
        c = d.agg(F.count(F.lit(1)).alias("rows")).select(F.lit(i).alias("step"), F.lit(name).alias("stage"), "rows")
        counts = c if counts is None else counts.unionByName(c)
    w = Window.orderBy("step")
    return counts.withColumn("rows_before", F.lag("rows").over(w)) \
                 .withColumn("removed", F.col("rows_before") - F.col("rows")) \
                 .withColumnRenamed("rows", "rows_after")


def stage_report_once(df: DataFrame, stages: list[tuple[str, F.Column]], distinct: tuple[str, F.Column] | None = None,
                      first: str = "master") -> DataFrame:
    """:func:`stage_report` of a chain of filters, with the input read once:
    a row is in a stage where its condition and those before it hold (null
    counts as false), and ``distinct`` (name, key) ends the chain with the
    number of keys left.  Costly values in the conditions are best
    materialised first."""
    names, counts, kept = [first], [F.count(F.lit(1))], F.lit(True)
    for name, condition in stages:
        kept = kept & F.coalesce(condition, F.lit(False))
        names.append(name)
        counts.append(F.count_if(kept))
    if distinct:
        names.append(distinct[0])
        counts.append(F.count_distinct(F.when(kept, distinct[1])))
    row = df.agg(*[c.alias(f"_n{i}") for i, c in enumerate(counts)])
    before = [F.lit(None).cast("long"), *[F.col(f"_n{i}") for i in range(len(names) - 1)]]
    steps = F.array(*[F.struct(F.lit(i).alias("step"), F.lit(name).alias("stage"), F.col(f"_n{i}").alias("rows_after"),
                               before[i].alias("rows_before"), (before[i] - F.col(f"_n{i}")).alias("removed"))
                      for i, name in enumerate(names)])
    return row.select(F.inline(steps))


def unmapped_labels(df: DataFrame, raw: str = "raw_label", mapped: str = "label") -> DataFrame:
    """Distinct raw label values that map to null, with counts (sorted)."""
    return df.filter(F.col(mapped).isNull() & F.col(raw).isNotNull()) \
             .groupBy(F.col(raw).alias("raw_label")).agg(F.count(F.lit(1)).alias("n_rows"))


def error_analysis(pred: DataFrame, truth: str = "true_label", predicted: str = "pred_label",
                   order: str = "confidence", id_col: str = "doc_id", k: int = 10) -> DataFrame:
    """Up to ``k`` false positives and ``k`` false negatives (most confident
    first), the report the analysis prints."""
    kind = (F.when((F.col(truth) == 0) & (F.col(predicted) == 1), "false_positive")
             .when((F.col(truth) == 1) & (F.col(predicted) == 0), "false_negative"))
    e = pred.withColumn("error_type", kind).filter(F.col("error_type").isNotNull())
    w = Window.partitionBy("error_type").orderBy(F.desc(order), F.col(id_col))
    return e.withColumn("example", F.row_number().over(w)).filter(F.col("example") <= k)


def first_message(thread) -> F.Column:
    """Text before the first 'From:', else 'Sent:', else '<html '; when none
    occurs the text loses its last character (reproduced quirk).  The
    slice is not stripped."""
    t = T._col(thread)
    pos = F.coalesce(F.nullif(F.instr(t, "From:"), F.lit(0)), F.nullif(F.instr(t, "Sent:"), F.lit(0)),
                     F.nullif(F.instr(t, "<html "), F.lit(0)))
    cut = F.when(pos.isNotNull(), F.substring(t, F.lit(1), pos - 1)) \
           .otherwise(F.substring(t, F.lit(1), F.greatest(F.length(t) - 1, F.lit(0))))
    return cut

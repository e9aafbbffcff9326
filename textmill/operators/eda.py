"""Exploratory aggregates.

Every aggregate is one ``groupBy`` with map-side combine; top-k per group
uses ``row_number() <= k`` which Spark plans as a partial
``WindowGroupLimit`` before the shuffle, so a group's whole vocabulary never
lands in one task.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions import text as T
from ..functions.constants import HIST_BINS, TOP_NGRAMS, TOP_SOURCES, TOP_WORDS, english_stop_words
from .ranking import few_rows

FEATURES = ["text_length", "word_count", "punct_count", "upper_count"]


def label_distribution(df: DataFrame, label: str = "label") -> DataFrame:
    c = df.groupBy(label).agg(F.count(F.lit(1)).alias("n_rows"))
    return c.withColumn("share_pct", F.round(F.col("n_rows") * 100.0 / F.sum("n_rows").over(Window.partitionBy()), 4))


def split_label_distribution(df: DataFrame, split: str = "split", label: str = "label") -> DataFrame:
    c = df.groupBy(split, label).agg(F.count(F.lit(1)).alias("n_rows"))
    return c.withColumn("share_pct", F.round(F.col("n_rows") * 100.0 / F.sum("n_rows").over(Window.partitionBy(split)), 4))


def split_sizes(df: DataFrame, split: str = "split") -> DataFrame:
    c = df.groupBy(split).agg(F.count(F.lit(1)).alias("n_rows"))
    return c.withColumn("pct", F.round(F.col("n_rows") * 100.0 / F.sum("n_rows").over(Window.partitionBy()), 4))


def top_sources_by_label(df: DataFrame, source: str = "source_file", label: str = "label",
                         k: int = TOP_SOURCES) -> DataFrame:
    """Label counts for the ``k`` largest sources (ties by name), with the
    source's rank.  The top-k list has at most ``k`` rows and is broadcast."""
    totals = df.groupBy(source).agg(F.count(F.lit(1)).alias("source_rows"))
    top = totals.orderBy(F.desc("source_rows"), F.col(source)).limit(k) \
                .withColumn("source_rank", F.row_number().over(Window.orderBy(F.desc("source_rows"), F.col(source))))
    counts = df.join(F.broadcast(top.select(source)), source, "left_semi") \
               .groupBy(source, label).agg(F.count(F.lit(1)).alias("n_rows"))
    return counts.join(F.broadcast(top), source)


def _long_features(df: DataFrame, features: list[str], label: str) -> DataFrame:
    stack = F.explode(F.array(*[F.struct(F.lit(f).alias("feature"), F.col(f).cast("double").alias("value"))
                                for f in features]))
    return df.select(F.col(label), stack.alias("_f")).select(label, "_f.feature", "_f.value")


def feature_histogram(df: DataFrame, features=FEATURES, label: str = "label", bins: int = HIST_BINS) -> DataFrame:
    """``bins`` equal-width bins per feature over the common [min, max] of
    all labels; counts per (feature, label, bin).  The max falls in the last
    bin.  Rows are counted per value first, so the input is read once; bounds
    are a 1-row-per-feature table joined by feature name."""
    long = _long_features(df, list(features), label).groupBy("feature", label, "value").agg(F.count(F.lit(1)).alias("n"))
    counted = F.when(F.col("n") > 0, F.col("value"))  # asks for n, so that bounds and bins share one exchange
    bounds = long.groupBy("feature").agg(F.min(counted).alias("lo"), F.max(counted).alias("hi"))
    j = long.join(F.broadcast(bounds), "feature")
    width = F.col("hi") - F.col("lo")
    b = F.when(width > 0, F.least(F.floor((F.col("value") - F.col("lo")) / width * bins), F.lit(bins - 1))).otherwise(0)
    out = j.withColumn("bin", b.cast("int")).groupBy("feature", label, "bin", "lo", "hi") \
           .agg(F.sum("n").alias("n_rows"))
    w = F.col("hi") - F.col("lo")
    return out.select("feature", label, "bin",
                      (F.col("lo") + F.col("bin") * w / bins).alias("bin_lo"),
                      (F.col("lo") + (F.col("bin") + 1) * w / bins).alias("bin_hi"), "n_rows")


def feature_p99(df: DataFrame, features=FEATURES, q: float = 0.99, exact: bool = True) -> DataFrame:
    """Linear-interpolated quantile per feature (exact: Spark keeps a
    value->count map per group, bounded by distinct feature values)."""
    long = _long_features(df.withColumn("_one", F.lit(1)), list(features), "_one")
    agg = F.percentile(F.col("value"), q) if exact else F.percentile_approx(F.col("value"), q, 10000).cast("double")
    return long.groupBy("feature").agg(agg.alias("p99"))


def feature_correlation(df: DataFrame, cols: list[str]) -> DataFrame:
    """Pearson correlation matrix in long form (a, b, corr), one pass.
    A constant column yields null (Spark ANSI would raise on 0/0)."""
    d = df.select(*[F.col(c).cast("double").alias(c) for c in cols])
    aggs = [F.stddev_pop(c).alias(f"_sd_{c}") for c in cols]
    pairs = [(a, b) for i, a in enumerate(cols) for b in cols[i + 1:]]
    aggs += [F.covar_pop(a, b).alias(f"_cov_{a}_{b}") for a, b in pairs]
    s = d.agg(*aggs)
    entries = []
    for a in cols:
        for b in cols:
            if a == b:
                val = F.when(F.col(f"_sd_{a}") > 0, F.lit(1.0))
            else:
                x, y = (a, b) if (a, b) in pairs else (b, a)
                den = F.col(f"_sd_{x}") * F.col(f"_sd_{y}")
                val = F.when(den > 0, F.col(f"_cov_{x}_{y}") / den)
            entries.append(F.struct(F.lit(a).alias("feature_a"), F.lit(b).alias("feature_b"),
                                    val.cast("double").alias("corr")))
    return s.select(F.explode(F.array(*entries)).alias("e")).select("e.*")


def tokens_no_stop(text_col, stop_words=None):
    sw = english_stop_words() if stop_words is None else stop_words
    return T.remove_stop_words(T.word_tokens(text_col), sw)


def top_ngrams(df: DataFrame, text: str = "text", label: str = "label", ns=(1, 2), k: int = TOP_NGRAMS,
               stop_words=None) -> DataFrame:
    """Top-k n-grams per (label, n) by total count, ties by term.  Stop words
    are removed before n-grams are formed."""
    toks = df.select(label, tokens_no_stop(F.col(text), stop_words).alias("_t"))
    grams = F.explode(F.array(*[F.struct(F.lit(n).alias("n"), T.ngrams(F.col("_t"), n).alias("g")) for n in ns]))
    long = toks.select(label, grams.alias("_x")).select(label, "_x.n", T.explode_terms("_x.g").alias("term")) \
               .filter(F.col("term").isNotNull())
    counts = long.groupBy(label, "n", "term").agg(F.count(F.lit(1)).alias("n_count"))
    w = Window.partitionBy(label, "n").orderBy(F.desc("n_count"), F.col("term"))
    return counts.withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= k)


def word_frequencies(df: DataFrame, text: str = "text", group_cols=("label",), k: int = TOP_WORDS,
                     stop_words=None) -> DataFrame:
    """Top-k words per group with frequency relative to the group's top word."""
    g = list(group_cols)
    long = df.select(*g, T.explode_terms(tokens_no_stop(F.col(text), stop_words)).alias("word")) \
             .filter(F.col("word").isNotNull())
    counts = long.groupBy(*g, "word").agg(F.count(F.lit(1)).alias("n_count"))
    w = Window.partitionBy(*g).orderBy(F.desc("n_count"), F.col("word"))
    top = counts.withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= k)
    return top.withColumn("scale", F.round(F.col("n_count") / F.max("n_count").over(Window.partitionBy(*g)), 9))


def class_weights(df: DataFrame, label: str = "label") -> DataFrame:
    """Balanced weights ``n / (k * n_c)``."""
    c = df.groupBy(label).agg(F.count(F.lit(1)).alias("n_label"))
    all_ = Window.partitionBy()
    return c.withColumn("weight", F.sum("n_label").over(all_) / (F.count(F.lit(1)).over(all_) * F.col("n_label")))


def sample_weights(df: DataFrame, label: str = "label") -> DataFrame:
    """Per-row inverse class frequency ``1 / n_c``; the class table is
    broadcast where its counted rows are few."""
    c = df.groupBy(label).agg(F.count(F.lit(1)).alias("n_label"))
    return df.join(F.broadcast(c) if few_rows(df.select(label).distinct()) else c, label).withColumn("sample_weight", 1.0 / F.col("n_label")).drop("n_label")

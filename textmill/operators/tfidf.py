"""Long-form TF-IDF and scalers (M1-M3).

Tokens: lower-cased runs of 2+ word characters, stop words removed, then
n-grams.  Vocabulary: the ``max_features`` terms with the highest corpus
count (ties by term).  idf = ln((1 + n_docs) / (1 + df)) + 1; rows are
L2-normalised.

Plan shape: token arrays are hash-partitioned by document once; the
``(doc, term)`` count and the per-document norm window reuse that
partitioning (no further shuffle of the document side).  Term statistics
are a map-side-combined aggregate; a vocabulary of at most ``max_features``
terms is broadcast, as a join by term would shuffle every count twice.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions import text as T
from ..functions.barrier import materialize
from ..functions.constants import english_stop_words


def doc_terms(df: DataFrame, text: str, id_col: str, ngram=(1, 2), stop_words=None, by_doc: bool = False) -> DataFrame:
    """(doc_id, terms), with ``by_doc`` hash-partitioned by document.  Tokens are projected first and n-grams built from
    that column: the tokenizer must not be inlined into the n-gram lambda
    (it would run once per element)."""
    sw = english_stop_words() if stop_words is None else stop_words
    toks = df.select(F.col(id_col).alias("doc_id"), T.remove_stop_words(T.word_tokens(F.col(text)), sw).alias("_t"))
    if by_doc:  # the tokens are shuffled, not the n-grams made of them
        toks = toks.repartition("doc_id")
    return toks.select("doc_id", T.ngram_range(F.col("_t"), ngram[0], ngram[1]).alias("terms"))


def term_counts(terms: DataFrame, partitions: int | None = None, by_doc: bool = False) -> DataFrame:
    """(doc_id, term, tf) with documents hash-partitioned once (``by_doc``:
    they are already)."""
    t = terms if by_doc else terms.repartition(partitions, "doc_id") if partitions else terms.repartition("doc_id")
    return t.select("doc_id", T.explode_terms("terms").alias("term")).filter(F.col("term").isNotNull()) \
            .groupBy("doc_id", "term").agg(F.count(F.lit(1)).alias("tf"))


def term_stats(terms: DataFrame, by: Iterable[str] = ()) -> DataFrame:
    """(term, df, total), for each value of the columns ``by``, straight from
    the term arrays: a document's terms are sorted in the row, and its first of
    each marks the document, so nothing is shuffled but the map-side sums per
    term."""
    d = materialize(terms.select(*by, "terms"), "terms", F.sort_array("terms"))
    marked = F.transform("terms", lambda t, i: F.struct(
        t.alias("term"), ((i == 0) | (F.get("terms", i - 1) != t)).cast("int").alias("first")))
    return (d.select(*by, F.explode_outer(marked).alias("t")).filter(F.col("t.term").isNotNull())
            .groupBy(*by, "t.term").agg(F.sum("t.first").alias("df"), F.count(F.lit(1)).alias("total")))


def fit_vocabulary(tf: DataFrame, max_features: int | None) -> DataFrame:
    """(term, df, total, term_index) for the top terms by corpus count."""
    return top_terms(tf.groupBy("term").agg(F.count(F.lit(1)).alias("df"), F.sum("tf").alias("total")), max_features)


def top_terms(stats: DataFrame, max_features: int | None) -> DataFrame:
    if max_features is not None:
        stats = stats.orderBy(F.desc("total"), F.col("term")).limit(max_features)
    return stats.withColumn("term_index", (F.row_number().over(Window.orderBy(F.desc("total"), F.col("term"))) - 1).cast("int"))


def idf_table(vocab: DataFrame, docs: DataFrame) -> DataFrame:
    n_docs = docs.select(F.count(F.lit(1))).scalar()
    return vocab.withColumn("idf", F.log((F.lit(1.0) + n_docs) / (F.lit(1.0) + F.col("df"))) + F.lit(1.0))


def tfidf_long(tf: DataFrame, idf: DataFrame) -> DataFrame:
    """(doc_id, term, term_index, tf, tfidf) with unit L2 norm per document."""
    j = tf.join(idf.select("term", "term_index", "idf"), "term")
    raw = F.col("tf") * F.col("idf")
    norm = F.sqrt(F.sum(raw * raw).over(Window.partitionBy("doc_id")))
    return j.select("doc_id", "term", "term_index", "tf", (raw / norm).alias("tfidf"))


def tfidf(df: DataFrame, text: str, id_col: str, max_features: int | None = 20000, ngram=(1, 2),
          stop_words=None) -> DataFrame:
    terms = doc_terms(df, text, id_col, ngram, stop_words, by_doc=True)
    tf = term_counts(terms, by_doc=True)
    idf = idf_table(fit_vocabulary(tf, max_features), df)
    # A bounded vocabulary goes to the counts, which stay where their document is.
    return tfidf_long(tf, idf if max_features is None else F.broadcast(idf))


def standard_scale(df: DataFrame, cols: list[str]) -> DataFrame:
    """(x - mean) / population std; constant columns divide by 1.  Means and
    stds are one scalar subquery (no join): one pass for all columns."""
    stats = df.agg(F.struct(*[F.struct(F.avg(c).alias("m"), F.stddev_pop(c).alias("s")).alias(c) for c in cols])).scalar()
    out = df
    for c in cols:
        st = stats[c]
        sd = F.when(st["s"] > 0, st["s"]).otherwise(F.lit(1.0))
        out = out.withColumn(f"{c}_std", (F.col(c) - st["m"]) / sd)
    return out


def minmax_scale(df: DataFrame, cols: list[str]) -> DataFrame:
    """(x - min) / (max - min), 0 when the range is 0, clipped at >= 0; the
    ranges of all columns are one scalar subquery."""
    stats = df.agg(F.struct(*[F.struct(F.min(c).cast("double").alias("lo"), F.max(c).cast("double").alias("hi")).alias(c) for c in cols])).scalar()
    out = df
    for c in cols:
        st = stats[c]
        rng = st["hi"] - st["lo"]
        out = out.withColumn(f"{c}_mm", F.greatest(F.lit(0.0), F.when(rng > 0, (F.col(c) - st["lo"]) / rng).otherwise(F.lit(0.0))))
    return out


def naive_bayes_closed_form(train_tf: DataFrame, train_labels: DataFrame, test_tf: DataFrame, test_docs: DataFrame,
                            alpha: float = 1.0, vocab: DataFrame | None = None) -> DataFrame:
    """Multinomial NB on term counts, in DataFrame form.

    train_tf / test_tf: (doc_id, term, tf); train_labels: (doc_id, label);
    test_docs: (doc_id) of all test documents, also those without a term.
    Returns (doc_id, label, log_score) for every test document and label; a
    document without a known term gets the class priors."""
    lab = train_labels.select("doc_id", "label")
    t = train_tf.join(lab, "doc_id")
    if vocab is not None:
        t = t.join(vocab.select("term"), "term", "left_semi")
    # One row a term, with its count under each label; persisted, as sizes and
    # totals come from it too and the rows of the documents are read once.
    counts = t.groupBy("label", "term").agg(F.sum("tf").alias("n")) \
              .groupBy("term").agg(F.collect_list(F.struct("label", "n")).alias("seen")).persist()
    v_size = counts.select(F.count(F.lit(1))).scalar()
    n_docs = lab.select(F.count(F.lit(1))).scalar()
    priors = lab.groupBy("label").agg(F.log(F.count(F.lit(1)) / n_docs).alias("log_prior"))
    totals = counts.select(F.explode("seen").alias("s")).groupBy("s.label").agg(F.log(F.sum("s.n") + F.lit(alpha) * v_size).alias("log_denom"))
    # The labels are few and ride along as a scalar subquery.
    classes = priors.join(totals, "label").select(
        F.sort_array(F.collect_list(F.struct("label", "log_prior", "log_denom")))).scalar()
    # Terms never seen in training are ignored; a seen term never seen with a
    # label counts alpha there.
    known = test_tf.join(counts, "term").select("doc_id", "tf", "seen", F.explode(classes).alias("c"))
    n = F.aggregate(F.filter("seen", lambda s: s["label"] == F.col("c.label")), F.lit(0).cast("long"), lambda a, s: a + s["n"])
    sums = known.groupBy("doc_id", F.col("c.label").alias("label")).agg(
        F.sum(F.col("tf") * (F.log(n + F.lit(alpha)) - F.col("c.log_denom"))).alias("_ll"))
    docs = test_docs.select("doc_id").distinct().select("doc_id", F.explode(classes).alias("c")) \
                    .select("doc_id", "c.label", "c.log_prior")
    return docs.join(sums, ["doc_id", "label"], "left").select(
        "doc_id", "label", (F.col("log_prior") + F.coalesce(F.col("_ll"), F.lit(0.0))).alias("log_score"))


def argmax_label(scores: DataFrame) -> DataFrame:
    """Highest ``log_score`` label per doc (ties: smaller label)."""
    return scores.groupBy("doc_id").agg(
        F.max_by(F.col("label"), F.struct(F.col("log_score"), -F.col("label"))).alias("pred_label"))

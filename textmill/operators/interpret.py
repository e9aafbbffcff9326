"""Token-weight operators."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType

from ..functions.constants import NEWLINE_MARK, SPECIAL_TOKENS, WORD_START_MARK

#: Documents that may have more tokens than this are not held in one task's memory.
ROW_TOKENS = 1 << 18


def top_terms(df: DataFrame, doc: str = "doc_id", term: str = "term", weight: str = "weight", k: int = 15) -> DataFrame:
    """Top-k weighted terms per document (ties by term)."""
    w = Window.partitionBy(doc).orderBy(F.desc(weight), F.col(term))
    return df.withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= k)


def whole_rows(df: DataFrame, doc: str, size: Column, most: int = ROW_TOKENS) -> tuple[DataFrame, DataFrame]:
    """(rows that hold their document alone and give at most ``most`` tokens,
    all other rows).  ``size``: a bound of a row's tokens, null for none.

    Exploded, the first give tokens that lie together by document, as
    ``together`` below wants them; the others go through a shuffle."""
    n = df.withColumn("_rows", F.count(F.lit(1)).over(Window.partitionBy(doc)))
    whole = (F.col("_rows") == 1) & (F.coalesce(size, F.lit(0)) <= most)
    return n.filter(whole).drop("_rows"), n.filter(~whole).drop("_rows")


def merge_subwords(tokens: DataFrame, doc: str = "doc_id", pos: str = "pos", token: str = "token",
                   weight: str = "weight", together: bool = False) -> DataFrame:
    """Merge sub-word pieces into words.

    Special tokens are dropped; the word-start and newline markers are
    stripped; pieces that are empty or blank afterwards are dropped.  A new
    word starts at each marked piece, and the first kept piece of a document
    always starts one.  Word = pieces concatenated in order, weight = mean.

    ``together``: the tokens of each document follow one another in one
    partition, in any order; they are merged there and not shuffled."""
    if together:
        t = tokens.select(F.col(doc).alias("doc"), F.col(pos).cast("long").alias("pos"), F.col(token).alias("token"),
                          F.col(weight).cast("double").alias("weight"))
        out = t.select(F.col("doc").alias(doc), F.lit(0).cast("long").alias("word_no"), F.lit("").alias("word"), "weight").schema
        return t.mapInArrow(_by_documents(_words, "doc"), _nullable(out))
    t = tokens.filter(~F.col(token).isin(SPECIAL_TOKENS))
    t = t.withColumn("_piece", _unmarked(F.col(token))).filter(F.length(F.trim(F.col("_piece"))) > 0)
    t = t.withColumn("_start", F.col(token).startswith(WORD_START_MARK).cast("int"))
    w = Window.partitionBy(doc).orderBy(pos)
    t = t.withColumn("_first", (F.row_number().over(w) == 1).cast("int"))
    t = t.withColumn("word_no", F.sum(F.greatest("_start", "_first")).over(w.rowsBetween(Window.unboundedPreceding, 0)))
    g = t.groupBy(doc, "word_no").agg(
        F.sort_array(F.collect_list(F.struct(F.col(pos), F.col("_piece")))).alias("_p"),
        F.avg(weight).alias("weight"))
    return g.select(doc, "word_no", F.array_join(F.transform("_p", lambda s: s["_piece"]), "").alias("word"), "weight")


def _unmarked(token: Column) -> Column:
    return F.replace(F.replace(token, F.lit(WORD_START_MARK), F.lit("")), F.lit(NEWLINE_MARK), F.lit(""))


def _nullable(schema: StructType) -> StructType:
    return StructType([StructField(f.name, f.dataType) for f in schema])


def _run_starts(t: pa.Table, doc: str) -> np.ndarray:
    """Where the rows of each document begin."""
    ends = pc.run_end_encode(t.column(doc).combine_chunks()).run_ends.to_numpy()
    return np.concatenate([[0], ends[:-1]])


def _by_documents(work, doc: str, rows: int = 1 << 16):
    """``work`` on tables of some ``rows`` rows that hold whole documents; rows
    of the last one wait for the next batch."""
    def run(batches):
        held, n, due = [], 0, rows
        for b in batches:
            held.append(b)
            n += b.num_rows
            if n < due:
                continue
            t = pa.Table.from_batches(held)
            cut = int(_run_starts(t, doc)[-1])
            if cut:
                yield from work(t.slice(0, cut)).to_batches()
            held, n = t.slice(cut).to_batches(), n - cut
            due = max(rows, 2 * n)
        if n:
            yield from work(pa.Table.from_batches(held)).to_batches()
    return run


def _words(t: pa.Table) -> pa.Table:
    """Words of the tokens (doc, pos, token, weight) of whole documents."""
    token = t.column("token").combine_chunks()
    piece = pc.replace_substring(pc.replace_substring(token, WORD_START_MARK, ""), NEWLINE_MARK, "")
    kept = pc.and_(pc.invert(pc.is_in(token, pa.array(SPECIAL_TOKENS, token.type))),
                   pc.greater(pc.binary_length(pc.utf8_trim(piece, " ")), 0)).fill_null(False)
    at = np.flatnonzero(kept.to_numpy(zero_copy_only=False))
    starts = _run_starts(t, "doc")
    run = np.repeat(np.arange(len(starts)), np.diff(starts, append=t.num_rows))
    pos = t.column("pos").combine_chunks()
    known, pos = pos.is_valid().to_numpy(zero_copy_only=False), pos.fill_null(0).to_numpy()
    same = run[at[1:]] == run[at[:-1]]
    if not known.all() or (same & (pos[at[1:]] < pos[at[:-1]])).any():
        at = at[np.lexsort((pos[at], known[at], run[at]))]
    run, pos, known = run[at], pos[at], known[at]

    first = np.concatenate([[True], run[1:] != run[:-1]])[:len(at)]
    start = first | pc.starts_with(token, WORD_START_MARK).take(pa.array(at)).to_numpy(zero_copy_only=False)
    begin = np.flatnonzero(start)
    weight = t.column("weight").combine_chunks().take(pa.array(at))
    if not len(at):
        sums = counts = np.zeros(0)
    else:
        sums = np.add.reduceat(weight.fill_null(0).to_numpy(), begin)
        counts = np.add.reduceat(weight.is_valid().to_numpy(zero_copy_only=False).astype(np.int64), begin)
    if (~start[1:] & (pos[1:] == pos[:-1])).any():  # within a word ties go by piece
        keys = pa.table({"word": np.cumsum(start), "known": known.astype(np.int8), "pos": pos, "piece": piece.take(pa.array(at))})
        at = at[pc.sort_indices(keys, [(k, "ascending") for k in keys.column_names]).to_numpy()]
    runs = pa.ListArray.from_arrays(pa.array(np.append(begin, len(at)), pa.int32()), piece.take(pa.array(at)))
    no = np.arange(len(begin))
    return pa.table({
        "doc": t.column("doc").take(pa.array(at[begin])),
        "word_no": no - np.maximum.accumulate(np.where(first[begin], no, 0)) + 1,
        "word": pc.binary_join(runs, ""),
        "weight": pa.array(sums / np.maximum(counts, 1), mask=counts == 0)})


def normalise_weights(df: DataFrame, doc: str = "doc_id", weight: str = "weight", eps: float = 1e-9,
                      together: bool = False) -> DataFrame:
    """Per-document min-max scaling; raw weights when the range is < eps.

    ``together``: as in ``merge_subwords``."""
    if together:
        df = df.withColumn("norm_weight", F.col(weight).cast("double"))
        return df.mapInArrow(_by_documents(lambda t: _scaled(t, doc, eps), doc), _nullable(df.schema))
    w = Window.partitionBy(doc)
    lo, hi = F.min(weight).over(w), F.max(weight).over(w)
    rng = hi - lo
    return df.withColumn("norm_weight", F.when(rng >= eps, (F.col(weight) - lo) / rng).otherwise(F.col(weight)))


def _scaled(t: pa.Table, doc: str, eps: float) -> pa.Table:
    """The last column scaled by document.  NaN is the largest value, as in
    Spark; nulls stay."""
    x = t.column("norm_weight").combine_chunks()
    null, starts = x.is_null().to_numpy(zero_copy_only=False), _run_starts(t, doc)
    x = x.fill_null(np.nan).to_numpy()
    n = np.diff(starts, append=t.num_rows)
    lo = np.repeat(np.fmin.reduceat(x, starts), n)
    with np.errstate(invalid="ignore", divide="ignore"):
        width = np.repeat(np.maximum.reduceat(np.where(null, -np.inf, x), starts), n) - lo
        scaled = np.where(width < eps, x, (x - lo) / width)
    return t.set_column(t.num_columns - 1, "norm_weight", pa.array(scaled, mask=null))


def contributions(tfidf_long: DataFrame, coef: DataFrame, doc: str = "doc_id", term: str = "term",
                  k: int = 15) -> DataFrame:
    """Per-document top-k terms by ``tfidf * coefficient`` (linear model
    explanation).  ``coef``: (term, coef)."""
    j = tfidf_long.join(coef, term).withColumn("weight", F.col("tfidf") * F.col("coef"))
    return top_terms(j, doc, term, "weight", k)

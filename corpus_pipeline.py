"""A corpus pipeline over ``documents``: each stage takes the documents that
the one before kept, and its decisions take effect.

    toxicity           documents that score 0.7 or more go
    language           documents of no recognised language go
    near duplicates    of each group of near copies one document stays
    decontamination    documents in which a benchmark window occurs go
    BPE                the rest is encoded, and decoded as a check

All stages but the last return the columns of the table.  Null texts pass as
empty ones up to the language stage, which they do not survive.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from textmill.llm import bpe, decontam, lang_id, simhash, token_count, toxicity
from textmill.llm.common import read, stored

TOKENIZER = "byte_bpe_50k.json"


def remove_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows that score below 0.7, null and empty texts too.  Without labels
    every row scores 0.5 and stays."""
    return toxicity.drop_toxic(docs, read(spark, sf_dir, "labels"), threshold=0.7)


def keep_identified(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows whose language is recognised with a calibrated chance of 0.5 or
    more; null texts and texts without a letter go, and all rows where no
    language can be learned."""
    return lang_id.drop_unidentified(docs, least=0.5)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group of near copies: that of the smallest doc_id.
    Rows without a doc_id stay; repeated rows leave one."""
    return simhash.drop_near_duplicates(docs, words=3, max_bits=3)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows in which no benchmark window occurs; all where the benchmark is
    empty."""
    return decontam.drop_contaminated(docs, read(spark, sf_dir, "benchmark"), width=10)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """(doc_id, ids, n_tokens, round_trip): round_trip tells whether the
    decoded ids are the text."""
    vocab = token_count.vocabulary(spark, public_tokenizers.path(TOKENIZER))
    return (docs.select("doc_id", bpe.encode_checked(vocab, "text").alias("r"))
            .select("doc_id", "r.ids", F.size("r.ids").cast("long").alias("n_tokens"), "r.round_trip"))


STAGES = [
    ("toxicity", remove_toxic),
    ("language", keep_identified),
    ("near_duplicates", drop_near_duplicates),
    ("decontamination", drop_contaminated),
    ("bpe", encode),
]

ORACLE_SQL = None  # learned filters and tokenizer merges have no SQL form; see tests/llm


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last stage's rows for the whole table; every stage is written to
    the shared folder and read again."""
    docs = read(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs

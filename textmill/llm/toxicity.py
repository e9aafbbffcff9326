"""Toxicity scores: logistic regression over hashed word n-grams and
skip-grams, learned with FTRL-proximal.

Words are runs of letters and digits (A-Z lower-cased).  The features of a
text are the distinct hashes of its words, neighbouring pairs and pairs with
one word between them; whether a feature occurs counts, not how often or among
how many, so a few words decide in a long text as in a short one.  The L1
penalty leaves few weights, which are broadcast.  Averaging shards shrinks the
weights of rare but telling features, so a second, light pass over the chosen
features of the whole sample weighs them anew.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import crc_mod, stored, text_bytes
from .decontam import words
from .ftrl import Settings, bounded, fit, flat

BITS = 20
SAMPLE_ROWS = 40_000  # labelled rows to learn from, at most about so many
THRESHOLD = 0.7
CHOICE = Settings(alpha=1.0, beta=1.0, l1=3.0, l2=0.0, epochs=3, shard_rows=5000)             # finds the features
REFIT = Settings(alpha=1.0, beta=1.0, l1=2.0, l2=0.0, epochs=6, shard_rows=SAMPLE_ROWS * 2)   # weighs them


class Hashes(dict):
    """Word -> 32-bit hash."""

    def __missing__(self, word: bytes) -> int:
        if len(self) > 400_000:
            self.clear()
        self[word] = h = zlib.crc32(word)
        return h


def grams(text: bytes, hashes: Hashes) -> np.ndarray:
    """Feature of every word, pair and skip pair, repeats included."""
    w = words(text)
    h = np.fromiter(map(hashes.__getitem__, w), np.uint32, len(w))
    a, b, c = (np.uint32(x) for x in (0x9E3779B1, 0x85EBCA77, 0xC2B2AE3D))
    pair, skip = (h[:-1] * b) ^ (h[1:] * c + a), (h[:-2] * c) ^ (h[2:] * a + b)
    return (np.concatenate((h * a, pair * a, skip * b)) >> np.uint32(32 - BITS)).astype(np.int64)


@dataclass(frozen=True)
class Model:
    features: np.ndarray
    weights: np.ndarray
    bias: float

    def dense(self) -> np.ndarray:
        w = np.zeros(1 << BITS)
        w[self.features] = self.weights
        return w


def train(docs: DataFrame, labels: DataFrame, sample_rows: int = SAMPLE_ROWS) -> Model:
    """Learn from the documents whose crc32(doc_id as text) mod 3 is not 1 and
    that have a non-null ``toxic`` label; of repeated labels the largest
    counts, and repeated documents count as often as they stand.  Without such rows the model scores 0.5 everywhere."""
    known = (labels.where("toxic is not null and doc_id is not null").where(crc_mod("doc_id", 3) != 1)
             .groupBy("doc_id").agg(F.max((F.col("toxic") > 0).cast("int")).alias("target")))
    picked = bounded(known, "doc_id", sample_rows, "toxicity")  # an id and a bit for each of a bounded number of rows

    @F.arrow_udf("array<int>")
    def features(texts: Iterator[pa.Array]) -> Iterator[pa.Array]:
        hashes = Hashes()
        for t in texts:
            yield pa.array([np.unique(grams(x, hashes)).astype(np.int32) for x in t.to_pylist()], pa.list_(pa.int32()))

    rows = (docs.select("doc_id", text_bytes().alias("body")).join(F.broadcast(picked), "doc_id")
            .select(F.col("doc_id").alias("id"), features("body").alias("features"), "target"))
    sample = stored(rows, "toxicity-sample")
    at, _ = fit(sample, 1 << BITS, 1, CHOICE)
    chosen = np.zeros((1 << BITS) + 1, bool)
    chosen[at] = True
    mask = docs.sparkSession.sparkContext.broadcast(chosen)

    @F.arrow_udf("array<int>")
    def left(features: pa.Array) -> pa.Array:
        values, at = flat(features)
        kept = mask.value[values]
        ends = np.concatenate(([0], np.cumsum(kept)))[at]
        return pa.ListArray.from_arrays(pa.array((ends - ends[0]).astype(np.int32)), pa.array(values[at[0]:][kept[at[0]:]].astype(np.int32)))

    light = sample.select("id", left("features").alias("features"), "target")
    at, w = fit(light, 1 << BITS, 1, REFIT)
    own = at < 1 << BITS
    return Model(at[own], w[own, 0], float(w[~own, 0].sum()))


def score(model: Broadcast, text: str | Column = "text") -> Column:
    """A column: the chance (0 to 1) that the text is toxic.  Null or empty
    texts get the score of a text without features."""
    @F.arrow_udf("double")
    def run(texts: Iterator[pa.Array]) -> Iterator[pa.Array]:
        hashes, dense, bias = Hashes(), model.value.dense(), model.value.bias
        for t in texts:
            out = []
            for x in t.to_pylist():
                g = grams(x, hashes)
                out.append(bias + dense[np.unique(g[dense[g] != 0])].sum())
            yield pa.array(1 / (1 + np.exp(-np.clip(np.array(out, np.float64), -500, 500))))

    return run(text_bytes(text))


def broadcast_model(spark: SparkSession, model: Model) -> Broadcast:
    return spark.sparkContext.broadcast(model)  # at most 2^BITS weights


def score_table(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """(doc_id, held_out, score, predicted), a row for every row of ``docs``;
    other columns are not read.  A null id is not held out and not learned
    from."""
    model = broadcast_model(docs.sparkSession, train(docs, labels))
    return (docs.select("doc_id", F.coalesce(crc_mod("doc_id", 3) == 1, F.lit(False)).alias("held_out"), score(model).alias("score"))
            .withColumn("predicted", (F.col("score") >= threshold).cast("int")))


def drop_toxic(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """The documents that score below the threshold, all columns kept."""
    return docs.where(score(broadcast_model(docs.sparkSession, train(docs, labels))) < threshold)

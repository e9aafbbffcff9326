"""Language identification: sparse multinomial logistic regression on TF-IDF
character n-grams, learned by follow-the-regularised-leader with an elastic
net (L1 and L2), then calibrated with a temperature.

Features are hashed n-grams of 1 to 3 characters of the lower-cased text,
weighted (1 + ln tf) * idf and scaled to length one.  Document frequencies
come from every training document; weights from a bounded sample of them, the
temperature from another, disjoint one.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import crc_mod, stored, text_bytes
from .ftrl import Settings, bounded, fit

BITS = 15
SAMPLE_ROWS = 12_000      # labelled rows for the weights, at most about so many
CALIBRATION_ROWS = 4_000  # and for the temperature
MOST_CLASSES = 500        # languages that get weights, the ones with the most rows
UNKNOWN = "und"
SETTINGS = Settings(alpha=0.5, beta=1.0, l1=0.02, l2=0.001, epochs=3, shard_rows=3000)
TEMPERATURES = tuple(round(0.05 * 1.15 ** k, 4) for k in range(40))


def counts(text: bytes) -> tuple[np.ndarray, np.ndarray]:
    """(features, how often) of a whole text, ascending."""
    c = np.frombuffer(text.decode("utf-8", "replace").lower().encode("utf-32-le"), np.uint32)
    a, b = np.uint32(0x9E3779B1), np.uint32(0x85EBCA77)
    two = c[:-1] * a + c[1:]
    three = two[:-1] * a + c[2:]
    out = np.zeros(1 << BITS, np.int64)
    for salt, h in ((1, c), (2, two), (3, three)):
        h = (h + np.uint32(salt)) * b
        h ^= h >> np.uint32(13)
        out += np.bincount(h * a >> np.uint32(32 - BITS), minlength=1 << BITS)
    at = np.flatnonzero(out)
    return at, out[at]


def tfidf(text: bytes, idf: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    at, n = counts(text)
    v = (1 + np.log(n)) * idf[at]
    return at, v / max(np.sqrt(v @ v), 1e-12)


def document_frequencies(texts: DataFrame) -> tuple[int, np.ndarray]:
    """(documents, documents with each feature) over all rows of ``body``."""
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, df = 0, np.zeros((1 << BITS) + 1, np.int64)
        for b in batches:
            for x in b.column(0).to_pylist():
                df[counts(x)[0]] += 1
            n += b.num_rows
        df[-1] = n
        at = np.flatnonzero(df)
        yield pa.RecordBatch.from_pydict({"feature": pa.array(at.astype(np.int32)), "n": pa.array(df[at])})

    got = texts.select("body").mapInArrow(count, "feature int, n long").groupBy("feature").agg(F.sum("n").alias("n")).toPandas()
    df = np.zeros((1 << BITS) + 1, np.int64)
    df[got["feature"].to_numpy()] = got["n"].to_numpy()
    return int(df[-1]), df[:-1]


@dataclass(frozen=True)
class Model:
    languages: list[str]
    idf: np.ndarray
    weights: np.ndarray  # features + bias, by language
    temperature: float

    def logits(self, text: bytes) -> np.ndarray:
        at, v = tfidf(text, self.idf)
        return v @ self.weights[at] + self.weights[-1]


def train(docs: DataFrame, lang_col: str = "lang", sample_rows: int = SAMPLE_ROWS,
          calibration_rows: int = CALIBRATION_ROWS, settings: Settings = SETTINGS,
          most_classes: int = MOST_CLASSES) -> Model:
    """Learn from text and language of the documents whose crc32(doc_id as
    text) mod 3 is not 1, where both are given.  Without such rows the model
    knows no language.

    Of more than ``most_classes`` languages those with the most rows (then the
    smaller name) are learned; rows of the others are not learned from, and
    their texts get the likeliest of the learned ones."""
    spark = docs.sparkSession
    rows = (docs.where(F.col(lang_col).isNotNull() & F.col("text").isNotNull() & (crc_mod("doc_id", 3) != 1))
            .select("doc_id", F.col(lang_col).alias("language"), text_bytes().alias("body")))
    found = rows.groupBy("language").count().orderBy(F.desc("count"), "language").limit(most_classes + 1).collect()
    languages = sorted(r["language"] for r in found[:most_classes])
    if len(found) > most_classes:
        rows = rows.where(F.col("language").isin(languages))
    n, df = document_frequencies(rows)
    idf = np.log((1 + n) / (1 + df)) + 1
    weights = np.zeros(((1 << BITS) + 1, max(len(languages), 1)))
    if not languages:
        return Model([], idf, weights, 1.0)
    held = F.pmod(F.xxhash64("doc_id", F.lit("calibration")), F.lit(4)) == 0
    index = F.create_map(*[x for k, v in enumerate(languages) for x in (F.lit(v), F.lit(k))])[F.col("language")]
    shared = spark.sparkContext.broadcast(idf)

    @F.arrow_udf("struct<features:array<int>,vals:array<float>>")
    def features(texts: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for t in texts:
            got = [tfidf(x, shared.value) for x in t.to_pylist()]
            yield pa.StructArray.from_arrays([pa.array([a.astype(np.int32) for a, _ in got], pa.list_(pa.int32())),
                                              pa.array([v.astype(np.float32) for _, v in got], pa.list_(pa.float32()))], ["features", "vals"])

    sample = (bounded(rows.where(~held), "doc_id", sample_rows, "language")
              .select(F.col("doc_id").alias("id"), features("body").alias("x"), index.alias("target")).select("id", "x.*", "target"))
    outputs = max(len(languages), 2)  # a second, never seen, class keeps the softmax defined for one language
    at, w = fit(stored(sample, "language-sample"), 1 << BITS, outputs, settings)
    weights = np.zeros(((1 << BITS) + 1, outputs))
    weights[at] = w
    model = Model(languages, idf, weights, 1.0)
    left = bounded(rows.where(held), "doc_id", calibration_rows, "temperature").select("body", index.alias("target"))
    return Model(languages, idf, weights, _temperature(left, model))


def _temperature(rows: DataFrame, model: Model) -> float:
    """The temperature under which held-back labels are likeliest."""
    shared = rows.sparkSession.sparkContext.broadcast(model)

    @F.arrow_udf("array<double>")
    def losses(texts: pa.Array, target: pa.Array) -> pa.Array:
        out = []
        for x, y in zip(texts.to_pylist(), target.to_pylist()):
            z = shared.value.logits(x)[:, None] / np.array(TEMPERATURES)[None, :]
            top = z.max(axis=0)
            out.append(top + np.log(np.exp(z - top).sum(axis=0)) - z[y])
        return pa.array(out, pa.list_(pa.float64()))

    per = rows.select(losses("body", "target").alias("l"))
    total = per.agg(*[F.sum(F.col("l")[k]).alias(f"t{k}") for k in range(len(TEMPERATURES))]).first()
    return 1.0 if total[0] is None else TEMPERATURES[int(np.argmin(list(total)))]


def predict(model: Broadcast, text: str | Column = "text") -> Column:
    """A column: struct of lang_pred and score (0 to 1).  ``und`` with score 0
    where the text is null or has no letter, or no language was learned."""
    @F.arrow_udf("struct<lang_pred:string,score:double>")
    def run(texts: Iterator[pa.Array]) -> Iterator[pa.Array]:
        m = model.value
        for t in texts:
            pred, score = [], []
            for x in t.to_pylist():
                if not m.languages or not any(map(str.isalpha, x.decode("utf-8", "replace"))):
                    pred.append(UNKNOWN)
                    score.append(0.0)
                    continue
                z = m.logits(x)[:len(m.languages)] / m.temperature
                p = np.exp(z - z.max())
                k = int(np.argmax(p))
                pred.append(m.languages[k])
                score.append(float(p[k] / p.sum()))
            yield pa.StructArray.from_arrays([pa.array(pred, pa.string()), pa.array(score, pa.float64())], ["lang_pred", "score"])

    return run(text_bytes(text))


def broadcast_model(spark: SparkSession, model: Model) -> Broadcast:
    return spark.sparkContext.broadcast(model)  # 2^BITS rows of at most MOST_CLASSES weights


def predict_table(docs: DataFrame) -> DataFrame:
    """(doc_id, held_out, lang_pred, score), a row for every row of ``docs``.
    A null id is not held out and not learned from."""
    model = broadcast_model(docs.sparkSession, train(docs))
    return (docs.select("doc_id", F.coalesce(crc_mod("doc_id", 3) == 1, F.lit(False)).alias("held_out"), predict(model).alias("r"))
            .select("doc_id", "held_out", "r.*"))


def drop_unidentified(docs: DataFrame, least: float = 0.5) -> DataFrame:
    """The documents whose language is recognised with a calibrated chance of
    ``least`` or more, all columns kept."""
    found = predict(broadcast_model(docs.sparkSession, train(docs)))
    return docs.where((found["lang_pred"] != UNKNOWN) & (found["score"] >= least))

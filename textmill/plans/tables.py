"""Mapping of the shared test tables onto the engine's data model.

``text <- documents.text``, ``label <- labels.toxic`` (left join: unlabelled
rows stay, with a null label), ``source_file <- documents.source``,
``source_name <- documents.lang``, ``record_id <- documents.doc_id``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations"]


TEXT_TABLES = {"documents", "pages", "conversations", "benchmark"}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    df = spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")
    return spread(df) if name in TEXT_TABLES else df


def spread(df: DataFrame) -> DataFrame:
    """Text cleaning is CPU-bound per row.  A scan with fewer splits than
    task slots (one small file, one row group) is spread round-robin over
    the slots; a large input already has many splits and is left alone."""
    try:
        slots = df.sparkSession.sparkContext.defaultParallelism
        parts = df.rdd.getNumPartitions()
    except Exception:  # no RDD access (e.g. a remote session): leave it to AQE
        return df
    return df.repartition(slots) if parts < slots else df


def master(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(text, label, source_file, source_name, record_id); label may be null.
    Both sides are large at scale, so the join is left to the planner
    (sort-merge, or broadcast when AQE measures a small side)."""
    d = table(spark, sf_dir, "documents").select("doc_id", "text", "source", "lang")
    lab = table(spark, sf_dir, "labels").select("doc_id", "toxic")
    j = d.join(lab, "doc_id", "left")
    return j.select(F.col("text"), F.col("toxic").cast("int").alias("label"), F.col("source").alias("source_file"),
                    F.col("lang").alias("source_name"), F.col("doc_id").alias("record_id"))


def labelled(spark: SparkSession, sf_dir: str) -> DataFrame:
    return master(spark, sf_dir).filter(F.col("label").isNotNull() & F.col("text").isNotNull())


def predictions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A scored table derived from ``embeddings``: truth = class >= 5,
    score = e1 + e2, predicted = score > 0, confidence = sigmoid(10 |score|)."""
    e = table(spark, sf_dir, "embeddings")
    s = F.element_at("embedding", 1).cast("double") + F.element_at("embedding", 2).cast("double")
    return e.select(F.col("vec_id").alias("doc_id"), (F.col("label") >= 5).cast("int").alias("true_label"),
                    s.alias("score"), (s > 0).cast("int").alias("pred_label"),
                    (F.lit(1.0) / (F.lit(1.0) + F.exp(-F.abs(s) * 10))).alias("confidence"))

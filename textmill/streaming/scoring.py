"""Live scoring as Structured Streaming.

Stateless: each micro-batch is cleaned and scored with the same fitted
``PipelineModel`` as the batch path; the parquet sink plus checkpoint make a
restarted query resume without duplicating output.
"""

from __future__ import annotations

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import features as FT
from ..functions import text as T
from ..operators import models as MD


def scored_view(model: PipelineModel, docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    clean = docs.filter(F.length(F.trim(F.col(text_col))) > 0) \
                .select(F.col(id_col), T.clean_aggressive(text_col).alias("text"))
    out = MD.score(model, clean)
    return out.select(id_col, "pred_label", FT.label_name("pred_label", "plain").alias("label_name"),
                      (F.col("confidence") * 100).alias("confidence_pct"), "prob_0", "prob_1")


def score_stream(spark: SparkSession, model: PipelineModel, source_dir: str, glob: str, out_dir: str,
                 id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Run the scorer over the files in ``source_dir`` matching ``glob`` as a
    stream (availableNow), write parquet to ``out_dir``, return it."""
    path = f"{source_dir.rstrip('/')}/{glob}"  # a file, a folder of part files, or a pattern of either
    stream = (spark.readStream.schema(spark.read.parquet(path).schema).option("maxBytesPerTrigger", 1 << 30)  # small files share a micro-batch
              .parquet(f"{path[:-1]}[{path[-1]}]" if path[-1].isalnum() else path))  # a pattern may name a file or a folder
    scored = scored_view(model, stream, id_col, text_col)
    q = (scored.writeStream.format("parquet").option("path", out_dir + "/data")
         .option("checkpointLocation", out_dir + "/_checkpoint").outputMode("append")
         .trigger(availableNow=True).start())
    q.awaitTermination()
    return spark.read.parquet(out_dir + "/data")

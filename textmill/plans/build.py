"""End-to-end dataset build (the aggregation script as one Spark job).

master -> drop unlabelled -> base cleaner -> >= 50 chars -> keep-first
dedup -> stratified 70/15/15 split -> Parquet partitioned by ``split``.

The deduplicated table is written once to the shared folder before the
split: the split reads it twice (counts and rows), and the written table
cuts the lineage so a lost executor does not re-run cleaning and dedup.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import text as T
from ..functions.barrier import materialize
from ..operators import dedup as DD
from ..operators import quality as QL
from ..operators import sampling as SM
from ..session import scratch_path
from ..sinks.writers import write_stage


def clean_stage(master: DataFrame, cleaner=T.clean_base, min_chars: int = 50) -> DataFrame:
    m = QL.drop_unlabelled(master)
    return QL.min_length(materialize(m, "text", cleaner("text")), n=min_chars)


def build_dataset(spark: SparkSession, master: DataFrame, out_path: str | None = None,
                  cleaner=T.clean_base) -> DataFrame:
    """Returns the split table (read back from Parquet)."""
    deduped = DD.dedup_keep_first(clean_stage(master, cleaner))
    stage = write_stage(deduped, scratch_path(spark, "build/deduped"))
    QL.require_rows(stage, "master dataset")
    split = SM.stratified_split(stage)
    out = out_path or scratch_path(spark, "build/splits")
    return write_stage(split, out, partition_by=["split"])


def evaluation_split(splits: DataFrame) -> DataFrame:
    """Test rows, or validation rows when the test split is empty."""
    test = splits.filter(F.col("split") == "test")
    return splits.filter(F.col("split") == "validation") if test.isEmpty() else test

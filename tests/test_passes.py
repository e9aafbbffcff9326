"""Texts are cleaned once and searched only for what they hold."""

import contextlib
import io
import os
import re

from pyspark.sql import functions as F

from textmill.functions import text as T
from textmill.functions.constants import WS_CLASS
from textmill.operators import models as MD
from textmill.operators import tfidf as TF
from textmill.plans import catalog as C
from textmill.plans import ml_queries as ML
from textmill.streaming import scoring as ST

SF = "/root/testdata/sf0.001"


def _plan(df) -> str:
    out = io.StringIO()
    with contextlib.redirect_stdout(out):
        df.explain()
    return out.getvalue()


def test_every_character_is_cleaned_as_by_the_plain_patterns(spark):
    rows = [(f"A{chr(k)}b {chr(k)}{chr(k)} x",) for k in range(0x3100)] + [(None,), ("",)]
    df = spark.createDataFrame(rows, "t string")
    plain = F.trim(F.regexp_replace("t", "[" + WS_CLASS + "]+", " "))
    words = F.filter(F.split("t", "[" + WS_CLASS + "]+"), lambda w: w != "")
    kept = F.trim(F.regexp_replace(F.regexp_replace("t", "[^a-z" + WS_CLASS + r"\[\]]", ""), "[" + WS_CLASS + "]+", " "))
    tokens = F.regexp_extract_all("t", F.lit(r"[\p{L}\p{N}_]{2,}"), 0)
    same = [T.collapse_ws("t").eqNullSafe(plain), T.whitespace_words("t").eqNullSafe(words),
            T._keep("t", "abcdefghijklmnopqrstuvwxyz").eqNullSafe(kept), T.word_tokens("t", lower=False).eqNullSafe(tokens)]
    for s in same:
        assert df.filter(~s).count() == 0


def test_patterns_are_tried_only_where_their_marks_stand(spark):
    plan = _plan(spark.range(1).select(F.col("id").cast("string").alias("t")).select(T.clean_aggressive("t")))
    for mark in "@&<='":
        assert re.search(rf"[Cc]ontains\([^()]*(\(\))?[^()]*, {re.escape(mark)}\)", plan), mark


def test_scalers_read_persisted_counts(spark):
    for q in (C.q_minmax_scale, C.q_standard_scale):
        assert "InMemoryTableScan" in _plan(q(spark, SF))


def test_bounded_vocabulary_is_broadcast(spark):
    docs = spark.createDataFrame([(1, "alpha beta alpha"), (1, "alpha"), (2, "beta gamma")], "record_id long, text string")
    t = TF.tfidf(docs, "text", "record_id", max_features=10)
    assert "BroadcastHashJoin" in _plan(t) and "SortMergeJoin" not in _plan(t)
    assert {(r["doc_id"], r["term"]): r["tf"] for r in t.collect()}[1, "alpha"] == 3


def test_scoring_model_learns_from_cached_rows(spark, tmp_path):
    model, rows = ML._batch_model(spark, SF)
    assert rows.is_cached
    rows.unpersist()
    assert "array_contains" not in MD.terms_sql("text") and len(model.stages) == 2
    docs = spark.createDataFrame([(i, f"pay the bill {i} now") for i in range(40)], "doc_id long, text string")
    docs.repartition(4).write.parquet(f"{tmp_path}/in/docs.parquet")
    got = ST.score_stream(spark, model, f"{tmp_path}/in", "docs.parquet", f"{tmp_path}/out")
    assert got.select("doc_id").distinct().count() == 40
    assert [f for f in os.listdir(f"{tmp_path}/out/_checkpoint/commits") if f.isdigit()] == ["0"]  # one micro-batch for all files


def test_rows_read_a_few_times_stay_out_of_the_heap(spark):
    _, rows = ML._batch_model(spark, SF)
    level = rows.storageLevel
    rows.unpersist()
    assert level.useDisk and not level.useMemory

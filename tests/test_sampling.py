"""Invariants of the deterministic split / sampling operators."""

import hashlib

import pytest
from pyspark.sql import functions as F

from textmill.operators import dedup as DD
from textmill.operators import ranking as RK
from textmill.operators import sampling as SM


def _frame(spark, n=1000, pos_every=7):
    rows = [(i, 1 if i % pos_every == 0 else 0, f"text {i % 300}") for i in range(n)]
    return spark.createDataFrame(rows, "record_id long, label int, text string")


def test_split_sizes_and_strata(spark):
    df = _frame(spark)
    s = SM.stratified_split(df).cache()
    assert s.count() == 1000
    sizes = {r.split: r.n for r in s.groupBy("split").agg(F.count(F.lit(1)).alias("n")).collect()}
    assert sizes["test"] + sizes["validation"] == 300 and sizes["test"] == 150
    per = {(r.split, r.label): r.n for r in s.groupBy("split", "label").agg(F.count(F.lit(1)).alias("n")).collect()}
    n_pos = sum(v for (sp, lab), v in per.items() if lab == 1)
    for sp, frac in [("train", 0.7), ("test", 0.15)]:
        assert abs(per[(sp, 1)] - frac * n_pos) <= 1.5
    assert s.select("record_id").distinct().count() == 1000


def test_bucketed_rank_equals_global_rank(spark):
    df = _frame(spark, 3000)
    a = RK.hash_rank(df, "record_id", ["label"], hex_digits=2)
    w = F.row_number().over(__import__("pyspark.sql", fromlist=["Window"]).Window.partitionBy("label")
                            .orderBy(RK.hash_order("record_id"), "record_id"))
    b = df.withColumn("rank2", w)
    j = a.join(b.select("record_id", "rank2"), "record_id")
    assert j.filter(F.col("rank") != F.col("rank2")).count() == 0


def test_folds_balanced(spark):
    f = SM.stratified_folds(_frame(spark)).groupBy("fold", "label").count().collect()
    by_label = {}
    for r in f:
        by_label.setdefault(r.label, []).append(r["count"])
    assert all(max(v) - min(v) <= 1 for v in by_label.values())


def test_learning_subsets_nested(spark):
    s = SM.learning_subsets(_frame(spark, 200)).groupBy("subset").count().collect()
    counts = dict((r.subset, r["count"]) for r in s)
    cum = 0
    for i, frac in enumerate([0.1, 0.325, 0.55, 0.775, 1.0]):
        cum += counts.get(i, 0)
        assert cum == int(frac * 200)


def test_dedup_idempotent_and_first(spark):
    rows = [("a", 1, "f2", "x", 0), ("a", 0, "f1", "x", 5), ("b", 1, "f1", "x", 1), ("b", 1, "f1", "x", 0)]
    df = spark.createDataFrame(rows, "text string, label int, source_file string, source_name string, record_id long")
    d = DD.dedup_keep_first(df)
    got = {r.text: (r.source_file, r.record_id, r.label) for r in d.collect()}
    assert got == {"a": ("f1", 5, 0), "b": ("f1", 0, 1)}
    assert DD.dedup_keep_first(d).count() == d.count()


def test_balanced_resample(spark):
    r = SM.balanced_resample(_frame(spark, 700)).cache()
    assert r.count() == 700
    by = {x.label: x["count"] for x in r.groupBy("label").count().collect()}
    assert by == {0: 350, 1: 350}


def test_leakage(spark):
    rows = [("t1", "train"), ("t1", "test"), ("t2", "validation"), ("t2", "test"), ("t3", "train")]
    df = spark.createDataFrame(rows, "text string, split string")
    got = {(r.split_a, r.split_b): r.n_shared for r in DD.split_leakage(df).collect()}
    assert got == {("train", "validation"): 0, ("train", "test"): 1, ("validation", "test"): 1}


@pytest.mark.parametrize("label", [lambda i: 0, lambda i: None if i % 5 == 0 else i % 3])
@pytest.mark.parametrize("n", [0, 997])
def test_selections_equal_full_ranks(spark, n, label):
    """Quotas by marks against ranks over whole labels in plain Python."""
    rows = [(i, label(i), f"text {i}") for i in range(n)]
    df = spark.createDataFrame(rows, "record_id long, label int, text string")
    by = {}
    for i, lab, _ in sorted(rows, key=lambda r: hashlib.md5(f"42:{r[0]}".encode()).hexdigest()):
        by.setdefault(lab, []).append(i)
    by_all = sorted(range(n), key=lambda i: hashlib.md5(f"42:{i}".encode()).hexdigest())
    quotas = {r.label: r for r in SM.split_quotas(SM.label_counts(df.na.drop(subset=["label"]), "label"), "label").collect()}
    sdf = df.na.drop(subset=["label"])
    got = {r.record_id: r.split for r in SM.stratified_split(sdf).collect()}
    want = {i: "test" if k < quotas[lab].test_quota else "validation" if k < quotas[lab].hold_quota else "train"
            for lab, ids in by.items() if lab is not None for k, i in enumerate(ids)}
    assert got == want
    subset = {r.record_id: r.subset for r in SM.learning_subsets(df).collect()}
    bounds = [int(f * n) for f in (0.1, 0.325, 0.55, 0.775, 1.0)]
    assert subset == {i: next(j for j, b in enumerate(bounds) if k < b) for k, i in enumerate(by_all)}
    for size in (7, 2000):
        ids = [r.record_id for r in SM.stratified_sample(sdf, size).collect()]
        assert len(ids) == len(set(ids)) == min(size, len(want))
        for lab, order in by.items():
            mine = set(ids) & set(order)
            assert mine == set(order[:len(mine)])
    other = spark.createDataFrame([(-1, 1, "x")], "record_id long, label int, text string")
    for target in (0, 6):
        taken = {r.record_id for r in SM.sample_and_combine(df, other, "record_id", target).where("origin = 'd1'").collect()}
        assert taken == set(by_all[:max(target - 1, 0)])


def test_selection_moves_no_text(spark):
    """No exchange carries the text, and none of its keys is one."""
    df = _frame(spark, 100)
    for out in (SM.stratified_split(df), SM.stratified_sample(df, 10), SM.learning_subsets(df)):
        plan = out._jdf.queryExecution().optimizedPlan().toString()
        assert "Window" in plan
        for part in plan.split("Window ")[1:]:
            assert "text#" not in part.split("\n")[0]
        physical = out._jdf.queryExecution().sparkPlan().toString()
        assert "SortMergeJoin" not in physical.split("\n")[1]
    plan = DD.dedup_keep_first(df, order=("record_id",))._jdf.queryExecution().executedPlan().toString()
    assert all("text" not in line for line in plan.split("\n") if "hashpartitioning" in line)


def test_repeated_ids_stay_together(spark):
    df = spark.createDataFrame([(i // 4, 0, str(i)) for i in range(400)], "record_id long, label int, text string")
    s = SM.stratified_split(df).groupBy("record_id").agg(F.count_distinct("split").alias("n"), F.count("*").alias("m"))
    assert {(r.n, r.m) for r in s.collect()} == {(1, 4)}


def test_shared_texts(spark):
    a = spark.createDataFrame([("x",), ("x",), ("y",), (None,), ("",)], "text string")
    b = spark.createDataFrame([("x",), ("",), (None,), (None,), ("z",)], "text string")
    assert sorted(str(r.text) for r in DD.shared_texts(a, b).collect()) == ["", "None", "x"]
    assert sorted(str(r.text) for r in DD.shared_texts(a, b.na.drop()).collect()) == ["", "x"]

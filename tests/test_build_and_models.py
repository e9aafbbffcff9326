"""End-to-end build, Spark ML models, persistence and streaming = batch."""

import tempfile

from pyspark.sql import functions as F

from textmill.functions import text as T
from textmill.operators import models as MD
from textmill.plans import build as B
from textmill.plans.tables import labelled, master
from textmill.streaming import scoring as ST

SF = "/root/testdata/sf0.001"


def test_build_dataset(spark):
    out = tempfile.mkdtemp(prefix="tm-build-") + "/splits"
    s = B.build_dataset(spark, master(spark, SF), out)
    n = s.count()
    assert n > 0
    assert s.select("text").distinct().count() == n          # deduplicated
    assert s.filter(F.length("text") < 50).count() == 0      # min length
    sizes = {r.split: r["count"] for r in s.groupBy("split").count().collect()}
    assert sizes.get("test", 0) == -(-((n * 30 + 99) // 100) // 2)
    assert B.evaluation_split(s).count() == sizes.get("test", 0) or sizes.get("test", 0) == 0


def _ml_frames(spark):
    lab = labelled(spark, SF).select("record_id", "label", T.clean_aggressive("text").alias("text"))
    return lab


def test_models_fit_score_persist(spark):
    df = _ml_frames(spark).cache()
    for kind in ("logistic_regression", "linear_svc", "naive_bayes", "sgd_hinge"):
        model, wm, scored = MD.train_and_evaluate(kind, df, df, max_features=500)
        share = df.agg(F.avg("label")).first()[0]
        assert wm["accuracy"] >= max(share, 1 - share)  # on its own rows at least the larger class
        r = scored.select(F.min("confidence"), F.max("confidence")).first()
        assert 0.5 <= r[0] <= r[1] <= 1.0
        assert MD.parameter_count(model) > 0
    d = tempfile.mkdtemp(prefix="tm-model-") + "/m"
    from textmill.sinks.writers import load_model, save_model
    save_model(model, d)
    again = MD.score(load_model(d), df)
    a = sorted((r.record_id, r.pred_label) for r in MD.score(model, df).select("record_id", "pred_label").collect())
    b = sorted((r.record_id, r.pred_label) for r in again.select("record_id", "pred_label").collect())
    assert a == b


def test_published_grids():
    assert {k: len(MD.default_grid(k)) for k in MD.KINDS} == {
        "logistic_regression": 16, "linear_svc": 16, "sgd_hinge": 24, "naive_bayes": 12}


def _word_rows(spark, n=120):
    """Spam says offer, ham says meeting, beside words that both have."""
    rows = [(i, i % 2, f"please read number{i} {'offer prize' if i % 2 else 'meeting agenda'} today") for i in range(n)]
    return spark.createDataFrame(rows, "record_id long, label int, text string")


def test_term_stats_equal_counts_by_document(spark):
    from textmill.operators import tfidf as TF
    terms = spark.createDataFrame([(1, ["b", "a", "b"]), (2, ["b"]), (3, []), (4, None)], "doc_id int, terms array<string>")
    assert sorted(map(tuple, TF.term_stats(terms).collect())) == [("a", 1, 1), ("b", 2, 3)]


def test_tuning_beats_the_majority_class(spark):
    from textmill.operators import sampling as SM
    train = SM.stratified_folds(_word_rows(spark), k=2).cache()
    test = _word_rows(spark, 20)
    grids = {"logistic_regression": [{"C": 1.0, "max_features": 50, "ngram_max": 1, "balanced": b} for b in (False, True)],
             "naive_bayes": [{"nb_alpha": a, "max_features": 50, "ngram_max": 1} for a in (0.5, 1.0)]}
    got = MD.tune_all(train, test, tuple(grids), grids=grids)
    assert [r["model_name"] for r in got] == list(grids) and sum(r["is_best"] for r in got) == 1
    assert all(r["accuracy"] > 0.9 and r["cv_score"] > 0.9 and r["best_params"] in grids[r["model_name"]] for r in got)


def test_learning_curve(spark):
    from textmill.operators import sampling as SM
    train = SM.stratified_folds(_word_rows(spark), k=2).cache()
    got = MD.learning_curve(["naive_bayes"], train, fractions=(0.5, 1.0), max_features=50, ngram_max=1)
    assert [r[1] for r in got] == [0.5, 1.0] and got[-1][2] == 60 and got[-1][4] > 0.9


def test_any_estimator_fits_the_slot(spark):
    from pyspark.ml.classification import DecisionTreeClassifier
    df = _word_rows(spark)
    model = MD.fit_model(DecisionTreeClassifier(maxDepth=3, maxBins=8), df, max_features=20, ngram_max=1)
    assert MD.score(model, df).filter("pred_label != label").count() == 0


def test_stream_equals_batch(spark):
    df = _ml_frames(spark)
    model = MD.fit_model("logistic_regression", df, max_features=300)
    out = tempfile.mkdtemp(prefix="tm-stream-")
    stream = ST.score_stream(spark, model, SF, "documents.parquet", out)
    batch = ST.scored_view(model, spark.read.parquet(f"{SF}/documents.parquet"))
    key = ["doc_id", "pred_label", "label_name"]
    s = sorted(tuple(r) for r in stream.select(*key).collect())
    b = sorted(tuple(r) for r in batch.select(*key).collect())
    assert s == b and len(s) > 0


def test_entry_smoke(spark):
    import __spark_entry__ as E
    df = E.entry(spark)
    assert df.count() >= 1
    assert set(df.columns) == {"label", "n_rows", "share_pct"}
    assert set(E.oracle_sql()) <= set(E.queries())

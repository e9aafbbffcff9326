"""Accuracies by marks against featurizers and models fitted split by split."""

import random

import pytest
from pyspark.sql import functions as F

from textmill.operators import linear as LN
from textmill.operators import models as MD
from textmill.operators import sampling as SM
from textmill.operators import tfidf as TF

WORDS = {0: "meeting agenda notes report team lunch".split(), 1: "offer prize money winner click bank".split()}


def _rows(spark, n=150):
    """Words of the own label and, at times, of the other; some empty texts."""
    r = random.Random(7)
    rows = []
    for i in range(n):
        words = [r.choice(WORDS[i % 3 % 2 if r.random() < 0.75 else r.randrange(2)]) for _ in range(r.randrange(0, 9))]
        rows.append((i // 2 if i < 6 else i, i % 3 % 2, " ".join(words) + "!" * r.randrange(3)))  # some ids twice
    return spark.createDataFrame(rows, "record_id long, label int, text string")


@pytest.fixture
def folds(spark):
    df = SM.stratified_folds(_rows(spark), k=3).cache()
    yield df
    df.unpersist()


CELLS = [("naive_bayes", {"nb_alpha": 0.5, "max_features": 8, "ngram_max": 1}), ("naive_bayes", {"nb_alpha": 1.0, "max_features": 20}),
         ("naive_bayes", {"nb_alpha": 0.1, "max_features": 20}), ("logistic_regression", {"C": 1.0, "balanced": True, "max_features": 20}),
         ("linear_svc", {"C": 0.1, "max_features": 20})]


def test_cells_equal_models_fitted_fold_by_fold(spark, folds, monkeypatch):
    got = MD.cross_validate_cells(CELLS, folds)
    monkeypatch.setattr(MD, "_by_marks", lambda *a: False)
    want = MD.cross_validate_cells(CELLS, folds)
    assert all(g[0] > 0.5 for g in got)
    for g, w in zip(got, want):
        assert g == pytest.approx(w, abs=1e-9)


def test_learning_curve_equals_models_fitted_subset_by_subset(spark, folds, monkeypatch):
    kw = {"fractions": (0.02, 0.4, 1.0), "max_features": 20}
    got = MD.learning_curve(["naive_bayes"], folds, **kw)
    monkeypatch.setattr(MD, "_by_marks", lambda *a: False)
    assert got == [(w[0], w[1], *(x if x is None else pytest.approx(x, abs=1e-9) for x in w[2:]))
                   for w in MD.learning_curve(["naive_bayes"], folds, **kw)]


def test_texts_are_tokenised_once_for_all_folds(spark, folds, monkeypatch):
    seen = []
    plain = TF.term_stats
    monkeypatch.setattr(TF, "term_stats", lambda *a, **k: seen.append(a) or plain(*a, **k))
    MD.search(["naive_bayes"], folds, grids={"naive_bayes": [p for _, p in CELLS[:3]]})
    assert len(seen) == 1  # before: one for every fold and vocabulary setting


def test_blocks_are_read_once_for_all_splits(folds, monkeypatch):
    seen = []
    plain = LN._folded
    monkeypatch.setattr(LN, "_folded", lambda *a: seen.append(a) or plain(*a))
    MD.cross_validate_cells([("naive_bayes", {"max_features": 20})], folds)
    assert len(seen) == 2  # class sums and accuracies; before: both for every fold


def test_groups_that_may_not_meet_on_the_driver_share_no_job(monkeypatch):
    monkeypatch.setattr(LN, "AT_ONCE", 8 * 10 * 4)  # ten numbers of four tasks
    assert LN.in_jobs({0: 5, 1: 5, 2: 5}, 4) == [[0, 1], [2]]
    assert LN.in_jobs({0: 5, 1: 11}, 4) == [[0, 1]]  # the tasks fold them


def test_empty_table_and_one_label(spark, folds):
    assert MD.cross_validate_cells(CELLS[:1], folds.limit(0)) == [(None, None)]
    assert MD.cross_validate_cells(CELLS[:1], folds.where(F.col("label") == 1)) == [(None, None)]

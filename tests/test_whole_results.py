"""Queries over small tables with rows that are easily lost."""

import json

import pytest
from pyspark.sql import functions as F

from textmill.operators import models as MD
from textmill.plans import catalog as C
from textmill.plans import ml_queries as ML

SF001 = "/root/testdata/sf0.001"
DOCUMENTS = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture
def write(spark, tmp_path):
    """write(rows of (text, lang, toxic)): the folder with the two tables."""
    def run(rows):
        docs = [(k, text, lang, "s", len(text)) for k, (text, lang, _) in enumerate(rows)]
        spark.createDataFrame(docs, DOCUMENTS).write.parquet(f"{tmp_path}/documents.parquet")
        labels = [(k, 1, toxic) for k, (_, _, toxic) in enumerate(rows) if toxic is not None]
        spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
        return str(tmp_path)
    return run


def test_null_language_is_combined(spark, write):
    d = write([("a", "en", 0), ("b", "de", 1), ("c", None, 1), ("d", None, 0), ("e", None, None), ("f", "fr", 0)])
    got = {r["record_id"]: (r["label"], r["origin"]) for r in C.q_sample_and_combine(spark, d).collect()}
    assert got == {0: (0, "d1"), 1: (1, "d2"), 2: (1, "d2"), 3: (0, "d2"), 5: (0, "d2")}


def test_token_free_documents_get_the_prior_class(spark, write):
    words = ["meeting agenda notes", "prize money winner"]
    rows = [("!!! ???" if k % 2 else words[k % 3 == 0], "en", int(k % 3 == 0)) for k in range(60)]
    d = write(rows)
    test = {r["record_id"]: r["label"] for r in C.split_table(spark, d).where("split = 'test'").collect()}
    got = {r["doc_id"]: r for r in C.q_naive_bayes(spark, d).collect()}
    assert set(got) == set(test) and any(k % 2 for k in test)
    for k, r in got.items():
        assert r["true_label"] == test[k]
        assert r["pred_label"] == (0 if k % 2 else test[k])


def test_tfidf_keeps_the_whole_vocabulary(spark):
    t = C.q_tfidf(spark, SF001)  # 44,114 terms
    assert t.agg(F.count_distinct("term"), F.max("term_index")).first() == (40_000, 39_999)
    norms = t.groupBy("doc_id").agg(F.sum(F.col("tfidf") ** 2).alias("s")).agg(F.min("s"), F.max("s")).first()
    assert abs(norms[0] - 1) < 1e-3 and abs(norms[1] - 1) < 1e-3
    top = C.q_top_doc_terms(spark, SF001)
    assert top.join(t.where("term_index >= 20000"), ["doc_id", "term"]).count() > 0


def test_grid_search_takes_every_published_cell_and_refits_the_best(spark, write, monkeypatch):
    d = write([(f"please read number {k} {'offer prize' if k % 2 else 'meeting agenda'} today", "en", k % 2) for k in range(60)])
    monkeypatch.setattr(MD, "cross_validate_cells", lambda cells, *a: [(0.9 if k % 12 == 5 else 0.5, 0.0) for k in range(len(cells))])
    got = ML.q_grid_search(spark, d).collect()
    for kind in MD.KINDS:
        mine = [r for r in got if r["model_name"] == kind]
        assert [json.loads(r["params"]) for r in mine] == MD.default_grid(kind)  # before: linear models at one vocabulary setting
        best = [r for r in mine if r["is_best"]]
        assert len(best) == 1 and best[0]["cv_accuracy"] == 0.9 and best[0]["refit_accuracy"] == 1.0
        assert all(r["refit_accuracy"] is None for r in mine if not r["is_best"])

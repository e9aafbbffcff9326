import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F
from textmill.llm import ftrl, lang_id, toxicity
from textmill.llm import queries as Q
from util import awkward, crc, frame, rng, sentence

BAD = ["vile", "rotten", "filthy"]


def test_ftrl_finds_the_sparse_truth():
    r = np.random.default_rng(0)
    m = ftrl.Ftrl(51, 1, ftrl.Settings(alpha=1, l1=1, l2=0))
    for _ in range(3000):
        at = r.choice(50, 8, replace=False)
        m.learn(np.append(at, 50), np.ones(9), np.array([float(3 in at)]))
    w = m.weights(slice(None))[:, 0]
    assert w[3] > 3 and np.abs(np.delete(w, [3, 50])).max() < 1


def toxic_texts(r, n):
    texts, y = [], []
    for k in range(n):
        w = sentence(r, r.randint(1, 400) if k % 50 else 8000).split()
        bad = k % 4 == 0
        for b in BAD if bad else ():
            w.insert(r.randrange(len(w) + 1), b.upper() + "!")
        texts.append(" ".join(w))
        y.append(int(bad))
    return texts, y


def test_toxicity(spark):
    r = rng(4)
    texts, y = toxic_texts(r, 900)
    odd = awkward(r)
    df = frame(spark, texts + odd)
    labels = spark.createDataFrame([(k, 0, v) for k, v in enumerate(y)] + [(3, 0, y[3]), (None, 1, 1), (5000, 1, 1), (len(texts), 0, 0), (7, 1, None)],
                                   "doc_id long, score int, toxic int")
    got = {x["doc_id"]: x for x in toxicity.score_table(df, labels).collect()}
    assert len(got) == len(texts) + len(odd)
    for k, v in enumerate(y):
        assert got[k]["held_out"] == (crc(k, 3) == 1) and 0 <= got[k]["score"] <= 1
    held = [k for k in range(len(y)) if got[k]["held_out"]]
    assert np.mean([got[k]["predicted"] == y[k] for k in held]) > 0.98
    assert all(got[k]["predicted"] == 0 for k in range(len(texts), len(got)))
    kept = toxicity.drop_toxic(df, labels)
    assert kept.columns == df.columns and kept.count() == sum(x["predicted"] == 0 for x in got.values())


def test_models_without_training_rows(spark):
    labels = spark.createDataFrame([], "doc_id long, toxic int")
    assert {x["score"] for x in toxicity.score_table(frame(spark, ["a", None, ""]), labels).collect()} == {0.5}
    none = frame(spark, ["a b", None, "9"]).withColumn("lang", F.lit(None).cast("string"))
    assert {(x["lang_pred"], x["score"]) for x in lang_id.predict_table(none).collect()} == {("und", 0.0)}
    assert lang_id.predict_table(frame(spark, [])).collect() == []
    assert toxicity.score_table(frame(spark, []), labels).collect() == []


LANGS = {"aa": "the of and house water".split(), "bb": "der und haus wässer straße".split(), "cc": "les où maison été ça".split()}


def test_language(spark):
    r = rng(8)
    rows = []
    for k in range(400):
        lang = sorted(LANGS)[k % 3]
        rows.append((k, sentence(r, r.randint(3, 60), LANGS[lang]), lang if k % 11 else None, "clash"))
    rows += [(900, None, "aa", "x"), (901, "12 34 !?", "bb", "x"), (902, "", None, "x"), (903, "ß", None, "x"), (None, "the of and", "aa", "x")]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, lang_pred string")
    got = {x["doc_id"]: x for x in lang_id.predict_table(df).collect()}
    assert len(got) == len(rows)
    assert all(got[k]["lang_pred"] == "und" for k in (900, 901, 902)) and got[903]["lang_pred"] in LANGS and not got[None]["held_out"]
    right = [got[k]["lang_pred"] == sorted(LANGS)[k % 3] for k in range(400) if got[k]["held_out"]]
    assert len(right) > 80 and np.mean(right) > 0.97
    assert all(0 <= x["score"] <= 1 for x in got.values())
    kept = lang_id.drop_unidentified(df)
    assert kept.columns == df.columns and not {900, 901, 902} & {x["doc_id"] for x in kept.collect()}


def test_counts_are_of_all_ngrams():
    at, n = lang_id.counts("Aé".encode() * 1000)
    assert n.sum() == 2000 + 1999 + 1998
    assert lang_id.counts(b"")[0].size == 0 and lang_id.counts(b"x")[1].sum() == 1


@pytest.mark.parametrize("sf", ["/root/testdata/sf0.01"])
def test_language_query_held_out_accuracy(spark, sf):
    docs = {x["doc_id"]: x for x in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    got = Q.op6_language(spark, sf).collect()
    assert len(got) == len(docs)
    held = [x for x in got if zlib.crc32(str(x["doc_id"]).encode()) % 3 == 1 and docs[x["doc_id"]]["lang"]]
    assert all(x["held_out"] for x in held)
    assert np.mean([x["lang_pred"] == docs[x["doc_id"]]["lang"] for x in held]) > 0.95


def test_languages_beyond_the_bound(spark):
    """The languages with the most rows are learned, ties by name; every row gets a result."""
    r = rng()
    own = {"aa": "lorem ipsum dolor", "bb": "zwei drei vier", "cc": "uno dos tres", "dd": "yksi kaksi kolme"}
    texts = [(lang, sentence(r, 12, own[lang].split())) for lang, n in (("aa", 5), ("bb", 60), ("cc", 60), ("dd", 5)) for _ in range(n)]
    docs = spark.createDataFrame([(k, t, lang) for k, (lang, t) in enumerate(texts)], "doc_id long, text string, lang string")
    model = lang_id.train(docs, most_classes=3)
    counted = docs.where("crc32(cast(doc_id as string)) % 3 != 1").groupBy("lang").count().collect()
    assert model.languages == sorted(x["lang"] for x in sorted(counted, key=lambda x: (-x["count"], x["lang"]))[:3])
    shared = lang_id.broadcast_model(spark, model)
    got = docs.select("lang", lang_id.predict(shared).alias("r")).collect()
    assert len(got) == len(texts) and all(x["r"]["lang_pred"] in model.languages for x in got)
    assert all(x["r"]["lang_pred"] == x["lang"] for x in got if x["lang"] in ("bb", "cc"))

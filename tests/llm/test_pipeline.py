import public_tokenizers
from textmill.llm import simhash
from textmill.llm.common import read
from pyspark.sql import Row
from tokenizers import Tokenizer

import corpus_pipeline as P
from test_decontam import tokens
from util import awkward, frame, rng, rows, sentence

D = "/root/testdata/sf0.01"


def test_stages_take_effect_and_match_brute_force(spark):
    docs = read(spark, D, "documents")
    columns = docs.columns
    texts = {x["doc_id"]: x["text"] for x in docs.collect()}
    kept = []
    for name, stage in P.STAGES[:-1]:
        out = stage(spark, docs, D)
        assert out.columns == columns, name
        out.write.parquet(path := f"{spark.sparkContext.getCheckpointDir()}/test-{name}")
        kept.append(({x["doc_id"] for x in docs.select("doc_id").collect()}, docs))
        docs = spark.read.parquet(path)
    left = {x["doc_id"] for x in docs.select("doc_id").collect()}
    # near duplicates: one document of each group of its input
    before, frame = kept[2]
    groups = {x["doc_id"]: x["component_id"] for x in simhash.simhash_components(frame).collect()}
    assert {d for d in before if groups[d] == d} == kept[3][0]
    items = [(b["item_id"], b["text"]) for b in read(spark, D, "benchmark").collect()]
    assert left == {d for d in kept[3][0] if brute_hit(texts[d], items)}
    tok = Tokenizer.from_file(public_tokenizers.path(P.TOKENIZER))
    rows = P.STAGES[-1][1](spark, docs, D).collect()
    assert {x["doc_id"] for x in rows} == left and all(x["round_trip"] for x in rows)
    for x in rows[:100]:
        assert x["ids"] == tok.encode(texts[x["doc_id"]], add_special_tokens=False).ids
    assert len(left) > 0.7 * len(texts)


def brute_hit(text, items):
    """True if no window of an item occurs (sets of windows, not positions)."""
    w = tokens(text)
    for _, body in items:
        iw = tokens(body)
        m = min(10, len(iw))
        if m and {tuple(iw[k:k + m]) for k in range(len(iw) - m + 1)} & {tuple(w[k:k + m]) for k in range(len(w) - m + 1)}:
            return False
    return True


def tables(spark, path, docs, labels=(), benchmark=()):
    """A folder with the three tables that the pipeline reads."""
    docs.write.parquet(f"{path}/documents.parquet")
    spark.createDataFrame(list(labels), "doc_id long, quality int, toxic int").write.parquet(f"{path}/labels.parquet")
    spark.createDataFrame(list(benchmark), "item_id long, text string").write.parquet(f"{path}/benchmark.parquet")
    return str(path)


def test_awkward_rows_go_through_every_stage(spark, tmp_path):
    """Null ids and texts, empty and very long texts, repeated rows, near
    copies, a benchmark item and extra columns named like the stages' own."""
    texts = awkward(rng())
    leak = sentence(rng(9), 12)
    texts += [f"before {leak} after", sentence(rng(8), 40)]
    rows_ = rows(texts)
    more = [rows_[-1], rows([sentence(rng(7), 30)])[0].asDict() | {"doc_id": None, "lang": None, "source": None}]
    d = tables(spark, tmp_path, frame(spark, texts, more=[more[0], Row(**more[1])]),
               [(1, None, None), (None, 1, 1), (3, 1, 0), (3, 1, 0)], [(0, leak), (None, None), (2, "")])
    docs = read(spark, d, "documents")
    seen = {}
    for name, stage in P.STAGES[:-1]:
        out = stage(spark, docs, d)
        assert out.columns == docs.columns, name
        out.write.parquet(path := f"{tmp_path}/after-{name}")
        docs = spark.read.parquet(path)
        seen[name] = docs.collect()
    everything = read(spark, d, "documents").collect()
    assert sorted(map(str, seen["toxicity"])) == sorted(map(str, everything))  # no toxic label, none rejected
    lettered = [r for r in everything if r["text"] and any(map(str.isalpha, r["text"]))]
    assert sorted(map(str, seen["language"])) == sorted(map(str, lettered))
    left = [r["doc_id"] for r in seen["near_duplicates"]]
    linked = simhash.simhash_components(spark.read.parquet(f"{tmp_path}/after-language"))
    groups = {r["doc_id"]: r["component_id"] for r in linked.collect()}
    assert {x for x in left if x is not None} == {x for x, c in groups.items() if x is not None and x == c}
    gone = {r["doc_id"] for r in seen["near_duplicates"]} - {r["doc_id"] for r in seen["decontamination"]}
    assert gone == {r["doc_id"] for r in seen["near_duplicates"] if not brute_hit(r["text"], [(0, leak)])} != set()
    tok = Tokenizer.from_file(public_tokenizers.path(P.TOKENIZER))
    by_id = {r["doc_id"]: r["text"] for r in seen["decontamination"]}
    final = P.run(spark, d).collect()
    assert sorted(str(r["doc_id"]) for r in final) == sorted(str(r["doc_id"]) for r in seen["decontamination"])
    for r in final:
        assert r["round_trip"] and r["ids"] == tok.encode(by_id[r["doc_id"]], add_special_tokens=False).ids


def test_empty_tables(spark, tmp_path):
    d = tables(spark, tmp_path, frame(spark, ["x"]).limit(0))
    assert P.run(spark, d).collect() == []


def test_only_rows_that_go(spark, tmp_path):
    """Nothing is left after the language stage; the later ones take none."""
    d = tables(spark, tmp_path, frame(spark, [None, "", "123 456", "123 456"]), [(k, 1, 0) for k in range(4)], [(0, "123 456")])
    assert P.run(spark, d).collect() == []

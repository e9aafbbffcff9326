import hashlib
import re

import pytest
from textmill.llm import decontam as D
from textmill.llm import queries as Q
from util import awkward, frame, rng, sentence

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def tokens(t):
    return WORD.findall("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t or ""))


def brute(text, items, width=10):
    w = tokens(text)
    mark, got = [0] * len(w), set()
    for item, body in items:
        iw = tokens(body)
        if not iw:
            continue
        m = min(width, len(iw))
        for p in {tuple(iw[k:k + m]) for k in range(len(iw) - m + 1)}:
            for s in range(len(w) - m + 1):
                if tuple(w[s:s + m]) == p:
                    mark[s:s + m] = [1] * m
                    if item is not None:
                        got.add(str(item))
    return len(w), sum(mark), sorted(got)


@pytest.mark.parametrize("per_block", [3, 100_000])
def test_occurrences_match_brute_force(spark, per_block):
    r = rng(3)
    items = [(1, sentence(r, 25)), (2, "one"), (3, "Two-words."), (10, "alpha beta alpha"), (11, None), (12, "..."), (None, "it x1 it x1"),
             (1, sentence(r, 12)), (13, "the the the the the the the the the the the"), (14, "Zürich ÉLAN naïve")]
    texts = [t if t is None or len(t) < 9000 else t[:3000] for t in awkward(r)]
    texts += [sentence(r, 9) + ", " + items[0][1].upper() + " " + items[0][1], "a! TWO words,two WORDS", "the " * 30, items[7][1], "9 9 alpha"]
    bench = spark.createDataFrame([(i, t, "x") for i, t in items], "item_id long, text string, n_words string")
    got = {x["doc_id"]: x for x in D.contamination(frame(spark, texts), bench, patterns_per_block=per_block).collect()}
    assert len(got) == len(texts)
    for k, t in enumerate(texts):
        n, hit, its = brute(t, items)
        assert (got[k]["n_words"], got[k]["n_hit"], got[k]["items"], got[k]["contaminated"]) == (n, hit, its, hit > 0), t


def test_empty_tables_and_filter(spark):
    bench = spark.createDataFrame([], "item_id long, text string")
    df = frame(spark, ["a b", None])
    assert [x["n_hit"] for x in D.contamination(df, bench).collect()] == [0, 0]
    assert D.contamination(frame(spark, []), bench).collect() == []
    long = "w1 w2 w3 w4 w5 w6 w7 w8 w9 w10 w11"
    bench = spark.createDataFrame([(1, long)], "item_id long, text string")
    out = D.drop_contaminated(frame(spark, ["x " + long, "clean w1 w2", None, ""]), bench)
    assert sorted(x["doc_id"] for x in out.collect()) == [1, 2, 3] and out.columns == df.columns


def test_query(spark):
    d = "/root/testdata/sf0.001"
    docs, bench = (spark.read.parquet(f"{d}/{t}.parquet").collect() for t in ("documents", "benchmark"))
    items = [(b["item_id"], b["text"]) for b in bench]
    got = {x["doc_id"]: x for x in Q.op10_decontamination(spark, d).collect()}
    found = 0
    for x in docs:
        n, hit, its = brute(x["text"], items)
        found += hit > 0
        g = got[x["doc_id"]]
        assert (g["n_words"], g["n_hit"], g["n_items"], g["contaminated"]) == (n, hit, len(its), hit > 0)
        assert g["items_sha256"] == hashlib.sha256(",".join(its).encode()).hexdigest()
    assert len(got) == len(docs)

import re
from collections import Counter

import numpy as np
import pytest
from textmill.llm import collocation as C
from textmill.llm import queries as Q
from textmill.llm.fm_index import FMIndex
from util import awkward, frame, rng, sentence


def pieces(text):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    return [[w for w in re.split("[ \t]+", p) if w] for p in re.split("[.,;:!?\n\x0b\x0c\r]", low)]


def brute_counts(docs, most=3):
    c, left, right, n = Counter(), Counter(), Counter(), Counter()
    for lang, text in docs:
        lang = lang or "und"
        for p in pieces(text):
            n[lang] += len(p)
            for k in range(1, most + 1):
                for s in range(len(p) - k + 1):
                    g = lang, " ".join(p[s:s + k])
                    c[g] += 1
                    left[g] += s > 0
                    right[g] += s + k < len(p)
    return c, left, right, n


def brute(docs, most=3, least=10, covered=50, top=2000):
    c, _, _, n = brute_counts(docs, most)
    cand = {g: a for g, a in c.items() if a >= least and " " in g[1]}
    gone = set()
    for (lang, p), a in cand.items():
        w = p.split(" ")
        for k in range(2, len(w)):
            for s in range(len(w) - k + 1):
                inner = lang, " ".join(w[s:s + k])
                if 100 * a >= covered * c[inner]:
                    gone.add(inner)
    rows = {}
    for (lang, p), a in cand.items():
        if (lang, p) in gone:
            continue
        w = p.split(" ")
        cuts = [(10**6 * a * a // (c[lang, " ".join(w[:k])] * c[lang, " ".join(w[k:])]), k) for k in range(1, len(w))]
        score, k = min(cuts)
        rows.setdefault(lang, []).append((-score, -a, p.encode(), c[lang, " ".join(w[:k])], c[lang, " ".join(w[k:])]))
    return sorted((lang, r, x[2].decode(), -x[1], x[3], x[4], n[lang], -x[0])
                  for lang, found in rows.items() for r, x in enumerate(sorted(found)[:top], 1))


def corpus():
    r = rng(4)
    phrases = ["New York City.", "new york", "of the", "a b c", "Zürich élan naïve", "x\x00y z,", "don't stop"]
    texts = [t if t is None or len(t) < 9000 else t[:9000] for t in awkward(r)]
    return texts + [" ".join(r.choice(phrases) for _ in range(40)) + r.choice("\n\t;") + sentence(r, 20) for _ in range(50)]


def test_index_extends_both_ways():
    r = np.random.default_rng(2)
    for most, n in ((3, 200), (40, 3000), (2, 50)):
        seq = np.concatenate(([0], r.integers(0, most + 1, n), [0]))
        for depth in (1, 2, 3, 5):
            index, line = FMIndex(seq, depth), seq.tolist()
            for k, grams in enumerate(index.ngrams(depth, lambda ids: np.ones(ids.shape[1], bool)), 1):
                at = [s for s in range(len(line) - k + 1) if 0 not in line[s:s + k]]
                want = Counter(tuple(line[s:s + k]) for s in at)
                assert dict(zip(map(tuple, grams.ids.T.tolist()), grams.size.tolist())) == want
                left, right = (dict(zip(map(tuple, grams.ids.T.tolist()), x.tolist())) for x in index.neighbours(grams))
                assert left == {g: sum(line[s - 1] > 0 for s in at if tuple(line[s:s + k]) == g) for g in want}
                assert right == {g: sum(line[s + k] > 0 for s in at if tuple(line[s:s + k]) == g) for g in want}


def test_wide_keys_are_ranked():
    seq = np.concatenate(([0], np.random.default_rng(1).integers(1, 1 << 30, 500), [0]))
    *_, grams = FMIndex(seq % (1 << 22), 4).ngrams(4, lambda ids: np.ones(ids.shape[1], bool))
    assert len(grams.size) == 497 and (grams.size == 1).all()


@pytest.mark.parametrize("shard,segment", [(1 << 22, 1 << 20), (300, 50), (20, 1)])
def test_shards_sum_to_the_corpus(shard, segment, monkeypatch):
    import pyarrow as pa
    monkeypatch.setattr(C, "SHARD", shard)
    monkeypatch.setattr(C, "SEGMENT", segment)
    docs = [("en", t) for t in corpus()[:40]] + [("fr", "le chat, le chat noir"), ("und", "")]
    batch = pa.RecordBatch.from_pydict({"grp": [g for g, _ in docs], "body": pa.array([(t or "").encode() for _, t in docs], pa.binary())})
    c, left, right = Counter(), Counter(), Counter()
    for shard in C.shards(iter([batch]), 3):
        index, words = FMIndex(shard.seq, 3), shard.word.to_pylist()
        for grams in index.ngrams(3, lambda ids: np.ones(ids.shape[1], bool)):
            keys = [(shard.groups[shard.group[g[0]]], b" ".join(words[k] for k in g).decode()) for g in grams.ids.T.tolist()]
            for out, x in zip((c, left, right), (grams.size, *index.neighbours(grams))):
                for k, v in zip(keys, x.tolist()):
                    out[k] += shard.sign * v
    want = brute_counts(docs)
    assert c == want[0] and left == want[1] and right == want[2]


def test_collocations_match_brute_force(spark, monkeypatch):
    texts = corpus()
    langs = [[None, "en", "fr"][k % 3] for k in range(len(texts))]
    rows = [(k, t, g, "s", 1) for k, (t, g) in enumerate(zip(texts, langs))]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, phrase string, n long").repartition(3)
    docs = list(zip(langs, texts))
    for kw in ({}, {"least": 3, "most_words": 4, "covered": 90, "top": 300}):
        got = sorted(tuple(r)[:8] for r in C.collocations(df, **kw).collect())
        assert got == brute(docs, kw.get("most_words", 3), kw.get("least", 10), kw.get("covered", 50), kw.get("top", 2000)), kw
    c, left, right, n = brute_counts(docs)
    monkeypatch.setattr(C, "FILTER_BITS", 7)  # a filter that is full loses nothing
    for r in C.phrase_counts(df).collect():
        g = r["grp"], r["phrase"]
        assert (r["c"], r["with_left"], r["with_right"]) == ((n[g[0]], 0, 0) if r["words"] == 0 else (c[g], left[g], right[g]))


def test_large_counts_are_exact(spark):
    a, left, right = 987_654_321_012_345, 999_999_999_999_989, 999_999_999_999_961
    df = spark.createDataFrame([(a, left, right)], "a long, l long, r long")
    assert df.select(C.cut_score("a", "l", "r")).first()[0] == 10**6 * a * a // (left * right)


def test_empty_and_wordless(spark):
    assert C.collocations(frame(spark, [])).collect() == []
    assert C.collocations(frame(spark, [None, "", " . , "])).collect() == []


def test_query(spark):
    d = "/root/testdata/sf0.001"
    docs = [(r["lang"], r["text"]) for r in spark.read.parquet(f"{d}/documents.parquet").collect()]
    got = sorted(tuple(r) for r in Q.op12_collocations(spark, d).select("lang", "rank", "phrase", "a", "l", "r", "n", "score").collect())
    assert got == brute(docs) and len(got) > 100

"""Tokens that lie together by document are merged and scaled without a shuffle."""

import contextlib
import io
import random
import re

import pyarrow as pa
from pyspark.sql import functions as F

from textmill.operators import interpret as IP
from textmill.plans import catalog as C

TOKENS = "doc_id long, pos long, token string, weight double"


def _plan(df) -> str:
    out = io.StringIO()
    with contextlib.redirect_stdout(out):
        df.explain()
    return out.getvalue()


def _rows(df):
    """Rows in order, NaN as text."""
    plain = lambda x: x if not isinstance(x, float) else "nan" if x != x else round(x, 9)
    return sorted((tuple(map(plain, r)) for r in df.collect()), key=repr)


def test_token_rows_of_whole_documents_are_not_shuffled(spark, tmp_path):
    docs = [(i, f"some words of text {i}") for i in range(50)]
    spark.createDataFrame(docs, "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    for q, op in ((C.q_merge_subwords, "Window"), (C.q_normalise_weights, "Window")):
        whole = re.split(r"\n\+- |\n   \+- ", _plan(q(spark, str(tmp_path))))[1]
        # the one exchange and window by document are below the explode, on texts
        assert "MapInArrow" in whole
        tokens = whole.split("Generate")[0]
        assert "Exchange" not in tokens and op not in tokens


def test_merged_together_as_through_the_shuffle(spark):
    rng = random.Random(7)
    pieces = ["Ġab", "c", "Ġ", "Ċ", "<s>", "</s>", "Ġd e", " ", "é", "Ġ", "<unk>", "xĠyĊ", None, "", "\t", "Ġ🙂"]
    rows = []
    for doc in [5, None, 3, 9, 1, 7]:
        pos = list(range(rng.randint(0, 60)))
        rng.shuffle(pos)
        rows += [(doc, None if p == 4 else p, rng.choice(pieces), rng.choice([None, 0.5, 1.25, 2.0])) for p in pos]
    rows += [(11, 1, "Ġa", 1.0), (11, 2, "z", 2.0), (11, 2, "b", 4.0), (12, 0, "<s>", 0.0), (13, 1, "tail", None)]
    df = spark.createDataFrame(rows, TOKENS).coalesce(1)
    a, b = IP.merge_subwords(df, together=True), IP.merge_subwords(df)
    assert a.columns == b.columns and _rows(a) == _rows(b)
    assert (11, 1, "abz", round(7 / 3, 9)) in _rows(a) and (13, 1, "tail", None) in _rows(a)


def test_scaled_together_as_through_the_shuffle(spark):
    inf, nan = float("inf"), float("nan")
    weights = {1: [1.0, 3.0, 2.0, None], 2: [5.0, 5.0], None: [None, None], 4: [nan, 1.0, 2.0], 5: [nan, nan], 6: [inf, 1.0], 7: [inf, inf], 8: [-inf, None, 0.0]}
    rows = [(d, i, "t", w) for d, ws in weights.items() for i, w in enumerate(ws)]
    df = spark.createDataFrame(rows, TOKENS).coalesce(1)
    assert _rows(IP.normalise_weights(df, together=True)) == _rows(IP.normalise_weights(df))


def test_documents_are_whole_whatever_the_batches():
    docs = [1] * 5 + [None] * 3 + [2] * 40 + [3] + [4] * 7
    t = pa.table({"doc": docs, "i": range(len(docs))})
    seen = []
    for size in (1, 3, 8, 100):
        for rows in (1, 4, 16, 1000):
            got = []
            for part in IP._by_documents(lambda x: seen.append(x) or x, "doc", rows)(iter(t.to_batches(max_chunksize=size))):
                got += part.column("i").to_pylist()
            assert got == list(range(len(docs)))
            parts, seen = [set(x.column("doc").to_pylist()) for x in seen], []
            assert sum(map(len, parts)) == 5  # no document in two parts


def test_shared_ids_and_long_texts_go_by_rows(spark, tmp_path):
    docs = [(1, "alpha beta"), (2, "gamma"), (2, "gamma"), (3, None), (None, ""), (4, "x" * 400 + " <s> y" * 30), (5, "")]
    spark.createDataFrame(docs, "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    whole, others = IP.whole_rows(spark.createDataFrame(docs, "doc_id long, text string"), "doc_id", F.length("text"), 300)
    assert {r[0] for r in whole.collect()} == {1, 3, None, 5} and sorted(r[0] for r in others.collect()) == [2, 2, 4]
    words = _rows(C.q_merge_subwords(spark, str(tmp_path)))
    assert [r[:3] for r in words if r[0] in (1, 2)] == [(1, 1, "alpha"), (1, 2, "beta"), (2, 1, "gam"), (2, 2, "gammama")]
    assert not any(r[0] in (3, 5, None) for r in words)
    weights = _rows(C.q_normalise_weights(spark, str(tmp_path)))
    assert [r for r in weights if r[0] == 3] == [(3, 0, "<s>", 0.0), (3, 10 ** 12, "</s>", 0.0)]

import hashlib
import re

import numpy as np
import pytest
from pyspark.sql import functions as F
from textmill.llm import fim
from textmill.llm import queries as Q
from util import awkward, frame, rng

TOKEN = re.compile(r"[A-Za-z]+|[^A-Za-z]")


def brute(doc_id, text):
    text = text or ""
    tok = TOKEN.findall(text)
    digest = hashlib.sha256(f"1:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h = [int(digest[8 * k:8 * k + 8], 16) for k in range(4)]
    n = len(tok)
    a, b = sorted((h[0] % (n + 1), h[1] % (n + 1)))
    p, m, s = "".join(tok[:a]), "".join(tok[a:b]), "".join(tok[b:])
    if not text or re.search("<[PSM]>", text) or h[2] % 100 >= 90:
        return n, "plain", None, None, text
    if h[3] % 100 < 20:
        return n, "spm", len(p), len(m), f"<S>{s}<P>{p}<M>{m}"
    return n, "psm", len(p), len(m), f"<P>{p}<S>{s}<M>{m}"


@pytest.mark.parametrize("density", [0.001, 0.02, 0.5, 0.97, 1.0])
def test_select_in_every_container(density):
    r = np.random.default_rng(3)
    for n in (1, 63, 64, 65_535, 65_536, 65_537, 200_000):
        member = r.random(n) < density
        member[n // 2] = True
        want, got = np.flatnonzero(member), fim.BoundarySet(member)
        assert len(got) == len(want)
        for k in {0, len(want) - 1, len(want) // 2, *r.integers(0, len(want), 50).tolist()}:
            assert got.select(k) == want[k]


def test_containers_are_all_used():
    r = np.random.default_rng(1)
    assert type(fim.BoundarySet(r.random(60_000) < 0.01).containers[0]) is fim.ArrayContainer
    assert type(fim.BoundarySet(r.random(60_000) < 0.5).containers[0]) is fim.BitmapContainer
    assert type(fim.BoundarySet(np.ones(60_000, bool)).containers[0]) is fim.RunContainer
    gap = np.zeros(300_000, bool)
    gap[[5, 299_999]] = True  # spans without a member have no container
    assert len(fim.BoundarySet(gap).containers) == 2 and fim.BoundarySet(gap).select(1) == 299_999


def test_forms_match_brute_force(spark):
    texts = [*awkward(rng(8)), "a <P> inside", "<S>", "<M", "tail\n", "a\r\nb c", "<<S", "P>x<", *(f"w{k} Aé-b" for k in range(150))]
    rows = frame(spark, texts).unionByName(frame(spark, ["no id", None]).withColumn("doc_id", F.lit(None).cast("long")))
    twice = rows.unionByName(rows)
    got = twice.transform(fim.transform).withColumn("back", fim.restore()).collect()
    want = sorted([(k, *brute(k, t)) for k, t in enumerate(texts)] * 2 + [(None, *brute(None, t)) for t in ("no id", None)] * 2, key=repr)
    assert sorted([tuple(g)[:6] for g in got], key=repr) == want
    assert {g["form"] for g in got} == {"plain", "psm", "spm"}
    whole = dict(enumerate(texts))
    assert all(g["back"] == (whole[g["doc_id"]] or "") for g in got if g["doc_id"] is not None)


def test_empty_table_and_rates(spark):
    assert fim.transform(frame(spark, [])).collect() == []
    some = frame(spark, [f"word {k} more words" for k in range(40)])
    assert {r["form"] for r in fim.transform(some, rate=0).collect()} == {"plain"}
    assert {r["form"] for r in fim.transform(some, rate=100, suffix_first=100).collect()} == {"spm"}


def test_query(spark):
    d = "/root/testdata/sf0.001"
    docs = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{d}/documents.parquet").collect()}
    got = Q.op13_fill_in_middle(spark, d).collect()
    assert len(got) == len(docs)
    for g in got:
        n, form, a, b, out = brute(g["doc_id"], docs[g["doc_id"]])
        assert (g["n"], g["form"], g["prefix_chars"], g["middle_chars"]) == (n, form, a, b)
        assert g["output_sha256"] == hashlib.sha256(out.encode()).hexdigest()
        assert g["restored_sha256"] == hashlib.sha256((docs[g["doc_id"]] or "").encode()).hexdigest()

import re
from itertools import combinations

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F
from textmill.llm import simhash as S
from textmill.llm.common import components, forest
from util import SCHEMA, awkward, frame, rng, rows, sentence


def brute_fp(text, n=3):
    w = re.findall(r"[^\x20\x09-\x0D]+", "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))
    sh = [" ".join(w[k:k + n]) for k in range(len(w) - n + 1)] if len(w) > n else [" ".join(w)] if w else []
    h = [xxhash.xxh64(s.encode(), seed=42).intdigest() for s in sh]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def brute_components(fps, bits=3):
    own = list(range(len(fps)))

    def top(x):
        while own[x] != x:
            x = own[x]
        return x

    for a, b in combinations(range(len(fps)), 2):
        if (fps[a] ^ fps[b]).bit_count() <= bits:
            x, y = sorted((top(a), top(b)))
            own[y] = x
    return [top(k) for k in range(len(fps))]


def test_components_match_brute_force(spark):
    r = rng()
    texts = awkward(r)
    long = sentence(r, 500).split()
    for k in range(40):  # near copies
        w = list(long)
        w[k * 7] = "changed"
        texts.append(" ".join(w))
    fps = [brute_fp(t) for t in texts]
    own = brute_components(fps)
    got = {x["doc_id"]: x for x in S.simhash_components(frame(spark, texts)).collect()}
    assert len(got) == len(texts) and len(set(own)) < len(texts) - 20
    for k in range(len(texts)):
        assert got[k]["fingerprint"] == f"{fps[k]:016x}"
        assert got[k]["component_id"] == own[k]
        assert got[k]["kept"] == (own[k] == k)


@pytest.mark.parametrize("max_bits,block", [(0, 2048), (3, 16), (3, 2048), (5, 64)])
def test_search_loses_no_link(spark, max_bits, block):
    """Clustered fingerprints, some buckets far above the block size."""
    g = np.random.default_rng(max_bits)
    centres = g.integers(0, 2**63, 12, dtype=np.uint64)
    fps = [0, 2**64 - 1]
    for _ in range(400):
        x = int(g.choice(centres))
        for b in g.choice(64, g.integers(0, 6), replace=False):
            x ^= 1 << int(b)
        fps.append(x)
    fps = sorted(set(fps))
    df = spark.createDataFrame([(S.signed(x),) for x in fps], "fp long")
    found = {x["fp"] % 2**64: x["root"] % 2**64 for x in S.near_groups(df, max_bits, block).collect()}
    own = brute_components(fps, max_bits)
    mine = [found.get(x, x) for x in fps]
    groups = {}
    for k, o in enumerate(own):
        groups.setdefault(o, set()).add(mine[k])
    assert all(len(v) == 1 for v in groups.values())
    assert len({next(iter(v)) for v in groups.values()}) == len(groups)


def test_thresholds_obey_the_generalised_pigeonhole(spark):
    df = spark.createDataFrame([(S.signed(int(x)),) for x in np.random.default_rng(1).integers(0, 2**63, 500, dtype=np.uint64)], "fp long")
    parts = S.plan(df, 3)
    bits = [b for p, _ in parts for b in p]
    assert len(bits) == len(set(bits))
    for costs, total in (([[0, 5, 9, 20], [0, 1, 2, 3]], 1), ([[0, 1, 8]] * 4, 0)):
        cost, t = S.allocate(costs, total)
        assert sum(t) == total and cost == sum(c[x + 1] for c, x in zip(costs, t))


def test_drop_near_duplicates(spark):
    r = rng(2)
    a, b = sentence(r, 200), sentence(r, 200)
    df = frame(spark, [a, a, b, None, ""], more=[*rows([a]), *(x for x in spark.createDataFrame([(None, b)], "doc_id long, text string")
               .select("doc_id", "text", *(F.lit(None).cast(t).alias(n) for n, t in (c.split() for c in SCHEMA.split(", ")[2:]))).collect())])
    out = S.drop_near_duplicates(df)
    assert out.columns == df.columns
    assert sorted((x["doc_id"] if x["doc_id"] is not None else -1) for x in out.collect()) == [-1, 0, 2, 3]


def test_empty(spark):
    assert S.simhash_components(frame(spark, [])).collect() == []


def test_components_of_a_path_and_a_star(spark):
    n = 70
    e = [(k, k + 1) for k in range(n)] + [(500, k) for k in range(501, 560)] + [(9, 9)]
    got = {x["node"]: x["root"] for x in components(spark.createDataFrame(e, "a long, b long")).collect()}
    assert all(got[k] == 0 for k in range(1, n + 1)) and all(got[k] == 500 for k in range(501, 560)) and 0 not in got
    assert forest(5, np.array([4, 3]), np.array([1, 4])).tolist() == [0, 1, 2, 1, 1]

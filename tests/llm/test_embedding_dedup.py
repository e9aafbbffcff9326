import numpy as np
import pytest
from textmill.llm import embedding_dedup as E


def brute(rows, threshold=0.93):
    """{id: (n_links, component)} for rows (id, vector, label)."""
    ids = sorted({r[0] for r in rows if r[0] is not None})
    vec = {}
    for i, v, lab in rows:
        ok = i is not None and lab is not None and v and all(x is not None and np.isfinite(x) for x in v) and any(v)
        if ok:
            vec[i] = (lab, np.array(v, np.float64) / np.linalg.norm(np.array(v, np.float64)))
    own = {i: i for i in ids}

    def top(x):
        while own[x] != x:
            x = own[x]
        return x

    n = dict.fromkeys(ids, 0)
    good = sorted(vec)
    for a in range(len(good)):
        for b in range(a):
            (la, x), (lb, y) = vec[good[a]], vec[good[b]]
            if la == lb and len(x) == len(y) and x @ y >= threshold:
                n[good[a]] += 1
                n[good[b]] += 1
                p, q = sorted((top(good[a]), top(good[b])))
                own[q] = p
    return {i: (n[i], top(i)) for i in ids}


def make(seed=0):
    g = np.random.default_rng(seed)
    rows = []
    centres = [g.standard_normal(16) for _ in range(30)]
    for k in range(260):
        v = centres[k % 30] + g.standard_normal(16) * g.choice([0.02, 0.15, 0.5])
        rows.append((k, [float(np.float32(x)) for x in v], int(k % 30 % 3)))
    rows += [(300 + k, rows[0][1], 0) for k in range(40)]                       # copies
    rows += [(400, rows[0][1], 1), (401, rows[0][1], None), (402, None, 0), (403, [], 0), (404, [0.0] * 16, 0),
             (405, [float("nan")] + [1.0] * 15, 0), (406, [float("inf")] + [1.0] * 15, 0), (407, [None] + [1.0] * 15, 0),
             (408, [1.0, 2.0], 0), (409, [2.0, 4.0], 0), (None, rows[0][1], 0), (300, rows[0][1], 0)]
    return rows


@pytest.mark.parametrize("kind,block", [("float", 16), ("double", 1024)])
def test_links_match_brute_force(spark, kind, block):
    rows = make()
    df = spark.createDataFrame([(*r, 1, "x") for r in rows], f"vec_id long, embedding array<{kind}>, label int, n_links int, gid string")
    got = E.near_vectors(df, block=block).collect()
    want = brute(rows)
    assert len(got) == len(rows)
    for x in got:
        if x["vec_id"] is None:
            assert (x["n_links"], x["component_id"], x["kept"]) == (0, None, True)
        else:
            assert (x["n_links"], x["component_id"]) == want[x["vec_id"]], x["vec_id"]
            assert x["kept"] == (x["vec_id"] == x["component_id"])


def test_empty(spark):
    df = spark.createDataFrame([], "vec_id long, embedding array<float>, label int")
    assert E.near_vectors(df).collect() == []


def test_tables_meet_the_wanted_chance():
    for n in (10, 1000, 10**6):
        signs, tables = E.tables_for(n, 0.93, 0.9995)
        p = (1 - np.arccos(0.93) / np.pi) ** signs
        assert 1 - (1 - p) ** tables >= 0.9995


def test_query(spark):
    from textmill.llm import queries as Q
    d = "/root/testdata/sf0.001"
    rows = [(r["vec_id"], list(r["embedding"]), r["label"]) for r in spark.read.parquet(f"{d}/embeddings.parquet").collect()]
    want = brute(rows)
    got = {x["vec_id"]: (x["n_links"], x["component_id"]) for x in Q.op1_embedding_dedup(spark, d).collect()}
    assert got == want

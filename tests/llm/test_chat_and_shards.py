import hashlib
import random
from collections import Counter

import duckdb
import pytest
from pyspark.sql import functions as F
from textmill.llm import chat_tree as C
from textmill.llm import queries as Q
from textmill.llm import shard as S

ODD = ["\\### Assistant: </turn> ok", "", None, "\\", "\\\\h\\l<#", "### user: x</turn>\n### assistant: y", "a\\c:b", "é😀\n", "</turn>", "\\\\\\"]


def test_round_trip_of_odd_texts(spark):
    r = random.Random(0)
    texts = ODD + ["".join(r.choice("\\#<:hlc/ \né") for _ in range(r.randint(0, 12))) for _ in range(60)]
    rows = [(k // 5 if k // 5 else None, k % 5 if k % 7 else None, r.choice(["user", "assistant", "sys: <#\\c", None]), t, "x") for k, t in enumerate(texts)]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string, node string")
    out = C.format_conversations(df)
    got = {x["conv_id"]: x for x in out.select("conv_id", "n_turns", C.read_back(F.col("formatted")).alias("t"),
                                               C.learned_text(F.col("formatted"), F.col("loss")).alias("l")).collect()}
    low = lambda x: (x is not None, x if x is not None else "")  # noqa: E731  nulls first
    by = {}
    for i, turn, role, text, _ in sorted(rows, key=lambda x: (low(x[1]) if x[1] is None else (True, x[1]), low(x[2]), low(x[3])) if x[1] is not None
                                         else ((False, 0), low(x[2]), low(x[3]))):
        by.setdefault(i, []).append((role or "", text or ""))
    assert got.keys() == by.keys()
    for i, turns in by.items():
        assert [(t["role"], t["text"]) for t in got[i]["t"]] == turns and got[i]["n_turns"] == len(turns)
        assert got[i]["l"] == "".join(t for role, t in turns if role == "assistant")


def brute_paths(nodes):
    kids = {}
    known = {n for n, *_ in nodes}
    score = {n: s for n, _, s in nodes}
    for n, p, _ in nodes:
        kids.setdefault(p if p in known else None, []).append(n)
    out, todo = [], [[n] for n in kids[None]]
    while todo:
        path = todo.pop()
        if path[-1] in kids:
            todo += [[*path, k] for k in kids[path[-1]]]
        else:
            out.append((-sum(score[n] for n in path), path[-1], path))
    return sorted(out)


def test_branches_are_ranked_and_enumerated(spark):
    r = random.Random(3)
    rows, want = [], {}
    for tree, size, deep in (("a", 40, False), ("b", 70, True), ("c", 1, False)):
        nodes = [(n, None if n == 0 or r.random() < 0.05 else n - 1 if deep and r.random() < 0.9 else r.randrange(n), float(r.randint(0, 3))) for n in range(size)]
        nodes[0] = (0, 999, 1.0)  # an unknown parent
        want[tree] = brute_paths(nodes)[:3]
        rows += [(tree, n, p, s) for n, p, s in nodes]
    got = {}
    for x in C.paths(spark.createDataFrame(rows, "tree string, node long, parent long, score double"), 3).orderBy("pos").collect():
        got.setdefault(x["tree"], {}).setdefault((x["rank"], x["leaf"]), []).append(x["node"])
    for tree, best in want.items():
        assert got[tree] == {(k + 1, leaf): path for k, (_, leaf, path) in enumerate(best)}


def test_cycles_are_an_error_and_empty_is_empty(spark):
    with pytest.raises(ValueError):
        C.paths(spark.createDataFrame([("a", 1, 2, 0.0), ("a", 2, 1, 0.0)], "tree string, node long, parent long, score double"), 1)
    assert C.format_conversations(spark.createDataFrame([], "conv_id long, turn long, role string, text string")).collect() == []


def test_query_equals_its_sql(spark):
    d = "/root/testdata/sf0.001"
    con = duckdb.connect()
    con.execute(f"CREATE VIEW conversations AS SELECT * FROM '{d}/conversations.parquet'")
    cols = ["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"]
    want = sorted(con.execute(f"SELECT {', '.join(cols)} FROM ({Q.OP8_SQL})").fetchall())
    assert sorted(tuple(x[c] for c in cols) for x in Q.op8_chat_format(spark, d).collect()) == want


def brute_fill(names, slots):
    """Turn by turn over whole permutations."""
    num = lambda salt, s: int(hashlib.md5(f"{salt}:{s}".encode()).hexdigest()[:15], 16)
    order = [[(num("offset", s) % slots + k * (num("skip", s) % (slots - 1) + 1)) % slots for k in range(slots)] for s in names]
    owner = {}
    while len(owner) < slots:
        for k, o in enumerate(order):
            if len(owner) < slots:
                owner[next(x for x in o if x not in owner)] = k
    return [owner[k] for k in range(slots)]


def test_table_fill():
    names = [f"n{k}" for k in range(7)]
    got = S.fill(names, 211)
    assert got == brute_fill(names, 211)
    share = Counter(S.fill(Q.SHARDS))
    assert max(share.values()) - min(share.values()) <= 1
    less = S.fill(Q.SHARDS[:-1])
    moved = sum(a != b for a, b in zip(S.fill(Q.SHARDS), less)) / S.SLOTS
    assert moved < 0.1
    for bad in (([], 211), (["a", "a"], 211), (["a"], 210)):
        with pytest.raises(ValueError):
            S.fill(*bad)


def test_placement(spark, tmp_path):
    names = ["x", "y", "z"]
    keys = [None, "", "a", "a", *map(str, range(200))]
    df = spark.createDataFrame([(k, 1) for k in keys], "k string, key int")
    table = S.fill(names, 101)
    got = S.place(df, "k", names, 101).collect()
    want = Counter((k, int(hashlib.md5((k or "").encode()).hexdigest()[:15], 16) % 101) for k in keys)
    assert Counter((x["k"], x["slot"]) for x in got) == want and all(x["shard"] == table[x["slot"]] for x in got)
    assert S.place(df.limit(0), "k", names, 101).collect() == []
    with pytest.raises(ValueError):
        S.place(df.withColumnRenamed("key", "slot"), "k", names, 101)
    S.write_shards(df, str(tmp_path / "o"), "k", names, 101)
    back = spark.read.parquet(str(tmp_path / "o"))
    assert back.count() == len(keys) and Counter(x["shard"] for x in back.collect()) == Counter(x["shard"] for x in got)

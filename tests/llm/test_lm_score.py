import math
from collections import Counter

import numpy as np
from textmill.llm import lm_score as L
from util import awkward, crc, frame, rng, sentence


def tokens(t):
    return [*(t or "").encode().lower().split(), b""]


def test_scores(spark, monkeypatch):
    monkeypatch.setattr(L, "FREQUENT", 12)  # some words stay in the tail
    r = rng(9)
    a, b = "alpha beta gamma delta".split(), "uno dos tres cuatro".split()
    texts = awkward(r) + [sentence(r, r.randint(20, 200), a if k % 2 else b) for k in range(300)]
    df = frame(spark, texts)
    rows = {x["doc_id"]: x for x in L.score_table(df).collect()}
    assert len(rows) == len(texts)
    count = Counter(w for k, t in enumerate(texts) if crc(k, 10) for w in tokens(t))
    n, v = sum(count.values()), len(count)
    gain = []
    for k, t in enumerate(texts):
        x, w = rows[k], tokens(t)
        base = sum(math.log10((count[y] + 0.1) / (n + 0.1 * (v + 1))) for y in w)
        assert x["held_out"] == (crc(k, 10) == 0) and x["train_tokens"] == n and x["n_tokens"] == len(w)
        assert x["n_known"] == sum(count[y] > 0 for y in w)
        assert math.isclose(x["base_score"], base, rel_tol=1e-9, abs_tol=1e-9)
        if x["held_out"] and k >= 75:
            gain.append((x["score"] - base) / len(w))
    assert len(gain) > 10 and np.mean(gain) > 0.05


def test_probabilities_sum_to_one(spark, monkeypatch):
    monkeypatch.setattr(L, "FREQUENT", 6)
    r = rng(1)
    texts = [sentence(r, 50) for _ in range(40)]
    df = spark.createDataFrame([(k, t.encode()) for k, t in enumerate(texts)], "id long, body binary")
    counts = L.word_counts(df)
    frequent, c = L.frequent_words(counts)
    m = L.train(L.encode(df, frequent), c, *counts.selectExpr("sum(c)", "count(*)").first())
    tail = len(frequent)
    ids = np.array([0, 1, tail, 2, 0], np.uint32)
    y = L.logits(m, m.weights, L.features(ids, np.array([5]), tail + 1)).astype(float)
    logs = y - np.log(np.exp(y).sum(axis=1, keepdims=True))
    every = {bytes(x["word"]): x["c"] for x in counts.collect()}
    for y in logs:
        p = sum(math.exp(y[m.classes[k]] + m.within[k]) for k in range(tail))
        z = m.tail_total + 0.1 * (m.tail_distinct + 1)
        p += math.exp(y[0]) * sum((c + 0.1) / z for w, c in every.items() if w not in frequent) + math.exp(y[0]) * 0.1 / z
        p += sum(math.exp(y[c]) for c in range(1, L.CLASSES) if c not in m.classes[:tail])
        assert math.isclose(p, 1, rel_tol=1e-5)


def test_learning_lowers_the_loss():
    r = np.random.default_rng(0)
    ids = r.integers(0, 40, 4000).astype(np.uint32)
    ids[1::2] = (ids[::2] * 7 + 1) % 40  # every second token follows from the one before
    m = L.Model(np.ones(40), 1, 1, np.append(np.arange(40) % L.CLASSES, 0), np.zeros(41), 0, 0,
                np.zeros(L.CLASSES, np.float32), np.zeros((L.ROWS, L.CLASSES), np.float32))
    rows, target, w = L.features(ids, np.array([4000]), 41), m.classes[ids], m.weights.copy()
    before = L.class_logs(m, w, rows, target).mean()
    squares, visits = np.ones_like(w), np.zeros(L.ROWS)
    for _ in range(5):
        for s in range(0, 4000, 500):
            L.learn(m, w, squares, visits, rows[:, s:s + 500], target[s:s + 500])
    assert L.class_logs(m, w, rows, target).mean() > before + 0.8


def test_empty_and_untrained(spark):
    assert L.score_table(frame(spark, [])).collect() == []
    held = next(k for k in range(100) if crc(k, 10) == 0)
    x = L.score_table(frame(spark, ["a b"], start=held)).collect()[0]
    assert (x["train_tokens"], x["n_known"], x["n_tokens"]) == (0, 0, 3) and abs(x["base_score"]) < 1e-9


def test_words_are_predicted_from_their_neighbours(spark):
    r = rng(3)
    after = list(range(200))
    r.shuffle(after)  # one cycle or a few; every word has one successor

    def walk():
        k, out = r.randrange(200), []
        for _ in range(60):
            out.append(f"w{k}")
            k = after[k]
        return " ".join(out)

    got = L.score_table(frame(spark, [walk() for _ in range(1500)])).where("held_out").collect()
    gain = sum(x["score"] - x["base_score"] for x in got) / sum(x["n_tokens"] for x in got)
    assert gain > 1.5  # a choice among 16 classes gives at most log10(16) = 1.2


def test_within_class_probabilities_sum_to_one(spark):
    r = rng(2)
    vocabulary = [f"w{k}" for k in range(300)]
    df = spark.createDataFrame([(k, sentence(r, 80, vocabulary).encode()) for k in range(60)], "id long, body binary")
    counts = L.word_counts(df)
    frequent, c = L.frequent_words(counts)
    m = L.train(L.encode(df, frequent), c, *counts.selectExpr("sum(c)", "count(*)").first())
    n = len(frequent)
    assert n == 301 and np.diff(m.starts).max() == L.LEARNED and np.any(m.deep) and m.below[:n].min() < -1
    total = 0.0
    for k in [*range(n), n]:  # every word, and the tail, after the same two words
        ids, length = np.array([5, 9, k], np.uint32), np.array([3])
        logs = L.class_logs(m, m.weights, L.features(ids, length, n + 1, m.bits), m.classes[ids])
        at, side, lean, size = L.decisions(m, ids, L.contexts(ids, length, n + 1))
        total += math.exp(logs[2] + L.side_logs(m.deep, at, side, lean)[size[:2].sum():].sum() + m.below[k])
    assert math.isclose(total, 1, rel_tol=1e-4)


def test_weight_rows_follow_the_tokens():
    assert [L.row_bits(n) for n in (0, 10**6, 4 * 10**7, 10**12)] == [L.BITS, L.BITS, 16, L.MOST_BITS]


def test_rare_words_keep_their_identity_in_the_history(spark):
    df = spark.createDataFrame([(0, b"a b c b")], "id long, body binary")
    ids = np.frombuffer(L.encode(df, [b"a"]).first()["ids"], np.uint32)
    assert ids[0] == 0 and ids[1] == ids[3] != ids[2] and ids[1:].min() > 2


def test_scores_equal_a_plain_sum(spark, monkeypatch):
    """The score of texts from the same model, a token and a fork at a time."""
    monkeypatch.setattr(L, "RUN", 64)  # texts longer than a run
    kept = []
    train = L.train
    monkeypatch.setattr(L, "train", lambda *a: kept.append(train(*a)) or kept[0])
    monkeypatch.setattr(L, "FREQUENT", 60)
    r = rng(11)
    texts = [sentence(r, r.randint(0, 200), [f"w{int(r.random() ** 2 * 90)}" for _ in range(50)]) for _ in range(60)]
    got = {x["doc_id"]: x["score"] for x in L.score_table(frame(spark, texts)).collect()}
    m = kept[0]
    count = Counter(w for k, t in enumerate(texts) if crc(k, 10) for w in tokens(t))
    frequent = sorted((w for w in count), key=lambda w: (-count[w], w))[:len(m.counts)]
    ids, tail = {w: k for k, w in enumerate(frequent)}, len(frequent)
    z = m.tail_total + 0.1 * (m.tail_distinct + 1)
    for k, t in enumerate(texts):
        line, total = [tail + 1] * 3, 0.0
        for w in tokens(t):
            one = np.array([ids.get(w, tail + 2 + L.zlib.crc32(w) % (2**32 - tail - 2))], np.uint32)
            line.append(int(one[0]))
            h = L.contexts(np.array(line[-4:], np.uint32), np.array([4]), tail + 1)[:, 3:]
            y = m.bias + sum(m.weights[int(a)] for a in L.place(h, np.uint32(0), m.bits)[:, 0])
            at = min(int(one[0]), tail)
            total += float(y[m.classes[at]] - np.log(np.exp(y - y.max()).sum()) - y.max())
            for f in range(m.starts[at], m.starts[at + 1]):
                x = m.lean[m.forks[f]] + sum(m.deep[int(a)] for a in L.place(h, m.forks[f], m.bits + L.DEEP)[:, 0])
                total -= math.log1p(math.exp(float(x if m.sides[f] == 0 else -x)))
            total += m.below[at] if at < tail else math.log((count[w] + 0.1) / z)
        assert math.isclose(got[k], total / math.log(10), rel_tol=1e-4, abs_tol=1e-4)

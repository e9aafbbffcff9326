"""Language-model scores: a hashed maximum-entropy model with n-gram and skip
features and a class-factored softmax.

P(word | history) = P(class | history) * P(word | class, history).  The first
factor is a softmax over a few classes; the second is hierarchical: two-way
softmaxes (forks) down a tree of the class's words.  The logits of the classes
and of a word's first LEARNED forks are a bias from the counts plus hashed
weights for the word before, the pair before, and the words two and three
places before, at a fork hashed together with it; below, forks keep the shares
of the counts.  Any word counts in the history, by its hash where it is not
frequent.
Classes are clusters of frequent words that keep the same company (profiles of
the documents they occur in); all other words, and one unseen word, share a
tail class, within which a word has its smoothed share whatever the history.

Everything is gathered from all training documents: word counts, the classes'
profiles, and the weights, for which every training document is visited once.
Texts are encoded once, and training and scoring read the ids.
Training goes in rounds over disjoint parts of the documents: a few tasks (the
session's slots, or one for each TASK_TOKENS where that is more) start from
the broadcast weights, make gradient steps on their rows, and their changes
are averaged row by row, so what is sent follows the tasks, not the splits.  The number of weights follows the training tokens up
to 2^MOST_BITS rows and 2^DEEP times as many weights of forks; what is broadcast is bounded by that and FREQUENT;
counts of words outside the frequent ones meet the texts in a join.
"""

from __future__ import annotations

import heapq
import math
import zlib
from collections import Counter, defaultdict
from collections.abc import Iterator
from dataclasses import dataclass, replace
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import crc_mod, stored, text_bytes

FREQUENT = 1 << 17   # words with an id of their own, at most
BITS = 15            # of hashed feature rows, at least
ROWS = 1 << BITS
MOST_BITS = 17       # at most
DEEP = 4             # bits more for the weights of forks
LEARNED = 3          # forks of a word that see its history
TASK_TOKENS = 1 << 24
RUN = 1 << 17        # tokens whose contexts are alive at once
CLASSES = 16         # class 0 is the tail
ROUNDS = 2
STEP = 0.3           # of the gradient updates (AdaGrad)
BATCH = 8192         # tokens of one update
FORKS = 1 << 14      # forks of one update
BLOCK = 4096         # weights averaged together
PROFILE = 8          # numbers of a word's profile
SMOOTH = 0.1
END = b""            # the token after the last word; no word is empty


def words(text: bytes) -> list[bytes]:
    return text.lower().split()  # A-Z; runs of anything but the six ASCII blanks


def word_counts(texts: DataFrame, flush: int = 1_000_000) -> DataFrame:
    """(word binary, c) of every token of the column ``body``, ends included."""
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows(c: Counter) -> pa.RecordBatch:
            return pa.RecordBatch.from_pydict({"word": pa.array(list(c), pa.binary()), "c": pa.array(list(c.values()), pa.int64())})

        c: Counter = Counter()
        for b in batches:
            for t in b.column(0).to_pylist():
                c.update(words(t))
                c[END] += 1
                if len(c) > flush:
                    yield rows(c)
                    c = Counter()
        if c:
            yield rows(c)

    return texts.select("body").mapInArrow(count, "word binary, c long").groupBy("word").agg(F.sum("c").alias("c"))


@dataclass(frozen=True)
class Model:
    """What the tasks need; ids are places among the frequent words."""
    counts: np.ndarray       # of the frequent words
    total: int               # N
    distinct: int            # V
    classes: np.ndarray      # class of every id, and of the tail id
    within: np.ndarray       # ln P(word | class) of every id by the counts; 0 for the tail
    tail_total: int
    tail_distinct: int
    bias: np.ndarray         # by class
    weights: np.ndarray      # rows x CLASSES
    starts: np.ndarray | None = None  # where the forks on the way to every id begin
    forks: np.ndarray | None = None
    sides: np.ndarray | None = None   # which way, 0 or 1
    lean: np.ndarray | None = None    # bias of every fork
    below: np.ndarray | None = None   # ln of the shares of every id's other forks
    deep: np.ndarray | None = None    # weights of the forks

    @property
    def bits(self) -> int:
        return len(self.weights).bit_length() - 1

    def base(self, c: np.ndarray) -> np.ndarray:
        return np.log10((c + SMOOTH) / (self.total + SMOOTH * (self.distinct + 1)))


def context_runs(ids: np.ndarray, lengths: np.ndarray, start: int) -> Iterator[tuple[int, int, np.ndarray]]:
    """(first, end, hashes 4 x tokens) of what stands before the tokens of
    consecutive documents, RUN tokens at a time whatever their length; before
    a document stand three start tokens."""
    n, pad = len(ids), 3
    shift = np.repeat(np.arange(1, len(lengths) + 1, dtype=np.int32) * pad, lengths)
    line = np.full(n + pad * len(lengths), start, np.uint32)
    line[np.arange(n) + shift] = ids
    a, b, c, d = (np.uint32(x) for x in (0x9E3779B1, 0x85EBCA77, 0xC2B2AE3D, 0x27D4EB2F))
    for s in range(0, n, RUN):
        at = np.arange(s, min(s + RUN, n)) + shift[s:s + RUN]
        one, two, three = line[at - 1], line[at - 2], line[at - 3]
        yield s, min(s + RUN, n), np.stack((one * a + np.uint32(1), (one * b) ^ (two * c), two * d + np.uint32(3), three * c + np.uint32(5)))


def contexts(ids: np.ndarray, lengths: np.ndarray, start: int) -> np.ndarray:
    return np.concatenate([m for _, _, m in context_runs(ids, lengths, start)], axis=1)


def place(mixed: np.ndarray, fork: np.ndarray | np.uint32, bits: int) -> np.ndarray:
    """Places of the weights of contexts at a fork; 0 stands for the classes."""
    mixed = mixed + fork * np.uint32(0x85EBCA6B)
    mixed ^= mixed >> np.uint32(15)
    return mixed * np.uint32(0x9E3779B1) >> np.uint32(32 - bits)


def features(ids: np.ndarray, lengths: np.ndarray, start: int, bits: int = BITS) -> np.ndarray:
    """Feature rows (4 x tokens) of the decisions between classes."""
    return place(contexts(ids, lengths, start), np.uint32(0), bits)


def decisions(model: Model, flat: np.ndarray, mixed: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(places of the weights, sides, biases) of every fork on the way to the
    tokens, in their order, and the number of forks of each token."""
    known = np.minimum(flat, np.uint32(len(model.counts))).astype(np.int64)
    first = model.starts[known]
    size = model.starts[known + 1] - first
    token = np.repeat(np.arange(len(flat)), size)
    at = np.arange(len(token)) + np.repeat(first - (np.cumsum(size) - size), size)
    fork = model.forks[at]
    return place(mixed[:, token], fork, model.bits + DEEP), model.sides[at], model.lean[fork], size


def side_logs(deep: np.ndarray, at: np.ndarray, side: np.ndarray, lean: np.ndarray) -> np.ndarray:
    """ln P(side | features) of every fork."""
    y = deep.take(at[0])
    for a in at[1:]:
        y += deep.take(a)
    y = (y + lean) * (1 - 2 * side)
    return -np.logaddexp(np.float32(0), y)


def logits(model: Model, weights: np.ndarray, rows: np.ndarray) -> np.ndarray:
    """Logits of the classes, the largest of each token zero (tokens x classes)."""
    y = weights.take(rows[0], axis=0)
    for r in rows[1:]:
        y += weights.take(r, axis=0)
    y += model.bias
    y -= y.max(axis=1, keepdims=True)
    return y


def class_logs(model: Model, weights: np.ndarray, rows: np.ndarray, target: np.ndarray) -> np.ndarray:
    """ln P(target class | features) of every token."""
    y = logits(model, weights, rows)
    mine = y[np.arange(len(y)), target].astype(np.float64)
    return mine - np.log(np.exp(y, out=y).sum(axis=1))


_ENCODED = "struct<ids:binary,rare:array<struct<word:binary,n:int>>>"


def encode(docs: DataFrame, frequent: list[bytes]) -> DataFrame:
    """``docs`` with its text column ``body`` replaced by the ids of its
    tokens (32 bits each; any other word has a hash above the ids of the
    frequent words and the start token) and the list of its other words with how often they occur."""
    shared, tail = docs.sparkSession.sparkContext.broadcast(frequent), len(frequent)

    @F.arrow_udf(_ENCODED)
    def run(texts: Iterator[pa.Array]) -> Iterator[pa.Array]:
        ids = {w: k for k, w in enumerate(shared.value)}
        for batch in texts:
            out, rare_word, rare_n, ends = [], [], [], [0]
            for t in batch.to_pylist():
                tok = [*words(t), END]
                mine = np.fromiter(map(ids.get, tok, repeat(tail)), np.uint32, len(tok))
                at = np.flatnonzero(mine == tail)
                other = [tok[j] for j in at.tolist()]
                mine[at] = [tail + 2 + zlib.crc32(w) % (2**32 - tail - 2) for w in other]
                out.append(mine.tobytes())
                c = Counter(other)
                rare_word += c
                rare_n += c.values()
                ends.append(len(rare_word))
            items = pa.StructArray.from_arrays([pa.array(rare_word, pa.binary()), pa.array(rare_n, pa.int32())], ["word", "n"])
            yield pa.StructArray.from_arrays([pa.array(out, pa.binary()), pa.ListArray.from_arrays(pa.array(ends, pa.int32()), items)],
                                             ["ids", "rare"])

    return docs.select(*[c for c in docs.columns if c != "body"], run("body").alias("e")).select(
        *[c for c in docs.columns if c != "body"], "e.*")


def _tokens(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """(ids, number of tokens of each) of encoded texts."""
    return np.frombuffer(b"".join(texts), np.uint32), np.fromiter(map(len, texts), np.int64, len(texts)) // 4


def _slices(batch: pa.Array, most: int = 1 << 20) -> Iterator[list[bytes]]:
    """Texts of a batch in runs of about ``most`` bytes, whole texts each."""
    run, size = [], 0
    for t in batch.to_pylist():
        run.append(t)
        size += len(t)
        if size >= most:
            yield run
            run, size = [], 0
    if run:
        yield run


def _profiles(texts: DataFrame, model: Model) -> np.ndarray:
    """For every frequent word the sum, over its occurrences, of the profile
    of the document: its commonest words' shares in PROFILE hashed buckets."""
    tail = len(model.counts)

    def gather(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bucket = np.arange(256, dtype=np.uint32) * np.uint32(0x9E3779B1) >> np.uint32(29)
        total = np.zeros((tail + 1, PROFILE))
        for b in batches:
            for run in _slices(b.column(0)):
                flat, lengths = _tokens(run)
                flat = np.minimum(flat, np.uint32(tail))
                doc = np.repeat(np.arange(len(lengths)), lengths)
                common = flat < 256
                cell = doc[common] * PROFILE + bucket[flat[common]]
                shape = np.bincount(cell, minlength=len(lengths) * PROFILE).reshape(-1, PROFILE).astype(float)
                shape /= np.maximum(shape.sum(axis=1, keepdims=True), 1)
                for k in range(PROFILE):
                    total[:, k] += np.bincount(flat, weights=shape[doc, k], minlength=tail + 1)
        at = np.flatnonzero(total[:tail].any(axis=1))
        yield pa.RecordBatch.from_pydict({"id": pa.array(at.astype(np.int32)), **{f"s{k}": pa.array(total[at, k].astype(np.float32)) for k in range(PROFILE)}})

    schema = ", ".join(["id int", *(f"s{k} float" for k in range(PROFILE))])
    got = (texts.select("ids").mapInArrow(gather, schema).groupBy("id").agg(*(F.sum(f"s{k}").alias(f"s{k}") for k in range(PROFILE))).toPandas())
    out = np.zeros((tail, PROFILE))
    out[got["id"].to_numpy()] = got[[f"s{k}" for k in range(PROFILE)]].to_numpy()
    return out


def _cluster(points: np.ndarray, weight: np.ndarray, k: int, steps: int = 15) -> np.ndarray:
    """Weighted k-means from spread-out starts; deterministic."""
    centres = [points[int(np.argmax(weight))]]
    while len(centres) < min(k, len(points)):
        gap = np.min([((points - c) ** 2).sum(axis=1) for c in centres], axis=0)
        centres.append(points[int(np.argmax(gap * np.sqrt(weight)))])
    centres = np.array(centres)
    for _ in range(steps):
        own = np.argmin(((points[:, None, :] - centres[None]) ** 2).sum(axis=2), axis=1)
        for c in range(len(centres)):
            if (mine := own == c).any():
                centres[c] = np.average(points[mine], axis=0, weights=weight[mine])
    return own


def frequent_words(counts: DataFrame) -> tuple[list[bytes], np.ndarray]:
    """At most FREQUENT words (whole steps of frequency from the top) and
    their counts, the commonest first."""
    step = F.floor(8 * F.log2("c")).cast("int")  # at most 8 * 63 steps
    sizes = counts.groupBy(step.alias("step")).agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("step")).collect()
    least, room = None, FREQUENT
    for r in sizes:
        if r["n"] > room:
            break
        least, room = r["step"], room - r["n"]
    top = counts.where(step >= least).toPandas() if least is not None else counts.limit(0).toPandas()
    top["word"] = top["word"].map(bytes)
    top = top.sort_values(["c", "word"], ascending=[False, True])
    return top["word"].tolist(), top["c"].to_numpy(np.int64)


def _trees(classes: np.ndarray, c: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(starts, forks, sides, lean, below) of a Model: Huffman trees of the
    words of every class, from the classes of the frequent words and their
    counts; each word's LEARNED forks next to the root."""
    n = len(c)
    parent, side, lean = [0] * n, [0] * n, [0.0]  # fork 0 is none
    for k in range(1, CLASSES):
        heap = [(int(c[j]), j) for j in np.flatnonzero(classes[:n] == k).tolist()]
        heapq.heapify(heap)
        while len(heap) > 1:
            (x, a), (y, b) = heapq.heappop(heap), heapq.heappop(heap)
            parent[a] = parent[b] = new = len(parent)
            side[b] = 1
            parent.append(0)
            side.append(0)
            lean.append(math.log(y / x))
            heapq.heappush(heap, (x + y, new))
    up, way = np.array(parent, np.int64), np.array(side, np.float32)
    word, at, steps = np.arange(n), np.arange(n), []
    while len(word):  # one step up from every word not yet at a root
        go = up[at] > 0
        word, at = word[go], at[go]
        steps.append((word, up[at] - (n - 1), way[at]))
        at = up[at]
    owner, forks, sides = (np.concatenate(x) for x in zip(*steps)) if steps else (np.empty(0, np.int64),) * 3
    order = np.argsort(owner, kind="stable")  # of a word, from the bottom up
    owner, forks, sides = owner[order], forks[order].astype(np.uint32), sides[order].astype(np.float32)
    lean, depth = np.array(lean, np.float32), np.bincount(owner, minlength=n + 1)
    top = np.arange(len(owner)) >= (np.cumsum(depth) - LEARNED)[owner]
    log = -np.logaddexp(np.float32(0), lean[forks[~top]] * (1 - 2 * sides[~top]))
    below = np.bincount(owner[~top], log, n + 1)
    starts = np.concatenate(([0], np.cumsum(np.minimum(depth, LEARNED))))  # the tail has none
    return starts, forks[top], sides[top], lean, below


def row_bits(total: int) -> int:
    """A weight row for every 1,024 training tokens; each brings 2^DEEP weights of forks."""
    return min(max(BITS, (total // 1024).bit_length()), MOST_BITS)


def train(texts: DataFrame, c: np.ndarray, total: int, distinct: int) -> Model:
    """A model of the rows of ``texts`` (id, ids), the encoded training
    documents; c: counts of the frequent words; total, distinct: of all."""
    n = len(c)
    model = Model(c, total, distinct, np.zeros(n + 1, np.int64), np.zeros(n + 1), total - int(c.sum()),
                  distinct - n, np.zeros(CLASSES, np.float32), np.zeros((1 << row_bits(total), CLASSES), np.float32))
    classes = np.zeros(n + 1, np.int64)
    if n:
        classes[:n] = 1 + _cluster(_profiles(texts, model) / c[:, None], c.astype(float), CLASSES - 1)
    mass = np.bincount(classes[:n], weights=c, minlength=CLASSES)
    mass[0] = model.tail_total + SMOOTH * (model.tail_distinct + 1)
    within = np.zeros(n + 1)
    within[:n] = np.log(c / mass[classes[:n]])
    with np.errstate(divide="ignore"):
        bias = np.maximum(np.log(mass / max(mass.sum(), SMOOTH)), -60.0).astype(np.float32)  # classes without words
    starts, forks, sides, lean, below = _trees(classes, c)
    model = replace(model, classes=classes, within=within, bias=bias, starts=starts, forks=forks, sides=sides, lean=lean, below=below,
                    deep=np.zeros(len(model.weights) << DEEP, np.float32))
    for k in range(ROUNDS if n else 0):
        part = texts.where(F.pmod(F.xxhash64("id", F.lit("round")), F.lit(ROUNDS)) == k)
        weights, deep = _round(part, model)
        model = replace(model, weights=weights, deep=deep)
    return model


def learn(model: Model, weights: np.ndarray, squares: np.ndarray, visits: np.ndarray, rows: np.ndarray, target: np.ndarray) -> None:
    """One gradient step on some tokens, in place."""
    g = logits(model, weights, rows)
    np.exp(g, out=g)
    g /= g.sum(axis=1, keepdims=True)
    g[np.arange(len(g)), target] -= 1
    flat = rows.ravel()
    key = flat.astype(np.uint64) << np.uint64(32) | np.arange(len(flat), dtype=np.uint64)
    key.sort()
    order, line = (key & np.uint64(0xFFFFFFFF)).astype(np.int64), key >> np.uint64(32)
    first = np.flatnonzero(np.concatenate(([True], line[1:] != line[:-1])))
    at = line[first].astype(np.int64)
    order %= rows.shape[1]
    times = np.diff(np.append(first, len(flat)))
    total = g.take(order[first], axis=0)
    more = np.flatnonzero(times > 1)  # most rows occur once in a batch
    inside = np.repeat(times > 1, times)
    total[more] = np.add.reduceat(g.take(order[inside], axis=0), np.cumsum(times[more]) - times[more], axis=0) if len(more) else total[more]
    s = squares.take(at, axis=0)
    s += total * total
    squares[at] = s
    np.sqrt(s, out=s)
    np.divide(total, s, out=total)
    total *= STEP
    weights[at] = weights.take(at, axis=0) - total
    visits[at] += times


def learn_sides(deep: np.ndarray, squares: np.ndarray, at: np.ndarray, side: np.ndarray, lean: np.ndarray) -> None:
    """One gradient step on some forks, in place; the weights are visited in
    the order of their places."""
    flat = at.ravel()
    key = flat.astype(np.uint64) << np.uint64(32) | np.arange(len(flat), dtype=np.uint64)
    key.sort()
    order, line = (key & np.uint64(0xFFFFFFFF)).astype(np.int64), (key >> np.uint64(32)).astype(np.int64)
    first = np.flatnonzero(np.concatenate((np.ones(min(len(line), 1), bool), line[1:] != line[:-1])))
    place_ = line[first]
    mine, w = deep.take(place_), np.empty(len(flat), np.float32)
    w[order] = np.repeat(mine, np.diff(np.append(first, len(line))))
    g = 1 / (1 + np.exp(-(w.reshape(at.shape).sum(axis=0) + lean))) - side
    total = np.add.reduceat(g.take(order % len(side)), first)
    s = squares.take(place_) + total * total
    squares[place_] = s
    deep[place_] = mine - STEP * total / np.sqrt(s + 1)


def _round(texts: DataFrame, model: Model) -> tuple[np.ndarray, np.ndarray]:
    context = texts.sparkSession.sparkContext
    shared, tail = context.broadcast(model), len(model.counts)
    texts = texts.select("ids").coalesce(max(context.defaultParallelism, model.total // TASK_TOKENS))

    def local(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = shared.value
        w, deep = m.weights.copy(), m.deep.copy()
        squares, visits = np.full_like(w, 1.0), np.zeros(len(w))
        deep_squares = np.zeros_like(deep)
        for b in batches:
            for run in _slices(b.column(0)):
                flat, lengths = _tokens(run)
                for first, end, mixed in context_runs(flat, lengths, tail + 1):
                    part = flat[first:end]
                    target, rows = m.classes[np.minimum(part, np.uint32(tail))], place(mixed, np.uint32(0), m.bits)
                    for s in range(0, len(part), BATCH):
                        learn(m, w, squares, visits, rows[:, s:s + BATCH], target[s:s + BATCH])
                    at, side, lean, _ = decisions(m, part, mixed)
                    for s in range(0, len(side), FORKS):
                        learn_sides(deep, deep_squares, at[:, s:s + FORKS], side[s:s + FORKS], lean[s:s + FORKS])
        n = np.concatenate((np.repeat(visits, CLASSES), deep_squares)).astype(np.float32).reshape(-1, BLOCK)
        moved = np.concatenate(((w - m.weights).ravel(), deep - m.deep)).reshape(-1, BLOCK) * n
        for at in np.array_split(np.flatnonzero(n.any(axis=1)), 16):
            yield pa.RecordBatch.from_pydict({"block": pa.array(at.astype(np.int32)),
                                              "n": pa.array([n[k].tobytes() for k in at], pa.binary()),
                                              "moved": pa.array([moved[k].tobytes() for k in at], pa.binary())})

    def mean(tables: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, moved = np.zeros(BLOCK), np.zeros(BLOCK)
        for b in tables:
            for x, y in zip(b.column("n").to_pylist(), b.column("moved").to_pylist()):
                n += np.frombuffer(x, np.float32)
                moved += np.frombuffer(y, np.float32)
        change = np.divide(moved, n, out=np.zeros(BLOCK), where=n > 0).astype(np.float32)
        yield pa.RecordBatch.from_pydict({"block": b.column("block")[:1], "moved": pa.array([change.tobytes()], pa.binary())})

    got = (texts.mapInArrow(local, "block int, n binary, moved binary").groupBy("block")
           .applyInArrow(mean, "block int, moved binary").toArrow())  # at most the weights
    change = np.zeros(((model.weights.size + model.deep.size) // BLOCK, BLOCK), np.float32)
    for k, x in zip(got["block"].to_pylist(), got["moved"].to_pylist()):
        change[k] = np.frombuffer(x, np.float32)
    change = change.ravel()
    return model.weights + change[:model.weights.size].reshape(-1, CLASSES), model.deep + change[model.weights.size:]


_PART = "struct<n_tokens:bigint,n_known:bigint,base:double,score:double>"


def _partial(shared) -> Column:
    @F.arrow_udf(_PART)
    def run(texts: Iterator[pa.Array]) -> Iterator[pa.Array]:
        """Sums over frequent words, over classes and over forks."""
        m = shared.value
        tail = len(m.counts)
        base = np.append(m.base(m.counts), 0.0)
        for batch in texts:
            sums = defaultdict(list)
            for part in _slices(batch):
                flat, lengths = _tokens(part)
                logs = np.empty(len(flat))
                for first, end, mixed in context_runs(flat, lengths, tail + 1):
                    some = flat[first:end]
                    known = np.minimum(some, np.uint32(tail))
                    target, rows = m.classes[known], place(mixed, np.uint32(0), m.bits)
                    for s in range(0, len(some), BATCH):
                        logs[first + s:first + min(s + BATCH, len(some))] = class_logs(m, m.weights, rows[:, s:s + BATCH], target[s:s + BATCH])
                    places, side, lean, size = decisions(m, some, mixed)
                    ways = np.append(side_logs(m.deep, places, side, lean), np.float32(0))
                    logs[first:end] += m.below[known] + np.where(size > 0, np.add.reduceat(ways, np.cumsum(size) - size), 0.0)
                at = np.concatenate(([0], np.cumsum(lengths)[:-1]))
                sums["score"].append(np.add.reduceat(logs, at) / math.log(10))
                flat = np.minimum(flat, np.uint32(tail))
                sums["base"].append(np.add.reduceat(base[flat], at))
                sums["known"].append(np.add.reduceat((flat < tail).astype(np.int64), at))
                sums["n"].append(lengths)
            n, known, b, s = (np.concatenate(sums[x]) if sums[x] else np.empty(0) for x in ("n", "known", "base", "score"))
            yield pa.StructArray.from_arrays([pa.array(n, pa.int64()), pa.array(known, pa.int64()), pa.array(b, pa.float64()),
                                              pa.array(s, pa.float64())], ["n_tokens", "n_known", "base", "score"])

    return run(F.col("ids"))


def score_table(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, held_out, n_tokens, n_known, train_tokens, base_score, score), a
    row for every row of ``docs``.

    Training documents are those whose crc32(id as text) mod 10 is not 0; a
    null id counts as one of them.  Null texts count as empty: one end token.
    Repeated rows are counted and scored as often as they stand.  An empty
    table gives an empty result; other columns are not read."""
    held = F.coalesce(crc_mod(id_col, 10) == 0, F.lit(False))
    rows = docs.select(F.col(id_col).alias("id"), held.alias("held_out"), text_bytes(text_col).alias("body"))
    counts = stored(word_counts(rows.where(~F.col("held_out"))), "lm-counts")
    total, distinct = counts.agg(F.coalesce(F.sum("c"), F.lit(0)), F.count(F.lit(1))).first()
    frequent, c = frequent_words(counts)
    encoded = stored(encode(rows, frequent).withColumn("row", F.monotonically_increasing_id()), "lm-encoded")
    model = train(encoded.where(~F.col("held_out")), c, total, distinct)
    shared = docs.sparkSession.sparkContext.broadcast(model)
    parts = encoded.select("id", "held_out", "row", _partial(shared).alias("p")).select("id", "held_out", "row", "p.*")
    # rare words: their counts come by a join; the row numbers are those written
    rare = encoded.select("row", F.explode("rare").alias("x")).select("row", "x.word", "x.n").join(counts, "word", "left")
    c, n = F.coalesce("c", F.lit(0)), F.col("n")
    whole = model.total + SMOOTH * (model.distinct + 1)
    tail = model.tail_total + SMOOTH * (model.tail_distinct + 1)
    more = rare.groupBy("row").agg(F.sum(n * F.log10((c + SMOOTH) / whole)).alias("more_base"),
                                   F.sum(n * F.log10((c + SMOOTH) / tail)).alias("more_score"),
                                   F.sum(F.when(c > 0, n).otherwise(0)).alias("more_known"))
    out = parts.join(more, "row", "left")
    zero = F.lit(0.0)
    return out.select(F.col("id").alias(id_col), "held_out", "n_tokens",
                      (F.col("n_known") + F.coalesce("more_known", F.lit(0))).cast("long").alias("n_known"),
                      F.lit(model.total).cast("long").alias("train_tokens"),
                      (F.col("base") + F.coalesce("more_base", zero)).alias("base_score"),
                      (F.col("score") + F.coalesce("more_score", zero)).alias("score"))

"""SimHash near-duplicate detection with a generalised pigeonhole search.

A document's words (A-Z lower-cased) are cut into word shingles, each shingle
is hashed with XXH64, and bit b of the 64-bit fingerprint is set when more
than half of the hashes have it.  Fingerprints link when they differ in at
most ``max_bits`` bits; a document's component is the set of documents that
such links reach.

Search.  The 64 bits are dealt to m parts of correlated bits, and part i gets
a threshold T_i >= -1 with sum(T_i) = max_bits - m + 1.  Two fingerprints
within max_bits must then agree within T_i bits on some part i: otherwise they
would differ in at least sum(T_i + 1) = max_bits + 1 bits.  The partition and
the thresholds are those of the least estimated cost: a dynamic programme over
the parts weighs the keys that a threshold needs against the comparisons that
it is expected to cause.  The estimates come from statistics of every distinct
fingerprint (bit co-occurrence, histograms of part values).  A part with
threshold e is probed with one key for every choice of e of its bits to be
left out, so that two fingerprints share a key iff they agree within e bits.

Each key's group is compared exactly.  Hot groups are split in blocks, and a
group gives a spanning forest of its links, never all pairs.
"""

from __future__ import annotations

import itertools
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from xxhash import xxh64_intdigest

from .common import components, forest, map_groups, runs, split_hot, stored, text_bytes

BITS = 64
SEED = 42
BLOCK = 2048          # most members of a group that meet without a split
KEY_COST = 1.0        # of one key row, against
COMPARE_COST = 0.005  # one comparison of two fingerprints
MOST_KEYS = 600       # keys of one part, as they are written out in the plan


# -- fingerprints -----------------------------------------------------------

def shingle_hashes(text: bytes, words: int) -> np.ndarray:
    w = text.lower().split()  # bytes: A-Z, and the six ASCII blanks
    if not w:
        return np.empty(0, np.uint64)
    if len(w) <= words:
        return np.array([xxh64_intdigest(b" ".join(w), SEED)], np.uint64)
    n = len(w) - words + 1
    parts = zip(*(itertools.islice(w, k, None) for k in range(words)))
    return np.fromiter((xxh64_intdigest(b" ".join(p), SEED) for p in parts), np.uint64, n)


def fingerprint(hashes: np.ndarray, chunk: int = 1 << 15) -> int:
    """Majority of every bit; zero without hashes."""
    ones = np.zeros(BITS, np.int64)
    for s in range(0, len(hashes), chunk):
        part = np.ascontiguousarray(hashes[s:s + chunk]).view(np.uint8).reshape(-1, 8)
        ones += np.unpackbits(part, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > len(hashes), bitorder="little").view(np.uint64)[0])


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = 3) -> DataFrame:
    """(id, fp long: the 64 bits as a signed number) of every row."""
    @F.arrow_udf("long")
    def fp(texts: pa.Array) -> pa.Array:
        out = np.fromiter((fingerprint(shingle_hashes(t, words)) for t in texts.to_pylist()), np.uint64, len(texts))
        return pa.array(out.view(np.int64))

    return docs.select(F.col(id_col).alias("id"), fp(text_bytes(text_col)).alias("fp"))


# -- statistics and plan of the search --------------------------------------

def bit_statistics(fps: DataFrame) -> tuple[int, np.ndarray]:
    """(number of fingerprints, 64 x 64 matrix: how many have both bits set)."""
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, both = 0, np.zeros((BITS, BITS), np.int64)
        for b in batches:
            fp = np.ascontiguousarray(b.column(0).to_numpy(zero_copy_only=False))
            x = np.unpackbits(fp.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").astype(np.float32)
            for s in range(0, len(x), 1 << 16):  # float32 counts exactly up to 2^24
                part = x[s:s + (1 << 16)]
                both += (part.T @ part).astype(np.int64)
            n += len(x)
        if n:
            i = np.arange(BITS * BITS + 1)
            yield pa.RecordBatch.from_pydict({"cell": pa.array(i), "n": pa.array(np.append(both.ravel(), n))})

    got = fps.select("fp").mapInArrow(count, "cell long, n long").groupBy("cell").agg(F.sum("n").alias("n")).collect()
    flat = np.zeros(BITS * BITS + 1, np.int64)  # a matrix of fixed size, whatever the input
    for r in got:
        flat[r["cell"]] = r["n"]
    return int(flat[-1]), flat[:-1].reshape(BITS, BITS)


def correlated_parts(n: int, both: np.ndarray, m: int) -> list[list[int]]:
    """The 64 bits in m parts of (nearly) equal size, bits of high absolute
    correlation together: each part starts with the free bit that is most
    correlated with other free bits and takes its strongest partners."""
    p = np.diag(both) / max(n, 1)
    cov = both / max(n, 1) - np.outer(p, p)
    sd = np.sqrt(np.maximum(p * (1 - p), 1e-12))
    corr = np.abs(cov / np.outer(sd, sd))
    np.fill_diagonal(corr, 0)
    free, parts = list(range(BITS)), []
    for k in range(m):
        size = len(free) // (m - k)
        part = [max(free, key=lambda b: (corr[b, free].sum(), -b))]
        while len(part) < size:
            part.append(max((b for b in free if b not in part), key=lambda b: (corr[b, part].sum(), -b)))
        free = [b for b in free if b not in part]
        parts.append(sorted(part))
    return parts


def mask(bits) -> int:
    return sum(1 << b for b in bits)


def signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def keys_needed(bits: int, e: int) -> float:
    if e < 0:
        return 0
    n = math.comb(bits, e)
    return n if n <= MOST_KEYS else math.inf


def expected_compares(same: float, ratio: np.ndarray, bits: int, e: int) -> float:
    """Comparisons over all keys of a part with threshold e: a pair that
    differs in h bits of the part shares C(bits - h, e - h) of the keys; same:
    pairs equal on the part; ratio[h]: estimated pairs at distance h for each
    equal pair."""
    return 0.0 if e < 0 else same * sum(ratio[h] * math.comb(bits - h, e - h) for h in range(e + 1))


def distance_ratios(p: np.ndarray, part: list[int], most: int) -> np.ndarray:
    """P(distance h) / P(distance 0) on the part for h up to most, bits taken
    as independent with the chances p of a one."""
    d = 2 * p[part] * (1 - p[part])
    odds = d / np.maximum(1 - d, 1e-9)
    r = np.zeros(most + 1)
    r[0] = 1
    for o in odds:
        r[1:] += r[:-1] * o
    return r


def allocate(costs: list[list[float]], total: int) -> tuple[float, list[int]]:
    """Thresholds T_i >= -1 of the given sum with the least cost; costs[i][e + 1]
    is the cost of threshold e on part i.  Dynamic programme over the parts."""
    best: dict[int, tuple[float, list[int]]] = {0: (0.0, [])}
    for row in costs:
        step: dict[int, tuple[float, list[int]]] = {}
        for s, (c, chosen) in best.items():
            for k, v in enumerate(row):
                if (t := s + k - 1) not in step or c + v < step[t][0]:
                    step[t] = (c + v, [*chosen, k - 1])
        best = step
    return best[total]


def plan(fps: DataFrame, max_bits: int) -> list[tuple[list[int], int]]:
    """(bits, threshold) of the parts to probe, for distinct fingerprints."""
    n, both = bit_statistics(fps)
    p = np.diag(both) / max(n, 1)
    layouts = {m: correlated_parts(n, both, m) for m in range(min(2, max_bits + 1), max_bits + 2)}
    named = [(m, k, part) for m, parts in layouts.items() for k, part in enumerate(parts) if len(part) < BITS]
    equal: dict[tuple[int, int], float] = {}
    if named:
        rows = F.explode(F.array(*[F.struct(F.lit(i).alias("i"), F.col("fp").bitwiseAND(F.lit(signed(mask(part)))).alias("v"))
                                   for i, (_, _, part) in enumerate(named)])).alias("x")
        pairs = (fps.select(rows).groupBy("x.i", "x.v").agg(F.count(F.lit(1)).cast("double").alias("c"))
                 .groupBy("i").agg(F.sum(F.expr("c * (c - 1) / 2")).alias("pairs")).collect())
        equal = {named[r["i"]][:2]: r["pairs"] for r in pairs}  # a row for each part
    best = None
    for m, parts in layouts.items():
        costs = []
        for k, part in enumerate(parts):
            ratio = distance_ratios(p, part, max_bits)
            costs.append([KEY_COST * max(n, 1) * keys_needed(len(part), e)
                          + COMPARE_COST * expected_compares(equal.get((m, k), 0.0), ratio, len(part), e)
                          for e in range(-1, max_bits + 1)])
        cost, chosen = allocate(costs, max_bits - m + 1)
        if best is None or cost < best[0]:
            best = (cost, [(part, t) for part, t in zip(parts, chosen, strict=True) if t >= 0])
    return best[1]


# -- links and components ---------------------------------------------------

def probe_masks(parts: list[tuple[list[int], int]]) -> list[int]:
    """The bits that each key keeps."""
    return [mask(set(part) - set(out)) for part, t in parts for out in itertools.combinations(part, t)]


def compare(max_bits: int, step: int = 512):
    """Links within each group of candidate fingerprints, as a forest."""
    def near(t: pa.Table) -> Iterator[pa.RecordBatch]:
        grp = t.column("grp").to_numpy()
        fps = t.column("fp").to_numpy()
        side, same = t.column("side").to_numpy(), t.column("same").to_numpy()
        out_a, out_b = [], []
        for s, e in runs(grp):
            u = fps[s:e].view(np.uint64)
            rows = np.arange(e - s) if same[s] else np.flatnonzero(side[s:e] == 0)
            cols = np.arange(e - s) if same[s] else np.flatnonzero(side[s:e] == 1)
            hit_i, hit_j = [], []
            for k in range(0, len(rows), step):
                i, j = np.nonzero(np.bitwise_count(u[rows[k:k + step], None] ^ u[None, cols]) <= max_bits)
                i, j = rows[k:k + step][i], cols[j]
                keep = i != j
                hit_i.append(i[keep])
                hit_j.append(j[keep])
            i, j = (np.concatenate(x) if x else np.empty(0, np.int64) for x in (hit_i, hit_j))
            if len(i):
                root = forest(e - s, i, j)
                tied = np.flatnonzero(root != np.arange(e - s))
                out_a.append(fps[s:e][tied])
                out_b.append(fps[s:e][root[tied]])
        if out_a:
            yield pa.RecordBatch.from_pydict({"a": pa.array(np.concatenate(out_a)), "b": pa.array(np.concatenate(out_b))})
    return near


def near_groups(fps: DataFrame, max_bits: int = 3, block: int = BLOCK) -> DataFrame:
    """(fp, root) for distinct fingerprints that links tie to a smaller one."""
    parts = plan(fps, max_bits)
    keys = F.explode(F.array(*[F.xxhash64(F.lit(q), F.col("fp").bitwiseAND(F.lit(signed(m))))
                               for q, m in enumerate(probe_masks(parts))]))
    probes = split_hot(fps.select("fp", keys.alias("key")), "key", F.col("fp"), block, "simhash-hot")
    links = map_groups(probes.select("grp", "fp", "side", "same"), "grp", compare(max_bits), "a long, b long")
    return components(links, "simhash-links").select(F.col("node").alias("fp"), "root")


def simhash_components(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = 3,
                       max_bits: int = 3, block: int = BLOCK) -> DataFrame:
    """(id, fingerprint, component_id, kept), a row for every row of ``docs``.

    ``words``: shingle length; fewer words make one shingle; a null or empty
    text, or one of blanks only, has fingerprint zero and links like any
    other.  component_id is the smallest id that links reach, kept whether the
    id is that one.  Null ids: the row gets the component's smallest id (null
    if it has none) and is kept.  Repeated rows give repeated results.  An
    empty table gives an empty result; other columns are not read."""
    if not 0 <= max_bits < BITS:
        raise ValueError("max_bits must be from 0 to 63")
    rows = stored(fingerprints(docs, id_col, text_col, words), "simhash-fps")
    own = stored(rows.groupBy("fp").agg(F.min("id").alias("first")), "simhash-own")
    tied = stored(near_groups(own.select("fp"), max_bits, block), "simhash-tied")
    rooted = own.join(tied, "fp", "left").select("fp", "first", F.coalesce("root", "fp").alias("root"))
    least = rooted.groupBy("root").agg(F.min("first").alias("component_id"))
    found = rooted.join(least, "root").select("fp", "component_id")
    return rows.join(found, "fp").select(
        F.col("id").alias(id_col), F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id",
        F.coalesce(F.col("id") == F.col("component_id"), F.lit(True)).alias("kept"))


def drop_near_duplicates(docs: DataFrame, words: int = 3, max_bits: int = 3) -> DataFrame:
    """The documents without those that have a kept near copy: of each
    component the one with the smallest doc_id stays, in one row; rows with a
    null doc_id stay."""
    found = stored(simhash_components(docs, words=words, max_bits=max_bits)
                   .where("doc_id is not null").select("doc_id", "kept"), "simhash-kept")
    gone = found.where("not kept").select("doc_id").distinct()
    left = docs.join(gone, "doc_id", "left_anti").select(*docs.columns)
    again = stored(found.where("kept").groupBy("doc_id").count().where("count > 1").select("doc_id"), "simhash-again")
    if not again.count():
        return left
    once = left.join(again, "doc_id", "left_semi").select(*docs.columns).dropDuplicates(["doc_id"])
    return left.join(again, "doc_id", "left_anti").select(*docs.columns).unionByName(once)

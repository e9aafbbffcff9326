"""Phrase collocations: n-grams that occur far more often than their parts.

Every task cuts its texts into shards of bounded size and builds a
bidirectional FM-index over the word ids of each (see fm_index).  Extending
intervals enumerates a shard's n-grams with their counts and how many of their
occurrences have a word to the left and to the right; sums over the shards,
by Spark, are those of the whole corpus.  A text longer than a shard goes on
in the next one: its last words stand in both, and what lies wholly inside
that overlap is subtracted once.

A phrase can be frequent only if the phrases inside it are.  So the lengths
are taken one after another: the hashes of all n-grams of a length are summed,
those that are frequent set bits of a filter of bounded size (FILTER_BITS at
most, which is all that is broadcast), and longer n-grams are enumerated only
over those in the filter.  A full filter lets more through, which the final
exact counts drop: it costs time, never rows.
"""

from __future__ import annotations

import re
from collections import defaultdict
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import stored, text_bytes
from .fm_index import FMIndex, Grams

SHARD = 1 << 22        # bytes of a shard, about
SEGMENT = 1 << 20      # bytes of a text taken at once
FILTER_BITS = 27       # log2 of the bits of a filter, at most

_PIECES = bytes.maketrans(b",;:!?\n\x0b\x0c\r", b"." * 9)
_CUT = re.compile(rb"[ \t.,;:!?\n\x0b\x0c\r]")


def plain(text: bytes) -> bytes:
    """A text with A-Z lower-cased and b"." for every end of a piece, blanks around it."""
    return text.lower().translate(_PIECES).replace(b".", b" . ")


def words(text: bytes) -> list[bytes]:
    return plain(text).split()


def segments(text: bytes) -> Iterator[bytes]:
    """A text in runs of about SEGMENT bytes, never cut inside a word."""
    start = 0
    while start < len(text):
        cut = _CUT.search(text, start + SEGMENT)
        end = cut.start() if cut else len(text)
        yield text[start:end]
        start = end


def blank_split(text: bytes) -> pa.Array:
    """The words of a text as Arrow strings, split in one pass."""
    if not text:
        return pa.array([], pa.binary())
    whole = pa.Array.from_buffers(pa.string(), 1, [None, pa.py_buffer(np.array([0, len(text)], np.int32)), pa.py_buffer(text)])
    out = pc.ascii_split_whitespace(whole).flatten().view(pa.binary())
    blank = len(out) > 0 and out[0].as_py() == b"", len(out) > 1 and out[-1].as_py() == b""  # before and after the blanks at the ends
    return out[int(blank[0]):len(out) - int(blank[1])]


@dataclass(frozen=True)
class Shard:
    """Word ids from 1 (0: end of a piece), by group; what they stand for."""
    seq: np.ndarray
    word: pa.Array      # of every id, that of 0 empty
    group: np.ndarray   # of every id, its place in groups
    groups: list[str]
    sign: int           # -1: its n-grams are subtracted

    @classmethod
    def of(cls, texts: dict[str, list[bytes]], sign: int) -> Shard:
        parts, word, group, known = [np.zeros(1, np.int64)], [pa.array([b""], pa.binary())], [np.zeros(1, np.int64)], 1
        for k, (g, some) in enumerate(texts.items()):
            found = blank_split(plain(b". ".join(some))).dictionary_encode()
            ids = found.indices.to_numpy().astype(np.int64)
            end = pc.index(found.dictionary, pa.scalar(b".", pa.binary())).as_py()
            seq = ids + known
            if end >= 0:
                seq[ids == end] = 0
            parts += seq, np.zeros(1, np.int64)
            word.append(found.dictionary)
            group.append(np.full(len(found.dictionary), k))
            known += len(found.dictionary)
        seq = np.concatenate(parts)
        seq = seq[np.append(True, (seq[1:] > 0) | (seq[:-1] > 0))]  # one separator is enough
        return cls(seq, pa.concat_arrays(word), np.concatenate(group), list(texts), sign)


def shards(batches: Iterator[pa.RecordBatch], depth: int) -> Iterator[Shard]:
    """The texts (columns grp, body) of a task.  A long text goes on in
    another segment after its last words, which are subtracted."""
    texts, again, size = defaultdict(list), defaultdict(list), 0
    for b in batches:
        for group, body in zip(b.column("grp").to_pylist(), b.column("body")):
            body, before = body.as_py(), b""
            for segment in segments(body):
                if before:
                    again[group].append(before)
                    segment = before + b" " + segment
                texts[group].append(segment)
                size += len(segment)
                if len(body) > SEGMENT:
                    last = words(segment)[-depth:]
                    before = b" ".join(last[max((k + 1 for k, w in enumerate(last) if w == b"."), default=0):])
                if size >= SHARD:
                    yield Shard.of(texts, 1)
                    if again:
                        yield Shard.of(again, -1)
                    texts, again, size = defaultdict(list), defaultdict(list), 0
    if texts:
        yield Shard.of(texts, 1)
    if again:
        yield Shard.of(again, -1)


def rotated(h: np.ndarray, by: int) -> np.ndarray:
    by %= 64
    return h << np.uint64(by) | h >> np.uint64(64 - by) if by else h


def word_hashes(shard: Shard) -> np.ndarray:
    """A hash of every word and group: the sum of a mixed number for each
    byte and its place."""
    offsets = np.frombuffer(shard.word.buffers()[1], np.int32)[shard.word.offset:shard.word.offset + len(shard.word) + 1].astype(np.int64)
    data = np.frombuffer(shard.word.buffers()[2], np.uint8)[offsets[0]:offsets[-1]].astype(np.uint64)
    size = np.diff(offsets)
    place = np.arange(len(data)) - np.repeat(offsets[:-1] - offsets[0], size)
    total = np.concatenate((np.zeros(1, np.uint64), np.cumsum(mixed(data + (place.astype(np.uint64) << np.uint64(8)) + np.uint64(1)))))
    own = total[offsets[1:] - offsets[0]] - total[offsets[:-1] - offsets[0]]
    seeds = np.array([xxhash.xxh64_intdigest(g.encode()) for g in shard.groups], np.uint64)
    return mixed(own ^ seeds[shard.group])


def mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ x >> np.uint64(30)) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ x >> np.uint64(27)) * np.uint64(0x94D049BB133111EB)
    return x ^ x >> np.uint64(31)


def gram_hashes(ids: np.ndarray, of_word: np.ndarray) -> np.ndarray:
    """A hash of every n-gram: its words', each rotated by its place."""
    out = of_word[ids[0]]
    for k in range(1, len(ids)):
        out = out ^ rotated(of_word[ids[k]], 17 * k)
    return out


def in_filter(bits: np.ndarray, h: np.ndarray) -> np.ndarray:
    mask = np.uint64(len(bits) * 64 - 1)
    out = np.ones(len(h), bool)
    for at in (h & mask, h >> np.uint64(32) & mask):
        out &= (bits[(at >> np.uint64(6)).astype(np.int64)] >> (at & np.uint64(63)) & np.uint64(1)).astype(bool)
    return out


def keeper(of_word: np.ndarray, filters: list[np.ndarray]) -> Callable[[np.ndarray], np.ndarray]:
    """Which n-grams pass: all their parts of each length are in its filter."""
    def keep(ids: np.ndarray) -> np.ndarray:
        out = np.ones(ids.shape[1], bool)
        for n, bits in enumerate(filters, 1):
            for s in range(len(ids) - n + 1):
                at = np.flatnonzero(out)
                out[at] = in_filter(bits, gram_hashes(ids[s:s + n, at], of_word))
        return out

    return keep


def _hash_counts(texts: DataFrame, n: int, filters: list[Broadcast]) -> DataFrame:
    """(h, c): the hashes of the n-grams of n words whose parts pass."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for shard in shards(batches, n):
            of_word = word_hashes(shard)
            *_, grams = FMIndex(shard.seq, n).ngrams(n, keeper(of_word, [f.value for f in filters]))
            yield pa.RecordBatch.from_pydict({"h": pa.array(gram_hashes(grams.ids, of_word).view(np.int64)),
                                              "c": pa.array(shard.sign * grams.size.astype(np.int64))})

    return texts.mapInArrow(run, "h long, c long").groupBy("h").agg(F.sum("c").alias("c"))


def _filter(hashes: DataFrame) -> np.ndarray:
    """The filter of the hashes of column h: two bits for each, 16 bits of
    room and more, up to 2^FILTER_BITS.  Only its words reach the driver."""
    hashes = stored(hashes.select("h"), "phrase-hashes")
    bits = min(max(16, (16 * hashes.count()).bit_length()), FILTER_BITS)
    at = hashes.select(F.explode(F.array(F.col("h"), F.shiftrightunsigned("h", 32))).alias("h")).select(
        F.col("h").bitwiseAND(F.lit((1 << bits) - 1)).alias("at"))
    got = at.groupBy(F.shiftright("at", 6).alias("word")).agg(
        F.bit_or(F.expr("shiftleft(1L, cast(at & 63 AS int))")).alias("set")).toArrow()
    out = np.zeros(1 << bits - 6, np.uint64)
    out[got["word"].to_numpy()] = got["set"].to_numpy().view(np.uint64)
    return out


def _gram_counts(texts: DataFrame, depth: int, filters: list[Broadcast]) -> DataFrame:
    """(grp, phrase, words, c, with_left, with_right) of the n-grams of up to
    ``depth`` words that pass, and the number of all words as that of the
    phrase without words."""
    def rows(shard: Shard, group: np.ndarray, parts: list[pa.Array], *counts: np.ndarray) -> pa.RecordBatch:
        phrase = pc.binary_join_element_wise(*parts, b" ") if len(parts) > 1 else parts[0]
        names = pa.array(shard.groups, pa.string()).take(pa.array(group))
        return pa.RecordBatch.from_pydict({
            "grp": names, "phrase": phrase, "words": pa.array(np.full(len(group), len(parts) if len(phrase) and parts[0][0].as_py() else 0, np.int32)),
            **{k: pa.array(shard.sign * x.astype(np.int64)) for k, x in zip(("c", "with_left", "with_right"), counts)}})

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for shard in shards(batches, depth):
            of_word, index = word_hashes(shard), FMIndex(shard.seq, depth)
            counts = np.pad(index.counts, (0, len(shard.word) - len(index.counts)))
            total = np.bincount(shard.group[1:], weights=counts[1:], minlength=len(shard.groups))
            none = np.zeros(len(total))
            yield rows(shard, np.arange(len(total)), [pa.array([b""] * len(total), pa.binary())], total, none, none)
            for grams in index.ngrams(depth, keeper(of_word, [f.value for f in filters])):
                parts = [shard.word.take(pa.array(k)) for k in grams.ids]
                yield rows(shard, shard.group[grams.ids[0]], parts, grams.size, *index.neighbours(grams))

    schema = "grp string, phrase binary, words int, c long, with_left long, with_right long"
    return (texts.mapInArrow(run, schema).groupBy("grp", F.col("phrase").cast("string").alias("phrase"), "words")
            .agg(*(F.sum(x).alias(x) for x in ("c", "with_left", "with_right"))))


def phrase_counts(docs: DataFrame, text_col: str = "text", group_col: str = "lang", most_words: int = 3, least: int = 10) -> DataFrame:
    """(grp, phrase, words, c, with_left, with_right): every phrase of 1 to
    ``most_words`` words that occurs at least ``least`` times in its group, how
    often it does, and how often a word stands to its left and to its right in
    the same piece; and for each group a row of no words (phrase empty) whose c
    counts all word occurrences.

    Texts are cut at ``.,;:!?`` and line ends into pieces, pieces at blanks and
    tabs into words, A-Z lower-cased.  A null group is ``und``, a null text
    empty; rows that repeat count as often as they stand."""
    texts = docs.select(F.coalesce(F.col(group_col).cast("string"), F.lit("und")).alias("grp"), text_bytes(text_col).alias("body"))
    context, filters = docs.sparkSession.sparkContext, []
    for n in range(1, most_words + 1):
        filters.append(context.broadcast(_filter(_hash_counts(texts, n, filters).where(F.col("c") >= least))))
    return _gram_counts(texts, most_words, filters).where((F.col("words") == 0) | (F.col("c") >= least))


def cut_score(a: str, left: str, right: str) -> Column:
    """floor(10^6 a^2 / (l r)) in decimals of 38 digits; counts up to 10^15."""
    a, left, right = (f"cast({x} AS decimal(15,0))" for x in (a, left, right))
    return F.expr(f"(1000000 * ({a} * {a})) div ({left} * {right})")


def collocations(docs: DataFrame, text_col: str = "text", group_col: str = "lang", most_words: int = 3, least: int = 10,
                 covered: int = 50, top: int = 2000) -> DataFrame:
    """(group, rank, phrase, a, l, r, n, score, with_left, with_right): the
    ``top`` phrases of 2 to ``most_words`` words of each group, by score, a
    (both falling) and phrase.

    a counts the phrase, l and r the parts of its lowest-scoring cut (of equal
    scores the first), n all words of the group.  Phrases inside a longer
    candidate that has at least ``covered`` percent of their occurrences are
    left out.  Groups without a candidate have no row; an empty table gives an
    empty result."""
    counts = stored(phrase_counts(docs, text_col, group_col, most_words, least), "phrases")
    known = counts.select("grp", "phrase", "c")
    total = counts.where("words = 0").select("grp", F.col("c").alias("n"))
    found = None
    for size in range(2, most_words + 1):
        mine = counts.where(F.col("words") == size).select("grp", "phrase", F.col("c").alias("a"), "with_left", "with_right")
        for k in range(1, size):
            for name, part in ((f"l{k}", F.substring_index("phrase", " ", k)), (f"r{k}", F.substring_index("phrase", " ", k - size))):
                mine = mine.withColumn("part", part).join(
                    known.select("grp", F.col("phrase").alias("part"), F.col("c").alias(name)), ["grp", "part"]).drop("part")
        cuts = [F.struct(cut_score("a", f"l{k}", f"r{k}").alias("score"), F.lit(k).alias("k"), F.col(f"l{k}").alias("l"),
                         F.col(f"r{k}").alias("r")) for k in range(1, size)]
        mine = mine.withColumn("cut", F.least(*cuts) if size > 2 else cuts[0])
        if size < most_words:
            inside = F.array(F.substring_index("phrase", " ", size), F.substring_index("phrase", " ", -size))
            longer = (counts.where(F.col("words") == size + 1).select("grp", "c", F.explode(inside).alias("phrase"))
                      .groupBy("grp", "phrase").agg(F.max("c").alias("longest")))
            mine = mine.join(longer, ["grp", "phrase"], "left").where(
                F.col("longest").isNull() | (100 * F.col("longest") < covered * F.col("a")))
        mine = mine.select("grp", "phrase", "a", "cut.l", "cut.r", "cut.score", "with_left", "with_right")
        found = mine if found is None else found.unionByName(mine)
    order = Window.partitionBy("grp").orderBy(F.desc("score"), F.desc("a"), "phrase")
    best = found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top)
    return best.join(total, "grp").select(F.col("grp").alias(group_col), F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r",
                                          "n", F.col("score").cast("long").alias("score"), "with_left", "with_right")

"""Benchmark decontamination by Wu-Manber multi-pattern search over words.

Patterns are the benchmark's windows: every run of ``width`` consecutive words
of an item, or the whole item if it is shorter.  Texts are searched for all
patterns of one length together.  The shift table holds, for blocks of two
words (one word for patterns of one word), how far the search may jump when a
text position ends in that block: the least distance of the block from the end
of any pattern; a block that no pattern has allows the longest jump.  Where
the shift is zero the suffix bucket of the block names the patterns that end
in it, and direct comparison of their words confirms an occurrence.

The benchmark is a query set: it is taken in blocks of at most
``patterns_per_block`` patterns, each broadcast in turn, so what is broadcast
stays bounded however large the benchmark is.  Documents are neither shuffled
nor grouped.
"""

from __future__ import annotations

import hashlib
from collections import defaultdict
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import text_bytes

WIDTH = 10
PATTERNS_PER_BLOCK = 500_000

# Bytes of words: digits, a-z (A-Z lower-cased), every byte of a non-ASCII character.
_FOLD = bytes(b + 32 if 0x41 <= b <= 0x5A else b if 0x30 <= b <= 0x39 or 0x61 <= b <= 0x7A or b >= 0x80 else 0x20
              for b in range(256))


def words(text: bytes) -> list[bytes]:
    return text.translate(_FOLD).split()


class WuManber:
    """Search for patterns of one length: tuples of words, each with the items
    that have it."""

    def __init__(self, patterns: dict[tuple[bytes, ...], frozenset[str]], length: int):
        self.length, self.block = length, min(2, length)
        self.jump = length - self.block + 1
        self.shift: dict = {}
        self.bucket: dict = defaultdict(list)
        for p, items in patterns.items():
            for end in range(self.block, length + 1):
                key = p[end - self.block:end]
                self.shift[key] = min(self.shift.get(key, self.jump), length - end)
            self.bucket[p[-self.block:]].append((list(p), items))

    def search(self, w: list[bytes], mark: bytearray, items: set[str]) -> None:
        """Mark the words of every occurrence, add the items that occur."""
        m, n, jump, get = self.length, len(w), self.jump, self.shift.get
        end = m
        if self.block == 1:
            for k, x in enumerate(w):
                if get((x,)) == 0:
                    mark[k] = 1
                    for _, its in self.bucket[(x,)]:
                        items |= its
            return
        while end <= n:
            s = get((w[end - 2], w[end - 1]), jump)
            if s:
                end += s
                continue
            at = w[end - m:end]
            for p, its in self.bucket[(w[end - 2], w[end - 1])]:
                if p == at:
                    mark[end - m:end] = b"\1" * m
                    items |= its
            end += 1


def windows(w: list[bytes], width: int) -> set[tuple[bytes, ...]]:
    if not w:
        return set()
    return {tuple(w[k:k + width]) for k in range(max(1, len(w) - width + 1))}


def pattern_blocks(benchmark: DataFrame, item_col: str, text_col: str, width: int, most: int) -> Iterator[list[WuManber]]:
    """Searchers for the benchmark, at most ``most`` patterns (and one item)
    at a time.  Items stream to the driver one partition at a time."""
    def build(found: dict) -> list[WuManber]:
        by_length = defaultdict(dict)
        for p, items in found.items():
            by_length[len(p)][p] = frozenset(items)
        return [WuManber(ps, length) for length, ps in sorted(by_length.items())]

    found: dict[tuple[bytes, ...], set[str]] = {}
    rows = benchmark.select(F.col(item_col).cast("string").alias("item"), text_bytes(text_col).alias("text"))
    for r in rows.toLocalIterator():
        for p in windows(words(bytes(r["text"])), width):
            found.setdefault(p, set()).update(() if r["item"] is None else (r["item"],))
        if len(found) >= most:
            yield build(found)
            found = {}
    if found:
        yield build(found)


_FOUND = "struct<n_words:bigint,n_hit:bigint,mark:binary,items:array<string>>"


def _matcher(searchers):
    """A column function: text bytes, and what earlier blocks found -> found."""
    @F.arrow_udf(_FOUND)
    def match(texts: Iterator[tuple[pa.Array, pa.Array, pa.Array]]) -> Iterator[pa.Array]:
        tables = searchers.value
        for text, old_mark, old_items in texts:
            n_words, n_hit, marks, items = [], [], [], []
            for t, m, i in zip(text.to_pylist(), old_mark.to_pylist(), old_items.to_pylist(), strict=True):
                w = words(t)
                mark, its = bytearray(m) if m else bytearray(len(w)), set(i or ())
                for x in tables:
                    x.search(w, mark, its)
                n_words.append(len(w))
                n_hit.append(mark.count(1))
                marks.append(bytes(mark) if n_hit[-1] else b"")
                items.append(sorted(its))
            yield pa.StructArray.from_arrays(
                [pa.array(n_words, pa.int64()), pa.array(n_hit, pa.int64()), pa.array(marks, pa.binary()),
                 pa.array(items, pa.list_(pa.string()))], ["n_words", "n_hit", "mark", "items"])
    return match


def find_occurrences(benchmark: DataFrame, text: str | Column = "text", item_col: str = "item_id",
                     bench_text: str = "text", width: int = WIDTH,
                     patterns_per_block: int = PATTERNS_PER_BLOCK) -> Column:
    """A column for a table of documents: struct of n_words; n_hit,
    words inside an occurrence; mark, a byte 1 for each of them (empty if
    there is none); items, the ids (strings, sorted) of items with an occurring window.

    Null texts have no words.  An item with a null id marks words but is not
    listed; repeated items count once; an item without words has no window.
    With an empty benchmark nothing occurs."""
    sc = benchmark.sparkSession.sparkContext
    body = text_bytes(text)
    found = None
    for searchers in pattern_blocks(benchmark, item_col, bench_text, width, patterns_per_block):
        match = _matcher(sc.broadcast(searchers))
        old = (F.lit(None).cast("binary"), F.lit(None).cast("array<string>")) if found is None else (found["mark"], found["items"])
        found = match(body, *old)
    return _matcher(sc.broadcast([]))(body, F.lit(None).cast("binary"), F.lit(None).cast("array<string>")) if found is None else found


def items_digest(items: Column) -> Column:
    return F.sha2(F.array_join(items, ",").cast("binary"), 256)


def contamination(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text", **kw) -> DataFrame:
    """(id, n_words, n_hit, items, contaminated), a row for every row of
    ``docs``; other columns are not read.  See find_occurrences."""
    return (docs.select(F.col(id_col), find_occurrences(benchmark, text_col, **kw).alias("f"))
            .select(id_col, "f.n_words", "f.n_hit", "f.items")
            .withColumn("contaminated", F.col("n_hit") > 0))


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, **kw) -> DataFrame:
    """The documents in which no benchmark window occurs, all columns kept."""
    found = find_occurrences(benchmark, **kw)
    return docs.where(found["n_hit"] == 0)

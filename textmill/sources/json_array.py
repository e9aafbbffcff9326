"""JSON arrays read in byte ranges.

A JSON array on one line has no line ends to split at, so Spark's multi-line
reader takes a file whole in one task.  Here a file is read as text whose
lines end at ``}``, which Spark splits into blocks anywhere.  What a closing
brace means depends on all that stands before it: whether a string is open,
and how many objects are.  Three steps:

1. Every block is summed up for both cases, string open or not, at its start:
   what the case is at its end, and how the number of open objects changes.
2. The sums of a file (one small row per block) are chained, which gives the
   state at the start of each block.
3. Every block is read again from its known state.  Objects that lie inside a
   block leave as they are; only pieces of those that cross a border are
   grouped, by the block in which the object opens.

No escape crosses a piece, for JSON knows no escaped brace.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import ensure_checkpoint_dir

BROADCAST_BLOCKS = 500_000  # rows of some 200 bytes

_ESCAPE = re.compile(rb"\\.", re.DOTALL)
_STRING_REST = re.compile(rb'(?:[^"\\]|\\.)*+"', re.DOTALL)
_TO_OBJECT = re.compile(rb'(?:[^{"]|"(?:[^"\\]|\\.)*+")*+(?=\{)', re.DOTALL)
_BLOCK = ["file_path", "block_start", "block_length"]


def _balance(piece: bytes) -> tuple[bool, tuple[int, int]]:
    """Whether the piece holds an odd number of quotes, and the objects it
    opens where no string, or one, is open at its start."""
    parts = _ESCAPE.sub(b"", piece).split(b'"') if b"\\" in piece else piece.split(b'"')
    return len(parts) % 2 == 0, (sum(p.count(b"{") for p in parts[0::2]), sum(p.count(b"{") for p in parts[1::2]))


def _object_start(piece: bytes, inside: bool) -> int:
    """Where the first brace outside strings stands."""
    at = _STRING_REST.match(piece).end() if inside else 0
    return _TO_OBJECT.match(piece, at).end()


class _Sum:
    """What a block does to the state, for each case at its start."""

    def __init__(self):
        self.inside, self.depth, self.lowest = [False, True], [0, 0], [0, 0]

    def add(self, piece: bytes) -> None:
        odd, opened = _balance(piece)
        for case in (0, 1):
            depth = self.depth[case] + opened[self.inside[case]]
            self.inside[case] ^= odd
            self.depth[case] = depth - (not self.inside[case])
            self.lowest[case] = min(self.lowest[case], self.depth[case])


_SUMS = "file_path string, block_start long, block_length long, " + ", ".join(
    f"inside{c} boolean, depth{c} long, lowest{c} long" for c in (0, 1))


def _summed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    sums: dict[tuple, _Sum] = {}  # the blocks of one task
    for b in batches:
        for piece, *block in zip(*(c.to_pylist() for c in b.columns)):
            sums.setdefault(tuple(block), _Sum()).add(piece)
    rows = [(*k, *(v for c in (0, 1) for v in (s.inside[c], s.depth[c], s.lowest[c]))) for k, s in sums.items()]
    if rows:
        names = [f.split()[0] for f in _SUMS.split(", ")]
        yield pa.RecordBatch.from_pydict(dict(zip(names, map(list, zip(*rows)))))


_STATES = "file_path string, block_start long, block_length long, inside boolean, depth long, since long"


def _chained(blocks: pd.DataFrame) -> pd.DataFrame:
    """State at the start of each block of a file; ``since`` is the block in
    which the open object opened."""
    inside, depth, since, rows = False, 0, 0, []
    for b in blocks.sort_values("block_start").itertuples():
        rows.append((b.file_path, b.block_start, b.block_length, inside, depth, since))
        end, change, lowest = (b.inside1, b.depth1, b.lowest1) if inside else (b.inside0, b.depth0, b.lowest0)
        since = b.block_start if depth + lowest <= 0 else since
        # Braces that close nothing count as nothing.
        inside, depth = bool(end), max(depth + change, change - lowest)
    return pd.DataFrame(rows, columns=[*_BLOCK, "inside", "depth", "since"])


_PARTS = "file_path string, since long, block_start long, whole boolean, part binary"


def _cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Whole objects of each block, and what it holds of objects that began
    before it or go on after it."""
    block, held, inside, depth, since, own = None, [], False, 0, 0, False

    def left() -> list[tuple]:
        return [(block[0], since, block[1], False, b"".join(held))] if held else []

    for b in batches:
        rows = []
        for piece, path, start, length, in_string, opened_before, first in zip(*(c.to_pylist() for c in b.columns)):
            if block != (path, start, length):
                if in_string is None:
                    raise RuntimeError(f"{path} was split differently while it was read; read it again")
                rows += left()
                block, held, inside, depth, since, own = (path, start, length), [], in_string, opened_before, first, False
            odd, opened = _balance(piece)
            n = opened[inside]
            if depth or n:
                if not depth:
                    piece, since, own = piece[_object_start(piece, inside):], start, True
                held += [piece, b"}"]
            inside ^= odd
            depth = max(depth + n - (not inside), 0)
            if held and not depth:
                rows.append((path, since, start, own, b"".join(held)))
                held, own = [], False
        if rows:
            yield _batch(rows)
    if block and held:
        yield _batch(left())


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    names = ["file_path", "since", "block_start", "whole", "part"]
    types = [pa.string(), pa.int64(), pa.int64(), pa.bool_(), pa.binary()]
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types)], names)


def read_json_objects(spark: SparkSession, path: str) -> DataFrame:
    """(file_path, element): the text of every outermost object of UTF-8 JSON
    files, in an array, one a line or one after another.  Other elements of an
    array are passed over; an object that never closes is given up to the end
    of its file, with a brace for the missing one; an empty file or array has no rows.  Files are read three
    times, in blocks of ``spark.sql.files.maxPartitionBytes``; an object is
    held whole in one task."""
    ensure_checkpoint_dir(spark)
    pieces = spark.read.option("lineSep", "}").text(path).select(
        F.col("value").cast("binary").alias("piece"), F.col("_metadata.file_path").alias("file_path"),
        F.col("_metadata.file_block_start").alias("block_start"), F.col("_metadata.file_block_length").alias("block_length"))
    states = pieces.mapInArrow(_summed, _SUMS).groupBy("file_path").applyInPandas(_chained, _STATES)
    states = states.checkpoint()  # one row per block, read by both passes below
    wanted = ["piece", *_BLOCK, "inside", "depth", "since"]
    if states.count() <= BROADCAST_BLOCKS:  # rows stay in the order of the file
        placed = pieces.join(F.broadcast(states), _BLOCK, "left").select(*wanted)
    else:
        placed = (pieces.withColumn("n", F.monotonically_increasing_id()).join(states, _BLOCK, "left")
                  .repartition(*_BLOCK).sortWithinPartitions(*_BLOCK, "n").select(*wanted))
    parts = placed.mapInArrow(_cut, _PARTS)
    whole = parts.where("whole").select("file_path", F.col("part").cast("string").alias("element"))
    in_order = F.transform(F.array_sort(F.collect_list(F.struct("block_start", "part"))), lambda s: s["part"].cast("string"))
    # A border may cut a character of several bytes only where it cuts a piece,
    # and pieces end at braces: each part is whole text.
    crossing = parts.where("NOT whole").groupBy("file_path", "since").agg(F.array_join(in_order, "").alias("element"))
    return whole.unionByName(crossing.select("file_path", "element"))

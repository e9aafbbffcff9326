"""Token counts with a whole-token shortcut.

Offline, every vocabulary string is encoded alone by the tokenizer; those that
come back as one pre-token and one token are proven whole.  A pre-token that
equals a proven string is one token wherever it stands, as pre-tokens are
merged on their own.  Counting a text then means splitting it and looking its
pre-tokens up; only pre-tokens outside the proven set are merged, each once
while it stays in a bounded memo.
"""

from __future__ import annotations

import functools
import json
import os
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from . import pretokens
from .common import text_bytes

MEMO_ENTRIES = 300_000


class Vocabulary:
    """A byte-level BPE tokenizer file, checked for what this module relies
    on, with its added strings and the vocabulary strings proven whole."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            self.source = f.read()
        tok = Tokenizer.from_str(self.source)
        spec = json.loads(self.source)
        pre = spec["pre_tokenizer"] or {}
        if spec["model"]["type"] != "BPE" or pre.get("type") != "ByteLevel" or pre.get("add_prefix_space") \
                or not pre.get("use_regex", True) or spec["normalizer"] or spec["model"].get("dropout"):
            raise ValueError("a byte-level BPE tokenizer without normalizer, prefix space or dropout is needed")
        added = spec.get("added_tokens") or []
        if any(a["single_word"] or a["lstrip"] or a["rstrip"] for a in added):
            raise ValueError("added tokens that take white space or whole words only are not supported")
        self.added = {a["content"]: a["id"] for a in added}
        self.whole = frozenset(self._proven(tok))

    def _proven(self, tok: Tokenizer) -> Iterator[str]:
        back = {c: b for b, c in enumerate(pretokens.byte_letters())}
        for letters, number in tok.get_vocab(with_added_tokens=False).items():
            try:
                piece = bytes(back[c] for c in letters).decode("utf-8")
            except (KeyError, UnicodeDecodeError):
                continue  # part of a character: no pre-token equals it
            if piece in self.added:
                continue
            if tok.encode(piece, add_special_tokens=False).ids == [number] and len(pretokens.split(piece)) == 1:
                yield piece


def segments(text: str, added: dict[str, int]) -> Iterator[tuple[str, int | None]]:
    """Pieces of ordinary text, each with the added token that follows it."""
    if not any(a in text for a in added):
        yield text, None
        return
    at = 0
    while True:
        hits = [(k, -len(a), a) for a in added if (k := text.find(a, at)) >= 0]
        if not hits:
            yield text[at:], None
            return
        k, size, a = min(hits)
        yield text[at:k], added[a]
        at = k - size


class Counts(dict):
    """Pre-token -> number of tokens."""

    def __init__(self, vocab: Vocabulary):
        super().__init__()
        self.whole = dict.fromkeys(vocab.whole, 1)
        self.update(self.whole)
        self.merge = Tokenizer.from_str(vocab.source).model.tokenize

    def __missing__(self, piece: str) -> int:
        if len(self) >= MEMO_ENTRIES:
            self.clear()
            self.update(self.whole)
        n = len(self.merge(pretokens.to_letters(piece)))
        if len(piece) <= 256:
            self[piece] = n
        return n


@functools.lru_cache(maxsize=1)
def _counts(source: str, vocab: Broadcast) -> Counts:
    return Counts(vocab.value)


def worker_counts(vocab: Broadcast) -> Counts:
    """One memo for all tasks that a Python worker runs."""
    return _counts(vocab.value.source, vocab)


def count_tokens(text: str, counts: Counts, added: dict[str, int]) -> int:
    return sum(sum(map(counts.__getitem__, pretokens.split(part))) + (follow is not None)
               for part, follow in segments(text, added))


def vocabulary(spark: SparkSession, path: str) -> Broadcast:
    """The tokenizer for the executors; as large as its file (a few MB)."""
    if os.path.getsize(path) > 64 << 20:
        raise ValueError("the tokenizer file is too large to broadcast")
    return spark.sparkContext.broadcast(Vocabulary(path))


def token_counts(vocab: Broadcast, text: str | Column = "text") -> Column:
    """A column: tokens of the whole text, as the tokenizer encodes it without
    added begin or end tokens; strings of added tokens inside the text count
    as one.  Null or empty: 0."""
    @F.arrow_udf("long")
    def count(texts: Iterator[pa.Array]) -> Iterator[pa.Array]:
        v = vocab.value
        memo = worker_counts(vocab)
        for t in texts:
            yield pa.array(np.fromiter((count_tokens(x.decode(), memo, v.added) for x in t.to_pylist()), np.int64, len(t)))

    return count(text_bytes(text))


def count_table(docs: DataFrame, tokenizer_path: str, id_col: str = "doc_id", text_col: str = "text",
                limit: int = 512) -> DataFrame:
    """(id, n_bytes, n_tokens, over_limit), a row for every row of ``docs``;
    null texts count as empty, other columns are not read."""
    n = token_counts(vocabulary(docs.sparkSession, tokenizer_path), text_col)
    return (docs.select(F.col(id_col), F.octet_length(text_bytes(text_col)).cast("long").alias("n_bytes"), n.alias("n_tokens"))
            .withColumn("over_limit", F.col("n_tokens") > limit))

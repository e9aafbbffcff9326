"""Byte-level BPE encoding with reuse of content-defined chunks, and decoding.

A rolling hash over the last 16 characters cuts a text where its low bits are
all ones, so equal passages are cut alike wherever they stand.  A chunk is
encoded on its own, once, and its ids are reused for every document that the
Python worker meets it in, as long as a bounded cache holds it.

A chunk's ids are right for the whole text except near its ends.  Splitting
scans from left to right and looks at most three characters past a pre-token,
so from a true start of a pre-token on, a chunk's pre-tokens are those of the
text up to its last two.  At a join the text from the last two pre-tokens of
one chunk to the first few of the next is split anew; where this gives a start
that the next chunk has as well, with two pre-tokens more behind it, both
agree from there on.  The window grows until they do, at worst over the whole
chunk, so the result is exact.
"""

from __future__ import annotations

import functools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from . import pretokens
from .common import text_bytes
from .token_count import Vocabulary, segments, vocabulary

AVERAGE = 2048             # characters of a chunk, a power of two
LONGEST = 16 * AVERAGE     # a chunk is cut there at the latest
CACHE_CHARS = 3_000_000    # characters of chunks held by a worker, twice this at most
MEMO_ENTRIES = 150_000     # pre-tokens whose ids a worker holds
HEAD, TAIL = 4, 2          # pre-tokens of a chunk looked at first at a join; distrusted at its end


def cuts(points: np.ndarray) -> list[int]:
    """Ends of the chunks of a text given as code points, the last included."""
    n = len(points)
    h = points * np.uint32(0x9E3779B1)
    h ^= h >> np.uint32(15)
    factor, width = 0x85EBCA6B, 1
    for _ in range(4):  # sums over 2, 4, 8, 16 characters
        more = h.copy()
        more[width:] += h[:-width] * np.uint32(factor) if n > width else 0
        h, width, factor = more, 2 * width, factor * factor & 0xFFFFFFFF
    h ^= h >> np.uint32(16)
    low = np.uint32(AVERAGE - 1)
    ends = (np.flatnonzero((h & low) == low) + 1).tolist()
    out, at = [], 0
    for e in [*ends, n]:
        while e - at > LONGEST:
            at += LONGEST
            out.append(at)
        if e > at:
            out.append(e)
            at = e
    return out


class Merges(dict):
    """Pre-token -> its ids as little-endian 32-bit numbers."""

    def __init__(self, vocab: Vocabulary):
        super().__init__()
        self.model = Tokenizer.from_str(vocab.source).model

    def __missing__(self, piece: str) -> bytes:
        if len(self) >= MEMO_ENTRIES:
            self.clear()
        ids = b"".join([t.id.to_bytes(4, "little") for t in self.model.tokenize(pretokens.to_letters(piece))])
        if len(piece) <= 256:
            self[piece] = ids
        return ids


class Chunk:
    """A chunk encoded alone.  head: its first pre-tokens, and after[k] the
    bytes of ids of the first k; ids: all of them; core: bytes of ids without
    the last pre-tokens, whose text is tail.  Short chunks have no ids and are
    taken as text."""

    __slots__ = ("after", "core", "head", "ids", "tail", "text")

    def __init__(self, text: str, merges: Merges):
        pieces = pretokens.split(text)
        self.text, self.ids = text, None
        if len(pieces) >= HEAD + TAIL + 2:
            parts = list(map(merges.__getitem__, pieces))
            self.ids = b"".join(parts)
            self.head, self.after = pieces[:HEAD], [0]
            for p in parts[:HEAD]:
                self.after.append(self.after[-1] + len(p))
            self.core = len(self.ids) - sum(map(len, parts[-TAIL:]))
            self.tail = "".join(pieces[-TAIL:])


class Encoder:
    def __init__(self, vocab: Vocabulary):
        self.added, self.merges = vocab.added, Merges(vocab)
        self.now: dict[str, Chunk] = {}
        self.before: dict[str, Chunk] = {}
        self.held = 0
        self.hits = self.misses = 0

    def chunk(self, text: str) -> Chunk:
        found = self.now.get(text)
        if found is None:
            found = self.before.get(text)
            if found is None:
                self.misses += 1
                found = Chunk(text, self.merges)
            else:
                self.hits += 1
            if self.held > CACHE_CHARS:  # the older generation goes
                self.before, self.now, self.held = self.now, {}, 0
            self.now[text] = found
            self.held += len(text)
        else:
            self.hits += 1
        return found

    def plain(self, text: str) -> bytes:
        return b"".join(map(self.merges.__getitem__, pretokens.split(text)))

    def joined(self, text: str, out: list[bytes]) -> None:
        """Append the ids of a text without added tokens."""
        if not text:
            return
        at, left = 0, ""  # left: text before the chunk, from a true start on, not yet written
        for end in cuts(pretokens.code_points(text)):
            c = self.chunk(text[at:end])
            at = end
            if c.ids is None:
                left += c.text
            elif not left:
                out.append(c.ids[:c.core])
                left = c.tail
            else:
                left = self.repair(left, c, out)
        out.append(self.plain(left))

    def repair(self, left: str, c: Chunk, out: list[bytes]) -> str:
        """Join the chunk to the text before it; returns what stays unwritten."""
        pieces = pretokens.split(left + "".join(c.head))
        starts, s = {}, 0
        for k, p in enumerate(pieces):
            starts[s] = k
            s += len(p)
        s = len(left)
        for k in range(HEAD - TAIL + 1):  # at least two pre-tokens of the head behind it
            if s in starts and starts[s] + TAIL <= len(pieces):
                out += map(self.merges.__getitem__, pieces[:starts[s]])
                out.append(c.ids[c.after[k]:c.core])
                return c.tail
            s += len(c.head[k])
        return self.long_repair(left, c, out)

    def long_repair(self, left: str, c: Chunk, out: list[bytes]) -> str:
        """No agreement near the join: split what is left and the whole chunk
        together and keep its last pre-tokens open."""
        pieces = pretokens.split(left + c.text)
        done = max(0, len(pieces) - TAIL)
        out += map(self.merges.__getitem__, pieces[:done])
        return "".join(pieces[done:])

    def encode(self, text: str) -> np.ndarray:
        out: list[bytes] = []
        for part, follow in segments(text, self.added):
            self.joined(part, out)
            if follow is not None:
                out.append(np.array([follow], "<u4").tobytes())
        return np.frombuffer(b"".join(out), "<u4")


class Decoder:
    """Ids -> text: the bytes of every token in order, as UTF-8; bytes that are
    not valid become U+FFFD."""

    def __init__(self, vocab: Vocabulary):
        tok = Tokenizer.from_str(vocab.source)
        back = {c: b for b, c in enumerate(pretokens.byte_letters())}
        self.bytes = {i: bytes(back[c] for c in s) if all(c in back for c in s) else s.encode()
                      for s, i in tok.get_vocab(with_added_tokens=True).items()}

    def decode(self, ids: list[int]) -> str:
        try:
            return b"".join(map(self.bytes.__getitem__, ids)).decode("utf-8", "replace")
        except KeyError as e:
            raise ValueError(f"no token has the id {e.args[0]}") from None


@functools.lru_cache(maxsize=1)
def _encoder(source: str, vocab: Broadcast) -> Encoder:
    return Encoder(vocab.value)


@functools.lru_cache(maxsize=1)
def _decoder(source: str, vocab: Broadcast) -> Decoder:
    return Decoder(vocab.value)


def worker_encoder(vocab: Broadcast) -> Encoder:
    """One encoder, with its chunk cache, for all tasks of a Python worker."""
    return _encoder(vocab.value.source, vocab)


def worker_decoder(vocab: Broadcast) -> Decoder:
    return _decoder(vocab.value.source, vocab)


def portions(a: pa.Array, rows: int = 500) -> Iterator[pa.Array]:
    """A batch in short runs, so that only few results are held at once."""
    for s in range(0, len(a), rows):
        yield a.slice(s, rows)


def lists(values: list[np.ndarray]) -> pa.Array:
    ends = np.concatenate(([0], np.cumsum([len(v) for v in values]))).astype(np.int32)
    flat = np.concatenate(values) if values else np.empty(0, "<u4")
    return pa.ListArray.from_arrays(pa.array(ends), pa.array(flat.view(np.int32)))


def encode(vocab: Broadcast, text: str | Column = "text") -> Column:
    """A column: array<int> of the ids of the whole text, as the tokenizer
    encodes it without added begin or end tokens.  Strings of added tokens
    inside the text become those tokens.  Null or empty: an empty array."""
    @F.arrow_udf("array<int>")
    def run(texts: Iterator[pa.Array]) -> Iterator[pa.Array]:
        enc = worker_encoder(vocab)
        for t in texts:
            for some in portions(t):
                yield lists([enc.encode(x.decode()) for x in some.to_pylist()])

    return run(text_bytes(text))


def decode(vocab: Broadcast, ids: str | Column = "ids") -> Column:
    """A column: the text of an array<int> of ids, special tokens included.
    Null: an empty text.  Unknown ids are an error."""
    @F.arrow_udf("string")
    def run(lists_: Iterator[pa.Array]) -> Iterator[pa.Array]:
        dec = worker_decoder(vocab)
        for t in lists_:
            for some in portions(t):
                yield pa.array([dec.decode(x.values.to_numpy().tolist() if x.is_valid else ()) for x in some], pa.string())

    return run(F.col(ids) if isinstance(ids, str) else ids)


def encode_checked(vocab: Broadcast, text: str | Column = "text") -> Column:
    """A column: struct of ids (see encode) and round_trip, whether decoding
    them gives the text back."""
    @F.arrow_udf("struct<ids:array<int>,round_trip:boolean>")
    def run(texts: Iterator[pa.Array]) -> Iterator[pa.Array]:
        enc, dec = worker_encoder(vocab), worker_decoder(vocab)
        for t in texts:
            for some in portions(t):
                body = [x.decode() for x in some.to_pylist()]
                ids = [enc.encode(x) for x in body]
                same = [dec.decode(i.tolist()) == x for i, x in zip(ids, body)]
                yield pa.StructArray.from_arrays([lists(ids), pa.array(same, pa.bool_())], ["ids", "round_trip"])

    return run(text_bytes(text))


def encode_table(docs: DataFrame, tokenizer_path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, ids), a row for every row of ``docs``; other columns are not read."""
    v = vocabulary(docs.sparkSession, tokenizer_path)
    return docs.select(F.col(id_col), encode(v, text_col).alias("ids"))

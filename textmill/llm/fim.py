"""Fill-in-the-middle: texts cut at two token boundaries and put in another
order between markers.

The ends of a text's tokens are held as a compressed set of code point
positions in the manner of Roaring bitmaps: the positions are dealt by their
high 16 bits to containers, and each container keeps the low bits as a sorted
array, a bitmap or a list of runs, whichever is smallest.  Cumulative
cardinalities over the containers answer "where does token k end": a binary
search finds the container, and a select inside it the position.  Both cuts of
a text come from one such set.

Only the set is Python (Arrow batches, a text at a time); the choice of cuts
and of the form, the output and its inverse are DataFrame expressions over
hashes of the id, so a task that runs again gives the same rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import text_bytes

PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
SPAN = 1 << 16       # positions of a container
MOST_LISTED = 4096   # members of an array container: 2 bytes each, a bitmap takes 8,192


class ArrayContainer:
    """The sorted low bits."""

    def __init__(self, member: np.ndarray):
        self.low = np.flatnonzero(member).astype(np.uint16)

    def select(self, k: int) -> int:
        return int(self.low[k])


class BitmapContainer:
    """64-bit words, with the number of members before each of them."""

    def __init__(self, member: np.ndarray):
        bits = np.packbits(np.pad(member, (0, SPAN - len(member))), bitorder="little")
        self.words = bits.view(np.uint64)
        self.before = np.concatenate(([0], np.cumsum(np.bitwise_count(self.words), dtype=np.int64)))

    def select(self, k: int) -> int:
        word = int(np.searchsorted(self.before, k, "right")) - 1
        bits = np.unpackbits(self.words[word:word + 1].view(np.uint8), bitorder="little")
        return word * 64 + int(np.flatnonzero(bits)[k - int(self.before[word])])


class RunContainer:
    """Starts of the runs, with the number of members before each of them."""

    def __init__(self, member: np.ndarray):
        edge = np.flatnonzero(np.diff(member.astype(np.int8), prepend=0, append=0))
        self.starts = edge[::2].astype(np.uint16)
        self.before = np.concatenate(([0], np.cumsum(edge[1::2] - edge[::2])))

    def select(self, k: int) -> int:
        run = int(np.searchsorted(self.before, k, "right")) - 1
        return int(self.starts[run]) + k - int(self.before[run])


def container(member: np.ndarray, size: int):
    """The smallest container for the members (marked true) of one span."""
    runs = int(member[0]) + int(np.count_nonzero(member[1:] & ~member[:-1]))
    if 4 * runs < min(2 * size, SPAN // 8):
        return RunContainer(member)
    return ArrayContainer(member) if size <= MOST_LISTED else BitmapContainer(member)


class BoundarySet:
    """The set of positions marked true; ``select(k)`` is its k-th member."""

    def __init__(self, member: np.ndarray):
        self.containers, sizes, self.keys = [], [], []
        for start in range(0, len(member), SPAN):
            part = member[start:start + SPAN]
            if n := int(np.count_nonzero(part)):
                self.containers.append(container(part, n))
                self.keys.append(start)
                sizes.append(n)
        self.before = np.concatenate(([0], np.cumsum(sizes, dtype=np.int64)))

    def __len__(self) -> int:
        return int(self.before[-1])

    def select(self, k: int) -> int:
        c = int(np.searchsorted(self.before, k, "right")) - 1
        return self.keys[c] + self.containers[c].select(k - int(self.before[c]))


def token_ends(text: np.ndarray) -> np.ndarray:
    """For every code point of a UTF-8 text (bytes) whether a token ends with
    it; tokens are runs of A-Z and a-z, and any other code point alone."""
    letter = ((text | 0x20) - np.uint8(97)) < 26
    first = (text & 0xC0) != 0x80
    if not first.all():
        letter = letter[first]
    ends = np.ones(len(letter), bool)
    np.logical_and(letter[:-1], letter[1:], out=ends[:-1])
    np.logical_not(ends[:-1], out=ends[:-1])
    return ends


_CUTS = "struct<n:bigint,first:bigint,second:bigint>"


def _cuts(text: Column, one: Column, two: Column) -> Column:
    """(tokens, the smaller and the larger cut) of texts, by two draws."""
    @F.arrow_udf(_CUTS)
    def run(rows: Iterator[tuple[pa.Array, pa.Array, pa.Array]]) -> Iterator[pa.Array]:
        for texts, a, b in rows:
            out = np.zeros((3, len(texts)), np.int64)
            for k, (t, x, y) in enumerate(zip(texts, a.to_pylist(), b.to_pylist(), strict=True)):
                if not len(body := np.frombuffer(t.as_buffer(), np.uint8)):
                    continue
                ends = BoundarySet(token_ends(body))
                n = len(ends)
                cut = sorted((x % (n + 1), y % (n + 1)))
                out[:, k] = n, *(ends.select(c - 1) + 1 if c else 0 for c in cut)
            yield pa.StructArray.from_arrays([pa.array(x) for x in out], ["n", "first", "second"])

    return run(text, one, two)


def draw(id_col: str | Column, group: int, salt: str = "1") -> Column:
    """A number below 2^32 from the id: the group-th 8 hex digits of the
    sha256 of ``salt:id``; a null id counts as empty."""
    c = F.col(id_col) if isinstance(id_col, str) else id_col
    digest = F.sha2(F.concat(F.lit(f"{salt}:"), F.coalesce(c.cast("string"), F.lit(""))).cast("binary"), 256)
    return F.conv(F.substring(digest, 8 * group - 7, 8), 16, 10).cast("long")


def transform(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", rate: int = 90, suffix_first: int = 20,
              salt: str = "1") -> DataFrame:
    """(id, n, form, prefix_chars, middle_chars, output), a row for every row
    of ``docs``; no other column is read.

    n counts the tokens.  ``rate`` percent of the documents are cut; of these
    ``suffix_first`` percent get the form spm (suffix, prefix, middle), the
    others psm (prefix, suffix, middle).  The rest, empty texts and texts that
    hold a marker already are plain: the output is the text and the two
    lengths (code points) are null.  Null texts count as empty; pieces may be
    empty.  Equal rows give equal rows; an empty table gives none."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    h = [draw(id_col, k, salt) for k in (1, 2, 3, 4)]
    marked = text.contains(PREFIX) | text.contains(SUFFIX) | text.contains(MIDDLE)
    form = (F.when((text == "") | marked | (h[2] % 100 >= rate), "plain")
            .when(h[3] % 100 < suffix_first, "spm").otherwise("psm"))
    cut = docs.select(F.col(id_col).alias("id"), text.alias("body"), form.alias("form"),
                      _cuts(text_bytes(text_col), h[0], h[1]).alias("cut"))
    body, first, second = F.col("body"), F.col("cut.first").cast("int"), F.col("cut.second").cast("int")
    prefix = F.substring(body, F.lit(1), first)
    middle = F.substring(body, first + 1, second - first)
    suffix = F.substring(body, second + 1, F.char_length(body) - second)
    p, s, m = (F.lit(x) for x in (PREFIX, SUFFIX, MIDDLE))
    output = (F.when(F.col("form") == "plain", body)
              .when(F.col("form") == "spm", F.concat(s, suffix, p, prefix, m, middle))
              .otherwise(F.concat(p, prefix, s, suffix, m, middle)))
    split = F.col("form") != "plain"
    return cut.select(F.col("id").alias(id_col), F.col("cut.n").alias("n"), "form",
                      F.when(split, F.col("cut.first")).alias("prefix_chars"),
                      F.when(split, F.col("cut.second") - F.col("cut.first")).alias("middle_chars"),
                      output.alias("output"))


def restore(output: str | Column = "output", form: str | Column = "form") -> Column:
    """The text that ``transform`` put in order, from its output and form."""
    out, kind = (F.col(x) if isinstance(x, str) else x for x in (output, form))
    psm = F.regexp_replace(out, rf"(?s)\A{PREFIX}(.*){SUFFIX}(.*){MIDDLE}(.*)\z", "$1$3$2")
    spm = F.regexp_replace(out, rf"(?s)\A{SUFFIX}(.*){PREFIX}(.*){MIDDLE}(.*)\z", "$2$3$1")
    return F.when(kind == "psm", psm).when(kind == "spm", spm).otherwise(out)

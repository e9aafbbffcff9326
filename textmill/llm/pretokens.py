"""Pre-tokens of byte-level BPE, found with array operations.

A pre-token is what the tokenizer's split pattern
    's|'t|'re|'ve|'m|'ll|'d| ?\\p{L}+| ?\\p{N}+| ?[^\\s\\p{L}\\p{N}]+|\\s+(?!\\S)|\\s+
matches; its bytes are merged on their own.  Splitting is a property of
character classes except for contractions, so the starts of pre-tokens follow
from class changes between neighbouring characters.
"""

from __future__ import annotations

import functools
import sys
import unicodedata

import numpy as np

LETTER, NUMBER, SPACE, OTHER = 1, 2, 3, 0
# FIXED VALUES: suffixes of the pattern's contractions; White_Space code points.
CONTRACTIONS = ("s", "t", "re", "ve", "m", "ll", "d")
WHITE_SPACE = (*range(0x09, 0x0E), 0x20, 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000)


@functools.lru_cache(maxsize=1)
def classes() -> np.ndarray:
    """Class of every code point."""
    kinds = {"L": LETTER, "N": NUMBER}
    out = np.fromiter((kinds.get(unicodedata.category(chr(c))[0], OTHER) for c in range(sys.maxunicode + 1)), np.uint8)
    out[list(WHITE_SPACE)] = SPACE
    return out


def code_points(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)


def starts(text: str, points: np.ndarray | None = None) -> np.ndarray:
    """Offsets (in characters) at which pre-tokens start, ascending."""
    cp = code_points(text) if points is None else points
    n = len(cp)
    if not n:
        return np.empty(0, np.int64)
    cls = classes()[cp]
    start = np.empty(n, bool)
    start[0] = True
    np.not_equal(cls[1:], cls[:-1], out=start[1:])
    white = cls == SPACE
    after = np.flatnonzero(white[:-1] & ~white[1:]) + 1  # what follows white space
    start[after - 1] = True                              # its last character stands alone,
    start[after[cp[after - 1] == 0x20]] = False          # or a blank joins what follows
    if "'" in text:
        quotes = np.flatnonzero(cp == 0x27)
        for q in quotes[start[quotes]].tolist():
            if not start[q]:
                continue
            for c in CONTRACTIONS:
                if text.startswith(c, q + 1):
                    start[q + 1] = False
                    if q + 1 + len(c) < n:
                        start[q + 1 + len(c)] = True
                        # the blank rule does not reach inside a contraction
                    break
    return np.flatnonzero(start)


def split(text: str) -> list[str]:
    at = starts(text).tolist()
    return [text[a:b] for a, b in zip(at, [*at[1:], len(text)])]


@functools.lru_cache(maxsize=1)
def byte_letters() -> list[str]:
    """The letter that byte-level BPE writes for each byte: printable Latin-1
    characters stand for themselves, the others for U+0100 onward."""
    plain = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    spare = iter(range(0x100, 0x200))
    return [chr(b) if b in plain else chr(next(spare)) for b in range(256)]


@functools.lru_cache(maxsize=1)
def _latin_map() -> dict[int, str]:
    return dict(enumerate(byte_letters()))


def to_letters(piece: str) -> str:
    return piece.encode("utf-8", "surrogatepass").decode("latin-1").translate(_latin_map())

"""Small tables with awkward rows, shared by the operator tests."""

from __future__ import annotations

import random
import zlib

from pyspark.sql import Row

SCHEMA = ("doc_id long, text string, lang string, source string, n_chars long, "
          "id long, fp long, grp long, score double, n_tokens string, key string")


def crc(x, n):
    return zlib.crc32(str(x).encode()) % n


def sentence(rng, n, words="alpha beta gamma delta of the and it Zürich élan naïve 日本語 x1 9 don't".split()):
    return " ".join(rng.choice(words) for _ in range(n))


def rows(texts, start=0):
    return [Row(doc_id=start + k, text=t, lang="en", source="s", n_chars=len(t or ""), id=7, fp=1, grp=2, score=0.5,
                n_tokens="x", key="k") for k, t in enumerate(texts)]


def awkward(rng):
    """Nulls, empty and blank texts, ties, repeated texts, a very long one."""
    base = sentence(rng, 60)
    texts = [None, "", " \t\n", base, base, base + " tail", "one", "Two words", "UPPER lower MiXed", sentence(rng, 30_000),
             "\x00 nul\x1c sep\x0b vt", "emoji 😀😀 ok", "<|endoftext|> inside <|endoftext|>", "'s 't don't ''s  's", "x" * 50_000]
    return [*texts, *(sentence(rng, rng.randint(1, 80)) for _ in range(60))]


def frame(spark, texts, start=0, more=()):
    return spark.createDataFrame([*rows(texts, start), *more], SCHEMA)


def rng(seed=5):
    return random.Random(seed)

import hashlib
import os
import random

import public_tokenizers
import pytest
import regex
from textmill.llm import bpe, pretokens, token_count
from textmill.llm import queries as Q
from tokenizers import Tokenizer
from util import awkward, frame, rng

PATH = public_tokenizers.path("byte_bpe_50k.json")
ALPHABET = "ab Z19  \n\t'''srtvemld.,é²½٣  　中😀\x85\x1c_-"


@pytest.fixture(scope="module")
def tok():
    return Tokenizer.from_file(PATH)


@pytest.fixture(scope="module")
def vocab():
    return token_count.Vocabulary(PATH)


def fuzz(n, most, seed=1):
    r = random.Random(seed)
    return ["".join(r.choice(ALPHABET) for _ in range(r.randint(0, most))) for _ in range(n)]


def test_pretokens_equal_the_pattern():
    pattern = regex.compile(public_tokenizers.PATTERN)
    for t in fuzz(5000, 30):
        assert pretokens.split(t) == pattern.findall(t)


def test_every_character_counts_as_in_the_library(tok, vocab):
    counts = token_count.Counts(vocab)
    texts = ["".join(f"a{chr(c)}b {chr(c)}{chr(c)} 1{chr(c)}" for c in range(s, s + 64) if not 0xD800 <= c < 0xE000)
             for s in [*range(0, 0x3400, 64), *range(0x1F000, 0x1FA00, 64)]]
    for t, e in zip(texts, tok.encode_batch(texts, add_special_tokens=False)):
        assert token_count.count_tokens(t, counts, vocab.added) == len(e.ids)


def test_proven_strings_are_one_token(tok, vocab):
    assert len(vocab.whole) > 45_000
    for piece in random.Random(0).sample(sorted(vocab.whole), 500):
        assert len(tok.encode(piece, add_special_tokens=False).ids) == 1


@pytest.mark.parametrize("average", [8, 64, 1024])
def test_joins_are_repaired_exactly(tok, vocab, monkeypatch, average):
    monkeypatch.setattr(bpe, "AVERAGE", average)
    monkeypatch.setattr(bpe, "LONGEST", 16 * average)
    enc, dec = bpe.Encoder(vocab), bpe.Decoder(vocab)
    texts = [*fuzz(600, 500), "a" * 5000, " " * 3000 + "x", "'" * 2000 + "s", "l'l" * 500, "<|endoftext|>" * 3 + "x <|endoftext|>"]
    for t in [*texts, *texts]:  # the second time from the cache
        want = tok.encode(t, add_special_tokens=False).ids
        ids = enc.encode(t).tolist()
        assert ids == want
        assert dec.decode(ids) == tok.decode(want, skip_special_tokens=False)
    assert enc.hits


def test_decode_of_partial_characters(tok, vocab):
    dec = bpe.Decoder(vocab)
    r = random.Random(4)
    for _ in range(300):
        ids = [r.randrange(50257) for _ in range(r.randint(0, 12))]
        assert dec.decode(ids) == tok.decode(ids, skip_special_tokens=False)


def test_columns(spark, tok):
    texts = awkward(rng(6))
    df = frame(spark, texts)
    want = [tok.encode(t or "", add_special_tokens=False).ids for t in texts]
    got = {x["doc_id"]: x["ids"] for x in bpe.encode_table(df, PATH).collect()}
    assert [got[k] for k in range(len(texts))] == want
    v = token_count.vocabulary(spark, PATH)
    back = bpe.encode_table(df, PATH).select("doc_id", bpe.decode(v, "ids").alias("t")).collect()
    assert {x["doc_id"]: x["t"] for x in back} == {k: t or "" for k, t in enumerate(texts)}
    got = {x["doc_id"]: x for x in token_count.count_table(df, PATH).collect()}
    for k, t in enumerate(texts):
        assert got[k]["n_tokens"] == len(want[k]) and got[k]["n_bytes"] == len((t or "").encode())
        assert got[k]["over_limit"] == (len(want[k]) > 512)
    assert token_count.count_table(frame(spark, []), PATH).collect() == []
    assert bpe.encode_table(frame(spark, []), PATH).collect() == []


def test_queries(spark, tok):
    d = "/root/testdata/sf0.001"
    docs = {x["doc_id"]: x["text"] or "" for x in spark.read.parquet(os.path.join(d, "documents.parquet")).collect()}
    a = {x["doc_id"]: x for x in Q.op3_bpe(spark, d).collect()}
    b = {x["doc_id"]: x for x in Q.op5_token_count(spark, d).collect()}
    assert a.keys() == b.keys() == docs.keys()
    for k, t in docs.items():
        ids = tok.encode(t, add_special_tokens=False).ids
        assert a[k]["n_tokens"] == b[k]["n_tokens"] == len(ids)
        assert a[k]["ids_sha256"] == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
        assert a[k]["decoded_sha256"] == hashlib.sha256(tok.decode(ids, skip_special_tokens=False).encode()).hexdigest()

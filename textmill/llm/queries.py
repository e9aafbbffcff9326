"""One registered query per operator, over its whole table, with production
parameters; the digests that the results carry are derived here."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import bpe, chat_tree, collocation, decontam, embedding_dedup, fim, lang_id, lm_score, secret_scan, shard, simhash, token_count, toxicity
from .common import read, text_bytes

TOKENIZER = "byte_bpe_50k.json"


def op1_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embedding_dedup.near_vectors(read(spark, sf_dir, "embeddings"), threshold=0.93)


def op2_lm_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm_score.score_table(read(spark, sf_dir, "documents"))


def op3_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    vocab = token_count.vocabulary(spark, public_tokenizers.path(TOKENIZER))

    @F.arrow_udf("struct<n_tokens:bigint,ids_sha256:string,decoded_sha256:string>")
    def digests(texts: Iterator[pa.Array]) -> Iterator[pa.Array]:
        enc, dec = bpe.worker_encoder(vocab), bpe.worker_decoder(vocab)
        decimal = {i: b"%d" % i for i in dec.bytes}
        for t in texts:
            n, ids_sha, text_sha = [], [], []
            for x in t.to_pylist():
                ids = enc.encode(x.decode()).tolist()
                n.append(len(ids))
                ids_sha.append(hashlib.sha256(b",".join(map(decimal.__getitem__, ids))).hexdigest())
                text_sha.append(hashlib.sha256(dec.decode(ids).encode()).hexdigest())
            yield pa.StructArray.from_arrays([pa.array(n, pa.int64()), pa.array(ids_sha, pa.string()), pa.array(text_sha, pa.string())],
                                             ["n_tokens", "ids_sha256", "decoded_sha256"])

    return read(spark, sf_dir, "documents").select("doc_id", digests(text_bytes()).alias("r")).select("doc_id", "r.*")


SHARDS = [f"shard-{k:02d}" for k in range(64)]


def op4_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").select("doc_id")
    return shard.place(docs, "doc_id", SHARDS)


def op5_token_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_count.count_table(read(spark, sf_dir, "documents"), public_tokenizers.path(TOKENIZER), limit=512)


def op6_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lang_id.predict_table(read(spark, sf_dir, "documents"))


def op7_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.score_table(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels"), threshold=0.7)


ODD_TEXT = "\\### Assistant: </turn> ok"


def op8_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    table = read(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    odd = spark.range(2).select(F.lit(-7).cast("long").alias("conv_id"), F.col("id").alias("turn"),
                                F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"), F.lit(ODD_TEXT).alias("text"))
    out = chat_tree.format_conversations(table.unionByName(odd)).select(
        "conv_id", "formatted", chat_tree.read_back(F.col("formatted")).alias("turns"),
        chat_tree.learned_text(F.col("formatted"), F.col("loss")).alias("learned"))
    whole = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    return out.select("conv_id", F.size("turns").cast("long").alias("n_turns"), F.sha2(whole.cast("binary"), 256).alias("turns_sha256"),
                      F.char_length("learned").cast("long").alias("loss_chars"), F.sha2(F.col("learned").cast("binary"), 256).alias("loss_sha256"),
                      F.char_length("formatted").cast("long").alias("formatted_chars"))


OP8_SQL = r"""
WITH c AS (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '\### Assistant: </turn> ok' UNION ALL SELECT -7, 1, 'assistant', '\### Assistant: </turn> ok'),
e AS (SELECT *, replace(replace(replace(text, '\', '\\'), '#', '\h'), '<', '\l') AS body,
  replace(replace(replace(replace(role, '\', '\\'), '#', '\h'), '<', '\l'), ':', '\c') AS head FROM c)
SELECT conv_id, count(*) AS n_turns, sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
  CAST(sum(CASE WHEN role = 'assistant' THEN length(text) ELSE 0 END) AS BIGINT) AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (WHERE role = 'assistant'), '')) AS loss_sha256,
  CAST(sum(length(head) + length(body) + 14) AS BIGINT) AS formatted_chars
FROM e GROUP BY conv_id"""


def op9_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.simhash_components(read(spark, sf_dir, "documents"), words=3, max_bits=3)


def op10_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontam.contamination(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"), width=10)
    return found.select("doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
                        decontam.items_digest(F.col("items")).alias("items_sha256"), "contaminated")


def op11_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = secret_scan.scan(read(spark, sf_dir, "documents"))
    count = lambda kind: F.size(F.filter("base", lambda s: s["kind"] == kind)).cast("long")
    return found.select("doc_id", *(count(k).alias(f"n_{k}") for k in secret_scan.KINDS[:3]),
                        F.sha2(secret_scan.as_text("base").cast("binary"), 256).alias("base_sha256"),
                        secret_scan.as_text(secret_scan.merged()).alias("spans"))


# Positions by the lengths of the pieces between matches; every window of a candidate measured on its own.
OP11_SQL = r"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS t FROM documents),
p AS (SELECT 'assign' AS kind, 0 AS rank, '([Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]|[Tt][Oo][Kk][Ee][Nn]|[Aa][Pp][Ii]_?[Kk][Ee][Yy])["'']? *[:=] *["'']?([A-Za-z0-9+/_.=-]+)' AS rx
  UNION ALL SELECT 'access', 1, 'AKIA[A-Z0-9]+' UNION ALL SELECT 'hex', 2, '[0-9a-f]{24,}' UNION ALL SELECT 'entropy', 3, '[A-Za-z0-9+/_=-]{20,}'),
m AS (SELECT doc_id, kind, rank, rx, regexp_extract_all(t, rx) AS found, regexp_split_to_array(t, rx) AS between FROM d, p WHERE regexp_matches(t, rx)),
s AS (SELECT doc_id, unnest(list_transform(range(1, len(found) + 1), lambda i: {'kind': kind, 'rank': rank, 'f': found[i], 'a': CAST(
  list_sum(list_transform(between[:i], lambda x: length(x))) + coalesce(list_sum(list_transform(found[:i - 1], lambda x: length(x))), 0) AS BIGINT)}), recursive := true) FROM m),
base AS (SELECT doc_id, kind, rank, a, a + length(f) AS b FROM s WHERE
  kind = 'hex' OR kind = 'access' AND length(f) >= 20 OR kind = 'assign' AND length(regexp_extract(f, (SELECT rx FROM p WHERE kind = 'assign'), 2)) >= 6),
c AS (SELECT doc_id, f, a, CASE WHEN regexp_full_match(f, '[0-9A-Fa-f]+') THEN 3 ELSE 4 END AS rank FROM s WHERE kind = 'entropy'
  AND regexp_matches(f, '[0-9]') AND regexp_matches(f, '[A-Za-z]')
  AND NOT regexp_matches(f, '^[0-9a-f]{8}(-[0-9a-f]{4}){3}-[0-9a-f]{12}$|example|sample|placeholder|x{4}|0123456789|abcdefgh|qwertyui', 'i')),
w AS (SELECT doc_id, a, rank, list_filter(range(0, length(f) - 19), lambda k:
  list_aggregate(string_split(f[k + 1:k + 20], ''), 'entropy') >= CASE rank WHEN 3 THEN 3.0 ELSE 3.8 END) AS hot FROM c),
added AS (SELECT doc_id, CASE rank WHEN 3 THEN 'entropy_hex' ELSE 'entropy_base64' END AS kind, rank, a + hot[1] AS a, a + hot[-1] + 20 AS b FROM w WHERE len(hot) > 0),
kept AS (SELECT * FROM added x WHERE NOT EXISTS (SELECT 1 FROM base y WHERE y.doc_id = x.doc_id AND y.a <= x.a AND x.b <= y.b)),
j AS (SELECT *, concat_ws(':', kind, a, b) AS said FROM (SELECT * FROM base UNION ALL SELECT * FROM kept))
SELECT d.doc_id, count(*) FILTER (kind = 'assign') AS n_assign, count(*) FILTER (kind = 'access') AS n_access, count(*) FILTER (kind = 'hex') AS n_hex,
  sha256(coalesce(string_agg(said, ',' ORDER BY a, rank) FILTER (rank < 3), '')) AS base_sha256,
  coalesce(string_agg(said, ',' ORDER BY a, rank), '') AS spans
FROM d LEFT JOIN j ON j.doc_id = d.doc_id GROUP BY d.doc_id"""


def op12_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = collocation.collocations(read(spark, sf_dir, "documents"), most_words=3, least=10, covered=50, top=2000)
    return found.drop("with_left", "with_right")


OP12_SQL = r"""
WITH p AS (SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece FROM documents),
w AS (SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS w FROM p),
g AS (SELECT lang, k, unnest(list_transform(range(1, len(w) - k + 2), lambda s: array_to_string(w[s:s + k - 1], ' '))) AS phrase
  FROM w, (VALUES (1), (2), (3)) AS d(k) WHERE len(w) >= k),
f AS (SELECT lang, k, phrase, count(*) AS c FROM g GROUP BY ALL),
n AS (SELECT lang, CAST(sum(c) AS BIGINT) AS n FROM f WHERE k = 1 GROUP BY lang),
t AS (SELECT *, string_split(phrase, ' ') AS w FROM f WHERE k > 1 AND c >= 10),
named AS (SELECT lang || ':' || phrase AS name, c AS m FROM f WHERE c >= 10),
parts AS (SELECT lang, phrase, c AS a, i, lang || ':' || array_to_string(w[:i], ' ') AS head, lang || ':' || array_to_string(w[i + 1:], ' ') AS rest
  FROM (SELECT *, unnest(range(1, k)) AS i FROM t)),
cut AS (SELECT x.lang, x.phrase, x.a, x.i, d.m AS l, e.m AS r, 1000000 * x.a::HUGEINT * x.a::HUGEINT // (d.m::HUGEINT * e.m::HUGEINT) AS score
  FROM parts x JOIN named d ON d.name = x.head JOIN named e ON e.name = x.rest),
best AS (SELECT * FROM cut QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, i) = 1),
inner_of AS (SELECT lang, array_to_string(w[1:2], ' ') AS phrase, c FROM t WHERE k = 3
  UNION ALL SELECT lang, array_to_string(w[2:3], ' '), c FROM t WHERE k = 3),
kept AS (SELECT * FROM best b WHERE NOT EXISTS (SELECT 1 FROM inner_of o WHERE o.lang = b.lang AND o.phrase = b.phrase AND 100 * o.c >= 50 * b.a)),
ranked AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM kept)
SELECT ranked.lang, rank, phrase, a, l, r, n, CAST(score AS BIGINT) AS score FROM ranked JOIN n ON n.lang = ranked.lang WHERE rank <= 2000"""


def op13_fill_in_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = fim.transform(read(spark, sf_dir, "documents"))
    return out.select("doc_id", "n", "form", "prefix_chars", "middle_chars", F.sha2(F.col("output").cast("binary"), 256).alias("output_sha256"),
                      F.sha2(fim.restore().cast("binary"), 256).alias("restored_sha256"))


OP13_SQL = r"""
WITH h AS (SELECT doc_id, coalesce(text, '') AS text, regexp_extract_all(coalesce(text, ''), '[A-Za-z]+|[^A-Za-z]') AS tok,
  sha256('1:' || doc_id) AS d FROM documents),
c AS (SELECT doc_id, text, tok, len(tok) AS n, ('0x' || d[1:8])::BIGINT % (len(tok) + 1) AS a, ('0x' || d[9:16])::BIGINT % (len(tok) + 1) AS b,
  CASE WHEN text = '' OR contains(text, '<P>') OR contains(text, '<S>') OR contains(text, '<M>') OR ('0x' || d[17:24])::BIGINT % 100 >= 90 THEN 'plain'
    WHEN ('0x' || d[25:32])::BIGINT % 100 < 20 THEN 'spm' ELSE 'psm' END AS form FROM h),
p AS (SELECT *, array_to_string(tok[1:least(a, b)], '') AS pre, array_to_string(tok[least(a, b) + 1:greatest(a, b)], '') AS mid,
  array_to_string(tok[greatest(a, b) + 1:], '') AS suf FROM c)
SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN length(pre) END AS prefix_chars, CASE WHEN form <> 'plain' THEN length(mid) END AS middle_chars,
  sha256(CASE form WHEN 'plain' THEN text WHEN 'spm' THEN '<S>' || suf || '<P>' || pre || '<M>' || mid ELSE '<P>' || pre || '<S>' || suf || '<M>' || mid END) AS output_sha256,
  sha256(pre || mid || suf) AS restored_sha256
FROM p"""


QUERIES = {
    "op1_embedding_dedup": op1_embedding_dedup,
    "op2_lm_score": op2_lm_score,
    "op3_bpe": op3_bpe,
    "op4_sharding": op4_sharding,
    "op5_token_count": op5_token_count,
    "op6_language": op6_language,
    "op7_toxicity": op7_toxicity,
    "op8_chat_format": op8_chat_format,
    "op9_simhash": op9_simhash,
    "op10_decontamination": op10_decontamination,
    "op11_secret_scan": op11_secret_scan,
    "op12_collocations": op12_collocations,
    "op13_fill_in_middle": op13_fill_in_middle,
}


def oracles() -> dict[str, str]:
    return {"op8_chat_format": OP8_SQL, "op11_secret_scan": OP11_SQL, "op12_collocations": OP12_SQL,
            "op13_fill_in_middle": OP13_SQL}

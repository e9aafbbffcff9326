"""Registered queries over the shared test tables, each with (where SQL can
express it) an independent DuckDB oracle.

Every query reads whole tables (or data Spark derives from them); nothing is
restricted to id subsets.  Floating outputs are rounded to 6 decimals on both
sides so order-dependent summation does not break value hashes.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions import features as FT
from ..functions import text as T
from ..functions.constants import LEARNING_FRACTIONS, MONEY_KEYWORDS, NO_DESCRIPTION
from ..operators import clusters as CL
from ..operators import dedup as DD
from ..operators import eda as EDA
from ..operators import interpret as IP
from ..operators import metrics as MT
from ..operators import pages as PG
from ..operators import quality as QL
from ..operators import sampling as SM
from ..operators import tfidf as TF
from ..operators.models import MAX_FEATURES
from ..functions.barrier import materialize
from ..session import scratch_path
from ..sources import files as SF
from . import sqltext as S
from .tables import labelled, master, predictions, table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    def deco(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql.strip()
        return fn
    return deco


def r6(c):
    return F.round(c, 6)


# ---------------------------------------------------------------------------
# Flagship slice: documents ⋈ labels -> clean -> min length -> dedup -> distribution
# ---------------------------------------------------------------------------

def cleaned_master(spark, d):
    m = QL.drop_unlabelled(master(spark, d))
    return QL.min_length(materialize(m, "text", T.clean_base("text")))


def deduped(spark, d):
    return DD.dedup_keep_first(cleaned_master(spark, d))


@register("label_distribution", f"""
WITH {S.LABELLED_CTE},
c AS (SELECT {S.clean_base('text')} AS text, label, source_file, record_id FROM labelled),
f AS (SELECT * FROM c WHERE length(trim(text)) >= 50),
d AS (SELECT text, arg_min(label, (source_file, record_id)) AS label FROM f GROUP BY text)
SELECT label, count(*) AS n_rows, round(count(*) * 100.0 / sum(count(*)) OVER (), 4) AS share_pct FROM d GROUP BY label
""")
def q_label_distribution(spark, d):
    return EDA.label_distribution(deduped(spark, d))


@register("dedup_keep_first", f"""
WITH {S.LABELLED_CTE},
c AS (SELECT {S.clean_base('text')} AS text, label, source_file, source_name, record_id FROM labelled),
f AS (SELECT * FROM c WHERE length(trim(text)) >= 50)
SELECT text, arg_min(label, (source_file, record_id)) AS label, arg_min(source_file, (source_file, record_id)) AS source_file,
       arg_min(source_name, (source_file, record_id)) AS source_name, arg_min(record_id, (source_file, record_id)) AS record_id
FROM f GROUP BY text
""")
def q_dedup_keep_first(spark, d):
    return deduped(spark, d)


@register("dedup_report", f"""
WITH {S.LABELLED_CTE},
c AS (SELECT {S.clean_base('text')} AS text FROM labelled),
f AS (SELECT * FROM c WHERE length(trim(text)) >= 50)
SELECT count(*) AS rows_before, count(DISTINCT text) AS rows_after, count(*) - count(DISTINCT text) AS removed FROM f
""")
def q_dedup_report(spark, d):
    return DD.dedup_report(cleaned_master(spark, d))


@register("master", f"WITH {S.MASTER_CTE} SELECT * FROM master")
def q_master(spark, d):
    return master(spark, d)


@register("drop_unlabelled", f"WITH {S.LABELLED_CTE} SELECT * FROM labelled")
def q_drop_unlabelled(spark, d):
    return QL.drop_unlabelled(master(spark, d))


@register("load_labelled", f"WITH {S.LABELLED_CTE} SELECT record_id, text, label, source_file FROM labelled")
def q_load_labelled(spark, d):
    """The master written as a split, loaded again with its required columns."""
    path = scratch_path(spark, "labelled-split")
    master(spark, d).write.parquet(path)
    return SF.load_labelled(spark, path).select("record_id", "text", "label", "source_file")


@register("provenance", """
WITH f AS (SELECT doc_id, lang, source || ',part.csv' AS name, doc_id % 3 = 0 AS top FROM documents)
SELECT doc_id, replace(name, ',', ';') AS source_file, CASE WHEN top THEN 'corpus' ELSE lang END AS source_name,
  doc_id - min(doc_id) OVER (PARTITION BY top, CASE WHEN NOT top THEN lang END, name) AS record_id FROM f""")
def q_provenance(spark, d):
    """Rows of files below /data/corpus, a third of them at the top and the
    others in a folder for each language."""
    name = F.concat("source", F.lit(",part.csv"))
    folder = F.when(F.col("doc_id") % 3 == 0, "").otherwise(F.concat("lang", F.lit("/")))
    rows = table(spark, d, "documents").select("doc_id", F.concat(F.lit("file:///data/corpus/"), folder, name).alias("_file_path"),
                                               name.alias("_file_name"), F.col("doc_id").alias("_mid"))
    return SF.with_provenance(rows, "/data/corpus").select("doc_id", "source_file", "source_name", "record_id")


# ---------------------------------------------------------------------------
# Cleaners and scalar text functions
# ---------------------------------------------------------------------------

@register("clean_base", f"SELECT doc_id, {S.clean_base('text')} AS clean_text FROM documents")
def q_clean_base(spark, d):
    return table(spark, d, "documents").select("doc_id", T.clean_base("text").alias("clean_text"))


@register("clean_aggressive", f"SELECT doc_id, {S.clean_aggressive('text')} AS clean_text FROM documents")
def q_clean_aggressive(spark, d):
    return table(spark, d, "documents").select("doc_id", T.clean_aggressive("text").alias("clean_text"))


@register("clean_gentle", f"SELECT doc_id, {S.clean_gentle('text')} AS clean_text FROM documents")
def q_clean_gentle(spark, d):
    return table(spark, d, "documents").select("doc_id", T.clean_gentle("text").alias("clean_text"))


@register("qp_repair")
def q_qp_repair(spark, d):
    """General quoted-printable repair over documents and page HTML (oracle:
    unit vectors in tests; SQL has no byte-level decoder)."""
    docs = table(spark, d, "documents").select(F.concat(F.lit("d"), F.col("doc_id")).alias("id"), F.col("text"))
    pages = table(spark, d, "pages").select(F.concat(F.lit("p"), F.col("page_id")).alias("id"), F.col("html").alias("text"))
    return docs.unionByName(pages).select("id", T.qp_repair("text").alias("repaired"))


_ENTITY_SQL = ("replace(replace(replace(replace(replace(replace(replace({x}, '&quot;', '\"'), '&middot;', '·'), "
               "'&copy;', '©'), '&lt;', '<'), '&gt;', '>'), '&nbsp;', chr(160)), '&amp;', '&')")


_TAG_SQL = r"""</?[a-zA-Z](?:[^>"']|"[^"]*"|'[^']*')*>"""


def _html_sql(x: str) -> str:
    t = f"regexp_replace({x}, '(?is)<script\\b[^>]*(>.*?(</script\\s*>|$)|$)', ' ', 'g')"
    t = f"regexp_replace({t}, '(?is)<style\\b[^>]*(>.*?(</style\\s*>|$)|$)', ' ', 'g')"
    t = f"regexp_replace({t}, '(?s)<!--.*?(-->|$)', ' ', 'g')"
    t = f"regexp_replace({t}, '<![^>]*>|<\\?[^>]*>', ' ', 'g')"
    t = f"regexp_replace({t}, {S.q(_TAG_SQL)}, ' ', 'g')"
    return _ENTITY_SQL.format(x=t)


@register("html_strip", f"SELECT page_id, {S.collapse(_html_sql('html'))} AS page_text FROM pages")
def q_html_strip(spark, d):
    """HTML -> text over stored pages (the oracle decodes the entity names
    present in the pages; Spark decodes every HTML 4 name and numeric refs)."""
    return table(spark, d, "pages").select("page_id", T.collapse_ws(T.html_to_text("html")).alias("page_text"))


@register("mask_urls", f"""
SELECT page_id, {S.url_mask("lower('Visit ' || url || ' or www.' || page_id || '.example.org/x NOW!')", '[url]')} AS masked_base,
       {S.url_mask("'Visit ' || url || ' or www.' || page_id || '.example.org/x NOW!'", ' [URL] ')} AS masked_gentle
FROM pages""")
def q_mask_urls(spark, d):
    s = F.concat(F.lit("Visit "), F.col("url"), F.lit(" or www."), F.col("page_id").cast("string"), F.lit(".example.org/x NOW!"))
    return table(spark, d, "pages").select("page_id", T.mask_urls(F.lower(s), "[url]").alias("masked_base"),
                                           T.mask_urls(s, " [URL] ").alias("masked_gentle"))


@register("mask_emails", f"""
SELECT doc_id, {S.email_mask(f"lower({S.qp_ascii('text')})", '[email]')} AS masked_lower,
       {S.email_mask(S.qp_ascii('text'), ' [EMAIL] ', mixed=True)} AS masked_mixed
FROM documents""")
def q_mask_emails(spark, d):
    t = table(spark, d, "documents").select("doc_id", T.qp_repair("text").alias("t"))
    return t.select("doc_id", T.mask_emails(F.lower("t"), "[email]").alias("masked_lower"),
                    T.mask_emails("t", " [EMAIL] ", mixed_case=True).alias("masked_mixed"))


@register("expand_contractions", f"""
SELECT conv_id, turn, {S.contractions("text || ' I can''t say they''re sure it''s what we''d do, you''ll see we''ve I''m'")} AS expanded
FROM conversations""")
def q_expand_contractions(spark, d):
    s = F.concat(F.col("text"), F.lit(" I can't say they're sure it's what we'd do, you'll see we've I'm"))
    return table(spark, d, "conversations").select("conv_id", "turn", T.expand_contractions(s).alias("expanded"))


@register("metadata_features", f"""
SELECT doc_id, CAST(length(text) AS INTEGER) AS text_length, CAST(len({S.words('text')}) AS INTEGER) AS word_count,
       CAST(length(regexp_replace(text, '[^!-/:-@\\[-`{{-~]', '', 'g')) AS INTEGER) AS punct_count,
       CAST(len(list_filter({S.words('text')}, lambda w: upper(w) = w AND lower(w) <> w)) AS INTEGER) AS upper_count
FROM documents""")
def q_metadata_features(spark, d):
    return table(spark, d, "documents").select("doc_id", *FT.metadata_columns("text"))


@register("label_names", f"""
WITH {S.MASTER_CTE}
SELECT label, CASE label WHEN 0 THEN 'Not Phishing (0)' WHEN 1 THEN 'Phishing (1)' END AS name_eda,
       CASE label WHEN 0 THEN 'Great' WHEN 1 THEN 'Bait' END AS name_short,
       CASE label WHEN 0 THEN 'Not Phishing' WHEN 1 THEN 'Phishing' END AS name_plain, count(*) AS n_rows
FROM master GROUP BY label""")
def q_label_names(spark, d):
    m = master(spark, d).groupBy("label").agg(F.count(F.lit(1)).alias("n_rows"))
    return m.select("label", FT.label_name("label", "eda").alias("name_eda"), FT.label_name("label", "short").alias("name_short"),
                    FT.label_name("label", "plain").alias("name_plain"), "n_rows")


@register("label_standardise", f"""
WITH raw AS (
  SELECT CAST(l.toxic AS VARCHAR) AS raw_label FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id
  UNION ALL SELECT role FROM conversations
  UNION ALL SELECT CASE WHEN quality = 1 THEN ' SPAM ' ELSE 'Safe Email' END FROM labels)
SELECT raw_label, CASE lower({S.strip('raw_label')}) WHEN 'phishing email' THEN 1 WHEN '1.0' THEN 1 WHEN '1' THEN 1
  WHEN 'spam' THEN 1 WHEN 'safe email' THEN 0 WHEN '0.0' THEN 0 WHEN '0' THEN 0 WHEN 'ham' THEN 0
  WHEN 'not phishing' THEN 0 END AS label, count(*) AS n_rows
FROM raw GROUP BY raw_label""")
def q_label_standardise(spark, d):
    return _drift_raw(spark, d).groupBy("raw_label").agg(F.count(F.lit(1)).alias("n_rows")) \
        .select("raw_label", T.standardise_label("raw_label").alias("label"), "n_rows")


def _drift_raw(spark, d):
    docs = master(spark, d).select(F.col("label").cast("string").alias("raw_label"))
    conv = table(spark, d, "conversations").select(F.col("role").alias("raw_label"))
    lab = table(spark, d, "labels").select(F.when(F.col("quality") == 1, " SPAM ").otherwise("Safe Email").alias("raw_label"))
    return docs.unionByName(conv).unionByName(lab)


def _drift_frames(spark, d):
    """Three sources with different headers, as heterogeneous raw files are:
    documents (text, label), conversations (body, Class), benchmark (Email Text)."""
    docs = master(spark, d).select("text", F.col("label").cast("string").alias("label"), "source_file",
                                   F.col("record_id"))
    conv = table(spark, d, "conversations").select(
        F.col("text").alias("body"), F.col("role").alias("Class"), F.lit("conversations").alias("source_file"),
        (F.col("conv_id") * 100 + F.col("turn")).alias("record_id"))
    bench = table(spark, d, "benchmark").select(
        F.col("text").alias("Email Text"), F.lit("benchmark").alias("source_file"), F.col("item_id").alias("record_id"))
    return DD.union_all([docs, conv, bench])


@register("union_schema_drift", f"""
WITH u AS (
  SELECT d.text AS text, NULL AS "Email Text", NULL AS body, CAST(l.toxic AS VARCHAR) AS label, NULL AS "Class",
         d.source AS source_file, d.doc_id AS record_id
  FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id
  UNION ALL SELECT NULL, NULL, text, NULL, role, 'conversations', conv_id * 100 + turn FROM conversations
  UNION ALL SELECT NULL, text, NULL, NULL, NULL, 'benchmark', item_id FROM benchmark)
SELECT coalesce(text, "Email Text", body) AS text, coalesce(label, "Class") AS raw_label,
  CASE lower({S.strip('coalesce(label, "Class")')}) WHEN 'phishing email' THEN 1 WHEN '1.0' THEN 1 WHEN '1' THEN 1
  WHEN 'spam' THEN 1 WHEN 'safe email' THEN 0 WHEN '0.0' THEN 0 WHEN '0' THEN 0 WHEN 'ham' THEN 0
  WHEN 'not phishing' THEN 0 END AS label, source_file, record_id FROM u""")
def q_union_schema_drift(spark, d):
    u = _drift_frames(spark, d)
    cols = u.columns
    raw = T.consolidate(cols, ["label", "Email Type", "Class"])
    return u.select(T.consolidate(cols, ["text", "Email Text", "Text", "body"]).alias("text"), raw.alias("raw_label"),
                    T.standardise_label(raw).alias("label"), "source_file", "record_id")


@register("unmapped_labels", f"""
WITH u AS (SELECT CAST(l.toxic AS VARCHAR) AS raw FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id
           UNION ALL SELECT role FROM conversations)
SELECT raw AS raw_label, count(*) AS n_rows FROM u
WHERE raw IS NOT NULL AND lower({S.strip('raw')}) NOT IN ('phishing email','1.0','1','spam','safe email','0.0','0','ham','not phishing')
GROUP BY raw""")
def q_unmapped_labels(spark, d):
    u = _drift_frames(spark, d)
    raw = T.consolidate(u.columns, ["label", "Email Type", "Class"])
    return QL.unmapped_labels(u.select(raw.alias("raw_label"), T.standardise_label(raw).alias("label")))


@register("text_preview", """
SELECT doc_id, CASE WHEN length(text) > 100 THEN substr(text, 1, 100) || '...' ELSE text END AS preview,
       CASE WHEN length(replace(text, chr(10), ' ')) > 150 THEN substr(replace(text, chr(10), ' '), 1, 150) || '...'
            ELSE replace(text, chr(10), ' ') END AS preview_line
FROM documents""")
def q_text_preview(spark, d):
    return table(spark, d, "documents").select("doc_id", T.preview("text", 100).alias("preview"),
                                               T.preview("text", 150, single_line=True).alias("preview_line"))


@register("format_params", """
WITH s AS (SELECT source, sum(n_chars) * 997 AS n FROM documents GROUP BY source
           UNION ALL SELECT lang, sum(n_chars) * 1000003 FROM documents GROUP BY lang
           UNION ALL SELECT 'all', count(*) FROM documents)
SELECT source AS name, n, CASE WHEN n >= 1000000000 THEN printf('%.2f', n / 1e9) || 'B'
  WHEN n >= 1000000 THEN printf('%.1f', n / 1e6) || 'M' WHEN n >= 1000 THEN printf('%.1f', n / 1e3) || 'K'
  ELSE CAST(n AS VARCHAR) END AS formatted FROM s""")
def q_format_params(spark, d):
    docs = table(spark, d, "documents")
    s = docs.groupBy(F.col("source").alias("name")).agg((F.sum("n_chars") * 997).alias("n")) \
        .unionByName(docs.groupBy(F.col("lang").alias("name")).agg((F.sum("n_chars") * 1000003).alias("n"))) \
        .unionByName(docs.agg(F.count(F.lit(1)).alias("n")).select(F.lit("all").alias("name"), "n"))
    return s.select("name", "n", FT.format_count(F.col("n")).alias("formatted"))


@register("keyword_tags", f"""
SELECT doc_id, list_filter({[k for k in MONEY_KEYWORDS]}, lambda k: contains(lower(text), k)) AS keywords FROM documents""")
def q_keyword_tags(spark, d):
    return table(spark, d, "documents").select("doc_id", FT.keyword_tags("text").alias("keywords"))


@register("first_message", """
WITH t AS (
  SELECT conv_id, string_agg(CASE WHEN turn = 0 THEN text ELSE
      CASE role WHEN 'assistant' THEN chr(10) || 'From: ' WHEN 'user' THEN chr(10) || 'Sent: ' ELSE chr(10) || '<html >' END || text END,
      '' ORDER BY turn) AS thread
  FROM conversations GROUP BY conv_id),
p AS (SELECT conv_id, thread, coalesce(nullif(instr(thread, 'From:'), 0), nullif(instr(thread, 'Sent:'), 0), nullif(instr(thread, '<html '), 0)) AS pos FROM t)
SELECT conv_id, CASE WHEN pos IS NOT NULL THEN substr(thread, 1, pos - 1) ELSE substr(thread, 1, greatest(length(thread) - 1, 0)) END AS first_message,
       'Not Phishing' AS label
FROM p WHERE length(CASE WHEN pos IS NOT NULL THEN substr(thread, 1, pos - 1) ELSE substr(thread, 1, greatest(length(thread) - 1, 0)) END) <= 500""")
def q_first_message(spark, d):
    th = PG.build_threads(table(spark, d, "conversations"))
    out = th.select("conv_id", QL.first_message("thread").alias("first_message"), F.lit("Not Phishing").alias("label"))
    return out.filter(F.length("first_message") <= 500)


@register("label_encode", """
WITH u AS (SELECT DISTINCT role FROM conversations)
SELECT role, CAST(row_number() OVER (ORDER BY role) - 1 AS INTEGER) AS label_index FROM u""")
def q_label_encode(spark, d):
    roles = table(spark, d, "conversations").select("role").distinct()
    return roles.select("role", (F.row_number().over(Window.orderBy("role")) - 1).cast("int").alias("label_index"))


# ---------------------------------------------------------------------------
# Filters / quality
# ---------------------------------------------------------------------------

@register("min_length", f"""
WITH {S.LABELLED_CTE}, c AS (SELECT {S.clean_base('text')} AS text, label, source_file, source_name, record_id FROM labelled)
SELECT * FROM c WHERE length(trim(text)) >= 50""")
def q_min_length(spark, d):
    return cleaned_master(spark, d)


@register("token_band", f"""
WITH {S.LABELLED_CTE}, c AS (SELECT {S.clean_aggressive('text')} AS text, label, record_id FROM labelled)
SELECT * FROM c WHERE length(trim(text)) > 0 AND len({S.words('text')}) BETWEEN 5 AND 2000""")
def q_token_band(spark, d):
    c = materialize(labelled(spark, d).select("text", "label", "record_id"), "text", T.clean_aggressive("text"))
    return QL.token_band(QL.non_empty(c))


@register("completeness", f"""
WITH {S.MASTER_CTE},
m AS (SELECT record_id + 1 AS row_no, CAST(label AS VARCHAR) AS label, source_file, source_name FROM master),
hits AS (SELECT row_no, 'empty_label' AS issue FROM m WHERE label IS NULL OR trim(label) = '' OR lower(trim(label)) IN ('nan','none','null')
  UNION ALL SELECT row_no, 'empty_source_file' FROM m WHERE source_file IS NULL OR trim(source_file) = '' OR lower(trim(source_file)) IN ('nan','none','null')
  UNION ALL SELECT row_no, 'empty_source_name' FROM m WHERE source_name IS NULL OR trim(source_name) = '' OR lower(trim(source_name)) IN ('nan','none','null')),
issues AS (SELECT * FROM (VALUES ('empty_label'), ('empty_source_file'), ('empty_source_name')) v(issue)),
firsts AS (SELECT issue, list_sort(list(row_no)) AS first_rows, count(*) AS n FROM
  (SELECT *, row_number() OVER (PARTITION BY issue ORDER BY row_no) AS r FROM hits) WHERE r <= 10 GROUP BY issue),
counts AS (SELECT issue, count(*) AS n_rows FROM hits GROUP BY issue)
SELECT i.issue, coalesce(c.n_rows, 0) AS n_rows, coalesce(f.first_rows, []) AS first_rows
FROM issues i LEFT JOIN counts c USING (issue) LEFT JOIN firsts f USING (issue)""")
def q_completeness(spark, d):
    m = master(spark, d).withColumn("row_no", F.col("record_id") + 1)
    return QL.completeness(m, "row_no")


@register("long_text", """
WITH t AS (SELECT doc_id + 1 AS row_no, length(text) AS text_length, source AS source_file,
  CASE WHEN length(text) > 20000 THEN 'extremely_long' WHEN length(text) > 10000 THEN 'very_long' END AS tier FROM documents),
f AS (SELECT * FROM t WHERE tier IS NOT NULL),
r AS (SELECT *, row_number() OVER (PARTITION BY tier ORDER BY row_no) AS example, count(*) OVER (PARTITION BY tier) AS tier_rows FROM f)
SELECT tier, row_no, CAST(text_length AS INTEGER) AS text_length, source_file, example, tier_rows FROM r WHERE example <= 5""")
def q_long_text(spark, d):
    """Thresholds scaled to the test corpus (its longest text is ~33k
    characters); the library defaults are 100k / 1M."""
    docs = table(spark, d, "documents").withColumn("row_no", F.col("doc_id") + 1)
    return QL.long_text(docs, "text", "row_no", "source", very=10_000, extremely=20_000) \
        .select("tier", "row_no", "text_length", "source_file", "example", "tier_rows")


@register("stage_report", f"""
WITH {S.MASTER_CTE},
lab AS (SELECT * FROM master WHERE label IS NOT NULL AND text IS NOT NULL),
cl AS (SELECT {S.clean_base('text')} AS text FROM lab),
ml AS (SELECT * FROM cl WHERE length(trim(text)) >= 50),
s AS (SELECT 0 AS step, 'master' AS stage, (SELECT count(*) FROM master) AS rows_after
      UNION ALL SELECT 1, 'labelled', (SELECT count(*) FROM lab)
      UNION ALL SELECT 2, 'min_length', (SELECT count(*) FROM ml)
      UNION ALL SELECT 3, 'dedup', (SELECT count(DISTINCT text) FROM ml))
SELECT step, stage, rows_after, lag(rows_after) OVER (ORDER BY step) AS rows_before,
       lag(rows_after) OVER (ORDER BY step) - rows_after AS removed FROM s""")
def q_stage_report(spark, d):
    """Texts are cleaned where they lie; only what the stages ask of them
    meets the labels."""
    docs = table(spark, d, "documents").select("doc_id", "text", F.col("text").isNotNull().alias("has_text"))
    docs = materialize(docs, "text", T.clean_base("text"))
    long_enough = F.length(F.trim("text")) >= 50
    asked = docs.select("doc_id", "has_text", long_enough.alias("long_enough"), F.when(long_enough, DD.digest("text")).alias("digest"))
    m = asked.join(table(spark, d, "labels").select("doc_id", "toxic"), "doc_id", "left")
    return QL.stage_report_once(m, [("labelled", F.col("has_text") & F.col("toxic").isNotNull()), ("min_length", F.col("long_enough"))],
                                ("dedup", F.col("digest")))


@register("error_analysis", f"""
WITH {S.PRED_CTE},
e AS (SELECT *, CASE WHEN true_label = 0 AND pred_label = 1 THEN 'false_positive' WHEN true_label = 1 AND pred_label = 0 THEN 'false_negative' END AS error_type FROM pred),
r AS (SELECT *, row_number() OVER (PARTITION BY error_type ORDER BY confidence DESC, doc_id) AS example FROM e WHERE error_type IS NOT NULL)
SELECT doc_id, true_label, pred_label, round(confidence, 6) AS confidence, error_type, example FROM r WHERE example <= 10""")
def q_error_analysis(spark, d):
    e = QL.error_analysis(predictions(spark, d))
    return e.select("doc_id", "true_label", "pred_label", r6(F.col("confidence")).alias("confidence"), "error_type", "example")


@register("correct_incorrect", f"""
WITH {S.PRED_CTE}
SELECT CASE WHEN true_label = pred_label THEN 'correct' ELSE 'incorrect' END AS outcome, count(*) AS n_rows,
       round(avg(confidence), 6) AS mean_confidence FROM pred GROUP BY 1""")
def q_correct_incorrect(spark, d):
    p = predictions(spark, d)
    return p.groupBy(F.when(F.col("true_label") == F.col("pred_label"), "correct").otherwise("incorrect").alias("outcome")) \
            .agg(F.count(F.lit(1)).alias("n_rows"), r6(F.avg("confidence")).alias("mean_confidence"))


# ---------------------------------------------------------------------------
# Split / sampling / leakage
# ---------------------------------------------------------------------------

def split_table(spark, d):
    return SM.stratified_split(labelled(spark, d))


@register("stratified_split", f"""
WITH {S.LABELLED_CTE}, {S.split_ctes('labelled')}
SELECT record_id, label, split FROM split_rows""")
def q_stratified_split(spark, d):
    return split_table(spark, d).select("record_id", "label", "split")


@register("split_sizes", f"""
WITH {S.LABELLED_CTE}, {S.split_ctes('labelled')}
SELECT split, count(*) AS n_rows, round(count(*) * 100.0 / sum(count(*)) OVER (), 4) AS pct FROM split_rows GROUP BY split""")
def q_split_sizes(spark, d):
    return EDA.split_sizes(split_table(spark, d))


@register("split_label_distribution", f"""
WITH {S.LABELLED_CTE}, {S.split_ctes('labelled')}
SELECT split, label, count(*) AS n_rows, round(count(*) * 100.0 / sum(count(*)) OVER (PARTITION BY split), 4) AS share_pct
FROM split_rows GROUP BY split, label""")
def q_split_label_distribution(spark, d):
    return EDA.split_label_distribution(split_table(spark, d))


@register("split_leakage", f"""
WITH {S.LABELLED_CTE}, {S.split_ctes('labelled')},
f AS (SELECT text, max(CAST(split = 'train' AS INTEGER)) AS a, max(CAST(split = 'validation' AS INTEGER)) AS b,
             max(CAST(split = 'test' AS INTEGER)) AS c FROM split_rows WHERE text IS NOT NULL GROUP BY text)
SELECT 'train' AS split_a, 'validation' AS split_b, CAST(coalesce(sum(a * b), 0) AS BIGINT) AS n_shared FROM f
UNION ALL SELECT 'train', 'test', CAST(coalesce(sum(a * c), 0) AS BIGINT) FROM f
UNION ALL SELECT 'validation', 'test', CAST(coalesce(sum(b * c), 0) AS BIGINT) FROM f""")
def q_split_leakage(spark, d):
    return DD.split_leakage(split_table(spark, d))


@register("benchmark_overlap", """
SELECT count(*) AS n_shared FROM (SELECT DISTINCT text FROM documents INTERSECT SELECT DISTINCT text FROM benchmark)""")
def q_benchmark_overlap(spark, d):
    s = DD.shared_texts(table(spark, d, "documents"), table(spark, d, "benchmark"))
    return s.agg(F.count(F.lit(1)).alias("n_shared"))


@register("leakage_removed", f"""
WITH {S.LABELLED_CTE}, {S.split_ctes('labelled')}
SELECT record_id, label FROM split_rows t WHERE split = 'test'
AND NOT EXISTS (SELECT 1 FROM split_rows r WHERE r.split = 'train' AND r.text = t.text)""")
def q_leakage_removed(spark, d):
    s = split_table(spark, d)
    return DD.leakage_removed(s.filter(F.col("split") == "test"), s.filter(F.col("split") == "train")) \
        .select("record_id", "label")


@register("stratified_folds", f"""
WITH {S.LABELLED_CTE}
SELECT record_id, label, CAST((row_number() OVER (PARTITION BY label ORDER BY md5('42:' || CAST(record_id AS VARCHAR)), record_id) - 1) % 5 AS INTEGER) AS fold
FROM labelled""")
def q_stratified_folds(spark, d):
    return SM.stratified_folds(labelled(spark, d)).select("record_id", "label", "fold")


_FRACS_SQL = " ".join(
    f"WHEN rk <= floor({f} * n) THEN {i}" for i, f in enumerate(LEARNING_FRACTIONS))


@register("learning_subsets", f"""
WITH {S.LABELLED_CTE},
r AS (SELECT record_id, row_number() OVER (ORDER BY md5('42:' || CAST(record_id AS VARCHAR)), record_id) AS rk, count(*) OVER () AS n FROM labelled)
SELECT record_id, CAST(CASE {_FRACS_SQL} END AS INTEGER) AS subset FROM r""")
def q_learning_subsets(spark, d):
    return SM.learning_subsets(labelled(spark, d)).select("record_id", "subset")


@register("stratified_sample", f"""
WITH {S.LABELLED_CTE},
c AS (SELECT label, count(*) AS n_label FROM labelled GROUP BY label),
c1 AS (SELECT *, least(200, sum(n_label) OVER ()) AS tot, sum(n_label) OVER () AS n_all FROM c),
c2 AS (SELECT *, (tot * n_label) // n_all AS b, (tot * n_label) % n_all AS r FROM c1),
q AS (SELECT label, b + CASE WHEN row_number() OVER (ORDER BY r DESC, label) <= tot - sum(b) OVER () THEN 1 ELSE 0 END AS quota FROM c2),
rk AS (SELECT *, row_number() OVER (PARTITION BY label ORDER BY md5('42:' || CAST(record_id AS VARCHAR)), record_id) AS rk FROM labelled)
SELECT record_id, label FROM rk JOIN q USING (label) WHERE rk <= quota""")
def q_stratified_sample(spark, d):
    return SM.stratified_sample(labelled(spark, d), 200).select("record_id", "label")


@register("sample_and_combine", f"""
WITH {S.LABELLED_CTE},
d1 AS (SELECT * FROM labelled WHERE source_name IS NOT DISTINCT FROM 'en'),
d2 AS (SELECT * FROM labelled WHERE source_name IS DISTINCT FROM 'en'),
r AS (SELECT *, row_number() OVER (ORDER BY md5('42:' || CAST(record_id AS VARCHAR)), record_id) AS rk FROM d1)
SELECT record_id, label, 'd1' AS origin FROM r WHERE rk <= greatest(100000 - (SELECT count(*) FROM d2), 0)
UNION ALL SELECT record_id, label, 'd2' FROM d2""")
def q_sample_and_combine(spark, d):
    lab = labelled(spark, d)
    en = F.col("source_name").eqNullSafe("en")  # a null language is not 'en'; its rows stay
    out = SM.sample_and_combine(lab.filter(en), lab.filter(~en), "record_id")
    return out.select("record_id", "label", "origin")


@register("shuffled", f"""
WITH {S.LABELLED_CTE}
SELECT record_id, label, row_number() OVER (ORDER BY md5('42:' || CAST(record_id AS VARCHAR)), record_id) - 1 AS row_index FROM labelled""")
def q_shuffled(spark, d):
    return SM.shuffled(labelled(spark, d), "record_id").select("record_id", "label", "row_index")


@register("inspection_sample", f"""
WITH {S.LABELLED_CTE},
c AS (SELECT label, count(*) AS n_label, CASE label WHEN 0 THEN 3 WHEN 1 THEN 2 ELSE 0 END AS want FROM labelled GROUP BY label),
c1 AS (SELECT *, least(want, n_label) AS got FROM c),
c2 AS (SELECT *, sum(want - got) OVER () AS short FROM c1),
c3 AS (SELECT *, least(n_label, got + short) AS q0 FROM c2),
q AS (SELECT label, CASE WHEN sum(q0) OVER () > 5 THEN got ELSE q0 END AS quota FROM c3),
rk AS (SELECT *, row_number() OVER (PARTITION BY label ORDER BY md5('42:' || CAST(record_id AS VARCHAR)), record_id) AS rk FROM labelled)
SELECT record_id, label FROM rk JOIN q USING (label) WHERE rk <= quota""")
def q_inspection_sample(spark, d):
    return SM.inspection_sample(labelled(spark, d)).select("record_id", "label")


@register("balanced_resample", f"""
WITH {S.LABELLED_CTE},
rk AS (SELECT *, row_number() OVER (PARTITION BY label ORDER BY md5('42:' || CAST(record_id AS VARCHAR)), record_id) AS r FROM labelled),
c AS (SELECT label, count(*) AS n_c, row_number() OVER (ORDER BY label) - 1 AS ci FROM labelled GROUP BY label),
dr AS (SELECT unnest(range((SELECT count(*) FROM labelled))) AS draw),
p AS (SELECT draw, label, 1 + ('0x' || substr(md5('42:draw:' || CAST(draw AS VARCHAR)), 1, 15))::BIGINT % n_c AS pick
  FROM dr JOIN c ON draw % (SELECT count(*) FROM c) = ci)
SELECT p.draw, rk.record_id, rk.label FROM p JOIN rk ON rk.label = p.label AND rk.r = p.pick""")
def q_balanced_resample(spark, d):
    return SM.balanced_resample(labelled(spark, d)).select("draw", "record_id", "label")


# ---------------------------------------------------------------------------
# EDA
# ---------------------------------------------------------------------------

@register("top_sources_by_label", f"""
WITH {S.LABELLED_CTE},
t AS (SELECT source_file, count(*) AS source_rows FROM labelled GROUP BY source_file ORDER BY source_rows DESC, source_file LIMIT 10),
tr AS (SELECT *, row_number() OVER (ORDER BY source_rows DESC, source_file) AS source_rank FROM t)
SELECT l.source_file, l.label, count(*) AS n_rows, any_value(tr.source_rows) AS source_rows, any_value(tr.source_rank) AS source_rank
FROM labelled l JOIN tr USING (source_file) GROUP BY l.source_file, l.label""")
def q_top_sources_by_label(spark, d):
    return EDA.top_sources_by_label(labelled(spark, d)).select("source_file", "label", "n_rows", "source_rows", "source_rank")


def _features_table(spark, d):
    lab = labelled(spark, d).select("record_id", "label", T.clean_aggressive("text").alias("clean"))
    return lab.select("record_id", "label", *FT.metadata_columns("clean"))


_FEAT_SQL = f"""
WITH {S.LABELLED_CTE},
c AS (SELECT record_id, label, {S.clean_aggressive('text')} AS t FROM labelled),
f AS (SELECT record_id, label, CAST(length(t) AS DOUBLE) AS text_length, CAST(len({S.words('t')}) AS DOUBLE) AS word_count,
      CAST(length(regexp_replace(t, '[^!-/:-@\\[-`{{-~]', '', 'g')) AS DOUBLE) AS punct_count,
      CAST(len(list_filter({S.words('t')}, lambda w: upper(w) = w AND lower(w) <> w)) AS DOUBLE) AS upper_count FROM c),
long AS (SELECT label, 'text_length' AS feature, text_length AS value FROM f UNION ALL SELECT label, 'word_count', word_count FROM f
         UNION ALL SELECT label, 'punct_count', punct_count FROM f UNION ALL SELECT label, 'upper_count', upper_count FROM f)"""


@register("feature_histogram", _FEAT_SQL + """,
b AS (SELECT feature, min(value) AS lo, max(value) AS hi FROM long GROUP BY feature),
j AS (SELECT l.*, lo, hi, CAST(CASE WHEN hi - lo > 0 THEN least(floor((value - lo) / (hi - lo) * 50), 49) ELSE 0 END AS INTEGER) AS bin FROM long l JOIN b USING (feature))
SELECT feature, label, bin, round(lo + bin * (hi - lo) / 50, 6) AS bin_lo, round(lo + (bin + 1) * (hi - lo) / 50, 6) AS bin_hi, count(*) AS n_rows
FROM j GROUP BY feature, label, bin, lo, hi""")
def q_feature_histogram(spark, d):
    h = EDA.feature_histogram(_features_table(spark, d))
    return h.select("feature", "label", "bin", r6(F.col("bin_lo")).alias("bin_lo"), r6(F.col("bin_hi")).alias("bin_hi"), "n_rows")


@register("feature_p99", _FEAT_SQL + """
SELECT feature, round(quantile_cont(value, 0.99), 6) AS p99 FROM long GROUP BY feature""")
def q_feature_p99(spark, d):
    return EDA.feature_p99(_features_table(spark, d)).select("feature", r6(F.col("p99")).alias("p99"))


_CORR_COLS = ["label", "text_length", "word_count", "punct_count", "upper_count"]


def _corr_sql() -> str:
    parts = []
    for a in _CORR_COLS:
        for b in _CORR_COLS:
            if a == b:
                val = f"CASE WHEN stddev_pop({a}) > 0 THEN 1.0 END"
            else:
                val = f"CASE WHEN stddev_pop({a}) * stddev_pop({b}) > 0 THEN covar_pop({a}, {b}) / (stddev_pop({a}) * stddev_pop({b})) END"
            parts.append(f"SELECT '{a}' AS feature_a, '{b}' AS feature_b, round(CAST({val} AS DOUBLE), 6) AS corr FROM g")
    return _FEAT_SQL + ", g AS (SELECT CAST(label AS DOUBLE) AS label, text_length, word_count, punct_count, upper_count FROM f)\n" + \
        "\nUNION ALL ".join(parts)


@register("feature_correlation", _corr_sql())
def q_feature_correlation(spark, d):
    c = EDA.feature_correlation(_features_table(spark, d), _CORR_COLS)
    return c.select("feature_a", "feature_b", r6(F.col("corr")).alias("corr"))


def _ml_clean(spark, d):
    return labelled(spark, d).select("record_id", "label", T.clean_aggressive("text").alias("text"))


@register("top_ngrams", f"""
WITH {S.LABELLED_CTE},
c AS (SELECT label, {S.tokens_no_stop(S.clean_aggressive('text'))} AS toks FROM labelled),
g AS (SELECT label, 1 AS n, unnest(toks) AS term FROM c UNION ALL SELECT label, 2, unnest({S.bigrams('toks')}) FROM c),
cnt AS (SELECT label, n, term, count(*) AS n_count FROM g GROUP BY label, n, term),
r AS (SELECT *, row_number() OVER (PARTITION BY label, n ORDER BY n_count DESC, term) AS rank FROM cnt)
SELECT label, n, term, n_count, rank FROM r WHERE rank <= 20""")
def q_top_ngrams(spark, d):
    return EDA.top_ngrams(_ml_clean(spark, d)).select("label", "n", "term", "n_count", "rank")


@register("word_frequencies", f"""
WITH {S.LABELLED_CTE}, {S.split_ctes('labelled')},
w AS (SELECT split, label, unnest({S.tokens_no_stop(S.clean_gentle('text'))}) AS word FROM split_rows),
wc AS (SELECT split, label, word, count(*) AS n_count FROM w GROUP BY split, label, word),
r AS (SELECT *, row_number() OVER (PARTITION BY split, label ORDER BY n_count DESC, word) AS rank FROM wc)
SELECT split, label, word, n_count, rank, round(n_count / max(n_count) OVER (PARTITION BY split, label), 6) AS scale FROM r WHERE rank <= 100""")
def q_word_frequencies(spark, d):
    s = split_table(spark, d).withColumn("text", T.clean_gentle("text"))
    w = EDA.word_frequencies(s, "text", ("split", "label"))
    return w.select("split", "label", "word", "n_count", "rank", r6(F.col("scale")).alias("scale"))


@register("class_weights", f"""
WITH {S.LABELLED_CTE}, c AS (SELECT label, count(*) AS n_label FROM labelled GROUP BY label)
SELECT label, n_label, round(sum(n_label) OVER () / (count(*) OVER () * n_label), 6) AS weight FROM c""")
def q_class_weights(spark, d):
    return EDA.class_weights(labelled(spark, d)).select("label", "n_label", r6(F.col("weight")).alias("weight"))


@register("sample_weights", f"""
WITH {S.LABELLED_CTE}
SELECT record_id, label, round(1.0 / count(*) OVER (PARTITION BY label), 9) AS sample_weight FROM labelled""")
def q_sample_weights(spark, d):
    return EDA.sample_weights(labelled(spark, d)).select("record_id", "label", F.round("sample_weight", 9).alias("sample_weight"))


# ---------------------------------------------------------------------------
# Metrics on a scored table
# ---------------------------------------------------------------------------

_CM_SQL = f"""WITH {S.PRED_CTE},
grid AS (SELECT t, p FROM (VALUES (0), (1)) a(t), (VALUES (0), (1)) b(p)),
cm AS (SELECT g.t AS true_label, g.p AS pred_label, count(pred.doc_id) AS n FROM grid g
       LEFT JOIN pred ON pred.true_label = g.t AND pred.pred_label = g.p GROUP BY g.t, g.p)"""


@register("confusion_matrix", _CM_SQL + " SELECT * FROM cm")
def q_confusion_matrix(spark, d):
    return MT.confusion_matrix(predictions(spark, d))


_REPORT_SQL = _CM_SQL + """,
per AS (SELECT c AS cls,
  (SELECT n FROM cm WHERE true_label = c AND pred_label = c) AS tp,
  (SELECT sum(n) FROM cm WHERE true_label = c) AS support,
  (SELECT sum(n) FROM cm WHERE pred_label = c) AS predicted FROM (VALUES (0), (1)) v(c)),
p2 AS (SELECT *, CASE WHEN predicted <> 0 THEN tp / predicted ELSE 0.0 END AS precision,
  CASE WHEN support <> 0 THEN tp / support ELSE 0.0 END AS recall FROM per),
p3 AS (SELECT *, CASE WHEN precision + recall <> 0 THEN 2 * precision * recall / (precision + recall) ELSE 0.0 END AS f1 FROM p2),
rep AS (
  SELECT CAST(cls AS VARCHAR) AS "row", precision, recall, f1, CAST(support AS BIGINT) AS support FROM p3
  UNION ALL SELECT 'accuracy', sum(tp) / sum(support), sum(tp) / sum(support), sum(tp) / sum(support), CAST(sum(support) AS BIGINT) FROM p3
  UNION ALL SELECT 'macro avg', avg(precision), avg(recall), avg(f1), CAST(sum(support) AS BIGINT) FROM p3
  UNION ALL SELECT 'weighted avg', sum(precision * support) / sum(support), sum(recall * support) / sum(support),
                   sum(f1 * support) / sum(support), CAST(sum(support) AS BIGINT) FROM p3)"""


@register("classification_report", _REPORT_SQL + """
SELECT "row", round(precision, 6) AS precision, round(recall, 6) AS recall, round(f1, 6) AS f1, support FROM rep""")
def q_classification_report(spark, d):
    rep = MT.classification_report(MT.confusion_matrix(predictions(spark, d)))
    return rep.select("row", r6(F.col("precision")).alias("precision"), r6(F.col("recall")).alias("recall"),
                      r6(F.col("f1")).alias("f1"), "support")


@register("weighted_metrics", _REPORT_SQL + """
SELECT round(max(CASE WHEN "row" = 'accuracy' THEN f1 END), 6) AS accuracy,
       round(max(CASE WHEN "row" = 'weighted avg' THEN precision END), 6) AS weighted_precision,
       round(max(CASE WHEN "row" = 'weighted avg' THEN recall END), 6) AS weighted_recall,
       round(max(CASE WHEN "row" = 'weighted avg' THEN f1 END), 6) AS weighted_f1 FROM rep""")
def q_weighted_metrics(spark, d):
    w = MT.weighted_metrics(MT.confusion_matrix(predictions(spark, d)))
    return w.select(*[r6(F.col(c)).alias(c) for c in w.columns])


@register("binary_metrics", f"""
WITH {S.PRED_CTE},
s AS (SELECT sum(CAST(true_label = 1 AND pred_label = 1 AS BIGINT)) AS tp, sum(CAST(true_label <> 1 AND pred_label = 1 AS BIGINT)) AS fp,
             sum(CAST(true_label = 1 AND pred_label <> 1 AS BIGINT)) AS fn, sum(CAST(true_label <> 1 AND pred_label <> 1 AS BIGINT)) AS tn FROM pred),
p AS (SELECT *, CASE WHEN tp + fp <> 0 THEN tp / (tp + fp) ELSE 0.0 END AS precision, CASE WHEN tp + fn <> 0 THEN tp / (tp + fn) ELSE 0.0 END AS recall FROM s)
SELECT tp, fp, fn, tn, round(precision, 6) AS precision, round(recall, 6) AS recall,
  round(CASE WHEN precision + recall <> 0 THEN 2 * precision * recall / (precision + recall) ELSE 0.0 END, 6) AS f1,
  round((tp + tn) / (tp + fp + fn + tn), 6) AS accuracy FROM p""")
def q_binary_metrics(spark, d):
    b = MT.binary_metrics(predictions(spark, d))
    return b.select("tp", "fp", "fn", "tn", *[r6(F.col(c)).alias(c) for c in ["precision", "recall", "f1", "accuracy"]])


@register("inference_summary", f"""
WITH {S.PRED_CTE}
SELECT count(*) AS total, sum(CAST(pred_label = 0 AS BIGINT)) AS n_pred_0, sum(CAST(pred_label = 1 AS BIGINT)) AS n_pred_1,
  sum(CAST(pred_label = true_label AS BIGINT)) AS correct, round(avg(confidence), 6) AS mean_confidence,
  round(sum(CAST(pred_label = true_label AS BIGINT)) / count(*), 6) AS accuracy FROM pred""")
def q_inference_summary(spark, d):
    s = MT.inference_summary(predictions(spark, d))
    return s.select("total", "n_pred_0", "n_pred_1", "correct", r6(F.col("mean_confidence")).alias("mean_confidence"),
                    r6(F.col("accuracy")).alias("accuracy"))


@register("cv_summary", f"""
WITH {S.PRED_CTE},
f AS (SELECT *, (row_number() OVER (PARTITION BY true_label ORDER BY md5('42:' || CAST(doc_id AS VARCHAR)), doc_id) - 1) % 5 AS fold FROM pred),
a AS (SELECT fold, avg(CAST(true_label = pred_label AS DOUBLE)) AS accuracy FROM f GROUP BY fold)
SELECT round(avg(accuracy), 6) AS cv_mean, round(stddev_pop(accuracy), 6) AS cv_std, count(*) AS n_folds FROM a""")
def q_cv_summary(spark, d):
    f = SM.stratified_folds(predictions(spark, d), label="true_label", id_col="doc_id")
    s = MT.cv_summary(MT.fold_accuracy(f))
    return s.select(r6(F.col("cv_mean")).alias("cv_mean"), r6(F.col("cv_std")).alias("cv_std"), "n_folds")


@register("best_epoch", f"""
WITH {S.PRED_CTE},
f AS (SELECT *, (row_number() OVER (PARTITION BY true_label ORDER BY md5('42:' || CAST(doc_id AS VARCHAR)), doc_id) - 1) % 5 AS fold FROM pred),
h AS (SELECT fold + 1 AS epoch, round(avg(CAST(true_label = pred_label AS DOUBLE)), 6) AS val_acc FROM f GROUP BY fold)
SELECT epoch, val_acc FROM h ORDER BY val_acc DESC, epoch LIMIT 1""")
def q_best_epoch(spark, d):
    """History = per-fold validation accuracy of the scorer, fold i = epoch i+1."""
    f = SM.stratified_folds(predictions(spark, d), label="true_label", id_col="doc_id")
    h = MT.fold_accuracy(f).select((F.col("fold") + 1).alias("epoch"), r6(F.col("accuracy")).alias("val_acc"))
    return MT.best_epoch(h).select("epoch", "val_acc")


@register("history_rows", """
WITH a AS (SELECT conv_id, list(turn ORDER BY turn) AS epochs, list(CAST(length(text) AS DOUBLE) ORDER BY turn) AS train_loss,
                  list(CAST(length(role) AS DOUBLE) ORDER BY turn) AS val_loss FROM conversations GROUP BY conv_id)
SELECT conv_id, unnest(epochs) AS epoch, unnest(train_loss) AS train_loss, unnest(val_loss) AS val_loss FROM a""")
def q_history_rows(spark, d):
    """Parallel per-epoch arrays (one record per conversation) back to rows."""
    c = table(spark, d, "conversations")
    a = c.groupBy("conv_id").agg(F.sort_array(F.collect_list(F.struct("turn", F.length("text").cast("double").alias("tl"),
                                                                        F.length("role").cast("double").alias("vl")))).alias("_s"))
    a = a.select("conv_id", F.transform("_s", lambda s: s["turn"]).alias("epochs"),
                 F.transform("_s", lambda s: s["tl"]).alias("train_loss"), F.transform("_s", lambda s: s["vl"]).alias("val_loss"))
    z = a.select("conv_id", F.explode(F.arrays_zip("epochs", "train_loss", "val_loss")).alias("z"))
    return z.select("conv_id", F.col("z.epochs").alias("epoch"), F.col("z.train_loss").alias("train_loss"),
                    F.col("z.val_loss").alias("val_loss"))


_MODELS = [("scorer_a", "ML", [1, 2]), ("scorer_b", "ML", [3]), ("scorer_c", "DL", [4, 5]), ("scorer_d", "DL", [6])]


def _model_preds(spark, d):
    e = table(spark, d, "embeddings")
    frames = []
    for name, kind, dims in _MODELS:
        s = sum((F.element_at("embedding", i).cast("double") for i in dims[1:]), F.element_at("embedding", dims[0]).cast("double"))
        frames.append(e.select(F.lit(name).alias("model_name"), F.lit(kind).alias("model_type"),
                               F.col("vec_id").alias("doc_id"), (F.col("label") >= 5).cast("int").alias("true_label"),
                               (s > 0).cast("int").alias("pred_label")))
    return DD.union_all(frames)


def _model_preds_sql() -> str:
    parts = []
    for name, kind, dims in _MODELS:
        s = " + ".join(f"CAST(embedding[{i}] AS DOUBLE)" for i in dims)
        parts.append(f"SELECT '{name}' AS model_name, '{kind}' AS model_type, vec_id AS doc_id, CAST(label >= 5 AS INTEGER) AS true_label, "
                     f"CAST({s} > 0 AS INTEGER) AS pred_label FROM embeddings")
    return "mp AS (" + " UNION ALL ".join(parts) + ")"


def _model_results(spark, d):
    p = _model_preds(spark, d)
    g = p.groupBy("model_name", "model_type").agg(
        F.count(F.lit(1)).alias("n"), F.sum((F.col("true_label") == F.col("pred_label")).cast("long")).alias("correct"),
        *[F.sum(((F.col("true_label") == c) & (F.col("pred_label") == c)).cast("long")).alias(f"tp{c}") for c in (0, 1)],
        *[F.sum((F.col("pred_label") == c).cast("long")).alias(f"pr{c}") for c in (0, 1)],
        *[F.sum((F.col("true_label") == c).cast("long")).alias(f"su{c}") for c in (0, 1)])
    prec = [F.when(F.col(f"pr{c}") != 0, F.col(f"tp{c}") / F.col(f"pr{c}")).otherwise(0.0) for c in (0, 1)]
    wp = (prec[0] * F.col("su0") + prec[1] * F.col("su1")) / F.col("n")
    return g.select("model_name", "model_type", (F.col("correct") / F.col("n")).alias("test_accuracy"), wp.alias("weighted_precision"),
                    (F.col("n") * F.col("n") * 1013).alias("num_parameters"),
                    F.struct(F.col("n").alias("n_rows")).alias("hyperparameters"))


_MODEL_RESULTS_SQL = f"""WITH {_model_preds_sql()},
g AS (SELECT model_name, model_type, count(*) AS n, sum(CAST(true_label = pred_label AS BIGINT)) AS correct,
  sum(CAST(true_label = 0 AND pred_label = 0 AS BIGINT)) AS tp0, sum(CAST(true_label = 1 AND pred_label = 1 AS BIGINT)) AS tp1,
  sum(CAST(pred_label = 0 AS BIGINT)) AS pr0, sum(CAST(pred_label = 1 AS BIGINT)) AS pr1,
  sum(CAST(true_label = 0 AS BIGINT)) AS su0, sum(CAST(true_label = 1 AS BIGINT)) AS su1 FROM mp GROUP BY model_name, model_type),
res AS (SELECT model_name, model_type, correct / n AS test_accuracy,
  ((CASE WHEN pr0 <> 0 THEN tp0 / pr0 ELSE 0.0 END) * su0 + (CASE WHEN pr1 <> 0 THEN tp1 / pr1 ELSE 0.0 END) * su1) / n AS weighted_precision,
  n * n * 1013 AS num_parameters, n AS n_rows FROM g)"""


@register("model_summary", _MODEL_RESULTS_SQL + """
SELECT model_name AS "Model", model_type AS "Type", round(test_accuracy * 100, 2) AS "Test Accuracy (%)",
  round(weighted_precision * 100, 2) AS "Weighted Precision (%)", num_parameters AS "Parameters",
  CASE WHEN num_parameters >= 1000000000 THEN printf('%.2f', num_parameters / 1e9) || 'B'
       WHEN num_parameters >= 1000000 THEN printf('%.1f', num_parameters / 1e6) || 'M'
       WHEN num_parameters >= 1000 THEN printf('%.1f', num_parameters / 1e3) || 'K' ELSE CAST(num_parameters AS VARCHAR) END AS "Parameters (formatted)",
  '{"n_rows":' || n_rows || '}' AS "Hyperparameters" FROM res""")
def q_model_summary(spark, d):
    return MT.model_summary(_model_results(spark, d))


@register("model_rollup", _MODEL_RESULTS_SQL + """
SELECT count(*) AS n_models, sum(CAST(model_type = 'ML' AS BIGINT)) AS n_ml, sum(CAST(model_type = 'DL' AS BIGINT)) AS n_dl,
  arg_max(model_name, (test_accuracy, model_name)) AS best_model, round(max(test_accuracy), 6) AS best_accuracy,
  round(avg(test_accuracy), 6) AS mean_accuracy, round(avg(CASE WHEN model_type = 'ML' THEN test_accuracy END), 6) AS mean_accuracy_ml,
  round(avg(CASE WHEN model_type = 'DL' THEN test_accuracy END), 6) AS mean_accuracy_dl FROM res""")
def q_model_rollup(spark, d):
    r = MT.model_rollup(_model_results(spark, d))
    return r.select("n_models", "n_ml", "n_dl", "best_model", *[r6(F.col(c)).alias(c) for c in
                    ["best_accuracy", "mean_accuracy", "mean_accuracy_ml", "mean_accuracy_dl"]])


@register("model_inference_accuracy", f"""WITH {_model_preds_sql()},
per AS (SELECT model_name, model_type, sum(CAST(true_label = pred_label AS BIGINT)) AS correct, count(*) AS total,
        sum(CAST(true_label = pred_label AS BIGINT)) / count(*) AS accuracy FROM mp GROUP BY model_name, model_type)
SELECT model_name, model_type, correct, total, round(accuracy, 6) AS accuracy FROM per
UNION ALL SELECT '__' || model_type || '__', NULL, NULL, NULL, round(avg(accuracy), 6) FROM per GROUP BY model_type
UNION ALL SELECT '__ALL__', NULL, NULL, NULL, round(avg(accuracy), 6) FROM per""")
def q_model_inference_accuracy(spark, d):
    p = _model_preds(spark, d).withColumn("is_correct", F.col("true_label") == F.col("pred_label"))
    r = MT.model_inference_accuracy(p)
    return r.select("model_name", "model_type", "correct", "total", r6(F.col("accuracy")).alias("accuracy"))


@register("sigmoid_scores", """
SELECT vec_id, list_transform(embedding, lambda x: round(1.0 / (1.0 + exp(-greatest(-250.0, least(250.0, CAST(x AS DOUBLE) * 100)))), 6)) AS probs FROM embeddings""")
def q_sigmoid_scores(spark, d):
    e = table(spark, d, "embeddings")
    return e.select("vec_id", F.transform("embedding", lambda x: F.round(FT.sigmoid(x.cast("double") * 100), 6)).alias("probs"))


@register("normalised_sigmoid", """
WITH s AS (SELECT vec_id, list_transform(embedding, lambda x: 1.0 / (1.0 + exp(-greatest(-250.0, least(250.0, CAST(x AS DOUBLE)))))) AS sg FROM embeddings)
SELECT vec_id, list_transform(sg, lambda x: round(x / list_sum(sg), 6)) AS probs FROM s""")
def q_normalised_sigmoid(spark, d):
    e = table(spark, d, "embeddings")
    return e.select("vec_id", F.transform(FT.normalised_sigmoid("embedding"), lambda x: F.round(x, 6)).alias("probs"))


@register("softmax_argmax", """
WITH s AS (SELECT vec_id, list_transform(embedding, lambda x: CAST(x AS DOUBLE) * 10) AS lg FROM embeddings),
e AS (SELECT vec_id, lg, list_transform(lg, lambda x: exp(x - list_max(lg))) AS ex FROM s),
p AS (SELECT vec_id, lg, list_transform(ex, lambda x: x / list_sum(ex)) AS pr FROM e)
SELECT vec_id, CAST(list_position(lg, list_max(lg)) - 1 AS INTEGER) AS pred_class, round(list_max(pr), 6) AS confidence FROM p""")
def q_softmax_argmax(spark, d):
    e = table(spark, d, "embeddings").select("vec_id", F.transform("embedding", lambda x: x.cast("double") * 10).alias("lg"))
    return e.select("vec_id", FT.argmax("lg").alias("pred_class"), r6(F.array_max(FT.softmax("lg"))).alias("confidence"))


@register("ensemble_vote", f"""
WITH {S.PRED_CTE},
b AS (SELECT vec_id AS doc_id, CAST(CAST(embedding[3] AS DOUBLE) > 0 AS INTEGER) AS pred_b,
      1.0 / (1.0 + exp(-abs(CAST(embedding[3] AS DOUBLE)) * 10)) AS conf_b FROM embeddings),
j AS (SELECT p.doc_id, 0.5 * CASE WHEN pred_label = 1 THEN confidence ELSE 1 - confidence END
      + 0.5 * CASE WHEN pred_b = 1 THEN conf_b ELSE 1 - conf_b END AS s FROM pred p JOIN b USING (doc_id))
SELECT doc_id, CASE WHEN s > 0.5 THEN 1 ELSE 0 END AS pred, round(s, 6) AS score,
  round(CASE WHEN s > 0.5 THEN s ELSE 1 - s END * 100, 6) AS confidence_pct FROM j""")
def q_ensemble_vote(spark, d):
    a = predictions(spark, d).select("doc_id", "pred_label", "confidence")
    s = F.element_at("embedding", 3).cast("double")
    b = table(spark, d, "embeddings").select(F.col("vec_id").alias("doc_id"), (s > 0).cast("int").alias("pred_b"),
                                             (F.lit(1.0) / (F.lit(1.0) + F.exp(-F.abs(s) * 10))).alias("conf_b"))
    j = a.join(b, "doc_id").select("doc_id", FT.ensemble("pred_label", "confidence", "pred_b", "conf_b").alias("e"))
    return j.select("doc_id", "e.pred", r6(F.col("e.score")).alias("score"), r6(F.col("e.confidence_pct")).alias("confidence_pct"))


# ---------------------------------------------------------------------------
# TF-IDF, scalers, closed-form naive Bayes, interpretation
# ---------------------------------------------------------------------------

def _tfidf_corpus(spark, d):
    return labelled(spark, d).select("record_id", T.clean_aggressive("text").alias("text"))


_TFIDF_SQL_BASE = f"""WITH {S.LABELLED_CTE},
c AS (SELECT record_id AS doc_id, {S.tokens_no_stop(S.clean_aggressive('text'))} AS toks FROM labelled),
terms AS (SELECT doc_id, unnest(toks) AS term FROM c UNION ALL SELECT doc_id, unnest({S.bigrams('toks')}) FROM c),
tf AS (SELECT doc_id, term, count(*) AS tf FROM terms GROUP BY doc_id, term),
stats AS (SELECT term, count(*) AS df, sum(tf) AS total FROM tf GROUP BY term),
vocab AS (SELECT *, row_number() OVER (ORDER BY total DESC, term) - 1 AS term_index FROM stats ORDER BY total DESC, term LIMIT {MAX_FEATURES}),
idf AS (SELECT *, ln((1.0 + (SELECT count(*) FROM labelled)) / (1.0 + df)) + 1.0 AS idf FROM vocab),
w AS (SELECT tf.doc_id, tf.term, CAST(term_index AS INTEGER) AS term_index, tf.tf, tf.tf * idf AS raw FROM tf JOIN idf USING (term)),
tfidf AS (SELECT doc_id, term, term_index, tf, raw / sqrt(sum(raw * raw) OVER (PARTITION BY doc_id)) AS tfidf FROM w)"""


@register("tfidf", _TFIDF_SQL_BASE + " SELECT doc_id, term, term_index, tf, round(tfidf, 6) AS tfidf FROM tfidf")
def q_tfidf(spark, d):
    t = TF.tfidf(_tfidf_corpus(spark, d), "text", "record_id", max_features=MAX_FEATURES)
    return t.select("doc_id", "term", "term_index", "tf", r6(F.col("tfidf")).alias("tfidf"))


@register("top_doc_terms", _TFIDF_SQL_BASE + """,
r AS (SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY round(tfidf, 9) DESC, term) AS rank FROM tfidf)
SELECT doc_id, term, round(tfidf, 6) AS weight, rank FROM r WHERE rank <= 15""")
def q_top_doc_terms(spark, d):
    t = TF.tfidf(_tfidf_corpus(spark, d), "text", "record_id", max_features=MAX_FEATURES)
    top = IP.top_terms(t.withColumn("weight", F.round("tfidf", 9)), "doc_id", "term", "weight", 15)
    return top.select("doc_id", "term", r6(F.col("weight")).alias("weight"), "rank")


def _scale_inputs(spark, d):
    """The three counts, persisted: the statistics and the scaled rows read
    them, and the texts are cleaned once."""
    f = _features_table(spark, d).select("record_id", *[F.col(c).cast("double").alias(c) for c in ["word_count", "punct_count", "upper_count"]])
    return f.persist()


_SCALE_SQL = f"""WITH {S.LABELLED_CTE},
c AS (SELECT record_id, {S.clean_aggressive('text')} AS t FROM labelled),
f AS (SELECT record_id, CAST(len({S.words('t')}) AS DOUBLE) AS word_count,
      CAST(length(regexp_replace(t, '[^!-/:-@\\[-`{{-~]', '', 'g')) AS DOUBLE) AS punct_count,
      CAST(len(list_filter({S.words('t')}, lambda w: upper(w) = w AND lower(w) <> w)) AS DOUBLE) AS upper_count FROM c)"""


@register("standard_scale", _SCALE_SQL + """
SELECT record_id,
  round((word_count - avg(word_count) OVER ()) / CASE WHEN stddev_pop(word_count) OVER () > 0 THEN stddev_pop(word_count) OVER () ELSE 1.0 END, 6) AS word_count_std,
  round((punct_count - avg(punct_count) OVER ()) / CASE WHEN stddev_pop(punct_count) OVER () > 0 THEN stddev_pop(punct_count) OVER () ELSE 1.0 END, 6) AS punct_count_std,
  round((upper_count - avg(upper_count) OVER ()) / CASE WHEN stddev_pop(upper_count) OVER () > 0 THEN stddev_pop(upper_count) OVER () ELSE 1.0 END, 6) AS upper_count_std
FROM f""")
def q_standard_scale(spark, d):
    s = TF.standard_scale(_scale_inputs(spark, d), ["word_count", "punct_count", "upper_count"])
    return s.select("record_id", *[r6(F.col(f"{c}_std")).alias(f"{c}_std") for c in ["word_count", "punct_count", "upper_count"]])


@register("minmax_scale", _SCALE_SQL + """
SELECT record_id,
  round(greatest(0.0, CASE WHEN max(word_count) OVER () - min(word_count) OVER () > 0 THEN (word_count - min(word_count) OVER ()) / (max(word_count) OVER () - min(word_count) OVER ()) ELSE 0.0 END), 6) AS word_count_mm,
  round(greatest(0.0, CASE WHEN max(punct_count) OVER () - min(punct_count) OVER () > 0 THEN (punct_count - min(punct_count) OVER ()) / (max(punct_count) OVER () - min(punct_count) OVER ()) ELSE 0.0 END), 6) AS punct_count_mm,
  round(greatest(0.0, CASE WHEN max(upper_count) OVER () - min(upper_count) OVER () > 0 THEN (upper_count - min(upper_count) OVER ()) / (max(upper_count) OVER () - min(upper_count) OVER ()) ELSE 0.0 END), 6) AS upper_count_mm
FROM f""")
def q_minmax_scale(spark, d):
    s = TF.minmax_scale(_scale_inputs(spark, d), ["word_count", "punct_count", "upper_count"])
    return s.select("record_id", *[r6(F.col(f"{c}_mm")).alias(f"{c}_mm") for c in ["word_count", "punct_count", "upper_count"]])


def _nb_inputs(spark, d):
    """Split ids and unigram counts.  Both feed several aggregates and
    scalar subqueries, so they are persisted (memory, spilling to disk)
    instead of re-running cleaning and ranking for each consumer."""
    from pyspark import StorageLevel
    s = split_table(spark, d).select("record_id", "label", "split", T.clean_aggressive("text").alias("text"))
    s = s.persist(StorageLevel.MEMORY_AND_DISK)
    terms = TF.doc_terms(s, "text", "record_id", (1, 1))
    tf = TF.term_counts(terms).persist(StorageLevel.MEMORY_AND_DISK)
    ids = s.select(F.col("record_id").alias("doc_id"), "label", "split")
    test_tf = tf.join(ids.filter(F.col("split") == "test").select("doc_id"), "doc_id", "left_semi")
    return ids, tf, test_tf  # training counts meet the training labels, which leave the others out


_NB_SQL = f"""WITH {S.LABELLED_CTE}, {S.split_ctes('labelled')},
c AS (SELECT record_id AS doc_id, label, split, {S.tokens_no_stop(S.clean_aggressive('text'))} AS toks FROM split_rows),
tf AS (SELECT doc_id, term, count(*) AS tf FROM (SELECT doc_id, unnest(toks) AS term FROM c) GROUP BY doc_id, term),
tr AS (SELECT tf.*, c.label FROM tf JOIN c USING (doc_id) WHERE c.split = 'train'),
vs AS (SELECT count(DISTINCT term) AS v FROM tr),
nd AS (SELECT count(*) AS n FROM c WHERE split = 'train'),
pri AS (SELECT label, ln(count(*) / (SELECT n FROM nd)) AS log_prior FROM c WHERE split = 'train' GROUP BY label),
tc AS (SELECT label, term, sum(tf) AS n_tc FROM tr GROUP BY label, term),
den AS (SELECT label, ln(sum(n_tc) + 1.0 * (SELECT v FROM vs)) AS log_denom FROM tc GROUP BY label),
lp AS (SELECT label, term, ln(n_tc + 1.0) - log_denom AS log_p FROM tc JOIN den USING (label)),
cls AS (SELECT label, log_prior, ln(1.0) - log_denom AS log_p0 FROM pri JOIN den USING (label)),
te AS (SELECT tf.* FROM tf JOIN c USING (doc_id) WHERE c.split = 'test' AND tf.term IN (SELECT term FROM tr)),
docs AS (SELECT DISTINCT doc_id FROM c WHERE split = 'test'),
ll AS (SELECT te.doc_id, cls.label, sum(te.tf * coalesce(lp.log_p, cls.log_p0)) AS ll FROM te CROSS JOIN cls
       LEFT JOIN lp ON lp.label = cls.label AND lp.term = te.term GROUP BY te.doc_id, cls.label),
sc AS (SELECT docs.doc_id, cls.label, cls.log_prior + coalesce(ll.ll, 0.0) AS log_score FROM docs CROSS JOIN cls
       LEFT JOIN ll ON ll.doc_id = docs.doc_id AND ll.label = cls.label)"""


@register("naive_bayes", _NB_SQL + """,
best AS (SELECT doc_id, arg_max(label, (log_score, -label)) AS pred_label FROM sc GROUP BY doc_id)
SELECT b.doc_id, c.label AS true_label, b.pred_label FROM best b JOIN c USING (doc_id)""")
def q_naive_bayes(spark, d):
    """Closed-form multinomial NB (alpha=1) on unigram counts: train split ->
    test split predictions."""
    ids, train_tf, test_tf = _nb_inputs(spark, d)
    scores = TF.naive_bayes_closed_form(train_tf, ids.filter(F.col("split") == "train"), test_tf,
                                        ids.filter(F.col("split") == "test"), alpha=1.0)
    best = TF.argmax_label(scores)
    return best.join(ids.select("doc_id", F.col("label").alias("true_label")), "doc_id") \
               .select("doc_id", "true_label", "pred_label")


@register("nb_contributions", _NB_SQL + """,
coef AS (SELECT a.term, b.log_p - a.log_p AS coef FROM lp a JOIN lp b ON a.term = b.term AND a.label = 0 AND b.label = 1),
x AS (SELECT te.doc_id, te.term, round(te.tf * coef.coef, 9) AS weight FROM te JOIN coef USING (term)),
r AS (SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY weight DESC, term) AS rank FROM x)
SELECT doc_id, term, round(weight, 6) AS weight, rank FROM r WHERE rank <= 15""")
def q_nb_contributions(spark, d):
    """Per-document top terms by count x NB log-ratio coefficient (terms seen
    with both labels in training)."""
    ids, train_tf, test_tf = _nb_inputs(spark, d)
    lab = ids.filter(F.col("split") == "train").select("doc_id", "label")
    t = train_tf.join(lab, "doc_id")
    tc = t.groupBy("label", "term").agg(F.sum("tf").alias("n_tc")).persist()
    v = tc.select(F.count_distinct("term")).scalar()
    den = tc.groupBy("label").agg(F.log(F.sum("n_tc") + F.lit(1.0) * v).alias("log_denom"))
    lp = tc.join(F.broadcast(den), "label").select("label", "term", (F.log(F.col("n_tc") + 1.0) - F.col("log_denom")).alias("log_p"))
    coef = lp.groupBy("term").agg(F.max(F.when(F.col("label") == 1, F.col("log_p"))).alias("p1"),
                                  F.max(F.when(F.col("label") == 0, F.col("log_p"))).alias("p0")) \
             .filter(F.col("p1").isNotNull() & F.col("p0").isNotNull()) \
             .select("term", (F.col("p1") - F.col("p0")).alias("coef"))
    # Rank on 9-digit weights: mathematically tied terms (tf x coef) differ in
    # the last bits between engines; the term then breaks the tie.
    x = test_tf.join(coef, "term").withColumn("weight", F.round(F.col("tf") * F.col("coef"), 9))
    top = IP.top_terms(x, "doc_id", "term", "weight", 15)
    return top.select("doc_id", "term", r6(F.col("weight")).alias("weight"), "rank")


def _subword_tokens(docs):
    """Sub-word token rows derived from documents: each whitespace word is cut
    into 3-character pieces, the first marked as a word start; every document
    is framed by special tokens.  Weight is derived from the piece.  The rows
    of a document follow one another."""
    words = F.coalesce(T.whitespace_words("text"), F.array().cast("array<string>"))
    frame = F.array(F.lit(None).cast("string"))  # a null word gives one null piece
    w = docs.select("doc_id", F.posexplode_outer(F.concat(frame, words, frame)).alias("at", "word"))
    p = w.select("doc_id", "at", F.posexplode_outer(F.regexp_extract_all("word", F.lit("(?s).{1,3}"), 0)).alias("ppos", "piece"))
    wpos, special, first = F.col("at") - 1, F.col("piece").isNull(), F.col("at") == 0
    return p.select("doc_id",
                    F.when(special, F.when(first, 0).otherwise(10 ** 12)).otherwise(wpos.cast("long") * 100 + F.col("ppos") + 1).alias("pos"),
                    F.when(special, F.when(first, "<s>").otherwise("</s>")).when(F.col("ppos") == 0, F.concat(F.lit("Ġ"), F.col("piece")))
                     .otherwise(F.col("piece")).alias("token"),
                    F.when(special, 0.0).otherwise((F.length("piece") * 7 + wpos % 5) / 10.0).alias("weight"))


def _subword_inputs(spark, d):
    """The tokens of all documents: of those that lie in one row, where they lie
    together, and of the others."""
    whole, others = IP.whole_rows(table(spark, d, "documents").select("doc_id", "text"), "doc_id", F.length("text"))
    return _subword_tokens(whole), _subword_tokens(others)


_SUBWORD_SQL = r"""WITH w AS (SELECT doc_id, unnest(list_filter(regexp_split_to_array(text, '[WS]+'), lambda x: x <> '')) AS word,
        generate_subscripts(list_filter(regexp_split_to_array(text, '[WS]+'), lambda x: x <> ''), 1) - 1 AS wpos FROM documents),
p AS (SELECT doc_id, wpos, unnest(regexp_extract_all(word, '(?s).{1,3}')) AS piece, generate_subscripts(regexp_extract_all(word, '(?s).{1,3}'), 1) - 1 AS ppos FROM w),
tok AS (SELECT doc_id, wpos * 100 + ppos + 1 AS pos, CASE WHEN ppos = 0 THEN 'Ġ' || piece ELSE piece END AS token,
        (length(piece) * 7 + wpos % 5) / 10.0 AS weight FROM p
        UNION ALL SELECT doc_id, 0, '<s>', 0.0 FROM documents UNION ALL SELECT doc_id, 1000000000000, '</s>', 0.0 FROM documents)""".replace("WS", S.WS)


@register("merge_subwords", _SUBWORD_SQL + """,
k AS (SELECT *, replace(replace(token, 'Ġ', ''), 'Ċ', '') AS piece FROM tok WHERE token NOT IN ('<s>', '</s>', '<pad>', '<unk>')),
k2 AS (SELECT *, CASE WHEN starts_with(token, 'Ġ') OR row_number() OVER (PARTITION BY doc_id ORDER BY pos) = 1 THEN 1 ELSE 0 END AS st
       FROM k WHERE length(trim(piece)) > 0),
k3 AS (SELECT *, sum(st) OVER (PARTITION BY doc_id ORDER BY pos ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS word_no FROM k2)
SELECT doc_id, word_no, string_agg(piece, '' ORDER BY pos) AS word, round(avg(weight), 6) AS weight FROM k3 GROUP BY doc_id, word_no""")
def q_merge_subwords(spark, d):
    whole, others = _subword_inputs(spark, d)
    m = IP.merge_subwords(whole, together=True).unionByName(IP.merge_subwords(others))
    return m.select("doc_id", F.col("word_no").cast("long").alias("word_no"), "word", r6(F.col("weight")).alias("weight"))


@register("normalise_weights", _SUBWORD_SQL + """,
n AS (SELECT *, min(weight) OVER (PARTITION BY doc_id) AS lo, max(weight) OVER (PARTITION BY doc_id) AS hi FROM tok)
SELECT doc_id, pos, token, round(CASE WHEN hi - lo >= 1e-9 THEN (weight - lo) / (hi - lo) ELSE weight END, 6) AS norm_weight FROM n""")
def q_normalise_weights(spark, d):
    whole, others = _subword_inputs(spark, d)
    n = IP.normalise_weights(whole, together=True).unionByName(IP.normalise_weights(others))
    return n.select("doc_id", "pos", "token", r6(F.col("norm_weight")).alias("norm_weight"))


# ---------------------------------------------------------------------------
# Embeddings and clusters
# ---------------------------------------------------------------------------

@register("l2_normalise", """
SELECT vec_id, list_transform(embedding, lambda x: round(CAST(x AS DOUBLE) / sqrt(list_sum(list_transform(embedding, lambda y: CAST(y AS DOUBLE) * CAST(y AS DOUBLE)))), 6)) AS unit
FROM embeddings""")
def q_l2_normalise(spark, d):
    e = table(spark, d, "embeddings")
    return CL.with_unit(e, "embedding", "unit").select("vec_id", F.transform("unit", lambda x: F.round(x, 6)).alias("unit"))


def _cluster_tables(spark, d):
    e = CL.with_unit(table(spark, d, "embeddings"), "embedding", "unit")
    cents = CL.centroids(e, "unit", "label")
    assigned = CL.nearest_clusters(e, "unit", cents, n=1, extra_cols=()).select(
        "vec_id", "label", F.col("nearest")[0]["cluster"].alias("cluster"), F.col("unit"))
    risk = CL.cluster_risk(assigned.withColumn("is_positive", (F.col("label") >= 5).cast("int")))
    return e, cents, assigned, risk


_CLUSTER_SQL = """WITH e AS (SELECT vec_id, label, list_transform(embedding, lambda x: CAST(x AS DOUBLE) / sqrt(list_sum(list_transform(embedding, lambda y: CAST(y AS DOUBLE) * CAST(y AS DOUBLE))))) AS unit FROM embeddings),
pe AS (SELECT label, unnest(unit) AS x, generate_subscripts(unit, 1) AS pos FROM e),
cm AS (SELECT label AS cluster, pos, avg(x) AS m FROM pe GROUP BY label, pos),
cents AS (SELECT cluster, list(m ORDER BY pos) AS centroid FROM cm GROUP BY cluster),
dist AS (SELECT e.vec_id, e.label, c.cluster, sqrt(list_sum(list_transform(list_zip(e.unit, c.centroid), lambda z: (z[1] - z[2]) * (z[1] - z[2])))) AS dist
         FROM e, cents c),
near AS (SELECT *, row_number() OVER (PARTITION BY vec_id ORDER BY dist, cluster) AS rk FROM dist),
assigned AS (SELECT vec_id, label, cluster FROM near WHERE rk = 1),
risk AS (SELECT cluster, avg(CAST(label >= 5 AS DOUBLE)) AS risk, count(*) AS n_rows FROM assigned GROUP BY cluster)"""


@register("cluster_risk", _CLUSTER_SQL + " SELECT cluster, round(risk, 6) AS risk, n_rows FROM risk")
def q_cluster_risk(spark, d):
    _, _, _, risk = _cluster_tables(spark, d)
    return risk.select("cluster", r6(F.col("risk")).alias("risk"), "n_rows")


@register("cluster_risk_score", _CLUSTER_SQL + """,
top3 AS (SELECT n.vec_id, n.dist, r.risk FROM near n JOIN risk r USING (cluster) WHERE n.rk <= 3)
SELECT vec_id, round(sum(risk / (dist + 1e-9)) / sum(1.0 / (dist + 1e-9)), 6) AS risk_score FROM top3 GROUP BY vec_id""")
def q_cluster_risk_score(spark, d):
    """Our definition: inverse-distance-weighted mean risk of the 3 nearest
    centroids (centroids = per-class mean of unit vectors)."""
    e, cents, _, risk = _cluster_tables(spark, d)
    cr = cents.join(risk.select("cluster", "risk"), "cluster")
    n = CL.nearest_clusters(e, "unit", cr, n=3, extra_cols=("risk",))
    return n.select("vec_id", r6(CL.risk_score(F.col("nearest"))).alias("risk_score"))


@register("kmeans")
def q_kmeans(spark, d):
    _, assigned = CL.kmeans(table(spark, d, "embeddings"), "embedding", k=10)
    return assigned.select("vec_id", "label", "cluster")


@register("embedding_pca")
def q_embedding_pca(spark, d):
    _, proj = CL.pca(table(spark, d, "embeddings"), "embedding", k=3)
    return proj.select("vec_id", "projection")


# ---------------------------------------------------------------------------
# Pages
# ---------------------------------------------------------------------------

@register("page_links", f"""
WITH n AS (SELECT page_id, url, regexp_extract(html, '(?is)<nav\\b[^>]*>(.*?)</nav>', 1) AS nav FROM pages),
a AS (SELECT page_id, url, unnest(regexp_extract_all(nav, '(?is)<a\\b[^>]*>.*?</a>')) AS a,
             generate_subscripts(regexp_extract_all(nav, '(?is)<a\\b[^>]*>.*?</a>'), 1) - 1 AS item_no FROM n),
h AS (SELECT *, regexp_extract(a, '(?is)\\bhref\\s*=\\s*["'']([^"'']*)["'']', 1) AS href FROM a)
SELECT page_id, CAST(item_no AS INTEGER) AS item_no,
  {S.collapse(_html_sql("regexp_extract(a, '(?is)<a\\b[^>]*>(.*?)</a>', 1)"))} AS title,
  CASE WHEN regexp_matches(href, '^[a-zA-Z][a-zA-Z0-9+.-]*:') THEN href
       WHEN starts_with(href, '//') THEN regexp_extract(url, '^([a-zA-Z][a-zA-Z0-9+.-]*):', 1) || ':' || href
       WHEN starts_with(href, '/') THEN regexp_extract(url, '^([a-zA-Z][a-zA-Z0-9+.-]*://[^/?#]*)', 1) || href
       WHEN href = '' THEN url ELSE regexp_extract(url, '^([^?#]*/)', 1) || href END AS link
FROM h""")
def q_page_links(spark, d):
    return PG.page_links(table(spark, d, "pages"))


def _inner_sql(x: str) -> str:
    return S.collapse(_html_sql(x))


_EXTRACT_SQL = rf"""
a AS (SELECT page_id, url, html, regexp_extract(html, '(?is)<article\b[^>]*>(.*?)</article\s*>', 1) AS art FROM pages),
x AS (SELECT page_id, {_inner_sql(r"regexp_extract(html, '(?is)<h[1-6]\b[^>]*>(.*?)</h[1-6]\s*>', 1)")} AS heading,
  {_inner_sql(r"regexp_extract(html, '(?is)<title\b[^>]*>(.*?)</title\s*>', 1)")} AS doc_title, url,
  {_inner_sql(r"regexp_extract(art, '(?is)<p\b[^>]*>(.*?)(<p\b|</p\s*>|</article|$)', 1)")} AS first_p, {_inner_sql('art')} AS body FROM a),
page AS (SELECT page_id, coalesce(nullif(heading, ''), doc_title) AS title, url AS link,
  coalesce(nullif(first_p, ''), nullif(body, ''), {S.q(NO_DESCRIPTION)}) AS description FROM x)"""


@register("page_extract", f"WITH {_EXTRACT_SQL} SELECT * FROM page")
def q_page_extract(spark, d):
    return PG.page_extract(table(spark, d, "pages"))


@register("page_section", rf"""
WITH r AS (SELECT page_id, regexp_extract(html, '(?is)</h[1-6]\s*>(.*)$', 1) AS rest FROM pages),
n AS (SELECT *, unnest(range(1, 6)) AS k FROM r),
p AS (SELECT page_id, k, regexp_replace(regexp_split_to_array(rest, '(?i)<p\b[^>]*>')[k + 1], '(?is)(</p\s*>|</article).*', '') AS para FROM n),
t AS (SELECT page_id, k, {_inner_sql('para')} AS body FROM p WHERE para IS NOT NULL)
SELECT r.page_id, coalesce(arg_min(body, k) FILTER (contains(lower(body), 'the')), arg_min(body, k)) AS section,
  count(*) FILTER (contains(lower(body), 'the')) > 0 AS keyword_found
FROM r LEFT JOIN t ON t.page_id = r.page_id GROUP BY r.page_id""")
def q_page_section(spark, d):
    return PG.page_section(table(spark, d, "pages"), keyword="the")


_PIECES_SQL = r"""
c0 AS (SELECT page_id, url, html, regexp_replace(regexp_replace(html, '(?is)<script\b[^>]*(>.*?(</script\s*>|$)|$)', ' ', 'g'),
  '(?is)<style\b[^>]*(>.*?(</style\s*>|$)|$)', ' ', 'g') AS v FROM pages),
cut AS (SELECT page_id, url, html, string_split(regexp_replace(v, '(?s)<!--.*?(-->|$)', ' ', 'g'), '<') AS s FROM c0)"""


def _elements_sql(name: str, tag: str) -> str:
    """CTEs ending in ``name`` (page_id, element_no, depth, inner)."""
    return rf"""
{name}_p AS (SELECT page_id, unnest(s) AS piece, generate_subscripts(s, 1) - 1 AS opens FROM cut),
{name}_t AS (SELECT page_id, opens, CASE WHEN regexp_matches(piece, '(?i)^({tag})([\s/>]|$)') THEN 1
  WHEN regexp_matches(piece, '(?i)^/({tag})([\s>]|$)') THEN -1 END AS step FROM {name}_p),
{name}_d AS (SELECT *, sum(step) OVER (PARTITION BY page_id ORDER BY opens) + CASE WHEN step < 0 THEN 1 ELSE 0 END AS depth
  FROM {name}_t WHERE step IS NOT NULL),
{name}_c AS (SELECT *, lead(opens) OVER (PARTITION BY page_id, depth ORDER BY opens) AS closes FROM {name}_d),
{name} AS (SELECT e.page_id, CAST(row_number() OVER (PARTITION BY e.page_id ORDER BY opens) - 1 AS INTEGER) AS element_no,
  CAST(depth AS INTEGER) AS depth, opens,
  regexp_replace(array_to_string(s[opens + 1:coalesce(closes, len(s))], '<'), '^[^>]*>?', '') AS inner_html
  FROM {name}_c e JOIN cut USING (page_id) WHERE step = 1)"""


_BLOCKS = "article|div|footer|li|nav|ul"


@register("page_elements", f"""WITH {_PIECES_SQL}, {_elements_sql('e', _BLOCKS)}
SELECT page_id, element_no, depth, {_inner_sql('inner_html')} AS text FROM e""")
def q_page_elements(spark, d):
    return PG.page_elements(table(spark, d, "pages"), _BLOCKS)


@register("page_items", f"""WITH {_PIECES_SQL}, {_elements_sql('e', 'li')},
a AS (SELECT page_id, url, element_no, inner_html, regexp_extract(inner_html, '(?is)<a\\b[^>]*>.*?(</a\\s*>|$)') AS a
  FROM e JOIN cut USING (page_id)),
h AS (SELECT *, regexp_extract(a, '(?is)\\bhref\\s*=\\s*["'']([^"'']*)["'']', 1) AS href FROM a WHERE a <> '')
SELECT page_id, element_no AS item_no, {_inner_sql('a')} AS title,
  CASE WHEN regexp_matches(href, '^[a-zA-Z][a-zA-Z0-9+.-]*:') THEN href
       WHEN starts_with(href, '//') THEN regexp_extract(url, '^([a-zA-Z][a-zA-Z0-9+.-]*):', 1) || ':' || href
       WHEN starts_with(href, '/') THEN regexp_extract(url, '^([a-zA-Z][a-zA-Z0-9+.-]*://[^/?#]*)', 1) || href
       WHEN href = '' THEN url ELSE regexp_extract(url, '^([^?#]*/)', 1) || href END AS link,
  coalesce(nullif({_inner_sql('inner_html')}, ''), {S.q(NO_DESCRIPTION)}) AS description
FROM h""")
def q_page_items(spark, d):
    return PG.page_items(table(spark, d, "pages"), "li", None, None, ())


_TITLE_SQL = _inner_sql(r"regexp_extract(html, '(?is)<title\b[^>]*>(.*?)</title\s*>', 1)")


@register("section_by_heading", f"""WITH {_PIECES_SQL}, {_elements_sql('h', 'h[1-6]')}, {_elements_sql('f', 'p|footer|div')},
w AS (SELECT page_id, {_TITLE_SQL} AS want FROM cut),
hd AS (SELECT h.page_id, min(opens) AS start FROM h JOIN w USING (page_id) WHERE {_inner_sql('inner_html')} = want GROUP BY h.page_id),
t AS (SELECT f.page_id, {_inner_sql('inner_html')} AS body, row_number() OVER (PARTITION BY f.page_id ORDER BY opens) AS k
  FROM f JOIN hd USING (page_id) WHERE opens > start)
SELECT cut.page_id, coalesce(arg_min(body, k) FILTER (contains(lower(body), 'the')), arg_max(body, k)) AS section,
  count(*) FILTER (contains(lower(body), 'the')) > 0 AS keyword_found
FROM cut LEFT JOIN t ON t.page_id = cut.page_id AND k <= 5 GROUP BY cut.page_id""")
def q_section_by_heading(spark, d):
    title = PG._inner_text(F.regexp_extract("html", r"(?is)<title\b[^>]*>(.*?)</title\s*>", 1))
    return PG.section_by_heading(table(spark, d, "pages"), title, "p|footer|div", "the")


@register("combine_title_body", f"""WITH {_EXTRACT_SQL}
SELECT page_id, 'Title: ' || title || chr(10) || chr(10) || description AS combined_text, 1 AS true_label, 'Bait' AS true_label_name FROM page""")
def q_combine_title_body(spark, d):
    p = PG.page_extract(table(spark, d, "pages")).select("page_id", F.col("title").alias("Title"),
                                                          F.col("description").alias("Text"))
    out = PG.combine_title_body(p)
    return out.select("page_id", "combined_text", F.lit(1).alias("true_label"), F.lit("Bait").alias("true_label_name"))


def all_queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    from . import ml_queries  # noqa: F401  (registers the Spark ML entries)
    return dict(QUERIES)


def all_oracles() -> dict[str, str]:
    return dict(ORACLE)

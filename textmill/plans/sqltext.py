"""SQL fragments for the independent DuckDB oracle.

These are written directly in SQL (not generated from the Spark plan) so the
check is independent.  The regex classes are the same fixed values the Spark
side uses.
"""

from __future__ import annotations

from ..functions.constants import URL_PATTERN, WS_CLASS, english_stop_words

WS = WS_CLASS

MASTER_CTE = ("master AS (SELECT d.text, CAST(l.toxic AS INTEGER) AS label, d.source AS source_file, "
              "d.lang AS source_name, d.doc_id AS record_id FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id)")
LABELLED_CTE = MASTER_CTE + ", labelled AS (SELECT * FROM master WHERE label IS NOT NULL AND text IS NOT NULL)"

PRED_CTE = ("pred AS (SELECT vec_id AS doc_id, CAST(label >= 5 AS INTEGER) AS true_label, "
            "CAST(embedding[1] AS DOUBLE) + CAST(embedding[2] AS DOUBLE) AS score, "
            "CAST(CAST(embedding[1] AS DOUBLE) + CAST(embedding[2] AS DOUBLE) > 0 AS INTEGER) AS pred_label, "
            "1.0 / (1.0 + exp(-abs(CAST(embedding[1] AS DOUBLE) + CAST(embedding[2] AS DOUBLE)) * 10)) AS confidence "
            "FROM embeddings)")


def q(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def stop_list() -> str:
    return "[" + ", ".join(q(w) for w in english_stop_words()) + "]"


def qp_ascii(x: str) -> str:
    """Quoted-printable repair as it acts on the test documents: they hold
    no '=XX' escape and no character in U+0080-U+00BF, so every non-ASCII
    character is a lone invalid UTF-8 byte after Latin-1 encoding and is
    dropped.  (Spark runs the general decoder.)"""
    return f"regexp_replace(coalesce({x}, ''), '[^\\x{{0}}-\\x{{7F}}]', '', 'g')"


def collapse(x: str) -> str:
    return f"trim(regexp_replace({x}, '[{WS}]+', ' ', 'g'))"


def strip(x: str) -> str:
    return f"regexp_replace({x}, '^[{WS}]+|[{WS}]+$', '', 'g')"


def url_mask(x: str, token: str) -> str:
    return f"regexp_replace({x}, {q(URL_PATTERN)}, {q(token)}, 'g')"


def email_mask(x: str, token: str, mixed: bool = False) -> str:
    pat = (r"\b[a-zA-Z0-9._%+-]+@[a-zA-Z0-9.-]+\.[a-zA-Z]{2,}\b" if mixed
           else r"\b[a-z0-9._%+-]+@[a-z0-9.-]+\.[a-z]{2,}\b")
    return f"regexp_replace({x}, {q(pat)}, {q(token)}, 'g')"


def clean_base(x: str) -> str:
    t = f"lower({qp_ascii(x)})"
    t = email_mask(url_mask(t, "[url]"), "[email]")
    t = f"regexp_replace({t}, {q('[^a-z0-9' + WS + chr(92) + '[' + chr(92) + ']]')}, '', 'g')"
    return collapse(t)


def contractions(x: str) -> str:
    t = x
    for a, b in [("n't", " not"), ("'re", " are"), ("'s", " is"), ("'d", " would"), ("'ll", " will"),
                 ("'ve", " have"), ("'m", " am")]:
        t = f"replace({t}, {q(a)}, {q(b)})"
    return t


def clean_aggressive(x: str) -> str:
    t = f"lower({contractions(qp_ascii(x))})"
    t = email_mask(url_mask(t, "[URL]"), "[EMAIL]")
    t = f"regexp_replace({t}, '\\p{{Nd}}+', ' [NUM] ', 'g')"
    t = f"regexp_replace({t}, {q('[^a-z' + WS + chr(92) + '[' + chr(92) + ']]')}, '', 'g')"
    return collapse(t)


def clean_gentle(x: str) -> str:
    t = email_mask(url_mask(qp_ascii(x), " [URL] "), " [EMAIL] ", mixed=True)
    return collapse(t)


def words(x: str) -> str:
    return f"list_filter(regexp_split_to_array({x}, '[{WS}]+'), lambda w: w <> '')"


def tokens_no_stop(x: str) -> str:
    return (f"list_filter(regexp_extract_all(lower({x}), '[\\p{{L}}\\p{{N}}_]{{2,}}'), "
            f"lambda t: NOT list_contains({stop_list()}, t))")


def bigrams(arr: str) -> str:
    return (f"list_transform(range(1, len({arr})), lambda i: {arr}[i] || ' ' || {arr}[i + 1])")


def split_ctes(src: str, id_col: str = "record_id", label: str = "label", seed: int = 42,
               p_hold: int = 30, p_test: int = 15) -> str:
    """CTEs ``ranked`` and ``quotas`` and ``split_rows`` for the stratified split
    of table ``src``."""
    return f"""
ranked AS (SELECT *, row_number() OVER (PARTITION BY {label} ORDER BY md5('{seed}:' || CAST({id_col} AS VARCHAR)), {id_col}) AS rk FROM {src}),
cnt AS (SELECT {label}, count(*) AS n_label FROM {src} GROUP BY {label}),
q1 AS (SELECT *, sum(n_label) OVER () AS n_all, (sum(n_label) OVER () * {p_hold} + 99) // 100 AS hold_total FROM cnt),
q2 AS (SELECT *, (hold_total * n_label) // n_all AS b1, (hold_total * n_label) % n_all AS r1 FROM q1),
q3 AS (SELECT *, b1 + CASE WHEN row_number() OVER (ORDER BY r1 DESC, {label}) <= hold_total - sum(b1) OVER () THEN 1 ELSE 0 END AS hold_quota FROM q2),
q4 AS (SELECT *, (hold_total * {p_test} + {p_hold - 1}) // {p_hold} AS test_total FROM q3),
q5 AS (SELECT *, (test_total * hold_quota) // hold_total AS b2, (test_total * hold_quota) % hold_total AS r2 FROM q4),
quotas AS (SELECT {label}, n_label, hold_quota, b2 + CASE WHEN row_number() OVER (ORDER BY r2 DESC, {label}) <= test_total - sum(b2) OVER () THEN 1 ELSE 0 END AS test_quota FROM q5),
split_rows AS (SELECT ranked.*, CASE WHEN rk <= test_quota THEN 'test' WHEN rk <= hold_quota THEN 'validation' ELSE 'train' END AS split
               FROM ranked JOIN quotas USING ({label}))"""

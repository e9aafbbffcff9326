"""Text cleaning as Column -> Column expressions.

All functions stay inside Catalyst (no Python UDFs), so they run in
whole-stage generated code next to the scan.  Regex character classes are
spelled explicitly (see ``constants.WS_CLASS``) because Java's ``\\s``, ``\\d``
and ``\\w`` are ASCII-only while the semantics we reproduce are Unicode-aware.
"""

from __future__ import annotations

import functools
import json
import operator
import string

from pyspark.sql import Column
from pyspark.sql import functions as F

from .constants import (CONTRACTIONS, LABEL_MAP, TEXT_CANDIDATES, URL_PATTERN, WORD_CLASS,
                        WS_CLASS, html_named_entities)

# Python-style word boundary (Unicode \w on both sides).
_W = "[" + WORD_CLASS + "]"
PY_BOUNDARY = f"(?:(?<={_W})(?!{_W})|(?<!{_W})(?={_W}))"

# The same whitespace but the space.  Java looks single Latin-1 characters up in
# a table and tries ranges one by one, so the rare ones stand behind one range.
_OTHER_WS = r"[\t\n\x0B\f\r\x1C\x1D\x1E\x1F\x85\xA0[\x{1680}-\x{3000}&&[" + WS_CLASS + "]]]+"

WS_RUN = "[ " + _OTHER_WS[1:]
WORD_RUN = string.ascii_letters + string.digits + WORD_CLASS  # WORD_CLASS, in the table too

EMAIL_LOWER = PY_BOUNDARY + r"[a-z0-9._%+-]+@[a-z0-9.-]+\.[a-z]{2,}" + PY_BOUNDARY
EMAIL_MIXED = PY_BOUNDARY + r"[a-zA-Z0-9._%+-]+@[a-zA-Z0-9.-]+\.[a-zA-Z]{2,}" + PY_BOUNDARY


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def let(value: Column, body) -> Column:
    """``body(value)`` with the value computed once, also where the body
    refers to it inside another lambda."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def _where(c, marks: tuple[str, ...], change) -> Column:
    """``change`` of the texts that hold one of ``marks``; it would leave the
    others as they are, and they are not searched for its patterns."""
    return let(_col(c), lambda s: F.when(functools.reduce(operator.or_, [F.contains(s, F.lit(m)) for m in marks]), change(s)).otherwise(s))


# ---------------------------------------------------------------------------
# F1 / F2: consolidation and label standardisation
# ---------------------------------------------------------------------------

def consolidate(columns: list[str], candidates: list[str]) -> Column:
    """First non-null value over the candidate columns that exist, left to
    right; an all-null string column when none exists."""
    present = [c for c in candidates if c in columns]
    if not present:
        return F.lit(None).cast("string")
    return F.coalesce(*[F.col(f"`{c}`").cast("string") for c in present])


def label_map_column() -> Column:
    items = []
    for k, v in LABEL_MAP.items():
        items += [F.lit(k), F.lit(v)]
    return F.create_map(*items)


def standardise_label(raw) -> Column:
    """``str -> lower -> strip -> lookup``; unknown spellings become null."""
    key = F.lower(F.regexp_replace(_col(raw).cast("string"), f"^[{WS_CLASS}]+|[{WS_CLASS}]+$", ""))
    return label_map_column()[key].cast("int")


# ---------------------------------------------------------------------------
# quoted-printable repair
# ---------------------------------------------------------------------------

def qp_repair(c) -> Column:
    """Latin-1 encode (dropping other chars) -> quoted-printable decode ->
    UTF-8 decode dropping invalid bytes.  Pure Column expression.

    Each intermediate is referenced exactly once: expressions under
    higher-order functions are evaluated without common-subexpression
    elimination, so a branch that repeated the input would re-run it."""
    def unquoted(s):
        s = F.regexp_replace(F.replace(s, F.lit("=="), F.lit("=3D")), r"=\r?\n|=$", "")
        return F.array_join(F.transform(F.split(s, "=", -1), lambda p, i: F.when(i == 0, p).when(
            p.rlike("^[0-9A-Fa-f]{2}"),
            F.concat(F.decode(F.unhex(F.substring(p, 1, 2)), "ISO-8859-1"), F.substring(p, 3, 1 << 30)),
        ).otherwise(F.concat(F.lit("="), p))), "")

    s = F.regexp_replace(F.coalesce(_col(c), F.lit("")), r"[^\x{0}-\x{FF}]", "")
    decoded = _where(s, ("=",), unquoted)
    as_utf8 = F.make_valid_utf8(F.encode(decoded, "ISO-8859-1").cast("string"))
    return F.regexp_replace(as_utf8, r"\x{FFFD}", "")


# ---------------------------------------------------------------------------
# HTML to text
# ---------------------------------------------------------------------------

# Possessive: Java's regex recurses for each turn of a loop over alternatives,
# so a long tag, or one without an end, must neither loop by character nor
# backtrack.  What follows an alternative is never one of its own characters,
# so nothing is lost.
_TAG = r"""<[a-zA-Z](?:[^>"']++|"[^"]*+"|'[^']*+')*+>|</[a-zA-Z][^>]*+>"""


# What references to U+0080 to U+009F stand for: the Windows-1252 character,
# or the control character where that code page has none.
_C1 = "".join(bytes([b]).decode("cp1252", "ignore") or chr(b) for b in range(0x80, 0xA0))


def _entity_decode(s: Column) -> Column:
    """Decode character references as HTML 5 does: ``&name;``, the older names
    without a semicolon too (the longest that fits), ``&#NNN;`` and ``&#xHH;``
    with or without one.  Numbers 0, surrogates and those past U+10FFFF give
    U+FFFD, control characters and non-characters give nothing."""
    by_first: dict[str, dict[str, str]] = {}  # a map is searched from its start: by first letter it is short
    older = []
    for name, text in sorted(html_named_entities().items()):
        by_first.setdefault(name[0], {})[name] = text
        if not name.endswith(";"):
            older.append(name)
    named = F.from_json(F.lit(json.dumps(by_first)), "map<string,map<string,string>>")  # folded to a constant
    older_pattern = "^(" + "|".join(sorted(older, key=lambda n: (-len(n), n))) + ")"

    def lookup(name):
        return F.try_element_at(F.try_element_at(named, F.substring(name, 1, 1)), name)

    def number(digits, base):
        short = F.regexp_replace(digits, "^0+", "")
        cp = F.when(F.length(short) > 7, F.lit(1 << 24)).otherwise(F.conv(F.concat(F.lit("0"), short), base, 10).cast("bigint"))
        low = cp.bitwiseAND(F.lit(0xFFFF))
        return (F.when((cp == 0) | cp.between(0xD800, 0xDFFF) | (cp > 0x10FFFF), F.lit("\ufffd"))
                .when(cp.between(0x80, 0x9F), F.substring(F.lit(_C1), cp.cast("int") - 0x7F, F.lit(1)))
                .when((cp < 9) | (cp == 11) | cp.between(14, 31) | (cp == 127) | cp.between(0xFDD0, 0xFDEF) | (low >= 0xFFFE), F.lit(""))
                .otherwise(F.decode(F.unhex(F.lpad(F.hex(cp), 8, "0")), "UTF-32")))

    def rest(p, pattern):
        return F.regexp_replace(p, pattern, "")

    def piece(p, i):
        name, old = F.regexp_extract(p, "^([a-zA-Z][a-zA-Z0-9]*;)", 1), F.regexp_extract(p, older_pattern, 1)
        return (F.when(i == 0, p)
                .when(p.rlike("^#[0-9]"), F.concat(number(F.regexp_extract(p, "^#([0-9]+)", 1), 10), rest(p, "^#[0-9]+;?")))
                .when(p.rlike("^#[xX][0-9a-fA-F]"),
                      F.concat(number(F.regexp_extract(p, "^#[xX]([0-9a-fA-F]+)", 1), 16), rest(p, "^#[xX][0-9a-fA-F]+;?")))
                .when(~p.rlike("^[a-zA-Z]"), F.concat(F.lit("&"), p))
                .otherwise(F.coalesce(F.concat(lookup(name), rest(p, "^[a-zA-Z0-9]+;")),
                                      F.concat(lookup(old), rest(p, older_pattern)),
                                      F.concat(F.lit("&"), p))))

    return F.array_join(F.transform(F.split(s, "&", -1), piece), "")


def html_to_text(c) -> Column:
    """Text content of an HTML fragment, pieces joined by a space:
    script/style bodies, comments and declarations are removed, tags become
    a space, character references are decoded.  A script or style element that
    is never closed goes to the end of the text, so each of its characters is
    read once."""
    def without_tags(s):
        t = F.regexp_replace(s, r"(?is)<(script|style)\b[^>]*+(?:>.*?(?:</\1\s*+>|\z)|\z)", " ")
        t = F.regexp_replace(t, r"(?s)<!--.*?(-->|$)", " ")
        t = F.regexp_replace(t, r"<![^>]*>|<\?[^>]*>", " ")
        return F.regexp_replace(t, _TAG, " ")

    return _where(_where(c, ("<",), without_tags), ("&",), _entity_decode)


# ---------------------------------------------------------------------------
# Masks and normalisation
# ---------------------------------------------------------------------------

def expand_contractions(c) -> Column:
    def expanded(s):
        for pat, rep in CONTRACTIONS:
            s = F.replace(s, F.lit(pat), F.lit(rep))
        return s

    return _where(c, ("'",), expanded)  # every contraction holds one


def mask_urls(c, token: str = "[url]") -> Column:
    return _where(c, ("http", "www."), lambda s: F.regexp_replace(s, URL_PATTERN, token))


def mask_emails(c, token: str = "[email]", mixed_case: bool = False) -> Column:
    return _where(c, ("@",), lambda s: F.regexp_replace(s, EMAIL_MIXED if mixed_case else EMAIL_LOWER, token))


def mask_digits(c, token: str = " [NUM] ") -> Column:
    return F.regexp_replace(_col(c), r"\p{Nd}+", token)


def collapse_ws(c) -> Column:
    return F.trim(F.regexp_replace(F.regexp_replace(_col(c), _OTHER_WS, " "), " {2,}", " "))


def _keep(c, chars: str) -> Column:
    """``chars``, brackets and whitespace of a text, whitespace collapsed."""
    spaced = F.regexp_replace(_col(c), _OTHER_WS, " ")
    return F.trim(F.regexp_replace(F.regexp_replace(spaced, "[^" + chars + r" \[\]]+", ""), " {2,}", " "))


# ---------------------------------------------------------------------------
# The three cleaners
# ---------------------------------------------------------------------------

def clean_base(c) -> Column:
    """QP repair -> HTML -> lower -> [url] -> [email] -> keep a-z0-9 ws [] -> collapse."""
    t = F.lower(html_to_text(qp_repair(c)))
    t = mask_emails(mask_urls(t, "[url]"), "[email]")
    return _keep(t, string.ascii_lowercase + string.digits)


def clean_aggressive(c, keep_masks: bool = False) -> Column:
    """QP -> HTML -> contractions -> lower -> [URL] [EMAIL] [NUM] -> keep a-z ws [] -> collapse.

    The masks are upper case and inserted after lower-casing, so the
    whitelist deletes their letters (``[URL]`` becomes ``[]``).  This is the
    reproduced behaviour; ``keep_masks=True`` keeps the mask words instead."""
    t = F.lower(expand_contractions(html_to_text(qp_repair(c))))
    t = mask_digits(mask_emails(mask_urls(t, "[URL]"), "[EMAIL]"), " [NUM] ")
    return _keep(t, string.ascii_letters if keep_masks else string.ascii_lowercase)


def clean_gentle(c) -> Column:
    """QP -> HTML -> ' [URL] ' -> ' [EMAIL] ' (any case) -> collapse; case and
    punctuation kept."""
    t = html_to_text(qp_repair(c))
    t = mask_emails(mask_urls(t, " [URL] "), " [EMAIL] ", mixed_case=True)
    return collapse_ws(t)


# ---------------------------------------------------------------------------
# Tokens
# ---------------------------------------------------------------------------

def word_tokens(c, lower: bool = True) -> Column:
    """Tokens of two or more word characters (Unicode letters, numbers, '_')."""
    s = F.lower(_col(c)) if lower else _col(c)
    return F.regexp_extract_all(s, F.lit("[" + WORD_RUN + "]{2,}"), 0)


def explode_terms(arr: Column) -> Column:
    """``explode_outer`` for arrays computed by expensive expressions.

    A plain ``explode`` makes Catalyst infer ``size(arr) > 0`` and push that
    filter below the projection, inlining (and so re-running) the whole
    array expression inside the predicate.  The outer form infers nothing;
    callers drop the null produced for empty arrays."""
    return F.explode_outer(arr)


def remove_stop_words(tokens: Column, stop_words) -> Column:
    sw = list(stop_words)
    return F.filter(tokens, lambda t: ~t.isin(sw))


def ngrams(tokens: Column, n: int) -> Column:
    """Contiguous n-grams of a token array, joined with a space."""
    if n == 1:
        return tokens
    size = F.size(tokens)
    head = F.slice(tokens, 1, F.greatest(size - (n - 1), F.lit(0)))

    def gram(x, i):
        parts = [x] + [tokens[i + k] for k in range(1, n)]
        return F.concat_ws(" ", *parts)

    return F.transform(head, gram)


def ngram_range(tokens: Column, lo: int, hi: int) -> Column:
    grams = [ngrams(tokens, n) for n in range(lo, hi + 1)]
    return grams[0] if len(grams) == 1 else F.concat(*grams)


def whitespace_words(c) -> Column:
    """``str.split()``: runs of non-whitespace."""
    return F.filter(F.split(_col(c), WS_RUN), lambda w: w != "")


def preview(c, n: int = 100, single_line: bool = False) -> Column:
    s = _col(c)
    if single_line:
        s = F.replace(s, F.lit("\n"), F.lit(" "))
    return F.when(F.length(s) > n, F.concat(F.substring(s, 1, n), F.lit("..."))).otherwise(s)


def text_column(columns: list[str]) -> Column:
    return consolidate(columns, TEXT_CANDIDATES)

"""Extraction from stored HTML pages and e-mail threads.

The original work crawled pages one request at a time; here the same
extraction runs as column expressions over a table of stored HTML.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import text as T
from ..functions.barrier import materialize
from ..functions.constants import NO_DESCRIPTION


def _inner_text(fragment: Column) -> Column:
    return T.collapse_ws(T.html_to_text(fragment))


def absolute_url(base: Column, href: Column) -> Column:
    """``urljoin`` for the common cases: absolute, scheme-relative,
    root-relative and directory-relative references."""
    scheme = F.regexp_extract(base, r"^([a-zA-Z][a-zA-Z0-9+.-]*):", 1)
    origin = F.regexp_extract(base, r"^([a-zA-Z][a-zA-Z0-9+.-]*://[^/?#]*)", 1)
    base_dir = F.regexp_extract(base, r"^([^?#]*/)", 1)
    return (F.when(href.rlike(r"^[a-zA-Z][a-zA-Z0-9+.-]*:"), href)
             .when(href.startswith("//"), F.concat(scheme, F.lit(":"), href))
             .when(href.startswith("/"), F.concat(origin, href))
             .when(href == "", base)
             .otherwise(F.concat(base_dir, href)))


def page_links(pages: DataFrame, id_col: str = "page_id", url: str = "url", html: str = "html") -> DataFrame:
    """One row per navigation link: (page_id, item_no, title, link)."""
    nav = F.regexp_extract(F.col(html), r"(?is)<nav\b[^>]*>(.*?)</nav>", 1)
    anchors = F.regexp_extract_all(nav, F.lit(r"(?is)<a\b[^>]*>.*?</a>"), 0)
    p = pages.select(id_col, url, F.posexplode_outer(anchors).alias("item_no", "_a")) \
             .filter(F.col("item_no").isNotNull())
    href = F.regexp_extract(F.col("_a"), r"""(?is)\bhref\s*=\s*["']([^"']*)["']""", 1)
    title = _inner_text(F.regexp_extract(F.col("_a"), r"(?is)<a\b[^>]*>(.*?)</a>", 1))
    return p.select(id_col, "item_no", title.alias("title"), absolute_url(F.col(url), href).alias("link"))


def page_extract(pages: DataFrame, id_col: str = "page_id", url: str = "url", html: str = "html") -> DataFrame:
    """Title (first heading, else <title>), description (first paragraph of
    the article, else the article text, else a fixed placeholder)."""
    h = F.col(html)
    heading = _inner_text(F.regexp_extract(h, r"(?is)<h[1-6]\b[^>]*>(.*?)</h[1-6]\s*>", 1))
    doc_title = _inner_text(F.regexp_extract(h, r"(?is)<title\b[^>]*>(.*?)</title\s*>", 1))
    article = F.regexp_extract(h, r"(?is)<article\b[^>]*>(.*?)</article\s*>", 1)
    first_p = _inner_text(F.regexp_extract(article, r"(?is)<p\b[^>]*>(.*?)(?=<p\b|</p\s*>|</article|$)", 1))
    body = _inner_text(article)
    desc = F.coalesce(F.nullif(first_p, F.lit("")), F.nullif(body, F.lit("")), F.lit(NO_DESCRIPTION))
    title = F.coalesce(F.nullif(heading, F.lit("")), doc_title)
    return pages.select(id_col, title.alias("title"), F.col(url).alias("link"), desc.alias("description"))


def page_section(pages: DataFrame, id_col: str = "page_id", html: str = "html", keyword: str = "email",
                 tries: int = 5) -> DataFrame:
    """Text following the first heading: the first of the next ``tries``
    paragraphs whose text contains ``keyword`` (case-insensitive), else the
    first paragraph after the heading."""
    after = F.regexp_extract(F.col(html), r"(?is)</h[1-6]\s*>(.*)$", 1)
    paras = F.slice(F.regexp_extract_all(after, F.lit(r"(?is)<p\b[^>]*>(.*?)(?=<p\b|</p\s*>|</article|$)"), 1), 1, tries)
    texts = F.transform(paras, lambda x: _inner_text(x))
    hit = F.filter(texts, lambda x: F.instr(F.lower(x), keyword.lower()) > 0)
    section = F.coalesce(F.try_element_at(hit, F.lit(1)), F.try_element_at(texts, F.lit(1)))
    return pages.select(id_col, section.alias("section"), (F.size(hit) > 0).alias("keyword_found"))


def _pieces(html: str) -> Column:
    """The page cut at each ``<``, scripts, styles and comments gone: a piece
    is a tag (from its name) and the text behind it."""
    v = F.regexp_replace(F.col(html), r"(?is)<(script|style)\b[^>]*+(?:>.*?(?:</\1\s*+>|\z)|\z)", " ")
    return F.split(F.regexp_replace(v, r"(?s)<!--.*?(-->|\z)", " "), "<")


def elements(pages: DataFrame, tag: str, css_class: str | None = None, id_col: str = "page_id",
             html: str = "html", part: bool = False) -> DataFrame:
    """The elements of a page, nested ones too: (id, element_no from 0 in the
    order of their start, depth from 1, opens, closes), the last two being
    piece numbers from 0.

    ``tag`` is a pattern of names (``div``, ``h[1-6]``), ``css_class`` one of
    the class names that the element must carry (with ``part``, a part of its
    class attribute).  A running sum over the tags
    of a page gives the depth; at one depth starts and ends alternate, so an
    element ends at the next tag of its depth, and one that is never closed at
    the end of the page.  An end tag too many opens nothing.  Only piece
    numbers are shuffled, no text.  Ids are unique; null pages have no
    elements."""
    cut = pages.select(id_col, _pieces(html).alias("_s"))
    p = cut.select(id_col, F.size("_s").alias("_end"), F.posexplode_outer("_s").alias("opens", "_piece"))
    step = (F.when(F.col("_piece").rlike(rf"(?i)^(?:{tag})(?:[\s/>]|$)"), 1)
             .when(F.col("_piece").rlike(rf"(?i)^/(?:{tag})(?:[\s>]|$)"), -1))
    wanted = F.lit(True) if css_class is None else F.col("_piece").rlike(class_pattern(css_class, part))
    tags = p.select(id_col, "opens", "_end", step.alias("_step"), wanted.alias("_wanted")).filter(F.col("_step").isNotNull())
    tags = tags.withColumn("depth", F.sum("_step").over(Window.partitionBy(id_col).orderBy("opens"))
                           + F.when(F.col("_step") < 0, 1).otherwise(0))
    ends = F.lead("opens").over(Window.partitionBy(id_col, "depth").orderBy("opens"))
    found = tags.withColumn("closes", F.coalesce(ends, F.col("_end"))).filter((F.col("_step") > 0) & F.col("_wanted"))
    no = F.row_number().over(Window.partitionBy(id_col).orderBy("opens")) - 1
    return found.select(id_col, no.alias("element_no"), F.col("depth").cast("int").alias("depth"), "opens", "closes")


def class_pattern(css_class: str, part: bool = False) -> str:
    """Pattern of a start tag (from its name) that carries a class."""
    before, after = ("", "") if part else (r"\s", r"(?:\s[^\"'>]*)?[\"']")
    return rf"""(?is)^[^>]*\sclass\s*=\s*["'](?:[^"'>]*{before})?{re.escape(css_class)}{after}"""


def _first_inside(chain: list[DataFrame], id_col: str) -> DataFrame:
    """``chain[0]`` with ``_field``: (opens, closes) of the first element of
    ``chain[1]`` inside it, of the first of ``chain[2]`` inside that, and so
    on; null where one is missing.  One shuffle; running windows from the end
    of a page to its start."""
    u = None
    for k, e in enumerate(chain):
        e = e.select(id_col, F.lit(k).alias("_kind"), "element_no", "opens", "closes")
        u = e if u is None else u.unionByName(e)
    u = u.withColumn("_field", F.when(F.col("_kind") == len(chain) - 1, F.struct("opens", "closes")))
    later = Window.partitionBy(id_col).orderBy(F.desc("opens")).rangeBetween(Window.unboundedPreceding, -1)
    for k in reversed(range(1, len(chain))):
        nearest = F.last(F.when(F.col("_kind") == k, F.struct("opens", "_field")), ignorenulls=True).over(later)
        inside = F.when(F.col("_near.opens") < F.col("closes"), F.col("_near._field"))
        u = u.withColumn("_near", nearest) \
             .withColumn("_field", F.when(F.col("_kind") == k - 1, inside).otherwise(F.col("_field"))).drop("_near")
    return u.filter(F.col("_kind") == 0).drop("_kind")


def _inner(pieces: Column, e: Column) -> Column:
    """What stands between the tags of an element."""
    whole = F.array_join(F.slice(pieces, e["opens"] + 1, e["closes"] - e["opens"]), "<")
    return F.regexp_replace(whole, r"^[^>]*>?", "")


def _with_elements(pages: DataFrame, found: dict[str, DataFrame], id_col: str, html: str,
                   columns: tuple[str, ...] = ("element_no", "depth", "opens", "closes")) -> DataFrame:
    """``pages`` with the array ``_s`` of pieces and, per name, the array of
    the page's elements in order (empty for none)."""
    out = materialize(pages, "_s", _pieces(html))
    for name, e in found.items():
        rows = e.groupBy(id_col).agg(F.sort_array(F.collect_list(F.struct(*columns))).alias(name))
        out = out.join(rows, id_col, "left")
    return out


def page_elements(pages: DataFrame, tag: str, css_class: str | None = None, id_col: str = "page_id",
                  html: str = "html") -> DataFrame:
    """(id, element_no, depth, text) of each element of a page."""
    p = _with_elements(pages, {"_e": elements(pages, tag, css_class, id_col, html)}, id_col, html)
    inner = F.transform("_e", lambda e: F.struct(e["element_no"].alias("element_no"), e["depth"].alias("depth"),
                                                 _inner(F.col("_s"), e).alias("inner")))
    rows = p.select(id_col, F.explode_outer(inner).alias("_e")).filter(F.col("_e").isNotNull())
    return rows.select(id_col, "_e.element_no", "_e.depth", _inner_text(F.col("_e.inner")).alias("text"))


def page_items(pages: DataFrame, container: str = "div", css_class: str | None = "views-row", heading: str | None = "h2",
               field: tuple[str, ...] = ("field-name-body", "field-item"), id_col: str = "page_id", url: str = "url",
               html: str = "html") -> DataFrame:
    """A row per item of an archive page: (id, item_no, title, link,
    description) of each ``container`` element, nested ones too.

    Title and link are those of the first anchor in the first ``heading`` (in
    the item where None); items without one go.  The field of an item is the
    first ``div`` in it whose class attribute holds the first name of
    ``field``, in that the first that holds the next, and so on (the item for
    no names).  The description is the text of its first paragraph, of the
    whole field where it has none, and a fixed placeholder where that is empty
    or a name is missing."""
    chain = [elements(pages, container, css_class, id_col, html),
             *[elements(pages, "div", name, id_col, html, part=True) for name in field]]
    p = _with_elements(pages, {"_e": _first_inside(chain, id_col)}, id_col, html,
                       ("element_no", "opens", "closes", "_field"))
    inner = F.transform("_e", lambda e: F.struct(
        e["element_no"].alias("item_no"), _inner(F.col("_s"), e).alias("inner"),
        F.when(e["_field"].isNotNull(), _inner(F.col("_s"), e["_field"])).alias("field")))
    rows = p.select(id_col, url, F.explode_outer(inner).alias("_e")).filter(F.col("_e").isNotNull())
    rows = rows.select(id_col, url, "_e.item_no", F.col("_e.inner").alias("_x"), F.col("_e.field").alias("_field"))
    within = F.regexp_extract("_x", rf"(?is)<{heading}\b[^>]*>(.*?)(?:</{heading}\s*>|\z)", 1) if heading else F.col("_x")
    anchor = F.regexp_extract(within, r"(?is)<a\b[^>]*>.*?(?:</a\s*>|\z)", 0)
    rows = rows.select(id_col, url, "item_no", "_field", anchor.alias("_a")).filter(F.col("_a") != "")
    href = F.regexp_extract("_a", r"""(?is)\bhref\s*=\s*["']([^"']*)["']""", 1)
    has_p = F.col("_field").rlike(r"(?i)<p[\s>]")
    first_p = F.regexp_extract("_field", r"(?is)<p(?:\s[^>]*)?>(.*?)(?:<p[\s>]|</p\s*>|\z)", 1)
    text = _inner_text(F.when(has_p, first_p).otherwise(F.col("_field")))
    return rows.select(id_col, "item_no", _inner_text(F.col("_a")).alias("title"),
                       absolute_url(F.col(url), href).alias("link"),
                       F.coalesce(F.nullif(text, F.lit("")), F.lit(NO_DESCRIPTION)).alias("description"))


def section_by_heading(pages: DataFrame, heading, follow: str = "div", keyword: str = "email", retries: int = 4,
                       id_col: str = "page_id", html: str = "html") -> DataFrame:
    """Text of the element ``follow`` that comes after the first heading whose
    text is ``heading`` (a string or a Column): the first of ``retries`` + 1
    whose text contains ``keyword`` (case-insensitive), else the last of those.
    A row per page: (id, section, keyword_found); null and false where the page
    has no such heading or nothing follows it."""
    want = F.lit(heading) if isinstance(heading, str) else heading
    p = _with_elements(pages.withColumn("_want", want), {"_h": elements(pages, "h[1-6]", None, id_col, html),
                                                         "_f": elements(pages, follow, None, id_col, html)}, id_col, html)
    heads = F.filter("_h", lambda e: _inner_text(_inner(F.col("_s"), e)) == F.col("_want"))
    p = materialize(p, "_at", F.try_element_at(heads, F.lit(1))["opens"])
    after = F.slice(F.filter("_f", lambda e: e["opens"] > F.col("_at")), 1, retries + 1)
    p = materialize(p, "_texts", F.transform(after, lambda e: _inner_text(_inner(F.col("_s"), e))))
    p = materialize(p, "_hits", F.filter("_texts", lambda x: F.instr(F.lower(x), keyword.lower()) > 0))
    section = F.coalesce(F.try_element_at("_hits", F.lit(1)), F.try_element_at("_texts", F.lit(-1)))
    return p.select(id_col, section.alias("section"), F.coalesce(F.size("_hits") > 0, F.lit(False)).alias("keyword_found"))


def combine_title_body(df: DataFrame, title: str = "Title", body: str = "Text") -> DataFrame:
    """Both columns required; ``combined_text = 'Title: {Title}\\n\\n{Text}'``."""
    missing = [c for c in (title, body) if c not in df.columns]
    if missing:
        raise ValueError(f"missing required columns: {missing}")
    return df.withColumn("combined_text", F.format_string("Title: %s\n\n%s", F.col(title), F.col(body)))


def build_threads(turns: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role",
                  text: str = "text") -> DataFrame:
    """A thread per conversation: turns in order, later turns introduced by a
    header line ('From: ' for the assistant, 'Sent: ' for the user, an
    ``<html >`` marker otherwise).  A conversation is one e-mail thread,
    so its turns form one whole text."""
    header = (F.when(F.col(role) == "assistant", F.lit("\nFrom: "))
               .when(F.col(role) == "user", F.lit("\nSent: "))
               .otherwise(F.lit("\n<html >")))
    piece = F.when(F.col(turn) == 0, F.col(text)).otherwise(F.concat(header, F.col(text)))
    g = turns.groupBy(conv).agg(F.sort_array(F.collect_list(F.struct(F.col(turn), piece.alias("p")))).alias("_t"))
    return g.select(conv, F.array_join(F.transform("_t", lambda s: s["p"]), "").alias("thread"))

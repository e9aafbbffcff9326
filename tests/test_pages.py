"""Elements, items and sections of stored HTML against the standard parser."""

import random
from html.parser import HTMLParser

from textmill.functions.constants import NO_DESCRIPTION
from textmill.operators import pages as PG
from textmill.operators import quality as QL
from pyspark.sql import functions as F

VIEW = """<html><body><!-- <div class="views-row">hidden</div> --><script>var a = '<div class="views-row">';</script>
<div class="view"><div class="views-row odd"><div><h2 class="t"><a href="/one">First &amp; best</a></h2></div>
  <div class="field field-name-body x"><div class="inner"><div class="field-item even"><p>Para <b>one</b></p><p>two</p></div></div></div></div>
<div class='first views-row'><h2><a href="two.html">Second</a></h2>
  <div class="field-name-body"><div class="field-item">No paragraph here</div></div>
  <div class="views-row"><h2><a href="https://other.org/x">Nested</a></h2></div></div>
<DIV CLASS="views-row"><h2>No link</h2></DIV><div class="views-rows"><h2><a href="/no">other class</a></h2></div>
</div></div><div class="views-row"><h2><a href="">Unclosed</a></h2>"""


def _pages(spark, *html):
    rows = [(k, "http://site.org/dir/page?q=1", h) for k, h in enumerate(html)]
    return spark.createDataFrame(rows, "page_id long, url string, html string")


def test_items_by_container(spark):
    got = {(r.page_id, r.title): (r.link, r.description) for r in PG.page_items(_pages(spark, VIEW, None, "", "<div")).collect()}
    assert got == {
        (0, "First & best"): ("http://site.org/one", "Para one"),
        (0, "Second"): ("http://site.org/dir/two.html", "No paragraph here"),
        (0, "Nested"): ("https://other.org/x", NO_DESCRIPTION),
        (0, "Unclosed"): ("http://site.org/dir/page?q=1", NO_DESCRIPTION),
    }


def test_section_after_heading(spark):
    page = "<h1>Other</h1><div>no</div><h3 id=x>What <i>makes</i> this?</h3><p>p</p>{}<div>last</div>"
    tries = ["<div>one <div>inner</div> tail</div>", "<div>a</div><div>an EMAIL b</div>", "<div>1</div>" * 6]
    got = PG.section_by_heading(_pages(spark, *[page.format(t) for t in tries], "<h1>x</h1><div>y</div>", None, ""), "What makes this?")
    assert {r.page_id: (r.section, r.keyword_found) for r in got.collect()} == {
        0: ("last", False), 1: ("an EMAIL b", True), 2: ("1", False), 3: (None, False), 4: (None, False), 5: (None, False)}


class Depths(HTMLParser):
    """(depth, text) of each div, by a stack."""

    def __init__(self):
        super().__init__()
        self.open, self.found = [], []

    def handle_starttag(self, tag, attrs):
        if tag == "div":
            self.found.append([len(self.open) + 1, ""])
            self.open.append(self.found[-1])

    def handle_endtag(self, tag):
        if tag == "div" and self.open:
            self.open.pop()

    def handle_data(self, data):
        for e in self.open:
            e[1] += " " + data


def test_elements_against_a_stack(spark):
    rng = random.Random(3)
    html = []
    for _ in range(40):
        out, depth = [], 0
        for k in range(rng.randint(0, 60)):
            kind = rng.choice(["open", "close", "text", "other"])
            if kind == "close" and not depth:
                continue
            depth += {"open": 1, "close": -1}.get(kind, 0)
            out.append({"open": "<div class='c'>", "close": "</div >", "text": f"t{k}", "other": f"<divide>d{k}</divide>"}[kind])
        html.append("".join(out))
    got = {}
    for r in PG.page_elements(_pages(spark, *html), "div").collect():
        got.setdefault(r.page_id, {})[r.element_no] = (r.depth, r.text.split())
    for k, h in enumerate(html):
        want = Depths()
        want.feed(h)
        want.close()
        assert got.get(k, {}) == {i: (d, t.split()) for i, (d, t) in enumerate(want.found)}


def test_deep_and_long_pages(spark):
    deep = "<div>" * 20_000 + "x" + "</div>" * 20_000
    row = PG.elements(_pages(spark, deep, "a" * 2_000_000), "div").agg(F.max("depth"), F.count("*")).first()
    assert tuple(row) == (20_000, 20_000)
    assert PG.page_items(_pages(spark, VIEW).limit(0)).count() == 0


def test_stage_report_once_equals_stages(spark):
    rows = [("a", 1), ("a", 1), ("bb", None), (None, 2), ("cc", 0), ("", 0)]
    df = spark.createDataFrame(rows, "text string, label int")
    lab = df.filter("label is not null")
    long = lab.filter("length(text) >= 1")
    want = QL.stage_report([("master", df), ("labelled", lab), ("long", long), ("dedup", long.dropDuplicates(["text"]))])
    got = QL.stage_report_once(df, [("labelled", F.col("label").isNotNull()), ("long", F.length("text") >= 1)], ("dedup", F.col("text")))
    assert sorted(map(tuple, got.select(want.columns).collect())) == sorted(map(tuple, want.collect()))
    assert [r.rows_after for r in QL.stage_report_once(df.limit(0), [("x", F.lit(True))], ("d", F.col("text"))).collect()] == [0, 0, 0]

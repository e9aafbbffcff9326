"""Cleaners and scalar text functions against fixed unit vectors."""

import pytest
from pyspark.sql import functions as F

from textmill.functions import features as FT
from textmill.functions import text as T

QP_VECTORS = [
    ("café", "caf"), ("=C3=A9", "é"), ("=c3=a9", "é"), ("=E9x", "x"), ("a=3Db", "a=b"),
    ("soft=\nbreak", "softbreak"), ("soft=\r\nbreak", "softbreak"), ("a= \nb", "a= \nb"), ("a=20\nb", "a \nb"),
    ("a=ZZb", "a=ZZb"), ("==41", "=41"), ("=4", "=4"), ("tail=", "tail"),
    ("http://a/?q=ab&id=42", "http://a/?q&idB"), ("“smart” — 日本", "smart  "), ("Ã©", "é"), ("a_b", "a_b"),
]


def _one(spark, col_fn, value):
    return spark.createDataFrame([(value,)], "s string").select(col_fn(F.col("s")).alias("o")).first().o


def test_qp_repair_vectors(spark):
    df = spark.createDataFrame(QP_VECTORS, "i string, e string")
    bad = [(r.i, r.e, r.o) for r in df.select("i", "e", T.qp_repair("i").alias("o")).collect() if r.o != r.e]
    assert bad == []


@pytest.mark.parametrize("fn,inp,exp", [
    (T.clean_base, "Visit https://x.y/z NOW!", "visit [url] now"),
    (T.clean_base, "Mail Bob.1@Ex.com, 5pm", "mail [email] 5pm"),
    (T.clean_aggressive, "I can't pay 100", "i ca not pay []"),
    (T.clean_aggressive, "go www.x.y", "go []"),
    (T.clean_gentle, "Go www.x.y NOW!", "Go [URL] NOW!"),
    (T.clean_base, None, ""),
])
def test_cleaners(spark, fn, inp, exp):
    assert _one(spark, fn, inp) == exp


def test_aggressive_keep_masks(spark):
    assert _one(spark, lambda c: T.clean_aggressive(c, keep_masks=True), "I paid 100 at www.x.y") == "i paid [NUM] at [URL]"


@pytest.mark.parametrize("raw,exp", [(" SPAM ", 1), ("Phishing Email", 1), ("1.0", 1), ("ham", 0),
                                     ("Not Phishing", 0), ("phishing", None), ("2", None)])
def test_label_standardise(spark, raw, exp):
    assert _one(spark, T.standardise_label, raw) == exp


@pytest.mark.parametrize("w,exp", [("ÀB", 1), ("A1", 1), ("[URL]", 1), ("1", 0), ("Aß", 0)])
def test_upper_words(spark, w, exp):
    assert _one(spark, FT.upper_count, w) == exp


def test_html_to_text(spark):
    h = ('<html><head><script>var t="</p>";</script><style>p{}</style></head><body><p>Hi &amp; bye &copy; '
         '&#233;&#xE9; &bogus; a < b <3 <a@b.c> x</p><!-- c --></body></html>')
    assert _one(spark, lambda c: T.collapse_ws(T.html_to_text(c)), h) == "Hi & bye © éé &bogus; a < b <3 x"


def test_metadata_features(spark):
    row = spark.createDataFrame([("Hello, WORLD! It's OK now",)], "t string").select(*FT.metadata_columns("t")).first()
    assert (row.text_length, row.word_count, row.punct_count, row.upper_count) == (25, 5, 3, 2)


def test_ngrams_and_tokens(spark):
    r = spark.createDataFrame([("The café sells 2 big_cakes",)], "t string") \
        .select(T.ngram_range(T.remove_stop_words(T.word_tokens("t"), ["the"]), 1, 2).alias("g")).first().g
    assert r == ["café", "sells", "big_cakes", "café sells", "sells big_cakes"]


def test_first_message(spark):
    from textmill.operators.quality import first_message
    rows = [("hello\nFrom: bob", "hello\n"), ("x Sent: y From: z", "x Sent: y "), ("abc", "ab"), ("a <html b", "a "),
            ("no Sent: here", "no ")]
    df = spark.createDataFrame(rows, "t string, e string").select("e", first_message("t").alias("o")).collect()
    assert [r.o for r in df] == [r.e for r in df]


def test_format_count(spark):
    vals = [(999, "999"), (1234, "1.2K"), (253_250_000, "253.2M"), (1_500_000, "1.5M"), (2_000_000_000, "2.00B")]
    df = spark.createDataFrame(vals, "n long, e string").select("e", FT.format_count(F.col("n")).alias("o")).collect()
    assert [r.o for r in df] == [e for _, e in vals]


def test_sigmoid_softmax(spark):
    r = spark.createDataFrame([([1.0, 3.0, 2.0],)], "a array<double>").select(
        FT.argmax("a").alias("i"), F.array_max(FT.softmax("a")).alias("p"), FT.sigmoid(F.lit(1000.0)).alias("s")).first()
    assert r.i == 1 and abs(r.p - 0.665240955) < 1e-6 and r.s == 1.0


def test_long_tags_do_not_recurse(spark):
    long = ["hi <a " + "x" * 200_000, "hi <a " + "x " * 100_000 + "> end", "hi <a href='" + "y" * 100_000 + "'>end</a>", "</p" + " " * 100_000]
    df = spark.createDataFrame([(k, t) for k, t in enumerate(long)], "k int, t string")
    got = [r["o"] for r in df.select("k", T.html_to_text("t").alias("o")).orderBy("k").collect()]
    assert got[0] == long[0] and got[1] == "hi   end" and got[2] == "hi  end " and got[3] == long[3]


def test_labels_are_stripped_of_any_white_space(spark):
    raw = ["spam\n", "\tham", "spam\r", "\u00a0Safe Email ", "sp am", None]
    df = spark.createDataFrame([(k, t) for k, t in enumerate(raw)], "k int, t string")
    assert [r["o"] for r in df.select("k", T.standardise_label("t").alias("o")).orderBy("k").collect()] == [1, 0, 1, 0, None, None]


def test_character_references(spark):
    import html
    cases = ["a &apos;b&apos; &amp c &ampd &lbrace;x&rbrace; &notit; &notin; &frac12; &AMP;&copy2024 R&D AT&T & &; &nope; &#",
             "&#146; &#128;&#x9f; &#65 &#65; &#x41;z &#X4a &#0; &#xD800; &#1114112; &#99999999999999; &#x0000000000041; &#11; &#x1FFFE;",
             "&there4;&NotEqualTilde; &#129;", "", "plain", "&&amp;&", "&lt;b&gt &ltx"]
    df = spark.createDataFrame([(c,) for c in cases], "s string")
    assert [r[0] for r in df.select(T._entity_decode(F.col("s"))).collect()] == [html.unescape(c) for c in cases]


def test_unclosed_script_goes_and_is_read_once(spark):
    import time
    texts = ["keep <script>alert(1)", "a <STYLE x='y'>p{} </style >b", "a <script", "a <scripty>b", "<script>x</script\n>y<style>"]
    got = [r[0] for r in spark.createDataFrame([(t,) for t in texts], "t string").select(T.collapse_ws(T.html_to_text("t"))).collect()]
    assert got == ["keep", "a b", "a", "a b", "y"]
    t0 = time.time()
    long = spark.createDataFrame([("<script>" * 130_000,)], "t string").select(T.clean_base("t")).first()[0]
    assert long == "" and time.time() - t0 < 10


def test_values_bound_once(spark):
    from textmill.functions import features as FT
    from textmill.operators import clusters as CL
    df = spark.createDataFrame([([1.0, 2.0, 3.0],), ([0.0, 0.0],)], "a array<double>")
    soft, sig, unit = zip(*df.select(FT.softmax("a"), FT.normalised_sigmoid("a"), CL.l2_normalise("a")).collect())
    assert abs(soft[0][2] - 0.66524096) < 1e-8 and soft[1] == [0.5, 0.5] and abs(sum(sig[0]) - 1) < 1e-12
    assert abs(unit[0][0] - 14 ** -0.5) < 1e-12 and unit[1] == [0.0, 0.0]

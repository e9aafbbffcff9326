"""Per-row metadata features and scalar scoring expressions (all JVM-side)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .constants import LABEL_NAMES_EDA, LABEL_NAMES_PLAIN, LABEL_NAMES_SHORT, MONEY_KEYWORDS, PUNCT_CLASS
from .text import _col, let, whitespace_words


def text_length(c) -> Column:
    return F.length(_col(c))


def word_count(c) -> Column:
    return F.size(whitespace_words(c))


def punct_count(c) -> Column:
    return F.regexp_count(_col(c), F.lit(PUNCT_CLASS))


def upper_count(c) -> Column:
    """Words with at least one cased character and no lower-case one."""
    return F.size(F.filter(whitespace_words(c), lambda w: (F.upper(w) == w) & (F.lower(w) != w)))


def metadata_columns(c) -> list[Column]:
    """The four EDA features.  Pass a column (not an expression): it is
    referenced several times."""
    return [text_length(c).cast("int").alias("text_length"),
            word_count(c).cast("int").alias("word_count"),
            punct_count(c).cast("int").alias("punct_count"),
            upper_count(c).cast("int").alias("upper_count")]


def _name_map(names: dict[int, str]) -> Column:
    return F.create_map(*[x for k, v in sorted(names.items()) for x in (F.lit(k), F.lit(v))])


def label_name(c, style: str = "eda") -> Column:
    names = {"eda": LABEL_NAMES_EDA, "short": LABEL_NAMES_SHORT, "plain": LABEL_NAMES_PLAIN}[style]
    return _name_map(names)[_col(c)]


def sigmoid(c) -> Column:
    x = F.greatest(F.lit(-250.0), F.least(F.lit(250.0), _col(c).cast("double")))
    return F.lit(1.0) / (F.lit(1.0) + F.exp(-x))


def _shares(positive: Column) -> Column:
    total = lambda v: F.aggregate(v, F.lit(0.0), lambda acc, x: acc + x)
    return let(positive, lambda v: let(total(v), lambda t: F.transform(v, lambda x: x / t)))


def normalised_sigmoid(arr) -> Column:
    """Sigmoid of each score divided by the sum of the sigmoids."""
    return _shares(F.transform(_col(arr), lambda x: sigmoid(x)))


def softmax(arr) -> Column:
    a = F.transform(_col(arr), lambda x: x.cast("double"))
    return let(a, lambda v: let(F.array_max(v), lambda m: _shares(F.transform(v, lambda x: F.exp(x - m)))))


def argmax(arr) -> Column:
    """0-based index of the first maximum."""
    return (F.array_position(_col(arr), F.array_max(_col(arr))) - 1).cast("int")


def format_count(c) -> Column:
    """1234 -> '1.2K', 1_500_000 -> '1.5M', 2_000_000_000 -> '2.00B'.
    Ties round half-to-even, as Python's float formatting does."""
    x = _col(c)

    def fmt(v, digits, suffix):
        return F.concat(F.format_string(f"%.{digits}f", F.bround(v, digits)), F.lit(suffix))

    return (F.when(x >= 1_000_000_000, fmt(x / 1e9, 2, "B"))
            .when(x >= 1_000_000, fmt(x / 1e6, 1, "M"))
            .when(x >= 1_000, fmt(x / 1e3, 1, "K"))
            .otherwise(x.cast("string")))


def keyword_tags(c, keywords=MONEY_KEYWORDS) -> Column:
    low = F.lower(_col(c))
    return F.filter(F.array(*[F.lit(k) for k in keywords]), lambda k: F.instr(low, k) > 0)


def ensemble(pred_a, conf_a, pred_b, conf_b, w_a: float = 0.5, w_b: float = 0.5) -> Column:
    """Weighted vote of two scorers; conf in [0,1] for the predicted class.
    Returns struct(pred, score, confidence_pct)."""
    pa = F.when(_col(pred_a) == 1, _col(conf_a)).otherwise(1 - _col(conf_a))
    pb = F.when(_col(pred_b) == 1, _col(conf_b)).otherwise(1 - _col(conf_b))
    s = F.lit(w_a) * pa + F.lit(w_b) * pb
    pred = F.when(s > 0.5, 1).otherwise(0)
    conf = F.when(pred == 1, s).otherwise(1 - s) * 100
    return F.struct(pred.alias("pred"), s.alias("score"), conf.alias("confidence_pct"))

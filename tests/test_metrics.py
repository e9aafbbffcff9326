"""Golden confusion matrices: accuracy and weighted metrics to 1e-6."""

import pytest

from textmill.operators import metrics as MT

GOLDEN = [  # [[tn, fp], [fn, tp]], accuracy, weighted precision, weighted F1
    ([[7911, 217], [544, 5836]], 0.947546, 0.948188, 0.947374),
    ([[7905, 223], [226, 6154]], 0.969052, 0.969050, 0.969051),
    ([[7915, 213], [193, 6187]], 0.972015, 0.972029, 0.972020),
    ([[7910, 218], [258, 6122]], 0.967191, 0.967183, 0.967179),
    ([[8292, 89], [138, 6292]], 0.984674, 0.984682, 0.984667),
    ([[8306, 75], [156, 6274]], 0.984403, 0.984440, 0.984392),
    ([[8321, 60], [125, 6305]], 0.987509, 0.987533, 0.987502),
    ([[22524, 601], [486, 17800]], 0.973751, 0.973783, 0.973759),
    ([[24079, 141], [327, 18456]], 0.989117, 0.989142, 0.989111),
]


@pytest.mark.parametrize("cm,acc,wp,wf", GOLDEN)
def test_golden_weighted(spark, cm, acc, wp, wf):
    r = MT.weighted_metrics(MT.confusion_from_matrix(spark, cm)).first()
    assert abs(r.accuracy - acc) < 1e-6
    assert abs(r.weighted_precision - wp) < 1e-6
    assert abs(r.weighted_f1 - wf) < 1e-6


def test_inference_averages(spark):
    rows = []
    for name, kind, correct in [("svc", "ML", 10), ("lr", "ML", 10), ("nb", "ML", 12), ("sgd", "ML", 5),
                                ("bert", "DL", 9), ("distil", "DL", 10), ("roberta", "DL", 9)]:
        rows += [(name, kind, i < correct) for i in range(14)]
    df = spark.createDataFrame(rows, "model_name string, model_type string, is_correct boolean")
    out = {r.model_name: r.accuracy for r in MT.model_inference_accuracy(df).collect()}
    assert abs(out["__ML__"] - 0.660714) < 1e-6
    assert abs(out["__DL__"] - 0.666667) < 1e-6
    assert abs(out["__ALL__"] - 0.663265) < 1e-6
    assert abs(out["nb"] - 12 / 14) < 1e-12


def test_zero_division(spark):
    r = {x.row: x for x in MT.classification_report(MT.confusion_from_matrix(spark, [[5, 0], [3, 0]])).collect()}
    assert r["1"].precision == 0.0 and r["1"].f1 == 0.0

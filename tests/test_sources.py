"""File sources and sinks: CSV drift union, LFS quarantine, provenance,
JSON dumps, evaluation logs, round trips (all in fresh temp folders)."""

import json
import os
import tempfile

import pytest
from pyspark.sql import functions as F

from textmill.sinks import writers as W
from textmill.sources import files as S
from textmill.sources import json_array as J


def _write(path, text):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w", encoding="utf-8") as f:
        f.write(text)


def _tree():
    root = tempfile.mkdtemp(prefix="tm-src-")
    _write(f"{root}/top,level.csv", 'text,label\n"hello, world",spam\n"multi\nline ""quoted""",ham\n')
    _write(f"{root}/setA/a.csv", 'Email Text,Email Type\nfirst mail,Phishing Email\nsecond,Safe Email\nthird,NA\n')
    _write(f"{root}/setB/sub/b.csv", 'body,Class,text\nbody only,1.0,\n,0,from text col\n')
    _write(f"{root}/setC/pointer.csv", "version https://git-lfs.github.com/spec/v1\noid sha256:abc\nsize 12\n")
    _write(f"{root}/skip/x.csv", "text,label\nexcluded,1\n")
    return root


def test_read_csv_tree(spark):
    from textmill.functions import text as T
    root = _tree()
    df = S.read_csv_tree(spark, root, exclude_dirs=[f"{root}/skip"])
    rows = df.select(T.consolidate(df.columns, ["text", "Email Text", "Text", "body"]).alias("t"),
                     T.consolidate(df.columns, ["label", "Email Type", "Class"]).alias("l"),
                     "source_file", "source_name", "record_id").collect()
    got = sorted((r.t, r.l, r.source_file, r.source_name, r.record_id) for r in rows)
    root_name = os.path.basename(root)
    assert got == sorted([
        ("hello, world", "spam", "top;level.csv", root_name, 0),
        ('multi\nline "quoted"', "ham", "top;level.csv", root_name, 1),
        ("first mail", "Phishing Email", "a.csv", "setA", 0),
        ("second", "Safe Email", "a.csv", "setA", 1),
        ("third", None, "a.csv", "setA", 2),
        ("body only", "1.0", "b.csv", "setB", 0),
        ("from text col", "0", "b.csv", "setB", 1),
    ])


def test_lfs_quarantine(spark):
    root = _tree()
    files = S.list_csv_files(spark, root)
    real, lfs = S.quarantine_lfs(spark, files)
    assert len(lfs) == 1 and lfs[0].endswith("pointer.csv") and len(real) == 4


def test_missing_expected():
    assert S.missing_expected(["text", "x"], ["text", "Email Text"]) == ["Email Text"]


def test_json_dump_and_logs(spark):
    d = tempfile.mkdtemp(prefix="tm-json-")
    _write(f"{d}/dump.json", json.dumps([{"contents": "a\nFrom: b"}, {"contents": "c", "other": 1}]))
    assert sorted(r.contents for r in S.read_json_dump(spark, f"{d}/dump.json").collect()) == ["a\nFrom: b", "c"]
    log = {"timestamp": "2025-11-28T22:03:43", "model_name": "Linear SVC", "best_hyperparameters": None,
           "metrics": {"test_accuracy": 0.972015, "cross_validation_score": 0.969252},
           "confusion_matrix": [[7915, 213], [193, 6187]], "classification_report": "..."}
    _write(f"{d}/models/linear_svc/logs/evaluation_log.json", json.dumps(log, indent=2))
    _write(f"{d}/models/bert/logs/evaluation_log.json", json.dumps({"model_name": "BERT", "metrics": {"test_accuracy": 0.98}}))
    got = {r.method_dir: r for r in S.read_evaluation_logs(spark, f"{d}/models").collect()}
    assert got["linear_svc"].metrics.test_accuracy == 0.972015
    assert got["linear_svc"].confusion_matrix == [[7915, 213], [193, 6187]]
    assert got["bert"].confusion_matrix is None


AWKWARD = [{"contents": "a } b { c"}, {"contents": 'say "}" \\\\ {'}, {"contents": ""}, {"other": [{"contents": "inner"}, {}]}, {},
           {"contents": "\u00e9\u4e16\U0001f600 }" * 40}, {"contents": "x" * 3000, "deep": {"a": {"b": [1, {"c": "]["}]}}},
           {"contents": None}, {"contents": "tail\\\\"}]


@pytest.mark.parametrize("block, indent", [(151, None), (157, 2), (700, None), (1 << 27, 2)])
def test_json_objects_in_blocks(spark, block, indent):
    d = tempfile.mkdtemp(prefix="tm-json-")
    rows = AWKWARD * 2
    _write(f"{d}/a.json", json.dumps(["{", 1, "}", None, *rows, 'a"{'], indent=indent, ensure_ascii=False))
    _write(f"{d}/b.json", "\n".join(json.dumps(r) for r in AWKWARD))
    _write(f"{d}/c.json", "[]")
    _write(f"{d}/d.json", "")
    _write(f"{d}/e.json", '} [{"contents": "one"}} , {"contents": "never clo')
    want = sorted([json.dumps(r) for r in rows + AWKWARD + [{"contents": "one"}]])
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", block)
    try:
        got = [r.element for r in J.read_json_objects(spark, d).collect()]
        contents = [r.contents for r in S.read_json_dump(spark, f"{d}/a.json").collect()]
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    cut = [e for e in got if "never clo" in e]
    assert len(cut) == 1 and cut[0].startswith('{"contents": "never clo')
    assert sorted(json.dumps(json.loads(e)) for e in got if e not in cut) == want
    assert sorted(map(str, contents)) == sorted(str(r.get("contents")) for r in rows)


def test_json_objects_without_broadcast(spark, monkeypatch):
    d = tempfile.mkdtemp(prefix="tm-json-")
    _write(f"{d}/a.json", json.dumps(AWKWARD * 2))
    monkeypatch.setattr(J, "BROADCAST_BLOCKS", 0)
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", 300)
    try:
        got = [r.element for r in J.read_json_objects(spark, d).collect()]
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    assert sorted(json.dumps(json.loads(e)) for e in got) == sorted(json.dumps(r) for r in AWKWARD * 2)


def test_csv_round_trip(spark):
    d = tempfile.mkdtemp(prefix="tm-csv-")
    rows = [('a "quoted", text\nwith newline', 1), ("plain", 0)]
    df = spark.createDataFrame(rows, "text string, label int")
    W.write_csv(df, f"{d}/out", single_file=True)
    back = S.load_labelled(spark, f"{d}/out", fmt="csv")
    assert sorted((r.text, r.label) for r in back.collect()) == sorted(rows)


def test_history_rows(spark):
    df = spark.createDataFrame([([1, 2, 3], [0.5, 0.4, 0.3], [0.8, 0.85, 0.84])],
                               "epochs array<int>, train_loss array<double>, val_acc array<double>")
    from textmill.operators.metrics import best_epoch
    h = S.history_to_rows(df)
    assert h.count() == 3
    assert best_epoch(h).first().epoch == 2


def test_method_paths():
    p = W.method_paths("/x/ml_methods", "Linear SVC")
    assert p["evaluation_log"] == "/x/ml_methods/linear_svc/logs/evaluation_log.json"


def test_evaluation_log_and_report_round_trip(spark):
    d = tempfile.mkdtemp(prefix="tm-log-")
    record = {"model_name": "Naive Bayes", "best_hyperparameters": {"alpha": 0.1}, "metrics": {"test_accuracy": 0.9},
              "confusion_matrix": [[5, 1], [0, 4]], "classification_report": "class 0\nclass 1"}
    p = W.method_paths(d, "Naive Bayes")
    W.write_evaluation_log(spark, p["evaluation_log"], record)
    W.write_evaluation_report(spark, p["report"], record)
    W.write_evaluation_log(spark, W.method_paths(d, "BERT")["evaluation_log"], {})
    got = {r.method_dir: r for r in S.read_evaluation_logs(spark, d).collect()}
    assert set(got) == {"naive_bayes", "bert"}
    nb, empty = got["naive_bayes"], got["bert"]
    assert nb.metrics.test_accuracy == 0.9 and nb.metrics.cross_validation_score == 0.0
    assert json.loads(nb.best_hyperparameters) == {"alpha": 0.1} and nb.confusion_matrix == [[5, 1], [0, 4]]
    assert (empty.model_name, empty.best_hyperparameters, empty.metrics.test_accuracy) == ("bert", "{}", 0.0)
    report = "\n".join(r.value for r in spark.read.text(p["report"]).collect())
    assert "Model: Naive Bayes" in report and "test_accuracy: 0.900000" in report and "class 1" in report


def test_predictions_in_every_form(spark):
    d = tempfile.mkdtemp(prefix="tm-pred-")
    rows = [{"id": 1, "p": 0.5}, {"id": 2, "p": 0.25}]
    forms = {"lines": "\n".join(map(json.dumps, rows)), "array": json.dumps(rows, indent=2),
             "document": json.dumps({"predictions": rows}), "indented": json.dumps({"predictions": rows}, indent=2)}
    for name, text in forms.items():
        _write(f"{d}/{name}.json", text)
        assert sorted((r.id, r.p) for r in S.read_predictions(spark, f"{d}/{name}.json").collect()) == [(1, 0.5), (2, 0.25)], name


def test_latin_1_files_are_told_from_utf_8(spark):
    root = tempfile.mkdtemp(prefix="tm-enc-")
    for name, encoding in (("a.csv", "utf-8"), ("b.csv", "latin-1")):
        with open(f"{root}/{name}", "w", encoding=encoding) as f:
            f.write('text,label\nplain,0\n"café, crème",1\n')
    with open(f"{root}/empty.csv", "w"):
        pass
    got = sorted((r.source_file, r.record_id, r.text) for r in S.read_csv_tree(spark, root).collect())
    assert got == [(f, i, t) for f in ("a.csv", "b.csv") for i, t in enumerate(("plain", "café, crème"))]


def test_bad_lines(spark):
    d = tempfile.mkdtemp(prefix="tm-bad-")
    _write(f"{d}/a/x.csv", 'text,label\ngood,1\nshort\nwide,1,more\n"quoted, ""x"", y",0\ntrailing,1,\n"multi\nline, z",1,2,3\nlast,0\n')
    _write(f"{d}/b/y.csv", 'body,Class,n\none,0,1\nwide,1,2,3\n"a,b,c,d",1\n')

    def rows(policy):
        df = S.read_csv_tree(spark, d, bad_lines=policy)
        return {(r.source_file, r.record_id): r for r in df.collect()}, df.columns
    kept, columns = rows("keep")
    assert len(kept) == 10 and S.CORRUPT not in columns
    skipped, columns = rows("skip")
    assert S.CORRUPT not in columns
    assert set(kept) - set(skipped) == {("x.csv", 2), ("x.csv", 4), ("x.csv", 5), ("y.csv", 1)}
    assert skipped["x.csv", 1].label is None and skipped["x.csv", 3].text == 'quoted, "x", y'
    assert skipped["y.csv", 2].body == "a,b,c,d" and skipped["y.csv", 2].n is None
    recorded, _ = rows("record")
    raw = {k: r[S.CORRUPT].strip() for k, r in recorded.items() if r[S.CORRUPT] is not None}
    assert set(recorded) == set(kept)
    assert raw == {("x.csv", 1): "short", ("x.csv", 2): "wide,1,more", ("x.csv", 4): "trailing,1,",
                   ("x.csv", 5): '"multi\nline, z",1,2,3', ("y.csv", 1): "wide,1,2,3", ("y.csv", 2): '"a,b,c,d",1'}
    assert S.read_csv_tree(spark, d, bad_lines="record").select("text").where("text = 'last'").count() == 1
    with pytest.raises(ValueError):
        S.read_csv_tree(spark, d, bad_lines="drop")

"""The registry imports anywhere, and the stream scorer reads folders."""

import os
import subprocess
import sys

from textmill.operators import models as MD
from textmill.plans.tables import labelled
from textmill.streaming.scoring import score_stream, scored_view

REPO = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


def test_import_opens_no_jar():
    code = ("import builtins, glob, zipfile\n"
            "def no(*a, **k): raise RuntimeError('jar access')\n"
            "zipfile.ZipFile = no; glob.glob = no\n"
            "import __spark_entry__ as e\n"
            "q, o = e.queries(), e.oracle_sql()\n"
            "assert len(q) > 90 and set(o) <= set(q)")
    subprocess.run([sys.executable, "-c", code], cwd=REPO, check=True, timeout=120)


def test_stream_reads_a_folder_of_parts(spark, tmp_path):
    d = "/root/testdata/sf0.001"
    model = MD.fit_model("naive_bayes", labelled(spark, d).select("record_id", "text", "label"), max_features=200)
    docs = spark.read.parquet(f"{d}/documents.parquet")
    docs.repartition(3).write.parquet(str(tmp_path / "documents.parquet"))
    want = {r["doc_id"]: r for r in scored_view(model, docs).collect()}
    for name, source in (("folder", str(tmp_path)), ("file", d)):
        got = {r["doc_id"]: r for r in score_stream(spark, model, source, "documents.parquet", str(tmp_path / name)).collect()}
        assert got.keys() == want.keys() and len(got) > 100
        assert all(got[k]["pred_label"] == want[k]["pred_label"] and abs(got[k]["prob_1"] - want[k]["prob_1"]) < 1e-9 for k in got)

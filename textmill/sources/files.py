"""File sources.

Raw e-mail CSVs come with different headers.  A single CSV read applies one
header to every file, so files are grouped by their header line (found with
one distributed pass over the first block of each file) and each group is
read once; the groups are unioned by column name.  Provenance comes from
``_metadata``; the per-file row index uses the fact that a multi-line CSV
file is never split across partitions.
"""

from __future__ import annotations

import json
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .json_array import read_json_objects

# FIXED VALUES: marker line of a Git LFS pointer file, and the NA spellings
# that the pandas CSV reader treats as missing.
LFS_SPEC = "version https://git-lfs.github.com/spec/v1"
NA_VALUES = ["", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN",
             "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null"]

CSV_OPTIONS = {"header": "true", "multiLine": "true", "quote": '"', "escape": '"', "mode": "PERMISSIVE",
               "maxCharsPerColumn": "-1", "inferSchema": "false"}
CORRUPT = "_corrupt_record"


def _files_under(spark: SparkSession, root: str, suffix: str = ".csv") -> list[str]:
    """Recursive listing via the Hadoop FileSystem (metadata only)."""
    jvm = spark.sparkContext._jvm
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    path = jvm.org.apache.hadoop.fs.Path(root)
    fs = path.getFileSystem(conf)
    it = fs.listFiles(path, True)
    out = []
    while it.hasNext():
        p = it.next().getPath().toString()
        if p.lower().endswith(suffix):
            out.append(p)
    return sorted(out)


def _norm(p: str) -> str:
    return p.replace("file://", "").replace("file:", "").rstrip("/")


def list_csv_files(spark: SparkSession, root: str, exclude_dirs=()) -> list[str]:
    """``**/*.csv`` under root minus files equal to, or under, an excluded dir."""
    ex = [_norm(e) for e in exclude_dirs]
    files = [f for f in _files_under(spark, root) if not any(_norm(f) == e or _norm(f).startswith(e + "/") for e in ex)]
    if not files:
        raise FileNotFoundError(f"no CSV files under {root}")
    return files


def file_heads(spark: SparkSession, files: list[str]) -> DataFrame:
    """(file_path, first_line, is_utf8) of every file, in one distributed pass
    with map-side sums: the line of the smallest row id in the file's first
    block, and whether all of its bytes are valid UTF-8."""
    t = spark.read.text(files).select("value", F.col("_metadata.file_path").alias("file_path"),
                                      F.col("_metadata.file_block_start").alias("_bs"),
                                      F.monotonically_increasing_id().alias("_mid"))
    return t.groupBy("file_path").agg(F.min_by("value", F.when(F.col("_bs") == 0, F.col("_mid"))).alias("first_line"),
                                      F.bool_and(F.is_valid_utf8("value")).alias("is_utf8"))


def _real(heads: list) -> tuple[list, list[str]]:
    """(heads of data files, paths of Git LFS pointers)."""
    lfs = sorted(r["file_path"] for r in heads if (r["first_line"] or "").strip().startswith(LFS_SPEC))
    pointers = set(lfs)
    return [r for r in heads if r["file_path"] not in pointers], lfs


def quarantine_lfs(spark: SparkSession, files: list[str]) -> tuple[list[str], list[str]]:
    """Split files into (real, lfs_pointers).  Raises when nothing real is left."""
    _, lfs = _real(file_heads(spark, files).collect())  # a row per file
    lfs_n = {_norm(x) for x in lfs}
    real = [f for f in files if _norm(f) not in lfs_n]
    if not real:
        raise RuntimeError(f"all {len(files)} CSV files are Git LFS pointers")
    return real, lfs


def read_csv_group(spark: SparkSession, files: list[str], encoding: str = "UTF-8", bad_lines: str = "keep") -> DataFrame:
    """All files share one header; every column is read as STRING.  Column
    names are kept case-sensitive (``text`` and ``Text`` are different).

    ``bad_lines``: ``keep`` fills what a row lacks with nulls and cuts what it
    has too much; ``skip`` drops rows of more fields than the header (short
    ones stay, as in a lenient pandas read); ``record`` keeps all and adds
    ``_corrupt_record``, the raw text of a row of another width."""
    if bad_lines not in ("keep", "skip", "record"):
        raise ValueError(f"bad_lines must be keep, skip or record, not {bad_lines!r}")
    prev = spark.conf.get("spark.sql.caseSensitive")
    spark.conf.set("spark.sql.caseSensitive", "true")
    try:
        reader = spark.read.options(**CSV_OPTIONS).option("encoding", encoding)
        df = reader.csv(files)
        names = df.columns
        if bad_lines != "keep":
            schema = T.StructType([T.StructField(c, T.StringType()) for c in [*names, CORRUPT]])
            df = reader.schema(schema).option("columnNameOfCorruptRecord", CORRUPT).option("columnPruning", "false").csv(files)
        df = df.select(*[F.col(f"`{c}`") for c in df.columns],
                       F.col("_metadata.file_path").alias("_file_path"), F.col("_metadata.file_name").alias("_file_name"),
                       F.monotonically_increasing_id().alias("_mid"))
    finally:
        spark.conf.set("spark.sql.caseSensitive", prev)
    return df


def too_wide(raw: Column, width: int) -> Column:
    """Whether a raw CSV row has more than ``width`` fields: commas counted
    outside of quotes (a quote that is never closed goes to the end)."""
    bare = F.regexp_replace(raw, r'"[^"]*+(?:"|\z)', "")
    return F.length(bare) - F.length(F.replace(bare, F.lit(","), F.lit(""))) >= width


def with_provenance(df: DataFrame, root: str) -> DataFrame:
    """source_file = file name with ',' -> ';'; source_name = first directory
    below root (root's own name for top-level files); record_id = 0-based
    row index within the file."""
    root_n = _norm(root)
    root_name = root_n.split("/")[-1]
    rel = F.regexp_replace(F.regexp_replace(F.col("_file_path"), "^file:(//)?", ""), "^" + _re_escape(root_n) + "/?", "")
    first_dir = F.when(F.instr(rel, "/") > 0, F.substring_index(rel, "/", 1)).otherwise(F.lit(root_name))
    starts = df.groupBy("_file_path").agg(F.min("_mid").alias("_start"))
    out = df.join(starts, "_file_path")  # a row for every file: the planner knows its size
    return out.withColumn("source_file", F.replace(F.col("_file_name"), F.lit(","), F.lit(";"))) \
              .withColumn("source_name", first_dir) \
              .withColumn("record_id", F.col("_mid") - F.col("_start")) \
              .drop("_file_path", "_file_name", "_mid", "_start")


def _re_escape(s: str) -> str:
    import re
    return re.sub(r"([\\^$.|?*+()\[\]{}])", r"\\\1", s)


def na_to_null(df: DataFrame, cols=None) -> DataFrame:
    """Map the pandas NA spellings to null (Spark's CSV reader knows one)."""
    cols = cols or [c for c, t in df.dtypes if t == "string"]
    return df.select(*[F.when(F.col(f"`{c}`").isin(NA_VALUES), F.lit(None)).otherwise(F.col(f"`{c}`")).alias(c)
                       if c in cols else F.col(f"`{c}`") for c in df.columns])


def read_csv_tree(spark: SparkSession, root: str, exclude_dirs=(), encoding: str | None = None,
                  bad_lines: str = "keep") -> DataFrame:
    """Recursive CSV scan with LFS quarantine, header-drift union,
    provenance columns and pandas-style NA handling.  Without a given
    encoding a file that is not valid UTF-8 is read as Latin-1; rows of the
    wrong width go by ``bad_lines`` (see :func:`read_csv_group`).  Rows are
    numbered before bad ones are dropped, so ``record_id`` is their place in
    the file under every policy."""
    files = list_csv_files(spark, root, exclude_dirs)
    heads, _ = _real(file_heads(spark, files).collect())
    by_path = {_norm(f): f for f in files}
    groups: dict[tuple, list[str]] = {}
    for r in heads:
        enc = encoding or ("UTF-8" if r["is_utf8"] else "ISO-8859-1")
        groups.setdefault((r["first_line"] or "", enc), []).append(by_path.get(_norm(r["file_path"]), r["file_path"]))
    if not groups:
        raise RuntimeError(f"none of the {len(files)} CSV files holds data: Git LFS pointers or empty")
    frames = []
    for (_, enc), fs in groups.items():
        f = with_provenance(read_csv_group(spark, fs, enc, bad_lines), root)
        if bad_lines == "skip":
            width = len(f.columns) - 4  # less _corrupt_record and the provenance columns
            f = f.filter(F.col(CORRUPT).isNull() | ~too_wide(F.col(CORRUPT), width)).drop(CORRUPT)
        frames.append(f)
    prev = spark.conf.get("spark.sql.caseSensitive")
    spark.conf.set("spark.sql.caseSensitive", "true")
    try:
        u = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)
    finally:
        spark.conf.set("spark.sql.caseSensitive", prev)
    return na_to_null(u, [c for c in u.columns if c not in ("source_file", "source_name", "record_id", CORRUPT)])


def missing_expected(columns: list[str], expected: list[str]) -> list[str]:
    """Expected candidate columns absent from a frame (driver-side check)."""
    return [c for c in expected if c not in columns]


MASTER_SCHEMA = T.StructType([
    T.StructField("text", T.StringType()), T.StructField("label", T.IntegerType()),
    T.StructField("source_file", T.StringType()), T.StructField("source_name", T.StringType()),
    T.StructField("record_id", T.LongType())])


def load_labelled(spark: SparkSession, path: str, fmt: str = "parquet", required=("text", "label")) -> DataFrame:
    """Load a split, require columns, drop nulls, cast label to int."""
    df = spark.read.format(fmt).options(**(CSV_OPTIONS if fmt == "csv" else {})).load(path)
    missing = [c for c in required if c not in df.columns]
    if missing:
        raise ValueError(f"missing required columns: {missing}")
    return df.na.drop(subset=list(required)).withColumn("label", F.col("label").cast("int"))


def read_json_dump(spark: SparkSession, path: str, field: str = "contents") -> DataFrame:
    """An array of JSON objects -> ``field`` of each, as text; null where it
    is missing or the object is malformed.  One file is read in many tasks
    (:func:`read_json_objects`)."""
    schema = T.StructType([T.StructField(field, T.StringType())])
    return read_json_objects(spark, path).select(F.from_json("element", schema)[field].alias(field))


EVAL_SCHEMA = T.StructType([
    T.StructField("timestamp", T.StringType()), T.StructField("model_name", T.StringType()),
    T.StructField("best_hyperparameters", T.StringType()),
    T.StructField("metrics", T.StructType([T.StructField(n, T.DoubleType()) for n in
                                           ["cross_validation_score", "test_accuracy", "test_precision_weighted",
                                            "test_recall_weighted", "test_f1_weighted", "best_validation_accuracy"]])),
    T.StructField("confusion_matrix", T.ArrayType(T.ArrayType(T.LongType()))),
    T.StructField("classification_report", T.StringType())])


def read_evaluation_logs(spark: SparkSession, root: str) -> DataFrame:
    """Every ``<root>/<method>/logs/evaluation_log.json``, a file or a
    folder of parts.  A missing model name becomes the directory name, missing
    metrics 0.0 and missing hyper-parameters ``{}``; ``method_dir`` is the
    name of the method's directory."""
    df = spark.read.schema(EVAL_SCHEMA).option("multiLine", True).json(f"{root.rstrip('/')}/*/logs/evaluation_log.json")
    method = F.regexp_extract(F.col("_metadata.file_path"), r"/([^/]+)/logs/evaluation_log\.json(?:/[^/]*)?$", 1)
    metrics = [f.name for f in EVAL_SCHEMA["metrics"].dataType]
    return (df.withColumn("method_dir", method)
            .withColumn("model_name", F.coalesce("model_name", "method_dir"))
            .withColumn("best_hyperparameters", F.coalesce("best_hyperparameters", F.lit("{}")))
            .withColumn("metrics", F.struct(*[F.coalesce(F.col(f"metrics.{m}"), F.lit(0.0)).alias(m) for m in metrics])))


def read_predictions(spark: SparkSession, path: str) -> DataFrame:
    """Prediction records as JSON lines, or documents (indented ones too)
    that are an array of records or hold one as ``predictions`` -> one row per
    prediction.  All files of a path have the same form, told by whether the
    first line is a value of its own."""
    head = spark.read.text(path).where("trim(value) <> ''").first()
    try:
        lines = head is None or isinstance(json.loads(head["value"]), dict)
    except ValueError:
        lines = False
    df = spark.read.option("multiLine", not lines).json(path)
    if "predictions" in df.columns:
        df = df.select(F.explode("predictions").alias("p")).select("p.*")
    return df


def history_to_rows(df: DataFrame, arrays=("train_loss", "train_acc", "val_loss", "val_acc"), epochs: str = "epochs") -> DataFrame:
    """Parallel per-epoch arrays -> one row per epoch."""
    present = [a for a in arrays if a in df.columns]
    z = df.select(F.explode(F.arrays_zip(F.col(epochs), *[F.col(a) for a in present])).alias("z"))
    return z.select(F.col(f"z.{epochs}").alias("epoch"), *[F.col(f"z.{a}").alias(a) for a in present])

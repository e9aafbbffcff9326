"""Spark ML models over TF-IDF + metadata features.

``TfidfFeaturizer`` is an ``Estimator``: ``fit`` learns the vocabulary and idf
with distributed DataFrame aggregates (only the bounded vocabulary reaches
the driver, as with Spark's own ``CountVectorizer``) and returns a
``PipelineModel`` of standard stages (SQLTransformer -> CountVectorizerModel
-> ElementwiseProduct(idf) -> Normalizer -> scalers -> VectorAssembler), so
fitted models save and load with ``PipelineModel.write()``.  Cross-validation
refits the featurizer inside every fold (no vocabulary leakage from the
held-out rows).
"""

from __future__ import annotations

import itertools
import time
from collections.abc import Callable, Iterable
from concurrent.futures import ThreadPoolExecutor

from pyspark import StorageLevel, keyword_only
from pyspark.ml import Estimator, Pipeline, PipelineModel
from pyspark.ml.classification import NaiveBayes
from pyspark.ml.feature import (CountVectorizerModel, ElementwiseProduct, Normalizer, SQLTransformer, StandardScaler,
                                VectorAssembler)
from pyspark.ml.functions import vector_to_array
from pyspark.ml.linalg import Vectors
from pyspark.ml.param.shared import HasInputCol, HasOutputCol, Param, Params, TypeConverters
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import text as T
from ..functions.constants import LEARNING_FRACTIONS, PUNCT_CLASS, SEED, english_stop_words
from . import folds as FD
from . import linear as LN
from . import metrics as MT
from . import sampling as SM
from . import tfidf as TF

NUMERIC = ["word_count", "punct_count", "upper_count"]
KINDS = ("logistic_regression", "linear_svc", "sgd_hinge", "naive_bayes")
MAX_FEATURES = 40000  # vocabulary of the untuned models
PARALLEL = 5          # folds fitted at the same time, each over all slots
KEPT = StorageLevel.DISK_ONLY  # rows read a few times: in memory they would fill the executors' heaps as the input grows


def _sql_str(s: str) -> str:
    return "'" + s.replace("\\", "\\\\").replace("'", "\\'") + "'"


def terms_sql(text: str, ngram=(1, 2), stop_words=None) -> str:
    """SQLTransformer statement adding ``terms`` (tokens + n-grams) and the
    three metadata features."""
    sw = english_stop_words() if stop_words is None else stop_words
    kept = f"t NOT IN ({', '.join(_sql_str(w) for w in sw)})" if sw else "true"  # a hash set, where an array is searched word by word
    toks = f"filter(regexp_extract_all(lower(`{text}`), {_sql_str('[' + T.WORD_RUN + ']{2,}')}, 0), t -> {kept})"
    grams = ["_toks"] if ngram[0] <= 1 else []
    for n in range(max(2, ngram[0]), ngram[1] + 1):
        parts = ", ".join(["x"] + [f"_toks[i + {k}]" for k in range(1, n)])
        grams.append(f"transform(slice(_toks, 1, greatest(size(_toks) - {n - 1}, 0)), (x, i) -> concat_ws(' ', {parts}))")
    terms = grams[0] if len(grams) == 1 else f"concat({', '.join(grams)})"
    words = f"filter(split(`{text}`, {_sql_str(T.WS_RUN)}), w -> w != '')"
    return (f"SELECT *, {terms} AS terms, CAST(size(_words) AS DOUBLE) AS word_count, "
            f"CAST(regexp_count(`{text}`, {_sql_str(PUNCT_CLASS)}) AS DOUBLE) AS punct_count, "
            f"CAST(size(filter(_words, w -> upper(w) = w AND lower(w) != w)) AS DOUBLE) AS upper_count "
            f"FROM (SELECT *, {toks} AS _toks, {words} AS _words FROM __THIS__)")


class TfidfFeaturizer(Estimator, HasInputCol, HasOutputCol):
    maxFeatures = Param(Params._dummy(), "maxFeatures", "vocabulary size", typeConverter=TypeConverters.toInt)
    ngramMax = Param(Params._dummy(), "ngramMax", "largest n-gram", typeConverter=TypeConverters.toInt)
    scaler = Param(Params._dummy(), "scaler", "'standard' or 'minmax'", typeConverter=TypeConverters.toString)
    prepared = Param(Params._dummy(), "prepared", "rows come from with_terms", typeConverter=TypeConverters.toBoolean)

    @keyword_only
    def __init__(self, inputCol="text", outputCol="features", maxFeatures=MAX_FEATURES, ngramMax=2, scaler="standard", prepared=False):
        super().__init__()
        self._setDefault(maxFeatures=MAX_FEATURES, ngramMax=2, scaler="standard", prepared=False, inputCol="text", outputCol="features")
        self._set(**self._input_kwargs)

    def _fit(self, df: DataFrame) -> PipelineModel:
        text, out = self.getInputCol(), self.getOutputCol()
        k, n_max, scaler = self.getOrDefault(self.maxFeatures), self.getOrDefault(self.ngramMax), self.getOrDefault(self.scaler)
        sqlt = SQLTransformer(statement=terms_sql(text, (1, n_max)))
        first = [] if self.getOrDefault(self.prepared) else [sqlt]
        ready = sqlt.transform(df) if first else df
        stats = TF.term_stats(ready.select("terms"))
        vocab = TF.idf_table(TF.top_terms(stats, k), df).orderBy("term_index").select("term", "idf").collect()
        terms = [r["term"] for r in vocab] or ["__empty__"]
        idf = [float(r["idf"]) for r in vocab] or [0.0]
        cv = _vectorizer(df.sparkSession, terms)
        ep = ElementwiseProduct(scalingVec=Vectors.dense(idf), inputCol="_tf", outputCol="_tfidf_raw")
        nm = Normalizer(p=2.0, inputCol="_tfidf_raw", outputCol="_tfidf")
        va_num = VectorAssembler(inputCols=NUMERIC, outputCol="_num")
        if scaler == "minmax":
            sc = [_minmax_stage(ready), VectorAssembler(inputCols=[f"_mm_{c}" for c in NUMERIC], outputCol="_num_scaled")]
        else:  # learned from the three counts alone, before any vector is built
            sc = [StandardScaler(withMean=True, withStd=True, inputCol="_num", outputCol="_num_scaled").fit(va_num.transform(ready.select(NUMERIC)))]
        va = VectorAssembler(inputCols=["_tfidf", "_num_scaled"], outputCol=out)
        own = ["_toks", "_words", "terms", "_tf", "_tfidf_raw", "_tfidf", "_num", "_num_scaled"]
        own += [f"_mm_{c}" for c in NUMERIC] if scaler == "minmax" else []
        drop = SQLTransformer(statement=f"SELECT * EXCEPT ({', '.join(own)}) FROM __THIS__")
        return PipelineModel(stages=[*first, cv, ep, nm, va_num, *sc, va, drop])


def with_terms(df: DataFrame, ngram_max: int, text: str = "text") -> DataFrame:
    """``df`` with the terms and counts that a featurizer reads, for several
    featurizers over the same rows."""
    return SQLTransformer(statement=terms_sql(text, (1, ngram_max))).transform(df)


def _vectorizer(spark, terms: list[str]) -> CountVectorizerModel:
    """``CountVectorizerModel.from_vocabulary`` with the vocabulary sent as one
    string: that function makes a call to the JVM for every term."""
    array = spark.sparkContext._jvm.org.apache.commons.lang3.StringUtils.split("\n".join(terms), "\n")
    cv = CountVectorizerModel._create_from_java_class("org.apache.spark.ml.feature.CountVectorizerModel", array)
    return cv.setInputCol("terms").setOutputCol("_tf")


def _minmax_stage(df: DataFrame) -> SQLTransformer:
    """Scale the metadata counts to 0..1 by the range seen in ``df``; unseen
    rows stay at 0 or more, as naive Bayes needs, and a constant becomes 0."""
    r = df.agg(*[f(c).alias(f"{n}_{c}") for c in NUMERIC for n, f in (("lo", F.min), ("hi", F.max))]).first()
    cols = []
    for c in NUMERIC:
        lo, hi = r[f"lo_{c}"] or 0.0, r[f"hi_{c}"] or 0.0
        cols.append(f"greatest(0D, ({c} - {lo}D) / {hi - lo}D) AS _mm_{c}" if hi > lo else f"0D AS _mm_{c}")
    return SQLTransformer(statement=f"SELECT *, {', '.join(cols)} FROM __THIS__")


def classifier(kind: str | Estimator, C: float | None = None, alpha: float = 1e-4, nb_alpha: float = 1.0, balanced: bool = False):
    """The reference's classifiers and their untuned parameters: logistic loss
    (C 1) and squared hinge (C 0.1) by Newton steps, hinge by stochastic
    epochs, multinomial naive Bayes.  Any other estimator over ``features``
    and ``label`` is taken as it is."""
    if isinstance(kind, Estimator):
        return kind
    if kind == "logistic_regression":
        return LN.Newton("logistic", 1.0 if C is None else C, balanced)
    if kind == "linear_svc":
        return LN.Newton("squared_hinge", 0.1 if C is None else C, balanced)
    if kind == "sgd_hinge":
        return LN.Stochastic(alpha, balanced)
    if kind == "naive_bayes":
        return NaiveBayes(smoothing=nb_alpha, modelType="multinomial", featuresCol="features", labelCol="label")
    raise ValueError(kind)


def fit_classifiers(cells: list, x: DataFrame) -> list:
    """Models of ``classifier`` results from the same vectors; the linear ones
    advance together, one Spark job for each step of all of them."""
    linear = [c for c in cells if isinstance(c, (LN.Newton, LN.Stochastic))]
    found = iter(LN.fit_cells(x, linear) if linear else ())
    return [next(found) if isinstance(c, (LN.Newton, LN.Stochastic)) else c.fit(x) for c in cells]


def featurizer(kind: str | Estimator, max_features: int = MAX_FEATURES, ngram_max: int = 2, prepared: bool = False) -> TfidfFeaturizer:
    return TfidfFeaturizer(inputCol="text", maxFeatures=max_features, ngramMax=ngram_max,
                           scaler="minmax" if kind == "naive_bayes" else "standard", prepared=prepared)


def balance(df: DataFrame, label: str = "label", out: str = "balance") -> DataFrame:
    """Class weights n / (classes * n_class) as a column; the few class counts
    ride along as a scalar subquery."""
    counts = df.groupBy(label).agg(F.count(F.lit(1)).alias("n"))
    table = counts.agg(F.map_from_entries(F.collect_list(F.struct(label, "n"))).alias("m"), F.sum("n").alias("n"),
                       F.count(F.lit(1)).alias("k"))
    weight = table.select(F.transform_values("m", lambda _, n: F.col("n") / (F.col("k") * n))).scalar()
    return df.withColumn(out, F.element_at(weight, F.col(label)))


def training_features(feat: PipelineModel, train: DataFrame, balanced: bool) -> DataFrame:
    """Feature vectors in partitions of the session's advisory size: few for a
    small table, where a round of a solver is all task overhead; the shuffle
    moves only the vectors."""
    x = feat.transform(train).select("features", "label")
    return (balance(x) if balanced else x).hint("rebalance")


def score(model: PipelineModel, df: DataFrame) -> DataFrame:
    """Adds pred_label, confidence (probability of the predicted class; for
    SVMs the sigmoid of the margin), prob_0 and prob_1."""
    out = model.transform(df)
    if "probability" in out.columns:
        p = vector_to_array("probability")
        p1 = F.element_at(p, 2)
    else:
        m = F.element_at(vector_to_array("rawPrediction"), 2)
        p1 = F.lit(1.0) / (F.lit(1.0) + F.exp(-F.greatest(F.lit(-250.0), F.least(F.lit(250.0), m))))
    out = out.withColumn("prob_1", p1).withColumn("prob_0", 1 - F.col("prob_1"))
    out = out.withColumn("pred_label", F.col("prediction").cast("int"))
    return out.withColumn("confidence", F.greatest("prob_0", "prob_1")) \
              .drop("features", "rawPrediction", "probability", "prediction")


def fit_model(kind: str | Estimator, train: DataFrame, max_features: int = MAX_FEATURES, ngram_max: int = 2,
              balanced: bool = False, **kw) -> PipelineModel:
    """Featurizer fit -> features over all slots -> classifier fit;
    returns one ``PipelineModel`` (featurizer stages + classifier)."""
    return fit_models([(kind, {"max_features": max_features, "ngram_max": ngram_max, "balanced": balanced, **kw})], train)[0]


def fit_models(cells: list[tuple], train: DataFrame) -> list[PipelineModel]:
    """:func:`fit_model` of (kind, parameters) cells.  Cells of one scaler and
    vocabulary setting share the featurizer and its vectors; the texts are
    tokenised once a setting."""
    out: list = [None] * len(cells)
    groups: dict[tuple, list[int]] = {}
    for i, (kind, p) in enumerate(cells):
        groups.setdefault((kind == "naive_bayes", p.get("max_features", MAX_FEATURES), p.get("ngram_max", 2)), []).append(i)
    for (_, size, ngram), members in groups.items():
        ready = with_terms(train, ngram).select("label", "terms", *NUMERIC).persist(KEPT)
        try:
            feat = featurizer(cells[members[0]][0], size, ngram, prepared=True).fit(ready)
            vectors = PipelineModel(stages=feat.stages[:-1])  # the last drops columns, of which ready has a part
            made = [classifier(cells[i][0], **{k: v for k, v in cells[i][1].items() if k not in ("max_features", "ngram_max")}) for i in members]
            x = training_features(vectors, ready, any(cells[i][1].get("balanced") for i in members)).persist(KEPT)
            try:
                fitted = fit_classifiers(made, x)
            finally:
                x.unpersist()
        finally:
            ready.unpersist()
        feat = PipelineModel(stages=[SQLTransformer(statement=terms_sql("text", (1, ngram))), *feat.stages])
        for i, clf in zip(members, fitted):
            out[i] = PipelineModel(stages=[feat, clf])
    return out


def train_and_evaluate(kind: str, train: DataFrame, test: DataFrame, **kw):
    """Fit, time, predict and evaluate one model; returns (model, metrics dict,
    scored test frame)."""
    t0 = time.time()
    model = fit_model(kind, train, **kw)
    return (model, *_evaluated(model, test, time.time() - t0))


def _evaluated(model: PipelineModel, test: DataFrame, fit_s: float) -> tuple[dict, DataFrame]:
    """(metrics, scored test frame, kept for its reader as the metrics read it
    too)."""
    scored = score(model, test).withColumnRenamed("label", "true_label").persist(KEPT)
    cm = MT.confusion_matrix(scored, "true_label", "pred_label")
    wm = MT.weighted_metrics(cm).first().asDict()
    wm["fit_seconds"] = fit_s
    return wm, scored


def _accuracy(clf, x: DataFrame) -> float | None:
    return clf.transform(x).select(F.avg((F.col("label") == F.col("prediction")).cast("double"))).first()[0]


def _in_parallel(work: Callable, jobs: Iterable) -> list:
    with ThreadPoolExecutor(PARALLEL) as pool:
        return list(pool.map(work, jobs))


def evaluate_cells(cells: list[tuple], train: DataFrame, held: DataFrame, train_score: bool = False, prepared: bool = False) -> list[tuple]:
    """(train accuracy or None, held-out accuracy) of every (kind, parameters)
    cell.  The featurizer is fitted on ``train`` once for each scaler and
    vocabulary setting, and its vectors serve all cells that share it.
    Without two classes to learn from, a cell has no accuracy."""
    if train.agg(F.count_distinct("label")).first()[0] < 2:
        return [(None, None)] * len(cells)
    groups: dict[tuple, list[int]] = {}
    for i, (kind, params) in enumerate(cells):
        groups.setdefault((kind == "naive_bayes", params.get("max_features", MAX_FEATURES), params.get("ngram_max", 2)), []).append(i)
    out: list[tuple] = [(None, None)] * len(cells)
    for (_, size, ngram), members in groups.items():
        feat = featurizer(cells[members[0]][0], size, ngram, prepared).fit(train)
        x, y = training_features(feat, train, True).cache(), feat.transform(held).select("features", "label").cache()

        try:
            x.count(), y.count()
            made = [classifier(cells[i][0], **{k: v for k, v in cells[i][1].items() if k not in ("max_features", "ngram_max")}) for i in members]
            for i, clf in zip(members, fit_classifiers(made, x)):
                out[i] = _accuracy(clf, x) if train_score else None, _accuracy(clf, y)
        finally:
            x.unpersist(), y.unpersist()
    return out


def _mean_std(values: list) -> tuple[float | None, float | None]:
    v = [a for a in values if a is not None]
    if not v:
        return None, None
    mean = sum(v) / len(v)
    return mean, (sum((a - mean) ** 2 for a in v) / len(v)) ** 0.5


def _folds(df: DataFrame, fold_col: str) -> list[tuple[DataFrame, DataFrame]]:
    return [(df.filter(F.col(fold_col) != f), df.filter(F.col(fold_col) == f)) for f in _fold_values(df, fold_col)]


def _by_marks(cells: list[tuple], df: DataFrame) -> bool:
    """Whether :mod:`folds` can evaluate the cells: the four models on labels
    0 and 1; any other estimator or label is fitted split by split."""
    return all(kind in KINDS for kind, _ in cells) and df.filter(F.col("label").isNull() | ~F.col("label").isin(0, 1)).isEmpty()


def _setting(kind: str, params: dict) -> tuple:
    own = {k: v for k, v in params.items() if k not in ("max_features", "ngram_max")}
    return kind == "naive_bayes", params.get("max_features", MAX_FEATURES), params.get("ngram_max", 2), classifier(kind, **own)


def _evaluate_marks(cells: list[tuple], df: DataFrame, mark, splits: list, train_score: bool = False) -> list[tuple]:
    return FD.evaluate(with_terms(df, 1).withColumn("mark", mark), splits, [_setting(*c) for c in cells], NUMERIC, train_score, _in_parallel)


def _fold_values(df: DataFrame, fold_col: str) -> list:
    return sorted(r[0] for r in df.select(fold_col).distinct().collect())


def _place(values: list, col):
    """Place of the column's value among ``values``, from 0."""
    return F.array_position(F.array(*[F.lit(v) for v in values]), col).cast("int") - 1


def cross_validate_cells(cells: list[tuple], df: DataFrame, fold_col: str = "fold") -> list[tuple]:
    """k-fold CV over a fold column (stratified folds from sampling) of
    (kind, parameters) cells; the whole model, featurizer included, learns
    from k-1 folds and is scored on the held-out one (no vocabulary leakage).
    Returns (mean accuracy, population std) per cell."""
    if _by_marks(cells, df):
        n = len(folds := _fold_values(df, fold_col))
        splits = [FD.Split(tuple(m for m in range(n) if m != k), (k,)) for k in range(n)]
        found = _evaluate_marks(cells, df, _place(folds, F.col(fold_col)), splits) if n else []
        return [_mean_std([f[j][1] for _, f in found]) for j in range(len(cells))]
    out: list[tuple] = [(None, None)] * len(cells)
    for n in sorted({p.get("ngram_max", 2) for _, p in cells}):
        members = [i for i, (_, p) in enumerate(cells) if p.get("ngram_max", 2) == n]
        some, ready = [cells[i] for i in members], with_terms(df, n).cache()  # tokenised once for all folds and cells
        try:
            per_fold = _in_parallel(lambda fold: evaluate_cells(some, *fold, prepared=True), _folds(ready, fold_col))
        finally:
            ready.unpersist()
        for j, i in enumerate(members):
            out[i] = _mean_std([f[j][1] for f in per_fold])
    return out


def cross_validate(kind: str | Estimator, df: DataFrame, fold_col: str = "fold", grid: list[dict] | None = None, **kw):
    """[(params, mean accuracy, population std)] of one model over a grid."""
    grid = grid or [{}]
    return [(g, *r) for g, r in zip(grid, cross_validate_cells([(kind, {**kw, **g}) for g in grid], df, fold_col))]


def default_grid(kind: str) -> list[dict]:
    """The published grids: vocabulary size and n-grams for every model, with
    penalty and class weights (linear models) or smoothing (naive Bayes)."""
    axes = {"max_features": (10000, 20000), "ngram_max": (1, 2)}
    if kind in ("logistic_regression", "linear_svc"):
        axes |= {"C": (0.1, 1.0), "balanced": (False, True)}
    elif kind == "sgd_hinge":
        axes |= {"alpha": (1e-4, 1e-3, 1e-2), "balanced": (False, True)}
    elif kind == "naive_bayes":
        axes |= {"nb_alpha": (0.1, 0.5, 1.0)}
    return [dict(zip(axes, v)) for v in itertools.product(*axes.values())]


def best_cell(cells: list[tuple]) -> tuple:
    """The (params, mean accuracy, std) of the highest mean; ties go to the
    first cell of the grid."""
    return max(cells, key=lambda c: -1.0 if c[1] is None else c[1])


def search(kinds: Iterable[str], df: DataFrame, fold_col: str = "fold", grids: dict[str, list[dict]] | None = None) -> dict[str, list[tuple]]:
    """kind -> [(params, mean CV accuracy, std)] of every cell of its grid.
    The cells of all models go over the folds together, so models that read
    the same features share them."""
    cells = [(k, p) for k in kinds for p in ((grids or {}).get(k) or default_grid(k))]
    out: dict[str, list[tuple]] = {}
    for (kind, params), got in zip(cells, cross_validate_cells(cells, df, fold_col)):
        out.setdefault(kind, []).append((params, *got))
    return out


def grid_search(kind: str, df: DataFrame, fold_col: str = "fold", grid: list[dict] | None = None):
    """(model refit on all rows with the best cell, its parameters, its mean
    CV accuracy, all cells)."""
    return grid_searches([kind], df, fold_col, {kind: grid})[kind]


def grid_searches(kinds: Iterable[str], df: DataFrame, fold_col: str = "fold", grids: dict[str, list[dict]] | None = None) -> dict[str, tuple]:
    """kind -> what :func:`grid_search` gives, with features shared by the
    models; a model without an accuracy (no two classes) is not refit: None."""
    found = search(kinds, df, fold_col, grids)
    best = {kind: best_cell(cells) for kind, cells in found.items()}
    refit = [kind for kind, (_, mean, _) in best.items() if mean is not None]
    models = dict(zip(refit, fit_models([(kind, best[kind][0]) for kind in refit], df)))
    return {kind: (models.get(kind), *best[kind][:2], cells) for kind, cells in found.items()}


def accuracy(model: PipelineModel | None, df: DataFrame) -> float | None:
    """Share of the rows that a fitted model labels right."""
    return None if model is None else _accuracy(model, df)


def learning_curve(kinds: Iterable[str], df: DataFrame, fold_col: str = "fold", id_col: str = "record_id",
                   fractions=LEARNING_FRACTIONS, **kw) -> list[tuple]:
    """(kind, fraction, mean rows learned from, mean train accuracy, mean
    held-out accuracy) over the folds, on nested subsets in hash order."""
    cells = [(k, kw) for k in kinds]
    if _by_marks(cells, df):
        folds = _fold_values(df, fold_col)
        subset = _in_parallel(lambda f: SM.subset_of(df.filter(F.col(fold_col) != f), id_col, fractions, SEED), folds)
        # a row's mark: its fold and, for every fold held out, the smallest subset that has it
        place = F.concat_ws(",", _place(folds, F.col(fold_col)), *[
            F.coalesce(F.when(F.col(fold_col) != f, s), F.lit(len(fractions))) for f, s in zip(folds, subset)])
        seen = sorted(r[0] for r in df.select(place).distinct().collect())
        parts = [tuple(map(int, s.split(","))) for s in seen]
        splits = [FD.Split(tuple(m for m, p in enumerate(parts) if p[0] != k and p[k + 1] <= i), tuple(m for m, p in enumerate(parts) if p[0] == k))
                  for k in range(len(folds)) for i in range(len(fractions))]
        found = _evaluate_marks(cells, df, _place(seen, place), splits, train_score=True) if folds else []
        per_fold = [[((kind, float(fractions[j % len(fractions)])), (n, *r)) for (kind, _), r in zip(cells, got)] for j, (n, got) in enumerate(found)]
        return _curve(itertools.chain(*per_fold))

    def one(fold: tuple[DataFrame, DataFrame]) -> list[tuple]:
        train, held = fold
        nested, rows = SM.learning_subsets(train, id_col, fractions, SEED).cache(), []
        for i, fraction in enumerate(fractions):
            part = nested.filter(F.col("subset") <= i)
            n = part.count()
            rows += [((kind, float(fraction)), (n, *r)) for (kind, _), r in zip(cells, evaluate_cells(cells, part, held, train_score=True))]
        nested.unpersist()
        return rows

    return _curve(itertools.chain(*_in_parallel(one, _folds(df, fold_col))))


def _curve(rows: Iterable[tuple]) -> list[tuple]:
    got: dict[tuple, list[tuple]] = {}
    for key, r in rows:
        got.setdefault(key, []).append(r)
    return [(k, f, _mean_std([x[0] for x in v])[0], _mean_std([x[1] for x in v])[0], _mean_std([x[2] for x in v])[0])
            for (k, f), v in got.items()]


def tune_all(train: DataFrame, test: DataFrame, kinds: Iterable[str] = KINDS, fold_col: str = "fold",
             grids: dict[str, list[dict]] | None = None) -> list[dict]:
    """Every model tuned by its grid on ``train`` and evaluated on ``test``:
    model_name, model, best_params, cv_score, the weighted test metrics and
    is_best (highest test accuracy, ties to the first)."""
    found = [(kind, *best_cell(cells)) for kind, cells in search(kinds, train, fold_col, grids).items()]
    t0 = time.time()
    models = fit_models([(kind, params) for kind, params, _, _ in found], train)
    fit_s = time.time() - t0  # of all, as they are fitted together

    def finished(job: tuple) -> dict:
        (kind, params, mean, std), model = job
        wm, scored = _evaluated(model, test, fit_s)
        scored.unpersist()
        return {"model_name": kind, "model": model, "best_params": params, "cv_score": mean, "cv_std": std, **wm}

    out = _in_parallel(finished, zip(found, models))
    best = max(range(len(out)), key=lambda i: out[i]["accuracy"] or 0.0)
    return [{**r, "is_best": i == best} for i, r in enumerate(out)]


def parameter_count(model: PipelineModel) -> int:
    """coef + intercept (linear) or theta + pi sizes (NB)."""
    clf = model.stages[-1]
    if hasattr(clf, "theta"):
        th = clf.theta
        return th.numRows * th.numCols + clf.pi.size
    return clf.coefficients.size + 1

"""Evaluation aggregates."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def confusion_matrix(df: DataFrame, truth: str = "true_label", pred: str = "pred_label",
                     labels=(0, 1)) -> DataFrame:
    """Dense (truth, pred, n) grid over ``labels`` in one aggregate pass."""
    aggs = [F.sum(((F.col(truth) == t) & (F.col(pred) == p)).cast("long")).alias(f"_c{i}_{j}")
            for i, t in enumerate(labels) for j, p in enumerate(labels)]
    s = df.agg(*aggs)
    cells = [F.struct(F.lit(t).alias(truth), F.lit(p).alias(pred),
                      F.coalesce(F.col(f"_c{i}_{j}"), F.lit(0)).cast("long").alias("n"))
             for i, t in enumerate(labels) for j, p in enumerate(labels)]
    return s.select(F.explode(F.array(*cells)).alias("c")).select("c.*")


def _safe_div(a, b):
    return F.when(b != 0, a / b).otherwise(F.lit(0.0))


def classification_report(cm: DataFrame, truth: str = "true_label", pred: str = "pred_label") -> DataFrame:
    """Per-class precision / recall / F1 / support plus accuracy, macro and
    weighted averages (zero division -> 0) from a confusion matrix."""
    tp = cm.filter(F.col(truth) == F.col(pred)).select(F.col(truth).alias("cls"), F.col("n").alias("tp"))
    sup = cm.groupBy(F.col(truth).alias("cls")).agg(F.sum("n").alias("support"))
    prd = cm.groupBy(F.col(pred).alias("cls")).agg(F.sum("n").alias("predicted"))
    per = tp.join(sup, "cls").join(prd, "cls")
    per = per.withColumn("precision", _safe_div(F.col("tp"), F.col("predicted"))) \
             .withColumn("recall", _safe_div(F.col("tp"), F.col("support")))
    per = per.withColumn("f1", _safe_div(2 * F.col("precision") * F.col("recall"), F.col("precision") + F.col("recall")))
    rows = per.select(F.col("cls").cast("string").alias("row"), "precision", "recall", "f1",
                      F.col("support").cast("long").alias("support"))
    tot = per.agg(F.sum("support").alias("n"), F.sum("tp").alias("tp"),
                  F.avg("precision").alias("mp"), F.avg("recall").alias("mr"), F.avg("f1").alias("mf"),
                  F.sum(F.col("precision") * F.col("support")).alias("wp"),
                  F.sum(F.col("recall") * F.col("support")).alias("wr"),
                  F.sum(F.col("f1") * F.col("support")).alias("wf"))
    acc = _safe_div(F.col("tp"), F.col("n"))
    extra = tot.select(F.explode(F.array(
        F.struct(F.lit("accuracy").alias("row"), acc.alias("precision"), acc.alias("recall"), acc.alias("f1"),
                 F.col("n").cast("long").alias("support")),
        F.struct(F.lit("macro avg").alias("row"), F.col("mp").alias("precision"), F.col("mr").alias("recall"),
                 F.col("mf").alias("f1"), F.col("n").cast("long").alias("support")),
        F.struct(F.lit("weighted avg").alias("row"), _safe_div(F.col("wp"), F.col("n")).alias("precision"),
                 _safe_div(F.col("wr"), F.col("n")).alias("recall"), _safe_div(F.col("wf"), F.col("n")).alias("f1"),
                 F.col("n").cast("long").alias("support")))).alias("r")).select("r.*")
    return rows.unionByName(extra)


def weighted_metrics(cm: DataFrame, truth: str = "true_label", pred: str = "pred_label") -> DataFrame:
    """Accuracy and support-weighted precision / recall / F1 (one row)."""
    rep = classification_report(cm, truth, pred)

    def pick(row, col):
        return F.max(F.when(F.col("row") == row, F.col(col)))

    return rep.agg(pick("accuracy", "f1").alias("accuracy"), pick("weighted avg", "precision").alias("weighted_precision"),
                   pick("weighted avg", "recall").alias("weighted_recall"), pick("weighted avg", "f1").alias("weighted_f1"))


def binary_metrics(df: DataFrame, truth: str = "true_label", pred: str = "pred_label", positive=1) -> DataFrame:
    t = F.col(truth) == positive
    p = F.col(pred) == positive
    s = df.agg(F.sum((t & p).cast("long")).alias("tp"), F.sum((~t & p).cast("long")).alias("fp"),
               F.sum((t & ~p).cast("long")).alias("fn"), F.sum((~t & ~p).cast("long")).alias("tn"))
    prec = _safe_div(F.col("tp"), F.col("tp") + F.col("fp"))
    rec = _safe_div(F.col("tp"), F.col("tp") + F.col("fn"))
    s = s.select("*", prec.alias("precision"), rec.alias("recall"))
    return s.select("tp", "fp", "fn", "tn", "precision", "recall",
                    _safe_div(2 * F.col("precision") * F.col("recall"), F.col("precision") + F.col("recall")).alias("f1"),
                    _safe_div(F.col("tp") + F.col("tn"), F.col("tp") + F.col("fp") + F.col("fn") + F.col("tn")).alias("accuracy"))


def inference_summary(df: DataFrame, truth: str = "true_label", pred: str = "pred_label",
                      conf: str = "confidence", labels=(0, 1)) -> DataFrame:
    aggs = [F.count(F.lit(1)).alias("total")]
    aggs += [F.sum((F.col(pred) == l).cast("long")).alias(f"n_pred_{l}") for l in labels]
    aggs += [F.sum((F.col(pred) == F.col(truth)).cast("long")).alias("correct"), F.avg(conf).alias("mean_confidence")]
    s = df.agg(*aggs)
    return s.withColumn("accuracy", _safe_div(F.col("correct"), F.col("total")))


def cv_summary(fold_scores: DataFrame, score: str = "accuracy") -> DataFrame:
    """Mean and population standard deviation of per-fold scores."""
    return fold_scores.agg(F.avg(score).alias("cv_mean"), F.stddev_pop(score).alias("cv_std"),
                           F.count(F.lit(1)).alias("n_folds"))


def fold_accuracy(df: DataFrame, fold: str = "fold", truth: str = "true_label", pred: str = "pred_label") -> DataFrame:
    return df.groupBy(fold).agg(F.avg((F.col(truth) == F.col(pred)).cast("double")).alias("accuracy"))


def best_epoch(history: DataFrame, epoch: str = "epoch", metric: str = "val_acc", group_cols=()) -> DataFrame:
    """First epoch reaching the strict maximum of ``metric``."""
    w = Window.partitionBy(*group_cols).orderBy(F.desc(metric), F.col(epoch))
    return history.withColumn("_r", F.row_number().over(w)).filter(F.col("_r") == 1).drop("_r")


def model_summary(results: DataFrame) -> DataFrame:
    """Summary table: accuracy / precision as percent (2 d.p.), parameters
    formatted, hyper-parameters as JSON, sorted by accuracy desc."""
    from ..functions.features import format_count
    out = results.select(
        F.col("model_name").alias("Model"), F.col("model_type").alias("Type"),
        F.round(F.col("test_accuracy") * 100, 2).alias("Test Accuracy (%)"),
        F.round(F.col("weighted_precision") * 100, 2).alias("Weighted Precision (%)"),
        F.col("num_parameters").alias("Parameters"), format_count(F.col("num_parameters")).alias("Parameters (formatted)"),
        F.to_json(F.col("hyperparameters")).alias("Hyperparameters"))
    return out


def model_rollup(results: DataFrame) -> DataFrame:
    """Counts by type, best model, overall and per-type mean accuracy."""
    return results.agg(
        F.count(F.lit(1)).alias("n_models"),
        F.sum((F.col("model_type") == "ML").cast("long")).alias("n_ml"),
        F.sum((F.col("model_type") == "DL").cast("long")).alias("n_dl"),
        F.max_by(F.col("model_name"), F.struct(F.col("test_accuracy"), F.col("model_name"))).alias("best_model"),
        F.max("test_accuracy").alias("best_accuracy"),
        F.avg("test_accuracy").alias("mean_accuracy"),
        F.avg(F.when(F.col("model_type") == "ML", F.col("test_accuracy"))).alias("mean_accuracy_ml"),
        F.avg(F.when(F.col("model_type") == "DL", F.col("test_accuracy"))).alias("mean_accuracy_dl"))


def model_inference_accuracy(per_sample: DataFrame, model: str = "model_name", model_type: str = "model_type",
                             correct: str = "is_correct") -> DataFrame:
    """Per-model accuracy plus ML / DL / overall means of the model accuracies
    (rows ``model_name = '__ML__' | '__DL__' | '__ALL__'``)."""
    per = per_sample.groupBy(model, model_type).agg(
        F.sum(F.col(correct).cast("long")).alias("correct"), F.count(F.lit(1)).alias("total"))
    per = per.withColumn("accuracy", F.col("correct") / F.col("total"))
    means = per.groupBy(model_type).agg(F.avg("accuracy").alias("accuracy")) \
               .select(F.concat(F.lit("__"), F.col(model_type), F.lit("__")).alias(model), F.lit(None).cast("string").alias(model_type),
                       F.lit(None).cast("long").alias("correct"), F.lit(None).cast("long").alias("total"), "accuracy")
    overall = per.agg(F.avg("accuracy").alias("accuracy")).select(
        F.lit("__ALL__").alias(model), F.lit(None).cast("string").alias(model_type),
        F.lit(None).cast("long").alias("correct"), F.lit(None).cast("long").alias("total"), "accuracy")
    return per.unionByName(means).unionByName(overall)


def confusion_from_matrix(spark, matrix) -> DataFrame:
    """Long confusion table from a nested list ``[[tn, fp], [fn, tp]]``."""
    rows = [(i, j, int(matrix[i][j])) for i in range(len(matrix)) for j in range(len(matrix[i]))]
    return spark.createDataFrame(rows, "true_label int, pred_label int, n long")

"""Classifier evaluation, model comparison and approval, as aggregations."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from churnkit.operators.order import running_counts, same_keys

F1_THRESHOLD = 0.40  # fixed value


def _cells(y: str, yhat: str) -> dict[str, Column]:
    a, p = F.col(y), F.col(yhat)
    return {"tn": F.count_if((a == 0) & (p == 0)), "fp": F.count_if((a == 0) & (p == 1)),
            "fn": F.count_if((a == 1) & (p == 0)), "tp": F.count_if((a == 1) & (p == 1))}


def confusion(df: DataFrame, y: str, yhat: str, by: Sequence[str] = ()) -> DataFrame:
    """One row (per group) with tn, fp, fn, tp; absent cells are 0."""
    return df.groupBy(*by).agg(*[e.alias(k) for k, e in _cells(y, yhat).items()])


def _ratio(a: Column, b: Column) -> Column:
    """``a / b``, 0 when undefined."""
    return F.coalesce(F.try_divide(a.cast("double"), b), F.lit(0.0))


def _precision_recall_f1(tp: Column, fp: Column, fn: Column) -> tuple[Column, Column, Column]:
    return _ratio(tp, tp + fp), _ratio(tp, tp + fn), _ratio(2 * tp, 2 * tp + fp + fn)


def class_metrics(df: DataFrame, y: str, yhat: str, by: Sequence[str] = ()) -> DataFrame:
    """Accuracy, precision and recall of class 1, macro-F1 per group."""
    return _metrics_of(confusion(df, y, yhat, by), by)


def _metrics_of(c: DataFrame, by: Sequence[str]) -> DataFrame:
    tn, fp, fn, tp = (F.col(k) for k in ("tn", "fp", "fn", "tp"))
    p, r, f1_pos = _precision_recall_f1(tp, fp, fn)
    _, _, f1_neg = _precision_recall_f1(tn, fn, fp)
    return c.select(*by, "tn", "fp", "fn", "tp", _ratio(tp + tn, tn + fp + fn + tp).alias("accuracy"),
                    p.alias("precision_pos"), r.alias("recall_pos"), ((f1_pos + f1_neg) / 2).alias("macro_f1"))


def pr_pos(df: DataFrame, y: str, yhat: str, by: Sequence[str] = ()) -> DataFrame:
    """Precision and recall of class 1; 0 when nothing is predicted or present."""
    return class_metrics(df, y, yhat, by).select(*by, "precision_pos", "recall_pos")


def macro_f1(df: DataFrame, y: str, yhat: str, by: Sequence[str] = ()) -> DataFrame:
    """Mean of the two classes' F1."""
    return class_metrics(df, y, yhat, by).select(*by, "macro_f1")


def accuracy(df: DataFrame, y: str, yhat: str, by: Sequence[str] = ()) -> DataFrame:
    """Share of rows predicted right, with the number of wrong ones; rows that lack one of the two do not count."""
    return df.groupBy(*by).agg(F.count(F.col(y) == F.col(yhat)).alias("n"), F.count_if(F.col(y) != F.col(yhat)).alias("incorrect"),
                               F.avg((F.col(y) == F.col(yhat)).cast("double")).alias("accuracy"))


def _curve(df: DataFrame, y: str, score: str, by: Sequence[str]) -> DataFrame:
    scored = df.filter(F.col(score).isNotNull() & F.col(y).isNotNull())
    return running_counts(scored, score, {"pos": F.count_if(F.col(y) == 1), "n": F.count("*")}, by)


def average_precision(df: DataFrame, y: str, score: str, by: Sequence[str] = ()) -> DataFrame:
    """Area under precision-recall as the step sum over distinct scores; ties form one step."""
    c = _curve(df, y, score, by)
    return c.groupBy(*by).agg(
        _ratio(F.sum(F.col("pos") * F.col("pos_upto") / F.col("n_upto")), F.sum("pos")).alias("pr_auc"))


def roc_auc(df: DataFrame, y: str, score: str, by: Sequence[str] = ()) -> DataFrame:
    """Chance that a positive outranks a negative, ties counting half; null for one class."""
    c = _curve(df, y, score, by)
    return c.groupBy(*by).agg(_auc().alias("roc_auc"))


def _auc() -> Column:
    # negatives above each score, plus half of those tied with it, lose against its positives
    neg, neg_upto = F.col("n") - F.col("pos"), F.col("n_upto") - F.col("pos_upto")
    lost = F.sum(F.col("pos").cast("double") * (neg_upto - neg / 2.0))
    return F.lit(1.0) - F.try_divide(lost, F.sum("pos").cast("double") * F.sum(neg))


def ranking_metrics(df: DataFrame, y: str, score: str, by: Sequence[str] = ()) -> DataFrame:
    """PR-AUC and ROC-AUC from one ordering of the scores."""
    return _ranking_of(_curve(df, y, score, by), by)


def _ranking_of(curve: DataFrame, by: Sequence[str]) -> DataFrame:
    ap = _ratio(F.sum(F.col("pos") * F.col("pos_upto") / F.col("n_upto")), F.sum("pos"))
    return curve.groupBy(*by).agg(ap.alias("pr_auc"), _auc().alias("roc_auc"))


def class_report(df: DataFrame, y: str, yhat: str, names: Mapping[int, str] | None = None) -> DataFrame:
    """Precision, recall, F1 and support per class, with macro and weighted means."""
    names = names or {0: "0", 1: "1"}
    tn, fp, fn, tp = (F.col(k) for k in ("tn", "fp", "fn", "tp"))
    per = {0: (*_precision_recall_f1(tn, fn, fp), tn + fp), 1: (*_precision_recall_f1(tp, fp, fn), tp + fn)}
    total = per[0][3] + per[1][3]

    def line(label, p, r, f, s):
        return F.struct(F.lit(label).alias("class"), p.alias("precision"), r.alias("recall"), f.alias("f1"),
                        s.alias("support"))

    def mean(i, weighted):
        if weighted:
            return _ratio(per[0][i] * per[0][3] + per[1][i] * per[1][3], total)
        return (per[0][i] + per[1][i]) / 2

    lines = [line(names[k], *per[k]) for k in (0, 1)]
    lines += [line("macro avg", *[mean(i, False) for i in range(3)], total),
              line("weighted avg", *[mean(i, True) for i in range(3)], total)]
    return confusion(df, y, yhat).select(F.explode(F.array(*lines)).alias("_x")).select("_x.*")


def eval_log(labels: DataFrame, predictions: DataFrame, key: str, features: Sequence[str], label: str,
             prediction: str = "prediction") -> DataFrame:
    """Features with actual and predicted class and whether they agree, for keys in both inputs."""
    return (predictions.select(key, *features, F.col(prediction).cast("int").alias("predicted_churned"))
            .join(labels.select(key, F.col(label).alias("actual_churned")), key, "inner")
            .select(key, *features, "actual_churned", "predicted_churned",
                    (F.col("actual_churned") == F.col("predicted_churned")).alias("correct")))


def share_shift(df: DataFrame, y: str, yhat: str, classes: Sequence[int] = (0, 1)) -> DataFrame:
    """Percentage of each class among actual and among predicted labels."""
    wide = df.agg(*[F.avg((F.col(c) == k).cast("double")).alias(f"{n}{k}")
                    for k in classes for n, c in (("a", y), ("p", yhat))])
    return wide.select(F.explode(F.array(*[
        F.struct(F.lit(k).alias("class"), (F.col(f"a{k}") * 100).alias("actual_pct"),
                 (F.col(f"p{k}") * 100).alias("predicted_pct")) for k in classes])).alias("_x")).select("_x.*")


def leaderboard(scored: DataFrame, model: str, y: str, score: str, yhat: str) -> DataFrame:
    """All metrics per model over one long scored set, best PR-AUC first."""
    # one aggregation of the rows; both the confusion and the curve come from its cells
    cells = scored.groupBy(model, score, yhat).agg(F.count_if(F.col(y) == 1).alias("_pos"), F.count_if(F.col(y) == 0).alias("_neg"))

    def cell(count, predicted):
        return F.coalesce(F.sum(F.when(F.col(yhat) == predicted, F.col(count))), F.lit(0))

    c = _metrics_of(cells.groupBy(model).agg(cell("_neg", 0).alias("tn"), cell("_neg", 1).alias("fp"),
                                             cell("_pos", 0).alias("fn"), cell("_pos", 1).alias("tp")), [model])
    known = cells.filter(F.col(score).isNotNull() & (F.col("_pos") + F.col("_neg") > 0))
    curve = running_counts(known, score, {"pos": F.sum("_pos"), "n": F.sum(F.col("_pos") + F.col("_neg"))}, [model])
    r = _ranking_of(curve, [model])
    joined = c.alias("c").join(r.alias("r"), same_keys("c", "r", [model]), "left")
    return joined.select(F.col(f"c.{model}").alias(model), "r.pr_auc", "r.roc_auc", "c.recall_pos",
                         "c.precision_pos", F.col("c.macro_f1").alias("test_f1"), "c.accuracy",
                         ).orderBy(F.desc_nulls_last("pr_auc"), model)


def parity(a: DataFrame, b: DataFrame, key: str, prediction: str = "prediction") -> DataFrame:
    """How many keyed predictions of two sets agree."""
    j = _paired(a, b, key, prediction)
    same = F.col("prediction_a").eqNullSafe(F.col("prediction_b"))
    return j.agg(F.count("*").alias("compared"), F.count_if(same).alias("identical"),
                 F.coalesce(F.round(F.avg(same.cast("double")) * 100, 4), F.lit(0.0)).alias("identical_pct"))


def parity_diff(a: DataFrame, b: DataFrame, key: str, prediction: str = "prediction") -> DataFrame:
    """The keyed predictions that differ."""
    return _paired(a, b, key, prediction).filter(
        ~F.col("prediction_a").eqNullSafe(F.col("prediction_b")))


def _paired(a, b, key, prediction):
    return (a.select(key, F.col(prediction).alias("prediction_a"))
            .join(b.select(key, F.col(prediction).alias("prediction_b")), key, "inner"))


def metrics_long(metrics: DataFrame, version: Column | str, names: Sequence[str], digits: int = 4) -> DataFrame:
    """Metric columns of one-row results as rows ``version, metric, value``."""
    v = F.lit(version) if isinstance(version, (str, int)) else version
    return metrics.select(v.cast("string").alias("version"), F.explode(F.array(*[
        F.struct(F.lit(n).alias("metric"), F.round(F.col(n).cast("double"), digits).alias("value"))
        for n in names])).alias("_x")).select("version", "_x.*")


def approve(metrics: DataFrame, threshold: float = F1_THRESHOLD, metric: str = "test_f1") -> DataFrame:
    """Per version: the gate's decision and its reason. A missing metric counts as 0."""
    value = F.coalesce(F.max(F.when(F.col("metric") == metric, F.col("value"))), F.lit(0.0))
    ok = F.col("value") >= F.lit(threshold)
    return metrics.groupBy("version").agg(value.alias("value")).select(
        "version", F.lit(metric).alias("metric"), "value", F.lit(threshold).alias("threshold"),
        ok.alias("approved"),
        F.concat(F.lit(f"{metric} of "), F.format_string("%.4f", F.col("value")),
                 F.when(ok, " meets ").otherwise(" misses "), F.lit(f"{threshold:.2f}")).alias("reason"))


def resolve_version(versions: DataFrame, order: Sequence[str] = ("champion", "dev")) -> DataFrame:
    """The newest version under the first alias that exists."""
    at = F.array_position(F.array(*[F.lit(a) for a in order]), F.col("alias"))
    return versions.filter(F.col("alias").isin(*order)).orderBy(at, F.desc("version")).limit(1)

"""Classification metrics over one long score table.

Input columns: ``model_key, row_id, fold, y, score, pred[, split]``, or equal
rows counted as one with ``n_rows`` in place of ``row_id``. Every
metric is a grouped aggregation over that table, so all models (and folds)
are evaluated in one pass rather than one evaluator job per model.

Ranking metrics (ROC AUC, average precision, curves) are exact with ties:
rows are first reduced to one row per distinct (group, score), then running
sums in score order come from ``ordered_cumsum`` (no window over a whole
group).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kestrel.operators.ordered import ordered_cumsum
from kestrel.storage import materialize

METRICS = ("accuracy", "precision", "recall", "f1", "roc_auc")


def count_rows(scores: DataFrame, condition: Column) -> Column:
    """Number of score rows that meet the condition; a row with a column
    ``n_rows`` stands for that many."""
    if "n_rows" not in scores.columns:
        return F.count_if(condition)
    return F.coalesce(F.sum(F.when(condition, F.col("n_rows")).otherwise(0)), F.lit(0))


def _div0(a, b):
    """a / b with 0 when b == 0 (zero_division=0)."""
    return F.when(b == 0, F.lit(0.0)).otherwise(a.cast("double") / b)


# V3
def confusion_counts(scores: DataFrame, by: Sequence[str]) -> DataFrame:
    y, p = F.col("y"), F.col("pred")
    return scores.groupBy(*by).agg(
        count_rows(scores, (y == 1) & (p == 1)).alias("tp"), count_rows(scores, (y == 0) & (p == 1)).alias("fp"),
        count_rows(scores, (y == 1) & (p == 0)).alias("fn"), count_rows(scores, (y == 0) & (p == 0)).alias("tn"))


def confusion_matrix(scores: DataFrame, by: Sequence[str]) -> DataFrame:
    """Long 2x2 matrix per group, missing cells filled with 0."""
    c = confusion_counts(scores, by)
    cells = F.array(*[F.struct(F.lit(yv).alias("y"), F.lit(pv).alias("pred"), F.col(n).alias("n_rows"))
                      for yv, pv, n in ((1, 1, "tp"), (0, 1, "fp"), (1, 0, "fn"), (0, 0, "tn"))])
    return c.select(*by, F.inline(cells))


# V4
def threshold_metrics(scores: DataFrame, by: Sequence[str], prefix: str = "") -> DataFrame:
    c = confusion_counts(scores, by)
    tp, fp, fn, tn = (F.col(x) for x in ("tp", "fp", "fn", "tn"))
    return c.select(*by,
                    _div0(tp + tn, tp + fp + fn + tn).alias(f"{prefix}accuracy"),
                    _div0(tp, tp + fp).alias(f"{prefix}precision"),
                    _div0(tp, tp + fn).alias(f"{prefix}recall"),
                    _div0(2 * tp, 2 * tp + fp + fn).alias(f"{prefix}f1"))


def _ranked(scores: DataFrame, by: Sequence[str]) -> DataFrame:
    """One row per (group, distinct score) with pos/neg counts and running
    sums in descending score order, plus group totals P, N."""
    n = F.col("n_rows") if "n_rows" in scores.columns else F.lit(1)
    per = scores.groupBy(*by, "score").agg(
        F.sum(F.col("y").cast("bigint") * n).alias("pos"),
        F.sum((1 - F.col("y")).cast("bigint") * n).alias("neg"))
    cum = ordered_cumsum(per, by, "score", ["pos", "neg"], descending=True)
    tot = per.groupBy(*by).agg(F.sum("pos").alias("P"), F.sum("neg").alias("N"),
                               F.count(F.lit(1)).alias("n_thresholds"))
    return cum.join(tot, list(by))


# V5, V6
def ranking_metrics(scores: DataFrame, by: Sequence[str], prefix: str = "") -> DataFrame:
    """ROC AUC (ties count one half) and average precision (no
    interpolation). NULL when a group has only one class."""
    r = _ranked(scores, by)
    above = F.col("cum_pos") - F.col("pos")
    auc_num = F.sum(F.col("neg") * (above + F.col("pos") / 2.0))
    ap_num = F.sum(F.col("pos") * (F.col("cum_pos") / (F.col("cum_pos") + F.col("cum_neg"))))
    g = r.groupBy(*by, "P", "N").agg(auc_num.alias("_auc"), ap_num.alias("_ap"))
    ok = (F.col("P") > 0) & (F.col("N") > 0)
    return g.select(*by,
                    F.when(ok, F.col("_auc") / (F.col("P") * F.col("N"))).alias(f"{prefix}roc_auc"),
                    F.when(F.col("P") > 0, F.col("_ap") / F.col("P")).alias(f"{prefix}average_precision"))


# V7
def roc_curve(scores: DataFrame, by: Sequence[str], drop_intermediate: bool = True) -> DataFrame:
    """(threshold, fpr, tpr) per group, thresholds descending, starting at
    (inf, 0, 0). Collinear points are dropped as scikit-learn does: a point
    is kept if it is the first or last or the count of positives or
    negatives changes at the next threshold."""
    r = materialize(_ranked(scores, by), "ranked")  # read three times below
    nxt = r.select(*by, (F.col("cum_rows") - 1).alias("cum_rows"),
                   F.col("pos").alias("_npos"), F.col("neg").alias("_nneg"))
    j = r.join(nxt, [*by, "cum_rows"], "left")  # neighbour by equi-join on position
    keep = ((F.col("cum_rows") == 1) | (F.col("cum_rows") == F.col("n_thresholds"))
            | (F.col("_npos") != F.col("pos")) | (F.col("_nneg") != F.col("neg")))
    if drop_intermediate:
        j = j.where(keep | (F.col("n_thresholds") <= 2))
    pts = j.select(*by, F.col("score").alias("threshold"),
                   F.when(F.col("N") > 0, F.col("cum_neg") / F.col("N")).alias("fpr"),
                   F.when(F.col("P") > 0, F.col("cum_pos") / F.col("P")).alias("tpr"))
    start = r.select(*by).distinct().select(*by, F.lit(float("inf")).alias("threshold"),
                                            F.lit(0.0).alias("fpr"), F.lit(0.0).alias("tpr"))
    return start.unionByName(pts)


# V8
def pr_curve(scores: DataFrame, by: Sequence[str]) -> DataFrame:
    """(threshold, precision, recall) per distinct threshold plus the end
    point (NULL, 1, 0); recall is 1 everywhere when a group has no positive."""
    r = _ranked(scores, by)
    prec = _div0(F.col("cum_pos"), F.col("cum_pos") + F.col("cum_neg"))
    rec = F.when(F.col("P") == 0, F.lit(1.0)).otherwise(F.col("cum_pos") / F.col("P"))
    pts = r.select(*by, F.col("score").alias("threshold"), prec.alias("precision"), rec.alias("recall"))
    end = r.select(*by).distinct().select(*by, F.lit(None).cast("double").alias("threshold"),
                                          F.lit(1.0).alias("precision"), F.lit(0.0).alias("recall"))
    return pts.unionByName(end)


# V9
def classification_report(scores: DataFrame, by: Sequence[str]) -> DataFrame:
    """Long report per group: labels '0', '1', 'accuracy', 'macro avg',
    'weighted avg' with precision, recall, f1-score, support. The accuracy
    row repeats the accuracy in all four columns."""
    c = confusion_counts(scores, by)
    tp, fp, fn, tn = (F.col(x) for x in ("tp", "fp", "fn", "tn"))
    n = tp + fp + fn + tn
    p1, r1, f1 = _div0(tp, tp + fp), _div0(tp, tp + fn), _div0(2 * tp, 2 * tp + fp + fn)
    p0, r0, f0 = _div0(tn, tn + fn), _div0(tn, tn + fp), _div0(2 * tn, 2 * tn + fn + fp)
    s1, s0 = (tp + fn).cast("double"), (tn + fp).cast("double")
    acc = _div0(tp + tn, n)
    w = lambda a, b: _div0(a * s0 + b * s1, n)
    names = ("label", "precision", "recall", "f1-score", "support")

    def row(*vals):
        return F.struct(*[v.alias(nm) for v, nm in zip(vals, names)])

    rows = F.array(
        row(F.lit("0"), p0, r0, f0, s0),
        row(F.lit("1"), p1, r1, f1, s1),
        row(F.lit("accuracy"), acc, acc, acc, acc),
        row(F.lit("macro avg"), (p0 + p1) / 2, (r0 + r1) / 2, (f0 + f1) / 2, n.cast("double")),
        row(F.lit("weighted avg"), w(p0, p1), w(r0, r1), w(f0, f1), n.cast("double")),
    )
    return c.select(*by, F.inline(rows))


# V1 / V10 helpers
def fold_metrics(scores: DataFrame, by: Sequence[str] = ("model_key", "fold"), prefix: str = "test_") -> DataFrame:
    """accuracy, precision, recall, f1 and roc_auc per (model, fold)."""
    by = list(by)
    t = threshold_metrics(scores, by, prefix)
    r = ranking_metrics(scores, by, prefix).drop(f"{prefix}average_precision")
    return t.join(r, by)


# A5 / V10
def cv_summary(folds: DataFrame, metrics: Sequence[str] = METRICS, prefix: str = "test_",
               extra_means: Sequence[str] = ("fit_time", "score_time"), primary: str = "f1") -> DataFrame:
    """Mean and population std over folds per model (+ mean times)."""
    aggs = [F.count(F.lit(1)).cast("int").alias("cv_folds")]
    for m in metrics:
        aggs += [F.avg(f"{prefix}{m}").alias(f"{prefix}{m}_mean"), F.stddev_pop(f"{prefix}{m}").alias(f"{prefix}{m}_std")]
    aggs += [F.avg(c).alias(f"{c}_mean") for c in extra_means if c in folds.columns]
    out = folds.groupBy("model_key").agg(*aggs).withColumn("primary_metric", F.lit(primary))
    return out.orderBy(F.desc_nulls_last(f"{prefix}{primary}_mean"), "model_key")


# A6 / V11
def train_test_gap(train_folds: DataFrame, test_folds: DataFrame, metrics: Sequence[str] = METRICS) -> DataFrame:
    """Mean train and test metric per model, their difference, and the F1 diagnosis."""
    from kestrel.functions.scalar import gap_diagnosis

    tr = train_folds.groupBy("model_key").agg(*[F.avg(f"train_{m}").alias(f"train_{m}_mean") for m in metrics])
    te = test_folds.groupBy("model_key").agg(*[F.avg(f"test_{m}").alias(f"test_{m}_mean") for m in metrics])
    j = tr.join(te, "model_key")
    cols = ["model_key"]
    for m in metrics:
        cols += [F.col(f"train_{m}_mean"), F.col(f"test_{m}_mean"),
                 (F.col(f"train_{m}_mean") - F.col(f"test_{m}_mean")).alias(f"{m}_gap")]
    out = j.select(*cols)
    return out.withColumn("f1_diagnosis", gap_diagnosis("f1_gap"))


# V2
def oof_metrics(scores: DataFrame, by: Sequence[str] = ("model_key",), prefix: str = "oof_") -> DataFrame:
    """Metrics of the out-of-fold predictions (one row per model and row)."""
    by = list(by)
    return threshold_metrics(scores, by, prefix).join(ranking_metrics(scores, by, prefix), by)

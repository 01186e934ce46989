import numpy as np
import pandas as pd
from pyspark.sql import functions as F

from kestrel.operators import metrics as mt


def _scores(spark, rows):
    return spark.createDataFrame(
        [("m", i, 1, int(y), float(s), int(p)) for i, (y, s, p) in enumerate(rows)],
        "model_key string, row_id int, fold int, y int, score double, pred int")


def _brute_auc(y, s):
    pos, neg = s[y == 1], s[y == 0]
    gt = (pos[:, None] > neg[None, :]).sum() + 0.5 * (pos[:, None] == neg[None, :]).sum()
    return gt / (len(pos) * len(neg))


def _brute_ap(y, s):
    out, P = 0.0, y.sum()
    for t in sorted(set(s), reverse=True):
        sel = s >= t
        tp = (y[sel] == 1).sum()
        out += (y[s == t] == 1).sum() / P * tp / sel.sum()
    return out


def test_auc_and_ap_with_ties_match_brute_force(spark):
    rng = np.random.default_rng(7)
    y = rng.integers(0, 2, 300)
    s = np.round(rng.random(300) * 0.5 + y * 0.2, 1)
    df = _scores(spark, [(a, b, int(b >= 0.5)) for a, b in zip(y, s)])
    r = mt.ranking_metrics(df, ["model_key"]).first()
    assert abs(r["roc_auc"] - _brute_auc(y, s)) < 1e-12
    assert abs(r["average_precision"] - _brute_ap(y, s)) < 1e-12


def test_auc_edge_cases(spark):
    equal = _scores(spark, [(0, 0.5, 1), (1, 0.5, 1), (1, 0.5, 1)])
    assert mt.ranking_metrics(equal, ["model_key"]).first()["roc_auc"] == 0.5
    one_class = _scores(spark, [(1, 0.2, 0), (1, 0.9, 1)])
    assert mt.ranking_metrics(one_class, ["model_key"]).first()["roc_auc"] is None
    perfect = _scores(spark, [(0, 0.1, 0), (0, 0.2, 0), (1, 0.8, 1), (1, 0.9, 1)])
    assert mt.ranking_metrics(perfect, ["model_key"]).first()["roc_auc"] == 1.0


def test_zero_division(spark):
    df = _scores(spark, [(1, 0.1, 0), (0, 0.2, 0)])
    r = mt.threshold_metrics(df, ["model_key"]).first()
    assert r["precision"] == 0.0 and r["f1"] == 0.0 and r["recall"] == 0.0 and r["accuracy"] == 0.5


def test_confusion_matrix_complete_grid(spark):
    df = _scores(spark, [(1, 0.9, 1), (1, 0.8, 1)])
    cells = {(r["y"], r["pred"]): r["n_rows"] for r in mt.confusion_matrix(df, ["model_key"]).collect()}
    assert cells == {(1, 1): 2, (0, 1): 0, (1, 0): 0, (0, 0): 0}


def test_roc_curve_drops_collinear_points(spark):
    df = _scores(spark, [(1, 0.9, 1), (1, 0.8, 1), (1, 0.7, 1), (0, 0.3, 0), (0, 0.2, 0)])
    pts = mt.roc_curve(df, ["model_key"]).orderBy(F.desc("threshold")).collect()
    # scikit-learn keeps (0,0) start, first, last and corners: thresholds inf, .9, .7, .2
    assert [p["threshold"] for p in pts] == [float("inf"), 0.9, 0.7, 0.2]
    assert (pts[-1]["fpr"], pts[-1]["tpr"]) == (1.0, 1.0)


def test_classification_report_f1_follows_precision_recall(spark):
    df = _scores(spark, [(1, 0.9, 1), (0, 0.8, 1), (1, 0.2, 0), (0, 0.1, 0), (0, 0.3, 0)])
    rep = {r["label"]: r for r in mt.classification_report(df, ["model_key"]).collect()}
    for lab in ("0", "1"):
        p, r = rep[lab]["precision"], rep[lab]["recall"]
        assert abs(rep[lab]["f1-score"] - 2 * p * r / (p + r)) < 1e-12
    assert rep["accuracy"]["support"] == rep["accuracy"]["precision"] == 0.6


def test_cv_summary_reproduces_recorded_rf_row(spark):
    # recorded per-fold values of the reference's rf (fold results table)
    f1 = [0.9882034422742216, 0.9891109713013599, 0.9890620462685122, 0.9891162385720506, 0.9883046588053354]
    fit = [64.18195509910583, 63.9845130443573, 62.27491092681885, 62.373694896698, 62.219768047332764]
    rows = [("rf", i + 1, f1[i], fit[i]) for i in range(5)]
    folds = spark.createDataFrame(rows, "model_key string, fold int, test_f1 double, fit_time double")
    s = mt.cv_summary(folds, metrics=["f1"], extra_means=["fit_time"]).first()
    assert abs(s["test_f1_mean"] - 0.988759471444296) < 1e-12
    assert abs(s["test_f1_std"] - 0.0004143451295100812) < 1e-12  # population std
    assert abs(s["fit_time_mean"] - 63.00696840286255) < 1e-9

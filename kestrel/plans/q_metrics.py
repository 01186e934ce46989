"""Evaluation queries over the score table."""

from __future__ import annotations

from pyspark.sql import functions as F

from kestrel.operators import metrics as mt
from kestrel.operators import profile as pr
from kestrel.plans import score_views as sv
from kestrel.plans.registry import register
from kestrel.plans.views import with_views
from kestrel.storage import materialize

R = 6


def _r(c, name=None):
    return F.round(F.col(c), R).alias(name or c)


def score_table(spark, sf):
    """The score table with equal rows counted, written once (Parquet in the
    shared checkpoint folder) for queries that read it from several branches, so
    auction, folds and scores are not rebuilt for each branch."""
    return materialize(sv.score_counts(spark, sf), "scores")


def test_scores(spark, sf, sc=None):
    sc = sc if sc is not None else sv.scores(spark, sf)
    return sc.where(F.col("split") == "test")


def _with_scores(body: str, *extra: str) -> str:
    return with_views(body, "auction", extra=(sv.SCORES_SQL, *extra))


def _conf_sql(by: str, split: str) -> str:
    return f"""SELECT {by},
  count(*) FILTER (WHERE y = 1 AND pred = 1) AS tp, count(*) FILTER (WHERE y = 0 AND pred = 1) AS fp,
  count(*) FILTER (WHERE y = 1 AND pred = 0) AS fn, count(*) FILTER (WHERE y = 0 AND pred = 0) AS tn
FROM scores WHERE split = '{split}' GROUP BY {by}"""


def _div0(a: str, b: str) -> str:
    return f"CASE WHEN ({b}) = 0 THEN 0.0 ELSE CAST({a} AS DOUBLE) / ({b}) END"


def _thr_metrics_sql(prefix: str) -> str:
    return (f"round({_div0('tp + tn', 'tp + fp + fn + tn')}, 6) AS {prefix}accuracy, "
            f"round({_div0('tp', 'tp + fp')}, 6) AS {prefix}precision, "
            f"round({_div0('tp', 'tp + fn')}, 6) AS {prefix}recall, "
            f"round({_div0('2 * tp', '2 * tp + fp + fn')}, 6) AS {prefix}f1")


def _cum_sql(by: str, split: str) -> str:
    return f"""SELECT *, sum(pos) OVER w AS cum_pos, sum(neg) OVER w AS cum_neg, row_number() OVER w AS cum_rows,
       sum(pos) OVER (PARTITION BY {by}) AS P, sum(neg) OVER (PARTITION BY {by}) AS N,
       count(*) OVER (PARTITION BY {by}) AS n_thr
FROM (SELECT {by}, score, CAST(sum(y) AS BIGINT) AS pos, CAST(sum(1 - y) AS BIGINT) AS neg
      FROM scores WHERE split = '{split}' GROUP BY {by}, score) per
WINDOW w AS (PARTITION BY {by} ORDER BY score DESC ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)"""


def _rank_metrics_sql(by: str, split: str, prefix: str) -> str:
    return f"""SELECT {by},
  CASE WHEN P > 0 AND N > 0 THEN sum(neg * (cum_pos - pos + pos / 2.0::DOUBLE)) / (P * N) END AS {prefix}roc_auc,
  CASE WHEN P > 0 THEN sum(pos * (cum_pos / (cum_pos + cum_neg)::DOUBLE)) / P END AS {prefix}average_precision
FROM ({_cum_sql(by, split)}) c GROUP BY {by}, P, N"""


# ---------------------------------------------------------------- V3
@register("v3_confusion_matrix", _with_scores("""
SELECT model_key, y, pred, n_rows FROM (""" + _conf_sql("model_key", "test") + """) c,
LATERAL (VALUES (1, 1, tp), (0, 1, fp), (1, 0, fn), (0, 0, tn)) v(y, pred, n_rows)"""))
def v3_confusion_matrix(spark, sf):
    return mt.confusion_matrix(test_scores(spark, sf), ["model_key"])


# ---------------------------------------------------------------- V4, V5, V6 (V2 OOF metrics)
@register("v2_oof_metrics", _with_scores(f"""
SELECT t.model_key, CASE t.model_key WHEN 'svm' THEN 'decision_function' ELSE 'predict_proba' END AS score_method,
       t.oof_accuracy, t.oof_precision, t.oof_recall, t.oof_f1,
       round(r.oof_roc_auc, 6) AS oof_roc_auc, round(r.oof_average_precision, 6) AS oof_average_precision
FROM (SELECT model_key, {_thr_metrics_sql("oof_")} FROM ({_conf_sql("model_key", "test")}) c) t
JOIN ({_rank_metrics_sql("model_key", "test", "oof_")}) r ON t.model_key = r.model_key"""))
def v2_oof_metrics(spark, sf):
    out = mt.oof_metrics(test_scores(spark, sf, score_table(spark, sf)))
    method = F.create_map(*[F.lit(x) for kv in sv.SCORE_METHOD.items() for x in kv])
    return out.select("model_key", method[F.col("model_key")].alias("score_method"),
                      *[_r(f"oof_{m}") for m in ("accuracy", "precision", "recall", "f1", "roc_auc",
                                                  "average_precision")])


@register("v2_oof_one_row_per_model_row", _with_scores("""
SELECT model_key, count(*) AS n_rows, count(DISTINCT row_id) AS n_distinct_rows
FROM scores WHERE split = 'test' GROUP BY model_key"""))
def v2_oof_one_row_per_model_row(spark, sf):
    s = test_scores(spark, sf)
    return s.groupBy("model_key").agg(F.count(F.lit(1)).alias("n_rows"),
                                      F.count_distinct("row_id").alias("n_distinct_rows"))


@register("v4_threshold_metrics_by_fold", _with_scores(f"""
SELECT model_key, fold, {_thr_metrics_sql("")} FROM ({_conf_sql("model_key, fold", "test")}) c"""))
def v4_threshold_metrics_by_fold(spark, sf):
    out = mt.threshold_metrics(test_scores(spark, sf), ["model_key", "fold"])
    return out.select("model_key", "fold", *[_r(m) for m in ("accuracy", "precision", "recall", "f1")])


@register("v5_v6_ranking_metrics", _with_scores(f"""
SELECT model_key, round(roc_auc, 6) AS roc_auc, round(average_precision, 6) AS average_precision
FROM ({_rank_metrics_sql("model_key", "test", "")}) r"""))
def v5_v6_ranking_metrics(spark, sf):
    out = mt.ranking_metrics(test_scores(spark, sf, score_table(spark, sf)), ["model_key"])
    return out.select("model_key", _r("roc_auc"), _r("average_precision"))


# ---------------------------------------------------------------- V7, V8
@register("v7_roc_curve", _with_scores(f"""
SELECT model_key, 'inf'::DOUBLE AS threshold, 0.0::DOUBLE AS fpr, 0.0::DOUBLE AS tpr
FROM (SELECT DISTINCT model_key FROM scores WHERE split = 'test') m
UNION ALL
SELECT model_key, score AS threshold,
       round(CASE WHEN N > 0 THEN cum_neg / N::DOUBLE END, 6) AS fpr,
       round(CASE WHEN P > 0 THEN cum_pos / P::DOUBLE END, 6) AS tpr
FROM (SELECT *, lead(pos) OVER o AS npos, lead(neg) OVER o AS nneg
      FROM ({_cum_sql("model_key", "test")}) c WINDOW o AS (PARTITION BY model_key ORDER BY cum_rows)) x
WHERE cum_rows = 1 OR cum_rows = n_thr OR npos <> pos OR nneg <> neg OR n_thr <= 2"""))
def v7_roc_curve(spark, sf):
    out = mt.roc_curve(test_scores(spark, sf, score_table(spark, sf)), ["model_key"])
    return out.select("model_key", "threshold", _r("fpr"), _r("tpr"))


@register("v8_pr_curve", _with_scores(f"""
SELECT model_key, score AS threshold,
       round({_div0("cum_pos", "cum_pos + cum_neg")}, 6) AS precision,
       round(CASE WHEN P = 0 THEN 1.0 ELSE cum_pos / P::DOUBLE END, 6) AS recall
FROM ({_cum_sql("model_key", "test")}) c
UNION ALL
SELECT DISTINCT model_key, NULL::DOUBLE, 1.0::DOUBLE, 0.0::DOUBLE FROM scores WHERE split = 'test'"""))
def v8_pr_curve(spark, sf):
    out = mt.pr_curve(test_scores(spark, sf, score_table(spark, sf)), ["model_key"])
    return out.select("model_key", "threshold", _r("precision"), _r("recall"))


# ---------------------------------------------------------------- V9
def _report_sql() -> str:
    p1, r1, f1 = _div0("tp", "tp + fp"), _div0("tp", "tp + fn"), _div0("2 * tp", "2 * tp + fp + fn")
    p0, r0, f0 = _div0("tn", "tn + fn"), _div0("tn", "tn + fp"), _div0("2 * tn", "2 * tn + fn + fp")
    acc = _div0("tp + tn", "tp + fp + fn + tn")
    n = "CAST(tp + fp + fn + tn AS DOUBLE)"
    s0, s1 = "CAST(tn + fp AS DOUBLE)", "CAST(tp + fn AS DOUBLE)"

    def w(a, b):
        return _div0(f"({a}) * {s0} + ({b}) * {s1}", "tp + fp + fn + tn")

    rows = [("'0'", p0, r0, f0, s0), ("'1'", p1, r1, f1, s1), ("'accuracy'", acc, acc, acc, acc),
            ("'macro avg'", f"(({p0}) + ({p1})) / 2", f"(({r0}) + ({r1})) / 2", f"(({f0}) + ({f1})) / 2", n),
            ("'weighted avg'", w(p0, p1), w(r0, r1), w(f0, f1), n)]
    sel = "\nUNION ALL\n".join(
        f"SELECT model_key, {lab} AS label, round({a}, 6) AS precision, round({b}, 6) AS recall, "
        f"round({c}, 6) AS \"f1-score\", round({d}, 6) AS support FROM conf" for lab, a, b, c, d in rows)
    return sel


@register("v9_classification_report", _with_scores(_report_sql(), f"conf AS ({_conf_sql('model_key', 'test')})"))
def v9_classification_report(spark, sf):
    out = mt.classification_report(test_scores(spark, sf), ["model_key"])
    return out.select("model_key", "label", *[_r(c) for c in ("precision", "recall", "f1-score", "support")])


# ---------------------------------------------------------------- V1, V10, V11
_FOLD_SQL = f"""fold_res AS (
SELECT t.model_key, t.fold, t.test_accuracy, t.test_precision, t.test_recall, t.test_f1, r.test_roc_auc,
       tm.fit_time, tm.score_time
FROM (SELECT model_key, fold, {_thr_metrics_sql("test_").replace("round(", "(").replace(", 6)", ")")}
      FROM ({_conf_sql("model_key, fold", "test")}) c) t
JOIN ({_rank_metrics_sql("model_key, fold", "test", "test_")}) r ON t.model_key = r.model_key AND t.fold = r.fold
JOIN times tm ON t.model_key = tm.model_key AND t.fold = tm.fold)"""

_TRAIN_FOLD_SQL = f"""train_res AS (
SELECT t.model_key, t.fold, t.train_accuracy, t.train_precision, t.train_recall, t.train_f1, r.train_roc_auc
FROM (SELECT model_key, fold, {_thr_metrics_sql("train_").replace("round(", "(").replace(", 6)", ")")}
      FROM ({_conf_sql("model_key, fold", "train")}) c) t
JOIN ({_rank_metrics_sql("model_key, fold", "train", "train_")}) r ON t.model_key = r.model_key AND t.fold = r.fold)"""


def fold_results(spark, sf, split: str = "test", sc=None):
    sc = sc if sc is not None else sv.scores(spark, sf)
    part = sc.where(F.col("split") == split)
    res = mt.fold_metrics(part, ["model_key", "fold"], prefix=f"{split}_")
    if split == "test":
        res = res.join(sv.fold_times(sc), ["model_key", "fold"])
    return res


@register("v1_cv_fold_results", _with_scores(
    "SELECT model_key, fold, " + ", ".join(f"round({c}, 6) AS {c}" for c in (
        "test_accuracy", "test_precision", "test_recall", "test_f1", "test_roc_auc", "fit_time", "score_time"))
    + " FROM fold_res", _FOLD_SQL))
def v1_cv_fold_results(spark, sf):
    res = fold_results(spark, sf, sc=score_table(spark, sf))
    return res.select("model_key", "fold", *[_r(c) for c in (
        "test_accuracy", "test_precision", "test_recall", "test_f1", "test_roc_auc", "fit_time", "score_time")])


_SUMMARY_COLS = [f"test_{m}_{s}" for m in mt.METRICS for s in ("mean", "std")] + ["fit_time_mean", "score_time_mean"]


def _summary_sql() -> str:
    aggs = []
    for m in mt.METRICS:
        aggs += [f"avg(test_{m}) AS test_{m}_mean", f"stddev_pop(test_{m}) AS test_{m}_std"]
    aggs += ["avg(fit_time) AS fit_time_mean", "avg(score_time) AS score_time_mean"]
    return f"""cv_sum AS (SELECT model_key, 'f1' AS primary_metric, CAST(count(*) AS INTEGER) AS cv_folds, {", ".join(aggs)}
FROM fold_res GROUP BY model_key)"""


@register("v10_cv_summary", _with_scores(
    "SELECT model_key, primary_metric, cv_folds, " + ", ".join(f"round({c}, 6) AS {c}" for c in _SUMMARY_COLS)
    + " FROM cv_sum", _FOLD_SQL, _summary_sql()))
def v10_cv_summary(spark, sf):
    s = mt.cv_summary(fold_results(spark, sf, sc=score_table(spark, sf)))
    return s.select("model_key", "primary_metric", "cv_folds", *[_r(c) for c in _SUMMARY_COLS])


_GAP_COLS = [x for m in mt.METRICS for x in (f"train_{m}_mean", f"test_{m}_mean", f"{m}_gap")]


def _gap_sql() -> str:
    sel = []
    for m in mt.METRICS:
        sel += [f"tr.train_{m}_mean", f"te.test_{m}_mean", f"tr.train_{m}_mean - te.test_{m}_mean AS {m}_gap"]
    return f"""gap AS (
SELECT tr.model_key, {", ".join(sel)},
       CASE WHEN tr.train_f1_mean - te.test_f1_mean >= 0.10 THEN 'posible overfitting'
            WHEN tr.train_f1_mean - te.test_f1_mean <= 0.03 THEN 'sin brecha fuerte'
            WHEN tr.train_f1_mean - te.test_f1_mean IS NOT NULL THEN 'brecha moderada' END AS f1_diagnosis
FROM (SELECT model_key, {", ".join(f"avg(train_{m}) AS train_{m}_mean" for m in mt.METRICS)} FROM train_res GROUP BY model_key) tr
JOIN (SELECT model_key, {", ".join(f"avg(test_{m}) AS test_{m}_mean" for m in mt.METRICS)} FROM fold_res GROUP BY model_key) te
  ON tr.model_key = te.model_key)"""


@register("v11_train_test_gap", _with_scores(
    "SELECT model_key, " + ", ".join(f"round({c}, 6) AS {c}" for c in _GAP_COLS) + ", f1_diagnosis FROM gap",
    _FOLD_SQL, _TRAIN_FOLD_SQL, _gap_sql()))
def v11_train_test_gap(spark, sf):
    sc = score_table(spark, sf)
    g = mt.train_test_gap(fold_results(spark, sf, "train", sc), fold_results(spark, sf, "test", sc))
    return g.select("model_key", *[_r(c) for c in _GAP_COLS], "f1_diagnosis")


# ---------------------------------------------------------------- P17
_KPI = {"oof_roc_auc": 0.75, "oof_f1": 0.50}


@register("p17_kpi_check", _with_scores(f"""
SELECT model_key, metric, value, minimum, value >= minimum AS meets_kpi FROM (
  SELECT t.model_key, 'oof_f1' AS metric, t.oof_f1 AS value, 0.5::DOUBLE AS minimum
  FROM (SELECT model_key, {_thr_metrics_sql("oof_")} FROM ({_conf_sql("model_key", "test")}) c) t
  UNION ALL
  SELECT model_key, 'oof_roc_auc', round(oof_roc_auc, 6), 0.75::DOUBLE FROM ({_rank_metrics_sql("model_key", "test", "oof_")}) r
) k"""))
def p17_kpi_check(spark, sf):
    m = mt.oof_metrics(test_scores(spark, sf, score_table(spark, sf)))
    long = m.select("model_key", F.inline(F.array(*[
        F.struct(F.lit(k).alias("metric"), F.round(F.col(k), 6).alias("value")) for k in _KPI])))
    thresholds = spark.createDataFrame(list(_KPI.items()), "metric string, minimum double")
    return pr.kpi_check(long, thresholds).select("model_key", "metric", "value", "minimum", "meets_kpi")

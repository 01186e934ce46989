"""The long score table proxy (Spark and oracle SQL).

Five models' closed-form scores from auction columns, in hundredths so that
ties occur: ``model_key, row_id, fold, y, score, pred, split``. Test rows are
the out-of-fold score of every row; train rows repeat each row for the four
folds whose training part holds it (score + 0.03), for the train/test gap.
Fit and score times per fold are a cost proxy proportional to the rows
handled (per-model seconds per 100,000 rows).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kestrel.operators.metrics import count_rows
from kestrel.operators.sampling import stratified_folds
from kestrel.plans.q_sampling import FOLDS
from kestrel.sources import proxies
from kestrel.storage import materialize

MODEL_KEYS = ("lr", "dt", "rf", "knn", "svm")
# Decision threshold (in hundredths) and cost proxy per model.
THRESHOLD = {"lr": 50, "dt": 50, "rf": 50, "knn": 50, "svm": 0}
FIT_COST = {"lr": 10.0, "dt": 11.5, "rf": 63.0, "knn": 1.3, "svm": 18.2}
SCORE_COST = {"lr": 0.38, "dt": 0.37, "rf": 1.16, "knn": 234.5, "svm": 7.0}
SCORE_METHOD = {"lr": "predict_proba", "dt": "predict_proba", "rf": "predict_proba",
                "knn": "predict_proba", "svm": "decision_function"}
N_FOLDS = 5
AUCTION = ["row_id", "IsBadBuy", "VehBCost"]


def _score_int(y, rid, cost):
    return {
        "lr": F.floor(100 * cost / (cost + 250000)),
        "dt": y * 40 + (rid * 37) % 61,
        "rf": y * 35 + (rid * 13) % 66,
        "knn": F.least(F.lit(5), y * 2 + rid % 4) * 20,
        "svm": (rid * 7) % 201 - 100 + y * 15,
    }


def _test_rows(a: DataFrame) -> DataFrame:
    """The five models' scores of the auction rows, in hundredths."""
    f = stratified_folds(a, "IsBadBuy", "row_id", N_FOLDS)
    y, rid = F.col("IsBadBuy"), F.col("row_id")
    s = _score_int(y, rid, F.col("VehBCost"))
    return f.select("row_id", "fold", y.alias("y"), F.inline(F.array(*[
        F.struct(F.lit(k).alias("model_key"), s[k].cast("bigint").alias("s"), F.lit(THRESHOLD[k]).alias("thr"))
        for k in MODEL_KEYS])))


def scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _splits(_test_rows(proxies.auction(spark, sf_dir, AUCTION)), "row_id")


def score_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """:func:`scores` with ``n_rows``, the number of equal rows, in place of
    ``row_id``: rows are counted before the train rows are repeated, so the
    table is as long as there are different scores."""
    # written, since the folds read it twice
    rows = _test_rows(materialize(proxies.auction(spark, sf_dir, AUCTION), "auction-rows"))
    return _splits(rows.groupBy("model_key", "fold", "y", "s", "thr").agg(F.count(F.lit(1)).alias("n_rows")), "n_rows")


def _splits(long: DataFrame, kept: str) -> DataFrame:
    test = long.select("model_key", kept, "fold", "y", (F.col("s") / 100.0).alias("score"),
                       (F.col("s") >= F.col("thr")).cast("int").alias("pred"), F.lit("test").alias("split"))
    s2 = F.when(F.col("model_key") == "svm", F.col("s") + 3).otherwise(F.least(F.col("s") + 3, F.lit(100)))
    train = (long.withColumn("s2", s2)
             .select("*", F.explode(F.sequence(F.lit(1), F.lit(N_FOLDS))).alias("k"))
             .where(F.col("k") != F.col("fold"))
             .select("model_key", kept, F.col("k").cast("int").alias("fold"), "y",
                     (F.col("s2") / 100.0).alias("score"), (F.col("s2") >= F.col("thr")).cast("int").alias("pred"),
                     F.lit("train").alias("split")))
    return test.unionByName(train)


def fold_times(sc: DataFrame) -> DataFrame:
    """``model_key, fold, fit_time, score_time`` (cost proxy)."""
    fit = F.create_map(*[F.lit(x) for kv in FIT_COST.items() for x in kv])
    scr = F.create_map(*[F.lit(x) for kv in SCORE_COST.items() for x in kv])
    c = sc.groupBy("model_key", "fold").agg(count_rows(sc, F.col("split") == "train").alias("_ntr"),
                                            count_rows(sc, F.col("split") == "test").alias("_nte"))
    return c.select("model_key", "fold", (F.col("_ntr") * fit[F.col("model_key")] / 100000.0).alias("fit_time"),
                    (F.col("_nte") * scr[F.col("model_key")] / 100000.0).alias("score_time"))


def _sql_scores() -> str:
    parts = []
    for k in MODEL_KEYS:
        expr = {
            "lr": "CAST(floor(100 * VehBCost / (VehBCost + 250000)) AS BIGINT)",
            "dt": "IsBadBuy * 40 + (row_id * 37) % 61",
            "rf": "IsBadBuy * 35 + (row_id * 13) % 66",
            "knn": "least(5, IsBadBuy * 2 + row_id % 4) * 20",
            "svm": "(row_id * 7) % 201 - 100 + IsBadBuy * 15",
        }[k]
        parts.append(f"SELECT '{k}' AS model_key, row_id, fold, IsBadBuy AS y, CAST({expr} AS BIGINT) AS s, "
                     f"{THRESHOLD[k]} AS thr FROM fold_a")
    sc = "\nUNION ALL\n".join(parts)
    return FOLDS + f""",
sc AS ({sc}),
scores AS (
  SELECT model_key, row_id, fold, y, s / 100.0::DOUBLE AS score, CAST(s >= thr AS INTEGER) AS pred, 'test' AS split FROM sc
  UNION ALL
  SELECT model_key, row_id, CAST(k AS INTEGER) AS fold, y, s2 / 100.0::DOUBLE AS score,
         CAST(s2 >= thr AS INTEGER) AS pred, 'train' AS split
  FROM (SELECT *, CASE WHEN model_key = 'svm' THEN s + 3 ELSE least(s + 3, 100) END AS s2 FROM sc) t,
       range(1, {N_FOLDS + 1}) r(k)
  WHERE k <> fold),
times AS (
  SELECT model_key, fold,
         count(*) FILTER (WHERE split = 'train') * (CASE model_key {" ".join(f"WHEN '{k}' THEN {v}::DOUBLE" for k, v in FIT_COST.items())} END) / 100000.0::DOUBLE AS fit_time,
         count(*) FILTER (WHERE split = 'test') * (CASE model_key {" ".join(f"WHEN '{k}' THEN {v}::DOUBLE" for k, v in SCORE_COST.items())} END) / 100000.0::DOUBLE AS score_time
  FROM scores GROUP BY model_key, fold)"""


SCORES_SQL = _sql_scores()

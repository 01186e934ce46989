"""Model, k-NN and source queries (M1-M11, V1-V2 on MLlib, M5, I6, B5, S1-S5).

MLlib fits are not SQL-expressible: those queries have no oracle SQL (the
driver checks rows only). The k-NN classifier and k-NN imputation are exact
and have brute-force oracle SQL.
"""

from __future__ import annotations

from pyspark.ml import PipelineModel
from pyspark.sql import Window
from pyspark.sql import functions as F

from kestrel.functions.scalar import now_iso
from kestrel.operators import knn
from kestrel.operators import leaderboard as lb
from kestrel.operators import metrics as mt
from kestrel.operators import sampling as sp
from kestrel.operators import training as tr
from kestrel.plans import sqlgen as sg
from kestrel.plans.q_sampling import SPLIT
from kestrel.plans.registry import register
from kestrel.plans.views import with_views
from kestrel.sources import io, proxies
from kestrel.sources.tables import load
from kestrel.storage import materialize

NUM = ["VehicleAge", "VehYear", "VehOdo", "VehBCost", "MMRAcquisitionAuctionAveragePrice", "WarrantyCost",
       "purchase_year", "purchase_month", "purchase_day", "purchase_dow", "odo_per_year", "warranty_cost_ratio",
       "age_x_odo"]
CAT = ["Auction", "Make", "Model", "Size", "vehicle_age_group"]
CV_MODELS = ("lr", "dt", "rf", "knn", "svm")


def _auction_xy(spark, sf):
    """The auction rows, written once: a fit reads them many times."""
    return materialize(proxies.auction(spark, sf), "auction")


def _split_once(spark, sf):
    return materialize(sp.stratified_split(proxies.auction(spark, sf), "IsBadBuy", "row_id", 0.2), "auction-split")


def _cv(spark, sf, **options):
    a = _auction_xy(spark, sf)
    n = a.count()
    models = {k: v for k, v in tr.model_registry(n_train=n).items() if k in CV_MODELS}
    # the folds run on concurrent driver threads
    return tr.cross_validate(a, "IsBadBuy", "row_id", NUM, CAT, models=models, k=5, parallelism=8, **options)


# ---------------------------------------------------------------- V1, V2, M1-M4, M7, M11
@register("m1_m7_cv_oof_scores")
def m1_m7_cv_oof_scores(spark, sf):
    scores, _, _ = _cv(spark, sf, time_scoring=False)
    return scores


@register("v10_mllib_cv_leaderboard")
def v10_mllib_cv_leaderboard(spark, sf):
    """CV summary, OOF metrics, train/test gap and comparison for the fitted
    baselines, with their measured times."""
    scores, times, methods = _cv(spark, sf, with_train_scores=True)
    test, train = scores.where(F.col("split") == "test"), scores.where(F.col("split") == "train")
    test_folds = materialize(mt.fold_metrics(test, ["model_key", "fold"], "test_"), "cv-test-folds")
    train_folds = materialize(mt.fold_metrics(train, ["model_key", "fold"], "train_"), "cv-train-folds")
    cv = materialize(mt.cv_summary(test_folds.join(times, ["model_key", "fold"])), "cv-summary")
    meth = F.create_map(*[F.lit(x) for kv in methods.items() for x in kv])
    oof = materialize(mt.oof_metrics(test).withColumn("score_method", meth[F.col("model_key")]), "cv-oof")
    return lb.comparison_table(cv, oof, mt.train_test_gap(train_folds, test_folds))


@register("v11_fitted_train_test_gap")
def v11_fitted_train_test_gap(spark, sf):
    """Train/test gap of the fitted baselines."""
    scores, _, _ = _cv(spark, sf, with_train_scores=True, time_scoring=False)
    folds = {s: mt.fold_metrics(scores.where(F.col("split") == s), ["model_key", "fold"], f"{s}_") for s in ("train", "test")}
    return mt.train_test_gap(folds["train"], folds["test"])


_ORDERS = "(SELECT o_orderkey AS row_id, CAST(o_orderpriority = '1-URGENT' AS INTEGER) AS y FROM orders)"
_KEYS = ", ".join(f"('{k}')" for k in CV_MODELS)


@register("v1_v2_fitted_score_invariants", f"""
SELECT model_key, count(*) AS test_rows, count(DISTINCT row_id) AS test_ids, sum(y)::BIGINT AS test_bad, 4 * count(*) AS train_rows,
       count(DISTINCT row_id) AS train_ids, 5::BIGINT AS folds, true AS four_times_in_train, true AS never_both,
       true AS in_range, true AS pred_follows_score, CASE model_key WHEN 'svm' THEN 'decision_function' ELSE 'predict_proba' END AS score_method
FROM {_ORDERS}, (VALUES {_KEYS}) m(model_key) GROUP BY model_key""")
def v1_v2_fitted_score_invariants(spark, sf):
    """What five folds of any fit must satisfy, per model: every row once as a
    test row and four times as a train row, never both in a fold; scores in
    the range of their method, classes that follow them."""
    scores, _, methods = _cv(spark, sf, with_train_scores=True, time_scoring=False)
    test, train = F.col("split") == "test", F.col("split") == "train"
    per_row = scores.groupBy("model_key", "row_id").agg(
        F.count_if(test).alias("n_test"), F.count_if(train).alias("n_train"), F.count_distinct("fold").alias("n_folds"), F.max("y").alias("y"))
    rows = per_row.groupBy("model_key").agg(
        F.sum("n_test").alias("test_rows"), F.count_if(F.col("n_test") > 0).alias("test_ids"), F.sum(F.col("y").cast("long")).alias("test_bad"),
        F.sum("n_train").alias("train_rows"), F.count_if(F.col("n_train") > 0).alias("train_ids"),
        F.every(F.col("n_train") == 4).alias("four_times_in_train"), F.every(F.col("n_folds") == F.col("n_test") + F.col("n_train")).alias("never_both"))
    probability = F.col("model_key") != "svm"
    cut = F.when(probability, 0.5).otherwise(0.0)
    by_score = scores.groupBy("model_key").agg(
        F.count_distinct("fold").alias("folds"),
        F.every(F.when(probability, F.col("score").between(0, 1)).otherwise(F.col("score").isNotNull())).alias("in_range"),
        F.every((F.col("score") == cut) | ((F.col("score") > cut) == (F.col("pred") == 1))).alias("pred_follows_score"))
    method = F.create_map(*[F.lit(x) for kv in methods.items() for x in kv])
    return rows.join(by_score, "model_key").withColumn("score_method", method[F.col("model_key")])


# ---------------------------------------------------------------- K6, K2, A8 on measured times
@register("k6_measured_points", """
SELECT model_key, 3::INTEGER AS cv_folds, true AS fit_time_measured, true AS score_time_measured, true AS f1_in_range,
       true AS bucket_follows_median, 3::BIGINT AS points
FROM (VALUES ('lr'), ('dt'), ('nb')) m(model_key)""")
def k6_measured_points(spark, sf):
    """Time against F1 of models fitted here: what any measured points must
    satisfy, and the speed bucket that follows from them."""
    a = _auction_xy(spark, sf)
    models = tr.model_registry(n_train=a.count(), include_optional=True, tree_depth=5)
    scores, times, _ = tr.cross_validate(a, "IsBadBuy", "row_id", NUM, CAT, models={k: models[k] for k in ("lr", "dt", "nb")}, k=3)
    folds = mt.fold_metrics(scores, ["model_key", "fold"], "test_").join(times, ["model_key", "fold"])
    cv = lb.enrich(materialize(mt.cv_summary(folds), "cv-summary"))
    points = cv.select("model_key", "cv_folds", "fit_time_mean", "score_time_mean", "test_f1_mean", "speed_bucket")
    median = F.percentile("fit_time_mean", 0.5).over(Window.partitionBy())  # one row a model
    faster = F.col("speed_bucket") == lb.FASTER
    return points.select("model_key", "cv_folds", (F.col("fit_time_mean") > 0).alias("fit_time_measured"),
                         (F.col("score_time_mean") > 0).alias("score_time_measured"), F.col("test_f1_mean").between(0, 1).alias("f1_in_range"),
                         (faster == (F.col("fit_time_mean") <= median)).alias("bucket_follows_median"),
                         F.count(F.lit(1)).over(Window.partitionBy()).alias("points"))


# ---------------------------------------------------------------- M7, M8, M9, M10, S5
def _fit_on_split(spark, sf):
    a = _split_once(spark, sf)
    train = a.where(F.col("split") == "train")
    n = train.count()
    models = {k: v for k, v in tr.model_registry(n_train=n).items() if k in CV_MODELS}
    fitted = tr.fit_full_pipelines(train, "IsBadBuy", NUM, CAT, models=models)
    return a, fitted, n


@register("m8_m10_manifest_and_reload_check")
def m8_m10_manifest_and_reload_check(spark, sf):
    a, fitted, n = _fit_on_split(spark, sf)
    paths = tr.save_models(fitted, tr.artifact_root(spark))
    sample = a.where(F.col("split") == "test").orderBy("row_id").limit(5)
    check = tr.reload_check(spark, paths, sample, "row_id")
    man = tr.manifest(spark, fitted, paths, "IsBadBuy", n, len(NUM) + len(CAT))
    return man.join(check, "model_key")


@register("m9_batch_scores")
def m9_batch_scores(spark, sf):
    a, fitted, _ = _fit_on_split(spark, sf)
    test = a.where(F.col("split") == "test")
    out = None
    for mk, m in fitted.items():
        s = tr.batch_score(m, test, "row_id").withColumn("model_key", F.lit(mk))
        out = s if out is None else out.unionByName(s)
    return out


_ESTIMATORS = {"lr": "LogisticRegression", "dt": "DecisionTreeClassification", "rf": "RandomForestClassification",
               "knn": "KNeighborsClassifier", "svm": "LinearSVC"}


@register("m7_m10_artifact_invariants", f"""
WITH r AS (SELECT row_id, y, row_number() OVER (PARTITION BY y ORDER BY md5(CAST(row_id AS VARCHAR) || '-42'), row_id) AS rk,
                  count(*) OVER (PARTITION BY y) AS n FROM {_ORDERS}),
s AS (SELECT count(*) FILTER (WHERE rk <= round(n * 0.2)) AS n_test, count(*) FILTER (WHERE rk > round(n * 0.2)) AS n_train FROM r)
SELECT model_key, estimator, n_train AS train_rows, {len(NUM) + len(CAT)}::BIGINT AS train_columns, 'trained' AS status, true AS artifact_exists,
       5::BIGINT AS n_predictions, n_test AS batch_rows, n_test AS batch_ids, true AS reloaded_scores_equal
FROM s, (VALUES {", ".join(f"('{k}', '{v}')" for k, v in _ESTIMATORS.items())}) m(model_key, estimator)""")
def m7_m10_artifact_invariants(spark, sf):
    """Per model: manifest row, artifact, reload check, and batch scores of the
    reloaded pipeline equal to those of the fitted one on the whole test split."""
    a, fitted, n = _fit_on_split(spark, sf)
    paths = tr.save_models(fitted, tr.artifact_root(spark))
    test = materialize(a.where(F.col("split") == "test"), "test-split")
    man = tr.manifest(spark, fitted, paths, "IsBadBuy", n, len(NUM) + len(CAT)).select(
        "model_key", "estimator", "train_rows", "train_columns", "status")
    check = tr.reload_check(spark, paths, test.orderBy("row_id").limit(5), "row_id").select("model_key", "artifact_exists", "n_predictions")
    out = None
    for mk, m in fitted.items():
        again = tr.batch_score(PipelineModel.load(paths[mk]), test, "row_id").withColumnsRenamed({"prediction": "p2", "score": "s2"})
        s = tr.batch_score(m, test, "row_id").join(again, "row_id").agg(
            F.lit(mk).alias("model_key"), F.count(F.lit(1)).alias("batch_rows"), F.count_distinct("row_id").alias("batch_ids"),
            F.every((F.col("prediction") == F.col("p2")) & (F.col("score") == F.col("s2"))).alias("reloaded_scores_equal"))
        out = s if out is None else out.unionByName(s)
    return man.join(check, "model_key").join(out, "model_key")


# ---------------------------------------------------------------- M5 (exact k-NN classifier)
_EMB_SPLIT = """emb_r AS (
  SELECT vec_id, embedding, CAST(label = 0 AS INTEGER) AS is_zero,
         row_number() OVER (PARTITION BY label = 0 ORDER BY md5(CAST(vec_id AS VARCHAR) || '-42'), vec_id) AS rk,
         count(*) OVER (PARTITION BY label = 0) AS n_c
  FROM embeddings),
emb_s AS (SELECT vec_id, embedding, is_zero,
                 CASE WHEN rk <= round(n_c * 0.2) THEN 'test' ELSE 'train' END AS split FROM emb_r)"""

_DIST = ("sqrt(list_sum(list_transform(list_zip(t.embedding, r.embedding), "
         "lambda p: (CAST(p[1] AS DOUBLE) - CAST(p[2] AS DOUBLE)) * (CAST(p[1] AS DOUBLE) - CAST(p[2] AS DOUBLE)))))")


@register("m5_knn_classifier", f"""
WITH {_EMB_SPLIT},
d AS (SELECT t.vec_id AS q, r.vec_id AS ref, r.is_zero AS y, {_DIST} AS dist
      FROM (SELECT * FROM emb_s WHERE split = 'test') t, (SELECT * FROM emb_s WHERE split = 'train') r),
nn AS (SELECT *, row_number() OVER (PARTITION BY q ORDER BY dist, ref) AS rn FROM d)
SELECT q AS vec_id, avg(CAST(y AS DOUBLE)) AS score, CAST(avg(CAST(y AS DOUBLE)) >= 0.5 AS INTEGER) AS pred
FROM nn WHERE rn <= 5 GROUP BY q""")
def m5_knn_classifier(spark, sf):
    e = sp.stratified_split(proxies.emb(spark, sf), "is_zero", "vec_id", 0.2)
    train, test = e.where(F.col("split") == "train"), e.where(F.col("split") == "test")
    return knn.knn_classify(train, test, "vec_id", "embedding", "is_zero", 5)


# ---------------------------------------------------------------- I6 (exact k-NN imputation)
_IMP = ["VehBCost", "VehOdo", "MMRAcquisitionAuctionAveragePrice", "WarrantyCost", "VehicleAge"]
# column -> remainder of row_id mod 97 whose rows lose it, besides the orders without lines: six
# sets of present columns, incomplete donors, and rows with nothing at all
_MASK = {"VehOdo": 1, "WarrantyCost": 2, "VehBCost": 3}


def _knn_impute_sql(k: int = 5) -> str:
    """Brute force over all (incomplete row, donor) pairs, from the rule."""
    n = len(_IMP)
    x = ", ".join((f"CASE WHEN row_id % 97 = {_MASK[c]} THEN NULL ELSE CAST({c} AS DOUBLE) END" if c in _MASK else f"CAST({c} AS DOUBLE)")
                  + f" AS x{i}" for i, c in enumerate(_IMP))
    shared = " + ".join(f"CAST(q.x{i} IS NOT NULL AND d.x{i} IS NOT NULL AS INTEGER)" for i in range(n))
    ss = " + ".join(f"coalesce((q.x{i} - d.x{i}) * (q.x{i} - d.x{i}), 0)" for i in range(n))
    near = " UNION ALL ".join(
        f"SELECT row_id, {j} AS j, avg(v) AS fill FROM (SELECT q.row_id, d.x{j} AS v, row_number() OVER (PARTITION BY q.row_id "
        f"ORDER BY sqrt({ss}) * sqrt({n}.0::DOUBLE / ({shared})), d.row_id) AS rn "
        f"FROM t q JOIN t d ON q.x{j} IS NULL AND d.x{j} IS NOT NULL AND ({shared}) > 0) WHERE rn <= {k} GROUP BY row_id" for j in range(n))
    cols = ", ".join(f"round(coalesce(x{i}, (SELECT fill FROM near WHERE near.row_id = t.row_id AND j = {i}), "
                     f"(SELECT avg(x{i}) FROM t)), 6) AS {c}" for i, c in enumerate(_IMP))
    return f"""
, t AS (SELECT row_id, {x} FROM auction)
, near AS ({near})
SELECT row_id, {cols} FROM t""".lstrip()


@register("i6_knn_impute", with_views(_knn_impute_sql(), "auction"))
def i6_knn_impute(spark, sf):
    a = proxies.auction(spark, sf).select("row_id", *[
        F.when(F.col("row_id") % 97 != _MASK[c], F.col(c)).alias(c) if c in _MASK else F.col(c) for c in _IMP])
    out = knn.knn_impute(a, _IMP, "row_id", 5)
    return out.select("row_id", *[F.round(c, 6).alias(c) for c in _IMP])


# ---------------------------------------------------------------- B5 (SMOTE)
_SMOTE_SQL = f"""
WITH e AS (SELECT vec_id, embedding, CAST(label = 0 AS INTEGER) AS is_zero FROM embeddings),
cnt AS (SELECT is_zero, count(*) AS n FROM e GROUP BY is_zero),
mm AS (SELECT arg_min(is_zero, n) AS min_cls, min(n) AS n_min, arg_max(is_zero, n) AS maj_cls FROM cnt),
mino AS (SELECT e.* FROM e, mm WHERE e.is_zero = mm.min_cls),
pairs AS (SELECT t.vec_id, r.vec_id AS nb, {_DIST} AS dist FROM mino t, mino r WHERE t.vec_id <> r.vec_id),
nn AS (SELECT vec_id, nb, row_number() OVER (PARTITION BY vec_id ORDER BY dist, nb) AS nn_rank FROM pairs),
rmin AS (SELECT vec_id, embedding,
                row_number() OVER (ORDER BY md5(CAST(vec_id AS VARCHAR) || '-42'), vec_id) AS rk FROM mino),
rmaj AS (SELECT row_number() OVER (ORDER BY md5(CAST(e.vec_id AS VARCHAR) || '-42'), e.vec_id) AS rk
         FROM e, mm WHERE e.is_zero = mm.maj_cls),
draws AS (SELECT rk - n_min - 1 AS i, n_min, md5(CAST(rk - n_min - 1 AS VARCHAR) || '-42') AS h
          FROM rmaj, mm WHERE rk > n_min),
d2 AS (SELECT i, (i % n_min) + 1 AS brk, (('0x' || substr(h, 1, 8))::BIGINT % 5) + 1 AS nn_rank,
              ('0x' || substr(h, 9, 8))::BIGINT / 4294967296.0::DOUBLE AS u FROM draws),
syn AS (SELECT -(d2.i + 1) AS vec_id, (SELECT min_cls FROM mm) AS is_zero,
               list_transform(list_zip(b.embedding, nv.embedding),
                              lambda p: CAST(p[1] AS DOUBLE) + d2.u * (CAST(p[2] AS DOUBLE) - CAST(p[1] AS DOUBLE))) AS v
        FROM d2 JOIN rmin b ON b.rk = d2.brk
        JOIN nn ON nn.vec_id = b.vec_id AND nn.nn_rank = d2.nn_rank
        JOIN mino nv ON nv.vec_id = nn.nb),
allr AS (SELECT vec_id, is_zero, 0 AS is_synthetic, list_transform(embedding, lambda x: CAST(x AS DOUBLE)) AS v FROM e
         UNION ALL SELECT vec_id, is_zero, 1, v FROM syn)
SELECT vec_id, is_zero, is_synthetic, round(v[1], 6) AS emb0, round(v[2], 6) AS emb1,
       round(list_sum(v), 6) AS emb_sum FROM allr"""


@register("b5_smote_embeddings", _SMOTE_SQL)
def b5_smote_embeddings(spark, sf):
    e = proxies.emb(spark, sf).select("vec_id", "embedding", "is_zero")
    out = knn.smote(e, "vec_id", "embedding", "is_zero", 5)
    v = F.col("embedding")
    return out.select("vec_id", "is_zero", "is_synthetic", F.round(v[0], 6).alias("emb0"),
                      F.round(v[1], 6).alias("emb1"),
                      F.round(F.aggregate(v, F.lit(0.0), lambda a, b: a + b), 6).alias("emb_sum"))


# ---------------------------------------------------------------- S1 / S3 (CSV round trip)
@register("s1_s3_csv_round_trip", "SELECT n_nationkey, n_name, n_regionkey FROM nation")
def s1_s3_csv_round_trip(spark, sf):
    nation = load(spark, sf, "nation")
    path = io.scratch_path(spark, "csv")
    io.write_table(nation, path, fmt="csv")
    return io.read_csv(spark, path, schema=nation.schema)


def _typed_round_trip(spark, sf, table):
    """Written as CSV and read again without a schema."""
    path = io.scratch_path(spark, f"csv-{table}")
    io.write_table(load(spark, sf, table), path, fmt="csv")
    return io.read_csv(spark, path, infer=True)


@register("s1_csv_inferred_orders", "SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate, o_orderpriority FROM orders")
def s1_csv_inferred_orders(spark, sf):
    return _typed_round_trip(spark, sf, "orders")


@register("s1_csv_inferred_events", "SELECT event_id, ts, user_id, event_type, value, props FROM events")
def s1_csv_inferred_events(spark, sf):
    return _typed_round_trip(spark, sf, "events")


# ---------------------------------------------------------------- E9 (preprocessor)
def _preprocessor_sql() -> str:
    """Vector size and active entries from the rule: a scaled number is zero
    where the filled value is the training median; a category has one entry,
    unless it is unseen."""
    feats = {"purchase_year": "year(PurchDate)", "purchase_month": "month(PurchDate)", "purchase_day": "day(PurchDate)",
             "purchase_dow": "isodow(PurchDate) - 1", "odo_per_year": "VehOdo / (VehicleAge + 1.0)",
             "warranty_cost_ratio": "WarrantyCost / (VehBCost + 1.0)", "age_x_odo": "VehicleAge * VehOdo",
             "vehicle_age_group": "CASE WHEN VehicleAge > -1 AND VehicleAge <= 2 THEN 'nuevo' WHEN VehicleAge > 2 AND VehicleAge <= 5 THEN 'semi_nuevo' "
                                  "WHEN VehicleAge > 5 AND VehicleAge <= 10 THEN 'usado' WHEN VehicleAge > 10 AND VehicleAge <= 30 THEN 'antiguo' END"}
    nums = ", ".join(f"CAST({feats.get(c, c)} AS DOUBLE) AS {c}" for c in NUM)
    cats = ", ".join(f"CAST({feats.get(c, c)} AS VARCHAR) AS {c}" for c in CAT)
    modes = ", ".join(f"(SELECT {c} FROM tr WHERE {c} IS NOT NULL GROUP BY {c} ORDER BY count(*) DESC, {c} LIMIT 1) AS mode_{c}" for c in CAT)
    n_cats = " + ".join(f"(SELECT count(DISTINCT coalesce({c}, mode_{c})) FROM tr, m)" for c in CAT)
    active = " + ".join(f"CAST(coalesce({c}, (SELECT value FROM med WHERE column_name = '{c}')) <> "
                        f"(SELECT value FROM med WHERE column_name = '{c}') AS INTEGER)" for c in NUM)
    seen = " + ".join(f"CAST(coalesce({c}, mode_{c}) IN (SELECT coalesce({c}, mode_{c}) FROM tr, m) AS INTEGER)" for c in CAT)
    ctes = f"""f AS (SELECT row_id, split, {nums}, {cats} FROM split_a),
tr AS (SELECT * FROM f WHERE split = 'train'),
med AS (SELECT column_name, value FROM {sg.quantiles("tr", NUM, [0.5])} q),
m AS (SELECT {modes})"""
    body = f"SELECT row_id, split, CAST({len(NUM)} + {n_cats} AS INTEGER) AS n_features, {active} + {seen} AS n_active FROM f, m"
    return with_views(body, "auction", extra=(SPLIT, ctes))


@register("e9_preprocessor_vectors", _preprocessor_sql())
def e9_preprocessor_vectors(spark, sf):
    """Fit the preprocessor on the training split, transform every row:
    vector size and number of active entries per row."""
    from pyspark.ml.functions import vector_to_array

    a = _split_once(spark, sf)
    prep = tr.build_preprocessor(NUM, CAT).fit(a.where(F.col("split") == "train"))
    arr = vector_to_array(tr.FEATURES)
    return prep.transform(a).select("row_id", "split", F.size(arr).alias("n_features"),
                                    F.size(F.filter(arr, lambda v: v != 0)).alias("n_active"))


# ---------------------------------------------------------------- S2 / S6 (optional and required inputs)
@register("s2_s6_optional_inputs", """
SELECT 'present' AS input, count(*) AS n_rows, sum(o_totalprice) IS NOT NULL AS has_total FROM orders
UNION ALL SELECT 'missing', 0, false""")
def s2_s6_optional_inputs(spark, sf):
    """An optional table that exists, one that does not, the first existing of
    several candidates, and the required-input checks on the former."""
    there = io.first_existing(spark, [f"{sf}/no_such_orders.parquet", f"{sf}/orders.parquet"])
    io.require_paths(spark, [there])
    schema = "o_orderkey long, o_totalprice double"
    present = io.require_rows(io.require_columns(io.read_optional(spark, there, schema), ["o_orderkey", "o_totalprice"]))
    missing = io.read_optional(spark, f"{sf}/no_such_orders.parquet", schema)
    out = [d.agg(F.count(F.lit(1)).alias("n_rows"), F.sum("o_totalprice").isNotNull().alias("has_total")).select(
        F.lit(name).alias("input"), "n_rows", "has_total") for name, d in (("present", present), ("missing", missing))]
    return out[0].unionByName(out[1])


# ---------------------------------------------------------------- S4 (partial results and resume)
@register("s4_partial_scores_resume", """
SELECT model_key, count(*) AS n_rows, count(DISTINCT row_id) AS n_ids, sum(y) AS n_bad
FROM (SELECT o_orderkey AS row_id, CAST(o_orderpriority = '1-URGENT' AS INTEGER) AS y FROM orders),
     (VALUES ('dt'), ('nb')) m(model_key) GROUP BY model_key""")
def s4_partial_scores_resume(spark, sf):
    """Cross-validation that writes each unit's (model and fold) scores when
    they are there; a second run fits only units that the first did not finish."""
    a = _auction_xy(spark, sf)
    models = tr.model_registry(include_optional=True)
    path = io.scratch_path(spark, "partial-scores")
    for wanted in (["nb"], ["nb", "dt"]):
        tr.cross_validate_resumable(a, "IsBadBuy", "row_id", NUM, CAT, {k: models[k] for k in wanted}, path, k=3)
    return tr.read_partial_scores(spark, path).groupBy("model_key").agg(
        F.count(F.lit(1)).alias("n_rows"), F.count_distinct("row_id").alias("n_ids"), F.sum("y").alias("n_bad"))


# ---------------------------------------------------------------- M6 (optional models)
@register("m6_optional_models", """
SELECT model_key, count(*) AS n_rows, count(DISTINCT row_id) AS n_ids, true AS score_in_range, true AS pred_follows_score
FROM (SELECT o_orderkey AS row_id FROM orders), (VALUES ('nb'), ('gbt')) m(model_key) GROUP BY model_key""")
def m6_optional_models(spark, sf):
    """Gaussian naive Bayes and boosted trees, fitted on all rows: what any fit must satisfy."""
    a = _auction_xy(spark, sf)
    models = tr.model_registry(n_train=a.count(), include_optional=True)
    fitted = tr.fit_full_pipelines(a, "IsBadBuy", NUM, CAT, models={k: models[k] for k in ("nb", "gbt")})
    out = None
    for mk, m in fitted.items():
        s = tr.batch_score(m, a, "row_id").agg(
            F.lit(mk).alias("model_key"), F.count(F.lit(1)).alias("n_rows"), F.count_distinct("row_id").alias("n_ids"),
            F.every(F.col("score").between(0, 1)).alias("score_in_range"),
            F.every((F.col("score") > 0.5) == (F.col("prediction") == 1)).alias("pred_follows_score"))
        out = s if out is None else out.unionByName(s)
    return out


# ---------------------------------------------------------------- X9 (timestamps of the log)
@register("x9_now_iso", "SELECT count(*) AS n_rows, 1 AS n_stamps, true AS well_formed, true AS recent FROM nation")
def x9_now_iso(spark, sf):
    t = load(spark, sf, "nation").select(now_iso().alias("t"))
    return t.agg(F.count(F.lit(1)).alias("n_rows"), F.count_distinct("t").cast("int").alias("n_stamps"),
                 F.every(F.col("t").rlike(r"^\d{4}-\d{2}-\d{2}T\d{2}:\d{2}:\d{2}")).alias("well_formed"),
                 F.every(F.abs(F.unix_timestamp(F.current_timestamp()) - F.unix_timestamp(F.to_timestamp("t"))) < 3600).alias("recent"))

from kestrel.plans import all_oracles
from kestrel.plans import score_views as sv

TIMED = ("v1_cv_fold_results", "v10_cv_summary", "j1_cv_oof_one_to_one_join", "j2_gap_join_new_columns", "k1_k3_model_comparison",
         "u3_selected_candidates", "u3_discarded_models", "k4_review_table", "k5_experiment_log", "k6_tradeoff_points")


def test_fold_times_count_every_score_row(spark):
    rows = [("lr", 1, "train")] * 3 + [("lr", 1, "test")] * 2 + [("knn", 2, "train")] * 5 + [("knn", 2, "test")]
    sc = spark.createDataFrame(rows, "model_key string, fold int, split string")
    got = {(r["model_key"], r["fold"]): (r["fit_time"], r["score_time"]) for r in sv.fold_times(sc).collect()}
    assert got == {("lr", 1): (3 * 10.0 / 100000, 2 * 0.38 / 100000), ("knn", 2): (5 * 1.3 / 100000, 234.5 / 100000)}


def test_queries_on_the_score_table_keep_their_times():
    sql = all_oracles()
    for name in TIMED:
        assert "fit_time" in sql[name].rsplit("FROM", 1)[0], name
        assert "avg(fit_time)" in sql[name] or name == "v1_cv_fold_results", name
    assert "fit_time" in sql["v1_cv_fold_results"].rsplit("SELECT", 1)[1]

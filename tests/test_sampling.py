from pyspark.sql import Window
from pyspark.sql import functions as F

from kestrel.operators import sampling as sp


def _data(spark, n=2000, pos_every=7):
    return spark.createDataFrame([(i, int(i % pos_every == 0)) for i in range(n)], "row_id long, y int")


def test_stratified_rank_equals_window_rank(spark):
    df = _data(spark)
    got = sp.stratified_rank(df, ["y"], "row_id").select("row_id", "_rank")
    w = Window.partitionBy("y").orderBy(sp.hash_key("row_id"), "row_id")
    want = df.select("row_id", F.row_number().over(w).alias("_want"))
    assert got.join(want, "row_id").where(F.col("_rank") != F.col("_want")).count() == 0


def test_split_is_disjoint_complete_and_stratified(spark):
    df = _data(spark)
    s = sp.stratified_split(df, "y", "row_id", 0.2)
    assert s.count() == 2000 and s.select("row_id").distinct().count() == 2000
    c = {(r["y"], r["split"]): r["count"] for r in s.groupBy("y", "split").count().collect()}
    n1 = sum(1 for i in range(2000) if i % 7 == 0)
    assert c[(1, "test")] == round(0.2 * n1) and c[(0, "test")] == round(0.2 * (2000 - n1))


def test_folds_balanced_per_class(spark):
    f = sp.stratified_folds(_data(spark), "y", "row_id", 5)
    sizes = f.groupBy("y", "fold").count().groupBy("y").agg(F.max("count") - F.min("count")).collect()
    assert all(r[1] <= 1 for r in sizes)


def test_oversample_balances_with_existing_rows(spark):
    df = _data(spark)
    bal = sp.random_oversample(df, "y", "row_id")
    c = {r["y"]: r["count"] for r in bal.groupBy("y").count().collect()}
    assert c[0] == c[1]
    copies = bal.where("is_copy = 1")
    assert copies.join(df.where("y = 1"), ["row_id", "y"], "left_anti").count() == 0


def test_undersample_and_weights(spark):
    df = _data(spark)
    u = sp.random_undersample(df, "y", "row_id")
    c = {r["y"]: r["count"] for r in u.groupBy("y").count().collect()}
    assert c[0] == c[1]
    w = {r["y"]: r["class_weight"] for r in sp.class_weights(df, "y").select("y", "class_weight").distinct().collect()}
    n1 = c[1]
    assert abs(w[1] - 2000 / (2 * n1)) < 1e-12


def test_balancing_inside_folds_does_not_leak(spark):
    df = _data(spark)
    f = sp.stratified_folds(df, "y", "row_id", 5)
    test_ids = f.where("fold = 1").select("row_id")
    train = f.where("fold != 1").drop("fold")
    bal = sp.random_oversample(train, "y", "row_id")
    assert bal.join(test_ids, "row_id").count() == 0


def test_null_strata_and_null_keys_keep_every_row(spark):
    rows = [(None if i % 11 == 0 else i, None if i % 10 == 0 else i % 2) for i in range(100)]
    df = spark.createDataFrame(rows, "row_id long, y int")
    for out in (sp.stratified_split(df, "y", "row_id", 0.2), sp.stratified_folds(df, "y", "row_id", 5), sp.class_weights(df, "y")):
        assert out.count() == 100
    assert sp.stratified_folds(df, "y", "row_id", 5).where("y IS NULL").groupBy("fold").count().count() == 5
    over = sp.random_oversample(df, "y", "row_id").groupBy("y").count().collect()
    assert len(over) == 3 and len({r["count"] for r in over}) == 1
    under = sp.random_undersample(df, "y", "row_id").groupBy("y").count().collect()
    assert {r["count"] for r in under} == {10}

import math

from pyspark.sql import functions as F

from kestrel.operators import encode as en


def test_unseen_and_null_category_one_hot(spark):
    train = spark.createDataFrame([("a",), ("b",), ("b",)], "c string")
    test = spark.createDataFrame([(1, "a"), (2, "b"), (3, "z"), (4, None)], "id int, c string")
    idx, ohe = en.fit_one_hot(train, "c")
    out = {r["id"]: r["c_slot"] for r in en.one_hot_slot(test, "c", idx, ohe).collect()}
    assert out == {1: 0, 2: 1, 3: None, 4: None}


def test_target_encoder_smoothing(spark):
    rows = [("one", 1)] + [("twenty", i % 2) for i in range(20)] + [("hundred", 1 if i < 80 else 0) for i in range(100)]
    df = spark.createDataFrame(rows, "c string, y int")
    fitted = en.fit_target_encoder(df, ["c"], "y")
    enc = {r["value"]: r["encoding"] for r in fitted.collect()}
    prior = (1 + 10 + 80) / 121
    assert abs(enc["one"] - prior) < 1e-12
    assert abs(enc["twenty"] - (0.5 * prior + 0.5 * 0.5)) < 1e-12
    lam = 1 / (1 + math.exp(-(100 - 20) / 10))
    assert abs(enc["hundred"] - (lam * 0.8 + (1 - lam) * prior)) < 1e-12
    out = en.transform_target_encoder(spark.createDataFrame([("new",), (None,)], "c string"), ["c"], fitted)
    assert all(abs(r["c"] - prior) < 1e-12 for r in out.collect())


def test_robust_scaler_zero_iqr(spark):
    df = spark.createDataFrame([(5.0, float(i)) for i in range(5)], "k double, x double")
    fitted = en.fit_robust_scaler(df, ["k", "x"])
    st = {r["column_name"]: (r["center"], r["scale"]) for r in fitted.collect()}
    assert st["k"] == (5.0, 1.0) and st["x"] == (2.0, 2.0)
    out = en.transform_robust_scaler(df, ["k", "x"], fitted).agg(F.max("k"), F.max("x")).first()
    assert out[0] == 0.0 and out[1] == 1.0


def test_dummies_drop_first_null_all_zero(spark):
    df = spark.createDataFrame([(1, "a"), (2, "b"), (3, None)], "id int, c string")
    out = {r["id"]: r["c_b"] for r in en.dummies(df, ["c"]).collect()}
    assert out == {1: 0, 2: 1, 3: 0}

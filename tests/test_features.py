from pyspark.sql import functions as F

from kestrel.operators import features as fe


def test_age_bins_are_right_closed(spark):
    vals = [-1.0, 0.0, 2.0, 2.5, 5.0, 10.0, 30.0, 31.0, None]
    df = spark.createDataFrame([(i, v) for i, v in enumerate(vals)], "id int, VehicleAge double")
    got = [r["vehicle_age_group"] for r in fe.add_age_group(df).orderBy("id").collect()]
    assert got == [None, "nuevo", "nuevo", "semi_nuevo", "semi_nuevo", "usado", "antiguo", None, None]


def test_quartile_bins_merge_equal_edges(spark):
    vals = [1.0] * 6 + [2.0, 3.0, 4.0, 5.0, 6.0, 7.0]
    df = spark.createDataFrame([(i, v) for i, v in enumerate(vals)], "id int, x double")
    out = fe.add_quartile_group(df, "x", "g").collect()
    labels = {r["x"]: r["g"] for r in out}
    # edges 1, 1, 1.5, 4.25, 7 merge to 1, 1.5, 4.25, 7: three bins, numbered
    assert (labels[1.0], labels[2.0], labels[5.0], labels[7.0]) == ("0", "1", "2", "2")


def test_quartile_bins_named(spark):
    df = spark.createDataFrame([(i, float(i)) for i in range(1, 9)], "id int, x double")
    out = {r["x"]: r["g"] for r in fe.add_quartile_group(df, "x", "g").collect()}
    assert out[1.0] == "bajo" and out[8.0] == "alto" and out[4.0] == "medio_bajo"


def test_equal_width_bins_edges_and_empty(spark):
    vals = [0.0, 1.0, 5.0, 10.0]
    df = spark.createDataFrame([(v,) for v in vals], "x double")
    out = fe.equal_width_bins(df, "x", 10).orderBy("bin_id").collect()
    assert len(out) == 10
    counts = [r["n_rows"] for r in out]
    assert counts[0] == 2  # 0 (padded lower edge) and 1 (on the edge, right-closed)
    assert counts[4] == 1 and counts[9] == 1 and sum(counts) == 4
    assert out[0]["lower"] < 0.0


def test_equal_width_single_value(spark):
    df = spark.createDataFrame([(3.0,), (3.0,)], "x double")
    out = fe.equal_width_bins(df, "x", 10).collect()
    assert len(out) == 1 and out[0]["n_rows"] == 2


def test_log_guard_rejects_nulls_and_negatives(spark):
    df = spark.createDataFrame([(1.0, 1.0, -1.0), (None, 2.0, 3.0)], "a double, b double, c double")
    assert fe.nonnegative_columns(df, ["a", "b", "c", "missing"]) == ["b"]


def test_feature_builder_persists_guard(spark, tmp_path):
    from kestrel.operators.stages import FeatureBuilder, FeatureBuilderModel

    df = spark.createDataFrame([("2020-01-06", 1.0, 2, 5.0, 100.0), ("bad", 2.0, 3, 1.0, 50.0)],
                               "PurchDate string, VehOdo double, VehicleAge int, WarrantyCost double, VehBCost double")
    m = FeatureBuilder().fit(df)
    p = str(tmp_path / "fb")
    m.write().overwrite().save(p)
    m2 = FeatureBuilderModel.load(p)
    out = m2.transform(df).orderBy("VehOdo").collect()
    assert out[0]["purchase_dow"] == 0 and out[1]["purchase_year"] is None
    assert "VehOdo_log1p" in out[0].asDict()

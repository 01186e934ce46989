import pytest
from pyspark.sql import functions as F

from kestrel.operators import clean as cl
from kestrel.operators import profile as pr
from kestrel.sources import io


def test_mode_ties_take_smallest_and_skip_nulls(spark):
    df = spark.createDataFrame([(1, "b"), (2, "a"), (3, "b"), (4, "a"), (5, None), (6, None), (7, None)],
                               "id int, c string")
    assert cl.mode_stats(df, ["c"]).first()["mode"] == "a"
    filled = {r["id"]: r["c"] for r in cl.fill_mode(df, ["c"]).collect()}
    assert filled[5] == "a"


def test_numeric_mode_uses_numeric_order(spark):
    df = spark.createDataFrame([(10,), (9,), (10,), (9,)], "x int")
    assert cl.mode_stats(df, ["x"]).first()["mode"] == "9.0"


def test_group_median_fill(spark):
    rows = [(1, 1, 0.5), (2, 1, 4.0), (3, 1, 6.0), (4, 2, None), (5, 2, None), (6, None, 9.0), (7, None, None)]
    df = spark.createDataFrame(rows, "id int, g int, x double")
    out = {r["id"]: r["x"] for r in cl.fill_group_median(df, "x", "g", low_to_null=1.0).collect()}
    # group 1 median of (4, 6) = 5 fills id 1 (0.5 <= 1 became NULL)
    assert out[1] == 5.0 and out[2] == 4.0
    # group 2 has only NULLs, the null-key row keeps its value, the rest take the
    # global median of the group-filled column (5, 4, 6, 9 -> 5.5)
    assert out[4] == 5.5 and out[5] == 5.5 and out[6] == 9.0 and out[7] == 5.5


def test_duplicates_with_null_keys(spark):
    df = spark.createDataFrame([("a", 1), ("a", 1), (None, 2), (None, 2), (None, 3)], "a string, b int")
    assert pr.duplicate_count(df).first()["n_duplicates"] == 2
    assert pr.duplicate_count(df, ["a"]).first()["n_duplicates"] == 3


def test_winsorize_keeps_null_and_clips(spark):
    df = spark.createDataFrame([(float(v),) for v in [1, 2, 3, 4, 100]] + [(None,)], "x double")
    out = sorted([r["x"] for r in cl.winsorize_iqr(df, ["x"]).collect()], key=lambda v: (v is None, v))
    assert out[-1] is None and out[-2] == 4 + 1.5 * 2


def test_constant_and_sparse_columns(spark):
    df = spark.createDataFrame([(1, None, 5, "k"), (2, None, 5, "k"), (3, None, 5, None)],
                               "a int, b string, c int, d string")
    assert set(cl.constant_columns(df)) == {"b", "c"}
    assert cl.sparse_columns(df, 0.95) == ["b"]


def test_dirty_text_tokens(spark):
    df = spark.createDataFrame([(1, " nan "), (2, "None"), (3, ""), (4, "NULL"), (5, " ok "), (6, None)],
                               "id int, s string")
    out = {r["id"]: r["s"] for r in cl.basic_text_cleanup(df, [], ["s"]).collect()}
    assert out == {1: "Missing", 2: "Missing", 3: "Missing", 4: "Missing", 5: "ok", 6: "Missing"}


def test_dirty_dates_coerce_and_epoch(spark):
    from kestrel.functions.scalar import epoch_seconds_to_ts, text_to_ts

    df = spark.createDataFrame([("2020-01-02", 1260144000), ("not a date", 0)], "s string, e long")
    out = df.select(text_to_ts("s").alias("t"), F.year(epoch_seconds_to_ts("e")).alias("y")).collect()
    assert out[1]["t"] is None and out[0]["y"] == 2009


def test_one_year_dates_fail_the_spread_check(spark):
    df = spark.createDataFrame([("2020-01-02",), ("2020-12-02",)], "s string").select(
        F.to_timestamp("s").alias("d"))
    with pytest.raises(ValueError):
        cl.require_date_spread(df, "d")


def test_require_columns_and_optional_scan(spark, tmp_path):
    df = spark.createDataFrame([(1,)], "a int")
    with pytest.raises(KeyError):
        io.require_columns(df, ["a", "b"])
    empty = io.read_optional(spark, str(tmp_path / "missing"), "a int, b string")
    assert empty.count() == 0 and empty.columns == ["a", "b"]


def test_csv_tokens_become_null(spark, tmp_path):
    p = tmp_path / "t.csv"
    p.write_text("a,b\nnan,1\nx,NA\nNone,\n")
    out = io.read_csv(spark, str(p)).collect()
    assert [r["a"] for r in out] == [None, "x", None]
    assert [r["b"] for r in out] == ["1", None, None]

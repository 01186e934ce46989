import numpy as np
from pyspark.sql import functions as F

from kestrel.operators.quantiles import exact_quantiles
from kestrel.operators.ordered import ordered_cumsum


def test_exact_quantiles_match_numpy_with_ties(spark):
    rng = np.random.default_rng(1)
    vals = np.concatenate([rng.integers(0, 7, 500).astype(float), rng.normal(3, 2, 300)])
    df = spark.createDataFrame([(i, float(v)) for i, v in enumerate(vals)] + [(10_000, None)], "id int, x double")
    probs = [0.0, 0.1, 0.25, 0.5, 0.75, 0.9, 1.0]
    got = {r["q"]: r["value"] for r in exact_quantiles(df, ["x"], probs).collect()}
    for p in probs:
        assert abs(got[p] - np.percentile(vals, p * 100)) < 1e-9


def test_grouped_quantiles_and_all_null_group(spark):
    rows = [(1, 1.0), (1, 2.0), (1, 10.0), (2, None), (None, 5.0), (None, 7.0)]
    df = spark.createDataFrame(rows, "g int, x double")
    got = {(r["g"], r["q"]): r["value"] for r in exact_quantiles(df, ["x"], [0.5], by=["g"]).collect()}
    assert got[(1, 0.5)] == 2.0
    assert got[(None, 0.5)] == 6.0
    assert (2, 0.5) not in got  # a group with only nulls has no quantile


def test_ordered_cumsum_matches_window(spark):
    rng = np.random.default_rng(3)
    rows = [(int(g), float(s), int(c)) for g, s, c in zip(rng.integers(0, 3, 400), rng.random(400).round(3),
                                                          rng.integers(1, 5, 400))]
    df = spark.createDataFrame(rows, "g int, s double, c int").groupBy("g", "s").agg(F.sum("c").alias("c"))
    out = ordered_cumsum(df, ["g"], "s", ["c"], descending=True, n_buckets=8).toPandas()
    for g, part in out.groupby("g"):
        part = part.sort_values("s", ascending=False)
        assert list(part["cum_c"]) == list(part["c"].cumsum())
        assert list(part["cum_rows"]) == list(range(1, len(part) + 1))


def test_exact_quantiles_small_groups_all_positions(spark):
    rng = np.random.default_rng(4)
    rows, data = [], {}
    for g, n in enumerate([1, 2, 3, 4, 5, 7, 13, 14, 50, 199, 200, 201, 1178, 2500]):
        v = rng.integers(0, max(2, n // 3), n).astype(float) + rng.random(n).round(1)
        data[g] = v
        rows += [(g, float(x)) for x in v]
    df = spark.createDataFrame(rows, "g int, x double")
    probs = [0.0, 0.05, 0.1, 0.25, 0.33, 0.5, 0.75, 0.9, 0.99, 1.0]
    got = {(r["g"], r["q"]): r["value"] for r in exact_quantiles(df, ["x"], probs, by=["g"]).collect()}
    for g, v in data.items():
        for p in probs:
            assert got[(g, p)] is not None and abs(got[(g, p)] - np.percentile(v, p * 100)) < 1e-9, (g, p)
